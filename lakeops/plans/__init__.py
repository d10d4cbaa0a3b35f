"""Composite jobs built from the operators, and the test-data roles."""
