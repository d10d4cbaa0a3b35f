"""Operators of a training-data pipeline: near-duplicate search, secret and
personal-data scans, quality rules, HTML extraction, URL filters, substring
dedup, benchmark decontamination, packing and language-model scoring.

Nothing else in the library imports this subpackage; the registered queries
are in ``queries.py``.
"""
