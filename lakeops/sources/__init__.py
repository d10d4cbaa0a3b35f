"""Sources: files, catalog tables, literal rows, connector option builders."""

from lakeops.sources.files import (  # noqa: F401
    read_csv, read_csv_strings, cast_to_schema, read_table, key_scan,
    sql_scan, literal_rows, load_tables,
)
from lakeops.sources.connectors import jdbc_options, catalog_conf  # noqa: F401
from lakeops.sources.inference import (  # noqa: F401
    read_csv_inferred, read_csv_apart, inferred_types,
)
