"""Column-expression helpers (all built-in Spark expressions, codegen'd)."""

from lakeops.functions.predicates import (  # noqa: F401
    eq_flag, is_not_nan, is_non_negative, nan_to_null,
)
from lakeops.functions.time import zone_stamp  # noqa: F401
from lakeops.functions.names import model_key, strip_prefixes  # noqa: F401
