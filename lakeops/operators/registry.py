"""Champion/challenger model registry.

Registry rows: ``measure, service, model_run_id, value, mape, flag, date``.
The champion of a group is the row with the lowest ``mape`` (NULLs last),
newest ``date`` first among ties.  Best-per-group is computed by partial
aggregation (``min`` of a struct whose field order is the sort order), so a
group with a large share of the rows is reduced map-side instead of being
sorted on one task as a ``row_number`` window would.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.predicates import nan_to_null
from lakeops.functions.time import now_stamp

#: Fixed values of the original decision rule.
THRESHOLD = 0.99          # replace when new / stored < 0.99
MODEL_VALUE = -100.0      # "value" of a row that points at a model
NO_MODEL_ID = "no_model"  # model id of a single-price group
NO_MODEL_MAPE = 100.0     # mape of a single-price group
REGISTRY_COLS = ("measure", "service", "model_run_id", "value", "mape", "flag", "date")

_EPOCH = "1970-01-01 00:00:00"


def _micros(ts: str) -> Column:
    """Microseconds since the epoch, for ``timestamp_ntz`` or ``timestamp``."""
    return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"),
                            F.col(ts).cast("timestamp_ntz"))


def _as_of(as_of) -> Column:
    if as_of is None:
        return now_stamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def champion_score(registry: DataFrame, group_cols: Sequence[str] = ("measure", "service"),
                   score: str = "mape") -> DataFrame:
    """Per group: best score (``first_value(score) ORDER BY score NULLS LAST``)
    and the number of stored rows.  ``min`` skips NULLs and ranks NaN above
    numbers, exactly like that ordering."""
    return registry.groupBy(*group_cols).agg(F.min(score).alias("best_" + score),
                                             F.count(F.lit(1)).alias("n_stored"))


def champion_first_value(registry: DataFrame, group_cols: Sequence[str] = ("measure", "service"),
                         score: str = "mape") -> DataFrame:
    """Every registry row with ``score`` replaced by its group's best."""
    best = champion_score(registry, group_cols, score).drop("n_stored")
    j = registry.join(best, list(group_cols), "inner")
    return j.withColumn(score, F.col("best_" + score)).drop("best_" + score) \
            .select(*registry.columns)


def champion_row(registry: DataFrame, group_cols: Sequence[str] = ("measure", "service"),
                 score: str = "mape", date: str = "date", tie: str = "model_run_id") -> DataFrame:
    """The champion row of each group (W2): lowest score, NULLs last, newest
    date first, then ``tie`` ascending for a deterministic pick."""
    payload = [c for c in registry.columns if c not in set(group_cols)]
    key = F.struct(F.col(score).isNull().alias("_k0"), F.col(score).alias("_k1"),
                   (-_micros(date)).alias("_k2"), F.col(tie).alias("_k3"),
                   *[F.col(c).alias(f"_p_{c}") for c in payload])
    best = registry.groupBy(*group_cols).agg(F.min(key).alias("_b"))
    return best.select(*group_cols, *[F.col(f"_b._p_{c}").alias(c) for c in payload]) \
               .select(*registry.columns)


def challenger_select(new_scores: DataFrame, registry: DataFrame,
                      group_cols: Sequence[str] = ("measure", "service"), score: str = "mape",
                      threshold: float = THRESHOLD, as_of=None) -> DataFrame:
    """Registry rows to insert for newly trained models.

    No stored row for the group -> insert.  Otherwise insert only when
    ``new < threshold * stored_best`` (the product form of the ratio test,
    defined at 0).  A stored group whose scores are all NULL is not
    replaced, as a NaN ratio never passes.  ``new_scores`` has the group
    columns, ``model_run_id`` and ``score``.
    """
    champ = champion_score(registry, group_cols, score)
    j = new_scores.join(champ, list(group_cols), "left")
    keep = F.col("n_stored").isNull() | (F.col(score) < F.lit(threshold) * F.col("best_" + score))
    return j.filter(keep).select(
        *group_cols, F.col("model_run_id").cast("string").alias("model_run_id"),
        F.lit(MODEL_VALUE).alias("value"), F.col(score).cast("double").alias("mape"),
        F.lit(1).alias("flag"), _as_of(as_of).alias("date"))


def single_price_groups(df: DataFrame, group_cols: Sequence[str], target: str,
                        registry: DataFrame | None = None, as_of=None) -> DataFrame:
    """Groups whose target has at most one distinct value get a "no model"
    row, unless the registry already has the group (M14, A4).

    ``n_distinct <= 1`` is tested as ``min = max`` (or no values), three
    partial aggregates instead of a distinct count.  NaN counts as missing.
    """
    t = nan_to_null(F.col(target))
    g = df.groupBy(*group_cols).agg(F.min(t).alias("_mn"), F.max(t).alias("_mx"))
    single = g.filter(F.col("_mn").isNull() | (F.col("_mn") == F.col("_mx")))
    if registry is not None:
        single = single.join(registry.select(*group_cols), list(group_cols), "left_anti")
    return single.select(*group_cols, F.lit(NO_MODEL_ID).alias("model_run_id"),
                         F.col("_mn").cast("double").alias("value"),
                         F.lit(NO_MODEL_MAPE).alias("mape"), F.lit(0).alias("flag"),
                         _as_of(as_of).alias("date"))


def multi_price_groups(df: DataFrame, group_cols: Sequence[str], target: str) -> DataFrame:
    """Groups with two or more distinct target values (these get a model)."""
    t = nan_to_null(F.col(target))
    g = df.groupBy(*group_cols).agg(F.min(t).alias("_mn"), F.max(t).alias("_mx"),
                                    F.count(F.lit(1)).alias("n_rows"))
    return g.filter(F.col("_mn") < F.col("_mx")).select(*group_cols, "n_rows")

