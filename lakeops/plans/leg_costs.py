"""The leg-cost training job (C6) as one composition of operators.

load -> drop constant columns (keys protected) -> column roles and check ->
per-group reports (service counts, target balance) -> single-price groups ->
stratified split per group -> Yeo-Johnson on numeric features (fit on the
training rows) -> categories as ordered target statistics (of the training
rows) -> one boosted model per group, saved under the run's id ->
relative errors and metrics -> champion/challenger decision -> registry rows.
:func:`persist` appends the errors and decisions and writes the reports.

Everything except the model fits is one lazy plan per output; the fits
are distributed Spark ML jobs run concurrently per group.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.names import model_key
from lakeops.operators import binning as B, boosting as H, encoding as C, errors as E, models as M, profile as P
from lakeops.operators import registry as G, transform as T
from lakeops.session import checkpoint_root, scratch_path, staged
from lakeops.sinks import writers as W

#: The categorical columns declared by the original job.
LEG_COST_CATEGORICAL = (
    "l_fk_transp_stages", "l_fk_modality", "ltc_fk_vat_rates", "pr_code_dep",
    "pr_fk_point_types_dep", "pr_code_dest", "pr_fk_point_types_dest", "ts_fk_margins",
    "cr_fk_services_rail", "cr_fk_measure_units", "cr_fk_currencies", "ce_fk_counterparty",
    "ef_code_fk_gng_freights", "cargo_guarded", "ts_date_start_year", "ts_date_start_month",
    "ts_date_start_day", "ts_date_finish_year", "ts_date_finish_month", "ts_date_finish_day",
)


@dataclass
class LegCostConfig:
    measure: str = "cr_fk_measure_units"
    service: str = "cr_fk_services_rail"
    target: str = "ce_cost"
    id_col: str = "ts_id"
    split_key: str | None = None        # numeric column that orders the split; None: hash of the row
    categorical: tuple = LEG_COST_CATEGORICAL
    exclude: tuple = ()                 # more non-feature columns (ids are excluded anyway)
    test_size: float = B.TEST_SIZE
    seed: int = M.SEED
    n_trees: int = M.N_TREES
    depth: int = M.DEPTH
    threshold: float = G.THRESHOLD
    yeo_johnson: bool = True
    parallelism: int = 4
    model_name: str = "GBTRegressor"
    learner: str = "spark_ml"           # or "boosted": all groups in one series of jobs, mean relative error as objective


def _registry_keys(df: DataFrame, cfg: LegCostConfig) -> DataFrame:
    """Group columns renamed to the registry's ``measure``/``service`` (strings)."""
    return (df.withColumnRenamed(cfg.measure, "__m").withColumnRenamed(cfg.service, "__s")
              .withColumn("measure", F.col("__m").cast("string"))
              .withColumn("service", F.col("__s").cast("string")).drop("__m", "__s"))


def run_leg_costs(spark: SparkSession, lc: DataFrame, registry: DataFrame,
                  cfg: LegCostConfig = LegCostConfig(), as_of=None, out_dir: str | None = None) -> dict:
    """Run the job on ``lc``; the models and predictions of this run go below
    ``out_dir/runs/<run id>`` (the shared checkpoint area if not given).

    ``row_id`` is ``cfg.split_key`` or, without one, a hash of the row's
    columns: the split depends on the rows alone, not on how they are
    partitioned.  Rows that agree in it fall on the same side of the split.
    """
    g = [cfg.measure, cfg.service]
    protect = g + [cfg.target, cfg.id_col]
    missing_keys = [c for c in protect if c not in lc.columns]
    if missing_keys:
        raise ValueError(f"input lacks required columns {missing_keys}")
    run_id = uuid.uuid4().hex
    run_dir = f"{out_dir.rstrip('/')}/runs/{run_id}" if out_dir else scratch_path(spark, f"leg_costs-{run_id}")

    # One materialisation of the input in the shared checkpoint folder: every
    # later pass (profile, groups, split, fit) reads it instead of re-running
    # the joins behind ``lc``.
    key = F.col(cfg.split_key).cast("long") if cfg.split_key else F.xxhash64(*sorted(lc.columns))
    checkpoint_root(spark)
    lc = lc.withColumn("row_id", key).checkpoint()
    not_features = [cfg.id_col, "row_id", *g, *cfg.exclude, *([cfg.split_key] if cfg.split_key else [])]
    protect = protect + ["row_id"]
    declared = P.schema_check(lc, cfg.categorical, [], cfg.target)
    if declared.missing:
        raise ValueError(f"input lacks declared columns {sorted(declared.missing)}")
    lc = P.drop_constant_columns(lc, protect=protect)
    roles = P.columns_by_type(lc, cfg.categorical, cfg.target, exclude=not_features)
    cat = [c for c in roles.categorical if c in lc.columns and c not in g]
    num = [c for c in roles.numeric if c not in g]
    check = P.schema_check(lc, cat, num, cfg.target, exclude=not_features)

    service_counts = P.value_counts(lc, [cfg.measure], cfg.service, "service_counts")
    balance = P.target_balance(lc, g, cfg.target)
    keyed = _registry_keys(lc, cfg)
    single = G.single_price_groups(keyed, ["measure", "service"], cfg.target, registry, as_of=as_of)

    multi = staged(G.multi_price_groups(lc, g, cfg.target).select(*g), "leg_costs-groups")
    rows = lc.join(multi, g, "left_semi")
    split = B.stratified_split(rows, g, cfg.target, "row_id", cfg.test_size, cfg.seed)
    split = split.drop("q", "bin")
    if cfg.yeo_johnson and num:
        params = T.yeo_johnson_fit(split.filter(~F.col("is_test")), g, num)
        split = T.yeo_johnson_apply(split, params, g, num)
    split = C.target_statistics(split, g, cat, cfg.target)
    if cfg.learner == "boosted":
        fit = H.fit_boosted(split, g, cfg.target, [*num, *cat], id_cols=["row_id", cfg.id_col], n_trees=cfg.n_trees,
                            depth=cfg.depth, out_path=run_dir)
    elif cfg.learner == "spark_ml":
        data = M.prepare_table(split, g, scratch_path(spark, "leg_cost_rows"))
        fit = M.fit_group_models(spark, data, g, cfg.target, [*num, *cat], id_cols=["row_id", cfg.id_col],
                                 max_iter=cfg.n_trees, max_depth=cfg.depth, seed=cfg.seed,
                                 parallelism=cfg.parallelism, out_path=run_dir)
    else:
        raise ValueError(f"no learner {cfg.learner!r}")
    model_run_id = F.concat_ws("_", model_key(cfg.measure, cfg.service, model_name=cfg.model_name), F.lit(run_id))
    errs = E.relative_errors(fit.predictions, "y", "prediction").withColumn("run_id", model_run_id)
    metrics = E.metrics_by_group(errs, g, "y", "prediction")
    scores = E.model_score(errs, g).withColumn("model_run_id", model_run_id)
    decisions = G.challenger_select(_registry_keys(scores, cfg), registry,
                                    threshold=cfg.threshold, as_of=as_of)
    decisions = decisions.unionByName(single)
    return {"run_id": run_id, "roles": roles, "check": check, "service_counts": service_counts,
            "balance": balance, "single_price": single, "fit": fit, "errors": errs,
            "metrics": metrics, "scores": scores, "decisions": decisions}


def persist(out: dict, out_dir: str, cfg: LegCostConfig = LegCostConfig()) -> dict:
    """Write what a run has found below ``out_dir`` and return the paths:

    * ``registry``: its decisions appended (column names of the registry);
    * ``row_errors``: one row per test row, appended, with ``run_id``;
    * ``runs/<run id>/...``: service counts, target balance and metrics as
      CSV, a folder per group, and the table of fits with the model folders.

    The registry rows come last: a run that dies before is not a champion.
    """
    root = out_dir.rstrip("/")
    run = f"{root}/runs/{out['run_id']}"
    g = [cfg.measure, cfg.service]
    paths = {"registry": f"{root}/registry", "row_errors": f"{root}/row_errors", "fits": f"{run}/fits",
             "service_counts": f"{run}/service_counts", "balance": f"{run}/balance", "metrics": f"{run}/metrics"}
    W.write_partitioned(out["service_counts"], paths["service_counts"], [cfg.measure])
    W.write_partitioned(out["balance"], paths["balance"], g)
    W.write_partitioned(out["metrics"], paths["metrics"], g)
    W.write_parquet(out["fit"].summary, paths["fits"])
    W.append(out["errors"], paths["row_errors"], is_path=True)
    W.append(out["decisions"], paths["registry"], is_path=True)
    return paths
