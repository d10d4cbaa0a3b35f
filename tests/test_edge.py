"""Edge cases on tiny hand-made frames (FIXTURES.md section E)."""

import math

import pytest
from pyspark.sql import functions as F

from lakeops.functions.names import model_key, strip_prefixes
from lakeops.functions.predicates import eq_flag, is_non_negative, is_not_nan, row_mean
from lakeops.functions.time import zone_stamp
from lakeops.operators import binning as B, errors as E, keyed as K, legs as L
from lakeops.operators import profile as P, registry as G, quantiles as Q
from lakeops.sources.connectors import catalog_conf, jdbc_options
from lakeops.sources.files import literal_rows


def _key(t):
    return tuple((v is not None, v if v is not None else 0) for v in t)


def rows(df, *cols):
    """Rows as tuples, sorted with NULLs first."""
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)


# ------------------------------------------------------------------ keyed loads

def test_anti_join_empty_and_one_key(spark):
    stored = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    empty = spark.createDataFrame([], "id long, v string")
    assert K.anti_join(empty, stored, "id").count() == 0
    one = spark.createDataFrame([(3, "c")], "id long, v string")
    assert rows(K.insert_new_keys(one, stored, "id"), "id") == [(1,), (2,), (3,)]
    rep = K.insert_new_keys_report(one, stored, "id").first()
    assert (rep.n_batch, rep.n_skipped, rep.n_added) == (1, 0, 1)


def test_anti_join_null_in_reference_keeps_rows(spark):
    stored = spark.createDataFrame([(1,), (None,)], "id long")
    batch = spark.createDataFrame([(1,), (2,)], "id long")
    # NOT IN (1, NULL) would return nothing; the anti join keeps 2
    assert rows(K.anti_join(batch, stored, "id"), "id") == [(2,)]


def test_dedupe_policies(spark):
    batch = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id long, v string")
    with pytest.raises(ValueError):
        K.dedupe_batch(batch, "id", "error")
    assert K.dedupe_batch(batch, "id", "first").count() == 2
    assert K.dedupe_batch(batch, "id", "none").count() == 3


def test_append_new_keys_twice_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a")], "id long, v string").write.parquet(path)
    batch = spark.createDataFrame([(1, "x"), (2, "b")], "id long, v string")
    r1 = K.append_new_keys(batch, path, "id")
    r2 = K.append_new_keys(batch, path, "id")
    assert (r1["n_added"], r1["n_skipped"]) == (1, 1)
    assert (r2["n_added"], r2["n_skipped"]) == (0, 2)
    assert rows(spark.read.parquet(path), "id", "v") == [(1, "a"), (2, "b")]


def test_upsert_null_key_is_replaced_not_duplicated(spark):
    stored = spark.createDataFrame([(None, 1.0), (5, 2.0)], "customer_id long, total double")
    new = spark.createDataFrame([(None, 3.0)], "customer_id long, total double")
    once = K.upsert_by_key(stored, new, "customer_id")
    twice = K.upsert_by_key(once, new, "customer_id")
    assert rows(once, "customer_id", "total") == rows(twice, "customer_id", "total")
    assert sorted(rows(once, "total")) == [(2.0,), (3.0,)]
    rep = K.upsert_report(stored, new, "customer_id").first()
    assert (rep.n_replaced, rep.n_added, rep.n_kept, rep.n_total) == (1, 0, 1, 2)


def test_replace_by_key_table(spark, tmp_path):
    loc = str(tmp_path / "summary")
    spark.createDataFrame([(1, 1.0), (2, 2.0)], "k long, v double").write.parquet(loc)
    spark.sql(f"CREATE TABLE lk_sum USING parquet LOCATION '{loc}'")
    try:
        new = spark.createDataFrame([(2, 20.0), (3, 30.0)], "k long, v double")
        K.replace_by_key_table(spark, "lk_sum", new, "k")
        assert rows(spark.table("lk_sum"), "k", "v") == [(1, 1.0), (2, 20.0), (3, 30.0)]
    finally:
        spark.sql("DROP TABLE IF EXISTS lk_sum")


def test_items_with_unit_price_drops_unknown(spark):
    items = spark.createDataFrame([(1, 10, 100), (2, 11, 100), (3, 10, 999)],
                                  "item_id long, order_id long, product_id long")
    orders = spark.createDataFrame([(10,)], "order_id long")
    products = spark.createDataFrame([(100, 2.5)], "product_id long, price double")
    out = K.items_with_unit_price(items, orders, products, order_key="order_id",
                                  product_key="product_id", price_col="price")
    assert rows(out, "item_id", "unit_price") == [(1, 2.5)]


# ------------------------------------------------------------------ NaN / NULL

def test_not_nan_and_non_negative(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (-1.0,)], "lat double")
    assert rows(df.filter(is_not_nan("lat")), "lat") == [(-1.0,), (1.0,)]
    assert rows(df.filter(is_non_negative("lat")), "lat") == [(1.0,)]


def test_eq_flag_null_is_zero(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (None, None)], "a int, b int")
    assert [r.f for r in df.select(eq_flag("a", "b").alias("f")).collect()] == [1, 0, 0]


def test_row_mean_skips_missing(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None), (float("nan"), 2.0, 4.0)],
                               "a double, b double, c double")
    got = [r.m for r in df.select(row_mean("a", "b", "c").alias("m")).collect()]
    assert got == [2.0, None, 3.0]


# ------------------------------------------------------------------ leg-cost schema

def _leg_tables(spark):
    legs = spark.createDataFrame(
        [(1, 7, 1, 100.0, 2, 0, 0, 10, 11, 5000), (2, 7, 1, 50.0, 1, 0, 0, 10, 12, 3000),
         (3, 7, 1, 80.0, 1, 0, 0, 10, 11, 6000)],
        "id long, fk_transp_stages int, fk_modality int, distance double, day int, "
        "day_nko_dep int, day_nko_dest int, dep_fk_points_rail long, dest_fk_points_rail long, "
        "fk_transport_solution long")
    ltc = spark.createDataFrame([(1, 100, 1.0, 2.0, True, 20), (2, 100, 1.0, 1.0, True, 20),
                                 (3, 101, 1.0, 1.0, True, 20)],
                                "fk_legs long, fk_costs_rail long, basic double, quantity double, "
                                "active boolean, fk_vat_rates int")
    points = spark.createDataFrame([(10, "A", 1, 30.0, 50.0), (11, "B", 1, 31.0, 51.0),
                                    (12, "C", 2, float("nan"), 52.0)],
                                   "id long, code string, fk_point_types int, lon double, lat double")
    ts = spark.createDataFrame(
        [(5000, 1, "2024-01-02", "2024-02-03", 1, 1, 0, 0, 1.0, 1, 0, 2, 0),
         (3000, 1, "2024-01-02", "2024-02-03", 1, 1, 0, 0, 1.0, 1, 0, 2, 0),
         (6000, 2, "2024-03-04", "2024-04-05", 1, 1, 0, 0, 1.0, 1, 0, 2, 0)],
        "id long, fk_margins int, date_start string, date_finish string, rent_day_cont int, "
        "rent_day_wag int, own_cont int, train_cont int, cost_weight double, kkv int, auto int, "
        "quantity_cont int, return_wag int").withColumn("date_start", F.to_date("date_start")) \
        .withColumn("date_finish", F.to_date("date_finish"))
    cr = spark.createDataFrame([(100, 9, 3, 643), (101, 8, 3, 643)],
                               "id long, fk_services_rail int, fk_measure_units int, fk_currencies int")
    ce = spark.createDataFrame([(100, 77, 10.0), (100, 78, 12.0), (101, 77, 0.0)],
                               "fk_costs_rail long, fk_counterparty int, cost double")
    return legs, ltc, points, ts, cr, ce


def test_legs_costs_reference_schema(spark):
    lc = L.legs_costs(*_leg_tables(spark))
    # leg 2 has a NaN coordinate at its destination; leg 3 (id 6000) passes;
    # the cost bridge multiplies leg 1 by two expense rows
    got = rows(lc, "ts_id", "ce_cost", "ts_date_start_month", "pr_code_dep", "pr_code_dest")
    assert got == [(5000, 10.0, 1, "A", "B"), (5000, 12.0, 1, "A", "B"), (6000, 0.0, 3, "A", "B")]
    assert len(lc.columns) == 40      # the original projection has 40 columns


def test_cargo_guarded_null_and_default_modes(spark):
    cgt = spark.createDataFrame([(1.0, 1, 1, 1, 5000, 1), (2.0, 1, 1, 1, 5000, 99)],
                                "weight double, fk_cont_type int, quantity_cont int, quantity_wag int, "
                                "fk_transport_solution long, fk_etsng_freights long")
    ef = spark.createDataFrame([(1, 7, "X")], "id long, rt_id long, code_fk_gng_freights string")
    dpf = spark.createDataFrame([(7,), (0,)], "rt_id_fk_etsng_freights long")
    null_mode = rows(L.cargo_guarded(cgt, ef, dpf, "null"), "cgt_weight", "ef_code_fk_gng_freights",
                     "cargo_guarded")
    assert null_mode == [(1.0, "X", 1), (2.0, None, 0)]
    default_mode = rows(L.cargo_guarded(cgt, ef, dpf, "default"), "cgt_weight",
                        "ef_code_fk_gng_freights", "cargo_guarded")
    # unmatched freight becomes rt_id 0, which meets the listed key 0
    assert default_mode == [(1.0, "X", 1), (2.0, "", 1)]


def test_legs_costs_result_fanout_and_filter(spark):
    lc = spark.createDataFrame([(1, 5.0), (2, float("nan")), (3, -1.0), (4, 0.0)],
                               "ts_id long, ce_cost double")
    cgd = spark.createDataFrame([(1.0, 1, 1, "X", 1, 1), (2.0, 1, 1, "Y", 0, 1), (3.0, 1, 1, "Z", 0, 9)],
                                "cgt_weight double, cgt_quantity_cont int, cgt_quantity_wag int, "
                                "ef_code_fk_gng_freights string, cargo_guarded int, "
                                "cgt_fk_transport_solution long")
    for skew_safe in (True, False):
        out = L.legs_costs_result(lc, cgd, skew_safe=skew_safe)
        assert rows(out, "ts_id", "cgt_weight") == [(1, 1.0), (1, 2.0), (4, None)]


# ------------------------------------------------------------------ errors, quantiles

def test_relative_errors_zero_guard_keeps_ids(spark):
    df = spark.createDataFrame([(1, 0.0, 1.0), (2, 0.0, -1.0), (3, 2.0, 1.0), (4, 4.0, 5.0)],
                               "id int, y double, p double")
    out = E.relative_errors(df, "y", "p").orderBy("id").collect()
    assert [r.rel_err_abs for r in out] == [1.0, 1.0, 0.5, 0.25]
    assert [r.rel_err for r in out] == [1.0, -1.0, 0.5, -0.25]


def test_qcut_matches_pandas_and_describe(spark):
    xs = [1, 2, 3, 10, 20, 20, 20, 21]
    df = spark.createDataFrame([("g", i, float(x)) for i, x in enumerate(xs)], "g string, id int, x double")
    out = B.qcut_bins(df, ["g"], "x", 4).orderBy("id")
    assert [r.bin for r in out.collect()] == [0, 0, 1, 1, 2, 2, 2, 3]
    d = E.describe(df, ["g"], "x").first()
    assert (d.q1, d.q2, d.q3) == (2.75, 15.0, 20.0)
    assert math.isclose(d.std, 9.0938, abs_tol=1e-4)


def test_group_quantiles_ties_and_single_row(spark):
    df = spark.createDataFrame([("a", 5.0), ("a", 5.0), ("b", 1.0)], "g string, x double")
    q = {r.g: (r.q0, r.q1) for r in Q.group_quantiles(df, ["g"], "x", [0.0, 0.5]).collect()}
    assert q == {"a": (5.0, 5.0), "b": (1.0, 1.0)}


def test_histogram_constant_group(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", 1.0)], "g string, x double")
    h = E.error_histogram(df, ["g"], "x", 10).collect()
    assert [(r.bin, r["count"]) for r in h] == [(0, 2)]


# ------------------------------------------------------------------ registry

def test_single_vs_multi_price(spark):
    df = spark.createDataFrame([("m", "one", 5.0), ("m", "one", 5.0), ("m", "one", 5.0),
                                ("m", "two", 5.0), ("m", "two", 6.0), ("m", "two", 6.0)],
                               "measure string, service string, y double")
    s = G.single_price_groups(df, ["measure", "service"], "y", as_of="2026-01-01 00:00:00")
    assert rows(s, "service", "model_run_id", "value", "flag") == [("one", "no_model", 5.0, 0)]
    assert rows(G.multi_price_groups(df, ["measure", "service"], "y"), "service") == [("two",)]


def test_challenger_threshold_is_strict(spark):
    stored = spark.createDataFrame(
        [("m", s, "old", -100.0, mape, 1, None) for s, mape in (("null", None), ("zero", 0.0), ("one", 1.0))],
        "measure string, service string, model_run_id string, value double, mape double, flag int, "
        "date timestamp_ntz")
    new = spark.createDataFrame(
        [("m", s, f"{s}_{v}", v) for s in ("null", "zero", "one", "fresh") for v in (0.989, 0.99, 1.0)],
        "measure string, service string, model_run_id string, mape double")
    out = G.challenger_select(new, stored, as_of="2026-01-01 00:00:00")
    assert rows(out, "model_run_id") == [("fresh_0.989",), ("fresh_0.99",), ("fresh_1.0",), ("one_0.989",)]


def test_champion_row_nulls_last_newest_first(spark):
    reg = spark.createDataFrame(
        [("m", "s", "a", -100.0, None, 1, "2024-01-03 00:00:00"),
         ("m", "s", "b", -100.0, 0.5, 1, "2024-01-01 00:00:00"),
         ("m", "s", "c", -100.0, 0.5, 1, "2024-01-02 00:00:00")],
        "measure string, service string, model_run_id string, value double, mape double, flag int, "
        "date string").withColumn("date", F.col("date").cast("timestamp_ntz"))
    assert rows(G.champion_row(reg), "model_run_id") == [("c",)]
    fv = G.champion_first_value(reg)
    assert {r.mape for r in fv.collect()} == {0.5}


# ------------------------------------------------------------------ profile, names

def test_constant_columns(spark):
    df = spark.createDataFrame([(None, 1, 1, 1), (None, 1, None, 2), (None, 1, 1, 1)],
                               "all_null double, const int, const_null int, two int")
    assert P.constant_columns(df) == ["const", "const_null"]
    assert P.drop_constant_columns(df, protect=["const"]).columns == ["all_null", "const", "two"]
    nan_df = spark.createDataFrame([(float("nan"),), (2.0,)], "x double")
    assert P.constant_columns(nan_df) == ["x"]      # NaN counts as missing


def test_roles_and_schema_check(spark):
    df = spark.createDataFrame([(1, "a", True, 2.0, 3.0)], "id long, c string, b boolean, x double, y double")
    roles = P.columns_by_type(df, ["c"], "y", exclude=["id"])
    assert (roles.categorical, roles.numeric, roles.boolean) == (["c", "b"], ["x"], ["b"])
    chk = P.schema_check(df, ["c", "gone"], ["x"], "y")
    assert chk.missing == ["gone"] and chk.extra == ["id", "b"]


def test_strip_prefixes_keeps_remainder(spark):
    df = spark.createDataFrame([(1, 2, 3)], "num__a int, reminder__b int, remainder__c int")
    assert strip_prefixes(df).columns == ["a", "b", "remainder__c"]


def test_model_key_and_zone_stamp(spark):
    df = spark.createDataFrame([("m", 3, "2024-01-01 23:30:07.9")], "m string, s int, ts string")
    df = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    r = df.select(model_key("m", "s", model_name="GBT").alias("k"), zone_stamp("ts").alias("z")).first()
    assert r.k == "m_3_GBT"
    assert str(r.z) == "2024-01-02 02:30:07"


def test_target_balance_shares_sum_to_one(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("a", 2.0), ("a", float("nan")), ("b", 3.0)],
                               "g string, y double")
    tb = P.target_balance(df, ["g"], "y")
    got = rows(tb, "g", "y", "counts", "percent_counts")
    assert got == [("a", 1.0, 2, 2 / 3), ("a", 2.0, 1, 1 / 3), ("b", 3.0, 1, 1.0)]


# ------------------------------------------------------------------ sources

def test_connector_option_builders():
    o = jdbc_options("jdbc:example://h/db", "(SELECT * FROM t WHERE k > 0) s", "u", "p",
                     partition_column="k", lower_bound=0, upper_bound=100, num_partitions=8)
    assert o["dbtable"].startswith("(SELECT") and o["numPartitions"] == "8"
    with pytest.raises(ValueError):
        jdbc_options("u", "t", partition_column="k")
    c = catalog_conf("ch", "com.example.Catalog", host="h", port=8123, user="u", password="p")
    assert c["spark.sql.catalog.ch"] == "com.example.Catalog"
    assert c["spark.sql.catalog.ch.port"] == "8123"


def test_literal_rows_and_create_insert(spark, tmp_path):
    from lakeops.sinks import writers as W
    df = literal_rows(spark, [("Alice", 1), ("Bob", 2), ("Charlie", 3)], "name string, value int")
    loc = str(tmp_path / "t")
    W.create_table(spark, "lk_cid", "name STRING, value INT", location=loc, replace=True)
    try:
        W.append(df, "lk_cid")
        W.append(df, "lk_cid")
        assert spark.table("lk_cid").count() == 6
    finally:
        W.drop_table(spark, "lk_cid")


def test_sql_script_returns_last(spark):
    from lakeops.sinks.writers import run_sql_script
    out = run_sql_script(spark, ["CREATE OR REPLACE TEMP VIEW lk_x AS SELECT 1 AS a", "  ",
                                 "SELECT a + 1 AS b FROM lk_x"])
    assert out.first().b == 2


def test_sql_script_pieces():
    from lakeops.sinks.writers import split_statements
    text = "SELECT ';' AS a; -- x; y\n ; /* only; this */ ;SELECT \"a;b\", `c;d`, 'it\\'s;' -- end"
    assert split_statements(text) == ["SELECT ';' AS a", "SELECT \"a;b\", `c;d`, 'it\\'s;' -- end"]
    assert split_statements("") == split_statements(" ; -- none\n;") == []


def test_value_counts_ordered(spark):
    from lakeops.operators.profile import value_counts
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "y"), ("b", "z"), ("a", None)], "g string, v string")
    assert [tuple(r) for r in value_counts(df, ["g"], "v", ordered=True).collect()] == [("a", "y", 2), ("a", "x", 1), ("b", "z", 1)]
