"""Named queries over the driver's test tables, each with a DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL``.
Every query reads the given tables (or data Spark derives from them), so
its work grows with them.  Doubles that come out of order-dependent sums
are rounded on *both* sides (money to 2 or 4 decimals, which is exact for
sums of 2-decimal values; other aggregates to 6).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeops.functions.names import model_key, strip_prefixes
from lakeops.functions.predicates import is_non_negative, is_not_nan, row_mean
from lakeops.functions.time import zone_stamp
from lakeops.operators import batches, bucketed, keyed, legs as L, lookup, profile as P
from lakeops.plans import orders as O, roles as R
from lakeops.session import scratch_path
from lakeops.sinks import writers as W
from lakeops.sources import files as S, inference as I

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def rounded(df: DataFrame, cols, digits: int) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


# =============================================================== SQL role snippets

def _sql_moved(table: str, key: str, rows: str) -> str:
    return f"(SELECT * REPLACE (CASE WHEN {rows} THEN -1 - {key} ELSE {key} END AS {key}) FROM {table})"


SQL_BATCH = _sql_moved("orders", "o_orderkey", "o_orderkey % 3 = 0")
SQL_STORED = _sql_moved("orders", "o_orderkey", "o_orderkey % 2 <> 0")
SQL_KNOWN = _sql_moved("customer", "c_custkey", "c_custkey % 5 = 0")
SQL_PRODUCTS = _sql_moved("part", "p_partkey", "p_partkey % 4 = 0")
SQL_CUTOFF = f"TIMESTAMP '{R.SUMMARY_CUTOFF}'"
SQL_AS_OF = f"TIMESTAMP '{R.AS_OF}'"


def sql_summary(where: str = "TRUE") -> str:
    return f"""(SELECT o.o_custkey AS customer_id, c.c_name AS customer_name,
        count(o.o_orderkey) AS total_orders, round(CAST(sum(o.o_totalprice) AS DOUBLE), 2) AS total_spent,
        max(o.o_orderdate) AS last_order_date
      FROM orders o LEFT JOIN {SQL_KNOWN} c ON o.o_custkey = c.c_custkey
      WHERE {where}
      GROUP BY o.o_custkey, c.c_name)"""


# =============================================================== orders ETL

@query("customer_summary", f"SELECT * FROM {sql_summary()}")
def q_customer_summary(spark, sf):
    t = R.tables(spark, sf)
    from lakeops.plans.orders import customer_summary
    return rounded(customer_summary(t.orders, R.known_customers(t), R.ORDER_COLS), ["total_spent"], 2)


@query("semi_join_known_customers", f"""
SELECT * FROM {SQL_BATCH} b
WHERE b.o_custkey IN (SELECT c_custkey FROM {SQL_KNOWN} k)""")
def q_semi(spark, sf):
    t = R.tables(spark, sf)
    return keyed.semi_join(R.orders_batch(t), R.known_customers(t), "o_custkey", "c_custkey")


@query("anti_join_new_rows", f"""
SELECT * FROM {SQL_BATCH} b
WHERE NOT EXISTS (SELECT 1 FROM {SQL_STORED} s WHERE s.o_orderkey = b.o_orderkey)""")
def q_anti(spark, sf):
    t = R.tables(spark, sf)
    return keyed.anti_join(R.orders_batch(t), R.orders_stored(t), "o_orderkey")


_SQL_NEW_ORDERS = f"""(SELECT * FROM {SQL_BATCH} b
   WHERE b.o_custkey IN (SELECT c_custkey FROM {SQL_KNOWN} k)
     AND NOT EXISTS (SELECT 1 FROM {SQL_STORED} s WHERE s.o_orderkey = b.o_orderkey))"""


@query("insert_new_keys", f"SELECT * FROM {SQL_STORED} s UNION ALL SELECT * FROM {_SQL_NEW_ORDERS} n")
def q_insert_new_keys(spark, sf):
    """C1 end to end: stored orders in a table folder, the known-customer
    batch appended with new keys only, the folder read back."""
    t = R.tables(spark, sf)
    path = scratch_path(spark, "orders_table")
    R.orders_stored(t).write.mode("overwrite").parquet(path)
    batch = keyed.semi_join(R.orders_batch(t), R.known_customers(t), "o_custkey", "c_custkey")
    keyed.append_new_keys(batch, path, "o_orderkey", dedupe="error")
    return spark.read.parquet(path)


_SQL_NULL_KEYS = "SELECT CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey END AS k, o_custkey AS c FROM orders"


@query("insert_null_keys_report", f"""
WITH b AS ({_SQL_NULL_KEYS} ), s AS (SELECT CASE WHEN c % 2 <> 0 THEN -1 - k ELSE k END AS k FROM ({_SQL_NULL_KEYS})),
f AS (SELECT EXISTS (SELECT 1 FROM s WHERE s.k IS NOT DISTINCT FROM b.k) AS hit FROM b)
SELECT count(*) AS n_batch, count(*) FILTER (WHERE hit) AS n_skipped, count(*) FILTER (WHERE NOT hit) AS n_added FROM f""")
def q_insert_null_keys(spark, sf):
    """A NULL key that is stored is not added again."""
    batch = R.tables(spark, sf).orders.select(F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey")).alias("k"), F.col("o_custkey").alias("c"))
    return keyed.insert_new_keys_report(batch, R.moved(batch, "k", F.col("c") % 2 != 0), "k")


@query("insert_new_keys_report", f"""
SELECT count(*) AS n_batch,
       count(*) FILTER (WHERE b.o_orderkey IN (SELECT o_orderkey FROM {SQL_STORED} s)) AS n_skipped,
       count(*) FILTER (WHERE b.o_orderkey NOT IN (SELECT o_orderkey FROM {SQL_STORED} s)) AS n_added
FROM {SQL_BATCH} b WHERE b.o_custkey IN (SELECT c_custkey FROM {SQL_KNOWN} k)""")
def q_insert_report(spark, sf):
    t = R.tables(spark, sf)
    batch = keyed.semi_join(R.orders_batch(t), R.known_customers(t), "o_custkey", "c_custkey")
    return keyed.insert_new_keys_report(batch, R.orders_stored(t), "o_orderkey")


@query("items_with_unit_price", f"""
SELECT l.*, p.p_retailprice AS unit_price
FROM lineitem l JOIN {SQL_PRODUCTS} p ON l.l_partkey = p.p_partkey
WHERE l.l_orderkey IN (SELECT o_orderkey FROM {SQL_BATCH} b)""")
def q_items(spark, sf):
    t = R.tables(spark, sf)
    return keyed.items_with_unit_price(t.lineitem, R.orders_batch(t), R.products(t),
                                       order_key="o_orderkey", product_key="p_partkey",
                                       price_col="p_retailprice", items_order_key="l_orderkey",
                                       items_product_key="l_partkey")


@query("load_orders", f"""
SELECT b.* FROM {SQL_BATCH} b WHERE b.o_custkey IN (SELECT c_custkey FROM {SQL_KNOWN} k)
  AND b.o_orderkey NOT IN (SELECT o_orderkey FROM {SQL_STORED} s)""")
def q_load_orders(spark, sf):
    """C1 as one plan: orders of known customers, new keys only."""
    t = R.tables(spark, sf)
    cols = O.OrderCols(order_id="o_orderkey", customer_id="o_custkey", customer_key="c_custkey")
    return O.load_orders(R.orders_batch(t), R.known_customers(t), R.orders_stored(t), cols)


#: Keys of the stored items.
_SQL_STORED_ITEMS = "(SELECT DISTINCT CASE WHEN l_orderkey % 5 <> 0 THEN -1 - l_orderkey ELSE l_orderkey END FROM lineitem)"


@query("load_items", f"""
SELECT l.*, p.p_retailprice AS unit_price
FROM lineitem l JOIN {SQL_PRODUCTS} p ON l.l_partkey = p.p_partkey
WHERE l.l_orderkey IN (SELECT o_orderkey FROM {SQL_BATCH} b)
  AND l.l_orderkey NOT IN {_SQL_STORED_ITEMS}""")
def q_load_items(spark, sf):
    """C2 as one plan: items priced, then only those whose key is not stored."""
    t = R.tables(spark, sf)
    stored = R.moved(t.lineitem, "l_orderkey", F.col("l_orderkey") % 5 != 0).select("l_orderkey").distinct()
    return O.load_items(t.lineitem, R.orders_batch(t), R.products(t), stored, item_id="l_orderkey", order_id="o_orderkey",
                        product_id="p_partkey", price="p_retailprice", items_order_id="l_orderkey", items_product_id="l_partkey")


_SQL_OLD = sql_summary(f"o.o_orderdate < {SQL_CUTOFF}")
_SQL_NEW = sql_summary(f"o.o_orderdate >= {SQL_CUTOFF}")


@query("upsert_by_key", f"""
SELECT * FROM {_SQL_OLD} o
WHERE NOT EXISTS (SELECT 1 FROM {_SQL_NEW} n WHERE n.customer_id IS NOT DISTINCT FROM o.customer_id)
UNION ALL SELECT * FROM {_SQL_NEW} n2""")
def q_upsert(spark, sf):
    """C3's replace step: the old summary in a folder, replaced by key with
    the new summary into a staged folder, which is read back."""
    t = R.tables(spark, sf)
    path = scratch_path(spark, "summary_table")
    rounded(R.summary_old(t), ["total_spent"], 2).write.mode("overwrite").parquet(path)
    new = rounded(R.summary_new(t), ["total_spent"], 2)
    out = keyed.replace_by_key_path(path, new, "customer_id")
    return spark.read.parquet(out)


@query("replace_in_key_buckets", f"""
SELECT * FROM {_SQL_OLD} o
WHERE NOT EXISTS (SELECT 1 FROM {_SQL_NEW} n WHERE n.customer_id IS NOT DISTINCT FROM o.customer_id)
UNION ALL SELECT * FROM {_SQL_NEW} n2""")
def q_replace_in_buckets(spark, sf):
    """K2 on a table in key buckets: only the buckets that the new summary's
    keys fall into are read and rewritten."""
    t = R.tables(spark, sf)
    name, loc = f"lakeops_kb_{uuid.uuid4().hex[:8]}", scratch_path(spark, "bucketed")
    bucketed.create_bucketed(rounded(R.summary_old(t), ["total_spent"], 2), name, "customer_id", 32, loc)
    bucketed.replace_in_buckets(spark, name, rounded(R.summary_new(t), ["total_spent"], 2))
    return bucketed.bucketed_rows(spark, name)


@query("append_new_keys_once", f"""
SELECT * FROM {SQL_STORED} s UNION ALL SELECT * FROM {_SQL_NEW_ORDERS} n""")
def q_append_once(spark, sf):
    """K1 by batches: the stored orders are one batch, the known customers'
    orders another, which is loaded twice."""
    t = R.tables(spark, sf)
    path = scratch_path(spark, "orders_batches")
    batches.append_batch(R.orders_stored(t), path, "stored")
    new = keyed.semi_join(R.orders_batch(t), R.known_customers(t), "o_custkey", "c_custkey")
    for _ in range(2):
        batches.append_new_keys_once(new, path, "o_orderkey", "new")
    return batches.committed_rows(spark, path, t.orders.schema)


@query("upsert_report", f"""
WITH s AS (SELECT DISTINCT customer_id FROM {_SQL_OLD} a),
     n AS (SELECT DISTINCT customer_id FROM {_SQL_NEW} b),
     j AS (SELECT s.customer_id AS sk, n.customer_id AS nk, s.customer_id IS NOT NULL AS hs,
                  n.customer_id IS NOT NULL AS hn
           FROM s FULL OUTER JOIN n ON s.customer_id IS NOT DISTINCT FROM n.customer_id)
SELECT count(*) FILTER (WHERE hs AND hn) AS n_replaced,
       count(*) FILTER (WHERE NOT hs) AS n_added,
       count(*) FILTER (WHERE NOT hn) AS n_kept,
       count(*) AS n_total
FROM j""")
def q_upsert_report(spark, sf):
    t = R.tables(spark, sf)
    return keyed.upsert_report(R.summary_old(t), R.summary_new(t), "customer_id")


def _stored_by_key(spark, rows, key: str) -> str:
    name = f"lakeops_bk_{uuid.uuid4().hex[:8]}"
    lookup.store_by_key(rows, name, key, 32, scratch_path(spark, "by_key"))
    return name


@query("stored_lookup_known", f"SELECT * FROM {SQL_BATCH} b WHERE b.o_custkey IN (SELECT c_custkey FROM {SQL_KNOWN} k)")
def q_stored_lookup(spark, sf):
    """The batch's orders of known customers; the customers lie in
    buckets of their key and are not shuffled."""
    t = R.tables(spark, sf)
    return lookup.rows_with_stored_key(R.orders_batch(t), _stored_by_key(spark, R.known_customers(t), "c_custkey"), "o_custkey", "c_custkey")


@query("stored_insert_new_keys", f"SELECT * FROM {SQL_STORED} s UNION ALL SELECT * FROM {SQL_BATCH} b WHERE b.o_orderkey NOT IN (SELECT o_orderkey FROM {SQL_STORED} s2)")
def q_stored_insert(spark, sf):
    """The batch's new keys are appended to the stored orders, which
    lie in buckets of their key and are not shuffled."""
    t = R.tables(spark, sf)
    name = _stored_by_key(spark, R.orders_stored(t), "o_orderkey")
    lookup.append_new_keys_stored(R.orders_batch(t), name, "o_orderkey")
    return spark.table(name)


# =============================================================== sources / sinks

@query("table_scan", "SELECT * FROM lineitem")
def q_table_scan(spark, sf):
    return S.read_table(spark, sf, "lineitem")


@query("key_scan", "SELECT o_orderkey FROM orders")
def q_key_scan(spark, sf):
    return S.key_scan(S.read_table(spark, sf, "orders"), "o_orderkey")


@query("sql_table_scan", "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_acctbal > 0")
def q_sql_scan(spark, sf):
    view = f"lakeops_customer_{uuid.uuid4().hex[:8]}"
    return S.sql_scan(spark, S.read_table(spark, sf, "customer"), view,
                      f"SELECT c_custkey, c_name, c_mktsegment FROM {view} WHERE c_acctbal > 0")


@query("csv_roundtrip", "SELECT * FROM customer")
def q_csv_roundtrip(spark, sf):
    cust = S.read_table(spark, sf, "customer")
    path = W.write_csv(cust, scratch_path(spark, "customer_csv"))
    return S.read_csv(spark, path, cust.schema)


@query("csv_strings_cast", "SELECT * FROM customer")
def q_csv_strings(spark, sf):
    cust = S.read_table(spark, sf, "customer")
    path = W.write_csv(cust, scratch_path(spark, "customer_csv"))
    strings = S.read_csv_strings(spark, path)
    return S.cast_to_schema(strings, cust.schema)


#: Columns of a CSV file whose types are to be found, as SQL for both engines.
_UNTYPED = {
    "k": "CAST(o_orderkey AS {s})", "price": "CAST(o_totalprice AS {s})", "day": "CAST(CAST(o_orderdate AS DATE) AS {s})",
    "stamp": "CAST(o_orderdate AS {s})", "priority": "o_orderpriority", "even": "CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END",
    "mixed": "CASE WHEN o_custkey % 50 = 7 THEN 'n/a' ELSE CAST(o_custkey AS {s}) END",
    "gaps": "CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_custkey AS {s}) END",
    "number": "CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_custkey AS {s}) ELSE '0.5' END",
    "moment": "CASE WHEN o_orderkey % 3 > 0 THEN CAST(CAST(o_orderdate AS DATE) AS {s}) ELSE CAST(o_orderdate AS {s}) END",
    "nothing": "CAST(NULL AS {s})",
}
_TYPED = {"k": "BIGINT", "price": "DOUBLE", "stamp": "TIMESTAMP", "even": "BOOLEAN", "gaps": "BIGINT", "number": "DOUBLE", "moment": "TIMESTAMP"}


def _sql_untyped(string: str) -> str:
    return ", ".join(f"{x.format(s=string)} AS {c}" for c, x in _UNTYPED.items())


def _sql_type_of(c: str) -> str:
    forms = (("bigint", "BIGINT", r"[+-]?[0-9]+"), ("double", "DOUBLE", r"[+-]?[0-9]+([.][0-9]*)?([eE][+-]?[0-9]+)?"),
             ("date", "DATE", r"[0-9]{4}-[0-9]{2}-[0-9]{2}"), ("timestamp_ntz", "TIMESTAMP", r"[0-9]{4}-[0-9]{2}-[0-9]{2}( [0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?)?"),
             ("boolean", "BOOLEAN", "true|false"))
    when = " ".join(f"WHEN bool_and({c} IS NULL OR (regexp_full_match({c}, '{form}') AND TRY_CAST({c} AS {t}) IS NOT NULL)) THEN '{name}'" for name, t, form in forms)
    return f"""SELECT '{c}' AS "column", CASE WHEN count({c}) = 0 THEN 'string' {when} ELSE 'string' END AS type FROM u"""


def _untyped_csv(spark, sf) -> str:
    return W.write_csv(S.read_table(spark, sf, "orders").selectExpr(*[f"{x.format(s='STRING')} AS {c}" for c, x in _UNTYPED.items()]), scratch_path(spark, "untyped_csv"))


@query("csv_inferred", f"SELECT {', '.join(f'CAST({c} AS {_TYPED[c]}) AS {c}' if c in _TYPED else c for c in _UNTYPED if c != 'day')}, datediff('day', DATE '1970-01-01', CAST(day AS DATE)) AS day FROM (SELECT {_sql_untyped('VARCHAR')} FROM orders) u")
def q_csv_inferred(spark, sf):
    """A CSV file of orders read with the types of its values (the date
    as a day number)."""
    return I.read_csv_inferred(spark, _untyped_csv(spark, sf)).withColumn("day", F.unix_date("day").cast("long"))


@query("csv_inferred_schema", f"WITH u AS (SELECT {_sql_untyped('VARCHAR')} FROM orders) " + " UNION ALL ".join(map(_sql_type_of, _UNTYPED)))
def q_csv_inferred_schema(spark, sf):
    """The types found in a CSV file of orders."""
    return I.inferred_types(S.read_csv_strings(spark, _untyped_csv(spark, sf))).drop("position")


_SQL_LINES = """SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'bad' WHEN o_orderkey % 17 = 0 THEN 'bad' ELSE 'good' END AS kind,
  concat(o_orderkey, ',', CASE WHEN o_orderkey % 13 = 0 THEN 'x' ELSE '' END, o_custkey, CASE WHEN o_orderkey % 17 = 0 THEN ',1' ELSE '' END) AS text FROM orders"""


@query("csv_bad_rows", _SQL_LINES)
def q_csv_bad_rows(spark, sf):
    """Lines with a value of the wrong type or one value too many are set
    apart, the others are read."""
    path, view = scratch_path(spark, "lines"), f"lakeops_v_{uuid.uuid4().hex[:8]}"
    S.read_table(spark, sf, "orders").createOrReplaceTempView(view)
    spark.sql(_SQL_LINES.replace("FROM orders", f"FROM {view}")).select("text").write.text(path)
    spark.catalog.dropTempView(view)
    good, bad = I.read_csv_apart(spark, path, "k long, c long", header=False)
    return good.select(F.lit("good").alias("kind"), F.concat_ws(",", "k", "c").alias("text")).union(bad.select(F.lit("bad"), "text"))


@query("create_insert_drop", "SELECT c_name AS name, CAST(c_nationkey AS INTEGER) AS value FROM customer")
def q_create_insert_drop(spark, sf):
    """K7: create a typed table, insert from a query, read it back, drop it
    (the table is external, so dropping it keeps the folder just read)."""
    name = f"lakeops_t_{uuid.uuid4().hex[:8]}"
    view = f"lakeops_v_{uuid.uuid4().hex[:8]}"
    loc = scratch_path(spark, "create_insert")
    S.read_table(spark, sf, "customer").createOrReplaceTempView(view)
    W.create_table(spark, name, "name STRING, value INT", location=loc)
    spark.sql(f"INSERT INTO {name} SELECT c_name, c_nationkey FROM {view}")
    out = spark.read.parquet(loc)
    W.drop_table(spark, name)
    spark.catalog.dropTempView(view)
    return out


@query("append_table", """
SELECT * FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT * FROM orders WHERE o_orderkey % 2 <> 0""")
def q_append(spark, sf):
    o = S.read_table(spark, sf, "orders")
    path = scratch_path(spark, "append")
    W.write_parquet(o.filter(F.col("o_orderkey") % 2 == 0), path)
    W.append(o.filter(F.col("o_orderkey") % 2 != 0), path, is_path=True)
    return spark.read.parquet(path)


@query("sql_script", """
SELECT o_orderstatus, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY o_orderstatus""")
def q_sql_script(spark, sf):
    tag = uuid.uuid4().hex[:8]
    stmts = [
        f"CREATE OR REPLACE TEMPORARY VIEW lk_o_{tag} AS SELECT o_orderkey, o_orderstatus, "
        f"o_totalprice FROM parquet.`{sf.rstrip('/')}/orders.parquet`",
        "",
        f"CREATE OR REPLACE TEMPORARY VIEW lk_a_{tag} AS SELECT o_orderstatus, count(*) AS n_orders, "
        f"round(sum(o_totalprice), 2) AS total FROM lk_o_{tag} GROUP BY o_orderstatus",
        f"SELECT o_orderstatus, n_orders, total FROM lk_a_{tag}",
    ]
    return W.run_sql_script(spark, stmts)


@query("sql_script_text", """
SELECT o_orderstatus || ';' AS status, count(*) AS n_orders FROM orders GROUP BY o_orderstatus""")
def q_sql_script_text(spark, sf):
    """K9 from one text, with semicolons in a comment and in a literal."""
    view = f"lk_s_{uuid.uuid4().hex[:8]}"
    return W.run_sql_script(spark, f"""
-- the orders; all of them
CREATE OR REPLACE TEMPORARY VIEW {view} AS SELECT o_orderstatus FROM parquet.`{sf.rstrip('/')}/orders.parquet`;
/* one row; per status */
SELECT concat(o_orderstatus, ';') AS status, count(*) AS n_orders FROM {view} GROUP BY o_orderstatus;
""")


@query("ctas_sorted_properties", "SELECT c_custkey, c_name, c_nationkey, 'customers' AS kind, TRUE AS sorted FROM customer")
def q_ctas_sorted(spark, sf):
    """K8 + O3: create-table-as-select with a sort key and table properties,
    read back with a property and whether each row's file is in key order."""
    name, loc = f"lakeops_cs_{uuid.uuid4().hex[:8]}", scratch_path(spark, "ctas_sorted")
    rows = S.read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    W.overwrite_table(rows, name=name, path=loc, sort_within=["c_nationkey", "c_custkey"], properties={"kind": "customers"})
    kind = spark.sql(f"SHOW TBLPROPERTIES {name} ('kind')").first()["value"]
    W.drop_table(spark, name)
    out = spark.read.parquet(loc).withColumn("_file", F.input_file_name()).withColumn("_at", F.expr("_metadata.file_block_start")) \
        .withColumn("_pos", F.monotonically_increasing_id())
    before = F.lag(F.struct("c_nationkey", "c_custkey")).over(Window.partitionBy("_file", "_at").orderBy("_pos"))
    key = F.struct("c_nationkey", "c_custkey")
    return out.select("c_custkey", "c_name", "c_nationkey", F.lit(kind).alias("kind"), F.coalesce(before <= key, F.lit(True)).alias("sorted"))


@query("clustered_write", """
SELECT l_partkey, count(*) AS n_rows, CAST(sum(l_linenumber) AS BIGINT) AS lines, TRUE AS one_range
FROM lineitem GROUP BY l_partkey""")
def q_clustered_write(spark, sf):
    """O3: lineitem written in key order; per part its rows, and whether
    the files' key ranges overlap in their ends alone."""
    path = W.write_clustered(S.read_table(spark, sf, "lineitem"), scratch_path(spark, "clustered"), ["l_partkey"], 16)
    rows = spark.read.parquet(path).select("l_partkey", "l_linenumber", F.col("_metadata.file_path").alias("file"))
    ends = rows.groupBy("file").agg(F.min("l_partkey").alias("first"), F.max("l_partkey").alias("last"))
    before = F.lag("last").over(Window.orderBy("first", "last"))        # a row per file
    apart = ends.select(F.coalesce(before <= F.col("first"), F.lit(True)).alias("apart")).agg(F.every("apart").alias("one_range")).first()[0]
    return rows.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_linenumber").alias("lines")).withColumn("one_range", F.lit(apart))


# =============================================================== filters, scalars

@query("filter_threshold", "SELECT * FROM orders WHERE o_orderkey > 3102")
def q_filter_threshold(spark, sf):
    return S.read_table(spark, sf, "orders").filter(F.col("o_orderkey") > L.MIN_SOLUTION_ID)


_SQL_GEO = """(SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'NaN'::DOUBLE
                                      WHEN o_orderkey % 11 = 0 THEN NULL
                                      ELSE o_totalprice END AS lat FROM orders)"""


@query("filter_not_nan", f"SELECT * FROM {_SQL_GEO} g WHERE lat IS NOT NULL AND NOT isnan(lat)")
def q_not_nan(spark, sf):
    return R.geo(R.tables(spark, sf)).filter(is_not_nan("lat"))


@query("filter_non_negative", """
SELECT * FROM (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'NaN'::DOUBLE ELSE c_acctbal END AS bal
               FROM customer) b
WHERE bal >= 0 AND NOT isnan(bal)""")
def q_non_negative(spark, sf):
    return R.balances(R.tables(spark, sf)).filter(is_non_negative("bal"))


@query("date_parts", """
SELECT o_orderkey, CAST(extract(year FROM o_orderdate) AS BIGINT) AS o_orderdate_year,
       CAST(extract(month FROM o_orderdate) AS BIGINT) AS o_orderdate_month,
       CAST(extract(day FROM o_orderdate) AS BIGINT) AS o_orderdate_day
FROM orders""")
def q_date_parts(spark, sf):
    o = S.read_table(spark, sf, "orders")
    return o.select("o_orderkey", *L.date_parts("o_orderdate", "o_orderdate"))


@query("zone_stamp", "SELECT event_id, date_trunc('second', ts + INTERVAL 3 HOUR) AS ts_local FROM events")
def q_zone_stamp(spark, sf):
    e = S.read_table(spark, sf, "events")
    return e.select("event_id", zone_stamp("ts").alias("ts_local"))


@query("model_key", """
SELECT DISTINCT o_orderstatus AS measure, o_orderpriority AS service,
       concat_ws('_', o_orderstatus, o_orderpriority, 'GBTRegressor') AS model_key
FROM orders""")
def q_model_key(spark, sf):
    o = S.read_table(spark, sf, "orders")
    g = o.select(F.col("o_orderstatus").alias("measure"), F.col("o_orderpriority").alias("service")).distinct()
    return g.withColumn("model_key", model_key("measure", "service", model_name="GBTRegressor"))


@query("example_row", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY o_orderkey) AS rn
  FROM orders) x WHERE rn = 1""")
def q_example_row(spark, sf):
    """First row (by key) of each group, by partial aggregation of a struct."""
    o = S.read_table(spark, sf, "orders")
    payload = [c for c in o.columns if c not in ("o_orderstatus", "o_orderpriority")]
    best = o.groupBy("o_orderstatus", "o_orderpriority").agg(F.min(F.struct(*payload)).alias("_r"))
    return best.select(*[F.col(f"_r.{c}").alias(c) for c in payload], "o_orderstatus",
                       "o_orderpriority").select(*o.columns)


@query("row_mean", """
SELECT l_orderkey, l_linenumber, ((l_quantity + l_discount) + l_tax) / 3 AS pred_mean FROM lineitem""")
def q_row_mean(spark, sf):
    li = S.read_table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     row_mean("l_quantity", "l_discount", "l_tax").alias("pred_mean"))


@query("strip_prefixes", """
SELECT o_orderkey, o_custkey, o_orderstatus AS remainder__o_orderstatus, o_totalprice,
       o_orderdate, o_orderpriority FROM orders""")
def q_strip(spark, sf):
    o = S.read_table(spark, sf, "orders")
    named = o.select(F.col("o_orderkey").alias("num__o_orderkey"),
                     F.col("o_custkey").alias("reminder__o_custkey"),
                     F.col("o_orderstatus").alias("remainder__o_orderstatus"),
                     F.col("o_totalprice").alias("num__o_totalprice"),
                     "o_orderdate", "o_orderpriority")
    return strip_prefixes(named)


# =============================================================== leg-cost wide join

def _sql_star(min_ts_id: int = L.MIN_SOLUTION_ID) -> str:
    return f"""(SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity,
       l.l_extendedprice, l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus,
       ts.o_orderkey AS ts_id, ts.o_custkey AS ts_custkey, ts.o_orderstatus AS ts_orderstatus,
       ts.o_totalprice AS ts_totalprice, ts.o_orderpriority AS ts_orderpriority,
       CAST(extract(year FROM ts.o_orderdate) AS BIGINT) AS ts_date_start_year,
       CAST(extract(month FROM ts.o_orderdate) AS BIGINT) AS ts_date_start_month,
       CAST(extract(day FROM ts.o_orderdate) AS BIGINT) AS ts_date_start_day,
       CAST(extract(year FROM l.l_shipdate) AS BIGINT) AS ts_date_finish_year,
       CAST(extract(month FROM l.l_shipdate) AS BIGINT) AS ts_date_finish_month,
       CAST(extract(day FROM l.l_shipdate) AS BIGINT) AS ts_date_finish_day,
       sup.s_name AS sup_name, sup.s_acctbal AS sup_acctbal,
       pr1.n_name AS pr_code_dep, pr1.n_regionkey AS pr_region_dep,
       cus.c_name AS cus_name, cus.c_acctbal AS cus_acctbal, cus.c_mktsegment AS cus_mktsegment,
       pr2.n_name AS pr_code_dest, pr2.n_regionkey AS pr_region_dest,
       pt.p_brand AS pt_brand, pt.p_type AS pt_type, pt.p_size AS pt_size,
       pt.p_retailprice AS pt_retailprice,
       l.l_extendedprice * (1 - l.l_discount) AS ce_cost
FROM lineitem l
JOIN orders ts ON l.l_orderkey = ts.o_orderkey
JOIN supplier sup ON l.l_suppkey = sup.s_suppkey
JOIN nation pr1 ON sup.s_nationkey = pr1.n_nationkey
JOIN customer cus ON ts.o_custkey = cus.c_custkey
JOIN nation pr2 ON cus.c_nationkey = pr2.n_nationkey
JOIN part pt ON l.l_partkey = pt.p_partkey
WHERE ts.o_orderkey > {min_ts_id}
  AND sup.s_acctbal IS NOT NULL AND NOT isnan(sup.s_acctbal)
  AND cus.c_acctbal IS NOT NULL AND NOT isnan(cus.c_acctbal))"""


def _sql_cargo(default: bool) -> str:
    ef = "(SELECT p_partkey AS ef_id, p_size AS ef_rt_id, p_brand AS ef_code_fk_gng_freights FROM {} p)".format(
        _sql_moved("part", "p_partkey", "p_partkey % 2 <> 0"))
    dpf = "(SELECT s_suppkey * 3 AS dpf_rt_id_fk_etsng_freights FROM supplier)"
    if default:
        return f"""(SELECT l.l_quantity AS cgt_weight, l.l_linenumber AS cgt_fk_cont_type,
       l.l_linenumber AS cgt_quantity_cont, l.l_tax AS cgt_quantity_wag,
       l.l_orderkey AS cgt_fk_transport_solution,
       coalesce(ef.ef_code_fk_gng_freights, '') AS ef_code_fk_gng_freights,
       CASE WHEN coalesce(dpf.dpf_rt_id_fk_etsng_freights, 0) = coalesce(ef.ef_rt_id, 0) THEN 1 ELSE 0 END AS cargo_guarded
FROM lineitem l LEFT JOIN {ef} ef ON l.l_partkey = ef.ef_id
LEFT JOIN {dpf} dpf ON dpf.dpf_rt_id_fk_etsng_freights = coalesce(ef.ef_rt_id, 0))"""
    return f"""(SELECT l.l_quantity AS cgt_weight, l.l_linenumber AS cgt_fk_cont_type,
       l.l_linenumber AS cgt_quantity_cont, l.l_tax AS cgt_quantity_wag,
       l.l_orderkey AS cgt_fk_transport_solution, ef.ef_code_fk_gng_freights,
       CASE WHEN dpf.dpf_rt_id_fk_etsng_freights = ef.ef_rt_id THEN 1 ELSE 0 END AS cargo_guarded
FROM lineitem l LEFT JOIN {ef} ef ON l.l_partkey = ef.ef_id
LEFT JOIN {dpf} dpf ON dpf.dpf_rt_id_fk_etsng_freights = ef.ef_rt_id)"""


@query("legs_costs_wide_join", f"SELECT * FROM {_sql_star()} s")
def q_wide(spark, sf):
    return R.legs_star(R.tables(spark, sf))


@query("role_playing_dimension", f"""
SELECT pr_code_dep, pr_code_dest, count(*) AS n_legs, round(sum(ce_cost), 4) AS cost
FROM {_sql_star()} s GROUP BY pr_code_dep, pr_code_dest""")
def q_role_playing(spark, sf):
    s = R.legs_star(R.tables(spark, sf))
    g = s.groupBy("pr_code_dep", "pr_code_dest").agg(F.count(F.lit(1)).alias("n_legs"),
                                                     F.sum("ce_cost").alias("cost"))
    return rounded(g, ["cost"], 4)


@query("cargo_guarded_flag", f"SELECT * FROM {_sql_cargo(False)} c")
def q_cargo(spark, sf):
    return R.cargo(R.tables(spark, sf), "null")


@query("cargo_guarded_flag_default", f"SELECT * FROM {_sql_cargo(True)} c")
def q_cargo_default(spark, sf):
    return R.cargo(R.tables(spark, sf), "default")


def _sql_result(default: bool = False) -> str:
    zero = {"ef_code_fk_gng_freights": "''"}
    cargo = ", ".join(f"coalesce(c.{x}, {zero.get(x, 0)}) AS {x}" if default else f"c.{x}" for x in L.CARGO_RESULT_COLS)
    return f"""SELECT s.*, {cargo}
FROM {_sql_star()} s LEFT JOIN {_sql_cargo(default)} c ON s.ts_id = c.cgt_fk_transport_solution
WHERE s.ce_cost >= 0 AND NOT isnan(s.ce_cost)"""


@query("legs_costs_result", _sql_result())
def q_result(spark, sf):
    t = R.tables(spark, sf)
    return L.legs_costs_result(R.legs_star(t), R.cargo(t, "null"))


@query("legs_costs_result_default", _sql_result(default=True))
def q_result_default(spark, sf):
    """The result table under the column store's fill: unmatched cargo columns
    hold 0 or the empty string."""
    t = R.tables(spark, sf)
    return L.legs_costs_result(R.legs_star(t), R.cargo(t, "default"), null_fill="default")


@query("ctas_legs_costs_result", _sql_result())
def q_ctas(spark, sf):
    """K3 + O3: create-table-as-select after drop; no sort key (``order by tuple()``).

    The rows of a leg lie together, one for each cargo: ORC's runs, of three
    equal values on, hold their columns in half of what Parquet needs."""
    t = R.tables(spark, sf)
    res = L.legs_costs_result(R.legs_star(t), R.cargo(t, "null"))
    name = f"lakeops_lcr_{uuid.uuid4().hex[:8]}"
    loc = scratch_path(spark, "legs_costs_result")
    W.drop_table(spark, name)
    W.overwrite_table_in_parts(res, name, loc, "ts_id", 4, fmt="orc", compression="zstd")
    out = spark.read.schema(res.schema).orc(loc)
    W.drop_table(spark, name)
    return out


# =============================================================== profiling

_PROFILE_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                 "o_orderpriority", "k1", "n0"]


def _sql_profile() -> str:
    parts = []
    for c in _PROFILE_COLS:
        expr = {"k1": "1", "n0": "NULL::DOUBLE"}.get(c, c)
        clean = f"CASE WHEN isnan({expr}) THEN NULL ELSE {expr} END" if c in ("o_totalprice", "n0") else expr
        parts.append(f"SELECT '{c}' AS column_name, count(DISTINCT {clean}) AS n_distinct, "
                     f"count(*) FILTER (WHERE {clean} IS NULL) AS n_null FROM orders")
    return "\nUNION ALL ".join(parts)


@query("distinct_measures", "SELECT DISTINCT o_orderstatus AS measure FROM orders")
def q_distinct(spark, sf):
    return P.distinct_values(S.read_table(spark, sf, "orders"), "o_orderstatus", "measure")


@query("column_profile", _sql_profile())
def q_profile(spark, sf):
    return P.column_profile(R.profile(R.tables(spark, sf)))


@query("drop_constant_columns", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       NULL::DOUBLE AS n0 FROM orders""")
def q_drop_const(spark, sf):
    return P.drop_constant_columns(R.profile(R.tables(spark, sf)))


_CAT = ["o_custkey", "o_orderstatus", "o_orderpriority"]


@query("columns_by_type", """
SELECT column_name, role FROM (
  SELECT column_name,
         CASE WHEN column_name IN ('o_custkey', 'o_orderstatus', 'o_orderpriority')
                   OR column_type = 'BOOLEAN' THEN 'categorical'
              WHEN column_name = 'o_totalprice' THEN 'target'
              WHEN column_name IN ('o_orderkey') THEN NULL
              WHEN column_type = 'VARCHAR' THEN NULL
              ELSE 'numeric' END AS role
  FROM (DESCRIBE orders)) d WHERE role IS NOT NULL""")
def q_columns_by_type(spark, sf):
    o = S.read_table(spark, sf, "orders")
    roles = P.columns_by_type(o, _CAT, "o_totalprice", exclude=["o_orderkey"])
    return P.roles_frame(spark, roles)


@query("schema_check", """
SELECT column_name, role FROM (
  SELECT column_name,
         CASE WHEN column_name IN ('o_orderstatus', 'o_orderpriority') THEN 'categorical'
              WHEN column_name IN ('o_orderdate') THEN 'numeric'
              WHEN column_name = 'o_totalprice' THEN 'target'
              ELSE 'extra' END AS role
  FROM (DESCRIBE orders)) d
UNION ALL SELECT * FROM (VALUES ('o_shipmode', 'missing'), ('o_discount', 'missing')) v(column_name, role)""")
def q_schema_check(spark, sf):
    o = S.read_table(spark, sf, "orders")
    roles = P.schema_check(o, ["o_orderstatus", "o_orderpriority", "o_shipmode"],
                           ["o_orderdate", "o_discount"], "o_totalprice")
    return P.roles_frame(spark, roles)


# =============================================================== group reports

_SQL_SCORED_BASE = """(SELECT o_orderkey AS ts_id, o_orderstatus AS measure, o_orderpriority AS service,
        CAST(floor(o_totalprice / 100000) AS DOUBLE) AS y, o_totalprice / 100000 AS x FROM orders)"""


@query("services_value_counts", """
SELECT o_orderstatus AS measure, o_orderpriority AS service, count(*) AS service_counts
FROM orders GROUP BY o_orderstatus, o_orderpriority""")
def q_services(spark, sf):
    s = R.scored_base(R.tables(spark, sf))
    return P.value_counts(s, ["measure"], "service", "service_counts")


_SQL_BALANCE = f"""
WITH c AS (SELECT measure, service, y, count(*) AS counts FROM {_SQL_SCORED_BASE} s
           GROUP BY measure, service, y)
SELECT measure, service, y, counts,
       counts / sum(counts) OVER (PARTITION BY measure, service) AS percent_counts FROM c"""


@query("target_balance", _SQL_BALANCE)
def q_balance(spark, sf):
    s = R.scored_base(R.tables(spark, sf))
    return P.target_balance(s, ["measure", "service"], "y")


@query("partitioned_report", _SQL_BALANCE)
def q_partitioned(spark, sf):
    """K6: the balance report written as one CSV folder per (measure, service)
    in one job, read back."""
    s = R.scored_base(R.tables(spark, sf))
    rep = P.target_balance(s, ["measure", "service"], "y")
    path = W.write_partitioned(rep, scratch_path(spark, "balance_report"), ["measure", "service"])
    schema = "y double, counts long, percent_counts double, measure string, service string"
    back = spark.read.option("header", True).option("basePath", path).schema(schema).csv(path)
    return back.select("measure", "service", "y", "counts", "percent_counts")
