"""Orders ETL (C1-C3): load orders, load items, customer summary.

Column names are parameters; defaults are the original job's names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.operators import batches, keyed
from lakeops.session import scratch_path


@dataclass(frozen=True)
class OrderCols:
    order_id: str = "order_id"
    customer_id: str = "customer_id"
    order_date: str = "order_date"
    amount: str = "total_amount"
    customer_key: str = "customer_id"      # key column in the customers table
    customer_name: str = "customer_name"


def customer_summary(orders: DataFrame, customers: DataFrame,
                     cols: OrderCols = OrderCols()) -> DataFrame:
    """Per customer: name, order count, spend (as double), last order date.

    Orders whose customer is unknown keep a NULL name; a NULL customer id
    forms its own group.  Orders are aggregated *before* the join: with a
    keyed customers table this equals join-then-group, and a customer with
    a large share of all orders is reduced by map-side partial aggregation
    instead of landing on one join task.
    """
    agg = (orders.groupBy(F.col(cols.customer_id).alias("customer_id"))
           .agg(F.count(cols.order_id).alias("total_orders"),
                F.sum(cols.amount).cast("double").alias("total_spent"),
                F.max(cols.order_date).alias("last_order_date")))
    c = customers.select(F.col(cols.customer_key).alias("_ck"),
                         F.col(cols.customer_name).alias("customer_name"))
    j = agg.join(c, agg["customer_id"] == c["_ck"], "left")
    return j.select("customer_id", "customer_name", "total_orders", "total_spent",
                    "last_order_date")


def priced_items(batch_items: DataFrame, orders: DataFrame, products: DataFrame, *, order_id: str = "order_id",
                 product_id: str = "product_id", price: str = "price", items_order_id: str | None = None,
                 items_product_id: str | None = None) -> DataFrame:
    """Items of known orders with their unit price."""
    return keyed.items_with_unit_price(batch_items, orders, products, order_key=order_id, product_key=product_id,
                                       price_col=price, items_order_key=items_order_id, items_product_key=items_product_id)


def load_orders(batch: DataFrame, customers: DataFrame, stored: DataFrame,
                cols: OrderCols = OrderCols(), dedupe: str = "none") -> DataFrame:
    """C1 as a plan: batch orders of known customers, new keys only."""
    known = keyed.semi_join(batch, customers, cols.customer_id, cols.customer_key)
    return keyed.new_key_rows(known, stored, cols.order_id, dedupe)


def load_items(batch_items: DataFrame, orders: DataFrame, products: DataFrame,
               stored_items: DataFrame, *, item_id: str = "order_item_id",
               dedupe: str = "none", order_id: str = "order_id", product_id: str = "product_id",
               price: str = "price", items_order_id: str | None = None,
               items_product_id: str | None = None) -> DataFrame:
    """C2 as a plan: items of known orders with unit price, new keys only
    (names as in :func:`priced_items`).

    Stored keys are left out before the price comes in, so only new items move
    to their product; where the key is the order id, both tests share one
    shuffle of the items.  Repeats are looked for in the priced items.
    """
    names = {"product_key": product_id, "price_col": price, "items_product_key": items_product_id}
    items_order = items_order_id or order_id
    known = keyed.semi_join(batch_items, orders, items_order, order_id)
    if dedupe == "error":                           # stored keys count, too
        keyed.dedupe_batch(keyed.with_unit_price(known, products, **names), item_id, dedupe)
        dedupe = "none"
    # the semi join has left no NULL order id
    new = keyed.anti_join(known, stored_items, item_id, null_safe=item_id != items_order)
    return keyed.dedupe_batch(keyed.with_unit_price(new, products, **names), item_id, dedupe)


def run_orders_etl(spark, orders_csv: str, items_csv: str, *, orders_path: str,
                   items_path: str, customers: DataFrame, products: DataFrame,
                   summary_path: str, orders_schema, items_schema,
                   cols: OrderCols = OrderCols(), dedupe: str = "error", batch_id: str | None = None) -> dict:
    """The daily job: append new orders, append new items, replace the summary.

    With a ``batch_id`` the two tables are kept by batch
    (:mod:`lakeops.operators.batches`), so a run that died can be run again
    under the same id and adds nothing twice; without one they are plain folders.

    Returns the three reports.  The summary is computed once; its table is
    written to a new folder beside the old one (staged replace) whose path is
    returned as ``summary_path``, and the old one can go once readers have
    switched.
    """
    from lakeops.sources.files import read_csv

    new_orders = read_csv(spark, orders_csv, orders_schema)
    known = keyed.semi_join(new_orders, customers, cols.customer_id, cols.customer_key)
    def add(rows: DataFrame, path: str, key: str) -> tuple[dict[str, int], DataFrame]:
        if batch_id is None:
            return keyed.append_new_keys(rows, path, key, dedupe=dedupe), spark.read.parquet(path)
        return (batches.append_new_keys_once(rows, path, key, batch_id, dedupe),
                batches.committed_rows(spark, path, rows.schema))

    r_orders, orders = add(known, orders_path, cols.order_id)
    new_items = read_csv(spark, items_csv, items_schema)
    priced = priced_items(new_items, orders, products, order_id=cols.order_id)
    r_items, _ = add(priced, items_path, "order_item_id")

    staged = scratch_path(spark, "summary")
    customer_summary(orders, customers, cols).write.parquet(staged)
    summary = spark.read.parquet(staged)
    stored = spark.read.parquet(summary_path)
    rep = keyed.upsert_report(stored, summary, "customer_id").first().asDict()
    new_path = keyed.replace_by_key_path(summary_path, summary, "customer_id")
    return {"orders": r_orders, "items": r_items, "summary": rep, "summary_path": new_path}
