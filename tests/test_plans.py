"""Plan-shape tests: the properties that matter at scale, read from explain()."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_threshold_filter_pushed_to_scan(spark):
    p = plan(entry.queries()["filter_threshold"](spark, SF_SMALL))
    assert "GreaterThan(o_orderkey,3102)" in p


def test_key_scan_reads_one_column(spark):
    p = plan(entry.queries()["key_scan"](spark, SF_SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint>" in p


def test_customer_summary_aggregates_before_join(spark):
    p = plan(entry.queries()["customer_summary"](spark, SF_SMALL), "simple")
    # partial aggregation of orders happens below the join with customers
    agg = p.find("partial_count")
    join = p.find("Join")
    assert agg > join > 0        # deeper in the tree = later in the text


def test_champion_row_has_no_window(spark):
    p = plan(entry.queries()["champion_row"](spark, SF_SMALL), "simple")
    assert "Window" not in p and "partial_min" in p


def test_result_filter_below_fanout_join(spark):
    p = plan(entry.queries()["legs_costs_result"](spark, SF_SMALL), "simple")
    assert "isnan" in p.lower()
    assert "Union" in p          # inner join + unmatched rows (skew-splittable form)


def test_no_python_udfs_anywhere(spark):
    for name in ("yeo_johnson_apply", "stratified_split", "metrics_by_group", "legs_costs_result"):
        p = plan(entry.queries()[name](spark, SF_SMALL), "simple")
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def below_exchanges(df, key: str) -> list[str]:
    """The part of the plan below each exchange by ``key``."""
    lines, found = plan(df, "simple").splitlines(), []
    for i, line in enumerate(lines):
        if f"Exchange hashpartitioning({key}#" in line:
            depth = line.index("Exchange")
            end = next((j for j in range(i + 1, len(lines)) if len(lines[j]) - len(lines[j].lstrip(" :+-")) <= depth), len(lines))
            found.append("\n".join(lines[i + 1:end]))
    return found


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_legs_do_not_move_by_customer(spark, no_broadcast):
    """Orders meet their customers before they meet the legs."""
    by_customer = below_exchanges(entry.queries()["legs_costs_result"](spark, SF_SMALL), "o_custkey")
    assert by_customer and not any("l_extendedprice" in p for p in by_customer)


def test_load_items_prices_new_items_alone(spark, no_broadcast):
    """One shuffle of the items by order for both key tests, then one of the new ones by product."""
    df = entry.queries()["load_items"](spark, SF_SMALL)
    assert sum("l_extendedprice" in p for p in below_exchanges(df, "l_orderkey")) == 1
    by_product = below_exchanges(df, "l_partkey")
    assert len(by_product) == 1 and "LeftAnti" in by_product[0]
