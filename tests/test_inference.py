"""Types found in CSV values, and rows that do not parse."""

import pytest

from lakeops.sources import inference as I
from lakeops.sources.files import read_csv


@pytest.mark.parametrize("values, kind", [
    (["1", "-2", None, "+3", "007"], "bigint"), (["1", "99999999999999999999"], "double"), (["1", "2.5", ".5", "3.", "1e-3"], "double"),
    (["NaN", "-Infinity"], "double"), (["1", "x"], "string"), (["1d"], "string"), (["2024-02-29"], "date"), (["2023-02-29"], "string"),
    (["2024-02-29", "2024-01-01 10:00:00"], "timestamp_ntz"), (["2024-01-01T10:00:00.123456"], "timestamp_ntz"), (["2024-01-01 25:00:00"], "string"),
    (["true", "FALSE", "False"], "boolean"), (["true", "1"], "string"), (["2024-01-01", "5"], "string"), ([None, None], "string"), ([], "string"),
    ([" 1"], "string"), ([""], "string"),
])
def test_type_of_values(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], "`a.b` string")
    assert [tuple(r) for r in I.inferred_types(df).collect()] == [(0, "a.b", kind)]
    assert I.cast_inferred(df).dtypes == [("a.b", kind)]


def test_inference_reads_all_rows(spark, tmp_path):
    """One odd value among many, in the last file."""
    spark.range(20_000).selectExpr("id AS k", "IF(id = 19999, 'x', '1') AS v").repartition(4).write.option("header", True).csv(f"{tmp_path}/c")
    assert I.read_csv_inferred(spark, f"{tmp_path}/c").dtypes == [("k", "bigint"), ("v", "string")]


def test_bad_rows_are_set_apart(spark, tmp_path):
    lines = ["k,x,d", "1,2.5,2024-01-01", "x,2.5,2024-01-01", "2,,", "3,1.0", "4,1.0,2024-13-01", "5,1.0,2024-01-01,9", ""]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    (tmp_path / "b.csv").write_text("k,x,d\n7,7.0,2024-07-07\n")
    schema = "k int, x double, d date"
    good, bad = I.read_csv_apart(spark, str(tmp_path), schema)
    assert sorted(r.k for r in good.select("k").collect()) == [1, 2, 7]         # one column read: the same rows are good
    assert good.count() + bad.count() == 7
    assert {r.text for r in bad.collect()} == {lines[2], lines[4], lines[5], lines[6]}
    assert all(r.file.endswith("a.csv") for r in bad.collect())
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path), schema).collect()
