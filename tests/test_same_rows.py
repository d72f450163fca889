"""Two tables compared row by row."""

from tallyloom.sources import files

SCHEMA = "k bigint, x double, s string"


def test_counts_of_odd_rows(spark):
    """Nulls and NaN equal themselves, both zeros are one, and every copy counts."""
    nan = float("nan")
    a = spark.createDataFrame([(1, 0.0, "a"), (1, 0.0, "a"), (2, nan, None), (None, None, None), (3, 1.0, "c")], SCHEMA)
    b = spark.createDataFrame([(1, -0.0, "a"), (2, nan, None), (None, None, None), (None, None, None), (4, 1.0, "c")], SCHEMA)
    assert files.same_rows(a, b.select("s", "k", "x")).first().asDict() == {"left_rows": 5, "right_rows": 5, "left_only": 2, "right_only": 2}
    assert files.same_rows(a, a).first().asDict() == {"left_rows": 5, "right_rows": 5, "left_only": 0, "right_only": 0}


def test_no_task_holds_the_rows_of_a_scan(spark, tmp_path):
    """Rows are dealt before they are grouped, once."""
    spark.range(1000).selectExpr("id AS k", "id / 7 AS x", "string(id) AS s").write.parquet(str(tmp_path / "a"))
    a = spark.read.parquet(str(tmp_path / "a"))
    compared = files.same_rows(a, a)
    compared.collect()
    lines = compared._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].splitlines()
    dealt = next(n for n, line in enumerate(lines) if "hashpartitioning(__h" in line)
    assert not any("Aggregate" in line for line in lines[dealt:]) and sum("hashpartitioning" in line for line in lines) == 1
