"""Rows with null keys, null order values and repeated or late records stay."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import features as ft
from tallyloom.operators.aggregates import describe, histogram
from tallyloom.operators.cleaning import outlier_counts
from tallyloom.operators.ingest import load_increment
from tallyloom.operators.evaluation import overall_metrics, roc_auc
from tallyloom.operators.joins import dense_grid, map_of_last
from tallyloom.operators.neighbours import knn_join
from tallyloom.operators.spatial import dissolve
from tallyloom.plans import timejoin
from tallyloom.plans.ordering import CELL, ranks, row_numbers, running_sums, with_cells


def holed(spark, rows=3000):
    return spark.range(rows).select(
        "id", F.when(F.col("id") % 3 != 0, F.col("id") % 50).cast("double").alias("v"),
        F.when(F.col("id") % 5 != 0, F.concat(F.lit("k"), (F.col("id") % 4).cast("string"))).alias("k"))


def test_row_numbers_keep_nulls(spark):
    got = row_numbers(holed(spark), "v", "id", ["k"], with_total="n", cells=16).toPandas()
    assert len(got) == 3000
    for _, group in got.groupby("k", dropna=False):
        group = group.sort_values(["v", "id"], na_position="last")
        assert group.rn.tolist() == list(range(1, len(group) + 1)) and (group.n == len(group)).all()


def test_many_cells(spark):
    got = row_numbers(spark.range(6000).select("id", (F.col("id") % 3000).cast("double").alias("v")), "v", "id", cells=3000).toPandas()
    assert got.sort_values(["v", "id"]).rn.tolist() == list(range(1, 6001))


def test_null_cell_is_cut(spark):
    sizes = with_cells(holed(spark), "v", "id", cells=16).groupBy(CELL).count().agg(F.max("count")).first()[0]
    assert sizes < 500


def test_ranks_and_sums_keep_nulls(spark):
    got = ranks(holed(spark), "v", cells=8).toPandas()
    assert len(got) == 3000 and got[got.v.isna()]["rank"].unique().tolist() == [2001]
    assert got.dense_rank.max() == 51
    unique = holed(spark).groupBy("k", "v").agg(F.count("*").alias("n"))
    assert running_sums(unique, "v", {"upto": "n"}, ["k"]).filter("k IS NULL").agg(F.max("upto")).first()[0] == 600


def test_features_keep_null_categories(spark):
    df = holed(spark).withColumn("fold", (F.col("id") % 5).cast("int")).withColumn("y", (F.col("id") % 2).cast("double"))
    assert ft.class_weights(df, "k").count() == 3000
    assert ft.target_encode(df, "k", "y", "fold", 10.0, "e").count() == 3000


def test_group_statistics_keep_null_group(spark):
    got = describe(holed(spark), "v", ["k"], 6).filter("k IS NULL").first()
    assert got is not None and got["median"] is not None
    assert outlier_counts(holed(spark), ["k"], "v", 3.0).filter("k IS NULL").first()["rows"] == 600


def test_histogram_counts_all_values(spark):
    got = histogram(spark.createDataFrame([(-1.0,), (0.0,), (10.0,), (11.0,), (None,)], "v double"), "v", 0.0, 10.0, 5)
    assert {r["bin"]: r["n"] for r in got.collect()} == {-1: 1, 0: 1, 4: 1, 5: 1}


def test_late_tie_is_loaded(spark, tmp_path):
    at = datetime(2024, 1, 1)
    first = spark.createDataFrame([(1, at)], "id int, ts timestamp_ntz")
    second = spark.createDataFrame([(1, at), (2, at)], "id int, ts timestamp_ntz")
    third = spark.createDataFrame([(1, at), (2, at), (3, at)], "id int, ts timestamp_ntz")
    target = str(tmp_path / "t")
    assert [load_increment(x, "ts", target) for x in (first, second, second, third)] == [1, 1, 0, 1]
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == [1, 2, 3]


def test_repeated_station_keeps_last(spark):
    entries = spark.createDataFrame([([("a", 1), (None, 2), ("a", 3)],)], "e array<struct<k: string, v: int>>")
    got = entries.select(map_of_last(F.col("e"))).first()[0]
    assert got == {"a": 3}
    odd = spark.createDataFrame([([None, ("b", None), ("", 1)],), ([],), (None,)], "e array<struct<k: string, v: int>>")
    assert [r[0] for r in odd.select(map_of_last(F.col("e"))).collect()] == [{"b": None, "": 1}, {}, None]


def test_long_lookup_document(spark):
    """A map of 30,000 entries, every key three times: work in the square of the entries would not end."""
    entries = F.transform(F.sequence(F.lit(0), F.lit(29_999)), lambda i: F.struct((i % 10_000).alias("k"), i.alias("v")))
    got = spark.range(1).select(map_of_last(entries)).first()[0]
    assert got == {k: k + 20_000 for k in range(10_000)}


def test_dissolve_on_many_partitions(spark):
    polygons = spark.range(0, 8, 1, 4).selectExpr(
        "concat('a', id) AS area", "0 AS part", "array(array(0.0)) AS rings", "0.0 AS min_lon", "1.0 AS max_lon", "0.0 AS min_lat", "1.0 AS max_lat")
    parents = spark.range(8).selectExpr("concat('a', id) AS area", "'p' AS parent")
    assert dissolve(polygons, parents).select("part").distinct().count() == 8


@pytest.mark.parametrize("lengths", [(60,), (60, 5000)])
def test_interval_join_keeps_equal_rows(spark, lengths):
    at = F.timestamp_seconds(F.lit(1_000_000)).cast("timestamp_ntz")
    left = spark.range(4).select(F.lit(7).alias("id"), F.when(F.col("id") != 3, 1).alias("k"), at.alias("at"))
    spans = spark.createDataFrame([(1, n, s) for n, s in enumerate(lengths)], "k int, n int, s int")
    start = F.timestamp_seconds(F.lit(999_990)).cast("timestamp_ntz")
    spans = spans.select("k", "n", start.alias("start"), (start + F.make_dt_interval(secs=F.col("s"))).alias("end"))
    got = timejoin.interval_latest_join(left, spans, ["k"], ["id"], "at", "start", "end", "start", "n", ["n"]).collect()
    assert sorted((r["k"] or 0, r["id"], r["n"]) for r in got) == [(0, 7, None), (1, 7, 0), (1, 7, 0), (1, 7, 0)]


def test_frame_longer_than_look_back(spark):
    rows = spark.range(3).select(F.lit(1).alias("k"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"))
    with pytest.raises(ValueError, match="look-back"):
        timejoin.trailing_window(rows, ["k"], "ts", 600, lambda frame: {"n": F.count("*").over(frame(3600))})


def test_neighbours_skip_incomplete_vectors(spark):
    frame = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [None, 1.0]), (5, [5.0, 0.0])], "id long, v array<double>")
    got = knn_join(frame, frame, "id", "id", "v", 1, exclude_self=True, pivots=2).collect()
    assert sorted((r["id"], r["neighbour"]) for r in got) == [(1, 2), (2, 1), (5, 2)]


def test_dense_grid(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, None), (None, "a")], "t int, area string")
    got = dense_grid(rows, "t", "area", rows.groupBy("t", "area").agg(F.count("*").alias("n")), {"n": 0}).collect()
    assert sorted(tuple(r) for r in got) == [(1, "a", 1), (1, "b", 0), (2, "a", 0), (2, "b", 1)]


def test_grouped_metrics(spark):
    rows = spark.range(600).select(
        (F.col("id") % 3).alias("g"), (F.col("id") % 7 > 2).cast("double").alias("y"), (F.col("id") % 5 > 1).cast("double").alias("p"), (F.col("id") % 11).cast("double").alias("s"))
    areas = {r["g"]: r["auc"] for r in roc_auc(rows, "s", "y", ["g"]).collect()}
    rates = {r["g"]: r["macro_f1"] for r in overall_metrics(rows, "y", "p", ["g"]).collect()}
    for g in range(3):
        part = rows.filter(F.col("g") == g)
        assert areas[g] == pytest.approx(roc_auc(part, "s", "y").first()["auc"])
        assert rates[g] == pytest.approx(overall_metrics(part, "y", "p").first()["macro_f1"])


def test_rolling_origin_takes_every_period(spark):
    from tallyloom.operators import models

    rows = [(0, 1.0), (0, 3.0), (2, 5.0), (7, 6.0), (7, None), (None, 9.0), (-3, 2.0)]
    df = spark.createDataFrame(rows, "period bigint, value double")
    got = {r["fold"]: (r["train_rows"], r["test_rows"], r["mae"]) for r in models.rolling_origin_mean(df, "period", "value").collect()}
    assert got == {0: (1, 2, 1.0), 2: (3, 1, 3.0), 7: (4, 1, 3.25)}
    assert {r["fold"] for r in models.rolling_origin_mean(df, "period", "value", [2]).collect()} == {2}
    assert models.rolling_origin_mean(df.limit(0), "period", "value").count() == 0


@pytest.mark.parametrize("days", [[], [(2024, 2, 29)], [(2023, 12, 30), (2024, 1, 30), (2024, 3, 5)]])
def test_backfill_covers_the_whole_table(spark, tmp_path, days):
    from tallyloom.queries import QUERIES

    rows = [(datetime(*d, h), u) for d in days for h in (0, 13, 23) for u in (1, 2)]
    spark.createDataFrame(rows, "ts timestamp_ntz, user_id bigint").write.parquet(str(tmp_path / "events.parquet"))
    got = {(r["day"], r["user_id"]): r["n"] for r in QUERIES["i15_backfill"](spark, str(tmp_path)).collect()}
    want = {}
    for ts, u in rows:
        want[ts.day, u] = want.get((ts.day, u), 0) + 1
    assert got == want
