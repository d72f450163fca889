"""Answers worked out by hand."""

import math

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import documents, text, times, vectors
from tallyloom.operators import clustering, evaluation, features, models


def row(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


@pytest.fixture(scope="module")
def outcomes(spark):
    data = [
        ("High", "No", "Success"), ("High", "No", "Success"), ("High", "Yes", "Success"), ("High", "Yes", "Success"),
        ("High", "Yes", "Failure"), ("Low", "Yes", "Success"), ("Low", "Yes", "Failure"), ("Low", "Yes", "Failure"),
    ]
    return spark.createDataFrame(data, "a string, b string, outcome string")


def test_root_impurity(outcomes):
    root = outcomes.withColumn("root", F.lit("all"))
    found = row(models.impurity_table(root, ["root"], "outcome"))
    assert found["gini"] == pytest.approx(0.46875)
    assert found["entropy"] == pytest.approx(0.9544, abs=1e-4)


def test_weighted_impurity(outcomes):
    found = {r["feature"]: r for r in models.impurity_table(outcomes, ["a", "b"], "outcome").collect()}
    assert found["a"]["weighted_gini"] == pytest.approx(5 / 8 * 0.32 + 3 / 8 * 4 / 9)
    assert found["b"]["weighted_gini"] == pytest.approx(6 / 8 * 0.5)


def test_distances(spark):
    pair = spark.createDataFrame([([1.0, 1.0], [4.0, 5.0])], "p array<double>, q array<double>")
    p, q = F.col("p"), F.col("q")
    assert tuple(row(pair.select(vectors.l1(p, q), vectors.l2(p, q), vectors.linf(p, q)))) == (7.0, 5.0, 4.0)


def test_scaled_distances(spark):
    people = spark.createDataFrame([(1, 20.0, 50000.0), (2, 23.0, 60000.0), (3, 50.0, 200000.0)], "i int, age double, pay double")
    scaled = {
        r["i"]: (r["age"], r["pay"]) for r in people.select(
            "i", features.scale(people, people, "age", "minmax").alias("age"), features.scale(people, people, "pay", "minmax").alias("pay")
        ).collect()
    }
    assert math.dist(scaled[1], scaled[2]) == pytest.approx(0.120, abs=5e-4)
    assert math.dist(scaled[1], scaled[3]) == pytest.approx(1.41, abs=5e-3)


@pytest.fixture(scope="module")
def four(spark):
    return spark.createDataFrame(
        [(1, [1.0, 1.0], 0), (2, [2.0, 1.0], 0), (3, [4.0, 3.0], 1), (4, [5.0, 4.0], 1)], "i bigint, v array<double>, k bigint")


def test_kmeans_step(four, spark):
    centers = spark.createDataFrame([(0, [1.5, 1.0]), (1, [4.5, 3.5])], "c int, center array<double>")
    placed = clustering.assign_to_centers(four, "v", centers, "c", "center")
    assert [r["c"] for r in placed.orderBy("i").collect()] == [0, 0, 1, 1]
    assert row(placed.agg(F.sum("squared_distance")))[0] == pytest.approx(1.5)
    means = {r["k"]: r["center"] for r in clustering.cluster_means(four, "v", "k").collect()}
    assert means == {0: [1.5, 1.0], 1: [4.5, 3.5]}


def test_silhouette(four):
    found = {r["i"]: r["silhouette"] for r in clustering.silhouette_euclidean(four, "i", "v", "k", block_rows=2).collect()}
    assert [found[i] for i in (1, 2, 3, 4)] == pytest.approx([0.768, 0.7172, 0.560, 0.694], abs=1e-3)


def test_title_case(spark):
    rows = spark.createDataFrame([(" NORTH-EASTERN ",), ("ang mo kio",), ("o'neil école",)], "n string")
    assert [r[0] for r in rows.select(text.title_case(F.col("n"))).collect()] == ["North-Eastern", "Ang Mo Kio", "O'Neil École"]


def test_moments(spark):
    rows = spark.createDataFrame(
        [("2024-01-01T00:00:00Z",), ("2024-01-01T08:00:00+08:00",), ("2024-01-01T08:00:00",), ("not a time",)], "t string")
    moment = times.parse_moment(F.col("t"))
    assert [r[0] for r in rows.select(times.local_text(moment)).collect()] == ["2024-01-01T08:00:00+08:00"] * 3 + [None]
    assert row(rows.limit(1).select(times.wall_clock(F.col("t")).cast("string")))[0] == "2024-01-01 00:00:00"


def test_band_is_closed_on_the_right(spark):
    rows = spark.createDataFrame([(0.0,), (0.3,), (0.31,), (1.0,)], "v double")
    found = rows.select(evaluation.band(F.col("v"), [0.0, 0.3, 1.0], ["a", "b"])).collect()
    assert [r[0] for r in found] == [None, "a", "b", "b"]


def test_canonical_json(spark):
    rows = spark.createDataFrame([('{"b": [1, {"z": null, "a": true}], "a": "x"}',), ("{oops",)], "j string")
    assert [r[0] for r in rows.select(documents.canonical_json(F.col("j"))).collect()] == ['{"a":"x","b":[1,{"a":true,"z":null}]}', None]


def test_zero_division_counts_as_zero(spark):
    rows = spark.createDataFrame([("a", "b"), ("a", "b")], "y string, p string")
    found = {r["class"]: (r["precision"], r["recall"], r["f1"]) for r in evaluation.classification_report(rows, "y", "p").collect()}
    assert found == {"a": (0.0, 0.0, 0.0), "b": (0.0, 0.0, 0.0)}


def test_error_categories(spark):
    rows = spark.createDataFrame(
        [("Low", "Medium"), ("Medium", "Low"), ("Medium", "High"), ("High", "Medium"), ("High", "High")], "t string, p string")
    got = rows.select(evaluation.error_category(F.col("t"), F.col("p"), "Low", ["Low", "Medium", "High"])).collect()
    assert [r[0] for r in got] == ["Low -> Medium (FN)", "Medium -> Low (FP)", "Medium -> High (FP)", "High -> Medium (FN)", "Correct"]
