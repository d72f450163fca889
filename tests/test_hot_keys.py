"""Ordered and time-based operators on data where one key holds most rows,
against plain Python on the same rows."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.plans import ordering, timejoin

BASE = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    n = 3000
    frame = pd.DataFrame({
        "id": np.arange(n),
        "k": np.where(rng.random(n) < 0.6, 0, rng.integers(1, 9, n)),
        "ts": [BASE + timedelta(seconds=int(s)) for s in rng.integers(0, 200_000, n)],
        "v": np.round(np.where(rng.random(n) < 0.4, 7.0, rng.random(n) * 100), 2),
    })
    df = spark.createDataFrame(frame.astype({"id": "int64", "k": "int64"})).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return frame, df


def test_row_numbers_with_a_hot_value(rows):
    frame, df = rows
    got = ordering.row_numbers(df, "v", "id", out="rn", with_total="n", cells=8).toPandas().sort_values("id")
    want = frame.sort_values(["v", "id"]).assign(rn=range(1, len(frame) + 1)).sort_values("id")
    assert got["rn"].tolist() == want["rn"].tolist()
    assert set(got["n"]) == {len(frame)}


def test_row_numbers_per_key(rows):
    frame, df = rows
    got = ordering.row_numbers(df, "v", "id", ["k"], cells=8).toPandas().sort_values("id")
    want = frame.sort_values(["v", "id"]).assign(rn=lambda f: f.groupby("k").cumcount() + 1).sort_values("id")
    assert got["rn"].tolist() == want["rn"].tolist()


def test_exact_quantiles(rows):
    frame, df = rows
    got = ordering.exact_quantiles(df, "v", {"a": 0.0, "b": 0.33, "c": 0.5, "d": 1.0}, ["k"]).toPandas().set_index("k").sort_index()
    want = frame.groupby("k")["v"].quantile([0.0, 0.33, 0.5, 1.0]).unstack()
    assert np.allclose(got[["a", "b", "c", "d"]].to_numpy(), want.to_numpy())


def test_ranks(rows):
    frame, df = rows
    got = ordering.ranks(df, "v", cells=8).toPandas().sort_values("id")
    want = frame.sort_values("id")["v"]
    assert got["rank"].tolist() == want.rank(method="min").astype(int).tolist()
    assert got["dense_rank"].tolist() == want.rank(method="dense").astype(int).tolist()


def test_average_ranks(rows):
    frame, df = rows
    got = ordering.average_ranks(df, "v", {}).toPandas().set_index("v")["avg_rank"]
    want = frame["v"].rank().groupby(frame["v"]).first()
    assert np.allclose(got.sort_index(), want.sort_index())


def test_ntile(spark):
    df = spark.range(1, 24).select(ordering.ntile(F.col("id"), F.lit(23), 5).alias("t"))
    sizes = df.groupBy("t").count().orderBy("t").collect()
    assert [r["count"] for r in sizes] == [5, 5, 5, 4, 4]


def test_surrogate_keys(rows, spark):
    _, df = rows
    names = df.select(F.concat(F.lit("n"), "id").alias("name"))
    got = ordering.surrogate_keys(names.union(names), "name", "key").toPandas().sort_values("key")
    assert got["key"].tolist() == list(range(1, 3001))
    assert got["name"].tolist() == sorted(got["name"])


def test_point_in_time_never_sees_later_rows(rows):
    frame, df = rows
    feats = df.filter("id % 3 = 0").select("k", "ts", F.col("id").alias("fid"), "v", (F.col("ts") + F.expr("interval 10 minutes")).alias("made"))
    got = timejoin.point_in_time_join(
        df.select("id", "k", F.col("ts").alias("at")), feats, ["k"], "at", "ts", ["fid"], created="made", tie="fid",
        ttl_seconds=20_000, slice_seconds=5_000,
    ).toPandas().set_index("id")["fid"]
    f = frame[frame["id"] % 3 == 0]
    for r in frame.itertuples():
        c = f[(f["k"] == r.k) & (f["ts"] + timedelta(minutes=10) <= r.ts)]
        want = None
        if len(c):
            best = c.sort_values(["ts", "id"]).iloc[-1]
            want = best["id"] if (r.ts - best["ts"]).total_seconds() <= 20_000 else None
        have = got[r.id]
        assert (pd.isna(have) and want is None) or have == want


def test_null_keys_do_not_match(spark):
    left = spark.sql("SELECT 1 AS id, CAST(NULL AS BIGINT) AS k, timestamp_ntz'2024-01-02' AS at")
    right = spark.sql("SELECT CAST(NULL AS BIGINT) AS k, timestamp_ntz'2024-01-01' AS ts, 5 AS v")
    got = timejoin.point_in_time_join(left, right, ["k"], "at", "ts", ["v"]).collect()
    assert [tuple(r) for r in got] == [(None, 1, datetime(2024, 1, 2), None)]


def test_interval_join_with_mixed_lengths(rows, spark):
    frame, df = rows
    rng = np.random.default_rng(6)
    spans = pd.DataFrame({
        "k": rng.integers(0, 9, 400), "iid": np.arange(400),
        "s": [BASE + timedelta(seconds=int(x)) for x in rng.integers(0, 200_000, 400)],
        "len": rng.choice([1, 60, 3600, 50_000], 400), "lag": rng.integers(-3000, 3000, 400),
    })
    spans["e"] = spans["s"] + pd.to_timedelta(spans["len"], unit="s")
    spans["u"] = spans["s"] + pd.to_timedelta(spans["lag"], unit="s")
    right = spark.createDataFrame(spans[["k", "iid", "s", "e", "u"]].astype({"k": "int64", "iid": "int64"}))
    for c in ("s", "e", "u"):
        right = right.withColumn(c, F.col(c).cast("timestamp_ntz"))
    got = timejoin.interval_latest_join(
        df.select("id", "k", "ts"), right, ["k"], ["id"], "ts", "s", "e", "u", "iid", ["iid"]).toPandas()
    assert len(got) == len(frame)
    found = got.set_index("id")["iid"]
    for r in frame.itertuples():
        c = spans[(spans["k"] == r.k) & (spans["s"] <= r.ts) & (r.ts < spans["e"]) & (spans["u"] <= r.ts)]
        want = None if c.empty else c.sort_values(["u", "iid"], ascending=[False, True]).iloc[0]["iid"]
        have = found[r.id]
        assert (pd.isna(have) and want is None) or have == want


def test_nearest_join(rows):
    frame, df = rows
    got = timejoin.nearest_join(
        df.select("id", "k", "ts"), df.select("k", F.col("ts").alias("t2"), F.col("id").alias("rid")), ["k"], "ts", "t2", "rid",
        ["rid"], offset_seconds=3600, tolerance_seconds=90,
    ).toPandas().set_index("id")["rid"]
    for r in frame.itertuples():
        c = frame[frame["k"] == r.k].assign(d=lambda f: (f["ts"] - r.ts).dt.total_seconds() - 3600)
        c = c[c["d"].abs() <= 90].assign(a=lambda f: f["d"].abs()).sort_values(["a", "ts", "id"])
        have = got[r.id]
        assert (pd.isna(have) and c.empty) or have == c.iloc[0]["id"]


def test_trailing_window(rows):
    frame, df = rows
    got = timejoin.trailing_window(df, ["k"], "ts", 600, lambda f: {"n": F.count("*").over(f(600)), "m": F.max("v").over(f(60))})
    got = got.toPandas().set_index("id")
    assert len(got) == len(frame)
    for r in frame.sample(300, random_state=1).itertuples():
        same = frame[(frame["k"] == r.k) & (frame["ts"] <= r.ts)]
        assert got.loc[r.id, "n"] == (same["ts"] >= r.ts - timedelta(seconds=600)).sum()
        assert got.loc[r.id, "m"] == same[same["ts"] >= r.ts - timedelta(seconds=60)]["v"].max()


def test_sessions(rows):
    frame, df = rows
    got = timejoin.sessions(df, ["k"], "ts", 120, slice_seconds=1000).toPandas()
    want = []
    for k, g in frame.sort_values("ts").groupby("k"):
        island = (g["ts"].diff() > timedelta(seconds=120)).cumsum()
        for _, s in g.groupby(island):
            want.append((k, s["ts"].min(), s["ts"].max(), len(s)))
    have = sorted(zip(got["k"], got["session_start"], got["session_end"], got["n"]))
    assert have == sorted(want)


def test_interpolation(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, timestamp_ntz'2024-01-01 00:00:00', 10.0D), (1, timestamp_ntz'2024-01-02 06:00:00', NULL),
        (1, timestamp_ntz'2024-01-03 12:00:00', 40.0D), (1, timestamp_ntz'2024-01-09', NULL) AS t(k, ts, v)""")
    got = timejoin.interpolate(df, ["k"], "ts", "v", "x").orderBy("ts").collect()
    assert [r["x"] for r in got] == [10.0, 25.0, 40.0, None]
