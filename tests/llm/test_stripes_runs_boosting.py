"""Source divergences, periodic runs and boosted trees against plain re-statements, and their edge cases."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import boosting, classifier, runs, stripes
from tallyloom.llm.queries import QUERIES, with_period

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, value string, row string, label string"
LONG = "one two, three four; five " * 60000
ODD = [
    (1, None, None, "s", "x", "y", "z"), (2, "", "en", "s", "x", "y", "z"), (None, " \n\t", "en", None, None, None, None), (4, "é", "fr", "s", "x", "y", "z"),
    (5, LONG, "en", "s", "x", "y", "z"), (6, "12 34 $$", "en", "s", "x", "y", "z"), (6, "12 34 $$", "en", "s", "x", "y", "z"), (7, "漢字🙂 \u0000 ok", None, "s", "x", "y", "z"),
    *[(k, "Same Same words, é É " * (k % 5), "en", f"s{k % 4}", "x", "y", "z") for k in range(10, 60)],
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_divergences(rows, least=10, top=10):
    counts, documents, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        group = (lang or "", source or "")
        groups.add(group)
        counts[group].update(words)
        documents[group[0]].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in documents[lang].items() if n >= least]
        sources = sorted(g[1] for g in groups if g[0] == lang)
        of = {s: {t: counts[lang, s][t] for t in kept} for s in sources}
        of[None] = {t: sum(of[s][t] for s in sources) for t in kept}
        p = {s: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept} for s, c in of.items()}

        def f(a, b, t):
            return (p[a][t] - p[b][t]) ** 2 // (p[a][t] + p[b][t])

        for s in sources:
            pairs = [(sum(f(s, o, t) for t in kept), o) for o in sources if o != s]
            terms = [(f(s, None, t), t) for t in kept if of[s][t] and p[s][t] > p[None][t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out.append((lang, s, part, item, value, rank))
    return sorted(out)


def test_divergences(docs, odd, empty):
    for frame in (docs, odd):
        want = plain_divergences([(r.text, r.lang, r.source) for r in frame.collect()])
        assert sorted(tuple(r) for r in stripes.source_divergences(frame).collect()) == want
        # early emits, and tiles of a few sources each
        small = stripes.source_divergences(frame.repartition(5), most_cells=300, tile_cells=60)
        assert sorted(tuple(r) for r in small.collect()) == want
    assert stripes.source_divergences(empty).collect() == []
    found = stripes.source_divergences(odd, least_documents=10**6)
    assert {r.value for r in found.collect()} == {0} and {r.part for r in found.collect()} == {"pair"}


def test_shares_are_exact():
    pick = random.Random(3)
    totals = [1, 2, 3, 999, 10**9 + 7, 10**15 + 3, *[pick.randrange(1, 10**15) for _ in range(500)]]
    counts = [pick.randrange(0, t + 1) for t in totals]
    got = stripes.share(np.array(counts, np.int64), np.array(totals, np.int64))
    assert got.tolist() == [1 + 10**9 * c // t for c, t in zip(counts, totals)]


def test_pieces_cut_no_term():
    body = ("ab,é cde fghi " * 50).encode()
    assert b" ".join(stripes.pieces(body, 7)).split() == next(stripes.pieces(body)).split()
    assert list(stripes.pieces(b"")) == [b""] and b"".join(stripes.pieces(b"a" * 30, 7)) == b"a" * 30


def plain_runs(words):
    found = {}
    n = len(words)
    for q in range(1, n // 2 + 1):
        k = 0
        while k + q < n:
            start = k
            while k + q < n and words[k] == words[k + q]:
                k += 1
            if k + q - start >= 2 * q:
                found.setdefault((start, k + q), q)
            k += 1
    return sorted((s, e, q) for (s, e), q in found.items())


def test_runs_of_random_sequences():
    pick = random.Random(1)
    for _ in range(1500):
        n, letters = pick.randint(0, 70), pick.choice([1, 2, 2, 3, 5])
        words = [pick.randrange(letters) for _ in range(n)]
        if n and pick.random() < 0.5:
            at = pick.randrange(n)
            p = pick.randint(1, n - at)
            words = [words[at + (k - at) % p] if k >= at else words[k] for k in range(n)]
        assert sorted(runs.find_runs(words)) == plain_runs(words)


def test_runs_of_long_sequences():
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    assert sorted(runs.find_runs(b)) == plain_runs(b)
    assert runs.find_runs([3] * 50000) == [(0, 50000, 1)]


def plain_collapse(words, found):
    gone = {k for s, e, q in found for k in range(s + q, e)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def test_periodic_runs(docs, odd, empty):
    for frame in (docs, odd.filter("doc_id IS NULL OR doc_id <> 5")):
        for r in runs.periodic_runs(frame).collect():
            words = re.findall(r"[^\x20\x09-\x0D]+", r.row.text or "")
            want = [x for x in plain_runs(words) if x[1] - x[0] >= 12]
            assert [(x.start, x.start + x.length, x.period) for x in r.runs] == sorted(want, key=lambda x: (x[0], x[2]))
            assert r.n_words == len(words) and r.collapsed == plain_collapse(words, want)
    long = runs.periodic_runs(odd.filter("doc_id = 5")).first()
    assert [tuple(x) for x in long.runs] == [(0, 300000, 5)] and long.collapsed == "one two, three four; five"
    assert runs.periodic_runs(empty).count() == 0 and runs.periodic_runs(odd).count() == odd.count()


def test_stretches_lose_no_run():
    pick = random.Random(2)
    texts = [[pick.randrange(30) for _ in range(pick.randrange(80))] + [x for x in range(4)] * pick.randrange(6) + [pick.randrange(30) for _ in range(9)] for _ in range(200)]
    bodies = [" ".join(map(str, t)).encode() for t in texts]
    got = runs.measure(bodies, 12)[1].to_pylist()
    for words, found in zip(texts, got):
        assert sorted((r["start"], r["start"] + r["length"], r["period"]) for r in found) == [x for x in plain_runs(words) if x[1] - x[0] >= 12]


def test_made_periods(odd):
    for r in odd.select("doc_id", "text", with_period(F.col("text"), F.col("doc_id")).alias("made")).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        h, n = zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            assert r.made == " ".join(words[k] if k < a else words[a + (k - a) % p] for k in range(n))
        else:
            assert r.made == r.text


def walk(forest, row):
    total = forest.start
    for features, limits, values in zip(forest.features, forest.limits, forest.values):
        node = 0
        while node < len(features):
            node = 2 * node + (1 if row[features[node]] <= limits[node] else 2)
        total += values[node - len(features)]
    return total


def test_forest_is_walked_as_grown():
    random_ = np.random.default_rng(4)
    rows = np.column_stack([random_.normal(size=600), random_.integers(0, 3, 600), np.zeros(600)])
    labels = ((rows[:, 0] > 0.3) ^ (rows[:, 1] == 1)).astype(int)
    forest = boosting.train(rows[:400], labels[:400], np.ones(400), boosting.Growth(trees=40, depth=3))
    assert np.allclose(forest.margins(rows, block=7), [walk(forest, r) for r in rows])
    assert ((forest.probabilities(rows[400:]) >= 0.5) == labels[400:]).mean() > 0.95
    strange = forest.probabilities(np.array([[np.inf, -np.inf, 1e300]]))
    assert 0 <= strange[0] <= 1


def test_forest_of_little():
    none = boosting.train(np.zeros((0, 3)), np.zeros(0), np.zeros(0))
    assert none.probabilities(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    one = boosting.train(np.zeros((4, 3)), np.ones(4), np.ones(4))
    assert (one.probabilities(np.zeros((2, 3))) > 0.99).all()
    two = boosting.train(np.arange(2.0)[:, None], np.array([0, 1]), np.ones(2), boosting.Growth(least_curvature=0.0))
    assert two.probabilities(np.array([[0.0], [1.0]])).round().tolist() == [0, 1]


def test_classifier_on_rows_kept_apart(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op13_quality_classifier"](spark, folder).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    apart = [(got[k].predicted, v) for k, v in labels.items() if got[k].held_out]
    assert all(got[k].held_out == (zlib.crc32(str(k).encode()) % 3 == 1) for k in got) and len(apart) > 50
    for label in (0, 1):
        assert np.mean([p == v for p, v in apart if v == label]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_classifier_on_odd_rows(spark, docs, odd, empty):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    strange = spark.createDataFrame([(None, 1), (1, None), (2, 7), (3, 0), (3, 0), (3, 1)], "doc_id bigint, quality int")
    forest = classifier.fit_classifier(docs.unionByName(docs.limit(20)), labels.select("doc_id", "quality").unionByName(strange), F.lit(True))
    scored = classifier.score_quality(odd, forest).collect()
    assert len(scored) == odd.count() and all(0 <= r.score <= 1 for r in scored) and scored[0].row.asDict().keys() == set(odd.columns)
    assert len({r.score for r in scored if r.row.doc_id == 6}) == 1
    again = classifier.fit_classifier(docs.unionByName(docs.limit(20)).repartition(3), labels.select("doc_id", "quality").unionByName(strange), F.lit(True))
    assert np.array_equal(forest.values, again.values)
    assert classifier.score_quality(empty, forest).count() == 0
    bare = classifier.fit_classifier(empty, labels, F.lit(True))
    assert {r.score for r in classifier.score_quality(odd, bare).collect()} == {0.5}
    nothing = classifier.fit_classifier(docs, labels, F.lit(False))
    assert {r.predicted for r in classifier.score_quality(odd, nothing).collect()} == {1}


def test_junk_in_part_scores_low(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    forest = classifier.fit_classifier(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), labels, F.lit(True))
    clean = max((r.text for r in docs.filter("lang = 'en'").join(labels.filter("quality = 1"), "doc_id").collect()), key=len)
    words = clean.split()
    junk = " ".join(words[:100] + [w + "###" for w in words[100:400]])
    frame = spark.createDataFrame([(clean,), (junk,)], "text string")
    high, low = (r.score for r in classifier.score_quality(frame, forest).collect())
    assert high > 0.5 > low
