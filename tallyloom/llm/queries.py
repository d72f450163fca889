"""Registered queries of the text operators, each with the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import bpe, chat, classifier, decontaminate, language, licences, ngram_join, quality, rollup, runs, scoring, sharding, stripes
from tallyloom.llm.common import WORDS, fold_of
from tallyloom.plans.scratch import materialised, run_dir
from tallyloom.session import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def query(name: str, sql: str | None = None):
    def wrap(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


@query("op1_quality_rules")
def op1(t: Tables) -> DataFrame:
    """Features and verdict of every document."""
    return quality.quality_features(t.documents, keep=["doc_id"]).select("row.doc_id", *quality.FEATURES.names)


@query("op4_bpe_round_trip")
def op4(t: Tables) -> DataFrame:
    """Every document encoded and decoded again."""
    return bpe.encode_documents(t.documents, RANKS, public_tokenizers.PATTERN, keep=["doc_id"]).select("row.doc_id", *bpe.ENCODED.names)


@query("op8_decontamination", sql=r"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w,
           row_number() OVER () AS k
    FROM documents
), item AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), win AS (
    SELECT item_id, least(10, len(w)) AS size, unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2), lambda p: array_to_string(w[p:p + least(10, len(w)) - 1], ' '))) AS words
    FROM item WHERE len(w) > 0
), sizes AS (SELECT DISTINCT size FROM win),
spot AS (SELECT k, size, unnest(range(1, len(w) - size + 2)) AS p, w FROM doc, sizes WHERE len(w) >= size),
match AS (
    SELECT s.k, s.p, s.size, x.item_id
    FROM (SELECT k, p, size, array_to_string(w[p:p + size - 1], ' ') AS words FROM spot) s JOIN win x USING (size, words)
), hit AS (
    SELECT k, count(DISTINCT q) AS n_hit FROM (SELECT k, unnest(range(p, p + size)) AS q FROM match) GROUP BY k
), found AS (
    SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS item FROM match WHERE item_id IS NOT NULL) GROUP BY k
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (k) LEFT JOIN found USING (k)
""")
def op8(t: Tables) -> DataFrame:
    """Hit words and found items of every document."""
    found = decontaminate.find_benchmark(t.documents, t.benchmark, keep=["doc_id"])
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s.end - s.start)
    return found.select(
        "row.doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )


@query("op5_language_id")
def op5(t: Tables) -> DataFrame:
    """Language of every document, learned without the fold of remainder 2."""
    docs = t.documents
    held_out = fold_of(F.col("doc_id"), 4) == 2
    guessed = language.identify(docs, language.fit_languages(docs, ~held_out), keep=["doc_id"])
    return guessed.select("row.doc_id", (fold_of(F.col("row.doc_id"), 4) == 2).alias("held_out"), *language.GUESS.names)


@query("op7_ngram_jaccard_join")
def op7(t: Tables) -> DataFrame:
    """Class and number of links of every document."""
    found = ngram_join.jaccard_classes(t.documents.select("doc_id", "text"), keep=["doc_id"])
    return found.select("row.doc_id", "class_id", "n_links")


@query("op10_license_scan")
def op10(t: Tables) -> DataFrame:
    """Base phrases and licence labels of every document."""
    scanned = licences.scan_licences(t.documents, keep=["doc_id"])
    base = F.filter("places", lambda p: p.base)
    starts = F.transform(base, lambda p: p.start)
    return scanned.select(
        "row.doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        licences.label_list(base).alias("base_labels"), licences.label_list(F.col("places")).alias("labels"), "score",
    )


@query("op9_lm_scoring")
def op9(t: Tables) -> DataFrame:
    """Context-tree and unigram scores of every document, learned without the fold of remainder 2."""
    docs = t.documents
    scored = scoring.score_documents(docs, fold_of(docs["doc_id"], 7) != 2, keep=["doc_id"])
    return scored.select("row.doc_id", (fold_of(F.col("row.doc_id"), 7) == 2).alias("held_out"), *scoring.SCORES.names)


@query("op2_chat_snapshots", sql=r"""
WITH t AS (
    SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place FROM conversations
), c AS (
    SELECT conv_id, list({'r': role, 't': text} ORDER BY place) AS turns, count(*) AS n FROM t GROUP BY conv_id
), one AS (
    SELECT min(conv_id) AS conv_id, turns, n FROM c GROUP BY turns, n
), kept AS (
    SELECT conv_id, n FROM one a
    WHERE NOT EXISTS (SELECT 1 FROM one b WHERE b.turns[1] = a.turns[1] AND b.n > a.n AND b.turns[1:a.n] = a.turns)
)
SELECT k.conv_id, CAST((place - 1) // 256 AS BIGINT) AS page, CAST(k.n AS BIGINT) AS n_turns,
       string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || chr(10) || '<|end|>' || chr(10), '' ORDER BY place) AS rendered
FROM kept k JOIN t ON t.conv_id IS NOT DISTINCT FROM k.conv_id GROUP BY k.conv_id, (place - 1) // 256, k.n
""")
def op2(t: Tables) -> DataFrame:
    """All maximal conversations, rendered."""
    return chat.render_chats(t.conversations)


#: Tokenizer versions of the rollup query: white-space words, then words of lower-case terms.
_VERSIONS = {"space-1": r"[^\x20\x09-\x0D]+", "term-2": r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"}


@query("op3_token_rollup", sql=r"""
WITH d AS (
    SELECT source, lang, crc32 AS k, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS a,
           len(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS b
    FROM (SELECT *, ((coalesce(doc_id, 0) % 10) + 10) % 10 AS crc32 FROM documents)
), e AS (
    SELECT source, lang, 'space-1' AS tokenizer, a AS n FROM d WHERE k IN (0, 1, 2, 3, 4, 5)
    UNION ALL SELECT source, lang, 'term-2', b FROM d WHERE k IN (6, 7)
)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens FROM e GROUP BY source, lang, tokenizer
""")
def op3(t: Tables) -> DataFrame:
    """All documents arrive; ids ending in 8 and 9 are deleted, those in 6 and 7 counted anew by the second tokenizer; batches come twice."""
    docs = t.documents
    space, term = (rollup.count_tokens(docs["text"], p) for p in _VERSIONS.values())
    last = F.pmod(F.coalesce(docs["doc_id"], F.lit(0)), F.lit(10))
    # each row gets a number of its own, kept in a table, so that changes of equal rows stay apart and a repeated delivery does not
    counted = materialised(docs.select(
        F.monotonically_increasing_id().alias("row"), "source", "lang", last.alias("last"), space.alias("space"), F.when(last.isin(6, 7), term).alias("term")), "token-counts")

    def change(name: str, version: str, before: Column | None, after: Column | None, rows: Column) -> DataFrame:
        none = F.lit(None).cast("long")
        return counted.filter(rows).select(
            F.concat_ws(":", F.lit(name), F.col("row").cast("string")).alias("change_id"), "source", "lang", F.lit(version).alias("tokenizer"),
            (none if before is None else before).alias("before"), (none if after is None else after).alias("after"))

    space, term, last = F.col("space"), F.col("term"), F.col("last")
    insert = change("insert", "space-1", None, space, F.lit(True))
    gone = change("delete", "space-1", space, None, last.isin(8, 9))
    recount = change("drop", "space-1", space, None, last.isin(6, 7)).unionByName(change("recount", "term-2", None, term, last.isin(6, 7)))
    store = rollup.Rollup(t.spark, run_dir(t.spark, "rollup"))
    store.commit("inserts", insert)
    for _ in range(2):
        store.commit("deletes", gone)
        store.commit("recounts", recount.unionByName(recount))
    return store.totals()


_SHARDS = [f"shard-{k:02d}" for k in range(64)]


@query("op6_shard_table")
def op6(t: Tables) -> DataFrame:
    """Slot and shard of every document."""
    return sharding.place_rows(t.documents, "doc_id", _SHARDS, keep=["doc_id"]).select("row.doc_id", "slot", "shard")


#: The table as filled here; tests hold it against a plain re-statement of the rule.
ORACLES["op6_shard_table"] = f"""
WITH slots AS (SELECT unnest(range(8191)) AS slot, unnest([{','.join(map(str, sharding.fill_table(_SHARDS, 8191)))}]) AS k)
SELECT doc_id, CAST(d.slot AS INTEGER) AS slot, 'shard-' || lpad(CAST(k AS VARCHAR), 2, '0') AS shard
FROM (SELECT doc_id, ('0x' || md5(coalesce(CAST(doc_id AS VARCHAR), ''))[1:15])::BIGINT % 8191 AS slot FROM documents) d JOIN slots USING (slot)
"""


@query("op11_source_divergence", sql=r"""
WITH d AS (
    SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS k,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), t AS (SELECT lang, source, k, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS c FROM t GROUP BY lang, term HAVING count(DISTINCT k) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
cells AS (SELECT lang, source, term, count(*) AS c FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (SELECT lang, source, coalesce(sum(c), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN cells USING (lang, source) GROUP BY lang, source),
p AS (
    SELECT g.lang, g.source, k.term, coalesce(cells.c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(cells.c, 0) + 2)) // (g.n + 2 * v) AS p,
           1 + (1000000000::HUGEINT * (k.c + 2)) // (langs.n + 2 * v) AS q
    FROM groups g JOIN langs USING (lang) JOIN kept k USING (lang) LEFT JOIN cells ON cells.lang = g.lang AND cells.source = g.source AND cells.term = k.term
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
        SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value FROM p x JOIN p y USING (lang, term) GROUP BY x.lang, x.source, y.source
    ) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), ranked AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM ranked) WHERE part = 'pair' OR rank <= 10
""")
def op11(t: Tables) -> DataFrame:
    """Divergence of every source from each other source of its language, and its leading terms."""
    return stripes.source_divergences(t.documents)


def with_period(text: Column, key: Column) -> Column:
    """The text, or for a tenth of the keys its words up to a place and from there on the same words over and over."""
    hashed = F.crc32(F.coalesce(key.cast("string"), F.lit("")))
    g = F.floor(hashed / 10)
    words = F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))
    parts = F.transform(F.array(words), lambda w: F.struct(w.alias("w"), (g % F.size(w)).alias("a")))
    parts = F.transform(parts, lambda s: F.struct(s.w.alias("w"), s.a.alias("a"), (1 + F.floor((F.size(s.w) - s.a) / (3 + g % 8))).alias("p")))
    made = F.transform(parts, lambda s: F.array_join(F.transform(s.w, lambda w, i: F.when(i < s.a, w).otherwise(F.get(s.w, (s.a + (i - s.a) % s.p).cast("int")))), " "))
    return F.when((hashed % 10 == 0) & text.rlike(WORDS), made[0]).otherwise(text)


@query("op12_periodic_runs", sql=r"""
WITH t AS (
    SELECT list_transform(range(256), lambda n: list_reduce([n::BIGINT] || repeat([0::BIGINT], 8), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS crc
), h AS (
    SELECT doc_id, row_number() OVER () AS k, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(range(1, length(coalesce(CAST(doc_id AS VARCHAR), '')) + 1), lambda i: ascii(CAST(doc_id AS VARCHAR)[i])::BIGINT),
               lambda c, b: xor(c // 256, crc[xor(c, b) % 256 + 1]))) AS h
    FROM documents, t
), a AS (SELECT *, len(w) AS n, h // 10 AS g FROM h),
d AS (
    SELECT doc_id, k, n, CASE WHEN h % 10 = 0 AND n > 0 THEN
        list_transform(range(n), lambda i: CASE WHEN i < g % n THEN w[i + 1] ELSE w[g % n + (i - g % n) % (1 + (n - g % n) // (3 + g % 8)) + 1] END) ELSE w END AS w
    FROM a
), word AS (SELECT k, unnest(range(n)) AS i, unnest(w) AS word FROM d),
same AS (SELECT x.k, y.i - x.i AS q, x.i AS i FROM word x JOIN word y ON x.k = y.k AND x.word = y.word AND x.i < y.i),
stretch AS (SELECT k, q, min(i) AS s, max(i) + 1 + q AS e FROM (SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS island FROM same) GROUP BY k, q, island),
runs AS (SELECT k, s, e - s AS length, min(q) AS q FROM stretch WHERE e - s >= greatest(12, 2 * q) GROUP BY k, s, e),
told AS (
    SELECT k, count(*) AS n_runs, max({'length': length, 'start': -s, 'period': -q}) AS best, string_agg(s || ',' || length || ',' || q || chr(10), '' ORDER BY s, q) AS lines
    FROM runs GROUP BY k
), gone AS (SELECT k, list(DISTINCT i) AS gone FROM (SELECT k, unnest(range(s + q, s + length)) AS i FROM runs) GROUP BY k)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, -best.start AS start, best.length AS length, -best.period AS period, 1000 * best.length // -best.period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ') ELSE
           coalesce((SELECT string_agg(word, ' ' ORDER BY i) FROM word WHERE word.k = d.k AND NOT list_contains(gone, i)), '') END) AS collapsed_sha256
FROM d LEFT JOIN told USING (k) LEFT JOIN gone USING (k)
""")
def op12(t: Tables) -> DataFrame:
    """Runs of every document, after the words of a tenth of them have been made periodic."""
    docs = t.documents.select("doc_id", with_period(F.col("text"), F.col("doc_id")).alias("text"))
    found = runs.periodic_runs(docs, keep=["doc_id"])
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in runs.RUN.names]), F.lit("\n"))), "")
    told = found.select("row.doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed")
    return told.select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), "best.length", (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query("op13_quality_classifier")
def op13(t: Tables) -> DataFrame:
    """Quality score of every document, learned without the fold of remainder 1."""
    labels = t.labels
    forest = classifier.fit_classifier(t.documents, labels, fold_of(labels["doc_id"], 3) != 1)
    scored = classifier.score_quality(t.documents, forest, keep=["doc_id"])
    return scored.select("row.doc_id", (fold_of(F.col("row.doc_id"), 3) == 1).alias("held_out"), *classifier.SCORE.names)
