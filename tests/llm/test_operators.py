"""Each text operator against a plain re-statement, and its edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tallyloom.llm import bpe, chat, decontaminate, language, licences, ngram_join, quality, rollup, scoring, sharding
from tallyloom.llm.queries import ORACLES, QUERIES, RANKS

SMALL = "/root/testdata/sf0.001"
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, score string"
ODD = [
    (1, None, None, "s", None, "x", "y"), (2, "", "en", "s", 0, "x", "y"), (None, " \n\t", "en", None, 3, None, None), (4, "é", "fr", "s", 1, "x", "y"),
    (5, "a b c d e f " * 30000, "en", "s", 1, "x", "y"), (6, "12 34", "en", "s", 1, "x", "y"), (6, "12 34", "en", "s", 1, "x", "y"),
    (7, "漢字🙂 \u0000 ok", None, "s", 1, "x", "y"), (8, "Under the MIT License. under the mit license", "en", "s", 1, "x", "y"),
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


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    from oracle import compare, connect

    assert compare(QUERIES[name](spark, SMALL).toPandas(), connect(SMALL).execute(ORACLES[name]).df()) is None


def plain_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    hit = {k + j for k, w in enumerate(windows) if w in often for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def test_quality(docs, odd, empty):
    for frame in (docs, odd):
        for r in quality.quality_features(frame).collect():
            got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
            assert got == plain_quality(r.row.text)
            assert r.base_failed == (got[0] < 50 or 100 * got[4] > 50 * got[0]) and not (r.base_failed and r.kept)
    assert quality.keep_quality(empty).count() == 0 and quality.keep_quality(odd).columns == odd.columns


def test_bands_reject_repetition_and_noise():
    import zstandard

    z, bands = zstandard.ZstdCompressor(level=3), quality.Bands()
    noise = np.random.default_rng(1).bytes(20000)
    assert not quality.verdict(b"same words again " * 2000, bands, z)[3] and not quality.verdict(noise, bands, z)[3]


def test_learned_bands_part_low_quality_from_clean(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = [r for r in quality.quality_features(docs, keep=["doc_id"]).collect() if not r.base_failed]
    low, clean = ([r.kept for r in rows if labels.get(r.row.doc_id) == q] for q in (0, 1))
    assert sum(not k for k in low) >= 0.3 * len(low) > 0 and sum(clean) >= 0.99 * len(clean) > 0


def test_bands_of_copies_and_rare_lengths(spark):
    pick = random.Random(5)
    made = [" ".join("".join(pick.choices("abcdefghij", k=pick.randint(2, 8))) for _ in range(200)) for _ in range(80)]
    lists = [" | ".join("".join(pick.choices("ab", k=4)) for _ in range(200)) for _ in range(4)]
    copies, long = [made[0][:-1] + "x"] * 400, [" ".join(made[:12])]
    frame = spark.createDataFrame([(t,) for t in made + lists + copies + long], "text string")
    kept = {r.row.text: r.kept for r in quality.quality_features(frame).collect()}
    assert all(kept[t] for t in made + copies + long) and not any(kept[t] for t in lists)


def test_bpe(docs, odd, empty):
    ranks = bpe.read_ranks(RANKS)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for frame in (docs, odd):
        for r in bpe.encode_documents(frame, RANKS, public_tokenizers.PATTERN, with_ids=True).collect():
            want = plain.encode_ordinary(r.row.text or "")
            assert r.token_ids == want and r.n_tokens == len(want) and r.valid_utf8
            assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256((r.row.text or "").encode()).hexdigest()
    assert bpe.encode_documents(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_decoder_holds_open_characters():
    token = {k: bytes([k]) for k in range(256)}
    decoder = bpe.StreamDecoder(token)
    body = "aé漢🙂".encode()
    parts = list(decoder.decode(np.frombuffer(body, np.uint8), block=1))
    assert b"".join(p for p, _ in parts) == body and all(p.decode() is not None for p, _ in parts) and all(ok for _, ok in parts)
    assert not all(ok for _, ok in decoder.decode(np.frombuffer(body[:-1], np.uint8)))
    assert not all(ok for _, ok in decoder.decode(np.frombuffer(b"\xc0\x80", np.uint8)))


def test_language(docs, odd, empty):
    learned = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    model = language.fit_languages(docs, learned)
    got = language.identify(docs, model).filter(~F.col("row.doc_id").isNull() & (F.crc32(F.col("row.doc_id").cast("string")) % 4 == 2)).collect()
    assert sum(r.lang_pred == r.row.lang for r in got) >= 0.95 * len(got)
    odd_ones = {(r.row.doc_id, r.row.text): r for r in language.identify(odd, model).collect()}
    assert odd_ones[(1, None)].lang_pred == "und" and odd_ones[(6, "12 34")].lang_pred == "und" and 0 <= odd_ones[(4, "é")].score <= 1
    assert language.fit_languages(empty, F.lit(True)) is None and language.identify(empty, None).count() == 0
    assert {r.lang_pred for r in language.identify(odd, None).collect()} == {"und"}


@pytest.mark.parametrize("percent", [2, 5])
def test_language_with_wrong_labels_keeps_clean_documents(percent):
    pick, settings = random.Random(percent), language.Settings()
    alphabets = {"aa": "abcdefgh", "bb": "ijklmnop", "cc": "qrstuvwx", "dd": "acegikmo"}

    def made(lang):
        return " ".join("".join(pick.choices(alphabets[lang], k=5)) for _ in range(40)).encode()

    samples, names = [], sorted(alphabets)
    for k in range(1600):
        lang = names[k % 4]
        shown = pick.choice([x for x in names if x != lang]) if pick.random() < percent / 100 else lang
        samples.append((shown, *language.counts_of(made(lang), settings)))
    model = language.train(samples, settings)
    guesses = [(lang, *model.guess(made(lang))) for lang in names * 50]
    assert sum(ok for *_, ok in guesses) >= 0.97 * len(guesses) and sum(lang == got for lang, got, *_ in guesses) >= 0.97 * len(guesses)
    logits = np.zeros(4)
    assert language.softmax(logits / model.temperature).max() < model.threshold  # an undecided text is rejected


def plain_classes(texts):
    sets = []
    for text in texts:
        w = TERM.findall((text or "").encode().lower())
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    links, root = [0] * len(texts), list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = [new if x == old else x for x in root]
    return links, root


def test_ngram_join(spark, odd, empty):
    base = [f"w{k}" for k in range(120)]
    texts = [" ".join(base)] * 3 + [" ".join([*base[:k], "new", *base[k + 1:]]) for k in range(0, 120, 7)] + ["few words", "few words", "", None, "few other words"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    links, root = plain_classes(texts)
    for size in (1024, 4):  # one block, and many
        got = {r.row.doc_id: r for r in ngram_join.jaccard_classes(frame, block_docs=size).collect()}
        assert [got[k].n_links for k in range(len(texts))] == links and [got[k].class_id for k in range(len(texts))] == root
        assert sum(r.is_head for r in got.values()) == len(set(root))
    assert ngram_join.jaccard_classes(odd).count() == len(ODD) and ngram_join.one_per_class(odd).count() == len(ODD) - 1
    assert ngram_join.one_per_class(empty).count() == 0
    bands, rows = ngram_join.banding(0.8, 0.9999)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.9999


def test_decontamination(spark, odd, empty):
    items = spark.createDataFrame([(1, "a b c d e f a b c d e f"), (2, "mit license"), (3, ""), (None, "12 34"), (4, None), (5, "x y z")], "item_id bigint, text string")
    for block in (16_000_000, 10):  # one block of items, and many
        got = {r.row.text: r for r in decontaminate.find_benchmark(odd, items, block_bytes=block).collect()}
        long = got["a b c d e f " * 30000]
        assert [(h.start, h.end) for h in long.hits] == [(0, 180000)] and long.items == ["1"] and long.longest == 12
        licence = got["Under the MIT License. under the mit license"]
        assert [(h.start, h.end) for h in licence.hits] == [(2, 4), (6, 8)] and licence.items == ["2"]
        assert got["12 34"].items == [] and len(got["12 34"].hits) == 1 and not got[None].hits and not got["é"].hits
    assert decontaminate.drop_contaminated(odd, items).count() == len(ODD) - 4
    assert decontaminate.drop_contaminated(odd, items.limit(0)).count() == len(ODD) and decontaminate.drop_contaminated(empty, items).count() == 0


def plain_weighting(texts, trained, depth):
    """Context-tree weighting by its recursion."""
    counts, children = defaultdict(lambda: [0, 0]), defaultdict(set)

    def steps(text):
        s = b"\xff" * depth + text.encode().lower() + b"\xff"
        for p in range(depth, len(s)):
            context = tuple(s[p - 1 - k] for k in range(depth))
            for bit in range(8):
                yield (1 << bit) | (s[p] >> (8 - bit)), context, (s[p] >> (7 - bit)) & 1

    for text in trained:
        for node, context, way in steps(text):
            for d in range(depth + 1):
                counts[node, context[:d]][way] += 1
                if d:
                    children[node, context[:d - 1]].add(context[:d])

    def estimate(z, o):
        return math.lgamma(z + 0.5) + math.lgamma(o + 0.5) - math.lgamma(z + o + 1) - math.log(math.pi)

    known = {}

    def weighted(node, context):
        if (node, context) not in known:
            own = estimate(*counts[node, context])
            if len(context) < depth:
                own = np.logaddexp(own, sum(weighted(node, c) for c in children[node, context])) - math.log(2)
            known[node, context] = own
        return known[node, context]

    def predicted(node, context, way):
        p = 0.5
        for d in range(depth, -1, -1):
            if (node, context[:d]) in counts:
                z, o = counts[node, context[:d]]
                here = ((o if way else z) + 0.5) / (z + o + 1)
                stop = 1.0 if d == depth else math.exp(estimate(z, o) - math.log(2) - weighted(node, context[:d]))
                p = stop * here + (1 - stop) * p
        return p

    return [sum(math.log10(predicted(*s)) for s in steps(text)) for text in texts]


def test_scoring(spark, docs, odd, empty):
    rows = [r for r in docs.select("doc_id", "text").orderBy("doc_id").limit(12).collect()]
    frame = spark.createDataFrame(rows + [(900, None), (901, ""), (902, "never Seen häßlich"), (902, "never Seen häßlich")], "doc_id bigint, text string")
    texts = {r.doc_id: r.text or "" for r in frame.collect()}
    trained = [t for k, t in texts.items() if k < 8]
    want = dict(zip(texts, plain_weighting(list(texts.values()), trained, 5)))
    tokens = Counter(w for t in trained for w in [*t.encode().lower().split(), b" "])
    for block in (12_000_000, 1):
        got = scoring.score_documents(frame, F.col("doc_id") < 8, block_bytes=block).collect()
        assert len(got) == len(rows) + 4
        for r in got:
            mine = [*texts[r.row.doc_id].encode().lower().split(), b" "]
            base = sum(math.log10((tokens[w] + 1) / (sum(tokens.values()) + len(tokens) + 1)) for w in mine)
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(mine), sum(tokens[w] > 0 for w in mine), sum(tokens.values()))
            assert r.base_score == pytest.approx(base) and r.score == pytest.approx(want[r.row.doc_id], rel=1e-5)
    assert scoring.score_documents(empty, F.lit(True)).count() == 0
    none = scoring.score_documents(odd, F.lit(False)).collect()
    assert len(none) == len(ODD) and all(r.train_tokens == 0 and r.bits_per_byte == pytest.approx(8) for r in none)


def test_licences(spark, odd, empty, docs):
    notice = "x Permission is hereby granted, free of charge, to any person obtaining a copy of this software and some documentation files"
    frame = odd.unionByName(odd.limit(1).withColumn("text", F.lit(notice)).withColumn("doc_id", F.lit(50).cast("long")))
    got = {r.row.doc_id: r for r in licences.scan_licences(frame).collect()}
    assert [(p.label, p.base, p.start) for p in got[50].places] == [("mit", False, 1)] and 0.6 <= got[50].score < 1
    assert sorted(p.start for p in got[8].places) == [0, 4] and got[8].score == 1 and got[1].n_words == 0 and not got[5].places
    assert licences.scan_licences(empty).count() == 0
    for r in licences.scan_licences(docs).collect():
        words = [w.decode() for w in TERM.findall(r.row.text.encode().lower())]
        want = [(k, t.label) for t in licences.BASE for k in range(len(words)) if words[k:k + len(t.words())] == t.words()]
        assert r.n_words == len(words) and sorted((p.start, p.label) for p in r.places if p.base) == sorted(want)


def test_licence_with_words_changed_outside_its_key(spark):
    gpl = next(t for t in licences.NOTICES if t.label == "gpl")
    words = gpl.words()
    inserted = " ".join([*words[:5], "good", *words[5:]])  # the key stands one place on
    changed = " ".join(["one", "tool", "was", "gratis", "ware", *words[5:]])  # the rarest words are others
    frame = spark.createDataFrame([(k, t) for k, t in enumerate([inserted, changed, gpl.text.replace("gnu general", "general gnu")] + ["other words here"] * 40)], "doc_id bigint, text string")
    got = {r.row.doc_id: [(p.label, p.start) for p in r.places] for r in licences.scan_licences(frame, templates=(gpl,)).collect()}
    assert got[0] == [("gpl", 1)] and got[1] == [("gpl", 0)] and not any(got[k] for k in got if k > 1)


def test_short_licence_lines(spark):
    lines = {
        "This work is licensed under the GNU General Public License, version 3.": "gpl", "(c) A. All rights reserved.": "all-rights-reserved", "SPDX-License-Identifier: LGPL-2.1-only": "lgpl",
        "SPDX-License-Identifier: MPL-2.0": "mpl-2", "released under GPLv3 or later": "gpl", "SPDX-License-Identifier: MIT": "mit", "all rights are reserved, general public": "",
    }
    lines |= {f"see {key} please": t.label for t in licences.NOTICES for key in t.keys}
    lines |= {t.text: t.label for t in licences.SHORT_FORMS}
    frame = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    for r in licences.scan_licences(frame.withColumn("label", F.lit(None).cast("string"))).select("row.*", "score", "places", licences.label_list(F.col("places")).alias("labels")).collect():
        assert set(filter(None, [lines[r.text]])) <= set(r.labels.split(",")) and (r.score == 1) == bool(lines[r.text])
        assert "see" not in r.text.split() or [p.start for p in r.places] == [1]


def test_chat(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "bot", None), (2, 0, "user", "a"), (2, 1, "bot", None), (2, 2, "user", "c"), (3, 0, "user", "a"), (3, 1, "bot", ""),
            (4, 0, "user", "a"), (4, 1, "bot", None), (4, 2, "user", "c"), (None, 5, None, "z"), (7, None, "user", "n")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: r for r in chat.render_chats(turns).collect()}
    assert set(got) == {2, 3, None, 7} and got[2].n_turns == 3 and got[None].rendered == "<|unknown|>\nz\n<|end|>\n"
    pages = chat.render_chats(turns, page=2).orderBy("conv_id", "page").collect()
    assert "".join(r.rendered for r in pages if r.conv_id == 2) == got[2].rendered and chat.render_chats(turns.limit(0)).count() == 0


def chats_by_hand(rows, page):
    """Renders every conversation whose whole turn list is not a proper prefix of another's, smallest id first."""
    conversations = {}
    for conv, *turn in rows:
        conversations.setdefault(conv, []).append(turn)
    ids = {}
    for conv, turns in conversations.items():
        turns.sort(key=lambda turn: [(v is not None, v) if v is not None else (False,) for v in turn])
        ids.setdefault(tuple((role, text) for _, role, text in turns), []).append(conv)
    out = set()
    for turns, convs in ids.items():
        if not any(len(other) > len(turns) and other[:len(turns)] == turns for other in ids):
            first = min(convs, key=lambda c: (c is None, c or 0))
            for k in range(0, len(turns), page):
                out.add((first, k // page, len(turns), "".join(f"<|{role if role is not None else 'unknown'}|>\n{text or ''}\n<|end|>\n" for role, text in turns[k:k + page])))
    return out


@pytest.mark.parametrize("page", [3, 256])
def test_chat_by_hand(spark, page):
    pick = random.Random(page).choice
    rows = [(pick([None, *range(30)]), pick([None, 0, 0, 1, 2]), pick(["u", "b", None]), pick(["a", "b", "", None])) for _ in range(120)]
    rows += [(100 + k, j, "u", "abc"[j % 3]) for k in range(6) for j in range(2 * k + 1)] + [(200, None, "u", "x")] * 9
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    assert {tuple(r) for r in chat.render_chats(turns, page=page).collect()} == chats_by_hand(rows, page)


def test_rollup(spark, tmp_path):
    schema = "change_id string, source string, lang string, tokenizer string, before bigint, after bigint"
    store = rollup.Rollup(spark, str(tmp_path / "r"))
    first = spark.createDataFrame([("a", "s", "en", "t1", None, 5), ("a", "s", "en", "t1", None, 5), ("b", None, None, "t1", None, 7), (None, "s", "en", "t1", None, 1)], schema)
    second = spark.createDataFrame([("c", "s", "en", "t1", 5, 9), ("d", None, None, "t1", 7, None)], schema)
    store.commit("1", first)
    for _ in range(3):
        store.commit("2", second)
    store.commit("3", second.limit(0))
    assert [tuple(r) for r in store.totals().collect()] == [("s", "en", "t1", 2, 10)]
    with pytest.raises(ValueError):
        store.commit("a/b", second)


def test_rollup_query_counts_every_row(spark, tmp_path):
    import duckdb
    from oracle import compare

    rows = [(k, "a b, c", "en", "s") for k in (None, None, 3, 3, 8, 8, 6, 6, -4, 17)] + [(6, "other words", None, None), (6, None, "en", "s")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op3_token_rollup"](spark, str(tmp_path)).toPandas()
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert compare(got, con.execute(ORACLES["op3_token_rollup"]).df()) is None and got.n_docs.sum() == 10


def test_sharding(spark, odd, empty):
    names = [f"n{k}" for k in range(9)]
    table = sharding.fill_table(names, 1009)
    orders = [[(sharding._number(f"offset:{s}") + j * (sharding._number(f"skip:{s}") % 1008 + 1)) % 1009 for j in range(1009)] for s in names]
    want, taken = {}, 0
    while len(want) < 1009:  # by turns, each from the start of its order
        slot = next(x for x in orders[taken % 9] if x not in want)
        want[slot] = taken % 9
        taken += 1
    assert [want[k] for k in range(1009)] == table and max(Counter(table).values()) - min(Counter(table).values()) <= 1
    fewer = sharding.fill_table(names[:-1], 1009)
    assert sum(a != b for a, b in zip(table, fewer)) < 400
    placed = sharding.place_rows(odd, "doc_id", names, 1009).collect()
    assert len(placed) == len(ODD) and len({r.shard for r in placed if r.row.doc_id == 6}) == 1 and sharding.place_rows(empty, "doc_id", names).count() == 0
    with pytest.raises(ValueError):
        sharding.fill_table(names, 1000)


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    result = corpus_pipeline.run(spark, SMALL).toPandas()
    kept = {r.doc_id: r.text for r in quality.keep_quality(docs).collect()}
    links, root = plain_classes(list(kept.values()))
    heads = [k for i, k in enumerate(kept) if root[i] == i]
    assert set(result.doc_id) <= set(kept) and len(result) > 0 and result.doc_id.is_unique
    benchmark = [TERM.findall(r.text.encode().lower()) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    windows = {tuple(w[k:k + 10]) for w in benchmark for k in range(max(1, len(w) - 9))}
    sizes = {len(w) for w in windows}

    def clean(text):
        w = TERM.findall(text.encode().lower())
        return not any(tuple(w[k:k + n]) in windows for n in sizes for k in range(len(w) - n + 1))

    want = {k for k in heads if clean(kept[k])}
    assert set(result.doc_id) == want
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "language_id", "ngram_jaccard_join", "benchmark_decontamination", "bpe_encoding"]
