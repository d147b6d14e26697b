"""Search, scoring, line dedup, near-dedup and the pipeline against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spendwatch.llm import forest, interpolation, langid, linedup, neardup
from spendwatch.llm.common import fold, word_hashes
from spendwatch.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
BLANK = " \t\n\v\f\r"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


# Search

def test_forest_finds_nearest(spark):
    df = spark.read.parquet(f"{DATA}/embeddings.parquet")
    rows = df.collect()
    unit = {r.vec_id: np.asarray(r.embedding, float) / np.linalg.norm(np.asarray(r.embedding, float)) for r in rows}
    found = {}
    for r in forest.search(df, df.where("vec_id % 20 = 0"), k=5, shard_rows=150).collect():
        assert r.score == pytest.approx(float(unit[r.query_id] @ unit[r.vec_id]), abs=1e-12)
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    hits = total = 0
    for q in (i for i in unit if i % 20 == 0):
        best = sorted((-(unit[q] @ v), i) for i, v in unit.items() if i != q)[:5]
        assert [k for k, _ in sorted(found[q])] == [1, 2, 3, 4, 5]
        hits += len({i for _, i in best} & {i for _, i in found[q]})
        total += 5
    assert hits / total >= 0.9


def test_forest_of_copies_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0], "x") for i in range(300)] + [(i, [0.0, 1.0], "x") for i in range(300, 310)]
    rows += [(400, None, "x"), (401, [], "x"), (402, [0.0, 0.0], "x"), (403, [1.0, None], "x"), (404, [nan, 1.0], "x"),
             (405, [inf, 1.0], "x"), (None, [1.0, 1.0], "x"), (406, [1.0, 0.0, 0.0], "x"), (7, [1.0, 0.0], "x"),
             (500, [2.0, 2.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = {}
    for r in forest.search(df, df.where("vec_id in (0, 7, 305, 400, 404, 406, 500)")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert {q: [i for _, i in sorted(v)] for q, v in got.items()} == {
        0: [1, 2, 3, 4, 5], 7: [0, 1, 2, 3, 4], 305: [300, 301, 302, 303, 304], 500: [0, 1, 2, 3, 4]}
    few = df.where("vec_id in (1, 300)")
    assert [r.vec_id for r in forest.search(few, few).orderBy("query_id").collect()] == [300, 1]
    assert forest.search(df.limit(0), df).collect() == []
    assert forest.search(df, df.limit(0)).collect() == []


def test_forest_leaves_no_blocks_to_joins(spark, sent_by_joins):
    """A join of shards and blocks would broadcast every block, once for each shard."""
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.standard_normal((100, 8)))],
                               "vec_id long, embedding array<double>")
    assert sent_by_joins(forest.search(df, df, shard_rows=20)) == {"bigint", "int"}


def test_forest_sends_queries_in_passes(spark, sent):
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((300, 8)))]
    rows += [(1000 + i, v.tolist()) for i, v in enumerate(rng.standard_normal((100, 3)))] + [(2000, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = sorted(tuple(r) for r in forest.search(df, df, shard_rows=50).collect())
    assert len(want) == 5 * 401 and len(sent) == 1
    sent.clear()
    got = sorted(tuple(r) for r in forest.search(df, df, shard_rows=50, query_rows=20, pass_bytes=4096).collect())
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=1e-12)
    sizes = [sum(len(x) for row in held for x in row.values() if isinstance(x, (bytes, bytearray))) for held in sent]
    assert sum(sizes) == 300 * 80 + 100 * 40 and len(sizes) == 7 and max(sizes) < 2 * 4096


# Scoring

def plain_scores(texts, held, weights):
    """Base and model scores by the module's formula, with its weights."""
    tokens = {i: [*words_of(t), None] for i, t in texts.items()}
    train = [i for i in texts if not held[i]]
    one = Counter(w for i in train for w in tokens[i])
    two = Counter(p for i in train for p in zip(["^", *tokens[i]], tokens[i]))
    n, v = sum(one.values()), len(one)
    out = {}
    for i, own in tokens.items():
        base = score = 0.0
        for before, w in zip(["^", *own], own):
            context = one[None] if before == "^" else one[before]
            a, u, z = weights.table[int(interpolation.bucket_of(np.asarray([context]))[0])]
            base += math.log10((one[w] + 1) / (n + v + 1))
            score += math.log10(a * two[before, w] / max(context, 1) + u * one[w] / max(n, 1) + z / (v + 1))
        out[i] = (len(own), sum(one[w] > 0 for w in own), n, base, score)
    return out


def test_scores_match_plain_version(spark, documents, monkeypatch):
    learned = {}
    learn = interpolation.learn_weights
    monkeypatch.setattr(interpolation, "learn_weights", lambda *a: learned.setdefault("w", learn(*a)))
    texts = {i: t for i, t, _ in documents} | {10_001: None, 10_002: "", 10_003: "A a É " * 3000}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5).withColumn("score", F.lit("x"))
    rows = interpolation.score(df, fold("doc_id", 7) == 2, fold("doc_id", 49) == 3, chunk_bytes=50_000).collect()
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    want = plain_scores(texts, held, learned["w"])
    assert len(rows) == len(texts)
    for r in rows:
        assert r.held_out == held[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3]
        assert r.base_score == pytest.approx(want[r.doc_id][3], rel=1e-9)
        assert r.score == pytest.approx(want[r.doc_id][4], rel=1e-9)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_weights_maximise_held_out_probability():
    rng = np.random.default_rng(2)
    n, pair, flat = rng.integers(1, 9, 500), rng.choice([0, 0.5, 30.0], 500), rng.choice([0.01, 0.5], 500)
    bucket, known = np.full(500, 3), np.ones(500, bool)
    a, u, z = interpolation.learn_weights(bucket, n, pair, flat, known).table[3]
    assert a + u + z == pytest.approx(1)

    def gain(w):
        return (n * np.log(w[0] * pair + w[1] + w[2] * flat)).sum()

    for _ in range(200):
        other = np.abs(np.array([a, u, z]) + rng.normal(0, 0.03, 3)) + 1e-9
        assert gain(other / other.sum()) <= gain((a, u, z)) + 0.05


def test_scores_of_odd_tables(table_of):
    held = F.col("doc_id") == 1
    rows = [(1, "a b"), (2, "a"), (2, "a"), (None, "b c"), (3, None)]
    done = interpolation.score(table_of(rows), held, F.lit(False)).collect()
    assert sorted(r.n_tokens for r in done) == [1, 2, 2, 3, 3]
    assert all(r.score < 0 for r in done) and {r.train_tokens for r in done} == {8}
    assert interpolation.score(table_of([]), held, F.lit(False)).collect() == []
    (alone,) = interpolation.score(table_of([(1, "x")]), held, F.lit(False)).collect()
    assert alone.train_tokens == 0 and alone.base_score == 0


# Line dedup

def plain_dedup(docs, min_words):
    """Lines to delete, from all runs of all lengths."""
    seen, gone = set(), {}
    lines = {i: [x.strip(BLANK) for x in (t or "").split("\n") if x.strip(BLANK)] for i, t in docs.items()}
    for i in sorted(lines, key=lambda k: (k is not None, k or 0)):
        own, gone[i] = lines[i], set()
        for a in range(len(own)):
            words = 0
            for b in range(a, len(own)):
                words += len(re.findall(r"[^\x20\x09-\x0D]+", own[b]))
                run = tuple(own[a:b + 1])
                if words >= min_words:
                    if run in seen:
                        gone[i].update(range(a, b + 1))
                    seen.add(run)
    return {i: [x for n, x in enumerate(own) if n not in gone[i]] for i, own in lines.items()}, gone


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_line_dedup_matches_all_runs(spark, seed):
    rng = random.Random(seed)
    docs = {i: "\n".join(rng.choice(["a b", "c", "d e f", "", "  ", "g\th", "x y z w", "a b "]) for _ in range(rng.randrange(25)))
            for i in range(30)}
    docs[30], docs[None], docs[31] = None, docs[3], "\n".join(["c"] * 300)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").withColumn("n_lines", F.lit("x"))
    rows = {r.doc_id: r for r in linedup.delete_repeats(df, min_words=6).collect()}
    kept, gone = plain_dedup(docs, 6)
    for i in docs:
        assert [x.strip(BLANK) for x in (rows[i].text or "").split("\n") if x.strip(BLANK)] == kept[i], i
        assert rows[i].n_deleted == len(gone[i])
        if not gone[i]:
            assert rows[i].text == docs[i]


def test_line_dedup_of_passages(spark):
    passage = "\n".join(f"line {i} has exactly six words" for i in range(10))
    rows = [(1, "own one\n" + passage + "\nown two"), (2, "short\n" + passage), (3, "line 1 has exactly six words\nother"),
            (4, passage), (4, passage), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.text, r.n_lines, r.n_deleted) for r in linedup.delete_repeats(df).collect())
    assert got == [(1, rows[0][1], 12, 0), (2, "short", 11, 10), (3, rows[2][1], 2, 0), (4, "", 10, 10), (4, "", 10, 10),
                   (5, "", 0, 0)]
    assert linedup.delete_repeats(df.limit(0)).collect() == []


# Near-duplicates

def plain_components(docs, percent=85):
    sets = {}
    for i, text in docs.items():
        w = words_of(text)
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in docs}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    order = sorted(docs)
    for n, i in enumerate(order):
        for j in order[:n]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return {i: (len(sets[i]), top(i)) for i in docs}


def near_copies(rng, n):
    """Families around a text: copies with some changed words, so that many of them are alike to the centre only."""
    docs, vocabulary = {}, [f"w{i}" for i in range(3000)]
    while len(docs) < n:
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 40, 150]))]
        for _ in range(rng.choice([1, 2, 5, 60])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            docs[len(docs) * 3 + 1] = " ".join(own).upper() if rng.random() < 0.1 else "  ".join(own)
    return docs


@pytest.mark.parametrize("block", [1500, 20])
def test_components_match_all_pairs(spark, block):
    docs = near_copies(random.Random(block), 500) | {0: None, 2: "", 3: " \n", 5: "one", 6: "ONE", 8: "É one"}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").withColumn("n", F.lit("x"))
    rows = neardup.near_duplicates(df, block=block).collect()
    want = plain_components(docs)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert len(rows) == len(docs) and got == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_near_duplicates_of_odd_rows(table_of):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b  c\td e f"), (None, "a b c d e f"), (3, None),
            (4, "w " * 50_000), (5, "x " + "w " * 50_000)]
    got = sorted(((r.doc_id or 0, r.n_shingles, r.component_id, r.kept)
                  for r in neardup.near_duplicates(table_of(rows)).collect()), key=str)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (0, 2, None, True), (3, 0, 3, True),
                          (4, 1, 4, True), (5, 2, 5, True)], key=str)
    assert neardup.near_duplicates(table_of([])).collect() == []


def test_links_in_a_dense_family_are_not_lost(spark):
    """Every two documents are alike to some extent, most of them just below the threshold."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(120)]
    docs = {}
    for i in range(900):
        own = list(base)
        for _ in range(2):
            own[rng.randrange(120)] = f"v{rng.randrange(10**6)}"
        docs[i] = " ".join(own)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df, block=200).collect()}
    assert got == plain_components(docs)
    assert 100 < len({c for _, c in got.values()}) < 900


def test_names_do_not_follow_the_form_of_a_word(spark):
    """A Thue-Morse word and its complement are equal modulo 2^64 under any polynomial with an odd base."""
    one, two = "a", "b"
    for _ in range(10):
        one, two = one + two, two + one
    hashes, _ = word_hashes(pa.array([f"{one} {two} {one}"]))
    assert hashes[0] == hashes[2] != hashes[1]
    df = spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(df).collect()} == {1: 1, 2: 2, 3: 1}
    lines = "\n".join(["some words " * 10] * 5)
    runs = spark.createDataFrame([(1, f"{lines}\n{one}"), (2, f"{lines}\n{two}"), (3, f"{lines}\n{one}")],
                                 "doc_id long, text string")
    assert {r.doc_id: r.text for r in linedup.delete_repeats(runs).collect()}[2].endswith(two)


def test_columns_named_like_working_ones(spark):
    df = spark.createDataFrame([(1, "plain words here", 5, 6, 7, "t", "en")],
                               "doc_id long, text string, _doc long, _DOC2 long, _spans long, _text string, lang string")
    cut = linedup.delete_repeats(df)
    assert cut.columns == [*df.columns, "n_lines", "n_deleted"] and cut.first()._spans == 7
    judged = langid.predict(df, langid.train(df))
    assert judged.first()._text == "t" and judged.first().lang_pred == "en"


def test_long_chains_are_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    got = {r.node: r.component for r in neardup.components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


# Pipeline and queries

def test_pipeline_matches_plain_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language ID", "line dedup", "MinHash near-dedup", "packing"]
    known = stages["language ID"](spark, docs, DATA)
    assert known.columns == docs.columns and known.count() == docs.count()
    texts = {r.doc_id: r.text for r in known.collect()}
    kept, gone = plain_dedup(texts, 50)
    cut = stages["line dedup"](spark, known, DATA)
    rows = {r.doc_id: r for r in cut.collect()}
    assert cut.columns == docs.columns
    assert set(rows) == {i for i in texts if not gone[i] or kept[i]}
    for i, r in rows.items():
        assert [x.strip(BLANK) for x in r.text.split("\n") if x.strip(BLANK)] == kept[i]
        assert r.n_chars == len(r.text)
    single = stages["MinHash near-dedup"](spark, cut, DATA)
    want = plain_components({i: r.text for i, r in rows.items()}, percent=80)
    assert single.columns == docs.columns
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, (_, c) in want.items() if i == c)
    packed = corpus_pipeline.run(spark, DATA).groupBy("doc_id").agg(
        F.sum("length").alias("n"), F.first("doc_tokens").alias("want")).collect()
    assert sorted(r.doc_id for r in packed) == sorted(i for i, (_, c) in want.items() if i == c)
    assert all(r.n == r.want for r in packed)


def test_pipeline_stages_of_odd_rows(spark):
    rows = [(1, None, "en", "s", 0), (2, "", None, "s", 0), (3, "plain words in a line", None, "s", 21),
            (None, "plain words in a line", "en", "s", 21), (4, "plain words in a line", "en", "s", 21),
            (4, "plain words in a line", "en", "s", 21)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), "").collect() == []
    known = corpus_pipeline.identify_language(spark, docs, "")
    assert sorted(str(r.doc_id) for r in known.collect()) == ["3", "4", "4", "None"]
    assert {r.lang for r in known.collect()} == {"en"}
    single = corpus_pipeline.drop_near_duplicates(spark, known, "")
    # A missing id comes before all others.
    assert [r.doc_id for r in single.collect()] == [None]
    shared = spark.createDataFrame([(7, "one text of its own", "en", "s", 1), (7, "another text of the same id", "en", "s", 1),
                                    (7, "one text of its own", "en", "t", 1)], schema)
    assert sorted(r.text for r in corpus_pipeline.drop_near_duplicates(spark, shared, "").collect()) == [
        "another text of the same id", "one text of its own"]


def test_one_query_for_each_operator():
    assert sorted(int(name.split("_")[0][2:]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_run(spark, name):
    df = QUERIES[name](spark, DATA)
    assert df.count() > 0
