"""Near-duplicate embeddings, hard negatives and components against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendwatch.llm import components, descent, negatives
from spendwatch.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")
# Columns whose names the operators use themselves.
CLASH = {c: "'x'" for c in ("id", "vector", "node", "n", "label", "good", "low", "copies", "dim", "component_id", "rank",
                            "n_links", "kept", "shard", "positive_id")}


def vectors(spark, rows, schema="vec_id long, embedding array<double>"):
    df = spark.createDataFrame(rows, schema).repartition(3)
    return df.selectExpr("*", *(f"{v} as {k}" for k, v in CLASH.items() if k not in df.columns))


def plain_components(edges):
    parent = {}

    def top(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {x: top(x) for x in parent}


def plain_links(rows, threshold=0.95):
    """(n_links, component) of each (id, vector)."""
    good = []
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            scaled = np.asarray(v, float) / max(map(abs, v))  # no overflow in the squares
            good.append((i, scaled / np.linalg.norm(scaled)))
    links = {i: set() for i, _ in rows if i is not None}
    for a, (i, v) in enumerate(good):
        for j, w in good[a + 1:]:
            if len(v) == len(w) and i != j and v @ w >= threshold:
                links[i].add(j)
                links[j].add(i)
    low = plain_components((i, j) for i in links for j in links[i])
    return {i: (len(links[i]), low.get(i, i)) for i in links}


def got_links(df, **how):
    out = {}
    for r in descent.near_duplicates(df, **how).collect():
        assert r.kept == (r.vec_id is None or r.vec_id == r.component_id)
        if r.vec_id is not None:
            out[r.vec_id] = (r.n_links, r.component_id)
    return out


@pytest.mark.parametrize("chunk", [3, 200_000])
def test_components(spark, monkeypatch, chunk):
    monkeypatch.setattr(components, "CHUNK", chunk)
    rng = np.random.default_rng(4)
    edges = [(i, i + 1) for i in range(40)] + [(500, 400), (400, 500), (7, 7)] + [
        (int(a), int(b)) for a, b in rng.integers(1000, 1060, (45, 2))]
    df = spark.createDataFrame(edges, "a long, b long").repartition(4)
    got = {r.node: r.component for r in components.components(df).collect()}
    assert got == {k: v for k, v in plain_components(edges).items() if k != 7 or v != 7}
    assert components.components(df.limit(0)).collect() == []


def test_descent_finds_the_links_of_groups(spark):
    rng = np.random.default_rng(5)
    rows = [v for v in rng.standard_normal((600, 64))]
    for size, noise in ((2, .02), (12, .02), (90, .025), (40, .04)):
        base = rng.standard_normal(64)
        rows += [base + noise * rng.standard_normal(64) * np.linalg.norm(base) for _ in range(size)]
    table = [(i, v.tolist()) for i, v in enumerate(rows)]
    assert got_links(vectors(spark, table)) == plain_links(table)


def test_descent_counts_dense_nodes_exactly(spark):
    """Groups far beyond the longest list, in tight parts that fill the lists on their own, with copies."""
    rng = np.random.default_rng(6)
    table, n = [], 0
    for _ in range(2):
        base = rng.standard_normal(32)
        for _ in range(8):
            part = base + .02 * rng.standard_normal(32) * np.linalg.norm(base)
            for _ in range(20):
                v = (part + .002 * rng.standard_normal(32)).tolist()
                table += [(n, v), (n + 1, v)] if n % 10 == 0 else [(n, v)]
                n += 2
    table += [(n + 1 + i, v.tolist()) for i, v in enumerate(rng.standard_normal((200, 32)))]
    assert got_links(vectors(spark, table), leaf=32, start=4, most=8, block=50) == plain_links(table)


def test_descent_of_odd_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(50, 90)] + [(1, [2.0, 0.0]), (2, [1e300, 1e299]), (3, [1e-300, 0.0])]
    rows += [(4, None), (5, []), (6, [0.0, 0.0]), (7, [1.0, None]), (8, [NAN, 1.0]), (9, [INF, 1.0]), (None, [1.0, 0.0]),
             (10, [1.0, 0.0, 0.0]), (11, [-1.0, 0.0]), (60, [1.0, 0.0]), (12, [0.0, 1.0]), (12, [0.0, 1.0]), (13, [-0.0, 1.0])]
    df = vectors(spark, rows)
    got = got_links(df)
    assert got == plain_links(list({(i, str(v)): (i, v) for i, v in rows}.values()))
    assert got[1] == (42, 1) and got[4] == (0, 4) and got[12] == (1, 12) and got[13] == (1, 12)
    assert descent.near_duplicates(df).where("vec_id is null").count() == 1
    assert descent.near_duplicates(df).where("vec_id = 60").count() == 1
    assert descent.near_duplicates(df.limit(0)).collect() == []
    assert got_links(df.where("vec_id = 1")) == {1: (0, 1)}


def test_op11_against_brute_force(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding])
            for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    got = {r.vec_id: (r.n_links, r.component_id) for r in QUERIES["op11_neighbour_descent"](spark, DATA).collect()}
    assert got == plain_links(rows)


# Hard negatives

def plain_negatives(rows, anchors, k=5, few=3):
    kept = {}
    for i, v, label in sorted((r for r in rows if None not in r), key=lambda r: (r[0], r[2])):
        if all(x is not None and math.isfinite(x) for x in v):
            kept.setdefault(i, (label, [math.floor(256 * x) for x in v]))
    out = []
    for a in anchors:
        if a not in kept:
            continue
        label, own = kept[a]
        score = {i: sum(x * y for x, y in zip(own, v)) for i, (_, v) in kept.items() if i != a and len(v) == len(own)}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if kept[i][0] == label][:k]:
            fit = [i for i in order if kept[i][0] != label and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            out += [(a, p, r + 1, i, score[p], score[i]) for r, i in enumerate(fit[:few])]
    return sorted(out)


def got_negatives(df, anchors, **how):
    rows = negatives.hard_negatives(df, anchors, **how).collect()
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in rows)


KEYED = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("dim", [1, 3, 64])
def test_negatives_against_brute_force(spark, dim):
    rng = np.random.default_rng(dim)
    rows = [(i, v.tolist(), int(rng.integers(0, 3))) for i, v in enumerate(rng.standard_normal((400, dim)))]
    rows += [(1000 + i, rows[i % 5][1], i % 2) for i in range(60)]  # copies: many ties
    df = vectors(spark, rows, KEYED)
    want = plain_negatives(rows, [r[0] for r in rows if r[0] % 10 == 0])
    assert want
    assert got_negatives(df, df.where("vec_id % 10 = 0"), shard_rows=100, block_rows=7) == want


def test_negatives_of_odd_rows(spark):
    rows = [(1, [1.0, 0.5], 0), (2, [1.0, 0.4], 0), (3, [0.9, 0.2], 1), (4, [0.0, 0.0], 1), (5, None, 1), (6, [NAN, 1.0], 1),
            (7, [1.0, None], 1), (8, [0.8, 0.3], None), (None, [0.8, 0.3], 1), (9, [0.7, 0.4, 0.1], 1), (3, [0.9, 0.2], 1),
            (10, [], 0), (11, [], 0), (12, [], 1), (13, [-1.0, -0.5], 0), (14, [-0.7, -0.4], 1), (2, [0.9, 0.9], 2),
            (15, [1e15, 1e15], 1)]
    df = vectors(spark, rows, KEYED)
    everyone = [r[0] for r in rows if r[0] is not None]
    want = plain_negatives(rows, sorted(set(everyone)))
    assert (10, 11, 1, 12, 0, 0) in want
    assert got_negatives(df, df) == want
    assert got_negatives(df.limit(0), df.limit(0)) == []
    assert got_negatives(df, df.limit(0)) == []


def test_negatives_leave_no_blocks_to_joins(spark, sent_by_joins):
    """A join of shards and blocks would broadcast every block, once for each shard."""
    rng = np.random.default_rng(7)
    df = vectors(spark, [(i, v.tolist(), i % 3) for i, v in enumerate(rng.standard_normal((100, 8)))], KEYED)
    assert sent_by_joins(negatives.hard_negatives(df, df, shard_rows=20)) == {"bigint"}


def test_negatives_send_anchors_in_passes(spark, sent):
    rng = np.random.default_rng(8)
    rows = [(i, v.tolist(), int(rng.integers(0, 3))) for i, v in enumerate(rng.standard_normal((200, 8)))]
    rows += [(1000 + i, v.tolist(), i % 2) for i, v in enumerate(rng.standard_normal((50, 3)))]
    df = vectors(spark, rows, KEYED)
    want = plain_negatives(rows, [r[0] for r in rows])
    assert want and got_negatives(df, df, shard_rows=60, block_rows=9, pass_bytes=40_000) == want
    sizes = [sum(len(row["matrix"]) for row in held) for held in sent]
    # Two phases, each of three passes: 200 * 400 + 50 * 360 bytes with the summaries.
    assert len(sizes) == 6 and sum(sizes) == 2 * (200 * 64 + 50 * 24) and max(sizes) < 2 * 14000 / 3


def test_bounds_hold_every_score(spark):
    rng = np.random.default_rng(9)
    matrix = np.floor(256 * rng.standard_normal((50, 37))).astype(np.int64)
    rows = negatives.Rows(np.arange(50), np.zeros(50, np.int64), matrix,
                          [negatives.summaries(matrix.astype(float), s) for s in negatives.LEVELS])
    for i in range(50):
        scores = matrix @ matrix[i]
        widths = []
        for level in range(len(negatives.LEVELS)):
            low, high = rows.bounds(np.arange(50), level, rows, i)
            assert (low <= scores).all() and (scores <= high).all()
            widths.append((high - low).mean())
        assert widths[1] < widths[0]
