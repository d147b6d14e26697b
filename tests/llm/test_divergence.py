"""The source audit and its perfect hashes against a plain recount."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from spendwatch.llm import divergence
from spendwatch.llm.divergence import PerfectHash, term_hashes, terms_of

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "lang string, source string, text string"


def plain_terms(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_audit(rows, top=200):
    rows = [(lang or "", source or "", plain_terms(text)) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in rows}:
        df = Counter(t for x, _, terms in rows if x == lang for t in set(terms))
        kept = sorted(t for t, n in df.items() if n >= 3)
        counts = {}
        for x, source, terms in rows:
            if x == lang:
                counts.setdefault(source, Counter()).update(t for t in terms if df[t] >= 3)

        def shares(count):
            total = sum(count.values()) + len(kept)
            return {t: 1 + 10**9 * (count[t] + 1) // total for t in kept}

        p = {s: shares(c) for s, c in counts.items()}
        q = shares(sum(counts.values(), Counter()))
        for s in counts:
            pairs = [(sum((p[s][t] - p[o][t])**2 // p[o][t] for t in kept), o) for o in counts if o != s]
            terms = [((p[s][t] - q[t])**2 // q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, n + 1) for n, (value, item) in enumerate(items)
                        if part == "pair" or n < top]
    return sorted(out)


def got(df, **how):
    return sorted(tuple(r) for r in divergence.audit(df, **how).select(
        "lang", "source", "part", "item", "value", "rank").collect())


def random_rows(n, seed):
    rng = np.random.default_rng(seed)
    words = ["der", "Der", "été", "x" * 70, "naïve", "日本", "A", "b"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)]
    ranks = 1 / np.arange(1, len(words) + 1)
    rows = []
    for i in range(n):
        size = 0 if i % 17 == 0 else int(rng.integers(1, 40))
        text = " 12,".join(rng.choice(words, size, p=ranks / ranks.sum()))
        rows.append((["en", "de", None][i % 3], [f"s{rng.integers(0, 5)}", None, ""][0 if i % 7 else i % 3], text))
    return rows


@pytest.fixture
def table(spark):
    def make(rows):
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        return df.selectExpr("*", "1 as n", "'x' as term", "2 as hash", "'y' as item", "3 as rank", "4 as v", "5 as share")
    return make


@pytest.mark.parametrize("limits", [{}, {"shard_bytes": 300, "pass_bytes": 700, "slot_bytes": 1000, "bucket_cells": 50}])
def test_audit_against_plain_recount(table, limits):
    rows = random_rows(300, 1)
    assert got(table(rows), **limits) == plain_audit(rows)


def test_audit_of_odd_rows(table):
    rows = [(None, None, None), ("en", "a", ""), ("en", "b", "one"), ("de", "a", "7 8 9"), ("fr", "a", "mot mot"),
            ("fr", "b", "MOT"), ("fr", "a", "mot\u0000mot"), ("fr", "c", None), ("x\u0000y", "a", "mot"), ("x\u0000y", "a", "mot"),
            ("x\u0000y", "a", "mot"), ("x\u0000y", "b", "Ünï ünï")]
    assert got(table(rows)) == plain_audit(rows)
    assert got(table(rows).limit(0)) == []
    long = [("en", "a", "abc" * 400_000 + " q"), ("en", "b", "abc" * 400_000), ("en", "b", "abc" * 400_000), ("en", "c", "q " * 300_000)]
    assert got(table(long)) == plain_audit(long)


def test_top_ranks_only(table):
    rows = [("en", s, " ".join(f"{s}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300))) for s in "abc" for _ in range(3)]
    found = got(table(rows))
    assert found == plain_audit(rows)
    assert max(r[5] for r in found if r[2] == "term") == 200


def test_perfect_hash_gives_each_key_a_slot_of_its_own():
    hashes = np.random.default_rng(3).integers(0, 2**64, 50_000, dtype=np.uint64)
    hashed, left = PerfectHash.build(hashes)
    assert not len(left) and sorted(hashed.slots(hashes)) == list(range(50_000))
    twice, left = PerfectHash.build(np.append(hashes[:100], hashes[:1]))  # one hash of two keys
    assert sorted(left) == [0, 100] and sorted(twice.slots(hashes[1:100])) == list(range(99))


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(divergence, "key_hashes", lambda langs, lang, hashes: np.full(len(lang), 7, np.uint64))
    rows = random_rows(60, 2)
    batch = pa.RecordBatch.from_arrays([pa.array([x for x, _, _ in rows]), pa.array([s for _, s, _ in rows]),
                                        pa.array([t for _, _, t in rows])], ["lang", "source", "text"])
    found = pa.Table.from_batches(divergence._frequencies([batch]))
    row = divergence._build_shard((pa.scalar(0),), found.select(["lang", "term", "hash"])).to_pylist()[0]
    shard = divergence.Shard(row, {})
    assert shard.parted == 0
    langs, lang = divergence._names(found["lang"])
    terms = found["term"].cast(pa.large_binary()).combine_chunks()
    slots = shard.find(langs, lang, terms, np.full(len(lang), 7, np.uint64))
    assert sorted(slots) == list(range(len(lang)))


def test_terms_and_hashes():
    texts = ["Ab1cÉ d", None, "", "ab_AB", "日本 语"]
    terms, codes, rows = terms_of(pa.array(texts))
    names = [t.decode() for t in terms.to_pylist()]
    assert [(int(r), names[c]) for c, r in zip(codes, rows)] == [
        (i, t) for i, text in enumerate(texts) for t in plain_terms(text)]
    one, two = "a", "b"
    for _ in range(10):
        one, two = one + two, two + one
    assert len(set(term_hashes(pa.array([one.encode(), two.encode(), b"ab", b"ba"], pa.large_binary())).tolist())) == 4
