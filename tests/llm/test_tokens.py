"""Transducer lexicon and packing against the tokenizers library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from spendwatch.llm import lexicon, packing
from spendwatch.llm.chunks import ChunkEncoder

ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "<|endoftext|>x<|startoftext|> <|endof text|>"), (5, "a\u001cb\u001d c"),
       (6, "ÀÉ ΑΣ ΣΑΣ İ ﬁ é ́x"), (7, "it's WE'LL 'S o'clock"), (8, "日本語 한국어 가 ١٢٣ 😀😀"),
       (9, "x" * 5000), (10, "word " * 3000), (11, "same text"), (11, "same text"), (None, "no id"),
       (12, "  　᠎​﻿.")]


@pytest.fixture(scope="module")
def library(tokenizer_path):
    return Tokenizer.from_file(tokenizer_path)


def encoder(tokenizer_path, words):
    tokenizer = lexicon.WordTokenizer(tokenizer_path)
    arrays = lexicon.build_automaton({w: tokenizer.merge(w) for w in words})
    return lexicon.WordEncoder(tokenizer, lexicon.Transducer(lexicon.automaton_bytes(arrays)))


def test_random_texts_match_library(library, tokenizer_path):
    rng = random.Random(5)
    words = encoder(tokenizer_path, ["the", "then", "ab", "é", "x" * 40])
    pool = [chr(c) for c in [*range(0, 0x250), *range(0x300, 0x320), *range(0x390, 0x3D0), 0x130, 0x1E9E, 0x2028, 0x3000,
                             0x200B, 0x1F600, 0x4E00, 0xAC00, 0x661]] + ["'s", "<|endoftext|>", "<|", "ab ", "the "] * 9
    for _ in range(1500):
        text = "".join(rng.choice(pool) for _ in range(rng.randrange(14)))
        ids, _ = ChunkEncoder(words.resolve).encode([text])
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_merges_of_many_words_equal_single_merges(tokenizer_path, documents):
    tokenizer = lexicon.WordTokenizer(tokenizer_path)
    words = sorted({w for _, text, _ in documents for w in tokenizer.words((text or "").split())[0]})
    flat, sizes = tokenizer.merge_many(words)
    assert np.split(flat, np.cumsum(sizes)[:-1])[5].tolist() == tokenizer.merge(words[5])
    assert flat.tolist() == [i for w in words for i in tokenizer.merge(w)]


def test_automaton_is_minimal_and_exact(tokenizer_path):
    words = ["tap", "taps", "top", "tops", "é"]
    arrays = lexicon.build_automaton({w: [i, i + 1] for i, w in enumerate(words)})
    walk = lexicon.Transducer(lexicon.automaton_bytes(arrays))
    numbers = walk.numbers([*words, "ta", "tapss", "", "x"])
    assert (numbers >= 0).tolist() == [True] * 5 + [False] * 4
    for i, number in enumerate(numbers[:5]):
        a, b = walk.out_first[number:number + 2]
        assert walk.out_ids[a:b].tolist() == [i, i + 1]
    # t - (a|o) - p - s: the two middles and both ends share their states.
    assert len(arrays["final"]) == 6
    assert lexicon.Transducer(lexicon.automaton_bytes(lexicon.build_automaton({}))).numbers(["a"]).tolist() == [-1]


@pytest.mark.parametrize("lexicon_words", [0, 40, 100_000])
def test_encode_and_decode(table_of, library, tokenizer_path, lexicon_words):
    rows = lexicon.encode_decode(table_of(ODD), tokenizer_path, lexicon_words=lexicon_words).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in ODD)
    texts = {i: text or "" for i, text in ODD}
    for row in rows:
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert np.frombuffer(row.ids, "<u4").tolist() == ids
        assert row.n_tokens == len(ids)
        assert row.decoded == library.decode(ids, skip_special_tokens=False)


def test_empty_tables(spark, tokenizer_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lexicon.encode_decode(empty, tokenizer_path).collect() == []
    assert packing.pack(empty, tokenizer_path).collect() == []


@pytest.mark.parametrize("max_open", [2, 1024])
def test_packing_loses_no_id(table_of, library, tokenizer_path, documents, max_open):
    docs = [*((i, t) for i, t, _ in documents), *((i + 10_000 if i else None, t) for i, t in ODD)]
    pieces = packing.pack(table_of(docs), tokenizer_path, window=512, max_open=max_open).collect()
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
        by_doc[p.doc_id].append(p)
        assert len(p.ids) == 4 * p.length
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == 512 or at & (at - 1) == 0
    texts = defaultdict(list)
    for i, text in docs:
        texts[i].append(text or "")
    assert set(texts) == set(by_doc)
    for i, own in texts.items():
        ids = library.encode(own[0], add_special_tokens=False).ids + [2]
        assert {p.doc_tokens for p in by_doc[i]} == {len(ids)}
        want = np.asarray(ids, "<u4").tobytes()
        for p in by_doc[i]:
            assert p.ids == want[4 * p.start:4 * (p.start + p.length)]
        assert sum(p.length for p in by_doc[i]) == len(ids) * len(own)


def test_level_choice_is_least_sum_of_squares():
    rng = random.Random(1)
    for _ in range(300):
        packer = packing.Packer(32)
        for level in range(1, 32):
            packer.levels[level] = rng.choice([0, 0, 1, 2, 5])
        size = rng.randrange(1, 33)
        costs = {}
        for level in range(0, 33 - size):
            if level == 0 or packer.levels[level]:
                after = packer.levels.copy()
                if level:
                    after[level] -= 1
                if level + size < 32:
                    after[level + size] += 1
                costs[level] = int((after[1:32] ** 2).sum())
        least = min(costs.values())
        assert packer.level_for(size) == max(h for h, c in costs.items() if c == least)


def test_crc_of_a_piece(spark, tokenizer_path):
    from pyspark.sql import functions as F
    row = packing.pack(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), tokenizer_path).select(
        "ids", F.crc32("ids").alias("crc")).orderBy("ids").first()
    assert row.crc == zlib.crc32(row.ids)


def test_words_of_a_million_letters_equal_the_library(spark, tokenizer_path, library):
    rng = random.Random(3)
    table = [(1, "".join(rng.choice("acgt") for _ in range(1_000_000))), (2, "x" * 100_001 + " end"),
             (3, "\u65e5\u672c" * 20_000), (4, "short words")]
    docs = spark.createDataFrame(table, "doc_id long, text string").coalesce(1)
    want = {i: library.encode(text, add_special_tokens=False).ids for i, text in table}
    found = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in lexicon.encode_decode(docs, tokenizer_path).collect()}
    assert found == want
    joined = defaultdict(list)
    for r in packing.pack(docs, tokenizer_path).orderBy("doc_id", "start").collect():
        joined[r.doc_id] += np.frombuffer(r.ids, "<u4").tolist()
    assert joined == {i: [*ids, 2] for i, ids in want.items()}


def test_heap_merges_equal_the_library(tokenizer_path, library):
    tokenizer, rng = lexicon.WordTokenizer(tokenizer_path), random.Random(4)
    for _ in range(300):
        word = "".join(rng.choice("abcdeinorst") for _ in range(rng.randrange(1, 400)))
        assert tokenizer.merge(word) == library.encode(word, add_special_tokens=False).ids
