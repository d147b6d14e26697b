"""Language-model scoring by deleted interpolation.

P(w | v) = a[b] * c(v w) / c(v) + u[b] * c(w) / N + z[b] / (V + 1), where b is the bucket of the context's frequency
(octaves of c(v), and 0 for an unseen one). The three weights of a bucket come from expectation-maximisation on the
tokens of a held-out fold, whose counts are deleted from the estimates meanwhile; the final estimates hold all training
documents. A text begins after a start mark and ends with an end token; the start is as frequent as the end.

How the counts travel: documents are packed once into chunks of about `chunk_bytes` of text, each one row of a stored
table. A chunk counts its own distinct words and pairs (64-bit hashes) and sends them to `owners`, chosen by the hash: one
row of sorted keys and counts for each owner, so the shuffle moves arrays, and a word that stands in a third of all
tokens is one entry of each chunk. An owner adds up the counts and answers every list with the totals in the same order.
A chunk then meets its answers and scores its documents. Nothing is collected but N, V and the statistics of the
weights, whose size does not depend on the input (a histogram over buckets and ratios of the three estimates).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from spendwatch.llm.common import mix, partitions, ship, slices, stored, word_hashes

END, START = np.uint64(0xE4D0000000000001), np.uint64(0x57A0000000000001)
BUCKETS = 48
_STEPS = 8  # ratios are told apart by eighths of an octave; each cell keeps its mean
_NONE = -10_000  # the place of a ratio whose estimate is zero
_ROUNDS = 60


@dataclass
class Weights:
    """One row of (pair, word, uniform) weights for each bucket."""
    table: np.ndarray


def bucket_of(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.where(count > 0, 1 + np.log2(np.maximum(count, 1)), 0).astype(np.int64), BUCKETS - 1)


class _Tokens:
    """Tokens of a batch of texts: word keys (ends included), the key of what stands before each, row borders."""

    def __init__(self, texts: pa.Array):
        parts, starts, at = [], [np.zeros(1, np.int64)], 0
        batch = pa.RecordBatch.from_arrays([texts.cast(pa.large_string())], ["text"])
        for piece in slices([batch], "text", 2 << 20):
            words, first = word_hashes(piece.column(0))
            n = len(first) - 1
            key = np.empty(len(words) + n, np.uint64)
            ends = first[1:] + np.arange(n)
            key[ends] = END
            inner = np.ones(len(key), bool)
            inner[ends] = False
            key[inner] = words
            parts.append(key)
            starts.append(at + ends + 1)
            at += len(key)
        self.word = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        self.borders = np.concatenate(starts)
        before = np.empty_like(self.word)
        before[1:] = self.word[:-1]
        before[self.borders[:-1]] = START
        self.before = before
        with np.errstate(over="ignore"):
            self.pair = mix(before * np.uint64(0x9FB21C651E98DF25) + mix(self.word))


def _owner(keys: np.ndarray, owners: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)


def _lists(keys: np.ndarray, owners: int) -> np.ndarray:
    """Where in the sorted keys each owner's list begins; keys sort by owner first, as it comes from the top bits."""
    return np.searchsorted(_owner(keys, owners), np.arange(owners + 1))


def _blob(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unblob(blob: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(blob).read_next_batch()


def _chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """(chunk, docs, fold_docs): documents as compressed Arrow blobs; those of the fold for the weights once more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []

        def row() -> pa.RecordBatch:
            nonlocal number
            whole = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            number += 1
            schema = pa.schema([("id", whole.schema.field("id").type), ("part", pa.int32()), ("text", pa.large_string())])
            whole = whole.cast(schema)
            fold = whole.filter(pa.compute.equal(whole["part"], 2))
            blobs = [_blob(pa.RecordBatch.from_arrays([c.combine_chunks() for c in t.columns], schema=schema))
                     for t in (whole, fold)]
            return pa.RecordBatch.from_arrays([pa.array([number - 1]), pa.array(blobs[:1], pa.binary()),
                                               pa.array(blobs[1:], pa.binary())], ["chunk", "docs", "fold_docs"])

        size = 0
        for piece in slices(batches, "text", chunk_bytes // 4):
            held.append(piece)
            size += pa.compute.sum(pa.compute.binary_length(piece.column("text"))).as_py() or 0
            if size >= chunk_bytes:
                yield row()
                size = 0
        if held:
            yield row()

    return docs.mapInArrow(run, "chunk long, docs binary, fold_docs binary")


def _requests(chunks: DataFrame, owners: int) -> DataFrame:
    """(owner, chunk, kind, keys, train, fold): kind 0 words, 1 pairs; counts in training and in the weights' fold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("docs")):
                rows = _unblob(blob.as_py())
                tokens = _Tokens(rows.column("text"))
                part = np.repeat(np.asarray(rows.column("part")), np.diff(tokens.borders))
                for kind, all_keys in ((0, tokens.word), (1, tokens.pair)):
                    keys, which = np.unique(all_keys, return_inverse=True)
                    train = np.bincount(which[part != 1], minlength=len(keys)).astype("<u4")
                    fold = np.bincount(which[part == 2], minlength=len(keys)).astype("<u4")
                    at = _lists(keys, owners)
                    filled = np.flatnonzero(at[1:] > at[:-1])
                    spans = [(int(at[o]), int(at[o + 1])) for o in filled]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(filled.astype(np.int32)), pa.array([chunk] * len(spans), pa.int64()),
                         pa.array([kind] * len(spans), pa.int32()),
                         *(pa.array([x[a:b].tobytes() for a, b in spans], pa.binary()) for x in (keys, train, fold))],
                        ["owner", "chunk", "kind", "keys", "train", "fold"])

    return chunks.select("chunk", "docs").mapInArrow(
        run, "owner int, chunk long, kind int, keys binary, train binary, fold binary")


_ANSWER = pa.schema([("chunk", pa.int64()), ("owner", pa.int32()), ("kind", pa.int32()), ("counts", pa.binary()),
                     ("fold_counts", pa.binary()), ("tokens", pa.int64()), ("distinct", pa.int64()),
                     ("fold_tokens", pa.int64())])


def _total(key: tuple, group: pa.Table) -> pa.Table:
    """Answer every list of an owner with the totals of its keys. One more row (chunk -1) has the owner's sums."""
    out: dict[str, list] = {name: [] for name in _ANSWER.names}

    def add(*values) -> None:
        for name, value in zip(_ANSWER.names, values):
            out[name].append(value)

    owner = key[0].as_py()
    for kind in (0, 1):
        rows = group.filter(pa.compute.equal(group["kind"], kind))
        if not rows.num_rows:
            continue
        keys = [np.frombuffer(b.as_buffer(), np.uint64) for b in rows["keys"]]
        borders = np.cumsum([0, *map(len, keys)])
        _, which = np.unique(np.concatenate(keys), return_inverse=True)
        train = np.concatenate([np.frombuffer(b.as_buffer(), "<u4") for b in rows["train"]])
        fold = np.concatenate([np.frombuffer(b.as_buffer(), "<u4") for b in rows["fold"]])
        total = np.bincount(which, train)
        rest = total - np.bincount(which, fold)
        if kind == 0:
            add(-1, owner, 0, None, None, int(total.sum()), int((total > 0).sum()), int(fold.sum()))
        for chunk, a, b in zip(rows["chunk"].to_pylist(), borders[:-1], borders[1:]):
            own = which[a:b]
            add(chunk, owner, kind, total[own].astype("<u4").tobytes(),
                rest[own[fold[a:b] > 0]].astype("<u4").tobytes(), None, None, None)
    return pa.table(out, schema=_ANSWER)


def _answers(rows: pa.Table, column: str, kind: int) -> np.ndarray:
    own = rows.filter(pa.compute.equal(rows["kind"], kind)).sort_by("owner")
    return np.concatenate([np.zeros(0, "<u4"), *(np.frombuffer(b.as_buffer(), "<u4") for b in own[column])]).astype(
        np.float64)


def _resolved(tokens: _Tokens, rows: pa.Table, column: str):
    """For every token: counts of its pair, of what stands before it, and of itself."""
    words, which = np.unique(tokens.word, return_inverse=True)
    _, pair = np.unique(tokens.pair, return_inverse=True)
    of_word, of_pair = _answers(rows, column, 0), _answers(rows, column, 1)
    own = of_word[which]
    before = np.empty_like(own)
    before[1:] = own[:-1]
    before[tokens.borders[:-1]] = of_word[np.searchsorted(words, END)]
    return of_pair[pair], before, own


_CELLS = pa.schema([("bucket", pa.int32()), ("q_pair", pa.int32()), ("q_flat", pa.int32()), ("n", pa.int64()),
                    ("pair", pa.float64()), ("flat", pa.float64())])


def _cells(total: int, distinct: int):
    """Held-out tokens of a chunk by bucket and by the ratios of the pair's and the uniform estimate to the word's."""
    def run(_key: tuple, chunk: pa.Table, rows: pa.Table) -> pa.Table:
        if not chunk.num_rows or not rows.num_rows:
            return _CELLS.empty_table()
        docs = _unblob(chunk["fold_docs"][0].as_py())
        tokens = _Tokens(docs.column("text"))
        if not len(tokens.word):
            return _CELLS.empty_table()
        pair, before, own = _resolved(tokens, rows, "fold_counts")
        with np.errstate(divide="ignore", invalid="ignore"):
            word = own / max(total, 1)
            known = own > 0
            of_pair = np.where(known & (before > 0), pair / np.maximum(before, 1) / word, 0)
            flat = np.where(known, 1 / (distinct + 1) / word, 0)
            q_pair = np.where(of_pair > 0, np.round(np.log2(of_pair) * _STEPS), _NONE).astype(np.int64)
            q_flat = np.where(flat > 0, np.round(np.log2(flat) * _STEPS), _NONE).astype(np.int64)
        key = (bucket_of(before) << 40) + ((q_pair + 20_000) << 20) + (q_flat + 20_000)
        cell, which, n = np.unique(key, return_inverse=True, return_counts=True)
        return pa.table([pa.array((cell >> 40).astype(np.int32)),
                         pa.array(((cell >> 20 & 0xFFFFF) - 20_000).astype(np.int32)),
                         pa.array(((cell & 0xFFFFF) - 20_000).astype(np.int32)), pa.array(n),
                         pa.array(np.bincount(which, of_pair)), pa.array(np.bincount(which, flat))], schema=_CELLS)
    return run


def learn_weights(bucket: np.ndarray, n: np.ndarray, pair: np.ndarray, flat: np.ndarray, known: np.ndarray) -> Weights:
    """Expectation-maximisation for each bucket; `pair` and `flat` are estimates relative to the word's, `known` tells
    whether the word's is above zero. A bucket without held-out tokens takes the weights of the bucket below."""
    table = np.tile([0.3, 0.6, 0.1], (BUCKETS, 1))
    last = np.array([0.0, 0.9, 0.1])
    for b in range(BUCKETS):
        mine = bucket == b
        if not mine.any():
            table[b] = last
            continue
        # Without a known word the uniform part alone explains a token.
        parts = np.stack([np.where(known, pair, 0), known.astype(float), np.where(known, flat, 1)], axis=1)[mine]
        weight, count = np.array([1 / 3] * 3), n[mine].astype(float)
        for _ in range(_ROUNDS):
            share = parts * weight
            share /= share.sum(axis=1, keepdims=True)
            weight = (share * count[:, None]).sum(axis=0) / count.sum()
        weight = np.maximum(weight, [0, 1e-9, 1e-6])
        table[b] = last = weight / weight.sum()
    table[0] = [0, *(table[0][1:] / table[0][1:].sum())]  # an unseen context says nothing about pairs
    return Weights(table)


def _scores(total: int, distinct: int, weights: Weights, id_type: str):
    def run(_key: tuple, chunk: pa.Table, rows: pa.Table) -> pa.Table:
        if not chunk.num_rows or not rows.num_rows:
            return pa.schema([]).empty_table()
        docs = _unblob(chunk["docs"][0].as_py())
        tokens = _Tokens(docs.column("text"))
        pair, before, own = _resolved(tokens, rows, "counts")
        mixed = weights.table[bucket_of(before)]
        p = (mixed[:, 0] * pair / np.maximum(before, 1) + mixed[:, 1] * own / max(total, 1)
             + mixed[:, 2] / (distinct + 1))
        base = np.log10((own + 1) / (total + distinct + 1))
        at = tokens.borders[:-1]
        return pa.table({
            "id": docs.column("id"), "held_out": pa.compute.equal(docs.column("part"), 1),
            "n_tokens": pa.array(np.diff(tokens.borders)),
            "n_known": pa.array(np.add.reduceat((own > 0).astype(np.int64), at)),
            "train_tokens": pa.array(np.full(len(at), total, np.int64)),
            "base_score": pa.array(np.add.reduceat(base, at)), "score": pa.array(np.add.reduceat(np.log10(p), at))})
    return run


def score(docs: DataFrame, held_out: Column, weights_fold: Column, id_column: str = "doc_id", text: str = "text",
          chunk_bytes: int = 8 << 20) -> DataFrame:
    """Score every whole text under a model of all texts where `held_out` is not true.

    `weights_fold` marks the training rows on which the weights are learned. One row per input row: the id column, held_out,
    n_tokens, n_known (tokens seen in training), train_tokens, base_score (words with one added to each count), score;
    both are log10 probabilities. A null text counts as empty: its end token alone. Repeated rows and null ids
    are documents of their own; other columns are ignored; an empty table gives an empty result. Without training
    tokens every token has the uniform probability of a single unknown word. Raise `chunk_bytes` with the memory of
    the executors: larger chunks repeat fewer pairs.
    """
    spark = docs.sparkSession
    ship(spark)
    part = F.when(held_out, 1).when(weights_fold, 2).otherwise(0).cast("int")
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), part.alias("part"),
                       F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    chunks = stored(_chunks(rows, chunk_bytes), "chunks")
    requests = _requests(chunks, 4 * partitions(spark))
    answers = stored(requests.groupBy("owner").applyInArrow(
        _total, "chunk long, owner int, kind int, counts binary, fold_counts binary, tokens long, distinct long, "
                "fold_tokens long"), "counts")
    sums = answers.where("chunk < 0").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c)
                                            for c in ("tokens", "distinct", "fold_tokens"))).first()
    per_chunk = answers.where("chunk >= 0")
    cells = (chunks.select("chunk", "fold_docs").groupBy("chunk")
             .cogroup(per_chunk.select("chunk", "owner", "kind", "fold_counts").groupBy("chunk"))
             .applyInArrow(_cells(sums.tokens - sums.fold_tokens, sums.distinct),
                           "bucket int, q_pair int, q_flat int, n long, pair double, flat double")
             .groupBy("bucket", "q_pair", "q_flat").agg(F.sum("n").alias("n"), F.sum("pair").alias("pair"),
                                                        F.sum("flat").alias("flat")).toPandas())
    n = cells["n"].to_numpy(np.float64)
    weights = learn_weights(cells["bucket"].to_numpy(), n, cells["pair"].to_numpy() / np.maximum(n, 1),
                            cells["flat"].to_numpy() / np.maximum(n, 1), cells["q_flat"].to_numpy() != _NONE)
    return (chunks.select("chunk", "docs").groupBy("chunk")
            .cogroup(per_chunk.select("chunk", "owner", "kind", "counts").groupBy("chunk"))
            .applyInArrow(_scores(sums.tokens, sums.distinct, weights, kind),
                          f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                          "base_score double, score double").withColumnRenamed("id", id_column))
