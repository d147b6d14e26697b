"""Document fingerprints by locally consistent parsing.

A level turns a sequence of names into a shorter one. Runs of one name fold first, so neighbours differ. Deterministic
coin tossing then gives each name a label from the lowest bit in which it differs from the name before it (position and
value); repeated a few times, labels are below 6 and neighbours still differ. A phrase starts at every local maximum of
the labels, and its name is a hash of what it holds. A border depends on the few names around it alone, so
equal substrings are cut alike, whatever stands before them, except at their edges.

A fingerprint is the `size` smallest hashes of a text's distinct phrase names of levels 2 and up (8 hex digits each,
ascending). Texts with fewer than 8 phrases on level 2 add level 1. The likeness of two fingerprints is Dice's
measure 2J / (1 + J) of the estimated share J of common names: near the share of text in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from spendwatch.llm.common import BYTE_VALUES, mix, partitions, segment_hash, ship, slices, stored, text_bytes

SIZE, LEVELS, FEW = 64, 7, 8
_DEBRUIJN = np.uint64(0x03F79D71B4CB0A89)
with np.errstate(over="ignore"):
    _INDEX = np.zeros(64, np.uint8)
    _INDEX[((np.uint64(1) << np.arange(64, dtype=np.uint64)) * _DEBRUIJN) >> np.uint64(58)] = np.arange(64)


def _small_labels() -> np.ndarray:
    """The label of every pair (label before, label), for labels below 128."""
    before, own = np.meshgrid(np.arange(128), np.arange(128), indexing="ij")
    differ = before ^ own
    lowest = np.zeros_like(differ)
    for bit in range(6, -1, -1):
        lowest[differ >> bit & 1 == 1] = bit
    return (2 * lowest + (own >> lowest & 1)).astype(np.uint8).reshape(-1)


_LABEL = _small_labels()


def _labels(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below 6 whose neighbours differ; `first` marks where texts begin."""
    differ = np.empty_like(names)
    differ[1:] = names[1:] ^ names[:-1]
    differ[first] = 1
    with np.errstate(over="ignore"):
        lowest = _INDEX[((differ & (~differ + np.uint64(1))) * _DEBRUIJN) >> np.uint64(58)]
    label = 2 * lowest + ((names >> lowest.astype(np.uint64)) & np.uint64(1)).astype(np.uint8)
    for _ in range(4):
        pair = np.empty(len(label), np.uint16)
        pair[1:] = label[:-1]
        pair[first] = label[first] ^ 1
        label = _LABEL[(pair << np.uint16(7)) | label]
    return label


def _next_level(names: np.ndarray, offsets: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins = np.empty(len(names), bool)
    begins[1:] = names[1:] != names[:-1]
    begins[first] = True
    if not begins.all():  # fold runs
        at = np.flatnonzero(begins)
        lengths = np.diff(np.append(at, len(names)))
        offsets = np.searchsorted(at, offsets)
        names = names[at].copy()
        many = lengths > 1
        with np.errstate(over="ignore"):
            names[many] = mix(names[many] + lengths[many].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        first = offsets[:-1][offsets[:-1] < offsets[1:]]
    label = _labels(names, first)
    begins = np.zeros(len(names), bool)
    begins[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    begins[last] = False
    begins[first] = True
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(names))
    with np.errstate(over="ignore"):
        phrase = mix(segment_hash(names, starts, ends) + np.uint64(level))
    return phrase, np.searchsorted(starts, offsets)


def phrases(data: np.ndarray, offsets: np.ndarray, levels: int = LEVELS) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each level from 1 on: the phrase names of all texts, and where each text's names start."""
    names, out = BYTE_VALUES[data], []
    for level in range(1, levels + 1):
        if len(names):
            names, offsets = _next_level(names, offsets, level)
        out.append((names, offsets))
    return out


def _distinct(values: np.ndarray) -> np.ndarray:
    """The different values in ascending order, by one sort: np.unique fills a hash table first, which took more than half
    of the time of this module."""
    values = np.sort(values)
    first = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=first[1:])
    return values[first]


def sketches(data: np.ndarray, offsets: np.ndarray, size: int = SIZE, levels: int = LEVELS) -> list[np.ndarray]:
    """The fingerprint of each text, as sorted unsigned 32-bit values."""
    n = len(offsets) - 1
    by_level = phrases(data, offsets, levels)
    few = np.diff(by_level[1][1]) < FEW
    keys = []
    for level, (names, at) in enumerate(by_level, 1):
        doc = np.repeat(np.arange(n, dtype=np.uint64), np.diff(at))
        key = doc << np.uint64(32) | names >> np.uint64(32)
        keys.append(key[few[doc.astype(np.int64)]] if level == 1 else key)
    key = _distinct(np.concatenate(keys))
    at = np.searchsorted(key, np.arange(n + 1, dtype=np.uint64) << np.uint64(32))
    values = (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return [values[a:min(b, a + size)] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def fingerprint_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Dice's measure from the smallest `size` values of the union; two empty texts are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate((a, b)))
    twice = np.flatnonzero(both[1:] == both[:-1])  # a value of both fingerprints stands twice
    union = len(both) - len(twice)
    if len(a) >= size or len(b) >= size:  # beyond `size` values, a sketch is silent
        union = min(union, size)
    common = np.count_nonzero(twice - np.arange(len(twice)) < union)
    j = common / union
    return 2 * j / (1 + j)


def _of_texts(texts: list[str]) -> list[np.ndarray]:
    data, offsets = text_bytes(pa.array(texts, pa.large_string()))
    return sketches(data, offsets)


def edited(text: str, following: str) -> str:
    """The text with its last quarter (rounded down) replaced by the beginning of the following text."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


def _finished(ids: list, texts: list[str], own: list[np.ndarray], following: list[str],
              next_own: list[np.ndarray]) -> dict[str, list]:
    changed = [edited(t, f) for t, f in zip(texts, following)]
    theirs = _of_texts(changed)
    return {"id": ids, "n_chars": [len(t) for t in texts],
            "edited_sha256": [hashlib.sha256(c.encode()).hexdigest() for c in changed],
            "fingerprint": [fingerprint_text(s) for s in own],
            "edited_fingerprint": [fingerprint_text(s) for s in theirs],
            "near_edited": [likeness(a, b) for a, b in zip(own, theirs)],
            "near_next": [likeness(a, b) for a, b in zip(own, next_own)]}


_RESULT = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
           "near_next double")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fingerprint) of every row; a null text counts as empty and has the empty fingerprint."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            found = sketches(*text_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([fingerprint_text(s) for s in found], pa.string())],
                ["id", "fingerprint"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, fingerprint string").withColumnRenamed("id", id_column)


def compare_with_edits(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint every text and its edited text, whose last quarter comes from the next document by id.

    Null texts count as empty. Documents are ordered by id (null first), equal ids by a hash of the text, then the text;
    the first follows the last. One row per input row, repeated rows included; other columns are ignored; an empty table
    gives an empty result; a single document follows itself.

    Texts are dealt out by ranges of ids once. Only the first and the last document of each range meet again, in a
    second small step over a stored table.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(f"`{id_column}`").alias("id"),
                       F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ranged = (rows.repartitionByRange(partitions(spark), "id", "tie").sortWithinPartitions("id", "tie", "text")
              .select("id", "text"))
    fields = [f.split() for f in _RESULT.split(", ")]
    arrow = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: tuple | None = None  # the row before, which waits for its next one
        id_type = None

        def out(columns: dict[str, list], edge: int, texts: list[str] | None = None) -> pa.RecordBatch:
            n = len(columns["id"])
            arrays = [pa.array([edge] * n, pa.int32()), pa.array([part] * n, pa.int32()),
                      pa.array(texts or [None] * n, pa.string()), pa.array(columns["id"], id_type)]
            arrays += [pa.array(columns.get(name, [None] * n), arrow[kind_]) for name, kind_ in fields]
            return pa.RecordBatch.from_arrays(arrays, ["edge", "part", "text", "id", *(name for name, _ in fields)])

        for batch in slices(batches, "text", 2 << 20):
            id_type = batch.column("id").type
            ids, texts = batch.column("id").to_pylist(), batch.column("text").to_pylist()
            own = _of_texts(texts)
            if held is None:
                yield out({"id": ids[:1]}, 1, texts[:1])
            else:
                ids, texts, own = [held[0], *ids], [held[1], *texts], [held[2], *own]
            held = (ids[-1], texts[-1], own[-1])
            if len(ids) > 1:
                yield out(_finished(ids[:-1], texts[:-1], own[:-1], texts[1:], own[1:]), 0)
        if held is not None:
            yield out({"id": [held[0]]}, 2, [held[1]])

    done = stored(ranged.mapInArrow(run, f"edge int, part int, text string, id {kind}, {_RESULT}"), "fingerprints")
    edges = done.where("edge > 0").select("edge", "part", "text", "id")
    # As many rows as there are ranges: which range follows which.
    order = sorted(r.part for r in edges.where("edge = 1").select("part").collect())
    if not order:
        return done.where("edge = 0").select(F.col("id").alias(id_column), *(name for name, _ in fields))
    follows = spark.createDataFrame(list(zip(order, [*order[1:], order[0]])), "part int, next_part int")
    firsts = edges.where("edge = 1").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    pairs = edges.where("edge = 2").select("part", "id", "text").join(follows, "part").join(firsts, "next_part")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            texts, following = batch.column("text").to_pylist(), batch.column("following").to_pylist()
            columns = _finished(batch.column("id").to_pylist(), texts, _of_texts(texts), following, _of_texts(following))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(columns[name], arrow[kind_]) for name, kind_ in fields)],
                ["id", *(name for name, _ in fields)])

    last = pairs.select("id", "text", "following").mapInArrow(finish, f"id {kind}, {_RESULT}")
    return (done.where("edge = 0").select("id", *(name for name, _ in fields)).unionByName(last)
            .withColumnRenamed("id", id_column))
