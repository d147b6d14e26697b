"""Line dedup: later copies of repeated line runs are deleted, found by a suffix array over line-ID sequences.

Every line with a word is a position, named by a hash of its trimmed text. Prefix doubling ranks all positions by the
2^k lines that start there: round k pairs a position's rank with the rank 2^k lines further on, sorts the distinct
pairs over the cluster and numbers them in order. Sorted by such a rank, the positions are the suffix array to depth
2^k, and positions of equal rank are its longest-common-prefix intervals of that depth. A pair seen once
starts no repeated run and leaves the rounds.

A run counts if it holds `min_words` words. A line is deleted if it lies in such a run that also occurs earlier (order: id,
then line). It is enough to look at the shortest windows with `min_words` words, one starting and one ending at each line:
a maximal repeated run is the union of those inside it. A window of n lines, 2^k <= n < 2^(k+1), is named by the ranks of
its first and last 2^k lines, so equal names are equal windows. As a line has a word, n is at most `min_words` and the
number of rounds is its logarithm. The first copy of every line in the corpus always stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from spendwatch.llm.common import (
    BYTE_VALUES, IS_SPACE, free_name, partitions, segment_hash, ship, slices, stored, text_bytes)

MIN_WORDS = 50
_DOC = ["_doc", "_doc2"]


def _lines(data: np.ndarray, offsets: np.ndarray, min_words: int):
    """For all lines with a word: document number, number in the document, name, and the sizes of the shortest windows
    that start and end there (0: none)."""
    newline = data == 10
    blank = IS_SPACE[data]
    # A line starts at a document's start or after a newline; its trimmed part runs from its first to its last mark.
    starts = np.unique(np.concatenate([offsets[:-1][offsets[:-1] < offsets[1:]], np.flatnonzero(newline) + 1]))
    starts = starts[starts < len(data)]
    ends = np.append(starts[1:], len(data))
    marks = np.flatnonzero(~blank)
    low, high = np.searchsorted(marks, starts), np.searchsorted(marks, ends)
    full = high > low
    first, last = marks[low[full]], marks[high[full] - 1] + 1
    word_start = ~blank
    word_start[1:] &= blank[:-1]
    word_start[offsets[:-1][offsets[:-1] < offsets[1:]]] = ~blank[offsets[:-1][offsets[:-1] < offsets[1:]]]
    words_before = np.concatenate([[0], np.cumsum(word_start)])
    words = words_before[last] - words_before[first] + (~word_start[first]).astype(np.int64)
    doc = np.searchsorted(offsets, first, side="right") - 1
    n = len(doc)
    begin = np.searchsorted(doc, doc, side="left")
    number = np.arange(n) - begin
    end = np.searchsorted(doc, doc, side="right")
    total = np.concatenate([[0], np.cumsum(words)])
    stop = np.searchsorted(total, total[:-1] + min_words, side="left")  # the window [i, stop) has enough words
    ahead = np.where(stop <= end, stop - np.arange(n), 0)
    start = np.searchsorted(total, total[1:] - min_words, side="right") - 1  # the window [start, i]
    behind = np.where((start >= begin) & (total[1:] >= min_words), np.arange(n) - start + 1, 0)
    name = segment_hash(BYTE_VALUES[data], first, last).astype(np.int64)
    return doc, number, name, ahead, behind


def _positions(docs: DataFrame, min_words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            doc, number, name, ahead, behind = _lines(*text_bytes(batch.column("text")), min_words)
            rows = batch.select(["id", *_DOC]).take(pa.array(doc))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(number.astype(np.int32)), pa.array(name), pa.array(ahead.astype(np.int32)),
                 pa.array(behind.astype(np.int32))], ["id", *_DOC, "i", "name", "ahead", "behind"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", *_DOC, "text").mapInArrow(
        run, f"id {kind}, _doc long, _doc2 int, i int, name long, ahead int, behind int")


def _numbered(pairs: DataFrame, *columns: str) -> DataFrame:
    """Number distinct keys in sorted order: by ranges over the cluster, then inside each range."""
    ordered = pairs.repartitionByRange(partitions(pairs.sparkSession), *columns).sortWithinPartitions(*columns)
    return stored(ordered.withColumn("rank", F.monotonically_increasing_id()), "ranks")


def _repeated(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1").drop("n")


def suffix_ranks(positions: DataFrame, max_lines: int) -> DataFrame:
    """(document, i, k, rank) for every position whose 2^k lines occur more than once, 2^k <= max_lines."""
    names = _numbered(_repeated(positions, "name"), "name")
    level = stored(positions.select(*_DOC, "i", "name").join(names, "name").select(*_DOC, "i", "rank"), "level")
    levels = [level.withColumn("k", F.lit(0))]
    k = 0
    while 2 << k <= max_lines:
        further = level.select(*_DOC, (F.col("i") - (1 << k)).alias("i"), F.col("rank").alias("next"))
        pairs = level.join(further, [*_DOC, "i"])
        ranks = _numbered(_repeated(pairs, "rank", "next").withColumnRenamed("rank", "own"), "own", "next")
        level = stored(pairs.withColumnRenamed("rank", "own").join(ranks, ["own", "next"])
                       .select(*_DOC, "i", "rank"), "level")
        k += 1
        if level.isEmpty():
            break
        levels.append(level.withColumn("k", F.lit(k)))
    out = levels[0]
    for other in levels[1:]:
        out = out.unionByName(other)
    return out


def repeated_windows(positions: DataFrame, ranks: DataFrame) -> DataFrame:
    """(document, start, size) of every window that also occurs earlier."""
    both = positions.select("id", *_DOC, F.explode(F.array(
        F.struct(F.col("i").alias("start"), F.col("ahead").alias("size")),
        F.struct((F.col("i") - F.col("behind") + 1).alias("start"), F.col("behind").alias("size")))).alias("w"))
    windows = (both.select("id", *_DOC, "w.*").where("size > 0").distinct()
               .withColumn("k", F.floor(F.log2("size") + 1e-9).cast("int")))
    first = ranks.select(*_DOC, F.col("i").alias("start"), "k", F.col("rank").alias("a"))
    last = ranks.select(*_DOC, F.col("i").alias("tail"), "k", F.col("rank").alias("b"))
    tail = F.col("start") + F.col("size") - F.expr("shiftleft(1, k)")
    named = stored(windows.join(first, [*_DOC, "start", "k"]).withColumn("tail", tail)
                   .join(last, [*_DOC, "tail", "k"]).select("id", *_DOC, "start", "size", "a", "b"), "windows")
    groups = (named.groupBy("size", "a", "b")
              .agg(F.min(F.struct("id", *_DOC, "start")).alias("first"), F.count("*").alias("n")).where("n > 1"))
    return (named.join(groups, ["size", "a", "b"])
            .where(~F.col("first").eqNullSafe(F.struct("id", *_DOC, "start"))).select(*_DOC, "start", "size"))


def delete_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """All rows and columns, `text` without the later copies, with n_lines (lines with a word) and n_deleted.

    Null texts stay null and have no lines; lines without a word are no part of runs and stay. Documents are ordered by id
    (null first), equal ids by a hash. Rows that repeat id and text count as one document and are cut alike. Columns named
    n_lines or n_deleted are replaced. Texts of any length are read whole; a run may repeat inside one text.
    """
    ship(docs.sparkSession)
    docs = docs.drop("n_lines", "n_deleted")
    one, two, cuts = (free_name(docs, name) for name in (*_DOC, "_spans"))
    keyed = docs.withColumns({one: F.xxhash64(F.col(f"`{id_column}`"), F.col(f"`{text}`")),
                              two: F.hash(F.col(f"`{text}`"), F.col(f"`{id_column}`"))})
    plain = keyed.select(F.col(f"`{id_column}`").alias("id"), F.col(one).alias("_doc"), F.col(two).alias("_doc2"), F.col(f"`{text}`").cast("string").alias("text"))
    positions = stored(_positions(plain, min_words).dropDuplicates([*_DOC, "i"]), "lines")
    ranks = suffix_ranks(positions, min_words)
    spans = (repeated_windows(positions, ranks).groupBy(*_DOC)
             .agg(F.sort_array(F.collect_set(F.struct("start", "size"))).alias(cuts))
             .withColumnsRenamed({"_doc": one, "_doc2": two}))
    joined = keyed.join(spans, [one, two], "left").drop(one, two)
    names = docs.columns
    schema = StructType(list(docs.schema.fields)).add("n_lines", "long").add("n_deleted", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 4 << 20):
            texts, counts, deleted = [], [], []
            for value, spans_ in zip(batch.column(text).to_pylist(), batch.column(cuts).to_pylist()):
                cut, n, gone = without(value, [(s["start"], s["size"]) for s in spans_ or ()])
                texts.append(cut)
                counts.append(n)
                deleted.append(gone)
            columns = [pa.array(texts, batch.column(c).type) if c == text else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(deleted, pa.int64())],
                                             [*names, "n_lines", "n_deleted"])

    return joined.mapInArrow(run, schema)


_TRIM = " \t\n\v\f\r"


def without(text: str | None, spans: list[tuple[int, int]]) -> tuple[str | None, int, int]:
    """The text without the lines of the spans (start, size; lines without a word do not count), the number of lines
    with a word, and how many of them went."""
    if not text:
        return text, 0, 0
    lines = text.split("\n")
    gone = {i for start, size in spans for i in range(start, start + size)}
    kept, number = [], -1
    for line in lines:
        if line.strip(_TRIM):
            number += 1
            if number in gone:
                continue
        kept.append(line)
    return "\n".join(kept) if gone else text, number + 1, len(gone)
