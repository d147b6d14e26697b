"""Sum-of-squares online packing of documents into fixed windows.

Every task packs the documents it reads, one after the other: `levels[h]` counts its partially filled windows
that hold h tokens, and a document goes into the level that leaves the sum of the squared counts smallest (a
window that becomes full leaves the sum; ties go to the fuller window). A document beyond one window is cut: whole
windows first, the rest is placed. Nothing is shuffled; a task holds at most `max_open` open windows. Beyond that,
and at the end of its input, it joins the open windows end to end and cuts them into full ones. The last rest is
cut at powers of two, which need no padding, so no sequence is padded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from spendwatch.llm.chunks import ChunkEncoder
from spendwatch.llm.common import ship, slices
from spendwatch.llm.lexicon import WordEncoder, WordTokenizer

# A piece: document number in the task's output, tokens before it, its ids.
Piece = tuple[tuple, int, np.ndarray]


class Packer:
    def __init__(self, window: int = 4096, max_open: int = 1024):
        self.window, self.max_open = window, max_open
        self.levels = np.zeros(window + 1, np.int64)
        self._open: list[list[list[Piece]]] = [[] for _ in range(window + 1)]
        self._n_open = 0
        self._finished: list[list[Piece]] = []

    def level_for(self, size: int) -> int:
        """The level (0: a new window) whose choice keeps the sum of squared counts smallest."""
        top = self.window - size
        counts = self.levels[:top + 1]
        change = 2 * self.levels[size:] + 1  # the level reached gains a window
        change[top] = 0  # a full window counts no more
        change[1:] -= 2 * counts[1:] - 1  # the level left loses one
        change[1:][counts[1:] == 0] = np.iinfo(np.int64).max
        return top - int(change[::-1].argmin())

    def add(self, doc: tuple, ids: np.ndarray) -> None:
        whole = len(ids) // self.window * self.window
        for start in range(0, whole, self.window):
            self._finished.append([(doc, start, ids[start:start + self.window])])
        if whole < len(ids):
            self._place((doc, whole, ids[whole:].copy()))
        if self._n_open > self.max_open:
            self._put(self._join(), None)

    def _place(self, piece: Piece) -> None:
        size = len(piece[2])
        level = self.level_for(size)
        pieces = []
        if level:
            pieces = self._open[level].pop()
            self.levels[level] -= 1
            self._n_open -= 1
        self._put(pieces, piece)

    def _put(self, pieces: list[Piece], piece: Piece | None) -> None:
        pieces = pieces + [piece] if piece else pieces
        filled = sum(len(p[2]) for p in pieces)
        if filled == self.window:
            self._finished.append(pieces)
        elif filled:
            self._open[filled].append(pieces)
            self.levels[filled] += 1
            self._n_open += 1

    def _join(self) -> list[Piece]:
        """Cut all open windows, the fullest first, into full windows; returns the pieces that are left over."""
        current, room = [], self.window
        for level in range(self.window, 0, -1):
            for pieces in self._open[level]:
                for doc, start, ids in pieces:
                    while len(ids):
                        part, ids = ids[:room], ids[room:]
                        current.append((doc, start, part))
                        start, room = start + len(part), room - len(part)
                        if not room:
                            self._finished.append(current)
                            current, room = [], self.window
            self._open[level] = []
        self.levels[:] = 0
        self._n_open = 0
        return current

    def take(self) -> list[list[Piece]]:
        out, self._finished = self._finished, []
        return out

    def close(self) -> list[list[Piece]]:
        rest = self._join()
        left = sum(len(p[2]) for p in rest)
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            part: list[Piece] = []
            while size:
                doc, start, ids = rest.pop(0)
                if len(ids) > size:
                    rest.insert(0, (doc, start + size, ids[size:]))
                    ids = ids[:size]
                part.append((doc, start, ids))
                size -= len(ids)
            self._finished.append(part)
        return self.take()


def pack(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text: str = "text", window: int = 4096,
         end_id: int = 2, max_open: int = 1024) -> DataFrame:
    """Pack all documents. One row per piece: the id column, start (tokens of the document before the piece), length,
    ids (binary: little-endian unsigned 32-bit integers), doc_tokens, sequence_id, offset (in the sequence).

    A null or empty text is its end id alone. Repeated rows and null ids are documents of their own; other columns are
    ignored; an empty table gives no sequence. A sequence holds `window` ids, or a power of two of them.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    schema = "id " + kind + ", start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(WordEncoder(WordTokenizer(tokenizer_path), None).resolve)
        packer = Packer(window, max_open)
        number = TaskContext.get().partitionId() << 36
        id_type = pa.int64()

        def rows(sequences: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal number
            table: list[list] = [[] for _ in range(7)]
            for pieces in sequences:
                offset = 0
                for (doc, total), start, ids in pieces:
                    for column, value in zip(table, (doc, start, len(ids), ids.astype("<u4").tobytes(), total,
                                                     number, offset)):
                        column.append(value)
                    offset += len(ids)
                number += 1
            kinds = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(table, kinds)],
                ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for batch in slices(batches, "text", 4 << 20):
            id_type = batch.column("id").type
            flat, starts = encoder.encode(batch.column("text").to_pylist())
            for doc, begin, end in zip(batch.column("id").to_pylist(), starts[:-1], starts[1:]):
                packer.add((doc, int(end - begin) + 1), np.append(flat[begin:end], np.uint32(end_id)))
            yield rows(packer.take())
        yield rows(packer.close())

    return docs.mapInArrow(run, schema).withColumnRenamed("id", id_column)
