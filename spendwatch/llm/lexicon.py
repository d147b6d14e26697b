"""Subword encoding by a minimal acyclic transducer over frequent words, with exact merges for all others.

1. Count the words of all texts and keep the most frequent ones: whole classes of frequency, as many as fit
   `lexicon_words`.
2. Compile them into a minimal acyclic automaton: equal suffixes share states. Every state knows how many words
   leave through it, so a walk adds up a word's number, and that number leads to the word's ids (the output).
3. Write the automaton into one file in the shared folder; Spark sends it to the executors, and their tasks
   map it into memory.
4. Cut every text into words, walk the automaton with all distinct words at once, and merge the words it does not
   hold by the tokenizer's own merge list. The lexicon's size changes the speed, never a result.
"""

from __future__ import annotations

import heapq
import json
import mmap
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F

from spendwatch.llm.chunks import CACHE_CHUNKS, CACHE_IDS, ChunkEncoder, Numbers, chunks_of, take_segments
from spendwatch.llm.common import shared_path, ship, slices, stored

LEXICON_WORDS = 65_536
# Longer words (in bytes) are always merged: the driver's automaton has a state for each byte of its words.
LEXICON_WORD_BYTES = 128
# Memory bound of the counting tasks: distinct chunks held before partial counts are handed on.
COUNT_CHUNKS = 300_000
_FIELDS = ("state_first", "labels", "targets", "skipped", "final", "out_first", "out_ids")
_TYPES = {"state_first": np.int32, "labels": np.uint8, "targets": np.int32, "skipped": np.int32,
          "final": np.uint8, "out_first": np.int32, "out_ids": np.uint32}


def _byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies write for every byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class WordTokenizer:
    """A tokenizer file's own rules: lower-cased words, byte letters, merges with a word-end mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        pattern = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        self._word = regex.compile(pattern)
        self._with_ends = regex.compile(pattern + "|\n")
        letters = _byte_letters()
        self._letters = letters
        self.strings = [""] * (1 + max([*self.vocab.values(), *self.special.values()]))
        for table in (self.vocab, self.special):
            for token, number in table.items():
                self.strings[number] = token
        self._bytes = [s.encode() for s in self.strings]

    def words(self, chunks: list[str]) -> tuple[list[str], np.ndarray]:
        """The words of chunks without white space, and how many each chunk has; special tokens stand alone."""
        odd = [i for i, chunk in enumerate(chunks) if "<|" in chunk and self._special.search(chunk)]
        joined = "\n".join(["", *chunks, ""]) if not odd else "\n".join(
            ["", *("" if i in set(odd) else chunk for i, chunk in enumerate(chunks)), ""])
        found = self._with_ends.findall(self._normal(joined))
        ends = np.flatnonzero(np.fromiter((w == "\n" for w in found), bool, len(found)))
        counts = np.diff(ends) - 1
        words = [w for w in found if w != "\n"]
        if odd:  # put the words of chunks with special tokens where they belong
            starts = np.concatenate([[0], np.cumsum(counts)])
            pieces, at = [], 0
            for i in odd:
                pieces += [*words[at:starts[i]], *(own := self._special_words(chunks[i]))]
                counts[i], at = len(own), starts[i]
            words = [*pieces, *words[at:]]
        return words, counts

    @staticmethod
    def _normal(text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower() would look at its neighbours
        return text.lower()

    def _special_words(self, chunk: str) -> list[str]:
        out: list[str] = []
        for i, part in enumerate(self._special.split(chunk)):
            out.extend([part] if i % 2 else self._word.findall(self._normal(part)))
        return out

    def merge(self, word: str) -> list[int]:
        """Ids of one word, by applying the lowest-ranked merge until none is left."""
        if word in self.special:
            return [self.special[word]]
        letters = self._letters
        parts = list(word) if word.isascii() and word.isprintable() else [letters[b] for b in word.encode()]
        parts[-1] += self.end
        rank, never, size = self.ranks.get, len(self.ranks), len(parts)
        # A heap of (rank, place) over a linked list of parts; an entry counts while its place still has that rank.
        order = [rank(pair, never) for pair in zip(parts, parts[1:])] + [never]
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(r, i) for i, r in enumerate(order) if r != never]
        heapq.heapify(heap)

        def ranked(i: int) -> None:
            j = after[i]
            order[i] = rank((parts[i], parts[j]), never) if j < size else never
            if order[i] != never:
                heapq.heappush(heap, (order[i], i))

        while heap:
            best, i = heapq.heappop(heap)
            if order[i] != best:
                continue
            j = after[i]
            parts[i] += parts[j]
            parts[j], order[j] = "", never
            after[i] = after[j]
            if after[i] < size:
                before[after[i]] = i
            ranked(i)
            if before[i] >= 0:
                ranked(before[i])
        vocab = self.vocab
        return [vocab[p] for p in parts if p]

    def _prepare(self) -> None:
        """Tables for merging many words at once: a hash table from a pair of ids to the rank of its merge."""
        vocab, letters = self.vocab, self._letters
        self._first_ids = np.asarray([vocab[c] for c in letters], np.int64)
        self._last_ids = np.asarray([vocab[c + self.end] for c in letters], np.int64)
        self._merged_ids = np.asarray([vocab[a + b] for a, b in self.ranks], np.int64)
        keys = np.asarray([vocab[a] << 20 | vocab[b] for a, b in self.ranks], np.int64)
        size = 1 << (len(keys) * 4 - 1).bit_length()
        self._slot_keys, self._slot_ranks = np.full(size, -1, np.int64), np.full(size, len(keys), np.int32)
        left = np.arange(len(keys))
        slot = self._slots(keys)
        self._probes = 0
        while len(left):  # each round, every slot takes one of the keys that want it; the others try the next slot
            free = self._slot_keys[slot] < 0
            self._slot_keys[slot[free]] = keys[left[free]]
            placed = self._slot_keys[slot] == keys[left]
            self._slot_ranks[slot[placed]] = left[placed]
            left, slot = left[~placed], (slot[~placed] + 1) & (size - 1)
            self._probes += 1

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(40)).astype(np.int64) & (len(self._slot_keys) - 1)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 20 | right
        slot = self._slots(keys)
        rank = np.full(len(keys), len(self.ranks), np.int32)
        open_ = np.arange(len(keys))
        for _ in range(self._probes):
            held = self._slot_keys[slot]
            hit = held == keys[open_]
            rank[open_[hit]] = self._slot_ranks[slot[hit]]
            go = ~hit & (held >= 0)
            if not go.any():
                break
            open_, slot = open_[go], (slot[go] + 1) & (len(self._slot_keys) - 1)
        return rank

    def merge_many(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """merge() of many words in step: every round applies each word's lowest-ranked merge."""
        if not hasattr(self, "_probes"):
            self._prepare()
        codes = [w.encode() for w in words]
        sizes = np.fromiter(map(len, codes), np.int64, len(codes))
        flat_parts, order_parts, size_parts = [], [], []
        low = 0
        for high in (8, 16, 32):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            if self.special:
                rows = rows[np.fromiter((words[i] not in self.special for i in rows), bool, len(rows))]
            if len(rows):
                ids, kept = self._merge_block([codes[i] for i in rows], sizes[rows], high)
                flat_parts.append(ids)
                size_parts.append(kept)
                order_parts.append(rows)
        done = np.zeros(len(words), bool)
        for rows in order_parts:
            done[rows] = True
        for i in np.flatnonzero(~done):  # very long words and special tokens
            own = self.merge(words[i]) if words[i] else []
            flat_parts.append(np.asarray(own, np.uint32))
            size_parts.append(np.asarray([len(own)]))
            order_parts.append(np.asarray([i]))
        if not order_parts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        order, kept, flat = np.concatenate(order_parts), np.concatenate(size_parts), np.concatenate(flat_parts)
        begin = np.cumsum(kept) - kept
        back = np.argsort(order)
        kept, begin = kept[back], begin[back]
        ends = np.cumsum(kept)
        return flat[np.arange(len(flat)) + np.repeat(begin - (ends - kept), kept)], kept

    def _merge_block(self, codes: list[bytes], sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        n, never = len(codes), np.int32(len(self.ranks))
        data = np.frombuffer(b"".join(c.ljust(width, b"\0") for c in codes), np.uint8).reshape(n, width)
        symbols = self._first_ids[data]
        rows = np.arange(n)
        symbols[rows, sizes - 1] = self._last_ids[data[rows, sizes - 1]]
        place = np.arange(width)
        inside = place[None, :] < sizes[:, None]
        ranks = np.full((n, width), never, np.int32)
        pairs = place[None, :] < sizes[:, None] - 1
        at_row, at = np.nonzero(pairs)
        ranks[at_row, at] = self._rank(symbols[at_row, at], symbols[at_row, at + 1])
        after = np.broadcast_to(place + 1, (n, width)).copy()
        before = np.broadcast_to(place - 1, (n, width)).copy()
        live = rows
        while len(live):
            i = ranks[live].argmin(axis=1)
            best = ranks[live, i]
            go = best < never
            live, i, best = live[go], i[go], best[go]
            if not len(live):
                break
            j = after[live, i]
            symbols[live, i] = self._merged_ids[best]
            inside[live, j] = False
            ranks[live, j] = never
            k = after[live, j]
            after[live, i] = k
            ranks[live, i] = never
            has = k < sizes[live]
            r, a, b = live[has], i[has], k[has]
            before[r, b] = a
            ranks[r, a] = self._rank(symbols[r, a], symbols[r, b])
            h = before[live, i]
            has = h >= 0
            r, a, b = live[has], h[has], i[has]
            ranks[r, a] = self._rank(symbols[r, a], symbols[r, b])
        return symbols[inside].astype(np.uint32), inside.sum(axis=1)

    def decode(self, ids: list[int]) -> bytes:
        """The decoded text in UTF-8: this tokenizer has no decoder, so its tokens are joined by a space."""
        return b" ".join(map(self._bytes.__getitem__, ids))


def build_automaton(entries: dict[str, list[int]]) -> dict[str, np.ndarray]:
    """The minimal acyclic automaton of the words, by adding them in sorted order and sharing equal states."""
    words = sorted(entries, key=str.encode)
    register: dict[tuple, int] = {}
    frozen: list[tuple[bool, tuple[tuple[int, int], ...], int]] = []

    def freeze(node: list) -> int:
        final, arcs = node
        key = (final, tuple(arcs))
        if key not in register:
            register[key] = len(frozen)
            frozen.append((final, key[1], final + sum(frozen[t][2] for _, t in arcs)))
        return register[key]

    # The open path: one node per byte of the last word, not yet shared.
    path: list[list] = [[False, []]]
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            number = freeze(path.pop())
            path[-1][1].append((last[len(path) - 1], number))

    for word in words:
        code = word.encode()
        shared = 0
        while shared < min(len(code), len(last)) and code[shared] == last[shared]:
            shared += 1
        close(shared)
        path.extend([False, []] for _ in range(len(code) - shared))
        path[-1][0] = True
        last = code
    close(0)
    root = freeze(path[0])
    arrays: dict[str, list] = {name: [] for name in _FIELDS}
    # The root becomes state 0, so that a walk needs no header.
    number = {root: 0}
    for state in range(len(frozen)):
        if state != root:
            number[state] = len(number)
    order = sorted(number, key=number.__getitem__)
    for state in order:
        final, arcs, _ = frozen[state]
        arrays["state_first"].append(len(arrays["labels"]))
        arrays["final"].append(final)
        before = int(final)
        for label, target in arcs:
            arrays["labels"].append(label)
            arrays["targets"].append(number[target])
            arrays["skipped"].append(before)
            before += frozen[target][2]
    arrays["state_first"].append(len(arrays["labels"]))
    arrays["out_first"].append(0)
    for word in words:
        arrays["out_ids"].extend(entries[word])
        arrays["out_first"].append(len(arrays["out_ids"]))
    return {name: np.asarray(arrays[name], dtype=_TYPES[name]) for name in _FIELDS}


def automaton_bytes(arrays: dict[str, np.ndarray]) -> bytes:
    head = np.asarray([len(arrays[name]) for name in _FIELDS], dtype=np.int64).tobytes()
    return head + b"".join(arrays[name].tobytes().ljust(-(-arrays[name].nbytes // 8) * 8, b"\0") for name in _FIELDS)


class Transducer:
    """Walks a compiled automaton that lies in a buffer, such as a file mapped into memory."""

    def __init__(self, buffer):
        sizes = np.frombuffer(buffer, np.int64, len(_FIELDS))
        at = 8 * len(_FIELDS)
        for name, size in zip(_FIELDS, sizes):
            kind = np.dtype(_TYPES[name])
            setattr(self, name, np.frombuffer(buffer, kind, size, at))
            at += -(-int(size) * kind.itemsize // 8) * 8
        # An arc is found by its state and label in one sorted list.
        states = np.repeat(np.arange(len(self.state_first) - 1), np.diff(self.state_first))
        self._arcs = states * 256 + self.labels

    @classmethod
    def from_file(cls, path: str) -> Transducer:
        with open(path, "rb") as file:
            return cls(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))

    def numbers(self, words: list[str]) -> np.ndarray:
        """Each word's number in the lexicon, or -1. All words walk one byte at a time together."""
        codes = pa.array(words, pa.large_binary()) if words and isinstance(words[0], bytes) else pa.array(
            [w.encode() for w in words], pa.large_binary())
        result = np.full(len(words), -1, np.int64)
        if not words or not len(self._arcs):
            return result
        offsets = np.frombuffer(codes.buffers()[1], np.int64)[:len(words) + 1]
        data = np.frombuffer(codes.buffers()[2], np.uint8)
        sizes = np.diff(offsets)
        alive = np.flatnonzero(sizes > 0)
        state = np.zeros(len(alive), np.int64)
        total = np.zeros(len(alive), np.int64)
        step = 0
        while len(alive):
            wanted = state * 256 + data[offsets[alive] + step]
            arc = np.minimum(np.searchsorted(self._arcs, wanted), len(self._arcs) - 1)
            ok = self._arcs[arc] == wanted
            alive, arc, total = alive[ok], arc[ok], total[ok]
            state, total = self.targets[arc].astype(np.int64), total + self.skipped[arc]
            step += 1
            ended = sizes[alive] == step
            accepted = ended & (self.final[state] == 1)
            result[alive[accepted]] = total[accepted]
            alive, state, total = alive[~ended], state[~ended], total[~ended]
        return result


class WordEncoder:
    """Chunk resolver: lexicon words by the transducer, all others by exact merges; each distinct word once."""

    def __init__(self, tokenizer: WordTokenizer, transducer: Transducer | None):
        self.tokenizer, self.transducer = tokenizer, transducer
        self.from_lexicon = self.merged = 0
        self._clear()

    def _clear(self) -> None:
        self._numbers = Numbers()
        self._flat = np.zeros(0, np.uint32)
        self._starts = np.zeros(1, np.int64)

    def _ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.transducer.numbers(words) if self.transducer else np.full(len(words), -1)
        unseen = found < 0
        self.merged += int(unseen.sum())
        self.from_lexicon += int((~unseen).sum())
        flat, own = self.tokenizer.merge_many([words[i] for i in np.flatnonzero(unseen)])
        if not unseen.all():
            sizes, starts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
            sizes[unseen], starts[unseen] = own, np.cumsum(own) - own
            first, known = self.transducer.out_first, found[~unseen]
            sizes[~unseen], starts[~unseen] = first[known + 1] - first[known], first[known] + len(flat)
            return take_segments(np.concatenate([flat, self.transducer.out_ids]), starts, sizes), sizes
        return flat, own

    def resolve(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self._numbers) > CACHE_CHUNKS or len(self._flat) > CACHE_IDS:
            self._clear()
        words, counts = self.tokenizer.words(chunks)
        known = len(self._numbers)
        which = np.fromiter(map(self._numbers.__getitem__, words), np.int64, len(words))
        if len(self._numbers) > known:
            flat, sizes = self._ids_of(list(islice(self._numbers, known, None)))
            self._flat = np.concatenate([self._flat, flat])
            self._starts = np.concatenate([self._starts, self._starts[-1] + np.cumsum(sizes)])
        starts = self._starts[which]
        sizes = self._starts[which + 1] - starts
        before = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
        return take_segments(self._flat, starts, sizes), np.diff(before)


def count_words(docs: DataFrame, tokenizer_path: str, text: str = "text") -> DataFrame:
    """(word, n) over all texts; every task sums its own words before the shuffle."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(tokenizer_path)
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            words: Counter = Counter()
            found, sizes = tokenizer.words(list(counts))
            for word, n in zip(found, np.repeat(np.fromiter(counts.values(), np.int64), sizes).tolist()):
                if len(word) <= LEXICON_WORD_BYTES:
                    words[word] += n
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], ["word", "n"])

        for batch in slices(batches, "text"):
            for value in batch.column("text").to_pylist():
                if value:
                    counts.update(chunks_of(value))
            if len(counts) > COUNT_CHUNKS:
                yield flush()
        yield flush()

    ship(docs.sparkSession)
    return (docs.select(F.col(text).cast("string").alias("text")).mapInArrow(partial, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def publish(spark: SparkSession, arrays: dict[str, np.ndarray]) -> str:
    """Write the automaton to the shared folder and let Spark hand it out; returns the name tasks find it by."""
    name = f"lexicon-{uuid.uuid4().hex}.fst"
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_path(spark, 'lexicon')}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    try:
        out.write(bytearray(automaton_bytes(arrays)))
    finally:
        out.close()
    spark.sparkContext.addFile(path.toUri().toString() if path.toUri().getScheme() else f"file://{path}")
    return name


def compile_lexicon(docs: DataFrame, tokenizer_path: str, text: str = "text",
                    lexicon_words: int = LEXICON_WORDS) -> str:
    """Count, compile and publish. The driver holds at most `lexicon_words` words, and one row for each class of
    frequency (64 to an octave, so some thousands)."""
    tokenizer = WordTokenizer(tokenizer_path)
    short = F.octet_length("word") <= LEXICON_WORD_BYTES
    counted = stored(count_words(docs, tokenizer_path, text).where(short)
                     .withColumn("class", F.floor(F.log2("n") * 64).cast("int")), "words")
    least, room = None, lexicon_words
    for row in sorted(counted.groupBy("class").count().collect(), key=lambda r: -r["class"]):
        room -= row["count"]
        if room < 0:
            break
        least = row["class"]
    top = counted.where(F.col("class") >= least).collect() if least is not None else []
    entries = {row.word: tokenizer.merge(row.word) for row in top if row.word}
    return publish(docs.sparkSession, build_automaton(entries))


def encode_decode(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text: str = "text",
                  lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """Encode every whole text and decode it again.

    One row per input row: the id column, n_tokens, ids (binary: little-endian unsigned 32-bit integers) and decoded
    (the decoded text). A null text counts as empty: no ids and an empty decoded text. Null ids and repeated
    rows keep a row each; other columns are ignored; an empty table gives an empty result.
    """
    docs = docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"))
    name = compile_lexicon(docs, tokenizer_path, "text", lexicon_words)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(tokenizer_path)
        words = WordEncoder(tokenizer, Transducer.from_file(SparkFiles.get(name)))
        encoder = ChunkEncoder(words.resolve)
        for batch in slices(batches, "text", 4 << 20):
            ids, starts = encoder.encode(batch.column("text").to_pylist())
            spans = list(zip(starts[:-1].tolist(), starts[1:].tolist()))
            raw = ids.astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array(np.diff(starts)),
                pa.array([raw[4 * a:4 * b] for a, b in spans], pa.binary()),
                pa.array([tokenizer.decode(ids[a:b].tolist()) for a, b in spans], pa.binary()).cast(pa.string()),
            ], ["id", "n_tokens", "ids", "decoded"])

    kind = docs.schema["id"].dataType.simpleString()
    return (docs.mapInArrow(encode, f"id {kind}, n_tokens long, ids binary, decoded string")
            .withColumnRenamed("id", id_column))
