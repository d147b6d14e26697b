"""Source divergence audit: how far the word use of each source departs from the other sources of its language.

1. First pass: the exact document frequency of each (language, term); the terms in at least `least` documents are kept.
2. The kept terms are dealt by their hash into shards of about `shard_bytes`. A shard is a minimal perfect hash: levels of
   bits in which a term that is alone at its place has its bit set, so that the rank of the bit is its slot. Terms that no
   level parts (equal 64-bit hashes) follow as a plain list. The terms themselves are stored in the order of their slots.
3. Second pass: shards of at most about `pass_bytes` are broadcast and all documents are read again. Each distinct term of
   a batch is looked up and verified against the stored one, and its occurrences increment the slots of its group's
   array over the kept terms of its language. A task holds at most `slot_bytes` of arrays; the counts of further groups
   leave it batch by batch. More kept terms than one broadcast may hold take more passes.
4. Spark sums the slots of all tasks and computes the shares and divergences, in integers only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from spendwatch.llm.common import BYTE_VALUES, LOWER, mix, ship, slices, stored, text_bytes

# A term is a run of ASCII letters and of characters beyond ASCII, so of letters and bytes from 0x80 in UTF-8.
_IN_TERM = np.zeros(256, bool)
_IN_TERM[0x41:0x5B] = _IN_TERM[0x61:0x7B] = _IN_TERM[0x80:] = True
UNIT = 1_000_000_000  # shares are counted in parts of a thousand million
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LEVELS = 32
_SLICE = 4 << 20


def terms_of(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct terms (binary, A-Z lowered) of all rows, and for each occurrence its term and its row."""
    data, offsets = text_bytes(column)
    inside = _IN_TERM[data]
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]
    firsts, lasts = offsets[:-1][filled], offsets[1:][filled] - 1
    begins[firsts], closes[lasts] = inside[firsts], inside[lasts]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    places = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=places[1:])
    found = pa.Array.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(LOWER[data[inside]]))])
    coded = found.dictionary_encode()
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return coded.dictionary, np.asarray(coded.indices), rows


def _names(column: pa.Array) -> tuple[list[str], np.ndarray]:
    """The distinct values (null: empty) and each row's."""
    coded = pc.fill_null(column.cast(pa.string()), "").dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return coded.dictionary.to_pylist(), np.asarray(coded.indices)


def _raw(terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    places = np.frombuffer(terms.buffers()[1], np.int64)[terms.offset:terms.offset + len(terms) + 1]
    data = terms.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[places[0]:places[-1]], places - places[0]


def term_hashes(terms: pa.Array) -> np.ndarray:
    """64-bit hashes of binary values, none empty: the sum of each byte's value scattered by its place."""
    if not len(terms):
        return np.zeros(0, np.uint64)
    data, places = _raw(terms)
    inside = (np.arange(len(data)) - np.repeat(places[:-1], np.diff(places))).astype(np.uint64)
    with np.errstate(over="ignore"):
        return mix(np.add.reduceat(mix(BYTE_VALUES[data] + inside * _STEP), places[:-1]))


def _lang_hash(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def key_hashes(langs: list[str], lang: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Hashes of (language, term) from those of the terms."""
    own = np.asarray([_lang_hash(x) for x in langs], np.uint64)
    with np.errstate(over="ignore"):
        return mix(own[lang] * _STEP + hashes) if len(lang) else np.zeros(0, np.uint64)


def _place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(hashes + np.uint64(level + 1) * _STEP) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """A minimal perfect hash of 64-bit hashes: `slots` of known ones are all different and lie in 0 to n - 1."""

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.before = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.bitwise_count(words), out=self.before[1:])

    @classmethod
    def build(cls, hashes: np.ndarray) -> tuple["PerfectHash", np.ndarray]:
        """The hash, and the numbers of the keys that no level parts."""
        left, sizes, words = np.arange(len(hashes)), [], [np.zeros(0, np.uint64)]
        for level in range(_LEVELS):
            if not len(left):
                break
            size = 64 * (2 * len(left) // 64 + 1)
            place = _place(hashes[left], level, size)
            alone = np.bincount(place, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8").astype(np.uint64))
            sizes.append(size)
            left = left[~alone[place]]
        return cls(sizes, np.concatenate(words)), left

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """Each hash's slot; -1 if it has none. An unknown hash may get a slot that is not its own."""
        out = np.full(len(hashes), -1, np.int64)
        left, base = np.arange(len(hashes)), 0
        for level, size in enumerate(self.sizes):
            place = _place(hashes[left], level, size)
            word, bit = self.words[base + (place >> 6)], (place & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[hit]] = (self.before[base + (place >> 6)] + below)[hit]
            left, base = left[~hit], base + size // 64
        return out


_SHARD = ("shard long, sizes array<long>, words binary, langs array<string>, lang binary, term_places binary, "
          "term_bytes binary, bytes long")


def _build_shard(key: tuple, group: pa.Table) -> pa.Table:
    """One row: the levels, then languages and terms in the order of their slots (unparted ones last)."""
    group = group.combine_chunks()
    terms = group["term"].cast(pa.large_binary()).combine_chunks()
    langs, lang = _names(group["lang"])
    hashed, left = PerfectHash.build(group["hash"].to_numpy().view(np.uint64))
    slots = hashed.slots(group["hash"].to_numpy().view(np.uint64))
    slots[left] = len(slots) - len(left) + np.arange(len(left))
    order = np.argsort(slots)
    data, places = _raw(terms.take(pa.array(order)))
    row = {"shard": [key[0].as_py()], "sizes": [hashed.sizes], "words": [hashed.words.tobytes()], "langs": [langs],
           "lang": [lang[order].astype(np.int32).tobytes()], "term_places": [places.tobytes()],
           "term_bytes": [data.tobytes()], "bytes": [len(data) + 12 * len(order) + hashed.words.nbytes]}
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.string()), pa.binary(), pa.binary(), pa.binary(),
             pa.int64()]
    return pa.table([pa.array(v, t) for v, t in zip(row.values(), kinds)], names=list(row))


class Shard:
    """A shard as a task holds it; `dense` is a slot's place among all kept terms of its language in this pass."""

    def __init__(self, row: dict, counts: dict[str, int]):
        self.hash = PerfectHash(list(row["sizes"]), np.frombuffer(row["words"], np.uint64))
        places = np.frombuffer(row["term_places"], np.int64)
        self.terms = pa.Array.from_buffers(pa.large_binary(), len(places) - 1, [
            None, pa.py_buffer(row["term_places"]), pa.py_buffer(row["term_bytes"])])
        self.langs, self.lang = row["langs"], np.frombuffer(row["lang"], np.int32)
        self.parted = int(self.hash.before[-1])  # slots from here on are the plain list
        self.dense = np.empty(len(self.lang), np.int64)
        for i, name in enumerate(self.langs):
            own = np.flatnonzero(self.lang == i)
            self.dense[own] = counts.get(name, 0) + np.arange(len(own))
            counts[name] = counts.get(name, 0) + len(own)

    def find(self, langs: list[str], lang: np.ndarray, terms: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """Each (language, term)'s slot, verified on the stored key; -1 if it is not kept."""
        number = {name: i for i, name in enumerate(self.langs)}
        own = np.asarray([number.get(name, -1) for name in langs], np.int32)[lang]
        slots = self.hash.slots(hashes)
        known = np.flatnonzero(slots >= 0)
        same = np.asarray(pc.equal(self.terms.take(pa.array(slots[known])), terms.take(pa.array(known))).to_numpy(
            zero_copy_only=False), bool) & (self.lang[slots[known]] == own[known])
        out = np.full(len(hashes), -1, np.int64)
        out[known[same]] = slots[known[same]]
        if self.parted < len(self.lang):
            rest = {(int(c), t): self.parted + i for i, (c, t) in enumerate(zip(
                self.lang[self.parted:], self.terms.slice(self.parted).to_pylist()))}
            for i in np.flatnonzero(out < 0):
                out[i] = rest.get((int(own[i]), terms[i].as_py()), -1)
        return out


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, term, hash, docs): in how many rows of a slice each term of each language occurs."""
    for batch in slices(batches, "text", _SLICE):
        terms, codes, rows = terms_of(batch.column("text"))
        langs, lang = _names(batch.column("lang"))
        n = max(len(terms), 1)
        in_rows, _ = _counted(rows * n + codes)
        pairs, docs = _counted(lang.astype(np.int64)[in_rows // n] * n + in_rows % n)
        which, code = pairs // n, pairs % n
        hashes = key_hashes(langs, which, term_hashes(terms)[code])
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()).take(pa.array(which)), terms.take(pa.array(code)).cast(pa.binary()).cast(pa.string()),
             pa.array(hashes.astype(np.int64)), pa.array(docs.astype(np.int64))], ["lang", "term", "hash", "docs"])


def kept_terms(docs: DataFrame, least: int = 3) -> DataFrame:
    """(lang, term, hash) of the terms that occur in at least `least` documents (rows) of a language, exactly."""
    found = docs.select("lang", "text").mapInArrow(_frequencies, "lang string, term string, hash long, docs long")
    return (found.groupBy("lang", "term", "hash").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least)
            .drop("docs"))


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and how often each occurs; sorting whole numbers is faster than hashing them."""
    ordered = np.sort(values)
    fresh = np.flatnonzero(np.diff(ordered, prepend=ordered[:1] - 1))
    return ordered[fresh], np.diff(fresh, append=len(ordered))


_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64())])


def _count_rows(lang: str, source: str, terms: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    names = [pa.array([x], pa.string()).take(pa.array(np.zeros(len(n), np.int8))) for x in (lang, source)]
    return pa.RecordBatch.from_arrays([*names, terms.cast(pa.binary()).cast(pa.string()), pa.array(n.astype(np.int64))],
                                      schema=_COUNTS)


def _recount(shards: int, held, slot_bytes: int):
    """Occurrences of the terms of a pass's shards by (lang, source, term)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        tables = {row["shard"]: Shard(row, counts) for row in held.value}
        groups: dict[tuple[str, str], np.ndarray] = {}
        size = seen = 0

        def written() -> Iterator[pa.RecordBatch]:
            for (lang, source), slots in groups.items():
                hit = np.flatnonzero(slots)
                yield _count_rows(lang, source, _stored_terms(tables, lang).take(pa.array(hit)), slots[hit])

        for batch in slices(batches, "text", _SLICE):
            terms, codes, rows = terms_of(batch.column("text"))
            seen += len(codes)
            if seen >= 2**32:  # no slot may run over
                yield from written()
                groups.clear()
                size, seen = 0, len(codes)
            langs, lang = _names(batch.column("lang"))
            sources, source = _names(batch.column("source"))
            n = max(len(terms), 1)
            # The distinct (group, term) of the slice; most terms occur in several groups, so keys are looked up once.
            of_group, times = _counted((lang.astype(np.int64) * len(sources) + source)[rows] * n + codes)
            group, code = of_group // n, of_group % n
            own, _ = _counted(group // max(len(sources), 1) * n + code)
            which, term = own // n, own % n
            keys, hashes = terms.take(pa.array(term)), key_hashes(langs, which, term_hashes(terms)[term])
            dense = np.full(len(own), -1, np.int64)
            dealt = hashes.astype(np.int64) % shards
            for number, shard in tables.items():
                mine = np.flatnonzero(dealt == number)
                slots = shard.find(langs, which[mine], keys.take(pa.array(mine)), hashes[mine])
                dense[mine[slots >= 0]] = shard.dense[slots[slots >= 0]]
            place = dense[np.searchsorted(own, group // max(len(sources), 1) * n + code)]
            borders = np.flatnonzero(np.diff(group, prepend=-1, append=-1))
            for begin, end in zip(borders[:-1], borders[1:]):
                g = int(group[begin])
                name = (langs[g // len(sources)], sources[g % len(sources)])
                hit = begin + np.flatnonzero(place[begin:end] >= 0)
                if name not in groups and len(hit) and size + 4 * counts[name[0]] <= slot_bytes:
                    groups[name] = np.zeros(counts[name[0]], np.uint32)
                    size += groups[name].nbytes
                if name in groups:
                    groups[name][place[hit]] += times[hit].astype(np.uint32)
                elif len(hit):
                    yield _count_rows(*name, terms.take(pa.array(code[hit])), times[hit])
        yield from written()

    return run


def _stored_terms(tables: dict[int, Shard], lang: str) -> pa.Array:
    """The kept terms of a language in the order of its dense arrays."""
    return pa.concat_arrays([pa.array([], pa.large_binary())] + [
        shard.terms.take(pa.array(np.flatnonzero(shard.lang == shard.langs.index(lang))))
        for shard in tables.values() if lang in shard.langs])


def group_counts(docs: DataFrame, kept: DataFrame, shard_bytes: int = 4 << 20, pass_bytes: int = 64 << 20,
                 slot_bytes: int = 128 << 20) -> DataFrame:
    """(lang, source, term, n): how often each kept term occurs in each group, where it does."""
    spark = docs.sparkSession
    total = kept.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    tables = stored(kept.withColumn("shard", F.pmod("hash", F.lit(shards))).groupBy("shard")
                    .applyInArrow(_build_shard, _SHARD), "perfect-hashes")
    each = max(1, pass_bytes // shard_bytes)
    parts = []
    for first in range(0, shards, each):
        rows = [row.asDict() for row in tables.where(F.col("shard").between(first, first + each - 1)).orderBy("shard").collect()]
        held = spark.sparkContext.broadcast(rows)  # at most `each` shards
        found = docs.select("lang", "source", "text").mapInArrow(
            _recount(shards, held, slot_bytes), "lang string, source string, term string, n long")
        parts.append(stored(found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n")), "counts"))
        held.unpersist()
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    return counts


def _share(count: Column, total: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / total), exactly."""
    return F.lit(1) + F.call_function(
        "div", F.lit(UNIT).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)"), total.cast("decimal(20,0)"))


_PAIRS = "lang string, source string, item string, value long"


def _pair_sums(key: tuple, group: pa.Table) -> pa.Table:
    """Divergences of all sources of a language from each other, summed over the terms of one bucket.

    Rows without a term hold a source's share of a term it lacks.
    """
    marks = group.filter(pc.is_null(group["term"]))
    sources = np.asarray(marks["source"].to_pylist(), object)
    number = {s: i for i, s in enumerate(sources)}
    rows = group.filter(pc.is_valid(group["term"]))
    coded = rows["term"].combine_chunks().dictionary_encode()
    share = np.tile(marks["share"].to_numpy(), (len(coded.dictionary), 1)) if len(coded.dictionary) else np.zeros(
        (0, len(sources)), np.int64)
    at = np.fromiter((number[s] for s in rows["source"].to_pylist()), np.int64, rows.num_rows)
    share[np.asarray(coded.indices), at] = rows["share"].to_numpy()
    values = np.empty((len(sources), len(sources)), np.int64)
    for i in range(len(sources)):
        apart = share[:, i:i + 1] - share
        values[i] = (apart * apart // share).sum(axis=0) if len(share) else 0
    one, two = np.nonzero(~np.eye(len(sources), dtype=bool))
    return pa.table([pa.array([key[0].as_py()] * len(one), pa.string()), pa.array(sources[one], pa.string()),
                     pa.array(sources[two], pa.string()), pa.array(values[one, two])],
                    names=["lang", "source", "item", "value"])


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least: int = 3, top: int = 200,
          bucket_cells: int = 1 << 20, **limits: int) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (language, source) group.

    Part `pair`: the group's divergence from each other source of its language, over all kept terms. Part `term`: the kept
    terms it uses more than its language does, the `top` most telling ones. A share is p = 1 + floor(UNIT * (count + 1) /
    (N + V)), N the occurrences of kept terms in the group, V the kept terms of the language; a divergence is
    floor((p - q)^2 / q). Ranks go by falling value, then by item in UTF-8 order.

    Null texts, languages and sources are empty ones. Each row is a document, repeated rows too. A group without
    terms, or whose language keeps none, has its pairs all the same; a language with one source has none. Other
    columns are ignored; an empty table gives an empty result. Terms and texts may have any length.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name)
                         for c, name in ((lang, "lang"), (source, "source"), (text, "text"))))
    kept = stored(kept_terms(rows, least), "kept")
    counts = group_counts(rows, kept, **limits)
    words = kept.groupBy("lang").agg(F.count("*").alias("v"))
    used = counts.groupBy("lang", "source").agg(F.sum("n").alias("used"))
    groups = stored(rows.select("lang", "source").distinct().join(used, ["lang", "source"], "left")
                    .join(words, "lang", "left").select(
                        "lang", "source", F.coalesce("used", F.lit(0)).alias("used"), F.coalesce("v", F.lit(0)).alias("v")),
                    "groups")
    whole = groups.groupBy("lang").agg(
        F.sum("used").alias("lang_used"), F.count("*").alias("sources"),
        F.greatest(F.ceil(F.max("v") * F.count("*") / bucket_cells), F.lit(1)).alias("buckets"))
    shares = counts.join(groups, ["lang", "source"]).join(whole, "lang").withColumn(
        "share", _share(F.col("n"), F.col("used") + F.col("v")))
    shares = stored(shares.select("lang", "source", "term", "n", "share", "v", "lang_used", "buckets"), "shares")

    marks = groups.join(whole, "lang").select(
        "lang", "source", F.lit(None).cast("string").alias("term"),
        _share(F.lit(0), F.greatest(F.col("used") + F.col("v"), F.lit(1))).alias("share"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)).alias("bucket"))
    dealt = shares.select("lang", "source", "term", "share", F.pmod(F.xxhash64("term"), F.col("buckets")).alias("bucket"))
    pairs = (dealt.unionByName(marks).groupBy("lang", "bucket").applyInArrow(_pair_sums, _PAIRS)
             .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))

    lang_counts = shares.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    q = _share(F.col("lang_n"), F.col("lang_used") + F.col("v"))
    apart = F.col("share") - F.col("q")
    terms = (shares.join(lang_counts, ["lang", "term"]).withColumn("q", q).where("share > q").select(
        "lang", "source", F.col("term").alias("item"), F.call_function("div", apart * apart, F.col("q")).alias("value")))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    terms = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    def part(df: DataFrame, name: str) -> DataFrame:
        return df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")

    return part(pairs, "pair").unionByName(part(terms, "term"))
