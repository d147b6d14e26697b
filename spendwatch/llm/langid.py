"""Language identification by prediction by partial matching.

Every language has a tree of byte contexts (the last 0 to `order` bytes) with the counts of the bytes that followed.
A byte costs -log2 of its probability in the longest known context; a byte that never followed there escapes to the
context one byte shorter, with probability distinct / (count + distinct), and the shorter context excludes the bytes
that the longer one knows. Counts are frozen after training, so a byte's cost depends on the bytes before it alone, and
all costs fit one table: context x byte x language. A text's code length is the sum over all its bytes; the language
with the shortest code wins.

Training reads a sample of about `sample_bytes` bytes for each language (whole texts, chosen by a hash of id and text).
Languages are learned in groups of `_GROUP`. A group's table holds its most frequent contexts, as many as fit
`table_bytes` for a full group, so a language's tree is as deep among hundreds of languages as among few. A task scores its
texts group by group and holds one table at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from spendwatch.llm.common import free_name, ship, slices, stored, text_bytes

UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
_GROUP = 4  # languages of one table
_TAG = 40  # bits of a counted byte string; above them stands its length, then its language


@dataclass
class Model:
    """languages; symbols: byte -> symbol; child: context and the byte before it -> longer context or -1; bits: cost
    of a symbol in a context, for every language. `further`: the broadcast models of the groups after the first, each with
    its languages."""
    languages: list[str]
    symbols: np.ndarray
    child: np.ndarray
    bits: np.ndarray
    order: int
    further: list[tuple[list[str], Broadcast]] = field(default_factory=list)


def _count_strings(data: np.ndarray, place: np.ndarray, language: np.ndarray, order: int) -> np.ndarray:
    """Keys of all byte strings of 1 to order + 1 bytes inside the texts."""
    keys, packed = [], np.zeros(len(data), np.int64)
    for size in range(1, order + 2):
        # packed: the last `size` bytes up to here, the newest in the lowest bits.
        shifted = np.zeros(len(data), np.int64)
        shifted[size - 1:] = data[:len(data) - size + 1]
        packed = packed | shifted << (8 * (size - 1))
        inside = place >= size - 1
        keys.append(packed[inside] | np.int64(size) << _TAG | language[inside] << (_TAG + 4))
    return np.concatenate(keys)


def train(docs: DataFrame, text: str = "text", lang: str = "lang", order: int = 3, sample_bytes: int = 6_000_000,
          table_bytes: int = 24_000_000) -> Model:
    """Learn from all rows with a text and a language, by a bounded sample of each language."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).where(
        "text is not null and lang is not null")
    totals = {r.lang: r.n for r in rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    languages = sorted(totals)
    if not languages:
        return Model([], np.zeros(256, np.int64), np.full((1, 1), -1, np.int32), np.zeros((1, 1, 0), np.float32), order)
    share = F
    for name in languages:
        share = share.when(F.col("lang") == name, F.lit(min(1.0, sample_bytes / max(totals[name], 1))))
    chosen = rows.where(F.pmod(F.xxhash64("lang", "text"), F.lit(1 << 30)) < share * (1 << 30))
    number = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            data, offsets = text_bytes(batch.column("text"))
            sizes = np.diff(offsets)
            place = np.arange(len(data)) - np.repeat(offsets[:-1], sizes)
            own = np.repeat(np.asarray([number[x] for x in batch.column("lang").to_pylist()], np.int64), sizes)
            keys, n = np.unique(_count_strings(data, place, own, order), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], ["key", "n"])

    counted = chosen.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    if len(languages) <= _GROUP:
        return _build(languages, counted.toPandas(), order, table_bytes // len(languages))
    counted = stored(counted, "counts")
    first, further = None, []
    for start in range(0, len(languages), _GROUP):  # the driver holds the counts and the table of one group
        group = languages[start:start + _GROUP]
        low = start << _TAG + 4
        own = counted.where(F.col("key").between(low, low + (len(group) << _TAG + 4) - 1))
        model = _build(group, own.withColumn("key", F.col("key") - low).toPandas(), order, table_bytes // _GROUP)
        if first is None:
            first = model
        else:
            further.append((group, docs.sparkSession.sparkContext.broadcast(model)))
    first.further = further
    return first


def _build(languages: list[str], counted: pd.DataFrame, order: int, language_bytes: int) -> Model:
    keys, counts = counted["key"].to_numpy(np.int64), counted["n"].to_numpy(np.float64)
    order_ = np.argsort(keys)
    keys, counts = keys[order_], counts[order_]
    language = keys >> (_TAG + 4)
    size = (keys >> _TAG) & 15
    string = keys & ((1 << _TAG) - 1)
    seen = np.unique(string[size == 1])
    symbols = np.full(256, len(seen), np.int64)  # the last symbol stands for each byte never seen
    symbols[seen] = np.arange(len(seen))
    width, n_lang = len(seen) + 1, len(languages)
    # Contexts: what stands before the last byte. A context is as frequent as its share in each language, summed.
    context = string >> 8 | (size - 1) << _TAG
    share = counts / np.bincount(language[size == 1], counts[size == 1], n_lang)[language]
    known, which = np.unique(context, return_inverse=True)
    weight = np.bincount(which, share)
    depth = known >> _TAG
    capacity = max(1, language_bytes // (4 * width))
    best = np.lexsort((known, depth, -np.round(weight, 12)))[:capacity]
    best = best[np.lexsort((known[best], depth[best]))]
    node_of = np.full(len(known), -1, np.int64)
    node_of[best] = np.arange(len(best))
    nodes, node_depth = known[best], depth[best]
    parent = np.zeros(len(nodes), np.int64)
    child = np.full((len(nodes), width), -1, np.int32)
    for d in range(1, order + 1):
        at = np.flatnonzero(node_depth == d)
        body = nodes[at] & ((1 << _TAG) - 1)
        shorter = (body & ((1 << 8 * (d - 1)) - 1)) | np.int64(d - 1) << _TAG
        parent[at] = np.searchsorted(nodes, shorter)
        child[parent[at], symbols[body >> (8 * (d - 1))]] = at
    node = node_of[which]
    kept = node >= 0
    bits = np.zeros((len(nodes), width, n_lang), np.float32)
    for lang in range(n_lang):
        mine = kept & (language == lang)
        follow = np.zeros((len(nodes), width))
        follow[node[mine], symbols[string[mine] & 255]] = counts[mine]
        bits[:, :, lang] = -np.log2(_probabilities(follow, parent, node_depth, order))
    return Model(languages, symbols, child, bits, order)


def _probabilities(follow: np.ndarray, parent: np.ndarray, depth: np.ndarray, order: int) -> np.ndarray:
    """Probability of each symbol in each context, with escapes and exclusion."""
    has = follow > 0
    total, distinct = follow.sum(axis=1), has.sum(axis=1).astype(float)
    p = np.empty_like(follow)
    escaped = np.empty_like(follow)  # probability once the context itself has been escaped from
    escaped[0] = 1.0 / max(256 - distinct[0], 1)
    p[0] = np.where(has[0], follow[0] / max(total[0] + distinct[0], 1), 0)
    rest = distinct[0] / (total[0] + distinct[0]) if total[0] else 1.0
    p[0] = np.where(has[0], p[0], rest * escaped[0])
    for d in range(1, order + 1):
        at = np.flatnonzero(depth == d)
        up = parent[at]
        left = total[up] - (follow[up] * has[at]).sum(axis=1)
        kinds = distinct[up] - distinct[at]
        room = (left + kinds)[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            direct = np.where(room > 0, follow[up] / room, 0)
            further = np.where(room > 0, kinds[:, None] / room, 1) * escaped[up]
            escaped[at] = np.where(has[up], direct, further)
            weight = (total[at] + distinct[at])[:, None]
            own = np.where(has[at], follow[at] / weight, distinct[at][:, None] / weight * escaped[at])
        unknown = total[at] == 0  # a context that this language never saw counts as its shorter one
        p[at] = np.where(unknown[:, None], p[up], own)
        escaped[at] = np.where(unknown[:, None], escaped[up], escaped[at])
    return np.maximum(p, 1e-12)


def code_lengths(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of every text (rows) in every language (columns)."""
    sizes = np.diff(offsets)
    symbol = model.symbols[data]
    width = model.bits.shape[1]
    place = np.arange(len(data)) - np.repeat(offsets[:-1], sizes)
    node = np.zeros(len(data), np.int64)
    live = np.ones(len(data), bool)
    flat = model.child.reshape(-1)
    for back in range(1, model.order + 1):
        before = np.zeros(len(data), np.int64)
        before[back:] = symbol[:len(data) - back]
        longer = flat[node * width + before]
        live &= (longer >= 0) & (place >= back)
        node = np.where(live, longer, node)
    cost = model.bits.reshape(-1, model.bits.shape[2])[node * width + symbol]
    out = np.zeros((len(sizes), cost.shape[1]))
    filled = sizes > 0
    if filled.any():
        out[filled] = np.add.reduceat(cost, offsets[:-1][filled], axis=0, dtype=np.float64)
    return out


def _read(table: Broadcast) -> Model:
    """A broadcast model that its handle does not keep, where it is a local file."""
    path = getattr(table, "_path", None)
    return table.load_from_path(path) if path else table.value


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` (all by default) with lang_pred, score (posterior probability, all languages alike before)
    and bits_per_byte (shortest code).

    A null text, or one without a letter, is `und` with score 0 and null bits_per_byte. Columns named as the results
    are replaced. Texts of any length are read whole. Without a learned language everything is `und`.
    """
    spark = docs.sparkSession
    ship(spark)
    groups = [(model.languages, spark.sparkContext.broadcast(replace(model, further=[]))), *model.further]
    languages = [name for names, _ in groups for name in names]
    tables = [table for _, table in groups]
    added = {"lang_pred": pa.string(), "score": pa.float64(), "bits_per_byte": pa.float64()}
    kept = [c for c in (keep if keep is not None else docs.columns) if c not in added]
    own = free_name(docs, "_text")
    inner = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias(own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.asarray([*languages, UNDETERMINED], dtype=object)
        only = tables[0].value if len(tables) == 1 else None
        for batch in slices(batches, own, 2 << 20):
            data, offsets = text_bytes(batch.column(own))
            clear = np.fromiter((bool(t and _LETTER.search(t)) for t in batch.column(own).to_pylist()), bool,
                                batch.num_rows)
            if not languages:
                clear[:] = False
                lengths = np.zeros((batch.num_rows, 1))
            else:
                # Of several tables none stays in memory after its turn.
                lengths = np.concatenate([code_lengths(only or _read(table), data, offsets)
                                          for table in tables], axis=1)
            best = lengths.argmin(axis=1)
            shortest = lengths.min(axis=1)
            score = 1 / np.exp2(np.maximum(shortest[:, None] - lengths, -1000)).sum(axis=1)
            per_byte = shortest / np.maximum(np.diff(offsets), 1)
            columns = [batch.column(c) for c in kept]
            columns += [pa.array(np.where(clear, names[best], UNDETERMINED), pa.string()),
                        pa.array(np.where(clear, score, 0.0)), pa.array(per_byte, mask=~clear)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *added])

    schema = inner.drop(own).schema
    for name, kind in (("lang_pred", "string"), ("score", "double"), ("bits_per_byte", "double")):
        schema = schema.add(name, kind)
    return inner.mapInArrow(run, schema)


def accepted(max_bits: float = 8.0) -> Column:
    """Rows whose language is known and codes the text in at most `max_bits` bits a byte. Beyond 8 the language explains
    the text worse than chance does; short documents with keys or numbers stay below."""
    return (F.col("lang_pred") != UNDETERMINED) & (F.col("bits_per_byte") <= max_bits)
