"""Hard-negative mining by segment summaries.

Every row's vector is cut into segments, at several levels of fineness. A segment is summarised by its mean and by the
length of its deviations from that mean. The inner product of two vectors is the sum, over the segments, of size x mean
x mean and of the product of the deviations, which lies between plus and minus the product of their lengths. So the
summaries bound every score from both sides.

Rows are packed into shards of about `shard_rows`, anchors into blocks; every block meets every shard once for the
positives and once for the negatives (the stated query set against all rows, in blocks). At most about `pass_bytes` of
anchors are broadcast at a time; more take more passes. Where block and shard meet, the coarsest level bounds all scores, rows that cannot be among the wanted ones go, the next level bounds the rest, and only what is left after
the finest level is scored exactly. A row goes only if enough others are surely better, or if its bounds lie outside of
every wanted range, so the results are exact.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, GroupedData, Window, functions as F

from spendwatch.llm.common import PASS_BYTES, in_passes, partitions, pass_counts, ship, stored

LEVELS = (4, 16)


def cuts(dim: int, segments: int) -> np.ndarray:
    """Where the segments of a vector begin: at most `segments`, of almost equal size."""
    return np.unique(np.arange(min(segments, dim)) * dim // max(min(segments, dim), 1)).astype(np.int64)


def summaries(matrix: np.ndarray, segments: int) -> np.ndarray:
    """Means (times the root of the segment's size), then lengths of the deviations, of all segments of all rows."""
    dim = matrix.shape[1]
    if not dim:
        return np.zeros((len(matrix), 0))
    starts = cuts(dim, segments)
    sizes = np.diff(np.append(starts, dim))
    means = np.add.reduceat(matrix, starts, axis=1) / sizes
    apart = matrix - np.repeat(means, sizes, axis=1)
    return np.hstack([means * np.sqrt(sizes), np.sqrt(np.add.reduceat(apart * apart, starts, axis=1))])


class Rows:
    """The rows of a shard, or the anchors of a block: ids, labels, vectors of whole numbers, summaries by level."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray, levels: list[np.ndarray]):
        self.ids, self.labels, self.matrix, self.levels = ids, labels, matrix, levels
        self.lengths = np.sqrt((matrix.astype(np.float64) ** 2).sum(axis=1))

    @classmethod
    def of(cls, group: pa.Table, dim: int) -> "Rows":
        group = group.sort_by("id")
        vectors = group["vector"].combine_chunks()
        matrix = np.asarray(vectors.flatten(), np.int64).reshape(len(vectors), dim)
        return cls(np.asarray(group["id"], np.int64), np.asarray(group["label"], np.int64), matrix,
                   [summaries(matrix.astype(np.float64), s) for s in LEVELS])

    def pack(self) -> dict[str, list]:
        return {"ids": [self.ids.tobytes()], "labels": [self.labels.tobytes()], "matrix": [self.matrix.tobytes()],
                "levels": [[x.tobytes() for x in self.levels]]}

    @classmethod
    def unpack(cls, row: dict) -> "Rows":
        ids = np.frombuffer(row["ids"], np.int64)
        return cls(ids, np.frombuffer(row["labels"], np.int64),
                   np.frombuffer(row["matrix"], np.int64).reshape(len(ids), row["dim"]),
                   [np.frombuffer(x).reshape(len(ids), -1) for x in row["levels"]])

    def bounds(self, others: np.ndarray, level: int, anchors: "Rows", i: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores of rows `others` with anchor i."""
        mine, theirs = anchors.levels[level][i], self.levels[level][others]
        half = len(mine) // 2
        middle = theirs[:, :half] @ mine[:half]
        spread = theirs[:, half:] @ mine[half:]
        spread += 1e-12 * anchors.lengths[i] * self.lengths[others] + 1e-6  # more than rounding can be
        return middle - spread, middle + spread

    def scores(self, others: np.ndarray, anchors: "Rows", i: int) -> np.ndarray:
        """Exact inner products."""
        if len(others) and anchors.lengths[i] * self.lengths[others].max() < 2**52:
            # Every partial sum is a whole number below 2^53, so doubles hold it exactly.
            return (self.matrix[others].astype(np.float64) @ anchors.matrix[i].astype(np.float64)).astype(np.int64)
        return self.matrix[others] @ anchors.matrix[i]


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The numbers of the k best: higher scores first, ties by smaller id."""
    return np.lexsort((ids, -scores))[:k]


def _kth(values: np.ndarray, k: int) -> float:
    return -np.inf if len(values) < k else float(np.partition(values, -k)[-k])


def best_of_label(rows: Rows, anchors: Rows, i: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best rows of the anchor's label, and their scores."""
    left = np.flatnonzero((rows.labels == anchors.labels[i]) & (rows.ids != anchors.ids[i]))
    for level in range(len(LEVELS)):
        if len(left) > k:
            low, high = rows.bounds(left, level, anchors, i)
            left = left[high >= _kth(low, k)]
    scores = rows.scores(left, anchors, i)
    top = _first(rows.ids[left], scores, k)
    return left[top], scores[top]


def best_in_ranges(rows: Rows, anchors: Rows, i: int, ranges: list[tuple[int, int]],
                   k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each range of scores, the k best rows of other labels inside it, and their scores."""
    left = np.flatnonzero((rows.labels != anchors.labels[i]) & (rows.ids != anchors.ids[i]))
    for level in range(len(LEVELS)):
        if not len(left):
            break
        low, high = rows.bounds(left, level, anchors, i)
        wanted = np.zeros(len(left), bool)
        for least, most in ranges:
            sure = low[(low >= least) & (high <= most)]
            wanted |= (high >= max(least, _kth(sure, k))) & (low <= most)
        left = left[wanted]
    scores = rows.scores(left, anchors, i)
    out = []
    for least, most in ranges:
        inside = np.flatnonzero((scores >= least) & (scores <= most))
        top = inside[_first(rows.ids[left[inside]], scores[inside], k)]
        out.append((left[top], scores[top]))
    return out


_PACKED = "ids binary, labels binary, matrix binary, levels array<binary>"
_KINDS = {"ids": pa.binary(), "labels": pa.binary(), "matrix": pa.binary(), "levels": pa.list_(pa.binary())}


def _pack_block(key: tuple, group: pa.Table) -> pa.Table:
    """The anchors of a block, with the scores of each anchor's positives."""
    group = group.sort_by("id")
    packed = Rows.of(group, key[0].as_py()).pack()
    return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()),
                     *(pa.array(packed[c], t) for c, t in _KINDS.items()),
                     pa.array([group["positives"].to_pylist()], pa.list_(pa.list_(pa.int64())))],
                    names=["dim", "block", *_KINDS, "positives"])


def _asked(sharded: GroupedData, anchors: DataFrame, block_rows: int, pass_bytes: int, ask: Callable,
           best: Callable[[DataFrame], DataFrame], names: list[str], name: str) -> DataFrame:
    """`best` of `ask(rows, anchors, positives)` for each block of anchors and shard, stored. All columns are whole numbers."""
    width = 8 * sum(2 * s for s in LEVELS) + 16
    passes, blocks = pass_counts(*anchors.agg(F.count("*"), F.sum(F.col("dim").cast("long") * 8 + width)).first(),
                                 block_rows, pass_bytes)
    blocked = (anchors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).groupBy("dim", "block")
               .applyInArrow(_pack_block, f"dim int, block int, {_PACKED}, positives array<array<long>>"))
    schema = pa.schema([(c, pa.int64()) for c in names])

    def meet(held: Broadcast) -> DataFrame:
        def run(key: tuple, group: pa.Table) -> pa.Table:
            dim = key[0].as_py()
            own = Rows.of(group, dim)
            found = (ask(own, Rows.unpack(row), row["positives"]) for row in held.value if row["dim"] == dim)
            return pa.concat_tables([schema.empty_table(), *(pa.table(list(x), schema=schema) for x in found)])

        return best(sharded.applyInArrow(run, ", ".join(f"{c} long" for c in names)))

    return in_passes(blocked, passes, blocks, meet, name)


def hard_negatives(rows: DataFrame, anchors: DataFrame, id_column: str = "vec_id", vector: str = "embedding",
                   label: str = "label", positives: int = 5, negatives: int = 3, least_percent: int = 50,
                   most_percent: int = 95, scale: int = 256, shard_rows: int = 8192, block_rows: int = 256,
                   pass_bytes: int = PASS_BYTES) -> DataFrame:
    """For each anchor and each of its first positives, the best rows of other labels in the wanted range of scores.

    A component x counts as floor(scale * x); a score is the inner product of two such vectors. An anchor's positives are
    its best `positives` other rows of its label; a positive's negatives are the best `negatives` rows of other labels with
    least_percent * positive score <= 100 * score <= most_percent * positive score. Higher scores come first, ties go to
    the smaller id. Columns: anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    `anchors` are rows of the same table. Null ids, labels and vectors, and vectors with null or non-finite components,
    take no part; zero and empty vectors do (score 0). Repeated rows count once; of rows that share an id the one with the
    least (label, vector) counts. Vectors of different lengths are never compared. Scores must fit 63 bits. Other
    columns are ignored; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    ship(spark)

    def clean(df: DataFrame) -> DataFrame:
        own = df.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"),
                        F.col(f"`{vector}`").cast("array<double>").alias("vector"))
        finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        own = own.dropna().where(finite).withColumn("vector", F.transform("vector", lambda x: F.floor(x * scale)))
        return (own.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row"))
                .select("id", "row.label", "row.vector", F.size("row.vector").alias("dim")))

    index = stored(clean(rows), "rows")
    asked = stored(clean(anchors), "anchors")
    shards = max(1, -(-index.count() // shard_rows))
    sharded = (index.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
               .repartition(max(shards, partitions(spark)), "dim", "shard").groupBy("dim", "shard"))

    def find_positives(own: Rows, block: Rows, _: list) -> tuple[list, list, list]:
        out: tuple[list, list, list] = ([], [], [])
        for i in range(len(block.ids)):
            near, scores = best_of_label(own, block, i, positives)
            for column, values in zip(out, ([int(block.ids[i])] * len(near), own.ids[near].tolist(), scores.tolist())):
                column += values
        return out

    def find_negatives(own: Rows, block: Rows, given: list) -> tuple[list, list, list, list]:
        out: tuple[list, list, list, list] = ([], [], [], [])
        for i, of_anchor in enumerate(given):
            # Whole scores: 100 * score between two whole bounds. Equal positive scores want the same negatives.
            known = sorted(set(of_anchor))
            ranges = [(-(-least_percent * p // 100), most_percent * p // 100) for p in known]
            for p, (near, scores) in zip(known, best_in_ranges(own, block, i, ranges, negatives)):
                for column, values in zip(out, ([int(block.ids[i])] * len(near), [p] * len(near), own.ids[near].tolist(),
                                                scores.tolist())):
                    column += values
        return out

    near_order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    hard_order = Window.partitionBy("anchor_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id")

    def best_near(found: DataFrame) -> DataFrame:
        return found.withColumn("n", F.row_number().over(near_order)).where(F.col("n") <= positives).drop("n")

    def best_hard(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(hard_order)).where(F.col("rank") <= negatives)

    nothing = F.lit(None).cast("array<long>").alias("positives")
    near = _asked(sharded, asked.select("*", nothing), block_rows, pass_bytes, find_positives, best_near,
                  ["anchor_id", "positive_id", "positive_score"], "positives")
    lists = near.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list("positive_score").alias("positives"))
    # The size of stored vectors says little about their size in memory, so no side of this join may be broadcast.
    hard = _asked(sharded, asked.join(lists.hint("merge"), "id"), block_rows, pass_bytes, find_negatives, best_hard,
                  ["anchor_id", "positive_score", "negative_id", "negative_score"], "negatives")
    return near.join(hard, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
