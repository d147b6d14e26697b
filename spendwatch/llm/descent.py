"""Near-duplicate embeddings by nearest-neighbour descent.

1. Equal vectors fold into one node with a count, so copies cost nothing from here on. A node carries a sketch: 128 signs
   of projections on fixed random directions. Differing signs measure the angle between two nodes.
2. Start: in `trees` orders of their signs the nodes are sorted by ranges over the cluster and cut into leaves of `leaf`
   neighbours. Each node takes the nearest of its leaf into its neighbour list; its first and its farthest possible
   link of the leaf are kept besides, for they tie dense regions together.
3. Rounds: every node is a meeting place for the nodes of its list and those that list it (a join of the lists with
   themselves). Members that have not met before are compared, and each list keeps its nearest. A list that holds
   nothing but possible links is saturated: it doubles, up to `most`, and its members meet anew. Rounds end when they
   bring no possible link and no list has grown.
4. All possible links are confirmed on the vectors, in double precision; confirmed ones form components. Nodes whose list
   is saturated at `most` are dense: they are compared with all nodes of their component, by blocks, and only counts
   leave a pair of blocks. So no list length bounds a node's links.
5. Audit: a fixed number of nodes is compared with all rows. If fewer than `recall` of their links were found, new
   trees join the graph and the rounds go on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from spendwatch.llm.common import partitions, ship, stored
from spendwatch.llm.components import components
from spendwatch.llm.forest import usable

SIGNS = 128
_SEED = 11_11
PIECE = 24  # members of a meeting place that are compared with each other at a time


def possible_signs(threshold: float) -> int:
    """Differing signs up to which a pair may be a link: the expected number at the threshold and five deviations."""
    share = float(np.arccos(np.clip(threshold, -1, 1)) / np.pi)
    return min(SIGNS, int(SIGNS * share + 5 * np.sqrt(SIGNS * share * (1 - share))) + 1)


def units(vectors: pa.Array) -> np.ndarray:
    """The vectors (of one length) as rows of length 1."""
    dim = len(vectors[0])
    matrix = np.asarray(vectors.flatten(), np.float64).reshape(len(vectors), dim)
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def signs(matrix: np.ndarray) -> np.ndarray:
    """The sketch of each row as two 64-bit numbers."""
    directions = np.random.Generator(np.random.PCG64(_SEED)).standard_normal((matrix.shape[1], SIGNS))
    return np.packbits(matrix @ directions > 0, axis=1, bitorder="little").view("<u8")


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = np.asarray(batch.column("dim"))
    for dim in np.unique(dims):
        yield int(dim), batch.take(pa.array(np.flatnonzero(dims == dim)))


def _sketched(rows: DataFrame) -> DataFrame:
    """(dim, s1, s2, low, copies, vector) of every distinct vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in _by_length(batch):
                sketch = signs(units(part.column("vector"))).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("dim"), pa.array(sketch[:, 0]), pa.array(sketch[:, 1]), part.column("low"),
                     part.column("copies"), part.column("vector")], ["dim", "s1", "s2", "low", "copies", "vector"])

    return rows.mapInArrow(run, "dim int, s1 long, s2 long, low long, copies long, vector array<double>")


_EDGE = "u long, u1 long, u2 long, v long, v1 long, v2 long, signs int"


def _leaf_rows(nodes: DataFrame, trees: int, first: int) -> DataFrame:
    """(tree, dim, code, node, s1, s2): each tree reads the signs in an order of its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = [np.random.Generator(np.random.PCG64(_SEED + 1 + t)).permutation(SIGNS)[:63]
                  for t in range(first, first + trees)]
        weights = np.int64(1) << np.arange(62, -1, -1, dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            pair = np.stack([np.asarray(batch.column(c)) for c in ("s1", "s2")], axis=1).astype("<i8")
            bits = np.unpackbits(pair.view(np.uint8), axis=1, bitorder="little").astype(np.int64)
            for t, order in enumerate(orders):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(bits), first + t, np.int32)), batch.column("dim"),
                     pa.array(bits[:, order] @ weights), *(batch.column(c) for c in ("node", "s1", "s2"))],
                    ["tree", "dim", "code", "node", "s1", "s2"])

    return nodes.select("dim", "node", "s1", "s2").mapInArrow(
        run, "tree int, dim int, code long, node long, s1 long, s2 long")


def _leaf_edges(rows: DataFrame, leaf: int, take: int, possible: int) -> DataFrame:
    """Edges of each node to its nearest in the leaf, with `tie` for the further possible links."""
    def joined(table: pa.Table) -> pa.RecordBatch:
        node = table["node"].to_numpy()
        sketch = [table[c].to_numpy().view(np.uint64) for c in ("s1", "s2")]
        apart = sum(np.bitwise_count(s[:, None] ^ s[None, :]).astype(np.int16) for s in sketch)
        np.fill_diagonal(apart, SIGNS + 1)
        near = np.argpartition(apart, min(take, len(node) - 1) - 1, axis=1)[:, :min(take, len(node) - 1)]
        u, v = np.repeat(np.arange(len(node)), near.shape[1]), near.ravel()
        maybe = apart <= possible
        some = np.flatnonzero(maybe.any(axis=1))
        ends = [maybe[some].argmax(axis=1), np.where(maybe[some], apart[some], -1).argmax(axis=1)]
        tie = np.concatenate([np.zeros(len(u), bool), np.ones(2 * len(some), bool)])
        u, v = np.concatenate([u, some, some]), np.concatenate([v, *ends])
        s1, s2 = (s.view(np.int64) for s in sketch)
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (node[u], s1[u], s2[u], node[v], s1[v], s2[v], apart[u, v].astype(np.int32), tie)],
            ["u", "u1", "u2", "v", "v1", "v2", "signs", "tie"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            group = np.stack([held["tree"].to_numpy(), held["dim"].to_numpy()])
            borders = np.append(np.flatnonzero((np.diff(group, prepend=-1) != 0).any(axis=0)), held.num_rows)
            done = 0
            for begin, end in zip(borders[:-1], borders[1:]):
                last = end == held.num_rows  # the order may go on in the next batch
                for at in range(begin, end, leaf):
                    if last and at + 2 * leaf > end:
                        break
                    done = min(at + leaf, end)
                    start = max(begin, done - leaf)  # an order's last leaf reaches back to be a whole one
                    if done - start > 1:
                        yield joined(held.slice(start, done - start))
            held = held.slice(done)
        while held is not None and held.num_rows > 1:
            # What is left is of one order, less than two leaves.
            yield joined(held.slice(0, leaf))
            held = None if held.num_rows <= leaf else held.slice(min(leaf, held.num_rows - leaf))

    ordered = (rows.repartitionByRange(partitions(rows.sparkSession), "tree", "dim", "code", "node")
               .sortWithinPartitions("tree", "dim", "code", "node"))
    return ordered.mapInArrow(run, _EDGE + ", tie boolean")


def _nearest(edges: DataFrame, most: int, possible: int) -> DataFrame:
    """The lists: of the edges of each node u the `room` nearest; a saturated list gets twice the room, up to `most`.

    `fresh` edges have not met the others of their list; `worst` is what a new edge of u has to beat.
    """
    merged = edges.groupBy("u", "v").agg(
        *(F.first(c).alias(c) for c in ("u1", "u2", "v1", "v2", "signs")), F.min("fresh").alias("fresh"),
        F.max("room").alias("room"))
    whole = Window.partitionBy("u")
    ranked = (merged.withColumn("room", F.max("room").over(whole))
              .withColumn("n", F.row_number().over(whole.orderBy("signs", "v"))).where("n <= room"))
    full = (F.count("*").over(whole) >= F.col("room")) & (F.max("signs").over(whole) <= possible)
    dense = F.col("full") & (F.col("room") >= most)
    grown = F.col("full") & (F.col("room") < most)
    return (ranked.withColumns({"full": full, "length": F.count("*").over(whole), "far": F.max("signs").over(whole)})
            .withColumns({"dense": dense, "grown": grown,
                          # A grown list meets anew; a dense one waits for the exact count.
                          "fresh": (F.col("fresh") | grown) & ~dense,
                          "worst": F.when(grown | (F.col("length") < F.col("room")), SIGNS + 1).otherwise(F.col("far")),
                          "room": F.when(grown, F.least(2 * F.col("room"), F.lit(most))).otherwise(F.col("room"))})
            .drop("n", "full", "length", "far"))


def _signs_between(a: str, b: str) -> Column:
    return sum((F.bit_count(F.col(f"{a}{i}").bitwiseXOR(F.col(f"{b}{i}"))) for i in (1, 2)), F.lit(0)).cast("int")


def _met(lists: DataFrame) -> DataFrame:
    """New edges: members of one meeting place that are nearer to each other than the worst of their lists."""
    worst = lists.groupBy(F.col("u").alias("v")).agg(F.first("worst").alias("v_worst"))
    known = lists.join(worst, "v")
    entries = known.select(F.col("u").alias("at"), F.col("v").alias("m"), F.col("v1").alias("m1"), F.col("v2").alias("m2"),
                           "fresh", F.col("v_worst").alias("worst")).unionByName(
        known.select(F.col("v").alias("at"), F.col("u").alias("m"), F.col("u1").alias("m1"), F.col("u2").alias("m2"),
                     "fresh", "worst"))
    members = entries.groupBy("at", "m").agg(
        F.first("m1").alias("m1"), F.first("m2").alias("m2"), F.max("fresh").alias("fresh"), F.max("worst").alias("worst"))
    # A place with many members compares them in pieces: linear work, and nobody is left out.
    pieces = members.groupBy("at").agg(F.ceil(F.count("*") / PIECE).alias("pieces"))
    members = members.join(pieces, "at").withColumn("piece", F.pmod(F.xxhash64("m", "at"), F.col("pieces"))).drop("pieces")
    two = members.select("at", "piece", *(F.col(c).alias(f"o_{c}") for c in ("m", "m1", "m2", "fresh")))
    pairs = members.join(two, ["at", "piece"]).where("m != o_m and (fresh or o_fresh)")
    return (pairs.select(F.col("m").alias("u"), F.col("m1").alias("u1"), F.col("m2").alias("u2"),
                         F.col("o_m").alias("v"), F.col("o_m1").alias("v1"), F.col("o_m2").alias("v2"), "worst")
            .withColumn("signs", _signs_between("u", "v")).where("signs < worst").drop("worst"))


def _confirmed(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Those of the pairs (a, b) whose cosine reaches the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in _by_length(batch):
                score = (units(part.column("va")) * units(part.column("vb"))).sum(axis=1)
                yield part.select(["a", "b"]).filter(pa.array(score >= threshold))

    one = nodes.select(F.col("node").alias("a"), "dim", F.col("vector").alias("va"))
    two = nodes.select(F.col("node").alias("b"), F.col("vector").alias("vb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "dim", "va", "vb").mapInArrow(run, "a long, b long")


_BLOCK = "cluster long, side boolean, block long, nodes array<long>, copies array<long>, dense array<boolean>, matrix binary"


def _packed(key: tuple, group: pa.Table) -> pa.Table:
    group = group.sort_by("node")
    return pa.table({"cluster": pa.array([key[0].as_py()], pa.int64()), "side": pa.array([key[1].as_py()], pa.bool_()),
                     "block": pa.array([key[2].as_py()], pa.int64()),
                     "nodes": pa.array([group["node"].to_pylist()], pa.list_(pa.int64())),
                     "copies": pa.array([group["copies"].to_pylist()], pa.list_(pa.int64())),
                     "dense": pa.array([group["dense"].to_pylist()], pa.list_(pa.bool_())),
                     "matrix": pa.array([units(group["vector"].combine_chunks()).tobytes()], pa.binary())})


def _dense_counts(clusters: DataFrame, nodes: DataFrame, dense: DataFrame, threshold: float, block: int) -> DataFrame:
    """(node, n): for dense nodes the vectors of their component that they link with, for others the dense ones."""
    hot = clusters.join(dense, "node").select("component").distinct()
    rows = (clusters.join(hot, "component", "left_semi").join(dense.withColumn("dense", F.lit(True)), "node", "left")
            .join(nodes.select("node", "copies", "vector"), "node")
            .select("node", "copies", "vector", F.col("component").alias("cluster"),
                    F.coalesce("dense", F.lit(False)).alias("dense")))
    # One side holds the dense nodes, the other all nodes of the component.
    sides = rows.withColumn("side", F.explode(F.when(F.col("dense"), F.array(F.lit(True), F.lit(False)))
                                              .otherwise(F.array(F.lit(False)))))
    sizes = sides.groupBy("cluster", "side").agg(F.ceil(F.count("*") / block).alias("blocks"))
    blocks = stored(
        sides.join(sizes, ["cluster", "side"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
        .groupBy("cluster", "side", "block").applyInArrow(_packed, _BLOCK), "blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                a, ca, b, cb = (np.asarray(row[c], np.int64) for c in ("na", "ca", "nb", "cb"))
                one, two = np.frombuffer(row["ma"]).reshape(len(a), -1), np.frombuffer(row["mb"]).reshape(len(b), -1)
                hit = (one @ two.T >= threshold) & (a[:, None] != b[None, :])
                other = ~np.asarray(row["dense"], bool)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, b[other]])),
                                                  pa.array(np.concatenate([hit @ cb, hit[:, other].T @ ca]))], ["node", "n"])

    # Blocks, not rows, meet each other.
    one = blocks.where("side").select("cluster", F.col("nodes").alias("na"), F.col("copies").alias("ca"),
                                      F.col("matrix").alias("ma"))
    one = one.join(sizes.where("not side"), "cluster").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    two = blocks.where("not side").select("cluster", "block", F.col("nodes").alias("nb"), F.col("copies").alias("cb"),
                                          "dense", F.col("matrix").alias("mb"))
    met = one.select("cluster", "block", "na", "ca", "ma").join(two, ["cluster", "block"])
    return met.mapInArrow(run, "node long, n long").where("n > 0").groupBy("node").agg(F.sum("n").alias("n"))


def _true_counts(nodes: DataFrame, sample: DataFrame, threshold: float) -> DataFrame:
    """(node, n): with how many other vectors each node of the sample really links; all rows are read."""
    rows = sample.select("node", "dim", "vector").collect()  # a fixed number
    held = {}
    for dim in {r.dim for r in rows}:
        own = [r for r in rows if r.dim == dim]
        held[dim] = (np.asarray([r.node for r in own]), units(pa.array([r.vector for r in own], pa.list_(pa.float64()))))
    given = nodes.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in _by_length(batch):
                if dim in given.value:
                    names, matrix = given.value[dim]
                    hit = (matrix @ units(part.column("vector")).T >= threshold)
                    hit &= names[:, None] != np.asarray(part.column("node"))[None, :]
                    n = hit @ np.asarray(part.column("copies"))
                    yield pa.RecordBatch.from_arrays([pa.array(names[n > 0]), pa.array(n[n > 0])], ["node", "n"])

    return (nodes.select("node", "dim", "copies", "vector").mapInArrow(run, "node long, n long")
            .groupBy("node").agg(F.sum("n").alias("n")))


def near_duplicates(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", threshold: float = 0.95,
                    trees: int = 8, leaf: int = 128, start: int = 8, most: int = 32, rounds: int = 12,
                    audited: int = 1000, recall: float = 0.99, tries: int = 3, block: int = 1024) -> DataFrame:
    """One row per id and vector: the id column (as long), n_links, component_id, kept (id = component_id).

    Vectors link if their cosine is at least `threshold`. n_links counts the other rows linked directly, copies too;
    component_id is the smallest id reachable by links. Vectors that are null, empty, zero, or hold null or non-finite
    components link with nothing. Repeated rows count and come back once; rows that share an id and differ are vectors of
    their own. A row with a null id links with nothing: component_id null, kept true. Vectors of different lengths are
    never linked. Other columns are ignored; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    ship(spark)
    given = rows.select(F.col(f"`{id_column}`").cast("long").alias("id"),
                        F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    given = given.withColumn("good", usable(F.col("vector")) & F.col("id").isNotNull())
    folded = given.where("good").groupBy("vector").agg(F.min("id").alias("low"), F.count_distinct("id").alias("copies"))
    nodes = _sketched(folded.select(F.size("vector").alias("dim"), "low", "copies", "vector"))
    # The numbers are fixed by the write.
    nodes = stored(stored(nodes, "vectors").withColumn("node", F.monotonically_increasing_id()), "nodes")
    possible = possible_signs(threshold)
    sample = stored(nodes.orderBy(F.xxhash64("node")).limit(audited), "audit")
    real = stored(_true_counts(nodes, sample, threshold), "audit-links")
    wanted = real.agg(F.sum("n")).first()[0] or 0

    lists, ties = None, None
    for attempt in range(tries):
        grown = stored(_leaf_edges(_leaf_rows(nodes, trees, attempt * trees), leaf, max(1, start // 2), possible), "leaves")
        far = grown.where("tie").select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
        ties = far if ties is None else ties.unionByName(far).distinct()
        new = grown.drop("tie").withColumns({"fresh": F.lit(True), "room": F.lit(start)})
        known = new if lists is None else new.unionByName(lists.select(*new.columns))
        lists = stored(_nearest(known, most, possible), "lists")
        for _ in range(rounds):
            met = _met(lists).withColumns({"fresh": F.lit(True), "room": F.lit(start)})
            old = lists.withColumn("fresh", F.lit(False)).select(*met.columns)
            lists = stored(_nearest(old.unionByName(met), most, possible), "lists")
            if lists.where((F.col("fresh") & (F.col("signs") <= possible)) | F.col("grown")).isEmpty():
                break
        maybe = lists.where(F.col("signs") <= possible).select(
            F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).unionByName(ties).distinct()
        links = stored(_confirmed(maybe, nodes, threshold), "links")
        clusters = components(links)
        dense = stored(lists.where("dense").select(F.col("u").alias("node")).distinct(), "dense")
        counts = _link_counts(links, clusters, nodes, dense, threshold, block)
        counts = stored(counts, "counts")
        found = real.join(counts, "node").agg(F.sum(F.least(real.n, counts.n))).first()[0] or 0
        if found >= recall * wanted:
            break

    of_node = (nodes.select("node", "vector", "low", "copies").join(clusters, "node", "left")
               .join(counts, "node", "left"))
    named = of_node.withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = named.join(least, "component").select(
        "vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = given.where("good").select("id", "vector").distinct().join(named, "vector").drop("vector")
    alone = given.where(~F.col("good")).select("id", "vector").distinct().select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_column), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _link_counts(links: DataFrame, clusters: DataFrame, nodes: DataFrame, dense: DataFrame, threshold: float,
                 block: int) -> DataFrame:
    """(node, n): the vectors of other nodes that each node links with."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if dense.isEmpty():
        listed = both
        exact = None
    else:
        # Links with a dense node come from the exact count, on both ends.
        listed = both.join(dense.withColumnRenamed("node", "a"), "a", "left_anti").join(
            dense.withColumnRenamed("node", "b"), "b", "left_anti")
        exact = _dense_counts(clusters, nodes, dense, threshold, block)
    counts = (listed.join(nodes.select(F.col("node").alias("b"), "copies"), "b")
              .select(F.col("a").alias("node"), F.col("copies").alias("n")))
    if exact is not None:
        counts = counts.unionByName(exact)
    return counts.groupBy("node").agg(F.sum("n").alias("n"))
