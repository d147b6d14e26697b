"""Near-duplicate documents by an LSH forest over MinHash signatures.

1. Every document becomes the set of its distinct word shingles (64-bit hashes). Equal sets fold into one node, named by
   their smallest id, so a group of exact copies is a single node from here on.
2. Every tree reads a node's signature in an order of its own. The nodes of all trees are sorted, by ranges over the
   cluster, by their first `depth` values and then by the further ones. Nodes that agree in the first `depth` values form a
   region; each is paired with the next `reach` nodes of its region. So a small region pairs all its nodes at the least
   depth, and in a dense one the pairs are those with the longest common prefixes, as deep as the region needs.
3. Candidate pairs join nodes into clusters, and every pair is confirmed on the full shingle sets of whole texts, unless
   its ends are connected already. A cluster is dealt out in blocks of about `block` nodes. Each block first compares its
   nodes with the one nearest to what most of them share (the centre), then follows its pairs; the best centres of a split
   cluster meet all its nodes, then the pairs between blocks follow. No step emits all pairs of a group.
4. Links form components; the smallest id names a component.
5. A region's nodes lie in one cluster, as each is paired with the next. In a cluster that is larger than `reach` + 1 and is
   not one component yet, the nodes outside of its largest component meet all its nodes, in blocks: pairs of different
   components whose signatures may reach the threshold (up to four deviations below it) are compared on their sets. Only
   links leave a pair of blocks. So `reach` and the depth of the order bound the work, not the links.

With 32 trees of depth 6, two documents at the threshold of 0.85 meet in a region but for a chance of 3 in 10 million, at
0.80 of 6 in 100 thousand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from spendwatch.llm.common import mix, partitions, ship, slices, stored, word_hashes
from spendwatch.llm.components import components, forest

SHINGLE = 5
HASHES, TREES, DEPTH, TAIL = 128, 32, 6, 4
WEIGHT = 4_000_000  # shingles of a block: many short texts or few long ones
_RANDOM = np.random.Generator(np.random.PCG64(77))
_FACTORS = _RANDOM.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ORDERS = np.stack([_RANDOM.permutation(HASHES)[:DEPTH + TAIL] for _ in range(TREES)])


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and where each text's begin. Fewer words make one shingle."""
    words, first = word_hashes(texts)
    n = len(first) - 1
    counts = np.diff(first)
    with np.errstate(over="ignore"):
        rolling = np.zeros(len(words), np.uint64)
        for j in range(size):
            part = np.zeros(len(words), np.uint64)
            part[:len(words) - j] = words[j:]
            rolling = mix(rolling * np.uint64(0x9E3779B97F4A7C15) + part)
        doc = np.repeat(np.arange(n), counts)
        whole = np.arange(len(words)) + size <= first[1:][doc]
        short = np.flatnonzero((counts > 0) & (counts < size))
        for i in short:  # at most size - 1 words each
            value = np.uint64(counts[i])
            for w in words[first[i]:first[i + 1]]:
                value = mix(np.asarray([value * np.uint64(0x9E3779B97F4A7C15) + w]))[0]
            rolling[first[i]], whole[first[i]] = value, True
    hashes, doc = rolling[whole], doc[whole]
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[fresh], np.searchsorted(doc[fresh], np.arange(n + 1))


def signatures(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """16-bit MinHash values of every set that is not empty (rows)."""
    starts = at[:-1][at[1:] > at[:-1]]
    out = np.empty((len(starts), HASHES), np.uint16)
    if len(starts):
        with np.errstate(over="ignore"):
            for i, factor in enumerate(_FACTORS):
                out[:, i] = np.minimum.reduceat(hashes * factor, starts) >> np.uint64(48)
    return out


def links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets reach the similarity, exactly."""
    small, large = min(len(a), len(b)), max(len(a), len(b))
    if not small or 100 * small < percent * large:
        return False
    merged = np.concatenate([a, b])
    merged.sort(kind="stable")
    common = int((merged[1:] == merged[:-1]).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _sets(docs: DataFrame) -> DataFrame:
    """(id, n, h1, h2, signature) of every row with an id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            hashes, at = shingle_sets(batch.column("text"))
            n = np.diff(at)
            filled = n > 0
            names = np.zeros((2, len(n)), np.uint64)
            with np.errstate(over="ignore"):
                for i in range(2):
                    if filled.any():
                        names[i, filled] = np.add.reduceat(mix(hashes + np.uint64(i)), at[:-1][filled])
            raw = signatures(hashes, at).astype("<u2").tobytes()
            place = np.cumsum(filled) - 1
            packed = [raw[2 * HASHES * p:2 * HASHES * (p + 1)] if f else b"" for p, f in zip(place, filled)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n.astype(np.int64)), pa.array(names[0].astype(np.int64)),
                 pa.array(names[1].astype(np.int64)), pa.array(packed, pa.binary())],
                ["id", "n", "h1", "h2", "signature"])

    return docs.mapInArrow(run, "id long, n long, h1 long, h2 long, signature binary")


def _tree_rows(nodes: DataFrame) -> DataFrame:
    """(region, further, node) for every node and tree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            packed = b"".join(batch.column("signature").to_pylist())
            values = np.frombuffer(packed, "<u2").reshape(-1, HASHES).astype(np.uint64)
            regions, further = [], []
            with np.errstate(over="ignore"):
                for tree, order in enumerate(_ORDERS):
                    region = np.full(len(values), tree + 1, np.uint64)
                    for column in order[:DEPTH]:
                        region = mix(region * np.uint64(0x9FB21C651E98DF25) + values[:, column])
                    rest = np.zeros(len(values), np.uint64)
                    for column in order[DEPTH:]:
                        rest = rest << np.uint64(16) | values[:, column]
                    regions.append(region)
                    further.append(rest)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(regions).astype(np.int64)), pa.array(np.concatenate(further).astype(np.int64)),
                 pa.array(np.tile(np.asarray(batch.column("node")), TREES))], ["region", "further", "node"])

    return nodes.select("node", "signature").mapInArrow(run, "region long, further long, node long")


def _neighbours(rows: DataFrame, reach: int) -> DataFrame:
    """(a, b) of neighbours within `reach` in the sorted orders, inside a region, a < b."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for batch in batches:
            region = np.concatenate([held[0], np.asarray(batch.column("region"))])
            node = np.concatenate([held[1], np.asarray(batch.column("node"))])
            new = len(held[0])
            pairs = []
            for step in range(1, reach + 1):
                right = np.arange(max(new, step), len(node))  # pairs that end in this batch
                right = right[region[right] == region[right - step]]
                pairs.append(np.stack([node[right - step], node[right]]))
            both = np.sort(np.concatenate(pairs, axis=1), axis=0)
            both = np.unique(both[:, both[0] < both[1]], axis=1)
            held = (region[-reach:], node[-reach:])
            yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["a", "b"])

    ordered = (rows.repartitionByRange(partitions(rows.sparkSession), "region", "further", "node")
               .sortWithinPartitions("region", "further", "node"))
    return ordered.select("region", "node").mapInArrow(run, "a long, b long")


def _sets_of(texts: pa.ChunkedArray) -> list[np.ndarray]:
    hashes, at = shingle_sets(texts)
    return [hashes[a:b] for a, b in zip(at[:-1], at[1:])]


def _confirm_block(percent: int):
    """Confirmed links of one block as stars, and its centre."""
    schema = pa.schema([("cluster", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("score", pa.float64())])

    def run(key: tuple, nodes: pa.Table, pairs: pa.Table) -> pa.Table:
        if not nodes.num_rows:
            return schema.empty_table()
        nodes = nodes.sort_by("node")
        names = nodes["node"].to_numpy()
        sets = _sets_of(nodes["text"])
        parent = list(range(len(names)))

        def top(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        def follow(i: int, j: int) -> None:
            i, j = top(i), top(j)
            parent[max(i, j)] = min(i, j)

        # The centre: the node most alike to what more than half of the block's nodes hold.
        values, df = np.unique(np.concatenate(sets), return_counts=True)
        shared = values[2 * df > len(sets)]
        inside = [int(np.isin(s, shared, assume_unique=True).sum()) if len(shared) else 0 for s in sets]
        alike = np.asarray([c / max(len(s) + len(shared) - c, 1) for c, s in zip(inside, sets)])
        centre = int(alike.argmax())
        if alike[centre] > 0:
            for i in range(len(sets)):
                if i != centre and top(i) != top(centre) and links(sets[i], sets[centre], percent):
                    follow(i, centre)
        left = np.searchsorted(names, pairs["a"].to_numpy())
        right = np.searchsorted(names, pairs["b"].to_numpy())
        for i, j in zip(left.tolist(), right.tolist()):
            if top(i) != top(j) and links(sets[i], sets[j], percent):
                follow(i, j)
        cluster = key[0].as_py()
        stars = [(cluster, int(names[i]), int(names[top(i)]), None) for i in range(len(names)) if top(i) != i]
        stars.append((cluster, int(names[centre]), None, float(alike[centre])))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*stars), schema.types)], schema=schema)

    return run


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets reach the similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_a", 1 << 20):
            for piece in slices([batch], "text_b", 1 << 20):
                one, two = _sets_of(piece.column("text_a")), _sets_of(piece.column("text_b"))
                good = pa.array([links(x, y, percent) for x, y in zip(one, two)], pa.bool_())
                yield piece.select(["a", "b"]).filter(good)

    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs whose ends lie in different components so far, one for each two components and node."""
    of = found.select(F.col("node").alias("a"), F.col("component").alias("of_a"))
    to = found.select(F.col("node").alias("b"), F.col("component").alias("of_b"))
    return (pairs.join(of, "a", "left").join(to, "b", "left")
            .withColumns({"of_a": F.coalesce("of_a", "a"), "of_b": F.coalesce("of_b", "b")})
            .where("of_a != of_b").select("a", "b"))


def _link_blocks(percent: int):
    """Links between different components, from a block of outer nodes and a block of all nodes of a cluster."""
    share = percent / 100
    least = HASHES * (share - 4 * np.sqrt(share * (1 - share) / HASHES))

    def run(one: pa.Table, two: pa.Table) -> pa.Table:
        if not one.num_rows or not two.num_rows:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        names, others = one["node"].to_numpy(), two["node"].to_numpy()
        marks = [np.frombuffer(b"".join(t["signature"].to_pylist()), "<u2").reshape(-1, HASHES) for t in (one, two)]
        of, to = one["of"].to_numpy(), two["of"].to_numpy()
        outer = np.asarray(two["outer"].to_pylist(), bool)
        hashes, at = shingle_sets(two["text"])
        sets = _sets_of(one["text"])
        sizes = np.diff(at)
        a, b = [], []
        for i, own in enumerate(sets):
            # A pair of outer nodes meets in both orders; one is enough.
            near = np.flatnonzero((of[i] != to) & ~(outer & (others > names[i])))
            near = near[(marks[1][near] == marks[0][i]).sum(axis=1) >= least]
            for begin in range(0, len(near), 64):
                part = near[begin:begin + 64]
                starts = np.cumsum(sizes[part]) - sizes[part]
                flat = hashes[np.arange(int(sizes[part].sum())) + np.repeat(at[:-1][part] - starts, sizes[part])]
                place = np.minimum(np.searchsorted(own, flat), len(own) - 1)
                common = np.add.reduceat((own[place] == flat).astype(np.int64), starts)
                good = part[100 * common >= percent * (len(own) + sizes[part] - common)]
                a.append(np.full(len(good), names[i]))
                b.append(others[good])
        a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (a, b))
        return pa.table(dict(zip("ab", map(pa.array, forest(a, b)))))

    return run


def _outer_links(dealt: DataFrame, found: DataFrame, nodes: DataFrame, texts: DataFrame, percent: int, reach: int,
                 block: int) -> DataFrame:
    """Links (a, b) that the neighbours in the orders did not show, exactly; None if all clusters are settled."""
    own = dealt.where(F.col("size") > reach + 1).join(found, "node", "left").select(
        "node", "cluster", "weight", F.coalesce("component", "node").alias("of"))
    own = stored(own, "open")
    parts = own.groupBy("cluster", "of").agg(F.count("*").alias("n"))
    largest = parts.groupBy("cluster").agg(F.max(F.struct("n", "of"))["of"].alias("main"), F.count("*").alias("parts"))
    state = (own.join(largest.where("parts > 1"), "cluster")
             .withColumn("outer", F.col("of") != F.col("main")).drop("main", "parts"))
    if state.isEmpty():
        return None
    amount = F.ceil(F.greatest(F.count("*") / block, F.sum("weight") / WEIGHT))
    blocks = state.groupBy("cluster").agg(
        amount.alias("blocks"), F.greatest(F.ceil(F.count_if("outer") / block), F.ceil(
            F.sum(F.when(F.col("outer"), F.col("weight"))) / WEIGHT)).alias("outer_blocks"))
    full = (stored(state.join(blocks, "cluster").join(nodes.select("node", "signature"), "node"), "sides")
            .join(texts.select("node", "text"), "node"))
    # Each block of one side is sent to each block of the other.
    one = full.where("outer").select("node", "signature", "of", "text", "cluster",
                                     F.pmod(F.xxhash64("node"), F.col("outer_blocks")).alias("x"),
                                     F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("y"))
    two = full.select("node", "signature", "of", "text", "outer", "cluster",
                      F.explode(F.sequence(F.lit(0).cast("long"), F.col("outer_blocks") - 1)).alias("x"),
                      F.pmod(F.xxhash64("node"), F.col("blocks")).alias("y"))
    one = one.toDF(*one.columns)  # columns of its own beside those of the other side
    return (one.groupBy("cluster", "x", "y").cogroup(two.groupBy("cluster", "x", "y"))
            .applyInArrow(_link_blocks(percent), "a long, b long"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", percent: int = 85,
                    reach: int = 4, block: int = 1500, centres: int = 4) -> DataFrame:
    """One row per input row: the id column (as long), n_shingles, component_id, kept (id = component_id).

    Words are runs of other characters than ASCII white space, A-Z lowered; a set holds a text's distinct 5-word shingles, or
    all its words as one if there are fewer. Documents are linked if 100 * intersection >= percent * union.
    component_id is the smallest id reachable. Null and empty texts have no shingles and are linked with nothing. Rows
    with a null id are not linked: component_id null, kept true. Rows that share an id count as one document.
    Other columns are ignored; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    sets = stored(_sets(rows), "sets")
    nodes = (sets.where("n > 0 and id is not null").groupBy("h1", "h2", "n")
             .agg(F.min("id").alias("node"), F.first("signature").alias("signature")))
    nodes = stored(nodes, "nodes")
    pairs = stored(_neighbours(_tree_rows(nodes), reach).distinct(), "pairs")
    clusters = components(pairs)
    weighed = clusters.join(nodes.select("node", F.col("n").alias("weight")), "node")
    sizes = weighed.groupBy("component").agg(F.count("*").alias("size"), F.sum("weight").alias("whole"))
    dealt = (weighed.join(sizes, "component")
             .withColumn("parts", F.ceil(F.greatest(F.col("size") / block, F.col("whole") / WEIGHT)))
             .select("node", F.col("component").alias("cluster"), "parts", "size", "weight",
                     F.pmod(F.xxhash64("node"), F.col("parts")).alias("part")))
    dealt = stored(dealt, "clusters")
    texts = stored(rows.join(dealt.select(F.col("node").alias("id"), "cluster", "part"), "id")
                   .withColumnRenamed("id", "node").dropDuplicates(["node"]), "texts")
    left = dealt.select(F.col("node").alias("a"), "cluster", "part")
    right = dealt.select(F.col("node").alias("b"), F.col("part").alias("part_b"))
    placed = stored(pairs.join(left, "a").join(right, "b"), "placed")
    stars = (texts.select("cluster", "part", "node", "text").groupBy("cluster", "part")
             .cogroup(placed.where("part = part_b").select("cluster", "part", "a", "b").groupBy("cluster", "part"))
             .applyInArrow(_confirm_block(percent), "cluster long, a long, b long, score double"))
    stars = stored(stars, "stars")
    linked = stars.where("b is not null").select("a", "b")
    # Clusters in several blocks: their best centres against all nodes, then the pairs between blocks.
    split = dealt.where("parts > 1")
    if not split.isEmpty():
        best = Window.partitionBy("cluster").orderBy(F.desc("score"), "a")
        centre = (stars.where("score is not null").join(split.select("cluster").distinct(), "cluster", "left_semi")
                  .withColumn("n", F.row_number().over(best)).where(F.col("n") <= centres)
                  .select("cluster", F.col("a").alias("centre")))
        to_centre = split.select("cluster", "node").join(centre, "cluster").select(
            F.col("node").alias("a"), F.col("centre").alias("b")).where("a != b")
        linked = stored(linked.unionByName(
            _confirmed(_apart(to_centre, components(linked)), texts, percent)), "links")
        across = placed.where("part != part_b").select("a", "b")
        linked = linked.unionByName(_confirmed(_apart(across, components(linked)), texts, percent))
    linked = stored(linked, "linked")
    found = components(linked)
    further = _outer_links(dealt, found, nodes, texts, percent, reach, block // 2 or 1)
    if further is not None:
        found = components(linked.unionByName(further))
    of_node = nodes.select("h1", "h2", "n", "node").join(found, "node", "left").select(
        "h1", "h2", "n", F.coalesce("component", "node").alias("component"))
    own = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component")).otherwise(F.col("id"))
    return (sets.select("id", "n", "h1", "h2").join(of_node, ["h1", "h2", "n"], "left")
            .select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), own.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_column) == F.col("component_id"), F.lit(True))))
