"""Operator 12: near-duplicate embeddings by a forest of random-projection trees.

Equal vectors become one with a weight. A tree splits its vectors again and again by their projection on a
random direction, where few lie near the cut; what is nearer to it than a third of what parts two vectors
at the threshold, on the average direction, goes to both sides. No cut is made through a dense group (most
members so near any cut that it would part links): it stays a leaf, however large. Cuts are fitted on a bounded
sample (``SAMPLE`` vectors by hash); every vector is then dealt by them to its leaves in ``TREES``
trees. Where the sample is too thin for the number of vectors, a leaf goes on by further random directions
through its centre. Vectors of a leaf meet in one task and are compared by cosine, in double precision. A leaf
too large to be held, found by counting, is dealt in blocks, and each pair of its blocks meets in
a task of its own: slower (the work is the square of a dense group's size), but nothing is left out.

A vector carries the list of its leaves, so a pair that meets in several leaves is counted in the first of
them only: leaves give each member's number of links and edges that span what is connected there, never pairs.
Sums by vector and connected components follow. No pair below the threshold is ever counted; a pair above
it is lost if every tree parts it. Parting grows rarer the closer two vectors are: recall is measured against brute
force in the README.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component link with nothing
(no links, a component of their own), nor do rows with a null id (their component is null and they are kept);
rows repeated with the same id are vectors of their own, linked to each other, and the kept one's copies are kept
with it, as they bear its id; vectors meet only vectors of the same length; an empty table gives none;
further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from smogline.operators.joins import checked_broadcast
from smogline.session import pin_table

from . import common
from .components import components

#: Trees; vectors that a leaf should hold; vectors of a block that is compared with another; fitted vectors.
TREES, LEAF, BLOCK, SAMPLE = 10, 512, 1024, 16_384
#: What goes to both sides, against the standard deviation of what parts two vectors at the threshold along a random
#: direction; share of a node's vectors within one such deviation of a cut, by bit of division, that makes it too dense.
SPILL, DENSE = 0.36, 0.65
#: Fewest fitted vectors of a leaf; random directions; directions tried at a cut; cuts below a fitted leaf at most.
FEWEST, DIRECTIONS, TRIED, DEEPEST = 64, 256, 6, 30


def _mixed(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def units(rows: list[np.ndarray], dim: int) -> np.ndarray:
    """Rows cut or filled up to ``dim`` components, of length 1: for dealing only."""
    out = np.zeros((len(rows), dim))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r[:dim]
    out /= np.maximum(np.abs(out).max(axis=1, initial=0), 1e-300)[:, None]
    return out / np.maximum(np.linalg.norm(out, axis=1), 1e-300)[:, None]


class Forest:
    """Random-projection trees over unit vectors, grown on a sample that stands for ``total`` vectors."""

    def __init__(self, sample: np.ndarray, total: int, least: float, trees: int = TREES, leaf: int = LEAF, seed: int = 12):
        rng = np.random.default_rng(seed)
        self.dim = sample.shape[1]
        self.pool = rng.standard_normal((DIRECTIONS, self.dim)) / np.sqrt(max(self.dim, 1))
        self.each = max(1.0, total / max(1, len(sample)))
        self.leaf = leaf
        self.apart = float(np.sqrt(max(0.0, 2 - 2 * least) / max(self.dim, 1)))
        projected = sample @ self.pool.T
        # a node: its direction (-1: a leaf), where it is cut, its sides, cuts below a leaf
        self.nodes: list[list] = []
        self.centre: dict[int, np.ndarray] = {}
        self.roots = [self._grow(projected, np.arange(len(sample)), rng) for _ in range(trees)]
        columns = list(zip(*self.nodes))
        self.direction, self.left, self.right, self.deeper = (np.array(columns[i], np.int64) for i in (0, 2, 3, 4))
        self.cut = np.array(columns[1], float)
        del self.nodes

    def _grow(self, projected: np.ndarray, members: np.ndarray, rng) -> int:
        """The number of a new tree's root."""
        root = self._node()
        todo = [(root, members)]
        while todo:
            at, members = todo.pop()
            size = len(members) * self.each
            if size <= self.leaf or not len(members):
                continue
            if len(members) <= FEWEST:
                self.nodes[at][4] = min(DEEPEST, int(np.ceil(1.25 * np.log2(size / self.leaf))))
                self.centre[at] = projected[members].mean(axis=0)
                continue
            best = min((self._cost(projected[members, d], share) + (d,) for d in rng.integers(0, DIRECTIONS, TRIED).tolist()
                        for share in (0.3, 0.4, 0.5, 0.6, 0.7)))
            if best[0] <= DENSE:
                _, cut, d = best
                p, sides = projected[members, d], (self._node(), self._node())
                self.nodes[at][:4] = d, cut, *sides
                todo += [(sides[0], members[p <= cut + SPILL * self.apart]), (sides[1], members[p >= cut - SPILL * self.apart])]
        return root

    def _cost(self, p: np.ndarray, share: float) -> tuple[float, float]:
        """(share of the vectors near the cut by bit of division, the cut): infinite if a side would hold nearly all."""
        cut = float(np.quantile(p, share))
        left, right = (p <= cut + SPILL * self.apart).mean(), (p >= cut - SPILL * self.apart).mean()
        if max(left, right) > 0.85:
            return np.inf, cut
        bits = -(share * np.log2(share) + (1 - share) * np.log2(1 - share))
        return float((np.abs(p - cut) <= self.apart).mean() / bits), cut

    def _node(self) -> int:
        self.nodes.append([-1, 0.0, -1, -1, 0])
        return len(self.nodes) - 1

    def deal(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of every leaf that a row comes to, in the order of rows and cells."""
        projected = x @ self.pool.T
        row = np.tile(np.arange(len(x)), len(self.roots))
        node = np.repeat(np.array(self.roots, np.int64), len(x))
        done = [(row[:0], node[:0])]
        while len(row):
            end = self.direction[node] < 0
            if end.any():
                done += self._below(projected, row[end], node[end])
                row, node = row[~end], node[~end]
            p = projected[row, self.direction[node]]
            left, right = p <= self.cut[node] + SPILL * self.apart, p >= self.cut[node] - SPILL * self.apart
            row, node = (np.concatenate([row[left], row[right]]),
                         np.concatenate([self.left[node[left]], self.right[node[right]]]))
        row, cell = (np.concatenate(a) for a in zip(*done))
        order = np.lexsort((cell, row))
        return row[order], cell[order]

    def _below(self, projected, row, node):
        """Cells of fitted leaves: the leaf and the sides taken at the cuts through its centre."""
        plain = self.deeper[node] == 0
        yield row[plain], (node[plain] << 32) + 1
        for leaf in np.unique(node[~plain]).tolist():
            r = row[node == leaf]
            path = np.ones(len(r), np.int64)
            centre, margin = self.centre[leaf], SPILL * self.apart
            for _ in range(int(self.deeper[leaf])):
                d = (_mixed((leaf << 32) + path) % np.uint64(DIRECTIONS)).astype(np.int64)
                p = projected[r, d] - centre[d]
                left, right = p <= margin, p >= -margin
                r, path = np.concatenate([r[left], r[right]]), np.concatenate([2 * path[left], 2 * path[right] + 1])
            yield r, (leaf << 32) + path


def usable(vec: Column, id_col: str) -> Column:
    """Whether a vector can link with others."""
    x = vec.cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.coalesce(F.col(id_col).isNotNull() & fine & F.exists(x, lambda v: v != 0), F.lit(False))


def name_of(vec: Column) -> Column:
    """126 bits of two hashes as one number: equal vectors have equal names."""
    high = F.xxhash64(F.lit(1), vec).bitwiseAND(F.lit(2**62 - 1)).cast("decimal(19,0)")
    low = F.xxhash64(F.lit(2), vec).bitwiseAND(F.lit(2**62 - 1)).cast("decimal(19,0)")
    return (high * F.lit(2**62).cast("decimal(19,0)") + low).cast("decimal(38,0)")


def grown(nodes: DataFrame, least: float, **sizes) -> Forest:
    """A forest fitted on at most ``SAMPLE`` of the distinct vectors, by hash."""
    total = nodes.count()
    place = F.pmod(F.xxhash64(F.lit("sample"), "u"), F.lit(1 << 30))
    few = nodes.filter(place < int(min(1.0, 1.5 * SAMPLE / max(1, total)) * (1 << 30))).orderBy(place, "u").limit(SAMPLE)
    got = [np.asarray(v.as_py(), float) for v in few.select("vec").toArrow().column("vec")]
    return Forest(units(got, max(map(len, got), default=1)), total, least, **sizes)


def scaled(part: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled by powers of two, so nothing overflows and no bit changes, and their lengths."""
    x = np.array(part, np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
    return x, np.sqrt(np.square(x).sum(axis=1))


def compared(x: np.ndarray, length: np.ndarray, cells: list[np.ndarray], weight: np.ndarray, block: np.ndarray, cell: int,
             across: bool, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(members with links, their number of links that no earlier cell counts, the first member each is connected
    with): the vectors of a cell, or of two of its blocks, when only links across count."""
    hit = x @ x.T >= least * np.outer(length, length)
    np.fill_diagonal(hit, False)
    if across:
        hit &= block[:, None] != block[None, :]
    at = np.flatnonzero(hit.any(axis=1))
    if not len(at):
        return at, at, at
    hit = hit[np.ix_(at, at)]
    # earlier cells that two of these members share
    before = [cells[i][cells[i] < cell] for i in at]
    member = np.repeat(np.arange(len(at)), [len(b) for b in before])
    names, place, often = np.unique(np.concatenate(before), return_inverse=True, return_counts=True)
    shared = np.cumsum(often > 1) - 1
    held = often[place] > 1
    inside = np.zeros((len(at), int((often > 1).sum())), np.float32)
    inside[member[held], shared[place[held]]] = 1
    links = (hit & (inside @ inside.T == 0)) @ weight[at]
    first, was = np.arange(len(at)), None
    while was is None or (first != was).any():
        was = first
        first = np.minimum(first, np.where(hit, first[None, :], len(at)).min(axis=1))
        first = first[first]
    return at, links, at[first]


def links(nodes: DataFrame, forest: Forest, least: float, block: int = BLOCK) -> DataFrame:
    """(u, n long, v): of each cell's members that have links there, how many are counted and the
    first member that each is connected with."""
    def cells_of(batch):
        return forest.deal(units([np.asarray(v.values, float) for v in batch.column(0)], forest.dim))

    def name_cells(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(cells_of(batch)[1])], names=["cell"])

    def deal(batches):
        for batch in batches:
            row, cell = cells_of(batch)
            own = pa.array(np.split(cell, np.flatnonzero(np.diff(row)) + 1), pa.list_(pa.int64()))
            for lo in range(0, len(row), 8192):
                take = pa.array(row[lo:lo + 8192])
                yield pa.RecordBatch.from_arrays([pa.array(cell[lo:lo + 8192]), own.take(take), *(c.take(take) for c in batch.columns)],
                                                 names=["cell", "cells", "vec", "u", "w"])

    kind = nodes.schema["vec"].dataType.simpleString()
    # cells that are too large are found by counting, not by the fit
    crowded = pin_table(nodes.select("vec").mapInArrow(name_cells, "cell long").groupBy("cell").count()
                        .filter(F.col("count") > block)
                        .select("cell", F.ceil(F.col("count") / block).alias("blocks")), "crowded")
    dealt = nodes.select("vec", "u", "w").mapInArrow(
        deal, f"cell long, cells array<long>, vec {kind}, u decimal(38,0), w long")
    blocks = F.coalesce("blocks", F.lit(1).cast("long"))
    # a block meets each block of its cell: (the smaller, the larger) is the place
    dealt = (dealt.join(checked_broadcast(crowded), "cell", "left")
             .withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "u"), blocks))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
             .select("cell", F.least("block", "other").alias("small"), F.greatest("block", "other").alias("large"),
                     F.size("vec").alias("dim"), "block", "u", "w", "vec", "cells"))
    key = ["cell", "small", "large", "dim"]
    dealt = dealt.repartition(common.shuffle_parts(nodes.sparkSession), *key).sortWithinPartitions(*key)

    def meet(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)
            if not len(keys):
                continue
            bounds = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            if held and [held[0].column(i)[0].as_py() for i in range(4)] != keys[0].tolist():
                yield from _cell(held, least)
                held = []
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                held.append(batch.slice(lo, hi - lo))
                if hi < len(keys):  # the last cell may go on in the next batch
                    yield from _cell(held, least)
                    held = []
        if held:
            yield from _cell(held, least)

    return dealt.mapInArrow(meet, "u decimal(38,0), n long, v decimal(38,0)")


def _cell(held: list[pa.RecordBatch], least: float):
    t = pa.Table.from_batches(held).combine_chunks()
    if t.num_rows < 2:
        return
    cell, small, large = (t.column(i)[0].as_py() for i in range(3))
    u = t.column("u").chunk(0)
    x, length = scaled([np.asarray(v.values, float) for v in t.column("vec").chunk(0)])
    cells = [np.asarray(v.values) for v in t.column("cells").chunk(0)]
    at, n, first = compared(x, length, cells, t.column("w").to_numpy(), t.column("block").to_numpy(), cell, small != large, least)
    if len(at):
        yield pa.RecordBatch.from_arrays([u.take(pa.array(at)), pa.array(n.astype(np.int64)), u.take(pa.array(first))],
                                         names=["u", "n", "v"])


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", least: float = 0.9,
                    block: int = BLOCK, **sizes) -> DataFrame:
    """(vec_id long, n_links long, component_id long, kept boolean): a row for each row of ``vectors``. ``sizes``:
    trees and leaf, where other than the module's."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"), usable(F.col(vec_col), id_col).alias("fine"))
    rows = rows.withColumn("u", F.when(F.col("fine"), name_of(F.col("vec"))))
    nodes = pin_table(rows.filter("fine").groupBy("u").agg(F.count("*").alias("w"), F.first("vec").alias("vec"),
                                                           F.min("vec_id").alias("least")), "nodes")
    found = pin_table(links(nodes, grown(nodes, least, **sizes), least, block), "links")
    counts = found.groupBy("u").agg(F.sum("n").alias("n"))
    roots = components(found.select("u", "v"), "u", "v").withColumnRenamed("node", "u")
    part = nodes.select("u", "w", "least").join(roots, "u", "left").withColumn("root", F.coalesce("root", "u"))
    ids = part.groupBy("root").agg(F.min("least").alias("component_id"))
    # written, so that the join with all rows has nothing before its exchanges and a vector of many rows can be split
    each = pin_table(part.join(ids, "root").join(counts, "u", "left")
                     .select("u", (F.col("w") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id"), "each")
    alone = rows.filter(~F.col("fine")).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                                F.col("vec_id").alias("component_id"))
    linked = rows.filter("fine").select("vec_id", "u").join(each, "u").select("vec_id", "n_links", "component_id")
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all ``embeddings`` at a cosine of 0.9 or more."""
    return near_duplicates(common.table(spark, sf_dir, "embeddings"))
