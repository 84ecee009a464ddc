"""Links between sets that meet in blocks, by count-vector bounds, exact checks and components.

A block is a list of nodes that may link. Each list has a centre under each of a few orders of the nodes; a
node is first paired with one centre an order, the first of all its lists' centres, so mostly one node for
a whole group. Pairs that the bound lets through are checked, those of later orders only between nodes
that are not connected yet. In a last round the lists that are not connected yet are dealt to tasks, a node
once for all lists of a task. Parities of the counts, a bit each, tell which nodes have a partner there that
may link; only those nodes' texts move, and an R-tree over their points gives the pairs, which are compared
in the task. Tasks give out links between components, never the pairs of a list. No link that would join two
components is lost, and a large group of copies costs a few pairs a node.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Scratch, mix, shingle_sets, slices
from riskloom.llm.components import components
from riskloom.llm.count_tree import FEWEST, CountTree, Points, folded, parities, parity_pairs, point
from riskloom.llm.minmax import groups

U = np.uint64
#: Orders of the nodes that give centres, and rows held before only each node's first centre is kept.
CENTRES, KEPT = 3, 1 << 20
#: Rows of lists with one smallest node that a task of the last round takes together; more are dealt by list.
#: Longer lists than ``TILE`` are dealt by pairs of slabs of about so many nodes.
TOGETHER, TILE = 4096, 1024
#: Counts in the matrix of one tree, as a power of two.
MATRIX_BITS = 20
PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _whole_lists(batches, names: list[str]) -> Iterator[pa.Table]:
    """Tables of whole lists from batches sorted by list."""
    held: list[pa.Table] = []
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.table(b.columns, names=names)
        key = t.column("list").to_numpy()
        cut = int(np.searchsorted(key == key[-1], True))  # a list's rows lie side by side
        if cut:  # everything before the last list is whole
            yield pa.concat_tables([*held, t.slice(0, cut)])
            held = []
        held.append(t.slice(cut))
        if not cut and held[0].column("list")[0].as_py() != key[0]:
            yield pa.concat_tables(held[:-1])
            held = held[-1:]
    if held:
        yield pa.concat_tables(held)


def _edges(key: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])


CENTRE = pa.schema([("node", pa.int64()), ("turn", pa.int32()), ("rank", pa.int64()), ("centre", pa.int64())])


def _firsts(node: np.ndarray, rank: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((rank, node))
    keep = order[np.append(True, node[order][1:] != node[order][:-1])] if len(order) else order
    return node[keep], rank[keep], centre[keep]


def _centres(batches):
    """(node, turn, rank, centre): of the centres of a node's lists in this task, the first in each order. A list's
    centre is its first node; its other nodes are paired with it, it with none."""
    held = [[] for _ in range(CENTRES)]
    rows = 0
    for t in _whole_lists(batches, ["list", "node"]):
        key, node = t.column("list").to_numpy(), t.column("node").to_numpy()
        edge = _edges(key)
        of = np.repeat(np.arange(len(edge) - 1), np.diff(edge))
        for turn in range(CENTRES):
            with np.errstate(over="ignore"):
                rank = (mix(node.view(U) + U(turn)) >> U(1)).view(np.int64)
            least = np.minimum.reduceat(rank, edge[:-1])
            at = np.flatnonzero(rank == least[of])
            centre = np.empty(len(edge) - 1, np.int64)
            centre[of[at]] = node[at]
            other = node != centre[of]
            held[turn].append((node[other], least[of][other], centre[of][other]))
        rows += len(node)
        if rows > KEPT:
            held = [[_firsts(*(np.concatenate(c) for c in zip(*h, strict=True)))] for h in held]
            rows = len(held[0][0][0])
    for turn, h in enumerate(held):
        if h:
            node, rank, centre = _firsts(*(np.concatenate(c) for c in zip(*h, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(np.full(len(node), turn, np.int32)), pa.array(rank), pa.array(centre)], schema=CENTRE)


def _folded(batches):
    for b in slices(batches, 1024):
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(folded(b.column(1).to_pylist()), pa.binary())], names=["node", "point"])


def _bounded(batches):
    """(a, b) of rows (a, b, point_a, point_b) that the bound lets through."""
    for b in slices(batches, 4096):
        n = b.num_rows
        at = Points(b.column(2).to_pylist() + b.column(3).to_pylist())
        ok = at.may_link(np.arange(n), np.arange(n, 2 * n))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], schema=PAIR).filter(pa.array(ok))


def _parities(batches):
    """(node, size, parity) of rows (node, point)."""
    for b in slices(batches, 1024):
        size, bits = parities(b.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size), pa.array(bits, pa.binary())], names=["node", "size", "parity"])


#: A tile of the last round: the nodes of some lists with one home, or of two slabs of one list (side 0 and 1).
TILE_DDL = "home bigint, part int, i int, j int, side int, node bigint, root bigint"
TILE_KEYS = ["home", "part", "i", "j"]


def _across(t: pa.Table) -> np.ndarray:
    """The side of each row where only pairs of two sides are of interest; on the diagonal none."""
    return t.column("side").to_numpy() if t.column("i")[0].as_py() != t.column("j")[0].as_py() else np.zeros(0, np.int32)


def _candidates(batches):
    """Of tiles with (size, parity), the rows that have a partner of another root that may link."""
    names = [x.split()[0] for x in TILE_DDL.split(", ")]
    for t in groups(batches, len(TILE_KEYS)):
        root, side = t.column("root").to_numpy(), _across(t)
        keep = np.zeros(t.num_rows, bool)
        for x, y in parity_pairs(t.column("size").to_numpy(), t.column("parity").to_pylist()):
            ok = root[x] != root[y]
            if len(side):
                ok &= side[x] != side[y]
            keep[x[ok]] = True
            keep[y[ok]] = True
        if keep.any():
            yield from t.select(names).filter(pa.array(keep)).to_batches()


def _joined(batches):
    """Links (a, b) of tiles with texts, at most one less than the components that a tile joins."""
    for t in groups(batches, len(TILE_KEYS)):
        node, side = t.column("node").to_numpy(), _across(t)
        _, label = np.unique(t.column("root").to_numpy(), return_inverse=True)
        sets = list(shingle_sets(t.column("text")))
        at = Points([point(x) for x in sets])
        bits = max(FEWEST, min(int(at.bits.min()), MATRIX_BITS - len(sets).bit_length()))
        a, b = [], []
        for i, j in CountTree(at.rows(np.arange(len(sets)), bits), label.copy()).pairs():
            ok = label[i] != label[j]
            if len(side):
                ok &= side[i] != side[j]
            i, j = i[ok], j[ok]
            ok = at.may_link(i, j)
            for x, y in zip(i[ok].tolist(), j[ok].tolist(), strict=True):
                if label[x] != label[y] and _linked(sets[x], sets[y]):
                    label[label == label[y]] = label[x]
                    a.append(node[x])
                    b.append(node[y])
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=PAIR)


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    return 7 * len(np.intersect1d(x, y, assume_unique=True)) >= 3 * (len(x) + len(y))


def _checked(batches):
    """(a, b) of rows (a, b, text_a, text_b) whose shingle sets link."""
    for batch in batches:
        for k in range(0, batch.num_rows, 512):
            part = batch.slice(k, 512)
            ok = [_linked(x, y) for x, y in zip(shingle_sets(part.column(2)), shingle_sets(part.column(3)), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], schema=PAIR).filter(pa.array(ok, pa.bool_()))


def check(pairs: DataFrame, texts: Callable[[DataFrame], DataFrame], scratch: Scratch) -> DataFrame:
    """The pairs (a, b) whose texts link; ``texts`` gives (node, text) of nodes."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    text = scratch.keep(texts(nodes))
    left = text.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = text.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return scratch.keep(both.mapInArrow(_checked, "a bigint, b bigint"))


def _merged(roots: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) after more links: only components that a link joins are looked at again."""
    top = lambda side: F.coalesce(F.col(f"root_{side}"), F.col(side)).alias(side)
    for side in ("a", "b"):
        links = links.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}")), side, "left")
    over = components(links.select(top("a"), top("b")), scratch)
    known = roots.join(over.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return scratch.keep(known.union(over.join(roots, "node", "left_anti").select("node", "root")))


MET_DDL = "list bigint, node bigint, turn int, rank bigint, centre bigint"
MET = [x.split()[0] for x in MET_DDL.split(", ")]


def met_in_lists(buckets: DataFrame, lists_of: Callable[[pa.Table], pa.Table], scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Distinct (list, node) and (node, turn, centre) of the lists that ``lists_of`` makes of each bucket.

    Centres are found where a list is made, so a node has a row a bucket and turn, however many lists and tasks it
    is in; a list that several buckets make has the same centres in each.
    """

    def run(t: pa.Table) -> pa.Table:
        lists = lists_of(t)
        none = lambda kind: pa.nulls(lists.num_rows, kind)
        out = [pa.table([lists.column("list"), lists.column("node"), none(pa.int32()), none(pa.int64()), none(pa.int64())], names=MET)]
        for b in _centres(lists.to_batches(max_chunksize=KEPT // 4)):
            out.append(pa.table([pa.nulls(b.num_rows, pa.int64()), *b.columns], names=MET))
        return pa.concat_tables(out)

    both = scratch.keep(buckets.groupBy("bucket").applyInArrow(run, MET_DDL))
    lists = scratch.keep(both.filter("turn IS NULL").select("list", "node").distinct())
    met = both.filter("turn IS NOT NULL").groupBy("node", "turn").agg(F.min_by("centre", "rank").alias("centre"))
    return lists, scratch.keep(met)


def connect(lists: DataFrame, met: DataFrame, at: DataFrame, texts: Callable[[DataFrame], DataFrame], scratch: Scratch) -> DataFrame:
    """(node, root) of every node with a link. ``lists`` and ``met`` are those of ``met_in_lists``; ``at`` has (node, point)."""
    # the first look is at points of a quarter of the groups: a quarter of the bytes move
    coarse = scratch.keep(at.select("node", "point").mapInArrow(_folded, "node bigint, point binary"))
    left = coarse.select(F.col("node").alias("a"), F.col("point").alias("point_a"))
    right = coarse.select(F.col("node").alias("b"), F.col("point").alias("point_b"))
    pair = [F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")]

    def checked(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        near = pairs.join(left, "a").join(right, "b").select("a", "b", "point_a", "point_b")
        near = scratch.keep(near.mapInArrow(_bounded, "a bigint, b bigint"))
        return near, check(near, texts, scratch)

    pairs, links = checked(met.filter("turn = 0").select(*pair).distinct())
    roots = components(links, scratch)
    apart = met.filter("turn > 0").select(*pair).distinct()
    for side in ("a", "b"):
        apart = apart.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}")), side, "left")
    apart = apart.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b").join(pairs, ["a", "b"], "left_anti")
    again, more = checked(scratch.keep(apart))
    if not more.isEmpty():
        roots = _merged(roots, more, scratch)
    # lists whose nodes are not all connected yet
    rooted = scratch.keep(lists.join(roots, "node", "left").select("list", "node", F.coalesce("root", "node").alias("root")))
    mixed = rooted.groupBy("list").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min("node").alias("home"), F.count(F.lit(1)).alias("n")).filter("low <> high").select("list", "home", "n")
    mixed = scratch.keep(mixed)
    # lists with much the same nodes share the smallest one; many of them are dealt to several tasks
    short = mixed.filter(F.col("n") <= TILE)
    share = short.groupBy("home").agg(F.ceil(F.sum("n") / TOGETHER).alias("tasks"))
    dealt = short.join(share, "home").select("list", "home", F.pmod(F.xxhash64("list"), F.col("tasks")).cast("int").alias("part"), F.lit(1).alias("slabs"))
    dealt = dealt.union(mixed.filter(F.col("n") > TILE).select("list", F.col("list").alias("home"), F.lit(-1).alias("part"), F.ceil(F.col("n") / TILE).cast("int").alias("slabs")))
    # a node meets every slab of its list: once as the lower and once as the upper side of a tile
    rows = rooted.join(dealt, "list").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("slabs")).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("slabs") - 1)))
    rows = rows.select("home", "part", F.least("mine", "o").alias("i"), F.greatest("mine", "o").alias("j"), (F.col("mine") > F.col("o")).cast("int").alias("side"), "node", "root").distinct()
    tiles = rows.join(at.select("node", "point").mapInArrow(_parities, "node bigint, size bigint, parity binary"), "node").select(*TILE_KEYS, "side", "node", "root", "size", "parity")
    wanted = scratch.keep(tiles.repartition(*TILE_KEYS).sortWithinPartitions(*TILE_KEYS, "node").mapInArrow(_candidates, TILE_DDL))
    if wanted.isEmpty():
        return roots
    full = wanted.join(texts(wanted.select("node").distinct()), "node").select(*TILE_KEYS, "side", "node", "root", "text")
    last = scratch.keep(full.repartition(*TILE_KEYS).sortWithinPartitions(*TILE_KEYS, "node").mapInArrow(_joined, "a bigint, b bigint"))
    return roots if last.isEmpty() else _merged(roots, last, scratch)
