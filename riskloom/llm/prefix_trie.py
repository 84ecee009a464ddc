"""Trie of what conversations have in common from their first turn on, and what sharing it would save.

A node is a distinct sequence of first turns; it is known by its smallest member (the conversation that owns
it) and its depth. Members, children and owners are aggregations by a hash of the sequence. What a subtree
holds comes from balanced parentheses:

- A chain of nodes with one child each and no conversation's end is folded into the node at its foot, so the
  shape has about two nodes a conversation, however long conversations are.
- The folded path of every node's owner, in one common order, is cut into shards; a shard writes its paths as balanced
  parentheses (``parens.Parens``), finds each node's end by least excesses, and takes leaves and weights between
  the two from cumulative arrays.
- Nodes on the border path of two shards (the shared spine) are in both; their parts are added up. A node's own
  weight travels on its owner's path only, so it counts once.

A conversation of any share of the turns is split by ranges of its turns, its hashes are summed in blocks, and
its private end never meets in one task. A folded path is at most the square root of twice the number of turns
long, because each of its nodes needs another conversation that reaches as far.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import Scratch, U, attach, mix
from riskloom.llm.parens import Parens



class Sizes(NamedTuple):
    """What tasks hold at once; results do not depend on it."""

    block: int = 4096  #: turns of a conversation whose hashes are summed in one block
    shard: int = 1 << 18  #: nodes on the paths of a shard
    piece: int = 1 << 14  #: ids in one piece of a list of ends


NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_keys(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, key, bytes) of (conv_id, turn, role, text): 16 bytes that stand for role and text, and the
    text's UTF-8 bytes. A null role or text counts as empty; rows without a conv_id belong to no conversation."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    whole = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return conversations.filter("conv_id IS NOT NULL").select("conv_id", "turn", F.unhex(F.substring(whole, 1, 32)).alias("key"), F.octet_length(text).cast("long").alias("bytes"))


def _numbered(batches):
    """Number rows of a sorted partition within their conversation."""
    part = TaskContext.get().partitionId()
    last, n = None, 0
    for b in batches:
        if not b.num_rows:
            continue
        conv = b.column("conv_id").to_numpy()
        start = np.append(True, conv[1:] != conv[:-1])
        begin = np.maximum.accumulate(np.where(start, np.arange(len(conv)), 0))
        local = np.arange(len(conv)) - begin + 1
        if last == conv[0]:
            local[begin == 0] += n
        last, n = conv[-1], int(local[-1])
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), pa.array(np.full(len(conv), part, np.int32)), pa.array(local), b.column("key"), b.column("bytes")], names=["conv_id", "part", "local", "key", "bytes"])


def positions(turns: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos from 1, key, bytes) of every turn by (turn, null first, then key), and (conv_id, n).

    Turns are dealt by ranges of (conv_id, turn, key), so a conversation of any size is split. Only the first
    and the last conversation of a range can go on in another one; what they have before is at most two rows
    a range, which is broadcast.
    """
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("key"), F.col("salt")]  # the salt splits equal rows
    ranged = turns.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = scratch.keep(ranged.select("conv_id", "key", "bytes").mapInArrow(_numbered, "conv_id bigint, part int, local bigint, key binary, bytes bigint"))
    each = rows.groupBy("conv_id", "part").agg(F.max("local").alias("n"))
    lengths = scratch.keep(each.groupBy("conv_id").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts")))
    split = each.join(lengths.filter("parts > 1").select("conv_id"), "conv_id")
    before = split.withColumn("before", F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).filter("before IS NOT NULL")
    placed = rows.join(F.broadcast(before.select("conv_id", "part", "before")), ["conv_id", "part"], "left")
    return placed.select("conv_id", (F.col("local") + F.coalesce("before", F.lit(0))).alias("pos"), "key", "bytes"), lengths.select("conv_id", "n")


def branched(rows: DataFrame, lengths: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Conversations as the query's contract rebuilds them: the first h turns of conversation c - c % 5 and then
    those of c after its first h, with h = crc32(c) % 9. Gives (conv_id, pos, length, key, bytes) and (conv_id, length)."""
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    own = lengths.withColumn("h", head).withColumn("base", F.col("conv_id") - F.col("conv_id") % 5)
    base = lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    plan = own.join(base, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    plan = scratch.keep(plan.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    total = lengths.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    tails = attach(rows.filter(F.col("pos") > head), plan.select("conv_id", "h", "taken", "length", "n"), "conv_id", "n", total)
    tails = tails.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "length", "key", "bytes")
    heads = rows.filter("pos <= 8 AND conv_id % 5 = 0").select(F.col("conv_id").alias("base"), "pos", "key", "bytes")
    heads = plan.filter("taken > 0").select("conv_id", "base", "taken", "length").join(heads, "base").filter("pos <= taken")
    return heads.select("conv_id", "pos", "length", "key", "bytes").unionByName(tails), plan.select("conv_id", "length")


def _weights(key: pa.Array, pos: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit numbers of each turn at its place."""
    words = np.frombuffer(b"".join(key.to_pylist()), U).reshape(-1, 2)
    with np.errstate(over="ignore"):
        return [mix(words[:, i] + mix(pos.astype(U) * U(2) + U(i + 1))) for i in range(2)]


def _restart(conv: np.ndarray, block: np.ndarray) -> np.ndarray:
    return np.append(True, (conv[1:] != conv[:-1]) | (block[1:] != block[:-1]))


PREFIX = "conv_id bigint, pos bigint, length bigint, bytes bigint, k1 bigint, k2 bigint, q1 bigint, q2 bigint"


def _summed(size: int):
    """Running sums of the turns' numbers within (conv_id, block), of rows sorted so; sums wrap at 64 bits."""

    def run(batches):
        last, carry = None, [U(0), U(0)]
        for b in batches:
            if not b.num_rows:
                continue
            conv, pos = b.column("conv_id").to_numpy(), b.column("pos").to_numpy()
            block = (pos - 1) // size
            start = _restart(conv, block)
            begin = np.maximum.accumulate(np.where(start, np.arange(len(conv)), 0))
            out = []
            with np.errstate(over="ignore"):
                for i, w in enumerate(_weights(b.column("key"), pos)):
                    before = np.append(U(0), np.cumsum(w, dtype=U))[:-1]
                    before = before - before[begin]
                    if last == (conv[0], block[0]):
                        before[begin == 0] += carry[i]
                    out += [before + w, before]
                    carry[i] = out[-2][-1]
            last = (conv[-1], block[-1])
            k1, q1, k2, q2 = (pa.array(x.view(np.int64)) for x in out)
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("pos"), b.column("length"), b.column("bytes"), k1, k2, q1, q2], names=["conv_id", "pos", "length", "bytes", "k1", "k2", "q1", "q2"])

    return run


def _block_starts(size: int):
    """(conv_id, block, o1, o2): sums before each block, of whole blocks' sums sorted by conversation and block."""

    def run(batches):
        last, carry = None, (U(0), U(0))
        for b in batches:
            rows = []
            for conv, pos, k1, k2 in zip(*(b.column(c).to_pylist() for c in ("conv_id", "pos", "k1", "k2")), strict=True):
                if conv != last:
                    last, carry = conv, (0, 0)
                carry = ((carry[0] + k1) % (1 << 64), (carry[1] + k2) % (1 << 64))
                rows.append((conv, pos // size, *carry))
            if rows:
                conv, block, o1, o2 = zip(*rows, strict=True)
                sums = [pa.array(np.array(o, U).view(np.int64)) for o in (o1, o2)]
                yield pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(block, pa.int64()), *sums], names=["conv_id", "block", "o1", "o2"])

    return run


def _added(batches):
    for b in batches:
        with np.errstate(over="ignore"):
            sums = [pa.array((b.column(c).to_numpy().view(U) + b.column(o).to_numpy().view(U)).view(np.int64)) for c, o in (("k1", "o1"), ("k2", "o2"), ("q1", "o1"), ("q2", "o2"))]
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("pos"), b.column("length"), b.column("bytes"), *sums], names=["conv_id", "pos", "length", "bytes", "k1", "k2", "q1", "q2"])


def prefixes(turns: DataFrame, scratch: Scratch, size: int) -> DataFrame:
    """Turns with the hash (k1, k2) of all turns up to them and (q1, q2) of those before."""
    block = F.floor((F.col("pos") - 1) / size)
    dealt = turns.withColumn("block", block).repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "pos")
    local = scratch.keep(dealt.select("conv_id", "pos", "length", "key", "bytes").mapInArrow(_summed(size), PREFIX))
    whole = local.filter((F.col("length") > size) & (F.col("pos") % size == 0)).select("conv_id", "pos", "k1", "k2")
    starts = whole.repartition("conv_id").sortWithinPartitions("conv_id", "pos").mapInArrow(_block_starts(size), "conv_id bigint, block bigint, o1 bigint, o2 bigint")
    first = local.filter(F.col("pos") <= size)
    later = local.filter(F.col("pos") > size).withColumn("block", block).join(starts, ["conv_id", "block"])
    return scratch.keep(first.unionByName(later.drop("block").mapInArrow(_added, PREFIX)))


def _shard_rows(paths: list[tuple[list[int], list[int], list[int], bool]]) -> pa.RecordBatch:
    """Leaves and weights under every node of one shard's paths (depths, owners, weights, whether a leaf ends
    them), sorted by path. A path that does not end in a leaf is followed by a longer one; if that is in the
    next shard, its last node looks like a leaf here and is not counted."""
    opens, ids, weight, stack, had = [True], [(0, 0)], [0], [0], []
    for depth, owner, w, _ in paths:
        path = list(zip(depth, owner, strict=True))
        same = 0
        while same < min(len(had), len(path)) and had[same] == path[same]:
            weight[stack[same + 1]] += w[same]
            same += 1
        opens += [False] * (len(had) - same)
        del stack[same + 1 :]
        for node, x in zip(path[same:], w[same:], strict=True):
            opens.append(True)
            stack.append(len(ids))
            ids.append(node)
            weight.append(x)
        had = path
    opens += [False] * len(stack)
    shape = Parens(np.array(opens))
    place = shape.nodes()
    close = shape.close(place)
    depth, owner = (np.array(x, np.int64) for x in zip(*ids, strict=True))
    leaves = shape.leaves(place, close)
    if not paths[-1][3]:
        leaves[stack] -= 1
    cols = [depth, owner, leaves, shape.totals(np.array(weight, np.int64), place, close)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["depth", "rep", "n_leaves", "below"])


def _shards(size: int):
    def run(batches):
        held, n = [], 0
        for b in batches:
            for path in zip(*(b.column(c).to_pylist() for c in ("depths", "owners", "weights", "leaf")), strict=True):
                held.append(path)
                n += len(path[0]) + 1
                if n > size:
                    yield _shard_rows(held)
                    held, n = [], 0
        if held:
            yield _shard_rows(held)

    return run


def _pieces(size: int):
    """(rep, depth, first, ids) of sorted (rep, depth, conv_id): ids joined by commas, a bounded number in each."""

    def run(batches):
        for b in batches:
            rep, depth = b.column("rep").to_numpy(), b.column("depth").to_numpy()
            conv = b.column("conv_id").to_pylist()
            cut = np.flatnonzero(_restart(rep, depth)).tolist()
            rows = []
            for s, e in zip(cut, [*cut[1:], len(conv)], strict=True):
                for i in range(s, e, size):
                    part = conv[i : min(i + size, e)]
                    rows.append((int(rep[s]), int(depth[s]), part[0], ",".join(map(str, part))))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["rep", "depth", "first", "ids"])

    return run


def _digests(batches):
    """sha256 of each node's ids from its pieces in order; only the hash's state is held."""
    last, state, rows = None, None, []

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["rep", "depth", "ends"])

    for b in batches:
        for rep, depth, ids in zip(*(b.column(c).to_pylist() for c in ("rep", "depth", "ids")), strict=True):
            if (rep, depth) != last:
                if last is not None:
                    rows.append((*last, state.hexdigest()))
                last, state = (rep, depth), hashlib.sha256(ids.encode())
            else:
                state.update(b",")
                state.update(ids.encode())
        if len(rows) > 10_000:
            yield out(rows)
            rows = []
    if last is not None:
        rows.append((*last, state.hexdigest()))
    if rows:
        yield out(rows)


def _members(prefix: DataFrame, members: DataFrame) -> DataFrame:
    """(k1, k2, depth, rep, n_convs, n_ends, end, bytes, q1, q2) of every node: by sequences, and the root from all conversations."""
    end = F.col("pos") == F.col("length")
    found = prefix.groupBy("k1", "k2", F.col("pos").alias("depth")).agg(
        F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("n_convs"), F.sum(end.cast("long")).alias("n_ends"), F.min(F.when(end, F.col("conv_id"))).alias("end"), F.max("bytes").alias("bytes"), F.max("q1").alias("q1"), F.max("q2").alias("q2")
    )
    none = F.col("length") == 0
    zero = F.lit(0).cast("long")
    root = members.agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("n_convs"), F.coalesce(F.sum(none.cast("long")), zero).alias("n_ends"), F.min(F.when(none, F.col("conv_id"))).alias("end")).filter("n_convs > 0")
    return found.unionByName(root.select(zero.alias("k1"), zero.alias("k2"), zero.alias("depth"), "rep", "n_convs", "n_ends", "end", zero.alias("bytes"), zero.alias("q1"), zero.alias("q2")))


def _feet(nodes: DataFrame, size: int) -> DataFrame:
    """Nodes with ``foot``, the depth at which their chain ends, and ``run``, their owner's saved bytes down to them.
    Both are windows within blocks of depths, carried over blocks by windows of one row a block."""
    rows = nodes.withColumn("block", F.floor(F.col("depth") / size)).withColumn("own", (F.col("n_convs") - 1) * F.col("bytes")).withColumn("mark", F.when(F.col("fold"), None).otherwise(F.col("depth")))
    inside = Window.partitionBy("rep", "block")
    down, up = inside.orderBy("depth").rowsBetween(Window.unboundedPreceding, 0), inside.orderBy("depth").rowsBetween(0, Window.unboundedFollowing)
    rows = rows.withColumn("run", F.sum("own").over(down)).withColumn("foot", F.min("mark").over(up))
    blocks = rows.groupBy("rep", "block").agg(F.sum("own").alias("own"), F.min("mark").alias("mark"))
    by_block = Window.partitionBy("rep").orderBy("block")
    blocks = blocks.select(
        "rep", "block", F.coalesce(F.sum("own").over(by_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.min("mark").over(by_block.rowsBetween(1, Window.unboundedFollowing)).alias("next")
    )
    joined = rows.join(blocks, ["rep", "block"])
    return joined.withColumn("run", F.col("run") + F.col("before")).withColumn("foot", F.coalesce("foot", "next")).drop("block", "mark", "before", "next")


def nodes(turns: DataFrame, members: DataFrame, scratch: Scratch, sizes: Sizes = Sizes()) -> DataFrame:
    """Every node of the trie over (conv_id, pos, length, key, bytes), with members (conv_id, length) of all conversations.

    Per node: conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves,
    saved_tokens (over the subtree, (n_convs - 1) times the bytes of each node's last turn) and ends_sha256 (of the ids
    of the conversations that end here, ascending, joined by commas). No conversations give no rows; conversations
    without turns give the root only.
    """
    prefix = prefixes(turns, scratch, sizes.block)
    members = scratch.keep(members)
    found = scratch.keep(_members(prefix, members))
    key = ["k1", "k2", "depth"]
    children = found.filter("depth > 0").groupBy(F.col("q1").alias("k1"), F.col("q2").alias("k2"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = found.join(children, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    counted = counted.withColumn("fold", (F.col("depth") > 0) & (F.col("n_children") == 1) & (F.col("n_ends") == 0))
    counted = scratch.keep(_feet(counted, sizes.block))
    rows_total = found.agg(F.coalesce(F.sum("n_convs"), F.lit(0)).alias("n")).first().n

    # the shape: folded paths of the owners, in order
    chains = counted.groupBy("rep", F.col("foot").alias("depth")).agg(F.sum("own").alias("weight"), F.count(F.lit(1)).alias("chain"), F.max("run").alias("run"))
    shape = counted.filter("NOT fold").select(*key, "rep", "n_convs", (F.col("n_children") == 0).alias("leaf")).join(chains, ["rep", "depth"])
    shape = scratch.keep(shape)
    steps = attach(prefix.select("conv_id", F.col("pos").alias("depth"), "k1", "k2"), shape.filter("depth > 0").select(*key, "rep", "n_convs", "leaf", "weight"), key, "n_convs", rows_total)
    step = F.struct("depth", "rep", F.when(F.col("rep") == F.col("conv_id"), F.col("weight")).otherwise(F.lit(0)).alias("weight"), "leaf")
    owners = steps.groupBy("conv_id").agg(F.array_sort(F.collect_list(step)).alias("steps")).withColumn("last", F.element_at("steps", -1)).filter("last.rep = conv_id")
    paths = owners.select(F.expr("transform(steps, s -> struct(s.depth, s.rep))").alias("path"), F.col("steps.depth").alias("depths"), F.col("steps.rep").alias("owners"), F.col("steps.weight").alias("weights"), F.col("last.leaf").alias("leaf"))
    paths = paths.repartitionByRange("path").sortWithinPartitions("path").select("depths", "owners", "weights", "leaf")
    parts = scratch.keep(paths.mapInArrow(_shards(sizes.shard), "depth bigint, rep bigint, n_leaves bigint, below bigint"))
    # spine nodes are in several shards; the root is in all, as (0, 0)
    merged = parts.filter("depth > 0").groupBy("rep", "depth").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("below").alias("below"))
    whole = parts.filter("depth = 0").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("below").alias("below"))
    top = shape.filter("depth = 0").select("rep", "depth", "weight", "run", "chain").join(whole, F.lit(True), "left")
    names = ["rep", "depth", "weight", "run", "chain", "n_leaves", "below"]
    feet = shape.filter("depth > 0").select("rep", "depth", "weight", "run", "chain").join(merged, ["rep", "depth"]).select(names)
    feet = feet.unionByName(top.select("rep", "depth", "weight", "run", "chain", F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"), F.coalesce("below", F.lit(0)).alias("below")))
    feet = scratch.keep(feet.select("rep", F.col("depth").alias("foot"), F.col("run").alias("foot_run"), "chain", "n_leaves", (F.col("below") - F.col("weight")).alias("under")))
    n_nodes = found.count()
    under = attach(counted, feet, ["rep", "foot"], "chain", n_nodes)
    # saved below the foot, and on the chain from the node down to the foot
    under = under.withColumn("saved_tokens", F.col("under") + F.col("foot_run") - F.col("run") + F.col("own"))

    # parents: another owner's only where an owner's run of nodes begins
    first = counted.groupBy("rep").agg(F.min("depth").alias("depth")).filter("depth > 0")
    begins = counted.join(first, ["rep", "depth"]).select("rep", "depth", F.col("q1").alias("k1"), F.col("q2").alias("k2"), (F.col("depth") - 1).alias("above"))
    holders = scratch.keep(counted.filter("n_children > 0").select("k1", "k2", F.col("depth").alias("above"), F.col("rep").alias("parent"), "n_children"))
    parents = attach(begins, holders, ["k1", "k2", "above"], "n_children", n_nodes).select("rep", "depth", "parent")

    ends = _ends(prefix, members, counted, scratch, sizes.piece)
    out = under.join(parents, ["rep", "depth"], "left").join(ends, ["rep", "depth"], "left")
    one = F.when(F.col("n_ends") == 1, F.sha2(F.col("end").cast("string").cast("binary"), 256))
    return out.select(
        F.col("rep").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.coalesce("parent", "rep")).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", one, F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def _ends(prefix: DataFrame, members: DataFrame, counted: DataFrame, scratch: Scratch, size: int) -> DataFrame:
    """(rep, depth, ends) of the nodes at which several conversations end; ids are packed before they meet."""
    several = scratch.keep(counted.filter("n_ends > 1").select("k1", "k2", "depth", "rep", "n_ends"))
    zero = F.lit(0).cast("long")
    last = prefix.filter("pos = length").select("conv_id", "k1", "k2", F.col("pos").alias("depth"))
    last = last.unionByName(members.filter("length = 0").select("conv_id", zero.alias("k1"), zero.alias("k2"), zero.alias("depth")))
    total = counted.agg(F.coalesce(F.sum("n_ends"), F.lit(0)).alias("n")).first().n
    ending = attach(last, several, ["k1", "k2", "depth"], "n_ends", total).select("rep", "depth", "conv_id")
    packed = ending.repartitionByRange("rep", "depth", "conv_id").sortWithinPartitions("rep", "depth", "conv_id").mapInArrow(_pieces(size), "rep bigint, depth bigint, first bigint, ids string")
    return packed.repartition("rep", "depth").sortWithinPartitions("rep", "depth", "first").mapInArrow(_digests, "rep bigint, depth bigint, ends string")


def trie(conversations: DataFrame, scratch: Scratch, sizes: Sizes = Sizes()) -> DataFrame:
    """``nodes`` of conversations as they are."""
    rows, lengths = positions(turn_keys(conversations), scratch)
    turns = attach(rows, lengths, "conv_id", "n", lengths.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n).withColumnRenamed("n", "length")
    return nodes(turns, lengths.withColumnRenamed("n", "length"), scratch, sizes)


def branched_trie(conversations: DataFrame, scratch: Scratch, sizes: Sizes = Sizes()) -> DataFrame:
    """``nodes`` of conversations rebuilt with the first turns of another one (``branched``)."""
    rows, lengths = positions(turn_keys(conversations), scratch)
    turns, members = branched(scratch.keep(rows), lengths, scratch)
    return nodes(turns, members, scratch, sizes)
