"""The trie of conversations against dictionaries of prefixes, its parentheses against a stack."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from riskloom.llm import parens, prefix_trie
from riskloom.llm.parens import Parens

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


# --- parentheses --------------------------------------------------------------------------------


def random_tree(rng, n, deep):
    """Balanced parentheses of n nodes under one root."""
    out, depth, left = [True], 1, n - 1
    while left or depth:
        if left and (depth == 1 or rng.random() < deep):
            out.append(True)
            depth, left = depth + 1, left - 1
        else:
            out.append(False)
            depth -= 1
        if not left and not depth:
            break
    return np.array(out)


@pytest.mark.parametrize("block", [2, 8, 128])
@pytest.mark.parametrize("deep", [0.3, 0.5, 0.95, 1.0])
def test_parentheses_against_a_stack(block, deep, monkeypatch):
    monkeypatch.setattr(parens, "BLOCK", block)
    rng = np.random.default_rng(int(deep * 100) + block)
    for n in (1, 2, 3, 17, 400, 3000):
        opens = random_tree(rng, n, deep)
        want, stack = {}, []
        for i, o in enumerate(opens.tolist()):
            if o:
                stack.append(i)
            else:
                want[stack.pop()] = i
        shape = Parens(opens)
        place = shape.nodes()
        close = shape.close(place)
        assert close.tolist() == [want[p] for p in place.tolist()]
        weight = rng.integers(0, 9, len(place))
        leaf = [opens[p] and not opens[p + 1] for p in place]
        totals, leaves = shape.totals(weight, place, close), shape.leaves(place, close)
        for k in rng.integers(0, len(place), 30).tolist():
            inside = (place >= place[k]) & (place <= close[k])
            assert totals[k] == weight[inside].sum() and leaves[k] == np.array(leaf)[inside].sum()


def test_unbalanced_parentheses():
    with pytest.raises(ValueError):
        Parens(np.array([True, True, False]))


# --- the trie -----------------------------------------------------------------------------------


def plain(rows, rebuild=True):
    """Node rows of (conv_id, turn, role, text) by dictionaries of prefixes."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            k = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs.setdefault(c, []).append(((turn is not None, turn or 0), k, (role, text)))
    convs = {c: [x[2] for x in sorted(v)] for c, v in convs.items()}
    if rebuild:
        new = {}
        for c, v in convs.items():
            h = zlib.crc32(str(c).encode()) % 9
            new[c] = convs.get(c - c % 5, [])[:h] + v[h:]
        convs = new
    members, ends = {}, {}
    for c, v in convs.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
        ends.setdefault(tuple(v), []).append(c)
    children = Counter(p[:-1] for p in members if p)
    saved, leaves = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
            leaves[p[:d]] += not children[p]
    return Counter(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
        for p, m in members.items()
    )


def rows(df):
    return Counter(tuple(r) for r in df.select(COLUMNS).collect())


SCHEMA = "conv_id long, turn long, role string, text string"


def random_rows(seed, convs, most, words=3, ids=1):
    rng = np.random.default_rng(seed)
    out = []
    for c in range(convs):
        for t in range(int(rng.integers(1, most))):
            out.append((int(c * ids), t, ["user", "assistant"][t % 2], f"t{int(rng.integers(0, words))}é"))
    return out


@pytest.mark.parametrize("seed, convs, most, words", [(0, 60, 12, 2), (1, 200, 6, 1), (2, 40, 30, 2)])
def test_rebuilt_conversations(spark, scratch, seed, convs, most, words):
    data = random_rows(seed, convs, most, words)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    assert rows(prefix_trie.branched_trie(df, scratch)) == plain(data)


def test_conversations_as_they_are_in_small_pieces(spark, scratch):
    """Every bound at its smallest: shards of a path or two, pieces of two ids."""
    data = random_rows(3, 120, 9, 2)
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    for shard in (1, 3, 20):
        assert rows(prefix_trie.trie(df, scratch, prefix_trie.Sizes(shard=shard, piece=2))) == plain(data, False)


def test_a_conversation_with_most_turns(spark, scratch):
    """One conversation and its copy over many blocks and ranges, branches and ends far down."""
    sizes = prefix_trie.Sizes(block=16)
    long = [(10, t, "user", f"x{t % 7}") for t in range(900)]
    data = [*long, *[(11, *r[1:]) for r in long[:700]], *[(12, *r[1:]) for r in long[:300]], (12, 300, "user", "other"), (13, 0, "user", "x0"), *[(14, *r[1:]) for r in long]]
    df = spark.createDataFrame(data, SCHEMA).repartition(7)
    assert rows(prefix_trie.trie(df, scratch, sizes)) == plain(data, False)
    assert rows(prefix_trie.branched_trie(df, scratch, sizes)) == plain(data)


def test_awkward_conversations(spark, scratch):
    data = [
        (None, 1, "user", "a"), (1, None, None, None), (1, 1, "user", None), (1, 1, "user", None), (1, 2, "", ""), (2, None, None, None), (2, 3, "user", "x" * 100_000), (3, 5, "user", "b"), (3, 5, "user", "a"),
        (3, 5, None, "b"), (4, None, "ab", "c"), (5, None, "a", "bc"), (-3, 0, "user", "a"), (7, 1, "user", "é\U0001f642"),
    ]
    df = spark.createDataFrame([(*r, "x", "y") for r in data], SCHEMA + ", pos string, key string").repartition(3)
    assert rows(prefix_trie.trie(df, scratch)) == plain(data, False)
    nothing = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.trie(nothing, scratch).count() == 0 and prefix_trie.branched_trie(nothing, scratch).count() == 0


def test_conversations_without_turns(spark, scratch):
    members = spark.createDataFrame([(4, 0), (9, 0)], "conv_id long, length long")
    turns = spark.createDataFrame([], "conv_id long, pos long, length long, key binary, bytes long")
    got = prefix_trie.nodes(turns, members, scratch).select(COLUMNS).collect()
    assert [tuple(r) for r in got] == [(4, 0, None, 2, 0, 1, 0, hashlib.sha256(b"4,9").hexdigest())]


def test_batches_of_three_rows(spark, scratch):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        data = random_rows(5, 50, 8, 1)
        assert rows(prefix_trie.branched_trie(spark.createDataFrame(data, SCHEMA).repartition(3), scratch)) == plain(data)
    finally:
        spark.conf.set(key, before)
