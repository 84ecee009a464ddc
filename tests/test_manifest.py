"""Committed appends, compacted logs and keyed stream state."""

from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from riskloom.operators import bitemporal as bt
from riskloom.sources.manifest import CommittedTable, CompactedLog, Conflict, Manifest
from riskloom.streaming import incremental as inc

ROW = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.DoubleType())])


def test_versions_and_conflicts(spark, tmp_path):
    m = Manifest(spark, f"file://{tmp_path}/t")
    assert m.latest() == (0, [])
    m.commit(0, [{"a": 1}])
    m.commit(1, [{"a": 2, "é": "ü"}])
    assert m.latest() == (2, [{"a": 2, "é": "ü"}])
    with pytest.raises(Conflict):
        m.commit(1, [])
    assert m.latest()[0] == 2
    for i in range(2, 40):
        m.commit(i, [])
    assert m.versions() == list(range(21, 41))


def test_appends_happen_once(spark, tmp_path):
    t = CommittedTable(spark, f"file://{tmp_path}/t", ROW)
    assert t.read().count() == 0
    one = spark.createDataFrame([(1, 1.0), (2, None)], ROW)
    assert t.append(one, "first") and not t.append(one, "first") and t.append(one, "second")
    assert t.read().count() == 4
    one.write.parquet(f"file://{tmp_path}/t/data/left-by-a-killed-job")  # no manifest names it
    assert t.read().count() == 4


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    t = CommittedTable(spark, f"file://{tmp_path}/t", ROW)
    other = CommittedTable(spark, f"file://{tmp_path}/t", ROW)
    one = spark.createDataFrame([(1, 1.0)], ROW)
    commit, raced = t.manifest.commit, []

    def late(version, entries):
        if not raced:
            raced.append(1)
            other.append(one, "other")
        commit(version, entries)

    monkeypatch.setattr(t.manifest, "commit", late)
    assert t.append(one, "mine")
    assert {e["name"] for e in t.manifest.latest()[1]} == {"mine", "other"} and t.read().count() == 2


def test_revisions_of_a_job_that_runs_again_or_is_killed(spark, tmp_path, monkeypatch):
    schema = "id long, dt date, v double"
    day = date(2020, 5, 1)
    first = spark.createDataFrame([(1, day, 1.0), (2, day, 2.0), (3, date(2021, 5, 1), 3.0)], schema)
    second = spark.createDataFrame([(1, day, 1.0), (2, day, 2.5), (4, day, None)], schema)
    table = bt.revision_table(spark, f"file://{tmp_path}/r", [first.schema["id"], first.schema["dt"]], first.schema["v"])
    assert bt.write_revisions(first, table, ["id", "dt"], "v", "2022-01-01")
    with monkeypatch.context() as m:  # killed between rows and commit
        m.setattr(table.manifest, "commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            bt.write_revisions(second, table, ["id", "dt"], "v", "2022-01-02")
    assert table.read().count() == 3
    assert bt.write_revisions(second, table, ["id", "dt"], "v", "2022-01-02") and not bt.write_revisions(second, table, ["id", "dt"], "v", "2022-01-02")
    assert not bt.write_revisions(second, table, ["id", "dt"], "v", "2022-01-03", name="v-2022-01-02")
    assert table.read().count() == 6
    active = bt.active(table.read(), ["id", "dt"])
    assert sorted((r.id, r.v) for r in active.collect()) == [(1, 1.0), (2, 2.5), (4, None)]
    assert {r.year for r in table.read().collect()} == {2020, 2021}


def test_log_is_compacted_and_batches_count_once(spark, tmp_path):
    schema = T.StructType([*ROW.fields, T.StructField("n", T.LongType())])
    log = CompactedLog(spark, f"file://{tmp_path}/log", schema, lambda d: d.groupBy("k").agg(F.sum("v").alias("v"), F.sum("n").alias("n")), fanout=3)
    assert log.read().count() == 0
    for i in range(25):
        rows = spark.createDataFrame([(i % 4, float(i), 1), (9, 1.0, 1)], schema).coalesce(1)
        assert log.append(rows, i)
        if i % 5 == 0:
            assert not log.append(rows, i) and not log.append(rows, i // 2)
        assert len(log.folders()) <= 2 * 3  # two of each of three levels
    got = {r.k: (r.v, r.n) for r in log.read().collect()}
    assert got == {**{k: (float(sum(range(k, 25, 4))), len(range(k, 25, 4))) for k in range(4)}, 9: (25.0, 25)}
    kept = [p.name for p in (tmp_path / "log" / "data").iterdir()]
    assert len(kept) <= len(log.folders()) + 3  # and those of the version before


def test_streams_go_on_with_their_log(spark, tmp_path):
    base = f"file://{tmp_path}/state"
    for i in range(7):
        rows = [("a", f"2020-01-0{1 + i % 3} 10:00:00", float(i)), ("b", "2020-01-01 00:00:00", None)]
        spark.createDataFrame(rows, "k string, t string, v double").selectExpr("k", "CAST(t AS timestamp) AS t", "v").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        if i in (2, 6):
            out = inc.stream_windows(inc.read_stream(spark, str(tmp_path / "in"), 1), "k", "t", "v", "1 day", "1 day", base=base, fanout=2).toPandas()
    a = out[out.k == "a"].sort_values("start")
    assert a.n.tolist() == [3, 2, 2] and a["mean"].tolist() == [3.0, 2.5, 3.5] and a["std"].iloc[0] == pytest.approx(3.0)
    b = out[out.k == "b"]
    assert b.n.tolist() == [7] and b["mean"].isna().all()


class Value:
    """A state value that counts what is read."""

    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class Map:
    def __init__(self):
        self.values, self.read, self.written = {}, 0, 0

    def containsKey(self, key):
        return key in self.values

    def getValue(self, key):
        self.read += len(self.values[key][2])
        return self.values[key]

    def updateValue(self, key, value):
        self.written += len(value[2])
        self.values[key] = value


def test_state_that_is_read_does_not_grow_with_history(monkeypatch):
    p = inc.Cumulative("id", "s", "r")
    p.span, p.blocks = Value(), Map()
    cum, most = 1.0, 0
    for s in range(2000):
        p.blocks.read = 0
        out = next(p.handleInputRows((1,), iter([pd.DataFrame({"s": [s], "r": [0.001]})]), None))
        cum *= 1.001
        assert out.cum.tolist() == pytest.approx([cum]) and len(out) == 1
        most = max(most, p.blocks.read)
    assert most <= 2 * inc.BLOCK
    p.blocks.read = 0
    out = next(p.handleInputRows((1,), iter([pd.DataFrame({"s": [1990], "r": [None]})]), None))
    assert out.s.tolist() == list(range(1990, 2000)) and p.blocks.read <= 3 * inc.BLOCK
    out = next(p.handleInputRows((1,), iter([pd.DataFrame({"s": [-500, 5000, None], "r": [1.0, 0.5, 9.0]})]), None))
    assert len(out) == 2002 and out.cum.iloc[0] == 2.0 and out.cum.iloc[-1] == pytest.approx(2.0 * 1.001**1999 * 1.5)
