"""Round trips of delimited files with header lines."""

from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.sources import flatfiles as ff

TEXT = st.text(alphabet='ab|"\\#\n\r\t é;\u2028', max_size=12)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), min_size=2, max_size=6), st.sampled_from("|;,"))
def test_lines_give_back_their_values(values, sep):
    line = sep.join(ff.encode(v, sep) for v in values)
    assert ff.decode(line, sep) == values and "\n" not in line and "\r" not in line and not line.startswith("#")


def test_plain_lines_of_others():
    assert ff.decode("a|b c||x\\n|") == ["a", "b c", None, "x\\n", None]
    assert ff.decode('5" pipe|"open|x') == ['5" pipe', '"open', "x"]


def test_round_trip_in_spark(spark, tmp_path):
    rows = [
        (1, "a|b", 1.5, date(2020, 1, 2)), (2, "# not a comment", None, None), (3, "two\nlines\r\n", -0.25, date(1999, 12, 31)), (4, "", 1e300, None), (5, None, 0.0, None), (6, ' "q" \\ ', 2.0, None),
        (None, "#", None, None), (8, "é\U0001f642\u2028x", 0.1, None), (9, "null", None, None),
    ]
    df = spark.createDataFrame(rows * 30, "id bigint, s string, x double, d date").repartition(5)
    kinds = {"id": "INTEGER", "s": "STRING", "x": "NUMBER", "d": "DATE"}
    path = str(tmp_path / "f")
    ff.write_flat(df, path, kinds)
    back = ff.read_flat(spark, path)
    assert back.dtypes == df.dtypes and sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    files = [p for p in (tmp_path / "f").iterdir() if p.name.startswith("part")]
    assert len(files) == 5 and all(p.read_text().startswith("#Columns: id|s|x|d\n#Type: INTEGER|STRING|NUMBER|DATE\n") for p in files)


def test_files_split_inside(spark, tmp_path):
    """Splits of a few hundred bytes, with line ends inside values."""
    rows = [(i, f"line\n{i}\n|#{'x' * (i % 40)}") for i in range(500)]
    df = spark.createDataFrame(rows, "id bigint, s string").coalesce(1)
    path = str(tmp_path / "f")
    ff.write_flat(df, path, {"id": "INTEGER"})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        back = ff.read_flat(spark, path)
        assert back.rdd.getNumPartitions() > 10 and sorted(map(tuple, back.collect())) == rows
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_one_column_empty_tables_and_faults(spark, tmp_path):
    one = spark.createDataFrame([("a",), (None,), ("",)], "only string")
    ff.write_flat(one, str(tmp_path / "one"))
    assert sorted(str(r.only) for r in ff.read_flat(spark, str(tmp_path / "one")).collect()) == ["", "None", "a"]
    ff.write_flat(one.where("only = 'z'"), str(tmp_path / "none"))
    assert ff.read_flat(spark, str(tmp_path / "none")).collect() == []
    (tmp_path / "short").mkdir()
    (tmp_path / "short" / "a.txt").write_text("# made by hand\n#Columns: a|b|c\n#Type: INTEGER|NUMBER|STRING\n1|2.5\n\nx|y|z|\n")
    assert sorted(map(str, map(tuple, ff.read_flat(spark, str(tmp_path / "short")).collect()))) == ["(1, 2.5, None)", "(None, None, 'z')"]
    (tmp_path / "short" / "b.txt").write_text("#Columns: a|b|c\n#Type: INTEGER|NUMBER|STRING\n1|2|3|4\n")
    with pytest.raises(Exception, match="4 values for 3 columns"):
        ff.read_flat(spark, str(tmp_path / "short")).collect()
    (tmp_path / "bare").mkdir()
    (tmp_path / "bare" / "a.txt").write_text("1|2\n")
    with pytest.raises(ValueError):
        ff.read_flat(spark, str(tmp_path / "bare"))
