import io as text_io
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from closewright.sources import csv_records as c, io
from tests.conftest import rows


@pytest.fixture
def small_ranges(spark):
    """Files are read in ranges of a about 150 bytes."""
    held = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in held.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


FIELDS = ["", "1", "plain", '"a"', '"two\nlines"', '"three\r\n\n lines"', '"say ""hi"""', '""', '"a,b"', '5" pipe', '"x, ""\n"" y"', " padded ", '"' + "long\n" * 40 + '"', "ü€", '"\n"']


def random_file(seed, n=100):
    r = random.Random(seed)
    lines = ["k,a,b"]
    for k in range(n):
        lines.append(",".join([f"r{k}", *(r.choice(FIELDS) for _ in range(r.choice([2, 2, 2, 2, 1, 0])))]))
        if r.random() < 0.05:
            lines.append(r.choice(["", "  "]))
    return r.choice(["\n", "\r\n"]).join(lines) + r.choice(["", "\n"])


def as_pandas(text):
    df = pd.read_csv(text_io.StringIO(text, newline=""), dtype=str, keep_default_na=False, na_values=[], lineterminator=None)
    return sorted(tuple("" if v is None or v != v else v for v in r) for r in df.itertuples(index=False, name=None))


@pytest.mark.parametrize("seed", range(6))
def test_ranges_against_pandas(spark, tmp_path, small_ranges, seed):
    text = random_file(seed)
    (tmp_path / "x.csv").write_bytes(text.encode())
    path = str(tmp_path / "x.csv")
    assert c.lines_of(spark, path).rdd.getNumPartitions() > 5
    df = io.read_csv(spark, path, io.header_of(spark, path))
    assert io.bad_rows(df).count() == 0
    assert sorted(tuple(v or "" for v in r) for r in io.good_rows(df).collect()) == as_pandas(text)


def test_state_of_ranges(spark, tmp_path, small_ranges):
    """A field over many ranges, some of them without a quote, and a file that follows it."""
    (tmp_path / "a.csv").write_text('k,a\n1,"' + "inside the field\n" * 30 + '"\n2,"x ""y"" "\n3,z\n')
    (tmp_path / "b.csv").write_text("k,a\n4,w\n")
    df = io.read_csv(spark, str(tmp_path), ["k", "a"])
    assert rows(df, "k", "a") == [("1", "inside the field\n" * 30), ("2", 'x "y" '), ("3", "z"), ("4", "w")]


def test_round_trip(spark, frame, tmp_path, small_ranges):
    held = [(k, t) for k, t in enumerate(["two\nlines", "", None, 'say "hi"', '"', "a\r\nb", "\r", " padded ", "a,b", "back\\slash", '\\"', "ends in break\n", "ü€", "\n\n", "null", "#"])]
    df = frame(held, "k int, s string").repartition(3)
    io.write_csv(df, str(tmp_path / "out"))
    back = io.read_csv(spark, str(tmp_path / "out"), ["k", "s"])
    assert sorted((int(r.k), r.s) for r in io.good_rows(back).collect()) == held and io.bad_rows(back).count() == 0


def test_one_column_keeps_its_rows(spark, frame, tmp_path):
    io.write_csv(frame([("x",), (None,), ("",)], "s string"), str(tmp_path / "one"))
    assert rows(io.read_csv(spark, str(tmp_path / "one"), ["s"]), "s") == [("",), ("",), ("x",)]


def test_short_long_and_unclosed_rows(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b,c\n1\n1,2\n1,2,3\n1,2,3,4\n1,2,3,\n1,2,3,,\n"",,""\n\n9,"open\nto the end,1,2\n')
    df = io.read_csv(spark, str(tmp_path / "x.csv"), ["a", "b", "c"])
    assert rows(io.good_rows(df)) == [("", None, ""), ("1", None, None), ("1", "2", None), ("1", "2", "3")]
    assert sorted(r[io.CORRUPT] for r in io.bad_rows(df).collect()) == ["1,2,3,", "1,2,3,,", "1,2,3,4", '9,"open\nto the end,1,2']


def test_header_over_lines_empty_file_and_other_separator(spark, tmp_path):
    (tmp_path / "h.csv").write_text('"a\nb";c\n1;"x;y"\n')
    assert rows(io.read_csv(spark, str(tmp_path / "h.csv"), ["a", "c"], sep=";"), "a", "c") == [("1", "x;y")]
    (tmp_path / "e.csv").write_text("")
    assert io.read_csv(spark, str(tmp_path / "e.csv"), ["a"]).count() == 0
    (tmp_path / "o.csv").write_text("a,b\n")
    assert io.read_csv(spark, str(tmp_path / "o.csv"), ["a", "b"]).count() == 0


def test_text_is_not_shuffled(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\n")
    lines = c.lines_of(spark, str(tmp_path / "x.csv"))
    for df in (c.range_maps(lines, ","), c.assembled(lines, ",", {})):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_conformed_rows_keep_breaks(spark, tmp_path):
    (tmp_path / "u.csv").write_text('Voucher Id,Amount Used,note\nV1,"1,000","a\nb"\nV2,5\n')
    out = io.read_conformed_csv(spark, str(tmp_path / "u.csv"), "OPS_USAGE")
    assert rows(out, "voucher_id", F.col("note")) == [("V1", "a\nb"), ("V2", None)]
