"""Partitioned and bucketed layouts: what is read and shuffled, and equal rows."""

import uuid

import pytest
from pyspark.sql import functions as F

from closewright.operators import joins
from closewright.sources import layout as lay
from tests.conftest import rows


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def ledger(spark, frame, tmp_path):
    held = [(f"C{k % 5}", None if k % 40 == 39 else f"1998-{1 + k % 12:02d}-15", k) for k in range(600)]
    df = frame(held, "company_code string, d string, amount int").withColumn("posting_date", F.col("d").cast("timestamp_ntz")).drop("d")
    path = str(tmp_path / "ledger")
    lay.write_by_period(df, path)
    return df, path


def test_periods_and_companies_prune_folders(spark, ledger):
    df, path = ledger
    got = lay.read_by_period(spark, path, ["C1", "C3"], 199803, 199805)
    assert rows(got) == rows(df.filter("company_code in ('C1', 'C3') and posting_date >= '1998-03-01' and posting_date < '1998-06-01'"))
    scan = plan_of(got).split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "period_partition" in scan
    assert got.select(F.input_file_name()).distinct().count() == 6
    assert rows(lay.read_by_period(spark, path)) == rows(df)


def test_companies_of_a_table_prune_when_the_query_runs(spark, frame, ledger, tmp_path):
    df, path = ledger
    frame([(f"C{k}", "north" if k < 2 else "south") for k in range(5)], "code string, region string").write.parquet(str(tmp_path / "companies"))
    wanted = spark.read.parquet(str(tmp_path / "companies")).filter("region = 'north'").select("code")
    got = lay.read_by_period(spark, path, wanted)
    assert "dynamicpruning" in plan_of(got).lower()
    assert rows(got) == rows(df.filter("company_code in ('C0', 'C1')"))


def names(n):
    return [f"layout_{uuid.uuid4().hex}" for _ in range(n)]


@pytest.fixture
def bucketed(spark, frame, tmp_path):
    """Issued vouchers, usage with one hot voucher, and cancelled keys, as bucketed tables and as they are."""
    issued = frame([(None if k % 30 == 0 else f" v{k}.0 " if k % 2 else f"v{k}", k) for k in range(300)], "id string, n int")
    used = frame([(f"V{k % 90}" if k % 3 else "V7", "1.50") for k in range(500)] + [(None, "9")], "voucher_id string, amount_used string")
    cancelled = frame([(f"V{k}",) for k in range(0, 300, 7)] + [(None,)], "k string")
    made = names(3)
    tables = (
        lay.bucketed_vouchers(issued, made[0], 6, str(tmp_path / made[0])), lay.bucketed_usage(used, made[1], 6, str(tmp_path / made[1])), lay.bucketed_keys(cancelled, made[2], 6, str(tmp_path / made[2])),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield issued, used, cancelled, *tables
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for name in made:
        spark.sql(f"drop table {name}")


def test_joins_of_bucketed_tables_shuffle_nothing(spark, bucketed):
    issued, used, cancelled, vouchers, usage, keys = bucketed
    timing = lay.used_against_issued(vouchers, usage)
    unmatched = lay.without_keys(vouchers, keys)
    for df in (timing, unmatched):
        plan = plan_of(df)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    from closewright.functions.text import voucher_key

    key = issued.withColumn("key", voucher_key("id"))
    sums = used.withColumn("u", voucher_key("voucher_id")).filter("u is not null").groupBy("u").agg(F.sum(F.col("amount_used").cast("decimal(18,2)")).alias("s"))
    plain = key.join(sums, F.col("key") == F.col("u"), "left").select("id", "n", F.coalesce("s", F.lit(0).cast("decimal(18,2)")).alias("s"))
    assert rows(timing, "id", "n", "ops_amount_used") == rows(plain)
    assert rows(unmatched, "id", "n") == rows(key.join(cancelled, F.col("key") == F.col("k"), "left_anti").select("id", "n"))


def test_lookup_types_of_line_keys(spark, frame, tmp_path):
    issued = frame([("a", "t1", "x"), ("b", "t2", None), ("b", "t2", "w")], "id string, transaction_no string, business_use string")
    used = frame([("b", "t9", "y"), ("c", "t1", "z")], "id string, transaction_no string, business_use string")
    lines = frame([("a",), ("b ",), ("b",), ("c",), ("d",), (None,), (" ",)] + [("a",)] * 20, "voucher_no string")
    made = names(2)
    types = lay.bucketed_types(issued, used, "id", (1, 2), made[0], 4, str(tmp_path / made[0]))
    keys = lay.line_keys(lines, "voucher_no", made[1], 4, str(tmp_path / made[1]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = lay.types_of_keys(keys, types)
        assert "Exchange" not in plan_of(found)
        assert rows(found) == [("a", 1, "x"), ("b", 1, "w"), ("c", 2, "z"), ("d", None, None)]
        plain = joins.left_lookup(lines.withColumn("k", F.trim("voucher_no")), found.withColumnRenamed("voucher_key", "lookup_key"), F.col("k"), ["voucher_no"])
        assert plain.filter("lookup_rank = 1").count() == 23
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in made:
            spark.sql(f"drop table {name}")
