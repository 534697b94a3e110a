"""How often rows are moved, and by how many tasks they are written."""

import glob

import pytest

from closewright.checks.queries import QUERIES
from closewright.operators import bridge_rules as br
from closewright.plans import extracts as ex
from closewright.sources import sample_views as views
from closewright.sources.staging import shared_folder
from tests.conftest import rows


@pytest.fixture
def no_broadcast(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def moves_of(df, column):
    """Exchanges above the scan that reads the column."""
    lines = plan(df).splitlines()
    at = next(n for n, line in enumerate(lines) if ("Scan" in line) and column in line)
    found, depth = 0, lines[at].index(lines[at].lstrip(" :+-")[0])
    for line in reversed(lines[:at]):
        name = line.lstrip(" :+-")
        if name and line.index(name) < depth:
            depth = line.index(name)
            found += name.startswith("Exchange")
    return found


@pytest.fixture
def tables(spark, frame, tmp_path):
    """Two companies; repeated and null keys on every side."""
    day = "timestamp_ntz '1998-01-02'"
    frame([(1, "A"), (3, "B")], "n_nationkey int, n_name string").write.parquet(str(tmp_path / "nation.parquet"))
    frame([(1, "one", 1, "BUILDING"), (2, "two", 3, "MACHINERY"), (2, "twice", 3, "AUTO"), (None, "none", 1, "AUTO"), (5, "lost", None, "AUTO")], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string").write.parquet(str(tmp_path / "customer.parquet"))
    orders = frame([(10, 1), (20, 2), (20, 1), (None, 1), (30, None), (40, 9), (50, 5)], "o_orderkey long, o_custkey long")
    orders.selectExpr("*", "'O' as o_orderstatus", "1.5d as o_totalprice", f"{day} as o_orderdate", "'1-URGENT' as o_orderpriority").write.parquet(str(tmp_path / "orders.parquet"))
    lines = frame([(10, 1), (10, 1), (10, 2), (20, 1), (None, 1), (30, 1), (40, 1), (50, 1), (60, 1)], "l_orderkey long, l_linenumber int")
    lines.selectExpr("*", "7L as l_partkey", "8L as l_suppkey", "2d as l_quantity", "3.25d as l_extendedprice", "'R' as l_returnflag", f"{day} as l_shipdate").write.parquet(str(tmp_path / "lineitem.parquet"))
    return views.SampleTables(spark, str(tmp_path))


def test_lines_meet_their_customer_with_one_move(spark, tables, no_broadcast):
    text = views.VIEWS["line_base"]
    wanted = spark.sql(text, **{name: tables[name] for name in views._references(text)})
    assert tables["line_base"].columns == wanted.columns and rows(tables["line_base"]) == rows(wanted) and wanted.count() == 6
    assert moves_of(tables["line_base"], "l_orderkey") == 1 < moves_of(wanted, "l_orderkey")


def test_lines_of_many_views_are_moved_once(tables, no_broadcast):
    staged = tables.with_lines_staged()
    kept = staged["line_base"].columns
    assert {"l_orderkey", "company_code"} <= set(kept) <= set(tables["line_base"].columns)
    assert rows(staged["line_base"]) == rows(tables["line_base"].select(*kept))
    assert "Join" in plan(tables["cle"]) and "Join" not in plan(staged["cle"])
    assert rows(staged["cle_detail"]) == rows(tables["cle_detail"]) and staged["cle_detail"].count() > 0


def test_extracts_read_staged_lines():
    class Asked(Exception):
        pass

    class Tables:
        def with_lines_staged(self):
            raise Asked

    with pytest.raises(Asked):
        QUERIES["conformed_extracts"](Tables())


def test_open_entries_are_moved_by_entry_and_by_customer(frame, no_broadcast):
    at = "1998-09-30"
    entry = "select {} as entry_no, {} as customer_id, 'n' as customer_name, 'BL' as business_line_code, 'UE' as posting_group, 'X' as company_code, 'c' as country_code, cast(1 as decimal(18,2)) as amount_lcy, timestamp_ntz '1998-01-01' as posting_date, timestamp_ntz '1998-01-01' as due_date"
    spark = frame([(1,)], "a int").sparkSession
    # Entry 1 twice, 4 of a customer whose balance is zero, 5 closed, 6 of no customer, 7 of one without attributes.
    cle = spark.sql(" union all ".join(entry.format(n, c) for n, c in ((1, "'a'"), (1, "'a'"), (4, "'z'"), (5, "'a'"), (6, "cast(null as string)"), (7, "'q'"))))
    detail = frame([("X", "a", 1, 5), ("X", "z", 4, 2), ("X", "z", 8, -2), ("X", "a", 5, 1), ("X", "a", 5, -1), ("X", None, 6, 3), ("X", "q", 7, 3)], "company_code string, customer_id string, entry_no int, amount int")
    t = {
        "cle": cle, "cle_detail": detail.selectExpr("company_code", "customer_id", "entry_no", "cast(amount as decimal(18,2)) as amount", "timestamp_ntz '1998-01-01' as posting_date"),
        "company": frame([("X", "c", "o", 1)], "company_code string, country_code string, opco_central string, in_scope int"),
        "customers": frame([("X", "a", "A", "BL", 0, "g", "s"), ("X", "a", "B", "BL", 0, "g", "s"), ("X", None, "C", "BL", 0, "g", "s")], "company_code string, customer_no string, name string, busline_code string, auto_integrated int, posting_group string, stream string"),
        "buslines": frame([("X", "BL", "v")], "company_code string, busline_code string, vertical_1 string"),
    }
    found = ex.customer_open_items(t, at)
    assert rows(found, "entry_no", "customer_id", "name", "vertical_1") == [(1, "a", "A", "v"), (1, "a", "A", "v"), (1, "a", "B", "v"), (1, "a", "B", "v"), (7, "q", None, "v")]
    assert found.columns[:3] == ["company_code", "customer_id", "entry_no"]
    moves = [line for line in plan(found).splitlines() if "Exchange hashpartitioning" in line]
    assert sum("_customer" in line for line in moves) == 2 and not any("_semi" in line for line in moves)


def test_rows_stay_where_they_are_for_a_table_of_rules(spark):
    df = spark.range(100).selectExpr("id", "case id % 3 when 0 then 'Payment' when 1 then 'REFUND' end as transaction_type")
    got = br.classify_by_table(df, br.rule_table(spark), ["transaction_type"])
    assert "hashpartitioning(_claim" not in plan(got)
    assert rows(got) == rows(br.classify_bridges(df))


def test_bridges_of_sums(frame):
    held = {
        "company": frame([(1,)], "a int"),
        "cash_transactions": frame([("X", "Payment", 5), ("X", "Payment", None), ("X", None, 2)], "company_code string, transaction_type string, amount int"),
        "order_items": frame([("X", None, 1, 7), ("X", None, 1, 7), ("X", None, None, 1)], "company_code string, refund_date timestamp_ntz, is_prepayment int, unit_price int"),
    }
    got, wanted = QUERIES["rule_bridges_by_table"](held), QUERIES["rule_bridges"](held)
    assert rows(got) == rows(wanted) and got.columns == wanted.columns


def test_csv_lines_are_written_by_the_tasks_that_have_them(spark):
    lines = spark.range(90).selectExpr("id as entry_no", "concat('D', id) as document_no").repartition(9)
    folder = shared_folder(spark).removeprefix("file://")
    before = set(glob.glob(f"{folder}/short-rows-*/part-*"))
    found = QUERIES["csv_short_rows"]({"gl_entries": lines})
    assert found.count() == 90 and found.filter("bad").count() == 30
    assert len(set(glob.glob(f"{folder}/short-rows-*/part-*")) - before) == 9
