from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructField, StructType

from closewright.operators import conform as cf, joins, naming
from closewright.sources import contracts as C, io, staging
from closewright.sources.contract_tables import CONTRACTS
from tests.conftest import rows


def test_every_contract_is_consistent():
    assert len(CONTRACTS) == 13
    for contract in CONTRACTS.values():
        names = [f.name for f in contract.fields]
        assert len(names) == len(set(names)) and set(contract.primary_keys) <= set(names)
        assert {f.name for f in contract.fields if f.required} & set(names)
        # Every declared heading, alone, is bound to its field.
        for f in contract.fields:
            assert all(cf.resolve_names([alias], contract) == {f.name: alias} for alias in f.aliases)
            assert cf.resolve_names([f"not {f.name}"], contract) == {}


@pytest.mark.parametrize("dataset,column,tag,kind,required", [
    ("CR_03", "entry_no", "id", "bigint", True), ("CR_03", "flg_in_conso_scope", "code", "bigint", False), ("CR_03", "bal_account_no", "code", "string", False),
    ("CR_03", "amount", "amount", "decimal(18,2)", True), ("CR_03", "posting_date", "date", "timestamp_ntz", True), ("CR_05", "fx_rate", "rate", "double", False),
    ("IPE_07", "entry_no", "id", "bigint", True), ("IPE_11", "sc_vendor_name", "name", "string", False), ("OPS_USAGE", "amount_used", "amount", "decimal(18,2)", True),
])
def test_declared_tags(dataset, column, tag, kind, required):
    f = next(f for f in CONTRACTS[dataset].fields if f.name == column)
    assert (f.tag, f.spark_type, f.required) == (tag, kind, required)


@pytest.mark.parametrize("dataset,heading,column", [
    ("IPE_11", "Transaction No", "sc_transaction_no"), ("IPE_11", "Vendor Name", "sc_vendor_name"), ("IPE_11", "ASG L1", "asg_level_1"), ("IPE_10", "Order Number", "order_nr"),
    ("IPE_12", "Order Number", "order_nr"), ("IPE_34", "Order Number", "order_nr"), ("CR_03", "Vendor Tag", "vendortag_code"), ("CR_05", "Month Code", "cod_month"), ("IPE_31", "Type", "transaction_type"),
])
def test_declared_headings(dataset, heading, column):
    assert cf.resolve_names([heading], CONTRACTS[dataset]) == {column: heading}


def test_first_declared_heading_wins():
    assert cf.resolve_names(["Entry Number", "Entry No_"], CONTRACTS["CR_03"]) == {"entry_no": "Entry No_"}


def test_alias_collision_is_refused():
    with pytest.raises(ValueError):
        C.Contract("X", 1, (C.Field("a", aliases=("Same",)), C.Field("b", aliases=("Same",))))
    with pytest.raises(ValueError):
        C.Contract("X", 1, (C.Field("a", aliases=("b",)), C.Field("b")))


def test_conform(frame):
    raw = frame([(" EC_NG ", "12", "2025-09-30 10:00:00", "$1,234.50", "nan", "x"), ("", "x", "bad", "n/a", "V1", "y")], "ID_COMPANY string, `Entry No_` string, `Posting Date` string, Amount string, `Voucher No_` string, extra string")
    contract = CONTRACTS["CR_03"]
    out = cf.conform(raw, contract)
    assert out.columns == ["id_company", "entry_no", "voucher_no", "posting_date", "amount", "extra"]
    assert rows(out) == [(None, None, "V1", None, None, "y"), ("EC_NG", 12, None, datetime(2025, 9, 30), Decimal("1234.50"), "x")]
    assert cf.unknown_columns(raw, contract) == ["extra"]
    assert "extra" not in cf.conform(raw, contract, drop_unknown=True).columns
    assert out.schema["amount"].metadata["semantic_tag"] == "amount"
    with pytest.raises(cf.MissingColumns):
        cf.conform(raw.drop("Amount"), contract)
    assert "amount" not in cf.conform(raw.drop("Amount"), contract, strict=False).columns
    assert cf.missing_required(["ID_COMPANY", "Amount"], contract) == ["entry_no", "posting_date"]


def test_presets(frame):
    contract = C.Contract("X", 1, (C.Field("a", "amount", True),))
    raw = frame([("1",)], "a string")
    assert cf.conform_as(raw, contract, "strict_lite")[1] is None
    assert cf.conform_as(raw, contract, "strict_full")[1].count() == 1
    assert cf.conform_as(raw.drop("a").withColumn("b", F.lit(1)), contract, "audit_mode")[1].first()["violated"]


def test_conform_report_and_fills(frame):
    contract = C.Contract("X", 2, (
        C.Field("a", "amount", True, ("A",), fill=C.FILL_ZERO), C.Field("t", "name", fill=C.FILL_EMPTY), C.Field("d", "date", fill=C.FAIL_ON_NULL), C.Field("m", "id", True),
    ))
    raw = frame([("1", None, "2025-01-01"), ("bad", "x", None), (None, "y", "nope")], "A string, t string, d string")
    assert rows(cf.conform(raw, contract, strict=False), "a", "t") == [(Decimal("0.00"), "x"), (Decimal("0.00"), "y"), (Decimal("1.00"), "")]
    got = {r["column"]: r for r in cf.conform_report(raw, contract).collect()}
    assert (got["a"]["source_column"], got["a"]["nulls_before"], got["a"]["nulls_after"], got["a"]["invalid_to_null"], got["a"]["filled"]) == ("A", 1, 0, 1, 2)
    assert got["d"]["violated"] and got["d"]["invalid_to_null"] == 1 and got["m"]["violated"] and got["m"]["nulls_before"] is None
    assert [type(r).__name__ for r in cf.contract_rules(contract)] == ["ColumnExistsCheck", "SemanticValidityCheck", "NoNullsCheck", "ColumnExistsCheck", "SemanticValidityCheck"]


def test_first_alias_wins(frame):
    df = frame([(1, 2, 3)], "`Voucher Id` int, id int, other int")
    assert naming.rename_first_existing(df, naming.OPS_USAGE_ALIASES).columns == ["voucher_id", "id", "other"]


def test_csv_keeps_bad_rows_apart(spark, tmp_path):
    path = str(tmp_path / "u.csv")
    (tmp_path / "u.csv").write_text("Voucher Id,Amount Used\nV1,\"1,000\"\nV2,2,3,4\nV3,5\n")
    df = io.read_csv(spark, path, io.header_of(spark, path))
    assert rows(io.good_rows(df)) == [("V1", "1,000"), ("V3", "5")]
    assert [r[io.CORRUPT] for r in io.bad_rows(df).collect()] == ["V2,2,3,4"]
    assert io.read_ops_usage(spark, path).columns == ["voucher_id", "amount_used"]
    assert rows(io.read_conformed_csv(spark, path, "OPS_USAGE"), "amount_used") == [(Decimal("1000.00"),), (Decimal("5.00"),)]


def test_csv_round_trip_and_snapshot(spark, frame, tmp_path):
    df = frame([(i, f"a,{i}\"") for i in range(30)], "k int, s string")
    io.write_csv(df, str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True, escape="\\").count() == 30
    io.write_snapshot(df, ["k"], str(tmp_path / "snap"), 5)
    assert sorted(int(r["k"]) for r in spark.read.csv(str(tmp_path / "snap"), header=True).collect()) == [25, 26, 27, 28, 29]
    head, size = io.report_rows(df, ["k"], 10)
    assert head.count() == 10 and tuple(size.first()) == (30, True)


def test_ingest_and_table(spark, frame, tmp_path):
    df = frame([("a\r\nb", 1.25)], "s string, x double")
    target = StructType([StructField("s", StringType()), StructField("x", DecimalType(10, 2))]).add("dat_load_date", "date")
    out = io.ingest(df, target, datetime(2025, 10, 1))
    assert rows(out, "s", "x") == [("ab", Decimal("1.25"))] and str(out.first()["dat_load_date"]) == "2025-10-01"


def test_resolve_dataset(spark, frame, tmp_path):
    root = str(tmp_path)
    frame([(1,)], "k int").write.parquet(f"{root}/company=EC_NG/IPE_08_ISSUANCE.parquet")
    frame([(2,)], "k int").write.parquet(f"{root}/CR_04.parquet")
    (tmp_path / "JX.csv").write_text("a,b\n1,2\n")
    given = frame([(9,)], "k int")
    assert io.resolve_dataset(spark, "IPE_08", {"IPE_08": given}, folder=root)[1] == "supplied"
    assert io.resolve_dataset(spark, "IPE_08", live=lambda d: given)[1] == "live"
    found, where = io.resolve_dataset(spark, "IPE_08", folder=root, company="EC_NG")
    assert where == "company file EC_NG" and found.first()["k"] == 1
    assert io.resolve_dataset(spark, "CR_04", folder=root, company="EC_NG")[1] == "shared file"
    assert rows(io.resolve_dataset(spark, "JX", folder=root)[0]) == [("1", "2")]
    assert io.resolve_dataset(spark, "NONE", folder=root) == (None, "none")


def test_parameters(spark, frame):
    params = io.period_params("2025-09-30", ["NG", "JD_GH", "CI"])
    assert params["subsequent_month_start"] == "2025-10-01" and params["companies"] == ["EC_NG", "JD_GH", "EC_IC"] and params["currencies"] == ["GHS", "NGN", "XOF"]
    df = io.run_query(spark, "select * from {t} where k = :k", {"k": 2}, {"t": frame([(1,), (2,)], "k int")})
    assert rows(df) == [(2,)]
    with pytest.raises(Exception):
        io.run_query(spark, "select :missing").collect()


def test_staged_is_a_table(spark):
    df = spark.range(10).select("id", F.lit("x").alias("s"))
    out = staging.staged(df, "probe")
    assert out.dtypes == df.dtypes and out.count() == 10 and out.inputFiles()
    assert staging.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_orders_and_unions(frame):
    df = frame([(None,), (2,), (1,)], "k int")
    assert [r["k"] for r in joins.order_rows(df, ["k"]).collect()] == [1, 2, None]
    assert [r["k"] for r in joins.tail_rows(df, ["k"], 2).collect()] == [None, 2]
    assert rows(joins.stack_frames([df, frame([("a",)], "s string")])) == [(None, None), (None, "a"), (1, None), (2, None)]
