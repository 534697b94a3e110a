"""The chained close from source tables to published results."""

import os

import pytest
from pyspark.sql import functions as F

from closewright.checks import queries as q
from closewright.operators import audit, conform as cf, evidence, quality, reports
from closewright.plans import close
from closewright.sources import publish
from closewright.sources.contract_tables import CONTRACTS
from closewright.sources.sample_views import SampleTables
from tests.conftest import rows

FOLDER = os.environ.get("SAMPLE_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables absent")

EXTRACTS = {
    "CR_04": {"cutoff": q.CUTOFF, "accounts": ["18412"]}, "CR_05": {"year": 1998, "month": 9},
    "IPE_10": {"cutoff": q.CUTOFF, "since": "1995-06-01"}, "IPE_31": {"cutoff": q.CUTOFF, "excluded_countries": ("C05", "C09")},
}
SETTINGS = close.CloseSettings(q.CUTOFF, q.BATCH_USER, countries=q.STORE_COUNTRIES, contracts=q.CONTRACTS, company_overrides=q.OVERRIDES, extracts=EXTRACTS)


class Broken(dict):
    """Source tables of which one cannot be read."""

    def __init__(self, tables, missing):
        self.tables, self.missing = tables, missing

    def __getitem__(self, name):
        if name == self.missing:
            raise OSError("the table is gone")
        return self.tables[name]


@pytest.fixture(scope="module")
def tables(spark):
    return SampleTables(spark, FOLDER)


def test_reports_of_a_write_equal_their_aggregates(spark, tables, tmp_path):
    """One job writes the table, its conform report, quality, summary, numeric probe and fingerprint."""
    raw = spark.read.parquet(f"{FOLDER}/lineitem.parquet").selectExpr("cast(l_orderkey as string) as `Voucher Id`", "if(l_linenumber = 3, 'n/a', cast(l_extendedprice as string)) as `Amount Used`", "l_shipdate as usage_date", "l_discount as extra")
    contract = CONTRACTS["OPS_USAGE"]
    gathered = reports.Gathered()
    df = cf.conform(gathered.watch(raw, {"contract": cf.contract_report(raw, contract)}), contract)
    rules = cf.contract_rules(contract)
    df = gathered.watch(df, {"quality": quality.rule_report(df, rules), "summary": audit.summary_report(df, "t"), "probe": reports.numeric_probe(df, "p", df.columns)})
    told = gathered.watch(df.withColumn(evidence.DIGEST, evidence.row_digest(df)), {"print": evidence.fingerprint_report(df.columns, "t")}).drop(evidence.DIGEST)
    spark.sparkContext.setJobGroup("one-write", "")
    told.write.parquet(str(tmp_path / "t"))
    found = gathered.reports()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("one-write")
    spark.sparkContext.setJobGroup("after", "")
    assert len(jobs) == 1
    plain = cf.conform(raw, contract)
    assert rows(found["contract"]) == rows(cf.conform_report(raw, contract))
    assert rows(found["quality"]) == rows(quality.run_quality(plain, rules))
    assert rows(found["summary"]) == rows(audit.table_summary(plain, "t"))
    assert rows(found["print"]) == rows(evidence.fingerprint(plain, "t")) == rows(evidence.fingerprint(spark.read.parquet(str(tmp_path / "t")), "t"))
    expected = {r.metric: r.value for r in audit.probe_metrics(plain, "p", plain.columns).collect()}
    assert {r.metric: r.value for r in found["probe"].collect()} == {k: v for k, v in expected.items() if k in {r.metric for r in found["probe"].collect()}}
    assert {"row_count", "column_count", "amount_used_sum", "amount_used_mean"} <= {r.metric for r in found["probe"].collect()}


def test_reports_of_an_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "a decimal(18,2), b string")
    gathered = reports.Gathered()
    told = gathered.watch(df, {"summary": audit.summary_report(df, "t"), "probe": reports.numeric_probe(df, "p", ["a"])})
    told.write.parquet(str(tmp_path / "t"))
    found = gathered.reports()
    assert rows(found["summary"]) == rows(audit.table_summary(df, "t")) and {r.metric: r.value for r in found["probe"].collect()}["row_count"] == 0


def test_close_from_source_tables(spark, tables, tmp_path):
    folder = str(tmp_path)
    inputs = close.inputs_from_tables(spark, tables, SETTINGS)
    status = {r["step"]: r for r in close.run_close(spark, inputs, SETTINGS, folder, "1998-09").collect()}
    assert {s for s, r in status.items() if r["status"] == "ERROR"} == set(), [tuple(r) for r in status.values() if r["status"] == "ERROR"]
    assert status["CR_03"]["status"] == "WARNING" and status["CR_03"]["message"] == "found nowhere"
    published = publish.tables_of(publish.current(spark, folder), spark, folder)
    for name in ("CR_04", "conform_report_CR_04", "quality_CR_04", "probe_CR_04", "classified_ledger", "review_table", "component_totals", "vtc_breakdown", "merge_audit", "rule_bridges_IPE_31", "close_status", "run_audit"):
        assert name in published
    assert {"_dataset_id", "_extraction_date", "_cutoff_date"} <= set(published["CR_04"].columns)
    assert published["classified_ledger"].count() == tables["gl_entries"].count()
    # The audit rows, gathered while writing, are the fingerprints of what was written.
    audited = {r["dataset"]: r for r in close.run_audit(spark, folder).collect()}
    for name in ("CR_04", "variance"):
        assert audited[name]["fingerprint"] == evidence.fingerprint(published[name], name).first()["fingerprint"]
    assert audited["CR_04"]["query_text"] == "balances_at_date(cutoff='1998-09-30', accounts=['18412'])"
    # The run once more: no second audit rows.
    close.run_close(spark, inputs, SETTINGS, folder, "1998-09")
    assert close.run_audit(spark, folder).count() == len(audited)


def test_a_broken_source_leaves_the_other_steps(spark, tables, tmp_path):
    folder = str(tmp_path)
    inputs = close.inputs_from_tables(spark, Broken(tables, "order_items"), SETTINGS)
    status = {r["step"]: r["status"] for r in close.run_close(spark, inputs, SETTINGS, folder).collect()}
    assert status["IPE_10"] == "ERROR" and status["CR_04"] != "ERROR" and status["variance"] == "SUCCESS"
    manifest = publish.current(spark, folder)
    assert "IPE_10" not in manifest.tables and "variance" in manifest.tables
    assert close.overall_status(publish.read_published(spark, folder, "close_status")).first()["status"] == "ERROR"


def test_a_killed_run_leaves_the_old_results(spark, frame, tmp_path):
    folder = str(tmp_path)
    first = publish.Run(spark, folder, "m1")
    first.write("a", frame([(1,)], "k int"))
    first.write("b", frame([(1,)], "k int"))
    first.publish()
    killed = publish.Run(spark, folder, "m1")
    killed.write("a", frame([(2,)], "k int"))  # and never publishes
    assert [rows(publish.read_published(spark, folder, t)) for t in ("a", "b")] == [[(1,)], [(1,)]]
    other = publish.Run(spark, folder, "m2")
    other.write("a", frame([(3,)], "k int"))
    other.publish()
    assert rows(publish.read_published(spark, folder, "a")) == [(3,)] and rows(publish.read_published(spark, folder, "a", "m1")) == [(1,)]
    with pytest.raises(KeyError):
        publish.read_published(spark, folder, "b")
    again = publish.Run(spark, folder, "m1")
    again.write("a", frame([(4,)], "k int"))
    again.publish()
    assert rows(publish.read_all_runs(spark, folder, "a")) == [(3,), (4,)]
    assert publish.remove_unpublished(spark, folder) == [killed.attempt]
    assert [m.run_id for m in publish.manifests(spark, folder)] == ["m1", "m2", "m1"]
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, str(tmp_path / "none"), "a")


def test_folder_of_files(spark, tables, tmp_path):
    from closewright.sources import io

    folder = str(tmp_path / "in")
    for name in ("gl_entries", "vouchers", "voucher_usage", "fx_rates"):
        tables[name].write.parquet(f"{folder}/{name}.parquet")
    io.write_csv(tables["ops_usage"], f"{folder}/ops_usage.csv")
    inputs = close.inputs_from_folder(spark, folder, SETTINGS)
    assert inputs.customer_ledger is None and inputs.ops_usage.count() == tables["ops_usage"].count()
    assert sorted(io.FolderTables(spark, folder)) == ["fx_rates", "gl_entries", "ops_usage", "voucher_usage", "vouchers"]
