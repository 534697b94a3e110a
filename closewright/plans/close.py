"""The chained close: load, conform, scope, classify, pivot, compare, judge, drill down, bridge and keep evidence."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closewright.functions.labels import COMPANY_OVERRIDES
from closewright.operators import audit, bridge_rules, bridges, cascade, evidence, fx, pivots, quality, scope, thresholds, totals, variance
from closewright.operators.conform import conform, contract_report, contract_rules
from closewright.operators.naming import VOUCHER_ALIASES, first_existing, rename_first_existing
from closewright.operators.reports import Gathered, Report, numeric_probe
from closewright.plans.extracts import CATALOG, catalog_rules, in_contract_names
from closewright.sources.contract_tables import CONTRACTS
from closewright.sources.io import FolderTables, resolve_dataset
from closewright.sources.publish import Run, read_all_runs
from closewright.sources.staging import release, staged


@dataclass(frozen=True)
class CloseInputs:
    """Sources of one close. Optional ones switch their steps off; one that cannot be read fails only the steps that use it."""

    ledger: DataFrame
    issuance: DataFrame
    usage: DataFrame
    targets: Sequence[DataFrame]
    fx_rates: DataFrame
    ops_usage: DataFrame | None = None
    customer_ledger: DataFrame | None = None
    totals: Mapping[str, DataFrame] = field(default_factory=dict)
    #: Builders of extracts by dataset id, each with the place it comes from: loaded, conformed, checked and written.
    datasets: Mapping[str, Callable[[], tuple[DataFrame | None, str]]] = field(default_factory=dict)


@dataclass(frozen=True)
class CloseSettings:
    cutoff: str
    batch_user: str
    account: str = scope.VOUCHER_ACCOUNT
    countries: Sequence[str] = cascade.STORE_CREDIT_COUNTRIES
    contracts: Sequence[thresholds.ThresholdContract] = thresholds.CONTRACTS
    company_overrides: Mapping[str, str] = field(default_factory=lambda: dict(COMPANY_OVERRIDES))
    only_material: bool = False
    company: str | None = None
    #: Parameters of each extract behind the source tables.
    extracts: Mapping[str, Mapping[str, object]] = field(default_factory=dict)


def load_datasets(
    spark: SparkSession, tables: Mapping[str, DataFrame], settings: CloseSettings, supplied: Mapping[str, DataFrame] | None = None, folder: str | None = None,
    wanted: Sequence[str] = tuple(CATALOG),
) -> dict[str, Callable[[], tuple[DataFrame | None, str]]]:
    """A builder for each dataset: supplied frame, extract over the source tables, company file, shared file, in this order.

    An extract runs for the datasets whose parameters the settings name.
    """
    def live(dataset: str) -> DataFrame | None:
        if dataset not in settings.extracts:
            return None
        return CATALOG[dataset](tables, **settings.extracts[dataset])

    return {name: (lambda name=name: resolve_dataset(spark, name, supplied, live, folder, settings.company)) for name in wanted}


def targets_of(issuance: DataFrame) -> list[DataFrame]:
    """Target values of issued and of used vouchers."""
    vouchers = rename_first_existing(issuance, VOUCHER_ALIASES)
    common = ["country_code", F.col("business_use").alias("voucher_type")]
    issued = vouchers.select(*common, F.lit("Issuance").alias("category"), F.col("remaining_amount").alias("amount_local"), "id")
    used = vouchers.filter("is_active = 0").select(*common, F.lit("Usage").alias("category"), F.col("total_amount_used").alias("amount_local"), "id")
    return [issued, used]


def inputs_from_folder(spark: SparkSession, folder: str, settings: CloseSettings, supplied: Mapping[str, DataFrame] | None = None) -> CloseInputs:
    """The inputs of a close from a folder of source tables and dataset files (Parquet or CSV, one a name)."""
    return inputs_from_tables(spark, FolderTables(spark, folder), settings, supplied, folder)


def inputs_from_tables(spark: SparkSession, tables: Mapping[str, DataFrame], settings: CloseSettings, supplied: Mapping[str, DataFrame] | None = None, folder: str | None = None) -> CloseInputs:
    def optional(name: str) -> DataFrame | None:
        try:
            return tables[name]
        except KeyError:
            return None

    issuance = tables["vouchers"]
    return CloseInputs(
        tables["gl_entries"], issuance, tables["voucher_usage"], targets_of(issuance), tables["fx_rates"], optional("ops_usage"), optional("cle"),
        datasets=load_datasets(spark, tables, settings, supplied, folder),
    )


def conformed(name: str, raw: DataFrame, gathered: Gathered) -> DataFrame:
    """A dataset under its contract, with the contract's report gathered on the raw rows."""
    contract = CONTRACTS.get(name)
    if contract is None:
        return raw
    named = in_contract_names(name, raw)
    return conform(gathered.watch(named, {f"conform_report_{name}": contract_report(named, contract)}), contract)


def facts_of(name: str, raw: DataFrame, df: DataFrame) -> dict[str, Report]:
    """What is gathered while a conformed dataset is written: quality, summary and numeric probe."""
    contract = CONTRACTS.get(name)
    # Expected columns are those of the extract, before it takes its contract's names.
    expected = [r for r in catalog_rules(name) if getattr(r, "column", None) is None or r.column in raw.columns or r.column in df.columns]
    lost = [r for r in catalog_rules(name) if r not in expected]
    rules = [r for r in expected if getattr(r, "column", None) is None or r.column in df.columns] + lost + (contract_rules(contract) if contract else [])
    return {
        f"quality_{name}": quality.rule_report(df, rules, name), f"summary_{name}": audit.summary_report(df, name),
        f"probe_{name}": numeric_probe(df, name, df.columns),
    }


def plan_close(inputs: CloseInputs, settings: CloseSettings, made: list[DataFrame] | None = None) -> dict[str, Callable[[], DataFrame]]:
    """Result tables of the close by name, each built on request.

    The classified ledger and the judged buckets are staged once, because the pivot, the drilldown
    and the bridges all read them; staged frames are put into `made`, for their release.
    """
    def kept(df: DataFrame) -> DataFrame:
        if made is not None:
            made.append(df)
        return df

    @cache
    def classified() -> DataFrame:
        return kept(staged(
            cascade.classify_ledger(inputs.ledger, inputs.issuance, inputs.usage, settings.batch_user, settings.account, settings.countries), "classified"
        ))

    @cache
    def vouchers() -> DataFrame:
        return scope.on_account(classified(), settings.account)

    @cache
    def buckets() -> DataFrame:
        compared = variance.variance_pivot(
            pivots.nav_pivot(pivots.nav_lines(vouchers())), pivots.target_pivot(list(inputs.targets)), rates(), settings.company_overrides
        )
        return kept(staged(variance.with_status(compared, settings.account, settings.contracts), "buckets"))

    @cache
    def unmatched() -> DataFrame:
        return kept(staged(bridges.unmatched_refunds(inputs.issuance, vouchers(), settings.cutoff), "unmatched"))

    def rates() -> DataFrame:
        return fx.rate_table(inputs.fx_rates)

    results: dict[str, Callable[[], DataFrame]] = {
        "classified_ledger": classified,
        "classification_counts": lambda: cascade.classification_counts(classified()),
        "invalid_pairs": lambda: cascade.invalid_pairs(vouchers()),
        "nav_pivot": lambda: pivots.nav_pivot_with_total(pivots.nav_lines(vouchers())),
        "variance": buckets,
        "review_table": lambda: variance.review_table(
            buckets(), settings.account, rates(), pivots.nav_lines(vouchers()), pivots.target_lines(list(inputs.targets)), settings.contracts, settings.company_overrides, settings.only_material
        ),
        "vtc_unmatched": unmatched,
        "vtc_metrics": lambda: bridges.vtc_metrics(inputs.issuance, vouchers(), settings.cutoff),
        "vtc_breakdown": lambda: pivots.frequencies(unmatched(), "business_use", keep_null=False),
        "key_violations": lambda: quality.primary_key_violations(classified(), [c for c in ("company_code", "entry_no") if c in inputs.ledger.columns]),
    }
    if {"id"} <= set(inputs.issuance.columns) & set(inputs.usage.columns):
        results["merge_audit"] = lambda: audit.merge_audit(inputs.issuance, inputs.usage, ["id"], "issuance_usage")
        results["merge_duplicates_issuance"] = lambda: audit.duplicated_rows(inputs.issuance, ["id"])
        results["merge_duplicates_usage"] = lambda: audit.duplicated_rows(inputs.usage, ["id"])
    if inputs.ops_usage is not None:
        results["timing_bridge"] = lambda: bridges.timing_difference(inputs.ops_usage, inputs.issuance, settings.cutoff)
        results["usage_validation"] = lambda: quality.usage_validation(inputs.ops_usage)
        results["bridge_summary"] = lambda: bridges.bridge_summary([
            ("TIMING_DIFFERENCE", bridges.timing_total(bridges.timing_difference(inputs.ops_usage, inputs.issuance, settings.cutoff)), F.col("variance"), F.col("vouchers")),
            ("VTC", bridges.vtc_total(unmatched()), F.col("amount_local"), F.col("vouchers")),
        ])
    if inputs.customer_ledger is not None:
        results["posting_group_conflicts"] = lambda: bridges.posting_group_conflicts(inputs.customer_ledger)
        results["business_line_reclass"] = lambda: bridges.business_line_reclass(inputs.customer_ledger)
    if inputs.totals:
        results["reconciliation_totals"] = lambda: totals.reconciliation_totals(inputs.totals)
    return results


def plan_over_datasets(loaded: Mapping[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    """Steps over the datasets that were written: totals by component, and rule bridges of the rows with a transaction type."""
    results: dict[str, Callable[[], DataFrame]] = {}
    if set(loaded) & {totals.ACTUALS, *totals.COMPONENTS}:
        results["reconciliation_totals"] = lambda: totals.reconciliation_totals(loaded)
        results["component_totals"] = lambda: totals.component_totals(loaded)
    for name, df in loaded.items():
        if first_existing(df, ["transaction_type", "Transaction_Type"]):
            results[f"rule_bridges_{name}"] = lambda df=df: bridge_rules.classify_bridges(df)
    return results


def run_close(spark: SparkSession, inputs: CloseInputs, settings: CloseSettings, folder: str, run_id: str | None = None) -> DataFrame:
    """Write every result table and publish them together; returns the status of each step.

    Each table, its fingerprint for the run audit and, of datasets, the contract, quality and probe reports come from one
    write. Tables lie under the run until the manifest names them all, so readers (`sources.publish`) never see a part
    of a run, and a repeated run replaces its audit rows. A failing step becomes an ERROR row and does not stop the
    others, also where the steps share a failing classification; a failed quality rule makes its dataset a WARNING, as
    does a dataset that is found nowhere.
    """
    started = datetime.now(timezone.utc)
    run = Run(spark, folder, run_id or f"{settings.cutoff}/{settings.company or 'all'}")
    states: list[tuple] = []
    audits: list[DataFrame] = []
    made: list[DataFrame] = []
    loaded: dict[str, DataFrame] = {}

    def write(name: str, df: DataFrame, gathered: Gathered, query: str) -> tuple[DataFrame, dict[str, DataFrame]]:
        told = gathered.watch(df.withColumn(evidence.DIGEST, evidence.row_digest(df)), {f"fingerprint_{name}": evidence.fingerprint_report(df.columns, name)})
        told.drop(evidence.DIGEST).write.parquet(run.new_table(name))
        run.keep(name)
        reports = gathered.reports()
        audits.append(evidence.audit_row(reports.pop(f"fingerprint_{name}"), query, {"cutoff": settings.cutoff, "account": settings.account}, "SUCCESS", started))
        return spark.read.schema(df.schema).parquet(run.new_table(name)), reports

    def guarded(name: str, step: Callable[[], tuple[str, str]]) -> None:
        try:
            state, message = step()
        except Exception as error:  # noqa: BLE001 - reported as a row
            state, message = "ERROR", f"{type(error).__name__}: {str(error).splitlines()[0] if str(error) else ''}"
        states.append((name, state, message, datetime.now(timezone.utc)))

    def dataset_step(name: str, build) -> tuple[str, str]:
        raw, place = build()
        if raw is None:
            return "WARNING", "found nowhere"
        gathered = Gathered()
        df = conformed(name, raw, gathered)
        df = evidence.with_lineage(df, name, started, settings.cutoff)
        df = gathered.watch(df, facts_of(name, raw, df))
        told = f"{CATALOG[name].__name__}({', '.join(f'{k}={v!r}' for k, v in settings.extracts[name].items())})" if place == "live" else f"{name} from {place}"
        loaded[name], reports = write(name, df, gathered, told)
        failed = False
        for report, rows in reports.items():
            kept = run.write(report, rows)
            failed = failed or (report.startswith("quality_") and not kept.filter(~F.col("passed")).isEmpty())
        return ("WARNING", f"{place}; a quality rule failed") if failed else ("SUCCESS", place)

    def result_step(name: str, build) -> tuple[str, str]:
        write(name, build(), Gathered(), name)
        return "SUCCESS", ""

    for name, build in inputs.datasets.items():
        guarded(name, lambda name=name, build=build: dataset_step(name, build))
    for name, build in (plan_over_datasets(loaded) | plan_close(inputs, settings, made)).items():
        guarded(name, lambda name=name, build=build: result_step(name, build))
    status = run.write("close_status", spark.createDataFrame(states, "step string, status string, message string, finished_at timestamp"))
    if audits:
        rows = audits[0]
        for row in audits[1:]:
            rows = rows.unionByName(row)
        run.write("run_audit", rows)
    run.publish()
    release(*made)
    return status


def run_audit(spark: SparkSession, folder: str) -> DataFrame:
    """The audit rows of all runs; of a repeated run, those of its last publication."""
    return read_all_runs(spark, folder, "run_audit")


def overall_status(status: DataFrame) -> DataFrame:
    """ERROR over WARNING over SUCCESS."""
    return status.agg(
        F.when(F.bool_or(F.col("status") == "ERROR"), "ERROR").when(F.bool_or(F.col("status") == "WARNING"), "WARNING").otherwise("SUCCESS").alias("status"),
        F.count("*").alias("steps"),
    )
