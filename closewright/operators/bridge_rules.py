"""First-match classification of transactions by bridge rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closewright.functions.text import flag_text
from closewright.sources.staging import staged


@dataclass(frozen=True)
class BridgeRule:
    """A rule fires when every trigger column holds one of its values, letter case ignored."""

    key: str
    title: str
    triggers: Mapping[str, Sequence[str]]
    dr_gl_accounts: Sequence[str]
    cr_gl_accounts: Sequence[str]
    required_enrichments: Sequence[str] = field(default_factory=tuple)
    rank: int = 2


_BANK = ("bank_posting_group",)
_YES = ("1", "true", "yes")

# The bridge rules of the close.
BRIDGE_RULES = (
    BridgeRule(
        "CASH_DEPOSITS", "Cash deposits pending application",
        {"transaction_type": ("Transfer to", "Third Party Collection", "Payment - Rev", "Translist in progress", "Payment", "Transfer")},
        ("100XX",), ("13011", "13012", "10590"), _BANK, 1,
    ),
    BridgeRule(
        "CASH_DEPOSITS_CANCEL", "Cash deposit cancellations",
        {"transaction_type": ("Payment Charges Rev", "Transfer From", "Reallocation From")},
        ("13011", "13012", "10590"), ("100XX",), _BANK,
    ),
    BridgeRule(
        "JFORCE_PAYOUTS", "JForce payouts by voucher", {"transaction_type": ("JForce Payout", "Jforce Payouts", "Payment")},
        ("18307",), ("18412",), ("jforce_voucher_only",),
    ),
    BridgeRule(
        "PAYMENT_RECONCILES", "Payments reconciled timing differences",
        {"transaction_type": ("Payment", "Transfer to", "Third Party Collection")}, ("13024",), ("13011", "13012", "10590"), _BANK,
    ),
    BridgeRule("PREPAID_DELIVERIES", "Prepaid deliveries in transit", {"is_prepayment": _YES}, ("18350",), ("18314",), (), 3),
    BridgeRule(
        "PREPAYMENTS", "Customer prepayments (TV)", {"is_prepayment": _YES}, ("13012", "13030"), ("18350",),
        ("payment_provider_channel_optional",),
    ),
    BridgeRule(
        "REFUNDS", "Refunds - retail vs MPL", {"transaction_type": ("Refund", "Refunds")}, ("100XX", "18412"), ("13005", "18317"),
        ("refund_channel",),
    ),
    BridgeRule(
        "SALES_CREDIT_MEMOS", "Sales credit memos", {"transaction_type": ("Sales Credit Memo",)}, ("30101", "30102"), ("13005",),
        ("customer_type_flag",), 3,
    ),
    BridgeRule("SALES_DELIVERIES", "Sales deliveries not posted", {"transaction_type": ("Delivery", "DELIVERED")}, ("13005",), ("300XX",), (), 1),
    BridgeRule(
        "SC_ACCOUNT_STATEMENT", "Seller Center account statements",
        {"source": ("Seller Center", "SC"), "entity": ("Account Statement",)}, ("18314",), ("13023",),
    ),
    BridgeRule(
        "SELLER_ACCOUNT_STATEMENTS", "Seller account statements", {"source": ("Seller", "MPL"), "entity": ("Account Statement",)},
        ("18314",), ("13023",),
    ),
)


def classify_bridges(df: DataFrame, rules: Sequence[BridgeRule] = BRIDGE_RULES) -> DataFrame:
    """Add bridge_key, bridge_title, dr_gl_accounts, cr_gl_accounts and required_enrichments.

    Lower rank first, then list order. A rule whose trigger column is absent is dropped at plan
    time; the rest become one CASE.
    """
    names = {c.lower(): c for c in df.columns}
    claim = None
    for rule in sorted(rules, key=lambda r: r.rank):
        if not all(c.lower() in names for c in rule.triggers):
            continue
        hit = F.lit(True)
        for column, values in rule.triggers.items():
            text = F.lower(flag_text(F.col(f"`{names[column.lower()]}`")))
            hit = hit & text.isin(*sorted({v.lower() for v in values}))
        fields = {
            "bridge_key": rule.key, "bridge_title": rule.title, "dr_gl_accounts": ",".join(rule.dr_gl_accounts),
            "cr_gl_accounts": ",".join(rule.cr_gl_accounts), "required_enrichments": ",".join(rule.required_enrichments),
        }
        outcome = F.struct(*[F.lit(v).alias(k) for k, v in fields.items()])
        claim = F.when(hit, outcome) if claim is None else claim.when(hit, outcome)
    out_columns = ("bridge_key", "bridge_title", "dr_gl_accounts", "cr_gl_accounts", "required_enrichments")
    if claim is None:
        return df.withColumns({c: F.lit(None).cast("string") for c in out_columns})
    return df.withColumn("_claim", claim).withColumns({c: F.col(f"_claim.{c}") for c in out_columns}).drop("_claim")


_OUT = ("bridge_key", "bridge_title", "dr_gl_accounts", "cr_gl_accounts", "required_enrichments")
RULE_SCHEMA = "rule_no int, bridge_key string, bridge_title string, dr_gl_accounts string, cr_gl_accounts string, required_enrichments string, rank int, triggers array<struct<column:string,values:array<string>>>"


def rule_table(spark: SparkSession, rules: Sequence[BridgeRule] = BRIDGE_RULES) -> DataFrame:
    """One row per rule; rule_no is the list order. Users may keep such a table themselves."""
    rows = [
        (n, r.key, r.title, ",".join(r.dr_gl_accounts), ",".join(r.cr_gl_accounts), ",".join(r.required_enrichments), r.rank, [(c, list(v)) for c, v in r.triggers.items()])
        for n, r in enumerate(rules)
    ]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def classify_by_table(df: DataFrame, rules: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns of `classify_bridges` from a table of rules; `columns` are those a rule may ask for.

    Each (column, value) lists the rules it triggers. The distinct values of the rows' trigger columns look up their
    lists, hits are counted by rule, and a rule whose hits equal its number of trigger columns matches; the least rank,
    then list order, wins. A rule that asks for a column the rows lack can never reach its number. Rows join their
    values' rule by equality, so the plan does not depend on the number of rules, and a value that very many rows share
    is looked up once.
    """
    names = {c.lower(): c for c in df.columns}
    asked = [c.lower() for c in columns if c.lower() in names]
    text = {c: F.lower(flag_text(F.col(f"`{names[c]}`"))) for c in asked}
    # A trigger without a value, which every row has, for rules that ask for nothing.
    values = F.array(F.struct(F.lit("").alias("column"), F.lit("").alias("value")), *[F.struct(F.lit(c).alias("column"), text[c].alias("value")) for c in asked])
    keyed = df.withColumn("_values", F.filter(values, lambda v: v["value"].isNotNull())).withColumn("_key", F.to_json("_values"))
    order = F.struct("rank", "rule_no")
    number = F.greatest(F.size("triggers"), F.lit(1))
    each = rules.select(order.alias("order"), number.alias("wanted"), F.explode(F.when(F.size("triggers") > 0, F.col("triggers")).otherwise(F.array(F.struct(F.lit("").alias("column"), F.array(F.lit("")).alias("values"))))).alias("t"))
    postings = each.select("order", "wanted", F.lower("t.column").alias("column"), F.explode("t.values").alias("value")).select("order", "wanted", F.struct("column", F.lower("value").alias("value")).alias("trigger")).distinct()
    held = keyed.select("_key", "_values").distinct().select("_key", F.explode("_values").alias("trigger"))
    hits = held.join(postings, "trigger").groupBy("_key", "order", "wanted").agg(F.count("*").alias("hits")).filter("hits = wanted")
    first = hits.groupBy("_key").agg(F.min("order").alias("order"))
    claims = first.join(rules.select(order.alias("order"), *_OUT), "order").select(F.concat("_key", F.lit("|")).alias("_claim"), *_OUT)
    # A table, so its size is known before the rows are moved: usually few values occur, and then no row is.
    claims = staged(claims, "bridge-claims")
    # Joined on a derived key: rows that share their values with very many others can be split over tasks.
    return keyed.withColumn("_claim", F.concat("_key", F.lit("|"))).join(claims, "_claim", "left").select(*[F.col(f"`{c}`") for c in df.columns], *_OUT)


def bridge_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("bridge_key").agg(F.count("*").alias("rows"))
