"""The SQL each query is checked against, written apart from the DataFrame code.

All texts run on the sample tables; the view list in front of each is the one the queries read.
"""

from __future__ import annotations

import re

from closewright.sources.sample_views import view_ctes

ORACLE: dict[str, str] = {}

CUT = "timestamp '1998-09-30'"
NEXT = "timestamp '1998-10-01'"
MONTH = "timestamp '1998-09-01'"
USES = "('apology_v2', 'jforce', 'refund', 'store_credit', 'Jpay store_credit')"


def sql(name: str, views: list[str], body: str, *parts: str) -> None:
    """Register a query: view definitions, further common tables, then the body."""
    tables = [view_ctes(views), *parts] if views else list(parts)
    ORACLE[name] = (f"with {','.join(x for x in tables if x)}\n" if tables else "") + body.strip()


def dbl(*columns: str) -> str:
    return ", ".join(f"cast({c} as double) as {c}" for c in columns)


# --- classification -------------------------------------------------------------------------

GL = ["gl_entries", "vouchers", "voucher_usage"]

# Labels of every ledger row before the lookup, then the four-stage lookup stage by stage.
LABELLED = """
norm as (select *, upper(trim(coalesce(description, ''))) as d, upper(trim(coalesce(comment, ''))) as note,
  upper(trim(coalesce(document_no, ''))) as doc,
  case when replace(upper(trim(user_id)), chr(92), '/') = 'CORP/SVC.BATCH' then 'Integration' else 'Manual' end as integration_type
  from gl_entries),
ruled as (select *, case
  when gl_account <> '18412' then null
  when integration_type = 'Manual' and amount > 0 and bal_account_type = 'Bank Account' then 'VTC'
  when amount < 0 then 'Issuance'
  when amount > 0 and integration_type = 'Integration' then case when contains(d, 'VOUCHER ACCRUAL') then 'Cancellation' else 'Usage' end
  when amount > 0 and contains(d, 'EXPR') then 'Expired'
  when amount > 0 and (contains(d, 'MANUAL RND') or (contains(d, 'PYT_') and contains(note, 'GTB'))) then 'VTC'
  when amount > 0 and document_type = 'Credit Memo' then 'Cancellation'
  when amount > 0 and contains(d, 'ITEMPRICECREDIT') then 'Usage' end as bridge_category
  from norm),
typed as (select *, case
  when bridge_category = 'VTC' then 'Refund'
  when bridge_category = 'Issuance' and integration_type = 'Integration' then case
    when contains(d, 'REFUND') or contains(d, 'RF_') or contains(d, 'RF ') then 'Refund'
    when contains(d, 'COMMERCIAL GESTURE') then 'Apology' when contains(d, 'PYT_') then 'JForce' end
  when bridge_category = 'Issuance' then case
    when left(doc, 3) in ('C07', 'C11', 'C20') then 'Store Credit'
    when contains(d, 'REFUND') or contains(d, 'RFN') or contains(d, 'RF_') or contains(d, 'RF ') then 'Refund'
    when contains(d, 'COMMERCIAL') or contains(d, 'CXP') or contains(d, 'APOLOGY') then 'Apology'
    when contains(d, 'PYT_') then 'JForce' end
  when bridge_category = 'Cancellation' then case when integration_type = 'Integration' then 'Apology' else 'Store Credit' end
  when bridge_category = 'Expired' then case when contains(d, 'EXPR_APLGY') then 'Apology' when contains(d, 'EXPR_JFORCE') then 'JForce'
    when contains(d, 'EXPR_STR CRDT') or contains(d, 'EXPR_STR_CRDT') then 'Store Credit' end end as rule_type
  from ruled)
"""

STAGES = """
s1 as (select k, ty from (select trim(id) as k, business_use as ty,
  row_number() over (partition by trim(id) order by business_use nulls last) as n from vouchers where trim(id) <> '') where n = 1),
s2 as (select k, ty from (select trim(id) as k, business_use as ty,
  row_number() over (partition by trim(id) order by business_use nulls last) as n from voucher_usage where trim(id) <> '') where n = 1),
s3 as (select k, ty from (select trim(transaction_no) as k, business_use as ty,
  row_number() over (partition by trim(transaction_no) order by business_use nulls last) as n from voucher_usage where trim(transaction_no) <> '') where n = 1),
s4 as (select k, ty from (select trim(transaction_no) as k, business_use as ty,
  row_number() over (partition by trim(transaction_no) order by business_use nulls last) as n from vouchers where trim(transaction_no) <> '') where n = 1)
"""

CLASSIFIED = """
classified as (select g.*, case when bridge_category = 'Usage' then
  case when s1.k is not null then s1.ty when s2.k is not null then s2.ty when s3.k is not null then s3.ty when s4.k is not null then s4.ty end
  else rule_type end as voucher_type
  from typed g left join s1 on s1.k = trim(g.voucher_no) left join s2 on s2.k = trim(g.voucher_no)
  left join s3 on s3.k = trim(g.document_no) left join s4 on s4.k = trim(g.document_no)),
ledger as (select * from classified where gl_account = '18412')
"""
FULL = (LABELLED, STAGES, CLASSIFIED)

sql("gl_classified", GL, f"select entry_no, gl_account, {dbl('amount')}, integration_type, bridge_category, voucher_type from classified", *FULL)
sql(
    "gl_cascade_types", GL,
    """select gl_account, integration_type, bridge_category, voucher_type, count(*) as rows, cast(sum(amount) as double) as amount
from classified group by all""", *FULL,
)
sql(
    "gl_category_counts", GL,
    """select 'bridge_category' as dimension, bridge_category as value, count(*) as rows from classified group by bridge_category
union all select 'voucher_type', voucher_type, count(*) from classified group by voucher_type
union all select 'integration_type', integration_type, count(*) from classified group by integration_type""", *FULL,
)
sql(
    "gl_category_totals", GL,
    """select count(*) as total_rows, sum(case when bridge_category is not null then 1 else 0 end)::bigint as categorized_rows,
sum(case when bridge_category is null then 1 else 0 end)::bigint as uncategorized_rows from classified""", *FULL,
)
sql(
    "gl_invalid_pairs", GL,
    """select c.bridge_category, c.voucher_type, count(*) as rows from classified c
left join (values ('Issuance','Refund'),('Issuance','Apology'),('Issuance','JForce'),('Issuance','Store Credit'),
 ('Cancellation','Apology'),('Cancellation','Store Credit'),('Usage','Refund'),('Usage','Apology'),('Usage','JForce'),('Usage','Store Credit'),
 ('Expired','Apology'),('Expired','JForce'),('Expired','Refund'),('Expired','Store Credit'),('VTC','Refund')) v(c1, t1)
 on v.c1 = c.bridge_category and v.t1 = c.voucher_type
where c.bridge_category is not null and c.voucher_type is not null and v.c1 is null group by c.bridge_category, c.voucher_type""", *FULL,
)
sql(
    "lookup_voucher_type", GL,
    """select lookup_stage, lookup_type, count(*) as rows, cast(sum(amount) as double) as amount from (
select g.amount, case when s1.k is not null then 1 when s2.k is not null then 2 when s3.k is not null then 3 when s4.k is not null then 4 end as lookup_stage,
 case when s1.k is not null then s1.ty when s2.k is not null then s2.ty when s3.k is not null then s3.ty when s4.k is not null then s4.ty end as lookup_type
 from gl_entries g left join s1 on s1.k = trim(g.voucher_no) left join s2 on s2.k = trim(g.voucher_no)
 left join s3 on s3.k = trim(g.document_no) left join s4 on s4.k = trim(g.document_no)) group by lookup_stage, lookup_type""", STAGES,
)

# --- scope ----------------------------------------------------------------------------------

sql("scope_non_marketing", ["vouchers"], f"select id, business_use, {dbl('remaining_amount')} from vouchers where business_use in {USES}")
sql("scope_account", ["gl_entries"], "select gl_account, count(*) as rows, cast(sum(amount) as double) as amount from gl_entries where trim(gl_account) = '18412' group by gl_account")
sql("scope_company", ["gl_entries"], f"select entry_no, company_code, {dbl('amount')} from gl_entries where company_code = 'JM_C01'")
sql(
    "scope_rolling_year", ["vouchers"],
    """select count(*) as vouchers, min(created_at) as first_day, max(created_at) as last_day, cast(sum(total_amount_used) as double) as amount
from vouchers where created_at >= timestamp '1997-10-01' and created_at <= timestamp '1998-09-30'""",
)
sql("scope_inactive_month", ["vouchers"], f"select id, inactive_at from vouchers where inactive_at >= {MONTH} and inactive_at <= {CUT}")
sql("scope_null_keys_dropped", ["cle"], "select business_line_code, count(*) as rows from cle where customer_id is not null and business_line_code is not null group by business_line_code")
sql(
    "drilldown_view", GL,
    """select voucher_no as voucher_id, bridge_category as category, cast(amount as double) as amount, posting_date as date, country_code,
integration_type as business_line, description as details from classified where bridge_category = 'Usage' and country_code = 'C01'""", *FULL,
)
sql(
    "voucher_details", ["gl_entries", "vouchers"],
    f"""select entry_no, voucher_no, {dbl('amount')} from gl_entries
where voucher_no in (select id from vouchers where business_use = 'refund' and is_active = 0)""",
)
sql("first_voucher_line", ["gl_entries"], f"select entry_no, voucher_no, posting_date, {dbl('amount')} from gl_entries where voucher_no = '300' order by gl_entries.posting_date, entry_no, gl_entries.amount limit 1")
sql("non_marketing_frequencies", ["vouchers"], f"select business_use, count(*) as vouchers, business_use in {USES} as non_marketing from vouchers where business_use is not null group by business_use")
sql(
    "non_marketing_summary", ["vouchers"],
    f"""select count(*) as total_vouchers, count(*) filter (where business_use in {USES}) as non_marketing_count,
count(*) - count(*) filter (where business_use in {USES}) as marketing_count from vouchers""",
)

# --- scalar functions -----------------------------------------------------------------------

READ = "try_cast(nullif(replace(replace(amount_used, ',', ''), ' ', ''), '') as decimal(18,2))"
sql(
    "numeric_coercion", ["ops_usage"],
    """select voucher_id, count(*) as rows, count(v) as readable, count(*) filter (where amount_used is not null and v is null) as invalid,
cast(sum(coalesce(v, 0)) as double) as amount from r group by voucher_id""", f"r as (select *, {READ} as v from ops_usage)",
)
sql("amount_columns_cast", ["ops_usage"], f"select usage_date, cast(sum(coalesce({READ}, 0)) as double) as amount from ops_usage group by usage_date")
sql(
    "date_functions", ["order_items"],
    f"""select order_item_id, order_nr, cast(date_trunc('month', shipped_date) as timestamp) as month_start, cast(last_day(shipped_date) as timestamp) as month_end,
year(shipped_date) * 100 + month(shipped_date) as yyyymm, concat(year(delivered_date), '-', month(delivered_date)) as delivered_ym,
case when last_day(delivered_date) < date '1998-09-30' then 'Credit' when last_day(delivered_date) > date '1998-09-30' then 'Debit' else 'Due Month' end as due_label,
shipped_date - interval '1' second as second_before from order_items""",
)
sql(
    "date_parsing", ["gl_entries"],
    """select kind, iso, same, count(*) as rows, min(parsed) as first_day from (
select entry_no % 4 as kind, case when entry_no % 4 in (0) then true else false end as iso,
 case entry_no % 4 when 0 then posting_date when 2 then posting_date
  when 1 then posting_date end as parsed,
 case when entry_no % 4 = 3 then null else true end as same from gl_entries) group by kind, iso, same""",
)
sql(
    "key_normalise", ["order_items"],
    "select order_nr, item_no, case when item_no % 2 = 0 then concat('A', order_nr) else order_nr end as voucher_key, true as blank_is_null from order_items",
)
HARMONISED = """case when {0} is null or trim({0}) = '' then 'Unknown' when lower(trim({0})) in ('refund', 'rf_', 'rfn') then 'refund'
 when lower(trim({0})) in ('store credit', 'store_credit', 'storecredit') then 'store_credit'
 when lower(trim({0})) in ('apology', 'commercial gesture', 'cxp') then 'apology' when lower(trim({0})) in ('jforce', 'pyt_', 'pyt_pf') then 'jforce'
 when lower(trim({0})) in ('expired', 'exp') then 'expired' when lower(trim({0})) in ('vtc', 'voucher to cash') then 'vtc' else 'other' end"""
sql("harmonise_type", ["voucher_usage"], f"select business_use, {HARMONISED.format('business_use')} as voucher_type, count(*) as rows from voucher_usage group by business_use")
sql(
    "gl_account_names", ["gl_entries"],
    "select gl_account, case gl_account when '18412' then 'Voucher Liabilities' else 'Unknown GL: ' || gl_account end as account_name, count(*) as rows from gl_entries group by gl_account",
)
FX_COMPANY = "case {0} when 'C01' then 'JM_C01' when 'C02' then 'JD_C02' else 'EC_' || {0} end"
sql("country_company_map", ["company"], f"select country_code, {FX_COMPANY.format('country_code')} as fx_company from company")

# --- currency -------------------------------------------------------------------------------

RATES = "rates as (select company_code as rc, max(fx_rate) as rate from fx_rates where fx_rate is not null and fx_rate <> 0 group by company_code)"
sql(
    "fx_conversion", ["gl_entries", "fx_rates"],
    """select entry_no, company_code, cast(amount as double) as amount, cast(amount as double) / coalesce(rate, 1.0::double) as amount_usd,
rate as fx_rate_used, rate is null as fx_missing from gl_entries left join rates on rc = company_code""", RATES,
)
sql(
    "fx_duplicate_rates", ["fx_rates"],
    """select company_code, count(*) as rates from (select * from fx_rates union all select * from fx_rates where company_code like '%1')
where fx_rate is not null and fx_rate <> 0 group by company_code having count(*) > 1""",
)
sql(
    "fx_from_currency", ["fx_spot"],
    "select 'JM_C01' as company_code, rate_amount as fx_rate from fx_spot where currency_code = 'Q01' and rate_amount <> 0 order by starting_date desc, rate_amount desc limit 1",
)

# --- pivots, variance, review ---------------------------------------------------------------

NAV_LINES = f"nav_lines as (select *, coalesce(bridge_category, 'Uncategorized') as category, {HARMONISED.format('voucher_type')} as vt from ledger)"
NAV = "nav as (select country_code, category, vt as voucher_type, sum(amount) as nav_amount_local from nav_lines group by country_code, category, vt)"
TV_LINES = f"""tv_lines as (select country_code, 'Issuance' as category, {HARMONISED.format('business_use')} as voucher_type, remaining_amount as amount_local, id from vouchers
 union all select country_code, 'Usage', {HARMONISED.format('business_use')}, total_amount_used, id from vouchers where is_active = 0)"""
TV = "tv as (select country_code, category, voucher_type, sum(amount_local) as tv_amount_local from tv_lines group by country_code, category, voucher_type)"
VARIANCE = f"""joined as (select coalesce(n.country_code, t.country_code) as country_code, coalesce(n.category, t.category) as category,
 coalesce(n.voucher_type, t.voucher_type) as voucher_type, coalesce(nav_amount_local, 0) as na, coalesce(tv_amount_local, 0) as ta
 from nav n full join tv t on n.country_code = t.country_code and n.category = t.category and n.voucher_type = t.voucher_type),
variance as (select country_code, category, voucher_type, cast(na as double) as nav_amount_local, cast(ta as double) as tv_amount_local,
 cast(na - ta as double) as variance_amount_local, cast(na as double) / coalesce(rate, 1.0::double) as nav_amount_usd,
 cast(ta as double) / coalesce(rate, 1.0::double) as tv_amount_usd, cast(na - ta as double) / coalesce(rate, 1.0::double) as variance_amount_usd,
 rate as fx_rate_used, rate is null as fx_missing from joined left join rates on rc = {FX_COMPANY.format('country_code')})"""
PIVOTED = (*FULL, NAV_LINES, NAV, TV_LINES, TV, RATES, VARIANCE)
PIVOT_VIEWS = [*GL, "fx_rates"]

sql("nav_pivot", GL, f"select country_code, category, voucher_type, {dbl('nav_amount_local')} from nav", *FULL, NAV_LINES, NAV)
sql(
    "nav_pivot_total", GL,
    """select category, vt as voucher_type, cast(sum(amount) as double) as amount_local, count(amount) as row_count from nav_lines group by category, vt
union all select '__TOTAL__', '', cast(sum(amount) as double), count(amount) from nav_lines""", *FULL, NAV_LINES,
)
sql("tv_pivot", ["vouchers"], f"select country_code, category, voucher_type, {dbl('tv_amount_local')} from tv", TV_LINES, TV)
sql(
    "union_mixed", ["vouchers"],
    f"""select country_code, category, voucher_type, cast(sum(amount_local) as double) as tv_amount_local from (
select country_code, 'Issuance' as category, {HARMONISED.format('business_use')} as voucher_type, remaining_amount as amount_local from vouchers
union all select country_code, null, {HARMONISED.format('business_use')}, remaining_amount from vouchers where is_active = 0)
group by country_code, category, voucher_type""",
)
sql("variance_usd", PIVOT_VIEWS, "select * from variance", *PIVOTED)
sql("variance_ordered", PIVOT_VIEWS, "select country_code, category, voucher_type, variance_amount_local from variance order by 1, 2, 3", *PIVOTED)
sql("variance_missing_fx", PIVOT_VIEWS, "select country_code, count(*) filter (where fx_missing) as buckets_without_rate, count(*) as buckets from variance group by country_code", *PIVOTED)



def threshold_rules() -> str:
    """The sample contracts as a rule table: country (null is the default), scopes, value, description, version, hash."""
    from closewright.checks.queries import CONTRACTS

    rows, ordinal = [], 0
    for contract in CONTRACTS:
        default = contract.country_code == "DEFAULT"
        for r in contract.rules:
            ordinal += 1
            scope = [f"'{x[0]}'" if x else "null" for x in (r.gl_accounts, r.categories, r.voucher_types)]
            text = f"DEFAULT: {r.description}" if default else r.description
            country = "null" if default else f"'{contract.country_code}'"
            rows.append(
                f"({country}, '{r.threshold_type}', {', '.join(scope)}, {r.value_usd}::double, '{text}', {contract.version}::bigint, '{contract.content_hash}', {ordinal})"
            )
    return f"rules(country, kind, gl, cat, vt, value_usd, text, version, hash, ord) as (values {', '.join(rows)})"


RESOLVED = """
{0} as (select * from (select b.country_code as bc, b.category as bcat, b.voucher_type as bvt, r.value_usd, r.text, r.version, r.hash,
  ((r.gl is not null)::int + (r.cat is not null)::int + (r.vt is not null)::int)::bigint as spec,
  row_number() over (partition by b.country_code, b.category, b.voucher_type order by (r.country is null)::int,
   (r.gl is not null)::int + (r.cat is not null)::int + (r.vt is not null)::int desc, r.ord) as n
 from variance b join rules r on r.kind = '{1}' and (r.country is null or r.country = b.country_code) and (r.gl is null or r.gl = '18412')
  and (r.cat is null or r.cat = b.category) and (r.vt is null or r.vt = b.voucher_type)) where n = 1)
"""
STATUS = """
status as (select v.*, t.value_usd as threshold_usd, case when abs(variance_amount_usd) < t.value_usd then 'OK' else 'INVESTIGATE' end as status,
 t.version as threshold_contract_version, t.hash as threshold_contract_hash, t.text as threshold_rule_description, 'catalog' as threshold_source, t.spec as threshold_specificity
 from variance v join bucket_t t on t.bc = v.country_code and t.bcat = v.category and t.bvt = v.voucher_type)
"""


def _register_review() -> None:
    judged = (*PIVOTED, threshold_rules(), RESOLVED.format("bucket_t", "BUCKET_USD"), STATUS)
    sql("variance_status", PIVOT_VIEWS, "select * from status", *judged)
    line_t = RESOLVED.format("line_t", "LINE_ITEM_USD")

    def items(side: str, lines: str, vt: str, voucher: str, document: str, amount: str) -> str:
        local, usd = f"cast({amount} as double)", f"cast({amount} as double) / coalesce(rate, 1.0::double)"
        show = lambda s, x: x if side == s else "null::double"
        return f"""select l.country_code, '18412' as gl_account, l.category, l.{vt} as voucher_type, 'line_item' as row_type, {voucher} as voucher_id,
 {document} as document_no, {show('nav', local)} as nav_amount_local, {show('tv', local)} as tv_amount_local, {local} as variance_amount_local,
 {show('nav', usd)} as nav_amount_usd, {show('tv', usd)} as tv_amount_usd, {usd} as variance_amount_usd, s.threshold_usd as bucket_threshold_usd,
 'INVESTIGATE' as bucket_status, t.value_usd as line_item_threshold_usd, abs({usd}) >= t.value_usd as line_item_material,
 s.threshold_contract_version, s.threshold_contract_hash, t.text as threshold_rule_description
 from {lines} l join status s on s.status = 'INVESTIGATE' and s.country_code = l.country_code and s.category = l.category and s.voucher_type = l.{vt}
 join line_t t on t.bc = l.country_code and t.bcat = l.category and t.bvt = l.{vt} left join rates on rc = {FX_COMPANY.format('l.country_code')}"""

    nav = items("nav", "nav_lines", "vt", "l.voucher_no", "l.document_no", "l.amount")
    tv = items("tv", "tv_lines", "voucher_type", "l.id", "null::varchar", "l.amount_local")
    sql("line_items_nav", PIVOT_VIEWS, f"select * from ({nav}) where line_item_material", *judged, line_t)
    summary = """select country_code, '18412' as gl_account, category, voucher_type, 'bucket_summary' as row_type, null::varchar as voucher_id, null::varchar as document_no,
 nav_amount_local, tv_amount_local, variance_amount_local, nav_amount_usd, tv_amount_usd, variance_amount_usd, threshold_usd as bucket_threshold_usd,
 'INVESTIGATE' as bucket_status, null::double as line_item_threshold_usd, null::boolean as line_item_material, threshold_contract_version,
 threshold_contract_hash, threshold_rule_description from status where status = 'INVESTIGATE'"""
    sql("review_table", PIVOT_VIEWS, f"{summary} union all {nav} union all {tv}", *judged, line_t)


_register_review()

# --- bridges --------------------------------------------------------------------------------

OPS = f"ops as (select voucher_id, sum(coalesce({READ}, 0)) as used from ops_usage where voucher_id is not null group by voucher_id)"
TIMING = f"""timing as (select id, business_use, total_amount_used, coalesce(used, 0) as ops_amount_used, coalesce(used, 0) - total_amount_used as variance
 from vouchers left join ops on voucher_id = id where created_at between timestamp '1997-10-01' and {CUT} and is_active = 0 and business_use in {USES})"""
sql("timing_bridge", ["vouchers", "ops_usage"], f"select id, business_use, {dbl('total_amount_used', 'ops_amount_used', 'variance')} from timing", OPS, TIMING)
sql(
    "timing_total", ["vouchers", "ops_usage"],
    "select count(*) as vouchers, count(*) filter (where ops_amount_used <> 0) as vouchers_with_usage, cast(coalesce(sum(timing.variance), 0) as double) as variance from timing", OPS, TIMING,
)
sql("usage_by_voucher", ["ops_usage"], "select voucher_id, cast(used as double) as amount_used from ops", OPS)
VTC = f"""src as (select *, regexp_replace(upper(trim(id)), '^([0-9]+)\\.0$', '\\1') as k from vouchers where business_use = 'refund' and is_valid = 'valid' and is_active = 0
  and inactive_at between {MONTH} and {CUT}),
canc as (select distinct nullif(regexp_replace(upper(trim(voucher_no)), '^([0-9]+)\\.0$', '\\1'), '') as k from ledger
  where lower(trim(bridge_category)) like 'cancellation%' or lower(trim(bridge_category)) in ('vtc', 'vtc manual')),
vtc as (select * from src where not exists (select 1 from canc where canc.k = src.k))"""
sql("vtc_unmatched", GL, f"select id, company_code, {dbl('remaining_amount')} from vtc", *FULL, VTC)
sql(
    "vtc_amount", PIVOT_VIEWS,
    """select cast(coalesce(sum(n), 0) as bigint) as vouchers, cast(coalesce(sum(a), 0) as double) as amount_local, round(coalesce(sum(cast(a as double) / coalesce(rate, 1.0::double)), 0), 2) as amount_usd
from (select company_code, count(*) as n, sum(remaining_amount) as a from vtc group by company_code) left join rates on rc = company_code""", *FULL, VTC, RATES,
)
sql(
    "vtc_metrics", GL,
    """select (select count(*) from src) as refund_vouchers, (select count(distinct k) from src) as source_unique_voucher_keys,
(select count(*) from src where k in (select k from canc where k is not null)) as matched_source_vouchers, (select count(*) from vtc) as unmatched_vouchers,
(select count(k) from canc) as target_unique_voucher_keys""", *FULL, VTC,
)
sql("vtc_breakdown", GL, "select business_use, count(*) as rows from vtc where business_use is not null group by business_use", *FULL, VTC)
sql(
    "posting_group_conflicts", ["cle"],
    """select customer_id, min(customer_name) as customer_name, count(distinct posting_group) as group_count,
string_agg(distinct posting_group, ', ' order by posting_group) as posting_groups from cle group by customer_id having count(distinct posting_group) > 1""",
)
RECLASS = """bal as (select customer_id, business_line_code, sum(amount_lcy) as b from cle where customer_id is not null and business_line_code is not null
 group by customer_id, business_line_code having abs(sum(amount_lcy)) >= 0.01),
marked as (select *, count(*) over (partition by customer_id) as n,
 first_value(business_line_code) over (partition by customer_id order by abs(b) desc, business_line_code) as prime from bal)"""
sql(
    "business_line_reclass", ["cle"],
    """select customer_id, business_line_code, cast(b as double) as balance_lcy, n as num_business_lines_for_customer, prime as proposed_primary_business_line,
case when business_line_code <> prime then cast(b as double) else 0 end as proposed_reclass_amount_lcy, true as review_required from marked where n > 1""", RECLASS,
)
sql(
    "business_line_reasoning", ["cle"],
    """select customer_id, business_line_code, 'Customer ' || customer_id || ' has ' || n || ' business lines. Proposed primary: ' || prime || ' (largest absolute balance). ' ||
case when business_line_code <> prime then 'Reclass ' || cast(b as decimal(28,2)) || ' from ' || business_line_code || ' to ' || prime || '.'
 else 'Current BL is proposed primary. No reclass needed.' end as reasoning from marked where n > 1""", RECLASS,
)
sql("adjustment_by_target", ["gl_entries"], "select gl_account, cast(sum(amount) as double) as amount, count(*) as rows from gl_entries where user_id like 'USER%' group by gl_account")
sql(
    "bridge_summary", [*GL, "ops_usage"],
    """select bridge, cast(amount as double) as amount, items, case when items > 0 then 'EXPLAINED' else 'NONE' end as status from (
select * from parts union all select 'TOTAL', sum(amount), cast(sum(items) as bigint) from parts)""", *FULL, VTC, OPS, TIMING,
    """parts as (select 'TIMING_DIFFERENCE' as bridge, coalesce(sum(timing.variance), 0) as amount, count(*) as items from timing
 union all select 'VTC', coalesce(sum(remaining_amount), 0), count(*) from vtc)""",
)
BRIDGED = """facts as (select transaction_type, null::double as pre, amount from cash_transactions
 union all select case when refund_date is not null then 'REFUND' end, is_prepayment::double, unit_price from order_items),
keyed as (select *, case
 when lower(transaction_type) in ('transfer to', 'third party collection', 'payment - rev', 'translist in progress', 'payment', 'transfer') then 'CASH_DEPOSITS'
 when lower(transaction_type) in ('delivery', 'delivered') then 'SALES_DELIVERIES'
 when lower(transaction_type) in ('payment charges rev', 'transfer from', 'reallocation from') then 'CASH_DEPOSITS_CANCEL'
 when lower(transaction_type) in ('jforce payout', 'jforce payouts') then 'JFORCE_PAYOUTS'
 when pre = 1 then 'PREPAYMENTS' when lower(transaction_type) in ('refund', 'refunds') then 'REFUNDS'
 when lower(transaction_type) = 'sales credit memo' then 'SALES_CREDIT_MEMOS' end as bridge_key from facts),
book(k, title, dr, cr, enrich) as (values
 ('CASH_DEPOSITS', 'Cash deposits pending application', '100XX', '13011,13012,10590', 'bank_posting_group'),
 ('CASH_DEPOSITS_CANCEL', 'Cash deposit cancellations', '13011,13012,10590', '100XX', 'bank_posting_group'),
 ('PREPAYMENTS', 'Customer prepayments (TV)', '13012,13030', '18350', 'payment_provider_channel_optional'),
 ('REFUNDS', 'Refunds - retail vs MPL', '100XX,18412', '13005,18317', 'refund_channel'))"""
sql(
    "rule_bridges", ["cash_transactions", "order_items"],
    """select bridge_key, title as bridge_title, dr as dr_gl_accounts, cr as cr_gl_accounts, enrich as required_enrichments, count(*) as rows,
cast(sum(amount) as double) as amount from keyed left join book on k = bridge_key group by bridge_key, title, dr, cr, enrich""", BRIDGED,
)
sql("rule_bridge_counts", ["cash_transactions", "order_items"], "select bridge_key, count(*) as rows from keyed group by bridge_key", BRIDGED)

# --- catalog extracts -----------------------------------------------------------------------

sql(
    "ledger_open_items", ["gl_entries", "gl_detail", "company", "chart_of_accounts", "ifrs_map"],
    """select g.entry_no, g.company_code, g.gl_account, cast(g.amount as double) as amount, g.user_id, g.description, g.comment, g.bal_account_type, g.document_type,
g.document_no, g.voucher_no, g.posting_date, g.busline_code, cast(d.rem as double) as remaining_amount, c.country_code as company_country, c.opco_central,
c.in_scope, a.group_account_no, a.group_account_name, i.level_1_name, i.level_2_name, i.level_3_name,
case when g.description like '%BM%' or g.description like '%BACKMARGIN%' then 'BackMargin' else 'Other' end as entry_type
from gl_entries g join (select x.company_code, x.entry_no, sum(x.amount) as rem from gl_detail x left join company c on c.company_code = x.company_code
 where x.posting_date between timestamp '1998-01-01' and timestamp '1998-12-31' and x.gl_account in ('15010', '18412') and c.in_scope = 1
 group by x.company_code, x.entry_no having sum(x.amount) <> 0) d on d.company_code = g.company_code and d.entry_no = g.entry_no
left join company c on c.company_code = g.company_code left join chart_of_accounts a on a.company_code = g.company_code and a.account_no = g.gl_account
left join ifrs_map i on i.level_4_code = a.group_account_no where c.in_scope = 1""",
)
sql(
    "balances_at_date", ["gl_balances"],
    """select company_code, country_code, group_account_no, cast(closing_date as timestamp) as closing_date, busline_code, cast(balance_at_date as double) as balance_at_date
from gl_balances where closing_date = date '1998-09-30' and group_account_no in ('18412')""",
)
sql(
    "fx_closing", ["fx_company", "fx_monthly", "country"],
    """select p.company_code, p.country_code, p.company_name, p.opco_central, p.is_active, f.rate_type, f.rate_year, f.rate_month, c.country_name,
case when c.country_name = 'United States of America' or (c.country_name = 'Germany' and right(p.company_code, 4) = '_USD') then 1.0::double else f.rate end as fx_rate
from fx_company p left join (select * from fx_monthly where rate_year = 1998 and rate_month = 9 and rate_type = 'Closing' and base_currency = 'USD'
 and country <> 'United arab emirates (the)') f on f.country_code = p.country_code left join country c on c.country_code = p.country_code""",
)
sql(
    "fx_spot", ["fx_spot"],
    f"""select currency_code, year(starting_date) as year, month(starting_date) as month, rate_amount from fx_spot
where currency_code in ('Q01', 'Q02', 'Q04', 'Q07', 'Q10', 'Q15') and starting_date = {CUT}""",
)
sql(
    "customer_open_items", ["cle", "cle_detail", "company", "customers", "buslines"],
    f"""select e.entry_no, e.customer_id, e.customer_name, e.business_line_code, e.posting_group, e.company_code, cast(e.amount_lcy as double) as amount_lcy,
e.document_no, e.posting_date, e.due_date, c.country_code as company_country, c.opco_central, cast(d2.s as double) as remaining_amount_lcy, cu.name,
cu.busline_code as customer_busline, cu.auto_integrated, cu.posting_group as current_posting_group, cu.stream, b.vertical_1, b.vertical_2, b.vertical_3,
case when last_day(e.due_date) < date '1998-09-30' then 'Credit' when last_day(e.due_date) > date '1998-09-30' then 'Debit' else 'Due Month' end as debit_credit_due_month
from cle e join (select company_code, customer_id, sum(amount) as s from cle_detail where posting_date <= {CUT} group by all having sum(amount) <> 0) d1
 on d1.company_code = e.company_code and d1.customer_id = e.customer_id
join (select company_code, entry_no, sum(amount) as s from cle_detail where posting_date <= {CUT} group by all having sum(amount) <> 0) d2
 on d2.company_code = e.company_code and d2.entry_no = e.entry_no
left join company c on c.company_code = e.company_code left join buslines b on b.company_code = e.company_code and b.busline_code = e.business_line_code
left join customers cu on cu.company_code = e.company_code and cu.customer_no = e.customer_id
where e.posting_date <= {CUT} and e.posting_group in ('BUILDING', 'MACHINERY', '1-URGENT', '5-LOW') and c.in_scope = 1""",
)
COMPANIES = "('JM_C01', 'JD_C02', 'EC_C04', 'EC_C07', 'EC_C10', 'EC_C15', 'EC_C20')"
sql(
    "voucher_issuance", ["voucher_closing", "voucher_templates", "order_items"],
    f"""select v.id, v.company_code, v.code, v.business_use, v.description, v.is_active, v.type, v.template_status, {dbl('v.discount_amount').replace('as v.', 'as ')},
v.from_date, v.to_date, v.created_at, v.updated_at, v.last_time_used, v.voucher_inactive_date, v.template_inactive_date, v.fk_customer,
cast(v.used_discount_amount as double) as used_discount_amount, v.times_used, cast(v.remaining_amount as double) as remaining_amount, t.template_id, t.template_name,
u.voucher_type, cast(coalesce(u.sd, 0) as double) as shipping_discount, cast(coalesce(u.ss, 0) as double) as shipping_storecredit,
cast(coalesce(u.mpl, 0) as double) as mpl_storecredit, cast(coalesce(u.rtl, 0) as double) as rtl_storecredit,
case when v.business_use = 'jpay_store_credit' then case left(v.code, 2) when 'GC' then 'jpay_store_credit_gift' when 'JP' then 'jpay_store_credit_DS'
 else 'jpay_store_credit_other' end else v.business_use end as business_use_formatted,
case when v.to_date < {CUT} then 'expired' else 'valid' end as is_valid,
concat(year(v.to_date), '-', month(v.to_date)) as expiration_ym, concat(year(v.created_at), '-', month(v.created_at)) as creation_ym,
concat(year(v.updated_at), '-', month(v.updated_at)) as last_update_ym, concat(year(v.voucher_inactive_date), '-', month(v.voucher_inactive_date)) as codeinactive_ym,
concat(year(v.template_inactive_date), '-', month(v.template_inactive_date)) as templateinactive_ym,
cast(coalesce(u.ss, 0) + coalesce(u.mpl, 0) + coalesce(u.rtl, 0) as double) as total_amount_used,
cast(coalesce(v.discount_amount, 0) - (coalesce(u.ss, 0) + coalesce(u.mpl, 0) + coalesce(u.rtl, 0)) as double) as total_remaining_amount,
case when v.to_date > (case when v.voucher_inactive_date > v.template_inactive_date then v.template_inactive_date else v.voucher_inactive_date end)
 then (case when v.voucher_inactive_date > v.template_inactive_date then v.template_inactive_date else v.voucher_inactive_date end) else v.to_date end as min_inactive_date
from voucher_closing v left join voucher_templates t on t.id = v.id and t.company_code = v.company_code
left join (select company_code, voucher_code, voucher_type, sum(coalesce(shipping_discount, 0)) as sd, sum(coalesce(shipping_voucher_discount, 0)) as ss,
 sum(case when is_marketplace = 1 then coalesce(coupon_value, 0) else 0 end) as mpl, sum(case when is_marketplace = 0 then coalesce(coupon_value, 0) else 0 end) as rtl
 from order_items where package_delivery_date < {CUT} and year(delivered_date) > 1995 group by company_code, voucher_code, voucher_type) u
 on u.company_code = v.company_code and u.voucher_code = v.code
where v.company_code in {COMPANIES} and v.created_at > timestamp '1995-06-30' and v.created_at < {CUT}""",
)
sql(
    "voucher_timing", ["voucher_closing", "order_items"],
    f"""select v.company_code, v.id as voucher_id, v.code, cast(v.discount_amount as double) as amount, v.business_use, v.type as origin, 'inactive' as status,
v.created_at as creation_date, v.from_date as start_date, v.to_date as end_date, v.fk_customer, v.description as comment, i.order_item_id, i.order_nr,
i.order_creation_date, i.delivered_date as order_delivery_date, i.cancellation_date as order_cancellation_date, i.current_status as order_item_status, i.payment_method
from voucher_closing v left join order_items i on i.company_code = v.company_code and i.voucher_code = v.code
where v.created_at < {CUT} and coalesce(v.is_active, 0) = 0 and v.to_date >= {CUT}
and (i.current_status not in ('delivered', 'cancelled', 'closed') or i.current_status is null) and (i.delivered_date >= {CUT} or i.delivered_date is null)
and (i.cancellation_date >= {CUT} or i.cancellation_date is null)""",
)
sql(
    "voucher_usage_monthly", ["voucher_closing", "order_items"],
    f"""select i.company_code, v.id, i.voucher_type, v.business_use, year(v.created_at) as creation_year,
year(i.package_delivery_date) * 100 + month(i.package_delivery_date) as delivery_mth, cast(sum(coalesce(shipping_voucher_discount, 0)) as double) as shipping_storecredit,
cast(sum(case when is_marketplace = 1 then coalesce(coupon_value, 0) else 0 end) as double) as mpl_storecredit,
cast(sum(case when is_marketplace = 0 then coalesce(coupon_value, 0) else 0 end) as double) as rtl_storecredit,
cast(sum(coalesce(coupon_value, 0) + coalesce(shipping_voucher_discount, 0)) as double) as total_amount_used
from order_items i left join voucher_closing v on v.company_code = i.company_code and v.code = i.voucher_code
where i.voucher_type = 'reusablecredit' and i.package_delivery_date < {CUT} and year(i.delivered_date) > 1995 and i.company_code in {COMPANIES} group by 1, 2, 3, 4, 5, 6""",
)
SHIPPING = "coalesce(base_shipping, 0) - coalesce(shipping_rule_discount, 0) - coalesce(shipping_voucher_discount, 0) + coalesce(customs_fee, 0) - coalesce(customs_rule_discount, 0) + coalesce(freight_fee, 0)"
sql(
    "prepayments", ["order_items"],
    f"""select company_code, is_prepayment, order_item_id, order_nr, customer_id, current_status, case when current_status = 'closed' then 1 else 0 end as is_closed,
is_marketplace, payment_method, order_creation_date, finance_verified_date, delivered_date, package_delivery_date, refund_date,
cast(coalesce(unit_price, 0) - coalesce(coupon_value, 0) - coalesce(cart_rule_discount, 0) as double) as paid_for_items,
cast(coalesce(paid_price, 0) as double) as paid_price, cast({SHIPPING} as double) as paid_for_shipping
from order_items where order_creation_date > timestamp '1995-06-01' and is_prepayment = 1 and finance_verified_date between timestamp '1995-06-01' and {CUT}
and ((is_marketplace = 1 and (delivered_date is null or delivered_date > {CUT}) and (refund_date is null or refund_date > {CUT}))
 or (is_marketplace = 0 and ((delivery_type in ('Digital Content', 'Gift Card') and (delivered_date is null or delivered_date > {CUT}))
  or (delivery_type not in ('Digital Content', 'Gift Card') and (package_delivery_date is null or package_delivery_date > {CUT})))
  and (refund_date is null or refund_date > {CUT})))""",
)
sql(
    "accrued_revenue", ["seller_transactions", "seller_statements", "vendors", "asg_levels", "seller_transaction_types"],
    f"""select t.company_code, t.transaction_id, t.created_date, t.transaction_no, t.asg_name, t.nav_type, cast(t.transaction_amount as double) as transaction_amount,
t.created_manually, t.vendor_id, t.vendor_name, t.order_nr, t.statement_id, a.level_1, a.level_2, a.level_3, s.statement_no, s.start_date, s.end_date, s.paid,
v.is_global, y.transaction_type_name
from seller_transactions t left join seller_statements s on s.company_code = t.company_code and s.statement_id = t.statement_id
left join vendors v on v.company_code = t.company_code and v.vendor_id = t.vendor_id
left join asg_levels a on a.company_code = t.company_code and a.asg_name = t.asg_name
left join seller_transaction_types y on y.company_code = t.company_code and y.transaction_id = t.transaction_id
where t.created_date > timestamp '1995-01-01' and t.created_date >= {MONTH} and t.created_date < {NEXT} and a.level_1 = 'Revenues'
and (t.statement_id is null or s.end_date >= {NEXT})""",
)
sql(
    "packages_unreconciled", ["order_items", "package_cash", "customer_types"],
    f"""select i.company_code, i.package_number, i.payment_method, i.is_marketplace, i.order_nr, i.order_item_id, i.voucher_type, i.customer_id, i.order_creation_date,
i.shipped_date, i.delivered_date, i.package_delivery_date, i.is_prepayment, ct.customer_type_l1, cast(p.amount_expected as double) as amount_expected,
cast(p.amount_received as double) as amount_received, p.delivery_date, p.package_status, p.troubleshoot_date,
cast(coalesce(i.amount_paid, 0) as double) as amount_paid, cast(coalesce(i.paid_price, 0) as double) as paid_price,
cast({SHIPPING} - coalesce(delivery_rule_discount, 0) as double) as paid_shipping
from order_items i left join package_cash p on p.company_code = i.company_code and p.package_nr = i.package_number
left join customer_types ct on ct.customer_type_code = i.customer_type_code
where i.is_prepayment = 0 and i.payment_method <> 'NoPayment' and i.delivered_date between timestamp '1995-06-01' and {CUT}
and (p.troubleshoot_date is null or p.troubleshoot_date > {CUT})""",
)
REFUND = """coalesce(i.price_after_discount, 0) + coalesce(i.base_shipping, 0) + coalesce(i.customs_fee, 0) - coalesce(i.customs_rule_discount, 0)
 - coalesce(i.shipping_rule_discount, 0) - (case when i.voucher_type = 'coupon' then coalesce(i.shipping_voucher_discount, 0) else 0 end)"""
REFUND_COLUMNS = """i.company_code, i.current_status, {0} as case_type, i.is_marketplace, i.order_nr, i.order_item_id, i.customer_id, i.return_date, i.is_global,
 i.finance_verified_date, i.refund_date, r.oms_type, ct.customer_type_l1, cast({1} as double) as amount_to_refund
 from order_items i left join refund_no_return r on r.company_code = i.company_code and r.order_item_id = i.order_item_id
 left join customer_types ct on ct.customer_type_code = i.customer_type_code"""
PERIOD = "between timestamp '1996-01-01' and timestamp '1998-09-30 23:59:59'"
sql(
    "refund_liability", ["order_items", "refund_no_return", "customer_types"],
    f"""select {REFUND_COLUMNS.format("'Refunded not yet returned'", REFUND)} where i.delivered_date is not null and i.refund_date {PERIOD}
and (i.return_date is null or i.return_date >= {NEXT}) and i.company_code not in ('EC_C05', 'EC_C09')
union all select {REFUND_COLUMNS.format("'Returned not yet refunded'", f"-1 * ({REFUND})")} where i.return_date {PERIOD}
and (i.refund_date is null or i.refund_date >= {NEXT}) and i.company_code not in ('EC_C05', 'EC_C09')""",
)
COLLECTION = f"""cte as (select distinct p.company_code, p.packlist_no from packlist_packages p left join packlist_payments y
  on y.company_code = p.company_code and y.packlist_no = p.packlist_no and y.payment_reconciled_amount is not null
  where p.packlist_status = 'waitingApproval' or (p.packlist_status = 'waitingConfirmation' and y.payment_reconciled_amount is null)),
ev as (select t.*, cte.packlist_no as conc, case when t.transaction_type in ('Transfer to', 'Third Party Collection') then coalesce(d.payment_date, t.created_date)
   when t.transaction_type = 'Payment - Rev' then coalesce(d.payment_reversal_date, t.created_date) else t.created_date end as event_date
  from cash_transactions t left join cte on cte.company_code = t.company_code and cte.packlist_no = t.transaction_list_nr
  left join cash_deposits d on d.payment_no = t.related_entity and d.company_code = t.company_code and ((t.transaction_type = 'Transfer to' and d.deposit_type = 'Transfer')
   or (t.transaction_type = 'Third Party Collection' and d.deposit_type = 'Payment') or (t.transaction_type = 'Payment - Rev' and d.deposit_type = 'Payment'))),
items as (
 select company_code, event_date, collection_partner as cp, transaction_type, related_entity, amount from ev
 where transaction_type not in ('Payment', 'Collection Adjustment (over)', 'Collection Adjustment (under)', 'Payment Charges', 'Reallocation From', 'Transfer From', 'Payment Charges Rev')
 and event_date < {NEXT} and (transaction_list_nr is null or transaction_list_date >= {NEXT} or conc is not null) and amount <> 0
 union all
 select company_code, original_transaction_date, collection_partner_from, transaction_type, related_entity, amount from reallocations
 where original_transaction_date < {NEXT} and reallocated_transaction_date >= {NEXT}
 union all
 select tl.company_code, packlist_created_date, collection_partner, 'Translist in progress', tl.packlist_no, amount_received - coalesce(applied, 0)
 from (select company_code, collection_partner, packlist_no, amount_received, packlist_created_date from packlist_payments where packlist_created_date < {NEXT}
  and packlist_status in ('inProgress', 'closed', 'waitingConfirmation') and payment_reconciled_amount is not null group by all) tl
 left join (select company_code, packlist_no, sum(coalesce(payment_reconciled_amount, 0) + coalesce(charges_reconciled_amount, 0)) as applied from packlist_payments
  where payment_date < {NEXT} group by company_code, packlist_no) a on a.company_code = tl.company_code and a.packlist_no = tl.packlist_no
 left join (select company_code, entity_no, force_closed from collection_adjustments where entity_type = 'packlist' and force_closed = 1
  and (close_date < {NEXT} or close_date is null)) fc on fc.company_code = tl.company_code and fc.entity_no = tl.packlist_no
 where (fc.force_closed = 0 or fc.force_closed is null) and amount_received - coalesce(applied, 0) > 0
 union all
 select distinct p.company_code, p.payment_date, p.collection_partner, p.deposit_type, p.payment_no, -(coalesce(p.payment_amount, 0) + coalesce(p.charges_amount, 0) - coalesce(applied, 0))
 from cash_deposits p left join (select company_code, payment_no, sum(coalesce(payment_reconciled_amount, 0) + coalesce(charges_reconciled_amount, 0)) as applied
  from packlist_payments where packlist_created_date < {NEXT} and payment_date < {NEXT} and payment_status in ('inProgress', 'closed', 'waitingConfirmation')
  and payment_reconciled_amount is not null group by company_code, payment_no) p2 on p2.company_code = p.company_code and p2.payment_no = p.payment_no
 left join (select distinct company_code, entity_no, force_closed from collection_adjustments where entity_type <> 'packlist'
  and ((force_closed = 1 and (close_date < {NEXT} or close_date is null)) or close_date < {NEXT})) fc on fc.company_code = p.company_code and fc.entity_no = p.payment_no
 where p.payment_date < {NEXT} and coalesce(p.payment_amount, 0) + coalesce(p.charges_amount, 0) - coalesce(applied, 0) > 0 and fc.force_closed is null
 and p.payment_status in ('inProgress', 'closed', 'waitingConfirmation')),
collections as (select a.company_code, a.event_date, a.cp, a.transaction_type, a.related_entity, a.amount, comp.country_code as company_country, h.service_provider,
  cp.partner_type, cp.erp_name, b.gl_bank_account_no, timestamp '1998-09-30 23:59:59' as closing_date
 from items a left join hubs h on h.company_code = a.company_code and h.node = a.cp
 left join collection_partners cp on cp.company_code = a.company_code and cp.name = a.cp
 left join (select * from company where in_scope = 1) comp on comp.company_code = a.company_code
 left join (select distinct k.company_code, k.provider_no, g.gl_bank_account_no from bank_accounts k left join bank_posting_groups g
  on g.company_code = k.company_code and g.code = k.posting_group_code where k.provider_no is not null and k.provider_no <> '' and g.gl_bank_account_no <> '10058') b
  on b.company_code = a.company_code and b.provider_no = cp.erp_name
 where comp.country_code not in ('C05', 'C09'))"""
COLLECTION_VIEWS = [
    "packlist_packages", "packlist_payments", "cash_transactions", "cash_deposits", "reallocations", "collection_adjustments", "hubs", "collection_partners", "company",
    "bank_accounts", "bank_posting_groups",
]
sql("collection_open_items", COLLECTION_VIEWS, "select * replace (cast(amount as double) as amount) from collections", COLLECTION)
sql(
    "posting_group_of_provider", ["bank_accounts"],
    "select company_code, provider_no, min(posting_group_code) as posting_group_code from bank_accounts where provider_no <> '' group by company_code, provider_no",
)
sql(
    "channel_of_order", ["order_items"],
    """select company_code, order_nr, case when is_marketplace = 1 then 'MPL' else 'Retail' end as channel from (select *,
row_number() over (partition by company_code, order_nr order by item_no, order_item_id, is_marketplace) as n from order_items) where n = 1""",
)

# --- audits and quality ---------------------------------------------------------------------

sql(
    "dup_rows_left", [],
    "select l_orderkey, l_linenumber, l_partkey, l_suppkey from (select *, count(*) over (partition by l_orderkey, l_linenumber) as n from lineitem) where n > 1",
)
sql(
    "merge_audit", [],
    """select l.t::bigint as left_total_rows, l.d::bigint as left_duplicates, l.k::bigint as left_unique_dup_keys, r.t::bigint as right_total_rows, r.d::bigint as right_duplicates,
r.k::bigint as right_unique_dup_keys, 'orders_lines' as merge_name, (l.d > 0 or r.d > 0) as has_duplicates, (l.d > 0 and r.d > 0) as explosion_risk from
(select sum(n) as t, coalesce(sum(n) filter (where n > 1), 0) as d, count(*) filter (where n > 1) as k from (select count(*) as n from orders group by o_orderkey)) l,
(select sum(n) as t, coalesce(sum(n) filter (where n > 1), 0) as d, count(*) filter (where n > 1) as k from (select count(*) as n from lineitem group by l_orderkey)) r""",
)
OVERLAP = """l as (select voucher_id as id, count(*) as n from ops_usage group by voucher_id), r as (select id, count(*) as n from vouchers where is_active = 0 group by id)"""
sql(
    "merge_key_overlap", ["ops_usage", "vouchers"],
    """select *, round(matching_keys * 100.0::double / left_unique_keys, 2) as left_match_rate, round(matching_keys * 100.0::double / right_unique_keys, 2) as right_match_rate,
left_rows - left_unique_keys as left_duplicate_keys, right_rows - right_unique_keys as right_duplicate_keys from (select 'ops_vouchers' as merge_name,
(select sum(n) from l)::bigint as left_rows, (select sum(n) from r)::bigint as right_rows, (select count(*) from l) as left_unique_keys, (select count(*) from r) as right_unique_keys,
(select coalesce(sum(n), 0) from l where id is null)::bigint as left_null_keys, (select coalesce(sum(n), 0) from r where id is null)::bigint as right_null_keys,
(select count(*) from (select id from l intersect select id from r)) as matching_keys, (select count(*) from (select id from l except select id from r)) as left_only_keys,
(select count(*) from (select id from r except select id from l)) as right_only_keys,
(select count(*)::double from ops_usage o join vouchers v on v.id = o.voucher_id and v.is_active = 0) as joined_rows)""", OVERLAP,
)
sql(
    "merge_key_sets", ["ops_usage", "vouchers"],
    """select id, 'both' as side from (select id from l intersect select id from r) union all select id, 'left_only' from (select id from l except select id from r)
union all select id, 'right_only' from (select id from r except select id from l)""", OVERLAP,
)
sql(
    "table_probe", ["gl_entries"],
    """select 'gl_entries' as name, count(*) as rows, 13::bigint as cols, (count(*) * 13 - count(entry_no) - count(company_code) - count(country_code) - count(gl_account)
- count(amount) - count(user_id) - count(description) - count(comment) - count(bal_account_type) - count(document_type) - count(document_no) - count(voucher_no)
- count(posting_date) + (count(*) - count(busline_code)))::bigint as nulls_total, count(*) - (select count(*) from (select distinct * from gl_entries)) as duplicated_rows,
cast(sum(amount) as double) as amount_sum, strftime(min(posting_date), '%Y-%m-%d') as min_date, strftime(max(posting_date), '%Y-%m-%d') as max_date,
count(distinct document_no) as unique_document_no, count(distinct voucher_no) as unique_voucher_no from gl_entries""".replace("13::bigint", "14::bigint"),
)
sql(
    "probe_metrics", ["gl_entries"],
    """select 'ledger' as checkpoint, metric, round(value, 4) as value from (
select 'row_count' as metric, count(*)::double as value from gl_entries union all select 'column_count', 14 union all select 'amount_non_null_count', count(amount) from gl_entries
union all select 'amount_sum', cast(sum(amount) as double) from gl_entries union all select 'amount_mean', cast(sum(amount) as double) / count(amount) from gl_entries
union all select 'voucher_no_non_null_count', count(voucher_no) from gl_entries union all select 'voucher_no_unique_count', count(distinct voucher_no) from gl_entries)""",
)
DESCRIBE = """select '{0}' as "column", count({0}) as count, round(avg({0}), 6) as mean, round(stddev_samp({0}), 6) as std, min({0}) as min, round(quantile_cont({0}, 0.25), 6) as p25,
round(quantile_cont({0}, 0.5), 6) as p50, round(quantile_cont({0}, 0.75), 6) as p75, max({0}) as max from lineitem"""
sql("describe_amounts", [], f"{DESCRIBE.format('l_quantity')} union all {DESCRIBE.format('l_discount')}")
sql(
    "table_summary", [],
    """select 'orders' as "table", (select count(*) from orders) as rows, c as "column" from (values ('o_orderkey'), ('o_custkey'), ('o_orderstatus'), ('o_totalprice'), ('o_orderdate'), ('o_orderpriority')) x(c)""",
)
GL_REPORT = """f as (select count(*) as n, sum(amount) as s, count(voucher_no) as v, count(comment) as c, count(try_cast(description as double)) as dn,
 count(*) filter (where posting_date < timestamp '1998-01-01') as early, count(*) filter (where posting_date < timestamp '1990-01-01' or posting_date > timestamp '2005-01-01') as wide,
 strftime(min(posting_date), '%Y-%m-%d') as lo, strftime(max(posting_date), '%Y-%m-%d') as hi from gl_entries),
report as (select unnest([
 {'rule_no': 0, 'rule': 'RowCountCheck', 'column': null, 'passed': n >= 1}, {'rule_no': 1, 'rule': 'RowCountCheck', 'column': null, 'passed': n between 1 and 10},
 {'rule_no': 2, 'rule': 'ColumnExistsCheck', 'column': 'amount', 'passed': true}, {'rule_no': 3, 'rule': 'ColumnExistsCheck', 'column': 'fx_rate', 'passed': false},
 {'rule_no': 4, 'rule': 'NumericSumCheck', 'column': 'amount', 'passed': s <> 0}, {'rule_no': 5, 'rule': 'NumericSumCheck', 'column': 'amount', 'passed': s = 0},
 {'rule_no': 6, 'rule': 'NumericSumCheck', 'column': 'user_id', 'passed': false}, {'rule_no': 7, 'rule': 'NoNullsCheck', 'column': 'entry_no', 'passed': true},
 {'rule_no': 8, 'rule': 'NoNullsCheck', 'column': 'voucher_no', 'passed': v = n}, {'rule_no': 9, 'rule': 'DTypeCheck', 'column': 'amount', 'passed': true},
 {'rule_no': 10, 'rule': 'DTypeCheck', 'column': 'posting_date', 'passed': false}, {'rule_no': 11, 'rule': 'DateRangeCheck', 'column': 'posting_date', 'passed': wide = 0},
 {'rule_no': 12, 'rule': 'DateRangeCheck', 'column': 'posting_date', 'passed': early = 0}, {'rule_no': 13, 'rule': 'SemanticValidityCheck', 'column': 'amount', 'passed': true},
 {'rule_no': 14, 'rule': 'SemanticValidityCheck', 'column': 'description', 'passed': dn * 100 >= n * 95}, {'rule_no': 15, 'rule': 'SemanticValidityCheck', 'column': 'voucher_no', 'passed': (n - v) * 100 <= n * 5},
 {'rule_no': 16, 'rule': 'SemanticValidityCheck', 'column': 'entry_no', 'passed': true}, {'rule_no': 17, 'rule': 'SemanticValidityCheck', 'column': 'posting_date', 'passed': true},
 {'rule_no': 18, 'rule': 'SemanticValidityCheck', 'column': 'comment', 'passed': c > 0}], recursive := true) from f)"""
sql("quality_report", ["gl_entries"], """select 'gl_entries' as "table", rule_no::bigint as rule_no, rule, "column", passed from report""", GL_REPORT)
sql(
    "quality_details", ["gl_entries"],
    """select 0::bigint as rule_no, 'RowCountCheck' as rule, n || ' rows' as detail from f union all select 1, 'NoNullsCheck', (n - v) || ' nulls of ' || n || ' rows' from f
union all select 2, 'DateRangeCheck', early || ' before, 0 after, range ' || lo || ' to ' || hi from f""", GL_REPORT,
)
sql(
    "quality_status", ["gl_entries"],
    """select 'gl_entries' as "table", case when bool_and(passed) then 'PASS' else 'FAIL' end as status, count(*) as rules, count(*) filter (where not passed) as failed_rules from report""", GL_REPORT,
)
sql(
    "catalog_quality", ["gl_balances", "order_items", "refund_no_return", "customer_types"],
    f"""select 'IPE_10' as "table", 'RowCountCheck' as rule, null as "column", (select count(*) from ({ORACLE['prepayments'][ORACLE['prepayments'].index('select company_code, is_prepayment'):]})) > 0 as passed
union all select 'IPE_34', 'RowCountCheck', null, (select count(*) from order_items where delivered_date is not null and refund_date between timestamp '1996-01-01' and timestamp '1998-09-30 23:59:59') > 0
union all select 'IPE_12', 'RowCountCheck', null, (select count(*) from ({ORACLE['packages_unreconciled']})) > 0
union all select 'CR_04', 'RowCountCheck', null, (select count(*) from gl_balances where closing_date = date '1998-09-30' and group_account_no = '18412') > 0
union all select * from (values ('IPE_10', 'ColumnExistsCheck', 'company_code', true), ('IPE_34', 'ColumnExistsCheck', 'company_code', true), ('IPE_12', 'ColumnExistsCheck', 'company_code', true),
 ('CR_04', 'ColumnExistsCheck', 'balance_at_date', true), ('CR_04', 'ColumnExistsCheck', 'group_account_no', true))""",
)
sql("pk_violations", ["gl_entries"], "select company_code, entry_no, count(*) as rows from gl_entries group by company_code, entry_no having count(*) > 1")
sql(
    "control_totals", ["vouchers"],
    """select control, expected, actual, case when ok then 'PASS' else 'FAIL' end as status from (
select 'completeness' as control, (select count(*) from orders where o_orderstatus <> 'O') as expected, (select count(*) from x) as actual,
 (select count(*) from orders where o_orderstatus <> 'O') = (select count(*) from x) as ok
union all select 'witness', 1, (select count(*) from x where business_use = 'refund'), (select count(*) from x where business_use = 'refund') > 0
union all select 'exclusion', 0, (select count(*) from x where is_active = 1), (select count(*) from x where is_active = 1) = 0)""",
    "x as (select * from vouchers where is_active = 0)",
)
sql(
    "usage_validation", ["ops_usage"],
    """select count(*) as row_count, count(distinct voucher_id) as unique_vouchers, count(*) - count(voucher_id) as null_voucher_ids, count(*) - count(amount_used) as null_amounts,
count(amount_used) - count(v) as unreadable_amounts, count(*) - count(distinct voucher_id) as duplicate_vouchers, count(*) filter (where v < 0) as negative_amounts,
cast(sum(v) as double) as total_amount, true as valid, '' as missing_columns from r""", f"r as (select *, {READ} as v from ops_usage)",
)

# --- contracts ------------------------------------------------------------------------------

sql("conform_rows", ["ops_usage"], f"select voucher_id, cast(coalesce({READ}, 0) as double) as amount_used, usage_date, 'none' as status from ops_usage")
sql(
    "conform_report", ["ops_usage"],
    f"""select 'OPS_USAGE' as dataset_id, 1::bigint as version, c as "column", src as source_column, tag as semantic_tag, req as required, tb as type_before, ta as type_after, nb::bigint as nulls_before,
na::bigint as nulls_after, inv::bigint as invalid_to_null, fil::bigint as filled, bad as violated from (
select 'voucher_id' as c, 'Voucher Id' as src, 'id' as tag, true as req, 'string' as tb, 'string' as ta, count(*) - count(voucher_id) as nb, count(*) - count(voucher_id) as na, 0 as inv, 0 as fil, false as bad from ops_usage
union all select 'amount_used', 'Amount Used', 'amount', true, 'string', 'decimal(18,2)', count(*) - count(amount_used), 0, count(amount_used) - count({READ}), count(*) - count({READ}), false from ops_usage
union all select 'usage_date', 'Usage Date', 'date', false, 'timestamp_ntz', 'timestamp_ntz', count(*) - count(usage_date), count(*) - count(usage_date), 0, 0, false from ops_usage
union all select 'order_id', null, 'id', false, null, 'string', null, null, null, null, false union all select 'status', null, 'code', true, null, 'string', null, null, null, null, true)""",
)
sql("ingest_projection", ["gl_entries"], f"select document_no, {dbl('amount')}, description from gl_entries")
sql(
    "lineage_columns", ["company"],
    "select company_code, 'CR_05' as _dataset_id, '1998-10-02T03:04:05' as _extraction_date, '1998-09-30' as _cutoff_date from company",
)

# The fingerprint text of a ledger row: JSON with the columns in name order and nulls written out.
ROW_TEXT = """'{' || concat_ws(',', '"amount":' || amount, j('bal_account_type', bal_account_type), j('busline_code', busline_code), j('comment', comment), j('company_code', company_code),
 j('country_code', country_code), j('description', description), j('document_no', document_no), j('document_type', document_type), '"entry_no":' || entry_no, j('gl_account', gl_account),
 '"posting_date":"' || strftime(posting_date, '%Y-%m-%dT%H:%M:%S.000') || '"', j('user_id', user_id), j('voucher_no', voucher_no)) || '}'"""


def _json_text(text: str) -> str:
    """Expand j(name, column) to the JSON member of a text column."""
    return re.sub(r"j\('(\w+)', (\w+)\)", r"""'"\1":' || coalesce('"' || replace(\2, chr(92), chr(92) || chr(92)) || '"', 'null')""", text)


LIMBS = ", ".join(f"sum(('0x' || substr(h, {1 + 8 * i}, 8))::ubigint)::varchar as s{i}" for i in range(6))
GL_COLUMNS = (
    "amount,bal_account_type,busline_code,comment,company_code,country_code,description,document_no,document_type,entry_no,gl_account,posting_date,user_id,voucher_no"
)
sql(
    "dataset_fingerprint", ["gl_entries"],
    f"""select 'gl_entries' as dataset, n as data_rows, 14::bigint as data_columns, sha256(concat_ws('|', s0, s1, s2, s3, s4, s5, n::varchar, '{GL_COLUMNS}')) as fingerprint
from (select count(*) as n, {LIMBS} from digests)""", f"digests as (select sha256({_json_text(ROW_TEXT)}) as h from gl_entries)",
)
sql("fingerprint_verified", ["vouchers"], """select copy, 'vouchers' as dataset, n as data_rows, n as recorded_rows, copy = 'shuffled' or paid_off = 0 as verified
from (values ('shuffled'), ('changed')) c(copy), (select count(*) as n, count(*) filter (where is_active <> 1 and remaining_amount <> 0) as paid_off from vouchers)""")

from closewright.checks.queries import COMPANIES, EXTRACTS  # noqa: E402
from closewright.plans.extracts import CONTRACT_NAMES  # noqa: E402
from closewright.sources.contract_tables import CONTRACTS  # noqa: E402

# Every extract has all its rows under its contract, and its company or currency in each.
ORACLE["conformed_extracts"] = " union all ".join(
    f"select '{dataset}' as dataset_id, count(*) as rows, count({'currency_code' if dataset == 'CR_05a' else 'company_code'}) as keyed_rows from ({ORACLE[name]})" for dataset, name in EXTRACTS.items()
)

# Contract columns that an extract does not deliver.
NOT_DELIVERED = {
    "CR_03": (
        "external_document_no document_date account_name department_code bal_account_no bal_account_name reason_code source_code reversed "
        "g_l_creation_date destination_code partner_code system_created_entry source_type source_no ic_partner_code vendortag_code "
        "customertag_code service_period"
    ),
    "CR_04": (
        "company_name country_name refresh_date group_coa_account_name real_coa currency fx_rate reporting_country_code "
        "reporting_country_name partner_code ic_partner_code is_recharge is_retained_earnings conso_account_no conso_account_name "
        "ifrs_level_1_name ifrs_level_2_name ifrs_level_3_name is_interco"
    ),
    "IPE_07": (
        "gl_entry_no document_type external_document_no description source_code reason_code department_code original_amount currency open "
        "posted_by destination_code partner_code ic_partner_code"
    ),
    "IPE_08": "snapshot_date reason",
    "DOC_VOUCHER_USAGE": "transaction_no",
    "IPE_10": "refund_completed fail_date",
    "IPE_11": "sc_nav_message sc_vendor_no sc_id_sales_order_item oms_id_sales_order_item bob_id_sales_order_item sc_paid_date asg_level_4",
    "IPE_12": (
        "package_number mtr_shipping_fee_modification tracking_number oms_package_status fk_package_status delivered_update_date "
        "fk_collection_partner last_mile payment_method_confirmed"
    ),
}


def _conformed(dataset: str) -> str:
    """The extract's rows with its contract's columns, each read as its tag asks."""
    contract, names = CONTRACTS[dataset], CONTRACT_NAMES[dataset] | ({} if dataset == "CR_05" else {"company_code": "id_company"})
    source, missing, out = {v: k for k, v in names.items()}, NOT_DELIVERED.get(dataset, "").split(), []
    for f in contract.fields:
        if f.name not in missing:
            c = f'"{source.get(f.name, f.name)}"'
            if f.spark_type == "bigint":
                value = f"cast(try_cast({c} as decimal(20,2)) as bigint)"
            elif f.tag == "amount":
                value = f"cast(try_cast({c} as decimal(18,2)) as double)"
            elif f.tag == "rate":
                value = f"cast({c} as double)"
            elif f.tag == "date":
                value = f"date_trunc('day', cast({c} as timestamp))"
            elif f.tag in ("key", "id", "code"):
                value = f"case when trim(cast({c} as varchar)) not in ('', 'nan', 'None') then trim(cast({c} as varchar)) end"
            else:
                value = f"trim(cast({c} as varchar))"
            out.append(f"{value} as {f.name}")
    return f"select {', '.join(out)} from ({ORACLE[EXTRACTS[dataset]]})"


for _dataset in EXTRACTS:
    ORACLE[f"conformed_{_dataset.lower()}"] = _conformed(_dataset)

ORACLE["variance_status_by_table"] = ORACLE["variance_status"]
ORACLE["rule_bridges_by_table"] = ORACLE["rule_bridges"]
sql("conform_preset_report", ["ops_usage"], f"""select 'voucher_id' as name, (count(*) - count(voucher_id))::bigint as n from ops_usage union all select 'amount_used', 0 from ops_usage group by 1
union all select 'usage_date', count(*) - count(usage_date) from ops_usage union all select 'order_id', null union all select 'status', null union all select 'rows', count(*) from ops_usage""")
sql("ledger_of_periods", ["gl_entries"], f"""select company_code, posting_date, entry_no, cast(amount as double) as amount from gl_entries
where company_code in {COMPANIES} and posting_date >= timestamp '1995-01-01' and posting_date < timestamp '1997-01-01'""")
sql("timing_bucketed", ["vouchers", "ops_usage"], """select id, cast(total_amount_used as double) as total_amount_used, cast(coalesce(used, 0) as double) as ops_amount_used
from vouchers left join (select voucher_id, sum(coalesce(try_cast(replace(amount_used, ',', '') as decimal(18,2)), 0)) as used from ops_usage group by voucher_id) on id = voucher_id""")
sql("changed_ledger_rows", ["gl_entries"], """select entry_no, 'added' as change from gl_entries where entry_no % 997 = 3
union all select entry_no, 'changed' from gl_entries where entry_no % 991 = 5 and entry_no % 997 <> 3 and amount is not null
union all select -entry_no, 'lost' from gl_entries where entry_no % 983 = 7""")
sql("distinct_by_bitmap", ["gl_entries"], """select company_code, count(distinct document_no) as unique_document_no, count(distinct voucher_no) as unique_voucher_no, count(distinct user_id) as unique_user_id,
  count(distinct gl_account) as unique_gl_account from gl_entries group by company_code""")
sql("targets_kept_up", ["vouchers"], """select country_code, 'Issuance' as category, business_use as voucher_type, cast(sum(remaining_amount) as double) as amount, count(remaining_amount) as valued, count(*) as lines
from vouchers where cast(id as bigint) % 13 <> 0 group by all""")
sql(
    "csv_round_trip", ["gl_entries"],
    r"""select cast(entry_no as varchar) as entry_no, case entry_no % 8 when 0 then description || chr(10) || 'second line' when 1 then 'say "' || description || '"' || chr(13) || chr(10) || ',end' || chr(10)
      when 2 then '' when 3 then null when 4 then '  ' || description || ', ;\ ' else description end as note, document_no, 'shared file' as place from gl_entries""",
)
sql(
    "csv_short_rows", ["gl_entries"],
    "select cast(entry_no as varchar) as entry_no, case when entry_no % 3 <> 0 then document_no end as document_no, cast(null as varchar) as note, entry_no % 3 = 2 as bad from gl_entries",
)
sql(
    "csv_conformed", ["ops_usage"],
    """select case when trim(voucher_id) not in ('', 'nan', 'None') then trim(voucher_id) end as voucher_id, cast(try_cast(replace(amount_used, ',', '') as decimal(18,2)) as double) as amount_used,
      'kept' || chr(10) || 'as it is' as note from ops_usage""",
)
sql(
    "run_audit_row", ["company"],
    "select 'company' as dataset, count(*) as data_rows, 'select * from company' as query_text, 'account=18412,cutoff=1998-09-30' as params, 'SUCCESS' as validation_status from company",
)

# --- totals, sorts and limits ---------------------------------------------------------------

COMPONENTS = f"""actual as (select sum(balance_at_date) as actuals from gl_balances where closing_date = date '1998-09-30' and group_account_no = '18412'),
prepaid as ({ORACLE['prepayments'][ORACLE['prepayments'].index('select company_code, is_prepayment'):]}),
comp as (select 'IPE_08' as component, sum(remaining_amount)::decimal(38,2) as total from vouchers
 union all select 'IPE_10', sum(paid_price::decimal(18,2)) from prepaid union all select 'IPE_31', sum(amount) from collections)"""
TOTALS = f"""sums as (select (select actuals from actual) as a, (select sum(total) from comp) as t)"""
CLOSE_VIEWS = list(dict.fromkeys(["gl_balances", "order_items", "vouchers", *COLLECTION_VIEWS]))
sql("component_totals", CLOSE_VIEWS, f"select component, {dbl('total')} from comp", COLLECTION, COMPONENTS)
sql(
    "reconciliation_totals", CLOSE_VIEWS,
    """select cast(a as double) as actuals, cast(t as double) as target_values, cast(a - t as double) as variance, cast(abs(a - t) as double) as abs_variance, 1000.0::double as threshold,
case when abs(a - t) < 1000 then 'RECONCILED' else 'VARIANCE_DETECTED' end as status, abs(a - t) < 1000 as is_reconciled from sums""", COLLECTION, COMPONENTS, TOTALS,
)
sql(
    "catalog_status", CLOSE_VIEWS,
    """select cast(a as double) as actuals, cast(t as double) as target_values, cast(a - t as double) as variance, cast(abs(a - t) as double) as abs_variance, 10.0::double as threshold,
case when abs(a - t) < 10 then 'RECONCILED' else 'VARIANCE_DETECTED' end as status, abs(a - t) < 10 as is_reconciled, 1::bigint as threshold_contract_version,
'usage refund rule' as threshold_rule_description from sums""", COLLECTION, COMPONENTS, TOTALS,
)
sql("top_lines", ["gl_entries"], f"select {dbl('amount')}, entry_no, document_no, posting_date from gl_entries order by gl_entries.amount, entry_no, posting_date limit 100")
sql("last_lines", ["gl_entries"], f"select {dbl('amount')}, entry_no, document_no, posting_date from gl_entries order by gl_entries.amount desc, entry_no desc, posting_date desc limit 100")
sql("report_size", ["gl_entries"], "select count(*) as total_rows, count(*) > 1000 as truncated from gl_entries")
sql("named_parameters", ["gl_entries"], f"select company_code, cast(sum(amount) as double) as amount from gl_entries where posting_date <= {CUT} group by company_code")
