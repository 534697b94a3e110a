"""Ledger-shaped views over the sample star-schema tables.

Each view is one SQL text that runs unchanged on Spark and on the SQL engine used to check
results; only the joins of `line_base` stand in another order on Spark. `{name}` stands for a base
table or another view. Money is decimal, so sums are exact.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import DataFrame, SparkSession

from closewright.sources.staging import staged

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

VIEWS: dict[str, str] = {}

VIEWS["company"] = """
select n_nationkey as company_key,
 case n_nationkey when 1 then 'JM_C01' when 2 then 'JD_C02'
  else concat('EC_C', lpad(cast(n_nationkey as string), 2, '0')) end as company_code,
 concat('C', lpad(cast(n_nationkey as string), 2, '0')) as country_code,
 n_name as company_name,
 case when n_nationkey % 2 = 0 then 'Opco' else 'Central' end as opco_central,
 case when n_nationkey % 10 = 9 then 0 else 1 end as is_active,
 case when n_nationkey % 8 = 7 then 0 else 1 end as in_scope
from {nation}
"""

VIEWS["fx_rates"] = """
select company_code,
 case when company_key % 6 = 5 then cast(null as double)
  when company_key % 11 = 10 then cast(0.0 as double)
  else cast(company_key * 7 + 2 as double) end as fx_rate
from {company} where company_key <> 3
"""

# One row per order line with the order, customer and company it belongs to.
VIEWS["line_base"] = """
select l.*, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
 cu.c_name, cu.c_mktsegment, c.company_key, c.company_code, c.country_code
from {lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey
join {customer} cu on o.o_custkey = cu.c_custkey
join {company} c on cu.c_nationkey = c.company_key
"""

VIEWS["order_base"] = """
select o.*, cu.c_name, cu.c_mktsegment, c.company_key, c.company_code, c.country_code
from {orders} o join {customer} cu on o.o_custkey = cu.c_custkey
join {company} c on cu.c_nationkey = c.company_key
"""

VIEWS["gl_entries"] = """
select l_orderkey * 10 + l_linenumber as entry_no, company_code, country_code,
 case when l_partkey % 5 = 0 then '15010' else '18412' end as gl_account,
 cast(case when l_returnflag = 'R' then -l_extendedprice else l_extendedprice end as decimal(18,2)) as amount,
 case l_suppkey % 3 when 0 then 'CORP/SVC.BATCH' when 1 then concat('corp', chr(92), 'svc.batch ')
  else concat('USER/', cast(l_suppkey as string)) end as user_id,
 case l_partkey % 13 when 0 then 'Refund voucher' when 1 then 'rf_123' when 2 then 'Commercial gesture'
  when 3 then 'PYT_PF 9' when 4 then 'EXPR_APLGY' when 5 then 'EXPR_JFORCE' when 6 then 'EXPR_STR CRDT'
  when 7 then 'EXPR misc' when 8 then 'Manual RND' when 9 then 'Voucher Accrual'
  when 10 then 'ITEMPRICECREDIT' when 11 then null else 'other BM' end as description,
 case when l_partkey % 2 = 0 then 'gtb payout' end as comment,
 case when l_quantity > 45 then 'Bank Account' else 'G/L Account' end as bal_account_type,
 case when l_discount > 0.08 then 'Credit Memo' else 'Invoice' end as document_type,
 case when l_linenumber = 1 then concat(country_code, '-', cast(l_orderkey as string))
  else concat('DOC-', cast(l_orderkey as string)) end as document_no,
 case when l_linenumber % 2 = 0 then cast(l_orderkey * 3 as string) end as voucher_no,
 l_shipdate as posting_date,
 concat('BL0', cast(l_suppkey % 4 as string)) as busline_code
from {line_base}
"""

VIEWS["vouchers"] = """
select cast(o_orderkey * 3 as string) as id, company_code, country_code,
 case o_orderkey % 7 when 0 then 'refund' when 1 then 'store_credit' when 2 then 'apology_v2' when 3 then 'jforce'
  when 4 then 'Jpay store_credit' when 5 then 'marketing' end as business_use,
 case when o_orderstatus = 'O' then 1 else 0 end as is_active,
 case when o_orderpriority = '5-LOW' then 'expired' else 'valid' end as is_valid,
 o_orderdate as created_at, o_orderdate + interval '30' day as inactive_at,
 case when o_orderkey % 4 = 0 then concat('DOC-', cast(o_orderkey as string)) end as transaction_no,
 cast(o_totalprice as decimal(18,2)) as remaining_amount, cast(o_totalprice as decimal(18,2)) as total_amount_used
from {order_base}
"""

VIEWS["voucher_usage"] = """
select case when l_linenumber % 3 <> 0 then concat(' ', cast(l_orderkey * 3 as string)) end as id,
 concat('DOC-', cast(l_orderkey as string)) as transaction_no,
 case l_orderkey % 4 when 0 then 'refund' when 1 then 'store credit' when 2 then 'CXP' end as business_use,
 cast(l_extendedprice as decimal(18,2)) as amount, l_shipdate as delivered_at
from {lineitem}
"""

VIEWS["ops_usage"] = """
select case when l_partkey % 40 = 0 then cast(null as string) else cast(l_orderkey * 3 as string) end as voucher_id,
 case when l_partkey % 50 = 1 then 'n/a' when l_partkey % 50 = 2 then ''
  when l_partkey % 2 = 0 then concat('1,', lpad(cast(l_partkey % 1000 as string), 3, '0'), '.50')
  else cast(cast(l_extendedprice as decimal(18,2)) as string) end as amount_used,
 l_shipdate as usage_date
from {lineitem} where l_linestatus = 'F'
"""

VIEWS["cle"] = """
select l_orderkey * 10 + l_linenumber as entry_no, cast(o_custkey as string) as customer_id, c_name as customer_name,
 case when l_partkey % 97 = 0 then null else concat('BL0', cast(l_suppkey % 4 as string)) end as business_line_code,
 case when o_custkey % 3 = 0 then c_mktsegment else o_orderpriority end as posting_group,
 company_code, country_code,
 cast(case when l_returnflag = 'R' then -l_extendedprice else l_extendedprice end as decimal(18,2)) as amount_lcy,
 concat('INV-', cast(l_orderkey as string)) as document_no,
 o_orderdate as posting_date, l_shipdate as due_date
from {line_base}
"""

VIEWS["cle_detail"] = """
select company_code, customer_id, entry_no, posting_date, amount_lcy as amount from {cle}
union all
select company_code, customer_id, entry_no, posting_date, -amount_lcy as amount from {cle}
where entry_no % 4 = 0 or customer_id like '%7'
"""

VIEWS["customers"] = """
select cast(cu.c_custkey as string) as customer_no, c.company_code, cu.c_name as name,
 concat('BL0', cast(cu.c_custkey % 4 as string)) as busline_code,
 case when cu.c_custkey % 5 = 0 then 1 else 0 end as auto_integrated,
 cu.c_mktsegment as posting_group, case when cu.c_custkey % 2 = 0 then 'B2C' else 'B2B' end as stream
from {customer} cu join {company} c on cu.c_nationkey = c.company_key where cu.c_custkey % 50 <> 49
"""

VIEWS["buslines"] = """
select distinct c.company_code, concat('BL0', cast(s.s_suppkey % 4 as string)) as busline_code,
 concat('Vertical ', cast(s.s_suppkey % 4 as string)) as vertical_1,
 concat('Line ', cast(s.s_suppkey % 4 as string)) as vertical_2,
 case when s.s_suppkey % 4 = 3 then null else concat('Unit ', cast(s.s_suppkey % 4 as string)) end as vertical_3
from {supplier} s join {company} c on s.s_nationkey = c.company_key
"""

VIEWS["gl_detail"] = """
select company_code, gl_account, entry_no, posting_date, amount from {gl_entries}
union all
select company_code, gl_account, entry_no, posting_date, -amount as amount from {gl_entries} where entry_no % 4 = 0
"""

VIEWS["chart_of_accounts"] = """
select company_code, '15010' as account_no, 'G150' as group_account_no, 'Vendor receivables' as group_account_name
from {company} where company_key % 7 <> 6
union all
select company_code, '18412' as account_no, 'G184' as group_account_no, 'Voucher liabilities' as group_account_name
from {company}
"""

VIEWS["ifrs_map"] = """
select 'G184' as level_4_code, 'Liabilities' as level_1_name, 'Current' as level_2_name, 'Accruals' as level_3_name
union all
select 'G150' as level_4_code, 'Assets' as level_1_name, 'Current' as level_2_name, 'Receivables' as level_3_name
"""

VIEWS["gl_balances"] = """
select company_code, country_code, gl_account as group_account_no, last_day(cast(posting_date as date)) as closing_date,
 busline_code, sum(amount) as balance_at_date
from {gl_entries}
group by company_code, country_code, gl_account, last_day(cast(posting_date as date)), busline_code
"""

VIEWS["fx_company"] = """
select company_code, country_code, company_name, opco_central, is_active from {company}
union all
select concat(company_code, '_USD') as company_code, country_code, company_name, opco_central, is_active
from {company} where company_key in (6, 7)
"""

VIEWS["country"] = """
select country_code, case company_key when 7 then 'Germany' when 24 then 'United States of America'
  else company_name end as country_name
from {company} where company_key <> 11
"""

VIEWS["fx_monthly"] = """
select c.country_code, case when o.m = 8 then 'Average' else 'Closing' end as rate_type,
 o.y as rate_year, o.m as rate_month, cast(c.company_key * 3 + o.m as double) as rate,
 case when c.company_key = 12 then 'EUR' else 'USD' end as base_currency,
 case when c.company_key = 5 then 'United arab emirates (the)' else c.company_name end as country
from {company} c join
 (select cu.c_nationkey as k, cast(year(o.o_orderdate) as bigint) as y, cast(month(o.o_orderdate) as bigint) as m
  from {orders} o join {customer} cu on o.o_custkey = cu.c_custkey
  group by cu.c_nationkey, cast(year(o.o_orderdate) as bigint), cast(month(o.o_orderdate) as bigint)) o
 on o.k = c.company_key
"""

VIEWS["fx_spot"] = """
select concat('Q', lpad(cast(company_key as string), 2, '0')) as currency_code, o_orderdate as starting_date,
 case when company_key = 4 then cast(0 as double) else cast(company_key + max(o_orderkey) % 100 as double) end as rate_amount
from {order_base} group by company_key, o_orderdate
"""

VIEWS["voucher_closing"] = """
select cast(o_orderkey * 3 as string) as id, company_code,
 concat(case o_orderkey % 5 when 0 then 'GC' when 1 then 'JP' else 'VX' end, cast(o_orderkey as string)) as code,
 case o_orderkey % 7 when 0 then 'refund' when 1 then 'store_credit' when 2 then 'apology_v2' when 3 then 'jforce'
  when 4 then 'jpay_store_credit' when 5 then 'Jpay store_credit' end as business_use,
 concat('voucher ', cast(o_orderkey as string)) as description,
 case when o_orderkey % 11 = 0 then null when o_orderstatus = 'O' then 1 else 0 end as is_active,
 case when o_orderkey % 2 = 0 then 'coupon' else 'credit' end as type,
 case when o_orderkey % 3 = 0 then 'closed' else 'open' end as template_status,
 case when o_orderkey % 17 = 0 then null else cast(o_totalprice as decimal(18,2)) end as discount_amount,
 o_orderdate as from_date,
 case when o_orderkey % 13 = 0 then null when o_orderkey % 2 = 0 then o_orderdate + interval '60' day
  else o_orderdate + interval '400' day end as to_date,
 o_orderdate as created_at, o_orderdate + interval '15' day as updated_at,
 case when o_orderkey % 3 = 1 then o_orderdate + interval '9' day end as last_time_used,
 case when o_orderkey % 4 = 0 then null else o_orderdate + interval '90' day end as voucher_inactive_date,
 case when o_orderkey % 6 = 0 then null else o_orderdate + interval '80' day end as template_inactive_date,
 cast(o_custkey as string) as fk_customer,
 cast(o_orderkey % 40 as decimal(18,2)) as used_discount_amount, cast(o_orderkey % 3 as bigint) as times_used,
 cast(o_totalprice as decimal(18,2)) as remaining_amount
from {order_base}
"""

VIEWS["voucher_templates"] = """
select cast(o_orderkey * 3 as string) as id, company_code, concat('T', cast(o_orderkey % 20 as string)) as template_id,
 concat('Template ', cast(o_orderkey % 20 as string)) as template_name
from {order_base} where o_orderkey % 5 <> 4
"""

VIEWS["order_items"] = """
select company_code, cast(l_orderkey * 10 + l_linenumber as string) as order_item_id,
 cast(l_orderkey as string) as order_nr, cast(l_linenumber as bigint) as item_no, cast(o_custkey as string) as customer_id,
 case l_partkey % 6 when 0 then 'closed' when 1 then 'delivered' when 2 then 'shipped' when 3 then 'cancelled'
  when 4 then null else 'exported' end as current_status,
 case when l_suppkey % 2 = 0 then 1 else 0 end as is_marketplace,
 case when o_orderpriority in ('1-URGENT', '2-HIGH') then 1 else 0 end as is_prepayment,
 case when l_suppkey % 5 = 0 then 1 else 0 end as is_global,
 case l_linenumber % 4 when 0 then 'NoPayment' when 1 then 'CashOnDelivery' when 2 then 'Card' end as payment_method,
 case l_partkey % 9 when 0 then 'Digital Content' when 1 then 'Gift Card' when 2 then null else 'Parcel' end as delivery_type,
 o_orderdate as order_creation_date, o_orderdate + interval '1' day as finance_verified_date,
 l_shipdate as shipped_date,
 case when l_linestatus = 'F' then l_shipdate end as delivered_date,
 case when l_linestatus = 'F' then l_shipdate + interval '2' day end as package_delivery_date,
 case when l_returnflag = 'R' then l_shipdate + interval '20' day end as refund_date,
 case when l_returnflag in ('R', 'A') and l_partkey % 3 <> 0 then l_shipdate + interval '35' day end as return_date,
 case when l_partkey % 6 = 3 then l_shipdate + interval '5' day end as cancellation_date,
 case when l_partkey % 4 <> 3 then concat(case l_orderkey % 5 when 0 then 'GC' when 1 then 'JP' else 'VX' end,
  cast(l_orderkey as string)) end as voucher_code,
 case l_partkey % 3 when 0 then 'reusablecredit' when 1 then 'coupon' end as voucher_type,
 concat('PK', cast(l_orderkey as string), '-', cast(l_linenumber % 2 as string)) as package_number,
 c_mktsegment as customer_type_code,
 cast(l_extendedprice as decimal(18,2)) as unit_price,
 case when l_partkey % 7 = 0 then null else cast(l_partkey % 50 as decimal(18,2)) end as coupon_value,
 cast(l_suppkey % 9 as decimal(18,2)) as cart_rule_discount,
 cast(l_extendedprice as decimal(18,2)) as paid_price,
 case when l_partkey % 10 = 0 then null else cast(l_quantity as decimal(18,2)) end as base_shipping,
 cast(l_suppkey % 4 as decimal(18,2)) as shipping_rule_discount,
 case when l_partkey % 5 = 0 then null else cast(l_partkey % 8 as decimal(18,2)) end as shipping_voucher_discount,
 cast(l_partkey % 6 as decimal(18,2)) as shipping_discount,
 cast(l_linenumber as decimal(18,2)) as customs_fee, cast(l_linenumber % 2 as decimal(18,2)) as customs_rule_discount,
 case when l_suppkey % 3 = 0 then cast(l_suppkey % 7 as decimal(18,2)) end as freight_fee,
 cast(l_suppkey % 2 as decimal(18,2)) as delivery_rule_discount,
 case when l_partkey % 8 = 0 then null else cast(l_extendedprice as decimal(18,2)) end as price_after_discount,
 cast(l_extendedprice as decimal(18,2)) as amount_paid
from {line_base}
"""

VIEWS["customer_types"] = """
select distinct c_mktsegment as customer_type_code,
 case when c_mktsegment in ('BUILDING', 'MACHINERY') then 'B2B' else 'B2C' end as customer_type_l1
from {customer} where c_mktsegment <> 'FURNITURE'
"""

VIEWS["package_cash"] = """
select company_code, package_number as package_nr, sum(unit_price) as amount_expected,
 sum(coalesce(coupon_value, cast(0 as decimal(18,2)))) as amount_received, max(shipped_date) as delivery_date,
 min(current_status) as package_status,
 case when min(item_no) % 2 = 0 then max(shipped_date) + interval '50' day end as troubleshoot_date
from {order_items} where cast(order_nr as bigint) % 5 <> 0 group by company_code, package_number
"""

VIEWS["refund_no_return"] = """
select company_code, order_item_id, min(case when is_marketplace = 1 then 'refund_only' else 'goodwill' end) as oms_type
from {order_items} where refund_date is not null and is_global = 1 group by company_code, order_item_id
"""

VIEWS["seller_transactions"] = """
select c.company_code, l.l_orderkey * 10 + l.l_linenumber as transaction_id, l.l_shipdate as created_date,
 concat('TX-', cast(l.l_orderkey as string), '-', cast(l.l_linenumber as string)) as transaction_no,
 case l.l_partkey % 4 when 0 then 'Commission' when 1 then 'Shipping Fee' when 2 then 'Item Price' else 'Unmapped' end as asg_name,
 case when l.l_partkey % 2 = 0 then 'fee' else 'item' end as nav_type,
 cast(l.l_extendedprice as decimal(18,2)) as transaction_amount,
 case when l.l_suppkey % 6 = 0 then 1 else 0 end as created_manually,
 cast(l.l_suppkey as string) as vendor_id, s.s_name as vendor_name, cast(l.l_orderkey as string) as order_nr,
 case when l.l_orderkey % 3 <> 0
  then l.l_suppkey * 10000 + cast(year(l.l_shipdate) - 1990 as bigint) * 100 + cast(month(l.l_shipdate) as bigint) end as statement_id
from {lineitem} l join {supplier} s on l.l_suppkey = s.s_suppkey join {company} c on s.s_nationkey = c.company_key
"""

VIEWS["seller_statements"] = """
select company_code, statement_id, concat('ST-', cast(statement_id as string)) as statement_no,
 min(created_date) as start_date,
 max(created_date) + case when statement_id % 2 = 0 then interval '20' day else interval '0' day end as end_date,
 case when statement_id % 3 = 0 then 1 else 0 end as paid
from {seller_transactions} where statement_id is not null group by company_code, statement_id
"""

VIEWS["vendors"] = """
select c.company_code, cast(s.s_suppkey as string) as vendor_id, case when s.s_suppkey % 5 = 0 then 1 else 0 end as is_global
from {supplier} s join {company} c on s.s_nationkey = c.company_key where s.s_suppkey % 10 <> 7
"""

VIEWS["asg_levels"] = """
select distinct company_code, asg_name, case asg_name when 'Item Price' then 'Payables' else 'Revenues' end as level_1,
 concat(asg_name, ' group') as level_2, nav_type as level_3
from {seller_transactions} where asg_name <> 'Unmapped'
"""

VIEWS["seller_transaction_types"] = """
select company_code, transaction_id, min(concat(asg_name, ' type')) as transaction_type_name
from {seller_transactions} where transaction_id % 10 <> 3 group by company_code, transaction_id
"""

VIEWS["cash_transactions"] = """
select company_code, l_shipdate as created_date,
 case l_partkey % 9 when 0 then 'Transfer to' when 1 then 'Third Party Collection' when 2 then 'Payment - Rev'
  when 3 then 'Payment' when 4 then 'Payment Charges' when 5 then 'Reallocation From' when 6 then 'Collection'
  when 7 then 'Collection Adjustment (over)' else 'Cash Pickup' end as transaction_type,
 concat('PM', cast(l_orderkey as string)) as related_entity,
 concat('CP', cast(l_suppkey % 20 as string)) as collection_partner,
 case when l_discount > 0.09 then cast(0 as decimal(18,2)) else cast(l_extendedprice as decimal(18,2)) end as amount,
 case when l_linenumber % 3 = 0 then null else concat('PL', cast(l_orderkey as string)) end as transaction_list_nr,
 case when l_linenumber % 3 = 0 then null else l_shipdate + interval '25' day end as transaction_list_date
from {line_base}
"""

VIEWS["cash_deposits"] = """
select company_code, concat('PM', cast(o_orderkey as string)) as payment_no,
 case when o_orderkey % 2 = 0 then 'Transfer' else 'Payment' end as deposit_type,
 o_orderdate + interval '12' day as payment_date,
 case when o_orderkey % 6 = 0 then null else o_orderdate + interval '14' day end as payment_reversal_date,
 concat('CP', cast(o_orderkey % 20 as string)) as collection_partner,
 cast(o_totalprice as decimal(18,2)) as payment_amount,
 case when o_orderkey % 3 = 0 then null else cast(o_orderkey % 30 as decimal(18,2)) end as charges_amount,
 case o_orderkey % 4 when 0 then 'inProgress' when 1 then 'closed' when 2 then 'waitingConfirmation' else 'rejected' end as payment_status
from {order_base}
"""

VIEWS["packlist_payments"] = """
select company_code, concat('CP', cast(l_orderkey % 20 as string)) as collection_partner,
 concat('PL', cast(l_orderkey as string)) as packlist_no, cast(o_totalprice as decimal(18,2)) as amount_received,
 o_orderdate as packlist_created_date,
 case l_orderkey % 5 when 0 then 'waitingApproval' when 1 then 'waitingConfirmation' when 2 then 'inProgress' else 'closed' end as packlist_status,
 concat('PM', cast(l_orderkey as string)) as payment_no, l_shipdate as payment_date,
 case l_partkey % 3 when 0 then 'inProgress' when 1 then 'closed' else 'rejected' end as payment_status,
 case when l_partkey % 4 = 0 then null else cast(l_extendedprice as decimal(18,2)) end as payment_reconciled_amount,
 case when l_partkey % 6 = 0 then null else cast(l_partkey % 30 as decimal(18,2)) end as charges_reconciled_amount
from {line_base} where l_linenumber <= 3
"""

VIEWS["packlist_packages"] = """
select company_code, concat('PL', cast(o_orderkey as string)) as packlist_no,
 case o_orderkey % 5 when 0 then 'waitingApproval' when 1 then 'waitingConfirmation' when 2 then 'inProgress' else 'closed' end as packlist_status
from {order_base} where o_orderkey % 3 <> 2
"""

VIEWS["reallocations"] = """
select company_code, l_shipdate as original_transaction_date, l_shipdate + interval '40' day as reallocated_transaction_date,
 concat('CP', cast(l_suppkey % 20 as string)) as collection_partner_from, 'Reallocation' as transaction_type,
 concat('PM', cast(l_orderkey as string)) as related_entity, cast(l_extendedprice as decimal(18,2)) as amount
from {line_base} where l_partkey % 11 = 0
"""

VIEWS["collection_adjustments"] = """
select company_code, case when o_orderkey % 2 = 0 then concat('PL', cast(o_orderkey as string))
  else concat('PM', cast(o_orderkey as string)) end as entity_no,
 case when o_orderkey % 2 = 0 then 'packlist' else 'payment' end as entity_type,
 case when o_orderkey % 3 = 0 then 1 else 0 end as force_closed,
 case when o_orderkey % 7 = 0 then null else o_orderdate + interval '45' day end as close_date
from {order_base} where o_orderkey % 4 <> 1
"""

VIEWS["hubs"] = """
select distinct company_code, collection_partner as node, concat('SP-', collection_partner) as service_provider
from {cash_transactions} where collection_partner <> 'CP3'
"""

VIEWS["collection_partners"] = """
select distinct company_code, collection_partner as name,
 case when collection_partner like '%1' then 'bank' else '3PL' end as partner_type,
 concat('ERP', collection_partner) as erp_name
from {cash_transactions} where collection_partner <> 'CP5'
"""

VIEWS["bank_accounts"] = """
select distinct company_code, case when name = 'CP7' then '' else erp_name end as provider_no,
 case when name like '%2' then 'PGX' else 'PGA' end as posting_group_code
from {collection_partners}
"""

VIEWS["bank_posting_groups"] = """
select company_code, 'PGA' as code, '10010' as gl_bank_account_no from {company}
union all
select company_code, 'PGX' as code, case when company_key % 2 = 0 then '10058' else '10020' end as gl_bank_account_no from {company}
"""


def _references(text: str) -> list[str]:
    return list(dict.fromkeys(name for _, name, _, _ in string.Formatter().parse(text) if name))


class SampleTables:
    """Lazy lookup of base tables and views as DataFrames: `SampleTables(spark, folder)["gl_entries"]`."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder
        self._frames: dict[str, DataFrame] = {}

    def _line_base(self) -> DataFrame:
        """The rows of the view of that name, with the customer joined to the order before the order to its lines.

        As the text stands, every line passes a second shuffle, by customer, once customers are too many to broadcast.
        Here only the orders do; lines are moved once.
        """
        lines, orders = self["lineitem"], self["order_base"]
        of_order = ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "c_name", "c_mktsegment", "company_key", "company_code", "country_code")
        return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(*[lines[c] for c in lines.columns], *[orders[c] for c in of_order])

    def with_lines_staged(self) -> SampleTables:
        """The same tables with `line_base` written to the shared folder, for queries in which many views read it.

        Each of them would join the lines to their orders anew, and so move every line once more. Only columns that some
        view names are written.
        """
        tables = SampleTables(self._spark, self._folder)
        lines = self["line_base"]
        readers = " ".join(text for text in VIEWS.values() if "{line_base}" in text)
        tables._frames["line_base"] = staged(lines.select(*[c for c in lines.columns if re.search(rf"\b{c}\b", readers)]), "line_base")
        return tables

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name == "line_base":
                self._frames[name] = self._line_base()
            elif name in VIEWS:
                text = VIEWS[name]
                self._frames[name] = self._spark.sql(text, **{ref: self[ref] for ref in _references(text)})
            else:
                self._frames[name] = self._spark.read.parquet(f"{self._folder}/{name}.parquet")
        return self._frames[name]


def view_ctes(names: list[str]) -> str:
    """The named views and all they need, as a list of common table expressions in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in VIEWS and name not in ordered:
            for ref in _references(VIEWS[name]):
                visit(ref)
            ordered.append(name)

    for name in names:
        visit(name)
    return ",\n".join(
        f"{name} as ({VIEWS[name].format(**{r: r for r in _references(VIEWS[name])}).strip()})" for name in ordered
    )
