"""Input frames of the library as projections of the driver's tables.

Each view is one SQL text that Spark and DuckDB read the same way; ``{name}`` refers to a driver table or
another view. Object ids carry a prefix, so a contract id never equals a tranche id.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from snapbook.plans.register_types import TARGET_TYPES
from snapbook.session import bytes_of, folder_exists, new_folder

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

ORDER_DAY = "1998-06-30"
EVENT_DAY = "2024-01-20"


def _values(rows: Iterable[tuple], columns: str) -> str:
    def lit(v):
        if v is None:
            return "null"
        return f"'{v}'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return f"select * from (values {body}) as t({columns})"


def _register_types() -> str:
    """Names for the fixed register types plus reporting parents, limits and portfolio types."""
    kinds = {t: s for t, s, _, _ in TARGET_TYPES}
    rows = []
    for t in sorted(kinds):
        brief = {1: "Лим", 2: "НеиспЛим", 83: "БГарант", 84: "РезервБГарант"}.get(t, f"Рег{t}")
        if t >= 201 and t < 250:
            brief = f"МСФО9_Корр{t}"
        rows.append((t, f"Регистр {t}", brief, kinds[t], 1))
    for t in (200, 202, 204, 210, 230, 232):
        rows.append((t, f"Регистр {t}", f"МСФО9_Корр{t}", 0, 1))
    rows.append((38, "Регистр 38", "ПрПроц", 0, 1))
    for t in (300, 301, 302, 303):
        rows.append((t, f"Портфельный регистр {t}", f"Портф{t}", 2, 0 if t == 303 else 1))
    return _values(rows, "register_type_id, name, brief, sub_type, is_operational")


CONTRACT_REGISTERS = [5, 1, 2, 113, 6, 27, 200, 206, 114, 67, 38, 222]
TRANCHE_REGISTERS = [7, 8, 28, 23, 24, 33, 201, 203, 164, 165, 5, 207]
ACCOUNT_TYPES = [10001, 10005, 10018, 10019, 10050, 10053, 10043, 10133, 10135, 10143, 229, 228, 246, 10120, 10078, 10060, 238, 243]
CONTRACT_ACCOUNTS = [10001, 10005, 10050, 10019, 10143, 10053, 10135]
TRANCHE_ACCOUNTS = [10001, 10005, 10043, 10133, 10078, 228, 229]
PORTFOLIO_ACCOUNTS = [10018, 10133, 246, 229, 238, 243, 10120]


def _pick(expr: str, options: list[int]) -> str:
    cases = " ".join(f"when {i} then {v}" for i, v in enumerate(options[:-1]))
    return f"cast(case cast({expr} % {len(options)} as int) {cases} else {options[-1]} end as int)"


VIEWS: dict[str, str] = {
    # --- dictionaries -------------------------------------------------------------------------------
    "branch": "select r_regionkey as branch_id, case when r_regionkey = 4 then null else cast(10 + r_regionkey as string) end as inner_code from {region}",
    "division": "select n_nationkey as division_id, n_regionkey as branch_id, cast(100 + n_nationkey as int) as code from {nation}",
    "customer_dim": """
        select 'u' || cast(c_custkey as string) as customer_id,
               case when c_custkey % 3 = 0 then c_name || '  ' when c_custkey % 31 = 0 then null else c_name end as name,
               lpad(cast(c_custkey as string), 10, '7') as inn,
               case when c_custkey % 4 = 0 then null else 'lp' || cast(c_custkey as string) end as legal_person_id,
               cast(c_nationkey as int) as division_id
        from {customer}""",
    "legal_person": "select 'lp' || cast(c_custkey as string) as legal_person_id, cast(1 + c_custkey % 4 as int) as criterion from {customer} where c_custkey % 2 = 1",
    "loan_purpose": "select 'pp' || cast(n_nationkey as string) as purpose_id, n_name as name from {nation} where n_nationkey < 8",
    "product_type": """
        select 'pt' || cast(n_nationkey as string) as product_type_id,
               case when n_nationkey % 5 = 4 then null else 'pg' || cast(n_nationkey % 6 as string) end as program_id,
               n_name as name, 'B' || cast(n_nationkey as string) as brief
        from {nation}""",
    "loan_program": "select 'pg' || cast(r_regionkey as string) as program_id, 'pd' || cast(r_regionkey % 3 as string) as product_id from {region}",
    "product": """
        select 'pd' || cast(r_regionkey as string) as product_id,
               case when r_regionkey = 4 then 'Потребительский кредит' else r_name end as name,
               case when r_regionkey % 2 = 0 then 1 else 0 end as active
        from {region}""",
    "currency": _values([("810", "643"), ("840", "840")], "code, international_code"),
    "config9": "select 'InternalBankCode' as name, 9 as integer_value union all select r_name, r_regionkey from {region}",
    "config12": "select 'InternalBankCode' as name, 12 as integer_value union all select r_name, r_regionkey from {region}",
    "risk_group": "select 'rg' || cast(r_regionkey as string) as risk_group_id, cast(1 + r_regionkey as int) as code, cast(0.01 + r_regionkey * 0.1 as decimal(18,6)) as max_ratio from {region}",
    "register_type": _register_types(),
    "register_type_link": _values(
        [(5, 7), (6, 8), (27, 28), (59, 69), (71, 74), (200, 201), (202, 203), (206, 207), (67, 5), (67, 6), (109, 164), (76, 165)],
        "parent_id, child_id"),
    "account_register_link": _values(
        [(7, 10001), (8, 10001), (8, 10005), (5, 10005), (28, 10053), (23, 10001), (24, 10053), (33, 10050), (1, 10001), (2, 10001),
         (2, 10050), (113, 10050), (113, 10060), (113, 10001), (114, 10050), (84, 10050), (201, 228), (203, 229), (207, 228),
         (164, 10018), (300, 10018), (300, 229), (301, 246), (301, 10133), (302, 238), (300, 246)],
        "register_type_id, account_type_id"),
    "account_type": _values(
        [(t, f"Счет {t}", 1 + i % 2, "МСФО9_Доход" if t == 246 else ("МСФО9_Расх1" if t == 238 else f"Код{t}")) for i, t in enumerate(ACCOUNT_TYPES)],
        "account_type_id, name, kind, code"),
    # --- contracts and tranches ---------------------------------------------------------------------
    "contract": """
        select 'c' || cast(o_orderkey as string) as contract_id,
               cast(case when o_orderkey % 10 = 9 then 2 else 0 end as int) as kind,
               cast(1 + o_orderkey % 7 as int) as contract_type,
               'pt' || cast(o_orderkey % 26 as string) as product_type_id,
               case when o_orderkey % 5 = 0 then null else 'pp' || cast(o_orderkey % 9 as string) end as purpose_id,
               cast(case when o_orderkey % 6 = 0 then null else o_orderkey % 15 end as int) as schedule_type,
               cast(o_totalprice as decimal(21,2)) as annual_payment,
               case when o_orderkey % 8 = 0 then null else 's' || cast(o_orderkey as string) end as scheme_id,
               cast(o_orderkey % 4 as int) as guarant_type, cast(o_orderkey % 4 as int) as guarant_kind,
               'c' || cast(o_orderkey - 10 as string) as line_contract_id,
               case when o_orderkey % 3 = 0 then null else 'u' || cast(o_custkey as string) end as beneficiary_id,
               cast(o_totalprice as decimal(18,2)) as commission_sum
        from {orders}""",
    "base_contract": """
        select 'c' || cast(o_orderkey as string) as contract_id, 'N' || cast(o_orderkey as string) as number,
               cast(o_orderdate as date) as contract_date,
               case when o_orderkey % 29 = 0 then null else cast(o_orderdate as date) end as start_date,
               cast(o_orderdate as date) + 365 as end_date,
               case when o_orderstatus <> 'F' then null
                    when o_orderkey % 40 = 1 then cast('1998-06-30' as date)
                    else cast(o_orderdate as date) + cast(200 + o_orderkey % 300 as int) end as closed_date,
               cast(case when o_orderstatus = 'F' then 2 when o_orderstatus = 'O' then 1
                    when o_orderkey % 4 = 0 then 0 else 1 end as int) as status,
               'u' || cast(o_custkey as string) as client_id, cast(o_orderkey % 7 as int) as branch_id,
               cast(o_orderkey % 27 as int) as division_id,
               case when o_orderkey % 3 = 0 then null when o_orderkey % 3 = 1 then '810' else '840' end as currency
        from {orders}""",
    "loan_contract": """
        select 'c' || cast(o_orderkey as string) as contract_id, 'Brand#' || cast(1 + o_orderkey % 25 as string) as portfolio_id
        from {orders}""",
    "issue": """
        select 'i' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as issue_id,
               'c' || cast(l_orderkey as string) as contract_id, l_linenumber as issue_number,
               min(cast(l_shipdate as date)) as issue_date,
               case when max(l_returnflag) = 'R' then min(cast(l_shipdate as date)) + 180 else null end as close_date,
               min(cast(l_shipdate as date)) + 365 as plan_repayment_date,
               cast(sum(cast(l_extendedprice as decimal(21,2))) as decimal(21,2)) as issue_sum,
               case when l_orderkey % 6 = 0 then null else 's' || cast(l_orderkey as string) end as scheme_id
        from {lineitem} group by l_orderkey, l_linenumber""",
    "agreement_history": """
        select 'c' || cast(l_orderkey as string) as contract_id,
               case when l_linenumber % 2 = 0 then null
                    else 'i' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) end as issue_id,
               cast(case when l_returnflag = 'N' then 4 else 1 end as int) as change_type,
               cast(l_shipdate as date) as change_date,
               cast(case when l_partkey % 11 = 0 then null else l_quantity end as int) as contract_term,
               cast(case when l_partkey % 13 = 0 then null else l_quantity + 7 end as int) as issue_term
        from {lineitem}""",
    "status_history": """
        select 'c' || cast(l_orderkey as string) as contract_id, cast(l_shipdate as date) as oper_day,
               l_linenumber as date_change, cast(l_linenumber % 3 as int) as status,
               l_partkey * 100000 + l_suppkey * 10 + l_linenumber as seq
        from {lineitem}""",
    "portfolio_history": """
        select 'c' || cast(l_orderkey as string) as contract_id, p_brand as portfolio_id, cast(l_shipdate as date) as date_begin
        from {lineitem} join {part} on l_partkey = p_partkey""",
    "contract_sum": """
        select 'c' || cast(l_orderkey as string) as contract_id, cast(l_shipdate as date) as eff,
               cast(sum(cast(l_extendedprice as decimal(21,2))) as decimal(21,2)) as amount
        from {lineitem} group by l_orderkey, cast(l_shipdate as date)""",
    "overdue_balance": """
        select 'c' || cast(l_orderkey as string) as contract_id,
               case when l_returnflag = 'N' then 'interest' else 'principal' end as part,
               cast(l_shipdate as date) as oper_day,
               cast(case when l_linestatus = 'F' and l_linenumber % 2 = 0 then 0 else l_extendedprice end as decimal(21,2)) as rest_out
        from {lineitem}""",
    "scheme_value": """
        select 's' || cast(l_orderkey as string) as scheme_id, cast(l_shipdate as date) as value_date,
               cast(l_linenumber % 2 as int) as base_rate_id,
               case when l_partkey % 9 = 0 then null else cast(l_tax as decimal(9,4)) end as rate,
               l_partkey * 100000 + l_suppkey * 10 + l_linenumber as seq
        from {lineitem}""",
    "risk_change": """
        select 'k' || cast(l_orderkey as string) || '-' || cast(l_partkey as string) || '-' || cast(l_suppkey as string) || '-'
                   || cast(l_linenumber as string) || '-' || cast(cast(l_shipdate as date) as string) as change_id,
               'rg' || cast(l_linenumber % 6 as string) as risk_group_id,
               'c' || cast(l_orderkey as string) as contract_id,
               'i' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as issue_id,
               p_brand as portfolio_id, cast(l_shipdate as date) as action_date,
               cast(l_discount as decimal(18,6)) as ratio
        from {lineitem} join {part} on l_partkey = p_partkey""",
    # --- guarantees ---------------------------------------------------------------------------------
    "guarantee_event": """
        select 'h' || cast(l_orderkey as string) || '-' || cast(l_partkey as string) || '-' || cast(l_suppkey as string) || '-'
                   || cast(l_linenumber as string) || '-' || cast(cast(l_shipdate as date) as string) as history_id,
               l_shipdate as create_date, cast(6 + l_partkey % 6 as int) as guarant_status
        from {lineitem}""",
    "contract_revision": """
        select 'h' || cast(l_orderkey as string) || '-' || cast(l_partkey as string) || '-' || cast(l_suppkey as string) || '-'
                   || cast(l_linenumber as string) || '-' || cast(cast(l_shipdate as date) as string) as history_id,
               'c' || cast(l_orderkey as string) as contract_id, cast(37 + l_linenumber % 5 as int) as change_type,
               case when l_partkey % 5 = 0 then null else 'G' || cast(l_partkey as string) end as number,
               cast(l_shipdate as date) - 100 as contract_date, cast(l_shipdate as date) - 90 as start_date,
               cast(l_shipdate as date) + 400 as end_date,
               case when l_partkey % 3 = 0 then cast(l_shipdate as date) + 60 else null end as closed_date,
               cast(case when l_partkey % 4 = 0 then null else l_suppkey % 5 end as int) as branch_id,
               cast(l_suppkey % 25 as int) as division_id, 'u' || cast(l_suppkey as string) as customer_id,
               case when l_partkey % 2 = 0 then '840' else null end as currency
        from {lineitem}""",
    # --- registers and balances ---------------------------------------------------------------------
    "register": f"""
        select 'rc' || cast(o_orderkey as string) as register_id, {_pick("o_orderkey", CONTRACT_REGISTERS)} as register_type_id,
               'c' || cast(o_orderkey as string) as contract_id, cast(null as string) as issue_id, cast(null as string) as portfolio_id
        from {{orders}}
        union all
        select 'rd' || cast(o_orderkey as string), cast(case when o_orderkey % 10 = 9 then 2 else 113 + o_orderkey % 2 end as int),
               'c' || cast(o_orderkey as string), cast(null as string), cast(null as string)
        from {{orders}} where o_orderkey % 2 = 1 or o_orderkey % 9 = 0
        union all
        select 'ri' || substring(issue_id, 2), {_pick("issue_number + cast(substring(contract_id, 2) as bigint)", TRANCHE_REGISTERS)},
               contract_id, issue_id, cast(null as string)
        from {{issue}}
        union all
        select 'rp' || cast(k as string) || p_brand, cast(300 + k as int), cast(null as string), cast(null as string), p_brand
        from (select distinct p_brand, cast(p_partkey % 4 as int) as k from {{part}}) b""",
    "register_rest": """
        select register_id, oper_day, cast(rest_out - over_in + over_out as decimal(21,2)) as rest_in, rest_out, over_in, over_out
        from (
            select register_id, oper_day, over_in, over_out,
                   cast(sum(cast(over_in - over_out as decimal(21,2))) over (partition by register_id order by oper_day
                        rows between unbounded preceding and current row) as decimal(21,2)) as rest_out
            from (
                select register_id, oper_day, cast(sum(price) as decimal(21,2)) as over_in,
                       cast(sum(price * discount) as decimal(21,2)) as over_out
                from (
                    select 'rc' || cast(l_orderkey as string) as register_id, cast(l_shipdate as date) as oper_day,
                           cast(l_extendedprice as decimal(15,2)) as price, cast(l_discount as decimal(6,4)) as discount
                    from {lineitem}
                    union all
                    select case when l_partkey % 2 = 0 then 'ri' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string)
                                else 'rd' || cast(l_orderkey as string) end,
                           cast(l_shipdate as date), cast(l_extendedprice as decimal(15,2)), cast(l_discount as decimal(6,4))
                    from {lineitem}
                    union all
                    select 'rp' || cast(l_linenumber % 4 as string) || p_brand, cast(l_shipdate as date),
                           cast(l_extendedprice as decimal(15,2)), cast(l_discount as decimal(6,4))
                    from {lineitem} join {part} on l_partkey = p_partkey
                ) m group by register_id, oper_day
            ) d
        ) r""",
    # --- accounts -----------------------------------------------------------------------------------
    "account": f"""
        select 'ac' || cast(o_orderkey as string) as account_id, 'bc' || cast(o_orderkey as string) as base_account_id,
               {_pick("o_orderkey", CONTRACT_ACCOUNTS)} as account_type_id, 'c' || cast(o_orderkey as string) as contract_id,
               cast(null as string) as issue_id, cast(null as string) as portfolio_id
        from {{orders}} where o_orderkey % 19 <> 0
        union all
        select 'ad' || cast(o_orderkey as string), 'bc' || cast(o_orderkey - 1 as string),
               cast(case when o_orderkey % 2 = 0 then 10001 else 10050 end as int), 'c' || cast(o_orderkey as string),
               cast(null as string), case when o_orderkey % 5 = 0 then 'Brand#' || cast(1 + o_orderkey % 25 as string) else null end
        from {{orders}} where o_orderkey % 3 = 0 and o_orderkey % 19 <> 0 and o_orderkey > 0
        union all
        select 'ai' || substring(issue_id, 2), 'bi' || substring(issue_id, 2),
               {_pick("issue_number + cast(substring(contract_id, 2) as bigint)", TRANCHE_ACCOUNTS)},
               case when issue_number % 4 = 0 then contract_id else null end, issue_id, cast(null as string)
        from {{issue}} where issue_number % 3 <> 2
        union all
        select 'ap' || cast(k as string) || p_brand, 'bp' || cast(k as string) || p_brand, {_pick("k", PORTFOLIO_ACCOUNTS)},
               cast(null as string), cast(null as string), p_brand
        from (select distinct p_brand, cast(p_partkey % 25 as int) as k from {{part}}) b""",
    "base_account": f"""
        select 'bc' || cast(o_orderkey as string) as base_account_id,
               case when o_orderkey % 23 = 0 then null when o_orderkey % 17 = 0 then 'X' || cast(o_orderkey as string)
                    else lpad(cast(o_orderkey as string), 20, '4') end as number,
               case when o_orderkey % 3 = 0 then null when o_orderkey % 3 = 1 then '810' else '978' end as currency,
               o_orderdate as date_open,
               case when o_orderstatus = 'F' then o_orderdate + interval 400 day else null end as date_close,
               {_pick("o_orderkey", CONTRACT_ACCOUNTS)} as account_type_id
        from {{orders}}
        union all
        select 'bi' || substring(issue_id, 2), lpad(cast(issue_number as string) || substring(contract_id, 2), 20, '5'), '810',
               cast(issue_date as timestamp_ntz), cast(close_date as timestamp_ntz),
               {_pick("issue_number + cast(substring(contract_id, 2) as bigint)", TRANCHE_ACCOUNTS)}
        from {{issue}}
        union all
        select 'bp' || cast(k as string) || p_brand, lpad(cast(k as string), 20, '6'), '810', cast('1996-01-01' as timestamp_ntz),
               case when k % 6 = 5 then cast('1997-01-01' as timestamp_ntz) else null end, {_pick("k", PORTFOLIO_ACCOUNTS)}
        from (select distinct p_brand, cast(p_partkey % 25 as int) as k from {{part}}) b""",
    # --- published slices that later datasets read -------------------------------------------------
    "loan_slice": """
        select contract_id as oid, cast(null as string) as main_contract_oid, client_id as client_oid,
               cast(branch_id as int) as branch_code, number
        from {contract} join {base_contract} using (contract_id) where kind = 0 and status in (1, 2) and contract_date <= cast('1998-06-30' as date)
        union all
        select issue_id, contract_id, client_id, cast(branch_id as int), cast(issue_number as string)
        from {issue} join {contract} using (contract_id) join {base_contract} using (contract_id)
        where contract_type in (2, 3, 6, 7) and kind = 0 and status in (1, 2) and issue_date <= cast('1998-06-30' as date)""",
    "guarantee_slice": """
        select contract_id as oid, cast(null as string) as main_contract_oid, client_id as client_oid,
               cast(branch_id as int) as branch_code, number
        from {contract} join {base_contract} using (contract_id) where kind = 2 and status in (1, 2)""",
    # --- portfolios ---------------------------------------------------------------------------------
    "portfolio": """
        select p_brand as portfolio_id, 'bt' || cast(count(*) % 5 as string) as back_type_id,
               case when min(p_size) > 1 then null else 'cr' || cast(count(*) % 7 as string) end as criteria_id,
               'rg' || cast(max(p_size) % 5 as string) as risk_group_id
        from {part} group by p_brand""",
    "portfolio_back_type": """
        select 'bt' || cast(r_regionkey as string) as back_type_id, r_name as name,
               case when r_regionkey = 3 then cast('2001-01-01' as date) else cast('1996-01-01' as date) end as begin_date,
               case when r_regionkey = 2 then null else r_regionkey % 2 end as freeze_client_status, cast(r_regionkey as int) as contract_type
        from {region}""",
    "back_type_office": """
        select 'bt' || cast(n_nationkey % 6 as string) as back_type_id, n_nationkey as division_id,
               case when n_nationkey < 4 or n_nationkey = 9 then 1 else 0 end as create_account
        from {nation}""",
    "portfolio_criteria": "select 'cr' || cast(n_nationkey as string) as criteria_id, lower(n_name) as name from {nation} where n_nationkey < 6",
    # --- cessions (event based) ---------------------------------------------------------------------
    "operation": """
        select 'e' || cast(event_id as string) as operation_id,
               case when event_id % 3 = 0 then null else 'e' || cast(event_id - 1 as string) end as parent_id,
               'c' || cast(user_id as string) as contract_id,
               'i' || cast(user_id as string) || '-' || cast(event_id % 7 as string) as issue_id,
               cast(case when event_id % 3 = 0 and event_type = 'purchase' then 88 when event_id % 3 = 0 then 1 else 2 end as int) as type_id,
               cast(ts as date) as oper_date, cast(value as decimal(21,2)) as oper_sum,
               cast(case when event_id % 13 = 0 then 0 else 1 end as int) as status
        from {events}""",
    "transaction": """
        select 'e' || cast(event_id as string) as operation_id, 'ac' || cast(user_id * 7 + 3 as string) as debit_account_id
        from {events}
        union all
        select 'e' || cast(event_id as string), 'ac' || cast(user_id as string) from {events} where event_id % 4 = 0
        union all
        select 'e' || cast(event_id as string), 'ac' || cast(user_id * 7 + 3 as string) from {events} where event_id % 5 = 0""",
    "movement": """
        select 'm' || cast(event_id as string) as movement_id, 'e' || cast(event_id as string) as operation_id,
               'rc' || cast(user_id as string) as register_id
        from {events}
        union all
        select 'n' || cast(event_id as string), 'e' || cast(event_id as string), 'rc' || cast(user_id + event_id % 3 as string)
        from {events} where event_id % 2 = 0""",
    # --- schedules, clients, entries ----------------------------------------------------------------
    "schedule": """
        select case when l_linenumber % 3 = 0 then 'contract' else 'issue' end as owner,
               case when l_linenumber % 3 = 0 then 'c' || cast(l_orderkey as string)
                    else 'i' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) end as owner_id,
               case when l_partkey % 10 = 0 then null else cast(l_shipdate as date) end as date_payment,
               cast(l_extendedprice as decimal(21,2)) as debt_main,
               cast(cast(l_extendedprice as decimal(15,2)) * cast(l_tax as decimal(6,4)) as decimal(21,2)) as debt_interest,
               cast(0 as decimal(21,2)) as commissions, cast(0 as decimal(21,2)) as other_payments,
               cast(0 as decimal(21,2)) as other_expenses, cast(0 as decimal(21,2)) as overdue_main,
               cast(0 as decimal(21,2)) as overdue_interest, cast(l_linenumber as decimal(21,2)) as penalty
        from {lineitem}""",
    "client": """
        select 'u' || cast(c_custkey as string) as oid, c_name as name, upper(c_name) as full_name,
               case when c_custkey % 2 = 0 then 'ф' else 'ю' end as status, c_mktsegment as client_type,
               cast(1 as int) as is_resident, lpad(cast(c_custkey as string), 10, '7') as inn, cast(null as string) as kpp,
               cast(null as string) as okved, cast(null as string) as okato, cast('1990-01-01' as date) + cast(c_custkey % 5000 as int) as date_reg,
               cast(null as date) as date_birth, cast(null as string) as gender, c_mktsegment as segment,
               cast(null as string) as rating_internal, cast(c_acctbal as decimal(18,2)) as rating_internal_score,
               cast(c_custkey % 11 as smallint) as branch_code, cast(null as string) as fin_position
        from {customer}""",
    "entry": """
        select 'c' || cast(case when l_partkey % 4 = 0 then l_orderkey + 10000000 else l_orderkey end as string) as contract_oid,
               case when l_linenumber % 3 = 0 then '' else 'i' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) end as tranche_oid,
               case when l_partkey % 5 < 3 then ''
                    else 'Brand#' || cast(1 + l_suppkey % 30 as string) end as portfolio_oid,
               l_returnflag as operation_type, cast(l_shipdate as date) as date1, cast(l_extendedprice as decimal(31,2)) as sum_rub,
               lpad(cast(l_orderkey as string), 20, '4') as acc_number_debet, lpad(cast(l_partkey as string), 20, '7') as acc_number_credit,
               'P' || cast(l_suppkey as string) as payment_purpose,
               case when l_suppkey % 10 = 0 then 'other' else 'loan-book' end as source, cast(l_linenumber % 2 as int) as branch_code
        from {lineitem}""",
    # --- pledges ------------------------------------------------------------------------------------
    "pledge_contract": """
        select 'c' || cast(o_orderkey as string) as contract_id,
               case when o_orderkey % 4 = 0 then null else 'x' || cast(o_orderkey % 6 as string) end as source_system
        from {orders} where o_orderkey % 3 <> 2""",
    "external_system": "select 'x' || cast(r_regionkey as string) as code, r_name as name from {region}",
    "pledge": """
        select 'p' || cast(p_partkey as string) as pledge_id, 'c' || cast(p_partkey as string) as pledge_contract_id,
               cast(case when p_partkey % 9 = 8 then 0 else 1 end as int) as pledge_status, 'w' || cast(p_partkey as string) as owner_id,
               case when p_partkey % 4 = 0 then null when p_partkey % 4 = 1 then cast(0 as decimal(21,2))
                    else cast(p_retailprice as decimal(21,2)) end as fair_value,
               case when p_partkey % 7 = 0 then null else cast(p_retailprice as decimal(21,2)) end as collateral_value,
               cast('1998-01-01' as date) + p_size as confirmation_date,
               cast(case when p_partkey % 6 = 0 then null else p_partkey % 2 end as int) as subsequent,
               case when p_size % 3 = 0 then null else cast('1998-06-10' as date) + p_size end as basic_state_date,
               cast(p_partkey % 2 as int) as consider_reserve
        from {part}""",
    "pledge_owner": "select 'w' || cast(p_partkey as string) as owner_id, 'b' || cast(p_partkey as string) as object_id from {part} where p_partkey % 23 <> 0",
    "pledge_object": """
        select 'b' || cast(p_partkey as string) as object_id, 't' || cast(p_size as string) as collateral_type_id,
               p_size as pledge_kind, p_name as name, cast(1 + p_partkey % 3 as int) as quality_category
        from {part}""",
    "surety": """
        select 'c' || cast(o_orderkey as string) as contract_id, 't' || cast(o_orderkey % 60 as string) as collateral_type_id,
               cast(1 + o_orderkey % 2 as int) as quality_category
        from {orders} where o_orderkey % 2 = 0""",
    "collateral_type": "select 't' || cast(p_size as string) as collateral_type_id, max(p_brand) as code, max(p_type) as name from {part} group by p_size",
    "collateral_source": "select 't' || lpad(cast(p_partkey as string), 9, '0') as collateral_type_id, p_brand as code, p_type || ' ' || p_name as name from {part}",
    "pledge_link": """
        select 'c' || cast(l_orderkey as string) as contract_id,
               'c' || cast(case when l_linenumber % 2 = 0 then l_partkey else l_suppkey * 2 end as string) as pledge_contract_id,
               cast(l_shipdate as date) - 200 as link_date,
               case when l_partkey % 3 = 0 then null else cast(l_shipdate as date) + 300 end as expiration_date
        from {lineitem}""",
    "pledge_link_history": """
        select 'l' || cast(l_orderkey as string) || '-' || cast(l_partkey as string) || '-' || cast(l_suppkey as string) || '-'
                   || cast(l_linenumber as string) || '-' || cast(cast(l_shipdate as date) as string) as link_history_id,
               'c' || cast(l_orderkey as string) as contract_id,
               'c' || cast(case when l_linenumber % 2 = 0 then l_partkey else l_suppkey * 2 end as string) as pledge_contract_id,
               case when l_linenumber % 2 = 0 then 'p' || cast(l_partkey as string) else null end as pledge_id,
               cast(l_shipdate as date) - 5 as rest_oper_day, cast(l_shipdate as date) as distribution_date,
               cast(l_extendedprice as decimal(21,2)) as fair_value, cast(l_quantity as decimal(21,2)) as insurance_sum
        from {lineitem}""",
    "pledge_quality": """
        select 'b' || cast(l_partkey as string) as object_id, cast(1 + l_linenumber % 3 as int) as quality_category,
               cast(l_shipdate as date) as setting_date
        from {lineitem}""",
    "pledge_assessment": """
        select 'b' || cast(l_partkey as string) as object_id, 'n' || cast(l_suppkey as string) as conclusion_id,
               cast(l_shipdate as date) as assessment_date, cast(l_extendedprice as decimal(21,2)) as collateral_value
        from {lineitem}""",
    "pledge_conclusion": "select 'n' || cast(s_suppkey as string) as conclusion_id, 'a' || cast(s_suppkey as string) as activity_id from {supplier}",
    "activity": "select 'a' || cast(s_suppkey as string) as activity_id, cast(1 + s_suppkey % 3 as int) as status from {supplier}",
    "pledge_chain": """
        select 'p' || cast(p_partkey as string) as pledge_id,
               case when p_partkey % 8 = 0 then null else 'p' || cast(p_partkey - 1 as string) end as prev_pledge_id,
               case when p_partkey % 8 = 0 then null else cast('1998-06-01' as date) + p_size end as switch_date
        from {part}""",
    "pledge_series": """
        select 'p' || cast(p_partkey as string) as pledge_id,
               'p' || cast(p_partkey - p_partkey % 8 as string) as base_id, cast(p_partkey % 8 as int) as level,
               case when p_partkey % 8 = 0 then null else cast('1998-06-01' as date) + p_size end as switch_date
        from {part}""",
    # --- logs and presence --------------------------------------------------------------------------
    "run": """
        select 'run' || cast(user_id as string) || '-' || cast(cast(ts as date) as string) as run_id, cast(0 as int) as event_type,
               cast(ts as date) as for_date,
               cast(cast(ts as date) as timestamp_ntz) + cast(user_id % 23 as int) * interval 1 hour as start
        from {events} group by user_id, cast(ts as date)""",
    "step": """
        select 'st' || cast(event_id as string) as step_id, 'run' || cast(user_id as string) || '-' || cast(cast(ts as date) as string) as run_id,
               date_trunc('second', ts) as start, cast(event_id % 15 as int) as number, event_type as target,
               cast(event_id % 1000 as decimal(9,3)) as duration, cast(case when event_type = 'error' then 0 else 1 end as int) as status,
               cast(event_id % 77 as bigint) as record_count, cast(case when event_type = 'error' then 50000 else null end as int) as error_number,
               case when event_type = 'error' then 'p1' else null end as error_proc,
               case when event_type = 'error' then 'failed ' || cast(event_id as string) else null end as error_message
        from {events}""",
    "raw_step": """
        select 'run' || cast(user_id as string) as run_id, cast(event_id as int) as number, event_type as target,
               date_trunc('second', ts) as start, date_trunc('second', ts) + cast(event_id % 100 as int) * interval 1 second as finish,
               cast(case when event_id % 9 = 0 then 0 else 1 end as int) as status
        from {events}""",
    "expected": "select distinct p_brand as name, lower(p_brand) as synonym from {part}",
    "found": "select p_brand as name from {part} where p_size > 49",
}

# The same rows for Spark. A line item belongs to a contract register and a tranche or disposal register of its own order, so it is dealt out once, by its
# order, before it becomes the rows of both: day sums and the running sum then need no exchange of their own. Portfolio registers have rows of
# the whole book and a missing register has rows of any order; their days are summed before they are dealt out by register.
PLACED: dict[str, str] = {
    "register_rest": """
        select register_id, oper_day, cast(rest_out - over_in + over_out as decimal(21,2)) as rest_in, rest_out, over_in, over_out
        from (
            select register_id, oper_day, over_in, over_out,
                   cast(sum(cast(over_in - over_out as decimal(21,2))) over (partition by order_id, register_id order by oper_day
                        rows between unbounded preceding and current row) as decimal(21,2)) as rest_out
            from (
                select order_id, register_id, oper_day, cast(sum(price) as decimal(21,2)) as over_in, cast(sum(price * discount) as decimal(21,2)) as over_out
                from (
                    select order_id, oper_day, price, discount,
                           explode(array('rc' || cast(order_id as string), case when tranche then 'ri' || cast(order_id as string) || '-' || cast(line as string)
                                                                                else 'rd' || cast(order_id as string) end)) as register_id
                    from (
                        select /*+ repartition({parts}, order_id) */ order_id, line, tranche, oper_day, price, discount
                        from (
                            select l_orderkey as order_id, l_linenumber as line, l_partkey % 2 = 0 as tranche, cast(l_shipdate as date) as oper_day,
                                   cast(l_extendedprice as decimal(15,2)) as price, cast(l_discount as decimal(6,4)) as discount
                            from {lineitem}
                        ) l
                    ) o
                ) m where register_id is not null group by order_id, register_id, oper_day
            ) d
            union all
            select register_id, oper_day, over_in, over_out,
                   cast(sum(cast(over_in - over_out as decimal(21,2))) over (partition by register_id order by oper_day
                        rows between unbounded preceding and current row) as decimal(21,2)) as rest_out
            from (
                select register_id, oper_day, cast(sum(price) as decimal(21,2)) as over_in, cast(sum(spent) as decimal(21,2)) as over_out
                from (
                    select /*+ repartition({parts}, register_id) */ register_id, oper_day, price, spent
                    from (
                        select 'rp' || cast(l_linenumber % 4 as string) || p_brand as register_id, cast(l_shipdate as date) as oper_day,
                               sum(cast(l_extendedprice as decimal(15,2))) as price,
                               sum(cast(l_extendedprice as decimal(15,2)) * cast(l_discount as decimal(6,4))) as spent
                        from {lineitem} join {part} on l_partkey = p_partkey group by 1, 2
                        union all
                        select cast(null as string), cast(l_shipdate as date),
                               sum(cast(l_extendedprice as decimal(15,2))),
                               sum(cast(l_extendedprice as decimal(15,2)) * cast(l_discount as decimal(6,4)))
                        from {lineitem} where l_orderkey is null group by 2
                        union all
                        select cast(null as string), cast(l_shipdate as date),
                               sum(cast(l_extendedprice as decimal(15,2))),
                               sum(cast(l_extendedprice as decimal(15,2)) * cast(l_discount as decimal(6,4)))
                        from {lineitem}
                        where (l_orderkey is null or l_linenumber is null) and (l_orderkey is null or l_partkey % 2 = 0) group by 2
                    ) a
                ) m group by register_id, oper_day
            ) d
        ) r""",
}

_REF = re.compile(r"\{(\w+)\}")


def references(sql: str) -> list[str]:
    return list(dict.fromkeys(_REF.findall(sql)))


def needed(sql: str) -> list[str]:
    """Views behind a query, each after the ones it reads."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in references(text):
            if name in VIEWS and name not in order:
                visit(VIEWS[name])
                order.append(name)

    visit(sql)
    return order


def duck_sql(sql: str) -> str:
    """A query over the views as one self-contained DuckDB statement on the driver's tables."""
    plain = lambda text: _REF.sub(lambda m: m.group(1), text).replace("timestamp_ntz", "timestamp")
    views = [f"{name} as ({plain(VIEWS[name])})" for name in needed(sql)]
    body = plain(sql).strip()
    if not views:
        return body
    if body.lower().startswith("with recursive "):
        return "with recursive " + ", ".join(views) + ", " + body[len("with recursive "):]
    if body.lower().startswith("with "):
        return "with " + ", ".join(views) + ", " + body[len("with "):]
    return "with " + ", ".join(views) + " " + body


# Everything joined or reduced from orders or line items. A loan system holds these as tables, so each is
# written once per application and data folder, and read as a table from then on. Plain columns of a table are read
# where they are, and so are the unions of such (registers and accounts, which reduce the parts only): a copy would be moved and written for nothing.
UNIONS = ("register", "account", "base_account")
_COMBINED = re.compile(r"\b(join|union|distinct|group by|over)\b")
STAGED = tuple(
    name for name, sql in VIEWS.items()
    if {"orders", "lineitem", "issue", "contract", "base_contract"} & set(references(sql)) and _COMBINED.search(sql) and name not in UNIONS
) + ("portfolio", "run")


# Bytes of input behind one part of a view that is dealt out by a key: sums and sorts of a part stay within one task's memory.
PLACED_BYTES = 4 << 20

# Input below this size for each core is dealt out over the cores.
SPREAD_BYTES = 8 << 20


class StandIns(dict):
    """The views as Spark frames over one data folder, built on first use."""

    ALIASES = {"customer": "customer_dim", "config": "config9"}
    _written: dict[tuple[str, str, str], str] = {}

    def __init__(self, spark: SparkSession, sf_dir: str, **overrides: DataFrame) -> None:
        super().__init__(overrides)
        self.spark = spark
        self.sf_dir = sf_dir
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """A driver table, or a view by its own name."""
        if name not in self._raw:
            if name in VIEWS:
                tables = {r: self.raw(r) for r in references(VIEWS[name])}
                frame = self._view(name, tables)
                self._raw[name] = self._stage(name, frame) if name in STAGED else frame
            else:
                self._raw[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    def once(self, name: str) -> DataFrame:
        """A view for a query that goes through it once: not written as a table, and cut down to the columns asked for where it is built."""
        tables = {r: self.once(r) if r in VIEWS else self.raw(r) for r in references(VIEWS[name])}
        return self._view(name, tables)

    def _view(self, name: str, tables: dict[str, DataFrame]) -> DataFrame:
        if name not in PLACED:
            return self.spark.sql(VIEWS[name], **tables)
        read = sum(bytes_of(self.spark, f.inputFiles()) for f in tables.values())
        parts = max(self.spark.sparkContext.defaultParallelism, -(-read // PLACED_BYTES))
        return self.spark.sql(PLACED[name], parts=parts, **tables)

    def _stage(self, name: str, frame: DataFrame) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in self._written or not folder_exists(self.spark, self._written[key]):
            folder = new_folder(self.spark, f"source-{name}")
            cores = self.spark.sparkContext.defaultParallelism
            files = frame.inputFiles()
            if name not in PLACED and len(files) < cores and bytes_of(self.spark, files) < cores * SPREAD_BYTES:
                # A handful of small input files would leave a handful of tasks, here and in every later scan. Larger ones are split by the scan,
                # and a view dealt out by its key has a part for each core already.
                frame = frame.repartition(cores)
            frame.write.option("compression", "zstd").parquet(folder)
            self._written[key] = folder
        return self.spark.read.parquet(self._written[key])

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.raw(self.ALIASES.get(name, name))
        return self[name]

    def __contains__(self, name: object) -> bool:
        return super().__contains__(name) or name in VIEWS


def narrow(s: dict[str, DataFrame], name: str, *columns: str) -> None:
    """A view is written with these columns for a query that reads no others, here and in the views behind it. Given frames, and a table that is there whole, stay as they are."""
    if isinstance(s, StandIns) and name not in s._raw and (s.spark.sparkContext.applicationId, s.sf_dir, name) not in s._written:
        frame = s._view(name, {r: s.raw(r) for r in references(VIEWS[name])}).select(*columns)
        s._raw[name] = s._stage("-".join((name, *columns)), frame)
