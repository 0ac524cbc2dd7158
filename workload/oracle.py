"""SQL counterparts of the registered queries, run by DuckDB on the driver's tables.

They state each result directly (OR joins, per-row picks, pair products), not the way the library gets it.
``{name}`` stands for a view or table, ``@D`` and ``@E`` for the two reporting dates.
"""

from __future__ import annotations

from snapbook.plans.dictionaries import GUARANTEE_TYPES, RESERVE_TYPES, SCHEDULE_TYPES, SEGMENTS
from snapbook.plans.guarantee import STATUS_MAP
from snapbook.plans.portfolio import ACCOUNT_COLUMNS
from snapbook.plans.register_types import EXTRA_LINKS, TARGET_TYPES
from workload.standins import EVENT_DAY, ORDER_DAY, duck_sql


def _rows(rows, columns: str, name: str) -> str:
    lit = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(values {body}) as {name}({columns})"


STATUS = _rows(STATUS_MAP, "guarantee_status, base_status, status_name, base_status_name", "m")

LATEST_REST = """(select * from {register_rest} where oper_day <= @D
    qualify row_number() over (partition by register_id order by oper_day desc) = 1)"""

BACK_OFFICE = """(select l.back_type_id, d.code as division_code, coalesce(cast(b.inner_code as int), 0) as branch_code
    from {back_type_office} l join {division} d on d.division_id = l.division_id join {branch} b on b.branch_id = d.branch_id
    where l.create_account = 1)"""

OPENING_BALANCE = f"""select g.register_id,
    cast(coalesce(case when r.oper_day = @D then r.rest_in else r.rest_out end, 0) as double) as rest,
    cast(coalesce(d.over_in, 0) as double) as over_in, cast(coalesce(d.over_out, 0) as double) as over_out
    from {{register}} g left join {LATEST_REST} r on r.register_id = g.register_id
    left join {{register_rest}} d on d.register_id = g.register_id and d.oper_day = @D"""

ELIGIBLE = """(
    select c.contract_id, c.contract_type,
           case when b.status in (1, 2) and b.start_date <= @D and @D < coalesce(b.closed_date, @D + 1) then 1
                when b.status in (1, 2) and @D >= coalesce(b.closed_date, @D + 1) then 2
                else coalesce(h.status, 0) end as actual_status,
           b.closed_date as fact_close_date, coalesce(p.portfolio_id, l.portfolio_id) as portfolio_id
    from {contract} c join {base_contract} b using (contract_id) join {loan_contract} l using (contract_id)
    left join (select * from {status_history} where oper_day <= @D
               qualify row_number() over (partition by contract_id order by oper_day desc, date_change desc, seq desc) = 1) h using (contract_id)
    left join (select * from {portfolio_history} where date_begin <= @D
               qualify row_number() over (partition by contract_id order by date_begin desc, portfolio_id desc) = 1) p using (contract_id)
    where c.kind = 0)"""

QUALITY = """(select x.@K, x.ratio as reserve_ratio, g.code as quality_code from {risk_change} x join {risk_group} g using (risk_group_id)
    where x.action_date <= @D qualify row_number() over (partition by x.@K order by x.action_date desc, x.change_id desc) = 1)"""

RATE = """(select scheme_id, rate from {scheme_value} where value_date <= @D
    qualify row_number() over (partition by scheme_id order by value_date desc, seq desc) = 1)"""

CONTRACT_SUM = """(select contract_id, amount from {contract_sum} where eff <= @D
    qualify row_number() over (partition by contract_id order by eff desc, amount desc) = 1)"""

OVERDUE = """(
    with d as (select contract_id, part, oper_day, sum(rest_out) as rest from {overdue_balance} where oper_day <= @D group by all),
    r as (select contract_id, part, min(oper_day) as first_day from d
          where rest > 0 and not exists (select 1 from d z where z.contract_id = d.contract_id and z.part = d.part and z.rest = 0 and z.oper_day >= d.oper_day)
          group by all)
    select contract_id, min(first_day) filter (part = 'principal') as principal_from, min(first_day) filter (part = 'interest') as interest_from
    from r group by contract_id)"""

NEXT_CONTRACT = """(
    select distinct a.contract_id, a.contract_term from {agreement_history} a
    join (select contract_id, min(change_date) as change_date from {agreement_history} where change_type = 4 and change_date > @D group by 1) m
      using (contract_id, change_date)
    where a.change_type = 4 and a.contract_term is not null and a.issue_id is null)"""

NEXT_ISSUE = """(
    select distinct a.issue_id, a.issue_term from {agreement_history} a
    join (select issue_id, min(change_date) as change_date from {agreement_history} where change_type = 1 and change_date > @D group by 1) m
      using (issue_id, change_date)
    where a.change_type = 1)"""

LAST_REVISION = f"""(
    select r.*, e.create_date, e.guarant_status, m.base_status from {{contract_revision}} r join {{guarantee_event}} e using (history_id)
    join {STATUS} on m.guarantee_status = e.guarant_status
    where r.change_type in (37, 38, 39, 40) and cast(e.create_date as date) <= @D
    qualify row_number() over (partition by r.contract_id order by e.create_date desc, r.history_id desc) = 1)"""

TARGETS = f"""(
    with direct as (
        select distinct register_type_id, sub_type, lvl, base_type_id from {_rows(TARGET_TYPES, "register_type_id, sub_type, lvl, base_type_id", "f")}
        union
        select register_type_id, sub_type, 0, register_type_id from {{register_type}} where sub_type = 2 and is_operational = 1),
    parents as (
        select t.register_type_id, t.sub_type, 1, d.base_type_id from direct d
        join {{register_type_link}} l on l.child_id = d.register_type_id join {{register_type}} t on t.register_type_id = l.parent_id
        where d.lvl = 0 and t.brief like 'МСФО9%'
          and not exists (select 1 from direct z where z.lvl = 0 and z.register_type_id = t.register_type_id))
    select * from (select * from direct union select * from parents) where register_type_id <> 202)"""

LINKS = f"""(
    with stored as (
        select register_type_id, account_type_id from {{account_register_link}} k
        where not exists (
            select 1 from {{account_type}} a join {{register_type}} g on g.register_type_id = k.register_type_id and g.sub_type = 2
            where a.account_type_id = k.account_type_id and (a.code like '%МСФО9_Доход%' or a.code like 'МСФО9_Расх%'))
        union all select * from {_rows(EXTRA_LINKS, "a, b", "x")}),
    base as (select distinct s.register_type_id, s.account_type_id, t.lvl as priority from stored s join {TARGETS} t using (register_type_id)),
    one as (select distinct l.parent_id, b.account_type_id, b.priority + 10 as priority from base b join {{register_type_link}} l on l.child_id = b.register_type_id),
    two as (select distinct l.parent_id, b.account_type_id, b.priority + 10 as priority from one b join {{register_type_link}} l on l.child_id = b.parent_id)
    select register_type_id, account_type_id, case when account_type_id = 10050 and register_type_id in (113, 114) then 5 else priority end as priority
    from (select * from base union all select * from one union all select * from two))"""

ENTRIES = f"""(
    select 0 as entry_kind, s.oid as entry_id, s.client_oid as client_id, s.branch_code, s.number as entry_name, c.contract_type
    from (select * from {{loan_slice}} union all select * from {{guarantee_slice}}) s join {{contract}} c on c.contract_id = s.oid
    union all
    select 1, s.oid, s.client_oid, s.branch_code, b.number || ' - ' || cast(i.issue_number as varchar), c.contract_type
    from {{loan_slice}} s join {{issue}} i on i.issue_id = s.oid join {{base_contract}} b on b.contract_id = i.contract_id
    join {{contract}} c on c.contract_id = i.contract_id
    union all
    select 2, p.portfolio_id, null, coalesce((select min(o.branch_code) from {BACK_OFFICE} o where o.back_type_id = p.back_type_id), 0), t.name, null
    from {{portfolio}} p left join {{portfolio_back_type}} t on t.back_type_id = p.back_type_id where t.begin_date <= @D)"""

CLOSED_ENTRIES = f"""
    select distinct 0 as entry_kind, b.contract_id as entry_id, b.client_id, coalesce(cast(n.inner_code as int), 0) as branch_code,
           b.number as entry_name, c.contract_type
    from {{contract}} c join {{base_contract}} b using (contract_id) left join {{branch}} n on n.branch_id = b.branch_id
    join {{register}} g on g.contract_id = c.contract_id and g.issue_id is null
    join {{register_type}} t on t.register_type_id = g.register_type_id and t.brief not in
        ('Гарант', 'Лим', 'НеиспЛим', 'Обесп', 'ОбеспРез', 'БГарант', 'РезервБГарант', 'ЛимБГарант', 'НеисЛимБГарант')
    join {LATEST_REST} r on r.register_id = g.register_id
    where c.kind = 0 and b.status not in (0, 3) and coalesce(b.closed_date, @D) between @D - 30 and @D - 1 and r.rest_out > 0
    union all
    select distinct 1, i.issue_id, b.client_id, coalesce(cast(n.inner_code as int), 0), b.number || ' - ' || cast(i.issue_number as varchar), c.contract_type
    from {{contract}} c join {{base_contract}} b using (contract_id) join {{issue}} i on i.contract_id = c.contract_id
    left join {{branch}} n on n.branch_id = b.branch_id join {{register}} g on g.issue_id = i.issue_id
    join {LATEST_REST} r on r.register_id = g.register_id
    where c.kind = 0 and b.status not in (0, 3) and coalesce(i.close_date, @D) between @D - 30 and @D - 1 and r.rest_out > 0"""

REGISTERS = f"""(
    select distinct g.register_id, g.register_type_id, null as portfolio_id, e.entry_id as contract_id, null as issue_id, e.entry_id as contract_oid
    from {ENTRIES} e join {{register}} g on g.contract_id = e.entry_id and g.issue_id is null
    join {TARGETS} t on t.register_type_id = g.register_type_id and t.sub_type = 0 where e.entry_kind = 0
    union all
    select distinct g.register_id, g.register_type_id, null, i.contract_id, i.issue_id, i.contract_id
    from {ENTRIES} e join {{issue}} i on i.contract_id = e.entry_id join {{contract}} c on c.contract_id = i.contract_id
    join {{register}} g on g.contract_id = i.contract_id and g.issue_id = i.issue_id
    join {TARGETS} t on t.register_type_id = g.register_type_id and t.lvl = 0 and t.sub_type = 1
    where e.entry_kind = 0 and c.contract_type not in (2, 3, 6, 7)
    union all
    select distinct g.register_id, g.register_type_id, null, i.contract_id, i.issue_id, i.issue_id
    from {ENTRIES} e join {{issue}} i on i.issue_id = e.entry_id join {{contract}} c on c.contract_id = i.contract_id
    join {{register}} g on g.contract_id = i.contract_id and g.issue_id = i.issue_id
    join {TARGETS} t on t.register_type_id = g.register_type_id and t.lvl = 0 and t.sub_type = 1
    where e.entry_kind = 1 and c.contract_type in (2, 3, 6, 7)
    union all
    select distinct g.register_id, g.register_type_id, g.portfolio_id, null, null, e.entry_id
    from {ENTRIES} e join {{register}} g on g.portfolio_id = e.entry_id
    join {TARGETS} t on t.register_type_id = g.register_type_id and t.lvl = 0 and t.sub_type = 2 where e.entry_kind = 2)"""

_ACCOUNT_FIELDS = """a.account_id, b.number, case when y.kind = 1 then 1 else 0 end as is_active, a.account_type_id, e.entry_kind, e.entry_id,
    e.client_id, e.branch_code, e.entry_name,
    case when coalesce(b.currency, '810') = '810' then '643' else b.currency end as currency,
    coalesce(b.date_close, timestamp '3000-01-01') as will_close"""

ACCOUNTS = f"""(
    select * from (
        select distinct {_ACCOUNT_FIELDS}, null as portfolio_id, a.contract_id, null as issue_id
        from {ENTRIES} e join {{account}} a on a.contract_id = e.entry_id join {{base_account}} b using (base_account_id)
        join {{account_type}} y on y.account_type_id = a.account_type_id
        where e.entry_kind = 0 and cast(b.date_open as date) <= @D and (b.date_close is null or cast(b.date_close as date) >= @D)
          and not (a.account_type_id = 10143 and e.contract_type <> 1)
        union all
        select distinct {_ACCOUNT_FIELDS}, null, null, a.issue_id
        from {ENTRIES} e join {{account}} a on a.issue_id = e.entry_id join {{base_account}} b using (base_account_id)
        join {{account_type}} y on y.account_type_id = a.account_type_id
        where e.entry_kind = 1 and cast(b.date_open as date) <= @D and (b.date_close is null or cast(b.date_close as date) >= @D)
        union all
        select distinct {_ACCOUNT_FIELDS}, a.portfolio_id, null, null
        from {ENTRIES} e join {{account}} a on a.portfolio_id = e.entry_id and a.contract_id is null and a.issue_id is null
        join {{base_account}} b using (base_account_id) join {{account_type}} y on y.account_type_id = a.account_type_id
        where e.entry_kind = 2 and cast(b.date_open as date) <= @D and (b.date_close is null or cast(b.date_close as date) >= @D)
    ) where number is null or (length(trim(number)) = 20 and not regexp_matches(number, '[^0-9]')))"""

# Register and account of one register: every pair that shares an owner and has a linked type.
_CANDIDATES = """
    select r.register_id, a.account_id, a.account_type_id, a.will_close, k.priority from regs r join links k using (register_type_id)
    join accs a on a.account_type_id = k.account_type_id and a.portfolio_id = r.portfolio_id
    union all
    select r.register_id, a.account_id, a.account_type_id, a.will_close, k.priority from regs r join links k using (register_type_id)
    join accs a on a.account_type_id = k.account_type_id and a.issue_id = r.issue_id
    union all
    select r.register_id, a.account_id, a.account_type_id, a.will_close, k.priority from regs r join links k using (register_type_id)
    join accs a on a.account_type_id = k.account_type_id and a.contract_id = r.contract_id"""

MATCH = f"""regs as materialized (select * from {REGISTERS}), accs as materialized (select * from {ACCOUNTS}),
    links as materialized (select * from {LINKS}), targets as materialized (select * from {TARGETS}),
    cand as materialized ({_CANDIDATES}),
    best as (select * from cand qualify row_number() over (partition by register_id order by priority, will_close desc, account_id desc) = 1),
    spec as (select * from cand where account_type_id = 10050
             qualify row_number() over (partition by register_id order by will_close desc, account_id desc) = 1),
    ext as materialized (
        select distinct r.*, b.account_id, b.account_type_id, t.sub_type, t.base_type_id, t.lvl
        from regs r join targets t using (register_type_id) join best b using (register_id)
        union all
        select distinct r.*, b.account_id, b.account_type_id, t.sub_type, t.base_type_id, 1
        from regs r join targets t using (register_type_id) join spec b using (register_id))"""

PAIRS = f"""{MATCH},
    asked as (select distinct sub_type, case sub_type when 2 then portfolio_id when 1 then issue_id else contract_id end as id, base_type_id from ext),
    members as (
        select q.sub_type, q.id, q.base_type_id, e.register_id, e.account_id, e.lvl from asked q join ext e
          on e.base_type_id = q.base_type_id and q.sub_type = 2 and e.portfolio_id = q.id
        union all
        select q.sub_type, q.id, q.base_type_id, e.register_id, e.account_id, e.lvl from asked q join ext e
          on e.base_type_id = q.base_type_id and q.sub_type = 1 and e.issue_id = q.id
        union all
        select q.sub_type, q.id, q.base_type_id, e.register_id, e.account_id, e.lvl from asked q join ext e
          on e.base_type_id = q.base_type_id and q.sub_type = 0 and e.contract_id = q.id),
    pub as (
        select distinct register_id, account_id, 0 as is_external from (
            select * from members qualify row_number() over (partition by sub_type, id, base_type_id order by lvl, register_id, account_id) = 1)
        union all
        select distinct e.register_id, e.account_id, 1 from ext e join {{account}} a on a.account_id = e.account_id
        where e.base_type_id in (113, 114) and a.account_type_id = 10050)"""

LOAN_HEADER = """
    left join {branch} br on br.branch_id = b.branch_id
    left join {division} dv on dv.division_id = b.division_id
    join {customer_dim} cu on cu.customer_id = b.client_id
    left join {legal_person} lp on lp.legal_person_id = cu.legal_person_id
    left join {loan_purpose} pp on pp.purpose_id = c.purpose_id
    join {product_type} pt on pt.product_type_id = c.product_type_id
    left join {loan_program} pg on pg.program_id = pt.program_id
    left join {product} pd on pd.product_id = pg.product_id"""

LOAN_COMMON = """@D as date1, 'loan-book' as source, coalesce(cast(br.inner_code as int), 0) as branch_code, dv.code as division_code"""

FILTER_ACCOUNTS = "exists (select 1 from {account} a where a.contract_id = c.contract_id)"

LOANS = f"""
    select distinct {LOAN_COMMON}, c.contract_id as oid, cast(null as varchar) as main_contract_oid, cu.customer_id as client_oid, b.number,
           b.contract_date as date_open, (select min(i.issue_date) from {{issue}} i where i.contract_id = c.contract_id) as date_issue,
           coalesce(b.start_date + nx.contract_term, e.fact_close_date, b.end_date) as date_end,
           case when e.actual_status < 2 then null else e.fact_close_date end as date_close,
           case when e.actual_status = 2 then case when exists (select 1 from {{operation}} o where o.contract_id = c.contract_id and o.status = 1
                and o.type_id = 88 and o.oper_date <= @D) then 'Цессия' else 'Погашен' end end as reason_end,
           e.portfolio_id as portfolio_oid, pp.name as purpose, cast(coalesce(rt.rate, 0) as double) as rate,
           coalesce(pd.product_id, (select product_id from {{product}} where name = 'Потребительский кредит')) as id_credit_type,
           c.product_type_id as id_product, cast(lp.criterion as varchar) as id_credit_segment,
           cast(coalesce(sm.amount, 0) as double) as summa_val,
           case when coalesce(b.currency, '810') = '810' then '643' else b.currency end as curr,
           cast(q.reserve_ratio as double) as coef_reserve, q.quality_code as category_quality,
           od.principal_from as date_start_overdue_principal, od.interest_from as date_start_overdue_interest,
           coalesce(c.schedule_type, 15) as id_graf_freq_main, coalesce(c.schedule_type, 15) as id_graf_freq_proc,
           cast(c.annual_payment as double) as annual_payment, case when c.contract_type = 6 then 1 else 0 end as is_over,
           case c.contract_type when 3 then 'ВКЛ' when 2 then 'НКЛ' end as cline_type,
           case when fl.code > 0 then 1 else 0 end as is_floating_rate, cast(null as varchar) as oid_fi_class,
           cast(null as double) as fair_value, 0 as is_mbk
    from elig e join {{contract}} c on c.contract_id = e.contract_id join {{base_contract}} b on b.contract_id = c.contract_id and b.status < 3
    {LOAN_HEADER}
    left join {NEXT_CONTRACT} nx on nx.contract_id = c.contract_id
    left join {OVERDUE} od on od.contract_id = c.contract_id
    left join {QUALITY.replace("@K", "contract_id")} q on q.contract_id = c.contract_id
    left join {RATE} rt on rt.scheme_id = c.scheme_id
    left join {CONTRACT_SUM} sm on sm.contract_id = c.contract_id
    left join (select i.contract_id, sum(coalesce(v.base_rate_id, 0) * coalesce(v.rate, 0)) as code from {{issue}} i
               left join {{scheme_value}} v on v.scheme_id = i.scheme_id group by 1) fl on fl.contract_id = c.contract_id
    where {FILTER_ACCOUNTS}"""

TRANCHES = f"""
    select distinct {LOAN_COMMON}, i.issue_id, i.contract_id, cu.customer_id, cast(i.issue_number as varchar), i.issue_date, i.issue_date,
           coalesce(i.issue_date + nx.issue_term, i.plan_repayment_date), i.close_date,
           case when i.close_date < @D then 'Погашен' end, e.portfolio_id, pp.name, cast(coalesce(rt.rate, 0) as double),
           coalesce(pd.product_id, (select product_id from {{product}} where name = 'Потребительский кредит')),
           c.product_type_id, cast(lp.criterion as varchar), cast(coalesce(i.issue_sum, 0) as double),
           case when coalesce(b.currency, '810') = '810' then '643' else b.currency end,
           cast(q.reserve_ratio as double), q.quality_code, od.principal_from, od.interest_from,
           coalesce(c.schedule_type, 15), coalesce(c.schedule_type, 15), cast(c.annual_payment as double), 0, null,
           case when (select sum(coalesce(v.base_rate_id, 0) * coalesce(v.rate, 0)) from {{scheme_value}} v where v.scheme_id = i.scheme_id) > 0 then 1 else 0 end,
           null, null, 0
    from elig e join {{contract}} c on c.contract_id = e.contract_id join {{base_contract}} b on b.contract_id = c.contract_id and b.status < 3
    join {{issue}} i on i.contract_id = c.contract_id
    {LOAN_HEADER}
    left join {NEXT_ISSUE} nx on nx.issue_id = i.issue_id
    left join {OVERDUE} od on od.contract_id = c.contract_id
    left join {QUALITY.replace("@K", "issue_id")} q on q.issue_id = i.issue_id
    left join {RATE} rt on rt.scheme_id = i.scheme_id
    left join (select issue_id, max(oper_date) as oper_date from {{operation}} where type_id = 1 and status = 1 and oper_date <= @D group by 1) op
      on op.issue_id = i.issue_id
    where c.contract_type in (2, 3, 6, 7) and @D between coalesce(op.oper_date, i.issue_date) and coalesce(i.close_date, @D) and {FILTER_ACCOUNTS}"""


def _pledges(bank: int) -> str:
    if bank == 12:
        value = """case when coalesce(p.fair_value, 0) > 0 then coalesce(k0.fair_value, 0)
            when p.subsequent = 0 then coalesce(az.collateral_value, p.collateral_value, 0)
            when coalesce(p.basic_state_date, @D) > @D then coalesce(bp.collateral_value, 0) else 0 end"""
    else:
        value = "coalesce(k0.fair_value, 0)"
    return f"""
    select distinct @D as date1, 'loan-book' as source, coalesce(cast(br.inner_code as int), 0) as branch_code, x.contract_id as contract_oid,
           'к' as contract_type, coalesce(es.name, 'loan-book') as pledge_source, coalesce(p.pledge_id, su.contract_id) as pledge_oid,
           cc.number as pledge_contract_number,
           case when p.pledge_id is not null then cast(po.pledge_kind as varchar) else ct.code end as id_pledge_type,
           case when p.pledge_id is not null then po.name else ct.name end as name,
           case when p.pledge_id is null then su.quality_category
                when p.consider_reserve = 1 then coalesce(pq.quality_category, po.quality_category) else 0 end as category_rsbu,
           case when cc.currency = '810' then '643' else cc.currency end as fair_summa_curr,
           cast(case when p.pledge_id is null then k1.fair_value else {value} end as double) as fair_summa_val,
           case when cc.currency = '810' then '643' else cc.currency end as insure_curr,
           cast(case when p.pledge_id is null then k1.insurance_sum else k0.insurance_sum end as double) as insure_summa_val,
           p.confirmation_date as date_last_measurement,
           case when cc.currency = '810' then '643' else cc.currency end as summa_with_discount_curr, 0 as summa_with_discount_val,
           cc.client_id as client_oid
    from (select distinct coalesce(s.main_contract_oid, s.oid) as contract_id from {{loan_slice}} s) z
    join {{contract}} k on k.contract_id = z.contract_id
    join {{pledge_link}} x on x.contract_id = k.contract_id and @D between x.link_date and coalesce(x.expiration_date, @D)
    join {{base_contract}} cc on cc.contract_id = x.pledge_contract_id and @D between cc.start_date and coalesce(cc.closed_date, @D) and cc.status not in (0, 3)
    join {{pledge_contract}} pc on pc.contract_id = cc.contract_id
    left join {{external_system}} es on es.code = pc.source_system
    left join {{branch}} br on br.branch_id = cc.branch_id
    left join {{pledge}} p on p.pledge_contract_id = x.pledge_contract_id and p.pledge_status = 1
    left join {{pledge_owner}} po_ on po_.owner_id = p.owner_id
    left join {{pledge_object}} po on po.object_id = po_.object_id
    left join {{surety}} su on su.contract_id = x.pledge_contract_id
    left join {{collateral_type}} ct on ct.collateral_type_id = coalesce(po.collateral_type_id, case when p.pledge_id is null then su.collateral_type_id end)
    left join (select * from {{pledge_link_history}} where pledge_id is not null and distribution_date <= @D
               qualify row_number() over (partition by contract_id, pledge_id order by distribution_date desc, link_history_id desc) = 1) k0
      on k0.contract_id = x.contract_id and k0.pledge_id = p.pledge_id
    left join (select * from {{pledge_link_history}} where rest_oper_day <= @D
               qualify row_number() over (partition by contract_id, pledge_contract_id order by distribution_date desc, link_history_id desc) = 1) k1_
      on k1_.contract_id = x.contract_id and k1_.pledge_contract_id = x.pledge_contract_id
    left join {{pledge_link_history}} k1 on k1.link_history_id = k1_.link_history_id and k1.distribution_date <= @D
    left join (select * from {{pledge_quality}} qualify row_number() over (partition by object_id order by setting_date desc, quality_category desc) = 1) pq
      on pq.object_id = po.object_id
    left join (select t.* from {{pledge_assessment}} t join {{pledge_conclusion}} using (conclusion_id) join {{activity}} v using (activity_id)
               where v.status = 3 and t.assessment_date <= @D
               qualify row_number() over (partition by object_id order by assessment_date desc, t.collateral_value desc) = 1) az on az.object_id = po.object_id
    left join (select s.pledge_id, pp.collateral_value from {{pledge_series}} s join {{pledge_series}} m on m.base_id = s.base_id
               join {{pledge}} pp on pp.pledge_id = m.pledge_id where coalesce(m.switch_date, date '1900-01-01') <= @D
               qualify row_number() over (partition by s.pledge_id order by m.level desc, m.pledge_id desc) = 1) bp on bp.pledge_id = p.pledge_id
    where coalesce(p.pledge_id, su.contract_id) is not null"""


_PIVOT = ", ".join(f"min(account_id) filter (base_type_id = {t}) as {c}" for c, t in ACCOUNT_COLUMNS.items())
_ENTRY_ROWS = """select 'MSFO' as source, contract_oid as contract_id, nullif(tranche_oid, '') as issue_id, nullif(portfolio_oid, '') as portfolio_id,
    operation_type, date1 as transaction_date, sum_rub as transaction_sum, acc_number_debet, substring(acc_number_debet, 14, 5) as symbol_debet,
    acc_number_credit, substring(acc_number_credit, 14, 5) as symbol_credit, payment_purpose as description
    from {entry} where date1 = @D and source = 'loan-book' and branch_code = 1"""

_ORDER = ", ".join(f"{c} nulls first" for c in (
    "contract_id", "issue_id", "portfolio_id", "operation_type", "transaction_date", "transaction_sum", "acc_number_debet", "symbol_debet",
    "acc_number_credit", "symbol_credit", "description"))

SQL: dict[str, str] = {
    "S1_scan": "select o_orderkey, o_custkey, o_orderstatus from {orders} where o_orderdate <= @D",
    "S2_read_slice": "select oid, client_oid, number, @D as date1 from {loan_slice}",
    "S3_const_relation": f"select status_name, base_status, count(*) as events from {{guarantee_event}} join {STATUS} on guarantee_status = guarant_status group by all",
    "S4_replace_slice": "select oid, number, '007' as source, case when main_contract_oid is null then date '1998-06-29' else @D end as date1 from {loan_slice}",
    "S4_S8_versions": """
        select oid, 'before' as seen, 1 as refused from {loan_slice}
        union all select oid, 'after', 1 from {loan_slice} where main_contract_oid is not null
        union all select oid || '+', 'after', 1 from {loan_slice} where main_contract_oid is not null""",
    "S5_replace_objects": """
        select s.oid, s.number || case when b.status = 2 then '*' else '' end as number, @D as date1
        from {loan_slice} s left join {base_contract} b on b.contract_id = s.oid
        union all select oid, number, date '1998-06-29' from {loan_slice} where main_contract_oid is null""",
    "S6_replace_dictionary": """select code as id, name as description, 'A' as source from {collateral_source} c
        where collateral_type_id = (select max(collateral_type_id) from {collateral_source} z where z.code = c.code)""",
    "S7_delete_where": "select contract_id, currency from {base_contract} where currency <> '810' or currency is null",
    "S8_append_second_set": "select contract_id as oid, number from {base_contract} union all select issue_id, cast(issue_number as varchar) from {issue}",
    "S9_clear_slice": "select date '1998-06-26' + d as date1, (select count(*) from {loan_slice}) as row_count from (values (1), (2), (3)) t(d)",
    "S10_clear_range": """
        select date '1998-06-26' + d as date1, n as row_count, s as dataset from (values (1), (2), (3), (4)) t(d),
        (select 'loan' as s, count(*) as n from {loan_slice} union all select 'pledge', count(*) from {guarantee_slice}
         union all select 'account_type', count(*) from {guarantee_slice}) where s = 'account_type' or d in (1, 4)""",
    "F1_clear_every_date": """
        select date '1998-06-26' + d as date1, n as row_count, s as dataset from (values (1), (2), (3), (4)) t(d),
        (select 'pledge' as s, count(*) as n from {guarantee_slice} union all select 'account_type', count(*) from {guarantee_slice}) where s = 'account_type' or d > 2""",
    "S11_slice_counts": """select 'loan' as dataset, count(*) as row_count from {loan_slice} union all select 'pledge', count(*) from {guarantee_slice}
        union all select 'account_type', count(*) from {guarantee_slice}""",
    "S12_config_value": "select oid, (select integer_value from {config9} where name = 'InternalBankCode') as bank_code from {client}",
    "S13_default_id": """select contract_id, coalesce(g.product_id, (select product_id from {product} where name = 'Потребительский кредит')) as product_id
        from {contract} join {product_type} using (product_type_id) left join {loan_program} g using (program_id)""",
    "S14_append_audit": "select run_id, count(*) as steps, max(number) as last_number from {step} group by 1",
    "S14_S16_run_log": """
        select run_id, for_date, r.start, nullif(count(s.step_id), 0) as steps, max(s.number) as last_number
        from {run} r left join {step} s using (run_id) where for_date > date '2024-01-10' group by 1, 2, 3""",
    "S15_error_counts": "select r.*, (select count(*) from {step} s where s.run_id = r.run_id and s.status = 0) as error_count from {run} r",
    "S16_retention": "select run_id, count(*) as steps from {step} where run_id in (select run_id from {run} where for_date > date '2024-01-10') group by 1",
    "S17_entries_scan": f"select contract_id, issue_id, portfolio_id, cast(transaction_sum as double) as transaction_sum from ({_ENTRY_ROWS})",
    "S18_presence": """select name, synonym, case when name in (select name from {found}) then 1 else 0 end as present,
        case when name in (select name from {found}) then 0 else 1 end as missing from {expected}""",
    "F1_F2_optional_filter": """select status, count(*) as rows_all, nullif(count(*) filter (oper_day = @D), 0) as rows_day from {status_history} group by 1""",
    "F3_valid_interval": "select contract_id, closed_date from {base_contract} where @D between contract_date and coalesce(closed_date, @D)",
    "F4_half_open_interval": """select contract_id, case when start_date <= @D and @D < coalesce(closed_date, @D + 1) then 1 else 0 end as is_opened,
        case when @D < coalesce(closed_date, @D + 1) then 0 else 1 end as is_closed from {base_contract}""",
    "F5_account_window": """select base_account_id,
        case when cast(date_open as date) <= @D and (date_close is null or cast(date_close as date) >= @D) then 1 else 0 end as open_now,
        case when cast(date_open as date) <= @D and (date_close is null or cast(date_close as date) >= @D - 30) then 1 else 0 end as open_lately
        from {base_account}""",
    "F6_closed_within": """select contract_id, case when coalesce(closed_date, @D) between @D - 30 and @D - 1 then 1 else 0 end as lately,
        case when coalesce(closed_date, @D) between @D and @D - 1 then 1 else 0 end as never from {base_contract}""",
    "F7_account_number": "select base_account_id, number from {base_account} where number is null or (length(number) = 20 and not regexp_matches(number, '[^0-9]'))",
    "F8_in_lists": "select contract_id, contract_type, status from {contract} join {base_contract} using (contract_id) where contract_type in (2, 3, 6, 7) and status not in (0, 3)",
    "F9_like": "select brief, count(*) as registers from {register} join {register_type} using (register_type_id) where brief like 'МСФО9%' group by 1",
    "F10_J5_J6_exists": f"select contract_id, case when {FILTER_ACCOUNTS} then 'with' else 'without' end as side from {{contract}} c",
    "F11_not_in": "select contract_id, contract_type from {contract} where contract_id not in (select contract_id from {issue})",
    "F12_registers_with_history": """select g.register_id, g.register_type_id from {register} g left join {register_rest} r on r.register_id = g.register_id
        and r.oper_day <= @D group by 1, 2 having count(r.register_id) > 0""",
    "F13_portfolios_with_accounts": """select portfolio_id from {portfolio} p where exists (select 1 from {account} a join {base_account} b using (base_account_id)
        where a.portfolio_id = p.portfolio_id and @D between b.date_open and coalesce(b.date_close, @D))""",
    "F14_drop_missing_keys": "select owner, count(*) as payments from {schedule} where date_payment is not null group by 1",
    "F15_inner_by_filter": "select p.portfolio_id, t.name from {portfolio} p left join {portfolio_back_type} t using (back_type_id) where t.begin_date <= @D",
    "F16_final_exclusions": "select register_type_id, count(*) as registers from {register} where register_type_id not in (202, 38, 2) group by 1",
    "P1_expression_blocks": """select issue_id, coalesce(close_date, plan_repayment_date) as close_or_plan,
        case when coalesce(close_date, plan_repayment_date) < @D then 1 else 0 end as is_end,
        case when @D between issue_date and coalesce(close_date, @D) then 1 else 0 end as is_active from {issue}""",
    "P2_Q11_type_links": f"""select k.register_type_id, k.account_type_id, k.priority, g.registers from {LINKS} k
        left join (select register_type_id, count(*) as registers from {{register}} group by 1) g using (register_type_id)""",
    "J1_inner_join": """select l.portfolio_id, c.contract_type, count(*) as contracts from {contract} c join {base_contract} using (contract_id)
        join {loan_contract} l using (contract_id) group by 1, 2""",
    "J2_left_lookup": "select contract_id, p.name as purpose from {contract} left join {loan_purpose} p using (purpose_id)",
    "J3_left_join_filtered": """select distinct l.contract_id, l.pledge_contract_id, p.pledge_id from {pledge_link} l
        left join {pledge} p on p.pledge_contract_id = l.pledge_contract_id and p.pledge_status = 1""",
    "J4_coalesced_key": "select c.contract_id, count(*) as slice_rows from {loan_slice} s join {contract} c on c.contract_id = coalesce(s.main_contract_oid, s.oid) group by 1",
    "J7_asof_portfolio": """select c.contract_id, coalesce((select portfolio_id from {portfolio_history} h where h.contract_id = c.contract_id
        and h.date_begin <= @D order by date_begin desc, portfolio_id desc limit 1), l.portfolio_id) as portfolio_id
        from {contract} c join {loan_contract} l using (contract_id)""",
    "J8_asof_two_orders": """select c.contract_id, h.status, h.oper_day from {contract} c left join (select * from {status_history} where oper_day <= @D
        qualify row_number() over (partition by contract_id order by oper_day desc, date_change desc, seq desc) = 1) h using (contract_id)""",
    "J9_Q2_replanned_dates": f"""
        select distinct 'contract' as level, b.contract_id as oid, b.start_date + n.contract_term as plan_date from {NEXT_CONTRACT} n
        join {{contract}} using (contract_id) join {{base_contract}} b using (contract_id)
        union all select distinct 'tranche', i.issue_id, i.issue_date + n.issue_term from {NEXT_ISSUE} n join {{issue}} i using (issue_id)""",
    "J10_E17_opening_balance": OPENING_BALANCE,
    "J7_J10_carried_balances": OPENING_BALANCE,
    "J1_J10_colocated_tables": OPENING_BALANCE,
    "J7_S10_days_of_a_month": """
        with days as (select cast(unnest(generate_series(date '1998-06-01', date '1998-06-30', interval 1 day)) as date) as day),
        seen as (select g.register_id, g.register_type_id, d.day, r.oper_day, case when r.oper_day = d.day then r.rest_in else r.rest_out end as rest,
                        case when r.oper_day = d.day then r.over_in end as over_in, case when r.oper_day = d.day then r.over_out end as over_out
                 from {register} g cross join days d left join {register_rest} r on r.register_id = g.register_id and r.oper_day <= d.day
                 qualify row_number() over (partition by g.register_id, d.day order by r.oper_day desc) = 1)
        select day, register_type_id, count(*) as registers, cast(coalesce(sum(rest), 0) as double) as rest,
               cast(coalesce(sum(over_in), 0) as double) as over_in, cast(coalesce(sum(over_out), 0) as double) as over_out from seen group by 1, 2""",
    "J11_asof_through_join": f"select contract_id, history_id, base_status, change_type from {LAST_REVISION}",
    "J12_fanout_lookup": f"select p.portfolio_id, o.division_code, o.branch_code from {{portfolio}} p left join {BACK_OFFICE} o using (back_type_id)",
    "J12_checked_and_fanned_out": """select c.contract_id, c.purpose_id, p.name as purpose, i.issue_id from {contract} c
        left join {loan_purpose} p using (purpose_id) left join {issue} i on i.contract_id = c.contract_id""",
    "J13_U4_attach_overdue": f"select c.contract_id, o.principal_from, o.interest_from from {{contract}} c left join {OVERDUE} o using (contract_id)",
    "J14_lateral_aggregate": """select c.contract_id, (select min(issue_date) from {issue} i where i.contract_id = c.contract_id) as date_issue,
        case when (select sum(coalesce(v.base_rate_id, 0) * coalesce(v.rate, 0)) from {issue} i left join {scheme_value} v on v.scheme_id = i.scheme_id
                   where i.contract_id = c.contract_id) > 0 then 1 else 0 end as is_floating from {contract} c""",
    "J15_disjunctive_join": """
        with p as (select g.register_id, a.account_id from {register} g join {account} a on a.portfolio_id = g.portfolio_id
            union select g.register_id, a.account_id from {register} g join {account} a on a.issue_id = g.issue_id
            union select g.register_id, a.account_id from {register} g join {account} a on a.contract_id = g.contract_id)
        select register_id, count(*) as accounts, min(account_id) as first_account from p group by 1""",
    "J16_Q12_forward_match": f"with {MATCH} select register_id, account_id, account_type_id, sub_type, base_type_id, lvl as level from ext",
    "J17_prefer_row": """
        with o as (select account_id, 0 as owner_kind, contract_id as owner_id from {account} union all select account_id, 1, issue_id from {account}
            union all select account_id, 2, portfolio_id from {account})
        select * from o where owner_id is not null qualify row_number() over (partition by account_id order by owner_kind desc) = 1""",
    "J18_Q13_backward_pass": f"with {PAIRS} select * from pub",
    "J19_children": """
        with recursive tree as (
            select operation_id, parent_id, contract_id, 0 as level, type_id, oper_date from {operation} where type_id = 88 and oper_date = @E and status = 1
            union all
            select o.operation_id, o.parent_id, o.contract_id, t.level + 1, o.type_id, o.oper_date from tree t join {operation} o on o.parent_id = t.operation_id
            where t.level < 2 and o.status = 1)
        select * from tree""",
    "J20_parents": """
        with base as (select distinct register_type_id, account_type_id, 0 as priority from {account_register_link}
            where register_type_id in (select register_type_id from {register})),
        one as (select distinct l.parent_id as register_type_id, b.account_type_id, 10 as priority from base b join {register_type_link} l on l.child_id = b.register_type_id),
        two as (select distinct l.parent_id, b.account_type_id, 20 from one b join {register_type_link} l on l.child_id = b.register_type_id)
        select * from base union all select * from one union all select * from two""",
    "J21_chain_latest": """select s.pledge_id, (select m.pledge_id from {pledge_series} m where m.base_id = s.base_id and (m.switch_date is null or m.switch_date <= @D)
        order by m.level desc limit 1) as current_id from {pledge_series} s""",
    "J22_update_from": """select c.oid, case when d.division_id is null then c.branch_code else cast(d.branch_id as smallint) end as branch_code
        from {client} c left join {customer_dim} u on u.customer_id = c.oid left join {division} d on d.division_id = u.division_id""",
    "J23_G3_max_id_per_code": """select c.* from {collateral_source} c join (select max(collateral_type_id) as id from {collateral_source} group by code) m
        on m.id = c.collateral_type_id""",
    "J24_bounded_left_join": """select g.register_id, count(r.oper_day) as days from {register} g left join {register_rest} r on r.register_id = g.register_id
        and r.oper_day <= @D group by 1""",
    "G1_G2_min_dates": """select i.contract_id, min(i.issue_date) as first_issue, (select min(change_date) from {agreement_history} a
        where a.contract_id = i.contract_id and a.change_type = 4 and a.change_date > @D) as next_change from {issue} i group by 1""",
    "G4_W3_Q22_last_runs": """select s.step_id, r.run_id, r.for_date, s.start, s.number, s.target, cast(s.duration as double) as duration, s.status,
        s.record_count, s.error_number, s.error_proc, s.error_message from {run} r join {step} s on s.run_id = r.run_id
        where r.start = (select max(start) from {run} z where z.for_date = r.for_date)""",
    "G5_sum_of_products": "select scheme_id, cast(sum(coalesce(base_rate_id, 0) * coalesce(rate, 0)) as double) as code from {scheme_value} group by 1",
    "G6_grouped_sums": """select register_type_id, contract_id, issue_id, portfolio_id, cast(sum(over_in) as double) as over_in,
        cast(sum(over_out) as double) as over_out, cast(sum(rest_out) as double) as rest_out
        from {register_rest} join {register} using (register_id) group by 1, 2, 3, 4""",
    "G7_G8_counts_having": "select register_id, count(rest_out) as n from {register_rest} where oper_day <= @D group by 1 having count(rest_out) > 1",
    "G9_distinct": "select distinct contract_id, pledge_contract_id from {pledge_link}",
    "G10_Q7_pivot": f"""
        with o as (select a.account_id, a.portfolio_id, b.account_type_id as base_type_id from {{account}} a join {{base_account}} b using (base_account_id)
            where a.portfolio_id in (select portfolio_id from {{portfolio}}) and @D between b.date_open and coalesce(b.date_close, @D))
        select portfolio_id, {_PIVOT} from o where base_type_id in ({", ".join(str(t) for t in sorted(set(ACCOUNT_COLUMNS.values())))}) group by 1""",
    "W1_O1_first_per_key": """select contract_id, operation_id, oper_date from {operation}
        qualify row_number() over (partition by contract_id order by oper_date desc, oper_sum desc, operation_id desc) = 1""",
    "W2_O3_numbered_rows": """select row_number() over (order by contract_oid, tranche_oid, sum_rub, payment_purpose, acc_number_credit, date1) as idx,
        contract_oid, cast(sum_rub as double) as sum_rub from {entry}""",
    "O2_sorted_read": "select date_payment, owner_id, cast(debt_main as double) as debt_main from {schedule} where date_payment is not null order by 1, 2",
    "X1_union_all": f"""
        with r as ({_ENTRY_ROWS})
        select r.contract_id, issue_id, portfolio_id, cast(transaction_sum as double) as transaction_sum from r where contract_id in (select contract_id from {{contract}})
        union all
        select r.contract_id, issue_id, portfolio_id, cast(transaction_sum as double) from r where portfolio_id in (select portfolio_id from {{portfolio}})""",
    "X3_accumulating_inserts": """
        with parts as (select contract_id, 0 as part from {issue} where contract_id is not null
            union all select contract_id, 1 from {agreement_history} where contract_id is not null union all select contract_id, 2 from {contract})
        select contract_id, case min(part) when 0 then 'issue' when 1 then 'change' else 'contract' end as origin,
               case when count(*) > 1 then min(part) end as kept_part, count(*) - 1 as rejected_rows from parts group by 1""",
    "X2_exclusive_union": """
        with z as (
            select distinct x.contract_id, x.pledge_contract_id from {loan_slice} s join {contract} k on k.contract_id = coalesce(s.main_contract_oid, s.oid)
            join {pledge_link} x on x.contract_id = k.contract_id and @D between x.link_date and coalesce(x.expiration_date, @D)
            join {base_contract} c on c.contract_id = x.pledge_contract_id and @D between c.start_date and coalesce(c.closed_date, @D) and c.status not in (0, 3)
            join {pledge_contract} pc on pc.contract_id = c.contract_id)
        select z.contract_id, p.pledge_id as security_id, 'pledge' as kind, o.quality_category as quality from z
        join {pledge} p on p.pledge_contract_id = z.pledge_contract_id and p.pledge_status = 1
        left join {pledge_owner} w using (owner_id) left join {pledge_object} o using (object_id)
        union all
        select z.contract_id, g.contract_id, 'surety', g.quality_category from z join {surety} g on g.contract_id = z.pledge_contract_id
        where not exists (select 1 from {pledge} p where p.pledge_contract_id = z.pledge_contract_id and p.pledge_status = 1)""",
    "E1_E3_E4_E15_E23_contract_flags": """select contract_id, coalesce(schedule_type, 15) as schedule_type, case when contract_type = 6 then 1 else 0 end as is_over,
        case contract_type when 3 then 'ВКЛ' when 2 then 'НКЛ' end as cline_type,
        case when coalesce(currency, '810') = '810' then '643' else currency end as curr, case when currency = '810' then '643' else currency end as curr_raw,
        case when status = 2 then case when contract_type = 3 then 'Цессия' else 'Погашен' end end as reason,
        case branch_id when 0 then 'ф' when 1 then 'ю' else '?' end as letter from {contract} join {base_contract} using (contract_id)""",
    "E2_E5_E11_entry_fields": """select contract_oid, nullif(tranche_oid, '') as issue_id, substring(acc_number_debet, 14, 5) as symbol,
        cast(trunc(sum_rub) as int) as whole, try_cast(tranche_oid as int) as not_a_number from {entry}""",
    "E6_E7_E8_dates": """select contract_id, contract_date + 45 as plus_days, cast(contract_date - interval 12 month as date) as year_back,
        cast(end_date - contract_date as int) as days, coalesce(closed_date, @D) as closed_or_today from {base_contract}""",
    "E8_default_date": """select contract_id, @D as day, date_diff('day', contract_date, @D) as age,
        case when closed_date <= @D then 1 else 0 end as is_closed from {base_contract}""",
    "E10_E12_E13_names": """select contract_id, 'Счет ' || b.number || case when c.name is null then '' else ' (' || trim(c.name) || ')' end as title,
        case when currency is null then '' else currency || '. ' end || upper(substring(lower(b.number), 1, 1)) || substring(lower(b.number), 2) as capital,
        length(rtrim(c.name)) as name_length from {base_contract} b left join {customer_dim} c on c.customer_id = b.client_id""",
    "E16_E21_signed_balances": """select register_id, oper_day, cast(case when day(oper_day) <= 15 then 1 else -1 end * rest_out as double) as ik_val,
        cast(case when day(oper_day) <= 15 then over_in else -over_out end as double) as dk_val,
        cast(case when day(oper_day) <= 15 then -over_out else over_in end as double) as ck_val from {register_rest}""",
    "E18_Q1_eligible_contracts": f"""select contract_id, actual_status, fact_close_date, portfolio_id from {ELIGIBLE}
        where actual_status = 1 or (actual_status = 2 and fact_close_date = @D)""",
    "E19_status_map": f"select guarant_status, m.base_status, count(*) as events from {{guarantee_event}} left join {STATUS} on m.guarantee_status = guarant_status group by all",
    "E20_collateral_value": """select p.pledge_id, cast(case when coalesce(p.fair_value, 0) > 0 then 7
        when p.subsequent = 0 then coalesce(p.collateral_value, 0)
        when coalesce(p.basic_state_date, @D) > @D then coalesce((select q.collateral_value from {pledge_series} s join {pledge_series} m on m.base_id = s.base_id
            join {pledge} q on q.pledge_id = m.pledge_id where s.pledge_id = p.pledge_id and coalesce(m.switch_date, date '1900-01-01') <= @D
            order by m.level desc limit 1), 0) else 0 end as double) as value from {pledge} p""",
    "E22_E24_keys_and_codes": """select register_id, sha256(register_id || '|' || cast(register_type_id as varchar)) as row_key,
        cast(register_type_id as varchar) || case when register_type_id in (113, 114) then 'r' else '' end as account_type from {register}""",
    "U1_division_code": "select contract_id, d.code as division_code from {base_contract} left join {division} d using (division_id)",
    "U2_fact_end": "select contract_id, closed_date as fact_end from {base_contract}",
    "U3_contract_sum": f"select contract_id, cast(amount as double) as amount from {CONTRACT_SUM}",
    "U5_contract_quality": f"select contract_id, cast(reserve_ratio as double) as reserve_ratio, quality_code from {QUALITY.replace('@K', 'contract_id')}",
    "U6_issue_quality": f"select issue_id, cast(reserve_ratio as double) as reserve_ratio, quality_code from {QUALITY.replace('@K', 'issue_id')}",
    "U7_scheme_rate": f"select scheme_id, cast(rate as double) as rate from {RATE}",
    "U8_register_rest": f"select g.contract_id, cast(sum(r.rest_out) as double) as amount from {{register}} g join {LATEST_REST} r using (register_id) where g.register_type_id = 2 and g.contract_id is not null group by 1",
    "U9_schedules_by_owner": "select owner, owner_id, count(date_payment) as payments, cast(sum(debt_main) as double) as debt_main from {schedule} group by 1, 2",
    "U10_mirror_id": "select register_id, reverse(register_id) as mirror from {register}",
    "U11_pledge_series": """
        with recursive chain as (
            select pledge_id, switch_date, pledge_id as base_id, 0 as level from {pledge_chain} where prev_pledge_id is null
            union all
            select c.pledge_id, c.switch_date, t.base_id, t.level + 1 from chain t join {pledge_chain} c on c.prev_pledge_id = t.pledge_id)
        select * from chain""",
    "U11_J21_cycles": """
        with recursive links as (
            select pledge_id, cast(substring(pledge_id, 2) as bigint) as n,
                   case when cast(substring(pledge_id, 2) as bigint) % 40 = 0 then 'p' || cast(cast(substring(pledge_id, 2) as bigint) + 5 as string) else prev_pledge_id end as prev
            from {pledge_chain}),
        closed as (select n as first from links where n % 40 = 0 and n + 5 in (select n from links)),
        chain as (
            select l.pledge_id, coalesce(l.prev, l.pledge_id) as base_id, case when l.prev is null then 0 else 1 end as level from links l
            where l.prev is null or l.prev not in (select pledge_id from links)
            union all
            select c.pledge_id, t.base_id, t.level + 1 from chain t join links c on c.prev = t.pledge_id)
        select pledge_id, base_id, level, cast(null as bigint) as cycle_length, cast(null as int) as on_cycle from chain
        union all
        select l.pledge_id, (select min(b.pledge_id) from links b where b.n between first and first + 5), null, 6, case when l.n <= first + 5 then 1 else 0 end
        from closed join links l on l.n between first and first + 7""",
    "U12_client_rows": "select * exclude (branch_code) replace (cast(rating_internal_score as double) as rating_internal_score) from {client}",
    "Q3_Q4_loans": f"""
        with elig as (select * from {ELIGIBLE} where actual_status = 1 or (actual_status = 2 and fact_close_date = @D))
        {LOANS} union all {TRANCHES}""",
    "Q5_guarantees": f"""
        select @D as date1, 'loan-book' as source, coalesce(coalesce(i.branch_id, b.branch_id), 0) as branch_code, dv.code as division_code,
               c.contract_id as oid, coalesce(i.number, b.number) as number, cu.inn as beneficiary_inn, cu.name as beneficiary_name,
               coalesce(cr.international_code, '643') as curr, coalesce(i.contract_date, b.contract_date) as date_open,
               coalesce(i.end_date, b.end_date) as date_end, coalesce(i.closed_date, b.closed_date) as date_close,
               cast(c.guarant_type as varchar) as type_guarantee, cast(null as double) as comission_rate,
               cast(c.commission_sum as double) as comission_sum, cast(null as double) as comission_rate_year,
               coalesce(i.customer_id, b.client_id) as client_oid, case when c.guarant_kind in (1, 2) then 1 else 0 end as is_line,
               case when c.guarant_kind = 3 then c.line_contract_id end as main_contract_oid,
               (select cast(sum(r.rest_out) as double) from {{register}} g join {LATEST_REST} r using (register_id)
                where g.contract_id = c.contract_id and g.register_type_id = 2) as summa_val,
               cast(q.reserve_ratio as double) as coef_reserve, q.quality_code as category_quality,
               coalesce(ph.portfolio_id, l.portfolio_id) as portfolio_oid
        from {{contract}} c join {{base_contract}} b using (contract_id) join {{loan_contract}} l using (contract_id)
        left join {LAST_REVISION} i on i.contract_id = c.contract_id
        left join {{currency}} cr on cr.code = coalesce(i.currency, b.currency)
        left join {QUALITY.replace("@K", "contract_id")} q on q.contract_id = c.contract_id
        left join (select * from {{portfolio_history}} where date_begin <= @D
                   qualify row_number() over (partition by contract_id order by date_begin desc, portfolio_id desc) = 1) ph on ph.contract_id = c.contract_id
        left join {{division}} dv on dv.division_id = coalesce(i.division_id, b.division_id)
        left join {{customer_dim}} cu on cu.customer_id = c.beneficiary_id
        where c.kind = 2 and coalesce(i.base_status, b.status) in (1, 2) and @D between i.contract_date and coalesce(i.closed_date, @D)""",
    "Q6_portfolios": f"""
        select distinct @D as date1, 'loan-book' as source, coalesce(o.branch_code, 0) as branch_code, o.division_code, p.portfolio_id as oid,
               case when t.name is null then '' else t.name || '. ' end ||
               case when k.name is null then '' else upper(substring(k.name, 1, 1)) || substring(k.name, 2) end as name,
               cast(coalesce(r.ratio, g.max_ratio) as double) as coef_reserve, coalesce(r.code, g.code) as category_quality,
               case t.freeze_client_status when 0 then 'ф' when 1 then 'ю' else '?' end as status, 0 as is_registr, cast(null as varchar) as short_name
        from {{portfolio}} p left join {{portfolio_back_type}} t using (back_type_id) left join {{portfolio_criteria}} k using (criteria_id)
        left join {{risk_group}} g on g.risk_group_id = p.risk_group_id
        left join (select x.portfolio_id, x.ratio, z.code from {{risk_change}} x join {{risk_group}} z using (risk_group_id) where x.action_date <= @D
                   qualify row_number() over (partition by x.portfolio_id order by x.action_date desc, x.change_id desc) = 1) r on r.portfolio_id = p.portfolio_id
        left join {BACK_OFFICE} o on o.back_type_id = p.back_type_id
        where (select count(a.account_id) from {{account}} a join {{base_account}} b using (base_account_id)
               where a.portfolio_id = p.portfolio_id and @D between b.date_open and coalesce(b.date_close, @D)) > 0""",
    "Q8_account_entries": f"select * from {ENTRIES}",
    "Q8_account_entries_lookback": f"""select * from {ENTRIES} union all select c.* from ({CLOSED_ENTRIES}) c
        where not exists (select 1 from (select * from {ENTRIES}) e where e.entry_kind = c.entry_kind and e.entry_id = c.entry_id)""",
    "Q9_register_list": f"""select g.register_id, g.register_type_id, g.portfolio_id, g.contract_id, g.issue_id, g.contract_oid,
        cast(coalesce(case when r.oper_day = @D then r.rest_in else r.rest_out end, 0) as double) as rest,
        cast(coalesce(d.over_in, 0) as double) as over_in, cast(coalesce(d.over_out, 0) as double) as over_out
        from {REGISTERS} g left join {LATEST_REST} r on r.register_id = g.register_id
        left join {{register_rest}} d on d.register_id = g.register_id and d.oper_day = @D""",
    "Q10_account_list": f"""select account_id, account_type_id, number, is_active, entry_kind, entry_id, client_id, branch_code, entry_name, currency, will_close
        from {ACCOUNTS}""",
    "Q14_accounts": f"""
        with {PAIRS},
        det as (select * from accs qualify row_number() over (partition by account_id order by entry_kind desc, entry_id desc) = 1)
        select distinct @D as date1, 'loan-book' as source, a.branch_code, case when p.is_external = 1 then reverse(g.register_id) else g.register_id end as oid,
               a.number, t.name || ' ' || a.entry_name || case when c.name is null then '' else ' (' || trim(c.name) || ')' end as name,
               a.number as number_balance, case when a.entry_kind = 2 then null else g.contract_oid end as contract_oid, a.client_id as client_oid,
               cast(case when a.is_active = 1 then 1 else -1 end * coalesce(case when r.oper_day = @D then r.rest_in else r.rest_out end, 0) as double) as ik_val,
               cast(case when a.is_active = 1 then coalesce(d.over_in, 0) else -coalesce(d.over_out, 0) end as double) as dk_val,
               cast(case when a.is_active = 1 then -coalesce(d.over_out, 0) else coalesce(d.over_in, 0) end as double) as ck_val,
               a.currency as curr, cast(g.register_type_id as varchar) || case when p.is_external = 1 then 'r' else '' end as account_type,
               1 as is_registr, g.portfolio_id as portfolio_oid, cast(null as double) as disposal_val
        from pub p join regs g using (register_id) join {{register_type}} t using (register_type_id) join det a on a.account_id = p.account_id
        left join {{customer_dim}} c on c.customer_id = a.client_id
        left join {LATEST_REST} r on r.register_id = g.register_id
        left join {{register_rest}} d on d.register_id = g.register_id and d.oper_day = @D
        where t.register_type_id <> 38""",
    "Q15_disposal_accounts": """
        with recursive tree as (
            select operation_id, contract_id, oper_date, 0 as level from {operation} where type_id = 88 and oper_date = @E and status = 1
            union all
            select o.operation_id, o.contract_id, o.oper_date, t.level + 1 from tree t join {operation} o on o.parent_id = t.operation_id
            where t.level < 2 and o.status = 1),
        mv as (
            select t.contract_id, t.oper_date, a.account_id, b.number, case when coalesce(b.currency, '810') = '810' then '643' else b.currency end as currency,
                   y.name as type_name, y.kind, case when r.oper_day = @E then r.rest_in else r.rest_out end as rest, r.over_in, r.over_out
            from tree t join {transaction} x on x.operation_id = t.operation_id join {account} a on a.account_id = x.debit_account_id
            join {account_type} y on y.account_type_id = a.account_type_id join {base_account} b using (base_account_id)
            join {movement} m on m.operation_id = t.operation_id join {register} g on g.register_id = m.register_id
            left join (select * from {register_rest} where oper_day <= @E
                       qualify row_number() over (partition by register_id order by oper_day desc) = 1) r on r.register_id = g.register_id
            where y.account_type_id = 10019 and g.register_type_id <> 2),
        s as (
            select account_id, contract_id, number, currency, type_name, oper_date,
                   sum(case when kind = 1 then 1 else -1 end * coalesce(rest, 0)) as ik_val,
                   sum(case when kind = 1 then coalesce(over_in, 0) else -coalesce(over_out, 0) end) as dk_val,
                   sum(case when kind = 1 then -coalesce(over_out, 0) else coalesce(over_in, 0) end) as ck_val
            from mv group by all)
        select @E as date1, 'loan-book' as source, coalesce(cast(n.inner_code as int), 0) as branch_code, s.account_id as oid, s.number,
               s.type_name || ' ' || b.number || case when c.name is null then '' else '(' || trim(c.name) || ')' end as name,
               s.number as number_balance, s.contract_id as contract_oid, b.client_id as client_oid, cast(s.ik_val as double) as ik_val,
               cast(s.dk_val as double) as dk_val, cast(s.ck_val as double) as ck_val, s.currency as curr, '10019' as account_type, 0 as is_registr,
               l.portfolio_id as portfolio_oid, cast(null as double) as disposal_val
        from s join {base_contract} b using (contract_id) join {loan_contract} l using (contract_id)
        left join {branch} n on n.branch_id = b.branch_id left join {customer_dim} c on c.customer_id = b.client_id""",
    "Q16_schedules": """
        with ids as (select distinct c.contract_id, i.issue_id from {loan_slice} s left join {issue} i on i.issue_id = s.oid
            left join {contract} c on c.contract_id = s.oid and c.contract_type not in (2, 3, 6))
        select @D as date1, 'loan-book' as source, p.owner_id as contract_oid, p.date_payment, cast(debt_main as double) as debt_main,
               cast(debt_interest as double) as debt_interest, cast(commissions as double) as commissions, cast(other_payments as double) as other_payments,
               cast(other_expenses as double) as other_expenses, cast(overdue_main as double) as overdue_main,
               cast(overdue_interest as double) as overdue_interest, cast(penalty as double) as penalty
        from ids join {schedule} p on (p.owner = 'issue' and p.owner_id = ids.issue_id) or (p.owner = 'contract' and ids.issue_id is null and p.owner_id = ids.contract_id)
        where p.date_payment is not null""",
    "Q17_clients_by_division": """select @D as date1, 'loan-book' as source, c.* exclude (branch_code) replace (cast(rating_internal_score as double) as rating_internal_score),
        cast(d.branch_id as smallint) as branch_code from {client} c left join {customer_dim} u on u.customer_id = c.oid left join {division} d using (division_id)""",
    "Q17_clients_as_supplied": "select @D as date1, 'loan-book' as source, c.* replace (cast(rating_internal_score as double) as rating_internal_score) from {client} c",
    "Q18_pledges": _pledges(9),
    "Q18_pledges_waterfall": _pledges(12),
    "Q19_table_dictionaries": f"""select 'account_type' as dataset, cast(register_type_id as varchar) as id, name from {{register_type}}
        union all select 'account_type', * from {_rows(RESERVE_TYPES, "a, b", "r")}
        union all select 'loan_type', product_id, name from {{product}} where active = 1
        union all select 'loan_product', product_type_id, name from {{product_type}}
        union all select 'pledge_type', code, name from {{collateral_source}} where collateral_type_id in (select max(collateral_type_id) from {{collateral_source}} group by code)""",
    "Q20_constant_dictionaries": f"""
        select 'schedule_type' as dataset, a as id, b as name, (select count(*) from {{contract}} where coalesce(schedule_type, 15) = a) as uses from {_rows(SCHEDULE_TYPES, "a, b", "r")}
        union all select 'guarantee_type', a, b, (select count(*) from {{contract}} where kind = 2 and guarant_type = a) from {_rows(GUARANTEE_TYPES, "a, b, c", "r")}
        union all select 'segment', a, b, (select count(*) from {{legal_person}} where criterion = a) from {_rows(SEGMENTS, "a, b", "r")}
        union all select 'yul_segment', a, b, (select count(*) from {{legal_person}} where criterion = a) from {_rows(SEGMENTS, "a, b", "r")}""",
    "Q21_corrections": f"""
        with r as (select row_number() over (order by {_ORDER}) as idx, * from ({_ENTRY_ROWS}))
        select * replace (cast(transaction_sum as double) as transaction_sum) from r where contract_id in (select contract_id from {{contract}})
        union all
        select * replace (cast(transaction_sum as double) as transaction_sum) from r where portfolio_id in (select portfolio_id from {{portfolio}})""",
    "Q21_rejected_entries": """select contract_oid, portfolio_oid, date1 from {entry} where (contract_oid <> '' and not regexp_matches(contract_oid, '^[ci][0-9-]+$'))
        or (tranche_oid <> '' and not regexp_matches(tranche_oid, '^[ci][0-9-]+$')) or (portfolio_oid <> '' and not regexp_matches(portfolio_oid, '^[ci][0-9-]+$'))""",
    "Q23_step_audit": """select sha256(r.run_id || '|' || cast(r.number as varchar)) as step_id, r.run_id, r.start, r.number, r.target, date_diff('millisecond', r.start, r.finish) / 1000.0 as duration, r.status,
        case when r.status = 1 then (select count(*) from {step} s where s.target = r.target) else 0 end as record_count from {raw_step} r""",
    "Q24_presence_report": """select e.name, e.synonym, case when f.name is null then 0 else 1 end as present from {expected} e
        left join (select distinct name from {found}) f on f.name = e.name where e.synonym like 'brand%'""",
    "Q25_clear_store": """
        select s as dataset, date '1998-06-26' + d as date1, n as objects from (values (1), (2), (3), (4)) t(d),
        (select 'loan' as s, count(distinct oid) as n from {loan_slice} union all select 'pledge', count(distinct oid) from {guarantee_slice}
         union all select 'account_type', count(distinct oid) from {guarantee_slice}) where s = 'account_type' or d = 2""",
}

ORACLE: dict[str, str] = {
    name: duck_sql(sql).replace("@D", f"date '{ORDER_DAY}'").replace("@E", f"date '{EVENT_DAY}'") for name, sql in SQL.items()
}
