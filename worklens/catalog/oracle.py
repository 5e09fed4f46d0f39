"""DuckDB oracle SQL for every registered query.

The fixture views of FIXTURES.md §2 are inlined as CTEs (the oracle only sees
the driver's tables).  Where cheap, the oracle follows the reference's literal
shape (three count tables joined by full outer joins, stacked subtotal rows)
rather than our single-pass rewrite, so each comparison also checks that the
rewrite is equivalent.

DuckDB traps handled here: ``count_if``/``sum`` of integers are HUGEINT (cast
to BIGINT); ``dayofweek`` is 0 on Sunday; ``date_diff`` takes (unit, start,
end).
"""

from __future__ import annotations

from worklens.catalog.run import FIXTURE
from worklens.context import RunContext


def _d(x) -> str:
    return f"DATE '{x.isoformat()}'"


def _buyer(nk: str, name: str) -> str:
    return f"concat(lpad(cast({nk} as varchar), 2, '0'), '_', {name})"


def ctes(ctx: RunContext = FIXTURE) -> dict[str, tuple[str, tuple[str, ...]]]:
    """name -> (sql, dependencies), in dependency order."""
    as_of, lo, hi = _d(ctx.as_of), _d(ctx.date_from), _d(ctx.date_to)
    snap = f"TIMESTAMP '{ctx.snapshot.isoformat(sep=' ')}'"
    hist = " union all ".join(f"select {_d(d)} as archive_time" for d in ctx.history_dates)
    statuses = ", ".join(f"'{s}'" for s in ctx.po_statuses)
    min_age, min_amt = ctx.min_age_days, ctx.min_po_amount
    return {
        "buyers_cat": (f"""
            select case n_regionkey when 0 then 'NINV' when 1 then 'SE' when 2 then 'INV'
                        else 'IGNORE' end as category,
                   {_buyer('n_nationkey', 'n_name')} as buyer
            from nation where n_regionkey < 4
            union all select 'SE' as category, '90_IDLE' as buyer
            union all select 'IGNORE' as category, '91_IDLE' as buyer""", ()),
        "orders_b": (f"""
            select o.*, {_buyer('n_nationkey', 'n_name')} as buyer_login
            from orders o join customer on o_custkey = c_custkey
                          join nation on c_nationkey = n_nationkey""", ()),
        "backlog_raw": ("""
            select cast(o_orderkey as varchar) as requisition_id,
                   case when o_orderstatus = 'P' then 'Y' else 'N' end as hold,
                   case when o_orderpriority = '1-URGENT' then 'Requested'
                        when o_orderpriority = '4-NOT SPECIFIED' then null
                        else 'Not Requested' end as out_to_bid,
                   case when o_orderkey % 103 = 0 then null else cast(o_orderdate as date) end
                        as date_of_approval,
                   case when o_orderkey % 97 = 0 then null else buyer_login end as buyer,
                   case when o_orderkey % 101 = 0 then null
                        else cast(cast(o_totalprice * 2 as decimal(18,2)) as double) end as req_total
            from orders_b""", ("orders_b",)),
        "approver_raw": ("""
            select cast(l_orderkey as varchar) as po_no, l_linenumber as line,
                   l_shipdate as date_time,
                   case when l_partkey % 499 = 0 then null
                        else cast(cast(l_extendedprice as decimal(18,2)) as double) end as merch_amt,
                   l_partkey as tie1, l_suppkey as tie2
            from lineitem""", ()),
        "po_data": ("""
            select cast(o_orderkey as varchar) as po_no, o_orderdate as po_date,
                   case o_orderstatus when 'O' then 'A' when 'F' then 'D' else 'X' end as status,
                   buyer_login as buyer, coalesce(n_lines, 0) as n_lines
            from orders_b left join (select l_orderkey, count(*) as n_lines
                                     from lineitem group by l_orderkey) l
                 on l_orderkey = o_orderkey""", ("orders_b",)),
        "po_req": ("""
            select cast(l_orderkey as varchar) as po_no,
                   trim(concat(' R', cast(l_orderkey as varchar), ' ')) as req_id
            from lineitem group by l_orderkey""", ()),
        # Whole documents, latest version: lines in order of their number.
        "po_lines": ("""
            select cast(o_orderkey as varchar) as po_no, o_orderdate as po_date, buyer_login as buyer,
                   o_orderstatus, min(l_linenumber) as first_line, count(l_orderkey) as n_lines
            from orders_b left join lineitem on l_orderkey = o_orderkey
            group by o_orderkey, o_orderdate, buyer_login, o_orderstatus""", ("orders_b",)),
        "req_flat": ("""
            select concat(case when o_orderpriority = '5-LOW' then 'L' else 'R' end,
                          cast(o_orderkey as varchar)) as req_id,
                   concat(cast(cast(o_orderdate as date) as varchar), 'T00:00:00Z') as approved_on,
                   buyer_login as buyer, text as more_info
            from orders_b left join documents on doc_id = o_orderkey""", ("orders_b",)),
        # C-01 / C-02
        "clean": (f"""
            select b.*, c.category as category_dim,
                   cast(date_diff('day', b.date_of_approval, {as_of}) as integer) as age,
                   case when c.category in ('NINV', 'SE', 'INV') then c.category end as category
            from backlog_raw b join buyers_cat c on b.buyer = c.buyer
            where b.date_of_approval >= {lo} and b.date_of_approval <= {hi}""",
                  ("backlog_raw", "buyers_cat")),
        "split": ("""
            select *, case when out_to_bid = 'Requested' then 'out_to_bid'
                           when hold = 'Y' and not (out_to_bid = 'Requested') then 'hold'
                           when hold = 'N' and out_to_bid = 'Not Requested' then 'plain'
                      end as status
            from clean""", ("clean",)),
        # C-03, literal shape: binned plain counts, hold and out-to-bid counts,
        # full outer joins on buyer, NA -> 0, Total, category text from the dimension.
        "age_table": ("""
            select d.category, j.buyer,
                   coalesce(j.b0, 0) as age_0_30, coalesce(j.b30, 0) as age_30_60,
                   coalesce(j.b60, 0) as age_60_90, coalesce(j.b90, 0) as age_90_plus,
                   coalesce(j.hn, 0) as hold_cnt, coalesce(j.obn, 0) as out_to_bid_cnt,
                   coalesce(j.b0, 0) + coalesce(j.b30, 0) + coalesce(j.b60, 0)
                     + coalesce(j.b90, 0) + coalesce(j.hn, 0) + coalesce(j.obn, 0) as total
            from (
              select coalesce(p.buyer, h.buyer, o.buyer) as buyer,
                     p.b0, p.b30, p.b60, p.b90, h.n as hn, o.n as obn
              from (select buyer,
                           count(*) filter (where age >= 0 and age < 30) as b0,
                           count(*) filter (where age >= 30 and age < 60) as b30,
                           count(*) filter (where age >= 60 and age < 90) as b60,
                           count(*) filter (where not (age >= 0 and age < 90)) as b90
                    from split where status = 'plain' group by buyer) p
              full join (select buyer, count(*) as n from split where status = 'hold'
                         group by buyer) h on p.buyer = h.buyer
              full join (select buyer, count(*) as n from split where status = 'out_to_bid'
                         group by buyer) o on coalesce(p.buyer, h.buyer) = o.buyer) j
            left join buyers_cat d on d.buyer = j.buyer""", ("split", "buyers_cat")),
        "amount_table": (f"""
            select d.category, j.buyer,
                   coalesce(j.b0, 0) as amt_lt_250k, coalesce(j.b250, 0) as amt_250k_500k,
                   coalesce(j.b500, 0) as amt_500k_plus,
                   coalesce(j.hn, 0) as hold_cnt, coalesce(j.obn, 0) as out_to_bid_cnt,
                   coalesce(j.b0, 0) + coalesce(j.b250, 0) + coalesce(j.b500, 0)
                     + coalesce(j.hn, 0) + coalesce(j.obn, 0) as total
            from (
              select coalesce(p.buyer, h.buyer, o.buyer) as buyer,
                     p.b0, p.b250, p.b500, h.n as hn, o.n as obn
              from (select buyer,
                           count(*) filter (where req_total >= 0 and req_total < 250000) as b0,
                           count(*) filter (where req_total >= 250000 and req_total < 500000) as b250,
                           count(*) filter (where not (req_total >= 0 and req_total < 500000)) as b500
                    from split where status = 'plain' and age >= {min_age} group by buyer) p
              full join (select buyer, count(*) as n from split
                         where status = 'hold' and age >= {min_age} group by buyer) h
                   on p.buyer = h.buyer
              full join (select buyer, count(*) as n from split
                         where status = 'out_to_bid' and age >= {min_age} group by buyer) o
                   on coalesce(p.buyer, h.buyer) = o.buyer) j
            left join buyers_cat d on d.buyer = j.buyer""", ("split", "buyers_cat")),
        "old_counts": (f"""
            select category, buyer,
                   count(*) filter (where status = 'plain') as actionable_cnt,
                   count(*) filter (where status = 'hold') as on_hold_cnt,
                   count(*) filter (where status = 'out_to_bid') as out_to_bid_cnt
            from split where age >= {min_age} and status is not null
            group by category, buyer""", ("split",)),
        # C-10: keep first row per (po_no, line), sum per PO (null if any null),
        # keep the lowest line's row per PO.
        "prepared": (f"""
            with firsts as (
              select * from (
                select *, row_number() over (partition by po_no, line
                                             order by date_time, tie1, tie2) as rn
                from approver_raw) where rn = 1),
            sums as (
              select po_no, case when count(*) = count(merch_amt)
                                 then cast(sum(cast(merch_amt as decimal(18,2))) as double) end
                                 as sum_of_po_amt
              from firsts group by po_no),
            heads as (
              select * from (
                select po_no, date_time, tie1, tie2,
                       row_number() over (partition by po_no order by line) as rn2
                from firsts) where rn2 = 1)
            select h.po_no, h.date_time, h.tie1, h.tie2, s.sum_of_po_amt,
                   cast(date_diff('day', cast(h.date_time as date), {as_of}) as integer) as age
            from heads h join sums s on h.po_no = s.po_no""", ("approver_raw",)),
        "detail": (f"""
            select p.po_no, p.sum_of_po_amt, p.age as worklist_age, r.req_id as matched,
                   r.approved_on, r.buyer as rbuyer, r.more_info
            from prepared p left join po_req q on p.po_no = q.po_no
                            left join req_flat r on r.req_id = q.req_id
            where p.sum_of_po_amt >= {min_amt}""", ("prepared", "po_req", "req_flat")),
        # Archive history: every status-classified row, replayed at each snapshot
        # date on or after its approval date.
        "archive_backlog": ("""
            select s.requisition_id, s.hold, s.out_to_bid, s.date_of_approval, s.buyer,
                   s.req_total,
                   cast(date_diff('day', s.date_of_approval, a.archive_time) as integer) as age,
                   s.category, a.archive_time, s.status
            from split s join (""" + hist + """) a on s.date_of_approval <= a.archive_time
            where s.status is not null""", ("split",)),
        "archive_worklist": ("""
            select p.po_no, p.date_time, p.tie1, p.tie2, p.sum_of_po_amt,
                   cast(date_diff('day', cast(p.date_time as date), a.archive_time) as integer) as age,
                   a.archive_time
            from prepared p join (""" + hist + """) a on cast(p.date_time as date) <= a.archive_time""",
                             ("prepared",)),
        # Every source column but the last change date; requisition_id is the order's key.
        "snapshot_backlog": (f"""
            select concat('BU', cast(o_orderkey % 7 as varchar)) as business_unit, requisition_id, hold,
                   cast(o_orderdate as date) - cast(o_orderkey % 5 as integer) as requisition_date,
                   left(o_orderpriority, 1) as origin,
                   concat('C', cast(o_custkey as varchar)) as requester, date_of_approval, buyer,
                   buyer_login as buyer_assignment,
                   case when o_orderstatus = 'P' then 'Hold' end as hold_req_process,
                   out_to_bid, req_total, age, category, {snap} as archive_time, status
            from split join orders_b on cast(o_orderkey as varchar) = requisition_id
            where status is not null""", ("split", "orders_b")),
        # The first row of each line (as in prepared), then the lowest line's row of each PO.
        "snapshot_worklist": (f"""
            select concat('U', cast(l_suppkey % 50 as varchar)) as user, l_returnflag as status,
                   concat('O', cast(l_partkey % 20 as varchar)) as oper_id, l_shipdate as date_time,
                   concat('UN', cast(l_orderkey % 7 as varchar)) as unit, p.po_no, l_linestatus as origin,
                   p.tie1, p.tie2, p.sum_of_po_amt, p.age, {snap} as archive_time
            from prepared p join (
              select *, row_number() over (partition by l_orderkey
                                           order by l_linenumber, l_shipdate, l_partkey, l_suppkey) as rn
              from lineitem) l on cast(l_orderkey as varchar) = p.po_no and rn = 1""", ("prepared",)),
        # Throughput
        "po_weeks": (f"""
            select po_no, buyer, n_lines, cast(po_date as date) as d,
                   cast(po_date as date) - cast(dayofweek(cast(po_date as date)) as integer) as week_start
            from po_data
            where po_date > cast({_d(ctx.po_date_after)} as timestamp) and status in ({statuses})""",
                     ("po_data",)),
    }


def with_ctes(body: str, *names: str, extra: dict[str, str] | None = None,
              ctx: RunContext = FIXTURE) -> str:
    """Prefix ``body`` with the named CTEs, everything they depend on, then ``extra``."""
    table = ctes(ctx)
    needed: list[str] = []

    def visit(n: str) -> None:
        if n in needed:
            return
        for dep in table[n][1]:
            visit(dep)
        needed.append(n)

    for n in names:
        visit(n)
    blocks = [(n, table[n][0]) for n in needed] + list((extra or {}).items())
    if not blocks:
        return body.strip()
    parts = ",\n".join(f"{n} as ({sql}\n)" for n, sql in blocks)
    return f"with {parts}\n{body.strip()}"
