"""The registered queries as plain SQL, for comparison on another engine.

Written from the definitions, not from the DataFrame plans: a merge is the union
of its cases and deduplication a numbered window.
"""

from __future__ import annotations

from ..operators.scd2 import CUSTOMERS
from . import queries as q
from . import workload as w

OPEN = "timestamp '9999-12-31 23:59:59'"


def _window(day: str, runs: tuple[str, ...], i: int | str) -> str:
    if i == w.ALL:
        return "true"
    if i == w.REST:
        return f"{day} >= timestamp '{runs[0]}'"
    tests = []
    if i > 0:
        tests.append(f"{day} >= timestamp '{runs[i - 1]}'")
    if i < len(runs):
        tests.append(f"{day} < timestamp '{runs[i]}'")
    return " and ".join(tests)


def _text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def _customer_rows(i: int | str) -> str:
    return f"""
      select c.c_custkey as customer_id, c.c_name as name,
             lower(replace(c.c_name, '#', '.')) || '@example.com' as email,
             '+1-555-' || lpad(cast(c.c_custkey as varchar), 9, '0') as phone,
             nullif(l.o_orderpriority, '{w.NOT_SPECIFIED}') as address,
             n.n_name as city, r.r_name as state,
             cast(s.signup as date) as signup_date, l.o_orderdate as updated_at
      from customer c
      join (select *, row_number() over (partition by o_custkey
                       order by o_orderdate desc, o_orderkey desc) as rn
            from orders where {_window('o_orderdate', w.CUSTOMER_RUNS, i)}) l
        on l.o_custkey = c.c_custkey and l.rn = 1
      join (select o_custkey, min(case when o_orderpriority <> '{w.NOT_SPECIFIED}'
                                       then o_orderdate end) as signup
            from orders where {_window('o_orderdate', w.CUSTOMER_RUNS, i)}
            group by o_custkey) s on s.o_custkey = c.c_custkey
      join nation n on n.n_nationkey = c.c_nationkey
      join region r on r.r_regionkey = n.n_regionkey"""


def _product_batch(i: int | str) -> str:
    return f"""
      select p.p_partkey as product_id, p.p_name as product_name,
             case when l.l_returnflag <> '{w.NO_CATEGORY_FLAG}' then p.p_type end as category,
             cast(round(cast(p.p_retailprice as decimal(10,2))
                        * (1 - cast(l.l_discount as decimal(4,2))), 2)
                  as decimal(10,2)) as price,
             p.p_size as stock_quantity, f.first_ship as created_at,
             l.l_shipdate as updated_at
      from part p
      join (select *, row_number() over (partition by l_partkey
                       order by l_shipdate desc, l_orderkey desc, l_linenumber desc,
                                l_extendedprice desc, l_discount desc, l_returnflag desc) as rn
            from lineitem where {_window('l_shipdate', w.PRODUCT_RUNS, i)}) l
        on l.l_partkey = p.p_partkey and l.rn = 1
      join (select l_partkey, min(l_shipdate) as first_ship
            from lineitem where {_window('l_shipdate', w.PRODUCT_RUNS, i)}
            group by l_partkey) f on f.l_partkey = p.p_partkey"""


_CUSTOMER = "customer_id, name, email, phone, address, city, state, signup_date"


def _version_key(natural: str, start: str) -> str:
    return f"md5(cast({natural} as varchar) || '_' || {_text(start)})"


def _opened(source: str, start: str) -> str:
    """Rows of a batch as open versions that begin at ``start``."""
    columns = ", ".join(f"n.{c}" for c in _CUSTOMER.split(", "))
    return f"""
      select {_version_key('n.customer_id', start)} as customer_key, {columns},
             {start} as start_date, {OPEN} as end_date, true as is_current, n.updated_at
      from {source}"""


def _merge(
    history: str, batch: str, run: str,
    tracked: tuple[str, ...] = CUSTOMERS.tracked, refresh: bool = False,
) -> str:
    """The union of the five cases of a merge."""
    at = f"timestamp '{run}'"
    changed = "(" + " or ".join(f"h.{c} is distinct from n.{c}" for c in tracked) + ")"
    stored = ", ".join(f"h.{c}" for c in _CUSTOMER.split(", "))
    both = f"{batch} n join {history} h on h.customer_id = n.customer_id and h.is_current"
    if refresh:
        fresh = ", ".join(f"n.{c}" for c in _CUSTOMER.split(", "))
        same = f"""
      select h.customer_key, {fresh}, h.start_date, h.end_date, h.is_current, n.updated_at
      from {both} where not {changed}"""
    else:
        same = f"select h.* from {both} where not {changed}"
    new_start = "cast(n.signup_date as timestamp)"
    return f"""
      select * from {history} where not is_current
      union all
      select h.* from {history} h where h.is_current
         and h.customer_id not in (select customer_id from {batch})
      union all {same}
      union all
      select h.customer_key, {stored}, h.start_date, {at}, false, {at}
      from {both} where {changed}
      union all {_opened(both, at)} where {changed}
      union all {_opened(batch + ' n', new_start)}
      where n.customer_id not in (select customer_id from {history} where is_current)"""


def _upsert(history: str, batch: str) -> str:
    return f"""
      select * from {batch} union all
      select * from {history} where product_id not in (select product_id from {batch})"""


def _fact(bounds_end: str) -> str:
    return f"""
      select o.order_id, c.customer_key, p.product_key,
             cast(strftime(o.order_date, '%Y%m%d') as integer) as order_date_key,
             o.quantity, p.price as price_each, o.total_amount, o.order_status,
             cast(o.order_date as timestamp) as created_at
      from order_batch o
      join dim_customer c on c.customer_id = o.customer_id
       and c.start_date <= o.order_date and o.order_date {bounds_end} c.end_date
      join dim_product p on p.product_id = o.product_id"""


_RUN1, _RUN2 = w.CUSTOMER_RUNS

# Every query starts with this list of definitions and uses some of them.
_WITH = f"""
with customer_rows0 as ({_customer_rows(0)}),
customer_rows1 as ({_customer_rows(1)}),
customer_rows2 as ({_customer_rows(2)}),
customer_rows_all as ({_customer_rows(w.ALL)}),
customer_rows_rest as ({_customer_rows(w.REST)}),
customers_all as (select * from customer_rows_all where signup_date is not null),
customers_rest as (select * from customer_rows_rest where signup_date is not null),
customers0 as (select * from customer_rows0 where signup_date is not null),
customers1 as (select * from customer_rows1 where signup_date is not null),
customers2 as (select * from customer_rows2 where signup_date is not null),
loaded as ({_opened('customers0 n', 'cast(n.signup_date as timestamp)')}),
merged as ({_merge('loaded', 'customers1', _RUN1)}),
dim_customer as ({_merge('merged', 'customers2', _RUN2)}),
loaded_all as ({_opened('customers_all n', 'cast(n.signup_date as timestamp)')}),
merged_rest as ({_merge('loaded', 'customers_rest', _RUN1)}),
by_city as ({_merge('loaded', 'customers_rest', _RUN1, ('city',), refresh=True)}),
outcomes as (
  select coalesce(h.customer_id, n.customer_id) as customer_id,
         case when h.customer_id is null then 'new'
              when n.customer_id is null then 'absent'
              when h.address is distinct from n.address or h.city is distinct from n.city
                or h.state is distinct from n.state then 'changed'
              else 'unchanged' end as outcome
  from (select * from merged where is_current) h
  full join customers2 n on n.customer_id = h.customer_id),
products0 as ({_product_batch(0)}),
products1 as ({_product_batch(1)}),
products2 as ({_product_batch(2)}),
upserted as ({_upsert('products0', 'products1')}),
products_all as ({_product_batch(w.ALL)}),
products_rest as ({_product_batch(w.REST)}),
upserted_rest as ({_upsert('products0', 'products_rest')}),
products_now as ({_upsert('upserted', 'products2')}),
dim_product as (
  select md5(cast(product_id as varchar)) as product_key, * from products_now),
order_lines as (
  select l.l_orderkey * {w.LINES_PER_ORDER} + l.l_linenumber as order_id,
         o.o_custkey as customer_id, l.l_partkey as product_id,
         cast(l.l_quantity as integer) as quantity, cast(o.o_orderdate as date) as order_date,
         cast(l.l_extendedprice as decimal(12,2)) as total_amount,
         o.o_orderstatus as order_status
  from lineitem l join orders o on o.o_orderkey = l.l_orderkey),
order_batch as (
  select * exclude (rn) from (
    select *, row_number() over (partition by order_id
              order by total_amount desc, customer_id desc, product_id desc, quantity desc,
                       order_date desc, order_status desc) as rn from order_lines)
  where rn = 1),
fact as ({_fact('<')}),
fact_closed as ({_fact('<=')}),
calendar as (
  select cast(unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day))
              as date) as day from orders),
dates as (
  select cast(strftime(day, '%Y%m%d') as integer) as date_key, day as date,
         cast(year(day) as integer) as year, cast(quarter(day) as integer) as quarter,
         cast(month(day) as integer) as month, monthname(day) as month_name,
         cast(day(day) as integer) as day, cast(dayofweek(day) + 1 as integer) as day_of_week,
         dayname(day) as day_name, dayofweek(day) in (0, 6) as is_weekend
  from calendar),
line_intervals as (
  select l.l_partkey, l.l_orderkey, o.o_orderdate as start_date,
         case when l.l_returnflag = 'N' then {OPEN} else l.l_shipdate end as end_date,
         l.l_linestatus = 'O' as is_current
  from lineitem l join orders o on o.o_orderkey = l.l_orderkey),
whole_prices as (
  select cast(p_partkey as varchar) as product_id,
         regexp_replace(cast(cast(p_retailprice as decimal(10,2)) as varchar),
                        '\\.00$', '') as whole_price from part)
"""

_VERSION = (
    f"* replace ({_text('start_date')} as start_date, {_text('end_date')} as end_date, "
    f"{_text('updated_at')} as updated_at)"
)
_STAMPED = f"* replace ({_text('updated_at')} as updated_at)"
_PRODUCT = f"* replace ({_text('created_at')} as created_at, {_text('updated_at')} as updated_at)"
_FACT = f"* replace ({_text('created_at')} as created_at)"


def _interval_sql(bounds_end: str = "<", how: str = "join") -> str:
    return f"""select o.o_orderkey as order_id, o.o_custkey as customer_id, v.customer_key
      from orders o {how} dim_customer v on v.customer_id = o.o_custkey
       and v.start_date <= o.o_orderdate and o.o_orderdate {bounds_end} v.end_date"""


def _latest_sql(source: str, columns: str, key: str, order: str) -> str:
    return f"""select {columns} from (
      select *, row_number() over (partition by {key} order by {order}) as rn
      from {source}) where rn = 1"""


_DAILY_SALES = """
  select d.year, d.month, f.order_date_key, c.state as customer_state,
         p.category as product_category, cast(sum(f.quantity) as bigint) as total_items_sold,
         cast(sum(f.total_amount) as decimal(22,2)) as total_sales_usd,
         count(distinct f.order_id) as total_order_count
  from fact f join dim_customer c on c.customer_key = f.customer_key
  join dim_product p on p.product_key = f.product_key
  join dates d on d.date_key = f.order_date_key
  group by d.year, d.month, f.order_date_key, c.state, p.category"""


def _nulls(source: str, columns: tuple[str, ...]) -> str:
    return " union all ".join(
        f"select '{c}' as column_name, count(*) - count({c}) as nulls from {source}"
        for c in columns
    )


def _outcome_sql(name: str) -> str:
    return f"select * from outcomes where outcome = '{name}'"


_BODIES: dict[str, str] = {
    "conform_customers": f"select {_STAMPED} from customers_all",
    "conform_products": f"select {_PRODUCT} from products_all",
    "conform_orders": "select * from order_lines",
    "rejected_customers": f"""
      select * replace (cast(customer_id as varchar) as customer_id,
                        cast(signup_date as varchar) as signup_date,
                        {_text('updated_at')} as updated_at),
             concat_ws(',', case when address is null then 'null_address' end,
                       case when signup_date is null then 'null_signup_date' end) as reject_reason
      from customer_rows_all where signup_date is null or address is null""",
    "malformed_values": """
      select *, 'bad_whole_price' as reject_reason from whole_prices
      where not regexp_full_match(whole_price, '[0-9]+')""",
    "well_formed_values": """
      select cast(product_id as bigint) as product_id, cast(whole_price as integer) as whole_price
      from whole_prices where regexp_full_match(whole_price, '[0-9]+')""",
    "dedup_orders": "select * from order_batch",
    "dedup_customers": _latest_sql(
        "orders",
        f"o_custkey, o_orderkey, o_orderpriority, {_text('o_orderdate')} as o_orderdate",
        "o_custkey", "o_orderdate desc, o_orderkey desc",
    ),
    "dedup_products": _latest_sql(
        "lineitem",
        f"l_partkey, {_text('l_shipdate')} as l_shipdate, l_orderkey, l_linenumber, "
        "l_extendedprice, l_quantity",
        "l_partkey",
        "l_shipdate desc, l_orderkey desc, l_linenumber desc, l_extendedprice desc, "
        "l_quantity desc",
    ),
    "latest_events": _latest_sql(
        "events", "user_id, event_id, event_type, value", "user_id", "ts desc, event_id desc"
    ),
    "pool_customers": f"""
      select {_STAMPED} from (
        select * from customer_rows_rest union all select * from customer_rows0
        where customer_id not in (select customer_id from customer_rows_rest))""",
    "scd2_initial_load": f"select {_VERSION} from loaded_all",
    "scd2_merged": f"select {_VERSION} from merged_rest",
    "scd2_backfill": f"select {_VERSION} from dim_customer",
    "scd2_outcomes": "select * from outcomes",
    "scd2_new_keys": _outcome_sql("new"),
    "scd2_changed_keys": _outcome_sql("changed"),
    "scd2_unchanged_keys": _outcome_sql("unchanged"),
    "scd2_absent_keys": _outcome_sql("absent"),
    "scd2_expired_versions": f"""select {_VERSION} from dim_customer
      where not is_current and end_date = timestamp '{_RUN2}'""",
    "scd2_opened_versions": f"""select {_VERSION} from dim_customer
      where is_current and start_date = timestamp '{_RUN2}'""",
    "scd2_current": f"select {_VERSION} from dim_customer where is_current",
    "scd2_closed": f"select {_VERSION} from dim_customer where not is_current",
    "scd2_overwrite_untracked": f"select {_VERSION} from by_city",
    "scd2_change_feed": f"""
      select n.* replace ({_text('n.updated_at')} as updated_at)
      from customers_rest n left join customers0 b on b.customer_id = n.customer_id
      where b.customer_id is null or b.address is distinct from n.address
         or b.city is distinct from n.city or b.state is distinct from n.state""",
    "scd2_change_feed_by_digest": f"""
      select n.* replace ({_text('n.updated_at')} as updated_at)
      from customers_rest n left join customers0 b on b.customer_id = n.customer_id
      where b.customer_id is null or b.address is distinct from n.address
         or b.city is distinct from n.city or b.state is distinct from n.state""",
    "scd2_states_of_runs": f"""
      select customer_id, customer_key, {_text('start_date')} as start_date, {_text('end_date')} as end_date,
             case when customer_key in (select customer_key from loaded) then date '{w.FIRST_RUN}'
                  when customer_key in (select customer_key from merged) then date '{_RUN1}'
                  else date '{_RUN2}' end as since_run
      from dim_customer""",
    "scd2_tables_of_runs": f"""
      select {_VERSION}, date '{w.FIRST_RUN}' as run_date from loaded
      union all select {_VERSION}, date '{_RUN1}' from merged
      union all select {_VERSION}, date '{_RUN2}' from dim_customer
      where is_current or end_date = timestamp '{_RUN2}'""",
    "as_of_lookup": f"""select {_VERSION} from dim_customer
      where start_date <= timestamp '{q.AS_OF}' and timestamp '{q.AS_OF}' < end_date""",
    "scd1_initial_load": f"""
      select md5(cast(product_id as varchar)) as product_key, {_PRODUCT} from products_all""",
    "scd1_upserted": f"""
      select md5(cast(product_id as varchar)) as product_key, {_PRODUCT} from upserted_rest""",
    "scd1_backfill": f"select {_PRODUCT} from dim_product",
    "interval_join_half_open": _interval_sql(),
    "interval_join_closed": _interval_sql("<="),
    "interval_join_left": _interval_sql(how="left join"),
    "interval_join_swept": _interval_sql(),
    "interval_join_swept_left": _interval_sql(how="left join"),
    "interval_join_by_month": _interval_sql(),
    "interval_join_sliced": _interval_sql(),
    "interval_join_by_year_sliced": _interval_sql(),
    "product_lookup": """
      select l.product_id, l.order_id, l.quantity, p.product_key, p.price
      from order_lines l join dim_product p on p.product_id = l.product_id""",
    "price_totals": """
      select l.order_id, l.product_id, l.quantity, p.price,
             cast(round(p.price * l.quantity, 2) as decimal(18,2)) as total_amount
      from order_lines l join dim_product p on p.product_id = l.product_id""",
    "fact_orders": f"select {_FACT} from fact",
    "fact_orders_sliced": f"select {_FACT} from fact",
    "fact_orders_closed_bounds": f"select {_FACT} from fact_closed",
    "unmatched_orders": """
      select * from (
        select o.*, case when c.customer_key is null then 'no_customer_version'
                         when p.product_id is null then 'unknown_product' end as reject_reason
        from order_batch o
        left join dim_customer c on c.customer_id = o.customer_id
         and c.start_date <= o.order_date and o.order_date < c.end_date
        left join products0 p on p.product_id = o.product_id)
      where reject_reason is not null""",
    "dim_date": "select * from dates",
    "daily_sales_summary": _DAILY_SALES,
    "daily_sales_sliced": _DAILY_SALES,
    "repeated_keys": """select l_orderkey, l_linenumber, count(*) as n from lineitem
      group by l_orderkey, l_linenumber having count(*) > 1""",
    "null_report": _nulls("customer_rows_all", ("customer_id", "address", "city", "signup_date")),
    "length_limits": " union all ".join(
        f"""select '{c}' as column_name, cast(max(length({c})) as integer) as max_length,
            count(*) filter (where length({c}) > {n}) as too_long from conversations"""
        for c, n in (("role", 4), ("text", 255))
    ),
    "decimal_limits": " union all ".join(
        f"""select '{c}' as column_name, count({c}) as present,
            count(*) filter (where {c} is not null and try_cast({c} as {t}) is null) as overflow
            from lineitem"""
        for c, t in (("l_extendedprice", "decimal(6,2)"), ("l_quantity", "decimal(10,2)"))
    ),
    "range_limits": " union all ".join(
        f"""select '{c}' as column_name, count(*) filter (where {c} < {lo}) as below,
            count(*) filter (where {c} > {hi}) as above from orders"""
        for c, lo, hi in (
            ("o_totalprice", "1000", "400000"),
            ("o_orderdate", "timestamp '1995-06-01'", "timestamp '2001-01-01'"),
        )
    ),
    "orphan_values": """select o_custkey, count(*) as n from orders
      where o_custkey not in (select customer_id from customers_all) group by o_custkey""",
    "orphan_documents": """select doc_id, count(*) as n from documents
      where doc_id not in (select doc_id from labels) group by doc_id""",
    "monthly_orders_by_bitmap": """
      select strftime(l_shipdate, '%Y-%m') as month, l_returnflag, count(distinct l_orderkey) as orders
      from lineitem group by 1, 2""",
    "resolved_references": """select o_orderkey, o_custkey from orders
      where o_custkey in (select customer_id from customers_all)""",
    "current_flags": f"""
      select * from (
        select l_orderkey, count(*) filter (where is_current) as current_versions,
               count(*) filter (where is_current <> (end_date = {OPEN})) as flag_mismatches
        from line_intervals group by l_orderkey)
      where current_versions <> 1 or flag_mismatches > 0""",
    "version_continuity": """
      select l_orderkey, chains, repeated_starts, repeated_ends, inverted from (
        select l_orderkey, count(*) filter (where s > 0 and e = 0) as chains,
               count(*) filter (where s > 1) as repeated_starts,
               count(*) filter (where e > 1) as repeated_ends,
               cast(sum(inv) as bigint) as inverted
        from (select l_orderkey, moment, sum(s) as s, sum(e) as e, sum(inv) as inv from (
                select l_orderkey, start_date as moment, 1 as s, 0 as e,
                       case when start_date >= end_date then 1 else 0 end as inv
                from line_intervals
                union all select l_orderkey, end_date, 0, 1, 0 from line_intervals)
              group by l_orderkey, moment)
        group by l_orderkey)
      where chains <> 1 or repeated_starts > 0 or repeated_ends > 0 or inverted > 0""",
    "dimension_checks": f"""
      select 'versions' as table_name, count(*) as n from dim_customer
      union all
      select 'current flag', count(*) from (
        select customer_id from dim_customer group by customer_id
        having count(*) filter (where is_current) <> 1
            or count(*) filter (where is_current <> (end_date = {OPEN})) > 0)
      union all
      select 'continuity', count(distinct customer_id) from (
        select *, lead(start_date) over (partition by customer_id order by start_date) as next
        from dim_customer)
      where start_date >= end_date or next <> end_date""",
    "text_lacks_part": """select doc_id, lang from documents
      where text is null or not contains(text, 'the')""",
    "table_sizes": " union all ".join(
        f"select '{t}' as table_name, count(*) as n from {t}"
        for t in ("customer", "part", "orders", "lineitem")
    ),
    "count_expectations": " union all ".join(
        f"""select '{t}' as table_name, n, cast({least or "null"} as bigint) as least,
          cast({most or "null"} as bigint) as most,
          n >= {least or 0} and n <= {most or 2**62} as met from (select count(*) as n from {t})"""
        for t, (least, most) in q.EXPECTED_ROWS.items()
    ),
    "ordered_ids": f"""
      select {_text('o_orderdate')} as o_orderdate, o_orderkey, o_custkey,
             row_number() over (order by o_orderdate, o_orderkey) + {q.FIRST_ORDER_ID - 1}
               as order_id from orders""",
    "sampled_customers": f"""select c_custkey, c_name from customer
      where cast('0x' || substr(md5('{q.SAMPLE_SEED}_' || c_custkey), 1, 8) as bigint)
            < {int(q.SAMPLE_FRACTION * 2**32)}""",
    "next_ids": """select max(o_orderkey) + 1 as next_order_id,
      count(*) filter (where o_orderstatus = 'P') as pending, count(*) as orders from orders""",
    "date_arithmetic": """
      select l.l_orderkey, l.l_linenumber,
             cast(o.o_orderdate + interval 30 day as date) as due_date,
             cast(datediff('day', o.o_orderdate, l.l_shipdate) as integer) as days_to_ship,
             cast(l.l_shipdate as date) as ship_day,
             cast(strftime(l.l_shipdate, '%Y%m%d') as integer) as ship_date_key
      from lineitem l join orders o on o.o_orderkey = l.l_orderkey""",
}

ORACLES: dict[str, str] = {name: _WITH + body for name, body in _BODIES.items()}
