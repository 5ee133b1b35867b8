"""ANSI SQL for each registered query, over the same given tables."""

from __future__ import annotations

from stratum.plans.check_catalog import CATALOG
from stratum.registry.params import AS_OF, CUT, CUT_TIME, EARLY_CUT_TIME, NOW, START_DATE

_RAW_ORDERS = """
raw_orders as (
  select
    cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) || '-' || cast(l_partkey as varchar)
      || '-' || cast(l_suppkey as varchar) || '-' || cast(cast(l_shipdate as date) as varchar) as order_id,
    case when o_custkey % 83 = 0 then null when o_custkey % 101 = 0 then cast(-o_custkey as varchar)
         else cast(o_custkey as varchar) end as customer_id,
    cast(l_partkey as varchar) as product_id,
    cast(o_orderdate as date) as order_date,
    case when l_linestatus = 'F' then cast(l_shipdate as date) end as shipped_date,
    case when l_orderkey % 97 = 0 then 0 else cast(l_quantity as integer) end as quantity,
    cast(case when l_orderkey % 89 = 0 then 0
         else cast(cast(p_retailprice as decimal(10,2)) * 0.1 as decimal(10,2)) end as decimal(10,2)) as unit_price,
    cast(cast(l_discount as decimal(5,2)) * 100 as decimal(5,2)) as discount_pct,
    case when o_orderstatus = 'P' and l_returnflag = 'A' then 'cancelled'
         when l_returnflag = 'R' then 'returned'
         when l_returnflag = 'A' and l_linestatus = 'F' then 'delivered'
         when l_returnflag = 'A' and l_linestatus = 'O' then 'shipped'
         when l_returnflag = 'N' and l_linestatus = 'F' then 'confirmed'
         when l_returnflag = 'N' and l_linestatus = 'O' then 'pending' end as status,
    case r_name when 'AMERICA' then 'West' when 'EUROPE' then 'North' when 'ASIA' then 'East'
                when 'AFRICA' then 'South' when 'MIDDLE EAST' then 'International' end as region,
    case substr(o_orderpriority, 1, 1) when '1' then 'direct' when '2' then 'partner' when '3' then 'retail'
                when '4' then 'online' when '5' then 'online' end as channel,
    cast(o_orderdate + interval '30' hour as timestamp) as _loaded_at,
    'orders_' || cast(year(o_orderdate) as varchar) || '.json' as _source_file
  from lineitem
  left join orders on o_orderkey = l_orderkey
  left join part on p_partkey = l_partkey
  left join customer on c_custkey = o_custkey
  left join nation on n_nationkey = c_nationkey
  left join region on r_regionkey = n_regionkey),
stg_orders as (select * from raw_orders)"""

_RAW_CUSTOMERS = """
stg_customers as (
  select
    cast(c_custkey as varchar) as customer_id,
    c_name as customer_name,
    lower(replace(c_name, '#', '.')) || '@example.com' as email,
    n_name as country,
    'CITY_' || cast(c_custkey % 13 as varchar) as city,
    case c_mktsegment when 'MACHINERY' then 'Enterprise' when 'AUTOMOBILE' then 'Enterprise'
                      when 'BUILDING' then 'SMB' when 'FURNITURE' then 'SMB'
                      when 'HOUSEHOLD' then 'Consumer' end as customer_segment,
    date '1992-01-01' + cast(c_custkey % 365 as integer) as signup_date,
    c_acctbal >= 0 as is_active,
    'AM_' || cast(c_custkey % 4 as varchar) as account_manager,
    timestamp '1995-01-01 00:00:00' as _loaded_at
  from customer left join nation on n_nationkey = c_nationkey)"""


def _flagged(source: str, name: str = "flagged") -> str:
    """Derived order columns and the data-quality flag over any typed orders."""
    return f"""
{name} as (
  select
    order_id, customer_id, product_id, order_date, shipped_date, quantity, unit_price, discount_pct,
    status, region, channel,
    cast(quantity * unit_price as decimal(20,2)) as gross_revenue,
    cast(quantity * unit_price * (100 - discount_pct) * 0.01 as decimal(24,6)) as net_revenue,
    cast(quantity * unit_price * discount_pct * 0.01 as decimal(24,6)) as discount_amount,
    cast(date_diff('day', order_date, shipped_date) as integer) as days_to_ship,
    coalesce(shipped_date <= order_date + 2, false) as shipped_on_time,
    cast(date_trunc('month', order_date) as date) as order_month,
    cast(date_trunc('quarter', order_date) as date) as order_quarter,
    cast(year(order_date) as integer) as order_year,
    cast(dayofweek(order_date) as integer) as order_dow,
    case when unit_price <= 0 then 'invalid_price'
         when quantity <= 0 then 'invalid_quantity'
         when customer_id is null then 'missing_customer'
         else 'ok' end as dq_flag,
    _loaded_at
  from {source})"""


def _silver_of(flagged: str, name: str) -> str:
    return f"""
{name} as (
  select
    o.order_id, o.customer_id, o.product_id, o.order_date, o.shipped_date, o.quantity, o.unit_price,
    o.discount_pct, o.status, o.region, o.channel, o.gross_revenue, o.net_revenue, o.discount_amount,
    o.days_to_ship, o.shipped_on_time,
    c.customer_name, c.customer_segment, c.country, c.city, c.account_manager,
    o.order_month, o.order_quarter, o.order_year, o.order_dow, o.dq_flag, o._loaded_at
  from {flagged} o left join stg_customers c on c.customer_id = o.customer_id
  where o.dq_flag = 'ok')"""


_FLAGGED = _flagged("stg_orders")
_CLEAN = "\nclean as (select * from flagged where dq_flag = 'ok')"
_SILVER = _silver_of("flagged", "silver")

# Silver of the orders loaded up to the cut, and what came after the newest of them for keys that it may replace.
_INCREMENTED = f"""
first_load as (select * from silver where _loaded_at <= timestamp '{CUT_TIME}'),
second_load as (select * from silver where _loaded_at > (select max(_loaded_at) from first_load)),
incremented as (
  select * from first_load where order_id not in (select order_id from second_load)
  union all
  select * from second_load)"""


def _monthly(where: str = "", silver: str = "silver") -> str:
    return f"""
monthly as (
  select
    order_month, order_year, customer_segment, region, channel,
    count(distinct order_id) as order_count,
    count(distinct customer_id) as unique_customers,
    cast(sum(quantity) as bigint) as total_units,
    cast(sum(gross_revenue) as decimal(38,2)) as gross_revenue,
    cast(sum(net_revenue) as decimal(38,6)) as net_revenue,
    cast(sum(discount_amount) as decimal(38,6)) as total_discounts,
    cast(sum(net_revenue) as double) / count(net_revenue) as avg_order_value,
    avg(days_to_ship) as avg_days_to_ship,
    cast(sum(case when shipped_on_time then 1 else 0 end) as double) / nullif(count(*), 0) * 100
      as on_time_delivery_pct
  from {silver}
  {where}
  group by all)"""


_MONTHLY = _monthly()
_FROM_START = f"where order_date >= date '{START_DATE}'"
_MONTHLY_FROM_START = _monthly(_FROM_START)

_GROWTH = """
growth as (
  select *,
    cast(net_revenue - prev_month_revenue as decimal(38,6)) as revenue_mom_delta,
    cast(net_revenue - prev_month_revenue as double) / cast(nullif(prev_month_revenue, 0) as double) * 100
      as revenue_mom_growth_pct
  from (
    select *, lag(net_revenue) over (
      partition by customer_segment, region, channel order by order_month) as prev_month_revenue
    from monthly))"""

_METRICS = f"""
metrics as (
  select
    customer_id,
    min(order_date) as first_order_date,
    max(order_date) as last_order_date,
    cast(date_diff('day', min(order_date), max(order_date)) as integer) as customer_tenure_days,
    count(distinct order_id) as lifetime_order_count,
    count(distinct date_trunc('month', order_date)) as active_months,
    cast(sum(gross_revenue) as decimal(38,2)) as lifetime_gross_revenue,
    cast(sum(net_revenue) as decimal(38,6)) as lifetime_net_revenue,
    cast(sum(net_revenue) as double) / count(net_revenue) as avg_order_value,
    max(net_revenue) as max_single_order,
    cast(sum(discount_amount) as decimal(38,6)) as total_discounts_received,
    cast(date_diff('day', max(order_date), date '{AS_OF}') as integer) as days_since_last_order,
    avg(days_to_ship) as avg_days_to_ship,
    cast(sum(case when shipped_on_time then 1 else 0 end) as double) / nullif(count(*), 0) * 100
      as pct_orders_on_time
  from clean
  group by customer_id)"""

_RFM = """
rfm as (
  select customer_id,
    cast(ntile(5) over (order by days_since_last_order asc nulls last, customer_id) as integer) as recency_score,
    cast(ntile(5) over (order by lifetime_order_count asc nulls last, customer_id) as integer) as frequency_score,
    cast(ntile(5) over (order by lifetime_net_revenue asc nulls last, customer_id) as integer) as monetary_score
  from metrics)"""

_CHURN = """case when {0} > 180 then 'high' when {0} > 90 then 'medium' else 'low' end"""
_TIER = """case when {0} > 100000 then 'Platinum' when {0} > 25000 then 'Gold'
                when {0} > 5000 then 'Silver' else 'Bronze' end"""

_CUSTOMER_360 = f"""
customer_360 as (
  select
    cb.customer_id, cb.customer_name, cb.email, cb.customer_segment, cb.country, cb.city, cb.signup_date,
    cb.account_manager, cb.is_active,
    cm.* exclude (customer_id),
    r.recency_score, r.frequency_score, r.monetary_score,
    r.recency_score + r.frequency_score + r.monetary_score as rfm_total,
    {_CHURN.format("cm.days_since_last_order")} as churn_risk,
    {_TIER.format("cm.lifetime_net_revenue")} as customer_tier
  from stg_customers cb
  left join metrics cm on cm.customer_id = cb.customer_id
  left join rfm r on r.customer_id = cb.customer_id)"""

_TO_SILVER = (_RAW_ORDERS, _RAW_CUSTOMERS, _FLAGGED, _SILVER)
_TO_CLEAN = (_RAW_ORDERS, _FLAGGED, _CLEAN)
_TO_METRICS = (*_TO_CLEAN, _METRICS)
_TO_RFM = (*_TO_METRICS, _RFM)
_TO_MONTHLY = (*_TO_SILVER, _MONTHLY)
_TO_GROWTH = (*_TO_MONTHLY, _GROWTH)
_TO_MART = (*_TO_SILVER, _MONTHLY_FROM_START, _GROWTH)
_TO_360 = (_RAW_ORDERS, _RAW_CUSTOMERS, _FLAGGED, _CLEAN, _METRICS, _RFM, _CUSTOMER_360)

# The table a merge leaves: rows loaded by the cut, replaced or joined by the batch.
_MERGED = (
    _RAW_ORDERS,
    _RAW_CUSTOMERS,
    _FLAGGED,
    _SILVER,
    f"""
changed as (
  select * replace (
    cast(case when _loaded_at <= timestamp '{CUT_TIME}' then 0 else discount_pct end as decimal(5,2))
      as discount_pct,
    cast(case when _loaded_at <= timestamp '{CUT_TIME}' then order_date + interval '1' month else order_date end
      as date) as order_date)
  from stg_orders where _loaded_at > timestamp '{EARLY_CUT_TIME}')""",
    _flagged("changed", "changed_flagged"),
    _silver_of("changed_flagged", "batch"),
    f"""
merged as (
  select * from silver
  where _loaded_at <= timestamp '{CUT_TIME}' and order_id not in (select order_id from batch)
  union all select * from batch)""",
)


def _sql(ctes: tuple[str, ...], select: str) -> str:
    return f"with {','.join(ctes)}\n{select}"


def _suite(model: str, source: str, parent: str = "stg_customers") -> str:
    """One row per declared check: (model, column_name, check_type, failures)."""
    parts = []
    for check in CATALOG[model]:
        c = check.column
        if check.kind == "not_null":
            failing = f"select count(*) from {source} where {c} is null"
        elif check.kind == "accepted_values":
            values = ", ".join(f"'{v}'" for v in check.values)
            failing = f"select count(*) from {source} where {c} not in ({values})"
        elif check.kind == "accepted_range":
            tests = []
            if check.minimum is not None:
                tests.append(f"{c} < {check.minimum}")
            if check.maximum is not None:
                tests.append(f"{c} > {check.maximum}")
            failing = f"select count(*) from {source} where {' or '.join(tests)}"
        elif check.kind == "unique":
            failing = (
                f"select count(*) from (select {c} from {source} where {c} is not null "
                f"group by {c} having count(*) > 1)"
            )
        else:
            failing = (
                f"select count(*) from {source} where {c} is not null "
                f"and {c} not in (select {c} from {parent} where {c} is not null)"
            )
        parts.append(
            f"select '{model}' as model, '{c}' as column_name, '{check.kind}' as check_type, "
            f"({failing}) as failures"
        )
    return "\nunion all ".join(parts)


_STORED_SILVER = f"\nstored_silver as (select *, timestamp '{NOW}' as _transformed_at from silver)"
_STORED_360 = f"\nstored_360 as (select *, timestamp '{NOW}' as _refreshed_at from customer_360)"

_HOURS = "cast(date_diff('hour', {0}, {1}) as bigint)"


def _spine(datepart: str) -> str:
    step = "cast(o_orderdate as date)"
    if datepart != "day":
        step = f"cast(date_trunc('{datepart}', o_orderdate) as date)"
    return f"""
with steps as (select {step} as order_date from orders),
spine as (
  select cast(unnest(generate_series(min(order_date), max(order_date), interval '1' {datepart})) as date) as date_day
  from steps),
counts as (select order_date as date_day, count(*) as n from steps group by order_date)
select date_day, coalesce(n, 0) as n_orders from spine left join counts using (date_day)"""


def oracle_sql() -> dict[str, str]:
    all_orders = _sql((_RAW_ORDERS,), "select * from stg_orders")
    all_customers = _sql((_RAW_CUSTOMERS,), "select * from stg_customers")
    one_of = lambda ctes, columns, source: _sql(ctes, f"select {columns} from {source}")
    month = "order_month, customer_segment, region, channel"
    newest_seen = f"(select max(_loaded_at) from stg_orders where order_date < date '{CUT}')"
    return {
        # scans, sources and sinks
        "scan_raw_orders": _sql((_RAW_ORDERS,), "select * from raw_orders"),
        "scan_raw_customers": all_customers,
        "csv_roundtrip": all_orders,
        "json_roundtrip": all_orders,
        "json_quarantine": _sql(
            (_RAW_ORDERS,),
            "select region, count(*) as n_rows, cast(sum(quantity) as bigint) as quantity from stg_orders "
            "where quantity % 10 <> 0 or quantity is null group by region "
            "union all select 'quarantine', count(*), null from stg_orders where quantity % 10 = 0",
        ),
        "view_stg_orders": all_orders,
        "table_full_refresh": _sql((_RAW_ORDERS,), f"select * from stg_orders where order_date >= date '{CUT}'"),
        "clustered_write": one_of(_TO_CLEAN, "*", "clean"),
        "merge_upsert": one_of(_MERGED, "*", "merged"),
        "mart_revenue_incremental": _sql(
            (*_MERGED, _monthly(_FROM_START, "merged"), _GROWTH),
            "select * from growth order by order_month desc nulls first, net_revenue desc nulls first",
        ),
        "mart_customer_360_incremental": one_of(
            (*_MERGED, "\nclean as (select * from merged)", _METRICS, _RFM, _CUSTOMER_360), "*", "customer_360"
        ),
        "incremental_watermark": _sql((_RAW_ORDERS,), f"select * from stg_orders where _loaded_at > {newest_seen}"),
        "full_vs_incremental_equiv": _sql(
            (*_TO_SILVER, _INCREMENTED),
            "select count(f.order_id) as rows_full, count(i.order_id) as rows_incremental, "
            "count(*) filter (where f is distinct from i) as rows_differing "
            "from silver as f full join incremented as i on f.order_id = i.order_id",
        ),
        # projections, casts and filters
        "project_alias": one_of(
            (_RAW_ORDERS,), "order_id as id, product_id as product, quantity * 2 as doubled", "stg_orders"
        ),
        "cast_types": one_of(
            (_RAW_ORDERS,),
            "order_id, order_date, shipped_date, quantity, unit_price, discount_pct, _loaded_at, "
            "cast(quantity as double) as quantity_float, quantity % 2 = 1 as is_odd",
            "stg_orders",
        ),
        "filter_dq_ok": one_of(_TO_CLEAN, "*", "clean"),
        "filter_start_date": _sql((_RAW_ORDERS,), f"select * from stg_orders where order_date >= date '{START_DATE}'"),
        "filter_scalar_subquery": _sql(
            (_RAW_ORDERS,),
            f"select order_id, order_date, _loaded_at from stg_orders where _loaded_at > {newest_seen}",
        ),
        "having_null_pct": _sql(
            (_RAW_ORDERS,),
            "select cast(count(*) filter (where shipped_date is null) as double) / nullif(count(*), 0) as null_pct "
            "from stg_orders having null_pct > 1 - 0.75",
        ),
        "having_stale": _sql(
            (_RAW_ORDERS,),
            f"select {_HOURS.format('max(_loaded_at)', f"timestamp '{NOW}'")} as hours_stale "
            "from stg_orders having hours_stale > 5",
        ),
        # joins
        "join_enrich_left": one_of(
            _TO_SILVER,
            "order_id, customer_id, customer_name, customer_segment, country, city, account_manager",
            "silver",
        ),
        "join_customer_metrics_left": _sql(
            (_RAW_CUSTOMERS, *_TO_METRICS),
            "select customer_id, customer_name, m.* exclude (customer_id) "
            "from stg_customers left join metrics m using (customer_id)",
        ),
        "join_rfm_left": _sql(
            (_RAW_CUSTOMERS, *_TO_RFM),
            "select customer_id, customer_name, recency_score, frequency_score, monetary_score "
            "from stg_customers left join rfm using (customer_id)",
        ),
        # aggregations
        "agg_monthly_segment": one_of(_TO_MONTHLY, "*", "monthly"),
        "agg_customer_metrics": one_of(_TO_METRICS, "*", "metrics"),
        "agg_count_star": _sql((_RAW_ORDERS,), "select status, count(*) as n_orders from stg_orders group by status"),
        "agg_count_distinct": _sql(
            (_RAW_ORDERS,),
            "select channel, count(distinct customer_id) as unique_customers from stg_orders group by channel",
        ),
        "agg_count_distinct_expr": _sql(
            (_RAW_ORDERS,),
            "select customer_id, count(distinct date_trunc('month', order_date)) as active_months "
            "from stg_orders group by customer_id",
        ),
        "agg_sum_int": _sql(
            (_RAW_ORDERS,),
            "select product_id, cast(sum(quantity) as bigint) as total_units from stg_orders group by product_id",
        ),
        "agg_sum_decimal": _sql(
            _TO_CLEAN,
            "select order_year, region, cast(sum(gross_revenue) as decimal(38,2)) as gross_revenue, "
            "cast(sum(net_revenue) as decimal(38,6)) as net_revenue, "
            "cast(sum(discount_amount) as decimal(38,6)) as total_discounts from clean group by order_year, region",
        ),
        "agg_avg_decimal": _sql(
            _TO_CLEAN,
            "select channel, cast(sum(net_revenue) as double) / count(net_revenue) as avg_order_value "
            "from clean group by channel",
        ),
        "agg_avg_int": _sql(
            _TO_CLEAN, "select channel, avg(days_to_ship) as avg_days_to_ship from clean group by channel"
        ),
        "agg_min_max_date": _sql(
            (_RAW_ORDERS,),
            "select customer_id, min(order_date) as first_order_date, max(order_date) as last_order_date "
            "from stg_orders group by customer_id",
        ),
        "agg_max_decimal": _sql(
            _TO_CLEAN, "select customer_id, max(net_revenue) as max_single_order from clean group by customer_id"
        ),
        "agg_conditional_sum": _sql(
            _TO_CLEAN,
            "select channel, cast(sum(case when shipped_on_time then 1 else 0 end) as bigint) as orders_on_time "
            "from clean group by channel",
        ),
        "agg_count_if": _sql(
            (_RAW_ORDERS,),
            "select status, count(*) filter (where shipped_date is null) as unshipped from stg_orders group by status",
        ),
        "agg_on_time_pct": _sql(
            _TO_CLEAN,
            "select region, channel, cast(sum(case when shipped_on_time then 1 else 0 end) as double) "
            "/ nullif(count(*), 0) * 100 as on_time_delivery_pct from clean group by region, channel",
        ),
        "agg_tenure_recency": _sql(
            (_RAW_ORDERS,),
            "select customer_id, "
            "cast(date_diff('day', min(order_date), max(order_date)) as integer) as customer_tenure_days, "
            f"cast(date_diff('day', max(order_date), date '{AS_OF}') as integer) as days_since_last_order "
            "from stg_orders group by customer_id",
        ),
        # windows and sort
        "window_lag_prev_month": one_of(_TO_GROWTH, f"{month}, net_revenue, prev_month_revenue", "growth"),
        "window_mom_delta": one_of(_TO_GROWTH, f"{month}, revenue_mom_delta", "growth"),
        "window_mom_growth_pct": one_of(_TO_GROWTH, f"{month}, revenue_mom_growth_pct", "growth"),
        "window_ntile_recency": one_of(_TO_RFM, "customer_id, recency_score", "rfm"),
        "window_ntile_frequency": one_of(_TO_RFM, "customer_id, frequency_score", "rfm"),
        "window_ntile_monetary": one_of(_TO_RFM, "customer_id, monetary_score", "rfm"),
        "sort_month_revenue_desc": _sql(
            _TO_MONTHLY,
            f"select {month}, net_revenue from monthly "
            "order by order_month desc nulls first, net_revenue desc nulls first",
        ),
        # expressions
        "calc_revenue": one_of(
            (_RAW_ORDERS, _FLAGGED), "order_id, gross_revenue, net_revenue, discount_amount", "flagged"
        ),
        "shipped_on_time": one_of((_RAW_ORDERS, _FLAGGED), "order_id, shipped_on_time", "flagged"),
        "dq_flag": one_of((_RAW_ORDERS, _FLAGGED), "order_id, dq_flag", "flagged"),
        "days_to_ship": one_of((_RAW_ORDERS, _FLAGGED), "order_id, days_to_ship", "flagged"),
        "datediff_hour": _sql(
            (_RAW_ORDERS,),
            "select order_id, "
            + _HOURS.format(
                "cast(shipped_date as timestamp) "
                "+ to_minutes(cast(cast(split_part(order_id, '-', 1) as bigint) % 1440 as integer))",
                "_loaded_at",
            )
            + " as hours from stg_orders",
        ),
        "date_dims": one_of(
            (_RAW_ORDERS, _FLAGGED), "order_id, order_month, order_quarter, order_year, order_dow", "flagged"
        ),
        "churn_risk": _sql(
            (_RAW_ORDERS,),
            f"select customer_id, {_CHURN.format('days')} as churn_risk from ("
            f"select customer_id, date_diff('day', max(order_date), date '{AS_OF}') as days "
            "from stg_orders group by customer_id)",
        ),
        "customer_tier": _sql(
            _TO_CLEAN,
            f"select customer_id, {_TIER.format('revenue')} as customer_tier from ("
            "select customer_id, sum(net_revenue) as revenue from clean group by customer_id)",
        ),
        "rfm_total": one_of(
            _TO_RFM, "customer_id, recency_score + frequency_score + monetary_score as rfm_total", "rfm"
        ),
        "revenue_bands": one_of(
            (_RAW_ORDERS, _FLAGGED),
            "order_id, case when gross_revenue < 1000 then '< $1K' when gross_revenue < 10000 then '$1K–$10K' "
            "when gross_revenue < 100000 then '$10K–$100K' else '> $100K' end as revenue_band",
            "flagged",
        ),
        "safe_divide": one_of(
            (_RAW_ORDERS,),
            "order_id, case when quantity = 0 or quantity is null then null "
            "else cast(unit_price as double) / quantity end as price_per_unit",
            "stg_orders",
        ),
        "surrogate_key": one_of(
            (_RAW_ORDERS,),
            "order_id, md5(coalesce(order_id || '|' || customer_id || '|' || cast(order_date as varchar), '')) "
            "as order_sk",
            "stg_orders",
        ),
        "date_spine_day": _spine("day"),
        "date_spine_month": _spine("month"),
        # models
        "stg_orders": all_orders,
        "stg_customers": all_customers,
        "int_orders_enriched": one_of(_TO_SILVER, "*", "silver"),
        "int_orders_incremental": _sql(
            _TO_SILVER, f"select * from silver where _loaded_at > timestamp '{CUT_TIME}'"
        ),
        "mart_revenue_by_segment": _sql(
            _TO_MART, "select * from growth order by order_month desc nulls first, net_revenue desc nulls first"
        ),
        "mart_customer_360": one_of(_TO_360, "*", "customer_360"),
        "layered_run_summary": _layered_run_summary(),
        "layer_selection_summary": _layered_run_summary(),
        # checks
        "check_unique": "select order_id, count(*) as n_records from ("
        "select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as order_id from lineitem) "
        "where order_id is not null group by order_id having count(*) > 1",
        "check_not_null": _sql(
            (_RAW_ORDERS,), "select order_id, customer_id from stg_orders where customer_id is null"
        ),
        "check_accepted_values": _sql(
            (_RAW_CUSTOMERS,),
            "select customer_id, customer_segment from stg_customers "
            "where customer_segment not in ('Enterprise', 'SMB')",
        ),
        "check_accepted_range": _sql(
            _TO_CLEAN, "select order_id, days_to_ship from clean where days_to_ship < 0 or days_to_ship > 365"
        ),
        "check_relationships": _sql(
            (_RAW_ORDERS, _RAW_CUSTOMERS),
            "select o.customer_id, count(*) as n_records from stg_orders o "
            "left join stg_customers c on c.customer_id = o.customer_id "
            "where o.customer_id is not null and c.customer_id is null group by o.customer_id",
        ),
        "check_not_null_pct": _sql(
            (_RAW_ORDERS,),
            "select cast(count(*) filter (where customer_id is null) as double) / nullif(count(*), 0) as null_pct "
            "from stg_orders having null_pct > 1 - 0.99",
        ),
        "check_freshness_hours": _sql(
            (_RAW_ORDERS,),
            f"select {_HOURS.format('max(_loaded_at)', f"timestamp '{AS_OF} 00:00:00'")} as hours_stale "
            "from stg_orders having hours_stale > 25",
        ),
        "source_freshness": _sql(
            (_RAW_ORDERS,),
            "select 'raw.orders' as source, max_loaded_at, age_seconds, "
            "case when age_seconds is null or age_seconds > 24 * 3600 then 'error' "
            "when age_seconds > 6 * 3600 then 'warn' else 'pass' end as status from ("
            f"select max(_loaded_at) as max_loaded_at, "
            f"date_diff('second', max(_loaded_at), timestamp '{NOW}') as age_seconds from raw_orders)",
        ),
        "check_row_count_growth": _sql(
            _TO_SILVER,
            f"select * from (select 'mart_revenue_by_segment' as model, {_mart_rows(CUT_TIME)} as current_rows, "
            f"{_mart_rows(EARLY_CUT_TIME)} as previous_rows union all select 'mart_customer_360', "
            "(select count(*) from stg_customers), (select count(*) from stg_customers)) "
            "where current_rows <= previous_rows",
        ),
        "dq_suite_shares_and_freshness": _sql(
            (_RAW_ORDERS,),
            "\nunion all ".join(
                f"select 'stg_orders' as model, '{column}' as column_name, '{kind}' as check_type, "
                f"cast({failures} as bigint) as failures from stg_orders"
                for column, kind, failures in (
                    ("customer_id", "not_null", "count(*) - count(customer_id)"),
                    ("customer_id", "not_null_share", _share_above("customer_id", 0.99)),
                    ("shipped_date", "not_null_share", _share_above("shipped_date", 0.75)),
                    ("order_date", "not_null_share", _share_above("order_date", 1)),
                    ("_loaded_at", "fresh", _older_than(25)),
                    ("_loaded_at", "fresh", _older_than(5)),
                )
            ),
        ),
        "join_bucketed_left": _sql(
            (_RAW_ORDERS, _RAW_CUSTOMERS, _FLAGGED, _CLEAN),
            "select o.customer_id, o.order_id, o.net_revenue, c.customer_name, c.customer_segment "
            "from clean o left join stg_customers c on c.customer_id = o.customer_id",
        ),
        "clustered_interleaved": one_of(_TO_CLEAN, "*", "clean"),
        "filter_start_subquery": _sql(
            (*_TO_SILVER, _monthly("where order_date >= (select date_trunc('year', max(order_date)) from silver)"), _GROWTH),
            "select * from growth order by order_month desc nulls first, net_revenue desc nulls first",
        ),
        "dq_suite_source": _sql(
            (_RAW_ORDERS, _RAW_CUSTOMERS),
            _suite("raw_orders", "raw_orders") + "\nunion all " + _suite("raw_customers", "stg_customers"),
        ),
        "dq_suite_bronze": _sql(
            (_RAW_ORDERS, _RAW_CUSTOMERS),
            _suite("stg_orders", "stg_orders") + "\nunion all " + _suite("stg_customers", "stg_customers"),
        ),
        "dq_suite_silver": _sql(
            (*_TO_SILVER, _STORED_SILVER), _suite("int_orders_enriched", "stored_silver")
        ),
        "dq_suite_gold": _sql(
            (*_TO_MART, _CLEAN, _METRICS, _RFM, _CUSTOMER_360, _STORED_360),
            _suite("mart_revenue_by_segment", "growth") + "\nunion all " + _suite("mart_customer_360", "stored_360"),
        ),
    }


def _mart_rows(loaded_by: str) -> str:
    return (
        "(select count(*) from (select distinct order_month, customer_segment, region, channel from silver "
        f"where _loaded_at <= timestamp '{loaded_by}' and order_date >= date '{START_DATE}'))"
    )


def _share_above(column: str, share: float) -> str:
    nulls = f"cast(count(*) - count({column}) as double) / nullif(count(*), 0)"
    return f"coalesce({nulls} > 1 - {share}, false)"


def _older_than(hours: int) -> str:
    return f"coalesce({_HOURS.format('max(_loaded_at)', f"timestamp '{NOW}'")} > {hours}, true)"


def _layered_run_summary() -> str:
    """Rows of the built tables, and every declared check that fails with its number of failures."""
    sources = {
        "raw_orders": "raw_orders",
        "raw_customers": "stg_customers",
        "stg_orders": "stg_orders",
        "stg_customers": "stg_customers",
        "int_orders_enriched": "stored_silver",
        "mart_revenue_by_segment": "growth",
        "mart_customer_360": "stored_360",
    }
    suites = "\nunion all ".join(_suite(model, source) for model, source in sources.items())
    ctes = (*_TO_MART, _STORED_SILVER, _CLEAN, _METRICS, _RFM, _CUSTOMER_360, _STORED_360)
    return _sql(
        (*ctes, f"\nsuites as ({suites})"),
        "select 'rows' as measure, 'silver.int_orders_enriched' as item, count(*) as n from silver\n"
        "union all select 'rows', 'gold.mart_revenue_by_segment', count(*) from growth\n"
        "union all select 'rows', 'gold.mart_customer_360', count(*) from customer_360\n"
        "union all select 'failures', model || '.' || check_type || '_' || column_name, failures "
        "from suites where failures > 0",
    )
