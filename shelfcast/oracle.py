"""DuckDB-runnable SQL that defines the same panel as ``shelfcast.sources.fixture``
and ``shelfcast.operators.clean``; every oracle query starts with ``BASE``.

Views defined: store, facts, history (train), horizon (test), joined, panel
(clean train), open_panel, test_panel (clean horizon).
"""

BASE = """
with store as (
  select s_suppkey as store,
    substr('abcd', cast(s_suppkey % 4 + 1 as int), 1) as store_type,
    substr('abc', cast(s_nationkey % 3 + 1 as int), 1) as assortment,
    case when s_suppkey % 7 = 0 then null else round(abs(s_acctbal), 0) end as competition_distance,
    case when s_suppkey % 5 = 0 then null else cast(s_suppkey % 12 + 1 as int) end as competition_open_since_month,
    case when s_suppkey % 5 = 0 then null else cast(1992 + s_suppkey % 9 as int) end as competition_open_since_year,
    cast(s_suppkey % 2 as int) as promo2,
    case when s_suppkey % 2 = 1 then cast(s_suppkey % 52 + 1 as int) end as promo2_since_week,
    case when s_suppkey % 2 = 1 then cast(1994 + s_suppkey % 6 as int) end as promo2_since_year,
    case when s_suppkey % 2 = 0 then null when s_suppkey % 3 = 0 then 'Jan,Apr,Jul,Oct'
         when s_suppkey % 3 = 1 then 'Feb,May,Aug,Nov' else 'Mar,Jun,Sept,Dec' end as promo_interval
  from supplier),
li as (
  select l_suppkey, cast(l_shipdate as date) as d,
    cast(l_extendedprice * (1 - l_discount) as decimal(18,4)) as net,
    cast(l_quantity as bigint) as qty,
    case when l_discount >= 0.06 then 1 else 0 end as pr
  from lineitem),
agg_li as (
  select l_suppkey, d, cast(sum(net) as double) as net, cast(sum(qty) as bigint) as qty, max(pr) as pr
  from li group by l_suppkey, d),
flagged as (
  select *, case when day(d) % 7 = 0 and l_suppkey % 4 <> 1 then 0
                 when (l_suppkey + day(d)) % 29 = 0 then null else 1 end as op
  from agg_li),
facts as (
  select l_suppkey as store, d as date, cast(isodow(d) as int) as day_of_week,
    case when op = 0 then 0.0 else net end as sales,
    case when op = 0 then cast(0 as bigint) else qty end as customers,
    op as open, pr as promo,
    case when month(d) = 12 and day(d) in (25, 26) then 'c' when day(d) = 1 then 'a'
         when month(d) = 4 and day(d) <= 3 then 'b' else '0' end as state_holiday,
    case when month(d) in (7, 8) then 1 else 0 end as school_holiday
  from flagged),
cutoff as (select max(cast(l_shipdate as date)) - 42 as c from lineitem),
history as (select * from facts where date < (select c from cutoff)),
horizon as (
  select cast(row_number() over (order by store, date) as bigint) as id,
    store, date, day_of_week, open, promo, state_holiday, school_holiday
  from facts where date >= (select c from cutoff)),
joined as (
  select h.*, s.store_type, s.assortment, s.competition_distance, s.competition_open_since_month,
    s.competition_open_since_year, s.promo2, s.promo2_since_week, s.promo2_since_year, s.promo_interval
  from history h left join store s on h.store = s.store),
panel as (
  select store, date, day_of_week, sales, customers, coalesce(open, 1) as open, promo,
    case when state_holiday = '0' then 'None' else coalesce(state_holiday, 'nan') end as state_holiday,
    school_holiday, store_type, assortment,
    coalesce(competition_distance, (select median(competition_distance) from joined)) as competition_distance,
    coalesce(competition_open_since_month, 0) as competition_open_since_month,
    coalesce(competition_open_since_year, 0) as competition_open_since_year,
    promo2,
    coalesce(promo2_since_week, 0) as promo2_since_week,
    coalesce(promo2_since_year, 0) as promo2_since_year,
    coalesce(promo_interval, '') as promo_interval
  from joined),
open_panel as (select * from panel where open = 1 and sales > 0),
test_joined as (
  select h.*, s.store_type, s.assortment, s.competition_distance, s.competition_open_since_month,
    s.competition_open_since_year, s.promo2, s.promo2_since_week, s.promo2_since_year, s.promo_interval
  from horizon h left join store s on h.store = s.store),
test_panel as (
  select id, store, date, day_of_week, coalesce(open, 1) as open, promo,
    case when state_holiday = '0' then 'None' else coalesce(state_holiday, 'nan') end as state_holiday,
    school_holiday, store_type, assortment,
    coalesce(competition_distance, (select median(competition_distance) from test_joined)) as competition_distance,
    coalesce(competition_open_since_month, 0) as competition_open_since_month,
    coalesce(competition_open_since_year, 0) as competition_open_since_year,
    promo2,
    coalesce(promo2_since_week, 0) as promo2_since_week,
    coalesce(promo2_since_year, 0) as promo2_since_year,
    coalesce(promo_interval, '') as promo_interval
  from test_joined)
"""


def q(body: str) -> str:
    """Prefix ``body`` with the base views; a body with its own WITH extends the list."""
    stripped = body.lstrip()
    if stripped[:4].lower() == "with":
        return BASE.rstrip() + ",\n" + stripped[4:]
    return BASE + body
