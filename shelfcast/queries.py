"""Named queries over the driver tables: Spark builders and DuckDB oracle SQL.

Each builder takes (spark, sf_dir) and returns a lazy DataFrame over the
whole tables. ``ORACLE`` holds the equivalent SQL for every query that can be
written in SQL; queries without an entry are checked by row count only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions import calendar as CAL
from shelfcast.functions.aggregates import r6, rnd
from shelfcast.operators import clean as C
from shelfcast.operators import eda as E
from shelfcast.operators import evaluation as EV
from shelfcast.operators import sampling as SP
from shelfcast.operators import scoring as SC
from shelfcast.operators import timeseries as TS
from shelfcast.oracle import q
from shelfcast.plans import ensembles as EN
from shelfcast.plans import features as FE
from shelfcast.plans import models as MD
from shelfcast.session import written
from shelfcast.sources.fixture import Panel, load_panel

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def panels(spark: SparkSession, sf: str, stored: bool = False) -> tuple[Panel, DataFrame, DataFrame]:
    """(inputs, clean panel, open panel). ``stored``: the daily facts are written first, for queries
    that read them several times."""
    p = load_panel(spark, sf, stored=stored)
    panel, open_panel = C.prepare(p.fact, p.store)
    return p, panel, open_panel


def clean_horizon(p: Panel) -> DataFrame:
    from shelfcast.operators.joins import with_store
    return C.clean(with_store(p.horizon, p.store), C.row_weighted_median(p.horizon, p.store))


def test_panel(spark: SparkSession, sf: str) -> DataFrame:
    return clean_horizon(load_panel(spark, sf))


# ---------------------------------------------------------------- loading / cleaning

@register("clean_panel", q("select * from panel"))
def clean_panel(spark, sf):
    return panels(spark, sf)[1]


@register("clean_test_panel", q("select * from test_panel"))
def clean_test_panel(spark, sf):
    return test_panel(spark, sf)


@register("panel_profile", q("""
select cast(count(*) as bigint) as rows, cast(18 as bigint) as columns,
  min(date) as first_date, max(date) as last_date from panel"""))
def panel_profile(spark, sf):
    return C.profile(panels(spark, sf)[1])


@register("null_counts", q("""
select cast(store + date + day_of_week + sales + customers + open + promo + state_holiday + school_holiday + store_type + assortment + competition_distance + competition_open_since_month + competition_open_since_year + promo2 + promo2_since_week + promo2_since_year + promo_interval as bigint) as missing_total, * from (
  select cast(count_if(store is null) as bigint) as store,
    cast(count_if(date is null) as bigint) as date,
    cast(count_if(day_of_week is null) as bigint) as day_of_week,
    cast(count_if(sales is null) as bigint) as sales,
    cast(count_if(customers is null) as bigint) as customers,
    cast(count_if(open is null) as bigint) as open,
    cast(count_if(promo is null) as bigint) as promo,
    cast(count_if(state_holiday is null) as bigint) as state_holiday,
    cast(count_if(school_holiday is null) as bigint) as school_holiday,
    cast(count_if(store_type is null) as bigint) as store_type,
    cast(count_if(assortment is null) as bigint) as assortment,
    cast(count_if(competition_distance is null) as bigint) as competition_distance,
    cast(count_if(competition_open_since_month is null) as bigint) as competition_open_since_month,
    cast(count_if(competition_open_since_year is null) as bigint) as competition_open_since_year,
    cast(count_if(promo2 is null) as bigint) as promo2,
    cast(count_if(promo2_since_week is null) as bigint) as promo2_since_week,
    cast(count_if(promo2_since_year is null) as bigint) as promo2_since_year,
    cast(count_if(promo_interval is null) as bigint) as promo_interval
  from panel) t"""))
def null_counts(spark, sf):
    return C.null_counts(panels(spark, sf)[1])


@register("raw_null_counts", q("""
select cast(count(*) filter (where store_type is null) as bigint) as store_type,
  cast(count(*) filter (where competition_distance is null) as bigint) as competition_distance,
  cast(count(*) filter (where competition_open_since_month is null) as bigint) as competition_open_since_month,
  cast(count(*) filter (where promo2_since_week is null) as bigint) as promo2_since_week,
  cast(count(*) filter (where promo_interval is null) as bigint) as promo_interval,
  cast(count(*) filter (where open is null) as bigint) as open
from joined"""))
def raw_null_counts(spark, sf):
    from shelfcast.operators.joins import with_store
    p = load_panel(spark, sf)
    joined = with_store(p.fact, p.store)
    cols = ["store_type", "competition_distance", "competition_open_since_month",
            "promo2_since_week", "promo_interval", "open"]
    return joined.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


@register("open_filter_counts", q("""
select cast(count(*) as bigint) as rows,
  cast(count_if(open = 1 and sales > 0) as bigint) as kept,
  cast(count_if(not (open = 1 and sales > 0)) as bigint) as removed
from panel"""))
def open_filter_counts(spark, sf):
    return C.open_filter_counts(panels(spark, sf)[1])


@register("store_lookup", q("""
select store, store_type, assortment, competition_distance, promo2 from store
where store in (select distinct store from horizon)"""))
def store_lookup(spark, sf):
    from shelfcast.operators.joins import store_profile
    p = load_panel(spark, sf)
    return store_profile(p.horizon, p.store).select("store", "store_type", "assortment",
                                                    "competition_distance", "promo2")


# ---------------------------------------------------------------- exploratory aggregates

MEAN = "cast(sum(cast({c} as decimal(18,4))) as double) / count({c})"
CMEAN = "cast(sum({c}) as double) / count({c})"


@register("daily_mean_sales", q(f"""
select date, {MEAN.format(c='sales')} as mean_sales from open_panel group by date"""))
def daily_mean_sales(spark, sf):
    return E.daily_mean_sales(panels(spark, sf)[2])


@register("promo_lift", q(f"""
select m0 as mean_no_promo, m1 as mean_promo, (m1 - m0) / m0 * 100 as lift_pct from (
  select {MEAN.format(c='case when promo = 0 then sales end')} as m0,
         {MEAN.format(c='case when promo = 1 then sales end')} as m1 from open_panel) t"""))
def promo_lift(spark, sf):
    return E.promo_lift(panels(spark, sf)[2])


@register("promo_customer_lift", q(f"""
select m0 as mean_no_promo, m1 as mean_promo, (m1 - m0) / m0 * 100 as lift_pct from (
  select {CMEAN.format(c='case when promo = 0 then customers end')} as m0,
         {CMEAN.format(c='case when promo = 1 then customers end')} as m1 from open_panel) t"""))
def promo_customer_lift(spark, sf):
    return E.promo_lift(panels(spark, sf)[2], value="customers")


@register("monthly_mean", q(f"""
select cast(year(date) as int) as year, cast(month(date) as int) as month,
  {MEAN.format(c='sales')} as mean_sales from open_panel group by 1, 2"""))
def monthly_mean(spark, sf):
    return E.monthly_mean(panels(spark, sf)[2])


@register("weekday_mean", q(f"""
with names(idx, weekday) as (values (0, 'Monday'), (1, 'Tuesday'), (2, 'Wednesday'), (3, 'Thursday'),
  (4, 'Friday'), (5, 'Saturday'), (6, 'Sunday')),
a as (select cast(isodow(date) - 1 as int) as idx, {MEAN.format(c='sales')} as mean_sales
      from open_panel group by 1)
select cast(n.idx as int) as idx, n.weekday, a.mean_sales from names n left join a on n.idx = a.idx"""))
def weekday_mean(spark, sf):
    return E.weekday_mean(panels(spark, sf)[2])


@register("store_type_mean", q(f"""
select store_type, {MEAN.format(c='sales')} as mean_sales from open_panel group by 1"""))
def store_type_mean(spark, sf):
    return E.store_type_mean(panels(spark, sf)[2])


@register("assortment_mean", q(f"""
with names(idx, assortment_label) as (values (0, 'Basic'), (1, 'Extra'), (2, 'Extended')),
a as (select case assortment when 'a' then 'Basic' when 'b' then 'Extra' when 'c' then 'Extended' end as lbl,
        {MEAN.format(c='sales')} as mean_sales from open_panel group by 1)
select cast(n.idx as int) as idx, n.assortment_label, a.mean_sales
from names n left join a on n.assortment_label = a.lbl"""))
def assortment_mean(spark, sf):
    return E.assortment_mean(panels(spark, sf)[2])


@register("distance_band_mean", q(f"""
with b as (select *, case when competition_distance > 0 and competition_distance <= 500 then 0
    when competition_distance > 500 and competition_distance <= 1000 then 1
    when competition_distance > 1000 and competition_distance <= 2000 then 2
    when competition_distance > 2000 and competition_distance <= 5000 then 3
    when competition_distance > 5000 then 4 end as idx
  from open_panel where competition_distance is not null)
select idx, (['<500m', '500m-1km', '1-2km', '2-5km', '>5km'])[idx + 1] as band,
  {MEAN.format(c='sales')} as mean_sales from b where idx is not null group by idx"""))
def distance_band_mean(spark, sf):
    return E.distance_band_mean(panels(spark, sf)[2])


@register("promo_share_train_vs_test", q("""
select 'train' as dataset, promo, cast(count(*) as bigint) as rows,
  cast(count(*) as double) * 100.0 / (select count(*) from history) as share_pct
from history group by promo
union all
select 'test' as dataset, promo, cast(count(*) as bigint) as rows,
  cast(count(*) as double) * 100.0 / (select count(*) from horizon) as share_pct
from horizon group by promo"""))
def promo_share_train_vs_test(spark, sf):
    p = load_panel(spark, sf)
    return E.promo_share(p.fact, p.horizon)


@register("spend_median", q("""
with s as (select promo, sales / nullif(cast(customers as double), 0) as spc from open_panel)
select 'all_below_cut' as subset, cast(null as int) as promo, round(median(spc), 6) as median
from s where spc < 3000
union all
select 'by_promo' as subset, cast(promo as int) as promo, round(median(spc), 6) as median
from s group by promo"""))
def spend_median(spark, sf):
    out = E.spend_medians(panels(spark, sf, stored=True)[2], max_spend=3000.0)
    return out.withColumn("median", r6("median"))


@register("spend_hist", q("""
with s as (select sales / nullif(cast(customers as double), 0) as spc from open_panel),
v as (select spc from s where spc < 3000),
m as (select min(spc) as mn, max(spc) as mx from v),
b as (select least(cast(floor((spc - mn) * 50 / (mx - mn)) as int), 49) as bin, count(*) as c from v, m group by 1)
select cast(i as int) as bin, round(mn + i * ((mx - mn) / 50), 6) as lo, round(mn + (i + 1) * ((mx - mn) / 50), 6) as hi,
  cast(coalesce(c, 0) as bigint) as count
from range(0, 50) t(i) left join b on bin = i, m"""))
def spend_hist(spark, sf):
    h = E.spend_histogram(panels(spark, sf, stored=True)[2], max_spend=3000.0, bins=50)
    return h.withColumns({"lo": r6("lo"), "hi": r6("hi")})


@register("distinct_stores", q("select cast(count(distinct store) as bigint) as stores from history"))
def distinct_stores(spark, sf):
    return E.distinct_stores(load_panel(spark, sf).fact)


@register("kpis", q(f"""
select rows, mean_sales, (m1 - m0) / m0 * 100 as lift_pct, stores from (
  select cast(count(*) as bigint) as rows,
    {MEAN.format(c='case when open = 1 and sales > 0 then sales end')} as mean_sales,
    {MEAN.format(c='case when open = 1 and sales > 0 and promo = 1 then sales end')} as m1,
    {MEAN.format(c='case when open = 1 and sales > 0 and promo = 0 then sales end')} as m0,
    cast(count(distinct store) as bigint) as stores
  from panel) t"""))
def kpis(spark, sf):
    return E.kpis(panels(spark, sf)[1])


@register("corr_matrix", q("""
with c as (select corr(sales, cast(customers as double)) as sc, corr(sales, cast(promo as double)) as sp,
    corr(sales, cast(school_holiday as double)) as ss, corr(cast(customers as double), cast(promo as double)) as cp,
    corr(cast(customers as double), cast(school_holiday as double)) as cs,
    corr(cast(promo as double), cast(school_holiday as double)) as ps from open_panel)
select row_var, col_var, round(r, 6) as r from c, (values
  ('sales', 'sales', 1.0), ('sales', 'customers', sc), ('sales', 'promo', sp), ('sales', 'school_holiday', ss),
  ('customers', 'sales', sc), ('customers', 'customers', 1.0), ('customers', 'promo', cp), ('customers', 'school_holiday', cs),
  ('promo', 'sales', sp), ('promo', 'customers', cp), ('promo', 'promo', 1.0), ('promo', 'school_holiday', ps),
  ('school_holiday', 'sales', ss), ('school_holiday', 'customers', cs), ('school_holiday', 'promo', ps),
  ('school_holiday', 'school_holiday', 1.0)) m(row_var, col_var, r)"""))
def corr_matrix(spark, sf):
    return E.corr_matrix(panels(spark, sf)[2]).withColumn("r", r6("r"))


@register("sales_fit_line", q("""
with f as (select regr_slope(sales, cast(customers as double)) as slope,
    regr_intercept(sales, cast(customers as double)) as intercept,
    corr(sales, cast(customers as double)) as r,
    cast(min(customers) as double) as x_min, cast(max(customers) as double) as x_max from open_panel),
g as (select cast(i as int) as i, slope, intercept, r, x_min + i * (x_max - x_min) / 99 as x
      from f, range(0, 100) t(i))
select i, round(slope, 6) as slope, round(intercept, 6) as intercept, round(r, 6) as r, round(x, 6) as x,
  round(round(slope, 6) * round(x, 6) + round(intercept, 6), 4) as y from g"""))
def sales_fit_line(spark, sf):
    out = E.sales_fit_line(panels(spark, sf)[2])
    return out.select("i", r6("slope").alias("slope"), r6("intercept").alias("intercept"), r6("r").alias("r"),
                      r6("x").alias("x"),
                      rnd(r6("slope") * r6("x") + r6("intercept"), 4).alias("y"))


# ---------------------------------------------------------------- features


DATE_FEATURES_SQL = """
cast(year(date) as int) as year, cast(month(date) as int) as month, cast(day(date) as int) as day,
cast(isodow(date) - 1 as int) as day_of_week, cast(weekofyear(date) as int) as week_of_year,
cast(quarter(date) as int) as quarter, cast(isodow(date) - 1 >= 5 as int) as is_weekend,
cast(day(date) <= 5 as int) as is_month_start, cast(day(date) > 5 and day(date) <= 20 as int) as is_month_mid,
cast(day(date) > 20 as int) as is_month_end, cast(weekofyear(date) = 1 as int) as is_year_start,
cast(weekofyear(date) >= 52 as int) as is_year_end"""


def easter_sql(d: str) -> str:
    return (f"case year({d}) when 2013 then date '2013-03-31' when 2014 then date '2014-04-20' "
            f"when 2015 then date '2015-04-05' when 2016 then date '2016-03-27' "
            f"else make_date(year({d}), 4, 1) end")


def xmas_sql(d: str) -> str:
    return (f"cast((case when {d} > make_date(year({d}), 12, 25) then make_date(year({d}) + 1, 12, 25) "
            f"else make_date(year({d}), 12, 25) end) - {d} as int)")


PROMO2_SQL = """case when promo2 = 0 or promo_interval = '' then 0
  else cast(list_contains(list_transform(string_split(promo_interval, ','), lambda t: trim(t)),
       (['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'])[month(date)]) as int) end"""
COMP_SQL = """case when (year(date) - competition_open_since_year) * 12 + (month(date) - competition_open_since_month) is null
  then null else cast(greatest((year(date) - competition_open_since_year) * 12
  + (month(date) - competition_open_since_month), 0) as int) end"""


@register("date_features", q(f"select store, date, {DATE_FEATURES_SQL} from open_panel"))
def date_features(spark, sf):
    op = panels(spark, sf)[2]
    feats = CAL.date_feature_columns("date")
    keep = ["year", "month", "day", "day_of_week", "week_of_year", "quarter", "is_weekend", "is_month_start",
            "is_month_mid", "is_month_end", "is_year_start", "is_year_end"]
    return op.select("store", "date", *[feats[k].alias(k) for k in keep])


@register("holiday_distances", q(f"""
with s as (select store, date, cast(date + interval 216 month as date) as shifted from open_panel)
select store, date, {xmas_sql('date')} as days_to_christmas,
  cast(dayofyear(date) - 1 as int) as days_after_new_year,
  cast(abs({easter_sql('date')} - date) as int) as days_to_easter,
  shifted, {xmas_sql('shifted')} as shifted_days_to_christmas,
  cast(abs({easter_sql('shifted')} - shifted) as int) as shifted_days_to_easter
from s"""))
def holiday_distances(spark, sf):
    op = panels(spark, sf)[2].withColumn("shifted", F.add_months("date", 216))
    return op.select("store", "date", CAL.days_to_christmas("date").alias("days_to_christmas"),
                     CAL.days_after_new_year("date").alias("days_after_new_year"),
                     CAL.days_to_easter("date").alias("days_to_easter"), "shifted",
                     CAL.days_to_christmas("shifted").alias("shifted_days_to_christmas"),
                     CAL.days_to_easter("shifted").alias("shifted_days_to_easter"))


@register("promo2_active", q(f"""
select store, date, promo2, promo_interval, {PROMO2_SQL} as promo2_active from open_panel"""))
def promo2_active(spark, sf):
    op = panels(spark, sf)[2]
    return op.select("store", "date", "promo2", "promo_interval",
                     CAL.promo2_active("promo2", "promo_interval", F.month("date")).alias("promo2_active"))


@register("competition_months", q(f"""
select store, date, {COMP_SQL} as competition_open_months from open_panel"""))
def competition_months(spark, sf):
    op = panels(spark, sf)[2]
    return op.select("store", "date", CAL.competition_open_months(
        F.year("date"), F.month("date"), "competition_open_since_year",
        "competition_open_since_month").alias("competition_open_months"))


@register("engineered_features", q(f"""
select store, open, promo, school_holiday, competition_distance, promo2,
  cast(dense_rank() over (order by state_holiday) - 1 as int) as state_holiday,
  cast(dense_rank() over (order by store_type) - 1 as int) as store_type,
  cast(dense_rank() over (order by assortment) - 1 as int) as assortment,
  {DATE_FEATURES_SQL},
  {xmas_sql('date')} as days_to_christmas, cast(dayofyear(date) - 1 as int) as days_after_new_year,
  cast(abs({easter_sql('date')} - date) as int) as days_to_easter,
  {PROMO2_SQL} as promo2_active, {COMP_SQL} as competition_open_months
from open_panel"""))
def engineered_features(spark, sf):
    op = panels(spark, sf, stored=True)[2].drop("sales", "customers")
    model = FE.FeatureEngineer().fit(op)
    return model.transform(op)


@register("label_encode", q("""
with v as (select list_sort(list_distinct(list(store_type))) as vt, list_sort(list_distinct(list(assortment))) as va,
    list_sort(list_distinct(list(state_holiday))) as vh from open_panel)
select store, date, cast(list_position(vt, store_type) - 1 as int) as store_type_code,
  cast(list_position(va, assortment) - 1 as int) as assortment_code,
  cast(list_position(vh, state_holiday) - 1 as int) as state_holiday_code
from test_panel, v"""))
def label_encode(spark, sf):
    p, _, open_panel = panels(spark, sf, stored=True)
    return FE.label_encode(open_panel, clean_horizon(p))


IMPUTED = ["competition_distance", "competition_open_since_month", "competition_open_since_year",
           "promo2_since_week"]


@register("impute_median", q("select store, date, " + ", ".join(
    f"coalesce(cast({c} as double), (select median({c}) from joined)) as {c}" for c in IMPUTED) + " from joined"))
def impute_median(spark, sf):
    from shelfcast.operators.joins import with_store
    p = load_panel(spark, sf, stored=True)
    joined = with_store(p.fact, p.store)
    return FE.impute_median(joined, IMPUTED).select("store", "date", *IMPUTED)


SCALED = ["sales", "customers", "competition_distance", "promo"]


@register("standard_scale", q("select store, date, " + ", ".join(
    f"round(coalesce((cast({c} as double) - (select avg(cast({c} as double)) from open_panel)) / "
    f"nullif((select stddev_pop(cast({c} as double)) from open_panel), 0), 0), 6) as {c}" for c in SCALED)
    + " from open_panel"))
def standard_scale(spark, sf):
    out = FE.standard_scale(panels(spark, sf, stored=True)[2], SCALED)
    return out.select("store", "date", *[r6(c).alias(c) for c in SCALED])


# ---------------------------------------------------------------- sampling and splitting (K1-K3)


SAMPLE_KEY = "md5(concat_ws('/', store, date, '42'))"


@register("sample_fraction", q(f"""
select store, date, sales from open_panel
qualify row_number() over (order by {SAMPLE_KEY}) <= (select floor(count(*) * 0.2) from open_panel)"""))
def sample_fraction(spark, sf):
    return SP.sample_fraction(panels(spark, sf, stored=True)[2], 0.2).select("store", "date", "sales")


@register("sample_fixed", q(f"""
select store, date, sales from open_panel order by {SAMPLE_KEY} limit 8000"""))
def sample_fixed(spark, sf):
    return SP.sample_fixed(panels(spark, sf, stored=True)[2], 8000).select("store", "date", "sales")


@register("time_split_counts", q("""
with c as (select max(date) - 42 as cutoff from open_panel)
select (select cutoff from c) as cutoff,
  cast(count_if(date < (select cutoff from c)) as bigint) as train_rows,
  cast(count_if(date >= (select cutoff from c)) as bigint) as validation_rows,
  cast(count(distinct case when date >= (select cutoff from c) then date end) as bigint) as validation_dates
from open_panel"""))
def time_split_counts(spark, sf):
    op = panels(spark, sf, stored=True)[2]
    flagged = SP.with_split_flag(op, 6)
    cutoff = op.agg(F.date_sub(F.max("date"), 42)).scalar()
    v = F.col("is_validation") == 1
    return flagged.agg(F.count_if(~v).alias("train_rows"), F.count_if(v).alias("validation_rows"),
                       F.count_distinct(F.when(v, F.col("date"))).alias("validation_dates")) \
        .select(cutoff.alias("cutoff"), "*")


# ---------------------------------------------------------------- evaluation (M3-M12) with a fixed predictor

BASELINE_SQL = f"""
c as (select max(date) - 42 as cutoff from open_panel),
tr as (select * from open_panel where date < (select cutoff from c)),
va as (select * from open_panel where date >= (select cutoff from c)),
sm as (select store, {MEAN.format(c='sales')} as p from tr group by store),
pred as (select va.store, va.date, va.promo, va.sales as y, coalesce(sm.p, 0.0) as p
         from va left join sm on va.store = sm.store)"""
METRICS_SQL = """round(sqrt(avg((y - p) * (y - p))), 6) as rmse, round(avg(abs(y - p)), 6) as mae,
  round(avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16)) * 100, 6) as mape,
  round(sqrt(avg(case when y <> 0 then pow((y - p) / y, 2) end)) * 100, 6) as rmspe,
  round(case when var_pop(y) * count(y) <> 0 then 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y))
       when sum((y - p) * (y - p)) = 0 then 1.0 else 0.0 end, 6) as r2,
  cast(count(*) as bigint) as rows"""


def baseline_predictions(spark, sf, keys=("store",)):
    op = panels(spark, sf, stored=True)[2]
    train, val = SP.time_split(op, 6)
    pred = EV.store_mean_predictions(train, val, keys=list(keys))
    return written(pred.select("store", "date", "promo", F.col("sales").alias("y"), "p"), "baseline")


def _rounded(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: rnd(c, digits) for c in cols})


@register("regression_metrics", q(f"with {BASELINE_SQL} select {METRICS_SQL} from pred"))
def regression_metrics(spark, sf):
    m = EV.regression_metrics(baseline_predictions(spark, sf))
    return _rounded(m, ["rmse", "mae", "mape", "rmspe", "r2"])


@register("regression_metrics_by_promo", q(f"with {BASELINE_SQL} select promo, {METRICS_SQL} from pred group by promo"))
def regression_metrics_by_promo(spark, sf):
    m = EV.regression_metrics(baseline_predictions(spark, sf), by=["promo"])
    return _rounded(m, ["rmse", "mae", "mape", "rmspe", "r2"])


@register("pick_winner", q(f"""
with {BASELINE_SQL},
sp as (select store, promo, {MEAN.format(c='sales')} as p2 from tr group by store, promo),
pred2 as (select va.sales as y, coalesce(sp.p2, 0.0) as p from va left join sp on va.store = sp.store and va.promo = sp.promo),
m as (select 'store_mean' as model, sqrt(avg(case when y <> 0 then pow((y - p) / y, 2) end)) * 100 as rmspe from pred
      union all
      select 'store_promo_mean' as model, sqrt(avg(case when y <> 0 then pow((y - p) / y, 2) end)) * 100 as rmspe from pred2)
select arg_min(model, (rmspe, case when model = 'store_promo_mean' then 0 else 1 end)) as best_model,
  round(min(rmspe), 6) as best_rmspe from m"""))
def pick_winner(spark, sf):
    a = EV.regression_metrics(baseline_predictions(spark, sf)).select(F.lit("store_mean").alias("model"), "rmspe")
    b = EV.regression_metrics(baseline_predictions(spark, sf, keys=("store", "promo"))) \
        .select(F.lit("store_promo_mean").alias("model"), "rmspe")
    return _rounded(EV.pick_winner(a.unionByName(b), preferred_on_tie="store_promo_mean"), ["best_rmspe"])


@register("residuals", q(f"with {BASELINE_SQL} select store, date, y, p, y - p as residual from pred"))
def residuals(spark, sf):
    return EV.residuals(baseline_predictions(spark, sf)).select("store", "date", "y", "p", "residual")


@register("confidence_band", q(f"""
with {BASELINE_SQL}, s as (select stddev_pop(y - p) as sd from pred)
select store, date, round(p - 1.96 * sd, 6) as ci_lo, round(p + 1.96 * sd, 6) as ci_hi,
  cast(y >= p - 1.96 * sd and y <= p + 1.96 * sd as int) as inside from pred, s"""))
def confidence_band(spark, sf):
    b = EV.confidence_band(baseline_predictions(spark, sf))
    return _rounded(b.select("store", "date", "ci_lo", "ci_hi", "inside"), ["ci_lo", "ci_hi"])


@register("coverage", q(f"""
with {BASELINE_SQL}, s as (select stddev_pop(y - p) as sd from pred),
b as (select store, date, cast(y >= p - 1.96 * sd and y <= p + 1.96 * sd as int) as inside from pred, s),
f as (select * from b order by store, date limit 150)
select round((select avg(inside) from f) * 100, 6) as coverage_first_n, 150 as n,
  round((select avg(inside) from b) * 100, 6) as coverage_all"""))
def coverage(spark, sf):
    c = EV.coverage(baseline_predictions(spark, sf), order=["store", "date"], n=150)
    return _rounded(c, ["coverage_first_n", "coverage_all"])


@register("residual_hist", q(f"""
with {BASELINE_SQL}, v as (select y - p as x from pred),
m as (select min(x) as mn, max(x) as mx, count(x) as n from v),
b as (select least(cast(floor((x - mn) * 70 / (mx - mn)) as int), 69) as bin, count(*) as c from v, m group by 1)
select cast(i as int) as bin, round(mn + i * ((mx - mn) / 70), 6) as lo, round(mn + (i + 1) * ((mx - mn) / 70), 6) as hi,
  cast(coalesce(c, 0) as bigint) as count, round(coalesce(c, 0) / (n * ((mx - mn) / 70)), 12) as density
from range(0, 70) t(i) left join b on bin = i, m"""))
def residual_hist(spark, sf):
    h = EV.residual_hist(baseline_predictions(spark, sf), bins=70)
    return h.withColumns({"lo": r6("lo"), "hi": r6("hi"), "density": rnd("density", 12)})


@register("normal_curve", q(f"""
with {BASELINE_SQL}, st as (select avg(y - p) as mu, stddev_pop(y - p) as sigma, min(y - p) as lo, max(y - p) as hi from pred),
g as (select cast(i as int) as i, lo + i * (hi - lo) / 199 as x, mu, sigma from st, range(0, 200) t(i))
select i, round(x, 6) as x, round(exp(-0.5 * ((x - mu) / sigma) * ((x - mu) / sigma)) / (sigma * sqrt(2 * pi())), 12) as pdf
from g"""))
def normal_curve(spark, sf):
    c = EV.normal_curve(baseline_predictions(spark, sf), points=200)
    return c.withColumns({"x": r6("x"), "pdf": rnd("pdf", 12)})


def _poly_sql(coefs, r: str) -> str:
    acc = repr(coefs[0])
    for c in coefs[1:]:
        acc = f"({acc} * {r} + {c!r})"
    return acc


def inv_norm_sql(p: str) -> str:
    """AS 241 as a SQL expression (the oracle's inverse normal; DuckDB has none)."""
    from shelfcast.functions import stats as ST
    q_ = f"({p} - 0.5)"
    rc = f"(0.180625 - {q_} * {q_})"
    rt = f"sqrt(-ln(case when {q_} <= 0 then {p} else 1.0 - {p} end))"
    mid = f"({_poly_sql(ST.AS241_C, f'({rt} - 1.6)')} / {_poly_sql(ST.AS241_D, f'({rt} - 1.6)')})"
    tail = f"({_poly_sql(ST.AS241_E, f'({rt} - 5.0)')} / {_poly_sql(ST.AS241_F, f'({rt} - 5.0)')})"
    outer = f"(case when {rt} <= 5.0 then {mid} else {tail} end)"
    return (f"(case when abs({q_}) <= 0.425 then {q_} * {_poly_sql(ST.AS241_A, rc)} / {_poly_sql(ST.AS241_B, rc)} "
            f"when {q_} < 0 then -{outer} else {outer} end)")


@register("qq_points", q(f"""with {BASELINE_SQL},
res as (select y - p as v from pred where y - p is not null),
rk as (select v, row_number() over (order by v) as i, count(*) over () as n from res),
mm as (select i, v, case when i = n then pow(0.5, 1.0 / n) when i = 1 then 1 - pow(0.5, 1.0 / n)
                    else (i - 0.3175) / (n + 0.365) end as m from rk),
pts as (select i, v as ordered, {inv_norm_sql('m')} as theoretical from mm),
fit as (select regr_slope(ordered, theoretical) as slope, regr_intercept(ordered, theoretical) as intercept,
        corr(ordered, theoretical) as r from pts)
select cast(i as bigint) as i, round(theoretical, 9) as theoretical, ordered, round(slope, 6) as slope,
  round(intercept, 6) as intercept, round(r, 6) as r from pts, fit"""))
def qq_points(spark, sf):
    out = EV.qq_points(baseline_predictions(spark, sf))
    return out.select(F.col("i").cast("bigint").alias("i"), rnd("theoretical", 9).alias("theoretical"), "ordered",
                      r6("slope").alias("slope"), r6("intercept").alias("intercept"), r6("r").alias("r"))


# ---------------------------------------------------------------- time series (TS1-TS10, K4)


SERIES_SQL = f"""
open_rows as (select * from panel where open = 1),
daily as (select store, date, {MEAN.format(c='sales')} as y from open_rows group by store, date),
bounds as (select store, min(date) as d0, max(date) as d1 from daily group by store),
spine as (select store, cast(unnest(generate_series(d0, d1, interval 1 day)) as date) as date from bounds),
resampled as (select spine.store, spine.date, daily.y from spine left join daily
              on spine.store = daily.store and spine.date = daily.date),
nb as (select *,
  last_value(y ignore nulls) over (partition by store order by date rows between unbounded preceding and current row) as pv,
  last_value(case when y is not null then date end ignore nulls) over (partition by store order by date rows between unbounded preceding and current row) as pdt,
  first_value(y ignore nulls) over (partition by store order by date rows between current row and unbounded following) as nv,
  first_value(case when y is not null then date end ignore nulls) over (partition by store order by date rows between current row and unbounded following) as ndt
  from resampled),
ser as (select store, date, round(case when y is not null then y when pv is null then nv when nv is null then pv
  else pv + (nv - pv) * (cast(date - pdt as double) / cast(ndt - pdt as double)) end, 6) as y from nb),
sert as (select *, cast(row_number() over (partition by store order by date) as int) as t from ser)"""


def rounded_series(spark, sf) -> DataFrame:
    return TS.store_series(panels(spark, sf)[1]).withColumn("y", r6("y"))


@register("daily_resample", q(f"with {SERIES_SQL} select store, date, y from resampled"))
def daily_resample(spark, sf):
    return TS.daily_series(panels(spark, sf)[1])


@register("interpolate", q(f"with {SERIES_SQL} select store, date, y from ser"))
def interpolate(spark, sf):
    return rounded_series(spark, sf).select("store", "date", "y")


@register("interpolate_nulls", q(f"with {SERIES_SQL} select store, date, y from ser"))
def interpolate_nulls(spark, sf):
    """TS2 as a separate step over TS1's null days (the window form)."""
    s = TS.interpolate(TS.daily_series(panels(spark, sf)[1]))
    return s.select("store", "date", r6("y").alias("y"))


@register("first_difference", q(f"""with {SERIES_SQL}
select store, date, diff from (select store, date, round(y - lag(y) over (partition by store order by date), 6) as diff
  from ser) d where diff is not null"""))
def first_difference(spark, sf):
    return TS.first_difference(rounded_series(spark, sf)).select("store", "date", r6("diff").alias("diff"))


@register("dickey_fuller_lag0", q(f"""with {SERIES_SQL},
l as (select store, y - lag(y) over (partition by store order by date) as dy,
      lag(y) over (partition by store order by date) as yl from ser),
a as (select store, regr_slope(dy, yl) as b, regr_sxx(dy, yl) as sxx, regr_syy(dy, yl) as syy,
      regr_count(dy, yl) as n from l where dy is not null group by store)
select store, cast(n as bigint) as n, round(b / sqrt((syy - b * b * sxx) / (n - 2) / sxx), 4) as df_stat from a"""))
def dickey_fuller_lag0(spark, sf):
    return TS.dickey_fuller_lag0(rounded_series(spark, sf)).withColumn("df_stat", rnd("df_stat", 4))


ACF_SQL = f"""{SERIES_SQL},
s2 as (select store, t, y - avg(y) over (partition by store) as d from sert where y is not null),
lg as (select store, d, {", ".join(f"lag(d, {k}) over w as l{k}" for k in range(1, 41))}
       from s2 window w as (partition by store order by t)),
sums as (select store, count(*) as n, sum(d * d) as c0, [{", ".join(f"coalesce(sum(d * l{k}), 0.0)" for k in range(1, 41))}] as ck
         from lg group by store),
r as (select store, n, 0 as lag, 1.0::double as acf from sums
      union all
      select store, n, k as lag, ck[k] / c0 as acf from sums, range(1, 41) t(k))"""


@register("acf", q(f"""with {ACF_SQL},
b as (select *, coalesce(sum(case when lag >= 1 then acf * acf end) over (partition by store order by lag
      rows between unbounded preceding and 1 preceding), 0.0) as cum from r)
select store, cast(n as bigint) as n, cast(lag as int) as lag, round(acf, 6) as acf,
  round(1.96 * sqrt(case when lag = 0 then 0.0 when lag = 1 then 1.0 / n else (1 + 2 * cum) / n end), 6) as band
from b"""))
def acf(spark, sf):
    a = TS.acf(rounded_series(spark, sf), nlags=40)
    return a.select("store", "n", "lag", r6("acf").alias("acf"), r6("band").alias("band"))


PACF_STEP = "((r[k + 2] - list_sum(list_transform(phi, lambda y, j: y * r[k + 2 - j]))) / v)"


@register("pacf", "with recursive " + q(f"""with {ACF_SQL},
rl as (select store, n, list(acf order by lag) as r from r group by store, n),
dl as (
  select store, n, r, 1 as k, [r[2]] as phi, 1.0 - r[2] * r[2] as v, r[2] as pk from rl
  union all
  select store, n, r, k + 1 as k,
    list_transform(phi, lambda x, i: x - {PACF_STEP} * phi[k + 1 - i]) || [{PACF_STEP}] as phi,
    v * (1 - {PACF_STEP} * {PACF_STEP}) as v, {PACF_STEP} as pk
  from dl where k < 40)
select store, 0 as lag, 1.0::double as pacf, 0.0::double as band from rl
union all
select store, cast(k as int) as lag, round(pk, 6) as pacf, round(1.96 / sqrt(n), 6) as band from dl""").replace(
    "\nwith store as", "\nstore as", 1))
def pacf(spark, sf):
    """TS6 (Durbin-Levinson per store); the oracle runs the same recursion as a recursive CTE."""
    out = TS.pacf(TS.acf(rounded_series(spark, sf), nlags=40))
    return out.select("store", "lag", r6("pacf").alias("pacf"), r6("band").alias("band"))


def eliminated(name: str, source: str, steps: str, both_ways: bool = False) -> str:
    """Recursive CTE: after k steps, ``g`` (a k_all x k_all list) without what its first k variables explain.

    ``both_ways`` clears the rows above the pivot as well (Gauss-Jordan)."""
    other = "x // k_all <> k" if both_ways else "x // k_all > k and x % k_all > k"
    return f"""{name} as (
  select store, 0 as k, k_all, {steps} as steps, g from {source}
  union all
  select store, k + 1, k_all, steps, list_transform(range(0, k_all * k_all), lambda x: case when {other}
    then g[x + 1] - g[x // k_all * k_all + k + 1] * g[k * k_all + x % k_all + 1] / g[k * k_all + k + 1] else g[x + 1] end)
  from {name} where k < steps)"""


def gram_sql(cols: str) -> str:
    """Products of the columns (a list of lists) as one list."""
    return f"list_transform(range(0, len({cols}) * len({cols})), lambda x: list_inner_product({cols}[x // len({cols}) + 1], {cols}[x % len({cols}) + 1]))"


def past(lag: str, n: str, start: str) -> str:
    """Differences 1 .. lag days back for the days start + 1 .. n - 1."""
    return f"list_transform(range(1, {lag} + 1), lambda i: ds[{start} + 1 - i:n - 1 - i])"


# Phi by its power series; enough terms for |q| <= 12.
PHI_SQL = ("(0.5 + exp(-q * q / 2) / sqrt(2 * pi()) * sign(q) * list_sum(list_transform(range(0, 200), lambda i: "
           "exp((2 * i + 1) * ln(greatest(abs(q), 1e-300)) - lgamma(2 * i + 2) + i * ln(2.0) + lgamma(i + 1)))))")
ADF_SQL = f"""{SERIES_SQL},
ys0 as (select store, count(*) as n, list(y - m order by t) as ys from (select *, avg(y) over (partition by store) as m from sert) group by store),
ys1 as (select *, list_transform(range(1, n), lambda i: ys[i + 1] - ys[i]) as ds,
          least(cast(ceil(12 * pow(n / 100.0, 0.25)) as bigint), n // 2 - 2) as p from ys0),
wide as (select store, p + 3 as k_all, [list_transform(range(p + 1, n), lambda i: 1.0), ys[p + 1:n - 1]] || {past("p", "n", "p")} || [ds[p + 1:n - 1]] as c from ys1),
wide_g as (select store, k_all, {gram_sql("c")} as g from wide),
{eliminated("nested", "wide_g", "k_all - 1")},
scored as (select store, k - 2 as lag, (n - 1 - p) * (ln(2 * pi()) + ln(g[k_all * k_all] / (n - 1 - p)) + 1) + 2 * k as aic
           from nested join ys1 using (store) where k >= 2),
chosen as (select store, arg_min(lag, (aic, lag)) as l from scored group by store),
narrow as (select store, l + 3 as k_all, [list_transform(range(l + 1, n), lambda i: 1.0)] || {past("l", "n", "l")} || [ys[l + 1:n - 1], ds[l + 1:n - 1]] as c
           from ys1 join chosen using (store)),
narrow_g as (select store, k_all, {gram_sql("c")} as g from narrow),
{eliminated("level", "narrow_g", "k_all - 2")},
tail as (select store, k_all, g[k_all * k_all - k_all - 1] as a, g[k_all * k_all - k_all] as b, g[k_all * k_all] as c, n - 1 - l as nobs, l
         from level join chosen using (store) join ys0 using (store) where k = steps),
stat as (select store, l, nobs, b / a / sqrt((c - b * b / a) / (nobs - l - 2) / a) as tau from tail),
tested as (select *, case when tau <= -1.61 then 2.1659 + 1.4412 * tau + 0.038269 * tau * tau
             else 1.7339 + 0.93202 * tau - 0.12745 * tau * tau - 0.010368 * tau * tau * tau end as q from stat),
adf as (select store, tau, case when tau > 2.74 then 1.0 when tau < -18.83 then 0.0 else greatest({PHI_SQL}, 0.0) end as pv, l, nobs from tested)"""
STATIONARY_SQL = f"""{ADF_SQL},
level_or_step as (select s.store, s.date, pv < 0.05 as is_stationary, case when pv < 0.05 then y else y - lag(y) over (partition by s.store order by date) end as y
       from sert s join adf on s.store = adf.store),
stat_series as (select *, cast(row_number() over (partition by store order by date) as int) as t from level_or_step where y is not null)"""


def recursive(sql: str) -> str:
    """The oracle's views in one recursive WITH."""
    return "with recursive " + q(sql).replace("\nwith store as", "\nstore as", 1)


@register("adf", recursive(f"""with {ADF_SQL}
select store, round(tau, 4) as adf_stat, round(pv, 6) as p_value, cast(l as int) as used_lag, cast(nobs as int) as nobs, pv < 0.05 as is_stationary from adf"""))
def adf(spark, sf):
    """TS3; the oracle takes the regressions' products column by column and eliminates them in a recursive CTE."""
    out = TS.adf(rounded_series(spark, sf))
    return out.withColumns({"adf_stat": rnd("adf_stat", 4), "p_value": r6("p_value")})


@register("make_stationary", recursive(f"with {STATIONARY_SQL} select store, date, t, round(y, 6) as y, is_stationary from stat_series"))
def make_stationary(spark, sf):
    s = rounded_series(spark, sf)
    return TS.make_stationary(s, TS.adf(s)).withColumn("y", r6("y"))


@register("minmax_scale", q(f"""with {SERIES_SQL}
select store, date, min(y) over (partition by store) as v_min, max(y) over (partition by store) as v_max,
  round(-1.0 + 2.0 * ((y - min(y) over (partition by store)) / nullif(max(y) over (partition by store)
  - min(y) over (partition by store), 0)), 6) as scaled from ser"""))
def minmax_scale(spark, sf):
    s = TS.minmax_scale(rounded_series(spark, sf))
    return s.select("store", "date", "v_min", "v_max", r6("scaled").alias("scaled"))


@register("unscale_roundtrip", q(f"""with {SERIES_SQL},
m as (select store, date, y, min(y) over (partition by store) as v_min, max(y) over (partition by store) as v_max from ser),
s as (select *, -1.0 + 2.0 * ((y - v_min) / nullif(v_max - v_min, 0)) as scaled from m)
select store, date, round(v_min + (scaled - (-1.0)) / 2.0 * (v_max - v_min), 4) as y_back from s"""))
def unscale_roundtrip(spark, sf):
    s = TS.minmax_scale(rounded_series(spark, sf))
    return s.select("store", "date", rnd(TS.unscale(F.col("scaled"), F.col("v_min"), F.col("v_max")), 4)
                    .alias("y_back"))


LAG_COLS_SQL = ", ".join(f"x[{i}] as x_{i:02d}" for i in range(1, 15))


@register("sliding_windows", q(f"""with {SERIES_SQL},
w as (select store, t, y, list(y) over (partition by store order by t rows between 14 preceding and 1 preceding) as x
      from sert)
select store, t, {LAG_COLS_SQL}, y as target from w where t > 14"""))
def sliding_windows(spark, sf):
    """TS7; the window array is shown as 14 columns x_01 (oldest) .. x_14 (newest)."""
    w = TS.sliding_windows(rounded_series(spark, sf), "y", 14)
    return w.select("store", "t", *[F.col("x")[i - 1].alias(f"x_{i:02d}") for i in range(1, 15)], "target")


@register("store_list", q("select distinct store from history order by store limit 100"))
def store_list(spark, sf):
    """L2: distinct stores, sorted, first 100 (the store pickers)."""
    return load_panel(spark, sf).fact.select("store").distinct().orderBy("store").limit(100)


@register("head_rows", q("select store, date, sales from open_panel order by store, date limit 200"))
def head_rows(spark, sf):
    """L1/L3: the first 200 open-day rows in (store, date) order (an ordered limit)."""
    return panels(spark, sf)[2].orderBy("store", "date").limit(200).select("store", "date", "sales")


@register("ordered_cut", q(f"""with {SERIES_SQL},
w as (select store, t from sert where t > 14),
c as (select store, t, row_number() over (partition by store order by t) as rn, count(*) over (partition by store) as n from w)
select store, t, cast(rn <= floor(n * 0.85) as int) as is_train from c"""))
def ordered_cut(spark, sf):
    w = TS.sliding_windows(rounded_series(spark, sf), "y", 14)
    return TS.ordered_cut(w, 0.85).select("store", "t", "is_train")


LOOK_BACK = 14
# A store's scaled values as one list; window w's lags are sc[w .. w + 13], its target sc[w + 14].
WINDOWS_SQL = f"""{STATIONARY_SQL},
bounds_of as (select store, min(y) as lo, max(y) as hi, list(y order by t) as v from stat_series group by store having max(y) > min(y) and count(*) > {LOOK_BACK}),
win as (select store, lo, hi, sc, len(sc) - {LOOK_BACK} as w, cast(floor((len(sc) - {LOOK_BACK}) * 0.85) as bigint) as tr
        from (select *, list_transform(v, lambda x: -1.0 + 2.0 * ((x - lo) / (hi - lo))) as sc from bounds_of))"""


def window_columns(first: str, last: str) -> str:
    """Columns (1, lag 14 .. lag 1, target) of the windows first .. last."""
    return (f"[list_transform(range({first}, {last} + 1), lambda i: 1.0)] || "
            f"list_transform(range(0, {LOOK_BACK + 1}), lambda j: sc[{first} + j:{last} + j])")


def errors_sql(beta: str, source: str) -> str:
    """Errors of the test windows in series units, from weights ``beta`` (intercept first)."""
    return f"""miss as (select store, (hi - lo) / 2.0 * unnest(list_transform(range(tr + 1, w + 1),
          lambda i: sc[i + {LOOK_BACK}] - {beta}[1] - list_inner_product(sc[i:i + {LOOK_BACK - 1}], {beta}[2:]))) as e from {source})"""


ERRORS_OUT = "round(sqrt(avg(e * e)), 4) as rmse, round(avg(abs(e)), 4) as mae, count(*) as test_windows"


@register("lag_forecast", recursive(f"""with {WINDOWS_SQL},
design as (select store, {LOOK_BACK + 2} as k_all, {window_columns("1", "tr")} as c from win where tr > 0),
design_g as (select store, k_all, {gram_sql("c")} as g from design),
{eliminated("solved", "design_g", "k_all - 1", both_ways=True)},
beta as (select *, list_transform(range(0, {LOOK_BACK + 1}), lambda i: g[i * {LOOK_BACK + 2} + {LOOK_BACK + 2}] / g[i * {LOOK_BACK + 3} + 1]) as b
         from solved join win using (store) where k = steps),
{errors_sql("b", "beta")}
select store, {ERRORS_OUT} from miss group by store"""))
def lag_forecast(spark, sf):
    """TS10 by least squares; the oracle solves the normal equations by Gauss-Jordan steps in a recursive CTE."""
    out = TS.series_forecast(rounded_series(spark, sf))[1]
    return out.withColumns({"rmse": rnd("rmse", 4), "mae": rnd("mae", 4)})


LAG_STEP, LAG_EPOCHS, LAG_BATCH, LAG_PATIENCE = 0.05, 50, 32, 10
_M = LOOK_BACK + 1
_QUAD = "list_sum(list_transform(range(0, {k} * {k}), lambda x: {g}[x + 1] * {v}[x // {k} + 1] * {v}[x % {k} + 1]))".format
_NEXT = (f"list_transform(range(1, {_M + 1}), lambda i: s[{_M + 1}][i] + list_sum(list_transform(range(1, {_M + 1}), lambda j: s[j][i] * w0[j])))")
LAG_EPOCHS_SQL = f"""{WINDOWS_SQL},
part as (select store, b, least((b + 1) * {LAG_BATCH}, tr) - b * {LAG_BATCH} as n, {window_columns(f"(b * {LAG_BATCH} + 1)", f"least((b + 1) * {LAG_BATCH}, tr)")} as c
         from (select *, unnest(range(0, (tr + {LAG_BATCH - 1}) // {LAG_BATCH})) as b from win where tr > 0 and w > tr)),
moves as (select store, b, n, list_transform(range(1, {_M + 1}), lambda i: list_transform(range(1, {_M + 1}), lambda j: list_inner_product(c[i], c[j]))) as a,
          list_transform(range(1, {_M + 1}), lambda i: list_inner_product(c[i], c[{_M + 1}])) as r from part),
epoch_map as (
  select distinct store, 0 as b, list_transform(range(1, {_M + 2}), lambda j: list_transform(range(1, {_M + 1}), lambda i: case when i = j then 1.0::double else 0.0::double end)) as s from part
  union all
  select store, b + 1, list_transform(s, lambda col, j: list_transform(range(1, {_M + 1}), lambda i:
      col[i] - {2 * LAG_STEP} / n * (list_inner_product(a[i], col) - case when j = {_M + 1} then r[i] else 0.0 end)))
  from epoch_map join moves using (store, b)),
whole as (select store, arg_max(s, b) as s from epoch_map group by store),
loss_g as (select store, {gram_sql("c")} as g, {gram_sql("d")} as h, tr, w - tr as te
           from (select *, {window_columns("1", "tr")} as c, {window_columns("(tr + 1)", "w")} as d from win where tr > 0 and w > tr)),
run as (
  select store, 0 as epoch, list_transform(range(0, {_M}), lambda i: 0.0::double) as weights, 0.0::double as loss, 1e300::double as val, 1e300::double as best, 0 as best_epoch from whole
  union all
  select store, epoch + 1, weights, loss, val, case when val < best - 1e-7 then val else best end, case when val < best - 1e-7 then epoch + 1 else best_epoch end
  from (select store, epoch, best, best_epoch, weights, {_QUAD(k=_M + 1, g="g", v="v")} / tr as loss, {_QUAD(k=_M + 1, g="h", v="v")} / te as val
        from (select *, weights || [-1.0::double] as v from (select store, epoch, best, best_epoch, {_NEXT} as weights
              from (select store, epoch, best, best_epoch, weights as w0, s from run join whole using (store)
                    where epoch < {LAG_EPOCHS} and epoch - best_epoch < {LAG_PATIENCE})))
        join loss_g using (store)))"""


def lag_trained(spark, sf):
    return TS.lag_training(rounded_series(spark, sf), LOOK_BACK, epochs=LAG_EPOCHS, batch_size=LAG_BATCH,
                           patience=LAG_PATIENCE, step=LAG_STEP)


@register("lag_history", recursive(f"""with {LAG_EPOCHS_SQL}
select store, cast(epoch as int) as epoch, round(loss, 8) as loss, round(val, 8) as val_loss from run where epoch > 0"""))
def lag_history(spark, sf):
    """TS10's loss history: epochs of mini-batch gradient steps, stopped early; the oracle runs the same recursion."""
    return lag_trained(spark, sf)[2].withColumns({"loss": rnd("loss", 8), "val_loss": rnd("val_loss", 8)})


@register("lag_forecast_epochs", recursive(f"""with {LAG_EPOCHS_SQL},
last as (select store, max(epoch) as epochs, max(best_epoch) as best_epoch from run group by store),
kept as (select win.*, weights from last join run on run.store = last.store and run.epoch = last.best_epoch join win on win.store = last.store),
{errors_sql("weights", "kept")}
select store, {ERRORS_OUT}, cast(any_value(epochs) as int) as epochs, cast(any_value(best_epoch) as int) as best_epoch
from miss join last using (store) group by store"""))
def lag_forecast_epochs(spark, sf):
    """TS10 with 50 epochs, batches of 32 and patience 10: test errors with the weights of the best epoch."""
    return lag_trained(spark, sf)[1].withColumns({"rmse": rnd("rmse", 4), "mae": rnd("mae", 4)})


# ---------------------------------------------------------------- models and scoring
# Query-sized forests; the library defaults are the reference's (400 x 25, 500 x 0.03 x 8).


QUERY_RF = {"num_trees": 20, "max_depth": 8, "seed": 42}
QUERY_GBT = {"max_iter": 20, "step_size": 0.1, "max_depth": 5, "seed": 42}
_FITTED: dict = {}


def _stamp(spark, sf) -> tuple:
    """Sizes and times of the tables that the models are fitted on."""
    out = []
    for table in ("lineitem", "supplier"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf}/{table}.parquet")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        out += [fs.getContentSummary(path).getLength(), *sorted(f.getModificationTime() for f in fs.listStatus(path))]
    return tuple(out)


def _once(spark, sf, what: str, make):
    """One value per application and input as it stands: the model queries share their split, features and fits."""
    key = (spark.sparkContext.applicationId, sf, _stamp(spark, sf), what)
    if key not in _FITTED:
        _FITTED[key] = make()
    return _FITTED[key]


def model_inputs(spark, sf):
    """(stored inputs, training rows, validation rows, prepared features)."""
    def make():
        p, _, open_panel = panels(spark, sf, stored=True)
        train, val = SP.time_split(written(open_panel.drop("customers"), "open-panel"), 6)
        return p, train, val, MD.prepare_features(train)
    return _once(spark, sf, "inputs", make)


def fitted(spark, sf, kind: str):
    """The query-sized model on the pre-horizon training split, fitted once per application and input."""
    def make():
        _, train, val, prepared = model_inputs(spark, sf)
        pipe = MD.rf_pipeline(**QUERY_RF) if kind == "rf" else MD.gbt_pipeline(**QUERY_GBT)
        return MD.fit_and_record(pipe, kind, train, val, prepared=prepared)
    return _once(spark, sf, kind, make)


@register("rf_metrics")
def rf_metrics(spark, sf):
    _, pred, _ = fitted(spark, sf, "rf")
    return EV.regression_metrics(pred, "y", "p").withColumn("model", F.lit("RandomForest"))


@register("gbt_metrics")
def gbt_metrics(spark, sf):
    _, pred, _ = fitted(spark, sf, "gbt")
    return EV.regression_metrics(pred, "y", "p").withColumn("model", F.lit("GradientBoosting"))


@register("model_choice")
def model_choice(spark, sf):
    a = EV.regression_metrics(fitted(spark, sf, "rf")[1], "y", "p").select(F.lit("RandomForest").alias("model"), "rmspe")
    b = EV.regression_metrics(fitted(spark, sf, "gbt")[1], "y", "p").select(F.lit("GradientBoosting").alias("model"), "rmspe")
    return EV.pick_winner(a.unionByName(b))


@register("feature_importance")
def feature_importance(spark, sf):
    return MD.feature_importance(fitted(spark, sf, "rf")[0], spark, top_n=20)


@register("model_coverage")
def model_coverage(spark, sf):
    return EV.coverage(fitted(spark, sf, "rf")[1], order=["store", "date"], n=150)


@register("submission")
def submission(spark, sf):
    return SC.submission(fitted(spark, sf, "rf")[0], clean_horizon(model_inputs(spark, sf)[0]))


@register("submission_summary")
def submission_summary(spark, sf):
    return SC.submission_summary(SC.submission(fitted(spark, sf, "rf")[0], clean_horizon(model_inputs(spark, sf)[0])))


def scenario_requests(p: Panel) -> DataFrame:
    """Every horizon store under both promo settings, no school holiday, six weeks."""
    stores = p.horizon.select("store").distinct()
    return stores.select("store", F.explode(F.array(F.lit(1), F.lit(0))).alias("promo"),
                         F.lit(0).alias("school_holiday"), F.lit(6).alias("weeks"))


@register("forecast_calendar", q("""
with r as (select distinct store from horizon), p(promo) as (values (1), (0)),
last as (select max(date) as d1 from horizon)
select r.store, p.promo, 0 as school_holiday, 6 as weeks, cast(unnest(generate_series(d1 - 41, d1, interval 1 day)) as date) as date
from r, p, last"""))
def forecast_calendar(spark, sf):
    p = load_panel(spark, sf, stored=True)
    return SC.forecast_calendar(p.horizon, scenario_requests(p))


@register("forecast_requests", q("""
with r as (select distinct store from horizon), p(promo) as (values (1), (0)),
last as (select max(date) as d1 from horizon),
c as (select r.store, p.promo, 0 as school_holiday, 6 as weeks,
      cast(unnest(generate_series(d1 - 41, d1, interval 1 day)) as date) as date from r, p, last)
select c.store, c.promo, c.school_holiday, c.weeks, c.date, s.store_type, s.assortment, s.competition_distance,
  s.competition_open_since_month, s.competition_open_since_year, s.promo2, s.promo2_since_week,
  s.promo2_since_year, s.promo_interval, cast(isodow(c.date) as int) as day_of_week,
  case when isodow(c.date) = 7 and coalesce(s.store_type, '') <> 'b' then 0 else 1 end as open,
  'None' as state_holiday
from c left join store s on c.store = s.store"""))
def forecast_requests(spark, sf):
    p = load_panel(spark, sf, stored=True)
    return SC.forecast_requests(p.horizon, p.store, scenario_requests(p))


@register("scenario_forecast")
def scenario_forecast(spark, sf):
    p = model_inputs(spark, sf)[0]
    return SC.scenario_forecast(fitted(spark, sf, "rf")[0], p.horizon, p.store, scenario_requests(p))[1]


@register("batch_score")
def batch_score(spark, sf):
    # The horizon as an upload: raw rows (nulls in open), store attributes joined by J2.
    p = model_inputs(spark, sf)[0]
    return SC.batch_score(fitted(spark, sf, "rf")[0], p.horizon, p.store)


@register("batch_summary")
def batch_summary(spark, sf):
    p = model_inputs(spark, sf)[0]
    return SC.batch_summary(SC.batch_score(fitted(spark, sf, "rf")[0], p.horizon, p.store))


@register("batch_histogram")
def batch_histogram(spark, sf):
    p = model_inputs(spark, sf)[0]
    return SC.batch_histogram(SC.batch_score(fitted(spark, sf, "rf")[0], p.horizon, p.store), 60)


# ---- models at the reference's size (plans/ensembles.py) and what can be certified of them in SQL:
# the numbers of rows, and 0 rows where another way to the same value differs.

FULL = {"rf": {"num_trees": 400, "max_depth": 25, "seed": 42}, "gbt": {"max_iter": 500, "step_size": 0.03, "max_depth": 8, "seed": 42}}
CERTIFIED = 1e-6  # relative difference of two sums of the same numbers in another order


def full_model(spark, sf, kind: str):
    """(model, validation predictions, metrics) of the reference-sized model, fitted once per application and input."""
    def make():
        _, _, val, (features, prepared) = model_inputs(spark, sf)
        rows = _once(spark, sf, "ensemble-rows", lambda: EN.training_rows(prepared, MD.LABEL))
        return MD.fit_ensemble_and_record(kind, kind, features, rows, rows.count(), val, FULL[kind])
    return _once(spark, sf, f"full-{kind}", make)


def differing(a: DataFrame, b: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row: rows of ``a``, and of both those that lack a partner or differ."""
    x, y = F.col("x"), F.col("y")
    both = a.select(*keys, F.col(value).alias("x")).join(b.select(*keys, F.col(value).alias("y")), keys, "full")
    bad = x.isNull() | y.isNull() | (F.abs(x - y) > CERTIFIED * F.greatest(F.abs(x), F.lit(1.0)))
    return both.agg(F.count("x").alias("rows"), F.count_if(bad).alias("mismatches"))


@register("forest_metrics")
def forest_metrics(spark, sf):
    """M1 at 400 trees of depth 25: validation metrics."""
    return EV.regression_metrics(full_model(spark, sf, "rf")[1], "y", "p").withColumn("trees", F.lit(FULL["rf"]["num_trees"]))


@register("boosting_metrics")
def boosting_metrics(spark, sf):
    """M2 at 500 steps of 0.03 and depth 8: validation metrics."""
    return EV.regression_metrics(full_model(spark, sf, "gbt")[1], "y", "p").withColumn("steps", F.lit(FULL["gbt"]["max_iter"]))


@register("full_model_choice")
def full_model_choice(spark, sf):
    """M6 over the two reference-sized models."""
    each = [EV.regression_metrics(full_model(spark, sf, k)[1], "y", "p").select(F.lit(n).alias("model"), "rmspe")
            for k, n in (("rf", "RandomForest"), ("gbt", "GradientBoosting"))]
    return EV.pick_winner(each[0].unionByName(each[1]))


@register("forest_importance")
def forest_importance(spark, sf):
    """M7 of the 400-tree forest."""
    return EN.importances(full_model(spark, sf, "rf")[0].trees)


def prediction_certificate(spark, sf, kind: str) -> DataFrame:
    model, pred, _ = full_model(spark, sf, kind)
    native = MD.predictions(model.native(), model_inputs(spark, sf)[2])
    return differing(pred, native, ["store", "date"], "p")


VALIDATION_ROWS = """with c as (select max(date) - 42 as cutoff from open_panel),
va as (select distinct store, date from open_panel where date >= (select cutoff from c))
select cast(count(*) as bigint) as rows, cast(0 as bigint) as mismatches from va"""


@register("forest_certificate", q(VALIDATION_ROWS))
def forest_certificate(spark, sf):
    """Every validation row walks all 400 trees by native look-ups; the scorer's predictions must be the same."""
    return prediction_certificate(spark, sf, "rf")


@register("boosting_certificate", q(VALIDATION_ROWS))
def boosting_certificate(spark, sf):
    return prediction_certificate(spark, sf, "gbt")


@register("node_certificate", q("select cast(500 as bigint) as steps, cast(0 as bigint) as broken"))
def node_certificate(spark, sf):
    """Boosting's node table, every inner node against its two children: rows and values must add up, the gain must be what the
    cut takes off the squared error, and every step must have a tree."""
    nodes = EN.node_table(full_model(spark, sf, "gbt")[0].trees.withColumn("tree", F.xxhash64("tree", "value")))
    inner = nodes.filter("feature >= 0")
    child = nodes.select("tree", F.col("node").alias("at"), F.col("rows").alias("n"), F.col("value").alias("v"))
    left, right = (inner.select("tree", "node", (F.col("left") + i).alias("at")).join(child, ["tree", "at"])
                   .select("tree", "node", F.col("n").alias(f"n{i}"), F.col("v").alias(f"v{i}")) for i in (0, 1))
    j = inner.join(left, ["tree", "node"], "left").join(right, ["tree", "node"], "left")
    n0, n1, v0, v1 = (F.col(c) for c in ("n0", "n1", "v0", "v1"))
    scale = F.greatest(n0 * v0 * v0 + n1 * v1 * v1, F.lit(1.0))
    ok = (n0 + n1 == F.col("rows")) & (F.abs(n0 * v0 + n1 * v1 - F.col("rows") * F.col("value")) <= 1e-6 * F.sqrt(scale * F.col("rows"))) \
        & (F.abs(n0 * n1 / (n0 + n1) * (v0 - v1) * (v0 - v1) - F.col("gain")) <= 1e-6 * scale)
    broken = j.agg(F.count_if(~F.coalesce(ok, F.lit(False))).alias("broken"))
    steps = full_model(spark, sf, "gbt")[0].trees.filter("tree >= 0").agg(F.count_distinct("tree").alias("steps"))
    return steps.select("steps", broken.scalar().alias("broken"))


@register("submission_certificate", q("select cast(count(*) as bigint) as rows, cast(0 as bigint) as mismatches from horizon"))
def submission_certificate(spark, sf):
    """M13 with the boosted model, by the scorer and by native look-ups."""
    model, panel = full_model(spark, sf, "gbt")[0], clean_horizon(model_inputs(spark, sf)[0])
    return differing(SC.submission(model, panel), SC.submission(model.native(), panel), ["id"], "sales")


@register("scenario_certificate", q("select cast(2 * count(distinct store) as bigint) as rows, cast(0 as bigint) as mismatches from horizon"))
def scenario_certificate(spark, sf):
    """M16 with the boosted model: every request's total, by the scorer and by native look-ups."""
    p, model = model_inputs(spark, sf)[0], full_model(spark, sf, "gbt")[0]
    a, b = (SC.scenario_forecast(m, p.horizon, p.store, scenario_requests(p))[1] for m in (model, model.native()))
    return differing(a, b, ["store", "promo"], "total")


@register("batch_certificate", q("select cast(count(*) as bigint) as rows, cast(0 as bigint) as mismatches from horizon"))
def batch_certificate(spark, sf):
    """M17 with the boosted model, by the scorer and by native look-ups."""
    p, model = model_inputs(spark, sf)[0], full_model(spark, sf, "gbt")[0]
    a, b = (SC.batch_score(m, p.horizon, p.store) for m in (model, model.native()))
    return differing(a, b, ["id", "store", "date"], "predicted_sales")


@register("importance_certificate", q("select cast(26 as bigint) as features, cast(1.0 as double) as total, cast(0 as bigint) as negative"))
def importance_certificate(spark, sf):
    """M7 of the forest over all features: shares that add up to 1."""
    i = EN.importances(full_model(spark, sf, "rf")[0].trees, top_n=None)
    return i.agg(F.count(F.lit(1)).alias("features"), F.round(F.sum("importance"), 9).alias("total"), F.count_if(F.col("importance") < 0).alias("negative"))


# ---- the scoring arithmetic (F4, F12, F15, X22, M13, M16, M17, G16-G19) with the fixed predictor, against SQL

CENTS = "round_even(greatest({p}, 0.0) * 100, 0) / 100"
SCORED_SQL = f"""{BASELINE_SQL},
sub as (select t.id, t.store, t.date, case when t.open = 0 then 0.0 else {CENTS.format(p="coalesce(sm.p, 0.0)")} end as sales
        from test_panel t left join sm on t.store = sm.store)"""
BATCH_SQL = f"""{BASELINE_SQL},
up as (select h.id, h.date, h.store, case when coalesce(h.open, 1) = 0 then 0.0
         else {CENTS.format(p="coalesce(sm.p, 0.0)")} end as predicted_sales
       from horizon h left join sm on h.store = sm.store)"""


def baseline_model(spark, sf):
    """(stored inputs, store-mean model of the training split)."""
    def make():
        p, _, open_panel = panels(spark, sf, stored=True)
        return p, EV.StoreMeanModel(SP.time_split(open_panel, 6)[0])
    return _once(spark, sf, "baseline", make)


@register("baseline_submission", q(f"with {SCORED_SQL} select id, sales from sub"))
def baseline_submission(spark, sf):
    p, model = baseline_model(spark, sf)
    return SC.submission(model, clean_horizon(p))


@register("baseline_submission_summary", q(f"""with {SCORED_SQL}
select cast(count(*) as bigint) as rows, min(sales) as min, round(avg(sales), 6) as mean, max(sales) as max from sub"""))
def baseline_submission_summary(spark, sf):
    return _rounded(SC.submission_summary(baseline_submission(spark, sf)), ["mean"])


@register("baseline_scenario_forecast", q(f"""with {BASELINE_SQL},
rq as (select distinct store from horizon), pr(promo) as (values (1), (0)), last as (select max(date) as d1 from horizon),
cal as (select rq.store, pr.promo, 0 as school_holiday, cast(unnest(generate_series(d1 - 41, d1, interval 1 day)) as date) as date
        from rq, pr, last),
sc as (select cal.*, case when isodow(cal.date) = 7 and coalesce(s.store_type, '') <> 'b' then 0.0
         else {CENTS.format(p="coalesce(sm.p, 0.0)")} end as x
       from cal left join store s on cal.store = s.store left join sm on cal.store = sm.store)
select store, promo, school_holiday, round(sum(x), 6) as total,
  round(coalesce(avg(case when x > 0 then x end), 0.0), 6) as daily_mean, max(x) as peak from sc group by all"""))
def baseline_scenario_forecast(spark, sf):
    p, model = baseline_model(spark, sf)
    return _rounded(SC.scenario_forecast(model, p.horizon, p.store, scenario_requests(p))[1], ["total", "daily_mean"])


@register("baseline_batch_score", q(f"with {BATCH_SQL} select id, date, store, predicted_sales from up"))
def baseline_batch_score(spark, sf):
    p, model = baseline_model(spark, sf)
    # an upload that carries leak columns and its own store attributes (J2 and F12 have work to do)
    upload = p.horizon.withColumns({"sales": F.lit(1.0), "customers": F.lit(1)})
    return SC.batch_score(model, upload, p.store)


@register("baseline_batch_summary", q(f"""with {BATCH_SQL}
select cast(count(*) as bigint) as rows, round(sum(predicted_sales), 4) as total, round(avg(predicted_sales), 6) as mean from up"""))
def baseline_batch_summary(spark, sf):
    out = SC.batch_summary(baseline_batch_score(spark, sf))
    return out.withColumns({"total": rnd("total", 4), "mean": r6("mean")})


@register("baseline_batch_histogram", q(f"""with {BATCH_SQL}, v as (select predicted_sales as x from up),
m as (select min(x) as mn, max(x) as mx from v),
b as (select least(cast(floor((x - mn) * 60 / (mx - mn)) as int), 59) as bin, count(*) as c from v, m group by 1)
select cast(i as int) as bin, round(mn + i * ((mx - mn) / 60), 6) as lo, round(mn + (i + 1) * ((mx - mn) / 60), 6) as hi,
  cast(coalesce(c, 0) as bigint) as count from range(0, 60) t(i) left join b on bin = i, m"""))
def baseline_batch_histogram(spark, sf):
    return _rounded(SC.batch_histogram(baseline_batch_score(spark, sf), 60), ["lo", "hi"])


@register("display_labels", q("""
with r as (select distinct store from horizon), last as (select max(date) as d1 from horizon),
c as (select r.store, cast(unnest(generate_series(d1 - 41, d1, interval 1 day)) as date) as date from r, last)
select c.store, c.date, strftime(c.date, '%a %d %b %Y') as date_label,
  case when isodow(c.date) = 7 and coalesce(s.store_type, '') <> 'b' then 'No' else 'Yes' end as open_label,
  case s.assortment when 'a' then 'Basic' when 'b' then 'Extra' when 'c' then 'Extended' end as assortment_label,
  dayname(c.date) as weekday
from c left join store s on c.store = s.store"""))
def display_labels(spark, sf):
    """X19, X20, X23 on the forecast calendar of every horizon store."""
    from shelfcast.functions import display as DSP
    p = load_panel(spark, sf)
    req = p.horizon.select("store").distinct().select("store", F.lit(1).alias("promo"),
                                                      F.lit(0).alias("school_holiday"), F.lit(6).alias("weeks"))
    rows = SC.forecast_requests(p.horizon, p.store, req)
    return rows.select("store", "date", DSP.display_date("date").alias("date_label"),
                       DSP.yes_no("open").alias("open_label"),
                       DSP.assortment_label("assortment").alias("assortment_label"),
                       DSP.weekday_name("date").alias("weekday"))
