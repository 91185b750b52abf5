from __future__ import annotations

from pyspark.sql import functions as F

from hazeline.fixed_values import HOUR_COLUMNS
from hazeline.functions.dates import half_year, month_label
from hazeline.functions.numeric import row_mean
from hazeline.functions.stats import t_table
from hazeline.operators import aggregates as A
from hazeline.operators.joins import first_non_null
from hazeline.operators.reshape import gather
from hazeline.queries.base import query, r, rounded, table, text_date

MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "agg_first_non_null",
    """
    with t as (select case when user_id % 10 = 0 then null else user_id end as station,
        cast(ts as date) as date, ts, event_id,
        case when event_type in ('click', 'error') then value end as a,
        case when event_id % 3 > 0 then props end as b from events)
    select station, cast(date as varchar) as date,
      arg_min(a, (ts, event_id)) filter (a is not null) as a,
      arg_min(b, (ts, event_id)) filter (b is not null) as b
    from t where station is not null group by all
    """,
)
def agg_first_non_null(spark, sf):
    df = table(spark, sf, "events").select(
        F.expr("case when user_id % 10 = 0 then null else user_id end").alias("station"),
        text_date("ts").alias("date"), "ts", "event_id",
        F.expr("case when event_type in ('click', 'error') then value end").alias("a"),
        F.expr("case when event_id % 3 > 0 then props end").alias("b"),
    )
    return first_non_null(df, ["station", "date"], ["a", "b"], ["ts", "event_id"])


@query(
    "agg_count",
    "select o_orderpriority, year(o_orderdate) as year, count(*) as n from orders group by all",
)
def agg_count(spark, sf):
    return table(spark, sf, "orders").groupBy(
        "o_orderpriority", F.year("o_orderdate").alias("year")
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "agg_mean_all_numeric",
    """
    select l_returnflag, l_linestatus, round(avg(l_orderkey), 4) as l_orderkey,
      round(avg(l_partkey), 4) as l_partkey, round(avg(l_suppkey), 4) as l_suppkey,
      round(avg(l_linenumber), 4) as l_linenumber, round(avg(l_quantity), 4) as l_quantity,
      round(avg(l_extendedprice), 4) as l_extendedprice, round(avg(l_discount), 6) as l_discount,
      round(avg(l_tax), 6) as l_tax
    from lineitem group by all
    """,
)
def agg_mean_all_numeric(spark, sf):
    means = A.mean_all_numeric(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])
    small = ("l_discount", "l_tax")
    large = [c for c in means.columns[2:] if c not in small]
    return rounded(rounded(means, 4, *large), 6, *small)


@query(
    "agg_coverage_span",
    """
    select event_type, user_id, cast(cast(min(ts) as date) as varchar) as start,
      cast(cast(max(ts) as date) as varchar) as end
    from events group by all
    """,
)
def agg_coverage_span(spark, sf):
    spans = A.coverage_span(table(spark, sf, "events"), ["event_type", "user_id"], "ts")
    return spans.withColumns({"start": text_date("start"), "end": text_date("end")})


@query(
    "agg_global_scalars",
    """
    select cast(ceil(max(l_extendedprice)) as bigint) + 3 as axis_max,
      round(avg(l_quantity - l_discount * 100), 6) as mean_diff, min(l_tax * 100) as min_perc,
      max(l_tax * 100) as max_perc from lineitem
    """,
)
def agg_global_scalars(spark, sf):
    return table(spark, sf, "lineitem").agg(
        (F.ceil(F.max("l_extendedprice")) + 3).alias("axis_max"),
        r(F.avg(F.col("l_quantity") - F.col("l_discount") * 100)).alias("mean_diff"),
        F.min(F.col("l_tax") * 100).alias("min_perc"),
        F.max(F.col("l_tax") * 100).alias("max_perc"),
    )


@query(
    "agg_mean_ci",
    f"""
    with t as (select unnest(range(1, 1001)) as dof, unnest({list(t_table(0.95, 1000))}) as q),
    s as (select event_type, cast(ts as date) as date, avg(value) as mean, count(value) as n,
        stddev_samp(value) as sd from events group by all)
    select event_type, cast(date as varchar) as date, round(mean, 6) as mean, n,
      round(sd, 6) as sd, round(case when n - 1 <= 1000 then q else
        1.6448536269514722 + 1.5237767180880303 / (n - 1) + 1.4200271480 / (n - 1) ** 2 end
        * sd / sqrt(n), 6) as ci
    from s left join t on dof = n - 1
    """,
)
def agg_mean_ci(spark, sf):
    df = table(spark, sf, "events").select("event_type", text_date("ts").alias("date"), "value")
    return rounded(A.mean_ci(df, ["event_type", "date"], "value"), 6, "mean", "sd", "ci")


@query(
    "agg_median_iqr",
    """
    with long as (
      select l_returnflag, month(l_shipdate) as month, strftime(l_shipdate, '%b') as month_text,
        unnest(['l_quantity', 'l_discount']) as compound,
        unnest([l_quantity, l_discount]) as v from lineitem)
    select l_returnflag, month, month_text, compound, count(v) as n,
      round(quantile_cont(v, 0.25), 6) as lower_iqr, round(quantile_cont(v, 0.5), 6) as median,
      round(quantile_cont(v, 0.75), 6) as upper_iqr
    from long group by all
    """,
)
def agg_median_iqr(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_returnflag", F.month("l_shipdate").alias("month"),
        month_label(F.col("l_shipdate")).alias("month_text"), "l_quantity", "l_discount",
    )
    q = A.median_iqr(df, ["l_returnflag", "month", "month_text"], ["l_quantity", "l_discount"])
    return rounded(q, 6, "lower_iqr", "median", "upper_iqr")


@query(
    "agg_ratio_quantiles",
    """
    with t as (select l_linestatus, month(l_shipdate) as month,
        case when l_tax = 0 then null else l_discount / l_tax end as ratio from lineitem),
    q as (select l_linestatus, month, quantile_cont(ratio, 0.5) as ratio,
        quantile_cont(ratio, 0.25) as lower_iqr, quantile_cont(ratio, 0.75) as upper_iqr
      from t group by all)
    select l_linestatus, round(min(ratio), 6) as min, round(max(ratio), 6) as max,
      round(min(lower_iqr), 6) as min_lower, round(max(upper_iqr), 6) as max_upper
    from q group by all
    """,
)
def agg_ratio_quantiles(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_linestatus", F.month("l_shipdate").alias("month"), "l_discount", "l_tax"
    )
    q = A.ratio_quantiles(df, ["l_linestatus", "month"], "l_discount", "l_tax")
    return q.groupBy("l_linestatus").agg(
        r(F.min("ratio")).alias("min"), r(F.max("ratio")).alias("max"),
        r(F.min("lower_iqr")).alias("min_lower"), r(F.max("upper_iqr")).alias("max_upper"),
    )


@query(
    "agg_global_bounds",
    """
    select event_id, value, round(quantile_cont(value, 0.02) over (), 6) as min,
      round(quantile_cont(value, 0.98) over (), 6) as max from events
    """,
)
def agg_global_bounds(spark, sf):
    df = table(spark, sf, "events").select("event_id", "value")
    return rounded(A.global_bounds(df, "value"), 6, "min", "max")


@query(
    "agg_box_stats",
    """
    with q as (select event_type as city, count(value) as n,
        quantile_cont(value, [0.02, 0.25, 0.5, 0.75, 0.98]) as q from events group by all)
    select city, n, round(q[1], 6) as ymin, round(q[2], 6) as lower, round(q[3], 6) as middle,
      round(q[4], 6) as upper, round(q[5], 6) as ymax,
      round(q[3] - 1.58 * (q[4] - q[2]) / sqrt(n), 6) as notch_lower,
      round(q[3] + 1.58 * (q[4] - q[2]) / sqrt(n), 6) as notch_upper,
      round(sqrt(n), 6) as relvarwidth
    from q
    """,
)
def agg_box_stats(spark, sf):
    df = table(spark, sf, "events").select(F.col("event_type").alias("city"), "value")
    b = A.box_stats(df, ["city"], "value")
    return rounded(b, 6, *[c for c in b.columns if c not in ("city", "n")])


@query(
    "agg_box_outliers",
    """
    with q as (select event_type, quantile_cont(value, 0.02) as ymin,
        quantile_cont(value, 0.98) as ymax from events group by all)
    select event_id, e.event_type, value, round(ymin, 6) as ymin, round(ymax, 6) as ymax
    from events e join q using (event_type) where value < q.ymin or value > q.ymax
    """,
)
def agg_box_outliers(spark, sf):
    df = table(spark, sf, "events").select("event_id", "event_type", "value")
    return rounded(A.box_outliers(df, ["event_type"], "value"), 6, "ymin", "ymax")


@query(
    "agg_hourly_to_daily",
    """
    with h as (select event_type as pollutant, user_id as napsid, cast(ts as date) as date,
        hour(ts) as hour, avg(value) as v from events group by all)
    select pollutant, napsid, cast(date as varchar) as date, round(avg(v), 6) as summary
    from h group by all
    """,
)
def agg_hourly_to_daily(spark, sf):
    wide = hour_wide(table(spark, sf, "events"))
    return wide.select(
        "pollutant", "napsid", text_date("date").alias("date"),
        r(row_mean(*[F.col(h) for h in HOUR_COLUMNS])).alias("summary"),
    )


def hour_wide(events):
    """One row per pollutant, station and day with 24 hour columns."""
    return events.groupBy(
        F.col("event_type").alias("pollutant"), F.col("user_id").alias("napsid"),
        F.to_date("ts").alias("date"),
    ).agg(
        *[
            F.avg(F.when(F.hour("ts") == i, F.col("value"))).alias(h)
            for i, h in enumerate(HOUR_COLUMNS)
        ]
    )


@query(
    "agg_season_mean_long",
    """
    with t as (select l_returnflag as city,
        case when l_shipdate < timestamp '1998-07-01' then 'before' else 'after' end as period,
        case when month(l_shipdate) between 4 and 9 then 'summer' else 'winter' end as season,
        unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) as type,
        unnest([l_quantity, l_extendedprice, l_discount, l_tax]) as v from lineitem)
    select city, period, season, type, round(avg(v), 4) as val from t group by all
    """,
)
def agg_season_mean_long(spark, sf):
    df = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("city"),
        F.when(F.to_date("l_shipdate") < F.lit("1998-07-01"), "before").otherwise("after").alias("period"),
        half_year(F.month("l_shipdate")).alias("season"), *MEASURES,
    )
    keys = ["city", "period", "season"]
    means = A.mean_all_numeric(df, keys)
    long = gather(means, keys, MEASURES)
    return rounded(long.where(F.col("val").isNotNull()), 4, "val")


@query(
    "agg_composition_share",
    """
    with m as (select l_returnflag as city, case when month(l_shipdate) between 4 and 9
        then 'summer' else 'winter' end as season, avg(l_quantity) as a, avg(l_discount * 100) as b,
        avg(l_tax * 100) as c from lineitem group by all)
    select city, season, round(a, 6) as a, round(b, 6) as b, round(c, 6) as c,
      round(a + b + c, 6) as total, round(a / (a + b + c), 6) as a_perc,
      round(b / (a + b + c), 6) as b_perc, round(c / (a + b + c), 6) as c_perc from m
    """,
)
def agg_composition_share(spark, sf):
    df = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("city"), half_year(F.month("l_shipdate")).alias("season"),
        F.col("l_quantity").alias("a"), (F.col("l_discount") * 100).alias("b"),
        (F.col("l_tax") * 100).alias("c"),
    )
    s = A.composition_share(df, ["city", "season"], ["a", "b", "c"])
    return rounded(s, 6, *s.columns[2:])


@query(
    "cmp_before_after",
    """
    with t as (select o_orderpriority as city, strftime(o_orderdate, '%b') as month_text,
        o_orderdate < timestamp '1998-01-01' as early, o_totalprice as v from orders),
    b as (select city, month_text, avg(v) as m from t where early group by all),
    a as (select city, month_text, avg(v) as m from t where not early group by all),
    d as (select city, month_text, b.m as before, a.m as after from b join a using (city, month_text))
    select city, month_text, round(before, 4) as before, round(after, 4) as after,
      round(before - after, 4) as diff, round(after / before, 6) as ratio,
      round(avg(before - after) over (partition by city), 4) as mean_diff from d
    """,
)
def cmp_before_after(spark, sf):
    from hazeline.plans.summaries import compare_periods, mean_difference

    df = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("city"),
        month_label(F.col("o_orderdate")).alias("month_text"),
        F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("v"),
    )
    months = compare_periods(df, ["city", "month_text"], "v", F.lit("1998-01-01").cast("date"))
    both = months.join(mean_difference(months, ["city"]), "city")
    return rounded(rounded(both, 4, "before", "after", "diff", "mean_diff"), 6, "ratio")


PARTS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "cmp_median_periods",
    """
    with t as (select l_returnflag as city, month(l_shipdate) as month,
        case when l_shipdate < timestamp '1998-07-01' then 'before' else 'after' end as period, l_tax as v from lineitem),
    q as (select city, month, period, quantile_cont(v, 0.5) as med from t group by all),
    w as (select city, month, max(med) filter (period = 'before') as before,
        max(med) filter (period = 'after') as after from q group by all)
    select city, month, round(before, 8) as before, round(after, 8) as after, round(before - after, 8) as diff,
      round(after / before, 8) as ratio from w where before is not null and after is not null
    """,
)
def cmp_median_periods(spark, sf):
    from hazeline.plans.summaries import compare_medians

    df = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("city"), F.month("l_shipdate").cast("long").alias("month"),
        F.expr("case when l_shipdate < timestamp_ntz '1998-07-01' then 'before' else 'after' end").alias("period"), "l_tax",
    )
    medians = A.median_iqr(df, ["city", "month", "period"], ["l_tax"])
    compared = compare_medians(medians, ["city", "month"])
    return rounded(compared, 8, "before", "after", "diff", "ratio")


@query(
    "cmp_share_ratios",
    """
    with m as (select l_returnflag as city,
        case when l_shipdate < timestamp '1998-07-01' then 'before' else 'after' end as p,
        case when month(l_shipdate) between 4 and 9 then 'summer' else 'winter' end as h,
        avg(l_quantity) as a, avg(l_extendedprice) as b, avg(l_discount) as c, avg(l_tax) as d from lineitem group by all),
    s as (select city, p, h, unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) as type,
        unnest([a / (a + b + c + d), b / (a + b + c + d), c / (a + b + c + d), d / (a + b + c + d)]) as v from m),
    w as (select city, type, max(v) filter (p = 'before' and h = 'summer') as bs, max(v) filter (p = 'before' and h = 'winter') as bw,
        max(v) filter (p = 'after' and h = 'summer') as afs, max(v) filter (p = 'after' and h = 'winter') as afw from s group by all)
    select city, type || '_perc' as type, round(afs / bs, 8) as summer_change, round(afw / bw, 8) as winter_change,
      round(bw / bs, 8) as winter_to_summer_before, round(afw / afs, 8) as winter_to_summer_after from w
    """,
)
def cmp_share_ratios(spark, sf):
    from hazeline.plans.summaries import share_ratios

    df = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("city"), half_year(F.month("l_shipdate")).alias("season"),
        F.expr("case when l_shipdate < timestamp_ntz '1998-07-01' then 'before' else 'after' end").alias("period"), *PARTS,
    )
    shares = A.composition_share(df, ["city", "period", "season"], PARTS)
    ratios = share_ratios(shares, [f"{c}_perc" for c in PARTS])
    return rounded(ratios, 8, "summer_change", "winter_change", "winter_to_summer_before", "winter_to_summer_after")
