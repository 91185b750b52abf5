from __future__ import annotations

from pyspark.sql import functions as F

from hazeline.functions.dates import half_year
from hazeline.operators import ranking as R
from hazeline.operators import split_date as S
from hazeline.operators.aggregates import mean_all_numeric, median_iqr
from hazeline.operators.reshape import gather
from hazeline.queries.base import query, r, rounded, table, text_date
from hazeline.sources.stages import staged


@query(
    "win_sigma_outlier",
    """
    with t as (select event_id, event_type as city, value * value as v from events),
    w as (select *, avg(v) over (partition by city) as m, stddev_samp(v) over (partition by city)
        as s from t)
    select event_id, city, round(v, 4) as v,
      case when v > m + 3 * s or v < m - 3 * s then 'Outlier' else 'Normal' end as label from w
    """,
)
def win_sigma_outlier(spark, sf):
    df = table(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("city"), (F.col("value") * F.col("value")).alias("v")
    )
    return rounded(R.sigma_outliers(df, ["city"], "v"), 4, "v")


EXTREME_SQL = """
    with q as (select l_returnflag as city, month(l_shipdate) as month,
        quantile_cont(l_quantity, 0.5) as median from lineitem group by all)
    select city, month, round(median, 6) as median from (select *, rank() over (partition by city
      order by median {}) as k from q) where k = 1
"""


def _extreme(spark, sf, largest):
    df = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("city"), F.month("l_shipdate").alias("month"), "l_quantity"
    )
    # written: the extremes and the rows that attain them both read it
    q = staged(median_iqr(df, ["city", "month"], ["l_quantity"]), "group-medians")
    return R.group_extreme(q, ["city"], "median", largest).select("city", "month", r("median").alias("median"))


@query("win_group_extreme", EXTREME_SQL.format("desc"))
def win_group_extreme(spark, sf):
    return _extreme(spark, sf, True)


@query("win_group_minimum", EXTREME_SQL.format("asc"))
def win_group_minimum(spark, sf):
    return _extreme(spark, sf, False)


@query(
    "topk_per_group",
    """
    select user_id, rank, event_id, value from (select *, row_number() over (
      partition by user_id order by value desc nulls last, event_id) as rank
      from events) where rank <= 10
    """,
)
def topk_per_group(spark, sf):
    df = table(spark, sf, "events").select("user_id", "event_id", "value")
    return R.top_k(df, ["user_id"], "value", 10, ["event_id"])


@query(
    "topk_mean_composition",
    """
    with t as (select l_suppkey as city, case when month(l_shipdate) between 4 and 9
        then 'summer' else 'winter' end as season, l_extendedprice, l_quantity, l_discount, l_tax,
        row_number() over (partition by l_suppkey, month(l_shipdate) between 4 and 9
          order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey, l_quantity,
          l_discount, l_tax) as k from lineitem),
    m as (select city, season, avg(l_quantity) as l_quantity, avg(l_discount) as l_discount,
        avg(l_tax) as l_tax from t where k <= 10 group by all)
    select city, season, 'l_quantity' as type, round(l_quantity, 6) as val from m
    union all select city, season, 'l_discount', round(l_discount, 6) from m
    union all select city, season, 'l_tax', round(l_tax, 6) from m
    """,
)
def topk_mean_composition(spark, sf):
    df = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("city"), half_year(F.month("l_shipdate")).alias("season"),
        "l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
        "l_discount", "l_tax",
    )
    ties = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax"]
    keys = ["city", "season"]
    top = R.top_k(df, keys, "l_extendedprice", 10, ties)
    means = mean_all_numeric(top.select(*keys, "l_quantity", "l_discount", "l_tax"), keys)
    return rounded(gather(means, keys, ["l_quantity", "l_discount", "l_tax"]), 6, "val")


SPLIT_SQL = """
    with c as (select unnest(generate_series(timestamp '1996-01-01', timestamp '2000-01-01',
        interval 6 month)) as d),
    p as (select o_orderpriority as city, d, count(*) filter (o_orderdate <= d) / count(*) as b,
        count(*) filter (o_orderdate > d) / count(*) as a from orders, c group by all),
    s as (select d, avg(b) as b, avg(a) as a, round(abs(0.5 - avg(b)) + abs(0.5 - avg(a)), 12)
        as score from p group by d)
"""
STEPS = ("1996-01-01", "2000-01-01", 6)


def scores(spark, sf):
    return S.split_scores(
        table(spark, sf, "orders"), "o_orderpriority", "o_orderdate", S.candidate_dates(*STEPS)
    )


@query(
    "split_date_scores",
    SPLIT_SQL + "select cast(cast(d as date) as varchar) as split_date, round(b, 6) as mean_before,"
    " round(a, 6) as mean_after, round(score, 6) as score from s",
)
def split_date_scores(spark, sf):
    return rounded(
        scores(spark, sf).withColumn("split_date", text_date("split_date")), 6,
        "mean_before", "mean_after", "score",
    )


@query(
    "split_date_search",
    SPLIT_SQL + "select cast(cast(d as date) as varchar) as split_date, round(score, 6) as score"
    " from s order by s.score, d limit 1",
)
def split_date_search(spark, sf):
    return S.best_split(scores(spark, sf)).select(
        text_date("split_date").alias("split_date"), r("score").alias("score")
    )


@query(
    "split_date_table",
    SPLIT_SQL
    + """, best as (select d from s order by score, d limit 1)
    select o_orderpriority as city, count(*) filter (o_orderdate <= d) as before_samp,
      count(*) filter (o_orderdate > d) as after_samp,
      cast(cast(min(o_orderdate) as date) as varchar) as min,
      cast(cast(max(o_orderdate) as date) as varchar) as max, count(*) as total_samp,
      round(count(*) filter (o_orderdate <= d) / count(*), 2) as perc_before,
      round(count(*) filter (o_orderdate > d) / count(*), 2) as perc_aft
    from orders, best group by o_orderpriority
    """,
)
def split_date_table(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "city")
    tbl = S.searched_split_table(orders, "city", "o_orderdate", S.candidate_dates(*STEPS))
    return tbl.withColumns({"min": text_date("min"), "max": text_date("max")})
