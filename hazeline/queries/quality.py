from __future__ import annotations

from pyspark.sql import functions as F

from hazeline.operators import quality as Q
from hazeline.queries.base import query, table, text_date

# Lines with missing cells in four columns.
GAPPY = """
    with t as (
      select l_orderkey, l_partkey, l_suppkey, l_linenumber,
        case when l_partkey % 2 = 0 then null else l_quantity end as q,
        case when l_suppkey % 3 = 0 then null else l_discount end as d,
        case when l_orderkey % 2 = 0 then null else l_tax end as x,
        case when l_linenumber > 3 then null else l_extendedprice end as p
      from lineitem)
"""
MEASURES = ("q", "d", "x", "p")


def gappy(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.expr("case when l_partkey % 2 = 0 then null else l_quantity end").alias("q"),
        F.expr("case when l_suppkey % 3 = 0 then null else l_discount end").alias("d"),
        F.expr("case when l_orderkey % 2 = 0 then null else l_tax end").alias("x"),
        F.expr("case when l_linenumber > 3 then null else l_extendedprice end").alias("p"),
    )


@query(
    "dq_drop_null_rows",
    GAPPY + "select * from t where not (q is null and d is null and x is null and p is null)",
)
def dq_drop_null_rows(spark, sf):
    return Q.drop_null_rows(gappy(spark, sf), MEASURES)


MISSING = (
    "(case when q is null then 1 else 0 end + case when d is null then 1 else 0 end + "
    "case when x is null then 1 else 0 end + case when p is null then 1 else 0 end)"
)


@query("dq_drop_sparse_rows", GAPPY + f"select * from t where {MISSING} <= 1")
def dq_drop_sparse_rows(spark, sf):
    return Q.drop_sparse_rows(gappy(spark, sf), 1)


@query(
    "dq_null_count",
    GAPPY + f"select l_orderkey, l_partkey, l_suppkey, l_linenumber, {MISSING} as na_count"
    f" from t where {MISSING} < 3",
)
def dq_null_count(spark, sf):
    return (
        Q.with_null_count(gappy(spark, sf), MEASURES)
        .where(F.col("na_count") < 3)
        .drop(*MEASURES)
    )


# Orders as rows of yearly source files: a declared year and a station per row.
SOURCE_ROWS = """
    with s as (
      select o_orderkey, 1995 + o_custkey % 7 as declared_year,
        'f' || (1995 + o_custkey % 7) || '_' || o_custkey as source, o_custkey as station,
        case when o_orderkey % 41 = 0 then null else cast(o_orderdate as date) end as date
      from orders),
    known as (select c_custkey from customer where c_acctbal > 0),
    rep as (
      select source, count(*) as n_rows,
        count(*) filter (year(date) <> declared_year) as n_other_year,
        count(*) filter (date is null) as n_invalid_dates,
        count(*) filter (station not in (select c_custkey from known)) as n_unknown_stations
      from s group by source)
"""


def source_rows(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.expr("1995 + o_custkey % 7").alias("declared_year"),
        F.expr("concat('f', 1995 + o_custkey % 7, '_', o_custkey)").alias("source"),
        F.col("o_custkey").alias("station"),
        F.expr("case when o_orderkey % 41 = 0 then null else to_date(o_orderdate) end").alias("date"),
    )


def known_stations(spark, sf):
    return table(spark, sf, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("station")
    )


@query(
    "dq_source_check",
    SOURCE_ROWS
    + """select *, n_invalid_dates = 0 and n_unknown_stations = 0 as accepted from rep""",
)
def dq_source_check(spark, sf):
    return Q.source_report(source_rows(spark, sf), known_stations(spark, sf))


@query(
    "dq_accepted_rows",
    SOURCE_ROWS
    + """
    select o_orderkey, s.source, cast(date as varchar) as date from s join rep using (source)
    where n_invalid_dates = 0 and n_unknown_stations = 0 and year(date) = declared_year
    """,
)
def dq_accepted_rows(spark, sf):
    rows = source_rows(spark, sf)
    report = Q.source_report(rows, known_stations(spark, sf))
    return Q.accept_sources(rows, report).select("o_orderkey", "source", text_date("date").alias("date"))


@query(
    "dq_split_invalid",
    SOURCE_ROWS
    + """
    select case when date is null then 'quarantine' else 'valid' end as branch,
      declared_year, count(*) as n from s group by all
    """,
)
def dq_split_invalid(spark, sf):
    valid, invalid = Q.split_invalid(source_rows(spark, sf), F.col("date").isNotNull())
    both = valid.withColumn("branch", F.lit("valid")).unionByName(
        invalid.withColumn("branch", F.lit("quarantine"))
    )
    return both.groupBy("branch", "declared_year").agg(F.count(F.lit(1)).alias("n"))


@query(
    "dq_duplicate_keys",
    """
    select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1
    """,
)
def dq_duplicate_keys(spark, sf):
    return Q.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


LINE_ORDER = (
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus",
)


@query(
    "dedupe_keep_first",
    f"""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
      cast(cast(l_shipdate as date) as varchar) as l_shipdate
    from (select *, row_number() over (partition by l_orderkey, l_linenumber
          order by {", ".join(LINE_ORDER)}) as n from lineitem) where n = 1
    """,
)
def dedupe_keep_first(spark, sf):
    return Q.dedupe(
        table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER
    ).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", text_date("l_shipdate").alias("l_shipdate"),
    )


@query(
    "dq_complete_keys",
    """
    with t as (select case when event_id % 11 = 0 then null else user_id end as station,
        case when event_id % 13 = 0 then null else cast(ts as date) end as date from events)
    select case when station is null or date is null then 'quarantine' else 'kept' end as branch,
      count(*) as n from t group by all
    """,
)
def dq_complete_keys(spark, sf):
    df = table(spark, sf, "events").select(
        F.expr("case when event_id % 11 = 0 then null else user_id end").alias("station"),
        F.expr("case when event_id % 13 = 0 then null else to_date(ts) end").alias("date"),
    )
    kept, aside = Q.complete_keys(df, ["station", "date"])
    return (
        kept.withColumn("branch", F.lit("kept"))
        .unionByName(aside.withColumn("branch", F.lit("quarantine")))
        .groupBy("branch").agg(F.count(F.lit(1)).alias("n"))
    )
