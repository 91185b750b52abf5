from __future__ import annotations

from pyspark.sql import functions as F

from hazeline.functions import dates as D
from hazeline.functions import numeric as N
from hazeline.functions import text as X
from hazeline.queries.base import query, r, table
from hazeline.sources.provenance import path_parts


@query(
    "scalar_na_tokens",
    """
    with t as (
      select o_orderkey, case o_orderkey % 8 when 0 then 'NA' when 1 then '' when 2 then ' '
        when 3 then '-' when 4 then '-999' when 5 then '-999.000'
        else ' ' || o_orderpriority || ' ' end as raw
      from orders)
    select o_orderkey, case when trim(raw) in ('NA','','-','-999','-999.000') then null
      else trim(raw) end as cell
    from t
    """,
)
def scalar_na_tokens(spark, sf):
    raw = F.expr(
        "case o_orderkey % 8 when 0 then 'NA' when 1 then '' when 2 then ' ' when 3 then '-' "
        "when 4 then '-999' when 5 then '-999.000' else concat(' ', o_orderpriority, ' ') end"
    )
    return table(spark, sf, "orders").select("o_orderkey", X.na_to_null(raw).alias("cell"))


@query(
    "scalar_split_key",
    """
    with t as (
      select o_orderkey, '/raw/set/' || year(o_orderdate) || '_S' || o_custkey || '_'
        || o_orderstatus || '.csv' as path from orders)
    select o_orderkey,
      cast(regexp_extract(path, '([0-9]{4})_S[0-9]+', 1) as integer) as year,
      regexp_extract(path, '_(S[0-9]+)', 1) as station,
      regexp_extract(path, '_([A-Z])[.]csv$', 1) as file_type,
      split_part(path, '_', 2) as second_piece,
      substring(path, 11, 4) as characters
    from t
    """,
)
def scalar_split_key(spark, sf):
    path = F.concat(
        F.lit("/raw/set/"), F.year("o_orderdate"), F.lit("_S"), F.col("o_custkey"),
        F.lit("_"), F.col("o_orderstatus"), F.lit(".csv"),
    )
    p = F.col("path")
    parts = path_parts(p)
    return table(spark, sf, "orders").select("o_orderkey", path.alias("path")).select(
        "o_orderkey",
        parts["year"].alias("year"),
        parts["station"].alias("station"),
        parts["file_type"].alias("file_type"),
        X.part(p, "_", 2).alias("second_piece"),
        F.substring(p, 11, 4).alias("characters"),
    )


@query(
    "scalar_try_cast",
    """
    with t as (
      select o_orderkey, case o_orderkey % 4 when 0 then cast(o_totalprice as varchar)
        when 1 then o_orderpriority when 2 then 'NaN' else substring(o_orderpriority, 1, 1)
        end as cell from orders)
    select o_orderkey, round(case when isnan(try_cast(cell as double)) then null
      else try_cast(cell as double) end, 6) as number from t
    """,
)
def scalar_try_cast(spark, sf):
    cell = F.expr(
        "case o_orderkey % 4 when 0 then cast(o_totalprice as string) when 1 then o_orderpriority "
        "when 2 then 'NaN' else substring(o_orderpriority, 1, 1) end"
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", r(N.to_double(cell)).alias("number")
    )


@query(
    "scalar_parse_dates",
    """
    with t as (
      select o_orderkey, case o_orderkey % 3 when 0 then strftime(o_orderdate, '%Y%m%d')
        when 1 then strftime(o_orderdate, '%Y-%m-%d') else 'bad' || o_orderpriority end as cell
      from orders)
    select o_orderkey, cast(cast(coalesce(try_strptime(cell, '%Y%m%d'),
      try_strptime(cell, '%Y-%m-%d')) as date) as varchar) as parsed from t
    """,
)
def scalar_parse_dates(spark, sf):
    cell = F.expr(
        "case o_orderkey % 3 when 0 then date_format(o_orderdate, 'yyyyMMdd') "
        "when 1 then date_format(o_orderdate, 'yyyy-MM-dd') "
        "else concat('bad', o_orderpriority) end"
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", D.parse_date(cell).cast("string").alias("parsed")
    )


@query(
    "scalar_serial_date",
    """
    select o_orderkey, cast(date '1899-12-30' + cast(
      date_diff('day', date '1899-12-30', cast(o_orderdate as date)) + o_orderkey % 20000
      as integer) as varchar) as from_serial
    from orders
    """,
)
def scalar_serial_date(spark, sf):
    serial = F.datediff("o_orderdate", F.lit("1899-12-30")) + F.expr("o_orderkey % 20000")
    cell = F.concat(serial.cast("string"), F.lit(".25"))
    return table(spark, sf, "orders").select(
        "o_orderkey", D.serial_date(cell).cast("string").alias("from_serial")
    )


@query(
    "scalar_date_parts",
    """
    select o_orderkey, year(o_orderdate) as year,
      coalesce(case when o_orderkey % 5 = 0 then null else month(o_orderdate) end,
               month(o_orderdate)) as month,
      day(o_orderdate) as day, strftime(o_orderdate, '%b') as month_text,
      cast(make_date(year(o_orderdate), 1, 1) as varchar) as year_start,
      cast(make_date(year(o_orderdate), 12, 31) as varchar) as year_end
    from orders
    """,
)
def scalar_date_parts(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("date"),
        F.expr("case when o_orderkey % 5 = 0 then null else month(o_orderdate) end").alias("month"),
    )
    return D.fill_date_parts(df).select(
        "o_orderkey", "year", "month", "day",
        D.month_label(F.col("date")).alias("month_text"),
        D.year_start(F.col("year")).cast("string").alias("year_start"),
        D.year_end(F.col("year")).cast("string").alias("year_end"),
    )


@query(
    "scalar_season",
    """
    select o_orderkey, case when month(o_orderdate) in (3,4,5) then 'spring'
      when month(o_orderdate) in (6,7,8) then 'summer'
      when month(o_orderdate) in (9,10,11) then 'fall' else 'winter' end as season,
      case when month(o_orderdate) between 4 and 9 then 'summer' else 'winter' end as half_year
    from orders
    """,
)
def scalar_season(spark, sf):
    month = F.month("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", D.season(month).alias("season"), D.half_year(month).alias("half_year")
    )


NULLED_LINES = """
    with t as (
      select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice,
        case when l_partkey % 5 = 0 then null else l_quantity end as a,
        case when l_suppkey % 3 = 0 then null else l_tax end as b
      from lineitem)
"""


def nulled_lines(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
        F.expr("case when l_partkey % 5 = 0 then null else l_quantity end").alias("a"),
        F.expr("case when l_suppkey % 3 = 0 then null else l_tax end").alias("b"),
    )


@query(
    "scalar_coalesce",
    NULLED_LINES
    + """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(b, a) as gas,
      coalesce(a, b, -1) as other, a is null and b is null as all_missing from t
    """,
)
def scalar_coalesce(spark, sf):
    a, b = F.col("a"), F.col("b")
    return nulled_lines(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.coalesce(b, a).alias("gas"), F.coalesce(a, b, F.lit(-1.0)).alias("other"),
        (a.isNull() & b.isNull()).alias("all_missing"),
    )


@query(
    "scalar_null_skipping_sum",
    NULLED_LINES
    + """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey,
      round(case when a is null and b is null then null
        else coalesce(a, 0) + coalesce(b, 0) end, 6) as ec from t
    """,
)
def scalar_null_skipping_sum(spark, sf):
    return nulled_lines(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        r(N.null_skipping_sum(F.col("a"), F.col("b"))).alias("ec"),
    )


@query(
    "scalar_regex",
    """
    select c_custkey, regexp_replace(c_name, '0', 'x') as first_only,
      regexp_replace(c_name, '0', 'x', 'g') as everywhere,
      regexp_replace(split_part(c_name, '#', 2), '^0+', '') as no_zeros,
      regexp_replace(c_name, '^Customer#', 'S') as prefix_gone,
      upper(c_mktsegment) || '_' || lower(c_mktsegment) as joined
    from customer
    """,
)
def scalar_regex(spark, sf):
    name = F.col("c_name")
    return table(spark, sf, "customer").select(
        "c_custkey",
        X.replace_first(name, "0", "x").alias("first_only"),
        F.regexp_replace(name, "0", "x").alias("everywhere"),
        X.strip_leading_zeros(X.part(name, "#", 2)).alias("no_zeros"),
        F.regexp_replace(name, "^Customer#", "S").alias("prefix_gone"),
        F.concat(F.upper("c_mktsegment"), F.lit("_"), F.lower("c_mktsegment")).alias("joined"),
    )


@query(
    "scalar_parenthesised",
    """
    select p_partkey, array_to_string(regexp_extract_all(
      'Sampler # (' || p_brand || ') at (' || p_name || ')', '\\((.+?)\\)', 1), '|') as codes
    from part
    """,
)
def scalar_parenthesised(spark, sf):
    text = F.concat(
        F.lit("Sampler # ("), F.col("p_brand"), F.lit(") at ("), F.col("p_name"), F.lit(")")
    )
    return table(spark, sf, "part").select(
        "p_partkey", F.array_join(X.parenthesised(text), "|").alias("codes")
    )


@query(
    "scalar_rounding",
    """
    select o_orderkey, cast(ceil(o_totalprice / 1000) as bigint) + 3 as axis_max,
      round_even(o_totalprice / 1000, 0) as whole, round(sqrt(o_totalprice), 6) as root,
      round(abs(0.5 - o_totalprice / 500000), 9) as distance
    from orders
    """,
)
def scalar_rounding(spark, sf):
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        (F.ceil(price / 1000) + 3).alias("axis_max"),
        F.bround(price / 1000, 0).alias("whole"),
        r(F.sqrt(price)).alias("root"),
        r(F.abs(0.5 - price / 500000), 9).alias("distance"),
    )


PRIORITIES = ("5-LOW", "3-MEDIUM", "1-URGENT", "2-HIGH")


@query(
    "scalar_domain_order",
    """
    select o_orderkey, case o_orderpriority when '5-LOW' then 1 when '3-MEDIUM' then 2
      when '1-URGENT' then 3 when '2-HIGH' then 4 end as place from orders
    """,
)
def scalar_domain_order(spark, sf):
    place = X.domain_order(F.col("o_orderpriority"), PRIORITIES)
    return table(spark, sf, "orders").select("o_orderkey", place.alias("place"))
