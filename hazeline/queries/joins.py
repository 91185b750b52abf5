from __future__ import annotations

from pyspark.sql import functions as F

from hazeline.fixed_values import EARTH_RADIUS_KM, STUDY_CENTRE, STUDY_RADIUS_KM
from hazeline.operators import joins as J
from hazeline.operators.sizes import broadcast_if_small
from hazeline.queries.base import query, r, table, text_date


@query(
    "join_inner_broadcast",
    """
    select r_name, n_name, count(*) as suppliers, round(sum(s_acctbal), 2) as balance
    from supplier join nation on s_nationkey = n_nationkey
      join region on n_regionkey = r_regionkey
    group by all
    """,
)
def join_inner_broadcast(spark, sf):
    nation = broadcast_if_small(table(spark, sf, "nation"))
    region = broadcast_if_small(table(spark, sf, "region"))
    return (
        table(spark, sf, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name", "n_name")
        .agg(F.count(F.lit(1)).alias("suppliers"), r(F.sum("s_acctbal"), 2).alias("balance"))
    )


@query(
    "join_attach_by_key_date",
    """
    with w as (select o_custkey as city, cast(o_orderdate as date) as date,
        min(o_totalprice) as temp from orders where o_orderstatus = 'F' group by all)
    select o_orderkey, city, cast(date as varchar) as date, temp
    from orders join w on o_custkey = city and cast(o_orderdate as date) = date
    """,
)
def join_attach_by_key_date(spark, sf):
    """Attach daily side measurements (weather) to observations by city and date."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("city"), F.to_date("o_orderdate").alias("date"),
        "o_orderstatus", "o_totalprice",
    )
    weather = orders.where("o_orderstatus = 'F'").groupBy("city", "date").agg(
        F.min("o_totalprice").alias("temp")
    )
    return orders.join(weather, ["city", "date"]).select(
        "o_orderkey", "city", text_date("date").alias("date"), "temp"
    )


@query(
    "join_full_outer",
    """
    with c as (select c_nationkey as nation, count(*) as customers from customer
        where c_acctbal > 9000 group by all),
    s as (select s_nationkey as nation, count(*) as suppliers from supplier
        where s_acctbal > 5000 group by all)
    select nation, customers, suppliers from c full join s using (nation)
    """,
)
def join_full_outer(spark, sf):
    c = (
        table(spark, sf, "customer").where("c_acctbal > 9000")
        .groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("customers"))
    )
    s = (
        table(spark, sf, "supplier").where("s_acctbal > 5000")
        .groupBy(F.col("s_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("suppliers"))
    )
    return c.join(s, "nation", "full")


@query(
    "join_full_null_safe",
    """
    with a as (select case when o_orderstatus = 'P' then null else o_orderstatus end as status,
        year(o_orderdate) as year, count(*) as n from orders where month(o_orderdate) <= 8
        group by all),
    b as (select case when o_orderstatus = 'P' then null else o_orderstatus end as status,
        year(o_orderdate) as year, max(o_totalprice) as top from orders
        where year(o_orderdate) > 1996 group by all)
    select coalesce(a.status, b.status) as status, coalesce(a.year, b.year) as year, n, top
    from a full join b on a.status is not distinct from b.status and a.year = b.year
    """,
)
def join_full_null_safe(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.expr("case when o_orderstatus = 'P' then null else o_orderstatus end").alias("status"),
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), "o_totalprice",
    )
    a = orders.where("month <= 8").groupBy("status", "year").agg(F.count(F.lit(1)).alias("n"))
    b = orders.where("year > 1996").groupBy("status", "year").agg(F.max("o_totalprice").alias("top"))
    return J.null_safe_join(a, b, ["status", "year"], "full")


@query(
    "join_union_observations",
    """
    with t as (select case when o_orderstatus = 'P' then null else o_orderstatus end as status,
        o_custkey, cast(cast(o_orderdate as date) as varchar) as date from orders)
    select distinct * from t
    """,
)
def join_union_observations(spark, sf):
    """Two observation sets that overlap in part; equal rows collapse, nulls equal."""
    t = table(spark, sf, "orders").select(
        F.expr("case when o_orderstatus = 'P' then null else o_orderstatus end").alias("status"),
        "o_custkey", text_date("o_orderdate").alias("date"), "o_orderpriority",
    )
    early = t.where("o_orderpriority <= '3-MEDIUM'").drop("o_orderpriority")
    late = t.where("o_orderpriority >= '2-HIGH'").drop("o_orderpriority")
    return J.union_observations(early, late)


FOLDED = ("click", "error", "purchase", "signup", "view")


@query(
    "join_fold_full_outer",
    """
    with d as (select user_id, cast(ts as date) as date, event_type, max(value) as v
        from events group by all)
    select user_id, cast(date as varchar) as date, """
    + ", ".join(FOLDED)
    + " from "
    + " full join ".join(
        f"(select user_id, date, v as {k} from d where event_type = '{k}') t{i}"
        + (" using (user_id, date)" if i else "")
        for i, k in enumerate(FOLDED)
    ),
)
def join_fold_full_outer(spark, sf):
    long = table(spark, sf, "events").select(
        "user_id", F.to_date("ts").alias("date"), "event_type", "value"
    )
    folded = J.fold_full_outer(long, ["user_id", "date"], "event_type", "value", FOLDED)
    return folded.withColumn("date", text_date("date"))


@query(
    "merge_sources_first_value",
    """
    with t as (
      select user_id, cast(ts as date) as date, event_id,
        case event_type when 'purchase' then 0 when 'click' then 1 else 2 end as prio,
        case when event_type <> 'view' then value end as a,
        case when event_id % 4 = 0 then null else value end as b,
        case when event_type not in ('purchase', 'click') then value end as c
      from events)
    select user_id, cast(date as varchar) as date,
      arg_min(a, (prio, event_id)) filter (a is not null) as a,
      arg_min(b, (prio, event_id)) filter (b is not null) as b,
      arg_min(c, (prio, event_id)) filter (c is not null) as c
    from t group by all
    """,
)
def merge_sources_first_value(spark, sf):
    """Three sources with different columns, the more trusted one first."""
    events = table(spark, sf, "events").select(
        "user_id", F.to_date("ts").alias("date"), "event_id", "event_type",
        F.expr("case when event_type <> 'view' then value end").alias("a"),
        F.expr("case when event_id % 4 = 0 then null else value end").alias("b"),
        F.col("value").alias("c"),
    )
    kind = F.col("event_type")
    first = events.where(kind == "purchase").drop("event_type", "c")
    second = events.where(kind == "click").drop("event_type", "c")
    third = events.where(~kind.isin("purchase", "click")).drop("event_type")
    merged = J.merge_sources(
        [first, second, third], ["user_id", "date"], ["a", "b", "c"], ["event_id"]
    )
    return merged.withColumn("date", text_date("date"))


@query(
    "join_semi",
    """
    select c_custkey, c_name from customer
    where exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'P')
    """,
)
def join_semi(spark, sf):
    chosen = table(spark, sf, "orders").where("o_orderstatus = 'P'")
    return table(spark, sf, "customer").join(
        chosen, F.col("c_custkey") == F.col("o_custkey"), "left_semi"
    ).select("c_custkey", "c_name")


@query(
    "join_anti",
    """
    with t as (select event_id, case when event_id % 9 = 0 then null else user_id end as station
        from events)
    select event_id, station from t
    where not exists (select 1 from customer where c_custkey = station and c_acctbal > 5000)
    """,
)
def join_anti(spark, sf):
    known = table(spark, sf, "customer").where("c_acctbal > 5000").select("c_custkey")
    rows = table(spark, sf, "events").select(
        "event_id", F.expr("case when event_id % 9 = 0 then null else user_id end").alias("station")
    )
    return rows.join(known, F.col("station") == F.col("c_custkey"), "left_anti")


@query(
    "join_left_outer",
    """
    select event_id, user_id, c_name, n_name from events
      left join customer on user_id = c_custkey and c_mktsegment <> 'BUILDING'
      left join nation on c_nationkey = n_nationkey
    """,
)
def join_left_outer(spark, sf):
    info = table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'").join(
        broadcast_if_small(table(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return table(spark, sf, "events").join(
        info, F.col("user_id") == F.col("c_custkey"), "left"
    ).select("event_id", "user_id", "c_name", "n_name")


EXCLUDED = (
    ("1-URGENT", "1996-01-01", "1996-12-31"), ("2-HIGH", None, "1998-05-26"),
    ("5-LOW", "2000-01-01", None),
)


@query(
    "join_range_anti",
    """
    with t as (select o_orderkey, o_orderpriority as station,
        case when o_orderkey % 17 = 0 then null else cast(o_orderdate as date) end as date
      from orders),
    x as (select * from (values ('1-URGENT', date '1996-01-01', date '1996-12-31'),
        ('2-HIGH', null, date '1998-05-26'), ('5-LOW', date '2000-01-01', null))
        as v(station, from_date, to_date))
    select o_orderkey, t.station, cast(date as varchar) as date from t
    where not exists (select 1 from x where x.station = t.station and (date is null or (
      (from_date is null or date >= from_date) and (to_date is null or date <= to_date))))
    """,
)
def join_range_anti(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("station"),
        F.expr("case when o_orderkey % 17 = 0 then null else to_date(o_orderdate) end").alias("date"),
    )
    ranges = J.literal_table(spark, "station string, from_date date, to_date date", EXCLUDED)
    return J.anti_ranges(rows, ranges, "station").withColumn("date", text_date("date"))


@query(
    "join_range_anti_many",
    """
    with t as (select event_id, user_id, cast(ts as date) as date from events),
    x as (select o_custkey as user_id, case when o_orderkey % 50 = 0 then null else cast(o_orderdate as date) + 9861 end as f,
        case when o_orderkey % 70 = 1 then null else cast(o_orderdate as date) + (9861 + o_orderkey % 40)::int end as l from orders)
    select event_id, user_id, cast(date as varchar) as date from t where not exists (select 1 from x
      where x.user_id = t.user_id and (f is null or date >= f) and (l is null or date <= l))
    """,
)
def join_range_anti_many(spark, sf):
    """Every order excludes some days of its customer: as many ranges as orders."""
    rows = table(spark, sf, "events").select("event_id", "user_id", F.to_date("ts").alias("date"))
    day = F.date_add("o_orderdate", 9861)
    ranges = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("user_id"), F.when(F.col("o_orderkey") % 50 != 0, day).alias("from_date"),
        F.when(F.col("o_orderkey") % 70 != 1, F.date_add(day, (F.col("o_orderkey") % 40).cast("int"))).alias("to_date"),
    )
    return J.anti_ranges(rows, ranges, "user_id").withColumn("date", text_date("date"))


LAT = f"({STUDY_CENTRE[0]} + (c_custkey * 37 % 400 - 200) / 100.0)"
LON = f"({STUDY_CENTRE[1]} + (c_custkey * 53 % 600 - 300) / 100.0)"


@query(
    "join_radius",
    f"""
    with t as (select c_custkey, cast({LAT} as double) as lat, cast({LON} as double) as lon
        from customer),
    h as (select *, pow(sin(radians(lat - {STUDY_CENTRE[0]}) / 2), 2)
        + cos(radians({STUDY_CENTRE[0]})) * cos(radians(lat))
        * pow(sin(radians(lon - ({STUDY_CENTRE[1]})) / 2), 2) as a from t),
    d as (select c_custkey, {2 * EARTH_RADIUS_KM} * asin(sqrt(a)) as km from h)
    select c_custkey, round(km, 5) as distance_km from d where km < {STUDY_RADIUS_KM}
    """,
)
def join_radius(spark, sf):
    stations = table(spark, sf, "customer").select(
        "c_custkey",
        F.expr(LAT).cast("double").alias("latitude"), F.expr(LON).cast("double").alias("longitude"),
    )
    return J.within_radius(stations, STUDY_CENTRE, STUDY_RADIUS_KM).select(
        "c_custkey", r("distance_km", 5).alias("distance_km")
    )


CENTRE_KM = 40.0
CENTRE_LAT = f"({STUDY_CENTRE[0]} + (s_suppkey * 41 % 500 - 250) / 100.0)"
CENTRE_LON = f"({STUDY_CENTRE[1]} + (s_suppkey * 59 % 700 - 350) / 100.0)"


@query(
    "join_radius_many",
    f"""
    with t as (select c_custkey, cast({LAT} as double) as lat, cast({LON} as double) as lon from customer),
    c as (select s_suppkey, cast({CENTRE_LAT} as double) as lat0, cast({CENTRE_LON} as double) as lon0 from supplier),
    d as (select s_suppkey, c_custkey, {2 * EARTH_RADIUS_KM} * asin(sqrt(pow(sin(radians(lat - lat0) / 2), 2)
        + cos(radians(lat0)) * cos(radians(lat)) * pow(sin(radians(lon - lon0) / 2), 2))) as km from t, c)
    select s_suppkey, c_custkey, round(km, 5) as distance_km from d where km < {CENTRE_KM}
    """,
)
def join_radius_many(spark, sf):
    """Every supplier as a centre."""
    points = table(spark, sf, "customer").select(
        "c_custkey", F.expr(LAT).cast("double").alias("latitude"), F.expr(LON).cast("double").alias("longitude"),
    )
    centres = table(spark, sf, "supplier").select(
        "s_suppkey", F.expr(CENTRE_LAT).cast("double").alias("centre_latitude"), F.expr(CENTRE_LON).cast("double").alias("centre_longitude"),
    )
    return J.near_centres(points, centres, CENTRE_KM).select("s_suppkey", "c_custkey", r("distance_km", 5).alias("distance_km"))


PUBLISHED = (("1-URGENT", 3000), ("2-HIGH", 2900), ("5-LOW", 3100), ("9-OTHER", 10))


@query(
    "join_reference_diff",
    f"""
    with p as (select * from (values {", ".join(map(str, PUBLISHED))}) as v(station, n_published)),
    c as (select o_orderpriority as station, count(*) as n from orders group by all)
    select station, n, n_published, n - n_published as diff from c join p using (station)
    """,
)
def join_reference_diff(spark, sf):
    counts = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("station")).agg(
        F.count(F.lit(1)).alias("n")
    )
    published = J.literal_table(spark, "station string, n_published bigint", PUBLISHED)
    return J.compare_with_reference(counts, published, "station", "n", "n_published")
