"""Whole flows on the stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazeline.operators.joins import literal_table
from hazeline.plans import daily_stations, harmonise, sampler_timeline
from hazeline.queries.aggregates import hour_wide
from hazeline.queries.base import query, rounded, table, text_date

POLLUTANTS = ("click", "error", "purchase", "signup", "view")


@query(
    "pipe_daily_station_table",
    """
    with h as (select event_type, user_id, cast(ts as date) as date, hour(ts) as hr, avg(value) as v
        from events group by all),
    d as (select event_type, user_id as napsid, date, avg(v) as s from h group by all),
    w as (select napsid, date, """
    + ", ".join(
        f"max(s) filter (event_type = '{p}') as hourly_mean_{p}" for p in POLLUTANTS
    )
    + """ from d group by all),
    m as (select c_custkey as napsid, cast(o_orderdate as date) + 9861 as date,
        max(o_totalprice) as spec_pm2_5 from orders join customer on o_custkey = c_custkey
        group by all)
    select napsid, cast(date as varchar) as date, year(date) as year, month(date) as month,
      day(date) as day, """
    + ", ".join(f"round(hourly_mean_{p}, 6) as hourly_mean_{p}" for p in POLLUTANTS)
    + """, spec_pm2_5, c_name as station_name, c_mktsegment as city
    from w full join m using (napsid, date)
      left join (select * from customer where c_mktsegment <> 'BUILDING') on c_custkey = napsid
    """,
)
def pipe_daily_station_table(spark, sf):
    hourly = hour_wide(table(spark, sf, "events"))
    wide = daily_stations.spread_pollutants(daily_stations.daily_means(hourly), POLLUTANTS)
    mass = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("napsid"), F.date_add("o_orderdate", 9861).alias("date"))
        .agg(F.max("o_totalprice").alias("spec_pm2_5"))
    )
    stations = table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("napsid"), F.col("c_name").alias("station_name"),
        F.col("c_mktsegment").alias("city"),
    )
    result = daily_stations.daily_station_table(wide, [mass], stations)
    return rounded(
        result.withColumn("date", text_date("date")), 6, *[f"hourly_mean_{p}" for p in POLLUTANTS]
    )


@query(
    "pipe_sampler_timeline",
    """
    with s as (select o_custkey as station, year(o_orderdate) as year,
        case o_orderstatus when 'F' then 'Spec' when 'O' then 'Dichot' else 'PM' end as type,
        o_orderpriority as sampler from orders),
    k as (select s.*, c_mktsegment as city from s join customer on station = c_custkey
      where not (station = 7 and year = 1998) and not (station = 11 and year < 1999)),
    r as (select year, type, city, case when city = 'MACHINERY' and type = 'PM'
        then 'Manual sampler' else sampler end as sampler from k)
    select city, type, sampler, cast(make_date(min(year), 1, 1) as varchar) as start,
      cast(make_date(max(year), 12, 31) as varchar) as end,
      case type when 'Spec' then '#F8766D' when 'Dichot' then '#B79F00' else '#00BA38' end as colour
    from r group by all
    """,
)
def pipe_sampler_timeline(spark, sf):
    samplers = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("station"), F.year("o_orderdate").alias("year"),
        F.expr("case o_orderstatus when 'F' then 'Spec' when 'O' then 'Dichot' else 'PM' end").alias("type"),
        F.col("o_orderpriority").alias("sampler"),
    )
    stations = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("station"), F.col("c_mktsegment").alias("city")
    )
    exclusions = literal_table(
        spark, "station bigint, from_date date, to_date date",
        [(7, "1998-01-01", "1998-12-31"), (11, None, "1998-12-31")],
    )
    result = sampler_timeline.sampler_timeline(
        samplers, stations, exclusions, "MACHINERY", "PM", "Manual sampler"
    )
    return result.withColumns({"start": text_date("start"), "end": text_date("end")})


@query(
    "pipe_harmonise",
    """
    with t as (select case when o_orderkey % 31 = 0 then null else o_custkey end as station,
        cast(o_orderdate as date) as date, o_orderkey,
        case o_orderpriority when '1-URGENT' then 'C' else 'F' end as fraction,
        case when o_orderpriority = '5-LOW' then true else false end as is_blank,
        o_orderstatus as file_type, case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end
        as prio, o_totalprice as mass, case when o_orderkey % 3 = 0 then null
        else o_totalprice / 7 end as ion from orders),
    u as (select station, date, fraction, is_blank, prio, o_orderkey, 'spec_mass' as col_name,
        mass as value from t
      union all select station, date, fraction, is_blank, prio, o_orderkey, 'spec_ion', ion from t
        where ion is not null),
    m as (select station, date, fraction, is_blank, col_name,
        arg_min(value, (prio, o_orderkey)) as value from u where station is not null group by all)
    select station, cast(date as varchar) as date, year(date) as year, month(date) as month,
      day(date) as day, fraction, is_blank,
      max(value) filter (col_name = 'spec_mass') as "PM_spec_mass",
      round(max(value) filter (col_name = 'spec_ion'), 4) as "PM_spec_ion"
    from m group by station, date, fraction, is_blank
    """,
)
def pipe_harmonise(spark, sf):
    """Three sources of different trust, merged to one value per cell, then wide."""
    orders = table(spark, sf, "orders").select(
        F.lit(0).alias("file_no"), F.col("o_orderkey").alias("row_no"),
        F.expr("case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end").alias("source_priority"),
        F.expr("case when o_orderkey % 31 = 0 then null else o_custkey end").alias("station"),
        F.to_date("o_orderdate").alias("date"),
        F.expr("case o_orderpriority when '1-URGENT' then 'C' else 'F' end").alias("fraction"),
        (F.col("o_orderpriority") == "5-LOW").alias("is_blank"),
        # from a column, as in the files, so that the join with the short names has a key
        F.when(F.col("o_orderkey").isNotNull(), "PM2.5").alias("file_type"),
        F.col("o_totalprice").alias("spec_mass"),
        F.expr("case when o_orderkey % 3 = 0 then null else o_totalprice / 7 end").alias("spec_ion"),
    )
    ids = ["source_priority", *harmonise.ORDER, *harmonise.LONG[:5]]
    long = orders.unpivot(ids, ["spec_mass", "spec_ion"], "col_name", "value").where(
        F.col("value").isNotNull()
    )
    short = literal_table(spark, "file_type string, short_name string", [("PM2.5", "PM")])
    merged, _ = harmonise.merge_long(long, short)
    keyed = ["fraction", "is_blank"]
    wide = harmonise.widen(merged, ["PM_spec_mass", "PM_spec_ion"], keyed)
    return rounded(wide.withColumn("date", text_date("date")), 4, "PM_spec_ion")
