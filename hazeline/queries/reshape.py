from __future__ import annotations

from pyspark.sql import functions as F

from hazeline.operators import reshape as S
from hazeline.queries.base import query, r, table, text_date

KINDS = ("click", "error", "purchase", "signup", "view")


@query(
    "reshape_pivot_multi",
    "select user_id, "
    + ", ".join(
        f"min(case when event_type = '{k}' then {v} end) as cart_{k}_{v}"
        for v in ("value", "event_id") for k in KINDS
    )
    + " from events group by all",
)
def reshape_pivot_multi(spark, sf):
    return S.spread_many(
        table(spark, sf, "events"), ["user_id"], "event_type", KINDS, ["value", "event_id"],
        "cart_{name}_{value}",
    )


@query(
    "reshape_spread",
    "select user_id, cast(cast(ts as date) as varchar) as date, "
    + ", ".join(f"max(case when event_type = '{k}' then value end) as {k}" for k in KINDS)
    + " from events group by user_id, cast(ts as date)",
)
def reshape_spread(spark, sf):
    return (
        table(spark, sf, "events")
        .groupBy("user_id", text_date("ts").alias("date"))
        .pivot("event_type", list(KINDS))
        .agg(F.max("value"))
    )


@query(
    "reshape_unpivot",
    """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, 'quantity' as type,
      case when l_partkey % 5 = 0 then null else l_quantity end as val from lineitem
    union all select l_orderkey, l_linenumber, l_partkey, l_suppkey, 'tax', l_tax from lineitem
    """,
)
def reshape_unpivot(spark, sf):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    df = table(spark, sf, "lineitem").select(
        *keys, F.expr("case when l_partkey % 5 = 0 then null else l_quantity end").alias("quantity"),
        F.col("l_tax").alias("tax"),
    )
    return S.gather(df, keys, ["quantity", "tax"])


@query(
    "reshape_complete",
    """
    with m as (select event_type as city, user_id as type, round(avg(value), 6) as val
        from events where event_type <> 'signup' group by all)
    select c.city, k.type, m.val from (select distinct type from m) k,
      (values ('click'), ('error'), ('purchase'), ('signup'), ('view')) as c(city)
      left join m on m.city = c.city and m.type = k.type
    """,
)
def reshape_complete(spark, sf):
    means = (
        table(spark, sf, "events").where("event_type <> 'signup'")
        .groupBy(F.col("event_type").alias("city"), F.col("user_id").alias("type"))
        .agg(r(F.avg("value")).alias("val"))
    )
    return S.complete(means, "city", KINDS, ["type"])
