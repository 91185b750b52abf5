from __future__ import annotations

from pyspark.sql import functions as F

from hazeline.operators import sets as S
from hazeline.queries.base import query, table


@query(
    "set_union_by_name",
    """
    select 'customer' as station, c_custkey as id, c_nationkey as nation, c_acctbal as balance,
      c_mktsegment as segment from customer
    union all select 'supplier', s_suppkey, s_nationkey, s_acctbal, null from supplier
    """,
)
def set_union_by_name(spark, sf):
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
    )
    supplier = table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"),
        F.col("s_nationkey").alias("nation"),
    )
    return S.bind_rows({"customer": customer, "supplier": supplier}, "station")


@query(
    "set_union_all",
    """
    select event_id, event_type, value, 'yes' as edmon from events where event_type = 'click'
    union all select event_id, event_type, value, 'no' from events where event_type <> 'click'
    union all select event_id, event_type, value, 'no' from events
      where event_type = 'click' and value < 50
    """,
)
def set_union_all(spark, sf):
    """A branch relabelled in place, and part of it repeated under the other label."""
    df = table(spark, sf, "events").select(
        "event_id", "event_type", "value", F.lit("no").alias("edmon")
    )
    click = F.col("event_type") == "click"
    labelled = S.relabel_branch(df, click, {"edmon": F.lit("yes")})
    return S.add_relabelled_copy(labelled, click & (F.col("value") < 50), {"edmon": F.lit("no")})


@query(
    "set_distinct",
    "select distinct user_id, event_type from events",
)
def set_distinct(spark, sf):
    return table(spark, sf, "events").select("user_id", "event_type").distinct()


def _keys(spark, sf):
    users = table(spark, sf, "events").where("event_type <> 'view'").select(F.col("user_id").alias("k"))
    customers = table(spark, sf, "customer").where("c_acctbal > 2000").select(F.col("c_custkey").alias("k"))
    return customers, users


@query(
    "set_except",
    """
    select c_custkey as k from customer where c_acctbal > 2000
    except select user_id from events where event_type <> 'view'
    """,
)
def set_except(spark, sf):
    customers, users = _keys(spark, sf)
    return customers.subtract(users)


@query(
    "set_intersect",
    """
    select c_custkey as k from customer where c_acctbal > 2000
    intersect select user_id from events where event_type <> 'view'
    """,
)
def set_intersect(spark, sf):
    customers, users = _keys(spark, sf)
    return customers.intersect(users)
