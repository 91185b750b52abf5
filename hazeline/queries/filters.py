from __future__ import annotations

from pyspark.sql import functions as F

from hazeline.operators import quality as Q
from hazeline.queries.base import query, r, table


@query(
    "filter_allow_list",
    """
    select event_id, user_id, event_type from events
    where event_type in ('click', 'view', 'purchase')
    """,
)
def filter_allow_list(spark, sf):
    return table(spark, sf, "events").where(
        F.col("event_type").isin("click", "view", "purchase")
    ).select("event_id", "user_id", "event_type")


@query(
    "filter_name_regex",
    """
    select p_partkey, p_name from part
    where not regexp_matches(p_name, '(?i)bolt|RING|^red|[/]$')
    """,
)
def filter_name_regex(spark, sf):
    return table(spark, sf, "part").where(
        ~F.col("p_name").rlike("(?i)bolt|RING|^red|[/]$")
    ).select("p_partkey", "p_name")


@query(
    "filter_blank_split",
    """
    with t as (
      select case when l_partkey % 7 = 0 then null when l_returnflag = 'A' then 'TB'
        else l_returnflag end as cart, l_quantity from lineitem)
    select case when coalesce(cart in ('TB', 'FB'), false) then 'blank' else 'sample' end
        as branch, cart, count(*) as n, sum(l_quantity) as quantity
    from t group by all
    """,
)
def filter_blank_split(spark, sf):
    df = table(spark, sf, "lineitem").select(
        F.expr(
            "case when l_partkey % 7 = 0 then null when l_returnflag = 'A' then 'TB' "
            "else l_returnflag end"
        ).alias("cart"),
        "l_quantity",
    )
    samples, blanks = Q.split_blanks(df)
    both = samples.withColumn("branch", F.lit("sample")).unionByName(
        blanks.withColumn("branch", F.lit("blank"))
    )
    return both.groupBy("branch", "cart").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")
    )


@query(
    "filter_fraction_split",
    """
    select l_linestatus as fraction, l_returnflag,
      round(sum(case when l_linestatus = 'F' then l_quantity end), 4) as fine_mass,
      round(sum(case when l_linestatus = 'O' then l_quantity end), 4) as coarse_mass
    from lineitem group by all
    """,
)
def filter_fraction_split(spark, sf):
    df = table(spark, sf, "lineitem").select(
        F.when(F.col("l_linestatus") == "O", "C").otherwise("F").alias("c_f"),
        "l_linestatus", "l_returnflag", F.col("l_quantity").alias("mass"),
    )
    parts = Q.split_fractions(df, "c_f", "mass", {"F": "fine_mass", "C": "coarse_mass"})
    both = parts["F"].unionByName(parts["C"], allowMissingColumns=True)
    return both.groupBy(F.col("l_linestatus").alias("fraction"), "l_returnflag").agg(
        r(F.sum("fine_mass"), 4).alias("fine_mass"),
        r(F.sum("coarse_mass"), 4).alias("coarse_mass"),
    )
