from __future__ import annotations

from pyspark.sql import functions as F

from hazeline.fixed_values import CANONICAL_PREFIXES
from hazeline.functions.text import clean_name_column, sampler_kind
from hazeline.operators import columns as C
from hazeline.operators import naming as N
from hazeline.operators import quality as Q
from hazeline.operators.joins import literal_table
from hazeline.queries.base import query, r, table


@query(
    "proj_clean_names",
    """
    select c_custkey as customer_key, c_name as name_of_customer_number,
      c_acctbal as acct_bal_percent, c_mktsegment as p_t, c_nationkey as p_t_2 from customer
    """,
)
def proj_clean_names(spark, sf):
    df = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customerKey"),
        F.col("c_name").alias("Name of Customer #"),
        F.col("c_acctbal").alias("Acct. Bal (%)"),
        F.col("c_mktsegment").alias("P/T"),
        F.col("c_nationkey").alias("p t"),
    )
    return C.with_clean_names(df)


@query(
    "proj_clean_name_column",
    """
    select p_partkey, replace(p_name, ' ', '_') || '_ug_m3' as col_name,
      lower(p_type) || '_brand_number_' || regexp_extract(p_brand, '[0-9]+') as brand from part
    """,
)
def proj_clean_name_column(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        clean_name_column(F.concat("p_name", F.lit(" (ug/m3)"))).alias("col_name"),
        clean_name_column(F.concat("p_type", F.lit(" ")  , F.col("p_brand"))).alias("brand"),
    )


@query(
    "proj_prefix_rename",
    """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity as fb_l_quantity,
      l_discount as fb_l_discount, l_tax as fb_l_tax from lineitem
    """,
)
def proj_prefix_rename(spark, sf):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    df = table(spark, sf, "lineitem").select(*keys, "l_quantity", "l_discount", "l_tax")
    return C.with_prefix(df, "fb_", keys)


@query(
    "proj_select_pattern",
    """
    select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
      l_discount, l_tax from lineitem
    """,
)
def proj_select_pattern(spark, sf):
    return C.select_matching(table(spark, sf, "lineitem"), "flag|status|DATE", invert=True)


@query(
    "proj_drop_null_columns",
    "select c_custkey, c_name, c_acctbal from customer",
)
def proj_drop_null_columns(spark, sf):
    df = table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_acctbal",
        F.expr("case when c_custkey < 0 then c_mktsegment end").alias("empty_text"),
        F.expr("case when c_nationkey > 1000 then c_nationkey end").alias("empty_number"),
    )
    return Q.drop_null_columns(df)


@query(
    "proj_dictionary_rename",
    """
    select coalesce(new_name, lower(event_type)) as col_name, count(*) as n,
      round(sum(value), 4) as total
    from events left join (values ('click', 'so2'), ('view', 'no2'), ('error', 'o3'))
      as d(old_name, new_name) on event_type = old_name
    group by all
    """,
)
def proj_dictionary_rename(spark, sf):
    dictionary = literal_table(
        spark, "old_name string, new_name string",
        [("click", "SO2"), ("view", "NO2"), ("error", "O3")],
    )
    long = table(spark, sf, "events").select(F.col("event_type").alias("col_name"), "value")
    return C.rename_long(long, dictionary).groupBy("col_name").agg(
        F.count(F.lit(1)).alias("n"), r(F.sum("value"), 4).alias("total")
    )


@query(
    "proj_dictionary_select",
    """
    select new_name as col_name, event_id, value from events
    join (values ('click', 'so2'), ('view', 'no2')) as d(old_name, new_name)
      on event_type = old_name
    """,
)
def proj_dictionary_select(spark, sf):
    dictionary = literal_table(
        spark, "old_name string, new_name string", [("click", "SO2"), ("view", "NO2")]
    )
    long = table(spark, sf, "events").select(
        F.col("event_type").alias("col_name"), "event_id", "value"
    )
    return C.rename_long(long, dictionary, keep_unmapped=False)


@query(
    "proj_value_limit_pairs",
    """
    with long as (
      select l_orderkey, l_linenumber, l_partkey, l_suppkey, 'quantity' as species,
        l_quantity as value, l_discount * 300 as mdl from lineitem
      union all
      select l_orderkey, l_linenumber, l_partkey, l_suppkey, 'price', l_extendedprice, l_tax * 1e6
      from lineitem)
    select l_orderkey, l_linenumber, l_partkey, l_suppkey,
      case species when 'quantity' then 'dich_amount' else 'dich_price' end as value_name,
      case species when 'quantity' then 'dich_amount_mdl' else 'dich_price_mdl' end as limit_name,
      case species when 'quantity' then 'PM2.5' else 'No file' end as file_type,
      round(value, 4) as value, round(mdl, 4) as mdl
    from long
    """,
)
def proj_value_limit_pairs(spark, sf):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    df = table(spark, sf, "lineitem").select(
        *keys, "l_quantity", (F.col("l_discount") * 300).alias("q_d_l"),
        "l_extendedprice", (F.col("l_tax") * 1e6).alias("p_d_l"),
    )
    long = C.value_limit_pairs(
        df, keys,
        [("quantity", "l_quantity", "q_d_l"), ("price", "l_extendedprice", "p_d_l")],
    )
    scheme = literal_table(
        spark, "old_name string, new_name string, mdl_name string, file_type string",
        [("quantity", "amount", "amount_mdl", "PM2.5"), ("other", "x", "x_mdl", "PM2.5")],
    )
    routed = C.route_pairs(long, scheme, "dich").drop("species")
    return routed.withColumns({"value": r("value", 4), "mdl": r("mdl", 4)})


@query(
    "proj_scheme_substitution",
    """
    select p_partkey, replace(replace(p_name, 'red', 'dich_pm2_5_10'), 'bolt', 'PM2.5-10')
      as new_name, replace(replace(p_type, 'red', 'dich_pm2_5_10'), 'bolt', 'PM2.5-10')
      as file_type from part
    """,
)
def proj_scheme_substitution(spark, sf):
    scheme = table(spark, sf, "part").select(
        "p_partkey", F.col("p_name").alias("new_name"), F.col("p_type").alias("file_type")
    )
    return C.substitute_in_scheme(
        scheme, [("red", "dich_pm2_5_10"), ("bolt", "PM2.5-10")], ["new_name", "file_type"]
    )


@query(
    "proj_column_fixups",
    """
    select o_orderkey, case when o_custkey % 2 = 0 then o_orderpriority else o_orderstatus end
      as cart, coalesce(case when o_orderkey % 3 = 0 then null else o_totalprice end,
        case when o_orderstatus = 'F' then o_totalprice / 2 end) as mass
    from orders
    """,
)
def proj_column_fixups(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus",
        F.expr("case when o_custkey % 2 = 0 then o_orderpriority end").alias("cart"),
        F.col("o_orderstatus").alias("x0"),
        F.expr("case when o_orderkey % 3 = 0 then null else o_totalprice end").alias("mass"),
        F.expr("o_totalprice / 2").alias("mas_sp"),
    )
    fixed = C.fallback_columns(df, {"cart": "x0"})
    fixed = C.fallback_columns(fixed, {"mass": "mas_sp"}, F.col("o_orderstatus") == "F")
    return fixed.select("o_orderkey", "cart", "mass")


@query(
    "proj_recode",
    """
    select o_orderkey, case when o_orderstatus = 'P' then 'C' else o_orderstatus end as media,
      case when lower(o_orderpriority) like '%spec%' then 'spec'
        when lower(o_orderpriority) like '%urgent%' then 'dich' else 'pm' end as kind
    from orders
    """,
)
def proj_recode(spark, sf):
    label = F.replace(F.col("o_orderpriority"), F.lit("URGENT"), F.lit("Dichotomous"))
    label = F.replace(label, F.lit("NOT SPECIFIED"), F.lit("NOT SPEC"))
    media = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(media == "P", "C").otherwise(media).alias("media"),
        sampler_kind(label).alias("kind"),
    )


def _rewrite_sql(name: str) -> str:
    """The prefix rules as a CASE, later rules first."""
    cases = " ".join(
        f"when contains({name}, '{old}') then regexp_replace({name}, '{old}', '{new}', 'i')"
        for old, new in reversed(CANONICAL_PREFIXES)
    )
    return (
        f"case {cases} else replace(replace(replace({name}, ' ', ''), 'dich_', 'dich.'),"
        f" 'spec_', 'spec.') end"
    )


METHODS = (
    "Ions_IC_spec_tf_", "Ions_IC_", "EDXRF_dich_", "OCEC_spec_", "Metals_ICPMS_NT_", "spec_",
    "dich_", "",
)
_METHOD_CASE = " ".join(f"when {i} then '{m}'" for i, m in enumerate(METHODS))


@query(
    "proj_rewrite_rules",
    f"""
    with t as (select p_partkey,
      case p_partkey % {len(METHODS)} {_METHOD_CASE} end || p_name || '_' || lower(p_type)
      as name from part)
    select p_partkey, {_rewrite_sql("name")} as new_name from t
    """,
)
def proj_rewrite_rules(spark, sf):
    name = F.concat(
        F.expr(f"case p_partkey % {len(METHODS)} {_METHOD_CASE} end"),
        F.col("p_name"), F.lit("_"), F.lower("p_type"),
    )
    return table(spark, sf, "part").select(
        "p_partkey", N.rewrite_by_prefix(name).alias("new_name")
    )


# Value names built from the parts, limit names of a bounded list.
LIMITS = (
    "EDXRF_dich_small_mdl", "EDXRF_spec_ring_r_mdl", "Ions_IC_spec_red_mdl", "IC_spec_mdl",
    "OCEC_spec_bolt_b_mdl", "red_widget_mdl", "EDXRF_bolt_mdl", "EDXRF_dich_blue_b_promo_mdl",
    "x_economy_mdl",
)
_CASCADE = (
    "v || '_mdl' = m",
    "contains(m, f(1) || '_' || f(2) || '_' || f(4))",
    "contains(m, f(2) || '_' || f(3))",
    "contains(m, f(1) || '_' || f(3))",
    "contains(m, f(1) || '_' || f(2) || '_' || f(3) || '_' || f(5))",
    "contains(m, f(3) || '_' || f(4) || '_' || f(5))",
    "contains(m, f(3) || '_' || f(4))",
    "contains(m, f(5) || '_' || f(6))",
    "contains(m, f(5))",
    "contains(m, '_' || f(6) || '_')",
    "contains(m, f(1) || '_' || f(2) || '_' || f(3) || '_' || f(4) || '_' || f(6))",
)


def _cascade_sql() -> str:
    import re

    rules = " union all ".join(
        f"select v, {i} as rule, m from names, limits where "
        + re.sub(r"f\((\d)\)", r"coalesce(string_split(v, '_')[\1], 'NA')", cond)
        for i, cond in enumerate(_CASCADE)
    )
    limits = ", ".join(f"('{m}')" for m in LIMITS)
    return f"""
    with limits as (select * from (values {limits}) as l(m)),
    parts as (select p_partkey, case p_partkey % 4 when 0 then 'EDXRF_dich_' when 1 then
        'EDXRF_spec_' when 2 then 'Ions_IC_spec_' else 'OCEC_spec_' end
        || replace(p_name, ' ', '_') || '_' || lower(p_type) as v from part),
    names as (select distinct v from parts),
    hits as (select *, count(*) over (partition by v, rule) as n from ({rules})),
    best as (select v, min_by(m, rule) as mdl from hits where n = 1 group by v)
    select p_partkey, v as value_name, mdl from parts left join best using (v)
    """


@query("lookup_rule_cascade", _cascade_sql())
def lookup_rule_cascade(spark, sf):
    name = F.concat(
        F.expr(
            "case p_partkey % 4 when 0 then 'EDXRF_dich_' when 1 then 'EDXRF_spec_' "
            "when 2 then 'Ions_IC_spec_' else 'OCEC_spec_' end"
        ),
        F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), F.lit("_"), F.lower("p_type"),
    )
    parts = table(spark, sf, "part").select("p_partkey", name.alias("value_name"))
    limits = literal_table(spark, "limit string", [(m,) for m in LIMITS])
    return N.with_limit_names(parts, "value_name", limits, "mdl")


@query(
    "proj_add_missing",
    """
    select s_suppkey, s_acctbal, cast(null as double) as ions_ic_tf_sodium,
      cast(null as double) as pm2_5 from supplier
    """,
)
def proj_add_missing(spark, sf):
    df = table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    return C.add_missing(df, ["s_acctbal", "ions_ic_tf_sodium", "pm2_5", "pm2_5"])
