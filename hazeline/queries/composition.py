"""Domain transforms on lineitem columns as species."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazeline.operators.joins import literal_table
from hazeline.plans import compose, summaries
from hazeline.queries.base import query, r, rounded, table

# Species under the names the analysis uses: (expression valid in both SQL dialects, name).
SPECIES = {
    "station": "l_suppkey",
    "city": "l_returnflag",
    "month": "month(l_shipdate)",
    "spec_pm2_5": "l_extendedprice / 3000",
    "ions_ic_spec_tf_nitrate": "case when l_partkey % 11 = 0 then null else l_quantity / 10 end",
    "ions_ic_spec_tf_sulphate": "l_discount * 50",
    "ions_ic_spec_tf_ammonium": "case when l_orderkey % 13 = 0 then null else l_tax * 40 end",
    "ions_ic_spec_tf_sodium": "l_linenumber / 10",
    "ions_ic_spec_tf_chloride": "case when l_partkey % 7 = 0 then null else l_linenumber / 5 end",
    "ions_ic_tf_nitrate": "case when l_orderkey % 3 = 0 then null else l_quantity / 8 end",
    "ions_ic_tf_sulphate": "l_discount * 45",
    "ions_ic_tf_ammonium": "case when l_suppkey % 4 = 0 then null else l_tax * 35 end",
    "ions_ic_tf_sodium": "case when l_suppkey % 6 = 0 then null else l_linenumber / 7 end",
    "ions_ic_tf_chloride": "l_linenumber / 9",
    "ions_ic_dich_tf_sodium": "l_quantity / 100",
    "ions_ic_dich_tf_chloride": "l_quantity / 200",
    "ocec_spec_oc_corr": "l_extendedprice / 10000",
    "ocec_spec_oc_b": "l_extendedprice / 20000",
    "ocec_spec_ec_a": "case when l_suppkey % 5 = 0 then null else l_discount * 10 end",
    "ocec_spec_ec_b": "case when l_partkey % 3 = 0 then null else l_tax * 10 end",
    "edxrf_dich_silicon_si": "case when l_suppkey % 2 = 0 then null else l_tax * 2 end",
    "edxrf_dich_calcium_ca": "l_discount * 3",
    "edxrf_dich_iron_fe": "l_tax",
    "edxrf_dich_potassium_k": "l_discount",
    "edxrf_dich_titanium_ti": "l_tax / 4",
    "edxrf_spec_silicon_si": "l_tax * 3",
    "edxrf_spec_calcium_ca": "case when l_partkey % 17 = 0 then null else l_discount * 2 end",
    "edxrf_spec_iron_fe": "l_tax / 2",
    "edxrf_spec_potassium_k": "l_discount / 2",
    "edxrf_spec_titanium_ti": "l_tax / 8",
    "edxrf_silicon_si": "case when l_orderkey % 5 = 0 then null else l_tax * 2.5 end",
    "edxrf_calcium_ca": "l_discount * 2.5",
    "edxrf_iron_fe": "l_tax * 0.75",
    "edxrf_potassium_k": "l_discount * 0.75",
    "edxrf_titanium_ti": "l_tax / 5",
}
KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
SEASONS = ("spring", "summer", "fall", "winter")
# Ten digits in the outputs: exact products have at most nine, so no rounding ties occur.
# Season and city factors by rule; one pair is missing on purpose.
FACTORS = tuple(
    (s, c, 1.2 + 0.1 * i + 0.05 * j)
    for i, s in enumerate(SEASONS) for j, c in enumerate(("A", "N", "R"))
    if (s, c) != ("fall", "N")
)


def species(spark, sf):
    return table(spark, sf, "lineitem").select(
        *KEYS, F.to_date("l_shipdate").alias("date"),
        *[F.expr(e).alias(n) for n, e in SPECIES.items()],
    )


def factors(spark):
    return literal_table(spark, "season string, city string, correction_factor double", FACTORS)


def _soil(s):
    return (
        f"3.48 * edxrf_{s}silicon_si + 1.63 * edxrf_{s}calcium_ca + 1.63 * edxrf_{s}iron_fe"
        f" + 1.41 * edxrf_{s}potassium_k + 1.94 * edxrf_{s}titanium_ti"
    )


def _recon_sql(ions, salts, soils, oc):
    def over(samplers, template):
        return "coalesce(" + ", ".join(template.replace("@", s) for s in samplers) + ")"

    def soil():
        return "coalesce(" + ", ".join(_soil(s) for s in soils) + ")"

    i = "ions_ic_@tf_"
    return (
        "with sp as (select l_orderkey, l_linenumber, l_partkey, l_suppkey,"
        " cast(l_shipdate as date) as date, "
        + ", ".join(f"{e} as {n}" for n, e in SPECIES.items())
        + " from lineitem),"
        " fac as (select * from (values "
        + ", ".join(f"('{s}', '{c}', cast({v!r} as double))" for s, c, v in FACTORS)
        + ") as v(season, city, factor)),"
        " se as (select *, case when month in (3,4,5) then 'spring' when month in (6,7,8) then"
        " 'summer' when month in (9,10,11) then 'fall' else 'winter' end as season from sp),"
        " parts as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, date, station, month,"
        " spec_pm2_5, season, se.city,"
        f" {over(ions, f'1.29 * {i}nitrate')} as ANO3,"
        f" {over(ions, f'{i}sulphate + {i}ammonium - 0.29 * {i}nitrate')} as ASO4,"
        " case when ocec_spec_ec_a is null and ocec_spec_ec_b is null then null else"
        " coalesce(ocec_spec_ec_a, 0) + coalesce(ocec_spec_ec_b, 0) end as EC,"
        f" {soil()} as SOIL, {over(salts, f'{i}sodium + {i}chloride')} as NaCl,"
        f" {over(ions, f'0.32 * ({i}sulphate + {i}ammonium)')} as PBW,"
        f" {over(ions, f'{i}sulphate + {i}ammonium')} as PBW_h,"
        f" {over(ions, f'{i}ammonium - {i}sulphate - {i}nitrate')} as PBW_molar,"
        f" {oc} * factor as OM from se join fac using (season, city)),"
        " rec as (select *, NaCl + SOIL + EC + OM + ANO3 + ASO4 + PBW as total from parts)"
    )


MAIN = _recon_sql(["spec_"], ["spec_"], ["dich_", "spec_"], "ocec_spec_oc_corr")
FALLBACK = _recon_sql(
    ["spec_", ""], ["", "spec_", "dich_"], ["", "dich_", "spec_"], "ocec_spec_oc_b"
)
OUT = ("ANO3", "ASO4", "EC", "SOIL", "NaCl", "PBW", "PBW_h", "PBW_molar", "OM", "total")
_OUT_SQL = (
    " select l_orderkey, l_linenumber, l_partkey, l_suppkey, city, season, "
    + ", ".join(f"round({c}, 10) + 0.0 as {c}" for c in OUT)
    + " from rec"
)


def reconstructed(spark, sf):
    return compose.reconstruct_mass(species(spark, sf), factors(spark))


@query("dom_mass_reconstruction", MAIN + _OUT_SQL)
def dom_mass_reconstruction(spark, sf):
    return rounded(reconstructed(spark, sf).select(*KEYS, "city", "season", *OUT), 10, *OUT)


@query("dom_reconstruction_fallback", FALLBACK + _OUT_SQL)
def dom_reconstruction_fallback(spark, sf):
    rec = compose.reconstruct_mass(
        species(spark, sf), factors(spark), ion_samplers=("spec", ""),
        salt_samplers=("", "spec", "dich"), soil_samplers=("", "dich", "spec"),
        organic_carbon="ocec_spec_oc_b",
    )
    return rounded(rec.select(*KEYS, "city", "season", *OUT), 10, *OUT)


@query(
    "dom_mass_closure",
    MAIN
    + """ select city, count(spec_pm2_5 - total) as n, round(avg(spec_pm2_5 - total), 6) as mean_diff,
      round(avg(total / spec_pm2_5), 6) as mean_div from rec group by city""",
)
def dom_mass_closure(spark, sf):
    closed = compose.mass_closure(reconstructed(spark, sf))
    return closed.groupBy("city").agg(
        F.count("diff").alias("n"), r(F.avg("diff")).alias("mean_diff"),
        r(F.avg("div")).alias("mean_div"),
    )


@query(
    "dom_limit_substitution",
    """
    with t as (select l_orderkey, l_linenumber, l_partkey, l_suppkey,
        case when l_partkey % 9 = 0 then null else l_extendedprice / 10000 end as v,
        case when l_tax = 0 then null else l_tax * 100 end as m from lineitem)
    select l_orderkey, l_linenumber, l_partkey, l_suppkey,
      round(case when v is null then null when v < m then 0.5 * m when v >= m then v end, 6) as value,
      round(case when v < m then 0.5 * m else v end, 6) as kept from t
    """,
)
def dom_limit_substitution(spark, sf):
    df = table(spark, sf, "lineitem").select(
        *KEYS, F.expr("case when l_partkey % 9 = 0 then null else l_extendedprice / 10000 end").alias("value"),
        F.expr("case when l_tax = 0 then null else l_tax * 100 end").alias("value_mdl"),
    ).withColumn("kept", F.col("value"))
    kept = compose.substitute_limits(df, {"kept": "value_mdl"}, missing_limit="keep")
    both = compose.substitute_limits(kept, {"value": "value_mdl"})
    return rounded(both.drop("value_mdl"), 6, "value", "kept")


@query(
    "dom_blank_comparison",
    """
    with t as (select l_returnflag as city, l_shipdate < timestamp '1998-07-01' as early,
        l_quantity as a, case when l_partkey % 5 = 0 then null else l_discount end as b,
        l_tax as c, case when l_suppkey % 2 = 0 then null else l_discount end as d from lineitem),
    m as (select city, case when early then 'before' else 'after' end as period, avg(a) as a,
        avg(b) as b, avg(c + d) as c from t group by all)
    select city, period, 'mean_oc_cart_a' as type, round(a, 6) as val from m
    union all select city, period, 'mean_oc_cart_b', round(b, 6) from m
    union all select city, period, 'passive_travel_field_blank', round(c, 6) from m
    """,
)
def dom_blank_comparison(spark, sf):
    df = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("city"), F.to_date("l_shipdate").alias("date"),
        F.col("l_quantity").alias("a"),
        F.expr("case when l_partkey % 5 = 0 then null else l_discount end").alias("b"),
        F.col("l_tax").alias("c"),
        F.expr("case when l_suppkey % 2 = 0 then null else l_discount end").alias("d"),
    )
    return rounded(blank_means(df), 6, "val")


def blank_means(df):
    dated = summaries.with_period(df, F.lit("1998-07-01").cast("date"))
    return summaries.blank_comparison(dated, F.col("a"), F.col("b"), [F.col("c"), F.col("d")], ["city", "period"])


@query(
    "dom_blank_change",
    """
    with t as (select l_returnflag || l_linestatus as city, l_shipdate < timestamp '1998-07-01' as early,
        case when l_shipdate < timestamp '1998-07-01' then l_quantity else l_quantity + 1 end as a,
        case when l_partkey % 5 = 0 then null else l_discount end as b, l_tax as c, l_discount + l_tax as d from lineitem),
    m as (select city, early, avg(a) as a, avg(b) as b, avg(c + d) as c from t group by all),
    u as (select city, early, unnest(['mean_oc_cart_a', 'mean_oc_cart_b', 'passive_travel_field_blank']) as type, unnest([a, b, c]) as v from m),
    w as (select city, type, max(v) filter (not early) as after, max(v) filter (early) as before from u group by all)
    select city, type, round(after, 6) as after, round(before, 6) as before, round(after - before, 8) as diff, round(after / before, 8) as ratio,
      round(avg(after - before) over (partition by city), 8) as mean_diff from w where after is not null and before is not null
    """,
)
def dom_blank_change(spark, sf):
    """Carbon of cartridges and blanks before and after, by city and type, in one pass."""
    early = F.col("l_shipdate") < F.lit("1998-07-01")
    df = table(spark, sf, "lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("city"), F.to_date("l_shipdate").alias("date"),
        F.when(early, F.col("l_quantity")).otherwise(F.col("l_quantity") + 1).alias("a"),
        F.expr("case when l_partkey % 5 = 0 then null else l_discount end").alias("b"),
        F.col("l_tax").alias("c"), (F.col("l_discount") + F.col("l_tax")).alias("d"),
    )
    change = summaries.compare_long(blank_means(df), ["city", "type"])
    both = change.join(summaries.mean_difference(change, ["city"]), "city")
    return rounded(rounded(both, 6, "after", "before"), 8, "diff", "ratio", "mean_diff")


@query(
    "dom_season_means",
    MAIN
    + """, p as (select *, case when date < date '1998-07-01' then 'before' else 'after' end as period,
        case when month between 4 and 9 then 'summer' else 'winter' end as half from rec),
    u as (select city, period, half as season, """
    "unnest(['NaCl','SOIL','EC','OM','ANO3','ASO4','PBW']) as type,"
    " unnest([NaCl, SOIL, EC, OM, ANO3, ASO4, PBW]) as v from p)"
    " select city, period, season, type, round(avg(v), 6) as val from u group by all",
)
def dom_season_means(spark, sf):
    dated = summaries.with_period(reconstructed(spark, sf), F.lit("1998-07-01").cast("date"))
    return rounded(summaries.season_means(dated), 6, "val")


@query(
    "dom_top_days",
    MAIN
    + """, p as (select *, case when date < date '1998-07-01' then 'before' else 'after' end as period,
        case when month between 4 and 9 then 'summer' else 'winter' end as half from rec),
    k as (select *, row_number() over (partition by city, period, half
        order by spec_pm2_5 desc, l_orderkey, l_linenumber, l_partkey, l_suppkey, date) as n from p
      where period = 'before' or total is not null),
    u as (select city, period, half as season, """
    "unnest(['NaCl','SOIL','EC','OM','ANO3','ASO4','PBW']) as type,"
    " unnest([NaCl, SOIL, EC, OM, ANO3, ASO4, PBW]) as v from k where n <= 10)"
    " select city, period, season, type, round(avg(v), 10) as val from u group by all"
    " having avg(v) is not null",
)
def dom_top_days(spark, sf):
    dated = summaries.with_period(reconstructed(spark, sf), F.lit("1998-07-01").cast("date"))
    return rounded(summaries.top_days_composition(dated, [*KEYS, "date"]), 10, "val")
