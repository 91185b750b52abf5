from __future__ import annotations

from pyspark.sql import functions as F

from hazeline.operators import models as M
from hazeline.queries.base import query, rounded, table


@query(
    "model_simple_regression",
    """
    select event_type, regr_count(value, h) as n, round(regr_slope(value, h), 6) as slope,
      round(regr_intercept(value, h), 6) as intercept, round(regr_r2(value, h), 6) as r2
    from (select event_type, value, hour(ts) as h from events) group by event_type
    """,
)
def model_simple_regression(spark, sf):
    df = table(spark, sf, "events").select(
        "event_type", "value", F.hour("ts").cast("double").alias("h")
    )
    return rounded(
        M.simple_regression(df, ["event_type"], "value", "h"), 6, "slope", "intercept", "r2"
    )


# Days since 1970 around the middle of January 2024.
ORIGIN, SCALE = 19_738.0, 15.0


@query(
    "model_cubic_trend",
    # Another way to the same fit: orthogonal polynomials by their three-term recurrence,
    # then expanded into powers.
    f"""
    with p0 as (select event_type as g, value as y,
        (date_diff('day', date '1970-01-01', cast(ts as date)) - {ORIGIN}) / {SCALE} as x from events),
    a1 as (select g, avg(x) as a from p0 group by g),
    p1 as (select p0.*, x - a as q1, a as a1 from p0 join a1 using (g)),
    a2 as (select g, sum(x * q1 * q1) / sum(q1 * q1) as a, sum(q1 * q1) / count(*) as b
        from p1 group by g),
    p2 as (select p1.*, (x - a) * q1 - b as q2, a as a2, b as b1 from p1 join a2 using (g)),
    a3 as (select g, sum(x * q2 * q2) / sum(q2 * q2) as a, sum(q2 * q2) / sum(q1 * q1) as b
        from p2 group by g),
    p3 as (select p2.*, (x - a) * q2 - b * q1 as q3, a as a3, b as b2 from p2 join a3 using (g)),
    d as (select g, count(*) as n, avg(y) as d0, sum(y * q1) / sum(q1 * q1) as d1,
        sum(y * q2) / sum(q2 * q2) as d2, sum(y * q3) / sum(q3 * q3) as d3,
        any_value(a1) as a1, any_value(a2) as a2, any_value(a3) as a3,
        any_value(b1) as b1, any_value(b2) as b2 from p3 group by g)
    select g as event_type, n,
      round(d0 - a1 * d1 + (a1 * a2 - b1) * d2
        + (-a3 * (a1 * a2 - b1) + b2 * a1) * d3, 4) as c0,
      round(d1 - (a1 + a2) * d2 + ((a1 * a2 - b1) + a3 * (a1 + a2) - b2) * d3, 4) as c1,
      round(d2 - (a1 + a2 + a3) * d3, 4) as c2, round(d3, 4) as c3
    from d
    """,
)
def model_cubic_trend(spark, sf):
    fit = M.polynomial_trend(
        table(spark, sf, "events"), ["event_type"], "value",
        F.unix_date(F.to_date("ts")), ORIGIN, SCALE,
    )
    return rounded(fit, 4, "c0", "c1", "c2", "c3")


@query(
    "model_glm_categorical",
    # One category and one number: the fit has a closed form (pooled slope within groups).
    """
    with g as (select l_returnflag as f, count(*) as n, avg(l_quantity) as mx,
        avg(l_extendedprice) as my, var_pop(l_quantity) * count(*) as sxx,
        covar_pop(l_extendedprice, l_quantity) * count(*) as sxy,
        var_pop(l_extendedprice) * count(*) as syy from lineitem group by all),
    s as (select sum(sxy) / sum(sxx) as b, sum(sxx) as sxx,
        (sum(syy) - sum(sxy) * sum(sxy) / sum(sxx)) / (sum(n) - count(*) - 1) as v from g),
    l as (select f, n, mx, my - b * mx as a, b, v, s.sxx as w from g, s),
    base as (select * from l where f = (select min(f) from l)),
    out as (
      select 'l_quantity' as term, b as estimate, sqrt(v / w) as std_error from base
      union all select '(Intercept)', a, sqrt(v * (1 / n + mx * mx / w)) from base
      union all select 'l_returnflag_' || l.f, l.a - base.a,
        sqrt(l.v * (1 / l.n + 1 / base.n + (l.mx - base.mx) * (l.mx - base.mx) / l.w))
        from l, base where l.f <> base.f)
    select term, round(estimate, 3) as estimate, round(std_error, 3) as std_error from out
    """,
)
def model_glm_categorical(spark, sf):
    df = table(spark, sf, "lineitem").select("l_extendedprice", "l_returnflag", "l_quantity")
    fit = M.linear_model(df, "l_extendedprice ~ l_returnflag + l_quantity")
    return rounded(fit, 3, "estimate", "std_error")
