from datetime import date

import pytest
from pyspark.sql import functions as F

from hazeline.functions import dates as D
from hazeline.functions import numeric as N
from hazeline.functions import text as X
from hazeline.functions.stats import t_cdf, t_quantile, t_quantile_column, t_table


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("dof,expected", [(1, 6.313752), (9, 1.833113), (29, 1.699127)])
def test_t_quantile(dof, expected):
    assert t_quantile(0.95, dof) == pytest.approx(expected, abs=1e-6)


def test_t_table_inverts_the_distribution_function():
    for dof in (2, 5, 50, 200):
        assert t_cdf(t_table(0.95)[dof - 1], dof) == pytest.approx(0.95, abs=1e-12)


def test_t_column_is_continuous_at_the_table_end(spark):
    dofs = (0, 1, 200, 201, 1500, 10_000_000)
    df = spark.createDataFrame([(d,) for d in dofs], "d bigint").coalesce(1)
    got = [r.q for r in df.select(t_quantile_column(0.95, F.col("d")).alias("q")).collect()]
    assert got[0] is None
    assert got[1] == pytest.approx(6.313752, abs=1e-6)
    for q, d in zip(got[2:5], dofs[2:5]):
        assert q == pytest.approx(t_quantile(0.95, d), abs=1e-10)
    assert got[5] == pytest.approx(1.6448536, abs=1e-6)


def test_clean_names():
    names = ["NAPSID", "P/T", "Date", "Date", "PM2.5 (ug/m3)", "2nd", None, "sampleType", "% RH"]
    assert X.clean_names(names) == [
        "napsid", "p_t", "date", "date_2", "pm2_5_ug_m3", "x2nd", "x", "sample_type", "percent_rh",
    ]


def test_clean_name_column_agrees(spark):
    names = ["NAPSID", "P/T", "PM2.5 (ug/m3)", "2nd", "sampleType", "% RH", "Méthode", "", "_a_"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    got = [r.c for r in df.select("i", X.clean_name_column(F.col("n")).alias("c")).orderBy("i").collect()]
    assert got == [X.clean_name(n) for n in names]


@pytest.mark.parametrize("token", ["NA", "", " ", "-", "-999", "-999.000", " NA "])
def test_missing_tokens(spark, token):
    assert one(spark, X.na_to_null(F.lit(token))) is None


def test_values_are_trimmed(spark):
    assert one(spark, X.na_to_null(F.lit(" -9 "))) == "-9"


def test_bad_text_and_nan_become_null(spark):
    assert one(spark, N.to_double(F.lit("12x"))) is None
    assert one(spark, N.to_double(F.lit("NaN"))) is None
    assert one(spark, N.to_double(F.lit("1e3"))) == 1000.0


@pytest.mark.parametrize("text,expected", [
    ("20150102", date(2015, 1, 2)), ("2015-01-02", date(2015, 1, 2)), ("bad", None), ("20151302", None),
])
def test_parse_date(spark, text, expected):
    assert one(spark, D.parse_date(F.lit(text))) == expected


def test_serial_date(spark):
    assert one(spark, D.serial_date(F.lit("43831"))) == date(2020, 1, 1)
    assert one(spark, D.serial_date(F.lit("x"))) is None


def test_missing_day_and_year_come_from_the_date(spark):
    # The day and the year are filled with day and year, never with the month.
    df = spark.createDataFrame(
        [(date(2011, 2, 27), None, None, None)], "date date, year int, month int, day int"
    )
    row = D.fill_date_parts(df).first()
    assert (row.year, row.month, row.day) == (2011, 2, 27)


def test_season_of_missing_month(spark):
    assert one(spark, D.season(F.lit(None).cast("int"))) is None
    assert one(spark, D.half_year(F.lit(None).cast("int"))) is None


def test_row_mean_and_sum_skip_nulls(spark):
    none = F.lit(None).cast("double")
    assert one(spark, N.row_mean(F.lit(1.0), none, F.lit(3.0))) == 2.0
    assert one(spark, N.row_mean(none, none)) is None
    assert one(spark, N.null_skipping_sum(none, F.lit(3.0))) == 3.0
    assert one(spark, N.null_skipping_sum(none, none)) is None


def test_date_steps(spark):
    steps = one(spark, D.date_steps("2007-01-01", "2016-01-01", 6))
    assert len(steps) == 19 and steps[1] == date(2007, 7, 1)


def test_replace_first_and_groups(spark):
    assert one(spark, X.replace_first(F.lit("a_b_c"), "_", ".")) == "a.b_c"
    assert one(spark, X.parenthesised(F.lit("x (S-1) y (S-2)"))) == ["S-1", "S-2"]
