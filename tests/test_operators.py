"""Null semantics and rules that the big tables cannot show."""

import math
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hazeline.operators import aggregates as A
from hazeline.operators import columns as C
from hazeline.operators import joins as J
from hazeline.operators import models as M
from hazeline.operators import naming as N
from hazeline.operators import quality as Q
from hazeline.operators import ranking as R
from hazeline.operators import reshape as S
from hazeline.operators import split_date as D
from hazeline.operators.sizes import estimated_bytes
from hazeline.plans import compose


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)


def test_null_keys_match_in_full_join(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, a int")
    b = spark.createDataFrame([(None, 3), ("y", 4)], "k string, b int")
    assert rows(J.null_safe_join(a, b, ["k"])) == [("x", 1, None), ("y", None, 4), (None, 2, 3)]
    assert rows(J.null_safe_join(a, b, ["k"], "left_anti")) == [("x", 1)]


def test_equal_observations_collapse(spark):
    a = spark.createDataFrame([(1, None), (2, "p")], "k int, v string")
    b = spark.createDataFrame([(1, None, 9.0), (2, "p", None)], "k int, v string, w double")
    assert rows(J.union_observations(a, b)) == [(1, None, 9.0), (1, None, None), (2, "p", None)]


def test_first_present_value_by_priority(spark):
    a = spark.createDataFrame([("s", 1, None, 5.0), (None, 1, 1.0, 1.0)], "k string, d int, x double, y double")
    b = spark.createDataFrame([("s", 1, 7.0, 6.0), ("t", 1, None, None)], "k string, d int, x double, y double")
    got = rows(J.merge_sources([a, b], ["k", "d"], ["x", "y"]))
    # A row without a key is left out; a key with nothing but nulls stays.
    assert got == [("s", 1, 7.0, 5.0), ("t", 1, None, None)]


def test_value_with_a_missing_order_comes_last_but_is_kept(spark):
    df = spark.createDataFrame(
        [("k", None, 1.0), ("k", 5, 2.0), ("m", None, 3.0)], "k string, t bigint, v double"
    )
    want = [("k", 2.0), ("m", 3.0)]
    assert rows(J.first_non_null(df, ["k"], ["v"], ["t"])) == want
    assert rows(J.first_non_null(df, ["k"], ["v"], ["t", "v"])) == want
    assert rows(J.merge_sources([df], ["k"], ["v"], ["t"])) == want


def test_missing_date_of_excluded_key_is_dropped(spark):
    df = spark.createDataFrame(
        [("a", date(2014, 5, 26)), ("a", date(2014, 5, 27)), ("a", None), ("b", None)], "station string, date date"
    )
    ex = J.literal_table(spark, "station string, from_date date, to_date date", [("a", None, "2014-05-26")])
    assert rows(J.anti_ranges(df, ex, "station")) == [("a", date(2014, 5, 27)), ("b", None)]


def test_blank_split_keeps_missing_codes_with_samples(spark):
    df = spark.createDataFrame([("TB", 1), (None, 2), ("R", 3)], "media string, v int")
    main, blanks = Q.split_blanks(df)
    assert rows(main) == [("R", 3), (None, 2)] and rows(blanks) == [("TB", 1)]
    assert Q.split_blanks(df.withColumnRenamed("media", "m"))[1].count() == 0


def test_fraction_split_drops_missing_codes(spark):
    df = spark.createDataFrame([("C", 1), (None, 2), ("F", 3)], "c_f string, mass int")
    parts = Q.split_fractions(df, "c_f", "mass", {"F": "pm", "C": "coarse"})
    assert rows(parts["F"]) == [(3,)] and parts["C"].columns == ["coarse"]


def test_row_filters(spark):
    df = spark.createDataFrame([(1, None, None), (2, 1.0, None), (3, 1.0, 2.0)], "k int, a double, b double")
    assert rows(Q.drop_null_rows(df, ["a", "b"]), "k") == [(2,), (3,)]
    assert rows(Q.drop_sparse_rows(df, 1), "k") == [(2,), (3,)]
    assert rows(Q.with_null_count(df, ["a", "b"]), "k", "na_count") == [(1, 2), (2, 1), (3, 0)]


def test_drop_null_columns_needs_one_scan(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, "x")], "a int, `b.c` string, d string")
    assert Q.drop_null_columns(df).columns == ["a", "d"]


def test_keep_first_does_not_depend_on_row_order(spark):
    data = [("k", i, 10 - i) for i in range(5)]
    for part in (data, data[::-1]):
        df = spark.createDataFrame(part, "k string, a int, b int").repartition(3)
        assert rows(R.keep_first(df, ["k"], ["b", "a"])) == [("k", 4, 6)]


def test_extremes_keep_ties_and_skip_nulls(spark):
    df = spark.createDataFrame([("c", 1, 5.0), ("c", 2, 5.0), ("c", 3, None), ("d", 1, None)], "g string, m int, v double")
    assert rows(R.group_extreme(df, ["g"], "v"), "g", "m") == [("c", 1), ("c", 2)]


def test_top_k_puts_nulls_last(spark):
    df = spark.createDataFrame([("c", i, v) for i, v in enumerate([None, 1.0, 3.0, 3.0])], "g string, i int, v double")
    assert rows(R.top_k(df, ["g"], "v", 3, ["i"]), "i", "rank") == [(1, 3), (2, 1), (3, 2)]


def test_sigma_label_of_single_and_missing_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None)] + [("c", 1.0)] * 30 + [("c", 99.0)], "g string, v double")
    got = R.sigma_outliers(df, ["g"], "v").groupBy("g", "label").count()
    assert rows(got) == [("a", None, 1), ("b", None, 1), ("c", "Normal", 30), ("c", "Outlier", 1)]


def test_interval_needs_two_values_and_counts_present_ones(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 1.0), ("b", 3.0)], "g string, v double")
    got = {r.g: r for r in A.mean_ci(df, ["g"], "v").collect()}
    assert got["a"].n == 1 and got["a"].sd is None and got["a"].ci is None
    assert got["b"].ci == pytest.approx(6.313752, abs=1e-6)


def test_mean_of_nothing_is_null(spark):
    df = spark.createDataFrame([("a", None)], "g string, v double")
    assert rows(A.mean_all_numeric(df, ["g"])) == [("a", None)]


def test_completion_adds_null_rows(spark):
    df = spark.createDataFrame([("A", "x", 1.0), ("B", "y", 2.0)], "city string, type string, val double")
    assert rows(S.complete(df, "city", ["A", "B"], ["type"])) == [
        ("A", "x", 1.0), ("A", "y", None), ("B", "x", None), ("B", "y", 2.0),
    ]


def test_dictionary_rename_keeps_unmapped(spark):
    d = J.literal_table(spark, "old_name string, new_name string", [("A", "New"), ("B", None)])
    df = spark.createDataFrame([("A",), ("B",), ("C",)], "col_name string")
    assert rows(C.rename_long(df, d)) == [("b",), ("c",), ("new",)]
    assert C.rename_wide(df.toDF("A"), {"A": "New"}).columns == ["new"]


def test_numbers_by_name(spark):
    df = spark.createDataFrame([("1", "2", "x")], "zinc string, zinc_flag string, iron string")
    row = C.numeric_by_name(df).first()
    assert (row.zinc, row.zinc_flag, row.iron) == (1.0, "2", None)


def test_limit_rule_needs_exactly_one_hit():
    limits = ["a_b_c_d_mdl", "x_spec_nitrate_mdl", "y_spec_nitrate_mdl", "EDXRF_dich_s_mdl"]
    got = N.match_limits(["a_b_c_d", "q_spec_nitrate", "a_b_x_c", "EDXRF_dich_sulphur_s"], limits)
    assert got["a_b_c_d"] == "a_b_c_d_mdl"  # exact name
    assert got["q_spec_nitrate"] is None  # two hits decide nothing
    assert got["a_b_x_c"] == "a_b_c_d_mdl"  # parts 1, 2 and 4
    assert got["EDXRF_dich_sulphur_s"] == "EDXRF_dich_s_mdl"  # set by hand


def test_name_rules_agree_between_lists_and_columns(spark):
    limits = ["a_b_c_d_mdl", "x_spec_nitrate_mdl", "y_spec_nitrate_mdl", "m_n_zz_mdl"]
    names = ["a_b_c_d", "q_spec_nitrate", "a_b_x_c", "r_s_t_u_zz", "one", "a_b"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    table = spark.createDataFrame([(m,) for m in limits], "limit string")
    got = {r.n: r.m for r in N.with_limit_names(df, "n", table, "m").collect()}
    assert got == N.match_limits(names, limits, overrides={})
    old = ["Ions_IC_spec_tf_nitrate", "EDXRF_iron", "EDXRF_dich_iron", "spec_pm2_5", "a b dich_x"]
    df = spark.createDataFrame([(n,) for n in old], "n string")
    got = {r.n: r.m for r in df.select("n", N.rewrite_by_prefix(F.col("n")).alias("m")).collect()}
    assert got == {
        "Ions_IC_spec_tf_nitrate": "spec.IC.TF.nitrate", "EDXRF_iron": "na.EDXRF.TF.iron", "EDXRF_dich_iron": "dich.EDXRF.TF.iron",
        "spec_pm2_5": "spec.pm2_5", "a b dich_x": "abdich.x",
    }


def canonical(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "old_name string")
    return {r.old_name: r.new_name for r in N.canonical_names(df).collect()}


def test_canonical_names(spark):
    got = canonical(spark, ["date", "EDXRF_s_mdl", "EDXRF_sulphur_s", "x_flag", "y_2", "dich_pm2_5_mdl", "pm2_5"])
    assert got == {
        "date": "date", "EDXRF_s_mdl": "na.EDXRF.TF.sulphur_s_mdl",
        "EDXRF_sulphur_s": "na.EDXRF.TF.sulphur_s", "dich_pm2_5_mdl": "dich.pm2_5_mdl", "pm2_5": "pm2_5",
    }
    assert canonical(spark, []) == {}


def test_random_names_against_the_list_rules(spark):
    rng = random.Random(11)
    part = lambda: "".join(rng.choices("abn", k=rng.randint(1, 2)))
    names = sorted({"_".join(part() for _ in range(rng.randint(1, 6))) for _ in range(150)})
    limits = sorted({"_".join(part() for _ in range(rng.randint(1, 6))) + "_mdl" for _ in range(60)} | {f"{names[3]}_mdl"})
    tables = [spark.createDataFrame([(n,) for n in x], f"{c} string") for x, c in ((names, "name"), (limits, "limit"))]
    got = {r["name"]: r["limit"] for r in N.limit_matches(*tables).collect()}
    want = N.match_limits(names, limits, overrides={})
    assert got == {n: m for n, m in want.items() if m} and len(got) > 20


def test_a_hundred_thousand_names(spark):
    df = spark.range(100_000).select(
        F.concat(F.lit("Ions_IC_spec_tf_c"), F.col("id"), F.when(F.col("id") % 2 == 1, "_mdl").otherwise("")).alias("old_name")
    )
    got = N.canonical_names(df)
    assert got.count() == 100_000
    # values and limits have different numbers here, so no limit belongs to a value
    assert got.where("new_name <> concat('spec.IC.TF.c', substr(old_name, 18))").count() == 0


def test_candidates():
    dates = D.candidate_dates()
    assert len(dates) == 19 and dates[0] == date(2007, 1, 1) and dates[-1] == date(2016, 1, 1)


def test_split_scores_against_a_loop(spark):
    data = [(c, date(2000 + i % 9, 1 + i % 12, 1)) for i, c in enumerate("AABBBCCCCA" * 9)]
    data += [("late", date(2015, 1, 1))]
    df = spark.createDataFrame(data, "city string, date date")
    candidates = D.candidate_dates("2001-01-01", "2006-01-01", 6)
    for zero in (True, False):
        got = {r.split_date: r.score for r in D.split_scores(df, "city", "date", candidates, zero).collect()}
        for c in candidates:
            shares = {"b": [], "a": []}
            for city in {x for x, _ in data}:
                days = [d for x, d in data if x == city]
                for side, n in (("b", sum(d <= c for d in days)), ("a", sum(d > c for d in days))):
                    if n or zero:
                        shares[side].append(n / len(days))
            want = sum(abs(0.5 - sum(v) / len(v)) for v in shares.values())
            assert got[c] == pytest.approx(want, abs=1e-11)


def test_split_table_adds_up(spark):
    df = spark.createDataFrame([("A", date(2001, 1, 1)), ("A", date(2003, 1, 1)), ("B", date(2003, 1, 1))], "city string, date date")
    got = rows(D.split_table(df, "city", "date", F.lit("2001-01-01").cast("date")))
    assert [(r[0], r[1], r[2], r[5], r[6], r[7]) for r in got] == [("A", 1, 1, 2, 0.5, 0.5), ("B", 0, 1, 1, 0.0, 1.0)]


def test_radius_against_brute_force(spark):
    import math

    centre = (44.0, -78.0)
    pts = [(i, 42.0 + i * 0.037 % 4, -80.0 + i * 0.071 % 4) for i in range(300)]
    df = spark.createDataFrame(pts, "i int, latitude double, longitude double")

    def km(lat, lon):
        p1, p2 = math.radians(centre[0]), math.radians(lat)
        a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon - centre[1]) / 2) ** 2
        return 2 * 6371 * math.atan2(math.sqrt(a), math.sqrt(1 - a))

    got = {r.i for r in J.within_radius(df, centre, 120.0).collect()}
    assert got == {i for i, la, lo in pts if km(la, lo) < 120.0}


def test_cubic_trend_recovers_coefficients(spark):
    data = [("g", float(i), 1 + 2 * t - 3 * t**2 + 0.5 * t**3) for i in range(50) for t in [(i - 25) / 25]]
    df = spark.createDataFrame(data + [("flat", 1.0, 2.0)], "g string, x double, y double")
    got = {r.g: r for r in M.polynomial_trend(df, ["g"], "y", F.col("x"), 25, 25).collect()}
    assert [got["g"][f"c{i}"] for i in range(4)] == pytest.approx([1, 2, -3, 0.5], abs=1e-9)
    assert got["flat"].c3 is None  # one point has no cubic


def test_linear_model_with_two_categories(spark):
    effect = {"fall": 0.0, "spring": 1.0, "A": 0.0, "B": -2.0}
    data = [(s, c, float(x), 3.0 + effect[s] + effect[c] + 0.5 * x) for s in ("fall", "spring") for c in "AB" for x in range(6)]
    data.append((None, "A", 1.0, 99.0))
    df = spark.createDataFrame(data, "season string, city string, x double, y double")
    got = {r.term: r.estimate for r in M.linear_model(df, "y ~ season + city + x").collect()}
    assert got == pytest.approx({"season_spring": 1.0, "city_B": -2.0, "x": 0.5, "(Intercept)": 3.0}, abs=1e-8)


def test_sizes(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "k string")
    assert estimated_bytes(df) > 0


def test_packed_order_sorts_like_its_columns(spark):
    rng = random.Random(2)
    start = datetime(2020, 10, 25)
    times = [start + timedelta(microseconds=rng.randrange(10**11)) for _ in range(30)] + [datetime(1, 1, 1), datetime(9999, 12, 31, 23, 59, 59, 999_999), None]
    ids = [rng.randrange(-(2**63), 2**63) for _ in range(6)] + [2**63 - 1, -(2**63), 0, None]
    rows = [(rng.choice(times), rng.choice(ids), float(i), 1) for i in range(300)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, i long, v double, k int")

    def key(r):
        return (r[0] is None, r[0] or start, r[1] is None, r[1] or 0)

    best = min(rows, key=key)
    got = J.first_non_null(df, ["k"], ["v"], ["t", "i"])
    assert got.first().v in {r[2] for r in rows if key(r) == key(best)}
    ordered = df.withColumn("rank", J._rank(df, ["t", "i"])).orderBy("rank").collect()
    assert [key(r) for r in ordered] == sorted(map(key, rows))
    assert str(ordered[0]["rank"].__class__.__name__) == "Decimal"


def test_packed_order_refuses_what_does_not_fit():
    with pytest.raises(ValueError):
        J.packed_order({"a": 64, "b": 63})


def test_wide_table_of_many_columns(spark):
    names = [f"c{i}" for i in range(500)]
    long = spark.range(20_000).selectExpr("id % 7 as k", "concat('c', id % 503) as n", "cast(id as double) as v")
    wide = J.fold_full_outer(long, ["k"], "n", "v", names)
    assert wide.columns == ["k", *names] and wide.count() == 7
    row = wide.where("k = 3").first()
    want = {f"c{i % 503}": float(i) for i in range(20_000) if i % 7 == 3}
    assert {n: row[n] for n in names if row[n] is not None} == {n: v for n, v in want.items() if n in names}


def test_many_centres_near_poles_and_the_date_line(spark):
    rng = random.Random(6)
    places = [(float(rng.choice([-89.9, -60, 0, 45, 89.95]) + rng.uniform(-2, 2)), rng.uniform(-180, 180)) for _ in range(150)]
    places += [(rng.uniform(-1, 1), rng.choice([-1, 1]) * rng.uniform(178, 180)) for _ in range(60)] + [(90.0, 0.0), (-90.0, 7.0), (0.0, 180.0), (0.0, -180.0)]
    places = [(max(-90.0, min(90.0, a)), b) for a, b in places]
    points = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(places)] + [(999, None, 1.0)], "p int, latitude double, longitude double")
    centres = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(places[::3])], "c int, centre_latitude double, centre_longitude double")

    def km(a, b):
        (p, x), (q, y) = ((math.radians(v) for v in s) for s in (a, b))
        return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(math.sin((p - q) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin((x - y) / 2) ** 2)))

    for radius in (30.0, 400.0, 9000.0):
        got = sorted((r.p, r.c) for r in J.near_centres(points, centres, radius).collect())
        assert got == [(i, j) for i, a in enumerate(places) for j, b in enumerate(places[::3]) if km(a, b) < radius]


def test_a_full_cell_is_met_in_blocks_by_many_tasks(spark, monkeypatch):
    """All points and centres in one cell, equal rows among them: the pairs are whole, and no task makes more than a part of them."""
    monkeypatch.setattr(J, "BLOCK", 50, raising=False)
    monkeypatch.setattr(J, "TASK_PAIRS", 5000, raising=False)
    points = spark.range(600).selectExpr("id % 300 as p", "50.0D as latitude", "8.0D + id % 3 * 0.01D as longitude")
    centres = spark.range(400).selectExpr("id as c", "50.0D as centre_latitude", "8.0D as centre_longitude")
    met = J.near_centres(points, centres, 1.0)  # 0.01 degrees are 0.7 km, 0.02 degrees 1.4 km
    assert met.columns == ["p", "latitude", "longitude", "c", "centre_latitude", "centre_longitude", "distance_km"]
    pairs = met.groupBy("p", "c").count().agg(F.count(F.lit(1)), F.min("count"), F.max("count")).first()
    assert tuple(pairs) == (200 * 400, 2, 2)
    by_task = met.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert by_task <= 400 * 400 / 4


def test_exclusion_ranges_of_all_kinds(spark):
    rng = random.Random(9)
    day = lambda: rng.choice([None, date(2010, 1, 1) + timedelta(days=rng.randrange(2000))])
    rows = [(i, rng.choice("abcdef"), day()) for i in range(400)]
    ranges = [(rng.choice("abc"), day(), day()) for _ in range(25)] + [("d", None, date(2010, 6, 1)), ("e", date(2014, 1, 1), None)]
    ranges = [r for r in ranges if r[1:] != (None, None) or r[0] != "b"]
    hit = lambda d, f, t: d is None or ((f is None or d >= f) and (t is None or d <= t))
    # a closed range that ends before it begins excludes nothing but rows without a date
    want = {i for i, k, d in rows if not any(k == key and hit(d, f, t) for key, f, t in ranges)}
    df = spark.createDataFrame(rows, "i int, k string, date date")
    table = spark.createDataFrame(ranges, "k string, from_date date, to_date date")
    got = J.anti_ranges(df, table, "k")
    assert got.columns == df.columns and {r.i for r in got.collect()} == want
