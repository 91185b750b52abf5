"""The studies end to end on small invented tables."""

import math
import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from hazeline.fixed_values import ANALYSIS_COLUMNS, COMPONENTS, HOUR_COLUMNS
from hazeline.operators.joins import literal_table
from hazeline.operators.split_date import best_split, candidate_dates, split_scores
from hazeline.plans import analysis, compose
from hazeline.plans.daily_stations import radius_study
from hazeline.plans.sampler_timeline import figure_rows, sampler_timeline

STATIONS = [("S60211", "Windsor"), ("S60427", "Toronto"), ("S60439", "Toronto"), ("S90132", "Edmonton")]
FINE = [c for c in ANALYSIS_COLUMNS if not c.startswith("fb_")]
BLANK = [c.removeprefix("fb_") for c in ANALYSIS_COLUMNS if c.startswith("fb_")]


@pytest.fixture(scope="module")
def study(spark):
    rng = random.Random(3)
    days = [date(2006, 1, 3) + timedelta(days=97 * i) for i in range(40)]
    rows = []
    for station, _ in STATIONS:
        for d in days:
            values = [None if rng.random() < 0.01 else rng.uniform(0.5, 9.0) for _ in FINE]
            rows.append((station, d, rng.uniform(5, 60), *values, 1.0))
    rows.append(("S90132", date(2018, 3, 12), 50.0, *[5.0] * len(FINE), 1.0))
    rows.append(("S1", days[0], 1.0, *[1.0] * len(FINE), 1.0))  # unknown station
    doubles = [f"{c} double" for c in ["spec_pm2_5", *FINE, "ions_ic_spec_tf_nitrate_mdl"]]
    fine = spark.createDataFrame(rows, "station string, date date, " + ", ".join(doubles))
    blanks = spark.createDataFrame(
        [(s, d, *[0.1 * (i + 1) for i in range(len(BLANK))]) for s, _ in STATIONS for d in days[::2]],
        "station string, date date, " + ", ".join(f"{c} double" for c in BLANK),
    )
    stations = spark.createDataFrame(STATIONS, "station string, city string")
    factors = literal_table(
        spark, "season string, city string, correction_factor double",
        [(s, c, 1.5) for s in ("spring", "summer", "fall", "winter") for c in ("Windsor", "Toronto", "Edmonton")],
    )
    observations = analysis.substitute(analysis.prepare(fine, blanks, stations)).cache()
    spec = analysis.reconstruction(observations, factors).cache()
    return observations, spec


def test_overlap_of_stations_is_left_out(study):
    observations, _ = study
    assert observations.where("station = 'S60439' and date <= '2014-05-26'").count() == 0
    assert observations.where("station = 'S60439'").count() > 0
    assert observations.where("station = 'S1'").count() == 0


def test_limits_are_substituted(study):
    observations, _ = study
    low = observations.where("ions_ic_spec_tf_nitrate < 1").select("ions_ic_spec_tf_nitrate")
    assert {r[0] for r in low.collect()} <= {0.5}


def test_reconstruction(study):
    _, spec = study
    assert spec.where("city = 'Edmonton' and date = '2018-03-12'").count() == 0
    for r in spec.where("total is not null").collect():
        assert r.total == pytest.approx(sum(r[c] for c in COMPONENTS))
    bad = spec.where("na_count <> size(filter(array(ANO3, ASO4, EC, SOIL, NaCl, PBW, OM, PBW_h,"
                     " PBW_molar, total, spec_pm2_5, myso2, myhno3, ammonia_ic_spec_ammonia), v -> v is null))")
    assert bad.count() == 0


def test_cutoff_matches_the_search(study):
    _, spec = study
    best = best_split(split_scores(analysis.enough_data(spec), "city", "date", candidate_dates())).first()
    row = spec.select(analysis.cutoff(spec).alias("d")).first()
    assert row.d == best.split_date


def test_study_tables(study):
    observations, spec = study
    day = best_split(split_scores(analysis.enough_data(spec), "city", "date", candidate_dates())).first().split_date
    tables = analysis.study_tables(spec, observations, F.lit(day))
    full = [r for r in spec.collect() if r.na_count < 3]

    for r in tables["split_table"].collect():
        mine = [x for x in full if x.city == r.city]
        assert r.before_samp + r.after_samp == r.total_samp == len(mine)

    shares = tables["season_shares"].collect()
    assert shares
    for r in shares:
        assert sum(r[f"{c}_perc"] for c in COMPONENTS) == pytest.approx(1.0)

    groups = defaultdict(list)
    for x in full:
        if x.spec_pm2_5 is not None:
            groups["before" if x.date < day else "after", x.city].append(x.spec_pm2_5)
    boxes = {(r.period, r.city): r for r in tables["box_stats"].collect()}
    assert set(boxes) == set(groups)
    for key, values in groups.items():
        values.sort()
        h = (len(values) - 1) * 0.5
        lo = math.floor(h)
        median = values[lo] + (h - lo) * (values[min(lo + 1, len(values) - 1)] - values[lo])
        assert boxes[key].n == len(values) and boxes[key].middle == pytest.approx(median)

    top = {(r.city, r.period, r.season, r.type): r.val for r in tables["top_days"].collect()}
    for (city, period) in {(c, p) for c, p, _, _ in top}:
        for season in ("summer", "winter"):
            pool = [
                x for x in full
                if x.city == city and ("before" if x.date < day else "after") == period
                and ("summer" if 4 <= x.month <= 9 else "winter") == season
                and (period == "before" or (x.total is not None and x.spec_pm2_5 is not None))
            ]
            pool.sort(key=lambda x: -x.spec_pm2_5)
            for c in COMPONENTS:
                present = [x[c] for x in pool[:10] if x[c] is not None]
                if present:
                    assert top[city, period, season, c] == pytest.approx(sum(present) / len(present))

    for name in tables:
        assert tables[name].count() >= 0, name
    assert tables["with_weather"].columns.count("city") == 1


def test_study_stations_and_published_counts(spark):
    meta = spark.createDataFrame(
        [("S30113", 30118), ("S30118", None), ("S60211", None), ("S9", None)],
        "station string, combined_stations int",
    )
    got = sorted(map(tuple, analysis.study_stations(meta).collect()))
    assert got == [("S30113", "Halifax"), ("S30118", "Halifax"), ("S60211", "Windsor")]
    rows = [("Halifax", "S30113", date(2008, 12, 31))] * 5 + [("Halifax", "S30113", date(2009, 1, 1)),
            ("Halifax", "S30118", date(2008, 1, 1))]
    obs = spark.createDataFrame(rows, "city string, station string, date date")
    row = analysis.published_comparison(obs).collect()
    assert [(r.station, r.n, r.n_published, r["diff"]) for r in row] == [("S30113", 5, 177, -172)]


def test_box_rows_repeat_one_city(spark):
    rows = [("Edmonton", 60.0), ("Edmonton", 10.0), ("Halifax", 70.0), ("Halifax", -1.0), ("Halifax", None)]
    df = spark.createDataFrame(rows, "city string, spec_pm2_5 double")
    got = sorted(map(tuple, analysis.box_rows_after(df).collect()))
    assert got == [
        ("Edmonton", 10.0, "no"), ("Edmonton", 10.0, "yes"), ("Edmonton", 60.0, "yes"), ("Halifax", 70.0, "no"),
    ]


def test_gases_come_from_either_name(spark):
    df = spark.createDataFrame([(None, 2.0, 3.0, 4.0)], "spec_sulphur_dioxide double, "
                               "acidic_ic_spec_sulphur_dioxide double, spec_nitric_acid double, "
                               "acidic_ic_spec_nitric_acid double")
    row = compose.coalesce_gases(df).first()
    assert (row.myso2, row.myhno3) == (2.0, 3.0)


def test_radius_study(spark):
    stations = spark.createDataFrame(
        [("1", "Near", "x", "Peterborough", 44.31, -78.32), ("2", "Far", "y", "Montréal", 45.5, -73.6)],
        "napsid string, station_name string, location_address string, city string, latitude double, longitude double",
    )
    hours = [10.0] * 12 + [None] * 11 + [23.0]
    d = date(2015, 5, 1)
    rows = [("O3", "1", d, *hours), ("O3", "1", d, *[None] * 24), ("PM2.5", "1", d, *[1.0] * 24), ("O3", "2", d, *hours)]
    hourly = spark.createDataFrame(rows, "pollutant string, napsid string, date date, " + ", ".join(f"{h} double" for h in HOUR_COLUMNS))
    fine = spark.createDataFrame([("1", d, 5.0), ("1", date(2015, 5, 4), 6.0), ("2", d, 7.0)], "napsid string, date date, spec_pm2_5 double")
    coarse = spark.createDataFrame([("1", d, 3.0)], "napsid string, date date, dich_pm2_5_10 double")
    out = radius_study(hourly, fine, coarse, stations)
    got = {r.date: r for r in out["daily"].collect()}
    assert set(got) == {d, date(2015, 5, 4)}
    assert got[d].hourly_mean_o3 == pytest.approx(11.0) and got[d].hourly_mean_pm2_5 == 1.0
    assert (got[d].spec_pm2_5, got[d].dich_pm2_5_10, got[d].city) == (5.0, 3.0, "Peterborough")
    assert got[date(2015, 5, 4)].hourly_mean_o3 is None and got[date(2015, 5, 4)].month == 5
    assert out["coverage"].first().start == d


def test_blank_change_is_after_less_before(study):
    observations, spec = study
    tables = analysis.study_tables(spec, observations, F.lit("2010-01-01").cast("date"))
    sides = {s: {(r.city, r.type): r.val for r in tables[f"blank_{s}"].collect()} for s in ("before", "after")}
    got = {(r.city, r.type): r for r in tables["blank_change"].collect()}
    assert got and set(got) == set(sides["before"]) & set(sides["after"])
    for key, r in got.items():
        assert r["diff"] == pytest.approx(sides["after"][key] - sides["before"][key])
        assert r.ratio == pytest.approx(sides["after"][key] / sides["before"][key])
    means = {r.city: r.mean_diff for r in tables["blank_city_change"].collect()}
    assert means["Windsor"] == pytest.approx(sum(r["diff"] for k, r in got.items() if k[0] == "Windsor") / 3)


def test_reconstruction_with_the_earlier_orders(spark):
    day = date(2005, 4, 1)
    values = {
        "ions_ic_tf_nitrate": 1.0, "ions_ic_tf_sulphate": 2.0, "ions_ic_tf_ammonium": 3.0, "ions_ic_dich_tf_sodium": 0.5,
        "ions_ic_dich_tf_chloride": 0.25, "ocec_spec_ec_a": 1.0, "ocec_spec_oc_b": 4.0,
        **{f"edxrf_dich_{c}": 1.0 for c in ("silicon_si", "calcium_ca", "iron_fe", "potassium_k", "titanium_ti")},
    }
    df = spark.createDataFrame([("S1", "Windsor", day, 4, *values.values())], "station string, city string, date date, month int, "
                               + ", ".join(f"{c} double" for c in values))
    factors = literal_table(spark, "season string, city string, correction_factor double", [("spring", "Windsor", 1.5)])
    row = analysis.reconstruction(df, factors, **analysis.EARLIER_SAMPLERS).first()
    assert (row.ANO3, row.NaCl, row.OM, row.EC) == (1.29, 0.75, 6.0, 1.0)
    assert row.SOIL == pytest.approx(3.48 + 1.63 + 1.63 + 1.41 + 1.94) and row.total is not None
    assert analysis.reconstruction(df, factors).first().ANO3 is None


def test_timeline_leaves_a_folder_out_and_shows_empty_cities(spark):
    samplers = spark.createDataFrame(
        [("S1", 2012, "a", "Spec", "Integrated"), ("S1", 2012, "b", "Dichot", "IntegratedPM2.5-10"), ("S9", 2012, "c", "Spec", "Integrated")],
        "station string, year int, sampler string, type string, dir string",
    )
    stations = spark.createDataFrame([("S1", "Halifax")], "station string, city string")
    none = literal_table(spark, "station string, from_date date, to_date date", [("S2", "2008-01-01", "2008-12-31")])
    timeline = sampler_timeline(samplers, stations, none)
    assert [(r.city, r.sampler) for r in timeline.collect()] == [("Halifax", "a")]
    shown = figure_rows(timeline, ["Dichot", "Spec"], ["Canterbury", "Halifax"])
    assert sorted((r.city, r.sampler) for r in shown.collect()) == [("Canterbury", None), ("Halifax", "a")]


def test_sampler_timeline(spark):
    samplers = spark.createDataFrame(
        [("S1", 2003, "a", "Spec"), ("S1", 2005, "a", "Spec"), ("S2", 2008, "b", "PM"), ("S2", 2009, "b", "PM"), ("S2", 2010, "c", "Dichot")],
        "station string, year int, sampler string, type string",
    )
    stations = spark.createDataFrame([("S1", "Halifax"), ("S2", "Canterbury")], "station string, city string")
    ex = literal_table(spark, "station string, from_date date, to_date date", [("S2", "2008-01-01", "2008-12-31")])
    got = sampler_timeline(samplers, stations, ex, "Canterbury", "PM", "manual")
    assert sorted(map(tuple, got.collect())) == [
        ("Canterbury", "Dichot", "c", date(2010, 1, 1), date(2010, 12, 31), "#B79F00"),
        ("Canterbury", "PM", "manual", date(2009, 1, 1), date(2009, 12, 31), "#00BA38"),
        ("Halifax", "Spec", "a", date(2003, 1, 1), date(2005, 12, 31), "#F8766D"),
    ]
