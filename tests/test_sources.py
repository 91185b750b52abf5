from datetime import date

import pytest
from pyspark.sql import functions as F

from hazeline.sources import grid as G
from hazeline.sources import lines as L
from hazeline.sources import hourly as H
from hazeline.sources import lookups, provenance, stages

HOURS = ",".join(f"H{h:02d}" for h in range(1, 25))


def line(pollutant, station, day, first="-999", method=None, cells=24):
    middle = [first] + ["30"] * (cells - 1)
    parts = [pollutant] + ([method] if method else [])
    return ",".join(parts + [station, '"Example"', "NL", "47.5", "-52.7", day] + middle)


@pytest.fixture(scope="module")
def hourly(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("hourly")
    new = "\n".join([
        "Preamble,,", "Polluant?,,",
        "Pollutant//Polluant,Method Code // Code Méthode,NAPS ID,City,P/T,Latitude,Longitude,Date," + HOURS,
        line("O3", "010102", "20150101", method="1"),
        line("O3", "010102", "2015-01-02", "29", method="1"),
        line("O3", "010102", "bad", "1", method="1"),
        line("XX", "010102", "20150101", method="1"),
        line("O3", "010103", "20140101", method="1"),
        line("O3", "010103", "20150103", "7", method="1", cells=3),
    ])
    old = "\n".join([
        "Pollutant,Station,City,P/T,Latitude,Longitude,Date," + HOURS,
        "Polluant,Station,Ville,P/T,Latitude,Longitude,Date," + HOURS,
        line("NO2", "10102", "20030101", "4"),
        line("NO2", "10102", "20030101", "4"),
        line("NO2", "999", "20030102", "4"),
    ])
    (d / "O3_2015.csv").write_bytes(new.encode("latin1"))
    (d / "NO2_2003.csv").write_bytes(old.encode("latin1"))
    (d / "PM10_2004.csv").write_bytes(b"nothing,here\n1,2\n")
    (d / "CO_2005.csv").write_bytes(b"")
    return H.read_hourly(spark, str(d))


def test_hourly_rows(hourly):
    rows, rejects = hourly
    got = {(r.pollutant, r.napsid, r.date): r for r in rows.collect()}
    first = got["O3", "10102", date(2015, 1, 1)]
    assert first.h01 is None and first.h02 == 30.0 and first.city == "Example"
    assert (first.year, first.month, first.day) == (2015, 1, 1)
    assert got["O3", "10102", date(2015, 1, 2)].h01 == 29.0
    short = got["O3", "10103", date(2015, 1, 3)]
    assert short.h03 == 30.0 and short.h04 is None
    assert got["NO2", "10102", date(2003, 1, 1)].h01 == 4.0
    assert not [k for k in got if k[0] == "XX"]
    assert sorted(r.path.rsplit("/", 1)[1] for r in rejects.collect()) == ["CO_2005.csv", "PM10_2004.csv"]


def test_hourly_files_may_be_split(spark, tmp_path):
    """Headers are found and applied although no task sees the whole file."""
    body = [line("O3", f"{n:06d}", "20150101", str(n), method="1") for n in range(1, 400)]
    head = "Pollutant,{}NAPS ID,City,P/T,Latitude,Longitude,Date," + HOURS
    text = "\n".join([head.format(""), head.format("Method,"), *body])
    (tmp_path / "O3_2015.csv").write_bytes(text.encode("latin1"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows, rejects = H.read_hourly(spark, str(tmp_path))
        assert H.read_ragged_csv(spark, str(tmp_path)).rdd.getNumPartitions() > 4
        assert rejects.count() == 0
        got = {r.napsid: r.h01 for r in rows.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {str(n): float(n) for n in range(1, 400)}


def test_hourly_check(spark, hourly):
    rows, _ = hourly
    stations = spark.createDataFrame([("10102",), ("10103",)], "napsid string")
    accepted, invalid, report = H.checked_hourly(rows, stations)
    by_file = {r.source.rsplit("/", 1)[1]: r for r in report.collect()}
    assert by_file["O3_2015.csv"].n_invalid_dates == 1
    assert by_file["O3_2015.csv"].n_other_year == 1
    assert by_file["NO2_2003.csv"].n_unknown_stations == 1
    assert invalid.count() == 1 and accepted.count() == 0
    lenient, _, _ = H.checked_hourly(rows, stations, allow_invalid_dates=True)
    # The wrong-year row goes; the file with the unknown station goes as a whole.
    assert {(r.pollutant, r.date) for r in lenient.collect()} == {
        ("O3", date(2015, 1, 1)), ("O3", date(2015, 1, 2)), ("O3", date(2015, 1, 3)),
    }


@pytest.fixture(scope="module")
def sheets(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("sheets")
    (d / "2012_S60211_INT__Ions-Spec_IC.csv").write_bytes("\n".join([
        "Title,,,,,", "Medium,N/A,N/A,TF,TF,NF", "Sampler,,,S-1,S-1,S-2",
        "NAPS ID,Sampling Date,Sample Type,Nitrate,Nitrate MDL,Nitrate",
        "60211,40909,R,1.5,0.1,2.5", "60211,40912,FB,0.2,0.1,-999", ",,,,,", "60211,40915,,-,0.1,3",
    ]).encode("latin1"))
    (d / "2012_S60211_INT__NoHeader.csv").write_bytes(b"a,b\n1,2\n")
    (d / "2012_S60211_INT__Station Info.csv").write_bytes("\n".join([
        "Site,Windsor", "Sampler # (S-1),x", "Description,Speciation sampler",
        "Sampler # (S-2),x", "Description,Dichotomous sampler", "Sampler # (S-3),x",
        "Description,Partisol",
    ]).encode("latin1"))
    return G.read_grids(spark, str(d))


def test_provenance_and_sheet(sheets):
    row = sheets.files.where("sheet = 'NoHeader'").first()
    assert (row.year, row.station, row.file_type) == (2012, "S60211", "INT")
    names = {r.sheet for r in sheets.pick(provenance.wanted_sheets).files.collect()}
    assert names == {"Ions-Spec_IC", "NoHeader"}


def test_sampler_info(sheets):
    info = G.sampler_info(sheets.where("sheet = 'Station Info'"))
    got = {(r.sampler_num, r.type, r.description) for r in info.collect()}
    assert got == {
        ("S-1", "spec", "Description"), ("S-2", "dich", "Description"), ("S-3", "pm", "Description"),
    }


def test_names_from_medium_and_sampler_rows(sheets):
    info = G.sampler_info(sheets.where("sheet = 'Station Info'"))
    wanted = sheets.pick(provenance.wanted_sheets)
    assert [r.path.rsplit("__", 1)[1] for r in G.rejected(wanted).collect()] == ["NoHeader.csv"]
    named = G.with_sheet_names(wanted, info).files.where("sheet = 'Ions-Spec_IC'").first()
    assert named["names"] == [
        "naps_id", "sampling_date", "sample_type", "spec_tf_nitrate", "spec_tf_nitrate_mdl",
        "dich_nf_nitrate",
    ]
    assert named["warnings"] == []
    plain = G.with_sheet_names(wanted).files.where("sheet = 'Ions-Spec_IC'").first()
    assert plain["names"][3:] == ["tf_nitrate", "tf_nitrate_mdl", "nf_nitrate"]


def test_rows_meet_what_is_known_of_their_file(sheets):
    """Names are searched once for each file; the lines are neither sent to the split table nor shuffled."""
    named = G.with_sheet_names(sheets)
    rows = G.observations(named, "sampling_date", True, ["station"], "flag")
    text = G.measures_long(rows, ["station", "date", "blank_code"])._jdf.queryExecution().executedPlan().toString()
    assert "array_position" not in text and "RLIKE" not in text.upper() and "lambda" not in text
    assert text.count("Join") == 1 and "BuildRight" in text and "hashpartitioning" not in text


def test_first_and_last_header(spark):
    df = spark.createDataFrame([(1, "a,b\nDate,x\n1,2\ndate,y\n3,4"), (2, "a\nb"), (3, None)], "k int, t string")
    lines = L.table_lines(df, "k", "t")
    grids = G.grids_of(lines, {"header": G.has_cell("(?i)naps|date"), "mark": G.starts_with("ate")})
    assert sorted((r.path, r.header_row, r.header) for r in grids.files.collect()) == [(1, 2, ["Date", "x"]), (2, 0, None)]
    assert [(r.path, r.row_no) for r in L.marked(grids.splits, "mark", last=True).collect()] == [(1, 4)]
    assert [r.path for r in G.rejected(grids).collect()] == [2]


def test_places_beyond_the_header_are_named_by_number(spark):
    df = spark.createDataFrame([(1, "x\nDate,,b\n1,2,3,4\n,,\n5")], "k int, t string")
    grids = G.grids_of(L.table_lines(df, "k", "t"), {"header": G.has_cell("Date")})
    got = sorted(tuple(r) for r in G.promote_long(grids).collect())
    assert got == [(1, 3, "...4", "4"), (1, 3, "Date", "1"), (1, 3, "b", "3"), (1, 5, "Date", "5")]
    shifted = G.promote_long(grids, optional=G.has_optional_column(F.col("header"), ["no"]))
    assert sorted(tuple(r) for r in shifted.collect()) == got


def test_unique_names(spark):
    row = spark.range(1).select(G.unique_names(F.array(*map(F.lit, "abaca"))).alias("n")).first()
    assert row.n == ["a", "b", "a_2", "c", "a_3"]


def test_file_name_filter(spark):
    paths = ["/FR/2004_S1_IC.xls", "/d/2004_S1_IC_FR.xls", "/d/2004_change.xls", "/d/2004_4hr.xls"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    # Only the file's own name counts, not the folder.
    assert [r.path for r in provenance.wanted_files(df).collect()] == paths[:1]


def test_stations(spark, tmp_path):
    f = tmp_path / "stations.csv"
    f.write_text("NAPS,Station Name,City,Latitude,Longitude,SO2,NO2,PAH,Combined Stations\n"
                 "60211,Windsor W,Windsor,42.3,-83.0,Y,Y,N,\n")
    row = lookups.read_stations(spark, str(f)).first().asDict()
    assert row == {"naps": 60211, "station_name": "Windsor W", "city": "Windsor", "latitude": 42.3,
                   "longitude": -83.0, "combined_stations": None, "station": "S60211"}


def test_stage_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("F", "S1", 1.0), ("C", "S1", 2.0)], "fraction string, station string, v double")
    path = str(tmp_path / "stage")
    stages.write_stage(df, path, ["fraction"], ["station"])
    back = stages.read_stage(spark, path, df.schema)
    assert sorted(map(tuple, back.select(*df.columns).collect())) == sorted(map(tuple, df.collect()))
    stages.write_table_csv(df, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 2
