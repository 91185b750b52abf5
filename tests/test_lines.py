"""Line numbers, header rows and following lines of files that are read in many splits."""

import random

import pytest
from pyspark.sql import functions as F

from hazeline.sources import grid as G
from hazeline.sources import lines as L


@pytest.fixture(scope="module")
def many_blocks(spark, tmp_path_factory):
    """Three files, an empty one among them; the first one spans many splits, its header far behind the first."""
    folder = tmp_path_factory.mktemp("blocks")
    rng = random.Random(4)
    texts = {
        "2012_S1_INT__A.csv": [f"note {i}," + "x" * rng.randint(0, 200) for i in range(3000)] + ["", "NAPS ID,Sampling Date,Iron"]
        + [("Sampler # (S-1),é" if i % 100 == 7 else f"1,{40000 + i},{i}.5") for i in range(4000)],
        "2012_S2_INT__A+b c.csv": ["Date,Zinc", "40000,1", "", "40001,2"],
    }
    for name, lines in texts.items():
        (folder / name).write_bytes("\n".join(lines).encode("latin1"))
    (folder / "2012_S3_INT__A.csv").write_bytes(b"")
    (folder / "2012_S4_INT__A.csv").write_bytes(b"no head\r\nhere\r\n")
    texts["2012_S4_INT__A.csv"] = ["no head", "here"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        grids = G.read_grids(spark, str(folder))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    return grids, texts


def named(path):
    return path.rsplit("/", 1)[1]


def test_every_line_has_its_number(many_blocks):
    grids, texts = many_blocks
    assert grids.splits.count() > 150
    got = sorted((named(r.path), r.row_no, r.line) for r in L.numbered(grids.lines, grids.splits).collect())
    assert got == sorted((n, i, line) for n, lines in texts.items() for i, line in enumerate(lines, 1))


def test_headers_and_rejects(many_blocks):
    grids, _ = many_blocks
    rows = {named(r.path): r for r in grids.files.collect()}
    assert {n: r.header_row for n, r in rows.items()} == {
        "2012_S1_INT__A.csv": 3002, "2012_S2_INT__A+b c.csv": 1, "2012_S3_INT__A.csv": 0, "2012_S4_INT__A.csv": 0,
    }
    assert rows["2012_S2_INT__A+b c.csv"].sheet == "A+b c" and rows["2012_S1_INT__A.csv"].top[0] == "note 0"
    assert [r.path for r in grids.files.orderBy("file_no").collect()] == sorted(r.path for r in rows.values())
    assert {named(r.path) for r in G.rejected(grids).collect()} == {"2012_S3_INT__A.csv", "2012_S4_INT__A.csv"}


def test_rows_below_the_header(many_blocks):
    grids, texts = many_blocks
    got = {(r.station, r.row_no, r.cells[-1]) for r in G.body_rows(grids, ["station"]).collect()}
    long = texts["2012_S1_INT__A.csv"]
    assert got == {("S1", i, line.split(",")[-1]) for i, line in enumerate(long, 1) if i > 3002} | {("S2", 2, "1"), ("S2", 4, "2")}


def test_the_line_after_a_mark_across_splits(many_blocks):
    grids, texts = many_blocks
    got = {(r.marker_row, r.marker, tuple(r.next_cells)) for r in G.next_rows(grids, "Sampler #", ["station"]).collect()}
    lines = texts["2012_S1_INT__A.csv"]
    want = {(i, "Sampler # (S-1)", tuple(lines[i].split(","))) for i, line in enumerate(lines, 1) if line.startswith("Sampler")}
    assert got == want and len(want) == 40


def test_last_line_has_no_follower(spark):
    df = spark.createDataFrame([(1, "a\nb"), (2, "b"), (3, ""), (4, None)], "k int, t string")
    lines = L.table_lines(df, "k", "t")
    of = L.splits(lines)
    got = {(r.path, r.line, r.after) for r in L.successors(lines.where(F.col("line") != "x"), lines, of).collect()}
    assert got == {(1, "a", "b"), (1, "b", None), (2, "b", None), (3, "", None)}
