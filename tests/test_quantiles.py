import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazeline.operators import quantiles
from hazeline.operators.aggregates import box_stats, global_bounds, median_iqr
from hazeline.operators.quantiles import PASSES, double_image, exact_quantiles, first_counts, holding, next_counts, wanted_ranks

PROBS = (0.02, 0.25, 0.5, 0.75, 0.98)
NAMES = ("a", "b", "c", "d", "e")


def rows():
    """One hot group with a third of all rows and heavy duplicates, a missing key, an empty group."""
    rng = random.Random(1)
    data = [("hot", rng.choice([0.0, 1.0, 1.0, 1e9, rng.gauss(0, 1)])) for _ in range(3000)]
    data += [(f"k{i % 40}", rng.expovariate(1.0)) for i in range(5000)]
    data += [(None, float(i)) for i in range(97)]
    data += [("one", 5.0), ("empty", None), ("two", 1.0), ("two", 2.0), ("two", None)]
    return data


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(rows(), "k string, v double").repartition(7)


def expected():
    groups = {}
    for k, v in rows():
        groups.setdefault(k, []).extend([v] if v is not None else [])
    return groups


@pytest.mark.parametrize("options", [{}, {"passes": (3, 61)}, {"passes": (1, 15, 16, 16, 16)}])
def test_by_group(df, options):
    got = {r.k: r for r in exact_quantiles(df, ["k"], "v", PROBS, NAMES, **options).collect()}
    want = expected()
    assert set(got) == set(want)
    for k, values in want.items():
        assert got[k].n == len(values)
        for p, name in zip(PROBS, NAMES):
            if values:
                assert got[k][name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)
            else:
                assert got[k][name] is None


@pytest.mark.parametrize("options", [{}, {"passes": (40, 24)}])
def test_whole_table(df, options):
    row = exact_quantiles(df, [], "v", PROBS, NAMES, **options).first()
    values = [v for _, v in rows() if v is not None]
    assert row.n == len(values)
    for p, name in zip(PROBS, NAMES):
        assert row[name] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_other_passes_give_the_same_summaries(df):
    hard = {"passes": (12, 40, 12)}
    for fn in (
        lambda **o: box_stats(df, ["k"], "v", **o),
        lambda **o: median_iqr(df, ["k"], ["v"], **o),
        lambda **o: global_bounds(df, "v", **o),
    ):
        plain = sorted(map(repr, fn().collect()))
        assert sorted(map(repr, fn(**hard).collect())) == plain


def test_images_sort_like_doubles(spark):
    rng = random.Random(3)
    tiny, huge = 5e-324, 1.7976931348623157e308
    values = [0.0, -0.0, tiny, -tiny, 2.2250738585072014e-308, 2.225073858507201e-308, huge, -huge, float("inf"), float("-inf"), float("nan")]
    for e in range(-1074, 1024):  # powers of two and their neighbours
        p = 2.0**e
        values += [p, -p, float(np.nextafter(p, 0)), float(np.nextafter(p, np.inf))]
    values += [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(4000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {}
    for r in df.select("v", double_image(F.col("v")).alias("i")).collect():
        got.setdefault("nan" if r.v != r.v else r.v + 0.0, set()).add(r.i)
    assert all(len(i) == 1 for i in got.values())
    last = got.pop("nan")
    ordered = [got[v].copy().pop() for v in sorted(got)]
    assert all(a < b for a, b in zip(ordered, ordered[1:])) and last.pop() > ordered[-1]


def test_clustered_values(spark):
    """Nearly all values share their leading bits: each pass holds few rows of a group, and no step sorts its values."""
    df = spark.range(200_000).selectExpr("id % 2 as k", "case when id < 10 then id * 1e300 else 1e6 + id * 1e-9 end as v")
    want = df.toPandas()
    got = {r.k: r for r in exact_quantiles(df, ["k"], "v", PROBS, NAMES).collect()}
    for k, values in want.groupby("k")["v"]:
        for p, name in zip(PROBS, NAMES):
            assert got[k][name] == pytest.approx(np.quantile(values, p), rel=1e-15)
    images = df.select("k", "v", double_image(F.col("v")).alias("image"))
    held = holding(first_counts(images, ["k"], PASSES[0]), wanted_ranks(PROBS)).cache()
    assert held.count() <= 2 * 2 * len(PROBS)
    second = next_counts(images, ["k"], held, PASSES[0], sum(PASSES[:2]))
    assert second.groupBy("k").count().agg(F.max("count")).first()[0] < 50_000


def test_values_settled_by_their_leading_bits_need_no_later_pass(spark, monkeypatch):
    """Few different values are known after the first pass; the last one joins with an empty table. Another group may go on alone."""
    passes = []
    monkeypatch.setattr(quantiles, "next_counts", lambda *args: passes.append(args) or next_counts(*args))
    few = spark.range(20_000).selectExpr("id % 2 as k", "cast(id * id % 50 as double) as v")
    odd = [(7, float("nan")), (7, 1.0), (7, -0.0), (7, 0.0), (8, float("nan")), (9, None)]
    few = few.unionByName(spark.createDataFrame(odd, "k long, v double"))

    def check(df):
        got = {r.k: r for r in exact_quantiles(df, ["k"], "v", PROBS, NAMES).collect()}
        for k, values in df.where("k < 7").toPandas().groupby("k")["v"]:
            assert [got[k][name] for name in NAMES] == pytest.approx([np.quantile(values, p) for p in PROBS], rel=1e-15)
        assert got[7].n == 4 and got[7].b == 0.0 and got[7].c == 0.5 and math.isnan(got[8].c)
        assert got[9].n == 0 and got[9].c is None

    check(few)
    assert len(passes) == 1
    check(few.unionByName(spark.range(10_000).selectExpr("2L as k", "1e6 + id * 1e-9 as v")))
    assert len(passes) == 3


def test_an_image_is_worked_out_once_for_each_row(spark):
    df = spark.range(5000).selectExpr("id % 3 as k", "1e6 + id * 1e-9 as v")
    text = exact_quantiles(df, ["k"], "v", (0.5,), ("m",))._jdf.queryExecution().executedPlan().toString()
    assert text.upper().count("LOG2(") == 1
