"""Exact quantiles (linear interpolation between order statistics) by group, by radix selection.

Every value has an image: a whole number of 64 bits that sorts like it. A pass counts values by group and the leading bits of their images,
combined before the shuffle; a running sum over these counts tells which few of them hold a wanted rank. Where all values with such leading
bits are equal, the rank is settled. The next pass looks only at values with the other ones and counts them by more bits; after the last pass
all bits are known. The number of passes is bounded, a count of one pass and group has at most two to the bits of the pass as many rows for
each wanted rank, and clustered values cost nothing more: they share leading bits and part in a later pass. So no task sees a group's values,
whatever the group's size, and the same steps run at every size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hazeline.operators.joins import null_safe_join
from hazeline.sources.stages import staged

#: Bits of the image that each pass adds.
PASSES = (24, 20, 20)
#: Exponents of normal doubles.
LEAST, MOST = -1022, 1023


def _power(e: Column) -> Column:
    # exact: Java's pow gives the very number where both arguments are whole and it can be represented
    return F.pow(F.lit(2.0), e)


def _near(size: Column) -> Column:
    return F.least(F.greatest(F.floor(F.log2(size)), F.lit(LEAST)), F.lit(MOST))


def _exponent(size: Column, near: Column) -> Column:
    up = ((size / 2) >= _power(near)).cast("long")
    down = ((size < _power(near)) & (near > LEAST)).cast("long")
    return F.least(near + up - down, F.lit(MOST))


def _image(value: Column, size: Column, exponent: Column) -> Column:
    fraction = (size / _power(exponent) * F.lit(2.0**52)).cast("long")
    finite = (exponent - LEAST) * F.lit(2**52) + fraction
    whole = F.when(size == F.lit(float("inf")), F.lit(2**63 - 2)).otherwise(finite)
    return F.when(F.isnan(value), F.lit(2**63 - 1)).when(value < 0, -whole).otherwise(whole)


def double_image(value: Column) -> Column:
    """A whole number that sorts like the double, with one for each; both zeros are 0, and what is not a number comes last.

    Exponent and fraction side by side. Scaling by a power of two is exact, so the fraction is, and the exponent is mended where
    the logarithm rounds to the neighbour.
    """
    size = F.abs(value)
    return _image(value, size, _exponent(size, _near(size)))


def with_image(df: DataFrame, value: str) -> DataFrame:
    """Adds image, null for null. In steps, so that the logarithm and the powers are worked out once for each row."""
    v, size = F.col(value), F.abs(value)
    steps = df.withColumn("__near", _near(size)).withColumn("__exponent", _exponent(size, F.col("__near")))
    return steps.withColumn("image", F.when(v.isNotNull(), _image(v, size, F.col("__exponent")))).drop("__near", "__exponent")


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], names: Sequence[str],
    passes: Sequence[int] = PASSES,
) -> DataFrame:
    """Columns: keys, n (present values) and one column per probability.

    Groups without any present value are kept, with null quantiles. passes: bits added by each pass, 64 in all.
    """
    if sum(passes) != 64:
        raise ValueError("the passes must add up to 64 bits")
    ranks = wanted_ranks(probs)
    keyed = df if keys else df.withColumn("__all", F.lit(0))
    by = list(keys) or ["__all"]
    rows = keyed.select(*by, F.col(value).cast("double").alias("v"))
    known = passes[0]
    counts = first_counts(with_image(rows, "v"), by, known)
    # Written, so that every later step sees the same few rows and Spark knows how few they are.
    held = staged(holding(counts, ranks), "quantile-bits")
    groups = held.select(*by, "n").distinct()
    known_values = [held.where(settled())]
    for bits in passes[1:-1]:
        open_bits = held.where(~settled())
        if open_bits.isEmpty():
            break
        counts = next_counts(with_image(between(rows, by, open_bits), "v"), by, open_bits, known, known + bits)
        held, known = staged(holding(counts, ranks), "quantile-bits"), known + bits
        known_values.append(held.where(settled()))
    # without open bits the last pass joins with an empty table, so no row is read
    open_bits = held.where(~settled())
    known_values.append(next_counts(with_image(between(rows, by, open_bits), "v"), by, open_bits, known, 64))
    columns = [*by, "n", "begin", "c", "v"]
    found = reduce(DataFrame.unionByName, [values.select(columns) for values in known_values])
    picked = found.groupBy(*by).agg(*[F.max(F.when(inside(rank), F.col("v"))).alias(name) for name, rank in ranks.items()])
    position = [(F.col("n") - 1) * F.lit(float(p)) for p in probs]
    return null_safe_join(groups, picked, by, "left").select(*keys, "n", *[
        (F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * (position[i] - F.floor(position[i]))).alias(name)
        for i, name in enumerate(names)
    ])


def wanted_ranks(probs: Sequence[float]) -> dict[str, Column]:
    """The ranks, from 0, on both sides of each quantile's position among n values."""
    ranks = {}
    for i, p in enumerate(probs):
        low = F.floor((F.col("n") - 1) * F.lit(float(p)))
        ranks |= {f"lo{i}": low, f"hi{i}": F.least(low + 1, F.col("n") - 1)}
    return ranks


def inside(rank: Column) -> Column:
    return rank.between(F.col("begin"), F.col("begin") + F.col("c") - 1)


def holding(counts: DataFrame, ranks: dict[str, Column]) -> DataFrame:
    """The rows that hold a wanted rank, and one row of each group without values."""
    return counts.where(reduce(lambda a, b: a | b, map(inside, ranks.values())) | (F.col("n") == 0))


def settled() -> Column:
    """All values with these leading bits are equal, so no later bits are asked for."""
    return F.col("bits").isNull() | (F.col("v") == F.col("top"))


def between(rows: DataFrame, by: Sequence[str], held: DataFrame) -> DataFrame:
    """The rows whose value lies from the least to the greatest with held bits of their group: known without an image."""
    reach = held.groupBy(*by).agg(F.min("v").alias("__least"), F.max("top").alias("__most"))
    return null_safe_join(rows, reach, by, "inner").where(F.col("v").between(F.col("__least"), F.col("__most"))).select(rows.columns)


def _before(order) -> Column:
    return F.coalesce(F.sum("c").over(order.orderBy("bits").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))


def _counted(rows: DataFrame, keys: Sequence[str], known: int) -> DataFrame:
    """Values by group and known leading bits; v is the least of them and top the greatest, after the last pass both are the only one."""
    return rows.groupBy(*keys, F.expr(f"shiftright(image, {64 - known})").alias("bits")).agg(
        F.count("v").alias("c"), F.min("v").alias("v"), F.max("v").alias("top")
    )


def first_counts(images: DataFrame, by: Sequence[str], known: int) -> DataFrame:
    """(by, n, bits, c, begin, v): begin is the rank of the first value with these bits."""
    group = W.partitionBy(*by)
    return _counted(images, by, known).select(
        *by, F.sum("c").over(group).alias("n"), "bits", "c", _before(group).alias("begin"), "v", "top"
    )


def next_counts(images: DataFrame, by: Sequence[str], held: DataFrame, earlier: int, known: int) -> DataFrame:
    """The same for values whose first ``earlier`` bits were picked by the pass before."""
    # a missing image meets nothing, because picked bits are never null; asked for here, it would be worked out twice
    present = images.withColumn("held", F.expr(f"shiftright(image, {64 - earlier})"))
    picked = held.where("bits IS NOT NULL").select(*by, "n", F.col("bits").alias("held"), F.col("begin").alias("from"))
    met = null_safe_join(present, picked, [*by, "held"], "inner")
    counts = _counted(met, [*by, "n", "held", "from"], known)
    return counts.select(
        *by, "n", "bits", "c", (F.col("from") + _before(W.partitionBy(*by, "held"))).alias("begin"), "v", "top"
    )
