"""Matching value columns with limit columns, and canonical names.

``match_limits`` works on the columns of a frame; the others apply the same rules where names are data, in tables of any size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.fixed_values import CANONICAL_OVERRIDES, CANONICAL_PREFIXES, LIMIT_OVERRIDES, LIMIT_RENAMES
from hazeline.functions.text import replace_first
from hazeline.sources.stages import staged

# The order in which a limit column is looked for, after the value's own name with _mdl. A value name is read as parts between
# "_": sampler or method, medium, species and so on. An entry lists the parts (from 1) that, joined by "_" again, must stand inside the limit
# name, and whether a "_" must stand on both sides of them.
LIMIT_RULES_FULL = (
    ((1, 2, 4), False), ((2, 3), False), ((1, 3), False), ((1, 2, 3, 5), False),
    ((3, 4, 5), False), ((3, 4), False), ((5, 6), False), ((5,), False),
    ((6,), True), ((1, 2, 3, 4, 6), False),
)
LIMIT_RULES_SHORT = (((1, 2, 4), False), ((2, 3), False))


def match_limits(
    value_names: Sequence[str],
    limit_names: Sequence[str],
    rules=LIMIT_RULES_FULL,
    overrides: dict[str, str] = LIMIT_OVERRIDES,
) -> dict[str, str | None]:
    """Value name -> limit name. A rule counts only if it hits exactly one limit name."""
    limits = set(limit_names)
    result: dict[str, str | None] = {}
    for name in value_names:
        parts = name.split("_")
        hits = [[f"{name}_mdl"] if f"{name}_mdl" in limits else []]
        for positions, framed in rules:
            # A part that does not exist reads as the text NA.
            fragment = "_".join(
                parts[p - 1] if p <= len(parts) else "NA" for p in positions
            )
            fragment = f"_{fragment}_" if framed else fragment
            hits.append([m for m in limit_names if fragment in m])
        found = next((h[0] for h in hits if len(h) == 1), None)
        result[name] = overrides.get(name, found)
    return result


def _fragment(name: Column, positions: Sequence[int], framed: bool) -> Column:
    parts = F.split(name, "_")
    pieces = F.concat_ws("_", *[F.coalesce(F.get(parts, F.lit(p - 1)), F.lit("NA")) for p in positions])
    return F.concat(F.lit("_"), pieces, F.lit("_")) if framed else pieces


def limit_matches(values: DataFrame, limits: DataFrame, rules=LIMIT_RULES_FULL) -> DataFrame:
    """(name, limit): the same cascade for tables (name) and (limit) of distinct names, for any number of them.

    An index of the limit names by the texts inside them: every piece of a limit name that is as long as some fragment, and of those only
    the pieces that are fragments, with their number of limit names. A rule counts where its fragment has one.
    """
    asked = staged(
        values.select("name", F.inline(F.array(*[
            F.struct(F.lit(i).alias("rule"), _fragment(F.col("name"), *rule).alias("fragment")) for i, rule in enumerate(rules, 1)
        ]))),
        "name-fragments",
    )
    fragments = asked.select("fragment").distinct()
    lengths = fragments.agg(F.collect_set(F.length("fragment")).alias("n")).scalar()
    whole = F.col("limit")
    pieces = F.transform(
        F.filter(F.col("lengths"), lambda n: n <= F.length(whole)),
        lambda n: F.transform(F.sequence(F.lit(1), F.length(whole) - n + 1), lambda i: whole.substr(i, n)),
    )
    inside = limits.withColumn("lengths", lengths).select("limit", F.explode(F.array_distinct(F.flatten(pieces))).alias("fragment"))
    index = inside.join(fragments, "fragment", "left_semi").groupBy("fragment").agg(
        F.count(F.lit(1)).alias("n"), F.min("limit").alias("limit")
    )
    hits = asked.join(index.where(F.col("n") == 1), "fragment").select("name", "rule", "limit")
    exact = values.join(limits, F.concat("name", F.lit("_mdl")) == F.col("limit")).select("name", F.lit(0).alias("rule"), "limit")
    best = exact.unionByName(hits).groupBy("name").agg(F.min(F.struct("rule", "limit")).alias("best"))
    return best.select("name", F.col("best.limit").alias("limit"))


def with_limit_names(
    df: DataFrame, name: str, limits: DataFrame, out: str, rules=LIMIT_RULES_FULL
) -> DataFrame:
    """Adds the limit name of each row's value name: worked out once per distinct name, and written, so that
    Spark knows how many they are and can split a hot name where it does not broadcast."""
    values = df.select(F.col(name).alias("name")).where(F.col("name").isNotNull()).distinct()
    names = staged(limit_matches(values, limits, rules).select(F.col("name").alias(name), F.col("limit").alias(out)), "limit-names")
    return df.join(names, name, "left")


def _looked_up(table: dict[str, str], name: Column) -> Column:
    """A fixed value by name, null without one."""
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), name) if pairs else F.lit(None).cast("string")


def rewrite_by_prefix(
    name: Column, prefixes: Sequence[tuple[str, str]] = CANONICAL_PREFIXES
) -> Column:
    """Ordered prefix rules; the last one that applies wins, a fallback if none does."""
    result = F
    for old, new in reversed(prefixes):
        result = result.when(
            F.contains(name, F.lit(old)), replace_first(name, f"(?i){old}", new)
        )
    fallback = F.replace(name, F.lit(" "), F.lit(""))
    fallback = F.replace(fallback, F.lit("dich_"), F.lit("dich."))
    fallback = F.replace(fallback, F.lit("spec_"), F.lit("spec."))
    return result.otherwise(fallback)


def canonical_name(name: Column) -> Column:
    """Canonical name (sampler.METHOD.FILTER.species) of an old one."""
    return F.coalesce(_looked_up(CANONICAL_OVERRIDES, name), rewrite_by_prefix(name))


def canonical_names(names: DataFrame) -> DataFrame:
    """(old_name, new_name) for a table (old_name) of distinct names of the fine table, of any size.

    Flag columns and repeated columns are left out; limit columns take their value column's name first, the last in order where several
    values share one.
    """
    old = F.col("old_name")
    kept = staged(names.where(~old.contains("flag") & ~old.contains("_2")), "kept-names")
    limits = kept.where(old.contains("mdl")).select(old.alias("limit"))
    values = kept.where(~old.contains("mdl") & ~old.isin("date", "year", "month", "day")).select(old.alias("name"))
    found = values.join(limit_matches(values, limits), "name", "left").select(
        "name", F.coalesce(_looked_up(LIMIT_OVERRIDES, F.col("name")), "limit").alias("old_name")
    )
    of_limit = found.groupBy("old_name").agg(F.concat(F.max("name"), F.lit("_mdl")).alias("of_value"))
    base = F.coalesce(_looked_up(LIMIT_RENAMES, old), "of_value", old)
    return kept.join(of_limit, "old_name", "left").select(
        "old_name", F.coalesce(_looked_up(CANONICAL_OVERRIDES, old), canonical_name(base)).alias("new_name")
    )
