"""Limit substitution and mass reconstruction."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.fixed_values import (
    NITRATE_IN_ASO4, NITRATE_TO_ANO3, SOIL_COEFFICIENTS, WATER_FACTOR,
)
from hazeline.functions.dates import season
from hazeline.functions.numeric import null_skipping_sum
from hazeline.operators.sizes import broadcast_if_small

# Column name templates by sampler for the ions (tf = Teflon filter) and the metals.
ION = "ions_ic_{sampler}tf_{species}"
METAL = "edxrf_{sampler}{species}"


def substitute_limit(value: Column, limit: Column, missing_limit: str = "null") -> Column:
    """Half the limit for values below it.

    A value without a limit becomes null by default (the comparison is undecided), or stays
    with ``missing_limit="keep"``.
    """
    result = F.when(value.isNull() | (value >= limit), value).when(value < limit, 0.5 * limit)
    return result.otherwise(value) if missing_limit == "keep" else result


def substitute_limits(
    df: DataFrame, limits: dict[str, str | None], missing_limit: str = "null"
) -> DataFrame:
    """Substitution for pairs (value column -> limit column); no limit column, no change."""
    return df.withColumns(
        {
            v: substitute_limit(F.col(v), F.col(m), missing_limit)
            for v, m in limits.items() if m is not None
        }
    )


def _named(template: str, sampler: str, species: str) -> Column:
    return F.col(template.format(sampler=f"{sampler}_" if sampler else "", species=species))


def _soil(sampler: str) -> Column:
    total = None
    for species, k in SOIL_COEFFICIENTS.items():
        term = F.lit(k) * _named(METAL, sampler, species)
        total = term if total is None else total + term
    return total


def columns_of(
    ion_samplers: Sequence[str] = ("spec",), salt_samplers: Sequence[str] | None = None,
    soil_samplers: Sequence[str] = ("dich", "spec"), organic_carbon: str = "ocec_spec_oc_corr",
) -> list[str]:
    """Names of the columns that a reconstruction with these orders of samplers reads."""
    def glued(template: str, sampler: str, names: Iterable[str]) -> list[str]:
        return [template.format(sampler=f"{sampler}_" if sampler else "", species=n) for n in names]

    ions = [c for s in ion_samplers for c in glued(ION, s, ("nitrate", "sulphate", "ammonium"))]
    salts = [c for s in salt_samplers or ion_samplers for c in glued(ION, s, ("sodium", "chloride"))]
    soils = [c for s in soil_samplers for c in glued(METAL, s, SOIL_COEFFICIENTS)]
    return [*ions, *salts, *soils, "ocec_spec_ec_a", "ocec_spec_ec_b", organic_carbon]


def reconstruct_mass(
    df: DataFrame,
    om_factor: DataFrame,
    ion_samplers: Sequence[str] = ("spec",),
    salt_samplers: Sequence[str] | None = None,
    soil_samplers: Sequence[str] = ("dich", "spec"),
    organic_carbon: str = "ocec_spec_oc_corr",
    city: str = "city",
    month: str = "month",
) -> DataFrame:
    """Components of the mass, their total, and the water terms.

    Each component is taken from the first sampler (in the given order) for which all its
    terms are present. ``om_factor`` is (season, city, correction_factor) with a fixed number
    of rows; observations without a factor are dropped. The total is null if any part is.
    """
    def over(samplers: Sequence[str], fn) -> Column:
        return F.coalesce(*[fn(s) for s in samplers])

    no3, so4, nh4 = (
        lambda s, name=name: _named(ION, s, name) for name in ("nitrate", "sulphate", "ammonium")
    )
    salt = salt_samplers or ion_samplers
    parts = {
        "season": season(F.col(month)),
        "ANO3": over(ion_samplers, lambda s: F.lit(NITRATE_TO_ANO3) * no3(s)),
        "ASO4": over(ion_samplers, lambda s: so4(s) + nh4(s) - F.lit(NITRATE_IN_ASO4) * no3(s)),
        "EC": null_skipping_sum(F.col("ocec_spec_ec_a"), F.col("ocec_spec_ec_b")),
        "SOIL": over(soil_samplers, _soil),
        "NaCl": over(salt, lambda s: _named(ION, s, "sodium") + _named(ION, s, "chloride")),
        "PBW": over(ion_samplers, lambda s: F.lit(WATER_FACTOR) * (so4(s) + nh4(s))),
        "PBW_h": over(ion_samplers, lambda s: so4(s) + nh4(s)),
        "PBW_molar": over(ion_samplers, lambda s: nh4(s) - so4(s) - no3(s)),
    }
    factors = broadcast_if_small(om_factor.select("season", city, "correction_factor"))
    with_om = (
        df.withColumns(parts)
        .join(factors, ["season", city], "inner")
        .withColumn("OM", F.col(organic_carbon) * F.col("correction_factor"))
        .drop("correction_factor")
    )
    total = F.col("NaCl")
    for part in ("SOIL", "EC", "OM", "ANO3", "ASO4", "PBW"):
        total = total + F.col(part)
    return with_om.withColumn("total", total)


def mass_closure(df: DataFrame, measured: str = "spec_pm2_5", total: str = "total") -> DataFrame:
    """Measured minus reconstructed, and the ratio."""
    return df.withColumns(
        {
            "diff": F.col(measured) - F.col(total),
            "div": F.try_divide(F.col(total), F.col(measured)),
        }
    )


def coalesce_gases(df: DataFrame) -> DataFrame:
    """SO2 and HNO3 from whichever of two names carries them."""
    return df.withColumns(
        {
            "myso2": F.coalesce("spec_sulphur_dioxide", "acidic_ic_spec_sulphur_dioxide"),
            "myhno3": F.coalesce("spec_nitric_acid", "acidic_ic_spec_nitric_acid"),
        }
    )
