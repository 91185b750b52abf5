"""Text cells and names."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazeline.fixed_values import NA_TOKENS


def na_to_null(cell: Column, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """Trimmed cell, or null if it is one of the missing-value tokens."""
    trimmed = F.trim(cell)
    return F.when(~trimmed.isin(*{t.strip() for t in tokens}), trimmed)


def strip_quotes(cell: Column) -> Column:
    return F.replace(cell, F.lit('"'), F.lit(""))


def replace_first(text: Column, pattern: str, replacement: str) -> Column:
    """Replace the first match only. ``pattern`` must hold no capture groups of its own."""
    return F.regexp_replace(text, f"(?s)^(.*?)(?:{pattern})", f"$1{replacement}")


def strip_leading_zeros(text: Column) -> Column:
    return F.regexp_replace(text, "^0+", "")


def parenthesised(text: Column) -> Column:
    """All texts inside parentheses, as an array."""
    return F.regexp_extract_all(text, F.lit(r"\((.+?)\)"), F.lit(1))


def part(text: Column, separators: str, k: int) -> Column:
    """k-th piece (from 1; negative from the end) of a text split by a regex, else null."""
    return F.try_element_at(F.split(text, separators), F.lit(k))


def any_of(column: Column, values: Iterable) -> Column:
    """Membership that is false, not null, for a null cell."""
    return F.coalesce(column.isin(*values), F.lit(False))


def domain_order(column: Column, values: Iterable[str]) -> Column:
    """Place (from 1) of a value in its domain's output order; null outside the domain."""
    return F.nullif(F.array_position(F.lit(list(values)), column), F.lit(0))


def sampler_kind(text: Column) -> Column:
    """spec, dich or pm by the words in a sampler description."""
    low = F.lower(text)
    return (
        F.when(low.contains("spec"), "spec")
        .when(low.contains("dich"), "dich")
        .otherwise("pm")
    )


def clean_name(name: str | None) -> str:
    """One name in lower snake case."""
    text = name or ""
    text = text.replace("%", "_percent_").replace("#", "_number_").replace("µ", "u")
    text = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()
    text = re.sub(r"['\"]", "", text)
    text = re.sub(r"([a-z])([A-Z])", r"\1_\2", text)
    text = re.sub(r"[^0-9A-Za-z]+", "_", text).strip("_").lower()
    if not text or text[0].isdigit():
        text = f"x{text}"
    return text


def clean_names(names: Iterable[str | None]) -> list[str]:
    """Clean names, made unique with _2, _3, ... in order of appearance."""
    seen: dict[str, int] = {}
    result = []
    for name in map(clean_name, names):
        seen[name] = seen.get(name, 0) + 1
        result.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return result


def clean_name_column(name: Column) -> Column:
    """The same rule for names that are data (long layout)."""
    text = F.replace(F.coalesce(name, F.lit("")), F.lit("%"), F.lit("_percent_"))
    text = F.replace(text, F.lit("#"), F.lit("_number_"))
    text = F.replace(text, F.lit("µ"), F.lit("u"))
    text = F.translate(
        text, "ÀÂÄÇÈÉÊËÎÏÔÖÙÛÜàâäçèéêëîïôöùûü", "AAACEEEEIIOOUUUaaaceeeeiioouuu"
    )
    text = F.regexp_replace(text, "['\"]", "")
    text = F.regexp_replace(text, "([a-z])([A-Z])", "$1_$2")
    text = F.lower(F.regexp_replace(text, "[^0-9A-Za-z]+", "_"))
    text = F.regexp_replace(text, "^_+|_+$", "")
    return F.when(text.rlike("^([0-9]|$)"), F.concat(F.lit("x"), text)).otherwise(text)
