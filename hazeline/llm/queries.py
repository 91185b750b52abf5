"""Importing this module registers every query of the package."""

from hazeline.llm import (  # noqa: F401
    chat_format, decontaminate, license_scan, line_dedup, mixing, quality_classifier, quality_rules, simhash, source_divergence,
    spelling_variants, substring_dedup, token_counts, token_shards,
)
from hazeline.llm.registry import ORACLE, REGISTRY

__all__ = ["ORACLE", "REGISTRY"]
