"""Labelled pattern scan over whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The labelled patterns of the default scan. Names of an organisation are
# site-specific, so they come as a further entry of the caller's own mapping.
DEFAULT_PATTERNS = {
    "private key": "BEGIN PRIVATE KEY",
    "cloud access key": "AKIA[0-9A-Z]{16}",
    "hard-coded password": "(?i)(password|pwd)\\s*[:=]\\s*[\"'][^\"']{4,}[\"']",
    "hard-coded token": "(?i)(api[_-]?key|access[_-]?token)\\s*[:=]\\s*[\"'][^\"']{8,}[\"']",
    "private network address": (
        "\\b(?:10\\.\\d{1,3}\\.\\d{1,3}\\.\\d{1,3}|192\\.168\\.\\d{1,3}\\.\\d{1,3})\\b"
    ),
}


def findings(
    texts: DataFrame, text: str, keep: list[str], patterns: dict[str, str]
) -> DataFrame:
    """One row per text and label that occurs in it. Map-only: no shuffle."""
    labels = F.array_compact(
        F.array(*[F.when(F.col(text).rlike(p), F.lit(name)) for name, p in patterns.items()])
    )
    return texts.select(*keep, F.explode(labels).alias("label"))


def findings_by_label(
    texts: DataFrame, text: str, groups: list[str], patterns: dict[str, str]
) -> DataFrame:
    """Number of texts per label and group."""
    return (
        findings(texts, text, groups, patterns)
        .groupBy("label", *groups)
        .agg(F.count(F.lit(1)).alias("documents"))
    )
