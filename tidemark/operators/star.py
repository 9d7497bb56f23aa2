"""Metadata-driven star join: a list of table entries becomes a chain of left joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class StarEntry:
    """One table of a star. The first entry of a list is the base and needs no condition.

    A condition may use the alias of any earlier entry, so a dimension can hang on another dimension.
    """

    table: str
    alias: str
    cols: Sequence[str]
    condition: str | None = None

    @classmethod
    def of(cls, raw: StarEntry | Mapping[str, Any]) -> StarEntry:
        """Accept the dictionary form, in which ``cols`` may be one comma-separated string of plain columns."""
        if isinstance(raw, cls):
            return raw
        cols = raw["cols"]
        if isinstance(cols, str):
            cols = [c.strip() for c in cols.split(",")]
        return cls(raw["table"], raw["alias"], tuple(cols), raw.get("condition"))


def star_join(
    spark: SparkSession,
    spec: Sequence[StarEntry | Mapping[str, Any]],
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Join the entries left to right and select all their columns.

    ``tables`` supplies frames by table name; other names are read from the catalog. Dimensions should hold one row per
    key (current versions), or facts fan out.
    """
    entries = [StarEntry.of(e) for e in spec]
    _validate(entries)
    given = tables or {}

    def load(entry: StarEntry) -> DataFrame:
        frame = given[entry.table] if entry.table in given else spark.read.table(entry.table)
        return frame.alias(entry.alias)

    joined = load(entries[0])
    for entry in entries[1:]:
        joined = joined.join(load(entry), F.expr(entry.condition), "left")
    result = joined.select(*[F.expr(c) for entry in entries for c in entry.cols])
    if len(set(result.columns)) != len(result.columns):
        raise ValueError(f"star join: output column named twice in {result.columns}")
    return result


def _validate(entries: Sequence[StarEntry]) -> None:
    if not entries:
        raise ValueError("star join: no tables given")
    aliases = [e.alias for e in entries]
    if len(set(aliases)) != len(aliases):
        raise ValueError(f"star join: alias used twice in {aliases}")
    for entry in entries[1:]:
        if not (entry.condition or "").strip():
            raise ValueError(f"star join: entry {entry.alias!r} has no join condition")
    if not any(entry.cols for entry in entries):
        raise ValueError("star join: no output columns")
