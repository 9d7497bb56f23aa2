"""The list of tables to ingest and what is known about each."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.operators.quality import Rule

# The start of time for a table that was never extracted, and the default schema of a source.
EPOCH_DATE = "1900-01-01"
DEFAULT_SCHEMA = "dbo"

_CONTROL_SCHEMA = "schema string, table string, cdc_col string, from_date string"


@dataclass(frozen=True)
class TableSpec:
    """One table on its way from source to gold.

    ``cdc_col`` drives extraction. ``keys`` and ``sequence`` identify a row version. ``dedupe`` says what silver keeps:

    * ``version`` and ``unseen``: one row per key and sequence, looked up in the days that the batch touches; no state
    * ``unseen_key``: one row per key, whatever its time; looked up among the keys in the range of the batch's keys; for
      facts
    * ``key``: the first arrival per key, remembered in streaming state
    * ``none``: every row
    """

    table: str
    cdc_col: str
    schema: str = DEFAULT_SCHEMA
    from_date: str = ""
    columns: StructType | None = None
    keys: tuple[str, ...] = ()
    sequence: tuple[str, ...] = ()
    dedupe: str = "none"
    transforms: tuple[Callable[[DataFrame], DataFrame], ...] = ()
    rules: tuple[Rule, ...] = ()
    track: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.dedupe not in ("version", "key", "unseen", "unseen_key", "none"):
            raise ValueError(f"table {self.table!r}: unknown dedupe {self.dedupe!r}")

    @property
    def qualified(self) -> str:
        return f"{self.schema}.{self.table}"


def load_specs(
    spark: SparkSession, path: str, known: Mapping[str, TableSpec] | None = None
) -> list[TableSpec]:
    """Read all entries of a JSON control list, in the order of the list.

    An entry names its schema, table, cdc column and optional backfill start; whatever else is known about a table of
    that name comes from ``known``.
    """
    rows = spark.read.schema(_CONTROL_SCHEMA).option("multiLine", True).json(path).collect()
    specs = []
    for row in rows:
        base = (known or {}).get(row["table"], TableSpec(row["table"], row["cdc_col"]))
        specs.append(
            replace(
                base,
                cdc_col=row["cdc_col"],
                schema=row["schema"] or DEFAULT_SCHEMA,
                from_date=row["from_date"] or "",
            )
        )
    return specs
