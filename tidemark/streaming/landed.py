"""Batches in dated folders, as they land, without listing what has been read before.

A file stream lists everything below its path on every run. Batches land in folders by day, ``<table>/<yyyy-MM-dd>/<batch>/``, so a
cursor is enough: the first of the last ``OVERLAP`` days with batches, and the batches of these days that have been read. A run lists
the days and, of the days from the cursor on, the batches. A batch counts once it is whole, that is, has ``_SUCCESS``; one that
becomes whole more than ``OVERLAP`` days with batches later than its folder's day is not found.

The cursor moves by numbered commits, after the batch's rows have landed. So a run that died is repeated, with the same rows or
with later ones as well, and what lands them must not mind; of two runs at one time one is refused.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.sources.commits import CommitLog
from tidemark.sources.tables import children, path_exists

OVERLAP = 3
# One batch takes at most so many folders, so a first run over a large lake is not one single batch.
MOST_FOLDERS = 200


@dataclass(frozen=True)
class LandedFolders:
    """The batches of a table below ``path``; the cursor is kept at ``cursor``."""

    path: str
    cursor: str

    def run(self, spark: SparkSession, schema: StructType, land: Callable[[DataFrame, int], None], most: int = MOST_FOLDERS) -> int:
        """Land every batch that has not been read, oldest first, several at a time; returns how many there were."""
        log, total = CommitLog(self.cursor), 0
        while True:
            last, state = log.latest(spark)
            found, state = self._next(spark, state, most)
            if not found:
                return total
            land(spark.read.schema(schema).parquet(*(f"{self.path}/{f}" for f in found)), last + 1)
            log.commit(spark, last + 1, state)
            total += len(found)

    def _next(self, spark: SparkSession, state: dict, most: int) -> tuple[list[str], dict]:
        """The next folders, and the cursor behind them."""
        floor, seen = state.get("floor", ""), set(state.get("seen", []))
        days = [d for d in children(spark, self.path) if d >= floor]
        new: list[str] = []
        for day in days:
            if len(new) > most:
                break
            folders = [f"{day}/{n}" for n in children(spark, f"{self.path}/{day}")]
            new += [f for f in folders if f not in seen and path_exists(spark, f"{self.path}/{f}/_SUCCESS")]
        taken, rest = new[:most], new[most:]
        if len(days) >= OVERLAP:
            floor = min([days[-OVERLAP], *(f.split("/")[0] for f in rest[:1])])
        return taken, {"floor": floor, "seen": sorted(f for f in (*seen, *taken) if f.split("/")[0] >= floor)}
