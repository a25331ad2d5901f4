"""The marts as additive state: signed deltas of sums and counts, KPIs projected from them.

Three tables of sums hold all that the four marts need: carrier-months (M2 and M5), route-months
by descriptive values (M3) and airport-months by side and place name (M4). Legs that enter
count with sign +1, legs that leave with -1, so a revised month is the old legs out and
the new ones in, whatever part of it changed, and an emptied month is its legs out. A batch
aggregates only those legs. The state is the sum over the batches; rows whose count comes to
zero are gone. Values that a sum cannot take back are kept as counts: a delay cause is NULL
when no leg has it, a place name is one as long as a leg bears it.

A batch counts once its marker is written, which comes last; applying it again does
nothing. ``compact`` writes the sum of all batches as one, whose marker takes the place of theirs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightmarts.operators import marts as M
from flightmarts.operators.enrich import with_carrier_name, with_flags
from flightmarts.schema import CAUSE_COLUMNS

_MARKER = "batch string, replaces array<string>"


class MartState:
    """Additive state under ``root`` (storage that all executors share)."""

    # table -> (first level, its keys, its row count)
    TABLES: dict[str, tuple[Callable[[DataFrame], DataFrame], list[str], str]] = {
        "carrier_month": (M.carrier_month_rows, ["month_start", "carrier_code"], "scheduled_flights"),
        "route_month": (M.route_rows, ["month_start", "origin", "dest", *M.ROUTE_DESCRIPTIVE], "_n"),
        "airport_month": (M.airport_rows, ["airport_code", "month_start", "is_departure", "city", "state"], "_n"),
    }

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _markers(self) -> list:
        try:
            return self.spark.read.schema(_MARKER).parquet(f"{self.root}/_batches").collect()  # a short row per batch
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def batches(self) -> list[str]:
        """The batches that count."""
        rows = self._markers()
        gone = {b for r in rows for b in r["replaces"]}
        return sorted(r["batch"] for r in rows if r["batch"] not in gone)

    def _mark(self, batch: str, replaces: list[str]) -> None:
        row = self.spark.createDataFrame([(batch, replaces)], _MARKER).coalesce(1)
        row.write.mode("overwrite").parquet(f"{self.root}/_batches/id={batch}")

    @staticmethod
    def _additive(rows: DataFrame, keys: list[str]) -> list[str]:
        return [c for c in rows.columns if c not in keys]

    def _merged(self, rows: DataFrame, keys: list[str], count: str) -> DataFrame:
        sums = [F.sum(c).alias(c) for c in self._additive(rows, keys)]
        return rows.groupBy(*keys).agg(*sums).where(F.col(count) != 0)

    def apply(self, batch: str, added: DataFrame | None = None, removed: DataFrame | None = None) -> bool:
        """Count ``added`` legs in and ``removed`` ones out (staged legs); False if the batch is known."""
        if batch in [r["batch"] for r in self._markers()]:
            return False
        for name, (level, keys, count) in self.TABLES.items():
            parts = []
            for legs, sign in ((added, 1), (removed, -1)):
                if legs is not None:
                    rows = level(with_flags(legs))
                    # a sum over no values is 0 here; its count tells
                    parts.append(rows.select(*keys, *[(F.coalesce(c, F.lit(0)) * sign).cast("long").alias(c) for c in self._additive(rows, keys)]))
            if not parts:
                raise ValueError("a batch needs legs to add or to remove")
            rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
            self._merged_delta(rows, keys).write.mode("overwrite").parquet(f"{self.root}/{name}/{batch}")
        self._mark(batch, [])
        return True

    def _merged_delta(self, rows: DataFrame, keys: list[str]) -> DataFrame:
        """What a batch changes: unchanged groups cancel out."""
        columns = self._additive(rows, keys)
        merged = rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in columns])
        return merged.where(" or ".join(f"`{c}` != 0" for c in columns))

    def rows(self, name: str) -> DataFrame:
        """The present first-level rows of a table."""
        _, keys, count = self.TABLES[name]
        paths = [f"{self.root}/{name}/{b}" for b in self.batches()]
        if not paths:
            raise ValueError(f"{self.root} holds no batch")
        return self._merged(self.spark.read.parquet(*paths), keys, count)

    def compact(self, batch: str) -> None:
        """Put one batch in the place of all that count."""
        old = self.batches()
        for name in self.TABLES:
            self.rows(name).write.mode("overwrite").parquet(f"{self.root}/{name}/{batch}")
        self._mark(batch, old)

    def marts(self, carriers: DataFrame) -> dict[str, DataFrame]:
        """The four marts, projected from the state."""
        facts = self.rows("carrier_month")
        for c in CAUSE_COLUMNS:  # NULL, not 0, where no leg has a value
            facts = facts.withColumn(f"_{c}", F.when(F.col(f"_n_{c}") > 0, F.col(f"_{c}")))
        named = with_carrier_name(facts, carriers)
        return {
            "fct_monthly_otp": M.monthly_otp_from(named),
            "fct_route_performance": M.route_performance_from(self.rows("route_month")),
            "fct_airport_congestion": M.airport_congestion_from(self.rows("airport_month")),
            "fct_delay_causes": M.delay_causes_from(named),
        }
