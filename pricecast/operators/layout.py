"""How the rows of a panel are spread over tasks before ordered operators run.

Two layouts give the same results:

``SERIES``
    One window partition per series. Right for daily bars: a clean panel holds at most one row per series
    and calendar day, so a partition is bounded by the calendar however large the input was.

``BlockLayout``
    For panels with no such bound (ticks), where one series may hold a large share of all rows. Rows get a
    position within their series from counts per time bucket, are cut into blocks of equal length, and each
    block receives a copy of the rows just before it. No task sees more than one block, and a series is
    spread over as many tasks as it has blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from pricecast.session import materialise


@dataclass(frozen=True)
class SeriesLayout:
    order: tuple[str, ...] = ("date",)

    def window(self) -> WindowSpec:
        return Window.partitionBy("series_id").orderBy(*self.order)

    def prepare(self, df: DataFrame, halo: int) -> DataFrame:
        return df

    def finish(self, df: DataFrame) -> DataFrame:
        return df

    def rows(self, before: int, after: int) -> WindowSpec:
        return self.window().rowsBetween(before, after)


SERIES = SeriesLayout()


def with_positions(df: DataFrame, order: tuple[str, ...], partitions: int | None = None) -> DataFrame:
    """Add ``_rn``, the 1-based position within the series, without ordering a whole series in one task.

    Rows are cut into ranges of (series, order) by sampled bounds, so a series, or a single minute of it, is spread over
    as many tasks as its rows fill. A position is the row's place in its own range plus the rows of the series in the
    ranges before; only these counts, one for each range and series, are added up. Rows of a series with an equal order
    come in any sequence, fixed by the first writing, and stay in one range: ``order`` should tell them apart.
    """
    by = ["series_id", *order]
    ranges = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    # The number holds the range in its upper and the place in the range in its lower 33 bits.
    placed = materialise(ranges.sortWithinPartitions(*by).withColumn("_id", F.monotonically_increasing_id()), "ranges")
    placed = placed.withColumn("_range", F.shiftright("_id", 33))
    counts = placed.groupBy("series_id", "_range").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = Window.partitionBy("series_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("series_id", "_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_off"))
    numbered = placed.join(offsets, ["series_id", "_range"])
    return numbered.withColumn("_rn", F.col("_off") + F.col("_id")).drop("_range", "_id", "_off")


@dataclass(frozen=True)
class BlockLayout:
    """Blocks of ``size`` rows over a frame that carries ``_rn`` (see :func:`with_positions`)."""

    size: int = 4096

    def window(self) -> WindowSpec:
        return Window.partitionBy("series_id", "_block").orderBy("_rn")

    def rows(self, before: int, after: int) -> WindowSpec:
        return self.window().rowsBetween(before, after)

    def prepare(self, df: DataFrame, halo: int) -> DataFrame:
        """Place every row in its block and copy the last ``halo`` rows of a block into the next one."""
        if halo > self.size:
            raise ValueError(f"look-back of {halo} rows needs blocks of at least that size, not {self.size}")
        home = F.floor((F.col("_rn") - 1) / self.size)
        place = (F.col("_rn") - 1) % self.size
        homes = F.when(place >= self.size - halo, F.array(home, home + 1)).otherwise(F.array(home))
        return df.withColumn("_home", home).withColumn("_block", F.explode(homes))

    def finish(self, df: DataFrame) -> DataFrame:
        return df.where(F.col("_block") == F.col("_home")).drop("_block", "_home")
