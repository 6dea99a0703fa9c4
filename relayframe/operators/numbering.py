"""Dense numbers for the rows of a large table, without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_ROW_BITS = 33  # how many bits of monotonically_increasing_id count rows within a partition


def dense_numbers(rows: DataFrame, name: str, after: int = 0, order: list[str] | None = None) -> DataFrame:
    """``rows`` with the numbers ``after + 1, after + 2, ...`` in column ``name``, none left out.

    With ``order`` the numbers follow it: the rows are dealt by ranges and sorted within them. Without
    it, they follow the rows as they lie. The place of each row in its partition is written once, so a
    recomputed partition cannot number anew; only one count per partition is summed up in order.
    """
    if order:
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    placed = cut_lineage(rows.withColumns({
        "_part": F.shiftright(place, _ROW_BITS), "_at": place.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))}), "placed")
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    # One row for each partition of the write.
    numbered = placed.join(F.broadcast(starts), "_part")
    number = (F.col("_start") + F.col("_at") + F.lit(after + 1)).cast("bigint")
    return numbered.withColumn(name, number).select(*rows.columns, name)
