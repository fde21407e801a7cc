"""Ordered running totals without a single-task window.

``Window.orderBy(x)`` with no partition key moves the whole input to one task.
The helpers here do the same scan in parallel:

1. range-partition the rows by the order into blocks of about
   ``rows_per_block`` rows and write them with their block number (a reliable
   checkpoint), so every later step sees the same blocks;
2. total every block and prefix-sum the block totals (a row per block and group);
3. run the ordered window inside each block only and add the block offset.

The result is exact; block bounds only balance the work. Rows that tie on the
order columns must be distinct (the callers group by the order value first, or
order by a unique key).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_BLK = "_blk"
ROWS_PER_BLOCK = 500_000


def running_totals(df: DataFrame, order_cols: Sequence[str], sum_cols: Sequence[str],
                   partition_cols: Sequence[str] = (), descending: bool = False,
                   rows_per_block: int = ROWS_PER_BLOCK, suffix: str = "_cum") -> DataFrame:
    """Add ``<c><suffix>`` = inclusive running sum of ``c`` over ``order_cols``
    (within ``partition_cols``) for every ``c`` in ``sum_cols``. ``df`` is
    counted and read again: pass a table or a checkpoint."""
    order: list[Column] = [F.col(c).desc() if descending else F.col(c).asc() for c in order_cols]
    blocks = math.ceil(df.count() / rows_per_block)
    inside = Window.partitionBy(*partition_cols, _BLK).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    if blocks <= 1:  # one block: the plain window
        return df.withColumn(_BLK, F.lit(0)).select(
            *df.columns, *[F.sum(c).over(inside).alias(f"{c}{suffix}") for c in sum_cols])
    blocked = materialize(df.repartitionByRange(blocks, *partition_cols, *order)
                          .withColumn(_BLK, F.spark_partition_id()))
    totals = blocked.groupBy(*partition_cols, _BLK).agg(*[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    before = Window.partitionBy(*partition_cols).orderBy(_BLK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *partition_cols, _BLK,
        *[F.coalesce(F.sum(f"_tot_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sum_cols])
    joined = blocked.join(offsets, [*partition_cols, _BLK])
    return joined.select(
        *df.columns,
        *[(F.sum(c).over(inside) + F.col(f"_off_{c}")).alias(f"{c}{suffix}") for c in sum_cols])


def positions(df: DataFrame, order_cols: Sequence[str], name: str = "position", partition_cols: Sequence[str] = (),
              rows_per_block: int = ROWS_PER_BLOCK, start: int = 1) -> DataFrame:
    """Dense position of each row in the order of ``order_cols`` (unique),
    counted from ``start``: a distributed ``row_number``."""
    tmp = "_one"
    counted = running_totals(df.withColumn(tmp, F.lit(1)), order_cols, [tmp], partition_cols=partition_cols,
                             rows_per_block=rows_per_block)
    return counted.select(*df.columns, (F.col(f"{tmp}_cum") - 1 + start).cast("long").alias(name))
