"""Percentiles from KLL sketches: samples of a few thousand values per group, which can be merged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One over the rank error of approximate percentiles, as a share of the group.
ACCURACY = 1_000
#: Slots of scan tasks whose sketches of one group are merged by themselves first.
MERGE_SLOTS = 512
GROUP_ROWS = "__group_rows"

# Limits of the sketch library, and the error that it states for a size (in 99 of 100 cases).
LEAST_SIZE, LARGEST_SIZE = 8, 65_535
ERROR_FACTOR, ERROR_POWER = 2.446, 0.9433


def sketch_size(accuracy: int) -> int:
    """The size at which the rank error is 1 / ``accuracy``; groups of fewer values are exact."""
    return max(LEAST_SIZE, min(LARGEST_SIZE, round((ERROR_FACTOR * accuracy) ** (1 / ERROR_POWER))))


def sketched(rows: DataFrame, group: Sequence[str], columns: Sequence[str], size: int) -> DataFrame:
    """``group``, the rows per group, and for each of ``columns`` its sketch and the count of its values, of a table. Sketches of one group are
    merged by slots of scan tasks, then the slots: of 100,000 tasks no task merges more than a few hundred."""
    slotted = rows.withColumn("__slot", F.pmod(F.spark_partition_id(), F.lit(MERGE_SLOTS)))
    first = [F.count("*").alias(GROUP_ROWS)]
    second = [F.sum(GROUP_ROWS).alias(GROUP_ROWS)]
    for column in columns:
        first += [F.kll_sketch_agg_double(column, F.lit(size)).alias(f"{column}_sketch"), F.count(column).alias(f"{column}_n")]
        # the sketch of no values cannot be read
        known = F.when(F.col(f"{column}_n") > 0, F.col(f"{column}_sketch"))
        second += [F.kll_merge_agg_double(known, F.lit(size)).alias(f"{column}_sketch"), F.sum(f"{column}_n").alias(f"{column}_n")]
    return slotted.groupBy(*group, "__slot").agg(*first).groupBy(*group).agg(*second)


def quantiles(sketch: str, n: str, ranks: Sequence[float]) -> Column:
    """The least values that at least these shares of all do not exceed, an array; null if there are no values."""
    return F.when(F.col(n) > 0, F.kll_sketch_get_quantile_double(sketch, F.array(*map(F.lit, ranks))))
