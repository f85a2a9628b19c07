"""How many value ranges an ordered operator cuts its input into.

One plan serves every size: a table that fits one range is the case of a single range.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

# Rows of a range, as long as there are not over ``MOST_RANGES``; beyond 10^9 rows the ranges grow, not their number.
MOST_ROWS = 1_000_000
# What the driver holds of a column: a cut for each range.
MOST_RANGES = 1024
# Below this a range is not worth a task of its own.
LEAST_ROWS = 20_000
# Texts drawn by lot for cuts between texts, at least, and for each range.
SAMPLE_ROWS = 2_000
SAMPLE_PER_RANGE = 20


def range_count(df: DataFrame, rows: int) -> int:
    """Enough ranges to use the shuffle partitions, none of them tiny, none of them huge."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(MOST_RANGES, max(math.ceil(rows / MOST_ROWS), min(4 * partitions, rows // LEAST_ROWS))))
