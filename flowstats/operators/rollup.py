"""Per-group rows plus `all` rows, from one pre-aggregated frame.

The original ran the per-group query and the overall query separately and
pasted the results into one document. Here the input is scanned and
aggregated once per (group, *keys), with map-side combining. The `all` rows
come from GROUPING SETS over those partial rows, not over the input: every
counter is a sum, so sums of the partial sums are exact, and the expansion
touches one row per (group, key) instead of every input record. `grouping()`
tells an `all` row from a real NULL group, which counts towards `all` but is
not reported on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

IS_ALL = "is_all"


def with_all_rows(
    per_group: DataFrame,
    group_col: str,
    keys: list[str],
    sum_cols: list[str],
) -> DataFrame:
    """Rows of `per_group` with a non-NULL group, plus one `all` row per `keys`.

    `per_group` must be aggregated by (group_col, *keys) and still contain the
    NULL-group rows. `all` rows have `is_all = true` and a NULL group.
    """
    rolled = per_group.groupingSets([[group_col, *keys], list(keys)], group_col, *keys).agg(
        (F.grouping(group_col) == 1).alias(IS_ALL), *[F.sum(c).alias(c) for c in sum_cols]
    )
    return rolled.where(F.col(IS_ALL) | F.col(group_col).isNotNull()).select(
        IS_ALL, group_col, *keys, *sum_cols
    )
