"""Top-k rows per metric (and per partition key), all metrics in one plan.

The original jobs ran one `ORDER BY metric DESC LIMIT k` job per metric and per
group from a driver loop. Here the metrics are stacked into (metric, value)
rows and ranked with `row_number` over (metric, *partition_by). Spark plans
the `rank <= k` filter as a `WindowGroupLimit`: a partial top-k runs before the
shuffle, so each map task sends at most k rows per window partition, however
many rows one group or key holds. That partial top-k sorts all rows of a task,
though, so lists over all groups are `ORDER BY ... LIMIT k` per metric instead:
each task keeps a heap of k rows, and the metrics read one aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowstats.schemas import TOP_K

_VALUE = "_topk_value"


def _value_type(df: DataFrame, metrics: list[str]) -> str:
    types = [df.schema[m].dataType for m in metrics]
    integral = all(isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) for t in types)
    return "long" if integral else "double"


def _limited(df: DataFrame, value: Column, order_keys: list[str], k: int, rank_col: str) -> DataFrame:
    """The first k rows by `value` descending, numbered; the window covers those k rows only."""
    order = [value.desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in order_keys]]
    return df.orderBy(*order).limit(k).withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))


def top_k_by_metrics(
    df: DataFrame,
    metrics: list[str],
    order_keys: list[str],
    partition_by: list[str] | None = None,
    k: int = TOP_K,
    metric_col: str = "metric",
    rank_col: str = "rank",
) -> DataFrame:
    """For every metric in `metrics`, the k rows of `df` with the largest value.

    Ranking is per (metric, *partition_by), by value descending with NULLs last,
    then by `order_keys` ascending so ties at rank k are deterministic. Every
    output row keeps all columns of `df` plus `metric_col` and `rank_col`.
    """
    partition_by = list(partition_by or [])
    vtype = _value_type(df, metrics)
    if not partition_by:
        lists = [
            _limited(df.select(F.lit(m).alias(metric_col), "*"), F.col(m).cast(vtype), order_keys, k, rank_col)
            for m in metrics
        ]
        out = lists[0]
        for one in lists[1:]:
            out = out.union(one)
        return out.select(metric_col, rank_col, *[c for c in df.columns if c not in (metric_col, rank_col)])
    pairs = []
    for m in metrics:
        pairs += [F.lit(m), F.col(m).cast(vtype)]
    stacked = df.select("*", F.stack(F.lit(len(metrics)), *pairs).alias(metric_col, _VALUE))
    window = Window.partitionBy(metric_col, *partition_by).orderBy(
        F.col(_VALUE).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in order_keys]
    )
    ranked = stacked.withColumn(rank_col, F.row_number().over(window)).where(F.col(rank_col) <= k)
    leading = [metric_col, *partition_by, rank_col]
    rest = [c for c in df.columns if c not in leading]
    return ranked.select(*leading, *rest)


def top_k_per_class(
    df: DataFrame,
    value_col: str,
    order_keys: list[str],
    partition_by: list[str],
    k: int = TOP_K,
    rank_col: str = "rank",
) -> DataFrame:
    """The k rows with the largest `value_col` per `partition_by` (rows are already long)."""
    window = Window.partitionBy(*partition_by).orderBy(
        F.col(value_col).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in order_keys]
    )
    ranked = df.withColumn(rank_col, F.row_number().over(window)).where(F.col(rank_col) <= k)
    leading = [*partition_by, rank_col]
    return ranked.select(*leading, *[c for c in df.columns if c not in leading])
