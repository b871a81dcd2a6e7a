"""Two-level running aggregates (running max, min, sum, xor) over an ordered key.

``cumulative(df, keys, order, bucket, aggs)`` gives every row the running value of
each aggregate over all rows of its key that come before it (or up to and
including it) in ``(bucket, *order)`` order, without any Window holding all rows
of one key:

* level 1: Window over ``(keys, bucket)`` ordered by ``order``;
* level 2: one summary row per ``(keys, bucket)`` (partial aggregation), a running
  aggregate over the key's earlier buckets, joined back on ``(keys, bucket)``.

With ``keys=[]`` the order is global (e.g. arrival order for watermarks); only the
summary, one row per bucket, is then ordered in a single task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_FUNCS = {"max": F.max, "sum": F.sum, "min": F.min, "xor": F.bit_xor}


def _combine(fn: str, local: Column, carry: Column) -> Column:
    if fn == "sum":
        return F.coalesce(local, F.lit(0)) + F.coalesce(carry, F.lit(0))
    if fn == "xor":
        return F.coalesce(local, F.lit(0)).bitwiseXOR(F.coalesce(carry, F.lit(0)))
    if fn == "max":
        return F.greatest(local, carry)
    return F.least(local, carry)


def cumulative(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: str,
    aggs: Mapping[str, tuple[str, Column]],
    *,
    inclusive: bool = True,
) -> DataFrame:
    """Add one column per ``aggs`` entry ``out -> (fn, value)``; fn in max/sum/min/xor.

    ``inclusive=False`` excludes the row itself (the value *before* this row)."""
    keys = list(keys)
    last = Window.currentRow if inclusive else -1
    w = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, last)
    staged = df.select("*", *[value.alias(f"_v_{out}") for out, (_, value) in aggs.items()])
    local = staged.select(
        "*", *[_FUNCS[fn](f"_v_{out}").over(w).alias(f"_l_{out}") for out, (fn, _) in aggs.items()]
    )
    summary = staged.groupBy(*keys, bucket).agg(
        *[_FUNCS[fn](f"_v_{out}").alias(f"_b_{out}") for out, (fn, _) in aggs.items()]
    )
    before = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(bucket)
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(
        *keys, bucket, *[_FUNCS[fn](f"_b_{out}").over(before).alias(f"_c_{out}") for out, (fn, _) in aggs.items()]
    )
    joined = local.join(summary, on=[*keys, bucket], how="inner")
    result = [F.col(c) for c in df.columns] + [
        _combine(fn, F.col(f"_l_{out}"), F.col(f"_c_{out}")).alias(out) for out, (fn, _) in aggs.items()
    ]
    return joined.select(*result)
