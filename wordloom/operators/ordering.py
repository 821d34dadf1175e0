"""Order-aware building blocks shared by the operators.

Keep-first / keep-last are expressed as aggregates over a struct whose leading
fields are the ordinal: ``min(struct(ord, payload...))``. Unlike a
``row_number()`` window this is a hash aggregate with a partial (map-side)
phase, so a key holding a third of all rows is reduced before the shuffle and
never buffered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               last: bool = False) -> DataFrame:
    """One row per ``keys``: the row with the smallest (largest if ``last``)
    ``order`` tuple. All other columns are carried along."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not rest and len(order) == 1:
        # a lone (numeric) ordinal: plain min/max keeps a fixed-width buffer,
        # so Spark plans a hash aggregate instead of a sort aggregate
        o = order[0]
        return df.groupBy(*keys).agg((F.max(o) if last else F.min(o)).alias(o))
    packed = F.struct(*[F.col(c) for c in list(order) + rest])
    agg = F.max(packed) if last else F.min(packed)
    out = df.groupBy(*keys).agg(agg.alias("_kf"))
    return out.select(*keys, *[F.col(f"_kf.{c}").alias(c) for c in list(order) + rest])


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], k: int,
          rank_col: str = "rank") -> DataFrame:
    """First ``k`` rows per ``keys`` by ``order`` with a 1-based rank.

    ``row_number() <= k`` is planned with a partial ``WindowGroupLimit`` before
    the exchange, so each map task ships at most ``k`` rows per key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def sorted_list(values: Column, order: Sequence[str], drop: Sequence[str] = ()) -> Column:
    """A4 ``collect_list`` of structs sorted by their leading ``order`` fields
    (structs compare field by field), with helper fields removed."""
    arr = F.array_sort(F.collect_list(values))
    if not drop:
        return arr
    return F.transform(arr, lambda s: s.dropFields(*drop))
