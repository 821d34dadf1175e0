"""K7 keyed upsert and J6 known/new entity merge as one full outer join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, updates: DataFrame, key: str | Sequence[str],
           replace: Sequence[str], overrides: dict[str, tuple[Column, Column]] | None = None,
           order: str | None = None) -> DataFrame:
    """Merge ``updates`` into ``target`` on ``key``.

    New keys are inserted with the update's values; for existing keys the
    ``replace`` columns take the update's value and every other column keeps
    the target's (K7: ``data`` replaced, ``multiple_meanings`` kept); keys
    without an update are kept. ``overrides`` maps a column to
    ``(value_when_updated, value_when_inserted)`` for special policies
    (J6: ``last_seen`` = run date, ``first_seen`` kept / set on insert).
    A key that comes more than once in ``updates`` counts once, with its last
    row by ``order`` (by all columns where no order is given).
    One full outer join, shuffling both sides on the key once; an
    ``action`` column tells insert / update / keep."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in updates.columns if c not in keys and c != order]
    last = updates.groupBy(*keys).agg(F.max(F.struct(*([order] if order else []), *rest)).alias("_last"))
    updates = last.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in updates.columns if c not in keys])
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns], F.lit(True).alias("_t"))
    u = updates.select(*[F.col(c).alias(f"u_{c}") for c in updates.columns], F.lit(True).alias("_u"))
    cond = [t[f"t_{k}"] == u[f"u_{k}"] for k in keys]
    j = t.join(u, cond, "full_outer")
    is_ins, is_keep = F.col("_t").isNull(), F.col("_u").isNull()
    overrides = overrides or {}
    out = []
    for c in target.columns:
        tc = F.col(f"t_{c}")
        uc = F.col(f"u_{c}") if c in updates.columns else F.lit(None)
        if c in keys:
            v = F.coalesce(tc, uc)
        elif c in overrides:
            when_upd, when_ins = overrides[c]
            v = F.when(is_ins, when_ins).when(is_keep, tc).otherwise(when_upd)
        elif c in replace:
            v = F.when(is_keep, tc).otherwise(uc)
        else:
            v = F.when(is_ins, uc).otherwise(tc)
        out.append(v.alias(c))
    action = F.when(is_ins, "insert").when(is_keep, "keep").otherwise("update")
    return j.select(*out, action.alias("action"))
