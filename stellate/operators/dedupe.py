"""One row per key with a deterministic survivor.

``dropDuplicates`` keeps whichever row a task sees first, so two runs (or a
dimension and its bridge written by separate jobs) can disagree.  Here the
survivor is the smallest row under an explicit total order: the ``order_by``
columns first, then every remaining column, each ascending with nulls last.

It is a plain ``groupBy(keys).agg(min_by(row, order))``: a hash aggregate
with map-side partial aggregation, so a key holding a third of the table
is reduced inside every map task before the shuffle.  Null keys form one
group, as with ``dropDuplicates``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

_ROW = "__stl_row"


def _orderable(df: DataFrame, name: str) -> bool:
    return not isinstance(df.schema[name].dataType, MapType)


def order_key(df: DataFrame, cols: Sequence[str]) -> Column:
    """A struct that sorts rows by ``cols`` ascending, nulls last."""
    parts = []
    for c in cols:
        parts.append(F.col(c).isNull())
        parts.append(F.col(c))
    return F.struct(*parts) if parts else F.lit(0)


def survivor_order(df: DataFrame, keys: Sequence[str],
                   order_by: Sequence[str] = ()) -> list[str]:
    """``order_by`` followed by all other orderable non-key columns."""
    keys = list(keys)
    order = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order and _orderable(df, c)]
    return order + rest


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Keep one row per ``keys``: the first under ``order_by`` + remaining columns."""
    keys = list(keys)
    missing = [k for k in list(keys) + list(order_by) if k not in df.columns]
    if missing:
        raise ValueError(f"dedupe: unknown columns {missing}")
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.select(*keys).distinct()
    order = survivor_order(df, keys, order_by)
    row = F.struct(*[F.col(c) for c in others])
    agg = df.groupBy(*keys).agg(F.min_by(row, order_key(df, order)).alias(_ROW))
    return agg.select(*keys, *[F.col(f"{_ROW}.{c}").alias(c) for c in others]).select(*df.columns)
