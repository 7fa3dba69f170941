"""Two-pass entity reconciliation across sources that share no id.

Semantics (per key = e.g. (name, postcode)):

1. pass 1: left and right rows with equal keys are matched; one row per key;
2. left rows with no match stay (``left_only``); right rows with no match
   (``right_only``) whose name carries a campus suffix (``'% - %'``) get the
   suffix stripped and are matched against ``left_only`` (a left join);
   other unmatched right rows are discarded;
3. the union of both passes has one row per distinct left key (null keys
   never match, but equal null keys collapse, as in a dedupe);
4. a dense id ordered by ``id_order`` is put first.

Survivors are deterministic: the smallest row under the left ``order_by``,
the remaining left columns, then the right columns (nulls last).  That order
is lexicographic over (left part, right part), so the smallest joined pair
of a key is (smallest left row, smallest right row).

Plan: no joins at all, two aggregations.

* **Aggregation 1** groups the union of both sides by key (rows with a null
  key are kept apart per side, since nulls never match) and keeps each
  side's smallest row: one shuffle, with map-side partial aggregation, gives
  matched, left-only and right-only keys at once.  The order of a row holds
  all its columns, so the row is read from the smallest order and doesn't
  travel beside it (unless it has columns without an order).
* **Aggregation 2** re-keys that single output -- right-only campus names are
  stripped, everything else keeps its key -- and groups again: a left-only
  key picks up the smallest stripped right row that lands on it; matched
  keys pass through unchanged.

So every input row crosses the network once, hot keys are reduced inside
the map tasks, and there is no fan-out and no join skew to handle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.functions.text import campus_base_name, has_campus_suffix
from stellate.operators.dedupe import order_key, survivor_order
from stellate.operators.ids import assign_ids

_L, _LO, _R, _RO, _NK, _TAG = "__stl_l", "__stl_lo", "__stl_r", "__stl_ro", "__stl_nk", "__stl_tag"


def _any_null(keys: Sequence[str]) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


def _payload(cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in cols]) if cols else F.struct(F.lit(None).cast("string").alias("__stl_none"))


def _side(df: DataFrame, keys, cols, order, own: tuple[str, str], other: tuple[str, str],
          other_types: tuple) -> DataFrame:
    row = F.lit(None) if _ordered_whole(cols, order) else _payload(cols)
    return df.select(*keys, row.alias(own[0]), order_key(df, order).alias(own[1]),
                     F.lit(None).cast(other_types[0]).alias(other[0]),
                     F.lit(None).cast(other_types[1]).alias(other[1]))


def _ordered_whole(cols: Sequence[str], order: Sequence[str]) -> bool:
    return bool(cols) and set(cols) <= set(order)


def _smallest(cols: Sequence[str], order: Sequence[str], row: str, key: str) -> list[Column]:
    """The aggregates that leave a side's smallest row, or what it is read from, and its order."""
    return [F.min(key).alias(key)] if _ordered_whole(cols, order) else [F.min_by(row, key).alias(row), F.min(key).alias(key)]


def _row(cols: Sequence[str], order: Sequence[str], row: str, key: str) -> Column:
    if not _ordered_whole(cols, order):
        return F.col(row)
    return F.when(F.col(key).isNotNull(), F.struct(*[F.col(key).getField(c).alias(c) for c in cols]))


def reconcile(left: DataFrame, right: DataFrame,
              keys: Sequence[str] = ("school_name", "postcode"),
              name_col: str = "school_name",
              id_col: str | None = "profile_id",
              order_by: Sequence[str] = ("school_id",),
              right_order_by: Sequence[str] = (),
              id_order: Sequence[str] | None = None) -> DataFrame:
    """Reconcile ``right`` onto ``left`` (see module doc)."""
    keys = list(keys)
    if name_col not in keys:
        raise ValueError("name_col must be one of the keys")
    overlap = (set(left.columns) & set(right.columns)) - set(keys)
    if overlap:
        raise ValueError(f"non-key columns on both sides: {sorted(overlap)}")
    lcols = [c for c in left.columns if c not in keys]
    rcols = [c for c in right.columns if c not in keys]
    lord = survivor_order(left, keys, order_by)
    rord = survivor_order(right, keys, right_order_by)

    # types of the per-side payloads, to pad the other side with typed nulls
    lt = left.select(_payload(lcols).alias("a"), order_key(left, lord).alias("b")).schema
    rt = right.select(_payload(rcols).alias("a"), order_key(right, rord).alias("b")).schema
    ltypes = ("void" if _ordered_whole(lcols, lord) else lt["a"].dataType, lt["b"].dataType)
    rtypes = ("void" if _ordered_whole(rcols, rord) else rt["a"].dataType, rt["b"].dataType)
    rk = right.select(*keys, *rcols)
    for k in keys:                       # align key types (left's win)
        rk = rk.withColumn(k, F.col(k).try_cast(left.schema[k].dataType))
    lside = _side(left, keys, lcols, lord, (_L, _LO), (_R, _RO), rtypes).withColumn(_NK, F.lit("L"))
    rside = _side(rk, keys, rcols, rord, (_R, _RO), (_L, _LO), ltypes).withColumn(_NK, F.lit("R"))
    both = lside.unionByName(rside).withColumn(_NK, F.when(_any_null(keys), F.col(_NK)))

    # aggregation 1: smallest row of each side per key
    a1 = both.groupBy(*keys, _NK).agg(*_smallest(lcols, lord, _L, _LO), *_smallest(rcols, rord, _R, _RO))
    a1 = a1.select(*keys, _NK, _row(lcols, lord, _L, _LO).alias(_L), _row(rcols, rord, _R, _RO).alias(_R), _RO)
    has_l, has_r = F.col(_L).isNotNull(), F.col(_R).isNotNull()
    tag = (F.when(has_l & has_r, F.lit("M")).when(has_l, F.lit("L"))
            .when(has_r & has_campus_suffix(name_col), F.lit("R")))
    rekeyed = (a1.withColumn(_TAG, tag).where(F.col(_TAG).isNotNull())
                 .withColumn(name_col, F.when(F.col(_TAG) == "R", campus_base_name(name_col))
                                        .otherwise(F.col(name_col)))
                 .withColumn(_NK, F.when(_any_null(keys), F.col(_TAG))))

    # aggregation 2: left-only keys pick up the smallest stripped right row
    zero = F.lit(0)
    a2 = rekeyed.groupBy(*keys, _NK).agg(
        F.min_by(F.struct(F.col(_L).alias("l"), F.col(_R).alias("r")),
                 F.when(F.col(_TAG) == "M", zero)).alias("m"),
        F.min_by(_L, F.when(F.col(_TAG) == "L", zero)).alias("lo"),
        F.min_by(_R, F.when(F.col(_TAG) == "R", F.col(_RO))).alias("rs"))
    lrow = F.coalesce(F.col("m.l"), F.col("lo"))
    rrow = F.when(F.col("m").isNotNull(), F.col("m.r")).otherwise(F.col("rs"))
    out = (a2.where(lrow.isNotNull())
             .select(*keys, lrow.alias(_L), rrow.alias(_R))
             .select(*keys, *[F.col(f"{_L}.{c}").alias(c) for c in lcols],
                     *[F.col(f"{_R}.{c}").alias(c) for c in rcols]))
    if id_col is None:
        return out
    order = list(id_order) if id_order is not None else list(order_by) + keys
    return assign_ids(out, order, id_col)
