"""Column-name and column-type shaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normal_name(name: str) -> str:
    """Header normalisation: lower case, spaces to underscores, nothing else."""
    return name.lower().replace(" ", "_")


def normalise_headers(df: DataFrame) -> DataFrame:
    """Rename every column with :func:`normal_name`.

    ``toDF`` is used (not ``col(name)``) so headers holding dots survive.
    Two headers that collide after normalising are an error.
    """
    new = [normal_name(c) for c in df.columns]
    dup = sorted({n for n in new if new.count(n) > 1})
    if dup:
        raise ValueError(f"headers collide after normalising: {dup}")
    return df.toDF(*new)


def apply_mapping(df: DataFrame, specs: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Rename + cast + order + prune in one projection.

    ``specs`` holds ``(source, source_type, target, target_type)``; columns not
    listed are dropped.  Conversions that fail give null (``try_cast``).
    """
    cols = []
    for src, _src_type, dst, dst_type in specs:
        if src not in df.columns:
            raise ValueError(f"apply_mapping: no column {src!r}")
        cols.append(F.col(f"`{src}`").try_cast(dst_type).alias(dst))
    return df.select(*cols)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename present columns; absent ones are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Type text columns (or those listed) from their content: bigint, else double, else string.

    One aggregation counts, per column, the non-null values and how many of
    them cast cleanly to bigint and to double; only those counts reach the
    driver.  A column whose every non-null value converts gets that type
    (blanks become null, so an integer column with gaps stays integral).
    """
    text = [c for c, t in df.dtypes if t == "string" and (columns is None or c in columns)]
    if not text:
        return df
    aggs = []
    for i, c in enumerate(text):
        v = F.nullif(F.trim(F.col(f"`{c}`")), F.lit(""))
        aggs += [F.count(v).alias(f"n{i}"), F.count(v.try_cast("bigint")).alias(f"i{i}"),
                 F.count(v.try_cast("double")).alias(f"d{i}")]
    stats = df.agg(*aggs).first()
    cols = []
    for c in df.columns:
        if c not in text:
            cols.append(F.col(f"`{c}`"))
            continue
        i = text.index(c)
        n, ni, nd = stats[f"n{i}"], stats[f"i{i}"], stats[f"d{i}"]
        v = F.nullif(F.trim(F.col(f"`{c}`")), F.lit(""))
        if n and ni == n:
            cols.append(v.try_cast("bigint").alias(c))
        elif n and nd == n:
            cols.append(v.try_cast("double").alias(c))
        else:
            cols.append(F.col(f"`{c}`"))
    return df.select(*cols)
