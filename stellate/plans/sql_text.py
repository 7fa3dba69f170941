"""SQL twins of composite operators, for the DuckDB oracle statements."""

from __future__ import annotations


def sql_reconcile(left: str, right: str, left_cols: list[str], right_cols: list[str],
                  order: list[str], id_col: str, id_order: list[str],
                  keys=("school_name", "postcode"), name_col="school_name") -> str:
    """The two-pass reconcile written directly in SQL (dedupe after join)."""
    k = list(keys)
    on = " AND ".join(f"x.{c} = y.{c}" for c in k)
    lsel = ", ".join([f"x.{c}" for c in k] + [f"x.{c}" for c in left_cols])
    rsel = ", ".join(f"y.{c}" for c in right_cols)
    allc = k + left_cols + right_cols
    ob = ", ".join(f"{c} ASC NULLS LAST" for c in order)
    part = ", ".join(k)
    cols = ", ".join(allc)
    idob = ", ".join(f"{c} ASC NULLS FIRST" for c in id_order)
    strip_cols = ", ".join(
        (f"trim(regexp_extract({c}, '^\"?(.+?)\\s+-\\s+', 1)) AS {c}" if c == name_col else c)
        for c in k + right_cols)
    return f"""
WITH l AS ({left}),
r AS ({right}),
m AS (SELECT {lsel}, {rsel} FROM l x JOIN r y ON {on}),
md AS (SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {ob}) AS rn__ FROM m) t WHERE rn__ = 1),
lo AS (SELECT * FROM l x WHERE NOT EXISTS (SELECT 1 FROM r y WHERE {on})),
ro AS (SELECT * FROM r y WHERE NOT EXISTS (SELECT 1 FROM l x WHERE {on})),
st AS (SELECT {strip_cols} FROM ro WHERE {name_col} LIKE '% - %'),
a AS (SELECT {lsel}, {rsel} FROM lo x LEFT JOIN st y ON {on}),
ad AS (SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {ob}) AS rn__ FROM a) t WHERE rn__ = 1),
u AS (SELECT * FROM md UNION ALL SELECT * FROM ad)
SELECT row_number() OVER (ORDER BY {idob}) AS {id_col}, {cols} FROM u"""
