"""Trigram name matching bound to the part names."""

from __future__ import annotations

from stellate.operators.similarity import PRIME, _coefficients, closest_pairs, lsh_join, similarity_join
from stellate.plans.registry import register
from stellate.plans.tables import table

_GRAMS_SQL = """
WITH n AS (SELECT DISTINCT p_name AS name FROM part WHERE p_name IS NOT NULL),
g AS (SELECT name, list_distinct(list_transform(range(1, length(name) - 1),
                                                lambda i: substr(lower(name), i, 3))) AS grams
      FROM n WHERE length(name) >= 3),
p AS (SELECT a.name AS name_a, b.name AS name_b, len(a.grams) AS na, len(b.grams) AS nb,
             len(list_intersect(a.grams, b.grams)) AS inter FROM g a, g b)
SELECT name_a, name_b, 1.0 - inter / (na + nb - inter) AS confidence FROM p WHERE inter > 0"""


def _names(spark, d):
    return table(spark, d, "part").select("p_name")


@register("fuzzy_exact", _GRAMS_SQL)
def q_fuzzy_exact(spark, d):
    return similarity_join(_names(spark, d), _names(spark, d), "p_name")


@register("fuzzy_exact_close", f"SELECT * FROM ({_GRAMS_SQL}) x WHERE confidence < 0.6")
def q_fuzzy_exact_close(spark, d):
    return similarity_join(_names(spark, d), _names(spark, d), "p_name", max_distance=0.6)


@register("top_matches", f"SELECT * FROM ({_GRAMS_SQL}) x ORDER BY confidence, name_a, name_b LIMIT 500")
def q_top_matches(spark, d):
    return closest_pairs(_names(spark, d), _names(spark, d), "p_name", n=500)


@register("top_matches_far", f"SELECT * FROM ({_GRAMS_SQL}) x ORDER BY confidence, name_a, name_b LIMIT 100000")
def q_top_matches_far(spark, d):
    """More than there are close pairs, so the bound has to fall to the end."""
    return closest_pairs(_names(spark, d), _names(spark, d), "p_name", n=100_000)


TABLES, SEED = 20, 7
_LSH_SQL = f"""
WITH n AS (SELECT DISTINCT p_name AS name FROM part WHERE length(p_name) >= 3),
g AS (SELECT name, list_distinct(list_transform(range(1, length(name) - 1), lambda i: substr(lower(name), i, 3))) AS grams FROM n),
t AS (SELECT * FROM (VALUES {', '.join(f'({i}, {a}::BIGINT, {b}::BIGINT)' for i, (a, b) in enumerate(_coefficients(TABLES, SEED)))}) v(no, a, b)),
h AS (SELECT name, no, list_min(list_transform(grams, lambda x: (('0x' || substr(md5(x), 1, 7))::BIGINT * a + b) % {PRIME})) AS hash
      FROM g, t),
p AS (SELECT DISTINCT x.name AS name_a, y.name AS name_b FROM h x JOIN h y ON x.no = y.no AND x.hash = y.hash),
v AS (SELECT name_a, name_b, len(a.grams) AS na, len(b.grams) AS nb, len(list_intersect(a.grams, b.grams)) AS inter
      FROM p JOIN g a ON a.name = name_a JOIN g b ON b.name = name_b)
SELECT name_a, name_b, 1.0 - inter / (na + nb - inter) AS confidence FROM v WHERE inter > 0"""


@register("fuzzy_lsh", _LSH_SQL)
def q_fuzzy_lsh(spark, d):
    return lsh_join(_names(spark, d), _names(spark, d), "p_name", num_hash_tables=TABLES, seed=SEED)
