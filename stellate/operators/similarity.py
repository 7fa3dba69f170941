"""Name matching on character trigrams.

Names are lower-cased and cut into overlapping 3-character grams (the set
of grams, as a hashing-TF + MinHash pipeline sees it).  Distance is the
Jaccard distance ``1 - |A∩B| / |A∪B|``; a pair is returned when its
distance is strictly below ``max_distance``.

``similarity_join`` is exact.  For ``max_distance < 1`` it uses prefix
filtering: grams are ranked by global frequency (rarest first), and two
sets with Jaccard similarity above ``t`` must share one of the first
``n - ceil(t*n) + 1`` grams of either set, so only those are joined.  Hot
grams rank last and drop out of the prefixes.  Candidates are then
verified with their full gram sets.  With ``max_distance = 1`` every pair
sharing a gram is a result, and the gram join *is* the result.

``closest_pairs`` is the top-k report; it lowers a similarity bound step by
step and ends by proof, see there.

``lsh_join`` is the approximate join: MinHash with one hash a table, pairs
that agree in any table, verified with their gram sets.  Its hashes are plain
arithmetic on MD5, so any engine can repeat them.  Buckets that many names
fall into are dealt out in chunks.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stellate.session import materialize

GRAM = 3


def trigrams(name) -> Column:
    """Distinct lower-cased character trigrams of a string (empty below 3 chars)."""
    s = F.lower(F.col(name) if isinstance(name, str) else name)
    n = F.length(s)
    grams = F.transform(F.sequence(F.lit(1), F.greatest(n - GRAM + 1, F.lit(1))),
                        lambda i: F.substring(s, i, GRAM))
    return F.when(n >= GRAM, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def _gram_sets(df: DataFrame, col: str, alias: str) -> DataFrame:
    names = df.select(F.col(col).alias(alias)).where(F.col(alias).isNotNull()).distinct()
    return names.select(alias, trigrams(alias).alias("grams")).select(
        alias, "grams", F.size("grams").alias(f"n_{alias}")).where(F.col(f"n_{alias}") > 0)


def similarity_join(a: DataFrame, b: DataFrame, col_a: str, col_b: str | None = None,
                    max_distance: float = 1.0) -> DataFrame:
    """Exact trigram Jaccard join of distinct names: (name_a, name_b, confidence)."""
    col_b = col_b or col_a
    ga = _gram_sets(a, col_a, "name_a")
    gb = _gram_sets(b, col_b, "name_b")
    ea = ga.select("name_a", "n_name_a", F.explode("grams").alias("gram"))
    eb = gb.select("name_b", "n_name_b", F.explode("grams").alias("gram"))

    if max_distance < 1.0:
        t = 1.0 - max_distance
        freq = (ea.select("gram").unionAll(eb.select("gram")).groupBy("gram")
                  .agg(F.count(F.lit(1)).alias("df")))

        def prefix(e, name, n):
            w = Window.partitionBy(name).orderBy("df", "gram")
            keep = F.col(n) - F.ceil(F.col(n) * F.lit(t) - F.lit(1e-9)) + 1
            return (e.join(freq, "gram").withColumn("rk", F.row_number().over(w))
                     .where(F.col("rk") <= keep).select(name, "gram"))

        cand = (prefix(ea, "name_a", "n_name_a").join(prefix(eb, "name_b", "n_name_b"), "gram")
                .select("name_a", "name_b").distinct())
        ea = cand.join(ea, "name_a")
        shared = ea.join(eb, ["name_b", "gram"])
    else:
        shared = ea.join(eb, "gram")

    inter = shared.groupBy("name_a", "name_b", "n_name_a", "n_name_b").agg(
        F.count(F.lit(1)).alias("inter"))
    dist = F.lit(1.0) - F.col("inter") / (F.col("n_name_a") + F.col("n_name_b") - F.col("inter"))
    return (inter.select("name_a", "name_b", dist.alias("confidence"))
                 .where(F.col("confidence") < F.lit(max_distance)))


def top_matches(pairs: DataFrame, n: int = 500) -> DataFrame:
    """The ``n`` closest pairs, ties broken by the names (a top-k, not a sample)."""
    return pairs.orderBy("confidence", "name_a", "name_b").limit(n)


def closest_pairs(a: DataFrame, b: DataFrame, col_a: str, col_b: str | None = None, n: int = 500,
                  first: float = 0.8, factor: float = 0.5) -> DataFrame:
    """Exact top-``n`` pairs without enumerating every pair that shares a gram.

    For a falling similarity bound ``t`` the prefix-filtered join returns every
    pair at ``t`` or above (prefixes reach further into the frequent grams the
    lower ``t`` is); as soon as there are at least ``n``, the ``n`` best (total
    order: distance, then names) are among them.  Two sets that share a gram
    have at least 1 / (largest + largest - 1): once ``t`` is no more than that,
    no pair is left, so fewer than ``n`` exist and all have been found.  Each
    step's pairs are written once; only counts and sizes reach the driver.
    """
    col_b = col_b or col_a
    largest = [s.agg(F.max("n")).first()[0] or 0 for s in (
        df.select(F.size(trigrams(c)).alias("n")) for df, c in ((a, col_a), (b, col_b)))]
    least = 1.0 / max(sum(largest) - 1, 1)
    t = first
    while True:
        # a distance strictly below 1 - t + step holds every pair at t
        close = materialize(similarity_join(a, b, col_a, col_b, max_distance=min(1.0 - max(t, least) + 1e-9, 1.0 - 1e-9)), "close")
        if t <= least or close.count() >= n:
            return top_matches(close, n)
        t *= factor


# ---- MinHash ---------------------------------------------------------------------------------

PRIME = (1 << 31) - 1
CHUNK = 1000


def _coefficients(tables: int, seed: int) -> list[tuple[int, int]]:
    """(a, b) of each table's hash (a * x + b) mod PRIME."""
    rnd = random.Random(seed)
    return [(rnd.randrange(1, PRIME), rnd.randrange(PRIME)) for _ in range(tables)]


def minhashes(grams: Column, tables: int, seed: int) -> Column:
    """The least hash of a gram set in each table, as an array."""
    x = F.transform(grams, lambda g: F.conv(F.substring(F.md5(g.cast("binary")), 1, 7), 16, 10).cast("long"))

    def least(a: int, b: int) -> Column:
        return F.array_min(F.transform(x, lambda v: (v * F.lit(a).cast("long") + F.lit(b)) % F.lit(PRIME).cast("long")))

    return F.array(*[least(a, b) for a, b in _coefficients(tables, seed)])


def lsh_join(a: DataFrame, b: DataFrame, col_a: str, col_b: str | None = None, max_distance: float = 1.0,
             num_hash_tables: int = 20, seed: int = 7, chunk: int = CHUNK) -> DataFrame:
    """Pairs that agree in a MinHash table and are closer than ``max_distance``: (name_a, name_b, confidence).

    Names under 3 characters have no grams and match nothing.  The names of
    ``b`` in a bucket are dealt out in chunks of about ``chunk``, and those of
    ``a`` go to every chunk, so a bucket of m x n names is n / chunk tasks'
    work.  A pair that shares several tables is verified once.
    """
    ga, gb = _gram_sets(a, col_a, "name_a"), _gram_sets(b, col_b or col_a, "name_b")
    ha, hb = (g.select(g.columns[0], F.posexplode(minhashes(F.col("grams"), num_hash_tables, seed)).alias("table", "hash"))
              for g in (ga, gb))
    dealt = hb.groupBy("table", "hash").agg(F.ceil(F.count("*") / chunk).cast("int").alias("chunks"))
    ha = ha.join(dealt, ["table", "hash"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    hb = hb.join(dealt, ["table", "hash"]).withColumn("chunk", F.pmod(F.xxhash64("name_b"), F.col("chunks")).cast("int"))
    pairs = ha.join(hb, ["table", "hash", "chunk"]).select("name_a", "name_b").distinct()
    both = pairs.join(ga, "name_a").join(gb.withColumnRenamed("grams", "grams_b"), "name_b")
    shared = F.size(F.array_intersect("grams", "grams_b"))
    dist = F.lit(1.0) - shared / (F.col("n_name_a") + F.col("n_name_b") - shared)
    return both.select("name_a", "name_b", dist.alias("confidence")).where(F.col("confidence") < F.lit(max_distance))


def short_names(df: DataFrame, col: str) -> int:
    """How many non-null names are too short for trigrams (``lsh_join`` skips them)."""
    return df.agg(F.count(F.when(F.length(col) < GRAM, 1)).alias("n")).first()["n"]
