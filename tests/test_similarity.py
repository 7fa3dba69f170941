import random

from conftest import rows
from stellate.operators.similarity import lsh_join, similarity_join, top_matches


def _brute(names_a, names_b, max_d):
    def grams(s):
        s = s.lower()
        return {s[i:i + 3] for i in range(len(s) - 2)} if len(s) >= 3 else set()
    out = []
    for a in set(x for x in names_a if x is not None):
        for b in set(x for x in names_b if x is not None):
            ga, gb = grams(a), grams(b)
            if not ga or not gb:
                continue
            inter = len(ga & gb)
            if inter == 0:
                continue
            d = 1.0 - inter / (len(ga) + len(gb) - inter)
            if d < max_d:
                out.append((a, b, round(d, 9)))
    return sorted(out)


def test_exact_join_edge_names(spark):
    names = ["St Mary", "st mary", "ST MARY COLLEGE", "ab", "", None, "Marist"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = sorted((a, b, round(c, 9)) for a, b, c in rows(similarity_join(df, df, "n")))
    assert got == _brute(names, names, 1.0)
    assert ("St Mary", "st mary", 0.0) in got              # differs only in case


def test_prefix_filter_is_exact(spark):
    rnd = random.Random(11)
    words = ["saint", "mary", "college", "primary", "high", "north", "west", "school", "campus"]
    names = [" ".join(rnd.sample(words, rnd.randint(1, 3))) for _ in range(120)]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    for d in (0.3, 0.5, 0.8, 1.0):
        got = sorted((a, b, round(c, 9)) for a, b, c in rows(similarity_join(df, df, "n", max_distance=d)))
        assert got == _brute(names, names, d), d


def test_top_matches_and_lsh(spark):
    names = [f"name {i:03d}" for i in range(40)]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    top = top_matches(similarity_join(df, df, "n"), 10).collect()
    assert len(top) == 10 and all(r["confidence"] == 0.0 for r in top)
    approx = lsh_join(df, df, "n", num_hash_tables=10).collect()
    assert all(0.0 <= r["confidence"] < 1.0 for r in approx)
    assert len(approx) <= len(_brute(names, names, 1.0))


def test_closest_pairs_equals_full_top_k(spark):
    from stellate.operators.similarity import closest_pairs
    rnd = random.Random(4)
    words = ["saint", "mary", "college", "primary", "high", "north", "west"]
    names = [" ".join(rnd.sample(words, rnd.randint(1, 3))) for _ in range(80)]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    for k in (5, 40, 400):
        want = [tuple(r) for r in top_matches(similarity_join(df, df, "n"), k).collect()]
        got = [tuple(r) for r in closest_pairs(df, df, "n", n=k).collect()]
        assert sorted(got) == sorted(want), k


def test_short_names_reported(spark):
    from stellate.operators.similarity import short_names
    df = spark.createDataFrame([("ab",), ("",), (None,), ("abc",)], "n string")
    assert short_names(df, "n") == 2


def test_closest_pairs_ends_by_proof(spark):
    """Fewer pairs than asked for, and a gram that nearly all names share: found exactly, with few candidates before."""
    from stellate.operators.similarity import closest_pairs
    rnd = random.Random(8)
    letters = "bcdfghjklmnpqrstvwxz"
    names = ["the " + "".join(rnd.choice(letters) for _ in range(20)) for _ in range(150)]
    names += [n[:-1] + "!" for n in names[:20]] + ["qqq", "zzz", "ab"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    want = _brute(names, names, 1.0)
    for k in (30, len(want), 10 ** 6):
        got = sorted((r.name_a, r.name_b, round(r.confidence, 9)) for r in closest_pairs(df, df, "n", n=k).collect())
        best = sorted(want, key=lambda r: (r[2], r[0], r[1]))[:k]
        assert got == sorted(best), k
    # the 192 identical and edited pairs are found without pairing all names that share "the"
    close = similarity_join(df, df, "n", max_distance=0.2).count()
    assert 192 <= close < len(want) / 20


def test_lsh_recall_and_hot_buckets(spark):
    rnd = random.Random(3)
    words = ["saint", "mary", "college", "primary", "high", "north", "west", "school", "campus"]
    names = sorted({" ".join(rnd.sample(words, rnd.randint(2, 4))) for _ in range(150)})
    df = spark.createDataFrame([(n,) for n in names], "n string")
    exact = {r[:2]: r[2] for r in _brute(names, names, 0.5)}
    one = {(r.name_a, r.name_b): round(r.confidence, 9) for r in lsh_join(df, df, "n", max_distance=0.5).collect()}
    assert all(exact[p] == d for p, d in one.items())            # nothing that the exact join lacks
    assert len(one) >= 0.9 * len(exact)
    split = {(r.name_a, r.name_b): round(r.confidence, 9) for r in lsh_join(df, df, "n", max_distance=0.5, chunk=2).collect()}
    assert split == one
