"""Reconcile against a literal pure-Python rendering of its semantics."""

import random
import re

from stellate.operators.reconcile import reconcile

CAMPUS = re.compile(r'^"?(.+?)\s+-\s+')


def _key(v):
    return (v is None, v)                      # ascending, nulls last


def _like_campus(name):
    return name is not None and re.search(r" - ", name) is not None


def brute(left, right):
    """left rows (school_id, name, pc); right rows (name, pc, g). Join keys (name, pc)."""
    def eq(a, b):
        return a[0] is not None and a[1] is not None and a == b
    # pass 1: inner join, then one row per key (smallest by school_id, g)
    inner = {}
    for sid, n, p in left:
        for rn, rp, g in right:
            if eq((n, p), (rn, rp)):
                k = (n, p)
                cand = (sid, g)
                if k not in inner or (_key(cand[0]), _key(cand[1])) < (_key(inner[k][0]), _key(inner[k][1])):
                    inner[k] = cand
    lkeys = {(n, p) for _, n, p in left}
    rkeys = {(n, p) for n, p, _ in right}
    left_only = [(sid, n, p) for sid, n, p in left if not any(eq((n, p), k) for k in rkeys)]
    right_only = [(n, p, g) for n, p, g in right if not any(eq((n, p), k) for k in lkeys)]
    stripped = []
    for n, p, g in right_only:
        if _like_campus(n):
            m = CAMPUS.search(n)
            stripped.append(((m.group(1) if m else "").strip(), p, g))
    anti = {}
    for sid, n, p in left_only:
        matches = [g for sn, sp, g in stripped if eq((n, p), (sn, sp))] or [None]
        for g in matches:
            k = (n, p)
            cand = (sid, g)
            if k not in anti or (_key(cand[0]), _key(cand[1])) < (_key(anti[k][0]), _key(anti[k][1])):
                anti[k] = cand
    out = {**anti, **inner}
    return sorted(((k[0], k[1], v[0], v[1]) for k, v in out.items()), key=lambda t: tuple(map(_key, t)))


def _rand_case(rnd):
    names = ["A", "B", "C", "A B", None]
    left = [(rnd.choice([1, 2, 3, 4, 5, 6, None]), rnd.choice(names), rnd.choice([1, 2, None]))
            for _ in range(rnd.randint(1, 8))]
    right = []
    for _ in range(rnd.randint(0, 8)):
        base = rnd.choice(names)
        style = rnd.random()
        if base is not None and style < 0.3:
            base = f"{base} - Campus {rnd.randint(1, 2)}"
        elif base is not None and style < 0.4:
            base = f'"{base} - X - Y'
        elif base is not None and style < 0.5:
            base = f"{base}-Z"
        right.append((base, rnd.choice([1, 2, None]), rnd.choice(["g1", "g2", None])))
    return left, right


def test_reconcile_matches_bruteforce(spark):
    rnd = random.Random(2024)
    for _ in range(12):
        left, right = _rand_case(rnd)
        l = spark.createDataFrame(left, "school_id int, school_name string, postcode int")
        r = spark.createDataFrame(right, "school_name string, postcode int, g string")
        got = sorted(((x["school_name"], x["postcode"], x["school_id"], x["g"])
                      for x in reconcile(l, r, id_col=None).collect()), key=lambda t: tuple(map(_key, t)))
        assert got == brute(left, right), (left, right)
