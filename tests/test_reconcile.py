import random

from conftest import rows
from stellate.operators.reconcile import reconcile

LEFT = [
    (1, "Alpha School", 2000),
    (2, "Beta School", 2001),          # matched only after campus strip
    (3, "Gamma School", 2002),         # two campuses strip to it
    (4, "Delta School", 2003),         # right side has leading quote + two ' - '
    (5, "Eps School", 2004),           # no right counterpart at all
    (6, "Zeta School", None),          # null postcode on the left
    (7, None, 2006),                   # null name
    (8, "Eta School", 2007),           # two left ids with one key
    (9, "Eta School", 2007),
]
RIGHT = [
    ("Alpha School", 2000, "boys"),                 # exact match
    ("Beta School - Junior", 2001, "girls"),
    ("Gamma School - North", 2002, "coed-n"),
    ("Gamma School - South", 2002, "coed-s"),
    ('"Delta School - East - Upper', 2003, "east"),
    ("Omega-School", 2009, "hyphen"),               # hyphen without spaces: discarded
    ("Zeta School", None, "nullpc"),                # null postcode on the right
    ("Eta School", 2007, "eta"),
    ("Theta School", 2010, "nomatch"),              # right name without ' - ': discarded
]


def _frames(spark):
    l = spark.createDataFrame(LEFT, "school_id int, school_name string, postcode int")
    r = spark.createDataFrame(RIGHT, "school_name string, postcode int, gender string")
    return l, r


def test_reconcile_edge_rows(spark):
    l, r = _frames(spark)
    out = reconcile(l, r, id_col="profile_id")
    got = {(x["school_name"], x["postcode"]): (x["school_id"], x["gender"]) for x in out.collect()}
    assert got[("Alpha School", 2000)] == (1, "boys")
    assert got[("Beta School", 2001)] == (2, "girls")
    assert got[("Gamma School", 2002)] == (3, "coed-n")       # smallest campus row wins
    assert got[("Delta School", 2003)] == (4, "east")
    assert got[("Eps School", 2004)] == (5, None)
    assert got[("Zeta School", None)] == (6, None)             # null keys never match
    assert got[(None, 2006)] == (7, None)
    assert got[("Eta School", 2007)] == (8, "eta")             # two left ids collapse to the smallest
    assert len(got) == 8
    ids = sorted(x["profile_id"] for x in out.collect())
    assert ids == list(range(1, 9))
    assert out.columns[0] == "profile_id"


def test_reconcile_each_left_key_once_and_order_free(spark):
    rnd = random.Random(3)
    names = [f"S{i}" for i in range(30)]
    left = [(i, rnd.choice(names), rnd.randint(0, 4)) for i in range(200)]
    right = [((rnd.choice(names) + (" - C" if rnd.random() < 0.3 else "")), rnd.randint(0, 4), f"g{j}")
             for j in range(250)]
    l = spark.createDataFrame(left, "school_id int, school_name string, postcode int")
    r = spark.createDataFrame(right, "school_name string, postcode int, gender string")
    a = reconcile(l, r)
    keys = [(x["school_name"], x["postcode"]) for x in a.collect()]
    assert len(keys) == len(set(keys)) == len({(n, p) for _, n, p in left})
    rnd.shuffle(left)
    rnd.shuffle(right)
    b = reconcile(spark.createDataFrame(left, l.schema).repartition(7),
                  spark.createDataFrame(right, r.schema).repartition(3))
    assert rows(a) == rows(b)
