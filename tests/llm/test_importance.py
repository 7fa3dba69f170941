"""Importance resampling against brute force, and running CRCs against zlib."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from stellate.llm import crc, importance

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, score double, rank string, bucket int, n_words string, place int, copies long"


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def bucket_list(text, most, buckets):
    words = words_of(text)
    return [zlib.crc32(" ".join(words[i:i + n]).encode()) % buckets
            for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, most, buckets, percent, least):
    source, aim = [0] * buckets, [0] * buckets
    for _, t in rows:
        for b in bucket_list(t, most, buckets):
            source[b] += 1
    for t in target:
        for b in bucket_list(t, most, buckets):
            aim[b] += 1
    s_all, t_all = sum(source), sum(aim)
    gain = [math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))))
            for s, t in zip(source, aim)]
    out = []
    for i, t in rows:
        found = bucket_list(t, most, buckets)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(words_of(t)), len(found), weight, score))
    can = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    drawn = [r + (k + 1,) for k, r in enumerate(can[:len(can) * percent // 100])]
    left = list(out)
    for r in drawn:
        left.remove(r[:5])
    return sorted(map(str, drawn + [r + (None,) for r in left]))


def rows():
    rnd = random.Random(3)
    pool = ["w%d" % i for i in range(60)] + ["Ünï", "日本", "A9z", "the"] * 4
    texts = [" ".join(rnd.choice(pool) + rnd.choice(["", ",", "\n", " -- ", " "]) for _ in range(rnd.randint(0, 60)))
             for _ in range(150)]
    texts += [None, "", " .,;\n", "x" * 70_000 + " tail", "word " * 300_000, "a-b\tc\x00d", "\x7fq\x01"] + [texts[0]] * 4
    out = [(k, t) for k, t in enumerate(texts)]
    return out + [(None, texts[3]), (None, texts[3]), (7, texts[8]), (7, texts[8])] + [(5000, texts[9] + " more" * 20)] * 40


@pytest.mark.parametrize("most,buckets,percent", [(1, 10_000, 10), (3, 97, 35)])
def test_against_brute_force(spark, most, buckets, percent):
    target = ["the w1 w2 A9z", None, "", "日本 w3 the the"]
    docs = spark.createDataFrame([(i, t, 0.5, "r", 1, "n", 3, 4) for i, t in rows()], SCHEMA).repartition(5)
    aim = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = importance.resample(docs, aim, buckets, most, percent).select("doc_id", "n_words", "n_features", "weight", "score", "rank")
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(rows(), target, most, buckets, percent, 20)
    assert [f.dataType.simpleString() for f in got.schema][1:] == ["bigint"] * 5


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    aim = spark.createDataFrame([], "item_id long, text string")
    assert importance.resample(docs, aim).count() == 0
    some = spark.createDataFrame([(1, "a b " * 20), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in importance.resample(some, aim, percent=100).collect()}
    assert got[1].rank == 1 and got[2].rank is None and got[2].weight == 0


def test_running_registers_give_any_substring():
    rnd = np.random.default_rng(1)
    for n in (0, 1, 255, 256, 257, 3000, crc.SEGMENT + 70_000):
        data = rnd.integers(0, 256, n).astype(np.uint8)
        places = np.sort(rnd.integers(0, n + 1, 40))
        running = crc.registers(data, places)
        for i, j in [(0, 39)] + [(k, k + 1) for k in range(39)]:
            s, e = places[i], places[j]
            got = crc.substring_crcs(running[[i]], running[[j]], np.array([e - s]))[0]
            assert got == zlib.crc32(data[s:e].tobytes())
