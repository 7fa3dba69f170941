"""Importance resampling towards a target distribution of hashed word n-grams.

A feature is a run of one to ``most_words`` consecutive words joined by one
blank; its bucket is the CRC-32 of its bytes.  Every text is scanned once per
pass: the bytes of its words, one blank between them, run through one CRC
register, and the CRC of any n-gram comes from the running registers at its
two ends (``crc.py``), whatever its length and n.

The source's and the target's bucket counts have a fixed number of entries
(BUCKETS), are summed in the tasks and are all that reaches the driver.  A
text's weight is the floored mean of its features' gains; Gumbel noise that
depends only on the id turns the highest scores into a draw without
replacement.  The draw is cut by a histogram of whole-number scores (their
range is bounded by the gains, not by the rows), and only rows at or above the
cut are sorted, by ranges.

A null text counts as empty: no features, weight 0, never drawn (fewer than
``LEAST_WORDS`` words).  A null id hashes like the empty text and sorts before
others.  Rows that share an id share their noise; equal rows are told apart by
any order.  An empty table gives no rows; an empty target makes all gains
follow the source counts alone.  Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm import crc, scan
from stellate.llm.common import documents, empty_text, materialize
from stellate.operators.ids import assign_ids

BUCKETS = 10_000
MOST_WORDS = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"


def features(data: np.ndarray, offs: np.ndarray, most_words: int = MOST_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(CRC-32 of every n-gram, its text's number, number of words of each text)."""
    start, end, doc = scan.spans(data, offs, scan.NON_ALNUM)
    words = np.bincount(doc, minlength=len(offs) - 1)
    if not len(start):
        return np.zeros(0, np.uint32), doc, words
    keep = ~scan.NON_ALNUM[data]
    inner = start[1:][doc[1:] == doc[:-1]] - 1                  # one separator before each word but a text's first
    keep[inner] = True
    place = np.cumsum(keep) - keep                              # bytes kept before each byte
    shown = scan.LOWER[data]
    shown[inner] = 0x20
    first, last = place[start], place[end - 1] + 1
    ends = np.empty(2 * len(first), np.int64)
    ends[0::2], ends[1::2] = first, last
    running = crc.registers(shown[keep], ends)
    before, after = running[0::2], running[1::2]
    keys, owners = [], []
    for n in range(1, most_words + 1):
        at = np.flatnonzero(doc[n - 1:] == doc[:len(doc) - n + 1])
        if not len(at):
            break
        keys.append(crc.substring_crcs(before[at], after[at + n - 1], last[at + n - 1] - first[at]))
        owners.append(doc[at])
    return np.concatenate(keys), np.concatenate(owners), words


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, most_words: int = MOST_WORDS) -> np.ndarray:
    """How often each bucket's features occur in the ``text`` column: ``buckets`` numbers, summed by Spark."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for _, data, offs in scan.blocks(batches):
            key, _, _ = features(data, offs, most_words)
            total += np.bincount((key % np.uint32(buckets)).astype(np.int64), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    summed = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for bucket, n in summed.collect():                          # one row a bucket
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed target and source shares, floored."""
    n = len(source)
    top = (target + 1).astype(np.float64) * float(int(source.sum()) + n)
    low = (source + 1).astype(np.float64) * float(int(target.sum()) + n)
    return np.floor(1000 * np.log(top / low)).astype(np.int64)


def weigh(texts: DataFrame, gain: np.ndarray, most_words: int = MOST_WORDS) -> DataFrame:
    """doc_id, n_words, n_features, weight of every row: the floored mean gain of its features (none: 0)."""
    shared = texts.sparkSession.sparkContext.broadcast(gain)    # one number a bucket

    def run(batches):
        value = shared.value
        for part, data, offs in scan.blocks(batches):
            key, owner, words = features(data, offs, most_words)
            got = value[(key % np.uint32(len(value))).astype(np.int64)]
            n = np.bincount(owner, minlength=part.num_rows)
            total = np.zeros(part.num_rows, np.int64)
            np.add.at(total, owner, got)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(words), pa.array(n), pa.array(total // np.maximum(n, 1))],
                ["doc_id", "n_words", "n_features", "weight"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: str = SEED) -> Column:
    """Thousandths of Gumbel noise, floored; a function of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def draw(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored`` with ``rank`` 1, 2, 3 ... for the floor(percent / 100) highest scores of the long enough rows.

    Ties go to the smaller doc_id.  Scores are whole numbers of a bounded
    range, so their histogram finds the cut; only rows from the cut on are
    sorted.  Equal rows count as one until they have their ranks.
    """
    scored = materialize(scored, "scored")
    long_enough = scored.filter(F.col("n_words") >= least_words)
    held = long_enough.groupBy("score").agg(F.count("*").alias("n")).orderBy(F.desc("score")).collect()
    most = sum(r.n for r in held) * percent // 100
    taken, cut = 0, None
    for r in held:
        if taken >= most:
            break
        taken, cut = taken + r.n, r.score
    none = F.lit(None).cast("long").alias("rank")
    if cut is None:
        return scored.select("*", none)
    can = (F.col("n_words") >= least_words) & (F.col("score") >= cut)
    columns = scored.columns
    classes = scored.filter(can).groupBy(*columns).agg(F.count("*").alias("copies"))
    single = classes.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    ranked = assign_ids(single, [F.desc("score"), F.asc_nulls_first("doc_id"), "weight", "n_features", "n_words", "copy"], "rank")
    drawn = ranked.select(*columns, F.when(F.col("rank") <= most, F.col("rank")).alias("rank"))
    return scored.filter(~F.coalesce(can, F.lit(False))).select("*", none).unionByName(drawn)


def resample(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, most_words: int = MOST_WORDS,
             percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: str = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank for every row of ``docs``; ``target`` has a ``text`` column."""
    texts = documents(docs)
    gain = gains(bucket_counts(texts, buckets, most_words),
                 bucket_counts(target.select(empty_text(target["text"]).alias("text")), buckets, most_words))
    scored = weigh(texts, gain, most_words).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    return draw(scored, percent, least_words)


def oracle() -> str:
    """The same steps in DuckDB; CRCs by a byte table over the distinct words (runs of one word)."""
    crc_table = (f"list_transform(range(256), lambda i: list_reduce(list_prepend(i::BIGINT, range(8)), "
                 f"lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, {crc.POLYNOMIAL}::BIGINT) ELSE c >> 1 END))")
    words = ("unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'))")
    return f"""
WITH t AS MATERIALIZED (SELECT {crc_table} AS crc_of),
d AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS row_no, text FROM documents),
w AS MATERIALIZED (SELECT row_no, {words} AS word FROM d),
b AS MATERIALIZED (SELECT {words} AS word FROM benchmark),
v AS (SELECT DISTINCT word, hex(encode(word)) AS code FROM (SELECT word FROM w UNION SELECT word FROM b)),
k AS MATERIALIZED (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(code) // 2),
         lambda i: ('0x' || substr(code, 2 * i + 1, 2))::BIGINT)),
         lambda c, x: xor(c >> 8, crc_of[(xor(c, x) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket
      FROM v, t),
s AS (SELECT bucket, count(*) AS n FROM w JOIN k USING (word) GROUP BY bucket),
g AS (SELECT bucket, count(*) AS n FROM b JOIN k USING (word) GROUP BY bucket),
gain AS MATERIALIZED (SELECT s.bucket, CAST(floor(1000 * ln(
         (coalesce(g.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s) + {BUCKETS})::DOUBLE
         / ((s.n + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM g), 0) + {BUCKETS})::DOUBLE))) AS BIGINT) AS gain
         FROM s LEFT JOIN g USING (bucket)),
f AS (SELECT row_no, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
      FROM w JOIN k USING (word) JOIN gain USING (bucket) GROUP BY row_no),
h AS (SELECT doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
             ('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT AS h
      FROM d LEFT JOIN f USING (row_no)),
x AS (SELECT doc_id, n_features, weight,
             weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM h),
r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {LEAST_WORDS} ORDER BY score DESC, doc_id) AS place,
             count(*) FILTER (n_features >= {LEAST_WORDS}) OVER () * {PERCENT} // 100 AS most FROM x)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= {LEAST_WORDS} AND place <= most THEN place END::BIGINT AS rank FROM r"""
