"""Quality by cross-document line frequency.

Every line is normalised (lower case, white space squeezed, digits made
alike) and hashed; a line that more than ``MAX_DOCUMENTS`` documents of one
host hold counts as boilerplate there and is removed.  A document of which
less than ``LEAST_LEFT`` of the words remain is depleted and rejected.

Lines are counted on (host, line, document) first and then on (host, line),
both map-side summed, so neither a host nor a line ends up in one task.
Null text counts as empty; rows without host share the null host; rows with
the same id are one document when lines are counted; an empty table gives no
rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm import scan
from stellate.llm.common import column_type, empty_text, materialize, row_ids

MAX_DOCUMENTS = 20
LEAST_LEFT = 0.5
LEAST_WORDS = 50
WINDOW = 3

SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
LINE_FEED = np.zeros(256, bool)
LINE_FEED[10] = True
ALIKE = scan.LOWER.copy()
ALIKE[48:58] = 48


def _repeated(key: np.ndarray, owner: np.ndarray, first_too: bool) -> np.ndarray:
    """Which entries equal another of the same owner (an earlier one, unless ``first_too``)."""
    order = np.lexsort((key, owner))
    same = (key[order][1:] == key[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    hit = np.concatenate([[False], same])[:len(order)]
    if first_too:
        hit = hit | np.concatenate([same, [False]])[:len(order)]
    out = np.zeros(len(key), bool)
    out[order] = hit
    return out


def measures(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """Per text: the base measures and, as flat lists, its distinct normalised lines with their words."""
    n = len(offs) - 1
    start, end, doc = scan.spans(data, offs)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    key, at = scan.windows(scan.hashes(data, start, end), doc, WINDOW)
    hit = at[_repeated(key, doc[at], True)]
    covered = np.zeros(len(start), bool)
    for k in range(WINDOW):
        covered[hit + k] = True

    l_start, l_end, l_doc = scan.spans(data, offs, LINE_FEED)
    first = np.searchsorted(start, l_start)
    words = np.searchsorted(start, l_end) - first
    real = words > 0
    l_start, l_end, l_doc, first, words = (x[real] for x in (l_start, l_end, l_doc, first, words))
    twice = _repeated(scan.hashes(data, l_start, l_end), l_doc, False)
    normal = scan.hashes(data, start, end, ALIKE)
    power, inverse = scan._powers(max(len(normal), 1) + 1)
    sums = np.zeros(len(normal) + 1, np.uint64)
    np.cumsum(normal * power[:len(normal)], out=sums[1:])
    line = scan.mix64((sums[first + words] - sums[first]) * inverse[first] + words.astype(np.uint64))

    order = np.lexsort((line, l_doc))
    line, owner, words = line[order], l_doc[order], words[order]
    new = np.ones(len(line), bool)
    new[1:] = (line[1:] != line[:-1]) | (owner[1:] != owner[:-1])
    begin = np.flatnonzero(new)

    def count(which, weights=None):
        return np.bincount(which, weights=weights, minlength=n).astype(np.int64)

    symbols = np.concatenate([[0], np.cumsum(SYMBOL[data])])
    return {"n_words": count(doc), "word_chars": count(doc, points[end] - points[start]),
            "n_symbols": symbols[offs[1:]] - symbols[offs[:-1]], "n_dup_lines": count(l_doc, twice),
            "n_repeat_words": count(doc, covered), "line": line[begin],
            "line_words": np.add.reduceat(words, begin) if len(begin) else words,
            "bounds": np.searchsorted(owner[begin], np.arange(n + 1))}


NUMBERS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, host: str, max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """doc_id, the base measures, base_failed, n_removed_words and kept of every row."""
    def run(batches):
        rows = row_ids()
        for part, data, offs in scan.blocks(batches):
            m = measures(data, offs)
            bounds = pa.array(m["bounds"].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows.take(part.num_rows), pa.int64()), part.column("doc_id"), part.column("host"),
                 *[pa.array(m[k]) for k in NUMBERS],
                 pa.ListArray.from_arrays(bounds, pa.array(scan.signed(m["line"]))),
                 pa.ListArray.from_arrays(bounds, pa.array(m["line_words"].astype(np.int64)))],
                ["row", "doc_id", "host", *NUMBERS, "line", "line_words"])

    numbers = ", ".join(f"{k} long" for k in NUMBERS)
    measured = materialize(
        docs.select("doc_id", F.col(host).alias("host"), empty_text(docs["text"]).alias("text")).mapInArrow(
            run, f"row long, doc_id {column_type(docs, 'doc_id')}, host {column_type(docs, host)}, {numbers}, "
                 "line array<long>, line_words array<long>"), "lines")
    lines = measured.select("row", "doc_id", F.xxhash64("host").alias("host"),
                            F.explode(F.arrays_zip("line", "line_words")).alias("x")).select(
        "row", "doc_id", "host", F.col("x.line").alias("line"), F.col("x.line_words").alias("words"))
    common = (lines.groupBy("host", "line", "doc_id").agg(F.lit(1).alias("one"))
              .groupBy("host", "line").agg(F.count("*").alias("documents"))
              .filter(F.col("documents") > max_documents).select("host", "line"))
    removed = (lines.join(materialize(common, "common"), ["host", "line"])
               .groupBy("row").agg(F.sum("words").alias("n_removed_words")))
    gone = F.coalesce(F.col("n_removed_words"), F.lit(0)).cast("long")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.col("n_words") - gone >= LEAST_LEFT * F.col("n_words")
    return measured.join(removed, "row", "left").select(
        "doc_id", *NUMBERS, failed.alias("base_failed"), gone.alias("n_removed_words"), (~failed & left).alias("kept"))
