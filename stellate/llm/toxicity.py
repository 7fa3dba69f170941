"""Toxicity by multiple-instance learning: sentence scores combined by noisy-or.

A sentence's probability is a logistic function of its hashed features; a text is
toxic unless every sentence is clean, 1 - prod(1 - p_s).  A sentence's
features are its words and their beginnings.  Weights are learnt
from labels of whole texts by gradient descent on the likelihood of that
noisy-or, with a learnt share of labels that no sentence explains.  The same
weights point at the offending sentences.  Only words that texts labelled
toxic hold more often than chance (``EVIDENCE`` standard deviations) get one.

Fitting takes about ``POSITIVES`` and ``NEGATIVES`` labelled texts of at most
``LONGEST`` characters, chosen by a hash of their id and weighted back to the
numbers of all labelled rows; scoring reads every text whole.

Null text counts as empty; a text without words scores 0.  A null label is no
label; where an id has several labels the largest holds.  Rows with null or
repeated ids are scored like any other.  Without labelled texts of both
classes every score is near 0.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm import scan
from stellate.llm.common import empty_text

FEATURE_BITS = 20
PREFIXES = (4, 5, 6, 7, 8)
POSITIVES, NEGATIVES = 2500, 3000
LONGEST = 10_000
LEAST_TEXTS = 4
EVIDENCE = 4.0
STEPS, RATE, SHRINK = 120, 0.5, 1e-5
THRESHOLD = 0.7
OFFENDING = 0.5

BREAK = np.zeros(256, bool)
BREAK[[0x0A, 0x21, 0x2E, 0x3F]] = True


class Sentences:
    """Features of a block's words, the sentence of each feature and the text of each sentence.

    A word's features are its hash and the hashes of its first bytes, if it is longer.
    """

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.start, self.end, doc = scan.spans(data, offs, scan.NON_ALNUM)
        data, breaks_at = scan.fold(data), BREAK[data]
        word = scan.hashes(data, self.start, self.end)
        breaks = np.cumsum(breaks_at, dtype=np.int64)[self.start] if len(data) else self.start
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (breaks[1:] != breaks[:-1])
        sentence = np.cumsum(new) - 1
        parts = scan.prefix_hashes(data, self.start, self.end, PREFIXES)
        self.feature = (np.concatenate([word, *(h for _, h in parts)]) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
        self.sentence = np.concatenate([sentence, *(sentence[at] for at, _ in parts)])
        self.first = np.flatnonzero(new)
        self.doc = doc[new]


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def fit(feature: np.ndarray, sentence: np.ndarray, doc: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights by feature, the bias last, from words, their sentences, the sentences' texts, and the texts' labels."""
    size = 1 << FEATURE_BITS
    w, bias, stray = np.zeros(size), -6.0, -3.0
    if not len(feature) or label.min(initial=1) == label.max(initial=0):
        return np.append(w, bias)
    pair = np.unique(doc[sentence] * size + feature)
    held = np.bincount(pair % size, minlength=size)
    toxic_held = np.bincount(pair % size, weights=label[pair // size], minlength=size)
    share = label.mean()
    expected = held * share
    marked = (held >= LEAST_TEXTS) & (toxic_held - expected >= EVIDENCE * np.sqrt(expected * (1 - share) + 1e-9))
    keep = marked[feature]
    feature, sentence = feature[keep], sentence[keep]
    n, texts, total = len(doc), len(label), weight.sum()
    square, square_bias, square_stray = np.full(size, 1e-8), 1e-8, 1e-8
    for _ in range(STEPS):
        z = bias + np.bincount(sentence, weights=w[feature], minlength=n)
        p = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))
        clean = np.exp(-np.bincount(doc, weights=_softplus(z), minlength=texts))
        noise = 1.0 / (1.0 + np.exp(-stray))
        toxic = np.maximum(1.0 - (1.0 - noise) * clean, 1e-9)
        # derivative of the negative log-likelihood by the sum of softplus(z) of a text
        slope = weight * np.where(label == 1, -(1.0 - toxic) / toxic, 1.0)
        by_sentence = slope[doc] * p
        grad = np.bincount(feature, weights=by_sentence[sentence], minlength=size) / total + SHRINK * w
        grad_bias = by_sentence.sum() / total
        grad_stray = (weight * np.where(label == 1, -clean * noise * (1 - noise) / toxic, noise)).sum() / total
        square += grad * grad
        square_bias += grad_bias * grad_bias
        square_stray += grad_stray * grad_stray
        w -= RATE * grad / np.sqrt(square)
        bias -= RATE * grad_bias / np.sqrt(square_bias)
        stray -= RATE * grad_stray / np.sqrt(square_stray)
    return np.append(w, bias)


def train(docs: DataFrame, labels: DataFrame, usable: Column) -> np.ndarray:
    """Weights from ``labels`` (doc_id, label 0 or 1) of the texts for which ``usable`` (on doc_id) holds."""
    labels = (labels.select("doc_id", F.col("label").cast("int").alias("label"))
              .filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & usable)
              .groupBy("doc_id").agg(F.max("label").alias("label")))
    count = {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = {1: POSITIVES / max(count.get(1, 0), 1), 0: NEGATIVES / max(count.get(0, 0), 1)}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    chosen = labels.filter(draw < F.when(F.col("label") == 1, F.lit(share[1])).otherwise(F.lit(share[0])))
    sample = (docs.select("doc_id", empty_text(docs["text"]).alias("text")).filter(F.length("text") <= LONGEST)
              .join(F.broadcast(chosen), "doc_id").select("label", "text"))     # 5,500 rows or so

    def run(batches):
        for part, data, offs in scan.blocks(batches):
            s = Sentences(data, offs)
            order = np.argsort(s.sentence, kind="stable")
            words = np.bincount(s.sentence, minlength=len(s.doc))
            at = np.searchsorted(s.doc, np.arange(part.num_rows + 1))
            bounds = np.append(0, np.cumsum(words))[at]
            yield pa.RecordBatch.from_arrays(
                [part.column("label"),
                 pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(s.feature[order].astype(np.int32))),
                 pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(words.astype(np.int32)))],
                ["label", "features", "words"])

    got = sample.mapInArrow(run, "label int, features array<int>, words array<int>").toArrow().combine_chunks()
    if not got.num_rows:
        return np.append(np.zeros(1 << FEATURE_BITS), -6.0)

    def lists(name: str) -> tuple[np.ndarray, np.ndarray]:
        column = got.column(name).combine_chunks()
        return column.flatten().to_numpy().astype(np.int64), np.diff(column.offsets.to_numpy())

    feature, _ = lists("features")
    words, sentences = lists("words")
    label = got.column("label").to_numpy()
    weight = np.where(label == 1, max(1.0, 1 / share[1]), max(1.0, 1 / share[0]))
    return fit(feature, np.repeat(np.arange(len(words)), words),
               np.repeat(np.arange(len(label)), sentences), label, weight)


def score(docs: DataFrame, model: np.ndarray, keep: list[str]) -> DataFrame:
    """``keep`` columns of every row, then score, n_offending and the worst sentence (code point span, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model.astype(np.float32))
    made = ["score double", "n_offending long", "worst_start long", "worst_end long", "worst_score double"]
    inner = docs.select(*[F.col(c).alias(f"in{i}") for i, c in enumerate(keep)], empty_text(docs["text"]).alias("text"))
    kinds = [f"in{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]

    def run(batches):
        w = shared.value
        for part, data, offs in scan.blocks(batches):
            s = Sentences(data, offs)
            n = part.num_rows
            z = float(w[-1]) + np.bincount(s.sentence, weights=w[s.feature], minlength=len(s.doc))
            whole = -np.expm1(-np.bincount(s.doc, weights=_softplus(z), minlength=n))
            p = 1.0 / (1.0 + np.exp(-z))
            offending = np.bincount(s.doc[p >= OFFENDING], minlength=n)
            # the worst sentence of a text: last after sorting by (text, score, earliest first)
            order = np.lexsort((-np.arange(len(z)), z, s.doc))
            last = np.searchsorted(s.doc, np.arange(n), "right") - 1
            has = np.bincount(s.doc, minlength=n) > 0
            worst = order[last[has]] if len(order) else np.zeros(0, np.int64)
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            stop = np.append(s.first[1:], len(s.start)) - 1     # last word of each sentence
            base = points[offs[:-1]][has]

            def spread(values, kind):
                out = np.zeros(n, kind)
                out[has] = values
                return pa.array(out, mask=~has)

            yield pa.RecordBatch.from_arrays(
                [*part.columns[:len(keep)], pa.array(whole), pa.array(offending.astype(np.int64)),
                 spread(points[s.start[s.first[worst]]] - base, np.int64),
                 spread(points[s.end[stop[worst]]] - base, np.int64), spread(p[worst], np.float64)],
                [f"in{i}" for i in range(len(keep))] + [m.split()[0] for m in made])

    out = inner.mapInArrow(run, ", ".join(kinds + made))
    return out.select(*[F.col(f"in{i}").alias(c) for i, c in enumerate(keep)], *[m.split()[0] for m in made])


def reject(docs: DataFrame, model: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more."""
    own = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("own"), docs["text"])
    return score(own, model, ["own"]).filter(F.col("score") < threshold).select("own.*")
