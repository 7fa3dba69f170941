"""N-gram language model in log-frequency Bloom filters, and scores of whole texts.

Counting: one pass per order emits (n-gram hash, count) already summed per
buffer; Spark sums them over the corpus.  An n-gram of order two or more is
counted only where both its shorter n-grams are stored (they must be at least
as frequent), and stored when its count reaches the floor, ``floor`` times the
number of training tokens.  At most 1/floor n-grams of one order can reach
it, which bounds everything that is broadcast whatever the corpus:

* words at or above the floor with exact counts: 16 bytes each;
* per order, a log-frequency Bloom filter: an n-gram with count c is entered
  once for each level up to 1 + log_base(c / floor count), at most
  1/floor * base/(base-1) entries.  The count is read back by probing levels
  1, 2, ... until one is missing;
* for each context of two words or more, how often it was followed by a stored
  n-gram, in a filter of the same kind.

Rarer words and pairs never enter a filter, but none is dropped: a pair that
is not in the filter goes with its text and its word's count, once a text, to
the bucket of its hash; a rare word goes with its pair to the bucket of the
word's.  What many texts send to a bucket is one packed row.  All training rows
of a pair or rare word meet there, so their sum is its exact count, and what
that adds to each text is summed up before anything is written, and handed on
packed, too, to the part of the texts that it belongs to.  The factor for
n = 0 splits into one of the word and one of the context, hence a rare word adds
both, its own and that of the pair it begins.  As no longer n-gram over such a
pair is stored, what higher orders add is a factor known in the task.  N-grams
of order three or more below the floor are not stored.

Probability: p_n = (c_n + (left + mass) * p_(n-1)) / (context + mass), where
``left`` is the context's count not covered by stored n-grams (0 for pairs);
for orders whose context isn't stored p_n = p_(n-1); p_1 = (c + 1) / (N + V + 1).

Texts: null counts as empty (one token, the end).  Words are told apart by
64-bit hashes.  Null ids count as training rows; repeated rows are scored and
counted one by one.  An empty table gives no rows; without training rows all
counts are 0.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm import bits, scan
from stellate.llm.common import column_type, documents, materialize, release, row_ids

ORDER = 2
FLOOR = 2e-7
LEVEL_BASE = 1.25
MASS = 2.0
BITS_PER_ENTRY = 16
PROBES = 6
BUFFER_TOKENS = 1 << 21
BLOCK_BYTES = 1 << 20
#: Counted rows in a batch: Spark holds a batch outside its heap.
BATCH_ROWS = 1 << 16
#: Text bytes scored at once; each of their pairs becomes a row of a dozen columns.
SCORE_BYTES = 1 << 20
END = np.uint64(0x8F3A1C5D7E9B2461)
BEGIN = np.uint64(0x51ED270B9F3C6A87)
CONTEXT = np.uint64(0xC2B2AE3D27D4EB4F)
#: Texts that a task sums up pairs for before it hands the sums on.
MOST_SUMS = 1 << 20
#: Pairs that a task gathers before it packs them, and texts that they may come from.
PACKED = 1 << 19
PACKED_TEXTS = 1 << 20
#: Buckets of pairs: so many, or one for each so many training tokens.
BUCKETS = 1 << 10
BUCKET_TOKENS = 1 << 21
#: Held-out rows of a bucket that are opened at once, and rows that are summed up at once.
OPENED = 1 << 19
#: Binary digits of a text's number within the part of the texts whose sums meet.
PART_BITS = 12
#: What the rare words of a text add to it where they are known.
RARE = ("known", "base_more", "score_more")
TEXT = ("doc_id", "held_out", "n_tokens", "n_known", "base", "score")
COLUMNS = ["key", "who", "count", "extra"]


class Lookup:
    """Row numbers, from 1, of a bounded number of uint64 keys; 0 for other keys."""

    BUCKET_BITS = 18

    def __init__(self, keys: np.ndarray):
        self.keys = np.sort(keys)
        edge = np.arange((1 << self.BUCKET_BITS) + 1, dtype=np.uint64)[:-1] << np.uint64(64 - self.BUCKET_BITS)
        self.first = np.append(np.searchsorted(self.keys, edge), len(keys))

    def __call__(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), np.int64)
        bucket = (h >> np.uint64(64 - self.BUCKET_BITS)).astype(np.int64)
        at, stop = self.first[bucket], self.first[bucket + 1]
        live = np.flatnonzero(at < stop)
        while len(live):
            here = at[live]
            hit = self.keys[here] == h[live]
            out[live[hit]] = here[hit] + 1
            at[live] += 1
            live = live[~hit]
            live = live[at[live] < stop[live]]
        return out

    def values(self, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
        """``values`` by row number; 0 at 0 and for keys that have none."""
        out = np.zeros(len(self.keys) + 1, np.float64)
        out[self(keys)] = values
        out[0] = 0
        return out


class CountFilter:
    """Log-frequency Bloom filter: ``levels`` finds an n-gram's quantised count."""

    def __init__(self, words: np.ndarray, least: int):
        self.words, self.least = words, least
        self.middle = np.append(0.0, least * LEVEL_BASE ** (np.arange(512) + 0.5))

    @staticmethod
    def entry(key: np.ndarray, level: int) -> np.ndarray:
        return scan.mix64(key + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64)))

    def levels(self, key: np.ndarray) -> np.ndarray:
        out = np.zeros(len(key), np.int64)
        member = np.flatnonzero(self.members(key))
        distinct, inverse = np.unique(key[member], return_inverse=True)
        found = np.ones(len(distinct), np.int64)
        live = np.arange(len(distinct))
        level = 1
        while len(live):
            level += 1
            live = live[bits.contains(self.words, self.entry(distinct[live], level), PROBES)]
            found[live] = level
        out[member] = found[inverse]
        return out

    def counts(self, level: np.ndarray) -> np.ndarray:
        """Middle of the level's range of counts; 0 where nothing is stored."""
        return self.middle[level]

    def members(self, key: np.ndarray) -> np.ndarray:
        return bits.contains(self.words, self.entry(key, 1), PROBES)

    @classmethod
    def build(cls, counts: DataFrame, least: int, floor: float) -> "CountFilter":
        """From (key, n) rows with n at or above ``least``."""
        step = math.log(LEVEL_BASE)
        most = F.floor(F.log(F.col("n") / F.lit(float(least))) / F.lit(step) + F.lit(1e-9)).cast("int") + 1
        counts = counts.select("key", most.alias("most"))
        entries = counts.agg(F.sum("most")).first()[0] or 0
        bound = int(2 * LEVEL_BASE / (LEVEL_BASE - 1) / floor * BITS_PER_ENTRY / 512)
        n_blocks = bits.blocks_for(entries, BITS_PER_ENTRY, 1 << bound.bit_length())

        def expand(batches):
            for b in batches:
                key = b.column("key").to_numpy().view(np.uint64)
                most = b.column("most").to_numpy()
                for level in range(1, int(most.max(initial=0)) + 1):
                    made = cls.entry(key[most >= level], level)
                    yield pa.RecordBatch.from_arrays([pa.array(scan.signed(made))], ["h"])

        return cls(bits.build(counts.mapInArrow(expand, "h long"), n_blocks, PROBES), least)


class Tokens:
    """The words of a block's texts, each text closed by the end token."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        start, end, doc = scan.spans(data, offs)
        word = scan.hashes(data, start, end, scan.LOWER)
        texts = len(offs) - 1
        per_doc = np.bincount(doc, minlength=texts) + 1
        self.close = np.cumsum(per_doc) - 1
        self.open = self.close - per_doc + 1
        self.key = np.full(len(word) + texts, END, np.uint64)
        self.key[np.arange(len(word)) + doc] = word
        self.doc = np.repeat(np.arange(texts), per_doc)
        self.place = np.arange(len(self.key)) - self.open[self.doc]
        self.size = per_doc
        previous = np.empty_like(self.key)
        previous[1:] = self.key[:-1]
        previous[self.open] = BEGIN
        self.previous = previous

    def longer(self, shorter: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
        """(n-gram hash, hash of its context) ending at each token."""
        context = self.previous if order == 2 else np.concatenate([shorter[:1], shorter[:-1]])
        return scan.mix64(context * np.uint64(scan.BASE) + self.key), context


class Model:
    """Everything a task needs; its size is bounded by the floor."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, tokens: int, distinct: int, least: int, texts: int):
        self.head = Lookup(words)
        self.count = self.head.values(words, counts)
        self.tokens, self.distinct, self.least = tokens, distinct, least
        self.texts = float(texts)
        self.grams: list[CountFilter] = []
        self.follow: list[CountFilter] = []          # by context of two or more words: followed by a stored n-gram

    def walk(self, t: Tokens, read):
        """(order, key, context, context's count, its count followed by stored n-grams, may be stored).

        ``read(filter, keys)`` gives a level above 0 for stored n-grams.
        """
        row = self.head(t.key)
        stored = row > 0
        before = np.empty(len(row))
        before[1:] = self.count[row[:-1]]
        before[t.open] = self.texts
        went = before                               # every pair counts
        shorter, order = t.key, 2
        while True:
            key, context = t.longer(shorter, order)
            able = stored & (before > 0) & (t.place >= order - 2)
            level = np.zeros(len(key), np.int64)
            if order - 2 < len(self.grams):
                level[able] = read(self.grams[order - 2], key[able])
            yield order, key, context, before, went, able, level
            if order - 2 >= len(self.grams):
                return
            shorter, stored = key, level > 0
            size = self.grams[order - 2].counts(level)
            before = np.concatenate([size[:1], size[:-1]])
            before[t.open] = 0
            if order - 2 < len(self.follow):
                follow = self.follow[order - 2]
                went = follow.counts(follow.levels(key ^ CONTEXT))
                went = np.concatenate([went[:1], went[:-1]])
            order += 1

    def count_next(self, t: Tokens):
        """(keys to count of the next order, contexts that the last stored order's n-grams follow)."""
        follow = np.zeros(0, np.uint64)
        for order, key, context, _, _, able, level in self.walk(t, lambda f, k: f.members(k)):
            if order == len(self.grams) + 2:
                return key[able], follow
            follow = context[level > 0]
        raise AssertionError

    def scores(self, t: Tokens, order: int):
        """(exact count or 0 for rare words, log10 p, which tokens lack a factor, their key and context's count).

        The factor that lacks is p_2 of pairs that are not in the filter (order 1: p_1 of rare words).
        """
        exact = self.count[self.head(t.key)]
        p = (exact + 1.0) / (self.tokens + self.distinct + 1.0)
        lacks, pair, first = exact == 0, t.key, np.zeros(len(exact))
        p[lacks] = 1.0
        for n, key, _, before, went, _, level in self.walk(t, lambda f, k: f.levels(k)):
            if n > order:
                break
            known = before > 0
            left = np.maximum(before - went, 0.0) + MASS
            p = np.where(known, (self.grams[n - 2].counts(level) + left * p) / (np.maximum(before, went) + MASS), p)
            if n == 2:
                lacks, pair, first = level == 0, key, before
                p[lacks] = 1.0
        return exact, np.log10(p), lacks, pair, first


def _summed(kind: int, keys: list[np.ndarray]):
    key = np.concatenate(keys)
    keys.clear()
    key.sort()
    first, n = _runs(key)
    key = scan.signed(key[first])
    for i in range(0, len(key), BATCH_ROWS):
        part = key[i:i + BATCH_ROWS]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(part), kind, np.int8)), pa.array(part), pa.array(n[i:i + BATCH_ROWS])], ["kind", "key", "n"])


def _count(texts: DataFrame, keys_of, kinds: int = 2) -> DataFrame:
    """Corpus counts (kind, key, n) of the keys that ``keys_of(tokens)`` gives for kind 0 and 1 (1 only: ``kinds`` 1)."""
    def run(batches):
        held: list[list[np.ndarray]] = [[], []]
        size = 0
        for _, data, offs in scan.blocks(batches, limit=BLOCK_BYTES):
            for kind, keys in enumerate(keys_of(Tokens(data, offs))):
                if not kind and kinds == 1:
                    continue
                held[kind].append(keys)
                size += len(keys)
            if size >= BUFFER_TOKENS:
                for kind, keys in enumerate(held):
                    if keys:
                        yield from _summed(kind, keys)
                held, size = [[], []], 0
        for kind, keys in enumerate(held):
            if keys:
                yield from _summed(kind, keys)

    return (texts.select("text").mapInArrow(run, "kind byte, key long, n long")
            .groupBy("kind", "key").agg(F.sum("n").alias("n")))


def train(texts: DataFrame, order: int = ORDER, floor: float = FLOOR) -> tuple[Model, DataFrame]:
    """(model, exact counts (key, n) of every training word)."""
    spark = texts.sparkSession
    words = materialize(_count(texts, lambda t: [t.key]).filter("kind = 0").select("key", "n"), "words")
    totals = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v"),
                       F.coalesce(F.sum(F.when(F.col("key") == int(END.view(np.int64)), F.col("n"))), F.lit(0)).alias("texts")).first()
    least = max(1, math.ceil(floor * totals["n"]))
    head = words.filter(F.col("n") >= least).toArrow()
    model = Model(head.column("key").to_numpy().view(np.uint64), head.column("n").to_numpy(),
                  totals["n"], totals["v"], least, totals["texts"])
    for n in range(2, order + 2 if order > 2 else order + 1):
        shared = spark.sparkContext.broadcast(model)
        counted = _count(texts, lambda t, m=shared: m.value.count_next(t), 2 if n <= order else 1)
        counted = materialize(counted.filter((F.col("kind") == 1) | (F.col("n") >= least)), f"grams{n}")
        after = counted.filter("kind = 1").select("key", "n")
        if n > 3:
            contexts = after.filter(F.col("n") >= least).withColumn(
                "key", F.col("key").bitwiseXOR(F.lit(int(CONTEXT.view(np.int64)))))
            model.follow.append(CountFilter.build(contexts, least, floor))
        if n <= order:
            model.grams.append(CountFilter.build(counted.filter("kind = 0"), least, floor))
    return model, words


def coded(row: np.ndarray, times: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the row, row, binary digit of ``times`` and ``held`` in one long) for each digit that is set."""
    at, out = [], []
    for digit in range(int(times.max(initial=0)).bit_length()):
        here = np.flatnonzero(times >> digit & 1)
        at.append(here)
        out.append(row[here] << 6 | digit << 1 | held[here])
    return np.concatenate([np.zeros(0, np.int64), *at]), np.concatenate([np.zeros(0, np.int64), *out])


def pack(columns: list[np.ndarray]) -> bytes:
    """Columns of one length, the bytes of a value apart: those that hardly differ shrink to nothing."""
    return pa.compress(b"".join(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes() for x in columns),
                       codec="zstd", asbytes=True)


def unpack(raw: bytes, n: int, types: list) -> list[np.ndarray]:
    types = [np.dtype(t) for t in types]
    data = np.frombuffer(pa.decompress(raw, n * sum(t.itemsize for t in types), "zstd", asbytes=True), np.uint8)
    edge = np.cumsum([0, *(n * t.itemsize for t in types)])
    return [np.ascontiguousarray(data[a:b].reshape(-1, n).T).view(t).ravel() for a, b, t in zip(edge, edge[1:], types)]


#: Types of a packed row's columns: key as differences, text and code less those of the first text, and of pairs the
#: word's count, of rare words the pair.
PAIR_TYPES = (np.uint64, np.uint32, np.float32)
RARE_TYPES = (np.uint64, np.uint32, np.uint64)
PACKED_SCHEMA = "bucket int, rare byte, held byte, n int, first long, packed binary"


def _packed(rare: int, parts: list[list[np.ndarray]], first: int, buckets: int) -> pa.RecordBatch:
    """A row for each bucket (the high bits of the key) and its training or held-out rows, of (key, who, other)."""
    key, who, other = (np.concatenate(x) for x in zip(*parts))
    who = (who - (first << 6)).astype(np.uint32)
    order = np.lexsort((key, who & 1))
    key, who, other = key[order], who[order], other[order]
    place = (key >> np.uint64(65 - buckets.bit_length())).astype(np.int64) if buckets > 1 else np.zeros(len(key), np.int64)
    where = place << 1 | (who & 1)
    begin, rows = _runs(where)
    made = [pack([np.diff(key[a:b], prepend=np.uint64(0)), who[a:b], other[a:b]]) for a, b in zip(begin, begin + rows)]
    n = len(begin)
    return pa.RecordBatch.from_arrays(
        [pa.array((where[begin] >> 1).astype(np.int32)), pa.array(np.full(n, rare, np.int8)),
         pa.array((where[begin] & 1).astype(np.int8)), pa.array(rows.astype(np.int32)), pa.array(np.full(n, first, np.int64)),
         pa.array(made, pa.binary())], ["bucket", "rare", "held", "n", "first", "packed"])


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate([np.ones(min(len(key), 1), bool), key[1:] != key[:-1]]))
    return first, np.diff(np.append(first, len(key)))


def _position(keys: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of ``key`` are in the sorted ``keys``, where these are)."""
    at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
    here = np.flatnonzero(keys[at] == key) if len(keys) else np.zeros(0, np.int64)
    return here, at[here]


def _opened(order: int):
    """Of texts and packed rows sorted by bucket, training rows first: rows sorted by key, as ``_pair_sums`` takes them.

    The training rows of one bucket are held.  Held-out rows whose key no training row has add nothing; the others
    are opened a bounded number at a time, the training rows with them, from the second time on as rows of no text.
    """
    def pieces(rows, types):
        learnt, held, size, again, keys = [], [], 0, False, None
        none = [[np.zeros(0, t) for t in (np.uint64, np.int64, types[2])]]

        def joined(parts):
            return [np.concatenate(x) for x in zip(*(none + parts))]

        for is_held, n, first, raw in rows:
            key, who, other = unpack(raw, n, types)
            part = [np.cumsum(key, dtype=np.uint64), who.astype(np.int64) + (first << 6), other]
            if not is_held:
                learnt.append(part)
                continue
            if keys is None:
                learnt = [joined(learnt)]
                keys = np.unique(learnt[0][0])
            here, _ = _position(keys, part[0])
            held.append([x[here] for x in part])
            size += len(here)
            if size >= OPENED:
                yield joined(learnt), joined(held), again
                held, size, again = [], 0, True
        if size or not again:
            yield joined(learnt), joined(held), again

    def read(batches, extra_type):
        for batch in batches:
            extra_type[:] = [batch.schema.field("extra").type]
            is_text = batch.column("packed").is_null()
            text = batch.filter(is_text)
            if text.num_rows:
                yield -1, 0, text
            packed = batch.filter(pc.invert(is_text))
            yield from zip(*(packed.column(c).to_pylist() for c in ("bucket", "rare", "held", "n", "first", "packed")))

    def run(batches):
        kind = []
        more, waiting = _Sums(), _Waiting()
        for (bucket, rare), rows in itertools.groupby(read(batches, kind), lambda r: r[:2]):
            if bucket < 0:
                for _, _, text in rows:
                    who = text.column("first").to_numpy() << 6
                    yield _columns(np.zeros(len(who), np.int64), who, np.zeros(len(who), np.float32), text.column("extra"))
                continue
            for learnt, held, again in pieces((r[2:] for r in rows), RARE_TYPES if rare else PAIR_TYPES):
                key, who, other = (np.concatenate(x) for x in zip(learnt, held))
                known = len(learnt[0])
                if rare:
                    words, at = np.unique(learnt[0], return_inverse=True)
                    count = np.bincount(at, weights=_times(learnt[1]), minlength=len(words))
                    each = count[np.concatenate([at, _position(words, held[0])[1]])]
                    new = slice(known if again else 0, None)
                    begins = (key[new] != END) & (order > 1)
                    more.add(who[new] >> 6, _times(who[new]), each[new], begins)
                    if len(more.row) >= MOST_SUMS:
                        yield more.taken(kind[0])
                    key, other = other, each
                if again:
                    who[:known] = -1 << 6 | who[:known] & 63
                if order > 1:
                    waiting.add(key, who, other)
                    if waiting.size >= OPENED:
                        yield waiting.taken(kind[0])
        if waiting.size:
            yield waiting.taken(kind[0])
        if len(more.row):
            yield more.taken(kind[0])

    return run


def _times(who: np.ndarray) -> np.ndarray:
    return np.int64(1) << (who >> 1 & 31)


def _columns(key, who, count, extra) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(who), pa.array(count.astype(np.float64)), extra], COLUMNS)


class _Sums:
    """What known rare words add, by text."""

    def __init__(self):
        self.row, self.sums = np.zeros(0, np.int64), [np.zeros(0) for _ in RARE]

    def add(self, row: np.ndarray, times: np.ndarray, count: np.ndarray, begins: np.ndarray) -> None:
        base = times * np.log10(count + 1.0)
        new = [times.astype(np.float64), base, base + times * begins * np.log10(MASS / (count + MASS))]
        self.row, at = np.unique(np.concatenate([self.row, row]), return_inverse=True)
        self.sums = [np.bincount(at, weights=np.concatenate([x, y]), minlength=len(self.row)) for x, y in zip(self.sums, new)]

    def taken(self, kind: pa.DataType) -> pa.RecordBatch:
        n = len(self.row)
        filled = [pa.array(self.sums[0].astype(np.int64)), *(pa.array(x) for x in self.sums[1:])]
        extra = pa.StructArray.from_arrays([*(pa.nulls(n, f.type) for f in list(kind)[:len(TEXT)]), *filled], [*TEXT, *RARE])
        out = _columns(np.zeros(n, np.int64), self.row << 6 | 1, np.zeros(n), extra)
        self.__init__()
        return out


class _Waiting:
    """Pairs of whole buckets that are summed up together."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, *part: np.ndarray) -> None:
        key, who, count = part
        order = np.lexsort((who & 1, key))
        self.parts.append([key[order], who[order], count[order].astype(np.float64)])
        self.size += len(key)

    def taken(self, kind: pa.DataType) -> pa.RecordBatch:
        key, who, count = (np.concatenate(x) for x in zip(*self.parts))
        self.__init__()
        return _columns(scan.signed(key), who, count, pa.nulls(len(key), kind))


def _pair_sums(whole: float):
    """Of rows sorted by key, training rows first: texts as they are, sums of known pairs by text, rare pairs with their counts.

    A pair's count n is the times of its training rows, and there are fewer of them than the floor, so nothing else
    of a key is held.  What a pair adds to its factor for n = 0 is log10(1 + n / (MASS * p_1)).
    """
    def add(sums, row, value):
        row, at = np.unique(np.concatenate([sums[0], row]), return_inverse=True)
        return row, np.bincount(at, weights=np.concatenate([sums[1], value]), minlength=len(row))

    def out(row, extra, times=None, n=None, value=None):
        columns = [pa.array(row), *(pa.nulls(len(row), pa.int64()) if x is None else pa.array(x) for x in (times, n)),
                   pa.nulls(len(row), pa.float64()) if value is None else pa.array(value), extra]
        return pa.table(columns, names=["row", "times", "n", "value", "extra"]).combine_chunks().to_batches()

    def run(batches):
        held, sums, kind = None, (np.zeros(0, np.int64), np.zeros(0)), None
        going = None                                            # key whose count is final, its count
        for batch in _with_end(batches):
            if batch is not None:
                t = pa.Table.from_batches([batch])
                extra = t.column("extra").combine_chunks()
                kind = extra.type
                is_text = pc.is_valid(pc.struct_field(extra, "n_tokens"))
                text = t.filter(is_text)
                if text.num_rows:
                    yield from out(text.column("who").to_numpy() >> 6, text.column("extra").combine_chunks())
                t = t.filter(pc.invert(is_text))
                held = t if held is None else pa.concat_tables([held, t])
            if held is None or not held.num_rows:
                continue
            key, who = held.column("key").to_numpy(), held.column("who").to_numpy()
            times, learnt = np.int64(1) << (who >> 1 & 31), 1 - (who & 1)
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            n = np.add.reduceat(times * learnt, first)
            if going is not None and key[0] == going[0]:
                n[0] = going[1]
            final = batch is None or not learnt[-1] or (going is not None and key[-1] == going[0])
            stop = len(key) if final else first[-1]
            going = (key[-1], n[-1]) if final else None
            each = np.repeat(n, np.diff(np.append(first, len(key))))[:stop]
            known = held.column("extra").is_null().to_numpy()[:stop]
            at = np.flatnonzero(known & (each > 0))
            count = held.column("count").to_numpy()[at].astype(np.float64)
            sums = add(sums, who[at] >> 6, times[at] * np.log10(1 + each[at] * whole / (MASS * (count + 1.0))))
            rare = np.flatnonzero(~known)
            if len(rare):
                yield from out(who[rare] >> 6, held.column("extra").take(pa.array(rare)).combine_chunks(), times[rare], each[rare])
            held = held.slice(stop)
            if len(sums[0]) >= MOST_SUMS:
                yield from out(sums[0], pa.nulls(len(sums[0]), kind), value=sums[1])
                sums = (np.zeros(0, np.int64), np.zeros(0))
        if len(sums[0]):
            yield from out(sums[0], pa.nulls(len(sums[0]), kind), value=sums[1])

    return run


SUM_TYPES = (np.int64, np.int64, np.float64, np.float64)
SUMS_SCHEMA = "part long, row long, n int, packed binary"


def _by_part(batches):
    """Of what ``_pair_sums`` gives: texts as they are, what is to be added to them as packed rows, one a part of the texts."""
    for batch in batches:
        extra = batch.column("extra")
        is_text = pc.is_valid(pc.struct_field(extra, "n_tokens"))
        text = batch.filter(is_text)
        n = text.num_rows
        if n:
            row = text.column("row").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(row >> PART_BITS), pa.array(row), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
                                              text.column("extra")], ["part", "row", "n", "packed", "extra"])
        rest = batch.filter(pc.and_(pc.invert(is_text), pc.greater_equal(batch.column("row"), 0)))
        if not rest.num_rows:
            continue
        known, base, more = (pc.struct_field(rest.column("extra"), c) for c in RARE)
        columns = [rest.column("row").to_numpy(), *(pc.fill_null(x, 0).to_numpy(zero_copy_only=False) for x in (
            known, base, pc.coalesce(rest.column("value"), more)))]
        order = np.argsort(columns[0], kind="stable")
        row, *columns = (x[order] for x in columns)
        begin, rows = _runs(row >> PART_BITS)
        made = [pack([np.diff(row[a:b], prepend=0), *(x[a:b] for x in columns)]) for a, b in zip(begin, begin + rows)]
        n = len(begin)
        yield pa.RecordBatch.from_arrays(
            [pa.array(row[begin] >> PART_BITS), pa.nulls(n, pa.int64()), pa.array(rows.astype(np.int32)), pa.array(made, pa.binary()),
             pa.nulls(n, rest.schema.field("extra").type)], ["part", "row", "n", "packed", "extra"])


def _added(tokens: int):
    """Of a part's texts and packed rows: the texts with all that is added to them."""
    def run(t: pa.Table) -> pa.Table:
        is_text = pc.is_null(t.column("packed"))
        text = t.filter(is_text)
        text = text.take(pc.sort_indices(text.column("row")))
        row = text.column("row").to_numpy()
        sums = [np.zeros(len(row)) for _ in RARE]
        packed = t.filter(pc.invert(is_text))
        for n, raw in zip(packed.column("n").to_pylist(), packed.column("packed").to_pylist()):
            at, *more = unpack(raw, n, SUM_TYPES)
            at = np.searchsorted(row, np.cumsum(at))
            for x, y in zip(sums, more):
                x += np.bincount(at, weights=y, minlength=len(row))
        doc_id, held_out, n_tokens, n_known, base, score = text.column("extra").combine_chunks().flatten()[:len(TEXT)]
        return pa.table([doc_id, held_out, n_tokens, pa.array(n_known.to_numpy() + sums[0].astype(np.int64)),
                         pa.array(np.full(len(row), tokens, np.int64)), pa.array(base.to_numpy() + sums[1]),
                         pa.array(score.to_numpy() + sums[2])],
                        ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def _with_end(batches):
    """The batches that have rows, then None."""
    yield from (b for b in batches if b.num_rows)
    yield None


def score(docs: DataFrame, held_out, order: int = ORDER, floor: float = FLOOR) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``.

    ``held_out`` is a Boolean column: rows from which nothing is learnt.
    """
    texts = documents(docs).withColumn("held_out", held_out)
    model, words = train(texts.filter("not held_out"), order, floor)
    release(texts.sparkSession)
    shared = texts.sparkSession.sparkContext.broadcast(model)
    total = model.tokens + model.distinct + 1.0

    buckets = 1 << max(BUCKETS - 1, model.tokens // BUCKET_TOKENS).bit_length()

    def run(batches):
        rows = row_ids()
        m = shared.value
        pairs, rare, size, first = [], [], 0, 0
        kind = None

        def packed():
            for which, parts in ((0, pairs), (1, rare)):
                if parts:
                    made = _packed(which, parts, first, buckets)
                    yield pa.RecordBatch.from_arrays([*made.columns, pa.nulls(made.num_rows, kind)], [*made.schema.names, "extra"])

        for part, data, offs in scan.blocks(batches, limit=SCORE_BYTES):
            t = Tokens(data, offs)
            exact, log_p, lacks, pair, before = m.scores(t, order)
            n = part.num_rows
            seen = exact > 0
            base = np.log10((exact + 1.0) / total)                # of rare words: as if no training row had them
            log_p[lacks] += base[lacks] + np.log10(MASS / (before[lacks] + MASS))
            sums = [np.bincount(t.doc, weights=x, minlength=n) for x in (base, log_p, seen)]
            ids = np.array(rows.take(n), np.int64)
            ids = ids >> 40 << 30 | ids & ((1 << 30) - 1)       # a task's number, then the text's in it
            text = [part.column("doc_id"), part.column("held_out"), pa.array(t.size), pa.array(sums[2].astype(np.int64)),
                    pa.array(sums[0]), pa.array(sums[1])]
            extra = pa.StructArray.from_arrays(
                [*text, pa.nulls(n, pa.int64()), *(pa.nulls(n, pa.float64()) for _ in RARE[1:])], [*TEXT, *RARE])
            kind = extra.type
            none = np.zeros(n, np.int8)
            yield pa.RecordBatch.from_arrays(
                [pa.array((-1 - ids % buckets).astype(np.int32)), pa.array(none), pa.array(none), pa.array(none.astype(np.int32)),
                 pa.array(ids), pa.nulls(n, pa.binary()), extra], ["bucket", "rare", "held", "n", "first", "packed", "extra"])
            tail = np.flatnonzero(lacks)
            tail = tail[np.lexsort((pair[tail], t.doc[tail]))]
            fresh = np.ones(len(tail), bool)
            fresh[1:] = (pair[tail[1:]] != pair[tail[:-1]]) | (t.doc[tail[1:]] != t.doc[tail[:-1]])
            at = np.flatnonzero(fresh)
            held = part.column("held_out").to_numpy(zero_copy_only=False).astype(np.int64)
            owner = t.doc[tail[at]]
            at_row, who = coded(ids[owner], np.diff(np.append(at, len(tail))), held[owner])
            one = tail[at][at_row]
            known = seen[one]
            if not size:
                first = int(ids[0])
            pairs.append([pair[one[known]], who[known], exact[one[known]].astype(np.float32)])
            rare.append([t.key[one[~known]], who[~known], pair[one[~known]]])
            size += len(one)
            if size >= PACKED or ids[-1] - first >= PACKED_TEXTS:
                yield from packed()
                pairs, rare, size = [], [], 0
        yield from packed()

    extra = (f"extra struct<doc_id: {column_type(docs, 'doc_id')}, held_out: boolean, n_tokens: bigint, n_known: bigint, base: double, "
             "score: double, known: bigint, base_more: double, score_more: double>")
    opened, summed = _opened(order), _pair_sums(total)
    found = materialize(
        texts.mapInArrow(run, f"{PACKED_SCHEMA}, {extra}")
        .repartition("bucket").sortWithinPartitions("bucket", "rare", "held")
        .mapInArrow(lambda batches: _by_part(summed(opened(batches))), f"{SUMS_SCHEMA}, {extra}"), "scored")
    release(texts.sparkSession)
    return found.groupBy("part").applyInArrow(
        _added(model.tokens), f"doc_id {column_type(docs, 'doc_id')}, held_out boolean, n_tokens bigint, n_known bigint, "
        "train_tokens bigint, base_score double, score double")
