"""Exact join of texts by the Jaccard similarity of their word n-grams, through parity sketches.

A set's sketch has k blocks of 2^64 bits; each shingle flips one bit of one
block, kept as the xor of hashes of the bits that are set: unlike sets of
shingles agree in a block by chance only once in 2^64, while in blocks of 64
bits those of one or two shingles did so all the time.  A shingle that only one
of two sets holds changes one bit, so the sketches differ in at most |A ^ B| bits.  At similarity t or more that is at
most D = (1 - t) / t * |A|, hence at most D of A's blocks differ: whenever
more than D of its blocks are not zero, one such block is equal in both.  k
depends on the set's size band only; sets near the upper edge of a band are
sketched for the next band too, since partners may lie there.

Prefixes: order all blocks in one way for all sets.  At most D of a set's
blocks are missing in its partner, so its first D + l blocks hold the first l
of those that both have; the same goes for the partner.  Hence both prefixes
share at least min(l) blocks, and only prefixes are moved; a pair that shares
fewer is no candidate.  Any order will do; this one takes blocks that a bounded
sample of texts shows to be frequent last, the rest by hash.

Sets that share a block are counted: in small groups all pairs, in large ones
each set with the first; pairs with enough equal blocks are candidates.  After
components are known, pairs of a large group that lie across components and
that the whole sketches allow are candidates, too, compared in bounded chunks, so
no pair depends on the count of a group that is too large to be paired.  Only
those that would join parts of a chunk are taken, fewer than it has members, as
long as that finds links; what then still lies across components is taken whole.  Every
candidate is verified: whole sketches that differ in too many bits rule a pair
out, the sets themselves decide the rest.  Equal sets are one node of the graph.

Texts: null counts as empty; texts without words have an empty set and stay
alone.  Repeated rows are equal sets.  A null id takes part; the smallest id
of its component is null only if all ids are.  An empty table gives no rows.
Shingles are told apart by 64-bit hashes, sets by 63 bits over all of them.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm import bits, scan
from stellate.llm.common import documents, materialize, release
from stellate.llm.components import components

WORDS = 5
SIMILARITY = (80, 100)
SIGMAS = 9.0
SMALL_GROUP = 12
CHUNK = 2048
#: Texts whose blocks are counted, and blocks of them that are known as frequent: they set an order only.
SAMPLE = 1 << 16
COMMON = 1 << 20
#: In block rows: bits of the size; above them the thousandths of the set's blocks that are frequent ones.
SIZE_BITS = 40
#: In candidates: w of a pair is at most this.
PAIR = -(1 << 50)
SHORT = (1 << 31) - 1
#: Up to so many texts pairs are counted by 31 bits of either node.
NARROW = 1 << 28
FILTER_BLOCKS = 1 << 17
SEED = 1
NULL_ID = -(1 << 63)
#: Rounds in which large groups give spanning pairs only, before one with all pairs left.
SPANNING = 4


def band(size: int) -> int:
    """Bands grow by the square root of two."""
    b = 2 * size.bit_length() - 2
    return b + (size * size >= 1 << (b + 1))


@lru_cache(None)
def band_blocks(b: int) -> int:
    """As few blocks as leave the largest set of a band more than D of them that are not zero.

    ``SIGMAS`` standard deviations of the number of occupied blocks are kept
    as margin: odds below 1e-18 a set.  The fewer the blocks, the more
    shingles each holds and the fewer sets with a passage in common share one.
    """
    top = math.isqrt((1 << (b + 1)) - 1)
    if top < 32:
        return 4096 if top < 16 else 512
    k = top // 4
    while True:
        k += max(1, k // 64)
        x = top / k
        empty = math.exp(-x)
        filled = k * (1 - empty)
        if filled - SIGMAS * math.sqrt(k * empty * (1 - (1 + x) * empty)) > most_different(top) + shared_least(top):
            return k


def most_different(size, similarity: tuple[int, int] = SIMILARITY) -> int:
    """Largest symmetric difference of a set of ``size`` with a set at the similarity or above."""
    a, b = similarity
    return size * (b - a) // a


def shared_least(size, similarity: tuple[int, int] = SIMILARITY):
    """How many equal blocks a pair must have among the first D of either and so many more."""
    return 1 + most_different(size, similarity) // 16


def shingle_sets(data: np.ndarray, offs: np.ndarray, n: int = WORDS):
    """(distinct shingle hashes by text, offsets, node): node 0 is the empty set."""
    start, end, doc = scan.spans(data, offs)
    word = scan.hashes(data, start, end, scan.LOWER)
    texts = len(offs) - 1
    count = np.bincount(doc, minlength=texts)
    key, at = scan.windows(word, doc, n)
    owner = doc[at]
    first = np.cumsum(count) - count
    for d in np.flatnonzero((count > 0) & (count < n)):        # fewer words: the whole sequence
        short, _ = scan.windows(word[first[d]:first[d] + count[d]], np.zeros(count[d], np.int64), int(count[d]))
        key, owner = np.append(key, short), np.append(owner, d)
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    key, owner = key[fresh], owner[fresh]
    bound = np.searchsorted(owner, np.arange(texts + 1))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(scan.mix64(key ^ np.uint64(0xA5A5A5A55A5A5A5A)), dtype=np.uint64)])
    size = np.diff(bound)
    node = scan.mix64(sums[bound[1:]] - sums[bound[:-1]] + size.astype(np.uint64)) & ~np.uint64(1)
    node[size == 0] = 0
    return key, bound, node


def sketch_blocks(key: np.ndarray, k: int, b: int, seed: int) -> np.ndarray:
    """Hashes of the blocks that are not zero of one set's sketch."""
    h = scan.mix64(key ^ np.uint64((seed * 0x9E3779B97F4A7C15 + b * 0xD1B54A32D192ED03) % (1 << 64)))
    block = ((h >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
    order = np.argsort(block, kind="stable")
    block, bit = block[order], scan.mix64(h[order])
    first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    parity = np.bitwise_xor.reduceat(bit, first)
    keep = parity != 0
    return scan.mix64(parity[keep] ^ scan.mix64(block[first][keep] + np.uint64(((b + 1) << 40) + (seed << 56))))


INDEX_SCHEMA = "k long, v long, w long, s binary"


def _rows(k: np.ndarray, v: np.ndarray, w: np.ndarray, s: list | None = None) -> pa.RecordBatch:
    sketch = pa.nulls(len(k), pa.binary()) if s is None else pa.array(s, pa.binary())
    return pa.RecordBatch.from_arrays([*(pa.array(x.astype(np.int64)) for x in (k, v, w)), sketch], ["k", "v", "w", "s"])


def whole_sketch(key: np.ndarray) -> bytes:
    """Parity of the shingles by bit position, in four to eight bits a shingle.

    Shingles that meet in a bit hide a difference; at this width about one in twenty does.
    """
    bits_used = 1 << max(6, int(len(key)).bit_length() + 2)
    place = scan.mix64(key ^ np.uint64(0x6A09E667F3BCC909)) & np.uint64(bits_used - 1)
    return np.packbits((np.bincount(place.astype(np.int64), minlength=bits_used) & 1).astype(np.uint8)).tobytes()


def sketch_distance(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Differing bits of rows of bytes; the longer sketches are folded onto the shorter ones' length."""
    while one.shape[1] != two.shape[1]:
        if one.shape[1] < two.shape[1]:
            one, two = two, one
        half = one.shape[1] // 2
        one = one[:, :half] ^ one[:, half:]
    return np.bitwise_count(one ^ two).sum(axis=1, dtype=np.int64)


def _blocks_of(key: np.ndarray, similarity: tuple[int, int], seed: int):
    """(band, hashes of the blocks that are not zero) of a set's sketches: its band's and, near the upper edge, the next one's."""
    a, c = similarity
    own = band(len(key))
    for b in [own] + [own + 1] * (band(len(key) * c // a) > own):
        yield sketch_blocks(key, band_blocks(b), b, seed)


def common_blocks(texts: DataFrame, n: int, similarity: tuple[int, int], seed: int, total: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, counts) of blocks that several of about SAMPLE texts hold, at most COMMON of them.

    They only set the order in which a set's blocks are taken: any order gives the same links, and this one
    takes blocks that are known to be frequent last.
    """
    a, c = similarity
    sample = texts if total <= SAMPLE else texts.filter(
        F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.lit((1 << 30) * SAMPLE // total))

    def run(batches):
        for _, data, offs in scan.blocks(batches):
            key, bound, _ = shingle_sets(data, offs, n)
            made = [m for d in np.flatnonzero(np.diff(bound) * (c - a) >= a).tolist()
                    for m in _blocks_of(key[bound[d]:bound[d + 1]], similarity, seed)]
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(scan.signed(np.concatenate(made)))], ["k"])

    found = (sample.select("text").mapInArrow(run, "k long").groupBy("k").agg(F.count("*").alias("n"))
             .filter("n > 1").orderBy(F.desc("n"), "k").limit(COMMON).toArrow())
    key = found.column("k").to_numpy().view(np.uint64)
    order = np.argsort(key)
    return key[order], np.minimum(found.column("n").to_numpy()[order], 255).astype(np.uint64)


def _index(texts: DataFrame, n: int, similarity: tuple[int, int], seed: int, total: int) -> DataFrame:
    """Rows of two kinds, told apart by w.

    Texts: (doc_id, node, -1 - size, sketch of the whole set); blocks: (48 bits of the block hash, node, share of
    frequent blocks and size), of each sketch only the first ones in a global order, frequent blocks last.  Blocks
    that agree in 48 bits only make a few candidates more.
    """
    a, c = similarity
    shared = texts.sparkSession.sparkContext.broadcast(common_blocks(texts, n, similarity, seed, total))

    def run(batches):
        seen: set[int] = set()
        common, held = shared.value
        for part, data, offs in scan.blocks(batches):
            key, bound, node = shingle_sets(data, offs, n)
            size = np.diff(bound)
            out = [[part.column("doc_id").fill_null(NULL_ID).to_numpy()], [scan.signed(node)], [-1 - size]]
            sketches = [None] * part.num_rows
            for d in np.flatnonzero(size * (c - a) >= a).tolist():      # smaller sets only have equal partners
                name = int(node[d])
                if name in seen:                                         # copies: once a task
                    continue
                seen.add(name)
                s = int(size[d])
                need = most_different(s, similarity) + shared_least(s, similarity)
                sketches[d] = whole_sketch(key[bound[d]:bound[d + 1]])
                for made in _blocks_of(key[bound[d]:bound[d + 1]], similarity, seed):
                    if len(made) < need:
                        raise ValueError("a sketch has too few blocks; take another seed")
                    often = 0
                    if len(common):
                        at = np.minimum(np.searchsorted(common, made), len(common) - 1)
                        times = np.where(common[at] == made, held[at], np.uint64(0))
                        order = times << np.uint64(56) | made >> np.uint64(8)
                        often = int(np.count_nonzero(times)) * 1000 // len(made)
                    else:
                        order = made
                    if len(made) > need:
                        made = made[np.argpartition(order, need - 1)[:need]]
                    out[0].append(scan.signed(made >> np.uint64(16)))
                    out[1].append(np.full(need, scan.signed(node[d:d + 1])[0]))
                    out[2].append(np.full(need, often << SIZE_BITS | s))
            k, v, w = (np.concatenate(x) for x in out)
            yield _rows(k, v, w, sketches + [None] * (len(k) - part.num_rows))

    return texts.mapInArrow(run, INDEX_SCHEMA)


def _runs(k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first row, number of rows) of each run of equal values."""
    first = np.flatnonzero(np.concatenate([np.ones(min(len(k), 1), bool), k[1:] != k[:-1]]))
    return first, np.diff(np.append(first, len(k)))


def _and_last(batches):
    """The batches that have rows, then None."""
    yield from (b for b in batches if b.num_rows)
    yield None


def short(node, mask):
    """The bits of a node that ``mask`` keeps, the lowest one left out."""
    return (node >> 1) & mask


def _candidates(similarity: tuple[int, int], narrow: bool):
    """Of rows (block, node, share and size) sorted by block and falling share: pairs (u, v, PAIR less the number of
    equal blocks asked for), and large groups as they are; texts pass.

    In small groups these are all pairs, in large ones each set with the first, the one with most frequent blocks:
    of edited copies that is rather the original.  ``narrow``: u and v are shortened to half a long each, in k.
    """
    a, c = similarity
    mask = SHORT                                # the driver's: a task's own import of this module has the default

    def pairs(u, v, us, vs):
        us, vs = (x & ((1 << SIZE_BITS) - 1) for x in (us, vs))
        u, v = np.minimum(u, v), np.maximum(u, v)
        near = (us * c >= vs * a) & (vs * c >= us * a) & (u != v)
        u, v = u[near], v[near]
        if narrow:
            u, v = short(u, mask), short(v, mask)
            u, v = np.minimum(u, v) << 32 | np.maximum(u, v), np.zeros(len(u), np.int64)
        return _rows(u, v, PAIR - shared_least(np.minimum(us, vs)[near], similarity))

    def run(batches):
        k = v = w = np.zeros(0, np.int64)
        large = None                             # block, first node and its size, last node of a large group still going on
        for batch in _and_last(batches):
            if batch is not None:
                new = [batch.column(n).to_numpy() for n in "kvw"]
                text = new[2] < 0
                if text.any():
                    yield batch.filter(pa.array(text))
                k, v, w = (np.concatenate([x, y[~text]]) for x, y in zip((k, v, w), new))
            if not len(k):
                continue
            fresh = np.concatenate([[True], (k[1:] != k[:-1]) | (v[1:] != v[:-1])])     # copies seen by several tasks
            k, v, w = k[fresh], v[fresh], w[fresh]
            if large is not None:
                same = int(np.searchsorted(k, large[0], "right"))
                skip = int(same > 0 and v[0] == large[3])
                yield pairs(np.full(same - skip, large[1]), v[skip:same], np.full(same - skip, large[2]), w[skip:same])
                yield _rows(k[skip:same], v[skip:same], w[skip:same])
                if same:
                    large = (*large[:3], v[same - 1])
                k, v, w = k[same:], v[same:], w[same:]
            first, rows = _runs(k)
            if not len(first):
                continue
            done = len(first) if batch is None or rows[-1] > SMALL_GROUP else len(first) - 1
            if done == len(first):
                large = (k[first[-1]], v[first[-1]], w[first[-1]], v[-1]) if rows[-1] > SMALL_GROUP else None
            stop = first[done] if done < len(first) else len(k)
            size = np.repeat(rows[:done], rows[:done])
            few = size <= SMALL_GROUP
            for d in range(1, SMALL_GROUP):
                at = np.flatnonzero(few[d:] & (k[d:stop] == k[:max(stop - d, 0)]))
                yield pairs(v[at], v[at + d], w[at], w[at + d])
            many = np.flatnonzero(~few)
            head = np.repeat(first[:done], rows[:done])[many]
            yield pairs(v[head], v[many], w[head], w[many])
            yield _rows(k[many], v[many], w[many])
            k, v, w = k[stop:], v[stop:], w[stop:]
    return run


def _near(pairs: DataFrame, sketches: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The ``pairs`` (u, v) whose sketches differ in no more bits than the sets may at the similarity."""
    a, c = similarity

    def run(batches):
        for b in batches:
            us, vs = (b.column(n).to_numpy() for n in ("us", "vs"))
            most = (us + vs) * (c - a) // (c + a)
            lengths = [np.array([len(x) for x in b.column(n).to_pylist()]) for n in ("one", "two")]
            keep = np.zeros(b.num_rows, bool)
            for x, y in set(zip(*(n.tolist() for n in lengths))):
                at = np.flatnonzero((lengths[0] == x) & (lengths[1] == y))
                one, two = (np.frombuffer(b"".join(b.column(n).take(pa.array(at)).to_pylist()), np.uint8).reshape(len(at), -1)
                            for n in ("one", "two"))
                keep[at] = sketch_distance(one, two) <= most[at]
            yield b.select(["u", "v"]).filter(pa.array(keep))

    def side(name, sketch, size):
        return sketches.select(F.col("node").alias(name), F.col("sketch").alias(sketch), F.col("size").alias(size))

    return pairs.join(side("u", "one", "us"), "u").join(side("v", "two", "vs"), "v").mapInArrow(run, "u long, v long")


def _across(similarity: tuple[int, int], spanning: bool):
    """Of members sorted by (k, lo, hi): pairs of different roots whose sketches allow the similarity.

    A group is dealt out in pairs (lo, hi) of chunks, so what is held here is two chunks.  With ``spanning`` only
    pairs that connect parts which no earlier pair of the chunks does, the nearest first: none only if there is none.
    """
    a, c = similarity

    def compare(t: pa.Table) -> pa.RecordBatch:
        node, root, size, chunk = (t.column(n).to_numpy() for n in ("node", "root", "size", "chunk"))
        apart = t.column("lo")[0] != t.column("hi")[0]
        part = np.unique(root, return_inverse=True)[1]
        raw = t.column("sketch").to_pylist()
        length = np.array([len(x) for x in raw])
        us, vs = [], []
        for x in np.unique(length):
            here = np.flatnonzero(length == x)
            one = np.frombuffer(b"".join(raw[i] for i in here), np.uint8).reshape(len(here), -1)
            for y in np.unique(length[length >= x]):
                there = np.flatnonzero(length == y)
                two = np.frombuffer(b"".join(raw[i] for i in there), np.uint8).reshape(len(there), -1)
                while two.shape[1] > one.shape[1]:
                    two = two[:, :two.shape[1] // 2] ^ two[:, two.shape[1] // 2:]
                for row, i in enumerate(here):
                    j = there if y > x else there[row + 1:]
                    ok = (part[j] != part[i]) & (size[j] * c >= size[i] * a) & (size[i] * c >= size[j] * a)
                    if apart:
                        ok &= chunk[j] != chunk[i]
                    at = np.flatnonzero(ok)
                    if not len(at):
                        continue
                    other = two[at] if y > x else two[row + 1:][at]
                    differ = np.bitwise_count(other ^ one[row]).sum(axis=1, dtype=np.int64)
                    spare = (size[j[at]] + size[i]) * (c - a) // (c + a) - differ
                    at, spare = at[spare >= 0], spare[spare >= 0]
                    if spanning and len(at):
                        at = at[np.argsort(-spare, kind="stable")]
                        met, nearest = np.unique(part[j[at]], return_index=True)
                        at = at[nearest]
                        part[np.isin(part, met)] = part[i]
                    us.append(np.minimum(node[j[at]], node[i]))
                    vs.append(np.maximum(node[j[at]], node[i]))
        none = [np.zeros(0, np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(us + none)), pa.array(np.concatenate(vs + none))], ["u", "v"])

    def run(batches):
        held = None
        for batch in _and_last(batches):
            if batch is not None:
                t = pa.Table.from_batches([batch])
                held = t if held is None else pa.concat_tables([held, t]).combine_chunks()
            if held is None or not held.num_rows:
                continue
            key = np.stack([held.column(n).to_numpy().astype(np.int64) for n in ("k", "lo", "hi")], axis=1)
            first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
            stop = np.append(first[1:], len(key))
            done = len(first) if batch is None else len(first) - 1
            for i in range(done):
                yield compare(held.slice(first[i], stop[i] - first[i]))
            held = held.slice(first[done]) if done < len(first) else None
    return run


def _verified(pairs: DataFrame, texts: DataFrame, n: int, similarity: tuple[int, int]) -> DataFrame:
    """The (u, v) of ``pairs`` at the similarity or above, decided on the sets themselves."""
    nodes = materialize(pairs.select("u").union(pairs.select(F.col("v").alias("u"))).distinct(), "nodes")
    shared = pairs.sparkSession.sparkContext.broadcast(bits.build(nodes, FILTER_BLOCKS, 3))

    def run(batches):
        seen: set[int] = set()
        for _, data, offs in scan.blocks(batches):
            key, bound, node = shingle_sets(data, offs, n)
            wanted = []
            for d in np.flatnonzero(bits.contains(shared.value, node, 3)).tolist():
                if int(node[d]) not in seen:
                    seen.add(int(node[d]))
                    wanted.append(d)
            if wanted:
                size = np.diff(bound)[wanted]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(scan.signed(node[wanted])),
                     pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)),
                                              pa.array(scan.signed(key[scan.ragged(bound[wanted], size)])))],
                    ["u", "words"])

    sets = materialize(texts.select("text").mapInArrow(run, "u long, words array<long>")
                       .join(nodes, "u", "left_semi").dropDuplicates(["u"]), "sets")
    both = (pairs.join(sets.withColumnRenamed("words", "a"), "u")
            .join(sets.select(F.col("u").alias("v"), F.col("words").alias("b")), "v"))
    common = F.size(F.array_intersect("a", "b"))
    a, c = similarity
    linked = common * c >= (F.size("a") + F.size("b") - common) * a
    return materialize(both.filter(linked).select("u", "v"), "links")


def join_documents(docs: DataFrame, n: int = WORDS, similarity: tuple[int, int] = SIMILARITY,
                   seed: int = SEED) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) for every row."""
    texts = documents(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    total = texts.count()
    narrow = total <= NARROW
    found = materialize(_index(texts, n, similarity, seed, total).repartition("k").sortWithinPartitions("k", F.col("w").desc(), "v")
                        .mapInArrow(_candidates(similarity, narrow), INDEX_SCHEMA), "candidates")
    release(texts.sparkSession)
    is_text = f"w < 0 and w > {PAIR}"
    rows = found.filter(is_text).select(F.col("k").alias("doc_id"), F.col("v").alias("node"), (-1 - F.col("w")).alias("size"))
    sketches = materialize(found.filter(f"{is_text} and s is not null").groupBy(F.col("v").alias("node")).agg(
        F.first("s").alias("sketch"), F.max(-1 - F.col("w")).alias("size")), "sketches")
    met = found.filter(f"w < {PAIR}")
    met = met.groupBy("k") if narrow else met.groupBy("k", "v")
    pairs = met.agg(F.count("*").alias("n"), F.min(F.lit(PAIR) - F.col("w")).alias("asked")).filter("n >= asked")
    if narrow:                                                  # nodes that are shortened alike: a few candidates more
        half = materialize(pairs.select(F.shiftright("k", 32).alias("us"), F.col("k").bitwiseAND(SHORT).alias("vs")), "halves")
        ends = sketches.select(F.shiftright("node", 1).bitwiseAND(SHORT).alias("half"), "node")
        pairs = half.join(ends.select(F.col("half").alias("us"), F.col("node").alias("x")), "us").join(
            ends.select(F.col("half").alias("vs"), F.col("node").alias("y")), "vs").filter("x <> y").select(
            F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v"))
    else:
        pairs = pairs.select(F.col("k").alias("u"), "v")
    links = _verified(materialize(_near(pairs, sketches, similarity), "pairs"), texts, n, similarity)
    release(texts.sparkSession)
    roots = materialize(components(links), "roots")

    members = found.filter("w > 0").select("k", F.col("v").alias("node"))
    split = members.groupBy("k").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")).filter("chunks > 1")
    spanning = True
    for done in range(SPANNING + 1):
        known = sketches.join(roots, "node", "left").select("node", "size", "sketch", F.coalesce("root", "node").alias("root"))
        dealt = (members.join(split, "k", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
                 .withColumn("chunk", F.pmod(F.hash("node"), F.col("chunks")))
                 .join(known, "node")
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
                 .select("k", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"),
                         "chunk", "node", "root", "size", "sketch"))
        spanning = spanning and done < SPANNING
        across = materialize(dealt.repartition("k", "lo", "hi").sortWithinPartitions("k", "lo", "hi", "node")
                             .mapInArrow(_across(similarity, spanning), "u long, v long").distinct(), "across")
        release(texts.sparkSession)
        if across.limit(1).count() == 0:
            break
        more = _verified(across, texts, n, similarity)
        linked = more.limit(1).count() > 0
        if linked:
            links = links.union(more)
            roots = materialize(components(links), "roots")
        if not spanning:
            break
        spanning = linked

    real = F.when(F.col("doc_id") != NULL_ID, F.col("doc_id"))
    nodes = rows.filter("size > 0").groupBy("node").agg(F.min(real).alias("least"))
    nodes = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    place = materialize(nodes.join(least, "root").select("node", "component_id"), "place")
    return (rows.join(place, "node", "left")
            .select(real.alias("doc_id"), F.col("size").alias("n_shingles"),
                    F.when(F.col("size") == 0, real).otherwise(F.col("component_id")).alias("component_id")))


def deduplicate(docs: DataFrame, n: int = WORDS, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id.

    Rows that share an id stay or go together; of rows that share id and text one stays.
    """
    joined = materialize(join_documents(docs, n, similarity).groupBy("doc_id").agg(
        F.max(F.col("component_id").eqNullSafe(F.col("doc_id"))).alias("first"), F.count("*").alias("rows")), "kept")
    gone = joined.filter("not first").select(F.col("doc_id").alias("other_id"))
    out = docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["other_id"]), "left_anti")
    several = joined.filter("first and rows > 1").select(F.col("doc_id").alias("other_id"))
    if several.limit(1).count() == 0:
        return out
    match = out["doc_id"].cast("long").eqNullSafe(several["other_id"])
    once = out.join(several, match, "left_semi").dropDuplicates(["doc_id", "text"])
    return out.join(several, match, "left_anti").unionByName(once)
