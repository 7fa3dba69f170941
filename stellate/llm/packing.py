"""Best-fit packing of token pieces into sequences, improved by swaps.

Documents are tokenised once (distinct whitespace chunks go through the
tokenizer, repeated ones come from a table), cut into pieces of at most
``capacity`` tokens and written without their text.  Pieces are dealt at
random into groups of a bounded number; a group is packed best-fit from the
longest piece on, then a local search moves pieces or exchanges one for one
or two for one between underfull bins.  Every step raises the sum of squared
fills, and a bin that has become empty is dropped.  Pieces of bins that are
still underfull meet again in fewer groups, until one group is left or most
of a round's pieces stay underfull for a second time.

Null text counts as empty: one piece holding only the closing id.  Repeated
rows and null or repeated ids are packed as separate pieces; an empty table
gives no rows.
"""

from __future__ import annotations

import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm import scan
from stellate.llm.common import column_type, documents, materialize, row_ids

CAPACITY = 2048
GROUP_ROWS = 8192
SLACK = 0.01
END_ID = 0
CACHE_CHUNKS = 400_000
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
#: ASCII marks that never share a token with an ASCII letter (an apostrophe may).
MARK = ~scan.NON_ALNUM | scan.WS
MARK = ~MARK
MARK[[0x27, *range(0x20), 0x7F]] = False
CHECKED_TEXTS = 4
#: Fixed value: how byte-level BPE cuts a text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Lead bytes of white space outside ASCII: such texts go through the tokenizer whole.
WIDE_SPACE = ((0xC2, 0x85), (0xC2, 0xA0), (0xE1, 0x9A), (0xE2, 0x80), (0xE2, 0x81), (0xE3, 0x80))


def _ranks(tokenizer):
    """The byte-level BPE of a ``tokenizers`` file as ranks (ids follow merge order)."""
    import tiktoken
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in printable}
    byte.update((chr(256 + k), b) for k, b in enumerate(b for b in range(256) if b not in set(printable)))
    vocabulary = {t: i for t, i in tokenizer.get_vocab(with_added_tokens=False).items() if all(c in byte for c in t)}
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, special_tokens={},
                             mergeable_ranks={bytes(byte[c] for c in t): i for t, i in vocabulary.items()
                                              if t not in special})


class Encoder:
    """Token ids of whole texts, by encoding each distinct chunk once.

    A chunk is a run of other characters with the single space before it, or
    white space, cut again between ASCII letters and marks; the pre-tokenizer
    never looks across these borders, so concatenated chunk ids equal the ids
    of the text.  An added token is a chunk, and what lies between two is cut
    like a text of its own.  These tokens, and texts with white space outside
    ASCII, go through the tokenizer itself; other chunks are merged by the same
    vocabulary in its rank form, which is held against the tokenizer on the
    first texts of a task.
    """

    def __init__(self, path: str):
        import os

        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        added = list(self.tokenizer.get_added_tokens_decoder().values())
        longest_first = sorted((t.content.encode() for t in added), key=len, reverse=True)
        self.added = re.compile(b"|".join(map(re.escape, longest_first)) or rb"(?!)")
        self.alone = not any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added)
        self.ranks = _ranks(self.tokenizer)
        self.token_bytes = np.zeros(self.ranks.n_vocab, np.int64)
        for token in self.ranks.token_byte_values():
            self.token_bytes[self.ranks.encode_single_token(token)] = len(token)
        self.unchecked = CHECKED_TEXTS
        self._clear()

    def _clear(self):
        self.key = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def added_tokens(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, end) of the added tokens; of the whole texts that hold one, if they take in what is around them."""
        raw = data.tobytes()
        found = []
        if self.added.search(raw):
            for a, b in itertools.pairwise(offs.tolist()):
                spans = [m.span() for m in self.added.finditer(raw, a, b)]
                found += spans if self.alone or not spans else [(a, b)]
        found = np.array(found, np.int64).reshape(-1, 2)
        return found[:, 0], found[:, 1]

    @staticmethod
    def chunks(data: np.ndarray, offs: np.ndarray, added: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start of every chunk; which chunks are whole: those from ``added`` on, and with white space outside ASCII."""
        n = len(data)
        ws = scan.WS[data]
        start = np.zeros(n + 1, bool)
        start[offs] = True
        before = np.zeros(n, bool)
        before[1:] = ws[:-1] & ~start[1:n]
        after = np.zeros(n, bool)
        after[:-1] = ~ws[1:] & ~start[1:n]
        cut = ws & ~before
        last = ws & after
        cut |= last
        follows = np.flatnonzero(last & (data != 32)) + 1
        cut[follows] = True
        letter, mark = LETTER[data], MARK[data]
        cut[1:] |= (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
        wide = np.zeros(n, bool)
        for a, b in WIDE_SPACE:
            wide[:-1] |= (data[:-1] == a) & (data[1:] == b)
        wide[added] = True
        whole = np.zeros(n, bool)
        for d in np.unique(np.searchsorted(offs, np.flatnonzero(wide), "right") - 1):
            cut[offs[d]:offs[d + 1]] = False
            whole[offs[d]] = True
        at = np.flatnonzero(cut | start[:n])
        return at, whole[at]

    def _merge(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids by chunk, all ids) of chunks without white space but a first space.

        One call over all of them, a line feed between two: it is always a token of its own there.
        """
        place = np.cumsum(size + 1) - size - 1
        text = np.full(int(size.sum()) + len(size), 10, np.uint8)
        text[scan.ragged(place, size)] = data[scan.ragged(start, size)]
        ids = np.array(self.ranks.encode_ordinary(text.tobytes().decode("utf-8")), np.uint32)
        feed = np.searchsorted(np.cumsum(self.token_bytes[ids]), place + size + 1)
        keep = np.ones(len(ids), bool)
        keep[feed] = False
        return np.diff(feed, prepend=-1) - 1, ids[keep]

    def _add(self, new: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray, odd: np.ndarray) -> None:
        tail = data[start + size - 1]
        whole, odd = odd, odd | scan.WS[tail] | (size > 256) | scan.WS[data[start]] & (data[start] != 32)
        count, ids = self._merge(data, start[~odd], size[~odd])
        rest = [np.array(self.tokenizer.encode(text, add_special_tokens=False).ids if w
                         else self.ranks.encode_ordinary(text), np.uint32)
                for w, text in ((w, data[s:s + n].tobytes().decode("utf-8"))
                                for s, n, w in zip(start[odd], size[odd], whole[odd]))]
        count = np.concatenate([count, np.array([len(r) for r in rest], np.int64)])
        key = np.concatenate([self.key, new[~odd], new[odd]])
        order = np.argsort(key, kind="stable")
        self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(count) - count])[order]
        self.size = np.concatenate([self.size, count])[order]
        self.ids = np.concatenate([self.ids, ids, *rest])
        self.key = key[order]

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets by text)."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        first, last = self.added_tokens(data, offs)
        start, whole = self.chunks(data, np.unique(np.concatenate([offs, first, last])), first)
        end = np.append(start[1:], len(data))
        unique, first, inverse = np.unique(scan.hashes(data, start, end), return_index=True, return_inverse=True)
        if len(self.key) > CACHE_CHUNKS:
            self._clear()
        at = np.searchsorted(self.key, unique)
        new = np.ones(len(unique), bool)
        inside = at < len(self.key)
        new[inside] = self.key[at[inside]] != unique[inside]
        if new.any():
            f = first[new]
            self._add(unique[new], data, start[f], end[f] - start[f], whole[f])
            at = np.searchsorted(self.key, unique)
        row = at[inverse]
        size = self.size[row]
        total = np.concatenate([[0], np.cumsum(size)])
        out, bound = self.ids[scan.ragged(self.first[row], size)], total[np.searchsorted(start, offs)]
        for d in range(min(self.unchecked, len(offs) - 1)):
            text = data[offs[d]:min(offs[d + 1], offs[d] + 65536)].tobytes().decode("utf-8", "ignore")
            want = self.tokenizer.encode(text, add_special_tokens=False).ids
            if offs[d + 1] - offs[d] <= 65536 and want != out[bound[d]:bound[d + 1]].tolist():
                raise ValueError("the vocabulary's rank form disagrees with its tokenizer")
            self.unchecked -= 1
        return out, bound


def tokenized(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and a random number."""
    def run(batches):
        encoder, rows = Encoder(tokenizer_path), row_ids()
        for part, data, offs in scan.blocks(batches):
            ids, bound = encoder.encode(data, offs)
            which, piece, start, length, crc = [], [], [], [], []
            for d in range(part.num_rows):
                own = np.append(ids[bound[d]:bound[d + 1]], np.uint32(END_ID)).astype("<u4")
                n = len(own)
                cuts = [0, *range(n % capacity or capacity, n, capacity), n]
                for k in range(len(cuts) - 1):
                    which.append(d)
                    piece.append(k)
                    start.append(cuts[k])
                    length.append(cuts[k + 1] - cuts[k])
                    crc.append(zlib.crc32(own[cuts[k]:cuts[k + 1]].tobytes()))
            salt = scan.mix64(np.array(rows.take(len(which)), np.uint64)) >> np.uint64(1)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(which, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                 pa.array(salt.astype(np.int64))],
                ["doc_id", "piece", "start", "length", "ids_crc32", "salt"])

    return documents(docs).mapInArrow(
        run, f"doc_id {column_type(docs, 'doc_id')}, piece int, start long, length long, ids_crc32 long, salt long")


def best_fit(length: list[int], capacity: int) -> list[list[int]]:
    """Bins (lists of item numbers), longest item first, each into the fullest bin that takes it."""
    bins: list[list[int]] = []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    room = 0                                   # bit r set: some bin has r tokens left
    for i in sorted(range(len(length)), key=lambda i: -length[i]):
        size = length[i]
        fits = room >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            b = open_bins[r].pop()
            if not open_bins[r]:
                room ^= 1 << r
            bins[b].append(i)
        else:
            r, b = capacity, len(bins)
            bins.append([i])
        r -= size
        if r:
            open_bins[r].append(b)
            room |= 1 << r
    return bins


def local_search(length: list[int], bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Empty underfull bins by moves and swaps that raise the sum of squared fills.

    Takes the emptiest bin as source until it is empty or no step helps, then
    the next one.  Each step raises the sum, which is bounded, so it ends.
    """
    least = -(-sum(length) // capacity)
    if len(bins) <= least:
        return bins
    fills = [sum(length[i] for i in b) for b in bins]
    closed = [b for b, f in zip(bins, fills) if f == capacity]
    work = [b for b, f in zip(bins, fills) if f < capacity]
    item = np.array([i for b in work for i in b])
    size = np.array(length)[item]
    owner = np.repeat(np.arange(len(work)), [len(b) for b in work])
    fill = np.array([f for f in fills if f < capacity])
    live = len(work)
    gained = True
    while gained and len(closed) + live > least:
        gained = False
        for source in np.argsort(fill, kind="stable"):
            if len(closed) + live <= least:
                break
            if not fill[source]:
                continue
            while fill[source] and _step(int(source), size, owner, fill, capacity):
                pass
            if not fill[source]:
                live -= 1
                gained = True
    order = np.argsort(owner, kind="stable")
    parts = np.split(item[order], np.cumsum(np.bincount(owner, minlength=len(work)))[:-1])
    return closed + [p.tolist() for p in parts if len(p)]


def _step(source: int, size: np.ndarray, owner: np.ndarray, fill: np.ndarray, capacity: int) -> bool:
    """One move, one-for-one or two-for-one exchange out of ``source``; False if none raises squared fill."""
    mine = fill[source]
    own = np.flatnonzero(owner == source)
    able = (fill < capacity) & (fill > 0)
    able[source] = False
    for a in own[np.argsort(-size[own], kind="stable")]:
        fits = np.flatnonzero(able & (fill + size[a] <= capacity) & (fill + size[a] > mine))
        if len(fits):
            to = fits[np.argmax(fill[fits])]
            owner[a] = to
            fill[to] += size[a]
            fill[source] -= size[a]
            return True
    theirs = np.flatnonzero((able & (fill >= mine))[owner])
    if not len(theirs):
        return False
    value = size[theirs]
    limit = capacity - fill[owner[theirs]]

    def exchange(out: list[int]) -> bool:
        give = int(size[out].sum())
        gain = give - value
        gain[(gain > limit) | (gain <= 0)] = 0
        at = int(np.argmax(gain))
        if not gain[at]:
            return False
        back, to = theirs[at], owner[theirs[at]]
        owner[out] = to
        owner[back] = source
        fill[to] += gain[at]
        fill[source] -= gain[at]
        return True

    distinct = dict(zip(size[own].tolist(), own.tolist()))
    for _, a in sorted(distinct.items(), reverse=True):
        if exchange([a]):
            return True
    pairs: dict[int, list[int]] = {}
    for x, a in enumerate(own.tolist()):
        for b in own[x + 1:].tolist():
            pairs.setdefault(int(size[a] + size[b]), [a, b])
    return any(exchange(pair) for _, pair in sorted(pairs.items(), reverse=True))


def _packer(capacity: int, number: int):
    """Packs the rows of one group (``number`` is the round)."""
    def run(t):
        length = t.column("length").to_pylist()
        group = t.column("group")[0].as_py()
        bins = local_search(length, best_fit(length, capacity), capacity)
        order, sequence, offset, underfull = [], [], [], []
        for k, b in enumerate(bins):
            at, fill = 0, sum(length[i] for i in b)
            for i in b:
                order.append(i)
                sequence.append((number << 56) | (group << 20) | k)
                offset.append(at)
                underfull.append(capacity - fill > SLACK * capacity)
                at += length[i]
        t = t.drop_columns(["group"]).take(pa.array(order, pa.int64()))
        return (t.append_column("sequence_id", pa.array(sequence, pa.int64()))
                .append_column("offset", pa.array(offset, pa.int64()))
                .append_column("underfull", pa.array(underfull, pa.bool_())))
    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Add sequence_id and offset to written ``pieces`` (length at most ``capacity``, salt)."""
    done, rest = [], pieces
    count, number, stuck = rest.count(), 0, False
    names = pieces.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    while True:
        groups = max(1, -(-count // group_rows))
        packed = materialize(
            rest.withColumn("group", F.pmod(F.xxhash64("salt", F.lit(number)), F.lit(groups))).groupBy("group")
            .applyInArrow(_packer(capacity, number), f"{kinds}, sequence_id long, offset long, underfull boolean"),
            f"packed{number}")
        left = packed.filter("underfull").count() if groups > 1 else 0
        if groups == 1 or stuck and 2 * left > count:
            done.append(packed)
            break
        stuck = stuck or 2 * left > count
        done.append(packed.filter("not underfull"))
        rest = packed.filter("underfull").select(names)
        count, number = left, number + 1
    out = done[0]
    for df in done[1:]:
        out = out.unionByName(df)
    return out.drop("salt", "underfull")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
                   group_rows: int = GROUP_ROWS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(materialize(tokenized(docs, tokenizer_path, capacity), "pieces"), capacity, group_rows)
