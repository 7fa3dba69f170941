"""Near-duplicate embeddings: every pair of one label at a cosine, by tiles in principal order.

Vectors are scaled to length one and rotated onto the principal directions of
their second moments, so leading dimensions carry most of every product.
Equal vectors are one node.  Nodes are ordered by label and by a cell of their
leading dimensions, ranges of that order are cut into tiles of at most TILE
nodes.  Two tiles of a label are compared only if the boxes around their
leading dimensions come as near as the cosine asks (|a - b|^2 = 2 - 2 cos).
Inside a pair of tiles the leading products are accumulated first; what the
other dimensions can still add is at most the product of the suffix norms, so
a pair stops as soon as partial sum plus that bound is below the cosine.  The
few pairs within 1e-9 of the cosine are decided on the given components.

No pair of nodes leaves a task: a pair of tiles yields one row for each linked
node, its number of links there and one node of its piece; so a group of m
close vectors costs rows in proportion to m and the tiles it spans.  What the
driver gathers are d * d moments (above MOST_ROTATED dimensions only the d
mean squares, which still order them).

A vector that is null, zero or holds null or non-finite components, and a row
with a null label, links with nothing: no links, its own component, kept.
Vectors of different lengths have no cosine and don't link.  Equal rows are
linked copies of each other.  A null vec_id takes part; the component of rows
is null only if all their ids are, and a null id is kept only there.  Rows
that share vec_id and component are kept or dropped together.  An empty table
gives no rows.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import materialize, row_ids
from stellate.llm.components import components
from stellate.llm.whitening import vectors

COSINE = 0.98
TILE = 2048
#: Dimensions accumulated first, and those whose boxes are compared.
LEADING = 16
MOST_ROTATED = 1024
#: Tiles of one label whose boxes one task compares with as many others.
CHUNK = 256
SLACK = 1e-9


def units(values: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, without overflow or underflow on the way."""
    scaled = values / np.abs(values).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _packed(values: np.ndarray) -> list[bytes]:
    """Components as they came: 4 bytes each where all of a row's fit a float, else 8."""
    with np.errstate(over="ignore"):
        small = values.astype("<f4")
    fits = (small == values).all(axis=1)
    return [b"\4" + small[i].tobytes() if ok else b"\10" + values[i].astype("<f8").tobytes() for i, ok in enumerate(fits)]


def _unpacked(raw: list[bytes], d: int) -> np.ndarray:
    out = np.empty((len(raw), d))
    wide = np.array([b[0] for b in raw]) == 8
    for kind, at in (("<f8", np.flatnonzero(wide)), ("<f4", np.flatnonzero(~wide))):
        if len(at):
            out[at] = np.frombuffer(b"".join(raw[i][1:] for i in at), kind).reshape(len(at), d)
    return out


def _usable(vecs: DataFrame) -> DataFrame:
    """vec_id, label, d, node (hash of the vector; null if the row links with nothing) and components of every row."""
    kind = vecs.schema["label"].dataType.simpleString()

    def run(batches):
        for b in batches:
            node: list[bytes | None] = [None] * b.num_rows
            raw: list[bytes | None] = [None] * b.num_rows
            size, rows, matrices = vectors(b.column("embedding"))
            labelled = b.column("label").is_valid().to_numpy(zero_copy_only=False)
            for at, values in zip(rows, matrices):
                values = values + 0.0                           # no negative zeros
                for i, x, some in zip(at.tolist(), _packed(values), values.any(axis=1)):
                    if some and labelled[i]:
                        node[i], raw[i] = hashlib.blake2b(x, digest_size=16).digest(), x
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array(size.astype(np.int32)), pa.array(node, pa.binary()),
                 pa.array(raw, pa.binary())], ["vec_id", "label", "d", "node", "raw"])

    return vecs.select(F.col("vec_id").cast("long"), "label", "embedding").mapInArrow(
        run, f"vec_id long, label {kind}, d int, node binary, raw binary")


class Rotation:
    """The principal directions of the unit vectors' second moments, leading ones first, for rows of at most d entries."""

    def __init__(self, nodes: DataFrame, d: int):
        self.d = d
        whole = d <= MOST_ROTATED

        def run(batches):
            total, mean, n = np.zeros((d, d) if whole else d), np.zeros(d), 0
            for _, u in _units(batches):
                k = u.shape[1]
                if whole:
                    total[:k, :k] += u.T @ u
                else:
                    total[:k] += (u * u).sum(axis=0)
                mean[:k] += u.sum(axis=0)
                n += len(u)
            i, j = np.triu_indices(d) if whole else (np.arange(d), np.arange(d))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([i, np.full(d, -1), [-2]]).astype(np.int32)),
                 pa.array(np.concatenate([j, np.arange(d), [0]]).astype(np.int32)),
                 pa.array(np.concatenate([total[i, j] if whole else total, mean, [n]]).astype(float))], ["i", "j", "s"])

        moment, mean, self.n = np.zeros((d, d) if whole else d), np.zeros(d), 0
        for i, j, s in nodes.select("d", "raw").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s")).collect():
            if i == -2:
                self.n = int(s)
            elif i == -1:
                mean[j] = s
            elif whole:
                moment[i, j] = moment[j, i] = s
            else:
                moment[i] = s
        n = max(self.n, 1)
        if whole:
            value, self.matrix = np.linalg.eigh(moment / n)
            self.matrix = np.ascontiguousarray(self.matrix[:, ::-1])
            value, mean = value[::-1], self.matrix.T @ mean / n
            self.order = None
        else:
            self.order, self.matrix = np.argsort(-moment, kind="stable"), None
            value, mean = moment[self.order] / n, mean[self.order] / n
        self.mean, self.spread = mean, np.sqrt(np.maximum(value - mean * mean, 0))

    def turn(self, u: np.ndarray) -> np.ndarray:
        if self.matrix is not None:
            return u @ self.matrix[:u.shape[1]]
        out = np.zeros((len(u), self.d))
        out[:, :u.shape[1]] = u
        return out[:, self.order]

    def cells(self, bits: int) -> list[tuple[int, list[float]]]:
        """(dimension, cuts): 2^bits cells in all, the widest dimension halved again and again at a normal's quantiles."""
        width, parts = self.spread[:LEADING].copy(), np.zeros(min(self.d, LEADING), int)
        for _ in range(bits):
            k = int(width.argmax())
            parts[k] += 1
            width[k] /= 2
        return [(k, [self.mean[k] + self.spread[k] * NormalDist().inv_cdf(q / (1 << p)) for q in range(1, 1 << p)])
                for k, p in enumerate(parts.tolist()) if p]


def _units(batches):
    """(rows of one length, their unit vectors) of batches with ``raw`` and ``d``."""
    for b in batches:
        size = b.column("d").to_numpy()
        for d in np.unique(size).tolist():
            part = b.filter(pa.array(size == d))
            yield part, units(_unpacked(part.column("raw").to_pylist(), d))


def _placed(nodes: DataFrame, turn: Rotation, tile: int) -> DataFrame:
    """Nodes with the cell of their leading dimensions and the first of them."""
    bits = max(0, (turn.n // tile).bit_length() + 2) if turn.n > tile else 0
    cuts = turn.cells(min(bits, 60))

    def run(batches):
        for part, u in _units(batches):
            y = turn.turn(u)
            cell = np.zeros(len(u), np.int64)
            for k, at in cuts:
                cell = cell * (len(at) + 1) + np.searchsorted(at, y[:, k])
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell), pa.array(y[:, 0])], [*part.schema.names, "cell", "lead"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
    return nodes.mapInArrow(run, schema + ", cell long, lead double")


def _tiles(placed: DataFrame, turn: Rotation, tile: int) -> DataFrame:
    """Runs of at most ``tile`` nodes of one label and length; nodes are numbered from the tile's number on."""
    kind = placed.schema["label"].dataType.simpleString()
    names = ["tile", "label", "d", "n", "copies", "node", "raw", "low", "high"]

    def made(ids, rows):
        d = rows.column("d")[0].as_py()
        raw = rows.column("raw").to_pylist()
        lead = turn.turn(units(_unpacked(raw, d)))[:, :LEADING]
        return pa.RecordBatch.from_arrays(
            [pa.array([ids.take(rows.num_rows).start]), rows.column("label").slice(0, 1).combine_chunks(),
             pa.array([d], pa.int32()), pa.array([rows.num_rows]),
             pa.array([rows.column("copies").to_numpy().astype("<i8").tobytes()]), pa.array([b"".join(rows.column("node").to_pylist())]),
             pa.array([raw], pa.list_(pa.binary())),
             pa.array([lead.min(axis=0).tolist()]), pa.array([lead.max(axis=0).tolist()])], names)

    def run(batches):
        ids, held = row_ids(), None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            group, start = held.column("label").to_pylist(), 0
            size = held.column("d").to_pylist()
            for i in range(1, held.num_rows + 1):
                over = i < held.num_rows and (group[i] != group[start] or size[i] != size[start])
                if over or i - start == tile:
                    yield made(ids, held.slice(start, i - start))
                    start = i
            held = held.slice(start)
        if held is not None and held.num_rows:
            yield made(ids, held)

    order = ["label", "d", "cell", "lead", "node"]
    return (placed.repartitionByRange(*order).sortWithinPartitions(*order).select("label", "d", "copies", "node", "raw")
            .mapInArrow(run, f"tile long, label {kind}, d int, n long, copies binary, node binary, raw array<binary>, "
                             "low array<double>, high array<double>"))


def _tile_pairs(tiles: DataFrame, cosine: float) -> DataFrame:
    """(a, b) for the tiles of one label whose boxes come near enough, a tile with itself among them.

    A label's tiles are dealt out in pairs of chunks, so a task holds two chunks of boxes.
    """
    most = 2 - 2 * cosine + SLACK

    def near(t: pa.Table) -> pa.Table:
        side, tile = t.column("other").to_numpy(), t.column("tile").to_numpy()
        low = np.array(t.column("low").to_pylist())
        high = np.array(t.column("high").to_pylist())
        one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(two):
            two = one
        a, b = [], []
        for i in one.tolist():
            gap = np.maximum(np.maximum(low[i] - high[two], low[two] - high[i]), 0)
            ok = (gap * gap).sum(axis=1) <= most
            if two is one:
                ok &= tile[two] >= tile[i]
            a.append(np.full(int(ok.sum()), tile[i]))
            b.append(tile[two][ok])
        return pa.table({"a": np.concatenate(a or [tile[:0]]), "b": np.concatenate(b or [tile[:0]])})

    boxes = tiles.select("tile", "label", "d", "low", "high")
    chunks = boxes.groupBy("label", "d").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    dealt = (boxes.join(chunks, ["label", "d"])
             .withColumn("chunk", F.pmod(F.xxhash64("tile"), F.col("chunks")).cast("int"))
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("label", "d", F.least("chunk", "with").alias("lo"), F.greatest("chunk", "with").alias("hi"),
                     (F.col("chunk") > F.col("with")).cast("int").alias("other"), "tile", "low", "high"))
    return dealt.groupBy("label", "d", "lo", "hi").applyInArrow(near, "a long, b long")


def linked(one: np.ndarray, two: np.ndarray, cosine: float, leading: int = LEADING) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, cosine) of pairs of rows that reach ``cosine`` less SLACK; rotated unit vectors, leading dimensions first.

    The residual norm stands as one more dimension of the first product: its entries are bounds on the cosine.
    """
    least, d = cosine - SLACK, one.shape[1]

    def suffix(y, k):
        return np.sqrt(np.maximum((y[:, k:] * y[:, k:]).sum(axis=1), 0))

    k = min(leading, d)
    bound = np.column_stack([one[:, :k], suffix(one, k)]) @ np.column_stack([two[:, :k], suffix(two, k)]).T
    i, j = np.nonzero(bound >= least)
    if len(i) * 16 > bound.size:                                # most pairs go on: all products at once
        whole = one @ two.T
        i, j = np.nonzero(whole >= least)
        return i, j, whole[i, j]
    partial = np.einsum("ij,ij->i", one[i, :k], two[j, :k])
    while k < d:
        upto = min(2 * k, d)
        partial += np.einsum("ij,ij->i", one[i, k:upto], two[j, k:upto])
        k = upto
        go = partial + suffix(one, k)[i] * suffix(two, k)[j] >= least
        i, j, partial = i[go], j[go], partial[go]
    return i, j, partial


def pieces(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest node of each node's piece under the links (u, v)."""
    root = np.arange(n)
    while len(u):
        least = np.minimum(root[u], root[v])
        np.minimum.at(root, root[u], least)
        np.minimum.at(root, root[v], least)
        while (root[root] != root).any():
            root = root[root]
        go = root[u] != root[v]
        u, v = u[go], v[go]
    return root


def _compare(turn: Rotation, cosine: float):
    """Of the one or two tiles of a pair: (u, number of rows linked, a node of the same piece) for each linked node."""
    def run(t: pa.Table) -> pa.Table:
        tiles = []
        for i in np.argsort(t.column("tile").to_numpy()).tolist():
            given = _unpacked(t.column("raw")[i].as_py(), t.column("d")[i].as_py())
            copies = np.frombuffer(t.column("copies")[i].as_py(), "<i8")
            tiles.append((t.column("tile")[i].as_py(), given, turn.turn(units(given)), copies))
        (a, x, one, w1), (b, z, two, w2) = tiles[0], tiles[-1]
        i, j, value = linked(one, two, cosine)
        if len(tiles) == 1:
            i, j, value = (q[i < j] for q in (i, j, value))
        sure = value > cosine + SLACK
        for k in np.flatnonzero(~sure).tolist():                # too near to call: the components themselves
            p, q = x[i[k]], z[j[k]]
            p, q = p / np.abs(p).max(), q / np.abs(q).max()
            sure[k] = float(p @ q) / (float(np.sqrt(p @ p)) * float(np.sqrt(q @ q))) >= cosine
        i, j = i[sure], j[sure]
        number = np.arange(a, a + len(x))
        if len(tiles) == 2:
            number, j, w1 = np.concatenate([number, np.arange(b, b + len(z))]), j + len(x), np.concatenate([w1, w2])
        links = np.zeros(len(number), np.int64)
        np.add.at(links, i, w1[j])
        np.add.at(links, j, w1[i])
        root = pieces(len(number), i, j)
        at = np.flatnonzero(links)
        return pa.table({"u": number[at], "n": links[at], "v": number[root[at]]})

    return run


def near_duplicates(vecs: DataFrame, cosine: float = COSINE, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vecs`` (vec_id, embedding, label)."""
    rows = materialize(_usable(vecs), "rows")
    nodes = materialize(rows.filter("node is not null").groupBy("label", "d", "node", "raw").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("least")), "nodes")
    d = nodes.agg(F.max("d")).first()[0] or 0
    alone = (F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if not d:
        return rows.select("vec_id", *alone)
    turn = Rotation(nodes, d)
    tiles = materialize(_tiles(_placed(nodes.select("label", "d", "copies", "node", "raw"), turn, tile), turn, tile), "tiles")
    pairs = materialize(_tile_pairs(tiles, cosine), "tile-pairs")
    sides = pairs.withColumn("tile", F.explode(F.array_distinct(F.array("a", "b"))))
    found = materialize(sides.join(tiles.select("tile", "d", "copies", "raw"), "tile")
                        .groupBy("a", "b").applyInArrow(_compare(turn, cosine), "u long, n long, v long"), "found")

    def numbered(batches):
        for b in batches:
            for i in range(b.num_rows):
                first, raw = b.column("tile")[i].as_py(), b.column("node")[i].as_py()
                n = len(raw) // 16
                yield pa.RecordBatch.from_arrays(
                    [b.column("label").take(pa.array(np.full(n, i))), b.column("d").take(pa.array(np.full(n, i))),
                     pa.array([raw[16 * k:16 * k + 16] for k in range(n)], pa.binary()), pa.array(np.arange(first, first + n))],
                    ["label", "d", "node", "u"])

    kind = tiles.schema["label"].dataType.simpleString()
    numbers = tiles.select("tile", "label", "d", "node").mapInArrow(numbered, f"label {kind}, d int, node binary, u long")
    links = found.groupBy("u").agg(F.sum("n").alias("n"))
    roots = components(found.select("u", "v")).select(F.col("node").alias("u"), "root")
    group = ["label", "d", "node"]
    known = (nodes.drop("raw").join(numbers, group).join(links, "u", "left").join(roots, "u", "left")
             .select(*group, "copies", "least", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("root", "u").alias("root")))
    known = materialize(known, "known")
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    place = known.join(least, "root").select(*group, "component_id", (F.col("n") + F.col("copies") - 1).alias("n_links"))
    usable = rows.filter("node is not null").drop("raw").join(place, group)
    return usable.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")).union(
        rows.filter("node is null").select("vec_id", *alone))
