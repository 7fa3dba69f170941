"""Benchmark decontamination by templates.

Numbers become a typed placeholder, units after a number another, and, in a
second form of each text, capitalised words a third.  Windows of template
tokens are hashed and joined with the benchmark's windows.  A number with
separators and a run of names also count as one token each, so replacing a
value by a longer one keeps the windows over it.  Matches of one (text, item)
at one shift form an alignment, and so do those at nearby shifts together
(within half of the item; both of two overlapping grids of ranges are tried),
as insertions move the rest.  An alignment holds when every name or unit of
the item maps to one value of the text throughout (a name that turns into two
names is chance, one that is renamed everywhere is a re-parameterised
question; numbers are slots by position) and when it covers enough of the
item.  Windows with too few words
for a template (tables of values, sums) are matched as they stand, numbers
included, so every item has windows and a verbatim copy always matches.

The window hashes of the benchmark travel to the scan as a Bloom filter of
fixed size, which only thins out what is joined; the join itself is exact, so
a benchmark of any size works.  Items shorter than a window are one window.
Windows that many items hold are joined like the others.  An item that has
windows of its own matches by the tokens of these, or when nearly all of it
stands in the text as it is; an item without, like any other.  Of items that
match through shared windows a text names the nearest at each place.
Null texts count as empty and match nothing; rows with the same id are one
document; an empty table or benchmark gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stellate.llm import bits, scan
from stellate.llm.common import column_type, empty_text, materialize, row_ids

WINDOW = 8
LEAST_LITERAL = 4
LEAST_COVERED = 0.5
FILTER_BLOCKS = 1 << 17
#: The form of windows with too few literal tokens.
EXACT = 2
#: Windows that more items hold are shared: not counted as an item's own.
MOST_HOLDERS = 10
#: An alignment that keeps so much of the item as it stands needs no consistent slots.
LITERAL_ENOUGH = 0.8
#: A number in the windows of a family; hashes of numbers are odd as well.
MASKED = 1

NUMBER, UNIT, NAME = (np.uint64(x) for x in (0x11C4A35BD6D01CE5, 0x2B7E151628AED2A7, 0x3243F6A8885A308D))
#: Units and currencies, as written after a number.
UNITS = ("mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres centimeters "
         "kilometers mg g kg t lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons ml l liter "
         "liters litre litres gallon gallons ms s sec secs second seconds min mins minute minutes h hr hrs hour hours "
         "day days week weeks month months year years cent cents dollar dollars euro euros usd eur gbp percent mph kmh "
         "kph w kw kwh v a hz ghz mhz kb mb gb tb degrees celsius fahrenheit").split()


def _unit_hashes() -> np.ndarray:
    text = "".join(UNITS).encode()
    size = np.array([len(u) for u in UNITS])
    end = np.cumsum(size)
    return np.sort(scan.hashes(np.frombuffer(text, np.uint8), end - size, end, scan.LOWER))


def templates(data: np.ndarray, offs: np.ndarray):
    """Tokens as (text, first token, tokens covered, surface hash, template without names, with names, literal in each),
    first one by one, then with numbers joined over their separators, then runs of names as well.

    The lowest bit of a surface hash is set for numbers.
    """
    start, end, doc = scan.spans(data, offs, scan.NON_ALNUM)
    if not len(start):
        return
    folded = scan.fold(data)
    lead, tail = data[start], data[end - 1]
    number = (lead >= 48) & (lead < 58)
    known = _unit_hashes()
    second = data[np.minimum(start + 1, len(data) - 1)]
    lower = (second >= 97) & (second < 123) | (second >= 128) & (lead < 128)
    upper = (lead >= 65) & (lead < 91) | (lead == 0xC3) & (second >= 0x80) & (second < 0x9F)
    name = upper & (end - start > 1) & (lower | (lead == 0xC3))
    between = np.where((doc[1:] == doc[:-1]) & (start[1:] - end[:-1] == 1), data[end[:-1]], 0)
    figure = number[1:] & number[:-1] & (tail[:-1] >= 48) & (tail[:-1] < 58) & ((between == 0x2C) | (between == 0x2E))
    run = name[1:] & name[:-1] & scan.WS[between]
    none = np.zeros(len(figure), bool)
    for joined in (none, figure, figure | run):
        if joined is not none and not joined.any():
            continue
        at = np.flatnonzero(np.append(True, ~joined))
        width = np.diff(np.append(at, len(start)))
        own, n, who = doc[at], number[at], name[at]
        surface = scan.hashes(folded, start[at], end[at + width - 1])
        unit = np.zeros(len(at), bool)
        unit[1:] = n[:-1] & (own[1:] == own[:-1])
        unit &= known[np.minimum(np.searchsorted(known, surface), len(known) - 1)] == surface
        surface = surface & ~np.uint64(1) | n.astype(np.uint64)
        plain = np.where(n, NUMBER, np.where(unit, UNIT, surface))
        yield own, at, width, surface, plain, np.where(who, NAME, plain), ~(n | unit), ~(n | unit | who)


def _windows(data: np.ndarray, offs: np.ndarray, sizes: tuple[int, ...], whole_only: bool):
    """Windows (text, number of the first token, hash, surfaces, first token and width of each element, as it stands or not).

    Template windows with enough literal tokens, and the others as they stand; joined tokens only in
    windows that hold one.  ``sizes``: WINDOW, and the lengths of shorter items; ``whole_only``: shorter
    ones for whole texts only.
    """
    for doc, spot, width, surface, plain, named, literal, literal_named in templates(data, offs):
        count = np.bincount(doc, minlength=len(offs) - 1)
        wide = np.concatenate([[0], np.cumsum(width)])
        base = len(width) == wide[-1]
        for form, token, fixed in ((0, plain, literal), (1, named, literal_named), (EXACT, surface, literal)):
            if form == EXACT and not base:
                continue
            sums = np.concatenate([[0], np.cumsum(fixed)])
            for size in sizes:
                key, at = scan.windows(token, doc, size)
                keep = (sums[at + size] - sums[at] >= min(LEAST_LITERAL, size)) != (form == EXACT)
                if not base:
                    keep &= wide[at + size] - wide[at] > size
                if whole_only and size < WINDOW:
                    keep &= count[doc[at]] == size
                key, at = scan.mix64(key[keep] ^ np.uint64(size * 3 + form)), at[keep]
                yield doc[at], spot[at], size, key, at, surface, spot, width, form == EXACT


def _lists(values: np.ndarray, size: int, at: np.ndarray) -> pa.Array:
    bound = pa.array((np.arange(len(at) + 1) * size).astype(np.int32))
    return pa.ListArray.from_arrays(bound, pa.array(values))


def _rows(owner: pa.Array, place: np.ndarray, size: int, key: np.ndarray, surface: np.ndarray, at: np.ndarray):
    values = surface[scan.ragged(at, np.full(len(at), size))]
    return pa.RecordBatch.from_arrays(
        [owner, pa.array(place), pa.array(scan.signed(key)), _lists(scan.signed(values), size, at)],
        ["owner", "place", "key", "surfaces"])


def _tokens_of(windows: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and x (what ``windows`` say of an element) once for each token that the element covers."""
    zipped = [c for c in ("surfaces", "item_surfaces", "spots", "widths") if c in windows.columns]
    return (windows.select(*columns, F.explode(F.arrays_zip(*zipped)).alias("x"))
            .select(*columns, "x", F.explode(F.sequence("x.spots", F.col("x.spots") + F.col("x.widths") - 1)).alias("token")))


def _shared_windows(windows: DataFrame) -> DataFrame:
    """``windows`` with what items are judged by where many of them share windows; no window is left out.

    ``own``: at most MOST_HOLDERS items hold the window.  ``n_own``: the item's tokens less those that only shared
    windows cover.  ``n_shared``: its tokens that shared windows cover.
    """
    holders = windows.groupBy("key").agg(F.countDistinct("owner").alias("holders"))
    marked = windows.join(holders, "key").withColumn("own", F.col("holders") <= MOST_HOLDERS)
    covered = _tokens_of(marked, "owner", "own").groupBy("owner", "token").agg(
        F.max("own").alias("own"), F.min("own").alias("only_own"))
    items = covered.groupBy(F.col("owner").alias("of")).agg(
        F.max("own").alias("has_own"), F.count(F.when(~F.col("own"), 1)).alias("not_own"),
        F.count(F.when(~F.col("only_own"), 1)).alias("n_shared"))
    return marked.join(items, marked["owner"].eqNullSafe(items["of"])).select(
        *windows.columns, "own", (F.col("tokens") - F.col("not_own")).alias("n_own"), "n_shared", "has_own")


def _families(right: DataFrame, least_literal: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Items that shared windows alone can match, as families with the same shared windows but for numbers.

    Windows (item_id is the family's number, numbers are masked), members (family, item_id, n, and least, the
    smallest n), and numbers (family, item_id, token, number) of the members.
    """
    number = lambda x: x.bitwiseAND(1) == 1
    able = right.filter("not own").filter(~F.col("has_own") | (F.col("n_shared") >= F.lit(least_literal) * F.col("tokens")))
    masked = F.transform("item_surfaces", lambda x: F.when(number(x) & ~F.col("exact"), F.lit(MASKED)).otherwise(x))
    able = able.withColumn("masked", masked)
    length = F.when(F.max("has_own"), F.lit(0)).otherwise(F.max("tokens"))
    held = F.sort_array(F.collect_list(F.struct("item_place", "key", "masked", "spots", "widths")))
    members = able.groupBy(F.col("item_id").alias("of")).agg(
        F.xxhash64(F.max("has_own"), length, held).alias("family"), F.max("tokens").alias("n"))
    members = materialize(members.join(members.groupBy("family").agg(F.min("n").alias("least")), "family"), "families")
    able = able.join(members, able["item_id"].eqNullSafe(members["of"]))
    windows = able.groupBy(F.col("family").alias("item_id"), "item_place", "key").agg(
        *[F.first(c).alias(to) for c, to in (("masked", "item_surfaces"), ("spots", "spots"), ("widths", "widths"),
                                             ("least", "tokens"), ("has_own", "has_own"))])
    numbers = (_tokens_of(able.filter("not exact"), "family", "of").filter(number(F.col("x.item_surfaces")))
               .select("family", F.col("of").alias("item_id"), "token", F.col("x.item_surfaces").alias("number")).distinct())
    return windows, members.withColumnRenamed("of", "item_id"), numbers


def _by_families(found: DataFrame, right: DataFrame, least_covered: float, literal: float) -> tuple[DataFrame, DataFrame]:
    """The nearest members of each family that a text matches by shared windows, and the windows of the text it does so by."""
    windows, members, numbers = _families(right, literal)
    windows = materialize(windows, "family_windows")
    at = ["text_row", "item_id", "shift"]
    hits = _shifts(found.join(windows, "key"))
    aligned = _alignments(hits, [*at, "has_own"]).withColumnRenamed("n_item", "least")
    least = F.when(F.col("has_own"), F.lit(literal)).otherwise(F.lit(min(least_covered, literal)))
    aligned = materialize(aligned.filter(F.col("n_covered") >= least * F.col("least")), "family_alignments")
    hits = hits.join(aligned.select(*at), at, "left_semi")
    same = F.col("x.surfaces") == F.col("x.item_surfaces")
    put = (_tokens_of(hits, *at).groupBy(*at, "token")
           .agg(F.max(same).alias("same"), F.collect_set(F.when(F.col("x.item_surfaces") == MASKED, F.col("x.surfaces"))).alias("put"))
           .filter("not same").select(*at, "token", F.explode("put").alias("number")))
    of = ["text_row", "family", "shift"]
    equal = (put.withColumnRenamed("item_id", "family").join(numbers, ["family", "token", "number"])
             .groupBy(*of, "item_id").agg(F.countDistinct("token").alias("equal")))
    aligned = aligned.withColumnRenamed("item_id", "family")
    kept = F.col("n_covered") - F.col("n_changed") + F.col("equal")
    sizes = members.select(F.col("family").alias("in"), F.col("item_id").alias("of"), "n")
    some = equal.join(sizes, (equal["family"] == sizes["in"]) & equal["item_id"].eqNullSafe(sizes["of"])).drop("in", "of")
    some = some.join(aligned, of).withColumn("score", kept / F.col("n"))
    top = some.groupBy(*of).agg(F.max("score").alias("top"))
    none = (aligned.join(top, of, "left").withColumn("equal", F.lit(0).cast("long")).withColumn("score", kept / F.col("least"))
            .filter("top is null or score >= top").drop("top")
            .join(members.filter("n = least").drop("least"), "family"))
    near = some.unionByName(none).withColumn("top", F.max("score").over(Window.partitionBy(*of))).filter("score = top")
    enough = kept >= F.lit(literal) * F.col("n")
    enough = enough | (~F.col("has_own") & F.col("consistent") & (F.col("n_covered") >= F.lit(least_covered) * F.col("n")))
    near = materialize(near.filter(enough).select(
        *of, "item_id", "doc_id", F.col("n").alias("n_item"), "n_covered", (F.col("n_covered") - kept).alias("n_changed"),
        "has_own", "score").distinct(), "family_matches")
    used = hits.select(F.col("item_id").alias("family"), "text_row", "shift", "place").distinct().join(
        near.select(*of, "has_own", "score").distinct(), of)
    return near, used


def _shifts(hits: DataFrame) -> DataFrame:
    shift = F.col("place") - F.col("item_place")
    half = F.greatest(F.lit(WINDOW), F.floor(F.col("tokens") / 2))
    near = [F.struct(F.lit(k).alias("kind"), v.cast("long").alias("at")) for k, v in (
        (0, shift), (1, F.floor(shift / (2 * half))), (2, F.floor((shift + half) / (2 * half))))]
    return hits.withColumn("shift", F.explode(F.array(*near)))


def _alignments(hits: DataFrame, at: list[str]) -> DataFrame:
    """doc_id, n_item, n_covered, n_changed, consistent of each ``at`` (text, item, shift and what is the same for them)."""
    same = F.col("x.surfaces") == F.col("x.item_surfaces")
    pairs = (_tokens_of(hits, "doc_id", *at, "tokens")
             .groupBy(*at, "token")
             .agg(F.first("doc_id").alias("doc_id"), F.first("tokens").alias("tokens"),
                  F.max(F.when(same, F.col("x.surfaces"))).alias("kept"),
                  F.max(F.when(~same, F.col("x.surfaces"))).alias("put"),
                  F.max(F.when(~same, F.col("x.item_surfaces"))).alias("gone"))
             .withColumn("here", F.coalesce("kept", "put")).withColumn("there", F.coalesce("kept", "gone")))
    figure = F.col("there").bitwiseAND(1) == 1
    values = pairs.groupBy(*at, "there").agg(
        F.first("doc_id").alias("doc_id"), F.first("tokens").alias("tokens"), F.count("*").alias("n"),
        (figure | (F.min("here") == F.max("here"))).alias("one"),
        F.sum((F.col("here") != F.col("there")).cast("long")).alias("changed"))
    return values.groupBy(*at).agg(
        F.first("doc_id").alias("doc_id"), F.first("tokens").alias("n_item"), F.sum("n").alias("n_covered"),
        F.sum("changed").alias("n_changed"), F.min("one").alias("consistent"))


def _with_shared(found: DataFrame, right: DataFrame, least_covered: float, literal: float) -> DataFrame:
    """Matches where many items share windows: by own windows alone, or by all windows of the item.

    The second way needs nearly all of the item as it stands (of an item without own windows, what any item needs).
    Shared windows are joined with the items whose own windows a text has, and with families of items; of the
    items that match this way only, those stay that are the nearest at some window of the text (of items without own
    windows: within the family).  All that are equally near stay, so a text that has matches keeps some.
    """
    at = ["text_row", "item_id", "shift"]
    first = found.join(right.filter("own"), "key")
    pairs = first.filter("n_shared > 0").select("text_row", F.col("item_id").alias("of")).distinct()
    rest = right.filter("not own").join(pairs, right["item_id"].eqNullSafe(pairs["of"])).drop("of")
    hits = first.withColumn("own_only", F.lit(True)).withColumn("tokens", F.col("n_own")).unionByName(
        first.filter("n_shared > 0").unionByName(found.join(rest, ["key", "text_row"])).withColumn("own_only", F.lit(False)))
    hits = _shifts(hits)
    aligned = _alignments(hits, [*at, "own_only"])
    aligned = materialize(aligned.filter(F.when(F.col("own_only"), _enough(least_covered, literal)).otherwise(_kept(literal))), "alignments")
    near, used = _by_families(found, right, least_covered, literal)
    whole = aligned.filter("not own_only").withColumn("score", (F.col("n_covered") - F.col("n_changed")) / F.col("n_item"))
    of = whole.select("text_row", F.col("item_id").alias("of"), "shift", "score")
    hits = hits.filter("not own_only").select("text_row", "item_id", "shift", "place").distinct()
    mine = hits.join(of.withColumnsRenamed({"text_row": "row", "shift": "by"}),
                     (F.col("text_row") == F.col("row")) & F.col("item_id").eqNullSafe(F.col("of")) & (F.col("shift") == F.col("by")))
    mine = mine.select("text_row", "item_id", "shift", "place", "score", F.lit(True).alias("has_own"))
    used = materialize(mine.withColumn("family", F.lit(None).cast("long")).unionByName(
        used.withColumn("item_id", F.lit(None).cast(right.schema["item_id"].dataType))), "used_windows")
    best = F.when(F.col("has_own"), F.max("score").over(Window.partitionBy("text_row", "place"))).otherwise(
        F.max("score").over(Window.partitionBy("text_row", "place", "family")))
    named = used.withColumn("best", best).filter("score = best")
    pair = named.filter("family is null").select(F.col("text_row").alias("row"), F.col("item_id").alias("of")).distinct()
    whole = whole.join(pair, (whole["text_row"] == pair["row"]) & whole["item_id"].eqNullSafe(pair["of"]), "left_semi")
    near = near.join(named.filter("family is not null").select("text_row", "family", "shift"), ["text_row", "family", "shift"], "left_semi")
    columns = ["doc_id", "item_id", "n_item", "n_covered", "n_changed", "own_only"]
    return (aligned.filter("own_only").select(*columns).unionByName(whole.select(*columns))
            .unionByName(near.withColumn("own_only", F.lit(False)).select(*columns)))


def _kept(literal: float):
    return F.col("n_covered") - F.col("n_changed") >= F.lit(literal) * F.col("n_item")


def _enough(least_covered: float, literal: float):
    return F.col("consistent") & (F.col("n_covered") >= F.lit(least_covered) * F.col("n_item")) | _kept(literal)


def matches(docs: DataFrame, benchmark: DataFrame, least_covered: float = LEAST_COVERED) -> DataFrame:
    """doc_id, item_id, n_covered, n_item, n_changed, kind (verbatim or reparameterised) of contaminated documents."""
    given = benchmark.select("item_id", empty_text(benchmark["text"]).alias("text"))
    items = materialize(given.groupBy("text").agg(F.min("item_id").alias("item_id")), "items")
    repeated = given.count() > items.count()
    sizes_needed = tuple(range(1, WINDOW + 1))

    def item_windows(batches):
        for part, data, offs in scan.blocks(batches):
            tokens = np.bincount(scan.spans(data, offs, scan.NON_ALNUM)[2], minlength=part.num_rows)
            first = np.cumsum(tokens) - tokens
            for doc, place, size, key, at, surface, spot, width, exact in _windows(data, offs, sizes_needed, True):
                made = _rows(part.column("item_id").take(pa.array(doc)), place - first[doc], size, key, surface, at)
                each = scan.ragged(at, np.full(len(at), size))
                spots = spot[each] - np.repeat(first[doc], size)
                for name, column in (("spots", _lists(spots, size, at)), ("widths", _lists(width[each], size, at)),
                                     ("tokens", pa.array(tokens[doc])), ("size", pa.array(np.full(len(at), size))),
                                     ("exact", pa.array(np.full(len(at), exact)))):
                    made = made.append_column(name, column)
                yield made

    kind = column_type(benchmark, "item_id")
    wanted = materialize(items.mapInArrow(
        item_windows, f"owner {kind}, place long, key long, surfaces array<long>, spots array<long>, widths array<long>, "
                      "tokens long, size long, exact boolean")
        .dropDuplicates(["owner", "place", "key"]), "item_windows")
    common = wanted.groupBy("key").agg(F.countDistinct("owner").alias("holders")).filter(F.col("holders") > MOST_HOLDERS)
    literal = max(LITERAL_ENOUGH, least_covered)
    mixed = common.limit(1).count() > 0                         # else every window is its items' own
    if mixed:
        wanted = materialize(_shared_windows(wanted), "shared_windows")
    sizes = tuple(sorted(r["size"] for r in wanted.select("size").distinct().collect()))     # at most WINDOW of them
    shared = docs.sparkSession.sparkContext.broadcast(bits.build(wanted.select("key").distinct(), FILTER_BLOCKS, 3))

    def text_windows(batches):
        rows = row_ids()
        for part, data, offs in scan.blocks(batches):
            tokens = np.bincount(scan.spans(data, offs, scan.NON_ALNUM)[2], minlength=part.num_rows)
            first = np.cumsum(tokens) - tokens
            ids = np.array(rows.take(part.num_rows), np.int64)
            for doc, place, size, key, at, surface, _, _, _ in _windows(data, offs, sizes, False):
                hit = bits.contains(shared.value, key, 3)
                doc, place, at, key = doc[hit], place[hit], at[hit], key[hit]
                if len(at):
                    made = _rows(part.column("doc_id").take(pa.array(doc)), place - first[doc], size, key, surface, at)
                    yield made.append_column("text_row", pa.array(ids[doc]))

    found = materialize(docs.select("doc_id", empty_text(docs["text"]).alias("text")).mapInArrow(
        text_windows, f"owner {column_type(docs, 'doc_id')}, place long, key long, surfaces array<long>, text_row long"),
        "text_windows")
    found = found.withColumnRenamed("owner", "doc_id")
    right = wanted.withColumnsRenamed({"owner": "item_id", "place": "item_place", "surfaces": "item_surfaces"}).drop("size")
    if mixed:
        aligned = _with_shared(found, right, least_covered, literal)
    else:
        aligned = _alignments(_shifts(found.join(right, "key")), ["text_row", "item_id", "shift"])
        aligned = aligned.filter(_enough(least_covered, literal)).withColumn("own_only", F.lit(True))
    best = F.max_by(F.struct("n_covered", "n_item", "n_changed"), F.struct("own_only", "n_covered", -F.col("n_changed")))
    result = aligned.groupBy("doc_id", "item_id").agg(best.alias("b"))
    if repeated:                                                # items of one text: each by its own id
        copies = items.withColumnRenamed("item_id", "least").join(given, "text").select("least", "item_id").distinct()
        result = result.withColumnRenamed("item_id", "found_id").join(
            copies, F.col("found_id").eqNullSafe(F.col("least"))).select("doc_id", "item_id", "b")
    return (result
            .select("doc_id", "item_id", "b.*",
                    F.when(F.col("b.n_changed") == 0, "verbatim").otherwise("reparameterised").alias("kind")))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated documents."""
    bad = materialize(matches(docs, benchmark).select(F.col("doc_id").alias("bad_id")).distinct(), "contaminated")
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]), "left_anti")
