"""Item-based collaborative filtering for a list of target items at once."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenfold.functions.stats import ZERO
from lumenfold.plans import salted_join, stage

# Users an item needs, items a user needs, neighbours kept.
MIN_USERS, MIN_ITEMS, NEIGHBOURS = 25, 5, 50
# Ratings a task of a block product holds on average, and what it handles at once: products, pairs that wait, rows of a result.
UNIT_RATINGS = 10_000_000
PRODUCTS_AT_ONCE = 1_000_000
PAIRS_AT_ONCE = 2_000_000
ROWS_AT_ONCE = 500_000
PACK_ROWS = 500_000
# Ten block pairs at least, also of a small table.
LEAST_BLOCKS = 4
# A task takes up to so many blocks one after another for the block that it holds, but of few blocks only a sixth of them.
SPAN, SPANS = 16, 6
UNIT = ["a", "span", "slices", "slice"]


def last_ratings(events: DataFrame, order_by: Sequence[str], rating: str = "rating") -> DataFrame:
    """(user, item, rating): the last rating of each pair.

    ``order_by`` must be a total order up to equal ratings; later values win.
    """
    return events.groupBy("user", "item").agg(F.max_by(rating, F.struct(*order_by)).alias("rating"))


def support_filter(ratings: DataFrame, min_users: int = MIN_USERS, min_items: int = MIN_ITEMS) -> DataFrame:
    """Keep items with enough users, then users with enough of those items; one pass each.

    The counts and the first result are staged: each is read for the hot keys and for the filter.
    """
    per_item = stage(ratings.groupBy("item").agg(F.count("*").alias("rows")), "per_item")
    kept_items = per_item.where(F.col("rows") >= min_users).select("item")
    of_items = stage(salted_join(ratings, kept_items, "item", per_item, ["user"], how="left_semi"), "of_items")
    per_user = stage(of_items.groupBy("user").agg(F.count("*").alias("rows")), "per_user")
    kept_users = per_user.where(F.col("rows") >= min_items).select("user")
    return salted_join(of_items, kept_users, "user", per_user, ["item"], how="left_semi").select("user", "item", "rating")


def item_moments(ratings: DataFrame) -> DataFrame:
    """(item, mean, norm, raters): mean rating, length of the centred rating vector, number of ratings."""
    return ratings.groupBy("item").agg(
        F.avg("rating").alias("mean"), F.sqrt(F.var_pop("rating") * F.count("*")).alias("norm"), F.count("*").alias("raters")
    )


def item_neighbours(
    ratings: DataFrame, targets: DataFrame, k: int = NEIGHBOURS, min_common: int = 2, include_self: bool = True
) -> DataFrame:
    """(target, item, similarity, rank): the ``k`` items most similar to each target.

    Similarity is the centred cosine: the dot product runs over the common users, the
    norms over all raters of each item. ``targets`` is a list of items (column ``item``); it
    is staged, so that Spark knows its size and broadcasts it while it is short.
    ``ratings`` should be staged, since it is read four times.

    The item's own mean is subtracted after the sums (dot = sum(d * r) - mean * sum(d)),
    which saves joining the means to every rating.
    """
    moments = item_moments(ratings)
    wanted = targets.select(F.col("item").alias("target")).distinct()
    of_targets = stage(
        moments.join(wanted, F.col("item") == F.col("target")).select(
            "target", F.col("mean").alias("target_mean"), F.col("norm").alias("target_norm")
        ),
        "targets",
    )
    raters = ratings.join(of_targets, F.col("item") == F.col("target")).select(
        "user", "target", "target_norm", (F.col("rating") - F.col("target_mean")).alias("d")
    )
    per_user = ratings.groupBy("user").agg(F.count("*").alias("rows"))
    common = salted_join(ratings, raters, "user", per_user, ["item"])
    sums = common.groupBy("target", "item").agg(
        F.count("*").alias("n"),
        F.sum(F.col("d") * F.col("rating")).alias("sum_dr"),
        F.sum("d").alias("sum_d"),
        F.max("target_norm").alias("target_norm"),
    )
    dot = F.col("sum_dr") - F.col("mean") * F.col("sum_d")
    scored = (
        sums.where(F.col("n") >= min_common)
        .join(moments, "item")
        .select("target", "item", F.try_divide(dot, F.col("target_norm") * F.col("norm")).alias("similarity"))
        .where((F.col("similarity") > ZERO) & ~F.isnan("similarity"))
    )
    if not include_self:
        scored = scored.where("item <> target")
    order = Window.partitionBy("target").orderBy(F.round("similarity", 9).desc(), "item")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def all_item_neighbours(
    ratings: DataFrame,
    k: int = NEIGHBOURS,
    min_common: int = 2,
    include_self: bool = True,
    item_block: int | None = None,
    unit_ratings: int = UNIT_RATINGS,
) -> DataFrame:
    """(target, item, similarity, rank): the ``k`` items most similar to every item. Exact.

    The same rows as ``item_neighbours`` with all items as targets. Items are dealt into blocks, by default four or as many
    as leave two blocks about ``unit_ratings`` ratings, and the product of the rating matrix with itself is made block pair by
    block pair. So the pairs of a user's items are split into a triangle of pieces, each combined with those of other users
    where it is made. A task holds one block and takes a span of others, one after another. If two of these blocks have many more
    ratings, as one with a very frequent item has, its span is cut in slices of users, so no task sees all items of a user
    or all users of such an item.

    A rating is packed once, with others of its block, in a few bytes; the packed ratings go to every task that takes the
    block. A task that holds a whole block pair knows all common users of its items, so only the ``k`` best of each item leave
    it. The products of slices are added up by pairs of items first.

    ``ratings`` should be staged; it is read twice. Ratings without user or item meet no others.
    """
    ratings = ratings.where(F.col("user").isNotNull() & F.col("item").isNotNull())
    moments = stage(item_moments(ratings), "item-moments")
    size = moments.agg(F.count("*").alias("items"), F.sum("raters").alias("ratings")).first()
    wanted = size["items"] / item_block if item_block else max(LEAST_BLOCKS, 2 * (size["ratings"] or 0) / unit_ratings)
    blocks = max(1, min(math.ceil(wanted), size["items"]))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int")
    sizes = {r["block"]: r["rows"] for r in moments.groupBy(block.alias("block")).agg(F.sum("raters").alias("rows")).collect()}
    routes = _routes(sizes, unit_ratings)
    slices = max((way[2] for ways in routes.values() for way in ways), default=1)

    # a is the block of the item, b the slice of the user. Rows without a user tell the mean and the norm of an item.
    rows = ratings.select(
        block.alias("a"),
        F.pmod(F.xxhash64("user"), F.lit(slices)).cast("int").alias("b"),
        "user",
        "item",
        F.col("rating").cast("double").alias("value"),
        F.lit(None).cast("double").alias("norm"),
    )
    nobody = F.lit(None).cast(ratings.schema["user"].dataType).alias("user")
    of_items = moments.where("norm > 0").select(block.alias("a"), F.lit(-1).alias("b"), nobody, "item", F.col("mean").alias("value"), "norm")
    found = _block_products(rows.unionByName(of_items), Limits(unit_ratings, k, min_common, routes))
    if slices > 1:
        found = stage(found, "block-products")
        parts = found.where("n IS NOT NULL").groupBy("target", "item").agg(F.sum("dot").alias("dot"), F.sum("n").alias("n"))
        once = _similar(parts.select(F.col("target").alias("i"), F.col("item").alias("j"), "dot", "n"), moments, min_common)
        turned = once.where("target <> item").select(F.col("item").alias("target"), F.col("target").alias("item"), "similarity")
        found = found.where("n IS NULL").select("target", "item", "similarity").unionByName(once).unionByName(turned)
    if not include_self:
        found = found.where("item <> target")
    order = Window.partitionBy("target").orderBy(F.round("similarity", 9).desc(), "item")
    best = found.select("target", "item", "similarity").withColumn("rank", F.row_number().over(order))
    return best.where(F.col("rank") <= k)


def _routes(sizes: dict[int, int], unit_ratings: int) -> dict[int, list[tuple[int, int, int, int]]]:
    """The (held block, span, slices, turn) that each block goes to, from the ratings of the blocks. Turn -1 is the held block itself.

    A span of a block is it and the blocks after it, some at a time. Its slices, a power of two, leave two
    blocks about ``unit_ratings`` ratings, if they have more than twice as many.
    """
    names, routes = sorted(sizes), {name: [] for name in sizes}
    width = min(SPAN, max(1, len(names) // SPANS))
    for at, held in enumerate(names):
        for span, first in enumerate(range(at, len(names), width)):
            taken = [name for name in names[first : first + width] if name != held]
            rows = sizes[held] + max((sizes[name] for name in taken), default=0)
            slices = 1 if rows <= 2 * unit_ratings else 1 << math.ceil(math.log2(rows / unit_ratings))
            for name in [held, *taken]:
                routes[name].append((held, span, slices, -1 if name == held else name))
    return routes


@dataclass
class Limits:
    """Ratings a task holds on average, what is kept of a block pair, and where each block goes."""

    unit_ratings: int
    k: int
    min_common: int
    routes: dict[int, list[tuple[int, int, int, int]]] = field(default_factory=dict)


def _block_products(placed: DataFrame, limits: Limits) -> DataFrame:
    """(target, item, similarity, dot, n) of pairs of items with common users, from (a, b, user, item, value, norm).

    ``a`` is a block of items and ``b`` a slice of users. A whole block pair gives the similarities of the best items of each
    target, a slice of one gives products with ``n``, each pair once.
    """
    kind = {c: placed.schema[c].dataType.simpleString() for c in ("user", "item")}
    packed = placed.select("a", "b", "user", "item", "value", "norm").mapInArrow(_pack, "block int, part int, data binary")
    ways = "block int, ways array<struct<a:int,span:int,slices:int,turn:int>>"
    routes = placed.sparkSession.createDataFrame(list(limits.routes.items()), ways)
    sent = packed.join(F.broadcast(routes), "block").select("part", F.explode("ways").alias("way"), "data").select("way.*", "part", "data")
    # What is told of the items goes to every slice.
    part = F.when(F.col("part") < 0, F.sequence(F.lit(0), F.col("slices") - 1)).otherwise(F.array(F.pmod("part", "slices")))
    sent = sent.select("a", "span", "slices", F.explode(part).alias("slice"), "turn", "data")
    units = sent.repartition(*UNIT).sortWithinPartitions(*UNIT, "turn")
    schema = f"target {kind['item']}, item {kind['item']}, similarity double, dot double, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for (_, span, slices, _), turn, data in _turns(batches):
            if turn < 0:
                held = None  # before the next is read
                held = _held(*_unpacked(data))
                if span == 0 and held:
                    yield from multiply(held, _met(held, held.who, held.codes, held.values, held), True, slices)
            elif held:
                yield from multiply(held, _meet(data, held), False, slices)

    def multiply(left: _Held, right: _Met | None, alone: bool, slices: int) -> Iterator[pa.RecordBatch]:
        if right is None:
            return
        code_l, d_l, who, ends = left.codes, left.values, left.who, left.ends
        count, start, code_r, d_r = right.count, right.start, right.codes, right.values
        upto, wide = np.concatenate([[0], np.cumsum(count[who])]), len(right.norms)

        def products(x: int, y: int) -> tuple[np.ndarray, np.ndarray]:
            """Cells and products of the ratings x to y of side a with those of the same users on side b."""
            size = count[who[x:y]]
            at = np.repeat(np.arange(x, y), size)
            other = np.repeat(start[who[x:y]] - upto[x:y], size) + np.arange(upto[x], upto[y])
            cell, product = code_l[at].astype(np.int64) * wide + code_r[other], d_l[at] * d_r[other]
            if not alone:
                return cell, product
            once = code_r[other] >= code_l[at]
            return cell[once], product[once]

        def sums() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
            """(i, j, dot, n) of some items of side a after the other, each with all its pairs."""
            x = 0
            while x < len(code_l):
                fits = np.searchsorted(upto[ends], upto[x] + PRODUCTS_AT_ONCE, side="right")
                y = int(ends[fits - 1]) if fits and ends[fits - 1] > x else 0
                if y:
                    cell, product = products(x, y)
                    order = np.argsort(cell, kind="stable")
                    cell, product = cell[order], product[order]
                    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, int)
                    i, j = np.divmod(cell[first], wide)
                    yield i, j, np.add.reduceat(product, first) if len(first) else product, np.diff(np.append(first, len(cell)))
                else:
                    # One item with very many products: some at a time into a whole row of the product.
                    y = int(ends[np.searchsorted(ends, x, side="right")])
                    dot, n = np.zeros(wide), np.zeros(wide, np.int64)
                    cuts = np.searchsorted(upto[x : y + 1], np.arange(upto[x], upto[y] + PRODUCTS_AT_ONCE, PRODUCTS_AT_ONCE)).clip(0, y - x)
                    for c, e in zip(cuts, np.append(cuts[1:], y - x), strict=True):
                        cell, product = products(x + int(c), x + int(e))
                        dot += np.bincount(cell % wide, product, wide)
                        n += np.bincount(cell % wide, minlength=wide)
                    j = np.flatnonzero(n)
                    yield np.full(len(j), code_l[x]), j, dot[j], n[j]
                x = y

        def rows(target: pa.Array, item: pa.Array, similarity=None, dot=None, n=None) -> pa.RecordBatch:
            numbers = [pa.nulls(len(target), t) if v is None else pa.array(v, t) for v, t in ((similarity, pa.float64()), (dot, pa.float64()), (n, pa.int64()))]
            return pa.RecordBatch.from_arrays([target, item, *numbers], names=["target", "item", "similarity", "dot", "n"])

        turned: list[tuple[np.ndarray, ...]] = []
        waiting, full = 0, PAIRS_AT_ONCE
        for i, j, dot, n in sums():
            if slices > 1:
                yield rows(left.names.take(pa.array(i)), right.names.take(pa.array(j)), dot=dot, n=n)
                continue
            similarity = dot / (left.norms[i] * right.norms[j])
            good = (n >= limits.min_common) & (similarity > ZERO)
            i, j, similarity = i[good], j[good], similarity[good]
            kept = _k_best(i, j, similarity, limits.k)
            yield rows(left.names.take(pa.array(i[kept])), right.names.take(pa.array(j[kept])), similarity[kept])
            back = i != j if alone else slice(None)
            turned.append((j[back].astype(np.int32), i[back].astype(np.int32), similarity[back]))
            waiting += len(turned[-1][0])
            if waiting > full:
                turned = [_best_of(turned, limits.k)]
                waiting = len(turned[0][0])
                full = max(PAIRS_AT_ONCE, 2 * waiting)
        if turned:
            j, i, similarity = _best_of(turned, limits.k)
            for at in range(0, len(j), ROWS_AT_ONCE):
                some = slice(at, at + ROWS_AT_ONCE)
                yield rows(right.names.take(pa.array(j[some])), left.names.take(pa.array(i[some])), similarity[some])

    return units.mapInArrow(run, schema)


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, ...], int, list[pa.Scalar]]]:
    """(unit, turn, packed tables) of sorted rows, all of a turn together."""
    last, data = None, []
    for batch in batches:
        places = [batch.column(c).to_pylist() for c in [*UNIT, "turn"]]
        for *place, table in zip(*places, batch.column("data"), strict=True):
            if place != last:
                if data:
                    yield tuple(last[:-1]), last[-1], data
                last, data = place, []
            # A copy: the batch is not kept for it.
            data.append(table.as_py())
    if data:
        yield tuple(last[:-1]), last[-1], data


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, part, data): the rows of a block and a slice of users, some at a time as a compressed table, by user if they are numbers."""

    def cut(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        a, b = (table.column(c).to_numpy() for c in ("a", "b"))
        key = a.astype(np.int64) * (int(b.max()) + 2) + b + 1
        if pa.types.is_integer(table.schema.field("user").type):
            order = np.lexsort((pc.fill_null(table.column("user"), 0).to_numpy(), key))
        else:
            order = np.argsort(key, kind="stable")
        key, table = key[order], table.select(["user", "item", "value", "norm"]).take(pa.array(order))
        firsts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        data = [_written(table.slice(x, y - x)) for x, y in zip(firsts, np.append(firsts[1:], len(key)), strict=True)]
        columns = [*(pa.array(place[order[firsts]], pa.int32()) for place in (a, b)), pa.array(data, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["block", "part", "data"])

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= PACK_ROWS:
            yield cut(held)
            held, size = [], 0
    if held:
        yield cut(held)


def _written(table: pa.Table) -> bytes:
    """A compressed table of few bytes a row. Whole numbers are steps from the one before (users, in order) or from the least (items)."""
    columns, first = {}, {}
    ratings = not table.column("user").null_count
    for name in ("user", "item") if ratings else ("item",):
        column = table.column(name).combine_chunks()
        if ratings and pa.types.is_integer(column.type):
            # Modulo 2 ** 64, so that no step overflows.
            value = column.to_numpy().astype(np.uint64)
            first[name] = str(int(value[0] if name == "user" else column.to_numpy().min().astype(np.uint64)))
            steps = np.diff(value, prepend=value[:1]) if name == "user" else value - np.uint64(int(first[name]))
            column = pa.array(steps.astype(np.min_scalar_type(steps.max())))
        columns[name] = column
    if ratings:
        coded = pc.fill_null(table.column("value"), math.nan).combine_chunks().dictionary_encode()
        kind = pa.int8() if len(coded.dictionary) < 128 else pa.int16() if len(coded.dictionary) < 32_768 else pa.int32()
        columns["value"] = pa.DictionaryArray.from_arrays(coded.indices.cast(kind), coded.dictionary)
    else:
        columns |= {c: table.column(c).combine_chunks() for c in ("value", "norm")}
    whole = pa.table(columns).replace_schema_metadata(first)
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, whole.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(whole)
    return out.getvalue().to_pybytes()


def _read(data: bytes) -> dict[str, pa.Array | np.ndarray]:
    """The columns of such a table; whole numbers as a numpy array, of items without ratings as they are."""
    table = pa.ipc.open_stream(pa.py_buffer(data)).read_all()
    columns = {c: table.column(c).combine_chunks() for c in table.column_names}
    for name, least in (table.schema.metadata or {}).items():
        steps = columns[name.decode()].to_numpy()
        steps = np.cumsum(steps, dtype=np.uint64) if name == b"user" else steps.astype(np.uint64)
        columns[name.decode()] = (steps + np.uint64(int(least))).view(np.int64)
    return columns


class _Side(NamedTuple):
    """The items of a block in ascending order with their norms."""

    names: pa.Array
    norms: np.ndarray


class _Held(NamedTuple):
    """The items of the held block, its users, and per rating, item by item, the numbers of user and item and the centred value."""

    names: pa.Array
    norms: np.ndarray
    known: np.ndarray | pa.Array
    who: np.ndarray
    codes: np.ndarray
    values: np.ndarray
    ends: np.ndarray


class _Met(NamedTuple):
    """The items of a block, and its ratings by those users that the held block has: number and first place for each user."""

    names: pa.Array
    norms: np.ndarray
    count: np.ndarray
    start: np.ndarray
    codes: np.ndarray
    values: np.ndarray


def _unpacked(data: list[bytes]) -> tuple[_Side, np.ndarray | pa.Array, np.ndarray, np.ndarray]:
    """The items of a block, and users, items' numbers and centred values of its ratings; users as numbers if they are any. ``data`` is used up."""
    told, users, items, values = [], [], [], []
    while data:
        columns = _read(data.pop())
        if "norm" in columns:
            told.append(pa.table(columns))
        else:
            users.append(columns["user"])
            items.append(columns["item"])
            values.append(columns["value"].dictionary.to_numpy()[columns["value"].indices.to_numpy()])
    if not told or not values:
        return _Side(pa.nulls(0), np.zeros(0)), np.zeros(0, int), np.zeros(0, np.int32), np.zeros(0)
    of_items = pa.concat_tables(told).sort_by("item")
    names, mean = of_items.column("item").combine_chunks(), of_items.column("value").to_numpy()
    known = names
    if isinstance(items[0], np.ndarray):
        items, known = [pa.array(i) for i in items], pa.array(names.to_numpy().astype(np.uint64).view(np.int64))
    codes = pc.fill_null(pc.index_in(pa.chunked_array(items), value_set=known), -1).to_numpy().astype(np.int32)
    del items
    there, centred = codes >= 0, np.concatenate(values)
    del values
    centred -= mean[codes]
    users = np.concatenate(users) if isinstance(users[0], np.ndarray) else pa.chunked_array(users).combine_chunks()
    if not there.all():
        codes, centred = codes[there], centred[there]
        users = users[there] if isinstance(users, np.ndarray) else users.filter(pa.array(there))
    return _Side(names, of_items.column("norm").to_numpy()), users, codes, centred


def _held(side: _Side, users: np.ndarray | pa.Array, codes: np.ndarray, values: np.ndarray) -> _Held | None:
    if not len(codes):
        return None
    if isinstance(users, np.ndarray):
        known, who = np.unique(users, return_inverse=True)
    else:
        encoded = users.dictionary_encode()
        known, who = encoded.dictionary, encoded.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    ends = np.append(np.flatnonzero(np.diff(codes)) + 1, len(codes))
    return _Held(*side, known, who.astype(np.int32)[order], codes, values[order], ends)


def _numbers(users: np.ndarray | pa.Array, known: np.ndarray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The places in ``known`` of those users that stand there, and which of ``users`` these are."""
    if isinstance(users, np.ndarray):
        # Packed tables are ordered by user, and the sort makes use of that.
        order = np.argsort(users, kind="stable")
        users = users[order]
        at = np.searchsorted(known, users)
        good = known[np.minimum(at, len(known) - 1)] == users
        return at[good].astype(np.int32), order[good]
    at = pc.fill_null(pc.index_in(users, value_set=known), -1).to_numpy()
    there = np.flatnonzero(at >= 0)
    return at[there], there


def _meet(data: list[bytes], held: _Held) -> _Met | None:
    """The ratings of a block by users of the held one; nothing else of them stays in memory."""
    side, users, codes, values = _unpacked(data)
    numbers, there = _numbers(users, held.known)
    del users
    return _met(side, numbers, codes[there], values[there], held) if len(there) else None


def _met(side: _Side | _Held, numbers: np.ndarray, codes: np.ndarray, values: np.ndarray, held: _Held) -> _Met:
    count = np.bincount(numbers, minlength=len(held.known)).astype(np.int32)
    start = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
    order = np.argsort(numbers, kind="stable")
    return _Met(side.names, side.norms, count, start, codes[order], values[order])


def _k_best(target: np.ndarray, item: np.ndarray, similarity: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best rows of each target. Rows whose similarity lies on the border of two roundings are kept and not counted."""
    scaled = similarity * 1e9
    sure = np.flatnonzero(np.abs(scaled % 1 - 0.5) > 1e-4)
    order = sure[np.lexsort((item[sure], -np.rint(scaled[sure]), target[sure]))]
    sorted_target = target[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_target[1:] != sorted_target[:-1]])) if len(order) else np.zeros(0, int)
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    kept = np.abs(scaled % 1 - 0.5) <= 1e-4
    kept[order[rank < k]] = True
    return np.flatnonzero(kept)


def _best_of(parts: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
    target, item, similarity = (np.concatenate(c) for c in zip(*parts, strict=True))
    kept = _k_best(target, item, similarity, k)
    return target[kept], item[kept], similarity[kept]


def _similar(products: DataFrame, moments: DataFrame, min_common: int) -> DataFrame:
    """(target, item, similarity) of the positive cosines, each pair once."""
    norm = lambda c: moments.select(F.col("item").alias(c), F.col("norm").alias(f"norm_{c}"))
    joined = products.where(F.col("n") >= min_common).join(norm("i"), "i").join(norm("j"), "j")
    similarity = F.try_divide(F.col("dot"), F.col("norm_i") * F.col("norm_j"))
    scored = joined.select(F.col("i").alias("target"), F.col("j").alias("item"), similarity.alias("similarity"))
    return scored.where((F.col("similarity") > ZERO) & ~F.isnan("similarity"))


def predict_ratings(ratings: DataFrame, neighbours: DataFrame, min_neighbours: int = 2) -> DataFrame:
    """(target, user, rating, known) for users who rated enough neighbours of the target.

    The user's own rating of the target if there is one, else the mean of the neighbour
    ratings weighted by similarity; only positive results are kept. ``neighbours`` holds
    at most k rows per target; it is staged, so that Spark knows its size.
    """
    near = stage(neighbours.select("target", "item", "similarity"), "neighbours")
    own = near.select("target").distinct().select(
        "target", F.col("target").alias("item"), F.lit(None).cast("double").alias("similarity")
    )
    rated = ratings.join(near.unionAll(own), "item")
    per_user = rated.groupBy("target", "user").agg(
        F.count("similarity").alias("n"),
        F.sum(F.col("rating") * F.col("similarity")).alias("weighted"),
        F.sum("similarity").alias("weight"),
        F.max(F.when(F.col("similarity").isNull(), F.col("rating"))).alias("own"),
    )
    rating = F.coalesce(F.col("own"), F.try_divide(F.col("weighted"), F.col("weight")))
    return (
        per_user.where(F.col("n") >= min_neighbours)
        .select("target", "user", rating.alias("rating"), F.col("own").isNotNull().alias("known"))
        .where((F.col("rating") > 0) & ~F.isnan("rating"))
    )
