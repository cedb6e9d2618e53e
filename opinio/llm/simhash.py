"""SimHash near-duplicates: exact tiled comparison of fingerprints, then components.

Fingerprints are split into blocks that every pair within reach shares at least once. In a
block they are dealt into tiles in the order of their population count; a tile pair whose
counts differ beyond the radius is skipped, every other is compared whole with numpy
exclusive-or and bit counts. A tile pair returns a spanning forest of its links, never all
pairs, so a group of thousands of near copies stays small.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinio.llm.common import stored

SEED = 42
TILE = 1024
# Fingerprints aimed at in one block; a block's size does not change what is found.
PER_BLOCK = 512
ROWS_AT_ONCE = 128


def shingle_hashes(text: bytes, words: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of each run of ``words`` words of a text, A-Z lower-cased, in order.

    Words are cut at ASCII white space. Fewer words make one run; no words none.
    """
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(found), seed)], np.uint64)
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = [0, *ends[: len(found) - words].tolist()]
    stops = (ends[words - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], seed) for a, b in zip(starts, stops)], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    n = len(hashes)
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    # 64 counters of a byte each, added 8 at a time as words; 255 rows cannot overflow them
    lanes = np.zeros((-(-n // 255) * 255, 8), np.uint64)
    lanes[:n] = bits.view(np.uint64)
    sums = lanes.reshape(-1, 255, 8).sum(axis=1, dtype=np.uint64).view(np.uint8)
    over = sums.reshape(-1, 64).sum(axis=0, dtype=np.int64) * 2 > n
    return int(np.packbits(over, bitorder="little").view("<u8")[0]) if n else 0


def fingerprints(docs: DataFrame, words: int = 3, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc, f0)``: the 64-bit fingerprint of every row as a signed long.

    A NULL text counts as empty, whose fingerprint is 0. Rows repeat as they are.
    """
    source = docs.select(doc, text)
    schema = f"`{doc}` {source.schema[doc].dataType.simpleString()}, f0 bigint"

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                majority(shingle_hashes(value.as_buffer().to_pybytes(), words))
                if value.is_valid
                else 0
                for value in batch.column(1)
            ]
            yield pa.record_batch(
                [batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))],
                names=[doc, "f0"],
            )

    return source.mapInArrow(per_batch, schema)


def blocks_of(fingerprint: Column, radius: int, n: int) -> Column:
    """Block keys of a 64-bit fingerprint among ``n``: one for each of ``radius`` + 1 segments.

    Two fingerprints within the radius agree on a whole segment, so on its key. A key
    uses as many bits of a segment as ``n`` calls for.
    """
    width = 64 // (radius + 1)
    bits = min(width, max(0, (n // PER_BLOCK).bit_length()))
    mask = F.lit((1 << bits) - 1).cast("bigint")
    return F.array(
        *(
            F.shiftrightunsigned(fingerprint, table * width)
            .bitwiseAND(mask)
            .bitwiseOR(F.lit(table << width).cast("bigint"))
            for table in range(radius + 1)
        )
    )


class Forest:
    """Union-find over the rows of a tile pair."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.parent[max(i, j)] = min(i, j)
        return i != j


# rows of a tile pair -> a test of two of its rows by number
Verify = Callable[[pa.Table], Callable[[int, int], bool]]


def forest_of(group: pa.Table, radius: int, gap: int, lanes: int, verify: Verify | None) -> list[tuple[int, int]]:
    """Links (of row numbers) that connect all rows of a tile pair whose pairs are linked.

    A pair is compared if its sides are 0 and 1, or if both are 0 in a tile by itself.
    """
    words = [group[f"f{i}"].to_numpy().view(np.uint64) for i in range(lanes)]
    rank = group["rank"].to_numpy()
    side = group["side"].to_numpy()
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1)
    alone = not len(right)
    if alone:
        right = left
    forest, links = Forest(len(side)), []
    test = verify(group) if verify else None
    for start in range(0, len(left), ROWS_AT_ONCE):
        rows = left[start : start + ROWS_AT_ONCE]
        others = right[start:] if alone else right
        far = sum(
            np.bitwise_count(w[rows][:, None] ^ w[others][None, :]).astype(np.uint16) for w in words
        )
        near = (far <= radius) & (np.abs(rank[rows][:, None] - rank[others][None, :]) <= gap)
        near_row, near_other = np.nonzero(near)
        for i, j in zip(rows[near_row].tolist(), others[near_other].tolist()):
            if (not alone or i < j) and forest.root(i) != forest.root(j):
                if test is None or test(i, j):
                    forest.join(i, j)
                    links.append((i, j))
    return links


def near_links(
    items: DataFrame,
    radius: int,
    gap: int,
    lanes: int = 1,
    tile: int = TILE,
    verify: Verify | None = None,
    payload: DataFrame | None = None,
) -> DataFrame:
    """``(a, b)``: links between items of one block, enough to connect what is linked.

    ``items`` has ``key`` (a block), ``id``, ``rank`` and ``f0``...; ``payload``, if given, has
    ``id`` and what ``verify`` needs, and joins them once they have been dealt out. Two items are linked if they share a block, their ranks differ by ``gap`` at most, their
    fingerprints by ``radius`` bits at most, and ``verify`` agrees. A block of any
    size is cut into tiles in the order of rank; each pair of tiles within the gap is a
    task's unit of work, so no block has to fit anywhere.
    """
    words = [f"f{i}" for i in range(lanes)]
    by_rank = Window.partitionBy("key").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        items.groupBy("key", "rank")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(by_rank), F.lit(0)))
        .withColumn("total", F.sum("n").over(Window.partitionBy("key")))
        .where(F.col("total") > 1)
        .withColumn("first", F.floor(F.col("before") / tile))
        .withColumn("last", F.floor((F.col("before") + F.col("n") - 1) / tile))
    )
    spread = cells.withColumn("tile", F.explode(F.sequence("first", "last")))
    tiles = spread.groupBy("key", "tile").agg(F.min("rank").alias("low"), F.max("rank").alias("high"))
    x, y = tiles.alias("x"), tiles.alias("y")
    pairs = x.join(
        y,
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.tile") <= F.col("y.tile"))
        & (F.col("y.low") - F.col("x.high") <= gap),
    ).select(F.col("x.key").alias("key"), F.col("x.tile").alias("ta"), F.col("y.tile").alias("tb"))
    roles = pairs.select(
        "key",
        "ta",
        "tb",
        F.explode(
            F.when(F.col("ta") == F.col("tb"), F.array(F.struct(F.col("ta").alias("tile"), F.lit(0).alias("side"))))
            .otherwise(
                F.array(
                    F.struct(F.col("ta").alias("tile"), F.lit(0).alias("side")),
                    F.struct(F.col("tb").alias("tile"), F.lit(1).alias("side")),
                )
            )
        ).alias("role"),
    ).select("key", "ta", "tb", "role.tile", "role.side")
    dealt = items.join(cells.select("key", "rank", "first", "last"), ["key", "rank"]).withColumn(
        "tile",
        F.col("first") + F.pmod(F.xxhash64("id"), F.col("last") - F.col("first") + 1),
    )
    placed = dealt.join(roles, ["key", "tile"]).select(
        "key", "ta", "tb", "side", "rank", "id", *words
    )
    if payload is not None:
        placed = placed.join(payload, "id")
    placed = placed.repartition("key", "ta", "tb").sortWithinPartitions("key", "ta", "tb")
    kind = items.schema["id"].dataType.simpleString()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            some = pa.Table.from_batches([batch])
            held = some if held is None else pa.concat_tables([held, some])
            starts = boundaries(held)
            if len(starts) > 1:
                yield links_of(held, starts)
                held = held.slice(starts[-1]).combine_chunks()
        if held is not None and held.num_rows:
            yield links_of(held, [*boundaries(held), held.num_rows])

    def boundaries(rows: pa.Table) -> list[int]:
        new = np.zeros(max(rows.num_rows - 1, 0), bool)
        for name in ("key", "ta", "tb"):
            values = rows[name].to_numpy()
            new |= values[1:] != values[:-1]
        return [0, *(np.flatnonzero(new) + 1).tolist()] if rows.num_rows else []

    def links_of(rows: pa.Table, starts: list[int]) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        ids = rows["id"].to_numpy()
        first, second = [], []
        for start, stop in zip(starts, starts[1:]):
            if stop - start > 1:
                group = rows.slice(start, stop - start)
                for i, j in forest_of(group, radius, gap, lanes, verify):
                    first.append(ids[start + i])
                    second.append(ids[start + j])
        return pa.record_batch(
            [pa.array(np.array(first, ids.dtype)), pa.array(np.array(second, ids.dtype))],
            names=["a", "b"],
        )

    return placed.mapInArrow(compare, f"a {kind}, b {kind}").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(id, root)`` for every id that has a link, root the smallest id of its component.

    Large-star and small-star rounds: every round hangs neighbours on the smallest id
    seen so far. A round is written to the shared folder; its edges shrink to stars. Minima
    are combined before the shuffle, and a hot id's edges are split by the adaptive join.
    """
    edges = stored(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
        .distinct(),
        "edges",
    )
    last = None
    while True:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        lowest = both.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("m"))
        large = (
            both.where(F.col("u") > F.col("v"))
            .join(lowest, "v")
            .select(F.col("u").alias("v"), F.col("m").alias("u"))
            .distinct()
        )
        lower = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (
            large.join(lower, "v")
            .select(F.explode(F.array("v", "u")).alias("v"), F.col("m").alias("u"))
            .where(F.col("u") != F.col("v"))
            .distinct()
        )
        edges = stored(small, "stars")
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == last:
            break
        last = now
    roots = edges.select(F.col("u").alias("id"), F.col("u").alias("root")).distinct()
    return edges.select(F.col("v").alias("id"), F.col("u").alias("root")).unionByName(roots)


def near_duplicates(
    docs: DataFrame, words: int = 3, radius: int = 2, doc: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc, fingerprint, component_id)``, one row for each row of ``docs``.

    ``component_id`` is the smallest id reachable over fingerprints that differ in at most
    ``radius`` bits; NULL ids do not count for it. Equal fingerprints are compared once,
    however many rows have them.
    """
    rows = stored(fingerprints(docs, words, doc, text), "fingerprints")
    distinct = stored(rows.groupBy("f0").agg(F.min(doc).alias("lowest")), "distinct")
    n = distinct.count()
    items = distinct.select(
        F.explode(blocks_of(F.col("f0"), radius, n)).alias("key"),
        F.col("f0").alias("id"),
        F.bit_count("f0").alias("rank"),
        "f0",
    )
    roots = components(near_links(items, radius, gap=radius))
    named = distinct.join(roots, distinct["f0"] == roots["id"], "left").select(
        "f0", F.coalesce("root", "f0").alias("root"), "lowest"
    )
    lowest = named.groupBy("root").agg(F.min("lowest").alias("component_id"))
    answer = named.join(lowest, "root").select("f0", "component_id")
    return rows.join(answer, "f0").select(
        doc, F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id"
    )
