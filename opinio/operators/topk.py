"""Exact top-k of many queries over a large table of items.

Scoring every item for every query is inherent in exact search; writing every
(query, item) pair down is not. Items are scored a block at a time as matrix
work and only the best k per query leave a task.

Queries travel with the tasks and items stay where they are. A query set beyond the
checked size goes in blocks, one pass over the items for each; no item is shuffled or copied.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from opinio.session import new_path

# Bounds of a query set that may travel with the tasks.
RESIDENT_QUERIES = 10_000
RESIDENT_BYTES = 32 << 20
ITEMS_PER_BLOCK = 20_000
# Items and queries that are multiplied at once, and pairs scored at once.
ITEMS_AT_ONCE, QUERIES_AT_ONCE, PAIRS_AT_ONCE = 4096, 256, 1 << 16
# Terms of queries, and postings, that are looked up at once.
LOOKUPS_AT_ONCE, POSTINGS_AT_ONCE = 1 << 20, 1 << 21
# Products that take the time of adding one posting, queries whose products take the time of filling
# in a row of a matrix, and its numbers.
PRODUCTS_A_POSTING, FILLING, MULTIPLIED_AT_ONCE = 200, 20, 1 << 22
# Terms by which queries are put beside their like, and the least weight in single precision.
LEADING_TERMS, LEAST = 4, 1e-30
# A term in this share of a block's items is kept as a column of all of them.
DENSE = 1 / 8

# Tasks for each core that items are scored by, at most.
TASKS_A_CORE = 2
# Parts of the tasks that are ranked apart before the last ranking.
RANKING_PARTS = 64

# queries -> items -> k, digits ranked on and the k-th scores reached so far, or nothing ->
# (query or the query of each, items, scores) one after the other: what can be among the best k
Hits = Iterator[tuple[int | np.ndarray, np.ndarray, np.ndarray]]
Score = Callable[..., Hits]
Prepare = Callable[[pa.Table], Score]
MakeScorer = Callable[[pa.Table], Prepare]


def round_half_up(values: np.ndarray, digits: int) -> np.ndarray:
    scale = 10.0**digits
    return np.copysign(np.floor(np.abs(values) * scale + 0.5), values) / scale


def keep_best(hits: pa.Table, k: int) -> pa.Table:
    """At most k rows per ``query``, by score descending, then id ascending."""
    hits = hits.sort_by([("query", "ascending"), ("score", "descending"), ("id", "ascending")])
    query = hits["query"].to_numpy()
    place = np.arange(len(query)) - np.searchsorted(query, query, side="left")
    return hits.filter(pa.array(place < k))


def highest(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the scores at or above the k-th: keeps all ties for the id order."""
    wanted = scores > -np.inf
    if len(scores) > k:
        wanted &= scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
    return np.flatnonzero(wanted)


def block_hits(
    items: pa.Table, score: Score, k: int, digits: int, reached: np.ndarray | None = None
) -> pa.Table:
    """The best k of a block of items per query, chosen among the items a query touches.

    ``reached`` has the k-th score that each query has so far: lower ones are left out.
    """
    ids = items["id"].combine_chunks()
    found = []
    for query, rows, scores in score(k, digits, reached):
        scores = round_half_up(scores, digits)
        wanted = scores > -np.inf
        if reached is not None:
            wanted &= scores >= reached[query]
        at = np.flatnonzero(wanted)
        hits = pa.table(
            {
                "query": pa.array(np.broadcast_to(query, scores.shape)[at].astype(np.int32)),
                "id": ids.take(pa.array(rows[at])),
                "score": pa.array(scores[at], pa.float64()),
            }
        )
        found.append(keep_best(hits, k) if len(at) > k else hits)
    empty = pa.table(
        {"query": pa.array([], pa.int32()), "id": ids.slice(0, 0), "score": pa.array([], pa.float64())}
    )
    return pa.concat_tables(found) if found else empty


def kth_scores(best: pa.Table, n_queries: int, k: int) -> np.ndarray:
    """The k-th score of each query among sorted hits; -inf for a query with fewer."""
    query = best["query"].to_numpy()
    last = np.flatnonzero(np.arange(len(query)) - np.searchsorted(query, query, side="left") == k - 1)
    reached = np.full(n_queries, -np.inf)
    reached[query[last]] = best["score"].to_numpy()[last]
    return reached


def _named(hits: pa.Table, queries: pa.Table) -> pa.Table:
    names = queries["query_id"].combine_chunks().take(hits["query"].combine_chunks())
    return pa.table({"query_id": names, "id": hits["id"], "score": hits["score"]})


def exact_topk(
    items: DataFrame,
    queries: DataFrame,
    make_scorer: MakeScorer,
    k: int,
    digits: int,
    query_bytes: Column,
    resident_queries: int = RESIDENT_QUERIES,
    resident_bytes: int = RESIDENT_BYTES,
    items_per_block: int = ITEMS_PER_BLOCK,
    recomputed: bool = False,
) -> DataFrame:
    """``(query_id, id, score, rank)`` from ``items(id, ...)`` and ``queries(query_id, ...)``.

    ``query_id`` and ``id`` are unique. ``query_bytes`` is the size of one query
    row, from which the size of the whole set is summed before any of it is fetched. Up to
    ``items_per_block`` items are scored together. ``recomputed`` says that ``items`` are
    more than a scan: for several query blocks they are written once.
    """
    schema = StructType(
        [queries.schema["query_id"], items.schema["id"], StructField("score", DoubleType())]
    )
    # a task's later items have to reach what its earlier ones have: few tasks, few candidates
    tasks = max(1, int(TASKS_A_CORE * items.sparkSession.sparkContext.defaultParallelism))

    def candidates(items: DataFrame, resident: pa.Table) -> DataFrame:
        def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            prepare = make_scorer(resident)
            best = reached = None
            for batch in batches:
                for start in range(0, batch.num_rows if resident.num_rows else 0, items_per_block):
                    block = pa.Table.from_batches([batch.slice(start, items_per_block)])
                    hits = block_hits(block, prepare(block), k, digits, reached)
                    if best is None or hits.num_rows:
                        best = keep_best(hits if best is None else pa.concat_tables([best, hits]), k)
                        reached = kth_scores(best, resident.num_rows, k)
            if best is not None:
                yield from _named(best, resident).to_batches()

        return items.coalesce(tasks).mapInArrow(per_task, schema)

    return by_query_blocks(
        items, queries, query_bytes, lambda some, resident: best_of_each(candidates(some, resident), k, tasks),
        resident_queries, resident_bytes, recomputed,
    )


def by_query_blocks(
    items: DataFrame,
    queries: DataFrame,
    query_bytes: Column,
    answers: Callable[[DataFrame, pa.Table], DataFrame],
    resident_queries: int = RESIDENT_QUERIES,
    resident_bytes: int = RESIDENT_BYTES,
    recomputed: bool = False,
) -> DataFrame:
    """``answers(items, some queries)`` of all queries: one pass, or one for each block of them."""
    n_queries, n_bytes = queries.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(query_bytes), F.lit(0))
    ).first()
    if n_queries <= resident_queries and n_bytes <= resident_bytes:
        return answers(items, queries.toArrow())

    n_blocks = max(-(-n_queries // resident_queries), -(-n_bytes // resident_bytes))
    spark = queries.sparkSession
    asked, found = new_path(spark, "queries"), new_path(spark, "hits")
    block = F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)).cast("int")
    queries.withColumn("_block", block).write.partitionBy("_block").parquet(asked)
    if recomputed:
        kept = new_path(spark, "items")
        items.write.parquet(kept)
        items = spark.read.schema(items.schema).parquet(kept)
    for number in range(n_blocks):
        some = spark.read.parquet(asked).where(F.col("_block") == number)
        answers(items, some.select(*queries.columns).toArrow()).write.mode("append").parquet(found)
    return spark.read.parquet(found)


def best_of_each(candidates: DataFrame, k: int, tasks: int | None = None) -> DataFrame:
    """The best k of each query; k rows from each of very many tasks do not meet in one.

    Those of few ``tasks`` do, in one step.
    """
    order = [F.desc("score"), F.asc("id")]
    part = Window.partitionBy("query_id", "_part").orderBy(*order)
    whole = Window.partitionBy("query_id").orderBy(*order)
    if tasks is None or tasks > RANKING_PARTS:
        candidates = (
            candidates.withColumn("_part", F.spark_partition_id() % RANKING_PARTS)
            .withColumn("rank", F.row_number().over(part))
            .where(F.col("rank") <= k)
            .drop("_part")
        )
    return candidates.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)


def _flat(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """Flattened list values and the number of values in each row."""
    lists = column.combine_chunks()
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return lists.flatten(), lengths


def pair_scores(rows: np.ndarray, wanted: np.ndarray, row: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Products of some pairs of a row and a query; the same for a pair in any company."""
    found = np.empty(len(row))
    for start in range(0, len(row), PAIRS_AT_ONCE):
        some = slice(start, start + PAIRS_AT_ONCE)
        found[some] = np.einsum("ij,ij->i", rows[row[some]], wanted[query[some]])
    return found


def cosine_scorer(positive_only: bool) -> MakeScorer:
    """Cosine of ``embedding`` columns; a zero vector hits nothing.

    Products in single precision and their error tell which pairs can be among the best; only
    these are scored in double precision.
    """

    def make(queries: pa.Table) -> Prepare:
        wanted, wanted_ok = unit_rows(queries)
        asked = np.flatnonzero(wanted_ok)

        def prepare(items: pa.Table) -> Score:
            rows, rows_ok = unit_rows(items)
            usable = np.flatnonzero(rows_ok)

            def score(k: int | None = None, digits: int = 0, reached: np.ndarray | None = None) -> Hits:
                if not rows.shape[1] or not wanted.shape[1] or not len(usable):
                    return
                about = rows[usable].astype(np.float32)
                error = (rows.shape[1] + 8) * 2.0**-23
                for start in range(0, len(asked), QUERIES_AT_ONCE):
                    some = asked[start : start + QUERIES_AT_ONCE]
                    query = wanted[some].T.astype(np.float32)
                    floor = np.full(len(some), -np.inf)
                    if reached is not None:
                        floor = reached[some] - 10.0**-digits - error
                    elif k is not None and len(about) > k:
                        head = about[: max(ITEMS_AT_ONCE, 2 * k)] @ query
                        if len(head) > k:
                            kth = np.partition(head, len(head) - k, axis=0)[len(head) - k]
                            floor = kth - 10.0**-digits - 2 * error
                    if positive_only:
                        floor = np.maximum(floor, -error)
                    for first in range(0, len(about), ITEMS_AT_ONCE):
                        near = about[first : first + ITEMS_AT_ONCE] @ query
                        row, column = np.nonzero(near >= floor.astype(np.float32))
                        if not len(row):
                            continue
                        row, number = usable[row + first], some[column]
                        scores = pair_scores(rows, wanted, row, number)
                        yield number, row, np.where(scores > 0, scores, -np.inf) if positive_only else scores

            return score

        return prepare

    return make


def unit_rows(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of ``embedding``, and which rows are not zero."""
    values, lengths = _flat(table["embedding"])
    width = int(lengths.max(initial=0))
    if not np.all((lengths == width) | (lengths == 0)):
        raise ValueError("embeddings of different lengths")
    matrix = np.zeros((len(lengths), width))
    matrix[lengths > 0] = values.to_numpy(zero_copy_only=False).reshape(-1, width) if width else 0
    norms = np.linalg.norm(matrix, axis=1)
    usable = norms > 0
    matrix[usable] /= norms[usable, None]
    return matrix, usable


def weighted_terms_scorer(queries: pa.Table) -> Prepare:
    """Sum of ``matches.weight`` over the terms an item shares with the query."""
    asked, asked_n = _flat(queries["terms"])
    vocabulary = pc.unique(asked)
    terms = pc.index_in(asked, vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
    edges = np.concatenate([[0], np.cumsum(asked_n)])
    groups = list(_alike(terms, edges, len(vocabulary)))

    def prepare(items: pa.Table) -> Score:
        postings = Postings(items["matches"], vocabulary)

        def score(k: int | None = None, digits: int = 0, reached: np.ndarray | None = None) -> Hits:
            if k is None:  # every item that a query touches
                for number in range(len(asked_n)):
                    yield from postings.touched(number, terms[edges[number] : edges[number + 1]])
                return
            for numbers in groups:
                n = asked_n[numbers]
                query = np.repeat(np.arange(len(numbers)), n)
                floor = None if reached is None else reached[numbers]
                some = terms[_ranges(edges[numbers], n)]
                for found, item, scores in postings.best(query, some, len(numbers), k, digits, floor):
                    yield numbers[found], item, scores

        return score

    return prepare


def _alike(terms: np.ndarray, edges: np.ndarray, n_terms: int) -> Iterator[np.ndarray]:
    """Numbers of the queries, those together that share terms which many queries have."""
    n = np.diff(edges)
    query = np.repeat(np.arange(len(n)), n)
    place = np.empty(n_terms, np.int64)
    place[np.argsort(-np.bincount(terms, minlength=n_terms), kind="stable")] = np.arange(n_terms)
    common = place[terms][np.lexsort((place[terms], query))]
    leading = np.full((LEADING_TERMS, len(n)), n_terms)
    for at in range(LEADING_TERMS):
        leading[at, n > at] = common[edges[:-1][n > at] + at]
    order = np.lexsort(leading[::-1])
    for start in range(0, len(order), QUERIES_AT_ONCE):
        yield order[start : start + QUERIES_AT_ONCE]


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All of first[i], first[i] + 1, ... (count[i] of them), one after the other."""
    before = np.cumsum(count) - count
    return np.repeat(first - before, count) + np.arange(int(count.sum()))


class Postings:
    """A block's matches by term.

    Scores of many queries are first added up in single precision: terms that many of the queries
    and many of the items have by a matrix product, the others posting by posting. These sums
    and their error tell what can be among the best k; only that is scored in double precision.
    """

    def __init__(self, column: pa.ChunkedArray, vocabulary: pa.Array):
        matches, counts = _flat(column)
        self.n, n_terms = len(counts), len(vocabulary)
        term = pc.index_in(matches.field("term"), vocabulary)
        known = term.is_valid().to_numpy(zero_copy_only=False)
        term = term.fill_null(0).to_numpy(zero_copy_only=False)[known].astype(np.int64)
        item = np.repeat(np.arange(self.n), counts)[known]
        weight = matches.field("weight").to_numpy(zero_copy_only=False)[known]
        by_term = np.argsort(term, kind="stable")
        term, self.item, self.weight = term[by_term], item[by_term], weight[by_term]
        self.first = np.searchsorted(term, np.arange(n_terms + 1))
        self.df = np.diff(self.first)
        self.keys = term * self.n + self.item
        self.most = np.zeros(n_terms)
        np.maximum.at(self.most, term, np.abs(self.weight))
        self.negative = bool(len(self.weight)) and self.weight.min() < 0
        self.single = self.weight.astype(np.float32)
        self.single[self.weight > 0] = np.maximum(self.single[self.weight > 0], np.float32(LEAST))
        often = np.flatnonzero(self.df > self.n * DENSE)
        self.column = np.full(n_terms, -1)
        self.column[often] = np.arange(len(often))
        self.dense = np.zeros((len(often), self.n))
        at = _ranges(self.first[often], self.df[often])
        self.dense[np.repeat(np.arange(len(often)), self.df[often]), self.item[at]] = self.weight[at]

    def touched(self, number: int, terms: np.ndarray) -> Hits:
        at = _ranges(self.first[terms], self.df[terms])
        if len(at):
            item, place = np.unique(self.item[at], return_inverse=True)
            total = np.bincount(place, self.weight[at])
            yield number, item, np.where(total > 0, total, -np.inf)

    def weights(self, term: np.ndarray, item: np.ndarray) -> np.ndarray:
        """The weight of each term in each item, 0 where it is not."""
        found = np.zeros(len(term))
        column = self.column[term]
        often = column >= 0
        found[often] = self.dense[column[often], item[often]]
        seldom = np.flatnonzero(~often)
        key = term[seldom] * self.n + item[seldom]
        at = np.minimum(np.searchsorted(self.keys, key), max(0, len(self.keys) - 1))
        held = self.keys[at] == key
        found[seldom[held]] = self.weight[at[held]]
        return found

    def scores(self, query: np.ndarray, item: np.ndarray, terms: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Whole scores of pairs; the terms of query q are terms[first[q]:][:count[q]], summed in this order."""
        total = np.zeros(len(query))
        ends = np.cumsum(count[query])
        start = 0
        while start < len(query):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + LOOKUPS_AT_ONCE, side="right")))
            some, n = query[start:stop], count[query[start:stop]]
            pair = np.repeat(np.arange(len(some)), n)
            found = self.weights(terms[_ranges(first[some], n)], item[start:stop][pair])
            total[start:stop] = np.bincount(pair, found, minlength=len(some))
            start = stop
        return total

    def near(self, query: np.ndarray, terms: np.ndarray, n_queries: int) -> np.ndarray:
        """Scores of all items for some queries, in single precision; above 0 where an item has a term."""
        used, column = np.unique(terms, return_inverse=True)
        # what is multiplied instead of being added one by one
        postings = np.bincount(column) * self.df[used]
        often = np.flatnonzero(postings * PRODUCTS_A_POSTING >= self.n * (n_queries + FILLING))
        often = often[np.argsort(-postings[often], kind="stable")[: max(1, MULTIPLIED_AT_ONCE // self.n)]]
        place = np.full(len(used), -1)
        place[often] = np.arange(len(often))
        column = place[column]
        rows = np.zeros((len(often), self.n), np.float32)
        n = self.df[used[often]]
        at = _ranges(self.first[used[often]], n)
        rows[np.repeat(np.arange(len(often)), n), self.item[at]] = self.single[at]
        has = np.zeros((n_queries, len(often)), np.float32)
        np.add.at(has, (query[column >= 0], column[column >= 0]), 1)  # a query may name a term twice
        found = has @ rows
        cells = found.reshape(-1)
        query, terms = query[column < 0], terms[column < 0]
        ends = np.cumsum(self.df[terms])
        start = 0
        while start < len(terms):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + POSTINGS_AT_ONCE, side="right")))
            n = self.df[terms[start:stop]]
            at = _ranges(self.first[terms[start:stop]], n)
            np.add.at(cells, np.repeat(query[start:stop] * self.n, n) + self.item[at], self.single[at])
            start = stop
        return found

    def best(
        self, query: np.ndarray, terms: np.ndarray, n_queries: int, k: int, digits: int,
        reached: np.ndarray | None,
    ) -> Hits:
        """What can be among the best k of some queries; ``query`` ascends."""
        present = self.df[terms] > 0
        query, terms = query[present], terms[present]
        if not len(terms):
            return
        count = np.bincount(query, minlength=n_queries)
        first = np.cumsum(count) - count
        near = self.near(query, terms, n_queries)
        # rounded scores are ranked; weights and each sum of them are rounded to 24 bits
        error = (count + 8) * 2.0**-23 * np.bincount(query, self.most[terms], minlength=n_queries)
        slack = 10.0**-digits + error + 1e-9 * (1 + error)
        floor = np.full(n_queries, -np.inf) if reached is None else reached - slack
        floor = np.maximum(floor, -error if self.negative else LEAST / 2)
        lower = np.nextafter(floor.astype(np.float32), np.float32(-np.inf))
        able = near >= lower[:, None]
        # the k-th of the items that are left lifts the floor of a query that has many
        many = np.flatnonzero(np.count_nonzero(able, axis=1) > k)
        if len(many):
            kth = np.partition(near[many], self.n - k, axis=1)[:, self.n - k]
            lifted = (kth - slack[many] - error[many]).astype(np.float32)
            able[many] &= near[many] >= np.nextafter(lifted, np.float32(-np.inf))[:, None]
        seen, item = np.nonzero(able)
        if len(seen):
            total = self.scores(seen, item, terms, first, count)
            yield seen, item, np.where(total > 0, total, -np.inf)
