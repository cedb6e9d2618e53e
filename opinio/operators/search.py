"""Semantic, full-text and hybrid search for tables of questions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinio.functions.counting import with_counts
from opinio.functions.text import term_counts
from opinio.operators.index import ROWS_PER_BUCKET, Snapshot, TextIndex, analysed, with_vector
from opinio.operators.topk import RESIDENT_QUERIES, cosine_scorer, exact_topk, weighted_terms_scorer
from opinio.session import checked_broadcast, new_path

# BM25 and reciprocal rank fusion constants, digits ranked on.
K1 = 1.2
B = 0.75
FUSION_OFFSET = 60
FUSION_DEPTH = 50
COSINE_DIGITS = 6
BM25_DIGITS = 4
DEFAULT_RESULTS = 5

# Asked terms that are pushed to the scan, and terms up to which their blocks are as well.
PUSHED_TERMS = 1000
TERMS_WITH_BLOCKS = 50
# Texts given out at once, and hits of all queries that a task may hold in one pass over the texts.
TEXTS_AT_ONCE, HITS_AT_ONCE, MOST_QUERIES = 8_192, 1_000_000, 50_000


def semantic_topk(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = DEFAULT_RESULTS,
    positive_only: bool = False,
    dimension: int | None = None,
    **bounds: int,
) -> DataFrame:
    """Exact cosine top-k: ``vectors(id, embedding)``, ``queries(query_id, embedding)``."""
    width = F.lit(dimension) if dimension else F.size("embedding")
    return exact_topk(
        vectors.where(F.col("embedding").isNotNull()).select("id", "embedding"),
        queries.where(F.col("embedding").isNotNull()).select("query_id", "embedding"),
        cosine_scorer(positive_only),
        k,
        COSINE_DIGITS,
        query_bytes=width * 8,
        **bounds,
    )


def search_semantic(
    found: Snapshot, queries: DataFrame, k: int = DEFAULT_RESULTS, **bounds: int
) -> DataFrame:
    """Cosine over the index vectors.

    With the hashed vectors a text without a common bucket is no hit; a caller's model
    ranks every text, also at negative cosines.
    """
    counted = analysed(queries.select("query_id", "query_text"), "query_text", found.index.embed)
    asked = _stored(found, counted.select("query_id", "embedding"))
    items = found.rows().select(F.col(found.index.key).alias("id"), "embedding")
    return semantic_topk(
        items, asked, k, found.index.embed is None, found.totals.dimension or None, **bounds
    )


def search_approximate(
    found: Snapshot, queries: DataFrame, k: int = DEFAULT_RESULTS, **options: float
) -> DataFrame:
    """Cosine over the vectors of the cells nearest to the question; see ``operators.cells``.

    The index makes its cells at the first such search and keeps them from then on.
    """
    asked = with_vector(
        queries.select("query_id", "query_text", term_counts(F.col("query_text")).alias("terms")),
        "query_text",
        found.index.embed,
    ).select("query_id", "embedding")
    hits = found.cells().search(asked, k, **options)
    return hits if found.index.embed else hits.where(F.col("score") > 0)


def search_fulltext(
    found: Snapshot, queries: DataFrame, k: int = DEFAULT_RESULTS, **bounds: int
) -> DataFrame:
    """BM25 over the postings of the asked terms.

    Postings are sorted by term, so a short list of terms is pushed to the scan
    and skips the other row groups. Blocks of a term's postings that cannot lift a text to
    the k-th score of any question are left out (see ``needed_blocks``). The matches of one text
    are gathered once, by the task of its bucket, and scored for all queries together (see
    ``topk.Postings``).
    """
    counted = with_counts(queries.select("query_id", "query_text"), "query_text", None)
    asked = _stored(found, counted.select("query_id", F.col("terms.term").alias("terms")))
    size = F.octet_length(F.concat_ws("", "terms")) + 8 * F.size("terms")

    # a pass over the texts costs more than the few terms of a query
    most = max(RESIDENT_QUERIES, min(MOST_QUERIES, HITS_AT_ONCE // max(1, k)))
    bounds = {"resident_queries": most, **bounds}

    def ranked(blocks: DataFrame) -> DataFrame:
        return exact_topk(
            _matches(found, blocks), asked, weighted_terms_scorer, k, BM25_DIGITS,
            query_bytes=size, recomputed=True, **bounds,
        )

    return ranked(needed_blocks(found, asked, k, ranked))


def _stored(found: Snapshot, asked: DataFrame) -> DataFrame:
    """What is asked, written: it is read several times, and its texts are analysed once."""
    path = new_path(found.index.spark, "asked")
    asked.write.parquet(path)
    return found.index.spark.read.schema(asked.schema).parquet(path)


def _norm(found: Snapshot, n_terms: Column) -> Column:
    return K1 * (1 - B + B * n_terms / F.lit(found.totals.mean_terms or 1.0))


def _matches(found: Snapshot, blocks: DataFrame) -> DataFrame:
    """``(id, matches)``: the weighted terms of each text in some blocks with their ``idf``.

    A text's postings lie in one bucket, so the blocks travel as they are, to a task for each
    bucket. Buckets that have grown far beyond their size are cut by the hash of the key.
    """
    totals = found.totals
    own = blocks.select("bucket", "term", "idf", "entries")
    slices = max(1, -(-totals.n_docs // (2 * ROWS_PER_BUCKET * totals.n_buckets)))
    unit = F.col("bucket")
    if slices > 1:
        own = own.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).withColumn(
            "entries",
            F.filter(
                "entries",
                lambda e: F.pmod(F.xxhash64(e["id"], F.lit("slice")), F.lit(slices)) == F.col("slice"),
            ),
        )
        unit = (unit * slices + F.col("slice")).cast("int")
    kind = found.index.rows().schema[found.index.key].dataType.simpleString()
    return (
        own.select(unit.alias("unit"), "term", "idf", "entries")
        .repartitionById(totals.n_buckets * slices, F.col("unit"))
        .mapInArrow(
            _texts(totals.mean_terms or 1.0), f"id {kind}, matches array<struct<term:string,weight:double>>"
        )
    )


def _texts(mean: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The blocks of a bucket turned to its texts."""

    def per_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, idfs, ids, tfs, lengths = ([] for _ in range(5))
        for batch in batches:
            entries = batch.column("entries")
            block = np.repeat(np.arange(batch.num_rows), entries.value_lengths().to_numpy(zero_copy_only=False))
            flat = entries.flatten()
            terms.append(batch.column("term").take(pa.array(block)).dictionary_encode())
            idfs.append(batch.column("idf").to_numpy(zero_copy_only=False)[block])
            ids.append(flat.field("id"))
            tfs.append(flat.field("tf").to_numpy(zero_copy_only=False))
            lengths.append(flat.field("n_terms").to_numpy(zero_copy_only=False))
        if not ids:
            return
        tf, length = np.concatenate(tfs), np.concatenate(lengths)
        norm = K1 * (1 - B + B * length / mean)
        weight = np.concatenate(idfs) * tf * (K1 + 1) / (tf + norm)
        coded = pa.chunked_array(ids).combine_chunks().dictionary_encode()
        of = coded.indices.to_numpy()
        order = np.argsort(of, kind="stable")
        edges = np.searchsorted(of[order], np.arange(len(coded.dictionary) + 1))
        term = pa.chunked_array(terms).unify_dictionaries().combine_chunks()
        for start in range(0, len(coded.dictionary), TEXTS_AT_ONCE):
            stop = min(start + TEXTS_AT_ONCE, len(coded.dictionary))
            some = order[edges[start] : edges[stop]]
            matches = pa.StructArray.from_arrays(
                [term.take(pa.array(some)).cast(pa.string()), pa.array(weight[some])], names=["term", "weight"]
            )
            offsets = pa.array(edges[start : stop + 1] - edges[start], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [coded.dictionary.slice(start, stop - start), pa.ListArray.from_arrays(offsets, matches)],
                names=["id", "matches"],
            )

    return per_bucket


def needed_blocks(
    found: Snapshot, asked: DataFrame, k: int, ranked: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Blocks of the asked terms, with ``idf``, that can hold a hit of some question.

    A block's greatest weight follows from its greatest count and its shortest text. The
    heaviest blocks alone, ranked, give each question a k-th score that its hits must reach.
    A text of a block can reach it only if the block's greatest weight and the greatest
    weights of the question's other terms together do: blocks for which that holds in no
    question are left out. A hit is in none of them, so hits keep their whole score. Of more terms
    than can be pushed to the scan every block is taken.
    """
    vocabulary = asked.select(F.explode_outer("terms").alias("term")).distinct()
    vocabulary = vocabulary.where(F.col("term").isNotNull())
    few = [row[0] for row in vocabulary.limit(PUSHED_TERMS + 1).collect()]
    pushed = len(few) <= PUSHED_TERMS
    n_asked = len(few) if pushed else vocabulary.count()

    def matching(rows: DataFrame) -> DataFrame:
        if pushed:
            return rows.where(F.col("term").isin(few))
        return rows.join(checked_broadcast(vocabulary, n_asked), "term", "left_semi")

    df = F.sum("n")
    totals = found.totals
    rarity = F.log(1 + (totals.n_docs - df + 0.5) / (df + 0.5))
    most = F.col("most_tf") * (K1 + 1) / (F.col("most_tf") + _norm(found, F.col("least_terms")))
    bounds = matching(found.blocks().select("term", "block", "n", "most_tf", "least_terms"))
    path = new_path(found.index.spark, "terms")
    bounds.groupBy("term").agg(
        rarity.alias("idf"), F.max(most).alias("most"), F.max("block").alias("last")
    ).write.parquet(path)
    terms = found.index.spark.read.parquet(path)
    known = checked_broadcast(terms.select("term", "idf"), n_asked)
    blocks = (matching(found.blocks()) if pushed else found.blocks()).join(known, "term")
    if not pushed or (terms.agg(F.max("last")).first()[0] or 0) == 0:
        # very many terms: hardly a block that no question needs, so all are read, once;
        # or one block for each term and bucket: nothing to leave out
        return blocks

    first = ranked(blocks.where(F.col("block") == 0))
    reached = first.where(F.col("rank") == k).select("query_id", F.col("score").alias("reached"))
    wanted = asked.select("query_id", F.explode("terms").alias("term")).join(terms, "term")
    bound = F.col("idf") * F.col("most")
    whole = wanted.groupBy("query_id").agg(F.sum(bound).alias("whole"))
    # a block of the term is needed from this weight on; scores are ranked rounded
    rest = F.coalesce("reached", F.lit(0.0)) - (F.col("whole") - bound) - 10.0**-BM25_DIGITS
    needs = (
        wanted.join(whole, "query_id").join(reached, "query_id", "left")
        .groupBy("term").agg(F.min(rest).alias("needs"))
    )
    path = new_path(found.index.spark, "needs")
    needs.write.parquet(path)
    needs = found.index.spark.read.parquet(path)
    enough = F.col("idf") * most >= F.col("needs")
    needed = blocks.join(checked_broadcast(needs, n_asked), "term").where(enough)
    if n_asked > TERMS_WITH_BLOCKS:
        return needed
    # the last block needed of each term goes to the scan as well
    last = (
        bounds.join(known, "term").join(needs, "term").where(enough)
        .groupBy("term").agg(F.max("block").alias("last")).collect()
    )
    scanned = F.lit(False)
    for row in last:
        scanned = scanned | ((F.col("term") == row["term"]) & (F.col("block") <= row["last"]))
    return needed.where(scanned)


def fuse(rankings: list[DataFrame], k: int) -> DataFrame:
    """Reciprocal rank fusion of ``(query_id, id, rank)`` rankings."""
    votes = rankings[0].select("query_id", "id", "rank")
    for ranking in rankings[1:]:
        votes = votes.unionByName(ranking.select("query_id", "id", "rank"))
    vote = F.lit(1.0) / (F.lit(FUSION_OFFSET) + F.col("rank"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
    return (
        votes.groupBy("query_id", "id")
        .agg(F.sum(vote).alias("score"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
    )


def search_hybrid(
    found: Snapshot, queries: DataFrame, k: int = DEFAULT_RESULTS, depth: int = FUSION_DEPTH
) -> DataFrame:
    """Both rankings fused, each at least ``k`` deep."""
    depth = max(depth, k)
    return fuse(
        [search_semantic(found, queries, depth), search_fulltext(found, queries, depth)], k
    )


MODES = {
    "semantic": search_semantic,
    "approximate": search_approximate,
    "fulltext": search_fulltext,
    "hybrid": search_hybrid,
}


def search(
    index: TextIndex,
    queries: DataFrame,
    k: int = DEFAULT_RESULTS,
    mode: str = "semantic",
    columns: list[str] | None = None,
    **options: int,
) -> DataFrame:
    """Hits of every query, with the wanted source columns of the found rows.

    ``options`` go to the mode, such as ``depth`` to ``hybrid``.
    """
    found = index.current()
    hits = MODES[mode](found, queries, k, **options)
    if not columns:
        return hits
    rows = found.rows().select("bucket", F.col(index.key).alias("id"), *columns)
    # the hits are written: a table of keys, from whose buckets the scan of the rows is pruned at run time
    path = new_path(index.spark, "hits")
    hits.write.parquet(path)
    hits = index.spark.read.parquet(path).where(F.col("rank") <= k)
    hits = hits.withColumn("bucket", found.bucket_of(F.col("id")))
    hits = checked_broadcast(hits, queries.count() * k)
    return rows.join(hits, ["bucket", "id"]).select("query_id", "rank", "id", "score", *columns)


def question_context(
    index: TextIndex,
    queries: DataFrame,
    k: int = DEFAULT_RESULTS,
    mode: str = "hybrid",
    **options: int,
) -> DataFrame:
    """One row per question: the ordered context rows, with the ids to cite."""
    hits = search(index, queries, k, mode, [index.text], **options)
    entry = F.struct("rank", "id", F.col(index.text).alias("text"), "score")
    found = hits.groupBy("query_id").agg(F.sort_array(F.collect_list(entry)).alias("_found"))
    context = F.transform(
        "_found",
        lambda e: F.struct(e["id"].alias("id"), e["text"].alias("text"), e["score"].alias("score")),
    )
    return queries.join(found, "query_id", "left").select(
        "query_id", "query_text", F.coalesce(context, F.array()).alias("context")
    )
