"""The registered queries: one per operator, each over its whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinio.functions.rows import fingerprint
from opinio.functions.counting import with_counts
from opinio.functions.text import term_counts
from opinio.operators import meaning, ratings, reviews, search, silver
from opinio.operators.cells import VectorCells, scored_share
from opinio.operators.changes import apply_changes, change_set, with_row_hash
from opinio.operators.index import Snapshot, TextIndex, with_vector
from opinio.plans import layered
from opinio.session import new_path
from opinio.sources import headers, landing, splittable, standins, tables
from opinio.streaming.sync import sync_available

Query = Callable[[SparkSession, str], DataFrame]

_INDEXES: dict[tuple, TextIndex] = {}


def corpus_index(spark: SparkSession, folder: str) -> TextIndex:
    """The index over all documents, built once per application and state of the files."""
    files = standins.table(spark, folder, "documents").select(
        "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time"
    )
    state = files.distinct().agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64(*files.columns))
    )
    known = (spark.sparkContext.applicationId, folder, *state.first())
    if known not in _INDEXES:
        index = TextIndex(spark, new_path(spark, "index"))
        _INDEXES[known] = index.build(standins.corpus(spark, folder))
    return _INDEXES[known]


def silver_rows(spark: SparkSession, folder: str) -> DataFrame:
    return silver.join_reviews(standins.products(spark, folder), standins.reviews(spark, folder))


# -- sources and sinks ---------------------------------------------------------


def _write_csv(rows: DataFrame, path: str) -> None:
    """Write with doubled quotes and untouched spaces."""
    rows.write.csv(
        path,
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "parts")
    _write_csv(standins.table(spark, folder, "part"), path)
    return landing.scan_csv(spark, path)


def csv_glob_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "orders")
    orders = standins.table(spark, folder, "orders")
    _write_csv(orders.repartition("o_orderpriority"), path)
    found = landing.scan_csv(spark, f"{path}/part-*.csv")
    return found.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


def csv_multiline_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "documents")
    documents = standins.table(spark, folder, "documents")
    _write_csv(documents, path)
    return landing.scan_csv(spark, path, schema=documents.schema, multi_line=True)


def csv_split_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The same files, each shared by the tasks of its blocks."""
    path = new_path(spark, "documents")
    documents = standins.table(spark, folder, "documents")
    _write_csv(documents, path)
    return splittable.scan_csv_in_splits(spark, path, documents.schema)


def csv_by_header(spark: SparkSession, folder: str) -> DataFrame:
    """Parts in files of two column orders, one of them without the size, and one bad record each
    (a part without a price); counted with what became of them."""
    path = new_path(spark, "parts")
    parts = standins.table(spark, folder, "part")
    price = F.when(F.col("p_partkey") % 100 == 7, "n/a").otherwise(F.col("p_retailprice").cast("string"))
    parts = parts.withColumn("p_retailprice", price)
    first = F.col("p_partkey") % 2 == 0
    order = ["p_retailprice", "p_brand", "p_name", "p_partkey", "p_type"]
    _write_csv(parts.where(first), f"{path}/a")
    _write_csv(parts.where(~first).select(*order), f"{path}/b")
    schema = standins.table(spark, folder, "part").schema
    found = headers.scan_csv_by_header(spark, f"{path}/*", schema)
    return found.withColumn("is_bad", F.col("bad_record").isNotNull()).drop("bad_record")


def file_lineage(spark: SparkSession, folder: str) -> DataFrame:
    """The rows with the name of their file, and whether its time is known."""
    rows = landing.with_lineage(standins.table(spark, folder, "part"))
    return rows.select(
        *(c for c in rows.columns if c not in landing.LINEAGE),
        F.regexp_extract("file_path", "(part)[.]parquet", 1).alias("file_name"),
        F.col("file_modification_time").isNotNull().alias("has_time"),
    )


def loaded_files(spark: SparkSession, folder: str) -> DataFrame:
    """Line items landed as one folder per return flag, counted by where they came from."""
    path = new_path(spark, "items")
    items = standins.table(spark, folder, "lineitem").withColumn("flag", F.col("l_returnflag"))
    items.write.partitionBy("flag").csv(path, header=True)
    bronze = landing.with_lineage(landing.scan_csv(spark, f"{path}/flag=*"))
    origin = F.regexp_extract("file_path", "flag=([^/]+)/", 1)
    return bronze.groupBy(origin.alias("flag")).agg(F.count(F.lit(1)).alias("n_rows"))


def table_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    name = f"opinio_{uuid.uuid4().hex}"
    path = new_path(spark, name)
    tables.overwrite_table(standins.reviews(spark, folder), name, "parquet", path)
    tables.overwrite_table(standins.products(spark, folder), name, "parquet", path)
    return tables.read_table(spark, name)


def layered_gold(spark: SparkSession, folder: str) -> DataFrame:
    """Landing files to the stored gold table, with ids that survive a rerun."""
    files = new_path(spark, "landing")
    _write_csv(standins.products(spark, folder), landing.join_path(files, layered.PRODUCT_FILE))
    _write_csv(standins.reviews(spark, folder), landing.join_path(files, "reviews_all.csv"))
    layers = layered.Layers(
        prefix=f"opinio_{uuid.uuid4().hex}", location=new_path(spark, "layers")
    )
    layered.run_all(
        spark,
        files,
        layers,
        add_id=silver.with_stable_id,
        product_options={"schema": standins.products(spark, folder).schema},
        review_options={"schema": standins.reviews(spark, folder).schema},
    )
    return tables.read_table(spark, layers.gold)


# -- relational operators ------------------------------------------------------


def silver_join(spark: SparkSession, folder: str) -> DataFrame:
    return silver_rows(spark, folder)


def product_rating_stats(spark: SparkSession, folder: str) -> DataFrame:
    return ratings.rating_stats(silver_rows(spark, folder))


def polarised_products(spark: SparkSession, folder: str) -> DataFrame:
    return ratings.polarised(ratings.rating_stats(silver_rows(spark, folder)))


def product_divisiveness(spark: SparkSession, folder: str) -> DataFrame:
    return ratings.ranked(ratings.divisiveness(ratings.rating_stats(silver_rows(spark, folder))))


def gold_product(spark: SparkSession, folder: str) -> DataFrame:
    return ratings.gold(silver_rows(spark, folder))


def gold_product_join(spark: SparkSession, folder: str) -> DataFrame:
    return ratings.gold_by_join(silver_rows(spark, folder))


def lenient_rating_cast(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.substring("props", 7, 2)
    return standins.table(spark, folder, "events").select(
        "event_id", raw.alias("raw"), ratings.as_score(raw).alias("score")
    )


def stable_row_id(spark: SparkSession, folder: str) -> DataFrame:
    return silver.with_stable_id(silver_rows(spark, folder))


def surrogate_id_unique(spark: SparkSession, folder: str) -> DataFrame:
    return silver.id_check(silver.with_surrogate_id(silver_rows(spark, folder)))


def distinct_sources(spark: SparkSession, folder: str) -> DataFrame:
    return landing.distinct_values(standins.table(spark, folder, "documents"), "source")


def preview(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows a preview has, and how many of them are silver rows."""
    silver_marks = silver_rows(spark, folder)
    mark = fingerprint(silver_marks, silver_marks.columns).alias("mark")
    known = silver_marks.select(mark).distinct().withColumn("known", F.lit(1))
    shown = tables.preview(silver_rows(spark, folder)).select(mark)
    return shown.join(known, "mark", "left").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("known").alias("n_silver")
    )


# -- text index ----------------------------------------------------------------


def _exploded_vector(rows: DataFrame, key: str) -> DataFrame:
    entries = rows.select(key, F.explode_outer("_vector").alias("_e"))
    return entries.where(F.col("_e").isNotNull()).select(
        key, "_e.bucket", "_e.n", F.round("_e.weight", 6).alias("weight")
    )


def hashed_embedding(spark: SparkSession, folder: str) -> DataFrame:
    documents = standins.corpus(spark, folder).select("id", "review_text")
    vectors = with_counts(documents, "review_text", "sparse").select("id", "embedding")
    return _exploded_vector(vectors.withColumnRenamed("embedding", "_vector"), "id")


def query_embedding(spark: SparkSession, folder: str) -> DataFrame:
    asked = standins.questions(spark, folder)
    counted = asked.select("query_id", term_counts(F.col("query_text")).alias("terms"))
    dense = with_vector(counted, "query_text", None)
    return (
        dense.select("query_id", F.posexplode("embedding").alias("bucket", "weight"))
        .where(F.col("weight") != 0)
        .select("query_id", "bucket", F.round(F.col("weight").cast("double"), 6).alias("weight"))
    )


def index_build(spark: SparkSession, folder: str) -> DataFrame:
    index = TextIndex(spark, new_path(spark, "index")).build(standins.corpus(spark, folder))
    built = index.current()
    rows = built.rows().agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_keys")
    )
    postings = built.postings().agg(
        F.count(F.lit(1)).alias("n_postings"), F.sum("tf").alias("n_tokens")
    )
    return rows.select(F.lit("rows").alias("what"), F.col("n_rows").alias("n"), "n_keys").unionByName(
        postings.select(
            F.lit("postings").alias("what"), F.col("n_postings").alias("n"),
            F.col("n_tokens").alias("n_keys"),
        )
    )


def index_terms(spark: SparkSession, folder: str) -> DataFrame:
    stats = corpus_index(spark, folder).current().term_stats()
    return stats.groupBy("term").agg(F.sum("df").alias("df"))


def index_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Description of the index, with the exact number of terms beside the merged sketches' estimate."""
    found = corpus_index(spark, folder).current()
    described = found.describe().withColumnRenamed("n_distinct_terms", "estimate")
    exact = F.col("n_distinct_terms")
    return described.crossJoin(found.n_distinct_terms()).select(
        "n_docs", "n_distinct_terms", "dimension", F.round("mean_terms", 6).alias("mean_terms"),
        (F.abs(F.col("estimate") - exact) <= 0.02 * exact).alias("estimate_holds"),
    )


def index_change_set(spark: SparkSession, folder: str) -> DataFrame:
    before, after = standins.snapshots(spark, folder)
    return change_set(with_row_hash(before), with_row_hash(after), "id")


def snapshot_after_changes(spark: SparkSession, folder: str) -> DataFrame:
    before, after = standins.snapshots(spark, folder)
    changes = change_set(with_row_hash(before), with_row_hash(after), "id")
    return apply_changes(before, after, changes, "id")


def _summary(found: Snapshot) -> DataFrame:
    """Live rows with what the index derived from them."""
    matches = found.postings().groupBy("id").agg(
        F.count(F.lit(1)).alias("n_postings"), F.sum("tf").alias("n_tokens")
    )
    rows = found.rows().select("id", "review_text", "lang", "source")
    return rows.join(matches, "id", "left").fillna(0, ["n_postings", "n_tokens"])


def index_after_sync(spark: SparkSession, folder: str) -> DataFrame:
    before, after = standins.snapshots(spark, folder)
    index = TextIndex(spark, new_path(spark, "index")).build(before)
    index.sync(after)
    return _summary(index.current())


def index_terms_after_sync(spark: SparkSession, folder: str) -> DataFrame:
    before, after = standins.snapshots(spark, folder)
    index = TextIndex(spark, new_path(spark, "index")).build(before)
    index.sync(after)
    return index.current().term_stats().groupBy("term").agg(F.sum("df").alias("df")).where("df > 0")


def stream_sync(spark: SparkSession, folder: str) -> DataFrame:
    """The same two snapshots as change files read by a stream, then the first changes again, late."""
    before, after = standins.snapshots(spark, folder)
    changes = change_set(with_row_hash(before), with_row_hash(after), "id")
    first = before.withColumns({"op": F.lit("upsert"), "seq": F.lit(0)})
    fresh = after.join(changes.where("change != 'delete'").select("id"), "id", "left_semi")
    gone = changes.where("change = 'delete'").select("id", F.lit("delete").alias("op"))
    second = fresh.withColumn("op", F.lit("upsert")).unionByName(gone, allowMissingColumns=True)
    touched = second.select("id")
    late = first.join(touched, "id", "left_semi").select(*first.columns)
    feed, checkpoint = new_path(spark, "feed"), new_path(spark, "stream")
    index = TextIndex(spark, new_path(spark, "index"))
    for day in (first, second.withColumn("seq", F.lit(1)), late):
        day.write.mode("append").parquet(feed)
        sync_available(index, feed, first.schema, checkpoint)
    return _summary(index.current())


# -- search --------------------------------------------------------------------


def semantic_topk(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector asks for its three nearest, itself included."""
    vectors = standins.table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), "embedding"
    )
    return search.semantic_topk(vectors, vectors.withColumnRenamed("id", "query_id"), 3)


def _cells(spark: SparkSession, folder: str) -> tuple[VectorCells, DataFrame, DataFrame]:
    """All vectors in trained cells, the vectors, and those whose id is divisible by 50 as queries."""
    vectors = standins.table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), "embedding"
    )
    cells = VectorCells(spark, new_path(spark, "cells")).build(vectors)
    return cells, vectors, vectors.where("id % 50 = 0").withColumnRenamed("id", "query_id")


def semantic_cells_topk(spark: SparkSession, folder: str) -> DataFrame:
    """Approximate hits: one vector in fifty asks all for its four nearest, itself included."""
    cells, _, queries = _cells(spark, folder)
    return cells.search(queries, 4)


def semantic_topk_approx(spark: SparkSession, folder: str) -> DataFrame:
    """How the approximate hits of the same queries compare with the exact ones: by query the
    exact hits asked for (its own row not counted), whether they are found in nine of ten cases
    over all queries, and whether fewer than a quarter of all vectors are scored."""
    cells, vectors, queries = _cells(spark, folder)
    exact, near = (
        # one more than three: its own row is left out
        hits.where("query_id <> id").withColumn(
            "place", F.row_number().over(Window.partitionBy("query_id").orderBy("rank"))
        ).where("place <= 3").select("query_id", "id", "score")
        for hits in (search.semantic_topk(vectors, queries, 4), cells.search(queries, 4))
    )
    # a found hit has the exact score: the same cosine of the same vectors
    found = exact.join(near.withColumn("near", F.lit(1)), ["query_id", "id", "score"], "left")
    per_query = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_exact"), F.count("near").alias("n_near"))
    held = (F.sum("n_near") >= 0.9 * F.sum("n_exact")).alias("held")
    n_vectors = vectors.agg(F.count(F.lit(1)).alias("n")).scalar()
    n_scored = scored_share(cells, queries).agg(F.avg("n")).scalar()
    return per_query.select(
        "query_id",
        "n_exact",
        per_query.agg(held).scalar().alias("recall_holds"),
        (n_scored < 0.25 * n_vectors).alias("few_scored"),
    )


def semantic_text_topk(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(
        corpus_index(spark, folder), standins.questions(spark, folder), 3, "semantic",
        ["lang", "source", "review_text"],
    )


def fulltext_topk(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(
        corpus_index(spark, folder), standins.questions(spark, folder), 3, "fulltext"
    )


def hybrid_topk(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(
        corpus_index(spark, folder), standins.questions(spark, folder), 3, "hybrid"
    )


def hybrid_topk_deep(spark: SparkSession, folder: str) -> DataFrame:
    """More results than the usual depth of the two rankings."""
    return search.search(
        corpus_index(spark, folder), standins.questions(spark, folder), 60, "hybrid"
    )


def question_context(spark: SparkSession, folder: str) -> DataFrame:
    contexts = search.question_context(
        corpus_index(spark, folder), standins.questions(spark, folder), 3
    )
    return contexts.select(
        "query_id", F.posexplode("context").alias("position", "_hit")
    ).select("query_id", "position", "_hit.id", "_hit.text", "_hit.score")


def meaning_topk(spark: SparkSession, folder: str) -> DataFrame:
    """Questions against all documents, both in the corpus' strongest directions."""
    corpus = standins.corpus(spark, folder)
    embed = meaning.fit(corpus, "review_text").embed()
    path = new_path(spark, "vectors")
    corpus.select("id", embed(F.col("review_text")).alias("embedding")).write.parquet(path)
    asked = standins.questions(spark, folder)
    queries = asked.select("query_id", embed(F.col("query_text")).alias("embedding"))
    return search.semantic_topk(spark.read.parquet(path), queries, 3)


def last_user_text(spark: SparkSession, folder: str) -> DataFrame:
    return reviews.last_user_text(standins.table(spark, folder, "conversations"))


def conversation_context(spark: SparkSession, folder: str) -> DataFrame:
    """Context for what the user asked last in each conversation."""
    asked = last_user_text(spark, folder).select(
        F.col("conv_id").alias("query_id"), F.col("last_text").alias("query_text")
    )
    return search.search(corpus_index(spark, folder), asked, 3, "fulltext")


def conversation_context_default(spark: SparkSession, folder: str) -> DataFrame:
    """The same questions as a caller asks them who names no mode."""
    asked = last_user_text(spark, folder).select(
        F.col("conv_id").alias("query_id"), F.col("last_text").alias("query_text")
    )
    contexts = search.question_context(corpus_index(spark, folder), asked, 3)
    return contexts.select(
        "query_id", F.posexplode("context").alias("position", "_hit")
    ).select("query_id", "position", "_hit.id", "_hit.text", "_hit.score")


def extreme_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return reviews.extreme_reviews(silver.with_stable_id(silver_rows(spark, folder)))


def text_judged_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as reviews of their source's language, rated by the editors' marks."""
    documents = standins.table(spark, folder, "documents")
    labels = standins.table(spark, folder, "labels")
    rating = F.when(F.col("quality") == 1, "5").when(F.col("quality") == 0, "1")
    rated = documents.join(labels, "doc_id", "left").select(
        F.col("lang").alias("product_id"),
        F.col("doc_id").alias("id"),
        rating.alias("rating"),
        F.col("text").alias("review_text"),
    )
    return reviews.text_judged_reviews(rated)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        csv_scan,
        csv_glob_scan,
        csv_multiline_scan,
        csv_split_scan,
        csv_by_header,
        file_lineage,
        loaded_files,
        table_overwrite,
        layered_gold,
        silver_join,
        product_rating_stats,
        polarised_products,
        product_divisiveness,
        gold_product,
        gold_product_join,
        lenient_rating_cast,
        stable_row_id,
        surrogate_id_unique,
        distinct_sources,
        preview,
        hashed_embedding,
        query_embedding,
        index_build,
        index_terms,
        index_stats,
        index_change_set,
        snapshot_after_changes,
        index_after_sync,
        index_terms_after_sync,
        stream_sync,
        semantic_topk,
        semantic_topk_approx,
        semantic_cells_topk,
        semantic_text_topk,
        fulltext_topk,
        hybrid_topk,
        hybrid_topk_deep,
        question_context,
        meaning_topk,
        last_user_text,
        conversation_context,
        conversation_context_default,
        extreme_reviews,
        text_judged_reviews,
    )
}
