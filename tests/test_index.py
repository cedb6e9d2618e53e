import pandas as pd
import pytest
from pyspark.sql import functions as F

from opinio.operators.changes import InvalidKey
from opinio.operators.index import TextIndex
from opinio.session import new_path
from opinio.sources import standins

ROW = "id long, review_text string, product_name string"


def fresh(spark, **options):
    return TextIndex(spark, new_path(spark, "index"), **options)


def state(index):
    """Everything a reader can see, as plain data."""
    found = index.current()
    key = index.key
    rows = {
        r[key]: (r[index.text], [tuple(t) for t in r.terms], r.n_terms, r.embedding)
        for r in found.rows().collect()
    }
    postings = {(r.term, r[key]): (r.tf, r.n_terms) for r in found.postings().collect()}
    df = {
        r.term: r.df
        for r in found.term_stats().groupBy("term").agg(F.sum("df").alias("df"))
        .where("df != 0").collect()
    }
    return rows, postings, df, (found.totals.n_docs, found.totals.n_terms)


def frame(spark, rows):
    return spark.createDataFrame(rows, ROW)


DAY1 = [(1, "good cream", "A"), (2, "bad cream", "A"), (3, "", "B"), (4, None, "B")]
DAY2 = [(1, "good cream", "A"), (2, "very bad cream", "A"), (4, "late text", "B"), (5, "new", "C")]


def test_build_keeps_source_columns_and_counts(spark):
    index = fresh(spark).build(frame(spark, DAY1))
    rows, postings, df, totals = state(index)
    assert rows[1][1:3] == ([("cream", 1), ("good", 1)], 2)
    assert postings[("bad", 2)] == (1, 2)
    assert df == {"good": 1, "bad": 1, "cream": 2}
    assert totals == (4, 4)
    assert {"product_name", "review_text", "embedding"} <= set(index.current().rows().columns)


@pytest.mark.parametrize("rows", [DAY1 + [(1, "again", "A")], DAY1 + [(None, "no key", "A")]])
def test_build_refuses_bad_keys_and_can_be_repeated(spark, rows):
    index = fresh(spark)
    with pytest.raises(InvalidKey):
        index.build(frame(spark, rows))
    assert index.snapshot() is None
    index.build(frame(spark, DAY1))
    assert index.current().totals.n_docs == 4


def test_an_index_is_not_built_twice(spark):
    index = fresh(spark).build(frame(spark, DAY1))
    with pytest.raises(ValueError, match="holds an index"):
        index.build(frame(spark, DAY2))
    with pytest.raises(ValueError, match="no index"):
        fresh(spark).current()


def test_sync_equals_a_fresh_build(spark):
    index = fresh(spark)
    days = [DAY1, DAY2, [], DAY1]
    for version, day in enumerate(days):
        assert index.sync(frame(spark, day)) == version
        rows, postings, df, totals = state(index)
        other = fresh(spark).build(frame(spark, day))
        assert (rows, postings, df, totals) == state(other)
    assert index.sync(frame(spark, DAY1)) == len(days) - 1


def files_of(index, table):
    """Files of a table by bucket."""
    found = {}
    for name in index.spark.read.parquet(f"{index.path}/{table}").inputFiles():
        found.setdefault(int(name.split("bucket=")[1].split("/")[0]), set()).add(name)
    return found


def test_only_touched_buckets_are_written(spark):
    rows = [(i, f"text number{i}", "A") for i in range(200)]
    index = fresh(spark, n_buckets=16).build(frame(spark, rows))
    before = {t: files_of(index, t) for t in ("rows", "postings", "stats")}
    changed = [*rows[1:7], (7, "another text", "A"), *rows[8:], (500, "new", "B")]
    assert index.sync(frame(spark, changed)) == 1
    keys = spark.createDataFrame([(0,), (7,), (500,)], "id long")
    touched = {r[0] for r in keys.select(index.current().bucket_of(F.col("id"))).collect()}
    for table, known in before.items():
        now = files_of(index, table)
        assert {b for b in now if now[b] != known.get(b)} == touched
    assert state(index) == state(fresh(spark, n_buckets=3).build(frame(spark, changed)))


def test_reads_take_the_tables_as_they_are(spark):
    index = fresh(spark).build(frame(spark, DAY1))
    index.sync(frame(spark, DAY2))
    for rows in (index.current().rows(), index.current().postings()):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan


def test_documents_survive_a_day_of_changes(spark, data):
    before, after = standins.snapshots(spark, data)
    index = fresh(spark).build(before)
    index.sync(after)
    assert state(index) == state(fresh(spark).build(after))


def test_a_sync_that_failed_half_way_is_mended_by_the_next(spark, monkeypatch):
    index = fresh(spark).build(frame(spark, DAY1))
    index.current().cells()

    def dead(*_):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(TextIndex, "_derive", dead)
    with pytest.raises(RuntimeError):
        index.sync(frame(spark, DAY2))
    monkeypatch.undo()
    index.sync(frame(spark, DAY2))
    assert state(index) == state(fresh(spark).build(frame(spark, DAY2)))
    index.sync(frame(spark, DAY1))
    assert state(index) == state(fresh(spark).build(frame(spark, DAY1)))


def test_a_build_that_failed_leaves_nothing_to_the_next(spark, monkeypatch):
    index = fresh(spark)

    def dead(*_):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(TextIndex, "_derive", dead)
    with pytest.raises(RuntimeError):
        index.build(frame(spark, [(i, f"old {i}", "A") for i in range(40)]))
    monkeypatch.undo()
    index.build(frame(spark, DAY1))
    assert state(index) == state(fresh(spark).build(frame(spark, DAY1)))


def test_a_numbered_change_is_applied_once(spark):
    index = fresh(spark).build(frame(spark, DAY1))
    more = spark.createDataFrame([(9, "more", "Z", 4), (1, "first", "A", 5)], ROW + ", change_seq long")
    gone = spark.createDataFrame([(2, 6)], "id long, change_seq long")
    assert index.apply(more, gone) == 1
    after = state(index)
    assert index.apply(more, gone) == 1 and state(index) == after
    late = spark.createDataFrame([(2, "risen", "A", 3), (9, "late", "Z", 4)], ROW + ", change_seq long")
    assert index.apply(late) == 1 and state(index) == after
    # a change without a number is applied, and does not open the key to late ones
    index.apply(frame(spark, [(9, "plain", "Z")]))
    index.apply(late)
    assert index.current().rows().where("id = 9").first().review_text == "plain"


def test_a_bucket_can_be_emptied_and_filled_again(spark):
    index = fresh(spark, n_buckets=4).build(frame(spark, DAY1))
    index.sync(frame(spark, []))
    assert state(index) == ({}, {}, {}, (0, 0))
    index.sync(frame(spark, DAY2))
    assert state(index) == state(fresh(spark).build(frame(spark, DAY2)))


def test_cells_follow_a_sync(spark):
    from opinio.operators.search import search

    rows = [(i, f"word{i % 7} extra{i}", "A") for i in range(60)]
    index = fresh(spark).build(frame(spark, rows))
    asked = spark.createDataFrame([(1, "word3 extra999")], "query_id int, query_text string")
    search(index, asked, 1, "approximate").collect()
    index.sync(frame(spark, [*rows[:50], (999, "word3 extra999", "B"), (0, "other", "A")][1:]))
    assert search(index, asked, 1, "approximate").first().id == 999
    cells = {r.id for r in index.current().cells().rows().where("embedding is not null").collect()}
    assert cells == {r.id for r in index.current().rows().collect()}


def test_a_hot_term_spans_blocks(spark, monkeypatch):
    rows = [(i, "hot " * (1 + i % 5) + f"rare{i}", "A") for i in range(900)]
    index = fresh(spark, n_buckets=2).build(frame(spark, rows))
    blocks = index.current().blocks().where("term = 'hot'").collect()
    assert len(blocks) >= 8 and sum(b.n for b in blocks) == 900
    for b in blocks:
        assert b.n == len(b.entries) <= 128
        assert b.most_tf == max(e.tf for e in b.entries)
        assert b.least_terms == min(e.n_terms for e in b.entries)
    for bucket in {b.bucket for b in blocks}:
        mine = sorted((b for b in blocks if b.bucket == bucket), key=lambda b: b.block)
        assert [b.block for b in mine] == list(range(len(mine)))


def test_describe(spark):
    row = fresh(spark).build(frame(spark, DAY1)).current().describe().first()
    assert (row.n_docs, row.n_distinct_terms, row.dimension, row.mean_terms) == (4, 3, 256, 1.0)
    assert row.version == 0 and row.synced_at is not None


def test_merged_sketches_estimate_the_terms(spark):
    rows = [(i, " ".join(f"w{i * 20 + j}" for j in range(20)), "A") for i in range(1500)]
    index = fresh(spark).build(frame(spark, rows))
    index.sync(frame(spark, [*rows[100:], (5000, "w7 quite new", "B")]))
    found = index.current()
    exact = found.n_distinct_terms().first()[0]
    assert exact == 1400 * 20 + 3
    assert abs(found.describe().first().n_distinct_terms - exact) <= 0.02 * exact


def test_a_callers_model_makes_the_vectors(spark):
    @F.pandas_udf("array<float>")
    def lengths(texts: pd.Series) -> pd.Series:
        return texts.fillna("").map(lambda t: [float(len(t)), 1.0])

    index = fresh(spark, embed=lengths).build(frame(spark, DAY1))
    assert index.current().totals.dimension == 2
    assert index.current().rows().where("id = 1").first().embedding == [10.0, 1.0]

    from opinio.operators.search import search

    asked = spark.createDataFrame([(1, "0123456789")], "query_id int, query_text string")
    assert search(index, asked, 1).first().id == 1


def test_other_key_and_text_columns(spark):
    index = fresh(spark, key="sku", text="body")
    index.sync(spark.createDataFrame([("a", "one two"), ("b", "two")], "sku string, body string"))
    index.sync(spark.createDataFrame([("b", "two three")], "sku string, body string"))
    assert set(state(index)[1]) == {("two", "b"), ("three", "b")}


@pytest.mark.parametrize("extra", [(1, "good cream", "A"), (None, "no key", "A")])
def test_sync_refuses_bad_keys_before_it_writes(spark, extra):
    index = fresh(spark).build(frame(spark, DAY1))
    with pytest.raises(InvalidKey):
        index.sync(frame(spark, [*DAY1, extra]))
    assert index.current().totals.version == 0
    assert state(index) == state(fresh(spark).build(frame(spark, DAY1)))


def test_a_new_source_column_is_kept_and_a_new_type_refused(spark):
    index = fresh(spark).build(frame(spark, DAY1))
    more = frame(spark, DAY2).withColumn("extra", F.col("id") * 2)
    assert index.sync(more) == 1
    assert {r.id: r.extra for r in index.current().rows().collect()} == {1: 2, 2: 4, 4: 8, 5: 10}
    index.sync(frame(spark, DAY1))
    assert {r.extra for r in index.current().rows().collect()} == {None}
    with pytest.raises(ValueError, match="extra was bigint, is string"):
        index.sync(more.withColumn("extra", F.col("extra").cast("string")))
