import pytest
from test_index import state

from opinio.operators.index import TextIndex
from opinio.session import new_path
from opinio.streaming.sync import sync_available

FEED = "id long, review_text string, op string, seq long"


def deliver(spark, folder, rows):
    spark.createDataFrame(rows, FEED).coalesce(1).write.mode("append").parquet(folder)


def test_changes_are_applied_once_in_order(spark):
    folder, checkpoint = new_path(spark, "feed"), new_path(spark, "stream")
    index = TextIndex(spark, new_path(spark, "index"))
    deliver(spark, folder, [(1, "one", "upsert", 1), (2, "two", "upsert", 2)])
    deliver(spark, folder, [(1, "uno", "upsert", 3), (3, "three", "upsert", 4)])
    assert sync_available(index, folder, FEED, checkpoint, files_per_batch=1) == 2
    assert {i: r[0] for i, r in state(index)[0].items()} == {1: "uno", 2: "two", 3: "three"}

    assert sync_available(index, folder, FEED, checkpoint) == 0
    version = index.current().totals.version

    # newest change first in the file, and a key that comes and goes
    deliver(spark, folder, [(2, None, "delete", 9), (2, "zwei", "upsert", 8), (1, "un", "upsert", 7)])
    assert sync_available(index, folder, FEED, checkpoint) == 1
    assert {i: r[0] for i, r in state(index)[0].items()} == {1: "un", 3: "three"}
    assert index.current().totals.version == version + 1

    fresh = TextIndex(spark, new_path(spark, "index")).build(
        spark.createDataFrame([(1, "un"), (3, "three")], "id long, review_text string")
    )
    assert state(index) == state(fresh)


def test_a_replayed_batch_changes_nothing(spark):
    folder = new_path(spark, "feed")
    index = TextIndex(spark, new_path(spark, "index"))
    deliver(spark, folder, [(1, "one", "upsert", 1), (2, None, "delete", 2)])
    # the batch has reached the index, the crash came before the stream noted it
    sync_available(index, folder, FEED, new_path(spark, "stream"))
    before = state(index)
    assert sync_available(index, folder, FEED, new_path(spark, "stream")) == 1
    assert index.current().totals.version == 0 and state(index) == before


def test_a_batch_that_failed_half_way_is_finished_by_its_replay(spark, monkeypatch):
    folder, checkpoint = new_path(spark, "feed"), new_path(spark, "stream")
    index = TextIndex(spark, new_path(spark, "index"))
    deliver(spark, folder, [(1, "one", "upsert", 1)])
    sync_available(index, folder, FEED, checkpoint)
    deliver(spark, folder, [(1, "uno", "upsert", 2), (2, "two", "upsert", 3)])

    def dead(*_):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(TextIndex, "_derive", dead)
    with pytest.raises(Exception, match="lost driver"):
        sync_available(index, folder, FEED, checkpoint)
    monkeypatch.undo()
    assert sync_available(index, folder, FEED, checkpoint) == 1
    fresh = TextIndex(spark, new_path(spark, "index")).build(
        spark.createDataFrame([(1, "uno"), (2, "two")], "id long, review_text string")
    )
    assert state(index) == state(fresh)


def test_a_late_change_does_not_undo_a_newer_one(spark):
    folder, checkpoint = new_path(spark, "feed"), new_path(spark, "stream")
    index = TextIndex(spark, new_path(spark, "index"))
    days = [
        [(1, "new text", "upsert", 5), (2, None, "delete", 6), (3, "three", "upsert", 1)],
        [(1, "old text", "upsert", 3), (2, "risen", "upsert", 4), (3, "drei", "upsert", 2)],
    ]
    for day in days:
        deliver(spark, folder, day)
        assert sync_available(index, folder, FEED, checkpoint) == 1
    assert {i: r[0] for i, r in state(index)[0].items()} == {1: "new text", 3: "drei"}
