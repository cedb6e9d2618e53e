import pytest

from opinio.operators.changes import (
    InvalidKey,
    apply_changes,
    change_set,
    check_key,
    latest_per_key,
    with_row_hash,
)

ROW = "id long, text string, price double"


def test_every_kind_of_change(spark):
    old = spark.createDataFrame(
        [(1, "same", 1.0), (2, "gone", 1.0), (3, "before", 1.0), (4, None, 1.0), (5, "x", None)], ROW
    )
    new = spark.createDataFrame(
        [(1, "same", 1.0), (3, "after", 1.0), (4, "value", 1.0), (5, "x", None), (6, "new", 1.0)], ROW
    )
    changes = change_set(with_row_hash(old), with_row_hash(new), "id")
    assert dict(changes.collect()) == {2: "delete", 3: "update", 4: "update", 6: "insert"}
    applied = apply_changes(old, new, changes, "id")
    assert sorted(map(tuple, applied.collect()), key=str) == sorted(
        map(tuple, new.collect()), key=str
    )


def test_column_order_is_no_change(spark):
    rows = spark.createDataFrame([(1, "a", 2.0)], ROW)
    turned = rows.select("price", "id", "text")
    assert change_set(with_row_hash(rows), with_row_hash(turned), "id").isEmpty()


@pytest.mark.parametrize("ids", [[1, 2, 1], [1, None]])
def test_bad_keys_are_refused(spark, ids):
    rows = spark.createDataFrame([(i,) for i in ids], "id long")
    with pytest.raises(InvalidKey):
        check_key(rows, "id")
    check_key(rows.where("id = 2"), "id")


def test_the_last_change_of_a_key_wins_even_for_a_hot_key(spark):
    rows = spark.range(6000).selectExpr(
        "if(id % 3 = 0, 0, id % 100) AS key", "id AS seq", "concat('v', id) AS value"
    )
    got = {r.key: r.value for r in latest_per_key(rows.repartition(9), "key", "seq").collect()}
    want = {}
    for r in sorted(rows.collect(), key=lambda r: r.seq):
        want[r.key] = r.value
    assert got == want
