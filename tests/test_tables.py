import pytest

from opinio.sources.tables import overwrite_table, preview, read_table, set_properties


def test_overwrite_replaces_the_schema(spark):
    overwrite_table(spark.range(3), "replaced")
    overwrite_table(spark.createDataFrame([("a", 1.5)], "name string, x double"), "replaced")
    table = read_table(spark, "replaced")
    assert table.columns == ["name", "x"]
    assert table.count() == 1


def test_names_may_start_with_a_digit_and_properties_are_stored(spark):
    overwrite_table(spark.range(20), "default.1_gold_rows", "parquet", cluster_by=["id"])
    set_properties(spark, "default.1_gold_rows", {"feed.enabled": "true"})
    stored = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES 1_gold_rows").collect()}
    assert stored["feed.enabled"] == "true"
    assert preview(read_table(spark, "1_gold_rows")).count() == 10


def test_clustered_tables_let_a_lookup_skip_row_groups(spark, tmp_path):
    from opinio.operators.ratings import gold

    rows = spark.range(60_000).selectExpr(
        "id % 1500 AS product_id", "cast(1 + (id div 1500) % 5 AS string) AS rating", "id"
    )
    overwrite_table(rows, "clustered", "parquet", str(tmp_path / "t"), cluster_by=["product_id"])
    plan = gold(read_table(spark, "clustered"))._jdf.queryExecution().executedPlan().toString()
    assert "product_id" in plan.split("DataFilters")[1] and "Subquery" in plan
    assert gold(read_table(spark, "clustered")).count() == 40


def test_a_refresh_swaps_folders_and_a_failed_one_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "swapped")
    overwrite_table(spark.range(3), "swapped", "parquet", path)
    reader = read_table(spark, "swapped")
    overwrite_table(spark.range(5), "swapped", "parquet", path)
    # a reader that began before the swap finishes on the old folder
    assert reader.count() == 3 and read_table(spark, "swapped").count() == 5
    broken = spark.range(9).selectExpr("id", "if(id = 8, raise_error('lost'), 1) AS x")
    with pytest.raises(Exception, match="lost"):
        overwrite_table(broken, "swapped", "parquet", path)
    assert read_table(spark, "swapped").count() == 5
    set_properties(spark, "swapped", {"kept": "yes"})
    overwrite_table(spark.range(7), "swapped", "parquet", path)
    stored = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES swapped").collect()}
    assert stored["kept"] == "yes" and read_table(spark, "swapped").count() == 7
    overwrite_table(spark.createDataFrame([("a",)], "name string"), "swapped", "parquet", path)
    assert read_table(spark, "swapped").columns == ["name"]
    # the one before is kept for its readers, and what a failed write has left is cleared in time
    assert sum(f.name.startswith("v-") for f in (tmp_path / "swapped").iterdir()) == 2
