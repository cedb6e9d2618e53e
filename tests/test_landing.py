import pytest
from pyspark.sql import functions as F

from opinio.sources.landing import join_path, scan_csv, source_files, with_lineage
from opinio.session import new_path


def test_single_line_read_splits_quoted_breaks(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text('product_id,review_text,rating\nP1,"line one\nline two",5\nP2,plain,4\n')
    broken = scan_csv(spark, str(path))
    assert broken.count() == 3
    assert {r.product_id for r in broken.where("rating is null").collect()} >= {"P1"}
    whole = scan_csv(spark, str(path), multi_line=True).orderBy("product_id").collect()
    assert [(r.product_id, r.review_text, r.rating) for r in whole] == [
        ("P1", "line one\nline two", 5),
        ("P2", "plain", 4),
    ]


def test_doubled_quotes_need_the_repair_option(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('id,review_text,rating\n1,"he said ""wow"", ok",5\n')
    repaired = scan_csv(spark, str(path), multi_line=True).first()
    assert (repaired.review_text, repaired.rating) == ('he said "wow", ok', 5)
    assert scan_csv(spark, str(path)).first().review_text != repaired.review_text


def test_one_malformed_value_changes_the_inferred_type(spark, tmp_path):
    (tmp_path / "good.csv").write_text("id,price\n1,2.5\n")
    (tmp_path / "bad.csv").write_text("id,price\n1,2.5\n2,n/a\n")
    good, bad = (scan_csv(spark, str(tmp_path / f)) for f in ("good.csv", "bad.csv"))
    assert good.schema["price"].dataType.simpleString() == "double"
    assert bad.schema["price"].dataType.simpleString() == "string"
    fixed = scan_csv(spark, str(tmp_path / "good.csv"), schema="id bigint, price double")
    assert [t for _, t in fixed.dtypes] == ["bigint", "double"]


def test_glob_reads_all_files_with_their_lineage(spark, tmp_path):
    for name, rows in (("reviews_1", "P1,5\n"), ("reviews_2", "P2,1\nP3,2\n"), ("other", "X,9\n")):
        (tmp_path / f"{name}.csv").write_text("product_id,rating\n" + rows)
    bronze = with_lineage(scan_csv(spark, join_path(f"{tmp_path}/", "reviews*.csv")))
    assert bronze.columns == ["product_id", "rating", "file_modification_time", "file_path"]
    assert bronze.count() == 3
    assert bronze.schema["file_modification_time"].dataType.simpleString() == "timestamp"
    names = sorted(r.file_path.rsplit("/", 1)[1] for r in source_files(bronze).collect())
    assert names == ["reviews_1.csv", "reviews_2.csv"]


def test_shared_folder_comes_from_the_session(spark):
    assert new_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert new_path(spark, "x") != new_path(spark, "x")


def test_a_schema_does_not_mislabel_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("product_id,rating\nP1,5\n")
    (tmp_path / "b.csv").write_text("rating,product_id\n4,P2\n")
    schema = "product_id string, rating int"
    assert scan_csv(spark, str(tmp_path / "a.csv"), schema=schema).first().rating == 5
    with pytest.raises(Exception, match="header"):
        scan_csv(spark, str(tmp_path / "b.csv"), schema=schema).collect()
    # by position, if asked for
    assert scan_csv(spark, str(tmp_path / "b.csv"), schema=schema, check_header=False).count() == 1


ODD_CSV = (
    'id,name,text\n1,a,plain\n2,"b ""x""","two\nlines"\n3,,"a, ""quoted""\n\nbreak"\n\n'
    '4,"id,name,text","id,name,text\n"\nid,name,text\n5,e,""\n6,\u00e9\u6c34,"' + "long\n" * 400 + '"\n7,g,end'
)
ODD_SCHEMA = "id int, name string, text string"


@pytest.mark.parametrize("split", [7, 64, 700, 1 << 20])
@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_one_file_is_read_by_many_tasks(spark, tmp_path, split, ending):
    from opinio.sources.splittable import scan_csv_in_splits

    schema = spark.createDataFrame([], ODD_SCHEMA).schema
    path = tmp_path / "odd.csv"
    path.write_bytes(ODD_CSV.replace("\n", ending).encode())
    (tmp_path / "more.csv").write_text("id,name,text\n8,h,last\n")
    want = scan_csv(spark, str(tmp_path), schema=schema, multi_line=True).collect()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        got = scan_csv_in_splits(spark, str(tmp_path), schema, lineage=True)
        rows = got.collect()
        n_splits = spark.read.text(str(path)).select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert split > 100 or n_splits > 5
    assert sorted(str(tuple(r)[:3]) for r in rows) == sorted(str(tuple(r)) for r in want)
    assert {r.file_path.rsplit("/", 1)[1] for r in rows} == {"odd.csv", "more.csv"}
    assert all(r.file_modification_time is not None for r in rows)


def test_a_split_read_refuses_other_headers(spark, tmp_path):
    from opinio.sources.splittable import scan_csv_in_splits

    (tmp_path / "a.csv").write_text("name,id,text\nx,1,y\n")
    with pytest.raises(ValueError, match="a.csv: its header"):
        scan_csv_in_splits(spark, str(tmp_path), spark.createDataFrame([], ODD_SCHEMA).schema)


def test_headers_in_any_order_and_bad_records(spark, tmp_path):
    from opinio.sources.headers import scan_csv_by_header

    (tmp_path / "a.csv").write_text("product_id,rating,extra\nP1,5,x\nP2,bad,y\n")
    (tmp_path / "b.csv").write_text("\ufeff Rating , product_id\n4,P3\n2,P4,too many\n")
    (tmp_path / "c.csv").write_text("product_id\nP5\n")
    (tmp_path / "empty.csv").write_text("")
    schema = spark.createDataFrame([], "product_id string, rating int").schema
    rows = scan_csv_by_header(spark, f"{tmp_path}/*.csv", schema).collect()
    assert sorted((r.product_id, r.rating, r.bad_record) for r in rows if r.bad_record is None) == [
        ("P1", 5, None), ("P3", 4, None), ("P5", None, None)
    ]
    assert sorted(r.bad_record for r in rows if r.bad_record) == ["2,P4,too many", "P2,bad,y"]
    none = scan_csv_by_header(spark, f"{tmp_path}/empty.csv", schema)
    assert none.columns == ["product_id", "rating", "bad_record"] and none.count() == 0


def test_a_scope_is_emptied_and_the_rest_stays(spark):
    from opinio.session import path_exists, remove, scope

    kept = new_path(spark, "kept")
    spark.range(2).write.parquet(kept)
    with pytest.raises(RuntimeError):
        with scope(spark, "work"):
            inner = new_path(spark, "inner")
            spark.range(3).write.parquet(inner)
            with scope(spark, "deeper"):
                assert new_path(spark, "x").startswith(inner.rsplit("/", 1)[0])
            raise RuntimeError
    assert not path_exists(spark, inner) and spark.read.parquet(kept).count() == 2
    for path in ("/etc/passwd", spark.conf.get("spark.checkpoint.dir") + "/"):
        with pytest.raises(ValueError):
            remove(spark, path)
    remove(spark, kept)
    assert not path_exists(spark, kept)
