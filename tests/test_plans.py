import pytest
from pyspark.pipelines.graph_element_registry import (
    GraphElementRegistry,
    graph_element_registration_context,
)

from opinio.operators.index import TextIndex
from opinio.operators.ratings import Selection
from opinio.operators.search import search
from opinio.operators.silver import with_stable_id
from opinio.plans import layered
from opinio.plans.declarative import define
from opinio.plans.layered import Layers
from opinio.session import new_path

RULE = Selection(min_reviews=3, max_reviews=4)
HEADER = "author,product_id,rating,is_recommended,review_text,price_usd\n"


@pytest.fixture
def landing(tmp_path):
    (tmp_path / "product_info.csv").write_text(
        "product_id,product_name,primary_category,secondary_category,tertiary_category,highlights,x\n"
        "P1,Mask,Skin,Care,,soft,1\nP2,Brush,Tools,Hair,,hard,2\nP3,Soap,Skin,Care,,,3\n"
    )
    (tmp_path / "reviews_0.csv").write_text(
        HEADER + "u,P1,5,1,Lovely mask,10\nv,P1,1,0,Useless mask,10\nw,P1,2,0,Awkward,10\n"
    )
    (tmp_path / "reviews_1.csv").write_text(
        HEADER + "u,P2,5,1,Fine,7\nv,P9,1,0,Orphan,7\nw,P2,bad,0,Meh,7\n"
    )
    return tmp_path


def plain(rows):
    return sorted(map(tuple, rows.drop("id").collect()), key=str)


def test_landing_to_index(spark, landing):
    layers = Layers(prefix="1", location=new_path(spark, "layers"))
    index = TextIndex(spark, new_path(spark, "index"))
    layered.run_all(
        spark, f"{landing}/", layers, index, add_id=with_stable_id, rule=RULE,
        properties={"feed.enabled": "true"},
    )
    assert spark.read.table(layers.bronze_reviews).count() == 6
    assert "file_path" in spark.read.table(layers.bronze_products).columns
    silver = spark.read.table(layers.silver)
    assert silver.count() == 5 and silver.columns[-1] == "id"
    gold = spark.read.table(layers.gold)
    assert gold.columns == silver.columns
    assert {r.product_id for r in gold.collect()} == {"P1"} and gold.count() == 3
    assert {r.id for r in gold.collect()} <= {r.id for r in silver.collect()}

    asked = spark.createDataFrame([(1, "Awkward, useless")], "query_id int, query_text string")
    found = search(index, asked, 3, "fulltext", ["product_id", "product_name", "review_text"])
    assert {r.review_text for r in found.collect()} == {"Awkward", "Useless mask"}

    # an unchanged rerun keeps the ids and writes no index version; a new file does
    layered.run_all(spark, str(landing), layers, index, add_id=with_stable_id, rule=RULE)
    assert index.current().totals.version == 0
    (landing / "reviews_2.csv").write_text(HEADER + "z,P1,2,0,Dull mask,10\n")
    layered.run_all(spark, str(landing), layers, index, add_id=with_stable_id, rule=RULE)
    assert index.current().totals.version == 1
    assert index.current().rows().count() == 4


def test_empty_gold_gives_an_empty_index(spark, landing):
    layers = Layers(prefix="none", location=new_path(spark, "layers"))
    index = TextIndex(spark, new_path(spark, "index"))
    layered.run_all(spark, str(landing), layers, index)
    assert spark.read.table(layers.gold).count() == 0
    asked = spark.createDataFrame([(1, "mask")], "query_id int, query_text string")
    for mode in ("semantic", "fulltext", "hybrid"):
        assert search(index, asked, 3, mode).count() == 0


class Recorder(GraphElementRegistry):
    def __init__(self):
        self.outputs, self.flows = {}, {}

    def register_output(self, output):
        self.outputs[output.name] = output

    def register_flow(self, flow):
        self.flows[flow.target] = flow.func

    def register_sql(self, sql_text, file_path):
        raise AssertionError("no SQL datasets")


def test_the_declarative_form_gives_the_same_tables(spark, landing):
    job = Layers(prefix="job", location=new_path(spark, "layers"))
    layered.run_bronze(spark, str(landing), job)
    layered.run_silver(spark, job)
    layered.run_gold(spark, job)

    layers, recorder = Layers(prefix="declared"), Recorder()
    with graph_element_registration_context(recorder):
        define(spark, str(landing), layers, {"feed.enabled": "true"})
    names = [layers.bronze_products, layers.bronze_reviews, layers.silver, layers.gold]
    assert list(recorder.flows) == names
    assert {type(o).__name__ for o in recorder.outputs.values()} == {"MaterializedView"}
    assert recorder.outputs[layers.gold].table_properties == {"feed.enabled": "true"}
    for name in names:
        recorder.flows[name]().write.mode("overwrite").saveAsTable(name)
    for name in ("bronze_products", "bronze_reviews", "silver", "gold"):
        mine, theirs = (spark.read.table(getattr(x, name)) for x in (layers, job))
        assert plain(mine) == plain(theirs)


def test_each_landing_file_has_options_of_its_own(spark, landing):
    layers = Layers(prefix="own", location=new_path(spark, "layers"))
    names = "product_name primary_category secondary_category tertiary_category highlights x"
    layered.run_bronze(
        spark,
        str(landing),
        layers,
        product_options={"schema": "product_id string, " + ", ".join(f"{n} string" for n in names.split())},
        review_options={
            "schema": "author string, product_id string, rating string, is_recommended int,"
            " review_text string, price_usd double"
        },
    )
    assert dict(spark.read.table(layers.bronze_products).dtypes)["x"] == "string"
    assert dict(spark.read.table(layers.bronze_reviews).dtypes)["price_usd"] == "double"
    with pytest.raises(Exception, match="header|HEADER"):
        layered.run_bronze(
            spark, str(landing), layers, product_options={"schema": "rating int, product_id string"}
        )
