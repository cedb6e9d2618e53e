"""The same four datasets as a declarative pipeline.

The runner takes the order of the datasets from the tables they read. The
builders are those of the layered job; none of them looks at a schema or starts
a job, which a pipeline definition may not do.
"""

from __future__ import annotations

from pyspark import pipelines
from pyspark.sql import DataFrame, SparkSession

from opinio.operators.ratings import gold
from opinio.operators.silver import join_reviews, with_surrogate_id
from opinio.plans import layered
from opinio.plans.layered import AddId, Layers


def define(
    spark: SparkSession,
    landing: str,
    layers: Layers,
    gold_properties: dict[str, str] | None = None,
    add_id: AddId = with_surrogate_id,
    product_options: dict | None = None,
    review_options: dict | None = None,
) -> None:
    """``add_id`` may be the stable id, which spares an index a rewrite at every refresh."""

    @pipelines.materialized_view(name=layers.bronze_products)
    def products() -> DataFrame:
        return layered.bronze_products(spark, landing, **(product_options or {}))

    @pipelines.materialized_view(name=layers.bronze_reviews)
    def reviews() -> DataFrame:
        return layered.bronze_reviews(spark, landing, **(review_options or {}))

    @pipelines.materialized_view(name=layers.silver)
    def silver() -> DataFrame:
        bronze = (spark.read.table(n) for n in (layers.bronze_products, layers.bronze_reviews))
        return add_id(join_reviews(*bronze))

    @pipelines.materialized_view(name=layers.gold, table_properties=gold_properties or {})
    def chosen() -> DataFrame:
        return gold(spark.read.table(layers.silver))
