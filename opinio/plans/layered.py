"""The layered job: landing files to bronze, silver, gold tables and the index.

Every stage takes its inputs and outputs as arguments and hands over through a
stored table, so gold and the index see the ids that silver stored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from opinio.operators.index import TextIndex
from opinio.operators.ratings import Selection, gold
from opinio.operators.silver import join_reviews, with_surrogate_id
from opinio.sources.landing import join_path, scan_csv, with_lineage
from opinio.sources.tables import overwrite_table, read_table, set_properties

# Names of the landing files.
PRODUCT_FILE = "product_info.csv"
REVIEW_FILES = "reviews*.csv"

AddId = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Layers:
    """Table names ``schema.prefix_layer_name``; ``location`` holds the files if given."""

    schema: str | None = None
    prefix: str = "opinio"
    location: str | None = None

    def table(self, layer: str, name: str) -> str:
        full = f"{self.prefix}_{layer}_{name}"
        return f"{self.schema}.{full}" if self.schema else full

    def path(self, table: str) -> str | None:
        return join_path(self.location, table.rsplit(".", 1)[-1]) if self.location else None

    @property
    def bronze_products(self) -> str:
        return self.table("bronze", "products")

    @property
    def bronze_reviews(self) -> str:
        return self.table("bronze", "reviews")

    @property
    def silver(self) -> str:
        return self.table("silver", "product_reviews")

    @property
    def gold(self) -> str:
        return self.table("gold", "product_reviews")


def bronze_products(spark: SparkSession, landing: str, **options) -> DataFrame:
    return with_lineage(scan_csv(spark, join_path(landing, PRODUCT_FILE), **options))


def bronze_reviews(spark: SparkSession, landing: str, **options) -> DataFrame:
    return with_lineage(scan_csv(spark, join_path(landing, REVIEW_FILES), **options))


def run_bronze(
    spark: SparkSession,
    landing: str,
    layers: Layers,
    fmt: str | None = None,
    product_options: dict | None = None,
    review_options: dict | None = None,
) -> None:
    """Each landing file with options of its own (see ``scan_csv``), such as its schema."""
    for rows, name in (
        (bronze_products(spark, landing, **(product_options or {})), layers.bronze_products),
        (bronze_reviews(spark, landing, **(review_options or {})), layers.bronze_reviews),
    ):
        overwrite_table(rows, name, fmt, layers.path(name))


def run_silver(
    spark: SparkSession,
    layers: Layers,
    fmt: str | None = None,
    add_id: AddId = with_surrogate_id,
) -> None:
    joined = join_reviews(
        read_table(spark, layers.bronze_products), read_table(spark, layers.bronze_reviews)
    )
    overwrite_table(
        add_id(joined), layers.silver, fmt, layers.path(layers.silver), cluster_by=["product_id"]
    )


def run_gold(
    spark: SparkSession,
    layers: Layers,
    fmt: str | None = None,
    rule: Selection = Selection(),
    properties: dict[str, str] | None = None,
) -> None:
    rows = gold(read_table(spark, layers.silver), rule)
    overwrite_table(rows, layers.gold, fmt, layers.path(layers.gold))
    if properties:
        set_properties(spark, layers.gold, properties)


def run_index(spark: SparkSession, layers: Layers, index: TextIndex) -> int:
    """Bring the text index to the stored gold table."""
    return index.sync(read_table(spark, layers.gold))


def run_all(
    spark: SparkSession,
    landing: str,
    layers: Layers,
    index: TextIndex | None = None,
    fmt: str | None = None,
    add_id: AddId = with_surrogate_id,
    rule: Selection = Selection(),
    properties: dict[str, str] | None = None,
    product_options: dict | None = None,
    review_options: dict | None = None,
) -> None:
    run_bronze(spark, landing, layers, fmt, product_options, review_options)
    run_silver(spark, layers, fmt, add_id)
    run_gold(spark, layers, fmt, rule, properties)
    if index is not None:
        run_index(spark, layers, index)
