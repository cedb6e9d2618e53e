"""One document of each group of near duplicates, by the SimHash operator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import stored
from opinio.llm.simhash import near_duplicates
from opinio.llm.urls import blocks_for, bloom_filter, maybe_listed

# Words of a shingle, and bits in which linked fingerprints differ at most.
WORDS, RADIUS = 3, 2


def one_of_each(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS
) -> DataFrame:
    """The rows of ``docs`` with one row of each component of linked fingerprints.

    The row with the smallest id stays, of equal ids one of them, NULL ids only where there is
    no other. Texts without a word (NULL, empty, white space) have one fingerprint and so are one
    group. Columns pass through as they are, whatever their names.
    """
    columns = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(columns))))
    # written once, so that a row keeps its number
    rows = stored(plain.withColumn("uid", F.monotonically_increasing_id()), "numbered")
    number = F.col(f"c{columns.index(doc)}")
    order = F.struct(number.isNull().alias("none"), number.alias("doc"), "uid")
    asked = rows.select(order.alias("key"), F.col(f"c{columns.index(text)}").alias("text"))
    # the smallest key of a component is the row that stays
    groups = near_duplicates(asked, words, radius, "key", "text")
    others = groups.where(F.col("key") != F.col("component_id")).select("key.uid")
    dropped = stored(others, "dropped")
    maybe, staying = split_by_list(rows, dropped)
    kept = staying.unionByName(maybe.join(dropped, "uid", "left_anti"))
    return kept.select(*(F.col(f"c{i}").alias(name) for i, name in enumerate(columns)))


def split_by_list(rows: DataFrame, listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``uid`` may be in a list, and rows whose ``uid`` is not.

    The list travels as a blocked Bloom filter of at most 4 MiB, so that wide rows which are
    not listed need not move. A list too long for it only lets more rows through.
    """
    keys = listed.select(F.col("uid").alias("key"))
    n_blocks = blocks_for(keys.count())
    bits = bloom_filter(keys, n_blocks).scalar()
    maybe = maybe_listed(F.col("uid"), bits, n_blocks)
    return rows.where(maybe), rows.where(~maybe)
