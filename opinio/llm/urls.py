"""URL filter: host and path rules, and a list of URLs behind a blocked Bloom filter.

The filter is one small array that travels with the tasks. URLs it rules out are
decided where they are; only possible hits meet the list in a hash join, which
removes the filter's false positives.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import ascii_lower

WORDS = 4  # 64-bit words of a block
BITS_PER_URL = 16
# The filter is at most WORDS * 8 * MOST_BLOCKS bytes (4 MiB). A longer list only
# raises the share of false positives that go to the join.
FEWEST_BLOCKS, MOST_BLOCKS = 64, 1 << 17


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(ascii_lower(found), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.`` or ``m.`` and path without closing slashes; query, fragment
    and scheme do not count. Empty for what is no URL."""
    host = F.regexp_replace(host_of(url), r"^(?:www|m)\.", "")
    return F.concat(host, F.regexp_replace(path_of(url), "/++$", ""))


def matched_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule whose host is the host or a parent of it and whose path begins the path.

    NULL if none fits. Of equally long rules the alphabetically first wins.
    """
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name), reverse=True):
        fits = ((host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))) & F.startswith(
            path, F.lit(rule.path)
        )
        chosen = F.when(fits, rule.name).otherwise(chosen)
    return chosen


def _masks(key: Column) -> list[Column]:
    """The two bits of each word that a URL sets, from twelve 6-bit slices of a hash."""
    h = F.xxhash64(key, F.lit("bits"))
    one = F.lit(1).cast("bigint")

    def bit(slot: int) -> Column:
        place = F.shiftrightunsigned(h, 6 * slot).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", one, place)

    return [bit(j).bitwiseOR(bit(WORDS + j)) for j in range(WORDS)]


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks)).cast("int")


def bloom_filter(keys: DataFrame, n_blocks: int) -> DataFrame:
    """One row, ``bits``: the words of all blocks in order, from rows of ``key``."""
    merged = (
        keys.select(
            _block(F.col("key"), n_blocks).alias("block"),
            *(m.alias(f"w{j}") for j, m in enumerate(_masks(F.col("key")))),
        )
        .groupBy("block")
        .agg(*(F.bit_or(f"w{j}").alias(f"w{j}") for j in range(WORDS)))
    )
    # every block is placed in order, at most MOST_BLOCKS of them
    every = keys.sparkSession.range(n_blocks).select(F.col("id").cast("int").alias("block"))
    none = F.lit(0).cast("bigint")
    placed = every.join(merged, "block", "left").select(
        F.struct(
            "block",
            F.array(*(F.coalesce(F.col(f"w{j}"), none) for j in range(WORDS))).alias("words"),
        ).alias("b")
    )
    in_order = F.array_sort(F.collect_list("b"))
    return placed.agg(F.flatten(F.transform(in_order, lambda b: b["words"])).alias("bits"))


def maybe_listed(key: Column, bits: Column, n_blocks: int) -> Column:
    """False only if the key is not in the list."""
    first = _block(key, n_blocks) * WORDS
    passed = F.lit(True)
    for j, mask in enumerate(_masks(key)):
        passed = passed & (F.get(bits, first + j).bitwiseAND(mask) == mask)
    return passed


def blocks_for(n_keys: int) -> int:
    wanted = -(-n_keys * BITS_PER_URL // (64 * WORDS))
    return 1 << (min(max(wanted, FEWEST_BLOCKS), MOST_BLOCKS) - 1).bit_length()


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    listed: DataFrame,
    url: str = "url",
) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``verdict`` to the rows of ``pages``.

    ``listed`` has one column ``url`` of URLs to block; they are compared in
    canonical form, so repeats and NULLs in it do no harm. A rule decides before the list.
    NULL and text without ``://`` have empty host and path, fit no rule with a
    host and are allowed. Rows repeat as they are; columns of ``pages`` with one
    of the four names are replaced.
    """
    made = ("host", "path", "rule", "verdict")
    kept = [c for c in pages.columns if c not in made]
    keys = listed.select(canonical(F.col("url")).alias("key")).where(F.col("key") != "").distinct()
    n_blocks = blocks_for(keys.count())
    bits = bloom_filter(keys, n_blocks).scalar()

    # own names inside, so that a column of ``pages`` may be named as it likes
    known = pages.select(
        *(F.col(c).alias(f"c{i}") for i, c in enumerate(kept)),
        F.col(url).alias("address"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
    ).withColumn("rule", matched_rule(F.col("host"), F.col("path"), rules))
    blocked = [r.name for r in rules if r.verdict == "block"]
    by_rule = F.when(F.col("rule").isin(blocked), "block").otherwise("allow")
    key = canonical(F.col("address"))
    asked = F.col("rule").isNull() & (key != "") & maybe_listed(key, bits, n_blocks)

    decided = known.where(~F.coalesce(asked, F.lit(False))).withColumn("verdict", by_rule)
    sure = keys.select("key", F.lit(True).alias("listed")).hint("shuffle_hash")
    hits = (
        known.where(asked)
        .withColumn("key", key)
        .join(sure, "key", "left")
        .withColumn("verdict", F.when(F.col("listed"), "block").otherwise("allow"))
        .drop("key", "listed")
    )
    return decided.unionByName(hits).select(
        *(F.col(f"c{i}").alias(c) for i, c in enumerate(kept)), *made
    )
