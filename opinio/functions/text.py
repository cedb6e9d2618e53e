"""Text to terms, term counts and hashed vectors, as column expressions.

Everything here stays inside one row and inside the JVM: a text is split, sorted
and run-length counted in place, so counting the terms of a corpus needs no
shuffle and no text, however often it is repeated, makes a hot group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token boundary and width of the hashed vector.
TOKEN_BREAK = r"[^\p{L}\p{N}]+"
DIMENSIONS = 256


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    A lambda that names an outer expression evaluates it again for every element;
    a lambda variable does not, and no optimizer rule inlines it.
    """
    return F.transform(F.array(value), body)[0]


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits, in text order."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), TOKEN_BREAK)
    return F.array_remove(parts, "")


def value_counts(values: Column) -> Column:
    """``array<struct<value, n>>``: distinct non-NULL values of an array, ascending."""

    def count_sorted(items: Column) -> Column:
        # index of the last element of each run; past the end is NULL, no value is
        run_ends = F.filter(
            F.sequence(F.lit(0), F.size(items) - 1, F.lit(1)),
            lambda i: ~F.get(items, i).eqNullSafe(F.get(items, i + 1)),
        )
        return bind(
            run_ends,
            lambda ends: F.transform(
                ends,
                lambda end, pos: F.struct(
                    F.get(items, end).alias("value"),
                    (end - F.coalesce(F.get(ends, pos - 1), F.lit(-1))).alias("n"),
                ),
            ),
        )

    def guarded(items: Column) -> Column:
        return F.when(F.size(items) > 0, count_sorted(items))

    return bind(F.sort_array(values), guarded)


def term_counts(text: Column) -> Column:
    """``array<struct<term string, tf int>>``, empty for a text without tokens."""
    counted = F.transform(
        value_counts(tokens(text)),
        lambda run: F.struct(run["value"].alias("term"), run["n"].alias("tf")),
    )
    return F.coalesce(counted, F.array().cast("array<struct<term:string,tf:int>>"))


def distinct_terms(text: Column) -> Column:
    return F.array_sort(F.array_distinct(tokens(text)))


def bucket_of(term: Column, dimensions: int = DIMENSIONS) -> Column:
    """The hash bucket of a term: first 32 bits of its md5, modulo the width."""
    prefix = F.substring(F.md5(term), 1, 8)
    return F.conv(prefix, 16, 10).cast("bigint") % dimensions


def _hashes(counted: Column, dimensions: int) -> Column:
    """The bucket of every token, hashing each distinct term once."""
    return F.flatten(
        F.transform(
            counted, lambda x: F.array_repeat(bucket_of(x["term"], dimensions), x["tf"])
        )
    )


def hashed_sparse(counted: Column, dimensions: int = DIMENSIONS) -> Column:
    """Hashed bag of words: ``array<struct<bucket, n, weight>>``, weights of unit length."""

    def weighted(runs: Column) -> Column:
        square = F.aggregate(
            runs, F.lit(0).cast("bigint"), lambda total, run: total + run["n"] * run["n"]
        )
        return bind(
            F.sqrt(square.cast("double")),
            lambda norm: F.transform(
                runs,
                lambda run: F.struct(
                    run["value"].alias("bucket"),
                    run["n"].alias("n"),
                    (run["n"] / norm).alias("weight"),
                ),
            ),
        )

    return bind(value_counts(_hashes(counted, dimensions)), weighted)


def hashed_vector(counted: Column, dimensions: int = DIMENSIONS) -> Column:
    """Dense unit vector of the hashed bag of words, zero for an empty text.

    Every bucket is added once before counting and taken off afterwards, so the
    run lengths come out as the full vector in bucket order.
    """
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(dimensions - 1).cast("bigint"))
    counts = F.transform(
        value_counts(F.concat(_hashes(counted, dimensions), every)),
        lambda run: (run["n"] - 1).cast("double"),
    )

    def unit(vector: Column) -> Column:
        norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x))
        # counts are whole: the norm of any text with tokens is at least 1
        return bind(
            F.greatest(norm, F.lit(1.0)),
            lambda divisor: F.transform(vector, lambda x: (x / divisor).cast("float")),
        )

    return bind(counts, unit)
