"""Vector codes: each part of a vector becomes the number of its nearest codebook entry.

Codebooks are trained by rounds over all rows in exact integers. A part keeps two bounds
from its last scan: the distance of its entry and that of the nearest other one, each with
the round it was taken in. The codebooks of all rounds are kept, so a bound is carried to the
present by the true net displacement of an entry since that round. This is the norm of the sum
of its moves, never more than the sum of their norms: entries that move to and fro cost nothing.
Only parts whose bounds cross are scanned again.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import stored
from opinio.session import new_path, remove

# Bounds are float64 roots of whole numbers: they are widened by this share.
SLACK = 1e-9
# Entries' sums are whole numbers of any size, moved in limbs of so many.
LIMB = 10**18
ROWS_AT_ONCE = 4096


@dataclass
class Books:
    """Codebooks of all rounds: ``rounds[r][p]`` is the (entries x width) array of part p."""

    rounds: list[list[np.ndarray]] = field(default_factory=list)

    def moved(self, part: int, since: int) -> np.ndarray:
        """How far each entry of a part is from where it was in round ``since`` (rounded up)."""
        return roots(self.rounds[-1][part] - self.rounds[since][part]) * (1 + SLACK)


def floats(numbers: np.ndarray) -> np.ndarray:
    """Whole numbers as float64, infinite where they are larger than that can hold."""
    if numbers.dtype != object:
        return numbers.astype(np.float64)
    made = [float(x) if x.bit_length() < 1000 else math.inf for x in numbers.ravel().tolist()]
    return np.array(made, np.float64).reshape(numbers.shape)


def roots(difference: np.ndarray) -> np.ndarray:
    """Lengths of whole-number rows."""
    return np.sqrt(floats((difference * difference).sum(axis=-1)))


def squared(values: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, rows x entries."""
    if values.dtype == object:
        return ((values[:, None, :] - entries[None]) ** 2).sum(axis=2)
    # |v - e|^2 without a third axis; whole numbers, so nothing is lost
    return (values * values).sum(axis=1)[:, None] - 2 * (values @ entries.T) + (entries * entries).sum(axis=1)


def scanned(values: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry (ties to the lower index), its distance, and that of the nearest other."""
    distance = squared(values, entries)
    label = distance.argmin(axis=1)
    rows = np.arange(len(values))
    near = floats(distance[rows, label])
    if len(entries) == 1:
        return label, np.sqrt(near) * (1 + SLACK), np.full(len(values), np.inf)
    other = floats(distance)
    other[rows, label] = np.inf
    return label, np.sqrt(near) * (1 + SLACK), np.sqrt(other.min(axis=1)) * (1 - SLACK)


@dataclass
class State:
    """Of some rows and one part: entry, the two bounds, and the round of each."""

    label: np.ndarray
    upper: np.ndarray
    lower: np.ndarray
    upper_at: np.ndarray
    lower_at: np.ndarray


def assigned(values: np.ndarray, books: Books, part: int, state: State | None) -> tuple[State, int]:
    """The state for the latest codebook, and how many rows were scanned against all entries."""
    now = len(books.rounds) - 1
    entries = books.rounds[now][part]
    n = len(values)
    if state is None:
        label, upper, lower = scanned(values, entries)
        at = np.full(n, now, np.uint8)
        return State(label, upper, lower, at, at.copy()), n
    upper, lower = state.upper.copy(), state.lower.copy()
    for since in range(now):
        moved = books.moved(part, since)
        some = np.flatnonzero(state.upper_at == since)
        upper[some] += moved[state.label[some]]
        some = np.flatnonzero(state.lower_at == since)
        if len(moved) > 1:  # the farthest any entry but the row's own has gone
            order = np.argsort(moved)
            first, second = order[-1], order[-2]
            lower[some] -= np.where(state.label[some] == first, moved[second], moved[first])
    made = State(state.label.copy(), state.upper.copy(), state.lower.copy(), state.upper_at.copy(), state.lower_at.copy())
    # a tie may be won by a lower index: the bounds have to be apart (and be numbers)
    doubtful = np.flatnonzero(~(upper * (1 + SLACK) < lower))
    if len(doubtful):  # first the true distance of the own entry
        own = roots(values[doubtful] - entries[state.label[doubtful]]) * (1 + SLACK)
        made.upper[doubtful], made.upper_at[doubtful] = own, now
        doubtful = doubtful[~(own * (1 + SLACK) < lower[doubtful])]
    if len(doubtful):
        label, near, other = scanned(values[doubtful], entries)
        made.label[doubtful], made.upper[doubtful], made.lower[doubtful] = label, near, other
        made.upper_at[doubtful] = made.lower_at[doubtful] = now
    return made, len(doubtful)


def whole_numbers(values: np.ndarray, scale: int, big: bool) -> np.ndarray:
    """``floor(scale * x)``; with ``big`` as Python integers, exact at any size."""
    if not big:
        return np.floor(values * scale).astype(np.int64)
    made = [
        int(x) * scale if abs(x) > 2.0**53 else math.floor(x * scale) for x in values.ravel().tolist()
    ]
    out = np.empty(len(made), object)
    out[:] = made
    return out.reshape(values.shape)


def spans(width: int, parts: int) -> list[tuple[int, int]]:
    """First and end component of each part; where they cannot be equal, the first are longer."""
    edges = np.cumsum([0, *(width // parts + (i < width % parts) for i in range(parts))])
    return list(zip(edges[:-1].tolist(), edges[1:].tolist()))


def vectors_of(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, width)


@dataclass(frozen=True)
class Plan:
    """What tasks need besides the codebooks."""

    width: int
    parts: int
    scale: int
    big: bool

    @property
    def spans(self) -> list[tuple[int, int]]:
        return spans(self.width, self.parts)


def limbs(value: int) -> list[int]:
    """A whole number as limbs, the lowest first, all of its sign."""
    sign, rest, found = (-1 if value < 0 else 1), abs(value), []
    while rest or not found:
        rest, low = divmod(rest, LIMB)
        found.append(sign * low)
    return found


TOTALS = "array<struct<slot:int,limb:int,total:bigint>>"
STATE = "code binary, bounds binary, stamps binary"


def totals_of(sums: list[np.ndarray], counts: np.ndarray) -> list[dict]:
    """A task's sums as rows: a slot for every part, entry and component, and one for each count."""
    found = []
    flat = [int(x) for s in sums for x in s.ravel().tolist()] + counts.ravel().tolist()
    for slot, value in enumerate(flat):
        if value:
            found += [{"slot": slot, "limb": i, "total": x} for i, x in enumerate(limbs(value)) if x]
    return found


def round_of(rows: DataFrame, plan: Plan, books: Books, last: bool) -> DataFrame:
    """Assigns every part of every row of ``(id, label, vector[, state])`` to the latest codebook.

    A task adds one row whose ``totals`` are its sums, or, in the last pass, each row has its ``error``.
    """
    carried = rows.columns[:3]
    known = "code" in rows.columns
    parts, entries = plan.parts, len(books.rounds[0][0])
    kept = carried[:2] if last else carried
    added = "code binary, error bigint" if last else f"{STATE}, totals {TOTALS}"
    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = object if plan.big else np.int64
        sums = [np.zeros((entries, b - a), dtype) for a, b in plan.spans]
        counts = np.zeros((parts, entries), np.int64)
        kinds = {}
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                kinds = {c: batch.schema.field(c).type for c in carried}
                values = whole_numbers(vectors_of(batch.column(2), plan.width), plan.scale, plan.big)
                n = len(values)
                made = []
                if known:
                    code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(n, parts)
                    bounds = np.frombuffer(b"".join(batch.column("bounds").to_pylist())).reshape(n, 2, parts)
                    stamps = np.frombuffer(b"".join(batch.column("stamps").to_pylist()), np.uint8).reshape(n, 2, parts)
                for p, (a, b) in enumerate(plan.spans):
                    state = (
                        State(code[:, p].astype(np.int64), bounds[:, 0, p], bounds[:, 1, p], stamps[:, 0, p], stamps[:, 1, p])
                        if known
                        else None
                    )
                    made.append(assigned(values[:, a:b], books, p, state)[0])
                labels = np.stack([s.label for s in made], axis=1)
                packed = labels.astype(np.uint8)
                columns = [batch.column(c) for c in kept]
                columns.append(pa.array([row.tobytes() for row in packed], pa.binary()))
                if last:
                    error = sum(
                        ((values[:, a:b] - books.rounds[-1][p][labels[:, p]]) ** 2).sum(axis=1)
                        for p, (a, b) in enumerate(plan.spans)
                    )
                    columns.append(pa.array(error.tolist(), pa.int64()))
                    yield pa.RecordBatch.from_arrays(columns, names=[*kept, "code", "error"])
                    continue
                for p, (a, b) in enumerate(plan.spans):
                    np.add.at(sums[p], labels[:, p], values[:, a:b])
                    counts[p] += np.bincount(labels[:, p], minlength=entries)
                bounds = np.stack(
                    [np.stack([s.upper for s in made], 1), np.stack([s.lower for s in made], 1)], 1
                )
                stamps = np.stack(
                    [np.stack([s.upper_at for s in made], 1), np.stack([s.lower_at for s in made], 1)], 1
                )
                columns += [
                    pa.array([row.tobytes() for row in bounds], pa.binary()),
                    pa.array([row.tobytes() for row in stamps], pa.binary()),
                    pa.nulls(n, pa_totals),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "code", "bounds", "stamps", "totals"])
        if not last and counts.any():
            nothing = [pa.nulls(1, kinds[c]) for c in kept] + [pa.nulls(1, pa.binary())] * 3
            yield pa.RecordBatch.from_arrays(
                [*nothing, pa.array([totals_of(sums, counts)], pa_totals)],
                names=[*kept, "code", "bounds", "stamps", "totals"],
            )

    pa_totals = pa.list_(
        pa.struct([("slot", pa.int32()), ("limb", pa.int32()), ("total", pa.int64())])
    )
    return rows.mapInArrow(assign, f"{fields}, {added}")


def next_books(state: DataFrame, plan: Plan, books: Books) -> list[np.ndarray]:
    """The entries replaced by the floored means of their parts; unused ones stay.

    What is fetched is one sum for each component of the codebooks.
    """
    entries = len(books.rounds[0][0])
    rows = (
        state.where(F.col("totals").isNotNull())
        .select(F.explode("totals").alias("t"))
        .groupBy("t.slot", "t.limb")
        .agg(F.sum(F.col("t.total").cast("decimal(38,0)")).alias("total"))
        .collect()
    )
    sums: dict[int, int] = {}
    for slot, limb, total in rows:
        sums[slot] = sums.get(slot, 0) + int(total) * LIMB**limb
    n_sums = entries * plan.width
    made, slot = [], 0
    for p, (a, b) in enumerate(plan.spans):
        book = books.rounds[-1][p].copy()
        for entry in range(entries):
            count = sums.get(n_sums + p * entries + entry, 0)
            for i in range(b - a):
                if count:
                    book[entry, i] = sums.get(slot, 0) // count
                slot += 1
        made.append(book)
    return made


def encode(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
) -> DataFrame:
    """``(key, code, error, label_error, codebooks_sha256)`` of every vector that takes part.

    Vectors that are NULL or hold NULL or non-finite components are left out, and so are those of
    another length than the first one's; empty ones have nothing to code. The codebooks start as the parts of the
    vectors of smallest key (NULL keys last, equal keys by their vectors), fewer if there are
    fewer vectors. Repeated rows each have a row. Rows with equal labels, NULLs among
    them, share ``label_error``. An error that a bigint cannot hold is an error. Other columns are ignored.
    """
    if not 0 < entries <= 256 or not 0 <= rounds < 256:
        raise ValueError("1 to 256 entries, at most 255 rounds")
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    plain = vectors.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & finite).select(
        F.col(key).alias("_key"), F.col(label).alias("_label"), x.alias("_vector")
    )
    by_key = (F.asc_nulls_last("_key"), F.asc("_vector"))
    first = plain.orderBy(*by_key).limit(1).collect()
    width = len(first[0]["_vector"]) if first else parts
    plain = plain.where(F.size("_vector") == width)
    largest = plain.agg(F.max(F.array_max(F.transform("_vector", F.abs)))).first()[0] or 0.0
    # exact in 64 bits if any squared distance of whole vectors is
    reach = largest * scale + 1
    plan = Plan(width, parts, scale, 4 * width * reach * reach >= 2.0**62)
    seeds = [r["_vector"] for r in plain.orderBy(*by_key).limit(entries).collect()]
    start = whole_numbers(np.array(seeds, np.float64).reshape(-1, width), scale, plan.big)
    books = Books([[start[:, a:b] for a, b in plan.spans]])
    state, spark, before = plain, vectors.sparkSession, None
    if seeds:
        for _ in range(rounds):
            path = new_path(spark, "codes")
            made = round_of(state, plan, books, last=False)
            made.write.option("compression", "zstd").parquet(path)
            state = spark.read.schema(made.schema).parquet(path)
            books.rounds.append(next_books(state, plan, books))
            state = state.where(F.col("totals").isNull()).drop("totals")
            if before:  # nothing reads the round before any more
                remove(spark, before)
            before = path
    coded = stored(round_of(state, plan, books, last=True), "coded") if seeds else (
        plain.drop("_vector").withColumns({"code": F.lit(b""), "error": F.lit(0).cast("bigint")})
    )
    # one row a label meets the rows again, so a label of very many rows can be split by the join
    by_label = coded.groupBy(F.col("_label").alias("_same")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, F.col("_label").eqNullSafe(F.col("_same"))).select(
        F.col("_key").alias(key),
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(digest(books.rounds[-1])).alias("codebooks_sha256"),
    )


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components in decimal, by part, entry and place."""
    numbers = (str(int(x)) for book in books for x in book.ravel().tolist())
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()
