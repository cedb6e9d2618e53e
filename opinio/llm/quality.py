"""Quality of a text by a small byte-level convolutional network in numpy.

Bytes have learned vectors. A text is cut into overlapping chunks; a filter's response to
a chunk is its largest over the chunk. Junk of few different words leaves most filters
without a strong match, and noise sets off filters of its own, so one linear layer turns
the responses and the chunk's length into the chunk's evidence. The mean over all chunks
gives the probability. Nothing of a text is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The network: size of a byte's vector, bytes and step of a filter, filters.
DEPTH, WIDTH, STEP, FILTERS = 8, 8, 4, 32
# Windows are pooled in units; a chunk is UNITS units and shares one with the next.
UNIT, UNITS = 32, 4
# Bytes whose windows are held at once: a whole number of units.
AT_ONCE = 256 * UNIT * STEP
# Bounded training sample: labelled rows of each label. Their texts are used whole.
SAMPLE_ROWS = 1600
# Chunks whose windows are held at once in training.
CHUNKS_AT_ONCE = 1024
EPOCHS, BATCH, RATE = 18, 32, 0.004
THRESHOLD = 0.3


@dataclass(frozen=True)
class Network:
    vectors: np.ndarray  # 256 x DEPTH; byte 0 pads
    filters: np.ndarray  # WIDTH * DEPTH x FILTERS
    bias: np.ndarray
    weights: np.ndarray  # of the filters, and of a chunk's length
    offset: float


def windows(codes: np.ndarray, stop: int | None = None) -> np.ndarray:
    """The WIDTH bytes from every STEP-th byte before ``stop`` on; the end is padded."""
    n = max(1, -(-(len(codes) if stop is None else min(stop, len(codes))) // STEP))
    short = max(0, (n - 1) * STEP + WIDTH - len(codes))
    return np.lib.stride_tricks.sliding_window_view(np.pad(codes, (0, short)), WIDTH)[::STEP][:n]


def chunk_spans(n: int) -> list[tuple[int, int]]:
    """(first, end) of the chunks over ``n`` windows: every window is in one, neighbours overlap."""
    size, hop = UNIT * UNITS, UNIT * (UNITS - 1)
    return [(at, min(at + size, n)) for at in range(0, max(1, n - UNIT), hop)]


def responses(net: Network, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The largest response of each filter in each chunk, and the windows of each chunk."""
    codes = np.frombuffer(text, np.uint8)
    tops, n = [], 0
    for start in range(0, max(len(codes), 1), AT_ONCE):
        # the last windows of a part reach into the next
        seen = windows(codes[start : start + AT_ONCE + WIDTH], AT_ONCE)
        made = net.vectors[seen].reshape(len(seen), -1) @ net.filters
        tops.append(np.maximum.reduceat(made, np.arange(0, len(made), UNIT)))
        n += len(seen)
    units = np.concatenate(tops)
    spans = chunk_spans(n)
    top = np.stack([units[a // UNIT : -(-b // UNIT)].max(axis=0) for a, b in spans])
    return np.maximum(top + net.bias, 0), np.array([b - a for a, b in spans])


def score(net: Network, text: bytes) -> float:
    top, sizes = responses(net, text)
    evidence = top @ net.weights[:-1] + np.log2(sizes) * net.weights[-1]
    value = float(evidence.mean()) + net.offset
    return float(1 / (1 + np.exp(-np.clip(value, -30, 30))))


def train(texts: list[bytes], labels: list[int]) -> Network:
    """Fits the network by Adam on the log loss; both labels weigh the same. Deterministic."""
    rng = np.random.default_rng(0)
    p = {
        "vectors": rng.normal(0, 0.5, (256, DEPTH)).astype(np.float32),
        "filters": rng.normal(0, 0.15, (WIDTH * DEPTH, FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "weights": rng.normal(0, 0.1, FILTERS + 1).astype(np.float32),
        "offset": np.zeros(1, np.float32),
    }
    truth = np.array(labels, np.float32)
    if len(set(labels)) < 2:  # nothing to tell apart: the share of label 1
        share = np.clip((truth.sum() + 1) / (len(truth) + 2), 0.01, 0.99)
        none = np.zeros(FILTERS + 1, np.float32)
        return Network(p["vectors"], p["filters"], none[1:], none, float(np.log(share / (1 - share))))
    rows = [windows(np.frombuffer(t, np.uint8)) for t in texts]
    spans = [chunk_spans(len(r)) for r in rows]
    weight = np.where(truth == 1, 0.5 / truth.mean(), 0.5 / (1 - truth.mean())).astype(np.float32)
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            chunks = [(k, i, a, b) for k, i in enumerate(batch) for a, b in spans[i]]
            owner = np.array([k for k, *_ in chunks])
            share = 1 / np.bincount(owner)[owner]
            groups = [slice(g, g + CHUNKS_AT_ONCE) for g in range(0, len(chunks), CHUNKS_AT_ONCE)]
            # forward, some chunks at a time: of each only the winning windows are kept
            bytes_at = np.empty((len(chunks), FILTERS, WIDTH), np.uint8)
            pooled = np.empty((len(chunks), FILTERS), np.float32)
            for group in groups:
                seen = np.concatenate([rows[i][a:b] for _, i, a, b in chunks[group]])
                made = p["vectors"][seen].reshape(len(seen), -1) @ p["filters"]
                ends = np.cumsum([b - a for _, _, a, b in chunks[group]])
                edges = zip([0, *ends.tolist()], ends.tolist())
                top = np.stack([a + made[a:b].argmax(axis=0) for a, b in edges])
                pooled[group] = np.take_along_axis(made, top, 0) + p["bias"]
                bytes_at[group] = seen[top]
            size = np.log2([[b - a] for _, _, a, b in chunks])
            active = np.concatenate([np.maximum(pooled, 0), size], axis=1).astype(np.float32)
            value = np.bincount(owner, (active @ p["weights"]) * share) + p["offset"]
            error = (1 / (1 + np.exp(-value)) - truth[batch]) * weight[batch] / len(batch)
            to_chunk = (error[owner] * share).astype(np.float32)
            back = to_chunk[:, None] * p["weights"][:-1] * (pooled > 0)
            to_vectors = np.zeros_like(p["vectors"])
            to_filters = np.zeros_like(p["filters"])
            for group in groups:
                inputs = p["vectors"][bytes_at[group]].reshape(-1, FILTERS, WIDTH * DEPTH)
                to_filters += np.einsum("tf,tfi->if", back[group], inputs)
                spread = (back[group][:, :, None] * p["filters"].T[None]).reshape(-1, DEPTH)
                np.add.at(to_vectors, bytes_at[group].reshape(-1), spread)
            gradient = {
                "vectors": to_vectors,
                "filters": to_filters,
                "bias": back.sum(axis=0),
                "weights": active.T @ to_chunk,
                "offset": error.sum(keepdims=True),
            }
            step += 1
            for k, g in gradient.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                mean = first[k] / (1 - 0.9**step)
                spread_of = second[k] / (1 - 0.999**step)
                p[k] = (p[k] - RATE * mean / (np.sqrt(spread_of) + 1e-8)).astype(np.float32)
    return Network(p["vectors"], p["filters"], p["bias"], p["weights"], float(p["offset"][0]))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> Network:
    """A network from the texts of ``docs`` that ``labels`` marks 1 or 0.

    Of each label at most SAMPLE_ROWS ids are used, those with the lowest hashes; only their
    texts are fetched, whole. A NULL text counts as empty, NULL labels and
    ids are left out, and so are ids with labels that disagree.
    """
    known = (
        labels.where(F.col(doc).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col(doc).alias("_doc"))
        .agg(F.min(label).alias("_label"), F.max(label).alias("_other"))
        .where(F.col("_label") == F.col("_other"))
        .select("_doc", "_label")
    )
    chosen = None
    for value in (0, 1):
        some = known.where(F.col("_label") == value).orderBy(F.xxhash64("_doc"), "_doc")
        some = some.limit(SAMPLE_ROWS)
        chosen = some if chosen is None else chosen.unionByName(some)
    # at most 2 * SAMPLE_ROWS ids; several documents of one id give one text
    texts = (
        docs.select(
            F.col(doc).alias("_doc"),
            F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"),
        )
        .join(F.broadcast(chosen), "_doc")
        .groupBy("_doc", "_label")
        .agg(F.min("_text").alias("_text"))
        .collect()
    )
    texts.sort(key=lambda r: str(r._doc))
    return train([bytes(r._text) for r in texts], [int(r._label) for r in texts])


def scores(docs: DataFrame, net: Network, text: str = "text", out: str = "score") -> DataFrame:
    """Adds ``out``, the probability of label 1, to every row.

    A NULL text counts as empty. Rows repeat as they are; a column already named ``out``
    is replaced.
    """
    kept = docs.select(*(c for c in docs.columns if c != out))
    names = [f.name for f in kept.schema.fields]
    schema = kept.withColumn(out, F.lit(0.0)).schema
    place = names.index(text)

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                score(net, value.as_buffer().to_pybytes() if value.is_valid else b"")
                for value in batch.column(place)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.float64())], names=[*names, out]
            )

    return kept.mapInArrow(per_batch, schema)


def keep_good(
    docs: DataFrame, net: Network, text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows whose score reaches the threshold, with the columns of ``docs``, whatever their names."""
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    judged = scores(plain, net, f"c{docs.columns.index(text)}", "score")
    return judged.where(F.col("score") >= threshold).select(
        *(F.col(f"c{i}").alias(name) for i, name in enumerate(docs.columns))
    )
