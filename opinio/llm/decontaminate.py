"""Benchmark passages in documents: q-gram counting in diagonal bands, then banded alignment.

Both sides are folded (A-Z in lower case, other ASCII signs and white space as one
blank) and handled as UTF-8 bytes, the characters of this module. An item is cut into
overlapping windows, and a short one is also a window as a whole. A document region within ``k`` edits of a window of ``m`` characters
shares at least ``m - q + 1 - k * q`` of its q-grams, on diagonals that differ by at most
``k``; bands of 2 (k + 1) diagonals, one beginning every k + 1, hold each such set whole.
Bands with enough shared q-grams are aligned; nothing else can be within the budget.
An item shorter than a q-gram is found where it stands as it is, between blanks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import stored
from opinio.session import new_path

Q = 8
WINDOW, HOP = 64, 8
# Items up to this many characters are one more window as a whole, with a budget to match.
WHOLE = 160
# Edits allowed in a window, as a share of its characters.
RATE = 0.1
# Bytes of benchmark text that travel with a pass over the documents; more make more passes.
BLOCK_BYTES = 1 << 20
BITS = 22
# Possible regions that are aligned together.
TOGETHER = 4096

FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32
    for c in range(256)
)
FIRST, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def fold(text: bytes) -> bytes:
    return b" ".join(text.translate(FOLD).split())


def places(text: bytes) -> np.ndarray:
    """For each folded character the code point of ``text`` it comes from."""
    codes = np.frombuffer(text.translate(FOLD), np.uint8)
    blank = codes == 32
    kept = ~blank
    inner = np.flatnonzero(kept)
    if len(inner):
        # of every run of blanks between words the first stays
        kept[1:] |= blank[1:] & ~blank[:-1]
        kept[: inner[0]] = False
        kept[inner[-1] + 1 :] = False
    raw = np.frombuffer(text, np.uint8)
    points = np.cumsum((raw & 0xC0) != 0x80) - 1
    return points[np.flatnonzero(kept)]


def raw_text(value: pa.Scalar) -> bytes:
    return value.as_buffer().to_pybytes() if value.is_valid else b""


def budget(m: int) -> int:
    """Edits allowed in a window of ``m`` characters, so many that the lemma still bites."""
    return max(0, min(int(m * RATE), (m - Q) // Q))


def grams(text: bytes) -> np.ndarray:
    """A 64-bit hash of the q-gram at every place. A collision can only add work."""
    n = len(text) - Q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    eight = np.lib.stride_tricks.as_strided(
        np.frombuffer(text, np.uint8), (len(text) - 7, 8), (1, 1)
    )
    words = np.ascontiguousarray(eight).view("<u8").ravel()
    return words[:n] * FIRST ^ words[Q - 8 : Q - 8 + n] * SECOND


@dataclass(frozen=True)
class Windows:
    """Some benchmark items, their windows and the index of their q-grams; and the short items."""

    sources: tuple[tuple[int, bytes], ...]
    short: tuple[tuple[int, bytes], ...] = ()

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """Of the short items between blanks, one sign a byte."""
        made = ahocorasick.Automaton()
        by_text: dict[bytes, list[int]] = {}
        for item, text in self.short:
            by_text.setdefault(text, []).append(item)
        for text, items in by_text.items():
            made.add_word(f" {text.decode('latin-1')} ", (len(text), tuple(items)))
        made.make_automaton()
        return made

    @cached_property
    def spans(self) -> np.ndarray:
        """Source, start and size of every window."""
        found = []
        for number, (_, text) in enumerate(self.sources):
            last = max(0, len(text) - WINDOW)
            size = min(WINDOW, len(text))
            found += [(number, start, size) for start in sorted({*range(0, last, HOP), last})]
            if WINDOW < len(text) <= WHOLE:
                found.append((number, 0, len(text)))
        return np.array(found, np.int64).reshape(-1, 3)

    @cached_property
    def items(self) -> tuple[int, ...]:  # by window
        return tuple(self.sources[n][0] for n in self.spans[:, 0].tolist())

    @cached_property
    def texts(self) -> tuple[bytes, ...]:
        return tuple(self.sources[n][1][a : a + size] for n, a, size in self.spans.tolist())

    @cached_property
    def index(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes, bounds of their postings, sources, places and numbers, and a bit table."""
        found = [grams(text) for _, text in self.sources]
        hashes = np.concatenate(found) if found else np.empty(0, np.uint64)
        of = np.repeat(np.arange(len(found)), [len(g) for g in found])
        at = np.concatenate([np.arange(len(g)) for g in found]) if found else of
        order = np.argsort(hashes, kind="stable")
        distinct, first = np.unique(hashes[order], return_index=True)
        bounds = np.append(first, len(hashes))
        table = np.zeros(1 << BITS, bool)
        table[distinct >> np.uint64(64 - BITS)] = True
        return distinct, bounds, of[order], at[order], order, table

    @cached_property
    def holders(self) -> tuple[np.ndarray, np.ndarray]:
        """The windows that hold each q-gram of the sources, one after the other, and bounds."""
        begins = np.cumsum([0, *(len(text) - Q + 1 for _, text in self.sources)])
        n = self.sizes - Q + 1
        gram = np.repeat(begins[self.spans[:, 0]] + self.spans[:, 1] - (np.cumsum(n) - n), n)
        gram += np.arange(len(gram))
        window = np.repeat(np.arange(len(n), dtype=np.int32), n)
        bounds = np.concatenate([[0], np.cumsum(np.bincount(gram, minlength=begins[-1]))])
        return window[np.argsort(gram, kind="stable")], bounds

    @cached_property
    def sizes(self) -> np.ndarray:
        return self.spans[:, 2]

    @cached_property
    def budgets(self) -> np.ndarray:
        return np.array([budget(m) for m in self.sizes.tolist()], np.int64)

    @cached_property
    def needed(self) -> np.ndarray:
        return np.maximum(1, self.sizes - Q + 1 - self.budgets * Q)

    @cached_property
    def least(self) -> np.ndarray:
        """By source the fewest q-grams that one of its windows needs."""
        least = np.full(len(self.sources), np.iinfo(np.int64).max)
        np.minimum.at(least, self.spans[:, 0], self.needed)
        return least

    @cached_property
    def long(self) -> np.ndarray:
        return np.array([len(text) > WHOLE for _, text in self.sources], bool)


def cut_windows(items: list[tuple[int, bytes]]) -> Windows:
    """Windows of folded items; those shorter than a q-gram are kept apart, empty ones left out."""
    return Windows(
        tuple((item, text) for item, text in items if len(text) >= Q),
        tuple((item, text) for item, text in items if 0 < len(text) < Q),
    )


def short_items(windows: Windows, text: bytes) -> Iterator[tuple[int, int, int]]:
    """(item, start, end) of every short item that stands in a folded text."""
    for last, (size, items) in windows.automaton.iter(f" {text.decode('latin-1')} "):
        # one blank has been put before the text, and the match ends with one
        for item in items:
            yield item, last - 1 - size, last - 1


def crowded(windows: Windows, source: np.ndarray, place: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
    """Which shared q-grams can be among those that a window needs.

    Bands so wide that each band of a window is whole in one, cut along the item into parts
    so long that each window is whole in one, are counted in a hash table. A collision can
    only keep more.
    """
    wide = 2 * (int(windows.budgets.max()) + 1)
    band = diagonal // wide
    part = np.where(windows.long[source], place // WINDOW, 0)
    bits = min(22, max(10, len(source).bit_length() + 3))

    def cell(band: np.ndarray, part: np.ndarray) -> np.ndarray:
        mixed = ((source << 40) + (part << 32) + band).astype(np.uint64) * FIRST
        return (mixed >> np.uint64(64 - bits)).astype(np.int64)

    cells = [cell(band - i, part - j) for i in (0, 1) for j in (0, 1)]
    counts = np.bincount(np.concatenate(cells), minlength=1 << bits)
    return np.max([counts[c] for c in cells], axis=0) >= windows.least[source]


def aligned(window: bytes, text: bytes, most: int) -> tuple[int, int] | None:
    """(edits, end) of the best alignment of a window in a short text, within ``most``.

    A column of the distance table at a time as two bit vectors (Myers). Of equally good
    ends the first.
    """
    size = len(window)
    found = text.find(window)
    if found >= 0:
        return 0, found + size
    at: dict[int, int] = {}
    for i, char in enumerate(window):
        at[char] = at.get(char, 0) | 1 << i
    every, last = (1 << size) - 1, 1 << (size - 1)
    up, down, edits = every, 0, size
    best, end = most + 1, 0
    # more edits than can be undone in what is left of the text end the search
    slack = len(text) + most
    for place, char in enumerate(text):
        same = at.get(char, 0)
        across = (((same & up) + up) ^ up) | same
        more = down | ~(across | up)
        less = up & across
        if more & last:
            edits += 1
            if edits > slack - place:
                break
        elif less & last:
            edits -= 1
            if edits < best:
                best, end = edits, place + 1
        more <<= 1
        same |= down
        up = (less << 1 | ~(same | more)) & every
        down = more & same & every
    return (best, end) if best <= most else None


def fewest_edits(pieces: list[bytes], texts: list[bytes]) -> np.ndarray:
    """Edits between each piece of at most 64 characters and the nearest part of its text.

    The bit vectors of ``aligned`` for many pairs at once.
    """
    n = len(pieces)
    sizes = np.array([len(p) for p in pieces])
    lengths = np.array([len(t) for t in texts])
    signs = np.frombuffer(b"".join(p.ljust(64, b"\0") for p in pieces), np.uint8).reshape(n, 64)
    long = int(lengths.max())
    columns = np.frombuffer(b"".join(t.ljust(long, b"\0") for t in texts), np.uint8)
    columns = np.ascontiguousarray(columns.reshape(n, long).T)
    rows = np.arange(n)
    at = np.zeros((n, 256), np.uint64)
    one = np.uint64(1)
    for i in range(int(sizes.max())):
        at[rows, signs[:, i]] |= np.where(i < sizes, one << np.uint64(i), np.uint64(0))
    up, down = np.full(n, ~np.uint64(0)), np.zeros(n, np.uint64)
    shift = (sizes - 1).astype(np.uint64)
    edits, best = sizes.copy(), sizes.copy()
    for place in range(long):
        same = at[rows, columns[place]]
        across = (((same & up) + up) ^ up) | same
        more = down | ~(across | up)
        less = up & across
        edits += (more >> shift & one).astype(np.int64)
        edits -= (less >> shift & one).astype(np.int64)
        best = np.where(place < lengths, np.minimum(best, edits), best)
        more <<= one
        same |= down
        up = (less << one) | ~(same | more)
        down = more & same
    return best


def regions(windows: Windows, text: bytes) -> dict[int, tuple[int, int, int, int]]:
    """item -> (start, end, fewest edits, windows found) in a folded text."""
    return regions_of_all(windows, [text])[0]


def regions_of_all(
    windows: Windows, texts: Iterable[bytes]
) -> list[dict[int, tuple[int, int, int, int]]]:
    """``regions`` of each text; what may be a region is aligned for many texts together."""
    found: list[dict[int, tuple[int, int, int, int]]] = []
    waiting: list[tuple[int, int, int, bytes]] = []
    met: set[tuple[int, int]] = set()

    def settle() -> None:
        # disjoint pieces of a window need no more edits together than the window
        owners, pieces, parts = [], [], []
        for number, (_, w, _, part) in enumerate(waiting):
            window = windows.texts[w]
            step = -(-len(window) // -(-len(window) // 64))
            for start in range(0, len(window), step):
                owners.append(number)
                pieces.append(window[start : start + step])
                parts.append(part)
        least = np.bincount(owners, fewest_edits(pieces, parts), minlength=len(waiting))
        most = windows.budgets[[w for _, w, _, _ in waiting]]
        for number in np.flatnonzero(least <= most).tolist():
            text, w, begin, part = waiting[number]
            best = aligned(windows.texts[w], part, int(windows.budgets[w]))
            if best is None:
                continue
            edits, end = best[0], begin + best[1]
            start = max(0, end - len(windows.texts[w]))
            item = windows.items[w]
            a, b, fewest, n = found[text].get(item, (start, end, edits, 0))
            n += (text, w) not in met
            met.add((text, w))
            found[text][item] = (min(a, start), max(b, end), min(fewest, edits), n)
        waiting.clear()

    for number, text in enumerate(texts):
        found.append({})
        for item, start, end in short_items(windows, text) if windows.short else ():
            a, b, fewest, n = found[number].get(item, (start, end, 0, 0))
            found[number][item] = (min(a, start), max(b, end), 0, n + 1)
        for w, begin, end in candidates(windows, text):
            waiting.append((number, w, begin, text[begin:end]))
            if len(waiting) >= TOGETHER:
                settle()
    if waiting:
        settle()
    return found


def candidates(windows: Windows, text: bytes) -> list[tuple[int, int, int]]:
    """(window, start, end): the parts of a folded text that may hold a window."""
    hashes = grams(text)
    distinct, bounds, of, at, numbers, table = windows.index
    if not len(hashes) or not len(distinct):
        return []
    fewest_needed = windows.least.min()
    seen = np.flatnonzero(table[hashes >> np.uint64(64 - BITS)])
    if len(seen) < fewest_needed:
        return []
    slot = np.minimum(np.searchsorted(distinct, hashes[seen]), len(distinct) - 1)
    exact = distinct[slot] == hashes[seen]
    seen, slot = seen[exact], slot[exact]
    counts = bounds[slot + 1] - bounds[slot]
    total = int(counts.sum())
    if total < fewest_needed:
        return []
    posting = np.repeat(bounds[slot] - (np.cumsum(counts) - counts), counts) + np.arange(total)
    seen = np.repeat(seen, counts)
    kept = crowded(windows, of[posting], at[posting], seen - at[posting])
    posting, seen = posting[kept], seen[kept]
    if not len(posting):
        return []
    holding, edges = windows.holders
    number = numbers[posting]
    first, counts = edges[number], edges[number + 1] - edges[number]
    entry = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    window = holding[entry].astype(np.int64)
    place = np.repeat(at[posting], counts) - windows.spans[window, 1]
    diagonal = np.repeat(seen, counts) - place + WHOLE
    step = windows.budgets[window] + 1
    band = diagonal // step
    # a diagonal is in the band that begins at its step and in the one before
    keys = np.concatenate([window * (1 << 40) + band, window * (1 << 40) + band - 1])
    distinct_keys, shared = np.unique(keys, return_counts=True)
    which = distinct_keys + 1 >> 40
    enough = shared >= windows.needed[which]
    w, most = which[enough], windows.budgets[which[enough]]
    low = (distinct_keys[enough] - w * (1 << 40)) * (most + 1) - WHOLE
    begin = np.maximum(0, low - most)
    # the band's last diagonal, and most edits beyond it
    end = np.minimum(len(text), low + 2 * (most + 1) - 1 + most + windows.sizes[w])
    fits = end > begin
    return list(zip(w[fits].tolist(), begin[fits].tolist(), end[fits].tolist()))


def blocks(
    benchmark: DataFrame, item: str = "item_id", text: str = "text", most: int = BLOCK_BYTES
) -> Iterator[Windows]:
    """The benchmark's windows, fetched in blocks of at most about ``most`` bytes of text.

    NULL items and texts are left out; repeated rows count once.
    """
    rows = (
        benchmark.where(F.col(item).isNotNull() & F.col(text).isNotNull())
        .select(F.col(item).alias("item"), F.col(text).alias("text"))
        .distinct()
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // most))
    for block in range(n):
        part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == block).collect()
        windows = cut_windows(sorted((r.item, fold(r.text.encode())) for r in part))
        if windows.sources or windows.short:
            yield windows


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``(doc, item, start, end, edits, windows)``: one row per document row and item in it.

    ``start`` and ``end`` are code points of the text around all windows found, ``edits``
    the fewest in one of them, ``windows`` how many were found (of an item shorter than a
    q-gram: its places). A NULL text counts as
    empty and has none; repeated rows are searched each on its own; clean documents have
    no row. Columns other than those named are ignored.
    """
    source = docs.select(doc, text)
    schema = (
        f"`{doc}` {source.schema[doc].dataType.simpleString()}, "
        f"`{item}` {benchmark.schema[item].dataType.simpleString()}, "
        "start bigint, end bigint, edits int, windows int"
    )
    parts: DataFrame | None = None
    path = new_path(docs.sparkSession, "passages")
    for number, windows in enumerate(blocks(benchmark, item, item_text)):

        def search(
            batches: Iterator[pa.RecordBatch], windows: Windows = windows
        ) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, found = [], []
                column = batch.column(1)
                every = regions_of_all(windows, (fold(raw_text(value)) for value in column))
                for i, hits in enumerate(every):
                    if hits:
                        at = places(raw_text(column[i]))
                        for name, (start, end, edits, n) in sorted(hits.items()):
                            rows.append(i)
                            found.append((name, int(at[start]), int(at[end - 1]) + 1, edits, n))
                if rows:
                    names, starts, ends, edits, counts = map(list, zip(*found))
                    yield pa.record_batch(
                        [
                            batch.column(0).take(pa.array(rows)),
                            pa.array(names),
                            pa.array(starts, pa.int64()),
                            pa.array(ends, pa.int64()),
                            pa.array(edits, pa.int32()),
                            pa.array(counts, pa.int32()),
                        ],
                        names=[doc, item, "start", "end", "edits", "windows"],
                    )

        # one pass is left as it is; of several each is written before the next begins
        if number:
            parts.write.mode("append").parquet(path)
        parts = source.mapInArrow(search, schema)
    if parts is None:
        return docs.sparkSession.createDataFrame([], schema)
    if number:
        parts.write.mode("append").parquet(path)
        return docs.sparkSession.read.schema(parts.schema).parquet(path)
    return parts


def clean_documents(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` in which no benchmark passage is found, with all their columns."""
    place = docs.columns.index(text)
    for number, windows in enumerate(blocks(benchmark, item, item_text)):
        if number:  # a plan holds one pass; what the last has kept is written
            docs = stored(docs, "clean")

        def keep(
            batches: Iterator[pa.RecordBatch], windows: Windows = windows
        ) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                folded = (fold(raw_text(value)) for value in batch.column(place))
                clean = [not hits for hits in regions_of_all(windows, folded)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
