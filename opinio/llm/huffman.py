"""Canonical, length-limited Huffman codes in numpy: lengths, bit packing, table decoding."""

from __future__ import annotations

import numpy as np

# Longest code; also the width of the decoding table (2**18 entries, 1.3 MB).
MAX_BITS = 18
# Ids between two checkpoints; a block is BLOCK ids and begins on a byte.
STRIDE = 1024
BLOCK = 64 * STRIDE


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Best code lengths of at most ``max_bits`` by package-merge; 0 for ids that do not occur."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) == 1:
        lengths[used] = 1
    if len(used) < 2:
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} ids need codes longer than {max_bits} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    n = len(order)
    # in every round pairs of the last round's list are merged with the single ids again;
    # kept for each round: how many of its first elements are single ids
    merged = weights
    singles = [np.arange(n + 1)]
    for _ in range(max_bits - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, pairs])
        rank = np.argsort(both, kind="stable")
        merged = both[rank]
        singles.append(np.concatenate([[0], np.cumsum(rank < n)]))
    # walk back: the first 2n - 2 elements of the last list are chosen
    chosen = 2 * n - 2
    for first in reversed(singles):
        ids = int(first[chosen])
        lengths[order[:ids]] += 1
        chosen = 2 * (chosen - ids)
    return lengths


def codes(lengths: np.ndarray) -> np.ndarray:
    """Canonical codes: by length, then id."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    result = np.zeros(len(lengths), np.uint32)
    sizes = lengths[order].astype(np.int64)
    # each code is the last one plus 1, shifted to its own length: as 2**-length sums
    top = int(sizes.max(initial=0))
    before = np.concatenate([[0], np.cumsum(1 << (top - sizes))[:-1]]) if len(order) else sizes
    result[order] = (before >> (top - sizes)).astype(np.uint32)
    return result


class Encoder:
    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.codes = codes(lengths).astype(np.uint64)

    def blocks(self, ids: np.ndarray, counts: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of several blocks of ids, each on a byte border, and where each begins."""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        begins = np.concatenate([[0], np.cumsum((np.diff(edges) + 7) // 8)])
        total = int(begins[-1])
        words = np.zeros(total // 8 + 2, np.uint64)
        if len(ids):
            starts = ends - sizes + np.repeat(8 * begins[:-1] - edges[:-1], counts)
            word = starts >> 6
            shift = 64 - (starts & 63) - sizes
            code = self.codes[ids]
            high = np.where(
                shift >= 0,
                code << np.maximum(shift, 0).astype(np.uint64),
                code >> np.maximum(-shift, 0).astype(np.uint64),
            )
            first = np.flatnonzero(np.diff(word, prepend=-1))
            words[word[first]] = np.bitwise_or.reduceat(high, first)
            # at most one code crosses into each next word
            over = np.flatnonzero(shift < 0)
            words[word[over] + 1] |= code[over] << (64 + shift[over]).astype(np.uint64)
        return words.astype(">u8").tobytes()[:total], begins

    def block(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of at most BLOCK ids, and the bit offset of every STRIDE-th."""
        payload, _ = self.blocks(ids, np.array([len(ids)]))
        sizes = self.lengths[ids]
        return payload, (np.cumsum(sizes) - sizes)[::STRIDE].astype("<u4")


class Decoder:
    def __init__(self, lengths: np.ndarray, max_bits: int = MAX_BITS):
        self.max_bits = max_bits
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        spans = 1 << (max_bits - lengths[order].astype(np.int64))
        self.ids = np.zeros(1 << max_bits, np.uint32)
        self.sizes = np.zeros(1 << max_bits, np.int64)
        filled = int(spans.sum())
        self.ids[:filled] = np.repeat(order, spans)
        self.sizes[:filled] = np.repeat(lengths[order], spans)

    def lanes(self, payload: bytes, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids of many runs, in order: run i has ``counts[i]`` ids from bit ``starts[i]`` on.

        All runs advance together, one id each at a time.
        """
        total = int(counts.sum())
        if not total:
            return np.empty(0, np.uint32)
        raw = np.frombuffer(payload + b"\0\0\0\0", np.uint8).astype(np.uint32)
        window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        window = np.append(window, np.uint32(0))
        # longest first, so the runs still active are a prefix
        order = np.argsort(-counts, kind="stable")
        at, left = starts[order].astype(np.int64), counts[order]
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])[order]
        out = np.empty(total, np.uint32)
        down = np.uint32(32 - self.max_bits)
        active = len(at)
        for step in range(int(left[0])):
            while left[active - 1] <= step:
                active -= 1
            here = at[:active]
            seen = window[here >> 3] << (here & 7).astype(np.uint32)
            key = seen >> down
            out[first[:active] + step] = self.ids[key]
            here += self.sizes[key]
        return out
