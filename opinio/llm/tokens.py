"""Token ids of whole texts, a word at a time.

The tokenizer drops white space and merges within words only, so a text's ids are
those of its words in order. Each worker keeps the ids of the words it has met:
a text costs one lookup per word, and the tokenizer sees each new word once.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, normalizers, pre_tokenizers

END_ID = 2
# Words kept by a worker, some 20 MB; beyond, the more frequent half stays. Results do not
# depend on it.
WORDS_KEPT = 400_000
# Bytes of text whose ids are made at once.
BYTES_AT_ONCE = 4 << 20
PIECES_A_LINE = 200

# Fixed pattern: how the tokenizer cuts a lower-case word. It is used on words of printable
# ASCII and of Latin letters that no normal form changes (the dotted capital I is left out).
LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017e"
PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LATIN}]+|[0-9]|[^\sa-z0-9{LATIN}]+")
PLAIN = re.compile(rf"[\x21-\x7e{LATIN}]+")
LETTERS = f"^[A-Za-z{LATIN}]+$"


# A-Z in lower case, ASCII white space as blanks.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
FOLD[9:14] = 32


def unfoldable(text: bytes) -> bool:
    """True if lower case could change ids: a combining mark may join a letter, or the text
    may name a special token."""
    return b"\xcc" in text or b"\xcd" in text or b"<|" in text


def codes_of(texts: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts together, and where each begins and the last ends."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset :][: len(texts) + 1]
    codes = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return codes, offsets - offsets[0]


# ASCII signs other than the apostrophe, which may begin a contraction.
SIGN = np.zeros(256, bool)
SIGN[[c for c in range(33, 127) if not chr(c).isalnum() and c != 39]] = True
SMALL = np.zeros(256, bool)
SMALL[97:123] = True
# Two-byte letters: U+00C0 to U+017F but for the signs U+00D7 and U+00F7, and U+0130, whose
# lower case ends in a combining dot that the tokenizer joins to a sign.
LEAD = np.zeros(256, bool)
LEAD[[0xC3, 0xC4, 0xC5]] = True


def folded(texts: pa.BinaryArray) -> pa.BinaryArray:
    """Texts in lower case, with signs that follow a letter set apart, which changes no id.

    A sign after a letter begins a piece in any case; set apart, the word before is met
    again wherever it stands.
    """
    codes, offsets = codes_of(texts)
    codes = FOLD[codes]
    signs = np.flatnonzero(SIGN[codes])
    signs = signs[signs > 1]
    last, before = codes[signs - 1], codes[signs - 2]
    letter = SMALL[last] | (
        LEAD[before]
        & (last >= 128)
        & ~((before == 0xC3) & ((last == 0x97) | (last == 0xB7)))
        & ~((before == 0xC4) & (last == 0xB0))
    )
    signs = signs[letter]
    apart = np.insert(codes, signs, 32)
    offsets = (offsets + np.searchsorted(signs, offsets)).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(apart)]
    )


class WordIds:
    """Ids of words: a bounded table of the words met, looked up once for each distinct word.

    Words, ids and their places are kept in arrays; a run's new words are learned together.
    """

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        # A plain piece is in its normal form and lower case already: many pieces in
        # one line, cut at blanks, give the same ids much faster.
        self.by_line = Tokenizer.from_file(path)
        self.by_line.normalizer = normalizers.Sequence([])
        self.by_line.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self.whole.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.closes[number] = token.endswith("</w>")
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.binary())
        self.ids = np.empty(0, np.uint32)
        self.lengths = np.empty(0, np.int32)
        self.met = np.empty(0, np.int32)  # runs in which a word was met

    def texts(self, texts: pa.BinaryArray, kind: str = "<u4") -> list[bytes]:
        """Ids of each text, none of which is NULL, and the end id."""
        ids, edges = self.encoded(texts, kind)
        raw = memoryview(ids.tobytes())
        edges = (edges * ids.dtype.itemsize).tolist()
        return [bytes(raw[a:b]) for a, b in zip(edges, edges[1:])]

    def encoded(self, texts: pa.BinaryArray, kind: str = "<u4") -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's with the end id, and where each text's begin and the last's end."""
        odd = np.zeros(len(texts), bool)
        if unfoldable(codes_of(texts)[0].tobytes()):
            odd[:] = [unfoldable(text.as_py()) for text in texts]
        parts, sizes = [np.empty(0, kind)], [np.zeros(1, np.int64)]
        cuts = [0, *(np.flatnonzero(odd[1:] != odd[:-1]) + 1).tolist(), len(texts)]
        for a, b in zip(cuts, cuts[1:]):
            some = texts.slice(a, b - a)
            if b > a and odd[a]:
                words = pa.array([text.as_py().split() for text in some], pa.list_(pa.binary()))
            else:
                words = pc.split_pattern(folded(some), b" ")
            ids, lengths = self._split(words, kind)
            parts.append(ids)
            sizes.append(lengths)
        return np.concatenate(parts), np.cumsum(np.concatenate(sizes))

    def _split(self, words: pa.ListArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts given as lists of words, and how many each text has."""
        coded = words.flatten().dictionary_encode()
        places = self._places(coded.dictionary)
        # a text's end is one more word, at the end of the table
        starts = np.append(np.cumsum(self.lengths) - self.lengths, len(self.ids))
        lengths = np.append(self.lengths, np.int32(1))
        table = np.append(self.ids, np.uint32(END_ID)).astype(kind)
        stops = words.offsets.to_numpy() - words.offsets[0].as_py()
        at = np.insert(places[coded.indices.to_numpy()], stops[1:], len(self.lengths))
        each = lengths[at]
        ends = np.cumsum(each, dtype=np.int64)
        shift = np.repeat((starts[at] - (ends - each)).astype(np.int32), each)
        shift += np.arange(len(shift), dtype=np.int32)
        edges = ends[stops[1:] + np.arange(len(words))]
        return table[shift], np.diff(edges, prepend=0)

    def _places(self, distinct: pa.BinaryArray) -> np.ndarray:
        """Where each of some distinct words is in the table; new ones are learned."""
        if len(self.known) > WORDS_KEPT:
            self._keep_frequent()
        found = pc.index_in(distinct, value_set=self.known)
        places = found.fill_null(-1).to_numpy().copy()
        new = np.flatnonzero(places < 0)
        self.met[places[places >= 0]] += 1
        if len(new):
            words = distinct.take(pa.array(new))
            ids, lengths = self._learned(words)
            places[new] = len(self.lengths) + np.arange(len(new))
            self.known = pa.concat_arrays([self.known, words])
            self.ids = np.concatenate([self.ids, ids])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.met = np.concatenate([self.met, np.ones(len(new), np.int32)])
        return places

    def _keep_frequent(self) -> None:
        """Halves the table: the words met in most runs stay."""
        stay = np.sort(np.argsort(-self.met, kind="stable")[: WORDS_KEPT // 2])
        starts = np.cumsum(self.lengths) - self.lengths
        self.ids, self.lengths = gathered(self.ids, starts[stay], self.lengths[stay]), self.lengths[stay]
        self.known, self.met = self.known.take(pa.array(stay)), self.met[stay] // 2

    def _learned(self, words: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one after the other, and how many each has."""
        spelled = words.cast(pa.string())
        letters = pc.match_substring_regex(spelled, LETTERS).to_numpy(zero_copy_only=False)
        single, others = np.flatnonzero(letters), np.flatnonzero(~letters)
        lower = pc.utf8_lower(spelled.take(pa.array(single))).dictionary_encode()
        pieces = lower.dictionary.to_pylist()
        numbers = {}
        cut, left = [], []  # other words by their pieces, and those for the whole tokenizer
        for i, word in zip(others.tolist(), spelled.take(pa.array(others)).to_pylist()):
            # the names of special tokens hold "<|" and are left to the whole tokenizer
            if PLAIN.fullmatch(word) and "<|" not in word:
                found = PIECES.findall(word.lower())
                for piece in found:
                    if piece not in numbers:
                        numbers[piece] = len(pieces)
                        pieces.append(piece)
                cut.append((i, [numbers[piece] for piece in found]))
            else:
                left.append((i, word))
        ids, sizes = self._of_pieces(pieces)
        begins = np.cumsum(sizes) - sizes
        # each word as some slices of a table of ids
        tables, slices = [ids], [(single, begins[lower.indices.to_numpy()], sizes[lower.indices.to_numpy()])]
        if cut:
            of = np.repeat([i for i, _ in cut], [len(found) for _, found in cut])
            number = np.array([n for _, found in cut for n in found])
            slices.append((of, begins[number], sizes[number]))
        at = len(ids)
        for start in range(0, len(left), 1000):
            some = left[start : start + 1000]
            made = [
                np.array(e.ids, np.uint32)
                for e in self.whole.encode_batch_fast([w for _, w in some], add_special_tokens=False)
            ]
            counts = np.array([len(m) for m in made], np.int64)
            slices.append((np.array([i for i, _ in some]), at + np.cumsum(counts) - counts, counts))
            tables += made
            at += int(counts.sum())
        owner = np.concatenate([s[0] for s in slices]).astype(np.int64)
        order = np.argsort(owner, kind="stable")
        first = np.concatenate([s[1] for s in slices])[order]
        counts = np.concatenate([s[2] for s in slices])[order]
        lengths = np.bincount(owner[order], counts, minlength=len(words)).astype(np.int32)
        return gathered(np.concatenate(tables), first, counts), lengths

    def _of_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, one after the other, and how many each has."""
        lines = [" ".join(pieces[i : i + PIECES_A_LINE]) for i in range(0, len(pieces), PIECES_A_LINE)]
        found = [np.empty(0, np.uint32)]
        for start in range(0, len(lines), 20):
            encoded = self.by_line.encode_batch_fast(lines[start : start + 20], add_special_tokens=False)
            found += [np.array(line.ids, np.uint32) for line in encoded]
        ids = np.concatenate(found)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(pieces) or (len(ids) and ends[-1] != len(ids)):
            raise ValueError("the vocabulary does not close every word with </w>")
        return ids, np.diff(ends, prepend=0)


def gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices of ``values`` one after the other."""
    ends = np.cumsum(lengths, dtype=np.int64)
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


@cache
def word_ids(path: str) -> WordIds:
    """One encoder per worker process, in one thread: a task has one core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordIds(path)


def runs(texts: pa.BinaryArray, most: int = BYTES_AT_ONCE) -> Iterator[pa.BinaryArray]:
    """Slices of about ``most`` bytes; a longer text is a slice of its own."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield texts.slice(start, stop - start)
        start = stop
