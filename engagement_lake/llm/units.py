"""Cutting texts into pieces that a tokenizer treats independently, and tokenising each piece once.

A tokenizer that never joins across a single space between two visible characters gives the same
ids for a text as for its pieces ``word``, `` word``, `` word`` put together. A batch of texts has
far fewer distinct pieces than pieces, so the tokenizer sees each distinct piece once.
"""

from __future__ import annotations

import ctypes
import json
import re
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
# For work that makes several 64-bit values of every byte.
HASHED_BYTES = 1 << 20
# Bytes whose pairs are looked up at a time, so that the lookup takes little memory.
PAIRED_BYTES = 1 << 18
REMEMBERED = 400_000

_VISIBLE_ASCII = np.zeros(256, bool)
_VISIBLE_ASCII[0x21:0x7F] = True
# First byte of the two-byte characters U+00C0 to U+00FF: letters, none of them white or combining.
_LATIN = 0xC3


def give_back() -> None:
    """Return freed memory to the system: a reused Python worker would keep its peak."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of Linux has it
    if trim is not None:
        trim(0)


def freed(work: Callable) -> Callable:
    """The same work on Arrow batches, returning freed memory after each batch and at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch
                give_back()

        yield from work(handed())
        give_back()

    return run


def text_bytes(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after another, and the n + 1 offsets. A null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about so many bytes of text; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(sizes) // most
    starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]]) if len(sizes) else []
    for begin, end in zip(starts, [*starts[1:], len(sizes)]):
        yield batch.slice(begin, end - begin)


def letters_from_marks() -> np.ndarray:
    """Byte pairs that word-splitting tokenizers always part: an ASCII letter, then an ASCII mark."""
    letter = np.zeros(256, bool)
    letter[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
    digit = np.zeros(256, bool)
    digit[0x30:0x3A] = True
    return np.outer(letter, _VISIBLE_ASCII & ~letter & ~digit)


def piece_starts(data: np.ndarray, offsets: np.ndarray, parted: np.ndarray) -> np.ndarray:
    """Where the pieces begin: at each non-empty text, at single spaces between visible characters,
    and within the byte pairs that are always ``parted``."""
    begins = offsets[:-1][np.diff(offsets) > 0]
    if len(data) < 3:
        return begins
    visible = (data > 0x20) & (data < 0x7F)
    before = visible[:-2].copy()
    before[1:] |= (data[:-3] == _LATIN) & (data[1:-2] >= 0x80)
    after = visible[2:] | (data[2:] == _LATIN)
    flags = np.zeros(len(data), bool)
    flags[1:-1] = (data[1:-1] == 0x20) & before & after
    for begin in range(0, len(data) - 1, PAIRED_BYTES):
        part = data[begin : begin + PAIRED_BYTES + 1]
        flags[begin + 1 : begin + len(part)] |= parted[part[:-1], part[1:]]
    flags[begins] = True
    return np.flatnonzero(flags)


def pieces_of(data: np.ndarray, starts: np.ndarray) -> pa.DictionaryArray:
    """Every piece, as an index into the distinct ones."""
    ends = np.r_[starts, len(data)].astype(np.int32)
    values = pa.Array.from_buffers(
        pa.string(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))]
    )
    return values.dictionary_encode()


class PieceCache:
    """Remembers what ``encode`` gave for a piece: a run of values, or only their number.

    ``encode`` returns the number of values of each piece, and the values one after another.

    Held per Python worker; beyond ``REMEMBERED`` pieces it forgets those that it has not met again, or all
    if these are few, so that its memory is bounded.
    """

    def __init__(self, encode: Callable, parted: np.ndarray, counts_only: bool = False):
        self.encode, self.parted, self.counts_only = encode, parted, counts_only
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.lengths = self.begins = np.zeros(0, np.int32)
        self.values = np.zeros(0, np.uint32)
        self.met = np.zeros(0, np.uint8)

    def _forget_rare(self) -> None:
        """Keep only pieces that were met again since this was last done."""
        keep = self.met > 1
        self.index = {p: i for i, p in enumerate(compress(self.index, keep.tolist()))}
        if not self.counts_only:
            self.values = self.values[np.repeat(keep, self.lengths)]
        self.lengths = self.lengths[keep]
        self.begins = np.cumsum(self.lengths, dtype=np.int32) - self.lengths
        self.met = np.ones(len(self.index), np.uint8)

    def _places(self, distinct: list[str]) -> np.ndarray:
        if len(self.index) + len(distinct) > max(REMEMBERED, len(distinct)):
            self._forget_rare()
            if len(self.index) + len(distinct) > REMEMBERED:
                self.forget()
        new = [p for p in distinct if p not in self.index]
        if new:
            lengths, values = self.encode(new)
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
            begins = len(self.values) + np.cumsum(lengths) - lengths
            self.begins = np.r_[self.begins, begins.astype(np.int32)]
            self.lengths = np.r_[self.lengths, lengths.astype(np.int32)]
            self.values = np.r_[self.values, values]
            self.met = np.r_[self.met, np.zeros(len(new), np.uint8)]
        places = np.fromiter(map(self.index.__getitem__, distinct), np.int64, len(distinct))
        self.met[places] = np.minimum(self.met[places], 1) + 1
        return places

    def per_text(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of values of each text, and all values one after another (none if counting)."""
        starts = piece_starts(data, offsets, self.parted)
        if not len(starts):
            return np.zeros(len(offsets) - 1, np.int64), np.zeros(0, np.uint32)
        coded = pieces_of(data, starts)
        places = self._places(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        lengths = self.lengths[places]
        before = np.zeros(len(lengths) + 1, np.int32)
        np.cumsum(lengths, out=before[1:])
        counts = np.diff(before[np.searchsorted(starts, offsets)]).astype(np.int64)
        if self.counts_only:
            return counts, np.zeros(0, np.uint32)
        at = np.repeat(self.begins[places] - before[:-1], lengths)
        at += np.arange(before[-1], dtype=np.int32)
        return counts, self.values[at]


def stretches(values: np.ndarray, counts: np.ndarray) -> list[memoryview]:
    """Little-endian unsigned 32-bit bytes of each run of values."""
    whole = memoryview(np.ascontiguousarray(values, dtype="<u4")).cast("B")
    ends = np.cumsum(counts) * 4
    return [whole[e - 4 * n : e] for e, n in zip(ends.tolist(), counts.tolist())]


# The rules of a tokenizer that makes a run of letters a word, drops white space, and ends a word with an id
# that stands nowhere else, and pieces that are such a run: letters of ASCII and Latin-1.
_END = "</w>"
_LETTERS = re.compile(r" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_WORDS_END = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}


def _put_together(lengths: list, values: list) -> tuple[np.ndarray, np.ndarray]:
    if not lengths:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    return np.concatenate(lengths).astype(np.int64), np.concatenate(values)


class LibraryTokenizer:
    """Ids of the ``tokenizers`` library, without added special tokens, piece by piece.

    Pieces go to the library joined by a special token, which it sets apart before anything else,
    so that each is tokenised as if alone; a piece that holds that token's text goes by itself.
    That makes twice as many parts, so a tokenizer whose ids tell where a word ends gets pieces of one
    word joined by spaces.
    """

    PIECES_PER_CALL = 2000

    def __init__(self, definition: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        specials = self.tokenizer.get_added_tokens_decoder()
        self.mark, self.mark_text = next((i, t.content) for i, t in specials.items() if t.special)
        self.word_ends: np.ndarray | None = None
        rules = json.loads(definition)
        if rules["model"].get("end_of_word_suffix") == _END and all(rules[k] == v for k, v in _WORDS_END.items()):
            vocabulary = self.tokenizer.get_vocab()
            self.word_ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.word_ends[[i for token, i in vocabulary.items() if token.endswith(_END)]] = True
        parted = letters_from_marks()
        for token in specials.values():
            inside = list(token.content.encode())
            parted[inside[:-1], inside[1:]] = False
        self.pieces = PieceCache(self._encode, parted)

    def _ids(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _encode_marked(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lengths, values = [], []
        for i in range(0, len(pieces), self.PIECES_PER_CALL):
            part = pieces[i : i + self.PIECES_PER_CALL]
            joined = self.mark_text.join(part)
            if joined.count(self.mark_text) >= len(part):
                alone = [self._ids(p) for p in part]
                lengths.append([len(ids) for ids in alone])
                values.extend(alone)
                continue
            ids = self._ids(joined + self.mark_text)
            marks = np.flatnonzero(ids == self.mark)
            lengths.append(np.diff(marks, prepend=-1) - 1)
            values.append(ids[ids != self.mark])
        return _put_together(lengths, values)

    def _encode_words(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces that are one word each."""
        lengths, values = [], []
        for i in range(0, len(pieces), self.PIECES_PER_CALL):
            part = pieces[i : i + self.PIECES_PER_CALL]
            ids = self._ids(" ".join(part))
            ends = np.flatnonzero(self.word_ends[ids])
            if len(ends) != len(part) or ends[-1] != len(ids) - 1:
                n, ids = self._encode_marked(part)
            else:
                n = np.diff(ends, prepend=-1)
            lengths.append(n)
            values.append(ids)
        return _put_together(lengths, values)

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.word_ends is None:
            return self._encode_marked(pieces)
        word = np.fromiter((_LETTERS.fullmatch(p) is not None for p in pieces), bool, len(pieces))
        encoded = [
            (word, *self._encode_words(list(compress(pieces, word)))),
            (~word, *self._encode_marked(list(compress(pieces, ~word)))),
        ]
        lengths = np.zeros(len(pieces), np.int64)
        for which, n, _ in encoded:
            lengths[which] = n
        values = np.zeros(lengths.sum(), np.uint32)
        for which, _, ids in encoded:
            values[np.repeat(which, lengths)] = ids
        return lengths, values

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each text, and all ids one after another. A null text is empty."""
        return self.pieces.per_text(*text_bytes(texts))


_LOADED: dict[int, LibraryTokenizer] = {}


def library_tokenizer(definition: str) -> LibraryTokenizer:
    """One tokenizer per Python worker and definition."""
    key = hash(definition)
    if key not in _LOADED:
        _LOADED[key] = LibraryTokenizer(definition)
    return _LOADED[key]
