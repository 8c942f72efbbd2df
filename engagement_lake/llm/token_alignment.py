"""Alignment of two tokenizers' tokens over the same bytes, and how usual each link is in the corpus.

Both tokenizers encode every whole text. Bytes at which a token of each ends, where the next token
of each begins with a space, are anchors: they cut a document into windows of token ids. A window's
groups and links follow from its ids alone, so each tuple of ids is aligned once and remembered.

A second pass counts every pair of linked ids over the corpus; a third gives the counts back to the
documents. Pairs that make up at least 1 / ``HOT_PAIRS`` of all links, at most ``HOT_PAIRS`` of them,
are broadcast; the others are joined by pair, each with few links by definition.

Cases: texts that are null, empty, or that the tokens of either tokenizer do not spell byte by byte
have no tokens: zeros and an empty digest. Special strings inside texts are plain text. Repeated
rows, or ids, are counted and returned each. An empty table gives no rows. Other columns are left
out, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engagement_lake.llm.store import read, written
from engagement_lake.llm.units import (
    PieceCache,
    freed,
    letters_from_marks,
    slices,
    text_bytes,
)

HOT_PAIRS = 1 << 19
WINDOWS_REMEMBERED = 400_000
# Text of one step: its token ids and links take some hundred times as many bytes.
STEP_BYTES = 1 << 20
SPACE = "▁"  # how piece models write a space


class Vocabulary:
    """The bytes of every token, one after another."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.spaced = np.array([t.startswith(b" ") for t in tokens])

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes[ragged(self.begins[ids], self.lengths[ids])]


def ragged(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, ... of each run, one after another."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(begins - before, lengths) + np.arange(lengths.sum())


# Every id in decimal digits; vocabularies are far smaller.
_DIGITS = Vocabulary([b"%d" % i for i in range(1 << 18)])


def byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a letter: itself if it can be seen, else one of U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in seen]
    return {**{chr(b): b for b in seen}, **{chr(0x100 + i): b for i, b in enumerate(hidden)}}


class ByteLevelTokens:
    """Ids and bytes of a byte-level model of the ``tokenizers`` library; special strings are plain text."""

    def __init__(self, definition: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(definition)
        tokenizer.encode_special_tokens = True
        letters = byte_letters()
        names = {i: t for t, i in json.loads(definition)["model"]["vocab"].items()}
        tokens = [names.get(i, "") for i in range(max(names) + 1)]
        # A token that is not written in byte letters, such as a special one, never spells anything.
        self.vocabulary = Vocabulary([bytes(letters.get(c, 0) for c in t) for t in tokens])

        def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
            ids = [e.ids for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
            return _flat(ids)

        self.pieces = PieceCache(encode, letters_from_marks())


class PieceTokens:
    """Ids and bytes of a piece model of the ``sentencepiece`` library, which puts a space before a text."""

    def __init__(self, model: bytes):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model)

        def spelling(i: int) -> bytes:
            piece = processor.id_to_piece(i)
            return bytes([int(piece[1:-1], 16)]) if processor.is_byte(i) else piece.replace(SPACE, " ").encode()

        self.vocabulary = Vocabulary([spelling(i) for i in range(processor.get_piece_size())])

        def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
            # Cut at single spaces only, so each begins with the space that the library puts there.
            return _flat(processor.encode([p[1:] for p in pieces], num_threads=1))

        self.pieces = PieceCache(encode, np.zeros((256, 256), bool))


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    return lengths, np.fromiter(chain.from_iterable(ids), np.uint32, lengths.sum())


def align(
    a: Vocabulary, n_a: np.ndarray, a_ids: np.ndarray, b: Vocabulary, n_b: np.ndarray, b_ids: np.ndarray
) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Of each window: its groups as text, their number, the number of its links; and all links' pairs.

    All windows at once: they stand one after another, and each is the same bytes in both vocabularies.
    A group's text ends with a semicolon.
    """
    a_ends, b_ends = np.cumsum(a.lengths[a_ids]), np.cumsum(b.lengths[b_ids])
    first = np.searchsorted(b_ends, a_ends - a.lengths[a_ids], side="right")
    each = np.searchsorted(b_ends, a_ends) - first + 1
    pairs = np.repeat(a_ids, each) * len(b.lengths) + b_ids[ragged(first, each)]

    # A group ends where both have an end; its number stands for the bytes before.
    last_a, last_b = np.isin(a_ends, b_ends, assume_unique=True), np.isin(b_ends, a_ends, assume_unique=True)
    a_group, b_group = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    order = np.argsort(np.r_[2 * a_group, 2 * b_group + 1], kind="stable")
    ids = np.r_[a_ids, b_ids][order]
    marks = np.r_[np.where(last_a, ord("|"), ord(",")), np.where(last_b, ord(";"), ord(","))][order]
    sizes = _DIGITS.lengths[ids] + 1
    ends = np.cumsum(sizes)
    written = np.empty(sizes.sum(), np.uint8)
    written[ends - 1] = marks
    written[ragged(ends - sizes, sizes - 1)] = _DIGITS.spelled(ids)
    # A window's tokens stand together in this order, too.
    bounds = np.r_[0, ends][np.r_[0, np.cumsum(n_a + n_b)]].tolist()
    whole = written.tobytes().decode()
    texts = [whole[x:y] for x, y in zip(bounds, bounds[1:])]
    a_bounds = np.r_[0, np.cumsum(n_a)]
    return texts, _sums(last_a, a_bounds), _sums(each, a_bounds), pairs


class Windows:
    """Alignments of windows by their ids, each made once; forgotten beyond ``WINDOWS_REMEMBERED``."""

    def __init__(self, a: Vocabulary, b: Vocabulary):
        self.a, self.b = a, b
        self.forget()

    def forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.texts: list[str] = []
        self.groups = self.starts = self.lengths = np.zeros(0, np.int64)
        self.pairs = np.zeros(0, np.int64)

    def places(self, windows: pa.Array) -> np.ndarray:
        """Where each window's alignment is; a window is the number of first ids, these, then the others."""
        names = windows.to_pylist()
        if len(self.index) + len(names) > max(WINDOWS_REMEMBERED, len(names)):
            self.forget()
        new = [i for i, w in enumerate(names) if w not in self.index]
        if new:
            n_a, a_ids, n_b, b_ids = _ids_of(windows.take(pa.array(new)))
            texts, groups, lengths, pairs = align(self.a, n_a, a_ids, self.b, n_b, b_ids)
            self.index.update((names[i], n) for n, i in enumerate(new, len(self.index)))
            self.texts.extend(texts)
            self.starts = np.r_[self.starts, len(self.pairs) + np.cumsum(lengths) - lengths]
            self.lengths = np.r_[self.lengths, lengths]
            self.groups = np.r_[self.groups, groups]
            self.pairs = np.r_[self.pairs, pairs]
        return np.fromiter(map(self.index.__getitem__, names), np.int64, len(names))


@dataclass
class Alignment:
    """Per text: tokens of both, groups, links, the groups' digest and the number of distinct linked
    pairs; these pairs of all texts one after another, and how often each is linked."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[bytes]
    pairs: np.ndarray
    times: np.ndarray
    distinct: np.ndarray


class Aligner:
    """Both tokenizers over a batch of texts, and the alignment of their tokens."""

    def __init__(self, definition: str, model: bytes):
        self.a, self.b = ByteLevelTokens(definition), PieceTokens(model)
        self.windows = Windows(self.a.vocabulary, self.b.vocabulary)

    def tokens(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """Ids and their number per text under both, none for texts that the tokens do not spell."""
        spaced = pc.binary_join_element_wise("", pc.fill_null(texts, ""), " ")
        spaced = pc.if_else(pc.equal(spaced, " "), "", spaced)
        data, offsets = text_bytes(spaced)
        a_counts, a_ids = self.a.pieces.per_text(data, offsets)
        b_counts, b_ids = self.b.pieces.per_text(data, offsets)
        right = np.ones(len(texts), bool)
        for vocabulary, counts, ids in ((self.a.vocabulary, a_counts, a_ids), (self.b.vocabulary, b_counts, b_ids)):
            right &= _spells(vocabulary, counts, ids, data, offsets)
        if not right.all():
            a_ids, b_ids = a_ids[np.repeat(right, a_counts)], b_ids[np.repeat(right, b_counts)]
            a_counts, b_counts = np.where(right, a_counts, 0), np.where(right, b_counts, 0)
        return a_counts, a_ids.astype(np.int64), b_counts, b_ids.astype(np.int64)

    def __call__(self, texts: pa.Array) -> Alignment:
        a_counts, a_ids, b_counts, b_ids = self.tokens(texts)
        a, b = self.a.vocabulary, self.b.vocabulary
        a_ends, b_ends = np.cumsum(a.lengths[a_ids]), np.cumsum(b.lengths[b_ids])
        size = int(a_ends[-1]) if len(a_ends) else 0
        # A window ends where tokens of both end and the next of both begins with a space, or the text ends.
        anchors = _before_space(a, a_ids, a_counts, a_ends, size) & _before_space(b, b_ids, b_counts, b_ends, size)
        cuts = np.flatnonzero(anchors)
        n_a = np.diff(np.searchsorted(a_ends, cuts) + 1, prepend=0)
        n_b = np.diff(np.searchsorted(b_ends, cuts) + 1, prepend=0)
        windows = _id_tuples(n_a, a_ids, n_b, b_ids).dictionary_encode()
        places = self.windows.places(windows.dictionary)[windows.indices.to_numpy()]

        text_ends = np.r_[0, a_ends][np.cumsum(a_counts)]
        bounds = np.r_[0, np.searchsorted(cuts, text_ends, side="right")]
        lengths = self.windows.lengths[places]
        pairs = self.windows.pairs[ragged(self.windows.starts[places], lengths)]
        of = np.repeat(np.repeat(np.arange(len(texts)), np.diff(bounds)), lengths)
        every = len(a.lengths) * len(b.lengths)
        linked, times = np.unique(of * every + pairs, return_counts=True)
        found = list(map(self.windows.texts.__getitem__, places.tolist()))
        return Alignment(
            n_a=a_counts,
            n_b=b_counts,
            n_groups=_sums(self.windows.groups[places], bounds),
            n_links=_sums(lengths, bounds),
            digests=[
                hashlib.sha256("".join(found[x:y])[:-1].encode()).digest() if y > x else b""
                for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())
            ],
            pairs=linked % every,
            times=times,
            distinct=np.bincount(linked // every, minlength=len(texts)),
        )


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.r_[0, np.cumsum(values)][bounds])


def _before_space(vocabulary: Vocabulary, ids: np.ndarray, counts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """By byte: whether a token ends there that is its text's last or stands before one that begins with a space."""
    before = np.r_[vocabulary.spaced[ids[1:]], True] if len(ids) else np.zeros(0, bool)
    last = np.cumsum(counts)[counts > 0] - 1
    before[last] = True
    marks = np.zeros(size + 1, bool)
    marks[ends[before]] = True
    return marks


def _id_tuples(n_a: np.ndarray, a_ids: np.ndarray, n_b: np.ndarray, b_ids: np.ndarray) -> pa.Array:
    """Each window as bytes: the number of first ids, these, then the others."""
    sizes = 1 + n_a + n_b
    ends = np.cumsum(sizes)
    begins = ends - sizes
    flat = np.empty(sizes.sum(), "<i4")
    flat[begins] = n_a
    flat[ragged(begins + 1, n_a)] = a_ids
    flat[ragged(begins + 1 + n_a, n_b)] = b_ids
    offsets = np.r_[0, ends] * 4
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


def _ids_of(windows: pa.Array) -> tuple[np.ndarray, ...]:
    """What ``_id_tuples`` was made from."""
    offsets = np.frombuffer(windows.buffers()[1], np.int64)[: len(windows) + 1] // 4
    flat = np.frombuffer(windows.buffers()[2], "<i4")
    begins = offsets[:-1]
    n_a = flat[begins].astype(np.int64)
    n_b = np.diff(offsets) - 1 - n_a
    a_ids, b_ids = flat[ragged(begins + 1, n_a)], flat[ragged(begins + 1 + n_a, n_b)]
    return n_a, a_ids.astype(np.int64), n_b, b_ids.astype(np.int64)


def _spells(vocabulary: Vocabulary, counts: np.ndarray, ids: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text's tokens, put together, are its bytes."""
    before = np.r_[0, np.cumsum(vocabulary.lengths[ids])]
    sizes = np.diff(before[np.r_[0, np.cumsum(counts)]])
    right = sizes == np.diff(offsets)
    if right.all():
        found = vocabulary.spelled(ids)
        wrong = np.r_[0, np.cumsum(found != data, dtype=np.int64)]
        return np.diff(wrong[offsets]) == 0
    # Sizes differ somewhere: compare the texts whose sizes agree.
    found = vocabulary.spelled(ids[np.repeat(right, counts)])
    kept = np.diff(offsets) * right
    wrong = np.r_[0, np.cumsum(found != data[np.repeat(right, np.diff(offsets))], dtype=np.int64)]
    return right & (np.diff(wrong[np.r_[0, np.cumsum(kept)]]) == 0)


_ALIGNERS: dict[int, Aligner] = {}


def _aligner(files: tuple[str, bytes]) -> Aligner:
    """One per Python worker and pair of tokenizers."""
    key = hash(files)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(*files)
    return _ALIGNERS[key]


_ALIGNED = (
    "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, digest binary, pairs array<bigint>, times array<int>"
)


def _lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)], pa.int32()), pa.array(values, kind))


def aligned_texts(docs: DataFrame, definition_path: str, model_path: str, key: str, text: str) -> DataFrame:
    """(key, row, n_a, n_b, n_groups, n_links, digest, pairs, times): each text's alignment.

    A pair is its first id times the size of the second vocabulary, plus its second id. Both files,
    of fixed size, are read on the driver and travel with the tasks.
    """
    with open(definition_path, encoding="utf-8") as definition, open(model_path, "rb") as model:
        files = docs.sparkSession.sparkContext.broadcast((definition.read(), model.read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(files.value)
        for batch in batches:
            for part in slices(batch, "value", STEP_BYTES):
                found = aligner(part.column("value"))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key"),
                        part.column("row"),
                        *(pa.array(c, pa.int64()) for c in (found.n_a, found.n_b, found.n_groups, found.n_links)),
                        pa.array(found.digests, pa.binary()),
                        _lists(found.pairs, found.distinct, pa.int64()),
                        _lists(found.times, found.distinct, pa.int32()),
                    ],
                    names=["key", "row", "n_a", "n_b", "n_groups", "n_links", "digest", "pairs", "times"],
                )

    rows = docs.select(
        F.col(f"`{key}`").alias("key"),
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{text}`").alias("value"),
    )
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(freed(run), f"key {kind}, row bigint, {_ALIGNED}")


def link_counts(aligned: DataFrame, n_second: int) -> DataFrame:
    """(pair, n, best): how many links of the corpus have the pair; whether no pair of its second id has more."""
    links = aligned.select(F.inline(F.arrays_zip("pairs", "times")))
    counted = links.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("n"))
    counted = written(counted.withColumn("second", F.col("pair") % n_second), "pairs")
    most = counted.groupBy("second").agg(F.max("n").alias("most"))
    return written(counted.join(most, "second").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "best")


def with_link_counts(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Add ``n_best`` and ``count_sum`` to every text: its links whose count is the highest, and all their counts."""
    total = aligned.agg(F.coalesce(F.sum("n_links"), F.lit(0))).head()[0]
    hot = (F.col("n") * HOT_PAIRS) >= total
    table = counts.where(hot).sort("pair").toArrow()  # at most HOT_PAIRS rows
    shared = aligned.sparkSession.sparkContext.broadcast([table.column(c).to_numpy() for c in ("pair", "n", "best")])
    narrow = [c for c in aligned.columns if c not in ("pairs", "times")]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_pairs, n, best = shared.value
        for batch in batches:
            pairs, times = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("pairs", "times"))
            lengths = pc.list_value_length(batch.column("pairs")).to_numpy(zero_copy_only=False)
            bounds = np.r_[0, np.cumsum(lengths)]
            at = np.searchsorted(hot_pairs, pairs)
            known = np.zeros(len(pairs), bool)
            inside = at < len(hot_pairs)
            known[inside] = hot_pairs[at[inside]] == pairs[inside]
            seen = np.where(known, times, 0)
            at = np.where(known, at, 0)
            n_best = _sums(seen * best[at], bounds) if len(best) else np.zeros(len(lengths), np.int64)
            count_sum = _sums(seen * n[at], bounds) if len(n) else n_best
            left = _sums(~known, bounds)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in narrow),
                    pa.array(n_best, pa.int64()),
                    pa.array(count_sum, pa.int64()),
                    _lists(pairs[~known], left, pa.int64()),
                    _lists(times[~known], left, pa.int32()),
                ],
                names=[*narrow, "n_best", "count_sum", "pairs", "times"],
            )

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in aligned.select(*narrow).schema)
    counted = "n_best bigint, count_sum bigint, pairs array<bigint>, times array<int>"
    known = written(aligned.mapInArrow(freed(look_up), f"{fields}, {counted}"), "known")
    rare = known.select("row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), "times")))
    rare = rare.join(counts.where(~hot), "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"),
    )
    return known.drop("pairs", "times").join(rare, "row", "left").select(
        *[c for c in narrow if c != "row"],
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
    )


def aligned_tokens(
    docs: DataFrame, definition_path: str, model_path: str, n_second: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, digest, n_best, count_sum) of every row."""
    aligned = written(aligned_texts(docs, definition_path, model_path, key, text), "aligned")
    return with_link_counts(aligned, link_counts(aligned, n_second))


def vocabulary_size(model_path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_path).get_piece_size()


def op12_token_alignment(spark, sf_dir: str) -> DataFrame:
    """Every document's tokens aligned; cases as the module states them."""
    import public_tokenizers

    first, second = (public_tokenizers.path(p) for p in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    found = aligned_tokens(read(spark, sf_dir, "documents"), first, second, vocabulary_size(second))
    return found.select(
        F.col("key").cast("long").alias("doc_id"),
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        "n_best",
        "count_sum",
        F.lower(F.hex("digest")).alias("groups_sha256"),
    )
