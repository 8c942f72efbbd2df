"""Exact Jaccard join of word-shingle sets, size-aware: small sets by subsets, large by lists.

Sets are put in an order of elements, rare before common. Similar sets must share elements of
their prefixes in that order: of a set of size s, which has to share o = ceil(0.75 s) elements with
any partner, one among the first s - o + 1, two among the first s - o + 2. A small set is entered
under every pair of elements of its longer prefix; a large set is entered in the inverted list of
every element of its shorter prefix, and so are the small ones that a large one could match. The
boundary between small and large is where the estimated cost is least: entries, and list lengths to
scan.

Equal sets are one (told by 64 bits of all elements and the size). Sets that stand under one key are
compared with the key's smallest set first; then, in turns, under keys whose sets still belong to different
components, the likeliest pairs of each two components meet; and at last all pairs across components
are compared. So a group of thousands of near copies costs a few comparisons a copy, and no link between
different components is missed. Pairs are sifted by bitmaps that bound the overlap, and the rest verified on the sets,
recomputed from the texts. A bitmap of one length says nothing of sets much larger than it, and these are the costliest
to verify: large sets have a second one, as wide as they are large.

That gives components, not all links. Links are then counted within each component, where all of
them are: its sets are dealt into blocks of sets of about one size, and each pair of blocks of
compatible sizes is compared whole, as a task's work of bounded size. So every similar pair is met
once. Equal sets count as often as there are rows.

Which elements are common is counted over all documents, one table of at most ``COMMON`` elements;
it affects only the order, so no result depends on it.

Cases: a null, empty or white text has the empty set and is linked with nothing; fewer than five
words are one shingle; repeated rows are each reported; a null key takes part and is named only if
its component has no other; other columns are left out. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engagement_lake.llm.components import connected
from engagement_lake.llm.shingles import parity_bitmaps, set_signatures, shingle_sets, wide_bitmaps
from engagement_lake.llm.store import given_back, read, written
from engagement_lake.llm.units import HASHED_BYTES, freed, slices
from engagement_lake.llm.words import mixed, owners

WIDTH = 5
# Similar: NUM * union <= DEN * intersection, that is a Jaccard similarity of NUM / DEN or more.
NUM, DEN = 3, 4
BITS = 1024
COMMON, COMMON_FROM = 500_000, 8
# Sets of this size and more are always large: their subsets would be too many.
LARGEST_SMALL = 64
# Shingles after which a task reports the repeated ones among them.
COUNTED = 2 << 20
# Bits of the filter of needed texts, and bytes kept of each element while pairs are verified.
FILTER_BITS = 1 << 24
PACKED = 8
# Sets of a key that meet all others in a turn, at most so many turns before the rest is compared, and pairs
# made at a time.
PIVOTS, TURNS = 16, 3
# Pairs that a task gives for each two components in a turn, the likeliest ones.
LIKELIEST = 4
PAIR_BLOCK = 1 << 17
# About so many sets, with so many elements, of a component are compared with as many at once.
BLOCK_SETS, BLOCK_ELEMENTS = 1024, 1 << 21
# Sizes whose ratio is below this are of one class; compatible sizes lie in one or in adjacent ones.
SIZE_CLASS = 1.5
# Columns of a matrix of elements, and meetings in an element, handled at a time.
MATRIX_COLUMNS, MEETINGS = 4096, 1 << 22
# Elements that pairs carry to their partners at a time, as a share of the elements of all listed sets.
CARRIED = 0.5
# Bytes of entries that one task sorts.
ENTRIES_BYTES = 16 << 20


def _prefix(size: np.ndarray, shared: int) -> np.ndarray:
    """Elements of a set's prefix in which similar sets share so many."""
    needed = -(-size * NUM // DEN)
    return np.minimum(size, size - needed + shared)


def _describe(docs: DataFrame) -> DataFrame:
    """Rows of three kinds. A document: key, size, sig, bits, and of a large set a bitmap as wide as it is large.
    A repeated element: sig, size (count).
    The cost of a set size: size, sets, entries of pairs and of elements, list length to scan."""
    names = ["kind", "key", "hash", "size", "sig", "bits", "wide", "sets", "pairs", "singles", "scanned"]

    def rows_of(n, kind_of, key_type, **columns) -> pa.RecordBatch:
        types = [pa.int8(), key_type, *[pa.int64()] * 3, *[pa.binary()] * 2, *[pa.int64()] * 4]
        arrays = [
            pa.array(np.full(n, kind_of, np.int8)) if name == "kind"
            else columns.get(name, pa.nulls(n, t))
            for name, t in zip(names, types)
        ]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held, cost = [], 0, np.zeros((LARGEST_SMALL, 4), np.int64)
        key_type = pa.int64()

        def repeated() -> pa.RecordBatch:
            element, count = np.unique(np.concatenate(held), return_counts=True)
            element, count = element[count > 1].view(np.int64), count[count > 1]
            return rows_of(len(element), 1, key_type, sig=pa.array(element), size=pa.array(count))

        for batch in batches:
            key_type = batch.schema.field("key").type
            for rows in slices(batch, "text", HASHED_BYTES):
                values, offsets = shingle_sets(rows.column("text"), WIDTH)
                sizes, sig = np.diff(offsets), set_signatures(values, offsets)
                bitmaps = parity_bitmaps(values, offsets, BITS)
                packed = pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(BITS // 8), len(sizes), [None, pa.py_buffer(bitmaps.tobytes())]
                ).cast(pa.binary())
                yield rows_of(
                    len(sizes), 0, key_type,
                    key=rows.column("key"), hash=rows.column("hash"), size=pa.array(sizes), sig=pa.array(sig), bits=packed,
                    wide=pa.array(wide_bitmaps(values, offsets, BITS), pa.binary()),
                )
                _, first = np.unique(sig, return_index=True)
                one = np.zeros(len(sizes), bool)
                one[first] = True
                of_one = np.repeat(one, sizes)
                held.append(values[of_one])
                n_held += len(held[-1])
                few = one & (sizes > 0) & (sizes < LARGEST_SMALL)
                if few.any():
                    _, place, seen = np.unique(values[of_one], return_inverse=True, return_counts=True)
                    excess = np.zeros(len(values), np.int64)
                    excess[of_one] = seen[place] - 1
                    share = np.diff(np.r_[0, np.cumsum(excess)][offsets])
                    pairs, singles = _prefix(sizes, 2), _prefix(sizes, 1)
                    for column, amount in enumerate(
                        (np.ones_like(sizes), pairs * (pairs - 1) // 2, singles, share * singles // np.maximum(sizes, 1))
                    ):
                        cost[:, column] += np.bincount(sizes[few], amount[few], LARGEST_SMALL).astype(np.int64)
                if n_held >= COUNTED:
                    yield repeated()
                    held, n_held = [], 0
        if held:
            yield repeated()
        at = np.flatnonzero(cost[:, 0])
        columns = dict(zip(names[7:], (pa.array(c) for c in cost[at].T)))
        yield rows_of(len(at), 2, key_type, size=pa.array(at), **columns)

    schema = T.StructType().add("kind", "byte").add("key", docs.schema["key"].dataType)
    for name in names[2:]:
        schema = schema.add(name, "binary" if name in ("bits", "wide") else "long")
    return docs.mapInArrow(freed(describe), schema)


def choose_boundary(costs: list) -> int:
    """The size below which sets are small, by least cost of entries and scanning.

    ``costs`` are (size, pairs, singles, scanned) sums. Sets from 3/4 of the boundary on are entered
    in lists too, since a large set may match them.
    """

    def total(boundary: int) -> int:
        small = sum(c["pairs"] for c in costs if c["size"] < boundary)
        return small + sum(
            c["singles"] + c["scanned"] for c in costs if c["size"] * DEN >= boundary * NUM
        )

    return min(range(2, LARGEST_SMALL + 1), key=total)


def _entries(docs: DataFrame, common: tuple[np.ndarray, np.ndarray], boundary: int) -> DataFrame:
    """(entry, sig, size): under which keys each set stands."""
    held = docs.sparkSession.sparkContext.broadcast(common)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        elements, counts = held.value
        for batch in batches:
            for rows in slices(batch, "text", HASHED_BYTES):
                values, offsets = shingle_sets(rows.column("text"), WIDTH)
                sizes, sig = np.diff(offsets), set_signatures(values, offsets)
                _, first = np.unique(sig, return_index=True)
                one = np.zeros(len(sizes), bool)
                one[first] = True
                one &= sizes > 1
                kept = np.repeat(one, sizes)
                values, of = values[kept], np.repeat(np.arange(len(sizes)), sizes)[kept]
                weight = np.zeros(len(values), np.int64)
                if len(elements):
                    at = np.minimum(np.searchsorted(elements, values), len(elements) - 1)
                    weight = np.where(elements[at] == values, counts[at], 0)
                order = np.lexsort((values, weight, of))
                values, of = values[order], of[order]
                n = np.bincount(of, minlength=len(sizes))
                place = np.arange(len(of)) - (np.cumsum(n) - n)[of]
                size = sizes[of]
                listed = (place < _prefix(size, 1)) & (size * DEN >= boundary * NUM)
                keys, owner = [values[listed]], [of[listed]]
                paired = (place < _prefix(size, 2)) & (size < boundary)
                small, small_of = values[paired], of[paired]
                for gap in range(1, LARGEST_SMALL):
                    together = small_of[gap:] == small_of[:-gap] if gap < len(small) else np.zeros(0, bool)
                    if not together.any():
                        break
                    a, b = small[:-gap][together], small[gap:][together]
                    low, high = np.minimum(a, b), np.maximum(a, b)
                    keys.append(mixed(low * np.uint64(0xC2B2AE3D27D4EB4F) + high))
                    owner.append(small_of[gap:][together])
                entry, owner = np.concatenate(keys).view(np.int64), np.concatenate(owner)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(entry), pa.array(sig[owner]), pa.array(sizes[owner])], names=["entry", "sig", "size"]
                )

    return docs.select("text").mapInArrow(freed(enter), "entry bigint, sig bigint, size bigint")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entries of a partition whose key more than one set has, each once, with the number of the key's
    sets and its smallest one."""
    parts = [[batch.column(i).to_numpy() for i in range(3)] for batch in batches]
    if not parts:
        return
    entry, sig, size = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((sig, size, entry))
    entry, sig, size = entry[order], sig[order], size[order]
    new = np.r_[True, (entry[1:] != entry[:-1]) | (sig[1:] != sig[:-1])]
    entry, sig, size = entry[new], sig[new], size[new]
    same = entry[1:] == entry[:-1]
    keep = np.r_[same, False] | np.r_[False, same]
    entry, sig, size = entry[keep], sig[keep], size[keep]
    least = np.searchsorted(entry, entry)
    sets = np.searchsorted(entry, entry, side="right") - least
    columns = (entry, sig, size, sets, sig[least], size[least])
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=_LIST_COLUMNS)


_LIST_COLUMNS = ["entry", "sig", "size", "sets", "least", "least_size"]


def _compatible(a: str, b: str):
    return (F.col(a) * DEN >= F.col(b) * NUM) & (F.col(b) * DEN >= F.col(a) * NUM)


def _bitmap_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BITS // 8)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)).sum(axis=-1, dtype=np.int64)


def _possible(apart: np.ndarray, both: np.ndarray) -> np.ndarray:
    """Whether bitmaps that differ in so many bits leave it possible that sets of so many elements are similar.

    The overlap is at most half of what the bitmaps leave, and has to be NUM / (NUM + DEN) of both.
    """
    return (NUM + DEN) * (both - apart) >= 2 * NUM * both


def _sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose bitmaps leave it possible that they are similar."""
    for batch in batches:
        both = batch.column("size_a").to_numpy() + batch.column("size_b").to_numpy()
        keep = _possible(_apart(_bitmap_rows(batch.column("bits_a")), _bitmap_rows(batch.column("bits_b"))), both)
        batch, both = batch.filter(pa.array(keep)), both[keep]
        apart = np.zeros(len(both), np.int64)
        for i, wide in enumerate(zip(batch.column("wide_a").to_pylist(), batch.column("wide_b").to_pylist())):
            if None not in wide:
                apart[i] = _apart(*_as_wide(*wide))
        yield batch.select(["a", "b", "size_a"]).filter(pa.array(_possible(apart, both)))


def _as_wide(a: bytes, b: bytes) -> list[np.ndarray]:
    """Two bitmaps, the wider folded to the width of the other."""
    width = min(len(a), len(b))
    return [np.bitwise_xor.reduce(np.frombuffer(x, np.uint8).reshape(-1, width), axis=0) for x in (a, b)]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()
        keep = []
        for a, b in zip(left, right):
            a, b = _unpacked(a), _unpacked(b)
            together = np.sort(np.concatenate([a, b]))
            overlap = int((together[1:] == together[:-1]).sum())
            keep.append(overlap * (NUM + DEN) >= NUM * (len(a) + len(b)))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _packed(values: np.ndarray) -> bytes:
    """The upper ``PACKED`` bytes of each hash, all of them."""
    kept = (values >> np.uint64(64 - 8 * PACKED)).astype("<u8")
    return kept.view(np.uint8).reshape(-1, 8)[:, :PACKED].tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // PACKED, 8), np.uint8)
    out[:, :PACKED] = np.frombuffer(packed, np.uint8).reshape(-1, PACKED)
    return out.view("<u8").ravel()


def _joined(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """The (a, b) pairs with the ``facts`` of both signatures, whose names get ``_a`` and ``_b``.

    Only facts that a pair may need are shuffled to it: a filter of fixed size tells which, so that few pairs
    do not move all facts.
    """
    place = F.pmod(F.xxhash64("sig"), F.lit(FILTER_BITS))
    word, bit = F.shiftright(place, 6), F.expr("shiftleft(1L, CAST(place % 64 AS INT))")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("sig")).select(place.alias("place"))
    needed = needed.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits_of_word"))
    held = facts.withColumns({"place": place, "word": word})
    held = held.join(F.broadcast(needed), "word").where(F.col("bits_of_word").bitwiseAND(bit) != 0)
    for x in "ab":
        named = [F.col(c).alias(x if c == "sig" else f"{c}_{x}") for c in facts.columns]
        pairs = pairs.join(held.select(*named), x)
    return pairs


class SetStore:
    """Sets of the documents that pairs need, taken from the texts once for each set, and the bitmaps of
    those that are ``listed``."""

    def __init__(self, docs: DataFrame, described: DataFrame, listed: DataFrame):
        self.docs, self.described = docs, described
        self.bitmaps = described.groupBy("sig").agg(*[F.first(c).alias(c) for c in ("bits", "wide", "size")])
        self.bitmaps = written(self.bitmaps.join(listed, "sig", "left_semi"), "bitmaps")
        self.sets: DataFrame | None = None
        self._parts: list[DataFrame] = []
        self._elements: int | None = None

    def give_back(self) -> None:
        """Delete the files of all sets: nothing may need them any more."""
        given_back(*self._parts)

    def _fetch(self, pairs: DataFrame) -> None:
        wanted = pairs.select(F.col("a").alias("sig")).union(pairs.select("b")).distinct()
        if self.sets is not None:
            wanted = wanted.join(self.sets, "sig", "left_anti")
        # One text of each set. A filter of fixed size tells a task which texts it may need to
        # shingle, so that no text is shuffled; what it lets through by chance is joined away.
        holders = self.described.join(wanted, "sig").groupBy("sig").agg(F.min("hash").alias("hash"))
        place = F.pmod(F.xxhash64("hash"), F.lit(FILTER_BITS))
        bit = F.expr("bit_or(shiftleft(1L, CAST(place % 64 AS INT)))").alias("bits")
        words = holders.select(place.alias("place")).groupBy(F.floor(F.col("place") / 64).alias("word"))
        words = words.agg(bit).toPandas()  # bounded by FILTER_BITS
        bits = np.zeros(FILTER_BITS // 64, np.int64)
        bits[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
        held = self.docs.sparkSession.sparkContext.broadcast(bits)

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = batch.column("place").to_numpy()
                needed = held.value.view(np.uint64)[at // 64] >> (at % 64).astype(np.uint64) & np.uint64(1)
                for rows in slices(batch.filter(pa.array(needed.astype(bool))), "text", HASHED_BYTES):
                    values, offsets = shingle_sets(rows.column("text"), WIDTH)
                    sig = set_signatures(values, offsets)
                    sig, first = np.unique(sig, return_index=True)
                    whole = _packed(values)
                    ends = offsets * PACKED
                    parts = [whole[ends[i] : ends[i + 1]] for i in first.tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(sig), pa.array(parts, pa.binary())], names=["sig", "elements"]
                    )

        texts = self.docs.select(F.pmod(F.xxhash64("hash"), F.lit(FILTER_BITS)).alias("place"), "text")
        found = texts.mapInArrow(freed(sets), "sig bigint, elements binary").join(wanted, "sig", "left_semi")
        found = written(found.dropDuplicates(["sig"]), "sets")
        self._parts.append(found)
        self.sets = found if self.sets is None else self.sets.unionByName(found)

    def similar(self, pairs: DataFrame) -> DataFrame:
        """The (a, b) pairs of signatures whose sets are similar, written."""
        sifted = _joined(pairs, self.bitmaps)
        sifted = written(sifted.mapInArrow(freed(_sift), "a bigint, b bigint, size_a bigint"), "pairs")
        self._fetch(sifted)
        # Each pair carries a set to its partner, and a set can have many: in rounds, whose shuffles go before
        # the next begins, so that what is carried at a time stays in proportion to the sets.
        n = self._rounds(sifted)
        found = []
        for turn in range(n):
            part = sifted.where(F.pmod(F.xxhash64("a", "b"), F.lit(n)) == turn).select("a", "b")
            part = _joined(part, self.sets.withColumnRenamed("elements", "set"))
            found.append(written(part.mapInArrow(freed(_verify), "a bigint, b bigint"), "similar"))
        given_back(sifted)
        if n == 1:
            return found[0]
        whole = written(reduce(DataFrame.unionByName, found), "similar")
        given_back(*found)
        return whole

    def _rounds(self, sifted: DataFrame) -> int:
        carried = sifted.agg(F.coalesce(F.sum("size_a"), F.lit(0))).head()[0]
        if self._elements is None:
            self._elements = self.bitmaps.agg(F.coalesce(F.sum("size"), F.lit(0))).head()[0]
        return max(1, math.ceil(carried / max(1, CARRIED * self._elements)))


def _cross_pairs(turn: int | None):
    """Pairs of sets under one key, of compatible size and in different components, that bitmaps allow.

    In a ``turn``, ``PIVOTS`` sets of a key, others in each turn, meet the others, and of the pairs that would
    join the same two components a task gives the ``LIKELIEST`` ones. If these sets are all but one of the key,
    all its pairs have met and all are given: the key is done with. Without a turn, it gives all pairs of all
    sets, each once. Pairs are made a bounded block at a time.
    """

    def pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, bitmaps = [], []
        for batch in batches:
            parts.append([batch.column(n).to_numpy() for n in ("entry", "size", "component", "sig")])
            bitmaps.append(_bitmap_rows(batch.column("bits")))
        if not parts:
            return
        entry, size, component, sig = (np.concatenate(x) for x in zip(*parts))
        bits = np.concatenate(bitmaps)
        order = np.lexsort((mixed(sig.view(np.uint64) ^ np.uint64(turn or 0)), entry))
        entry, size, component, sig, bits = (x[order] for x in (entry, size, component, sig, bits))
        every = np.arange(len(entry))
        place = every - np.searchsorted(entry, entry)
        n = np.searchsorted(entry, entry, side="right") - every - 1
        whole = np.ones(len(entry), bool)
        if turn is not None:
            whole = n + place <= PIVOTS
            n[place >= PIVOTS] = 0
        total = np.cumsum(n)
        kept = np.zeros((0, 2), np.int64)
        best = np.zeros((0, 5), np.int64)
        begin = 0
        while begin < len(entry):
            done = total[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, done + PAIR_BLOCK, side="right")))
            first = np.repeat(every[begin:end], n[begin:end])
            step = np.arange(len(first)) - np.repeat(np.cumsum(n[begin:end]) - n[begin:end], n[begin:end])
            second = first + 1 + step
            a, b = size[first], size[second]
            keep = (component[first] != component[second]) & (np.minimum(a, b) * DEN >= np.maximum(a, b) * NUM)
            first, second = first[keep], second[keep]
            a, b = sig[first], sig[second]
            pairs = np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)
            if turn is None:
                # A pair stands under many keys: bitmaps are looked at once.
                pairs, at = np.unique(pairs, axis=0, return_index=True)
                first, second = first[at], second[at]
            apart = _apart(bits[first], bits[second])
            both = size[first] + size[second]
            able = _possible(apart, both)
            kept = np.unique(np.concatenate([kept, pairs[able & whole[first]]]), axis=0)
            if len(kept) > PAIR_BLOCK:
                yield _pair_batch(kept)
                kept = kept[:0]
            able &= ~whole[first]
            if able.any():
                c, d = component[first[able]], component[second[able]]
                unlike = (apart[able] << 20) // np.maximum(both[able], 1)
                found = np.stack([np.minimum(c, d), np.maximum(c, d), unlike, *pairs[able].T], axis=1)
                best = np.concatenate([best, found])
                best = np.unique(best, axis=0)  # in order of components, then of likeness
                starts = np.flatnonzero(np.r_[True, (best[1:, :2] != best[:-1, :2]).any(axis=1)][: len(best)])
                rank = np.arange(len(best)) - np.repeat(starts, np.diff(np.r_[starts, len(best)]))
                best = best[rank < LIKELIEST]
            begin = end
        yield _pair_batch(np.unique(np.concatenate([kept, best[:, 3:]]), axis=0))

    return pairs_of


def _pair_batch(pairs: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each set on the left shares with each on the right.

    Elements of many sets are multiplied as a matrix; of the others each meeting is counted.
    """
    n, m = len(left), len(right)
    _, element = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    owner = np.repeat(np.arange(n + m), [len(x) for x in (*left, *right)])
    a, b = (np.bincount(element[of], minlength=int(element.max(initial=-1)) + 1) for of in (owner < n, owner >= n))
    many = (a * b * 32 > n * m) & (n * m > MATRIX_COLUMNS)
    out = np.zeros((n, m), np.int64)

    column = np.cumsum(many) - 1
    inside = np.flatnonzero(many[element])
    inside = inside[np.argsort(column[element[inside]], kind="stable")]
    places = column[element[inside]]
    for begin in range(0, int(many.sum()), MATRIX_COLUMNS):
        part = slice(*np.searchsorted(places, [begin, begin + MATRIX_COLUMNS]))
        matrix = np.zeros((n + m, MATRIX_COLUMNS), np.float32)
        matrix[owner[inside[part]], places[part] - begin] = 1
        out += (matrix[:n] @ matrix[n:].T).astype(np.int64)

    few = ~many & (a > 0) & (b > 0)
    first, second = (np.flatnonzero(few[element] & of) for of in (owner < n, owner >= n))
    second = second[np.argsort(element[second], kind="stable")]
    starts = np.searchsorted(element[second], element[first])
    times = b[element[first]]
    total = np.cumsum(times)
    begin = 0
    while begin < len(first):
        done = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, done + MEETINGS, side="right")))
        t = times[begin:end]
        step = np.arange(t.sum()) - np.repeat(np.cumsum(t) - t, t)
        i = np.repeat(owner[first[begin:end]], t)
        j = owner[second[np.repeat(starts[begin:end], t) + step]] - n
        out += np.bincount(i * m + j, minlength=n * m).reshape(n, m)
        begin = end
    return out


_PLACE = ["component", "class_a", "block_a", "class_b", "block_b"]


def _linked(as_pairs: bool):
    """Of rows sorted by pair of blocks: the similar pairs, or how many rows each set is similar to."""

    def solve(sig, size, copies, side, elements) -> pa.RecordBatch | None:
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        if not len(left) or not len(right):
            return None
        sets = [_unpacked(x) for x in elements]
        shared = _overlaps([sets[i] for i in left], [sets[i] for i in right])
        near = shared * (NUM + DEN) >= NUM * (size[left][:, None] + size[right])
        alone = side[0] == 2  # a block with itself
        if alone:
            near = np.triu(near, 1)
        i, j = np.nonzero(near)
        a, b = left[i], right[j]
        if as_pairs:
            low, high = np.minimum(sig[a], sig[b]), np.maximum(sig[a], sig[b])
            return pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], names=["a", "b"])
        n = np.zeros(len(sig), np.int64)
        np.add.at(n, a, copies[b])
        np.add.at(n, b, copies[a])
        return pa.RecordBatch.from_arrays([pa.array(sig[n > 0]), pa.array(n[n > 0])], names=["sig", "n"])

    def links_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["sig", "size", "copies", "side"]
        at, held = None, []

        def solved():
            columns = [np.concatenate([part[c] for part in held]) for c in range(len(names))]
            return solve(*columns, [x for part in held for x in part[-1]])

        for batch in batches:
            if not batch.num_rows:
                continue
            places = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in _PLACE], axis=1)
            columns = [batch.column(c).to_numpy() for c in names]
            elements = batch.column("elements").to_pylist()
            starts = np.flatnonzero(np.r_[True, (places[1:] != places[:-1]).any(axis=1)]).tolist()
            for begin, end in zip(starts, [*starts[1:], batch.num_rows]):
                place = tuple(places[begin].tolist())
                if place != at and held:
                    if (found := solved()) is not None:
                        yield found
                    held = []
                at = place
                held.append([*(c[begin:end] for c in columns), elements[begin:end]])
        if held and (found := solved()) is not None:
            yield found

    return links_of


def _all_links(members: DataFrame, sets: DataFrame, partitions: int, as_pairs: bool) -> DataFrame:
    """All (a, b) links, or (sig, n) counts of them, of the (component, sig, size, copies) members."""
    of = F.floor(F.log("size") / float(np.log(SIZE_CLASS))).cast("int")
    members = members.withColumn("class", of)

    def blocks(sets: str, elements: str):
        return F.greatest(F.ceil(F.col(sets) / BLOCK_SETS), F.ceil(F.col(elements) / BLOCK_ELEMENTS)).cast("int")

    loads = members.groupBy("component", "class").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("elements"))
    whole = loads.groupBy("component").agg(F.sum("n").alias("all"), F.sum("elements").alias("all_elements"))
    large = loads.join(whole.where(blocks("all", "all_elements") > 1), "component")
    large = written(large.select("component", "class", blocks("n", "elements").alias("blocks")), "blocks")
    beside = {
        name: large.select("component", (F.col("class") + step).alias("class"), F.col("blocks").alias(name))
        for name, step in (("above", -1), ("below", 1))
    }
    for name in ("above", "below"):
        large = large.join(beside[name], ["component", "class"], "left")
    dealt = members.join(large.fillna(0, ["above", "below"]), ["component", "class"], "left")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("sig"), F.col("blocks")).cast("int"))

    def place(class_a, block_a, class_b, block_b, side):
        parts = zip([*_PLACE[1:], "side"], (class_a, block_a, class_b, block_b, side))
        return F.struct(*[x.cast("int").alias(name) for name, x in parts])

    def each(n: str, f):
        return F.transform(F.slice(F.sequence(F.lit(0), F.col(n)), F.lit(1), F.col(n)), f)

    c, b = F.col("class"), F.col("block")
    own = each("blocks", lambda j: place(
        c, F.least(b, j), c, F.greatest(b, j), F.when(b == j, 2).when(b < j, 0).otherwise(1)
    ))
    above = each("above", lambda j: place(c, b, c + 1, j, F.lit(0)))
    below = each("below", lambda j: place(c - 1, j, c, b, F.lit(1)))
    alone = F.array(place(*[F.lit(0)] * 4, F.lit(2)))
    to = F.when(F.col("blocks").isNull(), alone).otherwise(F.concat(own, above, below))
    sent = dealt.join(sets, "sig").withColumn("to", F.explode(to))
    sent = sent.select("component", "to.*", "sig", "size", "copies", "elements")
    sent = sent.repartition(partitions, *_PLACE).sortWithinPartitions(*_PLACE)
    if as_pairs:
        return sent.mapInArrow(freed(_linked(True)), "a bigint, b bigint")
    return sent.mapInArrow(freed(_linked(False)), "sig bigint, n bigint").groupBy("sig").agg(F.sum("n").alias("n"))


def _connected_sets(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, SetStore, DataFrame, int]:
    """The described rows, the sets of all that have a link, their components, a number of partitions."""
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    facts = written(_describe(rows), "shingle-facts")
    described = facts.where("kind = 0").select("key", "hash", "size", "sig", "bits", "wide")

    common = facts.where("kind = 1").groupBy("sig").agg(F.sum("size").alias("n")).where(F.col("n") >= COMMON_FROM)
    common = common.orderBy(F.desc("n"), "sig").limit(COMMON).toPandas()  # bounded by COMMON
    elements = common["sig"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(elements)
    sums = [F.sum(c).alias(c) for c in ("pairs", "singles", "scanned")]
    costs = facts.where("kind = 2").groupBy("size").agg(*sums).collect()  # bounded by LARGEST_SMALL
    boundary = choose_boundary(costs)

    entries = _entries(rows, (elements[order], common["n"].to_numpy(np.int64)[order]), boundary)
    size = facts.agg(F.coalesce(F.sum("size"), F.lit(0))).head()[0]
    partitions = max(12, -(-int(size) * 6 // ENTRIES_BYTES))
    lists = entries.repartition(partitions, "entry").mapInArrow(
        freed(_shared), ", ".join(f"{c} bigint" for c in _LIST_COLUMNS)
    )
    lists = written(lists, "lists")
    near = lists.where(_compatible("size", "least_size") & (F.col("sig") != F.col("least")))
    pairs = near.select(F.least("least", "sig").alias("a"), F.greatest("least", "sig").alias("b")).distinct()
    pairs = written(pairs, "near")
    store = SetStore(rows, described, lists.select("sig").distinct())
    links = store.similar(pairs)

    # Keys whose sets are not yet of one component: in some turns a few sets of each meet the others across,
    # which joins most of what hangs together, and then all that are still apart. A key whose sets are of
    # one component is done with, as is one of two sets, which have met, and one whose sets all met in a turn.
    # What only led to a table is given back when that is written.
    done, apart = pairs, lists.where("sets > 2").select("entry", "sig", "size", "sets")
    compared, held = [pairs], lists
    turn: int | None = 0
    groups = connected(links)
    given_back(links)
    while True:
        components = groups.withColumnRenamed("node", "sig")
        named = apart.join(components, "sig", "left").withColumn("component", F.coalesce("component", "sig"))
        bounds = named.groupBy("entry").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        named = written(named.join(bounds.where("lo <> hi").select("entry"), "entry"), "apart")
        given_back(held)
        held = named
        if named.isEmpty():
            break
        across = named.drop("sets").join(store.bitmaps.select("sig", "bits"), "sig").repartition(partitions, "entry")
        across = across.mapInArrow(freed(_cross_pairs(turn)), "a bigint, b bigint").distinct()
        across = written(across.join(done, ["a", "b"], "left_anti"), "across")
        joined = False
        if not across.isEmpty():
            found = store.similar(across)
            joined = not found.isEmpty()
            if joined:
                # A star links what its component's links do.
                star = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
                before, groups = groups, connected(star.unionByName(found))
                given_back(before)
            given_back(found)
        compared.append(across)
        if turn is None:
            break
        done, apart = done.unionByName(across), named.drop("component").where(F.col("sets") > PIVOTS + 1)
        turn = turn + 1 if joined and turn + 1 < TURNS else None

    given_back(held, *compared, store.bitmaps)
    return described, store, groups, partitions


def _classes(described: DataFrame) -> DataFrame:
    """(sig, least, size, copies) of each set that is not empty: its least key and how many rows have it."""
    found = described.where("size > 0").groupBy("sig")
    return found.agg(F.min("key").alias("least"), F.first("size").alias("size"), F.count(F.lit(1)).alias("copies"))


def _members(described: DataFrame, groups: DataFrame) -> DataFrame:
    named = groups.select(F.col("node").alias("sig"), "component")
    return written(named.join(_classes(described).drop("least"), "sig"), "members")


def jaccard_pairs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(a, b) for each two different sets that are similar, each named by the least key that has it."""
    described, store, groups, partitions = _connected_sets(docs, key, text)
    members = _members(described, groups)
    pairs = written(_all_links(members, store.sets, partitions, True), "pairs")
    given_back(members)
    store.give_back()
    least = {x: _classes(described).select(F.col("sig").alias(x), F.col("least").alias(f"least_{x}")) for x in "ab"}
    pairs = pairs.join(least["a"], "a").join(least["b"], "b")
    return pairs.select(F.least("least_a", "least_b").alias("a"), F.greatest("least_a", "least_b").alias("b"))


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", counted: bool = True) -> DataFrame:
    """(key, n_shingles, n_links, component) of every row.

    ``component`` is the least key that links reach; ``n_links`` counts the other rows that are similar
    to the row, those of an equal set among them. Unless ``counted``, it is left out.
    """
    described, store, groups, partitions = _connected_sets(docs, key, text)
    classes = _classes(described)
    if counted:
        members = _members(described, groups)
        degree = written(_all_links(members, store.sets, partitions, False), "degrees")
        given_back(members)
        classes = classes.join(degree, "sig", "left")
    else:
        classes = classes.withColumn("n", F.lit(0))
    store.give_back()
    classes = classes.join(groups, classes["sig"] == groups["node"], "left")
    links = F.coalesce("n", F.lit(0)) + F.col("copies") - 1
    classes = classes.select("sig", "least", links.alias("n_links"), F.coalesce("component", "sig").alias("component"))
    roots = classes.groupBy("component").agg(F.min("least").alias("root"))
    classes = classes.join(roots, "component").select("sig", "root", "n_links")
    found = described.select("key", "size", F.when(F.col("size") > 0, F.col("sig")).alias("sig"))
    found = found.join(classes, "sig", "left")
    found = found.select(
        F.col("key").alias(key),
        F.col("size").alias("n_shingles"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("root", "key").alias("component"),
    )
    return found if counted else found.drop("n_links")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_components(read(spark, sf_dir, "documents"))
    return found.withColumnRenamed("component", "component_id")
