"""Packing token pieces into as few sequences as can be, by linear grouping and best fit.

Only the number of pieces of each length matters to a packing, and there are at most ``capacity``
lengths. So Spark counts the lengths, the driver packs the counts, whatever the number of
documents, and Spark gives each piece the place of its rank among the pieces of its length.

The driver's packing: large pieces, in order of length, form groups of equal cardinality and are
rounded up to their group's longest; the few sizes are packed by filling one sequence as full as a
knapsack can and repeating that configuration as often as the groups allow; real lengths then
replace the rounded ones; small pieces, longest first, go to the fullest sequences that take them.

Cases: a null or empty text is its end token; repeated rows are packed each; a null key is kept;
ties of length are told apart by rank, in order of key, piece and checksum. An empty table gives no
rows. Other columns are left out.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from engagement_lake.llm.store import read, written
from engagement_lake.llm.units import freed, library_tokenizer, slices, stretches

CAPACITY = 4096
# Numbers of groups to try, and parts of a sequence up to which a piece is small.
GROUPS = (24, 12, 48, 96, 200, 400)
SMALL = (1 / 8, 1 / 4)
BUCKET_ROWS = 20_000
# Bytes of text that are cut into ids at a time.
CUT_BYTES = 2 << 20


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    capacity: int,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """(key, piece, start, length, ids_crc32, ids): each text's ids and ``end_id``, cut if too long.

    ``ids`` are little-endian unsigned 32-bit integers, left out unless ``with_ids``.
    """
    names = ["key", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = library_tokenizer(definition.value)
        for batch in batches:
            for rows in slices(batch, "text", CUT_BYTES):
                counts, found = tokenizer(rows.column("text"))
                ids = np.insert(found, np.cumsum(counts), end_id)
                counts = counts + 1
                n_pieces = -(-counts // capacity)
                row = np.repeat(np.arange(len(counts)), n_pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                start = piece * capacity
                length = np.minimum(counts[row] - start, capacity)
                parts = stretches(ids, length)
                columns = [
                    rows.column("key").take(pa.array(row)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([p.tobytes() for p in parts], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    schema += ", ids binary" if with_ids else ""
    return rows.mapInArrow(freed(cut), schema)


@dataclass
class Run:
    """``count`` sequences filled alike: for each slot, the length and the first of ``count`` ranks."""

    count: int
    left: int
    slots: list[tuple[int, int]] = field(default_factory=list)

    def split(self, count: int) -> Run:
        """Take the first ``count`` sequences out of this run."""
        first = Run(count, self.left, list(self.slots))
        self.count -= count
        self.slots = [(length, rank + count) for length, rank in self.slots]
        return first


def _groups(large: list[tuple[int, int]], n_groups: int) -> list[list[list[int]]]:
    """Runs [length, first rank, count] of descending lengths in groups of equal cardinality."""
    total = sum(n for _, n in large)
    quota = max(1, -(-total // n_groups))
    groups: list[list[list[int]]] = []
    room = 0
    for length, n in large:
        rank = 0
        while n:
            if not room:
                groups.append([])
                room = quota
            take = min(n, room)
            groups[-1].append([length, rank, take])
            rank, n, room = rank + take, n - take, room - take
    return groups


def _fullest(sizes: list[int], available: list[int], capacity: int) -> list[int]:
    """How many of each size fill one sequence best, the first available size being used at least once."""
    first = next(i for i, n in enumerate(available) if n)
    items = [
        i
        for i in range(first, len(sizes))
        for _ in range(min(available[i] - (i == first), (capacity - sizes[first]) // sizes[i]))
    ]
    # reached[s]: the number of items tried when the sum s first came up, 0 for none, -1 never.
    reached = np.full(capacity - sizes[first] + 1, -1)
    reached[0] = 0
    for k, i in enumerate(items, 1):
        size = sizes[i]
        new = np.flatnonzero((reached[size:] < 0) & (reached[:-size] >= 0) & (reached[:-size] < k))
        reached[new + size] = k
        if reached[-1] >= 0:
            break
    chosen = [0] * len(sizes)
    chosen[first] = 1
    at = int(np.flatnonzero(reached >= 0)[-1])
    while at:
        item = items[reached[at] - 1]
        chosen[item] += 1
        at -= sizes[item]
    return chosen


def _substituted(group: list[list[int]], count: int) -> list[list[int]]:
    """Take ``count`` real pieces out of the group, longest first."""
    taken = []
    while count:
        length, rank, n = group[0]
        take = min(n, count)
        taken.append([length, rank, take])
        group[0] = [length, rank + take, n - take]
        if not group[0][2]:
            group.pop(0)
        count -= take
    return taken


def pack_lengths(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Runs of sequences that hold every rank of every length once: the best of a few groupings."""
    least = -(-sum(length * n for length, n in counts.items()) // capacity)
    best: tuple[int, list[Run]] | None = None
    for small in SMALL:
        for n_groups in GROUPS:
            runs = _packed(counts, capacity, n_groups, int(capacity * small))
            used = sum(run.count for run in runs)
            if best is None or used < best[0]:
                best = used, runs
            if used == least:
                return runs
    return best[1]


def _packed(counts: dict[int, int], capacity: int, n_groups: int, limit: int) -> list[Run]:
    """One packing: pieces of up to ``limit`` tokens are small, the others form ``n_groups`` groups."""
    by_length = sorted(counts.items(), reverse=True)
    groups = _groups([(length, n) for length, n in by_length if length > limit], n_groups)
    sizes = [group[0][0] for group in groups]
    available = [sum(n for *_, n in group) for group in groups]

    runs: list[Run] = []
    while any(available):
        chosen = _fullest(sizes, available, capacity)
        times = min(n // c for n, c in zip(available, chosen) if c)
        slots = []
        for i, c in enumerate(chosen):
            available[i] -= c * times
            slots += [_substituted(groups[i], times) for _ in range(c)]
        while slots[0]:  # sequences alike as long as no slot changes its length
            count = min(slot[0][2] for slot in slots)
            run = Run(count, capacity - sum(slot[0][0] for slot in slots))
            for slot in slots:
                length, rank, n = slot[0]
                run.slots.append((length, rank))
                slot[0] = [length, rank + count, n - count]
                if n == count:
                    slot.pop(0)
            runs.append(run)

    open_runs: dict[int, list[Run]] = {}
    lefts: list[int] = []

    def put(run: Run) -> None:
        if run.left not in open_runs:
            open_runs[run.left] = []
            insort(lefts, run.left)
        open_runs[run.left].append(run)

    for run in runs:
        put(run)
    for length, n in ((length, n) for length, n in by_length if length <= limit):
        rank = 0
        while rank < n:
            at = bisect_left(lefts, length)
            if at == len(lefts):
                put(Run(-(-(n - rank) // (capacity // length)), capacity))
                at = len(lefts) - 1
            left = lefts[at]
            run = open_runs[left].pop()
            taken = run.split(min(run.count, n - rank))
            if run.count:
                open_runs[left].append(run)
            if not open_runs[left]:
                del open_runs[left], lefts[at]
            taken.slots.append((length, rank))
            taken.left -= length
            rank += taken.count
            put(taken)
    return [run for alike in open_runs.values() for run in alike]


def _segments(runs: list[Run]) -> tuple[np.ndarray, ...]:
    """Sorted keys (length, first rank) with the first sequence and the offset in each sequence."""
    first, rows = 0, []
    for run in runs:
        offset = 0
        for length, rank in run.slots:
            rows.append((length << 40 | rank, first, offset))
            offset += length
        first += run.count
    table = np.array(sorted(rows), np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2]


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with the sequence and the place in it of each."""
    spark = pieces.sparkSession
    lengths = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = spark.sparkContext.broadcast(_segments(pack_lengths(lengths, capacity)))

    # The rank of a piece among those of its length, counted in buckets: a length may be very common.
    order = ["key", "piece", "ids_crc32"]
    buckets = max(16, -(-sum(lengths.values()) // BUCKET_ROWS))
    rows = pieces.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = rows.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    in_bucket = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*order)) - 1
    ranked = rows.withColumn("in_bucket", in_bucket).join(starts, ["length", "bucket"])
    ranked = ranked.select(*pieces.columns, (F.col("first") + F.col("in_bucket")).alias("rank"))

    names = list(pieces.columns)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, first, offset = plan.value
        for batch in batches:
            length, rank = (batch.column(n).to_numpy() for n in ("length", "rank"))
            at = np.searchsorted(keys, length << 40 | rank, side="right") - 1
            sequence = first[at] + rank - (keys[at] & ((1 << 40) - 1))
            columns = [batch.column(n) for n in names]
            columns += [pa.array(sequence), pa.array(offset[at])]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(locate, f"{schema}, sequence_id bigint, offset bigint")


def packed_sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, keys, ids): the sequences themselves, each of at most the packing's capacity."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "key", "ids")))
    grouped = placed.groupBy("sequence_id").agg(parts.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    return grouped.select("sequence_id", F.col("parts.key").alias("keys"), joined.alias("ids"))


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """The placed pieces of all documents, without their ids."""
    pieces = written(token_pieces(docs, tokenizer_path, end_id, capacity, with_ids=False), "pieces")
    placed = place_pieces(pieces, capacity)
    columns = ("piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    return placed.select(F.col("key").alias("doc_id"), *columns)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places of all documents' pieces; cases as the module states them."""
    import public_tokenizers

    return pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
