"""Modified Kneser-Ney models of characters, one for each of any number of models, counted by Spark.

A text is its UTF-16 units: one for each character, two for those beyond U+FFFF. A gram is ``ORDER``
units, packed exactly into 64 bits, the predicted one last; U+FFFF stands before a text and after it.

Spark does the whole estimate by grouping and joins. Grams are counted in the tasks and summed; those
of texts that are only to be scored count 0. Each shorter order counts in how many learnt grams of
the next longer one a gram is the end; counts of counts give each model and order its three
discounts; a window over a context's grams, at most 65,536, gives its total and what discounting
leaves to the shorter context, all of it where nothing was learnt; one join for each order adds the
shorter context's probability. The result is a table of (model, code, log) with every gram that the
texts hold. It grows with the texts.

To be looked up the table is arrays sorted by the hash of (model, gram): ``GramTable`` if it fits a
stated size, else joined to the distinct grams of chunks of texts (``joined_sums``). Logarithms are
whole numbers of ``LOG_UNIT``, so that neither way nor order changes a sum by a bit.

Cases: a null or empty text has one gram, its end; ill-formed UTF-8 counts as U+FFFD; no texts give
an empty table; repeated rows count each, so callers leave out copies. A model that learnt nothing
gives every unit the same probability.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from engagement_lake.llm.store import given_back, written
from engagement_lake.llm.units import HASHED_BYTES, freed, give_back, slices, text_bytes
from engagement_lake.llm.words import mixed

ORDER = 4
UNIT_BITS = 16
EDGE = 0xFFFF
LOG_UNIT = 2.0**-22
LEAST_DISCOUNT, GREATEST_SHARE = 0.05, 0.95
# Distinct grams that a task holds before it hands them on.
HELD_GRAMS = 1 << 20
CHUNK_BYTES = 12 << 20
# A row of a GramTable: hash and logarithm.
ROW_BYTES = 12


def utf16_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-16 units of all texts one after another, and the n + 1 offsets of the texts."""
    try:
        units = np.frombuffer(str(data, "utf-8").encode("utf-16-le"), np.uint16)
    except UnicodeDecodeError:
        texts = [
            np.frombuffer(str(data[a:b], "utf-8", "replace").encode("utf-16-le"), np.uint16)
            for a, b in zip(offsets[:-1], offsets[1:])
        ]
        return np.concatenate(texts), np.r_[0, np.cumsum([len(t) for t in texts])]
    made = ((data & 0xC0) != 0x80).astype(np.int8) + (data >= 0xF0)
    return units, np.r_[0, np.cumsum(made, dtype=np.int64)][offsets]


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all grams of the texts, and the n + 1 offsets of the texts."""
    units, offsets = utf16_units(data, offsets)
    n, lengths = len(offsets) - 1, np.diff(offsets)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    symbols = np.full(len(units) + n * ORDER, EDGE, np.uint64)
    symbols[np.arange(len(units)) + np.repeat(np.arange(1, n + 1) * ORDER - 1, lengths)] = units
    codes = np.zeros(len(symbols) - ORDER + 1, np.uint64)
    for i in range(ORDER):
        codes = codes << np.uint64(UNIT_BITS) | symbols[i : i + len(codes)]
    # Between two texts lie ORDER - 1 runs of units that belong to both.
    own = np.ones(len(codes), bool)
    between = (offsets[1:-1] + np.arange(1, n) * ORDER)[:, None] - np.arange(1, ORDER)
    own[between.ravel()] = False
    return codes[own], np.r_[0, np.cumsum(lengths + 1)]


def _counted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, first)


def all_texts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.ones(len(offsets) - 1, bool)


def count_grams(texts: DataFrame, learns: Callable = all_texts) -> DataFrame:
    """(model, code, n) over all (model bigint, text) rows; ``n`` counts the texts that ``learns`` chooses."""

    def hand_on(held: dict[int, list]) -> Iterator[pa.RecordBatch]:
        for model, parts in held.items():
            codes, counts = _counted(parts)
            columns = [pa.array(np.full(len(codes), model)), pa.array(codes.view(np.int64)), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(columns, names=["model", "code", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        size = 0
        for batch in batches:
            for rows in slices(batch.sort_by("model"), "text", HASHED_BYTES):
                data, offsets = text_bytes(rows.column("text"))
                codes, ends = grams(data, offsets)
                learnt = np.repeat(learns(data, offsets), np.diff(ends))
                models, first = np.unique(rows.column("model").to_numpy(), return_index=True)
                for model, begin, end in zip(models.tolist(), first, [*first[1:], rows.num_rows]):
                    of = slice(ends[begin], ends[end])
                    for chosen in (True, False):
                        found, n = np.unique(codes[of][learnt[of] == chosen], return_counts=True)
                        held.setdefault(model, []).append((found, n * chosen))
                        size += len(found)
            if size > HELD_GRAMS:
                held = {model: [_counted(parts)] for model, parts in held.items()}
                size = sum(len(parts[0][0]) for parts in held.values())
            if size > HELD_GRAMS // 2:
                yield from hand_on(held)
                held, size = {}, 0
        yield from hand_on(held)

    counted = texts.select("model", "text").mapInArrow(freed(count), "model bigint, code bigint, n bigint")
    return counted.groupBy("model", "code").agg(F.sum("n").alias("n"))


def _ending(code: str, width: int):
    """The last ``width`` units of a code."""
    return F.col(code).bitwiseAND(F.lit((1 << UNIT_BITS * width) - 1))


def all_orders(counts: DataFrame) -> DataFrame:
    """(width, model, code, n): the grams with their counts, and all shorter ones with their kinds of past."""
    levels = [counts.select("model", "code", "n")]
    for width in range(ORDER - 1, 0, -1):
        shorter = levels[-1].groupBy("model", _ending("code", width).alias("code"))
        levels.append(shorter.agg(F.count_if(F.col("n") > 0).alias("n")))
    whole = None
    for width, level in zip(range(ORDER, 0, -1), levels):
        level = level.withColumn("width", F.lit(width))
        whole = level if whole is None else whole.unionByName(level)
    return whole


def discounts(orders: DataFrame) -> DataFrame:
    """(width, model, d1, d2, d3): what is taken off a count of one, of two, and of more."""
    tally = orders.groupBy("width", "model").agg(
        *[F.greatest(F.count_if(F.col("n") == k), F.lit(1)).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)]
    )
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    found = {k: k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}") for k in (1, 2, 3)}
    bounded = [
        F.least(F.greatest(d, F.lit(LEAST_DISCOUNT)), F.lit(GREATEST_SHARE * k)).alias(f"d{k}")
        for k, d in found.items()
    ]
    return tally.select("width", "model", *bounded)


def _shares(orders: DataFrame, off: DataFrame, width: int) -> DataFrame:
    """(model, code, share, rest): a gram's discounted share of its context, and the context's remainder."""
    context = F.shiftrightunsigned("code", UNIT_BITS) if width > 1 else F.lit(0)
    of = orders.where(F.col("width") == width).select("model", "code", "n", context.alias("context"))
    group = Window.partitionBy("model", "context")
    n = F.col("n")
    counted = of.select(
        "model",
        "code",
        "n",
        F.sum("n").over(group).alias("total"),
        F.count_if(n == 1).over(group).alias("ones"),
        F.count_if(n == 2).over(group).alias("twos"),
        F.count_if(n > 2).over(group).alias("more"),
    )
    # One row for each model: Spark broadcasts it by its size, or splits a hot model of the join.
    joined = counted.join(off.where(F.col("width") == width).drop("width"), "model")
    taken = F.when(n == 0, 0.0).when(n == 1, F.col("d1")).when(n == 2, F.col("d2")).otherwise(F.col("d3"))
    left = F.col("d1") * F.col("ones") + F.col("d2") * F.col("twos") + F.col("d3") * F.col("more")
    known = F.col("total") > 0
    share, rest = F.when(known, (n - taken) / F.col("total")), F.when(known, left / F.col("total"))
    return joined.select(
        "model", "code", F.coalesce(share, F.lit(0.0)).alias("share"), F.coalesce(rest, F.lit(1.0)).alias("rest")
    )


def kneser_ney(texts: DataFrame, learns: Callable = all_texts) -> DataFrame:
    """(model, code, log) of every gram of the (model, text) rows; log is in units of ``LOG_UNIT``."""
    counts = written(count_grams(texts, learns), "gram-counts")
    orders = written(all_orders(counts), "gram-orders")
    given_back(counts)
    off = written(discounts(orders), "gram-discounts")
    lower = None
    for width in range(1, ORDER + 1):
        shares = _shares(orders, off, width)
        if lower is None:
            below = F.lit(2.0**-UNIT_BITS)
        else:
            shares = shares.withColumn("ending", _ending("code", width - 1))
            shares = shares.join(lower.select("model", F.col("code").alias("ending"), "p"), ["model", "ending"])
            below = F.col("p")
        lower = shares.select("model", "code", (F.col("share") + F.col("rest") * below).alias("p"))
    logs = F.round(F.log("p") / LOG_UNIT).cast("int").alias("log")
    table = written(lower.select("model", "code", logs), "gram-logs")
    given_back(orders, off)
    return table


class GramTable:
    """The logarithms of a bounded table, in arrays sorted by the hash of (model, gram)."""

    def __init__(self, table: pa.Table):
        keys = _hashes(table.column("model").to_numpy(), table.column("code").to_numpy().view(np.uint64))
        order = np.argsort(keys)
        self.keys, self.logs = keys[order], table.column("log").to_numpy().astype(np.int32)[order]

    def look_up(self, models: np.ndarray, codes: np.ndarray) -> np.ndarray:
        wanted = _hashes(models, codes)
        at = np.searchsorted(self.keys, wanted)
        if len(wanted) and (at[-1] == len(self.keys) or (self.keys[np.minimum(at, len(self.keys) - 1)] != wanted).any()):
            raise KeyError("a gram that was not counted")
        return self.logs[at]


def _hashes(models: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return mixed(codes + mixed(models.view(np.uint64)))


def log_sums(rows: pa.RecordBatch, look_up) -> tuple[np.ndarray, np.ndarray]:
    """Each text's sum of logarithms and its number of grams."""
    codes, ends = grams(*text_bytes(rows.column("text")))
    models = np.repeat(rows.column("model").to_numpy(), np.diff(ends))
    logs = look_up(models, codes)
    return np.diff(np.r_[0, np.cumsum(logs, dtype=np.int64)][ends]), np.diff(ends)


_SUMS = "model bigint, text_id binary, log_sum bigint, n_grams bigint"


def joined_sums(texts: DataFrame, table: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(model, text_id, log_sum, n_grams) of distinct (model, text_id, text) rows, for a table of any size.

    Texts are dealt into chunks of about so many bytes; each chunk lists its distinct grams, a join finds
    their logarithms, and the chunk's texts are scored from these. A gram that all chunks hold has one row
    for each of them in the join, which Spark splits like any hot key.
    """
    volume = texts.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0)).alias("bytes")).head()["bytes"]
    chunk = F.pmod(F.xxhash64("model", "text_id"), F.lit(max(1, -(-volume // chunk_bytes))))
    dealt = texts.select("model", "text_id", "text", chunk.alias("chunk")).repartition("chunk")

    def list_grams(key: tuple, table: pa.Table) -> pa.Table:
        held: dict[int, list] = {}
        for batch in table.sort_by("model").combine_chunks().to_batches():
            for rows in slices(batch, "text", HASHED_BYTES):
                codes, ends = grams(*text_bytes(rows.column("text")))
                models, first = np.unique(rows.column("model").to_numpy(), return_index=True)
                for model, begin, end in zip(models.tolist(), first, [*first[1:], rows.num_rows]):
                    held.setdefault(model, []).append(np.unique(codes[ends[begin] : ends[end]]))
        distinct = {model: np.unique(np.concatenate(parts)) for model, parts in held.items()}
        give_back()
        return pa.table(
            {
                "chunk": pa.array(np.full(sum(map(len, distinct.values())), key[0].as_py())),
                "model": pa.array(np.repeat(list(distinct), [len(c) for c in distinct.values()])),
                "code": pa.array(np.concatenate(list(distinct.values())).view(np.int64)),
            }
        )

    listed = dealt.groupBy("chunk").applyInArrow(list_grams, "chunk bigint, model bigint, code bigint")
    found = listed.join(table, ["model", "code"]).select("chunk", "model", "code", "log")

    def score(texts: pa.Table, found: pa.Table) -> pa.Table:
        known = GramTable(found)
        out = []
        for batch in texts.combine_chunks().to_batches():
            for rows in slices(batch, "text", HASHED_BYTES):
                sums, n = log_sums(rows, known.look_up)
                columns = [rows.column("model"), rows.column("text_id"), pa.array(sums), pa.array(n)]
                out.append(pa.RecordBatch.from_arrays(columns, names=["model", "text_id", "log_sum", "n_grams"]))
        give_back()
        return pa.Table.from_batches(out)

    return dealt.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(score, _SUMS)
