"""Scoring texts by prediction by partial matching over bytes, pretrained on a part of the documents.

The model codes a text's bytes and then its end. Each symbol is sought in the longest context seen
in training, of at most ``ORDER`` bytes; a context that lacks it spends an escape (as likely as the
context has distinct symbols) and passes to the next shorter one, in which the symbols just seen
are excluded. What no context has is shared evenly among the symbols left.

The trie of contexts is never held whole. A symbol's probability depends on its gram, the context
with the symbol. Documents are dealt into chunks of bounded size; each chunk lists its distinct
grams with their training counts; grams are partitioned by the context's last three bytes, where
contexts of three bytes and more stand as ranges of a sorted array, from the nearest byte to the
farthest; every chunk gets back the probabilities of its own grams. Shorter contexts have at most
256 * 256 * 257 counts and are broadcast. Words are counted the same way for the base score.

Texts are scored with A-Z lowered, white-space runs as one space, and none at the ends: one text for
each sequence of tokens. Probabilities are those of that text.

Cases: a null or empty text is its end alone; a null key trains; repeated rows are learnt and scored
each; other columns are left out. Without training rows all symbols are equally likely. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from engagement_lake.llm.store import read, written
from engagement_lake.llm.units import HASHED_BYTES, give_back, slices, text_bytes
from engagement_lake.llm.words import WHITE, lowered, per_text, span_hashes, word_spans

ORDER = 5
SHORT = 2
SYMBOLS = 257
END = 256
# Stands before a text; no byte of UTF-8.
START = 0xFF
CHUNK_BYTES = 12 << 20
PARTITION_BYTES = 8 << 20
# Keys gathered before they are summed up, and rows of a batch handed to the JVM.
GATHERED, BATCH_ROWS = 1 << 20, 1 << 17
GRAM, WORD = 0, 1
_END_WORD = np.int64(-1)


def plain(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts lowered, with one space between words and none elsewhere."""
    begins, ends = word_spans(data, offsets)
    keep = ~WHITE[data]
    n_words = np.diff(np.searchsorted(begins, offsets))
    last = np.zeros(len(begins), bool)
    last[np.cumsum(n_words)[n_words > 0] - 1] = True
    spaces = ends[~last]  # the white byte after each word but a text's last
    keep[spaces] = True
    data = lowered(data)
    data[spaces] = 0x20
    return data[keep], np.r_[0, np.cumsum(per_text(keep, offsets))]


def grams(data: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Codes of (context from nearest to farthest byte, symbol), and the n + 1 offsets of the texts."""
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    starts = offsets[:-1] + np.arange(n) * (order + 1)
    symbols = np.full(len(data) + n * (order + 1), START, np.int64)
    at = np.arange(len(data)) + np.repeat((np.arange(n) + 1) * (order + 1) - 1, lengths)
    symbols[at] = data
    symbols[starts + order + lengths] = END
    coded = np.ones(len(symbols), bool)
    coded[(starts[:, None] + np.arange(order)).ravel()] = False
    place = np.flatnonzero(coded)
    code = np.zeros(len(place), np.int64)
    for back in range(1, order + 1):
        code = code << 8 | symbols[place - back]
    return code << 9 | symbols[place], np.r_[0, np.cumsum(lengths + 1)]


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each wanted key, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Contexts:
    """All contexts of one length with their symbols: sorted arrays of (context, symbol) counts."""

    def __init__(self, edges: np.ndarray, counts: np.ndarray):
        self.edges, self.counts = edges, counts.astype(np.float64)
        nodes, first = np.unique(edges >> 9, return_index=True)
        self.nodes = nodes
        self.total = np.add.reduceat(self.counts, first) if len(first) else np.zeros(0)
        self.distinct = np.diff(np.r_[first, len(edges)]).astype(np.float64)
        self.first = first

    def shorter(self) -> Contexts:
        """The contexts without their farthest byte."""
        edges = self.edges >> 17 << 9 | self.edges & 511
        return Contexts(*_summed(edges, self.counts))

    def taken_from(self, parent: Contexts) -> np.ndarray:
        """For each context, how often its symbols occur in the context one byte shorter."""
        edges = self.edges >> 17 << 9 | self.edges & 511
        at, there = _find(parent.edges, edges)
        found = np.where(there, parent.counts[at], 0.0) if len(parent.edges) else np.zeros(len(edges))
        return np.add.reduceat(found, self.first) if len(self.first) else np.zeros(0)


def log_probabilities(wanted: np.ndarray, levels: list[Contexts], order: int = ORDER) -> np.ndarray:
    """log10 of the probability of each gram; ``levels`` are contexts of length ``order`` down to 0."""
    done = np.zeros(len(wanted), bool)
    log = np.zeros(len(wanted))
    symbol = wanted & 511
    # What the longer context has already ruled out: its number of symbols, and their count here.
    ruled, ruled_count = np.zeros(len(wanted)), np.zeros(len(wanted))
    for depth, level in enumerate(levels):
        context = wanted >> 9 + 8 * depth
        node, seen = _find(level.nodes, context)
        if not len(level.nodes):
            continue
        edge, has = _find(level.edges, context << 9 | symbol)
        left = np.where(seen, level.total[node] - ruled_count, 0.0)
        new = np.where(seen, level.distinct[node] - ruled, 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            hit = np.log10(level.counts[edge] / (left + new))
            escape = np.where(new > 0, np.log10(new / (left + new)), 0.0)
        log += np.where(done, 0.0, np.where(has, hit, escape))
        done |= has
        ruled = np.where(seen, level.distinct[node], 0.0)
        if depth + 1 < len(levels):
            taken = level.taken_from(levels[depth + 1])
            ruled_count = np.where(seen, taken[node], 0.0)
    return log - np.where(done, 0.0, np.log10(np.maximum(1.0, SYMBOLS - ruled)))


def levels_of(codes: np.ndarray, counts: np.ndarray, order: int = ORDER) -> list[Contexts]:
    """Contexts of length ``order`` down to 0 from the counts of grams."""
    levels = [Contexts(*_summed(codes, counts))]
    for _ in range(order):
        levels.append(levels[-1].shorter())
    return levels


def short_counts(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Training counts of all grams of ``SHORT`` bytes of context. At most 256 ** 2 * 257."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for rows in slices(batch, "text", HASHED_BYTES):
                codes, _ = grams(*plain(*text_bytes(rows.column("text"))), SHORT)
                found, n = np.unique(codes, return_counts=True)
                keys, counts = _summed(np.r_[keys, found], np.r_[counts, n])
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["code", "n"])
        give_back()

    counted = docs.where("train").select("text").mapInArrow(count, "code bigint, n bigint")
    total = counted.groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    return _summed(total["code"].to_numpy(np.int64), total["n"].to_numpy(np.int64))


class _Summing:
    """Counts by key, summed up whenever about as many keys wait as there are sums."""

    def __init__(self):
        self.parts, self.waiting, self.most = [], 0, GATHERED

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.waiting += len(keys)
        if self.waiting > self.most:
            keys, counts = self.sums()
            self.most = len(keys) + max(GATHERED, len(keys))

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = (np.concatenate(x) for x in zip(*self.parts))
        self.parts = []
        self.parts = [_summed(keys, counts)]
        self.waiting = len(self.parts[0][0])
        return self.parts[0]


def _chunk_items(table: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The distinct grams and words of a chunk, with their counts in its training rows."""
    found = {kind: _Summing() for kind in (GRAM, WORD)}
    for batch in table.combine_chunks().to_batches():
        for rows in slices(batch, "text", HASHED_BYTES):
            data, offsets = plain(*text_bytes(rows.column("text")))
            train = rows.column("train").to_numpy(zero_copy_only=False)
            codes, ends = grams(data, offsets)
            begins, stops = word_spans(data, offsets)
            words = span_hashes(data, begins, stops).view(np.int64)
            n_words = np.diff(np.searchsorted(begins, offsets))
            for kind, keys, of in (
                (GRAM, codes, np.diff(ends)),
                (WORD, np.r_[words, np.full(len(train), _END_WORD)], None),
            ):
                learnt = np.repeat(train, of) if of is not None else np.r_[np.repeat(train, n_words), train]
                distinct = np.unique(keys)
                taught, n = np.unique(keys[learnt], return_counts=True)
                counts = np.zeros(len(distinct), np.int64)
                counts[np.searchsorted(distinct, taught)] = n
                found[kind].add(distinct, counts)
    for kind in (GRAM, WORD):
        yield kind, *found.pop(kind).sums()


_ITEM = "chunk int, kind tinyint, key bigint, n bigint"
_VALUE = "chunk int, kind tinyint, key bigint, value double, owned boolean"


def _item_batches(chunk: int, items) -> pa.Table:
    columns = [[], [], [], []]
    for kind, keys, counts in items:
        for column, values in zip(
            columns, (np.full(len(keys), chunk, np.int32), np.full(len(keys), kind, np.int8), keys, counts)
        ):
            column.append(values)
    whole = pa.table([pa.array(np.concatenate(c)) for c in columns], names=["chunk", "kind", "key", "n"])
    return pa.Table.from_batches(whole.to_batches(BATCH_ROWS), whole.schema)


def score_documents(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, train, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    rows = docs.select(
        F.col(key).alias("key"), F.coalesce(train, F.lit(True)).alias("train"), F.col(text).alias("text")
    )
    short = short_counts(rows)
    sizes = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("n"))
    sizes = sizes.head()
    volume = sizes["bytes"] + 64 * sizes["n"]
    chunks, partitions = max(1, -(-volume // CHUNK_BYTES)), max(12, -(-volume // PARTITION_BYTES))
    lows = [Contexts(*short)]
    for _ in range(SHORT):
        lows.append(lows[-1].shorter())
    held = docs.sparkSession.sparkContext.broadcast(lows)

    chunk = F.pmod(F.xxhash64("key", "text"), F.lit(chunks)).cast("int")
    dealt = rows.withColumn("chunk", chunk).repartition("chunk")

    def list_items(chunk_key: tuple, table: pa.Table) -> pa.Table:
        items = _item_batches(chunk_key[0].as_py(), _chunk_items(table))
        give_back()
        return items

    items = dealt.groupBy("chunk").applyInArrow(list_items, _ITEM)
    nearest = F.shiftright("key", 9 + 8 * (ORDER - SHORT - 1))
    route = F.xxhash64(F.when(F.col("kind") == GRAM, nearest).otherwise(F.col("key")))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[batch.column(i).to_numpy() for i in range(4)] for batch in batches]
        if not parts:
            return
        chunk, kind, keys, n = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(keys, kind="stable")
        chunk, kind, keys, n = chunk[order], kind[order], keys[order], n[order]
        for k in (GRAM, WORD):
            of_kind = kind == k
            if not of_kind.any():
                continue
            mine, its_chunk = keys[of_kind], chunk[of_kind]
            distinct, total = _summed(mine, n[of_kind])
            if k == GRAM:
                levels = [Contexts(distinct[total > 0], total[total > 0])]
                while len(levels) < ORDER - SHORT:
                    levels.append(levels[-1].shorter())
                values = log_probabilities(distinct, levels + held.value)
            else:
                values = np.log10(total + 1.0)
            first = np.r_[True, mine[1:] != mine[:-1]]
            index = np.cumsum(first) - 1
            owned = first & (k == WORD) & (total[index] > 0)
            step = 1 << 18
            for i in range(0, len(mine), step):
                cut = slice(i, i + step)
                columns = [its_chunk[cut], np.full(len(mine[cut]), k, np.int8), mine[cut], values[index[cut]]]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, columns), pa.array(owned[cut])],
                    names=["chunk", "kind", "key", "value", "owned"],
                )
        give_back()

    values = items.repartition(partitions, route).mapInArrow(look_up, _VALUE)

    def score(table: pa.Table, found: pa.Table) -> pa.Table:
        kinds = found.column("kind").to_numpy()
        keys, value = found.column("key").to_numpy(), found.column("value").to_numpy()
        sets = {k: (pa.array(keys[kinds == k]), value[kinds == k]) for k in (GRAM, WORD)}
        owned = int(pc.sum(found.column("owned")).as_py() or 0)
        del kinds, keys, value

        def values_of(kind: int, wanted: np.ndarray) -> np.ndarray:
            known, logs = sets[kind]
            return logs[pc.index_in(pa.array(wanted), value_set=known).to_numpy()]

        out = []
        for batch in table.combine_chunks().to_batches():
            for rows in slices(batch, "text", HASHED_BYTES):
                data, offsets = plain(*text_bytes(rows.column("text")))
                codes, ends = grams(data, offsets)
                logs = np.diff(np.r_[0.0, np.cumsum(values_of(GRAM, codes))][ends])
                begins, stops = word_spans(data, offsets)
                word_ends = np.searchsorted(begins, offsets)
                word_logs = values_of(WORD, span_hashes(data, begins, stops).view(np.int64))
                end_log = values_of(WORD, np.array([_END_WORD]))[0]
                base = np.diff(np.r_[0.0, np.cumsum(word_logs)][word_ends]) + end_log
                n_known = np.diff(np.r_[0, np.cumsum(word_logs > 0)][word_ends]) + int(end_log > 0)
                columns = [rows.column("key"), rows.column("train"), pa.array(np.diff(word_ends) + 1)]
                columns += [pa.array(n_known), pa.array(base), pa.array(logs)]
                new = np.zeros(len(logs), np.int64)
                if not out and len(new):
                    new[0] = owned  # each training word is counted in one chunk, there once
                out.append(pa.RecordBatch.from_arrays([*columns, pa.array(new)], names=_SCORED))
        give_back()
        return pa.Table.from_batches(out)

    kind = rows.schema["key"].dataType.simpleString()
    schema = (
        f"key {kind}, train boolean, n_tokens bigint, n_known bigint, base double, score double, new_words bigint"
    )
    scored = dealt.groupBy("chunk").cogroup(values.groupBy("chunk")).applyInArrow(score, schema)
    scored = written(scored, "ppm-scores")
    whole = scored.agg(
        F.coalesce(F.sum(F.when(F.col("train"), F.col("n_tokens"))), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum("new_words"), F.lit(0)).alias("words"),
    ).head()
    even = float(np.log10(whole["tokens"] + whole["words"] + 1))
    return scored.select(
        F.col("key").alias(key),
        "train",
        "n_tokens",
        "n_known",
        F.lit(whole["tokens"]).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * even).alias("base_score"),
        "score",
    )


_SCORED = ["key", "train", "n_tokens", "n_known", "base", "score", "new_words"]


def op2_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on documents whose crc32 of the id has another remainder by 7 than 2; score all."""
    train = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
    scored = score_documents(read(spark, sf_dir, "documents"), train)
    return scored.withColumn("held_out", ~F.col("train")).drop("train")
