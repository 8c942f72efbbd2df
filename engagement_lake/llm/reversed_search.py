"""Ranked lexical search the other way round: documents stream through an index of the items.

The items' terms make a small inverted index, broadcast block by block. One pass over the documents
counts the index's terms in each; the counts give document frequencies and lengths, from which the
index gets its weights. A second pass streams the counts through the index. Every task holds one
bounded heap per item; the heaps are merged in two steps.

Blocks: items are dealt into as many blocks as it takes for each to hold at most ``BLOCK_TERMS``
distinct (item, term) entries; an item of more stands alone. Every block sees every document.

Cases: a null or empty text has no term; such an item has no results and such a document is counted
nowhere. Each row of items is an item of its own, and each row of documents a document of its own,
even if ids repeat; a null document id comes after all others among equal scores. An empty table
gives no rows. Other columns are left out, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from engagement_lake.llm.store import read, written
from engagement_lake.llm.units import freed, slices, text_bytes
from engagement_lake.llm.words import lowered

BLOCK_TERMS = 1 << 18
# Scores held at once: documents by items.
CELLS = 1 << 20
# Heaps of so many groups of tasks are merged first, then those.
MERGES = 64
# Sums of whole numbers in doubles are exact below this.
_EXACT = 1 << 53

TERM = np.zeros(256, bool)
TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of all texts one after another, and the number of each text."""
    data, offsets = text_bytes(texts)
    solid = TERM[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    begins = offsets[:-1][np.diff(offsets) > 0]
    first[begins] = solid[begins]  # no term spans two texts
    counts = np.diff(np.r_[0, np.cumsum(first, dtype=np.int64)][offsets])
    kept = np.ascontiguousarray(lowered(data[solid]))
    ends = np.r_[np.flatnonzero(first[solid]), len(kept)].astype(np.int64)
    terms = pa.Array.from_buffers(
        pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(kept)]
    )
    return terms, counts


def _counted(owner: np.ndarray, term: np.ndarray, n_owners: int, n_terms: int):
    """Distinct (owner, term) pairs in order, their counts, and the number of pairs of each owner."""
    pairs, counts = np.unique(owner * n_terms + term, return_counts=True)
    of = pairs // max(n_terms, 1)
    return pairs - of * n_terms, counts, np.bincount(of, minlength=n_owners)


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)], pa.int32()), pa.array(values, pa.int32()))


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item, place, term, times): the items' distinct terms; ``place`` tells rows apart."""
    kind = items.schema[key].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "value"):
                terms, counts = terms_of(part.column("value"))
                coded = terms.dictionary_encode()
                of = np.repeat(np.arange(part.num_rows), counts)
                found, times, each = _counted(of, coded.indices.to_numpy(), part.num_rows, len(coded.dictionary))
                rows = np.repeat(np.arange(part.num_rows), each)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("item").take(pa.array(rows)),
                        part.column("place").take(pa.array(rows)),
                        coded.dictionary.take(pa.array(found)).cast(pa.binary()),
                        pa.array(times, pa.int64()),
                    ],
                    names=["item", "place", "term", "times"],
                )

    rows = items.select(
        F.col(f"`{key}`").alias("item"),
        F.monotonically_increasing_id().alias("place"),
        F.col(f"`{text}`").alias("value"),
    )
    return rows.mapInArrow(freed(count), f"item {kind}, place bigint, term binary, times bigint")


def item_blocks(entries: DataFrame) -> list[DataFrame]:
    """The entries in blocks of whole items, each of at most ``BLOCK_TERMS`` entries or one item."""
    n_blocks = 1
    while True:
        block = F.pmod(F.xxhash64("place"), F.lit(n_blocks))
        sizes = entries.groupBy(block.alias("block")).agg(
            F.count(F.lit(1)).alias("entries"), F.min("place").alias("least"), F.max("place").alias("most")
        )
        if sizes.where(f"entries > {BLOCK_TERMS} AND least < most").isEmpty():
            return [entries.where(block == b) for b in range(n_blocks)]
        n_blocks *= 2


def document_terms(docs: DataFrame, vocabulary: pa.Array, key: str, text: str) -> DataFrame:
    """(doc, n, terms, counts): a document's length in terms and its counts of the vocabulary's."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "value"):
                terms, lengths = terms_of(part.column("value"))
                place = pc.fill_null(pc.index_in(terms, value_set=known.value), -1).to_numpy(zero_copy_only=False)
                hit = place >= 0
                of = np.repeat(np.arange(part.num_rows), lengths)[hit]
                found, times, each = _counted(of, place[hit].astype(np.int64), part.num_rows, len(known.value))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc"),
                        pa.array(lengths, pa.int64()),
                        _lists(found, each),
                        _lists(times, each),
                    ],
                    names=["doc", "n", "terms", "counts"],
                )

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("value"))
    return rows.mapInArrow(freed(count), "doc bigint, n bigint, terms array<int>, counts array<int>")


class ItemIndex:
    """Term weights and, for each term, the items that hold it and how often."""

    def __init__(self, places: np.ndarray, items: np.ndarray, terms: np.ndarray, times: np.ndarray,
                 df: np.ndarray, n_docs: int, n_terms: int):
        self.places, self.n_docs, self.n_terms = places, n_docs, n_terms
        self.weights = np.array(
            [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64
        )
        order = np.lexsort((items, terms))
        self.items, self.times = items[order], times[order]
        self.starts = np.searchsorted(terms[order], np.arange(len(df) + 1))
        most = np.bincount(items, weights=times, minlength=1).max()
        self.exact_in_doubles = most * max(self.weights.max(initial=0), 1) * 1e6 < _EXACT

    def scores(self, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Scores of documents of lengths ``n`` by items; ``doc`` is each count's place in ``n``."""
        m = 75 + (25 * n * self.n_docs) // max(self.n_terms, 1)
        value = self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
        first, width = self.starts[term], np.diff(self.starts)[term]
        at = np.repeat(first - np.cumsum(width) + width, width) + np.arange(width.sum())
        cells = np.repeat(doc, width) * len(self.places) + self.items[at]
        parts = np.repeat(value, width) * self.times[at]
        size = len(n) * len(self.places)
        if self.exact_in_doubles:
            flat = np.bincount(cells, weights=parts, minlength=size).astype(np.int64)
        else:
            flat = np.zeros(size, np.int64)
            np.add.at(flat, cells, parts)
        return flat.reshape(len(n), len(self.places))


class Heaps:
    """The best ``k`` documents of every item so far, ties to the smaller id, null ids last."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.item = self.score = self.doc = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)
        self.least = np.ones(n_items, np.int64)  # a score must be above 0
        self.worst = np.full(n_items, np.iinfo(np.int64).max)

    def add(self, scores: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        near = scores >= self.least
        rows, items = np.nonzero(near)
        value = scores[rows, items]
        able = (value > self.least[items]) | (doc[rows] <= self.worst[items])
        rows, items, value = rows[able], items[able], value[able]
        if not len(rows):
            return
        item = np.r_[self.item, items]
        score, ids, none = np.r_[self.score, value], np.r_[self.doc, doc[rows]], np.r_[self.null, null[rows]]
        order = np.lexsort((ids, none, -score, item))
        rank = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        order = order[rank < self.k]
        self.item, self.score, self.doc, self.null = item[order], score[order], ids[order], none[order]
        full = np.flatnonzero(rank[rank < self.k] == self.k - 1)
        self.least[self.item[full]] = self.score[full]
        self.worst[self.item[full]] = np.where(self.null[full], np.iinfo(np.int64).max, self.doc[full])


def search_block(postings: DataFrame, index: ItemIndex, k: int) -> DataFrame:
    """(place, doc, score): every item's best documents, merged from the tasks' heaps."""
    shared = postings.sparkSession.sparkContext.broadcast(index)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        heaps = Heaps(len(index.places), k)
        rows = max(CELLS // len(index.places), 1)
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                counted = part.column("terms")
                lengths = pc.list_value_length(counted).to_numpy(zero_copy_only=False)
                of = np.repeat(np.arange(part.num_rows), lengths)
                scores = index.scores(
                    part.column("n").to_numpy(),
                    of,
                    counted.flatten().to_numpy(),
                    part.column("counts").flatten().to_numpy().astype(np.int64),
                )
                doc = part.column("doc")
                null = doc.is_null().to_numpy(zero_copy_only=False)
                heaps.add(scores, pc.fill_null(doc, np.iinfo(np.int64).max).to_numpy(), null)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(index.places[heaps.item], pa.int64()),
                pa.array(heaps.doc, pa.int64(), mask=heaps.null),
                pa.array(heaps.score, pa.int64()),
            ],
            names=["place", "doc", "score"],
        )

    heaps = postings.mapInArrow(freed(best), "place bigint, doc bigint, score bigint")
    order = [F.desc("score"), F.asc_nulls_last("doc")]
    some = heaps.withColumn("merge", F.spark_partition_id() % MERGES)
    for keys in (["place", "merge"], ["place"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        some = some.withColumn("rank", rank).where(F.col("rank") <= k)
    return some.drop("merge")


def reversed_search(
    items: DataFrame,
    docs: DataFrame,
    k: int,
    item_key: str = "item_id",
    item_text: str = "text",
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(item, place, rank, doc, score): the ``k`` best documents of every item, scores above 0.

    Document keys must be whole numbers. ``place`` tells items of one id apart.
    """
    entries = written(item_terms(items, item_key, item_text), "items")
    names = entries.select("place", "item").distinct()
    found = None
    for block in item_blocks(entries):
        listed = block.select("place", "term", "times").toArrow().combine_chunks()
        if not listed.num_rows:
            continue
        places, item = np.unique(listed.column("place").to_numpy(), return_inverse=True)
        coded = listed.column("term").combine_chunks().cast(pa.large_binary()).dictionary_encode()
        postings = written(document_terms(docs, coded.dictionary, key, text), "postings")
        n_docs, n_terms = postings.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).head()
        holders = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        holders = holders.toArrow()  # no more rows than the block has terms
        df = np.zeros(len(coded.dictionary), np.int64)
        df[holders.column("term").to_numpy()] = holders.column("df").to_numpy()
        index = ItemIndex(
            places, item, coded.indices.to_numpy(), listed.column("times").to_numpy(), df, n_docs, n_terms
        )
        best = search_block(postings, index, k)
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = entries.sparkSession.createDataFrame([], "place bigint, doc bigint, score bigint, rank int")
    return found.join(names, "place").select("item", "place", "rank", "doc", "score")


def op11_reversed_search(spark, sf_dir: str) -> DataFrame:
    """Every benchmark item's 20 best documents; cases as the module states them."""
    items, docs = read(spark, sf_dir, "benchmark"), read(spark, sf_dir, "documents")
    return reversed_search(items, docs, 20).select(
        F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score"
    )


# Terms of more than ASCII go into the pattern as they are; only A-Z is lower-cased.
ORACLE = r"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), counts AS (
    SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL
), lengths AS (
    SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY doc_id
), corpus AS (
    SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM lengths
), asked AS (
    SELECT item_id, term, count(*) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark)
    GROUP BY ALL
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counts, corpus WHERE term IN (SELECT term FROM asked) GROUP BY term, n_docs
), scored AS (
    SELECT item_id, c.doc_id, CAST(sum(times * w * ((1000000000 * tf)
        // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM counts c JOIN asked USING (term) JOIN weights USING (term)
    JOIN lengths l ON c.doc_id = l.doc_id, corpus
    GROUP BY item_id, c.doc_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""
