"""Token ids of documents in files: one concatenated id array per block, boundaries in Elias-Fano.

A file row is a block: the ids of consecutive documents as little-endian integers of 2 or 4 bytes,
the document keys, and the ends of the documents in that array as an Elias-Fano sequence. Blocks
are ordered by (part, block); offsets across blocks are sums of the blocks' lengths, so no table of
64-bit offsets is stored. The rows are in Parquet, so that Spark's committer makes each file appear
once however often a task ran. All documents are read in one pass that decodes the boundaries; chosen
ones are fetched by their keys, their boundaries selected one by one.

Cases: a null or empty text has the end id only. Null keys come first; documents with equal keys
follow one another, ordered by their text's hash. An empty table gives a readable, empty file.
Other columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from engagement_lake.llm.elias_fano import EliasFano
from engagement_lake.llm.store import read, scratch_path
from engagement_lake.llm.units import library_tokenizer, slices, stretches

# Ids after which a block ends; its last document is never cut.
BLOCK_IDS = 1 << 20

_BLOCK = (
    "part int, block int, n_ids bigint, width int, ids binary, keys array<{key}>,"
    " n_ends int, low_bits int, low binary, high binary, samples binary"
)
_NAMES = [field.split()[0] for field in _BLOCK.split(", ")]


def write_tokens(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int, key: str = "doc_id", text: str = "text"
) -> None:
    """Encode every text, close it with ``end_id``, and write all in ascending key order.

    Texts are range-partitioned and sorted before they are encoded, so a task encodes and writes
    in one stream and holds one block. Equal keys are spread by the hash of their text.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = library_tokenizer(definition.value)
        width = 2 if max(tokenizer.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        part, block = TaskContext.get().partitionId(), 0
        keys, lengths, ids = [], [], []

        def close() -> pa.RecordBatch:
            counts = np.concatenate(lengths)
            ends = EliasFano.encode(np.cumsum(counts))
            row = [
                [part], [block], [int(counts.sum())], [width],
                [np.concatenate(ids).astype(f"<u{width}").tobytes()],
                pa.ListArray.from_arrays([0, len(counts)], pa.concat_arrays(keys)),
                [ends.count], [ends.low_bits], [ends.low], [ends.high], [ends.samples],
            ]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), None]
            kinds += [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            arrays = [x if kind is None else pa.array(x, kind) for x, kind in zip(row, kinds)]
            return pa.RecordBatch.from_arrays(arrays, names=_NAMES)

        for batch in batches:
            for rows in slices(batch, "text"):
                counts, found = tokenizer(rows.column("text"))
                closed = np.insert(found, np.cumsum(counts), end_id)
                keys.append(rows.column("key"))
                lengths.append(counts + 1)
                ids.append(closed)
                if sum(map(len, ids)) >= BLOCK_IDS:
                    yield close()
                    keys, lengths, ids, block = [], [], [], block + 1
        if keys:
            yield close()

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text")]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    kind = rows.schema["key"].dataType.simpleString()
    sorted_rows.mapInArrow(encode, _BLOCK.format(key=kind)).write.parquet(path)


def _boundaries(row: dict) -> EliasFano:
    return EliasFano(*(row[n].as_py() for n in ("n_ends", "low_bits", "low", "high", "samples")))


def read_tokens(spark: SparkSession, path: str, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """(key, start, n_tokens, ids_crc32[, ids]) of every document in the files.

    ``start`` counts the ids of all documents before; ``ids`` are 32-bit little-endian bytes.
    """
    blocks = spark.read.parquet(path)
    kind = blocks.schema["keys"].dataType.elementType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                ends = _boundaries(row).values()
                counts = np.diff(ends, prepend=0)
                ids = np.frombuffer(row["ids"].as_buffer(), f"<u{row['width'].as_py()}")
                parts = stretches(ids, counts)
                n = len(ends)
                columns = [
                    pa.array(np.full(n, row["part"].as_py(), np.int32)),
                    pa.array(np.full(n, row["block"].as_py(), np.int32)),
                    row["keys"].values,
                    pa.array(ends - counts),
                    pa.array(counts),
                    pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                ]
                names = ["part", "block", "key", "begin", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([p.tobytes() for p in parts], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"part int, block int, key {kind}, begin bigint, n_tokens bigint, ids_crc32 bigint"
    documents = blocks.mapInArrow(decode, schema + (", ids binary" if with_ids else ""))

    return _placed(documents, blocks, key, with_ids)


def fetch_tokens(spark: SparkSession, path: str, wanted: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32, ids) of the documents that the ``wanted`` rows name by ``key``.

    Blocks are found by their keys alone; only those that hold a wanted document are read, and there its
    begin and end are selected from the Elias-Fano sequence, which is not decoded. A key of several documents
    gives them all, one of none gives nothing; repeated and null keys are asked for once.
    """
    blocks = spark.read.parquet(path)
    kind = blocks.schema["keys"].dataType.elementType.simpleString()
    asked = wanted.select(F.col(key).cast(kind).alias("asked")).distinct()
    held = blocks.select("part", "block", F.posexplode("keys").alias("at", "key"))
    held = held.join(asked, held["key"].eqNullSafe(asked["asked"]), "left_semi")
    # At most as many places as the block has documents.
    places = held.groupBy("part", "block").agg(F.sort_array(F.collect_list("at")).alias("places"))

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                ends = _boundaries(row)
                at = row["places"].values.to_numpy()
                begin = np.array([ends.select(x - 1) if x else 0 for x in at.tolist()], np.int64)
                end = np.array([ends.select(x) for x in at.tolist()], np.int64)
                ids = np.frombuffer(row["ids"].as_buffer(), f"<u{row['width'].as_py()}")
                parts = [ids[a:b].astype("<u4").tobytes() for a, b in zip(begin.tolist(), end.tolist())]
                columns = [
                    pa.array(np.full(len(at), row["part"].as_py(), np.int32)),
                    pa.array(np.full(len(at), row["block"].as_py(), np.int32)),
                    row["keys"].values.take(pa.array(at)),
                    pa.array(begin),
                    pa.array(end - begin),
                    pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                    pa.array(parts, pa.binary()),
                ]
                names = ["part", "block", "key", "begin", "n_tokens", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"part int, block int, key {kind}, begin bigint, n_tokens bigint, ids_crc32 bigint, ids binary"
    found = blocks.join(places, ["part", "block"]).mapInArrow(select, schema)
    return _placed(found, blocks, key, True)


def _placed(documents: DataFrame, blocks: DataFrame, key: str, with_ids: bool) -> DataFrame:
    """The documents with ``start``, their place in all files, for ``begin``, that in their block."""
    # Offsets of parts are summed over one row a part, those of blocks within their part.
    lengths = blocks.select("part", "block", "n_ids")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = lengths.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    parts = parts.select("part", F.sum("n_ids").over(before.orderBy("part")).alias("part_start"))
    in_part = before.partitionBy("part").orderBy("block")
    starts = lengths.withColumn("block_start", F.sum("n_ids").over(in_part)).join(parts, "part")
    base = F.coalesce("part_start", F.lit(0)) + F.coalesce("block_start", F.lit(0))
    starts = starts.select("part", "block", base.alias("base"))
    return documents.join(starts, ["part", "block"]).select(
        F.col("key").alias(key),
        (F.col("base") + F.col("begin")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *(["ids"] if with_ids else []),
    )


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents into files in the shared folder and return what the files hold."""
    import public_tokenizers

    path = scratch_path(spark, "token-files")
    documents = read(spark, sf_dir, "documents")
    write_tokens(documents, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return read_tokens(spark, path)
