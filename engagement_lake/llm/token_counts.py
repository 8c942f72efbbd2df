"""Token counts of whole texts under a piece BPE model, by merging over a heap and a linked list.

Only the number of tokens is made: it is the number of initial symbols less the merges, with a
symbol that the vocabulary lacks counted by its UTF-8 bytes. No identifiers are emitted.

Cases: a null or empty text has 0 bytes and 0 tokens; special strings inside a text are ordinary
text; repeated rows are counted each; other columns are dropped except the key, whatever its type,
and may clash with nothing. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engagement_lake.llm.units import PieceCache, slices, text_bytes

SPACE = "▁"

class PieceMerges:
    """Counts tokens of a text the way the model's library does, white space escaped beforehand."""

    def __init__(self, ranks: dict[str, float]):
        self.ranks = ranks

    @classmethod
    def from_model(cls, model: bytes) -> PieceMerges:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(processor.get_piece_size())
        plain = (
            i
            for i in ids
            if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i))
        )
        return cls({processor.id_to_piece(i): -processor.get_score(i) for i in plain})

    def never_joined(self) -> np.ndarray:
        """Pairs of visible ASCII characters that are neighbours in no piece: no merge spans them."""
        parted = np.zeros((256, 256), bool)
        parted[0x21:0x7F, 0x21:0x7F] = True
        for piece in self.ranks:
            for a, b in zip(piece, piece[1:]):
                if max(a, b) < "\x7f":
                    parted[ord(a), ord(b)] = False
        return parted

    def count(self, text: str) -> int:
        """Tokens of ``text``: the adjacent pair of lowest rank merges first, the leftmost of equals."""
        ranks = self.ranks
        parts = list(text)
        last = len(parts) - 1
        following = list(range(1, last + 2))
        preceding = list(range(-1, last))
        heap = []
        for left in range(last):
            joined = parts[left] + parts[left + 1]
            if joined in ranks:
                heap.append((ranks[joined], left, left + 1, joined))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, left, right, joined = heapq.heappop(heap)
            if not parts[left] or not parts[right] or parts[left] + parts[right] != joined:
                continue  # one of the two has merged meanwhile
            merges += 1
            parts[left], parts[right] = joined, ""
            after = following[left] = following[right]
            if after <= last:
                preceding[after] = left
                wider = joined + parts[after]
                if wider in ranks:
                    heapq.heappush(heap, (ranks[wider], left, after, wider))
            before = preceding[left]
            if before >= 0:
                wider = parts[before] + joined
                if wider in ranks:
                    heapq.heappush(heap, (ranks[wider], before, left, wider))
        unknown = sum(len(p.encode()) - 1 for p in parts if p and p not in ranks)
        return len(parts) - merges + unknown


class TextCounter:
    """Token counts of texts from the counts of their distinct pieces."""

    def __init__(self, model: bytes):
        merges = PieceMerges.from_model(model)

        def count(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
            counts = [merges.count(p.replace(" ", SPACE)) for p in pieces]
            return np.asarray(counts, np.int64), np.zeros(0, np.uint32)

        self.pieces = PieceCache(count, merges.never_joined(), counts_only=True)

    def __call__(self, texts: pa.Array) -> np.ndarray:
        # The model puts a space before every text that is not empty.
        spaced = [" " + t if t else "" for t in texts.to_pylist()]
        return self.pieces.per_text(*text_bytes(pa.array(spaced, pa.string())))[0]


_COUNTERS: dict[int, TextCounter] = {}


def _counter(model: bytes) -> TextCounter:
    key = hash(model)
    if key not in _COUNTERS:
        _COUNTERS[key] = TextCounter(model)
    return _COUNTERS[key]


def token_counts(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens) of every row. One pass, no shuffle.

    ``model_path`` is read on the driver; the model file, of fixed size, travels with the tasks.
    """
    with open(model_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model.value)
        for batch in batches:
            for part in slices(batch, "value"):
                n_tokens = pa.array(counter(part.column("value").fill_null("")), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("n_bytes"), n_tokens],
                    names=["key", "n_bytes", "n_tokens"],
                )

    rows = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text).alias("value"),
    )
    kind = rows.schema["key"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"key {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumnRenamed("key", key)


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from engagement_lake.llm.store import read

    counted = token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


TOKEN_LIMIT = 4096
