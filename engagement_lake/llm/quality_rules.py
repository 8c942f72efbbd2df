"""Quality rules: surface counts of each text, and its perplexity under a modified Kneser-Ney model.

Each language has a model of its own, of grams of whole characters (``kneser_ney``), however many
languages there are. It learns each distinct text once, so that copies do not make a text likely,
and only texts that look like prose (``looks_like_prose``), so that junk stays unlikely.
Spark counts the grams and estimates the models by grouping and joins. The finished table of
logarithms, hash-sorted, is broadcast if its counted rows take at most ``HELD_BYTES``, else joined
to the texts' grams; both give the same sums to the bit.

Each language has its own band: the median of its distinct texts' log perplexities less and plus so
many times their median deviation, both exact over perplexities counted in steps of ``STEP``. The
deviation counts as ``LEAST_SPREAD`` at least; with fewer than ``FEWEST_TEXTS`` distinct texts it
counts at least as much as that of all languages' texts. A text outside is rejected.

Cases: a null or empty text has no words and fails the base rule; a null language is a language;
repeated rows are judged each; other columns are left out of the scores; texts are told apart by 128
bits. A language of which no text passes the base rule has no band and nothing to judge by it. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engagement_lake.llm.kneser_ney import LOG_UNIT, ROW_BYTES, GramTable, joined_sums, kneser_ney, log_sums
from engagement_lake.llm.store import read, written
from engagement_lake.llm.units import HASHED_BYTES, freed, slices, text_bytes
from engagement_lake.llm.words import owners, per_text, span_hashes, window_hashes, word_spans

# Median deviations that a text's log perplexity may lie below and above its language's median.
BELOW, ABOVE = 6.0, 6.0
# Least median deviation, so that a language of near copies does not reject everything else.
LEAST_SPREAD = 0.005
FEWEST_TEXTS = 20
STEP = 1e-4
# Largest broadcast table of logarithms; larger ones are joined.
HELD_BYTES = 64 << 20
FEWEST_WORDS = 20
MOST_REPEATED_PERCENT = 30
WINDOW = 8
# Texts from which models learn have at most so many symbols and capitals.
MOST_SYMBOLS_A_WORD, MOST_CAPITALS_A_LETTER = 0.1, 0.5
SURFACE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SYMBOLS = b"#*$%&|<>"


def surface(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts that need no model."""
    begins, ends = word_spans(data, offsets)
    n_words = np.diff(np.searchsorted(begins, offsets))
    word_of = owners(n_words)
    white = np.isin(data, np.array([0x20, *range(0x09, 0x0E)], np.uint8))
    symbols = np.isin(data, np.frombuffer(_SYMBOLS, np.uint8))

    # A window counts if it lies in one text and its hash occurs there twice or more.
    windows = window_hashes(span_hashes(data, begins, ends), WINDOW)
    inside = np.flatnonzero(word_of[: len(windows)] == word_of[WINDOW - 1 :]) if len(windows) else []
    covered = np.zeros(len(begins) + 1, np.int64)
    if len(inside):
        at = inside[_repeated(word_of[inside], windows[inside])]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + WINDOW, -1)
    repeated = np.cumsum(covered)[: len(begins)] > 0

    # Lines of a text: between line feeds, with at least one word.
    feeds = np.flatnonzero(data == 0x0A)
    line_begins = np.union1d(offsets[:-1], feeds + 1)
    line_begins = line_begins[line_begins < len(data)]
    line_ends = np.r_[line_begins[1:], len(data)]
    text_ends = offsets[np.searchsorted(offsets, line_begins, side="right")]
    closed = (line_ends <= text_ends) & (data[line_ends - 1] == 0x0A) if len(data) else line_ends > 0
    line_ends = np.minimum(line_ends - closed, text_ends)
    spoken = np.searchsorted(begins, line_begins) < np.searchsorted(begins, line_ends)
    line_begins, line_ends = line_begins[spoken], line_ends[spoken]
    line_of = np.searchsorted(offsets, line_begins, side="right") - 1
    again = _repeated(line_of, span_hashes(data, line_begins, line_ends), later_only=True)

    n = len(offsets) - 1
    return {
        "n_words": n_words,
        "word_chars": per_text(~white & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": per_text(symbols, offsets),
        "n_dup_lines": np.bincount(line_of[again], minlength=n),
        "n_repeat_words": np.bincount(word_of[repeated], minlength=n),
    }


def _repeated(text: np.ndarray, value: np.ndarray, later_only: bool = False) -> np.ndarray:
    """Indexes of the items that share text and value with another (with an earlier one)."""
    if not len(text):
        return np.zeros(0, np.int64)
    order = np.lexsort((value, text))
    same = (text[order][1:] == text[order][:-1]) & (value[order][1:] == value[order][:-1])
    later = np.r_[False, same]
    return order[later if later_only else later | np.r_[same, False]]


def looks_like_prose(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts of enough words, with few symbols to a word and few capitals among the letters A to Z."""
    begins, _ = word_spans(data, offsets)
    words = np.diff(np.searchsorted(begins, offsets))
    symbols = per_text(np.isin(data, np.frombuffer(_SYMBOLS, np.uint8)), offsets)
    capitals = per_text((data >= 0x41) & (data <= 0x5A), offsets)
    letters = capitals + per_text((data >= 0x61) & (data <= 0x7A), offsets)
    return (
        (words >= FEWEST_WORDS)
        & (symbols <= MOST_SYMBOLS_A_WORD * words)
        & (capitals <= MOST_CAPITALS_A_LETTER * letters)
    )


def distinct_texts(rows: DataFrame) -> DataFrame:
    """(model, text_id, text): each text of a model once. Only texts that occur again are shuffled."""
    again = rows.groupBy("model", "text_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    again = written(again, "texts-again")
    rows = rows.select("model", "text_id", "text")
    once = rows.join(again, ["model", "text_id"], "left_anti")
    copies = rows.join(again, ["model", "text_id"], "left_semi")
    return once.unionByName(copies.dropDuplicates(["model", "text_id"]))


def score_texts(docs: DataFrame, held_bytes: int = HELD_BYTES) -> DataFrame:
    """(key, model, text_id, surface counts, base_failed, log_perplexity) of (key, lang, text) rows."""
    model = F.xxhash64(F.col("lang").isNull(), F.col("lang")).alias("model")
    text_id = F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("text_id")
    rows = docs.select("key", model, text_id, "text")
    texts = distinct_texts(rows)
    table = kneser_ney(texts, looks_like_prose)
    held = None
    if table.count() * ROW_BYTES <= held_bytes:
        held = docs.sparkSession.sparkContext.broadcast(GramTable(table.toArrow()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", HASHED_BYTES):
                found = surface(*text_bytes(part.column("text")))
                if held is not None:
                    found["log_sum"], found["n_grams"] = log_sums(part, held.value.look_up)
                columns = [part.column(name) for name in ("key", "model", "text_id")]
                columns += [pa.array(c, pa.int64()) for c in found.values()]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "model", "text_id", *found])

    schema = T.StructType().add("key", docs.schema["key"].dataType).add("model", "long").add("text_id", "binary")
    for name in [*SURFACE, *(["log_sum", "n_grams"] if held is not None else [])]:
        schema = schema.add(name, "long")
    scored = rows.mapInArrow(freed(score), schema)
    if held is None:
        scored = scored.join(written(joined_sums(texts, table), "text-logs"), ["model", "text_id"])
    few = F.col("n_words") < FEWEST_WORDS
    same = 100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    perplexity = -F.col("log_sum") * LOG_UNIT / F.col("n_grams")
    columns = ["key", "model", "text_id", *SURFACE, (few | same).alias("base_failed")]
    return scored.select(*columns, perplexity.alias("log_perplexity"))


def bands(scored: DataFrame, below: float = BELOW, above: float = ABOVE) -> DataFrame:
    """(model, lowest, highest): the log perplexities that each language allows, in steps.

    Perplexities are counted by step first, so that no language's texts meet in one task: a step is one row
    of a language whatever the number of texts.
    """
    texts = scored.where(~F.col("base_failed"))
    texts = texts.select("model", "text_id", _steps().alias("step")).distinct()
    counted = written(texts.groupBy("model", "step").agg(F.count(F.lit(1)).alias("n")), "perplexity-steps")
    middle = counted.groupBy("model").agg(F.percentile("step", 0.5, F.col("n")).alias("middle"), F.sum("n").alias("texts"))
    off = counted.join(middle, "model").withColumn("off", F.abs(F.col("step") - F.col("middle")))
    own = off.groupBy("model").agg(
        F.first("middle").alias("middle"), F.first("texts").alias("texts"), F.percentile("off", 0.5, F.col("n")).alias("own")
    )
    pooled = off.groupBy("off").agg(F.sum("n").alias("n")).agg(F.percentile("off", 0.5, F.col("n")).alias("all"))
    few = F.when(F.col("texts") < FEWEST_TEXTS, F.col("all"))
    spread = F.greatest("own", few, F.lit(LEAST_SPREAD / STEP))
    return own.crossJoin(F.broadcast(pooled)).select(
        "model",
        (F.col("middle") - below * spread).alias("lowest"),
        (F.col("middle") + above * spread).alias("highest"),
    )


def _steps() -> Column:
    return F.round(F.col("log_perplexity") / STEP).cast("long")


def judge(
    docs: DataFrame, text: str = "text", lang: str = "lang", key: Column | str = "doc_id", held_bytes: int = HELD_BYTES
) -> DataFrame:
    """The scores of every row, with ``kept``: inside its language's band and not failed before."""
    rows = docs.select(
        (F.col(key) if isinstance(key, str) else key).alias("key"),
        F.col(lang).alias("lang"),
        F.col(text).alias("text"),
    )
    scored = written(score_texts(rows, held_bytes), "quality-scores")
    # One row for each language: Spark broadcasts it by its size, or splits a hot language of the join.
    judged = scored.join(written(bands(scored), "bands"), "model", "left")
    within = F.coalesce(_steps().between(F.col("lowest"), F.col("highest")), F.lit(True))
    return judged.withColumn("kept", ~F.col("base_failed") & within)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(read(spark, sf_dir, "documents"))
    return judged.select(F.col("key").alias("doc_id"), *SURFACE, "base_failed", "log_perplexity", "kept")
