"""The corpus operators against plain versions, on small made tables with every odd case."""

import math
import re
import textwrap
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from engagement_lake.llm.elias_fano import EliasFano
from engagement_lake.llm.licenses import scan_licenses
from engagement_lake.llm.mixing import mix_sources, mixed_documents, n_words
from engagement_lake.llm.packing import pack_documents, pack_lengths, packed_sequences, place_pieces, token_pieces
from engagement_lake.llm.ppm import SYMBOLS, Contexts, levels_of, log_probabilities, score_documents
from engagement_lake.llm.quality_rules import SURFACE, judge
from engagement_lake.llm.sharding import read_shards, shard_of, write_shards
from engagement_lake.llm.shingle_join import choose_boundary, jaccard_components, jaccard_pairs
from engagement_lake.llm.store import scratch_path, written
from engagement_lake.llm.token_counts import token_counts
from engagement_lake.llm.token_files import fetch_tokens, read_tokens, write_tokens
from engagement_lake.llm.voronoi import top_k

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DDL = "doc_id long, text string, lang string, source string, sig string, `row` int"
BASE = " ".join(f"word{i % 37}x{i % 11}" for i in range(60))
LONG = "Lorem ipsum dolor sit amet, consectetur\tadipiscing élit. " * 900

ODD = [
    (1, None, "en", "a", "x", 1),
    (2, "", "en", "a", None, 2),
    (3, " \t\n ", None, None, None, None),
    (4, "one two", "en", "b", "x", 1),
    (5, "ONE two", "de", "b", "x", 1),
    (5, "ONE two", "de", "b", "x", 1),
    (None, "naïve  café <|endoftext|> <s>▁x\x00 'll it's 3%", "fr", "c", None, 5),
    (6, BASE, "en", "a", "x", 1),
    (7, BASE + " tail", "en", "a", "x", 1),
    (8, BASE.replace("word5x5", "other"), "en", "a", "x", 1),
    (9, BASE[: len(BASE) // 2], "en", None, "x", 1),
    (10, "a b c d e f g h " * 12, "en", "a", "x", 1),
    (11, LONG, "en", "a", "x", 1),
    (12, "same line here\nsame line here\n#hash|tag here\nGranted. Released under the MIT License.", "en", "d", "x", 1),
    (13, BASE, "en", "a", "x", 1),
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, DDL)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DDL)


def plain_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def plain_components(rows):
    sets = [(key, plain_set(text)) for key, text in rows]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i][1], sets[j][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(sets):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return Counter((key, len(s), least.get(root(i), key)) for i, (key, s) in enumerate(sets))


def test_jaccard_components(odd, empty):
    found = jaccard_components(odd).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component"]) for r in found) == plain_components(
        [(r[0], r[1]) for r in ODD]
    )
    assert jaccard_components(empty).count() == 0


def test_jaccard_components_of_near_copies(spark):
    """Sets of all sizes with one to many words changed: links, near misses and chains."""
    random = np.random.default_rng(3)
    rows = []
    for n in (5, 7, 8, 12, 20, 40, 80):
        words = [f"w{n}_{i}" for i in range(n)]
        for copy in range(12):
            changed = list(words)
            for at in random.integers(0, n, copy % 4):
                changed[at] = f"c{copy}_{at}"
            rows.append((len(rows), " ".join(changed[: n - copy % 3])))
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component"]) for r in found) == plain_components(rows)


@pytest.mark.parametrize("block", [1024, 4])
def test_jaccard_links_are_all_counted(spark, monkeypatch, block):
    """A group of near copies, exact copies among them, whole in one block and cut into many."""
    monkeypatch.setattr("engagement_lake.llm.shingle_join.BLOCK_SETS", block)
    rows = [(1, None), (2, "a b c d e f"), (3, "a b c d e f"), (4, "f e d c b a")]
    for n in (40, 90):
        words = [f"w{n}_{i}" for i in range(n)]
        for copy in range(30):
            changed = [*words[: n - copy // 2 % 9], f"end{copy // 2}"]
            changed[copy // 4] = f"c{copy // 2}"
            rows.append((len(rows) + 1, " ".join(changed)))
    sets = [plain_set(text) for _, text in rows]
    expected, pairs = Counter(), set()
    least = {}
    for (key, _), x in zip(rows, sets):
        least.setdefault(x, key)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                expected[rows[i][0]] += 1
                expected[rows[j][0]] += 1
                if a != b:
                    pairs.add((min(least[a], least[b]), max(least[a], least[b])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["n_links"] for r in jaccard_components(docs).collect()}
    assert found == {key: expected[key] for key, _ in rows}
    assert Counter(map(tuple, jaccard_pairs(docs).collect())) == Counter(pairs)


def test_pairs_are_verified_in_rounds(spark, monkeypatch):
    """What pairs carry at a time is bounded; no link is lost by it."""
    from engagement_lake.llm import shingle_join

    rounds, count = [], shingle_join.SetStore._rounds
    monkeypatch.setattr(shingle_join, "CARRIED", 0.05)
    monkeypatch.setattr(shingle_join.SetStore, "_rounds", lambda *a: rounds.append(count(*a)) or rounds[-1])
    rows = [
        (100 * g + i, " ".join(f"g{g}w{j}" if j != 3 * i + 7 else f"changed{i}" for j in range(200)))
        for g in range(3)
        for i in range(6)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: (r["component"], r["n_links"]) for r in jaccard_components(docs).collect()}
    assert max(rounds) > 1
    assert found == {key: (key // 100 * 100, 5) for key, _ in rows}


def test_large_sets_that_are_not_similar_are_not_carried_to_each_other(spark, monkeypatch):
    """Bitmaps as wide as sets are large sift their pairs; near the limit, and of unlike widths, none is lost."""
    from engagement_lake.llm import shingle_join

    sifted, count = [], shingle_join.SetStore._rounds
    monkeypatch.setattr(shingle_join.SetStore, "_rounds", lambda s, x: sifted.append(x.count()) or count(s, x))
    whole = [f"w{i}" for i in range(5000)]
    half = [*whole[:2500], *(f"other{i}" for i in range(2500))]
    rows = [(1, " ".join(whole)), (2, " ".join(half))]
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["component"] for r in found.collect()} == {1, 2}
    assert sum(sifted) == 0

    rows = []
    for n in (1000, 1060, 2040, 2100, 4200):
        for copy, cut in enumerate((0, n // 100, n // 8, n // 7, n // 4 - 2, n // 4 + 2)):
            rows.append((len(rows), " ".join(f"n{n // 500}w{i}" for i in range(cut, n))))
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component"]) for r in found) == plain_components(rows)


def test_keys_of_few_sets_give_all_their_pairs_in_one_turn():
    """So that their sets need not be dealt again in the turns to come; keys of more sets give the likeliest."""
    from engagement_lake.llm.shingle_join import LIKELIEST, PIVOTS, _cross_pairs

    def pairs(n: int) -> set:
        columns = [np.zeros(n, np.int64), np.full(n, 100), np.arange(n) % 2, np.arange(n)]
        names = ["entry", "size", "component", "sig", "bits"]
        batch = pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array([bytes(128)] * n)], names=names)
        given = [pair for b in _cross_pairs(0)(iter([batch])) for pair in zip(*b.to_pydict().values())]
        assert len(set(given)) == len(given)
        return set(given)

    n = PIVOTS + 1
    assert pairs(n) == {(a, b) for a in range(n) for b in range(a, n) if (a - b) % 2}
    assert len(pairs(n + 1)) == LIKELIEST


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_joined_pieces_are_tokenised_as_if_alone(name):
    """Pieces of one word stand beside each other where ids tell the words' ends: one part each for the library."""
    from engagement_lake.llm.units import LibraryTokenizer

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        tokenizer = LibraryTokenizer(file.read())
    words = ["a", " a", " Straße", "ÀÉÿ", " oucheaué", "xkcdqz" * 9, "it", "s", " S", "re", " the", "w"]
    odd = ["×", "a×b", "÷", "e\u0301", "\u0301a", "'s", "x'", "it's", " ", " \t", "\n\n", "9", "12", "½", "a1", "ΑΣ", "a b"]
    odd += ["<|endoftext|>", "a<|endoftext|>b", "</w>", "w>", "한", "\u1112\u1161", "🙂", "\u200d", "\0", "İ", "ﬁ", "µ", "ªº", "a\n"]
    called, ids_of = [], tokenizer._ids
    tokenizer._ids = lambda text: called.append(text) or ids_of(text)
    for pieces in (words, odd, [p for pair in zip(words, odd) for p in pair], odd[:1]):
        lengths, values = tokenizer._encode(pieces)
        alone = [ids_of(p).tolist() for p in pieces]
        assert lengths.tolist() == [len(ids) for ids in alone]
        assert values.tolist() == [i for ids in alone for i in ids]
    assert (" ".join(words) in called) == (name == "word_bpe_49k.json")


def test_written_tables_leave_no_shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles() -> set:
        found = files.getAllFiles()
        names = [found.apply(i).getName() for i in range(found.size())]
        return {name for name in names if name.startswith("shuffle_")}

    before = shuffles()
    table = written(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count(), "counts")
    for _ in range(50):  # files go in the background
        if not (left := shuffles() - before):
            break
        time.sleep(0.2)
    assert not left and table.count() == 10


def test_boundary_weighs_entries_against_scans():
    cheap = [{"size": s, "pairs": 3, "singles": 2, "scanned": 50} for s in (4, 8)]
    dear = [{"size": s, "pairs": 300, "singles": 2, "scanned": 0} for s in (4, 8)]
    assert choose_boundary(cheap) > 8
    assert choose_boundary(dear) == 2


def test_ppm_probabilities_sum_to_one():
    random = np.random.default_rng(2)
    order = 3
    codes = random.integers(0, 3, (200, order + 1)) + 97
    code = np.zeros(len(codes), np.int64)
    for i in range(order):
        code = code << 8 | codes[:, i]
    code = code << 9 | codes[:, order]
    levels = levels_of(code, np.ones(len(code), np.int64), order)
    for context in [*(code[:5] >> 9), (120 << 16 | 120 << 8 | 120), (97 << 16 | 98 << 8 | 120)]:
        wanted = (np.int64(context) << 9) | np.arange(SYMBOLS)
        assert (10 ** log_probabilities(wanted, levels, order)).sum() == pytest.approx(1.0)
    untrained = [Contexts(np.zeros(0, np.int64), np.zeros(0, np.int64))] * (order + 1)
    assert log_probabilities(np.arange(2), untrained, order) == pytest.approx(-math.log10(SYMBOLS))


def test_ppm_chunks_are_summed_as_they_come(monkeypatch):
    """What waits to be summed is bounded, and a chunk's items reach the JVM in batches."""
    from engagement_lake.llm import ppm

    monkeypatch.setattr(ppm, "GATHERED", 10)
    monkeypatch.setattr(ppm, "BATCH_ROWS", 7)
    sums, total = ppm._Summing(), Counter()
    for i in range(30):
        keys = np.unique(np.arange(i, i + 9) % 13)
        sums.add(keys, np.full(len(keys), i))
        total.update({k: i for k in keys.tolist()})
        assert sums.waiting <= 13 + 13 + 9
    keys, counts = sums.sums()
    assert dict(zip(keys.tolist(), counts.tolist())) == total
    table = ppm._item_batches(3, [(ppm.GRAM, keys, counts), (ppm.WORD, keys, counts)])
    assert max(b.num_rows for b in table.to_batches()) <= 7
    assert table.column("key").to_pylist() == keys.tolist() * 2


def test_ppm_scores(odd, empty):
    train = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
    found = score_documents(odd, train).collect()
    learnt, rows = Counter(), []
    for doc_id, text, *_ in ODD:
        words = WORD.findall((text or "").translate(LOWER)) + ["\n"]
        held_out = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2
        rows.append((doc_id, not held_out, words))
        if not held_out:
            learnt.update(words)
    total, kinds = sum(learnt.values()), len(learnt)
    expected = Counter()
    for doc_id, trains, words in rows:
        base = sum(math.log10((learnt[w] + 1) / (total + kinds + 1)) for w in words)
        expected[doc_id, trains, len(words), sum(learnt[w] > 0 for w in words), total, round(base, 6)] += 1
    names = ("doc_id", "train", "n_tokens", "n_known", "train_tokens")
    assert Counter((*(r[n] for n in names), round(r["base_score"], 6)) for r in found) == expected
    assert all(r["score"] < 0 for r in found)
    assert score_documents(empty, train).count() == 0


def test_quality_counts(odd, empty):
    found = judge(odd).collect()
    expected = Counter()
    for doc_id, text, *_ in ODD:
        text = text or ""
        words, seen, repeated_lines = WORD.findall(text), set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                repeated_lines += line in seen
                seen.add(line)
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        covered = {
            j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)
        }
        marks = sum(c in "#*$%&|<>" for c in text)
        failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        counts = (len(words), sum(map(len, words)), marks, repeated_lines, len(covered))
        expected[(doc_id, *counts, failed)] += 1
    assert Counter((r["key"], *(r[n] for n in SURFACE), r["base_failed"]) for r in found) == expected
    assert not any(r["kept"] for r in found if r["base_failed"])
    assert judge(empty).count() == 0


def test_quality_bands_count_a_text_once(spark):
    """More than half of a language is one text; another language has two texts."""
    random = np.random.default_rng(6)
    letters = np.array(list("etaoinshrdlu"))

    def prose():
        return " ".join("".join(random.choice(letters, random.integers(2, 8))) for _ in range(60))

    copied, others = prose(), [prose() for _ in range(45)]
    odd_one = " ".join("".join(random.choice(list("QXZ#@9"), 5)) for _ in range(60))
    rows = [(i, copied, "en") for i in range(55)] + [(100 + i, t, "en") for i, t in enumerate(others)]
    rows += [(200, odd_one, "en"), (300, prose(), "de"), (301, prose(), "de")]
    found = {r["key"]: r for r in judge(spark.createDataFrame(rows, "doc_id int, text string, lang string")).collect()}
    step = {i: round(r["log_perplexity"] / 1e-4) for i, r in found.items()}
    once = {(r[2], r[1]): step[r[0]] for r in rows}
    middle, off = {}, {}
    for lang in ("en", "de"):
        values = [v for (of, _), v in once.items() if of == lang]
        middle[lang] = np.median(values)
        off[lang] = [abs(v - middle[lang]) for v in values]
    spread = {lang: max(np.median(x), 50) for lang, x in off.items()}
    spread["de"] = max(spread["de"], np.median(off["en"] + off["de"]))
    expected = {i: bool(abs(step[i] - middle[lang]) <= 6 * spread[lang]) for i, _, lang in rows}
    assert {i: r["kept"] for i, r in found.items()} == expected
    assert sum(found[i]["kept"] for i in range(100, 145)) >= 40 and not found[200]["kept"]
    assert found[300]["kept"] and found[301]["kept"]
    assert len({found[i]["log_perplexity"] for i in range(55)}) == 1


def test_token_counts_equal_the_library(odd, empty):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    found = token_counts(odd, path).collect()
    expected = Counter((r[0], len((r[1] or "").encode()), len(library.encode(r[1] or ""))) for r in ODD)
    assert Counter(map(tuple, found)) == expected
    assert token_counts(empty, path).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_files_round_trip(spark, odd, empty, name):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path(name))
    ids = {t: library.encode(t or "", add_special_tokens=False).ids + [0] for t in {r[1] for r in ODD}}
    path = scratch_path(spark, "test-tokens")
    write_tokens(odd, path, public_tokenizers.path(name), 0)
    found = read_tokens(spark, path, with_ids=True).orderBy("start").collect()
    as_bytes = [np.array(ids[r[1]], "<u4").tobytes() for r in ODD]
    expected = Counter((r[0], len(b) // 4, zlib.crc32(b), b) for r, b in zip(ODD, as_bytes))
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"], bytes(r["ids"])) for r in found) == expected
    assert [r["start"] for r in found] == list(np.cumsum([0] + [r["n_tokens"] for r in found[:-1]]))
    keys = [r["doc_id"] for r in found]
    assert keys[0] is None and keys[1:] == sorted(keys[1:])
    path = scratch_path(spark, "test-tokens")
    write_tokens(empty, path, public_tokenizers.path(name), 0)
    assert read_tokens(spark, path).count() == 0
    assert fetch_tokens(spark, path, empty).count() == 0


def test_documents_are_fetched_by_key(spark, odd):
    path = scratch_path(spark, "test-tokens")
    write_tokens(odd.repartition(3), path, public_tokenizers.path("byte_bpe_50k.json"), 0)
    columns = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]
    whole = read_tokens(spark, path, with_ids=True).select(columns).collect()
    keys = sorted({r["doc_id"] for r in whole} - {None})
    # Null, asked for twice, unknown, the first and the last document, every other one.
    for asked in ([None], [keys[0], keys[0], 10**12], [None, keys[-1]], keys[::2], [10**12], []):
        wanted = spark.createDataFrame([(k, "x") for k in asked], "doc_id long, start string")
        found = fetch_tokens(spark, path, wanted)
        assert found.columns == columns
        assert Counter(found.collect()) == Counter(r for r in whole if r["doc_id"] in asked)


@pytest.mark.parametrize("values", [[], [0], [5, 5, 5, 9], list(range(0, 90_000, 7)), [10**9, 10**9 + 1]])
def test_elias_fano(values):
    coded = EliasFano.encode(np.array(values, np.int64))
    assert coded.values().tolist() == values
    assert [coded.select(i) for i in range(len(values))] == values


def test_packing(spark, odd, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    found = pack_documents(odd, path, 1, 128).collect()
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1].tolist()] and ends[-1] <= 128
    total = sum(r["length"] for r in found)
    assert len(by_sequence) <= -(-total // 128) + 1
    assert pack_documents(empty, path).count() == 0
    placed = place_pieces(token_pieces(odd, path, 1, 128), 128)
    assert sum(len(r["ids"]) // 4 for r in packed_sequences(placed).collect()) == total


def test_pieces_are_the_library_s_ids(spark, odd):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    expected = Counter()
    for row in ODD:
        ids = [*library.encode(row[1] or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 128)):
            part = np.array(ids[start : start + 128], "<u4")
            expected[row[0], piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(tuple(r) for r in pack_documents(odd, path, 1, 128).select(*columns).collect()) == expected
    with_ids = token_pieces(odd, path, 1, 128).collect()
    assert Counter((r["key"], r["piece"], r["start"], r["length"], zlib.crc32(r["ids"])) for r in with_ids) == expected


def test_packing_places_every_rank_once():
    random = np.random.default_rng(10)
    counts = Counter(np.minimum(4096, random.lognormal(6, 1.3, 20_000).astype(int) + 1).tolist())
    runs = pack_lengths(counts)
    used = Counter()
    for run in runs:
        assert sum(length for length, _ in run.slots) + run.left == 4096 and run.left >= 0
        for length, rank in run.slots:
            used.update((length, rank + i) for i in range(run.count))
    assert max(used.values()) == 1
    assert Counter(length for length, _ in used) == counts
    least = -(-sum(length * n for length, n in counts.items()) // 4096)
    assert sum(run.count for run in runs) <= least * 1.002 + 1


def test_shards(spark, odd, empty):
    path = scratch_path(spark, "test-shards")
    write_shards(odd, path, 4, bucket_bytes=1000)
    found = read_shards(spark, path, odd.schema).select("*", shard_of(F.col("row.doc_id"), 5, 8).alias("grown")).collect()
    assert Counter(tuple(r["row"]) for r in found) == Counter(ODD)
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown"] in (r["shard"], 4)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    path = scratch_path(spark, "test-shards")
    write_shards(empty, path)
    none = read_shards(spark, path, empty.schema)
    assert none.collect() == [] and none.select("row.*").columns == empty.columns


def test_shards_are_read_without_a_shuffle_of_rows(spark, odd):
    path = scratch_path(spark, "shards")
    write_shards(odd, path, 4)
    found = read_shards(spark, path, odd.schema)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan


def test_mixing(spark, odd, empty):
    rows = [(i, "w " * (1 + i % 9), s) for i in range(600) for s in ("a", "b", None) if s != "b" or i < 100]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mix_sources(docs, n_words("text")).collect()
    sizes, taken, target = Counter(), Counter(), {}
    for r in found:
        source = r["row"]["source"]
        sizes[source] += r["size"]
        taken[source] += r["size"] * r["copies"]
        target[source] = r["target"]
        assert r["source_size"] >= r["size"] and r["copies"] in (0, 1, 2)
    # Weights 3, 1, 2 of 1.5 times all words: none reaches twice its source's size but, perhaps, b.
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for source in sizes:
        assert target[source] <= 2 * sizes[source] + 1e-6
        assert abs(taken[source] - target[source]) <= 20
    again = {(r["row"], r["copies"]) for r in mix_sources(docs, n_words("text")).collect()}
    assert again == {(r["row"], r["copies"]) for r in found}
    mixed = mixed_documents(mix_sources(docs, n_words("text")))
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in found)
    assert mix_sources(odd, n_words("text")).count() == len(ODD)
    assert mix_sources(empty, n_words("text")).count() == 0


def test_licenses(spark, odd, empty):
    found = {r["doc_id"]: r for r in scan_licenses(odd).collect()}
    assert found[12]["licenses"] == "MIT" and found[1]["licenses"] == ""
    wrapped = "Licensed under the Apache\nLicense, Version 2.0. You may not use this file except in\ncompliance with the License."
    rows = [(1, wrapped), (2, "x\nThis is licensed to nobody we know.\nLicensed under CC BY-NC 4.0.")]
    found = {r["doc_id"]: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert (found[1]["licenses"], found[1]["n_known"]) == ("Apache-2.0", 2)
    assert (found[2]["licenses"], found[2]["n_known"], found[2]["n_unknown"]) == ("CC-BY-NC-4.0", 1, 1)
    assert scan_licenses(empty).count() == 0


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_3 = """

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""


def test_licenses_of_standard_texts(spark):
    wanted = [(MIT, "MIT"), (GPL, "GPL-3.0-or-later"), (BSD, "BSD-2-Clause"), (BSD + BSD_3, "BSD-3-Clause")]
    wanted += [(GPL.replace("software: you", "software; you").replace("version 3", "version 2"), "GPL-2.0-or-later")]
    wanted += [("This project is licensed under the MIT License - see the LICENSE file for details.", "MIT")]
    wrapped = [("\n\n".join(textwrap.fill(x, 72) for x in t.split("\n\n")), name) for t, name in wanted]
    rows = [(i, t) for i, (t, _) in enumerate(wanted + wrapped)]
    found = {r["doc_id"]: r["licenses"] for r in scan_licenses(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert found == {i: name for i, (_, name) in enumerate(wanted + wrapped)}


def test_a_rights_notice_is_no_licence_beside_a_grant(spark):
    header = "Copyright (c) 2020, Somebody. All rights reserved.\n\n"
    rows = [(1, header + BSD), (2, header + "Nothing else."), (3, MIT + "\n\nAll rights reserved.")]
    rows += [(4, "No license is granted. All rights reserved."), (5, BSD + "\nAll rights reserved.\nNo license is granted.")]
    found = {r["doc_id"]: r["licenses"] for r in scan_licenses(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert found[1] == "BSD-2-Clause" and found[2] == "Proprietary" and found[3] == "MIT"
    assert found[4] == "Proprietary" and found[5] == "BSD-2-Clause,Proprietary"


def test_top_k(spark):
    random = np.random.default_rng(1)
    rows = [(i, random.normal(size=6).tolist(), 0) for i in range(300)]
    rows += [(300 + i, rows[50][1], 0) for i in range(40)] + [(50, rows[50][1], 1), (None, rows[0][1], 0)]
    rows += [(900, None, 0), (950, [1.0, None], 0), (951, [float("nan")], 0), (952, [1.0, 2.0], 0), (953, [], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, query int")
    found = top_k(frame, F.col("vec_id") % 50 == 0, 5).collect()
    usable = {}
    held = []
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            q = np.zeros(6)
            q[: len(v)] = np.floor(256 * np.array(v, np.float32).astype(float))
            usable[i] = q
            held.append((i, q))
    expected = []
    for i, q in usable.items():
        if i % 50 == 0:
            scores = sorted((-int(q @ c), j) for j, c in held if j != i)[:5]
            expected += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores, 1)]
    assert sorted(map(tuple, found)) == sorted(expected)
    assert top_k(frame.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_top_k_of_a_repeated_query_id(spark):
    """Ten rows of a query's own id lie nearest: they are never found, so farther ones must be."""
    random = np.random.default_rng(7)
    rows = [(50, [8.0, 0.01 * i]) for i in range(10)] + [(1 + i % 49, [4.0, 0.01 * i]) for i in range(100)]
    rows += [(1000 + 7 * i, (random.normal(size=2) * 2).tolist()) for i in range(200)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = top_k(frame, F.col("vec_id") == 50, 5).collect()
    points = [(i, np.floor(256 * np.array(v, np.float32).astype(float))) for i, v in rows]
    expected = []
    for i, q in points[:10]:
        scores = sorted((-int(q @ c), j) for j, c in points if j != i)[:5]
        expected += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores, 1)]
    assert sorted(map(tuple, found)) == sorted(expected)


def test_pipeline_stages(spark, odd):
    import corpus_pipeline

    random = np.random.default_rng(4)
    prose = [(100 + i, " ".join(random.choice(["alpha", "beta", "gamma", "delta"], 80)), "en", "a", None, None) for i in range(40)]
    docs = spark.createDataFrame(ODD + prose + prose[:3], DDL)
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality_rules"](spark, docs, "")
    assert kept.columns == docs.columns and {4, 10}.isdisjoint(r["doc_id"] for r in kept.collect())
    single = stages["near_duplicates"](spark, docs, "").collect()
    ids = Counter(r["doc_id"] for r in single)
    assert ids[6] == 1 and ids[7] == ids[8] == ids[13] == 0 and ids[5] == 0 and ids[4] == 1
    assert all(ids[100 + i] == 1 for i in range(40)) and ids[1] == ids[2] == ids[3] == 1
    mixed = stages["mixing"](spark, docs, "")
    assert mixed.columns == docs.columns and mixed.count() > 0
    assert stages["packing"](spark, mixed, "").where("length > 4096").count() == 0


def test_pipeline_keeps_columns_of_any_name(spark, odd, empty):
    import corpus_pipeline

    named = odd.withColumns({c: F.lit(c) for c in ("known", "doc", "size", "kept", "key", "component")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, named, "")
        assert found.columns == named.columns
        assert all(r[c] == c for r in found.collect() for c in ("known", "doc", "size", "kept", "key", "component"))
        assert stage(spark, empty, "").collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, empty, "").collect() == []


def test_piece_starts_take_little_memory():
    """Beside the starts, a few flags for every byte."""
    import tracemalloc

    from engagement_lake.llm.units import letters_from_marks, piece_starts

    data = np.frombuffer(b"some words, and more: of them " * 100_000, np.uint8)
    tracemalloc.start()
    starts = piece_starts(data, np.array([0, len(data)]), letters_from_marks())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(starts) == 8 * 100_000
    assert peak < 7 * len(data)


def test_pieces_met_again_stay_remembered(monkeypatch):
    from engagement_lake.llm import units

    monkeypatch.setattr(units, "REMEMBERED", 40)
    given = []

    def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        given.extend(pieces)
        ids = [[int(p), 7] if int(p) % 2 else [int(p)] for p in pieces]
        return np.array([len(x) for x in ids]), np.concatenate(ids).astype(np.uint32)

    cache = units.PieceCache(encode, np.zeros((256, 256), bool))
    for turn in range(20):
        numbers = [1, 2, *range(10 * turn + 10, 10 * turn + 20), 1, 3]
        expected = [x for n in numbers for x in ([n, 7] if n % 2 else [n])]
        counts, values = cache.per_text(*units.text_bytes(pa.array([" ".join(map(str, numbers))])))
        assert (counts.tolist(), values.tolist()) == ([len(expected)], expected)
        assert len(cache.index) <= 40
    assert given.count(" 3") == 1
