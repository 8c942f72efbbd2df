"""Kneser-Ney models and bands against plain versions, on small made tables."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from engagement_lake.llm.kneser_ney import LOG_UNIT, all_texts, grams, joined_sums, kneser_ney
from engagement_lake.llm.quality_rules import judge, looks_like_prose
from engagement_lake.llm.units import text_bytes
from tests.llm.test_operators import DDL, ODD

EDGE = "\uffff"


def units_of(text):
    raw = (text or "").encode("utf-16-le")
    return [chr(int.from_bytes(raw[i : i + 2], "little")) for i in range(0, len(raw), 2)]


def grams_of(text):
    units = [EDGE] * 3 + units_of(text) + [EDGE]
    return [tuple(units[i : i + 4]) for i in range(len(units) - 3)]


def plain_model(learnt):
    """Probability of a gram under the modified Kneser-Ney model of the texts, by recursion."""
    counts = {4: Counter(g for text in learnt for g in grams_of(text))}
    for width in (3, 2, 1):
        counts[width] = Counter(g[1:] for g in counts[width + 1])
    followers = {w: defaultdict(list) for w in counts}
    off = {}
    for width, found in counts.items():
        for gram, n in found.items():
            followers[width][gram[:-1]].append(n)
        n1, n2, n3, n4 = (max(1, sum(n == k for n in found.values())) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
        off[width] = [0.0] + [min(max(d, 0.05), 0.95 * k) for k, d in zip((1, 2, 3), raw)]

    def probability(gram):
        width = len(gram)
        if not width:
            return 1 / 65536
        lower = probability(gram[1:])
        past = followers[width].get(gram[:-1])
        if not past:
            return lower
        n, taken = counts[width].get(gram, 0), off[width]
        return (n - taken[min(n, 3)] + sum(taken[min(m, 3)] for m in past) * lower) / sum(past)

    return probability


def code_of(gram):
    code = 0
    for unit in gram:
        code = code << 16 | ord(unit)
    return code - (1 << 64) if code >> 63 else code


def prose(random, letters, n=60):
    parts = ["".join(random.choice(list(letters), 2)) for _ in range(12)]
    return parts, lambda: " ".join("".join(random.choice(parts, random.integers(1, 4))) for _ in range(n))


def test_grams_of_any_character():
    import pyarrow as pa

    texts = ["a𝄞é", "", None, "日本 x", "\x00"]
    codes, ends = grams(*text_bytes(pa.array(texts)))
    for i, text in enumerate(texts):
        assert codes[ends[i] : ends[i + 1]].view(np.int64).tolist() == [code_of(g) for g in grams_of(text)]
    broken = np.frombuffer(b"ab\xffc", np.uint8)
    assert len(grams(broken, np.array([0, 3, 4]))[0]) == 4 + 2


def test_model_equals_a_plain_one(spark):
    """Two models; texts that are not learnt are scored all the same."""
    rows = [(1, t) for t in ("banana bandana", "an ant, a band", "naïve 𝄞 banana", "", "bandana ban")]
    rows += [(2, "banana"), (2, "unlearnt !! banana"), (1, "unlearnt ?? bandana"), (3, "unlearnt alone")]

    def learns(data, offsets):
        return np.array([b"unlearnt" not in data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])], bool)

    found = kneser_ney(spark.createDataFrame(rows, "model long, text string"), learns).collect()
    expected = {}
    for model in (1, 2, 3):
        texts = [t for m, t in rows if m == model]
        probability = plain_model([t for t in texts if "unlearnt" not in t])
        expected.update({(model, code_of(g)): math.log(probability(g)) for t in texts for g in grams_of(t)})
    assert len(found) == len(expected)
    for row in found:
        assert row["log"] * LOG_UNIT == pytest.approx(expected[row["model"], row["code"]], abs=1e-6)
    probability = plain_model(["banana bandana"])
    seen = {g[-1] for g in grams_of("banana bandana")}
    rest = (65536 - len(seen)) * probability(("a", "n", "a", "\x01"))
    assert sum(probability(("a", "n", "a", unit)) for unit in seen) + rest == pytest.approx(1)
    empty = spark.createDataFrame([], "model long, text string")
    assert kneser_ney(empty, all_texts).count() == 0


def test_a_joined_table_gives_the_same(spark):
    odd = spark.createDataFrame(ODD, DDL).select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "text", "lang")
    held, joined = (Counter(map(tuple, judge(odd, held_bytes=size).collect())) for size in (1 << 20, 0))
    assert held == joined and sum(held.values()) == len(ODD)
    assert judge(odd.limit(0), held_bytes=-1).count() == 0
    rows = odd.where("text IS NOT NULL").dropDuplicates(["text"])
    rows = rows.select(F.lit(1).cast("long").alias("model"), F.unhex(F.md5("text")).alias("text_id"), "text")
    table = kneser_ney(rows)
    sums = [Counter(map(tuple, joined_sums(rows, table, size).collect())) for size in (1, 1 << 20)]
    assert sums[0] == sums[1]


def test_every_language_is_judged_by_its_own(spark):
    random = np.random.default_rng(3)
    rows = []
    for i in range(70):
        _, text = prose(random, "abcdefghijklmnopqrstuvwxyz"[i % 13 : i % 13 + 12])
        rows += [(10 * i + j, text(), f"l{i}") for j in range(2)]
    ddl = "doc_id int, text string, lang string"
    found = {r["key"]: r for r in judge(spark.createDataFrame(rows, ddl)).collect()}
    assert len({r["model"] for r in found.values()}) == 70
    alone = judge(spark.createDataFrame([r for r in rows if r[2] == "l5"], ddl)).collect()
    assert {r["key"]: r["log_perplexity"] for r in alone} == {k: found[k]["log_perplexity"] for k in (50, 51)}


@pytest.mark.parametrize("letters", ["абвгдежзиклмнопрстуфхцч", "的一是不了人我在有他这为之大来以个中上们"])
def test_noise_of_any_script_is_rejected(spark, letters):
    """Words of the language stay; the same characters in random order go; copies are judged alike."""
    random = np.random.default_rng(5)
    parts, text = prose(random, letters, 150)
    good = [text() for _ in range(60)]
    noise = [" ".join("".join(random.choice(list(letters), 5)) for _ in range(150)) for _ in range(2)]
    marked = [g.replace(" ", "*** ") for g in good[:5]]
    rows = [(i, t, "x") for i, t in enumerate(good + [good[0]] * 60)]
    rows += [(1000 + i, t, "x") for i, t in enumerate(noise + marked)]
    kept = {r["key"]: r["kept"] for r in judge(spark.createDataFrame(rows, "doc_id int, text string, lang string")).collect()}
    assert not any(kept[1000 + i] for i in range(7))
    assert sum(kept[i] for i in range(60)) >= 57
    assert all(kept[60 + i] == kept[0] for i in range(60))


def test_what_models_learn_from():
    import pyarrow as pa

    word = "word " * 25
    texts = [word, word[:50], word + "# " * 2, word + "| " * 6, word.upper(), "слово " * 25, "", None]
    assert looks_like_prose(*text_bytes(pa.array(texts))).tolist() == [True, False, True, False, False, True, False, False]
