"""Reversed search against a plain ranking of every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from engagement_lake.llm import reversed_search as module
from engagement_lake.llm.reversed_search import Heaps, reversed_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

ITEMS = [
    (1, "The cat sat, the cat; ÉTÉ été 12"),
    (2, None),
    (3, "... --- !"),
    (4, "unheard-of words"),
    (5, "the"),
    (5, "dog dog dog cat"),
    (None, "zebra the 中文"),
]
WORDS = ["the", "cat", "sat", "dog", "été", "ÉTÉ", "The", "CAT", "12", "zebra", "中文", "x" * 300, "of", "a_b"]


def documents():
    random.seed(5)
    rows = [(i, " ".join(random.choices(WORDS, k=random.randint(0, 60)))) for i in range(400)]
    rows += [(i, "cat cat dog") for i in range(400, 700)]  # copies: equal scores
    rows += [(7, "cat cat dog"), (7, "cat cat dog"), (None, "cat cat dog"), (None, "cat the dog zebra")]
    rows += [(900, None), (901, ""), (902, " !\n"), (903, "zebra " * 50_000), (904, "CAT\x00dog\x7fthe")]
    return rows


def plain(items, docs, k):
    terms = [Counter(TERM.findall((t or "").translate(LOWER))) for _, t in docs]
    lengths = [sum(c.values()) for c in terms]
    n_docs, n_terms = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(t for c in terms for t in c)
    found = []
    for item, text in items:
        asked = Counter(TERM.findall((text or "").translate(LOWER)))
        scored = []
        for (doc, _), counts, n in zip(docs, terms, lengths):
            m = 75 + (25 * n * n_docs) // n_terms if n_terms else 0
            score = 0
            for term, times in asked.items():
                if tf := counts[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += times * w * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        scored.sort(key=lambda s: s[:3])
        found += [(item, rank, s[3], -s[0]) for rank, s in enumerate(scored[:k], 1)]
    return sorted(found, key=repr)


def rows_of(df):
    return sorted(((r.item, r.rank, r.doc, r.score) for r in df.collect()), key=repr)


@pytest.mark.parametrize("limits", [{}, {"BLOCK_TERMS": 4, "CELLS": 30, "MERGES": 2}, {"_EXACT": 0}])
def test_ranking_is_that_of_the_plain_version(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(module, name, value)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = documents()
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, n int, place string")
    found = reversed_search(items, df.repartition(6), 20)
    assert rows_of(found) == plain(ITEMS, docs, 20)


def test_blocks_hold_whole_items(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK_TERMS", 4)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    entries = module.item_terms(items, "item_id", "text").cache()
    blocks = [b.collect() for b in module.item_blocks(entries)]
    assert sum(map(len, blocks)) == entries.count()
    assert all(len(b) <= 4 or len({r.place for r in b}) == 1 for b in blocks)
    placed = [r.place for b in blocks for r in {r.place: r for r in b}.values()]
    assert len(placed) == len(set(placed))


@pytest.mark.parametrize("items, docs", [([], documents()), (ITEMS, []), (ITEMS, [(1, None)]), (ITEMS[1:3], documents())])
def test_nothing_to_find(spark, items, docs):
    items = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    found = reversed_search(items, docs, 20)
    assert found.columns == ["item", "place", "rank", "doc", "score"] and found.collect() == []


def test_heaps_over_many_steps():
    rng = np.random.default_rng(3)
    scores, ids = rng.integers(0, 6, (500, 4)), rng.integers(0, 200, 500)
    heaps = Heaps(4, 7)
    for start in range(0, 500, 13):
        part = slice(start, start + 13)
        heaps.add(scores[part], ids[part], np.zeros(len(ids[part]), bool))
    for item in range(4):
        best = sorted((-s, i) for s, i in zip(scores[:, item], ids) if s > 0)[:7]
        mine = heaps.item == item
        assert [(-s, i) for s, i in zip(heaps.score[mine], heaps.doc[mine])] == best
