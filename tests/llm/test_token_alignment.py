"""Token alignment against the libraries on whole texts and a plain search for overlaps."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from engagement_lake.llm import token_alignment as module
from engagement_lake.llm.token_alignment import Aligner, Vocabulary, align, aligned_tokens, byte_letters, vocabulary_size

FIRST, SECOND = (public_tokenizers.path(p) for p in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
DDL = "doc_id long, text string, `row` string, pairs int, n string"

ODD = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "  two  spaces  ", "tab\there\nline", "naïve café déjà",
    "don't we'll it's I'm", "<|endoftext|>", "x<|endoftext|> <s></s> <unk> <0x41>", "▁", "x▁y", "a ▁ b", "\x00a\x7f\x1f",
    "中文字符 with 日本語 text", "emoji 👩‍👩‍👧 and é", " nbsp　wide", "ﬁ ligature ½ ™", "3.14 1,000 a-b c_d (x)",
    "ThisIsCamel HTTPServer http://a.b/c?d=e", "!!! ??? ... -- ==", "русский текст и ещё", "ا ب ت عربي", "word " * 3000,
    "unspaced" * 2000, "é" * 50, "àb", " lead", "trail\r\n", "q" * 5000, "x  y   z    w",
]


def plain(texts):
    a_tokens = Tokenizer.from_file(FIRST)
    a_tokens.encode_special_tokens = True
    b_tokens = sentencepiece.SentencePieceProcessor(model_file=SECOND)
    letters = byte_letters()
    rows, all_links = [], Counter()
    for text in texts:
        whole = (" " + text).encode() if text else b""
        a = [(t.id, t.bytes) for t in map(lambda i: Token(i, a_tokens, letters), a_tokens.encode(" " + (text or ""), add_special_tokens=False).ids)] if text else []
        b = [(i, piece_bytes(b_tokens, i)) for i in b_tokens.encode(text or "")] if text else []
        if b"".join(t for _, t in a) != whole or b"".join(t for _, t in b) != whole:
            a, b = [], []
        spans = []
        for tokens in (a, b):
            at, some = 0, []
            for i, t in tokens:
                some.append((i, at, at + len(t)))
                at += len(t)
            spans.append(some)
        ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, before = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, s, e in some if before < e <= end) for some in spans))
            before = end
        links, j = [], 0
        for i, s, e in spans[0]:
            while j and spans[1][j - 1][2] > s:
                j -= 1
            while j < len(spans[1]) and spans[1][j][1] < e:
                if spans[1][j][2] > s:
                    links.append((i, spans[1][j][0]))
                j += 1
        all_links.update(links)
        rows.append((len(a), len(b), groups, links))
    most = {}
    for (_, b), n in all_links.items():
        most[b] = max(most.get(b, 0), n)
    return [
        (n_a, n_b, len(groups), len(links), sum(all_links[p] == most[p[1]] for p in links),
         sum(all_links[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "")
        for n_a, n_b, groups, links in rows
    ]


class Token:
    def __init__(self, i, tokenizer, letters):
        self.id, self.bytes = i, bytes(letters[c] for c in tokenizer.id_to_token(i))


def piece_bytes(tokenizer, i):
    piece = tokenizer.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if tokenizer.is_byte(i) else piece.replace("▁", " ").encode()


def found_of(df):
    rows = aligned_tokens(df, FIRST, SECOND, vocabulary_size(SECOND)).collect()
    return sorted(
        ((r.key, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.digest.hex()) for r in rows), key=repr
    )


def made_texts():
    random.seed(9)
    parts = ["the", "The", " ", "  ", "\n", "ing", "tion", "é", "中", "'s", "12", ".", "<s>", "▁", "Ж", "\x01", "-", " ", " of", " a"]
    return ["".join(random.choices(parts, k=random.randint(1, 25))) for _ in range(400)]


@pytest.mark.parametrize("hot", [1 << 19, 40, 0], ids=["all pairs broadcast", "some", "none"])
def test_alignment_is_that_of_whole_texts(spark, monkeypatch, hot):
    monkeypatch.setattr(module, "HOT_PAIRS", hot)
    texts = [*ODD, *made_texts(), ODD[9], ODD[9]]
    df = spark.createDataFrame([(i, t, "x", 1, None) for i, t in enumerate(texts)], DDL).repartition(5)
    assert found_of(df) == sorted(((i, *row) for i, row in enumerate(plain(texts))), key=repr)


def test_forgetting_windows_changes_nothing(spark, monkeypatch):
    with open(FIRST, encoding="utf-8") as a, open(SECOND, "rb") as b:
        files = a.read(), b.read()
    whole = Aligner(*files)
    monkeypatch.setattr(module, "WINDOWS_REMEMBERED", 3)
    forgetful = Aligner(*files)
    for text in made_texts()[:60]:
        one, other = whole(pa.array([text, "the same"])), forgetful(pa.array([text, "the same"]))
        assert one.digests == other.digests and one.pairs.tolist() == other.pairs.tolist()
    assert len(forgetful.windows.index) <= 20


def test_windows_are_aligned_one_by_one():
    a = Vocabulary([b"", b"x", b"y", b"zz", b"uvw"])
    b = Vocabulary([b"", b"xy", b"zz", b"u", b"vwx"])
    texts, groups, links, pairs = align(
        a, np.array([3, 2]), np.array([1, 2, 3, 4, 1]), b, np.array([2, 2]), np.array([1, 2, 3, 4])
    )
    assert texts == ["1,2|1;3|2;", "4,1|3,4;"] and groups.tolist() == [2, 1] and links.tolist() == [3, 3]
    assert [divmod(p, 5) for p in pairs.tolist()] == [(1, 1), (2, 1), (3, 2), (4, 3), (4, 4), (1, 4)]


def test_repeated_and_null_ids_and_empty_table(spark):
    rows = [(1, "a text", "x", 1, None), (1, "a text", "x", 1, None), (None, "a text", "x", 1, None), (2, None, "x", 1, None)]
    found = found_of(spark.createDataFrame(rows, DDL))
    one = next(r for r in found if r[0] == 1)
    assert [r[1:] for r in found if r[0] != 2] == [one[1:]] * 3 and one[6] == 3 * one[4]
    assert found_of(spark.createDataFrame([], DDL)) == []
