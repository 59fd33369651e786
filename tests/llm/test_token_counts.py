"""Counts against the library itself."""

import random

import public_tokenizers
import pytest
from test_packing import odd_texts
from tokenizers import Tokenizer

from gridloom.llm import token_counts


def library_counts(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


@pytest.fixture(scope="module")
def whole():
    return token_counts.proven()


def test_proven_strings_are_one_token(whole):
    some = random.Random(1).sample(sorted(whole), 3000)
    assert library_counts(some) == [1] * 3000
    assert len(whole) > 20_000


def test_counts_equal_the_library(whole):
    texts = [*odd_texts(7, 600), "İstanbul Ⱥ Ⱦ", "It's THE we'll''s '' 's", "<|endoftext|> x", "a" * 3000, "ÀÉÎ ǅ ǆ ŉ ĸ", "\x1c\x1f\x85\xa0a", "", "é"]
    assert token_counts.Counter("word_bpe_49k.json", whole).counts(texts) == library_counts(texts)


PIECES = [
    "\u201cquoted\u201d", "it\u2019s", "\u2014", "漢字", "漢" * 90, "ΟΔΟΣ", "ΣΑΣ,ΣΣ", "σς", "e\u0301", "\u0301", "\u200b", "\u200d", "\ufeff", "\u2003", "\u3000",
    "\u0345Σ", "İ", "K", "ﬁ", "<|startoftext|>", "<|endoftext|>", "<|end", "\u00a0", "\x85", "\x1c", "\x00", "가각", "ᄀ", "ᅡ", "🙂", "👨\u200d👩", "plain", "don't", "x1", "...",
    "'ll", "\u0958", "\U0001d15e", "\u1e9e", "ǆ", "ŉ",
]


def test_texts_with_other_characters(whole):
    """Runs between white space are cut off only where the library's result stays the same."""
    draw = random.Random(11)
    spaces = [" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x0c", "", ""]
    texts = ["".join(draw.choice(PIECES) + draw.choice(spaces) for _ in range(draw.randrange(1, 14))) for _ in range(6000)]
    texts += [draw.choice(spaces[:7]) + a + s + b for a in PIECES for b in PIECES for s in (" ", "\n")]
    assert token_counts.Counter("word_bpe_49k.json", whole).counts(texts) == library_counts(texts)


def test_only_runs_with_other_characters_go_to_the_library(whole, monkeypatch):
    counter = token_counts.Counter("word_bpe_49k.json", whole)
    asked = []
    counts = token_counts._counts
    monkeypatch.setattr(token_counts, "_counts", lambda t, texts: asked.extend(texts) or counts(t, texts))
    counter.counts(["the of and in \u201cto\u201d the of " + "漢" * 100] * 3)
    assert sorted(asked) == sorted(["\u201cto\u201d", *["漢" * 100] * 3])


def test_every_document(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in token_counts.op4_token_counts(spark, sf_dir).collect()}
    counts = library_counts([r.text for r in docs])
    assert got == {r.doc_id: (len(r.text.encode()), n, n > 2048) for r, n in zip(docs, counts, strict=True)}


def test_odd_rows(spark):
    long = " ".join(f"word{i}" for i in range(30_000))
    rows = [(None, None, 1), (1, "", 2), (1, "", 2), (2, long, 3), (None, "é漢 x", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted((tuple(r) for r in token_counts.token_counts(docs).collect()), key=str)
    texts = [r[1] or "" for r in rows]
    want = [(r[0], len(t.encode()), n, n > 2048) for r, t, n in zip(rows, texts, library_counts(texts), strict=True)]
    assert got == sorted(want, key=str)
    assert token_counts.token_counts(docs.limit(0)).collect() == []
