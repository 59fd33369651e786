"""Repeated passages against brute force, and the suffix order against sorted()."""

import hashlib
import random

import numpy as np
import pytest

from gridloom.llm import suffix
from gridloom.llm.common import Scratch


def plain(texts):
    """(n_bytes, n_removed, n_spans, kept_sha256) of each text."""
    texts = [(t or "").encode() for t in texts]
    seen = {}
    for t in texts:
        for p in range(len(t) - 199):
            seen[t[p : p + 200]] = seen.get(t[p : p + 200], 0) + 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - 199):
            if seen[t[p : p + 200]] > 1:
                gone[p : p + 200] = b"\1" * 200
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def result(spark, rows, hot=None):
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key string, gram int")
    if hot is None:
        return sorted((tuple(r) for r in suffix.removed_bytes(docs).collect()), key=str)
    lost = suffix.repeated_passages(docs, Scratch(spark, "test"), hot)[1]
    return {r["_key"]: (r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in lost.collect()}


def words(draw, n):
    return " ".join("".join(draw.choice("abcdeé ") for _ in range(draw.randrange(2, 9))) for _ in range(n))


def passages(seed):
    draw = random.Random(seed)
    shared = [words(draw, 60) for _ in range(6)]
    texts = []
    for _ in range(40):
        parts = [words(draw, draw.randrange(0, 80))]
        for _ in range(draw.randrange(4)):
            text = draw.choice(shared)
            a = draw.randrange(len(text) // 2)
            parts += [text[a : a + draw.randrange(150, len(text))], words(draw, draw.randrange(30))]
        texts.append("".join(parts))
    texts += [texts[0], texts[0] + "x", "ab" * 300, "z" * 700, "z" * 200, "z" * 199, "", None, "q" * 200, "\0" * 300]
    draw.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    texts = passages(seed)
    got = result(spark, [(i, t, "k", 1) for i, t in enumerate(texts)])
    assert got == sorted(((i, *row) for i, row in enumerate(plain(texts))), key=str)


def test_null_and_repeated_ids(spark):
    texts = passages(9)[:14]
    ids = [None, 3, 3, None, *range(4, 14)]
    got = result(spark, [(i, t, None, None) for i, t in zip(ids, texts, strict=True)])
    assert got == sorted(((i, *row) for i, row in zip(ids, plain(texts), strict=True)), key=str)
    assert result(spark, []) == []


def crowds(seed):
    """Passages of 60 to 330 bytes in many texts, each time with other neighbours."""
    draw = random.Random(seed)
    alphabet = "abcdefghijklmnopqrstuvwxyz é"
    text = lambda n: "".join(draw.choice(alphabet) for _ in range(n))
    shared = [text(n) for n in (60, 110, 150, 170, 190, 199, 200, 240, 330)]
    texts = [text(draw.randrange(210)) + passage + text(draw.randrange(210)) for passage in shared for _ in range(25)]
    # Some neighbours are alike for a few bytes on one side.
    texts += [text(30) + "ab" * 15 + passage + "ba" * draw.randrange(9, 12) + text(90) for passage in shared for _ in range(9)]
    return texts + texts[::11]


@pytest.mark.parametrize("hot", [1, 3, 20, 5000])
@pytest.mark.parametrize("texts", [passages(5), crowds(2)], ids=["passages", "crowds"])
def test_crowded_grams_give_the_same(spark, texts, hot):
    rows = [(i, t, "k", 1) for i, t in enumerate(texts)]
    want = {i: row[1:] for i, row in enumerate(plain(texts)) if row[1]}
    got = result(spark, rows, hot)
    assert {k: v for k, v in got.items() if v[0]} == want


@pytest.mark.parametrize("gram", suffix.GRAMS)
def test_equal_strings_share_their_gram(gram):
    texts = [t.encode() for t in crowds(3)[::6] if len(t.encode()) >= 200]
    lengths = np.array([len(t) for t in texts])
    joined = np.frombuffer(b"".join(texts), dtype=np.uint8)
    routes, _, first, size = suffix.contexts(joined, np.repeat(np.cumsum(lengths), lengths), gram)
    assert size.sum() == (lengths - 199).sum()
    seen = {}
    for route, lo, n in zip(routes, first, size, strict=True):
        for p in range(lo, lo + n):
            assert seen.setdefault(joined[p : p + 200].tobytes(), route) == route


def test_long_texts_are_cut_into_blocks(spark, monkeypatch):
    draw = random.Random(1)
    shared = words(draw, 200)
    long = words(draw, 40) + shared + "x" + words(draw, 300_000) + shared[:400]
    assert len(long.encode()) > suffix.BLOCK
    got = result(spark, [(0, long, "", 0), (1, "y" + shared[100:700], "", 0)])
    assert got == sorted(((i, *row) for i, row in enumerate(plain([long, "y" + shared[100:700]]))), key=str)


@pytest.mark.parametrize("alphabet", [b"ab", b"abc", b"a", bytes(range(256))])
def test_suffix_order(alphabet):
    draw = random.Random(len(alphabet))
    text = bytes(draw.choice(alphabet) for _ in range(3000)) + bytes(draw.choice(alphabet) for _ in range(50)) * 9
    order = suffix.suffix_array(np.frombuffer(text, dtype=np.uint8), 200)
    assert sorted(order.tolist()) == list(range(len(text)))
    keys = [text[i : i + 200] for i in order]
    assert all(a.ljust(200, b"\0") <= b.ljust(200, b"\0") for a, b in zip(keys, keys[1:], strict=False))


def test_text_without_repeats(spark):
    shared = "é" * 150 + "passage " * 20
    docs = spark.createDataFrame(
        [(1, "Ab " + shared + "cd", "x", 9), (2, shared + "e", "y", 9), (3, None, "z", None)],
        "doc_id long, text string, _row string, n_chars long",
    )
    got = {r.doc_id: r for r in suffix.without_repeats(docs).collect()}
    assert got[1].text == "Ab cd" and got[1].n_chars == 5 and got[1]["_row"] == "x"
    assert got[2].text == "e" and got[3].text is None and got[3].n_chars is None


@pytest.mark.parametrize("seed", range(20))
def test_repeats_among_valid_starts(seed):
    """Only valid starts repeat each other, whatever else the text holds."""
    draw = random.Random(seed)
    alphabet = draw.choice([b"a", b"ab", b"\0ab", bytes(range(256))])
    parts = [bytes(draw.choices(alphabet, k=draw.randrange(1, 60))) for _ in range(4)]
    text = b"".join(draw.choice(parts)[: draw.randrange(60)] for _ in range(60)) + b"." * 12
    valid = np.array([draw.random() < draw.choice([0.2, 0.9]) for _ in text])
    valid[-11:] = False
    seen = {}
    for place in np.flatnonzero(valid):
        seen.setdefault(text[place : place + 12], []).append(place)
    want = sorted(place for same in seen.values() if len(same) > 1 for place in same)
    assert np.flatnonzero(suffix.repeated_starts(np.frombuffer(text, np.uint8), valid, 12)).tolist() == want


def test_only_needed_suffixes_are_sorted(monkeypatch):
    """Of pieces with few starts each, little more than the starts is sorted."""
    sorted_ = []
    kind = suffix._sorted_directly
    monkeypatch.setattr(suffix, "_sorted_directly", lambda w, places, d: sorted_.append(len(places)) or kind(w, places, d))
    draw = random.Random(1)
    pieces = [draw.randbytes(203) for _ in range(100)]
    pieces.append(b"x" + pieces[0][1:201] + b"yz")
    found = suffix._sort_chunk([(i, 0, piece) for i, piece in enumerate(pieces)]).to_pylist()
    assert sorted((r["_key"], r["lo"], r["n"]) for r in found) == [(0, 1, 1), (100, 1, 1)]
    assert sum(sorted_) <= 101 * 5


def test_covered_ranges_stay_in_their_rows():
    row, lo, n = (np.array(c) for c in zip((1, 500, 2), (0, 300, 9), (1, 0, 5), (0, 0, 100), (1, 204, 1), (3, 0, 1), strict=True))
    got = [c.tolist() for c in suffix.covered(row, lo, n)]
    assert got == [[0, 0, 1, 1, 3], [0, 300, 0, 500, 0], [299, 508, 404, 701, 200]]
