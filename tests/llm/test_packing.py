"""Packing: ids against the library, whole documents, certified bin counts."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gridloom.llm import packing, tokens


def library_ids(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def odd_texts(seed, n=300):
    draw = random.Random(seed)
    chars = [chr(c) for c in range(0x260) if not 0xD800 <= c < 0xE000] + list(" \n\t'  ab")*20 + ["'s", "'ll", "<|endoftext|>", "<", "|", "漢", "🙂", " "]
    return ["".join(draw.choice(chars) for _ in range(draw.randrange(60))) for _ in range(n)]


def test_ids_equal_the_library():
    texts = [*odd_texts(1), "", " ", "\n\n x", "a" * 5000, "It's  we'll\x1c\x85\xa0 x ²³½ 12", "<|endoftext|>x"]
    got = tokens.byte_level("byte_bpe_50k.json").ids(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == library_ids(texts)


def test_cuts_equal_the_rule():
    """Joined texts are cut as the rule cuts each of them."""
    letters, numbers, spaces = tokens.LETTERS, tokens.NUMBERS, tokens.SPACES
    rule = re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+"
        f"| ?[^{spaces}{letters}{numbers}]+|[{spaces}]+(?![^{spaces}])|[{spaces}]+"
    )
    draw = random.Random(4)
    chars = [chr(c) for c in range(tokens.PLAIN)] + list(" \n\x85\xa0''strevmlldS1²é.") * 30
    for _ in range(2000):
        texts = ["".join(draw.choices(chars, k=draw.randrange(12))) for _ in range(6)] + ["x"]
        edges = np.cumsum([0, *(len(text.encode()) for text in texts)])
        joined = "".join(texts).encode()
        begins = tokens.cuts(np.frombuffer(joined, np.uint8), edges[:-1][np.diff(edges) > 0])
        got = [joined[a:b].decode() for a, b in zip(begins, [*begins[1:], None], strict=True)]
        assert got == [part for text in texts for part in rule.findall(text)]


def test_each_different_pre_token_is_looked_up_once(monkeypatch):
    asked = []
    learned = tokens.Known.learned

    def counted(self, parts, find):
        known = learned(self, parts, find)
        return lambda part: asked.append(part) or known(part)

    monkeypatch.setattr(tokens.Known, "learned", counted)
    texts = ["the same few words, " * 500] * 20 + ["", "漢字"]
    got = tokens.ByteLevel("byte_bpe_50k.json").ids(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == library_ids(texts)
    assert len(asked) == len(set(asked)) <= 7


@pytest.mark.parametrize("seed", range(30))
def test_bounds_hold(seed):
    draw = random.Random(seed)
    size = draw.choice([10, 12, 60])
    lengths = np.array(sorted((draw.randrange(1, size) for _ in range(draw.randrange(1, 9))), reverse=True))
    best = [len(lengths)]

    def place(i, rooms):  # exact search
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for j in range(len(rooms)):
            if rooms[j] >= lengths[i]:
                place(i + 1, [*rooms[:j], rooms[j] - lengths[i], *rooms[j + 1 :]])
        place(i + 1, [*rooms, size - lengths[i]])

    place(0, [])
    where, _, bins = packing.best_fit(lengths, size)
    assert packing.lower_bound(lengths, size) <= best[0] <= bins
    assert np.bincount(where, weights=lengths).max() <= size


def check(rows, docs, size):
    """The packing of (doc_id, text) rows holds all ids, each once, without gaps."""
    ids = [[*found, 2] for found in library_ids([text or "" for _, text in docs])]
    want = []
    for (doc_id, _), own in zip(docs, ids, strict=True):
        first = len(own) % size or size
        cuts = [0, *range(first, len(own) + 1, size)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want.append((doc_id, piece, a, b - a, zlib.crc32(np.array(own[a:b], "<u4").tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str) == sorted(want, key=str)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences), packing.lower_bound(np.array([w[3] for w in want], dtype=np.int64), size)


def test_packs_whole_documents(spark):
    draw = random.Random(3)
    docs = [(i, " ".join(f"w{draw.randrange(99)}" for _ in range(draw.randrange(200)))) for i in range(150)]
    docs += [(None, "x"), (7, None), (7, ""), (7, ""), (None, "x"), (200, "long text " * 5000)]
    table = spark.createDataFrame([(*d, 1, "p") for d in docs], "doc_id long, text string, length int, piece string")
    for dealt in (packing.DEALT, 25):
        rows = packing.packed(table, size=64, dealt=dealt).collect()
        bins, bound = check(rows, docs, 64)
        assert bound <= bins <= bound * 1.02 + 3
    assert any(r.certified for r in rows)
    assert packing.packed(table.limit(0)).collect() == []


def test_query_meets_the_bound(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    bins, bound = check(packing.op1_best_fit_packing(spark, sf_dir).collect(), docs, 1024)
    assert bins <= bound + 3


def test_caches_keep_what_is_used(monkeypatch):
    """Generations of a few pre-tokens give the same ids as one of all."""
    monkeypatch.setattr(tokens, "CACHED", 5)
    texts = odd_texts(2, 200)
    small = tokens.ByteLevel("byte_bpe_50k.json")
    got = [small.ids(texts[at : at + 3]) for at in range(0, len(texts), 3)]
    assert [np.frombuffer(g, "<u4").tolist() for batch in got for g in batch] == library_ids(texts)


def test_repeated_rows_are_dealt_evenly(spark, monkeypatch):
    """Rows equal in all columns do not end up in one group."""
    sizes = spark.sparkContext.accumulator(0)
    kind = packing._packed

    def counted(group, size):
        sizes.add(len(group) ** 2)
        return kind(group, size)

    monkeypatch.setattr(packing, "_packed", counted)
    docs = spark.createDataFrame([(None, "the same words")] * 2000, "doc_id long, text string")
    assert len(packing.packed(docs, size=64, dealt=100).collect()) == 2000
    assert sizes.value < packing.ROUNDS * 2000 * 200
