"""Toxicity by compression distance to two zstandard dictionaries.

Text is cut into windows of whole words, ``WINDOW`` bytes or a little more.  Each
window is compressed with a dictionary of ordinary text and with one of toxic
text; a window that the toxic one shortens by more holds what toxic documents
write and others do not.

Both dictionaries are raw content trained on labelled documents, of which near
copies count once.  The ordinary one holds the beginnings of ordinary documents.
The toxic one holds the same, so common words cost the same under both, and before
it the word beginnings that are most telling for toxic documents, each with its
commonest words.  (Contents that
zstandard's own trainer picks separate the classes worse: what is frequent in
toxic text is mostly what is frequent in all text.)

Per document the differences of all windows are summed up (the greatest four,
their means, how many reach one to six bytes, how many windows there are), and a
logistic model turns them into a score.  It is calibrated on the two halves of the
labelled documents, each measured with dictionaries of the other half.

Training uses at most about ``PER_CLASS`` documents of each class, picked by hash
over all labelled ones.  Dictionaries see ``ROW_BYTES`` bytes of each in even
slices, the calibration whole texts.  Scoring reads every whole text.

Null text counts as empty and is scored as one empty window.  Labels without a
document, null labels and null ids are not learned from; of several labels of one
document the highest counts.  Without documents of both classes in either half every
score is 0.
Repeated rows are each scored.  An empty table gives an empty result.  Further columns,
whatever their names, are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridloom.llm.common import LOWER_AZ, Scratch, batches, table, utf8

WINDOW = 48
LONGEST_WORD = 256
PER_CLASS = 4000
ROW_BYTES = 16_384
SLICE = 1024
BASE_BYTES = 8192
BASE_BEGINNING = 200
STEMS = 32
FORMS = 12
#: A word beginning counts from this many toxic documents, and this share of them, on,
#: and if toxic documents have it so many times as often as others.
LEAST_DOCUMENTS, LEAST_SHARE, LEAST_RATIO = 4, 0.01, 4.0
STEM_SIZES = (4, 5, 6, 8, 11)
LEVEL = 9
#: Windows added to a text's own where shares of its windows are taken.
FEW = 8
#: Toxic documents are rare; missing one weighs this much more in the calibration.
TOXIC_WEIGHT = 2.0
#: Documents are held out of all learning where crc32(doc_id) mod FOLDS is HELD_OUT.
FOLDS, HELD_OUT = 5, 0

_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def windows(text: bytes, size: int = WINDOW) -> list[bytes]:
    """A whole text, A-Z in lower case, as windows of whole words; one at least."""
    out, now, length = [], [], 0
    for word in text.translate(LOWER_AZ).split():
        for at in range(0, len(word), LONGEST_WORD):
            piece = word[at : at + LONGEST_WORD]
            now.append(piece)
            length += len(piece) + 1
            if length >= size:
                out.append(b" " + b" ".join(now))
                now, length = [], 0
    if now or not out:
        out.append(b" " + b" ".join(now))
    return out


@lru_cache(maxsize=8)
def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, min_match=4, write_checksum=False, write_content_size=False, write_dict_id=False
    )
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters)


def features(text: bytes, toxic: bytes, ordinary: bytes) -> list[float]:
    with_toxic, with_ordinary = _compressor(toxic).compress, _compressor(ordinary).compress
    saved = np.array(
        [len(with_ordinary(window)) - len(with_toxic(window)) for window in windows(text)], dtype=np.float64
    )
    top = np.sort(np.r_[saved, [0.0, 0.0, 0.0]])[::-1][:4]
    windows_ = len(saved) + FEW  # a chance hit in a short text is no high share
    return [
        *top,
        float(saved.sum() / windows_),
        float(np.maximum(saved, 0).sum() / windows_),
        *[float((saved >= least).sum() / windows_) for least in (1, 2, 3, 4)],
        *[float(min(10, (saved >= least).sum())) for least in (2, 3, 4, 5, 6)],
        float(np.log(len(saved))),
    ]


def _stems(text: bytes) -> set[bytes]:
    return {word[:n] for word in text.translate(_WORDS).split() for n in STEM_SIZES if len(word) >= n}


def _apart(texts: list[bytes]) -> list[bytes]:
    """The texts without near copies: those that share a least or greatest five-word hash."""
    seen: set[tuple[bool, int]] = set()
    out = []
    for text in texts:
        words = text.translate(_WORDS).split()
        hashes = [xxhash.xxh64_intdigest(b" ".join(words[at : at + 5])) for at in range(max(1, len(words) - 4))]
        ends = {(False, min(hashes)), (True, max(hashes))}
        if not ends & seen:
            seen |= ends
            out.append(text)
    return out


def train_dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    """Contents of the toxic and the ordinary dictionary."""
    toxic, ordinary = _apart(toxic), _apart(ordinary)
    own, other = Counter(), Counter()
    for text in toxic:
        own.update(_stems(text))
    for text in ordinary:
        other.update(_stems(text))
    telling = {}
    for stem, n in own.items():
        p, q = (n + 0.5) / (len(toxic) + 1), (other[stem] + 0.5) / (len(ordinary) + 1)
        if n >= max(LEAST_DOCUMENTS, LEAST_SHARE * len(toxic)) and p > LEAST_RATIO * q:
            telling[stem] = (p - q) * np.log(p / q)
    kept: list[bytes] = []
    for stem in sorted(telling, key=lambda stem: (-telling[stem], stem)):
        if not any(stem.startswith(k) or k.startswith(stem) for k in kept):
            kept.append(stem)
            if len(kept) == STEMS:
                break
    # Longer matches save more, so the commonest words of each beginning are written out.
    words = Counter(word for text in toxic for word in set(text.translate(_WORDS).split()))
    beginnings: dict[bytes, list[bytes]] = {stem: [] for stem in kept}
    for word, _ in sorted(words.items(), key=lambda item: (-item[1], item[0])):
        for n in STEM_SIZES:
            if len(beginnings.get(word[:n], range(FORMS))) < FORMS:
                beginnings[word[:n]].append(word)
    forms = [word for stem in kept for word in [stem, *beginnings[stem]]]
    base = b"".join(text[:BASE_BEGINNING].translate(LOWER_AZ) for text in ordinary)[:BASE_BYTES]
    return b" " + b" ".join(forms[::-1]) + b" " + base, b" " + base


def calibrate(rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Logistic weights by Newton's method: one per feature, then the constant."""
    scale = rows.std(axis=0) + 1e-9
    x = np.c_[rows / scale, np.ones(len(rows))]
    cost = np.where(labels == 1, TOXIC_WEIGHT, 1.0)
    weights = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (cost * (p - labels)) + weights
        step = np.linalg.solve((x * (cost * p * (1 - p))[:, None]).T @ x + ridge, gradient)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    weights[:-1] /= scale
    return weights


def _sliced(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Up to ROW_BYTES of each text, in even slices."""
    for batch in batches(rows):
        out = []
        for text in utf8(batch.column("text")):
            parts = ROW_BYTES // SLICE
            if len(text) > ROW_BYTES:
                step = (len(text) - SLICE) // (parts - 1)
                text = b" ".join(text[at * step : at * step + SLICE] for at in range(parts))
            out.append(text)
        yield pa.RecordBatch.from_arrays(
            [batch.column("half"), batch.column("toxic"), pa.array(out, pa.binary())], ["half", "toxic", "text"]
        )


def _featured(rows: Iterator[pa.RecordBatch], contents: list[tuple[bytes, bytes]]) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows):
        halves = batch.column("half").to_pylist()
        found = [features(text, *contents[half]) for text, half in zip(utf8(batch.column("text")), halves, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.list_(pa.float64()))], ["toxic", "x"])


def _scored(rows: Iterator[pa.RecordBatch], model: tuple[bytes, bytes, np.ndarray] | None) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows):
        texts = utf8(batch.column("text"))
        if model is None:
            scores = np.zeros(len(texts))
        else:
            toxic, ordinary, weights = model
            x = np.array([features(text, toxic, ordinary) for text in texts])
            scores = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])


def _fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % FOLDS


def sampled(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """text, toxic and half (0 or 1) of the training documents, a written table."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (_fold() != HELD_OUT))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, min(1.0, PER_CLASS / max(1, counts.get(1, 0)))).otherwise(
        min(1.0, PER_CLASS / max(1, counts.get(0, 0)))
    )
    chosen = scratch.settle(known.where(draw < share).select("doc_id", "toxic", F.pmod(F.hash("doc_id"), F.lit(2)).cast("int").alias("half")))
    # About 2 * PER_CLASS rows by construction; of a repeated doc_id the least text.
    once = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic", "half").agg(F.min("text").alias("text"))
    return scratch.settle(once.select("text", "toxic", "half"))


def fit(docs: DataFrame, labels: DataFrame) -> tuple[bytes, bytes, np.ndarray] | None:
    """Both dictionaries and the calibration, or None without both classes."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    sample = sampled(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels, scratch)
    pieces = sample.select("half", "toxic", "text").mapInArrow(_sliced, "half int, toxic int, text binary").collect()
    # In an order that depends on nothing but the texts, and mixes them.
    texts = sorted(
        ((r["half"], r["toxic"], bytes(r["text"])) for r in pieces), key=lambda row: xxhash.xxh64_intdigest(row[2])
    )

    def trained(halves: tuple[int, ...]) -> tuple[bytes, bytes] | None:
        toxic, ordinary = ([t for half, label, t in texts if half in halves and label == kind] for kind in (1, 0))
        return train_dictionaries(toxic, ordinary) if toxic and ordinary else None

    # Each half is measured with dictionaries of the other one, so the calibration
    # sees documents as new ones; the dictionaries that stay are trained on both.
    crossed, whole = [trained((1,)), trained((0,))], trained((0, 1))
    if whole is None or None in crossed:
        return None
    rest = sample.select("half", "toxic", "text").mapInArrow(
        partial(_featured, contents=crossed), "toxic int, x array<double>"
    ).collect()
    rest.sort()
    return *whole, calibrate(np.array([r["x"] for r in rest]), np.array([r["toxic"] for r in rest], dtype=np.float64))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = fit(docs, labels)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = texts.mapInArrow(partial(_scored, model=model), "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.coalesce(_fold() == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
