"""Language of whole texts by a byte convolutional network.

Bytes are embedded, filters of several widths run over them, each filter keeps
its greatest response in the window, and a softmax over the learned languages
follows.  The network is trained in numpy on windows of labelled documents.  A
text is cut into windows of ``WINDOW`` bytes, the last one filled up, which are
classified in batches; the text's language is the one with the greatest mean
probability over its windows, each weighted by its bytes.

Training takes about ``SAMPLE`` different texts, shared out evenly over the languages
and picked by hash over all labelled ones, at least one of every language, and at most
``ROW_WINDOWS`` windows of each, evenly spaced.  How often a text is repeated changes
nothing.  Prediction reads every whole text and nothing but the text.

Null texts and texts without a letter are ``und`` with score 0, as is everything
if no document has a language.  Rows with a null doc_id are predicted but neither
learned from nor held out.  Repeated rows are each predicted.  An empty table
gives an empty result.  Further columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridloom.llm.common import LOWER_AZ, Scratch, batches, table, utf8

WINDOW = 256
SAMPLE = 2400
ROW_WINDOWS = 4
EMBEDDED = 8
#: Even, so a filter's response is a sum of one number per pair of bytes.
WIDTHS = (2, 4)
FILTERS = 16
STEPS = 400
BATCH = 64
RATE = 0.004
#: Documents are held out of all learning where crc32(doc_id) mod FOLDS is HELD_OUT.
FOLDS, HELD_OUT = 4, 2
#: Windows classified at a time.
TOGETHER = 32

_LETTER = re.compile(r"[^\W\d_]")
_FILL = 256  # the symbol after the 256 bytes


@dataclass
class Network:
    embedding: np.ndarray  # 257 x EMBEDDED
    filters: list[np.ndarray]  # per width: width * EMBEDDED x FILTERS
    biases: list[np.ndarray]
    output: np.ndarray  # filters of all widths x languages
    constant: np.ndarray

    @classmethod
    def fresh(cls, languages: int, draw: np.random.Generator) -> Network:
        normal = lambda *shape: draw.normal(size=shape).astype(np.float32)
        return cls(
            normal(257, EMBEDDED) * 0.5,
            [normal(w * EMBEDDED, FILTERS) / np.sqrt(w * EMBEDDED) for w in WIDTHS],
            [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
            normal(len(WIDTHS) * FILTERS, languages) * 0.1,
            np.zeros(languages, np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.biases, self.output, self.constant]

    def responses(self, windows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per width the columns (the embedded bytes at each place) and all responses."""
        embedded = self.embedding[windows]
        n, length, size = embedded.shape
        whole, step, item = embedded.strides
        for width, weights in zip(WIDTHS, self.filters, strict=True):
            # Neighbouring bytes are neighbours in memory: a column is a slice.
            slid = np.lib.stride_tricks.as_strided(
                embedded, (n, length - width + 1, width * size), (whole, step, item), writeable=False
            )
            column = slid.reshape(-1, width * size)
            yield column, (column @ weights).reshape(n, length - width + 1, FILTERS)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        best = [r.max(axis=1) + bias for (_, r), bias in zip(self.responses(windows), self.biases, strict=True)]
        return self._top(best)

    def _top(self, best: list[np.ndarray]) -> np.ndarray:
        return _softmax(np.maximum(np.concatenate(best, axis=1), 0) @ self.output + self.constant)

    def pair_tables(self) -> list[list[np.ndarray]]:
        """Per width and pair of places what each two bytes add to the responses."""
        out = []
        for width, weights in zip(WIDTHS, self.filters, strict=True):
            single = [self.embedding @ weights[j * EMBEDDED : (j + 1) * EMBEDDED] for j in range(width)]
            out.append(
                [(single[j][:, None] + single[j + 1][None]).reshape(-1, FILTERS) for j in range(0, width, 2)]
            )
        return out

    def looked_up(self, windows: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        """The same probabilities, by looking responses up instead of multiplying."""
        pairs = windows[:, :-1].astype(np.int32) * 257 + windows[:, 1:]
        best = []
        for width, parts, bias in zip(WIDTHS, tables, self.biases, strict=True):
            places = windows.shape[1] - width + 1
            response = parts[0].take(pairs[:, :places], axis=0)
            for n, part in enumerate(parts[1:], 1):
                response += part.take(pairs[:, 2 * n : 2 * n + places], axis=0)
            best.append(response.max(axis=1) + bias)
        return self._top(best)

    def gradients(self, windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        columns, places, best = [], [], []
        for (column, response), bias in zip(self.responses(windows), self.biases, strict=True):
            place = response.argmax(axis=1)
            best.append(np.take_along_axis(response, place[:, None, :], axis=1)[:, 0] + bias)
            columns.append(column)
            places.append(place)
        pooled = np.maximum(np.concatenate(best, axis=1), 0)
        error = _softmax(pooled @ self.output + self.constant)
        error[np.arange(len(labels)), labels] -= 1
        error /= len(labels)
        below = (error @ self.output.T) * (pooled > 0)
        embedding, filters, biases = np.zeros_like(self.embedding), [], []
        n, length = windows.shape
        for i, (width, weights) in enumerate(zip(WIDTHS, self.filters, strict=True)):
            part = below[:, i * FILTERS : (i + 1) * FILTERS]
            at = places[i] + np.arange(n)[:, None] * (length - width + 1)
            chosen = columns[i][at]  # n x FILTERS x width * EMBEDDED
            filters.append(np.einsum("nf,nfk->kf", part, chosen))
            biases.append(part.sum(axis=0))
            back = (part[:, :, None] * weights.T[None]).reshape(n, FILTERS, width, EMBEDDED)
            symbols = windows[np.arange(n)[:, None, None], places[i][:, :, None] + np.arange(width)]
            np.add.at(embedding, symbols.ravel(), back.reshape(-1, EMBEDDED))
        return [embedding, *filters, *biases, pooled.T @ error, error.sum(axis=0)]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows_of(text: bytes) -> np.ndarray:
    """All windows of a whole text, A-Z in lower case, the last one filled up."""
    symbols = np.frombuffer(text.translate(LOWER_AZ), dtype=np.uint8)
    rows = max(1, -(-len(symbols) // WINDOW))
    out = np.full(rows * WINDOW, _FILL, dtype=np.int16)
    out[: len(symbols)] = symbols
    return out.reshape(rows, WINDOW)


def train(windows: np.ndarray, labels: np.ndarray, languages: int, seed: int = 1) -> Network:
    """Adam on the cross entropy; every language is drawn equally often."""
    draw = np.random.default_rng(seed)
    network = Network.fresh(languages, draw)
    parameters = network.parameters()
    first = [np.zeros_like(p) for p in parameters]
    second = [np.zeros_like(p) for p in parameters]
    of = [np.flatnonzero(labels == k) for k in range(languages)]
    for step in range(1, STEPS + 1):
        kinds = draw.integers(0, languages, BATCH)
        chosen = np.array([of[k][draw.integers(len(of[k]))] for k in kinds])
        rate = RATE * min(1, 2 * (1 - step / (STEPS + 1)))
        for p, g, m, v in zip(parameters, network.gradients(windows[chosen], kinds), first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return network


def _some_windows(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows):
        langs, out = [], []
        for lang, text in zip(batch.column("lang").to_pylist(), utf8(batch.column("text")), strict=True):
            if _LETTER.search(text.decode("utf-8", "replace")) is None:
                continue
            cut = [text[at : at + WINDOW] for at in range(0, len(text), WINDOW)]
            step = max(1, len(cut) // ROW_WINDOWS)
            for piece in cut[::step][:ROW_WINDOWS]:
                langs.append(lang)
                out.append(piece)
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.binary())], ["lang", "window"])


def fit(docs: DataFrame) -> tuple[list[str], Network] | None:
    """The learned languages and the network, or None if there is no language."""
    scratch = Scratch(docs.sparkSession, "language")
    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
    known = docs.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & (fold != HELD_OUT)
    )
    known = known.where(F.col("text").rlike(r"\p{L}")).select("lang", "text", F.xxhash64("text").alias("hash"))
    # Written: one row per language, of its different texts.
    different = known.select("lang", "hash").distinct()
    counts = scratch.settle(different.groupBy("lang").agg(F.count("*").alias("n"), F.min("hash").alias("least")))
    languages = counts.count()
    if not languages:
        return None
    share = (SAMPLE / languages) / F.col("n")
    draw = F.pmod("hash", F.lit(1 << 30)) / float(1 << 30)
    # An even share of the sample per language, and its text with the least hash in any case.
    drawn = known.join(counts, "lang").where((draw < share) | (F.col("hash") == F.col("least")))
    chosen = drawn.groupBy("lang", "hash").agg(F.min("text").alias("text")).select("lang", "text")
    pieces = chosen.mapInArrow(_some_windows, "lang string, window binary").collect()
    scratch.drop(counts)
    if not pieces:
        return None
    rows = sorted((r["lang"], bytes(r["window"])) for r in pieces)
    names = sorted({lang for lang, _ in rows})
    windows = np.concatenate([windows_of(window) for _, window in rows])
    labels = np.array([names.index(lang) for lang, _ in rows])
    return names, train(windows, labels, len(names))


def _predicted(rows: Iterator[pa.RecordBatch], model: tuple[list[str], Network] | None) -> Iterator[pa.RecordBatch]:
    tables = model[1].pair_tables() if model else []
    for batch in batches(rows, 4 << 20):
        langs, scores = [], []
        texts = utf8(batch.column("text"))
        plain = [text if model and _LETTER.search(text.decode("utf-8", "replace")) else None for text in texts]
        cut = [windows_of(text) for text in plain if text is not None]
        if cut:
            windows = np.concatenate(cut)
            filled = (windows != _FILL).sum(axis=1)
            found = np.concatenate(
                [model[1].looked_up(windows[at : at + TOGETHER], tables) for at in range(0, len(windows), TOGETHER)]
            )
            starts = np.cumsum([0, *map(len, cut)])[:-1]
            total = np.add.reduceat(found * filled[:, None], starts, axis=0)
            mean = iter(total / np.add.reduceat(filled, starts)[:, None])
        for text in plain:
            if text is None:
                langs.append("und")
                scores.append(0.0)
            else:
                own = next(mean)
                langs.append(model[0][int(own.argmax())])
                scores.append(min(1.0, float(own.max())))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
            ["doc_id", "lang_pred", "score"],
        )


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    model = fit(docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = texts.mapInArrow(partial(_predicted, model=model), "doc_id long, lang_pred string, score double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))
