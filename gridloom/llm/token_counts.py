"""Token counts with a whole-token shortcut.

Offline, every string of the vocabulary is encoded alone, and those that come
back as one token are written down.  A text is cut into pre-tokens; the proven
ones count one each without any merging, and only the rest is merged, each
different pre-token once per process while it stays in a bounded cache.

The cutting rule is stated for characters whose lower case is one character
below ``tokens.PLAIN``.  No token reaches over white space, so a text with others, or with
the opening of a special token, is cut there, and only the runs that hold such characters go
through the library, each different short one once; special strings are handled as its default.

Null text counts as empty: no bytes, no tokens.  Repeated rows and null ids are
returned as they are; further columns are ignored.  An empty table gives an empty
result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache, partial

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer
from tokenizers.decoders import ByteLevel

from gridloom.llm import tokens
from gridloom.llm.common import batches, table
from gridloom.llm.tokens import LETTERS, NUMBERS, PLAIN, SPACES

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
WORD_END = "</w>"

_RULE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+")
#: Upper case that leaves the plain range when it is lower-cased.
_LEAVES = "".join(chr(p) for p in range(PLAIN) if len(chr(p).lower()) > 1 or ord(chr(p).lower()) >= PLAIN)
_OTHER = re.compile(f"[^\\x00-{chr(PLAIN - 1)}]|[{_LEAVES}]|<\\|")
#: What stands between white space of ASCII, at which every text may be cut.
_RUN = re.compile("[^\t-\r ]+")
#: Longest run, in characters, whose count is kept for later texts.
REMEMBERED = 64


@cache
def _tokenizer(name: str) -> Tokenizer:
    tokenizer = tokens.load(name)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _counts(tokenizer: Tokenizer, texts: list[str]) -> list[int]:
    return [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def proven(name: str = TOKENIZER) -> frozenset[str]:
    """Pre-tokens that the vocabulary encodes as one token, each tried alone."""
    tokenizer = _tokenizer(name)
    bytes_of = ByteLevel()  # vocabulary strings spell bytes; half characters decode to one that is not plain
    words = [bytes_of.decode([s.removesuffix(WORD_END)]) for s in tokenizer.get_vocab() if s.endswith(WORD_END)]
    words = sorted({w for w in words if w and not _OTHER.search(w) and w == w.lower() and _RULE.fullmatch(w)})
    return frozenset(w for w, n in zip(words, _counts(tokenizer, words), strict=True) if n == 1)


def _cut(text: str) -> tuple[list[str], list[str]]:
    """Pre-tokens and runs for the library, and of the latter those too long to be remembered."""
    part, long = [], []
    for run in _RUN.findall(text):
        if not _OTHER.search(run):
            part += _RULE.findall(run.lower())
        elif len(run) <= REMEMBERED:
            part.append(run)
        else:
            long.append(run)
    return part, long


class Counter:
    """Counts texts; ``known`` starts with the proven strings."""

    def __init__(self, name: str, whole: frozenset[str]) -> None:
        self.tokenizer = _tokenizer(name)
        self.known = tokens.Known(dict.fromkeys(whole, 1))

    def counts(self, texts: list[str]) -> list[int]:
        parts, long = [], []
        for text in texts:
            part, runs = (_RULE.findall(text.lower()), []) if not _OTHER.search(text) else _cut(text)
            parts.append(part)
            long.append(runs)
        known = self.known.learned(parts, lambda new: _counts(self.tokenizer, new))
        found = iter(_counts(self.tokenizer, [run for runs in long for run in runs]))
        return [sum(map(known, part)) + sum(next(found) for _ in runs) for part, runs in zip(parts, long, strict=True)]


_counters: dict[str, Counter] = {}


def _counted(rows: Iterator[pa.RecordBatch], name: str, whole: Broadcast) -> Iterator[pa.RecordBatch]:
    if name not in _counters:
        _counters[name] = Counter(name, whole.value)
    for batch in batches(rows, 4 << 20):
        texts = [text or "" for text in batch.column("text").to_pylist()]
        counts = pa.array(_counters[name].counts(texts), pa.int64())
        sizes = pa.array([len(text.encode()) for text in texts], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, counts], ["doc_id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, name: str = TOKENIZER, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document."""
    # Bounded by the vocabulary.
    whole = docs.sparkSession.sparkContext.broadcast(proven(name))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = texts.mapInArrow(partial(_counted, name=name, whole=whole), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
