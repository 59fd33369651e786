"""Quality rules judged per host, with rates shrunk by an empirical beta prior.

Each whole text is measured once.  Two base rules reject a document by itself:
fewer than ``MIN_WORDS`` words, or more than half of its words inside three-word
windows that occur twice or more.  Three further rules are weak signs alone
(symbols, repeated lines, odd word lengths), so the host decides about them.

Per host (``source``) and rule, failures are summed.  The rates of all hosts give
a beta prior by their mean and variance; a host's rate is the mean of its
posterior, so a host with few documents stays near the prior.

* A host whose shrunk rate of a weak rule is at least ``SUSPECT`` is suspect for
  it, and its documents that fail that rule are rejected.
* A host whose shrunk rate of base failures is at least ``BLOCKED`` is blocked:
  all of its documents are rejected.

A clean document of any host that is not blocked is kept.

Null and empty texts have no words and fail the first base rule.  A null source
is a host like any other.  Repeated rows count, and are returned, each for
itself.  An empty table gives an empty result.  Further columns, whatever their names,
are passed on by ``kept_documents`` and not read otherwise.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridloom.functions.once import add_once
from gridloom.llm.common import Scratch, table

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
SUSPECT = 0.5
BLOCKED = 0.95
#: Host verdicts are broadcast up to this many hosts with a verdict, else joined by shuffle.
MAX_BROADCAST_HOSTS = 100_000

_NOT_SYMBOL = bytes(b for b in range(256) if b not in SYMBOLS)


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more, the first included."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    count = end = 0
    for at, window in enumerate(windows):
        if seen[window] > 1:
            count += at + 3 - max(at, end)
            end = at + 3
    return count


def measure(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a whole text."""
    words = text.split()  # ASCII white space: 0x09-0x0D and 0x20
    joined = b"".join(words)
    chars = len(joined) if joined.isascii() else len(joined.decode("utf-8", "replace"))
    symbols = len(text.translate(None, _NOT_SYMBOL))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


_MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def _measured(texts: pa.Array) -> pa.Array:
    found = []
    for value in texts.cast(pa.binary()):  # one text at a time; only counts are held
        text = value.as_py() or b""
        found.append((*measure(text), sum(1 for line in text.split(b"\n") if line.strip())))
    columns = zip(*found, strict=True) if found else [[]] * len(_MEASURES)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], _MEASURES)


def _with_measures(docs: DataFrame, text: str) -> DataFrame:
    """Add ``_measures``, computed once per row whatever later filters ask of it."""
    measures = F.arrow_udf(_measured, ", ".join(f"{name} bigint" for name in _MEASURES))
    return add_once(docs, {"_measures": measures(F.col(text))})


#: Failures of a measured document; all but the first are weak signs.
RULES = {
    "base_failed": f"n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words",
    "symbols_failed": "10 * n_symbols > n_words",
    "lines_failed": "10 * n_dup_lines > 3 * n_lines",
    "length_failed": "word_chars < 3 * n_words or word_chars > 10 * n_words",
}
WEAK = [rule for rule in RULES if rule != "base_failed"]


def host_rates(measured: DataFrame) -> DataFrame:
    """source, n and, per rule, the shrunk rate of failures.

    The prior's mean is the mean of the hosts' rates, its strength comes from
    their variance: mean * (1 - mean) / variance - 1, within 1 to 1000.
    """
    rules = list(RULES)
    hosts = measured.groupBy("source").agg(
        F.count("*").alias("n"), *[F.sum(F.col(rule).cast("long")).alias(rule) for rule in rules]
    )
    spread = hosts.agg(
        *[F.avg(F.col(rule) / F.col("n")).alias(f"{rule}_mean") for rule in rules],
        *[F.var_pop(F.col(rule) / F.col("n")).alias(f"{rule}_var") for rule in rules],
    )
    out = hosts.crossJoin(F.broadcast(spread))  # one row
    for rule in rules:
        mean, var = F.col(f"{rule}_mean"), F.col(f"{rule}_var")
        # The variance of a rate is below mean * (1 - mean); none means: as strong as allowed.
        strength = F.when(var > 0, F.greatest(F.lit(1.0), F.least(F.lit(1000.0), mean * (1 - mean) / var - 1))).otherwise(1000.0)
        out = out.withColumn(f"{rule}_rate", (F.col(rule) + mean * strength) / (F.col("n") + strength))
    return out.select("source", "n", *[f"{rule}_rate" for rule in rules])


def _verdicts(measured: DataFrame, scratch: Scratch) -> DataFrame:
    """Hosts with a verdict against them: ``_blocked``, and ``_suspect_`` per weak rule."""
    verdicts = scratch.settle(
        host_rates(measured)
        .select(
            # A null key would lose the host's verdict in the join.
            F.coalesce("source", F.lit("")).alias("_host"),
            F.col("source").isNull().alias("_unnamed"),
            (F.col("base_failed_rate") >= BLOCKED).alias("_blocked"),
            *[(F.col(f"{rule}_rate") >= SUSPECT).alias(f"_suspect_{rule}") for rule in WEAK],
        )
        .where(" or ".join(["_blocked", *[f"_suspect_{rule}" for rule in WEAK]]))
    )
    return F.broadcast(verdicts) if verdicts.count() <= MAX_BROADCAST_HOSTS else verdicts


def _judged(ruled: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Add ``_kept`` to documents with their source and rules."""
    against = F.coalesce("_blocked", F.lit(False))
    for rule in WEAK:
        against |= F.coalesce(f"_suspect_{rule}", F.lit(False)) & F.col(rule)
    host = ruled.withColumns({"_host": F.coalesce("source", F.lit("")), "_unnamed": F.col("source").isNull()})
    return host.join(verdicts, ["_host", "_unnamed"], "left").withColumn("_kept", ~F.col("base_failed") & ~against)


def _ruled(docs: DataFrame, *carried: Column) -> DataFrame:
    """``carried`` columns, source, measures and rules of documents (_row)."""
    texts = docs.select(*carried, F.col("_row.source").cast("string").alias("source"), F.col("_row.text").alias("_text"))
    measured = _with_measures(texts, "_text").drop("_text").select("*", "_measures.*").drop("_measures")
    return measured.withColumns({rule: F.expr(text) for rule, text in RULES.items()})


def _packed(docs: DataFrame) -> DataFrame:
    """All columns inside ``_row``, where no name of theirs can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def quality(docs: DataFrame) -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` of every document."""
    scratch = Scratch(docs.sparkSession, "quality")
    ruled = scratch.settle(_ruled(_packed(docs), F.col("_row.doc_id").alias("doc_id")))
    judged = _judged(ruled, _verdicts(ruled, scratch))
    return judged.select("doc_id", *_MEASURES[:5], "base_failed", F.col("_kept").alias("kept"))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns.

    Texts are measured twice, for their host and for themselves, so that they never
    move: only the verdicts are sent to them.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    rows = _packed(docs)
    verdicts = _verdicts(scratch.settle(_ruled(rows)), scratch)
    return _judged(_ruled(rows, F.col("_row")), verdicts).where("_kept").select("_row.*")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


_RATE = "({rule} + {rule}_mean * {rule}_strength) / (n + {rule}_strength)"


def _sql() -> str:
    rules = list(RULES)
    spread = ", ".join(
        f"avg({r} / n::double) {r}_mean, var_pop({r} / n::double) {r}_var" for r in rules
    )
    strength = ", ".join(
        f"case when {r}_var > 0 then greatest(1.0, least(1000.0, {r}_mean * (1 - {r}_mean) / {r}_var - 1)) "
        f"else 1000.0 end {r}_strength"
        for r in rules
    )
    suspects = ", ".join(
        f"{_RATE.format(rule=r)} >= {SUSPECT} suspect_{r}" for r in WEAK
    )
    against = " or ".join(f"(h.suspect_{r} and m.{r})" for r in WEAK)
    blank = "[^\\x20\\x09-\\x0D]"
    return f"""
with split as (
  select doc_id, source, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '{blank}+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{blank}')) as lines
  from documents),
rows_ as (select row_number() over () as k, * from split),
windows as (
  select k, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from (select k, w, unnest(range(1, len(w) - 1)) as i from rows_ where len(w) > 2)),
twice as (
  select k, i from windows qualify count(*) over (partition by k, g) > 1),
repeats as (
  select k, count(distinct p) as n from (select k, unnest([i, i + 1, i + 2]) as p from twice) group by k),
measured as (
  select r.k, doc_id, source, len(w)::bigint as n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(repeats.n, 0)::bigint as n_repeat_words, len(lines)::bigint as n_lines
  from rows_ r left join repeats on repeats.k = r.k),
ruled as (
  select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words as base_failed,
    10 * n_symbols > n_words as symbols_failed, 10 * n_dup_lines > 3 * n_lines as lines_failed,
    word_chars < 3 * n_words or word_chars > 10 * n_words as length_failed
  from measured),
hosts as (
  select source, count(*) as n, {", ".join(f"sum({r}::bigint) as {r}" for r in rules)} from ruled group by source),
prior as (select *, {strength} from (select {spread} from hosts)),
verdicts as (
  select source, {_RATE.format(rule="base_failed")} >= {BLOCKED} as blocked, {suspects} from hosts, prior)
select m.doc_id, m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, m.base_failed,
  not m.base_failed and not (h.blocked or {against}) as kept
from ruled m join verdicts h on h.source is not distinct from m.source
"""


ORACLE_SQL = _sql()
