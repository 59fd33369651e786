"""Benchmark decontamination by a positional inverted index.

The words of all documents that also occur in the benchmark are stored as
postings: per term and batch of documents, the documents and word positions.  A
window is ``WINDOW`` consecutive words of an item (an item of fewer words, but
not none, is one window).  From each window its two rarest terms are taken, by
their counts in the whole index; windows with a term that never occurs are done.
The lists of the two terms, shifted by their places in the item, are intersected
per document: what is left are alignments (document, item, shift).  Each is then
verified on the document's words.  The result are exact phrase matches, the
maximal runs of words inside matching windows, or with ``slop`` > 0 proximity
matches, windows whose words all stand within ``slop`` of their places.

The benchmark is the stated query set.  It is handled in blocks of at most about
``BLOCK_WORDS`` words, which bounds what is broadcast; each block reads all
documents.

Null texts have no words.  Items without words never match.  A null item_id
marks words but is not listed or counted; repeated items count once.  Repeated
documents are each returned.  Empty tables give empty or uncontaminated results.
Further columns, whatever their names, are passed on by ``clean_documents`` and not
read otherwise.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridloom.llm.common import Scratch, batches, keyed, table, utf8

WINDOW = 13
BLOCK_WORDS = 1_000_000

#: A-Z becomes a-z, ASCII other than letters and digits becomes a blank.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

Item = tuple[str | None, list[bytes]]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


def _number(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) - (1 << 63)


def _postings(rows: Iterator[pa.RecordBatch], terms: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Per batch and term its documents and positions; the row without a term has the lengths."""
    numbers = np.array([_number(word) for word in terms], dtype=np.int64)
    for batch in batches(rows, 8 << 20):
        keys = batch.column("_key").to_numpy()
        found, lengths = [], []
        for text in utf8(batch.column("text")):
            words = words_of(text)
            lengths.append(len(words))
            found.append(np.array([terms.get(word, -1) for word in words], dtype=np.int32))
        term = np.concatenate(found)
        doc = np.repeat(np.arange(len(keys)), lengths)
        place = np.concatenate([np.arange(n, dtype=np.int32) for n in lengths])
        hit = np.flatnonzero(term >= 0)
        hit = hit[np.argsort(term[hit], kind="stable")]
        term, doc, place = term[hit], doc[hit], place[hit]
        cuts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.empty(0, np.int64)
        bounds = np.r_[0, len(keys) + np.r_[cuts, len(term)]] if len(term) else [0, len(keys)]
        offsets = pa.array(bounds, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None, *numbers[term[cuts]].tolist()], pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(np.r_[keys, keys[doc]])),
                pa.ListArray.from_arrays(offsets, pa.array(np.r_[np.array(lengths, np.int32), place])),
            ],
            ["term", "keys", "places"],
        )


def _probes(items: list[Item], counts: dict[int, int]) -> list[tuple[int, int, int, int, int]]:
    """(item, rarest term, its place, second rarest, its place) of each window that can occur."""
    probes = set()
    for number, (_, words) in enumerate(items):
        terms = [_number(word) for word in words]
        size = min(WINDOW, len(words))
        for start in range(len(words) - size + 1 if size else 0):
            rare = sorted(range(start, start + size), key=lambda at: (counts.get(terms[at], 0), at))[:2]
            a, b = rare[0], rare[-1]
            if counts.get(terms[a], 0):
                probes.add((number, terms[a], a, terms[b], b))
    return sorted(probes)


def _runs(matched: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Maximal runs covered by windows of ``size`` true values."""
    edge = np.flatnonzero(np.diff(np.r_[False, matched, False].astype(np.int8)))
    return [(int(lo), int(hi)) for lo, hi in zip(edge[::2], edge[1::2], strict=True) if hi - lo >= size]


def _verified(rows: Iterator[pa.RecordBatch], items: list[Item], slop: int) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows):
        out = []
        for key, text, pairs in zip(
            batch.column("_key").to_pylist(), utf8(batch.column("text")), batch.column("pairs").to_pylist(), strict=True
        ):
            words = words_of(text)
            for pair in pairs:
                item_id, wanted = items[pair["item"]]
                shift = pair["shift"]
                if slop:
                    near = [
                        word in words[max(0, shift + at - slop) : max(0, shift + at + slop + 1)]
                        for at, word in enumerate(wanted)
                    ]
                else:
                    there = words[max(0, shift) : shift + len(wanted)]
                    near = [a == b for a, b in zip(wanted[max(0, -shift) :], there, strict=False)]
                    near = [False] * max(0, -shift) + near + [False] * (len(wanted) - max(0, -shift) - len(near))
                for lo, hi in _runs(np.array(near, dtype=bool), min(WINDOW, len(wanted))):
                    first, last = max(0, shift + lo - slop), min(len(words), shift + hi + slop)
                    out.append((key, item_id, first, last))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.string(), pa.int32(), pa.int32()), strict=True)],
                ["_key", "item_id", "lo", "hi"],
            )


def _block(texts: DataFrame, items: list[Item], slop: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Matches with the items of one block, and the number of words of every text."""
    spark = texts.sparkSession
    terms = {word: n for n, word in enumerate(sorted({word for _, words in items for word in words}))}
    index = scratch.settle(
        texts.mapInArrow(partial(_postings, terms=terms), "term long, keys array<long>, places array<int>")
    )
    lengths = index.where("term is null").select(F.explode(F.arrays_zip("keys", "places")).alias("d")).select(
        F.col("d.keys").alias("_key"), F.col("d.places").cast("long").alias("n_words")
    )
    listed = index.where("term is not null")
    counts = dict(listed.groupBy("term").agg(F.sum(F.size("keys")).alias("n")).collect())  # at most the block's terms
    schema = "item int, a long, a_at int, b long, b_at int"
    probes = spark.createDataFrame(_probes(items, counts), schema)

    def aligned(term: str, at: str) -> DataFrame:
        wanted = probes.select("item", F.col("a_at").alias("pa"), F.col("b_at").alias("pb"), F.col(term).alias("term"), F.col(at).alias("at"))
        return listed.join(F.broadcast(wanted), "term").select(
            "item", "pa", "pb", "at", F.explode(F.arrays_zip("keys", "places")).alias("d")
        ).select("item", "pa", "pb", F.col("d.keys").alias("_key"), (F.col("d.places") - F.col("at")).alias("shift"))

    first, second = aligned("a", "a_at"), aligned("b", "b_at")
    if slop:
        second = second.withColumn(
            "shift", F.explode(F.sequence(F.col("shift") - slop, F.col("shift") + slop))
        ).distinct()
    pairs = first.join(second, ["item", "pa", "pb", "_key", "shift"]).select("_key", "item", "shift").distinct()
    by_text = scratch.settle(
        pairs.groupBy("_key").agg(F.collect_list(F.struct("item", "shift")).alias("pairs"))
    )
    matches = texts.join(by_text, "_key").mapInArrow(
        partial(_verified, items=items, slop=slop), "_key long, item_id string, lo int, hi int"
    )
    return matches, lengths


def _searched(texts: DataFrame, items: DataFrame, slop: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    tests = items.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = tests.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    # A word and its separator have two bytes at least.
    blocks = max(1, -(-int(size) // (2 * BLOCK_WORDS)))
    found, lengths = [], None
    for block in range(blocks):
        part = tests.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)
        words: dict[str, list[bytes]] = {}
        named = defaultdict(set)
        for row in part.collect():  # one block of the query set
            words[row["text"]] = words_of(row["text"].encode())
            named[row["text"]].add(row["item_id"])
        listed = [(item_id, words[text]) for text, ids in sorted(named.items()) for item_id in sorted(ids, key=str)]
        matches, lengths = _block(texts, listed, slop, scratch)
        found.append(matches)
    return reduce(DataFrame.unionByName, found), lengths


def matches(docs: DataFrame, items: DataFrame, slop: int = 0) -> DataFrame:
    """doc_id, item_id and word range [lo, hi) of every match of an item in a document."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    rows = keyed(docs.select("doc_id", "text"), scratch)
    found, _ = _searched(rows.select("_key", F.col("_row.text").alias("text")), items, slop, scratch)
    return rows.select("_key", F.col("_row.doc_id").alias("doc_id")).join(found, "_key").drop("_key")


def _judged(docs: DataFrame, items: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    rows = keyed(docs, scratch)
    found, lengths = _searched(rows.select("_key", F.col("_row.text").alias("text")), items, 0, scratch)
    # Length of the union of the ranges, in order of their starts.
    union = """aggregate(array_sort(collect_set(struct(lo, hi))), named_struct('end', 0, 'n', 0L),
        (u, r) -> named_struct('end', greatest(u.end, r.hi), 'n', u.n + greatest(0, r.hi - greatest(u.end, r.lo))),
        u -> u.n)"""
    per_text = found.groupBy("_key").agg(
        F.expr(union).alias("n_hit"), F.array_sort(F.collect_set("item_id")).alias("items")
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return rows, lengths.join(per_text, "_key", "left").select(
        "_key",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", listed), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """n_words, n_hit, n_items, items_sha256 and ``contaminated`` of every document."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    rows, judged = _judged(docs.select("doc_id", "text"), items, scratch)
    return rows.select("_key", F.col("_row.doc_id").alias("doc_id")).join(judged, "_key").drop("_key")


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    rows, judged = _judged(docs, items, scratch)
    # Written, so Spark knows how few they are and need not move the texts.
    bad = scratch.settle(judged.where("contaminated").select("_key"))
    return rows.join(bad, "_key", "left_anti").select("_row.*")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_W = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE_SQL = f"""
with d as (select row_number() over () as k, doc_id, {_W} as w from documents),
i as (select distinct item_id, {_W} as w from benchmark),
windows as (
  select distinct item_id, least(len(w), {WINDOW}) as size,
    array_to_string(w[s:s + least(len(w), {WINDOW}) - 1], ' ') as phrase
  from (select item_id, w, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) as s from i where len(w) > 0)),
places as (
  select k, s, size, array_to_string(w[s:s + size - 1], ' ') as phrase
  from (select k, w, size, unnest(range(1, len(w) - size + 2)) as s
        from d, (select distinct size from windows) where len(w) >= size)),
found as (select k, s, p.size, item_id from places p join windows using (size, phrase)),
hits as (
  select k, count(distinct p) as n_hit
  from (select k, unnest(range(s, s + size)) as p from found) group by k),
listed as (
  select k, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids
  from found group by k)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join hits using (k) left join listed using (k)
"""
