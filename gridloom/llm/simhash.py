"""Near-duplicate documents by SimHash over deletion-variant signatures.

A fingerprint has 64 bits and two of them are linked when at most ``LIMIT`` = 3
bits differ.  The 64 bits are cut into two segments of 32: three differing bits
leave one of the segments with at most one.  Every segment is therefore indexed
32 times, each time with one bit wildcarded, and fingerprints that agree in a
segment but for one bit meet under an equal key.  Pairs of a key are verified on
all 64 bits; only the links of a spanning forest of each key are kept, so a key
with m members gives fewer than m rows, never all its pairs.

Exact copies share a fingerprint and enter the index once.  A key with more than
``HOT`` fingerprints is dealt anew: at most three of the other segment's eight
nibbles can differ, so it is indexed under each choice of five equal nibbles.  A
key then fixes 51 of 64 bits and has at most 2**13 members, whatever the data.

Links become components by rounds of hooking onto the least parent and pointer
jumping, each round a written table.

Null text counts as empty; texts without words have fingerprint zero and are
linked like any other.  Rows with a null doc_id are fingerprinted and linked but
never name a component; a component of such rows alone has a null component_id.
Repeated rows give repeated rows.  An empty table gives an empty result.  Further
columns, whatever their names, are passed on by ``one_of_each`` and not read otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridloom.llm.common import LOWER_AZ, Scratch, batches, keyed, table, utf8

SHINGLE = 3
SEED = 42
LIMIT = 3
#: A key with more fingerprints than this is dealt anew under finer keys.
HOT = 1 << 14

_LANES = np.uint64(0x0101010101010101)


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit numbers have each bit set, lowest bit first."""
    if len(hashes) < 2000:
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        return bits.sum(axis=0, dtype=np.int64)
    counts = np.zeros(64, dtype=np.int64)
    padded = np.zeros(-(-len(hashes) // 255) * 255, dtype=np.uint64)
    padded[: len(hashes)] = hashes
    for bit in range(8):  # eight byte lanes at a time; 255 ones still fit a lane
        lanes = ((padded >> np.uint64(bit)) & _LANES).reshape(-1, 255).sum(axis=1, dtype=np.uint64)
        counts[bit::8] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the word shingles of one whole text."""
    words = text.translate(LOWER_AZ).split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) < shingle:
        hashes = np.array([xxhash.xxh64_intdigest(line, SEED)], dtype=np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
        starts = [0, *ends[: len(words) - shingle].tolist()]
        stops = (ends[shingle - 1 :] - 1).tolist()
        pieces = [line[a:b] for a, b in zip(starts, stops, strict=True)]
        # digests are big-endian
        digests = b"".join(map(xxhash.xxh64_digest, pieces, repeat(SEED)))
        hashes = np.frombuffer(digests, dtype=">u8").astype(np.uint64)
    ones = (2 * _bit_counts(hashes) > len(hashes)).astype(np.uint8)
    return int(np.packbits(ones, bitorder="little").view(np.int64)[0])


def _fingerprints(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows):
        prints = [fingerprint(text) for text in utf8(batch.column("text"))]
        columns = {name: batch.column(name) for name in batch.schema.names if name != "text"}
        yield pa.RecordBatch.from_pydict({**columns, "fp": pa.array(prints, pa.int64())})


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the 64 bits as a long) of every document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _fingerprints, "doc_id long, fp long"
    )


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    # bits of signed numbers are counted on their absolute value
    return np.bitwise_count((a ^ b).view(np.uint64)) <= LIMIT


def _spanning(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, least of its component) among distinct sorted fingerprints.

    Whoever is reached leaves the list of those still compared, so a dense group
    costs about its size, and memory is a block of rows.
    """
    children, parents = [], []
    rest = members
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        frontier = np.array([root])
        while len(frontier) and len(rest):
            block = max(1, 1_000_000 // len(rest))
            head, frontier = frontier[:block], frontier[block:]
            near = _near(rest[None, :], head[:, None]).any(axis=0)
            found, rest = rest[near], rest[~near]
            children.append(found)
            parents.append(np.full(len(found), root))
            frontier = np.concatenate([frontier, found])
    if not children:
        return members[:0], members[:0]
    return np.concatenate(children), np.concatenate(parents)


def _linked(keys: np.ndarray, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of whole, sorted runs of equal keys."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    wild = (keys[starts] >> 32) & 31
    half = keys[starts] >> 37
    # Equal segments meet under all 32 wildcards; one of them (the first) is enough.
    place = np.repeat(wild + 32 * (1 - half), sizes)
    bit = (prints >> place) & 1
    ones = np.add.reduceat(bit, starts)
    wanted = (sizes > 1) & ((wild == 0) | ((ones > 0) & (ones < sizes)))
    pairs = starts[wanted & (sizes == 2)]
    if len(pairs):
        a, b = prints[pairs], prints[pairs + 1]
        near = _near(a, b)
        yield np.maximum(a, b)[near], np.minimum(a, b)[near]
    for start, size in zip(starts[wanted & (sizes > 2)], sizes[wanted & (sizes > 2)], strict=True):
        yield _spanning(np.sort(prints[start : start + size]))


def _links(rows: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Sorted (key, sub, fp) rows to links; rows of hot keys come back as they are.

    Output: kind 0 with (child, parent), or kind 1 with (key, fp).
    """

    def out(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b)], ["kind", "a", "b"]
        )

    held = [np.empty(0, np.int64)] * 3
    hot: tuple[int, int] | None = None

    def flush(key: np.ndarray, sub: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(key):
            return
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (sub[1:] != sub[:-1])])
        sizes = np.repeat(np.diff(np.r_[starts, len(key)]), np.diff(np.r_[starts, len(key)]))
        large = sizes > most
        if large.any():
            yield out(1, key[large], fp[large])
            key, sub, fp = key[~large], sub[~large], fp[~large]
        if not len(key):
            return
        # Runs of one key that differ in sub are told apart by a running number.
        if sub.any():
            firsts = np.r_[True, (key[1:] != key[:-1]) | (sub[1:] != sub[:-1])]
            starts = np.flatnonzero(firsts)
            sizes = np.diff(np.r_[starts, len(key)])
            for start, size in zip(starts[sizes > 1], sizes[sizes > 1], strict=True):
                yield out(0, *_spanning(np.sort(fp[start : start + size])))
            return
        for child, parent in _linked(key, fp):
            if len(child):
                yield out(0, child, parent)

    for batch in rows:
        if not batch.num_rows:
            continue
        new = [batch.column(name).to_numpy() for name in ("key", "sub", "fp")]
        if hot is not None:
            same = (new[0] == hot[0]) & (new[1] == hot[1])
            if same.any():
                yield out(1, new[0][same], new[2][same])
                new = [column[~same] for column in new]
            if not len(new[0]):
                continue
            hot = None
        held = [np.concatenate([a, b]) for a, b in zip(held, new, strict=True)]
        key, sub, _ = held
        last = int(np.argmax((key == key[-1]) & (sub == sub[-1])))
        yield from flush(*(column[:last] for column in held))
        held = [column[last:] for column in held]
        if len(held[0]) > most:
            hot = (int(held[0][0]), int(held[1][0]))
            yield out(1, held[0], held[2])
            held = [column[:0] for column in held]
    yield from flush(*held)


_LINK_ROWS = "kind int, a long, b long"


def _segment_keys(prints: DataFrame) -> DataFrame:
    """64 rows per fingerprint: (segment, wildcard, the segment without that bit)."""
    high, low = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    wild = F.explode(F.sequence(F.lit(0), F.lit(63)))
    value = F.when(F.col("wild") < 32, high).otherwise(low)
    bit = F.expr("shiftleft(1L, wild % 32)")
    masked = value.bitwiseAND(F.bitwise_not(bit))
    key = F.expr("shiftleft(cast(wild as bigint), 32)").bitwiseOR(masked)
    return prints.select("fp", wild.alias("wild")).select(key.alias("key"), F.lit(0).cast("long").alias("sub"), "fp")


def _nibble_keys(hot: DataFrame) -> DataFrame:
    """56 rows per fingerprint of a hot key: five of the other segment's nibbles."""
    masks = [sum(0xF << (4 * n) for n in kept) for kept in combinations(range(8), 8 - LIMIT)]
    other = F.when(
        F.shiftright("key", 37) == 0, F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    ).otherwise(F.shiftrightunsigned("fp", 32))
    # The mask stands above the masked value, and the lot is never zero.
    chosen = F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask")
    return hot.select("key", "fp", other.alias("other"), chosen).select(
        "key",
        F.expr("shiftleft(cast(mask as bigint), 32)").bitwiseOR(F.col("other").bitwiseAND(F.col("mask"))).alias("sub"),
        "fp",
    )


def links(prints: DataFrame, scratch: Scratch, most: int = HOT) -> DataFrame:
    """Links (v, p) with p < v whose components are those of all pairs within LIMIT.

    ``prints`` has distinct values ``fp``; keys with over ``most`` are dealt anew.
    """

    def met(keys: DataFrame, most: int) -> DataFrame:
        dealt = keys.repartition("key", "sub").sortWithinPartitions("key", "sub")
        return scratch.settle(dealt.mapInArrow(partial(_links, most=most), _LINK_ROWS))

    first = met(_segment_keys(prints), most)
    hot = first.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("fp"))
    found = first
    if hot.take(1):
        found = first.unionByName(met(_nibble_keys(hot), HOT))
    return found.where("kind = 0").select(F.col("a").alias("v"), F.col("b").alias("p")).distinct()


def roots(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Least member ``p`` of the component of each ``v``; members that are least have no row.

    ``edges`` has (v, p) with p < v.  In each round a node keeps its least parent
    m(v), hooks its other parents onto m(v), and jumps to m(m(v)).  Hubs stand in
    the parent column, so grouping by ``v`` meets no hot key.
    """
    edges = scratch.settle(edges)
    while True:
        least = scratch.settle(edges.groupBy("v").agg(F.min("p").alias("m")))
        above = least.select(F.col("v").alias("m"), F.col("m").alias("top"))
        jumped = least.join(above, "m", "left").select(
            "v", F.coalesce("top", "m").alias("p"), F.col("top").isNotNull().alias("moved")
        )
        hooked = (
            edges.join(least, "v")
            .where(F.col("p") != F.col("m"))
            .select(F.col("p").alias("v"), F.col("m").alias("p"), F.lit(True).alias("moved"))
        )
        after = scratch.settle(
            jumped.unionByName(hooked).groupBy("v", "p").agg(F.max("moved").alias("moved"))
        )
        scratch.drop(edges, least)
        edges = after
        if not after.where("moved").take(1):
            return after.select("v", "p")


def _components(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Fingerprints per row (the columns of ``docs`` but text, and fp), and the root of each."""
    prints = scratch.settle(docs)
    distinct = scratch.settle(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = roots(links(distinct.select("fp"), scratch), scratch)
    return prints, distinct.join(found, distinct.fp == found.v, "left").select(
        "fp", "least", F.coalesce("p", "fp").alias("root")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document.

    ``component_id`` is the least doc_id that links of at most three differing
    bits reach, the document's own included.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    prints, rooted = _components(fingerprints(docs), scratch)
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    components = rooted.join(names, "root").select("fp", "component_id")
    return prints.join(components, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component, with all its columns: that of the least doc_id.

    Of rows that share it, or have none, one stays.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = keyed(docs, scratch)
    texts = rows.select("_key", F.col("_row.doc_id").cast("long").alias("doc_id"), F.col("_row.text").alias("text"))
    printed = texts.mapInArrow(_fingerprints, "_key long, doc_id long, fp long")
    prints, rooted = _components(printed, scratch)
    # Nulls last, then the key: both sums are made before anything is shuffled.
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_key")
    firsts = prints.groupBy("fp").agg(F.min(order).alias("first"))
    kept = firsts.join(rooted, "fp").groupBy("root").agg(F.min("first").alias("first"))
    # The copies are fewer than the documents that stay: they are what is joined, as a
    # written table, so Spark knows whether they are few enough to be sent to the texts.
    copies = scratch.settle(
        prints.select("_key").join(kept.select(F.col("first._key").alias("_key")), "_key", "left_anti")
    )
    return rows.join(copies, "_key", "left_anti").select("_row.*")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
