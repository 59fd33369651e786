"""Best-fit packing of documents into sequences, certified by lower bounds.

Documents become token ids with an end token.  Only documents over ``SIZE``
tokens are cut, into pieces of ``SIZE``; their first piece takes the remainder.
Pieces of ``SIZE`` are sequences by themselves.

The others are dealt by a hash of their written row number into partitions of about ``DEALT`` pieces.  Each is
packed by best-fit decreasing, and dual-feasible functions of its lengths give a
number of sequences that no packing can go below.  A partition that meets its
bound is certified and done.  Partitions with a gap keep their full sequences and
put the documents of the others into a common pool, which is dealt anew and
packed again, until there is no gap, or one partition is left, or after
``ROUNDS`` rounds.  So one task never holds more than its share, and gaps close
by exchange between partitions.

Null text counts as empty: one end token.  A null doc_id is kept.  Repeated rows
are packed each for itself.  An empty table gives an empty result.  Only doc_id and
text are read; further columns, whatever their names, are not.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridloom.llm import tokens
from gridloom.llm.common import Scratch, batches, table

SIZE = 1024
END = 2
TOKENIZER = "byte_bpe_50k.json"
DEALT = 40_000
ROUNDS = 4

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut(rows: Iterator[pa.RecordBatch], tokenizer: str, size: int, end: int) -> Iterator[pa.RecordBatch]:
    """Pieces of whole documents; a document's first piece takes the remainder."""
    closing = np.array([end], dtype="<u4").tobytes()
    for batch in batches(rows, 4 << 20):
        doc_ids = batch.column("doc_id").to_pylist()
        texts = [text or "" for text in batch.column("text").to_pylist()]
        out: list[tuple] = []
        for doc_id, ids in zip(doc_ids, tokens.byte_level(tokenizer).ids(texts), strict=True):
            ids += closing
            count = len(ids) // 4
            at, piece = 0, 0
            while at < count:
                stop = at + (count % size or size) if not at else at + size
                out.append((doc_id, piece, at, stop - at, zlib.crc32(ids[4 * at : 4 * stop])))
                at, piece = stop, piece + 1
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names
        )


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each length, in the given order, and the number of bins.

    A length goes to the bin with the least room that still takes it.  Bins are
    kept by their room, and one number has a bit for each room that some bin has.
    """
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    rooms, bins = 0, 0
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, length in enumerate(lengths.tolist()):
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, chosen = size, bins
            bins += 1
        where[i], offset[i] = chosen, size - room
        left = room - length
        if left:
            if not by_room[left]:
                rooms |= 1 << left
            by_room[left].append(chosen)
    return where, offset, bins


def lower_bound(lengths: np.ndarray, size: int) -> int:
    """A number of bins that no packing goes below, by dual-feasible functions.

    The first family rounds lengths over size - t up to the size and lengths
    under t down to zero, for each t up to half the size (t = 0: the sum alone).
    The second, for k up to 30, rounds (k + 1) * length / size down to whole
    k-ths unless it is whole.
    """
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=size + 1)
    number = np.concatenate([[0], np.cumsum(counts)])
    total = np.concatenate([[0], np.cumsum(counts * np.arange(size + 1))])
    best = -(-int(total[-1]) // size)
    for t in range(1, size // 2 + 1):
        large = int(number[-1] - number[size - t + 1])
        middle = int(total[size - t + 1] - total[t])
        best = max(best, large + -(-middle // size))
    values = np.arange(size + 1)
    for k in range(1, 31):
        scaled = (k + 1) * values
        rounded = np.where(scaled % size == 0, values * k, scaled // size * size)
        best = max(best, -(-int((rounded * counts).sum()) // (k * size)))
    return best


_PACKED = f"{_PIECES}, row long, part long, bin long, offset long, used long, gap long"


def _packed(group: pa.Table, size: int) -> pa.Table:
    group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("start", "ascending")])
    lengths = group.column("length").to_numpy()
    where, offset, bins = best_fit(lengths, size)
    used = np.bincount(where, weights=lengths, minlength=bins).astype(np.int64)
    gap = np.full(len(lengths), bins - lower_bound(lengths, size))
    columns = {"bin": where, "offset": offset, "used": used[where], "gap": gap}
    for name, values in columns.items():
        group = group.append_column(name, pa.array(values))
    return group.select([field.split()[0] for field in _PACKED.split(", ")])


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, size: int = SIZE, end: int = END) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece of every document."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(partial(_cut, tokenizer=tokenizer, size=size, end=end), _PIECES)


def packed(
    docs: DataFrame, tokenizer: str = TOKENIZER, size: int = SIZE, end: int = END, dealt: int = DEALT
) -> DataFrame:
    """The pieces with sequence_id, offset and ``certified``.

    ``certified`` tells that the sequence's partition meets its lower bound, or
    that the sequence is full.
    """
    def pack(group: pa.Table) -> pa.Table:
        return _packed(group, size)

    scratch = Scratch(docs.sparkSession, "packing")
    # The written numbers make ids of the full pieces that no re-run changes.
    cut = scratch.settle(pieces(docs, tokenizer, size, end).withColumn("row", F.monotonically_increasing_id()))
    columns = [field.split()[0] for field in _PIECES.split(", ")]
    done = [
        cut.where(F.col("length") == size).select(
            *columns,
            (F.col("row") + (1 << 62)).alias("sequence_id"),
            F.lit(0).cast("long").alias("offset"),
            F.lit(True).alias("certified"),
        )
    ]
    pool = cut.where(F.col("length") < size).select(*columns, "row")
    for turn in range(ROUNDS):
        parts = max(1, -(-pool.count() // dealt))
        part = F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(parts)).alias("part")
        found = scratch.settle(
            pool.select(*columns, "row", part).groupBy("part").applyInArrow(pack, _PACKED)
        )
        last = turn == ROUNDS - 1 or parts == 1
        stays = F.lit(True) if last else (F.col("gap") == 0) | (F.col("used") == size)
        sequence = F.col("bin") + F.col("part") * (1 << 32) + F.lit(turn) * (1 << 58)
        done.append(
            found.where(stays).select(
                *columns,
                sequence.alias("sequence_id"),
                "offset",
                ((F.col("gap") == 0) | (F.col("used") == size)).alias("certified"),
            )
        )
        pool = found.where(~stays).select(*columns, "row")
        if last or not pool.take(1):
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
