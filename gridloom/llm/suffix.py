"""Repeated passages removed byte by byte with two-stage suffix sorting.

Every byte covered by a ``SPAN`` = 200-byte string that also starts anywhere else
in the input, same text included, is removed.  Which start positions repeat is
read off suffix arrays: two starts repeat when they stand next to each other in
suffix order with a common prefix of 200 bytes.

Texts are routed to suffix arrays by their minimizers.  Each 200-byte string has
one least gram among its 161 grams of 40 bytes, wherever it stands, so equal
strings share that gram.  Consecutive starts with the same least gram form one
context, a piece of up to 360 bytes.  Equal contexts are counted before anything
moves: two of them repeat as a whole.  What is left to tell are grams with
several different contexts.  One copy of each goes to its gram's task, which
sorts them together:

* only suffixes smaller than their successor are sorted directly, by eight bytes
  at a time, to a depth of 200 bytes, and of these only what stands at a context's
  starts or next after them: the rest of a context is no start of its own;
* the others are induced by one scan over the buckets of first bytes, since such
  a suffix stands in its bucket in the order of the suffix that follows it;
* common prefixes of adjacent starts are compared, again by eight bytes.

A gram with more than ``HOT`` contexts (a passage that very many texts share,
each with another neighbourhood) would make one large task.  One copy of each of
its contexts is cut anew by the least gram of the next length in ``GRAMS``: equal
strings share that one too, and the longer it is the fewer neighbourhoods it has.
A gram of 200 bytes is the string itself, so the last length leaves none crowded.
Contexts are told apart by 128 bits of hash.

Null text counts as empty.  Texts under 200 bytes lose nothing.  Rows are told
apart even if their doc_id is null or repeated; repeated rows repeat each other.
An empty table gives an empty result.  Further columns, whatever their names, do
not matter to ``removed_bytes`` and are passed on by ``without_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridloom.llm.common import Scratch, keyed, table, utf8

SPAN = 200
#: Lengths of the grams that route; each one deals what is crowded under the one before.
GRAMS = (40, 100, 160, SPAN)
#: A gram with more different contexts than this is crowded.
HOT = 1000
#: Bytes hashed at a time, and sorted at a time.
BLOCK = 1 << 20
CHUNK = 4 << 20

_U = np.uint64


class _Roll:
    """Numbers of byte strings by content alone, for all places of a block."""

    def __init__(self, seed: int, longest: int) -> None:
        draw = np.random.default_rng(seed)
        self.values = draw.integers(1, 1 << 63, 256, dtype=np.uint64)
        factor = int(draw.integers(1 << 40, 1 << 62)) * 8 + 5
        self.up = np.full(longest + 1, factor % (1 << 64), dtype=np.uint64)
        self.down = np.full(longest + 1, pow(factor, -1, 1 << 64), dtype=np.uint64)
        self.up[0] = self.down[0] = 1
        np.cumprod(self.up, out=self.up)
        np.cumprod(self.down, out=self.down)

    def sums(self, text: np.ndarray) -> np.ndarray:
        total = np.zeros(len(text) + 1, dtype=np.uint64)
        np.cumsum(self.values[text] * self.up[: len(text)], out=total[1:])
        return total

    def number(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (sums[stop] - sums[start]) * self.down[start]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return (x ^ (x >> _U(29))) * _U(0x9E3779B97F4A7C15)


_rolls: dict[int, _Roll] = {}


def _roll(seed: int) -> _Roll:
    if seed not in _rolls:
        _rolls[seed] = _Roll(seed, BLOCK + SPAN)
    return _rolls[seed]


def contexts(text: np.ndarray, ends: np.ndarray, gram: int = GRAMS[0]) -> tuple[np.ndarray, ...]:
    """Contexts of concatenated texts: gram number, context number, first start, starts.

    ``ends`` holds for every byte the end of the text that it belongs to, ``gram``
    is the length of the grams.
    """
    count = len(text) - SPAN + 1
    if count <= 0:
        return (np.empty(0, np.int64),) * 4
    roll = _roll(1)
    sums = roll.sums(text)
    grams = _mixed((sums[gram:] - sums[:-gram]) * roll.down[: len(text) - gram + 1])
    # The upper bits choose, the lower ones hold the place; the first of equals wins.
    places = np.arange(len(grams), dtype=np.uint64)
    least = (grams & ~_U(0xFFFFFF)) | places
    window, width = SPAN - gram + 1, 1
    while width * 2 <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < window:
        least = np.minimum(least[: len(least) - (window - width)], least[window - width :])
    place = (least[:count] & _U(0xFFFFFF)).astype(np.int64)
    starts = np.arange(count)
    whole = starts + SPAN <= ends[:count]
    cut = np.r_[True, (place[1:] != place[:-1]) | (ends[1:count] != ends[: count - 1])]
    # A text's last start is followed by starts that reach over its end.
    cut |= np.r_[False, whole[1:] != whole[:-1]]
    first = np.flatnonzero(cut)
    size = np.diff(np.r_[first, count])
    kept = whole[first]
    first, size = first[kept], size[kept]
    place = place[first]
    other = _roll(2)
    number = other.number(other.sums(text), first, first + size - 1 + SPAN)
    shape = ((place - first) << 32 | size).astype(np.uint64)
    return grams[place].view(np.int64), _mixed(number ^ _mixed(shape)).view(np.int64), first, size


def _blocks(pieces: Iterator[tuple[int, int, bytes]]) -> Iterator[tuple[np.ndarray, ...]]:
    """Pieces (key, place in the text, bytes) in blocks.

    A block has its bytes and for every byte the end of its piece, its key, the
    place of its piece, and what leads from the block to the text.  Short pieces
    share a block; a long one is cut into blocks that overlap by 199 bytes, so
    every start is in exactly one.
    """
    held: list[tuple[int, int, int, bytes]] = []
    size = 0

    def joined() -> tuple[np.ndarray, ...]:
        lengths = np.array([len(part) for *_, part in held])
        begins = np.cumsum(lengths) - lengths
        key, at, lo = (np.array([row[i] for row in held], dtype=np.int64) for i in range(3))
        return (
            np.frombuffer(b"".join(part for *_, part in held), dtype=np.uint8),
            *(np.repeat(value, lengths) for value in (begins + lengths, key, at, lo - begins)),
        )

    for key, at, piece in pieces:
        for lo in range(0, len(piece) - SPAN + 1, BLOCK):
            part = piece[lo : lo + BLOCK + SPAN - 1]
            if size + len(part) > BLOCK + SPAN:
                yield joined()
                held, size = [], 0
            held.append((key, at, at + lo, part))
            size += len(part)
    if held:
        yield joined()


def _anchors(gram: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Contexts by grams of this length, from rows of _key, at and text."""

    def anchors(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            places = (batch.column(name).to_pylist() for name in ("_key", "at"))
            for text, ends, key, at, shift in _blocks(zip(*places, utf8(batch.column("text")), strict=True)):
                route, number, first, size = contexts(text, ends, gram)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(route),
                        pa.array(number),
                        pa.array(key[first]),
                        pa.array(at[first]),
                        pa.array(first + shift[first]),
                        pa.array(size.astype(np.int32)),
                    ],
                    ["gram", "context", "_key", "at", "lo", "n"],
                )

    return anchors


def _types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor; the end is smaller than all."""
    n = len(text)
    runs = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    rising = np.r_[text[runs[1:]] > text[runs[:-1]], False]
    return np.repeat(rising, np.diff(np.r_[runs, n]))


def _sorted_directly(words: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` in the order of the ``depth`` bytes there, eight at a time."""
    order = places[np.argsort(words[places])]
    key = words[order]
    cut = np.r_[True, key[1:] != key[:-1]]
    # Slots of the order whose neighbours are not told apart yet, with their group.
    sizes = np.diff(np.r_[np.flatnonzero(cut), len(order)])
    group = np.cumsum(cut) - 1
    slots = np.flatnonzero(np.repeat(sizes > 1, sizes))
    group = group[slots]
    for at in range(8, depth, 8):
        if not len(slots):
            break
        key = words[order[slots] + at]
        first = np.r_[True, group[1:] != group[:-1]]
        starts = np.flatnonzero(first)
        sizes = np.diff(np.r_[starts, len(group)])
        differs = np.r_[False, (key[1:] != key[:-1])] & ~first
        mixed = np.repeat(np.logical_or.reduceat(differs, starts), sizes)
        if not mixed.any():
            continue
        # Groups that still agree stay as they are; only the others are sorted.
        some = np.flatnonzero(mixed)
        by = np.lexsort((key[some], group[some]))
        order[slots[some]] = order[slots[some[by]]]
        key[some] = key[some[by]]
        cut = first | np.r_[False, key[1:] != key[:-1]]
        group = np.cumsum(cut) - 1
        sizes = np.diff(np.r_[np.flatnonzero(cut), len(cut)])
        open_ = np.repeat(sizes > 1, sizes)
        slots, group = slots[open_], group[open_]
    return order


def _led_to(valid: np.ndarray, smaller: np.ndarray) -> np.ndarray:
    """The valid places and what they are induced from, up to the next smaller suffix."""
    n = len(valid)
    last = np.flatnonzero(valid & ~np.r_[valid[1:], False] & ~smaller)
    direct = np.r_[np.flatnonzero(smaller), n - 1]
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, last, 1)
    np.subtract.at(step, direct[np.searchsorted(direct[:-1], last)] + 1, 1)
    return valid | (np.cumsum(step[:n]) > 0)


def suffix_array(text: np.ndarray, depth: int = SPAN, valid: np.ndarray | None = None) -> np.ndarray:
    """Suffixes of ``text`` in the order of their first ``depth`` bytes.

    Equal ones stand together in no particular order.  Where ``valid`` is given,
    only suffixes that are valid, and those that they are induced from.
    """
    n = len(text)
    smaller = _types(text)
    wanted = np.ones(n, dtype=bool) if valid is None else _led_to(valid, smaller)
    larger = wanted & ~smaller
    words = _words(text, depth)
    direct = _sorted_directly(words, np.flatnonzero(wanted & smaller), depth)
    heads = np.searchsorted(text[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]

    def induce(suffixes: np.ndarray) -> None:
        """Deals the predecessors that are larger than these, in order, to their buckets."""
        before = suffixes[suffixes > 0] - 1
        before = before[larger[before]]
        if not len(before):
            return
        first = text[before]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        cuts = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
        for a, b in zip(cuts, [*cuts[1:], len(first)], strict=True):
            induced[first[a]].append(before[a:b])

    induce(np.array([n]))
    out = []
    for bucket in range(256):
        done = 0  # a run of one byte induces into its own bucket, place by place
        while done < len(induced[bucket]):
            wave = np.concatenate(induced[bucket][done:])
            done = len(induced[bucket])
            out.append(wave)
            induce(wave)
        own = direct[heads[bucket] : heads[bucket + 1]]
        out.append(own)
        induce(own)
    return np.concatenate(out)


def _words(text: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes at each place as a number, zeros beyond the end."""
    padded = np.zeros(len(text) + depth + 8, dtype=np.uint64)
    padded[: len(text)] = text
    words = padded
    for width in (1, 2, 4):
        words = (words[:-width] << _U(8 * width)) | words[width:]
    return words


def repeated_starts(text: np.ndarray, valid: np.ndarray, span: int = SPAN) -> np.ndarray:
    """True at valid starts whose ``span`` bytes also start at another valid place."""
    order = suffix_array(text, span, valid)
    order = order[valid[order]]
    words = _words(text, span)
    left, right = order[:-1], order[1:]
    pairs = np.arange(len(left))
    for at in range(0, span, 8):  # the last word ends at the span or is cut there
        shift = _U(8 * max(0, at + 8 - span))
        same = (words[left[pairs] + at] >> shift) == (words[right[pairs] + at] >> shift)
        pairs = pairs[same]
    found = np.zeros(len(text), dtype=bool)
    found[left[pairs]] = True
    found[right[pairs]] = True
    return found


def _sort_chunk(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    lengths = np.array([len(piece) for *_, piece in held])
    text = np.frombuffer(b"".join(piece for *_, piece in held), dtype=np.uint8)
    begins = np.cumsum(lengths) - lengths
    counts = lengths - SPAN + 1
    valid = np.zeros(len(text), dtype=bool)
    places = np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    valid[places] = True
    found = repeated_starts(text, valid)
    # runs of repeated starts; a piece ends with invalid places
    edge = np.flatnonzero(np.diff(np.r_[False, found, False].astype(np.int8)))
    lo, hi = edge[::2], edge[1::2]
    piece = np.searchsorted(begins, lo, side="right") - 1
    keys = np.array([key for key, *_ in held])
    los = np.array([at for _, at, _ in held])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(keys[piece]),
            pa.array(los[piece] + lo - begins[piece]),
            pa.array((hi - lo).astype(np.int32)),
        ],
        ["_key", "lo", "n"],
    )


def _repeats(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by gram to runs of repeated starts; a gram's pieces stay together."""
    held: list[tuple[int, int, bytes]] = []
    size, last = 0, None
    for batch in rows:
        columns = [batch.column(name).to_pylist() for name in ("gram", "_key", "at", "piece")]
        for gram, key, at, piece in zip(*columns, strict=True):
            if size >= CHUNK and gram != last:
                yield _sort_chunk(held)
                held, size = [], 0
            held.append((key, at, piece))
            size += len(piece)
            last = gram
    if held:
        yield _sort_chunk(held)


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The row of each struct in a column of lists, and the structs' fields; a null list has none."""
    structs = lists.flatten()
    fields = zip(structs.type, structs.flatten(), strict=True)
    return (
        pc.list_parent_indices(lists).to_numpy().astype(np.int64),
        {field.name: values.to_numpy(zero_copy_only=False) for field, values in fields},
    )


def _pieces(crowded: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The bytes of each context that has to be told from others, crowded ones or the rest."""

    def pieces(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            texts = utf8(batch.column("text"))
            key, at = (batch.column(name).to_numpy() for name in ("_key", "at"))
            row, cut = _flat(batch.column("cuts"))
            some = np.flatnonzero(cut["sort"] & (cut["crowded"] == crowded))
            size = cut["n"][some].astype(np.int64) - 1 + SPAN
            for part in np.split(np.arange(len(some)), np.flatnonzero(np.diff(np.cumsum(size) >> 23)) + 1):
                if not len(part):
                    continue
                own, lo = row[some[part]], cut["lo"][some[part]]
                begin = lo - at[own]
                cuts = zip(own.tolist(), begin.tolist(), (begin + size[part]).tolist(), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cut["gram"][some[part]]),
                        pa.array(key[own]),
                        pa.array(lo),
                        pa.array([texts[i][a:b] for i, a, b in cuts], pa.binary()),
                    ],
                    ["gram", "_key", "at", "piece"],
                )

    return pieces


def covered(row: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, begin and end of the maximal byte ranges covered by runs (first start, number of starts) of rows."""
    if not len(row):
        return row, lo, lo
    order = np.lexsort((lo, row))
    row, lo = row[order], lo[order]
    hi = lo + n[order] - 1 + SPAN
    base = row * (hi.max() + 1)  # no range reaches into the next row
    reach = np.maximum.accumulate(base + hi)
    first = np.flatnonzero(np.r_[True, (base + lo)[1:] > reach[:-1]])
    last = np.r_[first[1:], len(row)] - 1
    return row[first], lo[first], reach[last] - base[last]


def _cut_out(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        out = []
        cut_row, cut = _flat(batch.column("cuts"))
        run_row, run = _flat(batch.column("runs"))
        whole = cut["whole"]
        row, lo, hi = covered(
            np.r_[cut_row[whole], run_row],
            np.r_[cut["lo"][whole], run["lo"]],
            np.r_[cut["n"][whole], run["n"]].astype(np.int64),
        )
        bounds = np.searchsorted(row, np.arange(batch.num_rows + 1)).tolist()
        spans = list(zip(lo.tolist(), hi.tolist(), strict=True))
        keys = batch.column("_key").to_pylist()
        for key, text, a, b in zip(keys, utf8(batch.column("text")), bounds, bounds[1:], strict=False):
            kept, at = [], 0
            for begin, end in spans[a:b]:
                kept.append(text[at:begin])
                at = end
            rest = b"".join([*kept, text[at:]])
            out.append((key, len(text) - len(rest), b - a, hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "ignore")))
        names = ["_key", "n_removed", "n_spans", "kept_sha256", "kept"]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)


_PIECES = "gram long, _key long, at long, piece binary"


def _told_apart(texts: DataFrame, scratch: Scratch, gram: int, hot: int | None) -> tuple[DataFrame, bool]:
    """Texts (_key, at, text) with the cuts that repeat or might, and whether a gram is crowded."""
    anchors = scratch.settle(
        texts.mapInArrow(_anchors(gram), "gram long, context long, _key long, at long, lo long, n int")
    )
    # Written before they are joined: a join whose sides are read straight from a
    # shuffle can be split where a gram is hot.
    several = scratch.settle(
        anchors.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1").select("gram")
    )
    shared = scratch.settle(anchors.join(several, "gram", "left_semi"))
    scratch.drop(anchors, several)
    kinds = scratch.settle(
        shared.groupBy("gram", "context").agg(
            F.count("*").alias("copies"), F.min(F.struct("_key", "lo")).alias("shown")
        )
    )
    numbers = scratch.settle(kinds.groupBy("gram").agg(F.count("*").alias("kinds")))
    many = F.lit(False) if hot is None else F.col("kinds") > hot
    cuts = (
        shared.join(kinds, ["gram", "context"])
        .join(numbers, "gram")
        .select(
            "_key",
            "at",
            "gram",
            "lo",
            "n",
            (F.col("copies") > 1).alias("whole"),
            # one copy of each different context is sorted
            ((F.col("kinds") > 1) & (F.col("shown") == F.struct("_key", "lo"))).alias("sort"),
            many.alias("crowded"),
        )
        .where("whole or sort")
    )
    by_text = cuts.groupBy("_key", "at").agg(
        F.collect_list(F.struct("gram", "lo", "n", "whole", "sort", "crowded")).alias("cuts")
    )
    held = scratch.settle(texts.join(by_text, ["_key", "at"]))
    crowded = bool(numbers.where(many).take(1))
    scratch.drop(shared, kinds, numbers)
    return held, crowded


def repeated_passages(docs: DataFrame, scratch: Scratch, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """The documents (_key, _row), and what repeats in those that lose bytes or might.

    The second table has _key, n_removed, n_spans, kept_sha256 and ``kept``, the
    remaining bytes as text without characters that were cut in two.
    """
    rows = keyed(docs, scratch)
    texts = rows.select("_key", F.lit(0).cast("long").alias("at"), F.col("_row.text").alias("text"))
    held, crowded = _told_apart(texts, scratch, GRAMS[0], hot)
    whole = held
    sortable = held.where("exists(cuts, c -> c.sort and not c.crowded)").mapInArrow(_pieces(False), _PIECES)
    deeper = []
    for gram in GRAMS[1:]:
        if not crowded:
            break
        some = held.where("exists(cuts, c -> c.sort and c.crowded)")
        texts = scratch.settle(
            some.mapInArrow(_pieces(True), _PIECES).select("_key", "at", F.col("piece").alias("text"))
        )
        held, crowded = _told_apart(texts, scratch, gram, hot if gram < GRAMS[-1] else None)
        scratch.drop(texts)
        sortable = sortable.unionByName(held.mapInArrow(_pieces(False), _PIECES))
        deeper.append(held.select("_key", F.inline("cuts")).where("whole").select("_key", "lo", "n"))
    runs = (
        sortable.repartition("gram")
        .sortWithinPartitions("gram")
        .mapInArrow(_repeats, "_key long, lo long, n int")
    )
    for more in deeper:
        runs = runs.unionByName(more)
    found = runs.groupBy("_key").agg(F.collect_list(F.struct("lo", "n")).alias("runs"))
    lost = whole.join(found, "_key", "left").mapInArrow(
        _cut_out, "_key long, n_removed long, n_spans long, kept_sha256 string, kept string"
    )
    return rows, lost


def removed_bytes(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans and kept_sha256."""
    scratch = Scratch(docs.sparkSession, "suffix")
    rows, lost = repeated_passages(docs.select("doc_id", "text"), scratch)
    text = F.coalesce("_row.text", F.lit("")).cast("binary")
    plain = rows.select(
        "_key",
        F.col("_row.doc_id").alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text, 256).alias("whole"),
    )
    return plain.join(lost.drop("kept"), "_key", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with the repeated bytes removed from their text; n_chars follows it.

    Half characters at a cut are dropped.  A null text stays null.
    """
    scratch = Scratch(docs.sparkSession, "suffix")
    rows, lost = repeated_passages(docs, scratch)
    after = rows.join(lost.select("_key", "kept"), "_key", "left")
    row = F.col("_row").withField("text", F.coalesce("kept", "_row.text"))
    if "n_chars" in docs.columns:
        length = F.length("kept").cast(docs.schema["n_chars"].dataType)
        row = row.withField("n_chars", F.when(F.col("kept").isNull(), F.col("_row.n_chars")).otherwise(length))
    return after.select(row.alias("_row")).select("_row.*")


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed_bytes(table(spark, sf_dir, "documents"))
