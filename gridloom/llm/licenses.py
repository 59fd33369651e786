"""License scans by patience alignment.

A license text is looked for where three words of it stand together.  The words
around such a place are aligned with the text: words that are unique on both
sides are anchors, the longest increasing sequence of them is kept, and the gaps
between anchors are aligned in the same way until none has anchors left; equal
words at the ends of a gap go with it.  The share of the text's words that found
their counterpart is its coverage, and at least ``COVERAGE`` counts as a match.  A text of
fewer than ``SHORT`` words has to stand there word for word.  Of a longer one the phrases
that tell the license from its relatives have to be there, with their names and versions
and without those of a relative among them.
Of matches that overlap the one with more words stays, then the better covered.

Nothing is shuffled: each whole text is scanned by itself, against texts whose
number is fixed.

Null and empty texts have no matches.  A document without matches has zero
counts and an empty list.  Null ids and repeated rows are returned as they are.
An empty table gives an empty result.  Further columns, whatever their names, are not
read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping, Sequence
from functools import cache, partial
from math import ceil
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridloom.llm.common import batches, table, utf8
from gridloom.llm.license_texts import TELLING, TEMPLATES

COVERAGE = 0.8
SEED = 3
SHORT = 20
LONG = 400

_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


class Match(NamedTuple):
    license: str
    template: int
    start: int  # first and last word in the document
    end: int
    matched: int
    coverage: float


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest sequence of pairs that rises in both; they come sorted by the first."""
    tops: list[int] = []  # least second number that ends a sequence of each length
    ends: list[int] = []
    before: list[int] = []
    for n, (_, second) in enumerate(pairs):
        at = bisect_left(tops, second)
        before.append(ends[at - 1] if at else -1)
        tops[at : at + 1] = [second]
        ends[at : at + 1] = [n]
    out, n = [], ends[-1] if ends else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def align(left: list[bytes], right: list[bytes]) -> list[tuple[int, int]]:
    """Pairs of places with equal words, rising on both sides."""
    out: list[tuple[int, int]] = []
    gaps = [(0, len(left), 0, len(right))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and left[a] == right[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and left[b - 1] == right[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        here, there = Counter(left[a:b]), Counter(right[c:d])
        at = {word: n for n, word in enumerate(right[c:d], c) if there[word] == 1}
        pairs = [(n, at[word]) for n, word in enumerate(left[a:b], a) if here[word] == 1 and word in at]
        anchors = increasing(pairs)
        if not anchors:
            continue
        out += anchors
        edges = [(a - 1, c - 1), *anchors, (b, d)]
        gaps += [(p + 1, q, r + 1, s) for (p, r), (q, s) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


class Telling(NamedTuple):
    places: list[int]  # where a telling phrase stands in a text
    length: int
    needed: set[bytes]
    barred: set[bytes]


Further = tuple[tuple[str, tuple[str, ...]], ...]


class Index(NamedTuple):
    texts: list[tuple[str, list[bytes]]]
    #: Per word the three-word seeds it is the longest of, each with its (text, place).
    seeds: dict[bytes, dict[tuple[bytes, ...], list[tuple[int, int]]]]
    telling: list[list[Telling]]
    counts: list[Counter[bytes]]


def _longest(seed: tuple[bytes, ...]) -> int:
    return max(range(SEED), key=lambda i: len(seed[i]))


@cache
def index(further: Further = ()) -> Index:
    """All texts, ``further`` ones behind the fixed ones, prepared for the scan."""
    forms = [(name, text) for name, texts in (*TEMPLATES.items(), *further) for text in texts]
    texts = [(name, words_of(text.encode())) for name, text in forms]
    seeds: dict[bytes, dict[tuple[bytes, ...], list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
    telling: list[list[Telling]] = []
    for number, (name, words) in enumerate(texts):
        for place in range(len(words) - SEED + 1):
            seed = tuple(words[place : place + SEED])
            seeds[seed[_longest(seed)]][seed].append((number, place))
        telling.append([])
        for phrase, needed, barred in TELLING.get(name, ()):
            p = words_of(phrase.encode())
            places = [n for n in range(len(words)) if words[n : n + len(p)] == p]
            if places:
                telling[-1].append(Telling(places, len(p), set(words_of(needed.encode())), set(words_of(barred.encode()))))
    return Index(texts, {word: dict(own) for word, own in seeds.items()}, telling, [Counter(words) for _, words in texts])


def own(words: list[bytes], wanted: list[bytes], telling: list[Telling], pairs: list[tuple[int, int]]) -> bool:
    """Whether the aligned words are this license's and not those of a relative."""
    if len(wanted) < SHORT:
        return len(pairs) == len(wanted) == pairs[-1][0] - pairs[0][0] + 1
    there = [place for _, place in pairs]

    def stands(place: int, phrase: Telling) -> bool:
        # All words between the neighbours of the phrase that found their counterpart.
        before, after = bisect_left(there, place), bisect_left(there, place + phrase.length)
        low = pairs[before - 1][0] + 1 if before else max(0, pairs[0][0] - phrase.length)
        high = pairs[after][0] if after < len(pairs) else pairs[-1][0] + 1 + phrase.length
        between = set(words[low:high])
        return 2 * (after - before) >= phrase.length and phrase.needed <= between and not phrase.barred & between

    return all(any(stands(place, phrase) for place in phrase.places) for phrase in telling)


class Spans:
    """Stretches of places, apart from each other and in order."""

    def __init__(self) -> None:
        self.lows: list[int] = []
        self.highs: list[int] = []

    def holds(self, place: int) -> bool:
        at = bisect_right(self.lows, place) - 1
        return at >= 0 and place <= self.highs[at]

    def add(self, place: int, near: int, least: int) -> None:
        """All places closer than ``near``; what lies below ``least`` is met no more."""
        gone = bisect_left(self.highs, least)
        del self.lows[:gone], self.highs[:gone]
        low, high = place - near + 1, place + near - 1
        first, last = bisect_left(self.highs, low), bisect_right(self.lows, high)
        if first < last:
            low, high = min(low, self.lows[first]), max(high, self.highs[last - 1])
        self.lows[first:last], self.highs[first:last] = [low], [high]


def scan(text: bytes, further: Further = ()) -> list[Match]:
    """Matches of one whole text in the order of their places."""
    texts, seeds, telling, counts = index(further)
    words = words_of(text)
    found: list[Match] = []
    done = [0] * len(texts)  # words before this place are aligned already
    tried: dict[int, Spans] = defaultdict(Spans)  # where alignments with a text have failed since then
    enough: dict[int, bool] = {}
    held: Counter[bytes] = Counter()

    def possible(number: int) -> bool:
        """Whether the document has enough of a text's words at all."""
        if number not in enough:
            least = COVERAGE * len(texts[number][1])
            if len(words) < least:
                enough[number] = False
            else:
                if not held:
                    held.update(words)
                enough[number] = sum(min(n, held[word]) for word, n in counts[number].items()) >= least
        return enough[number]

    for at, word in enumerate(words):
        own_seeds = seeds.get(word)
        if own_seeds is None:
            continue
        for back in range(SEED):
            first = at - back
            seed = tuple(words[first : first + SEED]) if first >= 0 else ()
            hits = own_seeds.get(seed)
            if hits is None or _longest(seed) != back:
                continue
            for number, place in hits:
                if first < done[number] or not possible(number):
                    continue
                name, wanted = texts[number]
                slack = max(SEED, len(wanted) // 4)
                # Alignments of a long text that start this close cover the same words.
                near = slack // 2 if len(wanted) >= LONG else 1
                start = first - place
                if len(wanted) < SHORT:  # word for word
                    end = start + len(wanted)
                    if start >= done[number] and words[start:end] == wanted:
                        found.append(Match(name, number, start, end, len(wanted), 1.0))
                        done[number] = end
                    continue
                failed = tried[number]
                if failed.holds(start):
                    continue
                begin = max(done[number], start - slack)
                window = words[begin : start + len(wanted) + slack]
                # A window moved by so many words has at most so many more of the text's.
                short_by = COVERAGE * len(wanted) - (counts[number] & Counter(window)).total()
                if short_by > 0:
                    failed.add(start, max(near, ceil(short_by)), first - len(wanted))
                    continue
                pairs = align(window, wanted)
                coverage = len(pairs) / len(wanted)
                if coverage >= COVERAGE and own(window, wanted, telling[number], pairs):
                    start, end = begin + pairs[0][0], begin + pairs[-1][0] + 1
                    found.append(Match(name, number, start, end, len(pairs), coverage))
                    done[number] = end
                    tried.pop(number)
                else:
                    failed.add(start, near, first - len(wanted))
    kept: list[Match] = []  # by start; they do not overlap, so neighbours tell
    starts: list[int] = []
    for match in sorted(found, key=lambda m: (-m.matched, -m.coverage, m.start, m.template)):
        spot = bisect_left(starts, match.start)
        free_before = not spot or kept[spot - 1].end <= match.start
        if free_before and (spot == len(kept) or kept[spot].start >= match.end):
            starts.insert(spot, match.start)
            kept.insert(spot, match)
    return kept


_MATCHES = "array<struct<license: string, start: int, end: int, coverage: double>>"


def _scanned(rows: Iterator[pa.RecordBatch], further: Further) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(
        pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("coverage", pa.float64())])
    )
    for batch in batches(rows):
        found = [
            [{"license": m.license, "start": m.start, "end": m.end, "coverage": m.coverage} for m in scan(text, further)]
            for text in utf8(batch.column("text"))
        ]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], ["doc_id", "matches"])


def matches(docs: DataFrame, further: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """doc_id and ``matches`` (license, word range, coverage) of every document.

    ``further`` has more texts by license name, which go to all tasks with the fixed ones.
    """
    added = tuple((name, tuple(forms)) for name, forms in (further or {}).items())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(partial(_scanned, further=added), f"doc_id long, matches {_MATCHES}")


def license_scan(docs: DataFrame, further: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Per document: its licenses, number of matches, words inside them, least coverage."""
    return matches(docs, further).select(
        "doc_id",
        F.concat_ws(",", F.array_sort(F.array_distinct("matches.license"))).alias("licenses"),
        F.size("matches").cast("long").alias("n_matches"),
        F.expr("aggregate(matches, 0L, (n, m) -> n + m.end - m.start)").alias("n_license_words"),
        F.array_min("matches.coverage").alias("coverage"),
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))
