"""Token ids of whole texts with small per-process caches of pre-tokens.

A text is cut into pre-tokens by the vocabulary's own rule and each different
pre-token is merged once.  The rule's character classes are built here for code
points below ``PLAIN`` only, where all Unicode versions agree; a text with any
other character, or with the opening of a special token, goes through the
library as a whole.
"""

from __future__ import annotations

import os
import re
import struct
import unicodedata
from collections.abc import Callable, Iterable
from functools import cache
from typing import Generic, TypeVar

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

K, T = TypeVar("K"), TypeVar("T")

#: End of the Latin blocks.
PLAIN = 0x250
#: Pre-tokens of one generation of a process's cache; two are kept.
CACHED = 300_000

_OTHER = re.compile(f"[^\\x00-{chr(PLAIN - 1)}]|<\\|")
#: First bytes in UTF-8 that begin plain characters only, and the bytes that follow them.
_BELOW = bytes(range(chr(PLAIN - 1).encode()[0]))


@cache
def load(name: str) -> Tokenizer:
    """The vocabulary file ``name``, one thread: Spark's tasks are the parallelism."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    path = name if os.path.sep in name else public_tokenizers.path(name)
    return Tokenizer.from_file(str(path))


def _class(kind: str) -> str:
    """Members of a general category below PLAIN, as ranges for a character class."""
    points = [p for p in range(PLAIN) if unicodedata.category(chr(p)).startswith(kind)]
    cuts = [0, *[i for i in range(1, len(points)) if points[i] != points[i - 1] + 1], len(points)]
    return "".join(
        f"\\u{points[a]:04x}-\\u{points[b - 1]:04x}" for a, b in zip(cuts, cuts[1:], strict=False)
    )


LETTERS, NUMBERS = _class("L"), _class("N")
#: Unicode's white space below PLAIN (Python's own class has four controls more).
SPACES = "\\t-\\r \\x85\\xa0"


def is_plain(text: str) -> bool:
    if "<|" in text:
        return False
    return text.isascii() or not text.encode().translate(None, _BELOW) or _OTHER.search(text) is None


class Known(Generic[K, T]):
    """What is known of pre-tokens: ``fixed`` ones and two generations of others.

    A full generation becomes the older one; what is still in use moves on from it.
    """

    def __init__(self, fixed: dict[K, T]) -> None:
        self.fixed = fixed
        self.now, self.before = dict(fixed), {}

    def learned(self, parts: Iterable[list[K] | None], find: Callable[[list[K]], list[T]]) -> Callable[[K], T]:
        """A lookup that knows all pre-tokens of ``parts``; ``find`` is asked for the new ones."""
        if len(self.now) > len(self.fixed) + CACHED:
            self.before, self.now = self.now, dict(self.fixed)
        new = {p for part in parts if part for p in part if p not in self.now}
        older = {p: self.before[p] for p in new if p in self.before}
        self.now.update(older)
        unknown = [p for p in new if p not in older]
        self.now.update(zip(unknown, find(unknown), strict=True))
        return self.now.__getitem__


_OTHERS, _LETTER, _NUMBER, _SPACE = range(4)
_KINDS = np.zeros(0x800, dtype=np.uint8)  # of all characters of two bytes at most
for _kind, _members in ((_LETTER, LETTERS), (_NUMBER, NUMBERS), (_SPACE, SPACES)):
    _KINDS[[p for p in range(PLAIN) if re.match(f"[{_members}]", chr(p))]] = _kind


def cuts(text: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Places in UTF-8 where the pre-tokens of joined plain texts begin.

    ``begins`` holds where each text begins that is not empty.  Per text the rule is

        's|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?[^SLN]+|S+(?!\\S)|S+

    with letters L, numbers N and white space S: runs of one kind, but the last white
    space before something else belongs to that if it is a space, and is alone if not.
    """
    n = len(text)
    code = text.astype(np.uint16)
    lead = np.flatnonzero(text >= 0xC0)
    code[lead] = code[lead + 1] = (code[lead] & 0x1F) << 6 | (code[lead + 1] & 0x3F)
    kind = _KINDS[code]
    opens = np.zeros(n, dtype=bool)
    opens[begins] = True
    change = np.r_[False, kind[1:] != kind[:-1]] & ~opens
    first = opens | change
    after = np.flatnonzero(change[1:] & (kind[:-1] == _SPACE)) + 1
    last = after - 1
    first[last - (text[last] & 0xC0 == 0x80)] = True
    first[after] = text[last] != ord(" ")
    # An apostrophe that begins a pre-token and has letters next to it.
    quote = np.flatnonzero((text[:-1] == ord("'")) & first[:-1] & change[1:] & (kind[1:] == _LETTER))
    one = quote[np.isin(text[quote + 1], list(b"stmd"))]
    quote = quote[quote + 2 < n]
    quote = quote[~opens[quote + 2]]
    pair = text[quote + 1].astype(np.uint16) << 8 | text[quote + 2]
    two = quote[np.isin(pair, [p[0] << 8 | p[1] for p in (b"re", b"ve", b"ll")])]
    first[one + 1] = first[two + 1] = False
    stop = np.r_[one + 2, two + 3]
    first[stop[stop < n]] = True
    return np.flatnonzero(first)


class ByteLevel:
    """Ids of a byte-level vocabulary, as little-endian 32-bit numbers."""

    def __init__(self, name: str) -> None:
        self.tokenizer = load(name)
        self.known: Known[bytes, bytes] = Known({})

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in (e.ids for e in found)]

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Ids of plain texts: each different pre-token of all is looked up once."""
        raw = [text.encode() for text in texts]
        edges = np.cumsum([0, *map(len, raw)])
        joined = b"".join(raw)
        if not joined:
            return raw
        begins = cuts(np.frombuffer(joined, dtype=np.uint8), edges[:-1][np.diff(edges) > 0])
        offsets = pa.py_buffer(np.append(begins, len(joined)))
        parts = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, offsets, pa.py_buffer(joined)])
        coded = parts.dictionary_encode()
        _, offsets, held = coded.dictionary.buffers()
        offsets = np.frombuffer(offsets, dtype=np.int64)[: len(coded.dictionary) + 1].tolist()
        held = held.to_pybytes()
        different = [held[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]
        known = self.known.learned([different], lambda new: self._whole([part.decode() for part in new]))
        found = list(map(known, different))
        ends = np.r_[0, np.cumsum(np.fromiter(map(len, found), np.int64, len(found))) // 4]
        which = coded.indices.to_numpy()
        sizes = np.diff(ends)[which]
        before = np.r_[0, np.cumsum(sizes)]
        places = np.repeat(ends[which] - before[:-1], sizes) + np.arange(before[-1])
        ids = np.frombuffer(b"".join(found), dtype="<u4")[places]
        bounds = before[np.searchsorted(begins, edges)]
        return [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]

    def ids(self, texts: list[str]) -> list[bytes]:
        plain = [is_plain(text) for text in texts]
        found = iter(self._plain([text for text, is_ in zip(texts, plain, strict=True) if is_]))
        return [next(found) if is_ else self._whole([text])[0] for text, is_ in zip(texts, plain, strict=True)]


@cache
def byte_level(name: str) -> ByteLevel:
    """One per worker process."""
    return ByteLevel(name)
