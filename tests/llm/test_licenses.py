"""Alignment against brute force, and planted license texts."""

import random
import time

import pytest

from gridloom.llm import licenses
from gridloom.llm.license_texts import TEMPLATES

LINES = {text: name for name, forms in TEMPLATES.items() for text in forms}


def common(a, b):
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@pytest.mark.parametrize("seed", range(40))
def test_alignment(seed):
    draw = random.Random(seed)
    left = [b"w%d" % draw.randrange(5 + seed) for _ in range(draw.randrange(30))]
    right = list(left)
    for _ in range(draw.randrange(6)):
        right[draw.randrange(len(right) + 1) : draw.randrange(len(right) + 1)] = [b"x%d" % draw.randrange(3)]
    pairs = licenses.align(left, right)
    assert all(left[i] == right[j] for i, j in pairs)
    assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:], strict=False))
    assert len(pairs) <= common(left, right)
    if len(set(left)) == len(left) and len(set(right)) == len(right):
        assert len(pairs) == common(left, right)


@pytest.mark.parametrize("seed", range(20))
def test_longest_increasing(seed):
    draw = random.Random(seed)
    seconds = draw.sample(range(50), 12)
    got = licenses.increasing(list(enumerate(seconds)))
    best = [1] * 12
    for i in range(12):
        best[i] = 1 + max([best[j] for j in range(i) if seconds[j] < seconds[i]], default=0)
    assert len(got) == max(best) and got == sorted(got) and [s for _, s in got] == sorted(s for _, s in got)


@pytest.mark.parametrize("text", sorted(LINES))
def test_planted_texts(text):
    draw = random.Random(text)
    filler = lambda n: " ".join(f"word{draw.randrange(99)}" for _ in range(n))
    for planted in (text, text.upper().replace(",", ""), text.replace(" ", "\n * ")):
        found = licenses.scan(f"{filler(50)}. {planted} {filler(30)} {planted}".encode())
        assert [m.license for m in found] == [LINES[text]] * 2
        assert all(m.coverage == 1 for m in found) and found[0].start == 50
    words = text.split()
    if len(words) > 30:  # some words changed, some added
        for _ in range(4):
            words[draw.randrange(len(words))] = "changed"
            words.insert(draw.randrange(len(words)), "added")
        found = licenses.scan(f"{filler(50)} {' '.join(words)} {filler(9)}".encode())
        assert [m.license for m in found] == [LINES[text]] and 0.8 <= found[0].coverage < 1
    half = licenses.scan(f"{filler(40)} {' '.join(text.split()[: len(text.split()) // 2])} {filler(40)}".encode())
    own = licenses.words_of(text.encode())
    assert all(m.matched < len(own) / 2 + 1 and m.coverage == 1 for m in half)  # at most a shorter text inside it


def test_every_document(spark, sf_dir):
    """In these documents a license is one line; it is found where the line stands."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in licenses.op9_license_scan(spark, "/root/testdata/sf0.01").collect()}
    short = {text: name for text, name in LINES.items() if len(text) < 90}
    for doc in docs:
        want = {name for text, name in short.items() if text in doc.text}
        assert set(filter(None, got[doc.doc_id].licenses.split(","))) == want
    assert len(got) == len(docs) and any(r.n_matches for r in got.values())


def test_odd_rows(spark):
    line = "Released under the MIT License."
    rows = [(None, line, "x"), (1, None, "y"), (1, "", "y"), (1, "", "y"), (2, "word " * 60_000 + line, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, licenses string")
    got = sorted((tuple(r) for r in licenses.license_scan(docs).collect()), key=str)
    assert got == sorted([(None, "MIT", 1, 5, 1.0), *[(1, "", 0, 0, None)] * 3, (2, "MIT", 1, 5, 1.0)], key=str)
    assert licenses.license_scan(docs.limit(0)).collect() == []


GPL3 = max((form for form in TEMPLATES["GPL-3.0"] if "This program is free" in form[:30]), key=len)
BSD2 = max(TEMPLATES["BSD-2-Clause"], key=len)
MIT = max(TEMPLATES["MIT"], key=len)


@pytest.mark.parametrize(
    ("text", "wrong"),
    [
        ("Licensed under the BSD License.", "MIT"),
        ("Licensed under the Apache License.", "MIT"),
        ("Licensed under the Apache License, Version 1.1.", "Apache-2.0"),
        ("This work is licensed under the GNU General Public License, version 2.", "GPL-3.0"),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", "GPL-3.0"),
        (GPL3.replace("version 3", "version 2"), "GPL-3.0"),
        (GPL3.replace("GNU General", "GNU Lesser General"), "GPL-3.0"),
        (GPL3.replace("GNU General", "GNU Affero General"), "GPL-3.0"),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-4.0"),
        ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "CC-BY-4.0"),
        ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "CC-BY-NC-4.0"),
        ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-4.0"),
        (
            BSD2.replace("THIS SOFTWARE IS PROVIDED", "3. Neither the name of the copyright holder nor the names of its "
            "contributors may be used to endorse or promote products derived from this software without specific prior "
            "written permission. THIS SOFTWARE IS PROVIDED"),
            "BSD-2-Clause",
        ),
        (MIT.replace("THE SOFTWARE IS PROVIDED", "The Software shall be used for Good, not Evil. THE SOFTWARE IS PROVIDED"), "MIT"),
    ],
)
def test_siblings(text, wrong):
    assert wrong not in {m.license for m in licenses.scan(f"some words before {text} and after".encode())}


@pytest.mark.parametrize("license", ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0"])
def test_whole_texts(license):
    """A full text is one match over all its words, also with a copyright line before and some words changed."""
    own = max(TEMPLATES[license], key=len).split()
    draw = random.Random(license)
    for n in draw.sample(range(40, len(own)), 10):
        own[n] = "changed"
    (found,) = licenses.scan(f"Copyright 2020 Somebody {' '.join(own)}".encode())
    assert found.license == license and found.end - found.start > 0.99 * len(licenses.words_of(" ".join(own).encode()))


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (GPL3.replace("version 3", "version 2"), "GPL-2.0"),
        (GPL3.replace("GNU General", "GNU Lesser General"), "LGPL-3.0"),
        (GPL3.replace("GNU General", "GNU Affero General"), "AGPL-3.0"),
        ("This work is licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1"),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
        ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"),
        ("This work is licensed under a Creative Commons Attribution-NoDerivs 3.0 Unported License.", "CC-BY-ND-3.0"),
        (TEMPLATES["GPL-3.0"][-1].replace("GENERAL PUBLIC LICENSE", "AFFERO GENERAL PUBLIC LICENSE", 1).replace("29 June 2007", "19 November 2007"), None),
    ],
)
def test_relatives_by_their_own_name(text, want):
    found = {m.license for m in licenses.scan(text.encode())}
    assert found == {want} if want else "GPL-3.0" not in {m.license for m in licenses.scan(text.encode()) if m.matched > 1000}


def test_further_texts(spark):
    docs = spark.createDataFrame([(1, "x y Use this as the House License 7 allows. z")], "doc_id long, text string")
    (row,) = licenses.license_scan(docs, {"House-7": ["Use this as the House License 7 allows."]}).collect()
    assert (row.licenses, row.n_matches, row.n_license_words) == ("House-7", 1, 8)
    assert licenses.license_scan(docs).first().licenses == ""


FULL = {name: max(forms, key=len) for name, forms in TEMPLATES.items()}
PART = " ".join(FULL["GPL-3.0"].split()[:3000])
REPEATED = {
    "lines": (min(FULL.values(), key=len) + "\n", 8000),
    "whole licenses": (FULL["GPL-3.0"] + "\n", 30),
    "parts of a license": (PART + " and so on ", 50),
    "two licenses in turn": (FULL["Apache-2.0"] + "\n" + FULL["MPL-2.0"] + "\n", 30),
}


@pytest.mark.parametrize("name", sorted(REPEATED))
def test_long_repeated_texts_end(name):
    text, times = REPEATED[name]
    whole = (text * times)[:1_000_000].encode()
    licenses.index()
    took = []
    for part in (whole[: len(whole) // 4], whole):
        began = time.perf_counter()
        found = licenses.scan(part)
        took.append(time.perf_counter() - began)
    # In proportion: four times the text in about four times the time, not sixteen.
    assert took[1] < 8 * took[0] + 1
    if name in ("whole licenses", "two licenses in turn"):
        each = len(licenses.scan(text.encode()))
        assert len(found) >= (len(whole) // len(text)) * each
    if name == "lines":
        assert len(found) == whole.count(b"\n")
    assert all(a.end <= b.start for a, b in zip(found, found[1:]))
