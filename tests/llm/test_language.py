"""Languages of held-out documents, gradients against differences, odd rows."""

import zlib

import numpy as np

from gridloom.llm import language


def test_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = language.op7_language_id(spark, sf_dir).collect()
    assert {r.doc_id for r in found} == set(docs)
    held = [r for r in found if r.held_out]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out for r in found)
    right = np.mean([r.lang_pred == docs[r.doc_id].lang for r in held])
    assert right > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_gradients():
    draw = np.random.default_rng(3)
    network = language.Network.fresh(3, draw)
    for p in network.parameters():
        p[...] = draw.normal(size=p.shape) * 0.3
    for name in ("embedding", "output", "constant"):
        setattr(network, name, getattr(network, name).astype(np.float64))
    network.filters = [f.astype(np.float64) for f in network.filters]
    network.biases = [b.astype(np.float64) for b in network.biases]
    windows, labels = draw.integers(0, 257, (5, 30)), draw.integers(0, 3, 5)
    loss = lambda: -np.log(network.probabilities(windows)[np.arange(5), labels]).mean()
    for p, g in zip(network.parameters(), network.gradients(windows, labels), strict=True):
        flat, own = p.reshape(-1), g.reshape(-1)
        for i in np.argsort(-np.abs(own))[:5]:
            before, flat[i] = flat[i], flat[i] + 1e-5
            up = loss()
            flat[i] = before - 1e-5
            down = loss()
            flat[i] = before
            assert abs((up - down) / 2e-5 - own[i]) < 1e-5


def test_tables_give_the_same():
    draw = np.random.default_rng(4)
    network = language.Network.fresh(5, draw)
    windows = draw.integers(0, 257, (9, language.WINDOW)).astype(np.int16)
    looked_up = network.looked_up(windows, network.pair_tables())
    assert np.allclose(looked_up, network.probabilities(windows), atol=1e-5)


def test_windows_hold_the_whole_text():
    text = ("Àb" * 999).encode()
    windows = language.windows_of(text)
    symbols = windows[windows != 256].astype(np.uint8).tobytes()
    assert symbols == text.translate(language.LOWER_AZ)
    assert language.windows_of(b"").shape == (1, language.WINDOW)


def test_repeated_rows_change_nothing(spark):
    texts = {"de": "der die das und ist nicht", "en": "the of and to in is", "fr": "le la les des une est", "es": "el los las una que por"}
    one = [(n, text, lang) for n, (lang, text) in enumerate(texts.items()) if zlib.crc32(str(n).encode()) % 4 != 2]
    one += [(n + 40, texts[lang] + " x", lang) for n, lang in enumerate(texts) if zlib.crc32(str(n + 40).encode()) % 4 != 2]
    docs = spark.createDataFrame(one, "doc_id long, text string, lang string")
    many = docs.crossJoin(spark.range(3000)).drop("id")
    names, network = language.fit(docs)
    again, same = language.fit(many)
    assert names == again == sorted({lang for _, _, lang in one})
    assert all((a == b).all() for a, b in zip(network.parameters(), same.parameters(), strict=True))


def test_each_language_is_learned(spark):
    rows = [(n, f"the of and {n} {'a' * (n % 50)}", "en") for n in range(4000)] + [(9000 + next(n for n in range(9) if zlib.crc32(str(9000 + n).encode()) % 4 != 2), "der die das", "de"), (9002, "", "xx"), (9003, "12", "xx")]
    names, _ = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert names == ["de", "en"]


def test_odd_rows(spark):
    rows = [(i, ("der die das " if i % 2 else "the of and ") * 30, "de" if i % 2 else "en", i) for i in range(60)]
    odd = [(None, "the of and", None, 1), (100, None, "en", 1), (100, "", "de", 1), (100, "12 34 _ !", "en", 1), (101, "die das " * 30_000, None, None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score int")
    got = language.languages(docs)
    found = sorted((-1 if r.doc_id is None else r.doc_id, r.lang_pred) for r in got.collect())
    assert found == sorted([(i, lang) for i, _, lang, _ in rows] + [(-1, "en"), (100, "und"), (100, "und"), (100, "und"), (101, "de")])
    assert language.languages(docs.limit(0)).collect() == []
    unknown = language.languages(docs.where("lang is null")).collect()
    assert {r.lang_pred for r in unknown} == {"und"}
