import zlib

import numpy as np

from tallyforge.llm import language_hd as hd


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = hd.identified(df).join(df.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 100 and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


def test_cosine_by_brute_force(spark):
    texts = ["the cat and the hat", "la casa es roja y grande"]
    df = spark.createDataFrame([(t, lang) for t, lang in zip(texts, ("en", "es"), strict=True)], "text string, lang string")
    known = dict(hd.prototypes(df))
    vectors = {}
    for t, lang in zip(texts, ("en", "es"), strict=True):
        padded = f" {t} "
        total = np.zeros(hd.DIMENSIONS)
        for i in range(len(padded) - 2):
            codes = [int(hd._letters()[ord(c)]) for c in padded[i : i + 3]]
            total += np.roll(hd._vectors()[codes[0]], 2).astype(int) * np.roll(hd._vectors()[codes[1]], 1) * hd._vectors()[codes[2]]
        vectors[lang] = total / (len(padded) - 2)
        assert np.allclose(known[lang], vectors[lang])
    mean = (vectors["en"] + vectors["es"]) / 2
    a = vectors["en"] - mean
    got = {r["text"]: r for r in hd.predictions(df, sorted(known.items())).collect()}
    assert got[texts[0]]["lang_pred"] == "en" and got[texts[1]]["lang_pred"] == "es"
    assert abs(got[texts[0]]["score"] - a @ a / (np.linalg.norm(a) ** 2)) < 1e-6


def test_edges(odd_docs, no_docs):
    rows = hd.identified(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[3]["lang_pred"] == by[4]["lang_pred"] == by[5]["lang_pred"] == "und" and by[None]["held_out"] is False
    assert hd.identified(no_docs).count() == 0
    assert {r["lang_pred"] for r in hd.predictions(odd_docs.select("text"), []).collect()} == {"und"}


def test_predictions_leave_their_input(spark):
    """A frame can be judged twice, and may have columns of the results' names already."""
    df = spark.createDataFrame([("the words of the text", 7, "x", "y")], "text string, score long, lang_pred string, __text string")
    known = [("a", hd.trigram_vectors(np.array([1, 2])).sum(0).astype(float)), ("b", hd.trigram_vectors(np.array([3])).sum(0).astype(float))]
    before = df.columns
    for _ in range(2):
        out = hd.predictions(df, known)
        assert out.columns == ["text", "__text", "lang_pred", "score"] and out.first()["__text"] == "y" and out.first()["lang_pred"] in ("a", "b")
    assert df.columns == before and df.schema.names == before


def test_many_languages(spark):
    """Bundles of any number of languages are learned exactly, batch by batch."""
    rows = [(f"l{i % 60}", f"{chr(97 + i % 26)}{chr(97 + i % 7)} word{i}") for i in range(900)]
    got = dict(hd.prototypes(spark.createDataFrame(rows, "lang string, text string")))
    assert len(got) == 60
    for lang in ("l0", "l37"):
        parts = [hd.trigrams(t) for x, t in rows if x == lang]
        total = sum(int(n.sum()) for _, n in parts)
        assert np.allclose(got[lang], sum((hd.trigram_vectors(k).T.astype(float) @ n) for k, n in parts) / total)
