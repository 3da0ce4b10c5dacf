import corpus_pipeline as cp
import test_decontaminate
import test_jaccard
from pyspark.sql import functions as F

from tallyforge.llm import pii_crf
from tallyforge.llm.storage import written


def test_stages_on_fixture(spark, tmp_path):
    rows = test_jaccard.fixture()
    extra = [("only clean words in this one here",), ("write to bob@site.example.org soon please, all of you",), ("123 456 ...",), (None,), (rows[0][1],)]
    docs = [(i, t, None if i % 9 == 0 else "en", f"s{i % 3}", len(t or "")) for i, t in [*rows, *((1000 + k, t) for k, (t,) in enumerate(extra))]]
    leak = " ".join(rows[5][1].split()[:12])
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept, seen = {d[0]: d[1] for d in docs}, {}
    for name, stage in cp.STAGES:
        df = written(stage(spark, df, str(tmp_path)), name)
        seen[name] = {r["doc_id"]: r for r in df.collect()}
        if name != "mixing":
            assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    kept = {i: t for i, t in kept.items() if t and any(c.isalpha() for c in t)}
    assert set(seen["language_id"]) == set(kept) and all(r["lang"] == "en" for r in seen["language_id"].values())
    classes = test_jaccard.brute(list(kept.items()))
    kept = {i: t for i, t in kept.items() if classes[i][0] == i}
    assert set(seen["near_duplicates"]) == set(kept)
    kept = {i: t for i, t in kept.items() if not test_decontaminate.brute(t, [(1, leak)])[4]}
    assert set(seen["decontamination"]) == set(kept)
    assert {i: r["text"] for i, r in seen["pii"].items()} == {i: "write to [email] soon please, all of you" if i == 1001 else t for i, t in kept.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in seen["pii"].values())
    out = cp.run(spark, str(tmp_path))
    assert {(r["doc_id"], r["copy"]) for r in out.collect()} == {(r["doc_id"], r["copy"]) for r in df.collect()}
    size = {i: len(r["text"].split()) for i, r in seen["pii"].items()}
    taken = sum(size[r["doc_id"]] for r in out.collect())
    assert abs(taken - 1.5 * sum(size.values())) <= 3 * max(size.values())


def test_edges(spark, tmp_path, odd_docs, no_docs):
    for name, df in (("odd", odd_docs), ("none", no_docs)):
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(1, "nothing of this kind occurs")], "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        out = cp.run(spark, f"{tmp_path}/{name}")
        assert out.columns == [*odd_docs.columns, "copy"]
        assert out.where("text is null").count() == 0 and (out.count() > 0) == (name == "odd")
    assert pii_crf.KINDS and F


def test_language_without_labels(spark, tmp_path):
    """With nothing to learn from, only texts without a letter go."""
    texts = ["clean words", "ñ", "12 34 ...", "", None, "日本語", "1 𝒳"]
    for ids, langs in ((range(7), [None] * 7), ([None] * 7, ["en"] * 7)):
        df = spark.createDataFrame([(i, t, lang, "s", 1) for i, t, lang in zip(ids, texts, langs, strict=True)], "doc_id long, text string, lang string, source string, n_chars long")
        got = cp.language_id(spark, df, str(tmp_path)).collect()
        assert {r["text"] for r in got} == {"clean words", "ñ", "日本語", "1 𝒳"} and {r["lang"] for r in got} == set(langs)
