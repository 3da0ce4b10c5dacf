import hashlib
import random
import re

from tallyforge.llm import decontaminate as dc


def tokens(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


def brute(text, items):
    w = tokens(text)
    hit, names = set(), set()
    for name, item in items:
        v = tokens(item)
        k = min(10, len(v))
        for s in range(len(v) - k + 1) if k else ():
            for p in range(len(w) - k + 1):
                if w[p : p + k] == v[s : s + k]:
                    hit.update(range(p, p + k))
                    names.add(str(name))
    return len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


def test_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    vocabulary = [f"v{i}" for i in range(30)]
    pick = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(pick(n))) for i, n in enumerate([25, 10, 12, 9, 3, 1, 0, 15])] + [(8, None), (9, "v1 v1 v1 v1 v1 v1 v1 v1 v1 v1 v1")]
    docs = []
    for i in range(60):
        w = pick(rng.choice([0, 5, 40, 100]))
        for _ in range(rng.choice([0, 1, 2])):
            v = tokens(rng.choice(items)[1])
            a = rng.randrange(len(v) + 1)
            at = rng.randrange(len(w) + 1)
            w[at:at] = v[a : a + rng.choice([9, 10, 11, 30])]
        docs.append((i, rng.choice([" ", ", ", "\n- "]).join(w).upper() if i % 7 == 0 else " ".join(w)))
    docs.append((60, "v1 " * 30))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    expected = {i: brute(t, items) for i, t in docs}
    for bits in (1 << 22, 1 << 11, 1 << 6):  # a filter with room, a crowded one and one that lets all through
        monkeypatch.setattr(dc, "LEAST_BITS", bits)
        monkeypatch.setattr(dc, "MOST_BITS", bits)
        got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in dc.contamination(d, b).collect()}
        assert got == expected
    clean = {r["doc_id"] for r in dc.cleaned(d, b).collect()}
    assert clean == {i for i, e in expected.items() if not e[4]} and len(clean) > 0


def test_edges(spark, odd_docs, no_docs):
    b = spark.createDataFrame([(1, "the same words stand here again and again"), (None, "word"), (3, None)], "item_id long, text string")
    rows = dc.contamination(odd_docs, b).collect()
    assert len(rows) == odd_docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_hit"] == 8 and by[1]["n_items"] == 1 and by[3]["n_words"] == 0
    assert by[8]["contaminated"] and by[8]["n_items"] == 0
    assert dc.cleaned(odd_docs, b).columns == odd_docs.columns
    assert dc.contamination(no_docs, b).count() == 0
    assert dc.contamination(odd_docs, b.limit(0)).where("contaminated").count() == 0


def test_filter_has_all_tokens(spark):
    """The driver's filter knows every token and few others, of whatever number they are."""
    import numpy as np

    rng = np.random.default_rng(2)
    known, other = rng.integers(-(1 << 63), (1 << 63) - 1, 100_000), rng.integers(-(1 << 63), (1 << 63) - 1, 100_000)
    bits = dc._filter(spark.createDataFrame([(int(k),) for k in known], "token long"), len(known))
    assert len(bits) * 64 == 1 << 23
    assert len(dc._passes(bits, known.view(np.uint64))) == len(known)
    assert len(dc._passes(bits, other.view(np.uint64))) < 0.002 * len(other)


def test_one_pass_over_the_documents(spark, tmp_path):
    """However many items there are, the documents are scanned once; only the broadcast filter and tables of hits follow the benchmark."""
    docs = [(i, " ".join(f"w{(i * 7 + j * (1 + i % 3)) % 997}" for j in range(60))) for i in range(50)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/d.parquet")
    items = [(i, " ".join(f"w{(i + j * (1 + i % 3)) % 997}" for j in range(14))) for i in range(600)]
    got = {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in dc.contamination(spark.read.parquet(f"{tmp_path}/d.parquet"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {i: brute(t, items)[1:3] for i, t in docs} and any(n for n, _ in got.values())
