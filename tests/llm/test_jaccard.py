import random
import re

import networkx_free as nx

from tallyforge.llm import graph
from tallyforge.llm import jaccard_join as jj


def sets_of(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = {i: sets_of(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    root = nx.roots(links)
    count = {i: 0 for i in sets}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    return {i: (root.get(i, i), count[i]) for i in sets}


def fixture():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for base in range(25):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 30, 80, 300]))]
        for _ in range(rng.choice([1, 2, 6, 12])):
            changed = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                changed[rng.randrange(len(changed))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(changed)))
    return rows


def test_brute_force(spark, monkeypatch):
    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute(rows)
    for block in (1024, 5):  # components that span blocks give the same
        monkeypatch.setattr(jj, "BLOCK", block)
        got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jj.jaccard_classes(df).collect()}
        assert got == expected
    assert max(n for _, n in expected.values()) > 5
    kept = {r["doc_id"] for r in jj.deduplicated(df).collect()}
    assert kept == {c for c, _ in expected.values()}


def test_chain_of_boilerplate(spark, monkeypatch):
    """Sets that share boilerplate chain into one large candidate component; refining leaves the near copies, with the same links."""
    rng = random.Random(8)
    rows, shared = [], [f"p{k}" for k in range(120)]
    for d in range(40):
        own = [f"o{d}_{k}" for k in range(100)]
        for copy in range(3):
            words = [*shared, *own]
            if copy:
                words[rng.randrange(len(words))] = f"x{rng.random()}"
            rows.append((len(rows), " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(jj, "BLOCK", 8)
    sizes, components = [], jj.components
    monkeypatch.setattr(jj, "components", lambda edges: (lambda out: sizes.append(out.groupBy("root").count().agg({"count": "max"}).first()[0]) or out)(components(edges)))
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jj.jaccard_classes(df).collect()} == brute(rows)
    assert sizes[0] > 24 and sizes[2] == 3  # of the candidates, and of what survives


def test_large_components_take_few_stages(spark, monkeypatch):
    """Few candidate edges take no round on the cluster, and large components give the same whether their values are broadcast or shuffled."""
    rng = random.Random(9)
    rows, shared = [], [f"p{k}" for k in range(200)]
    for d in range(12):
        words = [*shared, *(f"o{d}_{k}" for k in range(100))]
        rows.append((len(rows), " ".join(words)))
        words[rng.randrange(len(words))] = "x"
        rows.append((len(rows), " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(jj, "BLOCK", 5)
    names, put = [], graph.written
    monkeypatch.setattr(graph, "written", lambda df, name: names.append(name) or put(df, name))
    for most in (20_000, 0):
        monkeypatch.setattr(jj, "BROADCAST_SETS", most)
        assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jj.jaccard_classes(df).collect()} == brute(rows)
    assert names.count("edges") == 8 and "minima" not in names  # four graphs a run: of bands, hubs, bridges and links


def test_dense_and_sparse_overlaps_agree():
    import numpy as np

    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(12)]
    i, j = np.triu_indices(12, 1)
    exact = [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j, strict=True)]
    assert jj._overlaps(sets, i, j).tolist() == exact  # matrix products
    assert jj._overlaps(sets, i[:3], j[:3]).tolist() == exact[:3]  # one by one


def test_posterior_bound():
    needed = jj.needed_matches()
    assert list(needed) == list(range(32, 289, 32)) and needed[288] < 0.8 * 288
    assert all(needed[a] <= needed[b] for a, b in zip(list(needed)[:-1], list(needed)[1:], strict=True))


def test_edges(odd_docs, no_docs):
    got = sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in jj.jaccard_classes(odd_docs).collect()), key=str)
    assert (1, 1, 1) in got and (2, 1, 1) in got and (3, 3, 0) in got and (4, 4, 0) in got and got.count((7, 7, 1)) == 2 and len(got) == odd_docs.count()
    kept = jj.deduplicated(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    assert ids == ["1", "3", "4", "5", "6", "7", "8", "9", "None"]
    assert jj.jaccard_classes(no_docs).count() == 0 and jj.deduplicated(no_docs).count() == 0
