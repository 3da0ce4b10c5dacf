import random
import re

import networkx_free as nx
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyforge.llm import graph
from tallyforge.llm.graph import components
from tallyforge.llm.words import grams, shingle_sets, slices, words

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB9 é\n-日", max_size=30)), max_size=8))
def test_words(texts):
    w = words(pa.array(texts, pa.string()))
    expected = [[x.encode() for x in PATTERN.findall(lower(t))] for t in texts]
    assert [[w.text(i) for i in range(w.first[r], w.first[r + 1])] for r in range(len(texts))] == expected
    by_hash = {}
    for i in range(len(w.hashed)):
        assert by_hash.setdefault(int(w.hashed[i]), w.text(i)) == w.text(i)
    at, value = grams(w, 2)
    flat = [x for e in expected for x in e]
    assert len({(flat[i], flat[i + 1]) for i in at.tolist()}) == len(set(value.tolist()))
    values, bounds = shingle_sets(w, 3)
    sets = [{tuple(e[i : i + 3]) for i in range(max(1, len(e) - 2))} if e else set() for e in expected]
    assert [len(s) for s in sets] == (bounds[1:] - bounds[:-1]).tolist()
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            got = set(values[bounds[i] : bounds[i + 1]].tolist()) & set(values[bounds[j] : bounds[j + 1]].tolist())
            assert len(a & b) == len(got)


def test_slices():
    column = pa.array(["x" * 10, None, "y" * 30, "", "z"])
    assert [c for c in slices(column, 10)] == [(0, 2), (2, 3), (3, 5)]
    assert list(slices(pa.array([], pa.string()))) == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (103, 101), (5, 5), (200, 210), (210, 200)]
    df = spark.createDataFrame([*edges, (None, 1)], "u long, v long")
    got = {r["u"]: r["root"] for r in components(df).collect()}
    assert got == nx.roots([e for e in edges if e[0] != e[1]])
    assert components(df.limit(0)).count() == 0


def test_few_edges_are_settled_in_one_task(spark, monkeypatch):
    """Up to TASK_EDGES edges no round runs; beyond it rounds do, down to that number or to the end, with the same roots."""
    rng = random.Random(3)
    edges = [(rng.randrange(100), rng.randrange(100)) for _ in range(800)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(1900, 2000)]
    df = spark.createDataFrame(edges, "u long, v long")
    expected = nx.roots([e for e in edges if e[0] != e[1]])
    rounds, star = [], graph._large_star
    monkeypatch.setattr(graph, "_large_star", lambda e: rounds.append(1) or star(e))
    taken = {}
    for most in (500_000, 400, 0):
        monkeypatch.setattr(graph, "TASK_EDGES", most)
        rounds.clear()
        got = [(r["u"], r["root"]) for r in components(df).collect()]
        assert dict(got) == expected and len(got) == len(expected)
        taken[most] = len(rounds)
    assert taken[500_000] == 0 < taken[400] < taken[0]
