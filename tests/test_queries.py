"""Every query runs on the smallest tables, and agrees with its oracle where it has one."""

import datetime
import decimal
import math
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from tallyforge.plans.oracles import ORACLES
from tallyforge.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted(repr(tuple(plain(v) for v in r)) for r in df.select(*cols).collect())
    assert rows
    if name in ORACLES:
        r = duck.sql(ORACLES[name])
        assert sorted(r.columns) == cols
        order = [r.columns.index(c) for c in cols]
        assert rows == sorted(repr(tuple(plain(x[i]) for i in order)) for x in r.fetchall())


def test_line_grouping_takes_all_lines(spark, duck):
    """Every row is a word of a line, and a page holds no more words in a larger table."""
    got = QUERIES["line_grouping"](spark, SF).collect()
    assert sum(r["n"] for r in got) == duck.sql("SELECT count(*) FROM lineitem").fetchall()[0][0]
    pages = {}
    for r in got:
        pages[r["page"]] = pages.get(r["page"], 0) + r["n"]
    assert pages == dict(duck.sql("SELECT l_orderkey // 64, count(*) FROM lineitem GROUP BY 1").fetchall())


def test_without_the_subpackage(tmp_path):
    """The entry imports and keeps its other queries when the training-data subpackage is gone."""
    root = Path(__file__).resolve().parents[1]
    for p in [root / "__spark_entry__.py", *(root / "tallyforge").rglob("*.py")]:
        if "llm" not in p.relative_to(root).parts:
            to = tmp_path / p.relative_to(root)
            to.parent.mkdir(parents=True, exist_ok=True)
            to.write_text(p.read_text())
    code = "import __spark_entry__ as e; q = e.queries(); assert 'reconciliation' in q and not any(n.startswith('op1') for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=100)
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_module")  # a broken import is no missing subpackage
    broken = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=100)
    assert broken.returncode and "no_such_module" in broken.stderr


def test_hierarchy_against_brute_force(spark, duck):
    """The solver's rules on flat tables, written out: equal neighbours, then totals of the rows before or after, nearest first, until nothing changes."""
    from tallyforge.plans.queries import _LINE_ORDER

    tables = {}
    for key, v, q in duck.sql(f"SELECT l_orderkey, floor(l_extendedprice), l_quantity FROM lineitem ORDER BY l_orderkey, {', '.join(_LINE_ORDER)}").fetchall():
        tables.setdefault(key, []).append((v, q))
    expected = set()
    for key, rows in tables.items():
        rows = [*rows, tuple(map(sum, zip(*rows, strict=True)))]
        parent, kids, only = [None] * len(rows), [[] for _ in rows], [False] * len(rows)
        near = lambda a, b: all(abs(x - y) <= 1 for x, y in zip(a, b, strict=True))

        def link(t, parts, relation, key=key, rows=rows, parent=parent, kids=kids, only=only):
            kids[t] += parts
            only[t] = relation == "single_component"
            for p in parts:
                parent[p] = t
            expected.update((key, relation, c, t + 1, tuple(p + 1 for p in parts), sum(rows[p][c] for p in parts)) for c in range(2))

        for t in range(len(rows) - 1):
            if parent[t + 1] is None and not kids[t] and near(rows[t], rows[t + 1]):
                link(t, [t + 1], "single_component")
        changed = True
        while changed:
            changed = False
            for t in range(len(rows)):
                for relation, order in (("sum_of_preceding", range(t - 1, -1, -1)), ("sum_of_following", range(t + 1, len(rows)))):
                    if kids[t] and not only[t]:
                        break
                    free = [i for i in order if parent[i] is None][:14]
                    size = next((n for n in range(2, len(free) + 1) if near(rows[t], tuple(map(sum, zip(*(rows[i] for i in free[:n]), strict=True))))), None)
                    if size:
                        link(t, sorted(free[:size]), relation)
                        changed = True
    got = QUERIES["hierarchy_solver"](spark, SF).collect()
    assert {(r["l_orderkey"], r["relation"], r["column"], r["parent_row"], tuple(r["component_rows"]), r["computed"]) for r in got} == expected and len(got) == len(expected)
    assert all(r["passed"] == (abs(r["difference"]) <= 1) and r["difference"] == r["expected"] - r["computed"] for r in got)


def test_line_grouping_against_brute_force(spark, duck):
    pages = {}
    for page, c in duck.sql("SELECT l_orderkey // 64 AS page, l_linenumber * 40 + l_suppkey % 17 + 15 AS c FROM lineitem ORDER BY page, c").fetchall():
        lines = pages.setdefault(page, [])
        middle = lambda xs: (sorted(xs)[(len(xs) - 1) // 2] + sorted(xs)[len(xs) // 2]) / 2
        close = [(abs(middle(xs) - c), n) for n, xs in list(enumerate(lines))[-3:] if abs(middle(xs) - c) <= 22]
        if close:
            lines[min(close)[1]].append(c)
        else:
            lines.append([c])
    got = {(r["page"], r["line_no"]): r["n"] for r in QUERIES["line_grouping"](spark, SF).collect()}
    assert got == {(p, n): len(xs) for p, lines in pages.items() for n, xs in enumerate(lines)}


def test_title_similarity_against_difflib(spark, duck):
    from difflib import SequenceMatcher

    names = {k: (r, n.translate(str.maketrans("0123456789_", "ABCDEFGHIJ ")).replace("i", "İ").replace("ı", "I").upper()) for k, n, r in duck.sql("SELECT n_nationkey, n_name, n_regionkey FROM nation").fetchall()}
    clean = {k: (r, " ".join("".join(c for c in n if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZÇĞİÖŞÜ ").split())) for k, (r, n) in names.items()}
    expected = {(a, b): round(SequenceMatcher(None, clean[a][1], clean[b][1]).ratio(), 6) for a in clean for b in clean if a < b and clean[a][0] == clean[b][0]}
    assert {(r["a"], r["b"]): r["similarity"] for r in QUERIES["title_similarity"](spark, SF).collect()} == expected
