import hashlib
import re

from pyspark.sql import functions as F

from tallyforge.llm import mixing as mx


def brute_targets(sizes):
    """The resharing as stated, one source after another."""
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {s: float(mx.WEIGHTS[i % 3]) for i, (s, _) in enumerate(order)}
    limit, left, open_, out = {s: 2.0 * n for s, n in order}, 1.5 * sum(n for _, n in order), [s for s, _ in order], {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total > limit[s]]
        if not full:
            return out | {s: left * weight[s] / total for s in open_}
        out |= {s: limit[s] for s in full}
        left -= sum(limit[s] for s in full)
        open_ = [s for s in open_ if s not in out]
    return out


def bits(*parts):
    return int(hashlib.md5(":".join(parts).encode()).hexdigest()[:12], 16)


def brute_copies(rows, cell_rows):
    """Systematic sampling row by row: (id, text, source) to copies."""
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    text, by = {i: t or "" for i, t, _ in rows}, {}
    for i, _, s in rows:
        by.setdefault(s, []).append(i)
    goal = brute_targets([(s, sum(size[i] for i in ids)) for s, ids in by.items()])
    seed, out = str(mx.SEED), {}

    def cls(n):
        if n < 256:
            return n
        octave = n.bit_length() - 1
        return 256 + octave * 64 + int((n / 2**octave - 1) * 64)

    for s, ids in by.items():
        total = sum(size[i] for i in ids)
        expected = goal[s] / total if total else 0.0
        offset = bits(seed, "offset", "null" if s is None else f"={s}") / 2**48
        u = {i: bits(seed, str(i), hashlib.md5(text[i].encode()).hexdigest()) for i in ids}
        many = {c: sum(cls(size[i]) == c for i in ids) for c in {cls(size[i]) for i in ids}}
        salt = {i: int(u[i] / 2**48 * (1 + many[cls(size[i])] // cell_rows)) for i in ids}
        for n, i in enumerate(sorted(ids, key=lambda i: (-cls(size[i]), salt[i], -size[i], u[i], i)), 1):
            out[i] = 0 if not size[i] else int(expected) if expected == int(expected) else int(n * expected + offset) - int((n - 1) * expected + offset)
    return out


def test_targets(spark):
    find = lambda sizes: {r["source"]: r["target"] for r in mx.targets(spark.createDataFrame(sizes, "source string, n long")).collect()}
    got = find([("b", 100), ("a", 100), (None, 100)])
    assert got["a"] == 200 and abs(sum(got.values()) - 450) < 1e-9 and got["b"] > got[None]
    sizes = [(f"s{i}", n) for i, n in enumerate([10, 1000, 30, 500, 7, 0])]
    got = find(sizes)
    assert abs(sum(got.values()) - 1.5 * 1547) < 1e-6 and all(got[s] <= 2 * n + 1e-9 for s, n in sizes)
    free = {s: got[s] / (5, 2, 1)[i % 3] for i, (s, n) in enumerate(sizes) if got[s] < 2 * n - 1e-9}
    assert max(free.values()) - min(free.values()) < 1e-6
    assert find([]) == {} and find([("a", 0)]) == {"a": 0}
    many = [(f"s{i}", 3**(i % 11) + i % 7) for i in range(400)] + [(None, 900)]
    got, want = find(many), brute_targets(many)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_against_brute_force(spark, monkeypatch):
    """Equal copies row by row, with and without salts, a hot source, a class of equal sizes and sizes over several octaves."""
    rows = [(i, " ".join(["w"] * (40 if i % 3 == 0 else 1 + i * i % 1500)) if i % 50 else None, "hot" if i % 4 else f"s{i % 3}" if i % 8 else None) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for cell in (mx.CELL_ROWS, 20):
        monkeypatch.setattr(mx, "CELL_ROWS", cell)
        assert {r["doc_id"]: r["copies"] for r in mx.mixed(df).collect()} == brute_copies(rows, cell)


def test_systematic(spark, monkeypatch):
    monkeypatch.setattr(mx, "CELL_ROWS", 20)
    rows = [(i, " ".join(["w"] * (1 + i * i % 97)) + ("\n" if i % 2 else ""), f"s{i % 4}" if i % 5 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mx.mixed(df).cache()
    assert out.count() == 400
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t, _ in rows}
    by = {}
    for r in out.collect():
        assert r["size"] == sizes[r["doc_id"]] and r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        expected = r["target"] / r["source_size"]
        assert int(expected) <= r["copies"] <= int(expected) + 1
        by.setdefault(r["source"], [r["target"], 0, 0])
        by[r["source"]][1] += r["taken"]
        by[r["source"]][2] = max(by[r["source"]][2], r["size"])
    for target, taken, largest in by.values():
        assert abs(target - taken) <= largest + 1
    again = {(r["doc_id"], r["copies"]) for r in mx.mixed(df.repartition(7)).collect()}
    assert again == {(r["doc_id"], r["copies"]) for r in out.collect()}
    mixed = mx.mix(df.withColumn("copy", F.lit("x")))
    assert mixed.count() == out.agg(F.sum("copies")).first()[0] and mixed.columns == ["doc_id", "text", "source", "copy", "copy_no"]


def test_edges(odd_docs, no_docs):
    rows = mx.mixed(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[3]["size"] == by[4]["size"] == 0 and by[3]["taken"] == 0 and by[6]["size"] == 60_000
    assert set(mx.mix(odd_docs).columns) == {*odd_docs.columns, "copy"}
    assert mx.mixed(no_docs).count() == 0 and mx.mix(no_docs).count() == 0
