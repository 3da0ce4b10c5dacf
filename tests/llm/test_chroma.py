import io
import wave

import numpy as np
from pyspark.sql import functions as F

from tallyforge.llm import chroma


def wav(x, rate=4000):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(x, -1, 1) * 32000).astype(np.int16).tobytes())
    return out.getvalue()


def tune(seed, notes=40):
    rng = np.random.default_rng(seed)
    t = np.arange(256) / 4000
    return np.concatenate([0.6 * np.sin(2 * np.pi * 220 * 2 ** (rng.integers(0, 24) / 12) * t) for _ in range(notes)])


def media(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(40):
        x = tune(i)
        rows.append((20 * i, wav(x)))  # the queries
        rows.append((20 * i + 1, wav(np.concatenate([np.zeros(0), tune(1000 + i, 6), x]) + rng.normal(0, 0.01, 256 * 46))))  # delayed by six notes, with noise
    rows += [(2001, rows[0][1]), (2003, None), (2005, b"junk"), (2007, wav(np.zeros(10))), (None, rows[0][1]), (2020, None)]
    return spark.createDataFrame(rows, "id long, audio binary").withColumns({"cls": F.lit(1), "print": F.lit("x")})


def test_search_and_brute_force(spark, monkeypatch):
    monkeypatch.setattr(chroma, "ROW_BLOCK", 16)
    monkeypatch.setattr(chroma, "QUERY_BLOCK", 8)
    prints = chroma.fingerprints(media(spark), "id", "audio").cache()
    got = {r["query_id"]: r for r in chroma.matches(prints, F.col("id") % 20 == 0).collect()}
    assert set(got) == {20 * i for i in range(40)} | {2020}
    assert got[0]["match_id"] == 2001 and got[0]["ber"] == 0.0  # an equal recording
    assert got[2020]["match_id"] is None and got[2020]["matched"] is False
    found = sum(got[20 * i]["match_id"] == 20 * i + 1 and abs(got[20 * i]["offset"] - 12) <= 1 for i in range(1, 40))
    assert found >= 0.9 * 39
    rows = {r["id"]: np.frombuffer(r["print"], np.uint32) for r in prints.where("id is not null").collect()}
    pairs = {(r["query_id"], r["match_id"]): r for r in chroma.related(prints, F.col("id") % 20 == 0).where("relation = 'alignment'").collect()}
    for q in range(20, 200, 20):  # the least bit error of every row over all offsets
        errors = {i: least_error(rows[q], v) for i, v in rows.items() if i != q and len(v)}
        near = {i for i, e in errors.items() if e <= chroma.MAX_BIT_ERROR}
        assert near == {m for a, m in pairs if a == q} and near
        assert all(abs(pairs[q, i]["ber"] - errors[i]) < 1e-8 for i in near)
        assert (errors[got[q]["match_id"]], got[q]["matched"]) == (min(errors.values()), True)


def least_error(a, b):
    shares = []
    for offset in range(-len(a), len(b)):
        low, high = max(0, -offset), min(len(a), len(b) - offset)
        if high - low >= min(chroma.MIN_OVERLAP, len(a), len(b)):
            shares.append(int(np.bitwise_count(a[low:high] ^ b[low + offset : high + offset]).sum()) / (32 * (high - low)))
    return min(shares)


def test_recall_on_the_table(spark):
    """Recordings of the table's own vectors, and noisy copies of them, against the brute force over all rows and offsets: at least 0.9 of the pairs under the cut, and nothing else."""
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").orderBy("vec_id").limit(200).collect()
    rng = np.random.default_rng(11)
    clean = [chroma.samples(chroma.melody(list(r["embedding"])))[0] for r in vectors]
    rows = [chroma.fingerprint(x, chroma.RATE) for x in clean]
    right = found = wrong = 0
    for noise in (0.05, 0.2, 0.3, 0.4):
        queries = [chroma.fingerprint(x + rng.normal(0, noise, len(x)), chroma.RATE) for x in clean[::20]]
        q, r, _, _, errors, overlap = chroma.aligned(queries, rows)
        got = {(a, b) for a, b, e, n in zip(q.tolist(), r.tolist(), errors.tolist(), overlap.tolist(), strict=True) if e <= chroma.MAX_BIT_ERROR * 32 * n}
        truth = {(a, b) for a, x in enumerate(queries) for b, y in enumerate(rows) if least_error(x, y) <= chroma.MAX_BIT_ERROR}
        right, found, wrong = right + len(truth), found + len(truth & got), wrong + len(got - truth)
    assert right >= 20 and found >= 0.9 * right and wrong == 0


def test_all_alignments_and_members(spark, monkeypatch):
    """A query with two copies and three noisy ones has all of them, over several blocks."""
    monkeypatch.setattr(chroma, "ROW_BLOCK", 4)
    rng = np.random.default_rng(3)
    x = tune(5)
    rows = [(0, wav(x)), (1, wav(x)), (2, wav(x)), *((10 + i, wav(np.concatenate([tune(50 + i, 2 + i), x]) + rng.normal(0, 0.01, 256 * (42 + i)))) for i in range(3)), *((30 + i, wav(tune(90 + i))) for i in range(6)), (20, wav(x)), (40, None)]
    df = spark.createDataFrame(rows, "id long, audio binary")
    got = chroma.related(chroma.fingerprints(df, "id", "audio"), F.col("id") % 20 == 0).collect()
    by = {k: [r for r in got if r["relation"] == k] for k in ("best", "alignment", "member")}
    assert {(r["query_id"], r["match_id"]) for r in by["best"]} == {(0, 1), (20, 0), (40, None)}
    hits = {(r["query_id"], r["match_id"]): r for r in by["alignment"]}
    assert len(hits) == len(by["alignment"]) and {(0, 10), (0, 11), (0, 12)} <= set(hits) and all(q == 0 and m not in (0, 1, 2, 20) for q, m in hits)
    assert [abs(hits[0, 10 + i]["offset"] - 2 * (2 + i)) <= 1 and hits[0, 10 + i]["ber"] <= chroma.MAX_BIT_ERROR for i in range(3)] == [True] * 3
    assert {r["query_id"]: r["match_id"] for r in by["member"]} == {i: 0 if i in (0, 1, 2, 20) else i for i, a in rows if a}


def test_integral_image_filters():
    f = chroma.fingerprint(*chroma.samples(wav(tune(1))))
    assert len(f) == 80 - 3 - chroma.WIDTH + 1 and len(set(f.tolist())) > 10
    assert len(chroma.fingerprint(np.zeros(100), 4000)) == 0
    assert chroma.melody(None) is None and chroma.melody([]) is None and len(chroma.melody([0.1] * 64)) > 1000


def test_empty(spark):
    df = spark.createDataFrame([], "id long, audio binary")
    assert chroma.matches(chroma.fingerprints(df, "id", "audio"), F.col("id") % 20 == 0).count() == 0
    v = spark.createDataFrame([(1, [0.1, None]), (2, None), (3, [])], "vec_id long, embedding array<float>")
    assert chroma.rendered(v, "vec_id", "embedding").where("audio is null").count() == 2
