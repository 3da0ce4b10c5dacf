"""Chroma audio fingerprints of a media column.

A recording (WAV bytes, 16-bit PCM) becomes pitch-class frames: the spectrum's energy folded onto 12 classes. Differences of rectangle
sums, taken from an integral image over the frames, are each quantised to two bits of a Gray code; FILTERS of them make one packed
integer for each frame. Two recordings are aligned by the histogram of offsets at which they have equal parts (PARTS of each integer's bits, so that one wrong bit
doesn't hide a frame): of the TRIED fullest offsets the one of the fewest unequal bits wins, and
the share of unequal bits over the overlap at that offset is their distance.

A search is a stated query set against all rows, in blocks: each task has a block of recordings and a block of queries (a row is shipped once for each QUERY_BLOCK queries), looks the
queries' parts up in an index of its recordings' parts and emits
every alignment of at most MAX_BIT_ERROR, and each query's best whatever its error. Recordings with equal fingerprints are one class and are
compared once, so results are pairs of classes with a membership of ids. No integer is left out for being frequent.

Edge cases: null, empty or undecodable audio, and audio shorter than a filter, has an empty fingerprint and matches nothing; repeated rows and ids are
copies of each other; null ids are not queries and never a match; empty tables give an empty result. Other columns are never read.
"""

from __future__ import annotations

import io
import wave
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.storage import written

FRAME, HOP = 512, 128
LOWEST, HIGHEST = 60.0, 1900.0
FILTERS = 16
WIDTH = 12
CUTS = (-0.25, 0.0, 0.25)
#: Parts of an integer, as (shift, bits), that are looked up.
PARTS = ((0, 16), (8, 16), (16, 16))
#: An offset needs so many equal parts; so many of the fullest offsets are tried.
MIN_VOTES, TRIED = 3, 3
#: An alignment shares so many frames at least, or all of the shorter recording; fewer agree too often by chance.
MIN_OVERLAP = 24
#: Recordings match up to this share of unequal bits. Of 80,000 pairs of unrelated recordings of 50 integers the nearest have 0.21 at the best of all offsets.
MAX_BIT_ERROR = 0.2
ROW_BLOCK, QUERY_BLOCK = 4096, 16384


def _filters() -> list[tuple[int, int, int, int]]:
    """(kind, first class, height, width), by a rule that spreads kinds, places and sizes."""
    out = []
    for i in range(FILTERS):
        height = (4, 6, 12)[i % 3]
        out.append((i % 5, (i * 5) % (13 - height), height, (4, 8, 12)[(i // 3) % 3]))
    return out


def samples(audio: bytes | None) -> tuple[np.ndarray, int]:
    """Mono samples in -1..1 and the rate; empty if the bytes aren't 16-bit PCM WAV."""
    try:
        with wave.open(io.BytesIO(audio or b"")) as w:
            if w.getsampwidth() != 2:
                return np.zeros(0), 1
            x = np.frombuffer(w.readframes(w.getnframes()), np.int16).reshape(-1, w.getnchannels()).mean(1)
            return x / 32768.0, w.getframerate()
    except (wave.Error, EOFError, ValueError):
        return np.zeros(0), 1


def chroma(x: np.ndarray, rate: int) -> np.ndarray:
    """(frames x 12) energies of the pitch classes, each frame of sum 1."""
    n = (len(x) - FRAME) // HOP + 1
    if n < 1:
        return np.zeros((0, 12))
    spectrum = np.abs(np.fft.rfft(np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP] * np.hanning(FRAME), axis=1)) ** 2
    f = np.fft.rfftfreq(FRAME, 1 / rate)
    used = np.flatnonzero((f >= LOWEST) & (f <= HIGHEST))
    fold = np.zeros((len(f), 12))
    fold[used, np.round(12 * np.log2(f[used] / 440.0)).astype(int) % 12] = 1
    out = spectrum @ fold
    return out / np.maximum(out.sum(1, keepdims=True), 1e-12)


def fingerprint(x: np.ndarray, rate: int) -> np.ndarray:
    """A packed integer for each position of the widest filter."""
    frames = chroma(x, rate)
    n = len(frames) - WIDTH + 1
    if n < 1:
        return np.zeros(0, np.uint32)
    image = np.zeros((len(frames) + 1, 13))
    image[1:, 1:] = frames.cumsum(0).cumsum(1)
    t = np.arange(n)

    def area(t0: np.ndarray, t1: np.ndarray, c0: int, c1: int) -> np.ndarray:
        return image[t1, c1] - image[t0, c1] - image[t1, c0] + image[t0, c0]

    out = np.zeros(n, np.uint32)
    for kind, c, h, w in _filters():
        e, half, mid = t + w, t + w // 2, c + h // 2
        whole = area(t, e, c, c + h)
        if kind == 0:
            part = area(t, e, mid, c + h)
        elif kind == 1:
            part = area(half, e, c, c + h)
        elif kind == 2:
            part = area(half, e, mid, c + h) + area(t, half, c, mid)
        elif kind == 3:
            part = area(t, e, c + h // 4, c + h - h // 4)
        else:
            part = area(t + w // 4, e - w // 4, c, c + h)
        ratio = np.log((0.05 + part) / (0.05 + whole - part))
        level = np.searchsorted(CUTS, ratio, side="right")
        out = (out << np.uint32(2)) | np.array([0, 1, 3, 2], np.uint32)[level]
    return out


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint(*samples(a.as_py())) for a in batch.column("audio")]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([f.tobytes() for f in found], pa.binary())], names=["id", "print"])


def fingerprints(media: DataFrame, id_col: str, audio_col: str) -> DataFrame:
    """(id, print): the packed integers, little-endian, of every row's audio."""
    kind = media.schema[id_col].dataType.simpleString()
    return media.select(F.col(id_col).alias("id"), F.col(audio_col).alias("audio")).mapInArrow(_prints, f"id {kind}, print binary")


def _parts(values: np.ndarray) -> np.ndarray:
    """Keys of the parts of each integer (integers x PARTS); a key names its part."""
    return np.stack([((values >> np.uint32(shift)) & np.uint32((1 << bits) - 1)).astype(np.int64) | (p << 32) for p, (shift, bits) in enumerate(PARTS)], axis=1)


def aligned(queries: list[np.ndarray], rows: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """(query, row, offset, votes, bit errors, overlap) of each pair with MIN_VOTES or more at an offset of enough overlap: of its TRIED fullest offsets (ties: the one
    nearest 0, then the smaller) the one with the smallest share of unequal bits."""
    n_rows = np.array([len(r) for r in rows])
    flat, starts = np.concatenate(rows) if rows else np.zeros(0, np.uint32), np.cumsum(n_rows) - n_rows
    row, at = np.repeat(np.arange(len(rows)), n_rows), np.concatenate([np.arange(n) for n in n_rows]) if len(rows) else np.zeros(0, int)
    value = _parts(flat).reshape(-1)
    order = np.argsort(value, kind="stable")
    value, place = value[order], order // len(PARTS)
    out: list[list[np.ndarray]] = []
    for q, ints in enumerate(queries):  # one query's matches at a time bound the memory
        own = _parts(ints).reshape(-1)
        a, b = np.searchsorted(value, own), np.searchsorted(value, own, side="right")
        many = b - a
        if not many.sum():
            continue
        i = place[np.repeat(a, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
        width = len(ints) + int(n_rows.max()) + 1
        key, votes = np.unique(row[i] * (2 * width) + (at[i] - np.repeat(np.arange(len(own)) // len(PARTS), many)) + width, return_counts=True)
        r, offset = key // (2 * width), key % (2 * width) - width
        shared = np.minimum(len(ints), n_rows[r] - offset) - np.maximum(0, -offset)
        enough = (votes >= MIN_VOTES) & (shared >= np.minimum(MIN_OVERLAP, np.minimum(len(ints), n_rows[r])))
        r, offset, votes = r[enough], offset[enough], votes[enough]
        best = np.lexsort((offset, np.abs(offset), -votes, r))
        r, offset, votes = r[best], offset[best], votes[best]
        nth = np.arange(len(r)) - np.searchsorted(r, r)
        r, offset, votes = r[nth < TRIED], offset[nth < TRIED], votes[nth < TRIED]
        errors, overlap = np.zeros(len(r), np.int64), np.zeros(len(r), np.int64)
        for low in range(0, len(r), 20_000):
            s = slice(low, low + 20_000)
            there = np.arange(len(ints)) + offset[s, None]
            inside = (there >= 0) & (there < n_rows[r[s], None])
            other = flat[np.where(inside, there + starts[r[s], None], 0)]
            errors[s], overlap[s] = np.where(inside, np.bitwise_count(other ^ ints), 0).sum(1), inside.sum(1)
        best = np.lexsort((np.arange(len(r)), errors / np.maximum(overlap, 1), r))
        best = best[np.searchsorted(r[best], np.unique(r))]
        out.append([np.full(len(best), q), r[best], offset[best], votes[best], errors[best], overlap[best]])
    return tuple(np.concatenate([o[c] for o in out]) if out else np.zeros(0, int) for c in range(6))


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (rb, qb); a run of equal keys is one block of recordings with one of queries. Emits all alignments that match and each query's best."""
    held, key = [], None

    def settle(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(parts)
        cls, wants = t["cls"].to_numpy(), t["wants"].to_numpy(zero_copy_only=False)
        prints = [np.frombuffer(p, np.uint32) for p in t["print"].to_pylist()]
        qs, rs = np.flatnonzero(wants), np.flatnonzero(~wants)
        q, r, offset, votes, errors, overlap = aligned([prints[i] for i in qs], [prints[i] for i in rs])
        a, b = cls[qs[q]] if len(q) else np.zeros(0, np.int64), cls[rs[r]] if len(r) else np.zeros(0, np.int64)
        other = a != b
        a, b, offset, votes, errors, overlap = (v[other] for v in (a, b, offset, votes, errors, overlap))
        rate = np.round(errors / (32.0 * np.maximum(overlap, 1)), 9)
        best = np.lexsort((b, -votes, -overlap, rate, a))
        first = np.concatenate([[True], a[best][1:] != a[best][:-1]]) if len(best) else np.zeros(0, bool)
        best = best[first | (rate[best] <= MAX_BIT_ERROR)]
        for low in range(0, len(best), 50_000):
            some = best[low : low + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(v[some].astype(k)) for v, k in ((a, np.int64), (b, np.int64), (offset, np.int64), (votes, np.int64), (overlap, np.int64), (rate, np.float64))], names=["cls", "hit", "offset", "votes", "overlap", "ber"])

    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("rb", "qb")])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            now = tuple(keys[:, a].tolist())
            if now != key and held:
                yield from settle(held)
                held = []
            held.append(batch.slice(a, b - a))
            key = now
    if held:
        yield from settle(held)


def search(prints: DataFrame, is_query) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(best, alignments, members) of the rows of ``prints(id long, print)`` that ``is_query`` holds for, against all rows.

    Best is the other recording nearest to each query: (query_id, match_id, offset, votes, overlap, ber, matched); the least bit error, then the longest overlap,
    the most votes and the smallest class; a recording with an equal fingerprint is at distance 0. match_id is the smallest
    id of the class met (other than the query's own). Rows that meet nothing have nulls and matched false.

    Alignments are all pairs of a query's class and another class with a bit error of at most MAX_BIT_ERROR: (query_class, match_class, offset, votes, overlap, ber).
    Members give the class of each id with a fingerprint, (id, cls, n) with its n integers; a class is named by its smallest id.
    """
    prints = written(prints.where("id is not null"), "prints")
    classes = prints.where("length(print) > 0").groupBy("print").agg(F.min("id").alias("cls"))
    named = written(prints.join(classes, "print", "left").select("id", "cls", is_query.alias("wants")), "classes")
    classes = written(classes, "class-prints")
    wanted = named.where("wants and cls is not null").select("cls").distinct()
    asked = written(classes.join(wanted, "cls", "left_semi"), "queries")
    n_rows, n_queries = classes.count(), asked.count()
    rb, qb = -(-n_rows // ROW_BLOCK) or 1, -(-n_queries // QUERY_BLOCK) or 1
    spread = lambda df, own, blocks, other, others, wants: df.select("cls", "print", F.pmod(F.xxhash64("cls"), F.lit(blocks)).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other), F.lit(wants).alias("wants"))
    both = spread(classes, "rb", rb, "qb", qb, False).unionByName(spread(asked, "qb", qb, "rb", rb, True))
    met = both.repartition("rb", "qb").sortWithinPartitions("rb", "qb", "wants", "cls").mapInArrow(_search, "cls long, hit long, offset long, votes long, overlap long, ber double")
    met = written(met, "alignments")
    best = met.groupBy("cls").agg(F.min(F.struct("ber", (-F.col("overlap")).alias("o"), (-F.col("votes")).alias("v"), F.col("hit"), F.col("offset"))).alias("b"))
    copies = named.where("id <> cls").groupBy("cls").agg(F.min("id").alias("copy"))
    sizes = prints.select("id", (F.length("print") / 4).cast("long").alias("n"))
    asks = named.where("wants").join(sizes.distinct(), "id").join(copies, "cls", "left").join(best, "cls", "left")
    same = F.when(F.col("id") != F.col("cls"), F.col("cls")).otherwise(F.col("copy"))
    twin = same.isNotNull()
    ber = F.when(twin, 0.0).otherwise(F.col("b.ber"))
    nearest = asks.select(
        F.col("id").alias("query_id"), F.coalesce(same, "b.hit").alias("match_id"), F.when(twin, 0).otherwise(F.col("b.offset")).cast("long").alias("offset"),
        F.when(twin, F.col("n")).otherwise(-F.col("b.v")).alias("votes"), F.when(twin, F.col("n")).otherwise(-F.col("b.o")).alias("overlap"), ber.alias("ber"), F.coalesce(ber <= MAX_BIT_ERROR, F.lit(False)).alias("matched"),
    )
    alignments = met.where(F.col("ber") <= MAX_BIT_ERROR).select(F.col("cls").alias("query_class"), F.col("hit").alias("match_class"), "offset", "votes", "overlap", "ber")
    members = written(named.where("cls is not null").select("id", "cls").join(sizes.distinct(), "id"), "members")
    return nearest, alignments, members


def matches(prints: DataFrame, is_query) -> DataFrame:
    """The best of ``search``: one row a query."""
    return search(prints, is_query)[0]


def related(prints: DataFrame, is_query) -> DataFrame:
    """All that ``search`` finds, in one table with ``relation``: ``best`` (one row a query), ``alignment`` (pairs of classes) and ``member`` (each id and its class)."""
    best, alignments, members = search(prints, is_query)
    pairs = alignments.select(F.col("query_class").alias("query_id"), F.col("match_class").alias("match_id"), "offset", "votes", "overlap", "ber", F.lit(True).alias("matched"))
    own = members.select(F.col("id").alias("query_id"), F.col("cls").alias("match_id"), F.lit(0).cast("long").alias("offset"), F.col("n").alias("votes"), F.col("n").alias("overlap"), F.lit(0.0).alias("ber"), F.lit(True).alias("matched"))
    named = [df.withColumn("relation", F.lit(relation)) for df, relation in ((best, "best"), (pairs, "alignment"), (own, "member"))]
    return named[0].unionByName(named[1]).unionByName(named[2])


# --- recordings made from vectors -------------------------------------------------------------------------------------

RATE, NOTE = 4000, 256


def melody(vector: list[float] | None) -> bytes | None:
    """A WAV recording of a vector: two components a note, the first its pitch (two octaves above 220 Hz), the second its loudness."""
    if not vector:
        return None
    v = np.nan_to_num(np.array([x or 0.0 for x in vector], np.float64))
    v = np.concatenate([v, np.zeros(len(v) % 2)]).reshape(-1, 2) * np.sqrt(len(v))
    steps = np.clip(np.round(v[:, 0] * 6 + 12), 0, 24)
    t = np.arange(NOTE) / RATE
    tone = np.sin(2 * np.pi * (220.0 * 2 ** (steps[:, None] / 12)) * t) * (0.5 + 0.4 * np.tanh(v[:, 1, None]))
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(RATE)
        w.writeframes((tone.reshape(-1) * 32000).astype(np.int16).tobytes())
    return out.getvalue()


def rendered(vectors: DataFrame, id_col: str, vector_col: str, render: Callable = melody) -> DataFrame:
    """(id, audio) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([render(v.as_py()) for v in part.column("v")], pa.binary())], names=["id", "audio"])

    kind = vectors.schema[id_col].dataType.simpleString()
    return vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).mapInArrow(run, f"id {kind}, audio binary")
