"""Benchmark decontamination by a prefix-filtered set join.

The items' windows (WINDOW consecutive words; a shorter item is one window) are records, their shingles of up to SHINGLE words the
tokens. Tokens are ordered by rarity, the number of documents that hold them. As a window must be contained whole, its necessary
prefix is its rarest token, and a window with a token that no document holds is dropped. Documents are joined on prefix tokens only; the length bound (the window must
fit into the document) and the positional bound (the token must stand as far into the document as it stands in the window)
go first, and what is left is compared word by word.

Both sides are tables of any size. Documents are read once: a filter of the tokens' bits, the only thing that is broadcast and at most MOST_BITS large,
leaves the shingles that can be tokens, with their positions, and the texts that have one. Rarity, prefixes, candidates and items are joins on tokens, rows and windows; a token that
stands in many documents is a hot key of a plain join, which Spark splits. A filter that is full lets more shingles through and changes no result.

Edge cases: null or empty texts have no words and no hits; items without words never occur; repeated items each count; a null item id
counts as a hit of words but isn't listed; null document ids and repeated rows are kept, a row each. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.storage import bounded_batches, written
from tallyforge.llm.words import grams, slices, words

WINDOW = 10
SHINGLE = 5
#: Bits of the filter: so many for each token, within these bounds (512 KB and 64 MB).
BITS_A_TOKEN, LEAST_BITS, MOST_BITS = 64, 1 << 22, 1 << 29
#: Most document keys (about 30 bytes each) that are broadcast to filter rows; beyond it the same join shuffles.
BROADCAST_ROWS = 1_000_000


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, text) to the windows of each item: its words, their number and the tokens in order."""
    for batch in batches:
        for low, high in slices(batch.column("text")):
            part = batch.slice(low, high - low)
            w = words(part.column("text"))
            of = {k: dict(zip(*(v.tolist() for v in grams(w, k)), strict=True)) for k in range(1, SHINGLE + 1)}
            item, window, length, tokens = [], [], [], []
            for name, a, b in zip(part.column("item_id").to_pylist(), w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
                n = min(WINDOW, b - a)
                size = min(SHINGLE, n)
                for start in range(a, b - n + 1) if n else ():
                    item.append(name)
                    window.append(b" ".join(w.text(i) for i in range(start, start + n)))
                    length.append(n)
                    tokens.append([of[size][i] for i in range(start, start + n - size + 1)])
            flat = np.array([t for ts in tokens for t in ts], np.uint64).view(np.int64)
            ends = pa.array(np.concatenate([[0], np.cumsum([len(ts) for ts in tokens])]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.string()), pa.array(window, pa.binary()), pa.array(length, pa.int32()), pa.ListArray.from_arrays(ends, pa.array(flat))], names=["item_id", "window", "length", "tokens"])


def _filter(tokens: DataFrame, n: int) -> np.ndarray:
    """Two bits for each of about ``n`` tokens, as 64-bit words; the driver gets at most MOST_BITS / 64 of them."""
    bits = LEAST_BITS
    while bits < min(n * BITS_A_TOKEN, MOST_BITS):
        bits *= 2
    at = F.explode(F.array(F.col("token").bitwiseAND(bits - 1), F.shiftrightunsigned("token", 32).bitwiseAND(bits - 1))).alias("at")
    parts = tokens.select(at).select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[parts["word"].to_numpy()] = parts["bits"].to_numpy()
    return out.view(np.uint64)


def _passes(bits: np.ndarray, value: np.ndarray) -> np.ndarray:
    mask = np.uint64(len(bits) * 64 - 1)

    def probe(at: np.ndarray) -> np.ndarray:
        return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1

    found = np.flatnonzero(probe(value & mask))
    return found[probe((value[found] >> np.uint64(32)) & mask)]


def _scan(sizes: list[int], shared):
    """The pass over the documents: words counted; shingles that the filter lets through, with the word they begin at; texts that have one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for low, high in slices(batch.column("text")):
                part = batch.slice(low, high - low)
                w = words(part.column("text"))
                row, at, token = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
                for k in sizes:
                    start, value = grams(w, k)
                    hit = _passes(bits, value)
                    row.append(w.row[start[hit]])
                    at.append(start[hit] - w.first[row[-1]])
                    token.append(value[hit])
                row, at, token = np.concatenate(row), np.concatenate(at), np.concatenate(token)
                order = np.argsort(row, kind="stable")
                many = np.bincount(row, minlength=part.num_rows)
                ends = pa.array(np.concatenate([[0], np.cumsum(many)]).astype(np.int32))
                text = part.column("text").take(pa.array(np.arange(part.num_rows), mask=many == 0))
                yield pa.RecordBatch.from_arrays(
                    [part.column("rid"), part.column("doc_id"), pa.array(w.count.astype(np.int64)), text, pa.ListArray.from_arrays(ends, pa.array(token[order].view(np.int64))), pa.ListArray.from_arrays(ends, pa.array(at[order].astype(np.int32)))],
                    names=["rid", "doc_id", "n_words", "text", "token", "at"],
                )

    return run


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate windows of a text, compared word by word: merged ranges of hit words, their number and the windows found."""
    for batch in batches:
        for low, high in slices(batch.column("text")):
            part = batch.slice(low, high - low)
            w = words(part.column("text"))
            ranges, found = [], []
            for r, cands in enumerate(part.column("cands").to_pylist()):
                first = int(w.first[r])
                same = [c for c in cands if b" ".join(w.text(i) for i in range(first + c["start"], first + c["start"] + c["length"])) == c["window"]]
                ranges.append(_merge([(c["start"], c["start"] + c["length"]) for c in same]))
                found.append(list({c["window"] for c in same}))
            hits = [sum(b - a for a, b in m) for m in ranges]
            yield pa.RecordBatch.from_arrays(
                [part.column("rid"), pa.array(hits, pa.int64()), pa.array([[v for ab in m for v in ab] for m in ranges], pa.list_(pa.int64())), pa.array(found, pa.list_(pa.binary()))],
                names=["rid", "n_hit", "ranges", "found"],
            )


def _merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, ranges) of every document; ranges are merged word positions [from, to, ...] of its hits."""
    spark = docs.sparkSession
    bounded_batches(spark)
    items = benchmark.select(F.col(item_col).cast("string").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    windows = written(items.mapInArrow(_windows, "item_id string, window binary, length int, tokens array<long>"), "windows")
    token = windows.select(F.explode("tokens").alias("token"))
    about = windows.agg(F.count("*").alias("n"), F.collect_set(F.least("length", F.lit(SHINGLE))).alias("sizes")).first()  # neighbouring windows share tokens
    sizes = sorted(about["sizes"])
    shared = spark.sparkContext.broadcast(_filter(token, about["n"]))
    base = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    scanned = written(base.mapInArrow(_scan(sizes, shared), f"rid long, doc_id {kind}, n_words long, text string, token array<long>, at array<int>"), "scanned")

    held = scanned.where("text is not null")
    rarity = held.select(F.explode(F.array_distinct("token")).alias("token")).groupBy("token").agg(F.count("*").alias("n")).join(token.distinct(), "token")
    each = windows.select("window", "length", "tokens").distinct().select("window", "length", F.size("tokens").alias("most"), F.posexplode("tokens").alias("offset", "token"))
    rarest = F.min(F.struct("n", "offset", "token")).alias("p")
    prefix = each.join(rarity, "token").groupBy("window", "length", "most").agg(F.count("*").alias("there"), rarest).where("there = most").select("window", "length", "p.offset", "p.token")
    hits = held.select("rid", "n_words", F.explode(F.arrays_zip("token", "at")).alias("h")).select("rid", "n_words", "h.token", "h.at")
    start = F.col("at") - F.col("offset")
    cands = hits.join(prefix, "token").where((start >= 0) & (start + F.col("length") <= F.col("n_words")))
    grouped = cands.groupBy("rid").agg(F.collect_list(F.struct(start.alias("start"), "length", "window")).alias("cands"))  # a text's own windows
    found = written(held.select("rid", "text").join(grouped, "rid").mapInArrow(_verify, "rid long, n_hit long, ranges array<long>, found array<binary>").where("n_hit > 0"), "found")
    named = windows.where("item_id is not null").select("window", "item_id").distinct()
    listed = found.select("rid", F.explode("found").alias("window")).join(named, "window").groupBy("rid").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    hit = found.select("rid", "n_hit", "ranges").join(listed, "rid", "left")
    zero, none = F.lit(0).cast("long"), F.array().cast("array<string>")
    out = scanned.select("rid", "doc_id", "n_words").join(hit, "rid", "left").withColumn("items", F.coalesce("items", none))
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"), "items", F.coalesce("ranges", F.array().cast("array<long>")).alias("ranges"),
    )


def cleaned(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the contaminated rows; other rows and all columns stay as they are."""
    key = F.struct(F.col(id_col).alias("i"), F.xxhash64(F.col(text_col)).alias("c"))
    keyed = docs.select(key.alias("__key"), F.col(text_col).alias("__text"))
    dirty = written(contamination(keyed, benchmark, "__key", "__text").where("contaminated").select(F.col("doc_id.i").alias("__id"), F.col("doc_id.c").alias("__content")).distinct(), "dirty")
    side = F.broadcast(dirty) if dirty.count() <= BROADCAST_ROWS else dirty
    return docs.join(side, F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(text_col)) == F.col("__content")), "left_anti")
