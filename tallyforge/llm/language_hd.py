"""Language identification with hyperdimensional profiles.

Every letter has a random +1/-1 vector. The three letters of a trigram are bound by rotating their vectors by two, one and
no places and multiplying them; a text's vector is the sum (bundle) of its trigrams' vectors. A language's prototype
is the bundle over the labelled documents, and a text gets the language whose prototype has the largest cosine with it.
Prototypes are centred (their mean is taken off all of them and off the text) so that what all languages share, such as the
space between words, doesn't count.

Edge cases: a null or letterless text is ``und`` with score 0; a null id is never held out and never learned from; a
null label isn't learned from; with no labelled document at all every text is ``und``. Repeated rows are each judged. Other columns are never read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tallyforge.llm.storage import bounded_batches

DIMENSIONS = 512
#: Letter classes: 0 is what stands between words, 1-26 a to z; other letters share the rest by code point.
CLASSES = 128
#: Trigram vectors that a worker keeps; beyond it they are made anew.
CACHE_ROWS = 40_000
UNDETERMINED = "und"


@lru_cache(1)
def _letters() -> np.ndarray:
    """Class of each code point of the basic plane, upper and lower case alike."""
    out = np.zeros(1 << 16, np.uint8)
    for cp in range(1 << 16):
        if 0xD800 <= cp < 0xE000 or unicodedata.category(chr(cp))[0] != "L":
            continue
        c = ord(chr(cp).lower()[0])
        out[cp] = c - 96 if 97 <= c <= 122 else 27 + c % (CLASSES - 27)
    return out


@lru_cache(1)
def _vectors() -> np.ndarray:
    return (np.random.default_rng(8191).integers(0, 2, (CLASSES, DIMENSIONS), dtype=np.int8) * 2 - 1).astype(np.int8)


def trigram_vectors(keys: np.ndarray) -> np.ndarray:
    """Bound vectors of trigram keys, (first * CLASSES + second) * CLASSES + third."""
    v = _vectors()
    return np.roll(v, 2, 1)[keys // (CLASSES * CLASSES)] * np.roll(v, 1, 1)[keys // CLASSES % CLASSES] * v[keys % CLASSES]


class _Cache:
    def __init__(self) -> None:
        self.row = np.full(CLASSES**3, -1, np.int32)
        self.clear()

    def clear(self) -> None:
        self.row[:] = -1
        self.vectors = np.zeros((256, DIMENSIONS), np.float32)
        self.used = 0

    def get(self, keys: np.ndarray) -> np.ndarray:
        new = keys[self.row[keys] < 0]
        if len(new):
            if self.used + len(new) > CACHE_ROWS:
                self.clear()
                new = keys
                if len(new) > CACHE_ROWS:
                    return trigram_vectors(keys).astype(np.float32)
            while self.used + len(new) > len(self.vectors):
                self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
            self.row[new] = np.arange(self.used, self.used + len(new))
            self.vectors[self.used : self.used + len(new)] = trigram_vectors(new)
            self.used += len(new)
        return self.vectors[self.row[keys]]


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigram keys and counts of a whole text; runs of other characters are one space, and one stands at either end."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    classes = _letters()[np.minimum(points, 0xFFFF)].astype(np.int64)
    beyond = points > 0xFFFF
    if beyond.any():  # supplementary planes: by category, one by one
        classes[beyond] = [27 + p % (CLASSES - 27) if unicodedata.category(chr(p))[0] == "L" else 0 for p in points[beyond].tolist()]
    classes = np.concatenate([[0], classes, [0]])
    keep = np.ones(len(classes), bool)
    keep[1:] = (classes[1:] != 0) | (classes[:-1] != 0)
    classes = classes[keep]
    if len(classes) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.unique((classes[:-2] * CLASSES + classes[1:-1]) * CLASSES + classes[2:], return_counts=True)


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to one bundle a language, in whole numbers so that the order of summing doesn't matter.

    A batch's trigrams are counted by language, then bundled; between batches a language holds DIMENSIONS numbers, so any number of languages fits."""
    bundles: dict[str, np.ndarray] = {}
    total: dict[str, int] = {}
    for batch in batches:
        found: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            keys, n = trigrams(text.as_py())
            if len(keys):
                found.setdefault(lang, []).append((keys, n))
        for lang, parts in found.items():
            keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            counts = np.bincount(where, np.concatenate([n for _, n in parts])).astype(np.int64)
            bundle = bundles.setdefault(lang, np.zeros(DIMENSIONS, np.int64))
            total[lang] = total.get(lang, 0) + int(counts.sum())
            for low in range(0, len(keys), 4096):
                part = slice(low, low + 4096)
                bundle += (trigram_vectors(keys[part]).astype(np.float64).T @ counts[part]).astype(np.int64)
    for lang, bundle in bundles.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([total[lang]]), pa.array([bundle.tolist()], pa.list_(pa.int64()))], names=["lang", "n", "bundle"])


def prototypes(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text") -> list[tuple[str, np.ndarray]]:
    """Centred prototypes from all labelled rows, by language name; the driver gets DIMENSIONS numbers for each language."""
    bounded_batches(labelled.sparkSession)
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang is not null and text is not null")
    sums = rows.mapInArrow(_learn, "lang string, n long, bundle array<long>").select("lang", "n", F.posexplode("bundle").alias("at", "x")).groupBy("lang", "at").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    by: dict[str, np.ndarray] = {}
    for r in sums.collect():
        by.setdefault(r["lang"], np.zeros(DIMENSIONS))[r["at"]] = r["x"] / r["n"]
    return sorted(by.items())


def predictions(docs: DataFrame, known: list[tuple[str, np.ndarray]], text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (the larger of 0 and the cosine) added; columns of these names are replaced, the others pass through."""
    bounded_batches(docs.sparkSession)
    names = [n for n, _ in known]
    matrix = np.stack([v for _, v in known]) if known else np.zeros((0, DIMENSIONS))
    mean = matrix.mean(0) if len(names) > 1 else np.zeros(DIMENSIONS)
    centred = matrix - mean
    centred = centred / np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-12)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Cache()
        for batch in batches:
            lang, score = [], []
            for text in batch.column(-1):
                keys, n = trigrams(text.as_py())
                if not len(keys) or not names:
                    lang.append(UNDETERMINED)
                    score.append(0.0)
                    continue
                v = np.zeros(DIMENSIONS)
                for low in range(0, len(keys), 8192):
                    v += n[low : low + 8192].astype(np.float32) @ cache.get(keys[low : low + 8192])
                v = v / n.sum() - mean
                cosine = centred @ v / max(float(np.linalg.norm(v)), 1e-12)
                best = int(np.argmax(cosine))
                lang.append(names[best])
                score.append(float(min(1.0, max(0.0, cosine[best]))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=[*batch.schema.names[:-1], "lang_pred", "score"])

    kept = [f for f in docs.schema if f.name not in ("lang_pred", "score")]
    text = F.col(text_col).cast("string").alias("__text of the document")  # the last column, whatever the others are called
    return docs.select(*(F.col(f"`{f.name}`") for f in kept), text).mapInArrow(judge, StructType([*kept, StructField("lang_pred", StringType()), StructField("score", DoubleType())]))


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4."""
    return F.crc32(F.col(id_col).cast("string")) % 4


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row; learned only from rows whose fold isn't 2."""
    known = prototypes(docs.where(fold(id_col) != 2), lang_col, text_col)
    ids = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(fold(id_col) == 2, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    return predictions(ids, known).drop("text")
