"""N-gram Jaccard join with Bayesian candidate pruning.

Rows with equal shingle sets become one class by a grouping. The distinct sets get MinHash values, banded so that a pair
at the threshold shares a band with a probability of all but 1e-6. Pairs' MinHash values are compared 32 at a time and a pair goes as soon as the posterior probability
(uniform prior) that its similarity reaches the threshold is below the tolerance. What is left is verified on the full shingle sets.

Sets that share a band are neighbours in a candidate graph. A component of it that fits one block (BLOCK sets) is compared within it. Boilerplate can chain sets that have little
in common into large components, so these are refined first: each set is compared with the first of its bands, then, in bands whose sets aren't yet connected, sets of different
parts are compared band by band, in blocks, on MinHash values alone. Only pairs that survive the pruning connect, so what stays together are groups of near copies, and just these
are compared all with all, as each one's number of links is asked for.

A component's sets are cut into blocks, and each pair of blocks is one task's work. A pair meets in
exactly one pair of blocks, so links are counted without ever being written out, and each block emits at most one row a set.

Edge cases: null or empty texts (and texts without a word) have no shingles: they link to nothing and are a class of their
own. A text of fewer words than a shingle is one shingle. Repeated rows are copies of each other. A null id is kept; the
class id is the smallest non-null id of the class. Empty tables give an empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.graph import components
from tallyforge.llm.storage import bounded_batches, written
from tallyforge.llm.words import mix, shingle_sets, slices, words

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 48, 6
HASHES = BANDS * ROWS
STEP = 32
TOLERANCE = 1e-7
#: Sets in a block; a task holds two blocks.
BLOCK = 1024
#: Most ids (16 bytes each) that are broadcast to pick texts; beyond it the same join shuffles.
BROADCAST_ROWS = 1_000_000
#: Most sets whose MinHash values (some 300 bytes each) are broadcast to the pairs of large components; beyond it the same joins shuffle.
BROADCAST_SETS = 20_000

_rng = np.random.default_rng(20240607)
_A = (_rng.integers(1, 1 << 32, HASHES, dtype=np.uint64) | 1).astype(np.uint32)
_B = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)


def needed_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE, bits: int = 8) -> dict[int, int]:
    """By number of values compared, the fewest matches that keep a pair.

    A value matches with probability p = s + (1 - s) / 2**bits. With a uniform prior, P(p >= x | m of n match) equals
    P(Binomial(n + 1, x) <= m).
    """
    x, out = threshold + (1 - threshold) / (1 << bits), {}
    for n in range(STEP, HASHES + 1, STEP):
        below, m = 0.0, 0
        while (below := below + comb(n + 1, m) * x**m * (1 - x) ** (n + 1 - m)) < tolerance:
            m += 1
        out[n] = m
    return out


def minhashes(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(sets x HASHES) minima; ``bounds`` are the offsets of non-empty sets in ``values``."""
    out = np.empty((HASHES, len(bounds) - 1), np.uint32)
    step = 1 << 16
    low = 0
    while low < len(bounds) - 1:  # a stretch that stays in the CPU's cache
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + step, side="right")) - 1)
        x = (values[bounds[low] : bounds[high]] >> np.uint64(32)).astype(np.uint32)
        y, starts = np.empty_like(x), bounds[low:high] - bounds[low]
        for k in range(HASHES):
            np.multiply(x, _A[k], out=y)
            np.add(y, _B[k], out=y)
            out[k, low:high] = np.minimum.reduceat(y, starts)
        low = high
    return np.ascontiguousarray(out.T)


def _binary(matrix: np.ndarray) -> pa.Array:
    width = matrix.shape[1] * matrix.itemsize
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(np.arange(len(matrix) + 1, dtype=np.int32) * np.int32(width)), pa.py_buffer(np.ascontiguousarray(matrix))])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, cid, text) to the set's identity, size, band keys and 8-bit MinHash values."""
    from pyspark import TaskContext

    rid = TaskContext.get().partitionId() << 33
    for batch in batches:
        for low, high in slices(batch.column("text")):
            part = batch.slice(low, high - low)
            values, bounds = shingle_sets(words(part.column("text")), SHINGLE)
            size = np.diff(bounds)
            full = np.flatnonzero(size)
            a, b = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
            bands = np.zeros((len(size), BANDS), np.int64)
            low_bytes = np.zeros((len(size), HASHES), np.uint8)
            if len(full):
                starts = bounds[:-1][full]
                a[full] = np.add.reduceat(values, starts)
                b[full] = np.add.reduceat(mix(values ^ np.uint64(0x5851F42D4C957F2D)), starts)
                least = minhashes(values, np.append(starts, bounds[-1]))
                low_bytes[full] = mix(least.astype(np.uint64)).astype(np.uint8)
                key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) + np.uint64(1), (len(full), BANDS)).copy()
                for r in range(ROWS):
                    key = mix(key ^ least[:, r::ROWS].astype(np.uint64))
                bands[full] = key.view(np.int64)
            offsets = pa.array(np.arange(len(size) + 1, dtype=np.int32) * np.int32(BANDS))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(rid, rid + len(size))), part.column("doc_id"), part.column("cid"), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(size.astype(np.int32)), pa.ListArray.from_arrays(offsets, pa.array(bands.reshape(-1))), _binary(low_bytes)],
                names=["rid", "doc_id", "cid", "set_a", "set_b", "n", "bands", "sig"],
            )
            rid += len(size)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds each row's shingle set, and leaves out a row whose text isn't the one meant (64-bit content ids can clash)."""
    for batch in batches:
        for low, high in slices(batch.column("text")):
            part = batch.slice(low, high - low)
            values, bounds = shingle_sets(words(part.column("text")), SHINGLE)
            size = np.diff(bounds)
            a = np.zeros(len(size), np.uint64)
            full = np.flatnonzero(size)
            if len(full):
                a[full] = np.add.reduceat(values, bounds[:-1][full])
            keep = np.flatnonzero(a.view(np.int64) == part.column("set_a").to_numpy())
            sets = pa.array([values[bounds[i] : bounds[i + 1]].tobytes() for i in keep.tolist()], pa.binary())
            kept = part.take(pa.array(keep))
            yield pa.RecordBatch.from_arrays([*(kept.column(c) for c in ("rid", "comp", "members", "mult", "sig")), sets], names=["rid", "comp", "members", "mult", "sig", "shingles"])


def surviving_pairs(sig_x: np.ndarray, sig_y: np.ndarray, n_x: np.ndarray, n_y: np.ndarray, same: bool, needed: dict[int, int], among: np.ndarray | bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (``among`` those) that the posterior bound and the size bound leave, after all steps of the incremental comparison."""
    match = np.zeros((len(sig_x), len(sig_y)), np.uint8)
    for k in range(STEP):
        match += sig_x[:, k, None] == sig_y[None, :, k]
    ok = (match >= needed[STEP]) & among
    ok &= 5 * np.minimum(n_x[:, None], n_y[None, :]) >= 4 * np.maximum(n_x[:, None], n_y[None, :])
    i, j = np.nonzero(np.triu(ok, 1) if same else ok)
    total = match[i, j].astype(np.int32)
    for c in range(STEP, HASHES, STEP):
        if not len(i):
            break
        for low in range(0, len(i), 1 << 18):
            s = slice(low, low + (1 << 18))
            total[s] += (sig_x[i[s], c : c + STEP] == sig_y[j[s], c : c + STEP]).sum(1, dtype=np.int32)
        keep = total >= needed[c + STEP]
        i, j, total = i[keep], j[keep], total[keep]
    return i, j


def _overlaps(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact sizes of the intersections: pair by pair, or by products of 0/1 matrices where pairs are dense."""
    used, where = np.unique(np.concatenate([i, j]), return_inverse=True)
    if len(i) < 4 * len(used):
        out = np.empty(len(i), np.int64)
        for p, (a, b) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
            x, y = (sets[a], sets[b]) if len(sets[a]) < len(sets[b]) else (sets[b], sets[a])
            out[p] = np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x)
        return out
    row = np.repeat(np.arange(len(used)), [len(sets[u]) for u in used])
    _, token, seen = np.unique(np.concatenate([sets[u] for u in used]), return_inverse=True, return_counts=True)
    shared = seen[token] > 1
    row, token = row[shared], token[shared]
    _, token = np.unique(token, return_inverse=True)
    product = np.zeros((len(used), len(used)), np.float32)
    order = np.argsort(token, kind="stable")
    row, token = row[order], token[order]
    for low in range(0, int(token[-1]) + 1 if len(token) else 0, 4096):
        a, b = np.searchsorted(token, [low, low + 4096])
        dense = np.zeros((len(used), 4096), np.float32)
        dense[row[a:b], token[a:b] - low] = 1
        product += dense @ dense.T
    return product[where[: len(i)], where[len(i) :]].astype(np.int64)


def block_links(sig: np.ndarray, sets: list[np.ndarray], mult: np.ndarray, side: np.ndarray, same: bool, needed: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Of each set, the number of documents that it links to across this pair of blocks, and the root of its linked component (-1: no link)."""
    n = np.array([len(s) for s in sets])
    x, y = (np.arange(len(sets)),) * 2 if same else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
    i, j = surviving_pairs(sig[x], sig[y], n[x], n[y], same, needed)
    i, j = x[i], y[j]
    links, root = np.zeros(len(sets), np.int64), np.full(len(sets), -1)
    if len(i):
        both = _overlaps(sets, i, j)
        linked = 9 * both >= 4 * (n[i] + n[j])  # both / (n_i + n_j - both) >= 0.8, in whole numbers
        i, j = i[linked], j[linked]
        np.add.at(links, i, mult[j])
        np.add.at(links, j, mult[i])
        label = np.arange(len(sets))
        while True:  # least label over links, with shortcuts
            new = label.copy()
            np.minimum.at(new, i, label[j])
            np.minimum.at(new, j, label[i])
            new = np.minimum(new, new[new])
            if np.array_equal(new, label):
                break
            label = new
        root[links > 0] = label[links > 0]
    return links, root


def _runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, pa.Table]]:
    """Rows that are sorted by ``keys``, a table for each run of equal ones."""
    held, key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(c).to_numpy() for c in keys])
        cuts = [0, *(np.flatnonzero((values[:, 1:] != values[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            now = tuple(values[:, a].tolist())
            if now != key and held:
                yield key, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            key = now
    if held:
        yield key, pa.Table.from_batches(held)


def _signatures(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint8).reshape(-1, HASHES)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (comp, i, j); one run of equal keys is a pair of blocks."""
    needed = needed_matches()
    names = ["rid", "links", "root", "whole"]
    out: list[list[np.ndarray]] = []

    def ready() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[c] for o in out])) for c in range(4)], names=names)
        out.clear()
        return batch

    for key, t in _runs(batches, ("comp", "i", "j")):
        rid = t["rid"].to_numpy()
        order = np.argsort(rid)
        rid = rid[order]
        sets = [np.frombuffer(s, np.uint64) for s in t["shingles"].to_pylist()]
        sets = [sets[o] for o in order.tolist()]
        side = (t["block"].to_numpy()[order] != key[1]).astype(np.int8)
        links, root = block_links(_signatures(t)[order], sets, t["mult"].to_numpy()[order], side, key[1] == key[2], needed)
        at = np.flatnonzero(links)
        out.append([rid[at], links[at], rid[root[at]], np.full(len(at), t["blocks"][0].as_py() == 1)])
        if sum(len(o[0]) for o in out) > 20_000:
            yield ready()
    if out:
        yield ready()


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) with both ends' values and sizes: those that survive the pruning."""
    needed = needed_matches()
    for batch in batches:
        for low in range(0, batch.num_rows, 20_000):
            part = batch.slice(low, 20_000)
            x, y = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint8).reshape(-1, HASHES) for c in ("sig", "hub_sig"))
            n, m = part.column("n").to_numpy(), part.column("hub_n").to_numpy()
            keep = 5 * np.minimum(n, m).astype(np.int64) >= 4 * np.maximum(n, m).astype(np.int64)
            total = np.zeros(len(x), np.int64)
            for c in range(0, HASHES, STEP):
                at = np.flatnonzero(keep)
                total[at] += (x[at, c : c + STEP] == y[at, c : c + STEP]).sum(1)
                keep &= total >= needed[c + STEP]
            yield pa.RecordBatch.from_arrays([part.column(c).take(pa.array(np.flatnonzero(keep))) for c in ("u", "v")], names=["u", "v"])


def _bridges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (band, i, j); of each run, a forest of the surviving pairs between different parts."""
    needed = needed_matches()
    for key, t in _runs(batches, ("band", "i", "j")):
        sig, rid, n, part = _signatures(t), t["rid"].to_numpy(), t["n"].to_numpy(), t["part"].to_numpy()
        side = t["block"].to_numpy() != key[1]
        same = key[1] == key[2]
        x, y = (np.arange(len(rid)),) * 2 if same else (np.flatnonzero(~side), np.flatnonzero(side))
        i, j = surviving_pairs(sig[x], sig[y], n[x], n[y], same, needed, part[x][:, None] != part[y][None, :])
        # one edge for each pair of parts is enough
        _, first = np.unique(np.stack([part[x[i]], part[y[j]]]), axis=1, return_index=True)
        yield pa.RecordBatch.from_arrays([pa.array(rid[x[i[first]]]), pa.array(rid[y[j[first]]])], names=["u", "v"])


def refined(sets: DataFrame, large: DataFrame) -> DataFrame:
    """(u, root) of the sets in ``large(u, comp)``, connected by surviving pairs only; sets without one are left out.

    ``sets(rid, n, bands, sig)`` has the values. ``large`` holds whole components: whoever shares a band with one of its sets is in it, so its own bands tell which are shared."""
    known = written(sets.join(large.select(F.col("u").alias("rid")), "rid", "left_semi").select("rid", "n", "sig", "bands"), "large-sets")
    bands, about = known.select("rid", F.explode("bands").alias("band")), known.select("rid", "n", "sig")
    hubs = written(bands.groupBy("band").agg(F.min("rid").alias("v"), F.max("rid").alias("last")).where("v < last").select("band", "v"), "hubs")
    mine = written(bands.join(hubs, "band"), "large-bands")
    beside = F.broadcast if large.count() <= BROADCAST_SETS else lambda df: df
    first = mine.where("rid <> v").select(F.col("rid").alias("u"), "v").distinct()
    hub = about.select(F.col("rid").alias("v"), F.col("n").alias("hub_n"), F.col("sig").alias("hub_sig"))
    near = written(first.join(beside(about.withColumnRenamed("rid", "u")), "u").join(beside(hub), "v").mapInArrow(_near, "u long, v long"), "hub-edges")
    parts = components(near)
    parted = mine.join(parts.select(F.col("u").alias("rid"), "root"), "rid", "left").select("rid", "band", F.coalesce("root", "rid").alias("part"))
    parted = written(parted, "parted")
    open_ = written(parted.groupBy("band").agg(F.count("*").alias("size"), F.min("part").alias("a"), F.max("part").alias("b")).where("a < b").select("band", "size"), "open-bands")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = parted.join(open_, "band").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = rows.select("band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rid", "part").join(beside(about), "rid")
    more = spread.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j").mapInArrow(_bridges, "u long, v long")
    return components(near.unionByName(more))


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: (doc_id, content_id, rid, root, class_id, n_links).

    root identifies the class within the run and class_id is the smallest id in it; a class is a component of the link graph. n_links is the number of other
    documents with a similarity of 0.8 or more, copies included. rid numbers the rows of one run.
    """
    bounded_batches(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("cid"), F.col(text_col).cast("string").alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    rows = written(base.mapInArrow(_sketch, f"rid long, doc_id {kind}, cid long, set_a long, set_b long, n int, bands array<long>, sig binary"), "sketches")
    first = F.min(F.struct("rid", "cid", "n", "bands", "sig")).alias("f")
    sets = written(
        rows.where("n > 0").groupBy("set_a", "set_b").agg(F.count("*").alias("mult"), F.min("doc_id").alias("least"), first).select("set_a", "set_b", "mult", "least", "f.*"),
        "sets",
    )
    keyed = sets.select("rid", F.explode("bands").alias("band"))
    crowded = keyed.groupBy("band").agg(F.min("rid").alias("hub"), F.max("rid").alias("last")).where("hub < last").select("band", "hub")
    found = components(keyed.join(crowded, "band").where("rid <> hub").select(F.col("rid").alias("u"), F.col("hub").alias("v"))).withColumnRenamed("root", "comp")
    sizes = written(found.groupBy("comp").agg(F.count("*").alias("members")), "component-sizes")
    if sizes.where(F.col("members") > BLOCK).count():
        large = written(found.join(sizes.where(F.col("members") > BLOCK), "comp").select("u", "comp"), "large-components")
        split = refined(sets, large).withColumnRenamed("root", "comp")
        found = written(found.join(sizes.where(F.col("members") <= BLOCK), "comp").select("u", "comp").unionByName(split.select("u", "comp")), "refined")
        sizes = written(found.groupBy("comp").agg(F.count("*").alias("members")), "component-sizes")
    members = written(found.join(sizes, "comp").join(sets.select(F.col("rid").alias("u"), "cid", "set_a", "mult", "sig"), "u").withColumnRenamed("u", "rid"), "members")

    wanted = members.select("cid", "rid")
    if members.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    texts = base.select("cid", "text").join(wanted, "cid").groupBy("rid", F.hash("text").alias("h")).agg(F.first("text").alias("text"))
    full = texts.join(members.drop("cid"), "rid").select("rid", "comp", "members", "mult", "sig", "set_a", "text").mapInArrow(_sets, "rid long, comp long, members long, mult long, sig binary, shingles binary")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    spread = (
        full.withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("comp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "blocks", "rid", "mult", "sig", "shingles")
    )
    found = written(
        spread.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j").mapInArrow(_compare, "rid long, links long, root long, whole boolean"),
        "links",
    )
    # a component that fits one block is settled there; the others' forests meet here
    split = components(found.where("not whole").select(F.col("rid").alias("u"), F.col("root").alias("v"))).select(F.col("u").alias("rid"), "root")
    root = found.where("whole").select("rid", "root").unionByName(split)
    links = found.groupBy("rid").agg(F.sum("links").alias("links"))
    rooted = sets.select("rid", "set_a", "set_b", "mult", "least").join(root, "rid", "left").join(links, "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    # small tables are written before they meet rows of their key: the join then has a shuffle on either side, which Spark can split at a hot root
    rooted = written(rooted, "rooted")
    named = rooted.join(written(rooted.groupBy("root").agg(F.min("least").alias("class_id")), "class-ids"), "root")
    classes = named.select("set_a", "set_b", "root", "class_id", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"))
    joined = rows.where("n > 0").select("rid", "doc_id", "cid", "set_a", "set_b").join(classes, ["set_a", "set_b"])
    alone = rows.where("n = 0").select("rid", "doc_id", "cid", F.col("rid").alias("root"), F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return joined.select(*alone.columns).unionByName(alone).withColumnRenamed("cid", "content_id")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each class: the one with the smallest id (null last; of repeated rows one). All columns stay."""
    found = written(jaccard_classes(docs, id_col, text_col), "classes")
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).getField("rid").alias("kept")
    groups = written(found.groupBy("root").agg(best, F.count("*").alias("rows")).where("rows > 1").select("root", "kept"), "groups")
    keys = found.join(groups, "root").groupBy(F.col("doc_id").alias("__id"), F.col("content_id").alias("__content"))
    # rows with equal id and text are one key: it goes if none of its rows is kept, and stays once if one of several is
    gone = written(keys.agg(F.max((F.col("rid") == F.col("kept")).cast("int")).alias("kept"), F.count("*").alias("rows")).where("kept = 0 or rows > 1"), "gone")
    side = gone.select("__id", "__content")
    side = F.broadcast(side) if gone.count() <= BROADCAST_ROWS else side
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(text_col)) == F.col("__content"))
    left = docs.join(side, same, "left_anti")
    if gone.where("kept = 1").isEmpty():
        return left
    once = docs.join(gone.where("kept = 1").select("__id", "__content"), same).dropDuplicates(["__id", "__content"])
    return left.unionByName(once.select(*docs.columns))
