"""Personal data in whole texts: exact patterns, extended by a skip-chain conditional random field.

Nodes are the stretches of a text that could be personal data: tokens with an @ and runs of digits with their separators.
Pattern matches are evidence: they clamp their node to their kind. Neighbouring nodes share a
chain potential, in a text of any number of nodes. Nodes at any distance with a repeated or similar key (the same last digits, the same digits but for one,
the same local part) share a skip potential with a match of that key, or with each other where there is none, which makes an entity's label consistent across the document. Loopy
sum-product message passing gives every free node its posterior.

One rule holds in every text: a free node becomes a span if it has a skip edge or a valid checksum and its most likely label is a kind with a posterior of at
least MIN_POSTERIOR. Pattern matches always stay.

Node weights and both potentials are fitted together, by pseudo-likelihood on a bounded sample: SAMPLE distinct texts with nodes and of at most SAMPLE_CHARS
characters, of the POOL rows (about) whose texts have the least hashes. Pattern matches are distant labels. As patterns never label what they miss, each match also gives
damaged forms that no pattern matches (a lost +, a wrong digit, a cut domain): with a skip edge to the match they keep its kind, alone they are none.
Potentials are tied over kinds (same kind, both none, one none, two kinds), so a kind that the sample lacks has them too; without any match they stay at PRIOR.

Edge cases: null texts count as empty; an empty text or one without nodes has no spans; a text of any length is read whole,
in time linear in its length; repeated rows and null ids are kept as they are. Other columns are never read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.storage import bounded_batches

KINDS = ("email", "ip", "card", "phone")
#: Distinct texts that the model is fitted on, the most characters of one, and the rows (of least hash) that are searched for them.
SAMPLE, SAMPLE_CHARS, POOL = 2000, 20_000, 60_000
#: Log potentials of a skip edge before anything is learned (same kind, both none, one none, two kinds); those of a chain edge are 0, and held there more firmly.
PRIOR = (1.0, 1.0, -1.0, -1.0)
RIDGE = (0.003, 0.0001)
MIN_POSTERIOR = 0.9
#: Messages are passed on until none of them changes by more than TOLERANCE. One that has been passed on ROUNDS times is damped twice as much from then
#: on (and again after as many), so that passing ends on graphs where it would swing; on trees it settles before, at any distance.
TOLERANCE, ROUNDS = 1e-8, 200
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOOSE_DOMAIN = re.compile(r"[A-Za-z0-9.-]*")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_RUN = re.compile(r"[+(]*[0-9][\x20().0-9-]*")
_TOKEN = re.compile(r"[^\x20]+")
_ACTIVE = re.compile(r"[0-9@]")
_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _at_signs(text: str) -> Iterator[tuple[int, int, re.Match | None]]:
    """Each @ with a local part: start of it, position of the @ and the domain, leftmost first and without overlap."""
    floor, at = 0, text.find("@")
    while at >= 0:
        left = text[floor:at]
        start = floor + len(left.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if start < at:
            yield start, at, domain
        floor = domain.end() if domain else at + 1
        at = text.find("@", floor)


def base_spans(text: str) -> list[Span]:
    """The pattern matches of all kinds, by start and then kind."""
    out: list[tuple[int, int, int]] = []
    if _ACTIVE.search(text):
        out += [(start, domain.end(), 0) for start, _, domain in _at_signs(text) if domain]
        for run in _DOTTED.finditer(text):
            if run.group().count(".") >= 3:
                parts, at, i = run.group().split("."), run.start(), 0
                starts = []
                for p in parts:
                    starts.append(at)
                    at += len(p) + 1
                while i + 3 < len(parts):
                    if all(parts[i : i + 4]):
                        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts[i : i + 4]):
                            out.append((starts[i], starts[i + 3] + len(parts[i + 3]), 1))
                        i += 4
                    else:
                        i += 1
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), 2))
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((m.start(), m.end(), 3))
    return [(a, b, KINDS[k]) for a, b, k in sorted(out, key=lambda s: (s[0], s[2]))]


FEATURES, CHECKSUM = 12, 10


def features(s: str) -> list[float]:
    """What a node looks like."""
    if "@" in s:
        return [1.0, 1.0, float("." in s.partition("@")[2]), 0, 0, 0, 0, 0, 0, 0, 0, 0]
    d = _DIGIT.sub("", s)
    card = 12 <= len(d) <= 19
    return [1.0, 0, 0, 1.0, float(s.startswith("+")), float("(" in s), float(s.count(".") == 3), float(" " in s or "-" in s), float(9 <= len(d) <= 15), float(card), float(card and luhn(d)), min(len(d), 40) / 20]


def _keys(s: str) -> list[str]:
    if "@" in s:
        return [f"@{s.partition('@')[0].lower()}", f"e{s.lower()}"]
    d = _DIGIT.sub("", s)
    # all digits but one; numbers that differ in one before the last seven share those
    return [f"d{d}", f"t{d[-7:]}", *(f"w{len(d)}:{i}:{d[:i]}{d[i + 1 :]}" for i in range(len(d) - 7, len(d)) if 8 <= len(d) <= 32)]


def nodes(text: str, base: list[Span]) -> list[tuple[int, int, int, list[str], list[float]]]:
    """(start, end, evidence or -1, keys, features) of each node in order; evidence is 1 + the kind of the first match that it overlaps."""
    found: list[tuple[int, int]] = []
    for start, at, domain in _at_signs(text):
        end = domain.end() if domain else _LOOSE_DOMAIN.match(text, at + 1).end()
        found.append((start, end))
    for m in _RUN.finditer(text):
        # a run of more digits than any kind has is several numbers side by side
        for a, s in [(m.start(), m.group())] if sum(map(str.isdigit, m.group())) <= 19 else [(m.start() + t.start(), t.group()) for t in _TOKEN.finditer(m.group())]:
            s = s.rstrip(" .-(")
            if sum(map(str.isdigit, s)) >= 7:
                found.append((a, a + len(s)))
    found.sort()
    out, last, waiting, b = [], -1, [], 0
    for start, end in found:
        if start < last:
            continue
        last = end
        while b < len(base) and base[b][0] < end:
            waiting.append(base[b])
            b += 1
        waiting = [m for m in waiting if m[1] > start]  # nodes don't overlap: a match that ends before this one ends before all later ones
        s = text[start:end]
        out.append((start, end, 1 + KINDS.index(waiting[0][2]) if waiting else -1, _keys(s), features(s)))
    return out


def skip_edges(ns: list[tuple]) -> list[tuple[int, int]]:
    """Each node with the first match of each kind of the same key, so that repeats neither move away from the evidence nor outvote it.

    Nodes of a key without a match: each with the first of them; of those that another key ties to a match, only the first is tied to them.
    Keys with a digit left out tie numbers that differ in it; equal ones have other keys in common."""
    groups: dict[str, list[int]] = {}
    for i, (_, _, _, keys, _) in enumerate(ns):
        for key in keys:
            groups.setdefault(key, []).append(i)
    out: set[tuple[int, int]] = set()
    tied: set[int] = set()
    free: list[tuple[bool, list[int]]] = []
    for key, group in groups.items():
        if len(group) > 1:
            first: dict[int, int] = {}
            for i in group:
                first.setdefault(ns[i][2], i)
            anchors = [i for kind, i in first.items() if kind > 0]
            if anchors:
                tied.update(group)
            else:
                free.append((key[0] == "w", group))
            out.update((min(a, i), max(a, i)) for a in anchors for i in group if i != a and (key[0] != "w" or ns[i][3][0] != ns[a][3][0]))
    for one_off, group in free:
        rest = [i for i in group if i not in tied]
        if one_off:
            rest = list({ns[i][3][0]: i for i in reversed(rest)}.values())[::-1]
        if rest:
            out.update((min(rest[0], i), max(rest[0], i)) for i in rest[1:] + [i for i in group if i in tied][:1])
    return sorted(out)


class Model:
    """Weights of a node (FEATURES x labels) and log potentials of chain and skip edges (labels x labels)."""

    def __init__(self, weights: np.ndarray, chain: np.ndarray, skip: np.ndarray) -> None:
        self.weights, self.chain, self.skip = weights, chain, skip


LABELS = 1 + len(KINDS)
#: Which of the four tied potentials a pair of labels has.
_TIED = np.where(np.eye(LABELS, dtype=bool), 0, 3)
_TIED[0, :] = _TIED[:, 0] = 2
_TIED[0, 0] = 1


def damaged(s: str) -> list[str]:
    """Forms of a match that the patterns no longer match: without +, with a wrong digit, with a cut domain."""
    if "@" in s:
        forms = [s.rpartition(".")[0], s.partition("@")[0] + "@"]
    else:
        bare = s.lstrip("+")
        at = max(i for i, c in enumerate(bare) if c.isdigit())
        forms = [bare, _DIGIT.sub("", s), f"{bare[:at]}{(int(bare[at]) + 1) % 10}{bare[at + 1 :]}"]
    return [f for f in dict.fromkeys(forms) if not base_spans(f)]


def _examples(sample: list[str]) -> tuple[np.ndarray, ...]:
    """(features, labels of chain neighbours, labels of skip neighbours, label) of each node that has a label; neighbours are counted by label.

    Last come the features of the damaged forms."""
    rows: list[tuple[list[float], np.ndarray, np.ndarray, int]] = []
    twice: list[list[float]] = []
    one = np.eye(LABELS)
    for text in sample:
        base = base_spans(text)
        ns = nodes(text, base)
        label = [max(n[2], 0) for n in ns]
        linked = skip_edges(ns)
        hidden = {i for a, b in linked for i, j in ((a, b), (b, a)) if ns[i][2] < 0 and ns[j][2] > 0}
        near, far = np.zeros((len(ns), LABELS)), np.zeros((len(ns), LABELS))
        for counts, edges in ((near, [(i, i + 1) for i in range(len(ns) - 1)]), (far, linked)):
            for i, j in edges:
                counts[i] += one[label[j]] * (j not in hidden)
                counts[j] += one[label[i]] * (i not in hidden)
        for i, (a, b, kind, _, x) in enumerate(ns):
            if i not in hidden:
                rows.append((x, near[i], far[i], label[i]))
            if kind > 0:
                nobody = 0 * one[0]
                rows.append((x, nobody, nobody, kind))  # a match is one without its neighbours, too
                for form in damaged(text[a:b]):
                    x = features(form)
                    rows += [(x, nobody, one[kind], kind), (x, nobody, one[0], 0), (x, nobody, nobody, 0)]
                    twice.append(x)
    return *(np.array([r[c] for r in rows], float) for c in range(4)), np.array(twice, float).reshape(-1, FEATURES)


def fit(sample: list[str]) -> Model:
    """The weights and potentials of greatest pseudo-likelihood (each label given its neighbours'), drawn a little to 0 and to PRIOR.

    Pseudo-likelihood doesn't see that two free nodes could turn each other into a kind, so the joint likelihood that a damaged form which stands
    twice, without a match, is none both times is added."""
    w, prior = np.zeros((FEATURES, LABELS)), np.array([(0.0,) * 4, PRIOR])
    tied = prior
    x, near, far, label, twice = _examples(sample)
    if len(x):
        y = np.eye(LABELS)[label.astype(int)]
        share = 1 / (np.maximum(y.sum(0), 1) * (y.sum(0) > 0).sum())  # each label weighs as much
        weight = (y @ share)[:, None]
        step = [np.zeros_like(w), np.zeros_like(tied)]
        for _ in range(600):
            own = x @ w
            s = np.clip(own, -CLIP, CLIP) + near @ tied[0][_TIED] + far @ tied[1][_TIED]
            p = np.exp(s - s.max(1, keepdims=True))
            miss = weight * (y - p / p.sum(1, keepdims=True))
            up_w = x.T @ (miss * ((np.abs(own) < CLIP) | (own * miss < 0))) - 1e-4 * w
            up_t = np.array([np.bincount(_TIED.ravel(), (n.T @ miss).ravel(), 4) for n in (near, far)]) - np.array(RIDGE)[:, None] * (tied - prior)
            if len(twice):
                own = twice @ w
                s = np.clip(own, -CLIP, CLIP)
                both = s[:, :, None] + s[:, None, :] + tied[1][_TIED]
                p = np.exp(both - both.max((1, 2), keepdims=True))
                p = -p / p.sum((1, 2), keepdims=True) / len(twice)
                p[:, 0, 0] += 1 / len(twice)
                miss = 2 * p.sum(2)
                up_w += twice.T @ (miss * ((np.abs(own) < CLIP) | (own * miss < 0)))
                up_t[1] += np.bincount(_TIED.ravel(), p.sum(0).ravel(), 4)
            step = [0.9 * old + new for old, new in zip(step, (up_w, up_t), strict=True)]
            w, tied = w + 0.5 * step[0], tied + 0.5 * step[1]
    return Model(w, tied[0][_TIED], tied[1][_TIED])


#: What a node looks like counts for at most so much, as a log.
CLIP = 4.0


def posteriors(model: Model, x: np.ndarray, evidence: np.ndarray, edges: np.ndarray, skip: np.ndarray) -> np.ndarray:
    """Loopy sum-product over one graph, or many at once: nodes x labels. Evidence (>= 0) clamps a node."""
    unary = np.clip(x @ model.weights, -CLIP, CLIP)
    clamped = np.where(evidence[:, None] >= 0, np.where(np.arange(unary.shape[1]) == evidence[:, None], 0.0, -1e9), unary)  # no number of neighbours outweighs a match
    if not len(edges):
        out = np.exp(clamped - clamped.max(1, keepdims=True))
        return out / out.sum(1, keepdims=True)
    source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    both = np.concatenate([skip, skip])
    potential = np.where(both[:, None, None], model.skip, model.chain)
    message = np.zeros((len(source), unary.shape[1]))
    belief = clamped.copy()
    passed, live = np.zeros(len(source), np.int64), np.arange(len(source))
    while len(live):
        outgoing = (belief[source[live]] - message[back[live]])[:, :, None] + potential[live]
        top = outgoing.max(1, keepdims=True)
        new = np.log(np.exp(outgoing - top).sum(1)) + top[:, 0]
        change = (new - new.max(1, keepdims=True) - message[live]) * 0.5 ** (1 + passed[live] // ROUNDS)[:, None]
        message[live] += change
        np.add.at(belief, target[live], change)
        passed[live] += 1
        moved = live[np.abs(change).max(1) > TOLERANCE]
        # what left a node is due again once something new has reached it
        reached, due = np.zeros(len(belief), bool), np.zeros(len(source), bool)
        reached[target[moved]] = True
        due[moved] = True
        live = np.flatnonzero(due | reached[source])
    out = np.exp(belief - belief.max(1, keepdims=True))
    return out / out.sum(1, keepdims=True)


def added_spans(texts: list[str], bases: list[list[Span]], model: Model) -> list[list[Span]]:
    """The spans that message passing adds to each text. A free node needs a skip edge or a valid checksum; its own looks aren't enough."""
    out: list[list[Span]] = [[] for _ in texts]
    x, evidence, edges, skips, place, free = [], [], [], [], [], []
    for t, (text, base) in enumerate(zip(texts, bases, strict=True)):
        ns = nodes(text, base) if _ACTIVE.search(text) else []
        if not any(n[2] < 0 for n in ns):
            continue
        linked = skip_edges(ns)
        held = {i for e in linked for i in e}
        asked = [n[2] < 0 and (i in held or n[4][CHECKSUM] == 1) for i, n in enumerate(ns)]
        if not any(asked):
            continue
        at = len(x)
        x += [n[4] for n in ns]
        evidence += [n[2] for n in ns]
        place += [(t, n[0], n[1]) for n in ns]
        free += asked
        skip = set(linked)
        near = [(i, i + 1) for i in range(len(ns) - 1) if (i, i + 1) not in skip]
        edges += [(at + i, at + j) for i, j in [*linked, *near]]
        skips += [True] * len(linked) + [False] * len(near)
    if x:
        p = posteriors(model, np.array(x), np.array(evidence), np.array(edges, np.int64).reshape(-1, 2), np.array(skips, bool))
        for i in np.flatnonzero(np.array(free) & (p.argmax(1) > 0) & (p.max(1) >= MIN_POSTERIOR)).tolist():
            t, a, b = place[i]
            out[t].append((a, b, KINDS[int(p[i].argmax()) - 1]))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def _model(docs: DataFrame, text_col: str) -> Model:
    """Fitted in one pass that hashes every text and looks for nodes only in the POOL rows (about) of least hash, so that most texts cost a hash."""
    share = min(1.0, POOL / max(1, docs.count()))
    pool = docs.select(F.col(text_col).cast("string").alias("t")).where(F.pmod(F.xxhash64(F.lit("sample"), "t"), F.lit(1 << 30)) < int(share * (1 << 30)))
    few = pool.where((F.length("t") <= SAMPLE_CHARS) & F.col("t").rlike(r"@|[0-9][\x20().0-9-]{5}")).distinct()
    rows = few.orderBy(F.xxhash64("t"), "t").limit(SAMPLE)
    return fit([r["t"] for r in rows.collect()])


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans) of every row; n_spans counts all spans, the added ones too."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(_model(docs, text_col))
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            bases = [base_spans(t) for t in texts]
            spans = [merged(b, a) for b, a in zip(bases, added_spans(texts, bases, shared.value), strict=True)]
            counts = [pa.array([sum(s[2] == k for s in b) for b in bases], pa.int64()) for k in KINDS]
            digest = [hashlib.sha256(joined(b).encode()).hexdigest() for b in bases]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, pa.array(digest), pa.array([joined(s) for s in spans]), pa.array([len(s) for s in spans], pa.int64())], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_spans"])

    kind = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long")


def merged(base: list[Span], added: list[Span]) -> list[Span]:
    return sorted([*base, *added], key=lambda s: (s[0], KINDS.index(s[2]), s[1])) if added else base


def masked(docs: DataFrame, text_col: str = "text", mark: str = "[{}]") -> DataFrame:
    """``docs`` with every span of its texts replaced by its kind; the other columns and rows without spans are as they were."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(_model(docs, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where = batch.schema.get_field_index(text_col)
            texts = batch.column(where).to_pylist()
            bases = [base_spans(t or "") for t in texts]
            for i, added in enumerate(added_spans([t or "" for t in texts], bases, shared.value)):
                out, at = [], 0
                for a, b, kind in merged(bases[i], added):
                    if b > at:  # overlapping spans are one gap
                        out += [texts[i][at:a], mark.format(kind)] if a >= at else []
                        at = b
                if at:
                    texts[i] = "".join(out) + texts[i][at:]
            yield pa.RecordBatch.from_arrays([pa.array(texts, batch.schema.field(where).type) if c == where else batch.column(c) for c in range(batch.num_columns)], names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
