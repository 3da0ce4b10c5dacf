import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyforge.llm import pii_crf as pii


def contract(text):
    """The patterns as stated, on the whole text."""
    out = [(m.start(), m.end(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), m.end(), 1) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((m.start(), m.end(), 2))
    out += [(m.start(), m.end(), 3) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return [(a, b, pii.KINDS[k]) for a, b, k in sorted(out, key=lambda s: (s[0], s[2]))]


PIECES = st.sampled_from(["a", "Bob.x", "@", "@@", "x@y.z", ".", "..", "1", "25", "255", "256", "1.2.3.4", "4111111111111111", "4111 1111-1111 1111", " ", "-", "+", "+1 (407) 555-7710", "(", ")", "é", "\n", "000", "5500000000000004"])


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=14))
def test_patterns(pieces):
    text = "".join(pieces)
    assert pii.base_spans(text) == contract(text)


def test_linear_on_long_runs():
    for text in ("a" * 300_000, "1" * 300_000, "@" * 100_000, "1." * 100_000, "+1" + " " * 200_000, "a@" * 100_000):
        pii.nodes(text, pii.base_spans(text))


MODEL = pii.fit(["mail me at bob.x@site.example.org or +1 (407) 555-7710 and then again bob.x@site.example.org", "card 4111111111111111 and 4111111111111111 and 10.0.0.1 again 10.0.0.1", "no 123456789 none", "ref 99887766554433"])


def added(text):
    return pii.added_spans([text], [pii.base_spans(text)], MODEL)[0]


def test_skip_chain_consistency():
    phone = "Call +1 (407) 555-7710 today. Or (407) 555-7710 later."
    assert [k for *_, k in added(phone)] == ["phone"]
    a, b, _ = added(phone)[0]
    assert phone[a:b] == "(407) 555-7710"
    typo = "Card 4111111111111111 was used; again 4111111111111112."
    assert [k for *_, k in added(typo)] == ["card"]
    assert added("Number 5551234567 alone, and card 4111111111111111.") == []  # nothing ties it to the card
    two = "Cards 4111111111111111 5500000000000004 side by side."  # too many digits for one match
    assert pii.base_spans(two) == [] and [two[a:b] for a, b, _ in added(two)] == ["4111111111111111", "5500000000000004"]
    assert added("Just 5551234567 and 5551234567.") == []


def test_message_passing_by_enumeration():
    """On a tree, loopy message passing is exact."""
    import itertools

    rng = np.random.default_rng(0)
    model = pii.Model(rng.normal(size=(pii.FEATURES, 5)), rng.normal(size=(5, 5)), rng.normal(size=(5, 5)))
    model.chain, model.skip = model.chain + model.chain.T, model.skip + model.skip.T
    x, evidence = rng.normal(size=(3, pii.FEATURES)) * 0.3, np.array([-1, -1, -1])
    edges, skip = np.array([[0, 1], [1, 2]]), np.array([True, False])
    unary = np.clip(x @ model.weights, -4, 4)
    total = np.zeros((3, 5))
    for y in itertools.product(range(5), repeat=3):
        p = np.exp(sum(unary[i, y[i]] for i in range(3)) + model.skip[y[0], y[1]] + model.chain[y[1], y[2]])
        for i in range(3):
            total[i, y[i]] += p
    old, pii.ROUNDS = pii.ROUNDS, 60
    got = pii.posteriors(model, x, evidence, edges, skip)
    pii.ROUNDS = old
    assert np.allclose(got, total / total.sum(1, keepdims=True), atol=1e-6)


def test_query_and_masking(spark, odd_docs, no_docs):
    df = spark.createDataFrame([(1, "é bob@x.org, bob@x.org"), (2, "clean text 12"), (3, None), (None, "10.1.2.3")], "doc_id long, text string")
    by = {r["doc_id"]: r for r in pii.found(df).collect()}
    assert (by[1]["n_email"], by[1]["spans"]) == (2, "email:2:11,email:13:22") and by[None]["n_ip"] == 1 and by[3]["spans"] == ""
    masked = {r["doc_id"]: r["text"] for r in pii.masked(df).collect()}
    assert masked == {1: "é [email], [email]", 2: "clean text 12", 3: None, None: "[ip]"}
    assert pii.found(odd_docs).count() == odd_docs.count() and pii.masked(odd_docs).schema == odd_docs.schema
    assert pii.masked(odd_docs).exceptAll(odd_docs).count() == 0
    assert pii.found(no_docs).count() == 0 and pii.masked(no_docs).count() == 0


def test_evidence_reaches_every_repeat():
    for again in ("(407) 555-7710", "407-555-7710", "4075557710"):
        for n in (1, 11, 19, 39, 400):
            assert [k for *_, k in added("Call +1 (407) 555-7710 today." + f" Or {again} later." * n)] == ["phone"] * n, (again, n)
            assert [k for *_, k in added(f"Or {again} later. " * n + "Call +1 (407) 555-7710 today.")] == ["phone"] * n, (again, n)


def test_message_passing_settles_at_any_distance():
    """A path of 60 nodes with evidence at one end, against exact forward sums."""
    model, n = pii.Model(np.zeros((pii.FEATURES, 5)), np.zeros((5, 5)), 8 * np.eye(5)), 60
    got = pii.posteriors(model, np.zeros((n, pii.FEATURES)), np.array([2] + [-1] * (n - 1)), np.array([[i, i + 1] for i in range(n - 1)]), np.ones(n - 1, bool))
    step, p = np.exp(model.skip) / np.exp(model.skip).sum(1, keepdims=True), np.eye(5)[2]
    for i in range(n):
        assert np.allclose(got[i], p, atol=1e-6)
        p = p @ step


def test_long_texts_have_chain_edges():
    """With a chain potential that decides, a passage has the same spans in a text of few and of many nodes."""
    model = pii.Model(np.zeros((pii.FEATURES, 5)), 6 * np.eye(5), MODEL.skip)
    passage = "Call +1 (407) 555-7710 or 4111111111111111 5500000000000004 or +1 (407) 555-7711 now. "
    spans = [pii.added_spans([t], [pii.base_spans(t)], model)[0] for t in (passage + "x@y.org " * n for n in (1, 3000))]
    assert spans[0] and spans[0] == spans[1]


def test_one_digit_neighbours_behind_others():
    """Numbers that share a half of their digits hide no pair that differs in one digit, whichever it is."""
    card = "4111111111111111"
    between = " ".join(f"no {card[:8]}{n} x {n}{card[8:]} y" for n in range(22222222, 22222222 + 40 * 111, 111))
    for i in range(len(card)):
        typo = f"{card[:i]}2{card[i + 1 :]}"
        text = f"Card {card} was used; {between}; again {typo} at last."
        base = pii.base_spans(text)
        ns = pii.nodes(text, base)
        place = {text[n[0] : n[1]]: j for j, n in enumerate(ns)}
        assert (place[card], place[typo]) in pii.skip_edges(ns)
        assert typo in [text[a:b] for a, b, _ in pii.added_spans([text], [base], MODEL)[0]]


def test_copies_count_once_in_the_sample(spark, monkeypatch):
    """The sample is of distinct texts: neither do copies fill it nor do they narrow the first cut."""
    texts = [f"mail me at bob{i}@site.example.org" for i in range(100)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[:5] * 1500)], "doc_id long, text string")
    samples = []
    monkeypatch.setattr(pii, "fit", lambda sample: samples.append(sample) or MODEL)
    pii._model(df, "text")
    assert sorted(samples[0]) == sorted(texts)


def test_loopy_graph_against_enumeration():
    """On a graph with cycles message passing is approximate: close to exact sums where potentials are moderate, and of the same labels."""
    import itertools

    rng = np.random.default_rng(4)
    for _ in range(5):
        model = pii.Model(rng.normal(size=(pii.FEATURES, 5)), 0.3 * np.eye(5), 0.6 * np.eye(5))
        x, evidence = rng.normal(size=(5, pii.FEATURES)) * 0.4, np.array([-1, 2, -1, -1, -1])
        edges, skip = np.array([[0, 1], [1, 2], [2, 3], [3, 4], [0, 3], [1, 4]]), np.array([False, False, False, False, True, True])
        unary, total = np.clip(x @ model.weights, -pii.CLIP, pii.CLIP), np.zeros((5, 5))
        for y in itertools.product(range(5), repeat=5):
            if y[1] == 2:
                p = np.exp(sum(unary[i, y[i]] for i in range(5) if i != 1) + sum((model.skip if s else model.chain)[y[a], y[b]] for (a, b), s in zip(edges.tolist(), skip.tolist(), strict=True)))
                for i in range(5):
                    total[i, y[i]] += p
        exact, got = total / total.sum(1, keepdims=True), pii.posteriors(model, x, evidence, edges, skip)
        assert np.abs(got - exact).max() < 0.05 and (got.argmax(1) == exact.argmax(1)).all()


def test_potentials_are_learned():
    """Same labels attract over skip edges more than PRIOR says, kinds and none repel; without a match the potentials stay."""
    assert MODEL.skip[1, 1] > pii.PRIOR[0] + 1 and MODEL.skip[0, 1] < pii.PRIOR[2] - 1
    none = pii.fit(["no 123456789 none", "ref 99887766554433"])
    assert np.allclose(none.skip[pii._TIED == 0], pii.PRIOR[0], atol=0.05)
    assert pii.fit([]).weights.shape == (pii.FEATURES, 5)


def test_damaged_repeats():
    """Each match stands again in a damaged form that no pattern matches: the skip edges find it. Damaged forms alone, or in other texts, stay clean."""
    rng = np.random.default_rng(9)
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    texts, wanted, alone = [], 0, []
    for i in range(300):
        card = digits(15)
        matches = [f"+4{i % 10} {digits(3)} {digits(7)}", f"user{i}.{digits(3)}@mail{i % 7}.example.org", next(card + c for c in "0123456789" if pii.luhn(card + c))]
        m = matches[i % 3]
        forms = pii.damaged(m)
        form = forms[i // 3 % len(forms)]
        texts.append(f"order {digits(7)} for {m} shipped. Later {form} wrote again about {digits(8)}.")
        alone.append(f"order {digits(7)} shipped. Later {form} wrote again about {digits(8)}.")
        wanted += 1
    bases = [pii.base_spans(t) for t in texts]
    model = pii.fit(texts[:100])
    got = pii.added_spans(texts, bases, model)
    right = sum(len(g) == 1 and g[0][2] == b[0][2] and g[0][0] > b[0][1] for g, b in zip(got, bases, strict=True))
    assert right >= 0.98 * wanted
    assert pii.added_spans(alone, [pii.base_spans(t) for t in alone], model) == [[] for _ in alone]
    assert pii.added_spans([f"{t} {t}" for t in alone], [pii.base_spans(f"{t} {t}") for t in alone], model) == [[] for _ in alone]  # repeats of what is no match


def test_evidence_among_many_matches():
    """A node finds its match behind any number of others that begin before it."""
    text = "+1 2 " * 30 + "1.2.3.4 " * 20 + "and +1 (407) 555-7710 here"
    assert pii.nodes(text, pii.base_spans(text))[-1][2] == 4
