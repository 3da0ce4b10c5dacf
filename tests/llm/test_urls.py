import math
import random
from collections import Counter, defaultdict

from tallyforge.llm import url_markov as um

RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]


def host_path(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    path = rest[cut:]
    end = min((i for i in (path.find(c) for c in "?#") if i >= 0), default=len(path))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), path[:end]


def rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


class Model:
    def __init__(self, urls):
        self.n, self.kinds = Counter(), defaultdict(set)
        for u in urls:
            s = "\x01" * um.ORDER + u.lower() + "\x02"
            for i in range(um.ORDER, len(s)):
                for k in range(um.ORDER + 1):
                    self.n[s[i - k : i], s[i]] += 1
                    self.kinds[s[i - k : i]].add(s[i])
        self.total = Counter()
        for (c, _), n in self.n.items():
            self.total[c] += n

    def p(self, context, x):
        shorter = um.FLOOR if context == "" else self.p(context[1:], x)
        t = len(self.kinds.get(context, ()))
        return (self.n[context, x] + t * shorter) / (self.total[context] + t) if t else shorter


def test_scores_by_brute_force(spark):
    rng = random.Random(2)
    good = [f"http://news{rng.randrange(9)}.example.com/en/7{rng.randrange(1000)}" for _ in range(30)]
    bad = [f"http://casino{rng.randrange(9)}.shop.com/en/{rng.randrange(1000)}" for _ in range(30)]
    df = spark.createDataFrame([(u, "accept") for u in good] + [(u, "reject") for u in bad], "url string, label string").distinct()
    fitted = um.model(df)
    tests = ["http://news3.example.org/fr/71", "http://casino5.free.org/x", "ñ", "HTTP://NEWS"]
    got = {r["url"]: r["score"] for r in um.scored(spark.createDataFrame([(t,) for t in tests], "url string"), fitted).collect()}
    a, b = Model({*good}), Model({*bad})
    for t in tests:
        s = "\x01" * um.ORDER + t.lower() + "\x02"
        diffs = [math.log(a.p(s[i - um.ORDER : i], s[i])) - math.log(b.p(s[i - um.ORDER : i], s[i])) for i in range(um.ORDER, len(s))]
        assert abs(got[t] - sum(diffs) / len(diffs)) < 1e-6
    assert got[tests[0]] > 0 > got[tests[1]]


def test_threshold(spark):
    df = spark.createDataFrame([("reject", -2.0), ("reject", -1.0), ("accept", 1.0), ("accept", 2.0)], "label string, score double")
    assert um.threshold(df) == 0.0
    assert um.threshold(df.where("score < 0")) == 0.0


def test_judged(spark):
    rng = random.Random(4)
    urls = [f"https://{rng.choice(['a', 'b.c', 'free-bets'])}.example.{rng.choice(['com', 'net', 'org'])}/{rng.choice(['en', 'de', 'es', 'fr'])}/{rng.randrange(1000)}{rng.choice(['', '#x', '?y=/en/'])}" for _ in range(300)]
    urls += [None, "", "no scheme", "x://HOST.Example.COM/en/7", "a://b://c/d", "http://com/en/", "http://xcom/en/", "http://h?x/en/", "http://" + "long" * 5000 + ".net/de/", urls[0]]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'x' AS host", "1 AS g", "2 AS score")
    rows = um.judged(df).collect()
    assert len(rows) == len(urls)
    for r in rows:
        host, path = host_path(urls[r["page_id"]])
        name, verdict = rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, name)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
    assert {r["verdict"] for r in rows if r["page_id"] in (300, 301)} == {"allow"}
    assert um.judged(df.limit(0)).count() == 0
    assert {r["verdict"] for r in um.judged(df.where("page_id in (300, 302)")).collect()} == {"allow"}  # nothing to learn from


def mean_log_ratio(accept, reject, url):
    s = "\x01" * um.ORDER + url.lower() + "\x02"
    return sum(math.log(accept.p(s[i - um.ORDER : i], s[i]) / reject.p(s[i - um.ORDER : i], s[i])) for i in range(um.ORDER, len(s))) / (len(s) - um.ORDER)


def best_cut(scores):
    """Over all cuts between neighbours; 0 unless one beats chance."""
    total, seen, best = Counter(k for k, _ in scores), Counter(), (0, 0, 0, 0.0)
    at = sorted({s for _, s in scores})
    by_score = defaultdict(Counter)
    for k, s in scores:
        by_score[s][k] += 1
    for s, following in zip(at, at[1:] + [at[-1]]):
        seen += by_score[s]
        gain = seen["reject"] / total["reject"] - seen["accept"] / total["accept"]
        best = max(best, (gain, -abs(s), s, (s + following) / 2)) if gain > 0 else best
    return best[-1]


def test_learns_from_all_labelled_urls(spark, monkeypatch):
    rng = random.Random(6)
    word = lambda kinds: "".join(rng.choice(kinds) for _ in range(4))
    urls = {f"a://{word('abcd')}.net/de/{rng.randrange(99)}" for _ in range(4600)} | {f"a://{word('cdef')}.org/es/{rng.randrange(99)}" for _ in range(4600)}
    urls |= {"a://net/de/" + "zq" * 300, "a://org/es/" + "yx" * 300} | {f"a://{word(kinds)}.fr/{rng.randrange(99)}" for kinds in ("abcd", "bcde", "cdef", "qz", "xy") for _ in range(60)}
    urls = sorted(urls)
    label = {u: {"allow": "accept", "block": "reject"}.get(rule(*host_path(u))[1]) for u in urls}
    assert min(Counter(label.values()).values()) > 250 and min(sum(v == k for v in label.values()) for k in ("accept", "reject")) > 4000
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    fold = {r["url"]: r["f"] for r in df.selectExpr("url", "pmod(xxhash64('held', url), 4) AS f").collect()}
    whole = [Model([u for u in urls if label[u] == k]) for k in ("accept", "reject")]
    without = [[Model([u for u in urls if label[u] == k and fold[u] != f]) for k in ("accept", "reject")] for f in range(4)]
    cut = best_cut([(label[u], round(mean_log_ratio(*without[fold[u]], u), 9)) for u in urls if label[u]])
    for broadcast in (um.BROADCAST_ROWS, 0):
        monkeypatch.setattr(um, "BROADCAST_ROWS", broadcast)
        rows = um.judged(df).collect()
        own = [r for r in rows if r["rule"] is None]
        assert len(rows) == len(urls) and {r["verdict"] for r in own} == {"allow", "block"}
        for r in own:
            expected = mean_log_ratio(*whole, urls[r["page_id"]])
            assert abs(r["score"] - expected) < 1e-6
            assert r["verdict"] == ("allow" if expected >= cut else "block") or abs(expected - cut) < 1e-6


def test_threshold_over_ranges(spark):
    rng = random.Random(8)
    scores = [(k, round(rng.gauss(mean, 1), 2)) for k, mean in (("accept", 0.7), ("reject", -0.9)) for _ in range(3000)]
    assert abs(um.threshold(spark.createDataFrame(scores, "label string, score double").repartition(7)) - best_cut(scores)) < 1e-9
    assert um.threshold(spark.createDataFrame([("accept", -1.0), ("reject", 1.0)], "label string, score double")) == 0.0
