"""URL filters by a character language-model ratio, in DataFrame functions only.

URLs that a rule accepts and URLs that a rule rejects each train a variable-order Markov model: characters after up to ORDER
earlier ones, smoothed by Witten-Bell interpolation with the shorter contexts. A URL's score is the difference of its two log-likelihoods,
divided by its length. It's blocked if the score is below a threshold that is calibrated for the best balanced accuracy on
labelled URLs that the models didn't see.

Everything is learned from all distinct labelled URLs, whole. The models that judge are fitted on all of them. The threshold also comes from all of them: each is scored
for it by models fitted without its fold (FOLDS by hash), whose counts are the whole counts less the fold's. The distinct grams of all URLs are resolved once
against all these models, then joined to the positions.

Edge cases: a null URL, or one without ``://``, has an empty host and path; a null or empty URL has score 0 and is allowed unless a rule says
otherwise; if a class has no example every URL without a rule is allowed; repeated rows are each judged, null ids are kept; empty tables give an empty
result. Other columns are never read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.storage import written

#: (verdict, host, start of the path), as the contract states them.
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
ORDER = 4
#: Parts of the labelled URLs; each is held out once.
FOLDS = 4
#: Probability of any character before anything was seen.
FLOOR = 1 / 256
#: URLs that a task takes apart; their grams are some fifty times as many rows.
TASK_URLS = 8192
#: Most distinct grams (about 155 bytes each) that are broadcast to the positions, the commonest first; the positions of all others are shuffled to theirs.
BROADCAST_ROWS = 300_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, pattern, 1), _UPPER, _LOWER), F.regexp_extract(url, pattern, 2)


def ruled(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none fits."""
    longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = lambda r: ((host == r[1]) | host.endswith("." + r[1])) & path.startswith(r[2])
    pick = lambda at: reduce(lambda c, r: c.when(fits(r), F.lit(at(r))), longest, F.when(F.lit(False), F.lit("")))
    return pick(lambda r: r[1] + r[2]), pick(lambda r: r[0])


def _grams(url: Column) -> Column:
    """The ORDER + 1 characters that end at each position of a URL and at its end."""
    chars = F.split(F.concat(F.lit("\x01" * ORDER), F.translate(url, _UPPER, _LOWER), F.lit("\x02")), "")
    return F.transform(F.sequence(F.lit(1), F.length(url) + 1), lambda i: F.array_join(F.slice(chars, i, ORDER + 1), ""))


def _suffixes(g: str) -> Column:
    return F.transform(F.sequence(F.lit(1), F.lit(ORDER + 1)), lambda n: F.substring(F.col(g), ORDER + 2 - n, n))


def fold(url: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("held"), url), F.lit(FOLDS)).cast("int")


def _dealt(urls: DataFrame) -> DataFrame:
    """Dealt by a stated number: URLs are few bytes and many grams, so sizes before the explode mislead adaptive execution."""
    return urls.repartition(max(1, -(-urls.count() // TASK_URLS)), "url")


def model(labelled: DataFrame) -> DataFrame:
    """All of distinct ``labelled(url, label)``, with label accept or reject, to (label, fold, g, n): how often each gram of 1 to ORDER + 1 characters occurs."""
    whole = _dealt(labelled.select("url", "label")).select("label", fold(F.col("url")).alias("fold"), F.explode(_grams(F.col("url"))).alias("g"))
    counts = whole.groupBy("label", "fold", "g").agg(F.count("*").alias("n")).select("label", "fold", "n", F.explode(_suffixes("g")).alias("g"))
    return written(counts.groupBy("label", "fold", "g").agg(F.sum("n").alias("n")), "url-counts")


def gram_scores(grams: DataFrame, fitted: DataFrame) -> DataFrame:
    """Distinct ``grams(g)`` to (g, s0, s1, ...): the difference of the two log probabilities of its last character, by the models without each fold and, last, by those of all.

    Grams to score join the counts with none of their own, so every join is on a gram's suffix or context: no key has more rows than there are characters.
    """
    models = [(k, f) for k in ("accept", "reject") for f in range(FOLDS + 1)]
    asked = grams.select(F.lit(None).cast("string").alias("label"), F.lit(None).cast("int").alias("fold"), F.explode(_suffixes("g")).alias("g"), F.lit(0).cast("long").alias("n")).distinct()
    kept = lambda k, f: F.coalesce(F.sum(F.when((F.col("label") == k) & (F.col("fold") != f), F.col("n"))), F.lit(0))
    counts = fitted.select("label", "fold", "g", "n").unionByName(asked).groupBy("g").agg(*(kept(k, f).alias(f"{k}_n{f}") for k, f in models)).withColumn("c", F.expr("left(g, length(g) - 1)"))
    context = Window.partitionBy("c")
    sums = [c for k, f in models for n in [F.col(f"{k}_n{f}")] for c in (n, F.sum(n).over(context).alias(f"{k}_total{f}"), F.sum((n > 0).cast("int")).over(context).alias(f"{k}_types{f}"))]
    counts = written(counts.select("g", *sums), "url-contexts")

    def smoothed(k: str, f: int, shorter: Column) -> Column:
        n, total, types = (F.col(f"{k}_{v}{f}") for v in ("n", "total", "types"))
        return F.when(types > 0, (n + types * shorter) / (total + types)).otherwise(shorter).alias(f"{k}_p{f}")

    layer = counts.where(F.length("g") == 1).select("g", *(smoothed(k, f, F.lit(FLOOR)) for k, f in models))
    for size in range(2, ORDER + 2):
        shorter = layer.select(F.col("g").alias("suffix"), *(F.col(f"{k}_p{f}").alias(f"{k}_q{f}") for k, f in models))
        longer = counts.where(F.length("g") == size).withColumn("suffix", F.expr("substring(g, 2)"))
        layer = longer.join(shorter, "suffix").select("g", *(smoothed(k, f, F.col(f"{k}_q{f}")) for k, f in models))
    return layer.select("g", *((F.log(f"accept_p{f}") - F.log(f"reject_p{f}")).alias(f"s{f}") for f in range(FOLDS + 1)))


def scored(urls: DataFrame, fitted: DataFrame) -> DataFrame:
    """Distinct non-empty ``urls(url)`` to (url, score, unseen), means over the positions by the models of all labelled URLs and by those without the URL's fold."""
    at = _dealt(urls.select("url")).select("url", fold(F.col("url")).alias("fold"), F.explode(_grams(F.col("url"))).alias("g"))
    seen = written(at.groupBy("g").agg(F.count("*").alias("often")), "url-seen")
    table = written(gram_scores(seen, fitted).join(seen, "g"), "url-grams")
    running = table.groupBy("often").count().select("often", F.sum("count").over(Window.orderBy(F.desc("often"))).alias("upto"))
    least, grams = running.agg(F.min(F.when(F.col("upto") <= BROADCAST_ROWS, F.col("often"))), F.max("upto")).first()
    common = F.lit(False) if least is None else F.col("often") >= least
    unseen = reduce(lambda c, f: c.when(F.col("fold") == f, F.col(f"s{f}")), range(1, FOLDS), F.when(F.col("fold") == 0, F.col("s0")))
    exact = lambda c: F.sum(F.round(c, 9).cast("decimal(20,9)"))
    sums = lambda df: df.groupBy("url").agg(exact(F.col(f"s{FOLDS}")).alias("score"), exact(unseen).alias("unseen"), F.count("*").alias("n"))
    found = sums(at.join(F.broadcast(table.where(common).drop("often")), "g"))
    if grams is not None and (least is None or grams > BROADCAST_ROWS):
        rare = at.join(F.broadcast(table.where(common).select("g")), "g", "left_anti").join(table.where(~common).drop("often"), "g")
        found = found.unionByName(sums(rare)).groupBy("url").agg(*(F.sum(c).alias(c) for c in ("score", "unseen", "n")))
    return found.select("url", *(F.round(F.col(c).cast("double") / F.col("n"), 9).alias(c) for c in ("score", "unseen")))


def threshold(labelled_scores: DataFrame) -> float:
    """The cut of best balanced accuracy over all of ``labelled_scores(label, score)``; 0 if none beats chance or a class has none.

    Running counts are taken within ranges of scores and added to those of the ranges below, so no task meets all rows.
    """
    count = lambda k: F.count(F.when(F.col("label") == k, 1)).alias(k)
    ranges = labelled_scores.groupBy("score").agg(count("accept"), count("reject")).repartitionByRange("score").withColumn("part", F.spark_partition_id())
    ranges = written(ranges, "url-cuts")
    whole, order, upto = Window.partitionBy(), Window.orderBy("part"), Window.partitionBy("part").orderBy("score")
    below = order.rowsBetween(Window.unboundedPreceding, -1)
    parts = ranges.groupBy("part").agg(F.sum("accept").alias("a"), F.sum("reject").alias("r"), F.min("score").alias("low"))
    parts = parts.select("part", F.lead("low").over(order).alias("low"), *(c for k in "ar" for c in (F.coalesce(F.sum(k).over(below), F.lit(0)).alias(f"{k}_below"), F.sum(k).over(whole).alias(f"{k}_whole"))))
    share = lambda k, name: (F.col(f"{k}_below") + F.sum(name).over(upto)) / F.nullif(F.col(f"{k}_whole"), F.lit(0))
    cuts = ranges.join(parts, "part").select("score", F.coalesce(F.lead("score").over(upto), "low").alias("next"), (share("r", "reject") - share("a", "accept")).alias("gain")).where("gain > 0")
    best = cuts.agg(F.max_by(F.coalesce((F.col("score") + F.col("next")) / 2, F.col("score")), F.struct("gain", -F.abs("score"), "score")).alias("cut")).first()["cut"]
    return 0.0 if best is None else float(best)


def judged(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row."""
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    host, path = host_and_path(F.col("url"))
    base = base.withColumns({"host": host, "path": path})
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    base = base.withColumns({"rule": rule, "by_rule": verdict})
    urls = written(base.where("url is not null and url <> ''").select("url").distinct(), "urls")
    by_rule = ruled(*host_and_path(F.col("url")), rules)[1]
    label = F.when(by_rule == "allow", "accept").when(by_rule == "block", "reject")
    labelled = urls.select("url", label.alias("label")).where("label is not null")
    enough = {r["label"] for r in labelled.select("label").distinct().collect()} == {"accept", "reject"}
    if enough:
        scores = written(scored(urls, model(labelled)), "url-scores")
        cut = threshold(scores.select(label.alias("label"), F.col("unseen").alias("score")).where("label is not null"))
    else:
        scores, cut = urls.withColumn("score", F.lit(0.0)), 0.0
    score = F.coalesce("score", F.lit(0.0))
    own = F.when(F.col("url").isNull() | (F.col("url") == "") | F.lit(not enough) | (score >= cut), "allow").otherwise("block")
    return base.join(scores.select("url", "score"), "url", "left").select("page_id", "host", "path", "rule", F.coalesce("by_rule", own).alias("verdict"), score.alias("score"))
