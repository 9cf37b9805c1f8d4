"""Quality classifier by hierarchical empirical Bayes: what a document's text says, combined with what its site and section are like.

Text evidence is a log-likelihood ratio, summed over binned statistics of the whole text whose rates are counted on all labelled
documents. Every document then has a chance of being good from its text alone (its label, where it has one).
Sections (host and path) are shrunk toward their host, and hosts toward all documents, by beta priors whose strengths come from the
spread between hosts and between sections (moments). A document's own chance is taken out of the rates it is judged by. All
of it is grouped aggregation on one narrow table; rates are joined back by key.

Here the host of a document is its source and the path its language. Null hosts and paths form groups of their own; a null text
is an empty one. Labels without a document, or with a null quality, teach nothing; of several labels of a document the mean
counts. Null ids have no label. Repeated rows are judged alike. Without labels the evidence is zero and every document has
the prior chance of one half. Other columns are left out. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import only, staged
from .quality_rules import measure

#: Chance from which a document is kept; pseudo-counts of a bin; bounds of a prior's strength in documents; sharpest evidence of one statistic.
KEEP, PSEUDO, STRENGTHS, SHARPEST = 0.5, 4.0, (2.0, 500.0), 5.0
BINS = 24


def statistics() -> dict[str, Column]:
    """Bin of each statistic, 0 to BINS - 1."""
    share = lambda a, b, k: F.floor(F.sqrt(F.col(a) / (F.col(b) + 1)) * k)
    raw = {
        "words": F.floor(F.log1p(F.col("n_words").cast("double")) * 2),
        "length": F.floor(F.col("word_chars") / (F.col("n_words") + 1) * 2),
        "symbols": share("n_symbols", "word_chars", 24),
        "lines": share("n_dup_lines", "n_lines", 12),
        "repeats": share("n_repeat_words", "n_words", 12),
        "capitals": share("n_upper", "word_chars", 24),
    }
    return {k: F.least(F.greatest(v, F.lit(0)), F.lit(BINS - 1)).cast("int") for k, v in raw.items()}


def _evidence(rows: DataFrame) -> Column:
    """The summed ratios as an expression; the rates are one row of at most 6 * BINS counts."""
    names = list(statistics())
    long = rows.filter("label is not null").select("label", F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"b_{n}").alias("bin")) for n in names])).alias("e"))
    counts = long.groupBy("e.name", "e.bin").agg(F.sum("label").alias("good"), F.count("*").alias("n")).collect()
    parts = []
    for name in names:
        own = {r["bin"]: (r["good"], r["n"] - r["good"]) for r in counts if r["name"] == name}
        good, bad = sum(g for g, _ in own.values()), sum(b for _, b in own.values())
        if not good or not bad:
            continue
        case = None
        for k, (g, b) in sorted(own.items()):
            # Pseudo-counts are spread like all labelled documents, so rare bins say little.
            share = (g + b) / (good + bad)
            ratio = ((g + PSEUDO * share) / (good + PSEUDO)) / ((b + PSEUDO * share) / (bad + PSEUDO))
            value = max(-SHARPEST, min(SHARPEST, math.log(ratio)))
            test = F.col(f"b_{name}") == k
            case = F.when(test, F.lit(value)) if case is None else case.when(test, F.lit(value))
        parts.append(case.otherwise(F.lit(0.0)))
    return reduce(lambda a, b: a + b, parts) if parts else F.lit(0.0)


def _strength(groups: DataFrame, rate: str, n: str) -> float:
    """Prior documents from the spread of group rates, by moments; one row reaches the driver."""
    seen = groups.filter(F.col(n) >= 2)
    r = seen.agg(F.sum(n).alias("n"), F.sum(F.col(n) * F.col(rate)).alias("s"), F.sum(F.col(n) * F.col(rate) * F.col(rate)).alias("q"), F.sum(F.lit(1) * F.col(rate) * (1 - F.col(rate))).alias("v"), F.count("*").alias("k")).first()
    if not r.k or r.k < 2:
        return STRENGTHS[1]
    mean = r.s / r.n
    between = max(0.0, r.q / r.n - mean * mean - r.v / r.n)  # less what chance alone spreads
    low, high = STRENGTHS
    return high if between <= 0 else min(high, max(low, mean * (1 - mean) / between - 1))


def site_quality(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """Query form: per document its evidence, the shrunk rates of its host and section, the chance of being good and the verdict."""
    named = lambda c: F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-"))
    counted = measure(only(docs, ["doc_id", "text", host, path])).select("doc_id", F.col(f"`{host}`").alias("host"), F.col(f"`{path}`").alias("path"), named(host).alias("h"), named(path).alias("p"), *[v.alias(f"b_{k}") for k, v in statistics().items()])
    taught = labels.filter("quality is not null and doc_id is not null").groupBy(F.col("doc_id").alias("__id")).agg(F.avg(F.col("quality").cast("double")).alias("label"))
    rows = staged(counted.join(taught, F.col("doc_id") == F.col("__id"), "left").drop("__id"), "site-rows")
    known = rows.agg(F.avg("label")).first()[0]
    known = min(0.99, max(0.01, known)) if known is not None else 0.5
    chance = lambda logit: 1 / (1 + F.exp(-logit))
    scored = rows.withColumn("evidence", _evidence(rows)).withColumn("own", F.coalesce("label", chance(F.col("evidence") + math.log(known / (1 - known)))))
    scored = staged(scored.select("doc_id", "host", "path", "h", "p", "evidence", "own"), "site-scores")
    sections = staged(scored.groupBy("h", "p").agg(F.count("*").alias("n"), F.sum("own").alias("s")), "site-sections")
    hosts = sections.groupBy("h").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    of_host = _strength(hosts.withColumn("rate", F.col("hs") / F.col("hn")), "rate", "hn")
    of_section = _strength(sections.withColumn("rate", F.col("s") / F.col("n")), "rate", "n")
    whole = sections.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    prior = (whole.s + 1) / (whole.n + 2) if whole.n else 0.5
    shrunk = lambda s, n, strength, toward: (s + strength * toward) / (n + strength)
    joined = scored.join(sections, ["h", "p"]).join(hosts, "h")
    joined = joined.withColumn("host_rate", shrunk(F.col("hs") - F.col("own"), F.col("hn") - 1, F.lit(of_host), F.lit(prior)))
    joined = joined.withColumn("path_rate", shrunk(F.col("s") - F.col("own"), F.col("n") - 1, F.lit(of_section), F.col("host_rate")))
    score = chance(F.col("evidence") + F.log(F.col("path_rate") / (1 - F.col("path_rate"))))
    return joined.select("doc_id", "host", "path", "evidence", "host_rate", "path_rate", score.alias("score"), (score >= KEEP).alias("kept"))
