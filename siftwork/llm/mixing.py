"""Mixing sources to target weights: Efraimidis-Spirakis sampling up to a budget of words for each source.

Only DataFrame functions. A source's share of all words follows its weight, but not past ``REPEATS`` times its own words; what
is over goes to the others by weight. Whole epochs of a source come first. What is left of its budget goes to its documents
in the order of exponential keys, -ln(u) / quality, so good documents tend to come first; u is a hash of seed, id and text.

The order is found in two steps, so that no source meets in one task. Sizes are summed in bins of the key's logarithm, in which
the exponential law puts no more than a fixed share of rows whatever the qualities are, and prefix sums over the bins of a source
name the one bin where its budget ends. Only the rows of these bins are sorted. All other rows are told taken or left by their key,
so documents are never shuffled: they meet one row of their source.

The document where the budget ends gives its first words only, so each source's words are its target, rounded. Rows that share
that key (equal in id and text) are the same record and share what is left evenly, rounded down. A null text has no words and
is never taken; null sources are one source, the last; a null id is a key like any other. Columns of other names pass through
``mix``; those named like a result are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import only, staged, whole, with_columns
from .ranks import numbered

SEED = 20250117
#: Weights of the sources in their order, repeating.
WEIGHTS = (1, 2, 3)
#: No source gives more than so many times its words.
REPEATS = 3
#: Rows of a bin that is sorted, about.
BIN_ROWS = 50_000
#: The largest share of rows for each unit of the key's natural logarithm, whatever their qualities: 1 / e.
DENSEST = 0.3679
LEAST_QUALITY = 0.05
SOLID = r"[^\x20\x09-\x0D]+"


def word_count(text: str | Column = "text") -> Column:
    return F.regexp_count(whole(text), F.lit(SOLID)).cast("long")


def quality_of(text: str | Column = "text") -> Column:
    """Between LEAST_QUALITY and 1: the share of letters among what is not blank, times the share of lines that are no repeats."""
    t = whole(text)
    solid = F.length(F.regexp_replace(t, r"[\x20\x09-\x0D]+", ""))
    letters = F.length(F.regexp_replace(t, r"[^\p{L}\p{M}]+", ""))
    lines = F.split(t, "\n", -1)
    return F.greatest(F.lit(LEAST_QUALITY), letters / F.greatest(solid, F.lit(1)) * F.size(F.array_distinct(lines)) / F.size(lines))


def exponential_key(quality: Column, seed: int, *of: Column) -> Column:
    """-ln(u) / quality, with u in (0, 1) from 53 bits of a hash; the smaller, the earlier."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *of), 11).cast("double")
    return -F.log((bits + 0.5) / float(1 << 53)) / quality


def measured(docs: DataFrame, quality: Callable[[str], Column] = quality_of, seed: int = SEED, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The rows as one struct, so that no name can clash, beside their source, size and key."""
    col = lambda c: F.col(f"`{c}`")
    return docs.select(
        F.struct(*[col(c) for c in docs.columns]).alias("doc"), col(source).cast("string").alias("source"), word_count(col(text)).alias("size"),
        exponential_key(quality(col(text)), seed, col(doc_id).cast("string"), whole(col(text))).alias("key"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``sources`` (source, source_size) with weight and target.

    The level that gives each source level * weight, or its cap where that is less, rises until all words are shared out. Every
    round is one small aggregate, and a source that was capped stays so.
    """
    placed = numbered(sources, "place", F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    placed = staged(placed.withColumn("weight", weight), "sources")
    cap = repeats * F.col("source_size")
    total, parts = placed.agg(F.sum("source_size"), F.sum("weight")).first()
    level, capped = (total / parts if parts else 0.0), -1
    while parts:
        over = F.lit(level) * F.col("weight") >= cap
        n, held, free = placed.agg(F.count(F.when(over, 1)), F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("weight")))).first()
        if n == capped or not free:
            break
        level, capped = (total - (held or 0)) / free, n
    return placed.withColumn("target", F.least(F.lit(level) * F.col("weight"), cap.cast("double"))).drop("place")


def budgets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, bin_rows: int = BIN_ROWS) -> DataFrame:
    """One row for each source: source_size, weight, target, epochs, and the key where the rest of its budget ends (null: no rest).

    ``rows`` has source, size and key; it is read three times and should be written somewhere. cut_left words are left for the cut_n
    rows with that key.
    """
    sources = staged(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("__rows")), "source-sizes")
    plan = targets(sources, weights, repeats)
    n = sources.agg(F.max("__rows")).first()[0] or 0
    budget = F.round("target").cast("long")
    whole_epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    plan = staged(plan.withColumn("epochs", whole_epochs).withColumn("rest", budget - F.col("epochs") * F.col("source_size")).drop("__rows"), "budgets")

    width = bin_rows / (DENSEST * max(n, 1))
    binned = rows.withColumn("bin", F.floor(F.log("key") / F.lit(min(width, 64.0))))
    before = lambda order: F.coalesce(F.sum("s").over(Window.partitionBy("source").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    of_source = lambda side: F.col("source").eqNullSafe(F.col(side))
    bins = binned.groupBy("source", "bin").agg(F.sum("size").alias("s")).withColumn("before", before("bin"))
    rests = plan.filter("rest > 0").select(F.col("source").alias("__source"), "rest")
    last = bins.join(rests, of_source("__source")).filter((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("s")))
    last = staged(last.select("__source", F.col("bin").alias("__bin"), (F.col("rest") - F.col("before")).alias("left")), "last-bins")
    inside = binned.join(last, of_source("__source") & (F.col("bin") == F.col("__bin")))
    keys = inside.groupBy("source", "key").agg(F.sum("size").alias("s"), F.count("*").alias("n"), F.max("left").alias("left")).withColumn("before", before("key"))
    cut = keys.filter((F.col("before") <= F.col("left")) & (F.col("left") < F.col("before") + F.col("s")))
    cut = cut.select(F.col("source").alias("__source"), F.col("key").alias("cut_key"), (F.col("left") - F.col("before")).alias("cut_left"), F.col("n").alias("cut_n"))
    return staged(plan.join(cut, of_source("__source"), "left").drop("__source", "rest"), "cuts")


def taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with source_size, target, copies (whole ones) and tail (words of one more, cut copy)."""
    plan = plan.select(F.col("source").alias("__source"), "source_size", "target", "epochs", "cut_key", "cut_left", "cut_n")
    met = rows.join(plan, F.col("source").eqNullSafe(F.col("__source")))
    at_cut = F.least(F.col("size"), F.floor(F.col("cut_left") / F.col("cut_n")))
    more = F.when(F.col("cut_key").isNull(), 0).when(F.col("key") < F.col("cut_key"), F.col("size")).when(F.col("key") == F.col("cut_key"), at_cut).otherwise(0).cast("long")
    filled = F.when(F.col("size") > 0, F.col("epochs") + (more == F.col("size")).cast("long")).otherwise(0)
    met = met.withColumn("copies", filled.cast("long")).withColumn("tail", F.when(more < F.col("size"), more).otherwise(0).cast("long"))
    return met.drop("__source", "epochs", "cut_key", "cut_left", "cut_n")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, quality: Callable[[str], Column] = quality_of, seed: int = SEED, bin_rows: int = BIN_ROWS,
        doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``docs`` with size, source_size, target, taken, copies and tail: what the mix takes of each."""
    rows = measured(docs, quality, seed, doc_id, source, text)
    plan = budgets(staged(rows.drop("doc"), "mix-keys"), weights, repeats, bin_rows)
    out = taken(rows, plan).select("doc", *[F.col(c).alias(f"__{c}") for c in ("size", "source_size", "target", "copies", "tail")])
    named = {c: F.col(f"__{c}") for c in ("size", "source_size", "target", "copies", "tail")}
    # Picked by name, as a struct of a clashing field would be.
    passed = [F.col("doc").getField(c).alias(c) for c in docs.columns if c.lower() not in {*named, "taken"}]
    return out.select(*passed, *[v.alias(k) for k, v in named.items()], (F.col("__copies") * F.col("__size") + F.col("__tail")).alias("taken"))


def expand(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The mix itself: every document once for each copy, and cut to ``tail`` words for the last; column copy counts from 1."""
    n = F.col("copies") + (F.col("tail") > 0).cast("long")
    rows = mixed.filter(n > 0).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), n)))
    head = F.regexp_substr(F.col(f"`{text}`"), F.concat(F.lit(r"(?s)^(?:[\x20\x09-\x0D]*[^\x20\x09-\x0D]++){"), F.col("tail").cast("string"), F.lit("}")))
    return with_columns(rows, **{text: F.when(F.col("copy") > F.col("copies"), head).otherwise(F.col(f"`{text}`"))})


def digest(docs: DataFrame) -> DataFrame:
    """Query form: what the mix takes of every document. Texts are read once."""
    rows = staged(measured(only(docs, ["doc_id", "source", "text"])).select(F.col("doc.doc_id").alias("doc_id"), "source", "size", "key"), "mix-keys")
    out = taken(rows, budgets(rows))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size") + F.col("tail")).alias("taken"), "source", "copies", "tail")
