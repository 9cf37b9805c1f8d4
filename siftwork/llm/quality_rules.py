"""Quality rules: statistics of each text, judged by robust distances from what is usual for its language and source.

Only DataFrame functions. The minimum covariance determinant of every group is found by concentration steps that start
from medians and quartiles. One step is one aggregate: moments are summed per group and distance band, and the bands
nearest to the centre that hold ``SHARE`` of the rows give the next centre and covariance. Nothing depends on the order
of rows: coordinates are whole numbers and their sums are decimals.

Nulls: a null text is an empty one (no words, fails the base rules); null languages and sources form groups of their own;
a null doc_id passes through. Repeated rows are judged alike. Columns of other names pass through; a column that has the
name of a statistic is replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, only, staged, whole, with_columns

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]
SOLID = r"[^\x20\x09-\x0D]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Coordinates are multiples of 1 / UNIT.
UNIT = 1024
#: Coordinate and its least spread (beside what those before it explain), in its own units, put in where the fitted one is smaller.
#: Most texts have no symbols or repeats at all, so these are fitted as 0; a chance line or window of a short text must not decide.
COORDINATES = {"z_words": 0.10, "z_length": 0.03, "z_symbols": 0.03, "z_lines": 0.12, "z_repeats": 0.10, "z_upper": 0.03}
DIM = len(COORDINATES)
#: Share of a group's rows that the estimate rests on; the chi-square quantile of that share for DIM degrees of freedom.
SHARE, SHARE_QUANTILE = 0.75, 7.8408
#: A squared distance over this fails: the chi-square quantile of 0.9999 for DIM degrees of freedom.
CUTOFF = 27.856
STEPS = 5
#: So many ordinary words are added to a text's shares and mean length, which a short text otherwise throws about.
SMOOTH = 20
#: Smaller groups use the estimate of their language, and smaller languages that of all rows.
MIN_ROWS = 60
BANDS_PER_OCTAVE = 16
#: Rows of a group meet its estimate in so many places, as one group is all rows.
SALTS = 32


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, although ``use`` names it in a lambda."""
    return F.transform(F.array(value), use)[0]


def _repeated(words: Column, n: Column) -> Column:
    """Words inside windows that occur twice or more."""
    def windows(h: Column) -> Column:
        runs = F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, WINDOW)]))
        return F.slice(runs, F.lit(1), n - (WINDOW - 1))

    def places(sorted_pairs: Column) -> Column:
        twin = lambda x, k: (F.get(sorted_pairs, k - 1)["h"] == x["h"]) | (F.get(sorted_pairs, k + 1)["h"] == x["h"])
        return F.sort_array(F.transform(F.filter(sorted_pairs, lambda x, k: F.coalesce(twin(x, k), F.lit(False))), lambda x: x["i"]))

    def covered(starts: Column) -> Column:
        begin = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total"))
        return F.aggregate(starts, begin, lambda a, p: F.struct(p.alias("last"), (a["total"] + F.least(F.lit(WINDOW), p - a["last"])).alias("total")), lambda a: a["total"])

    def count(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), covered(_let(F.sort_array(pairs), places))).otherwise(0)

    return F.when(n >= WINDOW, _let(_let(F.transform(words, lambda w: F.xxhash64(w)), windows), count)).otherwise(0)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of every whole text."""
    t = whole(text)
    shown = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(SOLID))
    solid, n = F.array_join("__words", ""), F.size("__words")
    long = lambda c: c.cast("long")
    first = docs.withColumn("__words", F.filter(F.split(t, BLANKS, -1), lambda w: w != "")).withColumn("__lines", shown)
    out = with_columns(
        first,
        n_words=long(n),
        word_chars=long(F.length(solid)),
        n_symbols=long(F.regexp_count(t, F.lit("[#*$%&|<>]"))),
        n_dup_lines=long(F.size("__lines") - F.size(F.array_distinct("__lines"))),
        n_repeat_words=long(_repeated(F.col("__words"), n)),
        n_lines=long(F.size("__lines")),
        n_upper=long(F.regexp_count(t, F.lit(r"\p{Lu}"))),
    )
    return out.drop("__words", "__lines")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _coordinates() -> list[Column]:
    part = lambda a, b, more: F.sqrt(F.col(a) / (F.col(b) + more))
    raw = {
        "z_words": F.log1p(F.col("n_words").cast("double")),
        "z_length": F.log((F.col("word_chars") + SMOOTH * 5.0) / (F.col("n_words") + SMOOTH)),
        "z_symbols": part("n_symbols", "word_chars", 5 * SMOOTH),
        "z_lines": part("n_dup_lines", "n_lines", 2),
        "z_repeats": part("n_repeat_words", "n_words", SMOOTH),
        "z_upper": part("n_upper", "word_chars", 5 * SMOOTH),
    }
    return [F.round(raw[k] * UNIT).cast("long").alias(k) for k in COORDINATES]


PAIRS = [(i, j) for i in range(DIM) for j in range(i, DIM)]
_Z = list(COORDINATES)
_KEYS = ["level", "g_lang", "g_source"]
_FLOOR = [(v * UNIT) ** 2 for v in COORDINATES.values()]


def _with_groups(rows: DataFrame) -> DataFrame:
    """Each row for its own group, its language and all rows. Nulls are a group of their own."""
    named = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    levels = [(0, named("g_lang"), named("g_source")), (1, named("g_lang"), F.lit("*")), (2, F.lit("*"), F.lit("*"))]
    entry = F.array(*[F.struct(F.lit(k).alias("level"), a.alias("g_lang"), b.alias("g_source")) for k, a, b in levels])
    return rows.select(*_Z, "salt", F.explode(entry).alias("e")).select(*_Z, "salt", "e.*")


def _inverse_factor(state: DataFrame) -> DataFrame:
    """Adds the Cholesky factor (l_i_j) of the covariance (c_i_j), each factor made once, in one projection after another.

    No diagonal factor is under its coordinate's least spread, so a singular covariance has a factor too.
    """
    for i in range(DIM):
        for j in range(i + 1):
            got = F.col(f"c_{j}_{i}") - sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0))
            state = state.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(got, F.lit(_FLOOR[i]))) if i == j else got / F.col(f"l_{j}_{j}"))
    return state.select(*[c for c in state.columns if not c.startswith("c_")])


def _distance(df: DataFrame) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance, by forward substitution."""
    for i in range(DIM):
        y = (F.col(_Z[i]) - F.col(f"m_{i}")) - sum((F.col(f"l_{i}_{k}") * F.col(f"y_{k}") for k in range(i)), F.lit(0.0))
        df = df.withColumn(f"y_{i}", y / F.col(f"l_{i}_{i}"))
    df = df.withColumn("d2", reduce(lambda a, b: a + b, [F.col(f"y_{i}") * F.col(f"y_{i}") for i in range(DIM)]))
    return df.drop(*[f"y_{i}" for i in range(DIM)])


def _start(rows: DataFrame) -> DataFrame:
    """Centre and diagonal covariance from the quartiles of every group and coordinate, exact to 16 units."""
    coarse = F.explode(F.array(*[F.struct(F.lit(i).alias("axis"), F.floor(F.col(z) / 16).alias("v")) for i, z in enumerate(_Z)])).alias("e")
    counted = rows.select(*_KEYS, coarse).groupBy(*_KEYS, F.col("e.axis").alias("axis"), F.col("e.v").alias("v")).agg(F.count("*").alias("n"))
    counted = staged(counted, "quality-quartiles")
    of = Window.partitionBy(*_KEYS, "axis")
    ranked = counted.withColumn("upto", F.sum("n").over(of.orderBy("v"))).withColumn("all", F.sum("n").over(of))
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("v"))) * 16.0 + 8.0
    marks = ranked.groupBy(*_KEYS, "axis").agg(at(0.25).alias("a"), at(0.5).alias("b"), at(0.75).alias("c"), F.max("all").alias("n"))
    spread = F.pow((F.col("c") - F.col("a")) / 1.349, 2)
    wide = marks.groupBy(*_KEYS).agg(
        F.max("n").alias("n"),
        *[F.max(F.when(F.col("axis") == i, F.col("b"))).alias(f"m_{i}") for i in range(DIM)],
        *[F.max(F.when(F.col("axis") == i, spread)).alias(f"s_{i}") for i in range(DIM)],
    )
    return wide.select(
        *_KEYS, "n", F.lit(1.0).alias("scale"), *[f"m_{i}" for i in range(DIM)],
        *[(F.col(f"s_{i}") if i == j else F.lit(0.0)).alias(f"c_{i}_{j}") for i, j in PAIRS])


def _step(rows: DataFrame, state: DataFrame) -> DataFrame:
    """One concentration step: the nearest SHARE of every group's rows, to the end of a band, give its next estimate."""
    salted = state.drop("n", "scale").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    near = _distance(rows.join(salted, [*_KEYS, "salt"]))
    band = F.floor(F.log2(F.greatest(F.col("d2"), F.lit(1e-6))) * BANDS_PER_OCTAVE)
    exact = lambda c: F.sum(c.cast("decimal(18,0)"))
    sums = near.groupBy(*_KEYS, band.alias("band")).agg(
        F.count("*").alias("k"), *[exact(F.col(z)).alias(f"s_{i}") for i, z in enumerate(_Z)],
        *[exact(F.col(_Z[i]) * F.col(_Z[j])).alias(f"q_{i}_{j}") for i, j in PAIRS])
    # Written first, as the window's key alone would deal the partial sums: all of the widest group to one task.
    sums = staged(sums, "quality-bands")
    of = Window.partitionBy(*_KEYS)
    ranked = sums.withColumn("upto", F.sum("k").over(of.orderBy("band"))).withColumn("all", F.sum("k").over(of))
    total = lambda c: F.sum(F.col(c)).cast("double")
    core = ranked.filter(F.col("upto") - F.col("k") < SHARE * F.col("all")).groupBy(*_KEYS).agg(
        F.max("all").alias("n"), total("k").alias("k"), F.max("band").alias("edge"),
        *[total(f"s_{i}").alias(f"s_{i}") for i in range(DIM)], *[total(f"q_{i}_{j}").alias(f"q_{i}_{j}") for i, j in PAIRS])
    mean = [F.col(f"s_{i}") / F.col("k") for i in range(DIM)]
    return core.select(
        *_KEYS, "n",
        # How much larger the core is than that of normal rows; a tighter core is never blown up.
        F.greatest(F.lit(1.0), F.pow(F.lit(2.0), (F.col("edge") + 1) / BANDS_PER_OCTAVE) / SHARE_QUANTILE).alias("scale"),
        *[mean[i].alias(f"m_{i}") for i in range(DIM)],
        *[(F.col(f"q_{i}_{j}") / F.col("k") - mean[i] * mean[j]).alias(f"c_{i}_{j}") for i, j in PAIRS])


def fit(measured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Centre, factor of the covariance and scale of every group, language and all rows, from the rows that pass the base rules."""
    narrow = staged(
        measured.filter(~base_failed()).select(*_coordinates(), F.col(f"`{lang}`").cast("string").alias("g_lang"), F.col(f"`{source}`").cast("string").alias("g_source"), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt")), "quality-rows")
    rows = _with_groups(narrow)
    state = staged(_inverse_factor(_start(rows)), "quality-state")
    for _ in range(STEPS):
        # d2 of the last step rests on the state before; its scale belongs to that state.
        state = staged(_inverse_factor(_step(rows, state)), "quality-state")
    return state


def judge(measured: DataFrame, state: DataFrame | None = None, lang: str = "lang", source: str = "source") -> DataFrame:
    """Adds base_failed, distance (null where no estimate exists) and kept to the measured rows."""
    state = fit(measured, lang, source) if state is None else state
    named = lambda c: F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-"))
    # The rows' own columns travel as one struct, so none of their names can clash.
    rows = measured.select(F.struct(*[F.col(f"`{c}`") for c in measured.columns]).alias("__doc"), base_failed().alias("__failed"), *_coordinates(), named(lang).alias("__lang"), named(source).alias("__source"))
    # Which estimate a group uses is settled group by group; the rows then meet one estimate each.
    groups = measured.select(named(lang).alias("__lang"), named(source).alias("__source")).distinct()
    levels = [(0, F.col("__lang"), F.col("__source")), (1, F.col("__lang"), F.lit("*")), (2, F.lit("*"), F.lit("*"))]
    entry = F.array(*[F.struct(F.lit(k).alias("level"), a.alias("g_lang"), b.alias("g_source")) for k, a, b in levels])
    usable = state.filter((F.col("n") >= MIN_ROWS) | (F.col("level") == 2))
    met = groups.select("__lang", "__source", F.explode(entry).alias("e")).select("__lang", "__source", "e.*").join(usable, _KEYS)
    estimates = met.groupBy(F.col("__lang").alias("__l"), F.col("__source").alias("__s")).agg(F.min_by(F.struct(*[c for c in state.columns if c not in _KEYS]), "level").alias("__e"))
    # Written, so that Spark knows how small it is and need not move the documents.
    estimates = staged(estimates, "quality-estimates")
    rows = rows.join(estimates, (F.col("__lang") == F.col("__l")) & (F.col("__source") == F.col("__s")), "left")
    judged = _distance(rows.select("__doc", "__failed", *_Z, "__e.*"))
    out = judged.select("__doc.*", "__failed", (F.col("d2") / F.col("scale")).alias("__d2"))
    failed = F.col("__failed")
    return with_columns(out, base_failed=failed, distance=F.col("__d2"), kept=~failed & F.coalesce(F.col("__d2") <= CUTOFF, F.lit(True))).drop("__d2", "__failed")


def quality_rules(docs: DataFrame) -> DataFrame:
    """Query form: one row per document with its counts and verdict."""
    measured = staged(measure(only(docs, ["doc_id", "text", "lang", "source"])).drop("text"), "quality-counts")
    out = judge(measured)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``docs`` without the documents that the rules reject, with the same columns."""
    c = lambda x: F.col(f"`{x}`")
    # As one struct from the start: a column of docs may have the name of a statistic.
    rows = docs.select(F.struct(*[c(x) for x in docs.columns]).alias("doc"), c(text).alias("text"), c(lang).alias("lang"), c(source).alias("source"))
    judged = judge(staged(measure(rows).drop("text"), "quality-docs"))
    return judged.filter("kept").select("doc.*")
