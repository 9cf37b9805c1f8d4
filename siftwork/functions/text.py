"""Text normalisation as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from . import fixed_values as V


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rounded(x, places: int) -> Column:
    """A double rounded half up as SQL engines do it: times the power of ten, to a whole number, and back.

    ``F.round`` looks at the shortest decimal form instead: 103 / 4000 * 100 is written 2.5749999999999997, but a hundred times that is 257.5.
    """
    scale = F.lit(10.0**places)
    return F.round(as_col(x).cast("double") * scale) / scale


# Every Unicode white-space character.
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(chr(c) for c in range(0x2000, 0x200B))


def strip(c) -> Column:
    """Trim every kind of whitespace, not only spaces."""
    return F.btrim(as_col(c), F.lit(WHITE_SPACE))


def blank(c) -> Column:
    """True for null or whitespace-only text."""
    return F.length(strip(F.coalesce(as_col(c), F.lit("")))) == 0


def fold_case(c) -> Column:
    """Lower case with the one full case folding that occurs in Latin text (sharp s)."""
    return F.replace(F.lower(as_col(c)), F.lit("ß"), F.lit("ss"))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` refers to it."""
    return F.get(F.transform(F.array(value), body), 0)


def alternation(terms) -> str:
    """``terms`` as one alternation with first letters factored out; the order within a letter is kept.

    A look-ahead on the possible first letters turns most positions of a long text away at once.
    """
    heads: dict[str, list[str]] = {}
    for t in terms:
        heads.setdefault(t[0], []).append(t[1:])
    branches = [re.escape(h) + "(?:" + "|".join(re.escape(t) for t in rest) + ")" for h, rest in heads.items()]
    return "(?=[" + "".join(re.escape(h) for h in heads) + "])(?:" + "|".join(branches) + ")"


def any_word(terms) -> str:
    """One pattern matching any of ``terms`` on word boundaries, whatever the case."""
    return r"(?iU)\b" + alternation([t.lower() for t in terms]) + r"\b"


def contains_any(c, terms) -> Column:
    """Substring test against a term list, as one alternation (terms are lower case)."""
    return F.lower(as_col(c)).rlike(alternation(terms))


def normalize_handle(c) -> Column:
    """First ``@name`` anywhere in the text, lower case, else the empty string."""
    return F.lower(F.regexp_extract(F.coalesce(as_col(c), F.lit("")), V.HANDLE_PATTERN, 1))


def handle_key(c) -> Column:
    """``normalize_handle``, else the bare text without leading ``@`` in lower case."""
    found = normalize_handle(c)
    bare = F.lower(F.regexp_replace(strip(F.coalesce(as_col(c), F.lit(""))), "^@+", ""))
    return F.when(found != "", found).otherwise(bare)


def normalize_title(c) -> Column:
    """What two cuts of one item share: no bracket suffix, no punctuation, one case, one space."""
    t = F.regexp_replace(strip(F.coalesce(as_col(c), F.lit(""))), V.TITLE_SUFFIX_PATTERN, "")
    t = F.regexp_replace(fold_case(t), "[^a-z0-9 ]+", " ")
    return F.trim(F.regexp_replace(t, " +", " "))


def fold_name(c) -> Column:
    """Display name with inner spaces collapsed and case folded (for tracked-elsewhere matching)."""
    return fold_case(F.regexp_replace(strip(F.coalesce(as_col(c), F.lit(""))), r"(?U)\s+", " "))


def suppression_name(c) -> Column:
    """Display name for suppression matching: trimmed and case folded, inner spaces kept."""
    return fold_case(strip(F.coalesce(as_col(c), F.lit(""))))


def fold_country(c) -> Column:
    t = F.lower(strip(F.coalesce(as_col(c), F.lit(""))))
    return F.trim(F.regexp_replace(F.replace(t, F.lit(","), F.lit(" ")), r"(?U)\s+", " "))


def as_int(c, default: int = 0) -> Column:
    """Whole-number text to bigint, anything unreadable to ``default``."""
    t = strip(as_col(c).cast("string"))
    return F.coalesce(F.when(t.rlike(r"^[+-]?\d+$"), t.try_cast("bigint")), F.lit(default).cast("bigint"))


def csv_safe(c) -> Column:
    """Quote a value a spreadsheet would run as a formula."""
    c = as_col(c)
    return F.when(F.substring(c, 1, 1).isin(*V.FORMULA_PREFIXES), F.concat(F.lit("'"), c)).otherwise(c)


def csv_unsafe(c) -> Column:
    """Exact inverse of :func:`csv_safe`."""
    c = as_col(c)
    quoted = (F.substring(c, 1, 1) == "'") & F.substring(c, 2, 1).isin(*V.FORMULA_PREFIXES)
    return F.when(quoted, c.substr(F.lit(2), F.length(c))).otherwise(c)


def redact(c) -> Column:
    """First character and domain of an address, ``?`` when there is no ``@``."""
    c = F.coalesce(as_col(c), F.lit(""))
    return F.when(F.instr(c, "@") == 0, F.lit("?")).otherwise(
        F.concat(F.substring(F.substring_index(c, "@", 1), 1, 1), F.lit("***@"), c.substr(F.instr(c, "@") + F.lit(1), F.length(c)))
    )


def strip_control(c) -> Column:
    return F.regexp_replace(F.coalesce(as_col(c), F.lit("")), r"[\r\n\x00]", "")


def greeting_name(c) -> Column:
    """Name without control characters; a neutral word when nothing readable is left."""
    t = strip(strip_control(c))
    return F.when(t.rlike(r"[\p{L}\p{N}]"), t).otherwise(F.lit("there"))


def display_count(c, suffix: str = "") -> Column:
    """``3.5M`` / ``121K`` / plain number, followed by ``suffix``."""
    n = as_col(c).cast("double")

    def short(x):
        return F.regexp_replace(x.cast("string"), r"\.0$", "")

    text = (
        F.when(n >= 1_000_000, F.concat(short(rounded(n / 1_000_000, 1)), F.lit("M")))
        .when(n >= 1000, F.concat(F.round(n / 1000, 0).cast("bigint").cast("string"), F.lit("K")))
        .otherwise(as_col(c).cast("bigint").cast("string"))
    )
    return F.concat(text, F.lit(suffix))


def claim_key(entity, campaign) -> Column:
    return F.concat_ws(":", as_col(entity).cast("string"), as_col(campaign))


def miss_note(note) -> Column:
    """Why no contact was found: the given note, else the plain statement that all steps ran."""
    n = strip(F.coalesce(as_col(note), F.lit("")))
    return F.when(n != "", F.format_string("none found (%s)", n)).otherwise(F.lit(V.MISS_NOTE_ALL))


def is_english(tag) -> Column:
    """Unset language is *not* English: one of the two deliberate breaks of 'unknown passes'."""
    return F.coalesce(F.lower(strip(as_col(tag))).startswith("en"), F.lit(False))


def _range_class(ranges) -> str:
    return "".join(f"\\x{{{lo:04X}}}-\\x{{{hi:04X}}}" for lo, hi in ranges)


def script_chars(c, ranges=V.NON_LATIN_RANGES) -> Column:
    """How many characters of the text lie in the given code-point ranges."""
    t = F.coalesce(as_col(c), F.lit(""))
    return F.length(t) - F.length(F.regexp_replace(t, f"[{_range_class(ranges)}]+", ""))


def non_latin(c, min_chars=V.NON_LATIN_MIN_CHARS, min_ratio=V.NON_LATIN_MIN_RATIO, ranges=V.NON_LATIN_RANGES) -> Column:
    """Text substantially in a listed script: enough characters *and* a large enough share."""
    counted = F.struct(script_chars(c, ranges).alias("n"), F.length(strip(F.coalesce(as_col(c), F.lit("")))).alias("size"))
    return let(counted, lambda x: (x["n"] >= min_chars) & (F.coalesce(F.try_divide(x["n"], x["size"]), F.lit(0.0)) >= min_ratio))


def excluded_topic(texts, topics=V.EXCLUDED_TOPIC_TERMS) -> Column:
    """First category, in the given order, whose terms occur as words in the joined texts."""
    blob = F.concat_ws(" ", *[F.nullif(as_col(t), F.lit("")) for t in texts])
    return F.coalesce(*[F.when(blob.rlike(any_word(terms)), F.lit(cat)) for cat, terms in topics.items()])


def broadcaster(title, description, names=V.BROADCAST_NAME_TERMS, phrases=V.BROADCAST_PHRASE_TERMS) -> Column:
    """Names are read in the title only, self-describing phrases in title and description."""
    t, d = (F.coalesce(as_col(x), F.lit("")) for x in (title, description))
    return F.when(t.rlike(any_word(names)), F.lit("broadcast_tv_name")).when(
        F.concat_ws(" ", t, d).rlike(any_word(phrases)), F.lit("broadcast_tv_phrase")
    )


def persona_signals(bio, signals=V.BIO_OFF_SIGNALS) -> Column:
    """Listed phrases that occur in the bio, in list order."""
    low = F.lower(F.coalesce(as_col(bio), F.lit("")))
    return F.filter(F.array(*[F.lit(s) for s in signals]), lambda s: F.contains(low, s))
