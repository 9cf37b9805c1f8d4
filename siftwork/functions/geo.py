"""Where an entity is: country codes, zones, flags and location cues."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import fixed_values as V
from .text import alternation, as_col, fold_country, let, strip

_INDICATORS = "".join(chr(0x1F1E6 + i) for i in range(26))
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Longest names first, so that "south korea" wins over "korea".
_OUTSIDE = "(" + alternation(sorted(V.OUTSIDE_COUNTRY_NAMES, key=len, reverse=True)) + ")"
TITLE_COUNTRY_PATTERN = rf"(?iU)\b{_OUTSIDE}\b"
# Every cue starts with one of these characters; other positions are turned away at once.
DESC_LOCATION_PATTERN = rf"(?iU)(?=[blmhf📍]){V.LOCATION_CUE}[^\n]{{0,{V.LOCATION_GAP}}}?\b{_OUTSIDE}\b"


def _lookup(names: dict[str, str], key: Column) -> Column:
    """Code of a name, null when the name is not listed."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), key)


def country_code(c) -> Column:
    """Two letters pass through in upper case, known names are looked up, the rest is empty."""
    names = {**V.INSIDE_COUNTRY_NAMES, **V.OUTSIDE_COUNTRY_NAMES}
    return let(strip(F.coalesce(as_col(c), F.lit(""))), lambda t: (
        F.when(F.lower(t).isin(*V.UNKNOWN_COUNTRY_VALUES), F.lit(""))
        .when(t.rlike(r"^\p{L}{2}$"), F.upper(t))
        .otherwise(F.coalesce(_lookup(names, fold_country(t)), F.lit("")))
    ))


def _zone(zone) -> Column:
    return zone if isinstance(zone, Column) else F.array(*[F.lit(z) for z in zone])


def zone_verdict(country, zone) -> Column:
    """True inside, False outside, null when nothing readable is declared."""
    return let(country_code(country), lambda code: F.when(code != "", F.array_contains(_zone(zone), code)))


def region_of(tag) -> Column:
    """First two-letter subtag after the language, upper case, else empty."""
    parts = F.split(strip(F.coalesce(as_col(tag), F.lit(""))), "[-_]")
    regions = F.filter(F.slice(parts, F.lit(2), F.size(parts)), lambda p: p.rlike(r"^\p{L}{2}$"))
    return F.coalesce(F.upper(F.get(regions, 0)), F.lit(""))


def flag_codes(c) -> Column:
    """Sorted distinct codes spelled by flag emoji."""
    pairs = F.regexp_extract_all(F.coalesce(as_col(c), F.lit("")), F.lit(r"([\x{1F1E6}-\x{1F1FF}]{2})"), 1)
    return F.array_sort(F.array_distinct(F.transform(pairs, lambda p: F.translate(p, _INDICATORS, _LETTERS))))


def _flag_outside(title, zone) -> Column:
    z = _zone(zone)
    return F.array_min(F.filter(flag_codes(title), lambda x: ~F.array_contains(z, x)))


def _title_country(title) -> Column:
    return _lookup(V.OUTSIDE_COUNTRY_NAMES, F.lower(F.regexp_extract(F.coalesce(as_col(title), F.lit("")), TITLE_COUNTRY_PATTERN, 1)))


def _desc_location(description) -> Column:
    return _lookup(V.OUTSIDE_COUNTRY_NAMES, F.lower(F.regexp_extract(F.coalesce(as_col(description), F.lit("")), DESC_LOCATION_PATTERN, 1)))


def flag_outside(title, zone) -> Column:
    """Alphabetically first out-of-zone flag in the title, else empty."""
    return F.coalesce(_flag_outside(title, zone), F.lit(""))


def title_country(title) -> Column:
    """Code of an outside country named in the title as a word, else empty."""
    return F.coalesce(_title_country(title), F.lit(""))


def desc_location(description) -> Column:
    """Code of an outside country that follows a location cue on the same line, else empty."""
    return F.coalesce(_desc_location(description), F.lit(""))


NO_COUNTRY = "no country set on the channel"


def location_gate(title, description, country, zone) -> Column:
    """``struct(reason, detail)`` of the first signal that places the entity outside, else null.

    Each signal is null when silent, so the first one that speaks ends the evaluation.
    """
    declared = strip(F.coalesce(as_col(country), F.lit("")))
    detail = F.coalesce(
        F.concat(F.lit("title flies the "), _flag_outside(title, zone), F.lit(" flag")),
        F.concat(F.lit("title names "), _title_country(title)),
        F.concat(F.lit("description says "), _desc_location(description)),
        let(zone_verdict(declared, zone), lambda inside: F.when(inside.isNull(), F.lit(NO_COUNTRY)).when(
            ~inside, F.concat(F.lit("declared country "), declared))),
    )
    return let(detail, lambda d: F.when(d.isNotNull(), F.struct(
        F.when(d == NO_COUNTRY, F.lit("no_declared_country")).otherwise(F.lit("outside_search_zone")).alias("reason"), d.alias("detail"))))
