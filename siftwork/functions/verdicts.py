"""Reviewer-model verdicts: validation, confirmation, notes, error codes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import fixed_values as V
from .text import as_col, let, strip

ENVELOPE = (
    "struct<candidates:array<struct<finishReason:string,content:struct<parts:array<struct<text:string>>>>>,"
    "modelVersion:string,usageMetadata:struct<promptTokenCount:bigint>>"
)
VERDICT = (
    "struct<matches:boolean,confidence:double,reason:string,"
    "criteria_results:array<struct<criterion:string,matches:boolean,evidence:string>>>"
)


def verdict_text(env: Column) -> Column:
    """Text of all parts of the first candidate of a parsed body."""
    parts = F.get(env["candidates"], 0)["content"]["parts"]
    return strip(F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], F.lit(""))), ""))


def valid_verdict(body, verdict_key: str = "matches") -> Column:
    """Reason code of a response body: ``ok``, ``malformed``, ``max_tokens`` or ``safety_blocked``.

    The envelope and the verdict inside it are each parsed once.
    """
    raw = f"struct<{verdict_key}:string,confidence:string,criteria_results:string>"

    def well_formed(x):
        conf, v, text = x["v"]["confidence"].try_cast("double"), x["v"], x["text"]
        quoted = text.rlike(rf'"(?:confidence|{verdict_key})"\s*:\s*"')
        return (
            F.coalesce(v[verdict_key].isin("true", "false") & (conf >= 0) & (conf <= 1) & v["criteria_results"].startswith("["), F.lit(False)) & ~quoted
        )

    def code(env):
        finish = F.upper(F.coalesce(F.get(env["candidates"], 0)["finishReason"], F.lit("")))
        parsed = let(F.coalesce(verdict_text(env), F.lit("")), lambda t: F.struct(t.alias("text"), F.from_json(t, raw).alias("v")))
        return (
            F.when(F.coalesce(F.size(env["candidates"]), F.lit(-1)) <= 0, F.lit("malformed"))
            .when(finish == "MAX_TOKENS", F.lit("max_tokens"))
            .when(finish.isin(*V.BLOCKED_FINISH_REASONS), F.lit("safety_blocked"))
            .when(let(parsed, well_formed), F.lit("ok"))
            .otherwise(F.lit("malformed"))
        )

    return let(F.from_json(as_col(body), ENVELOPE), code)


def verdict_confirms(payload, min_confidence=V.MIN_CONFIDENCE, min_ratio=V.MIN_CRITERIA_RATIO, required=()) -> Column:
    """``struct(confirmed, why)``: confidence floor, required criteria, overall flag, matched share."""
    p = as_col(payload)
    conf = F.coalesce(p["confidence"], F.lit(0.0))
    results = F.coalesce(p["criteria_results"], F.array().cast("array<struct<criterion:string,matches:boolean,evidence:string>>"))
    n = F.size(results)
    hits = F.size(F.filter(results, lambda c: F.coalesce(c["matches"], F.lit(False))))
    conf_text = F.format_string("%.2f", conf)
    counts = F.concat(hits.cast("string"), F.lit("/"), n.cast("string"), F.lit(" criteria)"))

    def out(ok, why):
        return F.struct(F.lit(ok).alias("confirmed"), why.alias("why"))

    failed_required = F.filter(
        results, lambda c: c["criterion"].isin(*required) & ~F.coalesce(c["matches"], F.lit(False))
    ) if required else F.filter(results, lambda c: F.lit(False))
    return (
        F.when(conf < min_confidence, out(False, F.concat(F.lit("below confidence ("), conf_text, F.lit(")"))))
        .when(F.size(failed_required) > 0, out(False, F.concat(F.lit("failed a required criterion: "), F.get(failed_required, 0)["criterion"])))
        .when(F.coalesce(p["matches"], F.lit(False)), out(True, F.concat(F.lit("video confirmed "), conf_text)))
        .when(n == 0, out(False, F.concat(F.lit("video did not confirm ("), conf_text, F.lit(")"))))
        .when(F.try_divide(hits, n) >= min_ratio, out(True, F.concat(F.lit("video partly confirmed "), conf_text, F.lit(" ("), counts)))
        .otherwise(out(False, F.concat(F.lit("video did not confirm ("), conf_text, F.lit(", "), counts)))
    )


def verdict_notes(reason, criteria, max_chars=V.NOTES_MAX_CHARS) -> Column:
    """Reason and per-criterion evidence on one line, whitespace collapsed, cut to ``max_chars``."""
    bits = F.transform(
        as_col(criteria),
        lambda c: F.concat(
            F.lit("["), c["criterion"], F.when(F.coalesce(c["matches"], F.lit(False)), F.lit(": yes] ")).otherwise(F.lit(": no] ")),
            F.coalesce(c["evidence"], F.lit("")),
        ),
    )
    joined = F.concat_ws(" ", strip(F.coalesce(as_col(reason), F.lit(""))), F.array_join(bits, " "))
    return F.substring(strip(F.regexp_replace(joined, r"(?U)\s+", " ")), 1, max_chars)


def _ascii_escaped(text: Column) -> Column:
    """JSON text with every non-ASCII character written as ``\\uXXXX`` (surrogate pairs above the BMP)."""

    def unit(cp):
        return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(cp)), 4, "0"))

    def one(ch):
        cp = F.ascii(ch).cast("bigint")
        rest = cp - 0x10000
        pair = F.concat(unit(F.lit(0xD800) + F.shiftright(rest, 10)), unit(F.lit(0xDC00) + rest.bitwiseAND(F.lit(0x3FF))))
        return F.when(cp < 128, ch).when(cp < 0x10000, unit(cp)).otherwise(pair)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def criteria_hash(criteria) -> Column:
    """First 16 hex digits of the SHA-256 of canonical JSON (struct fields must be in name order)."""
    return F.substring(F.sha2(_ascii_escaped(F.to_json(as_col(criteria))), 256), 1, 16)


def classify_error(status, body) -> Column:
    """Named reason of a non-200 response."""
    s, b = as_col(status), F.coalesce(as_col(body), F.lit(""))
    low = F.lower(b)
    return (
        F.when((s == 429) & (F.contains(b, F.lit("PerDay")) | F.contains(low, F.lit("per day"))), F.lit("quota_exhausted"))
        .when((s == 429) & (F.contains(b, F.lit("PerMinute")) | F.contains(low, F.lit("per minute"))), F.lit("rate_limited"))
        .when(s == 429, F.lit("quota_exhausted"))
        .when(s.isin(400, 403, 404) & low.rlike("|".join(V.MEDIA_ERROR_WORDS)), F.lit("video_unavailable"))
        .when(s.isin(400, 403, 404), F.lit("request_rejected"))
        .otherwise(F.lit("unreachable"))
    )


def first_key(json, *names) -> Column:
    """First non-blank of several possible id fields, without leading ``@``, lower case."""
    picks = [F.nullif(F.get_json_object(as_col(json), f"$.{n}"), F.lit("")) for n in names]
    return F.lower(F.regexp_replace(F.coalesce(*picks), "^@+", ""))
