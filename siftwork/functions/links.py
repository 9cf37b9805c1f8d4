"""Links and contact addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from . import fixed_values as V
from .text import as_col, strip, strip_control

_HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//(?:[^/?#]*@)?([^/?#:@]*)"
_NETLOC = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)"
_PATH = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//[^/?#]*([^?#]*)"
_SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.\-]*)://"


def with_scheme(url) -> Column:
    u = as_col(url)
    return F.when(F.contains(u, F.lit("//")), u).otherwise(F.concat(F.lit("https://"), u))


def _host(u) -> Column:
    return F.lower(F.regexp_extract(u, _HOST, 1))


def link_host(url) -> Column:
    """Lower-case host without one leading ``www.``; the scheme may be missing."""
    u = F.coalesce(as_col(url), F.lit(""))
    return F.when(u == "", F.lit("")).otherwise(F.regexp_replace(_host(with_scheme(u)), r"^www\.", ""))


def unwrap_redirect(url, host: str = "youtube.com") -> Column:
    """Destination behind a ``/redirect?q=`` wrapper, else the URL itself."""
    u = F.coalesce(as_col(url), F.lit(""))
    query = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
    target = F.regexp_extract(query, r"(?:^|&)q=([^&]+)", 1)
    wrapped = _host(u).endswith(host) & (F.regexp_extract(u, _PATH, 1) == "/redirect") & (target != "")
    return F.when(wrapped, F.coalesce(F.try_url_decode(target), target)).otherwise(u)


def contact_url(url) -> Column:
    u = with_scheme(url)
    return F.concat(F.lower(F.regexp_extract(u, _SCHEME, 1)), F.lit("://"), F.regexp_extract(u, _NETLOC, 1), F.lit("/contact"))


def extract_links(html) -> Column:
    """Distinct link targets in document order, redirects unwrapped."""
    raw = F.regexp_extract_all(F.coalesce(as_col(html), F.lit("")), F.lit(r'href="([^"]*)"'), 1)
    return F.array_distinct(F.filter(F.transform(raw, unwrap_redirect), lambda u: u != ""))


LINK_DEPTH = 12


def nested_links(df: DataFrame, doc: str, out: str, root: str = "$", host: str = "youtube.com", depth: int = LINK_DEPTH) -> DataFrame:
    """``df`` with ``out``: distinct destinations of the redirect links in a nested JSON document, however it is nested.

    Every object down to ``depth`` may have a ``url``; one that is a redirect counts, unwrapped. An object's own link comes before those inside
    it; inside, arrays keep their order and the fields of one object come by name, as VARIANT does not keep theirs. What is no JSON has none.
    """
    level, found = F.col("_level"), F.col("_found")
    start = F.array(F.struct(F.lit("").alias("at"), F.try_variant_get(F.try_parse_json(doc), root, "variant").alias("v")))
    rows = df.withColumn("_level", start).withColumn("_found", F.array().cast("array<struct<at:string,url:string>>"))

    def own(e: Column) -> Column:
        url = F.try_variant_get(e["v"], "$.url", "variant")
        return F.struct(e["at"].alias("at"), F.when(F.schema_of_variant(url) == "STRING", F.try_variant_get(e["v"], "$.url", "string")).alias("url"))

    def inside(e: Column) -> Column:
        children = F.coalesce(
            F.map_values(F.try_variant_get(e["v"], "$", "map<string,variant>")), F.try_variant_get(e["v"], "$", "array<variant>"), F.array().cast("array<variant>"))
        return F.transform(children, lambda c, i: F.struct(F.concat(e["at"], F.lpad(i.cast("string"), 9, "0")).alias("at"), c.alias("v")))

    for d in range(depth + 1):
        urls = F.filter(F.transform(level, own), lambda u: F.coalesce(F.contains(u["url"], F.lit("/redirect")), F.lit(False)))
        rows = rows.withColumn("_found", F.concat(found, urls))
        if d < depth:
            rows = rows.withColumn("_level", F.flatten(F.transform(level, inside)))
    ordered = F.transform(F.array_sort(found), lambda u: unwrap_redirect(u["url"], host))
    return rows.withColumn(out, F.array_distinct(F.filter(ordered, lambda u: u != ""))).drop("_level", "_found")


def external_links(urls, hosts=V.THIRD_PARTY_DOMAINS) -> Column:
    """Links that may be the entity's own site: third-party hosts dropped, order kept."""
    keep = F.filter(
        F.coalesce(as_col(urls), F.array().cast("array<string>")),
        lambda u: (link_host(u) != "") & ~link_host(u).isin(*hosts),
    )
    return F.array_distinct(F.transform(keep, with_scheme))


def about_urls(urls, hosts=V.SOCIAL_ABOUT_HOSTS) -> Column:
    """``/about`` pages of social links that have a path and no query."""

    def path(u):
        return F.regexp_replace(F.regexp_extract(with_scheme(u), _PATH, 1), "/+$", "")

    def probe(u):
        p = path(u)
        origin = F.concat(F.lower(F.regexp_extract(with_scheme(u), _SCHEME, 1)), F.lit("://"), F.regexp_extract(with_scheme(u), _NETLOC, 1))
        return F.concat(origin, F.when(p.endswith("/about"), p).otherwise(F.concat(p, F.lit("/about"))))

    keep = F.filter(
        F.coalesce(as_col(urls), F.array().cast("array<string>")),
        lambda u: link_host(u).isin(*hosts) & (F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1) == "") & (path(u) != ""),
    )
    return F.array_distinct(F.transform(keep, probe))


def no_presence(links) -> Column:
    """Drop only on a list proven empty; an unread list is kept."""
    return F.when(F.size(as_col(links)) == 0, F.lit("no_social_presence"))


def safe_entity_url(url, entity_id, pattern=V.ENTITY_URL_PATTERN, id_pattern=V.ENTITY_ID_PATTERN, prefix=V.ENTITY_URL_PREFIX) -> Column:
    """A well-formed URL is kept, else rebuilt from a valid id, else null (rejected)."""
    u = strip(strip_control(url))
    i = F.coalesce(as_col(entity_id).cast("string"), F.lit(""))
    return F.when(u.rlike(pattern), u).when(i.rlike(id_pattern), F.concat(F.lit(prefix), i))


def safe_unsubscribe_url(url) -> Column:
    """An http(s) or mailto link, else null (rejected)."""
    u = strip(strip_control(url))
    return F.when(u.rlike(V.HTTP_URL_PATTERN) | u.rlike(V.MAILTO_PATTERN), u)


def item_id_from_url(url) -> Column:
    u = as_col(url)
    after = F.get(F.split(u, "v=", -1), 1)
    last = F.substring_index(F.regexp_replace(u, "/+$", ""), "/", -1)
    return F.when(F.contains(u, F.lit("v=")), F.substring_index(after, "&", 1)).otherwise(last)


def third_party(email, domains=V.THIRD_PARTY_DOMAINS) -> Column:
    return F.lower(F.substring_index(as_col(email), "@", -1)).isin(*domains)


def emails(text, domains=V.THIRD_PARTY_DOMAINS) -> Column:
    """Addresses in the text in order, without those at third-party domains. Texts without ``@`` are not scanned."""
    found = F.regexp_extract_all(as_col(text), F.lit(f"({V.EMAIL_PATTERN})"), 1)
    listed = F.when(F.contains(as_col(text), F.lit("@")), F.filter(found, lambda e: ~third_party(e, domains)))
    return F.coalesce(listed, F.array().cast("array<string>"))


def first_email(text, domains=V.THIRD_PARTY_DOMAINS) -> Column:
    return F.coalesce(F.get(emails(text, domains), 0), F.lit(""))


def resolve_contact(*steps) -> Column:
    """First non-blank of ``(value, label)`` steps as a struct; empty strings when none has one."""
    picks = [
        F.when(F.coalesce(as_col(v), F.lit("")) != "", F.struct(as_col(v).alias("value"), F.lit(label).alias("source")))
        for v, label in steps
    ]
    return F.coalesce(*picks, F.struct(F.lit("").alias("value"), F.lit("").alias("source")))
