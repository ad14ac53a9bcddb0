"""Links of fetched pages: documents to collect and pages to visit next."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions import text as T

#: The value of href in double quotes, single quotes or bare; then what the anchor holds.
ANCHOR = r"""(?is)<a\s[^>]*?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))[^>]*>(.*?)</a>"""
NAMED = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": "\u00a0", "&amp;": "&"}  # the last one last


def _any_of(text: Column, words: Sequence[str]) -> Column:
    return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(text, w))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"(?i)^https?://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"(?i)^https?://[^/?#]*([^?#]*)", 1))


def _decode(text: Column) -> Column:
    """Percent-decoding; a text that is not validly encoded stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def decode_entities(text: Column) -> Column:
    """Character references by number and the usual names."""
    def by_number(all_text: Column, m: Column) -> Column:
        digits = F.regexp_extract(m, r"(?i)&#x?([0-9a-f]+);", 1)
        code = F.when(m.rlike("(?i)&#x"), F.conv(digits, 16, 10)).otherwise(digits).try_cast("int")
        known = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        return F.when(known, F.replace(all_text, m, F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 8, "0")), "UTF-32"))).otherwise(all_text)

    found = F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?i)&#(?:x[0-9a-f]{1,6}|[0-9]{1,7});"), F.lit(0)))
    out = F.when(F.contains(text, F.lit("&#")), F.aggregate(found, text, by_number)).otherwise(text)
    for name, plain in NAMED.items():
        out = F.replace(out, F.lit(name), F.lit(plain))
    return out


def resolve_link(base: Column, href: Column) -> Column:
    """An href against its page: absolute, scheme-relative, root-relative or
    relative, with ``./`` and ``../`` taken out and the fragment cut off."""
    link = F.regexp_replace(F.trim(href), "#.*$", "")
    scheme = F.regexp_extract(base, r"(?i)^(https?):", 1)
    root = F.regexp_extract(base, r"(?i)^(https?://[^/?#]*)", 1)
    page = F.regexp_replace(base, "[?#].*$", "")
    folder = F.when(page.rlike(r"(?i)^https?://[^/]*$"), F.concat(page, F.lit("/"))).otherwise(
        F.regexp_replace(page, "[^/]*$", ""))
    joined = (
        F.when(link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), link)
        .when(link == "", F.regexp_replace(base, "#.*$", ""))
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, F.lit(":"), link))
        .when(F.startswith(link, F.lit("/")), F.concat(root, link))
        .when(F.startswith(link, F.lit("?")), F.concat(page, link))
        .otherwise(F.concat(folder, link))
    )
    dotted = joined.rlike(r"(?i)^https?://[^?]*/\.\.?(/|$|\?)")
    return F.when(dotted, _without_dots(joined)).otherwise(joined)


def _without_dots(url: Column) -> Column:
    head = F.regexp_extract(url, r"(?i)^(https?://[^/?]*)", 1)
    path = F.regexp_extract(url, r"(?i)^https?://[^/?]*([^?]*)", 1)
    query = F.regexp_extract(url, r"(\?.*)$", 1)
    split = F.split(path, "/")
    steps = F.slice(split, F.lit(2), F.size(split))
    kept = F.aggregate(
        steps, F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc).otherwise(F.array_append(acc, s)))
    return F.concat(head, F.lit("/"), F.array_join(kept, "/"),
                    F.when(path.rlike(r"/\.\.?$"), F.lit("/")).otherwise(""), query)


def page_links(pages: DataFrame, url: str = "url", html: str = "html",
               keep: Sequence[str] = ()) -> DataFrame:
    """(page, link, text, kind, place): every anchor (kind 0), then PDF addresses in scripts and payloads (kind 1)."""
    anchors = F.transform(
        F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(0)),
        lambda a: F.struct(
            decode_entities(F.concat(*[F.regexp_extract(a, ANCHOR, g) for g in (1, 2, 3)])).alias("href"),
            T.squeeze(decode_entities(F.regexp_replace(F.regexp_extract(a, ANCHOR, 4), "(?s)<[^>]*>", " "))).alias("text"),
            F.lit(0).alias("kind")))
    payload = F.transform(
        F.array_distinct(F.regexp_extract_all(F.replace(F.col(html), F.lit("\\/"), F.lit("/")), F.lit(X.PDF_URL), F.lit(0))),
        lambda u: F.struct(u.alias("href"), F.lit("").alias("text"), F.lit(1).alias("kind")))
    return (
        pages.select(F.col(url).alias("page"), *keep, F.posexplode(F.concat(anchors, payload)).alias("place", "_l"))
        .select("page", *keep, "place", resolve_link(F.col("page"), F.col("_l.href")).alias("link"),
                F.col("_l.text").alias("text"), F.col("_l.kind").alias("kind"))
        .where(F.col("link").rlike("(?i)^https?:"))
    )


def is_document(url: Column, pattern: str | None = None) -> Column:
    pdf = F.endswith(url_path(url), F.lit(".pdf"))
    return pdf | url.rlike(pattern) if pattern else pdf


def worth_following(url: Column, words: Sequence[str] = tuple(X.FOLLOW_WORDS)) -> Column:
    low = F.lower(url)
    ends = F.exists(F.array(*[F.lit(e) for e in X.SKIPPED_EXTENSIONS]), lambda e: F.endswith(low, e))
    return ~ends & _any_of(low, words)


def may_skip(url: Column, text: Column) -> Column:
    return _any_of(F.lower(F.concat(_decode(url), F.lit(" "), text)), X.SKIP_WORDS)


def on_allowed_host(links: DataFrame, sources: DataFrame, source: str = "source",
                    link: str = "link") -> DataFrame:
    """Links whose host contains one of their source's allowed hosts.

    ``sources``: (source, hosts array) — the registry of some thirty sources.
    """
    return (
        links.join(sources.select(source, F.col("hosts").alias("_hosts")), source)
        .where(F.exists("_hosts", lambda h: F.contains(host(F.col(link)), h))).drop("_hosts")
    )


def discover_documents(links: DataFrame, pattern: str | None = None) -> DataFrame:
    """Documents to collect, each once per source with the first text found: by page, then anchors before payloads, then place."""
    wanted = links.where(((F.col("kind") == 1) | is_document(F.col("link"), pattern))
                         & ~may_skip(F.col("link"), F.col("text")))
    first = F.min(F.struct("page_order", "kind", "place", "text", "page"))
    return wanted.groupBy("source", "link").agg(first.alias("_f")).select(
        "source", "link", "_f.text", F.col("_f.page").alias("found_on"))


def next_frontier(links: DataFrame, visited: DataFrame, max_depth: int,
                  words: Sequence[str] = tuple(X.FOLLOW_WORDS), pattern: str | None = None) -> DataFrame:
    """Pages to visit next: not documents, worth following, not visited, not too deep."""
    pages = links.where(~is_document(F.col("link"), pattern) & (F.col("depth") < max_depth)
                        & worth_following(F.col("link"), words))
    return (
        pages.groupBy("source", "link").agg((F.min("depth") + 1).alias("depth"))
        .join(visited.select("source", "link").distinct(), ["source", "link"], "left_anti")
    )
