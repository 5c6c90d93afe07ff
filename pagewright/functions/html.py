"""HTML and URL expressions over one page's text. All of them stay inside the JVM."""

from __future__ import annotations

import json
from functools import lru_cache
from html import unescape
from html.entities import html5
from urllib.parse import uses_netloc, uses_relative

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagewright.functions import text as tx

# The patterns that decide which parts of a page count.
TAG = r"<[^>]+>"
SCRIPT_OR_STYLE = r"(?is)<(script|style)\b[^>]*>.*?</\1>"
COMMENT = r"(?s)<!--.*?-->"
BARE_TITLE = r"(?is)<title>(.*?)</title>"
ANY_TITLE = r"(?is)<title[^>]*>(.*?)</title>"
BODY = r"(?is)<body[^>]*>(.*?)</body>"
META = r"""(?i)<meta[^>]+(?:property|name)=["']([^"']+)["'][^>]+content=["']([^"']*)["']"""
HREF = r"""(?i)href=["']([^"']+)["']"""
LD_JSON = r"""(?is)<script[^>]+type=["']application/ld\+json["'][^>]*>(.*?)</script>"""
SCRIPT = r"(?is)<script[^>]*>(.*?)</script>"
STATE_NAMES = ("__INITIAL_STATE__", "__NEXT_DATA__", "__STATE__", "INITIAL_STATE")
STATE = rf"(?s)(?:window\.)?(?:{'|'.join(STATE_NAMES)})\s*=\s*(\{{.*?\}})\s*;"
STATE_PREFIX = "window.__STATE__="
REVIEW_CARD = (
    r"""(?is)<div[^>]+(?:class|data-testid)=['"][^'"]*(?:review|rating)[^'"]*['"][^>]*>(.*?)</div>"""
)
LINK_WORDS = ("review", "rating", "page=")

_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_MARK = "\ufdd0"  # a code point that is never text (nor kept as such), set around each reference
_COMMON = {"lt": "<", "gt": ">", "quot": '"', "#39": "'", "nbsp": "\xa0", "copy": "©", "middot": "·"}
_URL = r"(?s)^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"
_DOT_SEGMENT = r"(?:^|/)\.\.?(?:/|$)"


@lru_cache(maxsize=1)
def _entity_tables() -> tuple[str, str, str]:
    """The named and the irregular numeric character references, read from the standard library.

    Returned as (JSON map of first letter to names, pattern of the names that need no semicolon, JSON
    map of the numbers that do not stand for themselves). A map lookup scans, so the names are
    grouped by their first letter.
    """
    names: dict[str, dict[str, str]] = {}
    for name, char in html5.items():
        names.setdefault(name[0], {})[name] = char
    bare = sorted((name for name in html5 if not name.endswith(";")), key=len, reverse=True)
    odd = [*range(0x20), *range(0x7F, 0xA0), *range(0xFDD0, 0xFDF0)]
    odd += [plane + low for plane in range(0, 0x110000, 0x10000) for low in (0xFFFE, 0xFFFF)]
    numbers = {str(n): unescape(f"&#{n};") for n in odd if unescape(f"&#{n};") != chr(n)}
    return json.dumps(names), "|".join(bare), json.dumps(numbers)


def _literal_map(pairs: str, kind: str = "map<string,string>") -> Column:
    return F.from_json(F.lit(pairs), kind)


def _char_of(number: Column, irregular: str) -> Column:
    """Character of a code point: irregular ones from the table, impossible ones U+FFFD."""

    def char(n: Column) -> Column:
        bad = n.isNull() | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
        plain = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        odd = (n < 0x20) | n.between(0x7F, 0x9F) | (n >= 0xFDD0)
        listed = F.try_element_at(_literal_map(irregular), n.cast("string"))
        return (
            F.when(bad, F.lit("\ufffd")).when(odd, F.coalesce(listed, plain)).otherwise(plain)
        )

    return tx.let(number, char)


def _name(body: Column) -> Column:
    """Text of a named reference (``body`` is what follows ``&``), NULL when no name fits."""
    names, bare, _ = _entity_tables()
    letters = _literal_map(names, "map<string,map<string,string>>")

    def look_up(table: Column) -> Column:
        by_prefix = tx.let(
            F.regexp_extract(body, f"^(?:{bare})", 0),
            lambda name: F.concat(F.try_element_at(table, name), F.substr(body, F.length(name) + 1)),
        )
        return F.coalesce(F.try_element_at(table, body), by_prefix)

    return tx.let(F.try_element_at(letters, F.substring(body, 1, 1)), look_up)


def _resolve(piece: Column) -> Column:
    """A reference as its character(s); any other piece unchanged."""
    irregular = _entity_tables()[2]
    hexes = F.regexp_extract(piece, r"^&#[xX]0*([0-9a-fA-F]{0,8});?$", 1)
    digits = F.regexp_extract(piece, r"^&#0*([0-9]{0,8});?$", 1)
    number = (
        F.when(piece.rlike("^&#[xX]0+;?$|^&#0+;?$"), F.lit(0).cast("bigint"))
        .when(piece.rlike("^&#[xX]"), F.conv(hexes, 16, 10).try_cast("bigint"))
        .otherwise(digits.try_cast("bigint"))
    )
    named = tx.let(F.substring(piece, 2, 40), _name)
    return (
        F.when(~piece.startswith("&"), piece)
        .when(piece.rlike("^&#[0-9]+;?$|^&#[xX][0-9a-fA-F]+;?$"), _char_of(number, irregular))
        .otherwise(F.coalesce(F.when(piece.rlike(f"^{_REFERENCE}$"), named), piece))
    )


def unescape_html(value: Column) -> Column:
    """Named and numeric character references to characters; text without ``&`` is not touched.

    When every ``&`` starts a common reference, plain replacing is enough: none of the characters
    put in is an ``&`` until the last step.
    """

    def unescape_in(text: Column) -> Column:
        common = text
        for name, char in _COMMON.items():
            common = F.replace(common, F.lit(f"&{name};"), F.lit(char))
        common = F.replace(common, F.lit("&amp;"), F.lit("&"))
        marked = F.regexp_replace(text, _REFERENCE, f"{_MARK}$0{_MARK}")
        pieces = F.transform(F.split(marked, _MARK), _resolve)
        return (
            F.when(~F.contains(text, F.lit("&")), text)
            .when(~text.rlike(f"&(?!(?:{'|'.join(_COMMON)}|amp);)"), common)
            .otherwise(F.array_join(pieces, ""))
        )

    return tx.let(value, unescape_in)


def strip_tags(value: Column) -> Column:
    return tx.squeeze(unescape_html(F.regexp_replace(value, TAG, " ")))


def visible_text(html: Column) -> Column:
    """Text a reader sees, case and character references resolved."""
    return strip_tags(F.regexp_replace(tx.text_of(html), SCRIPT_OR_STYLE, " "))


def block_text(html: Column) -> Column:
    """Lower-cased visible text for marker search: comments dropped too, references left alone."""
    bare = F.regexp_replace(tx.text_of(html), SCRIPT_OR_STYLE, " ")
    bare = F.regexp_replace(F.regexp_replace(bare, COMMENT, " "), TAG, " ")
    return F.lower(tx.squeeze(bare))


def snapshot_title(html: Column) -> Column:
    """Content of a bare ``<title>``; NULL when there is none or it is empty."""
    return tx.non_empty(strip_tags(F.regexp_extract(html, BARE_TITLE, 1)))


def block_title(html: Column) -> Column:
    return F.lower(tx.squeeze(F.regexp_extract(tx.text_of(html), ANY_TITLE, 1)))


def body_html(html: Column) -> Column:
    """Inside of ``<body>``, or the whole page when there is none."""
    found = lambda body: F.when(body != "", body).when(html.rlike(BODY), body).otherwise(html)
    return tx.let(F.regexp_extract(html, BODY, 1), found)


def meta_tags(html: Column) -> Column:
    """array<struct<key, value>> of the page's meta tags in document order."""
    tags = F.regexp_extract_all(html, F.lit(META), F.lit(0))
    return F.transform(
        tags,
        lambda tag: F.struct(
            F.lower(F.regexp_extract(tag, META, 1)).alias("key"),
            tx.strip(unescape_html(F.regexp_extract(tag, META, 2))).alias("value"),
        ),
    )


def last_meta(tags: Column, *keys: str) -> Column:
    """Value of the first listed key that has a non-empty value; within a key the last tag wins."""

    def one(key: str) -> Column:
        hits = F.filter(tags, lambda tag: tag["key"] == key)
        return tx.non_empty(F.try_element_at(hits, F.lit(-1))["value"])

    return F.coalesce(*[one(key) for key in keys])


def json_texts(html: Column) -> Column:
    """array<string> of the page's embedded JSON candidates: ld+json scripts, then state
    assignments, then scripts whose whole body is one object. Validity is not checked here."""
    ld = F.regexp_extract_all(html, F.lit(LD_JSON), F.lit(1))
    has_state = F.lit(False)
    for name in STATE_NAMES:
        has_state = has_state | F.contains(html, F.lit(name))
    state = F.when(has_state, F.regexp_extract_all(html, F.lit(STATE), F.lit(1))).otherwise(
        F.array().cast("array<string>")
    )
    bodies = F.transform(
        F.regexp_extract_all(html, F.lit(SCRIPT), F.lit(1)),
        lambda body: F.regexp_replace(tx.strip(body), "^" + STATE_PREFIX.replace(".", r"\."), ""),
    )
    whole = F.filter(bodies, lambda body: body.startswith("{") & body.endswith("}"))
    return F.concat(F.transform(F.concat(ld, state), tx.strip), whole)


def extract_product_id(url: Column) -> Column:
    """Query ``itemid``, then ``product_id``, then the last digit run of the path, then a hash."""
    query = F.regexp_extract(url, _URL, 4)
    path = F.regexp_replace(F.regexp_extract(url, _URL, 3), ";[^/]*$", "")

    def parameter(name: str) -> Column:
        raw = tx.non_empty(F.regexp_extract(query, rf"[?&]{name}=([^&]+)", 1))
        return tx.let(raw, lambda r: F.coalesce(F.try_url_decode(r), F.translate(r, "+", " ")))

    digits = F.try_element_at(F.regexp_extract_all(path, F.lit(r"(?U)\d+"), F.lit(0)), F.lit(-1))
    return F.coalesce(
        parameter("itemid"), parameter("product_id"), digits, F.substring(tx.stable_hash(url), 1, 16)
    )


def _fold_dots(segments: Column) -> Column:
    """Apply ``.`` and ``..`` path segments."""
    empty = F.array().cast("array<string>")
    folded = F.aggregate(
        segments,
        empty,
        lambda done, seg: F.when(seg == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(seg == ".", done)
        .otherwise(F.concat(done, F.array(seg))),
    )
    last = F.try_element_at(segments, F.lit(-1))
    return F.when(last.isin(".", ".."), F.concat(folded, F.array(F.lit("")))).otherwise(folded)


def _split_url(url: Column) -> Column:
    """struct<scheme, host, path, query, fragment>; a bare ``//``, ``?`` or ``#`` counts as absent."""
    part = lambda group: F.regexp_extract(url, _URL, group)
    real = lambda text, least: F.when(F.length(text) > least, text).otherwise(F.lit(""))
    return F.struct(
        F.lower(part(1)).alias("scheme"),
        tx.let(part(2), lambda t: real(t, 2)).alias("host"),
        part(3).alias("path"),
        tx.let(part(4), lambda t: real(t, 1)).alias("query"),
        tx.let(part(5), lambda t: real(t, 1)).alias("fragment"),
    )


def _join_path(base_path: Column, path: Column) -> Column:
    """Path of a link seen from a base path: empty links keep it, dot segments are applied."""
    is_rooted = path.startswith("/")

    def join(rooted: Column) -> Column:
        def fold(segments: Column) -> Column:
            inner = F.filter(
                segments,
                lambda seg, i: is_rooted | (i == 0) | (i == F.size(segments) - 1) | (seg != ""),
            )
            return F.when(rooted.rlike(_DOT_SEGMENT), tx.let(inner, _fold_dots)).otherwise(inner)

        return F.array_join(tx.let(F.split(rooted, "/"), fold), "/")

    folder = F.regexp_replace(base_path, "[^/]*$", "")
    joined = tx.let(F.when(is_rooted, path).otherwise(F.concat(folder, path)), join)
    return F.when(path == "", base_path).otherwise(F.coalesce(tx.non_empty(joined), F.lit("/")))


def _build_url(base: Column, link: Column, scheme: Column) -> Column:
    """Text of the URL that ``link`` (split) names from ``base`` (split)."""
    own_host = link["host"] != ""
    bare = ~own_host & (link["path"] == "") & (link["query"] == "")

    def build(host: Column, path: Column) -> Column:
        slashed = (path == "") | path.startswith("/")
        authority = (
            F.when(host != "", F.concat(host, F.when(slashed, "").otherwise(F.lit("/"))))
            .when(path.startswith("//"), F.lit("//"))
            .when(scheme.isin([s for s in uses_netloc if s]) & slashed, F.lit("//"))
            .otherwise(F.lit(""))
        )
        return F.concat(
            F.when(scheme == "", F.lit("")).otherwise(F.concat(scheme, F.lit(":"))),
            authority,
            path,
            F.when(bare, base["query"]).otherwise(link["query"]),
            link["fragment"],
        )

    host = F.when(own_host, link["host"]).otherwise(base["host"])
    path = F.when(own_host, link["path"]).otherwise(_join_path(base["path"], link["path"]))
    return tx.let(host, lambda h: tx.let(path, lambda p: build(h, p)))


def resolve_url(base: Column, link: Column) -> Column:
    """Absolute form of ``link`` as seen from ``base``, by the rules of RFC 3986."""
    clean = F.regexp_replace(F.regexp_replace(link, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    relative = [s for s in uses_relative if s]

    def resolve(b: Column, l: Column) -> Column:
        def with_scheme(scheme: Column) -> Column:
            foreign = (scheme != b["scheme"]) | ((scheme != "") & ~scheme.isin(relative))
            return F.when(foreign, link).otherwise(_build_url(b, l, scheme))

        return tx.let(F.coalesce(tx.non_empty(l["scheme"]), b["scheme"]), with_scheme)

    joined = tx.let(_split_url(base), lambda b: tx.let(_split_url(clean), lambda l: resolve(b, l)))
    return F.when(link == "", base).when(base == "", link).otherwise(joined)


def review_links(html: Column, base: Column, max_pages: int | None = None) -> Column:
    """array<string> of the pages to read for a product: links that look like review pages, made
    absolute, first seen first, with the base page put first when absent; at most ``max_pages`` if given."""
    hrefs = F.regexp_extract_all(html, F.lit(HREF), F.lit(1))
    wanted = F.filter(hrefs, lambda h: F.lower(h).rlike("|".join(LINK_WORDS)))
    resolved = F.transform(F.array_distinct(wanted), lambda h: resolve_url(base, h))
    first = (lambda links: links) if max_pages is None else (lambda links: F.slice(links, 1, max_pages))
    listed = tx.let(
        first(F.array_distinct(resolved)),
        lambda f: F.when(F.array_contains(f, base), f).otherwise(F.concat(F.array(base), f)),
    )
    return first(listed)
