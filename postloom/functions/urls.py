"""Urls, native keys and ids, as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from postloom.boards import BOARDS, Boards, url_of
from postloom.fixed_values import (
    AUTH_HTML_MARKERS,
    AUTH_URL_MARKERS,
    BOT_URL_MARKERS,
    CONTINUE_PARAMS,
    INDEED_KEY,
    INDEED_KEY_IN_URL,
    JOB_URL_MARKERS,
    LINKEDIN_ID,
    META_REFRESH,
    SEARCH_PATH_PREFIXES,
    SEARCH_PATHS,
)
from postloom.functions.text import contains_any, holds_any, let, strip

# --- url parts (they never fail, unlike parse_url) ---------------------------

_SCHEME = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?"


_SCHEME_AND_AUTHORITY = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"


def url_authority(url: Column) -> Column:
    return F.regexp_extract(url, _SCHEME + r"//([^/?#]*)", 1)


def url_host(url: Column) -> Column:
    """Lowered host without user, port."""
    host = F.regexp_replace(url_authority(url), r"^.*@", "")
    return F.lower(F.regexp_replace(host, r":[0-9]*$", ""))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, _SCHEME + r"(?://[^/?#]*)?([^?#]*)", 1)


def url_query(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def url_param(query: Column, name: str) -> Column:
    """First non-empty value of a query parameter, decoded; '' when absent."""
    value = F.regexp_extract(query, rf"(?:^|&){name}=([^&]+)", 1)
    return let(value, lambda v: F.coalesce(F.try_url_decode(v), v))


def url_quote(text: Column) -> Column:
    """Percent-encode with '%20' for a space, '/' and '~' kept."""
    out = F.url_encode(text)
    for encoded, plain in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(encoded), F.lit(plain))
    return out


# --- page kinds --------------------------------------------------------------


def is_auth_wall(url: Column, html: Column) -> Column:
    """A login or bot-detection page, told by its url or, failing that, its html."""
    return holds_any(F.lower(F.coalesce(url, F.lit(""))), AUTH_URL_MARKERS) | contains_any(
        F.lower(F.coalesce(html, F.lit(""))), AUTH_HTML_MARKERS
    )


def is_bot_wall(url: Column) -> Column:
    return holds_any(F.lower(F.coalesce(url, F.lit(""))), BOT_URL_MARKERS)


def is_detail_url(url: Column) -> Column:
    """A posting page, not a login or listing page."""
    low = F.lower(F.coalesce(url, F.lit("")))
    return holds_any(low, JOB_URL_MARKERS) & ~holds_any(low, AUTH_URL_MARKERS)


# --- redirects ---------------------------------------------------------------


def _first(texts: Column, keep: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.get(F.filter(texts, keep), F.lit(0)), F.lit(""))


def continue_url(url: Column) -> Column:
    """Posting url carried in a bounce parameter, or ''."""

    def target(value: Column, root: Column) -> Column:
        dest = strip(F.coalesce(F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))), value))
        return let(dest, lambda d: F.when(d.startswith("/"), F.concat(root, d)).otherwise(d))

    def found(url: Column) -> Column:
        own_root = F.regexp_extract(url, _SCHEME_AND_AUTHORITY, 1)
        root = F.when(
            F.contains(F.lower(F.coalesce(F.nullif(url_authority(url), F.lit("")), url)), F.lit("linkedin")),
            F.lit("https://www.linkedin.com"),
        ).otherwise(own_root)
        values = F.array(*[url_param(url_query(url), p) for p in CONTINUE_PARAMS])
        return let(root, lambda r: _first(F.transform(values, lambda v: target(v, r)), is_detail_url))

    return let(url, found)


def join_url(base: Column, ref: Column) -> Column:
    """``ref`` seen from ``base``: absolute, '//host', '/path', '?query' or relative."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    root = F.concat(scheme, F.lit("://"), url_authority(base))
    folder = F.regexp_replace(url_path(base), r"[^/]*$", "")
    return (
        F.when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | (F.coalesce(base, F.lit("")) == ""), ref)
        .when(ref == "", base)
        .when(ref.startswith("//"), F.concat(scheme, F.lit(":"), ref))
        .when(ref.startswith("/"), F.concat(root, ref))
        .when(ref.startswith("?"), F.concat(root, url_path(base), ref))
        .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), ref))
    )


def meta_refresh_url(html: Column, base: Column) -> Column:
    """Destination of the first meta refresh, or ''."""
    found = strip(F.regexp_extract(F.coalesce(html, F.lit("")), META_REFRESH, 1))
    return let(found, lambda ref: F.when(ref != "", join_url(base, ref)).otherwise(F.lit("")))


def _root(url: Column) -> Column:
    return F.lower(F.rtrim(F.regexp_extract(url, r"^([^?]*)", 1), F.lit("/")))


def redirect_target(final_url: Column, html: Column, requested_url: Column) -> Column:
    """Posting url behind a redirect page, or ''; the page's own root does not count."""

    def found(final: Column) -> Column:
        candidates = F.array(
            continue_url(final),
            meta_refresh_url(html, final),
            continue_url(F.coalesce(requested_url, F.lit(""))),
        )
        return let(
            _root(final), lambda here: _first(candidates, lambda c: is_detail_url(c) & (_root(c) != here))
        )

    return let(F.coalesce(F.nullif(final_url, F.lit("")), requested_url, F.lit("")), found)


# --- canonical posting urls --------------------------------------------------


def canonical_url(board: Column, href: Column, boards: Boards = BOARDS) -> Column:
    """The posting url a board's link stands for; '' for links of other kinds."""
    return url_of(boards.urls, board, F.coalesce(href, F.lit("")))


# --- keys and ids ------------------------------------------------------------


def short_hash(text: Column) -> Column:
    return F.substr(F.sha2(text, 256), F.lit(1), F.lit(16))


# jk, else vjk, out of "?query"; what does not match keeps its '?' and is no key.
_JK_OR_VJK = r"^\?(?:(?:.*?&)?jk=([^&]+)|(?:.*?&)?vjk=([^&]+)).*$"
_LISTING = "|".join([*(f"{p}.*" for p in SEARCH_PATH_PREFIXES), *SEARCH_PATHS])
_HOST_AND_PATH = rf"^(?![^/]*(?:{_LISTING})$)([^/]+/.+)$"


def native_key(board: Column, url: Column) -> Column:
    """The board's own posting identity in a url; null for search pages and foreign urls."""
    url = strip(F.coalesce(url, F.lit("")))
    query = url_query(url)
    jk = F.regexp_replace(F.concat(F.lit("?"), query), _JK_OR_VJK, "$1$2")
    indeed = F.regexp_extract(F.lower(F.try_url_decode(jk)), INDEED_KEY, 1)
    in_path = F.regexp_extract(url_path(url), LINKEDIN_ID, 1)
    current = F.regexp_extract(
        F.try_url_decode(F.regexp_extract(query, r"(?:^|&)currentJobId=([^&]+)", 1)), r"^(\d+)$", 1
    )
    linkedin = F.when(in_path != "", in_path).otherwise(current)
    host = F.regexp_replace(url_host(url), r"^www\.", "")
    place = F.concat(host, F.lower(F.rtrim(url_path(url), F.lit("/"))))
    other = F.regexp_extract(place, _HOST_AND_PATH, 1)
    key = F.when(board == "indeed", indeed).when(board == "linkedin", linkedin).otherwise(other)
    return F.nullif(key, F.lit(""))


def stable_id(board: Column, url: Column) -> Column:
    """16 hex digits from board and native key; null when the url has none."""
    board = F.lower(F.coalesce(board, F.lit("")))
    return short_hash(F.concat(board, F.lit("|"), native_key(board, url)))


def fallback_id(title: Column, company: Column, location: Column) -> Column:
    """Id from the lowered title, company and location."""
    return short_hash(F.concat_ws("|", *[F.lower(F.coalesce(c, F.lit(""))) for c in (title, company, location)]))


def queue_id(title: Column, company: Column, location: Column) -> Column:
    """Like ``fallback_id`` but case-sensitive; the queue has always keyed rows this way."""
    return short_hash(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in (title, company, location)]))


def indeed_key(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), INDEED_KEY_IN_URL, 1)
