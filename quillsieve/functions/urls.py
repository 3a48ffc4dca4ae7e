"""URLs: identifiers, tests, pagination and variants, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillsieve.functions.text import first_of, strip_html, text, trim
from quillsieve.functions.wordlists import ALLOWED_HINTS, BLOCKED_PATHS, DEVELOPER_PATHS, PAGE_KINDS, PAGED_HOSTS, PUBLISHERS, ROOT_SOURCES

_URL = r"^(?i)([a-z][a-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:]*)(:\d*)?([^?#]*)(\?[^#]*)?(#.*)?$"


def part(c: Column, group: int) -> Column:
    return F.regexp_extract(text(c), _URL, group)


def host(c: Column) -> Column:
    return F.lower(part(c, 2))


def bare_host(c: Column) -> Column:
    return F.regexp_replace(host(c), "^www[.]", "")


def path(c: Column) -> Column:
    """Path of a URL; ``/`` if it has none."""
    return F.when(part(c, 4) == "", F.lit("/")).otherwise(part(c, 4))


def bare_path(c: Column) -> Column:
    return F.regexp_replace(path(c), "/+$", "")


def is_http(c: Column) -> Column:
    return text(c).rlike(r"^(?i)https?://[^/?#\s]+")


def is_feed(c: Column) -> Column:
    p, q = F.lower(path(c)), F.lower(part(c, 5))
    return (host(c) != "") & (p.rlike(r"[.](?:xml|rss|atom)$") | p.rlike(r"(?:^|/)(?:rss|feeds?|atom)(?:/|$)") | q.rlike(r"[?&](?:output|format)=(?:rss|xml|atom)(?![A-Za-z0-9_])"))


def canonical(c: Column) -> Column:
    """Lower-case URL without query and fragment, default port and dot segments left out."""
    scheme = F.lower(part(c, 1))
    port = F.when((scheme == "https") & (part(c, 3) == ":443") | (scheme == "http") & (part(c, 3) == ":80") | (part(c, 3) == ":"), F.lit("")).otherwise(part(c, 3))
    return F.lower(F.concat(scheme, F.lit("://"), host(c), port, path(c)))


def sha(c: Column) -> Column:
    return F.sha2(c, 256)


def url_id(link: Column) -> Column:
    raw = text(link)
    return F.when(raw == "", F.lit("")).when(host(raw) != "", sha(canonical(raw))).otherwise(sha(F.lower(raw)))


def absolute(value: Column, base: Column) -> Column:
    """The http(s) URL that ``value`` means on page ``base``; else empty.

    Covers absolute, scheme-relative, rooted, query, fragment and relative references with dot
    segments.
    """
    v, b = trim(text(value)), text(base)
    root = F.concat(F.lower(part(b, 1)), F.lit("://"), host(b), part(b, 3))
    folder = F.regexp_replace(path(b), "[^/]*$", "")
    joined = (
        F.when(v.rlike(r"^(?i)[a-z][a-z0-9+.-]*:"), v)
        .when(v.startswith("//"), F.concat(F.lower(part(b, 1)), F.lit(":"), v))
        .when(v.startswith("/"), F.concat(root, v))
        .when(v.startswith("?"), F.concat(root, path(b), v))
        .when(v.startswith("#"), F.concat(root, path(b), part(b, 5), v))
        .otherwise(F.concat(root, folder, v))
    )
    dots = F.regexp_replace(part(joined, 4), r"/(?:[.]/)+", "/")
    for _ in range(6):
        dots = F.regexp_replace(dots, r"/(?!\.\./)[^/]+/\.\.(?=/|$)", "")
    dots = F.regexp_replace(F.regexp_replace(dots, r"^(?:/\.\.)+(?=/|$)", ""), r"/\.$", "/")
    clean = F.concat(F.lower(part(joined, 1)), F.lit("://"), host(joined), part(joined, 3), F.when(dots == "", F.lit("/")).otherwise(dots), part(joined, 5), part(joined, 6))
    return F.when((v != "") & is_http(joined), clean).otherwise(F.lit(""))


def publisher(link: Column, page_title: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in PUBLISHERS.items() for x in pair])
    return F.coalesce(F.try_element_at(names, bare_host(link)), F.nullif(trim(F.substring_index(strip_html(page_title), "|", 1)), F.lit("")), bare_host(link))


def favicon(link: Column) -> Column:
    return F.concat(F.lit("https://www.google.com/s2/favicons?domain="), F.url_encode(host(link)), F.lit("&sz=128"))


def source_kind(c: Column) -> Column:
    """Which kind of scan a source URL takes."""
    official = F.lit(False)
    for name, place in DEVELOPER_PATHS.items():
        official = official | ((bare_host(c) == name) & (F.when(bare_path(c) == "", F.lit("/")).otherwise(bare_path(c)) == place))
    return (
        F.when(bare_host(c) == "hsvphry.org.in", "notices")
        .when((bare_host(c) == "bptp.com") & (bare_path(c) == "/media"), "embedded")
        .when(official, "official")
        .when(is_feed(c), "feed")
        .otherwise("page")
    )


def page_urls(c: Column, pages: int = 15) -> Column:
    """The URLs of a source's pages, itself first."""
    base, h, root = bare_path(c), host(c), F.concat(F.lower(part(c, 1)), F.lit("://"), host(c), part(c, 3))
    tag = (h == "realty.economictimes.indiatimes.com") & base.startswith("/tag/")
    dash = (h == "www.hindustantimes.com") & (base.isin("/real-estate", "/cities/noida-news") | base.startswith("/topic/"))
    slash = (h == "indianexpress.com") & base.startswith("/about/") | h.isin(PAGED_HOSTS)
    tail = lambda n: F.when(tag, F.concat(F.lit("/"), n)).when(dash, F.concat(F.lit("/page-"), n)).otherwise(F.concat(F.lit("/page/"), n, F.lit("/")))
    more = F.transform(F.sequence(F.lit(2), F.lit(max(2, pages))), lambda n: F.concat(root, base, tail(n.cast("string")), part(c, 5), part(c, 6)))
    return F.when((tag | dash | slash) & F.lit(pages > 1), F.concat(F.array(text(c)), more)).otherwise(F.array(text(c)))


def variants(c: Column) -> Column:
    """URLs under which an article can be had, to be tried in this order."""
    h, p, q = bare_host(c), path(c), part(c, 5)
    amp = F.regexp_replace(p, "(?i)/articleshow/", "/amp_articleshow/")
    full = F.regexp_replace(p, "(?i)/amp_articleshow/", "/articleshow/")
    mobile, desk = F.lit("https://m.economictimes.com"), F.lit("https://economictimes.indiatimes.com")
    more = F.array(
        F.when(h == "economictimes.indiatimes.com", F.concat(mobile, p, q)),
        F.when((h == "economictimes.indiatimes.com") & (amp != p), F.concat(mobile, amp, q)),
        F.when((h == "m.economictimes.com") & (full != p), F.concat(desk, full, q)),
    )
    return F.array_distinct(F.array_compact(F.concat(F.array(text(c)), more)))


def page_kind(c: Column, fallback: Column) -> Column:
    p = F.lower(path(c))
    out = None
    for pattern, kind in PAGE_KINDS:
        out = F.when(p.rlike(pattern), kind) if out is None else out.when(p.rlike(pattern), kind)
    return out.otherwise(fallback)


def is_dynamic(c: Column, original_path: Column) -> Column:
    p = F.lower(path(c))
    has = lambda words: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(p, w))
    return F.when(p.rlike(r"[.](?:pdf|jpg|jpeg|png|webp|gif|svg|zip|docx?|xlsx?)$") | has(BLOCKED_PATHS), False).when(p == "/", original_path == "/").otherwise(has(ALLOWED_HINTS))


def is_root_source(category: Column, name: Column, kind: Column) -> Column:
    return (category == "Local News") | name.isin(ROOT_SOURCES) | ((name == "HSVP") & (kind == "Announcement"))


def normalized(c: Column) -> Column:
    """URL without fragment and without slashes at the end of its path."""
    short = F.when(bare_path(c) == "", F.lit("/")).otherwise(bare_path(c))
    return F.concat(F.lower(part(c, 1)), F.lit("://"), host(c), part(c, 3), short, part(c, 5))


def logo(links: list[Column], source: Column) -> Column:
    return first_of(*[absolute(x, source) for x in links], favicon(source))
