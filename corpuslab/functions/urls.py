"""URL column expressions: canonical form, reasons, type, file stem."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS, strip_ws

SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*):(//)?([^/?#]*)([^?#]*)(\?([^#]*))?(#.*)?$"

# Hosts and suffixes that are never fetched as documents.
UNSUPPORTED_HOSTS = ["instagram.com", "twitter.com", "x.com", "youtu.be", "youtube.com"]
NON_DOCUMENT_SUFFIXES = [
    "avi", "css", "gif", "gz", "jpeg", "jpg", "js", "json", "mov",
    "mp3", "mp4", "png", "svg", "tar", "webm", "webp", "zip",
]
CONTENT_TYPES = ["pdf", "html", "markdown", "text", "unknown"]
RAW_SUFFIX = {"pdf": ".pdf", "html": ".html", "markdown": ".md", "text": ".txt"}

MAX_STEM_BYTES = 240
HASH_LENGTH = 16


def embedded_url(line: Column) -> Column:
    """The URL of an inbox line, which may carry a ``Category->Sub:`` prefix."""
    tail = F.regexp_extract(line, r"^.*?:(http.*)$", 1)
    return F.when(line.startswith("http"), line).when(tail != "", tail).otherwise(line)


def full_url(raw: Column) -> Column:
    """Trimmed URL with ``http://`` in front where it has no scheme."""
    url = strip_ws(raw)
    return F.when(url.rlike(SCHEME), url).otherwise(F.concat(F.lit("http://"), url))


def url_parts(full: Column) -> Column:
    """Array of scheme, slashes, authority, path, query; one match per URL."""
    return F.split(F.regexp_replace(full, PARTS, "$1\u0001$2\u0001$3\u0001$4\u0001$6"), "\u0001")


def host_of(server: Column) -> Column:
    bracketed = F.regexp_extract(server, r"^\[([^\]]*)\]", 1)
    return F.lower(F.when(server.startswith("["), bracketed).otherwise(F.regexp_extract(server, "^([^:]*)", 1)))


def port_of(server: Column) -> Column:
    return F.regexp_extract(server, r"^(?:\[[^\]]*\]|[^:\[]*):(.*)$", 1)


def refusal(url: Column, scheme: Column, host: Column, port: Column) -> Column:
    """Why a URL cannot be used, in a fixed order of checks; null if it can."""
    number = F.coalesce(port.try_cast("int"), F.lit(65536))
    port_ok = (port == "") | (port.rlike("^[0-9]+$") & (number <= 65535))
    return (
        F.when(url == "", F.lit("empty URL"))
        .when(url.rlike(WS), F.lit("URL contains whitespace"))
        .when(~scheme.isin("http", "https"), F.concat(F.lit("unsupported URL scheme: "), scheme))
        .when(host == "", F.lit("URL is missing a host"))
        .when((host != "localhost") & ~F.contains(host, F.lit(".")), F.lit("URL host is not valid"))
        .when(~port_ok, F.lit("URL port is not valid"))
    )


def assemble(scheme: Column, host: Column, port: Column, path: Column, query: Column) -> Column:
    """Canonical URL of checked parts: port without leading zeros, a bare ``/``
    dropped, paper abstracts turned into their PDF."""
    authority = F.when(port == "", host).otherwise(F.concat(host, F.lit(":"), port.try_cast("int").cast("string")))
    is_arxiv = host.isin("arxiv.org", "www.arxiv.org")
    paper = F.regexp_replace(F.substring(path, 6, 1 << 30), "/+$", "")
    to_pdf = is_arxiv & (path.startswith("/abs/") | (path.startswith("/pdf/") & ~F.lower(path).endswith(".pdf")))
    new_path = (
        F.when(to_pdf, F.concat(F.lit("/pdf/"), paper, F.lit(".pdf"))).when(path == "/", F.lit("")).otherwise(path)
    )
    tail = F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query))
    return F.concat(scheme, F.lit("://"), F.when(is_arxiv, F.lit("arxiv.org")).otherwise(authority), new_path, tail)


def content_type(normalized_url: Column) -> Column:
    """Type by host block list, then by the suffix of the path."""
    host = F.regexp_extract(normalized_url, r"^https?://(?:www\.)?([^/?#:]*)", 1)
    path = F.lower(F.regexp_extract(normalized_url, r"^https?://[^/?#]*([^?#]*)", 1))
    suffix = F.regexp_extract(path, r"\.([^./]*)$", 1)
    return (
        F.when(host.isin(UNSUPPORTED_HOSTS), F.lit("unknown"))
        .when(suffix == "pdf", F.lit("pdf"))
        .when(suffix.isin("html", "htm"), F.lit("html"))
        .when(suffix == "md", F.lit("markdown"))
        .when(suffix == "txt", F.lit("text"))
        .when(suffix.isin(NON_DOCUMENT_SUFFIXES), F.lit("unknown"))
        .otherwise(F.lit("html"))
    )


def file_stem(normalized_url: Column) -> Column:
    """File-safe stem; long ones are cut and closed with a digest prefix."""
    safe = F.regexp_replace(F.replace(normalized_url, F.lit("://"), F.lit("__")), "[^A-Za-z0-9_-]", "_")
    stem = F.regexp_replace(F.regexp_replace(safe, "_+", "_"), "^_+|_+$", "")
    digest = F.substring(F.sha2(normalized_url, 256), 1, HASH_LENGTH)
    cut = F.regexp_replace(F.substring(stem, 1, MAX_STEM_BYTES - HASH_LENGTH - 1), "_+$", "")
    return F.when(F.octet_length(stem) <= MAX_STEM_BYTES, stem).otherwise(F.concat(cut, F.lit("_"), digest))


def with_timestamp(url: Column, seconds: Column) -> Column:
    sep = F.when(F.contains(url, F.lit("?")), F.lit("&")).otherwise(F.lit("?"))
    return F.concat(url, sep, F.lit("t="), seconds.cast("string"))
