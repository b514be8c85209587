"""Scalar and text functions, as Column expressions that stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sentence ends: Chinese, other languages, and both (sliding windows).
ENDS = {"zh": "[。！？；]+", "en": "[.!?]+", "mixed": "[.!?。！？]+"}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once a row however often body uses it."""
    return F.transform(F.array(value), body)[0]


def word_count_sql(text: Column) -> Column:
    """Pieces between single spaces, empty ones included."""
    return F.size(F.split(text, " "))


def words(text: Column) -> Column:
    """Words between runs of Unicode white space."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def word_count_ws(text: Column) -> Column:
    return F.size(words(text))


def content_hash(content: Column) -> Column:
    return F.when(content != "", F.md5(content))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def sentences(text: Column, language: str = "en", collapse: bool = True) -> Column:
    """Stripped non-empty sentences without their ends; white space collapsed unless told otherwise."""
    ends = ENDS["zh" if language == "zh" else language if language in ENDS else "en"]
    if collapse:  # in the whole text, at once; single blanks stay as they are
        parts = F.transform(F.split(F.regexp_replace(text, r"(?U)[\s&&[^ ]]\s*| \s+", " "), ends), lambda s: F.trim(s))
    else:
        parts = F.transform(F.split(text, ends), strip)
    return F.filter(parts, lambda s: s != "")


def paragraphs(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n\n"), strip), lambda p: p != "")


def join_sentences(parts: Column, language: str = "en") -> Column:
    return F.array_join(parts, "" if language == "zh" else " ")


def domain(url: Column) -> Column:
    """Authority of a URL, with user and port."""
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)


def url_path(url: Column) -> Column:
    path = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.when(path == "", "/").otherwise(path)


def normalized_base(host: Column) -> Column:
    """Base address of a host or URL; https unless a scheme is given."""
    return F.when(host.startswith("http"), host).otherwise(F.concat(F.lit("https://"), host))


def title(html: Column) -> Column:
    return F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def iso_timestamp(text: Column) -> Column:
    """ISO 8601 time; null if it is none."""
    return F.try_to_timestamp(text)


def is_sitemap(url: Column) -> Column:
    """Whether a listed address is itself a sitemap."""
    return F.lower(url).endswith(".xml") | F.lower(url_path(url)).contains("sitemap")


def looks_like_sitemap(content_type: Column, body: Column) -> Column:
    return F.lower(content_type).contains("xml") & (body.contains("<urlset") | body.contains("<sitemapindex"))


def pretty_size(size: Column) -> Column:
    """Bytes as text in the largest unit below which fewer than 10240 are left."""
    out = F.concat(size.cast("string"), F.lit(" bytes"))
    for n, unit in enumerate(("kB", "MB", "GB", "TB"), 1):
        out = F.when(size >= 10240 * 1024 ** (n - 1), F.concat(F.round(size / 1024**n).cast("long").cast("string"), F.lit(f" {unit}"))).otherwise(out)
    return out


def quote_ident(name: Column) -> Column:
    """A name as it stands in SQL: bare if it is lower-case letters, digits and underscores, else in double quotes."""
    return F.when(name.rlike("^[a-z_][a-z0-9_]*$"), name).otherwise(F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"')))


def iso_format(at: Column) -> Column:
    """A time in UTC as ISO 8601 text with its offset; microseconds only where there are any."""
    micros = F.date_format(at, "SSSSSS")
    return F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)), F.lit("+00:00"))
