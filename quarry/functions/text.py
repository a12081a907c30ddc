"""Scalar text functions as Column expressions; nothing here leaves the JVM.

Patterns are in Java's dialect with (?U), so that classes such as \\w and \\s cover all scripts and spaces.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WS = r"(?U)\s+"
_BOILER = "(?U)[\\s\\d|·.,()（）\\[\\]【】'\"~\\-–—]+"


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def tokens(c: Column) -> Column:
    """Estimated number of tokens: six tenths of the characters, rounded down."""
    return F.floor(F.length(c) * 6 / F.lit(10)).cast("int")


def chunk_key(*parts: Column) -> Column:
    """24 hexadecimal digits of the SHA-256 of the parts, joined by colons; a null part is empty."""
    return F.substring(F.sha2(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256), 1, 24)


def file_digest(content: Column) -> Column:
    return F.sha2(content, 256)


def double_spaces(md: Column) -> Column:
    """Runs of two blanks or more."""
    return F.regexp_count(md, F.lit("  +"))


def dense(c: Column) -> Column:
    """Without white space."""
    return F.regexp_replace(c, _WS, "")


def squeeze(c: Column) -> Column:
    return strip(F.regexp_replace(c, _WS, " "))


def boilerplate_key(c: Column, size: int = 300) -> Column:
    """First characters of the text after its first two lines, without spaces, digits and common punctuation."""
    lines = F.split(c, "\n")
    body = F.array_join(F.slice(lines, 3, F.greatest(F.size(lines) - 2, F.lit(1))), "\n")
    return F.substring(F.regexp_replace(body, _BOILER, ""), 1, size)


def integrity_norm(c: Column) -> Column:
    """For comparing a text with its source: no spaces, bars or dashes; digits stay."""
    return F.regexp_replace(c, r"(?U)[\s|·\-–—]+", "")


def toc_norm(c: Column) -> Column:
    """A title without a bullet, a number and white space."""
    return dense(F.regexp_replace(strip(c), r"(?U)^(?:[-–—∙·▪]\s*)?(?:\d{1,3}(?:-\d{1,3})?\s*[.)]?\s*)?", ""))


def boundary_norm(c: Column) -> Column:
    """A title without its number and white space, for comparing detected with declared ones."""
    return dense(F.regexp_replace(strip(c), r"^\d+\.\s*", ""))


def probe_norm(c: Column) -> Column:
    """For looking up pieces of a source in its chunks: without white space, bars, dots, brackets and quotes; digits stay."""
    return F.regexp_replace(c, "(?U)[\\s|․·⋅‧,.\\-()\\[\\]【】〔〕:;'\"]+", "")


_HEADER_LINE = r"(?U)^(?:\[.*\]|제\s*\d+\s*조\([^)]*\)|【[^】]*】.*|별표\s*\d+\s*.*)$"


def body_of(content: Column) -> Column:
    """A chunk's text without its prefix line, where that has bars but is no row of a table, and the header lines after it; the whole where nothing is left."""
    ls = F.split(content, "\n")
    first = F.get(ls, F.lit(0))
    skip = (F.contains(first, F.lit(" | ")) & ~F.rlike(first, F.lit(r"^\s*\|"))).cast("int")
    rest = F.slice(ls, skip + 1, F.greatest(F.size(ls) - skip, F.lit(0)))
    at = F.array_position(F.transform(rest, lambda x: F.rlike(strip(x), F.lit(_HEADER_LINE))), False).cast("int")
    body = strip(F.array_join(F.when(at > 0, F.slice(rest, at, F.size(rest))).otherwise(F.array().cast("array<string>")), "\n"))
    return F.when(body == "", content).otherwise(body)


def section_kind(section: Column) -> Column:
    """별표, 특별약관 or 보통약관, by what a section's label says."""
    return F.when(F.startswith(section, F.lit("별표")) | F.contains(section, F.lit("분류표")), "별표").when(F.contains(section, F.lit("특별약관")) | F.contains(section, F.lit("특약")), "특별약관").otherwise("보통약관")


def cache_name(base: str, question_set: str, variant: str = "", default: str = "questions") -> str:
    """Name of a cache: the base, the question set unless it is the default one, and the variant."""
    return "_".join([base, *([] if question_set == default else [question_set]), *([variant] if variant else [])])


def strip_fences(c: Column) -> Column:
    """Without the marks of a fenced code block around it."""
    return strip(F.regexp_replace(c, r"(?m)^\s*```[A-Za-z]*\s*$", ""))


def hangul_digits(c: Column) -> Column:
    """Number of Hangul syllables and digits."""
    return F.length(F.regexp_replace(c, "[^가-힣0-9]", ""))


def head3(vector: Column) -> Column:
    return F.slice(vector, 1, 3)


def variant(struct: str, field: str, question: Column) -> Column:
    """A variant of a question, or the question itself where it is missing."""
    return F.coalesce(F.col(f"{struct}.{field}"), question)


def first_word(c: Column, sep: str = " | ") -> Column:
    """The second part of a prefix line, where the product stands."""
    return F.try_element_at(F.split(F.try_element_at(F.split(c, "\n"), F.lit(1)), r" \| "), F.lit(2))


ARTICLE = r"제\s*(\d+)\s*조(?:의\s*\d+)?\s*"
TITLE = r"(?:[(（]((?:[^()（）]|[(（][^()（）]{0,40}[)）]){1,80})[)）]|【([^】]{1,60})】|\[([^\]]{1,80})\])"


def article_no(line: Column) -> Column:
    """Number of the article whose heading begins the line, or null."""
    m = F.regexp_extract(line, "(?U)^" + ARTICLE + TITLE, 1)
    return F.when(m != "", m.cast("int"))


def article_title(line: Column) -> Column:
    """Title of the article whose heading begins the line, nested brackets kept; white space is squeezed."""
    p = "(?U)^" + ARTICLE + TITLE
    t = F.concat(F.regexp_extract(line, p, 2), F.regexp_extract(line, p, 3), F.regexp_extract(line, p, 4))
    return F.when(t != "", squeeze(t))


def first_match(c: Column, rules: list[tuple[str, list[str]]], default: str) -> Column:
    """The class of the first rule of which the text contains a word."""
    out = None
    for name, words in rules:
        for w in words:
            out = F.when(F.contains(c, F.lit(w)), name) if out is None else out.when(F.contains(c, F.lit(w)), name)
    return F.lit(default) if out is None else out.otherwise(default)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors of doubles; null if either has no length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))
