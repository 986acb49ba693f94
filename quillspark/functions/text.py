"""Text and identifier functions as column expressions.

Java's ``\\s`` is ASCII only; :data:`SPACE` matches what Unicode calls white space, and the four separators that
``(?U)`` leaves out. Missing strings are empty strings here, as everywhere in the corpus tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"(?U)[\s\x1C-\x1F]+"
#: Such white space as isn't a single blank already.
_ODD_SPACE = r"(?U)[\s\x1C-\x1F](?:[\s\x1C-\x1F]+|(?<! ))"
CJK = r"㐀-䶿一-鿿"
#: A word of Latin letters or digits, perhaps hyphenated, or one ideograph.
WORD = r"[A-Za-z0-9]+(?:[-'][A-Za-z0-9]+)?|[一-鿿]"
UNIT = rf"[{CJK}]|[A-Za-z0-9]+(?:[-'][A-Za-z0-9]+)?"


def col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: str | Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is evaluated once, however often body names it: the optimiser may inline a column into a lambda."""
    return F.get(F.transform(F.array(col(value)), body), F.lit(0))


def swap(x: Column, signs: str, by: str) -> Column:
    """x with each of some signs replaced: ``translate`` for few signs, without its look at every character."""
    for a, b in zip(signs, by, strict=True):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def given(x: str | Column) -> Column:
    """The string, empty for null."""
    return F.coalesce(col(x).cast("string"), F.lit(""))


def is_falsy(x: str | Column, kind: str = "string") -> Column:
    """Null, empty, zero or an empty list: what counts as missing in validation."""
    c = col(x)
    if kind.startswith("array"):
        return c.isNull() | (F.size(c) == 0)
    if kind in ("int", "bigint", "double"):
        return c.isNull() | (c == 0)
    return c.isNull() | (c == "")


def strip(x: str | Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(given(x), r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$", "")


def unspaced(x: str | Column) -> Column:
    """Without any white space; blanks, the most of it, go without a search for a pattern."""
    return F.regexp_replace(F.replace(given(x), F.lit(" "), F.lit("")), SPACE, "")


def fold(x: str | Column) -> Column:
    """All white space to single blanks, none at the ends."""
    return F.trim(F.regexp_replace(given(x), _ODD_SPACE, " "))


def normalize(x: str | Column) -> Column:
    """Folded lower case with every dash as a hyphen: the form that word terms are matched in."""
    return swap(fold(F.lower(given(x))), "‐‑–—", "----")


def normalize_dense(x: str | Column) -> Column:
    """Lower case, hyphens for dashes, no white space at all: the form that substring terms are matched in."""
    return unspaced(swap(F.lower(given(x)), "‐‑–—", "----"))


def fold_cjk(x: str | Column) -> Column:
    """Folded text without blanks between ideographs."""
    plain = F.trim(F.regexp_replace(swap(given(x), "\u00a0\u3000", "  "), r"[ \t\r\n](?:[ \t\r\n]+|(?<! ))", " "))
    return F.regexp_replace(plain, rf"(?U)\s(?<=[{CJK}]\s)\s*+(?=[{CJK}])", "")


def ideograph(x: Column) -> Column:
    """Whether a string of one character is an ideograph of :data:`CJK`."""
    low, last, first, high = CJK[0], CJK[2], CJK[3], CJK[5]
    return (x >= low) & (x <= high) & ~((x > last) & (x < first))


def normalize_line(x: str | Column) -> Column:
    """One line of a page: odd blanks and NULs gone, runs of blanks as one."""
    return F.trim(F.regexp_replace(F.replace(swap(given(x), "\u00a0\u3000", "  "), F.lit("\x00"), F.lit("")), r"[ \t](?:[ \t]+|(?<! ))", " "))


def normalize_page(x: str | Column) -> Column:
    """A page with its lines normalised and runs of blank lines as one."""
    lines = F.transform(F.split(swap(given(x), "\r", "\n"), "\n", -1), normalize_line)
    return F.regexp_replace(F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n"), r"^\n+|\n+$", "")


def without_citations(x: str | Column) -> Column:
    """Numeric citations such as [3, 5-7] removed, then folded."""
    return fold(F.regexp_replace(given(x), r"(?U)\s*\[[\d,\-\s]*\]", ""))


def content_chars(x: str | Column) -> Column:
    return F.regexp_count(given(x), F.lit(rf"[A-Za-z0-9{CJK}]"))


def cjk_chars(x: str | Column) -> Column:
    return F.regexp_count(given(x), F.lit(rf"[{CJK}]"))


def private_use_chars(x: str | Column) -> Column:
    return F.regexp_count(given(x), F.lit("[\ue000-\uf8ff]"))


def visible_chars(x: str | Column) -> Column:
    return F.length(unspaced(x))


def word_count(x: str | Column) -> Column:
    return F.regexp_count(given(x), F.lit(WORD))


def unit_count(x: str | Column) -> Column:
    """Ideographs one by one, other words as one unit each."""
    return F.regexp_count(given(x), F.lit(UNIT))


def text_is_usable(x: str | Column, min_chars: int = 60, min_cjk: int = 20, max_private: int = 24, max_private_ratio: float = 0.015) -> Column:
    """Whether extracted page text is good enough to do without recognition."""
    private = private_use_chars(x)
    return (content_chars(x) >= min_chars) & (cjk_chars(x) >= min_cjk) & (private <= max_private) & (private / F.greatest(visible_chars(x), F.lit(1)) <= max_private_ratio)


def extraction_method(native: str | Column, ocr_mode: str = "auto", usable: Column | None = None) -> Column:
    """How a page's text is to be had: native_text, ocr or native_low_text."""
    if ocr_mode not in ("auto", "always", "never"):
        raise ValueError(f"unknown mode: {ocr_mode}")
    usable = text_is_usable(native) if usable is None else usable
    if ocr_mode == "always":
        return F.lit("ocr")
    return F.when(usable, "native_text").otherwise("ocr" if ocr_mode == "auto" else "native_low_text")


def header_key(x: str | Column) -> Column:
    """A line without white space and case, its numbers as #: equal for one header on many pages."""
    return F.regexp_replace(F.lower(unspaced(x)), r"(?U)(?:第)?\d+(?:页)?", "#")


def slug(x: str | Column, fallback: str, most: int = 80, pattern: str = r"[^A-Za-z0-9._-]+") -> Column:
    """Safe identifier part: other characters as _, none at the ends, cut, the fallback if nothing is left."""
    clean = F.substring(F.regexp_replace(F.regexp_replace(given(x), pattern, "_"), "^_+|_+$", ""), 1, most)
    return F.coalesce(F.nullif(clean, F.lit("")), F.lit(fallback))


def query_slug(x: str | Column, most: int = 60) -> Column:
    return slug(x, "rag_query", most, r"[^A-Za-z0-9一-鿿]+")


def article_key(x: str | Column) -> Column:
    """Central article number: trimmed, upper case, prefixed if it is digits alone."""
    v = F.upper(F.trim(given(x)))
    return F.when(v.rlike(r"^[0-9]+$"), F.concat(F.lit("PMC"), v)).otherwise(v)


def numeric_key(x: str | Column) -> Column:
    """The article number without its prefix."""
    return F.regexp_replace(article_key(x), "^PMC", "")


def sha_prefix(x: str | Column, n: int) -> Column:
    return F.upper(F.substring(F.sha1(given(x)), 1, n))


def document_key(stem: str | Column) -> Column:
    return F.concat(F.lit("CNKI-"), sha_prefix(stem, 12))


def section_key(section: str | Column) -> Column:
    return F.concat(F.lit("SEC-"), sha_prefix(section, 8))


def has_text(x: str | Column) -> Column:
    return fold(x) != ""


def citation_ids(x: str | Column) -> Column:
    """The distinct E-numbers cited in brackets, in order."""
    return F.array_distinct(F.regexp_extract_all(given(x), F.lit(r"\[(E[0-9]+)\]"), F.lit(1)))


def looks_like_article(content: str | Column) -> Column:
    """Whether the first 500 bytes of a file open an article or a set of articles."""
    head = F.lower(F.decode(F.substring(col(content), 1, 500), "ISO-8859-1"))
    return head.contains("<pmc-articleset") | head.contains("<article")


def split_pages(x: str | Column, page_count: str | Column) -> Column:
    """Form-feed separated text as exactly page_count normalised pages: padded, or the surplus joined to the last."""
    raw = F.split(given(x), "\f", -1)
    raw = F.when(fold(F.element_at(raw, -1)) == "", F.slice(raw, F.lit(1), F.size(raw) - 1)).otherwise(raw)
    pages, n = F.transform(raw, normalize_page), col(page_count).cast("int")
    padded = F.concat(pages, F.array_repeat(F.lit(""), F.greatest(n - F.size(pages), F.lit(0))))
    surplus = F.concat(F.slice(pages, F.lit(1), F.greatest(n - 1, F.lit(0))), F.array(F.array_join(F.slice(pages, F.greatest(n, F.lit(1)), F.size(pages)), "\n")))
    return F.when(F.size(pages) > n, surplus).otherwise(padded)
