"""Text expressions. All of them are built-in Spark expressions and stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from weirgate import constants as C

#: Every code point that counts as white space in the data model (Java's ``\s`` misses most of them).
SPACE = r"[\s\p{Z}\x0b\x1c-\x1f\x{85}]"
#: The same code points one by one, for trimming without a pattern.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
#: White space that may lead a line, including the zero-width marks.
LINE_LEAD = (
    r"(?m)^[ \t\x{00A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}\x{FEFF}\x{200B}-\x{200D}\x{2060}]+"
)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(value: Column | str) -> Column:
    """Trim every kind of white space at both ends."""
    return F.btrim(_col(value), F.lit(SPACE_CHARS))


def collapse_space(value: Column | str) -> Column:
    """One blank for each run of white space, none at the ends."""
    return F.trim(F.regexp_replace(_col(value), rf"{SPACE}+", " "))


def normalize_title(value: Column | str) -> Column:
    """Lower-case title with collapsed white space, for comparison (H5)."""
    return F.lower(collapse_space(value))


def not_blank(value: Column | str) -> Column:
    """True when the text is neither null nor empty."""
    return F.coalesce(_col(value) != "", F.lit(False))


def clean_text(value: Column | str) -> Column:
    """Unix line ends, no leading space on any line, trimmed (H14). Null becomes the empty text."""
    text = F.coalesce(_col(value).cast("string"), F.lit(""))
    unix = F.when(F.contains(text, F.lit("\r")), F.regexp_replace(text, r"\r\n?", "\n")).otherwise(text)
    return strip(F.regexp_replace(unix, LINE_LEAD, ""))


def escape_html3(value: Column | str) -> Column:
    """Escape ``& < >`` (H8); null becomes the empty text."""
    text = F.coalesce(_col(value).cast("string"), F.lit(""))
    for plain, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def escape_html5(value: Column | str) -> Column:
    """Escape ``& < > " '`` (H8)."""
    text = escape_html3(value)
    for plain, escaped in (('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def mask_email(value: Column | str) -> Column:
    """Keep at most two characters before the ``@`` (H7)."""
    return F.regexp_replace(_col(value), r"\A(.{0,2})[^@]*@", "$1***@")


def redact_secrets(value: Column | str, style: str = "key") -> Column:
    """Redact an error text (H9).

    ``key`` hides ``sk-...`` keys and cuts at 1500 characters; ``bearer`` hides the value after a bearer, API key
    or token marker, trims and cuts at 500.
    """
    text = _col(value)
    if style == "key":
        return F.substring(F.regexp_replace(text, r"sk-[A-Za-z0-9_-]+", "[REDACTED]"), 1, 1500)
    if style == "bearer":
        hidden = F.regexp_replace(
            text, r"(?i)(bearer\s+|api[_-]?key[=:]\s*|token[=:]\s*)[^\s,;]+", "$1[REDACTED]"
        )
        return F.substring(strip(hidden), 1, 500)
    raise ValueError(f"unknown redaction style: {style}")


def error_summary(value: Column | str) -> Column:
    """Trimmed summary, blank becomes null, at most 500 characters."""
    return F.substring(F.nullif(strip(value), F.lit("")), 1, 500)


def header_is_safe(value: Column | str) -> Column:
    """True when a stored response header has no control character (H19); null is safe."""
    return ~F.coalesce(F.rlike(_col(value), F.lit(r"[\x00-\x1f\x7f]")), F.lit(False))


def or_default(value: Column | str, default: str) -> Column:
    """The text, or ``default`` when it is null or empty."""
    return F.coalesce(F.nullif(_col(value).cast("string"), F.lit("")), F.lit(default))


def short_hash(value: Column | str, length: int = 12) -> Column:
    """First characters of a hash with an ellipsis (H20); ``unknown`` when there is none."""
    return F.concat(or_default(F.substring(_col(value), 1, length), "unknown"), F.lit("…"))


def first_name(value: Column | str) -> Column:
    """First word of a full name."""
    return F.element_at(F.split(collapse_space(value), " "), 1)


def last_name(value: Column | str) -> Column:
    """Everything after the first word of a full name."""
    words = F.split(collapse_space(value), " ")
    return F.array_join(F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), " ")


def is_tracking_param(name: Column | str) -> Column:
    """True for query parameters that only track (H2)."""
    lowered = F.lower(_col(name))
    return lowered.startswith("utm_") | lowered.isin(*C.TRACKING_PARAMETERS)


def strip_tracking(url: Column | str) -> Column:
    """Canonical form of a plain ASCII https URL without escapes, in built-in expressions (ASCII part of H1).

    Null unless the scheme is https. For any other URL use ``functions.urls.canonicalize_url``, which is exact.
    """
    raw = strip(url)
    shape = r"\A(?i:https)://([^/?#@]+)([^?#]*)(?:\?([^#]*))?(?:#.*)?\z"
    host = F.regexp_replace(F.lower(F.regexp_extract(raw, shape, 1)), r"(?::443)?\z", "")
    path = F.regexp_extract(raw, shape, 2)
    pairs = F.filter(F.split(F.regexp_extract(raw, shape, 3), "&"), lambda pair: pair != "")
    pairs = F.filter(pairs, lambda pair: ~is_tracking_param(F.substring_index(pair, "=", 1)))
    pairs = F.array_sort(F.transform(
        pairs, lambda pair: F.struct(F.substring_index(pair, "=", 1).alias("k"),
                                     F.regexp_replace(pair, r"\A[^=]*=?", "").alias("v"))))
    query = F.array_join(F.transform(pairs, lambda pair: F.concat(pair["k"], F.lit("="), pair["v"])), "&")
    return F.when(
        F.rlike(raw, F.lit(shape)),
        F.concat(F.lit("https://"), host, F.when(path == "", "/").otherwise(path),
                 F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))),
    )


#: Entities the built-in variant decodes before the ampersand.
BASIC_ENTITIES = (
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"),
    ("&copy;", "©"), ("&middot;", "·"), ("&mdash;", "—"), ("&ndash;", "–"), ("&hellip;", "…"),
)
#: The ampersand comes last, so nothing is decoded twice; its semicolon may be missing.
AMPERSAND = "&amp;?"


def sanitize_markup(value: Column | str, maximum: int = C.ARTICLE_TEXT_MAX) -> Column:
    """Text of an HTML fragment in built-in expressions: regex form of H4 with the basic entities only.

    ``functions.html.sanitize_html`` is the exact form with a real tokenizer and all entities.
    """
    text = F.regexp_replace(_col(value), r"(?is)<(script|style)\b.*?</(script|style)\s*>|<!--.*?-->|<[^>]*>", "")
    for escaped, plain in BASIC_ENTITIES:
        text = F.replace(text, F.lit(escaped), F.lit(plain))
    text = F.regexp_replace(text, AMPERSAND, "&")
    return F.rtrim(F.substring(collapse_space(text), 1, maximum))


def count_keywords(text: Column, keywords: tuple[str, ...]) -> Column:
    """How many of the keywords occur in the text as substrings."""
    hits = F.lit(0)
    for keyword in keywords:
        hits = hits + F.contains(text, F.lit(keyword)).cast("int")
    return hits


def keyword_share(text: Column, keywords: tuple[str, ...]) -> Column:
    """Share of the keywords that occur, at most 1."""
    if not keywords:
        return F.lit(0.0)
    return F.least(F.lit(1.0), count_keywords(text, keywords).cast("double") / F.lit(float(len(keywords))))
