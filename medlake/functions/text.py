"""Report text cleaning as one chain of native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# They decide which characters survive and which words are upper-cased.
MIN_CLEAN_LENGTH = 50
STRIPPED = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
NON_PRINTABLE = r"[^\x20-\x7E\n\t]"
HEADERS = [
    (r"\bCLINICAL\s+INDICATION\b", "CLINICAL INDICATION"),
    (r"\bINDICATION\b", "INDICATION"),
    (r"\bFINDINGS?\b", "FINDINGS"),
    (r"\bIMPRESSION\b", "IMPRESSION"),
    (r"\bCONCLUSION\b", "CONCLUSION"),
]
SMART_FROM = "\u2018\u2019\u201c\u201d\u2014\u2013"
SMART_TO = "''\"\"--"
ELLIPSIS = "\u2026"


def normalise_newlines(text: Column) -> Column:
    return F.regexp_replace(text, r"\r\n?", "\n")


def collapse_blanks(text: Column) -> Column:
    return F.regexp_replace(text, r"[ \t]+", " ")


def drop_line_end_blanks(text: Column) -> Column:
    """Blanks before a newline go; blanks at the start of a line stay."""
    return F.regexp_replace(text, r" +\n", "\n")


def collapse_empty_lines(text: Column) -> Column:
    return F.regexp_replace(text, r"\n{3,}", "\n\n")


def strip_unicode(text: Column) -> Column:
    """Strip every kind of Unicode white space, not only U+0020.

    A trim looks at the two ends only; a regular expression would scan the whole text.
    """
    return F.btrim(text, F.lit(STRIPPED))


def keep_printable_ascii(text: Column) -> Column:
    return F.regexp_replace(text, NON_PRINTABLE, "")


def plain_punctuation(text: Column) -> Column:
    """Typographic quotes, dashes and the ellipsis as ASCII."""
    return F.replace(F.translate(text, SMART_FROM, SMART_TO), F.lit(ELLIPSIS), F.lit("..."))


def uppercase_headers(text: Column) -> Column:
    """Section words in capitals wherever they occur, in prose as well."""
    for pattern, replacement in HEADERS:
        text = F.regexp_replace(text, f"(?i){pattern}", replacement)
    return text


def clean_text(text: Column, punctuation: str = "reference") -> Column:
    """The whole cleaning chain; null becomes the empty string.

    ``punctuation="reference"`` deletes typographic characters with all other non-ASCII
    ones; ``"preserve"`` turns them into their ASCII form first.
    """
    if punctuation not in ("reference", "preserve"):
        raise ValueError("punctuation must be 'reference' or 'preserve'")
    out = F.coalesce(text, F.lit(""))
    for step in (
        normalise_newlines,
        collapse_blanks,
        drop_line_end_blanks,
        collapse_empty_lines,
        strip_unicode,
    ):
        out = step(out)
    if punctuation == "preserve":
        out = plain_punctuation(out)
    return uppercase_headers(keep_printable_ascii(out))


def long_enough(clean: Column, minimum: int = MIN_CLEAN_LENGTH) -> Column:
    return F.length(clean) >= minimum


def collapse_space(text: Column) -> Column:
    """Every run of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def decode_bytes(content: Column) -> Column:
    """UTF-8 text, or Latin-1 text where the bytes are not valid UTF-8."""
    return F.coalesce(
        F.try_validate_utf8(content.cast("string")), F.decode(content, "ISO-8859-1")
    )
