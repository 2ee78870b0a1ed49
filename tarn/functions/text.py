"""Text rules as column expressions that stay in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarn.functions.bind import let
from tarn.functions.unicode import nfkc, unescape_html

# Every character that Unicode counts as white space, as one trim set.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set inside a regular-expression class.
SPACE = r"\s\p{Z}\x1c-\x1f\x85"

# Character classes of the cleaning rules.
CONTROL = r"[\x00-\x08\x0B-\x0C\x0E-\x1F\x7F]"
INLINE_SPACE = r" \t\u00A0\u2000-\u200B\u3000"
COMBINING = r"[\u0300-\u036F]+"
EMOJI = r"\x{1F300}-\x{1FAFF}\x{2700}-\x{27BF}"
NON_ASCII = r"[^\x00-\x7F]+"
SENTENCE_END = ".?!。！？"

# Anything but line feeds, printable ASCII and Latin-1 letters. Texts without such a character, which
# is most of them, need none of the rules for odd spaces, control characters and normal forms, and one
# scan tells. Spelled as what is odd: the engine tests that faster than the negated class.
ODD = r"[\x00-\x09\x0b-\x1f\x7f-\xbe\u0100-\x{10ffff}]"

# Line separators of a text.
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"

# Markdown image forms, in the order in which they are removed. UNIX_LINES keeps ^ and $
# at line feeds.
MARKDOWN_IMAGE_FORMS = (
    # wiki embeds
    r"!\[\[[^\]]+\]\]",
    # HTML images
    r"(?is)<img\b[^>]*>",
    # inline images with an optional title
    rf"!\[[^\]]*\]\([{SPACE}]*<?[^){SPACE}>]+[^)]*?>?[{SPACE}]*"
    rf"(?:\"[^\"]*\"|'[^']*'|\([^)]+\))?[{SPACE}]*\)",
    # reference images
    r"!\[[^\]]*\]\[[^\]]*\]",
    # reference definitions on one line
    rf"(?imd)^[{SPACE}]*\[[^\]]+\]:[{SPACE}]*(?:<[^>\n]+>|[^{SPACE}]+)"
    rf"(?:[{SPACE}]+(?:\"[^\"]*\"|'[^']*'|\([^)]+\)))?[{SPACE}]*$",
    # data-URI definitions, cut to the end of the text
    rf"(?ismd)^[{SPACE}]*\[[^\]]+\]:[{SPACE}]*<?[{SPACE}]*data:image[^>{SPACE}]*.*$",
)

# Rich-text rules of the plain fallback, in order.
RTF_FORMS = (
    (r"\\par[d]?", "\n\n"),
    (r"\{\\[^}]*\}", " "),
    (r"\\[a-zA-Z]+-?\d*", " "),
    (r"[{}]", " "),
)

# Elements whose text is no part of a page's text, with comments and declarations.
_HIDDEN_MARKUP = (
    r"(?is)<!--.*?-->|<(script|style|template|rt|rp)\b.*?</\1\s*>|<![^>]*>|<\?[^>]*>"
)
# Possessive, so that a long run of tags needs no recursion.
_TAG_RUN = r"(?:</?[a-zA-Z][^>]*+>)++"


def is_ascii(text: Column) -> Column:
    """One byte per character: a count, not a scan by pattern."""
    return F.octet_length(text) == F.length(text)


def collapse(text: Column, space: str) -> Column:
    """Runs of the characters in ``space``, a class that holds the blank, become one blank.

    Texts without odd characters or two blanks in a row are left alone.
    """
    needed = F.contains(text, F.lit("  ")) | text.rlike(ODD)
    return F.when(needed, F.regexp_replace(text, f"[{space}]+", " ")).otherwise(text)


def strip(text: Column) -> Column:
    """Trim every kind of Unicode white space from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def unix_lines(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def squeeze_blank_lines(text: Column) -> Column:
    return F.regexp_replace(text, r"\n{3,}", "\n\n")


def normalize_spacing(text: Column) -> Column:
    """Line feeds only, trimmed, at most one blank line in a row; NULL gives the empty string."""
    return F.coalesce(squeeze_blank_lines(strip(unix_lines(text))), F.lit(""))


def visible_markup(html: Column) -> Column:
    """A page without tags, scripts, styles and comments; character references still in place."""
    return F.regexp_replace(F.regexp_replace(html, _HIDDEN_MARKUP, "<x>"), _TAG_RUN, "\n")


def html_to_text(html: Column) -> Column:
    """Text of a page: text nodes joined by line feeds."""
    return normalize_spacing(unescape_html(visible_markup(html), html))


def html_pages_to_text(pages: Column) -> Column:
    """Text of an array of pages, each trimmed, with blank lines between.

    Arrow functions cannot run inside a lambda, so the character references of all pages are resolved
    in one string with NUL between them. A page's own NULs are left out.
    """
    pages = F.transform(pages, lambda page: F.replace(page, F.lit("\x00"), F.lit("")))
    joined = unescape_html(
        F.array_join(F.transform(pages, visible_markup), "\x00"), F.array_join(pages, "\x00")
    )
    return normalize_spacing(F.array_join(F.transform(F.split(joined, r"\x00"), strip), "\n\n"))


def markdown_strip_images(text: Column) -> Column:
    """Drop every image form from a markdown text."""
    for form in MARKDOWN_IMAGE_FORMS:
        text = F.regexp_replace(text, form, "")
    return normalize_spacing(text)


def rtf_strip(text: Column) -> Column:
    """Plain text of an RTF body by the fallback rules."""
    for pattern, replacement in RTF_FORMS:
        text = F.regexp_replace(text, pattern, replacement)
    return normalize_spacing(text)


def lossy_utf8(content: Column) -> Column:
    """Decode bytes as UTF-8 with the replacement character for what is invalid."""
    return F.make_valid_utf8(content.cast("string"))


def unprintable_count(text: Column) -> Column:
    """Characters that are neither printable nor white space."""
    bad = r"[\p{C}&&[^\t-\r\x1c-\x1f\x85]]"
    removed = F.length(text) - F.length(F.regexp_replace(text, bad, ""))
    return F.when(text.rlike(ODD), removed).when(text.isNotNull(), 0)


def printable_ratio(text: Column) -> Column:
    size = F.length(text)
    return (size - unprintable_count(text)) / F.greatest(F.lit(1), size)


def paragraphs(text: Column, separator: str = "\n\n") -> Column:
    """Trimmed non-blank pieces between separators."""
    pieces = F.transform(F.split(text, re.escape(separator)), strip)
    return F.filter(pieces, lambda piece: piece != "")


def python_round(value: Column, digits: int = 2) -> Column:
    """Round to nearest by the exact binary value, half to even.

    ``value * scale`` may land on a half only because the product was rounded. The product's error,
    exact by splitting the value in two halves of its digits, then tells the side.
    """
    scale = float(10**digits)
    product = value * scale
    split = value * 134217729.0
    high = split - (split - value)
    error = (high * scale - product) + (value - high) * scale
    floor = F.floor(product)
    half = product - floor == 0.5
    nearest = (
        F.when(half & (error > 0), floor + 1.0)
        .when(half & (error < 0), floor.cast("double"))
        .otherwise(F.rint(product))
    )
    return nearest / scale


def line_count(text: Column) -> Column:
    """Number of lines; a final break starts no further line."""
    feeds = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    breaks = F.when(text.rlike(ODD), F.regexp_count(text, F.lit(LINE_BREAK))).otherwise(feeds)
    closed = (text == "") | F.substring(text, -1, 1).rlike(LINE_BREAK)
    return breaks + F.when(closed, 0).otherwise(1)


def basic_clean(text: Column) -> Column:
    """NFKC, no byte-order marks or control characters, tidy lines, at most one blank line."""

    def tidy(spaced: Column) -> Column:
        lines = F.array_join(F.transform(F.split(spaced, "\n"), strip), "\n")
        return let(
            lines,
            lambda joined: F.when(
                F.contains(joined, F.lit("\n\n\n")), squeeze_blank_lines(joined)
            ).otherwise(joined),
        )

    unmarked = F.replace(nfkc(text), F.lit("\ufeff"), F.lit(""))
    plain = unix_lines(F.regexp_replace(unmarked, CONTROL, ""))
    # Texts without odd characters only lack single blanks and trimmed lines.
    easy = F.when(F.contains(text, F.lit("  ")), F.regexp_replace(text, " {2,}", " ")).otherwise(text)
    odd = text.rlike(ODD)
    return tidy(F.when(odd, F.regexp_replace(plain, f"[{INLINE_SPACE}]+", " ")).otherwise(easy))


def split_sentences(text: Column) -> Column:
    """Sentences of every line: a closing mark followed by white space ends one."""
    tidy = let(unix_lines(text), lambda clean: collapse(clean, f"{SPACE}&&[^\n]"))
    lines = F.filter(F.transform(F.split(tidy, "\n"), strip), lambda line: line != "")
    # A line holds single blanks only, so the blank is found first and the mark looked up behind it.
    pieces = F.transform(lines, lambda line: F.split(line, f" (?<=[{SENTENCE_END}] )"))
    return F.flatten(pieces)


def final_scrub(text: Column, keep_unicode: bool = False) -> Column:
    """NFKC without combining marks, control characters and emoji; then ASCII only.

    Control characters, runs of emoji and runs of other non-ASCII characters each become a blank. One
    pass finds all three; texts without odd characters hold letters at most.
    """
    marked = F.regexp_replace(nfkc(text), COMBINING, "")
    odd = text.rlike(ODD)
    if keep_unicode:
        full = F.regexp_replace(F.regexp_replace(marked, CONTROL, " "), f"[{EMOJI}]+", " ")
        return F.when(odd, full).otherwise(text)
    full = F.regexp_replace(marked, rf"{CONTROL}|[{EMOJI}]+|[^\x00-\x7F{EMOJI}]+", " ")
    return (
        F.when(odd, full).when(is_ascii(text), text).otherwise(F.regexp_replace(text, NON_ASCII, " "))
    )


def words(text: Column) -> Column:
    """White-space tokens."""
    return F.filter(F.split(text, rf"[{SPACE}]+"), lambda word: word != "")


def truncate_tokens(text: Column, limit: int) -> Column:
    """The first ``limit`` white-space tokens: a model's input limit."""
    return F.slice(words(text), 1, limit)


def preview(document: Column, width: int = 200) -> Column:
    """The first characters, with dots where text is left out."""
    return F.when(
        F.length(document) > width, F.concat(F.substring(document, 1, width), F.lit("..."))
    ).otherwise(document)
