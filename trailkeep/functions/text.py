"""Whitespace, markup, entities and token features."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from trailkeep.rules import ASCII_PUNCTUATION, STOPWORDS

# Unicode white space, as one class: the regex engine's own \s knows ASCII only.
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# Letters, numbers and the underscore of any script (no combining marks).
WORD = r"[\p{L}\p{N}_]"
WORD_START = rf"(?<!{WORD})"
WORD_END = rf"(?!{WORD})"


# The same characters one by one, without the blank.
_RARE_SPACE = "".join(map(chr, [
    *range(0x09, 0x0E), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
    0x202F, 0x205F, 0x3000,
]))


def strip(col: Column) -> Column:
    """Without leading and trailing white space of any kind (``trim`` knows the blank only)."""
    return F.regexp_replace(col, rf"\A{SPACE}+|{SPACE}+\z", "")


def _collapse(col: Column, extra: str, to: str) -> Column:
    # One character map, then a pattern that meets only true runs: cheaper than matching every blank.
    blanks = F.translate(col, _RARE_SPACE + extra, " " * len(_RARE_SPACE) + to)
    return F.trim(F.regexp_replace(blanks, "  +", " "))


def collapse_space(col: Column) -> Column:
    """Runs of white space become one blank, none at the ends."""
    return _collapse(col, "", "")


def clean_space(col: Column) -> Column:
    """``collapse_space`` with the export separator ``|`` replaced by ``/``."""
    return _collapse(col, "|", "/")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def blank_to_null(col: Column) -> Column:
    return F.when(col != "", col)


# --- entities ---------------------------------------------------------------------------------

_ENTRY, _PAIR = "\x01", "\x02"
# Names that need no closing semicolon, longest first: the longest known prefix wins.
_OPEN_NAMES = sorted((name for name in html5 if not name.endswith(";")), key=lambda n: (-len(n), n))
_OPEN_PREFIX = "^(" + "|".join(_OPEN_NAMES) + ")"
_FREQUENT = ("amp;", "nbsp;", "quot;", "lt;", "gt;", "apos;", "ndash;", "mdash;", "rsquo;", "lsquo;",
             "rdquo;", "ldquo;", "hellip;", "copy;", "middot;", "bull;")


def _name_map(names: Sequence[str]) -> Column:
    """A literal map, folded once by the optimizer."""
    text = _ENTRY.join(name + _PAIR + html5[name] for name in names)
    return F.str_to_map(F.lit(text), F.lit(_ENTRY), F.lit(_PAIR))


def _windows_1252() -> dict[int, str]:
    """What browsers, and the HTML standard, read for the control range 0x80-0x9f."""
    table = {0x00: "\ufffd", 0x0D: "\r"}
    for code in range(0x80, 0xA0):
        try:
            table[code] = bytes([code]).decode("cp1252")
        except UnicodeDecodeError:
            table[code] = chr(code)
    return table


def _code_point(code: Column) -> Column:
    """The character of a numeric reference; none for non-characters, U+FFFD outside Unicode."""
    remap = _windows_1252()
    remapped = F.str_to_map(
        F.lit(_ENTRY.join(f"{k}{_PAIR}{v}" for k, v in remap.items())), F.lit(_ENTRY), F.lit(_PAIR)
    )
    def within(low: int, high: int) -> Column:
        return (code >= low) & (code <= high)

    noncharacter = (
        within(0x1, 0x8) | (code == 0xB) | within(0xE, 0x1F) | (code == 0x7F)
        | within(0xFDD0, 0xFDEF) | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    )
    character = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (
        F.when((code == 0) | (code == 13) | within(0x80, 0x9F),
               F.element_at(remapped, code.cast("string")))
        .when(within(0xD800, 0xDFFF) | (code > 0x10FFFF), F.lit("\ufffd"))
        .when(noncharacter, F.lit(""))
        .otherwise(character)
    )


def _decode_piece(piece: Column) -> Column:
    """Decode what follows one ampersand."""
    number = F.regexp_extract(piece, r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?", 0)
    hexadecimal = F.regexp_extract(number, r"^#[xX]0*([0-9a-fA-F]*)", 1)
    decimal = F.regexp_extract(number, r"^#0*([0-9]*)", 1)
    too_big = F.lit(0x110000).cast("bigint")
    code = F.when(
        number.rlike("^#[xX]"),
        F.when(F.length(hexadecimal) > 6, too_big)
        .otherwise(F.coalesce(F.conv(F.concat(F.lit("0"), hexadecimal), 16, 10).try_cast("bigint"), too_big)),
    ).otherwise(
        F.when(F.length(decimal) > 7, too_big)
        .otherwise(F.coalesce(F.concat(F.lit("0"), decimal).try_cast("bigint"), too_big))
    )
    name = F.regexp_extract(piece, r"^[^\t\n\f <&#;]{1,32};?", 0)
    frequent = F.element_at(_name_map(_FREQUENT), name)
    full = F.element_at(_name_map(list(html5)), name)
    prefix = F.regexp_extract(name, _OPEN_PREFIX, 1)
    by_prefix = F.when(
        prefix != "",
        F.concat(F.element_at(_name_map(_OPEN_NAMES), prefix),
                 name.substr(F.length(prefix) + 1, F.length(name))),
    )
    named = F.coalesce(frequent, full, by_prefix, F.concat(F.lit("&"), name))
    return F.when(
        number != "", F.concat(_code_point(code), piece.substr(F.length(number) + 1, F.length(piece)))
    ).otherwise(F.concat(named, piece.substr(F.length(name) + 1, F.length(piece))))


def html_unescape(col: Column) -> Column:
    """Named and numeric character references decoded in a single pass (``&amp;lt;`` gives ``&lt;``)."""
    pieces = F.split(col, "&", -1)
    return F.array_join(F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(_decode_piece(p))), "")


# --- markup -----------------------------------------------------------------------------------

_TAG = "<[^>]+>"


def strip_html(col: Column, profile: str = "article") -> Column:
    """Text of an HTML fragment: hidden blocks and tags removed, references decoded afterwards.

    ``article`` decodes every reference and replaces ``|``; ``contact`` knows only ``&nbsp;``;
    ``district`` also turns the en dash reference into ``-``.
    """
    if profile == "article":
        shown = F.regexp_replace(col, r"(?is)<(script|style|noscript|svg)\b[^>]*>.*?</\1>", " ")
        return clean_space(html_unescape(F.regexp_replace(shown, _TAG, " ")))
    if profile not in ("contact", "district"):
        raise ValueError(f"unknown profile: {profile}")
    shown = F.regexp_replace(col, r"(?is)<(script|style|noscript).*?>.*?</\1>", " ")
    text = F.regexp_replace(shown, _TAG, " ")
    if profile == "district":
        text = F.regexp_replace(text, "(?i)&#8211;|&ndash;", "-")
    return collapse_space(F.regexp_replace(text, "(?i)&nbsp;", " "))


# --- token features ---------------------------------------------------------------------------


@cache
def _folds() -> dict[str, str]:
    """What the lower-case characters that case folding changes become: one character or several, none of them changed again."""
    letters = (c for c in map(chr, range(0x110000)) if not "\ud800" <= c <= "\udfff")
    return {c: c.casefold() for c in letters if c.lower() == c != c.casefold()}


def _class(letters: Iterable[str]) -> str:
    """A pattern for one of ``letters``, as few ranges; characters before the first one beyond Latin-1 fail at once."""
    codes = sorted(map(ord, letters))
    heads = [c for c in codes if c - 1 not in codes]
    tails = [c for c in codes if c + 1 not in codes]
    low = "".join(rf"\x{{{c:x}}}" for c in codes if c < 0x100)
    high = next(rf"\x{{{c:x}}}-\x{{10ffff}}" for c in codes if c >= 0x100)
    return f"[{low}{high}&&[{''.join(rf'\x{{{a:x}}}-\x{{{b:x}}}' for a, b in zip(heads, tails))}]]"


def case_fold(col: Column) -> Column:
    """Full case folding: lower case, then the few lower-case characters that fold further (sharp s, micro sign, ligatures).

    Only the folds a text holds are applied to it, one replacement each; most texts hold none.
    """
    folds = _folds()
    some = _class(folds)
    table = F.create_map(*[F.lit(x) for pair in folds.items() for x in pair])

    def further(text: Column) -> Column:
        held = F.array_distinct(F.regexp_extract_all(text, F.lit(some), F.lit(0)))
        return F.aggregate(held, text, lambda done, c: F.replace(done, c, F.element_at(table, c)))

    return let(F.lower(col), lambda text: F.when(text.rlike(some), further(text)).otherwise(text))


def clean_text(col: Column, stopwords: Sequence[str] = STOPWORDS) -> Column:
    """Word tokens without markup, case, punctuation and stopwords; missing text gives ``''``."""
    tokens = F.regexp_extract_all(case_fold(F.regexp_replace(col, _TAG, " ")), F.lit(f"{WORD}+"), F.lit(0))
    kept = F.filter(tokens, lambda token: ~token.isin(*stopwords)) if stopwords else tokens
    return F.coalesce(F.array_join(kept, " "), F.lit(""))


def clean_text_punct(col: Column, stopwords: Sequence[str]) -> Column:
    """Variant that deletes tags and ASCII punctuation (``2.9%`` becomes ``29``) and splits at white space."""
    # Rare spaces become blanks and punctuation goes, in one character map.
    bare = F.translate(F.lower(F.regexp_replace(col, _TAG, "")), _RARE_SPACE + ASCII_PUNCTUATION, " " * len(_RARE_SPACE))
    tokens = F.split(bare, " ", -1)
    kept = F.filter(tokens, lambda token: (token != "") & ~token.isin(*stopwords))
    return F.coalesce(F.array_join(kept, " "), F.lit(""))
