"""Text expressions: whitespace, word windows, section headers.

Java's ``\\s`` knows six characters, Unicode text has 29, so every rule below names
its white space explicitly.  Turning it into plain blanks first keeps the patterns that
walk a whole text simple and fast.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters that count as white space.
WHITESPACE = "".join(
    map(
        chr,
        (
            *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
            *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
        ),
    )
)
# The same set as a Java character class.  The intersection rejects common characters by
# one range test before the long union is looked at, which halves the scan time.
_SPACES = (
    r"[\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
WS = rf"[[^!-~\x{{a1}}-\x{{167f}}]&&{_SPACES}]"
# White space other than the plain blank.
_ODD_WS = rf"[[^ -~\x{{a1}}-\x{{167f}}]&&{_SPACES}]"

# Abbreviations that end no sentence; initials such as J. and U.S. don't either.
ABBREVIATIONS = (
    "Mr", "Mrs", "Ms", "Dr", "Prof", "Rev", "Gen", "Sen", "Rep", "Gov", "St", "Jr", "Sr",
    "Inc", "Corp", "Co", "Ltd", "Bros", "No", "Nos", "Art", "Sec", "Fig", "Vol", "pp", "p", "vs", "cf",
    "al", "approx", "e.g", "i.e", "Jan", "Feb", "Mar", "Apr", "Jun", "Jul", "Aug", "Sep", "Sept", "Oct",
    "Nov", "Dec",
)
_SHORT = "|".join(a.replace(".", r"\.") for a in ABBREVIATIONS)
# What a sentence ends with, what abbreviations look like, and what the next one starts with.
SENTENCE_END = r"[.!?][)\]\"'”’]{0,3}"
ABBREVIATED = rf"(?:{_SHORT}|\p{{Lu}}(?:\.\p{{Lu}}){{0,4}})\."
SENTENCE_START = r"[\"'(\[“‘]?[\p{Lu}\p{Nd}]"
_SENTENCE_GAP = rf" (?<={SENTENCE_END} )(?<!(?<![\p{{L}}\p{{Nd}}.]){ABBREVIATED} )(?={SENTENCE_START})"

# The two forms of a section header, an item number or a part number.
_HEADER = rf"(?:ITEM{WS}+\p{{Nd}}+[A-Z]?\.?|PART{WS}+[IVXLCDM]+)"
# Case-insensitive in Unicode, ^ and $ at lines, and only \n ends a line.
_FLAGS = "(?iumd)"


def strip(text: Column) -> Column:
    """Drop white space at both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def collapse(text: Column) -> Column:
    """Strip, and turn each inner run of white space into one blank."""
    blanks = F.regexp_replace(text, _ODD_WS, " ")
    single = F.when(F.contains(blanks, F.lit("  ")), F.regexp_replace(blanks, " {2,}", " "))
    return F.btrim(single.otherwise(blanks))


def sentences(plain: Column) -> Column:
    """Array of the sentences of a collapsed text.

    A sentence ends behind ``.``, ``!`` or ``?`` and closing marks if a capital or a digit
    follows, but not behind an abbreviation or initials.  The pattern begins with the blank, so
    what lies around it is looked at between words only.
    """
    return F.split(plain, _SENTENCE_GAP, -1)


def has_text(text: Column) -> Column:
    """Neither null nor blank; the search ends at the first character that is no space."""
    return F.coalesce(F.regexp_like(text, F.lit(rf"(?s)(?!{WS}).")), F.lit(False))


def word_windows(plain: Column, size: int, overlap: int = 0) -> Column:
    """Array of windows of ``size`` words of a collapsed text.

    One possessive pattern walks the text once, so the cost is linear in its length;
    an array of words sliced per window would be quadratic for a long document.
    """
    if size < 1 or not 0 <= overlap < size:
        raise ValueError("need size >= 1 and 0 <= overlap < size")
    window = rf"[^ ]++(?: [^ ]++){{0,{size - 1}}}+"
    if overlap == 0:
        return F.regexp_extract_all(plain, F.lit(window), F.lit(0))
    step = rf"[^ ]++(?: [^ ]++){{0,{size - overlap - 1}}}+"
    return F.regexp_extract_all(plain, F.lit(f"(?=({window})){step}"), F.lit(1))


def header_pieces(text: Column, *, inline_titles: bool = False) -> Column:
    """Split a text in front of every header line; the preamble is a piece of its own."""
    line = rf"{_HEADER}\b[^\n]*$" if inline_titles else rf"{_HEADER}{WS}*$"
    return F.split(text, rf"{_FLAGS}^(?={line})")


def header_of(piece: Column, *, inline_titles: bool = False) -> Column:
    """The header at the start of a piece, as written; empty for a preamble."""
    end = r"\b" if inline_titles else rf"(?={WS}*$)"
    return F.regexp_extract(piece, rf"{_FLAGS}\A{_HEADER}{end}", 0)


def section_title(header: Column) -> Column:
    """Normal form: single blanks, no dots at the ends, upper case."""
    return F.upper(F.btrim(collapse(header), F.lit(".")))


def preview(text: Column, chars: int) -> Column:
    return F.concat(F.left(text, F.lit(chars)), F.lit("..."))
