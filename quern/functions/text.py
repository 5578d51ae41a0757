"""Column expressions over text, shared by the passes.

White space is one explicit Unicode class, written so that Java and RE2 read it alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space.
WS_CHARS = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS = f"[{WS_CHARS}]"
# Characters stripped from both ends of a token before it is judged as a word.
EDGE_CHARS = r"\x21-\x2f0-9\x3a-\x40\x5b-\x60\x7b-\x7e\x{2019}\x{2018}\x{201c}\x{201d}\x{2014}\x{2013}\x{2026}\x{2022}\x{00b7}"


def filled(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def strip(col: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(F.regexp_replace(col, f"^{WS}+", ""), f"{WS}+$", "")


def norm(col: Column) -> Column:
    """Lower case, runs of white space as one blank, trimmed: the form that copies are told by."""
    return F.trim(F.regexp_replace(F.lower(col), f"{WS}+", " "))


def words(col: Column) -> Column:
    """Tokens between white space; an empty array for a blank text."""
    return F.filter(F.split(col, f"{WS}+"), lambda w: w != "")


def letters(col: Column) -> Column:
    """How many letters."""
    return F.length(F.regexp_replace(col, r"[^\p{L}]", ""))


def solid(col: Column) -> Column:
    """How many characters that are not white space."""
    return F.length(F.regexp_replace(col, f"{WS}+", ""))


def line_key(col: Column) -> Column:
    """The form that running headers and footers are told by: digits as #, lower case."""
    return F.lower(F.regexp_replace(strip(col), "[0-9]+", "#"))


def repair_breaks(col: Column) -> Column:
    """Native half of text repair: line ends, hyphenated breaks, trailing blanks, blank runs."""
    out = F.regexp_replace(col, "\r\n?", "\n")
    out = F.regexp_replace(out, r"([\p{L}\p{N}_])-\n([\p{L}\p{N}_])", "$1$2")
    out = F.regexp_replace(out, r"[ \t]+\n", "\n")
    return strip(F.regexp_replace(out, "\n{3,}", "\n\n"))


def reflow(col: Column) -> Column:
    """Join the lines of each blank-line block by a blank, and blocks by a blank line."""
    blocks = F.split(col, rf"\n{WS}*\n")
    joined = F.transform(blocks, lambda b: F.array_join(F.filter(F.transform(F.split(b, "\n"), strip), lambda x: x != ""), " "))
    return F.array_join(F.filter(joined, lambda b: b != ""), "\n\n")


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once for each row, not once for each use."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shingles(col: Column, k: int = 5) -> Column:
    """Distinct k-word shingles of the normal form; fewer words make one, none make none."""

    def body(w: Column) -> Column:
        many = F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (k - 1), F.lit(1))), lambda i: F.array_join(F.slice(w, i, k), " "))
        return F.when(F.size(w) == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(many))

    return _bound(words(norm(col)), body)


def shingle_hashes(col: Column, k: int = 5) -> Column:
    """Distinct 64-bit hashes of the same shingles.

    The words of a slice are hashed one after the other, so no shingle is ever put together as a
    string; words hold no white space, so equal slices and equal shingles are the same thing.
    """

    def body(w: Column) -> Column:
        many = F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (k - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, k)))
        return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(F.array_distinct(many))

    return _bound(words(norm(col)), body)


def char_ngrams(col: Column, n: int = 4) -> Column:
    """Distinct n-grams of the stream of lower-case letters and digits."""

    def body(c: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.greatest(F.size(c) - (n - 1), F.lit(1))), lambda i: F.array_join(F.slice(c, i, n), ""))
        return F.when(F.size(c) < n, F.array().cast("array<string>")).otherwise(F.array_distinct(grams))

    # Single characters first: reaching into a string by position costs its length each time.
    stream = F.regexp_replace(F.lower(col), r"[^\p{L}\p{N}]", "")
    return _bound(F.filter(F.split(stream, ""), lambda c: c != ""), body)
