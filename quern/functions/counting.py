"""Counts over a whole text by arrays of code points: one pass where a regular expression for each
counter would read the text again.  The classes are those of ``functions.text``."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter
from functools import cache
from hashlib import blake2b

import numpy as np

from quern.functions import text as T

_NUMBER = re.compile(r"[0-9]+(?:[.,/][0-9]+)?")
GRAM = 4


def _points(chars: str) -> np.ndarray:
    """Table of the code points that one of the written classes of ``functions.text`` names."""
    plain = re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: f"\\u{int(m[1], 16):04x}", chars)
    known = re.compile(f"[{plain}]")
    table = np.zeros(sys.maxunicode + 1, bool)
    table[[c for c in range(0x3001) if known.match(chr(c))]] = True
    return table


@cache
def tables() -> dict[str, np.ndarray]:
    kinds = np.array([unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1)])
    return {"space": _points(T.WS_CHARS), "edge": _points(T.EDGE_CHARS), "letter": kinds == "L", "alnum": (kinds == "L") | (kinds == "N")}


def codepoints(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _upto(flags: np.ndarray) -> np.ndarray:
    """How many are set before each place, and in all."""
    return np.concatenate([[0], np.cumsum(flags)])


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of set places begin and end."""
    turn = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    return np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)


AUDIT = ("n_chars", "n_tokens", "n_long", "n_letters", "n_solid", "n_cores", "n_wordlike", "n_caps", "n_lines", "n_garbage")


def audit_counts(text: str) -> tuple[int, ...]:
    """The audit's counters, named by ``AUDIT``.

    A token's core is what is left without edge characters at both ends; it counts where it is
    two letters or more and nothing else, so where the token has one run of letters and else
    edge characters only.
    """
    cp = codepoints(text)
    t = tables()
    letter, solid = t["letter"][cp], ~t["space"][cp]
    start, end = _runs(solid)
    within = lambda flags: (lambda c: c[end] - c[start])(_upto(flags))
    first = letter & ~np.concatenate([[False], letter[:-1]])
    letters = within(letter)
    core = (letters >= 2) & (within(first) == 1) & (within(solid & ~letter & ~t["edge"][cp]) == 0)
    lower, upper = (cp >= 97) & (cp <= 122), (cp >= 65) & (cp <= 90)
    vowel = np.isin(cp | 32, np.frombuffer("aeiouy".encode("utf-32-le"), np.uint32)) & (lower | upper)
    turns = np.concatenate([lower[:-1] & upper[1:], [False]]) if len(cp) else lower
    ends = np.append(np.flatnonzero(cp == 10), len(cp))
    begins = np.concatenate([[0], ends[:-1]])
    in_line = lambda flags: (lambda c: c[ends] - c[begins])(_upto(flags))
    line_solid = in_line(solid)
    return tuple(
        int(x)
        for x in (
            len(cp),
            len(start),
            (end - start > 30).sum(),
            letter.sum(),
            solid.sum(),
            core.sum(),
            (core & (letters <= 20) & (within(vowel) > 0)).sum(),
            (core & (within(turns) > 0)).sum(),
            (line_solid > 0).sum(),
            (in_line(letter) < line_solid * 0.35).sum(),
        )
    )


def _grams(x: np.ndarray) -> np.ndarray:
    """Distinct n-grams of a sequence of 16-bit numbers, each in one 64-bit number."""
    if len(x) < GRAM:
        return np.zeros(0, np.uint64)
    x = x.astype(np.uint64)
    n = len(x) - GRAM + 1
    return np.unique(x[:n] | x[1 : n + 1] << np.uint64(16) | x[2 : n + 2] << np.uint64(32) | x[3 : n + 3] << np.uint64(48))


def shared_grams(old: str, new: str) -> tuple[int, int, int]:
    """Distinct 4-grams of letters and digits, lower-cased: common to both texts, of each."""
    alnum = tables()["alnum"]
    a, b = (cp[alnum[cp]] for cp in (codepoints(old.lower()), codepoints(new.lower())))
    known, ids = np.unique(np.concatenate([a, b]), return_inverse=True)
    if len(known) > 1 << 16:  # more kinds of characters than 16 bits tell apart
        x, y = ({s[i : i + GRAM].tobytes() for i in range(len(s) - GRAM + 1)} for s in (a, b))
        return len(x & y), len(x), len(y)
    x, y = _grams(ids[: len(a)]), _grams(ids[len(a) :])
    return len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)


def numbers_kept(old: str, new: str) -> bool:
    """Whether ``new`` has no number more often than ``old``."""
    return not Counter(_NUMBER.findall(new)) - Counter(_NUMBER.findall(old))


#: Words whose hashes a process holds.
HELD_WORDS = 1 << 18
_held: dict[str, int] = {}


def _word(word: str) -> int:
    found = _held.get(word)
    if found is None:
        if len(_held) >= HELD_WORDS:
            _held.clear()
        found = _held[word] = int.from_bytes(blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big")
    return found


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on all (the last step of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(norm: str, k: int = 5) -> np.ndarray:
    """Distinct 64-bit hashes of the k-word shingles of a normal form, sorted; fewer words make
    one, none make none.  Words are hashed once, and their hashes one after the other."""
    words = [w for w in norm.split(" ") if w]
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(_word, words), np.uint64, len(words))
    n, step = max(len(words) - k + 1, 1), np.uint64(0x9E3779B97F4A7C15)
    h = np.zeros(n, np.uint64)
    for j in range(min(k, len(words))):
        h = _mixed(h + each[j : j + n] + step)
    return np.unique(h)
