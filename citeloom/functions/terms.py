"""Terms of full-text search: words without diacritics, stemmed by Porter's algorithm (1980)."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

_VOWEL = re.compile(r"[aeiou]|(?<=[^aeiou])y")


def _shape(stem: str) -> str:
    """v and c for each letter; y after a consonant is a vowel."""
    out = ""
    for k, c in enumerate(stem):
        out += "v" if c in "aeiou" or (c == "y" and k and out[-1] == "c") else "c"
    return out


def _measure(stem: str) -> int:
    return len(re.findall("v+c", _shape(stem)))


def _has_vowel(stem: str) -> bool:
    return "v" in _shape(stem)


def _short_end(stem: str) -> bool:
    """consonant, vowel, consonant that isn't w, x or y"""
    return len(stem) >= 3 and _shape(stem)[-3:] == "cvc" and stem[-1] not in "wxy"


# Suffixes of steps 2, 3 and 4 of the algorithm.
_STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble", "alli": "al", "entli": "ent",
    "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble", "logi": "log",
}
_STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
_STEP_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def porter(word: str) -> str:
    """The stem of a word in lower case; words under three letters and over 64 bytes stay."""
    if len(word) < 3 or len(word.encode()) > 64:
        return word
    if (word.endswith("sses") and len(word) > 4) or (word.endswith("ies") and len(word) > 3):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    cut = None
    if word.endswith("eed") and len(word) > 3:
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    elif word.endswith("ed") and _has_vowel(word[:-2]):
        cut = word[:-2]
    elif word.endswith("ing") and _has_vowel(word[:-3]):
        cut = word[:-3]
    if cut is not None:
        if cut.endswith(("at", "bl", "iz")):
            cut += "e"
        elif len(cut) > 1 and cut[-1] == cut[-2] and _shape(cut)[-1] == "c" and cut[-1] not in "lsz":
            cut = cut[:-1]
        elif _measure(cut) == 1 and _short_end(cut):
            cut += "e"
        word = cut
    if word.endswith("y") and _has_vowel(word[:-1]):
        word = word[:-1] + "i"
    for table in (_STEP_2, _STEP_3):
        end = _longest(word, table)
        if end and _measure(word[: -len(end)]) > 0:
            word = word[: -len(end)] + table[end]
    end = _longest(word, _STEP_4)
    if end:
        stem = word[: -len(end)]
        if _measure(stem) > 1 and (end != "ion" or stem.endswith(("s", "t"))):
            word = stem
    if word.endswith("e"):
        m = _measure(word[:-1])
        if m > 1 or (m == 1 and not _short_end(word[:-1])):
            word = word[:-1]
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word


def _in_word(c: str) -> bool:
    return unicodedata.category(c)[0] in "LN" or unicodedata.category(c) == "Co"


class _Kinds(dict):
    """Of a character's number: `w` in words, `m` for marks that a word goes on with, else a space."""

    def __missing__(self, number: int) -> str:
        c = chr(number)
        self[number] = "w" if _in_word(c) else "m" if unicodedata.category(c) == "Mn" else " "
        return self[number]


_KINDS = _Kinds()
_RUN = re.compile("w[wm]*")


@lru_cache(1 << 16)
def _plain(word: str) -> str:
    low = word.lower()
    return low if low.isascii() else "".join(x for x in unicodedata.normalize("NFD", low) if unicodedata.category(x) != "Mn")


def words(text: str) -> list[tuple[str, int, int]]:
    """(word, start, end): runs of letters and digits, in lower case without diacritics."""
    return [(_plain(text[m.start() : m.end()]), m.start(), m.end()) for m in _RUN.finditer(text.translate(_KINDS))]


def singular(word: str) -> str:
    """A word without the s of a plural, Porter's step 1a: `ofs` and `of` are one, `ofing` is another."""
    if word.endswith(("sses", "ies")):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def stems(text: str | None, stem: Callable[[str], str] | None = None) -> list[str]:
    return [(stem or _stem)(w) for w, _, _ in words(text or "")]


_stem = lru_cache(1 << 16)(porter)
