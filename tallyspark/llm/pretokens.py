r"""Pre-tokens: the matches of a tokenizer's pattern.

The pattern never lets a token cross a single space between two characters that
are not white space; the space starts the next token. So a text is cut there
first (a plain string split), and what a cut piece holds is worked out once and
kept in a bounded table: ``Memo``.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import regex

# Characters that this Python library's Unicode tables count as
# letters or numbers and that are unassigned in Unicode 16, which the
# tokenizer libraries go by.
UNASSIGNED = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 "
    "10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 "
    "16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 "
    "1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED "
    "1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F")

_NEWER = re.compile("[" + "".join("-".join(chr(int(x, 16)) for x in r.split("-")) for r in UNASSIGNED.split()) + "]")
_UNEVEN = re.compile(r"\s\s|^\s|\s\Z")
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


def cut(text: str) -> list[str]:
    """The text cut at single spaces between other characters; each piece but
    the first had a space before it."""
    return _BETWEEN.split(text) if _UNEVEN.search(text) else text.split(" ")


class Splitter:
    def __init__(self, pattern: str):
        self._find = regex.compile(pattern).findall

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or not _NEWER.search(text):
            return self._find(text)
        out, at = [], 0  # a private-use character stands in for each of them
        for piece in self._find(_NEWER.sub("", text)):
            out.append(text[at:at + len(piece)])
            at += len(piece)
        return out


class Memo(dict):
    """``key -> make(prefix + key)``, kept for keys up to ``longest``
    characters in two generations: beyond ``most`` entries the older one goes,
    and what is still used moves to the younger one."""

    def __init__(self, make: Callable, prefix: str, most: int, longest: int = 48):
        self.make, self.prefix, self.most, self.longest = make, prefix, most // 2, longest
        self.old: dict = {}

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            value = self.make(self.prefix + key)
        if len(key) <= self.longest:
            self[key] = value
        return value

    def trim(self) -> None:
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()
