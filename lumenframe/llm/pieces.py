"""Cutting text where a byte-level pre-tokenizer always cuts, and caches over the pieces.

A single space between two characters that are not white space always starts a new pre-token
and nothing before it matters for what follows. So the pieces between such spaces can be
tokenised one by one, each once per cache.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import regex

# The characters with Unicode's White_Space property, and the control characters
# that Python counts as white space besides; space and line feed are left out.
_RARE_SPACE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
# The pre-tokenizer pattern of byte-level vocabularies, its \s written as Unicode's
# White_Space property.
_WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRE_TOKEN = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
_SAFE = re.compile(r"(?<=[\w!-~]) (?=[\w!-~])")


def pieces(text: str) -> list[str]:
    """The text in pieces, without the single space before each but the first."""
    if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " " or _RARE_SPACE.search(text):
        return _SAFE.split(text)
    return text.split(" ")


class Cache(dict):
    """A bounded cache of ``make(key)``: when ``size`` entries are new, they become the old
    generation and the former old one goes. Lookups by ``cache[key]`` only."""

    def __init__(self, make: Callable, size: int):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        return self.put(key, self.make(key) if value is None else value)

    def put(self, key, value):
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
