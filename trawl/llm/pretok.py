"""Pre-token splitting for byte-level BPE, shared by the token operators.

``pieces`` cuts a text before every space and around every newline. Where spaces and newlines
stand alone between other characters, each cut is also a cut of the split pattern (a space
belongs to the word after it, a newline is a match of its own), so a piece can be split by the
pattern on its own and its result remembered. Any other text (runs of white space, tabs, no-break
spaces, NUL) is split by the pattern directly.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import regex

_OTHER_SPACE = re.compile(r"[^\S \n]")
_CUT = "\0"


class Splitter:
    def __init__(self, pattern: str):
        self.findall: Callable[[str], list[str]] = regex.compile(pattern).findall

    def pieces(self, text: str) -> list[str]:
        if ("  " in text or "\n\n" in text or " \n" in text or "\n " in text or _CUT in text
                or _OTHER_SPACE.search(text)):
            return self.findall(text)
        return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split(_CUT)


class Memo(dict):
    """Remembers ``make(key)``; emptied when it holds ``most`` entries, so its memory is bounded
    (a miss only costs the work again)."""

    def __init__(self, make: Callable, most: int):
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value
