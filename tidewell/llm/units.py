"""Cuts text where the byte-level pre-tokeniser always cuts, so that counts or ids of the parts add up."""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import Any

# The pre-tokeniser's pattern, and the white space other than blank and line feed.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RARE_SPACE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0  -     　]")
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
UNIT = re.compile(rf"[ \n]*[{LETTERS}]+(?=[.,](?:[ \n]|\Z)|[ \n]|\Z)|[.,](?=[ \n]|\Z)|[ \n]*[^ \n]+|[ \n]+")


def units(text: str) -> list[str]:
    """Runs of blanks and line feeds with the word that follows, and a last stop or comma after it.

    No piece of the pattern goes on from a non-space into a space or from a letter into a sign, and
    none looks back, so each unit is cut into the same pieces alone as in the text. Other white space
    could stand to the left of a cut; texts that have it stay whole.
    """
    return [text] if RARE_SPACE.search(text) else UNIT.findall(text)


FIRST = "\x01"  # begins the keys of units that don't begin with one blank and a sign
WORD = re.compile(f" ?[{LETTERS}]+")
LATIN = re.compile("[ \n!-~¡-¬®-ÿ]*")


def single_spaced(text: str) -> bool:
    """Whether white space never stands in runs or last, and is blanks and line feeds only."""
    return not (text[-1] in " \n" or "  " in text or "\n\n" in text or " \n" in text or "\n " in text or FIRST in text or RARE_SPACE.search(text))


def blank_keys(text: str) -> str:
    """The keys of a single-spaced text, with blanks between them."""
    return (FIRST + text if text[0] != " " else text[1:]).replace("\n", " \x01\n")


def keys(text: str) -> list[str]:
    """The text's units as keys of a memo: cut at each blank, which they go without, and before each line feed.

    Only in single-spaced texts is that so simple; else units() cuts.
    """
    if not text:
        return []
    if single_spaced(text):
        return blank_keys(text).split(" ")
    if FIRST in text or RARE_SPACE.search(text):
        return [FIRST + text]
    return [u[1:] if u[0] == " " and u[1:2] not in ("", " ", "\n") else FIRST + u for u in UNIT.findall(text)]


def unit_of(key: str) -> str:
    return key[1:] if key[0] == FIRST else " " + key


class Memo(dict):
    """unit -> value. Bounded: at `most` entries these are set aside, in place of those set aside before,
    and taken up again when they're met. What is forgotten costs time, never results."""

    def __init__(self, make: Callable[[str], Any], most: int = 400_000, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest, self.aside = make, most, longest, {}

    def keep(self, key: str, value: Any) -> None:
        if len(self) >= self.most:
            self.aside = dict(self)
            self.clear()
        self[key] = value

    def __missing__(self, key: str) -> Any:
        value = self.aside.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            self.keep(key, value)
        return value
