"""Blank-delimited units of a text that byte-level BPE encodes independently of each other.

The pre-split pattern of byte-level BPE never joins a visible character and a following blank, so a
text may be cut before every blank that follows a visible character. A unit is what lies between two
such cuts, its leading blank included.
"""

from __future__ import annotations

import re
import unicodedata

_BLANK = "\\s\\x1c-\\x1f\u180e"
_CUT = re.compile(f"(?<=[^{_BLANK}]) ")
# Every white space character followed by a blank; without any of these, all blanks are cuts.
_SPACES = [chr(c) for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, 0x180E,
                            *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_ASCII_UNSAFE = [c + " " for c in _SPACES if ord(c) < 128]
_OTHER_UNSAFE = [c + " " for c in _SPACES if ord(c) >= 128]

# Up to here every character has had its class since long, so that all libraries agree on it.
_LAST = 0x24F
_KIND = {c: unicodedata.category(chr(c))[0] for c in range(_LAST + 1)}
_L, _N = ("".join(f"\\u{c:04x}" for c, k in _KIND.items() if k == kind) for kind in "LN")
_W = "\\t-\\r \\x85\\xa0"
# The pre-split pattern of byte-level BPE with its classes spelled out for these characters.
_LATIN_PRETOKENS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_W}{_L}{_N}]+|[{_W}]+(?![^{_W}])|[{_W}]+"
)
_LATIN = re.compile(f"[\\x00-\\u{_LAST:04x}]*")
# With dashes, curly quotes and the ellipsis, which are neither letters, digits nor blanks.
_LATIN_TEXT = re.compile(f"[\\x00-\\u{_LAST:04x}\\u2010-\\u2027]*")


class Pretokens:
    """Pre-tokens of a text in the byte alphabet of a tokenizers library vocabulary."""

    def __init__(self, library):
        self.library = library.pre_tokenizer.pre_tokenize_str
        # The alphabet, read off the library character by character.
        letters = {}
        for c in (*range(_LAST + 1), 0x2010):
            for byte, letter in zip(chr(c).encode(), "".join(p for p, _ in self.library(chr(c)))):
                letters[byte] = letter
        self.letters = letters
        self.blank = letters[ord(" ")]

    def __call__(self, text: str) -> list[str]:
        if _LATIN.fullmatch(text) is None:
            return [p for p, _ in self.library(text)]
        if text.isascii():
            return [p.translate(self.letters) for p in _LATIN_PRETOKENS.findall(text)]
        return [p.encode().decode("latin-1").translate(self.letters)
                for p in _LATIN_PRETOKENS.findall(text)]

    def latin(self, text: str) -> list[str] | None:
        """Pre-tokens of a text in its own characters; none for a text beyond the Latin ones and marks."""
        if text.isascii() or _LATIN_TEXT.fullmatch(text) is not None:
            return _LATIN_PRETOKENS.findall(text)
        return None

    def in_bytes(self, pretoken: str) -> str:
        """A pre-token of ``latin`` in the byte alphabet."""
        if pretoken.isascii():
            return pretoken.translate(self.letters)
        return pretoken.encode().decode("latin-1").translate(self.letters)

    def after_blank(self, unit: str) -> list[str]:
        """Pre-tokens of a blank and a unit."""
        if unit.isascii() and unit.isalpha():
            return [self.blank + unit]
        return self(" " + unit)


class Remembered(dict):
    """Values made on first use; starts again when ``most`` are held."""

    def __init__(self, make, most: int, start: dict | None = None):
        super().__init__(start or {})
        self.make, self.most, self.first = make, most, start or {}

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value

    def trim(self) -> None:
        if len(self) > self.most:
            self.clear()
            self.update(self.first)


def split_units(text: str) -> list[str]:
    """Units of a text. The blank before every unit but the first is left out."""
    unsafe = text.startswith(" ") or any(x in text for x in _ASCII_UNSAFE)
    if not unsafe and not text.isascii():
        unsafe = any(x in text for x in _OTHER_UNSAFE)
    return _CUT.split(text) if unsafe else text.split(" ")
