"""Pre-tokens of the byte-level tokenizers: the pieces that merges never cross."""

from __future__ import annotations

import os
import re

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for each core

from tokenizers import Tokenizer  # noqa: E402


class PreTokens:
    """Splits texts as the library's byte-level pre-tokenizer does.

    The pattern is the tokenizer's with letters, digits and spaces as this
    Python knows them. Character tables differ in age, so each character is
    held against the library when first seen; a text with one that is classed
    otherwise is split by the library itself.
    """

    PATTERN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")

    def __init__(self, file: str):
        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = {
            token.content: number
            for number, token in self.tokenizer.get_added_tokens_decoder().items()
        }
        longest_first = sorted(self.specials, key=len, reverse=True)
        self._special = re.compile("|".join(map(re.escape, longest_first))) if longest_first else None
        self._alike: set[str] = set()
        self._other: set[str] = set()

    def by_library(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def split(self, text: str) -> list[str]:
        """The pre-tokens of a text without special strings; joined they are the text."""
        new = set(text) - self._alike
        for c in new - self._other:
            probe = f"a{c}1{c} "  # letters, digits, spaces and the rest part it differently
            same = self.PATTERN.findall(probe) == self.by_library(probe)
            (self._alike if same else self._other).add(c)
        return self.by_library(text) if new & self._other else self.PATTERN.findall(text)

    def segments(self, text: str) -> tuple[list[str], list[str]]:
        """Ordinary stretches of a text, one more than the special strings between them, and these."""
        if self._special is None:
            return [text], []
        found = self._special.findall(text)
        return (self._special.split(text), found) if found else ([text], [])
