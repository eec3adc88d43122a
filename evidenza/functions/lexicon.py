"""Many words and phrases looked for in one scan of each text.

A lexicon is a list of terms, each with the marks that it sets.  All terms are compiled into
one automaton; a scan gives a row's terms as a bit mask, and marks, rules and lists of terms
read that mask.  Texts cross to Python once, in Arrow batches.

Case-insensitive terms match letter by letter as upper case and back does, so texts keep
their length.  A word character is a letter, mark, decimal digit, letter number,
connector or joiner; a term with a bounded end needs exactly one word character of the
two around it.  Web addresses can be left out, as if they were deleted from the text.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property, lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_BITS = 62
_LINK = re.compile(r"https?://[^ \t\n\x0b\f\r]+")
_WORD_KINDS = frozenset(("Lu", "Ll", "Lt", "Lm", "Lo", "Mn", "Me", "Mc", "Nd", "Nl", "Pc"))


@dataclass(frozen=True)
class Term:
    """A literal text; ``starts`` and ``ends`` ask for a word boundary there."""

    text: str
    marks: tuple[str, ...]
    starts: bool = False
    ends: bool = False
    ignore_case: bool = True
    outside_links: bool = False


def terms(mark: str, texts: Sequence[str], whole: bool = False, **options: bool) -> list[Term]:
    """One term per text that sets ``mark``; ``whole`` asks for word boundaries on both sides."""
    return [Term(t, (mark,), whole, whole, **options) for t in texts]


@lru_cache(maxsize=1 << 16)
def is_word(char: str) -> bool:
    return unicodedata.category(char) in _WORD_KINDS or char in "‌‍"


@lru_cache(maxsize=1 << 16)
def _fold_char(char: str) -> str:
    upper = char.upper()
    lower = upper.lower() if len(upper) == 1 else char.lower()
    return lower if len(lower) == 1 else char


def fold(text: str) -> str:
    """The text for comparison without case, as long as it was."""
    if text.isascii():
        return text.lower()
    odd = [c for c in set(text) if not c.isascii()]
    # a capital sigma is lowered by its place in the word
    if "Σ" not in odd and all(_fold_char(c) == c.lower() for c in odd):
        return text.lower()
    return "".join(map(_fold_char, text))


@dataclass(frozen=True)
class Lexicon:
    terms: tuple[Term, ...]

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """Folded text -> numbers of the terms that have it."""
        found: dict[str, list[int]] = {}
        for number, term in enumerate(self.terms):
            if not term.text:
                raise ValueError("a term must not be empty")
            found.setdefault(fold(term.text), []).append(number)
        automaton = ahocorasick.Automaton()
        for text, numbers in found.items():
            automaton.add_word(text, (len(text), tuple(numbers)))
        automaton.make_automaton()
        return automaton

    def __getstate__(self) -> dict:
        return {"terms": self.terms}  # every worker compiles its own

    def find(self, text: str) -> int:
        """Bit mask of the terms that occur in the text."""
        folded = fold(text)
        found, links = 0, None
        for last, (size, numbers) in self.automaton.iter(folded):
            left = [n for n in numbers if not found >> n & 1]
            if not left:
                continue
            start, stop = last + 1 - size, last + 1
            for number in left:
                term = self.terms[number]
                after = stop
                if not term.ignore_case and text[start:stop] != term.text:
                    continue
                if term.outside_links:
                    links = [m.span() for m in _LINK.finditer(text)] if links is None else links
                    if any(a < stop and start < b for a, b in links):
                        continue
                    after = next((b for a, b in links if a == stop), stop)
                if term.starts and not self._edge(text, start, start, term.outside_links, links):
                    continue
                if term.ends and not self._edge(text, stop, after, False, None):
                    continue
                found |= 1 << number
        return found

    @staticmethod
    def _edge(text: str, before: int, after: int, skip: bool, links: list | None) -> bool:
        """Whether one of the characters on both sides is a word character, and the other is not."""
        if skip and links:
            before = next((a for a, b in links if b == before), before)
        left = before > 0 and is_word(text[before - 1])
        right = after < len(text) and is_word(text[after])
        return left != right

    def mask(self, text: Column) -> Column:
        """Array of words of ``WORD_BITS`` bits, one bit per term; null for null."""
        words = -(-len(self.terms) // WORD_BITS)
        low = (1 << WORD_BITS) - 1

        def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                masks = [None if t is None else self.find(t) for t in batch.to_pylist()]
                rows = [m if m is None else [m >> WORD_BITS * i & low for i in range(words)] for m in masks]
                yield pa.array(rows, pa.list_(pa.int64()))

        scan.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        return F.arrow_udf(scan, "array<bigint>")(text)

    def _any(self, mask: Column, numbers: Sequence[int]) -> Column:
        held = F.lit(False)
        for word in sorted({n // WORD_BITS for n in numbers}):
            bits = sum(1 << n % WORD_BITS for n in numbers if n // WORD_BITS == word)
            held = held | (F.get(mask, F.lit(word)).bitwiseAND(F.lit(bits)) != 0)
        return F.when(mask.isNotNull(), held)

    def marked(self, mask: Column, mark: str) -> Column:
        """Whether a term with this mark occurs; null for a null text."""
        return self._any(mask, [n for n, t in enumerate(self.terms) if mark in t.marks])

    def listed(self, mask: Column, mark: str) -> Column:
        """The texts of the terms with this mark that occur, in the lexicon's order."""
        found = [F.when(self._any(mask, [n]), F.lit(t.text)) for n, t in enumerate(self.terms) if mark in t.marks]
        return F.when(mask.isNotNull(), F.array_compact(F.array(*found)))
