"""WordPiece tokens of a text, and an encoder that reads long texts in windows of tokens.

The rules are those published for BERT: words end at white space, every punctuation mark and
every CJK ideograph is a word of its own, accents and case are dropped, control characters
vanish.  A word becomes the longest pieces that a vocabulary holds, from left to right; pieces
after the first carry ``##``.  A word that cannot be covered, or is too long, is one unknown token.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Sequence

import numpy as np
import regex

from evidenza.functions.encoders import ENCODER_BATCH

# Fixed values of the published rules.
UNKNOWN = "[UNK]"
CONTINUED = "##"
MAX_WORD_CHARS = 100
#: 512 positions, of which a model's start and end marks take two.
MAX_TOKENS = 510
# Fixed classes, in a form that Python's regex, Java and RE2 read alike.
PUNCTUATION = r"\p{P}$+<=>^`|~"
IDEOGRAPHS = (
    r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}"
    r"\x{2B740}-\x{2B81F}\x{2B820}-\x{2CEAF}\x{F900}-\x{FAFF}\x{2F800}-\x{2FA1F}"
)
WORD = rf"[{PUNCTUATION}{IDEOGRAPHS}]|[^ \t\r\n\p{{Z}}{PUNCTUATION}{IDEOGRAPHS}]+"

_WORD = regex.compile(regex.sub(r"\\x\{(\w+)\}", lambda m: rf"\U{int(m[1], 16):08x}", WORD), regex.V0)
_DROPPED = regex.compile(r"[\p{Mn}\p{C}]+")
_END = ""


def plain(word: str) -> str:
    """The word without accents, control characters and case."""
    if word.isascii() and word.isprintable():
        return word.lower()
    return _DROPPED.sub("", unicodedata.normalize("NFD", _DROPPED.sub("", word)).lower())


class WordPiece:
    """Greedy longest match over two tries of pieces: first ones, and those that go on."""

    # words that are remembered from text to text, each of at most max_word_chars; beyond that the memory starts anew
    cache_limit = 1 << 16

    def __init__(self, pieces: Iterable[str], unknown: str = UNKNOWN, max_word_chars: int = MAX_WORD_CHARS):
        self.unknown = unknown
        self.max_word_chars = max_word_chars
        self._first: dict = {}
        self._later: dict = {}
        self._known: dict[str, tuple[str, ...]] = {}
        for piece in pieces:
            later = piece.startswith(CONTINUED) and len(piece) > len(CONTINUED)
            node = self._later if later else self._first
            for sign in piece[len(CONTINUED) :] if later else piece:
                node = node.setdefault(sign, {})
            if node is not self._first:
                node[_END] = piece

    def match(self, word: str) -> tuple[str, ...]:
        """Pieces of a plain word; none for an empty one."""
        if len(word) > self.max_word_chars:
            return (self.unknown,)
        found, at, trie = [], 0, self._first
        while at < len(word):
            node, longest, stop = trie, None, at
            for i in range(at, len(word)):
                node = node.get(word[i])
                if node is None:
                    break
                if _END in node:
                    longest, stop = node[_END], i + 1
            if longest is None:
                return (self.unknown,)
            found.append(longest)
            at, trie = stop, self._later
        return tuple(found)

    def pieces(self, word: str) -> tuple[str, ...]:
        found = self._known.get(word)
        if found is None:
            found = self.match(plain(word))
            if len(word) <= self.max_word_chars:
                if len(self._known) >= self.cache_limit:
                    self._known.clear()
                self._known[word] = found
        return found

    def tokens(self, text: str) -> list[str]:
        """All tokens of a whole text."""
        return [piece for word in _WORD.findall(text) for piece in self.pieces(word)]

    def windows(self, text: str, max_tokens: int = MAX_TOKENS) -> list[tuple[int, int, int, int]]:
        """(start, stop, words, tokens) of stretches of ``text`` with at most ``max_tokens`` tokens.

        Every word lies in one window, and a window takes as many words as fit.  Only a word that
        alone has more tokens is over the limit; it stands alone.  Text without a word has no window.
        """
        found: list[tuple[int, int, int, int]] = []
        start = stop = words = tokens = 0
        for word in _WORD.finditer(text):
            n = len(self.pieces(word.group()))
            if not n:
                continue
            if words and tokens + n > max_tokens:
                found.append((start, stop, words, tokens))
                words = tokens = 0
            if not words:
                start = word.start()
            stop, words, tokens = word.end(), words + 1, tokens + n
        if words:
            found.append((start, stop, words, tokens))
        return found


class TokenWindows:
    """An encoder that reads whole texts through another one with a limit of tokens.

    The vector of a text is the mean of its windows, weighed by their tokens.  A text without
    a word is handed on as it is.
    """

    def __init__(self, encoder, tokenizer: WordPiece, max_tokens: int = MAX_TOKENS):
        self.encoder = encoder
        self.tokenizer = tokenizer
        self.max_tokens = max_tokens
        self.batch_size = getattr(encoder, "batch_size", ENCODER_BATCH)

    def encode_batch(self, texts: Sequence[str]) -> np.ndarray:
        sums: list = [None] * len(texts)
        totals = np.zeros(len(texts))
        waiting: list[tuple[int, str, int]] = []
        for i, text in enumerate(texts):
            stretches = self.tokenizer.windows(text, self.max_tokens) or [(0, len(text), 0, 1)]
            for start, stop, _, n in stretches:
                waiting.append((i, text[start:stop], n))
                if len(waiting) == self.batch_size:
                    self._add(waiting, sums, totals)
        self._add(waiting, sums, totals)
        return np.array([s / n for s, n in zip(sums, totals, strict=True)])

    def _add(self, waiting: list[tuple[int, str, int]], sums: list, totals: np.ndarray) -> None:
        if not waiting:
            return
        vectors = self.encoder.encode_batch([window for _, window, _ in waiting])
        for (i, _, n), vector in zip(waiting, vectors, strict=True):
            weighed = np.asarray(vector, np.float64) * n
            sums[i] = weighed if sums[i] is None else sums[i] + weighed
            totals[i] += n
        waiting.clear()
