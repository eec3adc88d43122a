"""Sentence splitting and overlapping chunks, entirely JVM-side."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from evidenza.functions.text import let, strip

# Abbreviations whose full stop does not end a sentence; pass to ``sentences``.
ENGLISH_ABBREVIATIONS = (
    "Dr", "Mr", "Mrs", "Ms", "Prof", "St", "No", "Fig", "vs", "etc", "al", "e.g", "i.e", "approx", "U.S", "U.N",
)

_BREAK = "\x01"
_KEPT_STOP = "\x02"


def sentences(text: Column, abbreviations: Sequence[str] = ()) -> Column:
    """Array of sentences: a break is ``. ! ?`` followed by whitespace."""
    marked = strip(text)
    if abbreviations:
        names = "|".join(re.escape(a) for a in abbreviations)
        marked = F.regexp_replace(marked, rf"\b({names})\.(?=[ \t\r\n])", rf"$1{_KEPT_STOP}")
    marked = F.regexp_replace(marked, r"([.!?])[ \t\r\n]+", f"$1{_BREAK}")
    found = F.split(marked, _BREAK)
    if abbreviations:
        found = F.transform(found, lambda s: F.replace(s, F.lit(_KEPT_STOP), F.lit(".")))
    return F.filter(found, lambda s: s != "")


def chunks(sentence_list: Column, size: int = 3, overlap: int = 1) -> Column:
    """Sliding windows of ``size`` sentences that share ``overlap`` sentences.

    The last window may lie wholly inside the one before it; blank windows are
    removed.
    """
    step = max(1, size - overlap)

    def windows(parts: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(parts) - 1, F.lit(0)), F.lit(step))
        return F.transform(starts, lambda i: F.array_join(F.slice(parts, i + 1, F.lit(size)), " "))

    # an empty list yields one blank window, which is removed with the others
    return F.filter(let(sentence_list, windows), lambda c: strip(c) != "")
