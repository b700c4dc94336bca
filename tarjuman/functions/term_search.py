"""Replacement of many terms: one automaton finds which of them occur at all.

The meaning is that of a pattern per term, longest first: terms apply one after the
other, to the output of those before. A term that does not occur changes nothing, so
only terms that the automaton finds are applied, in their order. Where a term is replaced,
the surroundings of the new text are searched again: later terms may have come about.
"""

import heapq
import unicodedata
from collections.abc import Callable, Collection
from functools import lru_cache
from zlib import crc32

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed value: the one character whose single lower case its full lower case hides.
DOTTED_I = "İ"
# Fixed value: the one folded character that stands for letters and for a mark, which is no word.
MIXED = "ι"
SLOTS = 1 << 16
#: Up to so many words are searched one by one, without an automaton.
FEW = 8


@lru_cache(maxsize=4096)
def folded(c: str) -> str:
    """The character that stands for ``c`` when case is ignored, always a single one."""
    upper = c.upper() if len(c.upper()) == 1 else c
    return "i" if upper == DOTTED_I else upper.lower() if len(upper.lower()) == 1 else upper


def fold(text: str) -> str:
    return text.lower() if text.isascii() else "".join(map(folded, text))


@lru_cache(maxsize=4096)
def is_word(c: str) -> bool:
    return c == "_" or unicodedata.category(c)[0] in "LN"


class TermSearch:
    """Replaces ``terms``, given in the order in which they apply."""

    def __init__(self, terms: list[tuple[str, str]], reach: int | None = None):
        """``reach`` is the length of the longest term, also of those that are not here."""
        self.terms = terms
        self.words = [fold(term) for term, _ in terms]
        self.reach = max(map(len, self.words), default=0) if reach is None else reach
        # Terms that differ in case only: the first changes every occurrence, but a
        # replacement may bring the word back for the next.
        ranks: dict[str, list[int]] = {}
        for rank, word in enumerate(self.words):
            ranks.setdefault(word, []).append(rank)
        self.ranks = ranks
        if len(ranks) > FEW:
            import ahocorasick

            self.finder = ahocorasick.Automaton()
            for word, own in ranks.items():
                self.finder.add_word(word, own)
            self.finder.make_automaton()

    def found(self, text: str) -> set[int]:
        """Ranks of the terms that occur, whole words or not."""
        if len(self.ranks) <= FEW:
            return {rank for word, ranks in self.ranks.items() if word in text for rank in ranks}
        return {rank for _, ranks in self.finder.iter(text) for rank in ranks}

    def _places(self, text: str, word: str, term: str) -> list[int]:
        """Where ``term`` stands between word boundaries, from left to right without overlap."""
        places, at, size = [], 0, len(word)
        first, last = is_word(term[0]), is_word(term[-1])
        lower = fold(text)
        while (at := lower.find(word, at)) >= 0:
            before = at > 0 and is_word(text[at - 1])
            after = at + size < len(text) and is_word(text[at + size])
            if before != first and after != last:
                places.append(at)
                at += size
            else:
                at += 1
        return places

    def replace(self, text: str, changed: Callable[[str, int, int], None] | None = None) -> str:
        """``changed`` is told every text that a term leaves, and the range that may hold new
        terms; ``used`` names the terms that applied."""
        todo = sorted(self.found(fold(text)))
        done = -1
        self.used: list[str] = []
        while todo:
            rank = heapq.heappop(todo)
            if rank <= done:
                continue
            done = rank
            term, replacement = self.terms[rank]
            places = self._places(text, self.words[rank], term)
            if not places:
                continue
            self.used.append(term)
            parts, near, at = [], [], 0
            for place in places:
                parts += [text[at:place], replacement]
                near.append(sum(map(len, parts[-2:])) + (near[-1] if near else 0))
                at = place + len(term)
            text = "".join([*parts, text[at:]])
            for end in near:
                low, high = max(0, end - len(replacement) - self.reach), min(len(text), end + self.reach)
                if changed:
                    changed(text, low, high)
                around = text[low:high]
                for other in self.found(fold(around)):
                    if other > done:
                        heapq.heappush(todo, other)
        return text


def edges(text: str, lower: str) -> tuple[list[int], set[int]]:
    """Where a term may start, and where it may end: at word boundaries, as ``_places`` wants them."""
    starts, ends, before = [], set(), False
    for at, c in enumerate(text):
        word = is_word(c)
        if word != before:
            starts.append(at)
            ends.add(at)
        else:
            if lower[at] == MIXED:
                starts.append(at)
            if at and lower[at - 1] == MIXED:
                ends.add(at)
        before = word
    if text and (before or lower[-1] == MIXED):
        ends.add(len(text))
    return starts, ends


def words_within(
    text: str, lengths: Collection[int], slots: Collection[int], low: int = 0, high: int | None = None,
) -> set[str]:
    """The folded words between ``low`` and ``high`` that a list of terms with these
    lengths and slots may hold."""
    high, lower, found = len(text) if high is None else high, fold(text), set()
    # Characters beside the range tell the boundaries of what is in it.
    first = max(0, low - 1)
    starts, ends = edges(text[first:high + 1], lower[first:high + 1])
    for start in starts:
        start += first
        if start < low:
            continue
        for length in lengths:
            end = start + length
            if end <= high and end - first in ends:
                word = lower[start:end]
                if slot(word) in slots:
                    found.add(word)
    return found


def slot(word: str) -> int:
    """One of a fixed number of classes of words, so that most words need no search."""
    return crc32(f"{len(word)} {word[:2]}{word[-1:]}".encode()) % SLOTS


_KNOWN: dict[int, TermSearch] = {}


def searched_terms(text: Column, terms: list[tuple[str, str]]) -> Column:
    """``text`` with the terms replaced. The list is a setting that every worker holds."""
    shared = SparkSession.active().sparkContext.broadcast(terms)
    own = hash(tuple(terms))

    def replace(texts: pd.Series) -> pd.Series:
        if own not in _KNOWN:
            _KNOWN.clear()
            _KNOWN[own] = TermSearch(shared.value)
        known = _KNOWN[own]
        return texts.map(lambda t: known.replace(t) if isinstance(t, str) else None)

    return F.pandas_udf(replace, "string")(text)
