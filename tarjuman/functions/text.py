"""Cleaning, term normalisation and content flags, all as native expressions."""

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarjuman import fixed
from tarjuman.functions.term_search import fold, searched_terms

#: From how many terms on one automaton is cheaper than a pattern per term.
LONGEST_CHAIN = 64


def strip_control(text: Column) -> Column:
    """Drop control characters, keeping tab, newline and carriage return."""
    return F.regexp_replace(text, f"[{fixed.CONTROL}]+", "")


def collapse_blanks(text: Column) -> Column:
    """Each run of spaces and tabs becomes one space."""
    return F.regexp_replace(text, r"[ \t]+", " ")


def collapse_newlines(text: Column) -> Column:
    """Newlines with only whitespace between them become one empty line."""
    return F.regexp_replace(text, f"\n[{fixed.WHITESPACE}]*\n", "\n\n")


def trim_text(text: Column) -> Column:
    """Strip Unicode whitespace from both ends, in time linear in the blanks removed."""
    return F.trim(text, F.lit(fixed.WHITESPACE_CHARS))


def clean_text(text: Column) -> Column:
    """Control characters, blanks, empty lines, ends; null becomes an empty string."""
    cleaned = trim_text(collapse_newlines(collapse_blanks(strip_control(text))))
    return F.coalesce(cleaned, F.lit(""))


def ordered_terms(custom: Mapping[str, str] | None = None) -> list[tuple[str, str]]:
    """Default terms overridden by ``custom``, longest first, ties in insertion order."""
    terms = {**fixed.TERM_REPLACEMENTS, **(custom or {})}
    return sorted(((t, r) for t, r in terms.items() if t), key=lambda item: -len(item[0]))


# Word boundaries spelled out: what java.util.regex counts as a word changes with
# its flags and version, and includes marks that are no letters.
# A letter beyond the basic plane, written out, makes lookbehind step over pairs.
_BEFORE = f"[{fixed.WORD}\U00010400]"
NO_WORD_BEFORE = f"(?<!{_BEFORE})"
NO_WORD_AFTER = f"(?![{fixed.WORD}])"
BOUNDARY = f"(?:{NO_WORD_BEFORE}(?=[{fixed.WORD}])|(?<={_BEFORE}){NO_WORD_AFTER})"


def _starts(words: Iterable[str]) -> str:
    """A lookahead for the first characters of ``words``, case ignored.

    Testing one character against a small set is what makes the patterns below
    cheap at the positions where nothing matches.
    """
    first = {fold(word[0]) for word in words}
    if not all(c.isascii() for c in first):
        return ""
    chars = "".join(fixed.FOLDED.get(c, c + c.upper() if c.isalpha() else c) for c in sorted(first))
    return f"(?=[{re.escape(chars)}])"


def _guard(terms: list[tuple[str, str]]) -> str:
    """A pattern that finds something wherever some term matches, whole word or not."""
    words: list[str] = []
    for word in sorted({fold(term) for term, _ in terms}, key=len):
        if not any(known in word for known in words):
            words.append(word)
    return f"{_starts(words)}(?iu:{'|'.join(re.escape(word) for word in words)})"


def _whole_word(term: str) -> str:
    """A pattern for ``term``, in any case, between word boundaries."""
    def is_word(c: str) -> bool:
        return c.isalnum() or c == "_"

    before = NO_WORD_BEFORE if is_word(term[0]) else f"(?<={_BEFORE})"
    after = NO_WORD_AFTER if is_word(term[-1]) else f"(?=[{fixed.WORD}])"
    return f"{_starts([term])}{before}(?iu:{re.escape(term)}){after}"


def normalize_terms(text: Column, custom: Mapping[str, str] | None = None) -> Column:
    """Replace provider terms, as whole words and in any case.

    Replacements run one after the other, so a later term sees earlier output.
    The chain sits behind one cheap search: most cells hold no term at all. A long
    list of terms is searched for by one automaton instead.
    """
    terms = ordered_terms(custom)
    if len(terms) > LONGEST_CHAIN:
        return searched_terms(text, terms)
    return chained_terms(text, terms)


def chained_terms(text: Column, terms: list[tuple[str, str]]) -> Column:
    """One pattern per term, in order."""
    replaced = text
    for term, replacement in terms:
        literal = replacement.replace("\\", "\\\\").replace("$", "\\$")
        replaced = F.regexp_replace(replaced, _whole_word(term), literal)
    return F.when(text.rlike(_guard(terms)), replaced).otherwise(text)


def preprocess(
    text: Column, terms: bool = True, custom: Mapping[str, str] | None = None
) -> Column:
    """What a provider is given for a cell."""
    cleaned = clean_text(text)
    return normalize_terms(cleaned, custom) if terms else cleaned


def contains_code(text: Column) -> Column:
    start = "".join(sorted({word[0] for word in fixed.CODE_WORDS.split("|")}))
    words = f"(?=[{start}]){NO_WORD_BEFORE}(?:{fixed.CODE_WORDS}){NO_WORD_AFTER}"
    return text.contains(fixed.CODE_FENCE) | text.rlike(words)


def contains_urls(text: Column) -> Column:
    plain, secure = fixed.URL_PREFIXES
    return text.contains(plain) | text.contains(secure)


def contains_emails(text: Column) -> Column:
    # The byte search for "@" spares most texts the pattern.
    return text.contains("@") & text.rlike(f"{BOUNDARY}{fixed.EMAIL}{BOUNDARY}")


def special_char_ratio(text: Column) -> Column:
    """Share of characters that are neither ASCII letters, digits nor whitespace."""
    ordinary = f"[a-zA-Z0-9{fixed.WHITESPACE}]+"
    special = F.length(F.regexp_replace(text, ordinary, ""))
    return special / F.greatest(F.length(text), F.lit(1))


def content_issues(text: Column) -> Column:
    """Names of the issues found, in a fixed order."""
    found = F.array(
        F.when(contains_code(text), F.lit("contains_code")),
        F.when(contains_urls(text), F.lit("contains_urls")),
        F.when(contains_emails(text), F.lit("contains_emails")),
        F.when(special_char_ratio(text) > fixed.SPECIAL_SHARE, F.lit("high_special_char_ratio")),
    )
    return F.array_compact(found)
