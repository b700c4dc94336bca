"""Acceptance checks of a reply and its normalisation."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarjuman import fixed
from tarjuman.functions.text import trim_text

CHECKS = ("not_empty", "has_arabic", "arabic_ratio_ok", "reasonable_length", "no_encoding_errors")


def has_script(text: Column, script: str = fixed.ARABIC) -> Column:
    """Whether any character lies in ``script``, a regular expression class body."""
    return text.rlike(f"[{script}]")


def script_ratio(text: Column, script: str = fixed.ARABIC) -> Column:
    """Share of ``script`` among the characters that are not whitespace."""
    others = F.regexp_replace(text, f"[{script}]+", "")
    inside = F.length(text) - F.length(others)
    if script == fixed.ARABIC:
        # No blank is in the script: only what is left of the text has any, mostly a small part.
        visible = inside + F.length(F.regexp_replace(others, f"[{fixed.WHITESPACE}]+", ""))
    else:
        visible = F.length(F.regexp_replace(text, f"[{fixed.WHITESPACE}]+", ""))
    return inside / F.greatest(visible, F.lit(1))


def has_mojibake(text: Column) -> Column:
    """Whether a trace of a wrong decoding occurs."""
    found = F.lit(False)
    for trace in fixed.MOJIBAKE:
        found = found | text.contains(trace)
    return found


def length_ratio(original_length: Column, reply: Column) -> Column:
    """Reply length over original length; null for an empty original."""
    return F.when(original_length > 0, F.length(reply) / original_length)


def quality_checks(
    original_length: Column, reply: Column, script: str = fixed.ARABIC
) -> dict[str, Column]:
    """The five checks by name; null where the reply is null."""
    in_range = length_ratio(original_length, reply).between(
        fixed.MIN_LENGTH_RATIO, fixed.MAX_LENGTH_RATIO
    )
    return {
        "not_empty": F.length(trim_text(reply)) >= fixed.MIN_REPLY_LENGTH,
        "has_arabic": has_script(reply, script),
        "arabic_ratio_ok": script_ratio(reply, script) >= fixed.MIN_SCRIPT_RATIO,
        "reasonable_length": (original_length == 0) | in_range,
        "no_encoding_errors": ~has_mojibake(reply),
    }


def is_valid(checks: dict[str, Column]) -> Column:
    """All checks hold; a missing reply is not valid."""
    verdict = F.lit(True)
    # The dearest check comes last: it is made only where the others hold.
    for name in sorted(checks, key=lambda name: name == "arabic_ratio_ok"):
        verdict = verdict & checks[name]
    return F.coalesce(verdict, F.lit(False))


def normalize_arabic(text: Column) -> Column:
    """Fold alef forms, collapse whitespace, strip the ends; null becomes empty."""
    folded = F.regexp_replace(text, fixed.ALEF_PATTERN, fixed.ALEF)
    # All runs of blanks but the single spaces, which stay as they are.
    blank = f"[{fixed.WHITESPACE}]"
    single = F.regexp_replace(folded, f"{blank}(?:(?<! ){blank}*|{blank}+)", " ")
    return F.coalesce(F.trim(single), F.lit(""))


def postprocess(reply: Column) -> Column:
    """What an accepted reply looks like in the output table."""
    return normalize_arabic(reply)
