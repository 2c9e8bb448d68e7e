"""Cleaning of single texts.  All of it stays in built-in expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from dialoom import fixed_values as fixed
from dialoom.functions.base import WHITESPACE_CLASS, hash_choice, let, strip, words


def any_of(phrases: Sequence[str]) -> str:
    """Pattern for any of the literal phrases; one class check skips most positions."""
    firsts = "".join(sorted({f"\\x{{{ord(p[0]):x}}}" for p in phrases}))
    return f"(?=[{firsts}])(?:{'|'.join(re.escape(p) for p in phrases)})"


def strip_phrases(text: Column, phrases: Sequence[str] = fixed.STRIP_PHRASES) -> Column:
    """Remove each phrase everywhere, one after the other, trimming after each.

    A text without any of the phrases is only trimmed; removal and trimming happen only
    for phrases that are there.
    """
    phrases = [p for p in phrases if p]
    if not phrases:
        return text

    def remove(acc: Column, phrase: Column) -> Column:
        return strip(F.replace(acc, phrase, F.lit("")))

    first = remove(text, F.lit(phrases[0]))
    later = F.array(*[F.lit(p) for p in phrases[1:]]).cast("array<string>")
    folded = F.aggregate(
        later,
        first,
        lambda acc, phrase: F.when(F.contains(acc, phrase), remove(acc, phrase)).otherwise(acc),
    )
    return F.when(F.rlike(text, F.lit(any_of(phrases))), folded).otherwise(strip(text))


def cut_at_marker(text: Column, markers: Sequence[str] = fixed.CUT_MARKERS) -> Column:
    """Keep what stands before the first of each marker."""
    if not markers:
        return text
    return F.aggregate(
        F.array(*[F.lit(m) for m in markers]),
        text,
        lambda acc, marker: F.when(
            F.contains(acc, marker),
            strip(F.call_function("substring_index", acc, marker, F.lit(1))),
        ).otherwise(acc),
    )


def section_pattern(headers: Sequence[str]) -> str:
    """A line that holds nothing but one of the headers, in any case."""
    listed = "|".join(re.escape(h) for h in headers)
    return f"(?imdu)^{WHITESPACE_CLASS}*(?:{listed}){WHITESPACE_CLASS}*\\n"


def cut_reference_sections(
    text: Column, headers: Sequence[str] = fixed.SECTION_HEADERS
) -> Column:
    pattern = section_pattern(headers)
    return let(
        text,
        lambda v: F.when(
            F.rlike(v, F.lit(pattern)), strip(F.get(F.split(v, pattern, 2), F.lit(0)))
        ).otherwise(v),
    )


def charset_share(text: Column, code_points: Sequence[int] = fixed.CODE_POINTS) -> Column:
    """Share of the characters that are ASCII or listed; null for an empty text."""
    listed = "".join(f"\\x{{{p:x}}}" for p in code_points)

    def share(v: Column) -> Column:
        others = F.length(F.regexp_replace(v, f"[\\x00-\\x7f{listed}]+", ""))
        total = F.length(v)
        # a text as long in bytes as in characters is pure ASCII
        return F.when(
            total > 0,
            F.when(F.octet_length(v) == total, F.lit(1.0)).otherwise(
                (total - others).cast("double") / total
            ),
        )

    return let(text, share)


def is_rejected(
    text: Column, phrases: Sequence[str] = fixed.REJECTION_PHRASES
) -> Column:
    """The phrases are regular expressions, joined as alternatives."""
    return F.coalesce(F.rlike(text, F.lit("|".join(phrases))), F.lit(False))


def match_capitalization(original: Column, replacement: Column) -> Column:
    """Capitalise the replacement if the original starts with an upper-case letter."""
    upper_first = F.rlike(original, F.lit(r"^\p{Lu}"))

    def cased(r: Column) -> Column:
        capital = F.concat(
            F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, F.lit(2), F.length(r)))
        )
        return F.when(upper_first, capital).otherwise(r)

    return let(replacement, cased)


def _fold_case(text: Column) -> Column:
    # letters whose case partners are ASCII letters, then plain lower case
    return F.lower(F.translate(text, "ıİſK", "iisk"))


def swap_phrases(
    text: Column,
    swaps: Mapping[str, Sequence[str]],
    seed: int,
    *identity: Column,
) -> Column:
    """Replace each phrase, in any case, by one of its alternatives.

    Phrases are taken in order and see the replacements made before.  Which
    alternative a match gets is a seeded hash of ``identity``, phrase and match number.
    """
    if not swaps:
        return text

    def swapped(old: Column, phrase: str, alternatives: Sequence[str]) -> Column:
        # a constant pattern is compiled once, and not at each text that holds the phrase
        pattern = F.lit("(?iu)" + re.escape(phrase))
        choices = F.array(*[F.lower(F.lit(a)) for a in alternatives])
        number = F.lit(len(alternatives))
        chosen = F.transform(
            F.regexp_extract_all(old, pattern, F.lit(0)),
            lambda match, k: match_capitalization(
                match,
                F.get(choices, hash_choice(number, seed, *identity, F.lit(phrase), k).cast("int")),
            ),
        )
        between = F.split(old, pattern, F.lit(-1))
        return F.array_join(
            F.zip_with(
                between, chosen, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))
            ),
            "",
        )

    def step(state: Column, phrase: str, alternatives: Sequence[str]) -> Column:
        return let(
            state,
            lambda acc: F.when(
                F.contains(acc["folded"], _fold_case(F.lit(phrase))),
                let(
                    swapped(acc["text"], phrase, alternatives),
                    lambda new: F.struct(new.alias("text"), _fold_case(new).alias("folded")),
                ),
            ).otherwise(acc),
        )

    # the folded text rides along, so that it is computed again only after a hit
    state = F.struct(text.alias("text"), _fold_case(text).alias("folded"))
    for phrase, alternatives in swaps.items():
        state = step(state, phrase, alternatives)
    return state["text"]


def truncate_tokens(text: Column, max_tokens: int) -> Column:
    """First ``max_tokens`` white-space tokens, joined by single spaces."""
    return F.array_join(F.slice(words(text), F.lit(1), F.lit(max_tokens)), " ")


def strip_ansi(text: Column) -> Column:
    return F.regexp_replace(text, fixed.ANSI_ESCAPE_PATTERN, "")


def clean_generated_prompt(
    output: Column, stop_markers: Sequence[str] = fixed.GENERATION_STOP_MARKERS
) -> Column:
    """The prompt inside raw model output, or null if the marker is missing."""
    marker = fixed.GENERATED_PROMPT_MARKER

    def extract(flat: Column) -> Column:
        prompt = F.substring_index(flat, marker, -1)
        for stop in stop_markers:
            prompt = F.substring_index(prompt, stop, 1)
        prompt = F.array_join(words(F.replace(prompt, F.lit("''"), F.lit(""))), " ")
        prompt = F.replace(prompt, F.lit(fixed.MOJIBAKE_APOSTROPHE), F.lit("_"))
        return F.when(F.contains(flat, F.lit(marker)), prompt)

    return let(F.translate(output, "\n", " "), extract)
