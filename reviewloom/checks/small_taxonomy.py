"""Rules of words that do occur in the provided documents, for the same tagger."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewloom.operators.tagging import found
from reviewloom.operators.taxonomy import Rule


def word(*words: str) -> str:
    """Whole words by letter neighbours, which reads alike in Java and in RE2."""
    return r"(?:^|[^\p{L}\p{N}_])(?:" + "|".join(words) + r")(?:$|[^\p{L}\p{N}_])"


def of(family: str, main: str, sub: str, order: int, *words: str) -> Rule:
    return Rule(family, main, sub, order, word(*words), words)


RULES = [
    of("scene", "English", "the_of", 0, "the of", "of the"),
    of("scene", "English", "with_that", 1, "with that", "that with"),
    of("scene", "English", "with_that", 1, "with it"),
    of("scene", "French", "les_des", 2, "les des", "des les"),
    of("scene", "German", "der_und", 3, "der und", "und der"),
    of("scene", "Spanish", "que_los", 4, "que los", "los que"),
    of("friction", "Legal", "License", 0, "license", "copyright"),
    of("friction", "Legal", "Rights", 1, "rights", "warranty"),
    Rule("friction", "Noise", "Numbers", 2, r"[0-9]{4}"),
    Rule("friction", "Noise", "Symbols", 3, r"[#*%]{3}"),
    of("friction", "Tone", "Disappointment", 4, "was", "no"),
    of("motivation", "Short", "is_it", 0, "is it", "it is"),
    of("motivation", "Short", "for_as", 1, "for as", "as for"),
    of("motivation", "Long", "from_this", 2, "from this", "this from"),
    of("time", "Early", "Early", 0, "at the", "by the"),
    of("time", "Late", "Late", 1, "on the"),
    of("location", "Inside", "Inside", 0, "in the", "into"),
    of("location", "Outside", "Outside", 1, "out", "from the"),
]

WITHDRAW_LICENSE = word("free", "under")
WITHDRAW_NUMBERS = word("the")


def withdraw(text: Column, rating: Column) -> dict[str, Column]:
    return {
        "License": F.coalesce(rating >= 4, F.lit(False)) & found(text, WITHDRAW_LICENSE),
        "Numbers": found(text, WITHDRAW_NUMBERS),
    }
