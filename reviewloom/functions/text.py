"""Text and key expressions. All of them are built-in column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Entity decoding order, quote folding, URL and file-name formats.
ENTITIES = (
    ("&nbsp;", " "),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
)
SINGLE_QUOTES = "‘’´`"
DOUBLE_QUOTES = "“”"
REVIEW_ID_FORMAT = "/customer-reviews/([^/]+)/ref"
PRODUCT_IN_NAME = "\\(([^)]*)\\)"

# Unicode white space plus the four ASCII separators that count as blanks in the landing data.
BLANKS = "(?U)[\\s\\x1C-\\x1F]+"


def only_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def clean_text(text: Column) -> Column:
    """Strip tags, decode entities in order, straighten quotes, collapse blanks. NULL gives ''.

    A text of ASCII characters without tags and entities has at most back quotes to straighten.
    """
    raw = F.coalesce(text, F.lit(""))
    untagged = F.regexp_replace(raw, "<[^>]*>", " ")
    decoded = reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), ENTITIES, untagged)
    folded = F.translate(
        decoded,
        SINGLE_QUOTES + DOUBLE_QUOTES,
        "'" * len(SINGLE_QUOTES) + '"' * len(DOUBLE_QUOTES),
    )
    simple = only_ascii(raw) & ~F.contains(raw, F.lit("<")) & ~F.contains(raw, F.lit("&"))
    straight = F.when(simple, F.replace(raw, F.lit("`"), F.lit("'"))).otherwise(folded)
    return F.trim(F.regexp_replace(straight, BLANKS, " "))


def review_id(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, REVIEW_ID_FORMAT, 1), F.lit(""))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def asin_from_path(path: Column) -> Column:
    return F.substring_index(file_name(path), "-", 1)


def product_from_name(path: Column) -> Column:
    """Text between the first pair of parentheses of the file name."""
    return F.regexp_extract(file_name(path), PRODUCT_IN_NAME, 1)


def review_key(asin: Column, rid: Column) -> Column:
    return F.concat_ws("_", asin, rid)


def title_and_content(title: Column, content: Column) -> Column:
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(content, F.lit("")))


def blank_to_space(text: Column) -> Column:
    """What an encoder receives: trimmed text, or one space where there is none."""
    return F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit(" "))


def title_bullets(title: Column, bullets: Column) -> Column:
    return F.concat_ws(";", title, bullets)


def ordered_label(text: Column, rules: tuple[tuple[str, tuple[str, ...]], ...], default: str) -> Column:
    """First rule, in order, one of whose terms occurs in ``text``."""
    tests = [(label, reduce(lambda a, b: a | b, [F.contains(text, F.lit(t)) for t in terms])) for label, terms in rules]
    chain = F.when(tests[0][1], F.lit(tests[0][0]))
    for label, test in tests[1:]:
        chain = chain.when(test, F.lit(label))
    return chain.otherwise(F.lit(default))


# Light-type labels, tested in this order on the lower-cased title and bullets.
LIGHT_TYPES = (
    ("FIR", ("far infrared", "far-infrared")),
    ("RLT", ("red light", "red-light")),
    ("Infrared_Only", ("infrared",)),
)


def light_type(text: Column) -> Column:
    return ordered_label(text, LIGHT_TYPES, "Other")
