"""Keyword bag of a text: lower-case words without stop words and numbers, mapped to base forms."""

from __future__ import annotations

import zlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.operators.keys import hot_keys, join_split
from reviewloom.session import has_at_most, materialise

# Short domain words that are kept although they have fewer than three letters or so.
DOMAIN_WORDS = ("ir", "fir", "led", "uv", "emf", "rf", "ems", "nmp", "red")

STOP_WORDS = tuple(
    """a about above after again all also am an and any are as at be because been before being below
    between both but by can could did do does doing down during each few for from further had has have
    having he her here hers him his how i if in into is it its itself just me more most my no nor not
    now of off on once only or other our out over own same she should so some such than that the their
    them then there these they this those through to too under until up us very was we were what when
    where which while who whom why will with would you your""".split()
)

NUMBER_WORDS = tuple(
    """zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty
    sixty seventy eighty ninety hundred thousand million""".split()
)

# Base forms used when no lemma table is given.
BASE_FORMS = {
    "pads": "pad", "masks": "mask", "lights": "light", "devices": "device", "panels": "panel",
    "knees": "knee", "joints": "joint", "muscles": "muscle", "pains": "pain", "aches": "ache",
    "wrinkles": "wrinkle", "lines": "line", "weeks": "week", "months": "month", "days": "day",
    "minutes": "minute", "hours": "hour", "used": "use", "uses": "use", "using": "use",
    "helped": "help", "helps": "help", "helping": "help", "worked": "work", "works": "work",
    "working": "work", "loved": "love", "loves": "love", "felt": "feel", "feels": "feel",
    "feeling": "feel", "bought": "buy", "buying": "buy", "got": "get", "gets": "get",
    "getting": "get", "broke": "break", "broken": "break", "heated": "heat", "heats": "heat",
    "heating": "heat", "returned": "return", "returns": "return", "charges": "charge",
    "charging": "charge", "better": "well", "best": "good",
}

# A word keeps the apostrophes inside it, so that contractions are seen whole.
WORD = "[\\p{L}\\p{N}]++(?:'\\p{L}++)*+"
# Contracted negations are function words like "not"; other contracted endings are cut off.
NEGATED = "n't"
ENDING = "'(?:s|re|ve|ll|d|m)$"

# Forms beyond which a table is no literal of the plan but a dictionary of the Python workers.
MAX_LITERAL_FORMS = 500
# Forms of a table that may be sent to every worker, some 20 MB.
MAX_SHARED_FORMS = 200_000

# Forms per bucket of a base-form table, whose lookup is linear inside a bucket.
FORMS_PER_BUCKET = 8


def keyword_list(
    text: Column,
    forms: dict[str, str] | None = None,
    stop_words: tuple[str, ...] = STOP_WORDS,
    keep: tuple[str, ...] = DOMAIN_WORDS,
) -> Column:
    """Words in text order with repeats, as an array."""
    forms = BASE_FORMS if forms is None else forms
    content = content_words(text, stop_words)
    if len(forms) > MAX_LITERAL_FORMS:
        based = _shared_forms(forms)(content)
    else:
        # few words have a base form, and a look into a set is cheaper than one into the table
        based = F.transform(content, lambda w: F.when(w.isin(*forms), F.coalesce(base_form(w, forms), w)).otherwise(w)) if forms else content
    return F.filter(based, lambda w: (F.length(w) >= 3) | w.isin(*keep))


def content_words(text: Column, stop_words: tuple[str, ...] = STOP_WORDS) -> Column:
    """Words in text order without stop words and numbers, as they stand in the text."""
    dropped = (*stop_words, *NUMBER_WORDS)
    plain = F.translate(F.lower(F.coalesce(text, F.lit(""))), "\u2019\u02bc", "''")
    words = F.regexp_extract_all(plain, F.lit(WORD), F.lit(0))
    # a lambda runs for every word of every text, so plain comparisons stand in front of the patterns
    cut = F.transform(
        words,
        lambda w: F.when(~F.contains(w, F.lit("'")), w).when(~w.endswith(NEGATED), F.regexp_replace(w, ENDING, "")),
    )
    lettered = lambda w: (w >= "a") & (w < "{")
    return F.filter(cut, lambda w: w.isNotNull() & ~w.isin(*dropped) & (lettered(w) | ~w.rlike("^\\p{N}+$")))


def keyword_bag(text: Column, **options) -> Column:
    return F.array_join(keyword_list(text, **options), ";")


def base_form(word: Column, forms: dict[str, str]) -> Column:
    """The form's base, or NULL: a literal table, split by the word's crc32 so that each part stays short."""
    buckets = -(-len(forms) // FORMS_PER_BUCKET)
    parts: list[list[str]] = [[] for _ in range(buckets)]
    for form, base in forms.items():
        parts[zlib.crc32(form.encode()) % buckets] += [form, base]
    empty = F.create_map().cast("map<string,string>")
    tables = F.array(*[F.create_map(*[F.lit(x) for x in part]) if part else empty for part in parts])
    return F.try_element_at(F.get(tables, (F.crc32(word.cast("binary")) % buckets).cast("int")), word)


def _shared_forms(forms: dict[str, str]):
    """Bases of arrays of words from a dictionary, in Arrow batches: each distinct word of a batch is looked up once."""

    @F.arrow_udf("array<string>")
    def bases(words: pa.Array) -> pa.Array:
        if isinstance(words, pa.ChunkedArray):
            words = words.combine_chunks()
        coded = words.flatten().cast(pa.string()).dictionary_encode()
        mapped = pa.array([forms.get(w, w) for w in coded.dictionary.to_pylist()], pa.string())
        ends = pc.cumulative_sum(pc.fill_null(pc.list_value_length(words), 0).cast(pa.int32()))
        return pa.ListArray.from_arrays(pa.concat_arrays([pa.array([0], pa.int32()), ends]), mapped.take(coded.indices))

    return bases


def form_table(table: DataFrame) -> DataFrame:
    """(form, base), one row per lower-case form; of several bases the first in order counts."""
    known = table.where(F.col("form").isNotNull() & F.col("base").isNotNull())
    return known.groupBy(F.lower("form").alias("form")).agg(F.min("base").alias("base"))


def load_forms(table: DataFrame) -> dict[str, str]:
    """Base forms from a table (form, base) of bounded size; a larger one is for ``with_keywords``."""
    rows = form_table(table).limit(MAX_SHARED_FORMS + 1).collect()
    if len(rows) > MAX_SHARED_FORMS:
        raise ValueError(f"more than {MAX_SHARED_FORMS} forms: use with_keywords")
    return {r.form: r.base for r in rows}


def with_keywords(
    rows: DataFrame, key: str, text: str, table: DataFrame, out: str = "keywords", shared: int = MAX_SHARED_FORMS, keep: tuple[str, ...] = DOMAIN_WORDS
) -> DataFrame:
    """Adds ``out``, the keyword bag under a base-form table (form, base) of any size; ``key`` is unique in ``rows``.

    The table meets the distinct words of the texts, so a frequent word is joined once. What it has for them goes to
    the workers as a dictionary where it is small; beyond that the words themselves are joined, frequent ones apart.
    """
    words = rows.select(key, content_words(F.col(text)).alias("_words"))
    seen = words.select(F.explode("_words").alias("form")).distinct()
    found = materialise(seen.join(form_table(table), "form"), "forms")
    if has_at_most(found, shared):
        forms = {r.form: r.base for r in found.collect()}
        return rows.withColumn(out, keyword_bag(F.col(text), forms=forms, keep=keep))
    each = materialise(words.select(key, F.posexplode("_words").alias("pos", "form")), "words")
    missing = each.join(found, "form", "left_anti").select(key, "pos", F.col("form").alias("base"))
    based = join_split(each, found, "form", hot_keys(each, "form")).select(key, "pos", "base").unionByName(missing)
    kept = based.where((F.length("base") >= 3) | F.col("base").isin(*keep))
    in_order = F.array_sort(F.collect_list(F.struct("pos", "base")))
    bags = kept.groupBy(key).agg(F.array_join(in_order["base"], ";").alias(out))
    return rows.join(bags, key, "left").withColumn(out, F.coalesce(out, F.lit("")))
