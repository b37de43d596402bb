"""Multi-label tagging: rules first, centroid fallback where no rule label is left."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.keywords import keyword_bag
from reviewloom.functions.scalars import signal
from reviewloom.operators import taxonomy as tax
from reviewloom.operators.vectors import decide, nearest

# Python's default for text patterns: any case, Unicode classes.
FLAGS = "(?iU)"

SCENE_TAGS = "array<struct<sub:string,main:string>>"
SCORED_TAGS = "array<struct<sub:string,main:string,source:string,score:double,margin:double>>"


def found(text: Column, pattern: str) -> Column:
    return text.rlike(FLAGS + pattern)


class Label(NamedTuple):
    """One label of a family: its patterns as one alternation, and words without which none can match."""

    main: str
    sub: str
    pattern: str
    hints: tuple[str, ...]


def label_patterns(rules: list[tax.Rule], family: str) -> list[Label]:
    """The labels of a family in test order."""
    grouped: dict[tuple[int, str, str], list[tax.Rule]] = {}
    for r in sorted((r for r in rules if r.family == family), key=lambda r: r.ord):
        grouped.setdefault((r.ord, r.main, r.sub), []).append(r)
    labels = []
    for (_, main, sub), members in grouped.items():
        hints = tuple(h for r in members for h in r.hints) if all(r.hints for r in members) else ()
        labels.append(Label(main, sub, "|".join(f"(?:{r.pattern})" for r in members), hints))
    return labels


# Non-ASCII letters that the case rules of the patterns treat as ASCII ones.
FOLD_FROM, FOLD_TO = "İıſ\u212a", "iisk"


def folded(text: Column) -> Column:
    """Text in the form that hints are searched in."""
    return F.lower(F.translate(text, FOLD_FROM, FOLD_TO))


def label_found(label: Label, text: Column, plain: Column) -> Column:
    """Whether the label's pattern occurs. A substring search per hint decides most texts."""
    hit = found(text, label.pattern)
    if not label.hints:
        return hit
    fold = str.maketrans(FOLD_FROM, FOLD_TO)
    likely = [F.contains(plain, F.lit(h.translate(fold).lower())) for h in label.hints]
    return reduce(lambda a, b: a | b, likely) & hit


def withdrawal_rules(text: Column, rating: Column, patterns: dict[str, str] | None = None) -> dict[str, Column]:
    """Per friction label, when a rule hit does not count. A missing rating never withdraws."""
    w = patterns or tax.WITHDRAWALS
    return {
        "Reliability_Issue": found(text, w["other_product"]),
        "Build_Quality": found(text, w["build_praise"]),
        "Device_Handling": found(text, w["not_heavy"]),
        "Efficacy_Ambiguity": found(text, w["did_not_work"]) & found(text, w["breakage"]),
        "Posture_Burden": ~found(text, w["neck_cause"]),
        "Battery_Life": found(text, w["battery_praise"]),
        "Price_Shock": F.coalesce(rating >= 4, F.lit(False)) & found(text, w["value_praise"]),
        "Thermal_Discomfort": found(text, w["not_hot"]),
    }


def rule_hits(text: Column, plain: Column, labels: list[Label], unless: dict[str, Column] | None = None) -> Column:
    """Sorted array of (sub, main) whose pattern is found and not withdrawn.

    The withdrawal test stands behind the hit test, so it runs only on rows that hit.
    """
    unless = unless or {}
    tags = []
    for label in labels:
        hit = label_found(label, text, plain)
        if label.sub in unless:
            hit = hit & ~unless[label.sub]
        tags.append(F.when(hit, F.struct(F.lit(label.sub).alias("sub"), F.lit(label.main).alias("main"))))
    if not tags:
        return F.array().cast(SCENE_TAGS)
    return F.array_sort(F.array_compact(F.array(*tags)))


def plain_hits(text: Column, plain: Column, labels: list[Label]) -> Column:
    """Labels found, in test order (times and places)."""
    if not labels:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(label_found(x, text, plain), F.lit(x.sub)) for x in labels]))


def tag_reviews(
    reviews: DataFrame,
    rules: list[tax.Rule] | None = None,
    centroids: dict[str, list[tuple[str, list]]] | None = None,
    key: str = "Review_ID",
    text: str = "Clean_Text",
    rating: str = "Rating",
    vector: str | None = None,
    forms: dict[str, str] | None = None,
    withdraw: Callable[[Column, Column], dict[str, Column]] | None = None,
    withdrawals: dict[str, str] | None = None,
) -> DataFrame:
    """One row per review: key, status, error, five tag arrays and the keyword bag.

    ``centroids`` maps a family to (sub, vector) pairs in label order; without it, or without a vector
    column, only rules apply. ``withdraw`` replaces the friction withdrawal rules,
    ``withdrawals`` (of ``load_withdrawals``) only their patterns. Blank text gets no tags and an empty keyword bag and counts as processed.
    """
    rules = tax.starter_rules() if rules is None else rules
    centroids = centroids if centroids and vector else {}
    main_of = {f: {x.sub: x.main for x in label_patterns(rules, f)} for f in tax.FAMILIES}

    body, plain, stars = F.col("_text"), F.col("_plain"), F.col("_rating")
    base = reviews.select(
        key,
        F.trim(F.coalesce(F.col(text), F.lit(""))).alias("_text"),
        F.col(rating).alias("_rating"),
        (F.col(vector) if vector else F.lit(None).cast("array<float>")).alias("_vector"),
    ).withColumn("_plain", folded(body))
    unless = {"friction": withdraw(body, stars) if withdraw else withdrawal_rules(body, stars, withdrawals)}
    # one projection per family keeps each generated method small
    hits = base
    for family in ("scene", "friction", "motivation"):
        hits = hits.withColumn(f"_{family}", rule_hits(body, plain, label_patterns(rules, family), unless.get(family)))
    for family in ("time", "location"):
        hits = hits.withColumn(f"_{family}", plain_hits(body, plain, label_patterns(rules, family)))

    blank = body == ""
    excluded = {"motivation": tax.NO_FALLBACK}
    guesses, errors = {}, []
    for family in ("scene", "friction", "motivation"):
        labels = [c for c in centroids.get(family, []) if c[0] not in excluded.get(family, ())]
        if labels:
            # rows that need no fallback send a NULL instead of their vector
            wanted = F.when((F.size(f"_{family}") == 0) & ~blank, F.col("_vector"))
            guesses[family] = nearest(wanted, labels).alias(f"_best_{family}")
    scored = hits.select("*", *guesses.values())
    errors = [F.col(f"_best_{f}")["error"] for f in guesses]
    error = F.coalesce(*errors) if errors else F.lit(None).cast("string")

    def guess(family: str, accept: Column | None = None) -> Column | None:
        if family not in guesses:
            return None
        best = F.col(f"_best_{family}")
        ok = decide(best, *tax.FALLBACK[family])
        ok = ok & accept if accept is not None else ok
        mains = F.create_map(*[F.lit(x) for pair in main_of[family].items() for x in pair])
        tag = F.struct(
            best["label"].alias("sub"),
            F.try_element_at(mains, best["label"]).alias("main"),
            F.lit("Embedding").alias("source"),
            signal(best["score"]).alias("score"),
            signal(best["margin"]).alias("margin"),
        )
        return F.when(ok, F.array(tag)).otherwise(F.array().cast(SCORED_TAGS))

    def tags(family: str, accept: Column | None = None) -> Column:
        by_rule = F.transform(
            F.col(f"_{family}"),
            lambda t: F.struct(
                t["sub"].alias("sub"),
                t["main"].alias("main"),
                F.lit("Regex").alias("source"),
                F.lit(None).cast("double").alias("score"),
                F.lit(None).cast("double").alias("margin"),
            ),
        )
        fallback = guess(family, accept)
        return by_rule if fallback is None else F.concat(by_rule, fallback)

    # a vetoed best label is dropped; the runner-up does not take its place
    veto = F.coalesce(stars == 5, F.lit(False)) & F.col("_best_friction")["label"].isin(*tax.VETO_AT_FIVE) if "friction" in guesses else None
    frictions = tags("friction", ~veto if veto is not None else None)
    # the last withdrawal follows the fallback and may leave the review without a friction
    content = F.coalesce(stars == 5, F.lit(False)) & found(body, (withdrawals or tax.WITHDRAWALS)["overall_praise"])
    frictions = F.filter(frictions, lambda t: (t["sub"] != "Disappointment") | ~content)

    failed = error.isNotNull()
    empty = F.array()

    def unless_failed(col: Column, kind: str) -> Column:
        return F.when(failed | blank, empty.cast(kind)).otherwise(col)

    return scored.select(
        key,
        F.when(failed, F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("status"),
        error.alias("error"),
        unless_failed(F.transform(tags("scene"), lambda t: F.struct(t["sub"].alias("sub"), t["main"].alias("main"))), SCENE_TAGS).alias("scenes"),
        unless_failed(frictions, SCORED_TAGS).alias("frictions"),
        unless_failed(tags("motivation"), SCORED_TAGS).alias("motivations"),
        unless_failed(F.col("_time"), "array<string>").alias("times"),
        unless_failed(F.col("_location"), "array<string>").alias("locations"),
        F.when(failed, F.lit("")).otherwise(keyword_bag(body, forms=forms)).alias("keywords"),
    )


def bridges(tagged: DataFrame, key: str = "Review_ID") -> dict[str, DataFrame]:
    """The five long tables of a tagged frame; failed reviews have no rows."""
    def rows(column: str) -> DataFrame:
        # a filter by status, or a plain explode, would copy the tag expressions below a filter and run every pattern twice
        done = F.when(F.col("status") == "SUCCESS", F.col(column))
        return tagged.select(key, F.explode_outer(done).alias("t")).where(F.col("t").isNotNull())

    def scored(column: str, prefix: str) -> DataFrame:
        tag = F.col("t")
        return rows(column).select(
            key,
            *[tag[f].alias(f"{prefix}_{f.capitalize()}") for f in ("main", "sub", "source", "score", "margin")],
        )

    return {
        "scene_bridge": rows("scenes").select(
            key, F.col("t")["main"].alias("Main_Scene"), F.col("t")["sub"].alias("Sub_Scene")
        ),
        "friction_bridge": scored("frictions", "Friction"),
        "motivation_bridge": scored("motivations", "Motivation"),
        "time_bridge": rows("times").select(key, F.col("t").alias("Time_of_Day")),
        "location_bridge": rows("locations").select(key, F.col("t").alias("Location")),
    }


def run_summary(tagged: DataFrame) -> DataFrame:
    """One row: reviews, successes, failures and bridge rows per family."""
    ok = F.col("status") == "SUCCESS"
    per_family = [
        F.coalesce(F.sum(F.when(ok, F.size(c)).otherwise(0)), F.lit(0)).cast("bigint").alias(f"{c}_rows")
        for c in ("scenes", "frictions", "motivations", "times", "locations")
    ]
    return tagged.agg(
        F.count(F.lit(1)).alias("reviews"),
        F.count_if(ok).alias("success"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        *per_family,
    )


