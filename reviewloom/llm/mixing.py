"""Mixing documents to target shares of domains, by soft membership, with DataFrame functions only.

A labelled table names the domain of some documents. A naive Bayes classifier over hashed words, fitted on a
bounded sample of these, gives every document a posterior over the domains. A document then counts towards
each domain by posterior times tokens (words), and projected-gradient least squares finds a non-negative
rate for each document such that the expected tokens of every domain match their targets. One step is one
pass over (tokens, posteriors) that adds up a number per domain; the rates themselves are never stored,
since they follow from the steps' gradients. A rate becomes whole copies by adding a hash of the id and
rounding down.

Targets are shares of the mix. Its size is set by the anchor domain, which keeps its own expected tokens.

Defined cases: a null text counts as empty; a text without words has the prior as posterior, no tokens, and
the rate its posterior gives; labels without id or domain, or of a domain without target, are left out, and
of several labels of one id the first in order of the targets counts; a domain without a labelled row among
the documents has no members, and its target is left open; without any labelled row all documents belong to the anchor. Every
input row gives one output row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import materialise, narrowed

BUCKETS = 1 << 14
# Labelled documents that the classifier is fitted on, at most.
BOUND = 4_000
STEPS = 40
TOLERANCE = 1e-4
# A count that every domain has for every bucket before any word is seen, as a share of all words' rate.
SMOOTH = 0.5
# Weight of the summed evidence per square root of a text's words.
SHARP = 4.0
# Log prior of a domain without labelled rows.
ABSENT = -1e9

_SEPARATORS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def word_buckets(text: Column, buckets: int = BUCKETS) -> Column:
    """Hash bucket of every word; words are runs of letters and digits in lower case."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _SEPARATORS), lambda w: w != "")
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))


class Membership:
    """Log weights per word bucket and domain, and log priors; both of a size that the parameters fix."""

    def __init__(self, domains: list[str], weights: list[list[float]], priors: list[float]):
        self.domains = domains
        self.weights = weights
        self.priors = priors

    @staticmethod
    def fit(docs: DataFrame, labelled: DataFrame, domains: list[str], buckets: int = BUCKETS, bound: int = BOUND) -> Membership:
        """Naive Bayes from at most ``bound`` of the ``docs`` in ``labelled`` (doc_id, domain), those whose ids hash lowest.

        Priors and words are counted over the same rows: labels of documents that ``docs`` does not hold say nothing.
        """
        order = F.array_position(F.array(*[F.lit(d) for d in domains]), F.col("domain"))
        rows = narrowed(labelled, "doc_id", "domain").where(F.col("doc_id").isNotNull() & F.col("domain").isin(*domains))
        chosen = rows.withColumn("k", order - 1).groupBy("doc_id").agg(F.min("k").alias("k"))
        chosen = chosen.join(narrowed(docs, "doc_id"), "doc_id", "left_semi")
        chosen = materialise(chosen.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(bound), "members")
        texts = narrowed(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id")
        words = texts.select("k", F.explode(word_buckets(F.col("text"), buckets)).alias("bucket"))
        per_bucket = materialise(
            words.groupBy("bucket").agg(*[F.count(F.when(F.col("k") == k, 1)).alias(f"n{k}") for k in range(len(domains))]), "buckets"
        )
        totals = per_bucket.agg(*[F.coalesce(F.sum(f"n{k}"), F.lit(0)).alias(f"n{k}") for k in range(len(domains))]).first()
        counts = {r.k: r["count"] for r in texts.groupBy("k").count().collect()}
        seen = sum(counts.values())
        every = sum(totals)
        # the logarithm of a domain's smoothed rate of each bucket, relative to the first domain's
        rate_all = sum(F.col(f"n{k}") for k in range(len(domains))) + 1

        def rate(k: int) -> Column:
            mass = SMOOTH * buckets
            return (F.col(f"n{k}") + mass * rate_all / float(every + buckets)) / float(totals[k] + mass)

        table = per_bucket.select("bucket", *[F.log(rate(k) / rate(0)).alias(f"w{k}") for k in range(1, len(domains))])
        every_bucket = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(table, "bucket", "left")

        def in_order(name: str) -> Column:
            listed = F.array_sort(F.collect_list(F.struct("bucket", F.coalesce(name, F.lit(0.0)).alias("w"))))
            return F.transform(listed, lambda x: x["w"]).alias(name)

        flat = every_bucket.agg(*[in_order(f"w{k}") for k in range(1, len(domains))])
        # (domains - 1) lists of ``buckets`` numbers, as constants of the expressions that use them
        flat = [list(w) for w in flat.first()]
        if not seen:
            return Membership(domains, flat, [0.0] + [ABSENT] * (len(domains) - 1))
        priors = [float(_log((counts.get(k, 0)) / seen)) for k in range(len(domains))]
        return Membership(domains, flat, priors)

    def added(self, docs: DataFrame) -> DataFrame:
        """``docs`` with the columns ``_mix_tokens`` and ``_mix_p0``, ``_mix_p1``, ...: words and posteriors.

        The sum of log weights is divided by the square root of the number of words: words of one text are not
        independent, and without that any long text would belong to one domain only. Each step is a column of
        its own, so that nothing is computed anew inside a function over an array.
        """
        others = range(1, len(self.domains))

        def summed(weights: list[float]) -> Column:
            # a constant, folded once: an array literal of that size would be slow to build
            weight = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
            return F.aggregate(F.col("_mix_found"), F.lit(0.0), lambda acc, b: acc + F.get(weight, b))

        found = docs.withColumn("_mix_found", word_buckets(F.col("text")))
        sums = found.withColumns({"_mix_tokens": F.size("_mix_found").cast("bigint"), **{f"_mix_s{j}": summed(self.weights[j - 1]) for j in others}})
        room = F.sqrt(F.greatest(F.col("_mix_tokens"), F.lit(1)).cast("double"))
        raw = sums.withColumns(
            {"_mix_s0": F.lit(self.priors[0]), **{f"_mix_s{j}": F.lit(self.priors[j]) + SHARP * F.col(f"_mix_s{j}") / room for j in others}}
        )
        names = [f"_mix_s{j}" for j in range(len(self.domains))]
        top = F.greatest(*names) if len(names) > 1 else F.col(names[0])
        powers = raw.withColumns({n: F.exp(F.greatest(F.col(n) - top, F.lit(-700.0))) for n in names})
        whole = sum(F.col(n) for n in names)
        # a domain without labelled rows has exactly no members, so that it cannot be the anchor either
        shares = powers.withColumns({f"_mix_p{k}": F.col(n) / whole if self.priors[k] > ABSENT else F.lit(0.0) for k, n in enumerate(names)})
        return shares.drop("_mix_found", *names)


def _log(x: float) -> float:
    return math.log(x) if x > 0 else ABSENT


def rate_column(steps: list[list[float]]) -> Column:
    """The rate after the given gradient steps over ``_mix_p*``, each projected onto the non-negative numbers."""
    rate = F.lit(1.0)
    for step in steps:
        push = sum((F.lit(float(g)) * F.col(f"_mix_p{k}") for k, g in enumerate(step)), F.lit(0.0))
        rate = F.greatest(F.lit(0.0), rate - push)
    return rate


def fitted_steps(members: DataFrame, targets: list[float], anchor: int, steps: int = STEPS, tolerance: float = TOLERANCE) -> list[list[float]]:
    """Gradient steps for ``members`` (_mix_tokens, _mix_p0, ...), starting from rate 1.

    A step moves every rate by its posteriors times a number per domain: the domain's excess of expected tokens,
    divided by the largest effect that all domains' moves together can have on it.
    """
    ks = range(len(targets))
    tokens = F.col("_mix_tokens").cast("double")
    start = members.agg(
        *[F.coalesce(F.sum(tokens * F.col(f"_mix_p{k}")), F.lit(0.0)).alias(f"e{k}") for k in ks],
        *[F.coalesce(F.sum(tokens * F.col(f"_mix_p{k}") * F.col(f"_mix_p{j}")), F.lit(0.0)).alias(f"c{k}_{j}") for k in ks for j in ks],
    ).first()
    if not start[f"e{anchor}"]:
        return []
    goal = [start[f"e{anchor}"] * targets[k] / targets[anchor] for k in ks]
    room = [sum(start[f"c{k}_{j}"] for j in ks) for k in ks]
    done: list[list[float]] = []
    expected = [start[f"e{k}"] for k in ks]
    size = max(sum(goal), 1.0)
    for _ in range(steps):
        # a domain without members cannot be moved
        over = [expected[k] - goal[k] if room[k] > 1e-9 * size else 0.0 for k in ks]
        if max(abs(x) for x in over) <= tolerance * size:
            break
        done.append([over[k] / room[k] if room[k] > 1e-9 * size else 0.0 for k in ks])
        rate = rate_column(done)
        row = members.agg(*[F.coalesce(F.sum(tokens * rate * F.col(f"_mix_p{k}")), F.lit(0.0)).alias(f"e{k}") for k in ks]).first()
        expected = [row[f"e{k}"] for k in ks]
    return done


def copies_of(doc_id: Column, rate: Column) -> Column:
    """Whole copies whose mean over ids is the rate."""
    share = F.pmod(F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(1 << 30)).cast("double") / float(1 << 30)
    return F.floor(rate + share).cast("int")


def _fitted(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], anchor: str, bound: int):
    domains = list(targets)
    membership = Membership.fit(docs, labelled, domains, bound=bound)
    members = materialise(membership.added(narrowed(docs, "doc_id", "text")).drop("text"), "members")
    steps = fitted_steps(members, [targets[d] for d in domains], domains.index(anchor))
    return domains, membership, members, steps


def mixing_rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], anchor: str, bound: int = BOUND) -> DataFrame:
    """(doc_id, tokens, p_<domain>..., rate, copies): one row per document."""
    domains, _, members, steps = _fitted(docs, labelled, targets, anchor, bound)
    rated = members.withColumn("rate", rate_column(steps))
    shares = [F.col(f"_mix_p{k}").alias(f"p_{d}") for k, d in enumerate(domains)]
    return rated.select("doc_id", F.col("_mix_tokens").alias("tokens"), *shares, "rate", copies_of(F.col("doc_id"), F.col("rate")).alias("copies"))


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], anchor: str, bound: int = BOUND) -> DataFrame:
    """The documents in their mix: each row as many times as its rate says, columns unchanged.

    The rate is computed anew beside the text, so that texts are neither shuffled nor joined.
    """
    _, membership, _, steps = _fitted(docs, labelled, targets, anchor, bound)
    whole = docs.select(F.struct("*").alias("_mix_row"), "doc_id", "text")
    rated = membership.added(whole).withColumn("_mix_copies", copies_of(F.col("doc_id"), rate_column(steps)))
    # the outer form: for the inner one the optimiser would filter on the copies first, and compute all of it twice
    copied = rated.withColumn("_mix_copy", F.explode_outer(F.array_repeat(F.lit(1), F.col("_mix_copies"))))
    return copied.where(F.col("_mix_copy").isNotNull()).select("_mix_row.*")
