"""Toxicity by a convolutional text classifier: hashed word embeddings, several filter widths, max pooling.

A word's embedding is the sum of hashed rows for the whole word and for its first four and five bytes, so that
inflected forms of a word share what was learned of one. Filters of one to three words slide over the whole text; each keeps its largest response; a
logistic layer turns these into a probability. The network learns in numpy from all labelled documents: a bounded
number begin it on the driver in several passes, all others refine it in tasks, in one pass whose changes are averaged.
Only the places that win the pooling carry a gradient, so a step back costs little.
Thresholds for a decision by language come from all of a fifth of the labelled documents, which the network does not
learn from; the score itself knows nothing of the language.

Defined cases: a null text counts as empty; a text without words has no response, so only the bias speaks;
a word unlike all learned ones adds
nothing; without labelled rows of both kinds every score is the smoothed share of toxic rows (0 without any row). A
language without labelled rows uses the threshold over all. Every input row gives one output row.
"""

from __future__ import annotations

import copy
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import BROADCAST_IDS, batch_chunks, fold, materialise, narrowed, small_batches
from reviewloom.llm.labelled import labelled_ids
from reviewloom.llm.words import letters_only, lowered, prefix_hashes
from reviewloom.operators.order import with_running_total
from reviewloom.session import BROADCAST_ROWS, has_at_most

# Rows of the table for each of the three parts of an embedding.
BUCKETS = 1 << 15
PARTS = (1 << 30, 4, 5)
WIDTH = 8
FILTERS = 12
SPANS = (1, 2, 3)
# Labelled documents that begin the network, at most; all others refine it.
BOUND = 6_000
# Documents that one task refines it with, on average.
GROUP = 4_000
# What squared gradients start from, and the unit in which changes travel.
UNSEEN = np.float32(1e-3)
FIXED = float(1 << 32)
# Share of the clean texts that the network sees as if it knew none of their words.
WORD_LOSS = 0.1


def word_rows(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of every word, one column per part, and where each text's words begin."""
    low = lowered(data)
    hashes, at = prefix_hashes(low, offsets, letters_only(low), PARTS)
    return np.stack([(h % np.uint64(buckets)).astype(np.int64) + k * buckets for k, h in enumerate(hashes)], axis=1), at


@dataclass
class Network:
    table: np.ndarray
    filters: list[np.ndarray]
    shifts: list[np.ndarray]
    out: np.ndarray
    bias: float
    buckets: int
    thresholds: dict[str, float] = field(default_factory=dict)

    def embedded(self, rows: np.ndarray) -> np.ndarray:
        return sum(self.table[rows[:, k]] for k in range(rows.shape[1]))

    def pooled(self, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Largest response of every filter in each text, at least 0."""
        texts = len(at) - 1
        result = np.zeros((texts, len(SPANS) * FILTERS), np.float32)
        some = np.flatnonzero(np.diff(at) > 0)
        if len(some) == 0:
            return result
        words = self.embedded(rows)
        left = (np.repeat(at[1:], np.diff(at)) - np.arange(len(rows)))[:, None]
        for j, span in enumerate(SPANS):
            seen = np.repeat(self.shifts[j][None, :], len(rows), axis=0)
            for k in range(span):
                part = words[k:] @ self.filters[j][k]
                seen[: len(part)] += np.where(left[: len(part)] > k, part, 0)
            result[some, j * FILTERS : (j + 1) * FILTERS] = np.maximum.reduceat(seen, at[some], axis=0)
        return np.maximum(result, 0)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        raw = self.pooled(*word_rows(data, offsets, self.buckets)) @ self.out + self.bias
        return 1 / (1 + np.exp(-np.clip(raw.astype(float), -30, 30)))


def _winners(net: Network, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Response and place of the winner of every filter in one text."""
    best, place = [], []
    for j, span in enumerate(SPANS):
        seen = np.repeat(net.shifts[j][None, :], len(words), axis=0)
        for k in range(span):
            seen[: len(words) - k] += words[k:] @ net.filters[j][k] if k < len(words) else 0
        place.append(seen.argmax(axis=0))
        best.append(seen.max(axis=0))
    return np.concatenate(best), np.concatenate(place)


@dataclass
class Adagrad:
    """Squared gradients so far, shaped as the parameters."""

    table: np.ndarray
    filters: list[np.ndarray]
    shifts: list[np.ndarray]
    out: np.ndarray
    bias: float = 1e-3

    @classmethod
    def fresh(cls, net: Network) -> Adagrad:
        def like(x: np.ndarray) -> np.ndarray:
            return np.full(x.shape, UNSEEN, np.float32)

        return cls(like(net.table), [like(f) for f in net.filters], [like(x) for x in net.shifts], like(net.out))


def rows_of(text: str, buckets: int) -> np.ndarray:
    raw = text.encode()
    return word_rows(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), buckets)[0]


def learn(net: Network, seen: Adagrad, documents: Iterable[tuple[np.ndarray, float]], heavy: float, rng: np.random.Generator) -> None:
    """One step of Adagrad for each (word rows, label); changes ``net`` and ``seen``."""
    for rows, y in documents:
        if len(rows) == 0:
            continue
        words = net.embedded(rows)
        # a clean text of unknown words is clean still: some of them are shown as such
        known = bool(y) or rng.random() >= WORD_LOSS
        words *= known
        best, place = _winners(net, words)
        pooled = np.maximum(best, 0)
        raw = float(pooled @ net.out + net.bias)
        slope = (1 / (1 + np.exp(-raw)) - y) * (heavy if y else 1.0)
        if abs(slope) < 1e-3:
            continue
        back = np.where(best > 0, net.out * slope, 0).astype(np.float32)
        step = slope * pooled + 1e-4 * net.out
        for j, span in enumerate(SPANS):
            lane = slice(j * FILTERS, (j + 1) * FILTERS)
            for k in range(span):
                where = place[lane] + k
                inside = where < len(words)
                at, push = np.minimum(where, len(words) - 1), back[lane] * inside
                grad = (words[at] * push[:, None]).T
                to_words = (net.filters[j][k] * push[None, :]).T
                seen.filters[j][k] += grad**2
                net.filters[j][k] -= 0.05 * grad / np.sqrt(seen.filters[j][k])
                used, inverse = np.unique(rows[at].T.reshape(-1), return_inverse=True)
                total = np.zeros((len(used), WIDTH), np.float32)
                np.add.at(total, inverse, np.tile(to_words * known, (len(PARTS), 1)))
                seen.table[used] += total**2
                net.table[used] -= 0.1 * total / np.sqrt(seen.table[used])
            seen.shifts[j] += back[lane] ** 2
            net.shifts[j] -= 0.02 * back[lane] / np.sqrt(seen.shifts[j])
        seen.out += step**2
        net.out -= (0.05 * step / np.sqrt(seen.out)).astype(np.float32)
        seen.bias += slope**2
        net.bias -= 0.05 * slope / np.sqrt(seen.bias)


def fresh(buckets: int, bias: float) -> Network:
    rng = np.random.default_rng(11)
    return Network(
        rng.normal(0, 0.05, (buckets * len(PARTS), WIDTH)).astype(np.float32),
        [rng.normal(0, 0.3, (span, WIDTH, FILTERS)).astype(np.float32) for span in SPANS],
        [np.zeros(FILTERS, np.float32) for _ in SPANS],
        rng.normal(0, 0.3, len(SPANS) * FILTERS).astype(np.float32),
        bias,
        buckets,
    )


def constant(share: float) -> Network:
    share = min(max(share, 1e-9), 0.999)
    net = fresh(1, float(np.log(share / (1 - share))))
    net.out[:] = 0
    return net


def begun(texts: list[str], y: np.ndarray, share: float, buckets: int = BUCKETS, epochs: int = 4) -> tuple[Network, Adagrad]:
    """The network that all further documents refine: several passes over these, in a seeded order."""
    net = fresh(buckets, float(np.log(share / (1 - share))))
    seen, rng = Adagrad.fresh(net), np.random.default_rng(12)
    rows = [rows_of(text, buckets) for text in texts]
    for _ in range(epochs):
        learn(net, seen, ((rows[i], y[i]) for i in rng.permutation(len(rows))), weight_of(share), rng)
    return net, seen


def fit(texts: list[str], y: np.ndarray, langs: list[str | None], buckets: int = BUCKETS, epochs: int = 4) -> Network:
    """A network of texts at hand; every fifth one only calibrates thresholds."""
    held = np.arange(len(texts)) % 5 == 0
    share = float(y[~held].mean()) if len(texts) > 1 else 0.0
    if not 0 < share < 1:
        return constant(float(y.sum()) / (len(y) + 1))
    net, seen = begun([t for t, h in zip(texts, held) if not h], y[~held], share, buckets, epochs)
    net.table[(seen.table == UNSEEN).all(axis=1)] = 0
    scores = np.array([net.score(np.frombuffer(t := texts[i].encode(), np.uint8), np.array([0, len(t)]))[0] for i in np.flatnonzero(held)])
    marks = y[held]
    net.thresholds[""] = best_threshold(scores, marks)
    for lang in sorted({x for x, h in zip(langs, held) if h and x is not None}):
        own = np.array([x == lang for x, h in zip(langs, held) if h])
        if marks[own].sum() >= 10 and (1 - marks[own]).sum() >= 10:
            net.thresholds[lang] = best_threshold(scores[own], marks[own])
    return net


def best_threshold(scores: np.ndarray, marks: np.ndarray) -> float:
    """The middle of the gap between two scores at which F1 is highest; 0.5 without rows of both kinds."""
    if marks.sum() == 0 or marks.sum() == len(marks):
        return 0.5
    values, at = np.unique(-scores, return_inverse=True)
    hits = np.cumsum(np.bincount(at, marks))
    best = int((2 * hits / (np.cumsum(np.bincount(at)) + marks.sum())).argmax())
    low = -values[best + 1] if best + 1 < len(values) else 0.0
    return float((-values[best] + low) / 2)


def weight_of(share: float) -> float:
    """What a toxic document counts, where they are rare."""
    return min(4.0, (1 - share) / share)


def flat(net: Network) -> np.ndarray:
    """All parameters as rows of WIDTH numbers: the table's, then the others'."""
    others = np.concatenate([x.reshape(-1) for x in (*net.filters, *net.shifts, net.out, np.array([net.bias]))])
    padded = np.zeros((-(-len(others) // WIDTH), WIDTH))
    padded.reshape(-1)[: len(others)] = others
    return np.concatenate([net.table.astype(float), padded])


def shaped(net: Network, values: np.ndarray) -> Network:
    """``net`` with the parameters of ``flat``."""
    rest, at, parts = values[len(net.table) :].reshape(-1), 0, []
    for like in (*net.filters, *net.shifts, net.out):
        parts.append(rest[at : at + like.size].reshape(like.shape).astype(np.float32))
        at += like.size
    n = len(SPANS)
    return Network(values[: len(net.table)].astype(np.float32), parts[:n], parts[n : 2 * n], parts[-1], float(rest[at]), net.buckets)


def refined(net: Network, seen: Adagrad, rows: DataFrame, share: float) -> tuple[Network, np.ndarray]:
    """One pass over ``rows`` (doc_id, text, y, _group), and which rows of the table it changed.

    Each group starts from ``net`` and learns in a task of its own.

    The change of a row of parameters is averaged over the groups that changed it. Changes travel as whole multiples of
    2 ** -32, so that their sums do not depend on the order. At most the rows of the network reach the driver.
    """
    small_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast((net, seen))  # of fixed size, about 6 MB
    names = [f"v{i}" for i in range(WIDTH)]

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        start, own, state = shared.value[0], *copy.deepcopy(shared.value)
        frame = frame.sort_values(["doc_id", "text"], kind="stable")
        rng = np.random.default_rng([13, int(frame["_group"].iloc[0])])
        texts, y = frame["text"].to_list(), frame["y"].to_numpy()
        learn(own, state, ((rows_of(texts[i], own.buckets), float(y[i])) for i in rng.permutation(len(texts))), weight_of(share), rng)
        change = np.rint((flat(own) - flat(start)) * FIXED).astype(np.int64)
        where = np.flatnonzero(change.any(axis=1))
        return pd.DataFrame({"at": where, **{name: change[where, i] for i, name in enumerate(names)}})

    changes = rows.groupBy("_group").applyInPandas(work, ", ".join(["at bigint", *[f"{n} bigint" for n in names]]))
    sums = changes.groupBy("at").agg(*[F.sum(n).alias(n) for n in names], F.count(F.lit(1)).alias("n")).toPandas()
    values = flat(net)
    values[sums["at"].to_numpy()] += sums[names].to_numpy() / FIXED / sums["n"].to_numpy()[:, None]
    changed = np.zeros(len(net.table), bool)
    changed[[i for i in sums["at"] if i < len(changed)]] = True
    return shaped(net, values), changed


def best_thresholds(scored: DataFrame) -> dict[str, float]:
    """Per language, and as "" over all, the middle of the gap between two scores at which F1 is highest.

    ``scored`` (lang, score, y) may have any number of rows: they are counted per score, and running totals down the
    scores come from ranges. 0.5 without rows of both kinds; a language with fewer than ten of either has none.
    """
    scopes = F.explode(F.when(F.col("lang").isNull() | (F.col("lang") == ""), F.array(F.lit(""))).otherwise(F.array(F.lit(""), F.col("lang"))))
    counts = scored.select("score", "y", scopes.alias("scope")).groupBy("scope", "score").agg(F.count(F.lit(1)).alias("rows"), F.sum("y").cast("bigint").alias("hits"))
    counts = materialise(counts, "scores")
    wholes = counts.groupBy("scope").agg(F.sum("rows").alias("all_rows"), F.sum("hits").alias("all_hits"))
    least = F.when(F.col("scope") == "", 1).otherwise(10)
    wholes = materialise(wholes.where((F.col("all_hits") >= least) & (F.col("all_rows") - F.col("all_hits") >= least)), "scopes")
    # all that is joined by scope has a row a language
    near = F.broadcast if has_at_most(wholes, BROADCAST_ROWS) else (lambda frame: frame)
    down = ["scope", F.col("score").desc()]
    running = counts.join(near(wholes), "scope")
    for name in ("rows", "hits"):
        running = with_running_total(running, down, name, f"_{name}")
    before = running.groupBy("scope").agg(*[F.min(F.col(f"_{n}") - F.col(n)).alias(f"{n}_before") for n in ("rows", "hits")])
    so_far = {n: F.col(f"_{n}") - F.col(f"{n}_before") for n in ("rows", "hits")}
    f1 = 2 * so_far["hits"] / (so_far["rows"] + F.col("all_hits"))
    best = running.join(near(before), "scope").groupBy("scope").agg(F.max(F.struct(f1.alias("f1"), F.col("score").alias("cut"))).alias("b"))
    best = best.select("scope", F.col("b.cut").alias("cut"))
    below = F.coalesce(F.max(F.when(F.col("score") < F.col("cut"), F.col("score"))), F.lit(0.0))
    found = counts.join(near(best), "scope").groupBy("scope").agg(((F.first("cut") + below) / 2).alias("threshold")).collect()
    return {"": 0.5, **{r.scope: r.threshold for r in found}}


def toxicity_network(docs: DataFrame, labels: DataFrame, train: Column, bound: int = BOUND, group: int = GROUP) -> Network:
    """A network fitted on all labelled documents of the training fold (a column over doc_id).

    A fifth of them, by a hash of the id, only calibrates thresholds. Of the others, at most ``bound`` whose ids hash
    lowest, and ``bound`` / 20 of either kind, begin the network on the driver; all that are left refine it in groups of
    about ``group``.
    """
    chosen = labelled_ids(labels, "toxic", train)
    text_id = F.col("doc_id").cast("string")
    chosen = materialise(chosen.withColumn("_held", F.pmod(F.xxhash64(F.lit("calibration"), text_id), F.lit(5)) == 0), "labelled")
    n, marked, to_learn, toxic = chosen.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0)), F.count_if(~F.col("_held")), F.count_if(~F.col("_held") & (F.col("y") == 1))
    ).first()
    if not 0 < toxic < to_learn:
        return constant(marked / (n + 1))
    share = toxic / to_learn
    learning = chosen.where(~F.col("_held")).select("doc_id", "y")
    lowest = [F.xxhash64(text_id), F.col("doc_id")]
    first = learning.orderBy(*lowest).limit(bound)
    for kind in (0, 1):
        first = first.unionByName(learning.where(F.col("y") == kind).orderBy(*lowest).limit(-(-bound // 20)))
    first = materialise(first.distinct(), "begin")
    # at most 1.1 * ``bound`` ids, so the broadcast is bounded by the parameter
    begin = _texts(docs, F.broadcast(first)).select("doc_id", "text", "y").collect()
    begin = sorted(begin, key=lambda r: (r.doc_id, r.text))
    net, seen = begun([r.text for r in begin], np.array([r.y for r in begin], float), share)
    known = (seen.table != UNSEEN).any(axis=1)
    rest = to_learn - first.count()
    if rest > 0:
        groups = -(-rest // group)
        part = F.pmod(F.xxhash64(F.lit("group"), text_id), F.lit(groups)).alias("_group")
        others = learning.join(F.broadcast(first.select("doc_id")), "doc_id", "left_anti")
        # as many tasks as groups, so that a task's work does not grow with the table
        dealt = _texts(docs, _few(others)).select("doc_id", "text", "y", part).repartition(groups, "_group")
        net, changed = refined(net, seen, dealt, share)
        known |= changed
    # rows no step has touched still hold their random start, and a long text's maximum would pick the largest of them
    net.table[~known] = 0
    held = _texts(docs, _few(chosen.where("_held").select("doc_id", "y")), "lang")
    net.thresholds = best_thresholds(scored(held, net, ("y",)).select("lang", "score", "y"))
    return net


def _few(ids: DataFrame) -> DataFrame:
    """Few ids are broadcast, so that texts stay where they are."""
    return F.broadcast(ids) if has_at_most(ids, BROADCAST_IDS) else ids


def _texts(docs: DataFrame, ids: DataFrame, *extra: str) -> DataFrame:
    return narrowed(docs, "doc_id", "text", *extra).join(ids, "doc_id").withColumn("text", F.coalesce("text", F.lit("")))


def toxicity_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, bound: int = BOUND) -> DataFrame:
    """(doc_id, held_out, score, predicted, lang, by_language): learned outside the held-out fold.

    ``predicted`` is the score at 0.5; ``by_language`` is it at the threshold calibrated for the row's language.
    """
    net = toxicity_network(docs, labels, fold("doc_id", folds) != held, bound)
    rows = scored(narrowed(docs, "doc_id", "text", "lang"), net)
    return rows.select(
        "doc_id",
        (fold("doc_id", folds) == held).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "lang",
        "by_language",
    )


def scored(rows: DataFrame, net: Network, kept: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, lang, *kept, score, by_language) of the rows (doc_id, text, lang, *kept)."""
    small_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(net)  # a table of fixed size, about 3 MB
    names = ("doc_id", "lang", *kept)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in batch_chunks(batch, "text"):
                scores = shared.value.score(data, offsets)
                limits = shared.value.thresholds
                cut = np.array([limits.get(x, limits.get("", 0.5)) for x in part.column("lang").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in names], pa.array(scores, pa.float64()), pa.array((scores >= cut).astype(np.int32))],
                    [*names, "score", "by_language"],
                )

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)
    return rows.select("text", *names).mapInArrow(work, f"{kinds}, score double, by_language int")
