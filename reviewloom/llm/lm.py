"""Scoring texts with a log-bilinear neural language model trained by noise-contrastive estimation.

The model predicts a word from the two before it: the context vector is a weighted sum of their vectors, the
weights being one vector per position. An output is reached in two steps, class and word in class, each a product of
the context with a vector plus a bias. Classes are the endings of words, told by a hash of their last three
bytes. A word has vectors of its own if it occurs at least sqrt(training tokens) / 32 times, so that the learned
words grow with the corpus and number at most 32 * sqrt(training tokens). The other words of a class are one output,
as target and as context, and share its probability by their smoothed counts. Training compares each true
class with noise classes that a batch shares, and each true word with noise words of its class, so that no sum over
the outputs is needed; scoring normalises exactly, with matrix products over all classes and over all words of
a class.

Counts cover the whole training corpus. Each task writes its texts as chunks: the distinct words of some
megabytes of text, and the texts as numbers into that list. Only the lists are shuffled, packed by word
hash, to be summed; the sums return to the chunk that asked. Every training round runs over all chunks from
the same start. A task sends the changes of those rows of the parameters that it met, and they are averaged by how
often each task met the row, so that a word of few tasks keeps what they learned. Only the words with
vectors are collected and broadcast, some 200 bytes each.

Defined cases: a null text counts as empty, and an empty text is its end alone; a null id belongs to the fold
of the empty text; without training texts N and V are 0, so a token's base score is log10(1/1) = 0 and the
model is uniform over its classes. Every input row gives one output row. Words are told apart by a 52-bit hash and
twelve bits of their ending's.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import batch_chunks, fold, materialise, narrowed, one_worker_each, small_batches
from reviewloom.llm.words import lowered, mix, word_hashes, word_spans

WIDTH = 16
# Noise classes that a batch shares, and noise words of its class for each token.
NOISE = 16
WORD_NOISE = 1
ROUNDS = 1
RATE = 0.2
# Bits of a word's number that tell its ending; the first of them are its class.
ENDING_BITS = 12
LEAST_CLASS_BITS = 7
CHUNK_TEXT = 8 << 20
SHARD_WORDS = 2_000_000
# Rows of parameters that are averaged together.
SLICE = 4096
# Tokens scored at a time, and outputs of one matrix product.
_TOKENS = 1 << 17
_CELLS = 1 << 18


def word_numbers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of every word, in the order of its ending's code first, and where each text's words begin."""
    starts, ends, at = word_spans(data, offsets)
    tail = np.zeros(len(starts), np.uint64)
    for k in (1, 2, 3):
        tail = tail * np.uint64(256) + np.where(ends - k >= starts, data[np.maximum(ends - k, 0)], 0).astype(np.uint64)
    code = mix(tail) >> np.uint64(64 - ENDING_BITS)
    return (code << np.uint64(64 - ENDING_BITS)) | (word_hashes(data, offsets)[0] >> np.uint64(ENDING_BITS)), at


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _unpacked(raw: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)


CHUNK_SCHEMA = "chunk bigint, doc_ids array<bigint>, held array<boolean>, tokens bigint, n_words bigint, ends binary, codes binary, words binary, counts binary"


def _encode(limit: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        ids, held, words, lengths, size = [], [], [], [], 0

        def flushed() -> pa.RecordBatch:
            nonlocal made
            every = np.concatenate(words)
            ends = np.cumsum(np.array(lengths, np.int64))
            distinct, place = np.unique(every, return_inverse=True)
            # frequent words get small numbers, which pack well
            order = np.argsort(-np.bincount(place, minlength=len(distinct)), kind="stable")
            rank = np.empty(len(distinct), np.uint32)
            rank[order] = np.arange(len(distinct), dtype=np.uint32)
            codes = rank[place]
            train = np.repeat(~np.array(held, bool), lengths)
            counts = np.bincount(codes[train], minlength=len(distinct)).astype(np.uint32)
            chunk = (TaskContext.get().partitionId() << 32) + made
            made += 1
            tokens = int(train.sum()) + int((~np.array(held, bool)).sum())
            row = [
                pa.array([chunk], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([held], pa.list_(pa.bool_())),
                pa.array([tokens], pa.int64()),
                pa.array([len(distinct)], pa.int64()),
                *[pa.array([_packed(x)], pa.binary()) for x in (ends, codes, distinct[order], counts)],
            ]
            return pa.RecordBatch.from_arrays(row, ["chunk", "doc_ids", "held", "tokens", "n_words", "ends", "codes", "words", "counts"])

        for batch in batches:
            for part, data, offsets in batch_chunks(batch, "text"):
                hashes, at = word_numbers(lowered(data), offsets)
                ids += part.column(0).to_pylist()
                held += part.column(1).to_pylist()
                words.append(hashes)
                lengths += np.diff(at).tolist()
                size += len(data)
                if size >= limit or len(ids) >= 1 << 20:
                    yield flushed()
                    ids, held, words, lengths, size = [], [], [], [], 0
        if ids:
            yield flushed()

    return work


def _to_shards(shards: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, words, counts in zip(*(batch.column(i) for i in range(3))):
                words, counts = _unpacked(words.as_py(), np.uint64), _unpacked(counts.as_py(), np.uint32)
                shard = words % np.uint64(shards)
                order = np.argsort(shard, kind="stable")
                used, starts = np.unique(shard[order], return_index=True)
                cuts = np.append(starts, len(order))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(used.astype(np.int64)),
                        pa.array([chunk.as_py()] * len(used), pa.int64()),
                        pa.array([words[order[s:e]].tobytes() for s, e in zip(cuts[:-1], cuts[1:])], pa.binary()),
                        pa.array([counts[order[s:e]].tobytes() for s, e in zip(cuts[:-1], cuts[1:])], pa.binary()),
                    ],
                    ["shard", "chunk", "words", "counts"],
                )

    return work


REPLY_SCHEMA = (
    "shard bigint, chunk bigint, totals binary, top_words array<bigint>, top_counts array<bigint>, "
    "codes array<int>, code_tokens array<bigint>, code_words array<bigint>"
)


def _answered(least: int, top: int | None):
    def work(group: pa.Table) -> pa.Table:
        """Corpus counts of the words each chunk asked for; the first row also says what the shard holds."""
        words = [np.frombuffer(x.as_py(), np.uint64) for x in group.column("words")]
        counts = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in group.column("counts")])
        distinct, place = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(place, counts, len(distinct)).astype(np.int64)
        cuts = np.concatenate([[0], np.cumsum([len(w) for w in words])])
        best = np.flatnonzero(total >= least)
        if top is not None:
            best = best[np.lexsort((distinct[best], -total[best]))[:top]]
        code = (distinct >> np.uint64(64 - ENDING_BITS)).astype(np.int64)
        tokens, known = (np.bincount(code, w, 1 << ENDING_BITS).astype(np.int64) for w in (total, total > 0))
        used = np.flatnonzero(known)

        def once(values: np.ndarray, kind: pa.DataType) -> pa.Array:
            return pa.array([values] + [values[:0]] * (group.num_rows - 1), pa.list_(kind))

        return pa.table(
            {
                "shard": group.column("shard"),
                "chunk": group.column("chunk"),
                "totals": pa.array([total[place[s:e]].tobytes() for s, e in zip(cuts[:-1], cuts[1:])], pa.binary()),
                "top_words": once(distinct[best].view(np.int64), pa.int64()),
                "top_counts": once(total[best], pa.int64()),
                "codes": once(used.astype(np.int32), pa.int32()),
                "code_tokens": once(tokens[used], pa.int64()),
                "code_words": once(known[used], pa.int64()),
            }
        )

    return work


def _added_rows(table: np.ndarray, rows: np.ndarray, grads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows, in order, and the sum of the gradients of each."""
    met = np.zeros(len(table), bool)
    met[rows] = True
    used = np.flatnonzero(met)
    number = np.zeros(len(table), np.int32)
    number[used] = np.arange(len(used), dtype=np.int32)
    place = number[rows].astype(np.intp)
    total = np.stack([np.bincount(place, g, len(used)) for g in np.ascontiguousarray(grads.T, float)], axis=1)
    return used, total.astype(np.float32)


@dataclass
class LogBilinear:
    """Outputs are numbered by class: the class's words in rising order, then its other words; last comes the end.

    ``words`` are the numbers of the words with vectors in rising order. The last column of ``word`` and ``kind`` is a
    bias. The last row of ``context`` is the start of a text, the last of ``word`` and ``kind`` its end.
    """

    words: np.ndarray
    bits: int
    context: np.ndarray
    word: np.ndarray
    kind: np.ndarray
    position: np.ndarray
    share: np.ndarray
    kind_share: np.ndarray

    @staticmethod
    def outputs_of(words: np.ndarray, bits: int) -> int:
        """Number of outputs without the end."""
        return len(words) + (1 << bits)

    @staticmethod
    def fresh(words: np.ndarray, counts: np.ndarray, bits: int = LEAST_CLASS_BITS) -> LogBilinear:
        """Parameters before training; with its small vectors, the model is about the unigram distribution ``counts``
        of the outputs, the end being the last."""
        rng = np.random.default_rng(3)
        outputs = LogBilinear.outputs_of(words, bits)
        model = LogBilinear(
            words,
            bits,
            rng.normal(0, 0.1, (outputs + 1, WIDTH)).astype(np.float32),
            rng.normal(0, 0.1, (outputs + 1, WIDTH + 1)).astype(np.float32),
            rng.normal(0, 0.1, ((1 << bits) + 1, WIDTH + 1)).astype(np.float32),
            np.ones((2, WIDTH + 1), np.float32),
            np.zeros(0),
            np.zeros(0),
        )
        smooth = counts + 1.0
        by_class = np.add.reduceat(smooth, model.starts()[:-1])
        model.share = smooth / by_class[model.classes()]
        model.word[:, -1] = np.log(model.share)
        model.kind_share = by_class / by_class.sum()
        model.kind[:, -1] = np.log(model.kind_share)
        return model

    def starts(self) -> np.ndarray:
        """First output of every class, the end's included, and the number of outputs."""
        kinds = np.arange((1 << self.bits) + 1)
        before = np.searchsorted(self.words >> np.uint64(64 - self.bits), kinds.astype(np.uint64))
        return np.append(before + kinds, len(self.context))

    def classes(self) -> np.ndarray:
        """Class of every output."""
        starts = self.starts()
        return np.repeat(np.arange(len(starts) - 1), np.diff(starts)).astype(np.int32)

    def outputs(self, words: np.ndarray) -> np.ndarray:
        """Output number of each word, and that of its class's other words where it has no vector."""
        kind = (words >> np.uint64(64 - self.bits)).astype(np.int64)
        rest = self.starts()[kind + 1] - 1
        if len(self.words) == 0:
            return rest.astype(np.int32)
        place = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[place] == words, place + kind, rest).astype(np.int32)

    def tables(self) -> list[np.ndarray]:
        return [self.context, self.word, self.kind, self.position]

    def flat(self) -> np.ndarray:
        """All parameters as rows of one width."""
        return np.concatenate([np.pad(t, ((0, 0), (0, WIDTH + 1 - t.shape[1]))) for t in self.tables()])

    def with_flat(self, rows: np.ndarray) -> LogBilinear:
        parts, at = [], 0
        for t in self.tables():
            parts.append(rows[at : at + len(t), : t.shape[1]].astype(np.float32))
            at += len(t)
        return LogBilinear(self.words, self.bits, *parts, self.share, self.kind_share)

    def sequences(self, outputs: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Target and the two words before it for every token, ends included, and where each text stops."""
        last, texts = len(self.context) - 1, len(ends)
        lengths = np.diff(ends, prepend=0)
        stops = ends + np.arange(1, texts + 1)
        total = len(outputs) + texts
        target = np.full(total, last, np.int32)
        inside = np.ones(total, bool)
        inside[stops - 1] = False
        target[inside] = outputs
        first = stops - lengths - 1
        # as context, the last row is the start
        one = np.concatenate([[last], target[:-1]]).astype(np.int32)
        one[first] = last
        two = np.concatenate([[last], one[:-1]]).astype(np.int32)
        two[first] = last
        return target, one, two, stops

    def trained(self, sequences: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], seed: int, batch: int = 4096) -> tuple[LogBilinear, np.ndarray]:
        """Adagrad on the noise-contrastive loss, and how often each row of ``flat`` was met."""
        rng = np.random.default_rng(seed)
        context, word, kind, position = values = [x.copy() for x in self.tables()]
        memory = [np.full(x.shape, 0.1, np.float32) for x in values]
        visits = [np.zeros(len(x)) for x in values]
        kinds, starts = self.classes(), self.starts()
        several = (np.diff(starts) > 1).astype(np.float32)
        log_word = np.log(WORD_NOISE * self.share).astype(np.float32)
        per_kind = self.kind_share
        log_kind = np.log(NOISE * per_kind).astype(np.float32)
        over_kinds = np.cumsum(per_kind)
        # a class's number plus the running share inside it, so that one search draws from every class
        running = np.cumsum(self.share)
        running = running - np.append(0.0, running)[starts[:-1]][kinds] + kinds

        def near(x: np.ndarray) -> np.ndarray:
            return 1 / (1 + np.exp(-np.maximum(x, -30)))

        def step(which: int, rows: np.ndarray, grads: np.ndarray) -> None:
            value, seen = values[which], memory[which]
            used, total = _added_rows(value, rows, grads)
            now = seen[used] + total**2
            seen[used] = now
            value[used] -= RATE * total / np.sqrt(now)

        for targets, ones, twos in sequences:
            # neighbours are of one text and language
            mixed = rng.permutation(len(targets))
            for start in range(0, len(targets), batch):
                at = mixed[start : start + batch]
                t, a, b = targets[at], ones[at], twos[at]
                k, n = kinds[t], len(t)
                va, vb = context[a], context[b]
                hidden = va * position[0, :-1] + vb * position[1, :-1]
                full = np.concatenate([hidden, np.ones((n, 1), np.float32)], axis=1)
                drawn = np.minimum(np.searchsorted(over_kinds, rng.random(NOISE)), len(per_kind) - 1)
                up = near((full * kind[k]).sum(axis=1) - log_kind[k]) - 1
                down = near(full @ kind[drawn].T - log_kind[drawn])
                noise = np.searchsorted(running, k[:, None] + rng.random((n, WORD_NOISE)))
                noise = np.clip(noise, starts[k][:, None], starts[k + 1][:, None] - 1)
                vectors = word[noise]
                up_word = (near((full * word[t]).sum(axis=1) - log_word[t]) - 1) * several[k]
                down_word = near(np.einsum("ij,ikj->ik", full, vectors) - log_word[noise]) * several[k][:, None]
                to_hidden = (
                    up[:, None] * kind[k] + down @ kind[drawn] + up_word[:, None] * word[t] + np.einsum("ik,ikj->ij", down_word, vectors)
                )[:, :-1]
                step(2, np.concatenate([k, drawn]), np.concatenate([up[:, None] * full, down.T @ full]))
                to_word = np.concatenate([up_word[:, None] * full, (down_word[:, :, None] * full[:, None, :]).reshape(-1, WIDTH + 1)])
                step(1, np.concatenate([t, noise.reshape(-1)]), to_word)
                pulls = [(to_hidden * v).sum(axis=0) for v in (va, vb)]
                step(0, np.concatenate([a, b]), np.concatenate([to_hidden * position[0, :-1], to_hidden * position[1, :-1]]))
                step(3, np.arange(2), np.pad(np.stack(pulls), ((0, 0), (0, 1))) / n)
            for which, rows in ((0, ones), (0, twos), (1, targets), (2, kinds[targets])):
                visits[which] += np.bincount(rows, minlength=len(visits[which]))
            visits[3] += len(targets)
        return LogBilinear(self.words, self.bits, *values, self.share, self.kind_share), np.concatenate(visits)

    def log10s(self, target: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Normalised log10 probability of every target: of its class, and of the word in the class."""
        starts, kinds = self.starts(), self.classes()
        result = np.empty(len(target))

        def norms(full: np.ndarray, table: np.ndarray) -> np.ndarray:
            """Logarithm of the sum over a table's outputs for each context."""
            found = np.empty(len(full), np.float32)
            # as many outputs at a time as stay in the cache
            size = max(1, _CELLS // len(table))
            for at in range(0, len(full), size):
                logits = full[at : at + size] @ table.T
                with np.errstate(over="ignore", divide="ignore"):
                    found[at : at + size] = np.log(np.exp(logits, out=logits).sum(axis=1))
            # rows whose sum leaves the range of single precision
            far = np.flatnonzero(~(np.abs(found) < 60))
            for at in range(0, len(far), size):
                logits = full[far[at : at + size]].astype(float) @ table.T
                top = logits.max(axis=1)
                found[far[at : at + size]] = top + np.log(np.exp(logits - top[:, None]).sum(axis=1))
            return found

        for at in range(0, len(target), _TOKENS):
            t = target[at : at + _TOKENS]
            # words return in the same contexts, which decide on the sum over classes
            pair = one[at : at + _TOKENS].astype(np.int64) * len(self.context) + two[at : at + _TOKENS]
            distinct, place = np.unique(pair, return_inverse=True)
            full = np.ones((len(distinct), WIDTH + 1), np.float32)
            full[:, :-1] = self.context[distinct // len(self.context)] * self.position[0, :-1]
            full[:, :-1] += self.context[distinct % len(self.context)] * self.position[1, :-1]
            k, in_class = kinds[t], norms(full, self.kind)[place]
            full = full[place]
            scores = np.einsum("ij,ij->i", full, self.kind[k]) - in_class
            order = np.argsort(k.astype(np.uint16), kind="stable")
            bounds = np.searchsorted(k[order], np.arange(len(starts)))
            for i in np.flatnonzero((np.diff(bounds) > 0) & (np.diff(starts) > 1)).tolist():
                rows = order[bounds[i] : bounds[i + 1]]
                own = full[rows]
                scores[rows] += np.einsum("ij,ij->i", own, self.word[t[rows]]) - norms(own, self.word[starts[i] : starts[i + 1]])
            result[at : at + _TOKENS] = scores
        return result / np.log(10)


@dataclass
class CorpusModel:
    """The trained model with the corpus counts that scoring needs."""

    model: LogBilinear
    train_tokens: int
    train_distinct: int
    train_texts: int
    rest: np.ndarray
    chunks: DataFrame
    replies: DataFrame
    shards: int


def fit_corpus(docs: DataFrame, held: Column, vocabulary: int | None = None, rounds: int = ROUNDS, chunk_text: int = CHUNK_TEXT) -> CorpusModel:
    """Chunks, corpus counts and a model trained on all texts that are not ``held``.

    With ``vocabulary``, at most that many words have vectors, the most frequent ones.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = narrowed(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), held.alias("held"), "text")
    chunks = materialise(rows.mapInArrow(_encode(chunk_text), CHUNK_SCHEMA), "chunks")
    totals = chunks.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum("n_words"), F.lit(0)).alias("entries"),
        F.coalesce(F.sum(F.size(F.filter("held", lambda h: ~h))), F.lit(0)).alias("texts"),
    ).first()
    shards = max(one_worker_each(spark), -(-totals.entries // SHARD_WORDS))
    least = max(2, -(-math.isqrt(totals.tokens) // 32)) if vocabulary is None else 1
    asked = chunks.select("chunk", "words", "counts").mapInArrow(_to_shards(shards), "shard bigint, chunk bigint, words binary, counts binary")
    replies = materialise(asked.groupBy("shard").applyInArrow(_answered(least, vocabulary), REPLY_SCHEMA), "replies")
    best = replies.select(F.explode(F.arrays_zip("top_words", "top_counts")).alias("t")).select("t.*")
    if vocabulary is not None:
        best = best.orderBy(F.desc("top_counts"), "top_words").limit(vocabulary)
    best = best.toPandas()
    words, counts = best["top_words"].to_numpy(np.int64).view(np.uint64), best["top_counts"].to_numpy(np.int64)
    order = np.argsort(words)
    words, counts = words[order], counts[order]
    bits = min(ENDING_BITS, max(LEAST_CLASS_BITS, math.isqrt(len(words)).bit_length()))
    by_class = replies.select(F.explode(F.arrays_zip("codes", "code_tokens", "code_words")).alias("t"))
    by_class = by_class.groupBy(F.shiftright("t.codes", ENDING_BITS - bits).alias("kind"))
    by_class = by_class.agg(F.sum("t.code_tokens").alias("tokens"), F.sum("t.code_words").alias("words")).collect()
    in_class = np.zeros((2, 1 << bits), np.int64)
    for r in by_class:
        in_class[:, r.kind] = r.tokens, r.words
    distinct = int(in_class[1].sum()) + (1 if totals.texts else 0)
    own = (words >> np.uint64(64 - bits)).astype(np.int64)
    rest = in_class - np.stack([np.bincount(own, counts, 1 << bits), np.bincount(own, minlength=1 << bits)]).astype(np.int64)
    every = np.zeros(LogBilinear.outputs_of(words, bits) + 1, np.int64)
    every[np.arange(len(words)) + own] = counts
    every[np.searchsorted(own, np.arange(1 << bits), side="right") + np.arange(1 << bits)] = rest[0]
    every[-1] = totals.texts
    model = LogBilinear.fresh(words, every, bits)
    if totals.texts:
        for number in range(rounds):
            model = _averaged(chunks, model, number)
    return CorpusModel(model, totals.tokens, distinct, totals.texts, rest.sum(axis=0) + 1, chunks, replies, shards)


def _averaged(chunks: DataFrame, model: LogBilinear, number: int) -> LogBilinear:
    """One round: every task trains from the same start on its chunks; changes of a row are averaged by its visits."""
    shared = chunks.sparkSession.sparkContext.broadcast(model)  # as large as the words with vectors
    source = chunks.select("held", "ends", "codes", "words")
    lanes = math.isqrt(source.rdd.getNumPartitions()) + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = shared.value
        task = TaskContext.get().partitionId()

        def sequences():
            for batch in batches:
                for held, ends, codes, words in zip(*(batch.column(i) for i in range(4))):
                    train = ~np.array(held.as_py(), bool)
                    ends = _unpacked(ends.as_py(), np.int64)
                    outputs = start.outputs(_unpacked(words.as_py(), np.uint64))[_unpacked(codes.as_py(), np.uint32)]
                    target, one, two, stops = start.sequences(outputs, ends)
                    keep = np.repeat(train, np.diff(stops, prepend=0))
                    yield target[keep], one[keep], two[keep]

        done, visits = start.trained(sequences(), 1000 * number + task)
        change = done.flat() - start.flat()
        for i in range(0, len(visits), SLICE):
            met = np.flatnonzero(visits[i : i + SLICE])
            if len(met):
                part = np.concatenate([visits[i + met, None], change[i + met] * visits[i + met, None]], axis=1).astype(np.float32)
                yield _slice_row(i // SLICE, task % lanes, met, part)

    def added(group: pa.Table) -> pa.Table:
        total = np.zeros((SLICE, WIDTH + 2), np.float32)
        for met, part in zip(group.column("met"), group.column("part")):
            total[np.frombuffer(met.as_py(), np.uint16)] += np.frombuffer(part.as_py(), np.float32).reshape(-1, WIDTH + 2)
        met = np.flatnonzero(total[:, 0])
        return pa.Table.from_batches([_slice_row(group.column("slice")[0].as_py(), group.column("lane")[0].as_py(), met, total[met])])

    schema = "slice int, lane int, met binary, part binary"
    parts = source.mapInArrow(work, schema)
    summed = parts.groupBy("slice", "lane").applyInArrow(added, schema)
    rows = model.flat()
    for r in summed.groupBy("slice").applyInArrow(added, schema).collect():
        part = np.frombuffer(r.part, np.float32).reshape(-1, WIDTH + 2)
        rows[r.slice * SLICE + np.frombuffer(r.met, np.uint16).astype(np.int64)] += part[:, 1:] / part[:, :1]
    return model.with_flat(rows)


def _slice_row(number: int, lane: int, met: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
    """Some rows of a slice: their places, and visits and sums of changes of each."""
    columns = [pa.array([number], pa.int32()), pa.array([lane], pa.int32())]
    columns += [pa.array([x.tobytes()], pa.binary()) for x in (met.astype(np.uint16), part)]
    return pa.RecordBatch.from_arrays(columns, ["slice", "lane", "met", "part"])


def text_scores(docs: DataFrame, held: Column, vocabulary: int | None = None, rounds: int = ROUNDS, chunk_text: int = CHUNK_TEXT) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every text.

    ``base_score`` is the add-one unigram score; ``score`` the log-bilinear model's log10 probability.
    """
    spark = docs.sparkSession
    fitted = fit_corpus(docs, held, vocabulary, rounds, chunk_text)
    shards = fitted.shards
    shared = spark.sparkContext.broadcast((fitted.model, fitted.train_tokens, fitted.train_distinct, fitted.train_texts, fitted.rest))
    # a chunk's replies are as many as its words have shards
    answers = fitted.replies.groupBy("chunk").agg(F.collect_list(F.struct("shard", "totals")).alias("answers"))
    whole = fitted.chunks.select("chunk", "doc_ids", "held", "ends", "codes", "words").join(answers, "chunk", "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, tokens, distinct, texts, rest = shared.value
        base = np.log10(tokens + 1 * (distinct + 1))
        in_rest, rest_output = np.log10(rest), model.starts()[1:-1] - 1
        end_score = np.log10(texts + 1) - base
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(6))):
                ids, held_out = pa.array(row[0].as_py(), pa.int64()), pa.array(row[1].as_py(), pa.bool_())
                ends, codes, words = _unpacked(row[2].as_py(), np.int64), _unpacked(row[3].as_py(), np.uint32), _unpacked(row[4].as_py(), np.uint64)
                counts = np.zeros(len(words), np.int64)
                order = np.argsort(words % np.uint64(shards), kind="stable")
                found = sorted((a["shard"], a["totals"]) for a in row[5].as_py() or [])
                counts[order] = np.concatenate([np.frombuffer(t, np.int64) for _, t in found]) if found else 0
                outputs = model.outputs(words)
                kind = (words >> np.uint64(64 - model.bits)).astype(np.int64)
                target, one, two, stops = model.sequences(outputs[codes], ends)
                scores = model.log10s(target, one, two)
                inside = target != len(model.context) - 1
                smooth = np.log10(counts + 1)
                # a word without vectors has its share of what its class's other words have
                scores[inside] += np.where(outputs == rest_output[kind], smooth - in_rest[kind], 0)[codes]
                plain = np.full(len(target), end_score)
                plain[inside] = (smooth - base)[codes]
                known = np.full(len(target), int(texts > 0))
                known[inside] = (counts > 0)[codes]
                first = np.concatenate([[0], stops[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        held_out,
                        pa.array(np.diff(stops, prepend=0), pa.int64()),
                        pa.array(np.add.reduceat(known, first), pa.int64()),
                        pa.array(np.full(len(stops), tokens), pa.int64()),
                        pa.array(np.add.reduceat(plain, first), pa.float64()),
                        pa.array(np.add.reduceat(scores, first), pa.float64()),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return whole.select("doc_ids", "held", "ends", "codes", "words", "answers").mapInArrow(
        work, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )


def held_out_scores(docs: DataFrame, folds: int = 7, held: int = 2, **options) -> DataFrame:
    """``text_scores`` with the texts of one fold of the ids held out of training."""
    return text_scores(docs, fold("doc_id", folds) == held, **options)
