"""Spelling variants grouped by blocked Gram matrices of letter counts.

Words one edit apart have letter counts that are close: a replaced letter changes two counts by one, an inserted or
deleted one changes one count. With the letter counts of a block of words as rows of a matrix X, the product X X' gives
all squared distances of the block at once; pairs at a distance of at most two are kept and their letters compared.

Blocks hold words of one length and words one letter longer. They are made finer without losing a pair: the letters
are dealt into classes, and a word stands in the block of its class counts as it is, and in the blocks of its class
counts with one letter of some class less. Of two words one edit apart, the shorter one's counts, or both words' counts
without the replaced letter, are the same block, and each pair has just one block that may report it. The number of
classes follows the number of words, so blocks grow slower than the vocabulary. A block beyond ``BLOCK_ROWS`` is cut
into parts, and every two parts meet in a task of their own.

Defined cases: a null text has no words; a null id counts as empty text in the checksum; repeated rows count again;
a word of any length is handled (counts are compared in double precision where single could round); an empty table
gives no rows.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import batch_chunks, materialise, narrowed, small_batches
from reviewloom.llm.words import lowered, mix
from reviewloom.session import broadcast_if_small

SHORTEST = 6
SEEN = 5
TYPO_EVERY = 199
FORM_RATIO = 5
# Words counted in a task before partial counts are handed on.
HELD_WORDS = 200_000
# Words of one block that meet in one task.
BLOCK_ROWS = 8_192
# Rows of one matrix: smaller blocks share one, larger ones are multiplied piece by piece.
GRAM_ROWS = 384
# a-z and U+00C0 to U+00FF.
LETTERS = 26 + 64
# Up to this length squared letter counts are exact in single precision.
SINGLE_LENGTH = 2_048


def typo(run: bytes, start: int) -> bytes:
    """The run without one of its letters where the checksum of ``<doc_id>:<run>`` says so; ``start`` is that of
    ``<doc_id>:``."""
    h = zlib.crc32(run, start)
    if h % TYPO_EVERY:
        return run
    letters = run.decode()
    k = h % len(letters)
    return (letters[:k] + letters[k + 1 :]).encode()


def letter_runs(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case and all that is no letter of the contract blank."""
    low = lowered(data)
    lead = data == 0xC3  # U+00C0 to U+00FF are this byte and one more
    inside = ((low >= 97) & (low <= 122)) | lead
    inside[1:] |= lead[:-1]
    return np.where(inside, low, np.uint8(32))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): how often each result of at least six letters occurs, where it does so at least five times."""
    rows = narrowed(docs, "doc_id", "text").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            words = [w.decode() for w in held]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for part, data, offsets in batch_chunks(batch, "text"):
                raw = letter_runs(data).tobytes()
                for doc, s, e in zip(part.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                    start = zlib.crc32(f"{doc}:".encode())
                    for run, n in Counter(raw[s:e].split()).items():
                        if len(run) >= SHORTEST:
                            word = typo(run, start)
                            if len(word) >= SHORTEST and (word.isascii() or len(word.decode()) >= SHORTEST):
                                held[word] += n
                if len(held) >= HELD_WORDS:
                    yield out()
                    held.clear()
        yield out()

    counted = rows.mapInArrow(work, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= SEEN)


def classes_for(words: int) -> int:
    """Classes of letters for a vocabulary: one more each time it doubles."""
    return min(LETTERS, max(4, round(math.log2(max(words, 1))) - 10))


def class_of_letter(classes: int) -> np.ndarray:
    """Deals letters out so that neighbours in the alphabet fall into different classes."""
    return np.arange(LETTERS) % classes


def letter_codes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Letter numbers of all words in a row, and where each word begins."""
    joined = "".join(words.to_pylist())
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    return np.where(points >= 0xC0, points - 0xC0 + 26, points - 97), np.concatenate([[0], np.cumsum(lengths)])


def letter_counts(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    n, lengths = len(at) - 1, np.diff(at)
    kind = np.float32 if lengths.max(initial=0) <= SINGLE_LENGTH else np.float64
    cell = np.repeat(np.arange(n), lengths) * LETTERS + codes
    return np.bincount(cell, minlength=n * LETTERS).reshape(n, LETTERS).astype(kind)


def _class_counts(counts: np.ndarray, classes: int) -> np.ndarray:
    return np.stack([counts[:, class_of_letter(classes) == k].sum(axis=1) for k in range(classes)], axis=1).astype(np.int64)


def _blocks(classes: int):
    """(key, word, n, taken): a word's own block (``taken`` is -1) and those without a letter of class ``taken``."""
    factor = mix(np.arange(1, classes + 1, dtype=np.uint64))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = _class_counts(letter_counts(*letter_codes(batch.column(0))), classes)
            total = (own.astype(np.uint64) * factor).sum(axis=1, dtype=np.uint64)
            rows, taken = np.nonzero(own)
            row = np.concatenate([np.arange(len(own)), rows])
            key = mix(np.concatenate([total, total[rows] - factor[taken]]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64)),
                    batch.column(0).take(pa.array(row)),
                    batch.column(1).take(pa.array(row)),
                    pa.array(np.concatenate([np.full(len(own), -1), taken]), pa.int32()),
                ],
                ["key", "word", "n", "taken"],
            )

    return work


def one_edit(codes: np.ndarray, at: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the words of each pair differ by exactly one inserted, deleted or replaced letter; a is not longer."""
    size = np.diff(at)
    good = np.zeros(len(a), bool)
    for length in np.unique(size[a]):
        for longer in (0, 1):
            use = np.flatnonzero((size[a] == length) & (size[b] == length + longer))
            # pieces keep very long words from filling the memory
            for piece in np.array_split(use, max(1, len(use) * int(length) // (1 << 22))):
                place = np.arange(length)
                x = codes[at[a[piece]][:, None] + place]
                front = x == codes[at[b[piece]][:, None] + place]
                if longer:
                    back = x == codes[at[b[piece]][:, None] + place + 1]
                    head = np.cumprod(front, axis=1).sum(axis=1)
                    tail = np.cumprod(back[:, ::-1], axis=1).sum(axis=1)
                    good[piece] = head + tail >= length
                else:
                    good[piece] = (~front).sum(axis=1) == 1
    return good


def _near(classes: int):
    """(word, n, other, other_n) in both directions for all pairs one edit apart, from rows sorted by block."""
    dealt = class_of_letter(classes)

    def met(block: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        key, taken, side = (np.asarray(block.column(i)) for i in (0, 3, 4))
        codes, at = letter_codes(block.column(1))
        size = np.diff(at)
        n = len(key)
        new = np.ones(n, bool)
        new[1:] = key[1:] != key[:-1]
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], n)
        last = np.repeat(ends, ends - starts)

        def close(rows: slice, columns: slice) -> tuple[np.ndarray, np.ndarray]:
            x = letter_counts(codes[at[rows.start] : at[rows.stop]], at[rows.start : rows.stop + 1] - at[rows.start])
            y = x if rows == columns else letter_counts(codes[at[columns.start] : at[columns.stop]], at[columns.start : columns.stop + 1] - at[columns.start])
            squares = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)
            i, j = np.nonzero(squares <= 2)
            return i + rows.start, j + columns.start

        found_a, found_b = [], []
        begin = 0
        while begin < n:
            # whole small blocks together, or one piece of a large block against the rest of it
            stop = int(last[begin])
            while stop < n and last[stop] - begin <= GRAM_ROWS:
                stop = int(last[stop])
            if stop - begin > 1:
                edges = list(range(begin, stop, GRAM_ROWS)) + [stop]
                pieces = [slice(s, e) for s, e in zip(edges[:-1], edges[1:])]
                for p, rows in enumerate(pieces):
                    for columns in pieces[p:]:
                        i, j = close(rows, columns)
                        use = (i < j) & (key[i] == key[j]) & (np.abs(size[i] - size[j]) <= 1) & ((side[i] == 0) | (side[i] != side[j]))
                        i, j = i[use], j[use]
                        # a longer word is there for its lost letter only, a shorter one as it is; of words of one
                        # length either lost one. The same class lost reports where it is the word's first class.
                        shorter_i = size[i] <= size[j]
                        a, b = np.where(shorter_i, i, j), np.where(shorter_i, j, i)
                        grown = size[a] < size[b]
                        use = np.where(grown, (taken[a] < 0) & (taken[b] >= 0), (taken[a] >= 0) & (taken[b] >= 0))
                        found_a.append(a[use])
                        found_b.append(b[use])
            begin = stop
        if not found_a:
            return
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        keep = one_edit(codes, at, a, b)
        a, b = a[keep], b[keep]
        if not len(a):
            return
        # few pairs are left: the block is theirs exactly, not by its hash alone
        both = np.unique(np.concatenate([a, b]))
        words = block.column(1)
        counts = _class_counts(letter_counts(*letter_codes(words.take(pa.array(both)))), classes)
        at_a, at_b = np.searchsorted(both, a), np.searchsorted(both, b)
        left_a, left_b = counts[at_a], counts[at_b]
        first = (left_a > 0).argmax(axis=1)
        pair = np.arange(len(a))
        less_a, less_b = left_a.copy(), left_b.copy()
        less_a[pair[taken[a] >= 0], taken[a][taken[a] >= 0]] -= 1
        less_b[pair[taken[b] >= 0], taken[b][taken[b] >= 0]] -= 1
        same = (less_a == less_b).all(axis=1)
        own = (taken[a] != taken[b]) | (taken[a] == first)
        a, b = a[same & own], b[same & own]
        counted = block.column(2)
        x, y = pa.array(np.concatenate([a, b])), pa.array(np.concatenate([b, a]))
        yield pa.RecordBatch.from_arrays([words.take(x), counted.take(x), words.take(y), counted.take(y)], ["word", "n", "other", "other_n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.asarray(batch.column(0))
            change = np.flatnonzero(key != key[-1])
            if len(change) or (waiting and waiting[-1].column(0)[0].as_py() != key[0]):
                last = int(change[-1]) + 1 if len(change) else 0
                yield from met(pa.Table.from_batches([*waiting, batch.slice(0, last)]).combine_chunks().to_batches()[0])
                waiting = []
                batch = batch.slice(last)
            waiting.append(batch)
        if waiting:
            yield from met(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])

    return work


def near_words(words: DataFrame, block_rows: int = BLOCK_ROWS, classes: int | None = None) -> DataFrame:
    """(word, n, other, other_n): all pairs of ``words`` one edit apart, in both directions."""
    spark = words.sparkSession
    total = words.count()
    classes = classes or classes_for(total)
    blocks = materialise(words.select("word", "n").mapInArrow(_blocks(classes), "key bigint, word string, n bigint, taken int"), "blocks")
    sizes = blocks.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > block_rows)
    wide = materialise(sizes.select("key", F.ceil(F.col("rows") / block_rows).cast("int").alias("parts")), "wide")
    rows = blocks.withColumn("side", F.lit(0))
    if not wide.isEmpty():
        # at most one wide block for each ``block_rows`` rows
        small = broadcast_if_small(wide)
        part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
        split = blocks.join(small, "key").withColumn("_part", part)
        split = split.withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        low, high = F.least("_part", "_with"), F.greatest("_part", "_with")
        side = F.when(low == high, 0).otherwise(F.when(F.col("_part") == low, 1).otherwise(2))
        split = split.select(F.xxhash64("key", low, high).alias("key"), "word", "n", "taken", side.alias("side"))
        rows = blocks.join(small, "key", "left_anti").withColumn("side", F.lit(0)).unionByName(split)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // 50_000)
    dealt = rows.select("key", "word", "n", "taken", "side").repartition(tasks, "key").sortWithinPartitions("key")
    return dealt.mapInArrow(_near(classes), "word string, n bigint, other string, other_n bigint")


def variants(docs: DataFrame, block_rows: int = BLOCK_ROWS, classes: int | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n): one row per word.

    ``form`` is the most frequent near word (ties: first in code-point order) where that is at least five times as
    frequent; ``root`` is where the forms of forms end. A form's count is five times the last one's, so chains are
    short, and each round doubles the steps taken.
    """
    small_batches(docs.sparkSession)
    words = materialise(word_counts(docs), "words")
    near = near_words(words, block_rows, classes)
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    by_word = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    of_form = F.col("best")["less"] * -1
    joined = words.join(by_word, "word", "left").withColumn("_strong", F.coalesce(of_form >= FORM_RATIO * F.col("n"), F.lit(False)))
    formed = materialise(
        joined.select(
            "word",
            F.when(F.col("_strong"), F.col("best")["other"]).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(F.col("_strong"), of_form).alias("form_n"),
        ),
        "formed",
    )
    steps = formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumped = materialise(steps.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        steps = jumped.select("word", "root")
        if jumped.where("moved").isEmpty():
            break
    rooted = formed.join(steps, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
