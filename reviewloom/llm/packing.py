"""Packing documents into sequences of a fixed number of tokens, by patterns of lengths.

Documents are tokenised and cut into pieces; the pieces are counted by length; everything that decides which
lengths share a sequence works on that histogram, which has one entry per possible length whatever the
corpus. Patterns of one to four lengths that fill a sequence (nearly) are enumerated, non-negative least
squares fits how often each is repeated so that the patterns use up the histogram, the repeats are rounded
down, and the lengths left over are packed best-fit, largest first, again by counts. The plan gives every
(length, rank) its sequence and offset; ranks inside a length come from one count per task.

Defined cases: a null text counts as empty, and an empty text is one piece with the end token; equal ids and
equal texts are packed as separate documents; an empty table gives an empty result. Markers that the tokenizer
adds, such as <|endoftext|>, are text like any other unless ``as_loaded``, which gives them their own ids.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import batch_chunks, materialise, narrowed, small_batches
from reviewloom.llm.words import mix, power_tables, word_spans

CAPACITY = 4096
END_ID = 1
# Units whose ids a Python worker remembers, some 30 bytes each and twice that while it learns; beyond that it starts to
# remember anew. Workers live from stage to stage, so what they hold stands beside all later work.
REMEMBERED = 400_000


@functools.lru_cache(maxsize=1)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    # texts are split at markers before, where that is wanted; a unit in lower case may only look like one
    tokenizer.encode_special_tokens = True
    return tokenizer


def _markers(tokenizer) -> dict[bytes, int]:
    """Bytes and id of every token added to the vocabulary; those found other than as they stand are refused."""
    found = {}
    for number, token in tokenizer.get_added_tokens_decoder().items():
        if token.normalized or token.single_word or token.lstrip or token.rstrip:
            raise ValueError(f"the added token {token.content!r} is not found by its bytes alone")
        found[token.content.encode()] = number
    return found


class WordIds:
    """Token ids of texts whose tokenizer ignores case, white space and what stands beside a run of letters.

    Texts are cut into units: a word, or where a word has only ASCII without apostrophes and Latin-1 letters,
    its runs of letters and digits and its runs of other signs, between which the tokenizer splits as well. The
    ids of a unit are asked of the tokenizer once and then found by the unit's 64-bit hash.
    """

    def __init__(self, path: str, as_loaded: bool = False):
        self.tokenizer = _tokenizer(path)
        self.markers = _markers(self.tokenizer) if as_loaded else {}
        # the first one in the text, and of those the longest
        self.marker = re.compile(b"|".join(re.escape(m) for m in sorted(self.markers, key=len, reverse=True))) if self.markers else None
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.uint32)

    def units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Lower-cased bytes, start and end of every unit, and where each text's units begin."""
        n = len(data)
        lead = data == 0xC3
        second = np.zeros(n, bool)
        second[1:] = lead[:-1]
        latin = second & (data != 0x97) & (data != 0xB7)
        upper = ((data >= 65) & (data <= 90)) | (latin & (data >= 0x80) & (data <= 0x9E))
        low = np.where(upper, data + np.uint8(32), data)
        good_lead = np.zeros(n, bool)
        good_lead[:-1] = latin[1:]
        high = data >= 128
        odd = (high & ~latin & ~(lead & good_lead)) | (data == 39) | (data < 32) | (data == 127)
        starts, ends, _ = word_spans(low, offsets)
        odds = np.concatenate([[0], np.cumsum(odd)])
        whole = np.repeat(odds[ends] != odds[starts], ends - starts)
        inside = np.zeros(n + 1, np.int8)
        # no two words have a start in common, nor an end
        inside[starts] += 1
        inside[ends] -= 1
        covered = np.cumsum(inside[:-1]) > 0
        stay = np.zeros(n, bool)
        stay[covered] = whole
        letter = high | ((low >= 97) & (low <= 122)) | ((low >= 48) & (low <= 57))
        cut = np.zeros(n + 1, bool)
        cut[starts] = True
        cut[1:n] |= covered[1:] & covered[:-1] & ~stay[1:] & (letter[1:] != letter[:-1])
        first = np.flatnonzero(cut)
        # a unit ends where the next begins or its word ends
        word = np.searchsorted(starts, first, side="right") - 1
        last = np.minimum(np.append(first[1:], n), ends[word]) if len(first) else first
        return low, first, last, np.searchsorted(first, offsets)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash in the store, or -1."""
        if len(self.hashes) == 0:
            return np.full(len(hashes), -1)
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[place] == hashes, place, -1)

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.array([len(x) for x in found], np.int32)
        flat = np.fromiter((i for x in found for i in x), np.uint32, int(sizes.sum()))
        every = np.concatenate([self.hashes, hashes])
        order = np.argsort(every, kind="stable")
        starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.hashes, self.starts, self.sizes = every[order], starts[order], np.concatenate([self.sizes, sizes])[order]
        self.flat = np.concatenate([self.flat, flat])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's ids begin."""
        raw = data.tobytes() if self.marker else b""
        if not self.marker or not self.marker.search(raw):
            return self._encoded(data, offsets)
        bounds, at_text, places, own = [], [], [], []
        for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            at_text.append(len(bounds))
            bounds.append(start)
            for found in self.marker.finditer(raw, start, end):
                places.append(len(bounds))
                own.append(self.markers[found.group()])
                bounds += found.span()
        at_text.append(len(bounds))
        bounds.append(int(offsets[-1]))
        ids, at = self._encoded(data, np.array(bounds, np.int64))
        counts = np.diff(at)
        inside = np.repeat(~np.isin(np.arange(len(counts)), places), counts)
        counts[places] = 0
        before = np.concatenate([[0], np.cumsum(counts)])
        ids = np.insert(ids[inside], before[places], np.array(own, np.uint32))
        counts[places] = 1
        return ids, np.concatenate([[0], np.cumsum(counts)])[at_text]

    def _encoded(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts without markers."""
        low, starts, ends, at = self.units(data, offsets)
        if len(starts) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        up, down = power_tables(len(low) + 1)
        total = np.zeros(len(low) + 1, np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[: len(low)], out=total[1:])
        hashes, first, which = np.unique(mix((total[ends] - total[starts]) * down[starts]), return_index=True, return_inverse=True)
        if len(self.hashes) + len(hashes) > REMEMBERED:
            self.forget()
        new = np.flatnonzero(self._find(hashes) < 0)
        if len(new):
            raw = low.tobytes()
            self._learn(hashes[new], [raw[starts[i] : ends[i]].decode() for i in first[new]])
        place = self._find(hashes)[which]
        counts = self.sizes[place].astype(np.int64)
        ends_at = np.cumsum(counts)
        take = np.repeat(self.starts[place] - (ends_at - counts), counts) + np.arange(ends_at[-1])
        return self.flat[take], np.concatenate([[0], ends_at])[at]


@functools.lru_cache(maxsize=1)
def _encoder(path: str, as_loaded: bool) -> WordIds:
    """One store per Python worker, kept from task to task."""
    return WordIds(path, as_loaded)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, as_loaded: bool = False) -> DataFrame:
    """(task, doc_id, piece, start, length, ids_crc32, rank): every document cut into pieces.

    ``rank`` counts the pieces of the same length inside the task.
    """
    small_batches(docs.sparkSession)
    rows = narrowed(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, as_loaded)
        task = TaskContext.get().partitionId()
        used = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for part, data, offsets in batch_chunks(batch, "text"):
                ids, at = encoder.encode(data, offsets)
                owners, numbers, starts, lengths, sums = [], [], [], [], []
                for i, doc_id in enumerate(part.column(0).to_pylist()):
                    own = np.append(ids[at[i] : at[i + 1]], np.uint32(end_id)).astype("<u4")
                    for number, start in enumerate(range(0, len(own), capacity)):
                        cut = own[start : start + capacity]
                        owners.append(doc_id)
                        numbers.append(number)
                        starts.append(start)
                        lengths.append(len(cut))
                        sums.append(zlib.crc32(cut.tobytes()))
                size = np.array(lengths, np.int64)
                order = np.argsort(size, kind="stable")
                ordered = size[order]
                place = np.arange(len(size)) - np.searchsorted(ordered, ordered)
                rank = np.empty(len(size), np.int64)
                rank[order] = place
                rank += used[size]
                used += np.bincount(size, minlength=capacity + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([task] * len(size), pa.int32()),
                        pa.array(owners, pa.int64()),
                        pa.array(numbers, pa.int32()),
                        pa.array(starts, pa.int64()),
                        pa.array(size),
                        pa.array(sums, pa.int64()),
                        pa.array(rank),
                    ],
                    ["task", "doc_id", "piece", "start", "length", "ids_crc32", "rank"],
                )

    return rows.mapInArrow(work, "task int, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, rank bigint")


def patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Candidate patterns of one to four of the given lengths, as rows of lengths padded with 0.

    For every length: alone; with the largest that still fits; and with a second length at one of several
    shares of the room left, completed by the largest lengths that fit. Patterns that fill the sequence
    exactly are found this way wherever the lengths are dense.
    """
    lengths = np.sort(lengths)

    def largest(room: np.ndarray) -> np.ndarray:
        """The largest length not above each room; 0 if none."""
        place = np.searchsorted(lengths, room, side="right")
        return np.where(place > 0, lengths[np.maximum(place - 1, 0)], 0)

    made = [np.stack([lengths, *[np.zeros_like(lengths)] * 3], axis=1)]
    room = capacity - lengths
    for share in (1.0, 0.85, 0.7, 0.6, 0.5, 0.4, 0.33, 0.25, 0.15, 0.08):
        second = largest((room * share).astype(np.int64))
        third = np.where(second > 0, largest(room - second), 0)
        made.append(np.stack([lengths, second, third, np.where(third > 0, largest(room - second - third), 0)], axis=1))
        third = np.where(second > 0, largest((room - second) // 2), 0)
        made.append(np.stack([lengths, second, third, np.where(third > 0, largest(room - second - third), 0)], axis=1))
    return np.unique(-np.sort(-np.concatenate(made), axis=1), axis=0)


def fitted_repeats(rows: np.ndarray, histogram: np.ndarray, capacity: int, steps: int = 400) -> np.ndarray:
    """Non-negative repeats of the patterns whose lengths add up to the histogram, by least squares.

    Accelerated projected gradient on the squared error, each length weighted by its tokens, with a small
    charge for unused room so that full patterns are preferred.
    """
    weight = np.sqrt(np.arange(capacity + 1) / capacity)
    target = histogram * weight
    present = rows > 0
    waste = (capacity - rows.sum(axis=1)) / capacity * max(1.0, float(target.max())) * 0.02

    def used(repeats: np.ndarray) -> np.ndarray:
        return sum(np.bincount(rows[:, k], repeats * present[:, k], capacity + 1) for k in range(rows.shape[1])) * weight

    def back(error: np.ndarray) -> np.ndarray:
        return sum((error * weight)[rows[:, k]] * present[:, k] for k in range(rows.shape[1]))

    vector = np.ones(len(rows))
    for _ in range(20):
        vector = back(used(vector))
        norm = np.linalg.norm(vector)
        vector /= max(norm, 1e-12)
    rate = 1.0 / max(norm * 1.05, 1e-9)
    repeats = np.zeros(len(rows))
    ahead, pace = repeats, 1.0
    for _ in range(steps):
        fresh = np.maximum(ahead - rate * (back(used(ahead) - target) + waste), 0)
        next_pace = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead, repeats, pace = fresh + (pace - 1) / next_pace * (fresh - repeats), fresh, next_pace
    return repeats


def plan(histogram: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Slots as rows (length, first rank, ranks, first sequence, per sequence, offset), and the number of sequences.

    ``histogram[n]`` counts the pieces of ``n`` tokens. A slot places ``ranks`` consecutive pieces of one length,
    ``per sequence`` of them side by side from ``offset`` on, in consecutive sequences.
    """
    left = histogram.astype(np.int64).copy()
    next_rank = np.zeros(capacity + 1, np.int64)
    slots: list[tuple[int, int, int, int, int, int]] = []
    sequences = 0

    def place(length: int, ranks: int, first: int, each: int, offset: int) -> None:
        slots.append((length, int(next_rank[length]), ranks, first, each, offset))
        next_rank[length] += ranks
        left[length] -= ranks

    def lay(contents: list[tuple[int, int]], count: int) -> None:
        """``count`` new sequences that each hold the given (length, how many)."""
        nonlocal sequences
        offset = 0
        for length, each in contents:
            place(length, count * each, sequences, each, offset)
            offset += length * each
        sequences += count

    some = np.flatnonzero(left)
    if len(some):
        rows = patterns(some, capacity)
        repeats = fitted_repeats(rows, histogram.astype(float), capacity)
        fill = rows.sum(axis=1)
        # rounding: whole repeats, fullest patterns first, never more than is left
        for k in np.lexsort((-repeats, -fill)):
            count = int(np.floor(repeats[k] + 0.5)) if fill[k] >= capacity * 0.999 else int(repeats[k]) if fill[k] >= capacity * 0.99 else 0
            if count:
                lengths, each = np.unique(rows[k][rows[k] > 0], return_counts=True)
                count = min(count, int((left[lengths] // each).min()))
                if count:
                    lay(list(zip(lengths[::-1].tolist(), each[::-1].tolist())), count)
    # best fit, largest first, over groups of sequences with equal room
    open_groups: dict[int, list[tuple[int, int]]] = {}
    for length in range(capacity, 0, -1):
        while left[length]:
            room = next((r for r in range(length, capacity + 1) if open_groups.get(r)), None)
            if room is None:
                each = capacity // length
                full, rest = divmod(int(left[length]), each)
                if full:
                    first = sequences
                    lay([(length, each)], full)
                    if capacity - each * length:
                        open_groups.setdefault(capacity - each * length, []).append((first, full))
                if rest:
                    first = sequences
                    lay([(length, rest)], 1)
                    open_groups.setdefault(capacity - rest * length, []).append((first, 1))
                continue
            first, count = open_groups[room].pop()
            used = min(count, int(left[length]))
            place(length, used, first, 1, capacity - room)
            if used < count:
                open_groups[room].append((first + used, count - used))
            if room > length:
                open_groups.setdefault(room - length, []).append((first, used))
    return np.array(sorted(slots), np.int64).reshape(-1, 6), sequences


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, as_loaded: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece."""
    spark = docs.sparkSession
    cut = materialise(pieces(docs, tokenizer, capacity, end_id, as_loaded), "pieces")
    counts = materialise(cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row per length at most
        histogram[row.length] = row.n
    slots, _ = plan(histogram, capacity)
    shared = spark.sparkContext.broadcast(slots)  # bounded by lengths and patterns, not by documents
    # pieces of the same length in earlier tasks come first: a running sum over (tasks x lengths) counts
    before = counts.withColumn("before", _running(counts))
    ranked = cut.join(before.select("length", "task", "before"), ["length", "task"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan_rows = shared.value
        keys = plan_rows[:, 0] * (1 << 44) + plan_rows[:, 1]
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            slot = plan_rows[np.searchsorted(keys, length * (1 << 44) + rank, side="right") - 1] if len(length) else plan_rows[:0]
            inside = rank - slot[:, 1]
            sequence = slot[:, 3] + inside // np.maximum(slot[:, 4], 1)
            offset = slot[:, 5] + inside % np.maximum(slot[:, 4], 1) * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank")).mapInArrow(
        work, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    )


def _running(counts: DataFrame):
    """Rows of the same length in tasks before this one; a window over at most one row per task."""
    from pyspark.sql import Window

    w = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("n").over(w), F.lit(0))
