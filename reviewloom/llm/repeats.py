"""Removal of repeated passages: every byte inside a string of ``span`` bytes that an earlier document has too.

Texts are UTF-8 bytes. A string of ``span`` bytes is judged on the input: if it also starts in a document with a
smaller id, all its bytes go, whatever else is removed. Documents are cut into shards by content, not by id:
each string of ``span`` bytes has a representative, the run of ``GRAM`` bytes inside it with the smallest hash,
and all strings around one representative form a segment that goes to the shard of the representative's
hash. Equal strings thus meet in one shard wherever they stand. Representatives that only one text has are
found first, from packed hashes, and their segments stay at home. A shard sorts the suffixes of its distinct
segments by induced sorting, takes the permuted common prefixes, and gives every string the smallest id of
its run.

Copies of a whole text are judged once: a later copy goes as a whole, if it is long enough.

Defined cases: a null text counts as empty; a null id counts as larger than every other id; rows with equal ids
are documents of the same rank, so neither removes from the other; every input row gives one output row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import batch_chunks, materialise, narrowed, one_worker_each, small_batches
from reviewloom.llm.suffixes import permuted_prefixes, suffix_array
from reviewloom.llm.words import mix, power_tables

SPAN = 50
GRAM = 20
# Bytes of text that numpy works on at once, that a shard of hashes stands for, whose hashes make a row, and of a chunk.
PIECE = 1 << 18
SHARD_TEXT = 1 << 24
ROW_TEXT = 1 << 14
MOST_CHUNK = 1 << 25
SHARD_BYTES = 1 << 20
# Strings of a shard that are compared with their smallest ids at once.
STRINGS = 1 << 18
LAST_ID = (1 << 63) - 1
_PLACE_BITS = np.uint64(28)

CHUNK_SCHEMA = (
    "chunk bigint, doc_ids array<bigint>, kinds binary, digests array<binary>, leasts array<bigint>, offsets array<binary>, bytes array<binary>"
)


def dealt(text_bytes: int, parts: int) -> tuple[int, int]:
    """Number of shards and bytes of text in a chunk.

    Every chunk sends a row to almost every shard. So a chunk grows with the number of shards, up to ``MOST_CHUNK``,
    and these rows stay as long as they are, instead of growing in number with the square of the input.
    """
    shards = max(parts, -(-text_bytes // SHARD_TEXT))
    return shards, min(max(shards * ROW_TEXT, PIECE), MOST_CHUNK)


def _stored(limit: int):
    """Texts as chunks of compressed pieces, with a number that stays the same in all later passes.

    A chunk names each different text once, with its smallest id there. Any column after id and text stays beside it.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held, size = 0, [], 0
        press = zstandard.ZstdCompressor(level=1)

        def chunk() -> pa.RecordBatch:
            parts, ids, digests = [h[0] for h in held], [], []
            for part, own, _, _ in held:
                ids += part.column(0).to_pylist()
                digests += own
            number: dict[bytes, int] = {}
            kinds = np.array([number.setdefault(d, len(number)) for d in digests], np.int32)
            least = np.full(len(number), LAST_ID, np.int64)
            np.minimum.at(least, kinds, np.array([LAST_ID if i is None else i for i in ids], np.int64))
            more = [pa.concat_arrays([p.column(k) for p in parts]) for k in range(2, parts[0].num_columns)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(TaskContext.get().partitionId() << 32) + made], pa.int64()),
                    pa.array([ids], pa.list_(pa.int64())),
                    pa.array([kinds.tobytes()], pa.binary()),
                    pa.array([list(number)], pa.list_(pa.binary())),
                    pa.array([least], pa.list_(pa.int64())),
                    pa.array([[h[2] for h in held]], pa.list_(pa.binary())),
                    pa.array([[h[3] for h in held]], pa.list_(pa.binary())),
                    *[pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), c) for c in more],
                ],
                ["chunk", "doc_ids", "kinds", "digests", "leasts", "offsets", "bytes", *parts[0].schema.names[2:]],
            )

        for batch in batches:
            for part, data, offsets in batch_chunks(batch, "text", PIECE):
                if held and size + len(data) > limit:
                    yield chunk()
                    made, held, size = made + 1, [], 0
                raw = data.tobytes()
                digests = [hashlib.md5(raw[a:b], usedforsecurity=False).digest() for a, b in zip(offsets[:-1], offsets[1:])]
                held.append((part, digests, offsets.astype(np.int64).tobytes(), press.compress(raw)))
                size += len(data)
        if held:
            yield chunk()

    return work


def _pieces(offsets: pa.Scalar, raws: pa.Scalar) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Pieces of a chunk: first text's number, first byte's place, offsets and bytes."""
    text = base = 0
    press = zstandard.ZstdDecompressor()
    for at, raw in zip(offsets.values, raws.values):
        own, data = np.frombuffer(at.as_buffer(), np.int64), np.frombuffer(press.decompress(raw.as_buffer()), np.uint8)
        yield text, base, own, data
        text, base = text + len(own) - 1, base + len(data)


def _chunk_segments(offsets: pa.Scalar, raws: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of a whole chunk, places within their pieces; and where each piece's segments begin."""
    found = []
    for text, _, own, data in _pieces(offsets, raws):
        first, last, hashes, owner = segments(data, own)
        found.append((first.astype(np.int32), last.astype(np.int32), hashes, (owner + text).astype(np.int32)))
    return *(np.concatenate(c) for c in zip(*found)), np.cumsum([0] + [len(f[0]) for f in found])


def _by_shard(hashes: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of segments by shard, the shards there are, and where each begins."""
    shard = (hashes >> np.uint64(40)) % np.uint64(shards)
    order = np.argsort(shard.astype(np.uint16) if shards < 1 << 16 else shard, kind="stable")
    used, starts = np.unique(shard[order], return_index=True)
    return order, used, np.append(starts, len(order))


def _ids(ids: pa.Scalar) -> np.ndarray:
    return ids.values.fill_null(LAST_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def _whole(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column, one value after the other, and their lengths."""
    values, lengths = [np.zeros(0, np.uint8)], [np.zeros(0, np.int64)]
    for part in column.chunks:
        if len(part):
            at = np.frombuffer(part.buffers()[1], np.int32)[part.offset : part.offset + len(part) + 1].astype(np.int64)
            values.append(np.frombuffer(part.buffers()[2], np.uint8)[at[0] : at[-1]])
            lengths.append(np.diff(at))
    return np.concatenate(values), np.concatenate(lengths)


def _binary(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(values))])


def segments(data: np.ndarray, offsets: np.ndarray, span: int = SPAN, gram: int = GRAM):
    """Runs of neighbouring strings with one representative: first and last string start, hash, text number."""
    n, width = len(data), span - gram + 1
    none = np.zeros(0, np.int64)
    if n < span:
        return none, none, none.astype(np.uint64), none
    up, down = power_tables(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    hashes = mix((total[gram:] - total[:-gram]) * down[: n - gram + 1])
    # the place in the low bits makes the leftmost of equal hashes the smallest
    best = ((hashes >> _PLACE_BITS) << _PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        best = np.minimum(best[:-step], best[step:])
        reach += step
    place = (best & np.uint64((1 << 28) - 1)).astype(np.int64)
    valid = np.zeros(n + 1, np.int32)
    long = np.diff(offsets) >= span
    np.add.at(valid, offsets[:-1][long], 1)
    np.add.at(valid, offsets[1:][long] - span + 1, -1)
    valid = np.cumsum(valid[: len(place)]) > 0
    owner_start = np.zeros(len(place), bool)
    owner_start[offsets[:-1][long]] = True
    begins = valid & owner_start
    begins[1:] |= valid[1:] & (place[1:] != place[:-1])
    first = np.flatnonzero(begins)
    stops = np.zeros(len(place), bool)
    stops[:-1] = valid[:-1] & (begins[1:] | ~valid[1:])
    stops[-1] = valid[-1]
    last = np.flatnonzero(stops)
    return first, last, hashes[place[first]], np.searchsorted(offsets, first, side="right") - 1


def _hash_blobs(shards: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, kinds, digests, offsets, raws in zip(*(batch.column(i) for i in range(5))):
                _, _, hashes, owner, _ = _chunk_segments(offsets, raws)
                nodes = np.array([int.from_bytes(d[:8], "little") for d in digests.as_py()], np.uint64)
                order, used, cuts = _by_shard(hashes, shards)
                short = (hashes[order] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                whose = np.frombuffer(kinds.as_py(), np.int32)[owner[order]]
                owners = [np.unique(whose[a:b], return_inverse=True) for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(used.astype(np.int64)),
                        pa.array([chunk.as_py()] * len(used), pa.int64()),
                        pa.array([short[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                        pa.array([nodes[u].tobytes() for u, _ in owners], pa.binary()),
                        pa.array([i.astype(np.uint32).tobytes() for _, i in owners], pa.binary()),
                    ],
                    ["shard", "chunk", "hashes", "nodes", "owners"],
                )

    return work


def _shared(group: pa.Table) -> pa.Table:
    """For every hash sent to this shard, whether texts with different content have it, as packed bits."""
    parts, nodes = [], []
    for h, n, o in zip(group.column("hashes"), group.column("nodes"), group.column("owners")):
        parts.append(np.frombuffer(h.as_py(), np.uint32))
        nodes.append(np.frombuffer(n.as_py(), np.uint64)[np.frombuffer(o.as_py(), np.uint32)])
    hashes, node = np.concatenate(parts), np.concatenate(nodes)
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    starts = np.concatenate([[0], np.flatnonzero(np.diff(ordered)) + 1])
    several = np.minimum.reduceat(node[order], starts) != np.maximum.reduceat(node[order], starts)
    flags = np.empty(len(hashes), bool)
    flags[order] = np.repeat(several, np.diff(np.append(starts, len(ordered))))
    cuts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    found = [flags[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
    return pa.table(
        {
            "chunk": group.column("chunk"),
            "shard": group.column("shard"),
            "n": pa.array([int(f.sum()) for f in found], pa.int64()),
            "flags": pa.array([np.packbits(f).tobytes() for f in found], pa.binary()),
        }
    )


def _shared_segments(shards: int, homes: int):
    """A row for every different segment of a piece that other texts may have, with the places and ids it has there."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, ids, kinds, firsts, offsets, raws, replies in zip(*(batch.column(i) for i in range(7))):
                ids, kinds = _ids(ids), np.frombuffer(kinds.as_py(), np.int32)
                lead = _ids(firsts)[kinds] == ids
                first, last, hashes, owner, at = _chunk_segments(offsets, raws)
                order, used, starts = _by_shard(hashes, shards)
                flags = np.zeros(len(first), bool)
                cuts = dict(zip(used.tolist(), zip(starts[:-1].tolist(), starts[1:].tolist())))
                for reply in replies.as_py():
                    a, b = cuts[reply["shard"]]
                    flags[order[a:b]] = np.unpackbits(np.frombuffer(reply["flags"], np.uint8), count=b - a).astype(bool)
                flags &= lead[owner]
                for a, b, (_, base, _, data) in zip(at[:-1], at[1:], _pieces(offsets, raws)):
                    pick = a + np.flatnonzero(flags[a:b])
                    if not len(pick):
                        continue
                    begin = first[pick].astype(np.int64)
                    lengths, whose = last[pick] - begin + SPAN, ids[owner[pick]]
                    sample, kind = distinct_ranges(data, begin, lengths)
                    order = np.argsort(kind, kind="stable")
                    places = np.stack([begin[order] + base, whose[order]], axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(((hashes[pick[sample]] >> np.uint64(20)) % np.uint64(homes)).astype(np.int64)),
                            pa.array(np.full(len(sample), chunk.as_py())),
                            _binary(data[_ranges_of(begin[sample], lengths[sample])], lengths[sample]),
                            _binary(places, np.bincount(kind) * 16),
                        ],
                        ["home", "chunk", "bytes", "places"],
                    )

    return work


def _ranges_of(begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all given ranges, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(begin - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def distinct_ranges(data: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One index for every distinct content among ranges of bytes in order, and the content's number for each range.

    Contents are told apart by length and two 64-bit hashes. Ranges are hashed some ``PIECE`` bytes at a time, so that
    many copies of a passage cost their bytes and no tables over all of them.
    """
    end = begin + lengths
    cuts = np.unique(np.append(np.searchsorted(end, np.arange(0, end[-1] if len(end) else 0, PIECE)), len(end)))
    parts = [_range_keys(data[begin[i] : end[j - 1]], begin[i:j] - begin[i], lengths[i:j]) for i, j in zip(cuts[:-1], cuts[1:])]
    keys = np.concatenate([np.zeros((2, 0), np.uint64), *parts], axis=1)
    order = np.lexsort((keys[1], keys[0]))
    new = np.ones(len(order), bool)
    new[1:] = (keys[0][order][1:] != keys[0][order][:-1]) | (keys[1][order][1:] != keys[1][order][:-1])
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(new) - 1
    return order[new], kind


def _range_keys(data: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Two hashes of each range, which do not depend on its place."""
    up, down = power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    keys = []
    for twist in (1, 131):
        np.cumsum(mix(data.astype(np.uint64) + np.uint64(twist)) * up[: len(data)], out=total[1:])
        keys.append(mix((total[begin + lengths] - total[begin]) * down[begin] + lengths.astype(np.uint64)))
    return np.stack(keys)


def smallest_owner(raw: np.ndarray, lengths: np.ndarray, ids: np.ndarray, span: int = SPAN) -> np.ndarray:
    """For every string of ``span`` bytes inside the segments, in order, the smallest id of a segment with it."""
    ends = np.cumsum(lengths)
    n = int(ends[-1])
    # symbols 2..257 for bytes, 1 after each segment, 0 at the end
    s = np.ones(n + len(lengths) + 1, np.int32)
    s[-1] = 0
    spot = np.arange(n) + np.repeat(np.arange(len(lengths)), lengths)
    s[spot] = raw.astype(np.int32) + 2
    left = np.zeros(len(s), np.int64)
    left[spot] = np.repeat(ends, lengths) - np.arange(n)
    owner = np.full(len(s), LAST_ID, np.int64)
    owner[spot] = np.repeat(ids, lengths)
    flat = np.zeros(len(s), np.uint8)
    flat[spot] = raw
    order = suffix_array(s.astype(np.int16))
    common = permuted_prefixes(flat, left, order, span)
    new = common[order] < span
    new[0] = True
    starts = np.flatnonzero(new)
    least = np.minimum.reduceat(owner[order], starts)
    result = np.empty(len(s), np.int64)
    result[order] = np.repeat(least, np.diff(np.append(starts, len(order))))
    return result[spot[left[spot] >= span]]


def _sorted_shard(group: pa.Table) -> pa.Table:
    """Ranges to remove in each chunk, from the suffix array over the shard's distinct segments."""
    raw, lengths = _whole(group.column("bytes"))
    places, counts = _whole(group.column("places"))
    starts, ids = places.view(np.int64).reshape(-1, 2).T
    counts = counts // 16
    begin = np.cumsum(lengths) - lengths
    sample, kind = distinct_ranges(raw, begin, lengths)
    least = np.full(len(sample), LAST_ID, np.int64)
    own = np.repeat(kind, counts)
    np.minimum.at(least, own, ids)
    size = lengths[sample]
    owners = smallest_owner(raw[_ranges_of(begin[sample], size)], size, least)
    strings = size - SPAN + 1
    first = np.cumsum(strings) - strings
    # a string goes if its smallest id is below the id of the document it stands in
    hit = np.flatnonzero(np.minimum.reduceat(owners, first)[own] < ids)
    chunk = np.repeat(group.column("chunk").to_numpy(), counts)[hit]
    own, starts, ids = own[hit], starts[hit], ids[hit]
    total = np.cumsum(strings[own])
    cuts = np.unique(np.append(np.searchsorted(total, np.arange(0, total[-1] if len(total) else 0, STRINGS)), len(total)))
    lows, highs, chunks = [], [], []
    for i, j in zip(cuts[:-1], cuts[1:]):
        count = strings[own[i:j]]
        ends = np.cumsum(count)
        gone = owners[_ranges_of(first[own[i:j]], count)] < np.repeat(ids[i:j], count)
        edge = np.zeros(len(gone) + 1, bool)
        edge[np.append(ends - count, ends[-1])] = True
        a = np.flatnonzero(gone & (edge[:-1] | ~np.concatenate([[False], gone[:-1]])))
        b = np.flatnonzero(gone & (edge[1:] | ~np.concatenate([gone[1:], [False]])))
        which = np.searchsorted(ends, a, side="right")
        shift = starts[i:j][which] - (ends - count)[which]
        lows.append(a + shift)
        highs.append(b + shift + SPAN)
        chunks.append(chunk[i:j][which])
    none = [np.zeros(0, np.int64)]
    return pa.table({name: np.concatenate(none + found) for name, found in (("chunk", chunks), ("low", lows), ("high", highs))})


def _cleaned(keep_text: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*batch.columns):
                yield from cleaned(row, batch.schema.names[6:])

    def cleaned(row: tuple, more: list[str]) -> Iterator[pa.RecordBatch]:
        all_ids, kinds, firsts, all_offsets, raws, replies, *beside = row
        ids, kinds = _ids(all_ids), np.frombuffer(kinds.as_py(), np.int32)
        copy = _ids(firsts)[kinds] != ids
        low = high = np.zeros(0, np.int64)
        if replies.is_valid:
            low, high = (replies.values.field(k).to_numpy() for k in (0, 1))
            order = np.argsort(low)
            low, high = low[order], high[order]
        for text, base, offsets, data in _pieces(all_offsets, raws):
            cover = np.zeros(len(data) + 1, np.int32)
            own = slice(*np.searchsorted(low, [base, base + len(data)]))
            np.add.at(cover, low[own] - base, 1)
            np.add.at(cover, high[own] - base, -1)
            gone = np.cumsum(cover[:-1]) > 0
            n = len(offsets) - 1
            for k in np.flatnonzero(copy[text : text + n] & (np.diff(offsets) >= SPAN)):
                gone[offsets[k] : offsets[k + 1]] = True
            begins = gone & np.concatenate([[True], ~gone[:-1]]) if len(gone) else gone
            begins[offsets[:-1][offsets[:-1] < len(gone)]] |= gone[offsets[:-1][offsets[:-1] < len(gone)]]
            removed = np.concatenate([[0], np.cumsum(gone)])
            spans = np.concatenate([[0], np.cumsum(begins)])
            left = data[~gone].tobytes()
            at = offsets - removed[offsets]
            texts = [left[a:b] for a, b in zip(at[:-1], at[1:])]
            columns = [
                all_ids.values.slice(text, n),
                pa.array(np.diff(offsets), pa.int64()),
                pa.array(np.diff(removed[offsets]), pa.int64()),
                pa.array(np.diff(spans[offsets]), pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
            ]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_text:
                # a cut may fall inside a character; what is left of it goes as well
                columns.append(pa.array([t.decode("utf-8", "ignore") for t in texts], pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(columns + [c.values.slice(text, n) for c in beside], names + more)

    return work


def without_repeats(docs: DataFrame, keep_text: bool = False, beside: Column | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept_text][, beside]), one row per input row.

    ``n_spans`` counts the maximal runs of removed bytes; ``kept_sha256`` is over the remaining bytes. The text
    that is left comes with ``keep_text``. ``beside`` is a column of the input to hand on unchanged.
    """
    spark = docs.sparkSession
    small_batches(spark)
    parts = one_worker_each(spark)
    source = narrowed(docs, "doc_id", "text") if beside is None else docs
    more = [] if beside is None else [beside.alias("beside")]
    rows = source.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *more)
    kind = rows.schema["beside"].dataType.simpleString() if more else ""
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    shards, limit = dealt(size, parts)
    chunks = materialise(rows.mapInArrow(_stored(limit), CHUNK_SCHEMA + (f", beside array<{kind}>" if more else "")), "texts")
    # the smallest id of every distinct text, in the order of each chunk's distinct texts
    flat = chunks.select("chunk", F.posexplode(F.arrays_zip("leasts", "digests")).alias("place", "d"))
    flat = flat.select("chunk", "place", F.col("d.leasts").alias("least"), F.col("d.digests").alias("digest"))
    least = flat.groupBy("digest").agg(F.min("least").alias("first"))
    firsts = (
        flat.join(least, "digest")
        .groupBy("chunk")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "first"))), lambda x: x["first"]).alias("firsts"))
    )
    sent = chunks.select("chunk", "kinds", "digests", "offsets", "bytes").mapInArrow(
        _hash_blobs(shards), "shard bigint, chunk bigint, hashes binary, nodes binary, owners binary"
    )
    flags = materialise(sent.groupBy("shard").applyInArrow(_shared, "chunk bigint, shard bigint, n bigint, flags binary"), "flags")
    shared = flags.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    homes = max(parts, -(-shared * 2 * SPAN // SHARD_BYTES))
    replies = flags.groupBy("chunk").agg(F.collect_list(F.struct("shard", "flags")).alias("replies"))
    known = chunks.drop("digests", "leasts").join(firsts, "chunk")
    asked = chunks.drop("beside").join(firsts, "chunk").join(replies, "chunk")
    found = asked.select("chunk", "doc_ids", "kinds", "firsts", "offsets", "bytes", "replies").mapInArrow(
        _shared_segments(shards, homes), "home bigint, chunk bigint, bytes binary, places binary"
    )
    ranges = found.groupBy("home").applyInArrow(_sorted_shard, "chunk bigint, low bigint, high bigint")
    ranges = materialise(ranges, "ranges").groupBy("chunk").agg(F.collect_list(F.struct("low", "high")).alias("replies"))
    whole = known.join(ranges, "chunk", "left").select(
        "doc_ids", "kinds", "firsts", "offsets", "bytes", "replies", *(["beside"] if more else [])
    )
    text = (", kept_text string" if keep_text else "") + (f", beside {kind}" if more else "")
    return whole.mapInArrow(
        _cleaned(keep_text), f"doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string{text}"
    )
