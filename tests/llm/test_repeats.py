import tracemalloc

import brute
import numpy as np
import pytest
from conftest import frame, odd
from pyspark.sql import functions as F

from reviewloom.llm import repeats
from reviewloom.llm.repeats import without_repeats
from reviewloom.llm.suffixes import doubled, permuted_prefixes, suffix_array


@pytest.mark.parametrize("symbols", [1, 2, 3, 5, 40])
def test_suffix_array_is_sorted(symbols):
    rng = np.random.default_rng(symbols)
    for n in [1, 2, 3, 10, 60, 300]:
        s = np.append(rng.integers(1, symbols + 1, n), 0)
        assert suffix_array(s).tolist() == sorted(range(n + 1), key=lambda i: s[i:].tolist())
        assert doubled(s).tolist() == suffix_array(s).tolist()


def test_permuted_prefixes():
    rng = np.random.default_rng(1)
    raw = rng.integers(97, 99, 400).astype(np.uint8)
    order = suffix_array(np.append(raw.astype(np.int64), 0))[1:]
    left = len(raw) - np.arange(len(raw))
    got = permuted_prefixes(raw, left, order, 20)
    for a, b in zip(order[:-1], order[1:]):
        x, y = raw[a:].tobytes(), raw[b:].tobytes()
        same = next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))
        assert got[b] == min(same, 20)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_equals_dictionary_of_strings(spark, documents):
    assert as_rows(without_repeats(odd(spark, documents))) == sorted(brute.remove_repeats(documents), key=str)


def test_passages_copies_ties_and_nulls(spark):
    rng = np.random.default_rng(2)
    words = [f"{rng.integers(10**9)}" for _ in range(400)]
    passage = " ".join(words[:30])
    rows = [(i, " ".join(words[40 + 5 * i : 52 + 5 * i]) + " " + passage + " " + " ".join(rng.permutation(words)[:20])) for i in range(20)]
    rows += [(7, passage), (7, passage), (50, rows[3][1]), (51, rows[3][1]), (None, passage + " tail"), (None, passage + " tail"), (60, None)]
    rows += [(61, "-" * 300), (62, "-" * 120 + "x" + "-" * 49), (63, "-" * 49)]
    assert as_rows(without_repeats(frame(spark, rows).repartition(4))) == sorted(brute.remove_repeats(rows), key=str)


def test_text_and_other_columns_go_on(spark):
    text = "A passage that two documents have in common, word by word, and all of it!"
    rows = [(1, text, "x"), (2, "before " + text + " after", "y"), (3, None, None)]
    docs = frame(spark, rows, "doc_id bigint, text string, note string")
    got = without_repeats(docs, keep_text=True, beside=F.struct("note")).select("doc_id", "kept_text", "beside.note")
    found = {r.doc_id: (r.kept_text, r.note) for r in got.collect()}
    assert found == {1: (text, "x"), 2: ("before  after", "y"), 3: ("", None)}


def test_empty(spark):
    assert without_repeats(frame(spark, [])).count() == 0


def test_rows_between_chunks_and_shards_grow_with_the_text():
    def rows(size):
        shards, limit = repeats.dealt(size, 32)
        return shards * -(-size // limit)

    for gigabytes in (1, 5, 25):
        assert rows(gigabytes << 30) <= 1.1 * gigabytes * rows(1 << 30)
    assert repeats.dealt(200 << 30, 32)[1] == repeats.MOST_CHUNK


def test_copies_in_a_chunk_are_named_once(spark):
    docs = frame(spark, [(i, "the same text in many documents, long enough to go") for i in range(50)]).coalesce(1)
    chunks = docs.mapInArrow(repeats._stored(1 << 20), repeats.CHUNK_SCHEMA).collect()
    assert [(len(c.doc_ids), len(c.digests), c.leasts) for c in chunks] == [(50, 1, [0])]


def test_many_chunks_pieces_and_shards(spark, documents, monkeypatch):
    for name, value in (("PIECE", 1 << 12), ("SHARD_TEXT", 1 << 16), ("ROW_TEXT", 1 << 8), ("SHARD_BYTES", 1 << 14)):
        monkeypatch.setattr(repeats, name, value)
    assert as_rows(without_repeats(odd(spark, documents).coalesce(2))) == sorted(brute.remove_repeats(documents), key=str)


def test_copies_in_a_shard_cost_no_tables_over_all_of_them():
    # a passage that many pieces have: rows grow, distinct segments do not
    rng = np.random.default_rng(4)
    words, pick = rng.integers(97, 123, (300, 70)).astype(np.uint8), rng.integers(0, 300, 60_000)
    lengths = rng.integers(50, 71, 300)[pick]
    raw = np.concatenate([words[k, :n] for k, n in zip(pick, lengths)])
    begin = np.cumsum(lengths) - lengths
    tracemalloc.start()
    sample, kind = repeats.distinct_ranges(raw, begin, lengths)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    number: dict[bytes, int] = {}
    want = [number.setdefault(raw[b : b + n].tobytes(), len(number)) for b, n in zip(begin, lengths)]
    assert len(sample) == len(number) == len(set(zip(kind.tolist(), want)))
    assert all(kind[s] == k for k, s in enumerate(sample))
    assert peak < 10 * len(raw)
