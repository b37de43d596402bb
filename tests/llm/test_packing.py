import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import frame, odd

from reviewloom.llm.packing import WordIds, packed, plan
from reviewloom.llm.queries import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")

ODD_TEXTS = [
    "Don't stop,'s ÀÉÎ ×÷ a×b É.é,…  x—, it's 4.0a B2B <|endoftext|> ΣΑΣ. İstanbul é.́ ≠ \x1c\x00a",
    "中文,字 ñ’s I'LL we'Re ﬁ ½x¼", "", "   ", "\n", "a", ".", ",'s", "'", "Ünï-cödé’s", "ＡＢ", " 　a b", "ß ẞ ÿŸ", "😀😀a😀.", "1234 5²",
]


def reference_ids(text):
    tokenizer = tokenizers.Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = True
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_ids_equal_the_tokenizer():
    raw = [t.encode() for t in ODD_TEXTS]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    encoder = WordIds(tokenizer_path())
    for _ in range(2):  # learned, then remembered
        ids, at = encoder.encode(data, offsets)
        for i, text in enumerate(ODD_TEXTS):
            assert ids[at[i] : at[i + 1]].tolist() == reference_ids(text)[:-1]


def check_plan(histogram, capacity):
    slots, sequences = plan(histogram, capacity)
    used = defaultdict(list)
    for length, first, ranks, sequence, each, offset in slots.tolist():
        for r in range(ranks):
            used[sequence + r // each].append((offset + r % each * length, length))
    assert len(used) == sequences
    for places in used.values():
        end = 0
        for start, length in sorted(places):
            assert start == end
            end += length
        assert end <= capacity
    for length in range(1, capacity + 1):
        own = slots[slots[:, 0] == length]
        assert own[:, 2].sum() == histogram[length]
        assert (np.sort(own[:, 1]) == np.concatenate([[0], np.cumsum(own[np.argsort(own[:, 1]), 2])])[:-1]).all()
    return sequences


@pytest.mark.parametrize("seed", range(6))
def test_plans_are_gapless_and_nearly_full(seed):
    rng = np.random.default_rng(seed)
    capacity = 128
    lengths = np.minimum(rng.geometric(0.03, 5000), capacity) if seed % 2 else rng.integers(1, capacity + 1, 5000)
    histogram = np.bincount(lengths, minlength=capacity + 1)
    least = -(-int((histogram * np.arange(capacity + 1)).sum()) // capacity)
    assert check_plan(histogram, capacity) <= least * 1.02 + 1


def test_plans_of_few_lengths():
    for histogram in ({}, {128: 3}, {1: 1}, {65: 10}, {100: 7, 28: 3}, {43: 1000}):
        counts = np.zeros(129, np.int64)
        for length, n in histogram.items():
            counts[length] = n
        check_plan(counts, 128)


def test_pieces_and_places(spark, documents):
    rows = documents + [(None, "null id"), (5, "again"), (5, "again")] + [(200_000 + i, t) for i, t in enumerate(ODD_TEXTS)]
    got = packed(odd(spark, rows), tokenizer_path(), capacity=512).collect()
    want = []
    for doc_id, text in rows:
        ids = reference_ids(text)
        for piece, start in enumerate(range(0, len(ids), 512)):
            cut = ids[start : start + 512]
            want.append((str(doc_id), piece, start, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        ends = 0
        for offset, length in sorted(places):
            assert offset == ends
            ends += length
        assert ends <= 512
    assert len(sequences) <= sum(r.length for r in got) / 512 * 1.03 + 1


def test_empty(spark):
    assert packed(frame(spark, []), tokenizer_path()).count() == 0


def test_units_of_texts_side_by_side():
    # one text's last word ends where the next one's first begins
    data = np.frombuffer(b"ab-cd" + b"ef g" + b"h", np.uint8)
    _, starts, ends, at = WordIds(tokenizer_path()).units(data, np.array([0, 5, 9, 9, 10]))
    assert [data[a:b].tobytes() for a, b in zip(starts, ends)] == [b"ab", b"-", b"cd", b"ef", b"g", b"h"]
    assert at.tolist() == [0, 3, 5, 5, 6]
