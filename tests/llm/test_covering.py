import itertools

import numpy as np
import pytest
import xxhash
from conftest import frame, odd
from pyspark.sql import functions as F

from reviewloom.llm.covering import BITS, cover, fingerprint, links, near_duplicates


def slow_fingerprint(text: str | None) -> int:
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\v\f\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reachable(marks: dict) -> dict:
    """Smallest key reachable over marks at most two bits apart."""
    root = {k: k for k in marks}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(marks, 2):
        if (marks[a] ^ marks[b]).bit_count() <= 2:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {k: find(k) for k in marks}


def test_fingerprint_equals_slow_one(documents):
    for _, text in documents:
        assert fingerprint((text or "").encode()) == slow_fingerprint(text)


def test_shingle_hash_is_sparks(spark):
    text = "Ünï code Words"
    got = spark.range(1).select(F.xxhash64(F.lit("Ünï code words")).alias("h")).first().h
    assert got & (2**64 - 1) == fingerprint(text.encode())


@pytest.mark.parametrize("free", [(1 << 64) - 1, 0xF0F0F0F0F0F0F0F0, 0b1011, 0b1])
def test_some_mask_misses_any_two_places(free):
    masks = cover(free)
    assert len(masks) == 7
    places = [i for i in range(BITS) if free >> i & 1]
    for a, b in itertools.product(places, repeat=2):
        assert any(not m >> a & 1 and not m >> b & 1 for m in masks)
    assert all(m & ~free == 0 for m in masks)


@pytest.mark.parametrize("bucket", [512, 64])
def test_links_connect_what_all_pairs_connect(spark, bucket):
    rng = np.random.default_rng(2)
    values = set(int(x) for x in rng.integers(0, 1 << 63, 150))
    for start in list(values)[:20]:
        here = start
        for _ in range(12):
            for b in rng.choice(64, rng.integers(1, 4), replace=False):
                here ^= 1 << int(b)
            values.add(here)
    # a crowd that agrees in all but a few places
    crowd = int(rng.integers(0, 1 << 62))
    for _ in range(150):
        values.add(crowd ^ sum(1 << int(b) for b in rng.choice(24, rng.integers(0, 9), replace=False)))
    values |= {0, (1 << 64) - 1}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = links(frame(spark, [(v,) for v in signed], "fp bigint").repartition(3), bucket).distinct().collect()
    near = {v: v for v in values}
    assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 64 for r in found)
    parent = {v: v for v in signed}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for r in found:
        parent[find(r.a)] = find(r.b)
    groups: dict[int, set] = {}
    for v in signed:
        groups.setdefault(find(v), set()).add(v & (2**64 - 1))
    wanted: dict[int, set] = {}
    for v, root in reachable(near).items():
        wanted.setdefault(root, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


@pytest.mark.parametrize("bucket", [64])
def test_components_equal_all_pairs(spark, documents, bucket):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in near_duplicates(odd(spark, documents), bucket).collect()}
    marks = {i: slow_fingerprint(t) for i, t in sorted(documents)}
    roots = reachable(marks)
    assert got == {i: (f"{m:016x}", roots[i]) for i, m in marks.items()}


def test_null_repeated_and_empty(spark):
    rows = [(None, "a b c d"), (7, "A b c\td"), (7, "A b c\td"), (9, None), (8, ""), (None, "only null ids here")]
    got = [(r.doc_id, r.component_id) for r in near_duplicates(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(None, 7), (7, 7), (7, 7), (9, 8), (8, 8), (None, None)], key=str)
    assert near_duplicates(frame(spark, [])).count() == 0


def test_a_fingerprint_of_most_rows(spark):
    rows = [(i, "the same words in most rows") for i in range(300)] + [(1000 + i, f"other {i} text {i * i} here {i}") for i in range(100)]
    got = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, rows).repartition(5)).collect()}
    assert all(got[i] == 0 for i in range(300)) and len(got) == 400
