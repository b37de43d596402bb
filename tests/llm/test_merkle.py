import hashlib
import zlib

import pytest
from compare import compare, connect
from conftest import SMALL, frame

from reviewloom.llm import merkle, oracles
from reviewloom.llm.queries import op13_merkle_manifest

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text=None) -> str:
    fields = [*row[:4], row[4] if text is None else text]
    return h(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def runs(nodes):
    return [nodes[i : i + 8] for i in range(0, len(nodes), 8)]


def climbed(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and for each node its (left, right) siblings level by level."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            run = nodes[place // 8 * 8 : place // 8 * 8 + 8]
            k = place % 8
            ways[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
        nodes = [h(*run) for run in runs(nodes)]
        at = [p // 8 for p in at]
    return nodes[0], ways


def brute(rows: list[tuple]) -> list[tuple]:
    low = str.maketrans(merkle.UPPER, merkle.LOWER)
    trees: dict = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    order = sorted(trees, key=lambda x: b"" if x is None else b"+" + x.encode())
    done = {}
    for lang in order:
        members = sorted(trees[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        done[lang] = (members, *climbed([leaf(r) for r in members]))
    root, upper = climbed([done[x][1] for x in order])
    out = []
    for k, lang in enumerate(order):
        members, subroot, ways = done[lang]
        for row, way in zip(members, ways):
            way = way + upper[k]
            own = leaf(row)
            if zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 3 == 0 and row[4] is not None:
                own = leaf(row, row[4].translate(low))
            for left, right in way:
                own = h(left, own, right)
            out.append((row[0], leaf(row), subroot, root, h(*[s for step in way for s in step]), own, own == root))
    return out


def check(spark, rows, levels=4):
    got = [tuple(r) for r in merkle.manifest(frame(spark, rows, SCHEMA).repartition(3), levels).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def made(n, langs=("en", "de", None, "Z", "é")):
    return [(i * 3 % 1009, f"s{i % 4}" if i % 5 else None, langs[i * i % len(langs)], None if i % 7 == 0 else i, f"Text {i} ÄB" if i % 6 else None) for i in range(n)]


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_equals_brute_force(spark, levels):
    check(spark, made(300), levels)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_one_tree_of_every_shape(spark, n):
    check(spark, [(i, "s", "en", 1, f"Word{i}") for i in range(n)], 1)


def test_one_tree_for_each_row(spark):
    check(spark, [(i, None, f"l{i:02d}", None, "A") for i in range(70)], 1)


def test_null_and_repeated_ids(spark):
    rows = [(None, "s", None, 1, "A"), (None, "s", None, 1, "A"), (5, None, None, None, None), (5, "t", None, 2, ""), (5, "t", None, 2, "")]
    check(spark, rows + made(40))


def test_one_id_in_most_rows(spark):
    check(spark, [(9, "s", "en", 3, "Same")] * 150 + made(60), 2)


def test_columns_with_clashing_names_and_no_rows(spark):
    rows = made(30)
    wide = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA + ", pos int, tree string, size int")
    assert sorted((tuple(r) for r in merkle.manifest(wide).collect()), key=str) == sorted(brute(rows), key=str)
    assert merkle.manifest(frame(spark, [], SCHEMA)).count() == 0


def test_equals_sql(spark):
    assert compare(spark, connect(SMALL), "op13", op13_merkle_manifest, oracles.ORACLES["op13_merkle_manifest"], SMALL) == ""


def test_queue_orders_children_before_parents():
    leaves = [str(i).encode() for i in range(20)]
    levels = merkle.forward(leaves, 2)
    assert [len(x) for x in levels] == [20, 3, 1]
    assert levels[1][2] == merkle.digest(b"".join(leaves[16:]))
    ways = merkle.backward(levels, ())
    assert merkle._steps(ways[17]) == [(b"16", b"1819"), (b"".join(levels[1][:2]), b"")]
