import random
import re
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import pytest
from compare import compare, connect
from conftest import SMALL, frame, odd

from reviewloom.llm import oracles, spelling
from reviewloom.llm.queries import op11_letter_counts


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(rows) -> dict:
    counts: Counter = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    beside = {w: [o for o in words if near(w, o)] for w in words}
    form = {}
    for w, others in beside.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(beside[w]), words.get(form[w])) for w, n in words.items()}


def result(df) -> dict:
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def lively(seed=5, n=300):
    """Texts of a few stems with edits, so that most words have neighbours and chains of forms arise."""
    rng = random.Random(seed)
    letters = "abcdeéÿÀß×"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(40)]

    def edited(w):
        k = rng.randrange(len(w))
        return rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :]])

    pool = list(stems)
    for _ in range(200):
        pool.append(edited(rng.choice(pool)))
    weights = [6 ** rng.randint(0, 3) for _ in pool]
    return [(i, " ".join(rng.choices(pool, weights, k=120)) + ", É-" + rng.choice(pool).upper()) for i in range(n)]


@pytest.mark.parametrize(("block_rows", "classes"), [(8192, None), (16, 4), (5, 7), (8192, 1), (8192, 90)])
def test_equals_all_pairs(spark, block_rows, classes):
    rows = lively()
    want = brute(rows)
    assert any(v[0] for v in want.values()) and any(v[1] != v[0] for v in want.values() if v[0])
    assert result(spelling.variants(odd(spark, rows), block_rows, classes)) == want


def test_whole_texts_and_defined_cases(spark, documents):
    rows = documents + [(None, "Nullword " * 9), (7, None), (7, "")]
    assert result(spelling.variants(odd(spark, rows))) == brute(rows)


def test_very_long_words(spark):
    long = "ab" * 1_500
    rows = [(1, f"{long} {long}x {long[:-1]} b{long[1:]} {'z' * 2999} {'z' * 3001}")] * 6
    assert result(spelling.variants(frame(spark, rows))) == brute(rows)


def test_empty(spark):
    assert spelling.variants(frame(spark, [])).count() == 0
    assert spelling.variants(frame(spark, [(1, None), (2, "1 2 3")])).count() == 0


def test_equals_sql(spark):
    assert compare(spark, connect(SMALL), "op11", op11_letter_counts, oracles.ORACLES["op11_letter_counts"], SMALL) == ""


def test_distances_are_those_of_letter_counts():
    import pyarrow as pa

    words = ["aabbcc", "aabbcd", "éabbcc", "ccbbaa"]
    counts = spelling.letter_counts(*spelling.letter_codes(pa.array(words)))
    gram = counts @ counts.T
    squares = gram.diagonal()[:, None] + gram.diagonal()[None, :] - 2 * gram
    assert squares[0].tolist() == [0, 2, 2, 0]


@pytest.mark.parametrize("name", ["spelling", "bagminhash"])
def test_modules_import_what_they_compute_with(name):
    # pyarrow.compute is a module of its own, there only if something else in the worker has imported it
    code = (
        "import sys, types, pyarrow as pa\n"
        f"import reviewloom.llm.{name} as module\n"
        "used = [f.__code__ for f in vars(module).values() if isinstance(f, types.FunctionType)]\n"
        "names = lambda c: set(c.co_names).union(*(names(k) for k in c.co_consts if isinstance(k, types.CodeType)))\n"
        "missing = [c.co_name for c in used if 'compute' in names(c)]\n"
        "assert 'pyarrow.compute' in sys.modules and not missing, missing\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(spelling.__file__).parents[2], capture_output=True, text=True)
    assert not done.returncode, done.stderr
