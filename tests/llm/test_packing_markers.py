import zlib

import numpy as np
import pytest
from conftest import odd

from reviewloom.llm import queries
from reviewloom.llm.packing import WordIds
from reviewloom.llm.queries import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")

TEXTS = [
    "end <|endoftext|> next", "", "<|endoftext|>", "a<|startoftext|><|endoftext|>b", "no marker", "don't<|endoftext|>'s É́<|endoftext|>́x",
    "x'<|ENDOFTEXT|> <|endoftext", "|>cut", "<|<|endoftext|>|>", "<|endoftext|> <|endoftext|>\n中文<|startoftext|>。", "", "last <|endoftext|>",
]


def as_loaded(text):
    return tokenizers.Tokenizer.from_file(tokenizer_path()).encode(text, add_special_tokens=False).ids


def test_markers_have_their_own_ids():
    assert as_loaded(TEXTS[0]) == [806, 49407, 1131]
    raw = [t.encode() for t in TEXTS]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    encoder = WordIds(tokenizer_path(), as_loaded=True)
    for _ in range(2):  # learned, then remembered
        ids, at = encoder.encode(data, offsets)
        assert [ids[s:e].tolist() for s, e in zip(at[:-1], at[1:])] == [as_loaded(t) for t in TEXTS]


def test_the_query_uses_the_tokenizer_as_loaded(spark, tmp_path):
    odd(spark, list(enumerate(TEXTS))).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.length, r.ids_crc32) for r in queries.op6_pattern_packing(spark, str(tmp_path)).collect()}
    want = [(i, np.array([*as_loaded(t), 1], "<u4")) for i, t in enumerate(TEXTS)]
    assert got == {(i, len(ids), zlib.crc32(ids.tobytes())) for i, ids in want}
