"""Text vectors for the centroid fallback: offline ones by hashing or projection, and a hook for any batch encoder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.keywords import keyword_list
from reviewloom.functions.text import blank_to_space
from reviewloom.operators.keys import hot_keys, join_split
from reviewloom.operators.vectors import centroids
from reviewloom.session import BROADCAST_ROWS, has_at_most, materialise

# Vector width and encoder batch size.
WIDTH = 384
BATCH = 64
# Words of texts whose signs are unpacked at a time, 3 KB each.
STRETCH = 4096

Encoder = Callable[[list[str]], np.ndarray]


def hashed_vectors(rows: DataFrame, key: str, text: str, width: int = WIDTH) -> DataFrame:
    """(key, embedding): word counts hashed to ``width`` buckets. Needs no model and no second pass."""
    words = rows.select(key, keyword_list(F.col(text)).alias("_words"))
    counted = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=width).transform(words)
    return counted.select(key, vector_to_array("_counts", "float32").alias("embedding"))


def word_counts(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, word, n) of the content words, stored: frequencies and vectors both read it."""
    words = rows.select(key, F.explode_outer(keyword_list(F.col(text), forms={})).alias("word")).where(F.col("word").isNotNull())
    return materialise(words.groupBy(key, "word").agg(F.count(F.lit(1)).alias("n")), "word-counts")


def document_frequencies(counts: DataFrame) -> DataFrame:
    """(word, texts): in how many texts each word is."""
    return counts.groupBy("word").agg(F.count(F.lit(1)).alias("texts"))


def merged_frequencies(*tables: DataFrame) -> DataFrame:
    """Frequencies of several batches that share no text."""
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out.groupBy("word").agg(F.sum("texts").alias("texts"))


def projected_vectors(counts: DataFrame, key: str, frequencies: DataFrame, texts: int, width: int = WIDTH) -> DataFrame:
    """(key, embedding): TF-IDF weights of a text's words under a random projection of fixed signs.

    ``counts`` is of ``word_counts``; ``texts`` is the number of texts behind ``frequencies``. A word's signs are the
    bits of MD5 of ``<block>:<word>``, so there is no projection matrix to keep and batches of any time agree. A word
    weighs n * ln((1 + texts) / (1 + its texts)); one without a frequency counts as in no text. Texts without words
    have no row. A small vocabulary is broadcast; of a large one, frequent words are joined where they are. A task holds
    one batch's texts and the signs of their distinct words.
    """
    kind = counts.schema[key].dataType.simpleString()
    spelled = counts.select("word").distinct()
    known = spelled.join(frequencies, "word", "left").withColumn(
        "idf", F.log((F.lit(1.0) + texts) / (F.lit(1.0) + F.coalesce("texts", F.lit(0))))
    )
    known = materialise(known.select("word", "idf"), "idf")
    if has_at_most(known, BROADCAST_ROWS):
        weighed = counts.join(F.broadcast(known), "word")
    else:
        weighed = join_split(counts, known, "word", hot_keys(counts, "word"))
    bags = weighed.groupBy(key).agg(F.collect_list(F.struct("word", (F.col("n") * F.col("idf")).alias("w"))).alias("_bag"))
    sent = bags.select(key, F.col("_bag")["word"].alias("_words"), F.col("_bag")["w"].alias("_w"))
    blocks = [f"{b}:".encode() for b in range(-(-width // 128))]

    def signs(word: str) -> bytes:
        return b"".join(hashlib.md5(block + word.encode()).digest() for block in blocks)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a word's signs are made once a batch, and unpacked for a stretch of words at a time
            coded = batch.column(1).flatten().cast(pa.string()).dictionary_encode()
            packed = np.frombuffer(b"".join(signs(w) for w in coded.dictionary.to_pylist()), np.uint8).reshape(-1, 16 * len(blocks))
            codes, weights = coded.indices.to_numpy(), batch.column(2).flatten().to_numpy()
            ends = np.cumsum(batch.column(1).value_lengths().to_numpy())
            vectors = np.zeros((batch.num_rows, width))
            first = 0
            while first < batch.num_rows:
                begin = ends[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(ends, begin + STRETCH, side="right")))
                used, at = np.unique(codes[begin : ends[last - 1]], return_inverse=True)
                for low in range(0, len(used), STRETCH):
                    ones = 2.0 * np.unpackbits(packed[used[low : low + STRETCH]], axis=1)[:, :width] - 1.0
                    for row in range(first, last):
                        mine = slice((ends[row - 1] if row else 0) - begin, ends[row] - begin)
                        here = at[mine] - low
                        inside = (here >= 0) & (here < len(ones))
                        vectors[row] += weights[begin:][mine][inside] @ ones[here[inside]]
                first = last
            flat = pa.array((vectors / np.sqrt(width)).astype("float32").reshape(-1))
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * width)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, flat)], [key, "embedding"])

    return sent.mapInArrow(project, f"`{key}` {kind}, embedding array<float>")


def encoded_vectors(rows: DataFrame, key: str, text: str, encoder: Encoder, batch: int = BATCH) -> DataFrame:
    """(key, embedding, error): vectors of a model, ``batch`` texts at a time inside tasks.

    A batch that fails is tried text by text, so an unusable text costs only itself. Blank text is
    encoded as one space.
    """
    kind = rows.schema[key].dataType.simpleString()

    def encode(texts: list[str]) -> list[tuple[list[float] | None, str | None]]:
        try:
            return [(np.asarray(v, dtype="float32").tolist(), None) for v in encoder(texts)]
        except Exception as error:
            if len(texts) == 1:
                return [(None, str(error))]
            return [pair for t in texts for pair in encode([t])]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start : start + batch]
                vectors, errors = zip(*encode(part["_text"].to_list()))
                yield pd.DataFrame({key: part[key].to_numpy(), "embedding": list(vectors), "error": list(errors)})

    texts = rows.select(key, blank_to_space(F.col(text)).alias("_text"))
    return texts.mapInPandas(run, f"`{key}` {kind}, embedding array<float>, error string")


def seed_centroids(seeds: DataFrame, vectors: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(family, sub, ord, vec) from seed phrases (family, sub, ord, phrase) by the same encoder as the reviews.

    ``vectors`` turns a frame with (seed, phrase) into (seed, embedding).
    """
    keyed = seeds.withColumn("seed", F.concat_ws("|", "family", "sub", "phrase"))
    embedded = vectors(keyed.select("seed", "phrase").distinct()).select("seed", "embedding")
    return centroids(keyed.join(embedded, "seed"), ["family", "sub", "ord"], "embedding")
