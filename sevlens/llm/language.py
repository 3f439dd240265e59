"""Language identification by nearest centroid.

A text's vector holds its hashed n-grams of 3 and 4 bytes (lower case, runs of other than
letters as one space), weighted by TF-IDF and scaled to unit length.  Each language has a few
centroids, clustered from a bounded sample of its texts, and a text takes the language of the
centroid with the largest cosine.  A text farther from its centroid than nearly all of
that centroid's own sample is flagged ``rejected``.

Document frequencies are counted over all training rows; the sample (``sample`` rows for each language)
serves the clustering alone.  The model is centroids x 2^14 numbers for each language.

Defined results: null texts and texts without a letter are ``und`` with score 0; rows of null
label train nothing; without training rows every text is ``und``; repeated rows get equal
results; whole texts are used whatever their length; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sevlens.llm.common import bounded_sample, rebatched, strings

SLOTS = 1 << 14
LETTER = r"\p{L}"
_TABLE = np.full(256, 32, np.uint8)
_TABLE[97:123] = np.arange(97, 123)
_TABLE[128:] = np.arange(128, 256)


def has_letter(text: Column) -> Column:
    """Whether the text has a letter; digits, fractions and numerals are none.  Learning and prediction both ask this."""
    return F.coalesce(text.rlike(LETTER), F.lit(False))


def counts(text: str) -> np.ndarray:
    """Counts of the text's hashed n-grams."""
    b = _TABLE[np.frombuffer(f"  {text.lower()}  ".encode(), np.uint8)]
    b = b[np.concatenate([[True], (b[1:] != 32) | (b[:-1] != 32)])]
    w = b.astype(np.uint32)
    if len(w) < 4:
        w = np.pad(w, (0, 4 - len(w)), constant_values=32)
    three = (w[:-2] << 16) | (w[1:-1] << 8) | w[2:]
    four = (three[:-1] << 8) | w[3:]
    slot = np.concatenate([three * np.uint32(2654435761), four * np.uint32(2246822519)]) >> np.uint32(18)
    return np.bincount(slot, minlength=SLOTS)


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    x = np.empty((len(texts), SLOTS), np.float32)
    for i, t in enumerate(texts):
        x[i] = np.sqrt(counts(t))
    x *= idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.maximum(norm, 1e-12)


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Over all rows; each task sends one count for each slot."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(SLOTS, np.int64), 0
        for batch in rebatched(batches):
            for t in strings(batch.column("text")):
                total += counts(t) > 0
            n += batch.num_rows
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(SLOTS + 1)), pa.array(np.append(total, n))], names=["slot", "n"])

    df = np.zeros(SLOTS + 1)
    for slot, n in rows.select("text").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n")).collect():
        df[slot] = n
    return df[:-1], int(df[-1])


def clusters(x: np.ndarray, k: int, rounds: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from farthest-first seeds; centroids and the low cosine of each."""
    c = x[:1]
    while len(c) < min(k, len(x)):
        c = np.vstack([c, x[(x @ c.T).max(axis=1).argmin()]])
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        c = np.vstack([x[own == i].mean(axis=0) if (own == i).any() else c[i] for i in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    near = x @ c.T
    own = near.argmax(axis=1)
    low = [np.quantile(near[own == i, i], 0.01) if (own == i).any() else 0.0 for i in range(len(c))]
    return c, np.array(low)


def fit(rows: DataFrame, sample: int = 300, centroids: int = 4) -> dict:
    """Model from ``rows`` (doc_id, text, lang): idf, labels, centroid matrix, each centroid's limit."""
    rows = rows.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & has_letter(F.col("text")))
    df, n = document_frequencies(rows)
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + np.float32(0.05)

    def cluster(key: tuple, table: pa.Table) -> pa.Table:
        x = vectors([t for t, _ in sorted(zip(table["text"].to_pylist(), table["doc_id"].to_pylist()), key=repr)], idf)
        c, low = clusters(x, centroids)
        return pa.table({"lang": [key[0].as_py()] * len(c), "low": low.astype(float), "c": [row.astype("<f4").tobytes() for row in c]})

    found = (bounded_sample(rows, "lang", sample).groupBy("lang")
             .applyInArrow(cluster, "lang string, low double, c binary").orderBy("lang", "c").collect())
    return {"idf": idf, "lang": [r["lang"] for r in found], "low": np.array([r["low"] for r in found]),
            "c": np.array([np.frombuffer(r["c"], "<f4") for r in found]).reshape(-1, SLOTS)}


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in rebatched(batches, 4 << 20):
            for s in range(0, whole.num_rows, 256):
                batch = whole.slice(s, 256)
                texts, letters = strings(batch.column("text")), batch.column("letters").to_pylist()
                lang, score, far = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
                use = [i for i, t in enumerate(texts) if m["lang"] and letters[i]]
                if use:
                    near = vectors([texts[i] for i in use], m["idf"]) @ m["c"].T
                    best = near.argmax(axis=1)
                    for i, j, row in zip(use, best, near):
                        lang[i], score[i], far[i] = m["lang"][j], min(1.0, max(0.0, float(row[j]))), row[j] < m["low"][j]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lang), pa.array(score), pa.array(far)],
                                                 names=["doc_id", "lang_pred", "score", "rejected"])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), has_letter(text).alias("letters")).mapInArrow(
        run, "doc_id long, lang_pred string, score double, rejected boolean")
