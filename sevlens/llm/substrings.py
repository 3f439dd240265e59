"""Removal of repeated word windows, prefiltered by a count-min sketch.

Every window of ``least`` words holds an anchor, its 8-word gram of least hash, so equal windows have equal
anchors; consecutive windows of one anchor form a segment.  First pass: every partition counts the
documents that hold an anchor in a count-min sketch of fixed size; the partitions' sketches are
summed block by block.  A window is estimated by its anchor's count, which is never below the
number of documents that hold the window, so a window estimated at one document cannot be repeated
and none that is repeated is lost.  Second pass: the segments estimated at two documents or more are
grouped exactly.  Equal segments meet in one aggregate of their digests; where an anchor has
segments that differ, their windows are grouped by window digest.  Both aggregates keep the
smallest document, combine before they are shuffled, and hold no list of documents.

The merged sketch has one bit a cell (``width`` x ``depth`` / 8 bytes, 8 MB at the default) and is
broadcast.  A fuller sketch lets more windows through to the second pass, at most 48 bytes and 8 for
each window of a segment; the result is the same.

Words are runs of anything but ASCII space characters, unchanged.  Defined results: a null text has no words; a null id
comes before all others; windows in rows of the same id don't remove each other; repeated rows get equal
results; a document of fewer words than a window stays whole; an empty table gives an empty result;
other columns are ignored.  Windows are compared by their anchor's and their own 64-bit hash together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sevlens.llm.common import rebatched, stored

GRAM = 8
NULL_ID = -(1 << 63)
BLOCK = 1 << 16
_U = np.uint64
_A, _B = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_SPACE = np.zeros(256, bool)
_SPACE[9:14] = _SPACE[32] = True


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


class Powers:
    """Powers of an odd base and of its inverse, as many as the longest input so far needs."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, _U)

    def sums(self, h: np.ndarray) -> np.ndarray:
        """Running sums from which :meth:`hashes` takes the hash of any stretch."""
        if len(h) >= len(self.up):
            n = 2 * len(h) + 1
            self.up, self.down = np.full(n, self.base, _U), np.full(n, self.inverse, _U)
            self.up[0] = self.down[0] = 1
            self.up, self.down = np.multiply.accumulate(self.up), np.multiply.accumulate(self.down)
        out = np.zeros(len(h) + 1, _U)
        np.cumsum(h * self.down[:len(h)], out=out[1:])
        return out

    def hashes(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each stretch [start, end), wherever it stands."""
        return mixed((sums[end] - sums[start]) * self.up[end])


class Windows:
    """Segments of documents: runs of windows with one anchor."""

    def __init__(self, least: int):
        self.least, self.gram = least, min(GRAM, least)
        self.byte, self.one, self.two = Powers(_A), Powers(_A), Powers(_B)

    def __call__(self, texts: list[bytes]) -> dict[str, np.ndarray]:
        """For each segment of the texts: ``doc`` (index), ``start`` (word), ``n`` windows, ``anchor``, ``own`` hash; and all
        windows' hashes with the place ``at`` of a segment's first."""
        data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts])
        word = ~_SPACE[data]
        edge = np.diff(word.astype(np.int8), prepend=np.int8(0))
        s, e = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
        doc = np.searchsorted(ends, s, "right")
        n = len(s) - self.least + 1
        if n < 1:
            return dict.fromkeys(("doc", "start", "n", "anchor", "own", "at", "windows"), np.zeros(0, np.int64))
        h = self.byte.hashes(self.byte.sums(data.astype(_U) + _U(1)), s, e)
        one, at = self.one.sums(h), np.arange(len(s))
        gram = self.one.hashes(one, at[:len(s) - self.gram + 1], at[self.gram - 1:] + 1)
        bits = _U(int(len(gram)).bit_length())
        key = (gram >> bits << bits) | np.arange(len(gram), dtype=_U)           # of equal grams the first
        width, span = self.least - self.gram + 1, 1
        while span * 2 <= width:
            key = np.minimum(key[:-span], key[span:])
            span *= 2
        if width > span:
            key = np.minimum(key[:len(key) - (width - span)], key[width - span:])
        place = (key & ((_U(1) << bits) - _U(1))).astype(np.int64)
        valid = doc[:n] == doc[self.least - 1:]
        cut = np.ones(n, bool)
        cut[1:] = (place[1:] != place[:-1]) | (doc[1:n] != doc[:n - 1]) | (valid[1:] != valid[:-1])
        first = np.nonzero(cut)[0]
        last = np.append(first[1:], n)
        ok = valid[first]
        first, last = first[ok], last[ok]
        two = self.two.sums(h)
        begin = np.searchsorted(doc, np.arange(len(texts)))                     # first word of each document
        return {"doc": doc[first], "start": first - begin[doc[first]], "n": last - first, "anchor": gram[place[first]],
                "own": self.two.hashes(two, first, last - 1 + self.least), "at": first, "windows": self.two.hashes(two, at[:n], at[:n] + self.least)}


def cells(anchor: np.ndarray, row: int, width: int) -> np.ndarray:
    """The anchors' cells in one row of the sketch."""
    return (mixed(anchor ^ _U((row + 1) * _A % (1 << 64))) % _U(width)).astype(np.int64)


def pieces(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """(ids, text hashes, texts) of documents long enough, a few MB at a time."""
    for batch in rebatched(batches, 2 << 20):
        rows = zip(batch.column("id").to_pylist(), batch.column("h").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist())
        rows = [r for r in rows if len(r[2]) >= 2 * least - 1]
        if rows:
            ids, h, texts = zip(*rows)
            yield list(ids), list(h), list(texts)


def repeated_cells(docs: DataFrame, least: int, width: int, depth: int) -> np.ndarray:
    """Cells (depth, width / 8 bytes, a bit each) that two documents or more share, of the merged sketch."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, windows = np.zeros((depth, width), np.uint8), Windows(least)
        for ids, _, texts in pieces(batches, least):
            found = windows(texts)
            ids = np.array(ids)[found["doc"]]
            by = np.lexsort((ids, found["anchor"]))
            a, i = found["anchor"][by], ids[by]
            new = np.append(True, (a[1:] != a[:-1]) | (i[1:] != i[:-1]))[:len(a)]     # a document counts once in a piece
            for row in range(depth):
                at, n = np.unique(cells(a[new], row, width), return_counts=True)
                sketch[row, at] = np.minimum(sketch[row, at] + n, 2)
        for row in range(depth):
            for k in range(0, width, BLOCK):
                part = sketch[row, k:k + BLOCK]
                if part.any():      # the two bits of a cell apart
                    yield pa.RecordBatch.from_pydict({"block": [row * (width // BLOCK) + k // BLOCK],
                                                      "once": [np.packbits(part > 0).tobytes()], "twice": [np.packbits(part > 1).tobytes()]})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, once, twice = None, None, None
        for batch in batches:
            for k, a, b in zip(batch.column("block").to_pylist(), batch.column("once").to_pylist(), batch.column("twice").to_pylist()):
                a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
                if k == block:
                    twice |= b | (once & a)
                    once |= a
                    continue
                if block is not None:
                    yield pa.RecordBatch.from_pydict({"block": [block], "bits": [twice.tobytes()]})
                block, once, twice = k, a.copy(), b.copy()
        if block is not None:
            yield pa.RecordBatch.from_pydict({"block": [block], "bits": [twice.tobytes()]})

    parts = docs.mapInArrow(count, "block long, once binary, twice binary").repartition("block").sortWithinPartitions("block")
    out, per = np.zeros((depth, width // 8), np.uint8), width // BLOCK
    # at most depth * width / 8 bytes
    for r in parts.mapInArrow(merge, "block long, bits binary").collect():
        row, k = divmod(r["block"], per)
        out[row, k * BLOCK // 8:(k + 1) * BLOCK // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def with_repeats(docs: DataFrame, least: int = 50, width: int = 1 << 25, depth: int = 2) -> DataFrame:
    """(doc_id, text, spans): each document with its removed stretches [start, end) in words, as an array of pairs."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), text.alias("text")).withColumn("h", F.xxhash64("text"))
    bits = spark.sparkContext.broadcast(repeated_cells(docs, least, width, depth))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, sent = Windows(least), set()
        for ids, h, texts in pieces(batches, least):
            found = windows(texts)
            often = np.ones(len(found["doc"]), bool)
            for row in range(depth):
                at = cells(found["anchor"], row, width)
                often &= (bits.value[row, at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
            x = {c: v[often] for c, v in found.items() if c != "windows"}
            if len(sent) > 300_000:
                sent.clear()
            own = []
            for key, at, n in zip(x["own"].tolist(), x["at"].tolist(), x["n"].tolist()):
                own.append(None if key in sent else found["windows"][at:at + n].astype("<u8").tobytes())     # once from a task
                sent.add(key)
            yield pa.RecordBatch.from_pydict({
                "id": np.array(ids, np.int64)[x["doc"]], "h": np.array(h, np.int64)[x["doc"]], "start": x["start"].astype(np.int32), "n": x["n"].astype(np.int32),
                "anchor": x["anchor"].view(np.int64), "own": x["own"].view(np.int64), "windows": pa.array(own, pa.binary())})

    found = stored(docs.mapInArrow(candidates, "id long, h long, start int, n int, anchor long, own long, windows binary"), "window-segments")
    # equal segments, the smallest document of each
    distinct = stored(found.groupBy("anchor", "own").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.max("windows").alias("windows")), "distinct-segments")
    # segments that differ under one anchor: their windows
    mixed_ = distinct.groupBy("anchor").agg(F.count("*").alias("m")).where("m > 1").select("anchor")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(w, "<i8") for w in batch.column("windows").to_pylist()]
            n = np.array([len(w) for w in own], np.int64)
            at = np.repeat(np.arange(len(n)), n)
            yield pa.RecordBatch.from_pydict({
                "anchor": batch.column("anchor").to_numpy()[at], "own": batch.column("own").to_numpy()[at], "least": batch.column("least").to_numpy()[at],
                "place": (np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)).astype(np.int32), "window": np.concatenate(own) if own else np.zeros(0, np.int64)})

    windows = stored(distinct.join(mixed_, "anchor").mapInArrow(each, "anchor long, own long, least long, place int, window long"), "segment-windows")
    # a window's smallest document, where several segments hold it
    lowest = windows.groupBy("anchor", "window").agg(F.min("least").alias("low"), F.count("*").alias("m")).where("m > 1").drop("m")
    earlier = (windows.join(lowest, ["anchor", "window"]).where("low < least").groupBy("anchor", "own")
               .agg(F.collect_list(F.struct("place", "low")).alias("windows")))        # at most one for each window of a segment
    settled = distinct.where("least < most").select("anchor", "own", "least").join(earlier, ["anchor", "own"], "full")
    whole = F.array(F.struct(F.col("start").alias("start"), (F.col("start") + F.col("n") - 1 + least).alias("end")))
    some = F.transform(F.filter("windows", lambda w: w["low"] < F.col("id")),
                       lambda w: F.struct((F.col("start") + w["place"]).alias("start"), (F.col("start") + w["place"] + least).alias("end")))
    spans = (found.drop("windows").join(settled, ["anchor", "own"])
             .select("id", "h", F.when(F.col("least") < F.col("id"), whole).otherwise(some).alias("spans")).where("size(spans) > 0"))
    spans = stored(spans, "window-spans").groupBy("id", "h").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return docs.join(spans, ["id", "h"], "left").select(F.nullif("id", F.lit(NULL_ID)).alias("doc_id"), "text", "spans")


def kept_words(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) from :func:`with_repeats`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rebatched(batches):
            out = []
            for text, spans in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist()):
                words = text.split()            # bytes: splits at ASCII space characters alone
                if spans:
                    depth = np.zeros(len(words) + 1, np.int64)
                    np.add.at(depth, [s["start"] for s in spans], 1)
                    np.add.at(depth, [s["end"] for s in spans], -1)
                    kept = [w for w, d in zip(words, np.cumsum(depth).tolist()) if not d]
                else:
                    kept = words
                out.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            n, removed, sha = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return docs.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")
