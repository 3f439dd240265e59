"""Removal of repeated byte strings by an enhanced suffix array.

Every string of ``least`` bytes holds one anchor, its 12-byte gram of least hash, so equal
strings have equal anchors.  Grams that a hundredth of a bounded sample of documents hold come after
all others, so the anchor of a string at the edge of a line that every document has is not that
line's.  Consecutive strings of one anchor form a segment (under twice
``least`` bytes); segments go to buckets by anchor hash, packed and compressed, and a bucket is
worked off in parts of about 2 MB.  Equal
segments of one batch of documents go once, from the first place by (doc_id, start) in whatever
order they are read; the other places are repeats already, so a passage that a third of the
documents hold arrives once per batch.

In a bucket, suffixes that start a repeated string with differing bytes before it (others are
covered by the string one byte longer to the left) are sorted into a suffix array with
common-prefix lengths.  A stack scan walks the common-prefix intervals of at least
``least`` bytes and yields those with diverse left extensions: the maximal repeats, each with
all occurrences.  All but the first occurrence, by (doc_id, start), are removed.  Candidates come
from hashes, equality from the bytes.

Defined results: a null text is empty; a null id comes before all others; rows that repeat both id
and text are one document and get equal results; equal ids with other texts are ordered by
a hash of the text; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sevlens.llm.common import rebatched, stored

GRAM = 12
NULL_ID = -(1 << 63)
PART_BYTES = 2 << 20
PARTS = 4           # of a bucket
FREQUENT_BITS = 22


def word64(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Big-endian 8-byte and 4-byte words at every position."""
    w = b.astype(np.uint64)
    w = (w[:-1] << np.uint64(8)) | w[1:]
    four = (w[:-2] << np.uint64(16)) | w[2:]
    return (four[:-4] << np.uint64(32)) | four[4:], four


def grams(b: np.ndarray) -> np.ndarray:
    """Hash of the 12 bytes from every start."""
    eight, four = word64(b)
    h = eight[:len(b) - GRAM + 1] * np.uint64(0x9E3779B97F4A7C15)
    h ^= four[8:8 + len(h)] * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h


def anchors(b: np.ndarray, least: int, frequent: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each start of a string of ``least`` bytes: the place of its anchor and the anchor's hash.

    ``frequent`` says of each value of a hash's first bits whether such a gram comes after all others.
    """
    h = grams(b)
    bits = np.uint64(int(len(h)).bit_length())
    key = h >> np.uint64(1) >> bits << bits
    if frequent is not None:
        key |= frequent[(h >> np.uint64(64 - FREQUENT_BITS)).astype(np.int32)].astype(np.uint64) << np.uint64(63)
    key |= np.arange(len(h), dtype=np.uint64)                          # of equal hashes the first
    width, span = least - GRAM + 1, 1
    while span * 2 <= width:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    if width > span:
        key = np.minimum(key[:len(key) - (width - span)], key[width - span:])
    place = (key & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    return place, h[place]


def string_hashes(b: np.ndarray, least: int) -> np.ndarray:
    """Polynomial hash of the ``least`` bytes from every start, by doubling."""
    base = 0x9E3779B97F4A7C15 | 1
    h, size, out, done = b.astype(np.uint64) + np.uint64(1), 1, None, 0
    n = len(b) - least + 1
    while size <= least:
        if least & size:                  # the bits of `least` from low to high, placed from the right
            part = h[least - done - size:][:n]
            out = part.copy() if out is None else out + part * np.uint64(pow(base, done, 1 << 64))
            done += size
        if size * 2 > least:
            break
        h = h[:-size] * np.uint64(pow(base, size, 1 << 64)) + h[size:]
        size *= 2
    out ^= out >> np.uint64(32)
    return out * np.uint64(0xD6E8FEB86659FD93)


def pack(*parts: bytes) -> bytes:
    import zstandard

    sizes = np.array([len(parts), *map(len, parts)], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=5).compress(sizes + b"".join(parts))


def unpack(blob: bytes) -> list[bytes]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    ends = 8 * (n + 1) + np.concatenate([[0], np.cumsum(np.frombuffer(raw, "<i8", n, 8))])
    return [raw[a:b] for a, b in zip(ends[:-1], ends[1:])]


class Segments:
    """Collects the segments of documents, read in any order, for the buckets."""

    def __init__(self, least: int, parts: int, frequent: np.ndarray | None = None):
        self.least, self.parts, self.frequent = least, parts, frequent
        self.clear()

    def clear(self) -> None:
        self.seen: dict[bytes, int] = {}        # the segment's place in bucket and row
        self.part, self.size = array("q"), 0
        self.row, self.spans = array("q"), array("q")        # three and four numbers each, flat

    def add(self, docs: list[tuple[int, int, bytes]]) -> None:
        """Documents (id, text hash, bytes) in ascending order, each at least ``least`` long."""
        data = b"".join(t for _, _, t in docs)
        sizes = np.array([len(t) for _, _, t in docs])
        begin = np.cumsum(sizes) - sizes
        place, h = anchors(np.frombuffer(data, np.uint8), self.least, self.frequent)
        doc = np.repeat(np.arange(len(docs)), sizes)[:len(place)]
        valid = np.arange(len(place)) <= (begin + sizes - self.least)[doc]
        cut = np.ones(len(place), bool)
        cut[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1]) | (valid[1:] != valid[:-1])
        first = np.nonzero(cut)[0]
        last = np.append(first[1:], len(place))
        ok = valid[first]
        first, last = first[ok], last[ok] - 1 + self.least
        owner, part = doc[first], (h[first] % np.uint64(self.parts)).astype(np.int64)
        seen, spans, row = self.seen, self.spans, self.row
        for s, e, d, k in zip(first.tolist(), last.tolist(), owner.tolist(), part.tolist()):
            text, (i, t, _), at = data[s:e], docs[d], s - int(begin[d])
            known = seen.get(text)
            if known is None:
                seen[text] = len(self.part)
                self.part.append(k)
                row.extend((i, t, at))
                self.size += e - s
                continue
            place, first_place = (i, t, at), tuple(row[3 * known:3 * known + 3])
            if place == first_place:            # a repeated row
                continue
            if place < first_place:             # read later, but the first: the place so far is the repeat
                row[3 * known:3 * known + 3] = array("q", place)
                i, t, at = first_place
            if spans and spans[-4] == i and spans[-3] == t and spans[-2] <= at <= spans[-1]:
                spans[-1] = max(spans[-1], at + e - s)
            else:
                spans.extend((i, t, at, at + e - s))

    def rows(self) -> pa.RecordBatch:
        """One packed row for each bucket; the spans found here travel with the first."""
        part_of = np.array(self.part, np.int64)
        order = np.argsort(part_of, kind="stable")
        texts, bucket = list(self.seen), part_of[order] // PARTS
        cuts = [0, *(np.nonzero(np.diff(bucket))[0] + 1), len(bucket)] if len(bucket) else [0]
        spans = np.array(self.spans, "<i8").reshape(-1, 4)
        out, blobs, where = [], [], np.array(self.row, "<i8").reshape(-1, 3)
        for s, e in zip(cuts[:-1], cuts[1:]):
            part = order[s:e]
            own = [texts[i] for i in part]
            out.append(int(bucket[s]))
            blobs.append(pack(np.array([len(x) for x in own], "<i4").tobytes(), where[part].T.tobytes(), b"".join(own),
                              (part_of[part] % PARTS).astype(np.int8).tobytes(),
                              spans.T.tobytes() if s == 0 else b""))
        self.clear()
        return pa.RecordBatch.from_arrays([pa.array(out, pa.int64()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])


def maximal_repeats(lcp: list[int], left: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Stack scan of the common-prefix intervals: (length, first, last) of those of at least ``least``
    whose suffixes differ in the byte before; lcp[i] belongs to the suffixes i - 1 and i."""
    n = len(left)
    change = np.append(np.nonzero((left[1:] != left[:-1]) | (left[1:] < 0))[0], n)
    after = change[np.searchsorted(change, np.arange(n))].tolist()  # last place before the byte changes
    stack: list[tuple[int, int]] = []
    for i in range(1, n + 1):
        here, begin = lcp[i] if i < n else 0, i - 1
        while stack and stack[-1][0] > here:
            length, begin = stack.pop()
            if after[begin] < i - 1:
                yield length, begin, i - 1
        if here >= least and (not stack or stack[-1][0] < here):
            stack.append((here, begin))


def bucket_spans(sizes: np.ndarray, where: np.ndarray, data: bytes, least: int) -> np.ndarray:
    """(id, text hash, start, end) rows of all but the first occurrences of repeats among segments."""
    b, none = np.frombuffer(data, np.uint8), np.zeros((0, 4), np.int64)
    ends = np.cumsum(sizes)
    seg = np.repeat(np.arange(len(sizes)), sizes - least + 1)       # of each string, in order
    count = sizes - least + 1
    q = np.arange(len(seg)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(ends - sizes, count)
    h = string_hashes(b, least)[q]
    bits = np.uint64(int(len(q)).bit_length())
    key = np.sort((h >> bits << bits) | np.arange(len(q), dtype=np.uint64))
    del h
    at, top = (key & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), key >> bits
    del key
    same = top[1:] == top[:-1]
    member = np.zeros(len(at), bool)
    member[1:] |= same
    member[:-1] |= same
    at, top = at[member], top[member]
    if not len(at):
        return none
    start = q[at] == (ends - sizes)[seg[at]]
    left = np.where(start, -1, b[q[at] - 1].astype(np.int64))
    group = np.concatenate([[0], np.nonzero(top[1:] != top[:-1])[0] + 1])
    diverse = (np.minimum.reduceat(left, group) != np.maximum.reduceat(left, group)) | (np.minimum.reduceat(left, group) < 0)
    keep = np.repeat(diverse, np.diff(np.append(group, len(at))))
    at, left = at[keep], left[keep]
    if not len(at):
        return none
    p, s = q[at], seg[at]
    del q, seg, member, top
    e = ends[s]
    suffix = [data[x:y] for x, y in zip(p.tolist(), e.tolist())]
    order = np.array(sorted(range(len(suffix)), key=suffix.__getitem__))
    p, s, e, left = p[order], s[order], e[order], left[order]
    lcp = np.zeros(len(p), np.int64)
    column = np.arange(int((e - p).max()))
    for i in range(0, len(p) - 1, 20_000):       # neighbours' common prefixes, a block of rows at a time
        x, y = p[i:i + 20_001][:-1], p[i:i + 20_001][1:]
        size = np.minimum((e - p)[i:i + 20_001][:-1], (e - p)[i:i + 20_001][1:])
        differ = b[np.minimum(x[:, None] + column, len(b) - 1)] != b[np.minimum(y[:, None] + column, len(b) - 1)]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), len(column))
        lcp[i + 1:i + 1 + len(x)] = np.minimum(first, size)
    begin = where[2][s] + p - (ends - sizes)[s]
    place = np.stack([where[0][s], where[1][s], begin])
    by = np.lexsort(place[::-1])
    moved = np.concatenate([[0], (place[:, by][:, 1:] != place[:, by][:, :-1]).any(axis=0).cumsum()])
    rank = np.empty(len(p), np.int64)
    rank[by] = moved                              # equal places are one occurrence
    most = np.zeros(len(p), np.int64)
    for length, i, j in maximal_repeats(lcp.tolist(), left, least):
        r = rank[i:j + 1]
        later = r > r.min()
        most[i:j + 1][later] = np.maximum(most[i:j + 1][later], length)
    cut = most > 0
    return np.stack([place[0][cut], place[1][cut], begin[cut], begin[cut] + most[cut]], axis=1)


def merged(spans: np.ndarray) -> np.ndarray:
    """Union of (start, end) rows as maximal runs, ascending."""
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    far = np.maximum.accumulate(spans[:, 1])
    first = np.concatenate([[True], spans[1:, 0] > far[:-1]])
    at = np.nonzero(first)[0]
    return np.stack([spans[at, 0], far[np.append(at[1:], len(far)) - 1]], axis=1)


def frequent_grams(docs: DataFrame, n: int, total: int, sample: int = 8 << 20, share: float = 0.01) -> np.ndarray:
    """For each value of a gram hash's first bits: whether such a gram is in ``share`` of the documents (8 at least) of about ``sample`` bytes.

    It decides only which anchors serve, never which strings count as repeated.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rebatched(batches, 1 << 20):
            own = [np.unique(grams(np.frombuffer(t, np.uint8)) >> np.uint64(64 - FREQUENT_BITS))
                   for t in batch.column("text").cast(pa.binary()).to_pylist() if len(t) >= GRAM]
            if own:
                value, m = np.unique(np.concatenate(own), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value.astype(np.int64)), pa.array(m.astype(np.int64))], names=["gram", "m"])

    every = max(1, total // sample)
    some = docs.where(F.pmod(F.xxhash64(F.lit("grams"), "id", "h"), F.lit(every)) == 0)
    out = np.zeros(1 << FREQUENT_BITS, np.uint8)
    least = max(8, int(share * n / every))
    # at most one row for each value of the first bits
    found = some.select("text").mapInArrow(count, "gram long, m long").groupBy("gram").agg(F.sum("m").alias("m")).where(F.col("m") >= least).select("gram")
    for batch in found.toArrow().to_batches():
        out[batch.column("gram").to_numpy()] = 1
    return out


def with_repeats(docs: DataFrame, least: int = 100) -> DataFrame:
    """(doc_id, text, spans): each document with its removed runs [start, end) in bytes, flat and ascending."""
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    total, n = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    spark = docs.sparkSession
    # about 3.2 bytes of segments for each byte of text
    parts = max(2 * PARTS * spark.sparkContext.defaultParallelism, -(-int(total * 3.2) // PART_BYTES))
    often = spark.sparkContext.broadcast(frequent_grams(docs, n, total))          # 4 MB

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = Segments(least, parts, often.value)
        for batch in rebatched(batches, 1 << 20):
            rows = zip(batch.column("id").to_pylist(), batch.column("h").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist())
            own = sorted({r for r in rows if len(r[2]) >= least})
            if own:
                segments.add(own)
            if segments.size > 40 << 20:
                yield segments.rows()
        if segments.size:
            yield segments.rows()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held, spans = None, [], []          # held: part, sizes, places, bytes
        for batch in batches:
            for k, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob").to_pylist()):
                if k != bucket and held:
                    yield from span_rows(held, spans)
                    held, spans = [], []
                bucket = k
                sizes, where, data, part, own = unpack(blob)
                sizes, part = np.frombuffer(sizes, "<i4").astype(np.int64), np.frombuffer(part, np.int8)
                ends, cuts = np.cumsum(sizes), np.searchsorted(part, np.arange(PARTS + 1))      # a blob has its parts one after the other
                for i, (s, e) in enumerate(zip(cuts[:-1], cuts[1:])):
                    if s < e:
                        held.append((i, sizes[s:e], np.frombuffer(where, "<i8").reshape(3, -1)[:, s:e], data[ends[s] - sizes[s]:ends[e - 1]]))
                spans.append(np.frombuffer(own, "<i8").reshape(4, -1).T)
        if held:
            yield from span_rows(held, spans)

    def span_rows(held: list, spans: list) -> Iterator[pa.RecordBatch]:
        """Spans of one bucket, united for each document."""
        more = []
        for i in range(PARTS):
            own = [x[1:] for x in held if x[0] == i]
            held[:] = [x for x in held if x[0] != i]
            if own:
                more.append(bucket_spans(np.concatenate([x[0] for x in own]), np.concatenate([x[1] for x in own], axis=1), b"".join(x[2] for x in own), least))
        rows = np.concatenate([*more, *spans])
        if not len(rows):
            return
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        new = np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])
        at = np.append(np.nonzero(new)[0], len(rows))
        out = [(i, merged(rows[s:e, 2:])) for i, (s, e) in enumerate(zip(at[:-1], at[1:]))]
        yield pa.RecordBatch.from_arrays([pa.array(rows[at[:-1], 0]), pa.array(rows[at[:-1], 1]),
                                          pa.array([m.ravel().tolist() for _, m in out], pa.list_(pa.int64()))], names=["id", "h", "spans"])

    sent = docs.mapInArrow(cut, "bucket long, blob binary").repartition("bucket").sortWithinPartitions("bucket")
    found = stored(sent.mapInArrow(find, "id long, h long, spans array<long>"), "repeat-spans")
    spans = found.groupBy("id", "h").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return docs.join(spans, ["id", "h"], "left").select(F.nullif("id", F.lit(NULL_ID)).alias("doc_id"), "text", "spans")


def kept_bytes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) from :func:`with_repeats`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rebatched(batches):
            out = []
            for text, flat in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist()):
                runs = merged(np.array(flat, np.int64).reshape(-1, 2)).tolist() if flat else []
                digest, at = hashlib.sha256(), 0
                for s, e in runs:
                    digest.update(text[at:s])
                    at = e
                digest.update(text[at:])
                out.append((len(text), sum(e - s for s, e in runs), len(runs), digest.hexdigest()))
            n, removed, spans, sha = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(spans, pa.int64()), pa.array(sha, pa.string())],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return docs.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
