"""Token-ID / binary output: flat unsigned integer files with 64-bit document offsets.

``write_tokens`` encodes documents in ascending ``doc_id`` order.  Each range
partition becomes one shard of three flat little-endian files:

* ``NNNNN.tok``  token ids, unsigned 16 bit if the vocabulary fits, else 32 bit;
* ``NNNNN.off``  unsigned 64-bit offsets (documents + 1) into that shard's ids;
* ``NNNNN.doc``  signed 64-bit document ids.

A shard is written under a name of its attempt and renamed when complete, so a
retried or speculative task leaves one whole shard.  Shard totals give each
shard's base by prefix sum (``token_base``); global document offsets are base plus
local offset.  ``read_tokens`` memory-maps the shards on the executors.

Defined results: a null text is empty (its end id only); a null id sorts first and
is stored as -2^63 (read back as null); repeated rows are encoded each time, ties
of ``doc_id`` ordered by text; an empty table gives no shard; columns other than
``doc_id`` and ``text`` are ignored.  ``folder`` must be a shared file system that
executors can open and map.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sevlens.llm.common import rebatched, strings

NULL_ID = -(1 << 63)
SHARD = T.StructType([T.StructField("shard", T.LongType()), T.StructField("docs", T.LongType()),
                      T.StructField("tokens", T.LongType())])


def local_folder(path: str) -> str:
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    if "://" in path:
        raise ValueError(f"{path}: memory-mapped shards need a mounted shared file system")
    return path


class ChunkEncoder:
    """Encodes by the tokenizers library, once for each distinct space-led chunk.

    The pre-tokenizer always cuts before a space that a non-space follows and on both
    sides of a line feed between non-spaces, so chunks cut there encode on their
    own; a line that holds other white space is cut only where that is certain, by
    being encoded whole, and so is a text that holds an added token such as
    <|endoftext|>.  Distinct chunks are kept up to ``keep`` entries.
    """

    def __init__(self, path: str, dtype: str, keep: int = 700_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype, self.keep, self.known = dtype, keep, {}
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        words = self.tokenizer.get_vocab(with_added_tokens=True)
        self.leads = np.zeros(max(words.values()) + 1, bool)
        self.leads[[i for w, i in words.items() if w.startswith("\u0120")]] = True      # the byte-level sign of a space

    def holds_added(self, text: str) -> bool:
        return any(t in text for t in self.added)

    def learn(self, chunks: set[str]) -> None:
        """Encodes new chunks; those led by a space in lines of many, cut where a token begins with a space."""
        new = [c for c in chunks if c not in self.known]
        led, rest = [], []
        for c in new:
            (led if c[0] == " " and len(c) > 1 and not self.holds_added(c) else rest).append(c)
        lines = [led[i:i + 1000] for i in range(0, len(led), 1000)]
        for line, e in zip(lines, self.tokenizer.encode_batch_fast(["".join(x) for x in lines], add_special_tokens=False)):
            ids = np.array(e.ids, self.dtype)
            at = np.nonzero(self.leads[ids])[0]
            if len(at) != len(line) or self.holds_added("".join(line)):    # a token that holds a space elsewhere: one by one
                rest += line
                continue
            raw, cut = ids.tobytes(), (np.append(at, len(ids)) * ids.itemsize).tolist()
            self.known.update((c, raw[x:y]) for c, x, y in zip(line, cut[:-1], cut[1:]))
        for c, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            self.known[c] = np.array(e.ids, dtype=self.dtype).tobytes()

    def chunks(self, text: str) -> list[str]:
        words = text.split(" ")
        if words[0][-1:].isspace() or any(w[:1].isspace() or not w for w in words[1:]):
            return [text]
        return [words[0], *[f" {w}" for w in words[1:]]] if words[0] else [f" {w}" for w in words[1:]]

    def pieces(self, text: str) -> list[str]:
        """Chunks whose encodings, put together, are the encoding of ``text``."""
        if not text:
            return []
        if self.holds_added(text):
            return [text]
        lines = text.split("\n")
        if any(not x or x[0].isspace() or x[-1].isspace() for x in lines):
            return [text]                   # runs of white space around a line feed
        out = self.chunks(lines[0])
        for line in lines[1:]:
            out.append("\n")
            out += self.chunks(line)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self.pieces(t) for t in texts]
        if len(self.known) > self.keep:
            self.known.clear()
        self.learn(set().union(*cut))
        get = self.known.__getitem__
        out = [b"".join(map(get, c)) for c in cut]
        for c in cut:
            if len(c) == 1 and len(c[0]) > 64:      # a whole text: of no use to another
                self.known.pop(c[0], None)
        return out


#: One encoder for each worker process and tokenizer, so that later tasks reuse its chunks.
_ENCODERS: dict[tuple[str, str], ChunkEncoder] = {}


def encoder_of(path: str, dtype: str) -> ChunkEncoder:
    if (path, dtype) not in _ENCODERS:
        _ENCODERS[path, dtype] = ChunkEncoder(path, dtype)
    return _ENCODERS[path, dtype]


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, vocabulary: int, end_id: int = 0) -> DataFrame:
    """Write the shards of ``docs`` to ``folder``; one row per shard with its token and document base."""
    base, dtype = local_folder(folder), "<u2" if vocabulary <= 1 << 16 else "<u4"
    end = np.array([end_id], dtype=dtype).tobytes()

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = encoder_of(tokenizer, dtype)
        number, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        docs = tokens = 0
        files = {}
        for batch in rebatched(batches, 4 << 20):
            if not batch.num_rows:
                continue
            if not files:
                os.makedirs(base, exist_ok=True)
                files = {x: open(f"{base}/.{attempt}.{x}", "wb") for x in ("tok", "off", "doc")}
                files["off"].write(np.zeros(1, "<u8").tobytes())
            coded = [x + end for x in encoder.encode(strings(batch.column("text")))]
            sizes = np.array([len(x) for x in coded], "<u8") // len(end)
            files["tok"].write(b"".join(coded))
            files["off"].write((tokens + np.cumsum(sizes)).astype("<u8").tobytes())
            ids = batch.column("doc_id").fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            files["doc"].write(ids.astype("<i8").tobytes())
            docs, tokens = docs + batch.num_rows, tokens + int(sizes.sum())
        if files:
            for x, f in files.items():
                f.flush()
                os.fsync(f.fileno())
                f.close()
                os.replace(f"{base}/.{attempt}.{x}", f"{base}/{number:05d}.{x}")
            yield pa.RecordBatch.from_pydict({"shard": [number], "docs": [docs], "tokens": [tokens]},
                                             schema=pa.schema([(c, pa.int64()) for c in ("shard", "docs", "tokens")]))

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spread = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return spread.mapInArrow(shard, SHARD)


def with_bases(shards: DataFrame) -> DataFrame:
    """Prefix sums over the shard table (one small row per shard)."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    return shards.select("*", F.coalesce(F.sum("tokens").over(before), zero).alias("token_base"),
                         F.coalesce(F.sum("docs").over(before), zero).alias("doc_base"))


def read_tokens(shards: DataFrame, folder: str, vocabulary: int) -> DataFrame:
    """Per document from the files: doc_id, start, n_tokens, ids_crc32 (of 32-bit ids)."""
    base, dtype = local_folder(folder), "<u2" if vocabulary <= 1 << 16 else "<u4"
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                path = f"{base}/{row['shard']:05d}"
                ids = np.memmap(f"{path}.tok", dtype, "r")
                offsets = np.memmap(f"{path}.off", "<u8", "r").astype(np.int64)
                doc = np.memmap(f"{path}.doc", "<i8", "r")
                for i in range(0, len(doc), 20_000):
                    at, own = offsets[i:i + 20_001], np.array(doc[i:i + 20_000])
                    crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(at[:-1], at[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own, mask=own == NULL_ID), pa.array(row["token_base"] + at[:-1]),
                         pa.array(at[1:] - at[:-1]), pa.array(crc, pa.int64())], names)

    n = shards.sparkSession.sparkContext.defaultParallelism
    return (shards.select("shard", "token_base").repartition(max(n, 1), "shard")
            .mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long"))
