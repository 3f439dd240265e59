"""Secret scan: Aho-Corasick keyword prefilter, anchored patterns at its hits, checksum validation.

One automaton finds all keywords in the ASCII-lower-cased text; a kind's pattern is
tried only where its keyword begins, from left to right and past the kind's last
match, which gives the leftmost non-overlapping matches of a whole scan.  Long hex runs
have no keyword and are taken by one pattern over the text.  Kinds with an embedded
checksum are kept only if it holds.

Defined results: a null or empty text has no span; repeated rows get equal
results; texts of any length are scanned whole; other columns are ignored.
Positions are code points, ends exclusive.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sevlens.llm.common import rebatched

# Kinds in their listed order, their patterns and least lengths, keywords of each kind.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
CHECKED_TOKEN = re.compile(r"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
SIGNED_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
PRIVATE_KEY = re.compile(r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----")
KEYWORDS = {"assign": ("password", "passwd", "secret", "token", "apikey", "api_key"), "access": ("akia",),
            "checked": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"), "signed": ("eyj",), "key": ("-----begin",)}
KINDS = ("assign", "access", "hex", "checked", "signed", "key")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum_holds(m: re.Match) -> bool:
    """The last six characters are the CRC-32 of the thirty before, in base 62."""
    n, text = zlib.crc32(m[1].encode()), ""
    while n:
        n, digit = divmod(n, 62)
        text = BASE62[digit] + text
    return m[2] == text.rjust(6, "0")


def header_holds(m: re.Match) -> bool:
    """The first part is the base-64 of a JSON object that names its algorithm."""
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(m[1] + "=" * (-len(m[1]) % 4)))
    except (ValueError, binascii.Error, TypeError):
        return False


#: kind -> (pattern, whether a match counts)
RULES = {"assign": (ASSIGN, lambda m: len(m[2]) >= 6), "access": (ACCESS, lambda m: m.end() - m.start() >= 20),
         "checked": (CHECKED_TOKEN, checksum_holds), "signed": (SIGNED_TOKEN, header_holds), "key": (PRIVATE_KEY, lambda m: True)}


def ascii_lower(text: str) -> str:
    """Lower case of A-Z alone, one code point for each."""
    if text.isascii():
        return text.lower()
    code = np.frombuffer(text.encode("utf-32-le"), "<u4").copy()
    code[(code >= 65) & (code <= 90)] += 32
    return code.tobytes().decode("utf-32-le")


def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for kind, keywords in KEYWORDS.items():
        for k in keywords:
            a.add_word(k, (kind, len(k)))
    a.make_automaton()
    return a


def scan(text: str, keywords) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) by start, then kind as listed."""
    spans, last = [("hex", m.start(), m.end()) for m in HEX.finditer(text)], {}
    for end, (kind, size) in sorted(keywords.iter(ascii_lower(text)), key=lambda x: x[0] - x[1][1]):
        start = end - size + 1
        if start < last.get(kind, 0):
            continue
        pattern, counts = RULES[kind]
        if m := pattern.match(text, start):
            last[kind] = m.end()
            if counts(m):
                spans.append((kind, start, m.end()))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def scan_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): every span of every document as (kind, start, end)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keywords = automaton()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in rebatched(batches):
            found = [[dict(zip(("kind", "start", "end"), s)) for s in scan(t.as_py() or "", keywords)] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")
