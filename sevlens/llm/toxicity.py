"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Terms are words and their 4- and 5-letter beginnings.  Of copies and near copies under a label
one trains (operator 8 within the label: linked by verified five-word Jaccard similarities of 0.8 or
more), so that the wording of a much-copied text isn't taken for a mark of its label.  A bounded sample of
the rows so left (``sample`` for each label) gives the examples; of label 1, rows come first that stand for a
mark of that label (a term in three of its rows, ten times as frequent as elsewhere, with a
log-likelihood ratio of 24 or more), so that rare marks have an example too.  The vocabulary is every
term of the examples that three training rows hold, so what the driver gathers is bounded by the
sample.  Its IDF comes from counts over all labelled training rows, and is multiplied by
``floor`` and the part of the term's log odds between the labels that exceeds ``errors`` standard errors, either way:
every term takes part, but those that tell the labels apart weigh more.  The
vectors form an inverted index cut into blocks of examples with the largest weight of every
term in every block that holds it.  A text's blocks are read by falling bound, and reading stops when
no block can hold a nearer example than the k found, so the k nearest are exact.  Where the bounds rule out few
blocks, the text's terms are read whole, with the same result.
Votes weighted by distance give a raw score, which isotonic regression over the examples,
each left out of its own vote, turns into a share of label 1.

Defined results: a null or empty text, or one without a term of the vocabulary, gets the share of such
texts; labels and ids of null train nothing; without both labels the
score is the share of label 1 (0 without labels); other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sevlens.llm import jaccard_join
from sevlens.llm.common import bounded_sample, held_out, rebatched, small_batches, stored, strings, those_held

WORDS = re.compile(r"[^\W\d_]+")
BLOCK = 64


def terms(text: str) -> Counter:
    n = Counter(WORDS.findall(text.lower()))
    out = Counter(n)
    for w, c in n.items():
        for size in (4, 5):
            if len(w) > size:
                out[f"{w[:size]}~"] += c
    return out


def held_terms(text: str) -> set[str]:
    words = set(WORDS.findall(text.lower()))
    return words | {f"{w[:size]}~" for w in words for size in (4, 5) if len(w) > size}


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, y) of the labelled documents that may be learned from; a row for each distinct label."""
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y")).where("y IS NOT NULL").distinct()
    y = stored(y, "labels")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(~held_out(F.col("doc_id")))
    return stored(those_held(rows, y, "doc_id").join(y, "doc_id"), "labelled")


def distinct_texts(rows: DataFrame, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """Rows of the smallest id of each group of verified near copies under a label.

    Only rows that may be dropped meet in a join, so that the texts of the others stay where they are.
    """
    rows = rows.where("y IN (0, 1)")
    found = jaccard_join.join(rows, threshold, words, within="y").groupBy("doc_id", F.col("y").cast("int").alias("y")).agg(F.max("kept").alias("kept"))
    gone, rows = stored(found.where("NOT kept").drop("kept"), "dropped-ids"), rows.where("doc_id IS NOT NULL")
    some = those_held(rows, gone, "doc_id", "y").join(gone, ["doc_id", "y"], "left_anti")
    return stored(those_held(rows, gone, "doc_id", "y", how="left_anti").unionByName(some.select(*rows.columns)), "training-rows")


def term_counts(rows: DataFrame) -> DataFrame:
    """(term, n0, n1, holder): rows of each label that hold the term, and the row of label 1 with the least hash that does."""

    def counted(n: tuple[Counter, Counter], holder: dict) -> pa.RecordBatch:
        both = list(n[0] | n[1])
        return pa.RecordBatch.from_arrays([pa.array(both, pa.string()), pa.array([n[0][t] for t in both], pa.int64()), pa.array([n[1][t] for t in both], pa.int64()),
                                           pa.array([None if (at := holder.get(t)) is None else {"h": at[0], "doc_id": at[1]} for t in both],
                                                    pa.struct([("h", pa.int64()), ("doc_id", pa.int64())]))], names=["term", "n0", "n1", "holder"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, holder = (Counter(), Counter()), {}
        for batch in rebatched(batches, 1 << 20):
            found = zip(strings(batch.column("text")), batch.column("y").to_pylist(), batch.column("holder").to_pylist())
            for t, y, at in found:
                held = held_terms(t)
                n[y].update(held)
                if y:
                    at = at["h"], at["doc_id"]
                    holder.update((x, at) for x in held if holder.get(x, at) >= at)      # the least hash stays
            if len(n[0]) + len(n[1]) > 1 << 17:
                yield counted(n, holder)
                n, holder = (Counter(), Counter()), {}
        if n[0] or n[1]:
            yield counted(n, holder)

    parts = (rows.select("text", "y", F.struct(F.xxhash64(F.lit("holder"), "doc_id").alias("h"), "doc_id").alias("holder"))
             .mapInArrow(count, "term string, n0 long, n1 long, holder struct<h: long, doc_id: long>"))
    return parts.groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.min("holder").alias("holder"))


def likelihood_ratio(n0: F.Column, n1: F.Column, all0: int, all1: int) -> F.Column:
    """G statistic of (term present) x (label)."""
    n, held = all0 + all1, n0 + n1
    cell = lambda seen, row, col: F.when(seen > 0, seen * F.log(seen * n / (row * col))).otherwise(0.0)
    return 2 * (cell(n0, held, F.lit(all0)) + cell(n1, held, F.lit(all1))
                + cell(F.lit(all0) - n0, n - held, F.lit(all0)) + cell(F.lit(all1) - n1, n - held, F.lit(all1)))


def term_weight(n0: np.ndarray, n1: np.ndarray, all0: int, all1: int, floor: float, errors: float) -> np.ndarray:
    """IDF times ``floor`` and the part of the log odds ratio that exceeds ``errors`` standard errors."""
    a, b, c, d = n1 + 0.5, all1 - n1 + 0.5, n0 + 0.5, all0 - n0 + 0.5
    apart = np.abs(np.log(a * d / (b * c))) - errors * np.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    return (np.log((all0 + all1) / (n0 + n1)) + 0.1) * (floor + np.maximum(apart, 0))


def ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The integers of all ranges first..last, one range after the other."""
    n = last - first
    upto = np.cumsum(n)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(first - upto + n, n)


class Examples:
    """Block-max inverted index over example vectors (sparse rows of unit length).

    Postings are ordered by (term, row); an entry is the run of a term within a block of rows, with its largest weight.
    Terms that ``common`` of the rows hold are kept as dense columns, multiplied for several texts at once; their
    exact part makes the bounds of the blocks tighter.
    """

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], n_terms: int, common: float = 1 / 8):
        self.n, self.blocks = len(rows), -(-len(rows) // BLOCK)
        row = np.repeat(np.arange(self.n, dtype=np.int32), [len(t) for t, _ in rows])
        term = np.concatenate([t for t, _ in rows]).astype(np.int32) if rows else np.zeros(0, np.int32)
        weight = np.concatenate([w for _, w in rows]) if rows else np.zeros(0)
        often = np.nonzero(np.bincount(term, minlength=n_terms) > common * self.n)[0]
        self.column = np.full(n_terms, -1)
        self.column[often] = np.arange(len(often))
        held = self.column[term] >= 0
        self.often, self._dense = (len(often), self.column[term[held]].astype(np.int32), row[held], weight[held]), None
        # each array is let go as soon as it is read: this is the largest of what the driver holds
        rest = np.nonzero(~held)[0].astype(np.int32)
        order = rest[np.argsort(term[rest], kind="stable")]        # rows ascend already
        del held, rest
        self.row = row[order]
        del row
        self.weight = weight[order]
        del weight
        term = term[order]
        del order
        start = np.nonzero(np.append(True, (term[1:] != term[:-1]) | (np.diff(self.row // BLOCK) != 0)))[0] if len(term) else np.zeros(0, np.int64)
        self.start = np.append(start, len(term))
        self.block = self.row[start] // BLOCK
        self.most = np.maximum.reduceat(self.weight, start) if len(start) else np.zeros(0)
        self.entry = np.searchsorted(term[start], np.arange(n_terms + 1))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_dense": None}

    @property
    def dense(self) -> np.ndarray:
        """Columns of the common terms; built where they are used, never sent."""
        if self._dense is None:
            n, column, row, weight = self.often
            self._dense = np.zeros((n, self.blocks * BLOCK))
            self._dense[column, row] = weight
        return self._dense

    def nearest(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, without: Sequence[int] = ()) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Exact k nearest (rows, cosines to 12 places) of each query, larger cosine then smaller row first; cosine 0 is no neighbour."""
        for s in range(0, len(queries), BLOCK):
            some = queries[s:s + BLOCK]
            q = np.zeros((len(some), len(self.dense)))
            for i, (t, w) in enumerate(some):
                at = self.column[t]
                q[i, at[at >= 0]] = w[at >= 0]
            for i, ((t, w), part) in enumerate(zip(some, q @ self.dense)):
                rare = self.column[t] < 0
                yield self._nearest(t[rare], w[rare], part, k, without[s + i] if len(without) else -1)

    def _whole(self, t: np.ndarray, w: np.ndarray, part: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest by the whole postings of the terms."""
        first, last = self.start[self.entry[t]], self.start[self.entry[t + 1]]
        p = ranges(first, last)
        cos = part + np.bincount(self.row[p], np.repeat(w, last - first) * self.weight[p], len(part))
        if len(cos) >= k:
            floor = max(floor, float(np.partition(cos, -k)[-k]))
        rows = np.nonzero((cos > 0) & (cos >= floor - 1e-11))[0]
        near = cos[rows].round(12)
        best = np.lexsort((rows, -near))[:k]
        rows, near = rows[best], near[best]
        return rows[near > 0], near[near > 0]

    def _nearest(self, t: np.ndarray, w: np.ndarray, part: np.ndarray, k: int, without: int) -> tuple[np.ndarray, np.ndarray]:
        if without >= 0:
            part[without] = -np.inf
        first, last = self.entry[t], self.entry[t + 1]
        e, x = ranges(first, last), np.repeat(w, last - first)
        block = self.block[e]
        bound = part.reshape(-1, BLOCK).max(axis=1) + np.bincount(block, x * self.most[e], self.blocks)
        # the rest adds nothing below 0, so the k-th largest exact part is a floor of the k-th cosine
        floor = max(0.0, float(np.partition(part, -k)[-k])) if len(part) >= k else 0.0
        if 2 * (bound + 1e-11 >= floor)[block].sum() > len(block):
            return self._whole(t, w, part, k, floor)
        rows, near = np.zeros(0, np.int64), np.zeros(0)
        order = np.argsort(-bound, kind="stable")
        done, step = 0, 8
        while done < len(order) and bound[order[done]] > 0 and bound[order[done]] + 1e-11 >= floor:
            read = np.zeros(self.blocks, bool)
            read[order[done:done + step]] = True
            done, step = done + step, self.blocks
            read &= bound + 1e-11 >= floor
            some = read[block]
            s, n = self.start[e[some]], self.start[e[some] + 1]
            p = ranges(s, n)
            cos = part + np.bincount(self.row[p], np.repeat(x[some], n - s) * self.weight[p], len(part))
            hit = np.nonzero(np.repeat(read, BLOCK) & (cos > 0) & (cos >= floor - 1e-11))[0]
            rows, near = np.append(rows, hit), np.append(near, cos[hit].round(12))
            best = np.lexsort((rows, -near))[:k]
            rows, near = rows[best], near[best]
            if len(near) >= k:
                floor = max(floor, float(near[-1]))
        return rows[near > 0], near[near > 0]


def vote(near: np.ndarray, labels: np.ndarray) -> float:
    w = near / (1.05 - np.minimum(near, 1.0))           # a neighbour at cosine 0 has no say
    return float((w * labels).sum() / w.sum())


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (x, value) of the non-decreasing least-squares fit, by pooling adjacent violators: both ends of every pool."""
    at, inverse = np.unique(x, return_inverse=True)
    weight, total = np.bincount(inverse, w), np.bincount(inverse, w * y)
    pools: list[list[float]] = []
    for a, n, s in zip(at, weight, total):
        pools.append([a, a, n, s])
        while len(pools) > 1 and pools[-2][3] / pools[-2][2] >= pools[-1][3] / pools[-1][2]:
            _, end, n2, s2 = pools.pop()
            pools[-1][1] = end
            pools[-1][2] += n2
            pools[-1][3] += s2
    return np.array([p[i] for p in pools for i in (0, 1)]), np.array([p[3] / p[2] for p in pools for _ in (0, 1)])


def by_length(known: dict) -> tuple[dict, dict, dict]:
    """The numbers of whole words, 4-letter and 5-letter beginnings."""
    begins = [{t[:n]: i for t, i in known.items() if t[n:] == "~"} for n in (4, 5)]
    return {t: i for t, i in known.items() if t[-1] != "~"}, *begins


class Numbers:
    """The numbers of a word's three terms: its own and those of its beginnings (-1: not in the vocabulary).

    Those of the vocabulary's words are held; other words may still have a beginning in it.
    """

    def __init__(self, known: tuple[dict, dict, dict]):
        self.known = known
        self.begins = np.full((sum(map(len, known)) + 1, 2), -1, np.int32)
        for word, i in known[0].items():
            self.begins[i] = self.begin(word)

    def begin(self, word: str) -> tuple[int, int]:
        size, (_, four, five) = len(word), self.known
        return four.get(word[:4], -1) if size > 4 else -1, five.get(word[:5], -1) if size > 5 else -1

    def of(self, words: list[str]) -> np.ndarray:
        whole = np.fromiter(map(self.known[0].get, words, repeat(-1)), np.int64, len(words))
        begins = self.begins[whole]
        for i in np.nonzero(whole < 0)[0].tolist():
            begins[i] = self.begin(words[i])
        return np.column_stack([whole, begins])


def vector(text: str, numbers: Numbers, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit TF-IDF vector of a text: term numbers ascending, weights."""
    n = Counter(WORDS.findall(text.lower()))
    t, c = numbers.of(list(n)), np.fromiter(n.values(), float, len(n))
    held = t >= 0
    t, c = t[held], np.repeat(c, 3)[held.ravel()]
    order = np.argsort(t, kind="stable")
    t, c = t[order], c[order]
    first = np.nonzero(np.append(True, t[1:] != t[:-1]))[0] if len(t) else order
    t, w = t[first], (1 + np.log(np.add.reduceat(c, first) if len(t) else c)) * weight[t[first]]
    return t, w / np.linalg.norm(w) if len(w) else w


def sampled(rows: DataFrame, counts: DataFrame, all0: int, all1: int, sample: int, least: float, lift: float, support: int) -> DataFrame:
    """At most ``sample`` rows of each label; of label 1, first those that stand for a mark, the strongest marks first."""
    g = likelihood_ratio(F.col("n0"), F.col("n1"), all0, all1)
    marks = (F.col("n1") >= support) & (F.col("n1") * all0 >= lift * all1 * F.col("n0"))
    holders = (counts.where(marks).withColumn("g", g).where(F.col("g") >= least).groupBy(F.col("holder.doc_id").alias("doc_id"))
               .agg(F.max("g").alias("g")).orderBy(F.desc("g"), "doc_id").limit(sample).withColumn("y", F.lit(1)))
    drawn = bounded_sample(rows, "y", sample).withColumn("g", F.lit(0.0))
    marked = rows.join(holders, ["doc_id", "y"]).select(*drawn.columns)
    both = marked.unionByName(drawn).groupBy("doc_id", "y", "text").agg(F.max("g").alias("g"))     # at most 3 x sample rows
    w = Window.partitionBy("y").orderBy(F.desc("g"), F.xxhash64(F.lit("fit order"), "doc_id"), "doc_id", "text")
    return both.withColumn("r", F.row_number().over(w)).where(F.col("r") <= sample).select("doc_id", "y", "text")


def fit(rows: DataFrame, sample: int = 1500, least: float = 24.0, lift: float = 10.0, support: int = 3, k: int = 15, floor: float = 0.3,
        errors: float = 2.0) -> dict:
    """Model from labelled rows (doc_id, text, y in 0, 1)."""
    small_batches(rows.sparkSession)
    rows = distinct_texts(rows.where("y IN (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                                                           F.col("y").cast("int").alias("y")))
    per = dict(rows.groupBy("y").count().collect())
    all0, all1 = per.get(0, 0), per.get(1, 0)
    model = {"known": {}, "k": k, "none": all1 / max(all0 + all1, 1)}
    if not all0 or not all1:
        return model
    counts = stored(term_counts(rows).where(F.col("n0") + F.col("n1") >= support), "term-counts")
    chosen = stored(sampled(rows, counts, all0, all1, sample, least, lift, support), "examples")

    def distinct_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rebatched(batches):
            held = set().union(*[held_terms(t) for t in strings(batch.column("text"))])
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string())], names=["term"])

    asked = chosen.select("text").mapInArrow(distinct_terms, "term string").distinct()
    kept = counts.join(asked, "term").select("term", "n0", "n1").toArrow()         # terms of the bounded sample alone
    weight = term_weight(kept["n0"].to_numpy().astype(float), kept["n1"].to_numpy().astype(float), all0, all1, floor, errors)
    order = pc.sort_indices(pa.table({"weight": weight, "term": kept["term"]}), sort_keys=[("weight", "descending"), ("term", "ascending")])
    known, weight = {t: i for i, t in enumerate(kept["term"].take(order).to_pylist())}, weight[order.to_numpy()]
    del kept, order

    table, parts = chosen.select("doc_id", "y", "text").toArrow(), Numbers(by_length(known))
    got = [(i, label, *vector(text.as_py() or "", parts, weight)) for i, label, text in zip(table["doc_id"].to_pylist(), table["y"].to_pylist(), table["text"])]
    got.sort(key=lambda r: (r[2][:1].tolist(), r[1], r[0], r[2].tobytes()))        # like examples share blocks
    y = np.array([r[1] for r in got], float)
    index = Examples([r[2:] for r in got], len(known))
    stands_for = {label: per[label] / max(1, (y == label).sum()) for label in (0, 1)}
    found = index.nearest([r[2:] for r in got], k, range(len(got)))
    raw, w = np.array([vote(near, y[rows_]) if len(near) else -1.0 for rows_, near in found]), np.where(y == 1, stands_for[1], stands_for[0])
    none = raw < 0
    if none.any():
        model["none"] = float((w * y)[none].sum() / w[none].sum())
    steps = isotonic(raw[~none], y[~none], w[~none]) if (~none).any() else (np.zeros(1), np.array([model["none"]]))
    index._dense = None         # the driver scores nothing more
    return model | {"known": known, "weight": weight, "index": index, "y": y, "ids": [r[0] for r in got], "steps": steps}


EVIDENCE = T.ArrayType(T.StructType([T.StructField('doc_id', T.LongType()), T.StructField('label', T.IntegerType()),
                                     T.StructField('cosine', T.DoubleType())]))


def score(docs: DataFrame, model: dict, name: str = "score", evidence: str = "evidence") -> DataFrame:
    """``docs`` with the score of every whole text and its evidence: the nearest examples, their labels and cosines."""
    small_batches(docs.sparkSession)
    keep = docs.columns
    types = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType()),
                          T.StructField(evidence, EVIDENCE)])
    return docs.mapInArrow(scorer(docs, model, keep, [name, evidence]), types)


def in_groups(index: Examples, vectors: Iterator, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The neighbours of each vector; only a group's vectors are held at a time."""
    while some := list(islice(vectors, BLOCK)):
        yield from index.nearest(some, k)


def scorer(docs: DataFrame, model: dict, keep: list[str], names: list[str]):
    # the vocabulary goes out as it's looked up, so that a worker never builds it beside another form
    shared = docs.sparkSession.sparkContext.broadcast(model | {"known": by_length(model["known"])})
    item = pa.list_(pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        known, none = Numbers(m["known"]) if any(m["known"]) else None, (np.zeros(0, np.int64), np.zeros(0))
        ids, labels = np.array(m.get("ids", []), np.int64), np.array(m.get("y", []), np.int32)
        for batch in rebatched(batches, 4 << 20):        # what a worker holds of a batch is a few times its texts
            texts = strings(batch.column("text"))
            different = list(dict.fromkeys(texts)) if known is not None else []           # copies in a batch are scored once
            near_of = dict(zip(different, in_groups(m["index"], (vector(t, known, m["weight"]) for t in different), m["k"]))) if known is not None else {}
            found = [near_of.get(t, none) for t in texts]
            scores = [float(np.interp(vote(near, m["y"][rows]), *m["steps"])) if len(rows) else m["none"] for rows, near in found]
            rows = np.concatenate([np.zeros(0, np.int64), *[r for r, _ in found]])
            near = np.concatenate([np.zeros(0), *[c for _, c in found]])
            evidence = pa.StructArray.from_arrays([pa.array(ids[rows], pa.int64()), pa.array(labels[rows], pa.int32()), pa.array(near)], fields=list(item.value_type))
            offsets = pa.array(np.cumsum([0, *[len(r) for r, _ in found]]), pa.int32())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(scores, pa.float64()), pa.ListArray.from_arrays(offsets, evidence).cast(item)],
                                             names=[*keep, *names])

    return run
