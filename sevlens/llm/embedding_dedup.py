"""Embedding near-duplicates by PCA-ordered tiled comparison.

Equal vectors are one class.  Class representatives are scaled to unit length and
rotated to principal axes (an orthogonal map, so cosines stay), cut into tiles of
nearby vectors, and tiles are compared pairwise: the product over the leading axes is
accumulated first, the rest is bounded by the product of suffix norms, and only rows
and columns whose bound still reaches the threshold are carried to the next axes.
Whole tile pairs are skipped when the boxes of their leading coordinates are farther
apart than the chord of the threshold.  What remains within rounding distance of the
threshold is decided by the cosine of the given vectors in double precision.

A tile pair gives link counts and a spanning forest of its links, never the links
themselves, so a large group of near copies costs its rows, not its square, in output.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null id, link with nothing; shorter vectors count as padded with
zeros; repeated rows and equal vectors link with each other; an empty table gives
an empty result; other columns are ignored.  ``component_id`` is the smallest id
reachable by links, and a row is ``kept`` if it has that id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sevlens.llm.common import connected_components, min_roots, stored

#: Axes added at each step of the accumulation.
STEPS = (16, 32, 64)
#: Leading axes of a tile's box.
BOX = 8
#: Distance from the threshold within which the given vectors decide.
ROUNDING = 1e-9


def usable(e: str = "embedding") -> F.Column:
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    zero = ~F.exists(e, lambda x: x != 0)
    return F.coalesce(~bad & ~zero, F.lit(False))


def unit_rows(vectors: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Given rows padded to ``d`` axes, as doubles, and the same at unit length."""
    given = np.zeros((len(vectors), d))
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    size = np.diff(vectors.offsets.to_numpy())
    row = np.repeat(np.arange(len(vectors)), size)
    given[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    scaled = given / np.abs(given).max(axis=1, keepdims=True)
    return given, scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def principal_axes(vectors: DataFrame, d: int) -> np.ndarray:
    """Axes of the second moments of all unit vectors, largest first; d x d numbers reach the driver."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            if batch.num_rows:
                x = unit_rows(batch.column("embedding"), d)[1]
                total += x.T @ x
        i = np.repeat(np.arange(d), d)
        yield pa.RecordBatch.from_arrays([pa.array(i * d + np.tile(np.arange(d), d)), pa.array(total.ravel())], ["i", "s"])

    sums = vectors.select("embedding").mapInArrow(moments, "i long, s double").groupBy("i").agg(F.sum("s").alias("s"))
    matrix = np.zeros(d * d)
    for i, s in sums.collect():
        matrix[i] = s
    matrix = matrix.reshape(d, d)
    return np.linalg.eigh((matrix + matrix.T) / 2)[1][:, ::-1].copy()


def compare(a: dict, b: dict, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (rows of a, rows of b) whose cosine reaches ``threshold``, in blocks of rows; i < j within a tile."""
    x, y, d = a["z"], b["z"], a["z"].shape[1]
    ends = sorted({min(s, d) for s in STEPS} | {d})
    for at in range(0, len(x), 512):
        rows, cols = np.arange(at, min(at + 512, len(x))), np.arange(len(y))
        part, begin = np.zeros((len(rows), len(cols))), 0
        for end in ends:
            part += x[rows, begin:end] @ y[cols, begin:end].T
            if end == d or not len(rows) or not len(cols):
                break
            open_ = part + np.multiply.outer(a["rest"][end][rows], b["rest"][end][cols]) >= threshold - ROUNDING
            r, c = open_.any(axis=1), open_.any(axis=0)
            rows, cols, part, begin = rows[r], cols[c], part[np.ix_(r, c)], end
        i, j = np.nonzero(part >= threshold - ROUNDING)
        near = np.abs(part[i, j] - threshold) <= ROUNDING
        i, j = rows[i], cols[j]
        if near.any():
            u, v = a["given"][i[near]], b["given"][j[near]]
            exact = (u * v).sum(axis=1) / np.sqrt((u * u).sum(axis=1) * (v * v).sum(axis=1))
            near[near] = exact < threshold
        ok = ~near & ((i < j) if same else True)
        if ok.any():
            yield i[ok], j[ok]


def opened(row: dict, axes: np.ndarray) -> dict:
    d = len(axes)
    given = np.frombuffer(row["given"]).reshape(-1, d)
    scaled = given / np.abs(given).max(axis=1, keepdims=True)
    z = scaled / np.linalg.norm(scaled, axis=1, keepdims=True) @ axes
    tail = np.sqrt(np.cumsum((z * z)[:, ::-1], axis=1)[:, ::-1])
    rest = {s: tail[:, s] for s in STEPS if s < d}
    return {"given": given, "z": z, "rest": rest, "id": np.frombuffer(row["ids"], "<i8"),
            "n": np.frombuffer(row["counts"], "<i8")}


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, tile_rows: int = 4096, strip: int = 8) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                             F.col("embedding").cast("array<double>").alias("embedding"))
    good = vectors.where(usable() & F.col("vec_id").isNotNull())
    classes = stored(good.groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("n")), "vector-classes")
    d = classes.agg(F.max(F.size("embedding"))).first()[0]
    if d is None:
        empty = F.lit(0).cast("long").alias("n_links")
        return vectors.select("vec_id", empty, F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    axes = principal_axes(classes, d)
    width, m = float(np.sqrt(2 * (1 - threshold))), min(BOX, d)

    # tiles: cells of the two leading axes, as wide as the chord of the threshold, so that linked
    # vectors lie in the same or in touching cells; large cells are cut by hash
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                z = unit_rows(batch.column("embedding"), d)[1] @ axes[:, :2]
                cell = np.floor(z / max(width * (1 + 1e-9), 1e-3)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n"), batch.column("embedding"),
                                                  pa.array(cell[:, 0]), pa.array(cell[:, -1])], names=["id", "n", "embedding", "c1", "c2"])

    placed = stored(classes.mapInArrow(place, "id long, n long, embedding array<double>, c1 long, c2 long"), "vector-cells")
    size = placed.groupBy("c1", "c2").agg(F.count("*").alias("_c"))
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("_c") / tile_rows))
    tiled = (placed.join(size, ["c1", "c2"])
             .select("id", "n", "embedding", "c1", "c2", part.alias("part")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive by tile; a tile becomes one row (more where batches cut it)."""
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in ("c1", "c2", "part")], axis=1)
            cuts = [0, *(np.nonzero((key[1:] != key[:-1]).any(axis=1))[0] + 1), len(key)] if len(key) else [0]
            for s, e in zip(cuts[:-1], cuts[1:]):
                part = batch.slice(s, e - s)
                given, unit = unit_rows(part.column("embedding"), d)
                lead, ids = unit @ axes[:, :m], part.column("id").to_numpy()
                yield pa.RecordBatch.from_pydict({
                    "tile": [int(ids[0])], "c1": [int(key[s, 0])], "c2": [int(key[s, 1])],
                    "ids": [ids.astype("<i8").tobytes()], "given": [given.tobytes()],
                    "counts": [part.column("n").to_numpy().astype("<i8").tobytes()],
                    "lo": [lead.min(axis=0).tolist()], "hi": [lead.max(axis=0).tolist()]})

    tiles = stored(tiled.repartition("c1", "c2", "part").sortWithinPartitions("c1", "c2", "part").mapInArrow(
        pack, "tile long, c1 long, c2 long, ids binary, given binary, counts binary, lo array<double>, hi array<double>"),
        "vector-tiles")
    work = tile_pairs(tiles.select("tile", "c1", "c2", "lo", "hi"), width, strip)

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """By strip: its own tile comes first, then the tiles to compare it with."""
        key, own = None, None
        for batch in batches:
            for row in (r for k in range(batch.num_rows) for r in batch.slice(k, 1).to_pylist()):
                tile, alone = opened(row, axes), row["strip"] < 0
                if (row["owner"], row["strip"]) != key:
                    key, own = (row["owner"], row["strip"]), tile
                    if not alone:
                        continue
                yield from links_of(own, tile, threshold, alone)

    found = stored(work.join(tiles.select("tile", "ids", "given", "counts"), "tile")
                   .repartition("owner", "strip").sortWithinPartitions("owner", "strip", "turn")
                   .mapInArrow(linked, "id long, links long, peer long"), "vector-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("id").alias("u"), F.col("peer").alias("v")), "vector-components")
    result = (classes.join(links, "id", "left").join(parts.withColumnRenamed("node", "id"), "id", "left")
              .select(F.col("embedding").alias("_e"), F.col("id").alias("_id"), F.col("n").alias("_n"), "links", "component"))
    joined = vectors.join(result, (F.col("embedding") == F.col("_e")) & F.col("vec_id").isNotNull(), "left")
    component = F.coalesce("component", "_id", "vec_id")
    return joined.select("vec_id", F.coalesce(F.coalesce("links", F.lit(0)) + F.col("_n") - 1, F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def tile_pairs(boxes: DataFrame, width: float, strip: int) -> DataFrame:
    """(owner, strip, turn, tile): the tiles to send to each strip; the owner's own tile has turn 0.

    Tiles meet by an equal join on touching cells, and only ids and boxes are joined.
    Of a pair either tile may be the owner, by hash; strips bound what one task receives.
    """
    touching = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    a = boxes.select("tile", "lo", "hi", "c1", "c2", touching.alias("to")).select(
        "tile", "lo", "hi", (F.col("c1") + F.col("to.i")).alias("c1"), (F.col("c2") + F.col("to.j")).alias("c2"))
    b = boxes.select(F.col("tile").alias("other"), F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"), "c1", "c2")
    apart = F.zip_with(F.zip_with("lo", "hi_b", lambda p, q: p - q), F.zip_with("lo_b", "hi", lambda p, q: p - q),
                       lambda p, q: F.greatest(p, q, F.lit(0.0)))
    near = F.aggregate(apart, F.lit(0.0), lambda s, x: s + x * x) <= width * width * (1 + 1e-9)
    swap = F.xxhash64("tile", "other") % 2 == 0
    pairs = (a.join(b, ["c1", "c2"]).where((F.col("tile") < F.col("other")) & near)
             .select(F.when(swap, F.col("tile")).otherwise(F.col("other")).alias("owner"),
                     F.when(swap, F.col("other")).otherwise(F.col("tile")).alias("tile")))
    many = pairs.groupBy("owner").agg(F.ceil(F.count("*") / strip).alias("_s"))
    pairs = (pairs.join(many, "owner").select("owner", F.pmod(F.xxhash64("tile"), "_s").alias("strip"), F.lit(1).alias("turn"), "tile"))
    own = pairs.select("owner", "strip").distinct().select("owner", "strip", F.lit(0).alias("turn"), F.col("owner").alias("tile"))
    alone = boxes.select(F.col("tile").alias("owner"), F.lit(-1).cast("long").alias("strip"), F.lit(0).alias("turn"), "tile")
    return stored(pairs.unionByName(own).unionByName(alone), "tile-pairs")


def links_of(a: dict, b: dict, threshold: float, same: bool) -> Iterator[pa.RecordBatch]:
    """For each linked vector of the two tiles: linked vectors on the other side, and the smallest id it connects to here."""
    ids = a["id"] if same else np.concatenate([a["id"], b["id"]])
    shift, links = 0 if same else len(a["id"]), np.zeros(len(ids), np.int64)
    order = np.argsort(ids)
    rank = np.argsort(order)
    root = np.arange(len(ids))
    for i, j in compare(a, b, threshold, same):
        n = len(links)
        links += np.bincount(i, b["n"][j], n).astype(np.int64) + np.bincount(j + shift, a["n"][i], n).astype(np.int64)
        root = min_roots(np.concatenate([rank[i], np.arange(n)]), np.concatenate([rank[j + shift], root]), n)
    some = np.nonzero(links)[0]
    if len(some):
        yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(links[some]), pa.array(ids[order[root[rank[some]]]])],
                                         names=["id", "links", "peer"])
