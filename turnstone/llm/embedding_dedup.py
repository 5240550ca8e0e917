"""Embedding near-dedup: all vectors are compared in PCA-ordered tiles, leading dimensions first."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstone.llm.components import components, roots
from turnstone.session import materialize, ship

COSINE = 0.95
#: Vectors of a tile at most.
TILE = 4096
#: Rows of a tile that are compared at once.
STRIP = 512
#: Share of a strip's pairs under which the survivors are gathered pair by pair.
SPARSE = 0.05
#: Room for rounding in the bounds; pairs kept by it are decided by the exact cosine.
SLACK = 1e-6


def usable(embedding: str) -> Column:
    """Vectors that can link: not null, every component finite, not all zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(embedding).isNotNull() & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def unit(block: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, first by their largest component, so that squares stay in range."""
    block = block / np.abs(block).max(1, keepdims=True)
    return block / np.sqrt(np.einsum("ij,ij->i", block, block))[:, None]


def principal_axes(vectors: DataFrame, size: int) -> np.ndarray:
    """An orthonormal basis, by falling variance: the eigenvectors of the summed products of components, which
    tasks and then a partial aggregation add up; the driver gets size ** 2 numbers."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            block = unit(batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size))
            total += block.T @ block
        cells = np.arange(size * size, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel())], ["cell", "value"])

    summed = vectors.select("embedding").mapInArrow(products, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    gram = np.zeros(size * size)
    for cell, value in summed.collect():
        gram[cell] = value
    return np.linalg.eigh(gram.reshape(size, size))[1][:, ::-1].copy()


def steps(size: int) -> list[int]:
    """Dimensions after which the bound is looked at."""
    out, k = [], max(1, size // 4)
    while k < size:
        out.append(k)
        k *= 2
    return [*out, size]


class Tile:
    """A tile's unit vectors along the principal axes, and their suffix norms after each step."""

    def __init__(self, blob: bytes, kind: str, size: int, axes: np.ndarray):
        self.unit = unit(np.frombuffer(blob, kind).astype(np.float64).reshape(-1, size))
        self.turned = np.ascontiguousarray(self.unit @ axes)
        squares = np.cumsum((self.turned**2)[:, ::-1], 1)[:, ::-1]
        self.rest = {k: np.sqrt(squares[:, k]) if k < size else np.zeros(len(squares)) for k in steps(size)}


def linked(a: Tile, b: Tile, same: bool, cosine: float = COSINE) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs (i, j) of two tiles with this cosine or more; i < j inside one tile.

    Products are accumulated over the leading dimensions; what the others can add is at most the product of the
    suffix norms. A pair is given up as soon as that can't reach the threshold, and decided in the end by the
    cosine of the vectors themselves.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    ends = steps(a.turned.shape[1])
    least = cosine - SLACK
    for top in range(0, len(a.turned), STRIP):
        left = slice(top, min(top + STRIP, len(a.turned)))
        sums = np.zeros((left.stop - top, len(b.turned)))
        at = 0
        for k in ends:
            sums += a.turned[left, at:k] @ b.turned[:, at:k].T
            at = k
            i, j = np.nonzero(sums + a.rest[k][left, None] * b.rest[k][None] >= least)
            if len(i) <= SPARSE * sums.size:
                break
        if same:
            upper = i + top < j
            i, j = i[upper], j[upper]
        part = sums[i, j]
        i = i + top
        for k in [k for k in ends if k > at]:
            part = part + np.einsum("ij,ij->i", a.turned[i, at:k], b.turned[j, at:k])
            alive = part + a.rest[k][i] * b.rest[k][j] >= least
            i, j, part, at = i[alive], j[alive], part[alive], k
        for cut in range(0, len(i), 1 << 16):
            p, q = i[cut : cut + (1 << 16)], j[cut : cut + (1 << 16)]
            sure = np.einsum("ij,ij->i", a.unit[p], b.unit[q]) >= cosine
            found.append((p[sure], q[sure]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _tiles(vectors: DataFrame, size: int, axes: np.ndarray, kind: str, tile: int) -> DataFrame:
    """Vectors in tiles, with the tile's bounds along the first axes.

    Slabs along the first axis are cut at its quantiles, and inside a slab vectors are ordered along the second,
    so that tiles are narrow along both. Range partitioning includes the vector's id: equal places don't pile up.
    """
    shown = min(size, 8)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            turned = unit(batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)) @ axes
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(turned[:, 0]), pa.array(turned[:, min(1, size - 1)])], [*batch.schema.names, "x", "y"])

    placed = vectors.select("rep", "h", "copies", "embedding").mapInArrow(project, T.StructType([*vectors.select("rep", "h", "copies", "embedding").schema, T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))
    placed = materialize(placed, "placed")
    n = placed.count()
    count = -(-n // tile)
    slabs = max(1, round(count**0.5))
    cuts = placed.agg(F.percentile_approx("x", [k / slabs for k in range(1, slabs)] or [0.5], 1000)).first()[0] if n else []
    slab = sum((F.when(F.col("x") > c, 1).otherwise(0) for c in (cuts if slabs > 1 else [])), F.lit(0))
    dealt = placed.withColumn("slab", slab).repartitionByRange(max(1, count), "slab", "y", "rep", "h").withColumn("part", F.spark_partition_id())

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(b.slice(i, tile) for b in batches for i in range(0, b.num_rows, tile)):
            block = np.ascontiguousarray(batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, size), kind)
            turned = (unit(block.astype(np.float64)) @ axes)[:, :shown]
            name = f"{batch.column(4)[0].as_py()}-{number}"
            lists = [batch.column(c).to_pylist() for c in range(3)]
            yield pa.RecordBatch.from_pylist(
                [{"tile": name, "reps": lists[0], "hs": lists[1], "copies": lists[2], "blob": block.tobytes(), "low": turned.min(0).tolist(), "high": turned.max(0).tolist()}],
                pa.schema([("tile", pa.string()), ("reps", pa.list_(pa.int64())), ("hs", pa.list_(pa.int64())), ("copies", pa.list_(pa.int64())), ("blob", pa.binary()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))]),
            )

    filled = dealt.select("rep", "h", "copies", "embedding", "part").mapInArrow(fill, "tile string, reps array<long>, hs array<long>, copies array<long>, blob binary, low array<double>, high array<double>")
    return materialize(filled, "tiles")


def _tile_pairs(tiles: DataFrame, cosine: float) -> DataFrame:
    """Tiles a <= b whose boxes are near enough for a link: unit vectors of that cosine are at most `reach` apart.

    Tiles meet by cells along the first two axes, as wide as the reach, so this is an equality join of small rows
    over as many keys as there are cells.
    """
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-6)
    width = max(reach, 0.05)

    def cells(room: int) -> Column:
        spans = [F.sequence(F.floor(F.get("low", F.lit(k)) / width) - room, F.floor(F.get("high", F.lit(k)) / width) + room) for k in (0, 1)]
        second = F.coalesce(spans[1], F.array(F.lit(0).cast("long")))  # vectors of one component have one axis
        return F.explode(F.flatten(F.transform(spans[0], lambda x: F.transform(second, lambda y: F.struct(x.alias("x"), y.alias("y"))))))

    boxes = tiles.select("tile", "low", "high")
    left = boxes.select(F.col("tile").alias("a"), F.col("low").alias("la"), F.col("high").alias("ha"), cells(0).alias("cell"))
    right = boxes.select(F.col("tile").alias("b"), F.col("low").alias("lb"), F.col("high").alias("hb"), cells(1).alias("cell"))
    gap = lambda z: F.pow(F.greatest(z["lb"] - z["ha"], z["la"] - z["hb"], F.lit(0.0)), 2)
    gaps = F.aggregate(F.transform(F.arrays_zip("la", "ha", "lb", "hb"), gap), F.lit(0.0), lambda s, x: s + x)
    return left.join(right, "cell").where(F.col("a") <= F.col("b")).where(gaps <= reach * reach).select("a", "b").distinct()


def _compare(tiles: DataFrame, size: int, axes: np.ndarray, kind: str, cosine: float) -> DataFrame:
    """rep, h, links (vectors on the other side) and root (a vector of the same component), by pair of tiles."""
    shared = tiles.sparkSession.sparkContext.broadcast(axes)
    side = lambda s: tiles.select(*[F.col(c).alias(c if c == s else f"{c}_{s}") for c in ("reps", "hs", "copies", "blob")], F.col("tile").alias(s))
    pairs = _tile_pairs(tiles, cosine).join(side("a"), "a").join(side("b"), "b")
    names = ["a", "b", *[f"{c}_{s}" for s in "ab" for c in ("reps", "hs", "copies", "blob")]]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(k)[r] for k, n in enumerate(names)}
                ids = {s: [np.array(row[f"{c}_{s}"].as_py(), np.int64) for c in ("reps", "hs", "copies")] for s in "ab"}
                same = row["a"].as_py() == row["b"].as_py()
                a = Tile(row["blob_a"].as_py(), kind, size, shared.value)
                b = a if same else Tile(row["blob_b"].as_py(), kind, size, shared.value)
                i, j = linked(a, b, same, cosine)
                if not len(i):
                    continue
                n = len(ids["a"][0])
                offset = 0 if same else n
                every = [x if same else np.concatenate((x, y)) for x, y in zip(ids["a"], ids["b"], strict=True)]
                j = j + offset
                links = np.bincount(i, every[2][j], len(every[0])) + np.bincount(j, every[2][i], len(every[0]))
                hit = np.flatnonzero(links)
                up = every[0][roots(len(every[0]), i, j)[hit]]
                yield pa.RecordBatch.from_arrays([pa.array(every[0][hit]), pa.array(every[1][hit]), pa.array(links[hit].astype(np.int64)), pa.array(up)], ["rep", "h", "links", "root"])

    return materialize(pairs.select(*names).mapInArrow(compare, "rep long, h long, links long, root long"), "links")


def link_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE, tile: int = TILE) -> DataFrame:
    """One row a vector: vec_id, n_links, component_id, kept.

    All pairs of vectors are compared, by tiles of PCA-ordered vectors (see linked); pairs of tiles whose boxes
    along the leading axes are too far apart are left out. Equal vectors are compared once. A pair of tiles gives
    one row a linked vector, its number of links and one connection, never the pairs themselves.
    n_links: other vectors with this cosine or more; component_id: the smallest id reachable by links; kept: that
    is the vector itself.

    Vectors that are null or zero, or hold null or non-finite components, and rows with a null id link with
    nothing, nor do vectors of different lengths; rows that repeat an id are one node; an empty table gives no rows;
    further columns are ignored.
    """
    ship(vectors.sparkSession)
    kind = "<f4" if vectors.schema[embedding].dataType.elementType == T.FloatType() else "<f8"
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
    good = rows.where(usable("embedding") & F.col("vec_id").isNotNull()).withColumn("h", F.xxhash64("embedding"))
    distinct = materialize(good.groupBy("h", "embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "vectors")
    found = None
    for (size,) in distinct.select(F.size("embedding")).distinct().orderBy(F.size("embedding")).collect():
        mine = distinct.where(F.size("embedding") == size)
        axes = principal_axes(mine, size)
        part = _compare(_tiles(mine, size, axes, kind, tile), size, axes, kind, cosine)
        found = part if found is None else found.union(part)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    labels = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "rep")
    counts = found.groupBy("rep", "h").agg(F.sum("links").alias("links"))
    known = distinct.select("rep", "h", "embedding", "copies").join(counts, ["rep", "h"], "left").join(labels, "rep", "left")
    known = known.select("h", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    linked_rows = good.join(known, ["h", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable("embedding") | F.col("vec_id").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = linked_rows.union(alone)
    return every.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


ORACLE_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
link AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id WHERE list_cosine_similarity(x.e, y.e) >= {COSINE}),
reach AS (SELECT vec_id AS node, vec_id AS other FROM v UNION SELECT node, b FROM reach JOIN link ON other = a),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, r.component_id, v.vec_id = r.component_id AS kept
FROM v LEFT JOIN n ON n.a = v.vec_id JOIN (SELECT node, min(other) AS component_id FROM reach GROUP BY node) r ON r.node = v.vec_id
"""
