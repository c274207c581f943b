"""Near-duplicate embeddings by PCA-ordered tiled comparison.

Vectors are turned so that their first coordinates hold most of their length. For two of them the product of the
leading coordinates plus the product of the norms of what follows bounds the cosine from above; the bound of a whole tile of pairs
is one small matrix product. Pairs that cannot reach the threshold stop there, the others go on with more coordinates, and
the cosine itself decides. Tiles are ranges of the first coordinate: ranges too far apart for the threshold never meet.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected
from .runtime import lean, ship, stored

#: Vectors the axes are fitted on, chosen by hash. The axes change the speed only.
SAMPLE = 4096
#: Vectors of one side of a task, and of a tile in it.
SIDE, TILE = 8192, 1024
#: Leading coordinates looked at first and next.
FIRST, NEXT = 16, 32
#: Rounding allowance of the bounds, which are single precision.
MARGIN = 1e-4
#: Products this near the threshold are computed once more by one rule, whatever way they came about.
ROUNDING = 1e-9


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, sizes, units = [], [], []
        for v in batch.column(1):
            v = v.as_py()
            x = np.array(v, np.float64) + 0.0 if v and None not in v else np.zeros(0)
            top = np.abs(x).max() if len(x) else 0.0
            if len(x) and np.isfinite(x).all() and top > 0:
                keys.append(xxhash.xxh3_128_digest(x.tobytes()))
                sizes.append(len(x))
                x = x / top  # so that squares neither overflow nor vanish
                units.append((x / math.sqrt(x @ x)).tobytes())
            else:
                keys.append(None), sizes.append(None), units.append(None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(units, pa.binary())],
                                         names=["id", "key", "length", "unit"])


class Forest:
    """Union-find over the vectors of a task that keeps one link for each union."""

    def __init__(self, n: int):
        self.parent = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if (up == self.parent).all():
                return up
            self.parent = up

    def add(self, mask: np.ndarray, rows: slice, columns: slice) -> None:
        while True:
            root = self.roots()
            new = mask & (root[rows][:, None] != root[columns][None, :])
            some = np.flatnonzero(new.any(axis=1))
            if not len(some):
                return
            for i, j in zip(some.tolist(), new[some].argmax(axis=1).tolist(), strict=True):
                a, b = rows.start + i, columns.start + j
                x, y = a, b
                while self.parent[x] != x:
                    x = self.parent[x]
                while self.parent[y] != y:
                    y = self.parent[y]
                if x != y:
                    self.parent[max(x, y)] = min(x, y)
                    self.links.append((a, b))


def compare(x: np.ndarray, y: np.ndarray | None, axes: np.ndarray, wx: np.ndarray, wy: np.ndarray | None, threshold: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links between the unit vectors ``x`` and ``y``, or within ``x`` if ``y`` is None.

    Gives for each vector, those of y after those of x, the summed weights of its partners, and links that span the components.
    """
    one = y is None
    z = x if one else np.concatenate([x, y])
    weight = wx if one else np.concatenate([wx, wy])
    turned = z @ axes
    tail = np.sqrt(np.maximum(np.cumsum((turned ** 2)[:, ::-1], axis=1)[:, ::-1], 0))
    bound = [np.concatenate([turned[:, :k], tail[:, k:k + 1] if k < z.shape[1] else np.zeros((len(z), 1))], axis=1).astype(np.float32) for k in (FIRST, NEXT)]
    counts, forest = np.zeros(len(z), np.int64), Forest(len(z))
    for r in range(0, len(x), TILE):
        rows = slice(r, min(r + TILE, len(x)))
        for c in range(r if one else len(x), len(z), TILE):
            columns = slice(c, min(c + TILE, len(z)))
            near = bound[0][rows] @ bound[0][columns].T >= threshold - MARGIN
            n = np.count_nonzero(near)
            if not n:
                continue
            mask = np.zeros(near.shape, bool)
            if n > near.size // 16:  # one product of matrices is cheaper than many of vectors
                product = z[rows] @ z[columns].T
                mask = product >= threshold
                i, j = np.nonzero(np.abs(product - threshold) <= ROUNDING)
            else:
                i, j = np.nonzero(near)
                open_ = np.einsum("ij,ij->i", bound[1][rows][i], bound[1][columns][j]) >= threshold - MARGIN
                i, j = i[open_], j[open_]
            mask[i, j] = np.einsum("ij,ij->i", z[rows][i], z[columns][j]) >= threshold
            if one and r == c:
                np.fill_diagonal(mask, False)
            if mask.any():
                counts[rows] += mask @ weight[columns]
                if not (one and r == c):
                    counts[columns] += weight[rows] @ mask
                forest.add(mask, rows, columns)
    return counts, forest.links


def _axes(vectors: DataFrame, length: int) -> np.ndarray:
    """Orthonormal columns, those that hold most of a bounded sample's length first."""
    sample = vectors.orderBy(F.xxhash64("key")).limit(SAMPLE).select("unit").toArrow().column("unit")
    z = np.frombuffer(b"".join(x.as_py() for x in sample), np.float64).reshape(-1, length)
    return np.linalg.eigh(z.T @ z)[1][:, ::-1].copy()


def _links(nodes: DataFrame, length: int, threshold: float) -> DataFrame:
    """(node, links, peer): parts of each node's count, and links as peers."""
    spark = nodes.sparkSession
    nodes = nodes.where(F.col("length") == length)
    axes = _axes(nodes, length)
    first = axes[:, 0].copy()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = batch.column(2)
            z = np.frombuffer(b"".join(x.as_py() for x in units), np.float64).reshape(-1, length)
            place = z @ first
            # Equal places are told apart by far less than matters, so that none of the ranges can be of one place.
            jitter = np.array([xxhash.xxh3_64_intdigest(x.as_py()) for x in units], np.float64) / 2 ** 64 * 1e-9
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place + jitter)], names=["node", "weight", "unit", "place"])

    placed = stored(nodes.select("node", "weight", "unit").mapInArrow(lean(project), "node long, weight long, unit binary, place double"))
    n = placed.count()
    sides = max(1, -(-n // SIDE))
    cuts = placed.approxQuantile("place", [k / sides for k in range(1, sides)], 0.1 / sides) if sides > 1 else []
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6  # how far apart linked unit vectors can be
    low, high = [-math.inf, *cuts], [*cuts, math.inf]
    furthest = [max(j for j in range(i, sides) if low[j] - high[i] <= reach) for i in range(sides)]
    nearest = [min(i for i in range(j + 1) if furthest[i] >= j) for j in range(sides)]
    side = F.aggregate(F.array(*map(F.lit, cuts)) if cuts else F.array().cast("array<double>"), F.lit(0), lambda k, cut: k + F.when(F.col("place") > cut, 1).otherwise(0))
    placed = placed.withColumn("side", side)
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("side") + 1)
    one = placed.select("node", "weight", "unit", F.col("side").alias("i"), F.explode(F.sequence("side", pick(furthest))).alias("j"), F.lit(True).alias("is_x"))
    two = placed.select("node", "weight", "unit", F.explode(F.sequence(pick(nearest), "side")).alias("i"), F.col("side").alias("j"), F.lit(False).alias("is_x")).where("i < j")
    shared = spark.sparkContext.broadcast(axes)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        x, y = rows[rows.is_x], rows[~rows.is_x]
        matrix = lambda part: np.frombuffer(b"".join(part.unit), np.float64).reshape(-1, length)
        inner = rows.i.iloc[0] == rows.j.iloc[0]
        if not inner and (x.empty or y.empty):
            return pd.DataFrame({"node": [], "links": [], "peer": []})
        counts, links = compare(matrix(x), None if inner else matrix(y), shared.value, x.weight.to_numpy(), None if inner else y.weight.to_numpy(), threshold)
        node = np.concatenate([x.node.to_numpy(), y.node.to_numpy()])
        some = np.flatnonzero(counts)
        a, b = (np.array([link[k] for link in links], np.int64) for k in (0, 1))
        return pd.DataFrame({"node": np.concatenate([node[some], node[a]]), "links": np.concatenate([counts[some], np.zeros(len(a), np.int64)]),
                             "peer": pd.array([*[None] * len(some), *node[b].tolist()], "Int64")})

    return stored(one.union(two).groupBy("i", "j").applyInPandas(run, "node long, links long, peer long"))


def near_duplicates(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """Vectors with a cosine of at least ``threshold``, in double precision.

    Returns ``id_col``, ``n_links`` long (other rows linked directly), ``component_id`` (smallest id reachable by links, itself included) and
    ``kept`` boolean (its own component id). One row per input row. Null, empty and zero vectors and those with null or non-finite
    parts link with nothing and are kept. Equal rows link. Vectors of different lengths do not link. Other columns are ignored.

    Equal vectors are one node with a weight (a count combined in each task first). A task compares two ranges of SIDE vectors and
    returns counts and a spanning forest, never pairs. The work is that of all pairs of ranges within reach of each other.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    kind = rows.schema["id"].dataType.simpleString()
    rows = stored(rows.mapInArrow(lean(_unit), f"id {kind}, key binary, length int, unit binary").withColumn("row", F.monotonically_increasing_id()))
    nodes = rows.where("key is not null").groupBy("key", "length").agg(F.min("row").alias("node"), F.min("id").alias("low"), F.count("*").alias("weight"), F.first("unit").alias("unit"))
    nodes = stored(nodes)
    lengths = sorted(r.length for r in nodes.select("length").distinct().collect())  # each is compared on its own
    found = [_links(nodes, length, threshold) for length in lengths]
    if not found:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    parts = connected(links.where("peer is not null").select(F.col("node").alias("a"), F.col("peer").alias("b")))
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    placed = nodes.select("key", "node", "low", "weight").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node")).join(counts, "node", "left")
    placed = stored(placed.select("key", "component", "low", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    least = placed.groupBy("component").agg(F.min("low").alias("component_id"))
    result = rows.select("id", "key").join(placed.join(least, "component").select("key", "n_links", "component_id"), "key", "left")
    component = F.coalesce("component_id", "id")
    return result.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.col("id").eqNullSafe(component).alias("kept"))
