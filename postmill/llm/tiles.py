"""Near-duplicate embeddings by comparing tiles in PCA order, exactly.

Equal vectors are one class. Classes of one length are turned by the principal axes of a bounded
sample, so that the leading coordinates hold most of a vector, and dealt into tiles: leaves of a tree
that halves the sample along the leading axes, cut by hash where they hold more than ``TILE``. A tile
knows the box of its leading coordinates. Two unit vectors of cosine t are sqrt(2 - 2t) apart, so a pair
of tiles whose boxes are further apart has no link and is not compared; pairs of tiles are found by a
join on cells of the leading axes, a cell as wide as that distance.

Within a pair of tiles products are summed over blocks of coordinates, leading ones first. What the
rest can add is at most the product of the lengths of the two suffixes. Pairs that so cannot reach the
threshold are given up, and what is left gets its cosine in double precision on the original vectors.
No pair is lost, whatever the sample. A pair of tiles gives no list of links but, for each of its
classes, the number of vectors linked there, and a forest of the links that has the same components.

Null, empty and zero vectors and those with null or non-finite components link with nothing; nor do
vectors of different lengths. Repeated ids are rows of their own. A null id is no id: its vector links,
and a component takes its smallest id, null if it has none. An empty table gives no rows. Labels and
other columns play no part. There are no ties: a link is a fact of two vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, stored
from .components import components
from .words import named

THRESHOLD = 0.9
TILE = 4096
SAMPLE_ROWS = 20_000
BOXED = 8  # leading axes that tiles are boxed on
CELLED = 2  # and those that pairs of tiles are joined on
COLUMNS = 8
PART = 1024  # rows compared at a time
SLACK = 1e-9
SEED = 13

CLASSES = "cid long, size int, tile long, least long, n long, v binary, lead array<double>"


def numbered(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): the vectors as doubles, null for those that can't link."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select("vec_id", v.alias("v"))
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    links = F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    return rows.select("vec_id", F.when(links, F.col("v")).alias("v"))


def unit(v: np.ndarray) -> np.ndarray:
    scaled = v / np.abs(v).max(axis=1, keepdims=True)  # first, against squares that overflow
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def principal_axes(sample: np.ndarray) -> np.ndarray:
    """An orthogonal matrix whose columns are the axes of largest squared length, largest first."""
    _, axes = np.linalg.eigh(sample.T @ sample)
    return axes[:, ::-1]


def split_points(x: np.ndarray, leaves: int) -> list[tuple[int, float]]:
    """Axis and value at each inner node of a tree over ``x``, in heap order; a power of two of leaves.

    A node is halved at the median of the leading axis along which it is widest.
    """
    nodes: list[tuple[int, float]] = []
    level = [x]
    while len(level) < leaves:
        below = []
        for rows in level:
            lead = rows[:, :BOXED]
            axis = int(np.argmax(lead.max(axis=0) - lead.min(axis=0))) if len(rows) else 0
            at = float(np.median(lead[:, axis])) if len(rows) else 0.0
            nodes.append((axis, at))
            below += [rows[rows[:, axis] < at], rows[rows[:, axis] >= at]] if len(rows) else [rows, rows]
        level = below
    return nodes


def leaf_of(x: np.ndarray, nodes: list[tuple[int, float]]) -> np.ndarray:
    place = np.zeros(len(x), dtype=np.int64)
    if nodes:
        axis, at = np.array([a for a, _ in nodes]), np.array([v for _, v in nodes])
        for _ in range((len(nodes) + 1).bit_length() - 1):
            place = 2 * place + 1 + (x[np.arange(len(x)), axis[place]] >= at[place])
    return place - len(nodes)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(-1, size)


def _turned(v: np.ndarray, axes: np.ndarray | None) -> np.ndarray:
    return unit(v) if axes is None else unit(v) @ axes


def _placed(model):
    """Deal classes to the leaves of their length's tree; lengths that the sample lacks have one leaf."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = named(batch, "size").to_numpy()
            for size in np.unique(sizes):
                some = batch.take(pa.array(np.flatnonzero(sizes == size)))
                v = np.ascontiguousarray(named(some, "v").flatten().to_numpy(zero_copy_only=False).reshape(-1, size))
                axes, nodes = model.value.get(int(size), (None, []))
                x = _turned(v, axes)
                lead = np.zeros((len(x), BOXED))
                lead[:, : min(BOXED, size)] = x[:, :BOXED]
                columns = [named(some, "cid"), named(some, "size"), pa.array(leaf_of(lead, nodes)), named(some, "least"), named(some, "n")]
                columns += [pa.array([row.tobytes() for row in v], pa.binary()), pa.array(list(lead), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["cid", "size", "tile", "least", "n", "v", "lead"])

    return place


def linked(x: np.ndarray, y: np.ndarray, threshold: float, columns: int = COLUMNS) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``x`` and ``y``, turned unit vectors, whose product can be the threshold or more.

    After each block of columns only those pairs go on that the suffixes' lengths leave a chance.
    """
    size, floor = x.shape[1], threshold - SLACK
    rest_x, rest_y = (np.sqrt(np.maximum(np.cumsum((z * z)[:, ::-1], axis=1)[:, ::-1], 0)) for z in (x, y))
    row, at = np.arange(len(x)), np.arange(len(y))
    total = np.zeros((len(x), len(y)))
    for a in range(0, size, columns):
        b = min(size, a + columns)
        total += x[row, a:b] @ y[at, a:b].T
        if b < size:
            alive = total + rest_x[row, b][:, None] * rest_y[at, b] >= floor
            # Whole rows and columns go while most pairs are dead; the rest is summed pair by pair.
            rows, cols = alive.any(axis=1), alive.any(axis=0)
            if np.count_nonzero(alive) * 16 < alive.size:
                i, j = np.nonzero(alive)
                return _pairwise(x, y, row[i], at[j], total[i, j], rest_x, rest_y, b, floor, columns)
            row, at, total = row[rows], at[cols], total[np.ix_(rows, cols)]
    i, j = np.nonzero(total >= floor)
    return row[i], at[j]


def _pairwise(x, y, i, j, total, rest_x, rest_y, a, floor, columns) -> tuple[np.ndarray, np.ndarray]:
    size = x.shape[1]
    while len(i) and a < size:
        b = min(size, a + columns)
        total = total + np.einsum("ij,ij->i", x[i, a:b], y[j, a:b])
        bound = total + rest_x[i, b] * rest_y[j, b] if b < size else total
        alive = bound >= floor
        i, j, total, a = i[alive], j[alive], total[alive], b
    return i, j


def cosines(v: np.ndarray, w: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """In double precision on the vectors as they are, scaled by their largest component."""
    out = np.empty(len(i))
    v, w = (z / np.abs(z).max(axis=1, keepdims=True) for z in (v, w))
    for a in range(0, len(i), 65_536):
        p, q = v[i[a : a + 65_536]], w[j[a : a + 65_536]]
        out[a : a + 65_536] = (p * q).sum(axis=1) / np.sqrt((p * p).sum(axis=1) * (q * q).sum(axis=1))
    return out


class Forest:
    """Union by smallest number; keeps the links that joined two trees."""

    def __init__(self, n: int) -> None:
        self.parent, self.kept = list(range(n)), []

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        """Links of many pairs; pairs already joined are sorted out by whole arrays first."""
        while len(i):
            label = np.array([self.root(k) for k in range(len(self.parent))])
            a, b = label[i], label[j]
            open_ = a != b
            if not open_.any():
                return
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            # One link for each tree suffices in a round, and halves the number of trees that have any.
            _, first = np.unique(a, return_index=True)
            for k in first:
                p, q = self.root(int(i[k])), self.root(int(j[k]))
                if p != q:
                    self.parent[max(p, q)] = min(p, q)
                    self.kept.append((int(i[k]), int(j[k])))


COMPARED = "cid long, links long, other long"


def _compared(model, threshold: float):
    """Two tiles, or one tile with itself: (cid, links, null) for degrees and (cid, null, other) for a forest."""

    def compare(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        size, same = key[0].as_py(), key[1].as_py() == key[2].as_py()
        axes, _ = model.value.get(size, (None, []))
        tiles = (left,) if same else (left, right)
        v = [_matrix(t.column("v"), size) for t in tiles]
        x = [_turned(m, axes) for m in v]
        cid = np.concatenate([t.column("cid").to_numpy() for t in tiles])
        n = np.concatenate([t.column("n").to_numpy() for t in tiles])
        second = 0 if same else len(v[0])
        degree, forest = np.zeros(len(cid), dtype=np.int64), Forest(len(cid))
        for a in range(0, len(v[0]), PART):
            for b in range(a if same else 0, len(v[-1]), PART):
                i, j = linked(x[0][a : a + PART], x[-1][b : b + PART], threshold)
                i, j = i + a, j + b
                if same:
                    i, j = i[i < j], j[i < j]
                for c in range(0, len(i), 1 << 20):
                    p, q = i[c : c + (1 << 20)], j[c : c + (1 << 20)]
                    near = cosines(v[0], v[-1], p, q) >= threshold
                    p, q = p[near], q[near] + second
                    degree += np.bincount(p, weights=n[q], minlength=len(cid)).astype(np.int64)
                    degree += np.bincount(q, weights=n[p], minlength=len(cid)).astype(np.int64)
                    forest.add(p, q)
        some = np.flatnonzero(degree)
        links = np.array(forest.kept, dtype=np.int64).reshape(-1, 2)
        none = lambda k: pa.nulls(k, pa.int64())
        return pa.table(
            [
                pa.array(np.concatenate((cid[some], cid[links[:, 0]]))),
                pa.concat_arrays([pa.array(degree[some]), none(len(links))]),
                pa.concat_arrays([none(len(some)), pa.array(cid[links[:, 1]])]),
            ],
            names=["cid", "links", "other"],
        )

    return compare


def tile_pairs(tiles: DataFrame, threshold: float) -> DataFrame:
    """(size, a, b), a <= b: pairs of tiles whose boxes are near enough, found by cells of the leading axes.

    Tiles have ``low`` and ``high`` on each leading axis. A tile lies in every cell that its box touches,
    and asks in the cells next to these as well.
    """
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6
    first, last = [[F.floor(F.element_at(c, k + 1) / reach) for k in range(CELLED)] for c in ("low", "high")]

    def celled(margin: int, *columns) -> DataFrame:
        out = tiles.select("size", *columns, *[F.sequence(first[k] - margin, last[k] + margin).alias(f"cells{k}") for k in range(CELLED)])
        for k in range(CELLED):
            out = out.withColumn(f"cell{k}", F.explode(f"cells{k}")).drop(f"cells{k}")
        return out

    box = [F.col("tile"), F.col("low"), F.col("high")]
    here = celled(0, *[c.alias(f"{name}_a") for c, name in zip(box, ("tile", "low", "high"), strict=True)])
    there = celled(1, *[c.alias(f"{name}_b") for c, name in zip(box, ("tile", "low", "high"), strict=True)])
    met = here.join(there, ["size", *[f"cell{k}" for k in range(CELLED)]]).where(F.col("tile_a") <= F.col("tile_b"))
    gap = lambda k: F.greatest(
        F.element_at("low_a", k) - F.element_at("high_b", k), F.element_at("low_b", k) - F.element_at("high_a", k), F.lit(0.0)
    )
    apart = sum((gap(k) * gap(k) for k in range(1, BOXED + 1)), F.lit(0.0))
    return met.where(apart <= reach * reach).select("size", F.col("tile_a").alias("a"), F.col("tile_b").alias("b")).distinct()


def duplicates(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row for each row of ``vectors``."""
    spark = vectors.sparkSession
    hashes = [F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(SEED), F.reverse("v")).alias("h2")]
    every = numbered(vectors)
    rows = every.where(F.col("v").isNotNull()).select("vec_id", "v", *hashes)
    grouped = rows.groupBy("h1", "h2").agg(F.first("v").alias("v"), F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"))
    # Numbers that stand once they are written.
    classes = stored(grouped.select("h1", "h2", "v", F.size("v").alias("size"), "least", "n").withColumn("cid", F.monotonically_increasing_id()))

    counts = {r["size"]: r["count"] for r in classes.groupBy("size").count().orderBy(F.desc("count"), "size").limit(SAMPLE_ROWS).collect()}
    per_million = max(1, min(1_000_000, 1_000_000 * SAMPLE_ROWS // max(1, sum(counts.values()))))
    sampled = classes.where(F.pmod("h1", F.lit(1_000_000)) < per_million).select("v").limit(2 * SAMPLE_ROWS).collect()
    by_size: dict[int, list] = {}
    for r in sampled:
        by_size.setdefault(len(r["v"]), []).append(r["v"])
    trees = {}
    for size, found in by_size.items():
        x = unit(np.array(found, dtype=np.float64))
        axes = principal_axes(x)
        lead = np.zeros((len(x), BOXED))
        lead[:, : min(BOXED, size)] = (x @ axes)[:, :BOXED]
        leaves = 1 << max(0, int(-(-counts.get(size, 1) // tile) - 1).bit_length())
        trees[size] = (axes, split_points(lead, min(leaves, 1 << max(0, len(found).bit_length() - 4))))
    model = spark.sparkContext.broadcast(trees)

    placed = stored(classes.select("cid", "size", "v", "least", "n").mapInArrow(_placed(model), CLASSES))
    leaf = placed.groupBy("size", "tile").agg(F.count(F.lit(1)).alias("held"))
    leaf = checkpoint(leaf.select(F.col("size").alias("s"), F.col("tile").alias("t"), F.ceil(F.col("held") / tile).alias("parts")))
    cut = placed.join(leaf, (F.col("size") == F.col("s")) & (F.col("tile") == F.col("t")))
    part = F.pmod(F.xxhash64("cid"), "parts")
    dealt = stored(cut.select("cid", "size", (F.shiftleft("tile", 32) + part).alias("tile"), "n", "v", "lead"))

    axis = lambda k: F.element_at("lead", k)
    boxes = dealt.groupBy("size", "tile").agg(
        *[F.min(axis(k)).alias(f"low{k}") for k in range(1, BOXED + 1)], *[F.max(axis(k)).alias(f"high{k}") for k in range(1, BOXED + 1)]
    )
    tiles = boxes.select("size", "tile", *[F.array(*[f"{end}{k}" for k in range(1, BOXED + 1)]).alias(end) for end in ("low", "high")])
    pairs = checkpoint(tile_pairs(checkpoint(tiles), threshold))

    def side(name: str) -> DataFrame:
        own = pairs.select(F.col("size").alias("size_"), "a", "b")
        return dealt.join(own, (F.col("size") == F.col("size_")) & (F.col("tile") == F.col(name))).select("size", "a", "b", "cid", "n", "v").toDF("size", "a", "b", "cid", "n", "v")

    both = side("a").groupBy("size", "a", "b").cogroup(side("b").where("a <> b").groupBy("size", "a", "b"))
    found = stored(both.applyInArrow(_compared(model, threshold), COMPARED))

    degree = found.where(F.col("links").isNotNull()).groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(found.where(F.col("other").isNotNull()).select(F.col("cid").alias("u"), F.col("other").alias("v")))
    own = classes.select("cid", "h1", "h2", "least", "n")
    rooted = checkpoint(
        own.join(roots.withColumnRenamed("id", "linked"), F.col("cid") == F.col("linked"), "left")
        .join(degree.withColumnRenamed("cid", "counted"), F.col("cid") == F.col("counted"), "left")
        .select("h1", "h2", "least", F.coalesce("root", "cid").alias("root"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    # Stored apart, so that a giant component's rows and its one id do not share an exchange.
    smallest = checkpoint(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    named_classes = checkpoint(rooted.join(smallest, "root").select("h1", "h2", "n_links", "component_id"))
    matched = rows.select("vec_id", "h1", "h2").join(named_classes, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = every.where(F.col("v").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return matched.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op12(vectors: DataFrame) -> DataFrame:
    return duplicates(vectors.select("vec_id", "embedding"))
