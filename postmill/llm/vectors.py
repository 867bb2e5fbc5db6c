"""Approximate nearest neighbours by an adaptive dimension scan of inverted lists.

Vectors are brought to length 1 and rotated at random, so that a part of the coordinates tells about
the whole distance. They are dealt into lists by their nearest centroid (spherical k-means on a
bounded sample; every vector is indexed), and lists into parts of about ``PART``. A query probes its
nearest lists, PROBE_SHARE of all (vectors without clusters need that many for a recall of 0.9).
Within a list the coordinates are read in blocks of columns: after d of D columns a
candidate is given up if its partial distance, scaled by D / d, is above (1 + EPSILON / sqrt d)^2
times the best distance known, a test that a true neighbour fails with a small chance only. What is
left gets its cosine in double precision on the original vectors.

Equal vectors are indexed once, with their ``k + 1`` smallest ids: no other id of theirs can be
among the k nearest of any query. Equal queries are searched once.

Vectors of different lengths have no cosine, so each length is searched by itself: the commonest one, and
every one with ``LEAST_CANDIDATES`` distinct vectors, by lists of its own, the rest by comparing all.

Null, empty and zero vectors and those with null or non-finite components take no part. Repeated ids are
rows of their own, and a query is never its own neighbour. Ties go to the smaller id. Null ids take no
part. An empty table gives no rows; columns beside id and vector play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint
from .words import named

NEAREST = 5
QUERY_STEP = 50
SAMPLE_BYTES = 8 << 20
LIST_SIZE = 256
MOST_LISTS = 4096
PROBE_SHARE = 0.5
QUERIES_AT_ONCE = 256
LEAST_CANDIDATES = 2048
PART = 2048
COLUMNS = 16
EPSILON = 2.1
SEED = 11


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v, size) of the vectors that take part, as doubles."""
    v = F.col("embedding").cast("array<double>")
    good = F.size("v") > 0
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select("vec_id", v.alias("v")).where(F.col("v").isNotNull() & good & finite)
    return rows.where(F.exists("v", lambda x: x != 0)).withColumn("size", F.size("v"))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(-1, size)


def unit(v: np.ndarray) -> np.ndarray:
    largest = np.abs(v).max(axis=1, keepdims=True)  # first, against squares that overflow
    scaled = v / largest
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def rotation(size: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def centroids_of(sample: np.ndarray, lists: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means."""
    random = np.random.default_rng(SEED)
    lists = min(lists, len(sample))
    centre = sample[random.choice(len(sample), lists, replace=False)]
    for _ in range(rounds):
        own = nearest_lists(sample, centre, 1)[:, 0]
        total = np.zeros_like(centre)
        np.add.at(total, own, sample)
        length = np.sqrt((total * total).sum(axis=1, keepdims=True))
        centre = np.where(length > 1e-9, total / np.maximum(length, 1e-9), centre)
    return centre


def nearest_lists(x: np.ndarray, centre: np.ndarray, count: int) -> np.ndarray:
    """The numbers of each row's nearest centroids, nearest first."""
    out = np.empty((len(x), min(count, len(centre))), dtype=np.int64)
    for a in range(0, len(x), 1024):
        near = x[a : a + 1024] @ centre.T
        out[a : a + 1024] = np.argsort(-near, axis=1, kind="stable")[:, : out.shape[1]]
    return out


def _packed(size: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = named(batch, "v").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            ids = named(batch, "ids")
            yield pa.RecordBatch.from_arrays(
                [named(batch, "h1"), named(batch, "h2"), ids, named(batch, "asked"), pa.array([row.tobytes() for row in np.ascontiguousarray(v)], pa.binary())],
                names=["h1", "h2", "ids", "asked", "v"],
            )

    return pack


def _listed(model, size: int):
    """Append the list of each vector and its rotated form."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, centre = model.value
        for batch in batches:
            x = unit(matrix(named(batch, "v"), size)) @ turn if batch.num_rows else np.zeros((0, size))
            own = nearest_lists(x, centre, 1)[:, 0].astype(np.int32)
            rotated = x.astype(np.float32)
            columns = [named(batch, n) for n in ("h1", "h2", "ids", "asked", "v")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(own), pa.array([row.tobytes() for row in rotated], pa.binary())], names=["h1", "h2", "ids", "asked", "v", "list", "x"]
            )

    return deal


def _probes(model, sizes: dict[int, int], size: int, probes: int):
    """Each query once for every part of the lists it probes."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, centre = model.value
        held = np.array([sizes.get(k, 0) for k in range(len(centre))])
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.frombuffer(b"".join(named(batch, "x").to_pylist()), dtype=np.float32).reshape(-1, size)
            ranked = nearest_lists(x.astype(np.float64), centre, len(centre))
            enough = np.cumsum(held[ranked], axis=1) - held[ranked] < LEAST_CANDIDATES
            enough[:, :probes] = True
            row, at = np.nonzero(enough & (held[ranked] > 0))
            lists = ranked[row, at]
            parts = -(-held[lists] // PART)
            pick = np.repeat(np.arange(len(row)), parts)
            part = np.arange(len(pick)) - np.repeat(np.cumsum(parts) - parts, parts)
            own = batch.take(pa.array(row[pick]))
            yield pa.RecordBatch.from_arrays(
                [named(own, "h1"), named(own, "h2"), named(own, "v"), pa.array(lists[pick].astype(np.int32)), pa.array(part.astype(np.int32))],
                names=["q1", "q2", "v", "list", "part"],
            )

    return probe


def scan(q: np.ndarray, x: np.ndarray, keep: int, columns: int = COLUMNS) -> tuple[np.ndarray, np.ndarray]:
    """The (query, candidate) pairs that the tests leave, column block by column block."""
    size = q.shape[1]
    if len(x) <= keep:
        return tuple(np.indices((len(q), len(x))).reshape(2, -1))
    head, tail = q[:, :columns], x[:, :columns]
    partial = np.maximum((head * head).sum(1)[:, None] + (tail * tail).sum(1) - 2 * head @ tail.T, 0)
    # The candidates best by the first block give the distance to beat.
    first = np.argpartition(partial, keep - 1, axis=1)[:, :keep]
    gap = x[first] - q[:, None, :]
    best = (gap * gap).sum(axis=2).max(axis=1)
    for a in range(0, size, columns):
        b = min(size, a + columns)
        if a:
            gap = x[at, a:b] - q[row, a:b]
            left = left + (gap * gap).sum(axis=1)
        loose = (1 + EPSILON / np.sqrt(b)) ** 2 * b / size if b < size else 1 + 1e-4
        limit = best * loose + 1e-5
        if a:
            near = left <= limit[row]
            row, at, left = row[near], at[near], left[near]
        else:
            row, at = np.nonzero(partial <= limit[:, None])
            left = partial[row, at]
    return row, at


def _searched(model, size: int, keep: int):
    def search(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.float64()]
        names = ["q1", "q2", "least", "ids", "score"]
        parts = [pa.table([pa.array([], t) for t in kinds], names=names)]
        if queries.num_rows and vectors.num_rows:
            turn, _ = model.value
            x = np.frombuffer(b"".join(vectors.column("x").to_pylist()), dtype=np.float32).reshape(-1, size)
            own = unit(matrix(vectors.column("v"), size))
            ids = vectors.column("ids").combine_chunks()
            least = np.array([i[0] for i in ids.to_pylist()])
            for a in range(0, queries.num_rows, QUERIES_AT_ONCE):
                some = queries.slice(a, QUERIES_AT_ONCE)
                asked = unit(matrix(some.column("v"), size))
                row, at = scan((asked @ turn).astype(np.float32), x, keep)
                score = (own[at] * asked[row]).sum(axis=1)
                order = np.lexsort((least[at], -score, row))
                row, at, score = row[order], at[order], score[order]
                begin = np.searchsorted(row, np.arange(some.num_rows))
                top = np.arange(len(row)) - begin[row] < keep
                row, at = pa.array(row[top]), pa.array(at[top])
                columns = [some.column("q1").take(row), some.column("q2").take(row), pa.array(least).take(at), ids.take(at), pa.array(score[top])]
                parts.append(pa.table(columns, names=names))
        return pa.concat_tables(parts)

    return search


def _compared(keep: int):
    """The nearest of few vectors of one length, by comparing all."""

    def compare(table: pa.Table) -> pa.Table:
        v = np.array(table.column("v").to_pylist(), dtype=np.float64)
        ids, asked = pa.array(table.column("ids").to_pylist(), pa.list_(pa.int64())), np.asarray(table.column("asked").to_numpy(zero_copy_only=False), dtype=bool)
        least, x = np.array([i[0] for i in ids.to_pylist()]), unit(v)
        row = np.flatnonzero(asked)
        score = np.array([(x[r] * x).sum(axis=1) for r in row]).reshape(len(row), len(x))
        order = np.lexsort((np.broadcast_to(least, score.shape), -score), axis=1)[:, :keep]
        row, at = np.repeat(row, order.shape[1]), order.ravel()
        return pa.table(
            [table.column("h1").take(pa.array(row)), table.column("h2").take(pa.array(row)), pa.array(least[at]), ids.take(pa.array(at)), pa.array(np.take_along_axis(score, order, 1).ravel())],
            names=["q1", "q2", "least", "ids", "score"],
        )

    return compare


FOUND = "q1 long, q2 long, least long, ids array<long>, score double"


def _searched_lists(marked: DataFrame, size: int, k: int, share: float) -> DataFrame:
    """(q1, q2, least, ids, score) of distinct vectors of one length, from the lists that each query probes."""
    spark = marked.sparkSession
    packed = checkpoint(marked.mapInArrow(_packed(size), "h1 long, h2 long, ids array<long>, asked boolean, v binary"))
    count = packed.count()
    sampled = min(1.0, SAMPLE_BYTES / (8 * size * count))
    picked = packed.where(F.pmod("h1", F.lit(1_000_000)) < F.lit(int(1_000_000 * sampled) + 1)).orderBy("h1", "h2").select("v").collect()
    turn = rotation(size)
    sample = unit(np.frombuffer(b"".join(r.v for r in picked), dtype=np.float64).reshape(-1, size)) @ turn if picked else np.zeros((0, size))
    lists = int(min(MOST_LISTS, max(1, count // LIST_SIZE)))
    centre = centroids_of(sample, lists) if len(sample) else np.zeros((1, size))
    model = spark.sparkContext.broadcast((turn, centre))
    dealt = checkpoint(packed.mapInArrow(_listed(model, size), "h1 long, h2 long, ids array<long>, asked boolean, v binary, list int, x binary"))
    # At most MOST_LISTS rows.
    sizes = {r["list"]: r["count"] for r in dealt.groupBy("list").count().collect()}
    parts = spark.createDataFrame([(key, -(-n // PART)) for key, n in sizes.items()], "l int, parts int")
    held = dealt.join(F.broadcast(parts), F.col("list") == F.col("l"))
    held = held.select("list", F.pmod("h1", "parts").cast("int").alias("part"), "ids", "v", "x")
    queries = dealt.where("asked").mapInArrow(_probes(model, sizes, size, max(1, round(share * lists))), "q1 long, q2 long, v binary, list int, part int")
    return queries.groupBy("list", "part").cogroup(held.groupBy("list", "part")).applyInArrow(_searched(model, size, k + 1), FOUND)


def nearest(vectors: DataFrame, step: int = QUERY_STEP, k: int = NEAREST, share: float = PROBE_SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row whose id ``step`` divides."""
    spark = vectors.sparkSession
    rows = usable(vectors).where(F.col("vec_id").isNotNull())
    rows = rows.select("vec_id", "size", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(SEED), "v").alias("h2"))
    is_query = F.pmod("vec_id", F.lit(step)) == 0
    # The smallest ids of each distinct vector; the limit is applied before the shuffle as well.
    ordered = Window.partitionBy("h1", "h2").orderBy("vec_id")
    few = rows.withColumn("at", F.row_number().over(ordered)).where(F.col("at") <= k + 1)
    asked = rows.where(is_query).select(F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("vec_id").alias("query_id"))
    asked = checkpoint(asked)
    distinct = few.groupBy("h1", "h2").agg(F.first("size").alias("size"), F.first("v").alias("v"), F.array_sort(F.collect_list("vec_id")).alias("ids"))
    wanted = asked.select("a1", "a2").distinct().withColumn("asked", F.lit(True))
    marked = distinct.join(wanted, (F.col("h1") == F.col("a1")) & (F.col("h2") == F.col("a2")), "left")
    marked = checkpoint(marked.select("h1", "h2", "size", "ids", F.coalesce("asked", F.lit(False)).alias("asked"), "v"))

    lengths = marked.groupBy("size").count()
    # Lengths of many vectors; there are only so many that a table has room for.
    large = [r["size"] for r in lengths.where(F.col("count") >= LEAST_CANDIDATES).orderBy(F.desc("count"), F.desc("size")).collect()]
    large = large or [r["size"] for r in lengths.orderBy(F.desc("count"), F.desc("size")).limit(1).collect()]
    if not large:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = marked.where(~F.col("size").isin(large)).groupBy("size").applyInArrow(_compared(k + 1), FOUND)
    for size in large:
        found = found.union(_searched_lists(marked.where(F.col("size") == size), size, k, share))
    best = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "least")
    kept = found.withColumn("at", F.row_number().over(best)).where(F.col("at") <= k + 1).select("q1", "q2", "score", F.explode("ids").alias("vec_id"))
    by_id = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "vec_id")
    kept = kept.withColumn("at", F.row_number().over(by_id)).where(F.col("at") <= k + 1)
    answers = kept.groupBy("q1", "q2").agg(F.array_sort(F.collect_list(F.struct("at", "vec_id", "score"))).alias("found"))
    each = asked.join(answers, (F.col("a1") == F.col("q1")) & (F.col("a2") == F.col("q2")))
    others = F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")), 1, k)
    return each.select("query_id", F.posexplode(others).alias("pos", "f")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("f.vec_id").alias("vec_id"), F.col("f.score").alias("score")
    )


def op2(vectors: DataFrame) -> DataFrame:
    return nearest(vectors.select("vec_id", "embedding"))
