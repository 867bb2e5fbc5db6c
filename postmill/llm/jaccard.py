"""N-gram Jaccard join: near-duplicate documents through pivots and the triangle inequality.

A document is the set of its distinct five-word shingles; equal sets form one class, so copies are
never paired. The Jaccard distance is a metric. The join goes by regions around pivots:

1. Pivots. The signature of a set is its ``SIGNATURE`` smallest shingle hashes (all, if it has
   fewer). Signatures of linked sets share at least ``SHARED`` hashes: the smallest of the union are
   a random draw of which each lies in both sets with probability 0.75, and 192 draws give fewer
   with a chance below 1e-15; sets of up to 144 shingles share what the bound itself says. So of its
   signature, rarest first, each set needs to offer only the first ``size - shared + 1``: linked
   sets have one of these in common. The smallest class that has a hash is its pivot; a class joins
   the regions of the pivots of what it offers. A class near several pivots is replicated into each
   region, so every pair that can link meets in one, while a set far from all others is in none.
2. Regions. Distances to the pivot are computed. Members within 0.25 link to it and need no further
   pairing among themselves, as only components are asked for. Pairs whose distances to the pivot
   differ by more than 0.25 can't link. What isn't joined to the region's largest component becomes
   a pivot itself, again and again, until all are joined or compared: this finds every component.
3. Regions of more than ``REGION`` classes or ``REGION_BYTES`` of texts and shingles are split into parts that each
   hold the pivot. A second
   join compares what the parts left outside the largest component with rings of members by
   distance to the pivot, as far as the window of 0.25 reaches, block by block.

Null and empty texts have no shingles and link with nothing. A text of one to four words is one
shingle. Repeated rows fall into one class. Of documents that tie, those with an id come first, then the smallest
id, then a hash of the whole row. Texts of any length are compared whole, and a text longer than a part has one
almost to itself. An empty table gives no rows; columns of any name are carried along in one struct.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, bounded_batches, checkpoint, packed, tie_break
from .components import components
from .words import NOT_SPACE, Words, mixed, named, slices, words

GRAM = 5
PERCENT = 75
REGION = 2000
REGION_BYTES = 64 << 20
SIGNATURE = 192
SHARED = 93
BUCKETS, CLASS_BUCKETS = 256, 64  # at least; both follow the number of shuffle partitions
FACTORS = mixed(np.arange(11, 11 + GRAM, dtype=np.uint64)) | np.uint64(1)


def shingles(w: Words, gram: int = GRAM) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    sums = np.zeros(max(0, len(w.hash) - gram + 1), dtype=np.uint64)
    for j in range(gram):
        sums += w.hash[j : j + len(sums)] * FACTORS[j]
    whole = mixed(sums)
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= gram:
            found = np.sort(whole[a : b - gram + 1])
            yield found[np.concatenate(([True], found[1:] != found[:-1]))]
        elif b > a:
            yield mixed((w.hash[a:b] * FACTORS[: b - a]).sum(keepdims=True) + np.uint64(b - a))
        else:
            yield np.zeros(0, dtype=np.uint64)


def class_of(found: np.ndarray) -> int:
    """A number of the set."""
    return int(mixed(mixed(found ^ np.uint64(0x5851F42D4C957F2D)).sum(keepdims=True) + np.uint64(len(found))).view(np.int64)[0])


def _classified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Append ``n`` and ``class`` (null without shingles); drop the column ``_text``."""
    for batch in batches:
        for part in slices(batch, "_text"):
            sets = list(shingles(words(named(part, "_text"), NOT_SPACE)))
            sizes = pa.array([len(s) for s in sets], pa.int64())
            ids = pa.array([class_of(s) if len(s) else None for s in sets], pa.int64())
            kept = [(f, part.column(i)) for i, f in enumerate(part.schema) if f.name != "_text"]
            fields = [f for f, _ in kept] + [pa.field("n", pa.int64()), pa.field("class", pa.int64())]
            yield pa.RecordBatch.from_arrays([c for _, c in kept] + [sizes, ids], schema=pa.schema(fields))


def classified(rows: DataFrame) -> DataFrame:
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "_text")
    return rows.mapInArrow(_classified, f"{kept}, n long, class long")


def _distinct_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, np.ndarray]]]:
    """For each slice of texts its distinct sets with their classes."""
    for batch in batches:
        for part in slices(batch, "_text"):
            sets = (s for s in shingles(words(named(part, "_text"), NOT_SPACE)) if len(s))
            yield list({class_of(s): s for s in sets}.items())


def offered(size: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """How many hashes of a signature of this size, rarest first, a linked set shares one of."""
    whole = (percent * size + 99) // 100
    # Up to this size the union of two linked sets fits a signature, so nothing is left to chance.
    return size - np.where(100 * size <= percent * SIGNATURE, whole, np.minimum(whole, SHARED)) + 1


def _blobs(buckets: np.ndarray, count: int, names: list[str], columns: list[np.ndarray]) -> pa.RecordBatch:
    """One row a bucket with its part of each column as bytes."""
    order = np.argsort(buckets, kind="stable")
    ends = np.searchsorted(buckets[order], np.arange(count + 1))
    full = np.flatnonzero(np.diff(ends))
    parts = [pa.array([column[order[ends[b] : ends[b + 1]]].tobytes() for b in full], pa.binary()) for column in columns]
    return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *parts], names=["bucket", *names])


def _postings(buckets: int):
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sets in _distinct_sets(batches):
            if sets:
                keys = [s[:SIGNATURE] for _, s in sets]
                sizes = np.array([len(k) for k in keys])
                tokens = np.concatenate(keys)
                owners = np.repeat(np.array([c for c, _ in sets], dtype=np.int64), sizes)
                bucket = (mixed(tokens) % np.uint64(buckets)).astype(np.int64)
                yield _blobs(bucket, buckets, ["tokens", "owners", "sizes"], [tokens, owners, np.repeat(sizes, sizes).astype(np.uint8)])

    return post


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind)


def _pivots(buckets: int):
    """For each hash that two classes or more have: its pivot and how many have it, sent to each of them."""

    def pivots(table: pa.Table) -> pa.Table:
        tokens, owners = _joined(table.column("tokens"), np.uint64), _joined(table.column("owners"), np.int64)
        sizes = _joined(table.column("sizes"), np.uint8)
        order = np.lexsort((owners, tokens))
        tokens, owners, sizes = tokens[order], owners[order], sizes[order]
        fresh = np.concatenate(([True], (tokens[1:] != tokens[:-1]) | (owners[1:] != owners[:-1])))
        tokens, owners, sizes = tokens[fresh], owners[fresh], sizes[fresh]
        begin = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
        count = np.diff(np.append(begin, len(tokens)))
        pivot, have = np.repeat(owners[begin], count), np.repeat(count, count)
        many = have > 1
        owners = owners[many]
        bucket = (mixed(owners.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        columns = [owners, tokens[many], have[many].astype(np.uint32), pivot[many], sizes[many]]
        return pa.Table.from_batches([_blobs(bucket, buckets, ["owners", "tokens", "have", "pivots", "sizes"], columns)])

    return pivots


def _placed(table: pa.Table) -> pa.Table:
    """(pivot, class): the regions of what each class offers; hashes that it has alone come first."""
    kinds = {"owners": np.int64, "tokens": np.uint64, "have": np.uint32, "pivots": np.int64, "sizes": np.uint8}
    owners, tokens, have, pivots, sizes = (_joined(table.column(name), kind) for name, kind in kinds.items())
    order = np.lexsort((tokens, have, owners))
    owners, pivots, sizes = owners[order], pivots[order], sizes[order].astype(np.int64)
    begin = np.flatnonzero(np.concatenate(([True], owners[1:] != owners[:-1])))
    count = np.diff(np.append(begin, len(owners)))
    rank = np.arange(len(owners)) - np.repeat(begin, count)
    alone = sizes - np.repeat(count, count)
    kept = (alone + rank < offered(sizes)) & (pivots != owners)
    pairs = np.unique(np.stack([pivots[kept], owners[kept]], axis=1), axis=0)
    return pa.table({"pivot": pa.array(pairs[:, 0], pa.int64()), "class": pa.array(pairs[:, 1], pa.int64())})


class Region:
    """Sets in memory with an index from shingle to sets, and a forest of what is linked."""

    def __init__(self, sets: list[np.ndarray], percent: int = PERCENT):
        self.sets, self.percent = sets, percent
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        shingle = np.concatenate(sets)
        order = np.argsort(shingle, kind="stable")
        self.shingle, self.owner = shingle[order], np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.group = np.arange(len(sets))

    def overlaps(self, found: np.ndarray) -> np.ndarray:
        lo, hi = np.searchsorted(self.shingle, found, "left"), np.searchsorted(self.shingle, found, "right")
        width = hi - lo
        at = np.repeat(lo - np.concatenate(([0], np.cumsum(width)[:-1])), width) + np.arange(width.sum())
        return np.bincount(self.owner[at], minlength=len(self.sets))

    def compare(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which sets link with ``found``, and the distances to it."""
        shared = self.overlaps(found)
        union = self.sizes + len(found) - shared
        return 100 * shared >= self.percent * union, 1 - shared / union

    def join(self, members: np.ndarray) -> None:
        groups = np.unique(self.group[members])
        if len(groups) > 1:
            self.group[np.isin(self.group, groups)] = groups[0]

    def connect(self, first: int) -> np.ndarray:
        """Join all that links, starting from the pivot ``first``; gives the distances to it."""
        slack = 1 - self.percent / 100 + 1e-9
        linked, distance = self.compare(self.sets[first])
        self.join(np.flatnonzero(linked))
        compared = np.zeros(len(self.sets), dtype=bool)
        compared[first] = True
        while True:
            largest = np.bincount(self.group).argmax()
            open_ = np.flatnonzero((self.group != largest) & ~compared)
            if not len(open_):
                return distance
            pivot = open_[0]
            linked, _ = self.compare(self.sets[pivot])
            self.join(np.flatnonzero(linked & (np.abs(distance - distance[pivot]) <= slack)))
            compared[pivot] = True


def _sets_of(table: pa.Table) -> tuple[list[int], list[np.ndarray], np.ndarray]:
    """Distinct classes, their sets, and the row that each comes from."""
    texts = table.column("_text").combine_chunks()
    texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
    classes = np.array(table.column("class").to_pylist(), dtype=np.int64)
    ids, rows = np.unique(classes, return_index=True)
    sets: list[np.ndarray] = []
    batch = pa.RecordBatch.from_arrays([texts.take(pa.array(rows))], names=["_text"])
    for part in slices(batch, "_text"):
        sets.extend(shingles(words(named(part, "_text"), NOT_SPACE)))
    return ids.tolist(), sets, rows


def _within(table: pa.Table) -> pa.Table:
    """Of one part of a region: for each class its group's first class and its distance to the pivot."""
    ids, sets, _ = _sets_of(table)
    region = Region(sets)
    pivot = table.column("pivot")[0].as_py()
    distance = region.connect(ids.index(pivot))
    roots = np.array(ids, dtype=np.int64)[region.group]
    n = len(ids)
    return pa.table(
        {
            "pivot": pa.array([pivot] * n, pa.int64()),
            "class": pa.array(ids, pa.int64()),
            "root": pa.array(roots),
            "distance": pa.array(distance, pa.float64()),
            "parts": table.column("parts").slice(0, 1).combine_chunks().take(pa.array([0] * n, pa.int64())),
        }
    )


def _across(table: pa.Table) -> pa.Table:
    """Links between what was left over and the members of one ring."""
    ids, sets, rows = _sets_of(table)
    left = np.array([bool(x) for x in table.column("left_over").to_pylist()])
    leftover = {c for c, keep in zip(table.column("class").to_pylist(), left.tolist(), strict=True) if keep}
    region = Region(sets)
    for i, c in enumerate(ids):
        if c in leftover:
            region.join(np.flatnonzero(region.compare(sets[i])[0]))
    roots = np.array(ids, dtype=np.int64)[region.group]
    return pa.table({"u": pa.array(ids, pa.int64()), "v": pa.array(roots)})


def _chosen(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rows`` (with doc_id and tie) that ``wanted`` names as ``rep``, with its columns."""
    asked = wanted.withColumn("r_doc", F.col("rep.doc_id")).withColumn("r_tie", F.col("rep.tie")).drop("rep")
    return rows.join(asked, F.equal_null("doc_id", "r_doc") & (F.col("tie") == F.col("r_tie"))).drop("r_doc", "r_tie")


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (class, rep, ..) with the text of the row that stands for the class."""
    rows = docs.select("doc_id", tie_break(docs).alias("tie"), F.col("text").alias("_text"))
    return _chosen(rows, wanted).drop("doc_id", "tie")


def class_links(docs: DataFrame, classes: DataFrame, region: int = REGION, size: int = REGION_BYTES) -> DataFrame:
    """Links (u, v) of classes whose components are those of all linked pairs.

    ``classes`` holds each class with its ``weight`` in bytes and ``rep``, the doc_id and tie of the row that stands for it.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets, class_buckets = max(BUCKETS, 2 * partitions), max(CLASS_BUCKETS, partitions // 2)
    postings = docs.select(F.col("text").alias("_text")).mapInArrow(_postings(buckets), "bucket int, tokens binary, owners binary, sizes binary")
    shared = postings.groupBy("bucket").applyInArrow(
        _pivots(class_buckets), "bucket int, owners binary, tokens binary, have binary, pivots binary, sizes binary"
    )
    # A class lies in one bucket, so its regions are distinct.
    pairs = checkpoint(shared.groupBy("bucket").applyInArrow(_placed, "pivot long, class long"))
    weights = classes.select(F.col("class").alias("w_class"), "weight")
    weighed = pairs.join(weights, F.col("class") == F.col("w_class"))
    needed = F.greatest(F.ceil((F.count("*") + 1) / region), F.ceil(F.sum("weight") / size))
    parts = checkpoint(weighed.groupBy("pivot").agg(needed.cast("int").alias("parts")))
    members = pairs.join(parts, "pivot").select("pivot", "class", "parts", F.array(F.pmod(F.xxhash64("class"), "parts").cast("int")).alias("part"))
    pivots = parts.select("pivot", F.col("pivot").alias("class"), "parts", F.sequence(F.lit(0), F.col("parts") - 1).alias("part"))
    placed = members.union(pivots).select("pivot", "class", "parts", F.explode("part").alias("part"))
    classes = classes.drop("weight")
    rows = _texts_of(docs, placed.join(classes, "class")).select("pivot", "part", "parts", "class", "_text")
    inside = checkpoint(rows.groupBy("pivot", "part").applyInArrow(_within, "pivot long, class long, root long, distance double, parts int"))
    links = inside.select(F.col("class").alias("u"), F.col("root").alias("v")).where("u != v").distinct()

    if parts.where("parts > 1").isEmpty():
        return links
    # Regions in several parts: members and what their largest component lacks meet again, ring by ring.
    known = checkpoint(components(links))
    width = 1 - PERCENT / 100
    # By pivot and class, not joined on the pivot before, or a hot region would stay in one task.
    held = inside.where("parts > 1").groupBy("pivot", "class").agg(F.min("distance").alias("distance"))
    held = held.join(known, F.col("class") == F.col("id"), "left").select("pivot", "class", "distance", F.coalesce("root", "class").alias("root"))
    held = held.join(weights, F.col("class") == F.col("w_class")).drop("w_class")
    sizes = held.groupBy("pivot", "root").agg(F.count("*").alias("n"), F.sum("weight").alias("bytes"))
    largest = sizes.groupBy("pivot").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.sum("n").alias("total"), F.sum("bytes").alias("bytes"))
    ring = F.least(F.floor(F.col("distance") / width), F.lit(int(1 / width))).cast("int")
    held = checkpoint(
        held.join(largest, "pivot")
        .withColumn("left_over", F.col("root") != F.col("main"))
        .withColumn("ring", ring)
        .withColumn("cells", F.greatest(F.ceil(2 * F.col("total") / region), F.ceil(2 * F.col("bytes") / size)).cast("int"))
    )
    cell = F.pmod(F.xxhash64("class"), "cells").cast("int")
    cells = F.sequence(F.lit(0), F.col("cells") - 1)
    # (cell of the left over) x (cell of the members), within neighbouring rings
    lost = held.where("left_over").select(
        "pivot", "class", F.lit(True).alias("left_over"), cell.alias("cell_1"),
        F.explode(F.array(F.col("ring") - 1, F.col("ring"), F.col("ring") + 1)).alias("ring"), F.col("cells"),
    ).withColumn("cell_2", F.explode(cells)).drop("cells")
    block = ["pivot", "ring", "cell_1", "cell_2"]
    wanted = lost.select(*block).distinct()
    others = held.select("pivot", "class", F.lit(False).alias("left_over"), "ring", cell.alias("cell_2")).join(wanted, ["pivot", "ring", "cell_2"])
    blocks = lost.select(*block, "class", "left_over").union(others.select(*block, "class", "left_over"))
    # A member that is left over itself keeps that mark within its block.
    blocks = blocks.groupBy(*block, "class").agg(F.max("left_over").alias("left_over"))
    rows = _texts_of(docs, blocks.join(classes, "class"))
    more = rows.groupBy(*block).applyInArrow(_across, "u long, v long").where("u != v").distinct()
    return links.union(checkpoint(more))


def _ids(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, bytes, n, class), written once."""
    rows = docs.select("doc_id", tie_break(docs).alias("tie"), F.octet_length("text").alias("bytes"), F.col("text").alias("_text"))
    return checkpoint(classified(rows))


def grouped(docs: DataFrame, region: int = REGION, size: int = REGION_BYTES) -> tuple[DataFrame, DataFrame]:
    """The ids of all documents, and for each class its component's first document: (c, root, rep)."""
    bounded_batches(docs.sparkSession)
    ids = _ids(docs)
    full = ids.where(F.col("n") > 0)
    # A row without an id stands for others only where none has one.
    ranked = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "tie")
    classes = full.groupBy("class").agg(F.min(ranked).alias("least"), F.max(F.col("bytes") + 8 * F.col("n")).alias("weight"))
    classes = checkpoint(classes.select("class", F.struct("least.doc_id", "least.tie").alias("rep"), "least", "weight"))
    links = class_links(docs, classes.select("class", "rep", "weight"), region, size)
    roots = components(links)
    labelled = checkpoint(classes.join(roots, F.col("class") == F.col("id"), "left").select("class", "least", F.coalesce("root", "class").alias("root")))
    # Stored apart, so that the classes of a giant component do not have to meet its one row in one task.
    first = checkpoint(labelled.groupBy("root").agg(F.min("least").alias("m")).select(F.col("root").alias("r"), F.struct("m.doc_id", "m.tie").alias("rep")))
    return ids, checkpoint(labelled.select("class", "root").join(first, F.col("root") == F.col("r")).select(F.col("class").alias("c"), "root", "rep"))


def near_duplicates(docs: DataFrame, region: int = REGION, size: int = REGION_BYTES) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    ids, groups = grouped(docs, region, size)
    full = ids.where(F.col("n") > 0).join(groups, F.col("class") == F.col("c"))
    found = full.select("doc_id", F.col("n").alias("n_shingles"), F.col("rep.doc_id").alias("component_id"))
    alone = ids.where(F.col("n") == 0).select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return found.union(alone)


def deduplicated(docs: DataFrame, region: int = REGION, size: int = REGION_BYTES) -> DataFrame:
    """One document of each component, that of the smallest id; documents without words all stay."""
    ids, groups = grouped(docs, region, size)
    first = groups.select("rep").union(ids.where(F.col("n") == 0).select(F.struct("doc_id", "tie").alias("rep"))).distinct()
    rows = docs.select(packed(docs).alias("row"), "doc_id", tie_break(docs).alias("tie"), (F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)) > 0).alias("full"))
    kept = _chosen(rows, first)
    # Rows that are equal in all columns are named together; one of them stays.
    one = kept.where("full").dropDuplicates(["doc_id", "tie"]).select("row").union(kept.where(~F.col("full")).select("row"))
    return one.select(*[F.col(f"row.`{name}`").alias(name) for name in docs.columns])


def op9(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs.select("doc_id", "text"))
