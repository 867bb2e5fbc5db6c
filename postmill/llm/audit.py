"""How five filters overlap, in every order that they can be applied in.

Duplicates are found by radix tries. Texts are range-partitioned by a prefix as short as the data
allow: prefixes that hold too many bytes are lengthened, round by round, until none does or the text
ends. Each partition inserts whole texts into a compressed trie, whose terminals hold the smallest id;
a walk over the terminals tells first texts from repeated ones. Before texts travel, a task
settles those that repeat a text of a smaller id in the same part of the input, so of a text that is on
a third of all rows each task sends a few copies.

The other four filters are judged row by row. What is left of a row is a mask of the filters it fails;
masks are counted by part and labels, and all orders are replayed on these counts.

Null texts are empty and equal to other empty ones. A null id is neither smaller nor larger than
another: its row is no duplicate and makes none. Rows equal in id and text are no duplicates of each
other. Null lang is the part with the empty name. Long texts are taken whole. Of several labels of a
document the largest counts; a document without a label or id has none. An empty table gives no rows.
Columns beside the named ones play no part.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, bounded_batches, stored, text_of
from .words import named, slices

FILTERS = "ABCDE"
FEWEST_WORDS = 100
DISTINCT_PERCENT = 80
CAPITAL_PERCENT = 10
MARKS = "[#$%&*|]"

FIRST_PREFIX = 16
LONGER = 4
PART_BYTES = 32 << 20
PER_PART = 4  # prefixes in a part, so that parts come out even
MOST_HEAVY = 200_000
SLICE = 8 << 20

JUDGED = "doc_id long, part string, fails string, text string"


def failing(text: Column) -> Column:
    """The letters of the filters that a text fails by itself."""
    found = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n_words, distinct = F.size(found), F.size(F.array_distinct(found))
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return F.concat(
        F.when(n_words < FEWEST_WORDS, "A").otherwise(""),
        F.when(100 * distinct.cast("long") < DISTINCT_PERCENT * n_words.cast("long"), "B").otherwise(""),
        F.when(100 * capitals.cast("long") > CAPITAL_PERCENT * F.length(text).cast("long"), "C").otherwise(""),
        F.when(text.rlike(MARKS), "D").otherwise(""),
    )


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop the text of a row that repeats one of a smaller id in this part of the input: it fails E.

    Texts are told apart by 128-bit digests here, 16 bytes for each distinct text of a task's input.
    """
    least: dict[bytes, int] = {}
    for batch in batches:
        ids, texts = named(batch, "doc_id").to_pylist(), named(batch, "text").to_pylist()
        fails = named(batch, "fails").to_pylist()
        for i, (doc_id, text) in enumerate(zip(ids, texts, strict=True)):
            if doc_id is None:
                texts[i] = None
                continue
            digest = hashlib.blake2b(text.encode(), digest_size=16).digest()
            known = least.setdefault(digest, doc_id)
            if known < doc_id:
                fails[i], texts[i] = fails[i] + "E", None
            else:
                least[digest] = doc_id
        columns = [named(batch, "doc_id"), named(batch, "part"), pa.array(fails, pa.string()), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "fails", "text"])


class Trie:
    """A compressed trie of byte strings. A node is [label, children by first byte, holder]."""

    def __init__(self) -> None:
        self.root: list = [b"", {}, None]

    def holder(self, text: bytes) -> list:
        """The holder at the terminal of ``text``: [smallest id, rows of that id by their columns]."""
        node, at, size = self.root, 0, len(text)
        while at < size:
            child = node[1].get(text[at])
            if child is None:
                node[1][text[at]] = child = [text[at:], {}, None]
                node, at = child, size
                break
            label = child[0]
            if text.startswith(label, at):
                node, at = child, at + len(label)
                continue
            same = _common(label, text, at)
            fork = [label[:same], {label[same]: child}, None]
            child[0] = label[same:]
            node[1][label[0]] = fork
            node, at = fork, at + same
        if node[2] is None:
            node[2] = [None, Counter()]
        return node[2]

    def terminals(self) -> Iterator[list]:
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node[2] is not None:
                yield node[2]
            stack.extend(node[1].values())


def _common(label: bytes, text: bytes, at: int) -> int:
    """How many bytes of ``label`` stand in ``text`` at ``at``; fewer than all of them. By halving."""
    low, high = 1, min(len(label), len(text) - at) + 1
    while high - low > 1:
        middle = (low + high) // 2
        if text.startswith(label[:middle], at):
            low = middle
        else:
            high = middle
    return low


def _tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, part, fails) of a partition's rows, now with E for all but the smallest id of a text."""
    trie = Trie()

    def rows(found: list[tuple]) -> pa.RecordBatch:
        kinds = (("doc_id", pa.int64()), ("part", pa.string()), ("fails", pa.string()))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], k) for i, (_, k) in enumerate(kinds)], names=[n for n, _ in kinds])

    for batch in batches:
        for some in slices(batch, "text", SLICE):
            out: list[tuple] = []
            columns = [named(some, c).to_pylist() for c in ("doc_id", "part", "fails", "text")]
            for doc_id, part, fails, text in zip(*columns, strict=True):
                holder = trie.holder(text.encode())
                if holder[0] is None or doc_id < holder[0]:
                    out += [(holder[0], p, f + "E") for (p, f), n in holder[1].items() for _ in range(n)]
                    holder[0], holder[1] = doc_id, Counter()
                if doc_id > holder[0]:
                    out.append((doc_id, part, fails + "E"))
                else:
                    holder[1][part, fails] += 1
            yield rows(out)
    out = []
    for least, held in trie.terminals():
        out += [(least, p, f) for (p, f), n in held.items() for _ in range(n)]
        if len(out) > 10_000:
            yield rows(out)
            out = []
    yield rows(out)


def adaptive_prefix(texts: DataFrame, bound: int, longest: int) -> Column:
    """The shortest of a row's prefixes that holds no more than ``bound`` bytes, or else its longest.

    Each round counts only the texts under prefixes that were too heavy; there are at most
    total / ``bound`` of them at each length.
    """
    size = F.octet_length("text")
    length, under = FIRST_PREFIX, texts
    prefix = F.left("text", F.lit(length))
    while length < longest:
        head = F.left("text", F.lit(length))
        heavy = [r["head"] for r in under.groupBy(head.alias("head")).agg(F.sum(size).alias("n")).where(F.col("n") > bound).collect()]
        if not heavy:
            break
        under = under.where(head.isin(heavy))
        length *= LONGER
        prefix = F.when(head.isin(heavy), F.left("text", F.lit(length))).otherwise(prefix)
    return prefix


def flagged(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, part, fails): for each row the letters of the filters that it fails."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), text_of().alias("text"))
    judged = stored(rows.select("doc_id", "part", failing(F.col("text")).alias("fails"), "text").mapInArrow(_settled, JUDGED))
    open_ = judged.where(F.col("text").isNotNull())
    seen = open_.agg(F.sum(F.octet_length("text")).alias("n"), F.max(F.length("text")).alias("longest")).first()
    size = seen["n"] or 0
    parts = max(int(judged.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // part_bytes))
    bound = max(size // (PER_PART * parts), size // MOST_HEAVY)
    prefix = adaptive_prefix(open_, bound, seen["longest"] or 0)
    dealt = open_.withColumn("prefix", prefix).repartitionByRange(parts, "prefix")
    tried = dealt.select("doc_id", "part", "fails", "text").mapInArrow(_tried, "doc_id long, part string, fails string")
    return judged.where(F.col("text").isNull()).select("doc_id", "part", "fails").union(tried)


def mask_counts(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, good, toxic, n): rows by mask and labels."""
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(
        F.max(F.when(F.col("quality") == 1, 1)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1)).alias("toxic")
    )
    named_rows = flags.where(F.col("doc_id").isNotNull()).join(known, F.col("doc_id") == F.col("labelled"), "left")
    nameless = flags.where(F.col("doc_id").isNull()).select("part", "fails", F.lit(None).cast("int").alias("good"), F.lit(None).cast("int").alias("toxic"))
    every = named_rows.select("part", "fails", "good", "toxic").union(nameless)
    return every.groupBy("part", "fails", F.col("good").isNotNull().alias("good"), F.col("toxic").isNotNull().alias("toxic")).agg(F.count(F.lit(1)).alias("n"))


def orders_replayed(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row for each part, order and step, with what the step's filter does there.

    ``counts`` has a bounded number of rows for each part; each is laid beside every order and step.
    """
    orders = F.array(*[F.lit("".join(p)) for p in permutations(filters)])
    by_order = counts.select("*", F.explode(orders).alias("filter_order"))
    by_step = by_order.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))).alias("step"))
    at = F.expr("substring(filter_order, step, 1)")
    fails = F.expr("contains(fails, substring(filter_order, step, 1))")
    gone = F.expr("translate(fails, left(filter_order, step - 1), '') <> fails")
    here = fails & ~gone
    total = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0)).alias
    steps = by_step.groupBy("part", "filter_order", "step").agg(
        total(~gone & ~fails)("kept"),
        total(here)("removed"),
        total(fails & gone)("redundant"),
        total(fails & (F.length("fails") == 1))("unique_fails"),
        total(here & F.col("good"))("good_lost"),
        total(here & F.col("toxic"))("toxic_lost"),
    )
    # One row of each order: as many as there are orders, in each group.
    of_filter = Window.partitionBy("part", at)
    return steps.withColumn("shapley", F.sum("removed").over(of_filter))


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return orders_replayed(mask_counts(flagged(docs), labels))


def op13(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audited(docs.select("doc_id", "text", "lang"), labels.select("doc_id", "quality", "toxic"))
