"""Benchmark decontamination by training suffix arrays.

Each shard of the training texts gets a suffix array over its words: every place whose word the
benchmark knows at all (no other can begin a match), sorted by the words that follow. Every suffix of
every benchmark item, down to its last word, is looked up in it by binary search. Windows, the suffixes
of ten words and more and whole shorter items, so find all their verbatim occurrences; a document word
inside any of them is hit. The neighbours of a place among the looked-up suffixes give the longest
match there of up to ten words, and windows found at consecutive places give the longer ones.

The benchmark is not bounded, so it is taken in blocks of about ``BLOCK_BYTES`` of distinct texts;
equal items are searched once. Each block is one pass over the texts, whose hits are carried along as
bits. After ``BLOCKS_HELD`` blocks the rows are stored and the blocks released. Documents are never
shuffled, and texts of any length are read whole, one shard for each that is longer than a shard.

Null and empty texts have no words and no hits, and so do all texts if the benchmark is empty; an empty
table gives no rows. Repeated items count by their id; items without an id hit words, but are not named.
Repeated documents are judged each. Of equally long longest matches the first of the text counts, and of
items that hold it any one, null where it has no id. Clashing column names are out of reach in the packed
row. Words are runs of ASCII letters and digits and of all other characters beyond ASCII; A-Z count as a-z.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, checkpoint, packed, stored, text_of
from .words import ALPHANUMERIC, named, slices, text_in, words

WINDOW = 10
BLOCK_BYTES = 4 << 20
BLOCKS_HELD = 8
STATE = "n_words long, hits binary, items array<string>, longest long, longest_at long, longest_item string"

Item = tuple[list[str], str]


class Index(NamedTuple):
    """The distinct suffixes of a block of items, in order, by their first ten words.

    Words are ranks in the vocabulary, 0 after the end. ``places[first[s]:first[s + 1]]`` are the places of
    suffix s in the items, ``owner`` the item of each of these, ``window`` the length of the window that the
    suffix is, 0 if it is none, and ``begins`` the place where each item begins.
    """

    vocabulary: np.ndarray
    suffixes: np.ndarray
    first: np.ndarray
    places: np.ndarray
    owner: np.ndarray
    window: np.ndarray
    begins: np.ndarray
    names: list[list[str]]

    def owners(self, suffix: int) -> np.ndarray:
        return self.owner[self.first[suffix] : self.first[suffix + 1]]


def pairs_of(ranks: np.ndarray) -> np.ndarray:
    """Ranks below 2^32, two to a number."""
    return (ranks[:, 0::2].astype(np.uint64) << np.uint64(32)) | ranks[:, 1::2].astype(np.uint64)


def suffix_array(ranks: np.ndarray) -> np.ndarray:
    """All places of words but 0, ordered by the words up to the next 0, of which WINDOW count at least.

    By doubling: places named by d words each are ordered by two such names.
    """
    places = np.flatnonzero(ranks)
    name, depth, order = ranks.astype(np.int64), 1, np.zeros(0, np.int64)
    while depth < WINDOW:
        follows = np.zeros_like(name)
        follows[:-depth] = name[depth:]
        key = (name * (int(name.max(initial=0)) + 1) + follows)[places]
        order = np.argsort(key)
        key = key[order]
        name = np.zeros_like(name)
        name[places[order]] = np.cumsum(np.concatenate(([True], key[1:] != key[:-1]))[: len(key)])
        depth *= 2
    return places[order]


def following(ranks: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The WINDOW words from each place, 0 from the first 0 on; ``ranks`` ends with WINDOW zeros."""
    table = np.empty((len(places), WINDOW), dtype=np.int32)
    open_ = np.ones(len(places), bool)
    for column in range(WINDOW):
        word = ranks[places + column]
        open_ &= word > 0
        table[:, column] = np.where(open_, word, 0)
    return table


def index_of(items: list[Item]) -> Index:
    w = words(pa.array([text for _, text in items], pa.string()), ALPHANUMERIC)
    vocabulary, rank = np.unique(w.hash, return_inverse=True)
    # WINDOW zeros after each item keep matches of neighbours apart.
    at = np.arange(len(w.hash)) + w.doc() * WINDOW
    ranks = np.zeros(len(w.hash) + (len(items) + 1) * WINDOW, dtype=np.int64)
    ranks[at] = rank + 1
    places = suffix_array(ranks)
    table = following(ranks, places)
    new = np.concatenate(([True], (table[1:] != table[:-1]).any(axis=1)))[: len(places)]
    first = np.flatnonzero(new)
    begins = w.first[:-1] + np.arange(len(items)) * WINDOW
    owner = np.searchsorted(begins, places, "right") - 1
    length = (table > 0).sum(axis=1)
    window = np.where((length == WINDOW) | (begins[owner] == places), length, 0)
    window = np.maximum.reduceat(window, first) if len(first) else window
    return Index(vocabulary, table[first], np.append(first, len(places)), places, owner, window, begins, [names for names, _ in items])


def _bound(columns: list[np.ndarray], wanted: list[np.ndarray], after: bool) -> np.ndarray:
    """For each wanted row the first place of the sorted rows that is not below it (or is above it)."""
    lo = np.searchsorted(columns[0], wanted[0], "left")
    hi = np.searchsorted(columns[0], wanted[0], "right")
    while (open_ := np.flatnonzero(lo < hi)).size:
        middle = (lo[open_] + hi[open_]) // 2
        below, equal = np.zeros(len(open_), bool), np.ones(len(open_), bool)
        for column, value in zip(columns[1:], wanted[1:], strict=True):
            have, want = column[middle], value[open_]
            below |= equal & (have < want)
            equal &= have == want
        go = below | equal if after else below
        lo[open_[go]], hi[open_[~go]] = middle[go] + 1, middle[~go]
    return lo


def _columns(table: np.ndarray) -> list[np.ndarray]:
    keys = pairs_of(table)
    return [np.ascontiguousarray(keys[:, c]) for c in range(keys.shape[1])]


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many first words rows have in common."""
    out, open_ = np.zeros(len(a), np.int64), np.ones(len(a), bool)
    for column in range(WINDOW):
        open_ &= (a[:, column] == b[:, column]) & (a[:, column] > 0)
        out += open_
    return out


class Matches(NamedTuple):
    """Occurrences of windows (suffix, place), and for each place with a known word its longest match of up to WINDOW words."""

    suffix: np.ndarray
    place: np.ndarray
    known: np.ndarray
    length: np.ndarray
    nearest: np.ndarray


def matches(ranks: np.ndarray, index: Index) -> Matches:
    """``ranks`` ends with WINDOW zeros and has a zero after each text."""
    known = suffix_array(ranks)
    if not len(known):
        return Matches(*[np.zeros(0, np.int64)] * 5)
    table = following(ranks, known)
    columns, low = _columns(table), _columns(index.suffixes)
    begin = _bound(columns, low, after=False)

    # Windows: from there to the last place that begins with all of their words.
    own = np.flatnonzero(index.window)
    inside = np.arange(WINDOW) < index.window[own][:, None]
    high = _columns(np.where(inside, index.suffixes[own], np.iinfo(np.int32).max))
    count = np.maximum(_bound(columns, high, after=True) - begin[own], 0)
    at = np.repeat(begin[own] - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())

    # The longest match of a place is with a neighbour of it among the suffixes.
    after = np.searchsorted(begin, np.arange(len(known)), "right")
    last = len(index.suffixes) - 1
    left, right = np.maximum(after - 1, 0), np.minimum(after, last)
    with_left, with_right = _common(table, index.suffixes[left]), _common(table, index.suffixes[right])
    nearest = np.where(with_left >= with_right, left, right)
    return Matches(np.repeat(own, count), known[at], known, np.maximum(with_left, with_right), nearest)


def _run(suffix: np.ndarray, index: Index) -> tuple[int, int, int]:
    """Length, first step and item of the longest match within full windows found at consecutive places."""
    count = index.first[suffix + 1] - index.first[suffix]
    step = np.repeat(np.arange(len(suffix)), count)
    entry = np.repeat(index.first[suffix] - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
    line = index.places[entry] - step
    order = np.lexsort((step, line))
    step, line, entry = step[order], line[order], entry[order]
    breaks = np.flatnonzero(np.concatenate(([True], (line[1:] != line[:-1]) | (step[1:] != step[:-1] + 1))))
    length = np.diff(np.append(breaks, len(step))) + WINDOW - 1
    best = np.lexsort((step[breaks], -length))[0]
    return int(length[best]), int(step[breaks[best]]), int(index.owner[entry[breaks[best]]])


def _longest(suffix: np.ndarray, at: np.ndarray, index: Index) -> tuple[int, int, int]:
    """Length, place and item of the longest match of WINDOW words or more in one text."""
    full = index.window[suffix] == WINDOW
    order = np.argsort(at[full], kind="stable")
    suffix, at = suffix[full][order], at[full][order]
    breaks = np.flatnonzero(np.diff(at) != 1) + 1
    best, seen = (0, -1, -1), set()
    for run, where in zip(np.split(suffix, breaks), np.split(at, breaks), strict=True):
        # A run that cannot be longer, or that came before, needs no look.
        if len(run) + WINDOW - 1 <= best[0] or not len(run) or (key := run.tobytes()) in seen:
            continue
        seen.add(key)
        length, step, item = _run(run, index)
        if length > best[0]:
            best = (length, int(where[step]), item)
    return best


def _search(index, first: bool):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            for part in slices(batch):
                yield _searched(part, own, first)

    return search


KIND = pa.struct([("n_words", pa.int64()), ("hits", pa.binary()), ("items", pa.list_(pa.string())), ("longest", pa.int64()), ("longest_at", pa.int64()), ("longest_item", pa.string())])


def _searched(part: pa.RecordBatch, index: Index, first: bool) -> pa.RecordBatch:
    w = words(text_in(part), ALPHANUMERIC)
    n_docs, doc = part.num_rows, w.doc()
    # One zero after each text keeps a match inside it.
    ranks = np.zeros(len(w.hash) + n_docs + WINDOW, dtype=np.int64)
    if len(index.vocabulary) and len(w.hash):
        at = np.minimum(np.searchsorted(index.vocabulary, w.hash), len(index.vocabulary) - 1)
        ranks[np.arange(len(w.hash)) + doc] = np.where(index.vocabulary[at] == w.hash, at + 1, 0)
    found = matches(ranks, index)
    starts = w.first[:-1] + np.arange(n_docs)
    sizes = np.diff(w.first)

    # Of each text the longest match of up to WINDOW words, the first of them.
    owner = np.searchsorted(starts, found.known, "right") - 1
    order = np.lexsort((found.known, -found.length, owner))
    top = order[np.unique(owner[order], return_index=True)[1]]
    short = dict(zip(owner[top].tolist(), zip(found.length[top].tolist(), found.known[top].tolist(), found.nearest[top].tolist(), strict=True), strict=True))

    owner = np.searchsorted(starts, found.place, "right") - 1
    order = np.argsort(owner, kind="stable")
    suffix, place, owner = found.suffix[order], found.place[order], owner[order]
    cut = np.searchsorted(owner, np.arange(n_docs + 1))
    old = None if first else named(part, "state")
    name = lambda item: min(index.names[item], default=None)
    rows = []
    for d in range(n_docs):
        a, b = cut[d], cut[d + 1]
        row = {"n_words": int(sizes[d]), "hits": None, "items": [], "longest": 0, "longest_at": None, "longest_item": None} if old is None else old[d].as_py()
        own, at = suffix[a:b], place[a:b] - starts[d]
        length, where, item = _longest(own, at, index) if a < b else (0, -1, -1)
        if d in short and short[d][0] > length:
            length, where = short[d][0], short[d][1] - int(starts[d])
            item = int(index.owners(short[d][2])[0])
        if length > row["longest"] or length and length == row["longest"] and where < row["longest_at"]:
            row |= {"longest": length, "longest_at": where, "longest_item": name(item)}
        if a < b:
            hit = np.zeros(int(sizes[d]) + 1, dtype=np.int64)
            np.add.at(hit, at, 1)
            np.add.at(hit, at + index.window[own], -1)
            bits = np.packbits(np.cumsum(hit[:-1]) > 0)
            if row["hits"] is not None:
                bits |= np.frombuffer(row["hits"], dtype=np.uint8)
            row["hits"] = bits.tobytes()
            row["items"] = sorted(set(row["items"]).union(*(index.names[i] for i in _owners(own, index))))
        rows.append(row)
    names = [name for name in part.schema.names if name != "state"]
    return pa.RecordBatch.from_arrays([named(part, name) for name in names] + [pa.array(rows, KIND)], names=[*names, "state"])


def _owners(suffix: np.ndarray, index: Index) -> list[int]:
    """The items that have one of the suffixes as a window.

    A short item is one as a whole, though another may end with the same words.
    """
    found: set[int] = set()
    for s in np.unique(suffix).tolist():
        entries = slice(index.first[s], index.first[s + 1])
        own = index.owner[entries]
        found.update(own.tolist() if index.window[s] == WINDOW else own[index.places[entries] == index.begins[own]].tolist())
    return list(found)


def distinct_items(benchmark: DataFrame) -> DataFrame:
    """(names, text): each text once, with the ids of all its items."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), text_of().alias("text"))
    return items.where(F.col("text") != "").groupBy("text").agg(F.array_sort(F.collect_set("item")).alias("names"))


def blocks(benchmark: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[list[Item]]:
    """The distinct items, in lists of about ``limit`` bytes; one block at a time is on the driver."""
    items = checkpoint(distinct_items(benchmark))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-total // limit))
    numbered = items.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(count)))
    for block in range(count):
        yield sorted((row.names, row.text) for row in numbered.where(F.col("block") == block).collect())


def _summed(state: pa.ChunkedArray | pa.Array) -> tuple[list, list, list]:
    hits = [int(np.unpackbits(np.frombuffer(x, np.uint8)).sum()) if (x := s["hits"].as_py()) is not None else 0 for s in state]
    items = [s["items"].as_py() or [] for s in state]
    return hits, [len(i) for i in items], [hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        state = named(batch, "state")
        hits, n_items, digests = _summed(state)
        yield pa.RecordBatch.from_arrays(
            [named(batch, "row"), state.field("n_words"), pa.array(hits, pa.int64()), pa.array(n_items, pa.int64()), pa.array(digests, pa.string()),
             state.field("items"), state.field("longest"), state.field("longest_at"), state.field("longest_item")],
            names=["row", "n_words", "n_hit", "n_items", "items_sha256", "items", "longest", "longest_at", "longest_item"],
        )


def searched(docs: DataFrame, benchmark: DataFrame, limit: int = BLOCK_BYTES, kept: list[str] | None = None) -> DataFrame:
    """``row`` (all columns of ``docs``, or those ``kept``) with its hits, items and longest match."""
    spark = docs.sparkSession
    bounded_batches(spark)
    # A whole row holds its text already.
    texts = [F.col("text").alias("_text")] if kept else []
    rows = docs.select(packed(docs.select(kept or "*")).alias("row"), *texts)
    shape = f"row {rows.schema['row'].dataType.simpleString()}"
    text = "_text string, " if kept else ""
    held: list = []
    for number, items in enumerate(blocks(benchmark, limit)):
        if len(held) == BLOCKS_HELD:
            rows = stored(rows)
            for index in held:
                index.destroy()
            held = []
        held.append(spark.sparkContext.broadcast(index_of(items)))
        rows = rows.mapInArrow(_search(held[-1], number == 0), f"{shape}, {text}state struct<{_fields(STATE)}>")
    digest = "n_words long, n_hit long, n_items long, items_sha256 string, items array<string>, longest long, longest_at long, longest_item string"
    return rows.drop("_text").mapInArrow(_digested, f"{shape}, {digest}").withColumn("contaminated", F.col("n_hit") > 0)


def _fields(columns: str) -> str:
    return ", ".join(":".join(c.split(" ", 1)) for c in columns.split(", "))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that hold a window of the benchmark."""
    clean = searched(docs, benchmark).where(~F.col("contaminated"))
    return clean.select(*[F.col(f"row.`{name}`").alias(name) for name in docs.columns])


def op6(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = searched(docs.select("doc_id", "text"), benchmark, kept=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
