"""Phrase collocations from stripes.

A stripe belongs to a prefix of two words: an associative counter of the words that follow it, with
one entry for the end of the piece. Stripes of the same first word lie together. Tasks count slices
of text into partial stripes, which are merged entry by entry. One merged stripe gives the prefix's
own frequency (its sum), its extensions (its entries) and the largest of them, by which the prefix is
subsumed. The counter of the empty prefix gives the words' frequencies and their spelling.

Buckets of stripes follow the size of the input. A first word that alone would fill a good part of a
bucket is dealt by its second word as well, and such a pair by its third; the sums of a pair dealt so
are added up afterwards. Which ones is read from a bounded sample, on which only the balance depends.

Words are known by 64-bit hashes until the candidates are spelled out.

Null and empty texts have no words; null lang counts as ``und``. Long texts are counted whole, each
row is counted however often it is repeated, ids play no part, and other columns are left alone. An
empty table gives no rows. Ties of score and frequency go to the smaller phrase, in UTF-8 byte order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, stored
from .words import Words, byte_set, mixed, named, slices, words

LEAST = 10
SUBSUMED_PERCENT = 50
TOP = 2000
SCALE = 1_000_000
UNKNOWN = "und"

SLICE = 6 << 20
BUCKET_BYTES = 4 << 20  # of text
LEAST_BUCKETS = 64
SAMPLE_BYTES = 8 << 20
HOT_SHARE = 8  # of a bucket: one in so many
LEAST_SAMPLED = 8
SALTS = 32

CUTS = ~byte_set([(ord(c), ord(c)) for c in ".,;:!?"] + [(0x0A, 0x0D)])
IN_WORD = byte_set([(ord(c), ord(c)) for c in ".,;:!? \t"] + [(0x0A, 0x0D)])
END = mixed(np.array([0x2E], dtype=np.uint64))[0]
NEXT = np.uint64(0xC2B2AE3D27D4EB4F)

STRIPED = "lang string, bucket int, firsts binary, n_seconds binary, seconds binary, n_thirds binary, thirds binary, counts binary, spelled binary, ends binary"
MERGED = "lang string, size int, w1 long, w2 long, w3 long, a long, longer long, word string"
BLOBS = ("firsts", "n_seconds", "seconds", "n_thirds", "thirds", "counts", "spelled", "ends")


def followed(w: Words) -> np.ndarray:
    """Whether the next word is of the same piece of the same text."""
    same = np.zeros(len(w.hash), dtype=bool)
    if len(same):
        doc = w.doc()
        cuts = np.cumsum(CUTS[w.data], dtype=np.int32)[w.start]
        same[:-1] = (doc[1:] == doc[:-1]) & (cuts[1:] == cuts[:-1])
    return same


def triples(ids: np.ndarray, goes_on: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (first, second, third) with their counts, in order; third may be ``end``."""
    size = end + 1
    third = np.full(len(ids), end, dtype=np.int64)
    third[:-2] = np.where(goes_on[1:-1], ids[2:], end)
    first, second, third = ids[:-1][goes_on[:-1]], ids[1:][goes_on[:-1]], third[:-1][goes_on[:-1]]
    pairs, own = np.unique(first * size + second, return_inverse=True)
    found, counts = np.unique(own * size + third, return_counts=True)
    pair = pairs[found // size]
    return pair // size, pair % size, found % size, counts


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of sorted keys begins."""
    new = np.zeros(len(keys[0]), dtype=bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def _lengths(starts: np.ndarray, total: int) -> np.ndarray:
    return np.diff(np.append(starts, total)).astype(np.uint32)


def among(keys: np.ndarray, few: np.ndarray) -> np.ndarray:
    """Which keys are in the short sorted ``few``."""
    if not len(few):
        return np.zeros(len(keys), dtype=bool)
    return few[np.minimum(np.searchsorted(few, keys), len(few) - 1)] == keys


def spread(first: np.ndarray, second: np.ndarray, third: np.ndarray, hot_words: np.ndarray, hot_pairs: np.ndarray) -> np.ndarray:
    """The number by which an entry is dealt: that of its first word, or of more words for a hot one."""
    pair = mixed(first * NEXT + second)
    key = np.where(among(first, hot_words), pair, first)
    return np.where(among(pair, hot_pairs), mixed(pair * NEXT + third), key)


def _dealt(key: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """A stable order by bucket, and where each begins in it."""
    bucket = (mixed(key) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _stripe_rows(first, second, third, counts, plan) -> Iterator[tuple]:
    buckets, hot_words, hot_pairs = plan
    order, ends = _dealt(spread(first, second, third, hot_words, hot_pairs), buckets)
    for b in np.flatnonzero(np.diff(ends)):
        at = order[ends[b] : ends[b + 1]]
        one, two = first[at], second[at]
        pairs = _runs(one, two)
        heads = _runs(one[pairs])
        yield (
            int(b), one[pairs][heads].tobytes(), _lengths(heads, len(pairs)).tobytes(), two[pairs].tobytes(),
            _lengths(pairs, len(at)).tobytes(), third[at].tobytes(), counts[at].astype(np.uint32).tobytes(), None, None,
        )


def _word_rows(w: Words, found: np.ndarray, at: np.ndarray, counts: np.ndarray, buckets: int) -> Iterator[tuple]:
    """The counter of the empty prefix; ``at`` is a place of each word in ``w``."""
    order, ends = _dealt(found, buckets)
    begin, size = w.start[at], w.end[at] - w.start[at]
    for b in np.flatnonzero(np.diff(ends)):
        own = order[ends[b] : ends[b + 1]]
        length = size[own]
        stop = np.cumsum(length)
        letter = np.repeat(begin[own] - (stop - length), length) + np.arange(int(stop[-1]))
        yield (-1 - int(b), found[own].tobytes(), None, None, None, None, counts[own].astype(np.uint32).tobytes(), w.data[letter].tobytes(), stop.astype(np.uint32).tobytes())


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of about ``SLICE`` bytes of text, from several batches if need be."""
    held, size = [], 0
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            held.append(part)
            size += named(part, "text").nbytes
            if size >= SLICE:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _striped(model):
    def stripe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = model.value
        kinds = [pa.string(), pa.int32(), *[pa.binary()] * len(BLOBS)]
        for part in _gathered(batches):
            w = words(named(part, "text"), IN_WORD)
            langs = named(part, "lang").dictionary_encode()
            lang_of = np.asarray(langs.indices)[w.doc()]
            goes_on = followed(w)
            found, ids = np.unique(w.hash, return_inverse=True)
            hashes = np.append(found, END)
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                of_lang = np.flatnonzero(lang_of == code)
                if not len(of_lang):
                    continue
                own = ids[of_lang]
                used, at, times = np.unique(own, return_index=True, return_counts=True)
                rows = [(lang, *row) for row in _word_rows(w, found[used], of_lang[at], times, plan[0])]
                first, second, third, counts = triples(own, goes_on[of_lang], len(found))
                rows += [(lang, *row) for row in _stripe_rows(hashes[first], hashes[second], hashes[third], counts, plan)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["lang", "bucket", *BLOBS])

    return stripe


def _blob(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=kind)


def merged_words(table: pa.Table, least: int) -> list[tuple]:
    """(size, w1, w2, w3, a, longer, word): the sum of all, and each word frequent enough."""
    found, counts = _blob(table, "firsts", np.uint64), _blob(table, "counts", np.uint32)
    unique, at, own = np.unique(found, return_index=True, return_inverse=True)
    total = np.bincount(own, weights=counts, minlength=len(unique)).astype(np.int64)
    row_of = np.searchsorted(np.cumsum([len(x) // 8 for x in table.column("firsts").to_pylist()]), at, "right")
    begins = np.concatenate(([0], np.cumsum([len(x) // 8 for x in table.column("firsts").to_pylist()])))
    out: list[tuple] = [(0, None, None, None, int(total.sum()), None, None)]
    for i in np.flatnonzero(total >= least):
        row, place = int(row_of[i]), int(at[i] - begins[row_of[i]])
        ends = np.frombuffer(table.column("ends")[row].as_buffer(), np.uint32)
        spelled = table.column("spelled")[row].as_buffer()
        begin = int(ends[place - 1]) if place else 0
        word = spelled[begin : int(ends[place])].to_pybytes().decode("utf-8", "replace")
        out.append((1, int(unique[i : i + 1].view(np.int64)[0]), None, None, int(total[i]), None, word))
    return out


def merged_stripes(table: pa.Table, least: int, hot_pairs: np.ndarray) -> list[np.ndarray]:
    """Columns size, w1, w2, w3, a, longer of the prefixes and extensions frequent enough.

    The sum of a prefix that is dealt by its third word is partial, so it goes out whatever it is.
    """
    first = np.repeat(_blob(table, "firsts", np.uint64), _blob(table, "n_seconds", np.uint32))
    n_thirds = _blob(table, "n_thirds", np.uint32)
    first, second = np.repeat(first, n_thirds), np.repeat(_blob(table, "seconds", np.uint64), n_thirds)
    third, counts = _blob(table, "thirds", np.uint64), _blob(table, "counts", np.uint32).astype(np.int64)
    order = np.lexsort((third, second, first))
    first, second, third, counts = first[order], second[order], third[order], counts[order]
    entries = _runs(first, second, third)
    first, second, third, a = first[entries], second[entries], third[entries], np.add.reduceat(counts, entries)
    extends = (third != END) & (a >= least)
    prefixes = _runs(first, second)
    total = np.add.reduceat(a, prefixes)
    longer = np.maximum.reduceat(np.where(extends, a, 0), prefixes)
    out = prefixes[(total >= least) | among(mixed(first[prefixes] * NEXT + second[prefixes]), hot_pairs)]
    at = np.searchsorted(prefixes, out)
    long = np.flatnonzero(extends)
    return [
        np.repeat(np.array([2, 3], np.int32), [len(out), len(long)]),
        *[np.concatenate((x[out], x[long])).view(np.int64) for x in (first, second, third)],
        np.concatenate((total[at], a[long])),
        np.concatenate((longer[at], np.zeros(len(long), np.int64))),
    ]


def _merged(model, least: int):
    names = ["lang", "size", "w1", "w2", "w3", "a", "longer", "word"]
    kinds = [pa.string(), pa.int32(), *[pa.int64()] * 5, pa.string()]

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        if key[1].as_py() < 0:
            columns: list = [list(c) for c in zip(*merged_words(table, least), strict=True)]
        else:
            columns = merged_stripes(table, least, model.value[2])
            columns.append([None] * len(columns[0]))
        lang = [key[0].as_py()] * len(columns[0])
        return pa.table([pa.array(c, t) for c, t in zip([lang, *columns], kinds, strict=True)], names=names)

    return merge


def hot_keys(texts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """First words, and hashes of pairs, that hold more of the sampled texts than a part of a bucket."""
    w = words(pa.array(texts, pa.string()), IN_WORD)
    before = np.flatnonzero(followed(w))
    first, second = w.hash[before], w.hash[before + 1]
    least = max(LEAST_SAMPLED, len(before) // (buckets * HOT_SHARE))

    def common(found: np.ndarray) -> np.ndarray:
        unique, counts = np.unique(found, return_counts=True)
        return unique[counts >= least]

    return common(first), common(mixed(first * NEXT + second))


def frequencies(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, size, w1, w2, w3, a, longer, word), stored: per lang the number of its words (size 0),
    its words (1), pairs (2; partial sums of a pair stand in several rows) and triples (3)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text").where(F.col("text").isNotNull())
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    one_in = max(1, -(-size // SAMPLE_BYTES))
    by_row = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(one_in)) == 0
    sampled = [r["text"] for r in rows.where(by_row).select("text").collect()]
    model = spark.sparkContext.broadcast((buckets, *hot_keys(sampled, buckets)))
    partial = rows.mapInArrow(_striped(model), STRIPED)
    return stored(partial.groupBy("lang", "bucket").applyInArrow(_merged(model, least), MERGED))


def _score(a: str, left: str, right: str) -> Column:
    """Whole millionths of a * a / (l * r); the products fit 38 digits while counts have 15."""
    wide = "cast({} as decimal(16, 0))"
    over = f"cast({SCALE} * cast({wide.format(a)} * {wide.format(a)} as decimal(31, 0)) as decimal(38, 0))"
    return F.expr(f"cast(({over}) div ({wide.format(left)} * {wide.format(right)}) as bigint)")


def collocations(docs: DataFrame, least: int = LEAST, percent: int = SUBSUMED_PERCENT, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each lang's first ``top`` phrases of two and three words."""
    found = frequencies(docs, least)
    of = lambda size: found.where(F.col("size") == size)
    word = of(1).select(F.col("lang").alias("lang_"), F.col("w1").alias("w"), F.col("a").alias("f"), "word")
    pairs = of(2).groupBy("lang", "w1", "w2").agg(F.sum("a").alias("a"), F.max("longer").alias("longer")).where(F.col("a") >= least)
    longs = of(3).select("lang", "w1", "w2", "w3", "a")

    def spelled(df: DataFrame, at: int) -> DataFrame:
        """Add the spelling and frequency of a word that every candidate's words reach."""
        own = word.select("lang_", F.col("w").alias(f"w{at}_"), F.col("f").alias(f"f{at}"), F.col("word").alias(f"word{at}"))
        return df.join(own, (F.col("lang") == F.col("lang_")) & (F.col(f"w{at}") == F.col(f"w{at}_"))).drop("lang_", f"w{at}_")

    def prefixed(df: DataFrame, at: int) -> DataFrame:
        own = pairs.select(F.col("lang").alias("lang_"), F.col("w1").alias("x"), F.col("w2").alias("y"), F.col("a").alias(f"f{at}{at + 1}"))
        same = (F.col("lang") == F.col("lang_")) & (F.col(f"w{at}") == F.col("x")) & (F.col(f"w{at + 1}") == F.col("y"))
        return df.join(own, same).drop("lang_", "x", "y")

    # The largest extension to the right is in the stripe itself; that to the left is in other stripes.
    before = longs.groupBy(F.col("lang").alias("lang_"), F.col("w2").alias("x"), F.col("w3").alias("y")).agg(F.max("a").alias("before"))
    same = (F.col("lang") == F.col("lang_")) & (F.col("w1") == F.col("x")) & (F.col("w2") == F.col("y"))
    free = pairs.join(before, same, "left").where(100 * F.greatest("longer", F.coalesce("before", F.lit(0))) < percent * F.col("a"))
    twos = spelled(spelled(free.select("lang", "w1", "w2", "a"), 1), 2)
    twos = twos.select("lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), _score("a", "f1", "f2").alias("score"))

    threes = spelled(spelled(spelled(prefixed(prefixed(longs, 1), 2), 1), 2), 3)
    cuts = F.array(
        F.struct(_score("a", "f1", "f23").alias("score"), F.lit(1).alias("k"), F.col("f1").alias("l"), F.col("f23").alias("r")),
        F.struct(_score("a", "f12", "f3").alias("score"), F.lit(2).alias("k"), F.col("f12").alias("l"), F.col("f3").alias("r")),
    )
    threes = threes.select("lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a", F.array_min(cuts).alias("cut"))
    threes = threes.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First within parts of a lang, so that no task sorts all phrases of one.
    salted = twos.unionByName(threes).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    for by in (["lang", "salt"], ["lang"]):
        salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)
    n = of(0).groupBy(F.col("lang").alias("lang_")).agg(F.sum("a").alias("n"))
    return salted.join(n, F.col("lang") == F.col("lang_")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def op11(docs: DataFrame) -> DataFrame:
    return collocations(docs.select("lang", "text"))
