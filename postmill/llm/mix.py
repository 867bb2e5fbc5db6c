"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are put in a fixed shuffled order and its words, laid end to end, are cut
into equal blocks of ``BLOCK`` words at most, ``LEAST_BLOCKS`` at least if it has as many words. The
mix is a row of slots of one block each; a source has its target over its block length of them. Slot
k stands at the golden-ratio point frac(k * phi); the point falls into the interval of one source on
the line of cumulative slots, so after any number of slots each source is within a few blocks of its
share. The slots of a source are ranked, and the slot of rank r takes the source's block
r mod (blocks of the source): one pass over the source, then a second one, never a third. At the end
the ranks of a source that are over its number are taken back, and those missing are added.

Only two hashes of the row, its source and its size take part in this; they are stored once, so texts are read
for their words a single time. ``mixture`` joins the rows to their copies in one shuffle at the end.

Targets: 150 % of all words are dealt by the weights 3, 1, 2, 3, .. over the sources in order of
code points, null last; a target stops at twice its source's size, and what is over is dealt again
among the others. A null text has no words; documents without words take no part. Equal rows are
documents of their own; which of them is taken more often is of no account. Texts of any length are counted
whole, and one longer than a block lies in several. Ties cannot arise but between equal rows, as places come from
hashes of the whole row. Columns of any name are carried along. An empty table, or one without a word, gives targets and shares of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, checkpoint, packed, row_keys, stored, text_of

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
BLOCK = 64
LEAST_BLOCKS = 64
BUCKETS = 1024
CELLS = 4096
CHUNK = 65_536
# The fraction of the golden ratio in units of 2^-40.
UNITS = 1 << 40
GOLDEN = 679_535_556_991
HALF = 1 << 20


def words_of(docs: DataFrame, seed: int, kept: tuple[str, ...] = ()) -> DataFrame:
    """``row`` (two keys of the whole row and the columns ``kept``), ``source``, ``size`` in words, and the place: ``bucket``, ``place``."""
    first, second = row_keys(docs)
    return docs.select(
        F.struct(first.alias("k1"), second.alias("k2"), packed(docs.select(*kept)).alias("kept") if kept else F.lit(None).cast("string").alias("kept")).alias("row"),
        F.col("source"),
        F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), first, second).alias("place"),
    ).withColumn("bucket", F.pmod("place", F.lit(BUCKETS)))


def source_targets(sizes: DataFrame) -> DataFrame:
    """From (source, size): ``sid``, ``source_size``, ``target``, ``n_blocks``, ``slots`` and their interval ``lo``, ``hi``.

    One row a source. Sorted by size over weight, the sources that are stopped come first, and the
    level of the rest is the largest (words left) / (weights left) along that order.
    """
    everything = Window.partitionBy()
    ranked = sizes.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("sid") % len(WEIGHTS) + 1).cast("int"))
    ranked = ranked.select("source", "sid", F.col("size").alias("source_size"), weight.alias("weight")).withColumn(
        "total", F.lit(SHARE) * F.sum("source_size").over(everything)
    )
    most = F.lit(float(REPEATS)) * F.col("source_size")
    by_ratio = Window.orderBy(most / F.col("weight"), "sid")
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    later = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = (F.col("total") - F.coalesce(F.sum(most).over(earlier), F.lit(0.0))) / F.sum("weight").over(later)
    leveled = ranked.withColumn("left", left).withColumn("level", F.max("left").over(everything))
    targets = leveled.withColumn("target", F.least(most, F.col("weight") * F.col("level")))
    size = F.col("source_size")
    n_blocks = F.greatest(F.ceil(size / BLOCK), F.least(size, F.lit(LEAST_BLOCKS))).cast("long")
    slots = F.greatest(F.round(F.col("target") / size * F.col("n_blocks")), F.lit(1)).cast("long")
    targets = targets.withColumn("n_blocks", n_blocks).withColumn("slots", F.when(F.col("target") > 0, slots).otherwise(0))
    in_order = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("slots").over(in_order), F.lit(0))
    whole = F.nullif(F.sum("slots").over(everything), F.lit(0))
    return targets.select(
        "source", "sid", "source_size", "target", "n_blocks", "slots",
        (before / whole).alias("lo"), ((before + F.col("slots")) / whole).alias("hi"),
    )


def golden_point(number: Column) -> Column:
    """The fraction of ``number`` times the golden ratio, in whole units without overflow, so that it keeps its precision for any number of slots."""
    low = F.pmod(number, F.lit(HALF)) * GOLDEN
    high = F.pmod(F.floor(number / HALF) * (GOLDEN % HALF), F.lit(HALF)) * HALF
    return F.pmod(low + high, F.lit(UNITS)) / F.lit(float(UNITS))


def schedule(targets: DataFrame, slots: int) -> DataFrame:
    """(sid, block, times): how often the slots take each block."""
    spark = targets.sparkSession
    points = spark.range(slots).withColumn("point", golden_point(F.col("id")))
    points = points.withColumn("cell", F.floor(F.col("point") * CELLS)).withColumn("chunk", F.floor(F.col("id") / CHUNK))
    # The last interval is open to the right, against sums of shares that end just below 1.
    open_end = F.lead("sid").over(Window.orderBy("sid")).isNull()
    intervals = targets.where(F.col("slots") > 0).withColumn("hi", F.when(open_end, F.lit(2.0)).otherwise(F.col("hi")))
    cells = F.sequence(F.floor(F.col("lo") * CELLS), F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1).cast("long")))
    intervals = intervals.select("sid", "lo", "hi", F.explode(cells).alias("cell"))
    dealt = points.join(intervals, "cell").where((F.col("point") >= F.col("lo")) & (F.col("point") < F.col("hi")))
    counts = checkpoint(dealt.groupBy("sid", "chunk").agg(F.count("*").alias("in_chunk")))
    before = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("sid", "chunk", F.coalesce(F.sum("in_chunk").over(before), F.lit(0).cast("long")).alias("first"))
    inside = F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("id")) - 1
    ranked = dealt.withColumn("inside", inside).join(first, ["sid", "chunk"]).withColumn("rank", F.col("first") + F.col("inside"))
    of_source = targets.select(F.col("sid").alias("s"), "n_blocks", F.col("slots").alias("due"))
    dealt_of = counts.groupBy("sid").agg(F.sum("in_chunk").alias("n")).withColumnRenamed("sid", "d")
    short = of_source.join(dealt_of, F.col("s") == F.col("d"), "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long"))).where(F.col("n") < F.col("due"))
    added = short.select("s", "n_blocks", F.explode(F.sequence("n", F.col("due") - 1)).alias("rank"))
    kept = ranked.join(of_source, F.col("sid") == F.col("s")).where(F.col("rank") < F.col("due")).select("s", "n_blocks", F.col("rank").cast("long").alias("rank"))
    settled = kept.unionByName(added).select(F.col("s").alias("sid"), F.pmod("rank", "n_blocks").alias("block"))
    return settled.groupBy("sid", "block").agg(F.count("*").alias("times"))


def block_of(word: str) -> Column:
    """The block of a word; in decimals, as the product can be beyond a long."""
    return F.expr(f"(cast({word} + 1 as decimal(19,0)) * cast(n_blocks as decimal(19,0)) - 1) div cast(source_size as decimal(19,0))")


def begin_of(block: str) -> Column:
    """The first word of a block."""
    return F.expr(f"(cast({block} as decimal(19,0)) * cast(source_size as decimal(19,0))) div cast(n_blocks as decimal(19,0))")


def mixed(docs: DataFrame, seed: int = 0, kept: tuple[str, ...] = ()) -> DataFrame:
    """Columns ``row`` (as in ``words_of``), ``size``, ``source_size``, ``target``, ``taken``, and ``leads`` at the first words of a source."""
    rows = stored(words_of(docs, seed, kept))
    sums = checkpoint(rows.groupBy("source", "bucket").agg(F.sum("size").alias("size")))
    targets = checkpoint(source_targets(sums.groupBy("source").agg(F.sum("size").alias("size"))))
    times = schedule(targets, targets.agg(F.sum("slots")).first()[0] or 0)

    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source", "bucket", F.coalesce(F.sum("size").over(before), F.lit(0).cast("long")).alias("offset"))
    offsets = offsets.join(targets.select("source", "sid", "source_size", "target", "n_blocks"), F.equal_null(offsets["source"], targets["source"])).drop("source")
    offsets = offsets.withColumnRenamed("bucket", "b")
    sids = targets.select(F.col("source").alias("s"), F.col("sid").alias("i"))
    rows = rows.join(sids, F.equal_null("source", "s")).drop("source", "s")
    running = F.sum("size").over(Window.partitionBy("i", "bucket").orderBy("place", "row.k1", "row.k2").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("running", running).join(offsets, (F.col("i") == F.col("sid")) & (F.col("bucket") == F.col("b")))
    rows = rows.select("row", "sid", "size", "source_size", "target", "n_blocks", (F.col("offset") + F.col("running") - F.col("size")).alias("start"))

    blocks = F.sequence(block_of("start"), block_of("start + size - 1"))
    pieces = rows.where(F.col("size") > 0).select("sid", "start", "size", "source_size", "n_blocks", F.explode(blocks).alias("block"))
    inside = F.least(F.col("start") + F.col("size"), begin_of("block + 1")) - F.greatest(F.col("start"), begin_of("block"))
    taken = pieces.join(times, ["sid", "block"]).groupBy("sid", "start").agg(F.sum(inside * F.col("times")).alias("taken"))
    taken = taken.select(F.col("sid").alias("t_sid"), F.col("start").alias("t_start"), "taken")
    found = rows.join(taken, (F.col("sid") == F.col("t_sid")) & (F.col("start") == F.col("t_start")) & (F.col("size") > 0), "left")
    leads = (F.col("start") == 0) & (F.col("size") > 0)
    return found.select("row", "size", "source_size", "target", leads.alias("leads"), F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixture(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The mix as documents: each as often as its taken words make whole copies, rounded.

    The first document of a source stays once at least, so no source is lost by rounding.
    """
    copies = F.greatest(F.round(F.col("taken") / F.col("size")), F.when(F.col("leads"), 1).otherwise(0)).cast("int")
    chosen = mixed(docs, seed).select("row.k1", "row.k2", F.when(F.col("taken") > 0, copies).otherwise(0).alias("copies"))
    # Equal rows share their keys: together they get the copies of all of them.
    chosen = chosen.groupBy("k1", "k2").agg(F.sum("copies").alias("copies"), F.count("*").alias("equals")).where(F.col("copies") > 0)
    first, second = row_keys(docs)
    rows = docs.select(packed(docs).alias("row"), first.alias("k1"), second.alias("k2"))
    rows = rows.withColumn("at", F.row_number().over(Window.partitionBy("k1", "k2").orderBy("k1"))).join(chosen, ["k1", "k2"])
    times = F.floor(F.col("copies") / F.col("equals")) + F.when(F.col("at") <= F.col("copies") % F.col("equals"), 1).otherwise(0)
    repeated = rows.withColumn("times", times).where(F.col("times") > 0).select("row", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    return repeated.select(*[F.col(f"row.`{name}`").alias(name) for name in docs.columns])


def op5(docs: DataFrame) -> DataFrame:
    slim = docs.select("doc_id", "source", "text")
    return mixed(slim, kept=("doc_id",)).select(F.col("row.kept.doc_id").alias("doc_id"), "size", "source_size", "target", "taken")
