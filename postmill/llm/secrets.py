"""Secret scan with multipart credential linking, in DataFrame functions only.

Base kinds stand by themselves: ``assign``, ``access``, ``hex``. Weak kinds are too common to be
reported alone: ``secret`` (40 characters of base 64), ``user`` (an account name that is assigned)
and ``endpoint`` (an address). A credential has three parts: an identifier (access, user), a secret
(assign, hex, secret) and an endpoint. Parts whose gap is at most ``SCOPE`` code points share a
scope; they are found by an interval join on bins of the text. A ``secret`` is reported when an
identifier is in its scope, a ``user`` when a secret is, an ``endpoint`` when both are.

Spans are kind:start:end in code points, end exclusive, by start and then by kind: there are no other
ties. A null text is empty and has none; a null id is an id. Rows equal in id and text have equal spans
and are searched once. A long text is searched whole, in time that grows with its length. An empty
table gives no rows, and columns beside id and text play no part.

Positions come from splitting the text at the matches, so that no Python is needed: a match starts
where the pieces and matches before it end, a running sum over the rows of one text and kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, text_of

SCOPE = 256

# The base patterns, which their names refer to.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"

SECRET = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/_-])"
USER = r"""(?i:user(?:name)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@-]{3,})"""
ENDPOINT = r"(?i:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[A-Za-z0-9._~:/?#@!$&*+,;=%-]{4,}"

KINDS = ("assign", "access", "hex", "secret", "user", "endpoint")
BASE = KINDS[:3]
ROLES = {"access": "identifier", "user": "identifier", "assign": "secret", "hex": "secret", "secret": "secret", "endpoint": "endpoint"}
NEEDS = {"secret": ("identifier",), "user": ("secret",), "endpoint": ("identifier", "secret")}

# Characters that the judged part of a match must have; others need one.
LEAST = {"assign": 6, "access": 20, "hex": 24}

SPAN = "array<struct<start:long,rank:int,stop:long>>"


PIECE = "array<struct<skip:int,took:int,judged:int>>"


def pieces_of(text: Column, pattern: str, group: int = 0, sign: str | None = None) -> Column:
    """(skip, took, judged) of each match of ``pattern``, leftmost and not overlapping: the code points
    since the match before, its own, and those of ``group``. ``sign`` is in every text with a match.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    lengths = F.zip_with(
        F.zip_with(F.split(text, pattern, -1), found, lambda b, m: F.struct(F.length(b).alias("skip"), F.length(m).alias("took"))),
        judged,
        lambda p, g: F.struct(p["skip"].alias("skip"), p["took"].alias("took"), F.length(g).alias("judged")),
    )
    # Texts without a match, nearly all, are searched once.
    some = text.rlike(pattern) if sign is None else text.contains(sign) & text.rlike(pattern)
    return F.when(some, lengths).otherwise(F.array().cast(PIECE))


def written(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined; spans sort by (start, rank, stop)."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


KEY = ("k1", "k2")  # of id and text: rows that share it are equal


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id``, the key of id and text, and for each kind the pieces of its matches."""
    text = text_of()
    long_hex = r"[0-9a-f]{24,}"  # runs of HEX are maximal, so the short ones can be left out at once
    columns = {
        "assign": pieces_of(text, ASSIGN, 1),
        "access": pieces_of(text, ACCESS, sign="AKIA"),
        "hex": pieces_of(text, long_hex),
        "secret": pieces_of(text, SECRET),
        "user": pieces_of(text, USER),
        "endpoint": pieces_of(text, ENDPOINT, sign="://"),
    }
    keys = [F.xxhash64(F.lit(seed), "doc_id", F.lit(1), text).alias(k) for seed, k in enumerate(KEY)]
    return docs.select("doc_id", *keys, *[c.alias(k) for k, c in columns.items()])


def placed(found: DataFrame) -> DataFrame:
    """(key, rank, start, stop): the spans of each distinct text that has any, by kind."""
    some = found.where(sum((F.size(k) for k in KINDS), F.lit(0)) > 0).dropDuplicates(list(KEY))
    by_kind = F.array(*[F.struct(F.lit(rank).alias("rank"), F.col(kind).alias("pieces")) for rank, kind in enumerate(KINDS)])
    parts = some.select(*KEY, F.inline(by_kind)).select(*KEY, "rank", F.posexplode("pieces").alias("nth", "p")).select(*KEY, "rank", "nth", "p.*")
    # The rows of one text and kind; those after the last match have no length of their own.
    so_far = Window.partitionBy(*KEY, "rank").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stop = F.sum(F.col("skip").cast("long") + F.coalesce("took", F.lit(0))).over(so_far)
    least = F.element_at(F.array(*[F.lit(LEAST.get(kind, 1)) for kind in KINDS]), F.col("rank") + 1)
    return parts.withColumn("stop", stop).where(F.col("judged") >= least).select(*KEY, "rank", (F.col("stop") - F.col("took")).alias("start"), "stop")


def linked(spans: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak spans whose scope holds the parts that they need.

    Each part is put into the bins that its scope touches, each weak span into the bins it covers
    itself; equal bins meet, and the gap decides.
    """
    rank = {kind: KINDS.index(kind) for kind in KINDS}
    role = F.element_at(F.array(*[F.lit(ROLES[kind]) for kind in KINDS]), F.col("rank") + 1)
    bins = lambda lo, hi: F.explode(F.sequence(F.floor(F.greatest(lo, F.lit(0).cast("long")) / scope), F.floor(hi / scope)))
    weak = spans.where(F.col("rank") >= len(BASE)).withColumn("bin", bins(F.col("start"), F.col("stop")))
    helpers = spans.select(F.col("k1").alias("h1"), F.col("k2").alias("h2"), F.col("start").alias("s"), F.col("stop").alias("e"), role.alias("role"))
    # Within a bin one part of a role, start and stop is enough.
    helpers = helpers.withColumn("h_bin", bins(F.col("s") - scope, F.col("e") + scope)).distinct()
    near = (F.col("s") <= F.col("stop") + scope) & (F.col("e") >= F.col("start") - scope)
    met = weak.join(helpers, (F.col("k1") == F.col("h1")) & (F.col("k2") == F.col("h2")) & (F.col("bin") == F.col("h_bin")) & near)
    has = {r: F.max((F.col("role") == r).cast("int")) for r in ("identifier", "secret")}
    judged = met.groupBy(*KEY, "rank", "start", "stop").agg(*[c.alias(r) for r, c in has.items()])
    enough = F.lit(False)
    for kind, roles in NEEDS.items():
        wanted = F.col("rank") == rank[kind]
        for r in roles:
            wanted = wanted & (F.col(r) == 1)
        enough = enough | wanted
    return judged.where(enough).select(*KEY, "rank", "start", "stop")


def op8(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    found = checkpoint(scan(docs.select("doc_id", "text")))
    spans = checkpoint(placed(found))
    is_base = F.col("rank") < len(BASE)
    span = F.struct("start", "rank", "stop")
    every = spans.where(is_base).unionByName(linked(spans, scope)).groupBy(F.col("k1").alias("h1"), F.col("k2").alias("h2")).agg(
        *[F.count_if(F.col("rank") == rank).alias(f"n_{kind}") for rank, kind in enumerate(BASE)],
        F.collect_list(F.when(is_base, span)).alias("base"), F.collect_list(span).alias("every"),
    )
    none = F.array().cast(SPAN)
    return found.select("doc_id", *KEY).join(every, (F.col("k1") == F.col("h1")) & (F.col("k2") == F.col("h2")), "left").select(
        "doc_id", *[F.coalesce(f"n_{kind}", F.lit(0)).cast("long").alias(f"n_{kind}") for kind in BASE],
        F.sha2(written(F.coalesce("base", none)), 256).alias("base_sha256"), written(F.coalesce("every", none)).alias("spans"),
    )
