"""

The test tables hold no posts or users, so the real operators run on stand-ins of the
same shape that Spark derives from the whole tables: orders are posts, customers are
users, and so on. Each stand-in is defined twice, here in Spark and below in SQL.
"""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import (  # noqa: E402
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from postmill.functions import blank_to_null, tag_list, timestamp_text  # noqa: E402
from postmill.operators import (  # noqa: E402
    clean_columns,
    count_by,
    label_lookup,
    left_join_dimension,
    merge_rows,
    quality,
    unresolved_rows,
)
from postmill.plans import gold, pipeline, reports, silver  # noqa: E402
from postmill.plans.ingest import ingest  # noqa: E402
from postmill.schemas import contract  # noqa: E402
from postmill.session import pin_utc  # noqa: E402
from postmill.sinks import append_batch, upsert_table, write_table  # noqa: E402
from postmill.sources import (  # noqa: E402
    RAW,
    REASON,
    load_rows,
    lookup_table,
    parse_lines,
    post_types,
    read_seed,
)

OPTIONAL_MODULES = ("postmill.llm", "postmill.llm.queries", "corpus_pipeline")

try:  # the corpus operators may be left out; the other queries stay
    from corpus_pipeline import ORACLE_SQL as PIPELINE_ORACLE
    from corpus_pipeline import run as run_pipeline
    from postmill.llm.queries import ORACLE as LLM_ORACLE
    from postmill.llm.queries import QUERIES as LLM_QUERIES

    LLM_QUERIES = LLM_QUERIES | {"pipeline": run_pipeline}
    LLM_ORACLE = LLM_ORACLE | ({"pipeline": PIPELINE_ORACLE} if PIPELINE_ORACLE else {})
except ModuleNotFoundError as missing:
    if missing.name not in OPTIONAL_MODULES:
        raise
    LLM_QUERIES, LLM_ORACLE = {}, {}

SMOKE_DIR = "/root/testdata/sf0.001"


# --- stand-ins ------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as bronze posts.

    The status gives the type (``P`` is type 11, which has no label). An order of
    unspecified priority has no owner, and one of status ``P`` an owner without a user.
    """
    status, key, date = F.col("o_orderstatus"), F.col("o_orderkey"), F.col("o_orderdate")
    moment = date.cast("timestamp")
    is_question = status == "O"
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )
    orders = table(spark, sf_dir, "orders").join(lines, key == F.col("l_orderkey"), "left")
    priority = F.lower("o_orderpriority")
    return orders.select(
        F.when(is_question, key + 1).alias("AcceptedAnswerId"),
        F.when(is_question, F.col("n_lines")).alias("AnswerCount"),
        F.concat(F.lit("<p>"), priority, F.lit("</p>")).alias("Body"),
        F.when(status == "P", moment).alias("ClosedDate"),
        (F.length("o_orderpriority") - 5).cast("long").alias("CommentCount"),
        F.when(priority == "5-low", moment).alias("CommunityOwnedDate"),
        F.lit("CC BY-SA 4.0").alias("ContentLicense"),
        moment.alias("CreationDate"),
        F.lit(None).cast("long").alias("FavoriteCount"),
        key.alias("Id"),
        moment.alias("LastActivityDate"),
        F.when(status == "F", moment).alias("LastEditDate"),
        F.when(status == "F", F.col("o_orderpriority")).alias("LastEditorDisplayName"),
        F.when(status == "F", F.col("o_custkey")).alias("LastEditorUserId"),
        F.when(status == "P", F.col("o_orderpriority")).alias("OwnerDisplayName"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None))
        .when(status == "P", -F.col("o_custkey") - 1)
        .otherwise(F.col("o_custkey"))
        .alias("OwnerUserId"),
        F.when(status == "F", key - 1).alias("ParentId"),
        F.when(is_question, 1).when(status == "F", 2).otherwise(11).cast("long").alias(
            "PostTypeId"
        ),
        (F.floor(F.col("o_totalprice") / 20000) - 3).cast("long").alias("Score"),
        F.when(
            status != "F",
            F.concat(F.lit("|"), F.translate(priority, "- ", "||"), F.lit("|")),
        ).alias("Tags"),
        F.when(status != "F", F.col("o_orderpriority")).alias("Title"),
        F.when(is_question, F.col("o_custkey")).alias("ViewCount"),
    )


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as bronze users; one market segment stands for a blank location."""
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    joined = F.make_timestamp(
        F.lit(2020), (F.col("c_nationkey") % 12 + 1).cast("int"), F.lit(1), F.lit(0), F.lit(0), F.lit(0)
    )
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("<p>"), "c_name", F.lit("</p>")).alias("AboutMe"),
        (key + 1000).alias("AccountId"),
        joined.alias("CreationDate"),
        F.col("c_name").alias("DisplayName"),
        F.col("c_nationkey").cast("long").alias("DownVotes"),
        key.alias("Id"),
        joined.alias("LastAccessDate"),
        F.when(segment == "BUILDING", "").otherwise(segment).alias("Location"),
        F.floor("c_acctbal").cast("long").alias("Reputation"),
        (F.col("c_nationkey") * 2).cast("long").alias("UpVotes"),
        F.length("c_name").cast("long").alias("Views"),
        F.when(segment == "MACHINERY", "")
        .when(segment != "FURNITURE", F.concat(F.lit("https://example.org/"), "c_name"))
        .alias("WebsiteUrl"),
    )


def staged_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.stg_posts(raw_posts(spark, sf_dir), post_types(spark))


def staged_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.stg_users(raw_users(spark, sf_dir))


def wide_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.posts_users(staged_posts(spark, sf_dir), staged_users(spark, sf_dir))


def tagged_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as tagged posts: the words of the name, the brand and the type are tags.

    A part of size over 45 has no tags, one of size 45 tags without any name in them.
    """
    words = F.concat(
        F.lit("|"), F.translate("p_name", " ", "|"), F.lit("|"), "p_brand", F.lit("||"), "p_type", F.lit("|")
    )
    tags = F.when(F.col("p_size") > 45, None).when(F.col("p_size") == 45, "||").otherwise(words)
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("post_id"), tags.alias("Tags")
    )


def flat(df: DataFrame) -> DataFrame:
    """Arrays and timestamps as text, so that both engines give comparable values."""

    def scalar(field: StructField) -> Column:
        kind = field.dataType.typeName()
        if kind == "array":
            return F.array_join(field.name, "|").alias(field.name)
        if kind.startswith("timestamp"):
            return F.date_format(field.name, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        return F.col(field.name)

    return df.select([scalar(f) for f in df.schema])


def as_dump(df: DataFrame) -> DataFrame:
    """Every row as a line of an attribute-style dump.

    The line is generated, not selected, so that a filter on it does not repeat its making.
    """
    attributes = F.struct(*[F.col(c).cast("string").alias("_" + c) for c in df.columns])
    line = F.to_xml(attributes, {"rowTag": "row", "indent": ""})
    return df.select(F.explode(F.array(F.rtrim(F.translate(line, "\n", " ")))).alias("value"))


# --- queries --------------------------------------------------------------------------


def xml_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as a dump and read back, typed and renamed."""
    customers = table(spark, sf_dir, "customer")
    return parse_lines(as_dump(customers), customers.schema).transform(clean_columns)


def xml_ingest_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts through the dump format: markup, quotes, line breaks, accents."""
    documents = table(spark, sf_dir, "documents")
    return parse_lines(as_dump(documents), documents.schema).transform(clean_columns)


def xml_ingest_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole HTML pages as attribute values."""
    pages = table(spark, sf_dir, "pages")
    return parse_lines(as_dump(pages), pages.schema).transform(clean_columns)


def xml_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts through the whole dump format, NULLs and timestamps included, to silver."""
    bronze = raw_posts(spark, sf_dir)
    parsed = parse_lines(as_dump(bronze), bronze.schema).transform(clean_columns)
    return flat(silver.stg_posts(parsed, post_types(spark)))


def xml_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event lines of which some do not fit the declared types; none is lost."""
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    texts = events.select(
        F.when(kind == "error", F.concat(F.lit("e"), F.col("event_id").cast("string")))
        .otherwise(F.col("event_id").cast("string"))
        .alias("event_id"),
        F.when(kind == "signup", "").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        kind,
        F.col("value").cast("string").alias("value"),
    )
    schema = contract(
        {
            "event_id": LongType(),
            "user_id": LongType(),
            "event_type": StringType(),
            "value": DoubleType(),
        }
    )
    parsed = parse_lines(as_dump(texts), schema, on_bad="quarantine")
    return parsed.groupBy(F.col("_event_type").alias("event_type"), REASON).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("_event_id").alias("n_ids"),
        F.count("_user_id").alias("n_users"),
        F.count(RAW).alias("n_raw"),
    )


def clean_column_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    prefixed = nation.select([F.col(c).alias("_" + c) for c in nation.columns])
    return clean_columns(prefixed)


def normalize_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = tagged_parts(spark, sf_dir).transform(silver.normalize_tags)
    return flat(tagged.withColumn("n_tags", F.array_size("tags_array")))


def event_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = StructType([StructField("code", StringType()), StructField("label", StringType())])
    labels = lookup_table(
        spark, [("view", "Viewed"), ("click", "Clicked"), ("purchase", "Bought")], schema
    )
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return label_lookup(events, labels, "event_type", "code", "label")


def author_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.author_status_counts(wide_posts(spark, sf_dir))


def unresolved_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = staged_posts(spark, sf_dir).select("post_id", "owner_user_id")
    return unresolved_rows(posts, staged_users(spark, sf_dir), "owner_user_id", "user_id")


def top_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.top_tags(tagged_parts(spark, sf_dir).transform(silver.normalize_tags))


def top_tags_by_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ranking when every post is known to occur once."""
    tagged = tagged_parts(spark, sf_dir).transform(silver.normalize_tags)
    return gold.top_tags(tagged, unique_posts=True)


def top_tags_repeated_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts that occur many times, as order lines do, count once per tag."""
    lines = table(spark, sf_dir, "lineitem")
    tags = tag_list(F.concat_ws("|", "l_returnflag", "l_linestatus", "l_returnflag"))
    tagged = lines.select(F.col("l_orderkey").alias("post_id"), tags.alias("tags_array"))
    return gold.top_tags(tagged)


def report_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_tags(top_tags(spark, sf_dir))


def gold_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = gold.top_tags(staged_posts(spark, sf_dir))
    return reports.gold_kpis(wide_posts(spark, sf_dir), tags)


def posts_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.posts_by_year(wide_posts(spark, sf_dir))


def peak_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.peak_year(reports.posts_by_year(wide_posts(spark, sf_dir)))


def score_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.score_bands(wide_posts(spark, sf_dir))


def balance_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands over a double with no zero in it, and NULLs shown apart."""
    balance = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal"))
    scores = table(spark, sf_dir, "customer").select(balance.alias("score"))
    return reports.score_bands(scores, null_band="none")


def unanswered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.unanswered(wide_posts(spark, sf_dir))


def top_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_authors(wide_posts(spark, sf_dir))


def top_author_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_author_accounts(wide_posts(spark, sf_dir))


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = staged_posts(spark, sf_dir).select("post_id", "owner_user_id", "post_type")
    return quality.not_null(posts, "owner_user_id")


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique(table(spark, sf_dir, "lineitem"), "l_orderkey")


def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return quality.accepted_values(events, "event_type", ["view", "click", "purchase", "signup"])


def dq_empty_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = tagged_parts(spark, sf_dir).transform(silver.normalize_tags)
    return quality.no_empty_arrays(tagged, "tags_array").select("post_id")


EVENT_RULES_AS_OF = "2024-01-15 00:00:00"
POST_RULES_AS_OF = "1997-06-30 00:00:00"


def event_rules() -> list[quality.RowRule]:
    as_of = F.lit(EVENT_RULES_AS_OF).cast("timestamp_ntz")
    return [
        *quality.rule_not_null(["event_id", "props"]),
        quality.rule_not_in_future("ts", as_of),
        quality.rule_in_list("event_type", ["view", "click"], level=quality.WARN),
    ]


def judged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    value_missing = F.when(F.col("value") >= 1, F.col("props"))
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", "event_type", value_missing.alias("props")
    )


def dq_row_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with its verdict and the rules it failed."""
    valid, refused = quality.split_by_rules(judged_events(spark, sf_dir), event_rules())
    return valid.select(
        "event_id",
        F.lit("valid").alias("verdict"),
        F.lit("").alias("errors"),
        F.array_join(quality.WARNINGS, ",").alias("warnings"),
    ).unionByName(
        refused.select(
            "event_id",
            F.lit("quarantined").alias("verdict"),
            F.array_join(quality.ERRORS, ",").alias("errors"),
            F.array_join(quality.WARNINGS, ",").alias("warnings"),
        )
    )


def dq_post_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts by verdict and failed rules: late ones are refused, unknown types are warned of."""
    rules = pipeline.post_rules([1, 2], F.lit(POST_RULES_AS_OF).cast("timestamp"))
    valid, refused = quality.split_by_rules(raw_posts(spark, sf_dir), rules)
    names = F.array_join(quality.WARNINGS, ",").alias("warnings")
    judged = valid.select(F.lit("").alias("errors"), names).unionByName(
        refused.select(F.array_join(quality.ERRORS, ",").alias("errors"), names)
    )
    return judged.groupBy("errors", "warnings").agg(F.count(F.lit(1)).alias("n_posts"))


def int_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension joined by a 32-bit key that is NULL for a fifth of the facts."""
    facts = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey")).alias("nation"),
    )
    nations = table(spark, sf_dir, "nation").alias("n")
    joined = left_join_dimension(
        facts.alias("c"), nations, F.col("c.nation"), F.col("n.n_nationkey"), F.col("c.c_custkey")
    )
    return joined.select("c_custkey", "nation", "n_name")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path that all executors see; on one machine a temporary one will do."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
    return f"{folder or tempfile.mkdtemp(prefix='postmill-')}/{name}-{uuid.uuid4().hex}"


def in_scratch(spark: SparkSession, work: Callable[[str], DataFrame]) -> DataFrame:
    """What ``work`` returns from a database of its own, stored; the database is dropped."""
    name, path = f"scratch_{uuid.uuid4().hex}", shared_path(spark, "result")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_path(spark, 'database')}'")
    try:
        work(name).write.parquet(path)
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")
    return spark.read.parquet(path)


def xml_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a stored dump by verdict: valid and refused rows together are all of its lines."""
    users = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") < 0, F.concat(F.lit("x"), F.col("c_custkey").cast("string")))
        .otherwise(F.col("c_custkey").cast("string"))
        .alias("Id"),
        F.col("c_name").alias("DisplayName"),
    )
    path = shared_path(spark, "dump")
    as_dump(users).select("value").write.text(path)
    schema = contract({"Id": LongType(), "DisplayName": StringType()})
    rows = load_rows(spark, path, schema, on_bad="quarantine")
    return rows.groupBy(REASON).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("_Id").alias("n_ids"), F.count(RAW).alias("n_raw")
    )


def seed_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders labelled by a seed that is stored as CSV and read back."""
    path = shared_path(spark, "seed")
    regions = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    regions.write.option("header", True).csv(path)
    seed = read_seed(spark, path, "r_regionkey INT, r_name STRING").where("r_regionkey > 0")
    labelled = label_lookup(table(spark, sf_dir, "nation"), seed, "n_regionkey", "r_regionkey", "r_name")
    return labelled.select("n_nationkey", "r_name")


def posted_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as the text that a dump holds."""
    orders = table(spark, sf_dir, "orders")
    text = timestamp_text(F.col("o_orderdate").cast("timestamp"))
    return orders.select("o_orderkey", text.alias("posted_at"))


def dq_violation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several promises about one table, counted together."""
    checks = quality.TableChecks(
        not_null=("post_id", "owner_user_id"),
        unique=("post_id", "owner_user_id"),
        accepted=(("post_type", ("Question", "Answer")),),
        no_empty_arrays=("tags_array",),
    )
    return quality.count_violations(staged_posts(spark, sf_dir), checks)


def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = tagged_parts(spark, sf_dir).transform(silver.normalize_tags)
    label = F.when(F.size("tags_array") > 0, F.element_at("tags_array", 1))
    return quality.stage_summary(tagged.withColumn("post_type", label))


def dq_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.grain(raw_posts(spark, sf_dir), wide_posts(spark, sf_dir))


def doc_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels, where there are any."""
    documents = table(spark, sf_dir, "documents").alias("d")
    labels = table(spark, sf_dir, "labels").alias("l")
    joined = left_join_dimension(
        documents, labels, F.col("d.doc_id"), F.col("l.doc_id"), spread_by=F.col("d.doc_id")
    )
    state = F.when(F.col("l.doc_id").isNull(), "unlabelled").otherwise("labelled")
    return joined.select(
        F.col("d.doc_id").alias("doc_id"), "lang", "quality", "toxic", state.alias("state")
    )


def doc_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(doc_labels(spark, sf_dir), "state", "n_docs")


def blank_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank against absent: only the blank one becomes NULL."""
    users = raw_users(spark, sf_dir)
    return users.groupBy(blank_to_null(F.col("Location")).alias("location")).agg(
        F.count(F.lit(1)).alias("n_users"), F.count("WebsiteUrl").alias("n_urls")
    )


NEW_KEY_OFFSET = 10_000_000_000


def sent_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All orders; and the open ones at double price with the pending ones as new orders."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    pending = F.col("o_orderstatus") == "P"
    sent = orders.where(F.col("o_orderstatus").isin("O", "P")).select(
        F.when(pending, F.col("o_orderkey") + NEW_KEY_OFFSET).otherwise(F.col("o_orderkey")).alias("o_orderkey"),
        "o_orderstatus",
        (F.col("o_totalprice") * 2).alias("o_totalprice"),
    )
    return orders, sent


def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders; the open ones are sent again at double price, pending ones as new orders."""
    return merge_rows(*sent_orders(spark, sf_dir), ["o_orderkey"])


def upserted(spark: SparkSession, sf_dir: str, **layout) -> DataFrame:
    """The table after the upsert has run twice."""
    orders, sent = sent_orders(spark, sf_dir)

    def work(database: str) -> DataFrame:
        name = f"{database}.orders"
        for source in (orders, sent, sent):
            upsert_table(source, name, "o_orderkey", **layout)
        return spark.table(name).select("o_orderkey", "o_orderstatus", "o_totalprice")

    return in_scratch(spark, work)


def upsert_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upserted(spark, sf_dir)


def upsert_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the partitions of open and pending orders are written anew."""
    return upserted(spark, sf_dir, partition_by=["o_orderstatus"])


def upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upserted(spark, sf_dir, buckets=8)


def refresh_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by brand, overwritten by a table of other columns, and that once more."""
    parts = table(spark, sf_dir, "part")
    by_brand = parts.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n_parts"))

    def work(database: str) -> DataFrame:
        name = f"{database}.brands"
        write_table(parts.select("p_partkey", "p_brand"), name, partition_by=["p_brand"])
        for _ in range(2):
            write_table(by_brand, name)
        return spark.table(name)

    return in_scratch(spark, work)


def append_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in two batches; one was sent before with other rows, and the retry replaces these."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    building = F.col("c_mktsegment") == "BUILDING"

    def work(database: str) -> DataFrame:
        name = f"{database}.customers"
        append_batch(customers, name, "first")
        append_batch(customers.where(~building), name, "second")
        append_batch(customers.where(building), name, "first")
        return spark.table(name).select("c_custkey", "c_mktsegment", "batch_id")

    return in_scratch(spark, work)


def ingest_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dumps of users go through the ingest job, the second one twice: rows, refused rows and ledger."""
    users = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") < 0, F.concat(F.lit("x"), F.col("c_custkey").cast("string")))
        .otherwise(F.col("c_custkey").cast("string"))
        .alias("Id"),
        F.col("c_name").alias("DisplayName"),
        (F.col("c_nationkey") < 10).alias("early"),
    )
    schema = contract({"Id": LongType(), "DisplayName": StringType()})
    paths = {early: shared_path(spark, "dump") for early in (True, False)}
    for early, path in paths.items():
        as_dump(users.where(F.col("early") == early).drop("early")).select("value").write.text(path)

    def work(database: str) -> DataFrame:
        name, refused = f"{database}.users", f"{database}.refused"
        for early, batch in ((True, "early"), (False, "late"), (False, "late")):
            ingest(spark, paths[early], name, schema, write_mode="append", quarantine_table=refused, batch=batch)
        kept = spark.table(name).groupBy("batch_id").agg(F.count("Id").alias("n"), F.sum("Id").alias("total"))
        put_aside = spark.table(refused).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
        noted = spark.table(f"{name}_batches").select("batch_id", F.col("n_rows").alias("n"), F.col("n_refused").alias("total"))
        parts = (("users", kept), ("refused", put_aside.withColumn("total", F.lit(0).cast("long"))), ("ledger", noted))
        rows = [df.select(F.lit(part).alias("part"), "batch_id", "n", "total") for part, df in parts]
        return rows[0].unionByName(rows[1]).unionByName(rows[2])

    return in_scratch(spark, work)


def dq_key_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide table against its posts, and against posts of which one was replaced by another."""
    posts, wide = raw_posts(spark, sf_dir), wide_posts(spark, sf_dir)
    other = posts.withColumn("Id", F.when(F.col("Id") == 1, F.lit(-1)).otherwise(F.col("Id")))
    same, swapped = (quality.key_grain(p, wide, "Id", "post_id") for p in (posts, other))
    return same.select(F.lit("same").alias("posts"), "*").unionByName(swapped.select(F.lit("swapped").alias("posts"), "*"))


def salted_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the name of their part, looked up by part and salt."""
    parts = table(spark, sf_dir, "part").where(F.col("p_partkey") > 10).select("p_partkey", "p_name")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return label_lookup(lines, parts, "l_partkey", "p_partkey", "p_name", salts=8)


def xml_any_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users from documents whose records take several lines each."""
    users = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("_Id"), F.col("c_name").alias("_DisplayName"), F.col("c_mktsegment").alias("Segment")
    )
    path = shared_path(spark, "documents")
    users.repartition(4).write.format("xml").option("rowTag", "row").option("rootTag", "users").save(path)
    schema = contract({"Id": LongType(), "DisplayName": StringType()})
    return clean_columns(load_rows(spark, path, schema, layout="file"))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the tag ranking."""
    return top_tags(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return LLM_QUERIES | {
        "xml_ingest": xml_ingest,
        "xml_ingest_bodies": xml_ingest_bodies,
        "xml_ingest_pages": xml_ingest_pages,
        "xml_to_silver": xml_to_silver,
        "xml_quarantine": xml_quarantine,
        "clean_columns": clean_column_names,
        "normalize_tags": normalize_tags,
        "label_lookup": event_labels,
        "stg_posts": lambda spark, sf_dir: flat(staged_posts(spark, sf_dir)),
        "stg_users": lambda spark, sf_dir: flat(staged_users(spark, sf_dir)),
        "posts_users_obt": lambda spark, sf_dir: flat(wide_posts(spark, sf_dir)),
        "author_status": author_status,
        "unresolved_owners": unresolved_owners,
        "top_tags": top_tags,
        "top_tags_by_row": top_tags_by_row,
        "top_tags_repeated_posts": top_tags_repeated_posts,
        "report_tags": report_tags,
        "gold_kpis": gold_kpis,
        "posts_by_year": posts_by_year,
        "peak_year": peak_year,
        "score_bands": score_bands,
        "balance_bands": balance_bands,
        "unanswered": unanswered,
        "top_authors": top_authors,
        "top_author_accounts": top_author_accounts,
        "dq_not_null": dq_not_null,
        "dq_unique": dq_unique,
        "dq_accepted_values": dq_accepted_values,
        "dq_empty_arrays": dq_empty_arrays,
        "dq_row_rules": dq_row_rules,
        "dq_violation_counts": dq_violation_counts,
        "dq_post_rules": dq_post_rules,
        "int_key_join": int_key_join,
        "xml_file_scan": xml_file_scan,
        "seed_labels": seed_labels,
        "posted_at": posted_at,
        "dq_summary": dq_summary,
        "dq_grain": dq_grain,
        "doc_labels": doc_labels,
        "doc_label_counts": doc_label_counts,
        "blank_locations": blank_locations,
        "upsert_merge": upsert_merge,
        "upsert_whole": upsert_whole,
        "upsert_partitions": upsert_partitions,
        "upsert_buckets": upsert_buckets,
        "refresh_twice": refresh_twice,
        "append_batches": append_batches,
        "ingest_batches": ingest_batches,
        "dq_key_grain": dq_key_grain,
        "salted_labels": salted_labels,
        "xml_any_layout": xml_any_layout,
    }


# --- the same in SQL ------------------------------------------------------------------

_POSTS = """
n_lines as (select l_orderkey, count(*) as n from lineitem group by l_orderkey),
posts as (
  select
    case when o_orderstatus = 'O' then o_orderkey + 1 end as AcceptedAnswerId,
    case when o_orderstatus = 'O' then n end as AnswerCount,
    '<p>' || lower(o_orderpriority) || '</p>' as Body,
    case when o_orderstatus = 'P' then o_orderdate end as ClosedDate,
    cast(length(o_orderpriority) - 5 as bigint) as CommentCount,
    case when o_orderpriority = '5-LOW' then o_orderdate end as CommunityOwnedDate,
    'CC BY-SA 4.0' as ContentLicense,
    o_orderdate as CreationDate,
    cast(null as bigint) as FavoriteCount,
    o_orderkey as Id,
    o_orderdate as LastActivityDate,
    case when o_orderstatus = 'F' then o_orderdate end as LastEditDate,
    case when o_orderstatus = 'F' then o_orderpriority end as LastEditorDisplayName,
    case when o_orderstatus = 'F' then o_custkey end as LastEditorUserId,
    case when o_orderstatus = 'P' then o_orderpriority end as OwnerDisplayName,
    case when o_orderpriority = '4-NOT SPECIFIED' then null
         when o_orderstatus = 'P' then -o_custkey - 1
         else o_custkey end as OwnerUserId,
    case when o_orderstatus = 'F' then o_orderkey - 1 end as ParentId,
    cast(case o_orderstatus when 'O' then 1 when 'F' then 2 else 11 end as bigint) as PostTypeId,
    cast(floor(o_totalprice / 20000) - 3 as bigint) as Score,
    case when o_orderstatus <> 'F'
         then '|' || replace(replace(lower(o_orderpriority), '-', '|'), ' ', '|') || '|' end as Tags,
    case when o_orderstatus <> 'F' then o_orderpriority end as Title,
    case when o_orderstatus = 'O' then o_custkey end as ViewCount
  from orders left join n_lines on o_orderkey = l_orderkey
)"""

_STG_POSTS = (
    _POSTS
    + """,
stg_posts as (
  select Id as post_id, PostTypeId as post_type_id,
    case PostTypeId when 1 then 'Question' when 2 then 'Answer' else 'Unknown' end as post_type,
    ParentId as parent_id, AcceptedAnswerId as accepted_answer_id,
    OwnerUserId as owner_user_id, OwnerDisplayName as owner_display_name,
    LastEditorUserId as last_editor_user_id, LastEditorDisplayName as last_editor_display_name,
    Title as title, Body as body,
    list_filter(string_split(Tags, '|'), lambda tag: tag <> '') as tags_array,
    Score as score, ViewCount as view_count, AnswerCount as answer_count,
    CommentCount as comment_count, FavoriteCount as favorite_count,
    ContentLicense as content_license, CreationDate as creation_date,
    LastActivityDate as last_activity_date, LastEditDate as last_edit_date,
    ClosedDate as closed_date, CommunityOwnedDate as community_owned_date
  from posts
)"""
)

_STG_USERS = """
stg_users as (
  select c_custkey as user_id, c_custkey + 1000 as account_id, c_name as display_name,
    cast(floor(c_acctbal) as bigint) as reputation,
    cast(c_nationkey * 2 as bigint) as up_votes, cast(c_nationkey as bigint) as down_votes,
    cast(length(c_name) as bigint) as profile_views,
    case when c_mktsegment <> 'BUILDING' then c_mktsegment end as location,
    case when c_mktsegment not in ('MACHINERY', 'FURNITURE')
         then 'https://example.org/' || c_name end as website_url,
    make_timestamp(2020, c_nationkey % 12 + 1, 1, 0, 0, 0) as creation_date,
    make_timestamp(2020, c_nationkey % 12 + 1, 1, 0, 0, 0) as last_access_date
  from customer
)"""

_WIDE = (
    _STG_POSTS
    + ","
    + _STG_USERS
    + """,
wide as (
  select post_id, post_type, parent_id, title, tags_array, score, view_count, answer_count,
    comment_count, p.creation_date as post_creation_date, owner_user_id, user_id, display_name,
    reputation, up_votes, down_votes, profile_views as user_profile_views,
    location as user_location, website_url as user_website_url,
    u.creation_date as user_creation_date, u.last_access_date as user_last_access_date,
    case when owner_user_id is null then 'anonymous'
         when user_id is null then 'unresolved' else 'resolved' end as author_status
  from stg_posts p left join stg_users u on owner_user_id = user_id
)"""
)

_PARTS = """
parts as (
  select p_partkey as post_id,
    list_filter(string_split(
      case when p_size > 45 then null when p_size = 45 then '||'
           else '|' || replace(p_name, ' ', '|') || '|' || p_brand || '||' || p_type || '|' end,
      '|'), lambda tag: tag <> '') as tags_array
  from part
)"""

_TOP_TAGS = """
exploded as (select post_id, unnest(tags_array) as tag from {0} where tags_array is not null),
top_tags as (
  select tag, count(distinct post_id) as post_count from exploded
  group by tag order by post_count desc, tag limit 100
)"""

_BY_YEAR = """
by_year as (
  select cast(extract(year from post_creation_date) as integer) as year,
    count(*) filter (where post_type = 'Question') as questions,
    count(*) filter (where post_type = 'Answer') as answers,
    count(*) as posts
  from wide group by 1
)"""

_DATE_TIME = "'%Y-%m-%d %H:%M:%S'"

_BANDS = """
select band_order, b.band as band, count(s.band) as posts
from (values (0, 'negative'), (1, 'zero'), (2, '1-4'), (3, '5-19'), (4, '20+'){0}) b(band_order, band)
left join (
  select case {1} when score < 0 then 'negative' when score = 0 then 'zero'
              when score between 1 and 4 then '1-4' when score between 5 and 19 then '5-19'
              else '20+' end as band
  from {2}) s on s.band = b.band
group by band_order, b.band"""


_STG_POSTS_FLAT = f"""
with {_STG_POSTS}
select * replace (
  array_to_string(tags_array, '|') as tags_array,
  strftime(creation_date, {_DATE_TIME}) as creation_date,
  strftime(last_activity_date, {_DATE_TIME}) as last_activity_date,
  strftime(last_edit_date, {_DATE_TIME}) as last_edit_date,
  strftime(closed_date, {_DATE_TIME}) as closed_date,
  strftime(community_owned_date, {_DATE_TIME}) as community_owned_date)
from stg_posts"""


_UPSERTED = f"""
with source as (
  select case when o_orderstatus = 'P' then o_orderkey + {NEW_KEY_OFFSET} else o_orderkey end as o_orderkey,
    o_orderstatus, o_totalprice * 2 as o_totalprice
  from orders where o_orderstatus in ('O', 'P'))
select o_orderkey, o_orderstatus, o_totalprice from orders
where o_orderkey not in (select o_orderkey from source)
union all select o_orderkey, o_orderstatus, o_totalprice from source"""


def oracle_sql() -> dict[str, str]:
    parts_tags = _PARTS + "," + _TOP_TAGS.format("parts")
    return LLM_ORACLE | {
        "xml_ingest": "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer",
        "xml_ingest_bodies": "select doc_id, text, lang, source, n_chars from documents",
        "xml_ingest_pages": "select page_id, url, html from pages",
        "xml_quarantine": """
select event_type,
  case event_type when 'error' then 'bad value: _event_id'
                  when 'signup' then 'bad value: _user_id' end as rejected_because,
  count(*) as n_rows,
  count(*) filter (where event_type <> 'error') as n_ids,
  count(*) filter (where event_type <> 'signup') as n_users,
  count(*) filter (where event_type in ('error', 'signup')) as n_raw
from events group by event_type""",
        "clean_columns": "select n_nationkey, n_name, n_regionkey from nation",
        "normalize_tags": f"""
with {_PARTS}
select post_id, array_to_string(tags_array, '|') as tags_array,
  cast(len(tags_array) as integer) as n_tags
from parts""",
        "label_lookup": """
select event_id, event_type, case event_type when 'view' then 'Viewed' when 'click' then 'Clicked'
  when 'purchase' then 'Bought' else 'Unknown' end as label
from events""",
        "xml_to_silver": _STG_POSTS_FLAT,
        "stg_posts": _STG_POSTS_FLAT,
        "stg_users": f"""
with {_STG_USERS}
select * replace (
  strftime(creation_date, {_DATE_TIME}) as creation_date,
  strftime(last_access_date, {_DATE_TIME}) as last_access_date)
from stg_users""",
        "posts_users_obt": f"""
with {_WIDE}
select * replace (
  array_to_string(tags_array, '|') as tags_array,
  strftime(post_creation_date, {_DATE_TIME}) as post_creation_date,
  strftime(user_creation_date, {_DATE_TIME}) as user_creation_date,
  strftime(user_last_access_date, {_DATE_TIME}) as user_last_access_date)
from wide""",
        "author_status": f"""
with {_WIDE}
select author_status, count(*) as posts from wide group by 1 order by posts desc, author_status""",
        "unresolved_owners": f"""
with {_STG_POSTS}, {_STG_USERS}
select post_id, owner_user_id from stg_posts
where owner_user_id is not null and owner_user_id not in (select user_id from stg_users)""",
        "top_tags": f"with {parts_tags} select * from top_tags",
        "top_tags_by_row": f"with {parts_tags} select * from top_tags",
        "top_tags_repeated_posts": """
with tagged as (
  select l_orderkey, l_returnflag as tag from lineitem
  union all select l_orderkey, l_linestatus from lineitem)
select tag, count(distinct l_orderkey) as post_count from tagged
group by tag order by post_count desc, tag limit 100""",
        "report_tags": f"with {parts_tags} select * from top_tags order by post_count desc, tag limit 15",
        "gold_kpis": f"""
with {_WIDE}, {_TOP_TAGS.format("stg_posts")},
totals as (
  select count(*) as posts,
    count(*) filter (where post_type = 'Question') as questions,
    count(*) filter (where post_type = 'Answer') as answers,
    count(distinct owner_user_id) as authors,
    cast(cast(min(post_creation_date) as date) as varchar) as first_post,
    cast(cast(max(post_creation_date) as date) as varchar) as last_post,
    count(*) filter (where post_type = 'Question' and coalesce(answer_count, 0) = 0) as unanswered
  from wide
)
select *, questions - unanswered as answered,
  cast(questions - unanswered as double) / cast(questions as double) * 100e0 as answered_pct,
  cast(answers as double) / cast(questions as double) as answers_per_question,
  substring(first_post, 1, 4) as first_year, substring(last_post, 1, 4) as last_year,
  (select count(*) from top_tags) as tags_ranked
from totals""",
        "posts_by_year": f"with {_WIDE}, {_BY_YEAR} select * from by_year order by year",
        "peak_year": f"with {_WIDE}, {_BY_YEAR} select * from by_year order by posts desc, year limit 1",
        "score_bands": f"with {_WIDE} " + _BANDS.format("", "", "wide"),
        "balance_bands": """
with scores as (
  select case when c_mktsegment <> 'BUILDING' then c_acctbal end as score from customer) """
        + _BANDS.format(", (5, 'none')", "when score is null then 'none'", "scores"),
        "unanswered": f"""
with {_WIDE}
select count(*) as unanswered from wide
where post_type = 'Question' and coalesce(answer_count, 0) = 0""",
        "top_authors": f"""
with {_WIDE}
select display_name, count(*) as posts, max(reputation) as reputation from wide
where display_name is not null group by 1 order by posts desc, display_name limit 10""",
        "top_author_accounts": f"""
with {_WIDE}
select user_id, display_name, count(*) as posts, max(reputation) as reputation from wide
where display_name is not null group by 1, 2 order by posts desc, user_id limit 10""",
        "dq_not_null": f"""
with {_STG_POSTS}
select post_id, owner_user_id, post_type from stg_posts where owner_user_id is null""",
        "dq_unique": "select l_orderkey, count(*) as n_rows from lineitem group by 1 having count(*) > 1",
        "dq_accepted_values": """
select event_id, event_type from events
where event_type not in ('view', 'click', 'purchase', 'signup')""",
        "dq_empty_arrays": f"""
with {_PARTS} select post_id from parts where tags_array is not null and len(tags_array) = 0""",
        "dq_row_rules": f"""
with judged as (
  select event_id,
    concat_ws(',', case when value < 1 then 'props_is_null' end,
                   case when ts > timestamp '{EVENT_RULES_AS_OF}' then 'ts_in_future' end) as errors,
    case when event_type not in ('view', 'click') then 'event_type_not_in_list' else '' end as warnings
  from events)
select event_id, case when errors = '' then 'valid' else 'quarantined' end as verdict, errors, warnings
from judged""",
        "dq_post_rules": f"""
select case when o_orderdate > timestamp '{POST_RULES_AS_OF}' then 'CreationDate_in_future' else '' end as errors,
  case when o_orderstatus = 'P' then 'PostTypeId_not_in_list' else '' end as warnings, count(*) as n_posts
from orders group by 1, 2""",
        "int_key_join": """
select c_custkey, nation, n_name
from (select c_custkey, case when c_mktsegment <> 'BUILDING' then c_nationkey end as nation from customer)
left join nation on nation = n_nationkey""",
        "xml_file_scan": """
select case when c_acctbal < 0 then 'bad value: _Id' end as rejected_because, count(*) as n_rows,
  count(*) filter (where c_acctbal >= 0) as n_ids, count(*) filter (where c_acctbal < 0) as n_raw
from customer group by 1""",
        "seed_labels": """
select n_nationkey, coalesce(r_name, 'Unknown') as r_name
from nation left join (select * from region where r_regionkey > 0) on n_regionkey = r_regionkey""",
        "posted_at": """
select o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') as posted_at from orders""",
        "dq_violation_counts": f"""
with {_STG_POSTS}
select 'not_null' as "check", 'post_id' as column_name, count(*) filter (where post_id is null) as violations from stg_posts
union all select 'not_null', 'owner_user_id', count(*) filter (where owner_user_id is null) from stg_posts
union all select 'accepted_values', 'post_type', count(*) filter (where post_type not in ('Question', 'Answer')) from stg_posts
union all select 'no_empty_arrays', 'tags_array', count(*) filter (where len(tags_array) = 0) from stg_posts
union all select 'unique', 'post_id', count(*) from (select post_id from stg_posts where post_id is not null group by 1 having count(*) > 1)
union all select 'unique', 'owner_user_id', count(*) from (select owner_user_id from stg_posts where owner_user_id is not null group by 1 having count(*) > 1)""",
        "dq_summary": f"""
with {_PARTS}
select count(*) as n_rows,
  count(*) filter (where tags_array is null or len(tags_array) = 0) as null_labels,
  count(*) filter (where len(tags_array) = 0) as empty_arrays
from parts""",
        "dq_grain": f"""
with {_WIDE}
select (select count(*) from posts) as source_rows, (select count(*) from wide) as result_rows,
  (select count(*) from posts) = (select count(*) from wide) as same_grain""",
        "doc_labels": """
select d.doc_id as doc_id, lang, quality, toxic,
  case when l.doc_id is null then 'unlabelled' else 'labelled' end as state
from documents d left join labels l on d.doc_id = l.doc_id""",
        "doc_label_counts": """
select case when l.doc_id is null then 'unlabelled' else 'labelled' end as state, count(*) as n_docs
from documents d left join labels l on d.doc_id = l.doc_id group by 1""",
        "blank_locations": """
select case when c_mktsegment <> 'BUILDING' then c_mktsegment end as location,
  count(*) as n_users, count(*) filter (where c_mktsegment <> 'FURNITURE') as n_urls
from customer group by 1""",
        **dict.fromkeys(("upsert_merge", "upsert_whole", "upsert_partitions", "upsert_buckets"), _UPSERTED),
        "refresh_twice": "select p_brand, count(*) as n_parts from part group by 1",
        "append_batches": """
select c_custkey, c_mktsegment, case when c_mktsegment = 'BUILDING' then 'first' else 'second' end as batch_id from customer""",
        "ingest_batches": """
with users as (
  select case when c_nationkey < 10 then 'early' else 'late' end as batch_id, c_custkey, c_acctbal >= 0 as good from customer),
counted as (
  select batch_id, count(*) filter (where good) as n_good, cast(sum(c_custkey) filter (where good) as bigint) as total,
    count(*) filter (where not good) as n_bad
  from users group by 1)
select 'users' as part, batch_id, n_good as n, total from counted
union all select 'refused', batch_id, n_bad, 0 from counted
union all select 'ledger', batch_id, n_good, n_bad from counted""",
        "dq_key_grain": """
select 'same' as posts, count(*) as source_rows, count(*) as result_rows, true as same_grain from orders
union all select 'swapped', count(*), count(*), count(*) filter (where o_orderkey = 1) = 0 from orders""",
        "salted_labels": """
select l_orderkey, l_linenumber, l_partkey, coalesce(p_name, 'Unknown') as p_name
from lineitem left join (select * from part where p_partkey > 10) on l_partkey = p_partkey""",
        "xml_any_layout": "select c_custkey as Id, c_name as DisplayName from customer",
    }
