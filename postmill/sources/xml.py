"""Attribute-style XML dumps: one ``<row .../>`` element per record.

Two layouts:

``lines`` (default)
    One element per line, as the dumps are written. The text scan splits a large
    file into many tasks, so a single huge file still reads on the whole cluster.
    Every line is accounted for: a record, markup around the records, or a line
    that does not fit. A line that does not fit is an error, never a lost row.
``file``
    Any layout of the elements: attributes on lines of their own, or all records on one
    line. The text scan cuts files where a record opens, so one file is read by many tasks
    here too, and each record is parsed by itself. A piece that looks like a record and
    is none is an error, as is a file that is not one complete document: cut off at
    either end, with a second root, or with anything after the end of its root. Within a record
    no element may open whose name begins like the record's.

Attributes are read as text and cast afterwards, because the reader cannot report a
value of the wrong type without failing the job or nulling the value silently.
"""

from __future__ import annotations

import operator
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from postmill.schemas import attribute_schema

LAYOUTS = ("lines", "file")

# Columns added in quarantine mode: why a row was refused, what it looked like, and which
# file it came from. The last two are NULL for a good row.
REASON = "rejected_because"
RAW = "rejected_row"
FILE = "rejected_file"

_FILE_PATH = "_metadata.file_path"

_CORRUPT = "_corrupt_record"
_VALUE = "value"
_TEXT = "text"


def load_rows(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None,
    row_tag: str = "row",
    layout: str = "lines",
    on_bad: str = "fail",
) -> DataFrame:
    """Scan a dump into typed columns named like the attributes with a ``_`` prefix.

    ``schema`` is a table contract without prefixes; ``None`` lets Spark infer one
    (an extra pass, for exploring only). A ``row_tag`` that does not occur gives zero
    rows and no error; :func:`postmill.plans.ingest.ingest` guards against that.

    ``on_bad="fail"`` stops the job at the first bad value. ``on_bad="quarantine"``
    keeps every row and adds columns for :func:`split_rejects`.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")
    if schema is None:
        return spark.read.format("xml").option("rowTag", row_tag).load(path)
    if layout == "lines":
        lines = spark.read.text(path)
        return parse_lines(lines, schema, row_tag, on_bad, file=F.col(_FILE_PATH))
    return _parsed(_pieces(spark, path, row_tag), schema, row_tag, on_bad)


def parse_lines(
    lines: DataFrame,
    schema: StructType,
    row_tag: str = "row",
    on_bad: str = "fail",
    file: Column | None = None,
) -> DataFrame:
    """Parse a ``value`` column holding the lines of a dump.

    ``file`` says where a line came from, if it is known.
    """
    if file is None:
        file = F.lit(None).cast("string")
    # The common form is settled with plain string tests. A raw '<' cannot occur inside
    # an attribute, so a second one means more markup on the line; a split on it runs at
    # memory speed, where a search for its position goes character by character.
    opening = "<" + row_tag
    line = F.trim(F.col(_VALUE))
    plain = (
        line.startswith(opening)
        & F.substring(line, len(opening) + 1, 1).isin(" ", "/")
        & line.endswith("/>")
        & (F.size(F.split(line, "<", 3)) == 2)
    )
    # Generating columns, here and below, keeps filters on them above this step. A filter
    # on a selected column is pushed below it and repeats all that the column is made of.
    tested = F.struct(
        F.when(plain, line).otherwise(F.col(_VALUE)).alias(_VALUE), plain.alias("plain")
    )
    # Patterns decide the rest: other white space, a byte order mark, a closing tag.
    tag = re.escape(row_tag)
    record_line = rf"^[\s\ufeff]*<{tag}(\s[^<]*)?(/>|>\s*</{tag}\s*>)\s*$"
    markup_line = r"^[\s\ufeff]*(<.*>\s*)?$"
    text = F.col(_VALUE)
    other_markup = text.rlike(markup_line) & ~text.rlike(rf"<{tag}[\s/>]")
    kind = (
        F.when(F.col("plain"), "record")
        .when(text.rlike(record_line), "record")
        .when(other_markup, "markup")
        .otherwise("broken")
    )
    bare = F.when(F.col("plain"), text).otherwise(
        F.regexp_replace(text, r"^[\s\ufeff]+", "")
    )
    kept = (
        lines.select(file.alias("file"), F.inline(F.array(tested)))
        .select("file", bare.alias(_VALUE), kind.alias("kind"))
        .where(F.col("kind") != "markup")
    )
    return _parsed(kept, schema, row_tag, on_bad)


def _pieces(spark: SparkSession, path: str | list[str], row_tag: str) -> DataFrame:
    """(file, value, kind): the records of files, and what is wrong with the rest of them.

    Three scans of the text: one finds the first chunk of each file, which no record opens; one cuts
    the records; one gathers, for each file, the little that lies outside of records.
    """
    opening = "<" + row_tag
    chunks = spark.read.text(path, lineSep=opening).select(
        F.col(_FILE_PATH).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        F.col("_metadata.file_size").alias("size"),
        F.col(_VALUE),
    )
    # The scan says nothing of an opening at the very end of a file, but then its bytes are missing.
    known = F.sum(F.octet_length(_VALUE)) + (F.count(F.lit(1)) - 1) * len(opening.encode())
    heads = chunks.groupBy("file").agg(
        F.min(F.struct("block", "id")).alias("first"), (F.max("size") - known == len(opening.encode())).alias("cut_off")
    )
    heads = heads.select(F.col("file").alias("head_file"), F.col("first.id").alias("head_id"), "cut_off")
    # One short row for each file: less than the listing of the files, which the driver holds anyway.
    is_head = (F.col("file") == F.col("head_file")) & (F.col("id") == F.col("head_id"))
    marked = chunks.join(F.broadcast(heads), is_head, "left")
    head = F.col("head_id").isNotNull()
    text = F.when(head, F.col(_VALUE)).otherwise(F.concat(F.lit(opening), F.col(_VALUE)))
    opened = marked.select("file", "block", "id", "cut_off", F.inline(F.array(F.struct(text.alias(_TEXT), head.alias("head")))))

    # No pattern has a loop whose turns grow with the file, as each turn takes stack.
    tag = re.escape(row_tag)
    attributes = r"""(?:\s(?:[^<>"']++|"[^<"]*+"|'[^<']*+')*+)?"""
    content = rf"[^<]*+(?:<(?!/?{tag}[\s/>])[^<]*+)*+"
    # An attribute may hold '>', never '<'.
    record = rf"^<{tag}{attributes}(?:(?<=/)>|>{content}</{tag}\s*>)"
    found = F.when(F.col("head"), "").otherwise(F.regexp_extract(_TEXT, record, 0))
    cut = opened.select("file", "block", "id", "cut_off", "head", _TEXT, F.inline(F.array(F.struct(found.alias("record")))))
    stray = (F.col("record") == "") & F.col(_TEXT).rlike(rf"^<{tag}([\s/>]|$)")
    broken = F.when(F.col("head"), F.col("cut_off")).otherwise(stray)
    kind = F.when(F.col("record") != "", "record").when(broken, "broken")
    value = F.when(F.col("record") != "", F.col("record")).when(F.col("head"), opening).otherwise(F.col(_TEXT))
    judged = F.struct(value.alias(_VALUE), kind.alias("kind"))
    pieces = cut.select("file", F.inline(F.array(judged))).where(F.col("kind").isNotNull())

    outside = F.expr(f"substring({_TEXT}, length(record) + 1)")
    markup = r"<\?[^>]*+>|<!--[\s\S]*?-->|<!(?!--)[^>]*+>"
    outside = F.trim(F.regexp_replace(F.regexp_replace(outside, markup, ""), r"^[\s\ufeff]++|\s++$", ""))
    left = cut.select("file", F.inline(F.array(F.struct("block", "id", outside.alias(_VALUE), broken.alias("broken")))))
    left = left.where((F.col(_VALUE) != "") | F.col("broken")).groupBy("file").agg(
        F.array_sort(F.collect_list(F.struct("block", "id", _VALUE))).alias("parts"), F.count_if("broken").alias("n_broken")
    )
    joined = left.select("file", "n_broken", F.inline(F.array(F.struct(F.array_join(F.col(f"parts.{_VALUE}"), "").alias(_VALUE)))))
    incomplete = joined.where((F.col("n_broken") == 0) & ~_complete(F.col(_VALUE)))
    return pieces.unionByName(incomplete.select("file", _VALUE, F.lit("incomplete").alias("kind")))


def _complete(rest: Column) -> Column:
    """Whether what is left of a file without its records is one root, opened and closed."""
    markup = r"(?:\s*+(?:<\?[^>]*>|<!--[\s\S]*?-->|<![^>]*>))*+\s*+"
    root = F.regexp_extract(rest, rf"^{markup}<([A-Za-z_][^\s/>]*)[^<>]*>", 1)
    closing = F.split(rest, F.concat(F.lit("</\\Q"), root, F.lit("\\E\\s*>")), -1)
    opened = F.split(rest, F.concat(F.lit("<\\Q"), root, F.lit("\\E[\\s/>]")), -1)
    empty_root = rest.rlike(rf"^{markup}<[^<>]*/>{markup}$")
    once = (F.size(closing) == 2) & (F.size(opened) == 2)
    ended = once & F.element_at(closing, -1).rlike(rf"^{markup}$")
    return ((root != "") & (ended | empty_root)) | rest.rlike(r"^\s*$")


def _parsed(kept: DataFrame, schema: StructType, row_tag: str, on_bad: str) -> DataFrame:
    """Parse (file, value, kind), where only a ``record`` is one."""
    record = F.from_xml(
        F.when(F.col("kind") == "record", F.col(_VALUE)), _ddl(_text_schema(schema)), _reader_options(row_tag)
    )
    parsed = kept.select("file", _VALUE, "kind", F.inline(F.array(record)))
    broken = (
        F.when(F.col("kind") == "broken", "not one element per line")
        .when(F.col("kind") == "incomplete", "not one complete document")
    )
    return _typed(parsed, schema, on_bad, broken, raw=F.col(_VALUE), file=F.col("file"))


def split_rejects(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Separate a quarantine-mode scan into typed good rows and raw refused ones."""
    good = rows.where(F.col(REASON).isNull()).drop(REASON, RAW, FILE)
    refused = rows.where(F.col(REASON).isNotNull()).select(REASON, RAW, FILE)
    return good, refused


def _reader_options(row_tag: str) -> dict[str, str]:
    # Spaces inside an attribute are data; the reader trims them unless told not to.
    return {
        "rowTag": row_tag,
        "ignoreSurroundingSpaces": "false",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _CORRUPT,
    }


def _text_schema(schema: StructType) -> StructType:
    names = [*attribute_schema(schema).names, _CORRUPT]
    return StructType([StructField(name, StringType(), True) for name in names])


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _typed(
    records: DataFrame,
    schema: StructType,
    on_bad: str,
    broken: Column,
    raw: Column,
    file: Column,
) -> DataFrame:
    """Cast the text attributes and deal with what does not fit."""
    if on_bad not in ("fail", "quarantine"):
        raise ValueError(f"on_bad must be 'fail' or 'quarantine', not {on_bad!r}")
    fields = list(attribute_schema(schema))
    typed = [f for f in fields if f.dataType != StringType()]
    values = [
        F.col(f.name).try_cast(f.dataType).alias(f.name) if f in typed else F.col(f.name)
        for f in fields
    ]
    # Generated once and then only looked at: text and value of an attribute side by side.
    cast = records.select(
        *[F.col(f.name).alias(_TEXT + f.name) for f in typed],
        broken.alias("broken"),
        F.col(_CORRUPT),
        raw.alias(_VALUE),
        file.alias("file"),
        F.inline(F.array(F.struct(*values))),
    )
    misfits = {
        f.name: F.col(_TEXT + f.name).isNotNull() & F.col(f.name).isNull() for f in typed
    }
    some_misfit = reduce(operator.or_, misfits.values(), F.lit(False))
    # Names are put together only for a row that needs them.
    named = F.concat_ws(", ", *[F.when(bad, name) for name, bad in misfits.items()])
    reason = (
        F.when(F.col("broken").isNotNull(), F.col("broken"))
        .when(F.col(_CORRUPT).isNotNull(), F.lit("malformed XML"))
        .when(some_misfit, F.concat(F.lit("bad value: "), named))
    )
    names = [f.name for f in fields]
    # Generated again: what is made of the reason must not reach the optimizer as a filter
    # over every column, which it would try to restate for each of them.
    if on_bad == "quarantine":
        row = F.struct(
            *names,
            reason.alias(REASON),
            F.when(reason.isNotNull(), F.col(_VALUE)).alias(RAW),
            F.when(reason.isNotNull(), F.col("file")).alias(FILE),
        )
        return cast.select(F.inline(F.array(row)))
    # A generator is never pruned, so even a count of the result checks every row. For the
    # same reason all columns of the contract are parsed and cast, whatever is selected
    # later: who wants a few passes a contract of these. The message shows the head of a row.
    message = F.concat(reason, F.lit(" in "), F.left(F.col(_VALUE), F.lit(500)))
    accepted = F.when(reason.isNull(), F.array(F.struct(*names)))
    return cast.select(F.inline(accepted.otherwise(F.raise_error(message))))
