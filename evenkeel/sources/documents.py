"""JSON of any layout: lines, arrays and pretty-printed documents, mixed in one folder.

Files are read as text. The first line of a file that is not blank tells its layout: a whole object or array
is a line of records, anything else begins a document that is the file. Layouts stay a frame that is joined to
the lines, so no list of files passes through the driver; lines of a document are put together in their
order. The schema comes from VARIANT values, merged over all records in one aggregation.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space of JSON, and the mark some editors put before the first line.
_BLANK = " \t\r\ufeff"


def _lines(text: DataFrame) -> DataFrame:
    """(file, place, line): lines that are not blank, with their place in the file.

    ``text`` is the folder read as text. One such frame serves all passes, so that its files are listed once.
    """
    # The number of a row in its partition grows along a split.
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("start"), row.alias("row")).alias("place"),
        F.btrim("value", F.lit(_BLANK)).alias("line"),
    ).filter("line <> ''")


def is_whole(text: Column) -> Column:
    """Whether a text is one JSON object or array."""
    return F.json_object_keys(text).isNotNull() | F.json_array_length(text).isNotNull()


def layouts(text: DataFrame) -> DataFrame:
    """(file, by_line, begun): whether its first line is a record, or else at least begins a document."""
    lines = _lines(text).select("file", "place", is_whole(F.col("line")).alias("whole"), "line")
    first = lines.groupBy("file").agg(F.min_by(F.struct("whole", F.left("line", F.lit(2)).alias("begin")), "place").alias("first"))
    begun = F.col("first.begin").startswith("[") | (F.col("first.begin") == "{")
    return first.select("file", F.col("first.whole").alias("by_line"), begun.alias("begun"))


def records(text: DataFrame) -> DataFrame:
    """(record): every line of the files of lines, every other file as a whole."""
    kinds, lines = layouts(text).drop("begun"), _lines(text)
    by_line = lines.join(kinds.filter("by_line").select("file"), "file", "left_semi").select(F.col("line").alias("record"))
    whole = lines.join(kinds.filter("not by_line").select("file"), "file", "left_semi").groupBy("file").agg(
        F.sort_array(F.collect_list(F.struct("place", "line"))).alias("parts")
    )
    document = F.array_join(F.transform("parts", lambda p: p["line"]), "\n")
    return by_line.unionByName(whole.select(document.alias("record")))


def schema_of(found: DataFrame) -> T.StructType:
    """The schema of all records of a frame of ``records``; text where types have nothing in common."""
    value = F.try_parse_json("record")
    each = found.select(value.alias("v")).filter("v is not null")
    listed = F.try_variant_get("v", "$", "array<variant>")
    each = each.select(F.explode(F.coalesce(listed, F.array("v"))).alias("v"))
    text = each.agg(F.schema_of_variant_agg("v").alias("s")).first().s or "VOID"
    if not text.startswith("OBJECT<"):
        return T.StructType()
    for pattern, to in ((r"DECIMAL\(\d+,\s*\d+\)", "DOUBLE"), (r"\b(VOID|VARIANT)\b", "STRING"), (r"OBJECT<", "STRUCT<")):
        # Names stand between backticks; only types are rewritten.
        text = "".join(p if k % 2 else re.sub(pattern, to, p) for k, p in enumerate(re.split(r"(`(?:[^`]|``)*`)", text)))
    return T.StructType.fromDDL(text.removeprefix("STRUCT<").removesuffix(">")) if text != "STRUCT<>" else T.StructType()


def schema_of_documents(spark: SparkSession, path: str) -> T.StructType:
    """The schema that Spark's JSON reader infers where every file is one document.

    Left to open many files itself, the reader hands the list of all of them to each; texts come without it.
    """
    whole = spark.read.text(path, wholetext=True).select(F.btrim("value", F.lit(_BLANK)).alias("document"))
    return spark.read.json(whole.rdd.map(lambda r: r.document)).schema


def read_documents(
    spark: SparkSession, path: str, schema: T.StructType | None = None, text: DataFrame | None = None
) -> DataFrame:
    """The records of every file below the path as rows, whatever its layout; ``text`` is the path read as text.

    A record that is no JSON gives a row of NULLs, as in other reads; an empty array gives none.
    """
    found = records(spark.read.text(path) if text is None else text)
    schema = schema or schema_of(found)
    rows = found.select(F.from_json("record", T.ArrayType(schema)).alias("rows"))
    rows = rows.filter(F.col("rows").isNull() | (F.size("rows") > 0))
    return rows.select(F.explode_outer("rows").alias("row")).select("row.*")


def documents_fail(text: DataFrame) -> DataFrame:
    """(file) of the files that are neither lines of records nor, as a whole, an object or array."""
    kinds = layouts(text).filter("not by_line and not begun")
    lines = _lines(text).join(kinds.select("file"), "file", "left_semi")
    parts = lines.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("place", "line"))).alias("parts"))
    document = F.array_join(F.transform("parts", lambda p: p["line"]), "\n")
    return parts.filter(~is_whole(document)).select("file")
