"""Remove lines that many sites share, by the spread of each line over distinct sites.

Each line hash gets a HyperLogLog sketch of the sites it is seen on; sketches merge in one aggregation, so
a line that stands in a third of all documents costs one row per task. Lines whose estimate is near the
threshold are counted exactly. A line at or above the threshold is boilerplate: it goes from all documents
but the one of least id, so that copies never lose a text altogether.

Lines are split at newlines and compared without outer blanks; lines without a word are never touched.
Defined results: NULL text stays NULL and has no lines; NULL sites count as one site of their own; repeated
rows of a document are cleaned alike; an empty table stays empty; other columns pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh, quoted

#: Blanks that do not count at the ends of a line.
_BLANKS = " \t\x0b\x0c\r"
#: Estimates off the threshold by up to this factor are settled by an exact count.
NEAR = 1.5


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _with_lines(docs: DataFrame, site: str) -> DataFrame:
    """(doc, version, site, pos, line): one row per line. ``version`` tells rows of one id apart."""
    at_most = F.col("text").isNotNull()
    lines = docs.filter(at_most).select(
        F.col("doc_id").alias("doc"),
        F.xxhash64("text").alias("version"),
        F.coalesce(F.col(f"`{site}`").cast("string"), F.lit("\0")).alias("site"),
        F.posexplode(_lines(F.col("text"))).alias("pos", "raw"),
    )
    line = F.btrim("raw", F.lit(_BLANKS))
    # Blank lines get a hash of their own place: they match nothing and crowd no partition.
    hashed = F.when(line != "", F.xxhash64(line)).otherwise(F.xxhash64("doc", "version", "pos"))
    return lines.select("doc", "version", "site", "pos", hashed.alias("line"), (line != "").alias("has_word"))


def spread(docs: DataFrame, *, min_sites: int, site: str = "source", lg_k: int = 12) -> DataFrame:
    """(line, first_doc): hashes of the lines on ``min_sites`` sites or more, and where each stays."""
    lines = _with_lines(docs, site).filter("has_word")
    sketched = lines.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites"),
        F.min("doc").alias("first_doc"),
    )
    possible = cut(sketched.filter(F.col("sites") >= min_sites / NEAR))
    sure = possible.filter(F.col("sites") >= min_sites * NEAR)
    near = possible.filter(F.col("sites") < min_sites * NEAR)
    # Distinct pairs first: afterwards a line has at most one row per site.
    pairs = lines.select("line", "site").distinct()
    counted = pairs.join(near.select("line"), "line", "left_semi").groupBy("line").count()
    exact = counted.filter(F.col("count") >= min_sites).join(near, "line")
    return sure.select("line", "first_doc").unionByName(exact.select("line", "first_doc"))


def remove(
    docs: DataFrame, *, min_sites: int = 8, site: str = "source", lg_k: int = 12
) -> DataFrame:
    """The documents, their text without boilerplate lines, with n_lines and n_removed (or free names)."""
    boiler = cut(spread(docs, min_sites=min_sites, site=site, lg_k=lg_k))
    seen = _with_lines(docs, site).join(boiler.withColumnRenamed("line", "boiler"), F.expr("line = boiler"), "left")
    drop = F.coalesce(~F.col("first_doc").eqNullSafe(F.col("doc")) & F.col("boiler").isNotNull(), F.lit(False))
    marks = (
        seen.select("doc", "version", "pos", drop.alias("drop"))
        .groupBy("doc", "version")
        .agg(
            F.collect_set(F.struct("pos", "drop")).alias("marked"),
            F.bool_or("drop").alias("any"),
        )
        .filter("any")
        .select("doc", "version", F.transform(F.sort_array("marked"), lambda m: m["drop"]).alias("drops"))
    )
    n_lines, n_removed, key, marked = fresh(docs, "n_lines", "n_removed", "key", "marked")
    marks = marks.select(F.struct("doc", "version").alias(f"{key}_of"), F.col("drops").alias(marked))
    keyed = docs.withColumn(key, F.struct(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("version")))
    joined = keyed.join(
        marks,
        F.col(f"`{key}`.doc").eqNullSafe(F.col(f"`{key}_of`.doc"))
        & (F.col(f"`{key}`.version") == F.col(f"`{key}_of`.version")),
        "left",
    )
    drops, text = F.col(f"`{marked}`"), F.col("text")
    kept = F.array_join(F.filter(_lines(text), lambda _, i: ~F.get(drops, i)), "\n")
    return joined.select(
        *(
            F.when(drops.isNull(), text).otherwise(kept).alias("text") if c == "text" else F.col(f"`{c}`")
            for c in docs.columns
        ),
        F.coalesce(F.size(_lines(text)), F.lit(0)).cast("long").alias(n_lines),
        F.coalesce(F.size(F.filter(drops, lambda d: d)), F.lit(0)).cast("long").alias(n_removed),
    )


def clean(docs: DataFrame, **settings) -> DataFrame:
    """The documents without boilerplate lines; those of which no word is left go."""
    marked = remove(docs, **settings)
    removed = F.col(f"`{marked.columns[-1]}`")
    left = F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]"))
    return marked.filter((removed == 0) | left).select(*quoted(docs.columns))


def oracle(min_sites: int = 8) -> str:
    """DuckDB SQL for (doc_id, n_lines, n_removed, n_chars, text_sha256), by exact counts."""
    blanks = "' ' || chr(9) || chr(11) || chr(12) || chr(13)"
    return f"""
with lines as (
  select doc_id, source, generate_subscripts(x, 1) pos, unnest(x) raw
  from (select doc_id, source, string_split(text, chr(10)) x from documents)
), keyed as (select *, trim(raw, {blanks}) line from lines),
boiler as (
  select line, min(doc_id) first_doc from keyed where line <> '' group by line
  having count(distinct coalesce(source, chr(1))) >= {min_sites}
), marked as (
  select k.doc_id, k.pos, k.raw, b.line is not null and b.first_doc <> k.doc_id gone
  from keyed k left join boiler b on k.line = b.line
)
select doc_id, count(*)::bigint n_lines, count(*) filter (gone)::bigint n_removed,
  length(coalesce(string_agg(raw, chr(10) order by pos) filter (not gone), ''))::bigint n_chars,
  sha256(coalesce(string_agg(raw, chr(10) order by pos) filter (not gone), '')) text_sha256
from marked group by doc_id
"""
