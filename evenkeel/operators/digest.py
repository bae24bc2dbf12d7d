"""Compare tables by digests first: values travel only where digests differ.

Every row has a 128-bit digest of its canonical key and values. Sums of digests do not depend on order, so
they are formed per bucket of keys before the shuffle; a bucket whose sums agree on both sides holds the same
rows. Buckets are compared level by level: the next level cuts only those that differ, each into finer ones by
further bits of the key's hash, and the rows of the last level's unequal buckets are compared by value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import norm_value
from ..mapping import Mapping
from ..sources.save import settle
from .classify import classify, key_columns, key_exprs

#: Bits of the key's hash by which the levels deal their buckets.
LEVELS = (8, 16)
#: Bits by which rows are sifted before an exact join, 16 MB however many digests there are, and 64-bit words of a row of them.
SIFTED, WORDS = 1 << 27, 16
_SUMS = ["rows", *(f"s{i}" for i in range(4))]


def canonical(df: DataFrame, mapping: Mapping, side: str) -> list[Column]:
    """Canonical texts of the compare columns."""
    return [
        norm_value(F.col(f"`{c.on(side)}`"), c.kind, c.date_format, df.schema[c.on(side)].dataType, mapping.unfit)
        for c in mapping.compare
    ]


def digests(*values: Column) -> list[Column]:
    """Two independent 64-bit hashes of a row."""
    return [F.xxhash64(F.lit(seed), *values).alias(f"d{seed}") for seed in (1, 2)]


def digested(df: DataFrame, mapping: Mapping, side: str, null_keys: str = "equal") -> DataFrame:
    """Keys, the key's hash and the row's digest; no values."""
    keys = key_columns(mapping, null_keys)
    rows = df.select(*key_exprs(df, mapping, side, null_keys), F.array(*canonical(df, mapping, side)).alias("v"))
    return rows.select(*keys, F.xxhash64(*keys).alias("h"), *digests(*keys, F.col("v")))


def _bucket(bits: int) -> Column:
    """The leading bits of the key's hash."""
    return F.shiftrightunsigned("h", 64 - bits)


def bucket_sums(rows: DataFrame, bits: int) -> DataFrame:
    """Rows and digest sums per bucket. Halves of 32 bits are summed, which no number of rows overflows."""
    low = F.lit(0xFFFFFFFF).cast("bigint")
    halves = [
        half for d in ("d1", "d2") for half in (F.col(d).bitwiseAND(low), F.shiftrightunsigned(d, 32))
    ]
    sums = [F.sum(half).alias(f"s{i}") for i, half in enumerate(halves)]
    return rows.groupBy(_bucket(bits).alias("bucket")).agg(F.count(F.lit(1)).alias("rows"), *sums)


def unequal_buckets(source: DataFrame, target: DataFrame, bits: int) -> DataFrame:
    """(bucket, source_rows, target_rows) of the buckets whose sums differ, from frames of ``digested``."""
    left, right = bucket_sums(source, bits), bucket_sums(target, bits)
    left = left.select("bucket", F.struct(*_SUMS).alias("a"))
    right = right.select("bucket", F.struct(*_SUMS).alias("b"))
    both = left.join(right, "bucket", "full_outer").filter(~F.col("a").eqNullSafe(F.col("b")))
    counts = [F.coalesce(F.col(s)["rows"], F.lit(0)).alias(f"{n}_rows") for s, n in (("a", "source"), ("b", "target"))]
    return both.select("bucket", *counts)


def _inside(rows: DataFrame, buckets: DataFrame, bits: int, how: str = "left_semi") -> DataFrame:
    return rows.join(buckets.select(F.col("bucket").alias("_bucket")), _bucket(bits) == F.col("_bucket"), how)


def differing(
    source: DataFrame,
    target: DataFrame,
    mapping: Mapping,
    *,
    levels: tuple[int, ...] = LEVELS,
    null_keys: str = "equal",
) -> list[DataFrame]:
    """The unequal buckets of every level; each level reads only rows of the level above's."""
    if not levels or list(levels) != sorted(set(levels)) or not 0 < levels[0] <= levels[-1] < 64:
        raise ValueError(f"levels must rise from 1 to 63 bits at most: {levels}")
    left, right = (digested(df, mapping, side, null_keys) for df, side in ((source, "source"), (target, "target")))
    found: list[DataFrame] = []
    for k, bits in enumerate(levels):
        if k:
            left, right = (_inside(side, found[-1], levels[k - 1]) for side in (left, right))
        found.append(settle(unequal_buckets(left, right, bits)))
    return found


def classify_by_digest(
    source: DataFrame,
    target: DataFrame,
    mapping: Mapping,
    *,
    levels: tuple[int, ...] = LEVELS,
    null_keys: str = "equal",
) -> DataFrame:
    """The rows of ``slim(classify(…))``: values of both sides are exchanged for unequal buckets only.

    Of equal buckets the keys of one side are counted. A key that occurs more than once is a finding, which
    is compared by value like an unequal bucket.
    """
    unequal = differing(source, target, mapping, levels=levels, null_keys=null_keys)[-1]
    keys, bits = key_columns(mapping, null_keys), levels[-1]
    settled = _inside(digested(source, mapping, "source", null_keys), unequal, bits, "left_anti")
    settled = settle(settled.groupBy("h", *keys).agg(F.count(F.lit(1)).alias("n")))
    repeated = settled.filter("n > 1").select(_bucket(bits).alias("bucket")).distinct()
    chosen = unequal.select("bucket").unionByName(repeated)
    agreed = _inside(settled, repeated, bits, "left_anti")

    def part(df: DataFrame, side: str) -> DataFrame:
        hashed = df.withColumn("h", F.xxhash64(*key_exprs(df, mapping, side, null_keys)))
        return _inside(hashed, chosen, bits).drop("h")

    compared = classify(part(source, "source"), part(target, "target"), mapping, null_keys)
    found = (F.col("state") != "equal") | (F.col("n_src") > 1) | (F.col("n_tgt") > 1)
    compared = compared.withColumns({"src": F.when(found, F.col("src")), "tgt": F.when(found, F.col("tgt"))})
    nothing = {name: F.lit(None).cast(compared.schema[name].dataType) for name in ("src", "tgt")}
    return compared.unionByName(
        agreed.select(
            *keys, F.col("n").alias("n_src"), F.col("n").alias("n_tgt"),
            *[value.alias(name) for name, value in nothing.items()],
            F.array().cast("array<string>").alias("changed"), F.lit("equal").alias("state"),
        )
    )


def _tagged(df: DataFrame, mapping: Mapping, side: str, null_keys: str) -> DataFrame:
    keys = key_columns(mapping, null_keys)
    texts = [v.alias(f"_v{i}") for i, v in enumerate(canonical(df, mapping, side))]
    rows = df.select(*key_exprs(df, mapping, side, null_keys), *texts)
    return rows.select(*rows.columns, *digests(*keys, F.array(*[F.col(f"_v{i}") for i in range(len(texts))])))


def _copies(left: DataFrame, right: DataFrame) -> DataFrame:
    """(digest, s, t): how many equal rows both sides hold; only digests and counts are exchanged."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    marks = left.select("d1", "d2", one.alias("s"), none.alias("t")).unionAll(
        right.select("d1", "d2", none.alias("s"), one.alias("t"))
    )
    return marks.groupBy("d1", "d2").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))


def _place(digest: str) -> tuple[Column, Column, Column]:
    """Where a digest has its bit: row, word and bit of the word."""
    at = F.col(digest).bitwiseAND(F.lit(SIFTED - 1))
    word = F.shiftright(at, 6).bitwiseAND(F.lit(WORDS - 1)).cast("int")
    return F.shiftright(at, 6 + WORDS.bit_length() - 1), word, at.bitwiseAND(F.lit(63)).cast("int")


def _sifted(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose digest is wanted, and a few others: those that share its bit in a bitmap, which is broadcast.

    An exact join may follow, and few of the rows take part in its shuffle.
    """
    row, word, bit = _place("d1")
    marks = wanted.select(row.alias("_row"), word.alias("_word"), bit.alias("_bit")).repartition("_row")
    own = [F.expr(f"bit_or(if(_word = {i}, shiftleft(1L, _bit), 0L))") for i in range(WORDS)]
    bitmap = marks.groupBy("_row").agg(F.array(*own).alias("_words"))
    met = rows.join(F.broadcast(bitmap), row == F.col("_row"))
    return met.filter(F.getbit(F.get("_words", word), bit) == 1).select(*rows.columns)


def bag_differences(
    source: DataFrame, target: DataFrame, mapping: Mapping, *, null_keys: str = "equal"
) -> DataFrame:
    """Copies of rows that have no equal copy on the other side, under canonical texts.

    All rows of a key are compared as a bag: equal copies of one (key, digest) are numbered and pair one to
    one, the copies beyond the other side's number are left over. One row per left-over copy: keys, compare
    columns, ``side`` and ``copy``, its number. Digests and counts alone are shuffled, added up before; the
    values of left-over rows are fetched afterwards, and rows that a bitmap of the unpaired digests rules out
    stay where they are. So the cost is linear, whatever a key's copies.
    """
    left, right = _tagged(source, mapping, "source", null_keys), _tagged(target, mapping, "target", null_keys)
    unpaired = settle(_copies(left, right).filter("s <> t"))

    def leftovers(rows: DataFrame, side: str, own: str, other: str) -> DataFrame:
        values = [c for c in rows.columns if c not in ("d1", "d2")]
        wanted = unpaired.filter(F.col(own) > F.col(other))
        # Rows of one digest are equal, so one of them stands for all.
        found = _sifted(rows, wanted).join(wanted, ["d1", "d2"]).groupBy("d1", "d2", own, other).agg(*[F.first(v).alias(v) for v in values])
        names = [F.col(f"_k{i}").alias(n) for i, n in enumerate(mapping.key_names)]
        names += [F.col(f"_v{i}").alias(n) for i, n in enumerate(mapping.compare_names)]
        return found.select(*names, F.lit(side).alias("side"), F.explode(F.sequence(F.col(other) + 1, F.col(own))).alias("copy"))

    return leftovers(left, "source", "s", "t").unionByName(leftovers(right, "target", "t", "s"))


def bag_summary(source: DataFrame, target: DataFrame, mapping: Mapping, *, null_keys: str = "equal") -> DataFrame:
    """One row: rows of both sides, copies that pair, copies left over on either side."""
    left, right = (digested(df, mapping, side, null_keys) for df, side in ((source, "source"), (target, "target")))
    none = F.lit(0).cast("bigint")
    named = {
        "source_row_count": F.col("s"),
        "target_row_count": F.col("t"),
        "paired_copies": F.least("s", "t"),
        "source_leftovers": F.greatest(F.col("s") - F.col("t"), none),
        "target_leftovers": F.greatest(F.col("t") - F.col("s"), none),
    }
    return _copies(left, right).agg(*[F.coalesce(F.sum(v), none).alias(n) for n, v in named.items()])
