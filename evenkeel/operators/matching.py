"""Match source to target columns by name, over a column catalog of many table pairs.

All columns of a pair travel once, to the partition of their pair. A pair of few columns becomes one
row there, and every source name is held against every target name: by length, then by a bound on the
edits, and what is left is scored. Nothing else is shuffled for such pairs.

In a wide pair that would be quadratic in the width of the tables. Two names that reach the cutoff
differ by at most some number d of edits. Cut the source name into more than d pieces; then for some
i <= d the i-th piece (from 0) occurs unchanged in the target name with exactly i edits left of it,
so it is moved by at most i, and what follows it by at most d - i. Names are joined on these pieces,
which loses no pair, and only the joined ones are scored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import levenshtein_ratio, name_key, sequence_ratio, sequence_ratios

CUTOFF = 0.90
#: Columns and wishes of a pair up to which all its names are compared; the pieces of one name are about as many.
NARROW = 256
_SLACK = 1e-9


def _most_edits(length: Column, measure: str, cutoff: float) -> Column:
    """Most edits between a name of this length and any other that reaches the cutoff."""
    if measure == "sequence":  # insertions + deletions <= (1 - cutoff) * sum of the lengths
        share = 2 * (1 - cutoff) / cutoff
    else:  # edits <= (1 - cutoff) * longer length
        share = (1 - cutoff) / cutoff
    return F.floor(length * F.lit(share) + F.lit(_SLACK)).cast("int")


def _edits(a: Column, b: Column, measure: str, cutoff: float) -> Column:
    """Most edits between two names of these lengths that reach the cutoff."""
    size = a + b if measure == "sequence" else F.greatest(a, b)
    return F.floor(size * F.lit(1 - cutoff) + F.lit(_SLACK)).cast("int")


def _length_range(length: Column, measure: str, cutoff: float) -> tuple[Column, Column]:
    """Shortest and longest partner of a name of this length."""
    ratio = cutoff / (2 - cutoff) if measure == "sequence" else cutoff
    low = F.ceil(length * F.lit(ratio) - F.lit(_SLACK)).cast("int")
    high = F.floor(length / F.lit(ratio) + F.lit(_SLACK)).cast("int")
    return low, high


def _near(a: Column, b: Column, measure: str, cutoff: float) -> Column:
    """False only for names below the cutoff. Either measure's edits are at least the Levenshtein distance."""
    low, high = _length_range(F.length(a), measure, cutoff)
    edits = _edits(F.length(a), F.length(b), measure, cutoff)
    return F.length(b).between(low, high) & (F.call_function("levenshtein", a, b, edits) >= 0)


def _piece(size: Column, pieces: Column, i: Column) -> tuple[Column, Column]:
    """Start (0-based) and length of the i-th of ``pieces`` nearly equal parts."""
    start = F.floor(size * i / pieces).cast("int")
    end = F.floor(size * (i + F.lit(1)) / pieces).cast("int")
    return start, end - start


def _source_pieces(names: DataFrame, measure: str, cutoff: float) -> DataFrame:
    size = F.length("key")
    most = _most_edits(size, measure, cutoff)
    rows = names.select("pair", "key", "first", size.alias("size"), most.alias("most"))
    rows = rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("most"))))
    start, length = _piece(F.col("size"), F.col("most") + 1, F.col("i"))
    piece = F.substring(F.col("key"), start + 1, length)
    return rows.select(
        F.xxhash64("pair", "size", "i", piece).alias("h"),
        F.col("pair").alias("source_pair"),
        F.col("key").alias("source_key"),
        F.col("first").alias("source"),
    )


def _target_pieces(names: DataFrame, measure: str, cutoff: float) -> DataFrame:
    """The pieces a target name may share with source names of every fitting length."""
    own = F.length("key")
    low, high = _length_range(own, measure, cutoff)
    rows = names.select("pair", "key", "first", F.explode(F.sequence(low, high)).alias("size"))
    rows = rows.withColumn("d", _edits(own, F.col("size"), measure, cutoff))
    rows = rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("d"))))
    pieces = _most_edits(F.col("size"), measure, cutoff) + 1
    start, length = _piece(F.col("size"), pieces, F.col("i"))
    longer = own - F.col("size")
    right = F.col("d") - F.col("i")
    rows = rows.select(
        "pair",
        "key",
        "first",
        "size",
        "i",
        start.alias("start"),
        length.alias("len"),
        F.greatest(-F.col("i"), longer - right, -start).alias("low"),
        F.least(F.col("i"), longer + right, own - length - start).alias("high"),
    )
    shifts = F.explode(F.sequence("low", "high"))
    rows = rows.filter("low <= high").withColumn("shift", shifts)
    piece = F.substring(F.col("key"), F.col("start") + F.col("shift") + 1, F.col("len"))
    return rows.select(
        F.xxhash64("pair", "size", "i", piece).alias("h"),
        "pair",
        F.col("key").alias("target_key"),
        F.col("first").alias("target"),
    )


def keyed_names(catalog: DataFrame, side: str) -> DataFrame:
    """pair, key and the first column (ordinal, column_name) of every name key of one side."""
    rows = catalog.filter(F.col("side") == side).select("pair", "ordinal", "column_name")
    least = F.min(F.struct("ordinal", "column_name")).alias("first")
    # By pair alone, so that similar_keys finds the names of a pair in one place.
    return rows.repartition("pair").groupBy("pair", name_key(F.col("column_name")).alias("key")).agg(least)


def similar_keys(
    source: DataFrame, target: DataFrame, measure: str = "sequence", cutoff: float = CUTOFF
) -> DataFrame:
    """pair, source_key, target_key, source, target, score of all keys that reach the cutoff.

    Both inputs come from ``keyed_names``; ``source`` and ``target`` are their first columns.
    """
    _check(measure, cutoff)
    sources = source.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("pair")))
    few = sources.filter(F.col("n") <= NARROW)
    left, right = (
        df.select("pair", F.col("key").alias(f"{side}_key"), F.col("first").alias(side))
        for df, side in ((few, "source"), (target, "target"))
    )
    # Sizes of counted rows are badly estimated, so a broadcast must not be chosen by them.
    near = right.hint("merge").join(left, "pair")
    near = near.filter(_near(F.col("source_key"), F.col("target_key"), measure, cutoff))
    wide = sources.filter(F.col("n") > NARROW).drop("n")
    pairs = wide.select("pair").distinct()
    found = near.select(_FOUND).unionByName(
        _by_pieces(wide, target.join(pairs.hint("merge"), "pair", "left_semi"), measure, cutoff)
    )
    if measure == "sequence":
        score = sequence_ratio(F.col("source_key"), F.col("target_key"))
    else:
        score = levenshtein_ratio(F.col("source_key"), F.col("target_key"))
    return found.withColumn("score", score).filter(F.col("score") >= cutoff - _SLACK)


_FOUND = ["pair", "source_key", "target_key", "source", "target"]


def _check(measure: str, cutoff: float) -> None:
    if measure not in ("sequence", "levenshtein"):
        raise ValueError(f"measure must be 'sequence' or 'levenshtein', not {measure!r}")
    if not 0.5 <= cutoff <= 1:
        raise ValueError("cutoff must lie between 0.5 and 1")


def _by_pieces(source: DataFrame, target: DataFrame, measure: str, cutoff: float) -> DataFrame:
    """The keys that share a piece where keys that reach the cutoff do."""
    left, right = _source_pieces(source, measure, cutoff), _target_pieces(target, measure, cutoff)
    # Sizes of exploded rows are badly estimated, so a broadcast must not be chosen by them.
    same = (left["h"] == right["h"]) & (left["source_pair"] == right["pair"])
    return left.hint("merge").join(right, same).select(_FOUND).distinct()


def match_columns(
    catalog: DataFrame,
    overrides: DataFrame | None = None,
    *,
    measure: str = "sequence",
    cutoff: float = CUTOFF,
) -> DataFrame:
    """pair, source_column, target_column, match_type for every column of every pair.

    Every source column wants the target of the highest score, the first on ties; a target goes
    to the first source that wants it, and there is no second choice. ``overrides`` (pair,
    source_column, target_column) may then place what is left. match_type is one-to-one, override,
    unmapped_source or unmapped_target. Pairs may be of any width.
    """
    _check(measure, cutoff)
    rows = _rows(catalog, overrides)
    wide = _wide_pairs(rows)
    columns = _columns(rows.join(wide.hint("shuffle_hash"), "pair"))
    return (
        _paired(rows.join(wide.hint("shuffle_hash"), "pair", "left").filter("wide is null"), measure, cutoff)
        .unionByName(_as_mapping(_paired_wide(columns, measure, cutoff)))
        .unionByName(_as_mapping(_without_pair(catalog)))
    )


def _rows(catalog: DataFrame, overrides: DataFrame | None) -> DataFrame:
    """pair and a column or wish of it, dealt out by pair once: narrow pairs need no other shuffle.

    The column is one struct, so that whatever is done with the rows reads the same exchange.
    """
    rows = catalog.filter("pair is not null").select(
        "pair", "side", "column_name", "ordinal", F.lit(None).cast("string").alias("wish"), F.lit(True).alias("listed")
    )
    if overrides is not None:
        known = overrides.filter("pair is not null and source_column is not null")
        none = F.lit(None).cast(catalog.schema["ordinal"].dataType)
        rows = rows.unionByName(
            known.select(
                "pair", F.lit("source").alias("side"), F.col("source_column").alias("column_name"),
                none.alias("ordinal"), F.col("target_column").alias("wish"), F.lit(False).alias("listed"),
            )
        )
    row = F.struct("side", "column_name", "ordinal", "wish", "listed")
    return rows.select("pair", row.alias("row")).repartition("pair")


def _wide_pairs(rows: DataFrame) -> DataFrame:
    """pair and a mark of the pairs of more than ``NARROW`` rows.

    Where there is none, adaptive execution drops all that would be done with them. The greatest hash is
    there for the rows to be read whole, as the others read them.
    """
    counted = rows.groupBy("pair").agg(F.count(F.lit(1)).alias("n"), F.max(F.xxhash64("row")).alias("hash"))
    wide = counted.filter((F.col("n") > NARROW) & F.col("hash").isNotNull())
    # By the count too, or it would be no exchange, whose end tells how many there are.
    return wide.repartition("pair", "n").select("pair", F.lit(True).alias("wide"))


def _columns(rows: DataFrame) -> DataFrame:
    """The columns of wide pairs with the target that is wished for them."""
    name = F.xxhash64("row.side", "row.column_name")
    same = rows.groupBy("pair", name).agg(F.collect_list("row").alias("rows"))
    columns = same.select("pair", F.inline("rows")).groupBy("pair", "side", "column_name").agg(
        F.min(F.when(F.col("listed"), F.struct("ordinal")))["ordinal"].alias("first"),
        F.min("ordinal").alias("ordinal"),
        F.min("wish").alias("wish"),
        F.max("listed").alias("listed"),
    )
    return columns.filter("listed").repartition("pair", "side", "column_name")


def _without_pair(catalog: DataFrame) -> DataFrame:
    """Columns whose pair is not known and that so have no partner."""
    none = F.lit(None).cast("string")
    lost = catalog.filter("pair is null").select("pair", "side", "column_name").distinct()
    return lost.withColumns({"partner": none, "match_type": none})


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often a lambda within uses it."""
    return F.transform(F.array(value), body)[0]


def _firsts(ordered: Column, name: str) -> Column:
    """The first element of each name in an array where those of a name are neighbours."""
    return _let(ordered, lambda o: F.filter(o, lambda x, i: (i == 0) | ~x[name].eqNullSafe(F.get(o, i - 1)[name])))


_SOURCE, _TARGET, _WISH, _OTHER = range(4)


def _gathered(rows: DataFrame, measure: str, cutoff: float) -> DataFrame:
    """One row for each pair: pair and arrays of its sources, targets, wishes and other columns.

    Pairs are grouped by a hash of them first, as texts that begin alike are slow to sort.
    """
    row = F.col("row")
    key = F.when(row["listed"], name_key(row["column_name"]))
    size = F.length(key)
    low, high = _length_range(size, measure, cutoff)
    kind = F.when(~row["listed"], F.lit(_WISH)).when(row["side"] == "source", F.lit(_SOURCE)).when(row["side"] == "target", F.lit(_TARGET))
    packed = F.struct(
        F.coalesce(kind, F.lit(_OTHER)).alias("kind"), key.alias("key"), row["ordinal"].alias("ordinal"), row["column_name"].alias("column_name"),
        size.alias("size"), low.alias("low"), high.alias("high"), _most_edits(size, measure, cutoff).alias("most"),
        row["wish"].alias("wish"), F.when(kind.isNull(), row).alias("row"),
    )
    pairs = rows.select(F.xxhash64("pair").alias("h"), "pair", packed.alias("row")).groupBy("h", "pair").agg(F.collect_list("row").alias("rows"))

    def of(kind: int) -> Column:
        return F.filter("rows", lambda r: r["kind"] == kind)

    wish = F.transform(F.filter("rows", lambda r: (r["kind"] == _WISH) & r["wish"].isNotNull()), lambda r: F.struct(r["column_name"], r["wish"]))
    other = F.transform(of(_OTHER), lambda r: r["row"])
    return pairs.select("pair", of(_SOURCE).alias("source"), of(_TARGET).alias("target"), wish.alias("wish"), other.alias("other"))


def _paired(rows: DataFrame, measure: str, cutoff: float) -> DataFrame:
    """The mapping of narrow pairs, worked out in arrays of ``NARROW`` columns at most.

    Arrays hold flat structs, whose order is quickly told; NULL comes first in it.
    """

    def near(s: Column, t: Column) -> Column:
        fits = (t["size"] >= s["low"]) & (t["size"] <= s["high"])
        return fits & (F.call_function("levenshtein", s["key"], t["key"], s["most"]) >= 0)

    def partners(found: Callable[[Column, Column], Column]) -> Column:
        """What is found for the first columns of two near keys."""
        targets, sources = (_firsts(F.sort_array(side), "key") for side in ("target", "source"))
        return _let(targets, lambda ts: F.flatten(F.transform(
            sources, lambda s: F.transform(F.filter(ts, lambda t: near(s, t)), lambda t: found(s, t))
        )))

    def wanted(s: Column, t: Column, score: Column) -> Column:
        return F.struct(
            s["ordinal"].alias("source_ordinal"), s["column_name"].alias("source_column"), (-score).alias("score"),
            t["ordinal"].alias("target_ordinal"), t["column_name"].alias("target_column"),
        )

    pairs = _gathered(rows, measure, cutoff)
    if measure == "sequence":
        pairs = pairs.withColumn("near", partners(lambda s, t: F.struct(s.alias("s"), t.alias("t"))))
        pairs = pairs.withColumn("scores", sequence_ratios(F.col("near.s")["key"], F.col("near.t")["key"]))
        scored = F.zip_with("near", "scores", lambda n, score: wanted(n["s"], n["t"], score))
    else:
        scored = partners(lambda s, t: wanted(s, t, levenshtein_ratio(s["key"], t["key"])))
    best = _firsts(F.sort_array(F.filter(scored, lambda w: -w["score"] >= cutoff - _SLACK)), "source_column")
    wants = F.transform(best, lambda w: F.struct(w["target_column"], w["source_ordinal"], w["source_column"]))
    pairs = pairs.withColumn("matched", _firsts(F.sort_array(wants), "target_column"))
    pairs = pairs.withColumns({
        "free": F.array_except("source.column_name", "matched.source_column"),
        "open": F.array_except("target.column_name", "matched.target_column"),
    })

    def ordinal(name: Column) -> Column:
        """The least ordinal of a source that is not NULL."""
        return F.array_min(F.transform(F.filter("source", lambda s: s["column_name"] == name), lambda s: s["ordinal"]))

    def meant(places: Column) -> Column:
        """The least wish of each free source, if it is for an open target."""
        wishes = F.filter("wish", lambda w: F.array_contains(places["free"], w["column_name"]))
        wishes = F.filter(_firsts(F.sort_array(wishes), "column_name"), lambda w: F.array_contains(places["open"], w["wish"]))
        return F.transform(wishes, lambda w: F.struct(w["wish"].alias("target_column"), ordinal(w["column_name"]).alias("source_ordinal"), w["column_name"].alias("source_column")))

    placed = _let(F.struct("free", "open"), meant)
    pairs = pairs.withColumn("placed", _firsts(F.sort_array(placed), "target_column"))
    none = F.lit(None).cast("string")

    def mapped(source: Column, target: Column, kind: Column) -> Column:
        return F.struct(source.alias("source_column"), target.alias("target_column"), kind.alias("match_type"))

    def ends(found: str, kind: str) -> Column:
        return F.transform(found, lambda w: mapped(w["source_column"], w["target_column"], F.lit(kind)))

    found = F.concat(
        ends("matched", "one-to-one"),
        ends("placed", "override"),
        F.transform(F.array_except("free", "placed.source_column"), lambda name: mapped(name, none, F.lit("unmapped_source"))),
        F.transform(F.array_except("open", "placed.target_column"), lambda name: mapped(none, name, F.lit("unmapped_target"))),
        F.array_distinct(F.transform("other", lambda r: mapped(none, r["column_name"], F.concat(F.lit("unmapped_"), r["side"])))),
    )
    return pairs.select("pair", F.inline(found))


def _paired_wide(columns: DataFrame, measure: str, cutoff: float) -> DataFrame:
    """Columns of wide pairs with partner and match_type, by pieces of their names."""
    named = columns.withColumn("ordinal", F.col("first"))
    scores = similar_keys(keyed_names(named, "source"), keyed_names(named, "target"), measure, cutoff)
    wanted = scores.groupBy("pair", "source_key").agg(
        F.min(F.struct(-F.col("score"), "target.ordinal", "target.column_name")).alias("best"),
        F.min("source").alias("source"),
    )
    matched = (
        wanted.groupBy("pair", F.col("best.column_name").alias("target_column"))
        .agg(F.min("source").alias("c"))
        .select("pair", F.col("c.column_name").alias("source_column"), "target_column")
        .withColumn("match_type", F.lit("one-to-one"))
    )
    return _placed(_with_partners(columns, matched))


def _with_partners(columns: DataFrame, matched: DataFrame) -> DataFrame:
    """Columns with the partner and match_type they have got, in one shuffle."""
    kept = ["pair", "side", "column_name", "ordinal", "wish"]
    none = F.lit(None).cast("string")

    def end(side: str, column: str, partner: str) -> Column:
        return F.struct(
            F.lit(side).alias("side"),
            F.col(column).alias("column_name"),
            F.col(partner).alias("partner"),
            "match_type",
        )

    ends = F.array(
        end("source", "source_column", "target_column"),
        end("target", "target_column", "source_column"),
    )
    found = matched.select("pair", F.inline(ends))
    rows = columns.select(*kept, none.alias("partner"), none.alias("match_type"))
    return rows.unionByName(found, allowMissingColumns=True).groupBy("pair", "side", "column_name").agg(
        *[F.min(c).alias(c) for c in ("ordinal", "wish", "partner", "match_type")]
    )


def _placed(columns: DataFrame) -> DataFrame:
    """Wishes between columns that are still free; the first source wins a target."""
    free = F.col("partner").isNull() & F.col("pair").isNotNull()
    target, source = free & (F.col("side") == "target"), free & (F.col("side") == "source")
    meets = F.when(target, F.col("column_name")).when(source, F.col("wish"))
    columns = columns.withColumn("meets", meets)
    same = Window.partitionBy("pair", "meets")
    columns = columns.withColumns({
        "taken": F.max(target & F.col("meets").isNotNull()).over(same),
        "won": F.min(F.when(source, F.struct("ordinal", "column_name"))).over(same)["column_name"],
    })
    gets = F.when(target, F.col("won")).when(source & F.col("taken") & (F.col("won") == F.col("column_name")), F.col("wish"))
    gets = F.when(F.col("meets").isNotNull(), gets)
    return columns.select(
        "pair", "side", "column_name", F.coalesce("partner", gets).alias("partner"),
        F.coalesce("match_type", F.when(gets.isNotNull(), F.lit("override"))).alias("match_type"),
    )


def _as_mapping(columns: DataFrame) -> DataFrame:
    """One row per match and per column without one."""
    source = F.col("side") == "source"
    rows = columns.filter(source | F.col("partner").isNull())
    return rows.select(
        "pair",
        F.when(source, F.col("column_name")).alias("source_column"),
        F.when(source, F.col("partner")).otherwise(F.col("column_name")).alias("target_column"),
        F.coalesce("match_type", F.concat(F.lit("unmapped_"), "side")).alias("match_type"),
    )


def backfill(mapping: DataFrame, catalog: DataFrame) -> DataFrame:
    """Give unmapped source columns the target column of exactly the same name, if there is one."""
    targets = (
        catalog.filter("side = 'target'")
        .select("pair", F.col("column_name").alias("source_column"))
        .distinct()
        .withColumn("same_name", F.col("source_column"))
    )
    return mapping.join(targets, ["pair", "source_column"], "left").select(
        "pair",
        "source_column",
        F.coalesce("target_column", "same_name").alias("target_column"),
        "match_type",
    )
