"""Column matching against a plain loop over all pairs of names."""

import random
import re
from difflib import SequenceMatcher

import pytest
from conftest import values

from pyspark.sql import functions as F

from evenkeel.functions.names import sequence_ratio
from evenkeel.operators.drift import CATALOG
from evenkeel.operators.matching import backfill, keyed_names, match_columns, similar_keys
from evenkeel.operators.profile import infer_types
from evenkeel.operators.sharing import match_by_values
from evenkeel.plans.generate import generate_mapping
from evenkeel.queries import matching as queries
from evenkeel.queries.inputs import run


def key(name):
    return re.sub(r"[^a-z0-9]+", "", name.lower())


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, above + (x != y))
    return row[-1]


SCORES = {
    "sequence": lambda a, b: SequenceMatcher(None, a, b, autojunk=False).ratio(),
    "levenshtein": lambda a, b: 1.0 if not a and not b else 1 - distance(a, b) / max(len(a), len(b)),
}


def random_name(rng):
    words = ["order", "customer", "shipment", "id", "number", "date", "total", "amt", "x", "__"]
    return "_".join(rng.choice(words) for _ in range(rng.randint(1, 5)))


def spoiled(rng, name):
    for _ in range(rng.randint(0, 3)):
        at = rng.randint(0, len(name))
        name = rng.choice(
            [name[:at] + rng.choice("abcz") + name[at:], name[:at] + name[at + 1 :], name.upper()]
        )
    return name


def catalog_rows(seed, pairs=4, width=40):
    rng = random.Random(seed)
    rows = []
    for p in range(pairs):
        source = list(dict.fromkeys(random_name(rng) for _ in range(width)))
        target = list(dict.fromkeys(spoiled(rng, n) for n in rng.sample(source, len(source))))
        rows += [(f"p{p}", "source", n, i, "string") for i, n in enumerate(source)]
        rows += [(f"p{p}", "target", n, i, "string") for i, n in enumerate(target)]
    return rows


def loop(rows, score, cutoff, wishes=()):
    found = []
    for pair in sorted({r[0] for r in rows}):
        names = {
            side: [r[2] for r in sorted(rows, key=lambda r: r[3]) if r[0] == pair and r[1] == side]
            for side in ("source", "target")
        }
        taken, open_ = set(), []
        for s in names["source"]:
            best, top = None, -1.0
            for t in names["target"]:
                value = score(key(s), key(t))
                if value > top:
                    best, top = t, value
            if best is not None and top >= cutoff and best not in taken:
                taken.add(best)
                found.append((pair, s, best, "one-to-one"))
            else:
                open_.append(s)
        free, wish = set(names["target"]) - taken, {w[1]: w[2] for w in wishes if w[0] == pair}
        for s in open_:
            if wish.get(s) in free:
                free.discard(wish[s])
                found.append((pair, s, wish[s], "override"))
            else:
                found.append((pair, s, None, "unmapped_source"))
        found += [(pair, None, t, "unmapped_target") for t in free]
    return sorted(found, key=str)


@pytest.mark.parametrize("measure", ["sequence", "levenshtein"])
@pytest.mark.parametrize("cutoff", [0.9, 0.75])
def test_no_similar_pair_is_lost(spark, measure, cutoff):
    rows = catalog_rows(11)
    catalog = spark.createDataFrame(rows, CATALOG)
    found = similar_keys(keyed_names(catalog, "source"), keyed_names(catalog, "target"), measure, cutoff)
    ours = {(r.pair, r.source_key, r.target_key): r.score for r in found.collect()}
    wanted = {}
    for pair, side, name, *_ in rows:
        for other in rows:
            if side == "source" and other[0] == pair and other[1] == "target":
                value = SCORES[measure](key(name), key(other[2]))
                if value >= cutoff - 1e-9:
                    wanted[pair, key(name), key(other[2])] = value
    assert ours.keys() == wanted.keys() and len(wanted) > 50
    assert all(abs(ours[k] - wanted[k]) < 1e-9 for k in wanted)


@pytest.mark.parametrize("measure", ["sequence", "levenshtein"])
def test_match_equals_the_loop(spark, measure):
    rows = catalog_rows(5)
    catalog = spark.createDataFrame(rows, CATALOG)
    rng = random.Random(9)
    targets = {p: [r[2] for r in rows if r[0] == p and r[1] == "target"] for p in {r[0] for r in rows}}
    wishes = [(r[0], r[2], rng.choice(targets[r[0]])) for r in rows if r[1] == "source"]
    plain = match_columns(catalog, measure=measure)
    assert sorted(map(tuple, plain.collect()), key=str) == loop(rows, SCORES[measure], 0.9)
    overrides = spark.createDataFrame(wishes, "pair string, source_column string, target_column string")
    placed = match_columns(catalog, overrides, measure=measure)
    wanted = loop(rows, SCORES[measure], 0.9, wishes)
    assert sorted(map(tuple, placed.collect()), key=str) == wanted
    assert "override" in {w[3] for w in wanted}


def test_customer_names(spark):
    names = {
        "source": "cust_id first_nm city status_cd Join-Date",
        "target": "CUSTID first_name city status joindate extra",
    }
    rows = [("m", s, n, i, "string") for s, ns in names.items() for i, n in enumerate(ns.split())]
    found = match_columns(spark.createDataFrame(rows, CATALOG))
    matched = {r.source_column: r.target_column for r in found.collect() if r.match_type == "one-to-one"}
    assert matched == {"cust_id": "CUSTID", "city": "city", "Join-Date": "joindate"}


def test_backfill(spark):
    catalog = spark.createDataFrame([("a", "target", "x", 0, "string")], CATALOG)
    mapping = spark.createDataFrame(
        [("a", "x", None, "unmapped_source"), ("a", "y", None, "unmapped_source"), ("a", "z", "q", "one-to-one")],
        "pair string, source_column string, target_column string, match_type string",
    )
    found = {r.source_column: r.target_column for r in backfill(mapping, catalog).collect()}
    assert found == {"x": "x", "y": None, "z": "q"}


def test_infer_types(spark):
    df = spark.sql(
        """select * from values
        ('1', '1.5', 'true', '2020-01-01', '1/2/2020', '31-12-2020', '2020-01-01 10:00', '1/2/2020 9:05:07', 'x', '', 1.00, 1.5),
        ('-2', '3', 'FALSE', '2020-02-29', '12/31/2020', '01-01-2020', '2020-01-01 10:00:30', '1/2/2020 19:05', '1', null, 2.00, 2.0)
        as t(i, d, b, day, us, eu, ts, uts, s, nothing, dec_i, dec_d)"""
    )
    found = {r.column_name: (r.data_type, r.date_format) for r in infer_types(df).collect()}
    assert found == {
        "i": ("integer", None),
        "d": ("double", None),
        "b": ("boolean", None),
        "day": ("date", "yyyy-MM-dd"),
        "us": ("date", "M/d/yyyy"),
        "eu": ("date", "dd-MM-yyyy"),
        "ts": ("timestamp", "yyyy-MM-dd H:mm[:ss]"),
        "uts": ("timestamp", "M/d/yyyy H:mm[:ss]"),
        "s": ("string", None),
        "nothing": ("string", None),
        "dec_i": ("integer", None),
        "dec_d": ("double", None),
    }
    assert {r.data_type for r in infer_types(df.limit(0)).collect()} == {"string"}
    blank = spark.sql("select * from values ('1'), ('') t(v)")
    assert infer_types(blank).first().data_type == "integer"
    assert infer_types(blank, blanks="string").first().data_type == "string"
    native = spark.sql("select 1 i, 1.5d d, true b, date'2020-01-01' t, array(1) a, now() ts")
    assert [r.data_type for r in infer_types(native).collect()] == [
        "integer", "double", "boolean", "date", "string", "timestamp",
    ]
    assert values(infer_types(native))[0] == ("a", 4, "string", None)


def test_long_names_score_like_short_ones(spark):
    row = spark.createDataFrame([("ab" * 150, "ba" * 150)], "a string, b string")
    score = row.select(sequence_ratio(F.col("a"), F.col("b"))).first()[0]
    assert score == pytest.approx(2 * 299 / 600)


def test_columns_are_matched_by_values(spark):
    """Renamed columns are found, also small ones; ranges that only contain each other and empty columns are not."""
    source = spark.range(4000).selectExpr(
        "id", "id % 3 small", "cast(id * 1.5 as double) price", "concat('n', id % 700) name", "cast(null as string) none",
        "date_add(date'2020-01-01', cast(id % 300 as int)) day", "array(id) nested",
    )
    target = source.filter("id % 50 <> 0").selectExpr(
        "cast(id as string) x1", "concat(cast(small as string), '.0') x2", "cast(price as decimal(20,4)) x3", "concat(name, ' ') x4",
        "none x5", "cast(day as timestamp_ntz) x6", "cast(id % 900 as string) x7", "nested x8",
    )
    found = {r.source_column: r for r in match_by_values(source, target).collect()}
    pairs = {s: r.target_column for s, r in found.items()}
    assert pairs == {"id": "x1", "small": "x2", "price": "x3", "name": "x4", "day": "x6", "nested": "x8"}
    assert (found["id"].source_values, found["id"].target_values, found["id"].shared_values) == (4000, 3920, 3920)
    assert match_by_values(source.limit(0), target).count() == 0
    assert match_by_values(source.select("none"), target).count() == 0
    for cutoff in (0, 1.5):
        with pytest.raises(ValueError):
            match_by_values(source, target, cutoff)


def test_left_over_columns_of_a_mapping_are_matched_by_values(spark):
    source = spark.range(50).selectExpr("id cust_id", "concat('n', id) nm", "id + 1000 total", "'z' flag")
    target = spark.range(48).selectExpr("id custid", "concat('n', id) full_name", "id + 1000 amount", "id % 7 batch")
    rows = generate_mapping(source, target, values_cutoff=0.8).collect()
    found = {(r.source_column, r.target_column, r.match_type) for r in rows}
    assert found == {
        ("cust_id", "custid", "one-to-one"), ("nm", "full_name", "shared-values"), ("total", "amount", "shared-values"),
        ("flag", None, "unmapped_source"), (None, "batch", "unmapped_target"),
    }
    plain = generate_mapping(source, target)
    assert {r.match_type for r in plain.collect()} == {"one-to-one", "unmapped_source", "unmapped_target"}


@pytest.mark.parametrize("measure", ["sequence", "levenshtein"])
def test_narrow_and_wide_pairs_match_alike(spark, monkeypatch, measure):
    """Pairs whose names are all compared give what the pieces of names give, wishes and odd rows included."""
    draw = random.Random(5)
    rows = [(None, "source", "lost", 1), (None, "target", "lost", 1), ("p0", "source", None, 1), ("p0", "other", "x", 1), ("p0", "source", "__", 2), ("p0", "target", "--", 3)]
    wishes = [("p0", "__", "nothing"), (None, "lost", "lost"), ("p1", None, "odd")]
    for pair, width in (("p0", 3), ("p1", 6), ("p2", 25)):
        names = ["_".join(draw.choice(["order", "price", "customer", "total", "day"]) for _ in range(4)) for _ in range(width)]
        for i, name in enumerate(names):
            other = draw.choice([name.upper(), name + "s", name.replace("e", "", 1), f"zz{i}"])
            rows += [(pair, "source", name, i), (pair, "target", other, None if i == 2 else i)] * draw.choice([1, 2])
            wishes.append((pair, name, draw.choice([other, f"zz{i}", None, "none"])))
    catalog = spark.createDataFrame(rows, "pair string, side string, column_name string, ordinal int")
    overrides = spark.createDataFrame(wishes, "pair string, source_column string, target_column string")
    found = []
    for narrow in (256, 20, 0):
        monkeypatch.setattr("evenkeel.operators.matching.NARROW", narrow)
        names = similar_keys(keyed_names(catalog, "source"), keyed_names(catalog, "target"), measure)
        found.append((values(names), values(match_columns(catalog, overrides, measure=measure))))
    assert found[0] == found[1] == found[2]
    kinds = {r[3] for r in found[0][1]}
    assert kinds == {"one-to-one", "override", "unmapped_source", "unmapped_target", "unmapped_other"}


def test_names_of_narrow_pairs_are_not_cut_into_pieces(spark, tmp_path):
    """What is exchanged grows with the columns, not with the pieces of their names."""
    rows = [(f"p{i}", side, f"customer_order_total_{i}_{k}", k) for i in range(200) for side in ("source", "target") for k in range(3)]
    spark.createDataFrame(rows, "pair string, side string, column_name string, ordinal int").write.parquet(str(tmp_path / "catalog"))
    catalog = spark.read.parquet(str(tmp_path / "catalog"))
    found = match_columns(catalog)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    plan = plan[: plan.index("== Initial Plan ==")]
    assert "Generate explode" not in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("measure, wished", [("levenshtein", True), ("sequence", False)])
def test_the_catalog_is_not_made_for_each_step(spark, measure, wished):
    """Where no pair is wide, the catalog is made once, and once more to look for columns without a pair."""
    rows = [(f"p{i}", side, f"customer_total_{i}_{k}", k) for i in range(60) for side in ("source", "target") for k in range(4)]
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    plain = spark.createDataFrame(rows, "pair string, side string, column_name string, ordinal int")
    wishes = spark.createDataFrame([("p1", "customer_total_1_1", "x")], "pair string, source_column string, target_column string")
    found = match_columns(plain.mapInArrow(counted, plain.schema), wishes if wished else None, measure=measure)
    assert len(found.collect()) == 60 * 4
    assert made.value <= 2 * len(rows)


def test_odd_columns_of_narrow_and_wide_pairs(spark, monkeypatch):
    """Copies with and without an ordinal, sides unknown or other, columns without a pair or a name."""
    rows = [("p", "source", "aaaaa", None), ("p", "source", "aaaaa", 9), ("p", "source", "bbbbb", 5), ("p", "target", "zzzzz", 1)]
    rows += [("p", None, "m", 1), ("p", None, "m", 2), ("p", "other", "n", 1), ("p", "source", None, 3), ("p", "target", None, 3)]
    rows += [(None, "source", "q", i) for i in range(4)] + [(None, "target", "q", 1), (None, None, None, 1)]
    wishes = [("p", "aaaaa", "zzzzz"), ("p", "bbbbb", "zzzzz"), ("p", "bbbbb", None), (None, "q", "q")]
    catalog = spark.createDataFrame(rows, "pair string, side string, column_name string, ordinal int")
    overrides = spark.createDataFrame(wishes, "pair string, source_column string, target_column string")
    wanted = [
        ("p", "bbbbb", "zzzzz", "override"), ("p", "aaaaa", None, "unmapped_source"), ("p", None, None, "unmapped_source"),
        ("p", None, None, "unmapped_target"), ("p", None, "m", None), ("p", None, "n", "unmapped_other"),
        (None, "q", None, "unmapped_source"), (None, None, "q", "unmapped_target"), (None, None, None, None),
    ]
    for narrow in (256, 0):
        monkeypatch.setattr("evenkeel.operators.matching.NARROW", narrow)
        found = match_columns(catalog, overrides, measure="levenshtein")
        assert sorted(map(tuple, found.collect()), key=str) == sorted(wanted, key=str)


def test_names_to_back_fill_from_take_one_join(spark, tmp_path):
    lines = [(1, 1, 1, 7), (1, 2, 2, 8), (2, 1, 3, 9), (2, 2, 4, 6), (None, 3, 1, 7)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "hot bolt"), (2, "old ring"), (3, None)], "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    found = queries._same_names(spark, str(tmp_path))
    assert values(found) == values(run(spark, str(tmp_path), queries._SAME_NAMES))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
