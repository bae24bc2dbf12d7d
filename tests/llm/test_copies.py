"""Near copies, repeated passages and shared lines against brute force on small tables."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evenkeel.llm import boilerplate, components, nearcopies, passages, suffixes

rng = random.Random(5)
VOCABULARY = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) for _ in range(300)]


def prose(r, n):
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


def odd_docs(spark):
    """Groups of copies with edits, texts that repeat themselves, shared lines, empty and NULL values, equal rows."""
    r, rows = random.Random(3), []
    base = [prose(r, 80) for _ in range(4)]
    shared = prose(r, 40)
    for i in range(60):
        words = r.choice(base).split()
        for _ in range(r.choice([0, 0, 1, 1, 2, 5])):
            words[r.randrange(len(words))] = r.choice(VOCABULARY)
        text = " ".join(words)
        if i % 5 == 0:
            text += "\n" + shared
        rows.append((i, text, f"s{i % 12}", i))
    rows += [(60 + i, prose(r, 70) + "\n" + shared, f"s{i}", None) for i in range(14)]
    rows += [(80, "spam " * 60, "s1", 1), (81, "ab" * 200, None, 1), (82, "", "s1", 1), (83, None, "s2", 1), (84, None, None, 1),
             (85, "one two", "s1", 1), (86, "one two", "s2", 1), (87, "", "s3", 1), (88, "\n \n", "s3", 1), (89, "é" * 150, "s3", 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_lines long")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60))
def test_suffix_array(symbols):
    assert suffixes.suffix_array(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"the ", b"of", b" ", b"x" * 40, b"\n", b"longerword ", b"y"]), max_size=60), max_size=6))
def test_repeats(parts):
    parts = [b"".join(p) for p in parts]
    seen, wanted = set(), []
    for p in parts:
        wanted.append([])
        for s in range(len(p) - 99):
            wanted[-1].append(p[s : s + 100] in seen)
            seen.add(p[s : s + 100])
    assert [x.tolist() for x in suffixes.repeats(parts, 100)] == wanted


def removed_by_hand(rows):
    seen, found = {}, {}
    for doc, text in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0)):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - 99):
            if raw[s : s + 100] in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.setdefault(raw[s : s + 100], doc)
        found[doc] = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
    return found


@pytest.mark.parametrize("gathered", [100_000, 1])
def test_passages(spark, gathered):
    docs = odd_docs(spark).repartition(4)
    found = {r.doc_id: r for r in passages.remove(docs, gathered=gathered).collect()}
    wanted = removed_by_hand([(r.doc_id, r.text) for r in docs.collect()])
    assert {d: bytes(r.kept) for d, r in found.items()} == wanted
    assert all(r.n_bytes - sum(x.end - x.start for x in r.runs) == len(r.kept) for r in found.values())


def test_passages_with_equal_ids_and_none(spark):
    text = prose(random.Random(1), 60)
    rows = [(1, text), (1, text), (1, "z" + text), (None, text), (2, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id or 0, r.n_bytes, len(r.kept)) for r in passages.remove(docs).collect())
    n = len(text)
    assert found == [(0, n, n), (1, n, 0), (1, n, 0), (1, n + 1, 1), (2, n, 0)]
    assert passages.remove(docs.limit(0)).count() == 0
    # Every text of an id counts, in the order of the texts.
    rows = [(1, "b" * 150), (1, "a" * 150), (2, "b" * 150), (3, "a" * 99 + "c" + "b" * 120), (1, "a" * 150)]
    found = passages.remove(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, bytes(r.kept)) for r in found) == [(1, b"a"), (1, b"a"), (1, b"b"), (2, b""), (3, b"a" * 99 + b"c")]


def bag(text):
    words = (text or "").split()
    width = min(5, len(words))
    found = {}
    for k in range(len(words) - width + 1 if words else 0):
        w = tuple(words[k : k + width])
        found[w] = found.get(w, 0) + 1
    return found


def jaccard(a, b):
    keys = a.keys() | b.keys()
    return sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / max(1, sum(max(a.get(k, 0), b.get(k, 0)) for k in keys))


def test_near_copies_equal_brute_force(spark):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    parent = {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    bags = {d: bag(t) for d, t in rows}
    for d, t in rows:
        for e, u in rows:
            if d < e and t is not None and (t == u or jaccard(bags[d], bags[e]) >= 0.8):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
    found = {r.doc_id: r.class_id for r in nearcopies.classes(docs).collect()}
    assert found == {d: find(d) for d, _ in rows}
    kept = nearcopies.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(found.values()))


def test_near_copies_odd_rows(spark):
    docs = odd_docs(spark)
    again = docs.unionByName(docs.filter("doc_id in (1, 83)"))
    found = [(r.doc_id, r.class_id) for r in nearcopies.classes(again).collect()]
    assert len(found) == again.count() and len(set(found)) == docs.count()
    nameless = docs.selectExpr("cast(null as long) doc_id", "text", "source", "n_lines").limit(3)
    assert nearcopies.keep_one(again.unionByName(nameless)).filter("doc_id is null").count() == 3
    assert nearcopies.classes(docs.limit(0)).count() == 0


def test_signatures_are_unbiased():
    r = np.random.default_rng(1)
    for low, high in ((1, 2), (1, 9), (3, 40)):
        keys = r.integers(0, 2**63, 60).astype(np.uint64)
        a, b = r.integers(low, high, 60), r.integers(low, high, 60)
        a[:10], b[10:20] = 0, 0
        doc = np.repeat([0, 1], 60)
        weight = np.concatenate([a, b])
        keep = weight > 0
        size = 6000
        regs = nearcopies.bag_min_hash(doc[keep], np.concatenate([keys, keys])[keep], weight[keep], 2, size)
        true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert abs((regs[0] == regs[1]).mean() - true) < 4 * np.sqrt(true * (1 - true) / size)
        assert np.isfinite(regs).all()


def test_dissimilar_texts_in_one_bucket_are_all_compared(spark):
    # One band of one register makes huge buckets of unlike texts.
    docs = odd_docs(spark).filter("text is not null")
    coarse = nearcopies.classes(docs, bands=8, rows=1)
    assert coarse.exceptAll(nearcopies.classes(docs)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (100, 300), (7, 7)]
    found = {r.id: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 100, 200: 100, 300: 100}


def test_shared_lines(spark):
    docs = odd_docs(spark)
    for min_sites in (2, 8, 12):
        rows = docs.collect()
        sites, first = {}, {}
        for r in sorted(rows, key=lambda r: r.doc_id):
            for line in (r.text or "").split("\n"):
                line = line.strip(" \t\x0b\x0c\r")
                sites.setdefault(line, set()).add(r.source)
                first.setdefault(line, r.doc_id)
        wanted = {}
        for r in rows:
            lines = [] if r.text is None else r.text.split("\n")
            gone = [bool(x.strip()) and len(sites[x.strip()]) >= min_sites and first[x.strip()] != r.doc_id for x in lines]
            text = None if r.text is None else "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)
            wanted[r.doc_id] = (text, len(lines), sum(gone))
        found = boilerplate.remove(docs, min_sites=min_sites)
        assert found.columns == [*docs.columns, "n_lines_", "n_removed"]
        assert {r.doc_id: (r.text, r["n_lines_"], r.n_removed) for r in found.collect()} == wanted
    cleaned = boilerplate.clean(docs, min_sites=2)
    assert cleaned.columns == docs.columns
    assert boilerplate.clean(docs.limit(0)).count() == 0
    again = docs.unionByName(docs.filter("doc_id = 60"))
    assert boilerplate.remove(again).count() == again.count()


def test_elements_keep_weighted_similarity():
    a, b = np.array([7, 7, 7, 5, 9], np.uint64), np.array([7, 7, 5, 5, 8], np.uint64)
    # Lesser weights 2 + 1, greater ones 3 + 2 + 1 + 1.
    assert nearcopies.similarity(nearcopies.elements(a), nearcopies.elements(b)) == 3 / 7
    none = np.empty(0, np.uint64)
    assert nearcopies.similarity(nearcopies.elements(none), nearcopies.elements(none)) == 0.0


def test_registers_do_not_depend_on_the_batch():
    r = np.random.default_rng(7)
    sizes = np.array([1, 2, 3, 5, 9, 30, 120, 800, *r.integers(1, 4000, 120)])
    assert sizes.sum() > 200_000
    doc = np.repeat(np.arange(len(sizes)), sizes)
    shingle = r.integers(0, 2**63, len(doc)).astype(np.uint64)
    weight = np.where(r.random(len(doc)) < 0.1, r.integers(2, 40, len(doc)), 1)
    together = nearcopies.bag_min_hash(doc, shingle, weight, len(sizes), 252)
    for d in range(30):
        one = doc == d
        alone = nearcopies.bag_min_hash(doc[one] - d, shingle[one], weight[one], 1, 252)
        assert (alone.view(np.uint64) == together[d : d + 1].view(np.uint64)).all()


def test_different_texts_of_one_id_are_texts_of_their_own(spark):
    r = random.Random(11)
    one, other, third = (prose(r, 90) for _ in range(3))
    near = lambda text: text.replace(text.split()[0], "edited", 1)
    rows = [(1, one), (1, other), (1, other), (2, near(other)), (3, near(one)), (4, third), (4, None), (5, third), (6, third + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sorted((x.doc_id, x.class_id) for x in nearcopies.classes(docs).collect())
    assert found == [(1, 1), (1, 1), (1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (5, 4), (6, 4)]
    kept = sorted(((x.doc_id, x.text) for x in nearcopies.keep_one(docs).collect()), key=str)
    assert kept == sorted([(1, one), (1, other), (4, third), (4, None)], key=str)
    twins = spark.createDataFrame([(7, one), (7, near(one))], "doc_id long, text string")
    assert nearcopies.keep_one(twins).count() == 1


def test_odd_sketches_never_rule_out_a_similar_pair(spark):
    r = np.random.default_rng(4)
    pairs = []
    for _ in range(400):
        n = int(r.integers(1, 3000))
        a = r.integers(0, 2**63, n).astype(np.uint64)
        change = int(r.integers(0, max(1, n // 3)))
        b = np.concatenate([a[change:], r.integers(0, 2**63, int(r.integers(0, change + 1))).astype(np.uint64)])
        a, b = nearcopies.elements(a), nearcopies.elements(b)
        x, y = nearcopies.odd_sketch(a), nearcopies.odd_sketch(b)
        pairs.append((nearcopies.similarity(a, b), len(a) + len(b), x.tolist(), y.tolist()))
    frame = spark.createDataFrame(pairs, "s double, n long, x array<long>, y array<long>")
    kept = frame.withColumn("kept", nearcopies.possible(F.col("x"), F.col("y"), F.col("n"), 0.8)).collect()
    assert all(k.kept for k in kept if k.s >= 0.8) and sum(k.s >= 0.8 for k in kept) > 50
    assert sum(not k.kept for k in kept if k.s < 0.7 and k.n < 2500) > 0.9 * sum(k.s < 0.7 and k.n < 2500 for k in kept) > 20
