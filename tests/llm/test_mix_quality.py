"""Mixing and quality rules on small, odd tables."""

import pytest

from evenkeel.llm import mixing, quality


def odd_docs(spark):
    rows = [(i, "word " * (20 + i % 7), "big" if i % 3 else f"s{i % 5}", 1) for i in range(90)]
    rows += [(100, None, "big", 1), (101, "", None, 1), (102, " \n", "blank", 1), (103, "one", None, None), (None, "no id", "big", 1),
             (104, "a b c d e f " * 5000, "s1", 1), (5, "word " * 25, "big", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, epoch int")


def test_mix_keeps_columns_and_bounds_repeats(spark):
    docs = odd_docs(spark)
    drawn = mixing.mix(docs, value=4.0)
    assert drawn.columns[:4] == docs.columns and drawn.columns[4:] == ["n_tokens", "epoch_", "block", "draw_order"]
    rows = drawn.collect()
    assert max(r["epoch_"] for r in rows) <= 3
    # Without a budget every document is used, as often as it stands there.
    firsts = sorted(str((r.doc_id, r.text)) for r in rows if r["epoch_"] == 0)
    assert firsts == sorted(str((r.doc_id, r.text)) for r in docs.collect())
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mix_meets_a_budget(spark):
    docs = odd_docs(spark).filter("doc_id < 90")
    tokens = sum(r.n_tokens for r in mixing.mix(docs, target="entropy", value=0.9, budget=1500).collect())
    assert 1500 <= tokens <= 1500 + 27 * 6
    with pytest.raises(ValueError):
        mixing.mix(docs, target="share")


def by_hand(text):
    words = (text or "").replace("\n", " ").split(" ")
    words = [w for w in words if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = {}
    for w in windows:
        counts[w] = counts.get(w, 0) + 1
    repeated = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        dup += bool(line.strip()) and line in seen
        seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for w in words for c in w), dup, len(repeated)


def test_quality_counts_equal_brute_force(spark):
    good = " ".join(f"plain{i} text with word{i} number{i}" for i in range(40))
    texts = [None, "", " \n ", "one", "a b c", "a b c a b c", "x x x x x", "l\nl\n\nl m\nl", "# $ é|< 🤷 " * 30, good, good + "\n" + good,
             "w " * 50_000, "é" * 30_000]
    docs = spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)] + [(None, good, None)], "doc_id long, text string, kept boolean")
    rows = quality.judge(docs).select(*quality.COLUMNS).collect()
    found = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts) + 1
    for i, text in enumerate([*texts]):
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == by_hand(text), i
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert found[9].kept and found[None].kept
    assert quality.judge(docs.limit(0)).count() == 0


def test_one_source_and_equal_sources(spark):
    rows = [(i, "a b c", "only") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for options in ({"target": "entropy", "value": 0.9}, {"value": 2.0}, {"target": "entropy", "value": 1.0, "share": 1.0}):
        assert sorted(r.doc_id for r in mixing.mix(docs, **options).collect()) == [0, 1, 2, 3, 4]
    equal = docs.unionByName(docs.selectExpr("doc_id + 10 doc_id", "text", "'other' source"))
    assert mixing.mix(equal, target="entropy", value=1.0).count() == 10
    half = mixing.mix(equal, value=1.5, share=0.5).collect()
    assert 15 <= sum(r.n_tokens for r in half) <= 21
    with pytest.raises(ValueError):
        mixing.mix(docs, budget=3, share=0.5)


def test_the_exponent_lies_between(spark):
    """Under the limit of the query the exponent is found by bisection: neither equal weights nor plain shares."""
    from evenkeel.llm.queries import REPEATS

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    tokens = docs.selectExpr("source", "size(split(trim(text), '[ \\t\\n\\r]+')) n").groupBy("source").agg({"n": "sum"}).collect()
    total = sum(r[1] for r in tokens)
    sources = spark.createDataFrame([(r[1], total) for r in tokens], "tokens long, all_tokens long")
    assert 0.1 < mixing.solve(sources, target="repeats", value=REPEATS) < 0.9


def test_the_query_draws_every_document(spark, tmp_path):
    from evenkeel.llm.queries import mixing_weights

    rows = [(i, f"s{i % 4}", "word " * (20 + 10 * (i % 4) + i % 7)) for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    drawn = mixing_weights(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in drawn} == set(range(200))
    words = sum(len(text.split()) for _, _, text in rows)
    assert 3 * words <= sum(r.n_tokens for r in drawn) <= 3 * words + 4 * 60
