"""Top-k search and main-text extraction on small, odd tables."""

import math
import random

import numpy as np

from evenkeel.llm import dom, maintext, topk


def vectors(spark):
    r = random.Random(2)
    rows = [(i, [r.choice([-1.0, 0.5, r.random()]) for _ in range(6)], 0) for i in range(120)]
    rows += [(200 + i, rows[5][1], 1) for i in range(8)]  # ties
    rows += [(300, None, 1), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (302, [float("nan")] * 6, 1),
             (303, [float("inf")] + [0.0] * 5, 1), (304, [1.0, 2.0], 1), (305, [], 1), (None, rows[1][1], 1)]
    rows.append(rows[7])  # the same row again
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>, score long")


def by_hand(rows, asks, k):
    known = {}
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            known[i] = [math.floor(256 * x) for x in v]
    found = set()
    for q, a in known.items():
        if asks(q):
            other = [(-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in known.items() if i != q and len(a) == len(b)]
            found |= {(q, n, i, -s) for n, (s, i) in enumerate(sorted(other)[:k], 1)}
    return found


def test_search_equals_brute_force(spark):
    rows, df = vectors(spark)
    for block, span in ((256, 8192), (4, 16), (1, 3)):
        found = topk.search(df, df.vec_id % 5 == 0, block_rows=block, span_rows=span)
        got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()]
        wanted = by_hand(rows, lambda q: q % 5 == 0, 5)
        assert set(got) == wanted and len(got) == len(wanted)


def test_search_with_few_rows(spark):
    rows, df = vectors(spark)
    assert topk.search(df.limit(0), df.vec_id >= 0).count() == 0
    few = df.filter("vec_id in (1, 2, 304)")
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.search(few, few.vec_id > 0).collect()}
    assert got == by_hand([r for r in rows if r[0] in (1, 2, 304)], lambda q: True, 5)


BODY = (
    "<article><h1>Caf&eacute; &amp; more</h1><p>The first   paragraph\nof the text, long enough to be read by people.</p>"
    "<p>And a second one with <b>bold</b> words, which also says something about it.</p></article>"
)
TEXT = (
    "Café & more The first paragraph of the text, long enough to be read by people. "
    "And a second one with bold words, which also says something about it."
)


def page(body):
    return (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a>"
        f"</li></ul></nav>{body}<aside><h3>Related</h3><ul><li><a href='/x'>Other</a></li></ul></aside>"
        "<script>var x = 1;</script><footer>&copy; Somebody</footer></body></html>"
    )


def test_pages_of_every_kind(spark):
    rows = [
        (1, "u", page(BODY), "x"), (2, None, None, "x"), (3, "u", "", None), (4, "u", "<p", None), (5, "u", page(BODY), "again"),
        (5, "u", page(BODY), "again"), (None, "u", page(BODY), None), (6, "u", page(BODY.replace("people", "word " * 50_000)), None),
        (7, "u", "<div>" * 3000 + "deep" + "</div>" * 3000, None), (8, "u", "</p></div><<>>&#xZZ;&unknown;", None),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = maintext.extract(df)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = found.collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    assert by[1] == by[5] == by[None] == TEXT
    assert by[2] == by[3] == ""
    assert by[6] == TEXT.replace("people", " ".join(["word"] * 50_000) + " ").replace(" .", " .")
    assert maintext.extract(df.limit(0)).count() == 0


def test_decoding_never_contradicts():
    model = maintext.fitted()
    r = random.Random(11)
    for _ in range(30):
        tree, _, _ = maintext.labelled(maintext.made_page(r))
        kept = maintext.decode(tree, model.odds(np.array(dom.features(tree), float)))
        assert all(not kept[k] or kept[tree.parent[k]] for k in range(1, len(kept)))


def test_fresh_pages_of_the_grammar():
    r, good = random.Random(99), 0
    model = maintext.fitted()
    for _ in range(60):
        made = maintext.made_page(r)
        tree, labels, _ = maintext.labelled(made)
        kept = [bool(x) for x in labels]
        plain = made.replace("\x01", "").replace("\x02", "")
        good += maintext.texts([plain], model)[0] == dom.join_texts(tree, [True, *kept[1:]])
    assert good >= 45


def test_raw_elements_end_at_their_own_tag_in_any_case():
    tree = dom.parse("<p>İ</p><SCRIPT>x('</scripts>', '</p>')</ScRiPt ><p>behind</p><style>a{}</STYLE/><p>last</p><script>open")
    assert [(tree.tags[k], text) for k, text, _ in tree.texts] == [
        ("p", "İ"), ("script", "x('</scripts>', '</p>')"), ("p", "behind"), ("style", "a{}"), ("p", "last"), ("script", "open"),
    ]


def test_deep_pages_with_unmatched_end_tags_take_linear_time():
    import time

    n, start = 100_000, time.process_time()
    tree = dom.parse("<div>" * n + "</x></p></li>" * n + "<p>text")
    assert time.process_time() - start < 2 and len(tree.tags) == n + 2
