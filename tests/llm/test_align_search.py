"""Backtracking BPE against the library, alignment and ranked search against brute force, on odd tables too."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from evenkeel.llm import alignment, ranked, wordbpe

WORD, A, B = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
SF = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "\n\n  \n", "a", "a" * 5000, " " * 3000, "don't  Stop\t\x1c\x1f\x85x", "<|endoftext|> <unk> <s>x",
    "naïve Ünïcode ʼn ① ½ ٣ 漢字かな 🤷🏽‍♀️ é", "x\x00y );\r\n {\r", "ΣΑΣ ς İx", "1234567890 12,345.67", "wort " * 4000,
    "▁x here", "the<|startoftext|>cat <|ENDOFTEXT|>", "x ", "x  ", "</w> </w>", "the cat sat", "the cat sat",
]


def odd_docs(spark):
    rows = [(i, t, "x", None) for i, t in enumerate(ODD)] + [(3, "the other text", "again", 1), (None, "no id", None, 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, score long")


def sha(data):
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def words():
    own = Tokenizer.from_file(WORD)
    own.no_truncation()
    own.no_padding()
    return own


_CODEC = wordbpe.Codec(open(WORD, encoding="utf-8").read())
_WORDS = Tokenizer.from_file(WORD)
_WORDS.no_truncation()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=60) | st.text("abehtinsr'LD 1.é<|>", max_size=60), max_size=6))
def test_backtracking_equals_the_library(texts):
    for text, ids in zip(texts, _CODEC.encode(texts), strict=True):
        wanted = _WORDS.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == wanted
        assert _CODEC.decode(ids).decode() == _WORDS.decode(wanted, skip_special_tokens=False)


def test_backtracking_frames(spark, words):
    found = {tuple(r) for r in wordbpe.round_trip(odd_docs(spark), WORD).collect()}
    wanted = set()
    for doc_id, text in [*enumerate(ODD), (3, "the other text"), (None, "no id")]:
        ids = words.encode(text or "", add_special_tokens=False).ids
        decoded = words.decode(ids, skip_special_tokens=False)
        wanted.add((doc_id, len(ids), sha(" ".join(map(str, ids)).encode()), sha(decoded.encode())))
    assert found == wanted
    assert wordbpe.round_trip(odd_docs(spark).limit(0), WORD).count() == 0
    whole = wordbpe.round_trip(odd_docs(spark), WORD, with_ids=True).filter("doc_id = 9").first()
    assert words.decode(whole.ids, skip_special_tokens=False) == whole.decoded


def test_entries_that_never_occur_are_left_out():
    # "ab" comes before "bc", so "abc" is never made of "a" and "bc".
    vocabulary = wordbpe.Vocabulary(
        {t: i for i, t in enumerate(["a", "b", "c", "a</w>", "b</w>", "c</w>", "ab", "bc</w>", "abc</w>"])},
        [["a", "b"], ["b", "c</w>"], ["a", "bc</w>"]], "</w>",
    )
    assert sorted(vocabulary.entries.values()) == [0, 1, 2, 3, 4, 5, 6, 7]
    assert wordbpe.Backtracker(vocabulary).encode([wordbpe._marked(w) for w in ("abc", "bc", "aab")]) == [[6, 5], [7], [0, 0, 4]]


def plain_links(aligner, tokenizer, model, text):
    """((n_a, n_b, n_groups, digest), links) by token spans."""
    raw = (" " + (text or "")).encode()
    a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
    b = model.encode(text) if text else []
    parts = [[aligner.a_bytes[i] for i in a], [aligner.b_bytes[i] for i in b]]
    if not text or any(b"".join(p) != raw for p in parts):
        return (0, 0, 0, ""), []
    spans = [[(int(e) - len(x), int(e)) for e, x in zip(np.cumsum([len(x) for x in p]), p, strict=True)] for p in parts]
    links = [(a[i], b[j]) for i, (s, e) in enumerate(spans[0]) for j, (t, f) in enumerate(spans[1]) if s < f and t < e]
    groups, before = [], 0
    for cut in sorted({e for _, e in spans[0]} & {e for _, e in spans[1]}):
        inside = [[str(i) for i, (_, e) in zip(ids, own, strict=True) if before < e <= cut] for ids, own in zip((a, b), spans, strict=True)]
        groups.append("|".join(map(",".join, inside)))
        before = cut
    return (len(a), len(b), len(groups), sha(";".join(groups).encode())), links


def plain_alignment(rows):
    aligner = alignment.aligner(open(A, encoding="utf-8").read(), open(B, "rb").read())
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    known = [plain_links(aligner, tokenizer, model, text) for _, text in rows]
    counts = Counter(pair for _, links in known for pair in set(links))
    most = Counter()
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    return Counter(
        (doc_id, *figures[:3], len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links), figures[3])
        for (doc_id, _), (figures, links) in zip(rows, known, strict=True)
    )


@pytest.mark.parametrize(("run_links", "fan_in"), [(alignment.RUN_LINKS, alignment.FAN_IN), (60, 2)])
def test_alignment_equals_brute_force(spark, run_links, fan_in):
    short = [(i, t if t is None or len(t) < 600 else t[:600]) for i, t in enumerate(ODD)]
    drawn = random.Random(5)
    pool = ["the ", "ing ", "é", "ab", "\n", "  ", ");\r", "x1", "漢", "😀", "'ll ", "<s>"]
    rows = [*short, (3, "the other text"), (None, "no id")]
    rows += [(100 + i, "".join(drawn.choices(pool, k=drawn.randint(1, 25)))) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, run string, codes int")
    found = alignment.align(docs.repartition(3), A, B, run_links=run_links, fan_in=fan_in)
    assert Counter(map(tuple, found.collect())) == plain_alignment(rows)


def test_alignment_of_long_and_no_texts(spark):
    docs = odd_docs(spark)
    assert alignment.align(docs.limit(0), A, B).count() == 0
    rows = alignment.align(docs, A, B).collect()
    assert len(rows) == len(ODD) + 2
    by = {r.doc_id: r for r in rows}
    assert by[13].n_groups == 8001 == by[13].n_links and len(by[13].groups_sha256) == 64
    assert by[0].n_links == by[14].n_links == 0 and by[0].groups_sha256 == by[14].groups_sha256 == ""


def plain_search(docs, items, k):
    split = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def terms(text):
        return split.findall((text or "").translate(fold))

    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n, total = len(held), sum(s for _, _, s in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = Counter()
    for item, text in dict.fromkeys(items):
        scored = []
        for d, c, size in held:
            m = 25 + 75 * size * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms(text) if t in c
            )
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out.update((item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k]))
    return out


@pytest.mark.parametrize("size", [3, 1 << 15])
def test_ranked_search_equals_brute_force(spark, size):
    drawn = random.Random(3)
    pool = ["the", "The", "cat", "sat", "É", "é", "naïve", "x1", "1", "of-the", " ", "\x85", "rare"]
    docs = [(i, t if t is None else t[:400]) for i, t in enumerate(ODD)] + [(None, "the rare cat"), (3, "the cat"), (7, "the cat")]
    docs += [(50 + i, " ".join(drawn.choices(pool, k=drawn.randint(0, 40)))) for i in range(80)]
    docs += [(1000 - i, "the cat sat twice") for i in range(30)]  # ties
    items = [(0, "the CAT sat"), (0, "the CAT sat"), (0, "naïve É"), (1, None), (2, ""), (3, "... !"), (4, "unheard"), (None, "rare rare of")]
    left = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, shard string, term int").repartition(3)
    right = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, block int")
    found = ranked.search(left, right, shard_docs=size)
    assert Counter(map(tuple, found.collect())) == plain_search(docs, items, 10)
    assert ranked.search(left.limit(0), right).count() == 0
    assert ranked.search(left, right.limit(0)).count() == 0


def test_intervals_are_pruned():
    """Far fewer documents are scored than there are, and the result is that of scoring all."""
    rng = np.random.default_rng(1)
    n = 20_000
    docs = [np.flatnonzero(rng.random(n) < share) for share in (0.9, 0.5, 0.1, 0.01, 0.001)]
    impacts = [rng.integers(1, 1000, len(d)) for d in docs]
    factor = np.array([1, 3, 8, 20, 40])
    scores = np.zeros(n, np.int64)
    for d, i, f in zip(docs, impacts, factor, strict=True):
        scores[d] += i * f
    lists, seen = ranked.Lists(docs, impacts), []
    greatest = lists.greatest
    lists.greatest = lambda lo, hi: seen.append(len(lo)) or greatest(lo, hi)
    found = ranked.best(lists, np.arange(5), factor, np.arange(n))
    assert found == [(int(scores[d]), int(d)) for d in np.lexsort((np.arange(n), -scores))[:10]]
    assert sum(seen) < n / 2
