"""Byte-level BPE, token-id files and language ID against the libraries and held-out labels."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from evenkeel.llm import bpe, idfile, language, queries

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SF = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "\n\n  \n", "a", "a" * 5000, " " * 3000, "don't  stop\t\x1c\x1f\x85x", "<|endoftext|> <unk> ▁x",
    "naïve Ünïcode ʼn ① ½ ٣ 漢字かな 🤷🏽‍♀️ é", "x\x00y", "ΣΑΣ ς", "1234567890 12,345.67", "wort " * 4000,
]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.serialise(bpe.read_ranks(RANKS)), public_tokenizers.PATTERN)


def odd_docs(spark):
    rows = [(i, t, "x", None) for i, t in enumerate(ODD)] + [(3, ODD[3], "again", 1), (None, "no id", None, 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, score long")


def test_every_entry_is_its_own_id(codec):
    texts = ["".join(chr(0x100 + b) for b in e) for e in bpe.read_ranks(RANKS)]
    assert codec.pieces.encode(texts, out_type=int) == [[i] for i in range(len(texts))]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_bpe_equals_the_library(text):
    own = bpe.codec(_MODEL, public_tokenizers.PATTERN)
    ids = own.encode(text)
    assert ids == _ENCODING.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


_MODEL = bpe.serialise(bpe.read_ranks(RANKS))
_ENCODING = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, special_tokens={},
    mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))},
)


def test_bpe_frames(spark, reference):
    docs = odd_docs(spark)
    found = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in
             bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect()}
    wanted = set()
    for doc_id, text in [*enumerate(ODD), (None, "no id")]:
        ids = reference.encode_ordinary(text or "")
        joined = " ".join(map(str, ids)).encode()
        wanted.add((doc_id, len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert found == wanted
    encoded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    decoded = bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).filter("doc_id = 9").first()
    assert bytes(decoded["bytes"]).decode() == ODD[9]
    assert bpe.round_trip(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("bits", [True, False])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 100, 1000])
def test_planes_round_trip(bits, n):
    rng = np.random.default_rng(n)
    for top in (1, 2, 300, 70_000, 2**32 - 1):
        ids = rng.integers(0, top, n, dtype=np.uint32) if n else np.empty(0, np.uint32)
        assert (idfile.unpack(idfile.pack(ids, block=64, bits=bits)) == ids).all()


def test_planes_refuse_other_bytes():
    with pytest.raises(ValueError):
        idfile.unpack(b"something else")


def test_files_equal_the_library(spark, tmp_path):
    docs = odd_docs(spark).filter("doc_id is not null and ids = 'x'")
    path = str(tmp_path / "ids")
    word_path = public_tokenizers.path("word_bpe_49k.json")
    idfile.write(docs.repartition(3), path, idfile.word_encoder(spark, word_path), end_id=2, block=16, chunk=64)
    found = {r.doc_id: r for r in idfile.read_documents(spark, path).collect()}
    tokenizer, start = Tokenizer.from_file(word_path), 0
    for doc_id, text in enumerate(ODD):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        r = found[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), doc_id
        start += len(ids)
    empty = str(tmp_path / "none")
    idfile.write(docs.limit(0), empty, idfile.word_encoder(spark, word_path), end_id=2)
    assert idfile.read_documents(spark, empty).count() == 0


def test_words_with_marks_behind_are_spelled_from_letters_and_marks():
    words = idfile.Words(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())
    known = [f"{stem}{marks}" for stem in ("word", "Ünï", "don", "ß") for marks in (*idfile._MARKS, ",%%%", "&&&", '."', "?!?!", "_-_")]
    assert all(words._plain(w) == words._whole([w])[0] for w in known)
    other = ["don's", "don'", "a,b", "a,'s", "İ!", "e\u0301!", "x1%", "!!", "<|endoftext|>", "word<|endoftext|>", "“a”"]
    assert [words._plain(w) for w in other] == [None] * len(other)
    text = " ".join([*known, *other])
    assert words.ids(text).tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


def test_planes_are_bits_of_the_ids_in_order():
    ids = np.array([1, 0, 3, 70_000], np.uint32)
    value = idfile.pack(ids)
    assert value[:9] == b"EKP1\1" + (1).to_bytes(4, "little") and value[9:17] == (4).to_bytes(4, "little") + (24).to_bytes(4, "little")
    assert idfile.zstandard.ZstdDecompressor().decompress(value[17 + 4 * 24 :][: value[17]]) == bytes([0b0101])


def test_forward_sums_all_segmentations():
    pieces = {"▁": 0, "a": 1, "b": 2, "ab": 3, "▁a": 4, "▁ab": 5}
    probs = np.array([[0.1, 0.2], [0.2, 0.1], [0.3, 0.1], [0.15, 0.2], [0.2, 0.3], [0.05, 0.1], [1e-6, 1e-6]])

    def brute(text, k):
        if not text:
            return 1.0
        return sum(probs[i, k] * brute(text[len(p):], k) for p, i in pieces.items() if text.startswith(p))

    words = ["ab", "a", "abab", "bb"]
    scores = language.word_scores(words, language.starts_of(pieces), probs)
    for w, row in zip(words, scores, strict=True):
        assert np.allclose(np.exp(row), [brute("▁" + w, 0), brute("▁" + w, 1)])
    # Expected uses times length add up to the characters covered.
    counts = {w: np.array([2.0, 1.0]) for w in words}
    uses = language.expected(counts, language.starts_of(pieces), probs)
    lengths = np.array([len(p) for p in pieces] + [1])
    assert np.allclose((uses * lengths[:, None]).sum(0), [2 * sum(len(w) + 1 for w in words), sum(len(w) + 1 for w in words)])


def test_language_is_told_on_held_out_documents(spark):
    found = queries.language_id(spark, SF)
    labels = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = found.join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 20 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95


def test_language_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs, public_tokenizers.path(queries.VOCABULARY), rounds=1)
    odd = odd_docs(spark)
    rows = language.predict(odd, model).collect()
    assert len(rows) == odd.count() and language.predict(odd, model).columns[:4] == odd.columns
    by = {r.doc_id: r for r in rows}
    assert by[0]["lang_pred"] == by[1]["lang_pred"] == by[12]["lang_pred"] == "und" and by[0]["score_"] == 0
    assert all(0 <= r["score_"] <= 1 for r in rows)
    assert language.predict(odd.limit(0), model).count() == 0
    kept = language.keep_known(docs, public_tokenizers.path(queries.VOCABULARY))
    assert kept.columns == docs.columns and kept.count() == docs.count()
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) lang")
    assert language.fit(unlabelled, public_tokenizers.path(queries.VOCABULARY)).predict("the text") == ("und", 0.0)


def test_workers_keep_no_model_after_its_stage(spark):
    def held(batches):
        import gc

        import pyarrow as pa

        for _ in batches:
            pass
        gc.collect()
        kinds = {("evenkeel.llm.language", "Model"), ("evenkeel.llm.bpe", "Codec")}
        found = sum((type(x).__module__, type(x).__name__) in kinds for x in gc.get_objects())
        yield pa.RecordBatch.from_arrays([pa.array([found])], names=["found"])

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    language.keep_known(docs, public_tokenizers.path(queries.VOCABULARY), rounds=1).count()
    bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).filter("n_tokens >= 0").collect()
    # More tasks than workers, so that each idle one gets some.
    rows = spark.range(96).repartition(96).mapInArrow(held, "found long").collect()
    assert len(rows) == 96 and sum(r.found for r in rows) == 0


def test_words_of_any_length_are_summed_whole():
    pieces = {"▁": 0, "a": 1, "b": 2, "ab": 3, "▁a": 4, "bab": 5}
    probs = np.array([[0.1, 0.2], [0.2, 0.1], [0.3, 0.1], [0.15, 0.2], [0.2, 0.3], [0.05, 0.1], [1e-6, 1e-6]])

    def plain(word, k):
        # In whole numbers of 2 ** -1074 the sums of long words would vanish, so fractions are used.
        from fractions import Fraction

        sums = [Fraction(1)]
        for j in range(1, len(word) + 1):
            ways = [sums[j - len(p)] * Fraction(probs[i, k]) for p, i in pieces.items() if word[:j].endswith(p)]
            if word[j - 1] not in pieces:
                ways.append(sums[j - 1] * Fraction(probs[-1, k]))
            sums.append(sum(ways, Fraction(0)))
        return float(sums[-1].numerator.bit_length() - sums[-1].denominator.bit_length()), sums[-1]

    words = ["ab", "ab" * 15 + "b", "ab" * 16, "abbab" * 100, "a" * 31 + "c" + "bab" * 40]
    scores = language.word_scores(words, language.starts_of(pieces), probs)
    for word, row in zip(words, scores, strict=True):
        for k in (0, 1):
            _, exact = plain("▁" + word, k)
            shift = exact.denominator.bit_length() - exact.numerator.bit_length()
            wanted = np.log(float(exact * 2**shift)) - shift * np.log(2)
            assert abs(row[k] - wanted) < 1e-9 * abs(wanted) + 1e-9
    counts = {w: np.array([2.0, 1.0]) for w in words}
    uses = language.expected(counts, language.starts_of(pieces), probs)
    lengths = np.array([len(p) for p in pieces] + [1])
    covered = sum(len(w) + 1 for w in words)
    assert np.allclose((uses * lengths[:, None]).sum(0), [2 * covered, covered])
