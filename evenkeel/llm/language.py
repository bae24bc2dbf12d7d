"""Language identification by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. The likelihood of a word is
the sum, over all ways to cut it into pieces, of the product of their probabilities (forward algorithm),
and that of a text the product over its words: runs of letters, lower case, after a word-start mark. The
probabilities are expected counts over all segmentations of labelled words (forward-backward, EM).

Fitting uses a bounded sample: about ``fit_docs`` documents of each language, chosen by a hash of doc_id.
Labels are ``lang`` of documents that are not held out; nothing but the text enters a prediction.

Defined results: NULL text and text without a letter is ``und`` with score 0; equal posteriors go to the
least language name; a word of any length is summed over all its segmentations; repeated rows get equal results;
without labelled documents all is ``und``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, fresh

#: Words up to this length, mark included, are summed many at a time, longer ones one by one with rescaled sums.
SHORT = 32
LEAST = 1e-9
SMOOTH = 0.05
#: Distinct words remembered by a Python worker.
REMEMBERED = 400_000
UNDETERMINED = "und"
_WORD = re.compile(r"[^\W\d_]+")
_START = "▁"


@lru_cache(maxsize=2)
def _pieces(model: bytes) -> dict[str, int]:
    """Ordinary pieces with their numbers."""
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    found = {}
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)):
            found[piece] = len(found)
    return found


@lru_cache(maxsize=2)
def _starts(model: bytes) -> dict[str, int]:
    return starts_of(_pieces(model))


def starts_of(pieces: dict[str, int]) -> dict[str, int]:
    """The pieces and all their beginnings; a beginning that is no piece itself has the number -1."""
    return {p[:k]: -1 for p in pieces for k in range(1, len(p))} | pieces


def words_of(text: str | None) -> list[str]:
    found = _WORD.findall(text.lower()) if text else []
    return found if any(c.isalpha() for w in found for c in w) else []


def _edges(words: list[str], pieces: dict[str, int], unknown: int) -> tuple[np.ndarray, ...]:
    """All pieces in all words: word, start, end, piece. A character that is no piece has the number ``unknown``."""
    own, starts, ends, ids = [], [], [], []
    get = pieces.get
    for k, s in enumerate(words):
        n = len(s)
        for i in range(n):
            for j in range(i + 1, n + 1):
                p = get(s[i:j])
                if p is None or p < 0:
                    if j == i + 1:
                        own.append(k)
                        starts.append(i)
                        ends.append(j)
                        ids.append(unknown)
                    if p is None:
                        break  # nothing longer starts like this
                    continue
                own.append(k)
                starts.append(i)
                ends.append(j)
                ids.append(p)
    return tuple(np.array(x, np.int32) for x in (own, starts, ends, ids))


def _forward(n: int, edges: tuple[np.ndarray, ...], probs: np.ndarray, back: bool = False) -> np.ndarray:
    """Sums over all segmentations up to (back: from) each position: [word, position, language]."""
    own, starts, ends, ids = edges
    at, other = (starts, ends) if back else (ends, starts)
    lengths = np.zeros(n, np.int64)
    np.maximum.at(lengths, own, ends)
    total = np.zeros((n, SHORT + 1, probs.shape[1]))
    total[np.arange(n), lengths if back else 0] = 1.0
    order = np.argsort(at, kind="stable")
    bounds = np.searchsorted(at[order], np.arange(SHORT + 2))
    for p in range(SHORT, -1, -1) if back else range(SHORT + 1):
        e = order[bounds[p] : bounds[p + 1]]
        if len(e):
            # Edges of a word stand together, and all that end here are known.
            o = own[e]
            first = np.flatnonzero(np.append(True, o[1:] != o[:-1]))
            total[o[first], p] = np.add.reduceat(total[o, other[e]] * probs[ids[e]], first, axis=0)
    return total


def _long_sums(word: str, pieces: dict[str, int], probs: np.ndarray) -> tuple[np.ndarray, ...]:
    """(starts, ends, pieces of the edges; logs of the sums up to and from every position) of one long word.

    Logs are kept, so that no length makes the sums vanish."""
    _, starts, ends, ids = _edges([word], pieces, len(probs) - 1)
    n, langs = len(word), probs.shape[1]
    found = []
    for at, other, positions in ((ends, starts, range(1, n + 1)), (starts, ends, range(n - 1, -1, -1))):
        logs = np.zeros((n + 1, langs))
        order = np.argsort(at, kind="stable")
        bounds = np.searchsorted(at[order], np.arange(n + 2))
        for p in positions:
            e = order[bounds[p] : bounds[p + 1]]
            before = logs[other[e]]
            top = before.max(0)
            logs[p] = top + np.log((np.exp(before - top) * probs[ids[e]]).sum(0))
        found.append(logs)
    return starts, ends, ids, *found


def _dealt(words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The words with their mark, and which are short and long."""
    marked = [_START + w for w in words]
    sizes = np.array([len(w) for w in marked], np.int64)
    return marked, np.flatnonzero(sizes <= SHORT), np.flatnonzero(sizes > SHORT)


def word_scores(words: list[str], pieces: dict[str, int], probs: np.ndarray) -> np.ndarray:
    """Log likelihood of each word in each language; ``pieces`` with their beginnings."""
    marked, short, long = _dealt(words)
    total = np.zeros((len(words), probs.shape[1]))
    step = 4096
    for a in range(0, len(short), step):
        part = [marked[k] for k in short[a : a + step]]
        sums = _forward(len(part), _edges(part, pieces, len(probs) - 1), probs)
        total[short[a : a + step]] = np.log(sums[np.arange(len(part)), [len(s) for s in part]])
    for k in long:
        total[k] = _long_sums(marked[k], pieces, probs)[3][-1]
    return total


def expected(counts: dict[str, np.ndarray], pieces: dict[str, int], probs: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in each language over all segmentations of the counted words."""
    marked, short, long = _dealt(list(counts))
    weights = np.array(list(counts.values())) if counts else np.zeros((0, probs.shape[1]))
    found = np.zeros_like(probs)
    step = 4096
    for a in range(0, len(short), step):
        part = [marked[k] for k in short[a : a + step]]
        edges = _edges(part, pieces, len(probs) - 1)
        own, starts, ends, ids = edges
        ahead, behind = _forward(len(part), edges, probs), _forward(len(part), edges, probs, back=True)
        whole = behind[:, 0]
        share = ahead[own, starts] * probs[ids] * behind[own, ends] / whole[own]
        np.add.at(found, ids, share * weights[short[a : a + step]][own])
    for k in long:
        starts, ends, ids, ahead, behind = _long_sums(marked[k], pieces, probs)
        share = np.exp(ahead[starts] + behind[ends] - behind[0]) * probs[ids]
        np.add.at(found, ids, share * weights[k])
    return found


@dataclass
class Model:
    """Languages and their piece probabilities; remembers words it has scored."""

    vocabulary: bytes
    langs: list[str]
    probs: np.ndarray
    known: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.pieces = _starts(self.vocabulary)
        self.scores = np.zeros((1024, len(self.langs)))

    def __reduce__(self):
        return Model, (self.vocabulary, self.langs, self.probs)

    def _learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(words)
        if new:
            at = len(self.known)
            if at + len(new) > len(self.scores):
                grown = np.zeros((2 * (at + len(new)), len(self.langs)))
                grown[:at] = self.scores[:at]
                self.scores = grown
            self.scores[at : at + len(new)] = word_scores(new, self.pieces, self.probs)
            self.known.update(zip(new, range(at, at + len(new)), strict=True))

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.langs:
            return UNDETERMINED, 0.0
        self._learn(set(words))
        total = self.scores[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))].sum(0)
        odds = np.exp(total - total.max())
        best = int(odds.argmax())
        return self.langs[best], float(odds[best] / odds.sum())


def held_out(doc_id: Column) -> Column:
    """Whether a document takes no part in learning. A NULL id does."""
    rest = F.crc32(doc_id.cast("string").cast("binary")) % 3
    return F.coalesce(rest == 1, F.lit(False))


def fit(docs: DataFrame, vocabulary_path: str, *, fit_docs: int = 1000, rounds: int = 2) -> Model:
    """Learn from about ``fit_docs`` documents of each language that are not held out."""
    with open(vocabulary_path, "rb") as file:
        vocabulary = file.read()
    spark = docs.sparkSession
    pieces = _pieces(vocabulary)
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    # One row per language.
    sizes = {r[0]: r[1] for r in usable.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return Model(vocabulary, [], np.zeros((len(pieces) + 1, 0)))
    shares = F.create_map(*(F.lit(x) for lang in langs for x in (lang, min(1.0, fit_docs / sizes[lang]))))
    draw = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = usable.filter(draw < shares[F.col("lang")]).select("lang", "text")
    sample = cut(sample.repartition(max(4, len(langs))))
    probs = np.full((len(pieces) + 1, len(langs)), 1.0 / len(pieces))
    for _ in range(rounds):
        shipped = spark.sparkContext.broadcast((vocabulary, langs, probs))

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            vocabulary, langs, probs = shipped.value
            pieces = _starts(vocabulary)
            counted = {lang: Counter() for lang in langs}
            for batch in batches:
                for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    counted[lang].update(words_of(text.as_py()))
            counts: dict[str, np.ndarray] = {}
            for k, lang in enumerate(langs):
                for word, n in counted[lang].items():
                    counts.setdefault(word, np.zeros(len(langs)))[k] = n
            found = expected(counts, pieces, probs)
            at, k = found.nonzero()
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), pa.array(k, pa.int32()), pa.array(found[at, k])],
                names=["piece", "lang", "uses"],
            )

        # At most one row per piece of the vocabulary and language.
        uses = sample.mapInArrow(run, "piece int, lang int, uses double").groupBy("piece", "lang")
        rows = uses.agg(F.sum("uses").alias("uses")).toPandas()
        total = np.full_like(probs, SMOOTH)
        total[rows["piece"], rows["lang"]] += rows["uses"]
        probs = np.maximum(total / total.sum(0), LEAST)
        shipped.unpersist()
    return Model(vocabulary, langs, probs)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, all their columns, with lang_pred and score (or names like these that are free).

    A worker's model, with the words it remembers, belongs to the broadcast: it is one for all tasks of the stage and goes
    when the worker, which serves later stages too, gets a task without it."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in batches:
            found = [own.predict(t.as_py()) for t in batch.column(at)]
            more = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *new])

    new = fresh(docs, "lang_pred", "score")
    schema = T.StructType(
        [*docs.schema.fields, T.StructField(new[0], T.StringType()), T.StructField(new[1], T.DoubleType())]
    )
    return docs.mapInArrow(run, schema)


def keep_known(docs: DataFrame, vocabulary_path: str, *, least: float = 0.5, **settings) -> DataFrame:
    """The documents whose language can be told: neither ``und`` nor scored below ``least``."""
    marked = predict(docs, fit(docs, vocabulary_path, **settings))
    lang, score = marked.columns[-2:]
    kept = marked.filter((F.col(f"`{lang}`") != UNDETERMINED) & (F.col(f"`{score}`") >= least))
    return kept.select(*(f"`{c}`" for c in docs.columns))
