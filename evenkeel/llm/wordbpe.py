"""BPE with word ends, encoded by backtracking over longest matches and decoded by an offset table.

A word is a row of symbols, one per byte, the last one marked as an end. An Aho-Corasick automaton finds the
longest vocabulary entry at every symbol. Entries are laid end to end, longest first; an entry is taken if it
may follow its left neighbour, else the next shorter one that begins alike is tried, and where none is left
the last entry is taken back. Every place is left for good once, so the time is linear.

Whether two entries may stand side by side is read off the merges: undoing them from the latest back, no pair
across the border may ever have had a merge that comes sooner. Entries whose own symbols merge otherwise never
occur and are left out. Decoding gathers the entries' texts from one buffer by their offsets.

Defined results: NULL text counts as empty (no ids, empty text); texts and words of any length are encoded
whole; every row is encoded, also repeated ones; an empty table gives an empty table; columns besides the
id and the text are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import ChainMap
from collections.abc import Iterator, Mapping
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

#: Distinct words and pairs of entries remembered by a Python worker.
REMEMBERED = 400_000
#: Words beyond this length are encoded anew each time.
LONG = 128
#: Added to the last symbol of a word.
_END = 0x1000
#: Between words: no symbol, and white space to every rule.
_GAP = "\n"
#: Separators for Python's split that are no white space to the tokenizer's rules, and a split without them.
_ODD = re.compile("[\x1c-\x1f]")
_WORDS = re.compile("[^\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")


def _split(text: str) -> list[str]:
    return _WORDS.findall(text) if _ODD.search(text) else text.split()


def _marked(word: str) -> str:
    return word[:-1] + chr(ord(word[-1]) + _END)


class Vocabulary:
    """Entries as symbols, their merges, and what follows from them."""

    def __init__(self, vocab: dict[str, int], merges: list[list[str]], suffix: str) -> None:
        def symbols(entry: str) -> str:
            return _marked(entry.removesuffix(suffix)) if len(entry) > len(suffix) and entry.endswith(suffix) else entry

        size = max(vocab.values()) + 1
        self.rank, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.merged: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(merges):
            pair, whole = (vocab[a], vocab[b]), vocab[a + b]
            if self.rank[whole] >= 0 or max(self.rank[pair[0]], self.rank[pair[1]]) >= rank:
                raise ValueError("every entry must come from one merge of earlier entries")
            self.rank[whole], (self.left[whole], self.right[whole]) = rank, pair
            self.merged[pair] = whole
        texts = {i: symbols(entry) for entry, i in vocab.items()}
        kept = {i for i, s in texts.items() if self.rank[i] < 0 and len(s) == 1}
        for whole in self.merged.values():  # by rank, so the parts are known already
            parts = self.left[whole], self.right[whole]
            if kept.issuperset(parts) and self._apart(*parts, self.rank[whole]):
                kept.add(whole)
        self.entries = {texts[i]: i for i in kept}
        self.shorter = [-1] * size
        for text, i in self.entries.items():
            begins = (self.entries.get(text[:n], -1) for n in range(len(text) - 1, 0, -1))
            self.shorter[i] = next((b for b in begins if b >= 0), -1)

    def _apart(self, a: int, b: int, until: int) -> bool:
        """Whether no merge across the border of two neighbours comes before the one of rank ``until``."""
        rank = self.rank
        while True:
            across = self.merged.get((a, b))
            if across is not None and rank[across] < until:
                return False
            # Of equal merges the left one comes first, so the right neighbour is undone first.
            if rank[a] > rank[b]:
                until, a = rank[a], self.right[a]
            elif rank[b] >= 0:
                until, b = rank[b] + 1, self.left[b]
            else:
                return True

    def compatible(self, a: int, b: int) -> bool:
        return self._apart(a, b, len(self.rank))


class Backtracker:
    """Encode rows of symbols that hold known symbols only."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.length = {i: len(s) for s, i in vocabulary.entries.items()}
        self.automaton = ahocorasick.Automaton()
        for text, i in vocabulary.entries.items():
            self.automaton.add_word(text, i)
        self.automaton.make_automaton()
        #: The pair-compatibility table, filled as pairs occur.
        self.pairs: dict[tuple[int, int], bool] = {}

    def encode(self, words: list[str]) -> list[list[int]]:
        """The entries of each word; one run of the automaton serves all."""
        joined = _GAP.join(words)
        longest, length = [-1] * (len(joined) + 1), self.length
        for end, entry in self.automaton.iter(joined):
            longest[end + 1 - length[entry]] = entry  # matches come by their end, so the longest stays
        if len(self.pairs) > REMEMBERED:
            self.pairs.clear()
        found, at = [], 0
        for word in words:
            found.append(self._lay(longest, at, at + len(word)))
            at += len(word) + 1
        return found

    def _lay(self, longest: list[int], start: int, stop: int) -> list[int]:
        length, shorter, pairs = self.length, self.vocabulary.shorter, self.pairs
        laid: list[int] = []
        at, dead = start, set()
        entry = longest[at]
        while at < stop:
            while entry >= 0:
                end = at + length[entry]
                if end not in dead:
                    if not laid:
                        break
                    pair = laid[-1], entry
                    fits = pairs.get(pair)
                    if fits is None:
                        fits = pairs[pair] = self.vocabulary.compatible(*pair)
                    if fits:
                        break
                entry = shorter[entry]
            if entry >= 0:
                laid.append(entry)
                at, entry = end, longest[end]
            else:  # nothing fits here: never come back, and shorten what led here
                if not laid:
                    raise ValueError("a symbol is not in the vocabulary")
                dead.add(at)
                entry = laid.pop()
                at -= length[entry]
        return laid


class Codec:
    """Texts to ids and ids to text, as the tokenizer file says."""

    def __init__(self, file: str) -> None:
        spec = json.loads(file)
        model = spec["model"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or spec["decoder"]:
            raise ValueError("a BPE model with word ends and without a decoder is wanted")
        rules = Tokenizer.from_str(file)
        self.normalize, self.cut = rules.normalizer.normalize_str, rules.pre_tokenizer.pre_tokenize_str
        self.backtracker = Backtracker(Vocabulary(model["vocab"], [
            m if isinstance(m, list) else m.split(" ") for m in model["merges"]
        ], model["end_of_word_suffix"]))
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, list[int]] = {}
        self.whole = {t: np.array([i], "<i4").tobytes() for t, i in added.items()}
        # The offset table: entry i is bytes [offsets[i], offsets[i + 1]), a blank behind it.
        texts = {i: t for t, i in (model["vocab"] | added).items()}
        spelled = [(texts[i] + " ").encode() if i in texts else b"" for i in range(max(texts) + 1)]
        self.buffer = np.frombuffer(b"".join(spelled), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(s) for s in spelled])])
        self.decimal = np.array([b"%d " % i for i in range(len(spelled))], object)

    def _ids(self, words: list[str]) -> list[bytes]:
        """The ids of words that hold no white space: normalised and cut in one go, laid in one go."""
        spelled = self.normalize(_GAP.join(words))
        ends = np.cumsum([len(w) + 1 for w in spelled.split(" ")])
        parts = self.cut(spelled)
        owner = np.searchsorted(ends, [at for _, (at, _) in parts], side="right").tolist()
        if len(self.parts) > REMEMBERED:
            self.parts.clear()
        new = list({p for p, _ in parts} - self.parts.keys())
        laid = self.backtracker.encode([_marked(p) for p in new])
        self.parts.update(zip(new, laid, strict=True))
        found: list[list[int]] = [[] for _ in words]
        for word, (part, _) in zip(owner, parts, strict=True):
            found[word] += self.parts[part]
        for part in new:
            if len(part) > LONG:
                del self.parts[part]
        return [np.array(ids, "<i4").tobytes() for ids in found]

    def _learn(self, words: set[str]) -> Mapping[str, bytes]:
        """Ids of all these words: the remembered ones, and those too long to remember."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(words)
        short, rest = [w for w in new if len(w) <= LONG], [w for w in new if len(w) > LONG]
        if short:
            self.known.update(zip(short, self._ids(short), strict=True))
        return ChainMap(dict(zip(rest, self._ids(rest), strict=True)), self.known) if rest else self.known

    def _words(self, text: str | None) -> list[str]:
        """The text's words and added tokens, in order."""
        if not text:
            return []
        if self.added is None or not self.added.search(text):
            return _split(text)
        parts = self.added.split(text)
        return list(chain.from_iterable([p] if k % 2 else _split(p) for k, p in enumerate(parts)))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [self._words(t) for t in texts]
        known = self._learn(set(chain.from_iterable(split)) - self.whole.keys())
        look = known.__getitem__
        if not all(map(self.whole.keys().isdisjoint, split)):
            look = ChainMap(self.whole, known).__getitem__
        return [np.frombuffer(b"".join(map(look, s)), "<i4") for s in split]

    def decode(self, ids: np.ndarray) -> bytes:
        """The entries' texts with a blank between, in UTF-8."""
        start, size = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(size)
        if not len(ids) or not ends[-1]:
            return b""
        where = np.arange(ends[-1]) + np.repeat(start - (ends - size), size)
        return self.buffer[where[:-1]].tobytes()


@lru_cache(maxsize=2)
def codec(file: str) -> Codec:
    return Codec(file)


def round_trip(docs: DataFrame, path: str, *, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, and ids and decoded text if asked) of every text."""
    with open(path, encoding="utf-8") as file:
        shipped = docs.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary file, whatever the table
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shipped.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                ids = own.encode(batch.column(1).to_pylist())
                joined = [b"".join(own.decimal[i].tolist())[:-1] for i in ids]
                texts = [own.decode(i) for i in ids]
                columns = [
                    batch.column(0), pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(j).hexdigest() for j in joined], pa.string()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                ]
                if with_ids:
                    columns += [pa.array(ids, pa.list_(pa.int32())), pa.array([t.decode() for t in texts], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kept = docs.select(f"`{id_col}`", f"`{text_col}`")
    schema = f"`{id_col}` {kept.dtypes[0][1]}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return kept.mapInArrow(run, schema + ", ids array<int>, decoded string" * with_ids)
