"""Near copies by BagMinHash: signatures of weighted bags of shingles, banded, then verified.

A text is the bag of its five-word windows, each with its count as weight. The weight axis is cut into the
steps [0,1), [1,2), [2,4), [4,8) … and every step of every shingle owns a Poisson process whose rate is the
step's length. Its points come in time order; each falls on one register of the signature and, by halving
the step, on one unit of weight, and counts only if the text's weight reaches that unit. A register keeps
its earliest point, so two registers agree with the probability of the weighted Jaccard similarity of the
bags. A process stops once its time passes the latest register: most shingles cost a point or two.

Signatures are banded; texts that share a band meet in a bucket, and their exact weighted Jaccard decides.
Two bounds that hold exactly rule pairs out before: the sizes of the bags, and an odd sketch, in which every
element of a bag flips one bit, so that two sketches differ in at most as many bits as the bags in elements.
No bucket is expanded to all its pairs. In a round, some members (centres, one per hash slot, a single one
at first, those that most others share keys with before others) are compared with all members of their
bucket; centres then leave it, buckets whose members are all connected are done, and the others go on with
four times as many centres. So in the end any two members that no path connects have been compared,
whatever the bucket's size, and a bucket of like texts takes one round.

Texts that are equal are one class before all that. Defined results: a text of one to four words is one
shingle; NULL texts and texts without a word have none (the latter are classed by equality, the former
are alone); a NULL id names no class, such rows get the class of an equal text that has an id, else NULL;
a text is known by its id and its content, so different texts under one id are texts of their own, and only rows
of equal id and text are one; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, cut, quoted, stored
from .components import labels as component_labels

WORDS = 5
SIMILARITY = 0.8
#: 36 bands of 7 registers: at similarity 0.8 a pair shares no band with a probability of 2 in 10,000.
BANDS, ROWS = 36, 7
_WORD = re.compile(f"[^{SPACE}]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_REMEMBERED = 400_000
#: Bits of an odd sketch.
SKETCH = 1024


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a public finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Hashes of the windows of texts; remembers the hashes of words."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = _WORD.findall(text) if text else []
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > _REMEMBERED:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(WORDS, len(words))
        total = np.zeros(len(words) - width + 1, np.uint64)
        for k in range(width):
            total = _mixed(total * _ODD + hashes[k : len(hashes) - width + 1 + k] + np.uint64(width))
        return total

    def bag(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(self(text), return_counts=True)


def elements(windows: np.ndarray) -> np.ndarray:
    """A bag as a sorted set: the second and later windows of a kind become elements of their own."""
    windows = np.sort(windows)
    if not len(windows):
        return windows
    starts = np.flatnonzero(np.concatenate([[True], windows[1:] != windows[:-1]]))
    if len(starts) == len(windows):
        return windows
    number = np.arange(len(windows)) - np.repeat(starts, np.diff(np.append(starts, len(windows))))
    return np.sort(np.where(number > 0, _mixed(windows + _ODD * number.astype(np.uint64)), windows))


def bag_min_hash(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n_docs: int, size: int) -> np.ndarray:
    """Registers [document, size] of the bags given as rows (document, shingle, whole weight)."""
    registers = np.full(n_docs * size, np.inf)
    steps = [(0, np.arange(len(doc)))]
    level = 1
    while len(more := np.flatnonzero(weight > 1 << (level - 1))):
        steps.append((level, more))
        level += 1
    at = np.concatenate([rows for _, rows in steps])
    level_of = np.concatenate([np.full(len(rows), k, np.uint64) for k, rows in steps])
    doc, weight = doc[at], weight[at]
    seed = _mixed(shingle[at] + _ODD * (level_of + np.uint64(1)))
    length = np.where(level_of > 0, 2.0 ** (level_of.astype(float) - 1), 1.0)
    first = np.where(level_of > 0, length, 0.0)
    time = np.zeros(len(doc))
    latest = np.full(n_docs, np.inf)
    done = 0
    while len(doc):
        # Few processes left: take many points of each at once.
        points = int(np.clip(200_000 // len(doc), 1, 64))
        number = np.arange(done, done + points, dtype=np.uint64)
        draw = _mixed(seed[:, None] + _ODD * (number[None, :] + np.uint64(1)))
        gap = -np.log(((draw >> np.uint64(11)).astype(float) + 1.0) / 2.0**53) / length[:, None]
        # One addition after the other from the start, so that the bits do not depend on how many points a batch takes.
        times = np.cumsum(np.concatenate([time[:, None], gap], 1), 1)[:, 1:]
        draw = _mixed(draw + np.uint64(1))
        register = (draw % np.uint64(size)).astype(np.int64)
        # The unit of weight the point falls on, its bits halving the step from the top.
        draw = _mixed(draw + np.uint64(2))
        unit = first[:, None] + np.floor((draw >> np.uint64(11)).astype(float) / 2.0**53 * length[:, None])
        hit = (unit < weight[:, None]) & (times < latest[doc][:, None])
        np.minimum.at(registers, (doc[:, None] * size + register)[hit], times[hit])
        time = times[:, -1]
        done += points
        touched = np.unique(doc)
        latest[touched] = registers.reshape(n_docs, size)[touched].max(1)
        going = time < latest[doc]
        doc, weight, seed, length, first, time = (x[going] for x in (doc, weight, seed, length, first, time))
    return registers.reshape(n_docs, size)


def band_keys(registers: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per document and band."""
    bits = registers.view(np.uint64).reshape(len(registers), bands, rows)
    keys = np.broadcast_to(_mixed(_ODD * np.arange(1, bands + 1, dtype=np.uint64)), bits.shape[:2])
    for k in range(rows):
        keys = _mixed(keys * _ODD + bits[:, :, k])
    return keys.astype(np.int64)


def odd_sketch(elements: np.ndarray) -> np.ndarray:
    """SKETCH bits, 64 to a number; every element flips the one that its hash names."""
    flips = np.bincount((elements >> np.uint64(20)).astype(np.int64) % SKETCH, minlength=SKETCH) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.int64)


def possible(x: Column, y: Column, sizes: Column, least: float) -> Column:
    """Whether two bags of this many elements together can be similar enough, by their sketches.

    Of bags of together n elements at similarity s, (1 - s) / (1 + s) of n are in one bag only, and sketches
    never differ in more bits than that. So no similar pair is lost."""
    unlike = F.lit(0)
    for k in range(SKETCH // 64):
        unlike = unlike + F.bit_count(x.getItem(k).bitwiseXOR(y.getItem(k)))
    return unlike <= sizes * F.lit((1 - least) / (1 + least)) + F.lit(1e-6)


def text_key(docs: DataFrame) -> Column:
    """What equal texts share; NULL texts have one for each id."""
    alone = F.concat_ws(":", F.lit("null"), docs["doc_id"].cast("string"))
    return F.coalesce(F.md5(docs["text"]), alone)


def signed(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, text_key, keys, windows, bits): the band keys of every text, texts without a word have none, and the size
    and the odd sketch of its bag."""
    kept = docs.select(F.col("doc_id").cast("long").alias("id"), text_key(docs).alias("text_key"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                bags, sketches, start, total = [], [], at, 0
                while at < batch.num_rows and total < 100_000 and at - start < 4096:
                    whole = shingles(batch.column(2)[at].as_py())
                    bags.append(np.unique(whole, return_counts=True))
                    sketches.append(odd_sketch(elements(whole)))
                    total += len(bags[-1][0])
                    at += 1
                sizes = np.array([len(h) for h, _ in bags])
                windows = np.array([c.sum() for _, c in bags], np.int64)
                doc = np.repeat(np.arange(len(bags)), sizes)
                found = bag_min_hash(
                    doc, np.concatenate([h for h, _ in bags]), np.concatenate([c for _, c in bags]),
                    len(bags), bands * rows,
                )
                keys = band_keys(found, bands, rows)[sizes > 0]
                bits = np.stack(sketches)
                offsets = np.concatenate([[0], np.cumsum(np.where(sizes > 0, bands, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(bags)), batch.column(1).slice(start, len(bags)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel())), pa.array(windows),
                     pa.FixedSizeListArray.from_arrays(pa.array(bits.ravel()), bits.shape[1]).cast(pa.list_(pa.int64()))],
                    names=["id", "text_key", "keys", "windows", "bits"],
                )

    return kept.mapInArrow(run, "id long, text_key string, keys array<long>, windows long, bits array<long>")


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two bags given as ``elements``: common ones over all."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    both = len(a) + len(b) - shared
    return shared / both if both else 0.0


def bagged(texts: DataFrame) -> DataFrame:
    """(id, bag) of the texts (id, text): the elements as bytes, so that a text is cut into windows once only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in batches:
            bags = [elements(shingles(text.as_py())).tobytes() for text in batch.column(1)]
            # Long arrays of bytes are passed on in parts.
            for at in range(0, len(bags), 256):
                part = pa.array(bags[at : at + 256], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 256), part], names=["id", "bag"])

    return texts.select("id", "text").mapInArrow(run, "id long, bag binary")


def verified(pairs: DataFrame, bags: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose bags are similar enough."""
    one = bags.select(F.col("id").alias("a"), F.col("bag").alias("bag_a"))
    other = bags.select(F.col("id").alias("b"), F.col("bag").alias("bag_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def bag(value: pa.Scalar) -> np.ndarray:
            return np.frombuffer(value.as_buffer(), np.uint64)

        for batch in batches:
            keep = [similarity(bag(x), bag(y)) >= least for x, y in zip(batch.column(2), batch.column(3))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(one, "a").join(other, "b").select("a", "b", "bag_a", "bag_b")
    return joined.mapInArrow(run, "a long, b long")


def linked(sigs: DataFrame, docs: DataFrame, least: float) -> DataFrame | None:
    """(id, label): components of the verified links between texts that share a band.

    Ids are those of the signatures, one for each text, and belong to the rows of its (doc_id, text_key)."""
    with stored(docs.sparkSession) as keep:
        found = _rounds(sigs, docs, least, keep)
        return None if found is None else cut(found)


def _rounds(
    sigs: DataFrame, docs: DataFrame, least: float, keep: Callable[[DataFrame], DataFrame]
) -> DataFrame | None:
    keys = sigs.select(F.explode("keys").alias("key"), "id")
    shared = keep(keys.groupBy("key").count().filter("count > 1"))
    members = keep(keys.join(shared, "key"))
    if members.isEmpty():
        return None
    # What a comparison needs of a text: its size, its sketch and how many others it meets.
    company = members.groupBy("id").agg(F.sum("count").alias("company"))
    compared = keep(sigs.drop("keys").join(company, "id"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(docs).alias("text_key"), "text")
    names = compared.select("id", "doc_id", "text_key")
    bags = keep(bagged(texts.join(names, ["doc_id", "text_key"]).select("id", "text").dropDuplicates(["id"])))
    labels = compared.select("id", F.col("id").alias("label"))
    info = compared.select("id", "windows", "bits", "company")
    slots, opened = 1, keep(members.select("key", "id").join(info, "id").withColumn("label", F.col("id")))
    while True:
        slot = F.pmod(F.xxhash64(F.lit(slots), "id"), F.lit(slots))
        first = F.min(F.struct((-F.col("company")).alias("order"), "id", "windows", "bits", "label")).alias("c")
        centres = opened.groupBy("key", slot.alias("slot")).agg(first)
        centres = keep(centres.select(
            "key", F.col("c.id").alias("centre"), F.col("c.windows").alias("size"),
            F.col("c.bits").alias("marks"), F.col("c.label").alias("of"),
        ))
        # Bags whose sizes differ too much are not similar, whatever they hold.
        sizes = F.least("windows", "size") >= F.lit(least - 1e-9) * F.greatest("windows", "size")
        pairs = opened.join(centres, "key").filter("label != of").filter(sizes)
        pairs = pairs.filter(possible(F.col("bits"), F.col("marks"), F.col("windows") + F.col("size"), least))
        pairs = keep(pairs.select(F.greatest("id", "centre").alias("a"), F.least("id", "centre").alias("b")).distinct())
        labels = _joined(labels, keep(verified(pairs, bags, least)), keep)
        rest = opened.drop("label").join(
            centres.select("key", F.col("centre").alias("id")), ["key", "id"], "left_anti"
        )
        rest = keep(rest.join(labels, "id"))
        mixed = rest.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi")
        opened = keep(rest.join(keep(mixed.select("key")), "key"))
        if opened.isEmpty():
            return labels
        slots *= 4


def _joined(labels: DataFrame, links: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The labels after the links (a, b) have joined classes: components of classes, not of all texts."""
    if links.isEmpty():
        return labels
    of_a = labels.select(F.col("id").alias("a"), F.col("label").alias("la"))
    of_b = labels.select(F.col("id").alias("b"), F.col("label").alias("lb"))
    between = links.join(of_a, "a").join(of_b, "b").select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct()
    step = component_labels(keep(between), keep).select(F.col("id").alias("label"), F.col("label").alias("to"))
    return keep(labels.join(step, "label", "left").select("id", F.coalesce("to", "label").alias("label")))


def _leaders(docs: DataFrame, least: float, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """(id, text_key) of every row, and of every text_key with an id the (text_key, class_id, class_key) of its class:
    the least id of the class and, of its texts of that id, the least text_key."""
    sigs = cut(signed(docs, bands, rows))
    firsts = cut(sigs.groupBy("text_key").agg(F.min("id").alias("id")).filter(F.col("id").isNotNull()))
    apart = sigs.join(firsts, ["text_key", "id"], "left_semi").filter(F.size("keys") > 0).dropDuplicates(["text_key"])
    # Numbers stand for the texts, as an id may have several; they hold once the rows are written.
    apart = cut(apart.select(
        F.monotonically_increasing_id().alias("id"), F.col("id").alias("doc_id"), "text_key", "keys", "windows", "bits"
    ))
    labels = linked(apart, docs, least)
    if labels is None:
        named = firsts.select("text_key", F.col("id").alias("class_id"), F.col("text_key").alias("class_key"))
    else:
        found = cut(apart.select("id", "doc_id", "text_key").join(labels, "id"))
        # Stored, so that the join reads plain shuffles and a large class can be split.
        first = cut(found.groupBy("label").agg(F.min(F.struct("doc_id", "text_key")).alias("first")))
        found = found.join(first, "label").select("text_key", "first")
        named = firsts.join(found, "text_key", "left").select(
            "text_key", F.coalesce("first.doc_id", "id").alias("class_id"),
            F.coalesce("first.text_key", "text_key").alias("class_key"),
        )
    return sigs.select("id", "text_key"), cut(named)


def classes(docs: DataFrame, *, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, class_id): the least id of the near copies of each document, one row per document."""
    texts, named = _leaders(docs, least, bands, rows)
    return texts.join(named, "text_key", "left").select(F.col("id").alias("doc_id"), "class_id")


def keep_one(docs: DataFrame, *, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The documents without near copies: of each class the one of least id stays. Rows without an id stay."""
    _, named = _leaders(docs, least, bands, rows)
    first = named.filter("text_key = class_key").select(F.col("class_id").alias("id"), "text_key")
    whole = docs.select(
        F.col("doc_id").cast("long").alias("id"), text_key(docs).alias("text_key"),
        F.struct(*quoted(docs.columns)).alias("row"),
    )
    kept = whole.join(first, ["id", "text_key"], "left_semi").dropDuplicates(["id", "text_key"])
    nameless = docs.filter(F.col("doc_id").isNull())
    return kept.select("row.*").unionByName(nameless.select(*quoted(docs.columns)))
