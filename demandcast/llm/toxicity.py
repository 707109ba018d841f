"""Toxicity scores by subword-bag embeddings and a linear softmax.

A word is the set of hashed character n-grams of ``<word>`` and the word
itself; every bucket has a vector. A bag of ``bag`` words in a row is the mean
of its words' vectors, a linear softmax over two classes scores it, and both
are trained together by mini-batches in numpy. A misspelled or inflected word
never seen shares most n-grams with the words it resembles.

A document is scored by its worst bag, so a few words count in a text of any
length. Training knows labels of documents only: a first round gives every bag
its document's label, a second keeps as positive only the bags the first model
finds toxic (a document's worst one at least). A fifth of the sample is kept
out of both rounds: its documents, scored whole, map worst-bag scores to
probabilities, with classes weighed by their shares of all labels, toxic ones
``MISS_COST`` times. A score s so weighed stands for a probability of
s / (s + MISS_COST (1 - s)), and 0.5 is where a miss costs what a false alarm
does.

Bounds: the model is fitted on at most ``max_docs`` labelled documents per
class, chosen by a hash of their ids, and on ``MAX_BAGS`` bags of each, chosen
at random from the whole text; words of over ``LONGEST_WORD`` characters do not
train. The tasks cut the bags, so the driver sees no more than these.
Everything else reads all rows: all texts are scored whole. The fitted model
is a table of 2^16 vectors whatever the input, broadcast as one float per
bucket.

Cases: a null or empty text has no bag and the model's bias as its score;
labels that are null do not train; a document labelled both ways is toxic;
without labels of both classes every score is 0; rows that share an id are
scored one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import Scratch, map_arrow, pick, python_strings, rows_in

BUCKETS = 1 << 16
DIM = 8
BAG = 5
GRAMS = (3, 4, 5)
MAX_DOCS = 1500
MAX_BAGS = 400
MISS_COST = 3.0  # of a toxic document that is missed, in false alarms
LONGEST_WORD = 100
CALIBRATE = 5  # one document of so many is kept out of the fit
ROUNDS = 2
EPOCHS = 3  # per round, more of them until there are STEPS batches
STEPS = 250
BATCH = 1024
HOLD_OUT = 5  # a row is held out where crc32(id) mod HOLD_OUT is 0
WORDS_KEPT = 300_000
EDGE = ".,!?;:%$&*#|\"'()[]<>-"


def words_of(text: str) -> list[str]:
    return [w.strip(EDGE) for w in text.lower().split()]


def buckets_of(word: str) -> list[int]:
    """Buckets of the word and its character n-grams."""
    if not word:
        return []
    marked = f"<{word}>"
    grams = {marked, *(marked[i:i + n] for n in GRAMS for i in range(len(marked) - n + 1))}
    return sorted({zlib.crc32(g.encode()) % BUCKETS for g in grams})


def _means(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Mean of each run of ``sizes`` rows of ``flat``; zero for empty runs."""
    ends = np.cumsum(sizes)
    total = np.concatenate([np.zeros((1, *flat.shape[1:])), np.cumsum(flat, axis=0, dtype=np.float64)])
    shape = (-1,) + (1,) * (flat.ndim - 1)
    return (total[ends] - total[ends - sizes]) / np.maximum(sizes, 1).reshape(shape)


def worst_bag(scores: np.ndarray, bag: int) -> float:
    """Largest mean of ``bag`` word scores in a row (of all, if fewer)."""
    if not len(scores):
        return 0.0
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    size = min(bag, len(scores))
    return float((sums[size:] - sums[:-size]).max() / size)


@dataclass
class Model:
    """Per bucket the softmax logit (class 1 less class 0) of its vector, the
    bias, and the map from a worst bag's logit to a probability."""

    buckets: np.ndarray
    bias: float
    slope: float
    shift: float
    bag: int = BAG

    def word_scores(self, words: list[str]) -> np.ndarray:
        found = [buckets_of(w) for w in words]
        sizes = np.array([len(b) for b in found], np.int64)
        flat = self.buckets[np.fromiter((x for b in found for x in b), np.int64, int(sizes.sum()))]
        return _means(flat, sizes)


class _Trainer:
    def __init__(self, words: list[str], seed: int = 7):
        self.rng = np.random.default_rng(seed)
        found = [buckets_of(w) for w in words]
        self.sizes = np.array([len(b) for b in found], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.flat = np.fromiter((x for b in found for x in b), np.int64, int(self.sizes.sum()))
        self.vectors = self.rng.normal(0, 0.1, (BUCKETS, DIM))
        self.out = np.zeros((DIM, 2))
        self.bias = np.zeros(2)
        self.g_vectors = np.full((BUCKETS, DIM), 1e-8)
        self.g_out, self.g_bias = np.full((DIM, 2), 1e-8), np.full(2, 1e-8)
        self.out += self.rng.normal(0, 0.1, (DIM, 2))

    def step(self, bags: np.ndarray, present: np.ndarray, labels: np.ndarray, weight: np.ndarray, rate: float = 0.3) -> None:
        words, inverse = np.unique(bags, return_inverse=True)
        inverse = inverse.reshape(bags.shape)
        sizes = self.sizes[words]
        where = np.repeat(self.ends[words] - np.cumsum(sizes), sizes) + np.arange(sizes.sum())
        buckets = self.flat[where]
        of_word = np.repeat(np.arange(len(words)), sizes)
        per_word = _means(self.vectors[buckets], sizes)
        share = present / np.maximum(present.sum(1, keepdims=True), 1)
        hidden = np.einsum("bw,bwd->bd", share, per_word[inverse])
        logits = hidden @ self.out + self.bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        delta = (p - np.eye(2)[labels]) * weight[:, None] / weight.sum()
        d_out, d_bias, d_hidden = hidden.T @ delta, delta.sum(0), delta @ self.out.T
        d_words = np.empty((len(words), DIM))
        for k in range(DIM):
            d_words[:, k] = np.bincount(inverse.ravel(), (share * d_hidden[:, k:k + 1]).ravel(), len(words))
        d_words /= np.maximum(sizes, 1)[:, None]
        used, slot = np.unique(buckets, return_inverse=True)
        d_used = np.stack([np.bincount(slot, d_words[of_word, k], len(used)) for k in range(DIM)], axis=1)
        self.g_vectors[used] += d_used**2
        self.vectors[used] -= rate * d_used / np.sqrt(self.g_vectors[used])
        self.g_out += d_out**2
        self.out -= rate * d_out / np.sqrt(self.g_out)
        self.g_bias += d_bias**2
        self.bias -= rate * d_bias / np.sqrt(self.g_bias)

    def logits(self) -> tuple[np.ndarray, float]:
        """(per word logit, bias)."""
        edge = self.out[:, 1] - self.out[:, 0]
        return _means((self.vectors @ edge)[self.flat], self.sizes), float(self.bias[1] - self.bias[0])


def cut(text: str, bag: int, limit: int, seed: int) -> list[str]:
    """Bags of a text, their words joined by spaces; ``limit`` of them at random."""
    words = [w if len(w) <= LONGEST_WORD else "" for w in words_of(text)]
    starts = range(0, max(1, len(words)), bag)
    if len(starts) > limit:
        starts = random.Random(seed).sample(starts, limit)
    return [" ".join(words[at:at + bag]) for at in starts]


def train(cuts: list[list[str]], labels: list[int], bag: int = BAG) -> Model | None:
    """Fit the model on the bags of each document; None unless both classes
    are present. Its probabilities are the softmax's, see :func:`calibrate`."""
    truth = np.array(labels, np.int64)
    if not len(truth) or truth.min() == truth.max():
        return None
    ids: dict[str, int] = {}
    owner = np.repeat(np.arange(len(cuts)), [len(c) for c in cuts])
    bags = np.full((len(owner), bag), -1, np.int64)
    for row, text in enumerate(b for c in cuts for b in c):
        words = text.split(" ")
        bags[row, :len(words)] = [ids.setdefault(w, len(ids)) for w in words]
    trainer = _Trainer(list(ids))
    present = bags >= 0
    y, use = truth[owner], np.ones(len(bags), bool)
    for _ in range(ROUNDS):
        rows = np.flatnonzero(use)
        epochs = max(EPOCHS, -(-STEPS * BATCH // max(1, len(rows))))
        balance = np.where(y == 1, 0.5 / max(1, y[rows].sum()), 0.5 / max(1, (1 - y[rows]).sum())) * len(rows)
        for _ in range(epochs):
            trainer.rng.shuffle(rows)
            for at in range(0, len(rows), BATCH):
                some = rows[at:at + BATCH]
                trainer.step(np.maximum(bags[some], 0), present[some], y[some], balance[some])
        scores, bias = trainer.logits()
        of_bag = (scores[np.maximum(bags, 0)] * present).sum(1) / np.maximum(present.sum(1), 1) + bias
        best = np.full(len(cuts), -np.inf)
        np.maximum.at(best, owner, of_bag)
        use = (truth[owner] == 0) | (of_bag > 0) & (of_bag > 0.5 * best[owner]) | (of_bag == best[owner])
    edge = trainer.out[:, 1] - trainer.out[:, 0]
    return Model((trainer.vectors @ edge).astype(np.float32), bias, 1.0, 0.0, bag)


def calibrate(model: Model, worst: np.ndarray, labels: np.ndarray, share: float) -> Model:
    """The model with probabilities fitted to documents kept out of it, of
    which toxic ones are ``share`` of all; unchanged without both classes."""
    if len(set(labels.tolist())) < 2:
        return model
    share = MISS_COST * share / (MISS_COST * share + 1 - share)
    slope, shift = _probabilities(worst + model.bias, labels, share)
    return replace(model, slope=slope, shift=shift)


def _probabilities(logits: np.ndarray, labels: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and shift of a logistic fit by Newton steps, lightly shrunk; the
    classes weigh by ``share``, since the sample has its own."""
    spread = max(float(np.std(logits)), 1e-6)
    x = np.stack([(logits - logits.mean()) / spread, np.ones(len(logits))], axis=1)
    weight = np.where(labels == 1, share / labels.sum(), (1 - share) / (1 - labels).sum()) * len(labels)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag([0.1, 1e-3])
        w = w - np.linalg.solve(hessian, x.T @ (weight * (p - labels)) + np.array([0.1, 1e-3]) * w)
    slope = max(float(w[0]), 1e-3) / spread
    return slope, float(w[1]) - slope * float(logits.mean())


def held_out(id_col: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(HOLD_OUT)) == 0


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model | None:
    """Fit on labelled documents that are not held out, ``max_docs`` a class.

    The sample's texts are written once; tasks cut the bags of those that
    train and score those kept out, so neither is gathered as text.
    """
    known = pick(labels, id_col, label_col).toDF("_id", "_label").filter("_id is not null and _label is not null")
    known = known.filter(~held_out(F.col("_id"))).groupBy("_id").agg(F.max((F.col("_label") == 1).cast("int")).alias("_label"))
    by_hash = [F.xxhash64("_id"), F.col("_id")]
    sample = known.filter("_label = 1").orderBy(*by_hash).limit(max_docs).union(known.filter("_label = 0").orderBy(*by_hash).limit(max_docs))
    ids = F.broadcast(sample)  # 2 * max_docs rows
    texts = pick(docs, id_col, text_col).toDF("_id", "_text").join(ids, "_id")
    kind = texts.schema["_id"].dataType.simpleString()
    # a row of each id; copies of one id would outweigh the rest
    one = texts.groupBy("_id").agg(F.min(F.coalesce(F.col("_text").cast("string"), F.lit(""))).alias("_text"), F.first("_label").alias("_label"))
    one = one.withColumn("_apart", F.pmod(F.xxhash64(F.lit("calibrate"), "_id"), F.lit(CALIBRATE)) == 0)

    def cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in(batches, 64):
            found = [cut(t, BAG, MAX_BAGS, zlib.crc32(str(i).encode())) for i, t in zip(batch.column(0).to_pylist(), python_strings(batch.column(2)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.string()))], names=["_id", "_label", "_bags"])

    scratch = Scratch(docs.sparkSession, "toxicity")
    try:
        rows = scratch.write(one.select("_id", "_label", "_text", "_apart"), "sample")
        mine = map_arrow(rows.filter("not _apart").select("_id", "_label", "_text"), cut_rows, f"_id {kind}, _label int, _bags array<string>")
        mine = sorted(mine.collect(), key=lambda r: r["_id"])
        model = train([r["_bags"] for r in mine], [r["_label"] for r in mine])
        if model is None:
            return None
        truth = {r["_id"]: r["_label"] for r in rows.filter("_apart").select("_id", "_label").collect()}
        worst = {r["_id"]: r["_worst"] for r in _worst(rows.filter("_apart").select("_id", "_text"), model).collect()}
        share = known.agg(F.avg("_label").alias("share")).first()["share"]
        at = sorted(truth)
        return calibrate(model, np.array([worst[i] for i in at]), np.array([truth[i] for i in at], np.int64), float(share))
    finally:
        scratch.drop()


def _worst(source: DataFrame, model: Model) -> DataFrame:
    """(_id, _worst): the score of the worst bag of each row's whole text."""
    kind = source.schema["_id"].dataType.simpleString()
    shared = source.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        known: dict[str, float] = {}
        for batch in rows_in(batches, 256):
            texts = [words_of(t) for t in python_strings(batch.column(1))]
            if len(known) > WORDS_KEPT:
                known.clear()
            new = list({w for words in texts for w in words if w not in known})
            known.update(zip(new, m.word_scores(new).tolist()))
            worst = [worst_bag(np.fromiter(map(known.__getitem__, words), np.float64, len(words)), m.bag) for words in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(worst, pa.float64())], names=["_id", "_worst"])

    return map_arrow(source, run, f"_id {kind}, _worst double")


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score double) per row of ``docs``."""
    source = pick(docs, id_col, text_col).toDF("_id", "_text").withColumn("_text", F.col("_text").cast("string"))
    if model is None:
        return source.select(F.col("_id").alias(id_col), F.lit(0.0).alias("score"))
    odds = F.lit(model.slope) * (F.col("_worst") + F.lit(model.bias)) + F.lit(model.shift)
    bounded = F.greatest(F.least(odds, F.lit(30.0)), F.lit(-30.0))
    return _worst(source, model).select(F.col("_id").alias(id_col), (1 / (1 + F.exp(-bounded))).alias("score"))


def classify(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    scored = score(docs, fit(docs, labels, max_docs))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
