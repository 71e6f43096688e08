"""Toxicity by subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the average of the embeddings of its character n-grams (with word edges) and of itself, hashed into a fixed
number of buckets, so an unseen misspelling shares most vectors with the word it hides. A bag of words is the average of
its words, and goes through a softmax of two classes. Embeddings and softmax are trained together by Adagrad.

Most words of any text say nothing, and their noise would drown a few telling words in the average of a long text. So bags
are gated: a word whose own logit is below the level that 99 % of the sample's words stay under counts as a zero vector, any
other word counts with what it has above that level, and the average goes over all words of the text. A text's score is
the softmax probability of its gated bag. Embeddings and softmax are trained on averaged bags throughout: on whole documents,
then on bags of the words by which the model tells documents apart (_telling), and at last on the documents' gated bags.

Labels come from a bounded sample: at most `rows` labelled documents, half a class, of up to `chars` characters, by the
smallest hashes of doc_id. One task trains on them. A fifth of them doesn't train embeddings: it sets the bias and the temperature
of the softmax, so that 0.7 is where toxic and clean documents part best. Every text is scored whole.

Defined cases: null and empty texts and texts without words get the lowest score; labels that are null or
neither 0 nor 1 are left out; of contradicting labels of one document the larger counts; if a class is missing, every score
is 0 and nothing is predicted toxic; the stage rejects rows by their own text, so rows that share a doc_id, or have none,
don't share a verdict; repeated rows give repeated results; an empty table gives an empty result; columns
other than doc_id and text (and doc_id and toxic of the labels) are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_batches, materialize, only, text_column

BUCKETS, DIM = 1 << 17, 8
GRAMS = (3, 4, 5, 6)
ROWS, CHARS = 4000, 50_000
#: Share of the sample's words that are below the level that counts; words added to a text's length, so that one word of a short text doesn't decide alone.
QUIET, EXTRA = 0.99, 5
CUT = 0.7

words_of = re.compile(r"[^\W_]+").findall


def subwords(word: str) -> list[int]:
    """Buckets of a word and of its n-grams."""
    marked = f"<{word}>"
    found = [zlib.crc32(f"={word}".encode()) % BUCKETS]
    for n in GRAMS:
        found += [zlib.crc32(marked[i : i + n].encode()) % BUCKETS for i in range(len(marked) - n + 1)]
    return found


@dataclass
class Toxicity:
    """weight: the softmax's difference of logits for each bucket; level: of the gates; scale and bias: its temperature and bias."""

    weight: np.ndarray
    level: float = 0.0
    scale: float = 1.0
    bias: float = 0.0
    constant: float | None = None
    keep: int = 200_000
    known: dict[str, float] = field(default_factory=dict, repr=False)

    def word(self, word: str) -> float:
        """What a word adds to a gated bag's logit."""
        value = max(0.0, float(self.weight[subwords(word)].mean()) - self.level)
        if len(word) <= 40:
            if len(self.known) >= self.keep:
                self.known.clear()
            self.known[word] = value
        return value

    def logit(self, text: str) -> float:
        """Of the averaged bag, without bias and temperature."""
        words = words_of(text.lower())
        get, miss = self.known.get, self.word
        return sum(v if (v := get(w)) is not None else miss(w) for w in words) / (len(words) + EXTRA)

    def score(self, text: str) -> float:
        if self.constant is not None:
            return self.constant
        return float(1 / (1 + np.exp(-np.clip(self.scale * self.logit(text) + self.bias, -40, 40))))


class _Bags:
    """Documents of a training sample as word numbers; words as bucket numbers, worked on PART words at a time: little memory."""

    PART = 1 << 16

    def __init__(self, texts: list[str]):
        number: dict[str, int] = {}
        self.docs = [np.array([number.setdefault(w, len(number)) for w in words_of(t.lower())], dtype=np.int32) for t in texts]
        ids, sizes = array("i"), array("i")
        for word in number:
            grams = subwords(word)
            ids.extend(grams)
            sizes.append(len(grams))
        self.ids, self.sizes = np.array(ids, dtype=np.int32), np.array(sizes, dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.each = 1.0 / np.maximum(self.sizes, 1)
        held = np.zeros(len(self.sizes))
        for d in self.docs:
            held[np.unique(d)] += 1
        #: buckets seen in few documents say nothing about others
        self.common = self.sums(held) >= 3

    def parts(self) -> Iterator[tuple[slice, np.ndarray]]:
        for a in range(0, len(self.sizes), self.PART):
            z = min(a + self.PART, len(self.sizes))
            yield slice(a, z), self.ids[self.starts[a] : self.starts[z]]

    def sums(self, by_word: np.ndarray) -> np.ndarray:
        """For each bucket the sum over the words that hold it."""
        out = np.zeros(BUCKETS)
        for part, ids in self.parts():
            out += np.bincount(ids, weights=np.repeat(by_word[part], self.sizes[part]), minlength=BUCKETS)
        return out

    def words(self, weight: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.sizes))
        for part, ids in self.parts():
            out[part] = np.add.reduceat(weight[ids], self.starts[part] - self.starts[part.start])
        return out * self.each

    def buckets(self, by_word: np.ndarray) -> np.ndarray:
        return self.sums(by_word * self.each)


class _Model:
    """Embeddings and softmax under Adagrad. Embeddings are worked on PART buckets at a time: little memory."""

    PART = 1 << 13

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.e, self.w, self.b = rng.normal(0, 0.1, (BUCKETS, DIM)), rng.normal(0, 0.5, (2, DIM)), 0.0
        self.ge, self.gw, self.gb = np.full((BUCKETS, DIM), 1e-8), np.full((2, DIM), 1e-8), 1e-8

    def weight(self, bags: _Bags) -> np.ndarray:
        return np.where(bags.common, self.e @ (self.w[1] - self.w[0]), 0.0)

    def step(self, bags: _Bags, words: np.ndarray, bag: np.ndarray, size: np.ndarray, y: np.ndarray, share: np.ndarray, rate: float, level: float = 0.0) -> None:
        """words and bag: each word of each bag; size, y, share: of each bag; level: what gates take off a word's logit."""
        weight = self.weight(bags)
        z = self.b + np.bincount(bag, weights=bags.words(weight)[words] - level, minlength=len(y)) / size
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * share
        by_word = np.bincount(words, weights=(error / size)[bag], minlength=len(bags.each))
        by_bucket = np.where(bags.common, bags.buckets(by_word), 0.0)
        u = self.w[1] - self.w[0]
        grad_w = by_bucket @ self.e
        for a in range(0, BUCKETS, self.PART):
            part = slice(a, a + self.PART)
            grad_e = by_bucket[part, None] * u[None, :] + 1e-7 * self.e[part]
            self.ge[part] += grad_e**2
            self.e[part] -= rate * grad_e / np.sqrt(self.ge[part])
        for c, sign in ((0, -1.0), (1, 1.0)):
            g = sign * grad_w + 1e-4 * self.w[c]
            self.gw[c] += g**2
            self.w[c] -= rate * g / np.sqrt(self.gw[c])
        g = float(error.sum())
        self.gb += g * g
        self.b -= rate * g / np.sqrt(self.gb)


def _flat(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.array([len(d) for d in docs], dtype=np.int64)
    return np.concatenate(docs), np.repeat(np.arange(len(docs)), size), size.astype(float)


def _telling(bags: _Bags, fit: list[int], y: np.ndarray, values: np.ndarray, rng: np.random.Generator) -> tuple[list[np.ndarray], np.ndarray]:
    """Bags of the words that speak for toxicity, with labels: of a toxic document the highest hundredth as one bag, of a clean one
    its four highest words and any one, as bags of their own."""
    chosen, labels = [], []
    for i in fit:
        words = np.unique(bags.docs[i])
        best = words[np.argsort(-values[words], kind="stable")]
        parts = [best[: 1 + len(best) // 100]] if y[i] else [*np.split(best[:4], len(best[:4])), best[rng.integers(0, len(best), 1)]]
        chosen += parts
        labels += [y[i]] * len(parts)
    return chosen, np.array(labels)


def train(texts: list[str], toxic: list[int], seed: int = 0, steps: int = 80, turns: int = 2, gated: int = 1, turn_steps: int = 15, rate: float = 0.2) -> Toxicity:
    """texts in an order that doesn't depend on the labels; every fifth of a class sets bias and temperature."""
    y = np.array(toxic, dtype=float)
    if not len(y) or y.min() == y.max():
        return Toxicity(np.zeros(1), constant=0.0)
    bags = _Bags(texts)
    rank = np.zeros(len(y), dtype=int)
    for c in (0.0, 1.0):
        rank[y == c] = np.arange(int((y == c).sum()))
    fit = [i for i in range(len(y)) if rank[i] % 5 and len(bags.docs[i])]
    model = _Model(seed)
    found = Toxicity(np.zeros(BUCKETS, dtype=np.float32))
    if fit:
        words, bag, size = _flat([bags.docs[i] for i in fit])
        yy = y[fit]
        share = np.where(yy > 0, 0.5 / max(1, yy.sum()), 0.5 / max(1, (1 - yy).sum()))
        for _ in range(steps):
            model.step(bags, words, bag, size, yy, share, rate=0.3)
        for _ in range(turns):
            chosen, labels = _telling(bags, fit, y, bags.words(model.weight(bags)), np.random.default_rng(seed))
            part = np.where(labels > 0, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
            flat = _flat(chosen)
            for _ in range(turn_steps):
                model.step(bags, *flat, labels, part, rate)
        for turn in range(gated + 1):
            values = bags.words(model.weight(bags))[words]
            level = float(np.quantile(values, QUIET))
            if turn < gated:
                loud = values > level
                for _ in range(turn_steps):
                    model.step(bags, words[loud], bag[loud], size + EXTRA, yy, share, rate, level)
        found = Toxicity(model.weight(bags).astype(np.float32), level)
    values = np.maximum(0.0, bags.words(found.weight.astype(float)) - found.level)
    z = np.array([values[d].sum() / (len(d) + EXTRA) for d in bags.docs])
    at, found.scale = _cut(z, y, np.array([r % 5 == 0 for r in rank]))
    found.bias = float(np.log(CUT / (1 - CUT)) - found.scale * at)
    return found


def _cut(z: np.ndarray, y: np.ndarray, held: np.ndarray) -> tuple[float, float]:
    """The logit where the held rows' F1 is best, and the temperature: the middle rows of the classes score up to 0.97 and down to 0.01."""
    if not y[held].any() or y[held].all():
        held = np.ones(len(y), bool)
    z, y = z[held], y[held]
    order = np.argsort(-z, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(z) + 1) + y.sum())
    k = int(np.argmax(f1))
    above, below = z[order[k]], z[order[k + 1]] if k + 1 < len(z) else z[order[k]] - 1
    t = float(above + below) / 2
    gap = max(1e-3, float(np.median(z[y > 0])) - t, (t - float(np.median(z[y == 0]))) / 2)
    return t, 2.6 / gap


def fold(doc_id: str = "doc_id", of: int = 3) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % of


def _sample(docs: DataFrame, labels: DataFrame, may_train: Column, rows: int, chars: int) -> DataFrame:
    """k, doc_id, toxic, text of the bounded training sample, at most `rows` rows. Of several texts under one doc_id the last one counts."""
    held = only(labels, doc_id="long", toxic="int").where("toxic in (0, 1) and doc_id is not null").where(may_train)
    held = held.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    short = only(docs, doc_id="long", text="string").select("doc_id", F.char_length(text_column()).alias("n")).where(F.col("n") <= chars).groupBy("doc_id").agg(F.min("n").alias("n"))
    held = materialize(held.join(short, "doc_id").select("doc_id", "toxic", F.xxhash64("doc_id").alias("k")), "toxic-labels")
    few = [held.where(F.col("toxic") == c).orderBy("k", "doc_id").limit(rows // 2) for c in (0, 1)]
    chosen = F.broadcast(few[0].unionByName(few[1]))  # at most `rows` rows
    got = only(docs, doc_id="long", text="string").where(F.char_length(text_column()) <= chars).join(chosen, "doc_id")
    return got.groupBy("k", "doc_id", "toxic").agg(F.max(text_column()).alias("text"))


def _in_order(rows: list) -> tuple[list[str], list[int]]:
    rows = sorted(rows, key=lambda r: (r["k"], r["doc_id"]))
    return [r["text"] for r in rows], [r["toxic"] for r in rows]


def sample(docs: DataFrame, labels: DataFrame, may_train: Column, rows: int = ROWS, chars: int = CHARS) -> tuple[list[str], list[int]]:
    """Texts and labels of the bounded training sample. may_train: a condition on doc_id."""
    return _in_order(_sample(docs, labels, may_train, rows, chars).collect())


def fit(docs: DataFrame, labels: DataFrame, may_train: Column, rows: int = ROWS, chars: int = CHARS) -> Toxicity:
    """train() on sample() in one task: the driver gets the model alone, neither texts nor what training holds."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = train(*_in_order([r for batch in batches for r in batch.to_pylist()]))
        columns = [pa.array([model.weight.astype(np.float32).tobytes()], pa.binary())]
        columns += [pa.array([x], pa.float64()) for x in (model.level, model.scale, model.bias, model.constant)]
        yield pa.RecordBatch.from_arrays(columns, ["weight", "level", "scale", "bias", "constant"])

    one = _sample(docs, labels, may_train, rows, chars).repartition(1)
    got = in_batches(one, work, "weight binary, level double, scale double, bias double, constant double").collect()
    if not got:  # an empty sample may have no task
        return train([], [])
    return Toxicity(np.frombuffer(bytes(got[0]["weight"]), dtype=np.float32), *got[0][1:])


def score(docs: DataFrame, model: Toxicity) -> DataFrame:
    """docs' doc_id with score, one row per row. The model has a fixed size and goes with the tasks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([model.score(t.as_py()) for t in batch.column(1)], pa.float64())], ["doc_id", "score"])

    return in_batches(only(docs, doc_id="long", text="string").select("doc_id", text_column().alias("text")), work, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, may_train: Column, rows: int = ROWS, chars: int = CHARS, cut: float = CUT) -> DataFrame:
    """One row per row of docs: doc_id, score, predicted."""
    model = fit(docs, labels, may_train, rows, chars)
    return score(docs, model).withColumn("predicted", (F.col("score") >= cut).cast("int"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the rows that aren't rejected, each by its own text, whatever its doc_id."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), fold() != 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([model.score(t.as_py() or "") < CUT for t in batch.column("text")], pa.bool_()))

    return in_batches(docs, work, docs.schema)
