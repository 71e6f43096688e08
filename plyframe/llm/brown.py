"""Language-model scores by Brown class-based bigrams.

The score of a token is log10 P(class | class before) + log10 P(word | class). The most frequent words are put into classes
by exchange clustering: each word in turn moves to the class that raises the mutual information of adjacent classes most.
Then every other word seen LEAST times goes to the class that raises it most against the class matrix of the first ones, by
its own counts of the classes beside it. Words seen once stand for the unseen ones: both are in classes by a hash of their
last two bytes. The end of a text is a class of its own. Transitions are then counted anew over the classes of all words.
Transitions are smoothed towards the class frequencies, emissions by ADD for each known word and one unknown word a class.

All counts are over all training texts. Texts are read twice: to count words, and to write them as numbers of the HEAD most
frequent words, with the other words beside them. The numbers then serve every pass. What the tasks get is bounded: the
head's words, classes and counts. Words beyond the head are rare, so their tokens meet by word without hot keys, where they are
counted and put into classes, and go back to their texts with both; each text is then a sequence of classes.

Defined cases: null text counts as empty; an empty text is its end token; a null doc_id is neither trained on nor held out;
without training texts all counts are 0; repeated rows give repeated results; an empty table gives an empty result; columns
other than doc_id and text are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, in_batches, materialize, only, text_column

ADD = 0.1
HEAD, CLUSTERED, CLASSES, RULES = 100_000, 1000, 64, 32
#: Words seen fewer times stand for the unseen ones.
LEAST = 2
#: Weight of the class frequencies in a transition.
BACK = 5.0
#: Distinct words that a task counts before it passes them on.
HELD = 300_000
END = b""


def tokens(text: bytes) -> list[bytes]:
    """Words of a text, A-Z in lower case; the end comes after them."""
    return text.lower().split()


def rule(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % RULES


def count_words(texts: DataFrame) -> DataFrame:
    """word, c over all texts; the end is the empty word."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                seen.update(tokens(text.as_py()))
                seen[END] += 1
            if len(seen) > HELD:
                yield flush(seen)
                seen.clear()
        yield flush(seen)

    def flush(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    return in_batches(texts.select("text"), work, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def most_frequent(vocabulary: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """About `most` (word, c), most frequent first: whole bands of counts from the top, and of the band that doesn't go in the words with the smallest hashes.

    Each task sends only rows that belong to the result; the bands, 16 an octave, are at most a thousand rows, and so are a band's
    4096 lots of hashes.
    """
    banded = vocabulary.withColumn("band", F.floor(F.log2("c") * 16)).withColumn("lot", F.pmod(F.xxhash64("word"), F.lit(4096)))
    room, last, lots = most, None, 0
    for r in sorted(banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r["band"]):
        last = r["band"]
        if r["n"] > room:
            for x in banded.where(F.col("band") == last).groupBy("lot").agg(F.count(F.lit(1)).alias("n")).orderBy("lot").collect():
                if x["n"] > room:
                    break
                room, lots = room - x["n"], x["lot"] + 1
            break
        room, lots = room - r["n"], 4096
    if last is None:
        return []
    found = banded.where((F.col("band") > last) | (F.col("band") == last) & (F.col("lot") < lots)).select("word", "c").collect()
    return sorted(((bytes(r["word"]), r["c"]) for r in found), key=lambda x: (-x[1], x[0]))


def encode(rows: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """rid (unique), doc_id, train, ids (a 32-bit number a word: the head's, or -1 - rule beyond it), rest (the words beyond it).

    rows: rid, doc_id, train, text.
    """
    shared = rows.sparkSession.sparkContext.broadcast(number)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, rules = shared.value.get, {}
        for batch in batches:
            ids, rest = [], []
            for text in batch.column("text"):
                words = tokens(text.as_py())
                found = list(map(get, words))
                beyond = []
                if None in found:
                    for i, x in enumerate(found):
                        if x is None:
                            word = words[i]
                            beyond.append(word)
                            if (r := rules.get(tail := word[-2:])) is None:
                                r = rules[tail] = -1 - rule(word)
                            found[i] = r
                ids.append(np.array(found, dtype=np.int32).tobytes())
                rest.append(beyond)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("rid", "doc_id", "train")), pa.array(ids, pa.binary()), pa.array(rest, pa.list_(pa.binary()))], ["rid", "doc_id", "train", "ids", "rest"])

    return in_batches(rows.select("rid", "doc_id", "train", "text"), work, "rid long, doc_id long, train boolean, ids binary, rest array<binary>")


def _laid(ids: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbers of several texts end to end, each text's length, and the places of the numbers where an end stands before each text and after the last."""
    values = [np.frombuffer(x.as_buffer(), dtype=np.int32) for x in ids]
    sizes = np.array([len(v) for v in values], dtype=np.int64)
    flat = np.concatenate([np.empty(0, dtype=np.int32), *values]).astype(np.int64)
    return flat, sizes, np.arange(len(flat)) + np.repeat(np.arange(1, len(sizes) + 1), sizes)


def _codes(ids: pa.Array, head: np.ndarray, beyond: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """_laid(), and the texts' codes with ends: head has the code of each head word, rule classes begin at `beyond`."""
    flat, sizes, at = _laid(ids)
    out = np.full(len(flat) + len(sizes) + 1, end, dtype=np.int64)
    out[at] = np.where(flat >= 0, head[np.maximum(flat, 0)] if len(head) else 0, beyond - 1 - flat)
    return flat, sizes, at, out


def count_pairs(coded: DataFrame, head: np.ndarray, beyond: int) -> np.ndarray:
    """Adjacent codes over all texts, as a matrix of fixed size; the end is the last code."""
    width = beyond + RULES + 1
    shared = coded.sparkSession.sparkContext.broadcast(head)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(width * width, dtype=np.int64)
        for batch in batches:
            *_, codes = _codes(batch.column("ids"), shared.value, beyond, width - 1)
            np.add.at(sums, codes[:-1] * width + codes[1:], 1 if len(codes) > 1 else 0)
        yield _sparse(sums)

    return _square(in_batches(coded.select("ids"), work, "pair long, n long"), width)


def _sparse(sums: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(sums)
    return pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["pair", "n"])


def _square(pairs: DataFrame, width: int) -> np.ndarray:
    """pair, n summed up as a matrix: at most width * width rows."""
    rows = pairs.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(width * width)
    out[rows.column("pair").to_numpy()] = rows.column("n").to_numpy()
    return out.reshape(width, width)


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(pairs: np.ndarray, n: int, classes: int = CLASSES, passes: int = 6) -> np.ndarray:
    """Classes of words 0..n-1; what follows them in `pairs` keeps classes of its own.

    Maximises sum f(C[g, h]) - sum f(C[g, .]) - sum f(C[., h]), f(x) = x log x: the mutual information of adjacent classes.
    """
    fixed = pairs.shape[0] - n
    k = max(1, min(classes, n))
    total = k + fixed
    of = np.concatenate([np.arange(n) % k, k + np.arange(fixed)])
    one = np.zeros((n + fixed, total))
    one[np.arange(n + fixed), of] = 1
    right, left = pairs @ one, pairs.T @ one  # of each word: what follows it and comes before it, by class
    c = one.T @ right
    own = np.arange(k)
    for _ in range(passes):
        moved = 0
        for w in range(n):
            a, self_ = of[w], pairs[w, w]
            r, l = right[w].copy(), left[w].copy()
            r[a] -= self_
            l[a] -= self_
            c[a, :] -= r
            c[:, a] -= l
            c[a, a] -= self_
            rows, cols = c[:k], c[:, :k].T
            gain = (_f(rows + r) - _f(rows)).sum(1) + (_f(cols + l) - _f(cols)).sum(1)
            diag = c[own, own]
            gain += -(_f(diag + r[:k]) - _f(diag)) - (_f(diag + l[:k]) - _f(diag)) + _f(diag + r[:k] + l[:k] + self_) - _f(diag)
            before, after = rows.sum(1) + l[:k], cols.sum(1) + r[:k]  # tokens of each class as first and as second
            gain -= _f(before + r.sum() + self_) - _f(before) + _f(after + l.sum() + self_) - _f(after)
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            c[b, :] += r
            c[:, b] += l
            c[b, b] += self_
            if b != a:
                of[w] = b
                right[:, a] -= pairs[:, w]
                right[:, b] += pairs[:, w]
                left[:, a] -= pairs[w]
                left[:, b] += pairs[w]
                moved += 1
        if not moved:
            break
    return of[:n]


class Chooser:
    """Classes of words by the classes beside them, against the matrix of the clustered words' classes: those that raise the mutual information most."""

    def __init__(self, moves: np.ndarray, k: int):
        self.k, self.groups = k, len(moves)
        self.to = np.concatenate([moves[:k].T, moves[:, :k]])  # of each code: tokens of each class beside it
        self.logs, self.one, self.two = _f(self.to), moves[:k].sum(1), moves[:, :k].sum(0)

    def choose(self, c: np.ndarray, word: np.ndarray, code: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Class of each word. c: its count; word, code, n: sorted by word; a class that follows a word is its code, one before it comes after all of these."""
        gain = _f(self.one) + _f(self.two) - _f(self.one + c[:, None]) - _f(self.two + c[:, None])
        for i in range(0, len(word), 1 << 14):
            x, w = code[i : i + (1 << 14)], word[i : i + (1 << 14)]
            starts = np.flatnonzero(np.diff(w, prepend=-1))
            gain[w[starts]] += np.add.reduceat(_f(self.to[x] + n[i : i + (1 << 14), None]) - self.logs[x], starts)
        return gain.argmax(1)


def head_classes(coded: DataFrame, of: np.ndarray, first: int, chooser: Chooser, counts: np.ndarray) -> np.ndarray:
    """Classes of the head words from number `first` on. of: classes of the first ones, and rule classes of the others."""
    k, groups, n = chooser.k, chooser.groups, len(of) - first
    out = of.copy()
    if n <= 0 or not k:
        return out
    width = 2 * groups
    shared = coded.sparkSession.sparkContext.broadcast(of)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(n * width, dtype=np.int32)  # of bounded size
        for batch in batches:
            flat, _, at, codes = _codes(batch.column("ids"), shared.value, k, groups - 1)
            mine = flat >= first
            base, at = (flat[mine] - first) * width, at[mine]
            np.add.at(sums, base + codes[at + 1], 1)
            np.add.at(sums, base + groups + codes[at - 1], 1)
        at = np.flatnonzero(sums)
        word, values = at // width, sums[at]
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        offsets = pa.array(np.append(starts, len(at)), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(t))) for x, t in ((at % width, np.int16), (values, np.int32))]
        yield pa.RecordBatch.from_arrays([pa.array(word[starts]), *lists], ["word", "codes", "n"])

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: dict[str, list] = {"key": [np.empty(0, np.int64)], "n": [np.empty(0, np.int64)]}
        size = 0
        for batch in batches:
            codes = batch.column("codes")
            cells["key"].append(np.repeat(batch.column("word").to_numpy(), codes.value_lengths().to_numpy()) * width + codes.flatten().to_numpy())
            cells["n"].append(batch.column("n").flatten().to_numpy().astype(np.int64))
            size += len(cells["n"][-1])
            if size > 4_000_000:
                key, m = summed(cells)
                cells, size = {"key": [key], "n": [m]}, 0
        key, m = summed(cells)
        words, word = np.unique(key // width, return_inverse=True)
        if len(words):
            got = chooser.choose(counts[words + first], word, key % width, m.astype(float))
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(got.astype(np.int32))], ["word", "class"])

    def summed(cells: dict[str, list]) -> tuple[np.ndarray, np.ndarray]:
        key, where = np.unique(np.concatenate(cells["key"]), return_inverse=True)
        return key, np.bincount(where, weights=np.concatenate(cells["n"]), minlength=len(key)).astype(np.int64)

    found = in_batches(coded.select("ids"), work, "word long, codes array<short>, n array<int>").repartition("word")
    rows = in_batches(found, pick, "word long, class int").toArrow()  # at most a row a head word
    word, got = (rows.column(c).to_numpy() for c in ("word", "class"))
    out[word + first] = np.where(counts[word + first] >= LEAST, got, out[word + first])
    return out


def tails(coded: DataFrame, of: np.ndarray, k: int) -> DataFrame:
    """rid, x, word of each token beyond the head. x: its place, the classes after and before it (rule classes beyond the head) and train as one number."""
    groups = k + RULES + 1
    shared = coded.sparkSession.sparkContext.broadcast(of)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, sizes, at, codes = _codes(batch.column("ids"), shared.value, k, groups - 1)
            mine = np.flatnonzero(flat < 0)
            text = np.repeat(np.arange(len(sizes)), sizes)[mine]
            place = mine - (np.cumsum(sizes) - sizes)[text]
            train = batch.column("train").to_numpy(zero_copy_only=False)[text]
            x = ((place * groups + codes[at[mine] + 1]) * groups + codes[at[mine] - 1]) * 2 + train
            yield pa.RecordBatch.from_arrays([pa.array(batch.column("rid").to_numpy()[text]), pa.array(x), batch.column("rest").flatten()], ["rid", "x", "word"])

    return in_batches(coded.select("rid", "train", "ids", "rest"), work, "rid long, x long, word binary")


def tail_classes(found: DataFrame, chooser: Chooser) -> DataFrame:
    """rid, place, class, c of the tokens of tails(): their words' classes and counts. Rows with a null rid count the distinct
    words of a class that occur in training texts (c)."""
    k, groups = chooser.k, chooser.groups

    def judge(t: pa.Table) -> pa.RecordBatch:
        words = t.column("word").combine_chunks()
        x, rid = (t.column(c).to_numpy() for c in ("x", "rid"))
        named = words.dictionary_encode()
        word, names = named.indices.to_numpy().astype(np.int64), named.dictionary.to_pylist()  # numbered as they come, so sorted
        train, before, after, place = (x & 1) > 0, x // 2 % groups, x // (2 * groups) % groups, x // (2 * groups * groups)
        c = np.bincount(word, weights=train, minlength=len(names)).astype(np.int64)
        best = np.array([k + rule(w) for w in names], dtype=np.int64)
        if k:
            w = word[train]
            key, n = np.unique(np.concatenate([w * 2 * groups + after[train], w * 2 * groups + groups + before[train]]), return_counts=True)
            best = np.where(c >= LEAST, chooser.choose(c, key // (2 * groups), key % (2 * groups), n.astype(float)), best)
        known = np.bincount(best[c > 0], minlength=groups)
        at = np.flatnonzero(known)
        columns = [pa.array([*rid.tolist(), *[None] * len(at)], pa.int64()), pa.array(np.concatenate([place, np.zeros(len(at), np.int64)])), pa.array(np.concatenate([best[word], at]).astype(np.int32)), pa.array(np.concatenate([c[word], known[at]]))]
        return pa.RecordBatch.from_arrays(columns, ["rid", "place", "class", "c"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None  # from the start of a word on
        for batch in batches:
            if not batch.num_rows:
                continue
            new = batch.column("word")[-1]
            if new == last:
                held.append(batch)
                continue
            words = batch.column("word").to_pylist()
            cut = batch.num_rows - 1
            while cut and words[cut - 1] == words[-1]:
                cut -= 1
            yield judge(pa.Table.from_batches([*held, batch.slice(0, cut)]))
            held, last = [batch.slice(cut)], new
        if held:
            yield judge(pa.Table.from_batches(held))

    met = found.repartition("word").sortWithinPartitions("word")
    return in_batches(met, work, "rid long, place long, class int, c long")


def classed(coded: DataFrame, named: DataFrame, of: np.ndarray, counts: np.ndarray, end: int) -> DataFrame:
    """doc_id, train, n (words), known (words that training texts hold), logs (sum of log10(c + ADD) of the words), classes (of each word, 16 bits).

    named: rid, place, class, c of the words beyond the head.
    """
    shared = coded.sparkSession.sparkContext.broadcast((of, counts))
    blank = lambda kind: F.lit(None).cast(kind)
    texts = coded.select("rid", blank("long").alias("place"), "doc_id", "train", "ids", blank("int").alias("class"), blank("long").alias("c"))
    words = named.select("rid", "place", blank("long").alias("doc_id"), blank("boolean").alias("train"), blank("binary").alias("ids"), "class", "c")
    met = texts.unionByName(words).repartition("rid").sortWithinPartitions("rid", F.col("place").asc_nulls_first())
    names = ["doc_id", "train", "n", "known", "logs", "classes"]

    def judge(t: pa.Table) -> pa.RecordBatch:
        of, counts = shared.value
        first = t.column("place").is_null().to_numpy()
        rows = t.filter(pa.array(first))
        flat, sizes, at, codes = _codes(rows.column("ids").combine_chunks(), of, 0, end)
        text = np.repeat(np.arange(len(sizes)), sizes)
        c = counts[np.maximum(flat, 0)] if len(counts) else np.zeros(len(flat), np.int64)
        words = t.filter(pa.array(~first))
        owner = (np.cumsum(first) - 1)[~first]
        place = (np.cumsum(sizes) - sizes)[owner] + words.column("place").to_numpy()
        codes[at[place]] = words.column("class").to_numpy()
        c = c.astype(np.int64)
        c[place] = words.column("c").to_numpy()
        logs = np.bincount(text, weights=np.log10(c + ADD), minlength=len(sizes)).astype(float)  # whole numbers where there are no words
        known = np.bincount(text, weights=c > 0, minlength=len(sizes)).astype(np.int64)
        short = codes[at].astype(np.uint16)
        edges = np.cumsum(sizes)
        return pa.RecordBatch.from_arrays([
            rows.column("doc_id").combine_chunks(), rows.column("train").combine_chunks(), pa.array(sizes), pa.array(known), pa.array(logs),
            pa.array([short[a:z].tobytes() for a, z in zip((edges - sizes).tolist(), edges.tolist())], pa.binary()),
        ], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # from the start of a text on
        for batch in batches:
            starts = np.flatnonzero(batch.column("place").is_null().to_numpy(zero_copy_only=False))
            if not len(starts):
                held.append(batch)
                continue
            cut = int(starts[-1])
            if held or cut:
                yield judge(pa.Table.from_batches([*held, batch.slice(0, cut)]))
            held = [batch.slice(cut)]
        if held and sum(b.num_rows for b in held):
            yield judge(pa.Table.from_batches(held))

    return in_batches(met, work, "doc_id long, train boolean, n long, known long, logs double, classes binary")


class Brown:
    """Transitions and denominators, as log10. moves: adjacent classes of the training texts, ends last; words: distinct words of each class."""

    def __init__(self, moves: np.ndarray, words: np.ndarray, total: int, distinct: int, ends: int):
        groups = len(moves)
        uses = moves.sum(0)
        share = (uses + 1) / (uses.sum() + groups)
        self.move = np.log10((moves + BACK * share) / (moves.sum(1, keepdims=True) + BACK))
        self.den = np.log10(uses + ADD * (words + 1))  # of emissions, by class
        self.base = math.log10(total + ADD * (distinct + 1))
        self.end = math.log10(ends + ADD) - self.base
        self.known = int(ends > 0)

    def scores(self, n: int, logs: float, classes: np.ndarray) -> tuple[float, float]:
        """Base score and score of a text."""
        last = len(self.move) - 1
        codes = np.concatenate([[last], classes, [last]]).astype(np.int64)
        return logs - n * self.base + self.end, logs - float(self.den[classes].sum()) + float(self.move[codes[:-1], codes[1:]].sum())


def brown_scores(docs: DataFrame, training: Column, head: int = HEAD, clustered: int = CLUSTERED, classes: int = CLASSES) -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, n_known, train_tokens, base_score, score. training: a condition on doc_id."""
    spark = docs.sparkSession
    rows = only(docs, doc_id="long", text="string")
    rows = rows.select("doc_id", text_column().cast("binary").alias("text"), F.coalesce(training, F.lit(False)).alias("train"))
    vocabulary = materialize(count_words(rows.where("train")), "lm-words")
    total, distinct = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    top = most_frequent(vocabulary.where(F.length("word") > 0), head)
    ends = sum(r["c"] for r in vocabulary.where(F.length("word") == 0).collect())
    counts = np.array([c for _, c in top], dtype=np.int64)
    coded = materialize(encode(rows.withColumn("rid", F.monotonically_increasing_id()), {w: i for i, (w, _) in enumerate(top)}), "lm-coded")
    train = coded.where("train")
    n = min(clustered, len(top))
    rules = np.array([rule(w) for w, _ in top], dtype=np.int64)
    pairs = count_pairs(train, np.concatenate([np.arange(n), n + rules[n:]]), n)
    clusters = exchange(pairs, n, classes)
    k = int(max(clusters, default=-1)) + 1
    groups = k + RULES + 1
    one = np.zeros((len(pairs), groups))
    one[np.arange(len(pairs)), [*clusters, *range(k, groups)]] = 1
    chooser = Chooser(one.T @ pairs @ one, k)
    of = head_classes(train, np.concatenate([clusters, k + rules[n:]]).astype(np.int64), n, chooser, counts)
    named = materialize(tail_classes(tails(coded, of, k), chooser), "lm-tails")
    words = np.bincount(of, minlength=groups).astype(float)
    for r in named.where("rid is null").groupBy("class").agg(F.sum("c").alias("n")).collect():
        words[r["class"]] += r["n"]
    held = materialize(classed(coded, named.where("rid is not null"), of, counts, groups - 1), "lm-classes")
    discard(vocabulary, coded, named)

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(groups * groups, dtype=np.int64)
        for batch in batches:
            for x in batch.column("classes"):
                codes = np.full(len(x.as_buffer()) // 2 + 2, groups - 1, dtype=np.int64)
                codes[1:-1] = np.frombuffer(x.as_buffer(), dtype=np.uint16)
                np.add.at(sums, codes[:-1] * groups + codes[1:], 1)
        yield _sparse(sums)

    moves = _square(in_batches(held.where("train").select("classes"), moved, "pair long, n long"), groups)
    shared = spark.sparkContext.broadcast(Brown(moves, words, total, distinct, ends))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            columns = (batch.column("n").to_pylist(), batch.column("logs").to_pylist(), batch.column("classes"))
            found = [m.scores(n, logs, np.frombuffer(x.as_buffer(), dtype=np.uint16)) for n, logs, x in zip(*columns)]
            base, score = (pa.array(x, pa.float64()) for x in zip(*found)) if found else (pa.array([], pa.float64()),) * 2
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(batch.column("n").to_numpy() + 1), pa.array(batch.column("known").to_numpy() + m.known), pa.array([total] * batch.num_rows, pa.int64()), base, score], ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return in_batches(held.select("doc_id", "n", "known", "logs", "classes"), work, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
