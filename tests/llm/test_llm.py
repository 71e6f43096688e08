"""The corpus operators against brute force on small tables with nulls, empty and long texts, ties and repeated rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = r"[^\x20\x09-\x0D]+"
DOCS = "doc_id long, text string, source string, h string, size string, t int, word string, k string"


def make_rows(n=120, seed=5):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghéß", k=rng.randint(1, 9))) for _ in range(300)]
    rows, texts = [], []
    for i in range(n):
        kind = rng.random()
        if texts and kind < 0.15:
            text = rng.choice(texts)  # exact copy
        elif texts and kind < 0.4:
            words = (rng.choice(texts) or "").split()  # near copy
            for _ in range(rng.randint(1, 3)):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocabulary)
            text = " ".join(words)
        else:
            text = " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 4, 5, 20, 60, 120])))
        if rng.random() < 0.15:
            text += "\nReleased under the MIT License.\tApache License CC BY 4.0 gnu general public license gnu"
        texts.append(text)
        rows.append((i, text, rng.choice(["a", "b", "c", "é", None])))
    rows += [(n, None, "a"), (n + 1, "", None), (n + 2, "", "b"), (n + 3, " \n\t", "c"), (n + 4, "x" * 3000, "a"), (n + 5, "word " * 4000, "b")]
    rows.append(rows[3])  # a repeated row
    return [(*r, "clash", "clash", 7, "clash", "clash") for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(make_rows(), DOCS)


@pytest.fixture(scope="module")
def rows():
    return [(r[0], r[1] or "", r[2]) for r in make_rows()]


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# --- 1 -----------------------------------------------------------------------------------------------------------------


def toxic_rows():
    rng = random.Random(1)
    clean = ["".join(rng.choices("abcdeilnorst", k=rng.randint(2, 8))) for _ in range(400)]
    rows = []
    for i in range(600):
        words = rng.choices(clean, k=rng.randint(20, 200))
        bad = i % 5 == 0
        if bad:
            for _ in range(max(1, len(words) // 25)):
                words.insert(rng.randrange(len(words)), "vilify" + rng.choice(["", "er", "ing", "s"]))
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_toxicity_on_held_out_rows(spark):
    from plyframe.llm.toxicity import fold, toxicity

    rows = toxic_rows()
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(900, None, "x"), (901, "", "x"), (902, "a vilifyx b c d e f g", "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(3, None), (None, 1), (4, 7)], "doc_id long, toxic int")
    got = by_id(toxicity(docs, labels, fold() != 1))
    held = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    hits = sum(got[i]["predicted"] and y for i, y in held)
    assert hits >= 0.9 * sum(y for _, y in held) and sum(got[i]["predicted"] for i, _ in held) <= 1.1 * hits
    assert got[900]["score"] == got[901]["score"] == min(r["score"] for r in got.values()) and got[900]["predicted"] == 0
    assert got[902]["predicted"] == 1  # an unseen spelling
    assert all(0 <= r["score"] <= 1 and (r["score"] >= 0.7) == (r["predicted"] == 1) for r in got.values())


def test_toxicity_score_by_hand(spark):
    """The score of every text from the model's arrays: softmax of the average of the gated words."""
    import numpy as np

    from plyframe.llm import toxicity as T

    rows = toxic_rows()
    model = T.train([t for _, t, _ in rows[:300]], [y for _, _, y in rows[:300]])
    texts = [t for _, t, _ in rows[300:]] + ["", "Vilifying!", "x" * 60_000, "vilify " * 30_000, None]
    got = T.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()

    def grams(w):
        marked = f"<{w}>"
        return [f"={w}", *(marked[i : i + n] for n in T.GRAMS for i in range(len(marked) - n + 1))]

    for r in got:
        words = re.findall(r"[^\W_]+", (texts[r["doc_id"]] or "").lower())
        gated = {w: max(0.0, float(np.mean([model.weight[zlib.crc32(g.encode()) % T.BUCKETS] for g in grams(w)], dtype=np.float32)) - model.level) for w in set(words)}
        logits = np.array([0.0, model.bias + model.scale * sum(gated[w] for w in words) / (len(words) + T.EXTRA)])
        assert r["score"] == pytest.approx(np.exp(logits[1] - np.logaddexp(*logits)), rel=1e-4, abs=1e-9)


def test_toxicity_sample_of_odd_rows(spark):
    """Contradicting labels: the larger counts; repeated rows once; long texts, null ids and labels that aren't 0 or 1 stay out."""
    from pyspark.sql import functions as F

    from plyframe.llm.toxicity import sample

    docs = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c" * 50), (None, "d"), (5, None), (6, "f"), (7, "x"), (7, "y")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (2, 0), (3, 1), (None, 1), (5, 1), (6, None), (6, 3), (7, 0), (8, 1)], "doc_id long, toxic int")
    got = sorted(zip(*sample(docs, labels, F.lit(True), chars=40)))
    assert got in ([("", 1), ("a", 1), ("b", 0), ("x", 0)], [("", 1), ("a", 1), ("b", 0), ("y", 0)])


def test_toxicity_without_labels(spark, docs, none):
    from plyframe.llm.toxicity import fold, toxicity

    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert {(r["score"], r["predicted"]) for r in toxicity(docs, labels, fold() != 1).collect()} == {(0.0, 0)}
    assert toxicity(none, labels, fold() != 1).count() == 0


# --- 2 -----------------------------------------------------------------------------------------------------------------


def test_exact_dedup(docs, rows, none):
    from plyframe.llm.exact import dedup_once

    got = dedup_once(docs).collect()
    groups = collections.defaultdict(list)
    for i, t, _ in rows:
        groups[t].append(i)
    expected = sorted((i, max(groups[t]), len(groups[t]), i == max(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t, _ in rows)
    assert sorted(tuple(r)[:5] for r in got) == expected
    assert dedup_once(none).count() == 0


def test_index_across_batches(spark):
    from plyframe.llm.exact import DigestIndex, exact_dedup

    batch = lambda *r: spark.createDataFrame(list(r), "doc_id long, text string")
    index = DigestIndex(spark, "index_across_batches", buckets=3)
    first = by_id(exact_dedup(batch((1, "a"), (2, "b"), (5, "a")), index, 0))
    assert (first[1]["kept"], first[5]["kept"], first[1]["keep_id"]) == (False, True, 5)
    second = by_id(exact_dedup(batch((9, "a"), (10, "c"), (11, "c")), index, 1))
    assert (second[9]["kept"], second[9]["known"], second[9]["keep_id"]) == (False, True, 5)
    assert (second[10]["kept"], second[11]["kept"]) == (False, True)
    index.compact()
    assert index.read().count() == 3
    plan = index.unseen(index.read().select("digest")).join(index.read().select("digest"), "digest")
    assert plan.count() == 0
    index.drop()


def test_batch_run_twice_and_index_reopened(spark):
    from plyframe.llm.exact import DigestIndex, exact_dedup

    batch = lambda *r: spark.createDataFrame(list(r), "doc_id long, text string")
    table, key = "digest_again", lambda df: sorted(tuple(r) for r in df.collect())
    one, two = batch((1, "a"), (2, "b"), (5, "a"), (None, "c")), batch((7, "a"), (8, "d"))
    index = DigestIndex(spark, table, 3)
    first = key(exact_dedup(one, index, 0).select("doc_id", "kept", "known").na.fill(-1, ["doc_id"]))
    assert first == [(-1, True, False), (1, False, False), (2, True, False), (5, True, False)]
    assert key(exact_dedup(one, index, 0).select("doc_id", "kept", "known").na.fill(-1, ["doc_id"])) == first  # a retry
    other = DigestIndex(spark, table, 8)  # another session's shuffle.partitions
    second = key(exact_dedup(two, other, 1).select("doc_id", "kept", "known"))
    assert second == [(7, False, True), (8, True, False)] and other.buckets == 3
    assert key(exact_dedup(one, other, 0).select("doc_id", "kept", "known").na.fill(-1, ["doc_id"])) == first  # after a later batch
    held = key(other.read().select("digest", "keep_id", "batch").na.fill(-1))
    assert len(held) == len({h[0] for h in held}) == 4
    other.compact()
    assert key(other.read().select("digest", "keep_id", "batch").na.fill(-1)) == held
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}_old")  # a compaction that was broken off
    assert key(exact_dedup(two, DigestIndex(spark, table), 1).select("doc_id", "kept", "known")) == second
    other.drop()


def test_stages_on_rows_that_share_ids(spark):
    from plyframe.llm import exact, mixing, neardup

    long = " ".join(f"w{i}" for i in range(40))
    rows = [(1, long, "a", 77, "x"), (1, long, "a", 77, "x"), (1, "other text of the same id", "a", 78, "x"), (2, long + " end", "a", 79, "y"), (None, long, "b", 80, "z"), (None, "", None, 81, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _turn int, _row string")
    got = exact.stage(spark, docs, "")
    assert got.columns == docs.columns and sorted(r["_turn"] for r in got.collect()) == [77, 78, 79, 81]
    got = neardup.stage(spark, docs, "")
    assert got.columns == docs.columns and sorted(r["_turn"] for r in got.collect()) == [77, 78, 80, 81]
    got = mixing.stage(spark, docs, "")
    assert got.columns == docs.columns and {r["_turn"] for r in got.collect()} >= {77, 79, 80}


def test_hot_group_is_attached_whole(spark):
    from plyframe.llm.exact import dedup_once

    docs = spark.range(6000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'same' ELSE cast(id as string) END AS text")
    got = dedup_once(docs)
    assert got.where("group_size = 2000 and keep_id = 5997").count() == 2000 and got.where("kept").count() == 4001


# --- 3 -----------------------------------------------------------------------------------------------------------------


def targets_of(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        rest, share = total - sum(3 * sizes[s] for s in stopped), sum(weight[s] for s in names if s not in stopped)
        target = {s: 3 * sizes[s] if s in stopped else rest * weight[s] / share for s in names}
        new = {s for s in names if s not in stopped and target[s] > 3 * sizes[s]}
        if not new:
            return target
        stopped |= new


@pytest.mark.parametrize("block", [7, 1024])
def test_mixing(docs, rows, block):
    from plyframe.llm.mixing import mix_counts

    got = mix_counts(docs, block=block).collect()
    sizes, source = collections.Counter(), collections.Counter()
    for i, t, s in rows:
        source[s] += len(re.findall(SPACE, t))
    target = targets_of(source)
    ids = {i: (len(re.findall(SPACE, t)), s) for i, t, s in rows}
    assert len(got) == len(rows)
    for r in got:
        size, s = ids[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size, source[s]) and abs(r["target"] - target[s]) < 1e-6 and 0 <= r["taken"] <= 3 * size
        sizes[s] += r["taken"]
    assert all(abs(sizes[s] - target[s]) <= 1 for s in target)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mix_counts(docs, block=block).collect()))


def test_mixing_stops_small_sources(spark, none):
    from plyframe.llm.mixing import mix_counts

    docs = spark.createDataFrame([(i, "w " * 10, "b") for i in range(50)] + [(99, "one two", "a"), (100, None, "c")], "doc_id long, text string, source string")
    got = by_id(mix_counts(docs))
    assert (got[99]["target"], got[99]["taken"], got[100]["target"], got[100]["taken"]) == (6.0, 6, 0.0, 0)
    assert abs(got[0]["target"] - 496) < 1e-6 and sum(got[i]["taken"] for i in range(50)) == 496
    assert mix_counts(none).count() == 0


def test_schedule_follows_weights_everywhere(docs):
    from plyframe.llm.mixing import measured, schedule, source_targets

    sources = source_targets(measured(docs))
    slots = schedule(sources, 16).orderBy("slot").collect()
    share = {r["src"]: r["target"] for r in sources.collect()}
    total, seen = sum(share.values()), collections.Counter()
    for n, r in enumerate(slots, 1):
        assert r["rank"] == seen[r["src"]] or r["slot"] >= total / 16
        seen[r["src"]] += 1
        if n % 50 == 0:
            assert all(abs(seen[s] - n * share[s] / total) < 6 for s in share)


# --- 4 -----------------------------------------------------------------------------------------------------------------

PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def test_license_scan(docs, rows, none):
    from plyframe.llm.licenses import license_scan

    got = by_id(license_scan(docs))
    found = 0
    for i, t, _ in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(LOWER))
        starts = [(j, PHRASES[p]) for p in PHRASES for j in range(len(words)) if words[j : j + len(p.split())] == p.split()]
        at = [j for j, _ in starts]
        r, base = got[i], {x for _, x in starts}
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)))
        labels = set(r["labels"].split(",")) if r["labels"] else set()
        assert base <= labels and ",".join(sorted(labels)) == r["labels"] and 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(labels)
        found += len(at)
    assert found > 20 and license_scan(none).count() == 0


def test_license_labels_and_score_by_hand(spark):
    """Bases, mandatory phrases and coverage by comparing every template with every place of a text."""
    from plyframe.llm import licenses as L

    rng, words = random.Random(4), lambda t: [w for w in L.words_of(t.encode())]
    texts = ["", "cc by by nc 4 0 cc", "all rights reserved all rights"]
    for _ in range(150):
        parts = []
        for t in rng.choices(L.TEMPLATES, k=rng.randint(1, 2)):
            w = words(t.text)
            for _ in range(rng.choice([0, 0, 1, 3])):  # words put in, left out or changed
                i = rng.randrange(len(w))
                w[i : i + rng.randint(0, 1)] = rng.choice([[], [b"x"], [b"the", b"software"] * rng.choice([1, 10])])
            parts += [*rng.choices([b"the", b"software", b"of", b"xyz", b"license"], k=rng.randint(0, 30)), *w[: rng.choice([len(w), len(w), 9])]]
        texts.append(b" ".join(parts).decode())
    rows = {i: words(t) for i, t in enumerate(texts)}
    vocabulary = L.template_words()
    idf = {w: math.log((len(rows) + 1) / (1 + sum(w in r for r in rows.values()))) for w in vocabulary}
    at = lambda w, phrase: [i for i in range(len(w) - len(phrase) + 1) if w[i : i + len(phrase)] == phrase]
    got = by_id(L.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    for i, w in rows.items():
        labels = {label for p, label in L.BASE.items() if at(w, words(p))}
        score = 0.5 * bool(labels)
        for t in L.TEMPLATES:
            text, keys = words(t.text), [words(k) for k in t.key]
            rare = sorted(set(text), key=lambda x: (-idf[x], text.index(x)))[: L.RARE]
            bases = [b for b in range(-len(text), len(w)) if sum(any(x == r and 0 <= b + p < len(w) and w[b + p] == r for p, x in enumerate(text)) for r in rare) >= min(2, len(rare))]
            if any(all(any(abs(s - b - p) <= L.SLACK for p in at(text, k) for s in at(w, k)) for k in keys) for b in bases):
                labels.add(t.label)
                share = [any(0 <= b + p < len(w) and w[b + p] == x for b in bases) for p, x in enumerate(text)]
                score = max(score, sum((idf[x] + 0.01) * s for x, s in zip(text, share)) / sum(idf[x] + 0.01 for x in text))
        assert got[i]["labels"] == ",".join(sorted(labels)) and got[i]["score"] == pytest.approx(score), texts[i]
    assert len({r["labels"] for r in got.values()}) > 10 and any(0.6 < r["score"] < 0.95 for r in got.values())


def test_license_templates(spark):
    from plyframe.llm.licenses import TEMPLATES, license_scan

    docs = spark.createDataFrame([(i, f"Code. {t.text.upper()}, see file.") for i, t in enumerate(TEMPLATES)] + [(99, "a licence of no kind, by all")], "doc_id long, text string")
    got = by_id(license_scan(docs))
    assert all(t.label in got[i]["labels"].split(",") and got[i]["score"] > 0.99 for i, t in enumerate(TEMPLATES))
    assert got[99]["labels"] == "" and got[99]["score"] == 0


# --- 5 -----------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("head", [10, 100_000])
def test_brown_base_columns(docs, rows, none, head):
    from plyframe.llm.brown import brown_scores
    from plyframe.llm.toxicity import fold

    got = by_id(brown_scores(docs, fold(of=10) != 0, head=head, clustered=min(head, 60), classes=8))
    tokens = {i: re.findall(SPACE, t.translate(LOWER)) + ["\0"] for i, t, _ in rows}
    counts = collections.Counter()
    for i, _, _ in rows:
        if zlib.crc32(str(i).encode()) % 10:
            counts.update(tokens[i])
    n, v = sum(counts.values()), len(counts)
    for i, words in tokens.items():
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0
    assert len(got) == len(tokens) and brown_scores(docs, fold(of=10) != 0, head=head).count() == len(rows)
    assert brown_scores(none, fold(of=10) != 0).count() == 0


def test_most_frequent_words_of_a_large_band(spark):
    from plyframe.llm.brown import most_frequent

    words = spark.createDataFrame([(f"w{i}".encode(), 7) for i in range(3000)] + [(b"often", 100), (b"seldom", 1)], "word binary, c long")
    got = most_frequent(words, 1000)
    assert got[0] == (b"often", 100) and 950 <= len(got) <= 1000 and {c for _, c in got[1:]} == {7}
    assert len(most_frequent(words, 5000)) == 3002 and most_frequent(words.limit(0), 10) == []


def test_brown_probabilities_sum_to_one():
    import numpy as np

    from plyframe.llm import brown

    rng = np.random.default_rng(1)
    moves, words = rng.integers(0, 50, (7, 7)).astype(float), np.array([4, 3, 9, 1, 2, 5, 0.0])
    m = brown.Brown(moves, words, 900, 25, 40)
    assert np.allclose((10**m.move).sum(1), 1)
    for c in range(6):  # known words share the uses of their class, and one unknown word is left
        assert (moves.sum(0)[c] + brown.ADD * words[c]) * 10 ** -m.den[c] + brown.ADD * 10 ** -m.den[c] == pytest.approx(1)
    assert (900 + 25 * brown.ADD + brown.ADD) * 10**-m.base == pytest.approx(1)


@pytest.mark.parametrize("head", [10, 100_000])
def test_brown_scores_by_hand(docs, rows, head, monkeypatch):
    """The score of each text from the classes that each word got, however it got them."""
    import numpy as np
    from pyspark.sql import functions as F

    from plyframe.llm import brown
    from plyframe.llm.toxicity import fold

    seen = {}
    classed = brown.classed
    monkeypatch.setattr(brown, "classed", lambda *a: seen.setdefault("texts", classed(*a)))
    monkeypatch.setattr(brown, "discard", lambda *a: None)
    square = brown._square
    monkeypatch.setattr(brown, "_square", lambda pairs, width: seen.update(groups=width) or square(pairs, width))  # the last one is by class
    got = brown.brown_scores(docs, fold(of=10) != 0, head=head, clustered=min(head, 40), classes=6).collect()
    split = {i: [w.encode() for w in re.findall(SPACE, t.translate(LOWER))] for i, t, _ in rows}
    trained = lambda i: zlib.crc32(str(i).encode()) % 10 != 0
    counts = collections.Counter(w for i, _, _ in rows if trained(i) for w in split[i])
    of, moves, groups = {}, collections.Counter(), seen["groups"]
    end = groups - 1
    for r in seen["texts"].collect():
        codes = np.frombuffer(bytes(r["classes"]), dtype=np.uint16).tolist()
        assert len(codes) == len(split[r["doc_id"]]) == r["n"] and r["known"] == sum(counts[w] > 0 for w in split[r["doc_id"]])
        for w, c in zip(split[r["doc_id"]], codes):
            assert of.setdefault(w, c) == c  # one class a word
    for i, _, _ in rows:
        if trained(i):
            codes = [end, *(of[w] for w in split[i]), end]
            moves.update(zip(codes, codes[1:]))
    uses, outs, words = collections.Counter(), collections.Counter(), collections.Counter(of[w] for w in of if counts[w])
    for (a, b), n in moves.items():
        uses[b] += n
        outs[a] += n
    total = sum(uses.values())

    def move(a, b):
        return math.log10((moves[a, b] + brown.BACK * (uses[b] + 1) / (total + groups)) / (outs[a] + brown.BACK))

    for r in got:
        codes = [end, *(of[w] for w in split[r["doc_id"]]), end]
        score = sum(math.log10((counts[w] + brown.ADD) / (uses[of[w]] + brown.ADD * (words[of[w]] + 1))) for w in split[r["doc_id"]])
        assert r["score"] == pytest.approx(score + sum(move(a, b) for a, b in zip(codes, codes[1:])))


def test_exchange_raises_mutual_information():
    import numpy as np

    from plyframe.llm.brown import exchange

    rng = np.random.default_rng(0)
    pairs = np.zeros((22, 22))
    for _ in range(5000):  # two kinds of words that alternate
        a = rng.integers(0, 10)
        pairs[a, 10 + rng.integers(0, 10)] += 1
        pairs[10 + rng.integers(0, 10), rng.integers(0, 10)] += 1
    of = exchange(pairs, 20, 2)
    assert len(set(of[:10])) == len(set(of[10:])) == 1 and of[0] != of[10]


def test_brown_classes_of_words_beyond_the_clustered(spark):
    """Two kinds of words alternate; all share their last two bytes, and only four are clustered by exchange."""
    from pyspark.sql import functions as F

    from plyframe.llm.brown import brown_scores

    rng = random.Random(8)
    kinds = [[f"{k}{i}xx" for i in range(40)] for k in "ab"]
    weight = [60, 50] + [1] * 38
    texts = [" ".join(rng.choices(kinds[j % 2], weight)[0] for j in range(60)) for _ in range(200)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000, "a20xx b21xx a22xx b23xx"), (1001, "a20xx a22xx b21xx b23xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for head in (10, 100_000):  # beyond the head too
        got = by_id(brown_scores(docs, F.col("doc_id") < 1000, head=head, clustered=4, classes=2))
        assert got[1000]["base_score"] == pytest.approx(got[1001]["base_score"])
        assert got[1000]["score"] > got[1001]["score"] + 1


# --- 6 -----------------------------------------------------------------------------------------------------------------


def removal(texts, length):
    count = collections.Counter(b[j : j + length] for b in texts.elements() for j in range(len(b) - length + 1))
    out = {}
    for b in texts:
        covered = bytearray(len(b))
        for j in range(len(b) - length + 1):
            if count[b[j : j + length]] > 1:
                covered[j : j + length] = b"\1" * length
        kept = bytes(x for x, c in zip(b, covered) if not c)
        out[b] = (len(b), sum(covered), len(re.findall(b"\1+", bytes(covered))), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("most", [2, 3000])
def test_repeat_removal(docs, rows, none, most):
    from plyframe.llm.suffix import repeat_removal

    expected = removal(collections.Counter(t.encode() for _, t, _ in rows), 200)
    got = repeat_removal(docs, most=most).collect()
    texts = {i: t.encode() for i, t, _ in rows}
    assert len(got) == len(rows) and all(tuple(r)[1:] == expected[texts[r["doc_id"]]] for r in got)
    assert sum(0 < r["n_removed"] < r["n_bytes"] for r in got) > 3 and repeat_removal(none).count() == 0


def test_long_texts_in_pieces(spark, monkeypatch):
    from plyframe.llm import suffix

    rng = random.Random(2)
    text = "".join(rng.choices("abcdefgh ", k=9000))
    rows = [(0, text), (1, "é" * 300 + text[2000:7000]), (2, "z" * 150 + text[5000:5199]), (3, text[100:300])]
    monkeypatch.setattr(suffix, "PACK", 1000)
    expected = removal(collections.Counter(t.encode() for _, t in rows), 200)
    held = spark.createDataFrame([(i, 0, t.encode()) for i, t in rows], "k long, h long, t binary")
    spans = [tuple(r) for b in [held.toArrow().to_batches()] for r in suffix.find_spans(held).collect()]
    places = [(r[0], r[2] >> 20, (r[2] >> 20) + (r[2] >> 10 & 1023), (r[2] >> 20) + (r[2] & 1023)) for r in spans]
    assert all(0 <= first <= last <= len(rows[k][1].encode()) - 200 and first <= anchor <= first + 168 + last for k, first, anchor, last in places)
    assert {r[0]: sum(last - first + 1 for k, first, _, last in places if k == r[0]) for r in held.collect()} == {i: max(0, len(t.encode()) - 199) for i, t in rows}
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix.repeat_removal(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: expected[t.encode()] for i, t in rows}


def test_merge_of_shards():
    from plyframe.llm.suffix import repeated

    rng = random.Random(3)
    for _ in range(150):
        length, letters = rng.choice([1, 2, 3, 5, 7, 8, 15]), rng.choice([b"ab", b"a", bytes(range(256))])
        spans = [bytes(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(rng.randint(1, 9))]
        count = collections.Counter(s[i : i + length] for s in spans for i in range(len(s) - length + 1))
        for shards in (1, 2, 3):
            assert [list(map(bool, f)) for f in repeated(spans, length, shards)] == [[count[s[i : i + length]] > 1 for i in range(len(s) - length + 1)] for s in spans]


# --- 7 -----------------------------------------------------------------------------------------------------------------


def shingles(text):
    words = re.findall(SPACE, text.translate(LOWER))
    return {tuple(words[j : j + 5]) for j in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} if words else set()


def linked(rows, percent):
    sets = {i: shingles(t) for i, t, _ in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


@pytest.mark.parametrize("percent", [85, 80])
def test_near_groups(docs, rows, none, percent):
    from plyframe.llm.neardup import near_groups

    expected = linked(rows, percent)
    got = near_groups(docs, percent).collect()
    assert len(got) == len(rows) and all(tuple(r)[1:] == expected[r["doc_id"]] for r in got)
    assert sum(not r["kept"] for r in got) > 10 and near_groups(none, percent).count() == 0


def test_large_group_in_blocks(spark, monkeypatch):
    from plyframe.llm import neardup

    monkeypatch.setattr(neardup, "BLOCK", 7)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(90):  # each differs from the base in one to three words: some pairs are linked, some only by a chain
        words = base[:]
        for _ in range(rng.randint(1, 3)):
            words[rng.randrange(100)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words), "s"))
    for i in range(90, 130):  # a passage that many share
        rows.append((i, " ".join([f"y{rng.randrange(10**6)}" for _ in range(60)] + base[:50]), "s"))
    for rounds in (0, 3):
        monkeypatch.setattr(neardup, "ROUNDS", rounds)
        got = {r["doc_id"]: tuple(r)[1:] for r in neardup.near_groups(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), 85).collect()}
        assert got == linked(rows, 85)


def test_null_ids_take_no_part(spark):
    from plyframe.llm.neardup import near_groups

    got = near_groups(spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f")], "doc_id long, text string"), 80).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in got) == [(0, None, None), (1, 1, True)]


# --- 8 -----------------------------------------------------------------------------------------------------------------


def test_top_k(spark):
    from pyspark.sql import functions as F

    from plyframe.llm.topk import top_k

    rng = random.Random(6)
    rows = [(i, [rng.choice([0.0, 0.25, rng.gauss(0, 1)]) for _ in range(6)]) for i in range(300)]
    rows += [(300, None), (301, []), (302, [1.0, None]), (303, [float("nan")] * 6), (400, [float("inf")] * 6), (305, [0.5] * 3), (306, rows[5][1]), (500, rows[7][1]), (700, [1e12] * 6), (None, [1.0] * 6)]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    expected = set()
    for q in (i for i in whole if i % 100 == 0):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:10]
        expected |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)}
    for block in (40, 2048):
        assert {tuple(r) for r in top_k(table, F.col("vec_id") % 100 == 0, 10, block).collect()} == expected
    assert top_k(table.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    few = {tuple(r)[:3] for r in top_k(table.where("vec_id in (100, 1, 2)"), F.col("vec_id") % 100 == 0).collect()}
    assert len(few) == 2 and {x[0] for x in few} == {100}


# --- 9 -----------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    P = pytest.importorskip("public_tokenizers")
    import tiktoken

    from plyframe.llm.bpe import load_ranks

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})


def test_bpe_equals_the_library(docs, rows, none, library):
    import public_tokenizers as P

    from plyframe.llm.bpe import decode, encode

    held = encode(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    got = by_id(held)
    for i, t, _ in rows:
        ids = library.encode_ordinary(t)
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        assert (got[i]["ids"], got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (ids, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    back = by_id(decode(held, P.path("byte_bpe_50k.tiktoken"), P.PATTERN))
    assert all(bytes(back[i]["text"]).decode() == t for i, t, _ in rows)
    assert encode(none, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def test_bpe_on_odd_characters(library):
    import public_tokenizers as P

    from plyframe.llm.bpe import codec

    c, rng = codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN), random.Random(7)
    odd = ["a", "b", " ", "  ", "\n", "\t", "'s", "é", "ß", "1", "!", "\x1c", "\x1f", "\x85", "　", "中", "😀", " a", "\r\n", "​", "Ⅷ", "²", "'re", "\x00", "\xa0", "_", "a" * 50]
    for _ in range(4000):
        text = "".join(rng.choices(odd, k=rng.randint(0, 12)))
        ids = c.encode(text)
        assert (memoryview(ids).cast("I").tolist() if ids else []) == library.encode_ordinary(text)
        assert c.decode(ids) == text.encode()


# --- 10 ----------------------------------------------------------------------------------------------------------------


def test_sharding(docs, rows, none):
    from plyframe.llm.sharding import shard

    got = shard(docs, 4).collect()
    texts = {i: t for i, t, _ in rows}
    held, place = collections.defaultdict(list), {}
    for r in got:
        t = texts[r["doc_id"]]
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(t.encode()) + 1, zlib.crc32(t.encode()), "bytes", None)
        assert place.setdefault(t, r["shard"]) == r["shard"]  # equal texts stay together
        held[r["shard"]].append((r["slot"], r["size"]))
    assert sorted(held) == [0, 1, 2, 3] and all(sorted(s for s, _ in x) == list(range(len(x))) for x in held.values())
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, shard(docs, 4).collect()), key=str)
    assert shard(none).count() == 0


def test_shards_are_near_equal_beside_a_large_group(spark):
    from plyframe.llm.sharding import shard

    docs = spark.range(4000).selectExpr("id AS doc_id", "CASE WHEN id % 25 = 0 THEN repeat('z', 200) ELSE concat(id, repeat(cast(id % 7 as string), cast(id % 900 as int))) END AS text")
    sizes = [r["n"] for r in shard(docs).groupBy("shard").agg({"size": "sum"}).withColumnRenamed("sum(size)", "n").collect()]
    assert len(sizes) == 16 and max(sizes) < 1.03 * min(sizes)


def test_sharding_is_native(docs):
    from plyframe.llm.sharding import shard

    plan = shard(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_null_and_shared_ids(spark):
    """Rows are documents: null ids and ids with several texts, in the operators that keep them."""
    from plyframe.llm.brown import brown_scores
    from plyframe.llm.neardup import near_groups
    from plyframe.llm.sharding import shard
    from plyframe.llm.suffix import repeat_removal
    from plyframe.llm.toxicity import fold

    rng = random.Random(9)
    words = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    shared, heavy = words(60), words(3000)
    table = [(None, shared), (None, None), (1, shared + " " + words(2)), (1, words(80)), (2, heavy), (3, words(90)), (3, words(90)), (4, None)]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    texts = collections.Counter((t or "").encode() for _, t in table)
    expected = removal(texts, 200)
    assert sorted(map(str, (tuple(r)[1:] for r in repeat_removal(docs).collect()))) == sorted(str(expected[t]) for t in texts.elements())
    got = near_groups(docs, 80).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in got if r["doc_id"] is not None) == [(1, 1, True), (1, 1, True), (2, 2, True), (3, 3, True), (3, 3, True), (4, 4, True)]
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None, None]
    got = brown_scores(docs, fold(of=10) != 0).collect()
    assert len(got) == len(table) and sorted(r["n_tokens"] for r in got) == sorted(len((t or "").split()) + 1 for _, t in table)
    assert {r["train_tokens"] for r in got} == {sum(len((t or "").split()) + 1 for i, t in table if i is not None and zlib.crc32(str(i).encode()) % 10)}
    got = shard(docs, 4).collect()
    held = collections.defaultdict(list)
    for r in got:
        held[r["shard"]].append(r)
    assert sorted(r["size"] for r in got) == sorted(len((t or "").encode()) + 1 for _, t in table)
    assert all(sorted(r["slot"] for r in x) == list(range(len(x))) for x in held.values())
    assert len({r["shard"] for r in got if r["size"] == 1}) == 1  # equal texts stay together
    assert [len(x) for x in held.values() if any(r["doc_id"] == 2 for r in x)] == [1]  # nothing joins a text that is heavier than a shard


# --- pipeline ----------------------------------------------------------------------------------------------------------


def test_pipeline(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline

    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t, _ in toxic_rows()]
    rows += [(1000 + i, rows[i][1], "en", "s1", 0) for i in range(1, 20) if i % 5] + [(2000, rows[1][1].replace(" ", "  ") + " tail", "en", "s2", 0), (2001, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, y) for i, _, y in toxic_rows()], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    seen, docs = {}, spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns = docs.columns
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        out = step(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / f"out{k}"))
        docs = spark.read.parquet(str(tmp_path / f"out{k}"))
        seen[name] = docs
        if k < 4:
            assert docs.columns == columns
    ids = {name: {r["doc_id"] for r in df.select("doc_id").collect()} for name, df in seen.items()}
    toxic = {i for i, _, y in toxic_rows() if y}
    assert len(toxic & ids["toxicity"]) < 0.1 * len(toxic) and len(ids["toxicity"]) > 0.95 * (len(rows) - len(toxic))
    assert not ids["exact_dedup"] & {i for i in range(1, 20) if i % 5} and 1001 in ids["exact_dedup"]
    assert len({1001, 2000} & ids["near_dedup"]) == 1
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == seen["byte_bpe"].count()


def test_pipeline_on_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    columns = "doc_id long, text string, lang string, source string, n_chars long, _row int, _turn string, h long, component_id string"
    spark.createDataFrame([], columns).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
