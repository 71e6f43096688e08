"""Importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text):
    w = WORDS.findall((text or "").translate(LOWER))
    return len(w), [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def bucket(gram):
    return zlib.crc32(gram.encode()) % 10_000


def expected(rows, target, percent=5, least=20):
    s, t = np.zeros(10_000, dtype=int), np.zeros(10_000, dtype=int)
    for held, texts in ((s, [r[1] for r in rows]), (t, target)):
        for text in texts:
            for g in grams(text)[1]:
                held[bucket(g)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + 10_000) / ((a + 1) * (t.sum() + 10_000)))) for a, b in zip(s.tolist(), t.tolist())]
    out = []
    for doc_id, text in rows:
        n, found = grams(text)
        weight = sum(gain[bucket(g)] for g in found)
        h = int(hashlib.sha256(f"42:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    part = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for k, r in enumerate(part[: percent * len(part) // 100]):
        r[4] = k + 1
    return sorted(map(tuple, out), key=str)


def make(n=400, seed=7):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdÉéß0Z9", k=rng.randint(1, 8))) for _ in range(150)] + ["w" * 70, "ü" * 200]
    rows = [(i, rng.choice([" ", "\t", ", ", "\x00", "[~"]).join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 3, 19, 20, 21, 80])))) for i in range(n)]
    rows += [(None, "one two three " * 9), (None, None), (n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "long " * 30_000), (n + 4, "x" * 100_000), rows[5], rows[5], (rows[7][0], rows[8][1])]
    return rows, [r[1] for r in rows[10:40]] + [None, "", "Target WORDS of its own"]


def run(spark, rows, target):
    from plyframe.llm.resampling import resample

    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, score string, rank int, weight int")
    found = resample(docs.repartition(5), spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string"))
    assert [c for c, _ in found.dtypes][:5] == ["doc_id", "n_features", "weight", "score", "rank"] and {k for _, k in found.dtypes} == {"bigint"}
    return sorted(map(tuple, found.collect()), key=str)


def test_resampling_against_brute_force(spark):
    rows, target = make()
    assert run(spark, rows, target) == expected(rows, target)


def test_resampling_of_nothing(spark):
    rows, _ = make(60)
    assert run(spark, rows, []) == expected(rows, [])
    assert run(spark, [], ["a b c"]) == []


def test_trie_holds_counts_and_states():
    from plyframe.llm.resampling import Trie, carried

    trie = Trie(pa.array(["A b a b", None, "", "a-b", "ends", "é " + "q" * 500 + " b"]))
    assert trie.words[:2] == [b"a", b"b"] and trie.counts[0][:2].tolist() == [3, 4]
    assert trie.n_words().tolist() == [4, 0, 0, 2, 1, 3]
    states = {zlib.crc32(g.encode()): n for g, n in (("a b", 3), ("b a", 1), ("é " + "q" * 500, 1), ("q" * 500 + " b", 1))}
    assert dict(zip(trie.states[1].tolist(), trie.counts[1].tolist())) == states
    a, b = b"some bytes", b"and " * 100
    assert carried(np.array([zlib.crc32(a)], np.uint32), np.array([len(b)]))[0] ^ zlib.crc32(b) == zlib.crc32(a + b)
