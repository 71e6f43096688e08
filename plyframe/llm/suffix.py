"""Repeated strings of LENGTH bytes, by merging Burrows-Wheeler transforms of shards.

Which bytes can repeat is narrowed down exactly before suffixes are compared:

1. Of every window of LENGTH bytes the smallest hash of its GRAM-byte grams is its anchor, so equal windows have equal
   anchors at equal offsets. The windows of one anchor place are adjacent; the bytes they cover are its span.
2. Spans meet by anchor gram. Spans that occur twice as a whole consist of repeated windows. Spans whose gram has no other
   span hold none. Grams with very many spans are counted before they are shuffled, the others in one sorted pass.
3. What is left are different spans of one anchor gram: the edges of repeats. The spans of a gram are a group. Groups are
   dealt to shards; each shard's Burrows-Wheeler transform is built by itself, and shards are merged by iterative interleave
   refinement: with each pass over the interleave the merged order is right for one more character, without sorting
   suffixes again. Where neighbours part at pass h their common prefix has h bytes; the intervals left after LENGTH passes
   are the repeated windows.

A batch of groups has a bounded size. A group beyond MOST spans isn't gathered: its windows are counted by digest, which
is exact too and sums up before the shuffle.

Defined cases: null text counts as empty; texts shorter than LENGTH bytes have no windows; windows never cross documents;
rows repeated with the same doc_id and text are two documents, so their windows repeat; an empty table gives an empty result;
columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach_groups, discard, in_batches, materialize, only, text_column

LENGTH, GRAM = 200, 32
#: Bytes that one pass of the anchor search or of a merge handles; spans of the largest group that is merged in a task.
PACK, BATCH, MOST = 1 << 18, 56_000, 3000
SHARDS, PAD = 2, 7
BASE = 0x9E3779B97F4A7C15
U = np.uint64


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=U)
    out[0] = 1
    return np.multiply.accumulate(out)


class Anchors:
    """Finds spans. table: a random value for each byte."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram = length, gram
        self.table = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=U)
        self.up = self.down = np.empty(0, dtype=U)

    def _hashes(self, raw: np.ndarray) -> np.ndarray:
        """A mixed hash of the gram that begins at each byte."""
        n = len(raw)
        if len(self.up) < n:
            self.up, self.down = _powers(n + 1024, BASE), _powers(n + 1024, pow(BASE, -1, 1 << 64))
        sums = np.zeros(n + 1, dtype=U)
        np.cumsum(self.table[raw] * self.up[:n], out=sums[1:])
        h = (sums[self.gram :] - sums[: n + 1 - self.gram]) * self.down[: n + 1 - self.gram]
        h ^= h >> U(31)
        h *= U(0xBF58476D1CE4E5B9)
        h ^= h >> U(29)
        h *= U(0x94D049BB133111EB)
        return h ^ (h >> U(32))

    def spans(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """For documents at raw[starts:ends], each of LENGTH bytes or more: first and last window start, anchor, its hash and document of each span."""
        width = self.length - self.gram + 1
        h = self._hashes(raw)
        m = len(h)
        key = (h >> U(24) << U(24)) | np.arange(m, dtype=U)  # the leftmost smallest
        padded = np.full(-(-m // width) * width, np.iinfo(U).max, dtype=U)
        padded[:m] = key
        blocks = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        n = m - width + 1
        least = np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])
        at = (least & U((1 << 24) - 1)).astype(np.int64)
        change = np.empty(n, dtype=bool)
        change[0] = True
        np.not_equal(at[1:], at[:-1], out=change[1:])
        inside = np.zeros(n + 1, dtype=np.int32)
        last = ends - self.length  # of the window starts of each document
        inside[starts] += 1
        inside[last + 1] -= 1
        inside = np.cumsum(inside)[:n] > 0
        change[starts] = True
        change &= inside
        first = np.flatnonzero(change)
        doc = np.searchsorted(starts, first, side="right") - 1
        stop = np.minimum(np.append(first[1:] - 1, n - 1), last[doc])
        return first, stop, at[first], h[at[first]], doc


class Shard:
    """A collection of strings with its sorted suffixes.

    Each string ends in PAD end characters. transform(step) is the Burrows-Wheeler transform read `step` characters at a time:
    the code of the characters before each suffix, 0 where they begin in an end or before the string.
    """

    def __init__(self, strings: list[bytes]):
        sizes = np.array([len(s) for s in strings], dtype=np.int64)
        total = int((sizes + PAD).sum())
        begin = np.cumsum(sizes + PAD) - sizes - PAD
        self.raw = np.zeros(total, dtype=np.int64)  # characters are 1 more than bytes, ends are 0
        body = np.ones(total, dtype=bool)
        for k in range(PAD):
            body[begin + sizes + k] = False
        self.raw[body] = np.frombuffer(b"".join(strings), dtype=np.uint8).astype(np.int64) + 1
        self.ends = int((~body).sum())
        owner = np.repeat(np.arange(len(strings)), sizes + PAD)
        # prefix doubling from PAD characters on; each end is a character of its own
        rank = np.empty(total, dtype=np.int64)
        rank[body] = np.unique(self.grams(PAD)[body], return_inverse=True)[1] + self.ends
        rank[~body] = np.arange(self.ends)
        step, longest = PAD, int(sizes.max(initial=0)) + PAD
        while step < longest and rank.max(initial=0) < total - 1:
            second = np.zeros(total, dtype=np.int64)
            second[:-step] = rank[step:] + 1
            both = rank * (total + 1) + second
            order = np.argsort(both, kind="stable")
            key = both[order]
            rank[order] = np.cumsum(np.append(0, key[1:] != key[:-1]))
            step *= 2
        self.order = np.argsort(rank, kind="stable")
        self.owner, self.offset = owner[self.order], self.order - begin[owner[self.order]]

    def grams(self, step: int) -> np.ndarray:
        """The characters from each place on as one number, 0 where an end begins it."""
        code, padded = np.zeros(len(self.raw), dtype=np.int64), np.append(self.raw, np.zeros(step, dtype=np.int64))
        for k in range(step):
            code = code * 257 + padded[k : k + len(self.raw)]
        return np.where(self.raw > 0, code, 0)

    def transform(self, codes: np.ndarray, step: int) -> np.ndarray:
        before = np.zeros(len(codes), dtype=codes.dtype)
        before[step:] = codes[:-step]
        return np.where(self.offset >= step, before[self.order], 0).astype(np.uint16)


def coded(shards: list[Shard], step: int) -> list[np.ndarray] | None:
    """Transforms by dense codes of `step` characters that all shards share; None if there are too many for 16 bits."""
    grams = [s.grams(step) for s in shards]
    kinds = np.unique(np.concatenate([[0], *grams]))
    if len(kinds) > 65_536:
        return None
    return [s.transform(np.searchsorted(kinds, g).astype(np.uint16), step) for s, g in zip(shards, grams)]


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the shards' suffixes in merged order to `depth` characters, and the block of each suffix.

    Suffixes of one block share `depth` characters. The interleave starts as one shard after another; a pass of `step`
    characters puts the suffix that begins so much earlier into the bucket of these characters, in the order of the suffixes
    they lead to. Only interleave and transforms are read, suffixes are not sorted again. Ends are unique and stand first.
    """
    step, table = next((k, t) for k in (PAD, 4, 3, 2, 1) if (t := coded(shards, k)) is not None)
    passes = [table] * (depth // step) + ([coded(shards, depth % step)] if depth % step else [])
    which = np.repeat(np.arange(len(shards), dtype=np.uint8), [len(s.order) for s in shards])
    ends = np.repeat(np.arange(len(shards), dtype=np.uint8), [s.ends for s in shards])
    n = len(ends)
    block = np.zeros(len(which), dtype=np.int64)
    chars, part = np.empty(len(which), dtype=np.uint16), np.ones(len(which), dtype=bool)
    for transforms in passes:
        for j, t in enumerate(transforms):
            chars[which == j] = t
        order = np.argsort(chars, kind="stable")
        order = order[len(order) - (len(which) - n) :]  # 0 leads to an end or out of a string, whose place is fixed
        codes, below = chars[order], block[order]
        part[n + 1 :] = (codes[1:] != codes[:-1]) | (below[1:] != below[:-1])
        which = np.concatenate([ends, which[order]])
        block = np.cumsum(part) - 1
        if len(block) and block[-1] == len(block) - 1:
            break  # every suffix stands alone
    return which, block


def repeated(spans: list[bytes], length: int = LENGTH, shards: int = SHARDS) -> list[np.ndarray]:
    """For each of several strings, which window starts hold a window of `length` bytes that also starts elsewhere in them."""
    out = [np.zeros(max(0, len(s) - length + 1), dtype=bool) for s in spans]
    parts = [list(range(k, len(spans), shards)) for k in range(min(shards, len(spans)))]
    built = [Shard([spans[i] for i in part]) for part in parts]
    which, block = merge(built, length)
    string, offset = np.empty(len(which), dtype=np.int64), np.empty(len(which), dtype=np.int64)
    for j, (part, shard) in enumerate(zip(parts, built)):
        mine = which == j
        string[mine], offset[mine] = np.array(part)[shard.owner], shard.offset
    many = np.bincount(block)[block] > 1
    room = offset <= np.array([len(s) - length for s in spans])[string]
    for s, o in zip(string[many & room].tolist(), offset[many & room].tolist()):
        out[s][o] = True
    return out


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _packs(batch: pa.RecordBatch, length: int) -> Iterator[tuple[list, list[bytes], list[int]]]:
    """(k, h) and text pieces of up to PACK bytes in all, with each piece's place in its text. A long text comes in overlapping pieces."""
    keys, pieces, places, size = [], [], [], 0
    for k, h, t in zip(*(batch.column(c) for c in ("k", "h", "t"))):  # one text at a time
        k, h, t = k.as_py(), h.as_py(), t.as_py()
        for a in range(0, max(0, len(t) - length + 1), PACK):
            piece = t[a : a + PACK + length - 1]
            if size + len(piece) > PACK and pieces:
                yield keys, pieces, places
                keys, pieces, places, size = [], [], [], 0
            keys.append((k, h))
            pieces.append(piece)
            places.append(a)
            size += len(piece)
    if pieces:
        yield keys, pieces, places


#: A span's place as one number: first window start, then the anchor's and the last window start's distance from it.
FIELDS = 10
FIRST, ANCHOR, LAST = f"shiftright(p, {2 * FIELDS})", f"(shiftright(p, {2 * FIELDS}) + (shiftright(p, {FIELDS}) & {(1 << FIELDS) - 1}))", f"(shiftright(p, {2 * FIELDS}) + (p & {(1 << FIELDS) - 1}))"


def find_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """k, h, p (place), g (hash of the anchor gram), s (digest of the span) of all spans of k, h, t."""
    names = ["k", "h", "p", "g", "s"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, digest = Anchors(length, gram), xxhash.xxh3_64_intdigest
        for batch in batches:
            for keys, pieces, places in _packs(batch, length):
                sizes = np.array([len(p) for p in pieces], dtype=np.int64)
                starts = np.cumsum(sizes) - sizes
                joined = b"".join(pieces)
                first, last, anchor, g, doc = finder.spans(np.frombuffer(joined, dtype=np.uint8), starts, starts + sizes)
                s = np.fromiter((digest(joined[a : b + length]) for a, b in zip(first.tolist(), last.tolist())), dtype=U, count=len(first))
                place = ((first + (np.array(places, dtype=np.int64) - starts)[doc]) << 2 * FIELDS) | ((anchor - first) << FIELDS) | (last - first)
                own = np.array(keys, dtype=np.int64)[doc]
                columns = [own[:, 0], own[:, 1], place, g.view(np.int64), s.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return in_batches(texts.select("k", "h", "t"), work, "k long, h long, p long, g long, s long")


def heavy(spans: DataFrame, share: int = 1000, chunk: int = 1 << 20) -> DataFrame:
    """g, s of the spans, and g (s null) of the grams, that are over 1 / share of some chunk of a task's rows: the `share` most frequent of each.

    What is over that share of all rows is so in one chunk at least. Each has at least 100 spans.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append((batch.column("g").to_numpy(), batch.column("s").to_numpy()))
            size += batch.num_rows
            if size >= chunk:
                yield often(held)
                held, size = [], 0
        if held:
            yield often(held)

    def often(held: list) -> pa.RecordBatch:
        g, s = (np.concatenate(x) for x in zip(*held))
        least = max(100, len(g) // share)
        grams, n = np.unique(g, return_counts=True)
        few = np.isin(g, grams[n >= least])  # a heavy span's gram is heavy
        pairs, at, m = np.unique(np.stack([g[few], s[few]]), axis=1, return_index=True, return_counts=True) if few.any() else (np.empty((2, 0), np.int64),) * 3
        m = m if few.any() else np.empty(0, np.int64)
        pairs, m, grams, n = pairs[:, m >= least], m[m >= least], grams[n >= least], n[n >= least]
        columns = [pa.array(np.concatenate([grams, pairs[0]])), pa.array([None] * len(grams) + pairs[1].tolist(), pa.int64()), pa.array(np.concatenate([n, m]))]
        return pa.RecordBatch.from_arrays(columns, ["g", "s", "n"])

    found = in_batches(spans.select("g", "s"), work, "g long, s long, n long").groupBy("g", "s").agg(F.sum("n").alias("n"))
    top = [found.where(x).orderBy(F.desc("n"), "g", "s").limit(share) for x in ("s is null", "s is not null")]
    return top[0].unionByName(top[1]).select("g", "s")


def sort_out(spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(k, h, p of the spans that occur twice as a whole; one span of each kind of the grams that may have several: k, h, p, g, once).

    once: the kind has this span alone. Spans meet by gram; heavy spans need not meet, and those of other heavy grams meet by kind.
    """
    hot = materialize(heavy(spans), "suffix-heavy")  # at most two thousand rows
    pairs = F.broadcast(hot.where("s is not null").select(F.col("g").alias("hg"), F.col("s").alias("hs")))
    grams = F.broadcast(hot.select(F.col("g").alias("gg")).distinct())
    marked = spans.join(pairs, (F.col("g") == F.col("hg")) & (F.col("s") == F.col("hs")), "left").join(grams, F.col("g") == F.col("gg"), "left")
    copies = marked.where("hs is not null")
    spread = F.when(F.col("gg").isNotNull(), F.xxhash64("g", "s")).otherwise(F.col("g"))
    met = marked.where("hs is null").select("k", "h", "p", "g", "s", spread.alias("r"), F.col("gg").isNotNull().cast("long").alias("hot"))
    met = met.repartition("r").sortWithinPartitions("r", "g", "s")
    names = ["k", "h", "p", "g", "s", "r", "hot"]

    def judge(rows: np.ndarray) -> pa.RecordBatch:
        """rows: of whole groups (same r), sorted."""
        _, _, _, g, s, r, hot = rows
        new = np.concatenate([[True], (r[1:] != r[:-1]) | (g[1:] != g[:-1])])
        fresh = new | np.concatenate([[True], s[1:] != s[:-1]])
        kind, group = np.cumsum(fresh) - 1, np.cumsum(new) - 1
        many = np.bincount(kind)[kind] > 1
        edge = fresh & ((np.bincount(group, weights=fresh)[group] > 1) | (hot > 0))
        keep = np.flatnonzero(many | edge)
        return pa.RecordBatch.from_arrays([*(pa.array(rows[i][keep]) for i in range(4)), *(pa.array(x[keep]) for x in (many, edge))], ["k", "h", "p", "g", "many", "edge"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.empty((len(names), 0), dtype=np.int64)  # the last group, which may go on
        for batch in batches:
            rows = np.concatenate([rest, np.stack([batch.column(c).to_numpy() for c in names])], axis=1)
            cut = int(np.searchsorted(rows[5], rows[5][-1])) if rows.shape[1] else 0
            if cut:
                yield judge(rows[:, :cut])
            rest = rows[:, cut:].copy()
        if rest.shape[1]:
            yield judge(rest)

    found = materialize(in_batches(met, work, "k long, h long, p long, g long, many boolean, edge boolean"), "suffix-sorted")
    whole = found.where("many").select("k", "h", "p").unionByName(copies.select("k", "h", "p"))
    one = copies.groupBy("g", "s").agg(F.min(F.struct("k", "h", "p")).alias("r")).select("r.*", "g", F.lit(False).alias("once"))
    return whole, found.where("edge").select("k", "h", "p", "g", (~F.col("many")).alias("once")).unionByName(one)


def _cut(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """spans (k, h, p and more) with first, anchor and their bytes. A text's spans come together with it."""
    more = [c for c in spans.columns if c not in ("k", "h")]
    by_text = spans.groupBy("k", "h").agg(F.collect_list(F.struct(*more)).alias("spans"))
    met = texts.select("k", "h", "t").join(by_text, ["k", "h"]).select("k", "h", "t", F.explode("spans").alias("x")).select("k", "h", "t", "x.*")
    return met.select("k", "h", *more, F.expr(FIRST).alias("first"), F.expr(ANCHOR).alias("anchor"), F.expr(f"substring(t, int({FIRST}) + 1, int({LAST} - {FIRST}) + {LENGTH})").alias("bytes"))


def _probes(low: int, high: int, length: int, gram: int) -> list[tuple[int, int, int, int]]:
    """Classes of windows by their bytes before the anchor, that meet low..high: (from, to, bytes before, bytes after) where any
    two equal windows of a class agree on so many bytes before and after the anchor's gram."""
    rest = length - gram
    step = -(-(rest + 1) // 4)
    classes = [(a, min(a + step - 1, rest)) for a in range(0, rest + 1, step)]
    return [(a, z, a, rest - z) for a, z in classes if a <= high and z >= low]


def likely(group: list[tuple], length: int, gram: int) -> list[tuple]:
    """The spans (.., first, anchor, .., bytes) of one anchor gram that may hold a repeated window, cut to where it may be.

    Exact: equal windows have the anchor at one offset, and agree on the bytes that their class has around it.
    """
    seen: dict[tuple, int] = {}
    found = []
    for row in group:
        first, anchor, raw = row[2], row[3], row[6]
        high = anchor - first
        low = high - (len(raw) - length)
        keys = [(a, z, (a, raw[high - x : high + gram + y])) for a, z, x, y in _probes(low, high, length, gram)]
        for _, _, key in keys:
            seen[key] = seen.get(key, 0) + 1
        found.append((row, low, high, keys))
    out = []
    for row, low, high, keys in found:
        if shared := [(a, z) for a, z, key in keys if seen[key] > 1]:
            lo, hi = max(low, shared[0][0]), min(high, shared[-1][1])
            skip = high - hi
            out.append((row[0], row[1], row[2] + skip, row[3], row[4], row[5], row[6][skip : skip + hi - lo + length]))
    return out


def edge_repeats(spans: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """k, h, a, z: byte runs covered by repeated windows, of spans (k, h, first, anchor, once, g, bytes) whose groups are merged in batches."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(rows: list) -> pa.RecordBatch:
            out = []
            for (k, h, first, _, once, _, _), flags in zip(rows, repeated([r[6] for r in rows], length)):
                if once:
                    out += [(k, h, first + lo, first + hi - 1 + length) for lo, hi in _runs(flags)]
            columns = list(zip(*out)) if out else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["k", "h", "a", "z"])

        ready, group, size, g = [], [], 0, None  # whole groups; the group that is being read
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(7))):  # a batch is bounded in bytes
                if row[5] != g:
                    group = likely(group, length, gram)
                    ready += group
                    size += sum(len(r[6]) for r in group)
                    group, g = [], row[5]
                    if size > BATCH:
                        yield solve(ready)
                        ready, size = [], 0
                group.append(row)
        ready += likely(group, length, gram)
        if ready:
            yield solve(ready)

    dealt = spans.select("k", "h", "first", "anchor", "once", "g", "bytes").repartition("g").sortWithinPartitions("g")
    return in_batches(dealt, work, "k long, h long, a long, z long")


def window_repeats(spans: DataFrame, length: int = LENGTH) -> DataFrame:
    """The same as edge_repeats for groups of any size: windows are counted by digest, whole groups meet nowhere."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 200) for i in range(0, batch.num_rows, 200)):
                out = []
                for k, h, first, once, raw in zip(*(part.column(c).to_pylist() for c in ("k", "h", "first", "once", "bytes"))):
                    out += [(k, h, first + i, once, xxhash.xxh3_128_digest(raw[i : i + length])) for i in range(len(raw) - length + 1)]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, kinds)], ["k", "h", "at", "once", "d"])

    windows = materialize(in_batches(spans.select("k", "h", "first", "once", "bytes"), work, "k long, h long, at long, once boolean, d binary"), "suffix-windows")
    counts = materialize(windows.groupBy("d").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "suffix-counts")
    found = attach_groups(windows, counts, "d", "n", F.unhex(F.md5(F.concat_ws(" ", "k", "h", "at")))).where("n is not null and once")
    return found.select("k", "h", F.col("at").alias("a"), (F.col("at") + length).alias("z"))


def repeat_removal(docs: DataFrame, most: int = MOST) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows = only(docs, doc_id="long", text="string").select("doc_id", text_column().alias("t"))
    rows = rows.select("doc_id", F.xxhash64("t").alias("h"), F.col("t").cast("binary").alias("t")).withColumn("k", F.xxhash64("doc_id", "h"))
    spans = materialize(find_spans(rows), "suffix-spans")
    whole, edges = sort_out(spans)
    whole = whole.select("k", "h", F.expr(FIRST).alias("a"), F.expr(f"{LAST} + {LENGTH}").alias("z"))
    several = materialize(edges.groupBy("g").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "suffix-several")
    edges = attach_groups(edges, several, "g", "m", F.xxhash64("k", "p")).where("m is not null")
    edges = materialize(_cut(rows, edges), "suffix-edges")
    found = edge_repeats(edges.where(F.col("m") <= most)).unionByName(window_repeats(edges.where(F.col("m") > most)))
    runs = whole.unionByName(found).groupBy("k", "h").agg(F.collect_list(F.struct("a", "z")).alias("runs"))
    runs = materialize(runs, "suffix-runs")
    discard(spans, several, edges)
    met = rows.join(runs, ["k", "h"], "left").select("doc_id", "t", "runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, t, runs in zip(batch.column("doc_id").to_pylist(), batch.column("t"), batch.column("runs")):
                t, merged = t.as_py(), merge_runs(runs.as_py())
                kept, at = hashlib.sha256(), 0
                for a, z in merged:
                    kept.update(t[at:a])
                    at = z
                kept.update(t[at:])
                out.append((doc, len(t), sum(z - a for a, z in merged), len(merged), kept.hexdigest()))
            types = [pa.int64()] * 4 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, types)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return in_batches(met, cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def merge_runs(runs: list[dict] | None) -> list[list[int]]:
    """Runs a..z in order, those that meet or overlap as one."""
    merged: list[list[int]] = []
    for a, z in sorted((r["a"], r["z"]) for r in runs or ()):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(z, merged[-1][1])
        else:
            merged.append([a, z])
    return merged
