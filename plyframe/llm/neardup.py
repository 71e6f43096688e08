"""Near-duplicate groups by bottom-k sketches of word shingles.

1. One hash function maps a document's shingles to 64-bit values; its sketch is the K smallest. Documents with equal sets are
   one class, so copies never meet in pairs.
2. Inverted lists of retained values generate overlaps. Two sets as similar as asked share well over SHARED of the
   retained values (with K = 64 and a similarity of 0.8, less than that is six standard deviations off), so they share
   one of the rarest (1 - SHARED) * K + 1: only these, ranked by how many classes retain them, are a class's list keys.
   A passage that many documents share fills its own values only and is no key unless it is most of a sketch.
3. Union-sketch estimation filters pairs, with a margin, and the ratio of set sizes filters exactly.
4. Exact Jaccard on the full sets, computed from the whole texts, verifies what is left.

Links are sought until connected groups can't change. Rounds first pair each list's members with one leader (at first the
member with the fewest values of its own, which is the centre of a group of near copies), so links grow with the group, not
with its square. Then only lists with members of different groups are open, and among their members exact bounds on the
full sets decide who can still be linked: of x's shingles, `alone` are in no other open set, so no link of x has more than
n - alone shingles in common, and a pair's union holds the lone shingles of both. Members that can't reach the similarity
with any partner go, which makes further shingles lone; what then remains is compared in blocks of bounded size, under the
same bounds, by sketches and then by up to LONG values of the sets, so a block passes on links and, of larger sets, what is
near the threshold. A pair within one group needs no link. Components are found by joins; neither links nor labels come to the driver.

Defined cases: null and empty texts and texts without words have an empty set, are groups of their own and kept; fewer words
than a shingle are one shingle; rows with a null doc_id take no part and get a null component; each row is a document: a
doc_id that comes with several texts is several documents, linked by their texts alone; rows repeated with the same doc_id
and text have equal results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import attach_groups, discard, in_batches, materialize, one_each, only, text_column, without

K, SHARED, MARGIN = 64, 0.5, 0.3
SHINGLE = 5
ROUNDS, PRUNES, BLOCK, STAR = 2, 3, 1024, 256
#: Values of a set that are compared within a block: smaller sets exactly, of larger ones an estimate that is eight standard deviations wide.
LONG, SLACK = 1024, 0.1
PRIME = 0x9E3779B97F4A7C15


class Shingler:
    """Sets of shingle hashes. Words: runs of characters other than ASCII white space, A-Z in lower case."""

    def __init__(self, size: int = SHINGLE, keep: int = 150_000):
        self.size, self.keep, self.known = size, keep, {}
        self.powers = [np.uint64(pow(PRIME, i, 1 << 64)) for i in range(size)]

    def set(self, text: bytes) -> np.ndarray:
        """Sorted distinct hashes."""
        words = text.lower().split()
        if not words:
            return np.empty(0, dtype=np.uint64)
        if len(self.known) > self.keep:
            self.known.clear()
        known, hashed = self.known, xxhash.xxh3_64_intdigest
        values = list(map(known.get, words))
        if None in values:
            for i, w in enumerate(words):
                if values[i] is None:
                    values[i] = hashed(w)
                    if len(w) <= 40:
                        known[w] = values[i]
        v = np.array(values, dtype=np.uint64)
        n = len(v) - self.size + 1
        if n < 1:
            return np.array([hashed(b" ".join(words), seed=len(words))], dtype=np.uint64)
        h = np.zeros(n, dtype=np.uint64)
        for i, p in enumerate(self.powers):
            h += v[i : i + n] * p
        h ^= h >> np.uint64(30)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        return np.unique(h)


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    flat = pa.array(np.concatenate([np.empty(0, dtype=np.int64), *values]), pa.int64())
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, values)]), pa.int32()), flat)


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text), t (its bytes)."""
    rows = only(docs, doc_id="long", text="string").select("doc_id", text_column().alias("t"))
    return rows.select("doc_id", F.xxhash64("t").alias("h"), F.col("t").cast("binary").alias("t"))


def sketches(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, h, n (set size), key (of the set; null if empty), sketch (the K smallest values, as signed)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Shingler(size)
        for batch in batches:
            sizes, keys, least = [], [], []
            for t in batch.column("t"):
                x = s.set(t.as_py())
                sizes.append(len(x))
                keys.append(xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None)
                least.append(x[:K].view(np.int64).copy())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), _lists(least)], ["doc_id", "h", "n", "key", "sketch"])

    return in_batches(_texts(docs), work, "doc_id long, h long, n long, key binary, sketch array<long>")


def full_sets(docs: DataFrame, chosen: DataFrame, size: int = SHINGLE) -> DataFrame:
    """a, set (its values as bytes, in order) of the chosen classes (a, doc_id, h). A class may have equal rows, which do no harm."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Shingler(size)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("a"), pa.array([s.set(t.as_py()).tobytes() for t in batch.column("t")], pa.binary())], ["a", "set"])

    return in_batches(_texts(docs).join(chosen, ["doc_id", "h"]).select("a", "t"), work, "a long, set binary")


def list_keys(classes: DataFrame) -> DataFrame:
    """v, a, n, own: the rarest retained values of each class that another class retains too. own: how many no other class retains."""
    kept = classes.select("a", "n", F.size("sketch").alias("s"), F.explode("sketch").alias("v"))
    often = materialize(kept.groupBy("v").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "near-df")
    kept = attach_groups(kept, often, "v", "df", F.xxhash64("a", "v")).where("df is not null")
    one = Window.partitionBy("a")
    kept = kept.withColumn("own", F.col("s") - F.count(F.lit(1)).over(one)).withColumn("rank", F.row_number().over(one.orderBy("df", "v")))
    # values that nobody else retains are rarer still and take the first places
    return kept.where(F.col("rank") <= F.col("s") - F.ceil(F.col("s") * SHARED) + 1 - F.col("own")).select("v", "a", "n", "own")


def _sketch_pairs(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Similarities estimated from the K smallest values of the union. Sketches are padded with the largest value."""
    pad = np.iinfo(np.uint64).max
    both = np.sort(np.concatenate([x, y], axis=1), axis=1)
    real = both != pad
    twice = np.zeros(both.shape, dtype=bool)
    twice[:, 1:] = (both[:, 1:] == both[:, :-1]) & real[:, 1:]
    distinct = np.cumsum(real & ~twice, axis=1)
    # beyond the K-th value of the union a sketch may end
    inside = distinct <= K
    return (twice & inside).sum(1) / np.maximum(1, (real & ~twice & inside).sum(1))


def _padded(sketches: pa.Array) -> np.ndarray:
    lengths = sketches.value_lengths().to_numpy(zero_copy_only=False)
    out = np.full((len(lengths), K), np.iinfo(np.uint64).max, dtype=np.uint64)
    flat = sketches.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _stars(pairs: DataFrame, held: DataFrame, test: Callable[[list, pa.Array, np.ndarray], np.ndarray]) -> DataFrame:
    """The pairs (hub, b, m) whose values pass the test. held: a and a value; m: a bound of the hub's partners.

    A hub's partners are dealt to blocks of about STAR; the hub's value goes to each block once, a partner's once a pair.
    test(hub values, partner values, hub of each partner) is asked for a batch of partners.
    """
    dealt = pairs.withColumn("blocks", F.ceil(F.col("m") / STAR)).withColumn("block", F.pmod(F.xxhash64("b"), F.col("blocks")))
    key, value = ["hub", "blocks", "block"], held.columns[1]
    hubs = dealt.select(*key).distinct().join(held.withColumnRenamed("a", "hub"), "hub").select(*key, F.lit(None).cast("long").alias("b"), value)
    members = dealt.select(*key, "b").join(held.withColumnRenamed("a", "b"), "b").select(*key, "b", value)
    met = hubs.unionByName(members).repartition(*key).sortWithinPartitions(*key, F.col("b").asc_nulls_first())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the hub of the block that is being read
        for batch in batches:
            first = batch.column("b").is_null().to_numpy(zero_copy_only=False)
            values = batch.column(value)
            hubs = [last, *(values[i] for i in np.flatnonzero(first).tolist())]
            last = hubs[-1]
            mine = np.flatnonzero(~first)
            if len(mine):
                keep = test(hubs, values.take(pa.array(mine)), np.cumsum(first)[mine])
                yield batch.select(["hub", "b", "blocks"]).take(pa.array(mine)).filter(pa.array(keep, pa.bool_()))

    return in_batches(met, work, "hub long, b long, blocks long").select("hub", "b", (F.col("blocks") * STAR).alias("m"))


def _likely(percent: int) -> Callable:
    least = percent / 100 - MARGIN

    def test(hubs: list, partners: pa.Array, of: np.ndarray) -> np.ndarray:
        flat = [np.array([], dtype=np.int64) if h is None else h.values.to_numpy() for h in hubs]
        x, y, keep = _padded(_lists(flat)), _padded(partners), np.zeros(len(of), bool)
        for i in range(0, len(of), 2000):
            keep[i : i + 2000] = _sketch_pairs(x[of[i : i + 2000]], y[i : i + 2000]) >= least
        return keep

    return test


def _exact(percent: int) -> Callable:
    def test(hubs: list, partners: pa.Array, of: np.ndarray) -> np.ndarray:
        keep, known, x = np.zeros(len(of), bool), None, None
        for i, (k, raw) in enumerate(zip(of.tolist(), partners)):
            if k != known:
                known, x = k, np.frombuffer(hubs[k].as_buffer(), dtype=np.uint64)
            y = np.frombuffer(raw.as_buffer(), dtype=np.uint64)
            common = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
            keep[i] = 100 * common >= percent * (len(x) + len(y) - common)
        return keep

    return test


def components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (a, c: the smallest member of a's group so far) after the links (hub, b). Groups by smallest labels and pointer jumping."""
    group = labels.select(F.col("a").alias("b"), F.col("c").alias("cb"))
    hubs = materialize(links.groupBy("hub").agg(F.count(F.lit(1)).alias("m")).join(labels.select(F.col("a").alias("hub"), F.col("c").alias("ca")), "hub"), "near-hubs")
    edges = attach_groups(links.select("hub", "b"), hubs, "hub", "m", F.xxhash64("hub", "b")).join(group, "b").where("ca != cb").select(F.greatest("ca", "cb").alias("x"), F.least("ca", "cb").alias("y")).distinct()
    edges = materialize(edges, "near-edges")
    parents = None  # x -> c, of groups that a smaller one takes
    while True:
        if edges.isEmpty():
            break
        # each group hangs on its smallest neighbour; then chains are followed to their ends
        step = edges.groupBy("x").agg(F.min("y").alias("c"))
        step = materialize(step, "near-step")
        while True:
            onward = step.select(F.col("x").alias("c"), F.col("c").alias("root"))
            jumped = materialize(step.join(onward, "c", "left").select("x", F.coalesce("root", "c").alias("c"), F.col("root").isNotNull().alias("moved")), "near-jump")
            step = jumped.select("x", "c")
            if jumped.where("moved").isEmpty():
                break
        moves = step
        if parents is None:
            parents = moves
        else:
            onward = moves.select(F.col("x").alias("c"), F.col("c").alias("root"))
            parents = parents.join(onward, "c", "left").select("x", F.coalesce("root", "c").alias("c")).unionByName(moves)
            parents = materialize(parents, "near-parents")
        to = lambda side: moves.select(F.col("x").alias(side), F.col("c").alias(f"r{side}"))
        mapped = edges.join(to("x"), "x", "left").join(to("y"), "y", "left").select(F.coalesce("rx", "x").alias("p"), F.coalesce("ry", "y").alias("q"))
        edges = materialize(mapped.where("p != q").select(F.greatest("p", "q").alias("x"), F.least("p", "q").alias("y")).distinct(), "near-edges")
    if parents is None:
        return labels
    roots = parents.select(F.col("x").alias("c"), F.col("c").alias("root"))
    return materialize(labels.join(roots, "c", "left").select("a", F.coalesce("root", "c").alias("c")), "near-labels")


def _leader_pairs(lists: DataFrame, labels: DataFrame, turn: int, percent: int) -> DataFrame:
    """hub, b, m: each member of a list with the list's leader, if they are in different groups and their sizes allow a link.

    Leaders come from an order that all lists share: first the fewest values of one's own, later a hash.
    """
    held = lists.join(labels, "a")
    order = F.struct(F.when(F.lit(turn == 0), F.col("own")).otherwise(F.lit(0)).alias("own"), F.xxhash64(F.lit(turn), "a").alias("k"), "a", "n", "c")
    leaders = held.groupBy("v").agg(F.min(order).alias("l"), F.count(F.lit(1)).alias("m"))
    leaders = materialize(leaders.select("v", "m", F.col("l.a").alias("hub"), F.col("l.n").alias("ln"), F.col("l.c").alias("lc")), "near-leaders")
    met = attach_groups(held, leaders, "v", "m", F.xxhash64("a", "v")).where("c != lc").where(F.least("n", "ln") * 100 >= F.greatest("n", "ln") * percent)
    return met.groupBy("hub", F.col("a").alias("b")).agg(F.max("m").alias("m"))


def _open_lists(held: DataFrame) -> DataFrame:
    """The rows of the lists whose members are in different groups, with m, the list's length."""
    ends = held.groupBy("v").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("m")).where("lo < hi").select("v", "m")
    return attach_groups(held, materialize(ends, "near-open"), "v", "m", F.xxhash64("a", "v")).where("m is not null")


def _alone(sets: DataFrame) -> DataFrame:
    """a, alone: how many values of a set no other of these sets holds."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [np.frombuffer(x.as_buffer(), dtype=np.int64) for x in batch.column("set")]
            if values:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(values)), pa.array(np.repeat(batch.column("a").to_numpy(), [len(x) for x in values]))], ["x", "a"])

    flat = in_batches(sets, work, "x long, a long")
    return flat.groupBy("x").agg(F.count(F.lit(1)).alias("n"), F.min("a").alias("a")).where("n = 1").groupBy("a").agg(F.count(F.lit(1)).alias("alone"))


def _open_members(lists: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Rows of open lists (v, a, n, c, m, alone) whose members may still have a link to another group."""
    held = lists.select("v", "a", "n").join(labels, "a")
    for _ in range(PRUNES):
        held = materialize(_open_lists(held), "near-open-lists")
        members = held.select("a", "n").distinct()
        before = members.count()
        lone = _alone(sets.join(members.select("a"), "a", "left_semi"))
        able = members.join(lone, "a", "left").select("a", F.coalesce("alone", F.lit(0)).alias("alone"), "n").where(F.expr(f"100 * (n - alone) >= {percent} * n"))
        able = materialize(able.select("a", "alone"), "near-able")
        held = held.drop("m").join(able, "a")
        if not before or able.count() > 0.9 * before:
            break
        held = held.drop("alone")
    else:
        held = held.join(able, "a")
    return _open_lists(held)


def _close(x: np.ndarray, y: np.ndarray, nx: int, ny: int, percent: int) -> bool:
    """Whether sets of nx and ny values, of which x and y are the LONG smallest, may be as similar as asked; exact if that is all of them."""
    if nx <= LONG and ny <= LONG:
        common = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
        return 100 * common >= percent * (nx + ny - common)
    least = np.union1d(x, y)[:LONG]
    return int((np.isin(least, x, assume_unique=True) & np.isin(least, y, assume_unique=True)).sum()) >= (percent / 100 - SLACK) * len(least)


def _open_pairs(lists: DataFrame, held: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """hub, b, m: all likely pairs of different groups within a list, compared in blocks of BLOCK members against BLOCK members.

    held: of _open_members. A pair comes from one list alone, that of the least key which both have.
    """
    keys = lists.join(held.select("a").distinct(), "a", "left_semi").groupBy("a").agg(F.sort_array(F.collect_list("v")).alias("keys"))  # up to K of each
    blocks = F.ceil(F.col("m") / BLOCK).cast("long")
    mine = F.pmod(F.xxhash64("a"), blocks)
    held = held.withColumn("blocks", blocks).withColumn("i", mine).withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    held = held.select("v", F.least("i", "j").alias("p"), F.greatest("i", "j").alias("q"), "i", "a", "c", "n", "alone")
    values = sets.join(held.select("a").distinct(), "a", "left_semi").groupBy("a").agg(F.min(F.substring("set", 1, 8 * LONG)).alias("long"))
    held = held.join(classes.select("a", "sketch"), "a").join(keys, "a").join(values, "a")
    dealt = held.repartition("v", "p", "q").sortWithinPartitions("v", "p", "q", "a")
    least = percent / 100 - MARGIN

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compare(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(parts).combine_chunks()
            v, p, q = (t.column(x)[0].as_py() for x in ("v", "p", "q"))
            own: dict[int, set] = {}
            keys_of = lambda x: own[x] if x in own else own.setdefault(x, set(t.column("keys")[x].as_py()))
            a, c, n, i, alone = (t.column(x).to_numpy() for x in ("a", "c", "n", "i", "alone"))
            sk = _padded(t.column("sketch").chunk(0) if t.column("sketch").num_chunks else pa.array([], pa.list_(pa.int64())))
            long = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in t.column("long")]
            left = np.flatnonzero(i == p)
            right = np.flatnonzero(i == q)
            out = [np.empty((0, 2), dtype=np.int64)]
            for x in left:
                y = right[(a[right] > a[x]) if p == q else np.ones(len(right), bool)]
                common = np.minimum(n[y] - alone[y], n[x] - alone[x])
                union = np.maximum(n[y] + n[x] - common, common + alone[y] + alone[x])
                y = y[(c[y] != c[x]) & (100 * common >= percent * union)]
                if len(y):
                    y = y[_sketch_pairs(np.repeat(sk[x][None], len(y), 0), sk[y]) >= least]
                    y = y[np.array([min(keys_of(int(x)) & keys_of(z)) == v and _close(long[x], long[z], int(n[x]), int(n[z]), percent) for z in y.tolist()], dtype=bool)]
                    out.append(np.stack([np.full(len(y), a[x]), a[y]], 1))
            got = np.concatenate(out)
            return pa.RecordBatch.from_arrays([pa.array(got[:, 0]), pa.array(got[:, 1])], ["hub", "b"])

        key, held_ = None, []
        for batch in batches:
            keys = np.stack([batch.column(x).to_numpy() for x in ("v", "p", "q")], 1)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for lo, hi in zip(edges, edges[1:]):
                if hi == lo:
                    continue
                if tuple(keys[lo]) != key:
                    if held_:
                        yield compare(held_)
                    key, held_ = tuple(keys[lo]), []
                held_.append(batch.slice(lo, hi - lo))
        if held_:
            yield compare(held_)

    return in_batches(dealt, work, "hub long, b long").distinct().withColumn("m", F.lit(1).cast("long"))


def grouped(docs: DataFrame, percent: int = 80, size: int = SHINGLE) -> DataFrame:
    """near_groups() with h, the hash of the row's text, and part, the group's own number (null for rows without words): groups of
    texts that share their smallest doc_id have one component_id."""
    held = materialize(sketches(docs, size), "near-sketches")
    filled = held.where("n > 0 and doc_id is not null")
    classes = filled.groupBy("key").agg(F.min(F.struct("doc_id", "h", "n", "sketch")).alias("r"), F.count(F.lit(1)).alias("copies"))
    classes = materialize(classes.select(F.monotonically_increasing_id().alias("a"), "key", "copies", "r.*"), "near-classes")
    lists = materialize(list_keys(classes), "near-lists")
    labels = classes.select("a", F.col("a").alias("c"))
    sets = materialize(full_sets(docs, classes.join(lists.select("a").distinct(), "a", "left_semi").select("a", "doc_id", "h"), size), "near-sets")
    for turn in range(ROUNDS + 1):
        if turn < ROUNDS:
            used = materialize(_leader_pairs(lists, labels, turn, percent), "near-leads")
            pairs = _stars(used, classes.select("a", "sketch"), _likely(percent))
        else:
            used = materialize(_open_members(lists, labels, sets, percent), "near-open-members")
            pairs = _open_pairs(lists, used, classes, sets, percent)
        pairs = materialize(pairs, "near-pairs")
        if not pairs.isEmpty():
            links, before = materialize(_stars(pairs, sets, _exact(percent)), "near-links"), labels
            labels = components(labels, links)
            discard(links, *([before] if before is not labels else []))
        discard(used, pairs)
    named = classes.select("a", "key", "copies", "doc_id").join(labels, "a")
    groups = materialize(named.groupBy("c").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("m")), "near-groups")
    named = attach_groups(named, groups, "c", "m", F.xxhash64("a")).select("key", "copies", "component_id", "c")
    named = materialize(named, "near-named")
    discard(classes, lists, sets, labels, groups)
    alone = F.unhex(F.sha2(F.concat_ws(" ", "doc_id", "h"), 256))
    held = held.withColumn("key", F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("key")), alone))
    found = attach_groups(held, named, "key", "copies", alone)
    found = found.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return found.select("doc_id", "h", F.col("c").alias("part"), F.col("n").alias("n_shingles"), "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def near_groups(docs: DataFrame, percent: int = 80, size: int = SHINGLE) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept. Links: 100 * intersection >= percent * union."""
    return grouped(docs, percent, size).drop("h", "part")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, at a similarity of 80 %: of each group one row stays, one with the smallest doc_id; of several texts under
    that id the one with the smallest hash. Rows with a null doc_id all stay."""
    rows = materialize(grouped(docs, percent=80), "near-verdicts").where("doc_id is not null")
    best = rows.where("kept and part is not null").groupBy("part").agg(F.min("h").alias("_h"), F.count(F.lit(1)).alias("m")).where("m > 1").select("part", "_h")
    others = rows.where("kept").join(best, "part").where("h <> _h")
    gone = rows.where("not kept").select("doc_id", "h").unionByName(others.select("doc_id", "h"))
    return one_each(without(docs, gone.distinct()), rows.where("kept"))
