"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

A piece's live positions are leaves that hold the rank of the pair beginning there; inner nodes hold the position of the
leftmost smallest rank. Each merge kills one position and updates the pairs of two live neighbours, so a piece of n
bytes costs O(n log n), however long it is. Pieces recur, so their ids are kept in a bounded table per worker.

Defined cases: null text counts as empty; an empty text has no ids and the digests of the empty string; repeated rows give
repeated results; an empty table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import in_batches, only, text_column

SHIFT = 40
NONE = 1 << 62
MASK = (1 << SHIFT) - 1


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece.

    tree: node 1 is the root, node size + i the leaf of position i. A leaf holds rank << SHIFT | position of the pair that
    begins there, or NONE; a node the smaller of its two, which is the leftmost least rank.
    """
    rank_of = ranks.get
    if (whole := rank_of(piece)) is not None:
        return [whole]
    n = len(piece)
    size = 1 << (n - 1).bit_length()
    tree = [NONE] * (2 * size)
    for i in range(n - 1):
        if (rank := rank_of(piece[i : i + 2])) is not None:
            tree[size + i] = rank << SHIFT | i
    for node in range(size - 1, 0, -1):
        x, y = tree[2 * node], tree[2 * node + 1]
        tree[node] = x if x < y else y
    ends, before = list(range(1, n + 1)), list(range(-1, n - 1))  # end of the token that starts at i; start of the one before
    while (top := tree[1]) != NONE:
        i = top & MASK
        j = ends[i]  # the token at j joins the one at i
        ends[i] = k = ends[j]
        if j < n and tree[node := size + j] != NONE:
            key = tree[node] = NONE
            while node > 1:
                if (other := tree[node ^ 1]) < key:
                    key = other
                node >>= 1
                if tree[node] == key:  # nothing above changes
                    break
                tree[node] = key
        key = NONE
        if k < n:
            before[k] = i
            if (rank := rank_of(piece[i : ends[k]])) is not None:
                key = rank << SHIFT | i
        node = size + i
        tree[node] = key
        while node > 1:
            if (other := tree[node ^ 1]) < key:
                key = other
            node >>= 1
            if tree[node] == key:
                break
            tree[node] = key
        if (h := before[i]) >= 0:
            key = NONE if (rank := rank_of(piece[h:k])) is None else rank << SHIFT | h
            if tree[node := size + h] != key:
                tree[node] = key
                while node > 1:
                    if (other := tree[node ^ 1]) < key:
                        key = other
                    node >>= 1
                    if tree[node] == key:
                        break
                    tree[node] = key
    found, i = [], 0
    while i < n:
        found.append(ranks[piece[i : ends[i]]])
        i = ends[i]
    return found


#: Beside these characters, the letters of the plain pattern are the same as \\p{L}, its digits as \\p{N}, its space as \\s.
UNPLAIN = re.compile("[^\\x00-\\x1b\\x20-\\x7f\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u024f]").search


class Codec:
    """Encoder and decoder for one vocabulary. keep: how many pieces are remembered, longest: of up to how many characters."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, keep: int = 1_000_000, longest: int = 40):
        self.ranks, self.keep, self.longest = ranks, keep, longest
        self.split = self.plain = regex.compile(pattern).findall
        if r"\p{L}" in pattern and not re.search(r"\\p\{(?![LN]\})|\\P|\\w|\\d", pattern):
            # in texts without other than plain characters the faster module finds the same matches
            plain = pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)").replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d")
            self.plain = re.compile(plain).findall
        self.tokens = [b""] * (max(ranks.values(), default=0) + 1)
        for raw, i in ranks.items():
            self.tokens[i] = raw
        self.known: dict[str, bytes] = {}

    def miss(self, piece: str) -> bytes:
        """Little-endian 32-bit ids of one match of the pattern that isn't remembered."""
        raw = merge_piece(piece.encode(), self.ranks)
        ids = struct.pack(f"<{len(raw)}I", *raw)
        if len(piece) <= self.longest:
            if len(self.known) >= self.keep:
                self.known.clear()
            self.known[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        pieces = (self.split if UNPLAIN(text) else self.plain)(text)
        ids = list(map(self.known.get, pieces))
        if None in ids:
            known, miss = self.known.get, self.miss
            ids = [x if x is not None else known(p) or miss(p) for x, p in zip(ids, pieces)]
        return b"".join(ids)

    def decode(self, ids: bytes) -> bytes:
        """The bytes that ids stand for."""
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I") if ids else ()))


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec a worker and vocabulary."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(load_ranks(path), pattern)
    return _codecs[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """doc_id, ids (array, unless with_ids is false), n_tokens, ids_sha256, decoded_sha256 of each text.

    path: a rank file that every executor has at that place, as libraries are installed there; it isn't shipped.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                ids = [c.encode(t) for t in part.column(1).to_pylist()]
                columns = [part.column(0)]
                if with_ids:
                    columns.append(pa.array([memoryview(x).cast("I").tolist() if x else [] for x in ids], pa.list_(pa.int32())))
                columns += [
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(c.decode(x)).hexdigest() for x in ids]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", *["ids"] * with_ids, "n_tokens", "ids_sha256", "decoded_sha256"]
    kinds = "doc_id long, " + "ids array<int>, " * with_ids + "n_tokens long, ids_sha256 string, decoded_sha256 string"
    rows = only(docs, doc_id="long", text="string")
    return in_batches(rows.select("doc_id", text_column().alias("text")), work, kinds)


def decode(ids: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and text (binary) of doc_id and ids."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            raw = [struct.pack(f"<{len(x)}I", *x) if x else b"" for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.decode(x) for x in raw], pa.binary())], ["doc_id", "text"])

    return in_batches(only(ids, doc_id="long", ids=""), work, "doc_id long, text binary")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: token ids of each document with their digests."""
    import public_tokenizers

    return encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
