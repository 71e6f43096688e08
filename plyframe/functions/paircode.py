"""Runs of small whole numbers as bytes: recursive pairs, then canonical prefix codes.

The most frequent pair of neighbours becomes a symbol of its own, again and again, so a symbol stands for a tree of pairs. What is left
is written in prefix codes of which only the lengths are kept: codes of one length are consecutive numbers, shorter ones come first.
Bytes: count of values, of base symbols and of pairs, of coded symbols; base symbols; pairs; code lengths; the codes.
"""

from __future__ import annotations

import heapq
import struct

import numpy as np

#: A pair becomes a symbol if it stands there so often; so many symbols at most.
OFTEN, SYMBOLS = 6, 4096


def paired(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base symbols, pairs, sequence): symbols are numbered base first, then pairs in the order in which they were made."""
    base, seq = np.unique(values, return_inverse=True)
    pairs: list[tuple[int, int]] = []
    n = len(base)
    while len(seq) > 1 and n + len(pairs) < SYMBOLS:
        both = seq[:-1].astype(np.int64) * SYMBOLS + seq[1:]
        kinds, counts = np.unique(both, return_counts=True)
        best = int(counts.argmax())
        a, b = divmod(int(kinds[best]), SYMBOLS)
        at = np.flatnonzero(both == kinds[best])
        if a == b and len(at) > 1:  # of overlapping pairs every other one, from the start of each run
            first = np.concatenate(([True], np.diff(at) > 1))
            start = at[first][np.cumsum(first) - 1]
            at = at[(at - start) % 2 == 0]
        if len(at) < OFTEN:
            break
        seq = seq.copy()
        seq[at] = n + len(pairs)
        seq = np.delete(seq, at + 1)
        pairs.append((a, b))
    return base, np.array(pairs, dtype=np.uint16).reshape(-1, 2), seq


def lengths(counts: np.ndarray) -> np.ndarray:
    """Length of the code of each symbol; 0 where it doesn't occur, 1 where it is alone."""
    out = np.zeros(len(counts), dtype=np.uint8)
    heap = [(int(c), i, [i]) for i, c in enumerate(counts) if c]
    if len(heap) == 1:
        out[heap[0][1]] = 1
    heapq.heapify(heap)
    while len(heap) > 1:
        (c, i, x), (d, _, y) = heapq.heappop(heap), heapq.heappop(heap)
        out[x + y] += 1
        heapq.heappush(heap, (c + d, i, x + y))
    return out


def codes(size: np.ndarray) -> list[tuple[int, int]]:
    """(symbol, code) in the order of lengths, then symbols."""
    out, code, last = [], 0, 0
    for s in sorted(np.flatnonzero(size), key=lambda s: (size[s], s)):
        code <<= int(size[s]) - last
        last = int(size[s])
        out.append((int(s), code))
        code += 1
    return out


def encode(values: np.ndarray) -> bytes:
    base, pairs, seq = paired(np.asarray(values, dtype=np.int32))
    size = lengths(np.bincount(seq, minlength=len(base) + len(pairs)) if len(seq) else np.zeros(0, dtype=int))
    text = {s: format(code, f"0{size[s]}b") for s, code in codes(size)}
    bits = "".join(text[s] for s in seq.tolist())
    body = int(bits or "0", 2).to_bytes((len(bits) + 7) // 8, "big") if bits else b""
    head = struct.pack("<IIII", len(values), len(base), len(pairs), len(seq))
    # the bits are right-aligned: the reader knows how many there are from the lengths of what it has read
    return head + base.astype("<i4").tobytes() + pairs.astype("<u2").tobytes() + size.tobytes() + struct.pack("<I", len(bits)) + body


def decode(data: bytes) -> np.ndarray:
    n, n_base, n_pairs, n_seq = struct.unpack_from("<IIII", data)
    at = 16
    base = np.frombuffer(data, "<i4", n_base, at)
    at += 4 * n_base
    pairs = np.frombuffer(data, "<u2", 2 * n_pairs, at).reshape(-1, 2).tolist()
    at += 4 * n_pairs
    size = np.frombuffer(data, np.uint8, n_base + n_pairs, at)
    at += n_base + n_pairs
    (n_bits,) = struct.unpack_from("<I", data, at)
    bits = format(int.from_bytes(data[at + 4 :], "big"), f"0{n_bits}b") if n_bits else ""
    by_code = {format(code, f"0{size[s]}b"): s for s, code in codes(size)}
    whole: list[np.ndarray] = [base[i : i + 1] for i in range(n_base)]  # what each symbol stands for
    for a, b in pairs:
        whole.append(np.concatenate((whole[a], whole[b])))
    out, low, shortest = [], 0, int(size[size > 0].min()) if n_seq else 1
    for _ in range(n_seq):
        high = low + shortest
        while bits[low:high] not in by_code:
            high += 1
        out.append(whole[by_code[bits[low:high]]])
        low = high
    found = np.concatenate(out) if out else np.zeros(0, dtype=np.int32)
    if len(found) != n:
        raise ValueError(f"{len(found)} values where {n} were written")
    return found
