"""Length-limited canonical Huffman code for token ids, vectorised with NumPy.

``code_lengths`` is the package-merge algorithm (Larmore and Hirschberg, 1990),
``canonical`` assigns codes in (length, id) order, so lengths alone define the
code. Bits are written most significant first. Every sequence starts at a byte
and has a checkpoint, its bit offset, for each STRIDE ids; between checkpoints a
decoder needs nothing but the code, so all stretches are decoded side by side
with one table lookup per id.
"""

from __future__ import annotations

import numpy as np

LIMIT = 16
STRIDE = 256


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code length per id under ``limit``; 0 where the count is 0."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids do not fit codes of {limit} bits")
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = np.asarray(counts, np.int64)[order]
    packages = np.zeros(0, np.int64)
    levels = []
    for _ in range(limit):
        weight = np.concatenate([leaves, packages])
        rank = np.argsort(weight, kind="stable")
        levels.append(rank < len(leaves))
        weight = weight[rank]
        packages = weight[: len(weight) // 2 * 2].reshape(-1, 2).sum(axis=1)
    need = 2 * len(leaves) - 2
    chosen = np.zeros(len(leaves), np.uint8)
    for is_leaf in reversed(levels):
        n = int(is_leaf[:need].sum())
        chosen[:n] += 1
        need = 2 * (need - n)
    lengths[order] = chosen
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of every id, right-aligned."""
    codes = np.zeros(len(lengths), np.uint32)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    size = lengths[order].astype(np.int64)
    # as fractions of 2 ** LIMIT, codes are running sums of 2 ** (LIMIT - length)
    top = np.concatenate(([0], np.cumsum(1 << (LIMIT - size))))[:-1]
    codes[order] = top >> (LIMIT - size)
    return codes


def decode_table(lengths: np.ndarray) -> np.ndarray:
    """For each LIMIT-bit window ``id << 5 | length``."""
    table = np.zeros(1 << LIMIT, np.uint32)
    used = np.flatnonzero(lengths)
    size = lengths[used].astype(np.int64)
    first = canonical(lengths)[used].astype(np.int64) << (LIMIT - size)
    order = np.argsort(first)
    entry = (used.astype(np.uint32) << np.uint32(5)) | size.astype(np.uint32)
    filled = np.repeat(entry[order], (1 << (LIMIT - size))[order])
    table[:len(filled)] = filled
    return table


def encode(ids: np.ndarray, bounds: np.ndarray, codes: np.ndarray, lengths: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sequences ``ids[bounds[i]:bounds[i + 1]]`` as (bytes, byte bounds, checkpoints, checkpoint bounds).

    Checkpoints are bit offsets from the start of their sequence.
    """
    n = len(bounds) - 1
    size = lengths[ids].astype(np.int64)
    ends = np.concatenate(([0], np.cumsum(size)))
    bits = ends[bounds[1:]] - ends[bounds[:-1]]
    byte_bounds = np.concatenate(([0], np.cumsum((bits + 7) // 8)))
    per = np.diff(bounds)
    shift = np.repeat(8 * byte_bounds[:-1] - ends[bounds[:-1]], per)
    at = ends[:-1] + shift
    out = np.zeros(int(byte_bounds[-1]) // 4 + 2, np.uint32)
    if len(ids):
        word = at >> 5
        wide = codes[ids].astype(np.uint64) << (np.uint64(64) - (at & 31).astype(np.uint64) - size.astype(np.uint64))
        first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        # codes do not overlap, so sums are bitwise ors
        out[word[first]] += np.add.reduceat(wide >> np.uint64(32), first).astype(np.uint32)
        low = (wide & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        over = np.flatnonzero(low)
        out[word[over] + 1] += low[over]
    data = out.astype(">u4").view(np.uint8)[: int(byte_bounds[-1])]
    marks = -(-per // STRIDE)
    mark_bounds = np.concatenate(([0], np.cumsum(marks)))
    place = np.repeat(bounds[:-1] - STRIDE * mark_bounds[:-1], marks) + STRIDE * np.arange(mark_bounds[-1])
    checkpoints = ends[:-1][place] - np.repeat(ends[bounds[:-1]], marks) if n else np.zeros(0, np.int64)
    return data, byte_bounds, checkpoints, mark_bounds


def decode(data: np.ndarray, at: np.ndarray, count: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The ids of stretches: stretch i has ``count[i]`` <= STRIDE ids from bit ``at[i]`` on.

    All stretches advance together, the longest first, by one id a step.
    """
    if not len(at):
        return np.zeros(0, np.uint32)
    order = np.argsort(-count, kind="stable")
    at, left = at[order].astype(np.int64), count[order]
    padded = np.concatenate([data, np.zeros(4, np.uint8)]).astype(np.uint32)
    window = (padded[:-2] << np.uint32(16)) | (padded[1:-1] << np.uint32(8)) | padded[2:]
    steps = int(left[0])
    out = np.zeros((steps, len(at)), np.uint32)
    live = len(at) - np.searchsorted(left[::-1], np.arange(steps), side="right")
    for step in range(steps):
        k = live[step]
        here = at[:k]
        entry = table[(window[here >> 3] >> (8 - (here & 7)).astype(np.uint32)) & np.uint32(0xFFFF)]
        out[step, :k] = entry >> np.uint32(5)
        here += (entry & np.uint32(31)).astype(np.int64)
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    flat = out.T[back]
    return flat[np.arange(steps) < count[:, None]]
