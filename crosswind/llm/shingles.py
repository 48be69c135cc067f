"""Weighted shingles of texts and their consistent weighted samples, in numpy."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import xxhash

WIDTH = 5
# Counters of the sketch that holds document frequencies.
COUNTERS = 1 << 21
# How much more a shingle seen once weighs than one seen everywhere.
RARE = 0.25
BANDS, ROWS = 16, 4
SAMPLES = BANDS * ROWS
# Shingles worked on at a time, so that they stay in the processor's cache.
CHUNK = 1 << 16

U64 = np.uint64
GOLDEN = U64(0x9E3779B97F4A7C15)
# Values that a random number of Gamma(2, 1) may take, evenly likely.
LEVELS = 4096


def scrambled(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix whose every output bit depends on every input bit."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def gamma_levels() -> np.ndarray:
    """Quantiles of Gamma(2, 1), whose distribution function is 1 - (1 + x) exp(-x)."""
    x = np.linspace(0.0, 40.0, 400_001)
    return np.interp((np.arange(LEVELS) + 0.5) / LEVELS, 1 - (1 + x) * np.exp(-x), x)


GAMMA = gamma_levels()
R, R_INVERSE, LOG_C = (t.astype(np.float32) for t in (GAMMA, 1 / GAMMA, np.log(GAMMA)))
MULTIPLIERS = scrambled(np.arange(1, SAMPLES + 1, dtype=U64) * GOLDEN) | U64(1)


def digest(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()[:32]


def shingle_hashes(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Sorted hashes of all runs of ``width`` words, repeats included.

    A shorter text is one run; a text without words has none. Blanks, tabs and
    line breaks of ASCII part words.
    """
    words = text.split()
    if not words:
        return np.empty(0, U64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))
    count = max(1, len(words) - width + 1)
    runs = np.zeros(count, U64)
    for i in range(min(width, len(words))):
        runs = runs * GOLDEN + hashes[i : i + count]
    runs = scrambled(runs)
    runs.sort()
    return runs


def distinct(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array and how often each occurs."""
    starts = np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]][: len(sorted_values)])
    return sorted_values[starts], np.diff(np.r_[starts, len(sorted_values)])


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    """The upper half of hashes, which stands for a shingle from here on; keeps their order."""
    return (hashes >> U64(32)).astype(np.uint32)


def counters(prints: np.ndarray) -> np.ndarray:
    return prints & np.uint32(COUNTERS - 1)


def rarity(counts: np.ndarray, documents: int) -> np.ndarray:
    """Inverse document frequency of each counter's shingles, from 1 to 1 + ``RARE``.

    A counter is shared by many shingles that occur once or so; what it holds on
    average is taken off, which leaves a frequent shingle's own count.
    """
    total = float(counts.sum())
    own = np.maximum(counts - total / COUNTERS, 1.0)
    scale = np.log(max(documents, 2))
    return (1 + RARE * np.clip(np.log(max(documents, 2) / own) / scale, 0, 1)).astype(np.float32)


def samples(prints: list[np.ndarray], times: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    """``SAMPLES`` consistent weighted samples of each text, as 32-bit numbers.

    For a shingle of weight w and random r, c of Gamma(2, 1) and b of [0, 1):
    t = floor(ln w / r + b) and ln a = ln c - r (t - b + 1); the sample is the
    shingle of least a, with its t. Two texts agree in a sample with the chance
    of their weighted Jaccard similarity.
    """
    flat = np.concatenate(prints)
    log_weight = np.log(np.concatenate(times) * idf[counters(flat)]).astype(np.float32)
    starts = np.cumsum([0, *[len(p) for p in prints[:-1]]])
    seed = scrambled(flat.astype(U64) + GOLDEN)
    out = np.empty((len(prints), SAMPLES), np.uint32)
    for k, multiplier in enumerate(MULTIPLIERS):
        z = seed * multiplier
        z ^= z >> U64(32)
        first = (z & U64(LEVELS - 1)).astype(np.intp)
        second = ((z >> U64(12)) & U64(LEVELS - 1)).astype(np.intp)
        b = (z >> U64(40)).astype(np.float32)
        b *= np.float32(2**-24)
        r = R[first]
        t = log_weight * R_INVERSE[first]
        t += b
        np.floor(t, out=t)
        name = t.astype(np.int32).view(np.uint32) * np.uint32(0x9E3779B1) ^ flat
        t -= b
        t += np.float32(1)
        t *= r
        # Shifted to be above zero, where floats order like their bits.
        a = LOG_C[second] - t
        a += np.float32(128)
        key = a.view(np.uint32).astype(U64) << U64(32) | name
        out[:, k] = np.minimum.reduceat(key, starts).astype(np.uint32)
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One number per band, from the samples in it and the band's place."""
    keys = np.zeros((len(signatures), BANDS), U64)
    for row in range(ROWS):
        keys = scrambled(keys * GOLDEN + signatures[:, row::ROWS].astype(U64))
    return (keys + np.arange(BANDS, dtype=U64)).view(np.int64)


def chunks(items: list, size) -> Iterator[list]:
    """Items in turn, as many at a time as stay under ``CHUNK`` together."""
    taken, total = [], 0
    for item in items:
        taken.append(item)
        total += size(item)
        if total >= CHUNK:
            yield taken
            taken, total = [], 0
    if taken:
        yield taken


def jaccards(left: bytes, right: bytes, idf: np.ndarray) -> tuple[float, float]:
    """Weighted and plain Jaccard similarity of two texts, which come as sorted fingerprints.

    Weighted: the sum of lesser over the sum of greater weights. Plain: shared
    over all distinct shingles.
    """
    a, n = distinct(np.frombuffer(left, "<u4"))
    b, m = distinct(np.frombuffer(right, "<u4"))
    if not len(a) or not len(b):
        return 0.0, 0.0
    shared, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    less = float((np.minimum(n[i], m[j]) * idf[counters(shared)].astype(float)).sum())
    whole = float((n * idf[counters(a)].astype(float)).sum() + (m * idf[counters(b)].astype(float)).sum())
    return less / (whole - less), len(shared) / (len(a) + len(b) - len(shared))


def linked(left: list[tuple[int, int, bytes]], right: list[tuple[int, int, bytes]], idf: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Of texts ``(rid, root, prints)``, pairs that are similar and differ in ``root``, one for each left text and right root.

    Every left text is measured against all right ones at once, over an index of
    the right ones' shingles; ``jaccards`` has the last word.
    """
    each = [distinct(np.frombuffer(prints, "<u4")) for *_, prints in right]
    owner = np.repeat(np.arange(len(right)), [len(a) for a, _ in each])
    flat, times = (np.concatenate(part) for part in zip(*each))
    size = np.array([len(a) for a, _ in each])
    weight = np.bincount(owner, times * idf[counters(flat)].astype(float), minlength=len(right))
    order = np.argsort(flat, kind="stable")
    flat, owner, times = flat[order], owner[order], times[order]
    roots = np.array([root for _, root, _ in right])
    found = []
    for rid, root, prints in left:
        a, n = distinct(np.frombuffer(prints, "<u4"))
        own = idf[counters(a)].astype(float)
        low = np.searchsorted(flat, a, "left")
        held = np.searchsorted(flat, a, "right") - low
        which = np.repeat(np.arange(len(a)), held)
        at = np.arange(len(which)) + np.repeat(low - np.r_[0, np.cumsum(held)[:-1]][: len(a)], held)
        less = np.bincount(owner[at], np.minimum(n[which], times[at]) * own[which], minlength=len(right))
        shared = np.bincount(owner[at], minlength=len(right))
        whole = float((n * own).sum()) + weight - less
        likely = (less >= (least - 1e-6) * whole) | (shared >= (least - 1e-6) * (len(a) + size - shared))
        met = set()
        for i in np.flatnonzero(likely & (roots != root)).tolist():
            if right[i][1] not in met and max(jaccards(prints, right[i][2], idf)) >= least:
                met.add(right[i][1])
                found.append((rid, right[i][0]))
    return found
