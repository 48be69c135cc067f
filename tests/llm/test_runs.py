"""Runs of words against a plain version that tries every period at every place."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

import plain
from crosswind.llm import queries, runs


def slow_lyndon(text: list[int]) -> list[int]:
    """By the definition: the next place whose suffix is smaller ends the word."""
    n = len(text)
    return [next((j for j in range(i + 1, n) if text[j:] < text[i:]), n) - i for i in range(n)]


def slow_runs(words: list, least: int) -> list[tuple[int, int, int]]:
    """Maximal stretches for every period, those of a smaller period of their own left out."""
    found, n, codes = [], len(words), {}
    numbers = np.array([codes.setdefault(w, len(codes)) for w in words])
    for p in range(1, n // 2 + 1):
        if not (numbers[p:] == numbers[:-p]).any():
            continue
        i = 0
        while i < n - p:
            end = i
            while end < n - p and words[end] == words[end + p]:
                end += 1
            if end - i >= max(p, least - p):
                stretch = words[i : end + p]
                if not any(stretch[q:] == stretch[:-q] for q in range(1, p)):
                    found.append((i, end + p - i, p))
            i = max(end, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def texts(draw: random.Random, n: int) -> list[int]:
    """Words of few kinds, plain, Fibonacci-like and with planted periods."""
    kind = draw.randrange(4)
    if kind == 0:
        return [draw.randrange(draw.choice([1, 2, 3, 5])) for _ in range(n)]
    if kind == 1:
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    text = [draw.randrange(40) for _ in range(n)]
    for _ in range(3):
        p, at = draw.randrange(1, 12), draw.randrange(n)
        for i in range(at + p, min(n, at + draw.randrange(2, 60))):
            text[i] = text[i - p]
    return text


@pytest.mark.parametrize("seed", range(60))
def test_lyndon_arrays_of_both_orders(seed):
    draw = random.Random(seed)
    text = texts(draw, draw.randrange(1, 120))
    assert runs.lyndon_lengths(text) == slow_lyndon(text)
    turned = [-x for x in text]
    assert runs.lyndon_lengths(turned) == slow_lyndon(turned)


@pytest.mark.parametrize("seed", range(60))
@pytest.mark.parametrize("least", [2, 7, 12])
def test_runs_are_those_of_every_period(seed, least):
    draw = random.Random(seed)
    text = texts(draw, draw.randrange(1, 150))
    assert runs.runs_of(np.array(text), least) == slow_runs(text, least)


@pytest.mark.parametrize("seed", range(30))
@pytest.mark.parametrize("least", [5, 12])
def test_stretches_lose_no_run(seed, least):
    """Several texts at a time, neighbours that go on where the text before them ended."""
    draw = random.Random(seed)
    given = [texts(draw, draw.randrange(1, 150)) for _ in range(6)] + [[1, 2] * 10, [1, 2] * 10, []]
    joined = [b" ".join(b"%d" % abs(x) for x in text) for text in given]
    worded, found = runs.runs_of_texts(joined, least)
    assert [w for w in worded] == [t.split() for t in joined]
    assert found == [slow_runs(w, least) for w in worded]


def test_long_periods_and_one_word_for_ever():
    block = list(range(30_000))
    assert runs.runs_of(np.array(block * 3), 12) == [(0, 90_000, 30_000)]
    assert runs.runs_of(np.zeros(200_000), 12) == [(0, 200_000, 1)]


def planted(doc_id, text) -> list[bytes]:
    words = plain.words(text)
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def contract(doc_id, text, found) -> tuple:
    words = planted(doc_id, text)
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    drop = {i for s, length, p in found for i in range(s + p, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
    listed = "".join(f"{s},{length},{p}\n" for s, length, p in found)
    milli = best[1] and 1000 * best[1] // best[2]
    return (doc_id, len(found), *best, milli, plain.sha(listed), hashlib.sha256(kept).hexdigest())


def test_given_and_awkward_documents(spark, monkeypatch):
    given = spark.read.parquet(f"{plain.SF_DIR}/documents.parquet")
    rows = spark.createDataFrame(plain.awkward(), plain.DOCUMENTS)
    docs = given.where("length(text) < 6000").unionByName(rows, allowMissingColumns=True)
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    back = [tuple(r) for r in queries.op12_periodic_runs(spark, "").collect()]
    expected = [
        contract(r["doc_id"], r["text"], slow_runs(planted(r["doc_id"], r["text"]), 12)) for r in docs.collect()
    ]
    assert sorted(back, key=str) == sorted(expected, key=str)
    assert sum(row[1] for row in back) > 20


def test_no_documents(spark):
    assert runs.periodic_runs(spark.createDataFrame([], plain.DOCUMENTS)).collect() == []
