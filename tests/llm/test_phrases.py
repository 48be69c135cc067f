"""Phrases against a plain version with counters of all phrases, and against the SQL."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import plain
from crosswind.llm import phrases, queries


def plain_counts(rows) -> dict[str, Counter]:
    found: dict[str, Counter] = defaultdict(Counter)
    for language, text in rows:
        small = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", small):
            words = re.findall("[^ \t]+", piece)
            counts = found["und" if language is None else language]
            for k in range(1, 5):
                counts.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return found


def plain_phrases(rows, least: int, top: int) -> set[tuple]:
    result = set()
    for language, counts in plain_counts(rows).items():
        n = sum(f for phrase, f in counts.items() if len(phrase) == 1)
        wanted = {phrase: f for phrase, f in counts.items() if len(phrase) > 1 and f >= least}
        hidden = set()
        for longer, f in wanted.items():
            for k in range(2, len(longer)):
                for i in range(len(longer) - k + 1):
                    part = longer[i : i + k]
                    if 100 * f >= 80 * counts[part]:
                        hidden.add(part)
        scored = []
        for phrase, a in wanted.items():
            if phrase not in hidden:
                cuts = [(counts[phrase[:k]], counts[phrase[k:]]) for k in range(1, len(phrase))]
                score, _, l, r = min((2_000_000 * a // (l + r), k, l, r) for k, (l, r) in enumerate(cuts))
                scored.append((-score, -a, " ".join(phrase).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            result.add((language, rank, phrase.decode(), -a, l, r, n, -score))
    return result


def found(df) -> set[tuple]:
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(seed: int) -> list[tuple]:
    """Texts of few words, with a word, a pair and a passage that are very common, and odd blanks."""
    draw = random.Random(seed)
    words = [f"W{i}" for i in range(25)] + ["é", "É", "a\x1cb", "x\x85y", "漢字", "o\x00p"]
    rows = []
    for _ in range(300):
        text = []
        for _ in range(draw.randrange(12)):
            text += draw.choice([["the", draw.choice(words)], ["is", "one", draw.choice(words)], draw.choices(words, k=4), ["this", "very", "passage", "again"]])
            text.append(draw.choice(["", "", ".", "\n", "\t", " \x0b"]))
        rows.append((draw.choice(["en", "en", "de", None, ""]), " ".join(text)))
    return rows


@pytest.mark.parametrize("route, limit", [(1 << 17, 1 << 26), (40, 1 << 26), (7, 0)])
def test_phrases_are_those_of_all_counts(spark, route, limit):
    """With routes so small that words and pairs are hot, and with joins that shuffle."""
    rows = corpus(route)
    docs = spark.createDataFrame([(*row, 1, "p") for row in rows], "lang string, text string, n long, phrase string").repartition(5)
    back = phrases.collocations(docs, least=5, top=40, route=route, limit=limit)
    assert back.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert found(back) == plain_phrases(rows, 5, 40)


def test_shared_bits_do_not_change_counts(spark, monkeypatch):
    rows = corpus(3)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    monkeypatch.setattr(phrases, "word_bits", lambda words, condition: np.full(phrases.WORD_BITS // 64, -1))
    assert found(phrases.collocations(docs, least=4, route=60)) == plain_phrases(rows, 4, 2000)


def test_awkward_and_given_documents(spark):
    given = spark.read.parquet(f"{plain.SF_DIR}/documents.parquet")
    rows = spark.createDataFrame(plain.awkward(), plain.DOCUMENTS)
    docs = given.unionByName(rows, allowMissingColumns=True)
    back = found(phrases.collocations(docs, least=6))
    assert back == plain_phrases([(r["lang"], r["text"]) for r in docs.collect()], 6, 2000)


def test_given_documents_agree_with_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{plain.SF_DIR}/documents.parquet'")
    name = "op13_phrase_collocations"
    wanted = con.sql(queries.ORACLES[name])
    mine = queries.QUERIES[name](spark, plain.SF_DIR)
    assert sorted(mine.columns) == sorted(wanted.columns)
    assert found(mine.select(*wanted.columns)) == set(wanted.fetchall())


def test_no_documents(spark):
    assert phrases.collocations(spark.createDataFrame([], plain.DOCUMENTS)).collect() == []


def test_equal_suffixes_in_many_words():
    """Beyond 65,535 different words the numbers of a suffix no longer fit one key."""
    draw = np.random.default_rng(1)
    columns = [draw.integers(1, 90_000, 500) for _ in range(4)]
    columns = [np.append(c, c[:200]) for c in columns]
    kept, counts = phrases.together(columns)
    assert Counter(zip(*[c.tolist() for c in columns])) == dict(zip(zip(*[c.tolist() for c in kept]), counts.tolist()))


def test_scores_beyond_64_bits(spark):
    big = 1 << 61
    table = spark.createDataFrame([("en", "a b", 2, big - 1)], "lang string, phrase string, words int, n long")
    words = spark.createDataFrame([("en", "a", big), ("en", "b", big + 5)], "lang string, word string, n long")
    (row,) = phrases.lowest_cut(table, words, table, 1 << 26).collect()
    assert row["score"] == 2_000_000 * (big - 1) // (2 * big + 5)
