"""The pipeline's stages against plain versions of what they decide."""

from __future__ import annotations

import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline  # noqa: E402
import plain  # noqa: E402
from crosswind.llm import quality, shingles  # noqa: E402
from crosswind.llm.tokens import default_tokenizer, word_ids  # noqa: E402
from crosswind.session import settle  # noqa: E402


def judged(docs: list) -> set[int]:
    """Ids that pass, with exact quantiles of each group, drawn towards its language's and those towards all."""
    measured = {d["doc_id"]: quality.measure((d["text"] or "").encode()) for d in docs}
    rate = lambda m: {"symbol_rate": m[2] / m[1], "dup_line_rate": m[4] / m[3], "word_length": m[1] / m[0]}
    rates = {i: rate(m) for i, m in measured.items() if m[0]}
    groups = defaultdict(list)
    for d in docs:
        if d["doc_id"] in rates:
            for key in ("all", d["lang"], (d["lang"], d["source"])):
                groups[key].append(rates[d["doc_id"]])

    def quantile(key, name, q):
        values = [r[name] for r in groups[key]]
        value, n = float(np.quantile(values, q, method="inverted_cdf")), len(values)
        wider = "all" if key != "all" and not isinstance(key, tuple) else key[0] if isinstance(key, tuple) else None
        if wider is None or (wider == "all" and name == "word_length"):
            return value
        return (value * n + quantile(wider, name, q) * quality.BORROWED_TEXTS) / (n + quality.BORROWED_TEXTS)

    kept = set()
    for d in docs:
        m = measured[d["doc_id"]]
        if m[0] < 10 or 100 * plain.repeats(d["text"]) > 20 * m[0]:
            continue
        inside = True
        for name, spread in quality.SPREADS.items():
            key = d["lang"], d["source"]
            low, middle, high = (quantile(key, name, q) for q in (0.25, 0.5, 0.75))
            if name == "word_length":
                spread = max(spread, 0.1 * middle)
            above = middle + quality.REACH * max(high - middle, spread)
            if name != "word_length":
                parts = [(quantile(k, name, 0.1), quantile(k, name, 0.25)) for k in (key, d["lang"])]
                above = min(above, max(b + quality.LOWER_REACH * max(b - a, spread) for a, b in parts))
            below = middle - quality.REACH * max(middle - low, spread)
            inside &= bool(round(below, 3) <= rates[d["doc_id"]][name] <= round(above, 3))
        if inside:
            kept.add(d["doc_id"])
    return kept


def test_every_stage(spark):
    docs = spark.read.parquet(f"{plain.SF_DIR}/documents.parquet")
    columns, steps = docs.columns, [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, plain.SF_DIR), name.replace(" ", "-"))
        steps.append(docs.collect())
        if name != "packing":
            assert docs.columns == columns
    given, good, distinct, masked, mixed, packed = steps

    assert {d["doc_id"] for d in good} == judged(given)
    assert set(good) <= set(given)

    sketch = lambda t: shingles.fingerprints(shingles.shingle_hashes((t or "").encode()))
    counts = np.zeros(shingles.COUNTERS, np.int64)
    for d in good:
        np.add.at(counts, shingles.counters(shingles.distinct(sketch(d["text"]))[0]), 1)
    idf = shingles.rarity(counts, len(good))
    similar = lambda a, b: max(shingles.jaccards(a.tobytes(), b.tobytes(), idf)) >= 0.8
    roots = plain.near_classes([d["text"] for d in good], similar, sketch)
    least = defaultdict(list)
    for d, root in zip(good, roots):
        least[root].append(d["doc_id"])
    assert Counter(d["doc_id"] for d in distinct) == Counter(min(ids) for ids in least.values())

    before = {d["doc_id"]: d for d in distinct}
    assert len(masked) == len(distinct)
    for d in masked:
        assert not plain.spans(d["text"], plain.PII, by_start=False)
        if not plain.spans(before[d["doc_id"]]["text"], plain.PII, by_start=False):
            assert d == before[d["doc_id"]]
        else:
            assert d["n_chars"] == len(d["text"]) and d["text"] != before[d["doc_id"]]["text"]

    assert set(mixed) <= set(masked)
    size, taken = Counter(), Counter()
    for d in masked:
        size[d["source"]] += len(plain.words(d["text"]))
    for d in mixed:
        taken[d["source"]] += len(plain.words(d["text"]))
    assert max(Counter(d["doc_id"] for d in mixed).values()) <= 3
    assert all(taken[s] <= 3 * size[s] for s in taken)

    words = word_ids(default_tokenizer())
    assert sum(p["length"] for p in packed) == sum(len(words.ids(d["text"].encode(), 1)) // 4 for d in mixed)
    assert plain.check_packing(packed, 4096) <= 1.1 * sum(p["length"] for p in packed) / 4096 + 1


def test_run_gives_the_same_twice(spark):
    once = corpus_pipeline.run(spark, plain.SF_DIR)
    places = ["sequence_id", "offset"]
    assert Counter(once.drop(*places).collect()) == Counter(corpus_pipeline.run(spark, plain.SF_DIR).drop(*places).collect())
