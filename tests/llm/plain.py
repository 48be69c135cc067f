"""Plain versions of the operators, for small data, and the awkward rows that every one must take."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

SF_DIR = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, row string, size string, _m int, copies string"

LONG = "word" * 3 + " " + " ".join(f"w{i % 977}x{i}" for i in range(30_000))


def awkward() -> list[tuple]:
    """Nulls in every column, empty and long texts, ties, repeated rows, columns that clash."""
    texts = ["", None, "   \n\t ", "one", "a b c d e", "a b c d e", LONG, "é ß 漢字 😀 x@y.org", "tie", "tie"]
    rows = [(i, t, "en", "s1", len(t or ""), "r", "z", 1, "q") for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, "a b c d e", None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return rows


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        value = int(c) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m[0])) <= 15),
]
SECRETS = [
    (
        "assign",
        r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: len(m[1]) >= 6,
    ),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
]


def spans(text: str | None, kinds, *, by_start: bool) -> list[tuple[str, int, int]]:
    found = [
        (m.start() if by_start else n, n if by_start else m.start(), kind, m.start(), m.end())
        for n, (kind, pattern, good) in enumerate(kinds)
        for m in re.finditer(pattern, text or "")
        if good(m)
    ]
    return [x[2:] for x in sorted(found)]


def listed(found) -> str:
    return ",".join(f"{kind}:{start}:{stop}" for kind, start, stop in found)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def crc(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def repeats(text: str | None, width: int = 5) -> int:
    w = words(text)
    seen = Counter(tuple(w[i : i + width]) for i in range(len(w) - width + 1))
    return len({j for i in range(len(w) - width + 1) if seen[tuple(w[i : i + width])] > 1 for j in range(i, i + width)})


def near_classes(texts: list[str | None], similar, sketch) -> list[int]:
    """Class of each text: the first of those connected by equality or similarity."""
    prints = [sketch(t) for t in texts]
    parent = list(range(len(texts)))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(set)
    for i, p in enumerate(prints):
        for value in set(p.tolist()):
            holders[value].add(i)
    pairs = {(i, j) for held in holders.values() for i in held for j in held if i < j}
    first: dict[str, int] = {}
    pairs |= {(first.setdefault(t or "", i), i) for i, t in enumerate(texts)}
    for i, j in sorted(pairs):
        if (texts[i] or "") == (texts[j] or "") or similar(prints[i], prints[j]):
            parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(texts))]


def check_packing(pieces: list, capacity: int) -> int:
    """Number of sequences, after checking that pieces fill them without gaps."""
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)
