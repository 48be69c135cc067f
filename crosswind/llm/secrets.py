"""Secrets, with the parts of one credential linked, in DataFrame functions alone.

Some spans are secrets by their form: assignments to names like ``password``,
access key ids, long hexadecimal strings. Others are weak: a random-looking
string, a user name, an address may be anything. But an identifier, a secret and
an endpoint that stand close together make a credential. Every part found gets
its scope, the code points around it; an interval join of parts and scopes tells
which kinds of parts meet, and a weak candidate is reported only if those that
complete it are there.

Nulls: a null text is an empty one and holds nothing; null ids are kept. Rows
that repeat get the same spans. An empty table gives an empty one. Other columns
are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosswind.llm.spans import ROW, Pattern, matched, not_overlapping, placed, report
from crosswind.session import settle

KINDS = ["assign", "access", "hex"]
# Code points on both sides of a part that belong to its scope.
SCOPE = 256
# Least number of different characters of a string that may be random, by its alphabet.
VARIED = {"random": 10, "short_hex": 6}

# The patterns of certain spans; letters of the names in either case.
ASSIGN = (
    r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = "AKIA[A-Z0-9]+"
HEX = "(?<![0-9a-f])[0-9a-f]{24,}+"

PATTERNS = [
    Pattern("assign", "assign", ASSIGN, "[:=]", group=1),
    Pattern("access", "access", ACCESS, "AKIA"),
    Pattern("hex", "hex", HEX, "[0-9a-f]{24}"),
    Pattern(
        "random",
        "secret",
        r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[a-z0-9+/_-]*+[A-Z])(?=[A-Z0-9+/_-]*+[a-z])[A-Za-z0-9+/_-]{20,}+={0,2}(?![A-Za-z0-9+/_=-])",
        "[A-Za-z0-9+/_-]{20}",
    ),
    Pattern(
        "short_hex",
        "secret",
        r"(?<![A-Za-z0-9])(?=[0-9a-f]{0,22}[0-9])(?=[0-9a-f]{0,22}[a-f])[0-9a-f]{16,23}+(?![A-Za-z0-9])",
        "[0-9a-f]{16}",
    ),
    Pattern(
        "user",
        "identifier",
        r"""(?<![A-Za-z])(?i:user(?:_?name|_?id)?|login|account(?:_?(?:id|name))?|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._+-]{2,}+""",
        "[:=]",
    ),
    Pattern("key_id", "identifier", "(?<![A-Z0-9])(?:ASIA|AROA|AIDA)[A-Z0-9]{16}+(?![A-Z0-9])", "A[SRI][IOD]A[A-Z0-9]{16}"),
    Pattern(
        "address",
        "endpoint",
        r"""(?<![A-Za-z])(?:https?|ftp|jdbc:[a-z]{2,}+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s"'<>]{4,}+|(?<![A-Za-z])(?i:host(?:name)?|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{3,}+(?::[0-9]++)?""",
        "://|[:=]",
    ),
]
ROLES = {"assign": "secret", "access": "identifier", "hex": "secret"}
# What has to be in scope for a weak part of each role.
COMPLEMENTS = {"secret": ["identifier"], "identifier": ["secret"], "endpoint": ["identifier", "secret"]}


def certain() -> Column:
    """Whether a match is a secret by its form alone; null for the weak kinds."""
    name = F.col("name")
    return (
        F.when(name == "assign", F.length("inner") >= 6)
        .when(name == "access", F.length("match") >= 20)
        .when(name == "hex", F.length("match") >= 24)
    )


def in_scope_of(parts: DataFrame, others: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``parts`` whose scope one of the ``others`` reaches into: a semi-join on cells.

    Matches of one pattern do not overlap, so a cell holds a bounded number of
    them, and a text full of matches grows the join in proportion only.
    """
    cell = 2 * scope
    spread = F.sequence(F.floor((F.col("start") - scope) / cell), F.floor((F.col("stop") + scope) / cell))
    left = parts.withColumn("_part", F.struct(ROW, "name", "start")).withColumn("_cell", F.explode(spread))
    inside = F.sequence(F.floor(F.col("start") / cell), F.floor(F.col("stop") / cell))
    right = others.select(
        F.col(ROW).alias("_o_row"),
        F.col("start").alias("_o_start"),
        F.col("stop").alias("_o_stop"),
        F.explode(inside).alias("_o_cell"),
    )
    near = (
        (F.col(ROW) == F.col("_o_row"))
        & (F.col("_cell") == F.col("_o_cell"))
        & (F.col("_o_start") < F.col("stop") + scope)
        & (F.col("_o_stop") > F.col("start") - scope)
    )
    met = left.join(right, near, "left_semi").select("_part").distinct()
    keyed = parts.withColumn("_part", F.struct(ROW, "name", "start"))
    return keyed.join(met, "_part", "left_semi").drop("_part")


def find(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", scope: int = SCOPE) -> DataFrame:
    """``id, _row, n_<kind>…, base_sha256, spans, _spans`` of every document."""
    found = matched(docs, PATTERNS, id_column=id_column, text_column=text_column)
    different = F.size(F.array_distinct(F.split("match", "")))
    varied = different >= F.when(F.col("name") == "short_hex", VARIED["short_hex"]).otherwise(VARIED["random"])
    role = F.col("kind")
    for kind, name in ROLES.items():
        role = F.when(F.col("kind") == kind, name).otherwise(role)
    parts = (
        placed(found)
        .withColumns({"base": certain(), "role": role})
        .where(F.coalesce("base", (F.col("role") != "secret") | varied))
        .select(ROW, "name", "kind", "role", "start", "stop", "base")
    )
    parts = settle(parts, "parts")
    base = parts.where("base")
    weak = settle(not_overlapping(parts.where("base IS NULL"), base, [ROW]), "weak")
    usable = base.unionByName(weak)
    linked = []
    for name, needed in COMPLEMENTS.items():
        candidates = weak.where(F.col("role") == name)
        for other in needed:
            candidates = in_scope_of(candidates, usable.where(F.col("role") == other), scope)
        linked.append(candidates)
    extra = linked[0].unionByName(linked[1]).unionByName(linked[2])
    return report(found, base, extra, KINDS, by_start=True)
