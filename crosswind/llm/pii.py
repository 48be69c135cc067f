"""Personal data by weak supervision, in DataFrame functions alone.

Patterns propose spans. Labelers vote on each: its shape, its check digits or
ranges, gazetteers, the words before it, its neighbours. How far a labeler can
be trusted is not set by hand: expectation-maximisation estimates it from the
votes of all spans, for each kind of data, and with it how likely each span is
personal data. On these likelihoods a final classifier is trained, over features
of the span itself, and it decides which spans are added to the certain ones.

Only counts reach the driver: of vote patterns and of feature values, whose
number is fixed by the labelers and features, whatever the data.

Nulls: a null text is an empty one and holds nothing; null ids are kept. Rows
that repeat get the same spans. An empty table gives an empty one. Other columns
are not looked at by ``find`` and pass untouched through ``masked_documents``.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crosswind.llm.common import lookup, row_key, small_table
from crosswind.llm.spans import ROW, Pattern, matched, not_overlapping, placed, report
from crosswind.operators.joins import fits_broadcast
from crosswind.session import settle

KINDS = ["email", "ip", "card", "phone"]

# The patterns of certain spans. Possessive, and bound to where a
# run of their characters begins, so that long runs cost no more than their length.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

# Gazetteers.
GIVEN_NAMES = [
    "Alexander", "Andrea", "Anthony", "Barbara", "Benjamin", "Brigitte", "Carlos", "Caroline", "Catherine", "Charles",
    "Charlotte", "Christian", "Christine", "Daniel", "David", "Dorothy", "Eduardo", "Elizabeth", "Emily", "Fernando",
    "Florian", "Francisco", "Friedrich", "Gabriel", "George", "Heinrich", "Isabelle", "Jacques", "James", "Javier",
    "Jennifer", "Jessica", "Johannes", "Jonathan", "Joseph", "Katharina", "Kevin", "Laurent", "Linda", "Lucas",
    "Manuel", "Margaret", "Maria", "Matthew", "Michael", "Michelle", "Nathalie", "Nicolas", "Patricia", "Philippe",
    "Rachel", "Richard", "Robert", "Samuel", "Sandra", "Sebastian", "Sophie", "Stephanie", "Susan", "Thomas",
    "Victoria", "Vincent", "William", "Wolfgang",
]
TITLES = ["Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Mme", "Monsieur", "Madame", "Senor", "Señor", "Señora"]
TOP_DOMAINS = [
    "at", "be", "biz", "br", "ca", "ch", "cn", "com", "de", "dk", "edu", "es", "eu", "fi", "fr", "gov", "ie", "in", "info",
    "int", "io", "it", "jp", "mil", "mx", "net", "nl", "no", "org", "pl", "pt", "ru", "se", "uk", "us",
]
# A family name with all of its parts: Smith, McDonald, O'Neil, Smith-Jones.
NAME_PART = r"(?:\p{Lu}['\u2019])?\p{Lu}\p{Ll}++(?:\p{Lu}\p{Ll}++)*+"
FAMILY_NAME = rf"{NAME_PART}(?:-{NAME_PART})*+"
SPEAKS_FOR = {
    "email": "e-?mail|contact|write|reply|kontakt|courriel|correo",
    "ip": r"ip|address|host|login|logged|client",
    "card": "card|visa|mastercard|amex|credit|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|cell|fax|whatsapp|telefon|téléphone|teléfono|handy",
    "ssn": "ssn|social security|tax id",
    "iban": "iban|account|konto|compte|cuenta",
    "person": "name|contact|dear|regards|patient|author|signed|by",
}
SPEAKS_AGAINST = r"version|release|order|invoice|isbn|issn|part no|serial|ticket|build|ref|chapter|section|figure|table|id"

PATTERNS = [
    Pattern("email", "email", EMAIL, "@"),
    Pattern("ip", "ip", IP, r"[0-9]\.[0-9]"),
    Pattern("card", "card", CARD, "[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]"),
    Pattern("phone", "phone", PHONE, r"\+[0-9]"),
    Pattern(
        "email_spelt",
        "email",
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(] ?(?:at|AT) ?[\])] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(] ?(?:dot|DOT) ?[\])]) ?[A-Za-z0-9-]++)++",
        r"[\[(] ?(?:at|AT) ?[\])]",
    ),
    Pattern(
        "phone_local",
        "phone",
        r"(?<![0-9+(.-])(?<!\+[0-9]{1,3} )\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
        "[0-9]{3}[ .-][0-9]{4}",
    ),
    Pattern("card_unchecked", "card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])", "[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]"),
    Pattern("ssn", "ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]{3}-[0-9]{2}-"),
    Pattern(
        "iban",
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        "[A-Z]{2}[0-9]{2}",
    ),
    Pattern(
        "person",
        "person",
        rf"(?<!\p{{L}})(?:(?:{'|'.join(TITLES)})\.? )?(?:{'|'.join(GIVEN_NAMES)}) {FAMILY_NAME}(?!\p{{L}})"
        rf"|(?<!\p{{L}})(?:{'|'.join(TITLES)})\.? {FAMILY_NAME}(?!\p{{L}})",
        rf"(?:{'|'.join(GIVEN_NAMES + TITLES)})\.? \p{{Lu}}",
    ),
]

LABELERS = ["shape", "check", "gazetteer", "words", "neighbours"]
FEATURES = ["size", "digits", "parting", "letters", "left", "right"]
ROUNDS = 30
# A span is added when classifier and votes both make it at least this likely.
SURE = 0.9
# What every count starts from, so that nothing is ruled out by never having been seen.
SMOOTH = 0.5
# Measured size up to which spans are broadcast to the texts.
SPANS_BYTES = 16 * 1024 * 1024


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column, longest: int = 19) -> Column:
    """Whether the digits satisfy the check; every second from the right counts double."""
    turned = F.reverse(digits(value))
    total = F.lit(0)
    for i in range(1, longest + 1):
        digit = F.coalesce(F.substring(turned, i, 1).try_cast("int"), F.lit(0))
        total = total + (digit if i % 2 else digit * 2 - F.when(digit > 4, 9).otherwise(0))
    return total % 10 == 0


def iban_valid(value: Column) -> Column:
    """Whether the account number, country and check digits last, leaves 1 modulo 97."""
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    code = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    step = lambda r, c: (r * F.when(code(c) > 9, 100).otherwise(10) + code(c)) % 97
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda r, c: F.when(c == "", r).otherwise(step(r, c))) == 1


def certain(name: str = "name", match: str = "match") -> Column:
    """Whether a proposed span is one of the certain ones."""
    kind, value = F.col(name), F.col(match)
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
        .when(kind == "card", luhn(value))
        .when(kind == "phone", F.length(digits(value)).between(8, 15))
        .otherwise(False)
    )


def vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0).cast("int")


def with_votes(spans: DataFrame) -> DataFrame:
    """Votes of all labelers, 1 for, -1 against, 0 for none."""
    kind, value = F.col("kind"), F.col("match")
    before, after = F.lower("before"), F.col("after")
    checked = (
        F.when(kind == "card", luhn(value))
        .when(kind == "iban", iban_valid(value))
        .when(kind == "ssn", ~value.rlike("^(000|666|9..)") & ~value.rlike("-00-") & ~value.rlike("-0000$"))
        .when(kind == "ip", value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
        .when(kind == "phone", F.length(digits(value)).between(8, 15))
    )
    last = F.lower(F.regexp_extract(value, r"([A-Za-z]+)$", 1))
    first = F.regexp_extract(value, r"^(?:\p{L}+\.? )?(\p{L}+) ", 1)
    listed = (
        F.when(kind == "email", last.isin(TOP_DOMAINS))
        .when(kind == "person", first.isin(GIVEN_NAMES))
        .when(kind == "phone", F.when(value.rlike(r"(^|[^0-9])555[^0-9]"), None).otherwise(value.rlike(r"^\+[1-9]|^\(?[2-9]")))
    )
    spoken = F.lit(False)
    for name, words in SPEAKS_FOR.items():
        spoken = spoken | ((kind == name) & before.rlike(rf"(?<!\p{{L}})(?:{words})s?(?!\p{{L}})[^\n]{{0,24}}$"))
    against = before.rlike(rf"(?<!\p{{L}})(?:{SPEAKS_AGAINST})(?!\p{{L}})[ .:#-]{{0,4}}$")
    torn = before.rlike(r"[\p{L}\p{N}_/=#-]$") | after.rlike(r"^[\p{L}\p{N}_/=-]")
    alone = (before.rlike(r"(^|[\s(:;,\"'<])$")) & (after.rlike(r"^($|[\s),;.:!?\"'>])"))
    true = F.lit(True)
    votes = {
        "shape": vote(F.col("base"), ~F.col("base") & (F.col("name") == kind)),
        "check": vote(F.coalesce(checked, ~true), ~F.coalesce(checked, true)),
        "gazetteer": vote(F.coalesce(listed, ~true), ~F.coalesce(listed, true)),
        "words": vote(spoken, against & ~spoken),
        "neighbours": vote(alone & ~torn, torn),
    }
    return spans.withColumns(votes)


def with_features(spans: DataFrame) -> DataFrame:
    """What the classifier sees of a span: few values each, none of them a labeler's vote."""
    value = F.col("match")
    share = F.length(digits(value)) * 4 / F.length(value)
    shape = lambda c: F.when(c == "", "edge").when(c.rlike(r"\s"), "blank").when(c.rlike(r"[\p{L}\p{N}]"), "word").otherwise("sign")
    return spans.withColumns(
        {
            "size": F.least(F.floor(F.length(value) / 4), F.lit(12)).cast("string"),
            "digits": F.floor(share).cast("string"),
            "parting": F.array_join(F.array_sort(F.array_distinct(F.split(F.regexp_replace(value, r"[^ .@()+-]", ""), ""))), ""),
            "letters": F.when(value.rlike(r"^\p{Lu}"), "upper").when(value.rlike(r"^\p{Ll}"), "lower").otherwise("none"),
            "left": shape(F.right("before", F.lit(1))),
            "right": shape(F.left("after", F.lit(1))),
        }
    )


def reliabilities(patterns: list[tuple[str, tuple[int, ...], int]]) -> dict[tuple[str, tuple[int, ...]], float]:
    """Likelihood of each kind's vote pattern, by expectation-maximisation.

    ``patterns`` are ``(kind, votes, number of spans)``. Every labeler has, for
    true spans and for others, its own chances of each vote. The first guess is
    the majority; labelers that contradict what the others agree on lose weight.
    """
    likely = {}
    kinds = defaultdict(list)
    for kind, votes, n in patterns:
        kinds[kind].append((votes, n))
    for kind, rows in kinds.items():
        post = [1 / (1 + math.exp(-sum(votes))) for votes, _ in rows]
        for _ in range(ROUNDS):
            # The fixed start of the counts says that votes mean what they say.
            chance = [[{v: SMOOTH * (1 + (v == side)) for v in (-1, 0, 1)} for _ in LABELERS] for side in (1, -1)]
            weight = [1.0, 1.0]
            for (votes, n), p in zip(rows, post):
                for side, share in enumerate((p, 1 - p)):
                    weight[side] += n * share
                    for labeler, v in enumerate(votes):
                        chance[side][labeler][v] += n * share
            log = [
                [{v: math.log(c / sum(table.values())) for v, c in table.items()} for table in side]
                for side in chance
            ]
            post = []
            for votes, _ in rows:
                odds = math.log(weight[0] / weight[1])
                odds += sum(log[0][i][v] - log[1][i][v] for i, v in enumerate(votes))
                post.append(1 / (1 + math.exp(-max(-40.0, min(40.0, odds)))))
        likely |= {(kind, votes): p for (votes, _), p in zip(rows, post)}
    return likely


def classified(spans: DataFrame) -> DataFrame:
    """Spans with ``likely``, by votes, and ``score``, by the trained classifier.

    The classifier is naive Bayes over the features, trained on the likelihoods
    instead of labels; its counts are two sums per feature value.
    """
    spark = spans.sparkSession
    voted = spans.groupBy("kind", *LABELERS).agg(F.count(F.lit(1)).alias("n")).collect()
    likely = reliabilities([(r["kind"], tuple(r[name] for name in LABELERS), r["n"]) for r in voted])
    table = small_table(
        spark,
        [(kind, *votes, p) for (kind, votes), p in likely.items()],
        ", ".join(["kind string", *[f"{name} int" for name in LABELERS], "likely double"]),
    )
    known = lookup(spans, table, ["kind", *LABELERS], rows=len(likely))
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in FEATURES])
    sums = (
        known.select("kind", "likely", F.inline(pairs))
        .groupBy("kind", "feature", "value")
        .agg(F.sum("likely").alias("yes"), F.sum(1 - F.col("likely")).alias("no"))
        .collect()
    )
    whole = defaultdict(lambda: [1.0, 1.0])
    values = defaultdict(int)
    for r in sums:
        values[r["kind"], r["feature"]] += 1
        if r["feature"] == FEATURES[0]:
            whole[r["kind"]][0] += r["yes"]
            whole[r["kind"]][1] += r["no"]
    weights = []
    for r in sums:
        yes, no = whole[r["kind"]]
        room = SMOOTH * values[r["kind"], r["feature"]]
        odds = math.log((r["yes"] + SMOOTH) / (yes + room)) - math.log((r["no"] + SMOOTH) / (no + room))
        weights.append((r["kind"], r["feature"], r["value"], odds))
    score = F.lit(0.0)
    for feature in FEATURES:
        rows = [(k, v, odds) for k, f, v, odds in weights if f == feature]
        part = small_table(spark, rows, f"kind string, {feature} string, _w_{feature} double")
        known = lookup(known, part, ["kind", feature], rows=len(rows))
        score = score + F.coalesce(f"_w_{feature}", F.lit(0.0))
    prior = [(k, math.log(yes / no)) for k, (yes, no) in whole.items()]
    known = lookup(known, small_table(spark, prior, "kind string, _prior double"), ["kind"], rows=len(prior))
    return known.withColumn("score", 1 / (1 + F.exp(-(F.col("_prior") + score)))).drop(
        "_prior", *[f"_w_{f}" for f in FEATURES]
    )


def find(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, _row, n_<kind>…, base_sha256, spans, _spans`` of every document."""
    found = matched(docs, PATTERNS, id_column=id_column, text_column=text_column)
    proposed = settle(with_features(with_votes(placed(found).withColumn("base", certain()))), "proposed")
    scored = classified(proposed)
    base = proposed.where("base")
    sure = scored.where(~F.col("base") & (F.col("likely") >= SURE) & (F.col("score") >= SURE))
    extra = not_overlapping(sure.select(ROW, "kind", "start", "stop"), base, [ROW]).dropDuplicates()
    return report(found, base, extra, KINDS, by_start=False)


def apart(spans: DataFrame) -> DataFrame:
    """``_row`` and its spans in order, each with ``after``, where the ones before it end.

    Spans inside others are left out.
    """
    before = Window.partitionBy(ROW).orderBy("start", F.desc("stop"), "kind")
    so_far = F.max("stop").over(before.rowsBetween(Window.unboundedPreceding, -1))
    each = spans.withColumn("after", F.coalesce(so_far, F.lit(0))).where(F.col("stop") > F.col("after"))
    return each.groupBy(ROW).agg(
        F.array_sort(F.collect_list(F.struct("start", "stop", "kind", "after"))).alias("_spans")
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; ``spans`` as ``apart`` gives them."""
    cut = lambda start, stop: F.substring(text, (start + 1).cast("int"), F.greatest(stop - start, F.lit(0)).cast("int"))
    parts = F.transform(
        spans, lambda s: F.concat(cut(s["after"], s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
    )
    end = F.element_at(spans, -1)["stop"]
    return F.concat(F.array_join(parts, ""), F.substring(text, (end + 1).cast("int"), F.length(text)))


def masked_documents(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked and ``n_chars``, if there is one, counted anew."""
    found = find(docs).where(F.size("_spans") > 0).dropDuplicates([ROW])
    spans = settle(apart(found.select(ROW, F.inline("_spans"))), "spans")
    # Few texts hold any; while their spans are measured to be small, no text has to move.
    spans = F.broadcast(spans) if fits_broadcast(spans, SPANS_BYTES) else spans.hint("merge")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(whole, F.col("doc_id").alias("id"), text.alias("text")).select(
        "_doc", "text", row_key("id", "text").alias(ROW)
    )
    met = keyed.join(spans, ROW, "left")
    clean = F.when(F.col("_spans").isNull(), F.col("_doc.text")).otherwise(masked(F.col("text"), F.col("_spans")))
    fresh = met.select("_doc", clean.alias("_clean"))
    new = {"text": F.col("_clean")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = ~F.col("_clean").eqNullSafe(F.col("_doc.text"))
        new["n_chars"] = F.when(changed, F.length("_clean").cast(kind)).otherwise(F.col("_doc.n_chars"))
    return fresh.select(*[new[c].alias(c) if c in new else F.col(f"_doc.`{c}`") for c in docs.columns])
