"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

All DataFrame code. Patterns are matched by Java's regular expressions, which recurse once per
round of a repeated group and try a run of characters from each of its positions. Long runs would
overflow the stack or take quadratic time, so every pattern here is a sequence of single-character
classes: the text is first rewritten, without moving a character, so that what the group forbids
can no longer occur inside the class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import let, running

# Kinds in the order that settles equal starts. The first four are the base; the rest are added
# where checksum and context carry them.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]
# What a kind's pattern alone is worth, and which words nearby support it.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.7, "ssn": 0.3}
CONTEXT = {
    "email": r"\b(mail|e-?mail|contact|write to|courriel|correo)\b",
    "ip": r"\b(ip|address|host|server|login|adresse)\b",
    "card": r"\b(card|visa|mastercard|amex|credit|payment|karte|carte|tarjeta)\b",
    "phone": r"\b(phone|call|tel|mobile|fax|telefon)\b",
    "iban": r"\b(iban|bank|account|transfer|konto|compte|cuenta)\b",
    "ssn": r"\b(ssn|social security|social|security number)\b",
}
CONTEXT_CHARS = 40
CONTEXT_GAIN = 0.3
# Added spans below this score are not reported.
MIN_SCORE = 0.5

# Takes the place of a separator that a card number cannot hold.
_MARK = "\x01"
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def _spans(seen: Column, pattern: str, kind: str, valid) -> Column:
    """Leftmost matches of ``pattern`` that are ``valid``, as structs; positions in code points.

    The pieces between matches and the matches follow each other, so running totals of their
    lengths are the matches' ends.
    """

    def located(found: Column) -> Column:
        pieces = F.slice(F.split(seen, pattern, -1), F.lit(1), F.size(found))
        steps = F.zip_with(pieces, found, lambda p, m: (F.length(p) + F.length(m)).cast("bigint"))
        spans = F.zip_with(
            running(steps, "sum"),
            found,
            lambda end, m: F.struct(
                (end - F.length(m)).alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"), m.alias("value")
            ),
        )
        return F.filter(spans, lambda s: valid(s["value"]))

    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,value:string>>")
    return let(F.regexp_extract_all(seen, F.lit(pattern), F.lit(0)), lambda m: F.when(F.size(m) == 0, none).otherwise(located(m)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right counts double, less 9 where that has two digits."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: F.ascii(d) - 48)
    summed = F.aggregate(
        F.transform(values, lambda d, i: F.when(i % 2 == 0, d).when(d < 5, d * 2).otherwise(d * 2 - 9)),
        F.lit(0),
        lambda total, d: total + d,
    )
    return summed % 10 == 0


def _mod_97(value: Column) -> Column:
    """The first four characters go last, letters count from 10, and the remainder by 97 must be 1."""
    compact = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(compact, 5, 64), F.substring(compact, 1, 4))
    rest = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda acc, c: F.when(c.rlike("[0-9]"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97),
    )
    return F.when(F.length(compact).between(15, 34), rest == 1).otherwise(F.lit(False))


def _email(text: Column) -> Column:
    # A dot that no label follows becomes "_", which a local part may hold and a domain may not.
    # A match can begin inside a run of local characters only where the last match ended.
    seen = F.regexp_replace(text, r"\.(?![A-Za-z0-9-])", "_")
    pattern = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++"
    return _spans(seen, pattern, "email", lambda m: F.lit(True))


def _ip(text: Column) -> Column:
    return _spans(
        text, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "ip", lambda m: m.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    )


def _card(text: Column) -> Column:
    # Once separators that do not stand between two digits are marked, a maximal run is a match.
    seen = F.regexp_replace(text, "[ -](?![0-9])|(?<![0-9])[ -]", _MARK)

    def valid(m: Column) -> Column:
        return let(_digits(m), lambda d: F.when(F.length(d).between(12, 19), _luhn(d)).otherwise(F.lit(False)))

    return _spans(seen, "[0-9][0-9 -]++", "card", valid)


def _phone(text: Column) -> Column:
    return _spans(text, r"\+[0-9][ ().0-9-]+[0-9]", "phone", lambda m: F.length(_digits(m)).between(9, 15))


def _iban(text: Column) -> Column:
    pattern = r"\b[A-Z]{2}[0-9]{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})\b"
    return _spans(text, pattern, "iban", _mod_97)


def _ssn(text: Column) -> Column:
    return _spans(text, r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "ssn", lambda m: ~m.rlike("^(000|666|9..)|-00-|-0000$"))


def found_spans(text: Column, min_score: float = MIN_SCORE) -> Column:
    """All spans of a text by start, then kind: array of start, rank, end, value, score.

    Base kinds stay whatever their score; the others need ``min_score``. NULL: no spans.
    """
    whole = F.coalesce(text, F.lit(""))
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,value:string>>")

    def of(t: Column) -> Column:
        proposals = F.concat(
            F.when(F.contains(t, F.lit("@")), _email(t)).otherwise(none),
            F.when(
                t.rlike("[0-9]"),
                F.concat(_ip(t), _card(t), F.when(F.contains(t, F.lit("+")), _phone(t)).otherwise(none), _iban(t), _ssn(t)),
            ).otherwise(none),
        )

        def scored(s: Column) -> Column:
            before = F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0))
            around = F.substring(t, (before + 1).cast("int"), (s["end"] + CONTEXT_CHARS - before).cast("int"))
            # What stands on the two sides is not one phrase.
            left = F.substring(around, F.lit(1), (s["start"] - before).cast("int"))
            right = F.substring(around, (s["end"] - before + 1).cast("int"), F.lit(CONTEXT_CHARS))
            near = F.lower(F.concat(left, F.lit("|"), right))
            score = F.lit(0.0)
            for rank, kind in reversed(list(enumerate(KINDS))):
                supported = PRIOR[kind] + F.when(near.rlike(CONTEXT[kind]), CONTEXT_GAIN).otherwise(0.0)
                score = F.when(s["rank"] == rank, F.least(supported, F.lit(1.0))).otherwise(score)
            value = F.substring(around, (s["start"] - before + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
            return F.struct(s["start"], s["rank"], s["end"], value.alias("value"), score.alias("score"))

        every = F.array_sort(F.transform(proposals, scored))
        return F.filter(every, lambda s: (s["rank"] < len(BASE)) | (s["score"] >= min_score))

    return let(whole, of)


def _listed(spans: Column) -> Column:
    kinds = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ",")


def personal_data(documents: DataFrame, text: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """One row per document: ``doc_id`` and ``found``, its spans. NULL and empty texts have none."""
    return documents.select("doc_id", found_spans(F.col(text), min_score).alias("found"))


def span_digests(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the SHA-256 of the base spans, the list of all spans and their scores in its order."""
    base = F.filter("found", lambda s: s["rank"] < len(BASE))
    ranks = F.transform("found", lambda s: s["rank"])
    counts = [
        (F.size(ranks) - F.size(F.array_remove(ranks, rank))).cast("bigint").alias(f"n_{kind}") for rank, kind in enumerate(BASE)
    ]
    scores = F.transform("found", lambda s: F.round(s["score"], 2))
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("found")).alias("spans"), scores.alias("scores"))


def redacted(text: Column, min_score: float = MIN_SCORE) -> Column:
    """The text with each span, or run of overlapping spans, replaced by the kind of its first in brackets.

    NULL stays NULL, and a text without spans, as an empty one, stays as it is. Each row is judged by itself.
    """
    marks = F.array(*[F.lit(f"[{kind.upper()}]") for kind in KINDS])

    def cut(t: Column, spans: Column) -> Column:
        reached = running(F.transform(spans, lambda s: s["end"]), "max")

        def pieces(ends: Column) -> Column:
            def piece(s: Column, k: Column) -> Column:
                last = F.when(k == 0, F.lit(0).cast("bigint")).otherwise(F.get(ends, k - 1))
                kept = F.substring(t, (last + 1).cast("int"), (s["start"] - last).cast("int"))
                return F.when(s["start"] >= last, F.concat(kept, F.get(marks, s["rank"]))).otherwise("")

            tail = F.substring(t, (F.array_max(ends) + 1).cast("int"), F.length(t))
            return F.concat(F.array_join(F.transform(spans, piece), ""), tail)

        return let(reached, pieces)

    return F.when(
        text.isNotNull(),
        let(text, lambda t: let(found_spans(t, min_score), lambda s: F.when(F.size(s) == 0, t).otherwise(cut(t, s)))),
    )
