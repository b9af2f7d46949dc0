"""Personal data against the contract's patterns, run by Python."""

import hashlib
import re

from pyspark.sql import functions as F

from llm_rows import awkward, no_documents  # noqa: F401
from millrace.llm.personal_data import personal_data, redacted, span_digests
from millrace.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (d * 2 if d < 5 else d * 2 - 9)
    return total % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    spans = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        spans += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text or "") if valid(kind, m.group())]
    spans.sort()
    return [sum(s[3] == kind for s in spans) for kind in PATTERNS], ",".join(f"{k}:{a}:{e}" for a, _, e, k in spans)


HOSTILE = [
    "a@b.com_x@y.org and q@r..s.t, u..v@w.x. z@y@b.com foo@bar_baz@q.com a.@b.co.@c.org .x@-y.z",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.255.255 1.2.3 9.9.9.9",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 1111 1111 378282246310005- 4111111111111112",
    "call +1 (743) 555-3824 or +49.30.1234567. +1 2 +123456789012345678 +1+2 3456789012 x",
    "été à 4111111111111111 😀 a@b.com 😀 +33 1 23 45 67 89",
    "5 " * 5_000 + "1" * 20_000 + " a" + ".b" * 20_000 + "@c" + ".d" * 20_000 + " " + "7." * 9_000,
    "x@y.zz " * 3_000,
]


def check(rows, out):
    for doc_id, text in rows:
        counts, listed = base(text)
        got = out[doc_id]
        assert [got["n_email"], got["n_ip"], got["n_card"], got["n_phone"]] == counts, (doc_id, counts)
        assert got["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(got["spans"].split(","))


def test_query_equals_brute_force(spark):
    out = {r["doc_id"]: r for r in LLM_QUERIES["op7_personal_data"](spark, SF).collect()}
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert len(rows) == len(out) and any(r["spans"] for r in out.values())
    check(rows, out)


def test_hostile_texts(spark):
    rows = list(enumerate(HOSTILE))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(rows, {r["doc_id"]: r for r in span_digests(personal_data(df)).collect()})


def test_added_kinds_need_checksum_or_context(spark):
    rows = [
        (0, "pay to bank account GB29 NWBK 6016 1331 9268 19 today"),
        (1, "pay to GB29 NWBK 6016 1331 9268 18 today"),
        (2, "my ssn is 123-45-6789."),
        (3, "part 123-45-6789."),
        (4, "DE89370400440532013000"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in span_digests(personal_data(df)).collect()}
    assert "iban:20:47" in got[0] and "ssn:10:21" in got[2] and "iban:0:22" in got[4]
    assert "iban" not in got[1] and "ssn" not in got[3]


def test_redaction(spark):
    rows = [("mail a@b.com, card 4111 1111 1111 1111.",), (None,), ("",), ("+1.2.3.4.56.78.9 end",), ("nothing",)]
    out = [r[0] for r in spark.createDataFrame(rows, "t string").select(redacted(F.col("t"))).collect()]
    assert out == ["mail [EMAIL], card [CARD].", None, "", "[PHONE] end", "nothing"]


def test_awkward_rows(awkward, no_documents):
    rows = awkward.select("doc_id", "text").collect()
    out = span_digests(personal_data(awkward)).collect()
    assert len(out) == len(rows) and all(r["spans"] == "" for r in out)
    assert {r["base_sha256"] for r in out} == {hashlib.sha256(b"").hexdigest()}
    assert span_digests(personal_data(no_documents)).count() == 0


def test_context_on_both_sides_and_scores(spark):
    far = "x" * 41
    rows = [
        (0, "123-45-6789 (SSN)"),
        (1, f"123-45-6789 {far} ssn"),
        (2, "so 123-45-6789 cial security"),
        (3, "😀 mail a@b.com"),
        (4, "a@b.com"),
        (5, None),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in span_digests(personal_data(df)).collect()}
    assert got[0]["spans"] == "ssn:0:11" and got[0]["scores"][0] >= 0.5
    assert got[1]["spans"] == got[2]["spans"] == got[5]["spans"] == "" and got[5]["scores"] == []
    assert got[3]["spans"] == "email:7:14"
    assert (got[3]["scores"], got[4]["scores"]) == ([1.0], [0.9])
    assert redact(spark, "123-45-6789 (SSN)") == "[SSN] (SSN)"


def redact(spark, text):
    return spark.createDataFrame([(text,)], "t string").select(redacted(F.col("t"))).first()[0]
