"""Host-level quality rules: what fails on a host is counted, its rates are shrunk towards an
empirical beta prior, and the host's verdict is joined back to its documents.

Documents are measured once and the measurements, not the texts, are kept: the shuffles by host
move a few numbers per row. Everything is DataFrame code.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import let, stored, words

WINDOW = 8
MIN_WORDS = 20
REPEATED_PERCENT = 30
DUPLICATE_LINES_PERCENT = 30
SYMBOLS_PERCENT = 10
SYMBOL = r"[#*$%&|<>]"
# A host is rejected when its shrunk failure rate of some rule is above this.
HOST_LIMIT = 0.5
# Bounds of the prior's strength, in documents. The upper one stands for hosts that do not differ.
PRIOR_STRENGTH = (1.0, 1e6)


def _repeated(w: Column, width: int) -> Column:
    """How many words lie in windows that occur twice or more, exactly."""
    windows = F.transform(
        F.sequence(F.lit(1), F.size(w) - (width - 1)),
        lambda i: F.struct(F.array_join(F.slice(w, i, width), " ").alias("w"), i.alias("at")),
    )

    def starts(s: Column) -> Column:
        def at(k: Column) -> Column:
            own, last, next_ = (F.get(s, k + step) for step in (0, -1, 1))
            twin = F.coalesce(own["w"] == last["w"], F.lit(False)) | F.coalesce(own["w"] == next_["w"], F.lit(False))
            return F.when(twin, own["at"])

        found = F.transform(F.sequence(F.lit(0), F.size(s) - 1), at)
        return F.array_sort(F.filter(found, lambda x: x.isNotNull()))

    def covered(a: Column) -> Column:
        gaps = F.transform(a, lambda x, k: F.least(F.coalesce(F.get(a, k + 1) - x, F.lit(width)), F.lit(width)))
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda total, gap: total + gap)

    return let(F.array_sort(windows), lambda s: let(starts(s), covered))


def _repeat_words(w: Column, width: int) -> Column:
    # Equal windows have equal hashes: a text whose hashes all differ has no repeat, and only the
    # others are compared word by word.
    hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (width - 1)), lambda i: F.xxhash64(F.slice(w, i, width)))
    none = F.lit(0).cast("bigint")
    return (
        F.when(F.size(w) < width, none)
        .when(F.size(F.array_distinct(hashes)) == F.size(w) - (width - 1), none)
        .otherwise(_repeated(w, width))
    )


def measured(text: Column, width: int = WINDOW) -> Column:
    """A struct of what the rules look at, all longs; NULL texts count as empty."""
    whole = F.coalesce(text, F.lit(""))

    def of(w: Column) -> Column:
        lines = F.filter(F.split(whole, "\n", -1), lambda line: line.rlike(WORD_CHAR))
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            F.regexp_count(whole, F.lit(SYMBOL)).cast("bigint").alias("n_symbols"),
            let(lines, lambda v: F.struct(F.size(v).alias("all"), F.size(F.array_distinct(v)).alias("own"))).alias("lines"),
            _repeat_words(w, width).alias("n_repeat_words"),
        )

    return let(words(text), of)


WORD_CHAR = r"[^\x20\x09-\x0D]"


def rules() -> dict[str, Column]:
    """The rules a document can fail, over the measured columns."""
    return {
        "short": F.col("n_words") < MIN_WORDS,
        "repeated": F.col("n_repeat_words") * 100 > F.col("n_words") * REPEATED_PERCENT,
        "symbols": F.col("n_symbols") * 100 > F.col("word_chars") * SYMBOLS_PERCENT,
        "same_lines": F.col("n_dup_lines") * 100 > F.col("n_lines") * DUPLICATE_LINES_PERCENT,
    }


def host_rates(judged: DataFrame, host: str, failures: Mapping[str, str]) -> DataFrame:
    """One row per host: documents, and each rule's failure rate shrunk towards its beta prior.

    The prior of a rule comes from all hosts by the method of moments: mean m is the overall rate,
    v the variance of host rates weighted by documents, and alpha + beta = m (1 - m) / v - 1.
    Rows without a host are left out.
    """
    per_host = (
        judged.filter(F.col(host).isNotNull())
        .groupBy(host)
        .agg(F.count("*").alias("n_docs"), *[F.sum(F.col(c).cast("bigint")).alias(f"k_{name}") for name, c in failures.items()])
    )
    per_host = stored(per_host, "hosts")
    total = F.sum("n_docs")
    moments = []
    for name in failures:
        k, n = F.col(f"k_{name}"), F.col("n_docs")
        moments += [(F.sum(k) / total).alias(f"m_{name}"), (F.sum(k * k / n) / total).alias(f"q_{name}")]
    prior = per_host.agg(*moments).first()  # one row: two numbers per rule
    shrunk = []
    for name in failures:
        m = prior[f"m_{name}"] or 0.0
        v = (prior[f"q_{name}"] or 0.0) - m * m
        low, high = PRIOR_STRENGTH
        strength = high if v <= 1e-12 else min(max(m * (1 - m) / v - 1, low), high)
        shrunk.append(((F.col(f"k_{name}") + m * strength) / (F.col("n_docs") + strength)).alias(f"rate_{name}"))
    return per_host.select(host, "n_docs", *shrunk)


def judge_documents(documents: DataFrame, host: str = "source", text: str = "text", host_limit: float = HOST_LIMIT) -> DataFrame:
    """Measurements and verdict per document: base_failed, host_rejected and kept.

    ``kept`` is false where the base rules fail (short, repeated) or the host is rejected.
    NULL text: an empty one, which is short. NULL host: judged by the base rules alone. Repeated
    rows are judged each on their own; other columns of the input play no part.
    """
    m = F.col("m")
    measurements = documents.select(F.col("doc_id"), F.col(host).alias("host"), measured(F.col(text)).alias("m")).select(
        "doc_id", "host", "m.n_words", "m.word_chars", "m.n_symbols",
        (m["lines"]["all"] - m["lines"]["own"]).cast("bigint").alias("n_dup_lines"),
        m["lines"]["all"].cast("bigint").alias("n_lines"), "m.n_repeat_words",
    )
    measurements = stored(measurements, "measured")
    failed = rules()
    judged = measurements.select("*", *[c.alias(f"fails_{name}") for name, c in failed.items()])
    rates = host_rates(judged, "host", {name: f"fails_{name}" for name in failed})
    worst = F.greatest(*[F.col(f"rate_{name}") for name in failed])
    hosts = rates.select(F.col("host").alias("judged_host"), worst.alias("host_rate"))
    base_failed = F.col("fails_short") | F.col("fails_repeated")
    rejected = F.coalesce(F.col("host_rate") > host_limit, F.lit(False))
    return judged.join(hosts, F.col("host") == F.col("judged_host"), "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"),
        rejected.alias("host_rejected"),
        (~base_failed & ~rejected).alias("kept"),
    )
