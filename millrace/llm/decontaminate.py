"""Benchmark decontamination by template canonicalisation.

Numbers, names and units of a text become typed placeholders. Windows of canonical words are
hashed and joined with those of the benchmark, so that a question whose parameters were exchanged
still matches. Then the slots are checked: along one alignment of a document with an item, a value
of the item must always stand for the same value of the document and the other way round.

All DataFrame code. Documents are exploded to one (row, position, hash, slots) per word; the
benchmark side is joined by broadcast only where its measured size allows, otherwise both sides
are shuffled by hash, which spreads windows evenly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import let, stored, words

WINDOW = 5
COVERAGE = 0.8
# What tells a row from others: rows can share an id or have none.
DOCUMENT = ("doc_id", "text_hash")
# A window's template says something only if this many of its words are no placeholders; any other
# window, and an item shorter than a window, is compared word by word.
MIN_LITERALS = 3
# Benchmark windows are broadcast up to this many: about 100 bytes each, so at most 20 MB.
BROADCAST_WINDOWS = 200_000

# First characters of slot words: name, number, unit. They are removed from texts beforehand.
NAME, NUMBER, UNIT = "\x02", "\x03", "\x04"
# Units that follow a number.
UNITS = (
    "mm|cm|dm|m|km|in|inch|inches|ft|feet|yd|yards|mi|mile|miles|mg|g|kg|t|tons|lb|lbs|oz|ml|cl|l|litres|liters|"
    "s|sec|seconds|min|minutes|h|hr|hours|days|weeks|months|years|m/s|km/h|mph|hz|khz|mhz|w|kw|v|a|j|kj|pa|kpa|"
    "k|°c|°f|percent|%|dollars|euros|usd|eur|€|\\$|cents|kb|mb|gb|tb"
)


def _marked(text: Column) -> Column:
    """The text in lower case without punctuation, its names, numbers and units marked as slots.

    A name is a capitalised word inside a sentence: the first word of a sentence, of a line or of
    the text is not. No word is split or joined, so positions of words stay.
    """
    t = text
    for mark in (NAME, NUMBER, UNIT):
        t = F.replace(t, F.lit(mark), F.lit(" "))
    t = F.regexp_replace(t, r"(?<=[\p{Ll}\p{N},;:)\]] )(\p{Lu}[\p{Ll}'’-]+)", f"{NAME}$1")
    t = F.regexp_replace(t, rf"(?i)(?<=[0-9] )((?:{UNITS})(?![\p{{L}}\p{{N}}]))", f"{UNIT}$1")
    t = F.regexp_replace(t, r"(?<![\p{L}\p{N}.,])([0-9])", f"{NUMBER}$1")
    return F.lower(F.regexp_replace(t, r"[^\p{L}\p{N}\x02-\x04\x20\x09-\x0D]+", ""))


def _canonical(marked: Column) -> Column:
    return F.regexp_replace(marked, r"([\x02-\x04])[^\x20\x09-\x0D]*", "$1")


def _slot(word: Column) -> Column:
    return word.rlike(r"^[\x02-\x04]")


def _exact(own: Column) -> Column:
    """Hash of words as they are, whether marked as slots or not; never that of a template."""
    return F.xxhash64(F.lit("exact"), F.transform(own, lambda w: F.translate(w, NAME + NUMBER + UNIT, "")))


def template_windows(text: Column, width: int = WINDOW, short: tuple[int, ...] = ()) -> Column:
    """An array of (at, hash, slots, rich) per window; empty for NULL and for texts of fewer words.

    A window rich in slots has the hash of its own words and no slots, and so have the additional
    windows of the widths ``short``.
    """
    kind = "array<struct<at:int,hash:bigint,slots:array<string>,rich:boolean>>"

    def of(marked: Column) -> Column:
        has_slots = marked.rlike(r"[\x02-\x04]")

        def windows(w: Column) -> Column:
            def exact(i: Column, n: int = width) -> Column:
                return F.struct(i.alias("at"), _exact(F.slice(w["own"], i, n)).alias("hash"), F.lit(None).cast("array<string>").alias("slots"), F.lit(True).alias("rich"))

            def window(i: Column) -> Column:
                def template(slots: Column) -> Column:
                    plain = F.struct(i.alias("at"), F.xxhash64(F.slice(w["canon"], i, width)).alias("hash"), slots.alias("slots"), F.lit(False).alias("rich"))
                    return F.when(F.coalesce(F.size(slots), F.lit(0)) > width - MIN_LITERALS, exact(i)).otherwise(plain)

                return let(F.when(w["any"], F.filter(F.slice(w["own"], i, width), _slot)), template)

            def each(n: int, window) -> Column:
                size = F.size(w["canon"])
                return F.when(size < n, F.array().cast(kind)).otherwise(F.transform(F.sequence(F.lit(1), size - (n - 1)), window).cast(kind))

            whole = each(width, window)

            def small(n: int) -> Column:
                return each(n, lambda i: exact(i, n))  # with n as a second argument, Spark would pass the index

            return F.concat(whole, *map(small, short)) if short else whole

        own = words(marked)
        canon = F.when(has_slots, words(_canonical(marked))).otherwise(own)
        return let(F.struct(own.alias("own"), canon.alias("canon"), has_slots.alias("any")), windows)

    return let(_marked(F.coalesce(text, F.lit(""))), of)


def benchmark_windows(items: DataFrame, width: int = WINDOW) -> tuple[DataFrame, tuple[int, ...]]:
    """Windows of the benchmark, and the numbers of words of items shorter than a window.

    A shorter item is one window. The first window of an item is there twice if a document would
    take the item's first word for a name after another word. Items without words have none and
    are never found. An item that is listed twice counts once.
    """
    rows = items.select("item_id", "text").dropDuplicates(["item_id", "text"])

    def exploded(text: Column, skipped: int = 0) -> DataFrame:
        found = rows.select("item_id", F.explode(template_windows(text, width)).alias("w"))
        return found.select(
            "item_id", (F.col("w.at") - skipped).alias("item_at"), F.col("w.hash").alias("hash"),
            F.coalesce("w.slots", F.array().cast("array<string>")).alias("item_slots"), F.col("w.rich").alias("rich"),
        )

    inside = exploded(F.concat(F.lit("x "), F.ltrim(F.col("text"))), 1).filter("item_at = 1")
    own = words(_marked(F.coalesce("text", F.lit(""))))
    short = rows.select("item_id", own.alias("own")).filter((F.size("own") > 0) & (F.size("own") < width))
    lengths = tuple(sorted(r["n"] for r in short.select(F.size("own").alias("n")).distinct().collect()))
    short = short.select("item_id", F.lit(1).alias("item_at"), _exact(F.col("own")).alias("hash"), F.array().cast("array<string>").alias("item_slots"), F.lit(True).alias("rich"))
    every = exploded(F.col("text")).unionByName(inside).unionByName(short).dropDuplicates(["item_id", "item_at", "hash", "item_slots"])
    return stored(every, "benchmark-windows"), lengths


def contaminated_texts(documents: DataFrame, items: DataFrame, coverage: float = COVERAGE, width: int = WINDOW) -> DataFrame:
    """Pairs (doc_id, text_hash, item_id) where the document holds at least ``coverage`` of the item's windows
    along alignments with consistent slots; ``coverage`` and whether the passage is ``verbatim``.

    Windows that are rich in slots are left out of this; an item is also found if the document holds
    ``coverage`` of all its windows, these included, with the item's own values.

    A row is judged by its own text, also where it shares its doc_id or has none; rows with the same
    id and text are one. NULL and empty texts are clean; so is everything where the benchmark is empty.
    """
    bench, short = benchmark_windows(items, width)
    n_windows = bench.count()
    bench = F.broadcast(bench) if n_windows <= BROADCAST_WINDOWS else bench
    # The first window can be there in two forms, one of them rich in slots.
    totals = bench.groupBy("item_id", "item_at").agg(F.every("rich").alias("rich")).groupBy("item_id").agg(
        F.count("*").alias("total_all"), F.count_if(~F.col("rich")).alias("total")
    )
    windows = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), F.explode(template_windows(F.col("text"), width, short)).alias("w"))
    windows = windows.select(*DOCUMENT, F.col("w.at").alias("at"), F.col("w.hash").alias("hash"), F.col("w.slots").alias("slots"))
    slots = F.coalesce("slots", F.array().cast("array<string>"))
    hits = windows.join(bench, "hash").select(
        *DOCUMENT, "item_id", (F.col("at") - F.col("item_at")).alias("shift"), F.struct("item_at", "rich").alias("item_at"),
        F.zip_with("item_slots", slots, lambda theirs, ours: F.struct(theirs.alias("theirs"), ours.alias("ours"))).alias("pairs"),
    )
    # One alignment is one occurrence of the passage; it has at most as many hits as the item windows.
    aligned = hits.groupBy(*DOCUMENT, "item_id", "shift").agg(
        F.collect_set("item_at").alias("covered"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs")
    )
    theirs, ours = F.array_distinct(F.col("pairs.theirs")), F.array_distinct(F.col("pairs.ours"))
    consistent = aligned.filter((F.size("pairs") == F.size(theirs)) & (F.size("pairs") == F.size(ours)))
    same = F.forall("pairs", lambda p: p["theirs"] == p["ours"])
    covered = (
        consistent.select(*DOCUMENT, "item_id", same.alias("same"), F.explode("covered").alias("c"))
        .groupBy(*DOCUMENT, "item_id", F.col("c.item_at").alias("item_at"))
        .agg(F.max("same").alias("same"), F.max(~F.col("c.rich")).alias("plain"), F.max(F.col("same") & ~F.col("c.rich")).alias("plain_same"))
        .groupBy(*DOCUMENT, "item_id")
        .agg(F.count_if("plain").alias("n"), F.count_if("plain_same").alias("n_same"), F.count_if("same").alias("n_all"))
    )
    as_template = (F.col("total") > 0) & (F.col("n") >= coverage * F.col("total"))
    as_it_is = F.col("n_all") >= coverage * F.col("total_all")
    found = covered.join(totals, "item_id").filter(as_template | as_it_is)
    return found.select(
        *DOCUMENT, "item_id", F.when(as_template, F.col("n")).otherwise(F.col("n_all")).alias("n_windows"),
        F.when(as_template, F.try_divide("n", "total")).otherwise(F.col("n_all") / F.col("total_all")).alias("coverage"),
        (as_it_is | (as_template & (F.col("n_same") >= coverage * F.col("total")))).alias("verbatim"),
    )


def contaminated(documents: DataFrame, items: DataFrame, coverage: float = COVERAGE, width: int = WINDOW) -> DataFrame:
    """The pairs of ``contaminated_texts`` by doc_id; ids that stand for several texts can have an item more than once."""
    return contaminated_texts(documents, items, coverage, width).drop("text_hash")


def without_contaminated(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no benchmark passage, all columns as they were.

    Each row is judged by its own text. What is dropped is stored first, ids and hashes only, so that
    Spark knows its size and need not move the texts where it is small.
    """
    found = contaminated_texts(documents, items).select(F.col("doc_id").alias("dirty_id"), F.col("text_hash").alias("dirty_hash"))
    dirty = stored(found.distinct(), "contaminated")
    own = documents["doc_id"].eqNullSafe(dirty["dirty_id"]) & (F.xxhash64(documents["text"]) == dirty["dirty_hash"])
    return documents.join(dirty, own, "left_anti")
