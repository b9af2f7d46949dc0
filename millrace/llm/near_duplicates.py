"""Near-duplicate documents by MinHash with tensored banding.

A table key of MinHash banding joins R hash values. Tensored banding makes it of a pair of smaller
keys, one from each of two collections: M keys of R / 2 values each side give M * M tables from
2 * M * R / 2 hash values instead of M * M * R.

The steps keep every shuffle in proportion to what can still be a duplicate:

1. Documents with equal shingle sets are one class; all further work is on classes.
2. Small keys that only one class has are dropped, and only classes that share one of each side
   form table keys.
3. In each table key the class that meets most others is the pivot; the others are compared with
   it, not with each other. Links are confirmed on the full sets.
4. Classes that met the same pivot but ended in different components can still be linked. Each is
   compared with the family's consensus, the hashes that most of a sample of its members have. What
   two members have in common lies inside the consensus or outside it. If all of it lies inside,
   sizes tell whether it can suffice; else they share a hash outside, and an index over a prefix of
   those hashes finds the pair. Other pairs are ruled out without being formed. This holds for any
   set in place of the consensus, which only makes the index short. Pairs that agree in too few
   small keys are left out, as in step 2.
5. Components come from alternating large-star and small-star rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import connected_components
from millrace.llm.texts import WordHashes, stored, word_hashes

SHINGLE = 5
PERCENT = 80
# Values per small key and small keys per side. Of two sets with similarity 0.8 a side shares no
# key with probability (1 - 0.8 ** 3) ** 14 < 5e-5.
VALUES, SIDE = 3, 14

# Of the 2 * SIDE small keys, two sets with similarity 0.8 have 14 in common on average, and fewer
# than this in less than one of 10,000 cases.
ALIKE = 5
# Bits of the filters that keep rows no join can use out of a shuffle (4 MB each): texts and sets that
# are not compared, small keys of one row. Up to some 8 million wanted values most others are kept out.
MARKS = 1 << 25
# Sizes are joined by bands, each that much wider than the one before.
BAND = 1.02
# Members of a family, about, whose majority is its consensus.
FAMILY_SAMPLE = 32

_RNG = np.random.default_rng(20_240_607)
_FACTORS = _RNG.integers(1, 2**63, 2 * SIDE * VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _RNG.integers(0, 2**63, 2 * SIDE * VALUES, dtype=np.uint64)
_SEEDS = _RNG.integers(1, 2**63, 2 * SIDE, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; of fewer words, the one whole run."""
    n = len(words)
    if n == 0:
        return words
    used = min(n, width)
    runs = np.full(n - used + 1, np.uint64(used))
    for k in range(used):
        runs = _mixed(runs * np.uint64(0x9E3779B97F4A7C15) + words[k : n - used + 1 + k])
    return np.unique(runs)


def small_keys(own: np.ndarray) -> np.ndarray:
    """The small keys of a non-empty set: SIDE of the first collection, then SIDE of the second."""
    lowest = np.full(len(_FACTORS), np.iinfo(np.uint64).max)
    for at in range(0, len(own), 4096):
        values = own[None, at : at + 4096] * _FACTORS[:, None]
        values += _OFFSETS[:, None]
        np.minimum(lowest, values.min(axis=1), out=lowest)
    keys = _SEEDS.copy()
    for values in lowest.reshape(2 * SIDE, VALUES).T:
        keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + values)
    return keys.view(np.int64)


def _set_key(own: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(own.tobytes())


def signatures(documents: DataFrame, text: str = "text", width: int = SHINGLE) -> DataFrame:
    """doc_id, text_key, n_shingles, set_key and small keys per row; both keys NULL for texts without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            sizes, keys, small = [], [], []
            for content in batch.column(2).to_pylist():
                own = shingles(word_hashes(content, cache), width)
                sizes.append(len(own))
                keys.append(_set_key(own) if len(own) else None)
                small.append(small_keys(own) if len(own) else None)
            columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(small, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "n_shingles", "set_key", "small"])

    rows = documents.select(F.col("doc_id").cast("long"), F.xxhash64(text), F.col(text))
    return rows.mapInArrow(sign, "doc_id long, text_key long, n_shingles long, set_key binary, small array<long>")


def table_keys(signed: DataFrame) -> DataFrame:
    """Rows (key, weight, set_key): the table keys a class forms from small keys it shares.

    ``weight`` is how many classes share its small keys; it makes the middle of a group its pivot.
    Rows are counted first: a key that only one row has no classes can share. Most keys are such, and
    are left out before set keys are shuffled.
    """
    small = signed.select("set_key", F.posexplode("small").alias("pos", "h"))
    repeated = stored(small.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"), "repeated-keys")
    of_classes = stored(possibly_in(small, ["h"], repeated).distinct(), "class-keys")
    shared = stored(of_classes.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1"), "shared-keys")
    own = of_classes.join(shared, "h").groupBy("set_key").agg(F.sum("n").alias("weight"), F.collect_list(F.struct("pos", "h")).alias("own"))
    side = [F.transform(F.filter("own", keep), lambda k: k["h"]) for keep in (lambda k: k["pos"] < SIDE, lambda k: k["pos"] >= SIDE)]
    sides = own.select("set_key", "weight", side[0].alias("a"), side[1].alias("b"))
    return sides.select("set_key", "weight", F.explode("a").alias("a"), "b").select(
        "set_key", "weight", F.explode(F.transform("b", lambda b: F.xxhash64("a", b))).alias("key")
    )


def possibly_in(rows: DataFrame, columns: list[str], wanted: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``columns`` are not in ``wanted``, before they are shuffled.

    A bit per hash of the wanted rows is set in bitmaps of MARKS bits in all, so what is broadcast has a
    fixed size. No wanted row is lost; of the others the more pass, the more bits are set.
    """
    mark = F.pmod(F.xxhash64(*columns), F.lit(MARKS))
    width = 8 * 4096  # bits of one of Spark's bitmaps
    marked = wanted.select(mark.alias("mark")).distinct().select(F.floor(F.col("mark") / width).alias("map"), F.pmod("mark", F.lit(width)).alias("bit"))
    maps = marked.repartition("map").groupBy("map").agg(F.bitmap_construct_agg("bit").alias("bits"))
    maps = stored(maps.select(F.col("map").alias("own_map"), "bits"), "marks")
    bit = F.pmod(mark, F.lit(width)).cast("int")
    byte = F.conv(F.hex(F.substring("bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = rows.join(F.broadcast(maps), F.floor(mark / width) == F.col("own_map"))
    return found.filter(F.getbit(byte, bit % 8) == 1).select(*rows.columns)


def shingle_sets(documents: DataFrame, wanted: DataFrame, text: str = "text", width: int = SHINGLE) -> DataFrame:
    """set_key, ``pivots``, ``own`` (its hashes as bytes) and ``small`` of the wanted classes, from one document each.

    ``small`` are the lowest eight bits of the small keys: enough to see that two keys differ. The
    pivots that a class met come along from ``wanted``, so that its set goes straight to them.
    """

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            rows, found = [], []
            for row, (content, key) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                own = shingles(word_hashes(content, cache), width)
                if _set_key(own) == key:
                    rows.append(row)
                    found.append((own.tobytes(), small_keys(own).astype(np.int8)))
            columns = list(zip(*found, strict=True)) or [[]] * 2
            kinds = (pa.binary(), pa.list_(pa.int8()))
            kept = [batch.column(c).take(pa.array(rows, pa.int32())) for c in (1, 2)]
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*kept, *arrays], ["set_key", "pivots", "own", "small"])

    def place(doc_id: Column, text_key: Column) -> list[Column]:
        return [F.coalesce(doc_id, F.lit(0)).alias("id"), doc_id.isNull().alias("no_id"), text_key.alias("text_key")]

    rows = documents.select(*place(F.col("doc_id").cast("long"), F.xxhash64(text)), F.col(text).alias("content"))
    wanted = wanted.select(*place(F.col("rep_id"), F.col("rep_text")), "set_key", "pivots")
    at = ["id", "no_id", "text_key"]
    # The join brings repeated rows together, so they are dropped without another shuffle.
    found = possibly_in(rows, at, wanted).join(wanted, at).select(*at, "content", "set_key", "pivots").distinct()
    return found.select("content", "set_key", "pivots").mapInArrow(rebuild, "set_key binary, pivots array<binary>, own binary, small array<tinyint>")


def sets_of(sets: DataFrame, pairs: DataFrame, side: str) -> DataFrame:
    """The sets of one side of ``pairs``, without most others."""
    return possibly_in(sets, ["set_key"], pairs.select(F.col(side).alias("set_key"))).select(F.col("set_key").alias(side), "own", "small")


def similarities(pairs: DataFrame, right: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Rows of ``pairs`` (a, b, ``own`` and ``small`` of a) with the sizes of both sets (that of b is in
    ``right``) and of their intersection in place of ``own``, and ``outside``: the hashes of a that b
    lacks, as many of the lowest as a set linked with a must share one of.

    A set linked with a has ``percent`` percent of a's hashes. With c of them in b, at least
    percent of |a| less c are among the hashes outside, and of n hashes in a fixed order the lowest
    of k shared ones is among the first n - k + 1.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for one, other in zip(batch.column("own"), batch.column("own_b"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (one, other))
                outside = np.setdiff1d(x, y, assume_unique=True)
                common = len(x) - len(outside)
                shared = max(1, -(-percent * len(x) // 100) - common)
                rows.append((len(x), len(y), common, outside[: max(0, len(outside) - shared + 1)].view(np.int64)))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
            kept = [batch.column(c) for c in ("a", "b", "small")]
            yield pa.RecordBatch.from_arrays([*kept, *arrays], ["a", "b", "small", "size_a", "size_b", "common", "outside"])

    both = pairs.join(right.select("b", F.col("own").alias("own_b")), "b").select("a", "b", "small", "own", "own_b")
    return both.mapInArrow(compare, "a binary, b binary, small array<tinyint>, size_a long, size_b long, common long, outside array<long>")


def _linked(percent: int) -> Column:
    return F.col("common") * 100 >= (F.col("size_a") + F.col("size_b") - F.col("common")) * percent


def _band(size: Column) -> Column:
    return F.floor(F.log(size) / float(np.log(BAND))).cast("int")


def consensus(placed: DataFrame, members: DataFrame, open_pivots: DataFrame, sets: DataFrame) -> DataFrame:
    """b (the pivot) and ``own``: the hashes that half of a sample of its members or more have."""

    def majority(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own, n = np.unique(np.concatenate([np.frombuffer(o, dtype=np.uint64) for o in rows["own"]]), return_counts=True)
        return pd.DataFrame({"b": [key[0]], "own": [own[2 * n >= len(rows)].tobytes()]})

    drawn = F.pmod(F.xxhash64("a", "b"), F.lit(1 << 20)) / (1 << 20) * F.col("n") < FAMILY_SAMPLE
    some = possibly_in(placed.select("a", "b", "own"), ["a", "b"], members.filter(drawn))
    pivots = sets_of(sets, open_pivots, "open").select(F.col("open").alias("a"), F.col("open").alias("b"), "own")
    own = some.unionByName(pivots).join(open_pivots, F.col("b") == F.col("open")).filter((F.col("a") == F.col("b")) | drawn)
    return own.select("b", "own").groupBy("b").applyInPandas(majority, "b binary, own binary")


def unsettled_pairs(compared: DataFrame, placed: DataFrame, roots: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs of different components that met the same pivot and may be linked (see step 4).

    ``placed`` has the sets of the classes beside the pivots they met, as ``similarities`` takes them.
    """
    of_pivot = roots.select(F.col("node").alias("b"), F.col("root").alias("pivot_root"))
    met = compared.select("a", "b").join(roots.select(F.col("node").alias("a"), "root"), "a", "left").join(of_pivot, "b", "left")
    met = stored(met.withColumns({"root": F.coalesce("root", "a"), "pivot_root": F.coalesce("pivot_root", "b")}), "met")
    several = met.groupBy("b").agg(F.min(F.least("root", "pivot_root")).alias("low"), F.max(F.greatest("root", "pivot_root")).alias("high"), F.count("*").alias("n"))
    several = stored(several.filter("low < high AND n > 1").select(F.col("b").alias("open"), "n"), "open-pivots")
    members = stored(met.join(several, F.col("b") == F.col("open")).drop("open"), "members")
    middle = consensus(placed, members, several, sets)
    compared = similarities(possibly_in(placed, ["b"], several.select(F.col("open").alias("b"))), middle, percent)
    members = stored(compared.join(members.drop("n"), ["a", "b"]), "placed-members")

    # Common hashes outside the pivot's set.
    index = members.select("b", F.explode("outside").alias("h"), "a", "root", "size_a", "small")
    mixed = index.groupBy("b", "h").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    mixed = stored(mixed.select(F.col("b").alias("open"), F.col("h").alias("open_h")), "open-hashes")
    index = stored(index.join(mixed, (F.col("b") == F.col("open")) & (F.col("h") == F.col("open_h")), "left_semi"), "outside-index")
    x, y = (index.select("b", "h", F.col("a").alias(f"key_{s}"), F.col("root").alias(f"root_{s}"), F.col("size_a").alias(f"size_{s}"), F.col("small").alias(f"small_{s}")) for s in "xy")
    close = F.least("size_x", "size_y") * 100 >= F.greatest("size_x", "size_y") * percent
    alike = F.size(F.filter(F.zip_with("small_x", "small_y", lambda p, q: p == q), lambda same: same)) >= ALIKE
    outside = x.join(y, ["b", "h"]).filter((F.col("root_x") < F.col("root_y")) & close & alike).select("key_x", "key_y")

    # All in common lies inside: then each side has enough there, and sizes follow from the counts.
    enough = members.filter(F.col("common") * 100 >= F.col("size_a") * percent)
    least_size = F.ceil(F.col("size_a") * percent / 100).cast("long")
    most_size = F.least(F.floor(F.col("common") * (100 + percent) / percent) - F.col("size_a"), F.floor(F.col("size_a") * 100 / percent)).cast("long")
    apart = enough.filter((F.col("root") != F.col("pivot_root")) & (most_size >= least_size))
    x = apart.select("b", F.explode(F.sequence(_band(least_size), _band(most_size))).alias("band"), least_size.alias("least_y"), most_size.alias("most_y"), F.col("a").alias("key_x"), F.col("root").alias("root_x"), F.col("size_a").alias("size_x"), F.col("common").alias("common_x"), F.col("small").alias("small_x"))
    y = enough.select("b", _band(F.col("size_a")).alias("band"), F.col("size_a").alias("size_y"), F.col("a").alias("key_y"), F.col("root").alias("root_y"), F.col("common").alias("common_y"), F.col("small").alias("small_y"))
    suffices = F.least("common_x", "common_y") * (100 + percent) >= (F.col("size_x") + F.col("size_y")) * percent
    fits = F.col("size_y").between(F.col("least_y"), F.col("most_y"))
    inside = x.join(y, ["b", "band"]).filter((F.col("root_x") != F.col("root_y")) & fits & suffices & alike).select("key_x", "key_y")
    return outside.unionByName(inside).select(F.least("key_x", "key_y").alias("a"), F.greatest("key_x", "key_y").alias("b")).distinct()


def grouped(documents: DataFrame, text: str = "text", percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """doc_id, text_key, n_shingles and root of every row; ``root`` names the group, NULL for texts without words."""
    signed = stored(signatures(documents, text, width), "signatures")
    keys = stored(table_keys(signed), "table-keys")

    best = keys.groupBy("key").agg(F.max(F.struct("weight", "set_key")).alias("pivot"), F.count("*").alias("n")).filter("n > 1")
    best = stored(best.select("key", F.col("pivot.set_key").alias("pivot")), "pivots")
    met = keys.join(best, "key").filter(F.col("set_key") != F.col("pivot"))
    pairs = stored(met.select(F.col("set_key").alias("a"), F.col("pivot").alias("b")).distinct(), "pairs")

    rep = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("rep")
    reps = signed.filter(F.col("set_key").isNotNull()).groupBy("set_key").agg(rep)
    wanted = pairs.select(F.col("a").alias("set_key"), F.col("b").alias("pivot")).unionByName(pairs.select(F.col("b").alias("set_key"), F.lit(None).cast("binary").alias("pivot")).distinct())
    wanted = wanted.groupBy("set_key").agg(F.collect_list("pivot").alias("pivots"))
    wanted = wanted.join(reps, "set_key").select("set_key", "pivots", F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_key").alias("rep_text"))
    sets = stored(shingle_sets(documents, wanted, text, width), "sets")

    placed = sets.select(F.col("set_key").alias("a"), F.explode("pivots").alias("b"), "own", "small")
    compared = stored(similarities(placed, sets_of(sets, pairs, "b"), percent).drop("outside", "small"), "similarities")
    edges = compared.filter(_linked(percent)).select("a", "b")
    rest = stored(unsettled_pairs(compared, placed, connected_components(edges), sets, percent), "unsettled")
    more = stored(similarities(rest.join(sets_of(sets, rest, "a"), "a"), sets_of(sets, rest, "b"), percent).drop("outside", "small"), "more-similarities").filter(_linked(percent)).select("a", "b")
    roots = connected_components(edges.unionByName(more))

    labelled = signed.select("doc_id", "text_key", "n_shingles", "set_key").join(roots.withColumnRenamed("node", "set_key"), "set_key", "left")
    return stored(labelled.select("doc_id", "text_key", "n_shingles", F.coalesce("root", "set_key").alias("root")), "labelled")


def near_duplicates(documents: DataFrame, text: str = "text", percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Rows whose sets have ``percent`` percent of their union in common are linked; ``component_id`` is
    the smallest doc_id that links reach. Rows without words or text are linked with nothing. Rows
    that share a doc_id are rows of their own; one without doc_id has the component_id of what it is
    linked with, NULL if nothing has an id, and is never kept.
    """
    labelled = grouped(documents, text, percent, width)
    lowest = stored(labelled.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("lowest")), "lowest-ids")
    final = labelled.join(lowest, "root", "left")
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("lowest"))
    return final.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))


def representatives(documents: DataFrame, text: str = "text", percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """One row of each group of near duplicates, and all rows without words: all columns as they were.

    It is the row with the smallest doc_id; of rows that share that, the one whose text hashes
    lowest, and of repeated rows any one. A group without any doc_id keeps one row too.
    """
    labelled = grouped(documents, text, percent, width)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("least")
    chosen = labelled.filter(F.col("root").isNotNull()).groupBy("root").agg(least).select(F.col("least.doc_id").alias("chosen_id"), F.col("least.text_key").alias("chosen_text"))
    copies = labelled.filter(F.col("root").isNotNull()).groupBy("doc_id", "text_key").agg(F.count("*").alias("copies"))
    same = F.col("chosen_id").eqNullSafe(F.col("doc_id")) & (F.col("chosen_text") == F.col("text_key"))
    chosen = stored(chosen.join(copies, same).select("chosen_id", "chosen_text", "copies"), "chosen")

    def rows(of: DataFrame) -> DataFrame:
        own = documents["doc_id"].cast("long").eqNullSafe(of["chosen_id"]) & (F.xxhash64(documents[text]) == of["chosen_text"])
        return documents.join(of, own, "left_semi")

    # Repeated rows are rare: only they are brought together, to drop all but one.
    single = rows(stored(chosen.filter("copies = 1"), "chosen-once"))
    repeated = rows(stored(chosen.filter("copies > 1"), "chosen-repeated")).dropDuplicates(["doc_id", text])
    wordless = documents.filter(~F.coalesce(documents[text], F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    return single.unionByName(repeated).unionByName(wordless)
