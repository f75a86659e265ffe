"""Mixing sources to target weights with hash-threshold histograms.

Every document has a fixed 60-bit hash. Words are summed by source and the leading hash bits;
the bucket in which a source's budget ends is the only one looked at again, by its next bits,
until one document is left in it. What lies below the source's threshold is taken: a filter, no
sort. A smaller budget always takes a subset of what a larger one takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattframe.llm.common import unused, word_count, written

WEIGHTS = (3, 1, 2)      # of the sources in code point order, null last, repeating
SHARE = 1.5              # all targets together, as a share of all words
MOST = 2                 # no document is taken more often
HASH_BITS, STEP_BITS = 60, 12


def mix_hash(doc_id):
    """Column: 60-bit hash of a doc_id, the first 15 hex digits of its MD5; null as empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Per source: source_size and target (words).

    ``share`` of all words is dealt by weight; a target stops at ``most`` times the source's
    words and the excess goes to the others by weight until none is above. That is
    min(cap, level * weight) with one level for all, found from the sources in ascending order
    of cap / weight. The two windows run over one row for each source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    names = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.row_number().over(names) - 1) % len(weights) + 1).cast("int"))
    per = per.select("*", w.alias("weight"), F.row_number().over(names).alias("place"))
    by_room = Window.orderBy(F.lit(most) * F.col("source_size") / F.col("weight"), "place")
    all_rows = Window.partitionBy()
    cap = F.lit(most) * F.col("source_size")
    per = per.select(
        "source", "source_size", "weight", cap.alias("cap"),
        ((F.lit(share) * F.sum("source_size").over(all_rows)
          - (F.sum(cap).over(by_room.rowsBetween(Window.unboundedPreceding, 0)) - cap))
         / F.sum("weight").over(by_room.rowsBetween(0, Window.unboundedFollowing))).alias("level"))
    open_level = F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(all_rows)
    return per.select("source", "source_size",
                      F.least(F.col("cap").cast("double"), F.coalesce(open_level * F.col("weight"), F.col("cap").cast("double"))).alias("target"))


def thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: source_size, target, copies (whole passes over the source) and limit.

    Documents with a hash below ``limit`` are taken once more than ``copies``. The last document
    is taken if that brings the words nearer to the target. Documents of equal hash (repeated
    rows) are taken or left together.
    """
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    cells = targets.select(
        "source", "source_size", "target", copies.alias("copies"),
        (F.col("target") - copies * F.col("source_size")).alias("rest"),
        F.lit(0).cast("long").alias("low"), F.lit(HASH_BITS).alias("shift"),
        F.lit(0).cast("long").alias("before"), F.col("source_size").alias("cell_size"), F.lit(2).cast("long").alias("n"))
    cells = written(cells, "mix-cells")
    names = [c for c in cells.columns if c != "source"]
    for shift in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        open_cells = cells.where((F.col("n") > 1) & (F.col("rest") > 0))
        inside = sizes.alias("s").join(
            open_cells.alias("c"),
            F.col("s.source").eqNullSafe(F.col("c.source"))
            & (F.shiftright(F.col("s.hash"), shift + STEP_BITS) == F.shiftright(F.col("c.low"), shift + STEP_BITS)),
        ).select("s.source", "s.size", "s.hash", *[F.col(f"c.{c}").alias(c) for c in names if c not in ("shift", "n", "low", "cell_size")])
        sums = inside.groupBy("source", "source_size", "target", "copies", "rest", "before",
                              F.shiftright("hash", shift).alias("cell")).agg(F.sum("size").alias("cell_size"), F.count("*").alias("n"))
        upto = F.col("before") + F.sum("cell_size").over(Window.partitionBy("source").orderBy("cell"))
        last = sums.withColumn("upto", upto).where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("cell_size") <= F.col("rest")))
        refined = last.select(
            "source", "source_size", "target", "copies", "rest", F.shiftleft("cell", shift).alias("low"), F.lit(shift).alias("shift"),
            (F.col("upto") - F.col("cell_size")).alias("before"), "cell_size", "n")
        cells = written(cells.where(~((F.col("n") > 1) & (F.col("rest") > 0))).unionByName(refined), "mix-cells")
        if not cells.where((F.col("n") > 1) & (F.col("rest") > 0)).head(1):
            break
    nearer = F.col("before") + F.col("cell_size") - F.col("rest") < F.col("rest") - F.col("before")
    limit = F.when(F.col("rest") <= 0, F.lit(0).cast("long")).otherwise(
        F.col("low") + F.when(nearer, F.expr("shiftleft(1L, shift)")).otherwise(F.lit(0).cast("long")))
    return written(cells.select("source", "source_size", "target", "copies", limit.alias("limit")), "mix-limits")


def mix_limits(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one row per document: doc_id, source, size, hash; one row per source: its limits)."""
    sizes = written(docs.select(
        F.col("doc_id").alias("doc_id"), F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"), mix_hash(F.col("doc_id")).alias("hash")), "mix-sizes")
    return sizes, thresholds(sizes, source_targets(sizes))


def mixed(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words, repeats counted).

    Null text has size 0 and takes nothing; rows without a source form a source of their own,
    the last one. Reruns agree: the hash depends on the doc_id alone.
    """
    sizes, limits = mix_limits(docs)
    s, c = sizes.alias("s"), limits.alias("c")
    times = F.col("c.copies") + (F.col("s.hash") < F.col("c.limit")).cast("long")
    return s.join(c, F.col("s.source").eqNullSafe(F.col("c.source")), "left").select(
        "s.doc_id", "s.size", "c.source_size", "c.target", (F.col("s.size") * times).alias("taken"),
        times.alias("copies"), F.col("s.source").alias("source"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, all columns.

    The limits are one row per source, so the texts are filtered where they are read. Documents without a source
    mix as a source of their own; a null text has no words, stays as often as its source is taken whole and by its id's hash
    once more; repeated rows of an id are taken equally often; an empty table gives an empty mix.
    """
    _, limits = mix_limits(docs)
    d, c = docs.alias("d"), limits.select("source", "copies", "limit").alias("c")
    times = (F.col("c.copies") + (mix_hash(F.col("d.doc_id")) < F.col("c.limit")).cast("long")).cast("int")
    rows = d.join(c, F.col("d.source").cast("string").eqNullSafe(F.col("c.source"))).where(times > 0)
    copy = unused("_copy", docs)
    return rows.select("d.*", F.explode(F.array_repeat(F.lit(1), times)).alias(copy)).drop(copy)
