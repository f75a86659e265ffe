"""Document fingerprints as threshold-scaled sketches, in DataFrame functions only.

A sketch retains every hash of a five-word shingle below one fixed fraction of the hash range, and the
4,096 smallest hashes whatever they are, for documents of any length. The smallest of a union are among
the smallest of its parts, so sketches merge to exactly the sketch of the joined shingles at every size, and
containment and Jaccard estimates hold between very unequal documents: two sketches are compared below
the bound up to which both hold every hash. Documents of up to 4,096 distinct shingles retain all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.llm.common import WORD_BREAK, written

SHINGLE = 5
FRACTION = 8      # one hash in FRACTION is retained
SMALL = 4096      # and the smallest ones, so many at least: shorter documents retain all
LOWEST = -(1 << 63)


def with_sketch(df: DataFrame, text: str, scale: str, sketch: str) -> DataFrame:
    """Adds the sorted distinct retained hashes of a text column, and ``scale``: 1 if these are all, else ``FRACTION``."""
    words, every = f"{sketch}_words", f"{sketch}_every"
    squeezed = F.btrim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WORD_BREAK + "+", " "))
    df = df.withColumn(words, F.when(squeezed == "", F.array().cast("array<string>")).otherwise(F.split(squeezed, " ")))
    w = F.col(words)
    hashes = F.when(F.size(w) >= SHINGLE, F.transform(
        F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]))) \
        .when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<long>"))
    # The number of distinct hashes decides, not the length: a repetitive text has few.
    df = df.withColumn(every, F.sort_array(F.array_distinct(hashes)))
    df = df.withColumn(scale, F.when(F.size(every) <= SMALL, 1).otherwise(FRACTION))
    return df.withColumn(sketch, F.when(F.col(scale) == 1, F.col(every)).otherwise(retained(F.col(every)))).drop(words, every)


def _below(h: Column) -> Column:
    return h < F.lit(LOWEST + (1 << 64) // FRACTION)


def retained(hashes: Column) -> Column:
    """Of sorted distinct hashes those that a sketch retains."""
    return F.filter(hashes, lambda h, i: _below(h) | (i < F.lit(SMALL)))


def comparable(scale: Column, sketch: Column, other_scale: Column, other: Column) -> Column:
    """The hashes of ``sketch`` up to the bound up to which ``other`` holds every hash of its text."""
    bound = F.greatest(F.lit(LOWEST + (1 << 64) // FRACTION - 1), F.element_at(other, -1))
    return F.when(other_scale == 1, sketch).otherwise(F.filter(sketch, lambda h: h <= bound))


def likeness(scale_a: Column, a: Column, scale_b: Column, b: Column) -> Column:
    """Jaccard estimate of two sketches; 1 if both are of texts without words, 0 if nothing is left to compare.

    A text has no words if its sketch is empty although all hashes are retained.
    """
    x, y = comparable(scale_a, a, scale_b, b), comparable(scale_b, b, scale_a, a)
    both = F.size(F.array_intersect(x, y))
    union = F.size(x) + F.size(y) - both
    wordless = (F.greatest(scale_a, scale_b) == 1) & (F.size(a) == 0) & (F.size(b) == 0)
    return F.when(wordless, F.lit(1.0)).when(union > 0, both / union).otherwise(F.lit(0.0))


def containment(scale_a: Column, a: Column, scale_b: Column, b: Column) -> Column:
    """Estimate of the share of a's shingles that b holds; null if no hash of a is left."""
    x, y = comparable(scale_a, a, scale_b, b), comparable(scale_b, b, scale_a, a)
    return F.when(F.size(x) > 0, F.size(F.array_intersect(x, y)) / F.size(x))


def merged(scale_a: Column, a: Column, scale_b: Column, b: Column) -> Column:
    """The sketch of the shingles of both texts, exactly as if they had been sketched together."""
    return retained(F.sort_array(F.array_union(a, b)))


def merged_scale(scale_a: Column, a: Column, scale_b: Column, b: Column) -> Column:
    """The scale beside :func:`merged`."""
    all_held = (scale_a == 1) & (scale_b == 1) & (F.size(F.array_union(a, b)) <= SMALL)
    return F.when(all_held, 1).otherwise(FRACTION)


def as_text(scale: Column, sketch: Column) -> Column:
    """The fingerprint as a string: the scale, then the hashes in hex."""
    return F.concat(scale.cast("string"), F.lit(":"), F.array_join(F.transform(sketch, F.hex), ","))


def neighbours(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id) in ascending order of the distinct ids, the first after the last.

    Ids are split by range, the neighbour is looked up within each range, and only the first id
    of each range (one row per partition) is ordered in one task.
    """
    parts = written(ids.where(F.col("doc_id").isNotNull()).select("doc_id").repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()), "ordered-ids")
    inside = parts.select("doc_id", "part", F.lead("doc_id").over(Window.partitionBy("part").orderBy("doc_id")).alias("next_id"))
    firsts = parts.groupBy("part").agg(F.min("doc_id").alias("first_id"))
    in_order = Window.orderBy("part")
    firsts = firsts.select("part", F.coalesce(F.lead("first_id").over(in_order), F.min("first_id").over(Window.partitionBy())).alias("first_after"))
    return inside.join(firsts, "part").select("doc_id", F.coalesce("next_id", "first_after").alias("next_id"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    The edited text has its last floor(n_chars / 4) code points replaced by the first as many (or
    all) of the next document in ascending doc_id, the first after the last. Null text counts as
    empty. Of rows that repeat a doc_id the one with the smallest SHA-256 of the text is the next
    document of another; a row without a doc_id has no next document and loses its last quarter,
    near_next is 0. Shingles do not depend on the kind or the number of white-space characters
    between words; texts of fewer than five words are one shingle.
    """
    # (Another name than doc_id: an alias of the same name is dropped on one side only, and the two
    # exchanges of the texts would not be recognised as one.)
    t = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    named = t.where(F.col("id").isNotNull())
    ids = written(named.select(F.col("id").alias("doc_id")).distinct(), "ids")
    order = written(neighbours(ids), "neighbours")
    # What each document gives to the one before it is its text: a sketch of all hashes is larger.
    asked = order.select(F.col("doc_id").alias("before_id"), F.col("next_id").alias("id"))
    gives = named.join(asked, "id").select(
        F.col("before_id").alias("id"), F.sha2(F.encode("text", "UTF-8"), 256).alias("sha"), F.col("text").alias("given"))
    gives = gives.groupBy("id").agg(F.min_by("given", "sha").alias("given"))
    # Both joins deal the texts out by id: they are shuffled once and the exchange is used again.
    alone = t.where(F.col("id").isNull()).select("id", "text", F.lit(None).cast("string").alias("given"))
    both = named.join(gives, "id", "left").unionByName(alone).withColumn("n_chars", F.length("text").cast("long"))
    quarter = "cast(floor(n_chars / 4) as int)"
    both = both.withColumn("edited", F.expr(
        f"concat(left(text, cast(n_chars as int) - {quarter}), left(coalesce(given, ''), {quarter}))"))
    both = both.withColumn("edited_sha256", F.sha2(F.encode("edited", "UTF-8"), 256))
    both = with_sketch(with_sketch(both, "text", "scale", "sketch"), "edited", "edited_scale", "edited_sketch")
    both = with_sketch(both, "given", "next_scale", "next_sketch")
    c = F.col
    return both.select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256",
        as_text(c("scale"), c("sketch")).alias("fingerprint"),
        as_text(c("edited_scale"), c("edited_sketch")).alias("edited_fingerprint"),
        likeness(c("scale"), c("sketch"), c("edited_scale"), c("edited_sketch")).alias("near_edited"),
        F.when(c("given").isNull(), F.lit(0.0)).otherwise(
            likeness(c("scale"), c("sketch"), c("next_scale"), c("next_sketch"))).alias("near_next"))
