"""Mixing sources to target weights: capped water-filling, then repetitions.

Targets share a budget by weight. A source whose share is above its cap
(``max_epochs`` times its size) is clamped there, and what is left is shared
by weight among the others, until no share is above its cap. A target over a
source's size is a number of whole repetitions of all its documents and a
rest; the rest is a seeded sample: documents in the order of a hash of seed,
id and text, up to the end of a document that is nearest to the rest.

Sampling doesn't sort a source: sums of ``2 ** BUCKET_BITS`` ranges of the hash find
the range that holds the cut, and only that range is ordered. Decisions are
one row a source: whole repetitions and the hash where the sample ends.

Defined results: a null text has size 0; null is a source of its own; a
source of size 0 has target 0 and is not taken; no document, empty ones
included, is taken more than ``max_epochs`` times; repeated rows share their
hash and are taken or left together; an empty table gives an empty table; only the columns named
are read. All of it is DataFrame functions; figures that decide are whole
numbers, so a rerun gives the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import WORD, ranked, stage, text_of

BUCKET_BITS = 12
MAX_ROUNDS = 10_000


def word_count(text_col: str = "text") -> Column:
    return F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long")


def _hash(seed: int, id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.col(text_col).cast("string"))


def sized(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``(doc_id, source, size, key)``: all that mixing needs of the documents, written once."""
    return stage(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            word_count(text_col).alias("size"),
            _hash(seed, id_col, text_col).alias("key"),
        )
    )


def cycled_weights(sources: DataFrame, cycle: tuple[int, ...] = (3, 1, 2)) -> DataFrame:
    """Add ``weight``: sources by code point, null last, take the numbers of ``cycle`` in turn."""
    placed = ranked(sources, [F.col("source").isNull(), F.col("source")], "__place")
    numbers = F.array(*[F.lit(w).cast("long") for w in cycle])
    at = (F.col("__place") % F.lit(len(cycle)) + 1).cast("int")
    return placed.withColumn("weight", F.element_at(numbers, at)).drop("__place")


def water_fill(sources: DataFrame, share_percent: int, max_epochs: int) -> DataFrame:
    """``sources(source, source_size, weight)`` → the same with ``target`` (double).

    Each round is one aggregate over the sources: what is clamped and what
    weight is free. The level rises from round to round and clamps more, so
    the rounds end when none is clamped anew; only sums reach the driver.
    """
    cap = F.col("source_size") * F.lit(max_epochs)
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    # level = (share_percent * total - 100 * clamped) / (100 * weight): whole numbers, divided once.
    held, numerator, denominator = -1, 0, 1
    full: Column = F.lit(False)
    for _ in range(MAX_ROUNDS):
        row = sources.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
            F.count(F.when(full, 1)),
        ).first()
        if row[2] == held or not row[1]:
            break
        held, numerator, denominator = row[2], int(share_percent * total - 100 * row[0]), int(100 * row[1])
        wide = "decimal(38,0)"
        over = F.col("weight").cast(wide) * F.lit(numerator).cast(wide) >= cap.cast(wide) * F.lit(denominator).cast(wide)
        full = over
    else:
        raise RuntimeError("water-filling did not settle")
    level = F.lit(float(numerator)) / F.lit(float(denominator))
    target = F.when(full, cap.cast("double")).otherwise(F.col("weight").cast("double") * level)
    return sources.withColumn("target", target)


def plan(rows: DataFrame, weigh, share_percent: int, max_epochs: int) -> DataFrame:
    """``(source, source_size, weight, target, whole, cut)`` of ``sized`` rows, one row a source.

    A document is taken ``whole`` times, and once more if its key is below
    ``cut`` (null: never). ``weigh`` adds ``weight`` to a table of sources.
    """
    sums = stage(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    targets = stage(water_fill(stage(weigh(sums)), share_percent, max_epochs))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.floor(F.col("target") - F.col("whole") * F.col("source_size"))
    targets = targets.withColumn("whole", whole.cast("long")).withColumn("rest", rest.cast("long"))
    # The range of the key that holds the cut, from sums of all ranges.
    bucket = F.shiftright("key", 64 - BUCKET_BITS)
    ranges = rows.withColumn("bucket", bucket).groupBy("source", "bucket").agg(F.sum("size").alias("size"))
    upto = Window.partitionBy("source").orderBy("bucket")
    sums_upto = ranges.withColumn("upto", F.sum("size").over(upto)).withColumn("before", F.col("upto") - F.col("size"))
    right = targets.select(F.col("source").alias("__s"), "rest")
    cut_in = sums_upto.join(right, F.col("source").eqNullSafe(F.col("__s")))
    # The first range that the rest ends in; none if it takes every document, or none of them.
    first = cut_in.where("upto > rest and rest > 0").groupBy("__s").agg(F.min(F.struct("bucket", "before", "rest")).alias("x"))
    first = stage(first.select("__s", "x.*"))
    here = rows.withColumn("bucket", bucket).withColumnRenamed("bucket", "__b")
    inside = here.join(first, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__b") == F.col("bucket")))
    # Equal keys (repeated rows) stand or fall together: they are added up first.
    keys = inside.groupBy("__s", "before", "rest", "key").agg(F.sum("size").alias("size"))
    run = F.sum("size").over(Window.partitionBy("__s").orderBy("key"))
    over = keys.withColumn("run", F.col("before") + run).where("run > rest")
    stop = over.groupBy("__s").agg(F.min(F.struct("key", "size", "run", "rest")).alias("x")).select("__s", "x.*")
    # The key that the rest ends in is taken if its end is nearer to the rest than its start.
    nearer = F.when(2 * F.col("run") - F.col("size") < 2 * F.col("rest"), 1).otherwise(0)
    last = stage(stop.select("__s", (F.least("key", F.lit((1 << 63) - 2)) + nearer).alias("cut")))
    out = targets.join(last, F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s")
    # No cut where the rest is the whole source (its target is a multiple).
    return stage(out.select("source", "source_size", "weight", "target", "whole", "cut"))


def _with_plan(rows: DataFrame, sources: DataFrame, source: str) -> DataFrame:
    # A row a source on the right, so adaptive execution may split a source
    # that holds a third of all rows, or broadcast the plan by its size.
    right = sources.select(F.col("source").alias("__s"), "source_size", "target", F.col("whole").alias("__whole"), "cut")
    return rows.join(right, F.col(source).cast("string").eqNullSafe(F.col("__s"))).drop("__s")


def _times(key: Column) -> Column:
    return F.col("__whole") + F.when(F.col("cut").isNotNull() & (key < F.col("cut")), 1).otherwise(0)


def mix(
    docs: DataFrame,
    weigh=cycled_weights,
    share_percent: int = 150,
    max_epochs: int = 2,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row a document: ``doc_id, source, size, source_size, target, copies, taken``."""
    rows = sized(docs, seed, id_col, text_col, source_col)
    found = _with_plan(rows, plan(rows, weigh, share_percent, max_epochs), "source")
    copies = _times(F.col("key")).cast("long")
    return found.select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def mixed_documents(
    docs: DataFrame,
    weigh=cycled_weights,
    share_percent: int = 150,
    max_epochs: int = 2,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with its columns."""
    rows = sized(docs, seed, id_col, text_col, source_col)
    sources = plan(rows, weigh, share_percent, max_epochs)
    keyed = docs.withColumn("__mix_key", _hash(seed, id_col, text_col))
    right = sources.select(F.col("source").alias("__s"), F.col("whole").alias("__whole"), F.col("cut").alias("__cut"))
    found = keyed.join(right, F.col(source_col).cast("string").eqNullSafe(F.col("__s"))).drop("__s")
    times = F.col("__whole") + F.when(F.col("__cut").isNotNull() & (F.col("__mix_key") < F.col("__cut")), 1).otherwise(0)
    wanted = found.withColumn("__times", times.cast("int")).where("__times > 0")
    repeated = wanted.withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__times"))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
