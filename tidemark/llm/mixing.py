"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order. A document's virtual
finish time is the number of words its queue has sent up to and including it,
divided by the source's target. All queues merged by finish time and cut at the
total budget give each source its share; a queue that is used up starts again, at
most ``epochs`` times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, numbered, word_count

WEIGHTS = (5, 2, 1)
EPOCHS = 3
# Queue positions are summed in this many cells of the shuffle order (hex digits), so a
# source with a third of all rows is spread over 4,096 tasks' worth of groups.
CELL_DIGITS = 3


def source_targets(source_sizes: DataFrame, weights: Sequence[int] = WEIGHTS,
                   epochs: int = EPOCHS) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources by code point, null last, take the weights in turn. Targets share the sum of
    all sizes; none exceeds ``epochs`` times its source, and what is cut off goes to the
    others by weight. Sources filled first are those with the least size for their weight,
    so the capped ones are a prefix of that order: no iteration.
    """
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                          ((F.col("place") - 1) % len(weights) + 1).cast("int")).cast("long")
    everything = Window.partitionBy()
    placed = (source_sizes
              .withColumn("place", F.row_number().over(
                  Window.orderBy(F.col("source").asc_nulls_last())))
              .withColumn("weight", weight)
              .withColumn("cap", F.col("source_size") * epochs)
              .withColumn("total", F.sum("source_size").over(everything)))
    by_fill = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    room = F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    capped = (placed
              .withColumn("room", room)
              .withColumn("heft", F.sum("weight").over(onward))
              .withColumn("capped", F.col("room") * F.col("weight") > F.col("cap") * F.col("heft")))
    left = F.col("total") - F.coalesce(
        F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0))
    heft = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything)
    share = (F.col("weight") * F.col("left")).cast("double") / F.col("heft_left").cast("double")
    return (capped.withColumn("left", left).withColumn("heft_left", heft)
            .select("source", "source_size",
                    F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share)
                    .alias("target")))


def shuffle_key(doc_id: Column) -> Column:
    """Where a document stands in its source's shuffle; a hash, so reruns agree."""
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))


# the one order of all queue entries; nulls last
_ORDER = ("finish", "no_source", "source_text", "epoch", "shuffled", "no_id", "id", "size", "row")


def decide(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """``row, doc_id, source, size`` (written, ``row`` unique) -> the same, ``source_size,
    target, copies, taken``.

    ``copies`` is how often the mix takes the document, ``taken`` the words so taken. Documents
    without words cost nothing: they are taken when their place in the queue is reached.
    Null ids and null sources are ordinary values, last in order. Rows alike in everything
    are told apart by ``row`` and stand next to each other. No rows in, no rows out.
    """
    keyed = (sizes.withColumn("shuffled", shuffle_key(F.col("doc_id")))
             .withColumn("cell", F.substring("shuffled", 1, CELL_DIGITS)))
    cells = materialise(keyed.groupBy("source", "cell").agg(F.sum("size").alias("cell_size")),
                        "mix-cells")
    targets = source_targets(cells.groupBy("source").agg(F.sum("cell_size").alias("source_size")),
                             weights, epochs)
    earlier = (Window.partitionBy("source").orderBy("cell")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = cells.withColumn("offset", F.coalesce(F.sum("cell_size").over(earlier), F.lit(0)))
    t, o = targets.alias("t"), offsets.alias("o")
    offsets = materialise(
        o.join(t, F.col("o.source").eqNullSafe(F.col("t.source")))
        .select("o.source", "o.cell", "offset", "source_size", "target"), "mix-offsets")
    k, o = keyed.alias("k"), offsets.alias("o")
    in_cell = (Window.partitionBy("k.source", "k.cell")
               .orderBy("shuffled", F.col("doc_id").asc_nulls_last(), "size", "row")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    queued = materialise(
        k.join(o, F.col("k.source").eqNullSafe(F.col("o.source"))
               & (F.col("k.cell") == F.col("o.cell")))
        .select("row", "doc_id", F.col("k.source").alias("source"), "size", "shuffled",
                "source_size", "target",
                (F.col("offset") + F.sum("size").over(in_cell)).alias("sent")), "mix-queues")
    cut = _cut(queued, epochs)
    if cut is None:
        copies = F.lit(0)
    else:
        last = F.struct(*[F.lit(cut[c]).cast(t).alias(c)
                          for c, t in _entries(queued, epochs).select(*_ORDER).dtypes])
        copies = sum((F.struct(*[c.alias(n) for n, c in _order(F.lit(e)).items()]) <= last)
                     .cast("int") for e in range(epochs))
    return (queued.withColumn("copies", copies.cast("long"))
            .withColumn("taken", F.col("copies") * F.col("size"))
            .select("row", "doc_id", "source", "size", "source_size", "target", "copies", "taken"))


def _order(epoch: Column) -> dict[str, Column]:
    words = (epoch * F.col("source_size") + F.col("sent")).cast("double")
    finish = F.when(F.col("target") > 0, words / F.col("target")).otherwise(F.lit(0.0))
    return {"finish": finish,
            "no_source": F.col("source").isNull(), "source_text": F.coalesce("source", F.lit("")),
            "epoch": epoch.cast("int"), "shuffled": F.col("shuffled"),
            "no_id": F.col("doc_id").isNull(), "id": F.coalesce("doc_id", F.lit(0)).cast("long"),
            "size": F.col("size"), "row": F.col("row")}


def _entries(queued: DataFrame, epochs: int) -> DataFrame:
    times = queued.withColumn("turn", F.explode(F.array(*[F.lit(e) for e in range(epochs)])))
    return times.select(*[c.alias(n) for n, c in _order(F.col("turn")).items()])


def _cut(queued: DataFrame, epochs: int) -> dict | None:
    """The last entry that fits in the budget: range-sort, sum per range, look into one range."""
    entries = _entries(queued, epochs)
    ranges = materialise(
        entries.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
        .withColumn("range", F.spark_partition_id()), "mix-ranges")
    budget = queued.agg(F.sum("size")).first()[0]
    if budget is None:
        return None
    # a row per range, as many as shuffle partitions
    sums = ranges.groupBy("range").agg(F.sum("size").alias("words"))
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    passed = (sums.withColumn("upto", F.sum("words").over(upto))
              .where(F.col("upto") - F.col("words") <= budget)
              .orderBy(F.col("range").desc()).first())
    room = budget - (passed["upto"] - passed["words"])
    inside = (Window.partitionBy("range").orderBy(*_ORDER)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    fits = (ranges.where(F.col("range") == passed["range"])
            .withColumn("upto", F.sum("size").over(inside)).where(F.col("upto") <= room))
    last = fits.orderBy(*[F.col(c).desc() for c in _ORDER]).first()
    if last is None:        # the first entry of that range is too large: the one before it
        last = (ranges.where(F.col("range") < passed["range"])
                .orderBy(*[F.col(c).desc() for c in _ORDER]).first())
    return last.asDict() if last is not None else None


def mix_decisions(docs: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS
                  ) -> DataFrame:
    """A row per document (repeated rows too) with size, target and words taken; see `decide`."""
    narrow = docs.select("doc_id", "source", word_count("text").alias("size"))
    sizes = numbered(narrow, "mix-sizes").select("row", "doc.*")
    return decide(sizes, weights, epochs)


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """The mixed corpus: the columns of ``docs``, each row as often as the mix takes it."""
    base = numbered(docs, "mix-docs")
    sizes = materialise(base.select("row", "doc.doc_id", "doc.source",
                                    word_count("doc.text").alias("size")), "mix-sizes")
    taken = decide(sizes, weights, epochs).where("copies > 0").select("row", "copies")
    repeated = base.join(taken, "row").withColumn(
        "turn", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select("doc.*")
