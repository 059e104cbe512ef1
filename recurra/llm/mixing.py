"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over the training time 0 to 1, a broken line.
Its integral is the source's weight and sets its target, a share of all words;
a target stops at ``max_repeats`` times the source's words, and the excess is
shared out again by weight until no target is above.

The words a source has delivered by time t are its target times the part of its
schedule's integral up to t. A source's documents stand in hash order, repeated
as often as its target asks, and each copy's place in that row of words is
turned back into the time at which it is due: its training position. Sorting by
position mixes the sources as their schedules say. Copies are whole, so no text
changes: the last copy of a source is taken or left, whichever is nearer its
target, which is missed by half of that document's words at most.

Places are running sums over a source. They are built from sums per (source,
hash range), so that a source with a third of all rows is split over many tasks;
the sums per range have at most ``RANGES`` rows for a source. Sources may be as
many as hosts: they are numbered and filled in ranges of their order, with the
sums per range put before them, one row a range. Sums per source and per range
are the only broadcast candidates; the optimiser checks the size of the former.

Rows: a null text has no words and is never taken; so are blank texts. A null
source is a source of its own, in order after the others. Rows that repeat id,
text and source are counted, and every copy has a place of its own in the row of
words. An empty table gives an empty result. Other columns are not read, or
returned as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recurra.llm.common import cut, words
from recurra.llm.sharding import copies as repeated

RANGES = 1024
WEIGHTS = (1.0, 2.0, 3.0)
# Shapes of the schedules, by order of source and repeated: (time, relative weight) knots.
SHAPES = (((0.0, 1.0), (1.0, 1.0)),                  # steady
          ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),      # early
          ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))      # late
Shape = Sequence[tuple[float, float]]


def _integral(shape: Shape) -> list[float]:
    """The integral from 0 to each knot."""
    out = [0.0]
    for (t0, w0), (t1, w1) in zip(shape, shape[1:]):
        out.append(out[-1] + (t1 - t0) * (w0 + w1) / 2)
    return out


def due(part: Column, shape: Shape) -> Column:
    """The time at which a ``part`` (0 to 1) of a schedule's integral is reached.

    Within a segment the integral is w0 x + (w1 - w0) x^2 / 2h; the root is
    taken in the form that also holds for a level or rising-from-zero segment.
    """
    total = _integral(shape)
    y, out = F.least(F.greatest(part, F.lit(0.0)), F.lit(1.0)) * total[-1], F.lit(float(shape[-1][0]))
    for ((t0, w0), (t1, w1)), begin, end in reversed(list(zip(zip(shape, shape[1:]), total, total[1:]))):
        left = F.greatest(y - begin, F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + left * (2 * (w1 - w0) / (t1 - t0)), F.lit(0.0))) + w0
        out = F.when(y <= end, t0 + F.when(left > 0, left * 2 / root).otherwise(F.lit(0.0))).otherwise(out)
    return out


def _in_ranges(rows: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """``rows`` written in ranges of ``order``; ``part`` numbers the ranges, one for each task that wrote."""
    return cut(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), label)


def _before(rows: DataFrame, **sums: Column) -> DataFrame:
    """part and the sums over all parts before it; as many rows as tasks wrote ``rows``."""
    earlier = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = rows.groupBy("part").agg(*[c.alias(n) for n, c in sums.items()])
    return by_part.select("part", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in sums])


def sources(sized: DataFrame, weights: Sequence[float] = WEIGHTS, shapes: Sequence[Shape] = SHAPES,
            max_repeats: int = 3) -> DataFrame:
    """source, nth, source_size and target of every source; ``sized`` has source and size.

    A schedule's integral is the weight: the shapes only say how it is spread.
    With targets min(max_repeats * size, level * weight), the level is found
    by filling the sources in the order in which they reach their stop.
    """
    by_name = [F.col("source").asc_nulls_last()]
    by_source = _in_ranges(sized.groupBy("source").agg(F.sum("size").alias("source_size")), by_name, "source-sizes")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("nth") % len(weights))
    rows = (by_source.join(F.broadcast(_before(by_source, named=F.count("*"))), "part")
            .withColumn("nth", F.col("named") + F.row_number().over(Window.partitionBy("part").orderBy(*by_name)) - 1)
            .withColumn("weight", weight).withColumn("stop", F.lit(float(max_repeats)) * F.col("source_size"))
            .withColumn("full", F.col("stop") / F.col("weight")).drop("part", "named"))
    rows = _in_ranges(rows, [F.col("full"), F.col("nth")], "source-stops")
    total, open_ = rows.agg(F.sum("source_size").cast("double"), F.sum("weight")).first()
    within = Window.partitionBy("part").orderBy("full", "nth").rowsBetween(Window.unboundedPreceding, -1)
    filled = (rows.join(F.broadcast(_before(rows, stops=F.sum("stop"), weights=F.sum("weight"))), "part")
              .withColumn("stopped", F.col("stops") + F.coalesce(F.sum("stop").over(within), F.lit(0.0)))
              .withColumn("open", F.lit(open_) - F.col("weights") - F.coalesce(F.sum("weight").over(within), F.lit(0.0))))
    # the level if all sources before this one are stopped; the first that it does not stop has the true one
    filled = filled.withColumn("level", (F.lit(total) - F.col("stopped")) / F.col("open"))
    found = filled.where(F.col("level") * F.col("weight") <= F.col("stop")).agg(F.min(F.struct("full", "nth", "level"))["level"])
    level = F.lit(found.first()[0]).cast("double")
    return rows.select("source", F.col("nth").cast("int").alias("nth"), "source_size",
                       F.least("stop", F.coalesce(level * F.col("weight"), F.col("stop"))).alias("target"))


def plan(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
         weights: Sequence[float] = WEIGHTS, shapes: Sequence[Shape] = SHAPES, max_repeats: int = 3) -> DataFrame:
    """One row per document: doc_id, text_hash, source, repeat, nth, size, source_size, target, taken, copies.

    ``repeat`` numbers the rows that have doc_id, text and source in common, from 0.
    ``copies`` is an array of (words, position): the words of each whole copy, and when it is due.
    """
    counted = (docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"),
                           F.col(source).alias("source"), F.size(words(F.col(text))).cast("long").alias("size"))
               .groupBy("doc_id", "text_hash", "source", "size").agg(F.count("*").alias("n")))
    at = F.when(F.col("repeat") == 0, F.xxhash64("doc_id", "text_hash")).otherwise(F.xxhash64("doc_id", "text_hash", "repeat"))
    sized = cut(repeated(counted, keys=["doc_id", "text_hash"]).withColumnRenamed("copy", "repeat").withColumn("at", at)
                .withColumn("range", F.pmod(F.shiftright("at", 48), F.lit(RANGES)).cast("int")), "mix-sizes")
    targets = cut(sources(sized, weights, shapes, max_repeats), "mix-targets")
    ranges = sized.groupBy("source", "range").agg(F.sum("size").alias("in_range"))
    up_to = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = cut(ranges.withColumn("before", F.coalesce(F.sum("in_range").over(up_to), F.lit(0)))
                 .withColumnsRenamed({"source": "of", "range": "of_range"})
                 .join(targets.withColumnRenamed("source", "its"), F.col("of").eqNullSafe(F.col("its")))
                 .drop("its", "in_range"), "mix-ranges")
    inside = Window.partitionBy("source", "range").orderBy("at", "doc_id", "text_hash", "repeat") \
        .rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("in_range", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = (placed.join(ranges, placed["source"].eqNullSafe(ranges["of"]) & (placed["range"] == ranges["of_range"]))
              .withColumn("begin", F.col("before") + F.col("in_range")))
    goal, size = F.round("target").cast("long"), F.col("size")

    def copy(e: Column) -> Column:
        begin = F.col("begin") + e * F.col("source_size")
        took = F.when(F.least(F.greatest(goal - begin, F.lit(0)), size) * 2 >= size, size).otherwise(F.lit(0))
        middle = (begin + took / 2) / F.greatest(F.col("target"), F.lit(1.0))
        at = due(middle, shapes[-1])
        for k in range(len(shapes) - 1):
            at = F.when(F.col("nth") % len(shapes) == k, due(middle, shapes[k])).otherwise(at)
        return F.struct(took.cast("long").alias("words"), at.alias("position"))

    copies = F.filter(F.transform(F.sequence(F.lit(0), F.lit(max_repeats - 1)), copy), lambda c: c["words"] > 0)
    return (placed.withColumn("copies", copies)
            .withColumn("taken", F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"]))
            .select("doc_id", "text_hash", "source", "repeat", "nth", "size", "source_size", "target", "taken", "copies"))


def places(planned: DataFrame) -> DataFrame:
    """The rows of ``plan`` with ``places``: where each copy stands in training order, counted from 0, in the order of ``copies``.

    All copies are sorted by range of training position, and numbered in ranges. Copies due at the
    same time stand by doc_id, text_hash, source and repeat.
    """
    row = ["doc_id", "text_hash", "source", "repeat"]
    due_at = [F.col("position"), *[F.col(c).asc_nulls_last() for c in row], F.col("copy")]
    each = _in_ranges(planned.select(*row, F.posexplode("copies.position").alias("copy", "position")), due_at, "mix-order")
    numbered = (each.join(F.broadcast(_before(each, earlier=F.count("*"))), "part")
                .withColumn("place", F.col("earlier") + F.row_number().over(Window.partitionBy("part").orderBy(*due_at)) - 1))
    held = [F.col(c) for c in planned.columns if c not in row]
    # rows and their copies meet in one grouping, where null keys are equal; every group has one row of ``planned``
    both = (planned.select(*row, F.struct(*held).alias("held"), F.lit(None).cast("struct<copy:int,place:bigint>").alias("at"))
            .unionByName(numbered.select(*row, F.lit(None).cast(planned.select(F.struct(*held)).schema[0].dataType).alias("held"),
                                         F.struct("copy", "place").alias("at"))))
    met = both.groupBy(*row).agg(F.first("held", ignorenulls=True).alias("held"), F.array_sort(F.collect_list("at")).alias("at"))
    return met.select(*[F.col(c) if c in row else F.col(f"held.{c}").alias(c) for c in planned.columns],
                      F.col("at.place").alias("places"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", **how) -> DataFrame:
    """The mixed documents in training order: the columns unchanged, one row per copy taken.

    Rows are sorted by range of training position.
    """
    key = F.struct("doc_id", "text_hash", "source").alias("key")    # structs compare null-safe
    planned = plan(docs, text, source, doc_id, **how).where("taken > 0").select(key, (F.col("repeat") + 1).alias("nth"), "copies")
    own = docs.select(F.struct(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"),
                               F.col(source).alias("source")).alias("own_key"),
                      F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    own = own.withColumn("own_nth", F.row_number().over(Window.partitionBy("own_key").orderBy(F.lit(0))))
    # the second condition tells repeated rows apart; no equality, so that the windows' partitioning serves the join
    each = (own.join(planned, (F.col("own_key") == F.col("key")) & (F.col("own_nth") - F.col("nth") == 0))
            .select("row", F.explode("copies.position").alias("position")))
    return each.orderBy("position").select("row.*")
