"""Sharding through fixed virtual slots.

Every record is hashed into one of ``SLOTS`` virtual slots, for good. Bytes and
rows are aggregated per slot, and a slot-to-shard map says which shard holds a
slot. Only the map changes when shards are added or sizes drift: it is a small
table, kept by version, and ``rebalance`` edits a version into the next by
moving as few slots as needed. The law is ``bytes``: shards get near-equal
bytes, as near as one slot (or one very long record) allows.

Only ids and sizes are shuffled, never texts. The per-slot sums and the map have
at most ``SLOTS`` rows whatever the data, so the map is edited on the driver and
broadcast. Records are placed from the map as it was stored and read again.

Rows: a null text has 0 bytes and is placed like any other. The slot hash takes
the id and the text's checksum, so null or repeated ids spread out. Rows that
repeat id and text are counted before they are shuffled and dealt out again as
numbered copies, ``BLOCK`` to a task's row; the slot hash takes the number of
every copy but the first, so that a group of any size spreads over all slots.
An empty table gives an empty result and a map that deals the slots round. Other
columns are not read.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recurra.llm.common import cut
from recurra.session import checkpoint_root

SLOTS = 4096
RECORD_OVERHEAD = 8
BLOCK = 4096        # copies of one repeated row that are numbered together

MAP_SCHEMA = T.StructType([
    T.StructField("virtual_slot", T.IntegerType(), False),
    T.StructField("shard", T.IntegerType(), False),
    T.StructField("slot_bytes", T.LongType(), False),
    T.StructField("slot_rows", T.LongType(), False),
    T.StructField("first_place", T.LongType(), False),
])


def size_of(text: Column) -> Column:
    """Stored size of a record: UTF-8 bytes of its text and a fixed overhead."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(RECORD_OVERHEAD)).cast("long")


def checksum(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def slot_of(slots: int) -> Column:
    """Virtual slot of a record with doc_id, text_crc32 and copy (its number among the repeats, from 0)."""
    first, later = F.xxhash64("doc_id", "text_crc32"), F.xxhash64("doc_id", "text_crc32", "copy")
    return F.pmod(F.when(F.col("copy") == 0, first).otherwise(later), F.lit(slots)).cast("int")


def copies(counted: DataFrame, first: str | None = None, keys: Sequence[str] = ("doc_id", "text_crc32")) -> DataFrame:
    """Every row of ``counted`` as often as its column ``n`` says, with ``copy`` from ``first`` (0) on.

    The blocks of a much repeated row are dealt to all tasks before they are spread out. The number of
    tasks is named, as adaptive coalescing would judge them by the size of the blocks, not of their rows.
    """
    tasks = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    begin = F.lit(0).cast("long") if first is None else F.col(first)
    last = F.least((F.col("block") + 1) * BLOCK, F.col("n")) - 1
    blocks = counted.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / BLOCK))))
    return (blocks.repartition(tasks, *keys, "block")
            .withColumn("copy", F.explode(F.sequence(F.col("block") * BLOCK + begin, last + begin))).drop("n", "block"))


def records(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual_slot of every record."""
    t = F.col(text)
    counted = (docs.select(F.col(doc_id).alias("doc_id"), size_of(t).alias("size"), checksum(t).alias("text_crc32"))
               .groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n")))
    return copies(counted).withColumn("virtual_slot", slot_of(slots)).drop("copy")


@dataclass(frozen=True)
class SlotMap:
    """One version of the map: shard, bytes and rows of every virtual slot."""

    version: int
    shards: int
    shard: tuple[int, ...]
    bytes: tuple[int, ...]
    rows: tuple[int, ...]

    def loads(self) -> list[int]:
        out = [0] * self.shards
        for s, b in zip(self.shard, self.bytes):
            out[s] += b
        return out

    def frame(self, spark: SparkSession) -> DataFrame:
        """The map as a table; ``first_place`` numbers a shard's slots on through their rows."""
        at, out = [0] * self.shards, []
        for v, s in enumerate(self.shard):
            out.append((v, s, self.bytes[v], self.rows[v], at[s]))
            at[s] += self.rows[v]
        return spark.createDataFrame(out, MAP_SCHEMA)


def slot_sums(recs: DataFrame, slots: int = SLOTS) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """Bytes and rows of every virtual slot."""
    size, rows = [0] * slots, [0] * slots
    for r in recs.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect():
        size[r["virtual_slot"]], rows[r["virtual_slot"]] = r["b"], r["n"]
    return tuple(size), tuple(rows)


def first_map(recs: DataFrame, shards: int, slots: int = SLOTS) -> SlotMap:
    """Version 1: slots by falling bytes, each to the shard with the fewest bytes so far."""
    size, rows = slot_sums(recs, slots)
    heap, shard = [(0, 0, s) for s in range(shards)], [0] * slots
    for v in sorted(range(slots), key=lambda v: (-size[v], v)):
        load, held, s = heapq.heappop(heap)
        shard[v] = s
        heapq.heappush(heap, (load + size[v], held + 1, s))
    return SlotMap(1, shards, tuple(shard), size, rows)


def rebalance(old: SlotMap, shards: int, size: tuple[int, ...] | None = None,
              rows: tuple[int, ...] | None = None, slack: float = 0.01) -> SlotMap:
    """The next version: for other sizes, or for more or fewer shards.

    Slots of dropped shards move, and then the fullest shards give slots to the
    emptiest until all lie within ``slack`` of the mean or no move helps. A slot
    moves only if that lowers the higher of the two loads.
    """
    size, rows = size or old.bytes, rows or old.rows
    shard, loads, held = list(old.shard), [0] * shards, [[] for _ in range(shards)]
    homeless = [v for v, s in enumerate(shard) if s >= shards]
    for v, s in enumerate(shard):
        if s < shards:
            loads[s] += size[v]
            held[s].append(v)

    def move(v: int, to: int) -> None:
        if shard[v] < shards:
            loads[shard[v]] -= size[v]
            held[shard[v]].remove(v)
        shard[v] = to
        loads[to] += size[v]
        held[to].append(v)

    for v in sorted(homeless, key=lambda v: (-size[v], v)):
        move(v, min(range(shards), key=lambda s: (loads[s], s)))
    mean = sum(loads) / shards
    while True:
        full = max(range(shards), key=lambda s: (loads[s], -s))
        empty = min(range(shards), key=lambda s: (loads[s], s))
        gap = loads[full] - loads[empty]
        if gap <= 2 * slack * mean:
            break
        fits = [v for v in held[full] if 0 < size[v] < gap]
        if not fits:
            break
        # the largest slot that does not make the receiver the fuller one, else the smallest
        under = [v for v in fits if 2 * size[v] <= gap]
        move(max(under, key=lambda v: (size[v], -v)) if under else min(fits, key=lambda v: (size[v], v)), empty)
    return SlotMap(old.version + 1, shards, tuple(shard), tuple(size), tuple(rows))


def save_map(spark: SparkSession, slot_map: SlotMap, root: str) -> None:
    """Store a version under ``root``; versions are written once and never changed."""
    (slot_map.frame(spark).withColumn("shards", F.lit(slot_map.shards)).coalesce(1)
     .write.mode("errorifexists" if slot_map.version in versions(spark, root) else "overwrite")
     .parquet(f"{root}/version={slot_map.version}"))


def versions(spark: SparkSession, root: str) -> list[int]:
    """The versions stored under ``root``, in order; a folder without its one file is of a write that did not end."""
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return []
    folders = [s.getPath() for s in fs.listStatus(where) if s.getPath().getName().startswith("version=")]
    done = [f for f in folders if any(s.getPath().getName().endswith(".parquet") for s in fs.listStatus(f))]
    return sorted(int(f.getName().split("=")[1]) for f in done)


def load_map(spark: SparkSession, root: str, version: int | None = None) -> SlotMap:
    """A stored version, the latest by default."""
    if version is None:
        version = versions(spark, root)[-1]
    found = spark.read.parquet(f"{root}/version={version}").orderBy("virtual_slot").collect()     # one row a slot
    return SlotMap(version, found[0]["shards"], tuple(r["shard"] for r in found),
                   tuple(r["slot_bytes"] for r in found), tuple(r["slot_rows"] for r in found))


def place(recs: DataFrame, slot_map: SlotMap) -> DataFrame:
    """Every record with its shard and its place in the shard, 0 to rows - 1 without gaps.

    Places run through the shard's virtual slots, and within a slot by id and
    checksum, so that each task numbers single slots only.
    """
    order = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    table = slot_map.frame(recs.sparkSession).select("virtual_slot", "shard", "first_place")
    return (recs.withColumn("in_slot", F.row_number().over(order) - 1)
            .join(F.broadcast(table), "virtual_slot")
            .withColumn("slot", F.col("first_place") + F.col("in_slot"))
            .drop("first_place", "in_slot"))


def shard_documents(docs: DataFrame, shards: int, text: str = "text", doc_id: str = "doc_id",
                    slots: int = SLOTS, map_root: str | None = None) -> DataFrame:
    """Place all documents by the map's next version, stored under ``map_root`` and read from there.

    Where ``map_root`` holds versions already, the latest is edited for the sizes and
    shards of now, so that few slots move. Without one, version 1 goes to a new folder
    under the shared checkpoint folder.
    """
    spark = docs.sparkSession
    root = map_root or f"{checkpoint_root(spark)}/llm/shard-map-{uuid.uuid4().hex}"
    recs = cut(records(docs, text, doc_id, slots), "shard-records")
    if versions(spark, root):
        slot_map = rebalance(load_map(spark, root), shards, *slot_sums(recs, slots))
    else:
        slot_map = first_map(recs, shards, slots)
    save_map(spark, slot_map, root)
    stored = load_map(spark, root, slot_map.version)
    return place(recs, stored).withColumn("map_version", F.lit(stored.version))


def write_shards(docs: DataFrame, slot_map: SlotMap, path: str, text: str = "text", doc_id: str = "doc_id") -> None:
    """Write the documents, each whole as a struct ``document``, into one folder per shard, in slot order.

    Whole rows that repeat are counted before the shuffle; rows that repeat id and text alone are numbered on from
    one another. So the shards hold the records that ``place`` puts there. Columns of maps cannot be grouped.
    """
    slots = len(slot_map.shard)
    table = slot_map.frame(docs.sparkSession).select("virtual_slot", "shard")
    whole = docs.select(F.col(doc_id).alias("doc_id"), checksum(F.col(text)).alias("text_crc32"), size_of(F.col(text)).alias("size"),
                        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"))
    counted = whole.groupBy(*whole.columns).agg(F.count("*").alias("n"))
    alike = Window.partitionBy("doc_id", "text_crc32", "size").orderBy("document")
    counted = counted.withColumn("first", F.coalesce(F.sum("n").over(alike.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    held = copies(counted, "first").withColumn("virtual_slot", slot_of(slots)).select("document", "virtual_slot")
    (held.join(F.broadcast(table), "virtual_slot").repartition("virtual_slot")
     .sortWithinPartitions("shard", "virtual_slot").write.partitionBy("shard").parquet(path))
