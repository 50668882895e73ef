"""Shards by fixed virtual slots and a versioned map of slots to shards.

Records are hashed by their text into a fixed number of slots, so equal texts stay together. The
bytes of every slot are summed, and a map says to which shard a slot belongs. Rebalancing edits the
map, slot by slot, and stores it as a new version; records are never hashed anew.

Texts whose copies hold more than a quarter of a shard's share are large (at most four times as many
texts as shards can be, which bounds the table that is broadcast for them). Each has a slot of its own
at the end, and goes whole to one shard: the largest are placed first, and the other slots are balanced
around them. Only a text whose copies hold more than a whole share, which no shard could take, is spread
over all slots by doc_id.

Built-in functions throughout. The map has as many rows as there are slots, whatever the input; it
is the one table that the driver edits.

Nulls and odd inputs: a null text has no bytes and counts as one for the record's end. A null
doc_id is a value like others. Repeated rows are counted before they are shuffled and each get a
place. An empty table gives an empty result and a map without bytes. Columns besides doc_id and text
are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwright.llm.common import stored, texts
from martwright.sources.tables import scratch_path

SLOTS = 4096
NUMBERED, NUMBERED_ROWS = 512, 200_000  # groups in which the rows of a shard are numbered, and their rows
COPIES = 4096  # copies of a row that are listed in one place
MAP_SCHEMA = "version int, virtual_slot int, shard int"


def records(docs: DataFrame) -> DataFrame:
    """(doc_id, copy, size, text_crc32, text_hash) of every row; copies of a row are numbered."""
    docs = texts(docs)
    facts = docs.select(
        "doc_id",
        (F.octet_length("text") + 1).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"),
    )
    facts = facts.groupBy("doc_id", "size", "text_crc32", "text_hash").agg(F.count("*").alias("copies"))
    blocks = F.sequence(F.lit(1).cast("long"), "copies", F.lit(COPIES).cast("long"))
    one, one_long = facts.where(F.col("copies") <= COPIES).withColumn("first", F.lit(1).cast("long")), F.lit(COPIES - 1).cast("long")
    many = facts.where(F.col("copies") > COPIES).withColumn("first", F.explode(blocks)).repartition("text_hash", "doc_id", "first")
    rows = one.unionByName(many)
    return rows.withColumn("copy", F.explode(F.sequence("first", F.least("copies", F.col("first") + one_long)))).drop("copies", "first")


def large_texts(rows: DataFrame, shards: int) -> list[tuple[int, int, int, bool]]:
    """(text_hash, text_crc32, bytes, fits) of the large texts, the largest first; at most 4 * shards."""
    share = (rows.agg(F.sum("size")).first()[0] or 0) / shards
    groups = rows.groupBy("text_hash", "text_crc32").agg(F.sum("size").alias("bytes"))
    found = groups.where(F.col("bytes") * 4 > share).collect()
    found.sort(key=lambda r: (-r["bytes"], r["text_hash"], r["text_crc32"]))
    return [(r["text_hash"], r["text_crc32"], r["bytes"], r["bytes"] <= share) for r in found]


def slotted(rows: DataFrame, shards: int, slots: int = SLOTS) -> DataFrame:
    """The records with their virtual slot; the last 4 * shards slots are those of large texts."""
    if slots <= 8 * shards:
        raise ValueError("there must be more than eight slots for each shard")
    own, kept = iter(range(slots - 1, 0, -1)), []
    for text_hash, crc, _, fits in large_texts(rows, shards):
        kept.append((text_hash, crc, next(own) if fits else None))
    large = rows.sparkSession.createDataFrame(kept, "text_hash long, text_crc32 long, own int").withColumn("large", F.lit(True))
    rows = rows.join(F.broadcast(large), ["text_hash", "text_crc32"], "left")
    spread = F.when(F.col("large"), F.xxhash64("text_hash", "doc_id", "copy")).otherwise(F.xxhash64("text_hash"))
    hashed = F.pmod(spread, F.lit(slots - 4 * shards)).cast("int")
    return rows.withColumn("virtual_slot", F.coalesce("own", hashed)).drop("large", "own")


def slot_bytes(rows: DataFrame) -> dict[int, int]:
    """The bytes of every slot that has any; one number per slot."""
    return {r[0]: r[1] for r in rows.groupBy("virtual_slot").agg(F.sum("size")).collect()}


def first_map(shards: int, slots: int = SLOTS) -> list[int]:
    return [slot % shards for slot in range(slots)]


def rebalanced(current: list[int], sizes: dict[int, int], shards: int) -> list[int]:
    """The map after slots went from the fullest shard to the emptiest, alone or against a smaller one.

    Slots that hold more than a quarter of a share are placed first, the largest first, each into the
    shard that has least of them; a shard keeps its own where that is as good. Then each step narrows the
    gap between two shards as far as one slot or one exchange can.
    """
    edited, loads = list(current), [0] * shards
    quarter, placed = sum(sizes.values()) / (4 * shards), [0] * shards
    for slot in sorted((s for s in sizes if sizes[s] > quarter), key=lambda s: (-sizes[s], s)):
        edited[slot] = min(range(shards), key=lambda x: (placed[x], x != edited[slot]))
        placed[edited[slot]] += sizes[slot]
    members: list[set[int]] = [set() for _ in range(shards)]
    for slot, shard in enumerate(edited):
        if size := sizes.get(slot, 0):
            loads[shard] += size
            members[shard].add(slot)
    while True:
        full, spare = max(range(shards), key=loads.__getitem__), min(range(shards), key=loads.__getitem__)
        gap = loads[full] - loads[spare]
        found = _narrowing(members[full], members[spare], sizes, gap)
        if found is None:
            return edited
        for slot, old, new in ((found[0], full, spare), (found[1], spare, full)):
            if slot is not None:
                members[old].remove(slot)
                members[new].add(slot)
                edited[slot] = new
                loads[old] -= sizes[slot]
                loads[new] += sizes[slot]


def _narrowing(full: set[int], spare: set[int], sizes: dict[int, int], gap: int) -> tuple[int, int | None] | None:
    """The slot to move, and the one to take back, that leave the smallest gap; None if none helps."""
    back = sorted((sizes[s], s) for s in spare)
    best, least = None, gap
    for slot in sorted(full):
        at = bisect_left(back, (sizes[slot] - gap // 2, -1))
        for size, other in ((0, None), *back[max(0, at - 1) : at + 1]):
            left = abs(gap - 2 * (sizes[slot] - size))
            if left < least:
                best, least = (slot, other), left
    return best


def grown(current: list[int], sizes: dict[int, int], shards: int) -> list[int]:
    """The map with one shard more: slots move into the new shard only, up to its fair share."""
    edited, share = list(current), sum(sizes.values()) / (shards + 1)
    loads = [0] * (shards + 1)
    for slot, shard in enumerate(edited):
        loads[shard] += sizes.get(slot, 0)
    for slot in sorted(sizes, key=lambda s: (-sizes[s], s)):
        shard = edited[slot]
        if loads[shard] - sizes[slot] >= share * 0.999 and loads[shards] + sizes[slot] <= share:
            edited[slot] = shards
            loads[shard] -= sizes[slot]
            loads[shards] += sizes[slot]
    return edited


def store_map(spark: SparkSession, versions: Iterable[list[int]], path: str, first: int = 0) -> None:
    """Append versions of the map to those in the folder."""
    rows = [(v, slot, shard) for v, shards in enumerate(versions, first) for slot, shard in enumerate(shards)]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def stored_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(virtual_slot, shard) of one version, the latest by default."""
    rows = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is None:
        version = rows.agg(F.max("version")).first()[0]
    return rows.where(F.col("version") == version).select("virtual_slot", "shard")


def placed(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """The slotted records with their shard and their gapless place in it, in groups of doc_ids.

    Rows are numbered in many groups per shard; a group's first place is a sum over group sizes.
    """
    groups = max(NUMBERED, rows.count() // NUMBERED_ROWS)
    rows = rows.join(F.broadcast(slot_map), "virtual_slot")
    rows = rows.withColumn("group", F.pmod(F.xxhash64("doc_id", "copy"), F.lit(groups)))
    sizes = rows.groupBy("shard", "group").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("shard", "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    order = Window.partitionBy("shard", "group").orderBy("doc_id", "text_hash", "text_crc32", "size", "copy")
    rows = rows.withColumn("place", F.row_number().over(order).cast("long") - 1)
    rows = rows.join(F.broadcast(firsts), ["shard", "group"])
    return rows.withColumn("slot", F.col("first") + F.col("place")).drop("group", "first", "place")


def sharded(docs: DataFrame, shards: int = 8, slots: int = SLOTS, path: str | None = None) -> DataFrame:
    """Every row's shard, with near equal bytes, by a map that is balanced and stored on the way.

    (doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, version)
    """
    spark = docs.sparkSession
    rows = slotted(stored(records(docs), "records"), shards, slots)
    start = first_map(shards, slots)
    path = path or scratch_path(spark, "slot-map")
    store_map(spark, [start, rebalanced(start, slot_bytes(rows), shards)], path)
    return placed(rows, stored_map(spark, path)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        F.lit(1).alias("version"),
    )
