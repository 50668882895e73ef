"""Exact duplicates by an index of cuckoo filters over live digests.

Texts are equal if their SHA-256 digests are. The index has a row per bucket of digests (the low bits of
their first 32 decide, so many of them that a bucket has about BUCKET_ROWS rows): a cuckoo filter, and the content: every live digest with the largest doc_id and the
number of rows of its group. A digest that the filter has not seen is new without a look at the
content; a hit is verified against the bucket's content, as the filter errs now and then. A filter
that overflows is built anew at twice the size from the stored digests. Digests can be deleted, so
an index can follow a corpus: ``update`` adds and removes rows.

Rows of one text are merged by a small index of this kind in the tasks that read them, so a text
that a third of all rows share reaches its bucket as a row per task.

Nulls and odd inputs: a null text is an empty one. A null doc_id is smaller than any other. Repeated
rows (equal doc_id and text) are members of their group like any others; one of them is kept. An
empty table gives an empty result. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import partitions, rows_of, stored, text_of, texts, unused_name

BUCKET_BITS, MOST_BITS = 16, 31
BUCKET_ROWS = 20_000  # of a corpus that needs more than 2 ** BUCKET_BITS buckets
PARTIAL_ENTRIES = 100_000  # digests that a reading task holds before it hands its groups on
INDEX_SCHEMA = "bucket int, slots binary, digests array<binary>, keep_ids array<bigint>, sizes array<bigint>"
EVENT_SCHEMA = "bucket int, kind int, digest binary, keep_id bigint, rows bigint, stored struct<slots binary, digests array<binary>, keep_ids array<bigint>, sizes array<bigint>>"
STORED, REMOVE, ADD = 0, 1, 2  # in the order in which a bucket takes them


class CuckooFilter:
    """Sixteen-bit marks in four-slot buckets; every mark lies in one of two buckets."""

    WAYS = 4
    KICKS = 200

    def __init__(self, buckets: int = 2, slots: bytes = b"") -> None:
        self.slots = array("H", slots or bytes(2 * self.WAYS * buckets))
        self.mask = len(self.slots) // self.WAYS - 1
        self.turn = 0

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[-2:], "big") or 1
        first = int.from_bytes(digest[8:16], "big") & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, place: int, mark: int) -> int:
        return place ^ (mark * 0x9E3779B1 >> 7 & self.mask)

    def _replace(self, place: int, old: int, new: int) -> bool:
        for i in range(place * self.WAYS, (place + 1) * self.WAYS):
            if self.slots[i] == old:
                self.slots[i] = new
                return True
        return False

    def __contains__(self, digest: bytes) -> bool:
        mark, first, second = self._places(digest)
        ways, slots = self.WAYS, self.slots
        return mark in slots[first * ways : (first + 1) * ways] or mark in slots[second * ways : (second + 1) * ways]

    def insert(self, digest: bytes) -> bool:
        """False if there is no room; the filter must then be built anew."""
        mark, first, second = self._places(digest)
        if self._replace(first, 0, mark) or self._replace(second, 0, mark):
            return True
        place = first
        for _ in range(self.KICKS):
            self.turn += 1
            at = place * self.WAYS + self.turn % self.WAYS
            mark, self.slots[at] = self.slots[at], mark
            place = self._other(place, mark)
            if self._replace(place, 0, mark):
                return True
        return False

    def delete(self, digest: bytes) -> bool:
        mark, first, second = self._places(digest)
        return self._replace(first, mark, 0) or self._replace(second, mark, 0)


class CuckooIndex:
    """The live digests of one bucket: a filter in front of the stored content."""

    def __init__(self) -> None:
        self.filter, self.content = CuckooFilter(), {}

    @classmethod
    def load(cls, row: dict) -> CuckooIndex:
        index = cls()
        index.filter = CuckooFilter(slots=row["slots"])
        entries = zip(row["keep_ids"], row["sizes"], strict=True)
        index.content = {d: list(e) for d, e in zip(row["digests"], entries, strict=True)}
        return index

    def add(self, digest: bytes, keep_id: int | None, rows: int) -> None:
        if digest in self.filter and (entry := self.content.get(digest)):
            if keep_id is not None and (entry[0] is None or keep_id > entry[0]):
                entry[0] = keep_id
            entry[1] += rows
            return
        self.content[digest] = [keep_id, rows]
        if not self.filter.insert(digest):
            self._resize()

    def remove(self, digest: bytes) -> None:
        if digest in self.filter and self.content.pop(digest, None):
            self.filter.delete(digest)

    def _resize(self) -> None:
        buckets = self.filter.mask + 1
        while True:
            buckets *= 2
            self.filter = CuckooFilter(buckets)
            if all(map(self.filter.insert, self.content)):
                return

    def row(self, bucket: int) -> dict:
        keep_ids, sizes = zip(*self.content.values(), strict=True) if self.content else ((), ())
        return {
            "bucket": bucket,
            "slots": self.filter.slots.tobytes(),
            "digests": list(self.content),
            "keep_ids": list(keep_ids),
            "sizes": list(sizes),
        }


def _digest(docs: DataFrame) -> Column:
    return F.unhex(F.sha2(text_of(docs), 256))


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) of every row."""
    docs = texts(docs)
    return docs.select("doc_id", _digest(docs).alias("digest"))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The groups of the rows that one task reads."""

    def groups(index: CuckooIndex) -> pa.RecordBatch:
        keep_ids, sizes = zip(*index.content.values(), strict=True) if index.content else ((), ())
        columns = [pa.array(index.content, pa.binary()), pa.array(keep_ids, pa.int64()), pa.array(sizes, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["digest", "keep_id", "rows"])

    index = CuckooIndex()
    for batch in batches:
        for doc_id, digest in rows_of(batch, "doc_id", "digest"):
            index.add(digest, doc_id, 1)
        if len(index.content) > PARTIAL_ENTRIES:
            yield groups(index)
            index = CuckooIndex()
    yield groups(index)


def _bucket(digest: str, bits: int) -> Column:
    return F.conv(F.substring(F.hex(digest), 1, 8), 16, 10).cast("bigint").bitwiseAND((1 << bits) - 1).cast("int")


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Events in the order of their buckets, to a row per bucket."""
    schema = pa.schema(
        [("bucket", pa.int32()), ("slots", pa.binary()), ("digests", pa.list_(pa.binary())), ("keep_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64()))]
    )
    index, at, done, held = CuckooIndex(), None, [], 0
    for batch in batches:
        for bucket, kind, digest, keep_id, rows, row in rows_of(batch, "bucket", "kind", "digest", "keep_id", "rows", "stored"):
            if bucket != at:
                if at is not None:
                    done.append(index.row(at))
                    held += len(index.content)
                index, at = CuckooIndex(), bucket
                if held > PARTIAL_ENTRIES:
                    yield pa.RecordBatch.from_pylist(done, schema)
                    done, held = [], 0
            if kind == STORED:
                index = CuckooIndex.load(row)
            elif kind == REMOVE:
                index.remove(digest)
            else:
                index.add(digest, keep_id, rows)
    if at is not None:
        done.append(index.row(at))
    yield pa.RecordBatch.from_pylist(done, schema)


def _added(rows: DataFrame, bits: int) -> DataFrame:
    merged = rows.mapInArrow(_merged, "digest binary, keep_id bigint, rows bigint")
    return merged.select(
        _bucket("digest", bits).alias("bucket"), F.lit(ADD).alias("kind"), "digest", "keep_id", "rows", F.lit(None).cast(EVENT_SCHEMA.split("stored ")[1]).alias("stored")
    )


def _index(events: DataFrame) -> DataFrame:
    spread = events.repartition(partitions(events), "bucket").sortWithinPartitions("bucket", "kind")
    return spread.mapInArrow(_applied, INDEX_SCHEMA)


def bucket_bits(rows: int) -> int:
    """How many bits of a digest name its bucket in an index of so many rows."""
    return min(MOST_BITS, max(BUCKET_BITS, (rows // BUCKET_ROWS).bit_length()))


def build_index(rows: DataFrame, bits: int = BUCKET_BITS) -> DataFrame:
    """The index of the rows (doc_id, digest), a row per bucket that has digests."""
    return _index(_added(rows, bits))


def update_index(
    index: DataFrame, added: DataFrame, removed: DataFrame, remaining: DataFrame, bits: int = BUCKET_BITS
) -> DataFrame:
    """The index after rows (doc_id, digest) were added and removed.

    ``remaining`` has the rows that the index covered and that were not removed, and ``bits`` are those it was built with. A digest that lost
    rows is deleted, and inserted again with what remains of its group.
    """
    lost = removed.select("digest").distinct()
    left = remaining.join(lost, "digest", "left_semi").select("doc_id", "digest")
    empty = F.lit(None).cast(EVENT_SCHEMA.split("stored ")[1])
    events = index.select(
        "bucket", F.lit(STORED).alias("kind"), F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("bigint").alias("keep_id"),
        F.lit(None).cast("bigint").alias("rows"), F.struct("slots", "digests", "keep_ids", "sizes").alias("stored"),
    )
    events = events.union(
        lost.select(_bucket("digest", bits), F.lit(REMOVE), "digest", F.lit(None).cast("bigint"), F.lit(None).cast("bigint"), empty)
    )
    return _index(events.union(_added(added.select("doc_id", "digest").union(left), bits)))


def content(index: DataFrame) -> DataFrame:
    """(digest, keep_id, group_size) of every live digest."""
    rows = index.select(F.explode(F.arrays_zip("digests", "keep_ids", "sizes")).alias("r"))
    return rows.select(F.col("r.digests").alias("digest"), F.col("r.keep_ids").alias("keep_id"), F.col("r.sizes").alias("group_size"))


def _members(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, rows, keep_id, group_size), repeated rows counted."""
    found = stored(digests(docs), "digests")
    groups = content(build_index(found, bucket_bits(found.count()))).where("group_size > 1").withColumnRenamed("digest", "_digest")
    members = found.groupBy("doc_id", "digest").agg(F.count("*").alias("rows"))
    return members.join(groups, F.col("digest") == F.col("_digest"), "left").select(
        "doc_id",
        "digest",
        "rows",
        F.when(F.col("_digest").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
    )


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row, dropped ones too."""
    rows = _members(docs).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return rows.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """Of equal texts the row with the largest doc_id; all columns are kept.

    Of rows with equal doc_id and text, the one whose other columns come first as text.
    """
    grouped = stored(_members(docs).where("group_size > 1"), "exact-groups")
    of_keeper = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    lost = _without(docs, grouped.where(~of_keeper))
    repeated = grouped.where(of_keeper & (F.col("rows") > 1)).select("doc_id", "digest")
    if repeated.isEmpty():
        return lost
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    one = _without(lost, repeated, "left_semi").groupBy("doc_id", _digest(docs).alias(unused_name(docs)))
    one = one.agg(F.min_by(row, F.to_json(row)).alias("row")).select("row.*")
    return _without(lost, repeated).unionByName(one)


def _without(docs: DataFrame, keys: DataFrame, how: str = "left_anti") -> DataFrame:
    doc_id, digest = unused_name(docs), unused_name(docs)
    keys = keys.select(F.col("doc_id").alias(doc_id), F.col("digest").alias(digest))
    return docs.join(keys, docs["doc_id"].eqNullSafe(keys[doc_id]) & (_digest(docs) == keys[digest]), how)
