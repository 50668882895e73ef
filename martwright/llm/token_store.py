"""A store of token ids in directly addressable codes.

An id is split into eight-bit chunks, the lowest first. Level 0 has the lowest chunk of every id and
a bitmap that says which ids go on; level k has chunk k of those that do. Each bitmap has a rank
directory (the ones before every block of 512 bits), so the place of an id's next chunk is one count
away: any token is read without decoding others. Frequent ids are small, and take one byte.

Files: Parquet with a row per segment of whole documents in ascending doc_id order, and the codes
as binary columns. Spark writes and reads them, so the store may lie wherever Spark can write, and
a lost executor's segments are written again. A segment ends after SEGMENT_TOKENS ids.

Order: ascending doc_id, nulls first, equal ids by the hash of their text. Texts are dealt to ranges of
both, of equally many rows and about RANGE_BYTES of text, by Spark's range partitioning; so an id with
very many rows is split by the hash. Each range is sorted and encoded by a task of its own.

Nulls and odd inputs: a null or empty text has the end id alone. Repeated rows are stored as often
as they occur. An empty table gives an empty store. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwright.llm import tokens
from martwright.llm.common import partitions, release, rows_of, texts
from martwright.sources.tables import scratch_path

CHUNK_BITS = 8
LEVELS = 4  # of 8 bits: every unsigned 32-bit id
RANK_BLOCK = 512
SEGMENT_TOKENS = 1 << 17
BATCH_BYTES = 1 << 20
RANGE_BYTES = 16 << 20
STORE_SCHEMA = "range int, segment int, n_docs long, n_tokens long, doc_ids array<bigint>, lengths array<bigint>, chunks array<binary>, bitmaps array<binary>, ranks array<binary>"


class Codes:
    """Ids in directly addressable codes."""

    def __init__(self, chunks: list[bytes], bitmaps: list[bytes], ranks: list[bytes]) -> None:
        self.chunks = [np.frombuffer(c, np.uint8) for c in chunks]
        self.bitmaps = [np.frombuffer(b, "<u8") for b in bitmaps]
        self.ranks = [np.frombuffer(r, "<u4") for r in ranks]

    @staticmethod
    def pack(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
        chunks, bitmaps, ranks, rest = [], [], [], ids.astype("<u4")
        for _ in range(LEVELS):
            more = rest >> CHUNK_BITS
            goes_on = more > 0
            words = -len(rest) % RANK_BLOCK
            bits = np.packbits(np.concatenate((goes_on, np.zeros(words, bool))), bitorder="little")
            ones = np.bitwise_count(bits.view("<u8")).reshape(-1, RANK_BLOCK // 64).sum(axis=1, dtype="<u4")
            chunks.append(rest.astype(np.uint8).tobytes())
            bitmaps.append(bits.tobytes())
            ranks.append((np.cumsum(ones, dtype="<u4") - ones).astype("<u4").tobytes())
            rest = more[goes_on]
            if not len(rest):
                break
        return chunks, bitmaps, ranks

    def take(self, at: np.ndarray) -> np.ndarray:
        """The ids at any positions."""
        out = np.zeros(len(at), "<u4")
        here = np.arange(len(at))
        for level, chunk in enumerate(self.chunks):
            out[here] |= chunk[at].astype("<u4") << np.uint32(CHUNK_BITS * level)
            goes_on = self._bits(level, at)
            here, at = here[goes_on], self._rank(level, at[goes_on])
            if not len(at):
                break
        return out

    def _bits(self, level: int, at: np.ndarray) -> np.ndarray:
        return (self.bitmaps[level][at >> 6] >> (at & 63).astype("<u8") & np.uint64(1)).astype(bool)

    def _rank(self, level: int, at: np.ndarray) -> np.ndarray:
        """The number of ones before each position: the directory's, and those in the block."""
        words, block = self.bitmaps[level], at // RANK_BLOCK
        found = self.ranks[level][block].astype(np.int64)
        for i in range(RANK_BLOCK // 64 - 1):
            word = block * (RANK_BLOCK // 64) + i
            found += np.where(word < at >> 6, np.bitwise_count(words[word]), 0)
        below = (np.uint64(1) << (at & 63).astype("<u8")) - np.uint64(1)
        return found + np.bitwise_count(words[at >> 6] & below)


def _segments(batches: Iterator[pa.RecordBatch], end_id: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("range", pa.int32()), ("segment", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64()))]
        + [(n, pa.list_(pa.binary())) for n in ("chunks", "bitmaps", "ranks")]
    )
    end = np.array([end_id], "<u4").tobytes()

    def row(key: tuple[int, int], held: list[tuple[int | None, bytes]]) -> pa.RecordBatch:
        ids = np.frombuffer(b"".join(x + end for _, x in held), "<u4")
        docs, lengths = [d for d, _ in held], [len(x) // 4 + 1 for _, x in held]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*key, len(held), len(ids), docs, lengths, *Codes.pack(ids)), schema)], schema=schema)

    at, held, size = (None, 0), [], 0
    for batch in batches:
        for place, doc_id, encoded in rows_of(batch, "range", "doc_id", "ids"):
            if held and (place != at[0] or size >= SEGMENT_TOKENS):
                yield row(at, held)
                at, held, size = (at[0], at[1] + 1), [], 0
            if place != at[0]:
                at = (place, 0)
            held.append((doc_id, encoded))
            size += len(encoded) // 4 + 1
    if held:
        yield row(at, held)
    release()


def write_store(docs: DataFrame, path: str, to: str, end_id: int = 2, ranges: int | None = None) -> None:
    """Encode every whole text with the tokenizer file ``path`` and write the store into ``to``."""
    docs = texts(docs).withColumn("tie", F.xxhash64("text"))
    if ranges is None:
        ranges = max(partitions(docs), (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // RANGE_BYTES)
    schema = pa.schema([("range", pa.int32()), ("doc_id", pa.int64()), ("ids", pa.binary())])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, held = [], 0
        for batch in batches:
            found = tokens.encode_all((t for (t,) in rows_of(batch, "text")), path)
            for row, ids in zip(rows_of(batch, "range", "doc_id"), found, strict=True):
                done.append((*row, ids))
                held += len(ids)
                if held > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
                    done, held = [], 0
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

    order = [F.col("doc_id").asc_nulls_first(), F.col("tie").asc()]
    rows = docs.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    rows = rows.select(F.spark_partition_id().alias("range"), "doc_id", "text")
    rows.mapInArrow(lambda it: _segments(encoded(it), end_id), STORE_SCHEMA).write.parquet(to)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The segments of a store, a row each."""
    return spark.read.schema(STORE_SCHEMA).parquet(path)


def starts(store: DataFrame) -> DataFrame:
    """(range, segment, start, end): the ids before each segment, and with it.

    The sums run over the segments of a range, and over one row per range; codes are not read.
    """
    sizes = store.select("range", "segment", "n_tokens")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sizes.groupBy("range").agg(F.sum("n_tokens").alias("n"))
    ranges = ranges.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("range").orderBy("segment").rowsBetween(Window.unboundedPreceding, 0)
    sums = sizes.withColumn("sum", F.sum("n_tokens").over(inside)).join(ranges, "range")
    end = F.col("base") + F.col("sum")
    return sums.select("range", "segment", (end - F.col("n_tokens")).alias("start"), end.alias("end"))


def read_documents(store: DataFrame) -> DataFrame:
    """(range, segment, at, doc_id, n_tokens, ids) of every document, read by its address.

    ``at`` is the document's place in its segment; ``starts`` has the segment's place in the store.
    """
    schema = pa.schema([("range", pa.int32()), ("segment", pa.int32()), ("at", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
    wanted = ("range", "segment", "doc_ids", "lengths", "chunks", "bitmaps", "ranks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, segment, doc_ids, lengths, *levels in rows_of(batch, *wanted):
                codes, ends = Codes(*levels), np.cumsum(lengths)
                begins, i = ends - lengths, 0
                while i < len(lengths):
                    j = max(i + 1, int(np.searchsorted(ends, begins[i] + BATCH_BYTES // 4, "right")))
                    ids = codes.take(np.arange(begins[i], ends[j - 1]))
                    parts = np.split(ids, ends[i : j - 1] - begins[i])
                    columns = [place] * (j - i), [segment] * (j - i), begins[i:j], doc_ids[i:j], lengths[i:j], [p.tobytes() for p in parts]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
                    i = j

    return store.select(*wanted).mapInArrow(run, "range int, segment int, at long, doc_id long, n_tokens long, ids binary")


def token(store: DataFrame, positions: DataFrame) -> DataFrame:
    """(position, id) of the tokens at the distinct ``position`` values, each read by its address.

    Positions beyond the store, and nulls, have no row.
    """
    schema = pa.schema([("position", pa.int64()), ("id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, at, *levels in rows_of(batch, "start", "at", "chunks", "bitmaps", "ranks"):
                found = Codes(*levels).take(np.array(at) - start)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(found.astype("i8"))], schema=schema)

    spans = starts(store).withColumn("bin", F.explode(F.expr(f"sequence(start div {SEGMENT_TOKENS}, end div {SEGMENT_TOKENS})")))
    asked = positions.select(F.col("position").cast("long")).distinct().withColumn("bin", F.expr(f"position div {SEGMENT_TOKENS}"))
    hits = asked.join(spans, "bin").where("position >= start and position < end")
    hits = hits.groupBy("range", "segment", "start", F.expr("position div 65536")).agg(F.collect_list("position").alias("at"))
    hits = hits.select("range", "segment", "start", "at").join(store, ["range", "segment"])
    return hits.select("start", "at", "chunks", "bitmaps", "ranks").mapInArrow(run, "position long, id long")


def crcs(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files written for them."""
    to = scratch_path(docs.sparkSession, "tokens")
    write_store(docs, path, to, end_id)
    store = read_store(docs.sparkSession, to)
    found = read_documents(store).select("range", "segment", "at", "doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    found = found.join(starts(store), ["range", "segment"])
    return found.select("doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
