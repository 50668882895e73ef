"""Benchmark decontamination: word windows of the benchmark, looked up in every document.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z in lower
case. Every run of ``size`` words of an item is a window; an item of fewer words, but not none, is
one window. The windows are broadcast as a set of hashes over word numbers; each document's words
are numbered by the benchmark's vocabulary, hashed window by window, and hits are verified word by
word. Only windows all of whose words occur in the benchmark can hit, so most of a text costs one
lookup per word.

The broadcast set has a stated bound (``broadcast_bytes`` of benchmark text, measured before it is
built). A larger benchmark is cut into blocks of items below the bound, and the documents are searched
block by block, with their hits so far in a stored table; the results do not depend on the bound. One
item above the bound is a block of its own.

Nulls and odd inputs: a null text has no words; an item with a null text or without words has no
window. Items with equal windows all count as occurring. Rows of the benchmark with equal item_id
are one item for the count of items; a null item_id counts as an item and is written as an empty
string. Repeated documents each get their row, a null doc_id stays null. An empty benchmark hits
nothing; no documents give no rows. Columns besides doc_id, item_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import small, stored, texts, unused_name

SIZE = 13
BROADCAST_BYTES = 1 << 22
FACTOR = np.uint64(0x9E3779B97F4A7C15)
SPLIT = bytes(32 if chr(i).isascii() and not chr(i).isalnum() else i + 32 if 65 <= i <= 90 else i for i in range(256))


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(SPLIT).split()


def _hashes(numbers: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` word numbers."""
    found = np.zeros(max(0, len(numbers) - size + 1), np.uint64)
    for i in range(size):
        found = found * FACTOR + numbers[i : i + len(found)]
    return found


class Windows:
    """The windows of some benchmark items, to be searched for in documents."""

    def __init__(self, items: list[tuple[str, str]], size: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.names, parts, begins, by_size = [], [], [0], {}
        for name, text in items:
            found = words(text)
            if not found:
                continue
            own = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in found], np.uint64)
            n = min(size, len(own))
            hashes = _hashes(own, n)
            by_size.setdefault(n, []).append((hashes, begins[-1] + np.arange(len(hashes))))
            self.names.append(name)
            parts.append(own)
            begins.append(begins[-1] + len(own))
        self.numbers = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        self.begins = np.array(begins)
        self.windows = {}
        for n, found in sorted(by_size.items()):
            hashes, places = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(hashes, kind="stable")
            self.windows[n] = hashes[order], places[order]

    def numbered(self, found: list[bytes]) -> np.ndarray:
        """Word numbers; 0 is a word that no item has."""
        return np.fromiter(map(self.vocabulary.get, found, repeat(0)), np.uint64, len(found))

    def search(self, numbers: np.ndarray) -> tuple[list[list[int]], set[str]]:
        """The [begin, end] of words inside occurrences of windows, and the items that occur."""
        spans, items = [], set()
        known = np.concatenate(([0], np.cumsum(numbers > 0)))
        for n, (hashes, places) in self.windows.items():
            at = np.flatnonzero(known[n:] - known[:-n] == n)
            if not len(at):
                continue
            own = np.zeros(len(at), np.uint64)
            for i in range(n):
                own = own * FACTOR + numbers[at + i]
            low, high = np.searchsorted(hashes, own), np.searchsorted(hashes, own, "right")
            for i, a, b in zip(*(x[high > low].tolist() for x in (at, low, high)), strict=True):
                same = [p for p in places[a:b].tolist() if (self.numbers[p : p + n] == numbers[i : i + n]).all()]
                if same:
                    spans.append([i, i + n])
                    items.update(self.names[k] for k in np.searchsorted(self.begins, same, "right") - 1)
        return spans, items


def merged(spans: list[list[int]]) -> list[list[int]]:
    found: list[list[int]] = []
    for begin, end in sorted(spans):
        if found and begin <= found[-1][1]:
            found[-1][1] = max(end, found[-1][1])
        else:
            found.append([begin, end])
    return found


def _blocks(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[str, str]]]:
    """Items in blocks below the bound, one block at a time on the driver."""
    item = F.coalesce(benchmark["item_id"].cast("string"), F.lit(""))
    text = F.coalesce(benchmark["text"].cast("string"), F.lit(""))
    items = benchmark.select(item.alias("item"), text.alias("text")).distinct()
    items = items.withColumn("hash", F.xxhash64("item", "text")).withColumn("size", F.octet_length("text"))
    blocks = 1
    while True:
        block = F.pmod("hash", F.lit(blocks))
        sizes = items.groupBy(block.alias("block")).agg(F.sum("size").alias("size"), F.count("*").alias("items"))
        if sizes.where((F.col("size") > limit) & (F.col("items") > 1)).isEmpty():
            break
        blocks *= 2
    for k in range(blocks):
        yield [(r["item"], r["text"]) for r in items.where(block == k).toLocalIterator()]


def _searched(docs: DataFrame, benchmark: DataFrame, size: int, broadcast_bytes: int) -> tuple[DataFrame, list[str]]:
    """The documents with all their columns and three more: words, spans hit and items."""
    n_words, spans, items = names = [unused_name(docs) for _ in range(3)]
    found = docs.withColumns(
        {n_words: F.lit(0).cast("long"), spans: F.lit(None).cast("array<array<long>>"), items: F.lit(None).cast("array<string>")}
    )
    text, searched = found.columns.index(docs.select("text").columns[0]), False
    for block in _blocks(benchmark, broadcast_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(Windows(block, size))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            windows = shared.value
            for batch in small(batches):
                counts, hit, named = [], [], []
                for value, before, known in zip(batch.column(text).to_pylist(), batch.column(spans).to_pylist(), batch.column(items).to_pylist(), strict=True):
                    own = words(value or "")
                    here, occurring = windows.search(windows.numbered(own))
                    counts.append(len(own))
                    hit.append(merged((before or []) + here))
                    named.append(sorted(occurring.union(known or [])))
                new = pa.array(counts, pa.int64()), pa.array(hit, pa.list_(pa.list_(pa.int64()))), pa.array(named, pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-3], *new], batch.schema.names)

        if searched:
            found = stored(found, "occurrences")
        found, searched = found.mapInArrow(run, found.schema), True
    return found, names


def _contaminated(spans: str, n_words: str, share: int) -> tuple[Column, Column]:
    hit = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return hit, (hit > 0) & (hit * share >= F.col(n_words))


def occurrences(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, n_words, spans, items) of every document.

    ``spans`` are the [begin, end) of the words inside windows, in order and apart; ``items`` the
    item_ids with windows that occur, sorted as strings.
    """
    found, names = _searched(texts(docs), benchmark, size, broadcast_bytes)
    return found.select("doc_id", *(F.col(n).alias(to) for n, to in zip(names, ("n_words", "spans", "items"), strict=True)))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, share: int = 20, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every document.

    A document is contaminated if words are hit, and these are at least one in ``share``.
    """
    hit, contaminated = _contaminated("spans", "n_words", share)
    return occurrences(docs, benchmark, size, broadcast_bytes).select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated.alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, share: int = 20, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The documents that are not contaminated, each judged by its own text; all columns are kept."""
    found, (n_words, spans, items) = _searched(docs, benchmark, size, broadcast_bytes)
    return found.where(~_contaminated(spans, n_words, share)[1]).drop(n_words, spans, items)
