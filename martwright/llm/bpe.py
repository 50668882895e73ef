"""Byte-pair encoding of whole texts by tree concatenation, and decoding.

A long text is cut into leaves that are encoded in parallel, in other tasks than their neighbours.
Pairs of neighbours are then joined, level by level, until one sequence is left: a window around
the cut is encoded anew and grows until it agrees with both sides; the ids inside the agreement
replace those next to the cut.

When do they agree? A window's ids are wrong only near its edges, and a side's only near the cut. In
between the window must give the ids that the side has, and the splice lies there: at a word's start
after white space, where every splitting pattern starts afresh; or, inside letters that nothing
splits, between tokens that both have on either side of the splice (a sequence of tokens is an
encoding if all neighbouring pairs are). A window that reaches the end of a side replaces all of it.
So the ids are those of the tokenizers library for the whole text.

Nulls and odd inputs: a null or empty text has no ids and decodes to the empty text. Repeated rows
each get their row, and a null doc_id stays null. An empty table gives an empty result. Columns
besides doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm import tokens
from martwright.llm.common import release, rows_of, texts

LEAF = 1 << 15  # characters; longer texts are cut
WINDOW = 64  # characters on each side of a cut, to begin with
SHARED = 3  # tokens around a splice inside a word
OUTPUT_BYTES = 1 << 20  # a batch is handed on when its values reach this size


def cut_text(text: str, leaf: int = LEAF) -> list[str]:
    """Halves of halves, until no part is longer than a leaf."""
    if len(text) <= leaf:
        return [text]
    middle = len(text) // 2
    return cut_text(text[:middle], leaf) + cut_text(text[middle:], leaf)


def _prefix(a: np.ndarray, b: np.ndarray) -> int:
    """The number of leading values that are equal."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def _splice(low: int, high: int, starts: np.ndarray, text: str, unsplit: bool) -> int | None:
    """A token in [low, high), all of them shared, before which two encodings can be joined."""
    for i in range(low + 1, high):
        if starts[i] and tokens.IS_WHITE(text[starts[i] - 1]):
            return i
    if unsplit and high - low > 2 * SHARED:
        return (low + high) // 2
    return None


def join(left: str, left_ids: np.ndarray, right: str, right_ids: np.ndarray, path: str) -> np.ndarray:
    """The ids of ``left + right`` from the ids of both."""
    encode, size = tokens.tokenizer(path).encode, WINDOW
    if not left or not right:
        return left_ids if left else right_ids
    while True:
        tail, head = left[-size:], right[:size]
        both = encode(tail + head, add_special_tokens=False)
        ids, offsets = np.array(both.ids, "<u4"), np.array(both.offsets).reshape(-1, 2)
        unsplit = len(set(both.word_ids)) == 1 and (tail + head).isalpha()
        kept_left, first = 0, 0  # ids that stay on the left; where the window's begin
        if len(tail) < len(left):
            own = encode(tail, add_special_tokens=False)
            own_ids, own_at = np.array(own.ids, "<u4"), np.array(own.offsets).reshape(-1, 2)
            low = len(own_ids) - _prefix(own_ids[::-1], left_ids[::-1])
            high = min(_prefix(own_ids, ids), _prefix(own_at[:, 0], offsets[:, 0]), _prefix(own_at[:, 1], offsets[:, 1]))
            first = _splice(low, high, own_at[:, 0], tail, unsplit)
            kept_left = None if first is None else len(left_ids) - (len(own_ids) - first)
        kept_right, last = len(right_ids), len(ids)
        if len(head) < len(right):
            own = encode(head, add_special_tokens=False)
            own_ids, own_at = np.array(own.ids, "<u4"), np.array(own.offsets).reshape(-1, 2)
            back = own_at[::-1] + len(tail)
            same = min(_prefix(own_ids[::-1], ids[::-1]), _prefix(back[:, 0], offsets[::-1, 0]), _prefix(back[:, 1], offsets[::-1, 1]))
            kept_right = _splice(len(own_ids) - same, _prefix(own_ids, right_ids), own_at[:, 0], head, unsplit)
            last = None if kept_right is None else len(ids) - (len(own_ids) - kept_right)
        if first is not None and last is not None and first <= last:
            return np.concatenate((left_ids[:kept_left], ids[first:last], right_ids[kept_right:]))
        size *= 2


def join_all(parts: list[tuple[str, np.ndarray]], path: str) -> np.ndarray:
    """Neighbours are joined, level by level."""
    while len(parts) > 1:
        pairs = zip(parts[::2], parts[1::2], strict=False)
        joined = [(a + b, join(a, x, b, y, path)) for (a, x), (b, y) in pairs]
        parts = joined + parts[len(joined) * 2 :]
    return parts[0][1]


def encode_text(text: str, path: str, leaf: int = LEAF) -> np.ndarray:
    """The ids of one text, in one process."""
    parts = cut_text(text, leaf)
    return join_all(list(zip(parts, map(tokens.ids, tokens.encode_all(parts, path)), strict=True)), path)


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    done, held = [], 0
    for row in rows:
        done.append(row)
        held += sum(len(v) for v in row if isinstance(v, bytes | str))
        if held > OUTPUT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
            done, held = [], 0
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)


def _encoded(batches: Iterator[pa.RecordBatch], path: str, *columns: str) -> Iterator[tuple]:
    """The columns' values, the last of which is the text, and the text's ids."""
    for batch in batches:
        found = tokens.encode_all((t for (t,) in rows_of(batch, columns[-1])), path)
        for row, encoded in zip(rows_of(batch, *columns), found, strict=True):
            yield *row, encoded
    tokens.units.cache_clear()  # a worker that other tasks use next need not hold the units
    release()


def _long(docs: DataFrame, path: str, leaf: int) -> DataFrame:
    """(doc_id, ids) of texts above a leaf; each text is encoded once, however often it occurs."""
    keyed = docs.where(F.char_length("text") > leaf).withColumn("key", F.unhex(F.sha2("text", 256)))

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.binary()), ("leaf", pa.int32()), ("part", pa.string())])
        rows = ((k, i, t) for b in batches for k, text in rows_of(b, "key", "text") for i, t in enumerate(cut_text(text, leaf)))
        yield from _batches(rows, schema)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.binary()), ("leaf", pa.int32()), ("part", pa.string()), ("ids", pa.binary())])
        yield from _batches(_encoded(batches, path, "key", "leaf", "part"), schema)

    def joined(table: pa.Table) -> pa.Table:
        table = table.sort_by("leaf")
        parts = zip(table["part"].to_pylist(), map(tokens.ids, table["ids"].to_pylist()), strict=True)
        return pa.table({"key": table["key"][:1], "ids": pa.array([join_all(list(parts), path).tobytes()], pa.binary())})

    rows = keyed.select("key", "text").mapInArrow(leaves, "key binary, leaf int, part string").dropDuplicates(["key", "leaf"])
    rows = rows.mapInArrow(encoded, "key binary, leaf int, part string, ids binary")
    whole = rows.groupBy("key").applyInArrow(joined, "key binary, ids binary")
    return keyed.select("doc_id", "key").join(whole, "key").select("doc_id", "ids")


def encode(docs: DataFrame, path: str, leaf: int = LEAF) -> DataFrame:
    """(doc_id, ids) of every row; ids are little-endian unsigned 32-bit integers.

    ``path`` is a file of the tokenizers library that every executor can open.
    """
    docs = texts(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
        yield from _batches(((d, i) for d, _, i in _encoded(batches, path, "doc_id", "text")), schema)

    short = docs.where(F.char_length("text") <= leaf).mapInArrow(run, "doc_id long, ids binary")
    return short.union(_long(docs, path, leaf))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text) of rows of ``encode``; special tokens are shown."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = tokens.tokenizer(path).decode
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("text", pa.string())])
        rows = (row for batch in batches for row in rows_of(batch, "doc_id", "ids"))
        yield from _batches(((d, i, text(tokens.ids(i).tolist(), skip_special_tokens=False)) for d, i in rows), schema)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def transcode(docs: DataFrame, path: str, leaf: int = LEAF) -> DataFrame:
    """(doc_id, ids, text) of every row: what ``decode`` gives for ``encode``.

    Texts of one leaf are decoded by the process that has encoded them, so that a core holds one
    tokenizer.
    """
    docs = texts(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("text", pa.string())])
        decoded = tokens.tokenizer(path).decode
        rows = _encoded(batches, path, "doc_id", "text")
        yield from _batches(((d, i, decoded(tokens.ids(i).tolist(), skip_special_tokens=False)) for d, _, i in rows), schema)

    short = docs.where(F.char_length("text") <= leaf).mapInArrow(run, "doc_id long, ids binary, text string")
    return short.union(decode(_long(docs, path, leaf), path))


def digests(docs: DataFrame, path: str, leaf: int = LEAF) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row, encoded and decoded."""
    return transcode(docs, path, leaf).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
