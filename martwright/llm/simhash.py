"""Near duplicates by SimHash fingerprints: an inverted index over byte positions.

Two 64-bit fingerprints that differ in at most d bits differ in at most d of their eight bytes, so
at least 8 - d positional bytes are equal. Pairs are found where they share bytes, the equal bytes
of each pair are counted, pairs below the guaranteed number are left out, and the rest is verified
bit by bit.

Postings do not hold one byte: lists of 1/256 of all fingerprints would pair almost everything.
They hold a set of positions with the bytes there, chosen so that any 8 - d positions contain one of
the sets: for d = 3 all triples inside either half of the eight positions (of five positions,
three lie in one half). A list that is still long is dealt anew by two more positions. What is left
to compare then is three bytes at most, so a list cannot have more than 2**24 entries, and long
ones are searched by flipping bits, which costs the same per entry however long the list is.
No pair is dropped on the way, and no list emits all its pairs: it emits a forest with the same
components.

Nulls and odd inputs: a null text counts as empty; a text without words has fingerprint zero and is
linked like any other. A null doc_id is kept in the rows and ignored for the component id (null
only if the component has no other). Repeated rows each get their row. An empty table gives an empty
result. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import release, rows_of, stored, text_of, texts, unused_name
from martwright.llm.components import connected_components

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
SEED = 42
BYTES = 8
CHUNK = 1 << 16  # shingles whose bits are counted at a time
LONG_LIST = 512  # a longer posting list is dealt anew by more positions
FLIP_LIST = 4096  # a longer list is searched by flipping bits instead of comparing pairs


def simhash(text: str, words: int = 3) -> int:
    """A bit is set if it is set in over half of the hashes of all shingles, repeats included."""
    tokens = text.encode("utf-8", "replace").translate(LOWER).split()
    if not tokens:
        return 0
    words = min(words, len(tokens))
    ends = np.cumsum([len(t) + 1 for t in tokens])
    starts = np.concatenate(([0], ends[:-1]))[: len(tokens) - words + 1].tolist()
    ends = (ends - 1)[words - 1 :].tolist()
    joined, digest = b" ".join(tokens), xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for i in range(0, len(starts), CHUNK):
        spans = zip(starts[i : i + CHUNK], ends[i : i + CHUNK], strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > len(starts)).tolist())


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed 64-bit number."""
    return _named_fingerprints(docs, words).select("doc_id", "fp")


def _named_fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, text_hash, fp) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [simhash(t, words) for (t,) in rows_of(batch, "text")]
            fp = pa.array(np.array(found, "u8").view("i8"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), fp], ["doc_id", "text_hash", "fp"])
        release()

    hashed = texts(docs).withColumn("text_hash", F.xxhash64("text"))
    return hashed.mapInArrow(run, "doc_id long, text_hash long, fp long")


def covering(size: int, bits: int) -> list[tuple[int, ...]]:
    """Sets of positions of which every set of BYTES - bits positions contains at least one."""
    if size == 3 and bits == 3:
        return [c for half in (range(4), range(4, 8)) for c in combinations(half, 3)]
    return list(combinations(range(BYTES), size))


def _mask(positions: tuple[int, ...]) -> int:
    mask = sum(0xFF << (8 * p) for p in positions)
    return mask - (1 << 64) if mask >> 63 else mask


def _postings(fps: DataFrame, bits: int) -> DataFrame:
    sets = covering(3, bits) if bits <= 3 else covering(BYTES - bits, bits)
    keys = [F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(_mask(s))).alias("bytes")) for i, s in enumerate(sets)]
    return fps.select("fp", F.explode(F.array(*keys)).alias("key")).select("key.k", "key.bytes", "fp")


def _dealt_anew(long: DataFrame, bits: int) -> DataFrame:
    """Postings of long lists by all sets of BYTES - bits positions around the shared ones."""
    first = covering(3, bits) if bits <= 3 else covering(BYTES - bits, bits)
    wide = covering(BYTES - bits, bits)
    keys = F.lit(None)
    for i, s in enumerate(first):
        own = [F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(_mask(w))).alias("bytes")) for k, w in enumerate(wide) if set(s) <= set(w)]
        keys = F.when(F.col("k") == i, F.array(*own)).otherwise(keys)
    again = long.select("fp", F.explode(keys).alias("key"))
    return again.select("key.k", "key.bytes", "fp").distinct()


def _forest(fps: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links between the fingerprints of one list, as many as join its components."""
    return _flipped(fps, bits) if len(fps) > FLIP_LIST else _compared(fps, bits)


def _compared(fps: np.ndarray, bits: int) -> list[tuple[int, int]]:
    edges, root = [], np.arange(len(fps))
    for i in range(len(fps) - 1):
        rest = np.flatnonzero(root[i + 1 :] != root[i]) + i + 1
        differ = fps[rest] ^ fps[i]
        shared = (differ.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
        rest, differ = rest[shared >= BYTES - bits], differ[shared >= BYTES - bits]
        for j in rest[np.bitwise_count(differ) <= bits].tolist():
            if root[i] != root[j]:
                edges.append((int(fps[i]), int(fps[j])))
                root[root == root[j]] = root[i]
    return edges


def _flipped(fps: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """For lists that share BYTES - bits bytes: every change of up to ``bits`` other bits, looked up."""
    fps = np.sort(fps)
    varying = int(np.bitwise_or.reduce(fps ^ fps[0]))
    free = [1 << i for i in range(64) if varying >> i & 1]
    edges, root = [], np.arange(len(fps))
    for n in range(1, bits + 1):
        for chosen in combinations(free, n):
            other = fps ^ np.uint64(sum(chosen))
            at = np.minimum(np.searchsorted(fps, other), len(fps) - 1)
            hit = np.flatnonzero((fps[at] == other) & (fps < other))
            for i, j in zip(hit.tolist(), at[hit].tolist(), strict=True):
                if (a := _find(root, i)) != (b := _find(root, j)):
                    root[b] = a
                    edges.append((int(fps[i]), int(fps[j])))
    return edges


def _find(root: np.ndarray, i: int) -> int:
    while root[i] != i:
        root[i] = root[root[i]]
        i = root[i]
    return i


def _edges(lists: DataFrame, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("fps")
            ends, flat = column.offsets.to_numpy(), column.values.to_numpy().view("u8")
            edges = [e for a, b in zip(ends, ends[1:], strict=False) for e in _forest(flat[a:b], bits)]
            pairs = np.array(edges, "u8").reshape(-1, 2).view("i8")
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    grouped = lists.groupBy("k", "bytes").agg(F.collect_list("fp").alias("fps"))
    return grouped.where(F.size("fps") > 1).select("fps").mapInArrow(partial(run, bits=bits), "a long, b long")


def links(fps: DataFrame, bits: int = 3) -> DataFrame:
    """(a, b) of distinct fingerprints: a forest with the components of all pairs within ``bits``."""
    postings = _postings(fps, bits)
    sizes = postings.groupBy("k", "bytes").agg(F.count("*").alias("n"))
    long = sizes.where(F.col("n") > LONG_LIST).select("k", "bytes")
    short = sizes.where(F.col("n").between(2, LONG_LIST)).select("k", "bytes")
    hot = postings.join(long, ["k", "bytes"], "left_semi")
    edges = _edges(postings.join(short, ["k", "bytes"], "left_semi"), bits)
    return edges.union(_edges(_dealt_anew(hot, bits), bits))


def near_duplicates(docs: DataFrame, words: int = 3, bits: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id, component_size) of every row of ``docs``.

    Rows with equal fingerprints are one node; nodes link at ``bits`` or fewer differing bits.
    """
    found = _grouped(docs, words, bits)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id", "component_size")


def _grouped(docs: DataFrame, words: int, bits: int) -> DataFrame:
    """(fp, doc_id, text_hash, component_id, component_size) of every row."""
    found = stored(_named_fingerprints(docs, words), "fingerprints")
    nodes = found.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows"))
    parts = connected_components(links(nodes.select("fp"), bits))
    placed = nodes.join(parts.withColumnRenamed("node", "fp"), "fp", "left")
    placed = placed.withColumn("component", F.coalesce("component", "fp"))
    heads = placed.groupBy("component").agg(F.min("first").alias("component_id"), F.sum("rows").alias("component_size"))
    return found.join(placed.select("fp", "component").join(heads, "component").drop("component"), "fp")


def drop_near_duplicates(docs: DataFrame, words: int = 3, bits: int = 3) -> DataFrame:
    """The rows whose doc_id is the smallest of their component; all columns are kept.

    A row goes by its doc_id and text together, so another text under the same doc_id is judged by its
    own component. Of components without any doc_id all rows stay, as do rows without a doc_id and
    further rows with the smallest doc_id.
    """
    found = _grouped(docs, words, bits).where(F.col("doc_id") != F.col("component_id"))
    key, name = unused_name(docs), unused_name(docs)
    dropped = found.select(F.col("doc_id").alias(key), F.col("text_hash").alias(name)).distinct()
    own = (docs["doc_id"].cast("long") == dropped[key]) & (F.xxhash64(text_of(docs)) == dropped[name])
    return docs.join(dropped, own, "left_anti")
