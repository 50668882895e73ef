"""Phrase collocations, counted by multikey three-way quicksort of suffix pointers.

Texts are cut into pieces and words; every word begins a suffix of up to ``LONGEST`` words of its piece.
Suffixes are routed globally by their leading words, so a task gets all suffixes that begin with them,
and sorts pointers to them by three-way quicksort: one word of depth at a time, into those before, equal
to and behind a pivot. The size of an equal partition is the count of its phrase, and a partition
smaller than ``LEAST`` is abandoned, as no phrase in it can reach that count. Phrases of all their words
are routed whole, so nothing is approximate.

Routing goes by two words. A pair that begins more than a ``HEAVY``-th of all suffixes is routed by three
words, a triple like that by four; the sizes of what such a group shares are parts of a count, are never
abandoned, and are summed afterwards. Equal suffixes are one with a weight before the shuffle, so a
passage that thousands of documents share is sent once per task and window. A first pass over the
texts counts words and finds the heavy beginnings: hashes, at most 4 * HEAVY of them, are what is sent
to the tasks. Suffixes travel as arrays, with the words of an array once.

Scores are exact decimals. Counts of parts are looked up with hot words joined by broadcast.

Nulls and odd inputs: a null text is an empty one and has no words, a null lang is ``und``. Very long
texts pass through in blocks that overlap by a suffix. Repeated rows and null doc_ids count each. Equal
scores and counts are ranked by the phrase's bytes. An empty table gives an empty result. Columns besides
text and lang are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.common import looked_up, partitions, release, rows_of, stored, text_of

LONGEST, LEAST, SUBSUMED = 4, 30, 80
HEAVY = 1024  # beginnings that hold more than a HEAVY-th of all suffixes are split
TOGETHER = 8 << 20  # bytes of text whose suffixes are sorted together before the shuffle
ROW = 8000  # suffixes of a row; their distinct words have numbers of 16 bits
GROUP = 1 << 21  # suffixes that a group has, about
# Fixed: the ends of pieces; a full stop stands for all of them, a blank for a tab.
PLAIN = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b".......... ")
STOP = b"."


def _words(text: bytes) -> list[bytes]:
    """The words, with a stop wherever a piece ends."""
    return text.lower().translate(PLAIN).replace(STOP, b" . ").split()


class Suffixes:
    """The suffixes that begin at the first ``starts`` of some words, as arrays of word numbers."""

    def __init__(self, lang: str, found: list[bytes], starts: int) -> None:
        numbers: defaultdict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        stop = numbers[STOP]
        codes = np.fromiter(map(numbers.__getitem__, found), np.int32, len(found))
        self.lang, self.words = lang, list(numbers)
        begins = np.flatnonzero(codes[:starts] != stop)
        ahead = np.concatenate((codes, np.full(LONGEST, stop, np.int32)))
        columns, open_ = [codes[begins]], np.ones(len(begins), bool)
        for k in range(1, LONGEST):
            word = ahead[begins + k]
            open_ = open_ & (word != stop)
            columns.append(np.where(open_, word, -1))
        self.columns = columns
        seed = zlib.crc32(lang.encode("utf-8", "surrogatepass"))
        hashes = [xxhash.xxh64_intdigest(w, seed) for w in self.words]
        self.hashes = np.array([*hashes, 0], np.uint64)  # the last for words that are not there

    def first(self, n: int, rows: np.ndarray | None = None) -> np.ndarray:
        """A hash of the first n words of every suffix."""
        found = np.uint64(n)
        for column in self.columns[:n]:
            found = (found ^ self.hashes[column if rows is None else column[rows]]) * np.uint64(0x9E3779B97F4A7C15)
            found ^= found >> np.uint64(29)
        return found.astype(np.int64)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[Suffixes]:
    """All suffixes of the texts; few texts, or a block of one, at a time."""
    held: defaultdict[str, list[bytes]] = defaultdict(list)
    size = 0
    for batch in batches:
        for lang, text in rows_of(batch, "lang", "text"):
            begin, carried = 0, []
            while (end := text.find(b" ", begin + TOGETHER)) >= 0:
                found = [*carried, *_words(text[begin:end])]
                starts = max(0, len(found) - LONGEST + 1)
                yield Suffixes(lang, found, starts)
                begin, carried = end, found[starts:]
            rest = b" ".join([*carried, text[begin:]])
            held[lang].append(rest)
            size += len(rest)
            if size >= TOGETHER:
                yield from _whole(held)
                held.clear()
                size = 0
    yield from _whole(held)


def _whole(held: dict[str, list[bytes]]) -> Iterator[Suffixes]:
    for lang, some in held.items():
        found = _words(STOP.join(some))
        yield Suffixes(lang, found, len(found))


def _texts(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang")
    return docs.select(lang, text_of(docs).cast("binary").alias("text"))


def beginnings(docs: DataFrame) -> DataFrame:
    """(lang, size, word, hash, n): counts of all words (size 1), and of beginnings of two and three
    words that are heavy among the suffixes they were found with, by their hash."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for window in _windows(batches):
            total = len(window.columns[0])
            counts = np.bincount(window.columns[0], minlength=len(window.words))
            used = np.flatnonzero(counts)
            rows = [(1, window.words[w], None, n) for w, n in zip(used.tolist(), counts[used].tolist(), strict=True)]
            for n in (2, 3):
                values, counts = np.unique(window.first(n, np.flatnonzero(window.columns[n - 1] >= 0)), return_counts=True)
                heavy = counts * HEAVY > total
                rows += [(n, None, h, c) for h, c in zip(values[heavy].tolist(), counts[heavy].tolist(), strict=True)]
            if rows:
                size, word, hash_, count_ = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([window.lang] * len(rows), pa.string()), pa.array(size, pa.int32()), pa.array(word, pa.binary()), pa.array(hash_, pa.int64()), pa.array(count_, pa.int64())],
                    ["lang", "size", "word", "hash", "n"],
                )
        release()

    found = _texts(docs).mapInArrow(count, "lang string, size int, word binary, hash long, n long")
    return found.groupBy("lang", "size", "word", "hash").agg(F.sum("n").alias("n"))


def routed(docs: DataFrame, heavy: dict[int, list[int]], buckets: int) -> DataFrame:
    """(lang, whole, bucket, words, w0.., n): the suffixes by their leading words.

    ``whole`` is the number of words that all suffixes of a bucket are routed by; phrases of as many
    words are complete there.
    """
    names = [f"w{k}" for k in range(LONGEST)]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {n: np.array(sorted(h), np.int64) for n, h in heavy.items()}
        for window in _windows(batches):
            some = np.flatnonzero(window.columns[1] >= 0)  # words alone are counted before
            if not len(some):
                continue
            columns, weights = _merged([c[some] for c in window.columns])
            window.columns = columns
            whole = np.full(len(weights), 2)
            for n in (2, 3):
                whole += (whole == n) & np.isin(window.first(n), known[n])
            hashes = np.select([whole == 2, whole == 3], [window.first(2), window.first(3)], window.first(4))
            bucket = (hashes.astype(np.uint64) >> np.uint64(8)) % np.uint64(buckets)
            place = whole * buckets + bucket.astype(np.int64)
            order = np.argsort(place, kind="stable")
            ends = np.flatnonzero(np.diff(place[order])) + 1
            rows = []
            for part in np.split(order, ends):
                for begin in range(0, len(part), ROW):
                    rows.append(_row(window, part[begin : begin + ROW], columns, weights, int(place[part[0]]), buckets))
            for begin in range(0, len(rows), 64):
                some_rows = rows[begin : begin + 64]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([window.lang] * len(some_rows), pa.string()),
                        pa.array([r[0] for r in some_rows], pa.int32()),
                        pa.array([r[1] for r in some_rows], pa.int64()),
                        pa.array([r[2] for r in some_rows], pa.binary()),
                        *(pa.array([r[3][k] for r in some_rows], pa.list_(pa.int16())) for k in range(LONGEST)),
                        pa.array([r[4] for r in some_rows], pa.list_(pa.int32())),
                    ],
                    ["lang", "whole", "bucket", "words", *names, "n"],
                )
        release()

    columns = ", ".join(f"{n} array<smallint>" for n in names)
    return _texts(docs).mapInArrow(route, f"lang string, whole int, bucket long, words binary, {columns}, n array<int>")


def _merged(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct suffixes, sorted, and how often each occurs."""
    head = columns[0].astype(np.int64) << 32 | (columns[1].astype(np.int64) + 1)
    tail = (columns[2].astype(np.int64) + 1) << 32 | (columns[3].astype(np.int64) + 1)
    order = np.lexsort((tail, head))
    head, tail = head[order], tail[order]
    new = np.concatenate(([True], (np.diff(head) != 0) | (np.diff(tail) != 0)))
    begins = np.flatnonzero(new)
    return [c[order[begins]] for c in columns], np.diff(np.append(begins, len(order))).astype(np.int32)


def _row(window: Suffixes, rows: np.ndarray, columns: list[np.ndarray], weights: np.ndarray, place: int, buckets: int) -> tuple:
    """One row of suffixes; its words are numbered anew, -1 stays for none."""
    own = np.stack([c[rows] for c in columns])
    used, codes = np.unique(own, return_inverse=True)
    missing = 1 if used[0] < 0 else 0
    codes = (codes.reshape(own.shape) - missing).astype(np.int16)
    words = b" ".join(window.words[w] for w in used[missing:].tolist())
    return place // buckets, place % buckets, words, codes, weights[rows]


def frequent(columns: list[np.ndarray], weights: np.ndarray, whole: int, least: int = LEAST) -> Iterator[tuple[tuple[int, ...], int]]:
    """(phrase, count) of two words and more, by three-way quicksort of pointers to suffixes.

    Phrases of fewer than ``whole`` words are counted in part and come whatever their size.
    """
    stack: list[tuple[np.ndarray, int, tuple[int, ...]]] = [(np.arange(len(weights)), 0, ())]
    while stack:
        pointers, depth, prefix = stack.pop()
        keys = columns[depth][pointers]
        middle = len(keys) // 2
        pivot = sorted((keys[0], keys[middle], keys[-1]))[1]
        # Below a heavy beginning even a small partition holds a part of a large count.
        spare = least if whole == 2 or depth >= whole - 1 else 1
        less, more = keys < pivot, keys > pivot
        for part in (less, more):
            rest = pointers[part]
            if len(rest) and weights[rest].sum() >= spare:
                stack.append((rest, depth, prefix))
        same = pointers[~(less | more)]
        size = int(weights[same].sum())
        if size < spare:
            continue
        phrase = (*prefix, int(pivot))
        if depth:
            yield phrase, size
        if depth + 1 < len(columns):
            same = same[columns[depth + 1][same] >= 0]
            deeper = least if whole == 2 or depth + 1 >= whole - 1 else 1
            if len(same) and weights[same].sum() >= deeper:
                stack.append((same, depth + 1, phrase))


def _counted(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The phrases of one group of routed suffixes."""
    lang, whole = key[0].as_py(), key[1].as_py()
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    columns: list[list[np.ndarray]] = [[] for _ in range(LONGEST)]
    weights = []
    for batch in batches:
        for i in range(batch.num_rows):
            words = batch.column("words")[i].as_py().split(b" ")
            own = np.fromiter((*map(numbers.__getitem__, words), -1), np.int32, len(words) + 1)
            for k, column in enumerate(columns):
                column.append(own[batch.column(f"w{k}")[i].values.to_numpy()])
            weights.append(batch.column("n")[i].values.to_numpy())
    joined = [np.concatenate(c) for c in columns]
    names, found = list(numbers), []

    def rows() -> pa.RecordBatch:
        phrases, sizes, counts = zip(*found, strict=True)
        arrays = [pa.array([lang] * len(found), pa.string()), pa.array(phrases, pa.binary()), pa.array(sizes, pa.int32()), pa.array(counts, pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, ["lang", "phrase", "size", "n"])

    for phrase, count in frequent(joined, np.concatenate(weights).astype(np.int64), whole):
        found.append((b" ".join(names[w] for w in phrase), len(phrase), count))
        if len(found) == 10_000:
            yield rows()
            found.clear()
    if found:
        yield rows()
    release()


def phrase_counts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, n) of all phrases of at least ``LEAST`` occurrences, and (lang, n) of all words."""
    begun = stored(beginnings(docs), "beginnings")
    totals = begun.where("size = 1").groupBy("lang").agg(F.sum("n").alias("n"))
    total = totals.agg(F.sum("n")).first()[0] or 0
    heavy: dict[int, list[int]] = {2: [], 3: []}
    for r in begun.where("size > 1").groupBy("size", "hash").agg(F.sum("n").alias("n")).where(F.col("n") * 2 * HEAVY > total).collect():
        heavy[r["size"]].append(r["hash"])
    buckets = max(partitions(docs), total // GROUP)
    suffixes = routed(docs, heavy, buckets)
    found = suffixes.groupBy("lang", "whole", "bucket").applyInArrow(_counted, "lang string, phrase binary, size int, n long")
    found = found.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))
    words = begun.where("size = 1").select("lang", F.col("word").alias("phrase"), "size", "n")
    counts = words.union(found).where(F.col("n") >= LEAST)
    return stored(counts.withColumn("phrase", F.col("phrase").cast("string")), "phrase-counts"), totals


def _part(begin: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice("words", begin, length), " ")


def collocations(docs: DataFrame, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` collocations."""
    counts, totals = phrase_counts(docs)
    phrases = counts.where("size > 1").withColumnRenamed("n", "a").withColumn("words", F.split("phrase", " "))
    parts = F.explode(
        F.flatten(
            F.transform(
                F.sequence(F.lit(1), F.col("size") - 1),
                lambda k: F.array(
                    F.struct(k.alias("k"), F.lit(True).alias("leading"), _part(F.lit(1), k).alias("part")),
                    F.struct(k.alias("k"), F.lit(False).alias("leading"), _part(k + 1, F.col("size") - k).alias("part")),
                ),
            )
        )
    )
    cuts = phrases.select("lang", "phrase", "a", parts.alias("cut")).select("lang", "phrase", "a", "cut.*")
    uses = cuts.groupBy("lang", "part").agg(F.count("*").alias("uses"))
    known = counts.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    counted = looked_up(cuts, stored(uses.join(known, ["lang", "part"]), "part-counts"), ["lang", "part"], "f", weight="uses")
    leading = F.col("leading")
    cut = counted.groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(leading, F.col("f"))).alias("l"), F.max(F.when(~leading, F.col("f"))).alias("r"))
    score = F.expr("(2000000 * cast(a as decimal(20, 0))) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    lowest = cut.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("size") - 1),
            lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda begin: _part(begin, n)),
        )
    )
    longer = phrases.where("size > 2").select("lang", F.explode(inner).alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = scored.join(longer, ["lang", "phrase"], "left").where(F.expr(f"longer IS NULL OR 100 * cast(longer as decimal(20, 0)) < {SUBSUMED} * cast(a as decimal(20, 0))"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
