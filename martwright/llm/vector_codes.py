"""Vectors as short codes: a codebook per part, nearest entries found by Orchard's search.

Components become whole numbers, floor(256 * x); a vector is cut into ``PARTS`` equal parts, and each part
is replaced by the index of the nearest entry of its position's codebook. Codebooks start as the parts
of the ``ENTRIES`` first vectors by id, and every round replaces an entry by the floored mean of the
parts that chose it. All of it is exact, in whole numbers.

Orchard's search keeps, for every entry, all others of its codebook sorted by their distance. It walks
along the list of the entry that is nearest so far, marks whom it visits, jumps to the list of an
entry that is nearer, and stops where the list goes beyond twice the distance in hand: by the triangle
inequality nobody there is nearer. Many parts walk at a time, as arrays. Ties go to the lower index; an
entry exactly at twice the distance is still looked at, as it may tie.

The corpus is read once per round, in tasks that send one sum and count per entry and component; the
driver holds codebooks only (ENTRIES x dimension numbers, whatever the input). Errors are summed by
label with map-side sums; labels that few rows share are joined by shuffle, hot ones by broadcast.

Nulls and odd inputs: rows whose vector is null, or has a null or non-finite component, are left out.
So are vectors of a length other than that of the first vector (by id) that can be cut into equal parts.
Vectors with equal ids are ordered by their components for the choice of the first entries, a null id
comes last; repeated rows count each. Fewer vectors than entries make smaller codebooks. Null labels
are one label. Components too large for exact 64-bit distances are computed with Python's integers,
and an error that does not fit a long is null, as is
the sum over its label. An empty table gives an empty result. Columns
besides vec_id, embedding and label are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import looked_up, release, stored

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE = 256.0
EXACT = 1 << 24  # components below this have squared distances in 64 bits, for parts of up to 2**13 numbers
ROWS = 4096  # vectors that walk together

Codebooks = list[list[list[int]]]  # part, entry, component


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows whose vector has nothing but finite components."""
    rows = vectors.select(
        vectors["vec_id"].cast("long").alias("vec_id"),
        vectors["label"].alias("label"),
        vectors["embedding"].cast("array<double>").alias("embedding"),
    )
    limit = F.lit(float("inf"))

    def finite(x: Column) -> Column:
        return F.coalesce((F.abs(x) < limit) & ~F.isnan(x), F.lit(False))

    return rows.where(F.col("embedding").isNotNull() & F.forall("embedding", finite))


def _floored(values: np.ndarray) -> np.ndarray:
    """floor(256 * x) as 64-bit integers, or as Python's where those are not enough."""
    scaled = np.floor(values * SCALE)
    if not len(values) or np.abs(scaled).max() < EXACT:
        return scaled.astype(np.int64)
    return np.array([int(np.floor(x)) * int(SCALE) if np.isinf(y) else int(y) for x, y in zip(values, scaled, strict=True)], object)


def first_entries(rows: DataFrame, dimension: int, parts: int, entries: int) -> Codebooks:
    order = (F.col("vec_id").asc_nulls_last(), F.col("embedding"))
    first = rows.where(F.size("embedding") == dimension).orderBy(*order).limit(entries).select("embedding").collect()
    vectors = [_floored(np.array(r[0], np.float64)).tolist() for r in first]
    size = dimension // parts
    return [[v[p * size : (p + 1) * size] for v in vectors] for p in range(parts)]


class Searcher:
    """The neighbour lists of one codebook, and the search along them."""

    def __init__(self, entries: Sequence[Sequence[int]]) -> None:
        large = any(abs(x) >= EXACT for e in entries for x in e)
        self.entries = np.array(entries, object if large else np.int64).reshape(len(entries), -1)
        apart = self.entries[:, None, :] - self.entries[None, :, :]
        distances = (apart * apart).sum(axis=2)
        self.order = np.argsort(distances, axis=1, kind="stable")
        self.sorted = np.take_along_axis(distances, self.order, axis=1)

    def _distances(self, points: np.ndarray, entries: np.ndarray) -> np.ndarray:
        apart = points - self.entries[entries]
        return (apart * apart).sum(axis=1)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of every point's nearest entry, the lowest index of equal ones."""
        n, size = len(points), len(self.entries)
        best = np.zeros(n, np.int64)
        least = self._distances(points, best)
        visited = np.zeros((n, size), bool)
        visited[:, 0] = True
        walking, place = np.arange(n), np.zeros(n, np.int64)
        while len(walking):
            own = best[walking]
            at = place[walking]
            inside = at < size
            reach = self.sorted[own, np.minimum(at, size - 1)]
            inside &= reach <= 4 * least[walking]  # squared, so four times
            walking, own, at = walking[inside], own[inside], at[inside]
            entry = self.order[own, at]
            fresh = ~visited[walking, entry]
            place[walking] += 1
            asked, entry = walking[fresh], entry[fresh]
            visited[asked, entry] = True
            distance = self._distances(points[asked], entry)
            better = (distance < least[asked]) | ((distance == least[asked]) & (entry < best[asked]))
            jumping, entry = asked[better], entry[better]
            best[jumping], least[jumping], place[jumping] = entry, distance[better], 0
        return best, least


def _points(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of about ROWS rows with their vectors as whole numbers; all have ``dimension`` components."""

    def gathered() -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                held.append(batch.slice(begin, ROWS))
                rows += held[-1].num_rows
                if rows >= ROWS:
                    yield pa.concat_batches(held)
                    held, rows = [], 0
        if rows:
            yield pa.concat_batches(held)

    for part in gathered():
        yield part, _floored(part.column("embedding").flatten().to_numpy(zero_copy_only=False)).reshape(part.num_rows, dimension)


def _assigned(points: np.ndarray, searchers: list[Searcher]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, errors), a column per part."""
    size = points.shape[1] // len(searchers)
    found = [s.nearest(points[:, p * size : (p + 1) * size]) for p, s in enumerate(searchers)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _limbs(number: int) -> Iterator[tuple[int, int]]:
    """(digits, x): the number as a sum of x * 10 ** digits with x below 10 ** 18."""
    sign, rest, digits = (-1 if number < 0 else 1), abs(number), 0
    while rest or not digits:
        rest, x = divmod(rest, 10**18)
        yield digits, sign * x
        digits += 18


def _sums(rows: DataFrame, codebooks: Codebooks, dimension: int) -> DataFrame:
    """(part, entry, component, digits, total, n): what the parts that chose an entry sum up to.

    A sum is that of ``total`` times 10 ** ``digits`` over its rows; most have one, with no digits.
    """
    parts, entries, size = len(codebooks), len(codebooks[0]), dimension // len(codebooks)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searchers = [Searcher(c) for c in codebooks]
        counts = np.zeros((parts, entries), np.int64)
        totals = np.zeros((parts, entries, size), object)
        for _, points in _points(batches, dimension):
            codes, _ = _assigned(points, searchers)
            for p in range(parts):
                own = np.zeros((entries, size), points.dtype)
                np.add.at(own, codes[:, p], points[:, p * size : (p + 1) * size])
                totals[p] += own
                counts[p] += np.bincount(codes[:, p], minlength=entries)
        sums = [
            (p, e, c, digits, total, int(counts[p, e]))
            for p, e in np.argwhere(counts).tolist()
            for c in range(size)
            for digits, total in _limbs(int(totals[p, e, c]))
        ]
        names = ["part", "entry", "component", "digits", "total", "n"]
        columns = zip(*sums, strict=True) if sums else [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
        release()

    found = rows.select("embedding").mapInArrow(add, "part long, entry long, component long, digits long, total long, n long")
    # Rows with digits repeat the count of those without; every sum has one without.
    n = F.sum(F.when(F.col("digits") == 0, F.col("n")))
    return found.groupBy("part", "entry", "component", "digits").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), n.alias("n"))


def trained(rows: DataFrame, dimension: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """The codebooks after ``rounds`` rounds over all vectors; entries that nobody chose stay."""
    codebooks = first_entries(rows, dimension, parts, entries)
    if not dimension or not codebooks[0]:
        return codebooks
    for _ in range(rounds):
        totals: defaultdict[tuple[int, int, int], int] = defaultdict(int)
        counts = {}
        for r in _sums(rows, codebooks, dimension).collect():
            key = r["part"], r["entry"], r["component"]
            totals[key] += int(r["total"]) * 10 ** r["digits"]
            if not r["digits"]:
                counts[key] = r["n"]
        for (p, e, c), total in totals.items():
            codebooks[p][e][c] = total // counts[p, e, c]
    return codebooks


def digest(codebooks: Codebooks) -> str:
    numbers = ",".join(str(x) for part in codebooks for entry in part for x in entry)
    return hashlib.sha256(numbers.encode()).hexdigest()


def codes(rows: DataFrame, codebooks: Codebooks, dimension: int) -> DataFrame:
    """(vec_id, label, code, error) of every vector."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searchers = [Searcher(c) for c in codebooks]
        for part, points in _points(batches, dimension):
            chosen, errors = _assigned(points, searchers)
            code = [bytes(row).hex() for row in chosen.astype(np.uint8)]
            error = [int(e) if e < 1 << 63 else None for e in errors.sum(axis=1).tolist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), part.column("label"), pa.array(code, pa.string()), pa.array(error, pa.int64())],
                ["vec_id", "label", "code", "error"],
            )
        release()

    label = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(encode, f"vec_id long, label {label}, code string, error long")


def dimension_of(rows: DataFrame, parts: int) -> int:
    """The length of the first vector, by id, that has equal parts; 0 if there is none."""
    order = (F.col("vec_id").asc_nulls_last(), F.col("embedding"))
    usable = rows.where((F.size("embedding") > 0) & (F.size("embedding") % parts == 0))
    first = usable.orderBy(*order).limit(1).select(F.size("embedding")).first()
    return first[0] if first else 0


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every vector that is kept."""
    if entries > 256:
        raise ValueError("an index has two hex digits")
    rows = whole_vectors(vectors)
    dimension = dimension_of(rows, parts)
    rows = rows.where(F.size("embedding") == dimension)
    codebooks = trained(rows, dimension, parts, entries, rounds)
    if not dimension:
        rows = rows.limit(0)
    coded = stored(codes(rows, codebooks, dimension), "vector-codes")
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long")
    sums = coded.groupBy("label").agg(F.when(F.count("error") == F.count("*"), total).alias("label_error"), F.count("*").alias("n"))
    found = looked_up(coded, stored(sums, "label-errors"), "label", "label_error", weight="n")
    return found.select("vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))
