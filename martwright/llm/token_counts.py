"""Token counts of whole texts, as a sentencepiece BPE model gives them, by rank-synchronous array merging.

A text is normalised by the library and cut into pre-tokens where no piece of the vocabulary has the
two neighbouring characters, so no merge reaches across. Pre-tokens of many texts are held as one
ragged numpy array of symbols. In every round each sequence's best pair (the highest score, of equal
ones the leftmost) is applied at all its places at once, and sequences without a pair leave the
arrays. What survives is counted: a piece is one token, a character without one as many as its
UTF-8 bytes. The library merges one place at a time; where the merge of a place makes a pair that
would come before the next place, the round stops there for that sequence, so the counts are equal.

Counts of pre-tokens are kept per worker, in two generations. Sequences of more than ``LONG`` symbols
are merged with a heap, in the same order, as their rounds would each pass all symbols.

Nulls and odd inputs: a null text is an empty one and has no bytes and no tokens. Very long texts are
counted whole, in time linear in their length but for the heap's logarithm. Repeated rows each get
a row, a null doc_id stays null. An empty table gives an empty result. Columns besides doc_id and text
are ignored. A model that is not a BPE model with byte fallback, or that has pieces of another kind
(unused ones), raises ValueError.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import release, rows_of, texts

LIMIT = 4096
LONG = 4096  # symbols of a sequence from which on a heap is faster than rounds
CACHED = 400_000  # pre-tokens of a generation
TOGETHER = 1 << 21  # characters of texts whose pre-tokens are merged together
SPACE = "▁"
NONE = np.int64(1) << 40  # the rank of pairs that do not merge


class Table:
    """Whole numbers -> whole numbers from zero, looked up for whole arrays; -1 for the others.

    Numbers lie at the first free place from that of their hash; one place in eight or fewer is taken.
    """

    def __init__(self, known: dict[int, int]) -> None:
        bits = max(4, (8 * len(known)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64)
        keys = np.fromiter(known, np.int64, len(known))
        for key, at, value in zip(known, self._places(keys).tolist(), known.values(), strict=True):
            while self.keys[at] >= 0:
                at = (at + 1) & self.mask
            self.keys[at], self.values[at] = key, value

    def _places(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        at = self._places(keys)
        held = self.keys[at]
        found = np.where(held == keys, self.values[at], -1)
        rest = np.flatnonzero((held != keys) & (held >= 0))
        while len(rest):
            at[rest] = (at[rest] + 1) & self.mask
            held = self.keys[at[rest]]
            hit = held == keys[rest]
            found[rest[hit]] = self.values[at[rest[hit]]]
            rest = rest[~hit & (held >= 0)]
        return found


class Merges:
    """The vocabulary as arrays: symbols of characters, pairs of symbols, ranks and sizes."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        kinds = (model.is_control, model.is_unknown, model.is_byte)
        ids = [i for i in range(model.vocab_size()) if not any(kind(i) for kind in kinds)]
        if any(map(model.is_unused, ids)) or sum(map(model.is_byte, range(model.vocab_size()))) != 256:
            raise ValueError(f"not a plain BPE model with byte fallback: {path}")
        pieces = [model.id_to_piece(i) for i in ids]
        names = pieces + sorted({c for p in pieces for c in p}.difference(pieces))
        symbol = {name: i for i, name in enumerate(names)}
        self.count = len(names)
        scores = np.array([model.get_score(i) for i in ids])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        pairs = {}
        for piece in pieces:
            for k in range(1, len(piece)):
                if piece[:k] in symbol and piece[k:] in symbol:
                    pairs[symbol[piece[:k]] * self.count + symbol[piece[k:]]] = symbol[piece]
        self.merged, self.made = pairs, Table(pairs)
        self.chars = Table({ord(name): i for name, i in symbol.items() if len(name) == 1})
        # How many tokens a symbol is: characters that are no piece are spelled by their bytes.
        self.tokens = np.array([1] * len(pieces) + [len(c.encode()) for c in names[len(pieces) :]], np.int64)
        inner = {(a, b) for p in pieces for a, b in zip(p, p[1:], strict=False)}
        self.inner = Table({ord(a) << 21 | ord(b): 1 for a, b in inner})
        # Words end before a space unless a piece goes on there.
        apart = not any(b == SPACE and a != SPACE for a, b in inner)
        self.words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if apart else "(?s:.+)").findall
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, symbol) of what two symbols merge into; symbols below zero merge with none."""
        made = self.made[np.where((left >= 0) & (right >= 0), left * self.count + right, self.count**2)]
        return np.where(made >= 0, self.rank[made], NONE), made

    def learn(self, found: Iterable[list[str]]) -> dict[str, int]:
        """Pre-token -> its number of tokens, for all of the given ones."""
        if len(self.young) > CACHED:
            self.young, self.old = {}, self.young
        missing = set().union(*found).difference(self.young)
        known = missing.intersection(self.old)
        self.young.update((word, self.old[word]) for word in known)
        missing = list(missing.difference(known))
        self.young.update(zip(missing, self.counts(missing).tolist(), strict=True))
        return self.young

    def counts(self, words: list[str]) -> np.ndarray:
        """The number of tokens of each pre-token; none is empty."""
        if not words:
            return np.zeros(0, np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        symbols = self.chars[points]
        spelled = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        near = points[:-1] << 21 | points[1:]
        starts = np.concatenate(([True], (self.inner[near] < 0) | (word[:-1] != word[1:])))
        return self._merged(symbols, np.cumsum(starts) - 1, word, spelled, len(words))

    def _merged(self, symbols: np.ndarray, sequence: np.ndarray, word: np.ndarray, spelled: np.ndarray, n: int) -> np.ndarray:
        """Tokens per word, from the symbols of sequences; unknown characters count as spelled."""
        totals = np.bincount(word, np.where(symbols < 0, spelled, 0), minlength=n).astype(np.int64)
        lengths = np.bincount(sequence)
        for number in np.flatnonzero(lengths > LONG):
            begin = np.searchsorted(sequence, number)
            own = symbols[begin : begin + lengths[number]]
            totals[word[begin]] += self._by_heap(own.tolist())
        short = lengths[sequence] <= LONG
        symbols, sequence, word = symbols[short], sequence[short], word[short]
        while len(symbols):
            together = sequence[:-1] == sequence[1:]
            rank, made = self.pairs(symbols[:-1], symbols[1:])
            rank = np.append(np.where(together, rank, NONE), NONE)
            made = np.append(made, -1)
            begins = np.flatnonzero(np.concatenate(([True], ~together)))
            least = np.repeat(np.minimum.reduceat(rank, begins), np.diff(np.append(begins, len(symbols))))
            done = least == NONE
            own = np.where(symbols < 0, 0, self.tokens[symbols])
            totals += np.bincount(word[done], own[done], minlength=n).astype(np.int64)
            chosen = self._chosen(symbols, sequence, rank, made, least)
            symbols = symbols.copy()
            symbols[chosen] = made[chosen]
            left = ~done
            left[chosen + 1] = False
            symbols, sequence, word = symbols[left], sequence[left], word[left]
        return totals

    def _chosen(self, symbols: np.ndarray, sequence: np.ndarray, rank: np.ndarray, made: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The places at which this round merges: of each sequence's best pair, from the left, without
        overlap, up to the first whose merge makes a pair that the library would take before the next."""
        best = (rank == least) & (least < NONE)
        places = np.flatnonzero(best)
        if not len(places):
            return places
        run = np.concatenate(([True], np.diff(places) > 1))
        first = places[np.maximum.accumulate(np.where(run, np.arange(len(places)), 0))]
        places = places[(places - first) % 2 == 0]
        merged = made[places]
        # The neighbour before is what the merge before made, if that ended there.
        before = np.concatenate(([-1], symbols))[places]
        adjacent = np.concatenate(([False], np.diff(places) == 2))
        before = np.where(adjacent, np.concatenate(([-1], merged[:-1])), before)
        before = np.where(np.concatenate(([-1], sequence))[places] == sequence[places], before, -1)
        after = np.concatenate((symbols, [-1, -1]))[places + 2]
        after = np.where(np.concatenate((sequence, [-1, -1]))[places + 2] == sequence[places], after, -1)
        sooner = np.minimum(self.pairs(before, merged)[0], self.pairs(merged, after)[0]) <= rank[places]
        earlier = np.cumsum(sooner) - sooner
        opens = np.concatenate(([True], sequence[places[1:]] != sequence[places[:-1]]))
        base = earlier[np.maximum.accumulate(np.where(opens, np.arange(len(places)), 0))]
        return places[earlier == base]

    def _by_heap(self, symbols: list[int]) -> int:
        """The number of tokens of one long sequence, unknown characters left out."""
        n, merged, rank, count = len(symbols), self.merged, self.rank, self.count
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[int, ...]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and symbols[a] >= 0 and symbols[b] >= 0:
                made = merged.get(symbols[a] * count + symbols[b])
                if made is not None:
                    heapq.heappush(heap, (int(rank[made]), a, b, symbols[a], symbols[b], made))

        for i in range(n - 1):
            offer(i, i + 1)
        gone = bytearray(n)
        while heap:
            _, a, b, left, right, made = heapq.heappop(heap)
            if gone[a] or gone[b] or symbols[a] != left or symbols[b] != right or after[a] != b:
                continue
            symbols[a], gone[b], after[a] = made, 1, after[b]
            if after[b] >= 0:
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        return sum(int(self.tokens[s]) for i, s in enumerate(symbols) if not gone[i] and s >= 0)

    def count_all(self, found: Iterable[str]) -> Iterator[int]:
        """The number of tokens of each text."""
        held, size = [], 0

        def done() -> list[int]:
            known = self.learn(held).__getitem__
            return [sum(map(known, text)) for text in held]

        for text in found:
            held.append(self.words(self.model.normalize(text)) if text else [])
            size += len(text)
            if size >= TOGETHER:
                yield from done()
                held, size = [], 0
        yield from done()


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


def token_counts(docs: DataFrame, model: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row, in one pass without a shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = merges(model)
        for batch in batches:
            counts = list(known.count_all(text for (text,) in rows_of(batch, "text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )
        release()

    rows = texts(docs).withColumn("n_bytes", F.octet_length("text").cast("long"))
    counted = rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
