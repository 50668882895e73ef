"""Token ids of whole texts, as the tokenizers library gives them.

Byte-level vocabularies whose merges are numbered in their order are run by a faster public encoder
of the same kind, built from the tokenizer's own file. Others go through a cache of text units. Both
give the ids of the library: one text in ``CHECKED`` of every call is compared, and texts with very long
unsplit runs, and vocabularies of another kind, are left to the library itself.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core

# Fixed: the characters with Unicode's White_Space property.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# White space and the word after it. Whether the text goes on after a word does not change its ids,
# as every pattern that splits text before the merges ends its words at white space.
UNIT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
IS_WHITE = re.compile(f"[{WHITE}]").fullmatch
CACHED_UNITS = 250_000  # of a generation, about 60 MB
CHECKED = 64
LONG_RUN = re.compile(r"\S{2000}|\s{2000}")
STOPS = ".,!?;:"
TOGETHER = 1 << 20  # characters whose units are looked up together


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The tokenizer of a file, one per Python worker; truncation and padding are off."""
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


def _plain_letter(char: str) -> bool:
    """Letters that stay one letter in every normal form and in lower case."""
    return char.isalpha() and char < "\u0130"


class Units:
    """Unit of text -> its ids as little-endian unsigned 32-bit integers, in two generations.

    A full generation becomes the old one, from which units that occur again are taken over.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = tokenizer(path)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def learn(self, texts: list[list[str]]) -> dict[str, bytes]:
        """The ids of the texts' units, all of them in the young generation now.

        A word is known if it is known without the stops after it: splitting patterns end a run of
        letters there, and one of stops at white space.
        """
        if len(self.young) > CACHED_UNITS:
            self.young, self.old = {}, self.young
        young, old, stems, needed = self.young, self.old, [], []
        for unit in set().union(*texts).difference(young):
            if unit in old:
                young[unit] = old[unit]
            elif unit[-1] in STOPS and _plain_letter((stem := unit.rstrip(STOPS))[-1:]):
                stems.append((unit, stem, unit[len(stem) :]))
            else:
                needed.append(unit)
        if stems:
            _, words, stops = zip(*stems, strict=True)
            needed = list(set(needed).union(words, stops).difference(young))
        together = [u for u in needed if u[0] in " \n" and _plain_letter(u[-1])]
        young.update(zip(together, self._together(together), strict=True))
        for unit in set(needed).difference(together):
            young[unit] = np.array(self.tokenizer.encode(unit, add_special_tokens=False).ids, "<u4").tobytes()
        for unit, stem, stop in stems:
            young[unit] = young[stem] + young[stop]
        return young

    def _together(self, units: list[str]) -> list[bytes]:
        """Units that begin with white space and end in a letter, encoded as one text and cut apart."""
        if not units:
            return []
        text = "".join(units)
        found = self.tokenizer.encode(text, add_special_tokens=False)
        ids, ends = np.array(found.ids, "<u4"), np.cumsum(np.fromiter(map(len, units), np.int64, len(units)))
        places = np.fromiter((a for a, _ in found.offsets), np.int64, len(ids))
        cuts = np.concatenate(([0], np.searchsorted(places, ends))) * 4
        encoded, cuts = ids.tobytes(), cuts.tolist()
        return [encoded[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


@lru_cache(maxsize=4)
def units(path: str) -> Units:
    return Units(path)


@lru_cache(maxsize=4)
def ranked(path: str):
    """The encoder for byte-level vocabularies, or None if the file's is of another kind."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    splits, vocabulary, special = made["pre_tokenizer"] or {}, made["model"]["vocab"], {t["content"]: t["id"] for t in made["added_tokens"]}
    merges = [m.split(" ") if isinstance(m, str) else m for m in made["model"].get("merges", [])]
    merged = [vocabulary.get("".join(m), -1) for m in merges]
    byte_level = splits.get("type") == "ByteLevel" and splits.get("use_regex") and not splits.get("add_prefix_space")
    plain = not any(t[k] for t in made["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    if made["normalizer"] or not byte_level or not plain or merged != sorted(merged) or -1 in merged:
        return None
    import tiktoken
    from public_tokenizers import PATTERN

    shown = {c: b for b, c in _byte_names().items()}
    ranks = {bytes(shown[c] for c in token): i for token, i in vocabulary.items() if token not in special}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def _byte_names() -> dict[int, str]:
    """How byte-level vocabularies spell bytes: printable ones as they are, others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def _by_library(text: str, path: str) -> bytes:
    return np.array(tokenizer(path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def encode_all(texts: Iterable[str], path: str) -> Iterator[bytes]:
    """The ids of each text as little-endian unsigned 32-bit integers."""
    return _by_units(texts, path) if ranked(path) is None else _by_ranks(texts, path)


def _by_ranks(texts: Iterable[str], path: str) -> Iterator[bytes]:
    """One text in CHECKED goes through the library as well; if they differ, all that follow do."""
    encoder, agreed = ranked(path), True
    for number, text in enumerate(texts):
        if not agreed or LONG_RUN.search(text):
            yield _by_library(text, path)
            continue
        ids = encoder.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
        if number % CHECKED == 0:
            known = _by_library(text, path)
            agreed, ids = ids == known, known
        yield ids


def _by_units(texts: Iterable[str], path: str) -> Iterator[bytes]:
    """By the units that texts share."""
    cache, held, size = units(path), [], 0

    def done() -> Iterator[bytes]:
        known = cache.learn(held).__getitem__
        return (b"".join(map(known, text)) for text in held)

    for text in texts:
        held.append(UNIT.findall(text))
        size += len(text)
        if size >= TOGETHER:
            yield from done()
            held, size = [], 0
    yield from done()


def encode(text: str, path: str) -> bytes:
    return next(encode_all([text], path))


def ids(encoded: bytes) -> np.ndarray:
    return np.frombuffer(encoded, "<u4")
