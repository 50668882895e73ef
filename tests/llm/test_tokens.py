import random
from collections import Counter

import brute
import numpy as np
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F

from fixtures import docs, odd_rows  # noqa: F401

from martwright.llm import bpe, token_store, tokens

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
PIECES = [
    "a", "B", "the", " ", "  ", "\n", "\t", "\r\n", "\x85", "\xa0", "　", "​", "\x1c", "'s", "'re", "'", "!", "...", "?!",
    "<|endoftext|>", "<|startoftext|>", "<|end", "é", "é", "́", "İ", "ß", "Σ", "K", "中文", "한", "한", "12", "½", "😀", "\x00", "ﬁ",
]


@pytest.mark.parametrize("name", FILES)
def test_any_text_is_encoded_as_by_the_library(name):
    rng, library = random.Random(name), brute.library(name)
    texts = ["".join(rng.choices(PIECES, k=rng.randrange(14))) for _ in range(4000)]
    texts += ["x" * 2500 + " y", " " * 2500 + "y", "naïve " * 300]
    for text, got in zip(texts, tokens.encode_all(texts, path(name)), strict=True):
        assert tokens.ids(got).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_old_units_are_taken_over(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_UNITS", 20)
    monkeypatch.setattr(tokens, "TOGETHER", 50)
    cache, library, rng = tokens.Units(path(FILES[0])), brute.library(FILES[0]), random.Random(4)
    for _ in range(200):
        text = " ".join("".join(rng.choices("abcde", k=rng.randrange(1, 4))) + rng.choice(["", ".", ","]) for _ in range(9))
        known = cache.learn([tokens.UNIT.findall(text)])
        got = b"".join(known[u] for u in tokens.UNIT.findall(text))
        assert tokens.ids(got).tolist() == library.encode(text, add_special_tokens=False).ids
    assert cache.old


@pytest.mark.parametrize("name", FILES)
def test_trees_give_the_ids_of_the_whole_text(name):
    """Texts with and without white space, cut into leaves of a few characters and more."""
    rng, library, file = random.Random(8), brute.library(name), path(name)
    letters = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=700))
    texts = [letters, letters.upper() + "é" * 50, "-" * 300, "中文字" * 120, "ab'sc " * 60, "a\n\n  b" * 60, "<|endoftext|>" * 20, "é" * 150]
    texts += ["".join(rng.choices(PIECES, k=150)) for _ in range(40)]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        for leaf in (7, 60, 200):
            assert bpe.encode_text(text, file, leaf).tolist() == want, (repr(text), leaf)


def test_joining_looks_no_further_than_it_must(monkeypatch):
    """A join in a long text encodes a window, not the sides."""
    rng, file = random.Random(9), path(FILES[0])
    text = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(20_000))
    left, right = text[:60_001], text[60_001:]
    sides = [tokens.ids(tokens.encode(t, file)) for t in (left, right)]
    seen, plain = [], tokens.tokenizer(file)

    class Watched:
        def encode(self, t, add_special_tokens):
            seen.append(len(t))
            return plain.encode(t, add_special_tokens=add_special_tokens)

    monkeypatch.setattr(tokens, "tokenizer", lambda _: Watched())
    joined = bpe.join(left, sides[0], right, sides[1], file)
    assert joined.tolist() == plain.encode(text, add_special_tokens=False).ids and max(seen) <= 4 * bpe.WINDOW


def test_documents_are_encoded_and_decoded(docs, odd_rows):
    names = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    want = Counter(brute.encoded(odd_rows))
    for leaf in (bpe.LEAF, 300):
        got = bpe.digests(docs(odd_rows), path(FILES[0]), leaf)
        assert Counter(map(tuple, got.select(*names).collect())) == want
    assert bpe.digests(docs([]), path(FILES[0])).count() == 0


def test_codes_are_read_at_any_place():
    rng = np.random.default_rng(1)
    for top in (200, 60_000, 2**32):
        for size in (1, 63, 64, 511, 512, 513, 5000):
            ids = np.minimum(rng.zipf(1.2, size) - 1, top - 1).astype("<u4")
            codes = token_store.Codes(*token_store.Codes.pack(ids))
            at = rng.integers(0, size, 300)
            assert (codes.take(at) == ids[at]).all() and (codes.take(np.arange(size)) == ids).all()


def stored_rows(df):
    return Counter(map(tuple, df.select("doc_id", "start", "n_tokens", "ids_crc32").collect()))


def test_the_store_has_every_document_in_order(docs):
    rng = random.Random(2)
    rows = [(i * 3, "".join(rng.choices(["ab ", "cd", "\n", "é"], k=rng.randrange(40)))) for i in range(200)]
    rows += [(7, None), (8, "")]
    assert stored_rows(token_store.crcs(docs(rows), path(FILES[1]))) == Counter(brute.stored_tokens(rows))
    assert token_store.crcs(docs([]), path(FILES[1])).count() == 0


def test_a_repeated_id_is_split_and_gapless(docs, odd_rows, monkeypatch):
    monkeypatch.setattr(token_store, "SEGMENT_TOKENS", 500)
    rng = random.Random(3)
    rows = [*odd_rows, *[(50, "w " * rng.randrange(60)) for _ in range(300)], *[(i, "v") for i in range(60, 90)]]
    got = token_store.crcs(docs(rows), path(FILES[1])).collect()
    want = brute.stored_tokens(rows)
    assert Counter((r[0], r[2], r[3]) for r in got) == Counter((r[0], r[2], r[3]) for r in want)
    got.sort(key=lambda r: r["start"])
    ends = [0]
    for r in got:
        assert r["start"] == ends[-1]
        ends.append(r["start"] + r["n_tokens"])
    ids = [r["doc_id"] for r in got if r["doc_id"] is not None]
    assert ids == sorted(ids) and got[0]["doc_id"] is None


def test_single_tokens_are_found_by_their_place(spark, docs, tmp_path):
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(50)]
    token_store.write_store(docs(rows), path(FILES[1]), str(tmp_path / "s"), end_id=2)
    store = token_store.read_store(spark, str(tmp_path / "s"))
    library = brute.library(FILES[1])
    ids = [x for _, t in rows for x in [*library.encode(t, add_special_tokens=False).ids, 2]]
    asked = spark.range(0, len(ids) + 5, 3).select(F.col("id").alias("position"))
    got = {r["position"]: r["id"] for r in token_store.token(store, asked).collect()}
    assert got == {i: ids[i] for i in range(0, len(ids), 3)}
