"""Vector codes, collocations and token counts against plain loops."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from public_tokenizers import path

from fixtures import docs, odd_rows, words  # noqa: F401

from martwright.llm import collocations, token_counts, vector_codes
from martwright.llm.common import looked_up
from martwright.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
MODEL = path("piece_bpe_32k.model")


# ---- token counts


def counted(rows, limit=4096):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    found = []
    for doc_id, text in rows:
        n = len(model.encode(text or "", num_threads=1))
        found.append((doc_id, len((text or "").encode()), n, n > limit))
    return found


PARTS = ["the", "  ", " ", "\n", "\t", "a", "aba", "ing", "tion", "é", "中", "文", "😀", "<s>", "</s>", "<0x0A>", "▁", "\r\n", "12", "....", "ﬁ", "\u0000", "́", "xxxxxxx", "====", "ß", "при"]


@pytest.mark.parametrize("long", [token_counts.LONG, 3])
def test_counts_of_random_texts(monkeypatch, long):
    """Also with nearly all sequences merged by the heap."""
    monkeypatch.setattr(token_counts, "LONG", long)
    rng = random.Random(long)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(60))) for _ in range(6000)]
    got = list(token_counts.Merges(MODEL).count_all(texts))
    assert got == [n for _, _, n, _ in counted(enumerate(texts))]


@pytest.mark.parametrize("text", ["a" * 300_000, " " * 300_000, "ab" * 100_000, "中文字" * 60_000, "a b" * 100_000])
def test_counts_of_long_runs(text):
    assert list(token_counts.Merges(MODEL).count_all([text])) == [counted([(1, text)])[0][2]]


def test_known_pretokens_change_generations(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED", 50)
    monkeypatch.setattr(token_counts, "TOGETHER", 200)
    rng = random.Random(4)
    texts = [words(rng, 30) for _ in range(200)]
    assert list(token_counts.Merges(MODEL).count_all(texts * 2)) == [n for _, _, n, _ in counted(enumerate(texts * 2))]


def test_token_counts_of_odd_tables(docs, odd_rows):
    got = token_counts.token_counts(docs(odd_rows), MODEL).collect()
    assert Counter(map(tuple, got)) == Counter(counted(odd_rows))
    assert token_counts.token_counts(docs([]), MODEL).count() == 0


@tables
def test_token_count_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(map(tuple, QUERIES["op13_token_counts"](spark, FOLDER).collect())) == Counter(counted(rows))


# ---- vector codes


def compressed(rows, parts=16, entries=64, rounds=2):
    """[(vec_id, code, error, label_error, sha)] in whole numbers."""
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    size = len(kept[0][1]) // parts
    books = [[r[1][p * size : (p + 1) * size] for r in kept[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(book))

    def assigned():
        return [[nearest(v[p * size : (p + 1) * size], books[p]) for p in range(parts)] for _, v, _ in kept]

    for _ in range(rounds):
        found = assigned()
        for p in range(parts):
            members = defaultdict(list)
            for (_, v, _), own in zip(kept, found, strict=True):
                members[own[p][1]].append(v[p * size : (p + 1) * size])
            for e, group in members.items():
                books[p][e] = [sum(c) // len(group) for c in zip(*group, strict=True)]
    found, labels = assigned(), Counter()
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    for (_, _, label), own in zip(kept, found, strict=True):
        labels[label] += sum(d for d, _ in own)
    return [(i, "".join(f"{e:02x}" for _, e in own), sum(d for d, _ in own), labels[label], sha) for (i, _, label), own in zip(kept, found, strict=True)]


@pytest.fixture(scope="module")
def vectors(spark):
    def make(rows):
        full = [(*r, "x", None) for r in rows]
        return spark.createDataFrame(full, "vec_id long, embedding array<double>, label int, code string, error string").repartition(3)

    return make


def same(got, rows):
    return Counter(map(tuple, got.collect())) == Counter(compressed(rows))


def test_codes_of_odd_vectors(vectors):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(32)], rng.choice([None, 0, 1, 2])) for i in range(300)]
    rows += [(i, rows[0][1], 1) for i in range(300, 500)] + rows[5:8]  # copies and repeated rows
    odd = [(-1, None, 1), (-2, [0.5] * 31 + [None], 2), (-3, [0.5] * 31 + [float("nan")], None), (-4, [float("inf")] + [0.0] * 31, 0)]
    rows += [(None, [0.25] * 32, None), (600, [0.0] * 32, 3), (601, [-0.0] * 32, 3), (7, [0.1] * 32, 1)]
    assert same(vector_codes.compressed(vectors(rows + odd)), rows)
    other = [(-9, [0.5] * 7, 1), (-8, [], 1), (900, [0.5] * 48, 1)]  # of another length
    assert same(vector_codes.compressed(vectors(rows + other)), rows)


def test_codes_of_few_and_no_vectors(vectors):
    rows = [(2, [0.5] * 16, None), (1, [0.5] * 16, None), (3, [-1e-9] * 16, 4)]
    assert same(vector_codes.compressed(vectors(rows)), rows)
    for none in ([], [(1, None, 2)], [(1, [0.5] * 5, 2)]):
        got = vector_codes.compressed(vectors(none))
        assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and got.count() == 0


def test_codes_of_large_components(vectors):
    rng = random.Random(5)
    rows = [(i, [rng.choice([1e3, 1e7, -3e8, 1.5]) * rng.random() for _ in range(16)], i % 2) for i in range(90)]
    got = {r["vec_id"]: (r["code"], r["error"]) for r in vector_codes.compressed(vectors(rows)).collect()}
    assert got == {i: (c, e if e < 1 << 63 else None) for i, c, e, _, _ in compressed(rows)}
    far = [*rows, (99, [1e200] * 16, 0)]
    assert {r["vec_id"]: r["code"] for r in vector_codes.compressed(vectors(far)).collect()} == {r[0]: r[1] for r in compressed(far)}


def test_the_search_finds_the_nearest_and_visits_few():
    rng = np.random.default_rng(1)
    for entries in ([[0, 0]], [[3, 3]] * 5, rng.integers(-40, 40, (64, 4)).tolist(), rng.integers(-2, 2, (64, 2)).tolist()):
        searcher = vector_codes.Searcher(entries)
        points = rng.integers(-50, 50, (500, len(entries[0])))
        apart = ((points[:, None, :] - np.array(entries)[None]) ** 2).sum(axis=2)
        index, distance = searcher.nearest(points)
        assert (index == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()


@tables
def test_vector_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert same(QUERIES["op11_vector_codes"](spark, FOLDER), rows)


def test_hot_keys_and_others_are_looked_up(spark):
    rows = [(i, None if i % 3 == 0 else i % 5000) for i in range(20_000)]
    table = Counter(k for _, k in rows)
    left = spark.createDataFrame(rows, "id long, k long").repartition(4)
    right = spark.createDataFrame([(k, f"v{k}", n) for k, n in table.items() if k != 7], "k long, v string, n long")
    got = {r["id"]: (r["k"], r["v"]) for r in looked_up(left, right, "k", "v", weight="n").collect()}
    assert got == {i: (k, None if k == 7 else f"v{k}") for i, k in rows}


# ---- collocations


def ngrams(rows, longest=4):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            own = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(own)
            for i in range(len(own)):
                for n in range(1, min(longest, len(own) - i) + 1):
                    counts[lang, tuple(own[i : i + n])] += 1
    return {k: n for k, n in counts.items() if n >= collocations.LEAST}, totals


def collocated(rows, top=2000):
    counts, totals = ngrams(rows)
    longer, ranked = Counter(), defaultdict(list)
    for (lang, phrase), a in counts.items():
        for n in range(2, len(phrase)):
            for i in range(len(phrase) - n + 1):
                key = lang, phrase[i : i + n]
                longer[key] = max(longer[key], a)
    for (lang, phrase), a in counts.items():
        if len(phrase) > 1 and 100 * longer[lang, phrase] < 80 * a:
            cuts = [(counts[lang, phrase[:k]], counts[lang, phrase[k:]]) for k in range(1, len(phrase))]
            score, _, left, right = min((2_000_000 * a // (x + y), k, x, y) for k, (x, y) in enumerate(cuts))
            ranked[lang].append((-score, -a, " ".join(phrase).encode(), left, right))
    found = []
    for lang, own in ranked.items():
        for i, (score, a, phrase, left, right) in enumerate(sorted(own)[:top], 1):
            found.append((lang, i, phrase.decode(), -a, left, right, totals[lang], -score))
    return found


@pytest.fixture(scope="module")
def written(spark):
    def make(rows):
        full = [(i, t, lang, "x", None) for i, (lang, t) in enumerate(rows)]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, phrase string, n string").repartition(3)

    return make


def prose(rng, n, size):
    vocabulary = ["".join(rng.choices("abcdeé中", k=rng.randrange(1, 4))) for _ in range(size)]
    drawn = rng.choices(vocabulary, weights=[1 / (i + 1) for i in range(size)], k=n)
    return "".join(w.upper() * (rng.random() < 0.1) or w for w in drawn[:1]) + "".join(rng.choice([" ", " ", " ", " ", "  ", "\t", ", ", ".", "\n"]) + w for w in drawn)


@pytest.mark.parametrize("heavy", [collocations.HEAVY, 8, 100_000])
def test_collocations(written, monkeypatch, heavy):
    """With common beginnings routed by two, three and four words."""
    monkeypatch.setattr(collocations, "HEAVY", heavy)
    rng = random.Random(heavy)
    passage = prose(rng, 40, 300)
    rows = [(rng.choice(["en", "de", None, "und"]), prose(rng, 400, 30)) for _ in range(40)]
    rows += [("en", f"{passage} {prose(rng, 5, 50)}") for _ in range(60)] + [("en", "The Same pair! " * 200)] * 3
    rows += [(None, None), ("en", ""), ("xx", None), ("xx", " ;,\t"), ("en", "one"), ("de", prose(rng, 20_000, 12))]
    assert Counter(map(tuple, collocations.collocations(written(rows)).collect())) == Counter(collocated(rows))


def test_collocations_in_small_blocks(written, monkeypatch):
    """Texts far longer than a block, and few suffixes per row."""
    monkeypatch.setattr(collocations, "TOGETHER", 300)
    monkeypatch.setattr(collocations, "ROW", 7)
    rng = random.Random(2)
    rows = [(rng.choice(["en", "fr"]), prose(rng, rng.choice([3, 50, 3000]), 15)) for _ in range(12)] + [("en", "x" * 5000), ("en", "x," * 700)]
    assert Counter(map(tuple, collocations.collocations(written(rows), top=25).collect())) == Counter(collocated(rows, top=25))


def test_no_collocations(written):
    got = collocations.collocations(written([]))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and got.count() == 0
    assert collocations.collocations(written([("en", "too few words"), (None, None)])).count() == 0


def test_partitions_are_counted():
    """Three-way quicksort of weighted suffixes against a plain count."""
    rng = random.Random(6)
    suffixes = [[rng.randrange(6) for _ in range(rng.randrange(2, 5))] for _ in range(4000)]
    columns = [np.array([s[k] if k < len(s) else -1 for s in suffixes], np.int32) for k in range(4)]
    weights = np.array([rng.randrange(1, 4) for _ in suffixes])
    want = Counter()
    for s, w in zip(suffixes, weights.tolist(), strict=True):
        for n in range(2, len(s) + 1):
            want[tuple(s[:n])] += w
    for whole in (2, 3, 4):
        got = dict(collocations.frequent(columns, weights, whole, least=30))
        assert got == {p: n for p, n in want.items() if n >= 30 or len(p) < whole}
