import random
from collections import Counter, defaultdict
from itertools import combinations

import brute
import numpy as np
import pytest

from fixtures import docs, odd_rows  # noqa: F401

from martwright.llm import simhash
from martwright.llm.components import connected_components


def found(df):
    return Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect())


def test_fingerprints_and_components(docs, odd_rows):
    rng = random.Random(1)
    rows = list(odd_rows)
    for i in range(12):
        base = [rng.choice("lorem ipsum dolor sit amet sed do eiusmod".split()) for _ in range(60)]
        for k in range(4):
            near = list(base)
            near[rng.randrange(60)] = "changed"
            rows.append((100 + 10 * i + k, " ".join(near)))
    assert found(simhash.near_duplicates(docs(rows))) == Counter(brute.near_duplicates(rows))


def test_short_and_empty_texts():
    assert simhash.simhash("") == simhash.simhash(" \n") == 0
    for text in ("one", "one two", "One TWO three", "É é É x"):
        assert simhash.simhash(text) == brute.fingerprint(text)


def test_empty_table(docs):
    got = simhash.near_duplicates(docs([]))
    assert got.columns == ["doc_id", "fingerprint", "component_id", "component_size"] and got.count() == 0


def test_any_guaranteed_positions_contain_a_posting():
    for bits, size in ((3, 3), (3, 5), (2, 6)):
        sets = [set(s) for s in simhash.covering(size, bits)]
        for equal in combinations(range(8), 8 - bits):
            assert any(s <= set(equal) for s in sets)
    assert len(simhash.covering(3, 3)) == 8


def components(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        root[find(a)] = find(b)
    groups = defaultdict(set)
    for n in nodes:
        groups[find(n)].add(n)
    return sorted(map(sorted, groups.values()))


def cluster(rng, n, changed=9):
    center, free = rng.getrandbits(64), rng.sample(range(64), changed)
    return [center ^ sum(1 << b for b in rng.sample(free, rng.randrange(changed))) for _ in range(n)]


def all_pairs(values, bits=3):
    v = np.array(values, "u8")
    return [(values[i], values[j]) for i in range(len(v)) for j in (np.flatnonzero(np.bitwise_count(v[:i] ^ v[i]) <= bits)).tolist()]


@pytest.mark.parametrize("long", [4, 512])
def test_links_join_what_all_pairs_join(spark, monkeypatch, long):
    """With lists that count as long from the fifth entry on, and as usual."""
    monkeypatch.setattr(simhash, "LONG_LIST", long)
    rng = random.Random(2)
    values = sorted({v for _ in range(8) for v in cluster(rng, 40)} | {rng.getrandbits(64) for _ in range(200)} | {0, 7, 15})
    signed = np.array(values, "u8").view("i8").tolist()
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()
    got = [tuple(np.array([r[0], r[1]], "i8").view("u8").tolist()) for r in edges]
    assert all((a ^ b).bit_count() <= 3 for a, b in got)
    assert components(got, values) == components(all_pairs(values), values)


def test_flipping_bits_finds_what_comparing_finds():
    rng = random.Random(3)
    base, free = rng.getrandbits(64), rng.sample(range(64), 16)
    values = sorted({base ^ sum(1 << b for b in rng.sample(free, rng.randrange(9))) for _ in range(150)})
    fps = np.array(values, "u8")
    for bits in (1, 2, 3):
        compared, flipped = simhash._compared(fps, bits), simhash._flipped(fps, bits)
        assert components(compared, values) == components(flipped, values) == components(all_pairs(values, bits), values)
        assert len(compared) < len(values) and len(flipped) < len(values)


def test_dropping_keeps_one_of_each_group_and_all_columns(docs):
    text = " ".join(f"w{i}" for i in range(80))
    table = docs([(3, text), (1, text), (2, "another text altogether"), (None, text)])
    got = simhash.drop_near_duplicates(table)
    assert got.columns == table.columns
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in got.collect()) == [(False, 0), (True, 1), (True, 2)]


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(1000, i) for i in range(1001, 1300)]
    edges = [*chain, *star, (5000, 5000), (6000, 6001), (6001, 6000)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()
    want = {i: 0 for i in range(41)} | {i: 1000 for i in range(1000, 1300)} | {6000: 6000, 6001: 6000}
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
