"""Exact duplicates, lines, decontamination and shards against plain loops."""

import random
import zlib
from collections import Counter, defaultdict

import brute
import pytest
from pyspark.sql import functions as F

from fixtures import docs, odd_rows  # noqa: F401

from martwright.llm import decontaminate, exact_dedup, line_dedup, sharding


def test_exact_duplicates(docs, odd_rows):
    got = exact_dedup.exact_duplicates(docs(odd_rows))
    names = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert Counter(map(tuple, got.select(*names).collect())) == Counter(brute.exact_duplicates(odd_rows))
    assert exact_dedup.exact_duplicates(docs([])).count() == 0


def test_one_row_of_each_text_is_left(docs, odd_rows):
    table = docs(odd_rows)
    got = exact_dedup.drop_exact_duplicates(table)
    assert got.columns == table.columns
    kept = sorted(str((r["doc_id"], r["text"] or "")) for r in got.collect())
    wanted = [(d, dict((brute.sha(t or ""), t or "") for _, t in odd_rows)[h]) for d, _, _, k, h in brute.exact_duplicates(odd_rows) if k]
    assert kept == sorted(map(str, wanted))


def test_a_filter_takes_and_gives_back_digests():
    rng = random.Random(1)
    digests = [rng.randbytes(32) for _ in range(3000)]
    index = exact_dedup.CuckooIndex()
    for i, d in enumerate(digests * 2):
        index.add(d, i, 1)
    assert index.filter.mask > 500 and all(d in index.filter for d in digests)  # it has grown
    assert {e[1] for e in index.content.values()} == {2} and len(index.content) == 3000
    for d in digests[:1500]:
        index.remove(d)
    assert all(d in index.filter for d in digests[1500:]) and len(index.content) == 1500
    again = exact_dedup.CuckooIndex.load(index.row(3))
    assert again.content == index.content and again.filter.slots == index.filter.slots
    assert sum(d in again.filter for d in digests[:1500]) < 60  # false hits only


def test_buckets_grow_with_the_corpus(docs):
    assert [exact_dedup.bucket_bits(n) for n in (0, 10**6, 10**9, 10**10, 10**11, 10**15)] == [16, 16, 16, 19, 23, 31]
    digests = exact_dedup.digests(docs([(i, f"text {i % 50}") for i in range(200)]))
    for bits in (1, 16, 31):
        got = exact_dedup.content(exact_dedup.build_index(digests, bits)).collect()
        assert sorted((r["keep_id"], r["group_size"]) for r in got) == [(150 + i, 4) for i in range(50)]


def test_an_index_follows_its_corpus(docs):
    rows = [(1, "a"), (2, "a"), (3, "b"), (4, "c")]
    digests = exact_dedup.digests
    index = exact_dedup.build_index(digests(docs(rows)))
    removed, remaining = [(2, "a"), (4, "c")], [(1, "a"), (3, "b")]
    after = exact_dedup.update_index(index, digests(docs([(9, "b"), (5, "d")])), digests(docs(removed)), digests(docs(remaining)))
    got = {(r["digest"].hex(), r["keep_id"], r["group_size"]) for r in exact_dedup.content(after).collect()}
    assert got == {(brute.sha("a"), 1, 1), (brute.sha("b"), 9, 2), (brute.sha("d"), 5, 1)}


def test_lines(docs, monkeypatch):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choices("abcdefghijklm", k=rng.randrange(3, 8))) for _ in range(400)]
    rows, lines = [], [" ".join(rng.choices(vocabulary, k=30)) for _ in range(25)]
    for i in range(60):
        own = []
        for _ in range(4):
            line = rng.choice(lines).split(" ")
            if rng.random() < 0.4:
                line[rng.randrange(30)] = rng.choice(vocabulary)
            own.append(" ".join(line) if rng.random() < 0.9 else "SHARED Line, as it is")
        rows.append((i, "\n".join([*own, "", "  "])))
    rows += [(100, None), (101, ""), (102, "\n\n")]
    got = {r["doc_id"]: [int(x) for x in r["dropped"].split(",") if x] for r in line_dedup.report(docs(rows)).collect()}
    want = brute.dropped_lines(rows)
    assert {d: n for d, n in got.items() if n} == want and len(got) == len(rows)
    cleaned = {r["doc_id"]: r["text"] for r in line_dedup.without_dropped(docs(rows)).collect()}
    for doc_id, text in rows[:60]:
        assert cleaned[doc_id].split("\n") == [x for i, x in enumerate(text.split("\n")) if i not in want.get(doc_id, [])]


def test_lines_of_repeated_rows_and_empty_tables(docs):
    rows = [(1, "a line\nb line"), (1, "a line\nb line"), (None, "a line"), (2, "b line")]
    got = Counter((r["doc_id"], r["n_lines"], r["dropped"]) for r in line_dedup.report(docs(rows)).collect())
    assert got == Counter({(1, 2, "0"): 2, (None, 1, ""): 1, (2, 1, "0"): 1})
    assert line_dedup.report(docs([])).count() == 0


def test_a_bucket_of_strangers_is_split(spark):
    """Lines that meet in a band but are not similar to its head are compared elsewhere."""
    shared = "the very same beginning of a line that many records have in common "
    lines = [shared + " ".join(f"x{i // 2}y{k}" for k in range(9)) + (" end" if i % 2 else "") for i in range(40)]
    docs = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "doc_id long, text string")
    got = {r["doc_id"] for r in line_dedup.report(docs).where("n_dropped > 0").collect()}
    assert got == set(brute.dropped_lines(list(enumerate(lines))))


BENCHMARK = [(1, " ".join(f"w{i}" for i in range(30))), (2, "short item"), (3, None), (4, "..."), (None, " ".join(f"w{i}" for i in range(20))), (11, "é naïve Wörter 中文")]


def contaminated(docs, rows, items, **limits):
    spark = docs([]).sparkSession
    table = spark.createDataFrame(items, "item_id long, text string")
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return Counter(map(tuple, decontaminate.contamination(docs(rows), table, **limits).select(*names).collect()))


def test_contamination(docs, odd_rows):
    passage = BENCHMARK[0][1].upper().replace(" ", ", ")
    rows = [*odd_rows, (20, passage), (21, "x " * 900 + passage), (22, "a Short, ITEM b"), (23, passage + " " + passage), (24, "É naïve wörter 中文"), (25, "é naïve wörter 中文")]
    want = Counter(brute.contaminated(rows, BENCHMARK))
    assert contaminated(docs, rows, BENCHMARK) == want
    assert contaminated(docs, rows, BENCHMARK, broadcast_bytes=40) == want  # in blocks
    assert contaminated(docs, rows, []) == Counter(brute.contaminated(rows, []))
    assert not contaminated(docs, [], BENCHMARK)


def test_contaminated_documents_go_by_their_own_text(docs, odd_rows):
    rows = [*odd_rows, (1, BENCHMARK[0][1]), (None, "a short item")]
    table = docs(rows)
    items = table.sparkSession.createDataFrame(BENCHMARK, "item_id long, text string")
    got = decontaminate.drop_contaminated(table, items)
    assert got.columns == table.columns
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter(odd_rows)


def shards(df):
    members = defaultdict(list)
    for r in df.collect():
        members[r["shard"]].append(r)
    return members


def test_shards_are_balanced_and_numbered(docs, odd_rows):
    rng = random.Random(3)
    rows = [(i, "x" * rng.randrange(2000)) for i in range(3000)] + odd_rows
    got = sharding.sharded(docs(rows), 4)
    members = shards(got)
    sizes = [sum(r["size"] for r in m) for m in members.values()]
    assert max(sizes) - min(sizes) < 0.005 * sum(sizes) and sum(map(len, members.values())) == len(rows)
    for m in members.values():
        assert sorted(r["slot"] for r in m) == list(range(len(m)))
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for m in members.values() for r in m) == want
    places = defaultdict(set)
    for shard, m in members.items():
        for r in m:
            places[r["text_crc32"], r["size"]].add(shard)
    assert max(map(len, places.values())) == 1  # equal texts stay together
    assert sharding.sharded(docs([]), 4).count() == 0


def test_a_text_that_a_third_of_all_rows_have_is_spread(docs):
    rows = [(i, "the very same text" if i % 3 == 0 else f"text {i} and more") for i in range(900)]
    sizes = [sum(r["size"] for r in m) for m in shards(sharding.sharded(docs(rows), 8)).values()]
    assert max(sizes) - min(sizes) < 0.02 * sum(sizes) / 8 + 40


@pytest.mark.parametrize("shares", [(0.4, 0.6, 0.9), (0.9, 0.9, 0.9, 0.9), (1.5, 0.6), (0.3,) * 12, (1.5, 0.9, 0.6, 0.4, 0.3), (2.6,)])
def test_texts_that_fit_a_shard_are_not_split(docs, shares):
    """A group of copies goes whole to one shard unless it holds more than a shard's share."""
    rng, total, shards_ = random.Random(1), 400_000, 8
    rows, kept = [], {}
    for k, share in enumerate(shares):
        text = f"group {k} " + "y" * 90
        n = round(share * total / shards_ / (len(text) + 1))
        kept[zlib.crc32(text.encode())] = share
        rows += [(len(rows) + i, text) for i in range(n)]
    size = sum(len(t) + 1 for _, t in rows)
    while size < total:
        text = "z" * rng.randrange(20, 400) + str(len(rows))
        rows.append((len(rows), text))
        size += len(text) + 1
    members = shards(sharding.sharded(docs(rows), shards_))
    places = defaultdict(set)
    for shard, m in members.items():
        for r in m:
            places[r["text_crc32"]].add(shard)
    for crc, share in kept.items():
        assert (len(places[crc]) == 1) == (share <= 1), share
    sizes = [sum(r["size"] for r in m) for m in members.values()]
    assert max(sizes) - min(sizes) < 0.01 * total / shards_ + 400


def test_a_row_that_is_repeated_very_often(docs):
    rows = [(1, "again and again")] * 9000 + [(i, f"text {i}") for i in range(500)]
    members = shards(sharding.sharded(docs(rows), 4))
    assert sum(map(len, members.values())) == len(rows)
    for m in members.values():
        assert sorted(r["slot"] for r in m) == list(range(len(m)))


def test_maps_are_edited_and_kept(spark, tmp_path):
    rng = random.Random(4)
    sizes = {s: rng.randrange(1, 5000) for s in range(500)}
    first = sharding.first_map(8, 500)
    balanced = sharding.rebalanced(first, sizes, 8)
    loads = Counter()
    for slot, shard in enumerate(balanced):
        loads[shard] += sizes[slot]
    assert max(loads.values()) - min(loads.values()) <= 3
    assert sharding.rebalanced(balanced, sizes, 8) == balanced
    more = sharding.grown(balanced, sizes, 8)
    moved = [slot for slot in range(500) if more[slot] != balanced[slot]]
    assert moved and {more[slot] for slot in moved} == {8}
    assert abs(sum(sizes[s] for s in moved) - sum(sizes.values()) / 9) < 0.05 * sum(sizes.values())
    path = str(tmp_path / "map")
    sharding.store_map(spark, [first, balanced], path)
    sharding.store_map(spark, [more], path, first=2)
    for version, want in ((0, first), (1, balanced), (None, more)):
        rows = sharding.stored_map(spark, path, version).orderBy("virtual_slot").collect()
        assert [r["shard"] for r in rows] == want
    assert sharding.stored_map(spark, path).agg(F.count("*")).first()[0] == 500
