"""Lines that are alike, of any length and in crowds, against plain loops over five-character shingles."""

import random
import time

import brute
import pytest
from pyspark.sql import functions as F

from martwright.llm import line_dedup


def dropped(spark, lines):
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    return {r["doc_id"] for r in line_dedup.report(docs).where("n_dropped > 0").collect()}


def made(rng, n=500):
    return ["".join(rng.choices("abcdefghijklm", k=rng.randrange(4, 8))) for _ in range(n)]


def alike(line, other):
    a, b = brute.line_shingles(line), brute.line_shingles(other)
    return len(a & b) / len(a | b)


def changed(rng, line, letters):
    line = list(line)
    for place in rng.sample(range(len(line)), letters):
        line[place] = rng.choice("nopqrstuvwxyz")
    return "".join(line)


@pytest.mark.parametrize("words, letters", [(4, 1), (9, 1), (16, 2), (40, 4), (250, 24)])
def test_recall_of_near_copies(spark, words, letters):
    """Pairs that are only just similar, each with nobody else to be linked by."""
    rng, pairs = random.Random(words), []
    vocabulary = made(rng, 3000)
    while len(pairs) < 400:
        line = " ".join(rng.choices(vocabulary, k=words))
        other = changed(rng, line, letters)
        if alike(line, other) >= 0.8:
            pairs.append((line, other))
    got = dropped(spark, [line for pair in pairs for line in pair])
    want = set(brute.dropped_lines([(i, line) for i, line in enumerate(line for pair in pairs for line in pair)]))
    assert got <= want and len(got) >= 0.95 * len(want) and len(want) >= 390


def test_a_line_with_one_letter_changed(spark):
    line = "we use cookies to improve this page, to show what you like, and to see who comes back to it"
    assert dropped(spark, [line, changed(random.Random(1), line, 1), "quite another line about the winter garden"]) == {1}


def test_a_line_that_is_only_like_one_like_the_head(spark, monkeypatch):
    """Variants that drift from a frequent line: its neighbours leave the crowd, theirs must not be lost."""
    monkeypatch.setattr(line_dedup, "PAIRED", 2)
    rng = random.Random(8)
    words, lines = made(rng), []
    for _ in range(6):
        line = rng.choices(words, k=40)
        lines += [" ".join(line)] * 5
        for _ in range(12):
            line = list(line)
            line[rng.randrange(40)] = rng.choice(words)
            lines.append(" ".join(line))
    assert dropped(spark, lines) == set(brute.dropped_lines(list(enumerate(lines))))


@pytest.mark.parametrize("paired", [1, 64])
def test_pairs_in_crowds(spark, monkeypatch, paired):
    """A beginning that 600 lines share puts them into common buckets; the pairs among them are found."""
    monkeypatch.setattr(line_dedup, "PAIRED", paired)
    rng = random.Random(9)
    words = made(rng, 2000)
    shared, lines = rng.choices(words, k=18), []
    for _ in range(300):
        own = rng.choices(words, k=22)
        lines += [" ".join([*shared, *own]), " ".join([*shared, *own[:-2], *rng.choices(words, k=2)])]
    got, want = dropped(spark, lines), set(brute.dropped_lines(list(enumerate(lines))))
    assert len(want) > 250 and got <= want and len(got) >= 0.95 * len(want)


def chain(rng, n=400, length=60):
    """Lines that differ from the one before in a word: all are one component, and few are like its first line."""
    words = made(rng)
    line, lines = rng.choices(words, k=length), []
    for _ in range(n):
        lines.append(" ".join(line))
        line = list(line)
        line[rng.randrange(length)] = rng.choice(words)
    return lines


def test_a_chain_of_near_copies_is_judged_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "CROWDED", 0)
    lines = chain(random.Random(5), 200)
    assert dropped(spark, lines) == set(brute.dropped_lines(list(enumerate(lines)))) == set(range(1, 200))


def test_pairs_that_signatures_rule_out_are_not_made(spark):
    """Of 60 lines in one bucket, each of its own component and alike in no bit, the join makes no pair."""
    rng = random.Random(6)
    rows = [(7, i, rng.getrandbits(40), rng.getrandbits(40), 60, i) for i in range(60)]
    left = spark.createDataFrame(rows, "value long, id long, sketch long, second long, n long, component long")
    assert line_dedup._paired(left).count() == 0
    twin = spark.createDataFrame([(7, 99, *rows[3][2:5], 99)], left.schema)
    assert [tuple(r)[:2] for r in line_dedup._paired(left.union(twin)).collect()] == [(99, 3)]


def test_pairs_of_one_first_line_are_shared_by_tasks(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARE", 10)
    rng = random.Random(3)
    line = " ".join(rng.choices(made(rng), k=60))
    lines = [line, *(changed(rng, line, 2) for _ in range(300))]
    assert dropped(spark, lines) == set(range(1, 301)) == set(brute.dropped_lines(list(enumerate(lines))))


def test_blank_and_very_long_lines(spark):
    """Tabs and carriage returns are blank; a long line is compared whole."""
    rng = random.Random(4)
    long = " ".join(rng.choices(made(rng), k=3000))
    end = long[:-700] + " ".join(rng.choices(made(rng), k=120))
    texts = ["hello\n\t\nworld\n \t\r\n\r", long, "HELLO\t\r\n" + end, "é😀中x", "É😀中x", "é😀中y", None, ""]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_lines"], [int(x) for x in r["dropped"].split(",") if x]) for r in line_dedup.report(docs).collect()}
    want = brute.dropped_lines(rows)
    assert got == {i: (sum(1 for x in (t or "").split("\n") if x.strip(" \t\r")), want.get(i, [])) for i, t in rows}
    assert got[0][0] == 2 and got[2] == (2, [0, 1]) and got[4] == (1, [0])


def test_lines_go_from_repeated_rows_alike(spark):
    rows = [(1, "first\nsecond line"), (1, "first\nsecond line"), (None, "second line"), (2, "FIRST \nthird")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["text"]) for r in line_dedup.without_dropped(docs).collect())
    assert got == [("1", "first"), ("1", "first"), ("2", "third"), ("None", "second line")]


def crowd_of(spark, rng, n=90):
    """A bucket's lines: bits that differ in up to nine places from those of three centres, a third in one component."""
    centres = [(rng.getrandbits(40), rng.getrandbits(40)) for _ in range(3)]

    def near(bits):
        places = sum(1 << p for p in rng.sample(range(40), rng.randrange(10)))
        return [b ^ (places & rng.getrandbits(40)) for b in bits]

    rows = [(7, i, *near(centres[i % 3]), n, 0 if i % 3 == 0 else i) for i in range(n)]
    return rows, spark.createDataFrame(rows, "value long, id long, sketch long, second long, n long, component long")


def hopeful(rows):
    pairs = [(a, b) for a in rows for b in rows if a[1] > b[1] and a[5] != b[5]]
    return sorted((a[1], b[1]) for a, b in pairs if ((a[2] ^ b[2]) | (a[3] ^ b[3])).bit_count() <= line_dedup.DIFFER)


@pytest.mark.parametrize("compared", [1 << 26, 500])
def test_a_crowd_makes_each_pair_once(spark, monkeypatch, compared):
    """However many tasks share the crowd, no pair is made twice or lost, and none within a component."""
    monkeypatch.setattr(line_dedup, "COMPARED", compared)
    rows, crowd = crowd_of(spark, random.Random(11))
    sizes = line_dedup._sizes(crowd)
    assert [tuple(r) for r in sizes.collect()] == [(7, 0, 90, -(-60 * 90 // compared))]
    got = sorted(tuple(r) for r in line_dedup._faced(crowd, sizes).select("id", "head").collect())
    assert got == hopeful(rows) and len(got) > 400


@pytest.mark.parametrize("limit", ["FACED", "MET"])
def test_crowds_too_large_to_compare_are_searched_by_rare_shingles(spark, monkeypatch, limit):
    monkeypatch.setattr(line_dedup, "PAIRED", 1)
    monkeypatch.setattr(line_dedup, limit, 0)
    searched, across = [], line_dedup._across
    monkeypatch.setattr(line_dedup, "_across", lambda *of: searched.append(1) or across(*of))
    rng = random.Random(9)
    words = made(rng, 2000)
    shared, lines = rng.choices(words, k=18), []
    for _ in range(120):
        own = rng.choices(words, k=22)
        lines += [" ".join([*shared, *own]), " ".join([*shared, *own[:-2], *rng.choices(words, k=2)])]
    got, want = dropped(spark, lines), set(brute.dropped_lines(list(enumerate(lines))))
    assert searched and len(want) > 100 and got <= want and len(got) >= 0.95 * len(want)


def test_pairs_are_verified_in_slices(spark, monkeypatch):
    """At most about one pair a line is verified at a time; together they are all that are similar."""
    lines = chain(random.Random(5), 60)
    rows = [(i, i, line) for i, line in enumerate(lines)]
    found = spark.createDataFrame(rows, "id long, twin long, line string")
    pairs = spark.createDataFrame([(i, j) for i in range(60) for j in range(i)], "id long, head long")
    slices, similar = [], line_dedup._similar
    monkeypatch.setattr(line_dedup, "_similar", lambda some, known: slices.append(some.count()) or similar(some, known))
    got = {(r["id"], r["head"]) for r in line_dedup._verified(pairs, line_dedup._known(found, pairs), 200).collect()}
    assert len(slices) == 9 and sum(slices) == 1770 and max(slices) < 300
    assert got == {(i, j) for i in range(60) for j in range(i) if alike(lines[i], lines[j]) >= 0.8}


def test_a_step_that_is_stored_leaves_no_shuffle(spark):
    """Shuffles that stayed until the driver collected its garbage added up to more than the disk has."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {name for f in files.getAllFiles().mkString("\n").split("\n") if (name := f.rpartition("/")[2]).startswith("shuffle_")}

    before, until = shuffles(), time.time() + 20
    summed = line_dedup.stored(spark.range(20000).groupBy((F.col("id") % 5000).alias("k")).count(), "line-test")
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before and summed.count() == 5000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
