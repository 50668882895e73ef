"""Fuzzy line dedup by MinHash, in built-in functions throughout.

A line is compared in lower case, without the blanks, tabs and carriage returns around it. Its shingles are its ``SHINGLE`` characters from every place (a
shorter line is one shingle). Signatures are ``BANDS * ROWS`` minima over hashes of these; two lines meet
in a bucket if all minima of a band are equal, which happens to lines of Jaccard similarity s with
probability 1 - (1 - s**ROWS)**BANDS: 0.958 at 0.8, 0.991 at 0.85. Lines that meet are verified by the exact
similarity of their whole shingle sets. Components are found by a distributed union-find, and of each
the first line stays: by doc_id, then by place in the text.

Equal lines are one line from the start: they are merged in the task that reads them and once after the
shuffle, and only then cut into shingles. The shingles are rows between two aggregations of one stage;
they are neither stored nor shuffled. Of a bucket of two, both lines are a pair. Of a larger bucket, every
line is one with the first, which joins what is mostly alike. Where lines of several components are left in
a bucket, those of different components are pairs, each with each. Buckets of more than ``PAIRED`` lines are
crowds: of these, lines outside the largest component are dealt over tasks and meet all others there. A crowd
of which more than ``FACED`` tasks would be needed, or that has more than ``MET`` pairs a line, is searched by its
rarest shingles, of which every line has so many that no similar pair of the crowd is missed. So no pair that
meets is lost, whatever the bucket's size. A pair is
verified if its signatures allow it: one bit of each minimum must be equal in all but ``APART`` of 40, and
two bits in all but ``DIFFER``. Of pairs at 0.8, one in a thousand fails that by chance.

Only lines of pairs are read again as texts. The shuffles of a step are removed when its rows are stored, and
pairs are verified in slices of at most one pair a line of the table, so the disk in use does not grow with the pairs.

Buckets, first lines and lines that very many rows share are joined by broadcast of a bounded number of
short rows, or dealt over several tasks; texts are never broadcast.

Nulls and odd inputs: a null or empty text has no lines. Lines of blanks, tabs and carriage returns
only are kept and not counted. A null doc_id comes first. Rows with equal doc_id and text are one
document and get equal rows. An empty table gives an
empty result. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm import common
from martwright.llm.common import looked_up, shuffles_removed, texts
from martwright.llm.components import connected_components

SHINGLE = 5
BANDS, ROWS = 8, 5
APART, DIFFER = 11, 13
PAIRED = 64
TOGETHER = 8  # shingles of a row
SHARE = 5000  # pairs with one first line that a task verifies
COMPARED = 1 << 26  # pairs of signatures in a crowd that a task compares
FACED, MET = 64, 1024  # rows of a line, and pairs a line, above which its rarest shingles take less disk
CROWDED = 4  # pairs a line, above which those most alike are verified before the others
COARSE = 1 << 21  # values of the filters that are broadcast, whatever the input
PLACE = ("doc_id", "text_hash", "line_no")
BITS = ("sketch", "second")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows stored, without the shuffles that made them."""
    with shuffles_removed(df.sparkSession):
        return common.stored(df, name)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the links' lines."""
    with shuffles_removed(edges.sparkSession):
        return connected_components(edges.select("id", "head"))


def normal(line: Column | str) -> Column:
    """The line as it is compared; empty if it is blank."""
    return F.lower(F.btrim(line, F.lit(" \t\r")))


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line_no, id, twin, line) of every line that is not blank.

    ``id`` names a line in the search; ``id`` and ``twin`` together stand for the line itself.
    """
    docs = texts(docs).withColumn("text_hash", F.xxhash64("text"))
    rows = docs.select("doc_id", "text_hash", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    rows = rows.select(*PLACE, normal("line").alias("line")).where("line != ''")
    return rows.select(*PLACE, F.xxhash64("line").alias("id"), F.xxhash64(F.lit(1), "line").alias("twin"), "line")


def _places(line: Column) -> Column:
    """The number of places at which a shingle begins."""
    return F.greatest(F.char_length(line) - (SHINGLE - 1), F.lit(1))


def _shingle(chars: Column, place: Column) -> Column:
    """The hash of a shingle; a character has four bytes."""
    return F.xxhash64(F.substring(chars, place * 4 + 1, F.lit(4 * SHINGLE)))


def shingles(line: Column) -> Column:
    """The set of a line's shingles, by their hashes."""
    hashes = F.transform(
        F.array(F.encode(line, "UTF-32")),
        lambda chars: F.transform(F.sequence(F.lit(0), _places(line) - 1), lambda i: _shingle(chars, i)),
    )
    return F.array_distinct(F.get(hashes, F.lit(0)))


def _salt(k: int) -> int:
    """32 bits for each minimum; the leading ones are spread evenly."""
    return (k + 1) * 0x9E3779B1 % (1 << 32)


def signatures(found: DataFrame) -> DataFrame:
    """(id, twin, doc_id, text_hash, line_no, rows, sketch, second, bands) of every distinct line.

    The place is the line's first, and ``rows`` the number of its places; ``sketch`` and ``second`` have a bit of
    each minimum.
    """
    first = F.min(F.struct(*PLACE)).alias("first")
    whole = found.groupBy("id", "twin").agg(F.max("line").alias("line"), first, F.count("*").alias("rows"))
    whole = whole.select("id", "twin", "first.*", "rows", F.encode("line", "UTF-32").alias("chars"), _places(F.col("line")).alias("places"))
    places = F.sequence(F.lit(0), F.col("places") - 1, F.lit(TOGETHER))
    rows = whole.select("*", F.explode(places).alias("place"))
    # The last place is repeated where a line ends before its row does; that changes no minimum.
    some = [_shingle(F.col("chars"), F.least(F.col("place") + j, F.col("places") - 1)).alias(f"h{j}") for j in range(TOGETHER)]
    hashed = rows.select("id", "twin", *PLACE, "rows", *some)
    low = [F.col(f"h{j}").bitwiseAND(F.lit((1 << 32) - 1)).alias(f"a{j}") for j in range(TOGETHER)]
    high = [F.shiftrightunsigned(f"h{j}", 32).alias(f"b{j}") for j in range(TOGETHER)]
    hashed = hashed.select("id", "twin", *PLACE, "rows", *low, *high)

    def minimum(k: int) -> Column:
        return F.min(F.least(*(F.col(f"{'ab'[k % 2]}{j}").bitwiseXOR(F.lit(_salt(k))) for j in range(TOGETHER))))

    least = [minimum(k).alias(f"m{k}") for k in range(BANDS * ROWS)]
    minima = hashed.groupBy("id", "twin", *PLACE, "rows").agg(*least)

    # Arrays keep the generated code of the aggregation small enough to be compiled.
    signed = minima.select("id", "twin", *PLACE, "rows", F.array(*(f"m{k}" for k in range(BANDS * ROWS))).alias("minima"))

    def bits(which: int) -> Column:
        return F.aggregate("minima", F.lit(0).cast("long"), lambda done, m: F.shiftleft(done, 1).bitwiseOR(F.shiftright(m, which).bitwiseAND(F.lit(1))))

    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.slice("minima", b * ROWS + 1, F.lit(ROWS))))
    return signed.select("id", "twin", *PLACE, "rows", bits(0).alias("sketch"), bits(1).alias("second"), bands.alias("bands"))


def _marks(ids: DataFrame, name: str) -> DataFrame:
    return ids.select(F.pmod(name, F.lit(COARSE)).alias("_mark")).distinct()


def _maybe(rows: DataFrame, ids: DataFrame, name: str = "id") -> DataFrame:
    """The rows whose ``name`` may be among ``ids``: a filter of at most COARSE values is broadcast."""
    marks = _marks(ids, name)
    return rows.join(F.broadcast(marks), F.pmod(name, F.lit(COARSE)) == marks["_mark"], "left_semi")


def _postings(signed: DataFrame) -> DataFrame:
    return signed.select("id", *BITS, F.explode("bands").alias("value"))


def _hopeful(*bits: Column) -> Column:
    """Whether two lines' signatures allow them to be similar, by the differing bits of both."""
    return _apart(*bits) <= DIFFER


def _apart(*bits: Column) -> Column:
    return F.bit_count(bits[0].bitwiseOR(bits[1]))


def _bits(signed: DataFrame, name: str, *names: str) -> DataFrame:
    return signed.select(F.col("id").alias(name), *(F.col(b).alias(n) for b, n in zip(BITS, names, strict=True)))


def _buckets(signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, head): lines of buckets of two that may be similar; (value, id, bits, head, n, near): those of larger ones.

    A line is ``near`` if it may be similar to the bucket's first one. Most buckets have one line, so signatures
    are looked up for the others instead of being sent along with every line.
    """
    ends = _postings(signed).groupBy("value").agg(F.min("id").alias("head"), F.max("id").alias("id"), F.count("*").alias("n"))
    ends = stored(ends.where("n > 1 AND id != head"), "line-ends")
    heads = [f"head_{b}" for b in BITS]
    ends = stored(ends.join(_bits(signed, "head", *heads), "head"), "line-buckets")
    differ = [F.col(b).bitwiseXOR(F.col(h)) for b, h in zip(BITS, heads, strict=True)]
    two = ends.where("n = 2").select("id", "head", *heads).distinct().join(_bits(signed, "id", *BITS), "id")
    two = two.where((F.bit_count(differ[0]) <= APART) & _hopeful(*differ)).select("id", "head")
    many = ends.where("n > 2").select("value", "head", "n", *heads)
    members = looked_up(_maybe(_postings(signed), many, "value"), many, "value", ["head", "n", *heads], weight="n")
    return two, stored(members.where(F.col("head").isNotNull()).select("value", "id", *BITS, "head", "n", _hopeful(*differ).alias("near")), "line-members")


def _ordered(a: str, b: str) -> list[Column]:
    return [F.greatest(a, b).alias("id"), F.least(a, b).alias("head")]


def _others(rows: DataFrame, *columns: str | Column) -> DataFrame:
    """The rows as the other lines of pairs."""
    return rows.select(*columns, F.col("id").alias("other"), F.col("component").alias("_component"), *(F.col(b).alias(f"_{b}") for b in BITS))


def _both() -> list[Column]:
    """The bits in which a line and the other one differ."""
    return [F.col(b).bitwiseXOR(F.col(f"_{b}")) for b in BITS]


def _known(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, twin, line, paired, n) of the pairs' lines: whether it has a first line, and of how many lines it is the first."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    ends = pairs.select("id", F.lit(True).alias("paired"), none.alias("n")).union(pairs.select("head", F.lit(False), one))
    wanted = stored(ends.groupBy("id").agg(F.max("paired").alias("paired"), F.sum("n").alias("n")), "line-wanted")
    known = _maybe(found, wanted).select("id", "twin", "line").join(wanted, "id")
    return stored(known.dropDuplicates(["id", "twin"]), "line-texts")


def _similar(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """(id, twin, head, head_twin) of the pairs whose shingle sets are similar enough.

    ``known`` may have more lines, and count more pairs. A first line with very many pairs is sent to
    several tasks, which share its pairs.
    """
    firsts = known.where("n > 0").withColumn("parts", F.ceil(F.col("n") / SHARE))
    heads = stored(firsts.groupBy(F.col("id").alias("head")).agg(F.max("n").alias("n"), F.max("parts").alias("parts")), "line-heads")
    dealt = looked_up(pairs, heads, "head", ["parts"], weight="n")
    dealt = dealt.select("id", "head", F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"))
    left = dealt.join(known.where("paired").select("id", "twin", "line"), "id")
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    right = firsts.select(F.col("id").alias("head"), F.col("twin").alias("head_twin"), F.col("line").alias("head_line"), part)
    # A first line is cut into shingles once in each task that shares its pairs, after it was sent there.
    right = right.repartition("head", "part").select("head", "head_twin", "part", shingles(F.col("head_line")).alias("t"))
    both = left.join(right, ["head", "part"]).where(5 * _places(F.col("line")) >= 4 * F.size("t"))
    sets = both.select("id", "twin", "head", "head_twin", shingles(F.col("line")).alias("s"), "t")
    # common / (s + t - common) >= 0.8, in whole numbers
    return sets.where(9 * F.size(F.array_intersect("s", "t")) >= 4 * (F.size("s") + F.size("t"))).select("id", "twin", "head", "head_twin")


def _verified(pairs: DataFrame, known: DataFrame, lines: int) -> DataFrame:
    """All pairs that are similar enough, verified in slices of about ``lines`` pairs, as each pair takes a text along."""
    slices = -(-pairs.count() // max(1, lines))
    if slices <= 1:
        return _similar(pairs, known)
    own = F.pmod(F.xxhash64("id", "head"), F.lit(slices))
    return reduce(DataFrame.union, [stored(_similar(pairs.where(own == i), known), "line-links") for i in range(slices)])


def _mixed(members: DataFrame, parts: DataFrame) -> DataFrame:
    """(value, id, bits, component, n) of the buckets in which lines of several components are left."""
    named = members.join(parts.withColumnRenamed("node", "id"), "id", "left")
    named = named.select("value", "id", *BITS, "n", F.coalesce("component", "id").alias("component"))
    ends = named.groupBy("value").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("lines"))
    ends = stored(ends.where("least != most"), "line-mixed")
    found = looked_up(_maybe(named, ends, "value"), ends, "value", ["least"], weight="lines")
    return stored(found.where(F.col("least").isNotNull()).drop("least"), "line-left")


def _paired(left: DataFrame) -> DataFrame:
    """Pairs of lines of different components in buckets of at most PAIRED."""
    few = left.where(F.col("n") <= PAIRED)
    return few.join(_others(few, "value"), "value").where((F.col("component") < F.col("_component")) & _hopeful(*_both())).select(*_ordered("id", "other"), _apart(*_both()).alias("apart"))


def _sizes(crowd: DataFrame) -> DataFrame:
    """(value, main, lines, parts): of each crowd the largest component, and the tasks that compare all others with all lines."""
    sizes = crowd.groupBy("value", "component").agg(F.count("*").alias("lines"))
    largest = F.max_by("component", F.struct("lines", "component")).alias("main")
    sizes = sizes.groupBy("value").agg(largest, F.max("lines").alias("most"), F.sum("lines").alias("lines"))
    work = (F.col("lines") - F.col("most")) * F.col("lines")
    return stored(sizes.select("value", "main", "lines", F.ceil(work / COMPARED).alias("parts")), "line-crowds")


def _faced(crowd: DataFrame, sizes: DataFrame) -> DataFrame:
    """(value, id, head, apart): the pairs of different components in the crowds that ``sizes`` has."""
    dealt = looked_up(crowd, sizes, "value", ["main", "parts"], weight="lines")
    others = _others(dealt.where(F.col("component") != F.col("main")), "value", F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"))
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    every = dealt.select("value", "id", *BITS, "component", (F.col("component") == F.col("main")).alias("in_main"), part)
    alike = (F.col("component") != F.col("_component")) & (F.col("in_main") | (F.col("id") < F.col("other"))) & _hopeful(*_both())
    return every.join(others, ["value", "part"]).where(alike).select("value", *_ordered("id", "other"), _apart(*_both()).alias("apart"))


def _crowds(crowd: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs of a crowd's lines in different components. Pairs are counted before any are stored."""
    sizes = _sizes(crowd)
    pairs = stored(_faced(crowd, sizes.where(F.col("parts") <= FACED)).groupBy("value").agg(F.count("*").alias("pairs")), "line-met")
    cheap = (F.col("parts") <= FACED) & (F.coalesce("pairs", F.lit(0)) <= MET * F.col("lines"))
    sizes = stored(sizes.join(pairs, "value", "left").withColumn("cheap", cheap), "line-crowds")
    more = _faced(crowd, sizes.where("cheap")).drop("value")
    rest = sizes.where("NOT cheap")
    if rest.isEmpty():
        return more
    crowd = looked_up(crowd, rest, "value", ["main"], weight="lines")
    crowd = stored(crowd.where(F.col("main").isNotNull()).drop("main"), "line-rest")
    ids = crowd.select("id").distinct()
    known = stored(_maybe(found, ids).select("id", "twin", "line").join(ids, "id", "left_semi").dropDuplicates(["id", "twin"]), "line-texts")
    return more.union(_across(crowd, known))


def _rarest(crowd: DataFrame, known: DataFrame) -> DataFrame:
    """(id, n, shingle): so many of a line's rarest shingles that similar lines share one.

    Lines with n shingles share at least 0.8 * n of them with a similar line, so of any common order the
    first n - ceil(0.8 * n) + 1 have one that the other line's first ones have as well.
    """
    single = known.join(crowd.select("id").distinct(), "id", "left_semi").select("id", "twin", shingles(F.col("line")).alias("hashes"))
    single = stored(single.select("id", "twin", F.size("hashes").alias("n"), F.explode("hashes").alias("shingle")), "line-shingles")
    often = single.groupBy("shingle").agg(F.count("*").alias("often"))
    counted = looked_up(single, stored(often, "line-often"), "shingle", ["often"], weight="often")
    ranked = counted.groupBy("id", "twin", "n").agg(F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("ranked"))
    length = F.col("n") - F.floor((4 * F.col("n") + 4) / 5).cast("int") + 1
    return ranked.select("id", "n", F.explode(F.slice("ranked", F.lit(1), length)["shingle"]).alias("shingle"))


def _across(crowd: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs of a crowd's lines in different components that share one of their rarest shingles.

    A pair has a line outside the largest component of the lines that share a shingle, so only these
    are joined with the others.
    """
    crowd = crowd.select("value", "id", *BITS, "component")
    postings = stored(crowd.join(_rarest(crowd, known), "id"), "line-postings")
    main = postings.groupBy("value", "shingle", "component").agg(F.count("*").alias("lines"))
    main = main.groupBy("value", "shingle").agg(F.max_by("component", F.struct("lines", "component")).alias("main"), F.count("*").alias("parts"))
    several = main.where("parts > 1").select("value", "shingle", "main")
    others = postings.join(several, ["value", "shingle"]).where(F.col("component") != F.col("main"))
    other = _others(others.withColumn("_n", F.col("n")), "value", "shingle", "_n")
    alike = (F.col("component") != F.col("_component")) & (5 * F.least("n", "_n") >= 4 * F.greatest("n", "_n")) & _hopeful(*_both())
    return postings.join(other, ["value", "shingle"]).where(alike).select(*_ordered("id", "other"), _apart(*_both()).alias("apart"))


def _joined_up(more: DataFrame, edges: DataFrame, known: DataFrame, size: int) -> DataFrame:
    """The links, with those of the pairs that are still needed for the same components.

    Where pairs are many more than lines, every line is first verified with the one most like it, and
    pairs whose lines have come to be of one component meanwhile are left out; the rest are all verified.
    """
    found, before = edges, 0
    while True:
        pairs, lines = more.count(), more.select("id").distinct().count()
        if pairs <= CROWDED * lines or (before and 5 * pairs > 4 * before):
            return found.union(_verified(more.select("id", "head"), known, size))
        nearest = more.groupBy("id").agg(F.min_by("head", F.struct("apart", "head")).alias("head"))
        nearest = stored(nearest, "line-nearest")
        found, before = found.union(stored(_similar(nearest, known), "line-links")), pairs
        parts = stored(components(found), "line-parts")
        named = more.join(nearest, ["id", "head"], "left_anti").join(parts.toDF("id", "component"), "id", "left").join(parts.toDF("head", "_component"), "head", "left")
        more = stored(named.where(F.coalesce("component", "id") != F.coalesce("_component", "head")).select("id", "head", "apart"), "line-more")


def links(signed: DataFrame, found: DataFrame) -> DataFrame:
    """(id, twin, head, head_twin) of similar lines: a graph with the components of all pairs that meet."""
    two, members = _buckets(signed)
    pairs = stored(two.union(members.where("id != head AND near").select("id", "head")).distinct(), "line-pairs")
    size = signed.count()
    edges = stored(_verified(pairs, _known(found, pairs), size), "line-links")
    left = _mixed(members, components(edges))
    if left.isEmpty():
        return edges
    more = _paired(left)
    crowd = left.where(F.col("n") > PAIRED)
    if not crowd.isEmpty():
        more = more.union(_crowds(crowd, found))
    more = stored(more.distinct().join(pairs, ["id", "head"], "left_anti"), "line-more")
    return _joined_up(more, edges, _known(found, more), size)


def groups(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lines, and (id, twin, rows, kept) of those that are not alone: ``kept`` is the place that stays."""
    found = lines(docs)
    signed = stored(signatures(found), "line-signatures")
    edges = stored(links(signed, found), "line-edges")
    nodes = edges.select("id", "twin").union(edges.select("head", "head_twin")).distinct()
    nodes = nodes.join(components(edges).withColumnRenamed("node", "id"), "id")
    place = F.struct(*PLACE)
    named = stored(signed.select("id", "twin", "rows", place.alias("place")).join(nodes, ["id", "twin"], "left").where("component IS NOT NULL OR rows > 1"), "line-groups")
    several = named.where("component IS NOT NULL")
    kept = several.groupBy("component").agg(F.min("place").alias("kept"))
    several = several.join(kept, "component").select("id", "twin", "rows", "kept")
    return found, several.union(named.where("component IS NULL").select("id", "twin", "rows", "place"))


def dropped_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, dropped): the numbers, from 0, of the lines of each document that go."""
    found, several = groups(docs)
    several = stored(several, "line-several")
    places = looked_up(_maybe(found.drop("line"), several), several, ["id", "twin"], ["kept"], weight="rows")
    gone = places.where(F.col("kept").isNotNull() & ~F.struct(*PLACE).eqNullSafe(F.col("kept"))).select(*PLACE).distinct()
    return gone.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list("line_no")).alias("dropped"))


def _joined(docs: DataFrame, rows: DataFrame) -> DataFrame:
    gone = dropped_lines(docs).select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), "dropped")
    own = rows["doc_id"].eqNullSafe(gone["_doc"]) & (rows["text_hash"] == gone["_hash"])
    none = F.array().cast("array<int>")
    return rows.join(gone, own, "left").drop("_doc", "_hash").withColumn("dropped", F.coalesce("dropped", none))


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, dropped) of every row; ``dropped`` has the numbers of lines that go."""
    counted = F.size(F.filter(F.split("text", "\n"), lambda line: normal(line) != ""))
    rows = texts(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), counted.cast("long").alias("n_lines"))
    return _joined(docs, rows).select(
        "doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"), F.array_join(F.col("dropped").cast("array<string>"), ",").alias("dropped")
    )


def without_dropped(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of every row without the lines that go."""
    rows = texts(docs).withColumn("text_hash", F.xxhash64("text"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(F.split("text", "\n")) - 1), F.col("dropped"))
    split = F.transform(F.array(F.split("text", "\n")), lambda own: F.transform(kept, lambda i: F.get(own, i)))
    return _joined(docs, rows).select("doc_id", F.array_join(F.get(split, F.lit(0)), "\n").alias("text"))
