"""The registered queries and the pipeline on the smallest tables."""

import math
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import brute
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from fixtures import docs, odd_rows  # noqa: F401
from martwright.llm import quality
from martwright.llm.queries import ORACLE, QUERIES
from verification.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def rows(spark):
    return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


def test_all_operators_and_the_pipeline_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())


EXACT = {
    "op1_simhash": (brute.near_duplicates, "doc_id fingerprint component_id"),
    "op2_bpe": (brute.encoded, "doc_id n_tokens ids_sha256 decoded_sha256"),
    "op5_token_store": (brute.stored_tokens, "doc_id start n_tokens ids_crc32"),
    "op8_pii": (brute.personal, "doc_id n_email n_ip n_card n_phone base_sha256"),
    "op10_exact_dedup": (brute.exact_duplicates, "doc_id keep_id group_size kept text_sha256"),
}


@pytest.mark.parametrize("name", EXACT)
def test_query_against_plain_loops(spark, name):
    loop, columns = EXACT[name]
    got = QUERIES[name](spark, FOLDER).select(*columns.split()).collect()
    assert Counter(map(tuple, got)) == Counter(loop(rows(spark)))


def test_decontamination_against_plain_loops(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    columns = "doc_id n_words n_hit n_items items_sha256 contaminated".split()
    got = QUERIES["op9_decontaminate"](spark, FOLDER).select(*columns).collect()
    assert Counter(map(tuple, got)) == Counter(brute.contaminated(rows(spark), items))


@pytest.mark.parametrize("name", ORACLE)
def test_query_against_its_sql(spark, name):
    with connect(FOLDER) as duck:
        assert difference(QUERIES[name](spark, FOLDER), duck, ORACLE[name]) is None


def test_lines_against_plain_loops(spark):
    got = QUERIES["op3_line_dedup"](spark, FOLDER).collect()
    found = {r["doc_id"]: [int(x) for x in r["dropped"].split(",")] for r in got if r["n_dropped"]}
    assert found == brute.dropped_lines(rows(spark)) and len(got) == len(rows(spark))


def test_shards_against_plain_loops(spark):
    got = QUERIES["op6_virtual_slots"](spark, FOLDER).collect()
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows(spark))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    loads, texts, total = defaultdict(list), defaultdict(set), sum(r["size"] for r in got)
    for r in got:
        loads[r["shard"]].append(r)
        texts[r["text_crc32"], r["size"]].add(r["shard"])
    assert set(loads) <= set(range(8)) and all(sorted(r["slot"] for r in m) == list(range(len(m))) for m in loads.values())
    assert all(len(places) == 1 for places in texts.values())  # equal texts lie together
    largest = max(r["size"] for r in got)
    sizes = [sum(r["size"] for r in loads[s]) for s in range(8)]
    assert max(sizes) <= max(total / 8 + largest, total / 8 * 1.02) and {r["law"] for r in got} == {"bytes"}


def test_quality_scores_against_plain_loops(spark):
    """Scores of the query are those of the machine's sum over all pairs, on whole texts."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    machine = quality.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    got = {r["doc_id"]: tuple(r)[1:4] for r in QUERIES["op7_quality_machine"](spark, FOLDER).collect()}
    for doc_id, text in rows(spark)[::9]:
        at, x = machine.row(*quality.features(text or ""))
        vectors = machine.vectors[at] * x[:, None]
        pairs = sum(float(vectors[i] @ vectors[j]) for i in range(len(at)) for j in range(i)) if len(at) < 400 else float((vectors.sum(axis=0) ** 2 - (vectors**2).sum(axis=0)).sum() / 2)
        score = 1 / (1 + math.exp(-(machine.bias + float(machine.weights[at] @ x) + pairs)))
        held, found, predicted = got[doc_id]
        assert found == pytest.approx(score, abs=1e-4) and predicted == (found >= 0.3)
        assert held == (zlib.crc32(str(doc_id).encode()) % 5 == 0)


@pytest.mark.parametrize("name", ["op4_licences", "op6_virtual_slots", "op7_quality_machine"])
def test_every_document_has_a_row(spark, name):
    got = QUERIES[name](spark, FOLDER).select("doc_id").collect()
    assert Counter(r[0] for r in got) == Counter(d for d, _ in rows(spark))


def test_pipeline_against_plain_loops(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    machine = quality.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    left = [(d, t) for d, t in rows(spark) if machine.score(t or "") >= quality.THRESHOLD]
    texts = dict(left)
    left = [(d, texts[d]) for d, _, _, kept, _ in brute.exact_duplicates(left) if kept]
    left = [(d, texts[d]) for d, _, first in brute.near_duplicates(left) if d == first]
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    left = [(r[0], texts[r[0]]) for r in brute.contaminated(left, items) if not r[-1]]
    got = corpus_pipeline.run(spark, FOLDER).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert Counter(map(tuple, got)) == Counter(brute.encoded(left))


def test_stages_take_odd_rows(spark, docs, odd_rows):
    """Null ids and texts, repeated rows and clashing columns pass every stage."""
    table = docs(odd_rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, table, FOLDER)
        kept = Counter((r["doc_id"], r["text"]) for r in got.collect())
        assert got.columns == table.columns and not kept - Counter(odd_rows), name
    assert kept == Counter(odd_rows)  # none of them is contaminated
    last = corpus_pipeline.STAGES[-1][1](spark, table, FOLDER).collect()
    assert Counter(r["doc_id"] for r in last) == Counter(d for d, _ in odd_rows)


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs.limit(0), FOLDER)
        assert got.columns == docs.columns and got.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), FOLDER).count() == 0
