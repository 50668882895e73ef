"""Rows that a statistic or a repeated id must not take away."""

import random

from fixtures import docs  # noqa: F401

from martwright.llm import licences, simhash


def test_a_notice_whose_words_are_frequent_is_scored(docs):
    """No word of the notice is rare where talk of copyright is common; it is still a notice."""
    rng = random.Random(2)
    talk = [" ".join(rng.sample("copyright reserved rights all river stone garden winter market".split(), 9)) for _ in range(200)]
    rows = [(i, line) for i, line in enumerate(talk)] + [(900, "Copyright, all rights reserved.")]
    table = docs(rows)
    for fitted_on in (table, docs(rows[:3]), docs([])):  # whatever was sampled
        licences.fit(fitted_on)
    asked = licences.paragraphs(table).groupBy("doc_id").count()
    assert asked.count() == len(rows)  # every line has a cue, and all are scored
    assert [r["paragraph"] for r in licences.paragraphs(table).where("doc_id = 900").collect()] == ["copyright, all rights reserved."]


def test_another_text_under_a_repeated_id_stays(docs):
    """One text of doc_id 5 is a copy of doc_id 1; the other is nobody's copy."""
    text, other = (" ".join(f"{c}{i}" for i in range(80)) for c in "wv")
    got = simhash.drop_near_duplicates(docs([(1, text), (5, text), (5, other), (6, other)]))
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == [(1, text), (5, other)]


def test_a_notice_without_a_known_cue_is_scored(docs):
    """Every paragraph meets the model, also one that has none of the words notices usually have."""
    rows = [(1, "A walk by the river.\nReleased under CC0 1.0 Universal.\nMore of it."), (2, "A walk by the river."), (3, None)]
    table = docs(rows)
    assert licences.paragraphs(table).count() == 0
    asked = sorted(map(tuple, licences.all_paragraphs(table).collect()))
    assert asked == [(1, "a walk by the river."), (1, "more of it."), (1, "released under cc0 1.0 universal."), (2, "a walk by the river.")]
    got = {r["doc_id"]: r["licences"] for r in licences.report(table, licences.fit(docs([]))).collect()}
    assert got == {1: "public-domain", 2: "", 3: ""}
