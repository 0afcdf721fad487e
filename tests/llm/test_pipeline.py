"""The stages one by one against brute force on what the stage before kept, and the registered queries."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from millrace.llm import toxicity
from millrace.llm.common import table
from millrace.llm.queries import ORACLES, QUERIES
from tests.llm.helpers import SMALL, by_id, contamination, documents, near_duplicates, remove_lines, sha
from tools.compare import connect, differences

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_against_brute_force(spark):
    docs = documents(spark)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "bpe_round_trip"]
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(stage(spark, tables[-1], SMALL).cache())
    before, clean, lined, single, decontaminated = map(rows_of, tables[:-1])
    assert all(t.columns == COLUMNS for t in tables[:-1])

    scored = by_id(toxicity.score_toxicity(docs, toxicity.learn_field(docs, table(spark, SMALL, "labels"))))
    assert clean == {i: t for i, t in before.items() if not scored[i].predicted}
    left = remove_lines(list(clean.items()))
    assert lined == {i: t for i, t in left.items() if t or not clean[i]}
    components, _ = near_duplicates(lined)
    assert single == {i: t for i, t in lined.items() if components[i] == i}
    hits = contamination(single, rows_of(table(spark, SMALL, "benchmark").selectExpr("item_id AS doc_id", "text")))
    assert decontaminated == {i: t for i, t in single.items() if not hits[i][1]}
    encoded = by_id(tables[-1])
    assert {i: r.decoded_sha256 for i, r in encoded.items()} == {i: sha(t or "") for i, t in decontaminated.items()}
    assert 0 < len(encoded) < len(before)


def test_run_equals_the_stages(spark):
    docs = documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect())) == sorted(map(tuple, docs.collect()))


def test_stages_keep_rows_without_ids_or_text(spark):
    extra = spark.createDataFrame([(None, "some words of no id", "en", "s", 1), (10**9, None, None, None, None), (10**9 + 1, "", None, None, None)], documents(spark).schema)
    docs = extra
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.count() == 3
    empty = extra.filter("false")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SMALL)
        assert empty.count() == 0


def test_rows_are_rejected_one_by_one_whatever_their_ids(spark, monkeypatch):
    bad = toxicity.Field({"wgrumpf": 20.0}, -10.0, score=(-4.0, 8.0, 0.0))
    monkeypatch.setattr(corpus_pipeline, "learn_field", lambda *_: bad)
    rows = [(None, "so grumpf it is"), (None, "so fine it is"), (1, "a grumpf more"), (1, "a clean one"), (2, "quite clean")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.text for r in corpus_pipeline.toxicity_stage(spark, docs, SMALL).collect()} == {"so fine it is", "a clean one", "quite clean"}

    one, two = (" ".join(f"{k}{i}" for i in range(50)) for k in "ab")
    rows = [(None, one), (7, one), (5, one + " more"), (6, two), (6, two), (None, "else"), (None, "other words"), (5, "unlike all others")]
    left = corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), SMALL).collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == sorted([(5, one + " more"), (6, two), (0, "else"), (0, "other words"), (5, "unlike all others")])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    got = QUERIES[name](spark, SMALL).toArrow()
    assert differences(got, connect(SMALL).execute(ORACLES[name]).to_arrow_table()) == []


def test_all_ten_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 11)) and set(QUERIES) <= names
