"""The pipeline stage by stage, and the queries that are registered."""

import sys

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.test_dedup import fingerprint_by_hand, removed_by_hand, roots, words
from tillsight.llm import queries, secret_scan, toxicity

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        out.append(rows)
        if name != "packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    return out


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "substring_dedup", "secret_scan", "packing",
    ]


def test_toxic_documents_go_and_others_stay(spark, stages):
    docs = spark.createDataFrame(stages[0])
    model = queries.toxicity_model(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    kept = [r for r in stages[0] if model.score([r.text or ""])[0] < toxicity.THRESHOLD]
    assert sorted(map(tuple, stages[1]), key=str) == sorted(map(tuple, kept), key=str)


def test_one_document_of_each_group_stays(stages):
    marks = {r.doc_id: fingerprint_by_hand(r.text) for r in stages[1]}
    links = [(a, b) for a in marks for b in marks if a < b and (marks[a] ^ marks[b]).bit_count() <= 3]
    assert sorted(r.doc_id for r in stages[2]) == sorted(set(roots(sorted(marks), links).values()))
    before = {r.doc_id: r for r in stages[1]}
    assert all(r == before[r.doc_id] for r in stages[2])


def test_repeats_are_cut(stages):
    expected = removed_by_hand([(r.doc_id, r.text or "") for r in stages[2]], 20)
    assert {r.doc_id: words(r.text) for r in stages[3]} == {i: e[2] for i, e in expected.items()}
    assert all(r.n_chars == len(r.text) for r in stages[3])


def test_secrets_are_redacted_and_nothing_else(stages):
    before = {r.doc_id: r.text for r in stages[3]}
    assert len(stages[4]) == len(before)
    for r in stages[4]:
        text = before[r.doc_id]
        for s, e, mark in reversed(secret_scan.weak_labels(text)):
            if mark:
                text = text[:s] + secret_scan.MARK + text[e:]
        assert r.text == text


def test_every_document_is_packed(stages):
    length = {}
    for p in stages[5]:
        length[p.doc_id] = length.get(p.doc_id, 0) + p.length
        assert p.doc_tokens >= length[p.doc_id]
    assert set(length) == {r.doc_id for r in stages[4]}


def test_run_gives_the_packed_tokens_of_the_stages(spark, stages):
    def texts(pieces):
        out = {}
        for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
            assert p.start == len(out.get(p.doc_id, b"")) // 4
            out[p.doc_id] = out.get(p.doc_id, b"") + bytes(p.tokens)
        return out

    # where documents are cut follows the order of the rows, their tokens do not
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert texts(got) == texts(stages[5])


def test_every_query_is_registered_and_runs(spark):
    import __spark_entry__

    registered = __spark_entry__.queries()
    assert set(queries.QUERIES) <= set(registered)
    assert sorted(n.split("_")[0] for n in queries.QUERIES if n != "pipeline") == sorted(f"op{i}" for i in range(1, 14))
    for name, query in queries.QUERIES.items():
        assert query(spark, FOLDER).count() > 0, name


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_check_sql(spark, name):
    from tests.compare import connect, differences

    con = connect(FOLDER)
    got = queries.QUERIES[name](spark, FOLDER).toArrow()
    assert differences(got, con.sql(queries.ORACLE_SQL[name]).to_arrow_table()) == []


def test_check_sql_of_the_dedup_queries_on_planted_copies(spark, tmp_path):
    import duckdb

    from tests.compare import differences
    from tests.llm.test_dedup import DOCS, corpus

    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 8))
    near = [base[i % 40] + rng.normal(size=8) * 0.12 for i in range(160)]
    odd = [None, [0.0] * 8, [float("nan")] * 8, [None] * 8, near[3].tolist()]
    vectors = [(7 * i % 401, v.tolist(), i % 40 % 3) for i, v in enumerate(near)]
    vectors += [(500 + i, v, None if i == 4 else 1) for i, v in enumerate(odd)]
    docs = [(i, t, "en", "x") for i, t in corpus(7)]
    made = {
        "embeddings": spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int"),
        "documents": spark.createDataFrame(docs, DOCS),
    }
    con = duckdb.connect()
    for table, df in made.items():
        df.write.parquet(f"{tmp_path}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    for name in ("op3_embedding_dedup", "op6_substring_dedup"):
        got = queries.QUERIES[name](spark, str(tmp_path)).toArrow()
        assert differences(got, con.sql(queries.ORACLE_SQL[name]).to_arrow_table()) == []
    assert con.sql(f"SELECT max(n_links) > 2 FROM ({queries.EMBEDDING_DEDUP_SQL})").fetchall() == [(True,)]


def test_entry_works_without_the_subpackage(monkeypatch):
    import importlib

    import __spark_entry__

    for name in [n for n in sys.modules if n.startswith("tillsight.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "tillsight.llm", None)
    import tillsight

    monkeypatch.delattr(tillsight, "llm", raising=False)
    try:
        module = importlib.reload(__spark_entry__)
        assert not set(queries.QUERIES) & set(module.queries())
    finally:
        monkeypatch.undo()
        importlib.reload(__spark_entry__)
