"""The registered queries against SQL, and the pipeline against brute force."""

import re

import pytest

import corpus_pipeline
from oracle import differences
from test_text_operators import brute_components, brute_items
from tidemart.llm import langid, pieces, secret_ledger
from tidemart.llm.oracles import ORACLES
from tidemart.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, FOLDER), duck, ORACLES[name]) == ""


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {x["doc_id"]: x["text"] for x in docs.collect()}
    items = [tuple(x) for x in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    # Every text has letters and is in one of the languages, so all pass the first stage.
    assert all(re.search(r"[^\W\d_]", t) for t in rows.values())
    groups = brute_components(list(rows.values()), list(rows), 5)
    first = {i for i, _, component in groups if i == component}
    clean = {i for i in first if not brute_items(rows[i], items)[1]}
    encoder = pieces.Encoder(pieces.load())

    def masked(text):
        spans = []
        for rank, rule in enumerate(secret_ledger.RULES):
            for m in re.finditer(rule.pattern, text, re.A):
                if len(m[rule.group]) >= rule.least:
                    spans.append(m.span())
        out, at = [], 0
        for start, end in sorted(spans):
            if start >= at:
                out += [text[at:start], "[SECRET]"]
            at = max(at, end)
        return "".join(out) + text[at:]

    expected = {i: encoder.encode([masked(rows[i])])[0].tolist() for i in clean}
    found = {x["doc_id"]: x["pieces"] for x in corpus_pipeline.run(spark, FOLDER).collect()}
    assert found == expected


def test_stages_keep_columns_and_pass_empty_tables(spark):
    odd = spark.createDataFrame(
        [(1, None, None, "a b", "x"), (2, "", "en", "c", "y"), (None, "the cat and the dog", "en", "d", "z")],
        "doc_id bigint, text string, lang string, label string, score string",
    )
    train = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    odd = odd.unionByName(train.limit(40), allowMissingColumns=True)
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, FOLDER)
            assert kept.columns == odd.columns, name
            assert kept.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == docs.count()
    assert langid.UNKNOWN not in {x["lang"] for x in train.select("lang").distinct().collect()}
