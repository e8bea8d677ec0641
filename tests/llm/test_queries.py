"""The registered queries on the smallest tables: SQL forms in DuckDB, and the pipeline against its parts."""

import re

import corpus_pipeline
import duckdb
import pytest

from llm.queries import ORACLE, QUERIES, table
from llm.shingles import exact_shingles

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_form(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLE[name])
    columns = sorted(d[0] for d in want.description)
    place = [[d[0] for d in want.description].index(c) for c in columns]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    assert sorted(map(repr, (tuple(r) for r in got.select(*columns).collect()))) == sorted(
        repr(tuple(r[i] for i in place)) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted({*QUERIES} - {*ORACLE}))
def test_whole_table(spark, name):
    ids = {r.doc_id for r in table(spark, SF, "documents").select("doc_id").collect()}
    assert {r.doc_id for r in QUERIES[name](spark, SF).select("doc_id").collect()} == ids


def test_pipeline(spark, tmp_path):
    """Each stage on what the one before it kept."""
    docs = table(spark, SF, "documents")
    first = {r.doc_id: r.text for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, SF)
        if name != "best_fit_packing":
            assert made.columns == docs.columns
        made.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        before, after = ([r.doc_id for r in d.select("doc_id").collect()] for d in (docs, out))
        assert {*after} <= {*before}
        if name == "quality_classifier":
            labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
            clean = [d for d in before if labels.get(d) == 1]
            assert len({*after} & {*clean}) >= 0.97 * len(clean)
            bad = [d for d in before if labels.get(d) == 0]
            assert len({*after} & {*bad}) <= 0.3 * len(bad)
        elif name == "exact_dedup":
            plain = lambda d: re.sub(r"[\x20\x09-\x0D]", "", first[d])
            assert len(after) == len({plain(d) for d in after}) and {plain(d) for d in after} == {plain(d) for d in before}
        elif name == "ngram_jaccard_join":
            sets = {d: exact_shingles(first[d], 5) for d in before}
            near = lambda a, b: a and b and 100 * len(a & b) >= 80 * len(a | b)
            assert not any(near(sets[a], sets[b]) for a in after for b in after if a < b)
            for d in {*before} - {*after}:
                assert any(near(sets[d], sets[e]) for e in before if e != d)
        elif name == "source_mix":
            assert max(after.count(d) for d in {*after}) <= 3
        else:
            assert {*after} == {*before}
            used = out.groupBy("sequence_id").agg({"length": "sum"}).collect()
            assert max(r[1] for r in used) <= 1024
        docs = out


def test_pipeline_decides_rows_not_ids(spark, tmp_path):
    """Rows with null or shared ids: each is judged by its own text, and near copies among them leave one."""
    docs = table(spark, SF, "documents")
    clean = {r.doc_id for r in table(spark, SF, "labels").filter("quality = 1 AND toxic = 0").collect()}
    good = [r for r in docs.collect() if r.doc_id in clean and r.lang == "en" and r.text and len(r.text) > 800][:12]
    rows = [r.asDict() | {"doc_id": None if i % 2 else 5} for i, r in enumerate(good)]
    rows += [rows[1] | {"text": "qzx!!! " * 400}, rows[1] | {"text": "jjj### vvv$$$ " * 300}, rows[2] | {"text": rows[2]["text"] + " tail"}]
    more = spark.createDataFrame(rows, docs.schema).unionByName(docs)
    more.write.parquet(f"{tmp_path}/docs")
    more = spark.read.parquet(f"{tmp_path}/docs")
    kept = {r.text for r in corpus_pipeline.quality_classifier(spark, more, SF).collect()}
    assert len({r.text for r in good} - kept) <= 2 and not {rows[-3]["text"], rows[-2]["text"]} & kept
    more = spark.createDataFrame(rows, docs.schema)
    near = [r.text for r in corpus_pipeline.near_copies(spark, more, SF).collect()]
    assert sum(t in near for t in (rows[2]["text"], rows[-1]["text"])) == 1
    mixed = corpus_pipeline.source_mix(spark, more, SF)
    assert mixed.columns == more.columns and mixed.count() > 0


def test_pipeline_exact_copies_shuffle_documents_once(spark, tmp_path):
    """Texts are dealt out twice, by the operator and to keep its choice; rows with null or shared ids leave one of each text."""
    schema = table(spark, SF, "documents").schema
    texts = [(1, "a b"), (1, "a b"), (1, "ab"), (None, "a  b"), (None, "a  b"), (2, "a  b"), (None, "c"), (None, " c"), (0, None), (None, ""),
             (None, " "), (0, "d")]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], schema).repartition(3).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = corpus_pipeline.exact_copies(spark, docs, SF)
        plan = spark._jvm.PythonSQLUtils.explainString(kept._jdf.queryExecution(), "formatted")
        rows = kept.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert kept.columns == docs.columns
    assert sorted(map(repr, ((r.doc_id, r.text) for r in rows))) == sorted(map(repr, [(2, "a  b"), (None, " c"), (None, " "), (0, "d")]))
    dealt = re.findall(r"^\(\d+\) Exchange.*\nInput.*: (.*)$", plan, re.M)
    assert len(dealt) >= 4 and sum("text#" in columns for columns in dealt) == 2
