import json
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from corpuslab.catalog import requests as request_queries, tables, tokens as tok
from corpuslab.plans import corpus_run, experiment_run, labelling_run, monitoring_run
from corpuslab.session import scratch_path, scratch_tables, via_table
from corpuslab.sources.corpus import read_corpus
from tools.check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the given tables")

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def base():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, base, key):
    df = QUERIES[key](spark, SF)
    got = [tuple(r) for r in df.collect()]
    if key not in ORACLES:
        # The smallest tables have no experiment with enough pairs.
        assert got or key == "t07_signed_rank_p"
        return
    cursor = base.execute(ORACLES[key])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, got) == rows_of(names, cursor.fetchall())


def test_every_operator_has_a_query():
    wanted = {f"{family}{i:02d}" for family, n in dict(s=14, p=15, x=10, a=11, n=17, e=19, t=11, o=22, r=6, v=10).items() for i in range(1, n + 1)}
    assert wanted <= {key[:3] for key in QUERIES}
    assert set(ORACLES) <= set(QUERIES)


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert rows and {len(r) for r in rows} == {4} and max(r["rank"] for r in rows) == 10


def test_scratch_tables_are_deleted(spark, tmp_path):
    with scratch_tables():
        rows = via_table(spark.range(3), "kept-for-a-while")
        scratch_path(spark, "never-written")
        names = rows.inputFiles()
        assert rows.count() == 3 and names
    assert not any(Path(n.removeprefix("file://")).exists() for n in names)


def test_corpus_run(spark, tmp_path):
    source = str(tmp_path / "in")
    tables.corpus(spark, SF).write.parquet(source)
    metrics = corpus_run.run(spark, source, str(tmp_path / "out"), partitions=3).first()
    stats = json.loads(spark.read.text(f"{tmp_path}/out/stats").first()[0])
    assert stats["total_documents"] == metrics.clean_records == spark.read.parquet(f"{tmp_path}/out/features").count()
    assert len(stats["top_20_words"]) == 20


def test_labelling_run(spark, tmp_path):
    source = str(tmp_path / "in")
    tables.cleaned(spark, SF).selectExpr("doc_id AS pmid", "text_clean AS text").write.parquet(source)
    report = labelling_run.run(spark, source, str(tmp_path / "out"), tok.rule_predictor).first()
    labels = spark.read.json(f"{tmp_path}/out/labels")
    assert labels.count() == report.total_abstracts == spark.read.parquet(source).count()
    assert report.high_confidence_entities == sum(report.entity_counts.values()) > 0


def test_experiment_run(spark, tmp_path):
    arms = tok.predictions(spark, SF).withColumnRenamed("source", "experiment_id")
    verdicts = experiment_run.run(arms, tok.latencies(spark, SF), str(tmp_path), num_samples=50)
    assert verdicts.agg({"num_samples": "sum"}).first()[0] == 50
    assert spark.read.json(f"{tmp_path}/report").count() == 2 * verdicts.count()


def test_monitoring_runs(spark, tmp_path):
    from corpuslab.catalog.reports import long_report

    status = monitoring_run.check_reports(long_report(spark, SF), str(tmp_path / "reports"))
    assert {r.overall_status for r in status.collect()} <= {"PASS", "WARN", "FAIL"}
    source = str(tmp_path / "log")
    request_queries.log(spark, SF).write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(source)
    for started in monitoring_run.watch_requests(spark, source, str(tmp_path / "panels"), str(tmp_path / "state")):
        started.awaitTermination()
    assert read_corpus(spark, f"{tmp_path}/panels/request_rate").count() > 0
