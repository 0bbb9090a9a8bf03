"""Monitoring jobs: report regressions, and a request log watched as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from corpuslab.operators import regress, requests
from corpuslab.session import scratch_tables, via_table
from corpuslab.sources.files import read_request_log
from corpuslab.streaming import requests as live


def check_reports(report: DataFrame, output: str, run: str = "run_id") -> DataFrame:
    """Findings, alerts, status and summary of every run in a long report;
    returns the status rows."""
    with scratch_tables():
        kept = via_table(report, "report")
        findings = via_table(regress.find_regressions(kept, [run]), "findings")
        tables = {
            "findings": findings,
            "alerts": regress.alerts(findings),
            "summary": regress.evaluation_summary(kept, findings, run),
            "status": regress.overall_status(findings, [run]).join(regress.alert_summary(findings, [run]), run),
        }
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{output}/{name}")
    return report.sparkSession.read.parquet(f"{output}/status")


def watch_requests(spark: SparkSession, source: str, output: str, checkpoint: str) -> list[StreamingQuery]:
    """Rates, error rates, entity rates and latency quantiles of a log folder,
    appended as their windows close. Call again to take in new files."""
    panels = {
        "request_rate": requests.request_rate,
        "error_rate": requests.error_rate,
        "entity_rate": requests.entity_rate,
        "latency_quantiles": requests.windowed_quantiles,
    }
    log = live.watermarked(read_request_log(spark, source, streaming=True))
    return [
        live.write_table(panel(log), f"{output}/{name}", f"{checkpoint}/{name}") for name, panel in panels.items()
    ]
