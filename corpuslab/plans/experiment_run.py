"""Experiment job: paired log, tests and verdict, written as CSV and JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpuslab.operators.experiment import EXPERIMENT, ab_report, ab_verdict, experiment_log
from corpuslab.operators.ranks import first_n
from corpuslab.session import scratch_tables, via_table
from corpuslab.sources.files import write_experiment_log


def run(
    arms: DataFrame,
    latencies: DataFrame,
    output: str,
    num_samples: int | None = None,
    compat: bool = False,
) -> DataFrame:
    """Judge the experiments in ``arms`` (experiment_id, sample_id and the arrays gold,
    pred_a, pred_b); return the verdicts."""
    chosen = arms if num_samples is None else first_n(arms, ["sample_id", "experiment_id"], num_samples)
    with scratch_tables():
        log = via_table(experiment_log(chosen, latencies, [*EXPERIMENT, "sample_id"]), "experiment-log")
        write_experiment_log(log, f"{output}/log")
        ab_report(log, compat=compat).write.mode("overwrite").json(f"{output}/report")
        ab_verdict(log).write.mode("overwrite").json(f"{output}/verdict")
    return log.sparkSession.read.json(f"{output}/verdict").withColumn("log", F.lit(f"{output}/log"))
