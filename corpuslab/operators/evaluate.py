"""Model evaluation from token predictions, latencies, logits and metric reports.

``by`` may name any columns (model, run, sample …): all groups are evaluated in
one shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpuslab.functions.arrays import once
from corpuslab.session import via_table

from .labelling import IGNORE, LABELS
from .ranks import percentiles
from .scan import Running, running, running_count
from .skew import join_keys, small_side

LABEL_IDS = list(range(len(LABELS)))
CHEMICAL, DISEASE = LABELS.index("B-Chemical"), LABELS.index("B-Disease")
QUANTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 where whole is 0."""
    return F.when(whole != 0, part / whole).otherwise(0.0)


# ---- token metrics


def prediction_pairs(df: DataFrame, keys: list[str], models: dict[str, str], gold: str = "gold") -> DataFrame:
    """(keys, model, position, gold, pred) rows from arrays, ignored tokens left out.

    ``models`` maps a model name to the column with its predictions. Arrays are
    paired up to the shorter one.
    """
    columns = {model: f"_p{i}" for i, model in enumerate(models)}
    rows = paired_rows(df, keys, {columns[m]: c for m, c in models.items()}, gold).filter(F.col("gold").isNotNull())
    answers = [F.struct(F.lit(m).alias("model"), F.col(c).alias("pred")) for m, c in columns.items()]
    return rows.select(*keys, "position", "gold", F.inline(F.array(*answers)))


def paired_rows(df: DataFrame, keys: list[str], preds: dict[str, str], gold: str = "gold") -> DataFrame:
    """One row per position with gold and all predictions, null where the token
    is ignored. A row without tokens stays, with nulls."""
    size = F.least(F.size(gold), *[F.size(c) for c in preds.values()])
    valued = F.transform(gold, lambda g: F.when(g != IGNORE, g))
    arrays = [F.slice(valued, F.lit(1), size).alias("gold")]
    arrays += [F.slice(c, F.lit(1), size).alias(name) for name, c in preds.items()]
    rows = (
        df.select(*keys, *arrays)
        .select(*keys, F.posexplode_outer(F.arrays_zip("gold", *preds)).alias("position", "t"))
        .select(*keys, "position", "t.*")
    )
    return rows.withColumns({p: F.when(F.col("gold").isNotNull(), F.col(p)) for p in preds})


def join_predictions(gold: DataFrame, pred: DataFrame, keys: list[str]) -> DataFrame:
    """The same pairs from two tables with one row per token."""
    return gold.filter(F.col("gold") != IGNORE).join(pred, keys)


def confusion(pairs: DataFrame, by: list[str]) -> DataFrame:
    return pairs.groupBy(*by, "gold", "pred").agg(F.count(F.lit(1)).alias("n"))


def classification_report(pairs: DataFrame, by: list[str], labels: list[int] | None = None) -> DataFrame:
    """precision, recall, f1 and support per class.

    With ``labels`` exactly these classes are listed, absent ones with zeros;
    without, the classes seen in gold or prediction.
    """

    def part(label: Column, hit: Column, support: Column, predicted: Column) -> Column:
        return F.struct(
            label.alias("label"), hit.alias("hit"), support.alias("support"), predicted.alias("predicted")
        )

    n, none = F.col("n"), F.lit(0).cast("bigint")
    hit = F.when(F.col("gold") == F.col("pred"), n).otherwise(none)
    parts = [part(F.col("gold"), hit, n, none), part(F.col("pred"), none, none, n)]
    if labels is not None:
        parts += [part(F.lit(x), none, none, none) for x in labels]
    counted = (
        confusion(pairs, by)
        .select(*by, F.inline(F.array(*parts)))
        .groupBy(*by, "label")
        .agg(*[F.sum(c).alias(c) for c in ("hit", "support", "predicted")])
    )
    if labels is not None:
        counted = counted.filter(F.col("label").isin(labels))
    return counted.select(
        *by,
        "label",
        ratio(F.col("hit"), F.col("predicted")).alias("precision"),
        ratio(F.col("hit"), F.col("support")).alias("recall"),
        ratio(F.col("hit") * 2, F.col("support") + F.col("predicted")).alias("f1"),
        "support",
    )


def macro_f1(report: DataFrame, by: list[str]) -> DataFrame:
    return report.groupBy(*by).agg(F.avg("f1").alias("macro_f1"))


def weighted_f1(report: DataFrame, by: list[str]) -> DataFrame:
    return report.groupBy(*by).agg(
        ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1")
    )


def entity_f1(report: DataFrame, by: list[str]) -> DataFrame:
    """F1 of the two B- classes; this is how chemical and disease F1 are defined."""

    def of(label: int) -> Column:
        return F.coalesce(F.max(F.when(F.col("label") == label, F.col("f1"))), F.lit(0.0))

    return report.groupBy(*by).agg(of(CHEMICAL).alias("chemical_f1"), of(DISEASE).alias("disease_f1"))


def metric_sums(pred: str, labels: list[int] = LABEL_IDS) -> list[Column]:
    """Counts of right tokens, hits and sizes per class for one prediction column."""
    gold, guess = F.col("gold"), F.col(pred)
    sums = [F.count_if(gold == guess).alias(f"{pred}_correct")]
    for x in labels:
        sums += [
            F.count_if((gold == x) & (guess == x)).alias(f"{pred}_h{x}"),
            F.count_if(gold == x).alias(f"{pred}_g{x}"),
            F.count_if(guess == x).alias(f"{pred}_p{x}"),
        ]
    return sums


def row_counts(df: DataFrame, keys: list[str], preds: dict[str, str], gold: str = "gold") -> DataFrame:
    """keys, num_tokens and the counts of ``metric_sums`` for every row of
    arrays, counted inside the row: no token becomes a row of its own. Arrays
    are paired up to the shortest; ignored tokens and missing answers count
    nowhere."""
    size = F.least(F.size(gold), *[F.size(c) for c in preds.values()])
    cut = once(
        df.select(*keys, gold, *dict.fromkeys(preds.values())),
        _gold=F.transform(F.slice(gold, F.lit(1), size), lambda g: F.when(g != IGNORE, g)),
        **{f"_{p}": F.slice(c, F.lit(1), size) for p, c in preds.items()},
    )
    hits = {f"_{p}_hits": F.zip_with("_gold", f"_{p}", lambda g, x: F.when(g == x, g)) for p in preds}
    guesses = {f"_{p}_guess": F.zip_with("_gold", f"_{p}", lambda g, x: F.when(g.isNotNull(), x)) for p in preds}
    paired = once(cut, **hits, **guesses)

    def known(values: str) -> Column:
        return F.coalesce(F.size(F.array_compact(values)), F.lit(0)).cast("bigint")

    def count(values: str, label: int) -> Column:
        return F.coalesce(F.size(values) - F.size(F.array_remove(values, label)), F.lit(0)).cast("bigint")

    columns = [known("_gold").alias("num_tokens")]
    for p in preds:
        columns.append(known(f"_{p}_hits").alias(f"{p}_correct"))
        for x in LABEL_IDS:
            columns += [
                count(f"_{p}_hits", x).alias(f"{p}_h{x}"),
                count("_gold", x).alias(f"{p}_g{x}"),
                count(f"_{p}_guess", x).alias(f"{p}_p{x}"),
            ]
    return paired.select(*keys, *columns)


def added_counts(counted: DataFrame, by: list[str]) -> DataFrame:
    """``row_counts`` of all rows of a group."""
    names = [c for c in counted.columns if c not in by]
    return counted.groupBy(*by).agg(*[F.sum(c).alias(c) for c in names])


def sample_metrics(df: DataFrame, keys: list[str], models: dict[str, str], gold: str = "gold") -> DataFrame:
    """``token_metrics`` by keys and model, from arrays; samples without counted
    tokens are left out."""
    names = {model: f"m{i}" for i, model in enumerate(models)}
    counted = row_counts(df, keys, {names[m]: c for m, c in models.items()}, gold)
    answers = []
    for model, name in names.items():
        fields = [c for c in counted.columns if c.startswith(f"{name}_")]
        renamed = [F.col(c).alias("pred" + c[len(name) :]) for c in fields]
        answers.append(F.struct(F.lit(model).alias("model"), "num_tokens", *renamed))
    rows = counted.filter(F.col("num_tokens") > 0).select(*keys, F.inline(F.array(*answers)))
    summed = added_counts(rows, [*keys, "model"])
    return summed.select(*keys, "model", "num_tokens", *[c.alias(n) for n, c in metric_columns("pred").items()])


def metric_columns(pred: str, labels: list[int] = LABEL_IDS) -> dict[str, Column]:
    """Metrics computed from ``metric_sums``."""
    sizes = {x: F.col(f"{pred}_g{x}") + F.col(f"{pred}_p{x}") for x in labels}
    f1 = {x: ratio(F.col(f"{pred}_h{x}") * 2, sizes[x]) for x in labels}

    def total(parts: list[Column]) -> Column:
        return sum(parts[1:], parts[0])

    seen = total([F.when(sizes[x] > 0, 1).otherwise(0) for x in labels])
    support = total([F.col(f"{pred}_g{x}") for x in labels])
    columns = {
        "correct": F.col(f"{pred}_correct"),
        "accuracy": ratio(F.col(f"{pred}_correct"), F.col("num_tokens")),
        "macro_f1": ratio(total(list(f1.values())), seen),
        "macro_f1_fixed": total(list(f1.values())) / len(labels),
        "weighted_f1": ratio(total([f1[x] * F.col(f"{pred}_g{x}") for x in labels]), support),
    }
    for name, label in (("chemical_f1", CHEMICAL), ("disease_f1", DISEASE)):
        if label in labels:
            columns[name] = f1[label]
    return columns


def token_metrics(pairs: DataFrame, by: list[str], labels: list[int] = LABEL_IDS) -> DataFrame:
    """All token metrics of a group as one row, from one aggregate.

    ``macro_f1`` averages the classes seen in gold or prediction,
    ``macro_f1_fixed`` the given ones.
    """
    counted = pairs.groupBy(*by).agg(F.count("gold").alias("num_tokens"), *metric_sums("pred", labels))
    return counted.select(*by, "num_tokens", *[c.alias(n) for n, c in metric_columns("pred", labels).items()])


def token_accuracy(pairs: DataFrame, by: list[str], entities_only: bool = False) -> DataFrame:
    """Share of right tokens; ``entities_only`` looks only at tokens whose gold label is not O."""
    looked_at = pairs.filter(F.col("gold") != 0) if entities_only else pairs
    return looked_at.groupBy(*by).agg(
        F.count(F.lit(1)).alias("tokens"), F.avg((F.col("gold") == F.col("pred")).cast("double")).alias("accuracy")
    )


# ---- latency


def skip_warmup(df: DataFrame, by: list[str], order: str, n: int) -> DataFrame:
    """All rows but the first ``n`` of each group by a unique ``order`` column.

    Only the cut-off of each group is looked for, so nothing but the first rows
    of each partition is shuffled.
    """
    first = Window.partitionBy(*by).orderBy(order)
    cut = (
        df.select(*by, order)
        .withColumn("_row", F.row_number().over(first))
        .filter(F.col("_row") <= n)
        .groupBy(*by)
        .agg(F.max(order).alias("_cut"))
    )
    return join_keys(df, small_side(cut), by).filter(F.col(order) > F.col("_cut")).drop("_cut")


def per_sample_latency(df: DataFrame, batch_ms: str = "batch_ms", rows: str = "batch_rows") -> DataFrame:
    return df.withColumn("latency_ms", F.col(batch_ms) / F.col(rows))


def latency_profile(
    df: DataFrame, by: list[str], value: str = "latency_ms", approximate: bool = False, group_rows: int | None = None
) -> DataFrame:
    """Mean, population deviation, p50, p95 and p99 per group.

    Percentiles are exact and interpolated by default; ``approximate`` takes
    the one-pass sketch instead.
    """
    basic = [
        F.count(value).alias("runs"),
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("std"),
    ]
    if approximate:
        sketch = [F.percentile_approx(value, q, 10_000).alias(n) for n, q in QUANTILES.items()]
        return df.groupBy(*by).agg(*basic, *sketch)
    return join_keys(df.groupBy(*by).agg(*basic), percentiles(df, by, value, QUANTILES, group_rows), by, "left")


# ---- sizes and comparisons


def size_report(df: DataFrame, by: list[str], weights: str, width: int = 4) -> DataFrame:
    """Number of parameters and mebibytes of a weight table with one array per row."""
    return df.groupBy(*by).agg(
        F.sum(F.size(weights)).alias("parameters"),
        (F.sum(F.size(weights).cast("bigint") * width) / 1_048_576).alias("model_size_mb"),
    )


def long_report(wide: DataFrame, keys: list[str]) -> DataFrame:
    """One row per metric column: (keys, metric, value)."""
    metrics = [c for c in wide.columns if c not in keys]
    rows = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    return wide.select(*keys, F.inline(F.array(*rows)))


def variant_summary(report: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """One row per variant, one column per metric."""
    return report.groupBy(*keys, "variant").pivot("metric", metrics).agg(F.first("value"))


def compare_to_baseline(report: DataFrame, baseline: str, keys: list[str] | None = None) -> DataFrame:
    """F1 retention %, parameter reduction %, speed-up and compression ratio
    of every other variant, per ``keys``."""
    keys = keys or []
    metrics = ["macro_f1", "parameters", "latency_mean_ms"]
    wide = variant_summary(report, keys, metrics)
    base = wide.filter(F.col("variant") == baseline).select(*keys, *[F.col(m).alias(f"_b_{m}") for m in metrics])
    others = wide.filter(F.col("variant") != baseline)
    if keys:
        both = join_keys(others, small_side(base), keys)
    else:
        both = others.withColumns({f"_b_{m}": base.select(f"_b_{m}").scalar() for m in metrics})
    share = F.try_divide(F.col("parameters"), F.col("_b_parameters"))
    return both.select(
        *keys,
        "variant",
        (F.try_divide(F.col("macro_f1"), F.col("_b_macro_f1")) * 100).alias("f1_retention_pct"),
        ((1 - share) * 100).alias("param_reduction_pct"),
        F.try_divide(F.col("_b_latency_mean_ms"), F.col("latency_mean_ms")).alias("speedup"),
        F.try_divide(F.col("_b_parameters"), F.col("parameters")).alias("compression_ratio"),
    )


def delta_table(report: DataFrame, first: str, second: str, keys: list[str] | None = None) -> DataFrame:
    """Change of every metric from one variant to another: plain and, signed, in points."""

    def of(variant: str) -> Column:
        return F.max(F.when(F.col("variant") == variant, F.col("value")))

    change = F.col("second") - F.col("first")
    return (
        report.groupBy(*(keys or []), "metric")
        .agg(of(first).alias("first"), of(second).alias("second"))
        .withColumns({"delta": change, "points": F.format_string("%+.2f", F.round(change * 100, 2))})
    )


# Targets of the compression run.
MIN_SPEEDUP, MAX_F1_DROP, MIN_SPARSITY, MAX_P95_MS = 2.5, 0.02, 0.38, 20.0


def target_checks(summary: DataFrame) -> DataFrame:
    """Booleans for speedup, f1_drop, sparsity and latency_p95_ms."""
    return summary.withColumns(
        {
            "speedup_met": F.col("speedup") >= MIN_SPEEDUP,
            "f1_drop_met": F.col("f1_drop") < MAX_F1_DROP,
            "sparsity_met": F.col("sparsity") >= MIN_SPARSITY,
            "latency_met": F.col("latency_p95_ms") < MAX_P95_MS,
        }
    )


def select_checkpoint(
    history: DataFrame,
    by: list[str],
    min_delta: float = 0.001,
    patience: int | None = 3,
    group_rows: int | None = None,
) -> DataFrame:
    """Best epoch of each run. An epoch counts as better by more than
    ``min_delta``; after ``patience`` epochs without one the run stops.

    Only a value above all earlier ones can be better; a scan that splits long
    runs finds those rows. A second scan links each to the next one that is
    better by ``min_delta``, if it comes before patience is out. The end of the
    chain of links from a run's start is found by doubling: in every round each
    row takes over the link of the row it points to.
    """
    numbered = running(
        history,
        by,
        ["epoch"],
        [running_count("_row"), Running("_max", "max", F.col("val_macro_f1"))],
        group_rows,
    )
    before = running(numbered, by, ["epoch"], [Running("_before", "previous", F.col("_max"))], group_rows)
    rows = via_table(before, "epochs")
    runs = rows.groupBy(*by).agg(F.max("_row").alias("_epochs"))
    record = F.col("_before").isNull() | (F.col("val_macro_f1") > F.col("_before"))
    records = rows.filter(record & F.col("val_macro_f1").isNotNull()).select(
        *by, "_row", "epoch", F.col("val_macro_f1").cast("double").alias("value")
    )
    starts = runs.select(
        *by,
        F.lit(0).cast("bigint").alias("_row"),
        F.lit(None).cast(history.schema["epoch"].dataType).alias("epoch"),
        F.lit(0.0).alias("value"),
    )
    ends = _chain_ends(_linked(records, starts, by, min_delta, patience, group_rows), by)
    folded = join_keys(runs, ends, by)
    last = F.col("_epochs") if patience is None else F.least("_epochs", F.col("_row") + patience)
    early = F.lit(False) if patience is None else F.col("_epochs") - F.col("_row") >= patience
    return folded.select(
        *by,
        F.col("epoch").alias("best_epoch"),
        F.col("value").alias("best_value"),
        last.alias("epochs_run"),
        early.alias("stopped_early"),
    )


def _linked(
    records: DataFrame, starts: DataFrame, by: list[str], min_delta: float, patience: int | None, group_rows: int | None
) -> DataFrame:
    """Records and starts with ``_to``: the row of the next record with a value
    above one's own and ``min_delta``, or the own row where there is none in time.

    Along falling values each record is followed by those that look for
    something below it, so what they look for is the last record before them.
    """
    none = F.lit(None).cast("bigint")
    nodes = records.unionByName(starts)
    held = records.select(*by, (-F.col("value")).alias("_at"), F.lit(1).alias("_kind"), F.col("_row").alias("_target"), none.alias("_row"))
    looking = nodes.select(
        *by, (-(F.col("value") + min_delta)).alias("_at"), F.lit(0).alias("_kind"), none.alias("_target"), "_row"
    )
    # At one value those that look come before the record, which must be above it.
    scanned = running(
        held.unionByName(looking),
        by,
        ["_at", "_kind", "_row", "_target"],
        [Running("_next", "last", F.col("_target"))],
        group_rows,
    )
    links = scanned.filter(F.col("_kind") == 0).select(*by, "_row", "_next")
    found = join_keys(nodes, links, [*by, "_row"])
    reached = F.col("_next").isNotNull()
    if patience is not None:
        reached &= F.col("_next") - F.col("_row") <= patience
    return found.withColumn("_to", F.when(reached, F.col("_next")).otherwise(F.col("_row"))).drop("_next")


def _chain_ends(nodes: DataFrame, by: list[str]) -> DataFrame:
    """For each group the last node (_row, epoch, value) of the chain of ``_to``
    that begins at row 0; as many rounds as the logarithm of the longest chain."""
    nodes = via_table(nodes, "links")
    while True:
        onward = nodes.select(*by, F.col("_row").alias("_to"), F.col("_to").alias("_further"))
        hopped = join_keys(nodes, onward, [*by, "_to"])
        moved = hopped.withColumn("_moved", F.col("_further") != F.col("_to"))
        nodes = via_table(moved.drop("_to").withColumnRenamed("_further", "_to"), "links")
        if nodes.filter("_moved").isEmpty():
            break
        nodes = nodes.drop("_moved")
    ends = nodes.filter("_row = 0").select(*by, F.col("_to").alias("_row"))
    return join_keys(ends, nodes.select(*by, "_row", "epoch", "value"), [*by, "_row"])


# ---- distillation loss

TEMPERATURE, ALPHA = 4.0, 0.5


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of all rows one after the other, how many each row has, and
    whether it is known: neither null nor with a null in it."""
    counts = pc.list_value_length(column)
    known = counts.is_valid().to_numpy(zero_copy_only=False)
    counts = pc.fill_null(counts, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten()
    if values.null_count:
        known[np.repeat(np.arange(len(counts)), counts)[values.is_null().to_numpy(zero_copy_only=False)]] = False
    return pc.cast(values, pa.float64()).to_numpy(zero_copy_only=False), counts, known


def _per_row(of: np.ufunc, values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``of`` over the numbers of each row, 0 for none."""
    out, held = np.zeros(len(counts)), np.flatnonzero(counts)
    if len(held):
        out[held] = of.reduceat(values, (np.cumsum(counts) - counts)[held])
    return out


def _log_shares(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Logarithms of the softmax of each row."""
    shifted = values - np.repeat(_per_row(np.maximum, values, counts), counts)
    return shifted - np.log(np.repeat(_per_row(np.add, np.exp(shifted), counts), counts))


def _token_losses(gold: np.ndarray, teacher: pa.ListArray, student: pa.ListArray, temperature: float) -> list[pa.Array]:
    """Divergence and cross entropy of each token; null where something is missing."""
    (t, n, sure), (s, m, known) = _flat(teacher), _flat(student)
    # A label beyond the logits has none.
    inside = known & (gold >= 0) & (gold < m)
    hard = np.zeros(len(gold))
    hard[inside] = -_log_shares(s, m)[(np.cumsum(m) - m + gold)[inside]]
    both = sure & known & (n == m)
    t, s, n = t[np.repeat(both, n)], s[np.repeat(both, m)], n[both]
    lt, ls = _log_shares(t / temperature, n), _log_shares(s / temperature, n)
    soft = np.zeros(len(gold))
    soft[both] = _per_row(np.add, np.exp(lt) * (lt - ls), n)
    return [pa.array(soft, mask=~both), pa.array(hard, mask=~inside)]


def distillation_loss(
    df: DataFrame, by: list[str], temperature: float = TEMPERATURE, alpha: float = ALPHA
) -> DataFrame:
    """alpha * T^2 * KL(teacher, student at temperature T) + (1 - alpha) * cross
    entropy, both averaged over tokens whose label is not ignored."""
    used = df.filter(F.col("gold") != IGNORE).select(*by, F.col("gold").cast("bigint").alias("gold"), "teacher", "student")
    losses = [T.StructField(c, T.DoubleType()) for c in ("soft", "hard")]
    schema = T.StructType([*[used.schema[c] for c in by], *losses])

    def run(batches):
        for batch in batches:
            gold = batch.column("gold").to_numpy(zero_copy_only=False)
            found = _token_losses(gold, batch.column("teacher"), batch.column("student"), temperature)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in by], *found], names=[*by, "soft", "hard"])

    tokens = used.mapInArrow(run, schema)
    averaged = tokens.groupBy(*by).agg(
        F.count(F.lit(1)).alias("tokens"),
        (F.avg("soft") * temperature**2).alias("soft_loss"),
        F.avg("hard").alias("hard_loss"),
    )
    return averaged.withColumn("loss", F.col("soft_loss") * alpha + F.col("hard_loss") * (1 - alpha))


#: Rows and bytes of a sequence that are packed together, and rows given out at once.
PACK_ROWS, PACK_BYTES, GIVEN_ROWS = 1 << 17, 1 << 25, 1 << 18
#: Packed rows that a task takes in at once, and groups of samples per task.
PACKS, GROUPS = 64, 64
#: First columns that may be kept as steps, by a bit each.
STEPPED = 60


@dataclass(frozen=True)
class Beside:
    """Two sequences in one shuffle: a row holds the rows of one side of a group
    of samples as they came, packed, and all rows of a group lie in one task."""

    frame: DataFrame
    schemas: tuple[pa.Schema, pa.Schema]


def side_by_side(a: DataFrame, b: DataFrame, sample: str = "sample_id") -> Beside:
    """The rows of two sequences that have a sample, brought together once for
    ``align_by_position`` and ``align_by_word``. Pieces are short, so a row on
    its own would be mostly keys: rows travel as compressed Arrow batches, whole
    numbers without nulls as steps, which are small where the rows of a sample
    stand together."""
    for name in (sample, "position", "word_idx"):
        if name in a.columns and name in b.columns:
            kind = a.select(name).union(b.select(name)).schema[0].dataType
            a, b = (df.withColumn(name, F.col(name).cast(kind)) for df in (a, b))
    groups = GROUPS * int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packs = pa.schema([("group", pa.int32()), ("side", pa.int32()), ("size", pa.int32()), ("steps", pa.int64()), ("rows", pa.binary())])

    def packed(side: int, df: DataFrame) -> tuple[DataFrame, pa.Schema]:
        own = to_arrow_schema(df.schema)

        def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            group = table.column(0).to_numpy()
            rows = pa.Table.from_arrays(table.columns[1:], names=own.names).cast(own)
            order = np.argsort(group, kind="stable")
            first = np.flatnonzero(np.diff(group[order], prepend=-1))
            columns, steps = [], 0
            for i, column in enumerate(rows.take(pa.array(order)).combine_chunks().columns):
                if i < STEPPED and pa.types.is_integer(column.type) and not column.null_count:
                    values = column.to_numpy()
                    step = np.diff(values, prepend=values[:1])
                    step[first] = values[first]
                    column, steps = pa.array(step, column.type), steps | 1 << i
                columns.append(column)
            batch = pa.Table.from_arrays(columns, schema=own).combine_chunks().to_batches()[0]
            parts = [
                batch.slice(begin, end - begin).serialize()
                for begin, end in zip(first.tolist(), [*first[1:].tolist(), len(order)], strict=True)
            ]
            blobs = [pa.compress(p, "zstd", asbytes=True) for p in parts]
            out = [group[order][first], np.full(len(first), side), [p.size for p in parts], np.full(len(first), steps), blobs]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, packs, strict=True)], schema=packs)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, rows, size = [], 0, 0
            for batch in batches:
                if batch.num_rows:
                    held.append(batch)
                    rows, size = rows + batch.num_rows, size + batch.nbytes
                if rows >= PACK_ROWS or size >= PACK_BYTES:
                    yield pack(held)
                    held, rows, size = [], 0, 0
            if held:
                yield pack(held)

        group = F.pmod(F.xxhash64(sample), F.lit(groups)).cast("int").alias("_group")
        known = df.filter(F.col(sample).isNotNull()).select(group, *df.columns)
        return known.mapInArrow(run, "group int, side int, size int, steps bigint, rows binary"), own

    (left, own_a), (right, own_b) = packed(0, a), packed(1, b)
    frame = left.unionByName(right).repartition("group").sortWithinPartitions("group", "side")
    return Beside(frame, (own_a, own_b))


def _codes(left: pa.ChunkedArray, right: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, int]:
    """Numbers of the values of two columns, equal where the values are, and how many there are."""
    found = pa.chunked_array([*left.chunks, *right.chunks], left.type).combine_chunks().dictionary_encode()
    code = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return code[: len(left)], code[len(left) :], len(found.dictionary)


def _first_rows(table: pa.Table, sample: str) -> pa.Table:
    """The first row by position of each sample and word; where a word has no
    position at all, its other values are null."""
    words, positions = table.column("word_idx"), table.column("position")
    key = np.zeros(len(table), np.int64)
    for column in (table.column(sample), words):
        code, _, n = _codes(column, column.slice(0, 0))
        key = key * n + code
    if pa.types.is_integer(positions.type):
        place = pc.fill_null(positions.cast(pa.int64()), np.iinfo(np.int64).max).to_numpy()
    else:
        place = pc.rank(positions, tiebreaker="dense", null_placement="at_end").to_numpy().astype(np.int64)
    missing = positions.is_null().to_numpy()
    order = np.lexsort((place, missing, key))
    first = order[np.flatnonzero(np.diff(key[order], prepend=-1))]
    out = table.take(pa.array(first))
    for i, name in enumerate(out.column_names if missing[first].any() else ()):
        if name not in (sample, "word_idx"):
            out = out.set_column(i, name, table.column(name).take(pa.array(first, mask=missing[first])))
    return out


def _aligned(a: DataFrame, b: DataFrame, sample: str, spot: str, beside: Beside | None) -> DataFrame:
    beside = beside or side_by_side(a, b, sample)
    by_word = spot == "word_idx"
    others = [[c for c in df.columns if c not in (sample, spot) and not (by_word and c == "position")] for df in (a, b)]
    fields = [a.schema[sample], a.schema[spot], *(df.schema[c] for df, names in zip((a, b), others, strict=True) for c in names)]
    # Both sides may name a column alike: columns are numbered inside.
    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)])
    kinds, schemas = to_arrow_schema(schema), beside.schemas

    def unpacked(size: int, steps: int, rows: bytes, own: pa.Schema) -> pa.RecordBatch:
        columns = pa.ipc.read_record_batch(pa.decompress(rows, size, "zstd"), own).columns
        for i, column in enumerate(columns):
            if steps >> i & 1:
                values = column.to_numpy()
                columns[i] = pa.array(np.cumsum(values, dtype=values.dtype), column.type)
        return pa.RecordBatch.from_arrays(columns, schema=own)

    def opened(parts: list[tuple[int, int, bytes]], own: pa.Schema) -> pa.Table:
        table = pa.Table.from_batches([unpacked(*part, own) for part in parts], own)
        table = table.filter(table.column(spot).is_valid())
        return _first_rows(table, sample) if by_word and len(table) else table

    def joined(parts: tuple[list, list]) -> Iterator[pa.RecordBatch]:
        if not all(parts):
            return
        left, right = (opened(p, own) for p, own in zip(parts, schemas, strict=True))
        keys = [np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)]
        for name in (sample, spot):
            *codes, n = _codes(left.column(name), right.column(name))
            keys = [key * n + code for key, code in zip(keys, codes, strict=True)]
        order = np.argsort(keys[1], kind="stable")
        ordered = keys[1][order]
        begin = np.searchsorted(ordered, keys[0])
        each = np.searchsorted(ordered, keys[0], side="right") - begin
        ends = np.cumsum(each)
        for low in range(0, int(ends[-1]) if len(ends) else 0, GIVEN_ROWS):
            pair = np.arange(low, min(low + GIVEN_ROWS, int(ends[-1])))
            one = np.searchsorted(ends, pair, side="right")
            other = order[begin[one] + pair - (ends[one] - each[one])]
            mine, yours = left.take(pa.array(one)), right.take(pa.array(other))
            columns = [mine.column(c) for c in (sample, spot, *others[0])] + [yours.column(c) for c in others[1]]
            table = pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds)
            yield from table.combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, ([], [])
        for batch in batches:
            for some in (batch.slice(i, PACKS) for i in range(0, batch.num_rows, PACKS)):
                for group, side, *part in zip(*(c.to_pylist() for c in some.columns), strict=True):
                    if group != at:
                        yield from joined(held)
                        at, held = group, ([], [])
                    held[side].append(part)
        yield from joined(held)

    return beside.frame.mapInArrow(run, schema).toDF(*[f.name for f in fields])


def align_by_position(a: DataFrame, b: DataFrame, sample: str = "sample_id", beside: Beside | None = None) -> DataFrame:
    """Rows of both sequences up to the end of the shorter one, position by
    position. ``beside`` holds the rows of both if several alignments share them."""
    return _aligned(a, b, sample, "position", beside)


def align_by_word(a: DataFrame, b: DataFrame, sample: str = "sample_id", beside: Beside | None = None) -> DataFrame:
    """First pieces of the same word in two tokenizations (word_idx null: no
    word). ``beside`` as in ``align_by_position``."""
    return _aligned(a, b, sample, "word_idx", beside)
