"""Arbitrary state on streams: running numbers of sessions with rows put in
order, and a gauge on a dense time grid.

Both need the RocksDB state store: start them inside ``rocksdb_state``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from corpuslab.operators.requests import SLA_MS, edges_of

from .requests import WATERMARK, entities_of, watermarked

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Whole parts of a millisecond in which latencies are added up.
PARTS = 1_000_000


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; a query takes the
    setting along when it starts."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


#: Groups of sessions that share one state. A stream that goes on from a
#: checkpoint needs the number that it began with.
GROUPS = 1024
ROWS = pa.schema(
    [("session", pa.string()), ("at_us", pa.int64()), ("request_id", pa.string()), ("latency_ms", pa.float64()), ("entities", pa.int64())]
)
COUNTS = pa.schema([("session", pa.string()), *[(c, pa.int64()) for c in ("requests", "entities", "total", "within", "last_us")]])


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _opened(packed: bytes) -> pa.Table:
    return pa.ipc.open_stream(packed).read_all()


class SessionNumbers(StatefulProcessor):
    """Rows wait until the watermark has passed them, and are then counted in
    order of time, so a late row changes the numbers after it as in a batch.

    The key is a group of sessions, whose rows are kept and counted together as
    Arrow tables: what a micro-batch costs follows its rows, not its sessions.
    One timer stands at the earliest waiting row, or at the first end of a
    session, when everything about that is forgotten."""

    def __init__(self, gap_us: int, limit_ms: float, names: list[str]):
        self.gap_us, self.limit_ms, self.names = gap_us, limit_ms, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", "counts binary, timer_ms long")
        self.waiting = handle.getListState("waiting", "rows binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pa.concat_tables([pa.Table.from_pandas(f[ROWS.names], ROWS, preserve_index=False).replace_schema_metadata() for f in rows])
        if any(new.column(name).null_count for name in ("at_us", "entities")):
            raise ValueError("a request has no time, or no number of entities")
        self.waiting.appendValue((_packed(new),))
        held, timer_ms = self.counts.get() if self.counts.exists() else (_packed(COUNTS.empty_table()), None)
        self._wake(held, timer_ms, pc.min(new.column("at_us")).as_py())
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed_us = timerValues.getCurrentWatermarkInMs() * 1000
        counts = _opened(self.counts.get()[0])
        rows = pa.concat_tables([ROWS.empty_table(), *(_opened(row[0]) for row in self.waiting.get())])
        is_due = pc.less_equal(rows.column("at_us"), passed_us)
        due, left = rows.filter(is_due), rows.filter(pc.invert(is_due))
        out = None
        if len(due):
            out, counts = self._advance(due, counts)
        if len(left):
            self.waiting.put([(_packed(left),)])
        else:
            self.waiting.clear()
        # A row still to come is later than the watermark, and so beyond the gap of the others.
        counts = counts.filter(pc.greater_equal(counts.column("last_us"), passed_us - self.gap_us))
        wanted = [pc.min(t.column(c)).as_py() + more for t, c, more in ((left, "at_us", 0), (counts, "last_us", self.gap_us + 1)) if len(t)]
        if wanted:
            self._wake(_packed(counts), None, min(wanted))
        else:
            self.counts.clear()
        return iter([] if out is None else [out])

    def _advance(self, due: pa.Table, counts: pa.Table) -> tuple[pd.DataFrame, pa.Table]:
        """The numbers of ``due`` rows, which go on from ``counts``, and the counts after them."""
        sessions = pa.chunked_array([*counts.column("session").chunks, *due.column("session").chunks], pa.string())
        found = sessions.combine_chunks().dictionary_encode(null_encoding="encode")
        code = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        known, code = code[: len(counts)], code[len(counts) :]
        at, latency = due.column("at_us").to_numpy(), due.column("latency_ms").to_numpy()
        if not np.isfinite(latency).all():
            raise ValueError("a latency is not a number that can be added up")
        request = pc.rank(due.column("request_id"), tiebreaker="dense", null_placement="at_start").to_numpy()
        order = np.lexsort((request, at, code))
        code, at, latency = code[order], at[order], latency[order]
        begins = np.diff(code, prepend=-1) != 0
        # Per session: the row of its counts, or one more, of zeros.
        row = np.full(len(found.dictionary), len(counts))
        row[known] = np.arange(len(counts))
        held = [np.append(counts.column(c).to_numpy(), 0) for c in COUNTS.names[1:]]
        before = np.where(begins, held[-1][row[code]], np.roll(at, 1))
        fresh = np.where(begins, row[code] == len(counts), False) | (at - before > self.gap_us)
        first = np.flatnonzero(begins | fresh)
        part = np.cumsum(begins | fresh) - 1
        goes_on = np.where(fresh[first], len(counts), row[code[first]])
        steps = (
            np.ones(len(at), np.int64),
            due.column("entities").to_numpy()[order],
            np.rint(latency * PARTS).astype(np.int64),
            (latency < self.limit_ms).astype(np.int64),
        )
        sums = []
        for step, old in zip(steps, held, strict=False):
            total = np.cumsum(step)
            sums.append(total + (old[goes_on] - total[first] + step[first])[part])
        requests, entities, total, within = sums
        own = due.take(pa.array(order))
        columns = [own.column("session"), own.column("request_id"), at, requests, entities, total / PARTS / requests, within * 100 / requests]
        out = pd.DataFrame({n: c.to_pandas() if isinstance(c, pa.ChunkedArray) else c for n, c in zip(self.names, columns, strict=True)})
        last = np.flatnonzero(np.append(begins[1:], True))
        after = pa.Table.from_arrays(
            [own.column("session").take(pa.array(last)).combine_chunks(), *(pa.array(c[last]) for c in (*sums, at))], schema=COUNTS
        )
        untouched = np.isin(known, code, invert=True)
        return out, pa.concat_tables([counts.filter(pa.array(untouched)), after])

    def _wake(self, counts: bytes, timer_ms: int | None, at_us: int) -> None:
        """Keep ``counts``, and have the timer no later than ``at_us``."""
        wanted = -(-at_us // 1000)
        if timer_ms is None or wanted < timer_ms:
            if timer_ms is not None:
                self.handle.deleteTimer(timer_ms)
            self.handle.registerTimer(wanted)
            timer_ms = wanted
        self.counts.update((counts, timer_ms))

    def close(self) -> None:
        pass


def ordered_session_numbers(
    log: DataFrame,
    session: str,
    gap_seconds: int = 1800,
    delay: str = WATERMARK,
    limit_ms: float = SLA_MS,
    groups: int = GROUPS,
) -> DataFrame:
    """Per answered request: requests, entities, mean latency and share below
    the limit so far in its session, as ``session_metrics`` with a gap counts
    them. A request comes out when the watermark has passed it."""
    # Sessions travel as text, which keeps nulls and large numbers as they are.
    kind = log.schema[session].dataType
    rows = watermarked(log.filter(F.col("latency_ms").isNotNull()), delay).select(
        F.pmod(F.xxhash64(session), F.lit(groups)).cast("int").alias("group"),
        F.col(session).cast("string").alias("session"),
        "timestamp",
        F.unix_micros("timestamp").alias("at_us"),
        "request_id",
        "latency_ms",
        entities_of().alias("entities"),
    )
    out = T.StructType(
        [
            T.StructField("session", T.StringType()),
            T.StructField("request_id", T.StringType()),
            T.StructField("at_us", T.LongType()),
            T.StructField("requests", T.LongType()),
            T.StructField("entities", T.LongType()),
            T.StructField("mean_latency_ms", T.DoubleType()),
            T.StructField("sla_pct", T.DoubleType()),
        ]
    )
    processor = SessionNumbers(gap_seconds * 1_000_000, limit_ms, out.names)
    found = rows.groupBy("group").transformWithStateInPandas(processor, out, "Append", "EventTime")
    return found.select(F.col("session").cast(kind).alias(session), *out.names[1:])


class DenseGauge(StatefulProcessor):
    """Steps come closed and in order; the state is the last one and its level."""

    def __init__(self, step: int, names: list[str]):
        self.step, self.names = step, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.level = handle.getValueState("level", "at long, in_flight long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # All at once: state belongs to the key of this call, which a generator would outlive.
        known = self.level.get() if self.level.exists() else None
        at, level = known if known is not None else (None, 0)
        spans = sorted(
            span for frame in rows for span in zip(frame["span_start"], frame["started"], frame["ended"], strict=True)
        )
        out = []
        for now, started, ended in spans:
            if at is not None:
                out += [(key[0], t, 0, 0, level) for t in range(at + self.step, int(now), self.step)]
            at, level = int(now), level + int(started) - int(ended)
            out.append((key[0], at, int(started), int(ended), level))
        self.level.update((at, level))
        return iter([pd.DataFrame(out, columns=self.names)])

    def close(self) -> None:
        pass


def active_requests_stream(log: DataFrame, by: str, span_seconds: int = 60, delay: str = WATERMARK) -> DataFrame:
    """``active_requests`` per ``by`` on a stream: edges are counted by time
    span; a closed span and those without an edge before it come out with the
    requests in flight at their end. A request may begin at most ``delay``
    before the newest edge."""
    edges = log.select(by, F.inline(edges_of())).withWatermark("edge", delay)
    window = F.window("edge", f"{span_seconds} seconds")
    counted = edges.groupBy(by, window).agg(F.sum("started").alias("started"), F.sum("ended").alias("ended"))
    spans = counted.select(by, F.window_time("window").alias("closed"), F.unix_seconds("window.start").alias("span_start"), "started", "ended")
    out = T.StructType(
        [
            T.StructField(by, log.schema[by].dataType),
            T.StructField("span_start", T.LongType()),
            T.StructField("started", T.LongType()),
            T.StructField("ended", T.LongType()),
            T.StructField("in_flight", T.LongType()),
        ]
    )
    return spans.groupBy(by).transformWithStateInPandas(DenseGauge(span_seconds, out.names), out, "Append", "None")
