"""Queries over the embeddings table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpuslab.operators import vectors as vec

from . import tables as t
from .evaluation import rounded
from .registry import registry

QUERIES, ORACLES, query = registry()
DIM = 64

def table(spark: SparkSession, sf: str) -> DataFrame:
    return t.table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").alias("v"))


ELEMENTS = """elements AS (
  SELECT vec_id, label, i, embedding[i + 1] AS x
  FROM (SELECT vec_id, label, embedding, unnest(range(len(embedding))) AS i FROM embeddings)),
pruned AS (
  SELECT vec_id, label, i, x,
    CASE WHEN row_number() OVER (ORDER BY abs(x), vec_id, i) <= round_even(0.4 * count(*) OVER (), 0)
      THEN 0 ELSE x END AS p FROM elements)"""


@query(
    "v01_sparsity",
    f"""WITH {ELEMENTS} SELECT label, round(count(*) FILTER (p = 0) / count(*), 4) AS sparsity
    FROM pruned GROUP BY label""",
)
def v01(spark: SparkSession, sf: str) -> DataFrame:
    return vec.sparsity(vec.prune_global(table(spark, sf), 0.4), ["label"])


@query("v02_prune_global", f"WITH {ELEMENTS} SELECT vec_id, CAST(i AS INTEGER) AS i, CAST(p AS DOUBLE) AS x FROM pruned")
def v02(spark: SparkSession, sf: str) -> DataFrame:
    pruned = vec.prune_global(table(spark, sf), 0.4)
    return pruned.select("vec_id", F.posexplode("v").alias("i", "x")).withColumn("x", F.col("x").cast("double"))


INT8 = """elements AS (
  SELECT vec_id, label, i, CAST(embedding[i + 1] AS DOUBLE) AS x
  FROM (SELECT vec_id, label, embedding, unnest(range(len(embedding))) AS i FROM embeddings)),
ends AS (SELECT least(min(x), 0) AS lo, (greatest(max(x), 0) - least(min(x), 0)) / 255 AS scale FROM elements),
coded AS (
  SELECT vec_id, label, i, x, scale, round_even(-lo / scale, 0) AS zero,
    CAST(greatest(0, least(255, round_even(x / scale, 0) + round_even(-lo / scale, 0))) AS INTEGER) AS q
  FROM elements, ends),
restored AS (SELECT *, (q - zero) * scale AS r FROM coded)"""


@query("v03_quantize_int8", f"WITH {INT8} SELECT vec_id, CAST(i AS INTEGER) AS i, q, round(r, 9) AS restored FROM restored")
def v03(spark: SparkSession, sf: str) -> DataFrame:
    coded = vec.quantize_int8(table(spark, sf))
    rows = coded.select("vec_id", F.posexplode(F.arrays_zip("q", "restored")).alias("i", "c"))
    return rows.select("vec_id", "i", "c.q", F.round("c.restored", 9).alias("restored"))


@query("v04_project_signs")
def v04(spark: SparkSession, sf: str) -> DataFrame:
    signs = vec.project_signs(table(spark, sf), vec.PolarConfig(DIM))
    return signs.select("vec_id", F.hex("signs").alias("signs"))


@query("v05_polar_encode")
def v05(spark: SparkSession, sf: str) -> DataFrame:
    codes, scales = vec.polar_encode(table(spark, sf), [vec.PolarConfig(DIM)])
    return codes.select(
        "vec_id",
        "radius",
        F.hex("signs").alias("signs"),
        t.joined(F.col("idx").cast("array<string>"), ",").alias("idx"),
        t.joined(F.col("corr").cast("array<string>"), ",").alias("corr"),
    )


@query("v06_polar_decode")
def v06(spark: SparkSession, sf: str) -> DataFrame:
    configs = [vec.PolarConfig(DIM)]
    codes, scales = vec.polar_encode(table(spark, sf), configs)
    restored = vec.polar_decode(codes, scales, configs)
    return restored.select("vec_id", F.posexplode("restored").alias("i", "x"))


@query(
    "v07_restoration_quality",
    f"""WITH {INT8}, sums AS (
      SELECT vec_id, label, sum(x * r) AS dot, sqrt(sum(x * x)) AS norm, sqrt(sum(r * r)) AS other,
        sum((x - r) * (x - r)) AS error, count(*) AS dim FROM restored GROUP BY vec_id, label),
    cosines AS (SELECT *, dot / (norm * other) AS c FROM sums)
    SELECT label, count(*) AS vectors, round(avg(c), 6) AS cosine_mean, round(stddev_samp(c), 6) AS cosine_std,
      round(min(c), 6) AS cosine_min, round(avg(sqrt(error) / (norm + 1e-8)), 6) AS relative_l2_error,
      round(sum(error) / sum(dim), 9) AS mse FROM cosines GROUP BY label""",
)
def v07(spark: SparkSession, sf: str) -> DataFrame:
    quality = vec.restoration_quality(vec.quantize_int8(table(spark, sf)), ["label"])
    return rounded(quality.withColumn("mse", F.round("mse", 9)), 9).withColumns(
        {c: F.round(c, 6) for c in ("cosine_mean", "cosine_std", "cosine_min", "relative_l2_error")}
    )


@query(
    "v08_memory_report",
    """WITH counted AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
    parts AS (
      SELECT label, n AS vectors, n + 8 AS radius_bytes, n * 147 // 8 AS sign_bytes, n * 18 * 2 // 8 AS correction_bytes,
        n * 18 * 2 AS index_bytes, n * 64 * 2 AS baseline_bytes FROM counted)
    SELECT *, radius_bytes + sign_bytes + correction_bytes + index_bytes AS compressed_bytes,
      round(baseline_bytes / (radius_bytes + sign_bytes + correction_bytes + index_bytes), 6) AS compression_ratio,
      round((radius_bytes + sign_bytes + correction_bytes + index_bytes) * 8 / (vectors * 64), 6) AS bits_per_element
    FROM parts""",
)
def v08(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(vec.memory_report(table(spark, sf), ["label"], vec.PolarConfig(DIM)))


@query("v09_bit_sweep")
def v09(spark: SparkSession, sf: str) -> DataFrame:
    return vec.bit_sweep(table(spark, sf), DIM)


@query(
    "v10_top_components",
    f"""WITH {ELEMENTS} SELECT vec_id, CAST(rank AS INTEGER) AS rank, CAST(i AS INTEGER) AS i FROM (
      SELECT vec_id, i, row_number() OVER (PARTITION BY vec_id ORDER BY abs(x) DESC, i) - 1 AS rank FROM elements)
    WHERE rank < 18""",
)
def v10(spark: SparkSession, sf: str) -> DataFrame:
    top = table(spark, sf).select("vec_id", vec.top_components(F.col("v"), 18).alias("top"))
    return top.select("vec_id", F.posexplode("top").alias("rank", "i"))


# ---- the same with a frame of signs, which SQL can write down

FRAME_BITS, FRAME_SWEEP = 2.625, [1.375, 2.625, 3.875, 5.125]


def framed(bits: float = FRAME_BITS) -> vec.PolarConfig:
    return vec.PolarConfig(DIM, bits, rows="frame")


def sql_polar(bits: float = FRAME_BITS) -> str:
    """Signs, codes and restored vectors of one configuration."""
    config = framed(bits)
    rows, most = config.sign_bits, config.corrections
    return f"""{ELEMENTS},
    lengths AS (SELECT vec_id, sqrt(sum(CAST(x AS DOUBLE) * x)) AS length FROM elements GROUP BY vec_id),
    units AS (SELECT vec_id, i AS j, x / (length + 1e-8) AS u FROM elements JOIN lengths USING (vec_id)),
    frame AS (SELECT r.range AS k, c.range AS j, CASE WHEN (bit_count((r.range % {DIM}) & c.range)
        + CASE WHEN r.range >= {DIM} AND c.range % (2 * (r.range // {DIM}) + 1) = 0 THEN 1 ELSE 0 END) % 2 = 0
        THEN 1 ELSE -1 END AS e FROM range({rows}) r, range({DIM}) c),
    signs AS (SELECT vec_id, k, sum(u * e) > 0 AS s FROM units JOIN frame USING (j) GROUP BY vec_id, k),
    packed AS (SELECT vec_id, string_agg(printf('%02X', byte), '' ORDER BY b) AS signs FROM (
      SELECT vec_id, k // 8 AS b, CAST(sum(CASE WHEN s THEN 1 << (7 - k % 8) ELSE 0 END) AS INTEGER) AS byte
      FROM signs GROUP BY ALL) GROUP BY vec_id),
    sums AS (SELECT vec_id, j, sum(CASE WHEN s THEN e ELSE -e END) / sqrt({rows}) AS a
      FROM signs JOIN frame USING (k) GROUP BY vec_id, j),
    near AS (SELECT vec_id, j, a / (sqrt(sum(a * a) OVER (PARTITION BY vec_id)) + 1e-8) AS a FROM sums),
    rests AS (SELECT vec_id, j, a, u - a AS rest,
      row_number() OVER (PARTITION BY vec_id ORDER BY abs(u - a) DESC, j) AS place FROM units JOIN near USING (vec_id, j)),
    scales AS (SELECT (SELECT min(length) FROM lengths) AS r_min, (SELECT (max(length) - min(length)) / 255 FROM lengths) AS r_scale,
      (SELECT max(abs(rest)) + 1e-8 FROM rests WHERE place <= {most}) AS c_scale),
    radii AS (SELECT vec_id, CAST(floor(greatest(0, least(255, (length - r_min) / (r_scale + 1e-8)))) AS INTEGER) AS radius
      FROM lengths, scales),
    corrections AS (SELECT vec_id, j, place,
      CAST(floor(greatest(0, least(3, (rest / c_scale + 1) * 1.5))) AS INTEGER) AS corr FROM rests, scales WHERE place <= {most}),
    corrected AS (SELECT vec_id, j, a + coalesce((corr / 1.5 - 1) * c_scale, 0) AS d
      FROM near LEFT JOIN corrections USING (vec_id, j), scales),
    restored AS (SELECT vec_id, j AS i, (radius * r_scale + r_min) * d
        / (sqrt(sum(d * d) OVER (PARTITION BY vec_id)) + 1e-8) AS x
      FROM corrected JOIN radii USING (vec_id), scales)"""


@query("v04_project_signs_frame", f"WITH {sql_polar()} SELECT vec_id, signs FROM packed")
def v04_frame(spark: SparkSession, sf: str) -> DataFrame:
    return vec.project_signs(table(spark, sf), framed()).select("vec_id", F.hex("signs").alias("signs"))


@query(
    "v05_polar_encode_frame",
    f"""WITH {sql_polar()} SELECT vec_id, radius, signs, string_agg(CAST(j AS VARCHAR), ',' ORDER BY place) AS idx,
      string_agg(CAST(corr AS VARCHAR), ',' ORDER BY place) AS corr
    FROM corrections JOIN packed USING (vec_id) JOIN radii USING (vec_id) GROUP BY ALL""",
)
def v05_frame(spark: SparkSession, sf: str) -> DataFrame:
    codes, _ = vec.polar_encode(table(spark, sf), [framed()])
    return codes.select(
        "vec_id",
        "radius",
        F.hex("signs").alias("signs"),
        t.joined(F.col("idx").cast("array<string>"), ",").alias("idx"),
        t.joined(F.col("corr").cast("array<string>"), ",").alias("corr"),
    )


@query("v06_polar_decode_frame", f"WITH {sql_polar()} SELECT vec_id, CAST(i AS INTEGER) AS i, round(x, 9) AS x FROM restored")
def v06_frame(spark: SparkSession, sf: str) -> DataFrame:
    codes, scales = vec.polar_encode(table(spark, sf), [framed()])
    restored = vec.polar_decode(codes, scales, [framed()])
    return restored.select("vec_id", F.posexplode("restored").alias("i", "x")).withColumn("x", F.round("x", 9))


def sql_quality(bits: float) -> str:
    return f"""SELECT * FROM (WITH {sql_polar(bits)},
      both_sides AS (SELECT vec_id, sum(e.x * r.x) AS dot, sqrt(sum(CAST(e.x AS DOUBLE) * e.x)) AS norm, sqrt(sum(r.x * r.x)) AS other,
        sum((e.x - r.x) * (e.x - r.x)) AS error, count(*) AS dim
        FROM elements e JOIN restored r USING (vec_id, i) GROUP BY vec_id),
      cosines AS (SELECT *, dot / (norm * other) AS c FROM both_sides)
      SELECT CAST({bits} AS DOUBLE) AS bits, count(*) AS vectors, round(avg(c), 6) AS cosine_mean,
        round(avg(sqrt(error) / (norm + 1e-8)), 6) AS relative_l2_error, round(sum(error) / sum(dim), 8) AS mse FROM cosines)"""


@query("v09_bit_sweep_frame", " UNION ALL ".join(sql_quality(b) for b in FRAME_SWEEP))
def v09_frame(spark: SparkSession, sf: str) -> DataFrame:
    found = vec.bit_sweep(table(spark, sf), DIM, FRAME_SWEEP, rows="frame")
    return found.select(
        "bits", "vectors", F.round("cosine_mean", 6).alias("cosine_mean"),
        F.round("relative_l2_error", 6).alias("relative_l2_error"), F.round("mse", 8).alias("mse"),
    )
