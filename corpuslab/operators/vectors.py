"""Pruning and quantization of vector tables (one array of numbers per row)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from corpuslab.session import via_table

from .ranks import select_rank
from .skew import small_side

# Fixed value: keeps quotients of zeros finite.
EPSILON = 1e-8


def sparsity(df: DataFrame, by: list[str], vector: str = "v") -> DataFrame:
    """Share of exact zeros, 4 places; 0 for no elements."""
    zeros = F.sum(F.size(F.filter(vector, lambda x: x == 0)))
    total = F.sum(F.size(vector))
    return df.groupBy(*by).agg(F.round(F.coalesce(F.try_divide(zeros, total), F.lit(0.0)), 4).alias("sparsity"))


def prune_global(df: DataFrame, amount: float, vec_id: str = "vec_id", vector: str = "v") -> DataFrame:
    """Set the round(amount * N) elements of smallest absolute value to 0 over the whole table.

    The cut-off is an exact order statistic found by counting, so no element is
    shuffled. Equal values at the cut-off go in order of (vec_id, position).
    """
    elements = df.agg(F.sum(F.size(vector)).alias("n")).collect()[0]["n"] or 0
    wanted = round(amount * elements)
    if wanted == 0:
        return df
    sizes = df.select(F.explode(F.transform(vector, lambda x: F.abs(x))).alias("size"))
    cut, below = select_rank(sizes, "size", wanted)

    def at_cut(x: Column) -> Column:
        return F.abs(x) == F.lit(cut)

    ties = df.select(vec_id, F.size(F.filter(vector, at_cut)).alias("ties"))
    last, before = select_rank(ties, vec_id, wanted - below, weight="ties")
    spots = F.filter(F.transform(vector, lambda x, i: F.when(at_cut(x), i)), lambda i: i.isNotNull())
    end = df.filter(F.col(vec_id) == F.lit(last)).select(F.element_at(spots, wanted - below - before)).collect()[0][0]

    def pruned(x: Column, i: Column) -> Column:
        chosen = (F.col(vec_id) < F.lit(last)) | ((F.col(vec_id) == F.lit(last)) & (i <= end))
        zero = F.lit(0).cast(df.schema[vector].dataType.elementType)
        return F.when((F.abs(x) < F.lit(cut)) | (at_cut(x) & chosen), zero).otherwise(x)

    return df.withColumn(vector, F.transform(vector, pruned))


def quantize_int8(df: DataFrame, vector: str = "v") -> DataFrame:
    """Add ``q`` (0 … 255), scale and zero_point, one scale for the whole table, and ``restored``.

    The range always holds 0, so that 0 is restored exactly.
    """
    ends = df.agg(
        F.least(F.min(F.array_min(vector)).cast("double"), F.lit(0.0)).alias("lo"),
        F.greatest(F.max(F.array_max(vector)).cast("double"), F.lit(0.0)).alias("hi"),
    )
    low, high = ends.select("lo").scalar(), ends.select("hi").scalar()
    step = df.withColumns({"_lo": low, "scale": (high - low) / 255})
    zero = F.when(F.col("scale") > 0, F.rint(-F.col("_lo") / F.col("scale"))).otherwise(0.0)
    scaled = step.withColumn("zero_point", zero).drop("_lo")

    def code(x: Column) -> Column:
        near = F.rint(F.try_divide(x.cast("double"), F.col("scale"))) + F.col("zero_point")
        return F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(255.0), near)), F.lit(0.0)).cast("int")

    coded = scaled.withColumn("q", F.transform(vector, code))
    return coded.withColumn("restored", F.transform("q", lambda q: (q - F.col("zero_point")) * F.col("scale")))


def top_components(vector: Column, k: int) -> Column:
    """Positions (from 0) of the ``k`` largest absolute components, equal ones in order of position."""
    ordered = F.array_sort(F.transform(vector, lambda x, i: F.struct((-F.abs(x)).alias("s"), i.alias("i"))))
    return F.transform(F.slice(ordered, 1, k), lambda s: s["i"])


# ---- polar quantization


@dataclass(frozen=True)
class PolarConfig:
    """Bit budget of one vector (fixed values): 8 bits of radius, 80 % of the rest
    sign bits, what then remains corrections of 2 bits."""

    dim: int
    bits: float = 3.0
    radius_bits: int = 8
    correction_bits: int = 2
    seed: int = 42
    #: "normal" numbers, or a "frame" of signs with orthogonal columns, which any engine can write down.
    rows: str = "normal"

    @property
    def sign_bits(self) -> int:
        return int((self.bits * self.dim - self.radius_bits) * 0.8)

    @property
    def corrections(self) -> int:
        rest = self.bits * self.dim - self.radius_bits - self.sign_bits
        return int(rest / self.correction_bits)

    def projection(self) -> np.ndarray:
        """sign_bits x dim normal numbers, or signs, scaled by 1 / sqrt(sign_bits)."""
        if self.rows == "frame":
            return frame(self.sign_bits, self.dim) / np.sqrt(self.sign_bits)
        draws = np.random.default_rng(self.seed).standard_normal((self.sign_bits, self.dim))
        return draws / np.sqrt(self.sign_bits)

    def signs(self, directions: np.ndarray, projection: np.ndarray) -> np.ndarray:
        return directions @ projection.T > 0

    def approximate(self, signs: np.ndarray, inverse: np.ndarray) -> np.ndarray:
        """Unit vectors restored from signs alone."""
        return unit((2.0 * signs - 1.0) @ inverse.T)


def frame(rows: int, dim: int) -> np.ndarray:
    """Signs with orthogonal columns: blocks of a Hadamard matrix, in block
    b > 0 with every (2 b + 1)-th column negated."""
    if dim & (dim - 1) or rows % dim:
        raise ValueError("a frame needs a power of two as dimension, and whole blocks of rows")
    i, j = np.arange(rows)[:, None], np.arange(dim)[None, :]
    block = i // dim
    odd = np.bitwise_count((i % dim) & j) + ((block > 0) & (j % (2 * block + 1) == 0))
    return 1.0 - 2.0 * (odd % 2)


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / (np.linalg.norm(vectors, axis=1, keepdims=True) + EPSILON)


#: Vectors that a worker holds as numbers at a time, whatever the batches.
SLICE_ROWS = 1_000


def sliced(frames: Iterator[pd.DataFrame], rows: int = SLICE_ROWS) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for at in range(0, len(frame), rows):
            yield frame.iloc[at : at + rows]


# The bit rates that are compared.
SWEEP_BITS = [2.0, 2.5, 3.0, 3.5, 4.0, 5.0, 6.0, 8.0]


def project_signs(df: DataFrame, config: PolarConfig, vec_id: str = "vec_id", vector: str = "v") -> DataFrame:
    """Sign bits of the random projection of every vector, packed 8 to a byte."""
    source = df.select(vec_id, vector)

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matrix = config.projection()
        for frame in batches:
            if len(frame):
                bits = config.signs(np.stack(frame[vector].to_numpy()).astype(float), matrix)
                yield pd.DataFrame({vec_id: frame[vec_id], "signs": [row.tobytes() for row in np.packbits(bits, axis=1)]})

    return source.mapInPandas(project, T.StructType([source.schema[vec_id], T.StructField("signs", T.BinaryType())]))


def polar_encode(
    df: DataFrame,
    configs: list[PolarConfig],
    vec_id: str = "vec_id",
    vector: str = "v",
    scale_by: str | None = None,
    rounded: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Codes and scales of every vector under every configuration.

    Codes: (vec_id, bits, radius, signs, idx, corr). Scales, per bits and
    ``scale_by``: (r_min, r_scale, c_scale). One pass over the vectors serves
    all configurations; its raw corrections are written once, since the largest
    of them scales all.
    """
    keys = [vec_id] + ([scale_by] if scale_by else [])
    source = df.select(*keys, F.col(vector).alias("v"))

    def raw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matrices = [(c, c.projection()) for c in configs]
        inverses = [np.linalg.pinv(p) for _, p in matrices]
        for frame in sliced(batches):
            vectors = np.stack(frame["v"].to_numpy()).astype(float)
            radius = np.linalg.norm(vectors, axis=1)
            directions = unit(vectors)
            for (config, matrix), inverse in zip(matrices, inverses):
                signs = config.signs(directions, matrix)
                rest = directions - config.approximate(signs, inverse)
                order = np.argsort(-np.abs(rest), axis=1, kind="stable")[:, : config.corrections]
                yield pd.DataFrame(
                    {
                        **{k: frame[k] for k in keys},
                        "bits": config.bits,
                        "length": radius,
                        "signs": [row.tobytes() for row in np.packbits(signs, axis=1)],
                        "idx": list(order.astype(np.int32)),
                        "rest": list(np.take_along_axis(rest, order, axis=1)),
                    }
                )

    schema = T.StructType(
        [source.schema[k] for k in keys]
        + [
            T.StructField("bits", T.DoubleType()),
            T.StructField("length", T.DoubleType()),
            T.StructField("signs", T.BinaryType()),
            T.StructField("idx", T.ArrayType(T.IntegerType())),
            T.StructField("rest", T.ArrayType(T.DoubleType())),
        ]
    )
    written = via_table(source.mapInPandas(raw, schema), "polar")
    groups = ["bits"] + ([scale_by] if scale_by else [])
    largest = F.max(F.array_max(F.transform("rest", lambda x: F.abs(x))))
    scales = written.groupBy(*groups).agg(
        F.min("length").alias("r_min"),
        ((F.max("length") - F.min("length")) / 255).alias("r_scale"),
        (F.coalesce(largest, F.lit(0.0)) + EPSILON).alias("c_scale"),
    )

    def level(value: Column, top: int) -> Column:
        clipped = F.greatest(F.lit(0.0), F.least(F.lit(float(top)), value))
        return (F.round(clipped) if rounded else F.floor(clipped)).cast("int")

    scaled = written.join(small_side(scales), groups)
    codes = scaled.select(
        *keys,
        "bits",
        level((F.col("length") - F.col("r_min")) / (F.col("r_scale") + EPSILON), 255).alias("radius"),
        "signs",
        "idx",
        F.transform("rest", lambda x: level((x / F.col("c_scale") + 1) * 1.5, 3)).alias("corr"),
    )
    return codes, scales


def polar_decode(
    codes: DataFrame,
    scales: DataFrame,
    configs: list[PolarConfig],
    vec_id: str = "vec_id",
    scale_by: str | None = None,
) -> DataFrame:
    """Vectors (vec_id, bits, restored) from codes and scales."""
    groups = ["bits"] + ([scale_by] if scale_by else [])
    keys = [vec_id] + ([scale_by] if scale_by else [])
    scaled = codes.join(small_side(scales), groups)
    by_bits = {c.bits: c for c in configs}

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        inverses = {bits: np.linalg.pinv(c.projection()) for bits, c in by_bits.items()}
        for frame in sliced(batches):
            for bits, part in frame.groupby("bits"):
                config = by_bits[bits]
                packed = np.stack([np.frombuffer(s, dtype=np.uint8) for s in part["signs"]])
                signs = np.unpackbits(packed, axis=1, count=config.sign_bits)
                directions = config.approximate(signs, inverses[bits])
                if config.corrections:
                    levels = np.stack(part["corr"].to_numpy()).astype(float)
                    sizes = (levels / 1.5 - 1.0) * part["c_scale"].to_numpy()[:, None]
                    spots = np.stack(part["idx"].to_numpy())
                    added = np.take_along_axis(directions, spots, axis=1) + sizes
                    np.put_along_axis(directions, spots, added, axis=1)
                radius = part["radius"].to_numpy() * part["r_scale"].to_numpy() + part["r_min"].to_numpy()
                yield pd.DataFrame(
                    {**{k: part[k] for k in keys}, "bits": bits, "restored": list(radius[:, None] * unit(directions))}
                )

    schema = T.StructType(
        [scaled.schema[k] for k in keys]
        + [T.StructField("bits", T.DoubleType()), T.StructField("restored", T.ArrayType(T.DoubleType()))]
    )
    return scaled.mapInPandas(decode, schema)


def restoration_quality(df: DataFrame, by: list[str], original: str = "v", restored: str = "restored") -> DataFrame:
    """Cosine similarity (mean, sample deviation, least), mean relative L2 error and mean squared error."""

    def total(left: str, right: str, one) -> Column:
        parts = F.zip_with(left, right, lambda a, b: one(a.cast("double"), b.cast("double")))
        return F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)

    sums = df.select(
        *by,
        total(original, restored, lambda a, b: a * b).alias("dot"),
        F.sqrt(total(original, original, lambda a, b: a * b)).alias("norm"),
        F.sqrt(total(restored, restored, lambda a, b: a * b)).alias("other"),
        total(original, restored, lambda a, b: (a - b) * (a - b)).alias("error"),
        F.size(original).alias("dim"),
    )
    cosine = F.col("dot") / (F.greatest("norm", F.lit(EPSILON)) * F.greatest("other", F.lit(EPSILON)))
    return sums.groupBy(*by).agg(
        F.count(F.lit(1)).alias("vectors"),
        F.avg(cosine).alias("cosine_mean"),
        F.stddev_samp(cosine).alias("cosine_std"),
        F.min(cosine).alias("cosine_min"),
        F.avg(F.sqrt("error") / (F.col("norm") + EPSILON)).alias("relative_l2_error"),
        (F.sum("error") / F.sum("dim")).alias("mse"),
    )


def memory_columns(n: Column, configs: list[PolarConfig], bits: Column | None = None) -> dict[str, Column]:
    """Bytes of ``n`` encoded vectors against 16-bit floats. A radius takes a byte (and 8
    bytes for the scale of them all), an index two bytes per correction. With
    several configurations ``bits`` tells which one a row has."""

    def per_vector(number) -> Column:
        chosen = F.lit(number(configs[0]))
        for c in configs[1:]:
            chosen = F.when(bits == c.bits, number(c)).otherwise(chosen)
        return chosen

    dim = configs[0].dim
    parts = {
        "radius_bytes": n + 8,
        "sign_bytes": F.floor(n * per_vector(lambda c: c.sign_bits) / 8),
        "correction_bytes": F.floor(n * per_vector(lambda c: c.corrections * c.correction_bits) / 8),
        "index_bytes": n * per_vector(lambda c: c.corrections * 2),
    }
    total = parts["radius_bytes"] + parts["sign_bytes"] + parts["correction_bytes"] + parts["index_bytes"]
    baseline = n * dim * 2
    return {
        **parts,
        "compressed_bytes": total,
        "baseline_bytes": baseline,
        "compression_ratio": baseline / total,
        "bits_per_element": total * 8 / (n * dim),
    }


def memory_report(df: DataFrame, by: list[str], config: PolarConfig) -> DataFrame:
    counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias("vectors"))
    return counted.withColumns(memory_columns(F.col("vectors"), [config]))


def bit_sweep(
    df: DataFrame,
    dim: int,
    bits: list[float] = SWEEP_BITS,
    vec_id: str = "vec_id",
    vector: str = "v",
    rows: str = "normal",
) -> DataFrame:
    """Quality and compression at several bit rates, one row each."""
    configs = [PolarConfig(dim, b, rows=rows) for b in bits]
    source = df.select(vec_id, F.col(vector).alias("v"))
    codes, scales = polar_encode(source, configs, vec_id)
    restored = polar_decode(codes, scales, configs, vec_id).join(source, vec_id)
    quality = restoration_quality(restored, ["bits"])
    memory = memory_columns(F.col("vectors"), configs, F.col("bits"))
    return quality.withColumns({c: memory[c] for c in ("compression_ratio", "bits_per_element")})
