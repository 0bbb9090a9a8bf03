"""SimHash near-duplicates by covering locality-sensitive hashing.

Each of the 64 bits is given a nonzero vector over two elements with
radius + 1 coordinates; a mask keeps the bits whose vector has an odd product
with the mask's own vector. Up to ``radius`` vectors always have a common
zero-product partner, so two fingerprints that differ in at most ``radius``
bits agree on all kept bits of some mask: no pair is missed.

Within a table only fingerprints that share a masked key are looked at. Two of
them are linked if their balls of half the radius meet, so each one lists the
dropped bits flipped and fingerprints that list the same value are linked to
the smallest of them. Such a group holds at most one ball, whatever the data,
and no pairs are enumerated, however many fingerprints share a key.

Null and empty texts have fingerprint zero and are linked like others; texts of
one or two words are one shingle; repeated rows share a fingerprint; rows with
null doc_id get a component but name none (null if it has no other row); an
empty table gives no rows; columns besides doc_id and text are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from corpuslab.operators.skew import lookup_join
from corpuslab.session import via_table

from .common import documents, map_batches, texts
from .components import components

SHINGLE = 3
RADIUS = 2
SEED = 42
STEP = 50_000


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit fingerprint; a bit is set if it is in over half the shingles."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(1, len(words) - shingle + 1)
    spans = list(zip(starts[:last].tolist(), ends[min(shingle, len(words)) - 1 :].tolist(), strict=True))
    votes = np.zeros(64, np.int64)
    for at in range(0, last, STEP):
        some = spans[at : at + STEP]
        hashes = np.fromiter((xxh64_intdigest(joined[s:e], seed) for s, e in some), "<u8", len(some))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > last, bitorder="little").view("<u8")[0])


def text_hash():
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash and fp (the fingerprint as a signed number) of every row."""

    def make():
        def step(rows):
            found = np.array([fingerprint(t, shingle) for t in rows["text"]], np.uint64)
            yield {"doc_id": rows["doc_id"], "text_hash": rows["text_hash"], "fp": found.view(np.int64)}

        return step

    return map_batches(texts(docs, text_hash().alias("text_hash")), make, "doc_id bigint, text_hash bigint, fp bigint")


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    """Kept bits of each mask, as signed numbers."""
    vectors = (1 << (radius + 1)) - 1
    of_bit = [1 + b % vectors for b in range(bits)]
    masks = [sum(1 << b for b in range(bits) if (of_bit[b] & v).bit_count() % 2) for v in range(1, vectors + 1)]
    return [m - (1 << bits) if m >> (bits - 1) else m for m in masks]


def ball(mask: int, radius: int) -> list[int]:
    """All flips of up to ``radius`` bits that ``mask`` drops, as signed numbers."""
    dropped = [1 << b for b in range(64) if not mask >> b & 1]
    flips = [sum(c) for k in range(radius + 1) for c in combinations(dropped, k)]
    return [f - (1 << 64) if f >> 63 else f for f in flips]


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) that connect all values of ``fp`` within ``radius`` (even)
    bits: each edge is such a pair, and any such pair is joined by edges."""
    if radius % 2:
        raise ValueError("the radius must be even")
    masks = covering_masks(radius)
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(masks)])
    members = distinct.select("fp", F.inline(tables))
    shared = members.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    found = via_table(members.join(shared, ["t", "k"], "left_semi").select("t", "fp"), "simhash-members")
    balls = F.array(*[F.array(*[F.lit(f) for f in ball(m, radius // 2)]) for m in masks])
    near = found.select("t", "fp", F.explode(F.get(balls, F.col("t"))).alias("flip"))
    # A list holds the fingerprints of one ball at most.
    met = near.groupBy("t", F.col("fp").bitwiseXOR(F.col("flip")).alias("v")).agg(F.collect_set("fp").alias("all"))
    several = met.filter(F.size("all") > 1)
    edges = several.select(F.explode("all").alias("a"), F.array_min("all").alias("b"))
    return edges.filter("a <> b").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id reachable) and text_hash of every row."""
    rows = via_table(fingerprints(docs, shingle), "simhash")
    # Copies meet here, combined before they move.
    counted = rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    distinct = via_table(counted, "simhash-distinct")
    roots = components(links(distinct.select("fp"), radius))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", "n", F.coalesce("root", "fp").alias("root")
    )
    firsts = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    lookup = via_table(rooted.join(firsts, "root").select("fp", "n", "component_id"), "simhash-components")
    return lookup_join(rows, lookup, "fp", "n").select("doc_id", "fp", "component_id", "text_hash")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each component, with all its columns: the smallest
    doc_id. Where rows repeat that doc_id, the smallest hash of the text and
    then of all columns decides. Rows without doc_id have no identity and stay."""
    named = docs.filter("doc_id IS NOT NULL")
    found = near_duplicates(named, shingle, radius)
    kept = found.groupBy("component_id").agg(F.min(F.struct("doc_id", "text_hash")).alias("k"))
    kept = kept.select(F.col("k.doc_id").alias("_id"), F.col("k.text_hash").alias("_hash"))
    hashed = named.withColumn("_own", text_hash())
    chosen = hashed.join(kept, (hashed["doc_id"] == kept["_id"]) & (hashed["_own"] == kept["_hash"]), "left_semi")
    order = Window.partitionBy("doc_id", "_own").orderBy(F.xxhash64(*docs.columns))
    once = chosen.withColumn("_turn", F.row_number().over(order)).filter("_turn = 1")
    return once.select(*docs.columns).unionByName(docs.filter("doc_id IS NULL"))


def op4_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
