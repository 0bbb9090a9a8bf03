import random

import pytest
import xxhash
from pyspark.sql import types as T

from corpuslab.llm import op04_simhash as op4
from corpuslab.llm.components import components

from .helpers import ODD, docs_of, rows

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(docs, radius=2):
    prints = [plain_fingerprint(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[root(i)] = root(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(docs):
        known = smallest.get(root(i))
        smallest[root(i)] = doc_id if known is None else known if doc_id is None else min(known, doc_id)
    return sorted(
        ({"doc_id": d, "fingerprint": f"{prints[i]:016x}", "component_id": smallest[root(i)]} for i, (d, _) in enumerate(docs)), key=str
    )


def found(df):
    return sorted(
        ({"doc_id": r.doc_id, "fingerprint": f"{r.fp % 2**64:016x}", "component_id": r.component_id} for r in df.collect()), key=str
    )


def test_masks_cover():
    for radius in (2, 4):
        masks = op4.covering_masks(radius)
        dropped = [{b for b in range(64) if not m >> b & 1} for m in masks]
        rng = random.Random(1)
        for _ in range(500):
            pair = set(rng.sample(range(64), radius))
            assert any(pair <= d for d in dropped)


def test_odd_rows(spark):
    docs = [*ODD, (40, "One two three four"), (41, "one TWO three  four"), (42, "É é"), (43, "one"), (44, "one two")]
    assert found(op4.near_duplicates(docs_of(spark, docs, clashing=True))) == plain_components(docs)
    assert op4.near_duplicates(docs_of(spark, [])).count() == 0


def test_links_against_all_pairs(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(60)]
    values = set(base)
    for v in base:
        for _ in range(6):
            for _ in range(rng.randint(1, 4)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    values = sorted(values)
    signed = {v - 2**64 if v >> 63 else v for v in values}
    df = spark.createDataFrame([(v,) for v in signed], T.StructType([T.StructField("fp", T.LongType())]))
    roots = {r.node: r.root for r in components(op4.links(df)).collect()}
    want = {r["doc_id"]: r["component_id"] for r in _components_of(values)}
    got = {v: roots.get(v - 2**64 if v >> 63 else v, v - 2**64 if v >> 63 else v) for v in values}
    groups = lambda m: sorted(sorted(k for k in m if m[k] == x) for x in set(m.values()))
    assert groups(got) == groups(want)


def _components_of(values):
    left, out = set(values), []
    while left:
        todo = [left.pop()]
        group = list(todo)
        while todo:
            v = todo.pop()
            near = {w for w in left if (v ^ w).bit_count() <= 2}
            left -= near
            todo += near
            group += near
        out += [{"doc_id": v, "component_id": min(group)} for v in group]
    return out


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7), (501, 500)], "x bigint, y bigint")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 501: 500}
    assert components(edges.limit(0)).count() == 0


def test_odd_radius(spark):
    with pytest.raises(ValueError):
        op4.links(spark.range(1).withColumnRenamed("id", "fp"), 3)


def test_keep_one(spark):
    docs = [(1, "a b c d"), (2, "a b c d"), (2, "a b c d"), (3, "x y z"), (3, "x y z"), (None, "a b c d")]
    kept = sorted((r.doc_id or 0, r.text) for r in op4.keep_one(docs_of(spark, docs)).collect())
    assert kept == [(0, "a b c d"), (1, "a b c d"), (3, "x y z")]


def test_query(spark):
    table = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(rows(op4.op4_simhash(spark, SF)), key=str) == plain_components(table)
