import importlib

import pytest

import __spark_entry__ as entry

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from corpuslab.llm import op02_byte_bpe as op2, op08_quality_rules as op8, op10_pii as op10  # noqa: E402
from corpuslab.llm.registry import ORACLES, QUERIES  # noqa: E402

from .helpers import ODD, docs_of  # noqa: E402
from .test_decontamination import items_of, split  # noqa: E402
from .test_simhash import plain_components  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    registered = entry.queries()
    assert set(QUERIES) | {"pipeline"} <= set(registered)
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(entry.oracle_sql()) and "pipeline" not in entry.oracle_sql()


def test_only_missing_folders_are_passed_over(monkeypatch):
    real = importlib.import_module

    def without(missing):
        def load(name):
            if name in entry.PIPELINE:
                raise ModuleNotFoundError(f"No module named {missing!r}", name=missing)
            return real(name)

        return load

    monkeypatch.setattr(importlib, "import_module", without("corpuslab.llm"))
    assert "op1_token_ids" not in entry.queries() and "a04_top_words" in entry.queries()
    monkeypatch.setattr(importlib, "import_module", without("tokenizers"))
    with pytest.raises(ModuleNotFoundError):
        entry.queries()


def test_stages_against_brute_force(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in table.collect()}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    views = {d: op8.View(t) for d, t in texts.items()}
    good = {d: t for d, t in texts.items() if not any(rule(views[d]) for rule in op8.RULES.values())}
    firsts = {r["component_id"] for r in plain_components(list(good.items()))}
    exact = {d for d in firsts if any(" ".join(split(x)) in " ".join(split(good[d])) for x in items)}

    docs = table
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == table.columns, name
        kept.append({r.doc_id: r.text for r in docs.collect()})
    assert kept[0] == good
    assert set(kept[1]) == firsts
    assert set(kept[2]) == firsts - exact
    assert set(kept[3]) == set(kept[2])
    assert not any(op10.base_spans(t) for t in kept[3].values())
    final = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(final) == set(kept[3])
    ranks = op2.read_ranks(__import__("public_tokenizers").path("byte_bpe_multi_50k.tiktoken"))
    for d, r in final.items():
        assert op2.decode(bytes(r.ids), ranks.tokens).decode() == kept[3][d]
        assert r.n_tokens == len(r.ids) // 4


def test_stages_take_odd_and_empty_tables(spark, tmp_path):
    items_of(spark, [(1, "never in any of these texts at all"), (2, None)]).write.parquet(f"{tmp_path}/benchmark.parquet")
    long = " ".join(f"word{i}" for i in range(80))
    other = " ".join(f"term{i}" for i in range(90))
    docs = [*ODD, (200, long), (201, other), (201, other), (None, long)]
    for rows, clashing in ((docs, True), ([], False)):
        current = docs_of(spark, rows, clashing)
        columns = current.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            current = stage(spark, current, str(tmp_path))
            assert current.columns == columns, name
        final = corpus_pipeline.STAGES[-1][1](spark, current, str(tmp_path))
        assert sorted(str(r.doc_id) for r in final.collect()) == (["200", "201", "None"] if rows else [])
