import re

import duckdb
import pytest

from corpuslab.llm import op08_quality_rules as op8

from .helpers import ODD, docs_of, rows

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i}" for i in range(60))
DOCS = [
    *ODD,
    (20, LONG),
    (21, "the same three " * 40),
    (22, " ".join(f"w{i}###" for i in range(60))),
    (23, "\n".join(["a line that is here again and more"] * 5 + [LONG])),
    (24, LONG + "\n\n" + LONG),
    (25, " ".join("x" for _ in range(60))),
    (26, "a b c a b c a"),
]


def plain(doc_id, text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, chars, symbols = len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text)
    dups = sum(x in lines[:i] for i, x in enumerate(lines))
    failed = n < 50 or 100 * len(covered) > 50 * n
    return {
        "doc_id": doc_id,
        "n_words": n,
        "word_chars": chars,
        "n_symbols": symbols,
        "n_dup_lines": dups,
        "n_repeat_words": len(covered),
        "base_failed": failed,
        "kept": not (failed or 10 * symbols > n or 2 * dups > len(lines) or not 2 * n <= chars <= 20 * n),
    }


def test_odd_rows(spark):
    got = rows(op8.judged(docs_of(spark, DOCS, clashing=True)))
    assert sorted(got, key=str) == sorted((plain(*d) for d in DOCS), key=str)
    assert {r["doc_id"] for r in got if r["kept"]} == {20}


def test_kept_rows_keep_their_columns(spark):
    docs = docs_of(spark, DOCS, clashing=True)
    kept = op8.keep_good(docs)
    assert kept.schema == docs.schema
    assert [r.text for r in kept.collect()] == [LONG]
    empty = docs_of(spark, [])
    assert op8.keep_good(empty).count() == op8.judged(empty).count() == 0


def test_order_follows_rejections_per_cost(spark):
    def slow(view):
        return sum(range(20_000)) < 0

    rules = {"slow": slow, "never": lambda v: False, "often": lambda v: v.n_words < 100}
    order = op8.estimate(docs_of(spark, [(i, LONG) for i in range(40)]), rules)
    assert order[0] == "often"
    seen = []
    assert op8.first_rejection(op8.View(LONG), [("often", rules["often"]), ("x", lambda v: seen.append(1))]) == "often"
    assert not seen


@pytest.mark.parametrize("order", [list(op8.RULES), list(op8.RULES)[::-1]])
def test_order_does_not_change_the_verdict(spark, order):
    got = rows(op8.judged(docs_of(spark, DOCS), order=order))
    assert sorted(got, key=str) == sorted((plain(*d) for d in DOCS), key=str)


def test_query_against_sql(spark):
    base = duckdb.connect()
    base.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    df = op8.op8_quality_rules(spark, SF)
    cursor = base.execute(op8.OP8_SQL)
    assert [d[0] for d in cursor.description] == df.columns
    assert sorted(map(str, cursor.fetchall())) == sorted(str(tuple(r)) for r in df.collect())


def test_base_rules_hold_with_rules_of_ones_own(spark):
    docs = docs_of(spark, [(1, "too few words"), (2, "one two three " * 40), (3, " ".join(f"w{i}" for i in range(80)))])
    got = {r.doc_id: (r.base_failed, r.kept) for r in op8.judged(docs, {"none": lambda v: False}).collect()}
    assert got == {1: (True, False), 2: (True, False), 3: (False, True)}
