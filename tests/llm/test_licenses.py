import re

from corpuslab.llm import op05_licenses as op5

from .helpers import ODD, docs_of, rows

SF = "/root/testdata/sf0.001"
DOCS = [
    *ODD,
    (50, "Released under the MIT License."),
    (51, "x mit\nlicense y MIT-LICENSE " + "z " * 40 + "Apache license; General Public\tLicense"),
    (52, "This work is licensed under the GNU General Public License, version 3."),
    (53, "Licensed under CC BY-NC 4.0."),
    (54, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including"),
    (55, "é mitlicense mit  LICENSEé permission is here"),
    (56, "the terms of use and the conditions are in the source of this work " * 30),
    (57, "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    (58, "a mit license " * 300),
]


def plain(doc_id, text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)
    starts, labels = [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        starts += found
        labels |= {label} if found else set()
    return {
        "doc_id": doc_id,
        "n_words": len(words),
        "n_base": len(starts),
        "first_word": min(starts, default=None),
        "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(labels)),
    }


def base_of(found):
    return sorted(({k: v for k, v in r.items() if k not in ("labels", "score")} for r in found), key=str)


def test_odd_rows(spark):
    got = rows(op5.license_scan(docs_of(spark, DOCS, clashing=True)))
    assert base_of(got) == sorted((plain(*d) for d in DOCS), key=str)
    labels = {r["doc_id"]: r["labels"] for r in got}
    assert labels[50] == "mit" and labels[53] == "cc-by-nc-4.0" and labels[54] == "mit"
    assert labels[52] == "gpl,gpl-3.0" and labels[57] == "apache,apache-2.0"
    assert labels[56] == labels[8] == ""
    for r in got:
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
    assert op5.license_scan(docs_of(spark, [])).count() == 0


def test_every_notice_is_found():
    known = op5.templates()
    vocabulary = frozenset(w for t in known for w in t.words)
    for label, notice, _ in op5.NOTICES:
        text = "some words before " * 50 + notice + " and some after" * 50
        found = op5.scan_text(text, known, vocabulary, {})
        assert label in found["labels"].split(",") and found["score"] > 0.9


def test_mandatory_phrases_decide():
    known = op5.templates()
    vocabulary = frozenset(w for t in known for w in t.words)
    _, notice, phrases = next(n for n in op5.NOTICES if n[0] == "bsd")
    broken = notice.replace("binary forms", "forms binary")
    assert op5.scan_text(broken, known, vocabulary, {})["labels"] == ""
    changed = notice.replace("permitted", "allowed")
    assert op5.scan_text(changed, known, vocabulary, {})["labels"] == "bsd"


def test_frequencies(spark):
    vocabulary = frozenset([b"mit", b"the", b"absent"])
    counts, total = op5.document_frequencies(docs_of(spark, DOCS), vocabulary)
    assert total == len(DOCS)
    assert counts == {b"mit": 4, b"the": 5}


def test_query(spark):
    table = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert base_of(rows(op5.op5_licenses(spark, SF))) == sorted((plain(*d) for d in table), key=str)


def test_base_places_do_not_depend_on_the_notices(spark):
    own = [("isc", "Permission to use copy modify and distribute this software for any purpose", ["permission to use"])]
    docs = [(1, "This is under the MIT License."), (2, "license"), (3, "mit license, apache license " * 200), (4, "general public license")]
    got = rows(op5.license_scan(docs_of(spark, docs), own))
    assert base_of(got) == [plain(*d) for d in docs]
    assert [r["labels"] for r in sorted(got, key=lambda r: r["doc_id"])] == ["mit", "", "apache,mit", "gpl"]
