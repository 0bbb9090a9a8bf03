import functools
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from corpuslab.llm import op01_token_ids as op1, op02_byte_bpe as op2, units
from corpuslab.llm.units import UnitCoder
from corpuslab.session import scratch_path

from .helpers import ODD, docs_of, rows

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SPLIT = op2.split_pattern(public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def reference():
    import base64

    import tiktoken

    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70_000), max_size=60), st.sampled_from([1, 2]))
def test_packing_round_trip(values, bits):
    ranks = np.array([v & 0xFFFF if bits == 1 else v * 251 for v in values], np.uint32)
    control, data = op1.pack(ranks, bits)
    back = op1.unpack(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(ranks), bits)
    assert back.tolist() == ranks.tolist()


ENCODER = functools.cache(lambda: op1.library_encoder(VOCABULARY, 2))


def library_coder(**bounds):
    encode, holds_added = ENCODER()
    return UnitCoder(encode, 2, undivided=holds_added, **bounds)


def packed_ids(packed):
    return [np.frombuffer(p, "<u2").tolist() for p in packed]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", " ", "  ", "a", "é's", "\n", "<|", "|>", " 12", "你好", "\t"]), max_size=12).map("".join), max_size=8))
def test_ids_are_those_of_the_library(library, given):
    coder = test_ids_are_those_of_the_library.__dict__.setdefault("coder", library_coder())
    assert packed_ids(coder(given)) == list(map(library, given))
    assert packed_ids(library_coder(max_units=1)(given)) == list(map(library, given))


def test_random_strings(library):
    rng = random.Random(9)
    pieces = ["<|endoftext|>", " ", " ", " ", "word", "Word", "'ll", "!!", "\n", "é", "x" * 120, "漢字" * 60, "1234"]
    given = ["".join(rng.choices(pieces, k=rng.randrange(40))) for _ in range(5_000)]
    assert packed_ids(library_coder()(given)) == list(map(library, given))


def test_tables_are_bounded_in_bytes(library):
    """Scripts without spaces: a unit is a paragraph, and no table holds it."""
    rng = random.Random(2)
    codes = range(0x4E00, 0x4E00 + 500)
    given = [" ".join("".join(map(chr, rng.choices(codes, k=3_000))) for _ in range(3)) for _ in range(20)]
    coder = library_coder()
    assert packed_ids(coder(given)) == list(map(library, given))
    assert coder.table["units"] == 0
    coder = library_coder(max_bytes=2_000)
    given = [" ".join(f"word{i}x{j}" for j in range(50)) for i in range(20)]
    assert packed_ids(coder(given)) == list(map(library, given))
    assert 1_900 < coder.bytes <= 2_000


def test_one_id_or_none_holds_many_rows(spark, library):
    """Rows without doc_id, and copies of one row, spread over the files."""
    given = [(None, f"text {i}") for i in range(300)] + [(7, "same text")] * 300 + [(i, "x") for i in range(10, 20)]
    found = op1.write_token_files(docs_of(spark, given), VOCABULARY, scratch_path(spark, "t"))
    got = sorted(rows(op1.read_token_files(found, "ids_crc32 bigint", zlib.crc32)), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None] * 300 + [7] * 300 + list(range(10, 20))
    assert len({r["part"] for r in found.files.collect()}) >= 4
    assert sum(r["n_tokens"] for r in got) == sum(len(library(t)) + 1 for _, t in given)
    ends = [r["start"] + r["n_tokens"] for r in got]
    assert [r["start"] for r in got] == [0, *ends[:-1]]


def expected(library, docs):
    start = 0
    for doc_id, text in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library(text or ""), 0]
        yield {"doc_id": doc_id, "start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(np.array(ids, "<u4").tobytes())}
        start += len(ids)


@pytest.mark.parametrize("file_ids", [50, op1.FILE_IDS])
def test_files(spark, library, file_ids):
    docs = docs_of(spark, ODD, clashing=True)
    found = op1.write_token_files(docs, VOCABULARY, scratch_path(spark, "t"), file_ids=file_ids)
    got = sorted(rows(op1.read_token_files(found, "ids_crc32 bigint", zlib.crc32)), key=lambda r: r["start"])
    assert got == list(expected(library, ODD))


def test_no_documents(spark):
    docs = docs_of(spark, [])
    found = op1.write_token_files(docs, VOCABULARY, scratch_path(spark, "t"))
    assert op1.read_token_files(found).count() == 0
    assert op2.encoded_digests(docs, RANKS, public_tokenizers.PATTERN).count() == 0


def test_query_op1(spark, library):
    table = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(rows(op1.op1_token_ids(spark, SF)), key=lambda r: r["start"])
    assert got == list(expected(library, table))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("aé 's \n\t. \x1c\x85 1你😀t")), max_size=30))
def test_units_do_not_change_ids(reference, text):
    ranks = op2.read_ranks(RANKS) if not hasattr(test_units_do_not_change_ids, "ranks") else test_units_do_not_change_ids.ranks
    test_units_do_not_change_ids.ranks = ranks
    code = UnitCoder(op2.unit_encoder(ranks, SPLIT), 4)
    assert np.frombuffer(code([text])[0], "<u4").tolist() == reference.encode_ordinary(text)


def test_code_points(reference, library):
    rng = random.Random(5)
    codes = [*range(0x20, 0x3400), *rng.sample([c for c in range(0x3400, 0x110000) if not 0xD800 <= c < 0xE000], 6000)]
    # Letters that newer tables know and older ones do not.
    codes += [0x558, 0x88F, 0x1C89, 0x105C0, 0x323B0]
    texts = [f"a{chr(c)}b {chr(c)}1 {chr(c)} {chr(c)}{chr(c)}'s  x" for c in codes if not 0xD800 <= c < 0xE000]
    trees = UnitCoder(op2.unit_encoder(op2.read_ranks(RANKS), SPLIT), 4)
    files = library_coder()
    for at in range(0, len(texts), 500):
        some = texts[at : at + 500]
        assert [np.frombuffer(i, "<u4").tolist() for i in trees(some)] == list(map(reference.encode_ordinary, some))
        assert [np.frombuffer(i, "<u2").tolist() for i in files(some)] == list(map(library, some))


def test_units_of_one_hash(library, monkeypatch):
    """Units that hash alike are told apart, in a call and in the table."""
    monkeypatch.setattr(units.Cutter, "hashes", lambda self, flat, start, end: (end - start).astype(np.uint64))
    given = [" ".join(random.Random(i).choices(["a", "bb", "cc", "dd", "eee", "é", "11"], k=20)) for i in range(30)]
    coder = library_coder()
    assert packed_ids(coder(given)) + packed_ids(coder(given[::-1])) == list(map(library, given + given[::-1]))


def test_table_of_units_may_overflow(reference):
    code = UnitCoder(op2.unit_encoder(op2.read_ranks(RANKS), SPLIT), 4, max_units=2)
    for text in ("a b c", "c b a d", "", "a  b"):
        assert np.frombuffer(code([text])[0], "<u4").tolist() == reference.encode_ordinary(text)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(min_size=2, max_size=90), min_size=1, max_size=8))
def test_trees_agree(pieces):
    test = test_trees_agree
    ranks = test.ranks = getattr(test, "ranks", None) or op2.read_ranks(RANKS)
    for piece in pieces:
        width = 1 << (len(piece) - 1).bit_length()
        parts = [ranks.of_byte[b] for b in piece]
        tokens = [ranks.tokens[p] for p in parts]
        known = {t: i for i, t in enumerate(ranks.tokens) if t}
        while True:
            options = [(known.get(tokens[i] + tokens[i + 1]), i) for i in range(len(tokens) - 1)]
            options = [o for o in options if o[0] is not None]
            if not options:
                break
            _, i = min(options)
            tokens[i : i + 2] = [tokens[i] + tokens[i + 1]]
        want = [known[t] for t in tokens]
        assert op2.merge_batch(ranks, [piece, piece], width)[1].tolist() == want
        assert op2.merge_long(ranks, piece) == want


def bpe_rows(reference, docs):
    out = []
    for doc_id, text in docs:
        ids = reference.encode_ordinary(text or "")
        out.append(
            {
                "doc_id": doc_id,
                "n_tokens": len(ids),
                "ids_sha256": hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                "decoded_sha256": hashlib.sha256((text or "").encode()).hexdigest(),
            }
        )
    return sorted(out, key=str)


def test_bpe_odd_rows(spark, reference):
    docs = docs_of(spark, ODD, clashing=True)
    got = rows(op2.encoded_digests(docs, RANKS, public_tokenizers.PATTERN))
    assert sorted(got, key=str) == bpe_rows(reference, ODD)
    ids = {r["doc_id"]: r["ids"] for r in rows(op2.encode_documents(docs, RANKS, public_tokenizers.PATTERN))}
    assert op2.decode(ids[9], op2.read_ranks(RANKS).tokens) == b" lead and trail "


def test_query_op2(spark, reference):
    table = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(rows(op2.op2_byte_bpe(spark, SF)), key=str) == bpe_rows(reference, table)
