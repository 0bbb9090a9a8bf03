"""Token ids as compact binary files.

Ids are replaced by their frequency rank over the whole corpus, so that the
common ones take one byte. Lengths stand apart from the values: a file holds a
header, the documents' ids and lengths, the control bytes and the value bytes.
A control byte describes 8 values of 1 or 2 bytes (vocabularies of up to
65,536 ids) or 4 values of 1 to 4 bytes, and is decoded by table lookup.

Rows with null text have only the end id; special strings in a text get the
ids that the library gives them; very long texts are encoded by units like
others, and units of over 100 characters wherever they occur; rows with null
doc_id come first; repeated doc_ids are kept, in the order of a hash of their ids; an
empty table gives no files and no rows; columns besides doc_id and text are
not read.
"""

from __future__ import annotations

import os
import struct
import zlib
from array import array
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from corpuslab.session import drop_table, scratch_path, store_of, via_table

from .common import documents, map_batches, slices, texts
from .units import UnitCoder, starts_unit, worker_table

MAGIC = b"TOKRANK1"
HEADER = "<8sQQQQQ"
FILE_IDS = 8_000_000
FILES_PER_READ = 100_000
SLICE_CHARS = 1_000_000
GROUP_CHARS = 2_000


# ---- the coding of one run of ranks


def control_bits(vocabulary: int) -> int:
    return 1 if vocabulary <= 1 << 16 else 2


def pack(ranks: np.ndarray, bits: int) -> tuple[bytes, bytes]:
    """Control bytes and value bytes of unsigned ``ranks``."""
    ranks = ranks.astype("<u4")
    widths = np.ones(len(ranks), np.uint8)
    for byte in range(1, 1 << bits):
        widths += ranks >= np.uint32(1 << (8 * byte))
    kept = np.arange(1 << bits, dtype=np.uint8)[None, :] < widths[:, None]
    values = ranks.view(np.uint8).reshape(-1, 4)[:, : 1 << bits][kept].tobytes()
    per = 8 // bits
    codes = np.zeros(-(-len(ranks) // per) * per, np.uint8)
    codes[: len(ranks)] = widths - 1
    shifts = (np.arange(per) * bits).astype(np.uint8)
    control = np.bitwise_or.reduce(codes.reshape(-1, per) << shifts, axis=1) if len(ranks) else codes
    return control.astype(np.uint8).tobytes(), values


def tables(bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each control byte: widths, offsets of its values, and their total."""
    per = 8 // bits
    codes = (np.arange(256)[:, None] >> (np.arange(per) * bits)) & ((1 << bits) - 1)
    widths = codes + 1
    ends = np.cumsum(widths, axis=1)
    return widths.astype(np.uint8), (ends - widths).astype(np.int64), ends[:, -1].astype(np.int64)


def unpack(control: np.ndarray, values: np.ndarray, count: int, bits: int) -> np.ndarray:
    """The ranks back, as unsigned 32-bit integers."""
    widths, offsets, totals = tables(bits)
    sizes = totals[control]
    starts = np.cumsum(sizes) - sizes
    at = (starts[:, None] + offsets[control]).ravel()[:count]
    wide = widths[control].ravel()[:count]
    padded = np.concatenate([values, np.zeros(4, np.uint8)])
    ranks = padded[at].astype(np.uint32)
    for byte in range(1, 1 << bits):
        more = np.flatnonzero(wide > byte)
        ranks[more] |= padded[at[more] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return ranks


def file_bytes(doc_ids: list, lengths: list[int], ranks: np.ndarray, bits: int) -> bytes:
    control, values = pack(ranks, bits)
    nulls = np.array([d is None for d in doc_ids], np.uint8).tobytes()
    ids = np.array([d or 0 for d in doc_ids], "<i8").tobytes()
    head = struct.pack(HEADER, MAGIC, bits, len(doc_ids), len(ranks), len(control), len(values))
    return b"".join([head, nulls, ids, np.array(lengths, "<i8").tobytes(), control, values])


def parse_file(content: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """doc_ids, lengths and ranks of one file."""
    magic, bits, docs, count, controls, size = struct.unpack_from(HEADER, content)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = struct.calcsize(HEADER)
    nulls = np.frombuffer(content, np.uint8, docs, at)
    ids = np.frombuffer(content, "<i8", docs, at + docs)
    lengths = np.frombuffer(content, "<i8", docs, at + 9 * docs)
    control = np.frombuffer(content, np.uint8, controls, at + 17 * docs)
    values = np.frombuffer(content, np.uint8, size, at + 17 * docs + controls)
    return [None if n else int(d) for d, n in zip(ids, nulls, strict=True)], lengths, unpack(control, values, count, bits)


# ---- the job


def library_encoder(path: str, width: int) -> tuple[Callable[[list[str]], list[bytes]], Callable[[str], bool]]:
    """Ids of strings by the tokenizers library, packed as unsigned integers of
    ``width`` bytes (2 or 4), and whether a text holds an added token, which the
    library finds before it splits."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    kind = {2: "H", 4: "I"}[width]
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    # In byte-level vocabularies a character of a token stands for one byte.
    sizes = np.zeros(tokenizer.get_vocab_size(), np.int64)
    for token, number in tokenizer.get_vocab().items():
        sizes[number] = len(token)

    def holds_added(text: str) -> bool:
        return any(token in text for token in added)

    def encode(strings: list[str]) -> list[bytes]:
        """Strings that begin a unit are encoded many at a time, and the ids cut
        where the bytes of a string end."""
        groups: list[list[str]] = []
        held = 0
        for string in strings:
            joins = string[:1] == " " and starts_unit(string[1:]) and not holds_added(string)
            if not joins or not groups or held > GROUP_CHARS:
                groups.append([])
                held = 0 if joins else GROUP_CHARS + 1
            groups[-1].append(string)
            held += len(string)
        found = tokenizer.encode_batch_fast(list(map("".join, groups)), add_special_tokens=False) if groups else []
        out: list[bytes] = []
        for group, encoding in zip(groups, found, strict=True):
            ids = array(kind, encoding.ids).tobytes()
            if len(group) == 1:
                out.append(ids)
                continue
            ends = np.cumsum(np.fromiter((len(s.encode()) for s in group), np.int64, len(group)))
            reached = np.cumsum(sizes[np.frombuffer(ids, f"<u{width}")])
            at = np.searchsorted(reached, ends)
            if at[-1] != len(reached) - 1 or (reached[at] != ends).any():
                out += [array(kind, e.ids).tobytes() for e in tokenizer.encode_batch_fast(group, add_special_tokens=False)]
                continue
            cut = [0, *((at + 1) * width).tolist()]
            out += [ids[a:b] for a, b in zip(cut, cut[1:], strict=False)]
        return out

    return encode, holds_added


@dataclass(frozen=True)
class TokenFiles:
    """A written set: its folder, the files in order, and the id of each rank."""

    folder: str
    files: DataFrame
    id_of_rank: np.ndarray


def tokenized(docs: DataFrame, vocabulary: str, width: int) -> DataFrame:
    """doc_id, the packed ids of each text, and a number of the row."""

    def make():
        encode, holds_added = library_encoder(vocabulary, width)
        code = UnitCoder(encode, width, worker_table(f"library {vocabulary} {width}"), undivided=holds_added)

        def step(rows):
            for some in slices(rows["text"], SLICE_CHARS):
                yield {"doc_id": rows["doc_id"][some], "ids": code(rows["text"][some])}

        return step

    return map_batches(texts(docs), make, "doc_id bigint, ids binary").withColumn("row", F.monotonically_increasing_id())


def id_counts(ids: DataFrame, size: int, width: int) -> DataFrame:
    """How often each id occurs; one partial row per id and task."""

    def make():
        total = np.zeros(size, np.int64)

        def step(rows):
            joined = np.frombuffer(b"".join(rows["ids"]), f"<u{width}")
            total[:] += np.bincount(joined, minlength=size)
            return ()

        def finish():
            seen = np.flatnonzero(total)
            yield {"id": seen, "n": total[seen]}

        step.finish = finish
        return step

    return map_batches(ids.select("ids"), make, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(
    docs: DataFrame, vocabulary: str, folder: str, end_id: int = 0, file_ids: int = FILE_IDS
) -> TokenFiles:
    """Tokenize ``docs`` once, rank the ids by frequency, and write files in
    ascending doc_id order below ``folder``, which executors must share.

    The list of files is itself a table of the tasks that succeeded, so files
    of lost or repeated attempts are never read.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    size = max(Tokenizer.from_file(vocabulary).get_vocab_size(), end_id + 1)
    width, bits = (2 if size <= 1 << 16 else 4), control_bits(size)
    scratch = scratch_path(spark, "token-ids")
    tokenized(docs, vocabulary, width).write.option("compression", "zstd").parquet(scratch)
    ids = spark.read.parquet(scratch)

    # The vocabulary bounds what is collected.
    counts = np.zeros(size, np.int64)
    for row in id_counts(ids, size, width).collect():
        counts[row["id"]] += row["n"]
    counts[end_id] += ids.count()
    id_of_rank = np.lexsort((np.arange(size), -counts)).astype(np.uint32)
    rank_of_id = np.empty(size, np.uint32)
    rank_of_id[id_of_rank] = np.arange(size, dtype=np.uint32)

    parts = max(spark.sparkContext.defaultParallelism, -(-int(counts.sum()) // file_ids))
    # Rows without doc_id and repeated rows spread over ranges as well.
    order = ("doc_id", "key", "row")
    keyed = ids.withColumn("key", F.xxhash64("ids"))
    ordered = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "ids")

    def make():
        from pyspark import TaskContext

        task = TaskContext.get()
        store, root = store_of(folder)
        store.create_dir(root, recursive=True)
        end = np.array([rank_of_id[end_id]], np.uint32)
        held_ids, held, lengths = [], [], []
        written, pending = 0, 0

        def flush():
            nonlocal written, pending
            name = f"{task.partitionId():06d}-{written:04d}-{task.taskAttemptId()}.tok"
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(file_bytes(held_ids, lengths, np.concatenate(held), bits))
            yield {"part": [task.partitionId()], "seq": [written], "name": [name], "n_ids": [pending]}
            written, pending = written + 1, 0
            for kept in (held_ids, held, lengths):
                kept.clear()

        def step(rows):
            nonlocal pending
            for doc_id, packed in zip(rows["doc_id"], rows["ids"], strict=True):
                own = rank_of_id[np.frombuffer(packed, f"<u{width}")]
                held_ids.append(doc_id)
                held.extend((own, end))
                lengths.append(len(own) + 1)
                pending += len(own) + 1
                if pending >= file_ids:
                    yield from flush()

        def finish():
            if held_ids:
                yield from flush()

        step.finish = finish
        return step

    listing = map_batches(ordered, make, "part int, seq int, name string, n_ids bigint")
    files = via_table(listing, "token-files")
    drop_table(scratch)
    return TokenFiles(folder, files, id_of_rank)


def read_token_files(
    found: TokenFiles, column: str = "ids binary", of: Callable[[bytes], object] = bytes
) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens,
    and ``column`` with ``of`` the ids as little-endian unsigned 32-bit integers."""
    spark = found.files.sparkSession
    folder, id_of_rank = found.folder, found.id_of_rank
    # One short row per file.
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    based = found.files.select("name", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    files = min(max(1, found.files.count()), FILES_PER_READ)

    def make():
        store, root = store_of(folder)

        def step(rows):
            for name, base in zip(rows["name"], rows["base"], strict=True):
                with store.open_input_file(f"{root}/{name}") as source:
                    doc_ids, lengths, ranks = parse_file(source.read())
                ids = id_of_rank[ranks].astype("<u4")
                ends = np.cumsum(lengths)
                for at in range(0, len(doc_ids), 500):
                    some = slice(at, at + 500)
                    starts = ends[some] - lengths[some]
                    yield {
                        "doc_id": doc_ids[some],
                        "start": starts + base,
                        "n_tokens": lengths[some],
                        column.split()[0]: [of(ids[s:e].tobytes()) for s, e in zip(starts, ends[some], strict=True)],
                    }

        return step

    spread = via_table(based, "token-bases").repartition(files)
    return map_batches(spread, make, f"doc_id bigint, start bigint, n_tokens bigint, {column}")


def op1_token_ids(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    folder = scratch_path(spark, "token-set")
    written = write_token_files(documents(spark, sf), public_tokenizers.path("byte_bpe_50k.json"), folder)
    return read_token_files(written, "ids_crc32 bigint", zlib.crc32)
