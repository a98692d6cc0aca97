"""Byte-level BPE encoding by a global shuffle of distinct words, and decoding.

A text is cut into words, each of whole pre-tokens: at single blanks between two other characters,
where every pre-token pattern of this kind (an optional blank leads a match) starts a match; a text
with other blanks is cut into its pre-tokens. Sending every occurrence through a shuffle would move
the corpus several times over, so occurrences are aggregated first: a task takes documents in
chunks of about ``CHUNK`` characters and

* sends each distinct word of a chunk once, to the bucket of its hash. A bucket encodes each of its
  words once, however many chunks ask, and answers every chunk;
* sends the documents as positions: the numbers of their words, frequent words first, so that a
  word costs about a byte and a half.

Both meet by chunk and are put together by position. A frequent word is one entry in each chunk,
so no word, document or source is hot, and no group holds more than one chunk. Decoding looks ids
up in the broadcast table of token bytes; this is the vocabulary file, whose size is fixed.

``docs`` is read twice and must give the same rows in the same partitions both times, as a stored
table does; a chunk is named by its partition, running number and words, and an answer that does
not fit its chunk is an error.

Defined results: a null text counts as empty and has no ids; repeated rows are encoded each for
itself; an empty table gives an empty result; columns of any name are carried, the result columns
are named by the caller. Ids that the vocabulary lacks, and null, decode to null.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from itertools import count, islice

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakevault.llm.chunks import chunks, named
from lakevault.llm.packing import (
    pack,
    pack_parts,
    slices,
    squeeze,
    unpack,
    unpack_parts,
    unsqueeze,
)
from lakevault.llm.storage import free_name

CHUNK = 6 << 20
_LONG = 4 << 20
_SOME = 1 << 18
#: As many words of a chunk have numbers of one or two bytes.
_SHORT = 1 << 14
_BLANKS = regex.compile(r"\s\s")


def load_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file: one token a line, base64 bytes and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def words(text: str | None, pattern):
    """Lists of a text's words in order, as keys: a word that follows a blank is itself, without
    the blank; any other has a blank before it, which no key of the first kind begins with. A very
    long text of pre-tokens comes in several lists."""
    if not text:
        return
    if not (text[0].isspace() or text[-1].isspace() or _BLANKS.search(text)):
        found = text.split(" ")
        found[0] = " " + found[0]
        yield found
    elif len(text) < _LONG:
        yield [" " + w for w in pattern.findall(text)]
    else:
        found = (" " + m.group() for m in pattern.finditer(text))
        while some := list(islice(found, _SOME)):
            yield some


def spelled(key: str) -> str:
    """The characters that a key of ``words`` stands for."""
    return key[1:] if key[:1] == " " else " " + key


def _bucket(word: bytes, buckets: int) -> int:
    return zlib.crc32(word) % buckets


def _requests(pattern_text: str, buckets: int, size: int):
    """Chunk -> one row for each bucket: its distinct words, in order of first occurrence."""
    def run(batches):
        pattern = regex.compile(pattern_text)
        for running, chunk in enumerate(chunks(batches, size)):
            seen: dict[str, None] = {}
            for text in chunk.column(chunk.num_columns - 1).to_pylist():
                for some in words(text, pattern):
                    seen.update(dict.fromkeys(some))
            distinct = [w.encode() for w in seen]
            name = named(distinct, running)
            by: dict[int, list[bytes]] = defaultdict(list)
            for w in distinct:
                by[_bucket(w, buckets)].append(w)
            yield pa.RecordBatch.from_arrays([
                pa.array(list(by), pa.int32()), pa.array([name] * len(by), pa.binary()),
                pa.array([pack([len(w) for w in ws]) for ws in by.values()], pa.binary()),
                pa.array([squeeze(b"".join(ws)) for ws in by.values()], pa.binary()),
            ], names=["bucket", "chunk", "lengths", "blob"])
    return run


def _answers(ranks, pattern_text: str, width: str):
    """Bucket rows, sorted by bucket -> the ids of their words; each distinct word once."""
    def run(batches):
        coder = tiktoken.Encoding("words", pat_str=pattern_text, mergeable_ranks=ranks.value,
                                  special_tokens={})
        size = np.dtype(width).itemsize
        at, known = None, {}
        for batch in batches:
            lengths, blobs = [], []
            for row in batch.to_pylist():
                if row["bucket"] != at:
                    at, known = row["bucket"], {}
                got = []
                for w in slices(unsqueeze(row["blob"]), unpack(row["lengths"])):
                    ids = known.get(w)
                    if ids is None:
                        ids = known[w] = np.array(
                            coder.encode_ordinary(spelled(w.decode())), width).tobytes()
                    got.append(ids)
                lengths.append(pack([len(g) // size for g in got]))
                blobs.append(squeeze(b"".join(got)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("bucket"), batch.column("chunk"), pa.array(lengths, pa.binary()),
                 pa.array(blobs, pa.binary())], names=["bucket", "chunk", "lengths", "blob"])
    return run


def _positions(pattern_text: str, buckets: int, size: int):
    """Chunk -> one row for each document: what it carries, and its words' numbers. A word's number
    is its place in the answers, bucket by bucket, after the short numbers of the most frequent
    words; the first row also has the places of these."""
    def run(batches):
        pattern = regex.compile(pattern_text)
        for running, chunk in enumerate(chunks(batches, size)):
            numbers: dict[str, int] = defaultdict(count().__next__)
            found = []
            for text in chunk.column(chunk.num_columns - 1).to_pylist():
                parts = [np.fromiter(map(numbers.__getitem__, some), np.uint32, len(some))
                         for some in words(text, pattern)]
                found.append(parts[0] if len(parts) == 1 else np.concatenate(
                    [np.zeros(0, np.uint32), *parts]))
            distinct = [w.encode() for w in numbers]
            every = np.concatenate(found)
            ends = np.cumsum([len(f) for f in found])
            place = np.empty(len(distinct), np.uint32)
            place[np.argsort([_bucket(w, buckets) for w in distinct], kind="stable")] = np.arange(
                len(distinct), dtype=np.uint32)
            short = np.argsort(-np.bincount(every, minlength=len(distinct)), kind="stable")[:_SHORT]
            number = place + np.uint32(len(short))
            number[short] = np.arange(len(short), dtype=np.uint32)
            orders = [None] * len(found)
            orders[0] = place[short].astype("<u4").tobytes()
            carried = chunk.drop_columns([chunk.column_names[-1]]).combine_chunks()
            out = pa.Table.from_arrays(
                [pa.array([named(distinct, running)] * len(found), pa.binary()),
                 pa.array(pack_parts(number[every], ends), pa.binary()),
                 pa.array(orders, pa.binary()), *carried.columns],
                names=["chunk", "numbers", "order", *carried.column_names])
            yield from out.combine_chunks().to_batches(max_chunksize=2000)
    return run


def _assemble(width: str, schema: pa.Schema):
    """Documents of a chunk and the answers to it -> documents with ids, 32 bits each."""
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        table: list[bytes] = []
        for row in sorted(answers.to_pylist(), key=lambda r: r["bucket"]):
            ids = np.frombuffer(unsqueeze(row["blob"]), width).astype("<u4").tobytes()
            table += slices(ids, unpack(row["lengths"]) * 4)
        order = next(o for o in docs.column("order").to_pylist() if o is not None)
        order = np.frombuffer(order, "<u4")
        numbers = unpack_parts(docs.column("numbers").to_pylist())
        most = max((int(n.max()) for n in numbers if len(n)), default=-1)
        if most >= len(order) + len(table) or len(order) and int(order.max()) >= len(table):
            raise ValueError("the documents changed between two readings; store them first")
        by_number = [*(table[i] for i in order.tolist()), *table]
        ids = [b"".join(map(by_number.__getitem__, n.tolist())) for n in numbers]
        return pa.Table.from_arrays(
            [*(docs.column(3 + k) for k in range(len(schema) - 2)),
             pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())],
            schema=schema)
    return run


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text",
           carry: list[str] | None = None, out: tuple[str, str] = ("n_tokens", "ids"),
           chunk: int = CHUNK) -> DataFrame:
    """The carried columns (default: all), number of tokens, and ids as little-endian unsigned
    32-bit integers in one binary value."""
    spark = docs.sparkSession
    carry = docs.columns if carry is None else carry
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    width = "<u2" if max(ranks.values(), default=0) < 1 << 16 else "<u4"
    sent = spark.sparkContext.broadcast(ranks)
    # names of our own inside, so that carried columns may have any name
    inner = [f"c{i}" for i in range(len(carry))]
    body = F.col(f"`{text}`").cast("string").alias("t")
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(carry, inner, strict=True)), body)
    kept = T.StructType([f for f in rows.schema if f.name != "t"])
    requests = docs.select(body).mapInArrow(
        _requests(pattern, buckets, chunk), "bucket int, chunk binary, lengths binary, blob binary")
    answers = requests.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        _answers(sent, pattern, width), requests.schema)
    positions = rows.mapInArrow(_positions(pattern, buckets, chunk), T.StructType([
        T.StructField("chunk", T.BinaryType()), T.StructField("numbers", T.BinaryType()),
        T.StructField("order", T.BinaryType()), *kept]))
    n, ids = free_name(inner, "n_tokens"), free_name(inner, "ids")
    schema = T.StructType([*kept, T.StructField(n, T.LongType()), T.StructField(ids, T.BinaryType())])
    whole = positions.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _assemble(width, to_arrow_schema(schema)), schema)
    return whole.select(*(F.col(i).alias(c) for i, c in zip(inner, carry, strict=True)),
                        F.col(n).alias(out[0]), F.col(ids).alias(out[1]))


def decode(spark: SparkSession, ids, ranks: dict[bytes, int]):
    """Column of the bytes that a column of ids (as ``encode`` gives them) stands for."""
    table = spark.sparkContext.broadcast({v: k for k, v in ranks.items()})

    def of(values: pa.Array) -> pa.Array:
        token = table.value.get
        out = []
        for v in values:
            parts = None if v.as_py() is None else list(
                map(token, np.frombuffer(v.as_py(), "<u4").tolist()))
            out.append(None if parts is None or None in parts else b"".join(parts))
        return pa.array(out, pa.binary())

    of.__annotations__ = {"values": pa.Array, "return": pa.Array}
    return F.arrow_udf(of, T.BinaryType())(ids)
