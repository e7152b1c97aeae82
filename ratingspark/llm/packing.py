"""Packing token ids into fixed sequences: concatenate and cut.

Pass one turns each text into ids plus a closing id 0 and writes them with the
running number of ids inside their partition. The totals of the partitions
give, by prefix sums (within blocks of partitions, then over blocks), the
number of ids before each partition. Pass two adds it, so every document knows
its place in the one long concatenation and is cut at multiples of the
sequence length without looking at any other row: no shuffle of ids, no window
over documents. A piece that touches a cut is a boundary record: the rest of
its document opens the next sequence. Only the last sequence has padding.

Ids are kept in two bytes where the vocabulary fits, else in four. The default
vocabulary file is read by the tiktoken library; a ``.json`` file by the
tokenizers library, which gives the same ids for the same vocabulary (tested)
at a fifth of the speed. Strings of the file's added tokens get the ids of
these tokens, as the tokenizers library does by default.

Defined cases: NULL text is empty, so its document is just the closing id;
NULL and repeated doc_ids are packed like any other, one run of pieces per
row; order in the concatenation is the order of the written partitions. An
empty table gives no pieces.
"""

from __future__ import annotations

import base64
import json

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratingspark.llm.common import Scratch, small_or_not

LENGTH = 1024
VOCABULARY = "byte_bpe_50k"
END_ID = 0
# Longer texts go to the tokenizers library, as the other one's pattern
# matcher may exhaust its stack on them. Ids are the same.
LONG_TEXT = 1_000_000
PARTITIONS_PER_BLOCK = 4096


def vocabulary_path(name: str) -> str:
    """``name`` if it is a path, else the place of that public vocabulary."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str):
    """text -> list of ids, for a ``.json`` or ``.tiktoken`` vocabulary file."""
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        return lambda text: t.encode(text, add_special_tokens=False).ids
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    with open(path.removesuffix(".tiktoken") + ".json") as f:   # the same vocabulary, with its added tokens
        added = {a["content"]: a["id"] for a in json.load(f)["added_tokens"]}
    t = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
    return lambda text: t.encode(text, allowed_special="all")


def _tokenise(name: str, end_id: int, width: str):
    def run(batches):
        fast, slow = encoder(vocabulary_path(name + ".tiktoken")), None
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, n, start = [], [], []
            for t in batch.column("text"):
                text = t.as_py() or ""
                if len(text) > LONG_TEXT:
                    slow = slow or encoder(vocabulary_path(name + ".json"))
                    got = slow(text)
                else:
                    got = fast(text)
                got.append(end_id)
                ids.append(np.array(got, dtype=width).tobytes())
                n.append(len(got))
                start.append(before)
                before += len(got)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(n, pa.int64()),
                 pa.array([part] * len(n), pa.int64()), pa.array(start, pa.int64())],
                names=["doc_id", "ids", "doc_tokens", "part", "before"])
    return run


def _cut(length: int, width: str):
    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("row", "start", "length", "ids", "sequence_id", "offset", "boundary")}
            place = batch.column("place").to_pylist()
            for i, raw in enumerate(batch.column("ids")):
                ids = np.frombuffer(raw.as_py(), dtype=width).astype("<u4")
                at, done = place[i], 0
                while done < len(ids):
                    k = min(length - at % length, len(ids) - done)
                    for name, v in (("row", i), ("start", done), ("length", k), ("ids", ids[done:done + k].tobytes()),
                                    ("sequence_id", at // length), ("offset", at % length),
                                    ("boundary", done > 0 or done + k < len(ids))):
                        out[name].append(v)
                    at, done = at + k, done + k
            rows = pa.array(out["row"], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rows), pa.array(out["start"], pa.int64()),
                 pa.array(out["length"], pa.int64()), pa.array(out["ids"], pa.binary()),
                 batch.column("doc_tokens").take(rows), pa.array(out["sequence_id"], pa.int64()),
                 pa.array(out["offset"], pa.int64()), pa.array(out["boundary"], pa.bool_())],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "boundary"])
    return run


def partition_bases(tokens: DataFrame) -> DataFrame:
    """(part, base): ids in all partitions before ``part``. Prefix sums run
    within blocks of partitions and over the block totals."""
    totals = (tokens.groupBy("part").agg(F.sum("doc_tokens").alias("t"))
                    .withColumn("block", F.floor(F.col("part") / PARTITIONS_PER_BLOCK)))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = totals.groupBy("block").agg(F.sum("t").alias("t")).select(
        "block", F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("block_base"))
    inside = Window.partitionBy("block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return (totals.withColumn("inside", F.coalesce(F.sum("t").over(inside), F.lit(0))).join(blocks, "block")
                  .select("part", (F.col("block_base") + F.col("inside")).alias("base")))


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
         vocabulary: str = VOCABULARY, end_id: int = END_ID, vocabulary_size: int = 50_257) -> DataFrame:
    """One row per piece: doc_id, start (ids of its document before it),
    length, ids (little-endian unsigned 32 bit), doc_tokens, sequence_id,
    offset (place in the sequence), boundary (its document goes on in another
    piece)."""
    scratch = Scratch(docs.sparkSession)
    width = "<u2" if vocabulary_size <= 1 << 16 else "<u4"
    key_type = docs.schema[key].dataType.simpleString()
    tokens = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(
        _tokenise(vocabulary, end_id, width),
        f"doc_id {key_type}, ids binary, doc_tokens bigint, part bigint, before bigint")
    tokens = scratch.keep(tokens)
    bases = small_or_not(scratch.keep(partition_bases(tokens)), 32)
    placed = tokens.join(bases, "part").select("doc_id", "ids", "doc_tokens",
                                               (F.col("base") + F.col("before")).alias("place"))
    return placed.mapInArrow(_cut(length, width),
                             f"doc_id {key_type}, start bigint, length bigint, ids binary, doc_tokens bigint, "
                             "sequence_id bigint, offset bigint, boundary boolean")


def padded(n: int, length: int) -> int:
    """Ids in a stored sequence of ``n`` ids: ``length``, but a power of two
    stays as it is."""
    return n if n & (n - 1) == 0 else length


def sequences(pieces: DataFrame, length: int = LENGTH, pad_id: int = END_ID) -> DataFrame:
    """sequence_id, ids (array<int>, padded), n_ids (without padding). A group
    holds at most ``length`` ids."""

    def join(batches):
        for batch in batches:
            ids, n = [], []
            for pieces_ in batch.column("pieces").to_pylist():
                whole = np.concatenate([np.frombuffer(p["ids"], "<u4") for p in
                                        sorted(pieces_, key=lambda p: p["offset"])])
                n.append(len(whole))
                ids.append(np.pad(whole, (0, padded(len(whole), length) - len(whole)), constant_values=pad_id)
                           .astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("sequence_id"), pa.array(ids, pa.list_(pa.int32())),
                                              pa.array(n, pa.int64())], names=["sequence_id", "ids", "n_ids"])

    grouped = pieces.groupBy("sequence_id").agg(F.collect_list(F.struct("offset", "ids")).alias("pieces"))
    return grouped.mapInArrow(join, "sequence_id bigint, ids array<int>, n_ids bigint")
