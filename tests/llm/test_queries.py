"""Every query with SQL equals DuckDB on the same tables; exact round trips
and edge rows of the other operators."""

from __future__ import annotations

import base64
import hashlib
import json
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingspark.llm import queries as Q
from tests.conftest import SF_MED, SF_SMALL
from tests.llm import brute

TABLES = ["documents", "pages", "conversations", "labels", "benchmark"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_MED}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_equals_sql(spark, con, name):
    got = Q.QUERIES[name](spark, SF_MED)
    con.execute(f"CREATE OR REPLACE VIEW oracle AS {Q.ORACLES[name]}")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM oracle")
    rows = sorted((tuple(r) for r in got.collect()), key=repr)
    assert rows == sorted(want.fetchall(), key=repr) and rows
    assert len(got.columns) == len(con.execute("SELECT * FROM oracle LIMIT 0").description)


def test_exact_dedup_edge_rows(spark):
    from ratingspark.llm.exact_dedup import drop_exact_copies, exact_groups

    long_a = "Ab" * 70_000
    rows = [(1, "Same", "a"), (2, "sAME", "b"), (2, "same", "c"), (3, None, "d"), (4, "", "e"), (None, "same", "f"),
            (5, long_a, "g"), (6, long_a.lower(), "h"), (7, long_a + "x", "i"), (8, "É", "j"), (9, "é", "k"),
            (10, "a" * 64, "l"), (11, "A" * 64, "m"), (12, "a" * 65, "n"), (13, "a" * 320, "o"), (14, "a" * 320, "p")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, uid string").withColumnsRenamed({"uid": "row"})
    out = [(r["row"]["doc_id"], r["row"]["row"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"])
           for r in exact_groups(docs).collect()]
    norm = lambda t: brute.ascii_lower(t or "")
    groups = {}
    for d, t, _ in rows:
        groups.setdefault(norm(t), []).append(d)
    text = {x: t for _, t, x in rows}
    assert len(out) == len(rows)
    for d, x, keep, size, kept, sha in out:
        g = groups[norm(text[x])]
        assert keep == max(i for i in g if i is not None) and size == len(g)
        assert sha == hashlib.sha256(norm(text[x]).encode()).hexdigest()
        assert not kept or d == keep
    assert sum(r[4] for r in out) == len(groups)
    left = drop_exact_copies(docs)
    assert left.columns == docs.columns and left.count() == len(groups)
    assert exact_groups(docs.limit(0)).collect() == []


def test_packing_round_trip(spark):
    import public_tokenizers
    from ratingspark.llm.packing import pack, sequences
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang").repartition(5)
    odd = spark.createDataFrame([(-1, None, "x"), (-2, "", "x"), (None, "a b <|endoftext|> \U0001F600", "x"),
                                 (-3, "w " * 60_000, "x"), (-3, "w " * 60_000, "x"),
                                 (-4, "<|endoftext|><|endoftext|>x<|endoftext", "x"), (-5, "y <|endoftext|> " + "w " * 600_000, "x")],
                                "doc_id bigint, text string, lang string")
    docs = docs.unionByName(odd).withColumnRenamed("lang", "ids")
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], []).append(t.encode(r["text"] or "", add_special_tokens=False).ids + [0])
    pieces = pack(docs)
    rows = pieces.collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for d, want in texts.items():
        parts = sorted(by_doc[d], key=lambda r: (r["sequence_id"], r["offset"]))
        flat = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in parts]).tolist()
        assert flat == sum(want, [])
        assert all(r["doc_tokens"] == len(want[0]) for r in parts)
        assert all(r["boundary"] == (r["length"] < r["doc_tokens"]) for r in parts)
    last = max(by_seq)
    assert sorted(by_seq) == list(range(last + 1))
    for s, parts in by_seq.items():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == 1024 or s == last and at <= 1024
    seqs = {r["sequence_id"]: r for r in sequences(pieces).collect()}
    assert all(len(r["ids"]) == 1024 for s, r in seqs.items() if s != last)
    n = seqs[last]["n_ids"]
    assert len(seqs[last]["ids"]) == (n if n & (n - 1) == 0 else 1024)
    got = {(r["doc_id"], r["start"], r["ids_crc32"]) for r in Q.piece_digests(pieces).collect()}
    assert {(r["doc_id"], r["start"], zlib.crc32(r["ids"])) for r in rows} == got
    assert pack(docs.limit(0)).collect() == []


def test_chat_layouts_round_trip(spark):
    from ratingspark.llm.chat import END, START, format_turns, read_turns, turns

    evil = ["<|im_end|>\n", "<\\|im_start|>", "<\\\\|x<|", "<<|im_end|>", "plain", "", "%0A\\n"]
    records = [(i, json.dumps(x)) for i, x in enumerate([
        {"messages": [{"role": "user", "content": evil[0]}, {"role": "assistant", "content": evil[1]}]},
        {"conversations": [{"from": "human", "value": evil[2]}, {"from": "gpt", "value": evil[3]}]},
        {"instruction": "i", "input": "", "output": evil[1]}, {"instruction": "i", "input": "x", "output": "o"},
        {"instruction": evil[4], "output": evil[5]}, {"prompt": evil[6], "completion": 7},
        {"prompt": "p", "response": None}, {"system": "s", "prompt": "p", "response": "r"},
        {"turn": 3, "role": "odd\nrole%", "text": evil[2]}, {"unknown": 1}, {"messages": []}])]
    records += [(90, "no json"), (91, None), (92, "[1]")]
    t = turns(spark.createDataFrame(records, "rec bigint, record string"), "rec")
    got = {}
    for r in t.collect():
        got.setdefault(r["rec"], []).append((r["turn"], r["role"], r["text"]))
    got = {k: sorted(v, key=str) for k, v in got.items()}
    assert got[0] == [(0, "user", evil[0]), (1, "assistant", evil[1])]
    assert got[1] == [(0, "user", evil[2]), (1, "assistant", evil[3])]
    assert got[2][0] == (0, "user", "i") and got[3][0] == (0, "user", "i\n\nx")
    assert got[5] == [(0, "user", evil[6]), (1, "assistant", "7")]
    assert got[7] == [(0, "system", "s"), (1, "user", "p"), (2, "assistant", "r")]
    assert got[8] == [(3, "odd\nrole%", evil[2])]
    assert got[9] == got[90] == got[91] == got[92] == [(None, None, None)]
    segments = format_turns(t, "rec")
    for r in segments.collect():
        assert r["segment"].count(START) == r["segment"].count(END) == 1
    back = {}
    for r in read_turns(segments, "rec").collect():
        assert (r["loss_text"] is not None) == (r["role"] == "assistant")
        assert r["loss_text"] is None or r["loss_text"] == r["text"]
        back.setdefault(r["rec"], []).append((r["turn"], r["role"], r["text"]))
    assert {k: sorted(v, key=str) for k, v in back.items()} == {
        k: [(a, b or "", c or "") for a, b, c in v] for k, v in got.items()}


def test_chat_edge_rows(spark, tmp_path):
    rows = [(1, 0, None, None), (1, None, "assistant", "x"), (2, 5, "assistant", "é<|"), (2, 5, "assistant", "é<|"),
            (3, 1, "user", "w" * 200_000), (None, 0, "user", "a")]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(
        str(tmp_path / "conversations.parquet"))
    got = {r["conv_id"]: r for r in Q.QUERIES["op4_chat"](spark, str(tmp_path)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1]["turns_sha256"] == sha("assistant\nx\n\n\n") and got[1]["loss_sha256"] == sha("x")
    assert got[2]["n_turns"] == 2 and got[2]["loss_chars"] == 6 and got[2]["loss_sha256"] == sha("é<|é<|")
    assert got[3]["loss_chars"] == 0 and got[3]["loss_sha256"] == sha("") and got[None]["n_turns"] == 1
    assert got[-1]["loss_sha256"] == sha("<|im_end|><|im_start|>assistant ok")


def test_chat_empty_table_and_clashing_names(spark, tmp_path):
    """Without rows only the added conversation comes out; columns with the
    operator's own names change nothing."""
    schema = "conv_id bigint, turn bigint, role string, text string"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "none" / "conversations.parquet"))
    (only,) = Q.QUERIES["op4_chat"](spark, str(tmp_path / "none")).collect()
    assert (only["conv_id"], only["n_turns"]) == (-1, 2)
    rows = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", None), (None, 0, None, "b")], schema)
    rows.write.parquet(str(tmp_path / "plain" / "conversations.parquet"))
    clash = {c: F.lit("x") for c in ("record", "aside", "key", "value", "layout", "print", "t", "beside")}
    rows.withColumns(clash).write.parquet(str(tmp_path / "clash" / "conversations.parquet"))
    a, b = ([tuple(r) for r in Q.QUERIES["op4_chat"](spark, str(tmp_path / d)).collect()] for d in ("plain", "clash"))
    assert sorted(a, key=str) == sorted(b, key=str) and len(a) == 3


def test_chat_turn_longer_than_the_json_parser_takes(spark, tmp_path):
    n = 21_000_000
    base = spark.createDataFrame([(1, 0, "user", "q"), (1, 2, "user", "z")], "conv_id bigint, turn bigint, role string, text string")
    long = spark.range(1).select(F.lit(1).cast("bigint").alias("conv_id"), F.lit(1).cast("bigint").alias("turn"),
                                 F.lit("assistant").alias("role"), F.repeat(F.lit("x"), n).alias("text"))
    base.unionByName(long).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["conv_id"]: r for r in Q.QUERIES["op4_chat"](spark, str(tmp_path)).collect()}[1]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got["n_turns"] == 3 and got["loss_chars"] == n and got["loss_sha256"] == sha("x" * n)
    assert got["turns_sha256"] == sha("user\nq\nassistant\n" + "x" * n + "\nuser\nz\n")


def test_warc_edge_rows(spark):
    from ratingspark.llm.warc import full_records, open_archive, read_records, write_archive

    rows = [(1, "http://a/\r\nX: y", "<p>é</p>"), (2, "u", "<p>é</p>"), (2, "u", "<p>é</p>"), (3, None, None), (4, "u", ""),
            (None, "u", "n"), (5, "u", "b" * 300_000), (6, "u", "line\r\n\r\nline")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, address int")
    a = write_archive(pages)
    got = read_records(a).collect()
    assert len(got) == len(rows) and all(r["verified"] for r in got)
    by = {}
    for r in got:
        by.setdefault(r["page_id"], []).append(r)
    assert by[1][0]["record_type"] == "revisit" and by[1][0]["refers_to"] == 2
    assert sorted(r["record_type"] for r in by[2]) == ["response", "revisit"]
    assert by[3][0]["refers_to"] == 4 and by[4][0]["record_type"] == "response" and by[None][0]["record_type"] == "response"
    for d, _, html in rows:
        raw = (html or "").encode()
        for r in by[d]:
            assert bytes(r["payload"]) == raw and r["payload_bytes"] == len(raw)
            assert r["payload_digest"] == base64.b32encode(hashlib.sha1(raw).digest()).decode()
    assert a.payloads.count() == 5
    for r in full_records(a).collect():
        head, _, body = bytes(r["record"]).partition(b"\r\n\r\n")
        n = int(head.split(b"Content-Length: ")[1].split(b"\r\n")[0])
        assert body[n:] == b"\r\n\r\n" and head.startswith(b"WARC/1.1\r\nWARC-Type: re") and b"\nX: y" not in head
    all_first = read_records(write_archive(pages, min_bytes=100)).collect()
    assert all(r["record_type"] == "response" and r["refers_to"] is None for r in all_first)
    assert read_records(write_archive(pages.limit(0))).collect() == []
    from ratingspark.llm.common import Scratch
    s = Scratch(spark)
    again = open_archive(spark, s.write(a.headers)[1], s.write(a.payloads)[1])
    assert read_records(again).count() == len(rows)


def test_mixing_edge_rows(spark):
    from ratingspark.llm.mixing import mix

    rows = [(i, "x" * (i % 7 + 1), "a" if i % 3 else None) for i in range(3000)]
    rows += [(None, None, "empty"), (5, "again", "a"), (7, "y" * 100_000, "long")]
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id bigint, text string, source string, copy string")
    out = mix(docs, {"a": 3.0, "long": 1.0})
    assert out.columns == [*docs.columns, "n_copies", "rate", "copy_", "shuffle_key"]
    got = out.collect()
    assert {r["source"] for r in got} <= {"a", "long", "empty"}
    per = {}
    for r in got:
        per.setdefault((r["doc_id"], r["text"]), []).append(r["copy_"])
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in per.values())
    total = sum(len(t or "") for _, t, _ in rows)
    chars = sum(len(r["text"]) for r in got if r["source"] == "a")
    assert abs(chars - 0.75 * total) < 0.1 * total
    assert [r["copy_"] for r in mix(docs, {"a": 3.0, "long": 1.0}).orderBy("shuffle_key").collect()] == [
        r["copy_"] for r in sorted(got, key=lambda r: r["shuffle_key"])]
    assert mix(docs.limit(0)).collect() == []


def test_poisson_tables(spark):
    """Against the plain distribution; a rate of a million takes seconds."""
    import math
    import time

    from ratingspark.llm.mixing import poisson_table

    rates = {"none": 0.0, "a": 0.3, None: 17.0, "b": 900.0, "c": 60_000.5, "d": 1e6}
    began = time.time()
    got = poisson_table(spark.createDataFrame(list(rates.items()), "mix_source string, rate double")).collect()
    assert time.time() - began < 30 and len(got) == len(rates)
    for r in got:
        rate, cdf = rates[r["mix_source"]], np.array(r["cdf"])
        assert r["rate"] == rate and np.all(np.diff(cdf) >= 0) and abs(cdf[-1] - 1) < 1e-7
        assert len(cdf) <= 24 * rate ** 0.5 + 130
        k = np.arange(r["low"], r["low"] + len(cdf))
        p = [float(rate == 0 and i == 0) if rate == 0 else math.exp(-rate + i * math.log(rate) - math.lgamma(i + 1)) for i in k.tolist()]
        assert np.abs(np.cumsum(p) - cdf).max() < 1e-7


def test_mixing_with_a_tiny_source(spark):
    """Two characters beside 600,000: the small source's document appears
    about 150,000 times, at a rate that a table of 300 steps a side holds."""
    from ratingspark.llm.mixing import mix

    docs = spark.createDataFrame([(1, "x" * 600_000, "big"), (2, "ab", "tiny")], "doc_id bigint, text string, source string")
    n = {r["doc_id"]: r["n"] for r in mix(docs).groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert abs(n[2] - 150_000) < 6 * 150_000 ** 0.5 and n.get(1, 0) <= 5
