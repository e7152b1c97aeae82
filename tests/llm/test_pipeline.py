"""The corpus pipeline: stages on their predecessors' results, and the entry."""

from __future__ import annotations

import subprocess
import sys

import corpus_pipeline as C
from ratingspark.llm import queries as Q
from ratingspark.llm import stages
from tests.conftest import ROOT, SF_MED, SF_SMALL
from tests.llm import brute


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_MED}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in C.STAGES:
        before = docs
        out = stage(spark, docs, SF_MED)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs
        if name != C.STAGES[-1][0]:
            assert docs.columns == columns
        if name == "exact_dedup":
            rows = [(r["doc_id"], brute.ascii_lower(r["text"])) for r in before.collect()]
            want = {}
            for d, t in rows:
                want[t] = max(d, want.get(t, d))
            assert sorted(r["doc_id"] for r in docs.collect()) == sorted(want.values())
        if name == "near_dedup":
            comp = brute.near_components([(r["doc_id"], r["text"]) for r in before.collect()])
            want = {c if n else d for d, (n, c) in comp.items()}
            assert sorted(r["doc_id"] for r in docs.collect()) == sorted(want)
        if name == "mixing":
            assert {r["doc_id"] for r in docs.collect()} <= {r["doc_id"] for r in before.collect()}
    pieces = kept["packing"].collect()
    assert sum(r["length"] for r in pieces if r["start"] == 0 and r["length"] == r["doc_tokens"]) > 0
    assert len({(r["sequence_id"], r["offset"]) for r in pieces}) == len(pieces)
    total = sum(r["length"] for r in pieces)
    assert max(r["sequence_id"] for r in pieces) == (total - 1) // 1024
    whole = C.run(spark, SF_MED)
    assert whole.columns == kept["packing"].columns
    assert whole.count() == len(pieces)


def test_stage_list():
    assert [n for n, _ in C.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    assert all(f is getattr(stages, f.__name__) for _, f in C.STAGES)


def test_entry_has_one_query_for_each_operator():
    import __spark_entry__ as E
    names = list(E.queries())
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and set(Q.ORACLES) <= set(E.oracle_sql())


def test_entry_without_this_subpackage(tmp_path):
    """The rest imports and lists its queries when these files are gone."""
    code = ("import sys, importlib.abc\n"
            "class Gone(importlib.abc.MetaPathFinder):\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name in ('corpus_pipeline', 'ratingspark.llm'): raise ModuleNotFoundError(name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as E\n"
            "print(len(E.queries()), any(x.startswith('op') for x in E.queries()), 'pipeline' in E.queries())\n")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=100)
    assert out.returncode == 0, out.stderr
    n, ops, pipe = out.stdout.split()
    assert int(n) > 90 and (ops, pipe) == ("False", "False")


def test_run_on_odd_tables(spark, tmp_path):
    """NULLs in every column, empty and repeated rows, extra columns with the
    names that stages use; and no documents at all."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    extra = {c: F.lit(1) for c in ("row", "uid", "ids", "copy", "rate", "label", "score", "kept", "component_id")}
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", "en", "s", 0), (-2, None, None, "s", None),
                                 (-3, "   ", "en", None, 3), (-4, "same words here", "en", "s", 15),
                                 (-4, "same words here", "en", "s", 15)], docs.schema)
    docs.unionByName(odd).withColumns(extra).write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    none = spark.createDataFrame([(None, None, None), (5, None, 1), (6, 1, None)], labels.schema)
    labels.unionByName(none).write.parquet(str(tmp_path / "labels.parquet"))
    out = C.run(spark, str(tmp_path)).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in out}) == len(out) > 0
    assert sum(r["doc_id"] is None for r in out) <= 3
    empty = tmp_path / "empty"
    docs.limit(0).write.parquet(str(empty / "documents.parquet"))
    labels.limit(0).write.parquet(str(empty / "labels.parquet"))
    assert C.run(spark, str(empty)).collect() == []
