import hashlib
import subprocess
import sys
import zlib
from pathlib import Path

import pytest

import corpus_pipeline
from closewright.llm import shared
from closewright.llm.queries import QUERIES
from closewright.llm.sql import ORACLE


def test_stages_on_small_documents(spark, tmp_path):
    """Copies, items, personal data and texts without letters go where their stage says; the rest is encoded whole."""
    from tests.llm.test_langid import rows

    docs = [(k, t, lang, "s", len(t)) for k, t, lang in rows(80)]
    copy = " ".join(f"sentence{n} the ing" for n in range(40))
    item = "A train leaves Boston at 40 miles per hour and meets another train that left Denver at 60 miles per hour today"
    docs += [(200, copy, "aa", "s", 1), (201, copy, "aa", "s", 1), (202, copy + " more", "aa", "s", 1), (203, "123 456", None, "s", 7), (204, None, "aa", "s", None), (205, copy[::-1] + " " + item, "aa", "s", 1), (206, "the ing and tion mail a@b.cd the ing", "aa", "s", 36)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = shared.written(stage(spark, now, str(tmp_path)), name)
        if name != "bpe":
            assert sorted(after.columns) == sorted(now.columns)
        seen[name] = {r.doc_id: r for r in after.collect()}
        now = after
    ids = {name: set(held) for name, held in seen.items()}
    assert ids["language"] == set(range(80)) | {200, 201, 202, 205, 206}
    assert {200, 205, 206} <= ids["near_duplicates"] and not ids["near_duplicates"] & {201, 202}
    assert ids["near_duplicates"] - ids["benchmark_free"] == {205}
    assert ids["personal_data"] == ids["bpe"] == ids["benchmark_free"]
    assert seen["personal_data"][206].text == "the ing and tion mail [EMAIL] the ing"
    assert seen["bpe"][206].n_tokens > 5
    whole = {r.doc_id: tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert whole == {k: tuple(r) for k, r in seen["bpe"].items()}


def test_stages_on_odd_tables(spark, tmp_path):
    """Empty tables, repeated rows, nulls in every column, and columns named as those the stages use."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, __score string, __lang string, __id string, __hash string, __text string, lang_found string, row string, key string, t string"
    extra = ("a", "b", "c", "d", "e", "f", "g", "h", "i")
    told = [(k, f"the ing and tion number {k} mail a{k}@b.cd the ing", "aa", "s", 40, *extra) for k in range(12)]
    odd = [(None, None, None, None, None, *[None] * 9), (3, "", "aa", "s", 0, *extra), (None, "the ing and tion without any id", None, None, None, *extra)]
    spark.createDataFrame([(1, None), (None, "an item that no document holds at all here")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (told + told[:4] + odd * 2, []):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            after = shared.written(stage(spark, docs, str(tmp_path)), name)
            if name != "bpe":
                assert after.schema.names == docs.schema.names and after.dtypes == docs.dtypes
                kept = [tuple(r)[5:] for r in after.collect()]
                assert all(k in (extra, (None,) * 9) for k in kept)
            if name in ("benchmark_free", "personal_data"):
                assert after.count() == docs.count()
            docs = after
        assert {r.doc_id for r in docs.collect()} <= {*range(12), None} and (docs.count() > 0) == bool(rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    import duckdb

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.sql(f"create view {t} as select * from '{folder}/{t}.parquet'")
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    got = sorted(map(tuple, df.select(*columns).collect()), key=str)
    assert got == sorted(map(tuple, con.sql(f"select {', '.join(columns)} from ({ORACLE[name]})").fetchall()), key=str)


def test_a_query_for_every_operator():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        shared.shared_folder(Session())


def test_tasks_give_freed_memory_back():
    """Small blocks that a task has freed below one that is still held do not stay with its process."""
    told = subprocess.run([sys.executable, "-c", HELD], capture_output=True, text=True, cwd=Path(__file__).resolve().parents[2])
    assert told.returncode == 0, told.stderr
    plain, tidied = map(int, told.stdout.split())
    assert plain > 80 and tidied < 20


HELD = """
import re
import numpy as np
from closewright.llm.shared import tidied

def mb():
    return sum(map(int, re.findall(r"\\nPss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) // 1024

kept = []
def task(batches):
    blocks = [np.ones(8000) for _ in range(2000)]
    kept.append(np.ones(8000))
    yield from batches

for run in (task, tidied(task)):
    before = mb()
    assert list(run([1, 2])) == [1, 2]
    print(mb() - before)
"""


def test_a_tidied_task_that_is_left_early_ends():
    ended = []

    def task(batches):
        try:
            yield from batches
        finally:
            ended.append(1)

    run = shared.tidied(task)(iter([1, 2]))
    assert next(run) == 1
    run.close()
    assert ended == [1]


def test_contract_digest_and_remainder():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442") and zlib.crc32(b"0") % 4 in range(4)


def test_entry_works_without_the_text_operators(tmp_path):
    import shutil
    from pathlib import Path

    root = Path(__file__).resolve().parents[2]
    shutil.copytree(root / "closewright", tmp_path / "closewright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    told = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') for n in e.queries()), 'pipeline' in e.queries())"], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
    assert told.returncode == 0, told.stderr
    assert told.stdout.split()[1:] == ["False", "False"]
