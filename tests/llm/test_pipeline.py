"""Perspectives against SQL, and the pipeline's stages with planted cases."""

import re

import duckdb
import pytest

import corpus_pipeline
from plotwise.llm import chat
from plotwise.llm.queries import QUERIES, SQL
from plotwise.llm.common import stored


def test_perspectives_match_sql(spark, root):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{root}/conversations.parquet'")
    rel = con.execute(SQL["op6_perspectives"])
    names = [d[0] for d in rel.description]
    want = sorted(tuple(dict(zip(names, r)).values()) for r in rel.fetchall())
    got = sorted(tuple(r[n] for n in names) for r in QUERIES["op6_perspectives"](spark, root).collect())
    assert got == want


def test_several_speakers_take_turns(spark):
    turns = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi é"), (1, 2, "bob", "yo"), (1, 3, "ann", None), (1, 3, "ann", None), (2, None, None, "lone"), (None, 1, "ann", "x"), (3, 0, "system", "s"), (1, 70, "bob", "late")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS part", "'q' AS speaker", "array(1) AS turns")
    got = {(r.conv_id, r.speaker, r.part): r for r in chat.rotate(df).collect()}
    assert set(got) == {(1, "ann", 0), (1, "bob", 0), (2, "unknown", 0)}
    ann = got[1, "ann", 0]
    assert ann.rendered == "<|system|>be kind<|end|>\n<|assistant|>hi é<|end|>\n<|user name=bob|>yo<|end|>\n<|assistant|><|end|>\n<|assistant|><|end|>\n<|user name=bob|>late<|end|>\n"
    assert (ann.n_turns, ann.n_trained) == (6, 3)
    assert [ann.rendered[int(a):int(b)] for a, b in (s.split(":") for s in ann.mask.split(","))] == ["hi é", "", ""]
    bob = got[1, "bob", 0]
    assert [bob.rendered[int(a):int(b)] for a, b in (s.split(":") for s in bob.mask.split(","))] == ["yo", "late"]
    assert chat.rotate(df.where("1 = 0")).collect() == []


def test_repeated_turns_without_numbers_stay(spark):
    """A dialogue of one repeated word and no turn numbers keeps every turn, in windows of 64, over several tasks."""
    turns = spark.range(1000, numPartitions=5).selectExpr("if(id < 990, 1, id) AS conv_id", "CAST(NULL AS long) AS turn", "if(id % 2 = 0, 'a', 'b') AS role", "'ok' AS text", "1 AS number", "2 AS part")
    rows = chat.rotate(turns).where("conv_id = 1").collect()
    assert sum(r.n_turns for r in rows) == 2 * 990 and max(r.n_turns for r in rows) == 64 and len(rows) == 2 * 16
    assert sum(r.n_trained for r in rows) == 990 and sum(r.rendered.count("ok<|end|>") for r in rows) == 2 * 990


@pytest.fixture(scope="module")
def staged(spark, root, docs):
    """The tables after each stage, with planted rows among the documents."""
    bench = spark.read.parquet(f"{root}/benchmark.parquet").first().text
    filler = docs.where("lang = 'en'").orderBy("n_chars").first().text
    base = docs.where("lang = 'en' AND n_chars > 3000").orderBy("doc_id").first().text
    near = base + "  "
    planted = [(9001, base), (9002, near), (9003, f"{filler} {bench} {filler}"), (9004, filler + " Write to eve.far@mail.example.org or +1 (504) 555-2652 now."), (9005, "12 34 !!"), (9006, None)]
    rows = spark.createDataFrame([(i, t, "en", "planted", None if t is None else len(t)) for i, t in planted], docs.schema)
    at, out = docs.unionByName(rows), {}
    for name, stage in corpus_pipeline.STAGES:
        at = stored(stage(spark, at, root), f"test-{name}")
        out[name] = at
    return out


def test_stages_act(staged, docs, spark, root):
    ids = {name: {r.doc_id for r in df.select("doc_id").collect()} for name, df in staged.items()}
    assert {9005, 9006}.isdisjoint(ids["language"]) and len(ids["language"]) == docs.count() + 4
    assert {9001, 9002}.isdisjoint(ids["near_copies"]) and {9003, 9004} <= ids["near_copies"]
    assert ids["near_copies"] - ids["benchmark_leaks"] >= {9003} and 9004 in ids["benchmark_leaks"]
    masked = staged["personal_data"].where("doc_id = 9004").first()
    assert "Write to <EMAIL> or <PHONE> now." in masked.text and masked.n_chars == len(masked.text)
    for name in ("language", "near_copies", "benchmark_leaks", "personal_data"):
        assert staged[name].schema == docs.schema
    assert ids["packing"] == ids["personal_data"]
    assert staged["packing"].groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0] <= 2048
    mail = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    assert not any(mail.search(r.text) for r in staged["personal_data"].select("text").collect())


def test_empty_pipeline(spark, root, no_docs, docs):
    at = docs.where("1 = 0")
    for name, stage in corpus_pipeline.STAGES:
        at = stored(stage(spark, at, root), f"test-{name}")
    assert at.collect() == []
