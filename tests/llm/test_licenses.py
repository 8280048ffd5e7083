"""License scans against brute force over words."""

import re

import pytest
from pyspark.sql import functions as F

from plotwise.llm import licenses as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def base_places(text):
    w = words(text)
    return sorted((i, t.label) for t in L.PHRASES for i in range(len(w)) if w[i : i + len(words(t.text))] == words(t.text))


def slow_labels(text, templates):
    """Each band of diagonals on its own: words of the template that equal runs cover."""
    w, found = words(text), set()
    for template in templates:
        v = words(template.text)
        hits = [(p, t) for p in range(len(w) - 2) for t in range(len(v) - 2) if w[p : p + 3] == v[t : t + 3]]
        starts = {p - t for p, t in hits}
        for phase in (0, template.drift):
            width = 2 * template.drift
            for d in starts:
                band = [t for p, t in hits if (p - t == d if not width else (p - t + phase) // width == (d + phase) // width)]
                if len({t + i for t in band for i in range(3)}) >= template.share * len(v) - 1e-12:
                    found.add(template.label)
    return ",".join(sorted(found))


MIT = L.NOTICES[0].text
CASES = [
    None, "", "!!", "cc", "CC BY-NC", "cc by nc cc by nc", "cc by by nc", "Under the MIT License. under the mit license!", "under the mit\x00license", "under the mitlicense",
    "APACHE LICENSE, version 2.0 under the Apache License Version 2", "licensed under the GNU General Public License, version 3.", "licensed under the GNU General Public License, version 2.",
    MIT, MIT.upper(), MIT.replace("free of charge", "wholly free of any charge"), MIT.replace("to use, copy", "to use and to copy"), " ".join(MIT.split()[:20]), " ".join(MIT.split()[6:]), " ".join(reversed(MIT.split())),
    "x " * 5000 + MIT + " y" * 5000 + " cc by nc", "Kunder the mit license K", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "é cc by nc é",
]


@pytest.fixture(scope="module")
def scanned(spark):
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in enumerate(CASES)], "doc_id long, text string, template string, diagonal int, n_words int")
    return {r.doc_id: r for r in L.scan(docs).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_scan(scanned, i):
    row, places = scanned[i], base_places(CASES[i])
    assert row.n_words == len(words(CASES[i])) and row.n_base == len(places)
    assert (row.first_word, row.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
    assert row.base_labels == ",".join(sorted({label for _, label in places}))
    assert row.labels == slow_labels(CASES[i], L.PHRASES + L.NOTICES)
    assert 0 <= row.score <= 1 and (row.score == 1 or not places)


def test_changed_copies_are_found(scanned):
    assert [scanned[i].labels for i in (13, 14, 15, 16, 18)] == ["mit"] * 5
    assert scanned[17].labels == scanned[19].labels == "" and 0.2 < scanned[17].score < 0.8


def test_odd_rows(spark, odd_docs, no_docs):
    rows = L.scan(odd_docs).collect()
    assert len(rows) == odd_docs.count() and {r.labels for r in rows} == {""}
    assert sorted((r.doc_id or -1, r.n_words) for r in rows) == sorted((r.doc_id or -1, len(words(r.text))) for r in odd_docs.collect())
    assert L.scan(no_docs).collect() == []


def test_repeated_rows_and_hot_copies(spark):
    docs = spark.range(300).select(F.lit(7).alias("doc_id"), F.lit("a cc by nc b under the mit license").alias("text"))
    rows = L.scan(docs.unionAll(spark.createDataFrame([(7, "cc by nc"), (None, "cc by nc")], "doc_id long, text string"))).collect()
    assert len(rows) == 302 and sum(r.n_base for r in rows) == 602


def test_spans(spark):
    docs = spark.createDataFrame([(1, f"one two {MIT} three cc by nc")], "doc_id long, text string")
    found = {(r.label, r.first_word, r.end_word) for r in L.spans(docs).collect()}
    n = len(words(MIT))
    assert found == {("mit", 2, 2 + n), ("cc-by-nc", 3 + n, 6 + n)}


def test_no_python_in_the_plan(spark):
    plan = L.scan(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan and "BroadcastHashJoin" in plan
