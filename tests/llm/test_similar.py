"""Near copies, benchmark leaks and fingerprints against brute force."""

import hashlib
import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from plotwise.llm import decontaminate, fingerprints, simhash
from plotwise.llm.components import components


def reach(ids, links):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {i: find(i) for i in ids}


# ---- SimHash -----------------------------------------------------------------------------------------------------

def slow_print(text: str, size: int) -> int:
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    runs = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abCÉ \t\n\x0b  .1")), max_size=60))
def test_fingerprint(text):
    assert simhash.simhash(simhash.hashes(text.encode(), 4)) == slow_print(text, 4)


@pytest.mark.parametrize("bits", [2, 4, 9])
def test_no_link_is_lost(spark, bits):
    """Scattered fingerprints, dense groups around some, and one very dense group."""
    rng = random.Random(bits)
    x = {0}
    for n, spread in ((300, 0), (40, 3), (40, 6), (1, 2)):
        for _ in range(n):
            centre = rng.getrandbits(64)
            x.add(centre)
            for _ in range(8 if n > 1 else 200):
                near = centre
                for b in rng.sample(range(64), rng.randint(0, spread)):
                    near ^= 1 << b
                x.add(near)
    values = np.array(sorted(x), np.uint64)
    prints = spark.createDataFrame([(int(v), int(v)) for v in values.view(np.int64)], "fingerprint long, first_id long")
    links = simhash.linked(prints, bits)
    got = {r.id: r.component for r in components(links, "x", "y").collect()}
    d = np.bitwise_count(values[:, None] ^ values[None]) <= bits
    signed = values.view(np.int64)
    want = reach(signed.tolist(), [(int(signed[i]), int(signed[j])) for i, j in zip(*np.where(np.triu(d, 1)))])
    groups = lambda m: sorted(sorted(k for k in m if m[k] == c) for c in set(m.values()))
    assert groups({v: got.get(v, v) for v in want}) == groups(want)


def test_every_allocation_is_complete():
    """Any thresholds from the program put close fingerprints under a common key."""
    rng = np.random.default_rng(0)
    sample = rng.integers(0, 1 << 63, 200).astype(np.uint64)
    for bits, parts in ((3, 3), (4, 2), (4, 5), (6, 4)):
        groups = simhash.grouped_bits(200, np.eye(64) * 100, parts)
        chosen, _ = simhash.thresholds(10**6, sample, groups, bits)
        assert sum(e + 1 for e in chosen) == bits + 1 and sorted(b for g in groups for b in g) == list(range(64))
        choice = [(g, e) for g, e in zip(groups, chosen) if e >= 0]
        for v in sample[:40]:
            flip = rng.choice(64, bits, replace=False)
            other = v ^ np.uint64(sum(1 << int(b) for b in flip))
            assert (simhash.masked_keys(np.array([v]), choice) == simhash.masked_keys(np.array([other]), choice)).any()


def test_components_of_documents(docs, texts):
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    prints = {i: slow_print(t, 4) for i, t in texts.items()}
    links = [(a, b) for a, b in combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    assert got == reach(prints, links)


def test_odd_rows_link(odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in rows}
    assert len(rows) == odd_docs.count() and got[7] == got[1] and got[1][1] == 1
    assert got[2] == got[3] == got[10] == (0, 2)  # no words: fingerprint zero
    assert simhash.near_duplicates(no_docs).collect() == []


def test_one_of_each_group(docs, texts, odd_docs, no_docs):
    kept = {r.doc_id for r in simhash.one_of_each(docs).collect()}
    prints = {i: slow_print(t or "", 4) for i, t in texts.items()}
    links = [(a, b) for a, b in combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    assert kept == set(reach(prints, links).values())
    odd = simhash.one_of_each(odd_docs)
    assert odd.columns == odd_docs.columns
    ids = [r.doc_id for r in odd.collect()]
    assert sorted(ids, key=str) == sorted([1, 2, 4, 5, 6, None, 9, 11], key=str)
    assert simhash.one_of_each(no_docs).collect() == []


def test_near_copies_go_and_others_stay(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows = []
    for g in range(30):
        base = [word() for _ in range(1500)]
        rows.append((10 * g, " ".join(base)))
        for k in range(1, 4):
            copy = list(base)
            copy[rng.randrange(1500)] = word()
            rows.append((10 * g + k, " ".join(copy)))
    rows += [(1000 + i, rows[0][1]) for i in range(100)]
    prints = {i: slow_print(t, 4) for i, t in rows}
    links = [(a, b) for a, b in combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    want = set(reach(prints, links).values())
    assert want >= {10 * g for g in range(30)} and len(want) < 45  # nearly all edited copies lie within 4 bits
    kept = {r.doc_id for r in simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == want


# ---- benchmark leaks ---------------------------------------------------------------------------------------------

def test_leaks_match_plain_sets(spark, docs, texts, root, monkeypatch):
    items = spark.read.parquet(f"{root}/benchmark.parquet")
    bench = {r.item_id: r.text for r in items.collect()}
    want = set()
    runs = lambda t: decontaminate.shingles(decontaminate.words(t.encode()), 5)
    of_docs = {i: runs(t) for i, t in texts.items()}
    for j, t in bench.items():
        own = runs(t)
        want |= {(i, j, len(own & s), len(own)) for i, s in of_docs.items() if len(own & s) >= 0.8 * len(own)}
    one = {(r.doc_id, r.item_id, r.shared, r.shingles) for r in decontaminate.leaks(docs, items).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 2000)  # the benchmark in several blocks
    many = {(r.doc_id, r.item_id, r.shared, r.shingles) for r in decontaminate.leaks(docs, items).collect()}
    assert want and one == many == want
    kept = {r.doc_id for r in decontaminate.without_leaks(docs, items).collect()}
    assert kept == set(texts) - {w[0] for w in want}


def test_every_short_item_in_a_long_document(spark):
    """Any fifth of the shingles may be missing; the sketch still finds the item."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    items, rows = [], []
    filler = " ".join(word() for _ in range(20_000))
    for j in range(40):
        tokens = [word() for _ in range(rng.randint(5, 60))]
        items.append((j, " ".join(tokens)))
        n = len(tokens) - 4
        drop = int(0.2 * n + 1e-9)
        # words at the end changed: so many shingles are missing
        changed = tokens[: len(tokens) - drop] + [word() for _ in range(drop)]
        rows.append((j, filler + " " + " , ".join(changed).upper() + " " + filler))
        rows.append((100 + j, filler + " " + " ".join(tokens[: len(tokens) - drop - 1]) + " " + filler))
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(j, j) for j in range(40)}


def test_odd_items_and_documents(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "the CAT, sat on"), (2, None), (3, "!!"), (4, "cat"), (None, "dog lay by the door of"), (5, "by the door of the house the end of it")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(odd_docs, items).collect()}
    assert got == {(d, i) for d in (1, 7) for i in (1, 4, None)}
    assert decontaminate.without_leaks(odd_docs, items).count() == odd_docs.count() - 3
    assert decontaminate.leaks(no_docs, items).collect() == [] and decontaminate.leaks(odd_docs, items.where("1 = 0")).collect() == []
    assert decontaminate.without_leaks(odd_docs, items.where("1 = 0")).count() == odd_docs.count()


# ---- fingerprints ------------------------------------------------------------------------------------------------

def test_states_are_sums():
    one, two, both, turned = (fingerprints.states([t]) for t in (b"a b c d\nsecond line", b"third\n\n", b"a b c d\nsecond line\nthird", b"third\nsecond line\na b c d"))
    assert one.add(two).bytes() == both.bytes() == turned.bytes()
    assert both.remove(two).bytes() == one.bytes() != both.bytes()
    assert fingerprints.States.of_bytes(both.bytes()).bytes() == both.bytes()
    assert fingerprints.likeness(both, turned)[0] == 1 and 0 < fingerprints.likeness(one, both)[0] < 1
    # the multiset counts: a line twice is not a line once
    assert fingerprints.states([b"x\nx"]).hex() != fingerprints.states([b"x"]).hex()


def test_edited_and_next(docs, texts):
    ids = sorted(texts)
    got = {r.doc_id: r for r in fingerprints.edited_and_next(docs).collect()}
    prints = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint(docs).collect()}
    assert len(got) == len(ids)
    for i, n in zip(ids, ids[1:] + ids[:1]):
        k = len(texts[i]) // 2
        edited = texts[i][: len(texts[i]) - k] + texts[n][:k]
        own, after, following = (fingerprints.states([t.encode()]) for t in (texts[i], edited, texts[n]))
        row = got[i]
        assert (row.n_chars, row.edited_sha256) == (len(texts[i]), hashlib.sha256(edited.encode()).hexdigest())
        assert row.fingerprint == prints[i] == own.hex()[0] and row.edited_fingerprint == after.hex()[0]
        assert (row.near_edited, row.near_next) == (fingerprints.likeness(own, after)[0], fingerprints.likeness(own, following)[0])


def test_odd_rows_have_fingerprints(spark, odd_docs, no_docs):
    got = fingerprints.edited_and_next(odd_docs).collect()
    assert len(got) == odd_docs.count()
    empty = {r.fingerprint for r in got if r.doc_id in (2, 3, 10)}
    assert len(empty) == 1 and len({r.fingerprint for r in got if r.doc_id in (1, 7)}) == 1
    assert fingerprints.edited_and_next(no_docs).collect() == []
    lone = fingerprints.edited_and_next(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).first()
    assert lone.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and lone.near_next == 1
