"""Token files and packing against the tokenizer itself."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from plotwise.llm.packing import Limits, best_fit, pack
from plotwise.llm.tokenfile import Codebook, _shifted, code_lengths, read_digests, read_tokens, write_tokens
from plotwise.llm.tokens import BatchEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    own = Tokenizer.from_file(PATH)
    own.encode_special_tokens = True
    return own


@pytest.fixture(scope="module")
def encoder():
    return BatchEncoder(PATH)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab Z'sé\n\t.,-_19ß  日×÷ \x1c")), max_size=30), max_size=6))
def test_units_are_the_tokenizers(tokenizer, encoder, some):
    ids, bounds = encoder.encode(pa.array(some, pa.string()))
    for i, t in enumerate(some):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_special_strings_and_nulls(tokenizer, encoder):
    some = ["a<|endoftext|>b", None, "", "I'm here, it's 'sfine"]
    ids, bounds = encoder.encode(pa.array(some))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in some]


def test_code_lengths_are_optimal_and_limited():
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144])
    free, tight = code_lengths(counts, 30), code_lengths(counts, 5)
    assert free.max() == 11 and tight.max() <= 5
    assert sum(2.0**-x for x in free) == 1 and sum(2.0**-x for x in tight) <= 1
    assert code_lengths(np.array([7])).tolist() == [1] and len(code_lengths(np.zeros(0))) == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 700), min_size=1, max_size=1500), st.integers(0, 3))
def test_codes_round_trip(ids, gaps):
    ids = np.array(ids, np.uint32)
    used, counts = np.unique(ids, return_counts=True)
    book = Codebook(used, code_lengths(counts, 12))
    bounds = np.unique(np.append(np.linspace(0, len(ids), gaps + 2).astype(int), [0, len(ids)]))
    data, byte_bounds, marks, mark_bounds = book.encode(ids, bounds)
    starts = marks + np.repeat(byte_bounds[:-1] * 8, np.diff(mark_bounds))
    sizes = np.diff(bounds)
    lanes = np.concatenate([np.append(np.full((n - 1) // 256, 256), (n - 1) % 256 + 1) for n in sizes]).astype(np.int64)
    assert book.decode(data, starts, lanes).tolist() == ids.tolist()


def test_checksums_of_pieces_join():
    raw = bytes(range(256)) * 9
    assert _shifted(zlib.crc32(raw[:700]), len(raw) - 700) ^ zlib.crc32(raw[700:]) == zlib.crc32(raw)


def _expected(tokenizer, texts, end):
    place, out = 0, {}
    for i in sorted(texts):
        ids = np.array(tokenizer.encode(texts[i] or "", add_special_tokens=False).ids + [end], "<u4")
        out[i] = (place, len(ids), zlib.crc32(ids.tobytes()), ids)
        place += len(ids)
    return out


def test_files_hold_all_ids(spark, docs, texts, tokenizer, monkeypatch):
    from plotwise.llm import tokenfile

    path = write_tokens(docs, PATH, 2)
    want = _expected(tokenizer, texts, 2)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in read_digests(spark, path).collect()} == {i: x[:3] for i, x in want.items()}
    pieces = read_tokens(spark, path).orderBy("start").collect()
    assert [i for p in pieces for i in p.ids] == [int(t) for i in sorted(want) for t in want[i][3]]
    assert all(p.start == want[p.doc_id][0] + p["from"] for p in pieces)
    assert tokenfile.BLOCK == 1 << 16


def test_odd_rows_in_files(spark, odd_docs, no_docs, tokenizer):
    rows = read_digests(spark, write_tokens(odd_docs, PATH, 2)).collect()
    assert len(rows) == odd_docs.count()
    got = {r.doc_id: r for r in rows}
    assert got[2].n_tokens == got[3].n_tokens == 1 and got[None].start == 0
    ids = np.array(tokenizer.encode(odd_docs.where("doc_id = 4").first().text, add_special_tokens=False).ids + [2], "<u4")
    assert got[4].n_tokens == len(ids) and got[4].ids_crc32 == zlib.crc32(ids.tobytes())
    assert read_digests(spark, write_tokens(no_docs, PATH, 2)).collect() == []


def test_long_documents_cross_blocks(spark, tokenizer):
    text = "a b c d e f g h " * 12000
    docs = spark.createDataFrame([(1, text), (2, "z")], "doc_id long, text string")
    got = {r.doc_id: r for r in read_digests(spark, write_tokens(docs, PATH, 2)).collect()}
    ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [2], "<u4")
    assert len(ids) > 1 << 16 and (got[1].n_tokens, got[1].ids_crc32, got[2].start) == (len(ids), zlib.crc32(ids.tobytes()), len(ids))


# ---- packing -----------------------------------------------------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=80), st.sampled_from(["norm", "dot"]), st.integers(2, 6))
def test_every_constraint_holds(lengths, rule, documents):
    limits = Limits(tokens=100, documents=documents, attention=10_000, rule=rule)
    lengths = np.array(lengths)
    sequence, offset = best_fit(lengths, limits)
    for s in np.unique(sequence):
        mine = np.flatnonzero(sequence == s)
        mine = mine[np.argsort(offset[mine])]
        assert lengths[mine].sum() <= 100 and len(mine) <= documents and (lengths[mine] ** 2).sum() <= 10_000
        assert offset[mine].tolist() == [0, *np.cumsum(lengths[mine])[:-1]]


def test_best_fit_is_no_worse_than_decreasing_scan():
    lengths = np.random.default_rng(1).integers(1, 2048, 3000)
    sequence, _ = best_fit(lengths, Limits())
    bins: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [(b - n, i) for i, b in enumerate(bins) if b >= n]
        if fits:
            bins[min(fits)[1]] -= n
        else:
            bins.append(2048 - n)
    assert len(np.unique(sequence)) <= len(bins)


def test_pack_covers_all_documents(docs, texts, odd_docs, no_docs, tokenizer):
    want = _expected(tokenizer, texts, 0)
    rows = pack(docs, PATH, 0).toPandas()
    assert rows.groupby("sequence_id")["length"].sum().max() <= 2048
    for i, mine in rows.sort_values("piece").groupby("doc_id"):
        ids = want[i][3]
        assert mine.length.sum() == len(ids) and (mine.length.iloc[1:] == 2048).all() and len(mine) == -(-len(ids) // 2048)
        assert all(zlib.crc32(ids[s : s + n].tobytes()) == c for s, n, c in zip(mine.start, mine.length, mine.ids_crc32))
    for _, mine in rows.sort_values("offset").groupby("sequence_id"):
        assert mine.offset.tolist() == [0, *mine.length.cumsum()[:-1]]
    odd = pack(odd_docs, PATH, 0).toPandas()
    assert (odd.doc_id == 7).sum() == 2 and odd[odd.doc_id == 2].length.tolist() == [1] and odd.doc_id.isna().sum() == 1
    assert pack(no_docs, PATH, 0).collect() == []
    with pytest.raises(ValueError):
        pack(docs, PATH, 0, Limits(tokens=10, attention=50))


# ---- added tokens ------------------------------------------------------------------------------------------------

@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", " ", "  ", "\n", "a", " b", "'s", ".", "é", "\u3000", "7"]), max_size=12).map("".join), max_size=6))
def test_added_tokens_are_the_librarys(some):
    ids, bounds = tokens_of().encode(pa.array(some, pa.string()))
    untouched = Tokenizer.from_file(PATH)
    for i, t in enumerate(some):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == untouched.encode(t, add_special_tokens=False).ids


def tokens_of():
    from plotwise.llm.tokens import encoder

    return encoder(PATH)


def test_pieces_and_files_hold_added_tokens(spark):
    docs = spark.createDataFrame([(1, "a<|endoftext|>b"), (2, "c")], "doc_id long, text string")
    rows = {r.doc_id: r for r in read_digests(spark, write_tokens(docs, PATH, end_id=2)).collect()}
    assert (rows[1].n_tokens, rows[1].ids_crc32) == (4, zlib.crc32(np.array([64, 50256, 65, 2], "<u4").tobytes()))
    assert tokens_of().encode(pa.array(["a<|endoftext|>b"]))[0].tolist() == [64, 50256, 65]
