"""Language, personal data, toxicity and URL models: brute force, held-out accuracy, odd rows."""

import re
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plotwise.llm import language, pii, toxicity, urls
from plotwise.llm.common import held_out

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


# ---- language ----------------------------------------------------------------------------------------------------

def test_forward_sums_all_segmentations():
    pieces = language.Pieces([b"_", b"_a", b"a", b"ab", b"b", b"bc", "é".encode()])
    p = np.linspace(0.05, 0.2, 8)[:, None]
    words = [b"_abc", b"_a", b"_", "_éba".encode(), b"_ccab"]

    def ways(word):
        if not word:
            return 1.0
        total = sum(p[i, 0] * ways(word[len(x):]) for i, x in enumerate(pieces.pieces) if word.startswith(x))
        first = word.decode()[0].encode()
        return total + (0 if first in pieces.pieces else p[-1, 0] * ways(word[len(first):]))

    got = np.exp(language.Lattice(words, pieces).log_words(p))[:, 0]
    assert np.allclose(got, [ways(w) for w in words])


def test_rounds_raise_the_likelihood():
    pieces = language.Pieces([b"_", b"a", b"b", b"ab", b"_ab"])
    words, counts = [b"_abab", b"_ba", b"_ab"], np.array([5.0, 1.0, 9.0])
    last = -np.inf
    for rounds in range(1, 6):
        p = language.fit_pieces(words, counts, pieces, language.Settings(rounds=rounds, smooth=0.0))
        now = counts @ language.Lattice(words, pieces).log_words(np.append(p, 1e-7)[:, None])[:, 0]
        assert now >= last - 1e-9
        last = now


def test_language_held_out(docs, odd_docs, no_docs):
    model = language.fit(docs.where(~held_out()), PIECES)
    rows = language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(held_out()).collect()
    assert len(rows) > 20 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.97 and all(0 <= r.score <= 1 for r in rows)
    got = {r.doc_id: r for r in language.identify(odd_docs, model).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (2, 3, 5, 10)) and got[None].lang_pred == "fr"
    # another script is none of the learned languages
    assert model.score_texts(pa.array(["これは日本語のテキストです 東京都"]))[1][0] < 0.5
    assert language.identify(no_docs, model).collect() == []
    kept = language.in_known_language(docs, model)
    assert kept.count() == docs.count() and kept.schema == docs.schema
    assert {r.doc_id for r in language.in_known_language(odd_docs, model).collect()} >= {1, 7, None}
    nothing = language.fit(no_docs, PIECES)
    assert {r.lang_pred for r in language.identify(odd_docs, nothing).collect()} == {"und"}


# ---- personal data -----------------------------------------------------------------------------------------------

def slow_base(text):
    out = []
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    for kind, pattern in patterns.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab@.-+ 0123456789()4111é%\n")), max_size=60))
def test_base_spans(text):
    assert pii.base_spans(text) == slow_base(text)


@pytest.mark.parametrize("text", ["4111 1111 1111 1111", "a@b.c.d@e.f", "1.2.3.4.5.6.7.8.9", "300.1.1.1 255.0.0.1", "+1 (017) 555-7713", "+" * 50 + "1" * 40, "00004.0001.2.3"])
def test_base_span_cases(text):
    assert pii.base_spans(text) == slow_base(text)


def test_long_runs_take_linear_time():
    assert pii.base_spans("a" * 300_000 + "@" + "1" * 300_000 + "." * 300_000) == []


@pytest.fixture(scope="module")
def trained():
    return pii.train()


def test_viterbi_is_the_best_path(trained):
    text = "call (504) 555-2652 or joe (at) mail (dot) com now"
    raw = np.frombuffer(text.encode(), np.uint8)
    tokens = pii.Tokens(raw, np.array([0, len(raw)]))
    emit = trained.emissions(tokens.features)[:7]
    best = max(product(range(5), repeat=7), key=lambda y: sum(emit[i, k] for i, k in enumerate(y)) + sum(trained.move[a, b] for a, b in zip(y, y[1:])))
    short = " ".join(text.split()[:7])
    raw = np.frombuffer(short.encode(), np.uint8)
    cut = pii.Tokens(raw, np.array([0, len(raw)]))
    emit = trained.emissions(cut.features)
    best = max(product(range(5), repeat=7), key=lambda y: sum(emit[i, k] for i, k in enumerate(y)) + sum(trained.move[a, b] for a, b in zip(y, y[1:])))
    assert trained.decode(cut).tolist() == list(best)


def test_field_adds_what_patterns_miss(trained):
    cases = ["call (504) 555-2652 or write to joe (at) mail (dot) com today.", "Telefon 0171 555 2652, ISBN 978-3-16-148410-0, version 10.4.2", "In 1998 some 25 of 120 houses", "the quick brown fox at noon"]
    base, every = pii.found_spans(pa.array(cases), trained)
    assert not any(base) and [[(t[a:b], k) for a, b, k in s] for t, s in zip(cases, every)] == [
        [("(504) 555-2652", "phone"), ("joe (at) mail (dot) com", "email")], [("0171 555 2652", "phone")], [], []
    ]


def test_clean_texts_stay_clean(docs, texts, trained):
    _, every = pii.found_spans(pa.array([t for t in texts.values() if not re.search(r"[0-9@]", t)]), trained)
    assert not any(every)


def test_odd_rows_and_masks(odd_docs, no_docs, spark, trained):
    assert pii.find(no_docs, trained).collect() == [] and pii.find(odd_docs, trained).count() == odd_docs.count()
    rows = spark.createDataFrame([(1, "é mail a@b.co, ip 10.0.0.1.", 7), (2, None, None), (3, "clean", 99)], "doc_id long, text string, n_chars int")
    found = {r.doc_id: r for r in pii.find(rows, trained).collect()}
    assert (found[1].n_email, found[1].n_ip, found[1].base) == (1, 1, "email:7:13,ip:18:26") and found[2].spans == ""
    out = {r.doc_id: r for r in pii.without_personal_data(rows, trained).collect()}
    assert out[1].text == "é mail <EMAIL>, ip <IP>." and out[1].n_chars == len(out[1].text) and out[2].text is None and out[3].n_chars == 99
    assert pii.without_personal_data(odd_docs, trained).schema == odd_docs.schema


# ---- toxicity ----------------------------------------------------------------------------------------------------

def test_neighbours_are_exact():
    rng = np.random.default_rng(2)
    n, m = 400, 60
    dense = (rng.random((n, m)) < 0.08) & (rng.random(m) < 0.9)
    rows, columns = np.nonzero(dense)
    own = toxicity.Settings(neighbours=7, block=16)
    model = toxicity.Model(own, np.arange(m, dtype=np.uint64), rng.random(m) + 0.5, np.arange(n), rng.integers(0, 2, n), rows, columns)
    x = dense * model.idf
    x = x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)
    for i in range(0, n, 5):
        at = np.flatnonzero(dense[i])
        if len(at):
            got, cosines = model.nearest(at, x[i, at])
            want = x @ x[i]
            best = np.lexsort((np.arange(n), -np.round(want, 12)))[:7]
            best = best[want[best] > 0]
            assert np.allclose(np.sort(cosines)[::-1], want[best]) and np.allclose(want[got], cosines)


def test_toxic_held_out(spark, odd_docs, no_docs):
    root = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/labels.parquet")
    model = toxicity.fit(docs, labels.where(~held_out()))
    rows = toxicity.score(docs, model).join(labels, "doc_id").where(held_out()).collect()
    good, bad = [r.score for r in rows if r.toxic == 0], [r.score for r in rows if r.toxic == 1]
    assert len(bad) >= 3 and np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good]) > 0.85 and np.mean([g >= 0.5 for g in good]) < 0.05
    got = {r.doc_id: r for r in toxicity.score(odd_docs, model).collect()}
    assert got[2].score == got[3].score == model.empty_rate and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert toxicity.score(no_docs, model).collect() == []
    held = {r.doc_id for r in labels.where(held_out()).collect()}
    assert not held & set(model.ids.tolist())
    nothing = toxicity.fit(docs, labels.where("1 = 0"))
    assert {r.score for r in toxicity.score(odd_docs, nothing).collect()} == {0.0}
    one_class = toxicity.fit(docs, labels.where("toxic = 0"))
    assert max(r.score for r in toxicity.score(docs, one_class).collect()) < 0.5


# ---- urls --------------------------------------------------------------------------------------------------------

def slow_url(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(n + p, v) for n, p, v in urls.RULES if (host == n or host.endswith("." + n)) and path.startswith(p)]
    rule = max(fits, key=lambda x: len(x[0]), default=(None, None))
    return host, path, *rule


def test_rules_and_parts(spark):
    cases = [
        "http://example.net/en/1", "https://a.b.example.net/en", "http://x.net/", "http://x.net", "http://NET/", "http://planet/", "http://x.example.com/de/7?q=/en/", "http://example.com/DE/", "https://w.org/fr/1#top",
        "http://org/fr/", "no url", None, "", "://h/p", "a://b://c/d", "http://h?x=/fr/", "http://h#f", "http://user@ÄB.Org/fr/ü", "http://a/b\nc?d", "http://", "http://myexample.net/en/",
    ]
    pages = spark.createDataFrame([(i, u, "x", None) for i, u in enumerate(cases)], "page_id long, url string, host string, score double")
    model = urls.fit(pages, WORDS)
    rows = {r.page_id: r for r in urls.judge(pages, model).collect()}
    for i, u in enumerate(cases):
        host, path, rule, verdict = slow_url(u)
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, rule), u
        assert rows[i].verdict == (verdict or ("block" if rows[i].score >= 0.5 else "allow"))
    assert urls.judge(pages.where("1 = 0"), urls.fit(pages.where("1 = 0"), WORDS)).collect() == []


def test_segmentation_is_the_cheapest():
    own = urls.Segmenter({"free": 3.0, "bets": 4.0, "be": 2.5, "ts": 9.0, "reef": 1.0, "f": 8.0})
    unknown = max(own.cost.values())

    def ways(run):
        if not run:
            yield 0.0
        for n in range(1, len(run) + 1):
            c = own.cost.get(run[:n], unknown + own.letter * n)
            yield from (c + rest for rest in ways(run[n:]))

    for run in ("freebets", "xfree", "bebe", "zzz", "freezbets"):
        words = own.split(run)
        assert "".join(words) == run and sum(own.cost.get(w, unknown + own.letter * len(w)) for w in words) == pytest.approx(min(ways(run)))


def test_names_are_split_and_judged(spark):
    hosts = ["onlinecasinobonus", "cheappills", "citylibrary", "sciencemuseum", "freebets", "thecityofthewind"] + [f"house{w}" for w in ("red", "blue", "tree", "lake")]
    pages = spark.createDataFrame([(i, f"https://www.{h}.example.com/en/{i}") for i, h in enumerate(hosts)], "page_id long, url string")
    rows = {r.host.split(".")[1]: r for r in urls.judge(pages, urls.fit(pages, WORDS)).collect()}
    assert {h for h, r in rows.items() if r.verdict == "block"} == {"onlinecasinobonus", "cheappills", "freebets"}
    assert "h:city h:library" in rows["citylibrary"].words and "h:cheap h:pills" in rows["cheappills"].words


def test_registered_names_are_judged(spark):
    hosts = ["www.onlinecasino.com", "m.cheappills.net", "onlinecasino.co.uk", "www.freebets.com.au:8080", "www.citylibrary.org", "m.sciencejournal.co.uk"] + [f"www.house{w}.com" for w in ("red", "blue", "tree", "lake")]
    pages = spark.createDataFrame([(i, f"https://{h}/a/{i}") for i, h in enumerate(hosts)], "page_id long, url string")
    rows = {r.host: r for r in urls.judge(pages, urls.fit(pages, WORDS), rules=()).collect()}
    assert {h for h, r in rows.items() if r.verdict == "block"} == set(hosts[:4])
    assert "h:online h:casino" in rows["www.onlinecasino.com"].words and "h:cheap h:pills" in rows["m.cheappills.net"].words
    assert urls.name_labels("shop.name.co.uk") == ["shop", "name"] and urls.name_labels("name.com") == ["name"] and urls.name_labels("localhost") == ["localhost"]
