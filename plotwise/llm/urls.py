"""URL filters: rules on hosts and paths, and naive Bayes over segmented host and path words.

Concatenated host names are split into words by Viterbi over a unigram model: a fixed public vocabulary in the order of
its frequency (Zipf's law gives the probabilities), with a cost for every letter outside it. Words of the host and the
path are the tokens of a multinomial naive Bayes classifier. It starts from a small labelled table of hosts; then every
distinct host of the corpus votes with its own posterior (one step of expectation maximisation), so counts cover all
pages. Tokens are counted in a fixed number of hash slots: the model has the same size for any corpus.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from plotwise.llm.common import chunks

#: (host, path, verdict); the longest text of host and path wins.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

# A small labelled table of hosts, as words.
UNWANTED = (
    "casino win, free casino, online casino bonus, best bets, free bets, sports betting odds, poker slots, jackpot lottery win, spam farm, link farm, mail spam, ads track, "
    "ad tracker, click tracking, banner ads, popup ads, adult x, adult video, xxx cams, porn tube, sex chat, hot dating, escort girls, cheap pills, cheap pharmacy, viagra pills, "
    "replica watches cheap, payday loans, fast cash loans, crack keygen, warez download, torrent crack, malware host, phishing login, fake prize win, weight loss pills, "
    "bonus bets, casino games, betting tips, free xxx, adult dating, spam mail"
).split(", ")
WANTED = (
    "city library, news today, the times, open source, state university, school board, science journal, health service, weather report, travel guide, cooking recipes, "
    "history museum, art gallery, music festival, football club, garden plants, public transport, book store, data portal, help center, user forum, code review, film review, "
    "local news, research institute, national park, family doctor, language course, photo archive, radio station, web design, company blog, wiki project, free software, "
    "free library, track record, win together, cheap flights, video lessons, online course, games review, chat support, mail service, fast trains, hot springs, farm shop"
).split(", ")

#: Labels under which countries register names (co.uk, com.au, ...).
SECOND_LEVELS = frozenset("ac co com edu gob gouv gov ltd me mil ne net nhs nom or org plc sch".split())


@dataclass(frozen=True)
class Settings:
    slots: int = 1 << 18  # hash slots of tokens
    prior: float = 0.1  # share of unwanted hosts that is expected
    seed_weight: float = 4.0  # hosts' worth of a labelled host
    smooth: float = 0.5
    trust: float = 50.0  # words of a class in the corpus that weigh half of the labelled table
    rank_shift: float = 10.0  # of Zipf's law
    letter: float = 4.0  # cost of a letter outside the vocabulary, beside that of a new word


# ---- parts and rules, as columns ---------------------------------------------------------------------------------

def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty if there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end; empty if there is no host part."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule's text (ties: the first by text) and its verdict; null if none fits."""
    text = verdict = F.lit(None).cast("string")
    for name, prefix, what in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]), reverse=True):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        text = F.when(fits, F.lit(name + prefix)).otherwise(text)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return text, verdict


# ---- words -------------------------------------------------------------------------------------------------------

def lexicon(path: str, settings: Settings = Settings()) -> dict[str, float]:
    """Cost (negative log probability) of each whole word of a BPE vocabulary with word ends, by its rank, and of the labelled hosts' words."""
    with open(path, encoding="utf-8") as file:
        vocab = json.load(file)["model"]["vocab"]
    words = [w[:-4] for w, _ in sorted(vocab.items(), key=lambda x: x[1]) if w.endswith("</w>") and w[:-4].isascii() and w[:-4].isalpha()]
    words = [w for w in words if len(w) > 1 or w in ("a", "i", "x")]
    total = sum(1 / (r + settings.rank_shift) for r in range(len(words)))
    cost = {w: log(total) + log(r + settings.rank_shift) for r, w in enumerate(words)}
    middle = log(total) + log(2000 + settings.rank_shift)
    for w in {w for line in UNWANTED + WANTED for w in line.split()}:
        cost[w] = min(cost.get(w, middle), middle)
    return cost


@dataclass
class Segmenter:
    """Splits runs of letters into words by the cheapest way through them."""

    cost: dict[str, float]
    letter: float = 4.0
    longest: int = 24
    kept: dict[str, list[str]] = field(default_factory=dict)

    def split(self, run: str) -> list[str]:
        """The words of a run; runs of unknown letters between them stay together. Equal costs: the longer last word."""
        if run in self.kept:
            return self.kept[run]
        n = len(run)
        best, back = [0.0] + [float("inf")] * n, [(0, False)] * (n + 1)
        unknown = max(self.cost.values(), default=0.0)
        for end in range(1, n + 1):
            for start in range(max(0, end - self.longest), end):
                known = self.cost.get(run[start:end])
                c = best[start] + (known if known is not None else unknown + self.letter * (end - start))
                if c < best[end] - 1e-12:
                    best[end], back[end] = c, (start, known is not None)
        words, end = [], n
        while end:
            words.append(run[back[end][0] : end])
            end = back[end][0]
        words.reverse()
        if len(self.kept) >= 100_000:
            self.kept.clear()
        self.kept[run] = words
        return words

    def words(self, text: str) -> list[str]:
        """Words of a host or path: runs of ASCII letters split up; digits as one ``#``; other letters' runs whole."""
        out = []
        for run in re.findall(r"[a-z]+|[0-9]+|[^\W_a-z0-9]+", text.lower()):
            out += ["#"] if run[0] in "0123456789" else self.split(run) if run.isascii() else [run]
        return out


def name_labels(host: str) -> list[str]:
    """All labels of a host but its public suffix (the last label, and a known second level before a country's); an only label stays, and an IPv4 address is whole. Port and user are left out."""
    host = host.rpartition("@")[2].partition(":")[0]
    labels = [x for x in host.split(".") if x]
    if len(labels) == 4 and all(x.isdecimal() for x in labels):
        return labels
    second = len(labels) > 2 and len(labels[-1]) == 2 and labels[-2] in SECOND_LEVELS
    return labels[: -2 if second else -1] or labels


def tokens(segmenter: Segmenter, host: str, path: str) -> list[str]:
    """Marked words: the host's name (its labels without the public suffix), and the path's."""
    name = name_labels(host)
    return ["h:" + w for x in name for w in segmenter.words(x)] + ["p:" + w for w in segmenter.words(path)]


def slots(words: list[str], size: int) -> list[int]:
    return [xxh64_intdigest(w.encode(), 7) % size for w in words]


# ---- naive Bayes -------------------------------------------------------------------------------------------------

@dataclass
class Model:
    segmenter: Segmenter
    settings: Settings
    counts: np.ndarray  # (2, slots): wanted, unwanted

    def __post_init__(self):
        # smoothing over the slots in use, so that unknown words weigh the same in both classes
        used = max(1, int((self.counts.sum(axis=0) > 0).sum()))
        s = self.settings
        self.logs = np.log(self.counts + s.smooth) - np.log(self.counts.sum(axis=1, keepdims=True) + s.smooth * used)

    def score(self, host: str, path: str) -> float:
        """Posterior of unwanted; words that neither class has seen say nothing."""
        at = [i for i in slots(tokens(self.segmenter, host, path), self.settings.slots) if self.counts[0, i] + self.counts[1, i] > 0]
        gap = float((self.logs[1, at] - self.logs[0, at]).sum()) + log(self.settings.prior / (1 - self.settings.prior))
        return 1 / (1 + np.exp(-min(max(gap, -30.0), 30.0)))


def seed_counts(segmenter: Segmenter, settings: Settings) -> np.ndarray:
    counts = np.zeros((2, settings.slots))
    for k, lines in enumerate((WANTED, UNWANTED)):
        for line in lines:
            for i in slots(["h:" + w for w in line.split()], settings.slots):
                counts[k, i] += settings.seed_weight
    return counts


def fit(pages: DataFrame, vocabulary: str, settings: Settings = Settings(), url_col: str = "url") -> Model:
    """The classifier: labelled hosts, then the posterior-weighted words of every distinct host of ``pages`` with its paths' words."""
    spark = pages.sparkSession
    segmenter = Segmenter(lexicon(vocabulary, settings), settings.letter)
    seeds = Model(segmenter, settings, seed_counts(segmenter, settings))
    shared = spark.sparkContext.broadcast(seeds)  # bounded by the vocabulary and the slots
    url = F.col(url_col).cast("string")
    # a host counts once for each shape of its paths (numbers as one), so one hot host can't outvote the others
    shape = F.regexp_replace(path_of(url), "[0-9]+", "0")
    hosts = pages.select(host_of(url).alias("host"), shape.alias("path")).where("host != ''").distinct()

    def count(batches):
        total = np.zeros((2, settings.slots))
        for batch in batches:
            model = shared.value
            for host, path in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist()):
                p = model.score(host, "")
                for i in slots(tokens(model.segmenter, host, path), settings.slots):
                    total[0, i] += 1 - p
                    total[1, i] += p
        used = np.flatnonzero(total.sum(axis=0))
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[0, used]), pa.array(total[1, used])], ["slot", "wanted", "unwanted"])

    rows = hosts.mapInArrow(count, "slot long, wanted double, unwanted double").groupBy("slot").agg(F.sum("wanted").alias("wanted"), F.sum("unwanted").alias("unwanted")).toPandas()
    # Each class's words are shares of that class, as unwanted hosts are few: the corpus weighs as much as the labelled
    # table, and less while either class has seen little of it.
    counts, totals = seeds.counts.copy(), [float(rows[name].sum()) for name in ("wanted", "unwanted")]
    least = min(totals)
    for k, name in enumerate(("wanted", "unwanted")):
        if least > 0:
            weight = seeds.counts[k].sum() / totals[k] * least / (least + settings.trust)
            # rounded, as sums of doubles depend on the order of the tasks
            np.add.at(counts[k], rows["slot"].to_numpy(), np.round(rows[name].to_numpy() * weight, 6))
    return Model(segmenter, settings, counts)


def judge(pages: DataFrame, model: Model, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict (allow or block), score (posterior of unwanted) and words of every url.

    A rule decides where one fits, else the classifier (block from 0.5). Null urls and those without ``://`` have empty
    host and path, no words and the prior as score. Repeated rows are judged each; an empty table gives no row; only the
    id and the url are read.
    """
    own = pages.sparkSession.sparkContext.broadcast(model)
    url = F.col(url_col).cast("string")
    parts = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)

    def run(batches):
        for batch in chunks(batches, "path"):
            m = own.value
            pairs = list(zip(batch.column("host").to_pylist(), batch.column("path").to_pylist()))
            words = [" ".join(tokens(m.segmenter, h, p)) for h, p in pairs]
            scores = [m.score(h, p) for h, p in pairs]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array(words, pa.string())], [*batch.schema.names, "score", "words"])

    scored = parts.select("*", text.alias("rule"), verdict.alias("by_rule")).mapInArrow(run, "page_id long, host string, path string, rule string, by_rule string, score double, words string")
    by_method = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_method).alias("verdict"), "score", "words")
