"""Queries of the operators over the given tables, each with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotwise.sources.readers import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def query(name: str, sql: str | None = None):
    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return wrap


@query("op1_token_files")
def token_files(spark: SparkSession, root: str) -> DataFrame:
    from plotwise.llm.tokenfile import read_digests, write_tokens

    path = write_tokens(table(spark, root, "documents"), BYTE_BPE, end_id=2)
    return read_digests(spark, path)


@query("op8_best_fit_packing")
def best_fit_packing(spark: SparkSession, root: str) -> DataFrame:
    from plotwise.llm.packing import pack

    return pack(table(spark, root, "documents"), BYTE_BPE, end_id=0)


@query("op4_multiset_fingerprints")
def multiset_fingerprints(spark: SparkSession, root: str) -> DataFrame:
    from plotwise.llm.fingerprints import edited_and_next

    return edited_and_next(table(spark, root, "documents"))


@query("op7_simhash_components")
def simhash_components(spark: SparkSession, root: str) -> DataFrame:
    from plotwise.llm.simhash import near_duplicates

    rows = near_duplicates(table(spark, root, "documents"), bits=4, words=4)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


_CAPITALS, _SMALL_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS_SQL = f"regexp_extract_all(translate(text, '{_CAPITALS}', '{_SMALL_LETTERS}'), '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+')"


@query("op2_benchmark_leaks", f"""
WITH items AS (SELECT item_id, w, least(5, len(w)) AS s FROM (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark) WHERE len(w) > 0),
item_runs AS (SELECT DISTINCT item_id, s, array_to_string(w[i : i + s - 1], ' ') AS run FROM (SELECT item_id, w, s, unnest(range(1, len(w) - s + 2)) AS i FROM items)),
sizes AS (SELECT item_id, COUNT(*) AS shingles FROM item_runs GROUP BY item_id),
docs AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
doc_runs AS (SELECT DISTINCT doc_id, s, array_to_string(w[i : i + s - 1], ' ') AS run
 FROM (SELECT doc_id, w, s, unnest(range(1, len(w) - s + 2)) AS i FROM docs CROSS JOIN (SELECT DISTINCT s FROM items))),
met AS (SELECT doc_id, item_id, COUNT(*) AS shared FROM doc_runs JOIN item_runs USING (s, run) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, shared, shingles, shared / CAST(shingles AS DOUBLE) AS containment FROM met JOIN sizes USING (item_id) WHERE shared * 5 >= shingles * 4
""")
def benchmark_leaks(spark: SparkSession, root: str) -> DataFrame:
    from plotwise.llm.decontaminate import leaks

    return leaks(table(spark, root, "documents"), table(spark, root, "benchmark"))


@query("op9_toxic_neighbours")
def toxic_neighbours(spark: SparkSession, root: str) -> DataFrame:
    from plotwise.llm.common import held_out
    from plotwise.llm.toxicity import fit, score

    docs, labels = table(spark, root, "documents"), table(spark, root, "labels")
    model = fit(docs, labels.where(~held_out()))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted", "evidence", "cosines")


PIECES = public_tokenizers.path("piece_bpe_32k.model")


@query("op3_language")
def language(spark: SparkSession, root: str) -> DataFrame:
    from plotwise.llm.common import held_out
    from plotwise.llm.language import fit, identify

    docs = table(spark, root, "documents")
    model = fit(docs.where(~held_out()), PIECES)
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query("op5_personal_data")
def personal_data(spark: SparkSession, root: str) -> DataFrame:
    from plotwise.llm.pii import find

    rows = find(table(spark, root, "documents"))
    return rows.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


@query("op6_perspectives", """
WITH said AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS number FROM
 (SELECT conv_id, COALESCE(turn, 0) AS turn, COALESCE(role, 'unknown') AS role, COALESCE(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM said WHERE role != 'system'),
each AS (SELECT s.conv_id, speaker, number // 64 AS part, number, role, text, CASE WHEN role = 'system' THEN '<|system|>' WHEN role = speaker THEN '<|assistant|>' ELSE '<|user name=' || role || '|>' END AS head
 FROM said s JOIN speakers p ON s.conv_id = p.conv_id),
placed AS (SELECT *, head || text || '<|end|>' || chr(10) AS piece, COALESCE(SUM(length(head || text || '<|end|>' || chr(10))) OVER (PARTITION BY conv_id, speaker, part ORDER BY number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS begins FROM each)
SELECT conv_id, speaker, part, COUNT(*) AS n_turns, COUNT(CASE WHEN role = speaker THEN 1 END) AS n_trained, string_agg(piece, '' ORDER BY number) AS rendered,
 COALESCE(string_agg(CASE WHEN role = speaker THEN CAST(begins AS BIGINT) || ':' || CAST(begins + length(text) AS BIGINT) END, ',' ORDER BY number), '') AS mask FROM placed GROUP BY conv_id, speaker, part
""")
def perspectives(spark: SparkSession, root: str) -> DataFrame:
    from plotwise.llm.chat import rotate

    return rotate(table(spark, root, "conversations"))


WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@query("op10_url_verdicts")
def url_verdicts(spark: SparkSession, root: str) -> DataFrame:
    from plotwise.llm.urls import fit, judge

    pages = table(spark, root, "pages")
    return judge(pages, fit(pages, WORD_BPE))


def _license_sql() -> str:
    """The same votes from runs of words themselves: templates as rows, diagonals, bands, covered words."""
    from plotwise.llm.licenses import NOTICES, PHRASES, RUN

    rows = ", ".join(f"({i}, '{t.label}', {t.share}, {t.drift}, {str(t.base).lower()}, '{t.text}')" for i, t in enumerate(PHRASES + NOTICES))
    letters = f"translate(text, '{_CAPITALS}', '{_SMALL_LETTERS}')"
    return f"""
WITH templates(template, label, share, drift, base, text) AS (VALUES {rows}),
wanted AS (SELECT template, label, share, drift, base, regexp_extract_all({letters}, '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM templates),
grams AS (SELECT template, label, share, drift, base, len(w) AS size, unnest(range(len(w) - {RUN - 1})) AS t, unnest(list_transform(range(1, len(w) - {RUN - 2}), lambda i: w[i : i + {RUN - 1}])) AS run FROM wanted),
docs AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
doc_runs AS (SELECT doc_id, unnest(range(len(w) - {RUN - 1})) AS p, unnest(list_transform(range(1, len(w) - {RUN - 2}), lambda i: w[i : i + {RUN - 1}])) AS run FROM docs WHERE len(w) >= {RUN}),
votes AS (SELECT doc_id, template, label, share, drift, base, size, t, p - t AS diagonal FROM doc_runs JOIN grams USING (run)),
banded AS (SELECT *, unnest(CASE WHEN drift > 0 THEN [CAST(floor(diagonal / (2 * drift)) AS BIGINT) * 2, CAST(floor((diagonal + drift) / (2 * drift)) AS BIGINT) * 2 + 1] ELSE [diagonal] END) AS band FROM votes),
met AS (SELECT doc_id, template, label, share, base, size, band, MIN(diagonal + t) AS first_word,
 len(list_distinct(flatten(list(range(t, t + {RUN}))))) / CAST(size AS DOUBLE) AS covered FROM banded GROUP BY doc_id, template, label, share, base, size, band),
found AS (SELECT doc_id, label, base, first_word, covered, covered >= share AS found FROM met),
by_doc AS (SELECT doc_id, COUNT(*) FILTER (found AND base) AS n_base, MIN(first_word) FILTER (found AND base) AS first_word, MAX(first_word) FILTER (found AND base) AS last_word,
 string_agg(DISTINCT label, ',' ORDER BY label) FILTER (found AND base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (found) AS labels, MAX(covered) AS score FROM found GROUP BY doc_id)
SELECT doc_id, COALESCE(len(w), 0) AS n_words, COALESCE(n_base, 0) AS n_base, first_word, last_word, COALESCE(base_labels, '') AS base_labels, COALESCE(labels, '') AS labels, COALESCE(score, 0) AS score
FROM docs LEFT JOIN by_doc USING (doc_id)
"""


@query("op13_license_spans", _license_sql())
def license_spans(spark: SparkSession, root: str) -> DataFrame:
    from plotwise.llm.licenses import scan

    return scan(table(spark, root, "documents"))


def _codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Assignments and means of each round as tables of their own; doubles hold these integers exactly."""

    def nearest(books: str) -> str:
        return f"""SELECT vec_id, label, p, x, MIN([xx - 2 * list_inner_product(x, y) + yy, e]) AS best
 FROM points JOIN (SELECT p, e, y, list_inner_product(y, y) AS yy FROM {books}) USING (p) GROUP BY vec_id, label, p, x"""

    steps = [
        "kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"points AS MATERIALIZED (SELECT *, list_inner_product(x, x) AS xx FROM (SELECT vec_id, label, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS x FROM kept CROSS JOIN range({parts}) r(p)))",
        f"books0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS y FROM points QUALIFY e < {entries})",
    ]
    for r in range(rounds):
        steps.append(f"near{r} AS MATERIALIZED ({nearest(f'books{r}')})")
        steps.append(f"""means{r} AS (SELECT p, e, list(floor(s / n) ORDER BY i) AS y FROM
 (SELECT p, e, i, SUM(c) AS s, COUNT(*) AS n FROM (SELECT p, best[2] AS e, unnest(x) AS c, unnest(range(len(x))) AS i FROM near{r}) GROUP BY p, e, i) GROUP BY p, e)""")
        steps.append(f"books{r + 1} AS MATERIALIZED (SELECT p, b.e, COALESCE(m.y, b.y) AS y FROM books{r} b LEFT JOIN means{r} m USING (p, e))")
    last = f"books{rounds}"
    steps.append(f"coded AS (SELECT vec_id, label, string_agg(printf('%02x', CAST(best[2] AS BIGINT)), '' ORDER BY p) AS code, CAST(SUM(best[1]) AS BIGINT) AS error FROM ({nearest(last)}) GROUP BY vec_id, label)")
    joined = ",\n".join(steps)
    return f"""
WITH {joined}
SELECT vec_id, code, error, CAST(SUM(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
 (SELECT sha256(string_agg(CAST(CAST(c AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) FROM (SELECT p, e, unnest(y) AS c, unnest(range(len(y))) AS i FROM {last})) AS codebooks_sha256 FROM coded
"""


@query("op12_vector_codes", _codes_sql())
def vector_codes(spark: SparkSession, root: str) -> DataFrame:
    from plotwise.llm.codebooks import compress

    return compress(table(spark, root, "embeddings")).drop("label")


@query("op11_ranked_search", f"""
WITH docs AS (SELECT * FROM (SELECT doc_id, {_WORDS_SQL} AS w FROM documents) WHERE len(w) > 0),
totals AS (SELECT COUNT(*) AS n_docs, CAST(SUM(len(w)) AS BIGINT) AS n_terms FROM docs),
asked AS (SELECT item_id, term, COUNT(*) AS k FROM (SELECT item_id, unnest({_WORDS_SQL}) AS term FROM benchmark) GROUP BY item_id, term),
tf AS (SELECT doc_id, n, term, COUNT(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM docs) WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, n, term),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * COUNT(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf CROSS JOIN totals GROUP BY term, n_docs),
parts AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))) AS part FROM tf JOIN weights USING (term) CROSS JOIN totals),
scores AS (SELECT item_id, doc_id, CAST(SUM(k * part) AS BIGINT) AS score FROM asked JOIN parts USING (term) GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scores WHERE score > 0 QUALIFY rank <= 20
""")
def ranked_search(spark: SparkSession, root: str) -> DataFrame:
    from plotwise.llm.lexical import rank

    return rank(table(spark, root, "documents"), table(spark, root, "benchmark"))
