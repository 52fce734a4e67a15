"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caremart.llm import (
    chunks,
    divergence,
    fertility,
    interaction,
    language,
    lines,
    minhash,
    mixing,
    packing,
    pivots,
    suffixes,
    topk,
    toxicity,
)
from caremart.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that stand on ten sites or more."""
    out = lines.flagged(table(spark, sf_dir, "documents"), min_sites=10, min_chars=10, suspect_share=0.5)
    return out.select("row.doc_id", "n_lines", "n_removed", F.col("clean_text").alias("text"))


def op2_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the chunks that an earlier place has."""
    return chunks.dedup(table(spark, sf_dir, "documents"), min_run=chunks.LEAST)


def op6_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of four-word shingles overlap by 80 percent."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading of every document under the mix of the pipeline."""
    out = mixing.readings(table(spark, sf_dir, "documents"), mixing.Mix())
    return out.select("row.doc_id", "row.source", mixing.tokens(F.col("row.text")).alias("n_tokens"), "block", "epoch", "block_key")


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best partners of every fiftieth vector among all other vectors."""
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5, scale=256)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public tokenizer file; installed beside Python on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op5_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens, one row a piece."""
    out = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=1, length=2048)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def _remainder(divisor: int, column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string")) % divisor


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main language of every document, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    model = language.learn(docs, _remainder(4) != 2)
    held_out = F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out")
    return language.predict(docs, model).select("doc_id", held_out, "lang_pred", "score", "languages", "shares")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from two thirds of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    weights = toxicity.learn(docs, table(spark, sf_dir, "labels"), _remainder(3, "id") != 1)
    held_out = F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out")
    return toxicity.scored(docs, weights).select(
        "doc_id", held_out, "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "sentences")


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.98 or more within a label, as counts and components."""
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 50-byte strings that a smaller document has."""
    out = suffixes.dedup(table(spark, sf_dir, "documents"), length=50)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op11_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes at each step of each order, by language."""
    return interaction.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of a language use its words differently, and the words each overuses most."""
    return divergence.audit(table(spark, sf_dir, "documents"), min_docs=10, top=10)


def op13_tokenizer_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its base counts and the verdict of the fertility bands."""
    import public_tokenizers

    out = fertility.judged(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), tokenizer_path("byte_bpe_50k.tiktoken"),
                           public_tokenizers.PATTERN)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                      *fertility.MEASURES, "outside")


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_line_dedup, op2_chunk_dedup, op3_source_mixing, op4_exact_topk, op5_curve_packing,
                                   op6_minmax_near_dedup, op7_language_id, op8_embedding_near_dedup, op9_toxicity, op10_suffix_dedup,
                                   op11_filter_interaction, op12_source_divergence, op13_tokenizer_fertility)}


_OP1 = """
WITH pages AS (SELECT text, arg_min(source, md5(source || '|' || md5(text))) AS site FROM documents
    WHERE source IS NOT NULL AND text IS NOT NULL GROUP BY text),
bare AS (SELECT text, site, trim(unnest(string_split(text, chr(10))), ' ' || chr(9) || chr(13)) AS line FROM pages),
counted AS (SELECT * FROM bare WHERE length(line) >= 10),
often AS (SELECT line FROM counted GROUP BY line HAVING count(DISTINCT site) >= 10),
hits AS (SELECT text, line, sum(length(line)) AS n FROM counted SEMI JOIN often USING (line) GROUP BY ALL),
mostly AS (SELECT text FROM hits GROUP BY text HAVING sum(n) > 0.5 * length(text)),
held AS (SELECT * FROM hits SEMI JOIN mostly USING (text)),
centres AS (SELECT line, arg_min(text, md5(text)) AS centre FROM held GROUP BY line),
shared AS (SELECT text, centre, sum(n) AS n FROM held JOIN centres USING (line) WHERE text <> centre GROUP BY ALL),
likely AS (SELECT text, arg_max(centre, (n, md5(centre))) AS centre FROM shared GROUP BY text),
copies AS (SELECT h.text FROM held h JOIN likely l ON h.text = l.text JOIN held o ON o.text = l.centre AND o.line = h.line
    GROUP BY h.text, l.centre HAVING sum(least(h.n, o.n)) >= 0.8 * greatest(length(h.text), length(l.centre))),
wide AS (SELECT line FROM counted ANTI JOIN copies USING (text) GROUP BY line HAVING count(DISTINCT site) >= 10),
bad AS (SELECT coalesce(list(line), []) AS bad FROM wide),
cut AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines, list_filter(string_split(text, chr(10)),
        lambda x: NOT list_contains(bad, trim(x, ' ' || chr(9) || chr(13)))) AS kept FROM documents, bad)
SELECT doc_id, CAST(coalesce(len(lines), 0) AS INTEGER) AS n_lines, CAST(coalesce(len(lines) - len(kept), 0) AS INTEGER) AS n_removed,
       array_to_string(kept, chr(10)) AS text
FROM cut
"""

_OP3 = r"""
WITH RECURSIVE t AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS digits FROM documents),
s AS (SELECT source, CAST(sum(n) AS BIGINT) AS tokens, CAST(sum(n) AS DOUBLE) / (SELECT sum(n) FROM t) AS share FROM t GROUP BY source),
p AS (SELECT list(share) AS p, max(share) AS most, min(share) AS least, count(*) AS n FROM s WHERE tokens > 0),
aim AS (SELECT *, h + 0.25 * (ln(n) - h) AS target FROM (SELECT *, -list_sum(list_transform(p, lambda x: x * ln(x))) AS h FROM p)),
bisect AS (SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high UNION ALL
    SELECT step + 1, CASE WHEN met THEN low ELSE mid END, CASE WHEN met THEN mid ELSE high END FROM (
        SELECT step, low, high, mid, ln(z) - mid * y / z <= target AND pow(most / least, 1 - mid) <= 2.0 AS met FROM (
            SELECT step, low, high, (low + high) / 2 AS mid, target, most, least,
                list_sum(list_transform(p, lambda x: pow(x, (low + high) / 2))) AS z,
                list_sum(list_transform(p, lambda x: pow(x, (low + high) / 2) * ln(x))) AS y
            FROM bisect, aim WHERE step < 24))),
found AS (SELECT round(high, 6) AS a FROM bisect WHERE step = 24),
passes AS (SELECT source, tokens, CASE WHEN tokens > 0 THEN pow(most / share, 1 - a) ELSE 1 END AS passes,
    CAST(greatest(64, ceil(tokens / 65536)) AS BIGINT) AS blocks FROM s, p, found),
wanted AS (SELECT *, CAST(floor(passes + 1e-9) AS INTEGER) AS epochs,
    floor((passes - floor(passes + 1e-9)) * tokens + 0.5) AS rest FROM passes),
placed AS (SELECT t.*, w.epochs, w.rest, t.digits % w.blocks AS block FROM t JOIN wanted w ON t.source IS NOT DISTINCT FROM w.source),
keyed AS (SELECT *, md5(concat_ws('|', coalesce(source, ''), block, epochs, 42)) AS key FROM placed),
running AS (SELECT source, key, sum(sum(n)) OVER (PARTITION BY source ORDER BY key) AS cum, any_value(rest) AS rest
    FROM keyed GROUP BY source, key),
bars AS (SELECT source, max(key) AS bar FROM running WHERE cum <= rest AND rest > 0 GROUP BY source),
times AS (SELECT k.*, k.epochs + CASE WHEN bar IS NOT NULL AND key <= bar THEN 1 ELSE 0 END AS times
    FROM keyed k LEFT JOIN bars b ON k.source IS NOT DISTINCT FROM b.source),
read AS (SELECT *, CAST(unnest(range(times)) AS INTEGER) AS epoch FROM times)
SELECT doc_id, source, n AS n_tokens, block, epoch, md5(concat_ws('|', coalesce(source, ''), block, epoch, 42)) AS block_key FROM read
"""

_OP4 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS terms FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.terms, c.terms) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

_OP6 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
said AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ')
    ELSE concat_ws(' ', w[k], w[k + 1], w[k + 2], w[k + 3]) END AS shingle
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS k FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM said GROUP BY doc_id),
held AS (SELECT doc_id, n, shingle FROM said JOIN sizes USING (doc_id) SEMI JOIN
    (SELECT shingle FROM said GROUP BY shingle HAVING count(*) > 1) AS twice USING (shingle)),
link AS (SELECT a.doc_id AS a, b.doc_id AS b FROM held a JOIN held b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (SELECT doc_id AS node, doc_id AS other FROM d UNION SELECT r.node, l.b FROM reach r JOIN link l ON r.other = l.a),
least_of AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT node AS doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = node AS kept
FROM least_of LEFT JOIN sizes ON doc_id = node
"""

_OP8 = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings),
usable AS (SELECT * FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(x) > 0
           AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
         ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.x, b.x) >= 0.98),
reach AS (SELECT vec_id AS node, vec_id AS other FROM v WHERE vec_id IS NOT NULL
          UNION SELECT r.node, l.b FROM reach r JOIN link l ON r.other = l.a),
least_of AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node),
degree AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT node AS vec_id, coalesce(n, 0) AS n_links, component_id, component_id = node AS kept
FROM least_of LEFT JOIN degree ON a = node
"""

_OP10 = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS body FROM documents),
starts AS (SELECT doc_id, k, body[k:k + 49] AS w FROM (SELECT doc_id, body, unnest(range(1, octet_length(body) - 48)) AS k FROM d)),
again AS (SELECT doc_id, k FROM starts JOIN (SELECT w, min(doc_id) AS first FROM starts GROUP BY w HAVING count(DISTINCT doc_id) > 1) USING (w)
    WHERE doc_id > first),
heads AS (SELECT doc_id, k, coalesce(k > 50 + lag(k) OVER (PARTITION BY doc_id ORDER BY k), true) AS head FROM again),
spans AS (SELECT doc_id, min(k) AS a, max(k) + 49 AS b FROM (
    SELECT doc_id, k, sum(CAST(head AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY k) AS span FROM heads) GROUP BY doc_id, span),
edges AS (SELECT doc_id, list([a, b] ORDER BY a) AS cut, sum(b - a + 1) AS n_removed FROM spans GROUP BY doc_id),
rest AS (SELECT d.doc_id, hex(body) AS digits, octet_length(body) AS n, coalesce(cut, []) AS cut, coalesce(n_removed, 0) AS n_removed
    FROM d LEFT JOIN edges USING (doc_id))
SELECT doc_id, n AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, len(cut) AS n_spans,
    sha256(unhex(array_to_string(list_transform(range(0, len(cut) + 1), lambda i: digits[
        CASE WHEN i = 0 THEN 1 ELSE 2 * cut[i][2] + 1 END:CASE WHEN i = len(cut) THEN 2 * n ELSE 2 * cut[i + 1][1] - 2 END]), ''))) AS kept_sha256
FROM rest
"""

_OP11 = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
judged AS (SELECT part, CAST(len(w) < 200 AS INTEGER) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INTEGER)
    + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS INTEGER)
    + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INTEGER)
    + 16 * CAST(coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), false) AS INTEGER) AS fails,
    coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
masks AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM judged GROUP BY ALL),
bits AS (SELECT chr(65 + CAST(k AS INTEGER)) AS f, 1 << CAST(k AS INTEGER) AS bit FROM range(5) r(k)),
orders AS (SELECT [a.f, b.f, c.f, d.f, e.f] AS fs, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bs FROM bits a, bits b, bits c, bits d, bits e
    WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT array_to_string(fs, '') AS filter_order, CAST(k AS INTEGER) AS step, bs[k] AS bit,
    CAST(coalesce(list_sum(bs[1:k - 1]), 0) AS INTEGER) AS before FROM orders, range(1, 6) r(k)),
sizes AS (SELECT part, filter_order, step, bit,
    CAST(sum(n) FILTER ((fails & (before | bit)) = 0) AS BIGINT) AS kept,
    CAST(sum(n) FILTER ((fails & bit) > 0 AND (fails & before) = 0) AS BIGINT) AS removed,
    CAST(sum(n) FILTER ((fails & bit) > 0 AND (fails & before) > 0) AS BIGINT) AS redundant,
    CAST(sum(n) FILTER (fails = bit) AS BIGINT) AS unique_fails,
    CAST(sum(good) FILTER ((fails & bit) > 0 AND (fails & before) = 0) AS BIGINT) AS good_lost,
    CAST(sum(toxic) FILTER ((fails & bit) > 0 AND (fails & before) = 0) AS BIGINT) AS toxic_lost
    FROM masks, steps GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0) AS kept, coalesce(removed, 0) AS removed, coalesce(redundant, 0) AS redundant,
    coalesce(unique_fails, 0) AS unique_fails, coalesce(good_lost, 0) AS good_lost, coalesce(toxic_lost, 0) AS toxic_lost,
    CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM sizes
"""

_OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
said AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM said GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
held AS (SELECT lang, source, term, count(*) AS c FROM said SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, sum(c) AS n FROM held GROUP BY ALL),
grid AS (SELECT g.lang, g.source, k.term, coalesce(h.c, 0) AS c,
    1 + 1000000000::HUGEINT * (coalesce(h.c, 0) + 2) // (coalesce(n.n, 0) + 2 * v.v) AS p
    FROM groups g JOIN kept k ON g.lang = k.lang JOIN v ON g.lang = v.lang
    LEFT JOIN held h ON g.lang = h.lang AND g.source = h.source AND k.term = h.term
    LEFT JOIN n ON g.lang = n.lang AND g.source = n.source),
whole AS (SELECT lang, term, 1 + 1000000000::HUGEINT * (sum(c) + 2) // (sum(sum(c)) OVER (PARTITION BY lang) + 2 * any_value(v.v)) AS q
    FROM held JOIN v USING (lang) GROUP BY lang, term),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS BIGINT) AS value
    FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    UNION ALL
    SELECT a.lang, a.source, 'pair', b.source, 0 FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    WHERE a.lang NOT IN (SELECT lang FROM v)),
over AS (SELECT g.lang, g.source, 'term' AS part, g.term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value
    FROM grid g JOIN whole w ON g.lang = w.lang AND g.term = w.term WHERE c > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM over) QUALIFY part = 'pair' OR rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_filter_interaction": _OP11, "op12_source_divergence": _OP12,
            "op1_line_dedup": _OP1, "op3_source_mixing": _OP3, "op4_exact_topk": _OP4,
            "op6_minmax_near_dedup": _OP6, "op8_embedding_near_dedup": _OP8, "op10_suffix_dedup": _OP10}
