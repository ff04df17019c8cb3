"""One query for each operator, over its whole table, with the parameters meant for production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lynxrisk.llm import alignment, chat, hamming_search, html_text, langid, line_dedup, mixing, packing, quality, secret_scan, sharding, simhash, spelling
from lynxrisk.llm.common import text_or_empty

#: The ranks of byte_bpe_50k.json, which give the same ids (tested) in a third of the time.
TOKENIZER = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op2_hamming_top_k(spark: SparkSession, folder: str) -> DataFrame:
    codes = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), hamming_search.sign_code(F.col("embedding")).alias("code"))
    found = hamming_search.nearest(codes, codes.filter(F.col("id") % 50 == 0), k=10)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "distance")


OP2 = """
WITH q AS (SELECT vec_id AS query_id, embedding AS qe FROM embeddings WHERE vec_id % 50 = 0),
d AS (SELECT query_id, vec_id, CAST(list_sum(list_transform(range(1, 65),
        lambda i: CASE WHEN (qe[i] > 0) <> (embedding[i] > 0) THEN 1 ELSE 0 END)) AS INTEGER) AS distance
      FROM q JOIN embeddings e ON e.vec_id <> q.query_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank, vec_id, distance FROM d)
SELECT query_id, rank, vec_id, distance FROM r WHERE rank <= 10
"""


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    answered = langid.identify(table(spark, folder, "documents"))
    return answered.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op4_adaptive_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents")).drop("failed")


def _op4() -> str:
    """The rules, sketches and fences of ``quality`` in SQL, from its fixed values and parameters."""
    q = quality
    measures = {
        "symbols": "n_symbols * 1000 // greatest(n_words, 1)",
        "upper": "n_upper * 1000 // greatest(word_chars, 1)",
        "word_length": "word_chars * 1000 // greatest(n_words, 1)",
        "repeated": "n_repeat_words * 1000 // greatest(n_words, 1)",
        "dup_lines": "n_dup_lines * 1000 // greatest(n_lines, 1)",
    }
    long = " UNION ALL ".join(f"SELECT doc_id, lang, source, '{m}' AS m, {e} AS v FROM counted WHERE NOT base_failed" for m, e in measures.items())
    limits = ", ".join(f"('{m}', {w}, {top or 'NULL'}, {low})" for m, (w, top, low) in q.MEASURES.items())
    shift = f"greatest(length(bin(v)) - {1 + q.FRACTION_BITS}, 0)"
    low = 1 << q.FRACTION_BITS

    def quartiles(name: str, by: str) -> str:
        group = f"{by}, m" if by else "m"
        end = f"CASE WHEN b < {2 * low} THEN b ELSE ((b - (b // {low} - 1) * {low} + 1) << CAST(b // {low} - 1 AS INTEGER)) - 1 END"
        return (
            f"{name} AS (SELECT {group}, any_value(n) AS n, min({end}) FILTER (c >= ceil(n * 0.25)) AS q1, min({end}) FILTER (c >= ceil(n * 0.75)) AS q3"
            f" FROM (SELECT {group}, b, sum(k) OVER (PARTITION BY {group} ORDER BY b) AS c, sum(k) OVER (PARTITION BY {group}) AS n"
            f" FROM (SELECT {group}, b, count(*) AS k FROM sketch GROUP BY ALL)) GROUP BY {group})"
        )

    space = r"\x20\x09-\x0D"
    prior = q.PRIOR_DOCS
    blend = lambda c: f"(o.n * o.{c} + {prior} * ((l.n * l.{c} + {prior} * e.{c}) // (l.n + {prior}))) // (o.n + {prior})"
    return f"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^{space}]+') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{space}]')) AS ls FROM d),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + {q.WINDOW - 1}], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {q.WINDOW - 2})) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, range(0, {q.WINDOW}) r(k) GROUP BY doc_id),
raw AS (SELECT w.doc_id, lang, source, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        len(regexp_extract_all(t, '[{q.SYMBOLS}]')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
        coalesce(cov.n, 0) AS n_repeat_words, len(regexp_extract_all(t, '[A-Z]')) AS n_upper, len(ls) AS n_lines
        FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id),
counted AS (SELECT *, n_words < {q.LEAST_WORDS} OR 100 * n_repeat_words > {q.MOST_REPEATED_PERCENT} * n_words AS base_failed FROM raw),
measured AS ({long}),
sketch AS (SELECT *, CASE WHEN v < {low} THEN v ELSE {shift} * {low} + (v >> CAST({shift} AS INTEGER)) END AS b FROM measured),
{quartiles("o", "lang, source")}, {quartiles("l", "lang")}, {quartiles("e", "")},
p(m, width, top, low_too) AS (VALUES {limits}),
f AS (SELECT o.lang, o.source, o.m, p.width, p.top, p.low_too, {blend("q1")} AS q1, {blend("q3")} AS q3
        FROM o JOIN l ON o.lang IS NOT DISTINCT FROM l.lang AND o.m = l.m JOIN e ON o.m = e.m JOIN p ON o.m = p.m),
g AS (SELECT lang, source, m, CASE WHEN low_too THEN q1 - {q.REACH} * greatest(q3 - q1, width) ELSE -1 END AS least,
        least(q3 + {q.REACH} * greatest(q3 - q1, width), CASE WHEN top IS NOT NULL THEN q3 + (greatest(top, q3) - q3) * 3 // 4 END) AS most FROM f),
bad AS (SELECT DISTINCT x.doc_id FROM measured x JOIN g ON x.lang IS NOT DISTINCT FROM g.lang AND x.source IS NOT DISTINCT FROM g.source AND x.m = g.m
        WHERE v < least OR v > most)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT EXISTS (SELECT 1 FROM bad WHERE bad.doc_id IS NOT DISTINCT FROM counted.doc_id) AS kept FROM counted
"""


OP4 = _op4()


def op5_cube_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op6_perspective_chat(spark: SparkSession, folder: str) -> DataFrame:
    views = chat.rotate(table(spark, folder, "conversations"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return views.select("conv_id", "speaker", F.col("piece").cast("long").alias("piece"), F.col("n_turns").cast("long").alias("n_turns"), "text", spans.alias("spans"))


OP6 = """
WITH t AS (
  SELECT conv_id, turn, role, replace(coalesce(text, ''), '<|', '< |') AS text,
         row_number() OVER (PARTITION BY conv_id, turn // 256 ORDER BY turn, role, text) - 1 AS pos, turn // 256 AS r FROM conversations),
p AS (SELECT *, dense_rank() OVER (PARTITION BY conv_id ORDER BY r, pos // 256) - 1 AS piece FROM t),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM conversations WHERE role IS NOT NULL AND role <> 'system'),
v AS (SELECT p.*, speaker, role = speaker AS own,
        '<|im_start|>' || CASE WHEN role = speaker THEN 'assistant' WHEN role = 'system' THEN 'system'
          ELSE 'user name=' || coalesce(role, 'unknown') END || chr(10) AS head FROM p JOIN s USING (conv_id)),
w AS (SELECT *, head || text || '<|im_end|>' || chr(10) AS whole FROM v),
o AS (SELECT *, coalesce(sum(length(whole)) OVER (PARTITION BY conv_id, speaker, piece ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM w)
SELECT conv_id, speaker, CAST(piece AS BIGINT) AS piece, count(*) AS n_turns, string_agg(whole, '' ORDER BY pos) AS text,
  coalesce(string_agg(CAST(CAST(off + length(head) AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(off + length(whole) - 1 AS BIGINT) AS VARCHAR), ',' ORDER BY pos) FILTER (own), '') AS spans
FROM o GROUP BY conv_id, speaker, piece
"""


def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"), tokenizer_path(), added=True)
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op8_hypergeometric_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shuffle_to_shards(table(spark, folder, "documents"), shards=40)
    text = text_or_empty(F.col("text"))
    return placed.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _count(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        _count("base", 0).alias("n_assign"),
        _count("base", 1).alias("n_access"),
        _count("base", 2).alias("n_hex"),
        F.sha2(secret_scan.joined_spans(F.col("base")), 256).alias("base_sha256"),
        secret_scan.joined_spans(F.col("spans")).alias("spans"),
    )


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"), least_words=1)


def op11_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, folder, "documents"))


def op13_cross_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.cross_align(table(spark, folder, "documents"), tokenizer_path(), tokenizer_path(PIECES))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup,
        op2_hamming_top_k,
        op3_language_id,
        op4_adaptive_quality,
        op5_cube_mix,
        op6_perspective_chat,
        op7_best_fit_packing,
        op8_hypergeometric_shards,
        op9_secret_scan,
        op10_line_dedup,
        op11_html_text,
        op12_spelling_variants,
        op13_cross_alignment,
    )
}

ORACLES: dict[str, str] = {"op2_hamming_top_k": OP2, "op4_adaptive_quality": OP4, "op6_perspective_chat": OP6}

