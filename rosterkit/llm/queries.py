"""One thin query per operator, over its whole table, and the SQL that
restates it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import ship_package, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            ship_package(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run
    return deco


@query("op1_token_output")
def _op1(spark, sf_dir):
    from .token_output import packed_sequences
    return packed_sequences(table(spark, sf_dir, "documents"))


@query("op3_best_two_fit")
def _op3(spark, sf_dir):
    from .best_two_fit import best_two_fit
    return best_two_fit(table(spark, sf_dir, "documents"))


_OP4_SQL = """
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (SELECT *, lag(role) OVER w AS before, escaped(text) AS e FROM rows_ WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, escaped(role), escaped(text))),
parts AS (
  SELECT *, e AS et, CASE WHEN before IS NULL THEN length('<s>[INST][/INST]') + length(escaped(role))
                WHEN before <> role THEN length('</s><s>[INST][/INST]') + length(escaped(role)) ELSE length('[SEP]') END AS skip
  FROM marked)
SELECT conv_id, count(*) AS n_turns,
       sha256(coalesce(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, escaped(role), escaped(text)), '')) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, escaped(role), escaped(text)) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       (sum(skip + length(et)) + length('</s>'))::BIGINT AS formatted_chars
FROM parts GROUP BY conv_id
"""


def _escaped_sql(sql: str) -> str:
    """Writes out ``escaped(x)``: mark first, then the five control strings."""
    import re
    def out(m):
        x = f"replace({m[1]}, '~', '~0')"
        for k, c in enumerate(("<s>", "</s>", "[INST]", "[/INST]", "[SEP]"), 1):
            x = f"replace({x}, '{c}', '~{k}')"
        return x
    return re.sub(r"escaped\((\w+)\)", out, sql)


@query("op4_chat_formatting", _escaped_sql(_OP4_SQL))
def _op4(spark, sf_dir):
    from .chat import format_conversations, read_back
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = read_back(format_conversations(turns))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


@query("op7_source_mixing")
def _op7(spark, sf_dir):
    from .mixing import mix
    docs, _ = mix(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", "size", "source_size", "target", "taken", "source")


@query("op10_quality_rules")
def _op10(spark, sf_dir):
    from .quality import judge_quality
    judged = judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")


_OP5_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))
                                              WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM words),
classes AS (SELECT doc_id, len(s) AS n, CASE WHEN len(s) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY s) END AS class_id FROM sets),
shingles AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS s FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT c.doc_id, c.n::BIGINT AS n_shingles, c.class_id, (SELECT min(b) FROM reach r WHERE r.a = c.doc_id) AS component_id,
       (SELECT count(*) FROM links l WHERE l.a = c.doc_id) AS n_links
FROM classes c
"""


@query("op5_ngram_join", _OP5_SQL)
def _op5(spark, sf_dir):
    from .ngram_join import ngram_jaccard_join
    found = ngram_jaccard_join(table(spark, sf_dir, "documents"), links="counts").documents
    return found.select("doc_id", "n_shingles", "class_id", "component_id", "n_links")


_OP6_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, c.vec_id, row_number() OVER (PARTITION BY q.r ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id) AS rank,
         list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0)
WHERE rank <= 20
"""


@query("op6_exact_topk", _OP6_SQL)
def _op6(spark, sf_dir):
    from .topk import top_k
    return top_k(table(spark, sf_dir, "embeddings"))


@query("op9_line_dedup")
def _op9(spark, sf_dir):
    from .line_dedup import dedup_lines
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).withColumn("n_removed", F.size("removed_lines").cast("long"))


@query("op2_token_counts")
def _op2(spark, sf_dir):
    from .unigram import count_tokens
    return count_tokens(table(spark, sf_dir, "documents"))


@query("op8_pseudonyms")
def _op8(spark, sf_dir):
    from .pseudonyms import pseudonymize
    return pseudonymize(table(spark, sf_dir, "documents"))


_OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, rank, vec_id AS negative_id, positive_score, score AS negative_score FROM (
  SELECT p.*, n.vec_id, n.score, (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id))::INTEGER AS rank
  FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
  WHERE 80 * positive_score <= 100 * n.score AND 100 * n.score <= 100 * positive_score)
WHERE rank <= 5
"""


@query("op11_hard_negatives", _OP11_SQL)
def _op11(spark, sf_dir):
    from .hard_negatives import hard_negatives
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved))


_OP12_SQL = """
WITH lists AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
freq AS (
  SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase, count(*)::HUGEINT AS f
  FROM places, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE i + m - 1 <= len(w) GROUP BY ALL),
total AS (SELECT lang, sum(f)::HUGEINT AS n FROM freq WHERE m = 1 GROUP BY lang),
cand AS (SELECT *, string_split(phrase, ' ') AS w FROM freq WHERE m >= 2 AND f >= 100),
cuts AS (
  SELECT c.lang, c.phrase, c.m, c.f AS a, k, l.f AS l, r.f AS r, n, (1000 * c.f * n) // (l.f * r.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM cand) c
  JOIN freq l ON l.lang = c.lang AND l.phrase = array_to_string(list_slice(c.w, 1, k), ' ')
  JOIN freq r ON r.lang = c.lang AND r.phrase = array_to_string(list_slice(c.w, k + 1, c.m), ' ')
  JOIN total t ON t.lang = c.lang),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (
  SELECT * FROM lowest p WHERE NOT EXISTS (
    SELECT 1 FROM cand q WHERE q.lang = p.lang AND q.m > p.m AND 100 * q.f >= 100 * p.a AND contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' ')))
SELECT lang, row_number() OVER w AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score, k
FROM held WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) QUALIFY rank <= 2000
"""


@query("op12_phrase_collocations", _OP12_SQL)
def _op12(spark, sf_dir):
    from .collocations import collocations
    return collocations(table(spark, sf_dir, "documents"))


@query("op13_bpe_round_trip")
def _op13(spark, sf_dir):
    from .bpe import decode_documents, encode_documents
    both = decode_documents(encode_documents(table(spark, sf_dir, "documents")))
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
