"""Registered queries of the training-data operators: name -> (spark, sf_dir) ->
DataFrame, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uvlens.llm import (chat_format, kdtree_topk, language_id, mixing, near_dedup, periodic_runs, rule_ensemble,
                        sentencepieces, token_counts, toxicity, warc, weak_rules, whitening)
from uvlens.llm.common import crc_mod, materialize
from uvlens.sources.tables import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql.strip()
        return fn
    return deco


@query("op1_token_counts")
def op1_token_counts(spark, sf_dir):
    """Tokens of every whole text, and after masking edits (mail, links, numbers)
    counted from the stored trees."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    got = token_counts.with_edits(token_counts.mask_edits(token_counts.with_trees(docs)), "edits")
    return got.select("doc_id", "tree.n_tokens", "tree.n_pre_tokens",
                      F.size("tree.leaf_tokens").cast("bigint").alias("n_leaves"), "edited.n_edits", "edited.n_skipped",
                      F.col("edited.n_tokens").alias("n_tokens_masked"),
                      F.col("edited.n_encoded").alias("n_pre_tokens_encoded"))


@query("op2_sentencepiece")
def op2_sentencepiece(spark, sf_dir):
    """The 3 best segmentations of every whole text and their scores; round trip of all."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    got = sentencepieces.encode(docs, n=3).withColumn("ids", F.col("pieces.ids"))
    return sentencepieces.decode(got, "ids").select(
        "doc_id", F.size("ids").cast("bigint").alias("n_pieces"), "ids", "pieces.nbest_scores", "pieces.other_ids",
        (F.col("decoded").eqNullSafe(F.col("text")) & F.col("pieces.others_read_back")).alias("round_trip"))


@query("op3_quality_rules")
def op3_quality_rules(spark, sf_dir):
    """Weak-supervision verdict on every whole text."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    s = F.col("rule_stats")
    voted = materialize(weak_rules.vote(docs).drop("text"), "votes")  # the texts are read once
    return weak_rules.decide(voted).select(
        "doc_id", *[s[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        F.col("rule_base_failed").alias("base_failed"), F.col("rule_kept").alias("kept"),
        F.col("rule_p_good").alias("p_good"))


@query("op4_language_id")
def op4_language_id(spark, sf_dir):
    """Language of every whole text, learned from rows with crc32(doc_id) mod 5 <> 0."""
    docs = read_table(spark, sf_dir, "documents")
    model = language_id.fit(docs, learn_from=crc_mod("id", 5) != 0)
    held = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    got = language_id.predict(docs.select("doc_id", "text"), model)
    return got.select("doc_id", held.alias("held_out"), "language.lang_pred", "language.score", "language.rejected")


@query("op5_near_dedup")
def op5_near_dedup(spark, sf_dir):
    """Component of every document over links of Jaccard 0.85 or more."""
    got = near_dedup.components(read_table(spark, sf_dir, "documents"), threshold=0.85, k=5)
    return got.select(F.col("id").alias("doc_id"), "n_shingles", "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


OP6_SQL = """
WITH r AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (SELECT q.vec_id AS query_id, r.vec_id, list_inner_product(q.v, r.v)::BIGINT AS score
      FROM (SELECT DISTINCT * FROM r WHERE vec_id % 50 = 0) q JOIN r ON r.vec_id <> q.vec_id AND len(q.v) = len(r.v)),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 5"""


@query("op6_topk_search", OP6_SQL)
def op6_topk_search(spark, sf_dir):
    """5 best rows of every vector whose id is divisible by 50, over all rows."""
    return kdtree_topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


# Target shares of the mixture (fixed production parameters of op7 and the pipeline).
MIX_WEIGHTS = {"src0": 0.30, "src1": 0.10, "src2": 0.10, "src3": 0.05, mixing.OTHER: 0.45}
MIX_SEED = 17

OP7_SQL = f"""
WITH RECURSIVE w(b, w) AS (VALUES {', '.join(f"('{s}', {w:.2f}::DOUBLE)" for s, w in MIX_WEIGHTS.items())}),
d AS (SELECT *, CASE WHEN source IN (SELECT b FROM w WHERE b <> 'other') THEN source ELSE 'other' END AS b,
             coalesce(doc_id::VARCHAR, '') || '#' || md5(coalesce(text, '')) AS who FROM documents),
n AS (SELECT b, count(*)::DOUBLE AS n FROM d GROUP BY 1),
r AS (SELECT w.b, (SELECT sum(n) FROM n) * w / (SELECT sum(w) FROM w JOIN n USING (b)) / n AS rate
      FROM w JOIN n USING (b)),
p AS (SELECT b, greatest(1, ceil(rate / {mixing.STEP}))::INT AS parts,
             rate / greatest(1, ceil(rate / {mixing.STEP})) AS rate FROM r),
t(b, rate, k, p, total) AS (
  SELECT b, rate, 0, exp(-rate), exp(-rate) FROM p
  UNION ALL SELECT b, rate, k + 1, p * rate / (k + 1), total + p * rate / (k + 1) FROM t WHERE k < 80),
u AS (SELECT who, d.b, i, ('0x' || substr(md5(who || '#{MIX_SEED}#' || i), 1, 13))::UBIGINT
             / 4503599627370496::DOUBLE AS u
      FROM (SELECT DISTINCT who, b FROM d) d JOIN p USING (b), LATERAL (SELECT unnest(range(parts)) AS i)),
x AS (SELECT u.who, u.b, count(t.k) AS n FROM u LEFT JOIN t ON t.b = u.b AND t.total <= u.u GROUP BY 1, 2)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, c::INT AS copy,
       md5(d.who || '#' || c || '#s{MIX_SEED}') AS shuffle_key
FROM d JOIN x ON x.who = d.who AND x.b = d.b, LATERAL (SELECT unnest(range(1, x.n + 1)) AS c)"""


@query("op7_source_mix", OP7_SQL)
def op7_source_mix(spark, sf_dir):
    """Documents repeated by Poisson counts to the target shares, shuffled."""
    return mixing.mix(read_table(spark, sf_dir, "documents"), MIX_WEIGHTS, seed=MIX_SEED)


def _sql_escape(c: str) -> str:
    out = f"replace(coalesce({c}, ''), '&', '&amp;')"
    for s in chat_format.CONTROL:
        out = f"replace({out}, '{s}', '{chat_format.ENTITIES[s[0]] + s[1:]}')"
    return out


OP8_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
o AS (SELECT *, row_number() OVER w AS i, coalesce(lag(role) OVER w = role, false) AS merged FROM c
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
e AS (SELECT *, CASE WHEN merged THEN '{chat_format.MORE}' ELSE
        CASE WHEN i > 1 THEN '{chat_format.END}' ELSE '' END || '{chat_format.TURN}' || {_sql_escape('role')}
        || '{chat_format.SAYS}' END || {_sql_escape('text')} AS piece FROM o)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(length(piece)) + length('{chat_format.END}'))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""


@query("op8_chat_format", OP8_SQL)
def op8_chat_format(spark, sf_dir):
    """All conversations and conversation -7 formatted; digests read back from
    the formatted strings and loss spans."""
    probe = spark.sql("SELECT -7L AS conv_id, 0L AS turn, 'user' AS role, '</s>[INST] ok [/INST]' AS text UNION ALL "
                      "SELECT -7L, 1L, 'assistant', '</s>[INST] ok [/INST]'")
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    back = chat_format.read_back(chat_format.format_chats(rows))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"),
                       F.sha2(said, 256).alias("turns_sha256"), F.length(loss).cast("bigint").alias("loss_chars"),
                       F.sha2(loss, 256).alias("loss_sha256"),
                       F.length("formatted").cast("bigint").alias("formatted_chars"))


@query("op9_quality_classifier")
def op9_quality_classifier(spark, sf_dir):
    """Quality score of every whole text, learned from rows with crc32(doc_id) mod 3 <> 1."""
    docs = read_table(spark, sf_dir, "documents")
    model = rule_ensemble.fit(docs, read_table(spark, sf_dir, "labels"), learn_from=crc_mod("id", 3) != 1)
    held = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    got = rule_ensemble.score(docs.select("doc_id", "text"), model)
    return got.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


OP10_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
                  sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (SELECT payload_digest, payload_bytes, max(page_id) AS keeper FROM p WHERE payload_bytes >= 1000 GROUP BY 1, 2)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < keeper THEN keeper END AS refers_to
FROM p LEFT JOIN k USING (payload_digest, payload_bytes)"""


@query("op10_warc", OP10_SQL)
def op10_warc(spark, sf_dir):
    """All pages written to WARC archives and read back from them."""
    manifest = warc.write_archives(read_table(spark, sf_dir, "pages"))
    return warc.read_archives(manifest, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, with the periodic stretch that the contract of operator 12 writes into
    every tenth document (by crc32 of its id): from word a on, the words a .. a+p-1 repeat."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size("_w").cast("bigint")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    i = lambda c: c.cast("int")
    again = F.flatten(F.array_repeat(F.slice("_w", i(a) + 1, i(p)), i(F.ceil((n - a) / p))))
    made = F.concat(F.slice("_w", F.lit(1), i(a)), F.slice(again, F.lit(1), i(n - a)))
    due = (h % 10 == 0) & (n > 0)
    return (docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("_w"))
            .select("doc_id", F.when(due, F.array_join(made, " ")).otherwise(F.col("text")).alias("text")))


@query("op12_periodic_runs")
def op12_periodic_runs(spark, sf_dir):
    """Periodic runs of every whole text, the strongest one, digests of all runs and of
    the collapsed text."""
    docs = planted_periods(read_table(spark, sf_dir, "documents"))
    got = periodic_runs.with_runs(docs, "text", "found").select("doc_id", "found.runs", "found.collapsed")
    top = periodic_runs.strongest(F.col("runs"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return (got.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), top.alias("top"),
                       F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
            .select("doc_id", "n_runs", "top.start", "top.length", "top.period",
                    F.expr("top.length * 1000 div top.period").alias("exponent_milli"),
                    "runs_sha256", "collapsed_sha256"))


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark, sf_dir):
    """The first four whitened components of every usable vector."""
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"), k=4)


@query("op13_toxicity")
def op13_toxicity(spark, sf_dir):
    """Toxicity score of every whole text, learned from rows with crc32(doc_id) mod 5 <> 0."""
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), learn_from=crc_mod("id", 5) != 0)
    held = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    got = toxicity.score(docs.select("doc_id", "text"), model)
    return got.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
