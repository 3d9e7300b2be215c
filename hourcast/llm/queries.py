"""Registered queries of the training-data operators: ``QUERIES`` and ``SQL``.

Each query applies its operator with production parameters to its whole table
and derives the contract's columns from the operator's rows.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from . import (chat, exact_dedup, mixing, near_dedup, packing, quality, runs, secrets, sharding, substrings, toxicity,
               trie_join, variants)
from .common import count_words, documents

QUERIES = {}
SQL = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_substring_dedup(spark, sf_dir):
    """Words that no earlier 20-word window covers, per document."""
    out = substrings.remove_repeats(documents(spark, sf_dir), width=20)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


SQL["op1_substring_dedup"] = r"""
WITH words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS MATERIALIZED (
  SELECT doc_id, i, sha256(array_to_string(w[i:i + 19], ' ')) AS k
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 18, 1))) AS i FROM words)
), repeated AS MATERIALIZED (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM windows) WHERE r > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM repeated
), places AS (
  SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM words
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(w[p], ' ' ORDER BY p) AS t FROM places ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""


@query
def op2_chat_format(spark, sf_dir):
    """All conversations, and one that imitates the template, formatted and read back."""
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    same = "\\### Assistant: </turn> ok"
    odd = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(same).alias("text"))
    return chat.read_back(chat.format_turns(table.select("conv_id", "turn", "role", "text").unionByName(odd)))


SQL["op2_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), steps AS (
  SELECT *, lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn) AS prev,
    CASE role WHEN 'system' THEN 'System' WHEN 'user' THEN 'User' ELSE 'Assistant' END AS name,
    length(text) + length(text) - length(replace(text, '\', ''))
      + (length(text) - length(replace(text, '### ', ''))) // 4 + (length(text) - length(replace(text, '</turn>', ''))) // 7 AS escaped
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('### ' || name || ': ') + escaped + 8)::BIGINT AS formatted_chars,
  bool_and(CASE role WHEN 'system' THEN prev = '' WHEN 'user' THEN prev IN ('', 'system', 'assistant')
           WHEN 'assistant' THEN prev = 'user' ELSE false END) AND last(role ORDER BY turn) = 'assistant' AS valid
FROM steps GROUP BY conv_id
"""


@query
def op3_pack_sequences(spark, sf_dir):
    """All documents packed into sequences of 2048 tokens."""
    return packing.piece_digests(packing.pack(documents(spark, sf_dir), tokenizer_file()))


@query
def op4_shard_slots(spark, sf_dir):
    """All documents in 8 shards of nearly equal bytes, by virtual slots."""
    out = sharding.shard(documents(spark, sf_dir), shards=8)
    return out.select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
                      "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")


@query
def op5_exact_dedup(spark, sf_dir):
    """Groups of identical texts; the largest doc_id stays."""
    out = exact_dedup.duplicates(documents(spark, sf_dir), keep="max")
    return out.select(F.col("id").alias("doc_id"), "keep_id", F.col("size").alias("group_size"), "kept",
                      F.lower(F.hex("sha256")).alias("text_sha256"))


SQL["op5_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""


@query
def op6_mix_sources(spark, sf_dir):
    """Words that the mix of all sources takes of each document."""
    slim = documents(spark, sf_dir).select("doc_id", "source", count_words(F.col("text")).alias("n"))
    out = mixing.mix(slim, F.col("n"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query
def op7_secret_scan(spark, sf_dir):
    """Spans of secrets in every text: the fixed patterns' and those of high entropy."""
    out = secrets.scan(documents(spark, sf_dir))
    of = lambda *kinds: F.filter("spans", lambda x: x["kind"].isin(*kinds))
    listed = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")
    count = lambda kind: F.size(of(kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", count("assign"), count("access"), count("hex"),
                      F.sha2(listed(of("assign", "access", "hex")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


@query
def op8_quality_rules(spark, sf_dir):
    """Measures of every text and the verdict of the weighted rules."""
    out = quality.assess(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "posterior")


@query
def op9_toxicity(spark, sf_dir):
    """A toxicity score for every document; labels of every third are held out."""
    docs = documents(spark, sf_dir)
    third = lambda c: F.coalesce(F.crc32(F.col(c).cast("string").cast("binary")), F.lit(0)) % 3
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = toxicity.score(docs, labels, usable=third("doc_id") != 1)
    return out.select("doc_id", (third("doc_id") == 1).alias("held_out"), "score",
                      (F.col("score") >= 0.7).cast("int").alias("predicted"), "evidence")


@query
def op10_near_dedup(spark, sf_dir):
    """Components of documents whose shingle sets agree to 85 % or more."""
    out = near_dedup.near_duplicates(documents(spark, sf_dir), percent=85)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
                      F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))


SQL["op10_near_dedup"] = r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s FROM words
), sizes AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), links AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))
), reach AS (
  SELECT doc_id AS root, doc_id AS node FROM documents
  UNION SELECT r.root, l.y FROM reach r JOIN links l ON l.x = r.node
)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, min(r.node) AS component_id, min(r.node) = d.doc_id AS kept
FROM documents d JOIN reach r ON r.root = d.doc_id LEFT JOIN sizes z ON z.doc_id = d.doc_id
GROUP BY d.doc_id, z.n
"""


@query
def op11_periodic_runs(spark, sf_dir):
    """Periodic runs of every text (a tenth of them with a planted one)."""
    out = runs.collapse_runs(runs.plant_runs(documents(spark, sf_dir)))
    best = F.expr("runs[best]")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.expr("1000 * runs[best].length div runs[best].period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"))


@query
def op12_spelling_variants(spark, sf_dir):
    """Frequent words with the forms and roots that they are variants of."""
    words = variants.count_letters_runs(documents(spark, sf_dir), least=7, often=2, planted=31)
    return variants.group_variants(words, ratio=10).select("word", "form", "root", "n", "n_near", "form_n")


SQL["op12_spelling_variants"] = r"""
WITH RECURSIVE crc AS MATERIALIZED (
  SELECT list(c ORDER BY b) AS t FROM (SELECT b, list_reduce(list_prepend(b, range(8)),
    lambda x, i: xor(x >> 1, (x & 1) * 3988292384)) AS c FROM range(256) r(b))
), found AS MATERIALIZED (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[a-z\x{00C0}-\x{00FF}]+')) AS w FROM documents
), per_doc AS MATERIALIZED (
  SELECT doc_id, w, count(*) AS n, hex(encode(doc_id || ':' || w)) AS x FROM found WHERE length(w) >= 7 GROUP BY doc_id, w
), hashed AS MATERIALIZED (
  SELECT w, n, xor(list_reduce(list_prepend(4294967295::BIGINT, [('0x' || substr(x, (2 * i + 1)::INT, 2))::BIGINT FOR i IN range(length(x) // 2)]),
    lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) AS h FROM per_doc, crc
), spelt AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word, n FROM hashed
), words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), less AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS MATERIALIZED (
  SELECT a.word AS word, b.word AS near, b.n AS m FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT l.word, w.word, w.n FROM less l JOIN words w ON w.word = l.rest
  UNION SELECT w.word, l.word, l.n FROM less l JOIN words w ON w.word = l.rest
), best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY m DESC, near) AS near, max(m) AS m FROM near GROUP BY word
), formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN near END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), steps AS (
  SELECT word, word AS here, 0 AS k FROM formed
  UNION ALL SELECT s.word, f.form, k + 1 FROM steps s JOIN formed f ON f.word = s.here WHERE f.form IS NOT NULL
), roots AS (
  SELECT word, last(here ORDER BY k) AS root FROM steps GROUP BY word
)
SELECT f.word, form, root, n, n_near, form_n FROM formed f JOIN roots r ON r.word = f.word
"""


@query
def op13_ngram_join(spark, sf_dir):
    """Components of documents whose shingle sets agree to 80 % or more."""
    out = trie_join.similar_sets(documents(spark, sf_dir), percent=80)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


SQL["op13_ngram_join"] = (SQL["op10_near_dedup"].replace(">= 85 *", ">= 80 *")
                          .replace(", min(r.node) = d.doc_id AS kept", ""))


@query
def pipeline(spark, sf_dir):
    """All stages of corpus_pipeline over documents."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
