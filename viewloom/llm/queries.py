"""The queries op1 to op13 over the given tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.llm import align, ann, blocks, compression, hmm, jaccard, leaks, lines, merkle, mixing, packing, rules, toxicity
from viewloom.llm.text import table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def remainder(divisor: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def op1_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = hmm.score(table(spark, sf_dir, "documents"), remainder(10) != 0)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op3_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    learned = rules.train(docs, labels)
    judged = rules.statistics(docs, ["doc_id"]).withColumn("rule", rules.verdict(learned))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.select("doc_id", *rules.LONGS, failed.alias("base_failed"), (~failed & F.col("rule").isNull()).alias("kept"), "rule")


def op5_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return blocks.extract(pages, blocks.train(pages), ["page_id", "url"]).withColumn("n_chars", F.length("text").cast("long"))


def op6_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    allowed = remainder(3) != 1
    model = toxicity.train(docs.where(allowed), labels.where(allowed))
    return toxicity.score(docs, model, ["doc_id"]).select(
        "doc_id", F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op7_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")).where("label is not null")
    model = compression.train(docs, labels.where(remainder(4) != 2))
    scored = compression.score(docs, model, ["doc_id"])
    return scored.select(
        "doc_id",
        F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "difference",
    )


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        leaks.n_hit(F.col("hits")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    found = align.counted(table(spark, sf_dir, "documents"), a, b, ["doc_id"])
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    values = {name: F.col(name).cast("string") for name in merkle.FIELDS}
    more = values | {"n_chars": (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")}
    shown = F.when(remainder(7) == 0, merkle.leaf(list(more.values())))
    leaves = docs.select("doc_id", "lang", merkle.leaf(list(values.values())).alias("leaf"), shown.alias("shown"))
    return merkle.manifest(leaves, "lang", "doc_id", claimed="shown")


QUERIES = {f.__name__: f for f in (op1_hmm_scoring, op2_mixing, op3_adaptive_scan, op4_decision_list, op5_block_labeller, op6_pu_toxicity, op7_compression_quality, op8_jaccard_join, op9_packing, op10_line_dedup, op11_decontamination, op12_token_alignment, op13_merkle_manifest)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_WORD = r"'[^\x20\x09-\x0D]+'"

#: The set joins, the decontamination and the manifest for DuckDB; ids are taken to be unique, as in ``documents``.  The other operators train models, pack with a tokenizer or choose by seeds.
ORACLE_SQL: dict[str, str] = {
    "op8_jaccard_join": f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_WORD}) AS ws FROM documents),
  runs AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0),
  s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM runs),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
  l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
  e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
  r AS (SELECT DISTINCT a AS doc_id, a AS other FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other),
  c AS (SELECT doc_id, min(other) AS component FROM r GROUP BY doc_id)
  SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, doc_id) AS component_id FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)""",
    "op10_line_dedup": f"""WITH d AS (SELECT doc_id, text IS NULL AS absent, string_split({_LOWER}, chr(10)) AS ls FROM documents),
  l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS k FROM d),
  s AS (SELECT doc_id, k, list_sort(list_distinct(regexp_extract_all(line, {_WORD}))) AS ws FROM l),
  f AS (SELECT *, row_number() OVER (PARTITION BY ws ORDER BY doc_id, k) AS place FROM s WHERE len(ws) > 0),
  node AS (SELECT doc_id, k, ws, len(ws) AS n, row_number() OVER (ORDER BY doc_id, k) AS id FROM f WHERE place = 1),
  word AS (SELECT id, n, unnest(ws) AS t FROM node WHERE n >= 4),
  df AS (SELECT t, count(*) AS c FROM word GROUP BY t),
  ranked AS (SELECT id, n, t, row_number() OVER (PARTITION BY id ORDER BY c, t) AS pos FROM word JOIN df USING (t) WHERE c > 0),
  key AS (SELECT id, n, t FROM ranked WHERE pos <= n - CAST(ceil(0.8 * n) AS BIGINT) + 1),
  pair AS (SELECT DISTINCT x.id AS x, y.id AS y FROM key x JOIN key y ON x.t = y.t AND y.id < x.id AND 4 * greatest(x.n, y.n) <= 5 * least(x.n, y.n)),
  both_ AS (SELECT x, a.n AS n, b.n AS m, len(list_intersect(a.ws, b.ws)) AS c FROM pair JOIN node a ON a.id = x JOIN node b ON b.id = y),
  gone AS (SELECT DISTINCT x FROM both_ WHERE 5 * c >= 4 * (n + m - c)),
  removed AS (SELECT doc_id, k FROM f WHERE place > 1 UNION ALL SELECT doc_id, k FROM node JOIN gone ON x = id),
  r AS (SELECT doc_id, count(*) AS n_removed, string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) AS removed FROM removed GROUP BY doc_id)
  SELECT doc_id, CASE WHEN absent THEN 0 ELSE len(ls) END AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed FROM d LEFT JOIN r USING (doc_id)""",
    "op11_decontamination": f"""WITH w AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_PLAIN}) AS ws FROM documents),
  b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all({_LOWER}, {_PLAIN}) AS ws FROM benchmark),
  cut AS (SELECT item, ws, least(len(ws), 10) AS n, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM b WHERE len(ws) > 0),
  win AS (SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS g FROM cut),
  runs AS (SELECT doc_id, n, unnest(range(1, len(ws) - n + 2)) AS i, ws FROM w, (SELECT DISTINCT n FROM win) WHERE len(ws) >= n),
  met AS (SELECT doc_id, i, n, item FROM (SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS g FROM runs) JOIN win USING (n, g)),
  spots AS (SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS spot FROM (SELECT DISTINCT doc_id, i, n FROM met)) GROUP BY doc_id),
  items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id)
  SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM w LEFT JOIN spots USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op13_merkle_manifest": """WITH RECURSIVE
  bits AS (SELECT doc_id, n_chars, lang, source, text, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda s, c: list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda t, b: xor(t >> 1, CASE WHEN t & 1 = 1 THEN 3988292384 ELSE 0 END), xor(s, c)), 4294967295) AS s FROM documents),
  f AS (SELECT *, coalesce(xor(s, 4294967295) % 7 = 0, false) AS bad, [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text] AS v,
    [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars + 1 AS VARCHAR), text] AS w FROM bits),
  h AS (SELECT doc_id, lang, bad, sha256(array_to_string(list_transform(v, lambda x: coalesce(CAST(strlen(x) AS VARCHAR) || ':' || x, '-')), '')) AS leaf,
    sha256(array_to_string(list_transform(w, lambda x: coalesce(CAST(strlen(x) AS VARCHAR) || ':' || x, '-')), '')) AS other FROM f),
  leaves AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM h),
  low AS (SELECT 0 AS lv, g, i, n, leaf AS d FROM leaves UNION ALL
    SELECT lv + 1, g, i // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY i)) FROM low WHERE n > 1 GROUP BY lv, g, i // 2, n),
  subroots AS (SELECT g, d FROM low WHERE n = 1),
  high AS (SELECT 0 AS lv, g - 1 AS i, (SELECT count(*) FROM subroots) AS n, d FROM subroots UNION ALL
    SELECT lv + 1, i // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY i)) FROM high WHERE n > 1 GROUP BY lv, i // 2, n),
  steps AS (SELECT x.g, x.i AS leaf_i, s.lv, s.i % 2 AS right_, s.d FROM leaves x JOIN low s ON s.g = x.g AND s.i = xor(x.i // CAST(power(2, s.lv) AS BIGINT), 1) WHERE s.n > 1
    UNION ALL SELECT x.g, x.i, 100 + s.lv, s.i % 2, s.d FROM leaves x JOIN high s ON s.i = xor((x.g - 1) // CAST(power(2, s.lv) AS BIGINT), 1) WHERE s.n > 1),
  lone AS (SELECT x.g, x.i AS leaf_i, l.lv, 0 AS right_, '' AS d FROM leaves x JOIN (SELECT g, lv, max(i) AS i FROM low WHERE n > 1 AND n % 2 = 1 GROUP BY g, lv) l
      ON l.g = x.g AND l.i = x.i // CAST(power(2, l.lv) AS BIGINT)
    UNION ALL SELECT x.g, x.i, 100 + l.lv, 0, '' FROM leaves x JOIN (SELECT lv, max(i) AS i FROM high WHERE n > 1 AND n % 2 = 1 GROUP BY lv) l ON l.i = (x.g - 1) // CAST(power(2, l.lv) AS BIGINT)),
  p AS (SELECT g, leaf_i, list({'r': right_, 'd': d} ORDER BY lv) AS steps, string_agg(d, '' ORDER BY lv) AS siblings FROM (SELECT * FROM steps UNION ALL SELECT * FROM lone) GROUP BY g, leaf_i),
  o AS (SELECT doc_id, leaf, u.d AS subroot, (SELECT d FROM high WHERE n = 1) AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
    list_reduce(list_prepend({'r': CAST(0 AS BIGINT), 'd': CASE WHEN bad THEN coalesce(other, leaf) ELSE leaf END}, list_transform(coalesce(steps, []), lambda t: {'r': CAST(t.r AS BIGINT), 'd': t.d})),
      lambda a, t: {'r': CAST(0 AS BIGINT), 'd': sha256(CASE WHEN t.r = 1 THEN a.d || t.d ELSE t.d || a.d END)}).d AS folded_root
    FROM leaves x JOIN subroots u USING (g) LEFT JOIN p ON p.g = x.g AND p.leaf_i = x.i)
  SELECT *, folded_root = root AS verified FROM o""",
}
