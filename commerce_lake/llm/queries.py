"""One query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lake.llm import (
    chat, decontam, lm, merkle, neardup, packing, pii, quality, secret_scan, shards, vector_codes, vector_search, warc,
)
from commerce_lake.llm.common import span_list, written

SHARDS = 40


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _of_kind(kind: str) -> Column:
    return F.filter("spans", lambda s: s["kind"] == kind)


def _count_of(kind: str) -> Column:
    return F.size(_of_kind(kind)).cast("long").alias(f"n_{kind}")


def _base_digest(kinds: tuple[str, ...]) -> Column:
    return F.sha2(span_list(F.filter("spans", lambda s: s["kind"].isin(*kinds))), 256).alias("base_sha256")


def op1_prefix_tree_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    probe = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(probe)
    read = chat.read_back(chat.build(rows, tokenizer_path()), tokenizer_path())
    masked = F.array_join(F.transform("turns", lambda t: t["masked"]), "")
    return read.select(
        F.col("conv").alias("conv_id"), "n_turns", F.sha2(chat.spelled(F.col("turns")), 256).alias("turns_sha256"),
        F.length(masked).cast("long").alias("loss_chars"), F.sha2(masked, 256).alias("loss_sha256"), "formatted_chars",
    )


def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.derive(warc.responses(pages)).select(
        "page_id", "kind", "record_id", "refers_to", "concurrent_to", "target_uri", "source_digest", "block_digest",
        "content_length", "n_links", F.sha2("record", 256).alias("record_sha256"),
    )


def op3_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    counts = written(quality.measured(docs, drop_text=True), "counts")
    judged = quality.judge(counts, quality.fences(counts))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_in_rows(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link(table(spark, sf_dir, "documents").select("doc_id", "text"), neardup.Plan(words=2))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = tuple(rule.kind for rule in secret_scan.BASE_RULES)
    return found.select(
        "doc_id", *[_count_of(kind) for kind in base], _base_digest(base), span_list(F.col("spans")).alias("spans")
    )


def op8_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.assign(table(spark, sf_dir, "documents").select("doc_id", "text"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", *[_count_of(kind) for kind in pii.BASE_KINDS], _base_digest(pii.BASE_KINDS),
        span_list(F.col("spans")).alias("spans"),
    )


def op10_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.place(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())
    return placed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        "segment", "loss_tokens",
    )


def op11_dual_tree_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.encode(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    coded = written(coded, "coded")
    labels = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"))
    labels = written(labels.withColumnRenamed("label", "_label"), "label-errors")
    digits = ",".join(str(x) for book in books for x in book.ravel().tolist())
    return coded.join(labels, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.sha2(F.lit(digits), 256).alias("codebooks_sha256")
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = F.translate("text", ascii_uppercase, ascii_lowercase)
    found = merkle.manifest(table(spark, sf_dir, "documents"), changed={"text": F.when(third, lowered).otherwise(F.col("text"))})
    return found.withColumnRenamed("folded", "folded_root").withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_adaptive_dimension_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vector_search.search(rows, F.col("vec_id") % 20 == 0)


QUERIES = {
    "op1_prefix_tree_chat": op1_prefix_tree_chat,
    "op2_warc_derivatives": op2_warc_derivatives,
    "op3_deleted_interpolation": op3_deleted_interpolation,
    "op4_quality_rules": op4_quality_rules,
    "op5_benchmark_containment": op5_benchmark_containment,
    "op6_circulant_minhash": op6_circulant_minhash,
    "op7_secret_scan": op7_secret_scan,
    "op8_feistel_shards": op8_feistel_shards,
    "op9_personal_data": op9_personal_data,
    "op10_vector_packing": op10_vector_packing,
    "op11_dual_tree_codes": op11_dual_tree_codes,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_adaptive_dimension_scan": op13_adaptive_dimension_scan,
}

_CONVERSATIONS = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(
    length('### : </turn>') + 1
    + length(replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), ':', '\:'), '</', '<\/'))
    + length(replace(replace(replace(text, '\', '\\'), '#', '\#'), '</', '<\/'))
  )::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

_CONTAINMENT = r"""
WITH lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, w[s : s + 9] AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM items WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT len(win) AS n FROM windows),
places AS (
  SELECT doc_id, s, n, w[s : s + n - 1] AS win
  FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM lowered, lengths)
), hits AS (SELECT doc_id, s, n, item_id FROM places JOIN windows USING (win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM lowered LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_CODES_START = """
WITH kept AS (
  SELECT row_number() OVER () AS row, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cut AS (
  SELECT row, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] AS x FROM kept, range(4) AS parts(p)
), book0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS y FROM cut JOIN kept USING (row)
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= 256
)"""

_CODES_ROUND = """, near{r} AS (
  SELECT row, p, x, e, away FROM (
    SELECT row, p, x, e, list_inner_product(x, x) - 2 * list_inner_product(x, y) + list_inner_product(y, y) AS away
    FROM cut JOIN book{r} USING (p)
  ) QUALIFY row_number() OVER (PARTITION BY row, p ORDER BY away, e) = 1
)"""

_CODES_MEANS = """, sums{r} AS (
  SELECT p, e, i, floor(sum(x[i]) / count(*)) AS mean
  FROM (SELECT p, e, x, unnest(range(1, len(x) + 1)) AS i FROM near{r}) GROUP BY p, e, i
), book{n} AS (
  SELECT p, e, coalesce(means, y) AS y
  FROM book{r} LEFT JOIN (SELECT p, e, list(mean ORDER BY i) AS means FROM sums{r} GROUP BY p, e) USING (p, e)
)"""

_CODES = (
    _CODES_START
    + "".join(_CODES_ROUND.format(r=r) + _CODES_MEANS.format(r=r, n=r + 1) for r in range(4))
    + _CODES_ROUND.format(r=4)
    + """, coded AS (
  SELECT row, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(away)::BIGINT AS error FROM near4 GROUP BY row
), digits AS (
  SELECT sha256(string_agg(c::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS sha
  FROM (SELECT p, e, unnest(y) AS c, unnest(range(len(y))) AS i FROM book4)
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha FROM digits) AS codebooks_sha256
FROM coded JOIN kept USING (row)
"""
)

_MERKLE = """
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY b) AS steps FROM (
    SELECT b, list_reduce(list_concat([b], range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS bytes(b)
  )
), rows AS (
  SELECT row_number() OVER () AS row, *, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii((doc_id::VARCHAR)[i])::BIGINT)),
    lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) AS crc32
  FROM documents, crc
), spelled AS (
  SELECT row, doc_id, lang, crc32 % 3 = 0 AS tampered,
    concat(
      coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-'), coalesce(strlen(source) || ':' || source, '-'),
      coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-')
    ) AS head,
    coalesce(strlen(text) || ':' || text, '-') AS body,
    coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS low
  FROM rows
), leaves AS (
  SELECT row, doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos,
    sha256(head || body) AS leaf, sha256(head || CASE WHEN tampered THEN low ELSE body END) AS altered
  FROM spelled
), nodes AS (
  SELECT tree, 0 AS level, pos, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (n + 7) // 8
  FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 8, n
), subroots AS (SELECT tree, level, digest FROM nodes WHERE n = 1),
above AS (
  SELECT 0 AS level, row_number() OVER (ORDER BY tree) - 1 AS pos, digest, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (n + 7) // 8
  FROM above WHERE n > 1 GROUP BY level, pos // 8, n
), steps AS (
  SELECT tree, level, pos, digest FROM nodes WHERE n > 1
  UNION ALL SELECT -1, level, pos, digest FROM above WHERE n > 1
), sided AS (
  SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before,
    coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS after
  FROM steps a JOIN steps b ON a.tree = b.tree AND a.level = b.level AND a.pos // 8 = b.pos // 8 GROUP BY a.tree, a.level, a.pos
), climbed AS (
  SELECT row, tree, 0 AS level, pos, altered AS cur, '' AS seen, false AS done FROM leaves
  UNION ALL
  SELECT row, CASE WHEN s.tree IS NULL THEN -1 ELSE c.tree END, CASE WHEN s.tree IS NULL THEN 0 ELSE c.level + 1 END,
    CASE WHEN s.tree IS NULL THEN c.tree - 1 ELSE c.pos // 8 END,
    CASE WHEN s.tree IS NULL THEN cur ELSE sha256(before || cur || after) END, seen || coalesce(before || after, ''),
    s.tree IS NULL AND c.tree = -1
  FROM climbed c LEFT JOIN sided s ON c.tree = s.tree AND c.level = s.level AND c.pos = s.pos WHERE NOT done
)
SELECT doc_id, leaf, s.digest AS subroot, (SELECT digest FROM above WHERE n = 1) AS root, sha256(seen) AS proof_sha256,
  cur AS folded_root, cur = (SELECT digest FROM above WHERE n = 1) AS verified
FROM climbed c JOIN leaves l USING (row) JOIN subroots s ON s.tree = l.tree WHERE done
"""

ORACLES: dict[str, str] = {
    "op1_prefix_tree_chat": _CONVERSATIONS,
    "op5_benchmark_containment": _CONTAINMENT,
    "op11_dual_tree_codes": _CODES,
    "op12_merkle_manifest": _MERKLE,
}
