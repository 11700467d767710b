"""The registered queries of this package, each with its checking SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tripkit.session import apply_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(apply_settings(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op8_mix_sources", r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight FROM s
), l AS (
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
      - coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
      / (sum(weight) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM w
), t AS (
  SELECT source, source_size,
    CASE WHEN 2 * source_size <= level * weight THEN (2 * source_size)::DOUBLE
         ELSE (max(CASE WHEN 2 * source_size > level * weight THEN level END) OVER ()) * weight END AS target
  FROM l
), q AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS goal,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(concat(d.doc_id, ':0')), d.doc_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(goal, before + size) - before)
   + greatest(0, least(goal, source_size + before + size) - source_size - before))::BIGINT AS taken
FROM q
""")
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripkit.llm.mixing import mix_sources

    pieces, listed = mix_sources(spark, _table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    taken = pieces.groupBy("row").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    return listed.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


@_query("op1_resolve_revisits", r"""
WITH c AS (
  SELECT page_id, html, url,
    regexp_extract(url, '^[^/?#]*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?', 1, 's') AS h,
    regexp_extract(url, '^[^/?#]*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?', 2, 's') AS p,
    list_sort(list_filter(string_split(regexp_extract(url, '^[^/?#]*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?', 3, 's'), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|gclid|fbclid)(=|$)'))) AS a
  FROM pages
), k AS (
  SELECT page_id, md5(html) AS digest, length(html) AS size,
    regexp_replace(lower(h), ':(80|443)$', '') || regexp_replace(p, '/+$', '')
      || CASE WHEN len(a) > 0 THEN '?' || array_to_string(a, '&') ELSE '' END AS url_key
  FROM c
), r AS (
  SELECT url_key, page_id AS time, max_by(page_id, page_id) AS page_id, max_by(digest, page_id) AS digest,
    max_by(size, page_id) AS size
  FROM k WHERE url_key IS NOT NULL GROUP BY ALL
), v AS (
  SELECT page_id * 2 + 1 AS record_id, url_key, page_id % 60 AS age,
    CASE WHEN page_id % 11 = 0 THEN page_id - 1 ELSE page_id + 1 + (page_id * 7919) % 5000 END AS time,
    CASE WHEN page_id % 7 = 0 THEN NULL WHEN page_id % 5 = 0 THEN '"changed"' WHEN page_id % 5 = 1 THEN NULL
         ELSE 'W/"' || digest || '"' END AS tag,
    CASE WHEN page_id % 7 = 0 THEN NULL ELSE 'day ' || page_id % 1000 END AS day
  FROM k
), j AS (
  SELECT v.*, r.page_id AS of_page, r.digest AS of_digest, r.size AS of_size
  FROM v ASOF LEFT JOIN r ON v.url_key = r.url_key AND v.time > r.time
), o AS (
  SELECT *, CASE WHEN of_page IS NULL THEN 'no_earlier_response'
    WHEN CASE WHEN tag IS NOT NULL THEN replace(tag, 'W/', '') = '"' || of_digest || '"'
              WHEN day IS NOT NULL THEN day = 'day ' || of_page % 1000 ELSE false END THEN 'resolved'
    ELSE 'validator_mismatch' END AS outcome
  FROM j
)
SELECT record_id, url_key, time, outcome,
  CASE WHEN outcome = 'resolved' THEN of_page * 2 END AS response_id,
  CASE WHEN outcome = 'resolved' THEN of_digest END AS payload_digest,
  CASE WHEN outcome = 'resolved' THEN 'age: ' || age || chr(10) || 'cache-control: max-age=3600' || chr(10)
    || 'content-length: ' || of_size || chr(10) || 'content-type: text/html' || chr(10)
    || 'etag: ' || coalesce(tag, '"' || of_digest || '"') || chr(10)
    || 'last-modified: ' || coalesce(day, 'day ' || of_page % 1000) END AS headers
FROM o
""")
def op1_resolve_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripkit.llm.revisits import records_of_pages, resolve_revisits

    resolved = resolve_revisits(records_of_pages(_table(spark, sf_dir, "pages")))
    lines = F.transform(F.map_entries("merged_headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return resolved.withColumn("headers", F.array_join(F.array_sort(lines), "\n")).drop("merged_headers")


URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


@_query("op3_judge_urls")
def op3_judge_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's URL carries the number of the document it shows, and so the document's labels."""
    from tripkit.llm.url_templates import host_and_path, judge_urls

    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.try_to_number(F.nullif(F.regexp_extract(host_and_path(F.col("url"))[1], r"/(\d{1,18})(?:[./]|$)", 1), F.lit("")), F.lit("9" * 18))
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0)
    labels = _table(spark, sf_dir, "labels").select("doc_id", bad.alias("bad"))
    numbered = pages.select("page_id", number.cast("long").alias("doc_id"))
    return judge_urls(spark, pages, URL_RULES, numbered.join(labels, "doc_id").select("page_id", "bad"))


@_query("op2_scan_secrets")
def op2_scan_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripkit.llm.secret_scan import scan_secrets

    return scan_secrets(_table(spark, sf_dir, "documents"))


@_query("op5_judge_quality")
def op5_judge_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripkit.llm.thresholds import judge_quality

    return judge_quality(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def _remainder(divisor: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


@_query("op6_identify_language")
def op6_identify_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripkit.llm.langid import learn_prototypes, predict_language

    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out")
    prototypes = learn_prototypes(docs.filter(_remainder(4) != 2))
    return predict_language(docs, prototypes, columns=["doc_id", held_out])


@_query("op4_top_products")
def op4_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripkit.llm.topk import top_products

    return top_products(spark, _table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0)


@_query("op7_pack_documents")
def op7_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripkit.llm.packing import pack_documents, public_tokenizer

    return pack_documents(spark, _table(spark, sf_dir, "documents"), public_tokenizer())


@_query("op9_near_duplicates")
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripkit.llm.neardup import near_duplicates

    return near_duplicates(spark, _table(spark, sf_dir, "documents").select("doc_id", "text")).drop("row_key")


@_query("op10_score_language_model")
def op10_score_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripkit.llm.kneser_ney import score_documents

    return score_documents(spark, _table(spark, sf_dir, "documents"), _remainder(7) != 2, order=3)


@_query("op11_mine_collocations", r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p
), f1 AS (
  SELECT lang, g, count(*) AS a FROM (SELECT lang, unnest(ws) AS g FROM w) GROUP BY ALL
), f2 AS (
  SELECT lang, x, y, count(*) AS a FROM (
    SELECT lang, unnest(ws[:-2]) AS x, unnest(ws[2:]) AS y FROM w WHERE len(ws) >= 2) GROUP BY ALL HAVING count(*) >= 10
), f3 AS (
  SELECT lang, x, y, z, count(*) AS a FROM (
    SELECT lang, unnest(ws[:-3]) AS x, unnest(ws[2:-2]) AS y, unnest(ws[3:]) AS z FROM w WHERE len(ws) >= 3) GROUP BY ALL HAVING count(*) >= 10
), n AS (
  SELECT lang, sum(a)::BIGINT AS n FROM f1 GROUP BY lang
), b AS (
  SELECT lang, x, y, max(a) AS longer FROM (SELECT lang, x, y, a FROM f3 UNION ALL SELECT lang, y, z, a FROM f3) GROUP BY ALL
), c AS (
  SELECT lang, x || ' ' || y AS phrase, f2.a, 1 AS k, u.a AS l, v.a AS r
  FROM f2 LEFT JOIN b USING (lang, x, y) JOIN f1 u USING (lang) JOIN f1 v USING (lang)
  WHERE u.g = x AND v.g = y AND 100 * coalesce(longer, 0) < 50 * f2.a
  UNION ALL
  SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, f3.a, 1, u.a, v.a
  FROM f3 JOIN f1 u ON u.lang = f3.lang AND u.g = f3.x JOIN f2 v ON v.lang = f3.lang AND v.x = f3.y AND v.y = f3.z
  UNION ALL
  SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, f3.a, 2, u.a, v.a
  FROM f3 JOIN f2 u ON u.lang = f3.lang AND u.x = f3.x AND u.y = f3.y JOIN f1 v ON v.lang = f3.lang AND v.g = f3.z
), s AS (
  SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM c
), t AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), o AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM t
)
SELECT lang, rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) WHERE rank <= 2000
""")
def op11_mine_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripkit.llm.collocations import collocations

    return collocations(spark, _table(spark, sf_dir, "documents"))


def _lloyd_sql(rounds: int = 4) -> str:
    """Every part against every entry, one pair of subqueries a round."""
    nearest = """a{k} AS MATERIALIZED (
  SELECT vec_id, label, part, x, unnest(min(struct_pack(d := list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, entry := entry)))
  FROM p JOIN c{k} USING (part) GROUP BY vec_id, label, part, x
)"""
    means = """c{n} AS MATERIALIZED (
  SELECT part, entry, coalesce(m, c) AS c FROM c{k} LEFT JOIN (
    SELECT part, entry, list(m ORDER BY j) AS m FROM (
      SELECT part, entry, j, floor(sum(y)::DOUBLE / count(*))::BIGINT AS m
      FROM (SELECT part, entry, unnest(x) AS y, generate_subscripts(x, 1) AS j FROM a{k}) GROUP BY ALL
    ) GROUP BY ALL
  ) USING (part, entry)
)"""
    steps = [q.format(k=k, n=k + 1) for k in range(rounds) for q in (nearest, means)]
    return """WITH e AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
  SELECT vec_id, label, part, list_slice(v, part * (len(v) // 4) + 1, (part + 1) * (len(v) // 4)) AS x FROM e, range(4) AS t(part)
), c0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS c FROM p QUALIFY entry < 256
), """ + ",\n".join([*steps, nearest.format(k=rounds)]) + f""", r AS (
  SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id, label
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM c{rounds}) AS codebooks_sha256
FROM r"""


@_query("op12_compress_vectors", _lloyd_sql())
def op12_compress_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripkit.llm.product_codes import codebooks_digest, compress_vectors, with_label_error

    done = compress_vectors(spark, _table(spark, sf_dir, "embeddings"), ["vec_id", "label"])
    digits = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    return with_label_error(done.rows).select(
        "vec_id", F.array_join(digits, "").alias("code"), "error", "label_error", F.lit(codebooks_digest(done.codebooks)).alias("codebooks_sha256")
    )


@_query("op13_encode_pieces")
def op13_encode_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripkit.llm.pieces import encode_documents, public_model

    encoded = encode_documents(spark, _table(spark, sf_dir, "documents"), public_model())
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
