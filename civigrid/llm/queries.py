"""The queries over this subpackage's operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def vocabulary(name: str) -> str:
    """A tokenizer file; every executor has it in the same Python package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civigrid.llm.rabitq import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"), 0.98)


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civigrid.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


# Verdict, host and path of the rules over the pages.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]

SHARDS, SHARD_SEED = 8, 11


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civigrid.llm.licenses import scan

    return scan(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civigrid.llm.tokencount import token_counts

    return token_counts(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), 2048)


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civigrid.llm.lmscore import lm_scores

    return lm_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civigrid.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), 2048)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civigrid.llm.quality import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"))


def op8_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civigrid.llm.sentencepieces import coded

    return coded(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civigrid.llm.langid import identify

    return identify(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civigrid.llm.urlfilter import filter_urls, rules_of

    return filter_urls(table(spark, sf_dir, "pages"), rules_of(spark, URL_RULES))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civigrid.llm.sharding import assigned

    placed = assigned(table(spark, sf_dir, "documents"), SHARDS, SHARD_SEED)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civigrid.llm.infill import restored, transformed

    made = transformed(table(spark, sf_dir, "documents"), seed="1")
    back = F.sha2(restored(F.col("output"), F.col("form")), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), back.alias("restored_sha256"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civigrid.llm.resample import resampled

    drawn = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank", "n_words")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_vectors, op2_minhash, op3_license_scan, op4_token_counts, op5_lm_scores, op6_packing, op7_quality_rules, op8_sentencepieces, op9_language_id, op10_url_filter, op11_sharding, op12_fill_in_middle, op13_resample)
    return {f.__name__: f for f in found}


def sql_licenses() -> str:
    from civigrid.llm.licenses import PHRASES, SHARE, TEMPLATES, needed, words_of

    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    sets = ", ".join(f"('{name}', {sorted(set(w))}, {len(w)}, {needed(len(set(w)), SHARE)})" for name, w in ((name, words_of(t)) for name, t in TEMPLATES.items()))
    base = " OR ".join("(" + " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(ws)) + ")" for ws in PHRASES.values())
    label = "CASE " + " ".join(f"WHEN w[i + {len(ws) - 1}] = 'license' AND w[i] = '{ws[0]}' AND w[i + 1] = '{ws[1]}' THEN '{name}'" for name, ws in PHRASES.items()) + " END"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '{word}') AS w FROM d),
p AS (SELECT r, i - 1 AS pos, {label} AS label FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM w WHERE t LIKE '%license%') WHERE {base}),
b AS (SELECT r, count(*) AS n, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS labels FROM p GROUP BY r),
s(name, words, length, need) AS (VALUES {sets}),
x AS (SELECT name, unnest(words) AS word, length, need, len(words) AS size FROM s),
a AS (SELECT r, i - 1 AS pos, w[i] AS word FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM w)),
k AS (SELECT r, name, size, need, word, unnest([pos // length, pos // length - 1]) AS block FROM a JOIN x USING (word)),
c AS (SELECT r, name, size, need, count(DISTINCT word) AS common FROM k WHERE block >= 0 GROUP BY r, name, size, need, block),
m AS (SELECT r, list(DISTINCT name) AS names, max(common / size) AS contained FROM c WHERE common >= need GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.names, [])))), ','), '') AS labels,
  CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(contained, 0.0)::DOUBLE END AS score
FROM w LEFT JOIN b USING (r) LEFT JOIN m USING (r)"""


def sql_urls() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
    return f"""
WITH u AS (SELECT row_number() OVER () AS r, page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT r, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
k(verdict, r_host, r_path) AS (VALUES {rules}),
f AS (SELECT r, arg_max(r_host || r_path, length(r_host || r_path)) AS rule, arg_max(verdict, length(r_host || r_path)) AS verdict
  FROM s JOIN k ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM s LEFT JOIN f USING (r)"""


WORD = r"[^\x20\x09-\x0D]+"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def sql_components(nodes: str, links: str) -> str:
    """CTEs that give, for each node, the smallest one that it reaches."""
    return f"""reach(node, seen) AS (SELECT node, node FROM ({nodes}) UNION SELECT l.b, r.seen FROM reach r JOIN ({links}) l ON l.a = r.node WHERE l.b > r.seen),
component AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)"""


def sql_vectors() -> str:
    return f"""WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
fine AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
{sql_components("SELECT vec_id AS node FROM embeddings", "SELECT * FROM links")}
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN component ON node = vec_id"""


def sql_minhash() -> str:
    return f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 2), ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
{sql_components("SELECT doc_id AS node FROM documents", "SELECT * FROM links")}
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN component ON node = d.doc_id"""


def sql_quality() -> str:
    from civigrid.llm.quality import LEFT_SHARE, LEFT_WORDS, LINE_FLOOR, LINE_SHARE

    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('s' || source, 'n') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{WORD}') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM d),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM (SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) > 2))),
c AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM g, range(3) x(k) WHERE n > 1 GROUP BY r),
l AS (SELECT r, doc_id, host, array_to_string(x, ' ') AS line, len(x) AS n FROM (SELECT r, doc_id, host, regexp_extract_all({LOWER.format("unnest(string_split(t, chr(10)))")}, '{WORD}') AS x FROM d) WHERE len(x) > 0),
h AS (SELECT host, count(DISTINCT doc_id) AS n FROM d GROUP BY host),
often AS (SELECT host, line FROM (SELECT host, line, count(DISTINCT doc_id) AS n FROM l GROUP BY host, line) x JOIN h USING (host) WHERE x.n > {LINE_FLOOR} AND x.n > h.n * {LINE_SHARE}::DOUBLE),
gone AS (SELECT r, sum(n) AS gone FROM l JOIN often USING (host, line) GROUP BY r),
m AS (SELECT w.*, len(w) AS n_words, coalesce(n_repeat_words, 0) AS n_repeat_words, len(w) - coalesce(gone, 0) AS left_words FROM w LEFT JOIN c USING (r) LEFT JOIN gone USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed, left_words::BIGINT AS left_words, NOT base_failed AND left_words >= {LEFT_WORDS} AND left_words >= {LEFT_SHARE} * n_words AS kept FROM b"""


#: The CRC-32 of a text's bytes, bit by bit.
CRC32 = "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(regexp_extract_all(hex(encode({})), '..'), lambda h: [('0x' || h)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda c, e: xor(xor(c, e) >> 1, (xor(c, e) & 1) * 3988292384)), 4294967295)"


def sql_sharding() -> str:
    return f"""WITH d AS (SELECT doc_id, source, strlen(coalesce(text, '')) + 1 AS size, {CRC32.format("coalesce(text, '')")} AS text_crc32, coalesce('v' || doc_id::VARCHAR, 'n') AS k, coalesce('v' || source, 'n') AS stratum FROM documents),
h AS (SELECT *, ('0x' || substr(md5(concat_ws(':', '{SHARD_SEED}', k, size::VARCHAR, text_crc32::VARCHAR)), 1, 15))::BIGINT AS h, ('0x' || substr(md5('{SHARD_SEED}:' || stratum), 1, 8))::BIGINT / 4294967296::DOUBLE AS phase FROM d),
f AS (SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY h, k, size, text_crc32) - 1 + phase) / count(*) OVER (PARTITION BY stratum) AS f FROM h),
p AS (SELECT *, row_number() OVER (ORDER BY f, stratum) - 1 AS place, count(*) OVER () AS total FROM f)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, (place * {SHARDS} // total)::INT AS shard, (place - (place * {SHARDS} // total * total + {SHARDS - 1}) // {SHARDS})::BIGINT AS slot, NULL::INT AS grown_shard, source FROM p"""


def sql_infill() -> str:
    return """WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
x AS (SELECT *, length(t) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM x),
p AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(prefix || middle || suffix) AS restored_sha256 FROM p"""


def sql_resample() -> str:
    from civigrid.llm.resample import BUCKETS, LEAST_WORDS, PERCENT, SEED

    words = f"regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
x AS (SELECT r, unnest(w) AS word FROM d), y AS (SELECT unnest({words}) AS word FROM benchmark),
b AS (SELECT word, {CRC32.format("word")} % {BUCKETS} AS bucket FROM (SELECT word FROM x UNION SELECT word FROM y)),
s AS (SELECT bucket, count(*) AS s FROM x JOIN b USING (word) GROUP BY bucket), t AS (SELECT bucket, count(*) AS t FROM y JOIN b USING (word) GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM x) + {BUCKETS})::DOUBLE / ((s + 1)::DOUBLE * ((SELECT count(*) FROM y) + {BUCKETS})::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket)),
m AS (SELECT r, sum(gain) AS total FROM x JOIN b USING (word) JOIN g USING (bucket) GROUP BY r),
e AS (SELECT doc_id, len(w) AS n_words, CASE WHEN len(w) = 0 THEN 0 ELSE floor(total::DOUBLE / len(w)) END::BIGINT AS weight, ('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM d LEFT JOIN m USING (r)),
v AS (SELECT doc_id, n_words, weight, (weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score FROM e),
k AS (SELECT *, row_number() OVER (ORDER BY n_words < {LEAST_WORDS}, score DESC, doc_id NULLS FIRST) AS place FROM v)
SELECT doc_id, n_words::BIGINT AS n_features, weight, score, CASE WHEN n_words >= {LEAST_WORDS} AND place <= (SELECT {PERCENT} * count(*) // 100 FROM v WHERE n_words >= {LEAST_WORDS}) THEN place END::BIGINT AS rank, n_words::BIGINT AS n_words FROM k"""


def oracle_sql() -> dict[str, str]:
    return {"op1_vectors": sql_vectors(), "op2_minhash": sql_minhash(), "op3_license_scan": sql_licenses(), "op7_quality_rules": sql_quality(), "op10_url_filter": sql_urls(), "op11_sharding": sql_sharding(), "op12_fill_in_middle": sql_infill(), "op13_resample": sql_resample()}
