"""The numbered queries over the given tables and the SQL that checks them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.llm import bpe, decontaminate, lm_score, neardup, packing, pii, prefix_tree, quality, resample, substring, syncmers, toxicity, url_rules
from platewise.llm.registry import documents, query


@query("op1_byte_bpe")
def op1_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of the ids and of the decoded bytes of every document."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(bpe.round_trip(documents(spark, sf), path, public_tokenizers.PATTERN))


@query(
    "op2_substring_dedup",
    r"""WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    windows AS (SELECT doc_id, i, array_to_string(ws[i : i + 12], ' ') AS s FROM docs, unnest(range(1, len(ws) - 11)) AS t(i)),
    firsts AS (SELECT s, min(doc_id) AS origin FROM windows GROUP BY s),
    hits AS (SELECT doc_id, i FROM windows JOIN firsts USING (s) WHERE origin < doc_id),
    gone AS (SELECT DISTINCT doc_id, i + j AS p FROM hits, range(13) AS t(j)),
    words AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM docs),
    kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
    FROM docs LEFT JOIN kept USING (doc_id)""",
)
def op2_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of every document without the 13-word windows of earlier ones."""
    out = substring.remove_repeats(documents(spark, sf), 13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query(
    "op3_near_duplicates",
    r"""WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    shingles AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS s FROM words, unnest(range(1, greatest(len(ws) - 3, 2))) AS t(i) WHERE len(ws) > 0),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (SELECT x, y FROM common JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id WHERE 100 * c >= 75 * (p.n + q.n - c)),
    both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
    reach(doc_id, low) AS (SELECT doc_id, doc_id FROM documents UNION SELECT b.y, r.low FROM reach r JOIN both_ways b ON r.doc_id = b.x)
    SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, min(r.low) AS component_id, d.doc_id = min(r.low) AS kept
    FROM documents d JOIN reach r USING (doc_id) LEFT JOIN sizes s USING (doc_id) GROUP BY d.doc_id, s.n""",
)
def op3_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Component of every document."""
    return neardup.near_duplicates(documents(spark, sf))


def held_out(remainder: int, parts: int):
    """Whether a document belongs to the part whose labels are not learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == remainder


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of two thirds of the ids."""
    docs = documents(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.train(docs, labels.where(~held_out(1, 3)), label="toxic")
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out(1, 3).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op5_quality")
def op5_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality of every document, learned from the labels of three quarters of the ids."""
    docs = documents(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.train(docs, labels.where(~held_out(2, 4)), label="quality")
    scored = quality.score(docs, model)
    return scored.select("doc_id", held_out(2, 4).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op6_syncmers")
def op6_syncmers(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprint of every document, and its likeness to an edited text's and to the next document's."""
    out = syncmers.edited_likeness(documents(spark, sf))
    return out.withColumn("edited_text", F.sha2("edited_text", 256)).withColumnRenamed("edited_text", "edited_sha256")


@query("op7_decontaminate")
def op7_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and the benchmark items whose templates they hold."""
    return decontaminate.find_leaks(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


@query("op8_lm_score")
def op8_lm_score(spark: SparkSession, sf: str) -> DataFrame:
    """Cross-entropy difference of every document between good documents and all."""
    good = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1 AND toxic = 0")
    return lm_score.score(documents(spark, sf), good)


@query("op9_pii")
def op9_pii(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data in every document: counts and digest of the base spans, and the list of all spans."""
    found = pii.find_spans(documents(spark, sf))
    counts = [pii.count_of(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS]
    base = F.sha2(pii.span_list(F.col("base")), 256)
    return found.select("doc_id", *counts, base.alias("base_sha256"), pii.span_list(F.col("spans")).alias("spans"))


# The rules of the contract.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query(
    "op10_url_rules",
    """WITH rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
      ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
    rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS r FROM pages),
    parts AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
    fits AS (SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
      row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC NULLS LAST) AS nth
      FROM parts p LEFT JOIN rules r ON ('.' || p.host LIKE '%.' || r.host) AND starts_with(p.path, r.path))
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE nth = 1""",
)
def op10_url_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Verdict on every page's url."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.match_urls(spark.read.parquet(f"{sf}/pages.parquet"), rules)


# CRC-32 in SQL, which DuckDB has no function for: its table by rule, then one step per byte.
CRC_TABLE_SQL = """SELECT list(list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t FROM range(256) AS r(n)"""


def crc_sql(value: str) -> str:
    """CRC-32 of a string's UTF-8 bytes as an SQL expression; ``t`` is the table's column."""
    coded = f"hex(encode({value}))"
    data = f"list_transform(range(octet_length(encode({value}))), lambda i: CAST('0x' || substr({coded}, 2 * i + 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {data}), lambda c, b: xor(t[1 + (xor(c, b) & 255)], c >> 8)), 4294967295)"


def _letters_sql(text: str) -> str:
    lowered = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op11_resample",
    f"""WITH crc AS ({CRC_TABLE_SQL}),
    docs AS (SELECT doc_id, {_letters_sql("text")} AS ws FROM documents),
    words AS (SELECT doc_id, unnest(ws) AS w FROM docs),
    wanted AS (SELECT unnest({_letters_sql("text")}) AS w FROM benchmark),
    buckets AS (SELECT w, {crc_sql("w")} % 10000 AS k FROM (SELECT w FROM words UNION SELECT w FROM wanted), crc),
    source AS (SELECT k, count(*) AS s FROM words JOIN buckets USING (w) GROUP BY k),
    target AS (SELECT k, count(*) AS t FROM wanted JOIN buckets USING (w) GROUP BY k),
    gains AS (SELECT k, CAST(floor(1000 * ln((CAST(coalesce(t, 0) AS DOUBLE) + 1) * ((SELECT count(*) FROM words) + 10000)
      / ((CAST(s AS DOUBLE) + 1) * ((SELECT count(*) FROM wanted) + 10000)))) AS BIGINT) AS gain FROM source LEFT JOIN target USING (k)),
    sums AS (SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight FROM words JOIN buckets USING (w) JOIN gains USING (k) GROUP BY doc_id),
    scored AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
      coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + CAST(0.5 AS DOUBLE)) / 4294967296))) AS BIGINT) AS score
      FROM docs LEFT JOIN sums USING (doc_id)),
    ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS nth, 10 * count(*) OVER () // 100 AS drawn FROM scored WHERE n_features >= 20)
    SELECT doc_id, n_features, weight, score, nth AS rank FROM scored LEFT JOIN (SELECT * FROM ranked WHERE nth <= drawn) USING (doc_id)""",
)
def op11_resample(spark: SparkSession, sf: str) -> DataFrame:
    """A tenth of the documents, drawn towards the benchmark's words; all documents with weight and score."""
    out = resample.resample(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


@query("op12_packing")
def op12_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Pieces of every document in windows of up to 1024 tokens."""
    return packing.pack(documents(spark, sf), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


@query(
    "op13_prefix_tree",
    rf"""WITH crc AS ({CRC_TABLE_SQL}),
    own AS (SELECT conv_id, turn, struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) AS m FROM conversations WHERE conv_id IS NOT NULL),
    lists AS (SELECT conv_id, list(m ORDER BY turn NULLS FIRST) AS ms FROM own GROUP BY conv_id),
    shared AS (SELECT conv_id, ms, {crc_sql("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM lists, crc),
    whole AS (SELECT c.conv_id, list_concat(coalesce(b.ms[1 : h], []), c.ms[h + 1 :]) AS p FROM shared c LEFT JOIN lists b ON b.conv_id = c.conv_id - c.conv_id % 20),
    members AS (SELECT conv_id, d, p[1 : d] AS node, CASE WHEN d > 0 THEN p[1 : d - 1] END AS up, coalesce(p[d].x, '') AS last, len(p) = d AS ends
      FROM whole, unnest(range(len(p) + 1)) AS t(d)),
    nodes AS (SELECT node, d, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(len(regexp_extract_all(last, '{prefix_tree.WORDS}'))) AS words,
      coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ends FROM members GROUP BY node, d),
    children AS (SELECT up AS node, count(*) AS n FROM nodes WHERE d > 0 GROUP BY up),
    full_nodes AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (node)),
    sums AS (SELECT node[1 : i] AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * words) AS saved FROM full_nodes, unnest(range(d + 1)) AS t(i) GROUP BY ALL)
    SELECT a.conv_id, a.d AS depth, b.conv_id AS parent_conv_id, a.n_convs, a.n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(a.ends) AS ends_sha256
    FROM full_nodes a JOIN sums s USING (node) LEFT JOIN nodes b ON b.node = a.up""",
)
def op13_prefix_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes of the trie of all conversations, which share starts by families of twenty."""
    turns, convs = prefix_tree.rebuilt(prefix_tree.ordered_turns(spark.read.parquet(f"{sf}/conversations.parquet")))
    return prefix_tree.prefix_tree(turns, convs)
