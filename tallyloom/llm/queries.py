"""The queries of this subpackage over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (archives, decontaminate, dualtree, importance, jaccard, language, packing,
               projections, recompression, secrets, suffixes, toxicity, turn_trie)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = secrets.find_secrets(docs, secrets.ratios(secrets.labelled(docs)))
    base = F.filter("spans", lambda s: s["kind"] < 3)

    def of(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"),
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"), of(3).alias("n_markov"))


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_hits(table(spark, folder, "documents"),
                                    table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        decontaminate.digest(F.col("items")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS k
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM phrases),
win AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)),
hits AS (SELECT doc_id, i, n, item_id FROM win JOIN phrases USING (n, k)),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    profiles = language.learned(docs)
    return language.predict(docs.select("doc_id", "text"), profiles).select(
        "doc_id", F.coalesce(language.third(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
        "lang_pred", "score")


def vocabulary() -> str:
    """Where the packing query finds its vocabulary; the operator takes any path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), vocabulary())


def op5_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = projections.near_duplicates(table(spark, folder, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id",
                        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


OP5_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
link(x, y) AS (
  SELECT a.vec_id, b.vec_id FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach(x, y) AS (
  SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
own AS (SELECT x, count(*) AS n_links FROM link GROUP BY x),
part AS (SELECT x, min(y) AS least FROM reach GROUP BY x)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links,
       least(vec_id, coalesce(part.least, vec_id)) AS component_id,
       vec_id <= coalesce(part.least, vec_id) AS kept
FROM v LEFT JOIN own ON vec_id = own.x LEFT JOIN part ON vec_id = part.x
"""


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return recompression.dedup_substrings(table(spark, folder, "documents"))


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k
  FROM d, unnest(range(1, len(w) - 11)) AS t(i)),
least AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p
  FROM win JOIN least USING (k) WHERE m < doc_id),
lists AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
kept AS (
  SELECT doc_id, w, coalesce(ps, []) AS ps FROM d LEFT JOIN lists USING (doc_id))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(ps) AS BIGINT) AS n_removed,
       sha256(array_to_string(
         list_filter(w, lambda x, j: NOT list_contains(ps, j)), ' ')) AS kept_sha256
FROM kept
"""


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.dedup_bytes(table(spark, folder, "documents"))


def op8_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(table(spark, folder, "documents"),
                               table(spark, folder, "labels"))


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    return archives.round_trip(table(spark, folder, "pages"), spark).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload,
         sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (
  SELECT payload_digest AS d, min(page_id) AS first_id FROM p
  WHERE octet_length(payload) >= 100 GROUP BY 1)
SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p LEFT JOIN f ON payload_digest = d
"""


def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join_similar(table(spark, folder, "documents")).select(
        "doc_id", "class_id", "n_links", "component_id", "kept")


OP10_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS k
  FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b USING (k) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT x, y, c = nx.n AND c = ny.n AS same
  FROM p JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id
  WHERE c >= 0.8 * (nx.n + ny.n - c)),
reach(x, y) AS (
  SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
own AS (
  SELECT x, count(*) AS n_links, min(CASE WHEN same THEN y END) AS first_same
  FROM link GROUP BY x),
part AS (SELECT x, min(y) AS least FROM reach GROUP BY x)
SELECT doc_id, least(doc_id, coalesce(first_same, doc_id)) AS class_id,
       CAST(coalesce(n_links, 0) AS BIGINT) AS n_links,
       least(doc_id, coalesce(part.least, doc_id)) AS component_id,
       doc_id <= coalesce(part.least, doc_id) AS kept
FROM d LEFT JOIN own ON doc_id = own.x LEFT JOIN part ON doc_id = part.x
"""


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return turn_trie.prefix_trie(table(spark, folder, "conversations"))


OP12_SQL = """
WITH RECURSIVE turns AS (
  SELECT conv_id, turn, length(coalesce(text, '')) AS size,
         substr(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '')
                       || coalesce(text, '')), 1, 32) AS name
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({'name': name, 'size': size} ORDER BY turn NULLS FIRST, name, size) AS ts
  FROM turns GROUP BY conv_id),
crc(conv_id, bits, k, v) AS (
  SELECT conv_id, 8 * strlen(CAST(conv_id AS VARCHAR)), 0, 4294967295 FROM own
  UNION ALL
  SELECT conv_id, bits, k + 1, CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END
  FROM (SELECT *, CASE WHEN k % 8 = 0
                  THEN xor(v, ascii(substr(CAST(conv_id AS VARCHAR), k // 8 + 1, 1))::BIGINT)
                  ELSE v END AS x FROM crc WHERE k < bits)),
hs AS (SELECT conv_id, xor(v, 4294967295) % 6 AS h FROM crc WHERE k = bits),
built AS (
  SELECT o.conv_id, list_concat(coalesce(f.ts, [])[1:h], o.ts[h + 1:]) AS ts
  FROM own o JOIN hs USING (conv_id) LEFT JOIN own f ON f.conv_id = o.conv_id - o.conv_id % 100),
steps AS (
  SELECT conv_id, len(ts) AS n, d, ts[d].size AS size,
         array_to_string(list_transform(ts[:d], lambda t: t.name), '') AS k,
         CASE WHEN d > 0 THEN
           array_to_string(list_transform(ts[:d - 1], lambda t: t.name), '') END AS parent
  FROM built, unnest(range(0, len(ts) + 1)) AS u(d)),
nodes AS (
  SELECT k, any_value(d) AS depth, any_value(parent) AS parent, min(conv_id) AS conv_id,
         count(*) AS n_convs, (count(*) - 1) * coalesce(any_value(size), 0) AS own,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                         FILTER (WHERE n = d), '')) AS ends_sha256
  FROM steps GROUP BY k),
kids AS (SELECT parent AS k, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent),
below AS (
  SELECT substr(n.k, 1, 32 * CAST(u.d AS BIGINT)) AS k, sum(own) AS saved_tokens,
         count(*) FILTER (WHERE kids.k IS NULL) AS n_leaves
  FROM nodes n LEFT JOIN kids USING (k), unnest(range(0, n.depth + 1)) AS u(d) GROUP BY 1)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
       CAST(coalesce(n_children, 0) AS BIGINT) AS n_children, b.n_leaves,
       CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b USING (k) LEFT JOIN kids USING (k) LEFT JOIN nodes p ON n.parent = p.k
"""


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return dualtree.rank_documents(table(spark, folder, "documents"),
                                   table(spark, folder, "benchmark"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS no, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT row_number() OVER () AS item, item_id, list_distinct(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM benchmark),
it AS (SELECT item, item_id, unnest(w) AS t FROM b),
total AS (SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
tf AS (
  SELECT no, doc_id, len(w) AS n, t, count(*) AS tf
  FROM (SELECT no, doc_id, w, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM it)
  GROUP BY no, doc_id, len(w), t),
wt AS (
  SELECT t, CAST(floor(1000 * ln((2 * total.n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))
                 AS BIGINT) AS w
  FROM tf, total GROUP BY t, total.n),
scored AS (
  SELECT item, item_id, no, doc_id,
         CAST(sum(wt.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (
           10 + (90 * tf.n * total.n) // total.l)))) AS BIGINT) AS score
  FROM it JOIN wt USING (t) JOIN tf USING (t), total GROUP BY item, item_id, no, doc_id),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST, no) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def llm_queries() -> dict[str, Query]:
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_decontaminate": op2_decontaminate,
        "op3_language_id": op3_language_id,
        "op4_best_fit_packing": op4_best_fit_packing,
        "op5_embedding_near_dedup": op5_embedding_near_dedup,
        "op6_substring_dedup": op6_substring_dedup,
        "op7_suffix_dedup": op7_suffix_dedup,
        "op8_importance_resampling": op8_importance_resampling,
        "op9_warc": op9_warc,
        "op10_jaccard_join": op10_jaccard_join,
        "op11_toxicity": op11_toxicity,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_ranked_search": op13_ranked_search,
    }


def llm_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express."""
    return {"op2_decontaminate": OP2_SQL, "op5_embedding_near_dedup": OP5_SQL,
            "op6_substring_dedup": OP6_SQL, "op9_warc": OP9_SQL, "op10_jaccard_join": OP10_SQL,
            "op12_prefix_trie": OP12_SQL, "op13_ranked_search": OP13_SQL}
