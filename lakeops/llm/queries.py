"""Queries of the operators in this folder, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ship import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash import Rule, near_duplicates

    found = near_duplicates(_table(spark, sf_dir, "documents"), Rule(words=4, percent=80))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@_query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import Rule, contamination

    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), Rule(words=10))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@_query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import held_out, score, train

    docs = _table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, _table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@_query
def op4_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mixed

    return mixed(_table(spark, sf_dir, "documents"))


@_query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_runs import dedup_lines

    return dedup_lines(_table(spark, sf_dir, "documents")).select("doc.doc_id", "n_lines", "n_deleted", "text")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACED = r"[^\x20\x09-\x0D]+"

ORACLE["op1_decontaminate"] = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_ALNUM}') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_ALNUM}') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s : s + n - 1], ' ') AS x
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM (SELECT *, least(len(w), 10) AS n FROM i) WHERE n > 0)
),
dw AS (
  SELECT doc_id, s, n, array_to_string(w[s : s + n - 1], ' ') AS x
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM iw))
),
hit AS (SELECT DISTINCT doc_id, s, n, item_id FROM dw JOIN iw USING (n, x)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(v, ',' ORDER BY v)) AS sha
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS v FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(sha, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

ORACLE["op3_minhash_near_dedup"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_SPACED}') AS w FROM documents
),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[s : s + 3], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS s FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (
  SELECT a, b FROM (SELECT l.doc_id AS a, r.doc_id AS b, count(*) AS m FROM s l JOIN s r USING (x) WHERE l.doc_id <> r.doc_id GROUP BY ALL)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * m >= 80 * (na.n + nb.n - m)
),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN n USING (doc_id)
"""

ORACLE["op4_poisson_mix"] = """
WITH z AS (SELECT source, coalesce(sum(length(text)), 0)::BIGINT AS chars FROM documents GROUP BY source),
w AS (SELECT source, chars, floor(sqrt(chars::DOUBLE) * 1048576)::HUGEINT AS weight FROM z),
r AS (
  SELECT source, CASE WHEN chars = 0 THEN 1.0::DOUBLE ELSE
    weight::DOUBLE / (SELECT sum(weight)::DOUBLE FROM w) * 1.0::DOUBLE * (SELECT sum(chars)::DOUBLE FROM w) / chars END AS rate FROM w
),
k AS (SELECT source, rate, unnest(range(0, ceil(rate + 9 * sqrt(rate) + 40)::BIGINT + 1)) AS k FROM r),
p AS (
  SELECT source, k, exp(CASE WHEN k = 0 THEN 0 ELSE k * ln(rate) END - rate
    - sum(CASE WHEN k = 0 THEN 0.0::DOUBLE ELSE ln(k::DOUBLE) END) OVER (PARTITION BY source ORDER BY k)) AS p FROM k
),
c AS (SELECT source, list(c ORDER BY k) AS cdf FROM (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM p) GROUP BY source),
n AS (
  SELECT d.*, len(list_filter(cdf, lambda x: x < ((('0x' || substr(md5('1:' || doc_id), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE)) AS n
  FROM documents d JOIN c ON d.source IS NOT DISTINCT FROM c.source
),
e AS (SELECT * EXCLUDE (n), unnest(range(1, n + 1))::INTEGER AS mix_copy FROM n)
SELECT *, ('0x' || substr(md5('1:' || doc_id || ':' || mix_copy), 1, 13))::BIGINT AS mix_key FROM e
"""


def _line_sql(words: int = 20) -> str:
    # Every line of a run has a word, so a line in a later run of ``words`` words lies in one of ``words`` lines at most.
    steps = "".join(
        f"""r{size} AS MATERIALIZED (
  SELECT * FROM (SELECT doc_id, n, words1, name1, words + lead(words1, {size - 1}) OVER o AS words, md5(name || lead(name1, {size - 1}) OVER o) AS name
  FROM r{size - 1} WINDOW o AS (PARTITION BY doc_id ORDER BY n))
),
"""
        for size in range(2, words + 1)
    )
    gone = " UNION ".join(
        f"""SELECT doc_id, unnest(range(n, n + {size})) AS n
  FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY doc_id, n) AS place FROM r{size} WHERE name IS NOT NULL) WHERE place > 1 AND words >= {words}"""
        for size in range(1, words + 1)
    )
    return f"""
WITH a AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(0, len(ls))) AS pos FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)
),
b AS (SELECT *, regexp_matches(line, '{_SPACED}') AS full_ FROM a),
c AS (SELECT *, sum(full_::INT) OVER (PARTITION BY doc_id ORDER BY pos)::BIGINT - 1 AS n FROM b),
r1 AS MATERIALIZED (SELECT *, words1 AS words, name1 AS name FROM (SELECT doc_id, n, len(regexp_extract_all(line, '{_SPACED}')) AS words1, md5(line) AS name1 FROM c WHERE full_)),
{steps}gone AS ({gone}),
left_ AS (
  SELECT c.doc_id, string_agg(line, chr(10) ORDER BY pos) FILTER (gone.n IS NULL) AS text,
    count(*) FILTER (full_) AS n_lines, count(gone.n) AS n_deleted
  FROM c LEFT JOIN gone ON c.full_ AND gone.doc_id = c.doc_id AND gone.n = c.n GROUP BY c.doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_deleted, 0)::BIGINT AS n_deleted,
  CASE WHEN d.text IS NOT NULL THEN coalesce(left_.text, '') END AS text
FROM documents d LEFT JOIN left_ USING (doc_id)
"""


ORACLE["op7_line_dedup"] = _line_sql()


@_query
def op5_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .compression import quality

    found = quality(_table(spark, sf_dir, "documents"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.col("in_band")).alias("kept"), "ratio", "bad_bytes",
    )


@_query
def op6_viterbi_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .viterbi import token_counts

    return token_counts(_table(spark, sf_dir, "documents"))


@_query
def op9_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..session import scratch_path
    from .warc import lookup, page_keys, read_captures, write_archives, write_index

    pages = _table(spark, sf_dir, "pages")
    root = scratch_path(spark, "archives")
    index = write_index(write_archives(pages, root), root)
    found = read_captures(lookup(page_keys(pages), index), root)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op9_warc_index"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_, sha1(h) AS x FROM p),
b AS (
  SELECT *, list_aggregate(list_transform(range(1, 41), lambda i:
    substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * (strpos('0123456789abcdef', substr(x, i, 1)) - 1)::INTEGER + 1, 4)),
    'string_agg', '') AS bits FROM f
)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + 16 * substr(bits, 5 * i + 1, 1)::INTEGER + 8 * substr(bits, 5 * i + 2, 1)::INTEGER + 4 * substr(bits, 5 * i + 3, 1)::INTEGER
      + 2 * substr(bits, 5 * i + 4, 1)::INTEGER + substr(bits, 5 * i + 5, 1)::INTEGER, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first_ THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_ THEN first_ END AS refers_to
FROM b
"""


@_query
def op10_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import digest, personal_data

    return digest(personal_data(_table(spark, sf_dir, "documents")))


@_query
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffixes import repeated_passages

    found = repeated_passages(_table(spark, sf_dir, "documents"))

    def words(spans: str) -> F.Column:
        return F.aggregate(F.transform(spans, lambda s: (s["end"] - s["start"]).cast("bigint")), F.lit(0).cast("bigint"), lambda a, b: a + b)

    def text(spans: str) -> F.Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select(
        "doc_id", "n_words", words("spans").alias("n_repeated"), words("removed").alias("n_removed"), text("spans").alias("spans"), text("removed").alias("removed"),
    )


ORACLE["op2_suffix_array_dedup"] = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_SPACED}') AS w FROM documents
),
t AS (
  SELECT *, len(w) AS n, ('0x' || substr(md5(array_to_string(w, ' ')), 1, 15))::BIGINT AS c FROM d WHERE len(w) >= 50
),
x AS (SELECT doc_id, n, c, s, md5(array_to_string(w[s + 1 : s + 50], ' ')) AS k FROM (SELECT *, unnest(range(0, n - 49)) AS s FROM t)),
y AS (
  SELECT *, count(*) OVER (PARTITION BY k) AS m, row_number() OVER (PARTITION BY k ORDER BY c, doc_id, s) > 1 AS later FROM x
),
z AS (SELECT doc_id, n, s, later FROM y WHERE m > 1),
i1 AS (SELECT doc_id, n, s, sum((s > coalesce(p, -51) + 50)::INT) OVER (PARTITION BY doc_id ORDER BY s) AS i
  FROM (SELECT *, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS p FROM z)),
a1 AS (SELECT doc_id, n, min(s) AS s, max(s) + 50 AS e FROM i1 GROUP BY doc_id, n, i),
i2 AS (SELECT doc_id, s, sum((s > coalesce(p, -51) + 50)::INT) OVER (PARTITION BY doc_id ORDER BY s) AS i
  FROM (SELECT *, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS p FROM z WHERE later)),
a2 AS (SELECT doc_id, min(s) AS s, max(s) + 50 AS e FROM i2 GROUP BY doc_id, i),
r AS (SELECT doc_id, sum(e - s) AS n_removed, string_agg(s || ':' || e, ',' ORDER BY s) AS removed FROM a2 GROUP BY doc_id)
SELECT doc_id, any_value(n)::BIGINT AS n_words, sum(e - s)::BIGINT AS n_repeated, coalesce(any_value(n_removed), 0)::BIGINT AS n_removed,
  string_agg(s || ':' || e, ',' ORDER BY s) AS spans, coalesce(any_value(removed), '') AS removed
FROM a1 LEFT JOIN r USING (doc_id) GROUP BY doc_id
"""


@_query
def op11_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .interleave import Rule, interleaved

    docs = _table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    # Size and checksum are taken where the text is read; the text itself need not move.
    sized = docs.select("doc_id", "source", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
    return interleaved(sized, Rule(shards=16)).select(
        "doc.doc_id", "doc.size", "doc.text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


# The table of the public CRC-32 checksum comes from its polynomial, 0xEDB88320.
_CRC_SQL = """
crc_table AS MATERIALIZED (
  SELECT list(list_reduce(range(0, 8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) ORDER BY i) AS t
  FROM (SELECT unnest(range(0, 256)) AS i)
)"""


def _crc_sql(text: str) -> str:
    # An initial value keeps the first byte from being taken for the state.
    return f"""xor(4294967295, list_reduce(list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda b: ('0x' || b)::BIGINT),
    lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295::BIGINT))::BIGINT"""


def _unit_sql(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 13))::BIGINT"


ORACLE["op11_interleave"] = f"""
WITH {_CRC_SQL},
d AS (
  SELECT doc_id, coalesce(source, '') AS s, (strlen(coalesce(text, '')) + 1)::BIGINT AS size, {_crc_sql("coalesce(text, '')")} AS text_crc32,
    row_number() OVER (PARTITION BY source ORDER BY {_unit_sql("'1:' || doc_id")}, doc_id) - 1 AS r, count(*) OVER (PARTITION BY source) AS m, source
  FROM documents, crc_table
),
f AS (SELECT *, (r + ({_unit_sql("'1:' || s")}::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE) / m AS share FROM d),
g AS (SELECT *, row_number() OVER (ORDER BY share, source NULLS FIRST, r) - 1 AS n, count(*) OVER () AS k FROM f),
h AS (SELECT *, n * 16 // k AS shard FROM g)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INTEGER AS shard, (n - (shard * k + 15) // 16)::BIGINT AS slot, NULL::INTEGER AS grown_shard FROM h
"""


@_query
def op13_orchard_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .orchard import Rule, clustered

    found = clustered(_table(spark, sf_dir, "embeddings"), Rule(clusters=8, rounds=10, dims=64, scale=1024, seed="3"))
    code = F.sha2(F.array_join(F.transform("centroid", lambda x: x.cast("string")), ","), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", code.alias("centroid_sha256"))


def _cluster_sql(rounds: int = 10) -> str:
    far = "list_sum(list_transform(range(1, 65), lambda i: (k.q[i] - c.q[i]) * (k.q[i] - c.q[i])))::BIGINT"
    steps = "".join(
        f"""a{r} AS MATERIALIZED (
  SELECT vec_id, any_value(q) AS q, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT k.vec_id, k.q, c.c, {far} AS d FROM k, c{r} c) GROUP BY vec_id
),
"""
        + (
            f"""m{r} AS (
  SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS q
  FROM (SELECT c, i, sum(x)::HUGEINT AS s, count(*) AS n FROM (SELECT c, unnest(q) AS x, unnest(range(0, 64)) AS i FROM a{r}) GROUP BY c, i) GROUP BY c
),
c{r + 1} AS MATERIALIZED (SELECT c, coalesce(m.q, o.q)::BIGINT[] AS q FROM c{r} o LEFT JOIN m{r} m USING (c)),
"""
            if r < rounds
            else ""
        )
        for r in range(rounds + 1)
    )
    return f"""
WITH k AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = 64
),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS c, q FROM (SELECT sha256('3:' || vec_id) AS h, q FROM k) ORDER BY h LIMIT 8
),
{steps}t AS (SELECT c, sum(d)::BIGINT AS cluster_inertia FROM a{rounds} GROUP BY c)
SELECT vec_id, c::INTEGER AS cluster, d AS distance, cluster_inertia, (SELECT sum(d)::BIGINT FROM a{rounds}) AS inertia,
  sha256(array_to_string(o.q, ',')) AS centroid_sha256
FROM a{rounds} JOIN t USING (c) JOIN c{rounds} o USING (c)
"""


ORACLE["op13_orchard_clusters"] = _cluster_sql()


@_query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .trie import spliced_trie

    return spliced_trie(_table(spark, sf_dir, "conversations"))


ORACLE["op12_prefix_trie"] = f"""
WITH {_CRC_SQL},
o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS r, count(*) OVER (PARTITION BY conv_id) AS m
  FROM conversations WHERE conv_id IS NOT NULL
),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc_sql("conv_id::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM o), crc_table),
s AS (SELECT c.*, least(h, coalesce(m, 0)) AS taken FROM c LEFT JOIN (SELECT DISTINCT conv_id, m FROM o) b ON b.conv_id = c.base),
u AS (
  SELECT s.conv_id, r AS pos, role, text FROM s JOIN o ON o.conv_id = s.base AND r < h
  UNION ALL SELECT conv_id, taken + r - h, role, text FROM s JOIN o USING (conv_id) WHERE r >= h
),
p AS (
  SELECT conv_id, pos + 1 AS d, length(text) AS chars,
    md5(string_agg(md5(length(role) || ':' || role || text), ',') OVER (PARTITION BY conv_id ORDER BY pos)) AS id FROM u
),
e AS (SELECT conv_id, 0 AS d, 0 AS chars, 'root' AS id FROM c UNION ALL SELECT * FROM p),
member AS (SELECT *, max(d) OVER (PARTITION BY conv_id) AS last FROM e),
n AS (
  SELECT d, id, min(conv_id) AS c, count(*) AS n, any_value(chars) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = last), '')) AS ends FROM member GROUP BY d, id
),
child AS (SELECT m.id, count(*) AS k FROM n JOIN member m ON m.conv_id = n.c AND m.d = n.d - 1 GROUP BY m.id),
v AS (SELECT n.*, coalesce(k, 0) AS k FROM n LEFT JOIN child USING (id)),
sub AS (
  SELECT m.id, sum((v.n - 1) * v.chars) AS saved, count(*) FILTER (v.k = 0) AS leaves FROM v JOIN member m ON m.conv_id = v.c AND m.d <= v.d GROUP BY m.id
),
up AS (SELECT v.id, q.c AS parent FROM v JOIN member m ON m.conv_id = v.c AND m.d = v.d - 1 JOIN v q ON q.id = m.id)
SELECT c AS conv_id, d::BIGINT AS depth, parent AS parent_conv_id, n AS n_convs, k AS n_children, leaves AS n_leaves,
  saved::BIGINT AS saved_tokens, ends AS ends_sha256
FROM v JOIN sub USING (id) LEFT JOIN up USING (id)
"""
