"""The operators as queries over the test tables, with checking SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import dialogue, extendible, graph_search, mixing, ngram_join, packing, ppm, range_join, ranked_search, secrets, token_files, tokens, toxicity, url_filter
from riskloom.session import run_dir

SHARD_BYTES = 1 << 20
QUERY_EVERY = 20
TOXIC = 0.7
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _crc(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string"))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    allowed = F.coalesce(_crc() % 3 != 1, F.lit(False))
    models = toxicity.train(docs, _table(spark, sf_dir, "labels"), allowed)
    held_out = F.coalesce(_crc() % 3 == 1, F.lit(False)).alias("held_out")
    scored = toxicity.score(docs.select("doc_id", held_out, "text"), models)
    return scored.withColumn("predicted", (F.col("score") >= TOXIC).cast("int"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = extendible.shards(docs, ["doc_id"], "n_bytes", SHARD_BYTES, F.octet_length("text"), F.col("text"))
    return found.select("doc_id", "n_bytes", "copy", "shard", "depth", "shard_bytes", "shard_rows", "oversized")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_dir(spark, "token-ids")
    token_files.write_ids(_table(spark, sf_dir, "documents"), folder, tokens.tokenizer_path())
    return token_files.index(spark, folder)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pieces(_table(spark, sf_dir, "documents"), tokens.tokenizer_path())
    return packing.best_fit(found).drop("row")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(_table(spark, sf_dir, "documents")).drop("source_id")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_join.range_join(_table(spark, sf_dir, "embeddings"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.nearest_rows(_table(spark, sf_dir, "embeddings"), QUERY_EVERY)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(_crc() % 10 == 0, F.lit(False))
    return ppm.ppm_scores(docs, ~held_out).withColumn("held_out", held_out)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.ngram_join(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.secret_scan(docs, run_dir(spark, "secrets"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of the rows with faults put in by a hash of conv_id and turn."""
    blank = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    kind = F.crc32(name) % 20
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(kind == 4, "user").otherwise(role)
    left = rows.where(kind != 0)
    copies = F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return left.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations")
    place = run_dir(spark, "dialogue")
    found = dialogue.digest(dialogue.repair(damaged(rows), place), place).withColumnRenamed("conv_id", "of")
    joined = rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    zeros = dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), F.lit(0).cast("long"))
    without = {**zeros, "audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    return joined.select("conv_id", *[F.coalesce(c, without[c]).alias(c) for c in without])


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = url_filter.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


QUERIES = {
    "op1_pu_toxicity": op1,
    "op2_extendible_sharding": op2,
    "op3_orc_token_ids": op3,
    "op4_best_fit_packing": op4,
    "op5_source_mixing": op5,
    "op6_metric_range_join": op6,
    "op7_pruned_graph_search": op7,
    "op8_ppm_scores": op8,
    "op9_ngram_jaccard_join": op9,
    "op10_secret_linking": op10,
    "op11_ranked_search": op11,
    "op12_conversation_repair": op12,
    "op13_url_trie": op13,
}

#: Shards: every level's buckets from the whole hash, and the first level that fits.
OP2_SQL = f"""
WITH sized AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS n_bytes, md5(coalesce(text, '')) AS tie FROM documents
), copies AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tie) - 1 AS copy FROM sized
), hashed AS (
  SELECT *, lpad(bin(('0x' || substr(md5(concat_ws('|', coalesce(doc_id::VARCHAR, ''), copy::VARCHAR)), 1, 16))::UBIGINT),
                 64, '0') AS bits FROM copies
), levels AS (
  SELECT h.*, l.depth, substr(h.bits, 1, l.depth) AS prefix
  FROM hashed h, (SELECT unnest(range(0, 65))::INT AS depth) l
), buckets AS (
  SELECT depth, prefix, sum(n_bytes)::BIGINT AS shard_bytes, count(*)::BIGINT AS shard_rows
  FROM levels GROUP BY depth, prefix
), fitting AS (
  SELECT l.doc_id, l.n_bytes, l.copy, l.bits, b.*,
         row_number() OVER (PARTITION BY l.doc_id, l.copy ORDER BY b.depth) AS rank
  FROM levels l JOIN buckets b ON l.depth = b.depth AND l.prefix = b.prefix
  WHERE b.shard_bytes <= {SHARD_BYTES} OR b.shard_rows = 1 OR b.depth = 64
)
SELECT doc_id, n_bytes, copy::BIGINT AS copy, prefix AS shard, depth, shard_bytes, shard_rows,
       shard_bytes > {SHARD_BYTES} AS oversized
FROM fitting WHERE rank = 1
"""

#: Links between texts that share a shingle, then the smallest document reached.
OP9_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
         ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM words, unnest(range(1, greatest(len(w) - 3, 2)::BIGINT)) AS t(i)
  WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = d.doc_id
"""

#: Every document's score for every item, then the best.
OP11_SQL = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), totals AS (
  SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM words WHERE len(w) > 0
), asked AS (
  SELECT item, item_id, term, count(*) AS times FROM (
    SELECT item, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT *, row_number() OVER () AS item FROM benchmark))
  GROUP BY ALL
), held AS (
  SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, len(w) AS n, unnest(w) AS term FROM words)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), totals
), scored AS (
  SELECT item, item_id, row, doc_id,
         sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term), totals GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def _op12_sql() -> str:
    """The cheapest way to each of the four states, message by message, as (c)ost, (a)udit and (o)utput."""

    def grown(way: str, edit: str, cost: str, line: str = "''") -> str:
        return f"{{'c': {way}.c + {cost}, 'a': {way}.a || '{edit}', 'o': {way}.o || {line}}}"

    def inserted(way: str, role: str) -> str:
        return grown(way, "I", "2", f"chr(10) || '{role}:'")

    def spoken(way: str, initial: str, role: str = "") -> list[str]:
        never = "CASE WHEN fault = 2 THEN 1000000000 ELSE 0 END + fault"
        kept = f"CASE WHEN role[1:1] = '{initial}' THEN 0 ELSE 1000000000 END + {never}"
        ways = [grown(way, "K", kept, "chr(10) || role || ':' || text") for way in way.split()]
        if role:
            ways += [grown(w, "R", f"2 + {never}", f"chr(10) || '{role}:' || text") for w in way.split()]
        return ways

    def least(*ways: str) -> str:
        return f"list_min([{', '.join(ways)}])"

    def closed(way: str) -> str:
        return inserted(f"({inserted(way, 'user')})", "assistant")

    far = "{'c': 1000000000::BIGINT, 'a': '', 'o': ''}"
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE bits AS (
  SELECT n, n::BIGINT AS c, 0 AS i FROM range(256) t(n)
  UNION ALL SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i + 1 FROM bits WHERE i < 8
), crc AS (
  SELECT list(c ORDER BY n) AS t FROM bits WHERE i = 8
), named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')) AS name
  FROM conversations
), kinds AS (
  SELECT name, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(name, ''), lambda x: ascii(x)::BIGINT)),
                               lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM (SELECT DISTINCT name FROM named), crc
), damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM named JOIN kinds USING (name), LATERAL (SELECT unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))) copies
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
         rtrim(text, {blanks}) AS solid FROM damaged
), judged AS (
  SELECT *, CASE WHEN solid = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS kind,
         CASE WHEN kind IN ('blank', 'duplicate') THEN 2 WHEN kind = 'truncated' THEN 1 ELSE 0 END AS fault,
         lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1:1] AS pair
  FROM ordered
), walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 'o': ''}} AS b0, {far} AS b1, {far} AS b2, {far} AS b3 FROM judged
  UNION ALL
  SELECT conv_id, i, {grown("c0", "D", "3")}, {least(grown("c1", "D", "3"), *spoken("c0", "s"))},
         {least(grown("c2", "D", "3"), *spoken("c0 c1 c3", "u", "user"))},
         {least(grown("c3", "D", "3"), *spoken("c2", "a", "assistant"))}
  FROM (
    SELECT *, {least("c3_", inserted("c2", "assistant"))} AS c3 FROM (
      SELECT w.conv_id, j.i, role, text, fault, b0 AS c0, b1 AS c1, b3 AS c3_,
             {least("b2", inserted("b0", "user"), inserted("b1", "user"), inserted("b3", "user"))} AS c2
      FROM walk w JOIN judged j ON w.conv_id IS NOT DISTINCT FROM j.conv_id AND j.i = w.i + 1
    )
  )
), best AS (
  SELECT conv_id, arg_max({least("b0", closed("b1"), inserted("b2", "assistant"), "b3")}, i) AS way
  FROM walk GROUP BY conv_id
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (kind = 'blank') AS blank,
         count(*) FILTER (kind = 'duplicate') AS duplicate, count(*) FILTER (kind = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(way.c, 0)::BIGINT AS cost,
       coalesce(way.a, '') AS audit, sha256(coalesce(substr(way.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN best b ON o.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
"""


OP12_SQL = _op12_sql()

#: The rules one by one, the longest first.
OP13_SQL = r"""
WITH behind AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), cut AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM behind
), ruled AS (
  SELECT *, CASE
    WHEN '.' || host LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN '.' || host LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN '.' || host LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN '.' || host LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule
  FROM cut
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

ORACLES = {
    "op2_extendible_sharding": OP2_SQL,
    "op9_ngram_jaccard_join": OP9_SQL,
    "op11_ranked_search": OP11_SQL,
    "op12_conversation_repair": OP12_SQL,
    "op13_url_trie": OP13_SQL,
}
