"""The registered queries of this package, over whole tables, and their checks."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agentlake.llm import ann, buckets, hard_negatives, jaccard, language, lines, lm, mixing, quality, resync, spelling, token_packs, urls
from agentlake.llm.text import LOWER, UPPER, crc_rest
from agentlake.session import configure

#: Vocabulary of a public tokenizer; any rank file will do.
RANKS = "file:///opt/tokenizers/byte_bpe_50k.tiktoken"

#: Name of a public sentence-piece model.
PIECES = "piece_bpe_32k.model"

#: The rules for hosts and paths.
URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: Rows of a table handed to Python at a time; texts may be long.
PYTHON_ROWS = "2000"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def settings(spark: SparkSession) -> SparkSession:
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", PYTHON_ROWS)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return settings(spark).read.parquet(f"{folder}/{name}.parquet")


def query(check: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = build
        if check is not None:
            CHECKS[build.__name__] = check
        return build

    return register


@query()
def op1_token_packs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return token_packs.pack_tokens(docs, token_packs.load_ranks(spark, RANKS))


@query()
def op2_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score_documents(table(spark, folder, "documents"))


#: Levels follow from sorting the sources by size per weight.
MIX = """
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source) AS rn
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, CAST(CASE (rn - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight FROM sources
), ranked AS (
  SELECT *, sum(source_size) OVER () AS total,
         coalesce(sum(source_size) OVER (ORDER BY source_size / weight, rn
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped,
         sum(weight) OVER (ORDER BY source_size / weight, rn
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
         row_number() OVER (ORDER BY source_size / weight, rn) AS place
  FROM weighed
), levels AS (
  SELECT *, (1.5 * total - 2.0 * stopped) / open_weight AS level FROM ranked
), level AS (
  SELECT arg_min(level, place) AS level FROM levels WHERE level * weight <= 2.0 * source_size
), targets AS (
  SELECT source, source_size,
         CASE WHEN 2.0 * source_size <= weight * l.level THEN 2.0 * source_size ELSE weight * l.level END AS target
  FROM weighed, level l
)
SELECT d.doc_id, d.size, t.source_size, CAST(t.target AS DOUBLE) AS target,
       CAST(CASE WHEN t.source_size = 0 THEN 0 ELSE d.size * (floor(t.target / t.source_size)
         + CASE WHEN CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) / 281474976710656.0
                < t.target / t.source_size - floor(t.target / t.source_size) THEN 1 ELSE 0 END) END AS BIGINT) AS taken
FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
"""


@query(MIX)
def op3_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, folder, "documents"))
    taken = (F.col("mix.size") * F.col("mix.copies")).cast("long").alias("taken")
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", taken)


@query()
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", crc_rest(F.col("doc_id"), 4) == 2)
    model = language.fit(docs.filter("NOT held_out"))
    found = language.identify(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "language.lang_pred", "language.score")


@query()
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    judged = quality.judge_quality(docs.select("doc_id", "text"), quality.references(docs))
    return judged.select("doc_id", "quality.*")


@query()
def op6_ann_graph(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "embeddings")
    index = ann.build_index(items, "vec_id", "embedding")
    return ann.search(index, items.filter("vec_id % 20 = 0"), "vec_id", "embedding", k=20)


GROUPS = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), placed AS (
  SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, least(len(w), 1)))) AS i FROM worded
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM placed
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 90 * (p.n + q.n - c)
), ways AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, w.y FROM reach r JOIN ways w ON r.other = w.x
), least AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, l.component_id
FROM documents d JOIN least l USING (doc_id) LEFT JOIN sizes s USING (doc_id)
"""


@query(GROUPS)
def op7_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    found, _ = jaccard.jaccard_groups(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query()
def op8_length_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return buckets.length_buckets(table(spark, folder, "documents"))


@query()
def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    judged = urls.filter_urls(pages, URL_RULES)
    return judged.select("page_id", *[f"url_filter.{c}" for c in ("host", "path", "rule", "verdict", "score")])


LINES = f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, unnest(parts) AS line, unnest(generate_series(1, len(parts))) AS pos FROM split
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
  FROM lines
), owners AS (
  SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), judged AS (
  SELECT k.*, coalesce(o.owner < k.doc_id, false) AS dropped FROM keyed k LEFT JOIN owners o ON k.key = o.key
)
SELECT doc_id, count(*) AS n_lines, count_if(dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query(LINES)
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    deduped = lines.dedup_lines(table(spark, folder, "documents"))
    sha = F.sha2(F.col("lines.kept").cast("binary"), 256).alias("kept_sha256")
    return deduped.select("doc_id", "lines.n_lines", "lines.n_dropped", sha)


#: crc32 as its polynomial defines it, a byte at a time by a table of 256.
SPELLINGS = f"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)
), runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[a-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run
  FROM documents
), distinct_runs AS (
  SELECT id, run, count(*) AS c, hex(encode(id || ':' || run)) AS h FROM runs WHERE length(run) >= 6 GROUP BY id, run
), coded AS (
  SELECT run, c, xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(range(len(h) // 2), lambda i: CAST('0x' || h[2 * i + 1:2 * i + 2] AS BIGINT))),
           lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS code
  FROM distinct_runs, crc
), formed AS (
  SELECT CASE WHEN code % 199 = 0 THEN substr(run, 1, code % length(run)) || substr(run, code % length(run) + 2) ELSE run END AS word, c
  FROM coded
), words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM formed WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5
), placed AS (
  SELECT word, n, unnest(range(length(word))) AS spot FROM words
), shorter AS (
  SELECT word, n, spot, substr(word, 1, spot) || substr(word, spot + 2) AS rest FROM placed
), near AS (
  SELECT word, rest AS other FROM shorter WHERE rest IN (SELECT word FROM words)
  UNION SELECT rest, word FROM shorter WHERE rest IN (SELECT word FROM words)
  UNION SELECT a.word, b.word FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.spot = b.spot AND a.word <> b.word
), counted AS (
  SELECT a.word, a.other, w.n AS other_n, count(*) OVER (PARTITION BY a.word) AS n_near,
         row_number() OVER (PARTITION BY a.word ORDER BY w.n DESC, a.other) AS place
  FROM near a JOIN words w ON w.word = a.other
), forms AS (
  SELECT w.word, w.n, coalesce(c.n_near, 0) AS n_near,
         CASE WHEN c.other_n >= 5 * w.n THEN c.other END AS form,
         CASE WHEN c.other_n >= 5 * w.n THEN c.other_n END AS form_n
  FROM words w LEFT JOIN counted c ON c.word = w.word AND c.place = 1
), ways AS (
  SELECT word, word AS root, 0 AS steps FROM forms
  UNION ALL SELECT y.word, f.form, y.steps + 1 FROM ways y JOIN forms f ON f.word = y.root WHERE f.form IS NOT NULL
), roots AS (
  SELECT word, arg_max(root, steps) AS root FROM ways GROUP BY word
)
SELECT f.word, f.form, r.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n FROM forms f JOIN roots r USING (word)
"""


@query(SPELLINGS)
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents"))


HARD = """
WITH base AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM base a JOIN base b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
), positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
), hard AS (
  SELECT p.anchor_id, p.other AS positive_id, n.other AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) AS rank
  FROM positives p JOIN scored n
    ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM hard WHERE rank <= 5
"""


@query(HARD)
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    items = table(spark, folder, "embeddings").withColumn("label", label)
    return hard_negatives.hard_negatives(items, F.col("vec_id") % 100 == 0)


@query()
def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    with open(public_tokenizers.path(PIECES), "rb") as file:
        model = file.read()
    return resync.count_tokens(table(spark, folder, "documents"), model)
