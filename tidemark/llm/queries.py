"""One named query for each text operator, with its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ball_tree, curriculum, decontamination, language_id, line_quality, piece_bpe, secret_scan, simhash, toxicity, transcripts,
    unigram_count, url_filter, whitening,
)
from .common import fold, prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Fixed rules of the URL query.
URL_RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
)


@query("""
WITH rest AS (
  SELECT page_id, url,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, url,
         translate(regexp_extract(rest, '^[^/?#]*'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest),
keyed AS (
  SELECT *, CASE WHEN regexp_replace(host, '^www\\.', '') <> ''
                 THEN regexp_replace(host, '^www\\.', '') || regexp_replace(path, '/+$', '') END AS key
  FROM parts),
listed AS (SELECT DISTINCT key FROM keyed WHERE key IS NOT NULL AND contains(url, '?utm_')),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1')
      THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/')
      THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM keyed)
SELECT page_id, host, path, rule,
       rule IS NULL AND key IS NOT NULL AND key IN (SELECT key FROM listed) AS listed,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN key IS NOT NULL AND key IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
""")
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page; listed are the addresses that are also spread through tracked links."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    tracked = pages.filter(F.col("url").contains("?utm_"))
    found = url_filter.url_filter(pages, tracked, URL_RULES)
    return found.select("page_id", "host", "path", "rule", "listed", "verdict")


@query(r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item, least(len(words), 10) AS n, array_to_string(words[i:i + 9], ' ') AS w
  FROM (SELECT item, words, unnest(generate_series(1, greatest(1, len(words) - 9))) AS i FROM b WHERE len(words) > 0)),
places AS (
  SELECT rid, n, i, array_to_string(words[i:i + n - 1], ' ') AS w
  FROM (SELECT rid, words, n, unnest(generate_series(1, len(words) - n + 1)) AS i
        FROM d JOIN (SELECT DISTINCT n FROM windows) ON len(words) >= n)),
hits AS (SELECT rid, i, n, item FROM places JOIN windows USING (n, w)),
covered AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(t.n, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(c.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c USING (rid) LEFT JOIN items t USING (rid)
""")
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside windows of benchmark items, and the items that occur."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find_hits(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", decontamination.hit_words().alias("n_hit"),
        F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("hit_items")), 256).alias("items_sha256"),
        (F.size("hit_starts") > 0).alias("contaminated"),
    )


@query(r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, source,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
win AS (
  SELECT rid, i, array_to_string(words[i:i + 4], ' ') AS w
  FROM (SELECT rid, words, unnest(generate_series(1, len(words) - 4)) AS i FROM d WHERE len(words) >= 5)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS n FROM win) WHERE n > 1),
covered AS (
  SELECT rid, sum(least(5, coalesce(following - i, 5))) AS n
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS following FROM twice) GROUP BY rid),
lines AS (
  SELECT rid, source, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS lw
  FROM (SELECT rid, source, text, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dups AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY rid),
normal AS (
  SELECT rid, source, len(lw) AS n, regexp_replace(lower(array_to_string(lw, ' ')), '[0-9]', '0', 'g') AS line
  FROM lines),
often AS (SELECT source, line FROM normal GROUP BY source, line HAVING count(DISTINCT rid) > 20),
gone AS (
  SELECT l.rid, sum(l.n) AS n
  FROM normal l JOIN often o ON l.source IS NOT DISTINCT FROM o.source AND l.line = o.line GROUP BY l.rid),
counts AS (
  SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dups.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(gone.n, 0) AS BIGINT) AS removed_words
  FROM d LEFT JOIN covered USING (rid) LEFT JOIN dups USING (rid) LEFT JOIN gone USING (rid)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts)
SELECT *, NOT base_failed AND n_words - removed_words >= 0.5 * n_words AND n_words - removed_words >= 10 AS kept
FROM judged
""")
def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document, and the verdict on lines its source repeats."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_quality.quality_rules(docs).drop("source")


@query()
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; languages are learnt from two of three folds only."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.train(docs.filter(fold("doc_id") != 1))
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(fold("doc_id") == 1, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


@query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels are learnt from two of three folds only."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs.filter(fold("doc_id") != 1), labels.filter(fold("doc_id") != 1))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(fold("doc_id") == 1, F.lit(False)).alias("held_out"), "score", "predicted"
    )


@query()
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: the base rules' spans and the network's."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.scan(docs, secret_scan.train(docs)).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"
    )


@query()
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document, links at four or fewer differing bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def piece_model() -> str:
    """The public SentencePiece BPE model that is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query()
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with an end id and decoded again, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_bpe.encode_documents(docs, piece_model()).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"
    )


@query()
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram tokens of every document, with the pieces and scores of the public model."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return unigram_count.count_tokens(docs, piece_model()).select("doc_id", "n_tokens", "score")


#: Ways in which transcripts name their speakers: system, user, assistant; what follows a turn.
TRANSCRIPT_STYLES = (
    ("System: ", "User: ", "Assistant: ", ""),
    ("[system] ", "[human] ", "[ai] ", "\n"),
    ("### Instructions:\n", "### Question:\n", "### Answer:\n", "\n"),
    ("**Context:** ", "**Q:** ", "**A:** ", ""),
    ("<system>\n", "<customer>\n", "<bot>\n", "\n"),
)


def raw_transcripts(conversations: DataFrame) -> DataFrame:
    """``(conv_id, seq, role, text)``: conversations as raw text in one of the styles.

    One turn in eight lacks its marker, by a hash of its place.
    """
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(TRANSCRIPT_STYLES)))
    lacks = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(8)) == 0
    marker = after = F.lit("")
    for i, (*markers, end) in enumerate(TRANSCRIPT_STYLES):
        for role, text in zip(transcripts.ROLES, markers, strict=True):
            marker = F.when((style == i) & (F.col("role") == role), F.lit(text)).otherwise(marker)
        after = F.when(style == i, F.lit(end)).otherwise(after)
    text = F.concat(F.when(lacks, "").otherwise(marker), F.coalesce("text", F.lit("")), after)
    return conversations.select("conv_id", F.col("turn").alias("seq"), "role", text.alias("text"))


@query()
def op10_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles and canonical turns of all conversations, recovered from raw transcripts.

    The model learns from two of three folds of the conversations.
    """
    raw = raw_transcripts(table(spark, sf_dir, "conversations"))
    model = transcripts.train(raw.filter(fold("conv_id") != 1))
    return transcripts.parse(raw.drop("role"), model)


#: Weight schedules of the mix, dealt to the sources in order; they weigh 3, 1 and 2 over all times.
MIX_SCHEDULES = (((0.0, 4.5), (1.0, 1.5)), ((0.0, 0.5), (1.0, 1.5)), ((0.0, 2.0), (1.0, 2.0)))


@query(r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r
  FROM d GROUP BY source),
weighed AS (
  SELECT source, n, CASE r % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS w,
         CASE r % 3 WHEN 0 THEN 4.5 WHEN 1 THEN 0.5 ELSE 2.0 END::DOUBLE AS first,
         CASE r % 3 WHEN 0 THEN -3.0 WHEN 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS slope,
         1.5::DOUBLE * (SELECT sum(n) FROM s)::DOUBLE AS budget
  FROM s),
steps AS (
  SELECT *, row_number() OVER w AS i,
         (budget - 2.0::DOUBLE * coalesce(sum(n) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / (sum(w * 1000000) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS rate
  FROM weighed WINDOW w AS (ORDER BY 2.0 * n / w, source NULLS LAST)),
rates AS (
  SELECT coalesce((SELECT rate FROM steps WHERE 2.0 * n >= rate * w * 1000000 ORDER BY i LIMIT 1),
                  'infinity'::DOUBLE) AS rate),
targets AS (
  SELECT source, n, w, first, slope,
         CASE WHEN n = 0 THEN 0.0 ELSE least(2.0::DOUBLE * n::DOUBLE, (w * 1000000) * rate) END::DOUBLE AS target
  FROM weighed, rates),
placed AS (
  SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         AS before
  FROM d),
mixed AS (
  SELECT p.doc_id, p.size, t.n, t.target, t.w, t.first, t.slope, before,
         greatest(0, least(p.size, CAST(floor(t.target + 0.5) AS BIGINT) - before)) AS once,
         greatest(0, least(p.size, CAST(floor(t.target + 0.5) AS BIGINT) - before - t.n)) AS twice
  FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source),
reached AS (
  SELECT *, CASE WHEN once > 0 THEN before::DOUBLE / target * w END AS rest FROM mixed)
SELECT doc_id, CAST(size AS BIGINT) AS size, n AS source_size, target, CAST(once + twice AS BIGINT) AS taken,
       CASE WHEN rest <= 0 THEN 0.0
            ELSE 2.0::DOUBLE * rest / (first + sqrt(greatest(first * first + 2.0::DOUBLE * slope * rest, 0.0))) END::DOUBLE
         AS position
FROM reached
""")
def op11_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, sorted by range of its first training position."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    planned = curriculum.in_order(curriculum.plan(docs, MIX_SCHEDULES))
    return planned.select(
        "doc_id", "size", "source_size", "target", "taken",
        curriculum.first_position(F.col("takes")).alias("position"))


@query()
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of every usable vector."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(vectors)


@query(r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
b AS (
  SELECT row_number() OVER () AS bid, item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
size AS (SELECT count(*) AS n, CAST(sum(len(words)) AS BIGINT) AS l FROM d WHERE len(words) > 0),
q AS (SELECT bid, term, count(*) AS often FROM (SELECT bid, unnest(words) AS term FROM b) GROUP BY bid, term),
t AS (
  SELECT rid, term, count(*) AS tf
  FROM (SELECT rid, unnest(words) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY rid, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * size.n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM t, size GROUP BY term, size.n),
m AS (SELECT rid, doc_id, 100 - 75 + ((75 * len(words) * size.n) // size.l) AS m FROM d, size WHERE len(words) > 0),
scores AS (
  SELECT bid, rid, doc_id, CAST(sum(often * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN t USING (term) JOIN w USING (term) JOIN m USING (rid) GROUP BY bid, rid, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY bid ORDER BY score DESC, doc_id NULLS LAST) AS r FROM scores WHERE score > 0)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM ranked JOIN b USING (bid) WHERE r <= 10
""")
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ball_tree.search(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
