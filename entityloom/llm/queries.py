"""The numbered operators as queries over the given tables, with their whole tables and production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityloom.llm.bpe import Codec
from entityloom.llm.collocations import collocations
from entityloom.llm.common import shared_folder, stored, table
from entityloom.llm.embedding_dedup import near_vectors
from entityloom.llm.fingerprints import as_hex, count_near, edited_fingerprints
from entityloom.llm.licenses import license_summary, scan_licenses
from entityloom.llm.line_dedup import without_repeated_lines
from entityloom.llm.mixing import mixing_plan, with_copies, word_count
from entityloom.llm.page_text import main_text
from entityloom.llm.quality import fit_quality, held_out, score_quality
from entityloom.llm.ranked_search import search
from entityloom.llm.simhash_balls import near_groups, with_fingerprints
from entityloom.llm.token_counts import count_tokens
from entityloom.llm.warc import mark_revisits, read_archive, write_archive

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    codec = Codec(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    decoded = codec.round_trip(table(spark, sf_dir, "documents"))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_summary(scan_licenses(table(spark, sf_dir, "documents")))


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


@query
def op8_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archive(mark_revisits(table(spark, sf_dir, "pages")), shared_folder(spark, "warc"))
    records = read_archive(manifest, with_payload=False)
    return records.select(
        F.col("record_id").cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


SQL["op8_warc_round_trip"] = """
WITH rows AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
     digests AS (SELECT page_id, strlen(body) AS payload_bytes, sha256(body) AS payload_digest FROM rows),
     marked AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM digests)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM marked
"""


@query
def op1_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query
def op6_simhash_balls(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = near_groups(with_fingerprints(table(spark, sf_dir, "documents")), radius=4)
    return grouped.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With ``n_near`` for the queries, the rows whose id is divisible by 20: other rows within 3 bits, of all rows."""
    printed = stored(edited_fingerprints(table(spark, sf_dir, "documents")))
    asked = F.col("doc_id") % 20 == 0
    near = stored(count_near(printed, printed.filter(asked), radius=3))
    found = printed.filter(asked).join(near, "fingerprint", "left").withColumn("n_near", F.col("n_near") - 1)
    rest = printed.filter(~F.coalesce(asked, F.lit(False))).withColumn("n_near", F.lit(None).cast("bigint"))
    return found.unionByName(rest).select(
        "doc_id", "n_chars", "edited_sha256", as_hex("fingerprint").alias("fingerprint"),
        as_hex("edited_fingerprint").alias("edited_fingerprint"), "near_edited", "near_next", "n_near",
    )


@query
def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = with_copies(docs, mixing_plan(docs, max_repeats=2.0))
    return rows.select(
        "doc_id", "source", word_count("text").alias("n_words"), F.round("mix.weight", 9).alias("weight"), F.col("mix.copies").alias("copies"), F.col("mix.block").alias("block")
    )


# the smallest exponent on the grid with (largest / smallest share) ^ (1 - exponent) <= 2, in closed form
_HASH = "('0x' || substr(md5({}), 1, 15))::BIGINT"
SQL["op3_source_mix"] = f"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS n_words,
         {_HASH.format("'17:' || coalesce(doc_id::VARCHAR, '')")} AS key,
         greatest(1, (SELECT count(*) FROM documents) // 2048) AS blocks
  FROM documents),
dealt AS (SELECT *, key % blocks AS block FROM docs),
sources AS (SELECT source, sum(n_words)::BIGINT AS words FROM dealt GROUP BY source),
shares AS (SELECT source, words, words / (SELECT sum(words)::DOUBLE FROM sources) AS share FROM sources WHERE words > 0),
found AS (SELECT CASE WHEN max(share) = min(share) THEN 0
            ELSE greatest(0, ceil((1 - ln(2) / ln(max(share) / min(share))) * 1048576 - 1e-6)) / 1048576.0 END::DOUBLE AS alpha,
            max(share) AS top FROM shares),
weighed AS (SELECT source, words, pow(share, alpha) / sum(pow(share, alpha)) OVER () AS weight,
            greatest(words, round((SELECT sum(words)::DOUBLE FROM sources) * pow(top, 1 - alpha) * pow(share, alpha))::BIGINT) AS target
            FROM shares, found),
wanted AS (SELECT *, target // words AS epochs, target % words AS part FROM weighed),
by_block AS (SELECT source, block, sum(n_words)::BIGINT AS words FROM dealt GROUP BY source, block),
ordered AS (SELECT b.source, b.block, w.part, b.words, {_HASH.format("'17:' || w.epochs || ':' || b.block")} AS place
            FROM by_block b JOIN wanted w ON b.source IS NOT DISTINCT FROM w.source),
summed AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY place, block ROWS UNBOUNDED PRECEDING) AS through FROM ordered),
last AS (SELECT source, place AS last_place, block AS last_block, part - through + words AS left_words FROM summed WHERE through > part
         QUALIFY row_number() OVER (PARTITION BY source ORDER BY place, block) = 1),
inside AS (SELECT d.source, d.key, sum(d.n_words) OVER (PARTITION BY d.source ORDER BY d.key) AS through, l.left_words
           FROM dealt d JOIN last l ON d.source IS NOT DISTINCT FROM l.source AND d.block = l.last_block),
cut AS (SELECT source, max(key) AS last_key FROM inside WHERE through <= left_words GROUP BY source)
SELECT d.doc_id, d.source, d.n_words::BIGINT AS n_words, round(coalesce(w.weight, 0), 9) AS weight, d.block::BIGINT AS block,
       (coalesce(w.epochs, 1) + CASE WHEN s.place < l.last_place OR (s.place = l.last_place AND d.block < l.last_block)
             OR (d.block = l.last_block AND d.key <= c.last_key) THEN 1 ELSE 0 END)::BIGINT AS copies
FROM dealt d LEFT JOIN wanted w ON d.source IS NOT DISTINCT FROM w.source
     LEFT JOIN summed s ON d.source IS NOT DISTINCT FROM s.source AND d.block = s.block
     LEFT JOIN last l ON d.source IS NOT DISTINCT FROM l.source LEFT JOIN cut c ON d.source IS NOT DISTINCT FROM c.source
"""


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = without_repeated_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "dedup.n_lines", "dedup.n_removed", F.sha2(F.coalesce("dedup.text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


# runs of every length, one line longer with each step, for as long as any is repeated
SQL["op5_line_dedup"] = """
WITH RECURSIVE split AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS d, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, d, unnest(range(len(ls))) AS pos, unnest(ls) AS line, md5(unnest(ls)) AS h,
                 len(regexp_extract_all(unnest(ls), '[^ \\t\\n\\x0B\\f\\r]+')) AS words FROM split),
runs AS (
  SELECT 1 AS n, d, pos, words, min(d * 1000000000 + pos) OVER same AS first FROM lines WINDOW same AS (PARTITION BY h) QUALIFY count(*) OVER same > 1
  UNION ALL
  SELECT r.n + 1, r.d, r.pos, r.words + l.words, min(r.d * 1000000000 + r.pos) OVER same FROM runs r JOIN lines l ON l.d = r.d AND l.pos = r.pos + r.n
  WINDOW same AS (PARTITION BY r.first, l.h) QUALIFY count(*) OVER same > 1),
later AS (SELECT d, pos, max(n) AS n FROM runs WHERE first < d * 1000000000 + pos AND words >= 3 GROUP BY d, pos),
gone AS (SELECT DISTINCT d, unnest(range(pos, pos + n)) AS pos FROM later)
SELECT l.doc_id, count(*)::BIGINT AS n_lines, count(g.pos)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '')) AS text_sha256
FROM lines l LEFT JOIN gone g ON l.d = g.d AND l.pos = g.pos GROUP BY l.d, l.doc_id
"""


@query
def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95)


# all pairs: right at any size, affordable at small ones
SQL["op4_embedding_dedup"] = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
usable AS (SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(e) = list_count(e)
           AND list_sum(list_transform(e, lambda x: CASE WHEN isfinite(x) THEN 0 ELSE 1 END)) = 0 AND list_inner_product(e, e) > 0),
links AS MATERIALIZED (SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
          AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT v.vec_id, (SELECT count(*) FROM links l WHERE l.x = v.vec_id)::BIGINT AS n_links, m.component_id, v.vec_id = m.component_id AS kept
FROM v JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) m ON m.x = v.vec_id
"""


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), longest=3, min_count=10, top=2000)


SQL["op11_collocations"] = """
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
lists AS (SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^ \\x09]+') AS w FROM pieces),
places AS (SELECT p, lang, unnest(range(len(w))) AS i, unnest(w) AS w1 FROM lists),
totals AS (SELECT lang, count(*) AS n FROM places GROUP BY lang),
runs AS (SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM places WINDOW o AS (PARTITION BY p ORDER BY i)),
phrases AS MATERIALIZED (
  SELECT lang, 1 AS k, w1 AS phrase, count(*)::HUGEINT AS f FROM runs GROUP BY ALL HAVING count(*) >= 10
  UNION ALL SELECT lang, 2, w1 || ' ' || w2 AS phrase, count(*)::HUGEINT FROM runs WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 AS phrase, count(*)::HUGEINT FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
split AS (SELECT *, string_split(phrase, ' ') AS w FROM phrases),
halves AS (SELECT lang, phrase, f AS a, 1 AS cut, w[1] AS first, array_to_string(w[2:], ' ') AS rest FROM split WHERE k > 1
           UNION ALL SELECT lang, phrase, f, 2, array_to_string(w[:2], ' '), w[3] FROM split WHERE k > 2),
cuts AS (SELECT c.lang, c.phrase, c.a, c.cut, l.f AS l, r.f AS r, (1000000 * c.a * c.a) // (l.f * r.f) AS score
         FROM halves c JOIN phrases l ON l.lang = c.lang AND l.phrase = c.first JOIN phrases r ON r.lang = c.lang AND r.phrase = c.rest),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (SELECT lang, phrase, max(a) AS most FROM (SELECT lang, first AS phrase, a FROM halves WHERE cut = 2
           UNION ALL SELECT lang, rest, a FROM halves WHERE cut = 1 AND contains(rest, ' ')) GROUP BY ALL),
ranked AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank
           FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase WHERE i.most IS NULL OR 100 * i.most < 50 * b.a)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query
def op12_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("bigint"))


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10).drop("q")


_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')"
SQL["op13_ranked_search"] = f"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, {_TERMS} AS terms FROM documents),
items AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS terms FROM benchmark),
asked AS (SELECT q, item_id, term, count(*) AS times FROM (SELECT q, item_id, unnest(terms) AS term FROM items) GROUP BY ALL),
stats AS (SELECT count(*) AS docs, sum(len(terms))::BIGINT AS words FROM docs WHERE len(terms) > 0),
counted AS (SELECT d, term, count(*)::BIGINT AS tf FROM (SELECT d, unnest(terms) AS term FROM docs) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM counted, stats GROUP BY term, docs),
sized AS (SELECT d, doc_id, (25 + (75 * len(terms)::BIGINT * docs) // words)::BIGINT AS m FROM docs, stats WHERE len(terms) > 0),
scores AS (SELECT a.q, a.item_id, s.d, s.doc_id, sum(a.times * w.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * s.m)))::BIGINT AS score
           FROM asked a JOIN weights w USING (term) JOIN counted c USING (term) JOIN sized s ON s.d = c.d GROUP BY ALL)
SELECT item_id, (row_number() OVER best)::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0
WINDOW best AS (PARTITION BY q ORDER BY score DESC, doc_id) QUALIFY row_number() OVER best <= 10
"""
