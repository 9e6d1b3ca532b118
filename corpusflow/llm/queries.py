"""The registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.llm import divergence, embeddings, language, lmscore, media, mixing, neardup, packing, phrases, substrings, topk, urls, warc
from corpusflow.llm.common import save, table


def op1_warc_convert(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    records = warc.read_archives(warc.archive_pages(pages), payloads=False).where("record_type in ('response', 'revisit')")
    kind = pages.schema["page_id"].dataType
    return records.select(F.col("key").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to_key").cast(kind).alias("refers_to"))


def op2_substring_dedup(spark, sf_dir):
    out = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("kept_sha256"))


def op3_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(docs.where(~language.held_out(F.col("doc_id"))))
    out = language.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op5_embedding_range_join(spark, sf_dir):
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_mix_sources(spark, sf_dir):
    return mixing.mix_plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_minhash_near_dedup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_copies", "kept")


def op8_lm_scoring(spark, sf_dir):
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return lmscore.cross_entropy(table(spark, sf_dir, "documents"), good)


def op9_media_columns(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("payload"))
    stored = save(media.add_media(docs, "payload").select("doc_id", F.octet_length("payload").cast("long").alias("n_bytes"), "media"), "media")
    out = media.media_features(stored, keep=("doc_id", "n_bytes"))
    feature = F.concat_ws(":", F.size("fingerprint").cast("string"), F.hex(F.xxhash64("fingerprint")))
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"))


def op10_url_filter(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "block_score")


def op11_phrase_collocations(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op12_source_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


def op13_topk_search(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES = {f.__name__: f for f in (op1_warc_convert, op2_substring_dedup, op3_best_fit_packing, op4_language_id, op5_embedding_range_join, op6_mix_sources, op7_minhash_near_dedup, op8_lm_scoring, op9_media_columns, op10_url_filter, op11_phrase_collocations, op12_source_divergence, op13_topk_search)}
WARC_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, sha1(b) AS payload_digest FROM p),
h AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS holder FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < holder THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < holder THEN holder END AS refers_to FROM h
"""

REPEATS_SQL = r"""
WITH x AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
s AS (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 18))) AS i FROM x),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS k FROM s),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS nth FROM win) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM later)),
words AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM x),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT x.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM x LEFT JOIN kept USING (doc_id)
"""
RANGE_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))) AND list_max(list_transform(embedding, lambda x: abs(x))) > 0),
p AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r(x, y) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.x, p.y FROM r JOIN p ON r.y = p.x),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x), n AS (SELECT x, count(*) AS n FROM p GROUP BY x)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept FROM embeddings LEFT JOIN c ON c.x = vec_id LEFT JOIN n ON n.x = vec_id
"""

PHRASES_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws, count(*) AS times FROM p GROUP BY lang, piece),
g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS gram, times FROM (SELECT lang, ws, times, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k))),
f AS (SELECT lang, k, gram, CAST(sum(times) AS HUGEINT) AS f FROM g GROUP BY ALL HAVING sum(times) >= 10),
n AS (SELECT lang, CAST(sum(len(ws) * times) AS BIGINT) AS n FROM w GROUP BY lang),
c AS (SELECT lang, k, gram, f AS a, string_split(gram, ' ') AS ws FROM f WHERE k > 1),
cut AS (SELECT lang, k, gram, a, unnest(range(1, k)) AS c1, ws FROM c),
s AS (SELECT cut.lang, cut.gram, cut.a, cut.c1, x.f AS l, y.f AS r, (1000000 * cut.a * cut.a) // (x.f * y.f) AS score FROM cut JOIN f x ON x.lang = cut.lang AND x.gram = array_to_string(cut.ws[1:cut.c1], ' ') JOIN f y ON y.lang = cut.lang AND y.gram = array_to_string(cut.ws[cut.c1 + 1:], ' ')),
worst AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, c1) = 1),
long AS (SELECT lang, array_to_string(ws[i:i + 1], ' ') AS gram, max(a) AS around FROM (SELECT lang, ws, a, unnest([1, 2]) AS i FROM c WHERE k = 3) GROUP BY ALL),
kept AS (SELECT worst.* FROM worst LEFT JOIN long ON long.lang = worst.lang AND long.gram = worst.gram WHERE coalesce(100 * around < 50 * a, true))
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, gram) AS rank, gram AS phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM kept JOIN n ON n.lang = kept.lang QUALIFY rank <= 2000
"""
DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
o AS (SELECT i, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_c FROM o GROUP BY ALL HAVING count(DISTINCT i) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM o GROUP BY ALL),
cell AS (SELECT g.lang, g.source, k.term, k.lang_c, CAST(coalesce(c.c, 0) AS HUGEINT) AS c FROM g JOIN kept k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
n AS (SELECT *, sum(c) OVER (PARTITION BY lang, source) AS n, sum(lang_c) OVER (PARTITION BY lang, source) AS lang_n, count(*) OVER (PARTITION BY lang, source) AS v FROM cell),
p AS (SELECT lang, source, term, c, CAST(1 + (1000000000 * (c + 1)) // (n + v) AS BIGINT) AS p, CAST(1 + (1000000000 * (CAST(lang_c AS HUGEINT) + 1)) // (lang_n + v) AS BIGINT) AS q FROM n),
sums AS (SELECT a.lang, a.source, b.source AS item, CAST(sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS BIGINT) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value FROM p WHERE c > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= 200
"""
TOPK_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings WHERE embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true))
SELECT q.vec_id AS query_id, CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.e, c.e) DESC, c.vec_id) AS INTEGER) AS rank, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e) QUALIFY rank <= 5
"""

ORACLE_SQL = {"op1_warc_convert": WARC_SQL, "op2_substring_dedup": REPEATS_SQL, "op5_embedding_range_join": RANGE_SQL, "op6_mix_sources": mixing.MIX_SQL, "op11_phrase_collocations": PHRASES_SQL, "op12_source_divergence": DIVERGENCE_SQL, "op13_topk_search": TOPK_SQL}
