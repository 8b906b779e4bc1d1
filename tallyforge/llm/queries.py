"""The registered queries of the corpus operators, with production parameters, over whole tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.llm import collocations, decontaminate, language_id, license_scan, mixing, quality_rules, sharding, simhash, spelling, substring_dedup, token_files, toxicity, url_filter

SHARDS = 40


def _table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Fixed values of the query.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
MIX = {"source": 0.7, "lang": {"en": 0.5, "de": 0.2, "fr": 0.15, "es": 0.15}, "topic": 0.5}


def op1_url_filter(spark, sf):
    pages = _table(spark, sf, "pages").select("page_id", "url")
    model = url_filter.fit(url_filter.labelled_pages(pages, _table(spark, sf, "labels")))
    return url_filter.judge(pages, URL_RULES, model)


def op2_substring_dedup(spark, sf):
    return substring_dedup.dedup(_table(spark, sf, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_license_scan(spark, sf):
    return license_scan.label_documents(_table(spark, sf, "documents"))


def op4_mixing(spark, sf):
    return mixing.sample(_table(spark, sf, "documents"), MIX)


def op5_token_files(spark, sf):
    import public_tokenizers

    path = token_files.new_folder(spark)
    token_files.write(_table(spark, sf, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), vocabulary=50257, added=True)
    return token_files.digest(spark, path, vocabulary=50257)


def op6_sharding(spark, sf):
    return sharding.assign(_table(spark, sf, "documents"), [1.0] * SHARDS)


def op7_simhash(spark, sf):
    found = simhash.groups(_table(spark, sf, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def op8_toxicity(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    scorer = toxicity.fit_documents(docs, _table(spark, sf, "labels"))
    return scorer.score(docs).select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


def op9_decontaminate(spark, sf):
    return decontaminate.find(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"), by_stretch=True)


def op10_quality_rules(spark, sf):
    return quality_rules.judge(_table(spark, sf, "documents"), _table(spark, sf, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.col("rule"))


def op11_language_id(spark, sf):
    docs = _table(spark, sf, "documents")
    profiles = language_id.fit(docs.where(~language_id.held_out("doc_id")))
    return profiles.predict(docs.select("doc_id", "text", language_id.held_out("doc_id").alias("held_out"))).drop("text")


def op12_spelling(spark, sf):
    return spelling.variants(_table(spark, sf, "documents"))


def op13_collocations(spark, sf):
    return collocations.collocations(_table(spark, sf, "documents"))


QUERIES = {f.__name__: f for f in (op1_url_filter, op2_substring_dedup, op3_license_scan, op4_mixing, op5_token_files, op6_sharding, op7_simhash, op8_toxicity, op9_decontaminate, op10_quality_rules, op11_language_id, op12_spelling, op13_collocations)}

SUBSTRING_SQL = """
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (
  SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i, ws FROM w WHERE len(ws) >= 13),
s AS (SELECT doc_id, i, array_to_string(ws[i : i + 12], ' ') AS win FROM g),
m AS (SELECT win, min(doc_id) AS least FROM s GROUP BY win),
gone AS (
  SELECT DISTINCT s.doc_id, unnest(range(s.i, s.i + 13)) AS pos FROM s JOIN m USING (win) WHERE m.least < s.doc_id),
p AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS pos, unnest(ws) AS word FROM w),
k AS (
  SELECT p.doc_id, count(*) FILTER (WHERE gone.pos IS NOT NULL) AS n_removed,
         string_agg(word, ' ' ORDER BY p.pos) FILTER (WHERE gone.pos IS NULL) AS kept
  FROM p LEFT JOIN gone ON gone.doc_id = p.doc_id AND gone.pos = p.pos GROUP BY p.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""

COLLOCATION_SQL = """
WITH low AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
piece AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS p FROM low),
w AS (SELECT lang, list_filter(string_split_regex(p, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM piece),
total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
k AS (SELECT unnest(range(1, 6)) AS k),
gram AS (
  SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase
  FROM (SELECT lang, k, ws, unnest(range(1, len(ws) - k + 2)) AS i FROM w, k WHERE len(ws) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM gram GROUP BY ALL HAVING count(*) >= 100),
inner_part AS (
  SELECT lang, array_to_string(string_split(phrase, ' ')[i : i + m - 1], ' ') AS part, f
  FROM (SELECT lang, phrase, f, k, m, unnest(range(1, k - m + 2)) AS i
        FROM (SELECT lang, phrase, f, k, unnest(range(2, k)) AS m FROM f WHERE k > 2))),
held AS (SELECT lang, part, max(f) AS longer FROM inner_part GROUP BY ALL),
kept AS (
  SELECT f.lang, f.phrase, f.k, f.f AS a FROM f LEFT JOIN held ON held.lang = f.lang AND held.part = f.phrase
  WHERE f.k > 1 AND (longer IS NULL OR 100 * longer < 100 * f.f)),
cut AS (
  SELECT lang, phrase, a, c, array_to_string(string_split(phrase, ' ')[1 : c], ' ') AS lp, array_to_string(string_split(phrase, ' ')[c + 1 : k], ' ') AS rp
  FROM (SELECT *, unnest(range(1, k)) AS c FROM kept)),
line AS (
  SELECT cut.lang, cut.phrase, a, c, l.f AS l, r.f AS r, n, ((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = cut.lp JOIN f r ON r.lang = cut.lang AND r.phrase = cut.rp JOIN total ON total.lang = cut.lang),
best AS (SELECT * FROM line QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""

ORACLES = {"op2_substring_dedup": SUBSTRING_SQL, "op13_collocations": COLLOCATION_SQL}
