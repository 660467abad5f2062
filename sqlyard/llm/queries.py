"""One query per operator over whole tables, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from sqlyard.llm import chunks, edits, leaks, lm, neighbours, packing, pages, periods, ranked, simhash, stages, substring, tokenfiles, toxicity
from sqlyard.llm.common import table


def op1_document_fingerprints(spark, sf):
    return chunks.edit_likeness(table(spark, sf, "documents"))


def op2_token_files(spark, sf):
    return tokenfiles.write_and_read(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json")).drop("path")


def op3_masked_likelihood(spark, sf):
    return lm.score(table(spark, sf, "documents"))


def op4_substring_dedup(spark, sf):
    return substring.remove_repeats(table(spark, sf, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_best_fit_packing(spark, sf):
    return packing.pack_documents(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_main_text(spark, sf):
    return pages.main_text(table(spark, sf, "pages"))


def op7_benchmark_decontamination(spark, sf):
    found = leaks.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op8_edited_token_counts(spark, sf):
    return edits.count_edits(
        table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_toxicity(spark, sf):
    return toxicity.score(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op10_simhash_near_duplicates(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


def op11_ranked_search(spark, sf):
    return ranked.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op12_nearest_neighbours(spark, sf):
    return neighbours.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


def op13_periodic_runs(spark, sf):
    docs = table(spark, sf, "documents")
    found = periods.periodic_runs(docs.select("doc_id", periods.with_planted_period("doc_id", "text").alias("text")))
    best = periods.strongest("runs")
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words")


QUERIES = {f.__name__: f for f in (
    op1_document_fingerprints, op2_token_files, op3_masked_likelihood, op4_substring_dedup, op5_best_fit_packing, op6_main_text,
    op7_benchmark_decontamination, op8_edited_token_counts, op9_toxicity, op10_simhash_near_duplicates, op11_ranked_search,
    op12_nearest_neighbours, op13_periodic_runs,
)} | {"pipeline": stages.run}


def _run(words: int) -> str:
    """SQL for a word and those after it as a list; without the missing ones at a document's end."""
    ahead = ", ".join(["word", *(f"lead(word, {j}) OVER ahead" for j in range(1, words))])
    return f"list_filter([{ahead}], lambda x: x IS NOT NULL)"


ORACLE_SQL = {
    "op4_substring_dedup": rf"""
        WITH w AS MATERIALIZED (
            SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS i
            FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents)),
        runs AS MATERIALIZED (
            SELECT doc_id, i, array_to_string(run, ' ') AS r
            FROM (SELECT doc_id, i, {_run(13)} AS run FROM w WINDOW ahead AS (PARTITION BY doc_id ORDER BY i)) WHERE len(run) = 13),
        firsts AS (SELECT r, min(doc_id) AS holder FROM runs GROUP BY r HAVING min(doc_id) < max(doc_id)),
        gone AS (
            SELECT DISTINCT doc_id, i + j AS i
            FROM runs JOIN firsts USING (r), (SELECT unnest(range(13)) AS j) WHERE holder < doc_id),
        kept AS (
            SELECT w.doc_id, count(*) AS n_words, count(gone.i) AS n_removed,
                coalesce(string_agg(CASE WHEN gone.i IS NULL THEN word END, ' ' ORDER BY w.i), '') AS kept
            FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id AND w.i = gone.i GROUP BY w.doc_id)
        SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM documents LEFT JOIN kept USING (doc_id)""",
    "op7_benchmark_decontamination": rf"""
        WITH folded AS (
            SELECT doc_id AS id, 'd' AS side, coalesce(text, '') AS t FROM documents
            UNION ALL SELECT item_id, 'b', coalesce(text, '') FROM benchmark),
        w AS MATERIALIZED (
            SELECT id, side, unnest(ws) AS word, unnest(range(len(ws))) AS i
            FROM (SELECT id, side, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM folded)),
        runs AS MATERIALIZED (
            SELECT id, side, i, {_run(10)} AS run FROM w WINDOW ahead AS (PARTITION BY side, id ORDER BY i)),
        phrases AS MATERIALIZED (
            SELECT DISTINCT id AS item_id, len(run) AS n, array_to_string(run, ' ') AS r
            FROM runs WHERE side = 'b' AND (len(run) = 10 OR i = 0)),
        found AS MATERIALIZED (
            SELECT DISTINCT runs.id, runs.i, k.n, phrases.item_id
            FROM (SELECT DISTINCT n FROM phrases) k
                JOIN runs ON side = 'd' AND len(run) >= k.n
                JOIN phrases ON phrases.n = k.n AND phrases.r = array_to_string(run[1 : k.n], ' ')),
        hits AS (SELECT id, count(DISTINCT i) AS n_hit FROM (SELECT id, unnest(range(i, i + n)) AS i FROM found) GROUP BY id),
        owners AS (
            SELECT id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
            FROM (SELECT DISTINCT id, item_id FROM found) GROUP BY id),
        counts AS (SELECT id, count(*) AS n_words FROM w WHERE side = 'd' GROUP BY id)
        SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM documents d LEFT JOIN counts ON counts.id = d.doc_id LEFT JOIN hits ON hits.id = d.doc_id
            LEFT JOIN owners ON owners.id = d.doc_id""",
    "op11_ranked_search": rf"""
        WITH folded AS (
            SELECT row_number() OVER () AS id, doc_id, 'd' AS side, NULL AS item_id, text AS t FROM documents
            UNION ALL SELECT 0, NULL, 'b', item_id, text FROM benchmark),
        w AS MATERIALIZED (
            SELECT id, doc_id, side, item_id, unnest(regexp_extract_all(
                translate(coalesce(t, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM folded),
        asked AS MATERIALIZED (SELECT DISTINCT item_id, term FROM w WHERE side = 'b'),
        sizes AS MATERIALIZED (SELECT id, count(*) AS n FROM w WHERE side = 'd' GROUP BY id),
        totals AS MATERIALIZED (SELECT count(*) AS n_docs, coalesce(sum(n), 0)::BIGINT AS n_terms FROM sizes),
        tfs AS MATERIALIZED (
            SELECT id, doc_id, term, count(*) AS tf FROM w WHERE side = 'd' AND term IN (SELECT term FROM asked) GROUP BY id, doc_id, term),
        weights AS (
            SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM tfs, totals GROUP BY term, n_docs),
        norms AS (SELECT id, 100 - 90 + (90 * n * n_docs) // n_terms AS m FROM sizes, totals),
        scored AS (
            SELECT item_id, id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
            FROM tfs JOIN weights USING (term) JOIN norms USING (id) JOIN asked USING (term) GROUP BY item_id, id, doc_id)
        SELECT item_id, (row_number() OVER best)::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0
        WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)
        QUALIFY row_number() OVER best <= 10""",
}
