"""The query of each operator: the operator over its whole table, and its digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loanmart.llm.shared import documents

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


@query()
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of documents: 4-word shingles, at most 4 differing bits."""
    from loanmart.llm import simhash

    found = simhash.groups(documents(spark, sf_dir), "doc_id", "text", shingle=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query()
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as token ids in files with Elias-Fano boundaries, read back from the files."""
    import public_tokenizers

    from loanmart.llm import token_files

    docs, folder = documents(spark, sf_dir), token_files.new_folder(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    shards = token_files.write(docs, "doc_id", "text", folder, path, end_id=2)
    return token_files.digests(spark, shards, folder).withColumnRenamed("id", "doc_id")


@query()
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without bytes covered by 400-byte strings that start elsewhere too."""
    from loanmart.llm import suffix_dedup

    return suffix_dedup.digest(suffix_dedup.remove_repeats(documents(spark, sf_dir), "doc_id", "text", 400))


@query()
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without words covered by 20-word sequences that start earlier too."""
    from loanmart.llm import substring_dedup

    return substring_dedup.digest(substring_dedup.remove_repeats(documents(spark, sf_dir), "doc_id", "text", 20))


@query(
    r"""
    WITH d AS (
      SELECT doc_id, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
      FROM documents),
    grams AS (
      SELECT doc_id, i, list_slice(w, i, i + 4) AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
    twice AS (
      SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
    covered AS (
      SELECT doc_id, count(DISTINCT p) AS n
      FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id),
    lines AS (
      SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT l) AS dup
      FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)
      WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
    m AS (
      SELECT d.doc_id, t, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
             length(t) - length(translate(t, '0123456789', '')) AS n_digits,
             coalesce(l.n, 0) AS n_lines, coalesce(l.dup, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
      FROM d LEFT JOIN lines l ON l.doc_id = d.doc_id LEFT JOIN covered c ON c.doc_id = d.doc_id),
    b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
    SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
           CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
           CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
           NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_symbols > n_words
                OR 100 * n_dup_lines > 30 * n_lines OR 100 * n_digits > 30 * word_chars
                OR regexp_matches(t, '[^\x20\x09-\x0D]{201}')) AS kept
    FROM b
    """
)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of each document, and whether all quality rules keep it."""
    from loanmart.llm import quality_rules

    judged = quality_rules.judge(documents(spark, sf_dir).select("doc_id", "text"), "text")
    measures = [m for m in quality_rules.MEASURES if m != "n_lines"]
    return judged.select("doc_id", *measures, "base_failed", "kept")


@query(
    r"""
    WITH s AS (SELECT doc_id, source, text, string_split(coalesce(text, ''), chr(10)) AS all_lines FROM documents),
    l AS (
      SELECT source, l FROM (SELECT source, unnest(all_lines) AS l FROM s) WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
    gone AS (SELECT l FROM l GROUP BY l HAVING count(DISTINCT source) >= 12),
    u AS (SELECT doc_id, unnest(all_lines) AS l, unnest(range(1, len(all_lines) + 1)) AS i FROM s),
    r AS (
      SELECT doc_id, CAST(count(*) FILTER (WHERE regexp_matches(u.l, '[^\x20\x09-\x0D]')) AS BIGINT) AS n_lines,
             CAST(count(gone.l) AS BIGINT) AS n_removed,
             coalesce(string_agg(u.l, chr(10) ORDER BY i) FILTER (WHERE gone.l IS NULL), '') AS t
      FROM u LEFT JOIN gone ON gone.l = u.l GROUP BY doc_id)
    SELECT doc_id, n_lines, n_removed, md5(t) AS text_md5 FROM r
    """
)
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without lines that stand on twelve or more sites."""
    from loanmart.llm import line_dedup

    cleaned = line_dedup.remove_boilerplate(documents(spark, sf_dir), "doc_id", "text", "source")
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    return cleaned.select("doc_id", "n_lines", "n_removed", digest.alias("text_md5"))


@query(
    r"""
    WITH w AS (
      SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
      UNION ALL
      SELECT 'b', item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') FROM benchmark),
    s AS (
      SELECT DISTINCT kind, id, array_to_string(list_slice(w, i, i + 4), ' ') AS g
      FROM (SELECT kind, id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
    n AS (SELECT id, count(*) AS n FROM s WHERE kind = 'b' GROUP BY id),
    f AS (
      SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_found
      FROM s d JOIN s b ON b.kind = 'b' AND d.kind = 'd' AND b.g = d.g GROUP BY d.id, b.id)
    SELECT doc_id, item_id, CAST(n AS BIGINT) AS n_shingles, CAST(n_found AS BIGINT) AS n_found
    FROM f JOIN n ON n.id = f.item_id WHERE 10 * n_found >= 8 * n
    """
)
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the benchmark items they contain: at least 0.8 of the item's five-word shingles."""
    from loanmart.llm import decontamination

    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.find(documents(spark, sf_dir), "doc_id", "text", items, "item_id", "text")


@query()
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices in each document."""
    from loanmart.llm import license_scan

    return license_scan.scan(documents(spark, sf_dir), "doc_id", "text")


@query()
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document, learned from those whose id's CRC-32 is not 2 modulo 4."""
    from loanmart.llm import language_id

    found = language_id.predict(documents(spark, sf_dir), "doc_id", "text", "lang")
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query()
def op9_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document encoded to pieces and decoded again: both as digests."""
    import public_tokenizers

    from loanmart.llm import sentence_pieces

    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = sentence_pieces.encode(documents(spark, sf_dir), "doc_id", "text", path).withColumnRenamed("doc_id", "id")
    return sentence_pieces.digest(coded, path).drop("ids").withColumnRenamed("id", "doc_id")


@query()
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words found five times or more, each with the far more frequent word one edit away."""
    from loanmart.llm import spelling
    from loanmart.llm.shared import written

    vocab = written(spelling.vocabulary(documents(spark, sf_dir), "doc_id", "text", slip=199, min_length=6, least=5))
    return spelling.group(vocab).select("word", "form", "root", "n", "n_near", "form_n")


@query(
    r"""
    WITH w AS (
      SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
      FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents)),
    places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
    g1 AS (SELECT lang, ws[i] AS x, CAST(count(*) AS HUGEINT) AS f FROM places GROUP BY ALL),
    g2 AS (SELECT lang, ws[i] AS x, ws[i + 1] AS y, CAST(count(*) AS HUGEINT) AS f FROM places WHERE i < len(ws) GROUP BY ALL HAVING count(*) >= 10),
    g3 AS (SELECT lang, ws[i] AS x, ws[i + 1] AS y, ws[i + 2] AS z, CAST(count(*) AS HUGEINT) AS f FROM places WHERE i + 1 < len(ws) GROUP BY ALL HAVING count(*) >= 10),
    t AS (SELECT lang, sum(f) AS n FROM g1 GROUP BY lang),
    e AS (SELECT lang, x, y, max(f) AS f FROM (SELECT lang, x, y, f FROM g3 UNION ALL SELECT lang, y, z, f FROM g3) GROUP BY lang, x, y),
    c AS (
      SELECT g2.lang, g2.x || ' ' || g2.y AS phrase, g2.f AS a, p.f AS l1, q.f AS r1, NULL AS l2, NULL AS r2
      FROM g2 JOIN g1 p ON p.lang = g2.lang AND p.x = g2.x JOIN g1 q ON q.lang = g2.lang AND q.x = g2.y
      LEFT JOIN e ON e.lang = g2.lang AND e.x = g2.x AND e.y = g2.y
      WHERE e.f IS NULL OR 100 * e.f < 50 * g2.f
      UNION ALL
      SELECT g3.lang, g3.x || ' ' || g3.y || ' ' || g3.z, g3.f, p.f, v.f, u.f, q.f
      FROM g3 JOIN g1 p ON p.lang = g3.lang AND p.x = g3.x JOIN g1 q ON q.lang = g3.lang AND q.x = g3.z
      JOIN g2 u ON u.lang = g3.lang AND u.x = g3.x AND u.y = g3.y JOIN g2 v ON v.lang = g3.lang AND v.x = g3.y AND v.y = g3.z),
    s AS (SELECT *, (1000000 * a * a) // (l1 * r1) AS s1, (1000000 * a * a) // (l2 * r2) AS s2 FROM c),
    o AS (
      SELECT lang, phrase, a, CASE WHEN s2 < s1 THEN l2 ELSE l1 END AS l, CASE WHEN s2 < s1 THEN r2 ELSE r1 END AS r,
             CASE WHEN s2 < s1 THEN s2 ELSE s1 END AS score FROM s),
    k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM o)
    SELECT k.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
           CAST(t.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
    FROM k JOIN t ON t.lang = k.lang WHERE rank <= 2000
    """
)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest phrases of two and three words of each language."""
    from loanmart.llm import collocations

    return collocations.mine(documents(spark, sf_dir), "text", "lang", least=10, inside=50, top=2000)


@query()
def op13_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities of each document, learned from those whose id's CRC-32 is not 1 modulo 5."""
    from loanmart.llm import backoff_lm

    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    return backoff_lm.score(documents(spark, sf_dir), "doc_id", "text", held_out).withColumnRenamed("id", "doc_id")
