"""One query per operator, over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comarca.llm.common import is_held_out
from comarca.llm.exact_dedup import exact_dedup
from comarca.llm.fill_middle import MARKS, digests, fill_in_middle
from comarca.llm.frames import store_frames
from comarca.llm.jaccard_join import jaccard_components
from comarca.llm.language import identify_languages, learn_languages
from comarca.llm.mixing import mix_plan
from comarca.llm.packing import pack_documents
from comarca.llm.quality_model import learn_quality, score_quality
from comarca.llm.quality_rules import judge_quality
from comarca.llm.registry import QUERIES, SQL, query, table
from comarca.llm.sharding import shard_by_bytes
from comarca.llm.token_files import read_token_files, token_digests, write_token_files
from comarca.llm.toxicity import learn_toxicity, score_toxicity
from comarca.llm.url_rules import ALLOW, BLOCK, judge_urls, rule_table
from comarca.llm.vector_codes import ROUNDS, encode_vectors, fit_codebooks
from comarca.sources import scratch_path

__all__ = ["QUERIES", "SQL"]


@query(
    """
    WITH hashed AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, text_sha256
    FROM hashed WINDOW same AS (PARTITION BY text_sha256)
    """
)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents stay when of equal texts the one with the largest id does."""
    decided = exact_dedup(table(spark, sf_dir, "documents"))
    sha = F.lower(F.hex("digest")).alias("text_sha256")
    return decided.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", sha)


RULES = [
    ("net", "/", BLOCK),
    ("example.net", "/en/", ALLOW),
    ("example.com", "/de/", BLOCK),
    ("org", "/fr/", ALLOW),
]


@query(
    """
    WITH parts AS (
        SELECT page_id,
               translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages
    ), ruled AS (
        SELECT *, CASE
            WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND prefix(path, '/en/')
                THEN 'example.net/en/'
            WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND prefix(path, '/de/')
                THEN 'example.com/de/'
            WHEN (host = 'org' OR suffix(host, '.org')) AND prefix(path, '/fr/') THEN 'org/fr/'
            WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/') THEN 'net/'
        END AS rule
        FROM parts
    )
    SELECT page_id, host, path, rule,
           CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
    FROM ruled
    """
)
def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest rule and the verdict for every page."""
    return judge_urls(table(spark, sf_dir, "pages"), rule_table(spark, RULES))


@query()
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies."""
    pieces = pack_documents(table(spark, sf_dir, "documents"), with_ids=False)
    return pieces.withColumnRenamed("id", "doc_id")


@query()
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen shards of nearly equal bytes."""
    placed = shard_by_bytes(table(spark, sf_dir, "documents"))
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select(F.col("id").alias("doc_id"), "size", "text_crc32", law, "shard", "slot", grown)


@query()
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    plan = mix_plan(table(spark, sf_dir, "documents"))
    taken = (F.col("copies") * F.col("size")).cast("long").alias("taken")
    return plan.select(F.col("id").alias("doc_id"), "size", "source_size", "target", taken, "shards")


@query()
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules, and a decision list learned from the quality labels."""
    judged = judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", "rule",
    )


@query()
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, by its significant passages."""
    docs = table(spark, sf_dir, "documents")
    model = learn_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, model)
    held_out = is_held_out(F.col("id")).alias("held_out")
    return scored.select(F.col("id").alias("doc_id"), held_out, "score", "predicted", F.size("passages").alias("passages"))


@query()
def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = learn_quality(docs, table(spark, sf_dir, "labels"))
    held_out = is_held_out(F.col("id")).alias("held_out")
    return score_quality(docs, model).select(F.col("id").alias("doc_id"), held_out, "score", "predicted")


@query()
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = table(spark, sf_dir, "documents")
    found = identify_languages(docs, learn_languages(docs))
    held_out = is_held_out(F.col("id")).alias("held_out")
    return found.select(F.col("id").alias("doc_id"), held_out, "lang_pred", "score", "rejected")


@query()
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingles are at least 85 % alike."""
    found = jaccard_components(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query(
    r"""
    WITH drawn AS (
        SELECT doc_id, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
               sha256('42:' || doc_id) AS h
        FROM documents
    ), cut AS (
        SELECT doc_id, text, units, len(units) AS n,
               ('0x' || substr(h, 1, 8))::BIGINT % (len(units) + 1) AS one,
               ('0x' || substr(h, 9, 8))::BIGINT % (len(units) + 1) AS two,
               ('0x' || substr(h, 17, 8))::BIGINT % 100 AS filled,
               ('0x' || substr(h, 25, 8))::BIGINT % 100 AS suffix_first
        FROM drawn
    ), parts AS (
        SELECT doc_id, text, n,
               CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                         OR filled >= 50 THEN 'plain'
                    WHEN suffix_first < 80 THEN 'spm' ELSE 'psm' END AS form,
               array_to_string(units[1:least(one, two)], '') AS prefix,
               array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS middle,
               array_to_string(units[greatest(one, two) + 1:], '') AS suffix
        FROM cut
    )
    SELECT doc_id, n, form,
           CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text
                            WHEN 'psm' THEN concat('<P>', prefix, '<S>', suffix, '<M>', middle)
                            ELSE concat('<S>', suffix, '<P>', prefix, '<M>', middle) END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM parts
    """
)
def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document rearranged by two hashed cuts, and rebuilt from that."""
    docs = table(spark, sf_dir, "documents")
    stored = store_frames(docs, scratch_path(spark, "frames"), marks=MARKS)
    return digests(fill_in_middle(stored)).withColumnRenamed("id", "doc_id")


def _lloyd_sql() -> str:
    """The codes of the vectors, round by round, over all pairs of part and entry."""

    def assigned(number: int) -> str:
        distance = "list_sum(list_transform(range(1, len(part) + 1), lambda k: (part[k] - middle[k]) * (part[k] - middle[k])))"
        return f"""
        near{number} AS MATERIALIZED (
            SELECT vec_id, p, any_value(part) AS part, arg_min(e, (d, e)) AS e, min(d) AS d
            FROM (SELECT vec_id, p, part, e, {distance} AS d FROM parts JOIN book{number} USING (p))
            GROUP BY vec_id, p
        )"""

    def moved(number: int) -> str:
        return f"""
        book{number} AS MATERIALIZED (
            SELECT p, e, coalesce(mean, middle) AS middle FROM book{number - 1} LEFT JOIN (
                SELECT p, e, list(mean ORDER BY k) AS mean FROM (
                    SELECT p, e, k, floor(sum(part[k])::DOUBLE / count(*))::BIGINT AS mean
                    FROM near{number - 1}, (SELECT unnest(range(1, (SELECT max(len(part)) FROM parts) + 1)) AS k)
                    GROUP BY p, e, k
                ) GROUP BY p, e
            ) USING (p, e)
        )"""

    rounds = [f"{assigned(number)},{moved(number + 1)}" for number in range(ROUNDS)]
    return f"""
    WITH kept AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), parts AS MATERIALIZED (
        SELECT vec_id, p, v[p * (len(v) // 8) + 1:(p + 1) * (len(v) // 8)] AS part
        FROM kept, (SELECT unnest(range(8)) AS p)
    ), book0 AS MATERIALIZED (
        SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, part AS middle
        FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 16)
    ), {','.join(rounds)}, {assigned(ROUNDS)}, coded AS (
        SELECT vec_id, string_agg(printf('%02x', e::INTEGER), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
        FROM near{ROUNDS} GROUP BY vec_id
    ), digest AS (
        SELECT sha256(string_agg(array_to_string(middle, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{ROUNDS}
    )
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
    FROM coded JOIN kept USING (vec_id), digest
    """


@query(_lloyd_sql())
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code, by codebooks fitted on all of them."""
    vectors = table(spark, sf_dir, "embeddings")
    found = fit_codebooks(vectors)
    coded = encode_vectors(vectors, found).withColumnRenamed("id", "vec_id")
    return coded.withColumn("codebooks_sha256", F.lit(found.sha256()))


@query()
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids, written in order and read back."""
    path = scratch_path(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), path)
    return token_digests(read_token_files(spark, path))
