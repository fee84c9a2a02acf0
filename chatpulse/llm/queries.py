"""The registered queries of these operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatpulse.llm.bpe import decode_ids, encode_texts
from chatpulse.llm.common import new_folder
from chatpulse.llm.decontaminate import find_benchmark
from chatpulse.llm.ego_join import embedding_links
from chatpulse.llm.gnat_codes import compress_vectors
from chatpulse.llm.hmm import score_texts
from chatpulse.llm.kneser_ney import classify_quality
from chatpulse.llm.packing import pack_documents
from chatpulse.llm.phrases import mine_phrases
from chatpulse.llm.simhash import simhash_components
from chatpulse.llm.token_counts import count_tokens
from chatpulse.llm.toxicity import score_toxicity
from chatpulse.llm.url_rules import judge_urls
from chatpulse.llm.warc import round_trip
from chatpulse.sources.tables import table

TOKENIZER = "byte_bpe_50k.json"
OVER = 512


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op2_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op3_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op5_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(table(spark, sf_dir, "embeddings"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache of its own, so that a run never depends on an earlier one."""
    counted = count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(), new_folder(spark, "token-cache"))
    return counted.withColumn("over_limit", F.col("n_tokens") > OVER)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def packed_pieces(docs: DataFrame) -> DataFrame:
    return pack_documents(docs, tokenizer_path()).withColumn("ids_crc32", F.crc32("tokens")).drop("tokens")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_vectors(table(spark, sf_dir, "embeddings"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(table(spark, sf_dir, "documents"))


def op13_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_texts(table(spark, sf_dir, "documents"), tokenizer_path())
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    told = encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed.cast("binary"), 256).alias("ids_sha256"), "ids"
    )
    decoded = decode_ids(told, tokenizer_path())
    return decoded.select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256")
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for name, run in globals().items() if name.startswith("op")}


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Assignment and mean of every round, one after the other."""
    whole = "(s - ((s % n) + n) % n) // n"
    steps = [
        f"""v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
        q AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, len(e) // {parts} AS d,
            list_transform(e, lambda x: floor(x * 4096)::HUGEINT) AS e FROM v
          WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS MATERIALIZED (SELECT rid, part, e[part * d + 1 : part * d + d] AS x FROM q, generate_series(0, {parts - 1}) AS s(part)),
        b0 AS MATERIALIZED (SELECT part, rid - 1 AS entry, x FROM p WHERE rid <= {entries})"""
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT rid, p.part, any_value(p.x) AS x, min({entries} * list_sum(
            list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT + entry) AS best
          FROM p JOIN b{i} b ON p.part = b.part GROUP BY rid, p.part)""")
        if i < rounds:
            steps.append(f"""m{i} AS (SELECT part, entry, list({whole} ORDER BY pos) AS x FROM (
                SELECT part, best % {entries} AS entry, pos, sum(x[pos])::HUGEINT AS s, count(*) AS n
                FROM (SELECT part, best, x, unnest(range(1, len(x) + 1)) AS pos FROM a{i}) GROUP BY ALL) GROUP BY part, entry),
            b{i + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x
              FROM b{i} b LEFT JOIN m{i} m ON b.part = m.part AND b.entry = m.entry)""")
    return "WITH " + ",\n".join(steps) + f""",
        c AS (SELECT rid, string_agg(printf('%02x', (best % {entries})::INTEGER), '' ORDER BY part) AS code,
          sum(best // {entries})::BIGINT AS error FROM a{rounds} GROUP BY rid),
        l AS (SELECT vec_id, label, code, error FROM c JOIN q USING (rid))
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (SELECT sha256(string_agg(x::VARCHAR, ','
          ORDER BY part, entry, pos)) FROM (SELECT part, entry, x[pos] AS x, pos FROM (
            SELECT *, unnest(range(1, len(x) + 1)) AS pos FROM b{rounds}))) AS codebooks_sha256 FROM l"""


PHRASES_SQL = r"""WITH t AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
    ), w AS (
      SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS ws FROM t
    ), g AS (
      SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase, count(*) AS f
      FROM (SELECT lang, k, ws, unnest(range(1, len(ws) - k + 2)) AS i FROM w, generate_series(1, 3) AS s(k)) GROUP BY ALL
    ), totals AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang),
    c AS (SELECT lang, k AS words, phrase, f AS a, string_split(phrase, ' ') AS ws FROM g WHERE k > 1 AND f >= 10),
    cuts AS (
      SELECT c.lang, c.phrase, a, h.f AS l, t.f AS r, cut, (1000000::HUGEINT * a * a) // (h.f::HUGEINT * t.f) AS score
      FROM (SELECT *, unnest(range(1, words)) AS cut FROM c) c
      JOIN g h ON h.lang = c.lang AND h.phrase = array_to_string(ws[1 : cut], ' ')
      JOIN g t ON t.lang = c.lang AND t.phrase = array_to_string(ws[cut + 1 : words], ' ')
    ), lowest AS (SELECT lang, phrase, unnest(min(struct_pack(score := score, cut := cut, a := a, l := l, r := r))) FROM cuts GROUP BY lang, phrase),
    longer AS (
      SELECT lang, phrase, max(a) AS most FROM (
        SELECT lang, a, unnest([array_to_string(ws[1 : 2], ' '), array_to_string(ws[2 : 3], ' ')]) AS phrase FROM c WHERE words = 3
      ) GROUP BY lang, phrase
    ), ranked AS (
      SELECT lowest.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
      FROM lowest LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < 50 * a
    )
    SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


def oracle_sql() -> dict[str, str]:
    """Mined rules, trained models, fingerprints, tokenizers and packings are beyond SQL; tests hold those
    queries against brute force instead."""
    return {
        "op11_vector_codes": _codes_sql(),
        "op12_phrases": PHRASES_SQL,
        "op5_vector_links": """WITH RECURSIVE v AS (
              SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            ), usable AS (
              SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND list_sum(list_transform(e, lambda x: x * x)) > 0
            ), links AS (
              SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
              ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
            ), reach AS (
              SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
            ), lowest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
            degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
            SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
            FROM v JOIN lowest ON v.vec_id = lowest.a LEFT JOIN degrees ON v.vec_id = degrees.a""",
        "op10_warc": """WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
            d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS payload_digest FROM p),
            k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM d)
            SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
              CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
              CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN keeper END AS refers_to FROM k""",
    }
