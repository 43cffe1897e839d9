"""One query per operator over the whole ``documents`` table, and the SQL of those that SQL can express."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.llm import (
    byte_bpe,
    exact_dedup,
    filter_audit,
    language_id,
    ngram_jaccard,
    orchard,
    packing,
    phrase_fingerprint,
    pii,
    pitman_yor_corpus,
    quality,
    substring_dedup,
    toxicity,
)
from panelloom.llm.frames import crc32_of_id, read_documents, read_embeddings, read_labels

BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"
WORD_TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def _id_digests(doc_id: int, ids: list[int], decoded: bytes) -> tuple[int, str, str]:
    joined = ",".join(map(str, ids)).encode("ascii")
    return len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(decoded).hexdigest()


def substring_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.substring_dedup(read_documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("__row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def byte_bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode(
        read_documents(spark, sf_dir),
        public_tokenizers.path(BYTE_RANKS),
        finish=_id_digests,
        finish_schema="n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    )


def jaccard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.ngram_jaccard(read_documents(spark, sf_dir))


def fingerprint_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_fingerprint.compare_with_next(read_documents(spark, sf_dir))


def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read_documents(spark, sf_dir), public_tokenizers.path(WORD_TOKENIZER), END_ID)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def _held_out(modulus: int, remainder: int) -> Column:
    return F.pmod(crc32_of_id(F.col("doc_id")), F.lit(modulus)) == remainder


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = read_documents(spark, sf_dir), _held_out(3, 1)
    model = quality.learn_quality(docs.where(~held_out), read_labels(spark, sf_dir).where(~held_out))
    return quality.score_quality(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = read_documents(spark, sf_dir), _held_out(5, 0)
    model = toxicity.learn_toxicity(docs.where(~held_out), read_labels(spark, sf_dir).where(~held_out))
    return toxicity.score_toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = read_documents(spark, sf_dir), _held_out(3, 1)
    profiles = language_id.learn(docs.where(~held_out))
    return language_id.identify(docs, profiles).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def language_model_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = read_documents(spark, sf_dir), _held_out(7, 2)
    scores = pitman_yor_corpus.score_corpus(docs, ~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def exact_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_documents(spark, sf_dir))


def filter_audit_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_documents(spark, sf_dir), read_labels(spark, sf_dir))


def orchard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = orchard.cluster(read_embeddings(spark, sf_dir))
    components = F.concat_ws(",", F.transform("centroid", lambda x: x.cast("string")))
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(components, 256).alias("centroid_sha256"))


def pii_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and ``base_sha256`` are of the undisguised spans; ``spans`` lists these and those the transducers add."""
    found = pii.detect(read_documents(spark, sf_dir))
    plain = F.filter("spans", lambda s: s["plain"])

    def listed(spans: Column | str) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def number(kind: str) -> Column:
        return F.size(F.filter(plain, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [number(kind) for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(plain), 256).alias("base_sha256"), listed("spans").alias("spans"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": substring_query,
    "op2_byte_bpe": byte_bpe_query,
    "op3_ngram_jaccard": jaccard_query,
    "op4_phrase_fingerprint": fingerprint_query,
    "op5_packing": packing_query,
    "op6_quality": quality_query,
    "op7_toxicity": toxicity_query,
    "op8_language_id": language_query,
    "op9_exact_dedup": exact_dedup_query,
    "op10_pitman_yor": language_model_query,
    "op11_filter_audit": filter_audit_query,
    "op12_orchard": orchard_query,
    "op13_pii": pii_query,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _orchard_sql(k: int = 40, rounds: int = 5) -> str:
    """Plain rounds over all distances; every assignment is by (distance, number)."""
    parts = [f"""
        v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS p
              FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
        c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, p) - 1 AS c, p AS q FROM (
              SELECT sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h, p FROM v ORDER BY h, p LIMIT {k}))"""]
    for i in range(rounds + 1):
        parts.append(f"""
        a{i} AS MATERIALIZED (SELECT r, min((d, c)) AS best FROM (
              SELECT r, c, list_sum(list_transform(list_zip(p, q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v, c{i}) GROUP BY r)""")
        if i < rounds:
            parts.append(f"""
        m{i} AS (SELECT c, list(m ORDER BY i) AS q FROM (SELECT c, i, (s - ((s % n) + n) % n) // n AS m FROM (
              SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM (
                SELECT best[2] AS c, unnest(p) AS x, unnest(range(64)) AS i FROM v JOIN a{i} USING (r)) GROUP BY c, i)) GROUP BY c),
        c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(m{i}.q, c{i}.q) AS q FROM c{i} LEFT JOIN m{i} ON m{i}.c = c{i}.c)""")
    return f"""WITH {",".join(parts)}
        SELECT vec_id, best[2]::INT AS cluster, best[1]::BIGINT AS distance, (sum(best[1]) OVER (PARTITION BY best[2]))::BIGINT AS cluster_inertia,
               (sum(best[1]) OVER ())::BIGINT AS inertia, sha256(array_to_string(q, ',')) AS centroid_sha256
        FROM v JOIN a{rounds} USING (r) JOIN c{rounds} ON c = best[2]"""


ORACLE: dict[str, str] = {
    "op1_substring_dedup": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
        s AS (SELECT doc_id, i, w[i] AS word,
                     CASE WHEN i + 34 <= len(w) THEN array_to_string(w[i:i + 34], ' ') END AS win FROM p),
        r AS (SELECT doc_id, i, word, win IS NOT NULL AND count(*) OVER (PARTITION BY win) > 1 AS rep FROM s),
        c AS (SELECT doc_id, i, word,
                     max(rep::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM r),
        k AS (SELECT doc_id, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS kept FROM c GROUP BY doc_id)
        SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN k ON d.doc_id = k.doc_id""",
    "op3_ngram_jaccard": f"""
        WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.replace("coalesce(text, '')", f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, sh FROM (
                SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS sh FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0))),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id != b.doc_id
              JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
              GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))),
        r(v, u) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.v, l.b FROM r JOIN l ON r.u = l.a)
        SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
        FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT v, min(u) AS component_id FROM r GROUP BY v) c ON c.v = d.doc_id""",
    "op9_exact_dedup": f"""
        WITH n AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY t)""",
    "op11_filter_audit": f"""
        WITH l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
        d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
        f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                     (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
                     + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT
                     + 8 * regexp_matches(t, '[#$%&*|]')::INT
                     + 16 * coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)::INT AS fails
              FROM d LEFT JOIN l ON l.doc_id = d.doc_id),
        n AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
        x AS (SELECT unnest(range(5)) AS x),
        o AS (SELECT row_number() OVER () AS o, [a.x, b.x, c.x, d.x, e.x] AS p FROM x a, x b, x c, x d, x e
              WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        s AS (SELECT o, p, i AS step, 1 << p[i] AS bit, coalesce(list_sum(list_transform(p[1:i - 1], lambda z: 1 << z)), 0)::BIGINT AS before
              FROM o, (SELECT unnest(range(1, 6)) AS i)),
        r AS (SELECT part, o, p, step, bit,
                     sum(CASE WHEN fails & (before + bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
                     sum(CASE WHEN fails & before = 0 AND fails & bit != 0 THEN n ELSE 0 END)::BIGINT AS removed,
                     sum(CASE WHEN fails & before != 0 AND fails & bit != 0 THEN n ELSE 0 END)::BIGINT AS redundant,
                     sum(CASE WHEN fails = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
                     sum(CASE WHEN fails & before = 0 AND fails & bit != 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
                     sum(CASE WHEN fails & before = 0 AND fails & bit != 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
              FROM n, s GROUP BY part, o, p, step, bit)
        SELECT part, array_to_string(list_transform(p, lambda z: substr('ABCDE', z::INT + 1, 1)), '') AS filter_order, step::INT AS step,
               kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
        FROM r""",
    "op12_orchard": _orchard_sql(),
}
