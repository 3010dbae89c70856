"""Queries over the corpus tables, one for each operator, and their expected results in SQL where SQL has them."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import codebooks, contamination, fingerprints, language, mixing, packing, periods, quality, rendering, simhash, substrings, topk, urls
from riskframe.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """All pages, and all documents with their source in the place of a host."""
    docs, pages = table(spark, folder, "documents"), table(spark, folder, "pages")
    model = language.fit(docs)
    shown = ("lang", "confidence", "text_lang", "declared", "host")
    by_page = language.fuse(language.page_evidence(pages, model), model).select(F.col("id").alias("page_id"), F.lit(None).cast("long").alias("doc_id"), *shown)
    by_text = language.fuse(language.text_evidence(docs, model, host=F.col("source")), model).select(F.lit(None).cast("long").alias("page_id"), F.col("id").alias("doc_id"), *shown)
    return by_page.unionByName(by_text)


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")


def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), with_ids=False)


def op4_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, folder, "documents"))
    words = F.filter(F.split(F.coalesce("kept", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.array_join(words, " "), 256).alias("kept_sha256"))


def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.train(docs, table(spark, folder, "labels")))
    return scored.select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op8_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return rendering.extract(table(spark, folder, "pages"))


def op10_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, folder, "documents"))


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return codebooks.compress(table(spark, folder, "embeddings"))


def repeat_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a tenth of the documents, chosen by id, repeat with a period from some place on; a null id is left alone."""
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    return words[:first] + [words[first + i % period] for i in range(n - first)]


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periods.summaries(table(spark, folder, "documents"), edit=repeat_tail)


def op13_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_url_filter": op2_url_filter,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_exact_topk": op4_exact_topk,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_source_mixing": op8_source_mixing,
    "op9_html_extraction": op9_html_extraction,
    "op10_document_fingerprints": op10_document_fingerprints,
    "op11_vector_codes": op11_vector_codes,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_decontamination": op13_decontamination,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_FOLDED = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

def _assigned(book: str) -> str:
    """Each part with its nearest entry and the squared distance to it."""
    return f"""SELECT vec_id, label, position, part, min(sq * 64 + entry) % 64 AS entry, min(sq * 64 + entry) // 64 AS sq
            FROM (SELECT p.*, b.entry, CAST(list_sum(list_transform(list_zip(p.part, b.part), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS sq
                FROM parts p JOIN {book} b USING (position))
            GROUP BY vec_id, label, position, part"""


def _moved(assigned: str, book: str) -> str:
    """The codebook after a round."""
    means = ", ".join(f"CAST(floor(sum(part[{i}]) / count(*)) AS BIGINT)" for i in range(1, 5))
    return f"""SELECT b.position, b.entry, coalesce(m.part, b.part) AS part FROM {book} b LEFT JOIN (
            SELECT position, entry, [{means}] AS part FROM {assigned} GROUP BY position, entry) m USING (position, entry)"""


ORACLE: dict[str, str] = {
    "op11_vector_codes": f"""
        WITH kept AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), parts AS (
            SELECT vec_id, label, position, v[position * 4 + 1:position * 4 + 4] AS part FROM (SELECT *, unnest(range(16)) AS position FROM kept)
        ), book0 AS (
            SELECT position, entry, part
            FROM (SELECT *, row_number() OVER (PARTITION BY position ORDER BY vec_id) - 1 AS entry FROM parts) WHERE entry < 64
        ), assigned0 AS ({_assigned("book0")}), book1 AS MATERIALIZED ({_moved("assigned0", "book0")}),
        assigned1 AS ({_assigned("book1")}), book2 AS MATERIALIZED ({_moved("assigned1", "book1")}),
        assigned2 AS ({_assigned("book2")}),
        coded AS (
            SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY position) AS code, CAST(sum(sq) AS BIGINT) AS error
            FROM assigned2 GROUP BY vec_id, label
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
            (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY position, entry)) FROM book2) AS codebooks_sha256
        FROM coded
    """,
    "op13_decontamination": f"""
        WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_FOLDED} AS words FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS content, least(10, len(words)) AS size
            FROM (SELECT *, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i FROM items WHERE len(words) > 0)
        ), docs AS (SELECT doc_id, {_FOLDED} AS words FROM documents),
        stretches AS (
            SELECT doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') AS content
            FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i
                FROM docs CROSS JOIN (SELECT DISTINCT size FROM windows) WHERE size <= len(words))
        ), met AS (
            SELECT doc_id, i, size, item_id FROM stretches JOIN windows USING (size, content)
        ), hit AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS place FROM met) GROUP BY doc_id),
        named AS (
            SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
            FROM (SELECT DISTINCT doc_id, item_id FROM met) GROUP BY doc_id
        )
        SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
            CAST(coalesce(m.n, 0) AS BIGINT) AS n_items, sha256(coalesce(m.ids, '')) AS items_sha256, h.n IS NOT NULL AS contaminated
        FROM docs d LEFT JOIN hit h USING (doc_id) LEFT JOIN named m USING (doc_id)
    """,
    "op5_substring_dedup": f"""
        WITH split AS (SELECT doc_id, {_WORDS} AS words FROM documents),
        placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place, len(words) AS n FROM split),
        windows AS (
            SELECT doc_id, place, n, string_agg(word, ' ') OVER (
                PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING) AS content
            FROM placed
        ), repeated AS (
            SELECT doc_id, place FROM windows WHERE place + 34 <= n
            QUALIFY count(*) OVER (PARTITION BY content) > 1
        ), covered AS (SELECT DISTINCT doc_id, unnest(range(place, place + 35)) AS place FROM repeated),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
            FROM placed ANTI JOIN covered USING (doc_id, place) GROUP BY doc_id
        )
        SELECT s.doc_id, CAST(len(s.words) AS BIGINT) AS n_words, CAST(len(s.words) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
            sha256(coalesce(k.text, '')) AS kept_sha256
        FROM split s LEFT JOIN kept k USING (doc_id)
    """,
    "op8_source_mixing": f"""
        WITH sized AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents),
        sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
        weighed AS (
            SELECT *, 2e0 * source_size AS cap, [5e0, 2e0, 1e0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
            FROM sources
        ), levels AS (
            SELECT *, cap / weight AS ratio, 15e-1 * sum(source_size) OVER () AS total, sum(weight) OVER () AS heavy,
                coalesce(sum(cap) OVER before, 0e0) AS caps, coalesce(sum(weight) OVER before, 0e0) AS weights
            FROM weighed
            WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), stopped AS (SELECT *, ratio <= (total - caps) / (heavy - weights) AS stops FROM levels),
        targets AS (
            SELECT source, source_size, CASE WHEN stops THEN cap ELSE
                (total - sum(CASE WHEN stops THEN cap ELSE 0e0 END) OVER ()) * weight
                / (heavy - sum(CASE WHEN stops THEN weight ELSE 0e0 END) OVER ()) END AS target
            FROM stopped
        ), drawn AS (
            SELECT s.doc_id, s.size, t.*, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0e0 END AS ratio,
                (CAST(CAST('0x' || substr(md5('mix:' || s.doc_id), 1, 12) AS BIGINT) AS DOUBLE) + 0.5e0) / 281474976710656e0 AS u
            FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
        ), ranked AS (
            SELECT *, ratio - floor(ratio) AS p, target - floor(ratio) * source_size AS rest FROM drawn
        ), odds AS (
            SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q FROM ranked
        ), chosen AS (
            SELECT *, coalesce(q IS NOT NULL AND sum(size) OVER (PARTITION BY source ORDER BY q, u, doc_id) <= rest, false) AS chosen
            FROM odds
        ), gaps AS (
            SELECT *, rest - sum(CASE WHEN chosen THEN size ELSE 0 END) OVER (PARTITION BY source) AS gap FROM chosen
        ), lasts AS (
            SELECT *, NOT chosen AND abs(size - gap) < gap AND row_number() OVER (
                PARTITION BY source, chosen ORDER BY abs(size - gap), q, doc_id) = 1 AS last
            FROM gaps
        )
        SELECT doc_id, size, source_size, target,
            CAST((floor(ratio) + CASE WHEN chosen OR last THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
        FROM lasts
    """,
    "op4_exact_topk": """
        WITH usable AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
            FROM usable q JOIN usable c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 20 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM scored
        QUALIFY rank <= 20
    """,
}
