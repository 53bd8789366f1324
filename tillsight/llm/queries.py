"""The registered query of each operator, and its SQL twin where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.staging import PACKAGE, stage, staging_root
from . import bpe, exact_dedup, jaccard_join, language, lexical, line_dedup, merkle, packing, ppm, sharding, simhash, substring_dedup, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_json(name: str = "word_bpe_49k.json") -> str:
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_json()).drop("ids")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", language.held_out())
    model = language.fit(docs.filter(~F.col("held_out")))
    # the model sees the text alone
    return language.predict(docs.select("doc_id", "held_out", "text"), model).drop("text")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = sharding.shard_by_slots(table(spark, sf_dir, "documents"))
    return rows


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(simhash.edited_fingerprints(table(spark, sf_dir, "documents")), "edited_fingerprints")
    near = stage(simhash.near_counts(rows), "near_counts")
    return rows.join(near, "fingerprint").select(
        "doc_id", "n_chars", "edited_sha256",
        simhash.as_hex("fingerprint").alias("fingerprint"), simhash.as_hex("edited_fingerprint").alias("edited_fingerprint"),
        simhash.likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        simhash.likeness("fingerprint", F.coalesce("next_fingerprint", F.lit(0).cast("long"))).alias("near_next"),
        "near_docs",
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{staging_root(spark)}/{PACKAGE}/{spark.sparkContext.applicationId}/warc-{uuid.uuid4().hex[:12]}"
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    rows = warc.captures(warc.read_warc(spark, path))
    page = lambda name: F.nullif(F.element_at(F.split(name, ":"), -1), F.lit("")).cast("long")
    again = F.col("response.record_type") == "revisit"
    return rows.select(
        page("capture_id").alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        # a response proves its digest by its payload; a revisit states that of the payload it stands for
        F.when(again, F.col("response.payload_digest")).otherwise(F.col("response.payload_sha256")).alias("payload_digest"),
        F.col("response.record_type").alias("record_type"),
        page("response.refers_to").alias("refers_to"),
    )


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, decoded=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    every_fifth = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = {"text": F.translate("text", lexical.UPPER, lexical.LOWER)}
    return merkle.verified_rows(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], lowered, every_fifth)


def op13_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, across=True)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_packing, op2_language, op3_jaccard_join, op4_exact_dedup, op5_sharding, op6_fingerprints, op7_warc, op8_bpe,
             op9_substring_dedup, op10_line_dedup, op11_lexical, op12_merkle, op13_ppm)
    return {f.__name__: f for f in found}


def merkle_sql(levels: int = 6) -> str:
    """Trees of up to 16 ** levels leaves or groups, a step for each level; the checksum runs over a table built from its polynomial."""
    def step(name: str, below: str) -> str:
        up = f"SELECT *, i // 16 AS j FROM {below} WHERE n > 1"
        return f"""
            {name} AS (
                SELECT k, j AS i, (n + 15) // 16 AS n, sha256(string_agg(h, '' ORDER BY i)) AS h
                FROM ({up}) GROUP BY k, j, n)"""

    def beside(name: str, below: str) -> str:
        # siblings of every node of a level: those of its run that stand before it and after it
        return f"""
            {name} AS (
                SELECT k, i, coalesce(string_agg(h, '' ORDER BY i) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
                       coalesce(string_agg(h, '' ORDER BY i) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
                FROM {below} WHERE n > 1 WINDOW w AS (PARTITION BY k, i // 16 ORDER BY i))"""

    def tree(t: str, first: str) -> list[str]:
        names = [first, *[f"{t}{v}" for v in range(1, levels + 1)]]
        return [*[step(b, a) for a, b in zip(names, names[1:], strict=False)], *[beside(f"{t}s{v}", names[v]) for v in range(levels)],
                f" {t}_root AS ({' UNION ALL '.join(f'SELECT k, h FROM {x} WHERE n = 1' for x in names)})"]

    def folds(t: str, source: str, key: str, at: str) -> list[str]:
        """Carry (proof so far, own hash) up a tree; a level of which the node has no run to share leaves both."""
        out, below = [], source
        for v in range(levels):
            out.append(f"""
            {t}f{v} AS (
                SELECT f.* EXCLUDE (proof, own), proof || coalesce(s.b, '') || coalesce(s.a, '') AS proof,
                       CASE WHEN s.i IS NULL THEN own ELSE sha256(s.b || own || s.a) END AS own
                FROM {below} f LEFT JOIN {t}s{v} s ON s.k = f.{key} AND s.i = f.{at} // {16 ** v})""")
            below = f"{t}f{v}"
        return out

    field = lambda c: f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}, '-')"
    leaf = "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", "text")) + ")"
    other = leaf.replace("text", "(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))")
    steps = [
        """ crc_table AS (
                SELECT list(list_reduce(list_concat([r], [0, 0, 0, 0, 0, 0, 0, 0]),
                            lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY r) AS t
                FROM range(256) AS g(r))""",
        f"""
            raw AS (
                SELECT doc_id, source, {leaf} AS leaf, {other} AS other,
                       xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                           lambda crc, c: xor(crc >> 8, t[(xor(crc, c) & 255) + 1])), 4294967295) % 5 = 0 AS touched
                FROM documents, crc_table)""",
        """
            numbered AS (
                SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS k,
                       row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM raw)""",
        " g0 AS (SELECT k, pos AS i, count(*) OVER (PARTITION BY k) AS n, leaf AS h FROM numbered)",
        *tree("g", "g0"),
        " t0 AS (SELECT 0 AS k, k AS i, (SELECT count(*) FROM g_root) AS n, h FROM g_root)",
        *tree("t", "t0"),
        " begin AS (SELECT *, 0 AS zero, '' AS proof, CASE WHEN touched THEN other ELSE leaf END AS own FROM numbered)",
        *folds("g", "begin", "k", "pos"),
        *folds("t", f"gf{levels - 1}", "zero", "k"),
    ]
    return f"""
            WITH {','.join(steps)}
            SELECT f.doc_id, f.leaf, r.h AS subroot, t.h AS root, sha256(f.proof) AS proof_sha256, f.own AS folded_root, f.own = t.h AS verified
            FROM tf{levels - 1} f JOIN g_root r ON r.k = f.k CROSS JOIN t_root t"""


def oracle() -> dict[str, str]:
    return {
        "op12_merkle": merkle_sql(),
        "op11_lexical": r"""
            WITH terms AS (
                SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
            tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
            lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
            totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS l FROM lengths),
            df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
            wanted AS (
                SELECT item_id, term, count(*) AS times FROM (
                    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
            weights AS (
                SELECT item_id, term, times * floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
                FROM wanted JOIN df USING (term), totals),
            scores AS (
                SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // l))))::BIGINT AS score
                FROM weights JOIN tf USING (term) JOIN lengths USING (doc_id), totals GROUP BY item_id, doc_id),
            ranked AS (
                SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
                FROM scores WHERE score > 0)
            SELECT * FROM ranked WHERE rank <= 20""",
        "op4_exact_dedup": r"""
            WITH t AS (
                SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
            SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
                   doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
            FROM t WINDOW w AS (PARTITION BY norm)""",
        "op7_warc": """
            WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
            d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest,
                         min(page_id) OVER (PARTITION BY payload) AS origin FROM p)
            SELECT page_id, payload_bytes, payload_digest,
                   CASE WHEN payload_bytes >= 100 AND origin <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
                   CASE WHEN payload_bytes >= 100 AND origin <> page_id THEN origin END AS refers_to
            FROM d""",
        "op10_line_dedup": r"""
            WITH docs AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
            spots AS (
                SELECT doc_id, line, l[line + 1] || chr(10) || l[line + 2] || chr(10) || l[line + 3] AS run
                FROM (SELECT doc_id, l, unnest(range(len(l) - 2)) AS line FROM docs WHERE len(l) >= 3)),
            later AS (
                SELECT doc_id, line FROM (
                    SELECT doc_id, line, row_number() OVER (PARTITION BY run ORDER BY doc_id, line) AS k
                    FROM spots WHERE regexp_matches(run, '\S')) WHERE k > 1),
            covered AS (SELECT DISTINCT doc_id, line + d AS line FROM later, (VALUES (0), (1), (2)) AS o(d)),
            kept AS (
                SELECT s.doc_id, string_agg(s.txt, chr(10) ORDER BY s.line) AS text, count(c.line) AS dummy
                FROM (SELECT doc_id, unnest(l) AS txt, unnest(range(len(l))) AS line FROM docs) s
                LEFT JOIN covered c ON s.doc_id = c.doc_id AND s.line = c.line
                WHERE c.line IS NULL GROUP BY s.doc_id),
            removed AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id)
            SELECT d.doc_id, CASE WHEN r.n IS NULL THEN d.text ELSE coalesce(k.text, '') END AS text,
                   CAST(len(d.l) AS INTEGER) AS lines, CAST(coalesce(r.n, 0) AS INTEGER) AS removed_lines
            FROM docs d LEFT JOIN kept k USING (doc_id) LEFT JOIN removed r USING (doc_id)""",
    }
