"""The registered query of each operator, over its whole table, and its oracle SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripdemand.llm.decontamination import contaminated_documents
from tripdemand.llm.exact_topk import exact_topk
from tripdemand.llm.html_extraction import extract_main_text
from tripdemand.llm.language_id import fit_prototypes, predict_language
from tripdemand.llm.manifest_oracles import MERKLE, MIXING, RUNS
from tripdemand.llm.merkle_manifest import merkle_proofs
from tripdemand.llm.ngram_join import near_duplicate_classes
from tripdemand.llm.periodic_runs import periodic_runs, with_repeated_tail
from tripdemand.llm.secret_scan import scan_secrets
from tripdemand.llm.sentencepiece_codec import encode_documents
from tripdemand.llm.source_mixing import repetitions
from tripdemand.llm.substring_chunks import repeated_documents
from tripdemand.llm.suffix_dedup import remove_repeated
from tripdemand.llm.token_packing import pack_documents


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """The file of a public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_documents(table(spark, sf_dir, "documents"), whole=True)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(spark, sf_dir, "documents"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    # the vocabulary ends at 50255; the next id is free and closes a document
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, 50256)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated(table(spark, sf_dir, "documents"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    labels, prototypes = fit_prototypes(docs.where(~held_out))
    return predict_language(docs, labels, prototypes, [F.col("doc_id"), held_out.alias("held_out")])


def checksum(number: Column) -> Column:
    """The unsigned crc32 of a whole number's decimal digits."""
    return F.crc32(number.cast("string").cast("binary"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", with_repeated_tail(F.col("text"), checksum(F.col("doc_id"))).alias("text"))
    return periodic_runs(docs, [F.col("doc_id")])


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.when(checksum(F.col("doc_id")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle_proofs(docs, ["doc_id", "source", "lang", "n_chars", "text"], [F.col("doc_id")], {"text": tampered})


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = repetitions(table(spark, sf_dir, "documents"), [F.col("doc_id")])
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1,
    "op2_html_extraction": op2,
    "op3_sentencepiece": op3,
    "op4_secret_scan": op4,
    "op5_substring_dedup": op5,
    "op6_ngram_jaccard": op6,
    "op7_token_packing": op7,
    "op8_suffix_dedup": op8,
    "op9_exact_topk": op9,
    "op10_language_id": op10,
    "op11_periodic_runs": op11,
    "op12_merkle_manifest": op12,
    "op13_source_mixing": op13,
}

_WORDS = r"regexp_extract_all(lower({}), '[a-z0-9\x{{80}}-\x{{10FFFF}}]+')"


def _shingles(key: str, text: str, source: str) -> str:
    """(key, s) of the distinct five-word shingles, as text, of every text that is not null."""
    return f"""
        SELECT DISTINCT k, array_to_string(w[i + 1 : i + 5], ' ') AS s
        FROM (SELECT k, w, unnest(range(greatest(1, len(w) - 4))) AS i
              FROM (SELECT {key} AS k, {_WORDS.format(text)} AS w FROM {source} WHERE {text} IS NOT NULL) WHERE len(w) > 0)"""


ORACLE: dict[str, str] = {
    "op1_decontamination": f"""
        WITH item AS ({_shingles('item_id', 'text', 'benchmark')}),
             size AS (SELECT k, count(*) AS n FROM item GROUP BY k),
             doc AS ({_shingles('doc_id', 'text', 'documents')}),
             hit AS (SELECT doc.k AS doc_id, item.k AS item_id, count(*) AS n FROM doc JOIN item ON doc.s = item.s GROUP BY ALL)
        SELECT doc_id, item_id, size.n AS n_shingles, hit.n AS n_matched, hit.n / size.n AS containment
        FROM hit JOIN size ON item_id = k WHERE hit.n >= ceil(0.8 * size.n - 1e-9)""",
    "op6_ngram_jaccard": f"""
        WITH RECURSIVE sh AS ({_shingles('doc_id', 'text', 'documents')}),
             doc AS (SELECT k, count(*) AS n, list(s ORDER BY s) AS l FROM sh GROUP BY k),
             rep AS (SELECT k, min(k) OVER (PARTITION BY l) AS r, n FROM doc),
             own AS (SELECT r, s, n FROM rep JOIN sh ON sh.k = r WHERE rep.k = r),
             pair AS (SELECT a.r AS a, b.r AS b FROM own a JOIN own b ON a.s = b.s AND a.r <> b.r
                      GROUP BY a.r, b.r, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9),
             reach AS (SELECT a, b FROM pair UNION SELECT reach.a, pair.b FROM reach JOIN pair ON reach.b = pair.a),
             cls AS (SELECT a, least(a, min(b)) AS c FROM reach GROUP BY a),
             links AS (SELECT a, count(*) AS n FROM pair GROUP BY a)
        SELECT d.doc_id, coalesce(c, r, d.doc_id) AS class_id, coalesce(links.n, 0) AS n_links
        FROM documents d LEFT JOIN rep ON d.doc_id = rep.k LEFT JOIN cls ON r = cls.a LEFT JOIN links ON r = links.a
        WHERE d.doc_id IS NOT NULL""",
    "op9_exact_topk": """
        WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
                   FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score, a.r AS query
                   FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
             r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op11_periodic_runs": RUNS,
    "op12_merkle_manifest": MERKLE,
    "op13_source_mixing": MIXING,
}
