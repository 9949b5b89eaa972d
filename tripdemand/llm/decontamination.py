"""Benchmark decontamination: which documents hold (nearly) all of a short test item.

Texts become lower-case words (runs of ASCII letters, digits and non-ASCII characters)
and sets of five-word shingles; a text of one to four words has one shingle of all of
them. A document holds an item if at least ``threshold`` of the item's shingles are in it.

Containment in a long document can't be told from Jaccard estimates of whole texts, so
items are partitioned by size and each partition gets min-wise sketches as long as its
largest items need: with n shingles at most n - ceil(threshold * n) may be missing, so
of that many plus one at least one is in every document sought. An item's sketch is that
many of its shingles, those with the smallest hashes. Documents holding a shingle of an
item's sketch are its candidates; none is lost. Candidates are then verified on the
words of the shingles themselves.

DataFrame functions only. Null and empty texts, and items without words, match nothing.
Decisions belong to texts: rows repeating a text share them, whatever their id (null too).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripdemand.llm.stored import stored

WORDS = 5
THRESHOLD = 0.8
#: Sizes of the partitions of items are the powers of this.
GROWTH = 2
#: Item shingles that may be broadcast (about 60 bytes each); beyond it they are joined by shuffling.
BROADCAST_ROWS = 500_000
NOT_WORD = r"[^a-z0-9\x{80}-\x{10FFFF}]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def shingle_hashes(w: Column) -> Column:
    """The hash of every shingle of the words column ``w``, by position."""
    n = F.size(w)
    parts = lambda i: [F.get(w, i + k) for k in range(WORDS)]
    full = F.transform(F.sequence(F.lit(0), n - WORDS), lambda i: F.xxhash64(*parts(i)))
    return F.when(n >= WORDS, full).when(n > 0, F.array(F.xxhash64(*parts(F.lit(0))))).otherwise(F.array().cast("array<bigint>"))


def shingle_text(w: Column, at: Column) -> Column:
    return F.concat_ws(" ", F.slice(w, at + 1, WORDS))


def exploded(texts: DataFrame, key: str, text_col: str) -> DataFrame:
    """(key, _hash, _shingle) of every shingle of every text; _shingle is only made where it is read."""
    cut = texts.select(key, words(F.col(text_col)).alias("_words"))
    return cut.select(key, "_words", F.posexplode(shingle_hashes(F.col("_words"))).alias("_at", "_hash"))


def text_key(text: Column) -> Column:
    """What rows with the same text share (128 bits)."""
    return F.unhex(F.md5(text.cast("binary")))


def item_sketches(items: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(item key, hash, shingle, n) of all item shingles, and (item key, hash) of the sketches."""
    shingles = exploded(items, "_item", "_item_text").select("_item", "_hash", shingle_text(F.col("_words"), F.col("_at")).alias("_shingle")).distinct()
    sizes = shingles.groupBy("_item").agg(F.count(F.lit(1)).alias("_n"))
    shingles = shingles.join(sizes, "_item")
    # the upper end of the size partition: no item in it has more shingles
    upper = F.pow(F.lit(float(GROWTH)), F.ceil(F.log(float(GROWTH), F.col("_n").cast("double")) - 1e-9))
    keep = F.least(F.col("_n").cast("double"), F.floor(upper * F.lit(1 - threshold) + 1e-9) + 1)
    ranked = F.array_sort(F.collect_set("_hash"))
    sketches = shingles.groupBy("_item", "_n").agg(ranked.alias("_all")).select("_item", F.explode(F.slice("_all", F.lit(1), keep.cast("int"))).alias("_hash"))
    return shingles, sketches


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most that many rows; as it is otherwise."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def find_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of a text and an item it holds: _key (of the text), item_id, n_shingles, n_matched, containment."""
    named = items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("_item_text")).distinct()
    named = named.withColumn("_item", text_key(F.col("_item_text")))
    shingles, sketches = item_sketches(named.select("_item", "_item_text").where("_item is not null").distinct(), threshold)
    shingles, sketches = stored(shingles), stored(sketches)
    texts = docs.select(F.col(text_col).alias("_text")).where(F.col("_text").isNotNull())
    keyed = texts.withColumn("_key", text_key(F.col("_text")))

    hits = exploded(keyed, "_key", "_text").select("_key", "_hash")
    candidates = stored(hits.join(small(sketches), "_hash").select("_key", "_item").distinct())
    sought = keyed.join(candidates.select("_key").distinct(), "_key", "left_semi").dropDuplicates(["_key"])
    inside = exploded(sought, "_key", "_text").join(small(shingles), "_hash").where(shingle_text(F.col("_words"), F.col("_at")) == F.col("_shingle"))
    matched = inside.select("_key", "_item", "_n", "_hash", "_shingle").distinct().groupBy("_key", "_item", "_n").agg(F.count(F.lit(1)).alias("n_matched"))
    verified = matched.join(candidates, ["_key", "_item"], "left_semi").where(F.col("n_matched") >= F.ceil(F.col("_n") * F.lit(threshold) - F.lit(1e-9)))
    out = verified.join(named.select("_item", "item_id"), "_item")
    return out.select("_key", "item_id", F.col("_n").alias("n_shingles"), "n_matched", (F.col("n_matched") / F.col("_n")).alias("containment"))


def contaminated_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how: object) -> DataFrame:
    """One row per document row and item it holds: id, item_id, n_shingles, n_matched, containment."""
    found = find_contaminated(docs, items, text_col, **how)
    return docs.select(F.col(id_col), text_key(F.col(text_col)).alias("_key")).join(found, "_key").drop("_key")


def without_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", **how: object) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    found = find_contaminated(docs, items, text_col, **how).select("_key").distinct().withColumnRenamed("_key", "_found_key")
    return docs.join(found, text_key(docs[text_col]) == found["_found_key"], "left_anti")
