"""Mixing the documents of many sources to target weights, by repeating or thinning them.

1. Words are counted per document and summed per source.
2. Sources, ordered by code point with null last, weigh 5, 2, 1 over and over, and share
   the words of the whole corpus by weight. No source gives more than ``most`` times its
   own words; what it cannot give is shared by the others. The share of one unit of weight
   follows from whole numbers alone: (words left to share) / (weights left). A source whose
   limit lies within its share stops there, which raises the share of the others, until
   none is above its limit. Each step is one aggregation over the sources' table.
3. A source's rate is its target over its own words. A document is taken floor(rate) times,
   and once more with a probability equal to the fraction. The draw is a digest of the seed,
   the id and the text's digest, so reruns and retries agree.

Null texts and texts without words have size 0; a source without words has target 0 and its
documents are taken 0 times. A null source is a source of its own. Repeated rows share one
draw (rows that differ in id or text have their own). An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripdemand.llm.row_order import places
from tripdemand.llm.stored import stored, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix-1"
#: A source's rows are joined to its rate under so many keys, so that a large one is split.
SALTS = 64
#: Whole numbers of up to 38 digits: words times weights.
WHOLE = "decimal(38,0)"


def weighted(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size) with ``weight``, dealt out over the sources in order of code points, null last."""
    cycle = F.array(*(F.lit(w) for w in weights))
    placed = places(sources, [F.col("source").asc_nulls_last()])
    return placed.withColumn("weight", F.element_at(cycle, (F.col("pos") % len(weights) + 1).cast("int")).cast("long")).drop("pos", "size")


def targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """(source, source_size, weight) with ``target`` and ``rate``.

    The driver holds two whole numbers: the words and the weights that sources below their
    limit share. Both only fall, so the loop ends.
    """
    sources = stored(sources)
    limit = (F.col("source_size") * most).cast(WHOLE)
    total = sources.agg(F.sum(F.col("source_size").cast(WHOLE)), F.sum("weight")).first()
    words, weights = int(total[0] or 0), int(total[1] or 0)
    whole = words
    while True:
        stopped = limit * F.lit(weights).cast("decimal(18,0)") <= F.col("weight").cast("decimal(18,0)") * F.lit(words).cast(WHOLE)
        held, free = sources.agg(F.sum(F.when(stopped, limit)), F.sum(F.when(~stopped, F.col("weight")))).first()
        step = whole - int(held or 0), int(free or 0)
        if step == (words, weights):
            break
        words, weights = step
        if not weights:  # every source gives all it can
            break
    if weights:
        share = F.lit(float(words)) * F.col("weight") / F.lit(float(weights))
        target = F.when(stopped, limit.cast("double")).otherwise(share)
    else:
        target = limit.cast("double")
    return sources.withColumn("target", target).withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number from 0 up to 1 that follows from the seed, the id and the text."""
    of = F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("-")), F.coalesce(F.sha2(text, 256), F.lit("-")))
    return F.conv(F.substring(F.sha2(of, 256), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def repetitions(docs: DataFrame, keep: list[Column], weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per input row: the columns of ``keep``, size, source_size, target and ``copies``.

    Texts are read once; what is written and joined has ``keep``, four numbers and the source.
    The rates reach the rows under (source, salt), the keys by which rows were summed up
    before, so a source with a third of all rows is no single task's work.
    """
    kept = [f"_keep{i}" for i in range(len(keep))]
    text = F.col(text_col)
    sized = written(docs.select(
        *(c.alias(k) for c, k in zip(keep, kept, strict=True)), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        draw(F.col(id_col), text, seed).alias("_draw"), (F.monotonically_increasing_id() % SALTS).cast("int").alias("_salt"),
    ), "sized")
    parts = written(sized.groupBy("source", "_salt").agg(F.sum("size").alias("source_size")), "salted_sources")
    rates = targets(weighted(parts.groupBy("source").agg(F.sum("source_size").alias("source_size")), weights), most)
    rates = rates.select(F.col("source").alias("_of"), "source_size", "target", "rate")
    salted = parts.select(F.col("source").alias("_s"), F.col("_salt").alias("_t")).join(rates, F.col("_s").eqNullSafe(F.col("_of"))).drop("_of")
    # written, so that its measured size decides whether it is broadcast
    salted = written(salted, "rates")
    joined = sized.join(salted, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_salt") == F.col("_t")))
    copies = F.floor("rate") + (F.col("_draw") < F.col("rate") - F.floor("rate")).cast("long")
    names = docs.select(*keep).columns
    return joined.select(*(F.col(k).alias(n) for k, n in zip(kept, names, strict=True)), "size", "source_size", "target", copies.alias("copies"))


def mixture(docs: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """The mix itself: every input row as often as it is taken, with ``copy`` from 1."""
    taken = repetitions(docs, [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")], id_col=id_col, **settings)
    return taken.where("copies > 0").select("_row.*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
