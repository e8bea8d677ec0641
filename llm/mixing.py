"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target in words: its share of the total by weight, at most ``limit`` times what it has, the excess
shared again by weight (a water level over sources sorted by what they can take per unit of weight). A document of a
source with target / size = f gets floor(f) whole copies for certain. Of the rest, f - floor(f), a Pareto sample is
drawn: with inclusion probability p and a fixed random number u per document, documents are ranked by
(u / (1 - u)) / (p / (1 - p)), and the first ones are taken until their words reach what the source still lacks, to the
nearest document. Documents may bring own weights (``weight_col``), by which probabilities differ within a source.

Ranks are cut up for scale: the ranking number, mapped to (0, 1), falls into ``buckets`` buckets per source; totals of
buckets give each bucket the words before it, and only the rows of one bucket are sorted together. A hot source is thus
many sorts, whose results are joined by a table of at most sources x buckets rows.

Defined cases: a null or empty text has size 0, which is always taken 0 times; a null source is a source of its own,
sorted last; sources with no words have target 0; repeated rows and null ids count like other rows (ties in the random
number, which is drawn from the id, are broken by size and are otherwise alike); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from llm.common import WORD, durable

BUCKETS = 4096


def source_targets(sizes: DataFrame, weights: list[int], limit: int = 3) -> DataFrame:
    """``sizes``: one row per source (source, source_size). Adds target; weights repeat over the sorted sources.

    The windows run over one row per source, of which there are few by nature."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*[F.lit(w) for w in weights])
    rows = sizes.withColumn("weight", F.element_at(cycle, (F.row_number().over(by_name) - 1) % len(weights) + 1))
    rows = rows.withColumn("cap", F.col("source_size") * limit)
    # in this order, sources are full from the first on; the level is what the others get per unit of weight
    by_room = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything)
    rows = rows.withColumn("level", (total - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                           / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    full = F.col("cap") <= F.col("level") * F.col("weight")
    # the first source that is not full fixes the level of all that follow
    level = F.min(F.when(~full, F.struct((F.col("cap") / F.col("weight")).alias("r"), F.col("source").isNull().alias("n"),
                                         "source", "level"))).over(everything)["level"]
    return rows.select("source", "source_size", F.when(full, F.col("cap").cast("double")).otherwise(level * F.col("weight")).alias("target"))


def uniform(seed: str, *columns: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of an MD5 sum: alike in every run and on every engine."""
    text = F.concat_ws("|", F.lit(seed), *columns)
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))


def mix(docs: DataFrame, weights: list[int], id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        limit: int = 3, seed: str = "mix", weight_col: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """(id, size, source_size, target, taken), one row per row of ``docs``; ``taken`` is a whole multiple of size."""
    own = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.greatest(F.coalesce(own, F.lit(0.0)), F.lit(0.0)).alias("own"),
                       uniform(seed, F.col(id_col).cast("string")).alias("u"))
    rows = durable(rows, "mix")
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("own") * F.col("size")).alias("weighed"))
    targets = source_targets(sums.select("source", "source_size"), weights, limit)
    per_source = targets.alias("t").join(sums.select("source", "weighed").alias("w"), F.expr("t.source <=> w.source")).select(
        "t.source", "source_size", "target", "weighed")
    # expected copies: the source's factor times the document's own weight, whole copies first
    known = rows.alias("r").join(per_source.alias("s"), F.expr("r.source <=> s.source")).select(
        "r.id", "r.source", "size", "own", "u", "source_size", "target", "weighed")
    copies = F.least(F.when(F.col("weighed") > 0, F.col("target") / F.col("weighed") * F.col("own")).otherwise(F.lit(0.0)), F.lit(float(limit)))
    known = known.withColumn("copies", copies).withColumn("whole", F.floor("copies")).withColumn("p", F.col("copies") - F.col("whole"))
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    drawn = (F.col("p") > 0) & (F.col("size") > 0)
    known = known.withColumn("order", F.when(drawn, odds))
    known = known.withColumn("bucket", F.when(drawn, F.floor(F.col("order") / (1 + F.col("order")) * buckets).cast("int")).otherwise(F.lit(-1)))
    # words of certain copies and of each bucket, by partial sums; then the bucket in which a source reaches its target
    totals = known.groupBy("source", "bucket").agg(
        F.sum(F.when(drawn, F.col("size")).otherwise(0)).alias("words"), F.sum(F.col("size") * F.col("whole")).alias("certain"),
        F.max("target").alias("target"))
    source = Window.partitionBy("source")
    so_far = source.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = totals.select("source", "bucket", "words", F.sum("words").over(so_far).alias("after"),
                           (F.col("target") - F.sum("certain").over(source)).alias("lacks"))
    cuts = totals.filter((F.col("bucket") >= 0) & (F.col("after") > F.col("lacks"))).groupBy("source").agg(
        F.min(F.struct("bucket", (F.col("after") - F.col("words")).alias("before"), "lacks")).alias("cut"))
    joined = known.alias("k").join(cuts.alias("c"), F.expr("k.source <=> c.source"), "left").select("k.*", "c.cut")
    at_cut = F.coalesce(F.col("bucket") == F.col("cut.bucket"), F.lit(False))
    below = (F.col("bucket") >= 0) & F.coalesce(F.col("bucket") < F.col("cut.bucket"), F.lit(True))
    sure = joined.filter(~at_cut).withColumn("extra", below.cast("int"))
    # within the cut bucket a document is taken where its middle lies below the cut: the total is then the nearest one
    ahead = F.coalesce(F.sum("size").over(source.orderBy("order", "size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = joined.filter(at_cut).withColumn("ahead", F.col("cut.before") + ahead)
    ranked = ranked.withColumn("extra", (2 * F.col("ahead") + F.col("size") <= 2 * F.col("cut.lacks")).cast("int")).drop("ahead")
    return sure.unionByName(ranked).select(
        F.col("id").alias(id_col), "size", "source_size", "target",
        (F.col("size") * (F.col("whole") + F.col("extra"))).cast("long").alias("taken"))
