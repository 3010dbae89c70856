"""Mixing sources to target weights with Pareto order sampling (Rosen, 1997).

A source whose target is r times its words takes every document floor(r) times for certain. The rest is a
sample without replacement: documents are ranked by random odds over inclusion odds, (u / (1 - u)) /
(p / (1 - p)), and taken in that order up to a fixed size, measured in words. The last place goes to the
document that fits the remaining gap best, so a source misses its target by half its longest document at
most, and by a few words where it has many documents.

Ranking needs no global sort: the rank values are cut into bins, words are summed per source and bin, and
only the documents of the bin in which the size is reached are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import fresh, stage
from riskframe.operators.skew import splittable

#: Weights by position of the source, repeating.
WEIGHTS = (5, 2, 1)
SHARE, LIMIT = 1.5, 2.0
BINS = 4096


def size(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, *, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) for each source.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share`` times all words. A
    target stops at ``limit`` times its source's words; what is cut is shared again by weight, until none is
    above. In ascending order of limit over weight the sources that stop come first, so running sums find them.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("double")
    ranked = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(limit))
    ranked = ranked.withColumn("ratio", F.col("cap") / F.col("weight"))
    ordered = Window.orderBy("ratio", F.col("source").isNull(), "source")
    before, everything = ordered.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    cut = lambda name: F.coalesce(F.sum(name).over(before), F.lit(0.0))
    ranked = ranked.withColumn("total", F.sum("source_size").over(everything) * F.lit(share)).withColumn("heavy", F.sum("weight").over(everything))
    ranked = ranked.withColumn("level", (F.col("total") - cut("cap")) / (F.col("heavy") - cut("weight")))
    ranked = ranked.withColumn("stops", F.col("ratio") <= F.col("level"))
    stopped = lambda name: F.sum(F.when(F.col("stops"), F.col(name)).otherwise(0.0)).over(everything)
    ranked = ranked.withColumn("left", F.col("total") - stopped("cap")).withColumn("heavy", F.col("heavy") - stopped("weight"))
    shared = F.col("left") * F.col("weight") / F.col("heavy")
    return ranked.select("source", "source_size", F.when(F.col("stops"), F.col("cap")).otherwise(shared).alias("target"))


def uniform(seed: str) -> Column:
    """A number in (0, 1) from the id, the same in every run."""
    text = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") + 0.5) / float(2**48)


_ROW = ("q", "u", "doc_id", "size", "key")


def _narrow(df: DataFrame, id_col: str, text_col: str, source_col: str) -> list[Column]:
    """What decides about a row; the same expressions on whole rows and on narrow ones."""
    named = (F.col(id_col).cast("long"), F.col(source_col).cast("string"), F.xxhash64(F.col(text_col)), size(F.col(text_col)))
    return [c.alias(name) for c, name in zip(named, ("doc_id", "source", "key", "size"), strict=True)]


def _with_odds(rows: DataFrame, sources: DataFrame, seed: str) -> DataFrame:
    """Rows with what their source gives them: whole copies ``sure``, the ``rest`` in words, and their rank ``q`` in it."""
    full = rows.withColumn("u", uniform(seed)).join(splittable(sources.withColumnRenamed("source", "_source")), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    full = full.withColumn("sure", F.floor(ratio)).withColumn("p", ratio - F.floor(ratio))
    full = full.withColumn("rest", F.col("target") - F.col("sure") * F.col("source_size"))
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    return full.withColumn("q", F.when(F.col("p") > 0, odds))


def _times(rows: DataFrame) -> Column:
    """How often a row is taken, from its source's ``cut`` (the last one in order that is drawn) and ``last``."""
    mine = F.struct(*_ROW)
    chosen = F.col("q").isNotNull() & F.coalesce(mine <= F.col("cut"), F.lit(False))
    is_last = F.col("last").isNotNull() & F.col("doc_id").eqNullSafe(F.col("last.doc_id")) & (F.col("key") == F.col("last.key"))
    return (F.col("sure") + F.when(chosen | F.coalesce(is_last, F.lit(False)), 1).otherwise(0)).cast("long")


def decisions(rows: DataFrame, *, seed: str, bins: int, **rules) -> DataFrame:
    """(source, source_size, target, cut, last): all that decides about the rows (doc_id, source, key, size) of a source."""
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = stage(targets(sums, **rules), "targets")
    full = _with_odds(rows, goals, seed).withColumn("bin", F.floor(F.col("q") / (1 + F.col("q")) * bins))
    full = stage(full.filter("q is not null").select("source", "rest", "bin", *_ROW), "ranked")

    # The bin of each source in which the size is reached.
    by_bin = full.groupBy("source", "bin").agg(F.sum("size").alias("n"), F.first("rest").alias("rest"), F.max(F.struct(*_ROW)).alias("most"))
    by_bin = stage(by_bin, "bins")
    running = Window.partitionBy("source").orderBy("bin")
    through = by_bin.withColumn("through", F.sum("n").over(running)).withColumn("so_far", F.max("most").over(running.rowsBetween(Window.unboundedPreceding, -1)))
    edge = through.filter(F.col("through") > F.col("rest")).groupBy("source")
    edge = edge.agg(F.min("bin").alias("edge"), F.min_by(F.col("through") - F.col("n"), "bin").alias("below"), F.min_by("so_far", "bin").alias("so_far"))
    edge = stage(edge.withColumnRenamed("source", "_source"), "edges")
    of_source = F.col("source").eqNullSafe(F.col("_source"))
    # Inside that bin, in order, while the size is not passed; repeated rows are peers in the range frame.
    inside = full.join(edge, of_source & (F.col("bin") == F.col("edge"))).drop("_source")
    order = Window.partitionBy("source").orderBy(*_ROW).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("chosen", F.col("below") + F.sum("size").over(order) <= F.col("rest")).filter("chosen")
    ends = inside.groupBy("source").agg(F.max(F.struct(*_ROW)).alias("within"))
    whole = through.groupBy("source").agg(F.max("most").alias("all"))  # of a source whose rest takes all of its rows
    cuts = _beside(_beside(whole, edge.withColumnRenamed("_source", "source")), ends)
    cuts = cuts.select("source", F.when(F.col("edge").isNull(), F.col("all")).otherwise(F.coalesce("within", "so_far")).alias("cut"))
    cuts = stage(cuts, "cuts").withColumnRenamed("source", "_source")

    # The last place: the document that leaves the least gap, if it lessens it at all.
    drawn = full.join(splittable(cuts), of_source).withColumn("chosen", F.coalesce(F.struct(*_ROW) <= F.col("cut"), F.lit(False)))
    got = drawn.groupBy("source").agg((F.first("rest") - F.sum(F.when(F.col("chosen"), F.col("size")).otherwise(0))).alias("gap"))
    gaps = stage(got, "gaps").withColumnRenamed("source", "_gap")
    error = F.abs(F.col("size") - F.col("gap"))
    open_rows = drawn.filter(~F.col("chosen")).join(splittable(gaps), F.col("source").eqNullSafe(F.col("_gap"))).filter(error < F.col("gap"))
    last = open_rows.groupBy("source").agg(F.min(F.struct(error.alias("error"), "q", "doc_id", "size", "key")).alias("last"))
    return stage(_beside(_beside(goals, cuts.withColumnRenamed("_source", "source")), last), "decisions")


def _beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join of two tables with one row for each source, null included."""
    right = right.withColumnRenamed("source", "_right")
    return left.join(right, F.col("source").eqNullSafe(F.col("_right")), "left").drop("_right")


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix", bins: int = BINS, **rules) -> DataFrame:
    """(doc_id, source, key, size, source_size, target, times, taken), one row for each row of ``docs``.

    ``times`` says how often the whole document is in the mix, ``taken`` counts its words that often; ``key`` is
    a hash of the text. Repeated rows (same id, source and text) share their fate. A null id is an id, a null
    source the last source; a source without words has target 0. No rows give no rows.
    """
    rows = stage(docs.select(*_narrow(docs, id_col, text_col, source_col)), "sizes")
    decided = _with_odds(rows, decisions(rows, seed=seed, bins=bins, **rules), seed)
    decided = decided.withColumn("times", _times(decided))
    return decided.select("doc_id", "source", "key", "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix", bins: int = BINS, **rules) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as ``mix`` takes them, with the same columns.

    A row's fate follows from itself and its source's row in ``decisions``, so whole documents meet that small
    table only. Nulls, ties and repeated rows are treated as in ``mix``; no rows give no rows.
    """
    narrow = _narrow(docs, id_col, text_col, source_col)
    row = fresh(docs, "row")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row), *narrow)
    rows = stage(whole.drop(row), "sizes")
    decided = _with_odds(whole, decisions(rows, seed=seed, bins=bins, **rules), seed)
    taken = decided.withColumn("times", _times(decided)).filter("times > 0")
    again = taken.select(row, F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return again.select(*[F.col(row)[c].alias(c) for c in docs.columns])
