"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

Each source asks for its share of the total by weight. A source that asks for more than
``max_epochs`` times its own size is clamped there, and what it cannot give is shared out
again by weight among the others, until none asks for too much. A source is then taken
``floor(target / size)`` times whole, and once more in part: its documents in the order
of a seeded hash, until the rest of the target is met. The document at which it is met
gives a part of its words, so a source's words differ from its target by rounding only.

Sizes are words (``common.WORD``). NULL and empty texts have size 0 and are taken 0 words.
Repeated rows with one id share what falls on them in proportion. A NULL source is a
source of its own. Sources without words have target 0. An empty table gives an empty
result. Columns of the input that a result column would hide are read before and lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factlab.llm.common import WORD, stored

#: More sources than these are joined by shuffle, not sent to every executor.
BROADCAST_SOURCES = 100_000
#: Hexadecimal digits of the hash by which a source is searched for the place it ends at.
_DIGITS = 3


def words_in(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def seeded_order(id_column: str, seed: int) -> Column:
    """A hash of the id as text, in whose order documents are drawn."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))))


def water_fill(sources: DataFrame, total: Column, max_epochs: float) -> DataFrame:
    """``sources`` (source, weight, source_size) with their ``target``.

    One job of two sums for each round of clamping. A round clamps all sources that
    ask for too much, so there are few.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    goal, clamped = sources.agg(total).first()[0], F.lit(False)
    last = -1
    while True:
        row = sources.agg(
            F.sum(F.when(clamped, cap)).alias("given"),
            F.sum(F.when(~clamped, F.col("weight"))).alias("weight"),
            F.count(F.when(clamped, 1)).alias("n"),
        ).first()
        rest, weight = (goal or 0.0) - (row["given"] or 0.0), row["weight"]
        asked = F.col("weight") * F.lit(rest) / F.lit(weight) if weight else F.lit(0.0)
        if row["n"] == last or not weight:
            return sources.withColumn("target", F.when(clamped, cap).otherwise(asked))
        last = row["n"]
        clamped = clamped | (asked > cap)


def mix(
    docs: DataFrame,
    weights,
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 17,
    whole_documents: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """``docs`` with size, source_size, target, ``repeats`` and ``extra_words``.

    ``weights`` takes the table of sources (source, source_size) and adds ``weight``.
    ``repeats`` counts whole repetitions, ``extra_words`` the words of the one in part,
    so a document gives ``repeats * size + extra_words`` words. With ``whole_documents``
    the document at which a target is met is taken whole or not at all, whichever is
    nearer.
    """
    made = ["size", "draw", "source_size", "weight", "target", "repeats", "extra_words"]
    drawn = docs.drop(*[c for c in made if c not in (id_column, text_column, source_column)])
    drawn = drawn.withColumns({"size": words_in(text_column), "draw": seeded_order(id_column, seed)})
    sizes = stored(
        drawn.select(F.col(source_column).alias("source"), "size", "draw"), "mixing-sizes"
    )
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = stored(weights(sources), "mixing-sources")
    n = sources.count()
    goal = F.sum("source_size") * F.lit(share)
    filled = water_fill(sources, goal, max_epochs)
    filled = filled.withColumn(
        "epochs", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long")
    ).withColumn(
        "rest", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")
    )
    filled = _sized(stored(filled, "mixing-targets"), n)
    ends = _sized(stored(_ends(sizes, filled), "mixing-ends"), n)
    plan = filled.join(ends, F.col("source").eqNullSafe(F.col("end_source")), "left")
    plan = _sized(plan.withColumnRenamed("source", "plan_source").drop("end_source"), n)
    at_end = F.expr("rest_left * size div end_size")
    if whole_documents:
        at_end = F.when(F.col("rest_left") * 2 >= F.col("end_size"), F.col("size")).otherwise(0)
    extra = (
        F.when(F.col("end_draw").isNull(), 0)
        .when(F.col("draw") < F.col("end_draw"), F.col("size"))
        .when(F.col("draw") == F.col("end_draw"), at_end)
        .otherwise(0)
    )
    joined = drawn.join(plan, F.col(source_column).eqNullSafe(F.col("plan_source")))
    return joined.withColumns(
        {"repeats": F.col("epochs"), "extra_words": extra.cast("long")}
    ).select(*drawn.columns, "source_size", "target", "repeats", "extra_words")


def _sized(sources: DataFrame, n: int) -> DataFrame:
    return F.broadcast(sources) if n <= BROADCAST_SOURCES else sources


def _ends(sizes: DataFrame, filled: DataFrame) -> DataFrame:
    """Where in the drawn order each source meets its rest: hash, words left, words there.

    Sums by source and leading digits of the hash find the range first, so only one in
    ``16 ** _DIGITS`` documents of a source is ordered, a hot source included.
    """
    digits = F.substring("draw", 1, _DIGITS)
    ranges = sizes.where("size > 0").groupBy("source", digits.alias("range")).agg(
        F.sum("size").alias("n")
    )
    upto = Window.partitionBy("source").orderBy("range")
    ranges = ranges.withColumn("before", F.sum("n").over(upto) - F.col("n"))
    rests = filled.where("rest > 0").select(F.col("source").alias("of"), "rest")
    ranges = ranges.join(rests, F.col("source").eqNullSafe(F.col("of"))).where(
        "before < rest and rest <= before + n"
    )
    ranges = ranges.select("of", F.col("range").alias("end_range"), F.expr("rest - before as need"))
    near = sizes.where("size > 0").join(
        ranges, F.col("source").eqNullSafe(F.col("of")) & (digits == F.col("end_range"))
    )
    near = near.groupBy("of", "draw").agg(F.sum("size").alias("n"), F.first("need").alias("need"))
    order = Window.partitionBy("of").orderBy("draw")
    near = near.withColumn("before", F.sum("n").over(order) - F.col("n"))
    return near.where("before < need and need <= before + n").select(
        F.col("of").alias("end_source"),
        F.col("draw").alias("end_draw"),
        F.expr("need - before as rest_left"),
        F.col("n").alias("end_size"),
    )


def taken_words() -> Column:
    return F.col("repeats") * F.col("size") + F.col("extra_words")


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The documents the mix takes whole, a row for each repetition."""
    times = F.col("repeats") + F.when(
        (F.col("extra_words") > 0) & (F.col("extra_words") >= F.col("size")), 1
    ).otherwise(0)
    return (
        mixed.withColumn("times_", times.cast("int"))
        .where("times_ > 0")
        .withColumn("copy_", F.explode(F.sequence(F.lit(1), F.col("times_"))))
        .select(*columns)
    )
