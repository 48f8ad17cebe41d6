"""Templates of short texts, learned from the texts: a tree over word positions whose varied positions are slots.

Texts with equally many words start at one node. At each position a node looks at the different words its texts hold
there: up to ``variety`` words each lead to a node of their own; more of them make the position a slot, and all texts
go on together. Words are counted before the shuffle, so a template that holds a third of all texts is no hot spot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supportlens.session import written

#: Marks a slot, and the rest of a text that goes beyond the positions looked at.
SLOT = "<*>"
VARIETY = 8
DEPTH = 16


def positions(text: Column, depth: int = DEPTH) -> Column:
    """Words of a text between blanks: the first ``depth``, and one slot for the rest of a longer one."""
    words = F.filter(F.split(text, " "), lambda w: w != "")
    return F.when(F.size(words) > depth, F.concat(F.slice(words, 1, depth), F.array(F.lit(SLOT)))).otherwise(words)


def learn_templates(df: DataFrame, text: str, variety: int = VARIETY, depth: int = DEPTH) -> DataFrame:
    """``(text, n, template)`` for each different text that isn't null; ``n`` is how many rows hold it.

    One round per position, at most ``depth + 1``; each writes the different texts with the way they took.
    """
    nowhere = F.array().cast("array<string>")
    counted = df.where(F.col(f"`{text}`").isNotNull()).groupBy(F.col(f"`{text}`").alias("text")).agg(F.count(F.lit(1)).alias("n"))
    state = written(counted.select("text", "n", positions(F.col("text"), depth).alias("words"), nowhere.alias("path")), "templates")
    longest = state.agg(F.max(F.size("words")).alias("n")).first()["n"] or 0
    for place in range(longest):
        word = F.get("words", F.lit(place))
        node = [F.size("words").alias("length"), F.col("path")]
        inside = state.where(F.size("words") > place)
        varied = (
            inside.select(*node, word.alias("word")).distinct()
            .groupBy("length", "path").agg(F.count(F.lit(1)).alias("values"))
            .where(F.col("values") > variety).select("length", "path", F.lit(True).alias("slot"))
        )
        step = F.when(F.col("slot"), F.lit(SLOT)).otherwise(word)
        met = state.withColumn("length", F.size("words")).join(varied, ["length", "path"], "left")
        path = F.when(F.col("length") > place, F.concat("path", F.array(step))).otherwise(F.col("path"))
        state = written(met.select("text", "n", "words", path.alias("path")), "templates")
    return state.select("text", "n", F.array_join("path", " ").alias("template"))


def slot_values(learned: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``(template, position, value, n)``: what stands in the slots of each template, positions counted from 1 on."""
    pairs = F.arrays_zip(F.split("template", " ").alias("mark"), positions(F.col("text"), depth).alias("value"))
    placed = learned.select("template", "n", F.posexplode(pairs).alias("i", "pair"))
    return (
        placed.where(F.col("pair.mark") == SLOT)
        .groupBy("template", (F.col("i") + 1).alias("position"), F.col("pair.value").alias("value")).agg(F.sum("n").alias("n"))
    )
