"""Match each question to the table function whose description fits best."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supportlens.functions.text import counts_norm, log_tf, term_counts

DIGITS = 6
# The terms of the descriptions are broadcast.
MAX_TOOLS = 1000


def route_questions(questions: DataFrame, keys: list[str], text: str, descriptions: DataFrame) -> DataFrame:
    """``keys`` plus the best tool and its score; no tool where no weighted word matches.

    ``descriptions`` is the fixed list of tools, so each question term meets at most
    one row per tool.
    """
    spark = questions.sparkSession
    counted = descriptions.select("tool", term_counts(F.col("comment")).alias("counts"))
    counted = counted.select("tool", counts_norm(F.col("counts")).alias("norm"), "counts")
    n_tools = descriptions.count()
    if n_tools > MAX_TOOLS:
        raise ValueError(f"more than {MAX_TOOLS} descriptions")
    terms = (
        counted.select("tool", "norm", F.explode("counts").alias("c"))
        .groupBy(F.col("c.term").alias("term"))
        .agg(
            F.log(n_tools / F.count(F.lit(1))).alias("idf"),
            F.collect_list(F.struct("tool", (log_tf(F.col("c.tf")) / F.col("norm")).alias("weight"))).alias("tools"),
        )
        .where(F.col("idf") > 0)
    )
    # The empty name carries the squared length of the question, counted once per term.
    length_entry = F.struct(F.lit("").alias("tool"), F.col("_asked").alias("weight"))
    matched = (
        questions.select(*keys, F.explode_outer(term_counts(F.col(text))).alias("_c"))
        .select(*keys, F.col("_c.term").alias("term"), log_tf(F.col("_c.tf")).alias("_tf"))
        .join(F.broadcast(terms), "term")
        .select(*keys, (F.col("_tf") * F.col("idf")).alias("_asked"), "tools")
        .select(*keys, "_asked", F.explode(F.concat("tools", F.array(length_entry))).alias("_t"))
        .groupBy(*keys, F.col("_t.tool").alias("_tool"))
        .agg(F.sum(F.col("_asked") * F.col("_t.weight")).alias("_raw"))
    )
    is_tool = F.col("_tool") != ""
    # At most one entry per tool in the list.
    gathered = matched.groupBy(*keys).agg(
        F.sqrt(F.max(F.when(~is_tool, F.col("_raw")))).alias("_length"),
        F.collect_list(F.when(is_tool, F.struct("_tool", "_raw"))).alias("_found"),
    )
    ranked = F.transform(
        "_found",
        lambda e: F.struct((-F.round(e["_raw"] / F.col("_length"), DIGITS)).alias("negative"), e["_tool"].alias("tool")),
    )
    best = gathered.select(*keys, F.array_min(ranked).alias("_best"))
    return questions.select(*keys).join(best, keys, "left").select(
        *keys, F.col("_best.tool").alias("tool"), F.coalesce(-F.col("_best.negative"), F.lit(0.0)).alias("score")
    )
