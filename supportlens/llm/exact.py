"""Exact duplicates by deterministic block naming, in DataFrame functions alone.

A text is cut into blocks of fixed length. All different blocks are sorted and numbered; a block's number is
its name. Then the names of adjacent blocks are paired, all different pairs are sorted and numbered, and so on
until every text has one name. Two texts have the same depth and name exactly if they are identical.

Blocks are sorted by their 64-bit hash, and by their characters only where different blocks share a hash, so
that naming moves eight bytes a block. Which hashes are shared is found out by comparing characters: the
smallest and the largest block of each hash, combined on the map side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supportlens.llm.rows import AT, FILE, ROW, identified
from supportlens.session import written

#: Characters that don't count when texts are compared: space and U+0009 to U+000D.
BLANKS = " \n\t\r\x0b\x0c"
BLOCK = 4096


def stripped(text: Column) -> Column:
    """The text without blanks; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        out = F.replace(out, F.lit(blank), F.lit(""))
    return out


def _blocks(text: Column, size: int) -> Column:
    """Pieces of ``size`` characters, the last one shorter; one empty piece for an empty text."""
    return F.when(text == "", F.array(F.lit(""))).otherwise(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    )


def _named(keys: DataFrame, name: str) -> DataFrame:
    """A number for each different row of ``keys``, in the order of the rows."""
    ordered = keys.distinct().orderBy(*keys.columns)
    return written(ordered.withColumn("name", F.monotonically_increasing_id()), name)


def exact_identities(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs`` (an ``identified`` table): its identity, key, length in characters,
    SHA-256 of the stripped text, and (``depth``, ``name``), which equal those of another row exactly if
    the stripped texts are identical. Other columns of ``docs`` are neither read nor returned.
    """
    base = docs.select(
        *ROW, F.col(key).alias("key"), F.length(F.coalesce(text, F.lit(""))).cast("long").alias("chars"),
        stripped(F.col(text)).alias("text"),
    )
    cut = base.select(F.explode(_blocks(F.col("text"), block)).alias("block")).select(
        F.xxhash64("block").alias("hash"), "block"
    )
    clashes = written(
        cut.groupBy("hash").agg(F.min("block").alias("low"), F.max("block").alias("high"))
        .filter("low <> high").select("hash", F.lit(True).alias("clash")),
        "block-clashes",
    )
    pieces = (
        base.withColumn("sha", F.sha2("text", 256)).withColumn("blocks", _blocks(F.col("text"), block)).drop("text")
        .withColumn("n", F.size("blocks").cast("long"))
        .select(*ROW, "key", "chars", "sha", "n", F.posexplode("blocks").alias("pos", "block"))
        .withColumn("hash", F.xxhash64("block"))
    )
    first = F.col("pos") == 0
    level = written(
        pieces.join(clashes, "hash", "left").select(
            *ROW, F.col("pos").cast("long").alias("pos"), "n", "hash",
            F.when(F.col("clash"), F.col("block")).otherwise("").alias("tie"),
            F.when(first, F.col("key")).alias("key"), F.when(first, F.col("chars")).alias("chars"),
            F.when(first, F.col("sha")).alias("sha"),
        ),
        "block-level",
    )
    current = written(
        level.join(_named(level.select("hash", "tie"), "block-names"), ["hash", "tie"]).select(*ROW, "pos", "n", "name"),
        "named-0",
    )
    most, depth, finished = level.agg(F.max("n")).first()[0] or 1, 0, []
    while True:
        finished.append(current.filter("n = 1").select(*ROW, F.lit(depth).alias("depth"), "name"))
        if most == 1:
            break
        most, depth = (most + 1) // 2, depth + 1
        even = F.col("pos") % 2 == 0
        pairs = written(
            current.filter("n > 1").groupBy(*ROW, F.shiftright("pos", 1).alias("pos")).agg(
                F.shiftright(F.max("n") + 1, 1).alias("n"),
                F.max(F.when(even, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("right"),
            ),
            f"pairs-{depth}",
        )
        names = _named(pairs.select("left", "right"), f"pair-names-{depth}")
        current = written(pairs.join(names, ["left", "right"]).select(*ROW, "pos", "n", "name"), f"named-{depth}")
    identity = finished[0]
    for more in finished[1:]:
        identity = identity.unionByName(more)
    about = level.filter("pos = 0").select(*ROW, "key", "chars", "sha")
    return written(about.join(identity, list(ROW)), "identities")


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """Groups of rows whose texts are identical once blanks are deleted.

    Of a group, the row with the longest original text stays, of those the one with the smallest key (null
    keys last), of those the one stored first. Returns one row per row of ``docs``: its identity, key,
    ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``. Null texts count as empty, and empty texts are
    one group. Repeated rows are members of their group like any other; one of them stays. An empty table
    gives an empty result. Columns other than ``key`` and ``text`` are ignored, whatever their names.
    """
    who = exact_identities(identified(docs), key, text, block)
    best = F.min(F.struct((-F.col("chars")).alias("chars"), F.col("key").isNull().alias("none"), F.col("key"), *ROW))
    groups = written(who.groupBy("depth", "name").agg(F.count("*").alias("group_size"), best.alias("best")), "groups")
    kept = (F.col("best")[FILE] == F.col(FILE)) & (F.col("best")[AT] == F.col(AT))
    return who.join(groups, ["depth", "name"]).select(
        *ROW, F.col("key").alias(key), F.col("best.key").alias("keep_id"), "group_size", kept.alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
