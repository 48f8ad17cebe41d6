"""Patterns in tickets and reviews: themes, error codes, quotes, ratings of results."""

from __future__ import annotations

import sys
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from supportlens.functions.expressions import percent, rounded, rows
from supportlens.functions.text import masked, tokens
from supportlens.operators.checks import union_all
from supportlens.operators.text_index import DIGITS, TextIndex, matching
from supportlens.session import spread

SENTENCE_END = r"[.!?\n]+"
# A ticket counts as a match of a text from this score on: about as much as one rare word out of ten in common.
MIN_SCORE = 0.1
#: Words whose pairs are added up at once, about, and reviews for each share of the pairs.
WORDS, REVIEWS = 1 << 21, 2000
MIXED = np.uint64(0x9E3779B97F4A7C15)

# Tasks get these functions with the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def each(df: DataFrame, elements: Column, name: str, *others: str) -> DataFrame:
    """One row per element of an array that is costly to compute.

    A plain explode would compute it a second time, in the filter Spark derives to
    drop empty arrays early.
    """
    return df.select(*others, F.explode_outer(elements).alias(name)).where(F.col(name).isNotNull())


def ticket_hits(tables, index: TextIndex, text: str, min_score: float = MIN_SCORE) -> DataFrame:
    """All tickets that match a text."""
    source = tables.support_tickets("ticket_id", "customer_id", "category", "priority", "status")
    return matching(index, text, min_score, source=source)


def hits_by_category(hits: DataFrame) -> DataFrame:
    """Search hits by category and priority, those to be flagged first."""
    flagged = (F.col("priority") == "Critical") | (F.col("status") == "Escalated")
    return (
        hits.groupBy("category", "priority")
        .agg(rows().alias("hits"), F.count_if(flagged).alias("flagged"), F.max("search_score").alias("best_score"))
        .orderBy(F.desc("flagged"), F.desc("hits"), "category", "priority")
    )


def systemic_customers(hits: DataFrame) -> DataFrame:
    """Customers behind more than one hit."""
    return (
        hits.groupBy("customer_id")
        .agg(rows().alias("hits"), F.min("ticket_id").alias("first_ticket"))
        .where(F.col("hits") > 1)
    )


def error_patterns(tables) -> DataFrame:
    """Error codes and quoted messages in ticket texts, with tickets and customers.

    A pattern counts once per ticket. Rows are reduced per pattern and customer first.
    """
    tickets = spread(tables.support_tickets("ticket_id", "customer_id", "description"))
    text = F.col("description")
    found = F.array_distinct(
        F.concat(F.regexp_extract_all(text, F.lit("([A-Z]+-[0-9]+)")), F.regexp_extract_all(text, F.lit('("[^"]+")')))
    )
    per_customer = (
        each(tickets, found, "pattern", "customer_id")
        .groupBy("pattern", "customer_id")
        .agg(rows().alias("n"))
    )
    return per_customer.groupBy("pattern").agg(F.sum("n").alias("tickets"), rows().alias("customers"))


def _pairs_in_shares(shares: int, schema: pa.Schema) -> Callable:
    """Rows (customer, words) of a review -> (share, data): record batches of two words that follow each other, a customer
    and their number of reviews, added up for some reviews at a time. The words decide the share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy().astype(np.int64)
            cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // WORDS, prepend=-1)).tolist()
            for first, stop in zip(cuts, [*cuts[1:], len(lengths)]):
                customers, words = batch.column(0)[first:stop].dictionary_encode("encode"), batch.column(1)[first:stop].flatten().dictionary_encode()
                codes, wide, by = words.indices.to_numpy().astype(np.int64), max(len(words.dictionary), 1), max(len(customers.dictionary), 1)
                review, n = np.repeat(np.arange(stop - first), lengths[first:stop]), stop - first
                follows = review[1:] == review[:-1]
                # Once per review.
                once = np.unique((codes[:-1] * wide + codes[1:])[follows] * n + review[1:][follows])
                found, times = np.unique(once // n * by + customers.indices.to_numpy()[once % n], return_counts=True)
                hashes = np.array([zlib.crc32(w.encode()) for w in words.dictionary.to_pylist()], np.uint64)
                left, right = found // by // wide, found // by % wide
                share = (((hashes[left] << np.uint64(32) | hashes[right]) * MIXED >> np.uint64(33)) % np.uint64(shares)).astype(np.int32)
                order = np.argsort(share, kind="stable")
                share, (left, right) = share[order], (words.dictionary.take(pa.array(c[order])) for c in (left, right))
                columns = [pc.binary_join_element_wise(left, right, " "), customers.dictionary.take(pa.array(found[order] % by)), pa.array(times[order])]
                rows, begins = pa.RecordBatch.from_arrays(columns, schema=schema), np.flatnonzero(np.diff(share, prepend=-1)).tolist()
                data = (rows.slice(a, z - a).serialize().to_pybytes() for a, z in zip(begins, [*begins[1:], len(share)]))
                yield pa.RecordBatch.from_arrays([pa.array(share[begins]), pa.array(data, pa.binary())], ["share", "data"])

    return run


def review_themes(tables, min_customers: int = 2, limit: int | None = None) -> DataFrame:
    """Word pairs that several customers mention; with a ``limit``, those of most customers."""
    asked = tables.product_reviews("customer_id", "review_text")
    reviews = spread(asked).select("customer_id", tokens(F.col("review_text")).alias("words"))
    schema = pa.schema([("theme", pa.string()), ("customer_id", to_arrow_type(reviews.schema["customer_id"].dataType)), ("n", pa.int64())])
    shares = -(-asked.select("customer_id").count() // REVIEWS) or 1

    def summed(table: pa.Table) -> pa.Table:
        parts = [pa.ipc.read_record_batch(data.as_buffer(), schema) for data in table.column("data")]
        per_customer = pa.Table.from_batches(parts).group_by(["theme", "customer_id"], use_threads=False).aggregate([("n", "sum")])
        found = per_customer.group_by("theme", use_threads=False).aggregate([("n_sum", "count"), ("n_sum", "sum")])
        return found.filter(pc.field("n_sum_count") >= min_customers).select(["theme", "n_sum_count", "n_sum_sum"]).rename_columns(["theme", "customers", "reviews"])

    # Pairs are many and most are rare, so little can be added up before the shuffle, and rows of their own would cost most.
    dealt = reviews.mapInArrow(_pairs_in_shares(shares, schema), "share int, data binary")
    themes = dealt.groupBy("share").applyInArrow(summed, "theme string, customers long, reviews long")
    if limit is None:
        return themes
    return themes.orderBy(F.desc("customers"), F.desc("reviews"), "theme").limit(limit)


def sentiment_by_product(tables) -> DataFrame:
    """Mean rating and shares of good and bad reviews per product."""
    return (
        tables.product_reviews("product_id", "product_name", "rating")
        .groupBy("product_id", "product_name")
        .agg(
            rows().alias("reviews"),
            rounded(F.avg("rating"), 2).alias("avg_rating"),
            percent(F.col("rating") >= 4).alias("positive_pct"),
            percent(F.col("rating") <= 2).alias("negative_pct"),
        )
    )


def verified_vs_all(tables) -> DataFrame:
    """Ratings of verified purchasers next to those of everybody."""
    verified = F.when(F.col("verified_purchase"), F.col("rating"))
    return (
        tables.product_reviews("product_id", "product_name", "rating", "verified_purchase", "helpful_votes")
        .groupBy("product_id", "product_name")
        .agg(
            rows().alias("reviews"),
            F.count(verified).alias("verified_reviews"),
            rounded(F.avg("rating"), 2).alias("avg_rating"),
            rounded(F.avg(verified), 2).alias("verified_avg_rating"),
            F.sum("helpful_votes").alias("helpful_votes"),
        )
    )


def key_quotes(tables, text: str, weights: dict[str, float] | None = None) -> DataFrame:
    """The sentence of each review that holds most of the words of ``text``; the earliest wins.

    With the ``weights`` of a search text (``text_index.query_weights``) it is the sentence whose words weigh most, and
    ``matches`` is their sum: what the sentence gives to the search. Works inside each row: nothing is shuffled.
    """
    words = sorted(weights) if weights is not None else sorted({w for w in text.lower().split() if w.isalpha()})
    weight_of = F.create_map(*[F.lit(x) for w in words for x in (w, (weights or {}).get(w, 1.0))])
    wanted = F.array(*[F.lit(w) for w in words])
    reviews = spread(tables.product_reviews("review_id", "product_name", "rating", "review_text"))

    def matches(sentence):
        # Splitting into words is left out where no word occurs even as part of another.
        some = F.lower(sentence).rlike("|".join(words))
        found = F.array_intersect(tokens(sentence), wanted)
        if weights is None:
            return F.when(some, F.size(found)).otherwise(0)
        total = F.aggregate(F.array_sort(found), F.lit(0.0), lambda acc, w: acc + F.element_at(weight_of, w))
        return F.when(some, F.round(total, DIGITS)).otherwise(0.0)

    ranked = F.transform(
        F.split(F.col("review_text"), SENTENCE_END),
        lambda s, i: F.struct(matches(s).alias("matches"), (-i).alias("place"), F.trim(s).alias("quote")),
    )
    best = F.filter(F.array(F.array_max(ranked)), lambda b: b["matches"] > 0)
    return each(reviews, best, "best", "review_id", "product_name", "rating").select(
        "review_id", "product_name", "rating", F.col("best.matches").alias("matches"), F.col("best.quote").alias("quote")
    )


def template_clusters(tables) -> DataFrame:
    """Ticket subjects that differ only in codes, quotes and numbers."""
    return (
        tables.support_tickets("customer_id", "subject")
        .groupBy(masked(F.col("subject")).alias("template"), "customer_id")
        .agg(rows().alias("n"))
        .groupBy("template")
        .agg(F.sum("n").alias("tickets"), rows().alias("customers"))
    )


def template_sentences(tables, min_customers: int = 2) -> DataFrame:
    """Sentences of ticket descriptions and reviews that several customers write, but for codes, quotes and numbers."""
    texts = union_all(
        [
            tables.support_tickets("ticket_id", "customer_id", "description").select(F.lit("ticket").alias("source"), F.col("ticket_id").alias("id"), "customer_id", F.col("description").alias("text")),
            tables.product_reviews("review_id", "customer_id", "review_text").select(F.lit("review").alias("source"), F.col("review_id").alias("id"), "customer_id", F.col("review_text").alias("text")),
        ]
    )
    sentences = F.transform(F.split("text", SENTENCE_END), lambda s: F.trim(masked(s)))
    return (
        each(spread(texts), F.filter(F.array_distinct(sentences), lambda s: s != ""), "template", "source", "customer_id")
        .groupBy("source", "template", "customer_id").agg(rows().alias("n"))
        .groupBy("source", "template").agg(F.sum("n").alias("texts"), rows().alias("customers"))
        .where(F.col("customers") >= min_customers)
    )


def tag_counts(tables) -> DataFrame:
    """Tickets per tag, and how many of them are Critical."""
    tagged = tables.support_tickets("tags", "priority")
    return (
        tagged.select("priority", F.explode(F.split("tags", ",")).alias("tag"))
        .groupBy("tag")
        .agg(rows().alias("tickets"), F.count_if(F.col("priority") == "Critical").alias("critical_tickets"))
    )


def label_summary(labels: DataFrame, documents: DataFrame) -> DataFrame:
    """Share of judged texts rated good and toxic, per language."""
    judged = labels.join(documents.select("doc_id", "lang"), "doc_id")
    return judged.groupBy("lang").agg(
        rows().alias("judged"), percent(F.col("quality") == 1, 2).alias("good_pct"), percent(F.col("toxic") == 1, 2).alias("toxic_pct")
    )


def recall_by_list(per_query: DataFrame, queries: DataFrame, key: str, list_id: str) -> DataFrame:
    """Share of the true neighbours found, per list of the query."""
    return (
        per_query.join(queries.select(F.col(key).alias("query_id"), list_id), "query_id")
        .groupBy(list_id)
        .agg(F.sum("expected").alias("expected"), F.sum("found").alias("found"))
        .withColumn("recall", rounded(F.col("found") / F.col("expected"), 4))
    )
