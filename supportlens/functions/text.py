"""Row-local text expressions: tokens, term counts and term weights.

A document's weights depend on that document only (logarithmic term frequency,
cosine-normalised). Document frequencies enter on the query side, so adding or
changing a document never touches the stored weights of the others.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NON_LETTERS = r"[^\p{L}]+"

# Tasks get these functions with the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters."""
    return F.filter(F.split(F.lower(text), NON_LETTERS), lambda t: t != "")


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a variable."""
    return F.transform(F.array(value), body)[0]


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("tf", T.IntegerType())])))
def _counted(words: pa.Array) -> pa.Array:
    """Different words of each row in order, and how often each occurs; none for a missing row."""
    rows = len(words)
    lengths = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = words.flatten().dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    wide = max(len(order), 1)
    keys, times = np.unique(np.repeat(np.arange(rows), lengths) * wide + rank[coded.indices.to_numpy(zero_copy_only=False)], return_counts=True)
    terms = coded.dictionary.take(pa.array(order)).take(pa.array(keys % wide))
    entries = pa.StructArray.from_arrays([terms, pa.array(times.astype(np.int32))], ["term", "tf"])
    offsets = np.searchsorted(keys // wide, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), entries)


def term_counts(text: Column) -> Column:
    """``array<struct<term, tf>>`` of a text, terms in order, without a shuffle: counted per Arrow batch."""
    return _counted(tokens(text))


def log_tf(tf: Column) -> Column:
    return 1.0 + F.log(tf.cast("double"))


def counts_norm(counts: Column) -> Column:
    """Euclidean length of the log-tf vector."""
    return F.sqrt(F.aggregate(counts, F.lit(0.0), lambda acc, c: acc + log_tf(c["tf"]) * log_tf(c["tf"])))


def token_total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0), lambda acc, c: acc + c["tf"])


def masked(text: Column) -> Column:
    """Text with quoted strings, codes and numbers replaced by placeholders."""
    quoted = F.regexp_replace(text, r'"[^"]*"', "<quoted>")
    coded = F.regexp_replace(quoted, r"[A-Z]+-[0-9]+", "<code>")
    return F.regexp_replace(coded, r"[0-9]+", "<number>")
