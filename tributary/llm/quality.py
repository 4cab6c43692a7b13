"""Quality rules on whole texts and on hosts, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.session import materialize

BLANK = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, not once per element of an array beside it."""
    return F.transform(F.array(value), body)[0]


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more: the windows' positions, each adding what the next doesn't cover."""

    def repeated(laid: Column) -> Column:
        return F.transform(
            F.filter(
                laid,
                lambda x, i: (F.get(laid, i - 1)["h"] == x["h"]).eqNullSafe(True) | (F.get(laid, i + 1)["h"] == x["h"]).eqNullSafe(True),
            ),
            lambda x: x["at"],
        )

    def spread(at: Column) -> Column:
        steps = F.transform(at, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    laid = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    return _let(F.array_sort(_let(laid, repeated)), spread)


def _repeat_words(words: Column) -> Column:
    def found(w: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(1), F.size(w) - WINDOW + 1), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
        some = _let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(h)))
        return F.when(F.size(w) <= WINDOW, F.lit(0)).otherwise(some)

    return _let(words, found)


def text_measures(text: Column) -> dict[str, Column]:
    """Counts of one whole text; a null text counts as empty.

    n_words and word_chars: words ``[^\\x20\\x09-\\x0D]+`` and their code points. n_symbols: characters of ``#*$%&|<>``.
    n_dup_lines: lines with a word that equal an earlier line. n_repeat_words: words in 8-word windows found twice or more.
    """
    whole = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(whole, BLANK), lambda w: w != "")
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    measured = _let(words, lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("r")))
    return {
        "_words": measured,
        "word_chars": F.length(F.translate(whole, " \t\n\x0b\x0c\r", "")).cast("long"),
        "n_symbols": (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    }


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), one row per row of ``docs``."""
    found = text_measures(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), *[c.alias(k) for k, c in found.items()])
    return rows.select(
        "doc_id", "host", F.col("_words")["n"].cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        F.col("_words")["r"].cast("long").alias("n_repeat_words"),
    )


def rules() -> dict[str, Column]:
    """Rules on the measures of a document; each is true where the document fails it."""
    return {
        "short": F.col("n_words") < 20,
        "repeats": 100 * F.col("n_repeat_words") > 30 * F.col("n_words"),
        "symbols": 10 * F.col("n_symbols") > 8 * F.col("n_words"),
        "lines": 2 * F.col("n_dup_lines") > F.col("n_words"),
    }


BASE_RULES = ("short", "repeats")


def host_verdicts(marked: DataFrame, host: str, failed: str, max_rate: float) -> DataFrame:
    """(host, n_docs, n_failed, rate, host_ok): failure rates by host, shrunk towards all hosts.

    The prior is a beta distribution with the mean of all documents and the variance of the hosts' rates (method of moments);
    with fewer than two hosts or no variance it weighs as many documents as ``PRIOR_DOCS``. A null host is a host.
    """
    hosts = marked.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col(failed).cast("long")).alias("n_failed")
    )
    hosts = materialize(hosts, "hosts")
    rate = F.col("n_failed") / F.col("n_docs")
    top = hosts.agg(F.sum("n_failed").alias("f"), F.sum("n_docs").alias("n"), F.var_samp(rate).alias("v")).first()
    mean = (top["f"] or 0) / top["n"] if top["n"] else 0.0
    spread = top["v"] or 0.0
    weight = mean * (1 - mean) / spread - 1 if spread > 0 else PRIOR_DOCS
    weight = weight if weight > 0 else PRIOR_DOCS
    shrunk = (F.col("n_failed") + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))
    return hosts.withColumn("rate", shrunk).withColumn("host_ok", F.col("rate") < max_rate)


PRIOR_DOCS = 10.0
MAX_HOST_RATE = 0.5


def host_quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_rate: float = MAX_HOST_RATE
) -> DataFrame:
    """Measures and verdicts, one row per row of ``docs`` in any order: base_failed, host_rate, kept.

    A document is kept unless it fails a base rule itself or its host's shrunk rate of documents that fail any rule reaches
    ``max_rate``. Null and empty texts have no words and fail; a null host groups all rows without host; repeated rows
    and repeated ids are judged one by one; an empty table gives an empty result; columns beside the three named are ignored.
    """
    tests = rules()
    any_rule, base = F.lit(False), F.lit(False)
    for name, failed in tests.items():
        any_rule = any_rule | failed
        base = base | failed if name in BASE_RULES else base
    rows = measure(docs, id_col, text_col, host_col).withColumn("base_failed", base).withColumn("any_failed", any_rule)
    rows = materialize(rows, "measures")
    hosts = host_verdicts(rows, "host", "any_failed", max_rate).select(F.col("host").alias("_host"), "rate", "host_ok")
    joined = rows.join(hosts, rows["host"].eqNullSafe(hosts["_host"]), "left")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.col("rate").alias("host_rate"), (~F.col("base_failed") & F.col("host_ok")).alias("kept"),
    )
