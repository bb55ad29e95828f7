"""Quality rules of documents, and verdicts on their hosts.

Each text is measured in one pass. A document fails the base rules by its own
figures. Hosts are judged by how often their documents break the strict rules:
counts per host are shrunk towards the corpus by a beta prior fitted to all
hosts (method of moments), so a host with few documents keeps the benefit of the
doubt. On a host judged bad, documents must keep the strict rules too; a
document that breaks no rule stays wherever it comes from.

Defined cases: a null or empty text has no words and fails the base rules; rows
with a null host form one host; repeated rows are measured and counted one by
one; an empty table gives no rows. Columns of the input that bear the name of a
result are replaced by it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldspark.llm.shared import checkpoint, give_back, whole

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = re.compile(r"[#*$%&|<>]")
WINDOW = 5
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Words that lie in a window of words found twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    first: dict = {}
    repeated: set = set()
    for i, key in enumerate(zip(*(words[k:] for k in range(window)))):
        j = first.setdefault(key, i)
        if j != i:
            repeated.add(j)
            repeated.add(i)
    covered = end = 0
    for i in sorted(repeated):
        covered += i + window - max(i, end)
        end = i + window
    return covered


def measure(text: str) -> tuple[int, int, int, int, int]:
    """The base figures of one text, in the order of ``MEASURES``."""
    words = _WORD.findall(text)
    lines: set = set()
    doubled = 0
    for line in text.split("\n"):
        if line in lines:
            doubled += _WORD.search(line) is not None
        else:
            lines.add(line)
    return len(words), sum(map(len, words)), len(_SYMBOLS.findall(text)), doubled, repeated_words(words)


_FIGURES = T.StructType([T.StructField(name, T.LongType()) for name in MEASURES])


@F.pandas_udf(_FIGURES)
def _measured(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([measure(t) for t in batch], columns=MEASURES, dtype="int64")
    give_back()


def base_failed(min_words: int = 10, max_repeat: int = 20) -> Column:
    """Too few words, or more than ``max_repeat`` % of them in repeated windows."""
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))


def strict_failed(max_symbols: int = 5, max_dup_lines: int = 3) -> Column:
    """Base rules broken, or over ``max_symbols`` symbols per 100 characters of words, or over ``max_dup_lines`` doubled lines."""
    return (
        F.col("base_failed")
        | (100 * F.col("n_symbols") > max_symbols * F.col("word_chars"))
        | (F.col("n_dup_lines") > max_dup_lines)
    )


def judge_hosts(hosts: DataFrame, max_rate: float) -> tuple[DataFrame, int]:
    """Per host (host, n_docs, n_failed): the shrunk rate of failures, and bad_host (rate over ``max_rate``).

    The prior is a beta distribution with the mean of the corpus and the
    variance of the hosts' rates beyond what their sizes explain. With no such
    excess (or one host) every host gets the rate of the corpus. Also returns
    the number of hosts.
    """
    # one row of sums over hosts
    total = hosts.agg(
        F.count(F.lit(1)).alias("h"),
        F.sum("n_docs").alias("n"),
        F.sum("n_failed").alias("f"),
        F.sum(F.col("n_failed") * F.col("n_failed") / F.col("n_docs")).alias("ff"),
        F.sum(F.col("n_docs").cast("double") * F.col("n_docs")).alias("nn"),
    ).first()
    mean = total.f / total.n if total.n else 0.0
    strength = None
    if total.n and total.h > 1 and 0 < mean < 1:
        between = total.ff - total.n * mean * mean  # sum of n (rate - mean)^2
        spread = (between - (total.h - 1) * mean * (1 - mean)) / (total.n - total.nn / total.n)
        if spread > 0:
            strength = max(mean * (1 - mean) / spread - 1, 0.0)
    if strength is None:
        rate = F.lit(float(mean))
    else:
        rate = (F.col("n_failed") + F.lit(float(mean * strength))) / (F.col("n_docs") + F.lit(float(strength)))
    return hosts.withColumn("rate", rate).withColumn("bad_host", F.col("rate") > max_rate), total.h


#: Verdicts of up to so many hosts are broadcast (about 100 bytes each); more are joined by shuffles.
BROADCAST_HOSTS = 100_000


def host_rules(
    docs: DataFrame,
    text_col: str = "text",
    host_col: str = "source",
    columns: list[str] | None = None,
    write_once: bool = False,
    max_rate: float = 0.3,
) -> DataFrame:
    """Rows of ``docs`` with the base figures, base_failed, strict_failed, host_rate, bad_host and kept.

    ``columns`` (all by default) are the input's columns to keep. With
    ``write_once`` they and the figures are written once and read by both passes, which
    pays if the text is not among them; else the texts are measured in both.
    """
    results = [*MEASURES, "base_failed", "strict_failed", "host_rate", "bad_host", "kept"]
    own = [c for c in (columns or docs.columns) if c not in results]
    rows = docs.select(*own, F.col(host_col).alias("_host"), _measured(whole(text_col)).alias("_figures"))
    rows = rows.select(*own, "_host", "_figures.*")
    rows = rows.withColumn("base_failed", base_failed()).withColumn("strict_failed", strict_failed())
    if write_once:
        rows = checkpoint(rows)
    hosts = rows.groupBy(F.col("_host").alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("strict_failed").cast("long")).alias("n_failed")
    )
    hosts, number = judge_hosts(checkpoint(hosts), max_rate)
    verdicts = hosts.select("host", F.col("rate").alias("host_rate"), "bad_host")
    if number <= BROADCAST_HOSTS:
        verdicts = F.broadcast(verdicts)
    judged = rows.join(verdicts, F.col("_host").eqNullSafe(F.col("host"))).drop("_host", "host")
    return judged.withColumn("kept", ~F.col("base_failed") & ~(F.col("bad_host") & F.col("strict_failed")))
