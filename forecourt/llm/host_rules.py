"""Quality rules whose failures are judged per host.

Rules look at one text. The share of a host's texts that fail is shrunk towards the rate of all
hosts with a beta prior estimated from the hosts themselves, so that a host with two texts isn't
judged by two texts. A host whose shrunk rate is too high loses its remaining documents as well.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import fresh
from forecourt.llm.tokens import WHITE, pieces

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_BLANK = WHITE.decode()
_SYMBOLS = "#*$%&|<>"  # fixed values


def repeated_words(words: list, window: int = 3) -> int:
    """Number of words inside a run of ``window`` words that occurs at least twice."""
    runs = list(zip(*[words[k:] for k in range(window)], strict=False))
    counts = Counter(runs)
    if len(counts) == len(runs):
        return 0
    covered = upto = 0
    for at, run in enumerate(runs):
        if counts[run] > 1:
            covered += at + window - max(at, upto)
            upto = at + window
    return covered


def measures(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()  # splits at the six ASCII blanks, as the contract says
    lines = Counter(line for line in text.split("\n") if line.strip(_BLANK))
    return (
        len(words),
        len(text) - sum(text.count(c) for c in _BLANK),
        sum(text.count(c) for c in _SYMBOLS),
        sum(lines.values()) - len(lines),
        repeated_words(words),
    )


def with_measures(df: DataFrame) -> DataFrame:
    """Add the five measures of ``text``. A null or empty text measures 0 everywhere."""
    df = df.drop(*MEASURES)
    schema = f"{df._jdf.schema().toDDL()}, " + ", ".join(f"{m} bigint" for m in MEASURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = [measures(t) for t in batch.column("text").to_pylist()]
            added = [pa.array([f[k] for f in found], pa.int64()) for k in range(len(MEASURES))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *MEASURES])

    return df.mapInArrow(run, schema)


def beta_prior(hosts: DataFrame, rows: str, failed: str) -> tuple[float, float]:
    """Parameters of the beta distribution that the hosts' rates come from, by moments.

    The spread of the observed rates less what chance alone gives them; if nothing is left, hosts
    don't differ and the prior outweighs any of them. One row reaches the driver.
    """
    rate = F.col(failed) / F.col(rows)
    m, spread, inverse = hosts.agg(F.avg(rate), F.var_pop(rate), F.avg(1 / F.col(rows))).first()
    if m is None or m in (0.0, 1.0):
        return 1.0, 1.0
    noise = m * (1 - m) * inverse
    true = max(spread - noise, m * (1 - m) * 1e-9)
    weight = max(m * (1 - m) / true - 1, 1e-3)
    return m * weight, (1 - m) * weight


def host_verdicts(df: DataFrame, host: str, rules: dict[str, Column], most: float = 0.5) -> DataFrame:
    """One row per host: rows, failures by rule, shrunk failure rate, and whether the rate exceeds ``most``.

    A failure of any rule is one failure. Null hosts form one host. Hosts are counted with a partial
    aggregate before the shuffle, so a host with a third of all rows is one row per task.
    """
    anything = F.greatest(*[r.cast("long") for r in rules.values()]) if len(rules) > 1 else next(iter(rules.values()))
    hosts = df.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("rows"),
        F.sum(anything.cast("long")).alias("failed"),
        *[F.sum(r.cast("long")).alias(name) for name, r in rules.items()],
    )
    a, b = beta_prior(hosts, "rows", "failed")
    rate = (F.col("failed") + a) / (F.col("rows") + a + b)
    return hosts.withColumn("rate", rate).withColumn("rejected", rate > most)


def judged(df: DataFrame, host: str, rules: dict[str, Column], most: float = 0.5) -> DataFrame:
    """Join the verdict on its host back to every document: adds ``failed``, ``host_rate`` and ``kept``.

    Documents are kept if they fail no rule and their host isn't rejected. Columns of these names are
    replaced. Rows of a hot host are split by the join, whose other side has one row per host.
    """
    df = df.drop("failed", "host_rate", "kept")
    name, rejected = fresh(df, "host", "rejected")
    verdicts = host_verdicts(df, host, rules, most).select(
        F.col("host").alias(name), F.col("rate").alias("host_rate"), F.col("rejected").alias(rejected)
    )
    failed = F.lit(False)
    for rule in rules.values():
        failed = failed | rule
    joined = df.join(verdicts, df[host].eqNullSafe(verdicts[name]), "left").withColumn("failed", failed)
    return joined.withColumn("kept", ~F.col("failed") & ~F.col(rejected)).drop(name, rejected)
