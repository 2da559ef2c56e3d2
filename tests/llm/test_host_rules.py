from __future__ import annotations

import re

import pytest
from hypothesis import given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forecourt.llm import host_rules
from tests.llm.cases import nasty


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    inside = {k + d for k, r in enumerate(runs) if runs.count(r) > 1 for d in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    repeated = sum(line in lines[:k] for k, line in enumerate(lines))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(inside))


@hypothesis_settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from(list("ab \n\x0b\x85é#|")), max_size=60))
def test_measures(text):
    assert host_rules.measures(text) == brute(text)


def test_hosts_are_judged_by_shrunk_rates(spark):
    """A bad host loses its good documents; a small one isn't judged by two bad texts alone."""
    rows = [("bad", k < 95) for k in range(100)] + [("good", k < 5) for k in range(100)] + [("tiny", True), (None, False)]
    rows += [(f"h{k}", j == 0) for k in range(20) for j in range(20)]
    df = spark.createDataFrame([(i, h, f) for i, (h, f) in enumerate(rows)], "doc_id int, host string, broken boolean")
    df = df.withColumn("failed", F.lit("mine"))
    out = host_rules.judged(df, "host", {"broken": F.col("broken")}).collect()
    assert len(out) == len(rows)
    kept = {h: [r for r in out if r.host == h and r.kept] for h in ("bad", "good", "tiny", None)}
    assert len(kept["bad"]) == 0 and len(kept["good"]) == 95 and len(kept[None]) == 1
    tiny = next(r for r in out if r.host == "tiny")
    assert tiny.failed and tiny.host_rate < 0.6
    hosts = host_rules.host_verdicts(df.drop("failed"), "host", {"broken": F.col("broken"), "other": F.col("doc_id") < 0})
    found = {r.host: r for r in hosts.collect()}
    assert (found["bad"].rows, found["bad"].failed, found["bad"].broken, found["bad"].other) == (100, 95, 95, 0)


def test_prior_when_hosts_agree(spark):
    hosts = spark.createDataFrame([("a", 10, 1), ("b", 20, 2)], "host string, rows int, failed int")
    a, b = host_rules.beta_prior(hosts, "rows", "failed")
    assert a / (a + b) == pytest.approx(0.1) and a + b > 1e6
    assert host_rules.beta_prior(hosts.limit(0), "rows", "failed") == (1.0, 1.0)
    assert host_rules.beta_prior(hosts.withColumn("failed", F.lit(0)), "rows", "failed") == (1.0, 1.0)


def test_odd_rows(spark):
    df = nasty(spark)
    measured = host_rules.with_measures(df)
    for r in measured.collect():
        assert tuple(r[m] for m in host_rules.MEASURES) == (brute(r.text or "") if len(r.text or "") < 10_000 else host_rules.measures(r.text))
        assert r.hash == 7
    judged = host_rules.judged(measured, "source", {"short": F.col("n_words") < 50})
    assert judged.count() == df.count()
    assert host_rules.judged(measured.limit(0), "source", {"short": F.col("n_words") < 50}).collect() == []
