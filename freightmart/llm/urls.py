"""URL filter: fixed rules first, and for the rest gradient-boosted trees over lexical features, learnt from the ruled URLs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import pick
from .trees import Boosted, fit

#: (verdict, rule): a rule is a host and a path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Ruled URLs that the trees are fitted on, at most; which ones is decided by a hash of the URL.
SAMPLE_ROWS = 20_000
#: A URL without a rule is blocked from this probability on.
BLOCK_FROM = 0.5
#: Weight of the overall share in a suffix's share of blocked URLs, in URLs.
PRIOR = 20.0
#: Suffixes are counted in so many hash buckets.
SUFFIX_BUCKETS = 4096


def host_of(url: Column) -> Column:
    """From behind the first :// up to / ? # or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest fitting rule, ties by text, or null."""
    found = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def features(url: pd.Series, host: pd.Series, path: pd.Series, suffix_share: pd.Series) -> np.ndarray:
    """Lexical figures: lengths, depths, digits, entropy, parameters, marks and the suffix's share of blocked URLs."""
    url = url.fillna("")
    query = url.str.partition("?")[2].str.partition("#")[0]
    size = np.maximum(url.str.len().to_numpy(float), 1)

    def entropy(text: str) -> float:
        if not text:
            return 0.0
        counts = np.unique(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), return_counts=True)[1]
        share = counts / counts.sum()
        return float(-(share * np.log2(share)).sum())

    return np.stack([
        size, host.str.len(), path.str.len(), query.str.len(), path.str.count("/"), host.str.count(r"\."),
        url.str.count("[0-9]") / size, host.str.count("[0-9]"), host.str.count("-"), path.str.count("-"),
        np.where(query == "", 0, query.str.count("&") + 1), url.str.count("%"), url.str.contains("#", regex=False),
        path.str.endswith("/"), path.str.contains(r"\.[A-Za-z0-9]+$"), url.str.startswith("https"), host.str.startswith("www."),
        host.map(entropy), url.map(entropy), host.str.rpartition(".")[2].str.len(), suffix_share,
    ], axis=1).astype(float)


def url_filter(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Verdict on every page: page_id, host, path, rule, verdict, score (probability of block by the method).

    URLs that a rule decides are the labelled ones; each distinct one counts once. Null URLs and URLs without :// have
    an empty host and path and no rule, and get the method's verdict. Without labelled URLs of both kinds all others
    are allowed unless every labelled one is blocked. Repeated pages are judged row by row, an empty table gives no
    rows, other columns are not looked at.
    """
    url = F.col("url")
    rows = pick(pages, page_id="page_id bigint", url="url string").select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(F.regexp_extract("host", r"[^.]*$", 0)), F.lit(SUFFIX_BUCKETS)).cast("int"))
    blocked = [rule for verdict, rule in rules if verdict == "block"]
    blocks = F.col("rule").isin(*blocked).cast("double")
    known = rows.where("rule is not null").groupBy("url", "host", "path", "bucket", "rule").agg(F.lit(1).alias("one")).withColumn("label", blocks)
    # statistics of suffixes over all labelled URLs, in a fixed number of hash buckets
    overall = known.agg(F.avg("label").alias("p"), F.count("*").alias("n")).first()
    share = overall["p"] if overall["n"] else 0.0
    by_suffix = known.groupBy("bucket").agg(F.sum("label").alias("b"), F.count("*").alias("n")).collect()
    shares = {r["bucket"]: (r["b"] + PRIOR * share) / (r["n"] + PRIOR) for r in by_suffix}
    sample = known.orderBy(F.xxhash64("url"), "url").limit(sample_rows).toPandas()
    model: Boosted = fit(features(sample["url"], sample["host"], sample["path"], sample["bucket"].map(shares).fillna(share)),
                         sample["label"].to_numpy(float), trees=40) if len(sample) else fit(np.zeros((0, 1)), np.zeros(0))
    kinds = sample["label"].nunique() if len(sample) else 0

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if kinds == 2 and len(batch):
                batch["score"] = model.score(features(batch["url"], batch["host"], batch["path"], batch["bucket"].map(shares).fillna(share)))
            else:
                batch["score"] = float(share)
            yield batch[["page_id", "host", "path", "rule", "score"]]

    method = rows.mapInPandas(scored, "page_id bigint, host string, path string, rule string, score double")
    allowed = [rule for verdict, rule in rules if verdict == "allow"]
    verdict = (F.when(F.col("rule").isin(*blocked), "block").when(F.col("rule").isin(*allowed), "allow")
               .when(F.col("score") > BLOCK_FROM, "block").otherwise("allow"))
    return method.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
