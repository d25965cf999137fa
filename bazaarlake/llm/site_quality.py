"""Quality by hierarchical empirical Bayes: text evidence with host and path posteriors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import no_columns_missing, space_words, stage

# The classifier is fitted on at most this many labelled rows, those with the smallest hashes.
SAMPLE_ROWS = 20_000
FEATURES = ["log_words", "symbols", "same_next", "distinct", "capitals", "lines_again"]
ROUNDS, DECAY = 30, 1.0
THRESHOLD = 0.5
# Bounds of the prior strengths, in documents.
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1000.0
# The entities a page cannot do without.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}
_CAPITALS = bytes(range(0x41, 0x5B))
_SYMBOLS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) not in ".,!?'-")


def _statistics(text: str | None) -> list[float]:
    words = space_words(text)
    n = max(len(words), 1)
    joined = b"".join(words)
    lines = [line for line in (text or "").split("\n") if line.strip()]
    return [
        float(np.log1p(len(words))),
        (len(joined) - len(joined.translate(None, _SYMBOLS))) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        len(set(words)) / n,
        (len(joined) - len(joined.translate(None, _CAPITALS))) / max(len(joined), 1),
        (len(lines) - len(set(lines))) / max(len(lines), 1),
    ]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [_statistics(text.as_py()) for text in batch.column("text")]
        others = [n for n in batch.schema.names if n != "text"]
        columns = np.array(rows, float).reshape(-1, len(FEATURES))
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in others], *[pa.array(columns[:, i]) for i in range(len(FEATURES))]],
            [*others, *FEATURES],
        )


@dataclass(frozen=True)
class Evidence:
    """A logistic classifier of standardised statistics, and the share of good rows it saw."""

    means: tuple[float, ...]
    scales: tuple[float, ...]
    weights: tuple[float, ...]
    bias: float
    base: float

    def log_odds(self) -> Column:
        total = F.lit(self.bias)
        for name, mean, scale, weight in zip(FEATURES, self.means, self.scales, self.weights):
            total = total + (F.col(name) - mean) * (weight / scale)
        return total


def fit(rows: np.ndarray, good: np.ndarray) -> Evidence:
    """Newton steps of a ridge-penalised logistic regression."""
    if not len(good) or good.min() == good.max():
        base = 0.5 if not len(good) else float(np.clip(good.mean(), 0.01, 0.99))
        zeros = (0.0,) * len(FEATURES)
        return Evidence(zeros, (1.0,) * len(FEATURES), zeros, float(np.log(base / (1 - base))), base)
    means, scales = rows.mean(axis=0), np.maximum(rows.std(axis=0), 1e-6)
    x = np.column_stack([(rows - means) / scales, np.ones(len(rows))])
    penalty = np.diag([DECAY] * len(FEATURES) + [0.0])
    weights = np.zeros(x.shape[1])
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - good) + penalty @ weights
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + penalty
        weights -= np.linalg.solve(curve, gradient)
    return Evidence(
        tuple(means.tolist()), tuple(scales.tolist()), tuple(weights[:-1].tolist()), float(weights[-1]), float(good.mean())
    )


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(groups: DataFrame) -> float:
    """Prior strength from the spread of group shares around their mean (moments)."""
    row = groups.filter("n >= 2").agg(
        F.sum("n").alias("n"),
        F.sum("p").alias("p"),
        F.count("*").alias("groups"),
        F.sum(F.col("p") * F.col("p") / F.col("n")).alias("pp"),
        F.sum(F.col("n") * F.col("n")).alias("nn"),
    ).first()
    if not row["groups"] or row["groups"] < 2:
        return MOST_STRENGTH
    n, mean = float(row["n"]), row["p"] / row["n"]
    between = (row["pp"] - n * mean * mean - (row["groups"] - 1) * mean * (1 - mean)) / (n - row["nn"] / n)
    if between <= 0:
        return MOST_STRENGTH
    return float(np.clip(mean * (1 - mean) / between - 1, LEAST_STRENGTH, MOST_STRENGTH))


def measured(rows: DataFrame, key: str, host: Column, path: Column, text: Column) -> DataFrame:
    """Key, host, path and text statistics of every row, written once; null sites are sites too."""

    def site(name: Column) -> Column:
        return F.coalesce(F.concat(F.lit("s"), name.cast("string")), F.lit("n"))

    kind = rows.schema[key].dataType.simpleString()
    return stage(
        rows.select(key, site(host).alias("host"), site(path).alias("path"), text.alias("text")).mapInArrow(
            _features,
            f"{key} {kind}, host string, path string, " + ", ".join(f"{f} double" for f in FEATURES),
        ),
        "measured",
    )


def learn(rows: DataFrame, labels: DataFrame) -> Evidence:
    """Fits the classifier on a bounded sample of labelled rows outside the held-out part."""
    known = (
        no_columns_missing(labels, doc_id="long", quality="int")
        .filter("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("good"), F.max("quality").alias("_most"))
        .filter("good = _most")
        .drop("_most")
        .filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(SAMPLE_ROWS)
    )
    sample = rows.join(F.broadcast(known), "doc_id").dropDuplicates(["doc_id"]).orderBy("doc_id").toPandas()
    return fit(sample[FEATURES].to_numpy(float), sample["good"].to_numpy(float))


def posteriors(rows: DataFrame, model: Evidence, key: str) -> DataFrame:
    """Evidence of every row, shrunk shares of its host and path, and the score of all three."""
    judged = rows.select(
        key, "host", "path", F.least(F.greatest(model.log_odds(), F.lit(-30.0)), F.lit(30.0)).alias("evidence")
    ).withColumn("p", 1 / (1 + F.exp(-F.col("evidence"))))
    paths = stage(judged.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("p")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("p").alias("p"))
    total = hosts.agg(F.sum("n"), F.sum("p")).first()
    overall = float(np.clip(total[1] / total[0], 0.01, 0.99)) if total[0] else 0.5
    of_host, of_path = _strength(hosts), _strength(paths)
    sites = paths.withColumnsRenamed({"n": "path_n", "p": "path_p"}).join(
        hosts.withColumnsRenamed({"n": "host_n", "p": "host_p"}), "host"
    )
    own = judged.join(sites, ["host", "path"])
    host_share = (F.col("host_p") - F.col("p") + of_host * overall) / (F.col("host_n") - 1 + of_host)
    path_share = (F.col("path_p") - F.col("p") + of_path * F.col("host_posterior")) / (F.col("path_n") - 1 + of_path)
    bounded = lambda share: F.least(F.greatest(share, F.lit(0.01)), F.lit(0.99))
    base = float(np.log(overall / (1 - overall)))
    joined = F.col("evidence") - base + _logit(F.col("path_posterior"))
    return (
        own.withColumn("host_posterior", bounded(host_share))
        .withColumn("path_posterior", bounded(path_share))
        .withColumn("score", 1 / (1 + F.exp(-joined)))
        .withColumn("kept", F.col("score") >= THRESHOLD)
    )


_JUDGED = ["evidence", "host_posterior", "path_posterior", "score", "kept"]


def site_quality(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """Per row: ``doc_id``, ``evidence``, ``host_posterior``, ``path_posterior``, ``score``, ``kept``.

    A logistic classifier of six text statistics, fitted on a bounded sample of labelled rows
    outside the held-out part, gives every row its log-odds. Their probabilities are summed per
    host and per path in grouped aggregates. A host's share is shrunk towards the global share
    and a path's towards its host's, by strengths estimated from the spread of the groups, so a
    site of a few rows says little. A row's own probability is left out of its site's. The score
    joins the text evidence (log-odds over the base rate) with the log-odds of the path.

    Null hosts and paths are groups of their own. Null and empty texts have zero statistics.
    Repeated rows are judged alike. Without usable labels all evidence is 0 and all rows are kept.
    """
    rows = measured(docs, "doc_id", F.col(host), F.col(path), F.col("text"))
    return posteriors(rows, learn(rows, labels), "doc_id").select("doc_id", *_JUDGED)


def page_text(html: Column) -> Column:
    """What a page shows: scripts, styles and tags go, tags that end a block end a line."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    lines = F.regexp_replace(bare, r"(?i)</?(p|div|li|tr|h[1-6]|br|ul|ol|table)\b[^>]*>", "\n")
    text = F.regexp_replace(lines, r"<[^>]*>", " ")
    for name, mark in ENTITIES.items():
        text = F.replace(text, F.lit(name), F.lit(mark))
    return text


def page_quality(pages: DataFrame, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per page: ``page_id``, ``site`` and ``section``, and what ``site_quality`` gives a document.

    The classifier is the one learned from the labelled documents; hosts and paths are those of
    the page's address: its host in lower case, and the first part of its path. Pages without a
    readable address form a site of their own, as do addresses without a path within their host.
    """
    address = F.col("url").cast("string")
    host = F.lower(F.try_parse_url(address, F.lit("HOST")))
    path = F.nullif(F.regexp_extract(F.try_parse_url(address, F.lit("PATH")), "^/([^/]+)", 1), F.lit(""))
    model = learn(measured(docs, "doc_id", F.lit(None), F.lit(None), F.col("text")), labels)
    rows = measured(pages, "page_id", host, path, page_text(F.col("html")))
    judged = posteriors(rows, model, "page_id")
    named = {"site": "host", "section": "path"}
    return judged.select(
        "page_id", *[F.when(F.col(c) != "n", F.substring(c, 2, 1 << 20)).alias(n) for n, c in named.items()], *_JUDGED
    )
