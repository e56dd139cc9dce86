"""URL filter: host and path rules, then logistic regression on character n-grams.

A rule is a host with the beginning of a path.  It fits its host and all
subdomains; the longest rule that fits decides.  All other URLs are judged by a
logistic regression on hashed character n-grams of host and path, trained
from a small table of labelled URLs.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylater.llm import documents
from paylater.llm.labelled_urls import ROWS

# The rules of the registered query.
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
BUCKETS = 1 << 14
NGRAMS = (2, 3, 4)
TRAINING_URLS = 2000       # labelled URLs that the regression is fitted on, at most
STEPS, RATE, RIDGE = 300, 2.0, 1e-3

_SCHEME = re.compile(r"://")
_HOST_END, _PATH_END = re.compile(r"[/?#]"), re.compile(r"[?#]")
_LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}


def host_and_path(url: str | None) -> tuple[str, str]:
    """The host (ASCII lower case) and path of a URL; empty without ``://``."""
    start = _SCHEME.search(url) if url else None
    if start is None:
        return "", ""
    rest = url[start.end():]
    end = _HOST_END.search(rest)
    host, rest = (rest[:end.start()], rest[end.start():]) if end else (rest, "")
    end = _PATH_END.search(rest)
    return host.translate(_LOWER), rest[:end.start()] if end else rest


class Rules:
    """Rules by host, longest path first."""

    def __init__(self, rules: list[tuple[str, str]]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + path, rule, verdict))

    def longest(self, host: str, path: str) -> tuple[str | None, str | None]:
        labels = host.split(".")
        fits = [(len(rule), rule, verdict) for k in range(len(labels))
                for start, rule, verdict in self.by_host.get(".".join(labels[k:]), ())
                if path.startswith(start)]
        return max(fits)[1:] if fits else (None, None)


def ngram_buckets(host: str, path: str) -> np.ndarray:
    """Hashed character n-grams; those of host and path differ."""
    found = {zlib.crc32(f"{kind}{text[i:i + n]}".encode()) % BUCKETS
             for kind, text in (("h", f"^{host}$"), ("p", f"^{path}$"))
             for n in NGRAMS for i in range(len(text) - n + 1)}
    return np.array(sorted(found), np.int64)


def train(rows: list[tuple[str, str, int]]) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch gradient descent; label 1 is block.

    Feature values have unit length per URL.  Without rows of both labels the
    weights are zero and the bias tells the only label (allow, without rows).
    """
    labels = np.array([r[2] for r in rows], float)
    weights = np.zeros(BUCKETS)
    if not len(rows) or labels.min() == labels.max():
        return weights, 1.0 if len(rows) and labels[0] else -1.0
    grams = [ngram_buckets(h, p) for h, p, _ in rows]
    row = np.repeat(np.arange(len(rows)), [len(g) for g in grams])
    column = np.concatenate(grams)
    value = np.repeat([1 / np.sqrt(max(len(g), 1)) for g in grams], [len(g) for g in grams])
    # both labels weigh the same
    balance = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    bias = 0.0
    for _ in range(STEPS):
        z = np.bincount(row, value * weights[column], minlength=len(rows)) + bias
        error = balance * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels)
        weights -= RATE * (np.bincount(column, value * error[row], minlength=BUCKETS) / len(rows) * 10 + RIDGE * weights)
        bias -= RATE * error.mean()
    return weights, float(bias)


def probability(host: str, path: str, weights: np.ndarray, bias: float) -> float:
    grams = ngram_buckets(host, path)
    z = weights[grams].sum() / np.sqrt(max(len(grams), 1)) + bias
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


VERDICT = "page_id long, host string, path string, rule string, verdict string, block_probability double"


def _judge(rules: list[tuple[str, str]], model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Rules(rules)
        raw, bias = model.value if model is not None else (b"", 0.0)
        weights = np.frombuffer(raw, float)
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for url in batch.column("url").to_pylist():
                host, path = host_and_path(url)
                rule, verdict = table.longest(host, path)
                chance = None
                if rule is None and model is not None:
                    chance = probability(host, path, weights, bias)
                    verdict = "block" if chance >= 0.5 else "allow"
                for column, v in zip(out, (host, path, rule, verdict, chance)):
                    column.append(v)
            kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), *(pa.array(c, k) for c, k in zip(out, kinds))],
                ["page_id", "host", "path", "rule", "verdict", "block_probability"])
    return run


def filter_urls(pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str]] = RULES,
                id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, block_probability`` of every row.

    ``labelled``: ``url, blocked`` (0 or 1); of more than ``TRAINING_URLS`` the ones of
    the smallest hash are fitted on.  Null URLs and those without ``://`` have an empty host and
    path, no rule, and the regression's verdict.  Rows are kept one for one;
    the probability is null where a rule decides.
    """
    sample = (labelled.where("url is not null and blocked is not null").select("url", "blocked").distinct()
              .orderBy(F.xxhash64("url"), "url", "blocked").limit(TRAINING_URLS).collect())
    weights, bias = train([(*host_and_path(r.url), int(r.blocked)) for r in sample])
    model = pages.sparkSession.sparkContext.broadcast((weights.tobytes(), bias))
    return (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"))
            .mapInArrow(_judge(rules, model), VERDICT))


def labelled(spark: SparkSession) -> DataFrame:
    """``url, blocked``: the table labelled by hand."""
    return spark.createDataFrame(ROWS, "url string, blocked int")


def op8_url_filter(spark, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL; where no rule fits, by the regression on the URLs labelled by hand."""
    return filter_urls(documents.read(spark, sf_dir, "pages"), labelled(spark))
