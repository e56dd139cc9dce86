"""Toxicity from the nearest labelled examples.

1. **Vocabulary.**  Of a bounded sample of labelled documents, the features
   (words, and beginnings of 3 to 6 letters) whose presence differs most
   between the labels, by a two-proportion z-score.
2. **Vectors.**  One pass over all whole texts counts the documents that hold each feature.
   Vectors are TF-IDF of unit length; the pass that scores a text makes its vector.
3. **Index.**  The examples' postings by feature lie in blocks of examples, and the
   greatest weight of each feature in each block is kept.  A query bounds its
   cosine with every block from these, reads blocks by falling bound, and stops
   once no bound reaches its k-th best; the result is exact.
4. **Votes.**  The neighbours vote with weights that fall with distance.  Votes
   become probabilities by isotonic regression on the examples, each of
   which is scored without itself.

The index holds ``examples`` documents of at most ``features`` features
each, whatever the corpus holds, so it is broadcast.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylater.llm import documents
from paylater.llm.blocks import binary_views
from paylater.llm.tables import written

EXAMPLES = 8192          # labelled documents that the model is fitted on, at most
FEATURES = 4096
LEAST_DOCS = 8           # documents of the sample that hold a feature, at least
LEAST_Z = 6.0
NEIGHBOURS = 16
BLOCK = 64
CACHED_WORDS = 250_000
SUMS = 32                # tasks that add up document frequencies
THRESHOLD = 0.7
WORD = re.compile(r"\w+")


def features_of(word: str) -> list[str]:
    return [word, *("^" + word[:n] for n in (3, 4, 5, 6) if len(word) > n)]


class FeatureIds(dict):
    """Feature ids of words, looked up once."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word):
        known = tuple(self.vocabulary[f] for f in features_of(word) if f in self.vocabulary)
        if len(self) < CACHED_WORDS:
            self[word] = known
        return known


def count_features(text: str, ids: FeatureIds) -> dict[int, int]:
    out: dict[int, int] = {}
    for word, n in Counter(WORD.findall(text.lower())).items():
        for f in ids[word]:
            out[f] = out.get(f, 0) + n
    return out


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each feature of each labelled document."""
    for batch in batches:
        data, at = binary_views(batch.column("body"))
        raw = data.tobytes()
        for i, toxic in enumerate(batch.column("toxic").to_pylist()):
            words = set(WORD.findall(raw[at[i]:at[i + 1]].decode().lower()))
            found = sorted({f for w in words for f in features_of(w)})
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.string()), pa.array([toxic] * len(found), pa.int32())], ["feature", "toxic"])


def _features(column: pa.Array, ids: FeatureIds) -> list[list[tuple[int, int]]]:
    """Sorted features with counts of every text."""
    data, at = binary_views(column)
    raw = data.tobytes()
    return [sorted(count_features(raw[at[i]:at[i + 1]].decode(), ids).items()) for i in range(len(at) - 1)]


def _vectors(vocabulary):
    """Features and counts of the examples."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = FeatureIds(vocabulary.value)
        for batch in batches:
            pairs = _features(batch.column("body"), ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([[f for f, _ in p] for p in pairs], pa.list_(pa.int32())),
                 pa.array([[n for _, n in p] for p in pairs], pa.list_(pa.int32())), batch.column("toxic")],
                ["doc_id", "features", "counts", "toxic"])
    return run


def _seen(vocabulary):
    """One row for each task: the number of texts that hold a feature, and of texts at the end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = FeatureIds(vocabulary.value)
        seen = np.zeros(len(vocabulary.value) + 1, np.int64)
        for batch in batches:
            pairs = _features(batch.column("body"), ids)
            for p in pairs:
                seen[[f for f, _ in p]] += 1
            seen[-1] += len(pairs)
        yield pa.RecordBatch.from_arrays([pa.array([seen], pa.list_(pa.int64()))], ["seen"])
    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of a task's ``seen`` rows."""
    total = None
    for batch in batches:
        for row in batch.column("seen"):
            values = row.values.to_numpy()
            total = values.copy() if total is None else total + values
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64()))], ["seen"])


class BlockMaxIndex:
    """Unit vectors of the examples in feature postings with block maxima."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_features: int):
        self.n = len(vectors)
        self.blocks = -(-self.n // BLOCK)
        example = np.repeat(np.arange(self.n), [len(f) for f, _ in vectors]).astype(np.int64)
        feature = np.concatenate([f for f, _ in vectors] or [np.zeros(0)]).astype(np.int64)
        weight = np.concatenate([w for _, w in vectors] or [np.zeros(0)]).astype(float)
        order = np.lexsort((example, feature))
        self.example, self.weight = example[order], weight[order]
        cell = feature[order] * self.blocks + self.example // BLOCK
        self.at = np.searchsorted(cell, np.arange(n_features * self.blocks + 1))
        self.most = np.zeros(n_features * self.blocks)
        np.maximum.at(self.most, cell, self.weight)
        self.most = self.most.reshape(n_features, self.blocks)

    def _scores(self, features, weights, blocks) -> np.ndarray:
        cells = (features[:, None] * self.blocks + blocks[None, :]).ravel()
        size = self.at[cells + 1] - self.at[cells]
        ends = np.cumsum(size)
        if not len(ends) or not ends[-1]:
            return np.zeros(self.n)
        rows = np.repeat(self.at[cells] - (ends - size), size) + np.arange(ends[-1])
        factor = np.repeat(np.repeat(weights, len(blocks)), size)
        return np.bincount(self.example[rows], self.weight[rows] * factor, minlength=self.n)

    def nearest(self, features: np.ndarray, weights: np.ndarray, k: int, without: int = -1
                ) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of the highest positive cosine, ties to the first, and their cosines."""
        bound = weights @ self.most[features]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        score, low, step = np.zeros(self.n), 0, 2
        while low < len(order):
            part = order[low:low + step]
            score += self._scores(features, weights, part)
            if without >= 0:
                score[without] = 0
            low, step = low + step, step * 2
            kth = np.partition(score, -k)[-k] if self.n > k else 0.0
            # a block may hold a member as long as its bound reaches the k-th best (with float slack)
            order = order[:low + int(np.searchsorted(-bound[order[low:]], -(kth - 1e-9), side="right"))]
        best = np.lexsort((np.arange(self.n), -score))[:k]
        best = best[score[best] > 0]
        return best, score[best]


def _unit(features, counts, idf) -> tuple[np.ndarray, np.ndarray]:
    features = np.asarray(features, np.int64)
    weight = (1 + np.log(np.asarray(counts, float))) * idf[features] if len(features) else np.zeros(0)
    norm = np.sqrt((weight ** 2).sum())
    return features, weight / norm if norm else weight


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps of the non-decreasing least-squares fit, pooled from adjacent violators."""
    values, inverse = np.unique(x, return_inverse=True)
    blocks: list[list[float]] = []       # sum, weight, number of values
    for total, weight in zip(np.bincount(inverse, y), np.bincount(inverse)):
        blocks.append([total, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    fitted = np.repeat([b[0] / b[1] for b in blocks], [int(b[2]) for b in blocks])
    return values, fitted


class Model:
    """The index, its examples' labels, and the calibration."""

    def __init__(self, examples: list[tuple[int, list[int], list[int], int]], idf: np.ndarray):
        self.idf = idf
        self.ids = np.array([e[0] for e in examples], np.int64)
        self.toxic = np.array([e[3] for e in examples], float)
        vectors = [_unit(e[1], e[2], idf) for e in examples]
        self.index = BlockMaxIndex(vectors, len(idf))
        votes = [self.vote(*v, without=i)[0] for i, v in enumerate(vectors)]
        known = np.array([v is not None for v in votes], bool)
        rest = self.toxic[~known]
        # documents without a neighbour: their own rate, with one clean document added
        self.default = float(rest.sum() / (len(rest) + 1))
        if known.any():
            self.steps, self.fitted = isotonic(np.array([v for v in votes if v is not None]), self.toxic[known])
        else:
            self.steps, self.fitted = np.zeros(1), np.array([self.default])

    def vote(self, features, weights, without: int = -1):
        if not len(features) or not len(self.ids):
            return None, np.zeros(0, np.int64), np.zeros(0)
        who, cosine = self.index.nearest(features, weights, NEIGHBOURS, without)
        if not len(who):
            return None, who, cosine
        weight = 1 / (1.05 - np.minimum(cosine, 1))
        return float((weight * self.toxic[who]).sum() / weight.sum()), who, cosine

    def score(self, features, counts) -> tuple[float, np.ndarray, np.ndarray]:
        vote, who, cosine = self.vote(*_unit(features, counts, self.idf))
        if vote is None:
            return self.default, who, cosine
        return float(np.interp(vote, self.steps, self.fitted)), who, cosine


EVIDENCE = T.ArrayType(T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("cosine", T.DoubleType()),
                                     T.StructField("toxic", T.IntegerType())]))


def _scorer(vocabulary, model):
    """Rows with their scores; the text is the last field of ``doc``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, ids = pickle.loads(model.value), FeatureIds(vocabulary.value)
        for batch in batches:
            scores, evidence = [], []
            for pairs in _features(batch.column("doc").flatten()[-1], ids):
                score, who, cosine = m.score([f for f, _ in pairs], [n for _, n in pairs])
                scores.append(min(max(score, 0.0), 1.0))
                evidence.append([{"doc_id": int(m.ids[i]), "cosine": float(c), "toxic": int(m.toxic[i])}
                                 for i, c in zip(who[:3], cosine[:3])])
            kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(scores, pa.float64()), pa.array(evidence, kind)],
                ["doc", "score", "evidence"])
    return run


def _choose(presence: DataFrame, n: int, n_toxic: int, features: int) -> dict[str, int]:
    """Features by falling absolute z-score of their presence in toxic and clean examples."""
    clean = max(n - n_toxic, 1)
    rate = F.col("n") / n
    z = ((F.col("t") / max(n_toxic, 1) - (F.col("n") - F.col("t")) / clean)
         / F.sqrt(rate * (1 - rate) * (1 / max(n_toxic, 1) + 1 / clean) + 1e-12))
    rows = (presence.groupBy("feature").agg(F.count("*").alias("n"), F.sum("toxic").alias("t"))
            .where(F.col("n") >= LEAST_DOCS).withColumn("z", F.abs(z)).where(F.col("z") >= LEAST_Z)
            .orderBy(F.desc("z"), "feature").limit(features).collect())
    return {r.feature: i for i, r in enumerate(rows)}


def score_rows(docs: DataFrame, labelled: DataFrame, examples: int = EXAMPLES, features: int = FEATURES,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, score, evidence`` of every row: the row itself as a struct (its text as the last field), the
    probability of the label, and the three nearest examples.

    ``labelled``: ``doc_id, toxic`` of the rows to learn from; ids and labels must not be
    null to count, of a repeated id the greater label and the smallest text (by bytes) count.  Of more than
    ``examples``, those of the smallest id hash are taken.  Null and empty texts,
    and texts without a known feature, get the rate of such examples.  Without any
    example all scores are 0.  Rows are scored one for one by their own texts, rows without an id, too.
    Examples are scored like all rows, so a learned row is its own nearest neighbour; of equal cosines
    the smaller ids are neighbours.

    Texts are read in two passes, one for the document frequencies and one that scores; nothing of
    them is written, joined or shuffled, but for the examples.
    """
    spark = docs.sparkSession
    rows = documents.bodies(docs, id_col, text_col)
    sample = (labelled.where("doc_id is not null and toxic is not null").groupBy("doc_id")
              .agg(F.max("toxic").cast("int").alias("toxic"))
              .join(rows.select("doc_id").distinct(), "doc_id", "left_semi")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples))
    chosen = spark.createDataFrame(sample.toArrow()) if sample.count() else sample
    learned = written(rows.join(F.broadcast(chosen), "doc_id")            # ``examples`` rows at most
                      .groupBy("doc_id").agg(F.min("body").alias("body"), F.max("toxic").alias("toxic")),
                      "toxicity-examples")
    size = learned.agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).first()
    presence = learned.select("body", "toxic").mapInArrow(_presence, "feature string, toxic int")
    vocabulary = _choose(presence, size.n or 0, size.t or 0, features) if size.n else {}

    sent = spark.sparkContext.broadcast(vocabulary)
    every = docs.select(documents.text_bytes(text_col).alias("body"))
    sums = (every.mapInArrow(_seen(sent), "seen array<bigint>").repartition(SUMS)
            .mapInArrow(_added, "seen array<bigint>").collect())              # ``SUMS`` rows at most
    seen = np.sum([np.array(r.seen, np.int64) for r in sums] or [np.zeros(len(vocabulary) + 1, np.int64)], axis=0)
    idf = np.log(1.0 + seen[-1]) - np.log(np.maximum(seen[:-1], 1))
    vectors = (learned.mapInArrow(_vectors(sent), "doc_id long, features array<int>, counts array<int>, toxic int")
               .orderBy("doc_id").collect())
    model = Model([(r.doc_id, list(r.features), list(r.counts), r.toxic) for r in vectors], idf)
    order = [c for c in docs.columns if c != text_col] + [text_col]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in order]).alias("doc"))
    return packed.mapInArrow(_scorer(sent, spark.sparkContext.broadcast(cloudpickle.dumps(model))), T.StructType([
        packed.schema["doc"], T.StructField("score", T.DoubleType()), T.StructField("evidence", EVIDENCE)]))


def score_documents(docs: DataFrame, labelled: DataFrame, examples: int = EXAMPLES, features: int = FEATURES,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, evidence`` of every row with an id, as ``score_rows`` gives them."""
    return (score_rows(docs.where(F.col(id_col).isNotNull()).select(id_col, text_col), labelled, examples, features,
                       id_col, text_col)
            .select(F.col(f"doc.`{id_col}`").cast("bigint").alias("doc_id"), "score", "evidence"))


def training_rows(labels: DataFrame) -> DataFrame:
    """Labels that may be learned from: crc32 of the id's text mod 3 is not 1."""
    return labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1).select("doc_id", "toxic")


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document, from labels outside the held-out third."""
    docs, labels = (documents.read(spark, sf_dir, t) for t in ("documents", "labels"))
    out = score_documents(docs, training_rows(labels))
    return out.select("doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1).alias("held_out"),
                      "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence")
