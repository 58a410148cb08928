"""Document quality by voting of the nearest labelled documents in a latent space.

Features of a whole text are counts of byte-class trigrams (how letters, digits,
marks and blanks follow each other) and of hashed letter trigrams, and the share
of words that repeat the word before. They are weighted by inverse document frequency and projected by the leading singular
vectors of a bounded sample of labelled documents (latent semantic analysis).
The sample's vectors, a matrix of known size, go to every task; a document's
cosines to all of them are exact products in blocks, and the labels of the most
similar vote with their similarity.
"""

from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from heddle.llm.batches import text_batches
from heddle.sources import table

#: Labelled documents that the model is fitted on, at most.
FIT_ROWS = 4000
DIMENSIONS = 64
NEIGHBOURS = 15
#: Votes are weighted by the cosine to this power.
SHARPNESS = 4
CLASSES = 12
LETTER_BUCKETS = 1024
#: Shares of words that repeat the word before; a text's bucket is one feature.
REPEATS = (0.02, 0.05, 0.1, 0.2, 0.4, 0.7)
REPEAT_WEIGHT = 12.0
FEATURES = CLASSES**3 + LETTER_BUCKETS + len(REPEATS) + 1


def _byte_classes() -> np.ndarray:
    """The class of each byte: 0 lower case, 1 upper case, 2 digit, 3 blank, 4 line end, then kinds of marks, 11 beyond ASCII."""
    classes = np.full(256, 10, dtype=np.int32)
    groups = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\r\n", ".,;:", "!?", "\"'`()[]{}<>", "|", "#$%&*@~^+=")
    for number, letters in enumerate(groups):
        classes[[ord(c) for c in letters]] = number
    classes[128:] = 11
    return classes


_CLASS = _byte_classes()
_FOLDED = np.arange(256, dtype=np.int32)
_FOLDED[65:91] += 32


def features(data: bytes, block: int = 1 << 20) -> np.ndarray:
    """Logs of 1 + n for a UTF-8 text's class trigrams and hashed letter trigrams, and its bucket of repeats."""
    counts = np.zeros(FEATURES)
    for at in range(0, max(len(data) - 2, 0), block):
        some = np.frombuffer(data, dtype=np.uint8, count=min(block + 2, len(data) - at), offset=at)
        kind = _CLASS[some]
        counts[: CLASSES**3] += np.bincount((kind[:-2] * CLASSES + kind[1:-1]) * CLASSES + kind[2:], minlength=CLASSES**3)
        letter = _FOLDED[some]
        hashed = (letter[:-2] * 7919 + letter[1:-1] * 104_729 + letter[2:] * 1_299_709) % LETTER_BUCKETS
        counts[CLASSES**3 : CLASSES**3 + LETTER_BUCKETS] += np.bincount(hashed, minlength=LETTER_BUCKETS)
    counts = np.log1p(counts)
    if len(words := data.split()) > 1:
        share = sum(map(eq, words, words[1:])) / (len(words) - 1)
        counts[CLASSES**3 + LETTER_BUCKETS + bisect(REPEATS, share)] = REPEAT_WEIGHT
    return counts


@dataclass
class Voters:
    """The fitted model: feature weights times projection, labelled unit vectors, labels and their mean."""

    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def embed(self, rows: np.ndarray) -> np.ndarray:
        latent = rows @ self.projection
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        """The share of label 1 among the neighbours' votes, from 0 to 1; the labels' mean without features or labels."""
        rows = np.array([features(t or b"") for t in texts], dtype=np.float32).reshape(len(texts), FEATURES)
        if not len(self.labels):
            return np.full(len(texts), self.prior)
        cosines = self.embed(rows) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        votes = np.maximum(np.take_along_axis(cosines, near, 1).astype(np.float64), 1e-6) ** SHARPNESS
        score = (votes * self.labels[near]).sum(axis=1) / votes.sum(axis=1)
        return np.where(rows.any(axis=1), np.clip(score, 0, 1), self.prior)


def leading_axes(rows: np.ndarray, k: int, rounds: int = 6, seed: int = 5) -> np.ndarray:
    """The leading right singular vectors of ``rows``, by subspace iteration from a fixed random start."""
    k = min(k, *rows.shape)
    axes = np.random.default_rng(seed).standard_normal((rows.shape[1], min(k + 16, *rows.shape))).astype(rows.dtype)
    for _ in range(rounds):
        axes, _ = np.linalg.qr(rows.T @ (rows @ axes))
    _, _, turn = np.linalg.svd(rows @ axes, full_matrices=False)
    return axes @ turn[:k].T


def fit(rows: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS) -> Voters:
    """A model of labelled texts, given their ``features`` as rows; without any, every score is one half."""
    if not len(rows):
        return Voters(np.zeros((FEATURES, 1), dtype=np.float32), np.zeros((0, 1), dtype=np.float32), labels, 0.5)
    rows = np.asarray(rows, dtype=np.float32)
    idf = np.log((1 + len(rows)) / (1 + (rows > 0).sum(axis=0))) + 0.1
    weighted = rows * idf
    weighted /= np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)
    projection = (idf[:, None] * leading_axes(weighted, dimensions)).astype(np.float32)
    model = Voters(projection, np.zeros((0, 1)), labels.astype(np.float64), float(labels.mean()))
    model.vectors = model.embed(rows).astype(np.float32)
    return model


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``rows`` labelled documents that aren't held out.

    The documents are the least by a hash of the id; of rows that repeat an id the
    one whose features come first counts. The ids, of bounded number, are broadcast
    to the scan of texts, and the driver gets features, whose size doesn't depend
    on the texts'.
    """
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    picked = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)

    @F.pandas_udf("binary")
    def counted(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: _sparse(features(t)))

    texts = docs.select(F.col(id_col).alias("picked"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    mine = texts.join(F.broadcast(picked.select(F.col("doc_id").alias("picked"), "quality")), "picked")
    found = mine.select("picked", "quality", counted("text").alias("features")).groupBy("picked", "quality").agg(F.min("features").alias("features"))
    found = sorted(found.collect(), key=lambda r: r["picked"])
    return np.array([_dense(r["features"]) for r in found], dtype=np.float32).reshape(len(found), FEATURES), np.array([r["quality"] for r in found], dtype=np.int64)


def _sparse(row: np.ndarray) -> bytes:
    """The places of a row that aren't zero, then their values."""
    at = np.flatnonzero(row)
    return at.astype("<u4").tobytes() + row[at].astype("<f4").tobytes()


def _dense(data: bytes) -> np.ndarray:
    half, row = len(data) // 2, np.zeros(FEATURES, dtype=np.float32)
    row[np.frombuffer(data[:half], dtype="<u4")] = np.frombuffer(data[half:], dtype="<f4")
    return row


def quality_score(spark: SparkSession, model: Voters, text: Column) -> Column:
    """The score of a text column; see ``score_quality``."""
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            parts = [sent.value.score(list(texts.iloc[at : at + 250])) for at in range(0, len(texts), 250)]
            yield pd.Series(np.concatenate(parts) if parts else [], dtype="float64")

    return score(F.coalesce(text, F.lit("")).cast("binary"))


def score_quality(docs: DataFrame, model: Voters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` for every row of ``docs``.

    The score looks at the text alone. Null texts are empty, and empty texts and
    those under three bytes score the labels' mean. Null ids stay null, repeated
    rows are scored each, other columns are not read, an empty table gives no
    rows.
    """
    return docs.select(F.col(id_col).alias("doc_id"), quality_score(docs.sparkSession, model, F.col(text_col)).alias("score"))


def keep_scored(docs: DataFrame, model: Voters, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is at least ``least``, with all their columns."""
    return docs.where(quality_score(docs.sparkSession, model, docs[text_col]) >= least)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from labels outside the held-out third."""
    text_batches(spark)
    docs = table(spark, sf_dir, "documents")
    model = fit(*labelled_sample(docs, table(spark, sf_dir, "labels")))
    scored = score_quality(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op5_quality": op5_quality}
ORACLE_SQL: dict[str, str] = {}
