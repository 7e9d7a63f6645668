"""Compression classifier: zstandard dictionaries of good and bad labelled text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of a window. A text is compressed in windows, so that a long one cannot learn
#: from itself what the dictionaries should tell.
WINDOW = 2048
LEVEL = 3
DICTIONARY_BYTES = 64 * 1024
#: Bounds of the sample that is fitted on: documents of each label whose windows train the
#: dictionaries, windows taken from one of them, and documents of each label for calibration.
DICTIONARY_DOCS, DOC_WINDOWS, CALIBRATION_DOCS = 1000, 8, 2000
#: Added to a text's length, so that a few bytes weigh little in a very short text.
SMOOTHING = 32


@dataclass(frozen=True)
class CompressionClassifier:
    """Two dictionaries and the calibration of the difference they make."""

    good: bytes
    bad: bytes
    raw_content: bool
    weights: tuple[float, ...]

    def score(self, text: Column) -> Column:
        """Probability of label 1 for a text (null: empty), from the whole text alone."""
        model = self

        @F.pandas_udf("double")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            sizes = model._sizer()
            for s in batches:
                yield pd.Series(model._probability(np.array([sizes(t) for t in s], dtype=float).reshape(-1, 4)))

        return scored(text)

    def sizes(self, text: Column) -> Column:
        """array(compressed with good, with bad, with neither, raw bytes) of a text."""
        model = self

        @F.pandas_udf("array<long>")
        def sized(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            sizes = model._sizer()
            for s in batches:
                yield pd.Series([sizes(t) for t in s])

        return sized(text)

    def _sizer(self):
        import zstandard as z

        kind = z.DICT_TYPE_RAWCONTENT if self.raw_content else z.DICT_TYPE_AUTO
        bare = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        coders = []
        for content in (self.good, self.bad):
            d = z.ZstdCompressionDict(content, dict_type=kind)
            d.precompute_compress(level=LEVEL)
            coders.append(z.ZstdCompressor(dict_data=d, **bare))
        coders.append(z.ZstdCompressor(**bare))

        def sizes(text: str | None) -> list[int]:
            raw = (text or "").encode("utf-8", "replace")
            total = [0, 0, 0]
            for at in range(0, max(1, len(raw)), WINDOW):
                w = raw[at:at + WINDOW]
                for i, c in enumerate(coders):
                    total[i] += len(c.compress(w))
            return [*total, len(raw)]

        return sizes

    def _probability(self, sizes: np.ndarray) -> np.ndarray:
        z = _features(sizes) @ np.array(self.weights)
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def _features(sizes: np.ndarray) -> np.ndarray:
    """1, the difference of the compressed sizes per byte, the log of the plain compressed size
    per byte: a text that repeats itself shrinks under any dictionary, and its difference
    with it, so the calibration has to know by how much it shrinks."""
    length = sizes[:, 3] + SMOOTHING
    return np.column_stack([np.ones(len(sizes)), (sizes[:, 1] - sizes[:, 0]) / length, np.log(sizes[:, 2] / length)])


def _fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps on standardised columns, slightly damped."""
    mean, dev = x.mean(0), x.std(0)
    mean[0], dev[0] = 0.0, 1.0
    dev[dev == 0] = 1.0
    s = (x - mean) / dev
    b = np.zeros(x.shape[1])
    damp = np.full(x.shape[1], 1e-3)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(s @ b, -500, 500)))
        grad = s.T @ (weight * (y - p)) - damp * b
        step = np.linalg.solve((s * (weight * p * (1 - p))[:, None]).T @ s + np.diag(damp), grad)
        b += step
        if np.abs(step).max() < 1e-9:
            break
    b = b / dev
    b[0] -= (b * mean)[1:].sum()
    return b


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality",
        dictionary_docs: int = DICTIONARY_DOCS, calibration_docs: int = CALIBRATION_DOCS) -> CompressionClassifier:
    """Train on a bounded sample of ``labels`` (doc_id, label 0 or 1).

    Of each label the documents with the smallest id hashes are taken: the first half, at most
    ``dictionary_docs``, train the dictionary with up to ``DOC_WINDOWS`` evenly spread windows
    each; the next, at most ``calibration_docs``, calibrate a logistic curve over the
    difference, weighted to the share of the labels among all labelled rows.  Ids with both
    labels, null ids and null labels are left out.  Without a document of either label every
    score is that of the label there is (1, 0; neither: 0.5).
    """
    spark = docs.sparkSession
    one = (labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y"))
           .filter("id IS NOT NULL AND y IN (0, 1)").groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("top"))
           .filter("y = top").select("id", "y"))
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).filter("text IS NOT NULL")
    there = one.join(texts.select("id").distinct(), "id", "left_semi")
    share = {r["y"]: r["n"] for r in there.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(share) < 2:
        constant = {(1,): 30.0, (0,): -30.0}.get(tuple(share), 0.0)
        return CompressionClassifier(b"-" * 8, b"-" * 8, True, (constant, 0.0, 0.0))
    chosen = []
    for y, n in sorted(share.items()):
        top = there.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(dictionary_docs + calibration_docs)
        ids = [r["id"] for r in top.collect()]
        cut = min(dictionary_docs, max(1, len(ids) // 2))
        chosen += [(i, y, at < cut) for at, i in enumerate(ids)]
    sample = spark.createDataFrame(chosen, f"id {dict(texts.dtypes)['id']}, y int, trains boolean")
    picked = texts.join(F.broadcast(sample), "id").dropDuplicates(["id"])  # at most 2 * (both bounds) rows

    @F.pandas_udf("array<binary>")
    def windows(s: pd.Series) -> pd.Series:
        def cut(t: str) -> list[bytes]:
            raw = t.encode("utf-8", "replace")
            starts = range(0, len(raw), WINDOW)
            spread = starts if len(starts) <= DOC_WINDOWS else [starts[i * len(starts) // DOC_WINDOWS] for i in range(DOC_WINDOWS)]
            return [raw[i:i + WINDOW] for i in spread]
        return s.map(cut)

    trained = picked.filter("trains").select("id", "y", windows("text").alias("w")).orderBy("id").collect()
    by_label = {y: [bytes(w) for r in trained if r["y"] == y for w in r["w"]] for y in (0, 1)}
    good, bad, raw_content = _dictionaries(by_label[1], by_label[0])
    model = CompressionClassifier(good, bad, raw_content, (0.0, 0.0, 0.0))
    held = picked.filter("NOT trains").select("id", "y", model.sizes(F.col("text")).alias("s")).orderBy("id").collect()
    if len({r["y"] for r in held}) < 2:  # too few documents for two samples: calibrate on the first
        held = picked.select("id", "y", model.sizes(F.col("text")).alias("s")).orderBy("id").collect()
    y = np.array([r["y"] for r in held], dtype=float)
    x = _features(np.array([r["s"] for r in held], dtype=float))
    total = sum(share.values())
    weight = np.where(y == 1, share[1] / total / y.mean(), share[0] / total / (1 - y.mean()))
    return CompressionClassifier(good, bad, raw_content, tuple(float(b) for b in _fit_logistic(x, y, weight)))


def _dictionaries(good: list[bytes], bad: list[bytes]) -> tuple[bytes, bytes, bool]:
    """Trained dictionaries; where there is too little text to train one, the last bytes of
    the text itself as raw content, for both."""
    import zstandard as z

    try:
        return (*(z.train_dictionary(DICTIONARY_BYTES, w).as_bytes() for w in (good, bad)), False)
    except z.ZstdError:
        return (*((b"".join(w)[-DICTIONARY_BYTES:]).rjust(8, b"-") for w in (good, bad)), True)


def held_out(doc_id: Column) -> Column:
    """The documents kept from training: CRC-32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def classify(docs: DataFrame, model: CompressionClassifier, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``__score`` and ``__predicted`` (1 if the score reaches ``threshold``)."""
    scored = docs.withColumn("__score", model.score(F.col(f"`{text}`")))
    return scored.withColumn("__predicted", (F.col("__score") >= threshold).cast("int"))
