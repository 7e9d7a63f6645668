"""Batch scoring with a supplied model.

The model is a plain Python callable on a pandas frame of features in
contract order; ``mapInPandas`` builds it once per partition and scores
Arrow batches.  Probabilities are asked for only when required."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def score(df: DataFrame, keep: Sequence[str], features: Sequence[str], make_model: Callable[[], object],
          mode: str, pipeline_id: str, classes: Sequence[str] = (), want_probabilities: bool = False,
          latency: bool = False) -> DataFrame:
    """One prediction per row.  ``make_model()`` returns an object with
    ``predict(X) -> array`` and optionally ``predict_proba(X) -> matrix``.
    C9: exactly one finite scalar (regression) or text (classification) per row
    and one probability per class.  A row that breaks this, or a batch for which
    the model raises or returns another shape, has no prediction and carries
    ``error_type`` and ``error_message`` for ``fail_tasks`` (H5); the job goes on.

    I2: with ``latency`` each output also carries ``latency_ms``, its equal share of the time that the
    model took for its batch, failed batches included; ``latency_histogram`` and
    ``observed_latency`` sum it up."""
    keep, features = list(keep), list(features)
    in_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    pred_type = "string" if mode == "classification" else "double"
    schema = ", ".join(f"{c} {in_types[c]}" for c in keep) + f", mode string, pipeline_id string, prediction {pred_type}" \
        + ", probabilities array<struct<label:string,probability:double>>, feature_order array<string>, used_probability_api boolean, error_type string, error_message string" \
        + (", latency_ms double" if latency else "")

    def predictions(model, x: np.ndarray) -> tuple[list, list, list]:
        """Per row: prediction, probabilities, what is wrong."""
        n = len(x)
        pred = np.asarray(model.predict(x))
        if pred.shape != (n,):
            raise ValueError("model must return one scalar result per row")
        if mode == "regression":
            values = [float(v) for v in pred]
            wrong = [None if np.isfinite(v) else "model returned a non-finite prediction" for v in values]
        else:
            values = [v.item() if isinstance(v, np.generic) else v for v in pred]
            wrong = [None if isinstance(v, str) else "model returned a class that is not text" for v in values]
        probs: list = [None] * n
        if want_probabilities:
            pm = np.asarray(model.predict_proba(x), dtype="float64")
            if pm.shape != (n, len(classes)):
                raise ValueError("model must return one probability per class and row")
            probs = [[{"label": c, "probability": float(p)} for c, p in zip(classes, row)] for row in pm]
        return [None if w else v for v, w in zip(values, wrong)], [None if w else p for p, w in zip(probs, wrong)], wrong

    def run(batches):
        model = make_model()
        for pdf in batches:
            out = pdf[keep].copy()
            out["mode"] = mode
            out["pipeline_id"] = pipeline_id
            kind = ["ValueError"] * len(pdf)
            began = time.perf_counter()
            try:
                values, probs, wrong = predictions(model, pdf[features].to_numpy())
            except Exception as exc:  # whatever a supplied model raises concerns the rows of its batch
                values, probs, wrong = [None] * len(pdf), [None] * len(pdf), [str(exc) or "model failed"] * len(pdf)
                kind = [type(exc).__name__] * len(pdf)
            took = 1000 * (time.perf_counter() - began) / max(len(pdf), 1)
            out["prediction"] = pd.Series(values, index=out.index, dtype="float64" if mode == "regression" else "object")
            out["probabilities"] = probs
            out["feature_order"] = [features] * len(pdf)
            out["used_probability_api"] = bool(want_probabilities)
            out["error_type"] = [k if w else None for k, w in zip(kind, wrong)]
            out["error_message"] = wrong
            if latency:
                out["latency_ms"] = took
            yield out

    return df.select(*keep, *[c for c in features if c not in keep]).mapInPandas(run, schema)


def latency_histogram(scored: DataFrame, dims: Sequence[str] = ("pipeline_id",)) -> DataFrame:
    """(dims, up_to_ms, n, total_ms, max_ms) by powers of two of a millisecond.  Partial sums
    per task; histograms of several runs add up."""
    up_to = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.col("latency_ms"), F.lit(2.0**-20)))))
    return scored.groupBy(*dims, up_to.alias("up_to_ms")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("latency_ms").alias("total_ms"), F.max("latency_ms").alias("max_ms"))


def observed_latency(scored: DataFrame, name: str = "latency") -> tuple[DataFrame, Observation]:
    """The frame to write and the metrics that are there once it was written: outputs, their
    total and longest time, and those that failed.  Costs no job of its own."""
    seen = Observation(name)
    return scored.observe(seen, F.count(F.lit(1)).alias("n"), F.sum("latency_ms").alias("total_ms"), F.max("latency_ms").alias("max_ms"),
                          F.count("error_type").alias("failed")), seen


class LinearRule:
    """A deterministic model for tests and examples: w . x + b."""

    def __init__(self, weights: Sequence[float], bias: float = 0.0):
        self.w = np.asarray(weights, dtype="float64")
        self.b = float(bias)

    def predict(self, x):
        return x.astype("float64") @ self.w + self.b


def hashing_embedder(dim: int, seed: int = 0) -> Callable[[pd.Series], pd.Series]:
    """A deterministic text -> unit vector function (feature hashing of
    character trigrams), usable inside a pandas UDF."""
    import xxhash

    def embed(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            v = np.zeros(dim, dtype="float64")
            s = t or ""
            for i in range(max(1, len(s) - 2)):
                h = xxhash.xxh64_intdigest(s[i:i + 3], seed)
                v[h % dim] += 1.0 if (h >> 63) == 0 else -1.0
            n = np.linalg.norm(v)
            out.append((v / n if n else v).astype("float32").tolist())
        return pd.Series(out)

    return embed
