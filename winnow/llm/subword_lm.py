"""Language-model scores by a subword lattice: the probability of a text over all segmentations."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shuffled, written

#: Rounds that fit the pieces' weights to the training words.
ROUNDS = 2
#: A token with at least this share of all training tokens is looked up where its text is: at most so many.
FREQUENT = 200_000
#: Distinct words that a worker counts before it passes them on; bytes of words whose lattices are laid out together.
KEEP_WORDS, BATCH_BYTES = 1 << 18, 1 << 17
_MARK = "▁".encode()


@dataclass(frozen=True)
class Vocabulary:
    """Pieces that begin a word (without the sign that says so) and pieces that go on, with their
    logarithmic weights; each of the two sums to one, the second together with ``stop``, a word's end."""

    begin: tuple[bytes, ...]
    go_on: tuple[bytes, ...]
    weights: np.ndarray  # of begin, then go_on, then the end


def read_vocabulary(path: str) -> Vocabulary:
    """The pieces of a SentencePiece model that lower-cased text can hold.

    The file's scores are places in an order (0, -1, -2, ...) and weigh as that: one over the place.
    Bytes that are no piece have their fallback pieces, last in the order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    begin: dict[bytes, float] = {b"": 1.0 / n}
    go_on: dict[bytes, float] = {bytes((b,)): 1.0 / n for b in range(256) if not 65 <= b <= 90}
    for i in range(n):
        piece = model.id_to_piece(i).encode()
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or piece != piece.lower() or _MARK in piece[1:]:
            continue
        weight = 1.0 / (2.0 - min(model.get_score(i), 0.0))
        if piece.startswith(_MARK):
            begin[piece[len(_MARK):]] = weight
        else:
            go_on[piece] = weight
    return Vocabulary(tuple(begin), tuple(go_on), _normalised(np.array([*begin.values()]), np.array([*go_on.values(), sum(go_on.values()) / 2])))


def _normalised(begin: np.ndarray, go_on: np.ndarray) -> np.ndarray:
    return np.log(np.concatenate([begin / begin.sum(), go_on / go_on.sum()]))


def _log_sums(terms: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Logarithm of the sum of exponentials of each run of ``terms``."""
    top = np.maximum.reduceat(terms, starts)
    lengths = np.diff(np.append(starts, len(terms)))
    return top + np.log(np.add.reduceat(np.exp(terms - np.repeat(top, lengths)), starts))


class Lattice:
    """Segmentations of words: a trie of all pieces finds, from every byte of a word, the pieces that begin there."""

    def __init__(self, begin: tuple[bytes, ...], go_on: tuple[bytes, ...]):
        children: list[dict[int, int]] = [{}, {}]  # roots of the pieces that go on and of those that begin
        at = [-1, -1]
        for number, (root, piece) in enumerate([*((1, p) for p in begin), *((0, p) for p in go_on)]):
            node = root
            for b in piece:
                node = children[node].setdefault(b, len(children))
                if node == len(children):
                    children.append({})
                    at.append(-1)
            at[node] = number
        self.next = np.zeros((len(children), 256), dtype=np.int32)
        for node, own in enumerate(children):
            for b, to in own.items():
                self.next[node, b] = to
        self.piece, self.stop, self.bare = np.array(at, dtype=np.int32), len(begin) + len(go_on), at[1]

    def edges(self, words: list[bytes]) -> tuple[np.ndarray, ...]:
        """(word, from, to, piece) of every piece in every word; ``from`` is -1 for pieces that begin it."""
        text = np.frombuffer(b"".join(words), dtype=np.uint8)
        size = np.array([len(w) for w in words])
        end = np.cumsum(size)
        word = np.repeat(np.arange(len(words)), size)
        found = []
        for root, place in ((0, np.arange(len(text))), (1, end - size)):
            node, here = np.full(len(place), root, dtype=np.int32), place
            origin, length = place, 0
            while len(here):
                node = self.next[node, text[here]]
                length += 1
                going = node > 0
                node, here, origin = node[going], here[going] + 1, origin[going]
                hit = self.piece[node] >= 0
                start = origin[hit]
                first = end[word[start]] - size[word[start]]
                found.append((word[start], start - first if root == 0 else np.full(len(start), -1), start - first + length, self.piece[node[hit]]))
                inside = here < end[word[origin]]
                node, here, origin = node[inside], here[inside], origin[inside]
        return tuple(np.concatenate(c) for c in zip(*found))

    def batches(self, words: list[bytes]) -> Iterator[np.ndarray]:
        """Places of words of like length, of a bounded number of bytes together or of one longer word."""
        order = np.argsort([len(w) for w in words], kind="stable")
        held, start = 0, 0
        for i, n in enumerate(order):
            if i > start and held + len(words[n]) > BATCH_BYTES:
                yield order[start:i]
                held, start = 0, i
            held += len(words[n])
        if len(order):
            yield order[start:]

    def forward(self, words: list[bytes], weights: np.ndarray):
        """ln of each word's probability, summed over all segmentations, and the lattice behind it.

        The value of a place is the sum over the pieces that end there of the value where
        they begin, all in logarithms; words advance together, one place at a time."""
        size = np.array([len(w) for w in words])
        base = np.concatenate(([0], np.cumsum(size + 1)))
        word, start, to, piece = self.edges(words)
        order = np.lexsort((word, to))
        word, start, to, piece = word[order], start[order], to[order], piece[order]
        source, target = np.where(start < 0, base[-1], base[word] + np.maximum(start, 0)), base[word] + to
        alpha = np.full(base[-1] + 1, -np.inf)
        alpha[base[-1]] = 0.0
        alpha[base[:-1]] = weights[self.bare]
        cuts = np.searchsorted(to, np.arange(1, size.max(initial=0) + 2))
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a < b:
                own = target[a:b]
                runs = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
                alpha[own[runs]] = _log_sums(alpha[source[a:b]] + weights[piece[a:b]], runs)
        total = alpha[base[1:] - 1] + weights[self.stop]
        return total, (alpha, base, size, word, start, source, target, piece)

    def log_probability(self, words: list[bytes], weights: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words))
        for own in self.batches(words):
            out[own] = self.forward([words[i] for i in own], weights)[0]
        return out

    def expected(self, words: list[bytes], weights: np.ndarray) -> np.ndarray:
        """How often each piece is expected in the words' segmentations, and the end."""
        counts = np.zeros(len(weights))
        for own in self.batches(words):
            total, (alpha, base, size, word, start, source, target, piece) = self.forward([words[i] for i in own], weights)
            beta = np.full(base[-1] + 1, -np.inf)
            beta[base[1:] - 1] = weights[self.stop]
            order = np.lexsort((word, -start))
            key, back = source[order], target[order]
            at, weight = start[order], weights[piece[order]]
            cuts = np.searchsorted(-at, np.arange(1 - size.max(initial=0), 2))
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a < b:
                    runs = np.flatnonzero(np.append(True, key[a:b][1:] != key[a:b][:-1]))
                    beta[key[a:b][runs]] = _log_sums(weight[a:b] + beta[back[a:b]], runs)
            counts += np.bincount(piece, np.exp(alpha[source] + weights[piece] + beta[target] - total[word]), minlength=len(weights))
            counts[self.bare] += np.exp(weights[self.bare] + beta[base[:-1]] - total).sum()
            counts[self.stop] += len(total)
        return counts


_LATTICES: dict[int, Lattice] = {}


def _lattice(v: Vocabulary) -> Lattice:
    """One trie per worker and vocabulary."""
    key = hash((v.begin, v.go_on))
    if key not in _LATTICES:
        _LATTICES.clear()
        _LATTICES[key] = Lattice(v.begin, v.go_on)
    return _LATTICES[key]


def held_out(doc_id: Column) -> Column:
    """Documents that are not learned from; those without an id are none of them either way."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 10 == 0, F.lit(True))


def _tokens(text: bytes | None) -> list[bytes]:
    """Lower-cased words between ASCII white space."""
    return (text or b"").lower().split()


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, c): every distinct token of all rows and its number in those with ``learn``; the end of
    a text is the empty word."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter({b"": 0})
        send = lambda: pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], names=["word", "n"])
        for batch in batches:
            for t, learn in zip(batch.column(0), batch.column(1).to_pylist()):
                words = _tokens(t.as_py())
                if learn:
                    held.update(words)
                    held[b""] += 1
                else:
                    for w in words:
                        held.setdefault(w, 0)
                if len(held) > KEEP_WORDS:
                    yield send()
                    held.clear()
        yield send()

    parts = docs.select(F.col(text).cast("binary").alias("t"), "learn").mapInArrow(count, "word binary, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("c"))


def fit_weights(spark: SparkSession, words: DataFrame, v: Vocabulary, rounds: int = ROUNDS) -> Vocabulary:
    """The vocabulary's weights fitted to distinct words: each round, the pieces expected in their
    segmentations under the last weights, with the first ones added as if seen once.  A task sends
    one row per piece, and the driver gets one per piece."""
    first, n = np.exp(v.weights), len(v.begin)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(v)

        def expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            own = shared.value
            counts = sum((_lattice(own).expected(b["word"].tolist(), own.weights) for b in batches), np.zeros(len(own.weights)))
            yield pd.DataFrame({"piece": np.arange(len(counts), dtype=np.int32), "n": counts})[counts > 0]

        got = words.select("word").mapInPandas(expect, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        counts = first.copy()
        for r in got:
            counts[r["piece"]] += r["n"]
        v = Vocabulary(v.begin, v.go_on, _normalised(counts[:n], counts[n:]))
    return v


def score_texts(docs: DataFrame, learn: Column, vocabulary: Vocabulary, text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``docs`` without its text, with n_tokens, n_known, train_tokens, base_score, score as ``__``-columns.

    A text is its lower-cased words (A-Z only) and one end.  Each token is either drawn from the
    training tokens or, with the probability that Good and Turing give to what was never seen (the share of
    words seen once), a new word, whose probability is the sum over all its segmentations into
    pieces of the vocabulary.  ``base_score`` is that of the unigram counts with 0.1 added.  Both are
    log10.  A null text is empty: its end alone is scored.  Without a training row every word is new.

    Distinct words are counted, fitted and scored once.  Rows keep their sums of frequent
    tokens (a list of bounded length); only the others meet their words in a join.
    """
    spark = docs.sparkSession
    keep = [c for c in docs.columns if c != text]
    rows = docs.withColumn("__learn", F.coalesce(learn, F.lit(False)))
    words = written(count_words(rows.select(F.col(f"`{text}`").alias("text"), F.col("__learn").alias("learn"))), "lm-words")
    total, types, once, ends = words.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1)), F.count(F.when((F.col("c") == 1) & (F.col("word") != F.lit(b"")), 1)),
        F.coalesce(F.max(F.when(F.col("word") == F.lit(b""), F.col("c"))), F.lit(0))).first()
    fitted = spark.sparkContext.broadcast(fit_weights(spark, words.filter((F.col("c") > 0) & (F.col("word") != F.lit(b""))), vocabulary, rounds))
    new = (once + 1) / (total + 2)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = fitted.value
        for pdf in batches:
            end, c = (pdf["word"].str.len() == 0).to_numpy(), pdf["c"].to_numpy(dtype=np.float64)
            spelled = np.full(len(pdf), -np.inf)
            spelled[~end] = _lattice(v).log_probability(pdf["word"][~end].tolist(), v.weights)
            with np.errstate(divide="ignore"):
                seen = np.log(np.where(end, c + 1, c) / (total + 1)) + math.log(1 - new)
            pdf["score"] = np.logaddexp(seen, spelled + math.log(new)) / math.log(10)
            yield pdf

    scored = written(words.select("word", "c").mapInPandas(score, "word binary, c long, score double"), "lm-scored")
    frequent = {bytes(r["word"]): (r["c"], r["score"]) for r in scored.filter(F.col("c") * FREQUENT >= max(total, 1)).collect()}
    frequent.setdefault(b"", next(((r["c"], r["score"]) for r in scored.filter(F.col("word") == F.lit(b"")).collect()), (0, 0.0)))
    shared = spark.sparkContext.broadcast(frequent)
    base = lambda c: math.log10((c + 0.1) / (total + 0.1 * (types + 1)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {w: (c, base(c), s) for w, (c, s) in shared.value.items()}
        for batch in batches:
            out, rest, cuts = [], [], [0]
            for t in batch.column(batch.schema.get_field_index("__text")):
                n = known_n = 0
                b = s = 0.0
                for w, k in Counter([*_tokens(t.as_py()), b""]).items():
                    got = known.get(w)
                    n += k
                    if got is None:
                        rest.append((w, k))
                    else:
                        known_n += k if got[0] else 0
                        b += k * got[1]
                        s += k * got[2]
                cuts.append(len(rest))
                out.append((n, known_n, b, s))
            own = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            sums = [pa.array([r[i] for r in out], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64()))]
            left = pa.StructArray.from_arrays([pa.array([r[0] for r in rest], pa.binary()), pa.array([r[1] for r in rest], pa.int64())], names=["w", "k"])
            yield pa.RecordBatch.from_arrays([*own, *sums, pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), left)], names=names)

    names = [*keep, "__n_tokens", "__known", "__base", "__score", "__rest"]
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep),
                        "__n_tokens long, __known long, __base double, __score double, __rest array<struct<w: binary, k: long>>"])
    texts = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("binary").alias("__text"))
    sums = written(texts.mapInArrow(read, schema).withColumn("__row", F.monotonically_increasing_id()), "lm-rows")
    left = sums.select("__row", F.explode("__rest").alias("x")).select("__row", F.col("x.w").alias("w"), F.col("x.k").alias("k"))
    c = F.col("c")
    met = shuffled(left).join(shuffled(scored), F.col("w") == F.col("word")).groupBy("__row").agg(
        F.sum(F.when(c > 0, F.col("k")).otherwise(0)).alias("__more"),
        F.sum(F.col("k") * F.log10((c + 0.1) / F.lit(total + 0.1 * (types + 1)))).alias("__more_base"),
        F.sum(F.col("k") * F.col("score")).alias("__more_score"))
    out = shuffled(sums.drop("__rest")).join(shuffled(met), "__row", "left")
    plus = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    return out.select(*[F.col(f"`{c}`") for c in keep], "__n_tokens", plus("__known", "__more").alias("__n_known"), F.lit(total).cast("long").alias("__train_tokens"),
                      plus("__base", "__more_base").alias("__base_score"), plus("__score", "__more_score").alias("__score"))
