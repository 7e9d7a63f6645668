"""BPE encoding by prefix-sharing trie traversal, and decoding."""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

# Fixed value: the public pre-tokenisation pattern of byte-level BPE.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Bounds of a worker's memory: words whose ids are kept, pairs of tokens whose compatibility is
#: kept (and edges that fall back), bytes of text whose words are put into one trie.
KEEP_WORDS, KEEP_PAIRS, TRIE_CHARS = 1 << 18, 1 << 18, 1 << 20
#: A longer word is encoded but not kept.
KEEP_WORD = 256


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself
    for printable Latin-1 characters, the next free one from U+0100 for the others."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _plain_pattern() -> re.Pattern:
    """The pre-tokenisation pattern for texts without characters above U+FFFF, its Unicode
    classes spelled out as ranges: the standard matcher then looks them up in a table."""
    import regex

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))
    ranges = {c: "".join(f"{re.escape(m[0][0])}-{re.escape(m[0][-1])}" for m in regex.finditer(f"{p}+", every))
              for c, p in (("L", r"\p{L}"), ("N", r"\p{N}"), ("S", r"\s"))}
    plain = (BYTE_LEVEL_PATTERN.replace(r"[^\s\p{L}\p{N}]", "[^" + ranges["S"] + ranges["L"] + ranges["N"] + "]")
             .replace(r"\p{L}", "[" + ranges["L"] + "]").replace(r"\p{N}", "[" + ranges["N"] + "]")
             .replace(r"\S", "[^" + ranges["S"] + "]").replace(r"\s", "[" + ranges["S"] + "]"))
    return re.compile(plain)


class TrieEncoder:
    """Encodes words with a byte-level BPE vocabulary.

    The encoding of a word is the one sequence of tokens in which every two neighbours are
    compatible (the merges leave exactly these two when run over both). So the last token
    of each prefix follows from the last tokens of shorter prefixes: it is the token
    that ends the prefix and is compatible with the last token of what stands before it.
    Distinct words go into a trie; a depth-first walk computes that state once for each
    shared prefix; the ids of a word are read back from its end.
    """

    def __init__(self, spec: str):
        import regex

        data = json.loads(spec)
        model, alphabet = data["model"], byte_alphabet()
        # what the walk does not model is refused, not ignored
        pre, added = data.get("pre_tokenizer") or {}, data.get("added_tokens") or []
        if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("only byte-level BPE with the standard pattern and no prefix space is supported")
        if data.get("normalizer") or model.get("ignore_merges") or model.get("dropout") or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("normalisers, ignore_merges, dropout and stripping added tokens are not supported")
        special = {t["content"]: t["id"] for t in added}
        to_bytes = lambda s: bytes(alphabet[c] for c in s)
        self.ids = {to_bytes(t): i for t, i in model["vocab"].items() if t not in special}
        self.bytes_of = {i: t for t, i in self.ids.items()} | {i: s.encode() for s, i in special.items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        #: rank of the merge of two tokens; of each merged token, its parts and its merge's rank
        self.across, self.parts, self.made_at = {}, {}, {}
        for rank, (a, b) in enumerate(pairs):
            x, y, xy = (model["vocab"][t] for t in (a, b, a + b))
            if xy in self.parts:
                raise ValueError("a token that two merges make is not supported")
            self.across[x, y], self.parts[xy], self.made_at[xy] = rank, (x, y), rank
        self.never = len(pairs)
        self._build_automaton()
        self.length = {i: len(t) for i, t in self.bytes_of.items()}
        self.special = special
        self.split_special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.rare_words, self.plain_words = regex.compile(BYTE_LEVEL_PATTERN).findall, _plain_pattern().findall
        #: ids of words seen lately, and of those seen before them
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Do the merges, run over both tokens' bytes, leave exactly these two?

        The merges on the two sides of the border are undone from the last to the first; a
        merge across the border that comes before the one just undone would have come first.
        At equal rank the merge further left is first."""
        a, b, before = left, right, self.never
        while self.across.get((a, b), self.never) >= before:
            rank_a, rank_b = self.made_at.get(a, -1), self.made_at.get(b, -1)
            if rank_a < 0 and rank_b < 0:
                return True
            if rank_a > rank_b:
                before, a = rank_a, self.parts[a][1]
            else:
                before, b = rank_b + 1, self.parts[b][0]
        return False

    def is_whole(self, token: int) -> bool:
        """Do the merges make one token of its bytes? Its two parts must be whole, and compatible
        but for the merge that joins them."""
        got = self.whole.get(token)
        if got is None:
            parts = [bytes([b]) for b in self.bytes_of[token]]
            while len(parts) > 1:
                ranked = [(self.across.get((self.ids.get(x), self.ids.get(y)), self.never), i) for i, (x, y) in enumerate(zip(parts, parts[1:]))]
                rank, at = min(ranked)
                if rank == self.never:
                    break
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            got = self.whole[token] = len(parts) == 1
        return got

    def _build_automaton(self) -> None:
        """Aho-Corasick automaton of the tokens: a state is the longest end of the bytes read that
        begins a token.  ``step[state << 8 | byte]`` holds the trie's edges, and, as they are met,
        those that fall back; ``ends[state]`` the tokens that end there as (id, bytes), longest first."""
        step, token_at, shorter = {}, {}, [0]
        for token, i in self.ids.items():
            state = 0
            for b in token:
                state = step.setdefault(state << 8 | b, len(shorter))
                if state == len(shorter):
                    shorter.append(0)
            token_at[state] = (i, len(token))
        below: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for edge, state in step.items():
            below[edge >> 8].append((edge & 255, state))
        ends: list[tuple[tuple[int, int], ...]] = [()] * len(shorter)
        level = [0]
        while level:  # by length: what a state falls back to is shorter
            after = []
            for state in level:
                for b, child in below.get(state, ()):
                    back = shorter[state]
                    while back and back << 8 | b not in step:
                        back = shorter[back]
                    shorter[child] = step.get(back << 8 | b, 0) if state else 0
                    own = token_at.get(child)
                    ends[child] = ((own, *ends[shorter[child]]) if own else ends[shorter[child]])
                    after.append(child)
            level = after
        self.step, self.shorter, self.ends = step, shorter, ends
        self.n_edges = len(step)

    def _fall_back(self, state: int, byte: int) -> int:
        """The state after a byte that no edge of ``state`` has; kept as an edge while there is room."""
        at = state
        while at and at << 8 | byte not in self.step:
            at = self.shorter[at]
        found = self.step.get(at << 8 | byte, 0)
        if len(self.step) < self.n_edges + KEEP_PAIRS:
            self.step[state << 8 | byte] = found
        return found

    def encode_words(self, words: set[bytes]) -> dict[bytes, tuple[int, ...]]:
        """Ids of each word.  The trie is its sorted words: in that order they are its depth-first
        walk, and a word goes on from the node that ends the prefix it shares with the one before."""
        if len(self.pairs) > KEEP_PAIRS:
            self.pairs.clear()
        out: dict[bytes, tuple[int, ...]] = {}
        ends, pairs, step, length = self.ends, self.pairs, self.step, self.length
        last, states = [0], [0]  # of each prefix of the node's prefix: its last token, its state
        before = b""
        for word in sorted(words):
            depth = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                depth += 1
            del last[depth + 1:], states[depth + 1:]
            state = states[depth]
            for b in word[depth:]:
                depth += 1
                state = step[state << 8 | b] if state << 8 | b in step else self._fall_back(state, b)
                for token, size in ends[state]:
                    pair = last[depth - size] << 32 | token if size < depth else -1 - token
                    fits = pairs.get(pair)
                    if fits is None:
                        fits = pairs[pair] = self.is_whole(token) and (pair < 0 or self.compatible(pair >> 32, token))
                    if fits:
                        last.append(token)
                        break
                states.append(state)
            at, tokens = depth, []
            while at:
                tokens.append(last[at])
                at -= length[last[at]]
            out[word] = tuple(reversed(tokens))
            before = word
        return out

    def encode_texts(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text, in order; the texts of a call share a trie."""
        cut = [self._pieces(t) for t in texts]
        if len(self.known) > KEEP_WORDS // 2:  # words of the last calls stay, older ones go
            self.known, self.older = {}, self.known
        new = set(chain.from_iterable(p for pieces in cut for p in pieces if isinstance(p, list))).difference(self.known)
        for w in new & self.older.keys():
            self.known[w] = self.older[w]
            new.remove(w)
        as_bytes = {w: w.encode("utf-8", "replace") for w in new}
        coded = self.encode_words(set(as_bytes.values()))
        once = {w: coded[b] for w, b in as_bytes.items() if len(b) > KEEP_WORD}
        for w, b in as_bytes.items():
            if w not in once:
                self.known[w] = coded[b]
        for pieces in cut:
            got: list[int] = []
            for p in pieces:
                if isinstance(p, int):
                    got.append(p)
                elif once:
                    got.extend(chain.from_iterable(once.get(w) or self.known[w] for w in p))
                else:
                    got.extend(chain.from_iterable(map(self.known.__getitem__, p)))
            yield np.array(got, dtype=np.int32)

    def words(self, text: str) -> list[str]:
        # a character above U+FFFF takes two units of UTF-16
        rare = not text.isascii() and len(text.encode("utf-16-le", "surrogatepass")) > 2 * len(text)
        return (self.rare_words if rare else self.plain_words)(text)

    def _pieces(self, text: str) -> list[list[str] | int]:
        """Runs of words, and the ids of special tokens between them."""
        if self.split_special is None:
            return [self.words(text)]
        parts = self.split_special.split(text)
        return [self.special[p] if i % 2 else self.words(p) for i, p in enumerate(parts)]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_ENCODERS: dict[int, TrieEncoder] = {}


def _encoder(spec: str) -> TrieEncoder:
    """One encoder per worker and vocabulary: its words are kept from task to task."""
    key = hash(spec)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = TrieEncoder(spec)
    return _ENCODERS[key]


def read_spec(spark: SparkSession, path: str):
    """The vocabulary file (a few MB, fixed size), read on the driver and broadcast."""
    return spark.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))


def _slices(lengths: list[int]) -> Iterator[tuple[int, int]]:
    """(start, count) of consecutive rows of at most ``TRIE_CHARS`` together, or of one longer row."""
    start = held = 0
    for i, n in enumerate(lengths):
        if i > start and held + n > TRIE_CHARS:
            yield start, i - start
            start = i
            held = 0
        held += n
    if lengths:
        yield start, len(lengths) - start


def encode_documents(docs: DataFrame, spec, text: str = "text", decoded: bool = False) -> DataFrame:
    """``docs`` without its text, with ``__ids`` (array<int>): the ids of the whole text (null:
    empty), no token added; with ``decoded`` also ``__decoded``, the text of these ids.

    Rows go through in slices of a bounded number of characters, whose words share a trie.
    """
    keep = [c for c in docs.columns if c != text]
    schema = StructType([*[docs.schema[c] for c in keep], StructField("__ids", ArrayType(IntegerType())),
                         *[StructField("__decoded", StringType())] * decoded])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(spec.value)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            lengths = pc.fill_null(pc.binary_length(column), 0).to_pylist()
            for start, count in _slices(lengths):
                part = batch.slice(start, count)
                ids = list(enc.encode_texts([t or "" for t in column.slice(start, count).to_pylist()]))
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                made = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))]
                if decoded:
                    made.append(pa.array([enc.decode(x.tolist()) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays([*[part.column(part.schema.get_field_index(c)) for c in keep], *made], names=schema.names)

    return docs.mapInArrow(run, schema)


def decode(ids: Column, spec) -> Column:
    """The text of an array of ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = _encoder(spec.value)
        for s in batches:
            yield s.map(lambda x: None if x is None else enc.decode(x.tolist()))

    return text(ids)
