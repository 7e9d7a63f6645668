"""Fuzzy line dedup: SimHash of normalised lines, pigeonhole blocks, edit similarity,
one occurrence per connected group."""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import combinations
from os.path import commonprefix

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions, row_key, same, scratch, shuffled, written
from .components import connected_components

#: Fingerprints of lines link at this many differing bits or fewer ...
MAX_BITS = 3
#: ... if the edit similarity, 1 - distance / longer length, is at least this.
SIMILARITY = 0.8
#: Bytes of texts gathered before their lines are hashed; bounds a worker's memory.
BLOCK_BYTES = 1 << 20
#: The hash of an end is a polynomial of its words' hashes at this odd number, modulo 2 ** 64; its inverse ...
STEP = np.uint64(0x9E3779B97F4A7C15)
UNSTEP = np.uint64(pow(int(STEP), -1, 1 << 64))
#: ... and the number that keeps ends of different lengths and sides apart.
KIND = np.uint64(0xC2B2AE3D27D4EB4F)

#: Lines of at most so many words are also keyed by what is left without any two of their words ...
FEW_WORDS = 9
#: ... and from here on, below twice as many, by their first and last words without any one of them.
END_WORDS = FEW_WORDS // 2 + 1
#: Lines of at most so many characters are compared inside the join; longer ones have cheaper bounds outside.
SHORT_LINE = 64
#: Partitions of rows that Python gathers hold about so many, a line counted as so many ends, in so many buckets; more rows of one partition are sifted in parts.
PARTITION_ROWS, ENDS_OF_LINE, BUCKETS, SIFT_ROWS = 500_000, 10, 4, 1_000_000
#: Up to so many fingerprints of a block are compared before the join.
FEW_OF_BLOCK = 64
#: Up to so many lines of an end are compared in a join, so that its pairs grow with the lines ...
FEW_LINES = 32
#: ... and more in tiles of about an eighth of them, within these bounds, two tiles at a time.
TILE_LINES = (512, 2048)
#: More lines of one group than that are met by way of one of them.
MANY_OF_GROUP = 8
#: Columns of a table of distances between two looks at all cells of one.
LOOK_AT = 32
#: Texts of at most so many characters have their distances computed many pairs at once, up to so many characters at a time.
LONG_TEXT, BATCH_CHARS, BATCH_PAIRS = 1024, 1 << 18, 4096
#: Their diagonals between two looks at all cells of two.
LOOK_EVERY = 16
#: What stands for a distance beside the band.
FAR = np.uint16(1 << 14)
#: So many pairs of a tile are compared at once.
TILE_PAIRS = 8192
#: Characters and pairs of characters are counted in so many classes for bounds of the edit distance.
CHAR_CLASSES, PAIR_CLASSES, MOST_COUNTED = 64, 256, 1 << 13

#: ASCII signs other than the underscore become spaces.
_SIGNS = bytes(32 if c < 128 and not (chr(c).isalnum() or chr(c) in "_\n") else c for c in range(256))
_LINES = "doc_id long, key long, line int, h1 long, h2 long, fp long, size int, ends array<long>"


def _spaced_lines(text: str) -> bytes:
    """The lines of a text as words with spaces between, before and after them: lower case, ASCII signs and
    white space are spaces; of a line of signs only its non-blank characters, as one word."""
    out = text.lower().encode("utf-8", "replace").translate(_SIGNS)
    lines = out.split(b"\n")
    bare = [i for i, line in enumerate(lines) if not line or line.isspace()]
    if not bare:
        return out
    raw = text.split("\n")
    for i in bare:
        lines[i] = "".join(raw[i].split()).encode("utf-8", "replace")
    return b"\n".join(lines)


def normalise(line: str) -> str:
    """The normal form of one line: its words joined by one space."""
    return b" ".join(_spaced_lines(line.replace("\n", " ")).split()).decode("utf-8", "replace")


def _xxh64(data: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """XXH64 (seed 0) of many words of ``data``: those of each length below 32 bytes at once, as the hash has one form for them."""
    from xxhash import xxh64_intdigest

    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
    turned = lambda x, bits: (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))
    padded = data + bytes(8)
    eights, fours, ones = (np.ndarray((len(data),), kind, padded, strides=(1,)) for kind in ("<u8", "<u4", "u1"))  # from each byte on
    out = np.empty(len(starts), dtype=np.uint64)
    for size in np.unique(sizes).tolist():
        which = np.flatnonzero(sizes == size)
        at = starts[which]
        if size >= 32:
            out[which] = [xxh64_intdigest(data[x:x + size]) for x in at.tolist()]
            continue
        h = np.full(len(at), (int(p5) + size) % (1 << 64), dtype=np.uint64)
        for k in range(0, size - 7, 8):
            h = turned(h ^ turned(eights[at + k] * p2, 31) * p1, 27) * p1 + p4
        k = size - size % 8
        if size % 8 >= 4:
            h = turned(h ^ fours[at + k].astype(np.uint64) * p1, 23) * p2 + p3
            k += 4
        for k in range(k, size):
            h = turned(h ^ ones[at + k].astype(np.uint64) * p5, 11) * p1
        h = (h ^ h >> np.uint64(33)) * p2
        h = (h ^ h >> np.uint64(29)) * p3
        out[which] = h ^ h >> np.uint64(32)
    return out


def _simhash(h: np.ndarray, counts: Sequence[int]) -> np.ndarray:
    """SimHash of consecutive runs of word hashes; ``counts`` has the length of each run.

    The 64 counters of a run are bytes of eight integers, one for each bit of a byte, so
    that a word costs eight additions; runs are summed in pieces of at most 255 words.
    """
    lanes = h >> np.arange(8, dtype=np.uint64)[:, None]
    lanes &= np.uint64(0x0101010101010101)
    n = np.asarray(counts)
    pieces = -(-n // 255)
    first = np.concatenate(([0], np.cumsum(pieces)[:-1]))
    within = np.arange(pieces.sum()) - np.repeat(first, pieces)
    starts = np.repeat(np.cumsum(n) - n, pieces) + within * 255
    part = np.ascontiguousarray(np.add.reduceat(lanes, starts, axis=1).T).astype("<u8").view(np.uint8).reshape(-1, 8, 8)
    ones = np.add.reduceat(part, first, axis=0, dtype=np.int32)  # run, bit of a byte, byte
    set_bits = (ones * 2 > n[:, None, None]).transpose(0, 2, 1)
    return np.packbits(set_bits, axis=2, bitorder="little").reshape(-1, 8).copy().view("<i8").ravel()


@lru_cache(maxsize=1 << 12)
def _end_lengths(n: int, similarity: float) -> tuple[int, ...]:
    """How many units are taken at either end of a line of ``n``: the power of two between a quarter
    and a half of it, the one below unless it is short, and those of the shortest line that can be similar."""
    out = set()
    for m in {n, max(2, int(n * similarity))}:
        q = 1 << max(0, (m // 2).bit_length() - 1)
        out |= {q, q // 2} if q >= 8 else {q}
    return tuple(sorted(out))


def _char_ends(word: bytes, similarity: float) -> list[int]:
    """Hashes of the first and the last characters of a line of one word."""
    from xxhash import xxh3_64_intdigest

    chars = word.decode("utf-8", "replace")
    if len(chars) < 2:
        return []
    return [xxh3_64_intdigest(b"\0" + part.encode("utf-8", "replace"), seed)
            for q in _end_lengths(len(chars), similarity) for seed, part in ((2 * q, chars[:q]), (2 * q + 1, chars[-q:]))]


def _ends(words: list[bytes], similarity: float) -> list[int]:
    """The ends of one line, see ``_all_ends``."""
    from xxhash import xxh64_intdigest

    h = np.array([xxh64_intdigest(w) for w in words], dtype=np.uint64)
    return _all_ends(h, np.zeros(1, np.int64), np.array([len(words)]), [b" ".join(words)], similarity)[0].tolist()


def _all_ends(h: np.ndarray, starts: np.ndarray, n: np.ndarray, own: list[bytes], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, how many a line): of a line's first words and of its last ones, at a few lengths that similar
    lines have in common; of a single word its characters.  Lines that differ in one place share an end.
    ``h`` has the hashes of all words, ``starts`` and ``n`` where those of a line begin and how many there are.

    Two edited words can spoil both ends of a short line.  Up to ``FEW_WORDS`` words, the line
    without any two or fewer of its words is a key as well; from there to below twice
    ``2 * END_WORDS``, each end of ``END_WORDS`` words without any one: of two edits, one end has one
    at most.  Replaced, added and lost words all count as one edit.

    Words hash to the sum of (hash of the word) * STEP ** (place), so that a running sum has those of all ends.
    """
    at = np.arange(len(h)) - np.repeat(starts, n)
    power = np.concatenate((np.ones(1, np.uint64), np.multiply.accumulate(np.full(max(int(n.max()), FEW_WORDS), STEP, np.uint64))))
    up, down = (np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * power[x]))) for x in (at, np.repeat(n, n) - 1 - at))
    stops = starts + n
    found: list[tuple[np.ndarray, np.ndarray]] = []  # (which lines, their hashes), in the order of a line's ends

    def of_kind(hashes: np.ndarray, kind: np.ndarray | int) -> np.ndarray:
        return hashes ^ np.atleast_1d(kind).astype(np.uint64) * KIND

    sizes, of = np.unique(n, return_inverse=True)
    lengths = [_end_lengths(k, similarity) if k > 1 else () for k in sizes.tolist()]
    for slot in range(max(map(len, lengths))):
        q = np.array([x[slot] if slot < len(x) else 0 for x in lengths])[of]
        lines = np.flatnonzero(q)
        q = q[lines]
        found.append((lines, of_kind(up[starts[lines] + q] - up[starts[lines]], 2 * q)))
        found.append((lines, of_kind(down[stops[lines]] - down[stops[lines] - q], 2 * q + 1)))

    single = np.flatnonzero(n == 1)
    listed = [_char_ends(own[i], similarity) for i in single.tolist()]
    found.append((np.repeat(single, np.array([len(x) for x in listed], dtype=np.int64)), np.array([e for x in listed for e in x], dtype=np.uint64)))

    for k in range(4, FEW_WORDS + 1):
        lines = np.flatnonzero(n == k)
        words = h[starts[lines][:, None] + np.arange(k)]
        left = [list(x) for size in range(max(k - 2, 3), k + 1) for x in combinations(range(k), size)]
        hashes = [of_kind((words[:, x] * power[:len(x)]).sum(axis=1), (1 << 33) + len(x)) for x in left]
        hashes = np.sort(np.stack(hashes, axis=1), axis=1)
        row, column = np.nonzero(np.concatenate((np.ones((len(lines), 1), bool), hashes[:, 1:] != hashes[:, :-1]), axis=1))
        found.append((lines[row], hashes[row, column]))

    lines = np.flatnonzero((n >= FEW_WORDS) & (n < 4 * END_WORDS))
    for side, running, first, sign in ((0, up, starts[lines], 1), (1, down, stops[lines], -1)):
        # the hash of the first or last k words, for k from 0 to END_WORDS
        part = [(running[first + sign * k] - running[first]) * np.uint64(1 if sign > 0 else (1 << 64) - 1) for k in range(END_WORDS + 1)]
        without = [part[END_WORDS], *(part[k] + (part[END_WORDS] - part[k + 1]) * UNSTEP for k in range(END_WORDS))]
        for k, hashes in enumerate(without):
            new = np.all([hashes != x for x in without[:k]], axis=0) if k else np.ones(len(lines), bool)
            # five words and four of them must not meet
            found.append((lines[new], of_kind(hashes[new], (1 << 32) + 2 * side + (k > 0))))

    which, hashes = (np.concatenate(x) for x in zip(*found))
    return hashes[np.argsort(which, kind="stable")].view(np.int64), np.bincount(which, minlength=len(n))


def _hash_lines(ends: float | None):
    return lambda batches: _hashed(batches, ends)


def _hashed(batches: Iterator[pa.RecordBatch], ends: float | None) -> Iterator[pa.RecordBatch]:
    """A row per non-blank line: where it stands, a 128-bit hash and the length of its normal
    form, the SimHash of its distinct words (a word that fills half of a line would else be
    the whole fingerprint), and the hashes of its ends for the similarity ``ends``, if given."""
    ids: list[int | None] = []
    keys, skipped, lines = array("q"), array("q"), array("q")
    texts: list[bytes] = []
    held = 0

    def flush() -> pa.RecordBatch | None:
        out = _hashed_block(ids, keys, skipped, lines, b"\n".join(texts), ends)
        for x in (ids, keys, skipped, lines, texts):
            del x[:]
        return out

    for batch in batches:
        for doc_id, key, text in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "key", "text"))):
            if not text:
                continue
            for skip, own in _pieces(_spaced_lines(text)):
                ids.append(doc_id)
                keys.append(key)
                skipped.append(skip)
                lines.append(own.count(b"\n") + 1)
                texts.append(own)
                held += len(own)
                if held >= BLOCK_BYTES:
                    held = 0
                    if (out := flush()) is not None:
                        yield out
    if texts and (out := flush()) is not None:
        yield out


def _pieces(text: bytes) -> Iterator[tuple[int, bytes]]:
    """(lines before it, piece) of a text cut at ends of lines into pieces of about ``BLOCK_BYTES``."""
    at = skip = 0
    while len(text) - at > BLOCK_BYTES and (end := text.find(b"\n", at + BLOCK_BYTES)) >= 0:
        yield skip, text[at:end]
        skip += text.count(b"\n", at, end + 1)
        at = end + 1
    yield skip, text[at:]


def _hashed_block(ids: list[int | None], keys: array, skipped: array, lines: array, joined: bytes, ends: float | None) -> pa.RecordBatch | None:
    """The rows of ``_hashed`` of some pieces of documents, whose lines of words are ``joined``; of each one,
    ``skipped`` has how many lines of the document stand before it and ``lines`` how many are in it."""
    from xxhash import xxh3_128_digest

    raw = np.frombuffer(joined + b"\n", dtype=np.uint8)
    is_break = raw == 10
    blank = is_break | (raw == 32)
    after_blank = np.concatenate(([True], blank[:-1]))
    first = np.flatnonzero(after_blank & ~blank)  # of each word
    if not len(first):
        return None
    # how many words stand before the end of each line
    before = np.searchsorted(first, np.flatnonzero(is_break))
    n = np.diff(before, prepend=0)
    number = np.arange(len(n)) - np.repeat(np.cumsum(lines) - lines - skipped, lines)
    document = np.repeat(np.arange(len(lines)), lines)
    full = np.flatnonzero(n)
    n, number, document = n[full], number[full], document[full]
    starts = np.cumsum(n) - n

    # every word with one space after it, one after the other
    tidy = raw[~(blank & after_blank)]
    space = (tidy == 32) | (tidy == 10)
    tidy[space] = 32
    offsets = np.concatenate(([0], np.flatnonzero(space) + 1))
    begin, end = offsets[starts], offsets[starts + n] - 1
    size = end - begin
    if not joined.isascii():  # code points: bytes that do not continue a character
        points = np.concatenate(([0], np.cumsum((tidy & 0xC0) != 0x80)))
        size = points[end] - points[begin]
    whole = tidy.tobytes()
    own = [whole[x:y] for x, y in zip(begin.tolist(), end.tolist())]
    halves = np.frombuffer(b"".join(map(xxh3_128_digest, own)), dtype=">i8").astype(np.int64).reshape(-1, 2)

    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(whole)])
    words = words.dictionary_encode()
    at = words.indices.to_numpy()
    known, vocabulary = len(words.dictionary), words.dictionary.buffers()
    cuts = np.frombuffer(vocabulary[1], dtype=np.int64, count=known + 1)
    h = _xxh64(vocabulary[2].to_pybytes(), cuts[:-1], np.diff(cuts) - 1)
    of_line = np.sort(np.repeat(np.arange(len(n)) * known, n) + at)
    distinct = of_line[np.concatenate(([True], of_line[1:] != of_line[:-1]))]
    line = distinct // known
    fp = _simhash(h[distinct - line * known], np.bincount(line, minlength=len(n)))
    end_hashes, n_ends = (np.zeros(0, np.int64), np.zeros(len(n), np.int64)) if ends is None else _all_ends(h[at], starts, n, own, ends)
    columns = [pa.array(ids, pa.int64()).take(pa.array(document)), np.array(keys, dtype=np.int64)[document], number.astype(np.int32), halves[:, 0], halves[:, 1],
               fp, size.astype(np.int32),
               pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n_ends))).astype(np.int32)), pa.array(end_hashes))]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc_id", "key", "line", "h1", "h2", "fp", "size", "ends"])


def _widest(edges: list[int]) -> int:
    return max(b - a for a, b in zip(edges, edges[1:]))


def _blocks(fp: Column, max_bits: int) -> list[Column]:
    """Keys of the pigeonhole blocks: within ``max_bits`` bits two of ``max_bits + 2`` blocks
    are equal, so a key for each pair of blocks."""
    m = max_bits + 2
    edges = [round(i * 64 / m) for i in range(m + 1)]
    width = _widest(edges)
    block = [F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:])]
    return [F.shiftleft(block[i], width).bitwiseOR(block[j]) for i, j in combinations(range(m), 2)]


def _sifted(df: DataFrame, rows: int, table: Callable[[pa.RecordBatch], list[np.ndarray]], sift: Callable[[list[np.ndarray], np.ndarray], tuple[np.ndarray, np.ndarray]],
            schema: str) -> DataFrame:
    """The rows (of ``schema``; about ``rows`` in all) of ``table`` of ``df`` that ``sift`` takes, which gets those of a key, the first column, together.

    Most keys have one row.  So rows cross the network as bytes, many rows of a bucket of keys at once, and only rows that
    are taken become rows of the engine.  ``sift`` gets columns and which rows were taken before, and returns which rows are taken and which ones rows that
    come later have to meet.  It is asked at the end of a partition, and each time that ``SIFT_ROWS`` more rows have come, so that a hot key needs no more memory.
    """
    kinds = [np.dtype({"long": "<i8", "int": "<i4"}[x.split()[1]]) for x in schema.split(", ")]
    names = [x.split()[0] for x in schema.split(", ")]
    width = sum(k.itemsize for k in kinds)
    parts = max(partitions(df.sparkSession), math.ceil(rows / PARTITION_ROWS))
    buckets = BUCKETS * parts

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            columns = [np.concatenate(x).astype(k, copy=False) for x, k in zip(zip(*held), kinds)]
            held.clear()
            bucket = (columns[0].view(np.uint64) * STEP >> np.uint64(32)) % np.uint64(buckets)
            order = np.argsort(bucket.astype(np.min_scalar_type(buckets)), kind="stable")
            found, first = np.unique(bucket[order], return_index=True)
            columns = [c[order] for c in columns]
            cuts = [*first.tolist(), len(order)]
            return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array([b"".join(c[x:y].tobytes() for c in columns) for x, y in zip(cuts, cuts[1:])], pa.binary())], names=["bucket", "packed"])

        for batch in batches:
            held.append(table(batch))
            if sum(len(x[0]) for x in held) >= PARTITION_ROWS // 2:
                yield flush()
        if held:
            yield flush()

    def sifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = [np.zeros(0, k) for k in kinds]
        done = np.zeros(0, dtype=bool)
        new: list[list[np.ndarray]] = []

        def taken() -> pa.RecordBatch:
            nonlocal kept, done
            columns = [np.concatenate(x) for x in zip(kept, *new)]
            new.clear()
            done = np.concatenate((done, np.zeros(len(columns[0]) - len(done), dtype=bool)))
            take, stay = sift(columns, done)
            out = pa.RecordBatch.from_arrays([pa.array(c[take & ~done]) for c in columns], names=names)
            kept, done = [c[stay] for c in columns], (take | done)[stay]
            return out

        for batch in batches:
            for x in batch.column(1):
                at, n, columns = 0, x.as_buffer().size // width, []
                for k in kinds:
                    columns.append(np.frombuffer(x.as_buffer(), k, n, at))
                    at += n * k.itemsize
                new.append(columns)
            if sum(len(x[0]) for x in new) >= SIFT_ROWS:
                yield taken()
        if new:
            yield taken()

    return df.mapInArrow(packed, "bucket int, packed binary").repartition(parts, "bucket").mapInArrow(sifted, schema)


def _shared(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows that share their key with another row, in the order of the keys; the number of the key of each)."""
    order = np.argsort(key)
    key = key[order]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    alone = new & np.concatenate((new[1:], [True]))
    return order[~alone], np.cumsum(new)[~alone]


def _near_in_block(max_bits: int):
    """Rows (block, fp, ...) whose block has another fingerprint within ``max_bits`` bits, or so many rows that the join tells."""

    def sift(columns: list[np.ndarray], done: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, run = _shared(columns[0])
        fp = columns[1][at].view(np.uint64)
        near = np.zeros(len(at), dtype=bool)
        full = np.bincount(run, minlength=1)[run] > FEW_OF_BLOCK
        # pairs so many rows apart in the order of the blocks
        first = np.flatnonzero(~full)
        for gap in range(1, FEW_OF_BLOCK):
            first = first[first + gap < len(at)]
            first = first[run[first] == run[first + gap]]
            if not len(first):
                break
            close = first[np.bitwise_count(fp[first] ^ fp[first + gap]) <= max_bits]
            near[close] = near[close + gap] = True
        take = np.zeros(len(done), dtype=bool)
        take[at[near | full]] = True
        # a full block needs only what shows that it is full, once its rows are taken
        stay = np.ones(len(done), dtype=bool)
        place = np.arange(len(at)) - np.searchsorted(run, run)
        stay[at[full & (place > FEW_OF_BLOCK)]] = False
        return take, stay

    return sift


def _near_on_end(similarity: float):
    """Rows (k, size, h1) whose end ``k`` has another line of about that length, once each."""

    def sift(columns: list[np.ndarray], done: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, run = _shared(columns[0])
        # in order of length, if any other line is near enough, the one before or after is; rows taken before come first
        order = np.lexsort((~done[at], columns[2][at], columns[1][at], run))
        at, run = at[order], run[order]
        stay = np.ones(len(done), dtype=bool)
        same_line = (run[1:] == run[:-1]) & (columns[1][at[1:]] == columns[1][at[:-1]]) & (columns[2][at[1:]] == columns[2][at[:-1]])
        stay[at[1:][same_line]] = False
        new = np.concatenate((np.ones(min(1, len(at)), bool), ~same_line))
        at, run = at[new], run[new]
        size = columns[1][at].astype(np.int64)
        near = (run[1:] == run[:-1]) & (size[1:] - size[:-1] <= size[1:] * (1 - similarity) + 1e-9)
        take = np.zeros(len(done), dtype=bool)
        take[at[1:][near]] = True
        take[at[:-1][near]] = True
        return take, stay

    return sift


def _near_fingerprints(classes: DataFrame, max_bits: int, similarity: float) -> DataFrame:
    """(fa, fb), fa < fb: fingerprints within ``max_bits`` bits whose lines' lengths (``low`` to
    ``high`` in a class) allow the similarity, once a pair: a pair counts under the first key
    it shares, inside the join condition."""
    m = max_bits + 2
    edges = [round(i * 64 / m) for i in range(m + 1)]

    def dealt(batch: pa.RecordBatch) -> list[np.ndarray]:
        fp, low, high = (batch.column(i).to_numpy() for i in range(3))
        bits = fp.view(np.uint64)
        block = [bits >> np.uint64(a) & np.uint64((1 << (b - a)) - 1) for a, b in zip(edges, edges[1:])]
        keys = [np.uint64(k << 40) | block[i] << np.uint64(_widest(edges)) | block[j] for k, (i, j) in enumerate(combinations(range(m), 2))]
        return [np.concatenate(keys).view(np.int64), *(np.tile(x, len(keys)) for x in (fp, low, high))]

    # most blocks have no two near fingerprints: only the others are joined
    near = _sifted(classes.select("fp", "low", "high"), math.comb(m, 2) * classes.count(), dealt, _near_in_block(max_bits), "block long, fp long, low int, high int")
    sizes = F.shiftleft(F.col("low").cast("long"), 32).bitwiseOR(F.col("high").cast("long"))
    met = written(near.select("fp", sizes.alias("sizes"), "block"), "line-blocks")
    # no column is renamed on either side: then one shuffle serves both
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    shared = [a == b for a, b in zip(_blocks(x("fp"), max_bits), _blocks(y("fp"), max_bits))]
    first = F.coalesce(*[F.when(c, F.lit(k).cast("long")) for k, c in enumerate(shared)])
    low, high = (lambda c: F.shiftright(c, 32)), (lambda c: c.bitwiseAND(F.lit((1 << 32) - 1)))
    # half a character of slack: the exact check comes with the texts
    lengths = (high(x("sizes")) + 0.5 >= low(y("sizes")) * F.lit(similarity)) & (high(y("sizes")) + 0.5 >= low(x("sizes")) * F.lit(similarity))
    on = ((x("block") == y("block")) & (x("fp") < y("fp")) & (F.bit_count(x("fp").bitwiseXOR(y("fp"))) <= max_bits)
          & lengths & (first == F.shiftright(x("block"), 40)))
    return met.alias("x").join(shuffled(met).alias("y"), on).select(x("fp").alias("fa"), y("fp").alias("fb"))


def _texts(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(h1, norm): the normal form of the line at each place (doc_id, key, line)."""

    @F.pandas_udf("string")
    def norm(s: pd.Series) -> pd.Series:
        return s.map(normalise)

    p = places.groupBy(F.col("doc_id").alias("p_doc"), F.col("key").alias("p_key")).agg(F.collect_list(F.struct("line", "h1")).alias("at"))
    at = docs.join(shuffled(p), same([docs["doc_id"], docs["key"]], [F.col("p_doc"), F.col("p_key")]))
    cut = at.select("at", F.split("text", "\n").alias("lines"))
    found = cut.select(F.explode(F.transform("at", lambda x: F.struct(x["h1"].alias("h1"), F.get("lines", x["line"]).alias("raw")))).alias("x"))
    raw = found.select("x.h1", "x.raw").dropDuplicates(["h1"])
    return raw.select("h1", norm("raw").alias("norm"))


def _unlike(a: str, b: str) -> tuple[str, str]:
    """Two texts without what they have in common at either end, which adds nothing to their distance."""
    p = len(commonprefix((a, b)))
    a, b = a[p:], b[p:]
    s = len(commonprefix((a[::-1], b[::-1])))
    return a[:len(a) - s], b[:len(b) - s]


def _word_for_word(a: str, b: str, limit: int) -> bool:
    """Do texts of as many words come within the limit with each word replaced that differs?"""
    wa, wb = a.split(" "), b.split(" ")
    return len(wa) == len(wb) and sum(max(len(x), len(y)) for x, y in zip(wa, wb) if x != y) <= limit


def _distance_within(a: str, b: str, limit: int) -> bool:
    """Is the edit distance (Levenshtein, code points) at most ``limit``?  Exact: bounds settle
    most pairs, the others go through a bit-parallel computation (Myers, Hyyro)."""
    if abs(len(a) - len(b)) > limit:
        return False
    a, b = _unlike(a, b)
    if max(len(a), len(b)) <= limit:
        return True
    if _word_for_word(a, b, limit):
        return True
    wa, wb = a.split(" "), b.split(" ")
    # no edit of a word costs more than the longest one and its space
    few = limit // (1 + max(map(len, wa + wb)))
    if abs(len(wa) - len(wb)) <= few and len(set(wa).difference(wb)) <= few and _distance(wa, wb, few) <= few:
        return True
    ca, cb = Counter(a), Counter(b)
    if max((ca - cb).total(), (cb - ca).total()) > limit:
        return False
    return _distance(a, b, limit) <= limit


def _distance(a: Sequence[str], b: Sequence[str], limit: int) -> int:
    """The edit distance of two texts or lists of words, or ``limit`` + 1 once it is known to be larger than ``limit``."""
    if not a:
        return len(b)
    # a column of the distance table as two bit vectors: where it rises and where it falls
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << len(a) - 1
    # unlike texts are past the limit in every cell of a column soon after so many of them
    look = limit + limit // 2 if len(a) > LOOK_AT else len(b)
    up, down, distance = full, 0, len(a)
    for at, c in enumerate(b):
        match = where.get(c, 0)
        same_diagonal = (((match & up) + up) ^ up) | match | down
        rises = down | ~(same_diagonal | up) & full
        falls = up & same_diagonal
        distance += bool(rises & last) - bool(falls & last)
        if distance - (len(b) - at - 1) > limit:
            return limit + 1
        rises, falls = rises << 1 | 1, falls << 1
        up = (falls | ~(same_diagonal | rises)) & full
        down = rises & same_diagonal & full
        if at == look:
            if _least_distance(up, down, len(a), at + 1, len(b)) > limit:
                return limit + 1
            look += LOOK_AT
    return distance


def _least_distance(up: int, down: int, size: int, done: int, whole: int) -> int:
    """A lower bound of the distance from column ``done`` of its table: the least cell with what its lengths left differ by."""
    bits = lambda x: np.unpackbits(np.frombuffer(x.to_bytes(-(-size // 8), "little"), np.uint8), count=size, bitorder="little").astype(np.int64)
    column = np.concatenate(([done], done + np.cumsum(bits(up) - bits(down))))
    return int((column + np.abs(np.arange(size, -1, -1) - (whole - done))).min())


def _distances_within(pairs: Sequence[tuple[str, str]], limits: Sequence[int]) -> np.ndarray:
    """``_distance_within`` of many pairs: what the lengths do not settle is computed for many pairs at once, long texts one by one."""
    out = np.zeros(len(pairs), dtype=bool)
    left: list[tuple[int, int, str, str]] = []  # (limit, pair, its texts)
    for i, ((a, b), limit) in enumerate(zip(pairs, limits)):
        if abs(len(a) - len(b)) > limit:
            continue
        if max(len(a), len(b)) > LONG_TEXT:
            out[i] = _distance_within(a, b, limit)
            continue
        # a word of the end they share is in common: most texts differ later than that
        p = next((q for q in (128, 64, 32, 16, 8) if a[:q] == b[:q]), 0)
        a, b = a[p:], b[p:]
        s = next((q for q in (128, 64, 32, 16, 8) if a[-q:] == b[-q:]), 0)
        if s:
            a, b = a[:-s], b[:-s]
        if max(len(a), len(b)) <= limit or _word_for_word(a, b, limit):
            out[i] = True
        else:
            left.append((limit, i, a, b))
    if left:
        limit, which, a, b = zip(*left)
        out[list(which)] = _all_banded(*_codes(a), *_codes(b), np.array(limit))
    return out


def _codes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(a row of character codes for each text, how many are of the text); what follows them is 0.  16 bits are compared
    faster and are taken if they hold all characters."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    out = np.zeros((len(texts), int(size.max(initial=0))), dtype=np.uint16 if flat.max(initial=0) < 1 << 16 else np.uint32)
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    return out, size


def _all_banded(x: np.ndarray, sx: np.ndarray, y: np.ndarray, sy: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """``_banded`` of many pairs, some at a time: those of about the same limit and length fill a table without much waste."""
    out, longer = np.zeros(len(limit), dtype=bool), np.maximum(sx, sy)
    kind = np.result_type(x, y)
    order = np.lexsort((longer, limit))
    at = 0
    while at < len(order):
        # as many as fit if all are as long as the longest among them
        longest = np.maximum.accumulate(longer[order[at:at + BATCH_PAIRS]])
        n = max(1, int(np.searchsorted(longest * np.arange(1, len(longest) + 1), BATCH_CHARS, "right")))
        take = order[at:at + n]
        at += n
        part = [np.ascontiguousarray(t[take, :int(s[take].max())].T, dtype=kind) for t, s in ((x, sx), (y, sy))]
        out[take] = _banded(*part, sx[take], sy[take], limit[take])
    return out


def _banded(x: np.ndarray, y: np.ndarray, la: np.ndarray, lb: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Which pairs have an edit distance of at most their limit?  ``x`` and ``y`` have a column of characters for each text
    and ``la`` and ``lb`` their lengths, which differ by the limit at most.  The tables of all pairs are filled together, from one
    diagonal of cells with the same ``i + j`` to the next, as far from the main diagonal as the largest limit goes.

    A path to the last cell goes through one of any two such diagonals that follow each other, and each step between
    the others' main diagonals costs one: pairs that are past their limit in all cells of two of them go early.
    """
    high, wide, band, n = int(la.max()), int(lb.max()), int(limit.max()), len(limit)
    # row 0 and row ``wide`` stand for what is before the first characters and are not looked at with a cost that counts
    x, y = np.concatenate((np.zeros((1, n), x.dtype), x)), np.concatenate((y[::-1], np.zeros((1, n), y.dtype)))
    # cell (i, d - i) of a diagonal stands in row i + 1; what is beside the band is far
    older, last, now = (np.full((high + 3, n), FAR, dtype=np.uint16) for _ in range(3))
    last[1] = 0
    out, which, ends = np.zeros(n, dtype=bool), np.arange(n), la + lb
    out[ends == 0] = True
    at_end = set(ends.tolist())
    other, ones = np.empty((high + 1, n), dtype=np.uint16), np.ones((high + 1, n), dtype=np.uint16)  # an array of ones is faster than the number
    for d in range(1, int(ends.max()) + 1):
        low, top = max(0, d - wide, -((band - d) // 2)), min(high, d, (d + band) // 2)
        cell, mine, its = now[low + 1:top + 2], x[low:top + 1], y[wide - d + low:wide - d + top + 1]
        # 1 where the characters differ
        cost = other[:len(cell)]
        if x.dtype == np.uint16:
            np.minimum(np.bitwise_xor(mine, its, out=cost), ones[:len(cell)], out=cost)
        else:
            np.copyto(cost, mine != its)
        cost += older[low:top + 1]
        np.minimum(last[low:top + 1], last[low + 1:top + 2], out=cell)
        cell += np.uint16(1)
        np.minimum(cell, cost, out=cell)
        now[low] = now[top + 2] = FAR
        older, last, now = last, now, older
        if d in at_end:
            done = np.flatnonzero(ends == d)
            out[which[done]] = last[la[done] + 1, done] <= limit[done]
        if d % LOOK_EVERY == 0:
            gap = (la - lb).astype(np.int16)
            i = np.arange(low, top + 1, dtype=np.int16)[:, None]
            least = (last[low + 1:top + 2].view(np.int16) + np.abs(2 * i - np.int16(d) - gap)).min(axis=0)
            # the diagonal before may begin a cell earlier
            i = np.arange(low - 1, top + 1, dtype=np.int16)[:, None]
            least = np.minimum(least, (older[low:top + 2].view(np.int16) + np.abs(2 * i - np.int16(d - 1) - gap)).min(axis=0))
            stay = np.flatnonzero((least <= limit) & (ends > d))
            if not len(stay):
                break
            if len(stay) < 0.8 * len(ends):
                x, y, older, last, now = (np.ascontiguousarray(t[:, stay]) for t in (x, y, older, last, now))
                other, ones = (t.ravel()[:len(t) * len(stay)].reshape(len(t), -1) for t in (other, ones))
                which, ends, limit, la, lb = (t[stay] for t in (which, ends, limit, la, lb))
    return out


def _similar(similarity: float):
    """A column function of two normal forms: do they have at least the edit similarity?"""

    @F.pandas_udf("boolean")
    def similar(x: pd.Series, y: pd.Series) -> pd.Series:
        # 1e-9: a product such as 0.2 * 35 may fall short of the whole number it stands for
        pairs = list(zip(x, y))
        return pd.Series(_distances_within(pairs, [int(max(len(s), len(t)) * (1 - similarity) + 1e-9) for s, t in pairs]))

    return similar


def _near_lengths(x: Column, y: Column, similarity: float) -> Column:
    """Can lines of these lengths have the edit similarity?"""
    return F.abs(x - y) <= F.greatest(x, y) * F.lit(1 - similarity) + F.lit(1e-9)


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose lines have at least the edit similarity."""
    a, b = texts.select(F.col("h1").alias("a"), F.col("norm").alias("na")), texts.select(F.col("h1").alias("b"), F.col("norm").alias("nb"))
    both = pairs.join(a, "a").join(b, "b").filter(_near_lengths(F.length("na"), F.length("nb"), similarity))
    return both.filter(_similar(similarity)("na", "nb")).select("a", "b")


def _free_shuffles(df: DataFrame) -> None:
    """Executors drop the shuffle files of a finished step once the driver has collected what refers
    to it.  The two largest steps here are done early: asked now, their files do not stay for the rest."""
    df.sparkSession._jvm.System.gc()


def _held_ends(lines: DataFrame, similarity: float) -> DataFrame:
    """(h1, size, k): the ends that a line shares with another one of about its length; lines may repeat."""
    def dealt(batch: pa.RecordBatch) -> list[np.ndarray]:
        h1, size, ends = (batch.column(i) for i in range(3))
        n = ends.value_lengths().to_numpy()
        return [ends.flatten().to_numpy(), *(np.repeat(x.to_numpy(), n) for x in (size, h1))]

    near = _sifted(lines.select("h1", F.col("size").cast("int"), "ends"), ENDS_OF_LINE * lines.count(), dealt, _near_on_end(similarity), "k long, size int, h1 long")
    return written(near.select("h1", "size", "k"), "line-ends")


def _end_stars(held: DataFrame, similarity: float) -> DataFrame:
    """(a, b), a < b: each line with one line of those of its end and about its length."""
    step = F.floor(F.log(F.col("size").cast("double")) / F.lit(-math.log(similarity)))
    by_length = held.select("k", "h1", step.alias("step"))
    heads = by_length.groupBy("k", "step").agg(F.min("h1").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return by_length.join(shuffled(heads), ["k", "step"]).filter("h1 <> a").select("a", F.col("h1").alias("b"))


def _counted(codes: list[np.ndarray], classes: int) -> np.ndarray:
    """How often each of ``classes`` stands in each list of codes, up to a number: that makes no two lists differ by more."""
    at = np.repeat(np.arange(len(codes)), [len(c) for c in codes]) * classes + np.concatenate([*codes, np.zeros(0, np.int64)])
    return np.minimum(np.bincount(at, minlength=len(codes) * classes), MOST_COUNTED).reshape(len(codes), classes).astype(np.int16)


def _linked_in_tiles(similarity: float):
    """A function of two tiles of the lines of one end: the similar pairs of lines with different
    roots, without those whose roots the pairs before already link.

    One edit changes the counts of characters by two at most and those of pairs of characters by four.
    Of a group with many lines left, one is the centre: a line whose distance to it is above another's
    by more than the limit is too far from that other.  What these bounds leave gets the exact
    distance, many pairs at once.  A pair counts under the least end it shares.
    """

    def linked(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["tile", "size", "h1"])
        h1, root, tile, key = rows["h1"].tolist(), rows["root"].tolist(), rows["tile"].to_numpy(), int(rows["k"].iloc[0])
        norm, ends = rows["norm"].tolist(), [set(e.tolist()) for e in rows["ends"]]
        size = np.array([len(t) for t in norm])
        # what all lines have in common at either end adds nothing to a distance
        p = len(commonprefix(norm))
        norm = [t[p:] for t in norm]
        s = len(commonprefix([t[::-1] for t in norm]))
        norm = [t[:len(t) - s] for t in norm]
        rest = size - p - s
        long = rest > LONG_TEXT
        codes = _codes([t[:LONG_TEXT] for t in norm])[0]
        points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64) for t in norm]
        chars = _counted([c % CHAR_CLASSES for c in points], CHAR_CLASSES)
        pairs = _counted([(c[:-1] * 31 + c[1:]) % PAIR_CLASSES for c in points], PAIR_CLASSES)
        groups = {r: i for i, r in enumerate(dict.fromkeys(root))}
        own = np.array([groups[r] for r in root])
        of = own.copy()  # joined groups have one number
        second = int(np.searchsorted(tile, tile[0], "right"))
        one_tile, out = second == len(h1), []
        centres: dict[int, int] = {}
        to_centre: dict[int, int] = {}

        def not_far(i: int, left: np.ndarray, most: np.ndarray) -> np.ndarray:
            stay = np.ones(len(left), dtype=bool)
            found, which, n = np.unique(own[left], return_inverse=True, return_counts=True)
            for g in np.flatnonzero(n > MANY_OF_GROUP).tolist():
                at = np.flatnonzero(which == g)
                c = centres.setdefault(int(found[g]), int(left[at[0]]))
                whole = _distance(*_unlike(norm[i], norm[c]), 1 << 31)
                for j in left[at].tolist():
                    if j not in to_centre:
                        to_centre[j] = _distance(*_unlike(norm[j], norm[c]), 1 << 31)
                stay[at] = np.abs(whole - np.array([to_centre[j] for j in left[at].tolist()])) <= most[at]
            return stay

        def link(found: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
            a = np.repeat([i for i, _, _ in found], [len(x) for _, x, _ in found])
            b, most = (np.concatenate(x) for x in list(zip(*found))[1:])
            left = of[a] != of[b]
            a, b, most = a[left], b[left], most[left]
            like = long[a] | long[b]
            for i in np.flatnonzero(like).tolist():
                like[i] = _distance_within(norm[a[i]], norm[b[i]], int(most[i]))
            short = np.flatnonzero(~(long[a] | long[b]))
            like[short] = _all_banded(codes[a[short]], rest[a[short]], codes[b[short]], rest[b[short]], most[short])
            for i, j in zip(a[like].tolist(), b[like].tolist()):
                if of[i] != of[j]:
                    out.append((min(h1[i], h1[j]), max(h1[i], h1[j])))
                    of[of == of[j]] = of[i]

        found, waiting = [], 0
        for i in range(len(h1) if one_tile else second):
            # lines stand by their size
            begin = i + 1 if one_tile else second
            begin, stop = begin + np.searchsorted(size[begin:], [size[i] * similarity - 1, size[i] / similarity + 1])
            at = np.arange(begin, stop)
            limit = (np.maximum(size[at], size[i]) * (1 - similarity) + 1e-9).astype(np.int64)
            gap = np.abs(size[at] - size[i])
            near = (gap <= limit) & (of[at] != of[i])
            near &= np.abs(chars[begin:stop] - chars[i]).sum(axis=1, dtype=np.int32) + gap <= 2 * limit
            at, limit = at[near], limit[near]
            near = np.abs(pairs[at] - pairs[i]).sum(axis=1, dtype=np.int32) <= 4 * limit
            at, limit = at[near], limit[near]
            first = np.array([min(ends[i] & ends[j]) == key for j in at.tolist()], dtype=bool)
            at, limit = at[first], limit[first]
            if len(at) > MANY_OF_GROUP:
                near = not_far(i, at, limit)
                at, limit = at[near], limit[near]
            if len(at):
                found.append((i, at, limit))
                waiting += len(at)
            if waiting >= TILE_PAIRS:
                link(found)
                found, waiting = [], 0
        if found:
            link(found)
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return linked


def _apart_by_ends(held: DataFrame, rooted: DataFrame, groups: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(a, b), a < b: pairs of similar lines that share an end, enough to link all groups of ``rooted`` that any
    such pair links.

    A pair counts under the least end it shares: similar lines with different roots share each of their ends in ``held``
    and among those with several roots, so no other end is needed.  Ends of a few lines are joined: short lines are
    compared inside the join condition, longer ones as they leave the join, and no candidate is written.
    The lines of any other end are dealt into tiles that meet two at a time, so that a task's share is
    bounded, no pair is a row and no line is left out."""
    at = held.join(shuffled(rooted), "h1")
    split = at.groupBy("k").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("lines")).filter("low <> high")
    of_line = at.join(shuffled(split.select("k", "lines")), "k").groupBy("h1", "size", "root").agg(F.collect_list(F.struct("k", "lines")).alias("open"))
    of_line = of_line.join(shuffled(texts), "h1").select("h1", "size", "root", "norm", F.array_sort("open.k").alias("ends"), F.explode("open").alias("end"))
    sides = written(of_line.select("h1", "size", "root", "norm", "ends", "end.k", "end.lines"), "line-end-sides")
    few = sides.filter(F.col("lines") <= FEW_LINES)
    left, right = (few.select(F.col("k").alias(f"k{e}"), F.col("h1").alias(e), F.col("size").alias(f"s{e}"), F.col("ends").alias(f"e{e}"),
                              F.col("root").alias(f"r{e}"), F.col("norm").alias(f"n{e}")) for e in "ab")
    limit = F.floor(F.greatest("sa", "sb") * F.lit(1 - similarity) + F.lit(1e-9)).cast("int")
    short = F.greatest("sa", "sb") <= SHORT_LINE
    on = ((F.col("ka") == F.col("kb")) & (F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb")) & _near_lengths(F.col("sa"), F.col("sb"), similarity)
          & (F.get(F.array_intersect("ea", "eb"), F.lit(0)) == F.col("ka"))
          & (~short | (F.call_function("levenshtein", F.col("na"), F.col("nb"), limit) >= 0)))
    by_pairs = left.join(shuffled(right), on).filter(_similar(similarity)("na", "nb")).select("a", "b")

    tiles = F.ceil(F.col("lines") / F.least(F.greatest(F.col("lines") / 8, F.lit(TILE_LINES[0])), F.lit(TILE_LINES[1]))).cast("int")
    many = sides.filter(F.col("lines") > FEW_LINES).withColumn("tile", F.pmod(F.xxhash64("h1"), tiles).cast("int"))
    met = many.select("k", "h1", "size", "root", "ends", "norm", "tile", F.explode(F.sequence(F.lit(0), tiles - 1)).alias("other"))
    met = met.groupBy("k", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"))
    return by_pairs.unionByName(met.applyInPandas(_linked_in_tiles(similarity), "a long, b long"))


def repeated_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", max_bits: int = MAX_BITS,
                   similarity: float = SIMILARITY, any_bits: bool = False) -> DataFrame:
    """(doc_id, key, line): the places of all lines that repeat an earlier one.

    Lines with the same normal form are one line.  Different lines are linked if their
    SimHash fingerprints over distinct words differ in at most ``max_bits`` bits and their edit
    similarity is at least ``similarity``; linked lines form connected groups.  With
    ``any_bits`` the similarity alone decides: lines that share an end (``_ends``) are compared
    too, however many bits they differ in.  The first occurrence of a group, by doc_id (null
    last), row key and line number, is not listed.  ``key`` tells rows with the same id apart;
    fully equal rows share their places.

    Groups are what counts, not pairs.  First each line is compared with one line of its
    fingerprint, of each near fingerprint and of each of its ends; then the lines that this
    leaves in different groups, all of them; what these add merges groups found before.
    """
    base = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), row_key(docs).alias("key"), F.col(f"`{text}`").alias("text"))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "line")
    # of the ends only those that lines share are kept
    hashed = written(base.mapInArrow(_hash_lines(similarity if any_bits else None), _LINES), "lines")
    groups = hashed.groupBy("h1", "h2", "fp", "size").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    groups = written(groups.select("h1", "h2", "fp", "size", "first.*", "n"), "line-groups")
    lines = hashed.select("doc_id", "key", "line", "h1", "h2")
    held = _held_ends(hashed, similarity) if any_bits else None
    _free_shuffles(docs)
    classes = groups.groupBy("fp").agg(F.min("size").alias("low"), F.max("size").alias("high"), F.min("h1").alias("head"), F.count(F.lit(1)).alias("members"))
    classes = written(classes, "line-classes")
    near = written(_near_fingerprints(classes, max_bits, similarity), "line-near")
    _free_shuffles(near)
    many = classes.filter("members > 1").select("fp", "head")

    # the lines that any pair can have, with their texts
    touched = near.select(F.col("fa").alias("fp")).union(near.select("fb")).union(many.select("fp")).distinct()
    members = written(groups.join(shuffled(touched), "fp", "left_semi").select("fp", "h1", "doc_id", "key", "line"), "line-members")
    places = members.select("doc_id", "key", "line", "h1")
    if any_bits:
        at_ends = groups.join(shuffled(held.select("h1").distinct()), "h1", "left_semi")
        places = places.unionByName(at_ends.select("doc_id", "key", "line", "h1")).distinct()
    texts = written(_texts(base, places), "line-texts")
    _free_shuffles(near)

    heads = members.groupBy("fp").agg(F.min("h1").alias("head"))
    head_a, head_b = (heads.select(F.col("fp").alias(f"f{e}"), F.col("head").alias(e)) for e in "ab")
    stars = members.join(many, "fp").filter(F.col("h1") != F.col("head")).select(F.col("head").alias("a"), F.col("h1").alias("b"))
    pairs = stars.unionByName(near.join(head_a, "fa").join(head_b, "fb").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    if any_bits:
        pairs = pairs.unionByName(_end_stars(held, similarity))
    pairs = written(pairs.distinct(), "line-pairs")
    comp = connected_components(_verified(pairs, texts, similarity))
    rooted = texts.select("h1").join(comp, F.col("h1") == F.col("node"), "left")
    rooted = written(rooted.select("h1", F.coalesce("root", "h1").alias("root"), F.col("root").isNotNull().alias("linked")), "line-rooted")

    # the rest of what can be linked: lines of one or two near fingerprints, lines of an end
    in_fp = written(members.select("fp", "h1").join(rooted.select("h1", "root"), "h1"), "line-members-rooted")
    span = in_fp.groupBy("fp").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    span_a, span_b = (span.select(F.col("fp").alias(f"f{e}"), F.col("low").alias(f"l{e}"), F.col("high").alias(f"g{e}")) for e in "ab")
    both = near.unionByName(many.select(F.col("fp").alias("fa"), F.col("fp").alias("fb")))
    unsettled = both.join(span_a, "fa").join(span_b, "fb").filter(F.least("la", "lb") != F.greatest("ga", "gb")).select("fa", "fb")
    side_a, side_b = (in_fp.select(F.col("fp").alias(f"f{e}"), F.col("h1").alias(e), F.col("root").alias(f"r{e}")) for e in "ab")
    apart = unsettled.join(side_a, "fa").join(side_b, "fb").filter((F.col("ra") != F.col("rb")) & ((F.col("fa") != F.col("fb")) | (F.col("a") < F.col("b"))))
    apart = apart.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).join(pairs, ["a", "b"], "left_anti")
    more = _verified(apart, texts, similarity)
    if any_bits:
        more = more.unionByName(_apart_by_ends(held, rooted.select("h1", "root"), groups, texts, similarity))

    # a link between two groups links their roots: the groups found stay as they are
    ra, rb = (rooted.select(F.col("h1").alias(e), F.col("root").alias(f"r{e}")) for e in "ab")
    merged = connected_components(written(more.join(ra, "a").join(rb, "b").select("ra", "rb"), "line-merges"), "ra", "rb")
    merged = merged.withColumnRenamed("root", "into")
    comp = rooted.join(merged, F.col("root") == F.col("node"), "left").filter(F.col("linked") | F.col("into").isNotNull())
    comp = comp.select(F.col("h1").alias("node"), F.coalesce("into", "root").alias("root"))

    # one row per line that has more than one occurrence or a link, with the place to keep
    linked = groups.join(comp, groups["h1"] == comp["node"], "left").filter((F.col("n") > 1) | F.col("root").isNotNull())
    linked = written(linked.select("h1", "h2", "no_id", "doc_id", "key", "line", "root"), "line-linked")
    roots = linked.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min(place).alias("keep"))
    kept = linked.filter(F.col("root").isNotNull()).join(roots, "root").select("h1", "h2", "keep").unionByName(
        linked.filter(F.col("root").isNull()).select("h1", "h2", place.alias("keep")))
    kept = written(kept.select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), F.col("keep.doc_id").alias("k_doc"),
                               F.col("keep.key").alias("k_key"), F.col("keep.line").alias("k_line")), "line-keep")
    j = lines.join(shuffled(kept), (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")))
    first = same([F.col("doc_id"), F.col("key"), F.col("line")], [F.col("k_doc"), F.col("k_key"), F.col("k_line")])
    # dealt by document, so that its lines need not move again
    return j.filter(~first).select("doc_id", "key", "line").repartition("doc_id", "key").distinct()


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, all rows and columns kept, and the
    columns ``__lines`` and ``__removed`` (lines of the text before, lines taken out).

    Blank lines stay where they are.  A null text stays null (0 lines), an empty one has
    one blank line.  A text whose lines all repeat earlier ones becomes empty.  Lines taken
    out are gathered per document only, and no list is longer than the document.
    """
    with scratch():
        places = repeated_lines(docs, text=text, doc_id=doc_id, **options)
        gone = places.groupBy(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).agg(F.collect_list("line").alias("__gone"))
        gone = written(gone, "lines-gone", lasting=True)
    _free_shuffles(gone)

    @F.pandas_udf("string")
    def cut(texts: pd.Series, removed: pd.Series) -> pd.Series:
        out = []
        for t, r in zip(texts, removed):
            drop = frozenset(r) if t is not None else ()
            out.append("\n".join(x for i, x in enumerate(t.split("\n")) if i not in drop) if drop else t)
        return pd.Series(out, dtype=object)

    keyed = docs.withColumn("__row", row_key(docs))
    j = keyed.join(shuffled(gone), same([F.col(f"`{doc_id}`").cast("long"), F.col("__row")], [F.col("__id"), F.col("__key")]), "left")
    # only texts that lose lines go through Python
    t, loses = F.col(f"`{text}`"), F.col("__gone").isNotNull()
    n = F.coalesce(F.octet_length(t) - F.octet_length(F.replace(t, F.lit("\n"), F.lit(""))) + 1, F.lit(0))
    j = j.withColumn("__cut", cut(F.when(loses, t), F.col("__gone")))
    cols = [F.when(loses, F.col("__cut")).otherwise(t).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    removed = F.when(t.isNotNull() & loses, F.size("__gone")).otherwise(F.lit(0))
    return j.select(*cols, n.cast("long").alias("__lines"), removed.cast("long").alias("__removed"))
