"""Byte-level BPE by merge ranks, encoding and decoding.

Each match of the split pattern is encoded by itself, but the new matches of a group of texts share one queue: they are
laid out one after the other in one linked list whose links end at each match. Pending merges wait in one bucket for
each rank, which holds positions of the list; a bitmap of 64-bit words, with two smaller bitmaps of its non-empty words
above it, tells by find-first-set which rank is next. An entry whose pair has changed since is stale and skipped. The positions of
a bucket are merged together, leftmost first where they overlap; if a merge of that rank could give rise to a pair with a lower
rank, only the leftmost of each match is, and the others go back. So the order within each match is that of single merges, lowest rank
first and leftmost among equals, and a match of a million bytes is no special case. Frequent matches are kept in a table of bounded size.

Edge cases: a null text is empty: no ids, and it decodes to no bytes. Very long texts are split in slices of matches. Repeated rows get equal
results, an empty table gives an empty result, and of the further columns none is read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Longest match, in code points, and number of matches that a worker's table keeps.
KEEP_CHARS, KEEP_MATCHES = 48, 400_000
#: Texts are encoded in groups of about this many characters; longer ones in slices of so many matches.
GROUP_CHARS, SLICE = 2_000_000, 200_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Pairs:
    """Which two tokens make which token: every way to cut a token of the rank file into two others."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.size = max(ranks.values(), default=0) + 1
        cut = [(ranks[t[:i]] * self.size + ranks[t[i:]], rank) for t, rank in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        table = np.array(sorted(cut), "i8").reshape(-1, 2)
        self.keys, self.made = np.ascontiguousarray(table[:, 0]), np.ascontiguousarray(table[:, 1])
        self.bytes = np.array([ranks.get(bytes([b]), -1) for b in range(256)], "i8")
        # the lowest rank that a pair with this token has
        self.lowest = np.full(self.size, self.size)
        for part in (self.keys // self.size, self.keys % self.size):
            np.minimum.at(self.lowest, part, self.made)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank that each pair of tokens has, -1 if it is none."""
        if not len(self.keys):
            return np.full(len(left), -1)
        key = left * self.size + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.made[at], -1)


class Queue:
    """Buckets of positions by rank, under a bitmap of three levels."""

    def __init__(self) -> None:
        self.buckets: dict[int, list[int]] = {}
        self.low: dict[int, int] = {}  # word w: which of the ranks 64 w .. 64 w + 63 have a bucket
        self.mid: dict[int, int] = {}  # which words of low are not zero
        self.top = 0  # which words of mid are not zero

    def push(self, ranks: list[int], positions: list[int]) -> None:
        for rank, position in zip(ranks, positions, strict=True):
            if (bucket := self.buckets.get(rank)) is not None:
                bucket.append(position)
                continue
            self.buckets[rank] = [position]
            word = rank >> 6
            bits = self.low.get(word, 0)
            self.low[word] = bits | 1 << (rank & 63)
            if not bits:
                high = word >> 6
                self.mid[high] = self.mid.get(high, 0) | 1 << (word & 63)
                self.top |= 1 << high

    def pop(self) -> tuple[int, list[int]]:
        """The lowest rank and its bucket, which is taken out."""
        high = (self.top & -self.top).bit_length() - 1
        bits = self.mid[high]
        word = high << 6 | (bits & -bits).bit_length() - 1
        bits = self.low[word]
        rank = word << 6 | (bits & -bits).bit_length() - 1
        self.low[word] = bits & (bits - 1)
        if not self.low[word]:
            self.mid[high] &= self.mid[high] - 1
            if not self.mid[high]:
                self.top &= self.top - 1
        return rank, self.buckets.pop(rank)


def merge(pieces: list[bytes], pairs: Pairs) -> list[bytes]:
    """The ids of each piece, as little-endian unsigned 32-bit integers."""
    lengths = np.fromiter(map(len, pieces), "i8", len(pieces))
    token = pairs.bytes[np.frombuffer(b"".join(pieces), "u1")]
    n = len(token)
    piece = np.repeat(np.arange(len(pieces)), lengths)
    # a place n at the end stands for "none" in both directions
    after, before = np.arange(1, n + 2), np.arange(-1, n)
    ends = np.cumsum(lengths)
    after[ends[lengths > 0] - 1] = n
    before[(ends - lengths)[lengths > 0]] = n
    token = np.append(token, -1)
    alive = np.ones(n, bool)

    def pair_at(at: np.ndarray) -> np.ndarray:
        following = after[at]
        return np.where(following < n, pairs.rank(token[at], token[following]), -1)

    pair = np.append(pair_at(np.arange(n)), -1)
    queue = Queue()
    first = np.flatnonzero(pair >= 0)
    queue.push(pair[first].tolist(), first.tolist())
    while queue.top:
        rank, bucket = queue.pop()
        at = np.array(bucket)
        at = at[pair[at] == rank]
        if len(at) > 1:
            at = np.unique(at)
            if pairs.lowest[rank] > rank:  # every second one of those that follow each other
                new = np.concatenate(([True], after[at[:-1]] != at[1:]))
                if not new.all():
                    place = np.arange(len(at))
                    at = at[(place - np.maximum.accumulate(np.where(new, place, 0))) % 2 == 0]
            else:
                new = np.concatenate(([True], piece[at[1:]] != piece[at[:-1]]))
                back = at[~new].tolist()
                queue.push([rank] * len(back), back)
                at = at[new]
        if not len(at):
            continue
        gone = after[at]
        alive[gone], pair[gone] = False, -1
        token[at] = rank
        after[at] = following = after[gone]
        before[following] = at
        left = before[at]
        changed = np.concatenate((at, left[left < n]))
        pair[changed] = own = pair_at(changed)
        some = own >= 0
        queue.push(own[some].tolist(), changed[some].tolist())
    packed = token[:n][alive].astype("<u4").tobytes()
    stops = (4 * np.cumsum(np.bincount(piece[alive], minlength=len(pieces)))).tolist()
    return [packed[a:b] for a, b in zip([0, *stops], stops, strict=False)]


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pattern, self.pairs = ranks, regex.compile(pattern), Pairs(ranks)
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.known: dict[str, bytes] = {}

    def ids(self, parts: list[list[str]]) -> list[bytes]:
        """The ids of each list of matches."""
        wanted = set().union(*parts)
        fresh = [m for m in wanted if m not in self.known]
        raw = [m.encode() for m in fresh]
        whole = [self.ranks.get(r) for r in raw]
        split = iter(merge([r for r, w in zip(raw, whole, strict=True) if w is None], self.pairs))
        self.known.update((m, next(split) if w is None else w.to_bytes(4, "little")) for m, w in zip(fresh, whole, strict=True))
        out = [b"".join(map(self.known.__getitem__, matches)) for matches in parts]
        if len(self.known) > KEEP_MATCHES:
            self.known = {m: self.known[m] for m in wanted}
        for m in fresh:
            if len(m) > KEEP_CHARS:
                self.known.pop(m, None)
        if len(self.known) > KEEP_MATCHES:
            self.known = {}
        return out

    def encode(self, text: str | None) -> bytes:
        """Slice by slice, so that a long text's matches are never all there at once."""
        matches = (m.group() for m in self.pattern.finditer(text or ""))
        return b"".join(self.ids([part])[0] for part in iter(lambda: list(islice(matches, SLICE)), []))

    def encode_groups(self, texts: Iterable[str | None]) -> Iterator[list[bytes]]:
        """The ids of each text, in lists of those that are encoded together; a text longer than a group is one of its own."""
        group: list[list[str]] = []
        chars = 0
        for text in texts:
            size = len(text or "")
            if group and chars + size > GROUP_CHARS:
                yield self.ids(group)
                group, chars = [], 0
            if size > GROUP_CHARS:
                yield [self.encode(text)]
                continue
            group.append(self.pattern.findall(text or ""))
            chars += size
        if group:
            yield self.ids(group)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(rank_file: str, pattern: str) -> Encoder:
    """One for each worker process; the rank file is read from the worker's own installation."""
    if (rank_file, pattern) not in _encoders:
        _encoders[rank_file, pattern] = Encoder(load_ranks(rank_file), pattern)
    return _encoders[rank_file, pattern]


def encode_decode(df: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, the ids of the text (array<int>) and the bytes they decode to. Each group of texts leaves as a batch of its own,
    so a worker and its JVM hold results of a group, not of all rows of the batch that was read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(rank_file, pattern)
        for batch in batches:
            start = 0
            for packed in own.encode_groups(t.as_py() for t in batch.column(1)):
                ends = np.cumsum([0, *map(len, packed)]) // 4
                ids = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(packed))])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)
                decoded = pa.array(map(own.decode, packed), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(packed)), lists, decoded], names=["id", "ids", "decoded"])
                start += len(packed)

    source = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, ids array<int>, decoded binary")


def digests(df: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, number of ids, and digests of the ids and of the bytes they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(rank_file, pattern)
        for batch in batches:
            counts, ids, decoded = [], [], []
            for packed in chain.from_iterable(own.encode_groups(t.as_py() for t in batch.column(1))):
                counts.append(len(packed) // 4)
                ids.append(hashlib.sha256(packed).hexdigest())
                decoded.append(hashlib.sha256(own.decode(packed)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    source = df.select(df[id_col].alias("doc_id"), df[text_col].alias("text"))
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
