"""Byte-level BPE encoding by batched merge rounds in numpy, and decoding.

The distinct words of a batch that no earlier batch of the task has seen lie, as symbols, in one
flat array. A round looks up the rank of every neighbouring pair by binary search over the sorted
pair keys, takes each word's lowest rank, and merges all places of that pair in all words at once.
Words without a pair to merge leave the array. Rounds are as many as the longest merge
sequence of a word, not as many as words. Long words would make many rounds over many symbols; in those, a
round goes on to the next rank of all, and looks up only the pairs beside what it has merged. A merge makes
no pair of a lower rank than its own, as a token is made before it is merged, so ranks only rise.

Ids are those of the tokenizers library without added special tokens; the strings of special
tokens in a text are their ids, as there. Defined cases: a null or empty text has no ids.
Very long texts and words are encoded whole. Repeated rows are encoded alike. An empty table gives no rows.
Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.tokens import VOCABULARY, vocabulary

NO_RANK = np.iinfo(np.int64).max
CACHED_WORDS = 400_000
BLOCK_CHARS = 4_000_000
ROUND_SYMBOLS = 2_000_000
LONG_WORD = 512


class Codec:
    """Encodes and decodes with one vocabulary; keeps the ids of words it has met, up to a limit."""

    def __init__(self, path: str = VOCABULARY):
        vocab = vocabulary(path)
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.special = vocab.special
        self.splitter = regex.compile("|".join(f"({regex.escape(s)})" for s in vocab.special) or r"(?!)")
        self.byte_ids = np.array([vocab.tokens[bytes([b])] for b in range(256)], np.int64)
        left = np.array([vocab.tokens[a] for a, _ in vocab.merges], np.int64)
        right = np.array([vocab.tokens[b] for _, b in vocab.merges], np.int64)
        made = np.array([vocab.tokens[a + b] for a, b in vocab.merges], np.int64)
        keys = left << 32 | right
        self.rank = np.argsort(keys, kind="stable")
        self.keys, self.made = keys[self.rank], made
        by_id = {i: t for t, i in vocab.tokens.items()} | {i: s.encode() for s, i in vocab.special.items()}
        pieces = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.flat: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, by binary search over the sorted keys."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.rank[at], NO_RANK)

    def merge_long(self, symbols: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``merge``, rank by rank, looking at the neighbours of merged pairs only."""
        symbols, size = symbols.copy(), len(symbols)
        after, before = np.arange(1, size + 1), np.arange(-1, size - 1)
        last = np.append(words[1:] != words[:-1], True)
        after[last] = -1
        before[np.r_[True, last[:-1]]] = -1
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def wait(places: np.ndarray) -> None:
            places = places[after[places] >= 0]
            rank = self.ranks(symbols[places], symbols[after[places]])
            places, rank = places[rank != NO_RANK], rank[rank != NO_RANK]
            order = np.argsort(rank, kind="stable")
            places, rank = places[order], rank[order]
            for part in np.split(np.arange(len(rank)), np.flatnonzero(np.diff(rank)) + 1):
                if len(part):
                    own = int(rank[part[0]])
                    if own not in waiting:
                        heapq.heappush(heap, own)
                    waiting.setdefault(own, []).append(places[part])

        wait(np.arange(size))
        while heap:
            rank = heapq.heappop(heap)
            at = np.unique(np.concatenate(waiting.pop(rank)))
            # What was merged meanwhile is no symbol any more, or another one.
            at = at[(symbols[at] >= 0) & (after[at] >= 0)]
            at = at[self.ranks(symbols[at], symbols[after[at]]) == rank]
            # Of a run of places, each the next symbol of the one before, take every other one.
            follows = np.append(False, after[at[:-1]] == at[1:])[: len(at)]
            index = np.arange(len(at))
            at = at[(index - np.maximum.accumulate(np.where(follows, 0, index))) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            beyond = after[gone]
            symbols[at], symbols[gone] = self.made[rank], -1
            after[at] = beyond
            before[beyond[beyond >= 0]] = at[beyond >= 0]
            left = before[at]
            wait(np.unique(np.concatenate([left[left >= 0], at])))
        where = np.flatnonzero(symbols >= 0)
        return symbols[where], where

    def merge(self, symbols: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over ``symbols``, of which ``words`` tells the word; words are in order."""
        done_symbols, done_places, places = [], [], np.arange(len(symbols))
        long = np.bincount(words)[words] > LONG_WORD if len(words) else np.zeros(0, bool)
        if long.any():
            merged, where = self.merge_long(symbols[long], words[long])
            done_symbols.append(merged)
            done_places.append(places[long][where])
            symbols, words, places = symbols[~long], words[~long], places[~long]
        while len(symbols):
            rank = self.ranks(symbols[:-1], symbols[1:])
            rank = np.append(np.where(words[:-1] == words[1:], rank, NO_RANK), NO_RANK)
            first = np.flatnonzero(np.r_[True, words[1:] != words[:-1]])
            best = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(words)))
            least = np.repeat(best, size)
            open_ = least != NO_RANK
            if not open_.all():
                done_symbols.append(symbols[~open_])
                done_places.append(places[~open_])
            # The lowest pair may overlap itself (a a a); of a run of places, take every other one.
            take = open_ & (rank == least)
            index = np.arange(len(take))
            run_start = np.maximum.accumulate(np.where(take & ~np.r_[False, take[:-1]], index, 0))
            take &= (index - run_start) % 2 == 0
            symbols = np.where(take, self.made[np.where(take, rank, 0)], symbols)
            stay = open_ & ~np.r_[False, take[:-1]]
            symbols, words, places = symbols[stay], words[stay], places[stay]
        if not done_symbols:
            return symbols, places
        out, where = np.concatenate(done_symbols), np.concatenate(done_places)
        order = np.argsort(where)
        return out[order], where[order]

    def learn(self, new: list[str]) -> None:
        """Encode words not met before, in blocks of about ROUND_SYMBOLS symbols."""
        raw = [word.encode() for word in new]
        lengths = np.array([len(r) for r in raw], np.int64)
        block = np.cumsum(lengths) // ROUND_SYMBOLS
        for part in np.split(np.arange(len(raw)), np.flatnonzero(np.diff(block)) + 1):
            size = lengths[part]
            data = np.frombuffer(b"".join(raw[part[0] : part[-1] + 1]), np.uint8)
            words = np.repeat(np.arange(len(part)), size)
            symbols, where = self.merge(self.byte_ids[data], words)
            self.flat.append(symbols.astype(np.int32))
            self.counts.append(np.bincount(words[where], minlength=len(part)))

    def words(self, text: str) -> list[str]:
        """Pieces in order; special tokens are pieces of their own."""
        if not any(s in text for s in self.special):
            return self.pattern.findall(text)
        parts = [p for p in self.splitter.split(text) if p]
        return list(chain.from_iterable([p] if p in self.special else self.pattern.findall(p) for p in parts))

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        start = weight = 0
        for end, text in enumerate(texts, 1):
            weight += len(text)
            if weight >= BLOCK_CHARS or end == len(texts):
                out += self._encode_block(texts[start:end])
                start, weight = end, 0
        return out

    def _encode_block(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.numbers) > CACHED_WORDS:
            self.forget()
        words = [self.words(text) for text in texts]
        numbers = self.numbers
        new = [w for w in dict.fromkeys(chain.from_iterable(words)) if w not in numbers]
        if new:
            special = [w for w in new if w in self.special]
            plain = [w for w in new if w not in self.special] if special else new
            for word in chain(plain, special):
                numbers[word] = len(numbers)
            if plain:
                self.learn(plain)
            self.flat.append(np.array([self.special[word] for word in special], np.int32))
            self.counts.append(np.ones(len(special), np.int64))
            self.flat, self.counts = [np.concatenate(self.flat)], [np.concatenate(self.counts)]
        if not numbers:
            return [np.empty(0, np.int32) for _ in texts]
        flat, counts = self.flat[0], self.counts[0]
        starts = np.cumsum(counts) - counts
        return [
            flat[_ranges(starts[at], counts[at])]
            for at in (np.fromiter(map(numbers.__getitem__, ws), np.int64, len(ws)) for ws in words)
        ]

    def decode(self, ids: np.ndarray) -> str:
        data = self.bytes[_ranges(self.starts[ids], self.sizes[ids])]
        return data.tobytes().decode("utf-8", "replace")


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size, one range after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - ends + sizes, sizes)


@cache
def codec(path: str = VOCABULARY) -> Codec:
    return Codec(path)


def encode_of(text: str | Column, path: str = VOCABULARY) -> Column:
    """The ids of a text, as an array of integers."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def run(texts: pa.Array) -> pa.Array:
        ids = codec(path).encode_batch([t or "" for t in texts.to_pylist()])
        offsets = np.cumsum([0, *map(len, ids)])
        flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))

    return run(text)


def decode_of(ids: str | Column, path: str = VOCABULARY) -> Column:
    """The text of an array of ids; null counts as no ids."""

    @F.arrow_udf(T.StringType())
    def run(lists: pa.Array) -> pa.Array:
        return pa.array([codec(path).decode(np.array(x or [], np.int64)) for x in lists.to_pylist()], pa.string())

    return run(ids)


DIGESTS = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def round_trip(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: encode, then decode those ids.

    Both steps run in one task on one batch, so that ids need not cross to the JVM and back.
    """

    @F.arrow_udf(DIGESTS)
    def run(texts: pa.Array) -> pa.Array:
        own = codec(path)
        rows = []
        for ids in own.encode_batch([t or "" for t in texts.to_pylist()]):
            raw = ids.astype("<u4").tobytes()
            text = own.decode(ids).encode()
            rows.append((len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text).hexdigest()))
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        kinds = [pa.int64(), pa.string(), pa.string()]
        return pa.StructArray.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=DIGESTS.names
        )

    found = documents.select(F.col(id_column).alias("doc_id"), run(F.col(text_column)).alias("found"))
    return found.select("doc_id", "found.*")
