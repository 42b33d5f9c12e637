"""Byte-level BPE over a corpus of words: encoding by merge replay, and decoding.

The new words of a slice of texts are laid side by side as bytes, a bounded number of bytes at a time. An inverted index lists, for every rank, the
places where a pair of neighbours makes the token of that rank. The merges are replayed over all words at once, the
lowest rank first: the pairs at the listed places are joined and only their neighbours get new entries in the index.
Words never touch each other, so each one ends as if it had been merged alone. Encoded words are kept in a bounded
store; a text is the concatenation of its words.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import count, islice

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession

from almanac.llm.batches import map_texts
from almanac.sources import table

# Bounds of what a worker holds: the store (a word counts as its characters and WORD_COST), new words before a replay,
# bytes of words in one replay, which takes some 60 times as much, and words of a text or characters at once.
STORE_BYTES = 40_000_000
WORD_COST = 150
NEW_WORDS = 100_000
REPLAY_BYTES = 1 << 20
BLOCK = 1 << 18
# Larger slices make fewer replays over the ranks, of more words each.
SLICE_BYTES = 4 << 20

# fixed values: white space of the pattern, and the letters and numbers among the first 0x250 code points
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
EARLY_LETTERS = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
EARLY_NUMBERS = r"0-9\xb2\xb3\xb9\xbc-\xbe"


class ByteBpe:
    """Encoder and decoder for a file of ranks, without special tokens."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        size = max(ranks.values()) + 1
        self.byte_ranks = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = [
            (left << 32 | right, rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (left := ranks.get(token[:cut])) is not None and (right := ranks.get(token[cut:])) is not None
        ]
        pairs.sort()
        self.pair_keys = np.array([key for key, _ in pairs], np.int64)
        self.pair_ranks = np.array([rank for _, rank in pairs], np.int64)
        # Tokens that, once made, can be part of a pair of lower rank than their own.
        early = self.pair_ranks < np.maximum(self.pair_keys >> 32, self.pair_keys & 0xFFFFFFFF)
        self.early = set(np.maximum(self.pair_keys >> 32, self.pair_keys & 0xFFFFFFFF)[early].tolist())
        by_rank = [b""] * size
        for token, rank in ranks.items():
            by_rank[rank] = token
        self.token_bytes = np.frombuffer(b"".join(by_rank), np.uint8)
        self.token_lengths = np.array([len(token) for token in by_rank], np.int64)
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths
        self.words = regex.compile(pattern)
        early_pattern = (
            pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{WHITE}{EARLY_LETTERS}{EARLY_NUMBERS}]")
            .replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]")
            .replace(r"\p{L}", f"[{EARLY_LETTERS}]").replace(r"\p{N}", f"[{EARLY_NUMBERS}]")
        )
        # For texts of early code points only, the same matches by the faster of the two engines.
        self.early_words = re.compile(early_pattern)
        self.is_early = re.compile(r"[\x00-\u024f\u2000-\u206f]*").fullmatch
        self.reset()

    def reset(self) -> None:
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.stored = 0
        self.cost = 0
        self.flat = np.empty(0, np.int32)
        self.lengths = np.empty(0, np.int64)

    def pieces(self, text: str) -> Iterator[list[str]]:
        words = self.early_words if self.is_early(text) else self.words
        if len(text) <= BLOCK:
            yield words.findall(text)
            return
        matches = (m.group() for m in words.finditer(text))
        while block := list(islice(matches, BLOCK)):
            yield block

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token identifiers of each text."""
        ids: list[list[np.ndarray]] = [[] for _ in texts]
        waiting: list[tuple[int, np.ndarray]] = []
        for i, text in enumerate(texts):
            for words in self.pieces(text):
                waiting.append((i, np.fromiter(map(self.number.__getitem__, words), np.int32, len(words))))
                if len(self.number) - self.stored > NEW_WORDS:
                    self._finish(waiting, ids)
        self._finish(waiting, ids)
        return [np.concatenate(parts) if len(parts) != 1 else parts[0] for parts in ids]

    def _finish(self, waiting: list[tuple[int, np.ndarray]], ids: list[list[np.ndarray]]) -> None:
        """Encode the new words, then the pieces of texts that wait for them; empty the store if it has grown too large."""
        flat, lengths = [self.flat], [self.lengths]
        new = iter(list(islice(self.number, self.stored, None)))
        while part := _up_to(new, REPLAY_BYTES):
            self.stored += len(part)
            self.cost += sum(map(len, part)) + WORD_COST * len(part)
            found, sizes = self.replay(part)
            flat.append(found.astype(np.int32))
            lengths.append(sizes)
        self.flat, self.lengths = np.concatenate(flat), np.concatenate(lengths)
        starts = np.cumsum(self.lengths) - self.lengths
        for i, words in waiting:
            ids[i].append(gather(self.flat, starts, self.lengths, words))
        waiting.clear()
        if self.cost > STORE_BYTES:
            self.reset()

    def decode(self, ids: np.ndarray) -> bytes:
        return gather(self.token_bytes, self.token_starts, self.token_lengths, ids).tobytes()

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair makes, or -1."""
        key = left << 32 | right
        place = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[place] == key, self.pair_ranks[place], -1)

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers of all words, end to end, and their number for each word."""
        lengths = np.array([len(w) for w in words], np.int64)
        ids = self.byte_ranks[np.frombuffer(b"".join(words), np.uint8)]
        size = len(ids)
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        after = np.arange(1, size + 1, dtype=np.int32)
        before = np.arange(-1, size - 1, dtype=np.int32)
        ends = np.cumsum(lengths)
        after[ends[lengths > 0] - 1] = -1
        before[(ends - lengths)[lengths > 0]] = -1
        alive = np.ones(size, bool)
        paired = np.full(size, -1, np.int64)
        index: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def enter(places: np.ndarray) -> None:
            """List the places under the rank of the pair that starts there now."""
            followed = places[after[places] >= 0]
            paired[places] = -1
            if not len(followed):
                return
            ranks = self.ranks_of(ids[followed], ids[after[followed]])
            paired[followed] = ranks
            made = ranks >= 0
            followed, ranks = followed[made], ranks[made]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            followed, ranks = followed[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for rank, places_of in zip(ranks[np.r_[0, cuts]].tolist(), np.split(followed, cuts)):
                if rank in index:
                    index[rank].append(places_of)
                else:
                    index[rank] = [places_of]
                    heappush(queue, rank)

        enter(np.arange(size))
        heapify(queue)
        while queue:
            rank = heappop(queue)
            places = index.pop(rank)
            left = places[0] if len(places) == 1 else np.concatenate(places)
            left = left[(paired[left] == rank) & alive[left]]
            if not len(left):
                continue
            if len(left) > 1:
                left = np.unique(left)
                if rank in self.early:  # one merge a word, then look for lower ranks again
                    first = np.r_[True, np.diff(word[left]) != 0]
                    if not first.all():
                        index[rank] = [left[~first]]
                        heappush(queue, rank)
                        left = left[first]
                left = left[_every_other(np.r_[False, left[1:] == after[left[:-1]]])]
            right = after[left]
            follower = after[right]
            ids[left] = rank
            alive[right] = False
            paired[right] = -1
            after[left] = follower
            inner = follower >= 0
            before[follower[inner]] = left[inner]
            leader = before[left]
            enter(np.concatenate([left, leader[leader >= 0]]))
        return ids[alive], np.bincount(word[alive], minlength=len(words))


def _up_to(words: Iterator[str], most: int) -> list[bytes]:
    """The next words as UTF-8, until they have ``most`` bytes."""
    part, size = [], 0
    for word in words:
        part.append(word.encode())
        size += len(part[-1])
        if size >= most:
            break
    return part


def _every_other(linked: np.ndarray) -> np.ndarray:
    """Of places that may each overlap the one before (linked), keep the first, third and so on of every run."""
    if not linked.any():
        return np.ones(len(linked), bool)
    place = np.arange(len(linked))
    start = np.maximum.accumulate(np.where(linked, 0, place))
    return (place - start) % 2 == 0


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The chosen runs of a flat array, end to end."""
    sizes = lengths[chosen]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts[chosen] - (ends - sizes), sizes) + np.arange(total)]


@lru_cache(maxsize=2)
def _codec(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def encoded(
    docs: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The kept columns and ids, the tokens of every row as array<int>; a null or empty text has an empty array.

    Rows are independent: repeated rows are encoded each, a null key is kept, other columns are not read. ``path``
    must be readable on the executors.
    """

    def prepare() -> Callable[[list[str]], list]:
        return lambda texts: [_codec(path, pattern).encode(texts)]

    return map_texts(docs, text, keep, "ids array<int>", prepare, SLICE_BYTES)


def digests(
    docs: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """As ``encoded``, with n_tokens, ids_sha256 (little-endian unsigned 32 bits) and decoded_sha256 for the ids.

    The identifiers are decoded in the same task, so they are never shuffled or written.
    """

    def prepare() -> Callable[[list[str]], list]:
        codec = _codec(path, pattern)

        def run(texts: list[str]) -> list:
            ids = codec.encode(texts)
            return [
                [len(i) for i in ids],
                [hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids],
                [hashlib.sha256(codec.decode(i)).hexdigest() for i in ids],
            ]

        return run

    return map_texts(docs, text, keep, "n_tokens long, ids_sha256 string, decoded_sha256 string", prepare, SLICE_BYTES)


def corpus_digests(docs: DataFrame) -> DataFrame:
    return digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_digests(table(spark, folder, "documents"))


QUERIES = {"op8_byte_bpe": op8_byte_bpe}
ORACLES: dict[str, str] = {}
