"""Token counts by heap-and-linked-list byte-pair merging, without making any identifiers.

A text is cut where no piece of the vocabulary can reach across, before a run of space marks. In such a chunk every
character starts as a symbol of a linked list; a heap gives the adjacent pair of the lowest rank, leftmost first,
which is merged, until no pair is a piece. The count is the number of initial symbols less the merges; a symbol that
is no piece at the end counts its bytes. Equal chunks are counted once per bounded cache.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache
from heapq import heapify, heappop, heappush

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from almanac.llm.batches import map_texts
from almanac.sources import table

SPACE = "▁"
CACHED_CHUNKS = 300_000
LIMIT = 4096


class ChunkCache(dict):
    """Counts of the chunks seen lately, in two generations of bounded size; a chunk that is met again stays."""

    def __init__(self, count: Callable[[str], int]):
        super().__init__()
        self.count = count
        self.older: dict[str, int] = {}

    def __missing__(self, chunk: str) -> int:
        tokens = self.older.get(chunk)
        if tokens is None:
            tokens = self.count(chunk)
        if len(self) >= CACHED_CHUNKS:
            self.older = dict(self)
            self.clear()
        self[chunk] = tokens
        return tokens


class PieceCounter:
    """Counts tokens as the library does for the vocabulary file, without special tokens."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec = model.normalizer_spec
        kinds = model.SentencePiece
        if model.trainer_spec.model_type != model.trainer_spec.BPE or spec.precompiled_charsmap:
            raise ValueError("only byte-pair vocabularies without a table of normal forms are counted")
        if spec.remove_extra_whitespaces or not model.trainer_spec.byte_fallback or not spec.escape_whitespaces:
            raise ValueError("the vocabulary must keep white space and fall back to bytes")
        if any(p.type in (kinds.UNUSED, kinds.USER_DEFINED) for p in model.pieces):
            raise ValueError("unused and user-defined pieces are not supported")
        # The library merges the highest score first; equal scores share a rank and go by place.
        normal = [p for p in model.pieces if p.type == kinds.NORMAL]
        order = {score: rank for rank, score in enumerate(sorted({p.score for p in normal}, reverse=True))}
        self.ranks = {p.piece: order[p.score] for p in normal}
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        across = any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in self.ranks)
        self.chunks = (lambda text: [text]) if across else re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        self.cache = ChunkCache(self.merge)

    def count(self, text: str) -> int:
        if not text:
            return 0
        return sum(map(self.cache.__getitem__, self.chunks(self.prefix + text.replace(" ", SPACE))))

    def merge(self, chunk: str) -> int:
        """Number of tokens of one chunk."""
        if len(chunk) == 1:
            return 1 if chunk in self.ranks else len(chunk.encode())
        rank_of = self.ranks.get
        symbols = list(chunk)
        count = len(symbols)
        after = list(range(1, count + 1))
        before = list(range(-1, count - 1))
        # Rank of the pair that starts at each place; the heap orders by it, then by the place, in one integer.
        paired = [rank_of(chunk[i : i + 2], -1) for i in range(count - 1)]
        paired.append(-1)
        heap = [rank << 32 | i for i, rank in enumerate(paired) if rank >= 0]
        heapify(heap)
        end = count
        while heap:
            entry = heappop(heap)
            left = entry & 0xFFFFFFFF
            if paired[left] != entry >> 32:
                continue  # one of the two has been merged since
            right = after[left]
            merged = symbols[left] = symbols[left] + symbols[right]
            symbols[right] = ""
            paired[right] = -1
            count -= 1
            follower = after[left] = after[right]
            if follower < end:
                before[follower] = left
                paired[left] = rank = rank_of(merged + symbols[follower], -1)
                if rank >= 0:
                    heappush(heap, rank << 32 | left)
            else:
                paired[left] = -1
            leader = before[left]
            if leader >= 0:
                paired[leader] = rank = rank_of(symbols[leader] + merged, -1)
                if rank >= 0:
                    heappush(heap, rank << 32 | leader)
        for symbol in symbols:
            if symbol and symbol not in self.ranks:
                count += len(symbol.encode()) - 1
        return count


@lru_cache(maxsize=2)
def _counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def token_counts(
    docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), limit: int = LIMIT
) -> DataFrame:
    """The kept columns and n_bytes, n_tokens, over_limit of every row; a null text counts as empty (0, 0, false).

    Rows are independent: repeated rows are counted each, a null key is kept, other columns are not read. Texts of
    any length are counted whole, in time proportional to the length times its logarithm. ``path`` must be readable
    on the executors.
    """

    def prepare() -> Callable[[list[str]], list]:
        counter = _counter(path)

        def run(texts: list[str]) -> list:
            counts = [counter.count(t) for t in texts]
            return [[len(t.encode()) for t in texts], counts, [n > limit for n in counts]]

        return run

    return map_texts(docs, text, keep, "n_bytes long, n_tokens long, over_limit boolean", prepare)


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {"op4_token_counts": op4_token_counts}
ORACLES: dict[str, str] = {}
