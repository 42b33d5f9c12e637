"""SimHash near-duplicates, found with BK-trees.

Fingerprints are 64 bits. Two that differ in at most ``radius`` bits agree on at least ``blocks - radius`` of
``blocks`` blocks, so the distinct fingerprints are dealt to shards by every such choice of blocks and their contents.
Each shard is a BK-tree: the children of a node are keyed by their Hamming distance to it, and a search follows only
the edges whose key is within the radius of the query's distance. A crowded shard is cut into several trees and as many
blocks of queries; every tree meets every block in a group of its own, so no group is larger than a tree and a block.
A shard's tree is thus taken to the tasks that hold its queries; what would be broadcast as a whole would grow with the
corpus. Shards give links to the first member of each local group, not pairs;
the links are closed by ``components``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.batches import map_batches, map_texts, with_plain_names
from almanac.llm.components import components
from almanac.operators.hot_joins import spread_join
from almanac.sources import materialise, table

SEED = 42
SHINGLE = 4
RADIUS = 4
TREE_NODES = 4096
HASHES_AT_ONCE = 1 << 17
MASK = (1 << 64) - 1


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bitwise majority of the XXH64 of the word shingles of a text, A-Z in lower case; no words: zero."""
    words = text.encode().lower().split()  # bytes: only A-Z and the six ASCII white-space characters are touched
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    last = ends[shingle - 1 :] or ends[-1:]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(last), HASHES_AT_ONCE):
        hashes = np.array(
            [digest(joined[s : e - 1], SEED) for s, e in zip(starts[i : i + HASHES_AT_ONCE], last[i : i + HASHES_AT_ONCE])],
            np.uint64,
        )
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(last), bitorder="little").tobytes(), "little")


def fingerprints(
    docs: DataFrame, shingle: int = SHINGLE, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The kept columns and bits, the fingerprint as a signed long; a null text counts as empty."""

    def prepare() -> Callable[[list[str]], list]:
        def run(texts: list[str]) -> list:
            found = [fingerprint(t, shingle) for t in texts]
            return [[f - (1 << 64) if f >> 63 else f for f in found]]

        return run

    return map_texts(docs, text, keep, "bits long", prepare)


class BkTree:
    """Integers by Hamming distance."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        new = len(self.values) - 1
        node = 0
        while new:
            distance = (self.values[node] ^ value).bit_count()
            child = self.children[node].setdefault(distance, new)
            if child == new:
                return
            node = child

    def within(self, value: int, radius: int) -> list[int]:
        """Numbers of the nodes at most ``radius`` away."""
        found = []
        stack = [0] if self.values else []
        while stack:
            node = stack.pop()
            distance = (self.values[node] ^ value).bit_count()
            if distance <= radius:
                found.append(node)
            low, high = distance - radius, distance + radius
            for edge, child in self.children[node].items():
                if low <= edge <= high:
                    stack.append(child)
        return found


def shard_links(nodes: list[int], queries: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that join whatever is within the radius: each member of a local group with the group's first."""
    tree = BkTree()
    for node in nodes:
        tree.add(node)
    members = nodes + queries
    parent = list(range(len(members)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, value in enumerate(queries, len(nodes)):
        for j in tree.within(value, radius):
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
    return [(members[i], members[r]) for i in range(len(members)) if (r := root(i)) != i and members[i] != members[r]]


def _shard_keys(bits: Column, radius: int, blocks: int) -> Column:
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    parts = [
        F.shiftrightunsigned(bits, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(cuts, cuts[1:])
    ]
    chosen = combinations(range(blocks), blocks - radius)
    return F.array(*[F.xxhash64(F.lit(i), *[parts[k] for k in kept]) for i, kept in enumerate(chosen)])


def links(distinct: DataFrame, radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """From distinct fingerprints (bits): links (a, b) whose closure joins all within the radius.

    ``blocks`` may be raised with the corpus: 6 give shards by 21 bits at radius 4, and 7 shards by 27 bits at
    35 copies of each fingerprint in place of 15.
    """
    keyed = distinct.select("bits", F.explode(_shard_keys(F.col("bits"), radius, blocks or radius + 2)).alias("key"))
    # A shard of more fingerprints than one tree takes becomes several trees and blocks of queries, which all meet.
    crowded = keyed.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > TREE_NODES)
    trees = crowded.select("key", F.ceil(F.col("n") / TREE_NODES).cast("int").alias("trees"))
    number = F.coalesce("trees", F.lit(1))
    own, asking = (F.pmod(F.xxhash64("bits", F.lit(part)), number).cast("int") for part in ("tree", "block"))
    placed = keyed.join(trees, "key", "left").select(
        "bits", "key", own.alias("own"), asking.alias("asking"), F.sequence(F.lit(0), number - 1).alias("all")
    )
    # A fingerprint is a node where its tree meets any block, and a query where its block meets any tree.
    as_node = F.transform("all", lambda block: F.struct(
        F.col("own").alias("tree"), block.alias("block"), F.lit(True).alias("node"), (block == F.col("asking")).alias("query")
    ))
    as_query = F.transform(F.filter("all", lambda tree: tree != F.col("own")), lambda tree: F.struct(
        tree.alias("tree"), F.col("asking").alias("block"), F.lit(False).alias("node"), F.lit(True).alias("query")
    ))
    met = placed.select("bits", "key", F.explode(F.concat(as_node, as_query)).alias("m"))
    dealt = met.select(F.xxhash64("key", "m.tree", "m.block").alias("shard"), "m.node", "m.query", "bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([rest, rows]) if rest is not None else rows
            shards = rows.column("shard").to_numpy()
            # The last shard may go on in the next batch.
            whole = int(np.searchsorted(shards, shards[-1]))
            yield from _linked(rows.slice(0, whole), radius)
            rest = rows.slice(whole)
        if rest is not None:
            yield from _linked(rest, radius)

    return map_batches(dealt.repartition("shard").sortWithinPartitions("shard"), run, "a long, b long")


def _linked(rows: pa.Table, radius: int) -> Iterator[pa.RecordBatch]:
    shards = rows.column("shard").to_numpy()
    if len(shards) < 2:
        return
    bits = rows.column("bits").to_numpy()
    is_node, is_query = (rows.column(c).to_numpy() for c in ("node", "query"))
    starts = np.r_[0, np.flatnonzero(np.diff(shards)) + 1, len(shards)]
    found: list[tuple[int, int]] = []
    for k in np.flatnonzero(np.diff(starts) > 1).tolist():
        part = slice(starts[k], starts[k + 1])
        values = bits[part]
        nodes, queries = values[is_node[part]], values[is_query[part]]
        found += shard_links([v & MASK for v in nodes.tolist()], [v & MASK for v in queries.tolist()], radius)
    if found:
        pairs = np.array(found, np.uint64).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _labelled(
    docs: DataFrame, shingle: int, radius: int, blocks: int | None, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The kept columns, bits and label of every row; a component has one label."""
    prints = materialise(fingerprints(docs, shingle, keep=keep), "prints")
    found = components(links(prints.select("bits").distinct(), radius, blocks))
    return prints.join(found.withColumnRenamed("node", "bits"), "bits", "left").select(
        *keep, "bits", F.coalesce("component", "bits").alias("label")
    )


def near_duplicate_components(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, blocks: int | None = None
) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id, the smallest doc_id reachable by links.

    A null or empty text has the fingerprint zero and is linked like any other. Repeated rows come out each. A null
    doc_id takes part in linking but is no one's component_id, which is null where a component has no doc_id at all.
    Other columns are not read; no rows give no rows.
    """
    labelled = materialise(_labelled(docs, shingle, radius, blocks), "labelled")
    first = labelled.groupBy(F.col("label").alias("component")).agg(F.min("doc_id").alias("component_id"))
    # A component may hold a large part of all rows.
    return spread_join(labelled, first, ["label"], ["component"]).select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def near_deduplicated(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, spare_null_ids: bool = True
) -> DataFrame:
    """One row of each component, with all columns: that of the smallest doc_id, nulls last.

    Of several such rows the least text, then the least of the other columns, stays; rows of one doc_id whose texts lie
    in several components are decided each by its own. With ``spare_null_ids`` rows without a doc_id stand in for no
    component and all stay; they only take part in linking.
    """
    docs, back = with_plain_names(docs)
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    labelled = _labelled(keyed, shingle, radius, None, ("doc_id", "text_key"))
    if spare_null_ids:
        labelled = labelled.filter("doc_id IS NOT NULL")
    # Only keys are compared here; texts are, once they are down to the rows of the smallest doc_id.
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")
    first = labelled.groupBy("label").agg(F.min(place).getField("doc_id").alias("_doc"))
    candidates = (
        labelled.join(first, "label").filter(F.col("doc_id").eqNullSafe(F.col("_doc")))
        .select("_doc", F.col("text_key").alias("_key"), F.col("label").alias("_label")).distinct()
    )
    same = docs["doc_id"].eqNullSafe(F.col("_doc")) & (F.xxhash64(docs["text"]) == F.col("_key"))
    others = [c for c in docs.columns if c != "doc_id"]
    order = F.struct(*[F.col(c) for c in ("doc_id", *sorted(others, key=lambda c: c != "text"))])
    single = docs.join(candidates, same).groupBy("_label").agg(F.min(order).alias("_row"))
    single = single.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
    return back(single.unionByName(docs.filter("doc_id IS NULL")) if spare_null_ids else single)


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_components(table(spark, folder, "documents"))


QUERIES = {"op7_simhash": op7_simhash}
ORACLES: dict[str, str] = {}
