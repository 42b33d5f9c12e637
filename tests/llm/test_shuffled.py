"""Operators that compare documents or vectors, against brute force and on odd rows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from almanac.llm import components, fingerprints, line_dedup, mixing, simhash, vector_search

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ", bits string, key string, n string, taken string, _first string, row string, n_lines string, size string"


def documents(spark, rows, clash: bool = False):
    """Rows of (doc_id, text, source); with columns named as the operators' own if ``clash``."""
    full = [(i, t, "en", s, None, *["c"] * 8 * clash) for i, t, s in rows]
    return spark.createDataFrame(full, DOCS + CLASHING * clash)


def prose(n: int, seed: int) -> str:
    random.seed(seed)
    return " ".join("".join(random.choices("abcdefgh", k=random.randint(2, 5))) for _ in range(n))


# Components

@pytest.mark.parametrize("size", [0, 1, 60])
def test_components_by_brute_force(spark, size):
    random.seed(size)
    edges = [(random.randint(0, 90), random.randint(0, 90)) for _ in range(size)] + [(100 + i, 101 + i) for i in range(size)]
    parent = {i: i for e in edges for i in e}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    found = components.components(spark.createDataFrame([*edges, (None, 1)] if edges else [], "a long, b long").dropna())
    assert dict(rows_of(found, "node", "component")) == {i: root(i) for i in parent if root(i) != i}


# SimHash

def brute_print(text: str | None) -> int:
    import xxhash

    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in (text or "").split()]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_by_brute_force(monkeypatch):
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 7)
    for text in ["", "  ", "One", "one two THREE", "a b c d", prose(50, 1), "É é A", "x " * 40]:
        assert simhash.fingerprint(text) == brute_print(text)


def test_bk_tree_by_brute_force():
    random.seed(2)
    values = [random.getrandbits(12) for _ in range(300)]
    tree = simhash.BkTree()
    for v in values:
        tree.add(v)
    for q in values[:50]:
        distinct = set(values)
        assert {tree.values[i] for i in tree.within(q, 3)} == {v for v in distinct if (v ^ q).bit_count() <= 3}


@pytest.mark.parametrize("tree_nodes", [4096, 3])
def test_links_lose_no_neighbour(spark, monkeypatch, tree_nodes):
    monkeypatch.setattr(simhash, "TREE_NODES", tree_nodes)
    random.seed(9)
    values = [random.getrandbits(64) for _ in range(40)]
    for _ in range(120):
        v = random.choice(values)
        for b in random.sample(range(64), random.randint(1, 5)):
            v ^= 1 << b
        values.append(v)
    values = sorted(set(values))
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    found = components.components(simhash.links(spark.createDataFrame(signed, "bits long")))
    of = {v: v for (v,) in signed} | dict(rows_of(found, "node", "component"))
    groups = {}
    for value, (s,) in zip(values, signed):
        groups.setdefault(of[s], set()).add(value)
    left, wanted = set(values), []
    while left:
        group, new = set(), {left.pop()}
        while new:
            group |= new
            new = {v for v in left if any((v ^ g).bit_count() <= 4 for g in new)}
            left -= new
        wanted.append(group)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted))


def test_simhash_of_odd_rows(spark):
    rows = [(5, "a b c d e", "s"), (3, "A b c d e", None), (3, "A b c d e", None), (8, None, "s"), (7, " ", "s"),
            (None, "a b c d e", "s"), (None, "quite another text here", "s"), (9, prose(3000, 1), "s")]
    found = rows_of(simhash.near_duplicate_components(documents(spark, rows, clash=True)), "doc_id", "component_id")
    assert found == [(3, 3), (3, 3), (5, 3), (7, 7), (8, 7), (9, 9), (None, 3), (None, None)]
    kept = simhash.near_deduplicated(documents(spark, rows, clash=True))
    assert rows_of(kept, "doc_id") == [(3,), (7,), (9,), (None,), (None,)]
    assert kept.columns == documents(spark, rows, clash=True).columns
    assert not simhash.near_duplicate_components(documents(spark, [])).collect()


def test_near_copies_are_decided_by_row(spark):
    rows = [(1, "a b c d e", "s"), (3, "quite another text here", "s"), (3, "A b c d e", "s"), (3, prose(40, 1), "s"),
            (None, prose(40, 2), "s"), (None, prose(40, 2), "s"), (None, "a b c d e", "s"), (2, "a b c d e", "s")]
    docs = documents(spark, rows, clash=True)
    whole = simhash.near_deduplicated(docs, spare_null_ids=False)
    wanted = sorted([rows[0][:2], rows[1][:2], rows[3][:2]])
    assert rows_of(whole, "doc_id", "text") == [*wanted, (None, prose(40, 2))] and whole.columns == docs.columns
    spared = rows_of(simhash.near_deduplicated(docs), "doc_id", "text")
    assert spared[:3] == wanted and len(spared) == 6


# Lines

def test_lines_recurring_across_documents_are_dropped_but_once(spark):
    long = prose(60, 3)
    words = long.split()
    varied = " ".join([*words[:4], "other", *words[5:]])
    rows = [
        (1, f"head one two three four\n{long}", "s"), (2, f"{prose(20, 4)}\n{long}\nshort", "s"), (3, f"short\n{varied}", "s"),
        (4, "page 17 of the long report\n" * 3 + "end", "s"), (6, "page 4 of the long report", "s"), (7, None, "s"), (8, "", "s"),
        (None, long, "s"), (9, "x\n" * 3000 + long, "s"), (9, "x\n" * 3000 + long, "s"), (10, prose(60, 5), "s"),
    ]
    found = rows_of(line_dedup.line_deduplicated(documents(spark, rows, clash=True)), "doc_id", "text", "n_lines", "n_dropped")
    texts = {r[0]: r[1:] for r in found}
    assert texts[1] == (rows[0][1], 2, 0) and texts[2] == (f"{prose(20, 4)}\nshort", 3, 1) and texts[3] == ("", 2, 2)
    assert texts[4] == (rows[3][1], 4, 0) and texts[6] == ("", 1, 1) and texts[7] == (None, 1, 0) and texts[8] == ("", 1, 0)
    assert texts[None] == ("", 1, 1) and texts[10] == (prose(60, 5), 1, 0) and len(found) == 11
    assert [r[1:] for r in found if r[0] == 9] == [("\n".join(["x"] * 3000), 3001, 1)] * 2
    assert not line_dedup.line_deduplicated(documents(spark, [])).collect()


def test_leaves_take_fields_in_two_runs_and_in_short_lines(spark):
    long = [f"w{chr(97 + i)}" for i in range(18)]
    two = [w if i not in (3, 15) else "other" for i, w in enumerate(long)]
    four = [w if i not in (3, 7, 11, 15) else "another" for i, w in enumerate(long)]
    rows = [(1, " ".join(long), "s"), (2, " ".join(two), "s"), (3, " ".join(four), "s"),
            (4, "Posted by Alice in Sports", "s"), (5, "Posted by Robin in Sports", "s"), (6, "Posted at home in Rome", "s")]
    found = rows_of(line_dedup.line_deduplicated(documents(spark, rows)), "doc_id", "n_dropped")
    assert found == [(1, 0), (2, 1), (3, 0), (4, 0), (5, 1), (6, 0)]


def test_short_lines_are_dropped(spark):
    rows = [(1, "All rights reserved.\n\nPage 3\n12\n版权所有不得转载", "s"),
            (2, "x\nAll rights  reserved.\n\nPage 41\n13\n版权所有不得转载\n 12", "s")]
    found = rows_of(line_dedup.line_deduplicated(documents(spark, rows)), "doc_id", "text", "n_dropped")
    assert found == [(1, rows[0][1], 0), (2, "x\n\n13", 4)]


# Fingerprints

def jaccard(a: str, b: str) -> float:
    one, two = Counter(a.split()), Counter(b.split())
    return sum((one & two).values()) / max(1, sum((one | two).values()))


def test_collisions_estimate_the_generalised_jaccard_similarity(spark):
    texts = [" ".join(random.Random(i).choices(["a", "b", "c", "d", *map(str, range(30))], k=60)) for i in range(40)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    signed = {r.id: r.signature for r in fingerprints.signatures(frame, ["id"], 64).collect()}
    errors = [
        np.mean([x == y for x, y in zip(signed[i], signed[j])]) - jaccard(texts[i], texts[j])
        for i in range(40) for j in range(i)
    ]
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08


def test_fingerprints_of_odd_rows(spark):
    rows = [(10, "one two three é", "s"), (4, "xx yy zz aa bb", "s"), (4, "xx yy zz aa bb", "s"), (20, None, "s"), (30, "", "s"),
            (None, "one two three é", "s"), (25, prose(4000, 2), "s")]
    found = rows_of(
        fingerprints.fingerprinted(documents(spark, rows, clash=True)),
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )
    by_id = {r[0]: r for r in found}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert len(found) == 7 and found[0] == found[1] and len({r[3] for r in found}) == 4
    assert by_id[4][1:3] == (14, sha("xx yy zone two")) and by_id[10][2] == sha("one two ") and by_id[20][2] == sha("")
    assert by_id[25][2] == sha(rows[-1][1][: len(rows[-1][1]) - len(rows[-1][1]) // 2]) and by_id[30][1:3] == (0, sha(""))
    assert by_id[10][3] == by_id[None][3] and by_id[None][4:] == (by_id[10][3], 1.0, None)
    assert by_id[20][3] == by_id[30][3] and by_id[20][6] == 0.0 and by_id[30][6] == 0.0 and by_id[20][5] == 1.0
    assert all(len(r[3]) == 8 * fingerprints.SAMPLES for r in found)
    alone = fingerprints.fingerprinted(documents(spark, [(1, "a b c d", "s")])).head()
    assert alone.near_next == 1.0 and alone.edited_sha256 == sha("a b a b")
    assert not fingerprints.fingerprinted(documents(spark, [])).collect()


# Mixing

def test_van_der_corput(spark):
    found = [r[0] for r in spark.range(8).select(mixing.van_der_corput(F.col("id"))).collect()]
    assert found == [0, 0.5, 0.25, 0.75, 0.125, 0.625, 0.375, 0.875]


def test_mix_takes_its_targets(spark):
    rows = [(i, "w " * (7 * i % 50 + 1), "abcde"[min(i % 9, 4)]) for i in range(300)]
    rows += [(400, "one two three", None), (401, None, "z"), (402, "  ", "a"), (5, rows[5][1], rows[5][2]), (None, "x y", "a")]
    docs = documents(spark, rows, clash=True)
    found = mixing.mixed(docs, block=16).collect()
    sizes, targets, taken = Counter(), {}, Counter()
    for r in found:
        sizes[r.source] += r.size
        targets[r.source] = r.target
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    # Water filling by hand.
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    open_, level = set(order), 0.0
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in order if s not in open_)
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not over:
            break
        open_ -= over
    for s in order:
        assert targets[s] == pytest.approx(level * weight[s] if s in open_ else 3 * sizes[s])
        assert abs(taken[s] - targets[s]) <= 0.5
    assert len(found) == len(rows) and sorted(map(tuple, found), key=str) == sorted(
        map(tuple, mixing.mixed(docs.repartition(5), block=16).collect()), key=str
    )
    mixture = mixing.mixture(docs, block=16)
    words = Counter()
    for r in mixture.collect():
        words[r.source] += len(r.text.split())
    assert mixture.columns == docs.columns and all(abs(words[s] - taken[s]) <= 50 for s in order)
    assert not mixing.mixed(documents(spark, [])).collect()
    assert [r.target for r in mixing.mixed(documents(spark, [(1, None, "a")])).collect()] == [0.0]


def test_schedule_is_even_all_along(spark):
    sources = spark.createDataFrame([(1, 3000), (2, 1000), (3, 6000), (4, 0)], "n int, quota long")
    slots = sorted((r.slot, r.n, r.words) for r in mixing.schedule(sources, block=10).collect())
    assert sum(w for *_, w in slots) == 10_000
    for end in range(100, 1000, 100):
        shares = Counter(n for _, n, _ in slots[:end])
        assert all(abs(shares[n] - end * q / 10_000) < 8 for n, q in ((1, 3000), (2, 1000), (3, 6000)))


def test_every_block_has_a_slot_of_its_own(spark):
    """Many sources of about a block, which points may miss, beside large ones."""
    random.seed(8)
    quotas = {n: random.choice([1, 5, 10, 11, 25, 39, 0]) for n in range(1, 701)} | {701: 9000, 702: 4000}
    sources = spark.createDataFrame(list(quotas.items()), "n int, quota long")
    found = sorted((r.slot, r.n, r.rank, r.start, r.words) for r in mixing.schedule(sources, block=10).collect())
    assert [r[0] for r in found] == list(range(sum(-(-q // 10) for q in quotas.values())))
    taken = {}
    for _, n, rank, start, words in found:
        assert rank == len(taken.setdefault(n, [])) and start == 10 * rank == sum(taken[n])
        taken[n].append(words)
    assert {n: sum(w) for n, w in taken.items()} == {n: q for n, q in quotas.items() if q}
    for n in (701, 702):
        for part in range(1, 4):
            seen = sum(r[1] == n for r in found[: len(found) * part // 4])
            assert abs(seen - len(taken[n]) * part / 4) < 0.08 * len(taken[n])


def test_the_schedule_by_brute_force(spark):
    """Points of the bits read backwards, each in the interval of its source; a source takes its first ones."""
    quotas = [370, 1220, 45, 0, 800]
    sources = spark.createDataFrame(list(enumerate(quotas, 1)), "n int, quota long")
    found = [(r.n, r.rank, r.words) for r in sorted(mixing.schedule(sources, block=10).collect(), key=lambda r: r.slot)]
    total, ends = sum(quotas), [sum(quotas[: i + 1]) for i in range(5)]
    wanted, ranks = [], Counter()
    for i in range(1 << (mixing.POINTS * -(-total // 10) - 1).bit_length()):
        point = int(f"{i:064b}"[::-1], 2) / 2**64
        n = next(k for k, end in enumerate(ends, 1) if point < end / total)
        if ranks[n] * 10 < quotas[n - 1]:
            wanted.append((n, ranks[n], min(10, quotas[n - 1] - 10 * ranks[n])))
            ranks[n] += 1
    assert all(ranks[n] * 10 >= q for n, q in enumerate(quotas, 1)) and found == wanted


def test_columns_named_as_those_inside_change_nothing(spark):
    """The operators that pass all columns on, with columns named as their own."""
    own = "_doc _text_key _flags _place _line _tokens _runs _leaf _dropped _n_dropped _at _copy _source _turns _key _label _row own1".split()
    rows = [(i, f"{prose(30, i % 4)}\nshared line of some words here", "ab"[i % 2]) for i in range(8)]
    plain = documents(spark, rows)
    named = plain.select("*", *[mixing.F.lit(i).alias(c) for i, c in enumerate(own)])
    for operator in (line_dedup.line_deduplicated, mixing.mixture, simhash.near_deduplicated):
        found = operator(named)
        assert [c for c in found.columns if c in own] == own
        assert rows_of(found.select("doc_id", "text")) == rows_of(operator(plain).select("doc_id", "text"))
        assert {tuple(r) for r in found.select(*own).collect()} == {tuple(range(len(own)))}


def test_the_mix_holds_its_schedule(spark):
    rows = [(i, " ".join(f"{i}.{k}" for k in range(7 * i % 50 + 1)), "abc"[min(i % 5, 2)]) for i in range(200)]
    docs = documents(spark, rows, clash=True)
    found = sorted(mixing.scheduled(docs, block=16).collect(), key=lambda r: (r.slot, r.turn, r.at))
    words, ranks, blocks = {i: t.split() for i, t, _ in rows}, {}, {}
    for r in found:
        ranks.setdefault(r.source, {})[r.rank] = r.slot
        blocks.setdefault((r.source, r.rank), []).extend(words[r.doc_id][r["first"] : r["last"] + 1])
    taken = Counter(w for b in blocks.values() for w in b)
    for r in mixing.mixed(docs, block=16).collect():
        assert sum(taken[w] for w in words[r.doc_id]) == r.taken
    for source, slots in ranks.items():
        n = len(slots)
        assert sorted(slots) == list(range(n)) and [slots[k] for k in range(n)] == sorted(slots.values())
        assert all(len(blocks[source, k]) == 16 for k in range(n - 1)) and 0 < len(blocks[source, n - 1]) <= 16
        stream = [w for k in range(n) for w in blocks[source, k]]
        size = sum(len(words[i]) for i, _, s in rows if s == source)
        assert stream[size:] == stream[: max(0, len(stream) - size)]
    # The written documents are in its order: every source is spread over the table by its share.
    mix = [(r.source, len(r.text.split())) for r in mixing.mixture(docs, block=16).collect()]
    total = sum(n for _, n in mix)
    share = {s: sum(n for t, n in mix if t == s) / total for s in "abc"}
    for part in range(1, 8):
        seen, end = Counter(), part * total // 8
        for s, n in mix:
            if sum(seen.values()) < end:
                seen[s] += n
        assert all(abs(seen[s] - share[s] * end) < 120 for s in "abc"), (part, seen, share)


# Vectors

def test_top_k_by_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(0, 0.3, (400, 8)).astype(np.float32)
    vectors[50:80] = vectors[0]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    odd = [(1000, None), (1050, [1.0, None]), (1100, [float("nan")] * 8), (1150, [float("inf")] * 8), (1200, []), (None, [0.5] * 8),
           (1250, [0.5, 0.5]), (1300, [1e18] * 8), (7, [2.0] * 8)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    scaled = vector_search.scaled(frame)
    found = vector_search.top_k(scaled.filter("vec_id % 50 = 0"), scaled)
    ints = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows + [odd[6], odd[7], odd[8]]]
    wanted = []
    for q, qv in ints:
        if q % 50 == 0:
            scores = [
                (-max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(qv, cv)))), c)
                for c, cv in ints if c != q and len(cv) == len(qv)
            ]
            wanted += [(q, k, c, -s) for k, (s, c) in enumerate(sorted(scores)[:5], 1)]
    assert rows_of(found, "query_id", "rank", "vec_id", "score") == sorted(wanted)
    assert not vector_search.top_k(scaled.limit(0), scaled).collect()


def test_bounds_hold_and_blocks_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(2)
    vectors, queries = rng.integers(-90, 90, (500, 16)), rng.integers(-90, 90, (20, 16))
    lower, upper = vector_search.ApproximationFile(vectors).bounds(queries)
    exact = queries @ vectors.T
    assert (lower <= exact).all() and (exact <= upper).all()
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, v array<bigint>")
    asked = frame.filter("vec_id % 5 = 0")
    wanted = rows_of(vector_search.top_k(asked, frame))
    monkeypatch.setattr(vector_search, "CANDIDATES_AT_ONCE", 60)
    monkeypatch.setattr(vector_search, "QUERIES_AT_ONCE", 30)
    assert rows_of(vector_search.top_k(asked, frame)) == wanted
