"""Periodic runs against a plain search over all periods."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from conftest import FOLDER

from almanac.llm import periodic_runs as runs
from almanac.sources import table

SCHEMA = "doc_id long, text string, runs string, _text string, _flat string, start long, _words string"


def plainly(words):
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(24, 3 * q):
                found.setdefault((start, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def digest(words):
    found = plainly(words)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    left = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in found)]
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (
        len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(left)).hexdigest(),
    )


def planted(key, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_every_document_equals_the_plain_search(spark):
    docs = {r.doc_id: r.text for r in table(spark, FOLDER, "documents").collect()}
    found = {r.doc_id: tuple(r)[1:] for r in runs.op13_periodic_runs(spark, FOLDER).collect()}
    assert found == {k: digest(planted(k, t)) for k, t in docs.items()}
    assert any(n for n, *_ in found.values())


def odd_texts(seed, number):
    random.seed(seed)
    for _ in range(number):
        letters, words = random.choice([1, 2, 2, 3, 5, 50]), []
        while len(words) < random.choice([0, 10, 30, 100, 300]):
            kind = random.random()
            if kind < 0.4:
                words += [random.randrange(letters) for _ in range(random.randint(1, 30))]
            elif kind < 0.8:
                unit = [random.randrange(letters) for _ in range(random.randint(1, 20))]
                words += unit * random.randint(1, 9) + unit[: random.randint(0, len(unit))]
            elif words:
                start = random.randrange(len(words))
                words += words[start : start + random.randint(1, 120)]
        yield words


@pytest.mark.parametrize("seed", range(4))
def test_periodic_sequences_side_by_side(seed):
    texts = list(odd_texts(seed, 60))
    assert runs.runs_of(texts) == [plainly(words) for words in texts]


def test_sequences_with_runs_at_every_scale():
    fibonacci, thue = [[0], [0, 1]], [0]
    while len(fibonacci[-1]) < 2500:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    while len(thue) < 2048:
        thue += [1 - x for x in thue]
    texts = [fibonacci[-1], thue, [3] * 2000, [*range(40)] * 30, [*range(900)] * 2, [], [1] * 23, [1] * 24]
    assert runs.runs_of(texts) == [plainly(words) for words in texts]


def test_rules_recur_and_derive_their_places():
    random.seed(3)
    words = runs.np.array([random.randrange(3) for _ in range(500)], runs.np.int64)
    found = runs.grammar(words, runs.np.zeros(500, runs.np.int64))
    length = found.rules.end - found.rules.start
    assert min(runs.np.bincount(found.of)) >= 2
    for rule, at in zip(found.of, found.at):
        start = found.rules.start[rule]
        assert (words[start : start + length[rule]] == words[at : at + length[rule]]).all()
    assert len(found.joints.start) and (found.joints.start < found.joints.middle).all()


def test_odd_rows(spark):
    rows = [
        (1, None, "", "", "", 1, ""), (2, "", None, None, None, None, None), (3, " \t\n", "", "", "", 2, ""),
        (None, "a b " * 40, "", "", "", 3, ""), (4, "a " * 30, "", "", "", 3, ""), (4, "a " * 30, "", "", "", 3, ""),
        (5, "x y\x1cz " * 24 + "ünd", "", "", "", 3, ""), (6, "long " * 100_000, "", "", "", 0, ""),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(frame).collect()]
    assert sorted(found, key=lambda r: (r[0] is None, r[0] or 0)) == [
        (1, [], ""), (2, [], ""), (3, [], ""), (4, [(0, 30, 1)], "a"), (4, [(0, 30, 1)], "a"),
        (5, [(0, 24, 1)], "x y\x1cz ünd"), (6, [(0, 100_000, 1)], "long"), (None, [(0, 80, 2)], "a b"),
    ]
    digests = {r.doc_id: tuple(r)[1:] for r in runs.run_digests(runs.with_planted_runs(frame)).collect()}
    assert digests == {r[0]: digest(planted(r[0], r[1])) for r in rows if r[0] != 6} | {6: digests[6]}
    assert digests[6][:5] == (1, 0, 100_000, 1, 100_000_000)
    assert not runs.run_digests(runs.with_planted_runs(spark.createDataFrame([], SCHEMA))).collect()
