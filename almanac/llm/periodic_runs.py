"""Periodic runs of words, found in a grammar of the text.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and a length of at least
``max(LEAST_WORDS, LEAST_PERIODS * q)`` that no neighbouring word extends.

The words of a slice of texts are numbered text by text and laid side by side. Re-Pair replaces pairs that recur in a
text by new symbols, the most frequent first; pairs that do not touch are replaced in the same round. What is left of a
text is joined by halves, so each text becomes one binary derivation. A run lies in some smallest symbol and crosses
the boundary between its two halves. So the runs that cross a symbol's boundary are looked for once, whatever the
number of its occurrences: their periods are among the distances at which the two words at the boundary recur. The
runs found are moved to all places of the derivation where the symbol stands, and of one period only the maximal ones
are kept.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass
from itertools import count

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.batches import fresh, map_texts
from almanac.sources import table

LEAST_WORDS = 24
LEAST_PERIODS = 3
# Matching words looked at on either side before a period is followed to its end; fewer than any run needs in all.
LOOK = 16
SLICE_BYTES = 2 << 20

Run = tuple[int, int, int]  # start, length, period


def words_of(text: str) -> list[bytes]:
    """Words between spaces and the control characters 9-13, as UTF-8; bytes split at just these."""
    return text.encode().split()


@dataclass
class Nodes:
    """Symbols of a grammar by one place where each stands: from start to end, halves meet at the middle."""

    start: np.ndarray
    middle: np.ndarray
    end: np.ndarray


@dataclass
class Grammar:
    """Binary derivations of several sequences laid side by side.

    ``rules`` are the symbols that recur; rule ``of[i]`` also stands at ``at[i]``. ``joints`` stand once each.
    """

    rules: Nodes
    of: np.ndarray
    at: np.ndarray
    joints: Nodes


def _mixed(values: np.ndarray) -> np.ndarray:
    """Scrambled values, so that ties between pairs do not follow the order of the text."""
    mixed = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def _every_other(same: np.ndarray) -> np.ndarray:
    """True for the first, third and so on of every stretch in which each item is marked as the same as its last."""
    place = np.arange(len(same))
    start = np.maximum.accumulate(np.where(same, 0, place))
    return (place - start) % 2 == 0


def grammar(symbols: np.ndarray, text_of: np.ndarray) -> Grammar:
    """Re-Pair in rounds. Symbols of different texts must differ, so that pairs recur within a text only.

    Every round counts the pairs that still occur and replaces those places at which a pair is more frequent than both
    pairs that overlap it; equally frequent ones are told apart by a hash. The most frequent pair of all is always
    replaced, so the rounds end, when no pair occurs twice. A text without such a pair leaves the rounds at once.
    """
    size = len(symbols)
    text = text_of
    symbol = symbols.astype(np.int64)
    start = np.arange(size, dtype=np.int64)
    end = start + 1
    fresh = int(symbol.max(initial=-1)) + 1
    rules: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    of, at, done = [], [], []
    made = 0
    while len(symbol) > 1:
        key = symbol[:-1] << 32 | symbol[1:]
        inside = text[:-1] == text[1:]
        place = np.flatnonzero(inside)
        pairs, number = np.unique(key[place], return_inverse=True)
        # Of xxxx only every other pair counts: the others overlap it.
        again = np.zeros(len(place), bool)
        again[1:] = (number[1:] == number[:-1]) & (place[1:] == place[:-1] + 1)
        valid = _every_other(again)
        often = np.bincount(number[valid], minlength=len(pairs))
        order = np.empty(len(pairs), np.int64)
        order[np.lexsort((_mixed(pairs), often))] = np.arange(1, len(pairs) + 1)
        rank = np.zeros(len(symbol) + 1, np.int64)  # rank[i + 1]: of the pair at i, 0 if it occurs but once
        rank[place + 1] = np.where(often[number] > 1, order[number], 0)
        alive = np.zeros(len(symbol), bool)
        alive[:-1][place[valid]] = True
        top = np.append(rank[1:-1], 0)
        taken = np.flatnonzero(alive & (top > 0) & (top >= rank[:-1]) & (top >= np.append(rank[2:], 0)))
        if not len(taken):
            break
        # A pair that is left at one place only, for now, would make a rule that does not recur.
        pair_of = number[np.searchsorted(place, taken)]
        recurs = np.bincount(pair_of, minlength=len(pairs))[pair_of] > 1
        taken, pair_of = taken[recurs], pair_of[recurs]
        chosen, first, rule = np.unique(pair_of, return_index=True, return_inverse=True)
        head = taken[first]
        rules.append((start[head], end[head], end[head + 1]))
        of.append(rule + made)
        at.append(start[taken])
        made += len(chosen)
        symbol[taken] = rule + fresh
        fresh += len(chosen)
        end[taken] = end[taken + 1]
        stays = np.ones(len(symbol), bool)
        stays[taken + 1] = False
        # Texts in which no pair occurred twice will have none later either.
        live = np.zeros(int(text[-1]) + 1, bool)
        live[text[:-1][top[:-1] > 0]] = True
        finished = stays & ~live[text]
        done.append((start[finished], end[finished], text[finished]))
        stays &= live[text]
        symbol, start, end, text = symbol[stays], start[stays], end[stays], text[stays]
    done.append((start, end, text))
    start, end, text = (np.concatenate(part) for part in zip(*done))
    in_order = np.argsort(start)
    none = np.empty(0, np.int64)
    return Grammar(
        Nodes(*(np.concatenate(part) for part in zip(*rules))) if rules else Nodes(none, none, none),
        np.concatenate(of) if of else none, np.concatenate(at) if at else none,
        _joints(start[in_order], end[in_order], text[in_order]),
    )


def _joints(start: np.ndarray, end: np.ndarray, text: np.ndarray) -> Nodes:
    """Join the symbols of each text by halves, down to stretches too short for a run."""
    edge = np.flatnonzero(np.diff(text, prepend=-1, append=-1))
    low, high = edge[:-1], edge[1:]
    found = []
    while len(low):
        long = (high - low > 1) & (end[high - 1] - start[low] >= LEAST_WORDS)
        low, high = low[long], high[long]
        middle = (low + high) // 2
        found.append((start[low], start[middle], end[high - 1]))
        low, high = np.concatenate([low, middle]), np.concatenate([middle, high])
    return Nodes(*(np.concatenate(part) for part in zip(*found))) if found else Nodes(start[:0], start[:0], start[:0])


def _matches(words: np.ndarray, left: int, right: int, most: int, step: int) -> int:
    """Number of places, at most ``most``, for which words from left and from right on (or back) are equal."""
    total, size = 0, 32
    while total < most:
        take = min(size, most - total)
        if step > 0:
            same = words[left + total : left + total + take] == words[right + total : right + total + take]
        else:
            same = (
                words[left - total - take + 1 : left - total + 1] == words[right - total - take + 1 : right - total + 1]
            )[::-1]
        if not same.all():
            return total + int(np.argmin(same))
        total += take
        size *= 2
    return total


def _promising(
    words: np.ndarray, left: np.ndarray, right: np.ndarray, low: np.ndarray, high: np.ndarray, need: np.ndarray
) -> np.ndarray:
    """Whether the LOOK words before left and right and the LOOK words from them on match as often as a run needs."""
    total = np.zeros(len(left), np.int64)
    for step in (1, -1):
        at = np.arange(len(left))
        a, b = (left, right) if step > 0 else (left - 1, right - 1)
        for k in range(LOOK):
            x, y = a[at] + step * k, b[at] + step * k
            on = (y < high[at]) & (x >= low[at])
            on[on] = words[x[on]] == words[y[on]]
            at = at[on]
            if not len(at):
                break
            total[at] += 1
    return total >= np.minimum(need, LOOK)


def crossing(words: np.ndarray, text_of: np.ndarray, nodes: Nodes) -> tuple[np.ndarray, ...]:
    """Runs across the middle of each node, within the node: node, start, end, period (the smallest).

    A run that is three periods long has one and a half on one side of the middle. So the two words at the middle come
    again one period later, or came one period earlier, and still inside the run.
    """
    span = nodes.end - nodes.start
    number = np.flatnonzero(span >= LEAST_WORDS)
    if not len(number):
        return tuple(np.empty(0, np.int64) for _ in range(4))
    start, middle, end = nodes.start[number], nodes.middle[number], nodes.end[number]
    size = len(words)
    pair = np.where(text_of[:-1] == text_of[1:], words[:-1] << 32 | words[1:], -1)
    same = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    place = np.arange(size - 1, dtype=np.int64)
    listed = np.sort(same * size + place)  # places of each pair of neighbours, in order
    here = same[middle - 1] * size
    left, right, owner = [], [], []
    reach_right = middle - 1 + (end - middle) * 2 // 3
    reach_left = middle - 1 - (middle - start) * 2 // 3
    for low, high in ((middle, reach_right), (reach_left, middle - 2)):
        first = np.searchsorted(listed, here + np.maximum(low, 0), "left")
        last = np.searchsorted(listed, here + np.maximum(high, -1), "right")
        many = np.maximum(last - first, 0)
        which = np.repeat(np.arange(len(number)), many)
        offset = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        other = listed[np.repeat(first, many) + offset] % size + 1
        left.append(np.minimum(other, middle[which]))
        right.append(np.maximum(other, middle[which]))
        owner.append(which)
    left, right, owner = np.concatenate(left), np.concatenate(right), np.concatenate(owner)
    period = right - left
    need = np.maximum(LEAST_WORDS, LEAST_PERIODS * period) - period
    hopeful = _promising(words, left, right, start[owner], end[owner], need)
    left, right, owner, period = left[hopeful], right[hopeful], owner[hopeful], period[hopeful]
    order = np.lexsort((period, owner))
    found: list[tuple[int, int, int, int]] = []
    last, seen = -1, []
    for i in order.tolist():
        node, q, a, b = int(owner[i]), int(period[i]), int(left[i]), int(right[i])
        if node != last:
            last, seen = node, []
        # A multiple of a period already followed gives the same stretch.
        if any(q % p == 0 and s <= a and b < e for s, e, p in seen):
            continue
        low, high = int(start[node]), int(end[node])
        begin = a - _matches(words, a - 1, b - 1, a - low, -1)
        stop = b + _matches(words, a, b, high - b, 1)
        if stop - begin >= max(LEAST_WORDS, LEAST_PERIODS * q):
            seen.append((begin, stop, q))
            found.append((int(number[node]), begin, stop, q))
    return tuple(np.array(part, np.int64) for part in zip(*found)) if found else tuple(
        np.empty(0, np.int64) for _ in range(4)
    )


def runs_of(texts: list[list]) -> list[list[Run]]:
    """The runs of each sequence of hashable words, by start and then period."""
    number: dict = {}
    numbered, lengths = [], []
    for words in texts:
        number = defaultdict(count(len(numbered)).__next__)  # words of different texts get different numbers
        numbered.extend(map(number.__getitem__, words))
        lengths.append(len(words))
    found: list[list[Run]] = [[] for _ in texts]
    words = np.array(numbered, np.int64)
    lengths = np.array(lengths, np.int64)
    # A text that is too short can hold no run; the others make the grammar.
    begins = np.cumsum(lengths) - lengths
    text_of = np.repeat(np.arange(len(texts)), lengths)
    long = lengths[text_of] >= LEAST_WORDS
    if not long.any():
        return found
    place = np.flatnonzero(long)
    words, text_of = words[long], text_of[long]
    derived = grammar(words, text_of)
    in_rule, start, end, period = crossing(words, text_of, derived.rules)
    # Every place of a symbol gets the runs that were found in it once.
    order = np.argsort(derived.of, kind="stable")
    of, at = derived.of[order], derived.at[order]
    first, last = np.searchsorted(of, in_rule, "left"), np.searchsorted(of, in_rule, "right")
    many = last - first
    run = np.repeat(np.arange(len(in_rule)), many)
    offset = np.arange(len(run)) - np.repeat(np.cumsum(many) - many, many)
    moved = at[np.repeat(first, many) + offset] - derived.rules.start[in_rule[run]]
    _, start_j, end_j, period_j = crossing(words, text_of, derived.joints)
    start = np.concatenate([start[run] + moved, start_j])
    end = np.concatenate([end[run] + moved, end_j])
    period = np.concatenate([period[run], period_j])
    for text, begin, length, q in _maximal(text_of, start, end, period):
        found[text].append((int(place[begin] - begins[text]), length, q))
    return found


def _maximal(text_of: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> list[tuple]:
    """text, start, length, period of those that no other of the text and period contains, by start, then period."""
    if not len(start):
        return []
    text = text_of[start]
    order = np.lexsort((-end, start, period, text))
    text, start, end, period = text[order], start[order], end[order], period[order]
    kept: dict[tuple[int, int, int], tuple[int, int]] = {}
    furthest, group = -1, None
    for t, q, s, e in zip(text.tolist(), period.tolist(), start.tolist(), end.tolist()):
        if group != (t, q):
            group, furthest = (t, q), -1
        if e > furthest:
            furthest = e
            # A multiple of a period covers the same stretch; the smallest one counts and comes first.
            kept.setdefault((t, s, e), (q, 0))
    return sorted((t, s, e - s, q) for (t, s, e), (q, _) in kept.items())


def best_run(runs: list[Run]) -> Run | None:
    """The run with the greatest exact length / period; ties go to the smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list, runs: list[Run]) -> list:
    """The words without those that some run contains after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [word for word, inside in zip(words, np.cumsum(change[:-1]).tolist()) if not inside]


def periodic_runs(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, runs (array of start, length, period, by start) and collapsed (text without repetitions).

    Words are joined by one space in ``collapsed``. A null, empty or wordless text has no runs and collapses to the empty
    string. Rows are independent: repeated rows come out each, null keys are kept, other columns are not read. Whole texts
    are read, however long; a task holds the words of a slice of texts, or of one text if that is longer.
    """

    def prepare() -> Callable[[list[str]], list]:
        def run(texts: list[str]) -> list:
            words = [words_of(t) for t in texts]
            runs = runs_of(words)
            flat = [[n for r in found for n in r] for found in runs]
            return [flat, [b" ".join(collapsed(w, r)).decode() for w, r in zip(words, runs)]]

        return run

    own = fresh("_flat", keep)
    found = map_texts(docs, text, keep, f"{own} array<long>, collapsed string", prepare, SLICE_BYTES)
    run = f"struct({own}[i] AS start, {own}[i + 1] AS length, {own}[i + 2] AS period)"
    places = f"CASE WHEN size({own}) > 0 THEN sequence(0, size({own}) - 3, 3) ELSE CAST(array() AS array<int>) END"
    return found.select(*[F.col(c) for c in keep], F.expr(f"transform({places}, i -> {run})").alias("runs"), "collapsed")


def run_digests(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """As ``periodic_runs``, told in a few columns: n_runs, start, length, period and exponent_milli of the run with the
    most periods (nulls without one), runs_sha256 and collapsed_sha256."""

    def prepare() -> Callable[[list[str]], list]:
        def run(texts: list[str]) -> list:
            words = [words_of(t) for t in texts]
            rows = []
            for of_text, runs in zip(words, runs_of(words)):
                best = best_run(runs)
                lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
                left = b" ".join(collapsed(of_text, runs))
                rows.append((
                    len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                    hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest(),
                ))
            return [list(column) for column in zip(*rows)]

        return run

    added = (
        "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
        "collapsed_sha256 string"
    )
    return map_texts(docs, text, keep, added, prepare, SLICE_BYTES)


def with_planted_runs(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key and text, with a periodic tail in the texts of every tenth hash of the key, as the query's contract has it.

    Others keep their text as it is, also rows whose key or text is null.
    """
    rows = docs.select(F.col(key), F.col(text), F.crc32(F.col(key).cast("string")).alias("_hash"))
    chosen = F.col("_hash") % 10 == 0
    words = F.filter(F.split(F.col(text), r"[ \t\n\x0B\f\r]+"), lambda word: word != "")
    split = rows.withColumn("_words", F.when(chosen, words))
    # The length stands in for that of wordless texts, so that nothing is divided by zero.
    n, g = F.greatest(F.size("_words"), F.lit(1)), F.floor(F.col("_hash") / 10)
    counted = split.withColumn("_a", F.pmod(g, n).cast("int"))
    placed = counted.withColumn("_p", (F.floor((n - F.col("_a")) / (g % 8 + 3)) + 1).cast("int"))
    a, p = F.col("_a"), F.col("_p")
    periodic = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("_words", F.when(i < a, i).otherwise(a + (i - a) % p)))
    edited = F.when(chosen & (F.size("_words") > 0), F.array_join(periodic, " ")).otherwise(F.col(text))
    return placed.select(F.col(key), edited.alias(text))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return run_digests(with_planted_runs(table(spark, folder, "documents", "doc_id", "text")))


QUERIES = {"op13_periodic_runs": op13_periodic_runs}
ORACLES: dict[str, str] = {}
