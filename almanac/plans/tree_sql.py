"""SQL that grows a small tree level by level, to check the library's own trees against."""

from __future__ import annotations


def grown(rows: str, features: list[str], depth: int, carry: tuple[str, ...] = ()) -> str:
    """Common table expressions that grow a tree on ``rows`` for each value of ``g``.

    ``rows`` selects g, train (boolean), y, the features and columns to carry. ``rows_d`` has every row with its node after ``d`` levels (the
    root is 1, the sides of n are 2n and 2n + 1), ``best_d`` the split of each node of the level: feature (numbered from
    0), x and gain, by how much the squared deviations from the mean fall. A node whose label varies no more with any
    feature stays. Where the label is 0 or 1, the Gini impurity falls by twice as much.
    """
    listed = ", ".join([*features, *carry])
    parts = [f"rows_0 AS (SELECT g, train, y, {listed}, 1 AS node FROM ({rows}))"]
    for level in range(depth):
        values = " UNION ALL ".join(
            f"SELECT g, node, {i} AS feature, {name} AS x, count(*) AS n, sum(y) AS s FROM rows_{level} "
            f"WHERE train AND node >= {2**level} GROUP BY ALL"
            for i, name in enumerate(features)
        )
        moved = " ".join(f"WHEN {i} THEN r.{name} <= b.x" for i, name in enumerate(features))
        parts.append(f"""
        sides_{level} AS (
            SELECT g, node, feature, x, sum(n) OVER w AS n1, sum(s) OVER w AS s1,
                   sum(n) OVER (PARTITION BY g, node, feature) AS nt, sum(s) OVER (PARTITION BY g, node, feature) AS st
            FROM ({values}) WINDOW w AS (PARTITION BY g, node, feature ORDER BY x)),
        best_{level} AS (
            SELECT g, node, feature, x, gain FROM (
                SELECT *, s1 * s1 / n1 + (st - s1) * (st - s1) / (nt - n1) - st * st / nt AS gain
                FROM sides_{level} WHERE n1 < nt)
            WHERE gain > 1e-9 QUALIFY row_number() OVER (PARTITION BY g, node ORDER BY gain DESC, feature, x) = 1),
        rows_{level + 1} AS (
            SELECT r.* EXCLUDE (node),
                   CASE WHEN b.x IS NULL THEN r.node WHEN CASE b.feature {moved} END THEN 2 * r.node ELSE 2 * r.node + 1 END AS node
            FROM rows_{level} r LEFT JOIN best_{level} b ON r.g = b.g AND r.node = b.node)""")
    means = f"leaves AS (SELECT g, node, avg(y) AS mean FROM rows_{depth} WHERE train GROUP BY g, node)"
    return "WITH " + ",\n        ".join([*parts, means])


def pruned(depth: int) -> str:
    """More expressions, for a classifier, which undoes splits below which all leaves say the same class.

    ``ends`` gives every leaf the node that it is part of in the end, ``means`` the mean label of those nodes.
    """
    return f""",
        above AS (
            SELECT g, node, mean, unnest(range(0, {depth + 1})) AS k, node >> k AS anc FROM leaves),
        same AS (
            SELECT g, anc FROM above WHERE anc >= 1 GROUP BY g, anc HAVING bool_and(mean > 0.5) OR bool_and(mean <= 0.5)),
        ends AS (SELECT a.g, a.node, min(a.anc) AS upper FROM above a JOIN same s ON a.g = s.g AND a.anc = s.anc GROUP BY ALL),
        means AS (
            SELECT r.g, e.upper, avg(y) AS mean FROM rows_{depth} r JOIN ends e ON r.g = e.g AND r.node = e.node
            WHERE train GROUP BY ALL)"""


def splits(depth: int) -> str:
    """All splits of a grown tree: g, node, feature, gain."""
    return " UNION ALL ".join(f"SELECT g, node, feature, gain FROM best_{level}" for level in range(depth))
