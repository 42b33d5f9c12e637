"""SQL for logistic regression: Newton steps in a recursive query, each solving its equations by elimination."""

from __future__ import annotations


def _solved(source: str, k: int, right: int, keep: str) -> str:
    """Solve k equations for ``right`` right-hand sides: columns h{i}_{j} (i <= j) and r{i}_{m} give d{i}_{m}."""

    def h(i: int, j: int) -> str:
        return f"h{min(i, j)}_{max(i, j)}"

    for p in range(k - 1):
        rest = range(p + 1, k)
        kept = [h(i, j) for i in range(p + 1) for j in range(i, k)] + [f"r{i}_{m}" for i in range(p + 1) for m in range(right)]
        less = [f"{h(i, j)} - {h(p, i)} * {h(p, j)} / {h(p, p)} AS {h(i, j)}" for i in rest for j in rest if i <= j]
        less += [f"r{i}_{m} - {h(p, i)} * r{p}_{m} / {h(p, p)} AS r{i}_{m}" for i in rest for m in range(right)]
        source = f"SELECT {keep}, {', '.join([*kept, *less])} FROM ({source})"
    for i in reversed(range(k)):
        new = [
            f"(r{i}_{m}{''.join(f' - {h(i, j)} * d{j}_{m}' for j in range(i + 1, k))}) / {h(i, i)} AS d{i}_{m}" for m in range(right)
        ]
        source = f"SELECT *, {', '.join(new)} FROM ({source})"
    return source


def newton(rows: str, features: list[str], steps: int = 15) -> str:
    """``fit`` has term, coefficient and std_error for ``rows``, which select the features and y (0 or 1)."""
    k = len(features) + 1
    terms = [*features, "intercept"]
    scaled = ", ".join(f"({f} - avg({f}) OVER ()) / stddev_pop({f}) OVER () AS x{i}" for i, f in enumerate(features))
    b = [f"b{i}" for i in range(k)]
    listed = ", ".join(b)
    score = " + ".join(f"b{i} * x{i}" for i in range(k))
    second = [f"sum(p * (1 - p) * x{i} * x{j}) AS h{i}_{j}" for i in range(k) for j in range(i, k)]
    first = [f"sum((y - p) * x{i}) AS r{i}_0" for i in range(k)]
    unit = [f"{'1e0' if i == m else '0e0'} AS r{i}_{m}" for i in range(k) for m in range(k)]
    summed = f"""SELECT step, {listed}, {{}} FROM (
        SELECT step, {listed}, x.*, 1 / (1 + exp(-({score}))) AS p FROM newton, scaled x {{}}) GROUP BY step, {listed}"""
    moved = _solved(summed.format(", ".join([*second, *first]), f"WHERE step < {steps}"), k, 1, f"step, {listed}")
    inverse = _solved(summed.format(", ".join([*second, *unit]), f"WHERE step = {steps}"), k, k, f"step, {listed}")
    means = ", ".join(f"avg({f}) AS m{i}, stddev_pop({f}) AS s{i}" for i, f in enumerate(features))
    n = k - 1
    intercept = f"b{n}" + "".join(f" - b{i} * m{i} / s{i}" for i in range(n))
    # Variance of b_n - sum of b_i m_i / s_i.
    factor = [f"(-m{i} / s{i})" for i in range(n)] + ["1e0"]
    variance = " + ".join(f"{factor[i]} * {factor[j]} * d{i}_{j}" for i in range(k) for j in range(k))
    each = [f"SELECT '{t}' AS term, b{i} / s{i} AS coefficient, sqrt(d{i}_{i}) / s{i} AS std_error FROM told" for i, t in enumerate(terms[:-1])]
    each.append(f"SELECT 'intercept', {intercept}, sqrt({variance}) FROM told")
    return f"""
    WITH RECURSIVE raw AS ({rows}),
    scaled AS (SELECT {scaled}, 1e0 AS x{n}, y FROM raw),
    newton AS (
        SELECT 0 AS step, {", ".join(f"0e0 AS {name}" for name in b)}
        UNION ALL
        SELECT step + 1, {", ".join(f"b{i} + d{i}_0" for i in range(k))} FROM ({moved})),
    told AS (SELECT * FROM ({inverse}), (SELECT {means} FROM raw)),
    fit AS ({" UNION ALL ".join(each)})
    """
