"""SQL text for what SQL lacks: Newton's logistic fit, the normal tail, and greedy matching. Used by oracles only."""

from __future__ import annotations

from collections.abc import Sequence


def newton_sql(name: str, rows: str, keys: Sequence[str], p: int, ridge: float = 0.0, weight: str = "1", steps: int = 25, small: float = 1e-6) -> str:
    """CTE ``name``: keys, n, b0 … b{p-1}, schur (information of the last coefficient), ok.

    ``rows`` has the keys, x0 … x{p-1} and y. A step solves the normal equations by elimination, one nested query
    for each pivot. ``ridge`` penalises all coefficients but b0.
    """
    k = "".join(f"{c}, " for c in keys)
    on = " AND ".join(f"r.{c} IS NOT DISTINCT FROM i.{c}" for c in keys) or "TRUE"
    ks = "".join(f"i.{c}, " for c in keys)
    bs = ", ".join(f"b{i}" for i in range(p))
    eta = " + ".join(f"i.b{j} * r.x{j}" for j in range(p))
    prob = f"(1 / (1 + exp(-LEAST(40, GREATEST(-40, {eta})))))"
    cells = [(i, j) for i in range(p) for j in range(i, p)]
    penalty = lambda i, j: f" + {ridge!r}" if ridge and i == j and i else ""
    pull = lambda i: f" - {ridge!r} * MAX(i.b{i})" if ridge and i else ""
    sums = ", ".join(f"SUM(w * q * (1 - q) * x{i} * x{j}){penalty(i, j)} AS a{i}_{j}" for i, j in cells)
    grads = ", ".join(f"SUM(w * (y - q) * x{i}){pull(i).replace('i.b', 'b')} AS g{i}" for i in range(p))
    inner = f"SELECT {k}step, n, {bs}, {sums}, {grads} FROM (SELECT {ks}i.step, i.n, {', '.join(f'i.b{j}' for j in range(p))}, r.y, {', '.join(f'r.x{j}' for j in range(p))}, r.w, {prob} AS q FROM {name}_it i JOIN {rows}_w r ON {on} WHERE i.step < {steps} AND i.size >= {small}) GROUP BY {k}step, n, {bs}"
    for c in range(p - 1):
        # eliminate column c from the rows below it
        keep = ", ".join([f"a{i}_{j}" for i, j in cells if i <= c] + [f"g{i}" for i in range(c + 1)])
        below = ", ".join(
            [f"a{i}_{j} - a{c}_{i} * a{c}_{j} / NULLIF(a{c}_{c}, 0) AS a{i}_{j}" for i, j in cells if i > c]
            + [f"g{i} - a{c}_{i} * g{c} / NULLIF(a{c}_{c}, 0) AS g{i}" for i in range(c + 1, p)]
        )
        inner = f"SELECT {k}step, n, {bs}, {keep}, {below} FROM ({inner})"
    for c in range(p - 1, -1, -1):
        # back substitution
        rest = "".join(f" - a{c}_{j} * d{j}" for j in range(c + 1, p))
        inner = f"SELECT *, (g{c}{rest}) / NULLIF(a{c}_{c}, 0) AS d{c} FROM ({inner})"
    size = "GREATEST(" + ", ".join(f"abs(d{i})" for i in range(p)) + ", 0)"
    moved = ", ".join(f"b{i} + d{i}" for i in range(p))
    w = f"{rows}_w AS (SELECT *, {weight} AS w FROM {rows})"
    return f"""
, {w},
{name}_it({k}step, n, {bs}, size, schur) AS (
  SELECT {k}0, COUNT(*), {', '.join('0.0::DOUBLE' for _ in range(p))}, 1e9::DOUBLE, NULL::DOUBLE FROM {rows}_w{f" GROUP BY {', '.join(keys)}" if keys else ''}
  UNION ALL
  SELECT {k}step + 1, n, {moved}, {size}, a{p - 1}_{p - 1} FROM ({inner}) WHERE {' AND '.join(f'isfinite(d{i})' for i in range(p))}
),
{name} AS (SELECT {k}n, {bs}, schur, size < {small} AND isfinite(schur) AND schur > 0 AS ok FROM {name}_it QUALIFY ROW_NUMBER() OVER ({f"PARTITION BY {', '.join(keys)} " if keys else ''}ORDER BY step DESC) = 1)
"""


def tail_sql(z: str) -> str:
    """Two-sided normal p of |z|: a series of positive terms near zero, a continued fraction in the tail."""
    x = f"GREATEST(abs({z}) / sqrt(2.0::DOUBLE), 1e-300)"
    series = f"list_sum(list_transform(range(120), lambda k: exp(2 * k * ln(2.0::DOUBLE) + (2 * k + 1) * ln({x}) - lgamma(2 * k + 2) + lgamma(k + 1))))"
    near = f"(1 - 2 / sqrt(pi()) * exp(-{x} * {x}) * {series})"
    # 1 / (x + (1/2) / (x + 1 / (x + (3/2) / …))), from the inside out
    chain = f"list_reduce(list_prepend({x}, list_transform(range(100, 0, -1), lambda k: k / 2.0::DOUBLE)), lambda t, c: {x} + c / t)"
    far = f"(exp(-{x} * {x}) / sqrt(pi()) / {chain})"
    return f"(CASE WHEN {z} IS NULL THEN NULL WHEN {x} < 3 THEN {near} ELSE {far} END)"


def greedy_sql(ratio: int) -> str:
    """CTE ``pair`` (case_id, control_id, match_rank, age): sequential greedy within a stratum.

    ``cand`` lists every admissible (stratum, case_id, case_rank, control_id, gap, dist, age). A step serves the next
    case of each stratum from the controls not used so far.
    """
    return f"""
, srt AS (SELECT stratum, case_id, case_rank, list({{'gap': gap, 'dist': dist, 'id': control_id, 'age': age}} ORDER BY gap, dist, control_id) AS c FROM cand GROUP BY ALL),
srn AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY stratum ORDER BY case_rank) AS turn FROM srt),
gre(stratum, turn, case_id, got, used) AS (
  SELECT DISTINCT stratum, 0::BIGINT, NULL::VARCHAR, [{{'gap': 0.0::DOUBLE, 'dist': 0.0::DOUBLE, 'id': '', 'age': 0.0::DOUBLE}}][2:], [''] FROM srn
  UNION ALL
  SELECT stratum, turn, case_id, got, list_concat(used, list_transform(got, lambda x: x.id)) FROM (
    SELECT s.stratum, s.turn, s.case_id, list_filter(s.c, lambda x: NOT list_contains(g.used, x.id))[1:{ratio}] AS got, g.used
    FROM gre g JOIN srn s ON s.stratum = g.stratum AND s.turn = g.turn + 1)
),
pair AS (SELECT case_id, UNNEST(got).id AS control_id, UNNEST(range(1, len(got) + 1)) AS match_rank, UNNEST(got).age AS age FROM gre WHERE len(got) > 0)
"""


def model_sql(name: str, source: str, train: str, numbers: Sequence[str], flags: Sequence[str] = (), levels: Sequence[tuple[str, str]] = (), ridge: float = 1.0) -> str:
    """CTE ``name``_p: every row of ``source`` with its encoded features and ``score``, by a ridge fit of the rows where ``train`` holds.

    ``numbers`` are imputed, centred and scaled, ``flags`` are 1 from 1 on, ``levels`` are (column, category). A feature
    that is constant in train gets the weight 0, as if it were left out. ``name``_t has the Youden threshold of train.
    """
    m = ", ".join(f"quantile_cont({c}, 0.5) FILTER ({train}) AS m{i}" for i, c in enumerate(numbers))
    st = ", ".join(f"AVG(COALESCE({c}, m{i})) FILTER ({train}) AS a{i}, stddev_pop(COALESCE({c}, m{i})) FILTER ({train}) AS s{i}" for i, c in enumerate(numbers))
    xs = ["1.0::DOUBLE"] + [f"COALESCE((COALESCE({c}, m{i}) - a{i}) / NULLIF(s{i}, 0), 0)::DOUBLE" for i, c in enumerate(numbers)]
    xs += [f"(COALESCE({c}, 0) >= 1)::INT::DOUBLE" for c in flags] + [f"({c} = '{v}')::INT::DOUBLE" for c, v in levels]
    n = len(xs)
    eta = " + ".join(f"b{i} * x{i}" for i in range(n))
    return (
        f", {name}_m AS (SELECT {m} FROM {source}), {name}_s AS (SELECT {st} FROM {source}, {name}_m),\n"
        f"{name}_e AS (SELECT {source}.*, {', '.join(f'{x} AS x{i}' for i, x in enumerate(xs))} FROM {source}, {name}_m, {name}_s),\n"
        f"{name}_r AS (SELECT y, {', '.join(f'x{i}' for i in range(n))} FROM {name}_e WHERE {train})"
        + newton_sql(f"{name}_f", f"{name}_r", [], n, ridge, small=1e-9)
        + f", {name}_p AS (SELECT {name}_e.*, 1 / (1 + exp(-LEAST(40, GREATEST(-40, {eta})))) AS score FROM {name}_e, {name}_f),\n"
        f"{name}_c AS (SELECT score, SUM(SUM(y)) OVER w AS tp, SUM(SUM(1 - y)) OVER w AS fp FROM {name}_p WHERE {train} GROUP BY score WINDOW w AS (ORDER BY score DESC)),\n"
        f"{name}_t AS (SELECT score AS cut FROM {name}_c, (SELECT MAX(tp) AS p, MAX(fp) AS n FROM {name}_c) ORDER BY CAST(tp AS DOUBLE) / p - CAST(fp AS DOUBLE) / n DESC, score DESC LIMIT 1)\n"
    )


def metrics_sql(name: str, source: str, group: str, cut: str) -> str:
    """CTE ``name``: the full metric row of each ``group`` from (y, score, person_id), confusion at ``cut``."""
    clip = "GREATEST(1e-12, LEAST(1 - 1e-12, score))"
    return f"""
, {name}_k AS (SELECT {group} AS grp, person_id, y, score, score >= {cut} AS hit, (RANK() OVER (PARTITION BY {group} ORDER BY score) - RANK() OVER (PARTITION BY {group} ORDER BY score DESC)
    + COUNT(*) OVER (PARTITION BY {group}) + 1) / 2.0::DOUBLE AS avg_rank, ROW_NUMBER() OVER w AS pos, SUM(y) OVER w AS seen FROM {source}
  WINDOW w AS (PARTITION BY {group} ORDER BY score DESC, person_id ROWS UNBOUNDED PRECEDING)),
{name} AS (SELECT grp, COUNT(*) AS n, SUM(y) AS cases, SUM(1 - y) AS controls, (SUM(avg_rank * y) - SUM(y) * (SUM(y) + 1) / 2.0::DOUBLE) / NULLIF(SUM(y) * SUM(1 - y), 0) AS roc_auc,
  SUM(CASE WHEN y = 1 THEN CAST(seen AS DOUBLE) / pos END) / NULLIF(SUM(y), 0) AS average_precision, CAST(SUM(y) AS DOUBLE) / COUNT(*) AS prevalence,
  AVG((score - y) * (score - y)) AS brier_score, AVG(-(y * ln({clip}) + (1 - y) * ln(1 - {clip}))) AS log_loss,
  COUNT(*) FILTER (hit AND y = 1) AS tp, COUNT(*) FILTER (hit AND y = 0) AS fp, COUNT(*) FILTER (NOT hit AND y = 0) AS tn, COUNT(*) FILTER (NOT hit AND y = 1) AS fn FROM {name}_k GROUP BY 1)
"""


#: The select list of a metric row, but its group.
METRIC_ROW = """n, cases, controls, ROUND(roc_auc, 4) AS roc_auc, ROUND(average_precision, 4) AS average_precision, ROUND(prevalence, 4) AS prevalence, ROUND(brier_score, 4) AS brier_score,
  ROUND(log_loss, 4) AS log_loss, tp, fp, tn, fn, ROUND(tp / NULLIF(tp + fn, 0)::DOUBLE, 4) AS sensitivity, ROUND(tn / NULLIF(tn + fp, 0)::DOUBLE, 4) AS specificity,
  ROUND(tp / NULLIF(tp + fp, 0)::DOUBLE, 4) AS ppv, ROUND(tn / NULLIF(tn + fn, 0)::DOUBLE, 4) AS npv, ROUND((tp + tn) / NULLIF(n, 0)::DOUBLE, 4) AS accuracy"""


def student_sql(t: str, df: str) -> str:
    """Two-sided Student p: the incomplete beta function by its continued fraction, from the inside out."""

    def fraction(a: str, b: str, x: str) -> str:
        odd = f"-({a} + (k - 1) / 2.0) * ({a} + {b} + (k - 1) / 2.0) * {x} / (({a} + k - 1) * ({a} + k))"
        even = f"(k / 2.0) * ({b} - k / 2.0) * {x} / (({a} + k - 1) * ({a} + k))"
        terms = "list_transform(range(300, 0, -1), lambda k: k::DOUBLE)"
        return f"(1 / list_reduce(list_prepend(1.0::DOUBLE, {terms}), lambda f, k: 1 + (CASE WHEN k % 2 = 1 THEN {odd} ELSE {even} END) / f))"

    x, a = f"({df} / ({df} + {t} * {t}))", f"({df} / 2.0::DOUBLE)"
    front = f"exp(lgamma({a} + 0.5) - lgamma({a}) - lgamma(0.5::DOUBLE) + {a} * ln({x}) + 0.5 * ln(1 - {x}))"
    low = f"{front} * {fraction(a, '0.5::DOUBLE', x)} / {a}"
    high = f"(1 - {front} * {fraction('0.5::DOUBLE', a, f'(1 - {x})')} / 0.5)"
    return f"(CASE WHEN {t} IS NULL OR {df} IS NULL THEN NULL WHEN {t} = 0 THEN 1.0 WHEN {x} < ({a} + 1) / ({a} + 2.5) THEN {low} ELSE {high} END)"


def critical_sql(df: str) -> str:
    """Student's 97.5 % point by its expansion around the normal one, which ``nearer_sql`` refines."""
    z = 1.959963984540054
    c = [(z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96, (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384, (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160]
    return f"({z!r}::DOUBLE" + "".join(f" + {k!r}::DOUBLE / pow({df}, {i})" for i, k in enumerate(c, start=1)) + ")"


def nearer_sql(t: str, df: str) -> str:
    """A Newton step from ``t`` to the point whose two-sided p is 5 %."""
    density = f"(exp(lgamma(({df} + 1) / 2) - lgamma({df} / 2)) / sqrt({df} * pi()) * pow(1 + {t} * {t} / {df}, -({df} + 1) / 2))"
    return f"({t} + ({student_sql(t, df)} - 0.05) / (2 * {density}))"


def two_group_sql(source: str, by: str, group: str, continuous: Sequence[str], binary: Sequence[str], categorical: Sequence[str], fisher, null_as_zero: bool = False) -> str:
    """CTE ``tg``: the two-group table of ``source``, group 1 against 0, for each ``by``."""
    n = f"COUNT(x) FILTER (g) AS n1, COUNT(x) FILTER (NOT g) AS n0, AVG(x) FILTER (g) AS m1, AVG(x) FILTER (NOT g) AS m0, COALESCE(var_samp(x) FILTER (g), 0) AS v1, COALESCE(var_samp(x) FILTER (NOT g), 0) AS v0, COALESCE(SUM(x) FILTER (g), 0) AS k1, COALESCE(SUM(x) FILTER (NOT g), 0) AS k0"
    flag = lambda c: f"(COALESCE({c}, 0) >= 1)" if null_as_zero else f"({c} >= 1)"
    long = [f"SELECT {by}, {group} = 1 AS g, 'continuous' AS kind, '{c}' AS variable, '' AS level, {c}::DOUBLE AS x FROM {source}" for c in continuous]
    long += [f"SELECT {by}, {group} = 1, 'binary', '{c}', 'yes', {flag(c)}::INT::DOUBLE FROM {source}" for c in binary]
    long += [f"SELECT {by}, {group} = 1, 'categorical', '{c}', {c}, 1.0::DOUBLE FROM {source}" for c in categorical]
    return (
        f", tl AS ({' UNION ALL '.join(long)}), tm AS (SELECT {by}, kind, variable, level, {n} FROM tl WHERE x IS NOT NULL GROUP BY ALL),\\n".replace("\\n", "\n")
        + f"""tn AS (SELECT * EXCLUDE (n1, n0), CASE WHEN kind = 'categorical' THEN SUM(n1) OVER w ELSE n1 END::DOUBLE AS n1, CASE WHEN kind = 'categorical' THEN SUM(n0) OVER w ELSE n0 END::DOUBLE AS n0
  FROM tm WINDOW w AS (PARTITION BY {by}, variable)),
tk AS (SELECT *, {by} || '|' || variable || '|' || level AS id, k1 AS ca, n1 - k1 AS cb, k0 AS cc, n0 - k0 AS cd, k1 / NULLIF(n1, 0) AS p1, k0 / NULLIF(n0, 0) AS p0, v1 / NULLIF(n1, 0) AS e1, v0 / NULLIF(n0, 0) AS e0 FROM tn),
ts AS (SELECT id, ca::BIGINT AS a, cb::BIGINT AS b, cc::BIGINT AS c, cd::BIGINT AS d FROM tk WHERE kind <> 'continuous' AND LEAST(ca, cb, cc, cd) < 5)
"""
        + fisher("ts")
        + f""", te AS (SELECT tk.*, fish.p AS fp, CASE WHEN LEAST(ca, cb, cc, cd) = 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS fx, sqrt(e1 + e0) AS se, sqrt((v1 + v0) / 2) AS pooled, sqrt((p1 * (1 - p1) + p0 * (1 - p0)) / 2) AS spread,
  (e1 + e0) * (e1 + e0) / NULLIF(e1 * e1 / NULLIF(n1 - 1, 0) + e0 * e0 / NULLIF(n0 - 1, 0), 0) AS df,
  sqrt((n1 + n0) * (ca * cd - cb * cc) * (ca * cd - cb * cc) / NULLIF(n1 * n0 * (ca + cc) * (cb + cd), 0)) AS chi FROM tk LEFT JOIN fish USING (id)),
tx AS (SELECT *, {critical_sql('df')} AS t0 FROM te), ty AS (SELECT *, {nearer_sql('t0', 'df')} AS t1 FROM tx), tz AS (SELECT *, {nearer_sql('t1', 'df')} AS t2 FROM ty), tw AS (SELECT *, {nearer_sql('t2', 'df')} AS crit FROM tz),
tf AS (SELECT *, CASE WHEN kind = 'continuous' THEN CASE WHEN n1 >= 2 AND n0 >= 2 THEN m1 - m0 END WHEN ca + cc > 0 AND n1 > 0 AND n0 > 0 THEN (ca + fx) * (cd + fx) / NULLIF((cb + fx) * (cc + fx), 0) END AS effect,
  sqrt(1 / NULLIF(ca + fx, 0) + 1 / NULLIF(cb + fx, 0) + 1 / NULLIF(cc + fx, 0) + 1 / NULLIF(cd + fx, 0)) AS ose, (m1 - m0) / NULLIF(se, 0) AS t FROM tw),
tg AS (SELECT {by}, kind, variable, level, n1::BIGINT AS n1, n0::BIGINT AS n0, CASE WHEN kind <> 'continuous' THEN k1::BIGINT END AS count1, CASE WHEN kind <> 'continuous' THEN k0::BIGINT END AS count0,
  CASE WHEN kind = 'continuous' THEN m1 END AS mean1, CASE WHEN kind = 'continuous' THEN m0 END AS mean0, sqrt(v1) AS sd1, sqrt(v0) AS sd0, effect,
  CASE WHEN kind = 'continuous' THEN effect - CASE WHEN se > 0 THEN crit * se ELSE 0 END ELSE exp(ln(effect) - 1.96 * ose) END AS ci_low,
  CASE WHEN kind = 'continuous' THEN effect + CASE WHEN se > 0 THEN crit * se ELSE 0 END ELSE exp(ln(effect) + 1.96 * ose) END AS ci_high,
  CASE WHEN n1 > 0 AND n0 > 0 THEN CASE WHEN kind = 'continuous' THEN CASE WHEN pooled = 0 THEN 0 ELSE (m1 - m0) / pooled END WHEN spread = 0 THEN 0 ELSE (p1 - p0) / spread END END AS smd,
  CASE WHEN kind = 'continuous' THEN {student_sql('t', 'df')} WHEN ca + cc = 0 OR n1 = 0 OR n0 = 0 THEN NULL WHEN fp IS NOT NULL THEN fp ELSE {tail_sql('chi')} END AS p_value FROM tf)
"""
    )


def formatted_sql(by: str, where: str = "TRUE") -> str:
    """The display text of ``tg``."""
    effect = lambda v: f"CASE WHEN {v} IS NULL THEN '' WHEN abs({v}) >= 100 OR (abs({v}) < 0.01 AND {v} <> 0) THEN printf('%.2e', {v}) ELSE printf('%.3f', ROUND({v}, 3)) END"
    cell = lambda i: f"CASE WHEN kind = 'continuous' THEN CASE WHEN mean{i} IS NULL THEN '' ELSE printf('%.1f (%.1f)', ROUND(mean{i}, 1), ROUND(sd{i}, 1)) END WHEN n{i} > 0 THEN printf('%d (%.1f%%)', count{i}, ROUND(count{i} * 100.0::DOUBLE / n{i}, 1)) ELSE '' END"
    return f"""SELECT {by}, variable, level, {cell(1)} AS cases, {cell(0)} AS controls, CASE WHEN kind = 'continuous' THEN 'mean_difference' ELSE 'odds_ratio' END AS effect_measure, {effect('effect')} AS effect_size,
  CASE WHEN ci_low IS NULL OR ci_high IS NULL THEN '' ELSE {effect('ci_low')} || ', ' || {effect('ci_high')} END AS ci_95, CASE WHEN smd IS NULL THEN '' ELSE printf('%.3f', ROUND(smd, 3)) END AS smd,
  CASE WHEN p_value IS NULL THEN '' WHEN p_value < 1e-4 THEN printf('%.2e', p_value) ELSE printf('%.4f', ROUND(p_value, 4)) END AS p_value FROM tg WHERE {where}"""
