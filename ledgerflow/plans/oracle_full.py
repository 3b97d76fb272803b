"""The full forecast model as SQL: design columns from the calendar, Gram matrices from a join, elimination in a recursion."""

from ledgerflow.config import ModelConfig
from ledgerflow.operators.forecast import FIXED_HOLIDAYS
from ledgerflow.plans.oracle_derived import Z80


def _easter(year: str) -> str:
    """Easter Sunday's date, by the anonymous Gregorian rule, of an integer expression."""
    a, b, c = f"({year} % 19)", f"({year} // 100)", f"({year} % 100)"
    h = f"((19 * {a} + {b} - {b} // 4 - ({b} - ({b} + 8) // 25 + 1) // 3 + 15) % 30)"
    w = f"((32 + 2 * ({b} % 4) + 2 * ({c} // 4) - {h} - {c} % 4) % 7)"
    days = f"({h} + {w} - 7 * (({a} + 11 * {h} + 22 * {w}) // 451) + 114)"
    return f"make_date({year}, {days} // 31, {days} % 31 + 1)"


def _fourier(period: float, order: int) -> list[str]:
    angle = f"(date_diff('day', DATE '1970-01-01', ds) * {6.283185307179586 / period!r})"
    return [f"{f}({angle} * {k})" for k in range(1, order + 1) for f in ("sin", "cos")]


def _solve(name: str, part: str, size: int, penalties: str, source: str) -> dict[str, str]:
    """CTEs that solve a ridge system per group: ``source`` has the group, a list ``z`` (columns, then the target)."""
    group = f"{part}, " if part else ""
    own = f"x.{part} IS NOT DISTINCT FROM p.{part}" if part else "TRUE"
    return {
        f"{name}_cells": f"SELECT {group}i, j, sum(z[i] * z[j]) AS s FROM {source}, (SELECT unnest(range(1, {size + 1})) AS i) r, (SELECT unnest(range(1, {size + 2})) AS j) q GROUP BY {group}i, j",
        f"{name}_lines": f"SELECT {'x.' + part + ', ' if part else ''}i, list(s + CASE WHEN i = j THEN 1e-9 + {penalties} ELSE 0.0 END ORDER BY j) AS line FROM {name}_cells x JOIN penalty_{name} p ON {own} GROUP BY {'x.' + part + ', ' if part else ''}i",
        f"{name}_system": f"SELECT {group}list(line ORDER BY i) AS m FROM {name}_lines {'GROUP BY ' + part if part else ''}",
        f"{name}_steps": (
            f"SELECT * FROM (WITH RECURSIVE step AS (SELECT {group}0 AS k, m FROM {name}_system UNION ALL SELECT {group}k + 1, "
            f"list_transform(m, lambda line, i: CASE WHEN i = k + 1 THEN list_transform(line, lambda v: v / line[k + 1]) "
            f"ELSE list_transform(line, lambda v, j: v - line[k + 1] * m[k + 1][j] / m[k + 1][k + 1]) END) FROM step WHERE k < {size}) SELECT * FROM step WHERE k = {size}) t"
        ),
        f"{name}_w": f"SELECT {group}list_transform(m, lambda line: line[{size + 1}]) AS w FROM {name}_steps",
    }


def full_model(history: str, config: ModelConfig, part: str = "", prefix: str = "full", days: str | None = None, given: str | None = None, regressors: tuple[str, ...] | list[str] = ()) -> dict[str, str]:
    """CTEs up to ``<prefix>_ahead`` (``part``, the forecast columns): fit on ``history`` (part, ds, y), predicted for its days and the horizon.

    ``days`` names a relation of (part, ds) to predict instead; ``given`` one of (ds, the regressors).
    """
    lead = f"{part}, " if part else ""
    by = f"GROUP BY {part}" if part else ""
    on = lambda a, b: f"{a}.{part} = {b}.{part}" if part else "TRUE"
    q = lambda t: f"{t}.{part}, " if part else ""
    n_trend = 2 + config.changepoints
    wide = (2 * config.yearly_order, 2 * config.weekly_order, len(FIXED_HOLIDAYS) + 1 + 2 * config.monthly_order + len(regressors))
    size = sum(wide)
    tau = "(date_diff('day', origin, ds) / greatest(span, 1.0))"
    bends = [f"greatest({tau} - {config.changepoint_range * (i + 1) / (config.changepoints + 1)!r}, 0.0)" for i in range(config.changepoints)]
    trend = ", ".join(["1.0::DOUBLE", tau, *bends])
    holidays = [f"CAST(month(ds) = {m} AND day(ds) = {d} AS INT)::DOUBLE" for m, d in FIXED_HOLIDAYS.values()] + [f"CAST(ds = {_easter('year(ds)')} - 2 AS INT)::DOUBLE"]
    season = ", ".join([*_fourier(365.25, config.yearly_order), *_fourier(7.0, config.weekly_order), *holidays, *_fourier(30.5, config.monthly_order), *[f"coalesce({r} - m_{r}, 0.0) / s_{r}" for r in regressors]])
    held = "".join(f", {r}, m_{r}, s_{r}" for r in regressors)
    figures = "".join(f", coalesce(avg(g.{r}), 0.0) AS m_{r}, CASE WHEN stddev_pop(g.{r}) > 1e-12 THEN stddev_pop(g.{r}) ELSE 1.0 END AS s_{r}" for r in regressors)
    beside = lambda t: f" LEFT JOIN {given} g ON g.ds = {t}.ds" if regressors else ""
    known = "".join(f", g.{r}" for r in regressors)
    moved = "".join(f", m_{r}, s_{r}" for r in regressors)
    spread = "".join(f", b.m_{r}, b.s_{r}" for r in regressors)
    dot = lambda x, w: f"list_sum(list_transform({x}, lambda v, k: v * {w}[k]))"
    p = prefix
    out = {
        f"{p}_b": f"SELECT {lead}min(h.ds) AS origin, max(h.ds) AS last_day, count(*) AS n, CAST(date_diff('day', min(h.ds), max(h.ds)) AS DOUBLE) AS span, greatest(max(abs(CAST(y AS DOUBLE))), 1e-12) AS sc{figures} FROM {history} h{beside('h')} {by}",
        f"{p}_d": f"SELECT {q('h')}h.ds, CAST(h.y AS DOUBLE) AS y, b.origin, b.span, b.sc{known}{spread} FROM {history} h JOIN {p}_b b ON {on('h', 'b')}{beside('h')}",
        f"{p}_z": f"SELECT {lead}ds, y, sc{held}, [{trend}] AS x, [{trend}, y / sc] AS z FROM {p}_d",
        f"penalty_{p}_t": f"SELECT {lead}greatest(regr_syy(y / sc, x[2]) - coalesce(regr_slope(y / sc, x[2]) ** 2 * regr_sxx(y / sc, x[2]), 0.0), 0.0) / count(*) / {config.changepoint_prior_scale ** 2!r} AS pen FROM {p}_z {by}",
    }
    out |= _solve(f"{p}_t", part, n_trend, "CASE WHEN i > 2 THEN pen ELSE 0.0 END", f"{p}_z")
    out |= {
        f"{p}_r": f"SELECT * FROM (SELECT {q('z')}z.ds, z.y, z.sc{held}, {dot('z.x', 't.w')} * z.sc AS trend FROM {p}_z z JOIN {p}_t_w t ON {on('z', 't')}) a",
        f"{p}_s": f"SELECT {lead}ds, y, trend, y / trend - 1 AS rel, [{season}, y / trend - 1] AS z FROM {p}_r WHERE abs(trend) > 1e-9 * sc",
        f"penalty_{p}_u": f"SELECT {lead}var_pop(rel) AS pen FROM {p}_s {by}",
    }
    prior = f"pen / CASE WHEN i > {wide[0] + wide[1]} THEN {config.holidays_prior_scale ** 2!r} ELSE {config.seasonality_prior_scale ** 2!r} END"
    out |= _solve(f"{p}_u", part, size, prior, f"{p}_s")
    out |= {
        f"{p}_e": f"SELECT {q('s')}coalesce(stddev_samp(s.y - s.trend * (1 + {dot(f'list_slice(s.z, 1, {size})', 'u.w')})), 0.0) AS sigma FROM {p}_s s JOIN {p}_u_w u ON {on('s', 'u')} {'GROUP BY s.' + part if part else ''}",
        f"{p}_m": f"SELECT {q('b')}b.origin, b.last_day, b.span, list_transform(t.w, lambda v: v * b.sc) AS tw, u.w AS uw, e.sigma{spread} FROM {p}_b b JOIN {p}_t_w t ON {on('b', 't')} JOIN {p}_u_w u ON {on('b', 'u')} JOIN {p}_e e ON {on('b', 'e')}",
        f"{p}_f": (
            f"SELECT {q('d')}d.ds, m.origin, m.span, m.tw, m.uw, m.sigma FROM {days} d JOIN {p}_m m ON {on('d', 'm')}"
            if days
            else f"SELECT {lead}CAST(unnest(generate_series(origin, last_day + {config.horizon_days}, INTERVAL 1 DAY)) AS DATE) AS ds, origin, span, tw, uw, sigma{moved} FROM {p}_m"
        ),
        f"{p}_g": f"SELECT {lead}ds, sigma, {dot(f'[{trend}]', 'tw')} AS trend, list_transform([{season}], lambda v, k: v * uw[k]) AS parts FROM (SELECT f.*{known} FROM {p}_f f{beside('f')}) k",
        f"{p}_ahead": (
            f"SELECT {lead}ds, yhat, yhat - {Z80} * sigma AS yhat_lower, yhat + {Z80} * sigma AS yhat_upper, trend, yearly, weekly FROM (SELECT *, trend * (1 + list_sum(parts)) AS yhat, "
            f"coalesce(list_sum(list_slice(parts, 1, {wide[0]})), 0.0) AS yearly, coalesce(list_sum(list_slice(parts, {wide[0] + 1}, {wide[0] + wide[1]})), 0.0) AS weekly FROM {p}_g) a"
        ),
    }
    return out
