"""SQL of worldwide cells, for a second engine: one column per level, digits by the tables of directions."""

from __future__ import annotations

import math

from plazaflow.functions.icosahedron import (
    DIGIT_DIRECTIONS,
    DIGITS,
    FACES,
    FINEST,
    GAP,
    SCALE,
    SIN60,
    TURN,
    UNIT,
    grid,
)


def _dot(azimuth: str) -> str:
    """Product of a point with a face's vector: the centre, or the tangent of an azimuth."""
    if not azimuth:
        return "sin(la_) * sin(fla_) + cos(la_) * cos(fla_) * cos(lo_ - flo_)"
    north = "(sin(la_) * cos(fla_) - cos(la_) * sin(fla_) * cos(lo_ - flo_))"
    east = "(cos(la_) * sin(lo_ - flo_))"
    return f"(cos({azimuth}) * {north} + sin({azimuth}) * {east})"


def h3_cells(block: str, resolution: int, lat: str = "lat", lon: str = "lon", name: str = "h3_index") -> str:
    """All columns of a block, plus the cell's text."""
    tables = {k: str(v) for k, v in grid().items()}
    angles = [str([f[k] for f in FACES]) for k in range(3)]
    near = [
        f"sin(la_) * {math.sin(a)!r}e0 + cos(la_) * {math.cos(a)!r}e0 * cos(lo_ - {b!r}e0)".replace("e-", "E-")
        for a, b, _ in FACES
    ]
    near = [x.replace("- -", "+ ") for x in near]
    c, s = (math.cos(TURN), math.sin(TURN)) if resolution % 2 else (1.0, 0.0)
    big = f"{SCALE**resolution / UNIT!r}"
    steps = [
        f"radians({lat}) AS la_, radians({lon}) AS lo_, [{', '.join(near)}] AS d_",
        "list_position(d_, list_max(d_)) AS f_",
        f"({angles[0]})[f_] AS fla_, ({angles[1]})[f_] AS flo_, ({angles[2]})[f_] AS az_",
        f"{_dot('az_')} / list_max(d_) * {big} AS u_, {_dot(f'(az_ - {math.pi / 2!r})')} / list_max(d_) * {big} AS v_",
        f"u_ * {c!r} + v_ * {s!r} AS x_, v_ * {c!r} - u_ * {s!r} AS y_",
        f"x_ + y_ / {SIN60!r} / 2 AS qa_, -y_ / {SIN60!r} AS qb_, y_ / {SIN60!r} / 2 - x_ AS qc_",
        "round_even(qa_, 0) AS ra_, round_even(qb_, 0) AS rb_, round_even(qc_, 0) AS rc_",
        "abs(ra_ - qa_) AS da_, abs(rb_ - qb_) AS db_, abs(rc_ - qc_) AS dc_",
        f"CAST(CASE WHEN da_ > db_ AND da_ > dc_ THEN -rb_ - rc_ ELSE ra_ END AS BIGINT) AS a{resolution}_, "
        "CAST(-(CASE WHEN NOT (da_ > db_ AND da_ > dc_) AND db_ > dc_ THEN -ra_ - rc_ ELSE rb_ END) AS BIGINT)"
        f" AS b{resolution}_",
    ]
    for level in range(resolution, 0, -1):
        a, b, p, q = f"a{level}_", f"b{level}_", f"a{level - 1}_", f"b{level - 1}_"
        up = (f"3 * {a} - {b}", f"{a} + 2 * {b}") if level % 2 else (f"2 * {a} + {b}", f"3 * {b} - {a}")
        down = (f"2 * {p} + {q}", f"3 * {q} - {p}") if level % 2 else (f"3 * {p} - {q}", f"{p} + 2 * {q}")
        steps.append(", ".join(f"CAST(round(({v}) / 7e0) AS BIGINT) AS {n}" for v, n in zip(up, (p, q))))
        i, j = f"({a} - ({down[0]}))", f"({b} - ({down[1]}))"
        steps.append(f"4 * {i} + 2 * {j} - 7 * least({i}, {j}, 0) AS g{level}_")
    digits = [f"g{level}_" for level in range(1, resolution + 1)]
    steps.append("(f_ - 1) * 25 + (a0_ + 2) * 5 + b0_ + 3 AS at_")
    steps.append(f"({tables['base']})[at_] AS base_, ({tables['turns']})[at_] AS turns_")
    lead = f"coalesce({', '.join(f'nullif({g}, 0)' for g in digits)}, 0)" if digits else "0"
    steps.append(f"({DIGIT_DIRECTIONS})[{lead} + 1] AS lead_")
    steps.append(
        f"turns_ + CASE WHEN lead_ < 0 OR ({tables['pentagon']})[base_ + 1] = 0 OR (lead_ + turns_) % 6 <> {GAP} THEN 0"
        f" WHEN ({tables['home_face']})[base_ + 1] = f_ - 1 THEN 1 ELSE 5 END AS t_"
    )
    parts = [
        f"CASE WHEN {g} = 0 THEN 0 ELSE ({list(DIGITS)})[(({DIGIT_DIRECTIONS})[{g} + 1] + t_) % 6 + 1] END"
        f" * {1 << 3 * (FINEST - level)}::BIGINT"
        for level, g in enumerate(digits, 1)
    ]
    head = (1 << 59) + (resolution << 52) + (1 << 3 * (FINEST - resolution)) - 1
    total = " + ".join([f"{head}::BIGINT", f"base_::BIGINT * {1 << 45}::BIGINT", *parts])
    sql = f"(SELECT * FROM {block})"
    for step in steps:
        sql = f"(SELECT *, {step} FROM {sql})"
    return f"(SELECT COLUMNS(lambda c: NOT ends_with(c, '_')), printf('%x', {total}) AS {name} FROM {sql})"
