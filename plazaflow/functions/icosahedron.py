"""H3 cells as column expressions: points to ids and ids to centres, without Python per row.

The grid lies on the 20 faces of an icosahedron. A point is projected from the sphere's centre to the
plane of the nearest face, where cells are hexagons of a lattice that shrinks by the root of 7 and
turns by `TURN` from one resolution to the next. An id has the number of one of 122 base cells and
a digit, the neighbour of the coarser cell's centre, for each resolution below.

Only the placement of the faces and the home faces of base cells are given values. All other tables
follow from geometry, once per Python process:

- A face's plane holds 19 base-cell places. The edge of two faces is a turn and a shift from one
  plane to the other, so places beyond an edge are those of the neighbour.
- Base cells are numbered from north to south by their centres. Where one lies on several faces, its
  digits count from the axes of its home face; other faces are turned by multiples of 60 degrees.
- Twelve base cells are pentagons around a corner of the icosahedron: five faces meet where a plane has
  room for six, and the direction `GAP` of the home face is left out.

`with_cell_number` and `with_center` compute the same for whole tables in named steps, each a projection of the one
before, so that Spark compiles them. `cell_number` and `center` are one column each; to use a value more than once
they need lambdas, which Spark interprets at many times the cost: they are for tables of few rows.
"""

from __future__ import annotations

import cmath
import functools
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Latitude and longitude of each face's centre and the azimuth of its first axis, in radians.
FACES = (
    (0.803582649718989942, 1.248397419617396099, 5.619958268523939882),
    (1.307747883455638156, 2.536945009877921159, 5.760339081714187279),
    (1.054751253523952054, -1.347517358900396623, 0.780213654393430055),
    (0.600191595538186799, -0.450603909469755746, 0.430469363979999913),
    (0.491715428198773866, 0.401988202911306943, 6.130269123335111400),
    (0.172745327415618701, 1.678146885280433686, 2.692877706530642877),
    (0.605929321571350690, 2.953923329812411617, 2.982963003477243874),
    (0.427370518328979641, -1.888876200336285401, 3.532912002790141181),
    (-0.079066118549212831, -0.733429513380867741, 3.494305004259568154),
    (-0.230961644455383637, 0.506495587332349035, 3.003214169499538391),
    (0.079066118549212831, 2.408163140208925497, 5.930472956509811562),
    (0.230961644455383637, -2.635097066257444203, 0.138378484090254847),
    (-0.172745327415618701, -1.463445768309359553, 0.448714947059150361),
    (-0.605929321571350690, -0.187669323777381622, 0.158629650112549365),
    (-0.427370518328979641, 1.252716453253507838, 5.891865957979238535),
    (-0.600191595538186799, 2.690988744120037492, 2.711123289609793325),
    (-0.491715428198773866, -2.739604450678486295, 3.294508837434268316),
    (-0.803582649718989942, -1.893195233972397139, 3.804819692245439833),
    (-1.307747883455638156, -0.604647643711872080, 3.664438879055192436),
    (-1.054751253523952054, 1.794075294689396615, 2.361378999196363184),
)

# Home face of each base cell.
HOME_FACES = (
    1, 2, 1, 2, 0, 1, 1, 2, 0, 2, 1, 1, 3, 3, 11, 4, 0, 6, 0, 2,
    7, 2, 0, 6, 10, 6, 3, 11, 4, 3, 0, 4, 5, 0, 7, 11, 7, 10, 12, 6,
    7, 4, 3, 3, 4, 6, 11, 8, 5, 14, 5, 12, 10, 4, 12, 7, 11, 10, 13, 10,
    11, 9, 8, 6, 8, 9, 14, 5, 16, 8, 5, 12, 7, 12, 10, 9, 13, 16, 15, 15,
    16, 14, 13, 5, 8, 14, 9, 14, 17, 12, 16, 17, 15, 16, 9, 15, 13, 8, 13, 17,
    19, 14, 19, 17, 13, 17, 16, 9, 15, 15, 18, 18, 19, 17, 19, 18, 18, 19, 19, 18,
    19, 18,
)

# Distance of neighbouring base cells in the plane of a face, and the digit of each direction
# from the first axis on, in steps of 60 degrees.
UNIT = 0.38196601125010500003
DIGITS = (4, 6, 2, 3, 1, 5)
GAP = 4  # direction of the digit that pentagons lack
TURN = math.asin(math.sqrt(3 / 28))
SCALE = math.sqrt(7)
FINEST = 15

DIRECTIONS = tuple(cmath.rect(1, math.radians(60 * t)) for t in range(6))
SIN60 = math.sqrt(3) / 2


def _frame(face: int) -> tuple[tuple[float, ...], ...]:
    """Unit vectors of a face: its centre, its first axis, and the axis a quarter turn to the left."""
    lat, lon, azimuth = FACES[face]
    centre = (math.cos(lat) * math.cos(lon), math.cos(lat) * math.sin(lon), math.sin(lat))
    north = (-math.sin(lat) * math.cos(lon), -math.sin(lat) * math.sin(lon), math.cos(lat))
    east = (-math.sin(lon), math.cos(lon), 0.0)
    c, s = math.cos(azimuth), math.sin(azimuth)
    first = tuple(c * n + s * e for n, e in zip(north, east))
    left = tuple(s * n - c * e for n, e in zip(north, east))
    return centre, first, left


def _on_sphere(face: int, z: complex) -> tuple[float, ...]:
    centre, first, left = _frame(face)
    p = [c + UNIT * (z.real * u + z.imag * v) for c, u, v in zip(centre, first, left)]
    size = math.hypot(*p)
    return tuple(x / size for x in p)


def _place(a: int, b: int) -> complex:
    """The point of a lattice place: `a` steps along the first axis and `b` along the one at 120 degrees."""
    return a + b * DIRECTIONS[2]


def _near(x: complex, y: complex) -> bool:
    return abs(x - y) < 1e-6


@functools.cache
def grid() -> dict[str, list]:
    """Tables of the grid, from the placement of the faces.

    base, turns: by face and place (see `place_of`), the base cell and the turns to its home face.
    home_x, home_y, pentagon: by base cell, its point on its home face and whether it is a pentagon.
    edge_face, edge_turn, edge_x, edge_y: by face and edge, the plane beyond it.
    wedge_face, wedge_corner: by base cell and wedge, the faces around a pentagon, from home clockwise.
    """
    corners = [2 * DIRECTIONS[2 * k] for k in range(3)]
    normals = [DIRECTIONS[1 + 2 * k] for k in range(3)]  # edge k lies between corners k and k + 1
    inside = [(a, b) for a in range(-2, 3) for b in range(-2, 3)]
    inside = [p for p in inside if all((_place(*p) * n.conjugate()).real < 1 + 1e-6 for n in normals)]

    # Base cells, from north to south.
    points: list[tuple[float, ...]] = []
    for face in range(20):
        for p in inside:
            x = _on_sphere(face, _place(*p))
            if not any(math.dist(x, y) < 1e-6 for y in points):
                points.append(x)
    points.sort(key=lambda x: -x[2])

    def base_of(face: int, z: complex) -> int:
        x = _on_sphere(face, z)
        return min(range(122), key=lambda k: math.dist(x, points[k]))

    home = []
    for base, face in enumerate(HOME_FACES):
        home.append(next(_place(*p) for p in inside if math.dist(_on_sphere(face, _place(*p)), points[base]) < 1e-6))
    pentagon = [abs(z) > 1.9 for z in home]

    # The plane beyond each edge: z becomes turn * z + shift on the face that shares its corners.
    ends = [[base_of(f, z) for z in corners] for f in range(20)]
    beyond: dict[tuple[int, int], tuple[int, int, complex]] = {}
    for f in range(20):
        for e in range(3):
            a, b = ends[f][e], ends[f][(e + 1) % 3]
            g = next(g for g in range(20) if g != f and a in ends[g] and b in ends[g])
            za, zb = corners[ends[g].index(a)], corners[ends[g].index(b)]
            turn = (za - zb) / (corners[e] - corners[(e + 1) % 3])
            steps = round(math.degrees(cmath.phase(turn)) / 60) % 6
            beyond[f, e] = g, steps, za - turn * corners[e]

    def across(f: int, e: int, z: complex) -> tuple[int, int, complex]:
        g, steps, shift = beyond[f, e]
        return g, steps, DIRECTIONS[steps] * z + shift

    # Wedges of each pentagon: the faces clockwise from home, and the corner that each has there.
    wedges: dict[int, list[tuple[int, int]]] = {}
    for base in range(122):
        if pentagon[base]:
            face, around = HOME_FACES[base], []
            for _ in range(5):
                corner = ends[face].index(base)
                around.append((face, corner))
                face = beyond[face, corner][0]  # the edge that begins at the corner lies clockwise
            wedges[base] = around

    def turns_of(f: int, z: complex, base: int) -> int:
        if pentagon[base]:
            m = [face for face, _ in wedges[base]].index(f)
            corner = wedges[base][m][1]
            return (wedge_middle(m) - corner_middle(corner)) % 6
        if HOME_FACES[base] == f:
            return 0
        edge = max(range(3), key=lambda e: (z * normals[e].conjugate()).real)
        g, steps, there = across(f, edge, z)
        return (steps + turns_of(g, there, base)) % 6

    base, turns = [-1] * 500, [0] * 500
    for f in range(20):
        for a in range(-2, 3):
            for b in range(-2, 3):
                z, g, steps = _place(a, b), f, 0
                if abs(a - b) > 2:
                    continue
                edge = max(range(3), key=lambda e: (z * normals[e].conjugate()).real)
                if (z * normals[edge].conjugate()).real > 1 + 1e-6:
                    g, steps, z = across(f, edge, z)
                k = base_of(g, z)
                base[place_of(f, a, b)] = k
                turns[place_of(f, a, b)] = (steps + turns_of(g, z, k)) % 6
    return {
        "base": base,
        "turns": turns,
        "home_x": [z.real for z in home],
        "home_y": [z.imag for z in home],
        "pentagon": [int(p) for p in pentagon],
        "home_face": list(HOME_FACES),
        "edge_face": [beyond[f, e][0] for f in range(20) for e in range(3)],
        "edge_turn": [beyond[f, e][1] for f in range(20) for e in range(3)],
        "edge_x": [beyond[f, e][2].real for f in range(20) for e in range(3)],
        "edge_y": [beyond[f, e][2].imag for f in range(20) for e in range(3)],
        "wedge_face": [wedges[k][m][0] if k in wedges else -1 for k in range(122) for m in range(5)],
        "wedge_corner": [wedges[k][m][1] if k in wedges else 0 for k in range(122) for m in range(5)],
    }


def wedge_middle(m: int) -> int:
    """Direction, from a pentagon's centre, of its wedge `m` in the axes of the home face."""
    return 3 - m


def corner_middle(corner: int) -> int:
    """Direction from a face's corner to the face's centre."""
    return (2 * corner + 3) % 6


def place_of(face, a, b):
    """Index of a lattice place of a face in the tables, for numbers and columns."""
    return face * 25 + (a + 2) * 5 + (b + 2)


def _list(values: list) -> Column:
    texts = (f"{v!r}D" if isinstance(v, float) else str(v) for v in values)
    return F.expr(f"array({', '.join(texts)})")


def _at(name: str, index: Column) -> Column:
    return F.element_at(_list(grid()[name]), (index + 1).cast("int"))


def _with(value: Column, use) -> Column:
    """`use` applied to a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _dot(p: Column, f: Column, axis: str) -> Column:
    return p["x"] * f[f"{axis}x"] + p["y"] * f[f"{axis}y"] + p["z"] * f[f"{axis}z"]


@functools.cache
def _faces_sql() -> str:
    rows = []
    for face in range(20):
        frame = [f"{v!r}D AS {axis}{c}" for axis, vector in zip("cuv", _frame(face)) for c, v in zip("xyz", vector)]
        rows.append(f"named_struct('f', {face}, {', '.join(repr(x.split(' AS ')[1]) + ', ' + x.split(' AS ')[0] for x in frame)})")
    return f"array({', '.join(rows)})"


def cell_number(lat: Column, lon: Column, resolution: int) -> Column:
    """The id of a point's cell as a whole number; null for a missing or infinite coordinate."""
    if not 0 <= resolution <= FINEST:
        raise ValueError(f"resolutions go from 0 to {FINEST}, not {resolution}")
    la, lo = F.radians(lat.cast("double")), F.radians(lon.cast("double"))
    point = F.struct(
        (F.cos(la) * F.cos(lo)).alias("x"), (F.cos(la) * F.sin(lo)).alias("y"), F.sin(la).alias("z")
    )
    faces = F.expr(_faces_sql())
    finite = ~F.isnan(point["x"] + point["z"])

    def of_point(p: Column) -> Column:
        # Faces lie opposite each other, so ten products tell the nearest of twenty.
        dots = []
        for f, g in _opposites():
            d = sum(p[c] * v for c, v in zip("xyz", _frame(f)[0]))
            dots.append(F.struct(F.abs(d).alias("d"), F.when(d < 0, g).otherwise(f).alias("f")))
        return _with(F.element_at(faces, F.greatest(*dots)["f"] + 1), lambda f: on_face(p, f))

    def on_face(p: Column, f: Column) -> Column:
        away = _dot(p, f, "c") * UNIT / SCALE**resolution
        x, y = _dot(p, f, "u") / away, _dot(p, f, "v") / away
        if resolution % 2:  # the finer lattice of a pair is turned
            c, s = math.cos(TURN), math.sin(TURN)
            x, y = x * c + y * s, y * c - x * s
        return _with(F.struct(x.alias("x"), y.alias("y")), lambda z: rounded(z, f["f"]))

    def rounded(z: Column, face: Column) -> Column:
        b = z["y"] / SIN60
        cube = F.struct((z["x"] + b / 2).alias("a"), (-b).alias("b"), (b / 2 - z["x"]).alias("c"))

        def nearest(q: Column) -> Column:
            r = F.struct(*(F.rint(q[n]).alias(n) for n in "abc"))
            return _with(r, lambda r: placed(q, r))

        def placed(q: Column, r: Column) -> Column:
            da, db, dc = (F.abs(r[n] - q[n]) for n in "abc")
            a = F.when((da > db) & (da > dc), -r["b"] - r["c"]).otherwise(r["a"])
            b = F.when((da > db) & (da > dc) | (db <= dc), r["b"]).otherwise(-r["a"] - r["c"])
            return _with(
                F.struct(a.cast("bigint").alias("a"), (-b).cast("bigint").alias("b")), lambda start: climbed(start, face)
            )

        return _with(cube, nearest)

    def climbed(start: Column, face: Column) -> Column:
        """Up to resolution 0, adding the digit of each step; `lead` is the coarsest that is not 0."""
        zero = F.lit(0).cast("bigint")
        state = F.struct(start["a"].alias("a"), start["b"].alias("b"), zero.alias("bits"), zero.alias("lead"))
        if resolution:
            levels = F.sequence(F.lit(resolution), F.lit(1), F.lit(-1))
            state = F.aggregate(levels, state, climb)
        return _with(state, lambda s: numbered(s, face))

    def climb(s: Column, level: Column) -> Column:
        a, b = s["a"], s["b"]
        odd = level % 2 == 1
        # The nearest coarser centre is a seventh of the place turned back.
        up_a = F.floor((2 * F.when(odd, 3 * a - b).otherwise(2 * a + b) + 7) / 14)
        up_b = F.floor((2 * F.when(odd, a + 2 * b).otherwise(3 * b - a) + 7) / 14)

        def moved(u: Column) -> Column:
            p, q = u["a"], u["b"]
            step = F.struct(
                p.alias("a"),
                q.alias("b"),
                (a - F.when(odd, 2 * p + q).otherwise(3 * p - q)).alias("da"),
                (b - F.when(odd, 3 * q - p).otherwise(p + 2 * q)).alias("db"),
            )
            return _with(step, coded)

        def coded(u: Column) -> Column:
            # Steps along three axes at 120 degrees, none negative, are the bits of a digit.
            digit = 4 * u["da"] + 2 * u["db"] - 7 * F.least(u["da"], u["db"], F.lit(0).cast("bigint"))
            shift = (3 * (resolution - level)).cast("int")
            return F.struct(
                u["a"].alias("a"),
                u["b"].alias("b"),
                (s["bits"] + F.call_function("shiftleft", digit, shift)).alias("bits"),
                F.when(digit == 0, s["lead"]).otherwise(digit).alias("lead"),
            )

        return _with(F.struct(up_a.alias("a"), up_b.alias("b")), moved)

    def numbered(s: Column, face: Column) -> Column:
        index = place_of(face, s["a"], s["b"])
        found = F.struct(_at("base", index).alias("base"), _at("turns", index).alias("turns"))
        return _with(found, lambda x: turned(s, x, face))

    def turned(s: Column, x: Column, face: Column) -> Column:
        # A pentagon lacks one direction: there the neighbouring wedge of the other side goes on.
        lead = F.element_at(_list(DIGIT_DIRECTIONS), (s["lead"] + 1).cast("int"))
        gap = (lead >= 0) & (_at("pentagon", x["base"]) == 1) & ((lead + x["turns"]) % 6 == GAP)
        home = _at("home_face", x["base"]) == face
        turns = (x["turns"] + F.when(gap & home, 1).when(gap, 5).otherwise(0)) % 6
        return _with(F.struct(turns.alias("turns"), s["bits"].alias("bits")), lambda t: finished(x["base"], t))

    def finished(base: Column, t: Column) -> Column:
        unused = 3 * (FINEST - resolution)
        head = (1 << 59) + (resolution << 52) + (1 << unused) - 1
        return F.lit(head).cast("bigint") + base.cast("bigint") * (1 << 45) + _turned(t["bits"], t["turns"]) * (1 << unused)

    return F.when(finite, _with(point, of_point))


def _turned(bits: Column, turns: Column) -> Column:
    """All digits turned by multiples of 60 degrees at once.

    A digit's bits are steps along three axes: a third of a turn moves each bit to the next axis, and
    half a turn puts the other two in place of each (0 stays). A sixth is a half less a third.
    """
    thirds = F.when(turns % 3 == 1, _third(_third(bits))).when(turns % 3 == 2, _third(bits)).otherwise(bits)
    return F.when(turns % 2 == 0, thirds).otherwise(_with(thirds, _half))


# The lowest bit of each digit.
LOW = sum(1 << 3 * k for k in range(FINEST))


def _third(x: Column) -> Column:
    rest = F.shiftright(x.bitwiseAND(F.lit(6 * LOW)), 1)
    return rest.bitwiseOR(F.shiftleft(x.bitwiseAND(F.lit(LOW)), 2))


def _half(x: Column) -> Column:
    some = x.bitwiseOR(F.shiftright(x, 1)).bitwiseOR(F.shiftright(x, 2)).bitwiseAND(F.lit(LOW))
    return x.bitwiseXOR(some * 7)


@functools.cache
def _opposites() -> list[tuple[int, int]]:
    """Pairs of faces that lie opposite each other."""
    centres = [_frame(f)[0] for f in range(20)]
    pairs = ((f, min(range(20), key=lambda g: math.dist(centres[f], [-v for v in centres[g]]))) for f in range(20))
    return [(f, g) for f, g in pairs if f < g]


def cell(lat: Column, lon: Column, resolution: int) -> Column:
    """The id of a point's cell as its usual text."""
    return F.lower(F.hex(cell_number(lat, lon, resolution)))


def number_of(text: Column) -> Column:
    """The id of a text; null for what is no hexadecimal number of 15 digits."""
    known = text.rlike("^[0-9a-fA-F]{15}$")
    return F.when(known, F.conv(text, 16, 10).cast("bigint"))


def center(number: Column) -> Column:
    """Centre of a cell as struct(lat, lon) in degrees; null for a null or impossible id."""

    def field(n: Column, low: int, mask: int) -> Column:
        return F.shiftright(n, low).bitwiseAND(F.lit(mask))

    def of_number(n: Column) -> Column:
        levels = F.sequence(F.lit(1), F.lit(FINEST))
        used = F.filter(levels, lambda r: r <= field(n, 52, 15))
        digit = F.transform(
            used,
            lambda r: F.call_function("shiftright", n, (3 * (FINEST - r)).cast("int")).bitwiseAND(F.lit(7)).cast("int"),
        )
        return _with(
            F.struct(field(n, 45, 127).cast("int").alias("base"), digit.alias("digits"), field(n, 59, 31).alias("mode")),
            of_digits,
        )

    def of_digits(x: Column) -> Column:
        direction = F.transform(
            x["digits"], lambda d: F.when(d == 0, -1).otherwise(F.element_at(_list(DIGIT_DIRECTIONS), d + 1))
        )
        possible = (x["mode"] == 1) & (x["base"] < 122) & ~F.exists(x["digits"], lambda d: d == 7)
        value = F.struct(x["base"].alias("base"), direction.alias("steps"))
        lead = F.get(F.filter(direction, lambda t: t >= 0), F.lit(0))
        lacking = (_at("pentagon", F.least(x["base"], F.lit(121))) == 1) & F.coalesce(lead == GAP, F.lit(False))
        return F.when(possible & ~lacking, _with(value, of_steps))

    def of_steps(x: Column) -> Column:
        lead = F.get(F.filter(x["steps"], lambda t: t >= 0), F.lit(0))
        pentagon = _at("pentagon", x["base"]) == 1
        # The last wedge of a pentagon lies where the missing direction would be.
        turned = pentagon & F.coalesce(lead == GAP + 1, F.lit(False))
        turn = F.when(turned, 5).otherwise(0)

        def added(part: str) -> Column:
            parts = F.transform(
                x["steps"],
                lambda t, i: F.when(
                    t >= 0, F.element_at(_list(STEP_VECTORS[part]), i * 6 + (t + turn) % 6 + 1)
                ).otherwise(0.0),
            )
            return F.aggregate(parts, F.lit(0.0), lambda a, v: a + v)

        moved = F.struct(
            x["base"].alias("base"),
            pentagon.alias("pentagon"),
            turned.alias("turned"),
            added("x").alias("dx"),
            added("y").alias("dy"),
        )
        return _with(moved, lambda m: on_some_face(m))

    def on_some_face(m: Column) -> Column:
        x, y = _at("home_x", m["base"]) + m["dx"], _at("home_y", m["base"]) + m["dy"]
        start = F.struct(_at("home_face", m["base"]).alias("f"), x.alias("x"), y.alias("y"))
        return F.when(m["pentagon"], around_corner(m)).otherwise(_with(start, over_edge))

    def around_corner(m: Column) -> Column:
        angle = F.degrees(F.atan2(m["dy"], m["dx"]))
        angle = F.when(m["turned"] & (angle < 0), angle + 360).when(~m["turned"] & (angle < -120), angle + 360).otherwise(angle)

        def wedge(w: Column) -> Column:
            index = m["base"] * 5 + F.pmod(w["m"], F.lit(5))
            corner = _at("wedge_corner", index)
            # From the wedge's middle in the home face's axes to the middle at this face's corner.
            shown = F.radians(w["angle"] - (180 - 60 * w["m"]) + 120 * corner + 180)
            size = F.hypot(m["dx"], m["dy"])
            at = F.radians(120.0 * corner)
            return F.struct(
                _at("wedge_face", index).alias("f"),
                (2 * F.cos(at) + size * F.cos(shown)).alias("x"),
                (2 * F.sin(at) + size * F.sin(shown)).alias("y"),
            )

        found = F.struct(angle.alias("angle"), F.rint((180 - angle) / 60).cast("int").alias("m"))
        return _with(_with(found, wedge), on_sphere)

    def over_edge(z: Column) -> Column:
        heights = F.array(
            *(
                F.struct((z["x"] * n.real + z["y"] * n.imag).alias("h"), F.lit(e).alias("e"))
                for e, n in enumerate(DIRECTIONS[1::2])
            )
        )

        def crossed(top: Column) -> Column:
            index = z["f"] * 3 + top["e"]
            turn = _at("edge_turn", index) + 1
            c = F.element_at(_list([d.real for d in DIRECTIONS]), turn)
            s = F.element_at(_list([d.imag for d in DIRECTIONS]), turn)
            there = F.struct(
                _at("edge_face", index).alias("f"),
                (c * z["x"] - s * z["y"] + _at("edge_x", index)).alias("x"),
                (s * z["x"] + c * z["y"] + _at("edge_y", index)).alias("y"),
            )
            return F.when(top["h"] > 1 + 1e-9, there).otherwise(z)

        return _with(_with(F.array_max(heights), crossed), on_sphere)

    def on_sphere(z: Column) -> Column:
        def projected(f: Column) -> Column:
            p = {c: f[f"c{c}"] + UNIT * (z["x"] * f[f"u{c}"] + z["y"] * f[f"v{c}"]) for c in "xyz"}
            return F.struct(
                F.degrees(F.atan2(p["z"], F.hypot(p["x"], p["y"]))).alias("lat"),
                F.degrees(F.atan2(p["y"], p["x"])).alias("lon"),
            )

        return _with(F.element_at(F.expr(_faces_sql()), z["f"] + 1), projected)

    return F.when(number.isNotNull(), _with(number, of_number))


# -- the same in steps over a table ----------------------------------------------------------------

# Values by name, and what the next values are in terms of those before.
Scope = dict[str, Column]
Step = Callable[[Scope], Scope]

# Steps compiled into one method, and more partitions than any table has.
FUSED = 2
MANY_PARTITIONS = 1 << 24


def _in_steps(df: DataFrame, steps: list[Step], column: str) -> DataFrame:
    """`df` with the last step's only value as a column. A step's values are columns of a projection of their
    own, as Spark computes once what a later projection uses more than once.

    Spark compiles neighbouring projections into one method, and Java runs large methods uncompiled. A coalescing to
    more partitions than there are leaves all rows where they are, but ends the method.

    The last value comes out of a generator with one row for each: a condition on it stays above. Spark would
    move it below all steps and write each value out in place of its name, the whole plan many times over."""
    prefix = "_"
    while any(c.startswith(prefix) for c in df.columns):
        prefix += "_"
    scope: Scope = {}
    for i, step in enumerate(steps[:-1]):
        new = step(scope)
        df = df.select("*", *(value.alias(prefix + name) for name, value in new.items()))
        if i % FUSED == FUSED - 1:
            df = df.coalesce(MANY_PARTITIONS)
        scope |= {name: F.col(prefix + name) for name in new}
    (value,) = steps[-1](scope).values()
    df = df.select("*", F.explode(F.array(value)).alias(f"{prefix}result"))
    return df.withColumn(column, F.col(f"{prefix}result")).drop(f"{prefix}result", *(prefix + name for name in scope))


def _cell_steps(lat: Column, lon: Column, resolution: int) -> list[Step]:
    la, lo = lat.cast("double"), lon.cast("double")
    pairs = _opposites()

    def angles(s: Scope) -> Scope:
        finite = (F.abs(la) < math.inf) & (F.abs(lo) < math.inf)
        return {"la": F.when(finite, F.radians(la)), "lo": F.when(finite, F.radians(lo))}

    def point(s: Scope) -> Scope:
        flat = F.cos(s["la"])
        return {"x": flat * F.cos(s["lo"]), "y": flat * F.sin(s["lo"]), "z": F.sin(s["la"])}

    def dots(s: Scope) -> Scope:
        return {f"d{i}": sum(s[c] * v for c, v in zip("xyz", _frame(f)[0])) for i, (f, _) in enumerate(pairs)}

    def largest(s: Scope) -> Scope:
        return {"best": F.greatest(*(F.abs(s[f"d{i}"]) for i in range(len(pairs))))}

    def face(s: Scope) -> Scope:
        found = (F.when(s[f"d{i}"] == s["best"], f).when(s[f"d{i}"] == -s["best"], g) for i, (f, g) in enumerate(pairs))
        return {"f": F.greatest(*found)}

    def frame(s: Scope) -> Scope:
        return {"frame": F.element_at(F.expr(_faces_sql()), s["f"] + 1)}

    def away(s: Scope) -> Scope:
        return {"away": _dot(s, s["frame"], "c") * UNIT / SCALE**resolution}

    def plane(s: Scope) -> Scope:
        return {"u": _dot(s, s["frame"], "u") / s["away"], "v": _dot(s, s["frame"], "v") / s["away"]}

    def cube(s: Scope) -> Scope:
        x, y = s["u"], s["v"]
        if resolution % 2:
            c, t = math.cos(TURN), math.sin(TURN)
            x, y = x * c + y * t, y * c - x * t
        b = y / SIN60
        return {"qa": x + b / 2, "qb": -b, "qc": b / 2 - x}

    def rounded(s: Scope) -> Scope:
        return {f"r{n}": F.rint(s[f"q{n}"]) for n in "abc"}

    def errors(s: Scope) -> Scope:
        return {f"e{n}": F.abs(s[f"r{n}"] - s[f"q{n}"]) for n in "abc"}

    def start(s: Scope) -> Scope:
        off = (s["ea"] > s["eb"]) & (s["ea"] > s["ec"])
        a = F.when(off, -s["rb"] - s["rc"]).otherwise(s["ra"])
        b = F.when(off | (s["eb"] <= s["ec"]), s["rb"]).otherwise(-s["ra"] - s["rc"])
        return {f"a{resolution}": a.cast("bigint"), f"b{resolution}": (-b).cast("bigint")} | {
            f"{n}{resolution}": F.lit(0).cast("bigint") for n in ("bits", "lead")
        }

    def climb(level: int) -> list[Step]:
        """From a level's place to that of the coarser cell, and the digit between them."""

        def up(s: Scope) -> Scope:
            a, b = s[f"a{level}"], s[f"b{level}"]
            x, y = (3 * a - b, a + 2 * b) if level % 2 else (2 * a + b, 3 * b - a)
            return {f"a{level - 1}": F.floor((2 * x + 7) / 14), f"b{level - 1}": F.floor((2 * y + 7) / 14)}

        def digit(s: Scope) -> Scope:
            p, q = s[f"a{level - 1}"], s[f"b{level - 1}"]
            i = s[f"a{level}"] - (2 * p + q if level % 2 else 3 * p - q)
            j = s[f"b{level}"] - (3 * q - p if level % 2 else p + 2 * q)
            return {f"g{level}": 4 * i + 2 * j - 7 * F.least(i, j, F.lit(0).cast("bigint"))}

        def joined(s: Scope) -> Scope:
            g = s[f"g{level}"]
            return {
                f"bits{level - 1}": s[f"bits{level}"] + g * (1 << 3 * (resolution - level)),
                f"lead{level - 1}": F.when(g == 0, s[f"lead{level}"]).otherwise(g),
            }

        return [up, digit, joined]

    def base(s: Scope) -> Scope:
        index = place_of(s["f"], s["a0"], s["b0"])
        lead = F.element_at(_list(DIGIT_DIRECTIONS), (s["lead0"] + 1).cast("int"))
        return {"base": _at("base", index), "turns": _at("turns", index), "lead": lead}

    def turns(s: Scope) -> Scope:
        gap = (s["lead"] >= 0) & (_at("pentagon", s["base"]) == 1) & ((s["lead"] + s["turns"]) % 6 == GAP)
        home = _at("home_face", s["base"]) == s["f"]
        return {"t": (s["turns"] + F.when(gap & home, 1).when(gap, 5).otherwise(0)) % 6, "once": _third(s["bits0"])}

    def thirds(s: Scope) -> Scope:
        twice = _third(s["once"])
        return {"thirds": F.when(s["t"] % 3 == 1, twice).when(s["t"] % 3 == 2, s["once"]).otherwise(s["bits0"])}

    def number(s: Scope) -> Scope:
        unused = 3 * (FINEST - resolution)
        head = (1 << 59) + (resolution << 52) + (1 << unused) - 1
        bits = F.when(s["t"] % 2 == 0, s["thirds"]).otherwise(_half(s["thirds"]))
        return {"number": F.lit(head).cast("bigint") + s["base"].cast("bigint") * (1 << 45) + bits * (1 << unused)}

    place = [angles, point, dots, largest, face, frame, away, plane, cube, rounded, errors, start]
    levels = [step for level in range(resolution, 0, -1) for step in climb(level)]
    return [*place, *levels, base, turns, thirds, number]


def with_cell_number(df: DataFrame, column: str, lat: Column, lon: Column, resolution: int) -> DataFrame:
    """`df` with `cell_number` of each row's point as `column`."""
    if not 0 <= resolution <= FINEST:
        raise ValueError(f"resolutions go from 0 to {FINEST}, not {resolution}")
    return _in_steps(df, _cell_steps(lat, lon, resolution), column)


def _center_steps(number: Column) -> list[Step]:
    def field(low: int, mask: int) -> Column:
        return F.shiftright(number, low).bitwiseAND(F.lit(mask)).cast("int")

    levels = range(1, FINEST + 1)

    def fields(s: Scope) -> Scope:
        digits = {f"g{r}": field(3 * (FINEST - r), 7) for r in levels}
        return {"mode": field(59, 31), "known": field(45, 127), "finest": field(52, 15), **digits}

    def directions(s: Scope) -> Scope:
        return {
            f"t{r}": F.when(s["finest"] >= r, F.element_at(_list(DIGIT_DIRECTIONS), s[f"g{r}"] + 1)).otherwise(-1)
            for r in levels
        }

    def kind(s: Scope) -> Scope:
        spoilt = functools.reduce(Column.__or__, ((s["finest"] >= r) & (s[f"g{r}"] == 7) for r in levels))
        return {
            "possible": (s["mode"] == 1) & (s["known"] < 122) & ~spoilt,
            "pentagon": _at("pentagon", F.least(s["known"], F.lit(121))) == 1,
            "lead": F.coalesce(*(F.when(s[f"t{r}"] >= 0, s[f"t{r}"]) for r in levels), F.lit(-1)),
        }

    def base(s: Scope) -> Scope:
        lacking = s["pentagon"] & (s["lead"] == GAP)
        # The last wedge of a pentagon lies where the missing direction would be.
        turned = s["pentagon"] & (s["lead"] == GAP + 1)
        return {"base": F.when(s["possible"] & ~lacking, s["known"]), "turned": turned, "turn": F.when(turned, 5).otherwise(0)}

    def moved(s: Scope) -> Scope:
        out = {}
        for part in "xy":
            total = F.lit(0.0)
            for r in levels:
                steps = _list(STEP_VECTORS[part][6 * r - 6 : 6 * r])
                total = total + F.when(s[f"t{r}"] >= 0, F.element_at(steps, (s[f"t{r}"] + s["turn"]) % 6 + 1)).otherwise(0.0)
            out[f"d{part}"] = total
        return out

    def home(s: Scope) -> Scope:
        angle = F.degrees(F.atan2(s["dy"], s["dx"]))
        return {
            "home": _at("home_face", s["base"]),
            "hx": _at("home_x", s["base"]) + s["dx"],
            "hy": _at("home_y", s["base"]) + s["dy"],
            "raw": angle,
        }

    def heights(s: Scope) -> Scope:
        low = F.when(s["turned"], 0).otherwise(-120)
        return {f"h{e}": s["hx"] * n.real + s["hy"] * n.imag for e, n in enumerate(DIRECTIONS[1::2])} | {
            "angle": F.when(s["raw"] < low, s["raw"] + 360).otherwise(s["raw"])
        }

    def edge(s: Scope) -> Scope:
        top = F.greatest(*(s[f"h{e}"] for e in range(3)))
        highest = F.greatest(*(F.when(s[f"h{e}"] == top, e) for e in range(3)))
        return {"top": top, "edge": s["home"] * 3 + highest, "wedge": F.rint((180 - s["angle"]) / 60).cast("int")}

    def beyond(s: Scope) -> Scope:
        index = s["base"] * 5 + F.pmod(s["wedge"], F.lit(5))
        return {"turn_at": _at("edge_turn", s["edge"]) + 1, "around": index, "corner": _at("wedge_corner", index)}

    def vectors(s: Scope) -> Scope:
        return {
            "c": F.element_at(_list([d.real for d in DIRECTIONS]), s["turn_at"]),
            "s": F.element_at(_list([d.imag for d in DIRECTIONS]), s["turn_at"]),
            # From the wedge's middle in the home face's axes to the middle at this face's corner.
            "shown": F.radians(s["angle"] - (180 - 60 * s["wedge"]) + 120 * s["corner"] + 180),
            "at": F.radians(120.0 * s["corner"]),
            "size": F.hypot(s["dx"], s["dy"]),
        }

    def plane(s: Scope) -> Scope:
        over, x, y = s["top"] > 1 + 1e-9, s["hx"], s["hy"]

        def chosen(corner: Column, there: Column, here: Column) -> Column:
            return F.when(s["pentagon"], corner).when(over, there).otherwise(here)

        return {
            "f": chosen(_at("wedge_face", s["around"]), _at("edge_face", s["edge"]), s["home"]),
            "px": chosen(
                2 * F.cos(s["at"]) + s["size"] * F.cos(s["shown"]), s["c"] * x - s["s"] * y + _at("edge_x", s["edge"]), x
            ),
            "py": chosen(
                2 * F.sin(s["at"]) + s["size"] * F.sin(s["shown"]), s["s"] * x + s["c"] * y + _at("edge_y", s["edge"]), y
            ),
        }

    def frame(s: Scope) -> Scope:
        return {"frame": F.element_at(F.expr(_faces_sql()), s["f"] + 1)}

    def sphere(s: Scope) -> Scope:
        f = s["frame"]
        return {c: f[f"c{c}"] + UNIT * (s["px"] * f[f"u{c}"] + s["py"] * f[f"v{c}"]) for c in "xyz"}

    def degrees(s: Scope) -> Scope:
        at = F.struct(
            F.degrees(F.atan2(s["z"], F.hypot(s["x"], s["y"]))).alias("lat"), F.degrees(F.atan2(s["y"], s["x"])).alias("lon")
        )
        return {"center": F.when(s["base"].isNotNull(), at)}

    return [fields, directions, kind, base, moved, home, heights, edge, beyond, vectors, plane, frame, sphere, degrees]


def with_center(df: DataFrame, column: str, number: Column) -> DataFrame:
    """`df` with `center` of each row's cell as `column`."""
    return _in_steps(df, _center_steps(number), column)


def _step_vectors() -> dict[str, list[float]]:
    """By level from 1 and direction, the step of a digit in the plane at resolution 0."""
    steps = [
        DIRECTIONS[t] * cmath.rect(SCALE**-level, TURN if level % 2 else 0.0) for level in range(1, FINEST + 1) for t in range(6)
    ]
    return {"x": [z.real for z in steps], "y": [z.imag for z in steps]}


STEP_VECTORS = _step_vectors()
DIGIT_DIRECTIONS = [-1, *(DIGITS.index(d) for d in range(1, 7)), -1]
