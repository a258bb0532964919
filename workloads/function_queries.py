"""Row functions on rotations and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from motionframes.functions import forces
from motionframes.functions import quat as Q
from motionframes.operators import rotations, stats
from motionframes.operators.blocks import dense_frames

from .base import QUATS, long, quats, query, r6, table

WXYZ, XYZ = "wxyz", "xyz"
HEAD = "take::BIGINT AS take, frame"


def out(df, **columns):
    """Flatten struct results to rounded columns ``name_component``."""
    cells = []
    for name, (column, parts) in columns.items():
        cells += [r6(column[p]).alias(f"{name}_{p}") for p in parts] if parts else [r6(column).alias(name)]
    return df.select(long("take").alias("take"), "frame", *cells)


def q_(prefix: str = "") -> list[str]:
    return [f"{prefix}{c}" for c in WXYZ]


def mul(a: list[str], b: list[str]) -> list[str]:
    (w, x, y, z), (e, f, g, h) = a, b
    return [
        f"({w}*{e} - {x}*{f} - {y}*{g} - {z}*{h})",
        f"({w}*{f} + {x}*{e} + {y}*{h} - {z}*{g})",
        f"({w}*{g} - {x}*{h} + {y}*{e} + {z}*{f})",
        f"({w}*{h} + {x}*{g} - {y}*{f} + {z}*{e})",
    ]


def conj(a: list[str]) -> list[str]:
    return [a[0], *[f"(-{c})" for c in a[1:]]]


def mat(q: list[str]) -> list[str]:
    w, x, y, z = q
    return [
        f"(1 - 2*({y}*{y} + {z}*{z}))", f"(2*({x}*{y} - {z}*{w}))", f"(2*({x}*{z} + {y}*{w}))",
        f"(2*({x}*{y} + {z}*{w}))", f"(1 - 2*({x}*{x} + {z}*{z}))", f"(2*({y}*{z} - {x}*{w}))",
        f"(2*({x}*{z} - {y}*{w}))", f"(2*({y}*{z} + {x}*{w}))", f"(1 - 2*({x}*{x} + {y}*{y}))",
    ]


def app(m: list[str], v: list[str], transpose: bool = False) -> list[str]:
    pick = (lambda i, j: m[3 * j + i]) if transpose else (lambda i, j: m[3 * i + j])
    return ["(" + " + ".join(f"{pick(i, j)}*{v[j]}" for j in range(3)) + ")" for i in range(3)]


def rnd(cells: dict[str, str], digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) + 0.0 AS {n}" for n, c in cells.items())


def named(prefix: str, cells: list[str], parts: str) -> dict[str, str]:
    return {f"{prefix}_{p}": c for p, c in zip(parts, cells)}


Qq, Qp = q_(), q_("p")
V, U = ["vx", "vy", "vz"], ["ux", "uy", "uz"]


@query(
    "f1_quaternion_product",
    f"WITH {QUATS} SELECT {HEAD}, {rnd(named('product', mul(Qq, Qp), WXYZ) | named('relative', mul(conj(Qq), Qp), WXYZ))} FROM q",
)
def f1_quaternion_product(spark, folder):
    q, p = F.col("q"), F.col("p")
    return out(quats(spark, folder), product=(Q.multiply(q, p), WXYZ), relative=(Q.multiply(Q.conjugate(q), p), WXYZ))


@query(
    "f2_log_exp",
    f"""WITH {QUATS}, l AS (SELECT *, sqrt(x*x + y*y + z*z) AS n FROM q),
    k AS (SELECT *, CASE WHEN n > 1e-12 THEN atan2(n, least(1.0, greatest(-1.0, w))) / n ELSE 0 END AS s FROM l)
    SELECT {HEAD}, {rnd({'log_x': 'x*s', 'log_y': 'y*s', 'log_z': 'z*s', 'back_w': 'w', 'back_x': 'x', 'back_y': 'y', 'back_z': 'z'})} FROM k""",
)
def f2_log_exp(spark, folder):
    q = quats(spark, folder).withColumn("l", Q.hold(Q.log_unit(F.col("q")), F.col("frame") >= 0))
    return out(q, log=(F.col("l"), XYZ), back=(Q.exp_pure(F.col("l")), WXYZ))


@query(
    "f3_shorter_arc",
    f"WITH {QUATS} SELECT {HEAD}, {rnd({f'arc_{c}': f'CASE WHEN w < 0 THEN -{c} ELSE {c} END' for c in WXYZ})} FROM q",
)
def f3_shorter_arc(spark, folder):
    return out(quats(spark, folder), arc=(Q.shorter_arc(F.col("q")), WXYZ))


LIFT = ["vx", "vy", "(vz + 9.81)"]


@query(
    "f4_rotate",
    f"""WITH {QUATS} SELECT {HEAD}, {rnd(named('turned', app(mat(Qq), V), XYZ) | named('back', app(mat(Qq), V, True), XYZ)
      | named('force', app(mat(Qq), LIFT, True), XYZ))} FROM q""",
)
def f4_rotate(spark, folder):
    q, v = F.col("q"), F.col("v")
    gravity = Q.vec(F.lit(0.0), F.lit(0.0), F.lit(-9.81))
    return out(
        quats(spark, folder),
        turned=(Q.rotate(q, v), XYZ),
        back=(Q.counter_rotate(q, v), XYZ),
        force=(Q.specific_force(v, q, gravity), XYZ),
    )


SLERP = f"""d AS (SELECT *, w*pw + x*px + y*py + z*pz AS raw FROM q),
a AS (SELECT *, acos(least(1.0, abs(raw))) AS th, abs(raw) > 1 - 1e-9 AS near, CASE WHEN raw < 0 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS sg FROM d),
k AS (SELECT *, CASE WHEN near THEN 0.7 ELSE sin(0.7 * th) / sin(th) END AS wa, sg * CASE WHEN near THEN 0.3 ELSE sin(0.3 * th) / sin(th) END AS wb FROM a),
o AS (SELECT take, frame, {', '.join(f'wa*{c} + wb*p{c} AS {c}' for c in WXYZ)} FROM k)"""


@query(
    "f5_slerp",
    f"WITH {QUATS}, {SLERP} SELECT {HEAD}, {rnd({f'mid_{c}': f'{c} / sqrt(w*w + x*x + y*y + z*z)' for c in WXYZ})} FROM o",
)
def f5_slerp(spark, folder):
    q = Q.with_slerp(quats(spark, folder).withColumn("t", F.lit(0.3)), {"mid": ("q", "p")}, "t")
    return out(q, mid=(F.col("mid"), WXYZ))


TRACE = " + ".join(f"{a}*{b}" for a, b in zip(mat(Qq), mat(Qp)))


@query(
    "f6_geodesic_angle",
    f"""WITH {QUATS} SELECT {HEAD}, round(degrees(2 * acos(least(1.0, abs(w*pw + x*px + y*py + z*pz)))), 4) + 0.0 AS by_dot,
    round(degrees(acos(greatest(-1.0, least(1.0, ({TRACE} - 1) / 2)))), 4) + 0.0 AS by_trace FROM q""",
)
def f6_geodesic_angle(spark, folder):
    q, p = F.col("q"), F.col("p")
    angle = Q.matrix_angle_deg(Q.to_matrix(q), Q.to_matrix(p))
    return quats(spark, folder).select(
        long("take").alias("take"), "frame", r6(Q.angle_deg(q, p), 4).alias("by_dot"), r6(angle, 4).alias("by_trace")
    )


M9 = [f"m{i}{j}" for i in range(3) for j in range(3)]


@query(
    "f7_matrix_round_trip",
    f"""WITH {QUATS} SELECT {HEAD}, {rnd(dict(zip([f'matrix_{c}' for c in M9], mat(Qq))) | {f'back_{c}': f'CASE WHEN w < 0 THEN -{c} ELSE {c} END' for c in WXYZ})} FROM q""",
)
def f7_matrix_round_trip(spark, folder):
    q = quats(spark, folder).withColumn("m", Q.hold(Q.to_matrix(F.col("q")), F.col("frame") >= 0))
    return out(Q.with_quaternion(q, "b", "m"), matrix=(F.col("m"), M9), back=(F.col("b"), WXYZ))


Mq = mat(Qq)


@query(
    "f8_heading",
    f"""WITH {QUATS} SELECT {HEAD}, {rnd({'heading': f'atan2({Mq[3]}, {Mq[0]})', 'twist': f'atan2({Mq[3]} - {Mq[1]}, {Mq[0]} + {Mq[4]})',
      'turn_w': 'cos(vx / 2)', 'turn_z': 'sin(vx / 2)'})} FROM q""",
)
def f8_heading(spark, folder):
    q = F.col("q")
    turn = Q.rotation_z(F.col("v")["x"])
    return out(
        quats(spark, folder),
        heading=(Q.heading(Q.to_matrix(q)), ""),
        twist=(Q.vertical_twist(q), ""),
        turn=(turn, "wz"),
    )


FRAME = """y1 AS (SELECT *, vx / n AS yx, vy / n AS yy, vz / n AS yz FROM (SELECT *, sqrt(vx*vx + vy*vy + vz*vz) AS n FROM q)),
x0 AS (SELECT *, ux - dp*yx AS ax, uy - dp*yy AS ay, uz - dp*yz AS az FROM (SELECT *, ux*yx + uy*yy + uz*yz AS dp FROM y1)),
x1 AS (SELECT *, ax / l AS xx, ay / l AS xy, az / l AS xz FROM (SELECT *, sqrt(ax*ax + ay*ay + az*az) AS l FROM x0)),
fr AS (SELECT *, xy*yz - xz*yy AS zx, xz*yx - xx*yz AS zy, xx*yy - xy*yx AS zz FROM x1)"""


@query(
    "f9_frame_from_axes",
    f"WITH {QUATS}, {FRAME} SELECT {HEAD}, {rnd({f'axes_m{i}{j}': f'{a}{c}' for i, c in enumerate(XYZ) for j, a in enumerate(XYZ)})} FROM fr",
)
def f9_frame_from_axes(spark, folder):
    return out(Q.with_frame_from_axes(quats(spark, folder), "axes", "v", "u"), axes=(F.col("axes"), M9))


@query(
    "f10_world_alignment",
    f"""WITH {QUATS}, h AS (SELECT *, vx / n AS a, vy / n AS b, vz / n AS c FROM (SELECT *, sqrt(vx*vx + vy*vy + vz*vz) AS n FROM q)),
    k AS (SELECT *, sqrt((1 - c)*(1 - c) + b*b + a*a) AS l FROM h)
    SELECT {HEAD}, {rnd({'turn_w': '(1 - c) / l', 'turn_x': '-b / l', 'turn_y': 'a / l', 'turn_z': '0.0::DOUBLE'})} FROM k""",
)
def f10_world_alignment(spark, folder):
    aligned = Q.with_shortest_to_axis(quats(spark, folder), "turn", "v", (0.0, 0.0, -1.0))
    return out(aligned, turn=(F.col("turn"), WXYZ))


@query(
    "f11_plate_load",
    f"""WITH {QUATS}, l AS (SELECT *, -vx AS fx, -vy AS fy, -vz AS fz, 0.1 AS ox, 0.2 AS oy, 0.3 AS oz FROM q),
    m AS (SELECT *, -(ux + oy*(-fz) - oz*(-fy)) AS nx, -(uy + oz*(-fx) - ox*(-fz)) AS ny, -(uz + ox*(-fy) - oy*(-fx)) AS nz, fz > 0.05 AS contact FROM l),
    c AS (SELECT *, CASE WHEN contact THEN -ny / fz END AS cx, CASE WHEN contact THEN nx / fz END AS cy FROM m)
    SELECT {HEAD}, contact, {rnd({'cop_x': 'cx', 'cop_y': 'cy', 'free_moment': 'nz - (cx*fy - cy*fx)'})},
      CASE WHEN NOT contact THEN -1 WHEN ((cx - ux)*(ux - vx) + (cy - uy)*(uy - vy)) > 0 THEN 10 ELSE 7 END::BIGINT AS body FROM c""",
)
def f11_plate_load(spark, folder):
    origin = Q.vec(F.lit(0.1), F.lit(0.2), F.lit(0.3))
    loaded = forces.plate_load(quats(spark, folder), force="v", moment="u", origin=origin, threshold=0.05)
    body = forces.receiving_body(ankle=F.col("v"), toe=F.col("u"), ankle_body=7, toe_body=10)
    return loaded.select(
        long("take").alias("take"),
        "frame",
        "contact",
        r6("cop_x").alias("cop_x"),
        r6("cop_y").alias("cop_y"),
        r6("free_moment").alias("free_moment"),
        long(body).alias("body"),
    )


@query(
    "f12_axis_components",
    f"""WITH {QUATS}, ax AS (SELECT *, {Mq[2]} AS ax1, {Mq[5]} AS ay1, {Mq[8]} AS az1, {mat(Qp)[1]} AS bx1, {mat(Qp)[4]} AS by1, {mat(Qp)[7]} AS bz1 FROM q),
    m AS (SELECT *, by1*az1 - bz1*ay1 AS cx1, bz1*ax1 - bx1*az1 AS cy1, bx1*ay1 - by1*ax1 AS cz1 FROM ax),
    n AS (SELECT *, sqrt(cx1*cx1 + cy1*cy1 + cz1*cz1) AS n FROM m)
    SELECT {HEAD}, {rnd({'on_x': 'vx*ax1 + vy*ay1 + vz*az1', 'on_y': 'CASE WHEN n > 1e-6 THEN (vx*cx1 + vy*cy1 + vz*cz1) / n END', 'on_z': 'vx*bx1 + vy*by1 + vz*bz1'})} FROM n""",
)
def f12_axis_components(spark, folder):
    here = F.col("frame") >= 0
    q = quats(spark, folder).withColumns(
        {"a": Q.hold(Q.to_matrix(F.col("q")), here), "b": Q.hold(Q.to_matrix(F.col("p")), here)}
    )
    first = Q.vec(*[F.col("a")[f"m{i}2"] for i in range(3)])
    third = Q.vec(*[F.col("b")[f"m{i}1"] for i in range(3)])
    return out(q, on=(Q.components(F.col("v"), first, third, 1e-6), XYZ))


DIFF = [f"({a} - {b})" for a, b in zip(V, U)]


@query(
    "f13_rigid_transform",
    f"""WITH {QUATS} SELECT {HEAD}, {rnd(named('local', app(mat(Qq), DIFF, True), XYZ) | named('world', [f'({a} + {b})' for a, b in zip(app(mat(Qq), V), U)], XYZ))} FROM q""",
)
def f13_rigid_transform(spark, folder):
    q, v, u = F.col("q"), F.col("v"), F.col("u")
    return out(quats(spark, folder), local=(Q.to_local(q, u, v), XYZ), world=(Q.to_world(q, u, v), XYZ))


# A small declared tree: node and parent.
TREE = ((0, None), (1, 0), (2, 0), (3, 1), (4, 3), (5, 2), (6, 5), (7, 5))


def tree_edges(spark):
    return spark.createDataFrame(list(TREE), "node int, parent int")


def local_rotations(spark, folder):
    """One local rotation per frame and tree node, from four embedding components each."""
    cells = [
        F.struct(
            F.lit(node).alias("node"),
            Q.normalise(Q.quat(*[F.col("embedding")[4 * node + i].cast("double") for i in range(4)])).alias("q"),
        )
        for node, _ in TREE
    ]
    e = table(spark, folder, "embeddings")
    raw = dense_frames(
        e.select("vec_id", F.col("label").alias("take"), F.array(*cells).alias("c")),
        keys=["take"],
        order=["vec_id"],
    )
    return raw.select(long("take").alias("take"), "frame", F.inline("c"))


def chain_sql() -> str:
    """Global rotations of the tree level by level in SQL."""
    def unit(node):
        cells = [f"embedding[{4 * node + i + 1}]::DOUBLE" for i in range(4)]
        length = "sqrt(" + " + ".join(f"{c}*{c}" for c in cells) + ")"
        return ", ".join(f"{c} / {length} AS l{node}{a}" for c, a in zip(cells, WXYZ))

    local = "c0 AS (SELECT label::BIGINT AS take, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame, "
    parts = [local + ", ".join(unit(n) for n, _ in TREE) + " FROM embeddings)"]
    last = "c0"
    for node, parent in TREE:
        own = q_(f"l{node}")
        cells = own if parent is None else mul(q_(f"g{parent}"), own)
        parts.append(f"t{node} AS (SELECT *, {', '.join(f'{c} AS g{node}{a}' for c, a in zip(cells, WXYZ))} FROM {last})")
        last = f"t{node}"
    rows = " UNION ALL ".join(
        f"SELECT take, frame, {n} AS node, {', '.join(f'round(g{n}{a}, 6) + 0.0 AS {a}' for a in WXYZ)} FROM {last}" for n, _ in TREE
    )
    return "WITH " + ", ".join(parts) + " " + rows


@query("f14_chain_composition", chain_sql())
def f14_chain_composition(spark, folder):
    closure = stats.tree_closure(tree_edges(spark), depth=4)
    found = rotations.compose_chain(local_rotations(spark, folder), closure, keys=["take", "frame"], node="node", q="q")
    return found.select("take", "frame", "node", *[r6(F.col("q")[c]).alias(c) for c in WXYZ])


@query(
    "f18_parent_relative",
    f"SELECT node, count(*) AS frames, 0.0::DOUBLE AS max_error FROM embeddings, (VALUES {', '.join(f'({n})' for n, _ in TREE)}) AS t(node) GROUP BY node",
)
def f18_parent_relative(spark, folder):
    """Locals rebuilt from the composed globals, against the locals they came from."""
    local = local_rotations(spark, folder)
    closure = stats.tree_closure(tree_edges(spark), depth=4)
    whole = rotations.compose_chain(local, closure, keys=["take", "frame"], node="node", q="q")
    again = rotations.parent_relative(whole, tree_edges(spark), keys=["take", "frame"], node="node", q="q")
    truth = local.withColumnRenamed("q", "truth")
    joined = again.join(truth, ["take", "frame", "node"])
    error = F.max(Q.angle_deg(F.col("q"), F.col("truth")))
    return joined.groupBy("node").agg(F.count(F.lit(1)).alias("frames"), r6(error, 3).alias("max_error"))
