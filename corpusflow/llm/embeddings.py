"""Exact metric range join of vectors by cosine, label by label.

Identical vectors are one class from the start (a point) and count by their number. On unit vectors a cosine of at least t is
a distance of at most e = sqrt(2 - 2t). Pivots partition a label's points: about sqrt(n) / PIVOT_ROOT of them, by hash order; a point
lies in the cell of its nearest pivot, c, and is stored there, once. By the triangle inequality it can have links to points of
the cell of another pivot, p, only if its distance to p is at most the cell's radius + e, and at most 2e more than to c. It visits
the cells of smaller number for which both hold, so that a pair of cells is looked at from one side.

Then cells are joined independently: each with itself and with its visitors. What visits is stored as cell numbers beside the
point; the vectors themselves are sent in waves of about WAVE times the points, and a wave's shuffle files go before the next one, so
that disk holds the points and some copies of them, whatever the vectors look like. A cell or its visitors beyond GROUP_VALUES numbers
are dealt by hash to blocks, which meet two by two. Where blocks meet, pivots of their own part them again, what is left is
compared by its first HEAD components and the length of the rest, which bound the cosine from above, then by all components,
both in single precision with a margin for rounding; what is that near the threshold, in double precision.

A label may hold most rows: it only gets more cells. Where vectors have no cluster structure, most points visit most cells, as in
any exact metric method on such data: that costs work and traffic, not disk.

Cases: null labels and ids, and vectors that are null, zero, or hold null or non-finite components, link with
nothing; vectors of different lengths link with nothing; each row that repeats an id is a vector with links of
its own, rows of the same id included, and the rows of an id share a component; an empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from corpusflow.llm.common import collected, drop_saved, place, save
from corpusflow.llm.components import components

THRESHOLD, CELL_ROWS, PART_ROWS, STRIP = 0.93, 1_024, 8_192, 1_024
#: The share of sqrt(n) that is pivots, their most for a label, and the rows that a wave sends, by the points.
PIVOT_ROOT, MOST_PIVOTS, WAVE = 16, 1_024, 1.5
#: Numbers in a block of vectors (131,072 vectors of 64), components of a head, and pairs that are looked at or tied at once.
GROUP_VALUES, HEAD, PAIRS = 1 << 23, 24, 1 << 16
#: Margin of the distance bounds against rounding.
SLACK = 1e-7


def _unit(x: np.ndarray) -> np.ndarray:
    """The rows, divided by their lengths in double precision; rows that have no direction hold no finite number."""
    with np.errstate(all="ignore"):
        x = x.astype("<f8")
        x /= np.abs(x).max(axis=1, keepdims=True)
        return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _pack(vectors: DataFrame, label: str, plain: bool = False) -> DataFrame:
    """(vec_id, space, digest, body) of every row: space is length and label, body the vector divided by its length as
    bytes of doubles; all three are null for a vector that links with nothing. plain: floats stay as they are, in half the bytes."""
    import hashlib

    kind = vectors.schema["vec_id"].dataType.simpleString()
    kept = "<f4" if plain and isinstance(vectors.schema["embedding"].dataType.elementType, FloatType) else None

    def run(batches):
        for b in batches:
            ids, labels, lists = b.column("vec_id"), b.column("label").to_pylist(), b.column("embedding")
            values = lists.flatten().cast(pa.float32() if kept else pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
            lengths = pa.compute.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
            starts = np.cumsum(lengths) - lengths
            out = [(None, None, None)] * b.num_rows
            named = ids.is_valid().to_numpy(zero_copy_only=False) & np.array([x is not None for x in labels], dtype=bool)
            for n in np.unique(lengths[named & (lengths > 0)]).tolist():
                at = np.flatnonzero(named & (lengths == n))
                held = values[starts[at][:, None] + np.arange(n)]
                unit = _unit(held)
                usable = np.isfinite(unit).all(axis=1)
                held = held.astype(kept) if kept else unit
                for i in np.flatnonzero(usable):
                    out[at[i]] = (f"{n}:{labels[at[i]]}", hashlib.blake2b(unit[i].tobytes(), digest_size=16).hexdigest(), held[i].tobytes())
            cols = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([ids, pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.binary())], names=["vec_id", "space", "digest", "body"])

    wanted = vectors.select("vec_id", F.col(label).cast("string").alias("label"), "embedding")
    return wanted.mapInArrow(run, f"vec_id {kind}, space string, digest string, body binary")


def _units(t: pa.Table, dim: int) -> np.ndarray:
    """The vectors of the bodies, divided by their lengths in double precision."""
    raw = [x.as_py() for x in t["body"]]
    return _unit(np.stack([np.frombuffer(x, dtype="<f4" if len(x) == 4 * dim else "<f8") for x in raw])) if raw else np.empty((0, dim))


def _pivots(points: DataFrame, sizes: DataFrame) -> DataFrame:
    """(space, pivot, body): of each space of sizes (space, n, m) m of its points, by hash order."""
    unit = F.pmod(F.xxhash64("digest", F.lit(7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    few = points.join(sizes, "space").where(unit <= 4.0 * (F.col("m") + 4) / F.col("n")).select("space", "m", F.struct(unit.alias("unit"), "body").alias("candidate"))
    picked = few.groupBy("space", "m").agg(F.sort_array(F.collect_list("candidate")).alias("c"))
    return picked.select("space", F.posexplode(F.slice("c", F.lit(1), F.col("m"))).alias("pivot", "c")).select("space", "pivot", F.col("c.body").alias("body"))


def _with_pivots(points: DataFrame, pivots: DataFrame, sizes: DataFrame, function, schema: str) -> DataFrame:
    """Rows that function makes of a part of a space's points (about PART_ROWS) and all pivots of the space.

    function(space, points, pivots) gets Arrow tables; the pivots are copied to each part, so no row carries them.
    """
    parts = sizes.select("space", F.ceil(F.col("n") / PART_ROWS).cast("int").alias("n_parts"))
    dealt = points.join(parts, "space").withColumn("part", F.pmod(F.xxhash64("digest"), F.col("n_parts")).cast("int")).drop("n_parts")
    copied = pivots.join(parts, "space").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1))).drop("n_parts")

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return function(key[0].as_py(), left, right.sort_by("pivot"))

    return dealt.groupBy("space", "part").cogroup(copied.groupBy("space", "part")).applyInArrow(run, schema)


def _distances(space: str, points: pa.Table, pivots: pa.Table) -> np.ndarray:
    dim = int(space.split(":")[0])
    if not len(pivots):  # the hash sample of a space was empty: all its points lie in one cell
        return np.zeros((len(points), 1))
    return np.sqrt(np.maximum(0, 2 - 2 * (_units(points, dim) @ _units(pivots, dim).T)))


def locate(points: DataFrame, e: float, root: float = PIVOT_ROOT) -> DataFrame:
    """The points (space, digest, pid, rep, weight, body) with cell, the number of the nearest pivot, and visits, the smaller numbers of
    the cells in which the triangle inequality leaves room for links."""
    sizes = points.groupBy("space").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("m", F.least(F.lit(MOST_PIVOTS), F.ceil(F.sqrt("n") / root)).cast("int")).where("m > 1")
    sizes = save(sizes, "sizes", tidy=True)
    pivots = save(_pivots(points, sizes), "pivots", tidy=True)

    def radius(space: str, t: pa.Table, p: pa.Table) -> pa.Table:
        d = _distances(space, t, p)
        own = d.argmin(axis=1)
        cells = np.unique(own)
        return pa.table({"space": pa.array([space] * len(cells), pa.string()), "pivot": pa.array(cells, pa.int32()), "r": pa.array([float(d[own == c, c].max()) for c in cells], pa.float64())})

    radii = _with_pivots(points.select("space", "digest", "body"), pivots, sizes, radius, "space string, pivot int, r double").groupBy("space", "pivot").agg(F.max("r").alias("r"))
    known = save(pivots.join(radii, ["space", "pivot"], "left"), "radii", tidy=True)
    names = ["digest", "pid", "rep", "weight", "body"]
    kinds = ", ".join(f"{c} {points.schema[c].dataType.simpleString()}" for c in names)

    def deal(space: str, t: pa.Table, p: pa.Table) -> pa.Table:
        d = _distances(space, t, p)
        own = d.argmin(axis=1)
        r = p["r"].fill_null(-np.inf).to_numpy() if len(p) else np.zeros(1)
        visit = (d <= r + e + SLACK) & (d <= d.min(axis=1)[:, None] + 2 * e + SLACK) & (np.arange(d.shape[1]) < own[:, None])
        offsets = np.concatenate([[0], np.cumsum(visit.sum(axis=1))])
        visits = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.nonzero(visit)[1], pa.int32()))
        return pa.table({"space": pa.array([space] * len(t), pa.string()), **{c: t[c] for c in names}, "cell": pa.array(own, pa.int32()), "visits": visits})

    schema = f"space string, {kinds}, cell int, visits array<int>"
    small = points.join(sizes.select("space"), "space", "left_anti").select("space", *names, F.lit(0).alias("cell"), F.array().cast("array<int>").alias("visits"))
    return _with_pivots(points.select("space", *names), known, sizes, deal, schema).union(small)


def _tie(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Unite the classes of i and j, pair by pair; parent holds each place's smallest one, before and after."""
    while len(i):
        p, q = parent[i], parent[j]
        apart = p != q
        i, j, p, q = i[apart], j[apart], p[apart], q[apart]
        np.minimum.at(parent, np.maximum(p, q), np.minimum(p, q))
        while (up := parent[parent]).tobytes() != parent.tobytes():
            parent[:] = up


def _links(left: pa.Table, right: pa.Table | None, dim: int, threshold: float, cell_rows: int) -> pa.Table:
    """Links between two groups of points, or within one: (pid, with) that ties what is linked, and n, the rows near each point."""
    tables = [left] if right is None else [left, right]
    if not all(map(len, tables)):
        return pa.table({"pid": pa.array([], pa.int64()), "with": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    raw = []
    for t in tables:
        data = b"".join(t["body"].to_pylist())
        raw.append(np.frombuffer(data, dtype="<f4" if len(data) == 4 * dim * len(t) else "<f8").reshape(-1, dim))
    pids, weight = ([t[c].to_numpy() for t in tables] for c in ("pid", "weight"))
    units = [np.concatenate([_unit(x[k : k + PAIRS]).astype("<f4") for k in range(0, len(x), PAIRS)]) for x in raw]
    margin, e = (dim + 16) * 3e-7, np.sqrt(max(0.0, 2 - 2 * threshold))
    # both sides by their nearest pivot of the left
    pivots = units[0][np.linspace(0, len(left) - 1, -(-len(left) // cell_rows)).astype(np.int64)]
    order, own = [], []
    for x in units:
        nearest = np.concatenate([(x[k : k + STRIP] @ pivots.T).argmax(axis=1) for k in range(0, len(x), STRIP)])
        order.append(np.argsort(nearest, kind="stable"))
        own.append(nearest[order[-1]])
    raw, units, pids, weight = ([x[o] for x, o in zip(xs, order)] for xs in (raw, units, pids, weight))
    cuts = np.searchsorted(own[0], np.arange(len(pivots) + 1))
    radius = np.array([np.sqrt(max(0.0, 2 - 2 * float((units[0][a:b] @ p).min())) + 2 * margin) if b > a else -np.inf for p, a, b in zip(pivots, cuts[:-1], cuts[1:])])
    reach = np.where(np.isfinite(radius), (radius + e) ** 2, -np.inf) + 2 * margin
    heads = [np.column_stack([x[:, :HEAD], np.sqrt((x[:, HEAD:] ** 2).sum(axis=1))]) for x in units] if dim >= 2 * HEAD else None
    a, b, first = units[0], units[-1], 0 if right is None else len(left)
    n = [np.zeros(len(x), dtype=np.int64) for x in units]
    parent, waiting, held = np.arange(sum(map(len, units))), [], 0

    def exact(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which of the pairs link."""
        parts = [(_unit(raw[0][i[k : k + PAIRS // 4]]) * _unit(raw[-1][j[k : k + PAIRS // 4]])).sum(axis=1) >= threshold for k in range(0, len(i), PAIRS // 4)]
        return np.concatenate(parts) if parts else np.empty(0, dtype=bool)

    for at in range(0, len(b), STRIP):
        visits = 2 - 2 * (b[at : at + STRIP] @ pivots.T) <= reach
        for c in np.flatnonzero(visits.any(axis=0)):
            rows, mates = np.arange(cuts[c], cuts[c + 1]), at + np.flatnonzero(visits[:, c])
            few = None
            if heads:
                few = np.flatnonzero(heads[0][rows[0] : rows[-1] + 1] @ heads[-1][mates].T >= threshold - margin)
            if few is not None and len(few) * 50 <= len(rows) * len(mates):
                i, j = rows[few // len(mates)], mates[few % len(mates)]
                near = exact(i, j) & ((i != j) if right is None else True)
                i, j = i[near], j[near]
                np.add.at(n[0], i, weight[-1][j])
                if right is not None:
                    np.add.at(n[1], j, weight[0][i])
            else:
                s = a[rows[0] : rows[-1] + 1] @ b[mates].T
                near = s >= threshold + margin
                i, j = np.nonzero((s >= threshold - margin) & ~near)
                near[i, j] = exact(rows[i], mates[j])
                if right is None:
                    near &= rows[:, None] != mates[None, :]
                n[0][rows] += near @ weight[-1][mates]
                if right is not None:
                    n[1][mates] += weight[0][rows] @ near
                i, j = np.nonzero(near & (parent[rows][:, None] != parent[first + mates][None, :]))
                i, j = rows[i], mates[j]
            if len(i):
                waiting.append((i, first + j))
                held += len(i)
            if held > PAIRS:
                _tie(parent, *map(np.concatenate, zip(*waiting)))
                waiting, held = [], 0
    if waiting:
        _tie(parent, *map(np.concatenate, zip(*waiting)))
    n, pids = np.concatenate(n), np.concatenate(pids)
    linked = np.flatnonzero(n)
    return pa.table({"pid": pa.array(pids[linked]), "with": pa.array(pids[parent[linked]]), "n": pa.array(n[linked])})


def cell_links(located: DataFrame, threshold: float, cell_rows: int = CELL_ROWS, block_rows: int | None = None, wave: float = WAVE) -> DataFrame:
    """Links of located points: (pid, with) that ties what is linked, and n, the rows near each point; in several rows a point.

    A cell's points are dealt to `mine` blocks and its visitors to `theirs`. A unit of work is a block a and a step s: in step 0 block a
    with itself, in step s with block a + s (where that is half the way round, from one side only), and in each with block s of
    the visitors. Units are dealt to waves by hash."""
    dim = F.split("space", ":")[0].cast("int")
    most = F.greatest(F.lit(1), F.lit(GROUP_VALUES) / dim) if block_rows is None else F.lit(block_rows)
    own = located.groupBy("space", "cell").agg(F.count("*").alias("n_own"))
    guests = located.select("space", F.explode("visits").alias("cell")).groupBy("space", "cell").agg(F.count("*").alias("n_guests"))
    cells = own.join(guests, ["space", "cell"], "left").fillna(0, ["n_guests"]).withColumns({"mine": F.ceil(F.col("n_own") / most).cast("int"), "theirs": F.ceil(F.col("n_guests") / most).cast("int")})
    cells = save(cells.withColumn("steps", F.greatest(F.floor(F.col("mine") / 2).cast("int") + 1, "theirs")), "cells", tidy=True)
    sent = F.col("n_own") * (F.col("steps") + F.floor(F.col("mine") / 2)) + F.col("n_guests") * F.col("mine")
    rows, points = cells.agg(F.coalesce(F.sum(sent), F.lit(0)), F.coalesce(F.sum("n_own"), F.lit(0))).first()
    n_waves = max(1, -int(-rows // max(1, wave * points)))
    cells = cells.select("space", "cell", "mine", "theirs", "steps")
    held = located.join(cells, ["space", "cell"]).withColumn("i", F.pmod(F.xxhash64("pid"), "mine").cast("int"))
    visiting = located.select("space", F.explode("visits").alias("cell"), "pid", "weight", "body").join(cells, ["space", "cell"]).withColumn("j", F.pmod(F.xxhash64("pid", F.lit(3)), "theirs").cast("int"))
    unit = lambda a, s: F.struct(a.cast("int").alias("a"), s.cast("int").alias("s"))
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def join(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by("pid")
        role = t["role"].to_numpy()
        mine, other, guests = (t.filter(pa.array(role == k)) for k in range(3))
        n = int(key[0].as_py().split(":")[0])
        out = [_links(mine, None, n, threshold, cell_rows)] if key[3].as_py() == 0 else [_links(mine, other, n, threshold, cell_rows)]
        return pa.concat_tables([*out, _links(mine, guests, n, threshold, cell_rows)])

    path, found = place(located.sparkSession, "links"), None
    for w in range(n_waves):
        now = lambda u: F.pmod(F.xxhash64("space", "cell", u["a"], u["s"]), F.lit(n_waves)) == w  # noqa: E731,B023
        lefts = F.transform(upto(F.col("steps")), lambda s: unit(F.col("i"), s))
        half = F.floor(F.col("mine") / 2).cast("int")
        rights = F.filter(F.transform(upto(half), lambda s: unit(F.pmod(F.col("i") - s - 1, F.col("mine")), s + 1)), lambda u: (2 * u["s"] < F.col("mine")) | (u["a"] < u["s"]))
        meets = F.transform(upto(F.col("mine")), lambda a: unit(a, F.col("j")))
        send = lambda df, units, role: df.select("space", "cell", F.explode(F.filter(units, now)).alias("u"), F.lit(role).alias("role"), "pid", "weight", "body")  # noqa: E731,B023
        sent = send(held, lefts, 0).union(send(held, rights, 1)).union(send(visiting, meets, 2))
        sent = sent.select("space", "cell", "u.a", "u.s", "role", "pid", "weight", "body")
        found = save(sent.groupBy("space", "cell", "a", "s").applyInArrow(join, "pid long, with long, n long"), "links", tidy=True, into=path)
    return found


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, label: str = "label", cell_rows: int = CELL_ROWS, block_rows: int | None = None, root: float = PIVOT_ROOT) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of vectors (vec_id, label, embedding); block_rows: rows of a block, about."""
    rows = _pack(vectors, label, plain=True)
    keys = save(rows.select("vec_id", "space", "digest"), "vectors")  # without their bodies, which only points hold
    usable = keys.where("digest is not null")
    points = rows.where("body is not null").groupBy("space", "digest").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.first("body").alias("body"))
    with collected() as unplaced:
        points = save(points.withColumn("pid", F.monotonically_increasing_id()), "points", tidy=True)
    points = save(locate(points, float(np.sqrt(max(0.0, 2 - 2 * threshold))), root), "located", tidy=True)
    drop_saved(vectors.sparkSession, unplaced)  # the located points are all of them
    found = cell_links(points, threshold, cell_rows, block_rows)
    n_links = found.groupBy("pid").agg(F.sum("n").alias("n"))
    of_row = save(usable.join(points.select("space", "digest", "pid"), ["space", "digest"]).select("vec_id", "pid"), "row-points", tidy=True)
    several = of_row.groupBy("vec_id").agg(F.min("pid").alias("low"), F.max("pid").alias("high")).where("low != high").select("vec_id", "low")
    tied = of_row.join(save(several, "repeated-ids", tidy=True), "vec_id").select(F.col("pid").alias("a"), F.col("low").alias("b"))
    classes = save(components(found.where("pid != with").select(F.col("pid").alias("a"), F.col("with").alias("b")).union(tied), alone=False), "components", tidy=True)
    names = save(classes.join(points.select(F.col("pid").alias("id"), "rep"), "id").groupBy("component").agg(F.min("rep").alias("name")), "component-names", tidy=True)
    named = classes.join(names, "component").select(F.col("id").alias("pid"), "name")
    per = points.select("pid", "rep", "weight").join(n_links, "pid", "left").join(named, "pid", "left")
    per = per.select("pid", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("name", "rep").alias("component_id"))
    linked = of_row.join(save(per, "per-point", tidy=True), "pid").select("vec_id", "n_links", "component_id")
    ids = linked.select(F.col("vec_id").alias("_id"), "component_id").distinct()
    lone = keys.where("digest is null").select("vec_id").join(ids, F.col("vec_id") == F.col("_id"), "left")
    out = linked.union(lone.select("vec_id", F.lit(0).cast("long"), F.coalesce("component_id", "vec_id")))
    return out.select("vec_id", "n_links", "component_id", F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)).alias("kept"))
