"""Exact top-k search by inner product of integer vectors, block at a time under bounds.

Components become integers, floor(scale * x). Every dimension is a pair of terms (its positive and its negative weights), so
a block's maximum and minimum of each dimension bound what it can add to a query's score; their sum bounds the block.

Vectors are indexed in shards: the nearest of a bounded number of pivots gives the cell, and a cell of many vectors is dealt
by hash. Within a shard vectors are put in an order that keeps neighbours together (halved again and again at the median of
the dimension that varies most) and cut into blocks of BLOCK consecutive ones: a row with each block's term maxima and its
forward index, the vectors themselves. A search has two waves. First each query is answered by its own vector's shard,
which gives a first k-th score. Then queries meet the block maxima of all shards; a query goes to the shards of which some
block's bound reaches its k-th score. In a shard a query takes blocks by falling bound, in rounds that double, until the
bounds are below its k-th score so far. Bounds equal to it are looked at, as ties go to smaller ids.

What work is saved depends on the vectors: near neighbours in clusters leave most blocks out, vectors spread evenly over many
dimensions hardly any, and then the rounds are products of whole blocks.

Scores are exact: products are made in single or double precision where no sum can leave the integers that these hold, and
with Python's integers elsewhere.

Equal vectors: the index keeps the k + 1 smallest ids of each distinct vector, as no query can return more, and equal queries
are answered once. So a vector that a third of the rows have is neither a hot key nor searched more than once.

Cases: null vectors and those that hold null or non-finite components (also after scaling) take no part; vectors of
different lengths are not compared, empty ones score 0 with each other; rows that repeat an id are vectors each, and a query
row is left out of its own answer only, so it can return a row of its own id; a row with a null id is no query and comes last among ties;
scores beyond a long are ranked exactly and returned as the nearest long; an empty table, or one without queries, gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import save

BLOCK = 64
#: Numbers in a shard or in a group of queries (16,384 vectors of 64), numbers in all pivots and their count at most.
SHARD_VALUES, PIVOT_VALUES, MOST_PIVOTS = 1 << 20, 1 << 19, 256
#: Integers up to these are exact in single and double precision.
EXACT_4, EXACT_8 = 1 << 24, 1 << 53
LONG = (1 << 63) - 1


def _integers(vectors: DataFrame, is_query: Column, scale: float, id: str, vector: str) -> DataFrame:
    """(id, mine, dim, body): integer components as bytes, of 4-byte floats where these hold them, else of 8-byte ones."""

    def run(batches):
        for b in batches:
            lists = b.column("vector")
            values = lists.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
            lengths = pa.compute.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            with np.errstate(over="ignore", invalid="ignore"):
                values = np.floor(values * scale) + 0.0
            good = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            usable = (good[ends] == good[ends - lengths]) & lists.is_valid().to_numpy(zero_copy_only=False)
            bodies: list[bytes | None] = [None] * b.num_rows
            for i in np.flatnonzero(usable):
                v = values[ends[i] - lengths[i] : ends[i]]
                bodies[i] = v.astype("<f4" if np.abs(v).max(initial=0) <= EXACT_4 else "<f8").tobytes()
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("mine"), pa.array(lengths, pa.int32()), pa.array(bodies, pa.binary())], names=["id", "mine", "dim", "body"])

    wanted = vectors.select(F.col(id).alias("id"), F.coalesce(is_query, F.lit(False)).alias("mine"), F.col(vector).cast("array<double>").alias("vector"))
    kind = vectors.schema[id].dataType.simpleString()
    return wanted.mapInArrow(run, f"id {kind}, mine boolean, dim int, body binary").where("body is not null")


def _matrix(bodies: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """The vectors as rows, in single precision if all of them are held so."""
    parts = [np.frombuffer(x, dtype="<f4" if len(x) == 4 * dim else "<f8") if dim else np.empty(0, "<f4") for x in bodies.to_pylist()]
    return np.stack(parts) if parts else np.empty((0, dim), "<f4")


def _neighbours(x: np.ndarray, block: int) -> np.ndarray:
    """An order of the rows in which each run of `block` ones lies in a small box."""
    todo, out = [np.arange(len(x))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= block or not x.shape[1]:
            out.append(rows)
            continue
        d = int((x[rows].max(axis=0) - x[rows].min(axis=0)).argmax()) if len(rows) < 4 * block else int(x[rows].astype("f8").std(axis=0).argmax())
        half = (len(rows) // 2 + block - 1) // block * block  # so that blocks are full
        rows = rows[np.argpartition(x[rows, d], half - 1)]
        todo += [rows[half:], rows[:half]]
    return np.concatenate(out)


def _cells(points: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """The points with the nearest pivot of their dimension as `cell`."""

    def run(batches):
        for b in batches:
            dims = b.column("dim").to_numpy()
            cell = np.zeros(b.num_rows, dtype=np.int32)
            for d in np.unique(dims):
                p, rows = pivots.get(int(d)), np.flatnonzero(dims == d)
                if p is not None and d:
                    x = _matrix(b.column("body").take(pa.array(rows)), int(d)).astype("f8")
                    x /= np.maximum(1, np.abs(x).max(axis=1, keepdims=True))
                    cell[rows] = (x @ p.T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int32())], names=[*b.schema.names, "cell"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema)
    return points.mapInArrow(run, f"{fields}, cell int")


def _blocks(points: DataFrame, block: int, kind: str) -> DataFrame:
    """A row per block of each shard (dim, cell, part): its term maxima and minima, its ids and its forward index."""

    def run(key: tuple, t: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        t = t.sort_by("rid")
        x = _matrix(t["body"], dim)
        order = _neighbours(x, block)
        x, t = x[order], t.take(pa.array(order))
        cuts = list(range(0, len(x), block))
        held = [x[c : c + block] for c in cuts]
        return pa.table({
            "dim": pa.array([dim] * len(cuts), pa.int32()), "cell": pa.array([key[1].as_py()] * len(cuts), pa.int32()), "part": pa.array([key[2].as_py()] * len(cuts), pa.int32()),
            "block": pa.array(range(len(cuts)), pa.int32()), "n": pa.array([len(h) for h in held], pa.int32()),
            "most": pa.array([h.max(axis=0).tobytes() for h in held], pa.binary()), "least": pa.array([h.min(axis=0).tobytes() for h in held], pa.binary()),
            "rids": pa.array([t["rid"][c : c + block].to_pylist() for c in cuts], pa.list_(pa.int64())), "ids": pa.array([t["id"][c : c + block].to_pylist() for c in cuts], pa.list_(t.schema.field("id").type)),
            "forward": pa.array([h.tobytes() for h in held], pa.binary()),
        })

    return points.groupBy("dim", "cell", "part").applyInArrow(run, f"dim int, cell int, part int, block int, n int, most binary, least binary, rids array<long>, ids array<{kind}>, forward binary")


def _exact(dim: int, *matrices: np.ndarray) -> list[np.ndarray]:
    """The matrices in a type in which every sum of dim products of theirs is exact."""
    most = max(1, dim)
    for m in matrices:
        most *= max(1, int(np.abs(m).max(initial=0)))
    if most <= EXACT_8:
        return [m.astype("<f4" if most <= EXACT_4 else "<f8") for m in matrices]
    return [np.array([[int(v) for v in row] for row in m], dtype=object).reshape(m.shape) for m in matrices]


def _bounds(q: np.ndarray, most: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For each query and block the sum of what its terms add at most."""
    none = q * 0
    return np.maximum(q, none) @ most.T + np.minimum(q, none) @ least.T


def _best(row: np.ndarray, score: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Indices of each row's k best by score, then by place, row after row."""
    if score.dtype == object:
        order = np.array(sorted(range(len(row)), key=lambda i: (row[i], -score[i], place[i])), dtype=np.int64)
    else:
        order = np.lexsort((place, -score, row))
    at = row[order]
    first = np.concatenate([[True], at[1:] != at[:-1]]) if len(at) else np.empty(0, bool)
    nth = np.arange(len(at)) - np.maximum.accumulate(np.where(first, np.arange(len(at)), 0)) if len(at) else at
    return order[nth < k]


def block_search(q: np.ndarray, kth: list, most: np.ndarray, least: np.ndarray, forward: np.ndarray, start: np.ndarray, place: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query, vector, score, blocks looked at) of the k best vectors of each query that reach its k-th score so far (None: none yet).

    start: the first vector of each block, and the end; place: each vector's place among ties."""
    q, held = _exact(q.shape[1], q, np.concatenate([most, least, forward]))
    most, least, forward = np.split(held, [len(most), len(most) + len(least)])
    bounds = _bounds(q, most, least)
    order = np.argsort(-bounds, axis=1, kind="stable")
    floor = np.array([-np.inf if x is None else x for x in kth], dtype=q.dtype if q.dtype == object else "f8")
    next_, active, take, looked = np.zeros(len(q), dtype=np.int64), np.arange(len(q)), 1, 0
    best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, q.dtype))
    while len(active):
        ranks = next_[active][:, None] + np.arange(take)
        inside = ranks < len(most)
        rows, column = np.nonzero(inside)
        rows, blocks = active[rows], order[active[rows], ranks[rows, column]]
        wanted = bounds[rows, blocks] >= floor[rows]
        rows, blocks = rows[wanted], blocks[wanted]
        by_block = np.argsort(blocks, kind="stable")
        rows, blocks = rows[by_block], blocks[by_block]
        looked += len(rows)
        found = [best]
        cuts = np.flatnonzero(np.diff(blocks, prepend=-1))
        for a, z in zip(cuts, [*cuts[1:], len(blocks)]):
            at, b = rows[a:z], blocks[a]
            s = q[at] @ forward[start[b] : start[b + 1]].T
            i, j = np.nonzero(s >= floor[at][:, None])
            found.append((at[i], start[b] + j, s[i, j]))
        best = tuple(np.concatenate(x) for x in zip(*found))
        keep = _best(best[0], best[2], place[best[1]], k)
        best = tuple(x[keep] for x in best)
        full = np.flatnonzero(np.bincount(best[0], minlength=len(q)) >= k)
        lows = np.searchsorted(best[0], full, side="right") - 1
        floor[full] = np.maximum(floor[full], best[2][lows])
        next_[active] += take
        take *= 2
        active = active[next_[active] < len(most)]
        active = active[bounds[active, order[active, next_[active]]] >= floor[active]]
    return *best, looked


def _over(score: int) -> bytes:
    """A key that orders scores beyond a long among themselves, and after (before) the long nearest to them."""
    if -LONG - 1 <= score <= LONG:
        return b"\1"
    digits = abs(score).to_bytes((abs(score).bit_length() + 7) // 8, "big")
    key = len(digits).to_bytes(4, "big") + digits
    return b"\2" + key if score > 0 else b"\0" + bytes(255 - x for x in key)


def _ordered(ids: list) -> np.ndarray:
    """The place of each id among all, nulls last."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0))
    place = np.empty(len(ids), dtype=np.int64)
    place[order] = np.arange(len(ids))
    return place


def _search(blocks: DataFrame, queries: DataFrame, keys: list[str], k: int, kind: str) -> DataFrame:
    """(qid, rid, id, score, over) of each query's k best in each shard that it goes to; queries (qid, body, kth, *keys),
    where kth is a string, as a score may pass a long."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out: tuple = ([], [], [], [], [])
        if len(left) and len(right):
            left, right = left.sort_by("block"), right.sort_by("qid")
            dim = key[0].as_py()
            ids, rids = ([x for row in left[c].to_pylist() for x in row] for c in ("ids", "rids"))
            start = np.concatenate([[0], np.cumsum(left["n"].to_numpy())])
            forward = np.concatenate([np.frombuffer(f, dtype="<f4" if len(f) == 4 * dim * n else "<f8").reshape(n, dim) if dim else np.empty((n, 0), "<f4") for f, n in zip(left["forward"].to_pylist(), left["n"].to_pylist())])
            kth = [None if x is None else int(x) for x in right["kth"].to_pylist()]
            row, col, score, _ = block_search(_matrix(right["body"], dim), kth, _matrix(left["most"], dim), _matrix(left["least"], dim), forward, start, _ordered(ids), k)
            qids = right["qid"].to_pylist()
            exact = [int(s) for s in score]
            out = ([qids[i] for i in row], [rids[j] for j in col], [ids[j] for j in col], exact, [str(s) for s in exact])
        return pa.table({
            "qid": pa.array(out[0], pa.int64()), "rid": pa.array(out[1], pa.int64()), "id": pa.array(out[2], id_type),
            "score": pa.array([max(-LONG - 1, min(LONG, s)) for s in out[3]], pa.int64()), "over": pa.array(map(_over, out[3]), pa.binary()), "exact": pa.array(out[4], pa.string()),
        })

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(blocks.schema["ids"].dataType.elementType)
    return blocks.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(run, f"qid long, rid long, id {kind}, score long, over binary, exact string")


def _ranked(found: DataFrame, by: str, k: int) -> DataFrame:
    """Each `by`'s k best with their rank."""
    order = (F.col("score").desc(), F.col("over").desc(), F.col("id").asc_nulls_last(), F.col("rid"))
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, id: str = "vec_id", vector: str = "embedding", block: int = BLOCK, shard_values: int = SHARD_VALUES) -> DataFrame:
    """(query_id, rank int, <id>, score long): for each row where is_query holds, its k best other rows."""
    kind = vectors.schema[id].dataType.simpleString()
    rows = save(_integers(vectors, is_query & F.col(id).isNotNull(), scale, id, vector).withColumn("rid", F.monotonically_increasing_id()), "integers", tidy=True)
    some = Window.partitionBy("dim", "body").orderBy(F.col("id").asc_nulls_last(), "rid")
    held = rows.withColumn("nth", F.row_number().over(some)).where(F.col("nth") <= k + 1).select("rid", "id", "dim", "body")
    n_values, most_dim = rows.agg(F.coalesce(F.sum(F.col("dim") + 1), F.lit(0)), F.max("dim")).first()
    # a bounded sample: as many pivots as there are shards, MOST_PIVOTS at most, by hash order
    n_pivots = max(1, min(MOST_PIVOTS, PIVOT_VALUES // max(1, most_dim or 1), -(-n_values // shard_values)))
    picked = rows.select("dim", "body").orderBy(F.xxhash64("body"), "body").limit(n_pivots).collect() if n_pivots > 1 else []
    pivots: dict[int, np.ndarray] = {}
    for d in {r.dim for r in picked if r.dim}:
        x = np.unique(_matrix(pa.array([bytes(r.body) for r in picked if r.dim == d], pa.binary()), d).astype("f8"), axis=0)
        x /= np.maximum(1, np.abs(x).max(axis=1, keepdims=True))
        pivots[d] = x / np.maximum(1e-300, np.sqrt((x * x).sum(axis=1, keepdims=True)))
    points = save(_cells(held, pivots), "points", tidy=True)
    sizes = points.groupBy("dim", "cell").agg(F.ceil(F.count("*") * (F.col("dim") + 1) / shard_values).cast("int").alias("parts"))
    dealt = points.join(sizes, ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("body"), "parts").cast("int"))
    blocks = save(_blocks(dealt.drop("parts"), block, kind), "blocks", tidy=True)

    # queries are those rows' distinct vectors; each has a home, the shard that holds its vector
    asked = rows.where("mine")
    queries = _cells(asked.groupBy("dim", "body").agg(F.min("rid").alias("qid")), pivots)
    queries = queries.join(sizes, ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("body"), "parts").cast("int")).drop("parts")
    queries = save(queries, "queries", tidy=True)
    n_groups = max(1, -(-int(queries.agg(F.coalesce(F.sum(F.col("dim") + 1), F.lit(0))).first()[0]) // shard_values))
    shard = ["dim", "cell", "part"]
    first = save(_search(blocks, queries.withColumn("kth", F.lit(None).cast("string")), shard, k + 1, kind), "first-wave", tidy=True)
    kth = _ranked(first, "qid", k + 1).where(F.col("rank") == k + 1).select("qid", F.col("exact").alias("kth"))
    grouped = save(queries.join(kth, "qid", "left").withColumn("group", F.pmod(F.xxhash64("qid"), F.lit(n_groups)).cast("int")), "thresholds", tidy=True)

    # the bounds of all blocks, a group of queries and a group of shards at a time
    n_maxima = max(1, -(-int(n_values * 2 // block) // shard_values))
    summaries = blocks.select(*shard, "block", "most", "least").withColumn("side", F.pmod(F.xxhash64(*shard), F.lit(n_maxima)).cast("int"))
    summaries = summaries.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
    meets = grouped.select("qid", "dim", "body", "kth", F.col("cell").alias("home"), F.col("part").alias("home_part"), "group").withColumn("side", F.explode(F.sequence(F.lit(0), F.lit(n_maxima - 1))))

    def reached(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out: tuple = ([], [], [])
        if len(left) and len(right):
            dim = key[0].as_py()
            left = left.sort_by([("cell", "ascending"), ("part", "ascending"), ("block", "ascending")])
            cell, part = left["cell"].to_numpy(), left["part"].to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (part[1:] != part[:-1])]))
            maxima = np.concatenate([_matrix(left["most"], dim), _matrix(left["least"], dim)])
            q, maxima = _exact(dim, _matrix(right["body"], dim), maxima)
            bound = np.maximum.reduceat(_bounds(q, maxima[: len(left)], maxima[len(left) :]), cuts, axis=1)
            for i, (qid, k_, home) in enumerate(zip(right["qid"].to_pylist(), right["kth"].to_pylist(), zip(right["home"].to_pylist(), right["home_part"].to_pylist()))):
                near = np.ones(len(cuts), bool) if k_ is None else bound[i] >= int(k_)
                for c in cuts[near]:
                    if (cell[c], part[c]) != home:
                        out[0].append(qid), out[1].append(int(cell[c])), out[2].append(int(part[c]))
        return pa.table({"qid": pa.array(out[0], pa.int64()), "cell": pa.array(out[1], pa.int32()), "part": pa.array(out[2], pa.int32())})

    grid = ["dim", "group", "side"]
    goes = summaries.groupBy(*grid).cogroup(meets.groupBy(*grid)).applyInArrow(reached, "qid long, cell int, part int")
    sent = goes.join(grouped.select("qid", "dim", "body", "kth", "group"), "qid")
    copies = blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
    second = _search(copies, sent, [*shard, "group"], k + 1, kind)
    best = _ranked(first.union(second), "qid", k + 1).drop("rank")

    of_row = asked.select("dim", "body", F.col("rid").alias("own"), F.col("id").alias("query_id")).join(queries.select("dim", "body", "qid"), ["dim", "body"]).select("qid", "own", "query_id")
    others = of_row.join(best, "qid").where("own != rid")
    return _ranked(others, "own", k).select("query_id", F.col("rank").cast("int"), F.col("id").alias(id), "score")
