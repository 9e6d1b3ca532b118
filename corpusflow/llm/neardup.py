"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

Shingles are five words, weighted tf * idf with idf = 1 + ln(N / df) / ln(N): N is the number of rows and df the
exact number of rows that have the shingle, gathered from all texts by chunks (see chunks.py). It is 2 for a shingle of
one text and 1 for one of all; the 1 keeps what large groups of copies share from being discounted away.

A band is an independent hash of the shingles into SLOTS groups; each group keeps its consistent
weighted sample, and the band's key is the samples together. Texts that share a key are compared with
the first of them; the weighted Jaccard similarity of the whole texts decides. A key whose texts then
still lie in several components is gone through again, in blocks, and every pair across components is
compared, through an index of rare shingles first, so a class is lost only if no band has brought two
of its texts together (a chance under 0.001 at the threshold).

Cases: null texts and texts without words are classes of their own, never linked; a text of fewer than
five words is one shingle; equal texts are one class from the start; rows that repeat a doc_id with
other texts join these texts' classes; rows without a doc_id are classes of their own; very long texts are
whole, in chunks of their own; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusflow.llm import chunks as C
from corpusflow.llm.common import collected, drop_saved, packed, save
from corpusflow.llm.components import components
from corpusflow.llm.hashing import GOLDEN, U64, join_blobs, mix, pack_ints, pack_sorted, split_blobs, unpack_ints, unpack_sorted, windows, word_hashes

SHINGLE, THRESHOLD, BANDS, SLOTS = 5, 0.8, 12, 3
#: Bits of the filter that thins out the scan for the texts to compare.
FILTER_BITS = 1 << 26
#: Texts of a block when a key's texts are gone through again.
BLOCK = 256


class Shingles:
    """The shingles of an array of texts: for each text its distinct hashes, sorted, and how often it has them."""

    def __init__(self, texts: pa.Array, size: int = SHINGLE):
        words, at = word_hashes(texts)
        n, many = np.diff(at), windows(words, size)
        per = np.maximum(n - size + 1, 0)
        start = np.repeat(at[:-1] - np.concatenate([[0], np.cumsum(per)[:-1]]), per) + np.arange(per.sum()) if len(n) else np.empty(0, dtype=np.int64)
        short = np.flatnonzero((n > 0) & (n < size))
        alone = np.array([mix(windows(words[at[i] : at[i + 1]], int(n[i])) + U64(n[i]))[0] for i in short], dtype=U64)
        h, doc = np.concatenate([many[start], alone]), np.concatenate([np.repeat(np.arange(len(n)), per), short])
        order = np.argsort(h, kind="stable")
        h, doc = h[order], doc[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        h, doc, tf = h[first], doc[first], np.diff(first, append=len(h))
        new = np.ones(len(h), dtype=bool)
        new[1:] = h[1:] != h[:-1]
        #: the distinct hashes of all texts, and how many of the texts have each
        self.keys = h[new]
        self.df = np.diff(np.flatnonzero(new), append=len(h))
        key, order = np.cumsum(new) - 1, np.argsort(doc, kind="stable")
        #: text after text: hash, its place among the keys, occurrences
        self.hashes, self.key, self.tf = h[order], key[order], tf[order]
        self.at = np.searchsorted(doc[order], np.arange(len(n) + 1))

    def weighted(self, df: np.ndarray, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per text (hashes, weights); df: of each hash of each text."""
        w = self.tf * idf(df, n)
        return [(self.hashes[a:b], w[a:b]) for a, b in zip(self.at[:-1], self.at[1:])]


def idf(df: np.ndarray, n: int) -> np.ndarray:
    return 1 + np.log(n / df) / np.log(n) if n > 1 else np.ones(len(df))


def with_frequencies(docs: DataFrame, size: int, chunk_bytes: int | None) -> tuple[DataFrame, int]:
    """(chunk, body, counts): docs by chunks, where counts are the replies with the document frequency of each of
    its keys, and the number of rows of docs."""
    chunks = C.make_chunks(docs, chunk_bytes=chunk_bytes)
    total, n = chunks.agg(F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum("n_docs"), F.lit(0))).first()
    _, bits = C.shard_bits(total // 2)
    bodies = chunks.select("chunk", "body")

    def send(row: dict):
        x = Shingles(C.from_body(row["body"])["text"], size)
        for s, p in key_parts(x.keys, bits):
            if p.stop > p.start:
                yield s, join_blobs([pack_sorted(x.keys[p] - U64(s << (64 - bits))), pack_ints(x.df[p].astype(U64))])

    def reply(shard: int, blobs: list[bytes], _) -> list[bytes]:
        keys, counts = zip(*((unpack_sorted(k), unpack_ints(c)) for k, c in map(split_blobs, blobs)))
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        keys = np.concatenate(keys)
        order = np.argsort(keys, kind="stable")  # runs that are sorted
        ordered = keys[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = ordered[1:] != ordered[:-1]
        sums = np.add.reduceat(np.concatenate(counts)[order], np.flatnonzero(new))
        out = np.empty(len(keys), dtype=U64)
        out[order] = sums[np.cumsum(new) - 1]
        return [pack_ints(x) for x in np.split(out, cuts)]

    return C.with_replies(bodies, counts=C.exchange(bodies, send, reply)).withColumn("bits", F.lit(bits)), n


def key_parts(keys: np.ndarray, bits: int) -> list[tuple[int, slice]]:
    """(shard, slice) of sorted 64-bit keys, by their first bits."""
    cuts = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=U64) << U64(64 - bits))
    cuts = np.concatenate([[0], cuts, [len(keys)]]).tolist()
    return [(s, slice(a, b)) for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))]


def band_keys(h: np.ndarray, weight: np.ndarray, starts: np.ndarray, bands: int = BANDS, slots: int = SLOTS) -> np.ndarray:
    """Keys (texts x bands) of texts that have shingles: text i has h and weight from starts[i] up to the next start."""
    sizes = np.diff(starts, append=len(h))
    log_weight = np.log(weight.astype(np.float32))
    unit = np.float32(2.0**-32)
    low = U64(0xFFFFFFFF)
    out = np.empty((len(starts), bands), dtype=np.int64)
    for band in range(bands):
        z = mix(h + U64((band + 1) * int(GOLDEN) & 0xFFFFFFFFFFFFFFFF))
        slot = (z % U64(slots)).astype(np.int8)
        draws = []
        for k in range(5):
            if k % 2 == 0:
                z = mix(z + U64(k + 1))
            draws.append((((z & low) if k % 2 == 0 else (z >> U64(32))).astype(np.float32) + np.float32(0.5)) * unit)
        r = -np.log(draws[0] * draws[1])
        t = np.floor(log_weight / r + draws[4])
        log_a = np.log(-np.log(draws[2] * draws[3])) - r * (t - draws[4]) - r
        sample = mix(h ^ (t.astype(np.int64).view(U64) * GOLDEN + U64(band)))
        key = np.zeros(len(starts), dtype=U64)
        for s in range(slots):
            a = np.where(slot == s, log_a, np.float32(np.inf))
            best = np.repeat(np.minimum.reduceat(a, starts), sizes)
            code = np.where((slot == s) & (a == best), sample, U64(0))
            key = mix(key * GOLDEN + np.maximum.reduceat(code, starts))
        out[:, band] = key.view(np.int64)
    return out


def similarity(a: tuple, b: tuple) -> float:
    """Weighted Jaccard of two texts' shingles (hashes, weights)."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    both = float(np.minimum(a[1][i], b[1][j]).sum())
    return both / (float(a[1].sum()) + float(b[1].sum()) - both)


def links_within(ids: list, texts: list[tuple], classes: list, threshold: float, across: int | None = None) -> list[tuple]:
    """Links that join different classes, among texts, found through an index of each text's rarest shingles.

    Two texts as similar as the threshold share one of the (1 - threshold) of weight with which each
    begins, in an order common to both; so only texts that meet there are compared. across: compare only
    between the first so many and the rest.
    """
    sizes = np.array([len(h) for h, _ in texts])
    full = np.flatnonzero(sizes)
    if not len(full):
        return []
    h, w = np.concatenate([x for x, _ in texts]), np.concatenate([x for _, x in texts])
    text = np.repeat(np.arange(len(texts)), sizes)
    _, place, count = np.unique(h, return_inverse=True, return_counts=True)
    order = np.lexsort((h, count[place], text))
    h, w, text, place = h[order], w[order], text[order], place[order]
    before = np.cumsum(w) - w
    start = np.concatenate([[0], np.cumsum(sizes)])[:-1][full]
    whole = np.add.reduceat(w, start)
    opens = before - np.repeat(before[start], sizes[full]) <= np.repeat((1 - threshold) * whole * (1 + 1e-6) + 1e-9, sizes[full])
    place, text = place[opens], text[opens]
    order = np.argsort(place, kind="stable")  # the texts of a shingle stay in order
    place, text = place[order], text[order]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1, [len(place)]])
    parent = {c: c for c in classes}

    def root(c):
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    met, out = set(), []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b - a < 2:
            continue
        here = text[a:b].tolist()
        for j, y in enumerate(here):
            ry = root(classes[y])
            for x in here[:j]:
                if (across is not None and (x < across) == (y < across)) or root(classes[x]) == ry or (x, y) in met:
                    continue
                met.add((x, y))
                if similarity(texts[x], texts[y]) >= threshold:
                    rx = root(classes[x])
                    parent[max(rx, ry)] = ry = min(rx, ry)
                    out.append((ids[y], ids[x]))
    return out


def text_digest(text: Column) -> Column:
    """128 bits of SHA-256: equal for equal texts only."""
    return F.substring(F.unhex(F.sha2(text.cast("binary"), 256)), 1, 16)


def wanted_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, ztext) of the wanted nodes (node, digest), by a scan of docs that a bitmap of fixed size thins out.

    The bitmap has FILTER_BITS bits whatever the corpus: of few wanted ids it lets few others pass, of many more,
    and the join after it is exact in any case.
    """
    spot = lambda c: F.pmod(F.xxhash64(F.col(c)), F.lit(FILTER_BITS))
    bit = spot("node.rep") + 1  # the bits of buckets 1, 2, ... are numbered from 1; a 0 would be in a bucket 0
    maps = wanted.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect()
    bits = np.zeros(FILTER_BITS // 8 + 4096, dtype=np.uint8)
    for r in maps:  # at most FILTER_BITS / 32768 rows of 4 KB; bucket k holds the bits from (k - 1) * 32768 + 1
        start = (r["bucket"] - 1) * 4096
        bits[start : start + len(r["bits"])] |= np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def thin(batches):
        press = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            at = b.column("spot").to_numpy()
            keep = pa.array((shared.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0)
            few = pa.RecordBatch.from_arrays([b.column(c) for c in ("doc_id", "digest", "text")], names=["doc_id", "digest", "text"]).filter(keep)
            if few.num_rows:
                z = pa.array([press(t.as_buffer()) for t in few.column("text").cast(pa.large_binary())], pa.binary())
                yield pa.RecordBatch.from_arrays([few.column("doc_id"), few.column("digest"), z], names=["doc_id", "digest", "ztext"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.where("doc_id is not null and text is not null").select("doc_id", text_digest(F.col("text")).alias("digest"), "text", spot("doc_id").alias("spot"))
    thinned = rows.mapInArrow(thin, f"doc_id {kind}, digest binary, ztext binary")
    found = thinned.join(wanted.select(F.col("node.rep").alias("_rep"), "node", F.col("digest").alias("_digest")), (F.col("doc_id") == F.col("_rep")) & (F.col("digest") == F.col("_digest")))
    return found.dropDuplicates(["doc_id", "digest"]).select("node", "ztext")


def unpacked(column) -> pa.Array:
    undo = zstandard.ZstdDecompressor().decompress
    return pa.array([undo(x) for x in column.to_pylist()], pa.binary())


def weighted_texts(ztexts: pa.Array, dfs: pa.Array, n: int, size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashes, weights) of packed texts and the packed document frequencies of their shingles."""
    df = [unpack_ints(x) for x in dfs.to_pylist()]
    return Shingles(unpacked(ztexts), size).weighted(np.concatenate(df) if df else np.empty(0, dtype=U64), n)


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, bands: int = BANDS, chunk_bytes: int | None = None) -> DataFrame:
    """(doc_id, digest, class_id, n_copies, kept) per row: class_id is the smallest doc_id of the class, n_copies its
    rows, and kept is true for the row of class_id (of the smallest digest, where that id has several texts)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text")
    with collected() as scratch:
        counted, n = with_frequencies(docs.withColumn("digest", text_digest(F.col("text"))), size, chunk_bytes)
        signed = save(counted.mapInArrow(_signer(n, size, bands), f"doc_id {kind}, digest binary, keys array<long>, dfs binary"), "signed")
    drop_saved(docs.sparkSession, scratch[:-1])  # the chunks; what was made of them is written
    grouped = signed.where("keys is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first(F.struct("keys", "dfs")).alias("s"))
    tie = F.row_number().over(Window.partitionBy("rep").orderBy("digest"))  # an id may stand for several texts
    texts = save(grouped.select(F.struct("rep", tie.alias("tie")).alias("node"), "digest", "s.keys", "s.dfs"), "texts")
    banded = texts.select("node", F.explode("keys").alias("key"))
    first = save(banded.groupBy("key").agg(F.min("node").alias("first"), F.count("*").alias("n")).where("n > 1"), "shared-keys")
    held = save(banded.join(first, "key"), "held")
    pairs = save(held.where("node != first").select("node", F.col("first").alias("other")).distinct(), "pairs")
    wanted = pairs.select("node").union(pairs.select("other")).distinct()
    few = save(texts.select("node", "digest", "dfs").join(wanted, "node", "left_semi"), "wanted")
    body = save(wanted_texts(docs, few.select("node", "digest")).join(few.select("node", "dfs"), "node"), "wanted-texts")
    node = "struct<rep:" + kind + ",tie:int>"

    def compare(batches):
        for whole in batches:
            for k in range(0, whole.num_rows, 200):
                b = whole.slice(k, 200)
                x, y = weighted_texts(b.column("ztext"), b.column("dfs"), n, size), weighted_texts(b.column("other_text"), b.column("other_dfs"), n, size)
                good = [similarity(p, q) >= threshold for p, q in zip(x, y)]
                found = pa.RecordBatch.from_arrays([b.column("node"), b.column("other")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))
                if found.num_rows:
                    yield found

    compared = pairs.join(body, "node").join(body.select(F.col("node").alias("other"), F.col("ztext").alias("other_text"), F.col("dfs").alias("other_dfs")), "other")
    links = save(compared.select("node", "other", "ztext", "dfs", "other_text", "other_dfs").mapInArrow(compare, f"a {node}, b {node}"), "links")
    so_far = save(components(links, alone=False), "components")
    again = _again(held, so_far, body, node, n, threshold, size)
    classes = components(so_far.select(F.col("id").alias("a"), F.col("component").alias("b")).union(again), alone=False)

    known = texts.join(classes, texts["node"] == classes["id"], "left").select("digest", F.coalesce("component", "node").alias("group"))
    lone = F.col("group").isNull() | F.col("doc_id").isNull()
    row = F.concat(F.lit("row:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.coalesce(F.hex("digest"), F.lit("")))
    member = signed.where("keys is not null").join(known, "digest", "left").select("doc_id", "digest", "group").union(signed.where("keys is null").select("doc_id", "digest", F.lit(None).cast(node)))
    member = save(member.select("doc_id", "digest", F.when(lone, row).otherwise(F.concat(F.lit("class:"), F.to_json("group"))).alias("group")), "members")
    # only classes of several rows are joined, and both sides are plain tables, so that a large class's rows can be split
    per = save(member.groupBy("group").agg(F.min(F.struct("doc_id", "digest")).alias("best"), F.count("*").alias("n_copies")).where("n_copies > 1"), "classes")
    out = member.join(per, "group", "left")
    kept = F.col("best").isNull() | (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & F.col("digest").eqNullSafe(F.col("best.digest")))
    class_id = F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id"))
    return out.select("doc_id", "digest", class_id.alias("class_id"), F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"), kept.alias("kept"))


def _signer(n: int, size: int, bands: int):
    """From (body, counts, bits) of chunks to (doc_id, digest, keys, dfs) of documents."""

    def sign(batches):
        for whole in batches:
            for i in range(whole.num_rows):
                row = {c: whole.column(c)[i].as_py() for c in ("body", "counts", "bits")}
                table = C.from_body(row["body"])
                x = Shingles(table["text"], size)
                replies = {r["shard"]: r["blob"] for r in row["counts"] or ()}
                df = np.empty(len(x.keys), dtype=U64)
                for s, p in key_parts(x.keys, row["bits"]):
                    if p.stop > p.start:
                        df[p] = unpack_ints(replies[s])
                df = df[x.key]
                keys: list = [None] * len(table)
                dfs: list = [None] * len(table)
                full = np.flatnonzero(np.diff(x.at))
                for k in range(0, len(full), 300):
                    some = full[k : k + 300]
                    a, b = x.at[some[0]], x.at[some[-1] + 1]
                    for j, row_keys in zip(some, band_keys(x.hashes[a:b], x.tf[a:b] * idf(df[a:b], n), x.at[some] - a, bands)):
                        keys[j], dfs[j] = row_keys, pack_ints(df[x.at[j] : x.at[j + 1]])
                t = pa.table({"doc_id": table["doc_id"], "digest": table["digest"], "keys": pa.array(keys, pa.list_(pa.int64())), "dfs": pa.array(dfs, pa.binary())})
                yield from t.combine_chunks().to_batches(max_chunksize=5000)

    return sign


def _again(held, so_far, body, node: str, n: int, threshold: float, size: int) -> DataFrame:
    """Links between texts that share a key of three texts or more and still lie in different components.

    Within a key all pairs across components are looked at, in blocks, so no link of the key that joins two
    components is left out.
    """
    known = so_far.select(F.col("id").alias("node"), F.col("component").alias("class"))
    many = held.where("n > 2").join(known, "node", "left").select("key", "n", "node", F.coalesce("class", "node").alias("class"))
    many = save(many, "unsettled")
    per = many.groupBy("key", "class").agg(F.count("*").alias("size")).groupBy("key").agg(F.max(F.struct("size", "class")).alias("main"), F.count("*").alias("classes"))
    per = save(per.where("classes > 1").drop("classes"), "unsettled-keys")
    mixed = many.join(per, "key")
    # texts of the key's largest component need no look at each other: blocks of the others come first, and each of
    # these meets every block
    other = F.col("class") != F.col("main.class")
    others, all_of = F.ceil((F.col("n") - F.col("main.size")) / BLOCK), F.ceil((F.col("n") - F.col("main.size")) / BLOCK) + F.ceil(F.col("main.size") / BLOCK)
    mine = F.when(other, F.pmod(F.xxhash64("node"), others)).otherwise(others + F.pmod(F.xxhash64("node"), F.ceil(F.col("main.size") / BLOCK)))
    dealt = mixed.withColumns({"mine": mine.cast("int"), "blocks": F.when(other, all_of).otherwise(others).cast("int")})
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("key", F.least("mine", "with").alias("i"), F.greatest("mine", "with").alias("j"), "mine", "node", "class").join(body, "node")
    kind = pa.struct([("rep", to_arrow_type(held.schema["node"].dataType["rep"].dataType)), ("tie", pa.int32())])

    def go(key: tuple, t: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        as_key = lambda c: [(x["rep"], x["tie"]) for x in c.to_pylist()]
        order = sorted(range(len(t)), key=lambda k, m=t["mine"].to_pylist(), n=as_key(t["node"]): (m[k], n[k]))
        t = t.take(pa.array(order, pa.int64()))
        ahead = t["mine"].to_pylist().count(i)
        found = links_within(as_key(t["node"]), weighted_texts(t["ztext"].combine_chunks(), t["dfs"].combine_chunks(), n, size), as_key(t["class"]), threshold, None if i == j else ahead)
        column = lambda k: pa.array([{"rep": x[k][0], "tie": x[k][1]} for x in found], kind)
        return pa.table({"a": column(0), "b": column(1)})

    return save(dealt.groupBy("key", "i", "j").applyInArrow(go, f"a {node}, b {node}").distinct(), "links-again")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """docs with one row of each class of near-duplicates; rows that are no class's (without words or id) all stay. All columns
    are handed on, whatever their names."""
    dropped = near_duplicates(docs, **options).where("not kept").select(F.col("doc_id").alias("_id"), "digest").distinct()
    mine = docs.select(packed(docs), F.col("doc_id").alias("_mine"), text_digest(F.col("text")).alias("_digest"))
    left = mine.join(dropped, (F.col("_mine") == F.col("_id")) & (F.col("_digest") == F.col("digest")), "left_anti")
    same = Window.partitionBy("_mine", "_digest").orderBy("_mine")
    first = F.col("_mine").isNull() | F.col("_digest").isNull() | (F.row_number().over(same) == 1)
    return left.withColumn("_first", first).where("_first").select("row.*")
