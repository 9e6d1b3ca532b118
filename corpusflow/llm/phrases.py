"""Collocations: phrases whose words occur together far more often than their parts do apart.

1. Texts are cut into pieces, and equal pieces become one with a multiplicity: within tasks first, then by a shuffle. So copies
   and passages that many documents share are cut into n-grams once. Pieces lie in chunks of some megabytes.
2. Most n-grams are rare, and none of those below the least count can be a phrase or the part of one. So chunks first send the
   cells that their n-grams' hashes fall into, with weights, to shards of the hash space, which add them up and reply by a bit a
   cell: whether its sum reaches the least count. A sum is an n-gram's count at least, so no phrase and no part is lost.
3. Chunks send the n-grams of such cells, with their weighted counts, to hash buckets. A bucket's counts stream into a duckdb
   of the task with a bound on its memory, which sums them out-of-core, in scratch files that go with the task, and gives
   those that do reach the least count.
4. A candidate needs the counts of its parts, and a phrase those of the longer candidates around it, which lie in other
   buckets. So buckets send lookup requests: one for each part, however many of the bucket's candidates have it, with the
   largest count of those around it. Requests are shuffled to where the part is counted and the answers back to the bucket
   that asked. A very common word gets as many requests as there are buckets, and no more.

Exact: counts are longs, scores are made in decimals of 38 digits, which hold counts of up to 10^15. Within a chunk equal
n-grams are told by two 64-bit hashes of their words and their length; buckets count by the n-grams themselves.

Cases: null texts are empty, a null lang is `und` and one with lang 'und'; empty texts and pieces have no phrases but count
for nothing else either; a very long piece is dealt in segments that overlap, each n-gram counted where it starts; repeated rows
count each; ties in score and count go by the phrase's UTF-8 bytes; an empty table gives no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections import Counter
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.chunks import exchange, from_body, make_chunks, shard_bits, with_replies
from corpusflow.llm.common import arrow_schema, save
from corpusflow.llm.hashing import U64, join_blobs, mix, pack_bits, pack_ints, pack_sorted, split_blobs, unpack_bits, unpack_ints, unpack_sorted, utf8, windows, word_hashes

#: Bytes of UTF-8 as they are read: A-Z in lower case, and what ends a piece as a line feed.
READ = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\x0b\x0c\x0d", bytes(range(97, 123)) + 9 * b"\n")
LONGEST, LEAST, COVER_PERCENT, TOP, SCALE = 3, 10, 50, 2000, 1_000_000
#: Words of a segment of a piece, bytes of pieces and n-grams that a task holds before it sends them on, memory of a bucket and the words it is for.
SEGMENT, HELD_BYTES, HELD_GRAMS, BUCKET_MEMORY, BUCKET_WORDS = 50_000, 24 << 20, 600_000, "200MB", 1 << 23


def pieces(docs: DataFrame, longest: int = LONGEST, segment: int = SEGMENT) -> DataFrame:
    """(lang, piece binary, starts, times): each distinct piece of a language, its words parted by single spaces, how many of
    them n-grams start at, and how often it occurs."""
    schema = "lang string, piece binary, starts int, times long"
    fields = arrow_schema(schema)

    def rows(held: dict[str, tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for lang, (whole, cut) in held.items():
            keys = [(p, p.count(b" ") + 1, n) for p, n in whole.items()] + [(*p, n) for p, n in cut.items()]
            for k in range(0, len(keys), 20_000):
                part = list(zip(*keys[k : k + 20_000]))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part[0])), *(pa.array(x, f.type) for x, f in zip(part, list(fields)[1:]))], schema=fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[Counter, Counter]] = {}
        size = 0
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                whole, cut = held.setdefault(lang, (Counter(), Counter()))
                found = []
                for piece in text.translate(READ).split(b"\n"):
                    words = piece.split()  # at spaces and tabs, as all else that bytes.split parts at has gone
                    if len(words) > segment:
                        cut.update((b" ".join(words[k : k + segment + longest - 1]), min(segment, len(words) - k)) for k in range(0, len(words), segment))
                    elif words:
                        found.append(b" ".join(words))
                whole.update(found)
                size += len(text)
                if size > HELD_BYTES:
                    yield from rows(held)
                    held, size = {}, 0
        yield from rows(held)

    wanted = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return wanted.mapInArrow(run, schema).groupBy("lang", "piece", "starts").agg(F.sum("times").alias("times"))


class _Grams:
    """The n-grams of a chunk of pieces: per size the places of their first words, weights and hashes."""

    def __init__(self, body: bytes, longest: int):
        self.t = from_body(body)
        words, at = word_hashes(self.t["piece"])
        self.data, offsets = utf8(self.t["piece"])
        n = np.diff(at)
        self.langs = self.t["lang"].combine_chunks().dictionary_encode()
        lang = self.langs.indices.to_numpy().astype(np.int64)
        self.seeds = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in self.langs.dictionary.to_pylist()], dtype=U64)
        self.row = np.repeat(np.arange(len(n)), n)
        self.lang, self.times = lang, self.t["times"].to_numpy()
        # pieces are words joined by single spaces, so a word ends where the next one's space or its row ends
        gap = np.flatnonzero(self.data[: int(offsets[-1])] == 32)
        self.start = np.sort(np.concatenate([offsets[:-1][n > 0], gap + 1]))
        self.end = np.sort(np.concatenate([offsets[1:][n > 0], gap]))
        nth = np.arange(len(words)) - np.repeat(at[:-1], n)
        starts, size = np.repeat(self.t["starts"].to_numpy(), n), np.repeat(n, n)
        self.words, firsts, hashes = words, [], []
        for k in range(1, longest + 1):
            firsts.append(np.flatnonzero((nth < starts) & (nth + k <= size)))
            hashes.append(self.hashes(k, 0)[firsts[-1]])
        self.sizes = [len(f) for f in firsts]
        self.first, h = np.concatenate(firsts), np.concatenate(hashes)
        del firsts, hashes, nth, starts, size
        self.order = np.argsort(h)
        h = h[self.order]
        self.new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.empty(0, np.int64)
        self.distinct = h[self.new]
        self.weight = np.add.reduceat(self.times[self.row[self.first[self.order]]], self.new) if len(h) else np.empty(0, np.int64)

    def hashes(self, k: int, seed: int) -> np.ndarray:
        return mix(windows(self.words, k, 2 * seed + k) ^ self.seeds[self.lang[self.row[: max(0, len(self.words) - k + 1)]]])

    def cells(self, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The cells of the distinct hashes, sorted: where each begins among these, each cell and its weight."""
        cell = self.distinct >> U64(64 - bits)
        at = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.empty(0, np.int64)
        return at, cell[at], np.add.reduceat(self.weight, at) if len(at) else self.weight

    def counts(self, keep: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(size, lang, first words, weights) of the n-grams whose distinct hashes are kept."""
        n = np.diff(np.append(self.new, len(self.order)))
        member = self.order[np.repeat(keep, n)]
        n = n[keep]
        head = member[np.cumsum(n) - n]
        k = np.repeat(np.arange(1, len(self.sizes) + 1), self.sizes)
        second = np.concatenate([self.hashes(i, 1)[f] for i, f in enumerate(np.split(self.first, np.cumsum(self.sizes)[:-1]), 1)])
        length = self.end[self.first + k - 1] - self.start[self.first]
        odd = np.zeros(len(member), dtype=bool)  # another n-gram with an equal hash
        for told in (second, length, k):
            odd |= told[member] != np.repeat(told[head], n)
        weight = self.weight[keep]
        if odd.any():
            weight = weight - np.bincount(np.repeat(np.arange(len(n)), n)[odd], weights=self.times[self.row[self.first[member[odd]]]], minlength=len(n)).astype(np.int64)
            weight, head = np.concatenate([weight, self.times[self.row[self.first[member[odd]]]]]), np.concatenate([head, member[odd]])
        lang, size = self.lang[self.row[self.first[head]]], k[head]
        for code in np.unique(lang * (len(self.sizes) + 1) + size):
            some = lang * (len(self.sizes) + 1) + size == code
            yield int(code % (len(self.sizes) + 1)), int(code // (len(self.sizes) + 1)), self.first[head[some]], weight[some]


def grams(chunks: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """(lang, gram binary, size, f): each chunk's weighted counts of the n-grams that may reach the least count, to be summed; with
    size 0 and an empty gram the number of its words."""
    n_keys = longest * (chunks.agg(F.sum("n_words")).first()[0] or 0)
    cell_bits, bits = shard_bits(n_keys)
    local = cell_bits - bits

    def send(row: dict) -> Iterator[tuple[int, bytes]]:
        _, cells, weights = _Grams(row["body"], longest).cells(cell_bits)
        cuts = np.searchsorted(cells >> U64(local), np.arange((1 << bits) + 1, dtype=U64))
        for shard in np.flatnonzero(np.diff(cuts)):
            a, z = cuts[shard], cuts[shard + 1]
            yield int(shard), join_blobs([pack_sorted(cells[a:z] & U64((1 << local) - 1)), pack_ints(weights[a:z])])

    def reply(shard: int, messages: list[bytes], senders: list[int]) -> list[bytes]:
        total, sent = np.zeros(1 << local, dtype=np.int64), [split_blobs(m) for m in messages]
        for cells, weights in sent:
            total[unpack_sorted(cells).astype(np.int64)] += unpack_ints(weights).astype(np.int64)  # (a message has a cell once)
        return [pack_bits(total[unpack_sorted(cells).astype(np.int64)] >= least) for cells, _ in sent]

    schema = "lang string, gram binary, size int, f long"
    fields = arrow_schema(schema)

    def wanted(body: bytes, replies: list[dict], held: dict[tuple[str, int], Counter]) -> None:
        g = _Grams(body, longest)
        at, cells, _ = g.cells(cell_bits)
        cuts = np.searchsorted(cells >> U64(local), np.arange((1 << bits) + 1, dtype=U64))
        often = np.zeros(len(cells), dtype=bool)
        for r in replies or ():
            a, z = cuts[r["shard"]], cuts[r["shard"] + 1]
            often[a:z] = unpack_bits(r["blob"], int(z - a))
        data, langs = g.data.tobytes(), g.langs.dictionary.to_pylist()
        for lang, n in enumerate(np.bincount(g.lang, weights=g.times * g.t["starts"].to_numpy(), minlength=len(langs))):
            held.setdefault((langs[lang], 0), Counter())[b""] += int(n)
        for k, lang, first, weight in g.counts(np.repeat(often, np.diff(np.append(at, len(g.distinct))))):
            found = {data[a:z]: n for a, z, n in zip(g.start[first].tolist(), g.end[first + k - 1].tolist(), weight.tolist())}
            if len(found) < len(first):  # of equal hashes, several are of one n-gram that is not the first
                found = Counter()
                for a, z, n in zip(g.start[first].tolist(), g.end[first + k - 1].tolist(), weight.tolist()):
                    found[data[a:z]] += n
            held.setdefault((langs[lang], k), Counter()).update(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], Counter] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for (lang, k), counted in held.items():
                found, f = list(counted), list(counted.values())
                for c in range(0, len(found), 50_000):
                    part = found[c : c + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), pa.array(part, pa.binary()), pa.array([k] * len(part), pa.int32()), pa.array(f[c : c + 50_000], pa.int64())], schema=fields)
            held.clear()

        for b in batches:
            for i in range(b.num_rows):
                wanted(b.column(0)[i].as_py(), b.column(1)[i].as_py(), held)
                if sum(map(len, held.values())) > HELD_GRAMS:
                    yield from rows()
        yield from rows()

    asked = with_replies(chunks, replies=exchange(chunks, send, reply))
    return asked.select("body", "replies").mapInArrow(run, schema)


def count_buckets(weighted: DataFrame, n_buckets: int, least: int) -> DataFrame:
    """(bucket, lang, gram, size, f) of the n-grams with f >= least, each bucket summed out-of-core by a duckdb of its task."""
    schema = "bucket int, lang string, gram string, size int, f long"
    fields = arrow_schema(schema)

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as scratch, duckdb.connect(f"{scratch}/bucket.db", config={"memory_limit": BUCKET_MEMORY, "threads": 1, "temp_directory": scratch, "preserve_insertion_order": False}) as con:
            con.execute("CREATE TABLE counts (lang VARCHAR, gram BLOB, size INTEGER, f BIGINT)")
            for b in batches:
                part = pa.Table.from_batches([b]).select(["lang", "gram", "size", "f"])  # noqa: F841  (read by name)
                con.execute("INSERT INTO counts SELECT * FROM part")
            found = con.sql(f"SELECT lang, decode(gram) AS gram, size, CAST(sum(f) AS BIGINT) AS f FROM counts GROUP BY lang, gram, size HAVING sum(f) >= {int(least)} OR size = 0")
            for b in found.to_arrow_reader(50_000):
                yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()] * b.num_rows, pa.int32()), *(c.cast(f.type) for c, f in zip(b.columns, list(fields)[1:]))], schema=fields)

    dealt = weighted.withColumn("bucket", F.pmod(F.xxhash64("lang", "gram"), F.lit(n_buckets)).cast("int"))
    return dealt.groupBy("bucket").applyInArrow(run, schema)


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, cover_percent: int = COVER_PERCENT, top: int = TOP, n_buckets: int | None = None, segment: int = SEGMENT) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` phrases of 2 to `longest` words.

    Phrases that occur `least` times are candidates; those with a longer candidate around them that has at least
    cover_percent of their count are left out. n_buckets: by default one for every BUCKET_WORDS words of distinct pieces, and one a shuffle partition at least."""
    spark = docs.sparkSession
    chunks = make_chunks(pieces(docs, longest, segment), order="times", text="piece")
    if n_buckets is None:
        n_words = chunks.agg(F.sum("n_words")).first()[0] or 0
        n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_words // BUCKET_WORDS))
    counted = save(count_buckets(grams(chunks, longest, least), n_buckets, least), "gram-counts", tidy=True)
    totals = counted.where("size = 0").select("lang", F.col("f").alias("n"))
    counted = counted.where("size > 0")

    # a candidate's parts: the cuts' first parts and rests, and everything shorter inside it that could be a phrase
    words = F.split("gram", " ")
    phrases = counted.where("size > 1").select("bucket", "lang", "gram", "size", F.col("f").alias("a"), words.alias("words"))
    spans = F.flatten(F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: F.struct(n.alias("n"), i.alias("i")))))
    inner = F.filter(spans, lambda s: (s.n > 1) | (s.i == 1) | (s.i == F.col("size")))
    parts = phrases.select("bucket", "lang", "gram", "size", "a", F.explode(inner).alias("s"), "words")
    parts = parts.select("bucket", "lang", "gram", "size", "a", "s", F.array_join(F.slice("words", F.col("s.i"), F.col("s.n")), " ").alias("part"))
    requests = parts.groupBy("lang", "part", "bucket").agg(F.max("a").alias("around"))
    answers = requests.join(counted.select("lang", F.col("gram").alias("part"), "f"), ["lang", "part"])
    answers = save(answers, "answers", tidy=True)
    covered = answers.where(F.col("f") * cover_percent <= F.col("around") * 100).select("lang", F.col("part").alias("gram")).distinct()

    cuts = parts.where("s.i = 1 or s.i + s.n - 1 = size").join(answers.select("bucket", "lang", "part", "f"), ["bucket", "lang", "part"])
    first = F.when(F.col("s.i") == 1, F.col("f"))
    rest = F.when(F.col("s.i") > 1, F.col("f"))
    k = F.when(F.col("s.i") == 1, F.col("s.n")).otherwise(F.col("size") - F.col("s.n"))
    cuts = cuts.groupBy("bucket", "lang", "gram", "a", k.alias("k")).agg(F.max(first).alias("l"), F.max(rest).alias("r"))
    wide = lambda c: F.col(c).cast("decimal(15,0)")
    score = F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * (wide("a") * wide("a")).cast("decimal(30,0)"), wide("l") * wide("r"))
    worst = cuts.withColumn("score", score).groupBy("lang", "gram", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    kept = worst.join(covered, ["lang", "gram"], "left_anti").select("lang", F.col("gram").alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
    # a language's best are among the best of its parts, which bounds what one task sorts
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    some = kept.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(n_buckets)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("rank") <= top).drop("_part")
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
