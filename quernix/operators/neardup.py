"""Near-duplicate records by a multi-index Hamming join over min-hash signatures.

A record's signature has LANES lanes of 16 bits; two records' lanes agree with the probability of their similarity, so
the Hamming distance of two signatures, counted in lanes, is about (1 - similarity) * LANES. The signature is split
into CHUNKS chunks. By the pigeonhole principle two signatures within distance (errors + 1) * chunks - 1 agree in some
chunk but for `errors` lanes; enumerating which lanes of a chunk may differ gives exact keys to meet on, which finds
every such pair. Pairs that meet are held against each other lane by lane, then exactly on their word sequences.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernix.functions.words import WordHasher, mix, shingles, words
from quernix.operators.components import connected_components
from quernix.operators.skew import keep_likely, salted_join
from quernix.runtime import ship, stage


@dataclass(frozen=True)
class SignatureJoin:
    """width: words of a sequence; similarity: least Jaccard similarity of a pair. errors: lanes of a chunk that may
    differ. slack: standard deviations by which a pair's signature may stray from the similarity before the exact check.
    hot: members above which a meeting place is enumerated in blocks of about `block` members, block against block.
    """

    width: int = 5
    similarity: float = 0.8
    chunks: int = 16
    chunk_lanes: int = 6
    errors: int = 1
    slack: float = 4.5
    hot: int = 200
    block: int = 1000

    @property
    def lanes(self) -> int:
        return self.chunks * self.chunk_lanes

    @property
    def sure_distance(self) -> int:
        """Signatures within this distance meet for certain."""
        return (self.errors + 1) * self.chunks - 1

    @property
    def most_distance(self) -> int:
        s, n = self.similarity, self.lanes
        return int(min(n, np.ceil((1 - s) * n + self.slack * np.sqrt(max(s * (1 - s), 1 / n) * n))))


def lane_values(hashes: np.ndarray, starts: np.ndarray, lanes: int) -> np.ndarray:
    """(records, lanes) min-hash values of 16 bits; hashes of record i begin at starts[i], none is without."""
    rng = np.random.default_rng(20240229)
    a = rng.integers(1, 2**63, lanes, dtype=np.uint64) | np.uint64(1)
    b = rng.integers(0, 2**63, lanes, dtype=np.uint64)
    out = np.empty((len(starts), lanes), dtype=np.uint16)
    for k in range(lanes):
        low = np.minimum.reduceat(hashes * a[k] + b[k], starts)
        out[:, k] = mix(low) >> np.uint64(48)
    return out


def chunk_keys(lanes: np.ndarray, c: SignatureJoin) -> np.ndarray:
    """(records, keys) meeting keys: for every chunk and every choice of lanes that may differ, a hash of the others."""
    n = len(lanes)
    keep = list(combinations(range(c.chunk_lanes), c.chunk_lanes - c.errors))
    out = np.empty((n, c.chunks * len(keep)), dtype=np.uint64)
    at = 0
    for chunk in range(c.chunks):
        part = lanes[:, chunk * c.chunk_lanes : (chunk + 1) * c.chunk_lanes].astype(np.uint64)
        for which in keep:
            x = np.full(n, at + 1, dtype=np.uint64)
            for lane in which:
                x = mix(x) + part[:, lane]
            out[:, at] = mix(x)
            at += 1
    return out


def _sets(ids: pa.Array, texts: pa.Array, width: int, hasher: WordHasher) -> Iterator[tuple[object, np.ndarray]]:
    for i, t in zip(ids.to_pylist(), texts.to_pylist(), strict=True):
        if t is not None:
            s = shingles(hasher(words(t)), width)
            if len(s):
                yield i, s


def signatures(texts: DataFrame, c: SignatureJoin) -> DataFrame:
    """(id, n, digest, lanes) of each (id, text) that has at least one sequence of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in batches:
            got = list(_sets(b.column(0), b.column(1), c.width, hasher))
            if not got:
                continue
            ids, sets = [x[0] for x in got], [x[1] for x in got]
            sizes = np.array([len(s) for s in sets])
            lanes = lane_values(np.concatenate(sets), np.concatenate([[0], np.cumsum(sizes)[:-1]]), c.lanes)
            yield pa.record_batch(
                [pa.array(ids, b.column(0).type), pa.array(sizes, pa.int32()), pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()), pa.array([x.tobytes() for x in lanes], pa.binary())],
                names=["id", "n", "digest", "lanes"],
            )

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(run, f"id {kind}, n int, digest binary, lanes binary")


def key_bitmap(keys: DataFrame) -> np.ndarray:
    """Bitmap of the low bits of a column key, about 16 bits a key and 32 MB at most."""
    n, enough = 32_768, min(1 << 28, 16 * keys.count())
    while n < enough:
        n *= 2
    # Spark counts places from 1: bit 0 of bucket 1 stands for 1
    place = keys.select(F.expr(f"(key & {n - 1}L) + 1").alias("p"))
    rows = place.groupBy(F.expr("bitmap_bucket_number(p)").alias("b")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p))").alias("bits")).collect()
    out = np.zeros(n // 8, dtype=np.uint8)
    for r in rows:
        out[(r["b"] - 1) * 4096 :][: len(r["bits"])] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def keys_of(reps: DataFrame, c: SignatureJoin, likely: np.ndarray | None = None) -> DataFrame:
    """(key, h) rows, one for each meeting key of each (h, lanes); with a bitmap, only for keys whose bit is set."""
    bitmap = None if likely is None else reps.sparkSession.sparkContext.broadcast(likely)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                lanes = np.frombuffer(b"".join(part.column(1).to_pylist()), dtype=np.uint16).reshape(part.num_rows, -1)
                keys = chunk_keys(lanes, c)
                h = np.repeat(part.column(0).to_numpy(zero_copy_only=False), keys.shape[1])
                keys = keys.reshape(-1).view(np.int64)
                if bitmap is not None:
                    at = keys & np.int64(8 * len(bitmap.value) - 1)
                    on = (bitmap.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
                    keys, h = keys[on], h[on]
                yield pa.record_batch([pa.array(keys), pa.array(h)], names=["key", "h"])

    return reps.select("h", "lanes").mapInArrow(run, "key bigint, h bigint")


def _meet(rows: DataFrame) -> DataFrame:
    """Pairs of the members of each key, all keys bounded in members."""
    sets = rows.groupBy("key").agg(F.array_sort(F.collect_set("h")).alias("hs")).where(F.size("hs") > 1)
    firsts = sets.select(F.explode(F.expr("transform(slice(hs, 1, size(hs) - 1), (x, i) -> struct(x as a, slice(hs, i + 2, size(hs)) as bs))")).alias("p"))
    return firsts.select(F.col("p.a").alias("a"), F.explode("p.bs").alias("b")).distinct()


def _blocks_meet(c: SignatureJoin):
    """Pairs of a block of a place with another or with itself that are near lane by lane and share no earlier key."""

    def run(t: pa.Table) -> pa.Table:
        lanes = np.frombuffer(b"".join(t.column("lanes").to_pylist()), dtype=np.uint16).reshape(t.num_rows, -1)
        h, b = t.column("h").to_numpy(), t.column("b").to_numpy()
        i, j, place = (t.column(k)[0].as_py() for k in ("i", "j", "key"))
        keys, left, right = chunk_keys(lanes, c).view(np.int64), np.flatnonzero(b == i), np.flatnonzero(b == j)
        columns = np.ascontiguousarray(lanes[right].T)
        out = []
        for at in range(0, len(left), 128):
            rows = left[at : at + 128]
            far = np.zeros((len(rows), len(right)), dtype=np.uint16)
            for k, column in enumerate(columns):
                far += lanes[rows, k][:, None] != column
            x, y = np.nonzero(far <= c.most_distance)
            x, y = rows[x], right[y]
            if i == j:
                x, y = x[h[x] < h[y]], y[h[x] < h[y]]
            # a pair is near at every place where it meets; the place of its first key gives it
            for cut in range(0, len(x), 20_000):
                p, q = x[cut : cut + 20_000], y[cut : cut + 20_000]
                same = keys[p] == keys[q]
                on = same.any(axis=1) & (keys[p, same.argmax(axis=1)] == place)
                out.append(np.stack([h[p[on]], h[q[on]]], axis=1))
        got = np.concatenate(out) if out else np.zeros((0, 2), dtype=np.int64)
        return pa.table({"a": got.min(axis=1), "b": got.max(axis=1)})

    return run


def _meet_hot(hot: DataFrame, reps: DataFrame, c: SignatureJoin) -> DataFrame:
    """Near pairs of the members of each key of (key, h, n), whose number n has no bound: every block of a place is held
    against every other and itself, in groups of two blocks at most."""
    last = F.ceil(F.col("n") / c.block).cast("int") - 1
    told = hot.join(reps.select("h", "lanes"), "h").withColumn("last", last).withColumn("b", F.expr("CAST(pmod(xxhash64(h, key), last + 1) AS INT)"))
    each = told.withColumn("o", F.explode(F.sequence(F.lit(0), "last")))
    each = each.select("key", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "b", "h", "lanes")
    return each.groupBy("key", "i", "j").applyInArrow(_blocks_meet(c), "a bigint, b bigint")


def candidate_pairs(reps: DataFrame, c: SignatureJoin) -> DataFrame:
    """(a, b) hashes of records whose signatures meet, a < b. Of a key met by more than c.hot records only the pairs
    within c.most_distance come out; the others would be dropped by the lanes later.
    """
    counts = stage(keys_of(reps, c).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "counts")
    # most keys are met by one record only; made again, all but few of those are left out before the shuffle
    shared = stage(keys_of(reps, c, key_bitmap(counts)).join(counts, "key"), "meeting")
    pairs = _meet(shared.where(F.col("n") <= c.hot))
    hot = shared.where(F.col("n") > c.hot)
    if not hot.isEmpty():
        pairs = pairs.unionByName(_meet_hot(hot, reps, c))
    return pairs.distinct()


def _near(c: SignatureJoin):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(k).to_pylist()), dtype=np.uint16).reshape(b.num_rows, -1) for k in (2, 3))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array((x != y).sum(axis=1) <= c.most_distance))

    return run


def _exact(c: SignatureJoin):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= c.similarity * (len(x) + len(y) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


#: Members of a class that are joined with its representative in one task.
_CLASS_TOGETHER = 100_000


def near_duplicate_classes(df: DataFrame, id_col: str, text: Column, c: SignatureJoin) -> tuple[DataFrame, DataFrame]:
    """(members, links): members (id, rep) puts every record with at least one word sequence into the class of records
    with exactly its sequences, rep being the least id; links (rep_a, rep_b) are all pairs of different classes whose
    similarity reaches c.similarity. Copies are one class and never multiply the work.

    Defined cases: null ids and texts, and texts with fewer than c.width words, are in no class; a repeated row counts
    once; an id with several texts is a member of several classes; an empty table gives two empty ones.
    """
    ship(df.sparkSession)
    texts = df.select(F.col(id_col).alias("id"), text.alias("text")).where("id is not null and text is not null")
    signed = stage(signatures(texts, c), "signatures")
    # the digest tells classes apart; h is its short name in the join, and a clash of two names only costs a check
    classes = signed.groupBy("digest").agg(F.min("id").alias("rep"), F.min("lanes").alias("lanes"), F.count(F.lit(1)).alias("size"))
    reps = stage(classes.select("digest", "rep", "lanes", "size", F.xxhash64("digest").alias("h")), "reps")
    # a class may hold a third of all rows
    salts = 1 + (reps.agg(F.max("size")).first()[0] or 0) // _CLASS_TOGETHER
    members = salted_join(signed.select("id", "digest").distinct(), reps.select("digest", "rep"), ["digest"], F.col("id"), "inner", min(salts, 1000)).select("id", "rep")
    pairs = candidate_pairs(reps.select("h", "lanes"), c)
    left = reps.select(F.col("h").alias("a"), F.col("lanes").alias("la"))
    right = reps.select(F.col("h").alias("b"), F.col("lanes").alias("lb"))
    near = pairs.join(left, "a").join(right, "b").select("a", "b", "la", "lb").mapInArrow(_near(c), "a bigint, b bigint")
    near = stage(near, "near")
    # the word sequences of records in some near pair, read again from their texts
    needed = near.select(F.explode(F.array("a", "b")).alias("h")).distinct()
    wanted = stage(reps.join(needed, "h").select("h", F.col("rep").alias("id"), "digest"), "wanted")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for b in batches:
            h, digests = b.column("h").to_pylist(), b.column("digest").to_pylist()
            rows = []
            for k, t in enumerate(b.column("text").to_pylist()):
                s = shingles(hasher(words(t)), c.width)
                if len(s) and xxhash.xxh3_128_digest(s) == digests[k]:
                    rows.append((h[k], b.column("id")[k].as_py(), s.tobytes()))
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], b.column("id").type), pa.array([r[2] for r in rows], pa.binary())], names=["h", "rep", "seqs"])

    kind = texts.schema["id"].dataType.simpleString()
    # only texts that are likely wanted go through the shuffle
    seqs = keep_likely(texts, "id", wanted).join(wanted, "id").select("h", "id", "digest", "text").mapInArrow(sets, f"h bigint, rep {kind}, seqs binary")
    seqs = stage(seqs.dropDuplicates(["h", "rep"]), "sequences")
    a = seqs.select(F.col("h").alias("a"), F.col("rep").alias("rep_a"), F.col("seqs").alias("sa"))
    b = seqs.select(F.col("h").alias("b"), F.col("rep").alias("rep_b"), F.col("seqs").alias("sb"))
    both = near.join(a, "a").join(b, "b").select("rep_a", "rep_b", "sa", "sb")
    links = both.mapInArrow(_exact(c), f"a {kind}, b {kind}").select(F.least("a", "b").alias("rep_a"), F.greatest("a", "b").alias("rep_b")).distinct()
    return members, links


def expand_pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """(id_a, id_b) of all pairs of different records, smaller first, that are alike or linked."""
    ma = members.select(F.col("id").alias("x"), F.col("rep").alias("rep_a"))
    mb = members.select(F.col("id").alias("y"), F.col("rep").alias("rep_b"))
    linked = links.join(ma, "rep_a").join(mb, "rep_b").select("x", "y")
    several = members.groupBy("rep").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("rep").alias("rep_a"))
    alike = several.join(ma, "rep_a").join(mb, F.col("rep_a") == F.col("rep_b")).where("x < y").select("x", "y")
    both = linked.unionByName(alike).where("x <> y")
    return both.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


def near_duplicate_groups(members: DataFrame, links: DataFrame) -> DataFrame:
    """(id, class_id, links): the class of each record under similarity carried on from record to record, and to how
    many classes of different text its own is linked."""
    ends = links.select("rep_a", "rep_b").unionByName(links.select(F.col("rep_b").alias("rep_a"), F.col("rep_a").alias("rep_b")))
    degree = ends.groupBy("rep_a").agg(F.count(F.lit(1)).alias("links")).withColumnRenamed("rep_a", "rep")
    comps = connected_components(links, "rep_a", "rep_b").withColumnRenamed("node", "rep")
    out = members.join(comps, "rep", "left").join(degree, "rep", "left")
    return out.select("id", F.coalesce("component", "rep").alias("class_id"), F.coalesce("links", F.lit(0)).cast("bigint").alias("links"))
