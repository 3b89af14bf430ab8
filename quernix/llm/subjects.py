"""Subject areas of documents by bisecting k-means over document vectors.

Copies are one text in all that follows; their documents get its subjects at the end, and count only where a word or a
leaf needs a least number of documents.

1. Every text becomes its sequence of words; document frequencies are counted over all texts, and the vocabulary is the
   `vocabulary` most frequent words. Of words that are in more than `common` of all texts only those count that labelled
   texts of some subject have far more often than the others; without labels none.
2. Every document becomes a vector: tf-idf over the vocabulary, words that seldom come twice in a text weighing less,
   projected by random signs to `dims` and normalised.
3. Bisecting k-means splits all documents, level by level: a pass sends down the tree, adds up both children of each
   leaf, and a leaf splits again until there are `leaves`.
4. A leaf's mixture of subjects comes from the labelled documents in it, or near it where it has few. A word's mixture
   is that of the leaves it occurs in, together with that of the labelled documents that have it; words far more
   frequent in one subject than elsewhere are its discriminative terms. Two more passes take documents' own mixtures in
   place of their leaves' mixtures.
5. Every document becomes a second vector, its mentions of discriminative terms by subject, normalised, and bisecting
   k-means splits these in the same way. So the discriminative terms label each leaf: its centroid is its mixture of
   subjects. A document without such terms has the vector of its first leaf's mixture.
6. A document's mixture is that of the leaves near it, weighted by likeness, and every subject with a substantial share
   in it is assigned.

Only labelled documents are sampled, `label_sample` rows at most, by the order of a hash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernix.functions.words import fold
from quernix.operators.skew import salted_join
from quernix.runtime import ship, stage

_LETTERS = re.compile(r"[^\W\d_]+")
_TWICE_ENCODED = re.compile("[ÃÂâ][\u0080-¿Œ-™]")


@dataclass(frozen=True)
class SubjectModel:
    vocabulary: int = 6000
    common: float = 0.1
    least_df: int = 5
    dims: int = 128
    #: Leaves of the tree over words, and of the tree over subjects, of which documents take their mixtures.
    leaves: int = 64
    mixture_leaves: int = 768
    rounds: int = 1
    least_leaf: int = 8
    label_sample: int = 20_000
    #: Labelled documents that a term's leaves count for.
    leaf_weight: float = 4.0
    #: A discriminative term's odds of its subject, against the subject's odds among all mentions, and its share in it.
    least_lift: float = 2.2
    least_share: float = 0.35
    #: How much likelier than the next subject a term has to make its own.
    least_lead: float = 2.2
    #: Share of a document's mixture that makes a subject a substantial part of it.
    substantial: float = 0.2
    #: How fast a leaf's weight falls with its distance: weights are exp(sharpness * cosine).
    sharpness: float = 50.0


def subject_name(label: str | None) -> str | None:
    """A label in the spelling of subject areas: lower case, underscores for blanks."""
    return re.sub(r"[\W_]+", "_", fold(label)).strip("_") if label is not None else None


def repair(text: str) -> str:
    """UTF-8 read as a one-byte encoding turned back, where it goes."""
    if _TWICE_ENCODED.search(text):
        return text.encode("cp1252", "ignore").decode("utf-8", "ignore")
    return text


def text_words(text: str) -> list[str]:
    return _LETTERS.findall(fold(repair(text)))


def _read_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, digest, codes, words): 32-bit hashes of the words in order and their digest; words are those this task
    met for the first time."""
    known: dict[str, int] = {}
    for b in batches:
        if len(known) > 1_000_000:
            known.clear()
        codes, fresh = [], []
        for t in b.column(1).to_pylist():
            ws, new = text_words(t), []
            try:
                row = [known[w] for w in ws]
            except KeyError:
                for w in ws:
                    if w not in known:
                        # short words are gaps between others
                        known[w] = xxhash.xxh32_intdigest(w) if len(w) > 2 else 0
                        if len(w) > 2:
                            new.append(w)
                row = [known[w] for w in ws]
            codes.append(np.array(row, dtype=np.uint32).tobytes())
            fresh.append(new)
        digests = [xxhash.xxh3_128_digest(x) for x in codes]
        yield pa.record_batch([b.column(0), pa.array(digests, pa.binary()), pa.array(codes, pa.binary()), pa.array(fresh, pa.list_(pa.string()))], names=["doc_id", "digest", "codes", "words"])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        flat, doc = _flat(b.column(0).to_pylist(), np.uint32)
        flat = flat.astype(np.int64)
        code, cf = np.unique(flat, return_counts=True)
        once = np.unique(doc * np.int64(2**32) + flat)
        at, copies = np.searchsorted(code, once % 2**32), b.column(1).to_numpy()
        df = np.bincount(at, minlength=len(code))
        rows = np.bincount(at, weights=copies[once // 2**32], minlength=len(code))
        yield pa.record_batch([pa.array(code), pa.array(df.astype(np.int64)), pa.array(cf.astype(np.int64)), pa.array(rows.astype(np.int64))], names=["code", "df", "cf", "docs"])


def _codes_among(wanted: np.ndarray):
    """Which of the wanted codes, sorted, each text has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            terms = []
            for x in b.column(2).to_pylist():
                terms.append(np.flatnonzero(np.isin(wanted, np.frombuffer(x, dtype=np.uint32))).astype(np.int32).tobytes())
            yield pa.record_batch([b.column(0), b.column(1), pa.array(terms, pa.binary())], names=["digest", "subject", "terms"])

    return run


def telling(has: np.ndarray, texts: np.ndarray, total: np.ndarray, n: float, m: SubjectModel) -> np.ndarray:
    """Which words some subject's texts have least_lift times as often as the other labelled ones, by more than chance.
    has: (subjects, words) texts of a subject that have a word, of texts; total: all labelled ones with it, of n."""
    others = np.maximum(n - texts, 1.0)[:, None]
    inside, outside = has / np.maximum(texts, 1e-9)[:, None], np.clip((total - has) / others, 1e-9, 1.0)
    chance = 4 * np.sqrt(outside * (1 - outside) / np.maximum(texts, 1e-9)[:, None])
    return ((inside - chance >= m.least_lift * outside) & (texts[:, None] > 0)).any(axis=0)


def _flat(blobs: list[bytes], dtype) -> tuple[np.ndarray, np.ndarray]:
    """All values of the blobs in a row, and to which blob each belongs."""
    sizes = np.array([len(x) for x in blobs]) // np.dtype(dtype).itemsize
    return np.frombuffer(b"".join(blobs), dtype=dtype), np.repeat(np.arange(len(blobs)), sizes)


@dataclass
class _Space:
    codes: np.ndarray  # sorted hashes of the vocabulary
    idf: np.ndarray
    signs: np.ndarray  # (vocabulary, dims)

    def terms(self, blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Vocabulary place of each word, -1 for others, and the document of each."""
        flat, doc = _flat(blobs, np.uint32)
        at = np.minimum(np.searchsorted(self.codes, flat), len(self.codes) - 1)
        return np.where(self.codes[at] == flat, at, -1).astype(np.int32), doc

    def vectors(self, term: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        on = term >= 0
        key, tf = np.unique(doc[on].astype(np.int64) * len(self.codes) + term[on], return_counts=True)
        d, t = key // len(self.codes), key % len(self.codes)
        w = ((1 + np.log(tf)) * self.idf[t]).astype(np.float32)
        out = np.zeros((n, self.signs.shape[1]), dtype=np.float32)
        if len(d):
            first = np.concatenate([[0], np.flatnonzero(np.diff(d)) + 1])
            out[d[first]] = np.add.reduceat(w[:, None] * self.signs[t], first, axis=0)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def _to_vectors(space: _Space):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                term, doc = space.terms(part.column(1).to_pylist())
                vec = space.vectors(term, doc, part.num_rows).astype(np.float16)
                # words outside the vocabulary count only as gaps, of which one is enough
                gap = (term < 0) & np.concatenate([[False], (term[:-1] < 0) & (doc[1:] == doc[:-1])])[: len(term)]
                term, doc = term[~gap], doc[~gap]
                cut = np.searchsorted(doc, np.arange(part.num_rows + 1))
                terms = [term[cut[k] : cut[k + 1]].tobytes() for k in range(part.num_rows)]
                yield pa.record_batch([part.column(0), pa.array(terms, pa.binary()), pa.array([v.tobytes() for v in vec], pa.binary()), part.column(2)], names=["digest", "terms", "vec", "n"])

    return run


@dataclass
class _Tree:
    """Nodes in order of creation; children holds the places of both children, -1 at leaves."""

    centroids: np.ndarray
    children: np.ndarray

    def descend(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), dtype=np.int64)
        while True:
            kids = self.children[node]
            inner = np.flatnonzero(kids[:, 0] >= 0)
            if not len(inner):
                return node
            a, b = kids[inner, 0], kids[inner, 1]
            left = np.einsum("ij,ij->i", x[inner], self.centroids[a]) >= np.einsum("ij,ij->i", x[inner], self.centroids[b])
            node[inner] = np.where(left, a, b)

    def leaves(self) -> np.ndarray:
        return np.flatnonzero(self.children[:, 0] < 0)


def _vectors_of(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype=np.float16).reshape(len(blobs), -1).astype(np.float32)


_SEEDS = 6


def _sum_leaves(tree: _Tree):
    """Per leaf of a task: number and sum of vectors, their documents, and the different vectors of least hash as seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dims = tree.centroids.shape
        total, n, docs, seeds = np.zeros((k, dims)), np.zeros(k, dtype=np.int64), np.zeros(k, dtype=np.int64), {}
        for b in batches:
            if not b.num_rows:
                continue
            x = _vectors_of(b.column(1).to_pylist())
            leaf = tree.descend(x)
            order = np.argsort(leaf, kind="stable")
            at = np.flatnonzero(np.concatenate([[True], np.diff(leaf[order]) > 0]))
            here = leaf[order][at]
            total[here] += np.add.reduceat(x[order].astype(np.float64), at, axis=0)
            n += np.bincount(leaf, minlength=k)
            docs += np.bincount(leaf, weights=b.column(2).to_numpy(), minlength=k).astype(np.int64)
            rank = b.column(0).to_numpy(zero_copy_only=False)
            for s, e, node in zip(at, [*at[1:], len(order)], here, strict=True):
                rows = order[s:e]
                rows = rows[x[rows].any(axis=1)]  # a text without terms has no direction
                rows = rows[np.unique(rank[rows], return_index=True)[1][:_SEEDS]]  # equal vectors are one seed
                seeds[node] = sorted({*seeds.get(node, []), *((int(rank[r]), x[r].astype(np.float32).tobytes()) for r in rows)})[:_SEEDS]
        on = np.flatnonzero(n)
        yield pa.record_batch(
            [pa.array(on), pa.array(n[on]), pa.array(docs[on]), pa.array([total[j].tobytes() for j in on], pa.binary()), pa.array([[r for r, _ in seeds[j]] for j in on], pa.list_(pa.int64())), pa.array([b"".join(v for _, v in seeds[j]) for j in on], pa.binary())],
            names=["node", "n", "docs", "total", "ranks", "seeds"],
        )

    return run


def _merge_leaves(t: pa.Table) -> pa.Table:
    """One row for each of some nodes from those of all tasks."""
    nodes, total = t.column("node").to_numpy(), np.stack([np.frombuffer(x) for x in t.column("total").to_pylist()])
    ranks, seeds, n, docs = t.column("ranks").to_pylist(), t.column("seeds").to_pylist(), t.column("n").to_numpy(), t.column("docs").to_numpy()
    size = 4 * total.shape[1]
    rows = []
    for node in np.unique(nodes).tolist():
        on = np.flatnonzero(nodes == node)
        pool = sorted({(r, seeds[i][k * size : (k + 1) * size]) for i in on.tolist() for k, r in enumerate(ranks[i])})[:_SEEDS]
        rows.append((node, int(n[on].sum()), int(docs[on].sum()), total[on].sum(axis=0).tobytes(), [r for r, _ in pool], b"".join(v for _, v in pool)))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary())
    return pa.table({name: pa.array([r[k] for r in rows], kind) for k, (name, kind) in enumerate(zip(("node", "n", "docs", "total", "ranks", "seeds"), kinds, strict=True))})


_NODE_SCHEMA = "node bigint, n bigint, docs bigint, total binary, ranks array<bigint>, seeds binary"
#: Rows of tasks that are merged together, unless one node has more.
_MERGED_TOGETHER = 20_000


def _pass(vectors: DataFrame, tree: _Tree) -> dict[int, tuple[int, np.ndarray, np.ndarray, int]]:
    """Number of texts, sum, seeds and number of documents of every leaf; as many rows come to the driver as there are leaves."""
    rows = vectors.select(F.xxhash64("vec").alias("rank"), "vec", "n")
    nodes, tasks = len(tree.centroids), rows.rdd.getNumPartitions()
    groups = min(nodes, max(4, nodes * tasks // _MERGED_TOGETHER))
    of_tasks = rows.mapInArrow(_sum_leaves(tree), _NODE_SCHEMA).withColumn("g", F.pmod("node", F.lit(groups)))
    got = of_tasks.groupBy("g").applyInArrow(_merge_leaves, _NODE_SCHEMA).collect()
    dims = tree.centroids.shape[1]
    return {r["node"]: (r["n"], np.frombuffer(r["total"]), np.frombuffer(r["seeds"], dtype=np.float32).reshape(-1, dims), r["docs"]) for r in got}


def _unit(v: np.ndarray) -> np.ndarray:
    return (v / max(np.linalg.norm(v), 1e-9)).astype(np.float32)


def bisecting_kmeans(vectors: DataFrame, dims: int, m: SubjectModel) -> tuple[_Tree, dict[int, int]]:
    """Tree of m.leaves leaves at most over (digest, vec, n), and the texts of each leaf. What a leaf needs to be split
    is told by its documents, which of them goes first by its texts."""
    tree = _Tree(np.zeros((1, dims), dtype=np.float32), np.full((1, 2), -1))
    seen = _pass(vectors, tree)
    if 0 in seen:
        tree.centroids[0] = _unit(seen[0][1])
    while True:
        leaves = [j for j in tree.leaves().tolist() if j in seen and seen[j][3] >= 2 * m.least_leaf and len(seen[j][2]) > 1]
        room = m.leaves - len(tree.leaves())
        leaves = sorted(leaves, key=lambda j: (-seen[j][0], j))[:room]
        fresh = []
        for j in leaves:
            s = seen[j][2]
            sim = s @ s.T
            a, b = np.unravel_index(np.argmin(sim), sim.shape)
            if sim[a, b] > 0.9999:
                continue
            at = len(tree.centroids)
            tree.centroids = np.vstack([tree.centroids, _unit(s[a]), _unit(s[b])])
            tree.children = np.vstack([tree.children, [[-1, -1], [-1, -1]]])
            tree.children[j] = [at, at + 1]
            fresh += [at, at + 1]
        if not fresh:
            return tree, {j: seen.get(j, (0,))[0] for j in tree.leaves().tolist()}
        for _ in range(m.rounds):
            seen = _pass(vectors, tree)
            for j in fresh:
                if j in seen:
                    tree.centroids[j] = _unit(seen[j][1])


def _leaf_terms(tree: _Tree, size: int):
    """Occurrences of each term in each leaf, and over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(tree.centroids)
        n = np.zeros(k * size, dtype=np.int64)
        for b in batches:
            if b.num_rows:
                leaf = tree.descend(_vectors_of(b.column(1).to_pylist()))
                term, doc = _flat(b.column(0).to_pylist(), np.int32)
                on = term >= 0
                n += np.bincount(leaf[doc[on]] * size + term[on], minlength=k * size)
        at = np.flatnonzero(n)
        yield pa.record_batch([pa.array((at // size).astype(np.int64)), pa.array((at % size).astype(np.int64)), pa.array(n[at].astype(np.float64))], names=["part", "term", "n"])

    return run


def _mentions(term: np.ndarray, doc: np.ndarray, tag: np.ndarray, n_docs: int, n_subjects: int) -> np.ndarray:
    """(documents, subjects) mentions: neighbouring words of one subject are one mention."""
    subject = np.where(term >= 0, tag[term], -1)
    start = (subject >= 0) & np.concatenate([[True], (subject[1:] != subject[:-1]) | (doc[1:] != doc[:-1])])[: len(subject)]
    return np.bincount(doc[start] * n_subjects + subject[start], minlength=n_docs * n_subjects).reshape(n_docs, n_subjects)


def _subject_terms(tag: np.ndarray, n_subjects: int):
    """Occurrences of each term by subject, every document's divided by its own mixture."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(tag)
        n = np.zeros((n_subjects, size))
        for b in batches:
            if b.num_rows:
                term, doc = _flat(b.column(0).to_pylist(), np.int32)
                seen = _mentions(term, doc, tag, b.num_rows, n_subjects).astype(np.float64)
                mix = (seen**2) / np.maximum((seen**2).sum(axis=1, keepdims=True), 1e-9)
                on = term >= 0
                t, d = term[on], doc[on]
                for s in range(n_subjects):
                    n[s] += np.bincount(t, weights=mix[d, s], minlength=size)
        s, t = np.nonzero(n)
        yield pa.record_batch([pa.array(s.astype(np.int64)), pa.array(t.astype(np.int64)), pa.array(n[s, t])], names=["part", "term", "n"])

    return run


def _term_matrix(rows: DataFrame, parts: int, size: int) -> np.ndarray:
    out = np.zeros((parts, size))
    for r in rows.groupBy("part", "term").agg(F.sum("n").alias("n")).toPandas().itertuples(index=False):
        out[r.part, r.term] = r.n
    return out


def discriminative(counts: np.ndarray, m: SubjectModel, first: bool = False) -> np.ndarray:
    """Subject of each term from its (subjects, terms) occurrences, -1 for terms of no subject. first: occurrences are
    divided by leaves, where small subjects are mixed with large ones, so only lift counts.
    """
    prior = counts.sum(axis=1) / max(counts.sum(), 1e-9)
    share = (counts + 0.5 * prior[:, None]) / (counts.sum(axis=0) + 0.5)
    lift = share / np.maximum(prior[:, None], 1e-9)
    top = np.argmax(lift, axis=0)
    at = np.arange(counts.shape[1])
    second = np.sort(lift, axis=0)[-2] if counts.shape[0] > 1 else np.zeros(counts.shape[1])
    # against all other subjects: a term of a subject with half of all mentions can't have twice their share
    over = lift[top, at] * (1 - prior[top]) / np.maximum(1 - share[top, at], 1e-9)
    good = (over >= m.least_lift) & (first | (share[top, at] >= m.least_share)) & (lift[top, at] >= m.least_lead * second)
    return np.where(good, top, -1)


def _to_subjects(tag: np.ndarray, tree: _Tree, leaf_mixture: np.ndarray):
    """Vector of a text's mentions of discriminative terms by subject, or of its leaf's mixture where it has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            term, doc = _flat(b.column(1).to_pylist(), np.int32)
            seen = _mentions(term, doc, tag, b.num_rows, leaf_mixture.shape[1]).astype(np.float64)
            none = np.flatnonzero(seen.sum(axis=1) == 0)
            if len(none):
                seen[none] = leaf_mixture[tree.descend(_vectors_of(b.column(2).take(pa.array(none)).to_pylist()))]
            vec = (seen / np.maximum(np.linalg.norm(seen, axis=1, keepdims=True), 1e-9)).astype(np.float16)
            yield pa.record_batch([b.column(0), pa.array([v.tobytes() for v in vec], pa.binary()), b.column(3)], names=["digest", "vec", "n"])

    return run


def mixtures(x: np.ndarray, centroids: np.ndarray, sharpness: float) -> np.ndarray:
    """Mixture of subjects of each vector: those of the leaves, weighted by how near they are."""
    like = x @ centroids.T
    weight = np.exp(sharpness * (like - like.max(axis=1, keepdims=True)))
    share = np.maximum(centroids, 0) / np.maximum(np.maximum(centroids, 0).sum(axis=1, keepdims=True), 1e-9)
    return (weight / weight.sum(axis=1, keepdims=True)) @ share


def _assign(tree: _Tree, subjects: list[str], m: SubjectModel):
    centroids = tree.centroids[tree.leaves()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4000):
                part = b.slice(at, 4000)
                share = mixtures(_vectors_of(part.column(1).to_pylist()), centroids, m.sharpness)
                chosen = share >= m.substantial
                chosen[np.arange(len(share)), np.argmax(share, axis=1)] = True
                d, s = np.nonzero(chosen)
                yield pa.record_batch([part.column(0).take(pa.array(d)), pa.array([subjects[k] for k in s], pa.string())], names=["digest", "subject"])

    return run


def document_subjects(docs: DataFrame, areas: DataFrame, labels: DataFrame, m: SubjectModel = SubjectModel()) -> DataFrame:
    """(doc_id, subject) of every non-blank text of docs (doc_id, text); subjects as spelt in areas (subject,
    description); labels (doc_id, subject) may be wrong, null, repeated and spelt otherwise.

    Defined cases: null, empty and blank texts (invisible characters count as blank) have no subject; labels that name
    no area, and of documents that don't exist, don't count; without any usable label, words of the descriptions name
    the leaves; a repeated row counts as another document of the same id and its subjects come out once; a text without
    any letters takes the subject of its leaf; no areas or no documents give an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, subject string"
    described = sorted((r[0], r[1] or "") for r in areas.select("subject", "description").where("subject is not null").distinct().collect())
    subjects = sorted({s for s, _ in described})
    if not subjects:
        return spark.createDataFrame([], schema)
    place = {subject_name(s): k for k, s in enumerate(subjects)}
    full = docs.select("doc_id", "text").where(F.col("text").rlike(r"[^\s\p{Z}\p{C}]"))
    read = stage(full.mapInArrow(_read_words, f"doc_id {kind}, digest binary, codes binary, words array<string>"), "words")
    texts = stage(read.groupBy("digest", "codes").agg(F.count(F.lit(1)).alias("n")), "texts")
    n_texts = texts.count()
    said = labels.select("doc_id", "subject").where("doc_id is not null and subject is not null").distinct()
    said = said.join(read.select("doc_id", "digest").distinct(), "doc_id").groupBy("digest", "subject").agg(F.count(F.lit(1)).alias("n"))
    said = stage(said.orderBy(F.xxhash64("digest"), "digest", "subject").limit(m.label_sample), "labels")
    share = _label_shares(said, place)
    df = texts.select("codes", "n").mapInArrow(_frequencies, "code bigint, df bigint, cf bigint, docs bigint").groupBy("code").agg(*[F.sum(c).alias(c) for c in ("df", "cf", "docs")])
    # a word of copies of few texts tells nothing of others, but where nearly all texts have copies
    few = min(m.least_df, max(1, n_texts // 1000))
    df = stage(df.where((F.col("code") != 0) & (F.col("docs") >= m.least_df) & (F.col("df") >= few)), "frequencies")
    common = F.col("df") > max(m.common * n_texts, m.least_df)
    often = np.sort(df.where(common).orderBy(F.desc("df"), "code").limit(m.vocabulary).toPandas()["code"].to_numpy()).astype(np.uint32)
    keep = []
    if len(often) and share:
        rows = texts.drop("n").join(F.broadcast(said), "digest").select("digest", "subject", "codes").mapInArrow(_codes_among(often), "digest binary, subject string, terms binary").select("digest", "terms").distinct().collect()
        has, total, of, n = np.zeros((len(subjects), len(often))), np.zeros(len(often)), np.zeros(len(subjects)), 0
        for r in rows:
            if told := share.get(bytes(r["digest"])):
                t = np.frombuffer(r["terms"], dtype=np.int32)
                total[t] += 1
                n += 1
                for k, w in told.items():
                    has[k, t] += w
                    of[k] += w
        keep = [int(c) for c in often[telling(has, of, total, n, m)]]
    vocab = df.where(~common | F.col("code").isin(keep)).orderBy(F.desc("df"), "code").limit(m.vocabulary).toPandas()
    if not len(vocab):
        return spark.createDataFrame([], schema)
    vocab = vocab.sort_values("code")
    codes = vocab["code"].to_numpy().astype(np.uint32)
    names = spark.createDataFrame(pd.DataFrame({"code": codes.astype(np.int64)}))
    known = read.select(F.explode("words").alias("word")).mapInArrow(_code_words(codes), "word string, code bigint").distinct()
    name_of = {r["code"]: r["word"] for r in known.join(F.broadcast(names), "code", "left_semi").collect()}
    rng = np.random.default_rng(7)
    signs = (rng.integers(0, 2, (len(codes), m.dims)) * 2 - 1).astype(np.float32) / np.float32(np.sqrt(m.dims))
    # words of a matter come again in a text that has them, words of phrasing don't
    burst = np.log(vocab["cf"].to_numpy() / vocab["df"].to_numpy()) ** 2 + 0.01
    space = _Space(codes, (np.log(n_texts / vocab["df"].to_numpy() + 1) * burst).astype(np.float32), signs)
    vectors = stage(texts.select("digest", "codes", "n").mapInArrow(_to_vectors(space), "digest binary, terms binary, vec binary, n bigint"), "vectors")

    tree, _ = bisecting_kmeans(vectors.select("digest", "vec", "n"), m.dims, m)
    leaf_of = tree.leaves()
    in_leaf = _term_matrix(vectors.select("terms", "vec").mapInArrow(_leaf_terms(tree, len(codes)), "part bigint, term bigint, n double"), len(tree.centroids), len(codes))

    rows = vectors.select("digest", "vec", "terms").join(F.broadcast(said.select("digest").distinct()), "digest").collect() if share else []
    told = [(r["vec"], r["terms"], k, w) for r in sorted(rows, key=lambda r: bytes(r["digest"])) for k, w in share.get(bytes(r["digest"]), {}).items()]
    votes = np.zeros((len(tree.centroids), len(subjects)))
    labelled = np.zeros((len(subjects), len(codes)))
    if told:
        x = _vectors_of([v for v, _, _, _ in told])
        which, weight = np.array([k for _, _, k, _ in told]), np.array([w for _, _, _, w in told])
        for _, terms, k, w in told:
            t = np.unique(np.frombuffer(terms, dtype=np.int32))
            labelled[k, t[t >= 0]] += w
        at = tree.descend(x)
        np.add.at(votes, (at, which), weight)
        near = weight[:, None] * np.maximum(x @ tree.centroids[leaf_of].T, 0) ** 6
        for k in range(len(subjects)):
            votes[leaf_of, k] += 0.2 * near[which == k].sum(axis=0)
    term_at = {name_of.get(int(c)): k for k, c in enumerate(codes)}
    for s, text in described:
        for w in {*text_words(text), *text_words(s)}:
            if w in term_at:
                votes[:, place[subject_name(s)]] += 0.05 * in_leaf[:, term_at[w]] / max(in_leaf[:, term_at[w]].sum(), 1e-9) * len(leaf_of)
    mixture = votes / np.maximum(votes.sum(axis=1, keepdims=True), 1e-9)
    by_leaf = mixture.T @ in_leaf
    # where a leaf holds several subjects, labelled documents with the term tell them apart
    counts = labelled + m.leaf_weight * by_leaf / np.maximum(by_leaf.sum(axis=0), 1e-9)
    tag = discriminative(counts, m, first=True)
    for _ in range(2):
        rows = vectors.select("terms").mapInArrow(_subject_terms(tag, len(subjects)), "part bigint, term bigint, n double")
        tag = discriminative(_term_matrix(rows, len(subjects), len(codes)), m)
    by_terms = np.stack([in_leaf[:, tag == k].sum(axis=1) for k in range(len(subjects))], axis=1)
    first = np.where(by_terms.sum(axis=1, keepdims=True) > 0, by_terms, np.where(votes.sum(axis=1, keepdims=True) > 0, votes, 1.0))
    first = first / first.sum(axis=1, keepdims=True)
    shares = stage(vectors.select("digest", "terms", "vec", "n").mapInArrow(_to_subjects(tag, tree, first), "digest binary, vec binary, n bigint"), "subject-vectors")
    fine, _ = bisecting_kmeans(shares, len(subjects), replace(m, leaves=m.mixture_leaves, least_leaf=1))
    assigned = shares.select("digest", "vec").mapInArrow(_assign(fine, subjects, m), "digest binary, subject string")
    # one text may have copies in a large part of all documents
    of_text = assigned.groupBy("digest").agg(F.collect_set("subject").alias("all"))
    parts = salted_join(read.select("doc_id", "digest"), of_text, ["digest"], F.col("doc_id"), "inner")
    return parts.select("doc_id", F.explode("all").alias("subject")).distinct()


def _label_shares(said: DataFrame, place: dict[str, int]) -> dict[bytes, dict[int, float]]:
    """Weights of the subjects of each labelled text: how often its copies are labelled so, against their commonest."""
    counts: dict[bytes, dict[int, float]] = {}
    for r in said.collect():
        if (k := place.get(subject_name(r["subject"]))) is not None:
            own = counts.setdefault(bytes(r["digest"]), {})
            own[k] = own.get(k, 0.0) + r["n"]
    return {d: {k: n / max(own.values()) for k, n in own.items()} for d, own in counts.items()}


def _code_words(codes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ws = list(set(b.column(0).to_pylist()))
            x = np.array([xxhash.xxh32_intdigest(w) for w in ws], dtype=np.uint32)
            on = np.isin(x, codes)
            yield pa.record_batch([pa.array([w for w, k in zip(ws, on, strict=True) if k], pa.string()), pa.array(x[on].astype(np.int64))], names=["word", "code"])

    return run
