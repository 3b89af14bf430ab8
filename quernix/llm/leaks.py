"""Evaluation passages in training text, by suffix arrays of the training text.

Each partition of the corpus is cut into shards. A shard's words, as numbers, get a suffix array, in which every suffix
of every test sentence is looked up by binary search; the suffixes that match far enough give records, longest verbatim
matches and their places. Words between which no test sentence goes on are left out of a shard beforehand: they can't be
part of a match of more than one word, so the shard keeps all matches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernix.functions.words import words
from quernix.runtime import ship

_SENTENCE_END = re.compile(r"\.(?=\s|\Z)")
#: Words of a shard; a bound on memory, not on what is searched.
SHARD_WORDS = 2_000_000
#: Most words of all test items, which go to every executor.
MOST_TEST_WORDS = 5_000_000


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes of text in the order of their first depth values (prefix doubling)."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    rank = rank.astype(np.int64)
    order, k = np.argsort(rank, kind="stable"), 1
    while k < depth and n > 1:
        nxt = np.zeros(n, dtype=np.int64)
        nxt[: n - k] = rank[k:] + 1 if k < n else 0
        key = rank * (n + 1) + nxt
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        k *= 2
        if rank[order[-1]] == n - 1:
            break
    return order


def search(text: np.ndarray, order: np.ndarray, queries: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each query queries[starts:starts+lengths], the range of order whose suffixes begin with it: all binary
    searches go on side by side, one value deeper in each round."""
    lo, hi = np.zeros(len(starts), dtype=np.int64), np.full(len(starts), len(order), dtype=np.int64)
    padded = np.append(text, -1)
    n = len(text)
    for d in range(int(lengths.max()) if len(lengths) else 0):
        on = np.flatnonzero((lengths > d) & (lo < hi))
        if not len(on):
            break
        want = queries[starts[on] + d]
        bounds = []
        for right in (False, True):
            a, b = lo[on].copy(), hi[on].copy()
            while True:
                open_ = a < b
                if not open_.any():
                    break
                mid = (a + b) // 2
                value = padded[np.minimum(order[np.minimum(mid, n - 1)] + d, n)]
                below = (value <= want) if right else (value < want)
                a = np.where(open_ & below, mid + 1, a)
                b = np.where(open_ & ~below, mid, b)
            bounds.append(a)
        lo[on], hi[on] = bounds
    return lo, hi


@dataclass
class TestSet:
    """The test sentences as numbers, with what each of their suffixes has to match.

    A run of words that another item has as well doesn't count, so a suffix has to match at least one word further than
    the longest run it shares with another item, and least words in any case.
    """

    items: list[tuple[str, str]]
    least: int = 10
    vocabulary: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        ids, item_of, ends = [], [], []
        for k, (_, instruction) in enumerate(self.items):
            for sentence in _SENTENCE_END.split(instruction):
                ws = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(sentence)]
                ends += [len(ids) + len(ws)] * len(ws)
                ids += ws
                item_of += [k] * len(ws)
            ids.append(-k - 1)
            item_of.append(-1)
            ends.append(len(ids) - 1)
        if len(ids) > MOST_TEST_WORDS:
            raise ValueError(f"test set of {len(ids)} words; at most {MOST_TEST_WORDS} can be sent to executors")
        self.text, self.item_of, self.ends = np.array(ids, dtype=np.int64), np.array(item_of), np.array(ends)
        need = np.maximum(self.least, 1 + self._shared())
        at = np.arange(len(ids))
        self.starts = at[(self.item_of >= 0) & (at + need <= self.ends)] if len(ids) else at
        self.lengths = need[self.starts] if len(ids) else need
        inner = self.item_of[:-1] >= 0 if len(ids) else np.zeros(0, bool)
        inner = inner & (self.item_of[1:] >= 0) if len(ids) else inner
        self.width = len(self.vocabulary) + 1
        self.links = np.unique(self.text[:-1][inner] * self.width + self.text[1:][inner]) if len(ids) else np.zeros(0, np.int64)
        self.depth = int(self.lengths.max()) if len(self.lengths) else 1

    def _shared(self) -> np.ndarray:
        """For each place, the longest run from there that is found in another item, too."""
        n = len(self.text)
        out = np.zeros(n, dtype=np.int64)
        if not n:
            return out
        longest = max(len(words(t)) for _, t in self.items) + 1
        order = suffix_array(self.text, longest).tolist()
        text, item = self.text.tolist(), self.item_of.tolist()

        def common(a: int, b: int) -> int:
            k = 0
            while a + k < n and b + k < n and text[a + k] == text[b + k] and text[a + k] > 0:
                k += 1
            return k

        for seq in (order, order[::-1]):
            other = None  # nearest suffix before this one that belongs to another item than its neighbours
            last = None
            for s in seq:
                if item[s] < 0:
                    continue
                if last is not None and item[last] != item[s]:
                    other = last
                if other is not None:
                    out[s] = max(out[s], common(s, other))
                last = s
        return out


def _shard_matches(test: TestSet, text: np.ndarray, record: np.ndarray, place: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(record, item, words, place in the record, place in the item) of the longest match of each record and item."""
    order = suffix_array(text, test.depth)
    lo, hi = search(text, order, test.text, test.starts, test.lengths)
    hits = np.flatnonzero(lo < hi)
    if not len(hits):
        return []
    times = hi[hits] - lo[hits]
    query = np.repeat(hits, times)
    within = np.arange(len(query)) - np.repeat(np.cumsum(times) - times, times)
    at = order[lo[query] + within]
    start = test.starts[query]
    length = test.lengths[query].astype(np.int64).copy()
    padded = np.append(text, -1)
    going = np.ones(len(query), dtype=bool)
    while going.any():
        t, q = np.minimum(at + length, len(text)), start + length
        going &= (q < test.ends[start]) & (padded[t] == test.text[np.minimum(q, len(test.text) - 1)])
        length += going
    item = test.item_of[start]
    best = np.lexsort((start, place[at], -length, item, record[at]))
    r, i = record[at][best], item[best]
    first = np.concatenate([[True], (r[1:] != r[:-1]) | (i[1:] != i[:-1])])
    pick = best[first]
    return list(zip(record[at[pick]].tolist(), item[pick].tolist(), length[pick].tolist(), place[at[pick]].tolist(), start[pick].tolist(), strict=True))


def _search_partition(test: TestSet):
    names = [x for x, _ in test.items]
    first_of = {}
    for k, i in enumerate(test.item_of.tolist()):
        first_of.setdefault(i, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = test.vocabulary.get
        texts, records, places, keys, held = [], [], [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                found = _shard_matches(test, np.concatenate(texts), np.concatenate(records), np.concatenate(places))
                if found:
                    yield pa.record_batch(
                        [
                            pa.array([keys[f[0]][0] for f in found], pa.string()),
                            pa.array([keys[f[0]][1] for f in found], pa.string()),
                            pa.array([names[f[1]] for f in found], pa.string()),
                            pa.array([f[2] for f in found], pa.int64()),
                            pa.array([f[3] for f in found], pa.int64()),
                            pa.array([f[4] - first_of[f[1]] for f in found], pa.int64()),
                        ],
                        names=["corpus", "record_id", "task_id", "n_words", "text_word", "item_word"],
                    )

        for b in batches:
            for corpus, key, text in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                ws = words(text)
                if len(ws) < test.least:
                    continue
                x = np.fromiter((get(w, 0) for w in ws), dtype=np.int64, count=len(ws))
                code = x[:-1] * test.width + x[1:]
                k = np.searchsorted(test.links, code)
                linked = test.links[np.minimum(k, len(test.links) - 1)] == code
                # runs of linked neighbours; a match of `least` words has least - 1 links
                edge = np.flatnonzero(np.diff(np.concatenate([[0], linked.view(np.int8), [0]])))
                for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                    if e - s >= test.least - 1:
                        texts.append(np.append(x[s : e + 1], 0))
                        places.append(np.arange(s, e + 2))
                        records.append(np.full(e - s + 2, len(keys), dtype=np.int64))
                        held += e - s + 2
                keys.append((corpus, key))
                if held > SHARD_WORDS:
                    yield from flush()
                    texts, records, places, keys, held = [], [], [], [], 0
        yield from flush()

    return run


def find_leaks(corpus: DataFrame, items: DataFrame, least: int = 10) -> DataFrame:
    """Longest match of each (corpus, record_id) of corpus with each (task_id, instruction) of items:
    (corpus, record_id, task_id, n_words, text_word, item_word), places counted in words from 0. A match lies within a
    sentence of the instruction, has at least `least` words, and isn't found in the instructions of another item.

    The items are a stated test set: they are collected, and refused if larger than MOST_TEST_WORDS.
    Defined cases: null texts, instructions and task ids match nothing; texts shorter than least words match nothing;
    a record with several texts gets the longest match of all; repeated rows count once; of equal matches the earliest
    in the text holds; empty tables give an empty result.
    """
    spark = corpus.sparkSession
    ship(spark)
    rows = items.select("task_id", "instruction").where("task_id is not null and instruction is not null").distinct().collect()
    test = TestSet(sorted((r[0], r[1]) for r in rows), least)
    schema = "corpus string, record_id string, task_id string, n_words bigint, text_word bigint, item_word bigint"
    if not len(test.starts):
        return spark.createDataFrame([], schema)
    texts = corpus.select("corpus", "record_id", "text").where("text is not null and record_id is not null")
    found = texts.mapInArrow(_search_partition(test), schema)
    best = found.groupBy("corpus", "record_id", "task_id").agg(F.max(F.struct("n_words", (-F.col("text_word")).alias("t"), (-F.col("item_word")).alias("i"))).alias("m"))
    return best.select("corpus", "record_id", "task_id", "m.n_words", (-F.col("m.t")).alias("text_word"), (-F.col("m.i")).alias("item_word"))


def remove_leaked(corpus: DataFrame, leaks: DataFrame, keys: tuple[str, ...] = ("corpus", "record_id")) -> DataFrame:
    """The records of corpus without a leak; a record is told by its corpus and id together."""
    return corpus.join(leaks.select(*keys).distinct(), list(keys), "left_anti")
