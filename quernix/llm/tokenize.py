"""Encoding with a public byte-level BPE vocabulary, the merges run as recursive queries of an in-process SQL engine.

A partition's texts are cut into words by the vocabulary's pattern. The distinct words go, as rows of (word, position,
token), through a recursive query: in each step every word finds the rank of each neighbouring pair in the merge table
and contracts its pairs of least rank from the left, until no pair is left; an ordered aggregation then reads the ids.
All pairs of that rank may go in one step, since a merge only makes pairs of later ranks: a token is in no merge before
the one that makes it. Where the same token stands several times in a row, every other pair of the run goes.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernix.runtime import ship

DEFAULT_TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
#: The published word pattern of this family of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words of more bytes than this are merged by a heap instead of step by step; the ids are the same. A word of 5,000
#: letters without a break takes the query 3.5 s, since its steps are as many as the different pairs merged.
LONG_WORD = 4096
_CACHE_LIMIT = 400_000

MERGE_QUERY = """
WITH RECURSIVE step(word, pos, tok, more) AS (
  SELECT word, pos, tok, true FROM pieces
  UNION ALL
  SELECT word, pos, tok, more FROM (
    SELECT word, pos, CASE WHEN hit THEN new_id ELSE tok END AS tok, best IS NOT NULL AS more, lag(hit, 1, false) OVER w AS eaten
    FROM (
      SELECT *, least_rank AND (k - coalesce(last_value(CASE WHEN NOT least_rank THEN k END IGNORE NULLS) OVER w, 0)) % 2 = 1 AS hit
      FROM (
        SELECT *, best IS NOT NULL AND coalesce(rank = best, false) AS least_rank, row_number() OVER w AS k
        FROM (
          SELECT p.word, p.pos, p.tok, m.new_id, m.rank, min(m.rank) OVER (PARTITION BY p.word) AS best
          FROM (SELECT word, pos, tok, lead(tok) OVER (PARTITION BY word ORDER BY pos) AS nxt FROM step WHERE more) p
          LEFT JOIN merges m ON m.a = p.tok AND m.b = p.nxt
        )
        WINDOW w AS (PARTITION BY word ORDER BY pos)
      )
      WINDOW w AS (PARTITION BY word ORDER BY pos)
    )
    WINDOW w AS (PARTITION BY word ORDER BY pos)
  ) WHERE NOT eaten
)
SELECT word, list(tok ORDER BY pos) AS ids FROM step WHERE NOT more GROUP BY word
"""


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in this family's files."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {}, 0
    for b in range(256):
        if b in keep:
            out[chr(b)] = b
        else:
            out[chr(256 + extra)] = b
            extra += 1
    return out


class ByteBpe:
    """Encoder of one tokenizer file. Ids of words are remembered; the memory is emptied when full."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, alphabet = model["vocab"], byte_alphabet()
        self.first = np.zeros(256, dtype=np.int32)
        for ch, b in alphabet.items():
            self.first[b] = vocab[ch]
        pairs = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        a, b = [vocab[x] for x, _ in pairs], [vocab[y] for _, y in pairs]
        new = [vocab[x + y] for x, y in pairs]
        self.rank = {(x, y): (r, z) for r, (x, y, z) in enumerate(zip(a, b, new, strict=True))}
        self.words = regex.compile(PATTERN)
        self.known: dict[str, list[int]] = {}
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB"})
        rows = pa.table({"a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()), "rank": pa.array(range(len(a)), pa.int32()), "new_id": pa.array(new, pa.int32())})
        self.db.register("merge_rows", rows)
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merge_rows")

    def long_word(self, raw: bytes) -> list[int]:
        """The same merges, leftmost of least rank first, by a heap over a linked list: for long runs without a break."""
        tok = self.first[np.frombuffer(raw, dtype=np.uint8)].tolist()
        n = len(tok)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r[0], i, tok[i], tok[i + 1]) for i in range(n - 1) if (r := self.rank.get((tok[i], tok[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, x, y = heapq.heappop(heap)
            j = nxt[i]
            if tok[i] != x or j >= n or tok[j] != y:
                continue
            tok[i], tok[j] = self.rank[(x, y)][1], -1
            nxt[i] = k = nxt[j]
            if k < n:
                prv[k] = i
                if r := self.rank.get((tok[i], tok[k])):
                    heapq.heappush(heap, (r[0], i, tok[i], tok[k]))
            if (p := prv[i]) >= 0 and (r := self.rank.get((tok[p], tok[i]))):
                heapq.heappush(heap, (r[0], p, tok[p], tok[i]))
        return [t for t in tok if t >= 0]

    def learn(self, new: list[str]) -> None:
        """Merges words that aren't known yet."""
        raws = [w.encode("utf-8", "surrogatepass") for w in new]
        short = []
        for k, raw in enumerate(raws):
            if len(raw) == 1:
                self.known[new[k]] = [int(self.first[raw[0]])]
            elif len(raw) > LONG_WORD:
                self.known[new[k]] = self.long_word(raw)
            else:
                short.append(k)
        for at in range(0, len(short), 20_000):
            part = short[at : at + 20_000]
            sizes = np.array([len(raws[k]) for k in part])
            joined = np.frombuffer(b"".join(raws[k] for k in part), dtype=np.uint8)
            word = np.repeat(np.arange(len(part), dtype=np.int32), sizes)
            pos = (np.arange(len(joined)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
            self.db.register("pieces", pa.table({"word": word, "pos": pos, "tok": self.first[joined]}))
            got = self.db.sql(MERGE_QUERY).to_arrow_table()
            self.db.unregister("pieces")
            for w, ids in zip(got.column("word").to_pylist(), got.column("ids").to_pylist(), strict=True):
                self.known[new[part[w]]] = ids

    def encode_batch(self, texts: list[str | None]) -> list[list[list[int]]]:
        """The ids of each word of each text; nothing for a null text."""
        if len(self.known) > _CACHE_LIMIT:
            self.known.clear()
        cut = [self.words.findall(t) if t else [] for t in texts]
        known = self.known
        self.learn([w for w in {w for ws in cut for w in ws} if w not in known])
        return [[known[w] for w in ws] for ws in cut]


_encoders: dict[str, ByteBpe] = {}


def encoder(path: str) -> ByteBpe:
    if path not in _encoders:
        _encoders[path] = ByteBpe(path)
    return _encoders[path]


def _encoded(path: str, sizes_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                got = bpe.encode_batch(part.column(1).to_pylist())
                sizes = np.array([sum(map(len, ws)) for ws in got], dtype=np.int64)
                if sizes_only:
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes)], names=["id", "n_tokens"])
                    continue
                flat = np.fromiter((i for ws in got for w in ws for i in w), dtype=np.int32, count=int(sizes.sum()))
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["id", "ids"])

    return run


def encode(df: DataFrame, id_col: str, text: Column, path: str = DEFAULT_TOKENIZER) -> DataFrame:
    """(id_col, ids) for every row of df, ids without special tokens, whose strings count as ordinary text.

    Defined cases: null and empty texts get the empty list; a null id stays null; repeated rows come out as often;
    other columns are left out; an empty table gives an empty one. path names the tokenizer file on every executor.
    """
    return _apply(df, id_col, text, path, "ids array<int>", False)


def token_counts(df: DataFrame, id_col: str, text: Column, path: str = DEFAULT_TOKENIZER) -> DataFrame:
    """(id_col, n_tokens) for every row of df: the number of ids that encode gives."""
    return _apply(df, id_col, text, path, "n_tokens bigint", True)


def _apply(df: DataFrame, id_col: str, text: Column, path: str, out: str, sizes_only: bool) -> DataFrame:
    ship(df.sparkSession)
    kind = df.select(id_col).schema[0].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), text.alias("text"))
    return rows.mapInArrow(_encoded(path, sizes_only), f"id {kind}, {out}").withColumnRenamed("id", re.sub(r"^.*\.", "", id_col))
