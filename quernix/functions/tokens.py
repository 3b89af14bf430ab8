"""Token ids of a public tokenizer for conversations, by its library, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernix.functions.pyfunctions import token_mask, trained_spans
from quernix.functions.text import chat_render
from quernix.runtime import ship

DEFAULT_TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The tokenizer of a file; strings of special tokens in a text are ordinary text."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def _lists(rows: list[list[int]]) -> pa.Array:
    sizes = np.array([len(r) for r in rows], dtype=np.int64)
    flat = np.fromiter((x for r in rows for x in r), dtype=np.int32, count=int(sizes.sum()))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat))


def with_token_ids(df: DataFrame, text: Column, path: str = DEFAULT_TOKENIZER) -> DataFrame:
    """df with input_ids of a text, without special tokens; none for a null or empty text. A column input_ids of df is
    replaced."""
    return _with_tokens(df, text, F.lit(None).cast("int"), path, False)


def with_conversation_tokens(df: DataFrame, turns: str = "messages", path: str = DEFAULT_TOKENIZER, opener: bool = True) -> DataFrame:
    """df with input_ids and loss_mask of the rendered conversation: 1 for tokens that overlap what assistants say, found
    by the offsets of tokens in the render. Null and empty turns have no tokens; columns of these names are replaced."""
    m = F.col(turns)
    return _with_tokens(df, F.when(F.size(m) > 0, chat_render(m, opener)), F.size(F.filter(m, lambda x: x["role"] == "assistant")), path, True)


def _with_tokens(df: DataFrame, text: Column, answers: Column, path: str, masked: bool) -> DataFrame:
    ship(df.sparkSession)
    added = ["input_ids", *(["loss_mask"] if masked else [])]
    work = df.drop(*added).withColumns({"__qx_text": text, "__qx_answers": answers})
    kept = [f for f in work.schema.fields if not f.name.startswith("__qx_")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).encode_batch
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                texts = [x or "" for x in b.column("__qx_text").to_pylist()]
                got = encode(texts, add_special_tokens=False)
                out = [b.column(f.name) for f in kept] + [_lists([e.ids for e in got])]
                if masked:
                    told = zip(texts, got, b.column("__qx_answers").to_pylist(), strict=True)
                    out.append(_lists([token_mask(len(t), trained_spans(t, [True] * n), e.offsets) if t else [] for t, e, n in told]))
                yield pa.RecordBatch.from_arrays(out, names=[*(f.name for f in kept), *added])

    return work.mapInArrow(run, T.StructType([*kept, *(T.StructField(name, T.ArrayType(T.IntegerType())) for name in added)]))


_SPACE = r"\t\n\x0b\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_MARK = r"\x{e000}"


def bpe_sql(source: str, path: str = DEFAULT_TOKENIZER) -> str:
    """The same ids in SQL, as CTEs after WITH RECURSIVE: from a table source (key, text) to encoded (key, ids). Words are
    cut by a pattern without look-ahead: of white space before a word the last character is set apart by a mark first.
    """
    return rf"""model AS (SELECT json->'model' AS m FROM read_json_objects('{path}', maximum_object_size=100000000)),
vocab AS (SELECT e.key AS piece, e.value AS id FROM (SELECT unnest(map_entries(CAST(m->'vocab' AS MAP(VARCHAR, INTEGER)))) AS e FROM model)),
pairs AS (SELECT ps[i] AS p, i AS rank FROM (SELECT ps, unnest(range(1, len(ps) + 1)) AS i FROM (SELECT CAST(m->'merges' AS VARCHAR[][]) AS ps FROM model))),
merges AS (SELECT a.id AS a, b.id AS b, c.id AS new_id, rank FROM pairs JOIN vocab a ON a.piece = p[1] JOIN vocab b ON b.piece = p[2] JOIN vocab c ON c.piece = p[1] || p[2]),
byte AS (SELECT b, CASE WHEN keep THEN b ELSE 255 + sum((NOT keep)::INT) OVER (ORDER BY b) END::INT AS cp FROM (SELECT b, b BETWEEN 33 AND 126 OR b BETWEEN 161 AND 172 OR b >= 174 AS keep FROM (SELECT unnest(range(256)) AS b))),
firsts AS (SELECT b, id FROM byte JOIN vocab ON piece = chr(cp)),
cut AS (SELECT key, list_filter(regexp_extract_all(regexp_replace(text, '([{_SPACE}]+)([{_SPACE}])([^{_SPACE}])', '\1' || chr(57344) || '\2\3', 'g'),
  '''s|''t|''re|''ve|''m|''ll|''d| ?\pL+| ?\pN+| ?[^{_SPACE}\pL\pN{_MARK}]+|[{_SPACE}]+|{_MARK}'), lambda w: w <> chr(57344)) AS ws FROM {source} WHERE text <> ''),
said AS (SELECT key, unnest(range(len(ws))) AS nr, unnest(ws) AS w FROM cut),
distinct_words AS MATERIALIZED (SELECT row_number() OVER () AS word, w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM said)),
bytes_of AS (SELECT word, unnest(range(len(h) // 2)) AS pos, h FROM distinct_words),
start AS (SELECT word, pos, id AS tok FROM bytes_of JOIN firsts ON b = ('0x' || substr(h, 2 * pos + 1, 2))::INT),
step(word, pos, tok, more) AS (
  SELECT word, pos, tok, true FROM start
  UNION ALL
  SELECT word, pos, tok, more FROM (
    SELECT word, pos, CASE WHEN hit THEN new_id ELSE tok END AS tok, best IS NOT NULL AS more, lag(hit, 1, false) OVER (PARTITION BY word ORDER BY pos) AS eaten
    FROM (
      SELECT word, pos, tok, new_id, best, best IS NOT NULL AND rank = best AND pos = min(CASE WHEN rank = best THEN pos END) OVER (PARTITION BY word) AS hit
      FROM (
        SELECT p.word, p.pos, p.tok, g.new_id, g.rank, min(g.rank) OVER (PARTITION BY p.word) AS best
        FROM (SELECT word, pos, tok, lead(tok) OVER (PARTITION BY word ORDER BY pos) AS nxt FROM step WHERE more) p LEFT JOIN merges g ON g.a = p.tok AND g.b = p.nxt
      )
    )
  ) WHERE NOT eaten
),
word_ids AS (SELECT w, list(tok ORDER BY pos) AS ids FROM step JOIN distinct_words USING (word) WHERE NOT more GROUP BY w),
encoded AS (SELECT s.key AS key, coalesce(any_value(i.ids), []::INTEGER[]) AS ids FROM {source} s LEFT JOIN (SELECT key, flatten(list(ids ORDER BY nr)) AS ids FROM said JOIN word_ids USING (w) GROUP BY key) i ON i.key = s.key GROUP BY s.key)"""
