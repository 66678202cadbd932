"""Documents with the odd cases that every operator must bear, and comparisons."""

from __future__ import annotations

import json
from collections import Counter

import duckdb
import numpy as np
import zstandard

from tallyshelf.llm.chunks import Chunk

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "conversations")

LINE = "The quick brown fox jumps over the lazy dog while fifty bytes pass by."
DOCS: list[tuple[int | None, str | None]] = [
    (3, f"{LINE}\nAnother line.\n{LINE}\nÀ côté, l'été: ### $5 & more | <b>"),
    (1, f"Start. {LINE} End of it."),
    (1, f"Start. {LINE} End of it."),
    (2, ""),
    (4, None),
    (4, "   \n\t \x0b\x0c\r "),
    (None, f"{LINE} without an id"),
    (None, None),
    (7, "one two three four five one two three four five one two three four five six"),
    (8, "word"),
    (9, "ünïcödé " * 40),
    (10, "x" * 20_000),
    (11, "\n".join(f"Long line number {k} of a long text, {k * k} words or so." for k in range(300))),
    (12, "ONE Two tHREE ▁ four five six seven eight nine ten eleven."),
]


def docs_frame(spark, more=()):
    """The documents, with columns whose names operators use for themselves."""
    rows = [(k, t, "und", "row", 1, "r") for k, t in [*DOCS, *more]]
    schema = "doc_id int, text string, chunk string, body string, n_tokens int, root string"
    return spark.createDataFrame(rows, schema).repartition(3)


def rows_of(df) -> Counter:
    names = sorted(df.columns)
    return Counter(tuple((n, r[n]) for n in names) for r in df.collect())


def duckdb_result(sf_dir: str, sql: str) -> Counter:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return Counter(tuple(sorted(zip(names, row, strict=True))) for row in cursor.fetchall())


def chunk_of(texts, flags=None):
    """A chunk of texts in bytes, with ids from 0."""
    n = len(texts)
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64).tobytes()
    flags = np.array(flags or [0] * n, np.uint8).tobytes()
    carried = json.dumps([""] * n).encode()
    sizes = n.to_bytes(8, "little"), len(carried).to_bytes(8, "little")
    head = [sizes[0], np.arange(n, dtype=np.int64).tobytes(), ends, flags, sizes[1], carried]
    return Chunk(zstandard.ZstdCompressor().compress(b"".join([*head, *texts])))
