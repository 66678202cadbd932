"""Packed sequences: every token once, in order, in windows without gaps; ids against the tokenizers library."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyshelf.llm import packing
from tests.llm.cases import SF_DIR, docs_frame


@pytest.fixture(scope="module")
def tokenizer():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer


def checked(pieces, rows, tokenizer, window, powers=True):
    """The sequences' lengths, after all pieces were found whole."""
    ids = {}
    wanted = Counter()
    for key, text in rows:
        tokens = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        ids.setdefault(key, []).append(tokens)
        wanted[key] += len(tokens)
    sequences, docs = defaultdict(list), defaultdict(list)
    for p in pieces:
        tokens = np.frombuffer(bytes(p.ids), "<u4").tolist()
        assert len(tokens) == p.length > 0
        assert any(len(d) == p.doc_tokens and d[p.start : p.start + p.length] == tokens for d in ids[p.doc_id])
        sequences[p.sequence_id].append((p.offset, p.length))
        docs[p.doc_id].append((p.start, p.length, p.doc_tokens))
    assert {k: sum(n for _, n, _ in d) for k, d in docs.items()} == dict(wanted)
    for key, parts in docs.items():
        if len(ids[key]) == 1:
            at = 0
            for start, n, _ in sorted(parts):
                assert start == at
                at += n
    lengths = []
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= window
        lengths.append(at)
    return lengths


def test_odd_documents(spark, tokenizer):
    more = [(50, "<|endoftext|> is text " * 20), (51, "ab1" * 60_000), (52, "中文" * 5000)]
    pieces = packing.pack_documents(docs_frame(spark, more)).collect()
    from tests.llm.cases import DOCS

    lengths = checked(pieces, [*DOCS, *more], tokenizer, packing.WINDOW)
    assert all(n & (n - 1) == 0 for n in lengths), "only whole windows and powers of two"
    assert Counter(lengths).most_common()[0][0] == packing.WINDOW


@pytest.mark.parametrize("parts", [1, 40])
def test_test_documents_are_packed_without_padding(spark, tokenizer, parts):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    pieces = packing.pack_documents(docs.repartition(parts), window=256, open_windows=4).collect()
    lengths = checked(pieces, [(r.doc_id, r.text) for r in docs.collect()], tokenizer, 256)
    assert sum(n != 256 for n in lengths) <= 8 and all(n & (n - 1) == 0 for n in lengths)


def test_whole_documents_if_not_cut(spark, tokenizer):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    pieces = packing.pack_documents(docs.repartition(5), window=1024, cut=False).collect()
    lengths = checked(pieces, [(r.doc_id, r.text) for r in docs.collect()], tokenizer, 1024)
    assert sum(lengths) > 0.9 * 1024 * len(lengths)
    cut = Counter(p.doc_id for p in pieces if p.doc_tokens < 1024)
    assert set(cut.values()) <= {1}


def test_query_columns(spark, tokenizer):
    rows = packing.q_packing(spark, SF_DIR).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in rows[:200]:
        tokens = (tokenizer.encode(docs[r.doc_id], add_special_tokens=False).ids + [1])[r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(tokens, "<u4").tobytes())


def test_windows_are_filled_by_best_fit():
    windows = packing.Windows(10, 2, True, 0)
    for key, n in enumerate([6, 7, 3, 4]):
        windows.add(key, 0, bytes(4 * n), n)
    # 3 goes beside 7, which fills that window, and 4 beside 6.
    assert [(p[0], p[5], p[6]) for p in windows.out] == [(1, 2, 0), (2, 2, 7), (0, 3, 0), (3, 3, 6)]
    windows.add(4, 0, bytes(4 * 9), 9)
    windows.add(5, 0, bytes(4 * 8), 8)
    windows.add(6, 0, bytes(4 * 5), 5)
    # None fits: the fullest is filled by a cut and emitted.
    assert [(p[0], p[1], p[2]) for p in windows.out[4:]] == [(4, 0, 9), (6, 0, 1)]


def test_no_documents(spark):
    assert packing.pack_documents(docs_frame(spark).limit(0)).collect() == []


def test_both_libraries_give_the_same_ids(tokenizer):
    encoding, _ = packing.encoder(packing.VOCABULARY, packing.PATTERN)
    rng = random.Random(1)
    for start in range(0, 0x11000, 64):
        chars = [chr(c) for c in range(start, start + 64) if not 0xD800 <= c < 0xE000]
        text = "".join(c + rng.choice(["", " ", "a", "1", "'s", "\n", ".", "  "]) for c in chars for _ in range(3))
        assert encoding.encode_ordinary(text) == tokenizer.encode(text, add_special_tokens=False).ids
