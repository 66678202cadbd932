"""Encoding with a merge-ranked piece vocabulary, by suffix-array matching, and decoding.

Rows are taken in groups. The distinct units of a group (a run of space marks and what follows it; no piece
crosses a unit's edge, which is checked against the vocabulary) are concatenated, some at a time, and indexed by a
suffix array that is sorted as deep as the longest piece. Every piece is searched in it twice by bisection, which gives its
range of occurrences. The occurrences are edges from a start to an end; they are sorted by position, and
relaxed: in rounds, each unit joins the two neighbouring symbols whose edge has the best score, the leftmost
of equals, until no edge joins two symbols. That is the order in which the vocabulary's own encoder joins
them. A symbol left over that is no piece becomes the pieces of its UTF-8 bytes.

Defined cases: null and empty text have no tokens and decode to empty text; repeated rows and ids are encoded
on their own; other columns are not read; a very long text is encoded whole, as a group of its own. Decoding
gives back the text, except that a space mark (U+2581) in it comes back as a space. A vocabulary whose encoder
changes text before it cuts it is refused.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyshelf.llm.common import give_back, id_and_text, numbered, numbering, table, text_groups

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
GROUP_BYTES = 2 << 20
UNIT_CHARACTERS = 1 << 18
CODE_BITS = 16

TOKENS = pa.schema([
    ("doc_id", pa.int64()),
    ("n_tokens", pa.int64()),
    ("ids", pa.list_(pa.int32())),
    ("round_trip", pa.bool_()),
])
TOKENS_DDL = "doc_id long, n_tokens long, ids array<int>, round_trip boolean"


@dataclass(frozen=True)
class Vocabulary:
    """Pieces of a model. Codes number the characters of pieces from 1; 0 ends a unit, `other` is any other."""

    pieces: list[str]
    raw: list[bytes]
    scores: np.ndarray
    byte_ids: np.ndarray
    code_of: np.ndarray
    other: int
    single: np.ndarray
    long_ids: np.ndarray
    low: np.ndarray
    high: np.ndarray
    lengths: np.ndarray
    depth: int
    unit: re.Pattern[str]


def _keys(codes: np.ndarray) -> np.ndarray:
    """Rows of 16-bit codes as byte strings that compare as the rows do."""
    return np.ascontiguousarray(codes.astype(">u2")).view(f"S{2 * codes.shape[1]}").reshape(-1)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for probe in ("½  x　\tﬁ ", "  A\n\n b"):
        if model.decode(model.encode(probe)) != probe:
            raise ValueError("the vocabulary's encoder changes text; only one that keeps it is supported")
    n = model.get_piece_size()
    pieces = [model.id_to_piece(k) for k in range(n)]
    scores = np.array([model.get_score(k) for k in range(n)])
    byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
    plain = [k for k in range(n) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k)
                                         or model.is_unused(k))]
    if any(not re.fullmatch(f"{MARK}*[^{MARK}]*", pieces[k]) for k in plain):
        raise ValueError("a piece has a space mark after another character")
    raw = [p.replace(MARK, " ").encode() for p in pieces]
    for b, k in enumerate(byte_ids):
        raw[k] = bytes([b])
    for k in range(n):
        if model.is_control(k) or model.is_unknown(k):
            raw[k] = b""
    letters = sorted({c for k in plain for c in pieces[k]})
    if len(letters) + 2 >= 1 << CODE_BITS:
        raise ValueError("too many different characters in pieces")
    other = len(letters) + 1
    code_of = np.full(0x110000, other, np.uint16)
    code_of[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
    single = np.full(len(letters) + 2, -1, np.int64)
    for k in plain:
        if len(pieces[k]) == 1:
            single[code_of[ord(pieces[k])]] = k
    long_ids = np.array([k for k in plain if len(pieces[k]) > 1])
    lengths = np.array([len(pieces[k]) for k in long_ids])
    depth = int(lengths.max())
    low = np.zeros((len(long_ids), depth), np.uint16)
    high = np.full((len(long_ids), depth), (1 << CODE_BITS) - 1, np.uint16)
    for row, k in enumerate(long_ids):
        low[row, : len(pieces[k])] = high[row, : len(pieces[k])] = [code_of[ord(c)] for c in pieces[k]]
    within = {c for k in long_ids for c in pieces[k]}
    alone = "".join(re.escape(c) for c in "\n\r\t" if c not in within)
    unit = re.compile(f"{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+" + (f"|[{alone}]" if alone else ""))
    return Vocabulary(
        pieces, raw, scores, byte_ids, code_of, other, single, long_ids, _keys(low), _keys(high), lengths, depth, unit
    )


def sorted_suffixes(codes: np.ndarray, depth: int) -> np.ndarray:
    """Where suffixes start, ordered by `depth` codes at least, by doubling: four codes, then ranks of neighbours."""
    n, deep = len(codes), 4
    padded = np.concatenate([codes, np.zeros(3, np.uint16)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(4):
        key |= padded[k : k + n] << np.uint64(CODE_BITS * (3 - k))
    del padded
    while True:
        order = np.argsort(key)
        if deep >= depth:
            return order
        value = key[order]
        rank = np.empty(n, np.uint64)
        # Rank 0 is what lies behind the last code.
        rank[order] = np.cumsum(np.diff(value, prepend=value[:1]) != 0) + 1
        key = rank << np.uint64(32)
        key[: max(n - deep, 0)] |= rank[deep:]
        deep *= 2


def matched_edges(codes: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """All occurrences of pieces: keys (start * (depth + 1) + length), sorted, and the pieces."""
    number = np.int32 if (len(codes) + 1) * (v.depth + 1) < 1 << 31 else np.int64
    suffixes = sorted_suffixes(codes, v.depth).astype(number)
    padded = np.concatenate([codes, np.zeros(v.depth, np.uint16)]).astype(">u2")
    windows = np.lib.stride_tricks.sliding_window_view(padded, v.depth)[: len(codes)]
    keys = windows[suffixes].view(f"S{2 * v.depth}").reshape(-1)
    begin = np.searchsorted(keys, v.low, side="left")
    end = np.searchsorted(keys, v.high, side="right")
    del keys
    counts = end - begin
    total = int(counts.sum())
    offsets = np.repeat((begin - np.cumsum(counts) + counts).astype(number), counts)
    edges = suffixes[np.arange(total, dtype=number) + offsets] * number(v.depth + 1)
    edges += np.repeat(v.lengths.astype(number), counts)
    order = np.argsort(edges)
    return edges[order], np.repeat(v.long_ids.astype(np.int32), counts)[order]


def encode_units(units: list[str], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all units in a row, and how many each unit has."""
    points = np.frombuffer("\0".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(u) for u in units])
    firsts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    codes = v.code_of[points]
    codes[firsts[1:] - 1] = 0
    edges, edge_ids = matched_edges(codes, v)

    number = edges.dtype.type
    owner = np.repeat(np.arange(len(units), dtype=number), sizes)
    start = np.arange(len(owner), dtype=number) + owner
    length = np.ones(len(owner), number)
    piece = v.single[codes[start]]

    def joined(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece and score of joining the symbols at `at` with their right neighbours."""
        right = at + 1
        ok = right < len(start)
        right = np.where(ok, right, at)
        span = length[at] + length[right]
        ok &= (owner[at] == owner[right]) & (span <= v.depth)
        key = start[at] * number(v.depth + 1) + span
        place = np.minimum(np.searchsorted(edges, key), max(len(edges) - 1, 0))
        ok &= (edges[place] == key) if len(edges) else False
        found = np.where(ok, edge_ids[place] if len(edges) else -1, -1)
        return found, np.where(ok, v.scores[found], -np.inf)

    done: list[tuple[np.ndarray, np.ndarray]] = []
    target, score = joined(np.arange(len(start)))
    while len(start):
        heads = np.flatnonzero(np.diff(owner, prepend=-1))
        counts = np.diff(np.append(heads, len(owner)))
        best = np.maximum.reduceat(score, heads)
        live = np.isfinite(best)
        if not live.all():
            rest = ~np.repeat(live, counts)
            done.append((start[rest], piece[rest]))
            keep = ~rest
            start, length, piece, owner, target, score = (
                a[keep] for a in (start, length, piece, owner, target, score)
            )
            counts, best = counts[live], best[live]
            if not len(start):
                break
        heads = np.concatenate([[0], np.cumsum(counts)[:-1]])
        places = np.flatnonzero(score == np.repeat(best, counts))
        place = places[np.searchsorted(places, heads)]
        piece[place] = target[place]
        length[place] += length[place + 1]
        keep = np.ones(len(start), bool)
        keep[place + 1] = False
        start, length, piece, owner, target, score = (a[keep] for a in (start, length, piece, owner, target, score))
        place = place - np.arange(len(place))
        changed = np.concatenate([place, place[place > 0] - 1])
        target[changed], score[changed] = joined(changed)

    at = np.concatenate([a for a, _ in done]) if done else np.empty(0, np.int64)
    ids = np.concatenate([b for _, b in done]) if done else np.empty(0, np.int64)
    order = np.argsort(at)
    at, ids = at[order], ids[order]
    if (ids < 0).any():
        spelled = [v.byte_ids[list(chr(points[p]).encode("utf-8", "surrogatepass"))] for p in at[ids < 0]]
        repeats = np.ones(len(ids), np.int64)
        repeats[ids < 0] = [len(s) for s in spelled]
        unknown = np.repeat(ids < 0, repeats)
        at, ids = np.repeat(at, repeats), np.repeat(ids, repeats)
        ids[unknown] = np.concatenate(spelled)
    return ids, np.bincount(np.searchsorted(firsts, at, side="right") - 1, minlength=len(units))


def encode_texts(texts: list[str], v: Vocabulary) -> list[np.ndarray]:
    """Token ids of each text."""
    numbers = numbering()
    rows = [
        numbered(numbers, v.unit.findall(MARK + text.replace(" ", MARK)) if text else []) for text in texts
    ]
    if not numbers:
        return [np.empty(0, np.int32) for _ in texts]
    units = list(numbers)
    del numbers
    # Units are encoded on their own, so some at a time: their arrays take many times the space of the texts.
    sizes = np.array([len(u) for u in units])
    cuts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // UNIT_CHARACTERS, prepend=-1)).tolist()
    parts = [encode_units(units[a:b], v) for a, b in pairwise([*cuts, len(units)])]
    del units
    ids = np.concatenate([part.astype(np.int32) for part, _ in parts])
    counts = np.concatenate([n for _, n in parts])
    ends = np.cumsum(counts)
    out = []
    for row in rows:
        n = counts[row]
        shift = np.repeat(ends[row] - np.cumsum(n), n)
        out.append(ids[np.arange(int(n.sum())) + shift])
    return out


def decode_ids(ids: np.ndarray, v: Vocabulary) -> str:
    """The text of token ids: without the space that encoding puts first."""
    text = b"".join(map(v.raw.__getitem__, ids.tolist())).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def _encoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        # The worker may have done other work before, and what it freed then is not given back by itself.
        give_back()
        for group in text_groups(batches, GROUP_BYTES):
            texts = group["text"].to_pylist()
            rows = encode_texts(texts, v)
            same = [decode_ids(r, v) == t.replace(MARK, " ") for r, t in zip(rows, texts, strict=True)]
            sizes = [len(r) for r in rows]
            ids = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(np.concatenate(rows), pa.int32())
            )
            doc_id = group["doc_id"].combine_chunks()
            del group, texts, rows
            give_back()
            yield pa.RecordBatch.from_arrays([doc_id, pa.array(sizes, pa.int64()), ids, pa.array(same)], schema=TOKENS)

    return run


def encode_documents(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, ids, and whether the ids decode to the text. `path` is a model that every executor has."""
    return id_and_text(docs).mapInArrow(_encoder(path), TOKENS_DDL)


def decode_documents(tokens: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id and the text of its ids; null ids are empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            texts = [decode_ids(np.array(ids or [], np.int64), v) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return tokens.select(tokens["doc_id"].cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def q_pieces(spark, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))
