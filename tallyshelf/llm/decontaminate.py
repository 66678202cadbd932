"""Benchmark items in documents: random-walk embedding, sampled-position hashing, exact edit verification.

Texts are compared as lower-case words. An item of L words is found in a document if some run of the document's
words is within the edit distance floor((1 - similarity) * L) of it.

1. Gate, without loss: t edits cut an item in t + 1 parts, so a run of at least ceil((L - t) / (t + 1)) words is
   left whole, and at least L - t of its words stand in the run. Only places that share such a run with an item,
   and that have so many of its words around, go on.
2. The windows of L words that start at these places, or up to t words beside them, are embedded: a pointer walks
   over the window, and at each of 3L steps writes the word it stands on and goes on or stays, by a random bit of
   step and word. Words that differ by few edits so become rows that differ in few places. Each of several walks
   hashes a few sampled places; an item is a candidate if a walk's hash is the same as the window's. The number
   of walks is chosen so that items with as many edits as allowed are found with the target recall, as measured
   on random edits of the items themselves.
3. Candidates are verified by the exact edit distance of the item to the best run of words around the window.

Items are a stated query set: they are read in blocks of `ITEM_BLOCK`, and each block is one pass over all
documents, without a shuffle. Defined cases: null or empty texts have no words and match nothing; repeated
documents and items give a row each; of several places of an item in a document the one with the smallest
distance, then the first, is reported; other columns are not read; long texts are searched whole.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyshelf.llm.common import id_and_text, mix, table, text_groups

WORDS = re.compile(r"\w+")
SIMILARITY = 0.8
TARGET_RECALL = 0.995
SAMPLED = 2
MOST_WALKS = 64
ITEM_BLOCK = 10_000
GROUP_BYTES = 4 << 20
LANES = 1 << 16

MATCHES = pa.schema([
    ("doc_id", pa.int64()),
    ("item_id", pa.int64()),
    ("distance", pa.int64()),
    ("item_words", pa.int64()),
    ("word_start", pa.int64()),
    ("word_end", pa.int64()),
])
MATCHES_DDL = "doc_id long, item_id long, distance long, item_words long, word_start long, word_end long"


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def allowed_edits(n_words: int, similarity: float = SIMILARITY) -> int:
    return int((1 - similarity) * n_words + 1e-9)


def least_run(n_words: int, edits: int) -> int:
    return -(-(n_words - edits) // (edits + 1))


def walk_hashes(rows: np.ndarray, walks: int) -> np.ndarray:
    """[row, walk]: hash of the sampled places of each walk over rows of one length."""
    n, length = rows.shape
    rng = np.random.default_rng(length)
    places = np.sort(rng.integers(0, 3 * length, (walks, SAMPLED)), axis=1)
    at = np.zeros((n, walks), np.int64)
    out = np.zeros((n, walks), np.uint64)
    salt = (np.arange(1, walks + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))[None, :]
    ended = np.uint64(0)
    padded = np.concatenate([rows.astype(np.uint64), np.full((n, 1), ended)], axis=1)
    lane = np.arange(n)[:, None]
    for step in range(int(places.max()) + 1):
        here = padded[lane, at]
        mixed = mix(here + salt * np.uint64(2 * step + 1))
        for k in range(SAMPLED):
            take = places[:, k] == step
            if take.any():
                out[:, take] = mix(out[:, take] * np.uint64(31) + here[:, take] + np.uint64(k + 1))
        at = np.minimum(at + (mixed & np.uint64(1)).astype(np.int64), length)
    return out


def hashes_in_slabs(rows: np.ndarray, walks: int) -> np.ndarray:
    slab = max(1, LANES // walks)
    return np.concatenate([walk_hashes(rows[k : k + slab], walks) for k in range(0, len(rows), slab)])


def edited(row: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """The row after random edits, cut or filled up to its length."""
    out = list(row)
    for _ in range(edits):
        at = int(rng.integers(0, len(out) + 1))
        kind = rng.integers(0, 3)
        fresh = int(rng.integers(1 << 40, 1 << 41))
        if kind == 0 and at < len(out):
            out[at] = fresh
        elif kind == 1 and len(out) > 1 and at < len(out):
            del out[at]
        else:
            out.insert(at, fresh)
    out = out[: len(row)] + [int(rng.integers(1 << 40, 1 << 41)) for _ in range(len(row) - len(out))]
    return np.array(out, np.uint64)


def walks_needed(rows: list[np.ndarray], similarity: float, recall: float, trials: int = 200) -> int:
    """Walks that find the target share of rows with as many edits as allowed."""
    rng = np.random.default_rng(11)
    first = []
    for k in range(trials):
        row = rows[k % len(rows)].astype(np.uint64)
        pair = np.stack([row, edited(row, allowed_edits(len(row), similarity), rng)])
        a, b = walk_hashes(pair, MOST_WALKS)
        same = np.flatnonzero(a == b)
        first.append(int(same[0]) + 1 if len(same) else MOST_WALKS)
    return int(np.quantile(first, recall, method="higher"))


@dataclass
class Items:
    """An index of items: word numbers, runs by length, and hash tables of the walks by item length."""

    numbers: dict[str, int]
    ids: list[int]
    rows: list[np.ndarray]
    members: list[np.ndarray]
    edits: list[int]
    runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    tables: dict[int, dict[tuple[int, int], list[int]]]
    walks: int


def run_keys(numbers: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of so many words; 0 where a word is unknown."""
    n = len(numbers) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    key = np.zeros(n, np.uint64)
    known = np.ones(n, bool)
    for k in range(length):
        part = numbers[k : k + n]
        known &= part > 0
        key = key * np.uint64(0x9E3779B97F4A7C15) + part.astype(np.uint64)
    return np.where(known, mix(key) | np.uint64(1), np.uint64(0))


def index_items(items: list[tuple[int, str]], similarity: float = SIMILARITY, recall: float = TARGET_RECALL) -> Items | None:
    """None if no item has words."""
    numbers: dict[str, int] = {}
    ids, rows = [], []
    for item_id, text in items:
        words = words_of(text or "")
        if words:
            ids.append(item_id)
            rows.append(np.array([numbers.setdefault(w, len(numbers) + 1) for w in words], np.int64))
    if not rows:
        return None
    edits = [allowed_edits(len(r), similarity) for r in rows]
    found = defaultdict(list)
    for k, row in enumerate(rows):
        length = least_run(len(row), edits[k])
        for place, key in enumerate(run_keys(row, length).tolist()):
            found[length].append((key, k, place))
    runs = {}
    for length, entries in found.items():
        entries.sort()
        keys = np.array([e[0] for e in entries], np.uint64)
        bits = np.zeros(1 << 22, bool)
        bits[(keys >> np.uint64(42)).astype(np.int64)] = True
        runs[length] = keys, np.array([e[1] for e in entries]), np.array([e[2] for e in entries]), bits
    walks = walks_needed(rows, similarity, recall)
    tables: dict[int, dict[tuple[int, int], list[int]]] = {}
    by_length = defaultdict(list)
    for k, row in enumerate(rows):
        by_length[len(row)].append(k)
    for length, members in by_length.items():
        of_length = tables.setdefault(length, defaultdict(list))
        hashed = hashes_in_slabs(np.stack([rows[k] for k in members]), walks)
        for k, line in zip(members, hashed.tolist(), strict=True):
            for walk, value in enumerate(line):
                of_length[walk, value].append(k)
        tables[length] = dict(of_length)
    return Items(numbers, ids, rows, [np.unique(r) for r in rows], edits, runs, tables, walks)


def best_run(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """Smallest edit distance of the item to any run of the words, and the first such run's start and end."""
    n = len(words)
    cost = np.zeros(n + 1, np.int64)
    start = np.arange(n + 1)
    place = np.arange(n + 1)
    for k, word in enumerate(item, 1):
        replace = np.concatenate([[k], cost[:-1] + (words != word)])
        drop = cost + 1
        took = replace <= drop
        now = np.where(took, replace, drop)
        begin = np.where(took, np.concatenate([[0], start[:-1]]), start)
        # Inserting words: the smallest of now[j] + (i - j) over j <= i, by the leftmost such j.
        low = np.minimum.accumulate(now - place)
        source = np.maximum.accumulate(np.where(now - place == low, place, 0))
        source = np.where(now <= low + place, place, source)
        cost, start = low + place, begin[source]
    end = int(np.argmin(cost))
    return int(cost[end]), int(start[end]), end


def gated(numbers: np.ndarray, items: Items) -> set[tuple[int, int]]:
    """(item, start) pairs that may match: they share a whole run and enough words."""
    out: set[tuple[int, int]] = set()
    for length, (keys, owners, places, bits) in items.runs.items():
        here = run_keys(numbers, length)
        hits = np.flatnonzero(bits[(here >> np.uint64(42)).astype(np.int64)] & (here > 0))
        first = np.searchsorted(keys, here[hits], side="left")
        last = np.searchsorted(keys, here[hits], side="right")
        hits, first, last = (a[last > first] for a in (hits, first, last))
        spread = np.repeat(np.arange(len(hits)), last - first)
        entry = np.arange(len(spread)) - np.repeat(np.cumsum(last - first) - last, last - first)
        pairs = np.unique(np.stack([owners[entry], hits[spread] - places[entry]]), axis=1)
        out.update(map(tuple, pairs.T.tolist()))
    kept = set()
    for k, start in out:
        edits = items.edits[k]
        if enough_words(numbers[max(0, start - edits) : max(0, start + len(items.rows[k]) + edits)], items, k):
            kept.add((k, start))
    return kept


def enough_words(around: np.ndarray, items: Items, k: int) -> bool:
    """Whether so many of the words are the item's that a match isn't ruled out."""
    members = items.members[k]
    spots = np.searchsorted(members, around).clip(max=len(members) - 1)
    return int((members[spots] == around).sum()) >= len(items.rows[k]) - items.edits[k]


def regions(candidates: list[tuple[int, int]], items: Items, length: int) -> Iterator[tuple[int, int, int]]:
    """Stretches of words that hold all of an item's candidate windows that overlap, and the edits beside them."""
    k0 = low = high = -1
    for k, start in candidates:
        if k == k0 and start <= high:
            high = start + length
            continue
        if k0 >= 0:
            yield k0, low - items.edits[k0], high + items.edits[k0]
        k0, low, high = k, start, start + length
    if k0 >= 0:
        yield k0, low - items.edits[k0], high + items.edits[k0]


def search(numbers: np.ndarray, items: Items) -> list[tuple[int, int, int, int]]:
    """(item, distance, start, end) of every item found in the word numbers, once per item and place."""
    windows: dict[int, set[int]] = defaultdict(set)
    for k, start in gated(numbers, items):
        windows[len(items.rows[k])].update(range(start - items.edits[k], start + items.edits[k] + 1))
    out = []
    padded_by = max(map(len, items.rows))
    padded = np.concatenate([np.zeros(padded_by, np.int64), numbers, np.zeros(2 * padded_by, np.int64)])
    for length, chosen in windows.items():
        starts = np.array([s for s in sorted(chosen) if -length < s < len(numbers)], np.int64)
        if not len(starts):
            continue
        rows = padded[starts[:, None] + padded_by + np.arange(length)[None, :]]
        of_length = items.tables[length]
        candidates = set()
        for start, line in zip(starts.tolist(), hashes_in_slabs(rows, items.walks).tolist(), strict=True):
            for walk, value in enumerate(line):
                for k in of_length.get((walk, value), ()):
                    candidates.add((k, start))
        for k, low, high in regions(sorted(candidates), items, length):
            around = numbers[max(0, low) : high]
            if enough_words(around, items, k):
                distance, begin, end = best_run(items.rows[k], around)
                if distance <= items.edits[k]:
                    out.append((k, distance, max(0, low) + begin, max(0, low) + end))
    return out


def numbered(texts: list[str], items: Items) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts in a row, 0 for words of no item, and where each text starts and ends.

    Between texts are so many zeros that no window or run that matches reaches into another text.
    """
    apart = np.zeros(4 * max(map(len, items.rows)), np.int64)
    parts, bounds, at = [apart], [], len(apart)
    for text in texts:
        words = words_of(text)
        parts += [np.fromiter(map(items.numbers.get, words, repeat(0)), np.int64, len(words)), apart]
        bounds.append((at, at + len(words)))
        at += len(words) + len(apart)
    return np.concatenate(parts), np.array(bounds).reshape(-1, 2)


def _searcher(items: Items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in text_groups(batches, GROUP_BYTES):
            doc_ids, found = group["doc_id"].to_pylist(), []
            numbers, bounds = numbered(group["text"].to_pylist(), items)
            best: dict[tuple[int, int], tuple[int, int, int]] = {}
            for k, distance, start, end in search(numbers, items):
                row = int(np.searchsorted(bounds[:, 1], end - 1, side="right"))
                first, last = bounds[row].tolist()
                hit = (distance, max(start, first) - first, min(end, last) - first)
                best[row, k] = min(best.get((row, k), hit), hit)
            for (row, k), (distance, start, end) in sorted(best.items()):
                found.append((doc_ids[row], items.ids[k], distance, len(items.rows[k]), start, end))
            columns = list(zip(*found, strict=True)) or [[] for _ in MATCHES]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, MATCHES, strict=True)], schema=MATCHES
            )

    return run


def find_items(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, recall: float = TARGET_RECALL
) -> DataFrame:
    """One row per document and item found in it; words are counted from 0, the end is past the last."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    texts = id_and_text(docs)
    parts, block = [], []

    def close() -> None:
        items = index_items(block, similarity, recall)
        if items:
            parts.append(texts.mapInArrow(_searcher(items), MATCHES_DDL))
        block.clear()

    for row in rows.orderBy("item_id", "text").toLocalIterator():
        block.append((row["item_id"], row["text"]))
        if len(block) >= ITEM_BLOCK:
            close()
    close()
    if not parts:
        return docs.sparkSession.createDataFrame([], MATCHES_DDL)
    return reduce(DataFrame.unionAll, parts)


def q_decontaminate(spark, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
