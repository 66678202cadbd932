"""Bytes that repeat what an earlier document has: windows in suffix order, as deep as the threshold.

Two suffixes share a window of THRESHOLD bytes if and only if they are equal that deep, so suffixes are ordered
through THRESHOLD bytes only, by radix passes from the most significant digit, and a group that is still equal
after the last pass is a repeated window with all its places. A group of one is dropped as soon as it arises.

The first digit is an anchor: the least hash among the runs of ANCHOR bytes in the window. Equal windows have
equal anchors, and neighbouring windows mostly share one, so it is cheap to exchange: chunks of documents ask for
each of their anchors whether other documents have it. Windows whose anchor no other document has are groups of
one. The others go to the bucket of their anchor, as segments of neighbouring windows, each content once from
each chunk with the least id there; the bucket makes equal contents one, orders the windows of anchors that have
several contents by the digits that are left, eight bytes in a pass, and answers with the least id of each window in the whole corpus. The chunk removes the bytes of each window
that starts in a document with a greater id.

Defined cases: null and empty text has no bytes; a text shorter than the threshold keeps all; matches never
cross documents; a null id comes after all others; rows with the same id don't remove each other's bytes, as
none is smaller; other columns are not read. A document is never split over chunks, so a very long text is one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyshelf.llm.chunks import (
    BLOCKS_DDL,
    NO_ID,
    Chunk,
    answer,
    ask,
    blocks_table,
    bucket_count,
    bucket_of,
    by_bucket,
    to_chunks,
    with_answers,
)
from tallyshelf.llm.common import (
    mix,
    numbered,
    numbering,
    pack,
    pack_sorted,
    release,
    stored,
    table,
    unpack,
    unpack_sorted,
)

THRESHOLD = 50
CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 4 << 20
ANCHOR = 25
SLAB = 1 << 17
POWER = np.uint64(0x9E3779B97F4A7C15)
WINDOWS_AT_ONCE = 1 << 20


def _powers(length: int) -> dict[int, np.uint64]:
    out = {1: POWER}
    k = 1
    with np.errstate(over="ignore"):
        while 2 * k <= length:
            out[2 * k] = out[k] * out[k]
            k *= 2
    return out


def _windowed(parts: dict[int, np.ndarray], length: int, join) -> np.ndarray:
    """Joins windows of powers of two to windows of any length, left to right."""
    done, out = 0, None
    for k in sorted(parts, reverse=True):
        if length & k:
            out = parts[k] if out is None else join(out, parts[k][done:], k)
            done += k
    return out


def anchors(data: np.ndarray, threshold: int, anchor: int) -> np.ndarray:
    """The anchor of each window of the data: the least hash of `anchor` bytes in `threshold` bytes."""
    table = mix(np.arange(1, 257, dtype=np.uint64))
    powers = _powers(anchor)
    parts = {1: table[data]}
    k = 1
    while 2 * k <= anchor:
        h = parts[k]
        parts[2 * k] = h[:-k] * powers[k] + h[k:]
        k *= 2

    def join(left: np.ndarray, right: np.ndarray, k: int) -> np.ndarray:
        n = min(len(left), len(right))
        return left[:n] * powers[k] + right[:n]

    least = mix(_windowed(parts, anchor, join))
    wide, k = threshold - anchor + 1, 1
    while 2 * k <= wide:
        least = np.minimum(least[:-k], least[k:])
        k *= 2
    return np.minimum(least[: len(least) - (wide - k)], least[wide - k :]) if wide > k else least


class Runs:
    """Runs of neighbouring windows with one anchor in one document: first window, windows, anchor, document."""

    def __init__(self, chunk: Chunk, threshold: int, anchor: int) -> None:
        data = np.frombuffer(chunk.data, np.uint8)
        starts, ends = chunk.starts, chunk.ends
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for at in range(0, len(data) - threshold + 1, SLAB):
            keys = anchors(data[at : at + SLAB + threshold - 1], threshold, anchor)
            change = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            found.append((change + at, keys[change]))
        if not found:
            self.first = self.count = self.doc = np.empty(0, np.int64)
            self.anchor = np.empty(0, np.uint64)
            return
        first = np.concatenate([f for f, _ in found])
        anchor_keys = np.concatenate([a for _, a in found])
        # Runs are also cut where documents start, and end with the last window inside their document.
        cuts = np.unique(starts[ends - starts >= threshold])
        owner = np.searchsorted(first, cuts, side="right") - 1
        places = np.concatenate([first, cuts])
        keys = np.concatenate([anchor_keys, anchor_keys[owner]])
        order = np.argsort(places, kind="stable")
        places, keys = places[order], keys[order]
        last = np.append(places[1:], len(data) - threshold + 1)
        doc = np.searchsorted(ends, places, side="right")
        doc = np.minimum(doc, len(ends) - 1)
        last = np.minimum(last, ends[doc] - threshold + 1)
        keep = last > places
        self.first, self.count = places[keep], (last - places)[keep]
        self.anchor, self.doc = keys[keep], doc[keep]


def _ask_anchors(threshold: int, anchor: int, buckets: int):
    def question(chunk: Chunk) -> Iterator[tuple[int, bytes]]:
        runs = Runs(chunk, threshold, anchor)
        keys, places = np.unique(runs.anchor, return_inverse=True)
        low = np.full(len(keys), len(chunk.ids), np.int64)
        high = np.full(len(keys), -1, np.int64)
        np.minimum.at(low, places, runs.doc)
        np.maximum.at(high, places, runs.doc)
        several = low != high
        order, ends = by_bucket(bucket_of(keys, buckets), buckets)
        start = 0
        for bucket, end in enumerate(ends.tolist()):
            some = order[start:end]
            start = end
            if len(some):
                yield bucket, pack(pack_sorted(keys[some]), np.packbits(several[some]))

    return question


def _shared_anchors(blocks: list[bytes]) -> list[bytes]:
    """For each block's keys, a bit: other documents have it."""
    keys, several = [], []
    for block in blocks:
        gaps, bits = unpack(block)
        keys.append(unpack_sorted(gaps))
        several.append(np.unpackbits(bits, count=len(gaps)).astype(np.int8))
    whole = np.concatenate(keys)
    order = np.argsort(whole, kind="stable")
    new = np.concatenate([[True], whole[order[1:]] != whole[order[:-1]]])
    group = np.cumsum(new) - 1
    shared = (np.bincount(group) + np.bincount(group, np.concatenate(several)[order])) > 1
    bits = np.empty(len(whole), bool)
    bits[order] = shared[group]
    return [pack(np.packbits(b)) for b in np.split(bits, np.cumsum([len(k) for k in keys])[:-1])]


class Segments:
    """The distinct contents of a chunk's runs whose anchor is shared: bytes, anchor, least id; and who has them."""

    def __init__(self, chunk: Chunk, bits: dict[int, bytes], threshold: int, anchor: int, buckets: int) -> None:
        runs = Runs(chunk, threshold, anchor)
        keys, places = np.unique(runs.anchor, return_inverse=True)
        order, ends = by_bucket(bucket_of(keys, buckets), buckets)
        shared = np.zeros(len(keys), bool)
        start = 0
        for bucket, end in enumerate(ends.tolist()):
            if end > start:
                shared[order[start:end]] = np.unpackbits(unpack(bits[bucket])[0], count=end - start).astype(bool)
            start = end
        mine = np.flatnonzero(shared[places])
        self.first, self.count, self.doc = runs.first[mine], runs.count[mine], runs.doc[mine]
        numbers: dict[bytes, int] = {}
        data = chunk.data
        self.owner = np.fromiter(
            (
                numbers.setdefault(bytes(data[a:b]), len(numbers))
                for a, b in zip(self.first.tolist(), (self.first + self.count + threshold - 1).tolist(), strict=True)
            ),
            np.int64,
            len(mine),
        )
        self.contents = list(numbers)
        self.least = np.full(len(numbers), NO_ID, np.int64)
        np.minimum.at(self.least, self.owner, chunk.ids[self.doc])
        self.anchor = np.zeros(len(numbers), np.uint64)
        self.anchor[self.owner] = runs.anchor[mine]
        self.order, self.ends = by_bucket(bucket_of(self.anchor, buckets), buckets)

    def by_bucket(self) -> Iterator[tuple[int, np.ndarray]]:
        start = 0
        for bucket, end in enumerate(self.ends.tolist()):
            if end > start:
                yield bucket, self.order[start:end]
            start = end


def _ask_windows(threshold: int, anchor: int, buckets: int):
    def use(number: int, chunk: Chunk, got: dict[int, dict[int, bytes]]) -> pa.Table:
        segments = Segments(chunk, got.get(0, {}), threshold, anchor, buckets)

        def blocks() -> Iterator[tuple[int, bytes]]:
            for bucket, some in segments.by_bucket():
                chosen = [segments.contents[k] for k in some.tolist()]
                sizes = np.array([len(c) for c in chosen], np.uint32)
                head = pack(segments.anchor[some], segments.least[some], sizes)
                body = zstandard.ZstdCompressor(level=1).compress(b"".join(chosen))
                yield bucket, len(head).to_bytes(8, "little") + head + body

        return blocks_table(number, blocks())

    return use


def radix_groups(first: np.ndarray, data: np.ndarray, places: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows that are not alone, ordered by first digit and bytes, and the group of equals of each.

    The passes go from the most significant digit; each orders groups of equals by their next eight bytes.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    alive = np.arange(len(places))
    _, group = np.unique(first, return_inverse=True)
    for digit in range(-1, -(-threshold // 8)):
        if digit >= 0:
            width = min(8, threshold - 8 * digit)
            value = np.zeros(len(alive), np.uint64)
            at = places[alive] + 8 * digit
            for k in range(width):
                value = (value << np.uint64(8)) | padded[at + k]
            order = np.lexsort((value, group))
            alive, group, value = alive[order], group[order], value[order]
            new = np.concatenate([[True], (group[1:] != group[:-1]) | (value[1:] != value[:-1])]) if len(alive) else np.empty(0, bool)
            group = np.cumsum(new) - 1
        counts = np.bincount(group, minlength=1)
        keep = counts[group] > 1
        alive, group = alive[keep], group[keep]
    return alive, group


def _least_ids(threshold: int):
    def merge(blocks: list[bytes]) -> list[bytes]:
        """For each window of each segment, in order, the least id of all documents where it starts."""
        anchor, least, sizes, bodies, segments = [], [], [], [], []
        for block in blocks:
            n = int.from_bytes(block[:8], "little")
            a, b, c = unpack(block[8 : 8 + n])
            anchor.append(a)
            least.append(b)
            sizes.append(c.astype(np.int64))
            segments.append(len(a))
            bodies.append(zstandard.ZstdDecompressor().decompress(block[8 + n :]))
        whole = b"".join(bodies)
        del bodies
        anchor, least, size = np.concatenate(anchor), np.concatenate(least), np.concatenate(sizes)
        begin = np.cumsum(size) - size
        # What several chunks have alike is one content from here on, with the least id of all.
        numbers = numbering()
        content = numbered(numbers, [whole[a:b] for a, b in zip(begin.tolist(), (begin + size).tolist(), strict=True)])
        n = len(numbers)
        del numbers
        first = np.empty(n, np.int64)
        first[content[::-1]] = np.arange(len(content))[::-1]
        low = np.full(n, NO_ID, np.int64)
        np.minimum.at(low, content, least)
        count = size[first] - threshold + 1
        shift = np.cumsum(count) - count
        out = np.repeat(low, count)
        # Windows of an anchor with one content are equal to none of another content.
        order = np.argsort(anchor[first], kind="stable")
        key = anchor[first[order]]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.cumsum(new) - 1
        several = np.bincount(group)[group] > 1
        order, new = order[several], new[several]
        # Whole groups of anchors at a time, so that memory follows the largest group and not the bucket.
        data = np.frombuffer(whole, np.uint8)
        edges = np.append(np.flatnonzero(new), len(order))
        ends = np.append(0, np.cumsum(count[order]))[edges]
        at = 0
        while at < len(edges) - 1:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + WINDOWS_AT_ONCE, side="right")) - 1)
            some = order[edges[at] : edges[to]]
            at = to
            owner = np.repeat(some, count[some])
            step = np.arange(len(owner)) - np.repeat(np.cumsum(count[some]) - count[some], count[some])
            alive, group = radix_groups(anchor[first[owner]], data, begin[first[owner]] + step, threshold)
            if len(alive):
                places = (shift[owner] + step)[alive]
                heads = np.concatenate([[True], group[1:] != group[:-1]])
                out[places] = np.minimum.reduceat(out[places], np.flatnonzero(heads))[np.cumsum(heads) - 1]
        answers = []
        for mine in np.split(content, np.cumsum(segments)[:-1]):
            n_windows = count[mine]
            step = np.arange(int(n_windows.sum())) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
            answers.append(pack(out[np.repeat(shift[mine], n_windows) + step]))
        return answers

    return merge


KEPT = pa.schema([
    ("doc_id", pa.int64()),
    ("n_bytes", pa.int64()),
    ("n_removed", pa.int64()),
    ("n_spans", pa.int64()),
    ("kept", pa.binary()),
    ("kept_text", pa.string()),
    ("carried", pa.string()),
])
KEPT_DDL = (
    "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_text string, carried string"
)


def removed_bytes(chunk: Chunk, got: dict[int, dict[int, bytes]], threshold: int, anchor: int, buckets: int) -> np.ndarray:
    """A mask of the chunk's bytes."""
    segments = Segments(chunk, got.get(0, {}), threshold, anchor, buckets)
    answers = got.get(1, {})
    windows = np.array([len(c) for c in segments.contents], np.int64) - threshold + 1
    # The answers stay in the order in which they come, and each content knows where its own begin.
    parts, seen = [], []
    for bucket, some in segments.by_bucket():
        parts.append(unpack(answers[bucket])[0])
        seen.append(some)
    edge = np.zeros(len(chunk.data) + 1, np.int32)
    if len(windows):
        come = np.concatenate(seen)
        begin = np.empty(len(windows), np.int64)
        begin[come] = np.cumsum(windows[come]) - windows[come]
        flat = np.concatenate(parts)
        del parts, seen, come
        for at in range(0, len(segments.owner), WINDOWS_AT_ONCE >> 6):
            some = slice(at, at + (WINDOWS_AT_ONCE >> 6))
            count, owner = segments.count[some], segments.owner[some]
            step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            hit = flat[np.repeat(begin[owner], count) + step] < np.repeat(chunk.ids[segments.doc[some]], count)
            places = (np.repeat(segments.first[some], count) + step)[hit]
            # A window is in one run only, so no place comes twice.
            edge[places] += 1
            edge[places + threshold] -= 1
    return np.cumsum(edge[:-1], dtype=np.int32) > 0


def without(data: bytes, turns: list[int]) -> str:
    """The text without the spans, and without characters of which a span has only a part."""
    parts, at = [], 0
    for start, end in zip(turns[::2], turns[1::2], strict=True):
        while start < len(data) and data[start] & 0xC0 == 0x80:
            start -= 1
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        parts.append(data[at : max(at, start)])
        at = max(at, end)
    return b"".join([*parts, data[at:]]).decode("utf-8", "surrogatepass")


def _remover(threshold: int, anchor: int, buckets: int):
    def use(number: int, chunk: Chunk, got: dict[int, dict[int, bytes]]) -> pa.Table:
        gone = removed_bytes(chunk, got, threshold, anchor, buckets)
        data = np.frombuffer(chunk.data, np.uint8)
        rows = []
        places = zip(chunk.ids.tolist(), chunk.starts.tolist(), chunk.ends.tolist(), chunk.carried, strict=True)
        for doc_id, start, end, carried in places:
            part = gone[start:end]
            turns = np.flatnonzero(np.diff(np.concatenate([[False], part, [False]]).astype(np.int8)))
            kept = data[start:end][~part] if len(turns) else data[start:end]
            rows.append((
                None if doc_id == NO_ID else doc_id,
                end - start,
                int(part.sum()),
                len(turns) // 2,
                kept.tobytes(),
                without(bytes(chunk.data[start:end]), turns.tolist()),
                carried,
            ))
        columns = list(zip(*rows, strict=True)) or [[] for _ in KEPT]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, KEPT, strict=True)], schema=KEPT)

    return use


def remove_repeats(
    docs: DataFrame,
    threshold: int = THRESHOLD,
    anchor: int | None = None,
    chunk_bytes: int = CHUNK_BYTES,
    carry: Column | None = None,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, the kept bytes, their whole characters as text, and a carried string."""
    anchor = (threshold + 1) // 2 if anchor is None else anchor
    ids = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        (F.lit("") if carry is None else carry).alias("carry"),
    )
    chunks = to_chunks(ids, limit=chunk_bytes, carry=F.col("carry"))
    buckets = bucket_count(chunks, BUCKET_BYTES)
    bits = stored(answer(ask(chunks, _ask_anchors(threshold, anchor, buckets)), _shared_anchors, kind=0), "anchors")
    release(docs.sparkSession)
    windows = with_answers(chunks, bits, _ask_windows(threshold, anchor, buckets), BLOCKS_DDL)
    least = stored(answer(windows, _least_ids(threshold), kind=1), "windows")
    del windows
    release(docs.sparkSession)
    return with_answers(chunks, bits.unionAll(least), _remover(threshold, anchor, buckets), KEPT_DDL)


def q_repeats(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
