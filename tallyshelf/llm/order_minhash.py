"""Near-duplicate documents by order MinHash, verified by banded alignment.

A text's words (apart by ASCII white space) give runs of SHINGLE words, each labelled by how often it occurred
before in the text. Each of SKETCHES hash functions samples the PICKS least labelled runs and keeps them in text
order; texts that have a sketch in common are candidates. The order makes the sketch sensitive to edits that
move text, unlike a set of minima. A candidate pair is linked if the edit distance of its word sequences is at
most (1 - SIMILARITY) of the longer one, computed in a band around the diagonal that is widened only as far as
that bound; before, pairs are left out whose counts of words in bins show that their distance is greater. Linked texts, and links of links, are one class; exact copies are one text to begin with.

Of the texts in a bucket, neighbours in a chain are compared first, in two levels: in a part of the bucket (by hash),
and the parts' first texts; that joins most classes with pairs that grow with the bucket. A bucket that still has
several classes is then cut into blocks of about BLOCK texts or BLOCK_WORDS words by hash, and every two blocks meet
in one group with the words of their texts (as 64-bit hashes). There each text is compared with those of other classes
that the profiles leave, nearest first, and a link makes one class of two at once: so the task verifies, no candidates
leave it, and a group gives fewer links than it has texts. Any two texts with a sketch in common are of one class or
were compared, and no group holds more than two blocks. The rows sent to blocks grow with the square of such a
bucket over BLOCK; buckets of one class send none.

Defined cases: null and empty texts are copies of each other; a text shorter than a run is one run, one with
fewer runs than PICKS gives all it has; a class is named by the least of its ids, null if it has none; repeated
rows and ids each give a row; other columns are not read; long texts are compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyshelf.llm.common import mix, numbered, numbering, stored, table, text_groups
from tallyshelf.llm.components import components
from tallyshelf.operators.joins import broadcast_rows_if_few

SHINGLE = 5
PICKS = 2
SKETCHES = 24
SIMILARITY = 0.8
PARTS = 16
# Texts and words that a block has at most, about; a longer text is a block of its own.
BLOCK = 1024
BLOCK_WORDS = 1 << 18
BINS = 256
# Bins that are added up for the first look at a block's pairs.
FOLD = 16
FIRST_BAND = 8
# Rows of a digest and an id that are broadcast at most; more are joined by shuffle.
SLIM_ROWS = 500_000
GROUP_BYTES = 4 << 20
LAST = np.uint64(0xFFFFFFFFFFFFFFFF)

KEYS = pa.schema([
    ("doc_id", pa.int64()),
    ("body", pa.binary()),
    ("keys", pa.list_(pa.int64())),
    ("n_words", pa.int64()),
    ("profile", pa.binary()),
])
KEYS_DDL = "doc_id long, body binary, keys array<long>, n_words long, profile binary"


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in a row, and the words of each text. Equal words have equal hashes in any task."""
    numbers = numbering()
    rows = [numbered(numbers, text.encode("utf-8", "surrogatepass").split()) for text in texts]
    if not numbers:
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    joined = np.frombuffer(b" ".join(numbers) + b" ", np.uint8).astype(np.uint64)
    ends = np.flatnonzero(joined == 32)
    sizes = np.diff(ends, prepend=-1)
    first = ends - sizes + 1
    # A word's bytes, mixed with their places, add up to its hash.
    place = (np.arange(len(joined)) - np.repeat(first, sizes)).astype(np.uint64)
    hashes = mix(np.add.reduceat(mix(joined + (place << np.uint64(8))), first))
    return hashes[np.concatenate(rows)], np.array([len(r) for r in rows], np.int64)


def profiles(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Words of each text by BINS bins of their hashes, at most 255 in each, as rows of bytes."""
    cell = np.repeat(np.arange(len(sizes)), sizes) * BINS + (words % np.uint64(BINS)).astype(np.int64)
    counts = np.bincount(cell, minlength=len(sizes) * BINS)
    return np.minimum(counts, 255).astype(np.uint8).reshape(len(sizes), BINS)


def sketch_keys(texts: list[str], shingle: int, picks: int, sketches: int) -> list[np.ndarray]:
    """The sketches' keys of each text; none for a text without words."""
    return _keys_of(*word_hashes(texts), shingle, picks, sketches)


def _keys_of(words: np.ndarray, sizes: np.ndarray, shingle: int, picks: int, sketches: int) -> list[np.ndarray]:
    counts = np.where(sizes > 0, np.maximum(sizes - shingle + 1, 1), 0)
    some = counts > 0
    if not some.any():
        return [np.empty(0, np.int64) for _ in sizes]
    begin = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), counts)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + begin[owner]
    padded = np.concatenate([words, np.zeros(shingle, np.uint64)])
    runs = np.zeros(len(start), np.uint64)
    left = (begin + sizes)[owner] - start
    for k in range(shingle):
        runs = np.where(left > k, mix(runs + padded[start + k] + np.uint64(k + 1)), runs)
    # Occurrence labels: the place among equal runs of the text.
    order = np.lexsort((np.arange(len(runs)), runs, owner))
    new = np.concatenate([[True], (runs[order[1:]] != runs[order[:-1]]) | (owner[order[1:]] != owner[order[:-1]])])
    at = np.arange(len(order))
    label = np.empty(len(order), np.uint64)
    label[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    labelled = mix(runs + label * np.uint64(0x9E3779B97F4A7C15))
    heads = (np.cumsum(counts) - counts)[some]
    reps = counts[some]
    out = np.empty((int(some.sum()), sketches), np.int64)
    rows = np.arange(len(reps))
    for f in range(sketches):
        values = (labelled ^ mix(np.array([f + 1]))[0]) * np.uint64(0xD6E8FEB86659FD93)
        values ^= values >> np.uint64(32)
        places = np.full((len(reps), picks), len(runs), np.int64)
        for k in range(picks):
            least = np.minimum.reduceat(values, heads)
            hits = np.flatnonzero(values == np.repeat(least, reps))
            hits = hits[values[hits] != LAST]
            of = np.searchsorted(heads, hits, side="right") - 1
            only = np.concatenate([[True], of[1:] != of[:-1]]) if len(of) else np.empty(0, bool)
            places[of[only], k] = hits[only]
            values[hits[only]] = LAST
        places.sort(axis=1)
        key = np.full(len(reps), f + 1, np.uint64)
        shown = np.concatenate([runs, [np.uint64(0)]])
        for k in range(picks):
            key = mix(key * np.uint64(31) + shown[places[rows, k]])
        out[:, f] = key.view(np.int64)
    keys = iter(out)
    return [next(keys) if s else np.empty(0, np.int64) for s in some]


def _sketcher(shingle: int, picks: int, sketches: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in text_groups(batches, GROUP_BYTES):
            words, sizes = word_hashes(group["text"].to_pylist())
            keys = _keys_of(words, sizes, shingle, picks, sketches)
            counted = [row.tobytes() for row in profiles(words, sizes)]
            ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(keys), pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [group["doc_id"].combine_chunks(), group["body"].combine_chunks(), lists, pa.array(sizes), pa.array(counted)],
                schema=KEYS,
            )

    return run


def banded_distance(a: np.ndarray, b: np.ndarray, limit: int) -> int | None:
    """The edit distance of two sequences if it is at most the limit."""
    if len(a) > len(b):
        a, b = b, a
    n = len(a)
    same = np.flatnonzero(a != b[:n])
    head = int(same[0]) if len(same) else n
    a, b = a[head:], b[head:]
    n = len(a)
    same = np.flatnonzero(a[::-1] != b[len(b) - n :][::-1]) if n else np.empty(0, int)
    tail = int(same[0]) if len(same) else n
    a, b = a[: n - tail], b[: len(b) - tail]
    n, m = len(a), len(b)
    if n == 0 or m - n > limit:
        return m if m <= limit else None
    values, number = np.unique(np.concatenate([a, b]), return_inverse=True)
    lack = np.bincount(number[n:], minlength=len(values)) - np.bincount(number[:n], minlength=len(values))
    least = int(lack[lack > 0].sum())
    if least > limit:
        return None
    a, b = number[:n], number[n:]
    # Words that one side lacks are edits, so a narrower band would be in vain.
    band = min(limit, max(FIRST_BAND, least + least // 4))
    while True:
        found = _in_band(a, b, band)
        if found is not None and found <= band:
            return found if found <= limit else None
        if band >= limit:
            return None
        band = min(limit, 2 * band)


def _in_band(a: np.ndarray, b: np.ndarray, band: int) -> int | None:
    """The distance of alignments that stay within `band` of the diagonal; None once all exceed the band."""
    n, m = len(a), len(b)
    width = 2 * band + 1
    far = n + m + 1
    step = np.arange(width)
    # Cell k of row i is column i + k - band of b.
    wide = np.concatenate([np.full(band + 1, -1), b, np.full(width + 1, -1)])
    row = np.where(step >= band, step - band, far)
    row[step - band > m] = far
    for i in range(1, n + 1):
        cost = row + (wide[i : i + width] != a[i - 1])
        cost[:-1] = np.minimum(cost[:-1], row[1:] + 1)
        low = band - i
        if low >= 0:
            cost[:low] = far
            cost[low] = i
        row = np.minimum.accumulate(cost - step) + step
        if low > 0:
            row[:low] = far
        high = m - i + band + 1
        if high < width:
            row[high:] = far
        if row.min() > band:
            return None
    at = m - n + band
    return int(row[at]) if at < width else None


def similar(a: list[bytes], b: list[bytes], similarity: float) -> bool:
    limit = int((1 - similarity) * max(len(a), len(b)) + 1e-9)
    if abs(len(a) - len(b)) > limit:
        return False
    numbers = numbering()
    x, y = numbered(numbers, a), numbered(numbers, b)
    return banded_distance(x, y, limit) is not None


def _screener(similarity: float):
    """Pairs that their profiles don't rule out: an edit changes a bin by one up, one down, or both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int16)
                for c in (3, 5)
            )
            gap = x - y
            least = np.maximum(np.maximum(gap, 0).sum(axis=1), np.maximum(-gap, 0).sum(axis=1))
            n, m = np.asarray(batch.column(2)), np.asarray(batch.column(4))
            limit = np.floor((1 - similarity) * np.maximum(n, m) + 1e-9)
            some = batch.select([0, 1]).filter(pa.array(np.maximum(least, np.abs(n - m)) <= limit))
            yield pa.RecordBatch.from_arrays(some.columns, names=["a", "b"])

    return run


def _verifier(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                similar(a.encode("utf-8", "surrogatepass").split(), b.encode("utf-8", "surrogatepass").split(), similarity)
                for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ]
            some = batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays(some.columns, names=["a", "b"])

    return run


def chained(rows: DataFrame, parts: int) -> DataFrame:
    """Pairs (a, b) of neighbours among the bodies of each key, in two levels."""
    parted = rows.withColumn("part", F.pmod(F.xxhash64("body"), F.lit(parts)))
    inside = Window.partitionBy("key", "part").orderBy("body")
    across = Window.partitionBy("key").orderBy("body")
    near = parted.select(F.lag("body").over(inside).alias("a"), F.col("body").alias("b"))
    firsts = parted.groupBy("key", "part").agg(F.min("body").alias("body"))
    far = firsts.select(F.lag("body").over(across).alias("a"), F.col("body").alias("b"))
    return near.unionAll(far).filter("a is not null and a != b").distinct()


def _worded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in text_groups(batches, GROUP_BYTES):
        words, sizes = word_hashes(group["text"].to_pylist())
        parts = np.split(words, np.cumsum(sizes)[:-1]) if len(sizes) else []
        rows = pa.array([w.tobytes() for w in parts], pa.binary())
        yield pa.RecordBatch.from_arrays([group["body"].combine_chunks(), rows], names=["body", "words"])


def _links_in(group: pa.Table, similarity: float) -> tuple[list[int], list[int]]:
    """Places of similar pairs that join all classes of a group of two blocks that similar pairs of its key can join.

    A pair that meets under several keys is compared under the least of them.
    """
    words = [np.frombuffer(w, np.uint64) for w in group["words"].to_pylist()]
    n = np.array([len(w) for w in words])
    profile = profiles(np.concatenate(words), n).astype(np.int16)
    coarse = profile.reshape(len(n), BINS // FOLD, FOLD).sum(axis=2, dtype=np.int32)
    # Texts of one number are joined already.
    joined = numbered(numbering(), group["root"].to_pylist()).copy()
    key = group["key"][0].as_py()
    keys = group["keys"].to_pylist()
    table_of = np.full((len(n), max(map(len, keys))), key, np.int64)
    for row, k in zip(table_of, keys, strict=True):
        row[: len(k)] = k
    one = group["low"][0] == group["high"][0]
    at = np.arange(len(n))
    first = np.asarray(group["side"]) == group["low"][0].as_py()
    left, right = (at, at) if one else (at[first], at[~first])
    x, y = [], []
    for k in left.tolist():
        limit = np.floor((1 - similarity) * np.maximum(n[k], n) + 1e-9)
        ok = right[(joined[right] != joined[k]) & (np.abs(n[right] - n[k]) <= limit[right]) & ((right > k) | (not one))]
        least = np.empty(0, np.int64)
        for bins in (coarse, profile):
            gap = bins[k] - bins[ok]
            up, lack = np.maximum(gap, 0).sum(axis=1), gap.sum(axis=1)
            least = np.maximum(up, up - lack)
            close = least <= limit[ok]
            ok, least = ok[close], least[close]
        if not len(ok):
            continue
        common = np.isin(table_of[ok], table_of[k])
        here = np.where(common, table_of[ok], np.iinfo(np.int64).max).min(axis=1) == key
        for j in ok[here][np.argsort(least[here], kind="stable")].tolist():
            if joined[j] != joined[k] and banded_distance(words[k], words[j], int(limit[j])) is not None:
                x.append(k)
                y.append(j)
                joined[joined == joined[j]] = joined[k]
    return x, y


def _crosser(similarity: float):
    """Links of each group of rows that follow one another with the same key, low and high."""

    def linked(group: pa.Table) -> Iterator[pa.RecordBatch]:
        if group.num_rows > 1:
            x, y = _links_in(group, similarity)
            body = group["body"].combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [body.take(pa.array(x, pa.int64())), body.take(pa.array(y, pa.int64()))], names=["a", "b"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            named = list(zip(*(batch.column(c).to_pylist() for c in ("key", "low", "high")), strict=True))
            start = 0
            for k, name in enumerate(named):
                if last is not None and name != last:
                    yield from linked(pa.Table.from_batches([*kept, batch.slice(start, k - start)]))
                    kept, start = [], k
                last = name
            kept.append(batch.slice(start))
        if kept:
            yield from linked(pa.Table.from_batches(kept))

    return run


def crossed(
    buckets: DataFrame,
    bodies: DataFrame,
    texts: DataFrame,
    roots: DataFrame | None,
    similarity: float,
    block: int = BLOCK,
    block_words: int = BLOCK_WORDS,
) -> DataFrame | None:
    """Links (a, b) between different classes among the bodies of each key, verified; fewer in a group than it has texts.

    None if every key of more than two bodies has one class; a chain has compared the bodies of the others.
    """
    named = buckets.withColumn("root", F.col("body"))
    if roots is not None:
        named = buckets.join(roots.withColumnRenamed("node", "body"), "body", "left")
        named = named.withColumn("root", F.coalesce("root", "body"))
    named = stored(named, "named")
    sums = [F.bit_xor(F.xxhash64("body", F.lit(k))).alias(f"sum{k}") for k in (1, 2)]
    mixed = named.groupBy("key").agg(
        F.count("*").alias("n"), F.sum("n_words").alias("words"), F.min("root").alias("low"), F.max("root").alias("high"), *sums
    )
    wanted = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("words") / block_words))
    mixed = mixed.filter("n > 2 and low != high").withColumn("blocks", F.least("n", wanted).cast("int"))
    # Keys of the same bodies have the same pairs: at most as many keys as there are sketches.
    same = F.min("key").over(Window.partitionBy("n", "sum1", "sum2"))
    mixed = stored(mixed.select("key", same.alias("same"), "blocks"), "mixed")
    mixed = broadcast_rows_if_few(mixed, SLIM_ROWS)
    if mixed is None:
        return None
    rows = named.join(mixed, "key").select("body", "root", F.col("same").alias("key"), "blocks").distinct()
    rows = stored(rows, "mixed bodies")
    keys = rows.groupBy("body").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    slim = bodies.select("body", "rep").join(keys.select("body"), "body", "left_semi")
    slim = broadcast_rows_if_few(stored(slim, "wanted"), SLIM_ROWS)
    if slim is None:
        return None
    worded = texts.join(slim, "body").filter(F.col("doc_id").eqNullSafe(F.col("rep"))).select("body", "text")
    worded = worded.dropDuplicates(["body"]).mapInArrow(_worded, "body binary, words binary")
    worded = stored(worded.join(keys, "body"), "words")
    rows = rows.withColumn("side", F.pmod(F.xxhash64("body"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "key", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "body", "root"
    )
    rows = rows.join(worded, "body").repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "body")
    return stored(rows.mapInArrow(_crosser(similarity), "a binary, b binary"), "links")


def near_classes(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    shingle: int = SHINGLE,
    picks: int = PICKS,
    sketches: int = SKETCHES,
    parts: int = PARTS,
) -> DataFrame:
    """doc_id, body (a digest of the text), class_id, the least id of all documents of its class, and its root body."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("body", F.unhex(F.md5("text")))
    sketched = stored(texts.mapInArrow(_sketcher(shingle, picks, sketches), KEYS_DDL), "sketches")
    firsts = [F.first(c).alias(c) for c in ("keys", "n_words", "profile")]
    bodies = stored(sketched.groupBy("body").agg(F.min("doc_id").alias("rep"), *firsts), "bodies")
    buckets = bodies.select("body", "n_words", F.explode("keys").alias("key"))
    shared = buckets.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    buckets = stored(buckets.join(shared, "key"), "buckets")
    small = bodies.select("body", "rep")

    def linked(pairs: DataFrame) -> DataFrame | None:
        """Those of the pairs that are similar; None if there are no pairs."""
        wanted = pairs.select(F.col("a").alias("body")).unionAll(pairs.select(F.col("b").alias("body"))).distinct()
        chosen = broadcast_rows_if_few(stored(wanted.join(small, "body").select("body", "rep"), "wanted"), SLIM_ROWS)
        if chosen is None:
            return None
        words = texts.join(chosen, "body").filter(F.col("doc_id").eqNullSafe(F.col("rep")))
        words = stored(words.select("body", "text").dropDuplicates(["body"]), "candidates")
        both = (
            pairs.join(words.select(F.col("body").alias("a"), F.col("text").alias("x")), "a")
            .join(words.select(F.col("body").alias("b"), F.col("text").alias("y")), "b")
            .select("a", "b", "x", "y")
        )
        return stored(both.mapInArrow(_verifier(similarity), "a binary, b binary"), "links")

    pairs = stored(chained(buckets.select("body", "key"), parts), "pairs")
    for side in "ab":
        pairs = pairs.join(bodies.select(*[F.col(c).alias(f"{c}_{side}") for c in ("body", "n_words", "profile")]),
                           F.col(side) == F.col(f"body_{side}")).drop(f"body_{side}")
    pairs = stored(pairs.mapInArrow(_screener(similarity), "a binary, b binary"), "screened")
    roots = None
    links = linked(pairs)
    if links is not None and not links.isEmpty():
        roots = components(links)
    more = crossed(buckets, bodies, texts, roots, similarity)
    if more is not None and not more.isEmpty():
        links = more if links is None else links.unionAll(more)
        roots = components(links)
    found = small if roots is None else small.join(roots.withColumnRenamed("node", "body"), "body", "left")
    found = found.withColumn("root", F.col("body") if roots is None else F.coalesce("root", "body"))
    least = found.groupBy("root").agg(F.min("rep").alias("class_id"))
    named = stored(found.join(least, "root").select("body", "class_id", "root"), "classes")
    return sketched.select("doc_id", "body").join(named, "body").select("doc_id", "body", "class_id", "root")


def q_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")
