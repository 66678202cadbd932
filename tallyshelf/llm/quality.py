"""Quality rules: counts of words, symbols, lines and repeats, and perplexity under an n-gram model by language.

The model is a modified Kneser-Ney model of LENGTH whole characters, of every alphabet. Documents are dealt to chunks
by a hash of the row. A chunk sends its distinct sequences to hashed buckets (as in `chunks.py`), with their counts and
whether one text alone has them. Buckets add them up; Spark takes from these the continuation counts of shorter
sequences, the discounts and the interpolated probabilities. Then each bucket answers the chunks with the probabilities
of what they sent. Numbers of chunks and buckets follow the input, and no part of the model passes the driver or is
broadcast. Texts are dealt twice and not stored; the same row gets the same chunk however the input is read.

Below LEAST_LENGTH characters it goes on with a model of ORDER symbols. A symbol is a character folded to one of 64
classes (letters a to z, any capital, any digit, white space, single signs, sixteen classes of other characters); the
share of a character in its class is that in the language. A text is no evidence for itself: a sequence that only
one text has, in any number of copies, is taken as never seen, and shorter ones give its probability.

A document whose perplexity is outside the band of its language is rejected. The band is the median of the log
perplexity of the language's documents that pass the base rules, plus or minus WIDTH robust standard deviations
(from the quartiles), and a share for shortness: NOISE / sqrt(characters). Documents without a language are a
language of their own.

Defined cases: null and empty text has no words, so it fails the base rules; text without characters has no
perplexity and passes the bands; repeated rows and ids are judged on their own; other columns are not read;
long texts are read whole. An empty table gives no rows.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyshelf.llm.chunks import BLOCKS, BLOCKS_DDL, CHUNK_BYTES, LEAST_BUCKETS, Blocks, blocks_table, bucket_of, by_bucket
from tallyshelf.llm.common import (
    discard,
    give_back,
    mix,
    numbered,
    numbering,
    pack,
    pack_sorted,
    release,
    stored,
    table,
    text_groups,
    unpack,
    unpack_sorted,
)
from tallyshelf.operators.joins import broadcast_rows_if_few

# Characters of a sequence, and of the shortest whose counts are of whole characters.
LENGTH = 5
LEAST_LENGTH = 4
# Bytes of a character in a sequence's code: its number and one, zero before the text.
WIDE = 3
# Places of a text that are looked at together.
PLACES = 1 << 20
ORDER = 4
BITS = 6
SIGNS = ".,!?'\"-;:#*$%&|<>"
SYMBOLS = b"#*$%&|<>"
# Sequences of a bucket, at a guess of one in eight bytes of text; fewer than LEAST_ENTRIES are not worth a bucket.
MODEL_ENTRIES = 4 << 20
LEAST_ENTRIES = 512
GROUP_BYTES = 6 << 20
FLUSH_ENTRIES = 2 << 20
WIDTH = 5.0
NOISE = 2.0
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5
NO_LANGUAGE = "und"
# Languages whose discounts are broadcast at most; more are joined by shuffle.
LANGUAGES = 100_000


def _fold_table() -> np.ndarray:
    points = np.arange(0x110000)
    table = (48 + mix(points) % np.uint64(16)).astype(np.uint8)
    table[:128] = 47
    for k in range(26):
        table[97 + k] = 1 + k
    for point in range(0x600):
        if chr(point).isupper():
            table[point] = 27
    table[48:58] = 28
    table[[9, 10, 11, 12, 13, 32]] = 29
    for k, sign in enumerate(SIGNS):
        table[ord(sign)] = 30 + k
    return table


FOLD = _fold_table()


def symbol_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the ORDER symbols that end at each character, texts in a row, and the characters of each text.

    A text's first characters have zeros before them. Zero is no symbol.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    gap = "\0" * (ORDER - 1)
    points = np.frombuffer((gap + gap.join(texts)).encode("utf-32-le", "surrogatepass"), np.uint32)
    symbols = FOLD[points].astype(np.uint32)
    firsts = np.cumsum(sizes + ORDER - 1) - sizes
    for k in range(1, ORDER):
        symbols[firsts - k] = 0
    codes = np.zeros(len(symbols), np.uint32)
    for k in range(ORDER):
        codes[k:] |= symbols[: len(symbols) - k] << np.uint32(BITS * k)
    keep = np.ones(len(symbols), bool)
    for k in range(1, ORDER):
        keep[firsts - k] = False
    return codes[keep], sizes


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of codes by language, added up in the task."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for language, (codes, counts) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(codes), pa.string()), pa.array(codes, pa.int64()), pa.array(counts, pa.int64())],
                names=["lang", "code", "n"],
            )
        held.clear()

    for group in text_groups(batches, GROUP_BYTES):
        languages, texts = group["lang"].to_pylist(), group["text"].to_pylist()
        for language in sorted(set(languages)):
            codes, _ = symbol_codes([t for t, x in zip(texts, languages, strict=True) if x == language])
            new, counts = np.unique(codes, return_counts=True)
            if language in held:
                old, before = held[language]
                merged, places = np.unique(np.concatenate([old, new]), return_inverse=True)
                counts = np.bincount(places, np.concatenate([before, counts])).astype(np.int64)
                new = merged
            held[language] = new, counts
        if sum(len(codes) for codes, _ in held.values()) > FLUSH_ENTRIES:
            yield from flush()
    yield from flush()


def _discounted(counts: DataFrame) -> DataFrame:
    """Adds d, the discount of each entry's count, by its language's counts of counts."""
    few = [F.sum(F.when(F.col("n") == k, 1).otherwise(0)).alias(f"n{k}") for k in range(1, 5)]
    kept = F.when(F.col("n1") + 2 * F.col("n2") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5)
    of = counts.groupBy("lang").agg(*few).select(
        "lang",
        *[
            F.greatest(
                F.lit(0.1),
                F.least(
                    F.lit(k - 0.1),
                    F.when(F.col(f"n{k}") > 0, k - (k + 1) * kept * F.col(f"n{k + 1}") / F.col(f"n{k}")).otherwise(k / 2),
                ),
            ).alias(f"d{k}")
            for k in range(1, 4)
        ],
    )
    d = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    # One row for each language: usually few, so no language is one task's key.
    of = broadcast_rows_if_few(stored(of, "discounts"), LANGUAGES)
    if of is None:
        return counts.withColumn("d", F.lit(0.0))
    return counts.join(of, "lang").select(*[counts[c] for c in counts.columns], d.alias("d"))


def model_table(docs: DataFrame) -> DataFrame:
    """lang, length, code, log_p (natural, of the last symbol after the others), log_back of a context; stored.

    Rows with log_p are sequences; rows with log_back are contexts: what is left to shorter ones after them.
    """
    counted = docs.select("lang", "text").mapInArrow(_counter, "lang string, code long, n long")
    counts = stored(counted.groupBy("lang", "code").agg(F.sum("n").alias("n")), "ngrams")
    by_length = {ORDER: counts}
    for length in range(ORDER - 1, 0, -1):
        shorter = F.col("code").bitwiseAND((1 << BITS * length) - 1)
        fewer = by_length[length + 1].groupBy("lang", shorter.alias("code")).agg(F.count("*").alias("n"))
        by_length[length] = stored(fewer, "ngrams")
    lower = None
    parts = []
    for length in range(1, ORDER + 1):
        entries = _discounted(by_length[length]).withColumn("context", F.shiftright("code", BITS))
        left = entries.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.sum("d").alias("given"))
        left = stored(left.withColumn("back", F.col("given") / F.col("total")), "contexts")
        if lower is None:
            base = entries.withColumn("p_lower", F.lit(1.0 / (1 << BITS)))
        else:
            shorter = F.col("code").bitwiseAND((1 << BITS * (length - 1)) - 1)
            base = entries.withColumn("shorter", shorter).join(lower, ["lang", "shorter"])
        p = (F.col("n") - F.col("d")) / F.col("total") + F.col("back") * F.col("p_lower")
        # Each length is stored, so the plan of a longer one begins at its files.
        seen = stored(base.join(left, ["lang", "context"]).select("lang", "code", p.alias("p")), "sequences")
        parts.append(seen.select("lang", F.lit(length).alias("length"), "code", F.log("p").alias("log_p"), F.lit(None).cast("double").alias("log_back")))
        parts.append(left.select("lang", F.lit(length).alias("length"), F.col("context").alias("code"), F.lit(None).cast("double").alias("log_p"), F.log("back").alias("log_back")))
        lower = seen.select("lang", F.col("code").alias("shorter"), F.col("p").alias("p_lower"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole


@dataclass
class Arrays:
    """One language's model: for each length sorted codes and log probabilities, sorted contexts and log weights."""

    codes: list[np.ndarray]
    log_p: list[np.ndarray]
    contexts: list[np.ndarray]
    log_back: list[np.ndarray]

    def score(self, codes: np.ndarray) -> np.ndarray:
        """Log probability of the last symbol of each code."""
        out = np.zeros(len(codes))
        todo = np.arange(len(codes))
        for length in range(ORDER, 0, -1):
            part = codes[todo] & np.uint32((1 << BITS * length) - 1)
            keys = self.codes[length - 1]
            at = np.searchsorted(keys, part).clip(max=len(keys) - 1)
            hit = keys[at] == part
            out[todo[hit]] += self.log_p[length - 1][at[hit]]
            todo, part = todo[~hit], part[~hit]
            if not len(todo):
                return out
            contexts = self.contexts[length - 1]
            above = part >> np.uint32(BITS)
            at = np.searchsorted(contexts, above).clip(max=len(contexts) - 1)
            known = contexts[at] == above
            out[todo[known]] += self.log_back[length - 1][at[known]]
        out[todo] -= math.log(1 << BITS)
        return out


def arrays_of(rows: pa.Table) -> dict[str, Arrays]:
    """Models by language from rows of the model table."""
    names, places = np.unique(np.asarray(rows["lang"].to_pylist(), dtype=object).astype(str), return_inverse=True)
    length, code = np.asarray(rows["length"]), np.asarray(rows["code"]).astype(np.uint32)
    log_p, log_back = np.asarray(rows["log_p"], float), np.asarray(rows["log_back"], float)
    out = {}
    for k, name in enumerate(names):
        model = Arrays([], [], [], [])
        for of_length in range(1, ORDER + 1):
            mine = (places == k) & (length == of_length)
            for values, codes, kept in ((log_p, model.codes, model.log_p), (log_back, model.contexts, model.log_back)):
                some = np.flatnonzero(mine & ~np.isnan(values))
                some = some[np.argsort(code[some])]
                codes.append(code[some])
                kept.append(values[some].astype(np.float32))
        out[str(name)] = model
    return out


def repeated_words(rows: list[np.ndarray]) -> np.ndarray:
    """Words of each row of word numbers that stand in a window of WINDOW words which the row has twice or more."""
    sizes = np.array([len(r) for r in rows], np.int64)
    words = np.concatenate(rows) if len(rows) else np.empty(0, np.int64)
    if len(words) < WINDOW:
        return np.zeros(len(rows), np.int64)
    owner = np.repeat(np.arange(len(rows)), sizes)
    n = len(words) - WINDOW + 1
    starts = np.flatnonzero(owner[:n] == owner[WINDOW - 1 :])
    key = mix(owner[starts])
    for k in range(WINDOW):
        key = mix(key + words[starts + k].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(starts), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts[twice], 1)
    np.add.at(edge, starts[twice] + WINDOW, -1)
    return np.bincount(owner[np.cumsum(edge[:-1]) > 0], minlength=len(rows))


def text_counts(texts: list[str]) -> dict[str, np.ndarray]:
    numbers = numbering()
    rows, n_words, word_chars, n_symbols, n_dup = [], [], [], [], []
    for text in texts:
        data = text.encode("utf-8", "surrogatepass")
        words = data.split()
        rows.append(numbered(numbers, words))
        n_words.append(len(words))
        word_chars.append(len(text) - sum(data.count(s) for s in b" \t\n\x0b\x0c\r"))
        n_symbols.append(sum(data.count(s) for s in SYMBOLS))
        lines = [x for x in data.split(b"\n") if x.split(None, 1)]
        n_dup.append(len(lines) - len(set(lines)))
    return {
        "n_words": np.array(n_words, np.int64),
        "word_chars": np.array(word_chars, np.int64),
        "n_symbols": np.array(n_symbols, np.int64),
        "n_dup_lines": np.array(n_dup, np.int64),
        "n_repeat_words": repeated_words(rows),
    }


MEASURES = pa.schema([
    ("doc_id", pa.int64()),
    ("lang", pa.string()),
    ("n_words", pa.int64()),
    ("word_chars", pa.int64()),
    ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()),
    ("n_scored", pa.int64()),
    ("log_perplexity", pa.float64()),
])
MEASURES_DDL = (
    "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_scored long, log_perplexity double"
)


def _dealer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their text compressed; equal rows that lie near each other are one, with their number."""
    compress = zstandard.ZstdCompressor(level=3).compress
    for group in text_groups(batches, GROUP_BYTES):
        copies = Counter(zip(*(c.to_pylist() for c in group.columns), strict=True))
        chunk, doc_id, language, same, texts = zip(*copies, strict=True)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(chunk, pa.int64()),
                pa.array(doc_id, pa.int64()),
                pa.array(language, pa.string()),
                pa.array(same, pa.int64()),
                pa.array(list(copies.values()), pa.int64()),
                pa.array([compress(t.encode("utf-8", "surrogatepass")) for t in texts], pa.binary()),
            ],
            names=["chunk", "doc_id", "lang", "same", "copies", "data"],
        )


DEALT_DDL = "chunk long, doc_id long, lang string, same long, copies long, data binary"


class Spelled:
    """Texts of one language in a row, copies of a text side by side, with zeros before each text."""

    def __init__(self, language: str, texts: list[str], identity: np.ndarray, copies: np.ndarray) -> None:
        self.order = np.argsort(identity, kind="stable")
        texts = [texts[k] for k in self.order]
        self.identity, self.copies = identity[self.order], copies[self.order]
        self.seed = seed_of(language)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        gap = "\0" * (LENGTH - 1)
        data = (gap + gap.join(texts)).encode("utf-32-le", "surrogatepass")
        self.points = np.frombuffer(data, np.uint32) + np.uint32(1)
        self.firsts = np.cumsum(self.sizes + LENGTH - 1) - self.sizes
        for k in range(1, LENGTH):
            self.points[self.firsts - k] = 0

    def windows(self, places: np.ndarray) -> np.ndarray:
        return self.points[places[:, None] + np.arange(1 - LENGTH, 1)]

    def runs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For the places in parts: keys of sequences, where each one's run begins, and places and texts in runs.

        A key may have several runs in a part. Places of a run ascend, and so do its texts.
        """
        number = np.uint64(PLACES - 1)
        for a in range(LENGTH - 1, len(self.points), PLACES):
            b = min(a + PLACES, len(self.points))
            keys = window_keys([self.points[a + k : b + k] for k in range(1 - LENGTH, 1)], self.seed)
            here = np.flatnonzero(self.points[a:b])
            # Sorting values is several times faster than sorting places by them.
            inside = (np.sort(keys[here] & ~number | here.astype(np.uint64)) & number).astype(np.int64)
            in_order = keys[inside]
            new = np.flatnonzero(np.concatenate([[True], in_order[1:] != in_order[:-1]])[: len(inside)])
            t0, t1 = np.searchsorted(self.firsts, [a, b - 1], side="right") - 1
            t0, t1 = max(t0, 0), max(t1, 0)
            ends = np.append(self.firsts[t0 + 1 : t1 + 1], b)
            texts = np.repeat(np.arange(t0, t1 + 1), np.diff(np.append(a, ends)))
            yield in_order[new], new, inside + a, texts[inside]


def seed_of(language: str) -> np.uint64:
    digest = blake2b(language.encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return np.uint64(int.from_bytes(digest, "little"))


# Odd factors of a sequence's characters, from the first on.
FACTORS = mix(np.arange(1, LENGTH + 1)) | np.uint64(1)


def window_keys(columns, seed: np.uint64 | np.ndarray) -> np.ndarray:
    """A hash of each sequence and its language, from the sequences' characters in their order."""
    keys = np.atleast_1d(seed)
    for column, factor in zip(columns, FACTORS, strict=True):
        keys = keys + column * factor
    return keys


def _added(keys: np.ndarray, counts: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys, sums of counts, owners (0: several) and a place of each key."""
    if not len(keys):
        return keys, counts, owners, np.empty(0, np.int64)
    order = np.argsort(keys, kind="stable")
    in_order = keys[order]
    new = np.flatnonzero(np.concatenate([[True], in_order[1:] != in_order[:-1]]))
    owners = owners[order]
    least = np.minimum.reduceat(owners, new)
    one = least == np.maximum.reduceat(owners, new)
    return in_order[new], np.add.reduceat(counts[order], new), np.where(one, least, 0), order[new]


def _texts(rows: pa.Table) -> list[str]:
    restore = zstandard.ZstdDecompressor().decompress
    return [restore(x).decode("utf-8", "surrogatepass") for x in rows["data"].to_pylist()]


def _by_language(rows: pa.Table, texts: list[str]) -> Iterator[tuple[str, np.ndarray, Spelled]]:
    """Languages of a chunk, the rows of each, in the order in which their texts are spelled, and these."""
    languages = rows["lang"].to_pylist()
    identity, copies = (np.asarray(rows[c], dtype=np.int64) for c in ("same", "copies"))
    for language in sorted(set(languages)):
        mine = np.array([k for k, x in enumerate(languages) if x == language])
        spelled = Spelled(language, [texts[k] for k in mine], identity[mine], copies[mine])
        yield language, mine[spelled.order], spelled


def _question(buckets: int):
    """A chunk's distinct sequences for each bucket: languages, characters, counts and the one text that has them."""

    def blocks(rows: pa.Table) -> Blocks:
        names, found = [], []
        for language, _, spelled in _by_language(rows, _texts(rows)):
            parts = []
            alone = bool((spelled.copies == 1).all())
            for keys, new, places, texts in spelled.runs():
                if not len(keys):
                    continue
                ends = np.append(new[1:], len(places))
                counts = ends - new if alone else np.add.reduceat(spelled.copies[texts], new)
                first, last = spelled.identity[texts[new]], spelled.identity[texts[ends - 1]]
                parts.append((keys, counts, np.where(first == last, first, 0), places[new]))
            if not parts:
                continue
            keys, counts, owners, places = (np.concatenate(p) for p in zip(*parts, strict=True))
            keys, counts, owners, at = _added(keys, counts, owners)
            windows = spelled.windows(places[at])
            found.append((keys, counts, owners, windows, np.full(len(keys), len(names), np.uint16)))
            names.append(language)
        if not found:
            return
        keys, counts, owners, windows, language = (np.concatenate(p) for p in zip(*found, strict=True))
        head = np.frombuffer(json.dumps(names).encode(), np.uint8)
        order, ends = by_bucket(bucket_of(keys, buckets), buckets)
        for k in np.flatnonzero(np.diff(ends, prepend=0)).tolist():
            some = order[ends[k - 1] if k else 0 : ends[k]]
            # By owner, so that one that has several is stored once.
            some = some[np.argsort(owners[some].view(np.uint64), kind="stable")]
            owner = pack_sorted(owners[some].view(np.uint64))
            yield k, pack(head, language[some], counts[some].astype(np.uint64), owner, *windows[some].T)

    def run(rows: pa.Table) -> pa.Table:
        found = blocks_table(rows["chunk"][0].as_py(), blocks(rows))
        give_back()
        return found

    return run


def _unpacked(data: bytes) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Languages, keys, counts, owners, characters and the language of each sequence of a block."""
    head, language, counts, gaps, *columns = unpack(data)
    counts, owners = counts.astype(np.int64), unpack_sorted(gaps).view(np.int64)
    names = json.loads(head.tobytes())
    seeds = np.array([seed_of(x) for x in names])
    return names, window_keys(columns, seeds[language]), counts, owners, np.stack(columns, 1), language


SEQUENCES_DDL = "bucket long, lang string, code binary, symbols long, n long, owner long"


def _codes(windows: np.ndarray) -> pa.Array:
    """Sequences as bytes, so that Spark can cut them."""
    n = len(windows)
    data = np.ascontiguousarray(windows.astype(">u4")).view(np.uint8).reshape(n, LENGTH, 4)[:, :, 4 - WIDE :]
    ends = np.arange(n + 1, dtype=np.int32) * (LENGTH * WIDE)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())])


def _windows(codes: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), LENGTH, WIDE).astype(np.uint32)
    return data[:, :, 0] << 16 | data[:, :, 1] << 8 | data[:, :, 2]


def _count(rows: pa.Table) -> pa.Table:
    """The sequences of a bucket, each once with the counts of all chunks added up."""
    keys, counts, owners, windows, languages = [], [], [], [], []
    numbers = numbering()
    for data in rows["data"].to_pylist():
        names, *arrays, language = _unpacked(data)
        for held, a in zip((keys, counts, owners, windows), arrays, strict=True):
            held.append(a)
        languages.append(numbered(numbers, names)[language])
    sums = _added(*(np.concatenate(a) for a in (keys, counts, owners)))
    at = sums[3]
    windows = np.concatenate(windows)[at]
    symbols = np.concatenate([[0], FOLD]).astype(np.int64)[windows[:, LENGTH - ORDER :]]
    codes = symbols @ (1 << BITS * np.arange(ORDER - 1, -1, -1, dtype=np.int64))
    names = pa.array(list(numbers), pa.string()).take(pa.array(np.concatenate(languages)[at]))
    bucket = pa.array(np.full(len(at), rows["bucket"][0].as_py()))
    return pa.Table.from_arrays(
        [bucket, names, _codes(windows), pa.array(codes), pa.array(sums[1]), pa.array(sums[2])],
        names=["bucket", "lang", "code", "symbols", "n", "owner"],
    )


def _one_owner() -> Column:
    least = F.min("owner")
    return F.when(least == F.max("owner"), least).otherwise(0)


def sequence_table(counts: DataFrame, symbols: DataFrame) -> DataFrame:
    """bucket, lang, code, log_p (natural, of the last character after the others) of all sequences; stored.

    `counts` has the columns of SEQUENCES_DDL, `symbols` is the symbols' model table.
    """

    def cut(first: int, length: int) -> Column:
        return F.substring("code", 1 + first * WIDE, length * WIDE)

    by_length = {LENGTH: counts}
    for length in range(LENGTH - 1, LEAST_LENGTH - 1, -1):
        fewer = by_length[length + 1].groupBy("lang", cut(1, length).alias("code")).agg(
            F.count("*").alias("n"), _one_owner().alias("owner"), F.min("symbols").alias("symbols")
        )
        by_length[length] = stored(fewer, "sequences")
    symbol = F.col("symbols").bitwiseAND((1 << BITS) - 1)
    characters = counts.groupBy("lang", symbol.alias("symbol"), cut(LENGTH - 1, 1).alias("last")).agg(F.sum("n").alias("n"))
    characters = stored(characters, "characters")
    classes = characters.groupBy("lang", "symbol").agg(F.sum("n").alias("of"))
    shares = characters.join(classes, ["lang", "symbol"]).select("lang", "last", (F.col("n") / F.col("of")).alias("share"))
    folded = symbols.filter((F.col("length") == ORDER) & F.col("log_p").isNotNull())
    folded = folded.select("lang", F.col("code").alias("symbols"), F.exp("log_p").alias("p_symbol"))
    lower = None
    for length in range(LEAST_LENGTH, LENGTH + 1):
        entries = _discounted(by_length[length]).withColumn("context", cut(0, length - 1))
        left = entries.groupBy("lang", "context").agg(
            F.sum("n").alias("total"), F.sum("d").alias("given"), _one_owner().alias("context_owner")
        )
        if lower is None:
            base = entries.join(folded, ["lang", "symbols"]).withColumn("last", cut(length - 1, 1)).join(shares, ["lang", "last"])
            base = base.withColumn("p_lower", F.col("p_symbol") * F.col("share"))
        else:
            base = entries.withColumn("shorter", cut(1, length - 1)).join(lower, ["lang", "shorter"])
        rest = F.col("given") / F.col("total") * F.col("p_lower")
        # What one text alone has is not held for it.
        p = (
            F.when(F.col("owner") == 0, (F.col("n") - F.col("d")) / F.col("total") + rest)
            .when(F.col("context_owner") == 0, rest)
            .otherwise(F.col("p_lower"))
        )
        kept = ["bucket", "lang", "code"] if length == LENGTH else ["lang", "code"]
        seen = stored(base.join(stored(left, "contexts"), ["lang", "context"]).select(*kept, p.alias("p")), "sequences")
        lower = seen.select("lang", F.col("code").alias("shorter"), F.col("p").alias("p_lower"))
    return seen.select(*kept, F.log("p").alias("log_p"))


def _reply(model: pa.Table, blocks: pa.Table) -> pa.Table:
    """For each block of a bucket the log probabilities of its sequences, in the order of languages and then of keys."""
    numbers = numbering()
    language = numbered(numbers, model["lang"].to_pylist())
    windows = _windows(model["code"].to_pylist())
    seeds = np.array([seed_of(x) for x in numbers], np.uint64)
    keys = window_keys(windows.T, seeds[language])
    order = np.argsort(keys)
    keys, log_p = keys[order], np.asarray(model["log_p"], float)[order].astype(np.float32)
    data = []
    for block in blocks["data"].to_pylist():
        names, asked, *_, of = _unpacked(block)
        # A chunk has its languages in the order of their names.
        data.append(pack(log_p[np.searchsorted(keys, asked[np.lexsort((asked, of))])]))
    give_back()
    return pa.Table.from_arrays(
        [blocks["chunk"].combine_chunks(), blocks["bucket"].combine_chunks()]
        + [pa.array([0] * len(data), pa.int32()), pa.array(data, pa.binary())],
        schema=BLOCKS,
    )


def _scores(rows: pa.Table, texts: list[str], got: dict[int, bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Characters and log perplexity of a chunk's texts, from the buckets' answers to its question."""
    spelled, keys = [], []
    for _, mine, part in _by_language(rows, texts):
        keys.append(np.unique(np.concatenate([np.empty(0, np.uint64), *(found for found, *_ in part.runs())])))
        spelled.append((mine, part))
    whole = np.concatenate([np.empty(0, np.uint64), *keys])
    order, ends = by_bucket(bucket_of(whole, buckets), buckets)
    log_p = np.zeros(len(whole))
    for k in np.flatnonzero(np.diff(ends, prepend=0)).tolist():
        log_p[order[ends[k - 1] if k else 0 : ends[k]]] = unpack(got[k])[0]
    scored, total = np.zeros(len(texts), np.int64), np.full(len(texts), np.nan)
    first = 0
    for (mine, part), of in zip(spelled, keys, strict=True):
        own = log_p[first : first + len(of)]
        first += len(of)
        sums = np.zeros(len(mine))
        for found, new, places, owner in part.runs():
            each = np.repeat(own[np.searchsorted(of, found)], np.diff(np.append(new, len(places))))
            sums += np.bincount(owner, each, len(mine))
        scored[mine] = part.sizes
        with np.errstate(invalid="ignore"):
            total[mine] = -sums / np.where(part.sizes > 0, part.sizes, np.nan)
    return scored, total


def _measurer(buckets: int):
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        texts = _texts(rows)
        counts = text_counts(texts)
        got = dict(zip(answers["bucket"].to_pylist(), answers["data"].to_pylist(), strict=True))
        scored, total = _scores(rows, texts, got, buckets)
        measures = pa.Table.from_arrays(
            [rows["doc_id"].combine_chunks(), rows["lang"].combine_chunks()]
            + [pa.array(v, pa.int64()) for v in counts.values()]
            + [pa.array(scored), pa.array(total, from_pandas=True)],
            schema=MEASURES,
        )
        del texts
        give_back()
        return measures.take(pa.array(np.repeat(np.arange(len(rows)), np.asarray(rows["copies"]))))

    return run


def measure(docs: DataFrame, entries: int = MODEL_ENTRIES) -> DataFrame:
    """Counts and log perplexity of every document; stored."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    n_bytes = rows.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).collect()[0]["n"] or 0
    buckets = max(LEAST_BUCKETS, n_bytes // (8 * max(entries, LEAST_ENTRIES)))
    chunk = F.pmod(F.xxhash64("doc_id", "lang", "text"), F.lit(n_bytes // CHUNK_BYTES + 1))
    # Zero stands for several texts.
    same = F.xxhash64("text").bitwiseOR(F.lit(1))
    dealt = rows.select(chunk.alias("chunk"), "doc_id", "lang", same.alias("same"), "text").mapInArrow(_dealer, DEALT_DDL)
    asked = stored(dealt.groupBy("chunk").applyInArrow(_question(buckets), BLOCKS_DDL), "asked")
    release(spark)
    counts = stored(asked.groupBy("bucket").applyInArrow(_count, SEQUENCES_DDL), "sequences")
    release(spark)
    model = sequence_table(counts, model_table(rows))
    release(spark)
    answers = stored(model.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInArrow(_reply, BLOCKS_DDL), "answers")
    discard(asked, counts)
    release(spark)
    # A chunk without characters has no answers.
    measured = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_measurer(buckets), MEASURES_DDL)
    measured = stored(measured, "quality")
    discard(answers)
    return measured


def judge_quality(docs: DataFrame, width: float = WIDTH, noise: float = NOISE) -> DataFrame:
    """Counts, perplexity, its language's band, base_failed and kept of every document."""
    measured = measure(docs)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    measured = measured.withColumn("base_failed", failed)
    usual = measured.filter(~F.col("base_failed") & F.col("log_perplexity").isNotNull())
    quartiles = F.percentile_approx("log_perplexity", [0.25, 0.5, 0.75], 10_000)
    bands = usual.groupBy("lang").agg(quartiles.alias("q")).select(
        "lang", F.col("q")[1].alias("middle"), ((F.col("q")[2] - F.col("q")[0]) / 1.349).alias("spread")
    )
    reach = width * F.col("spread") + noise / F.sqrt(F.greatest(F.col("n_scored"), F.lit(1)))
    judged = measured.join(bands, "lang", "left").withColumns({
        "perplexity": F.exp("log_perplexity"),
        "lower": F.exp(F.col("middle") - reach),
        "upper": F.exp(F.col("middle") + reach),
    })
    outside = F.coalesce((F.col("perplexity") < F.col("lower")) | (F.col("perplexity") > F.col("upper")), F.lit(False))
    return judged.withColumn("kept", ~F.col("base_failed") & ~outside).select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "perplexity", "lower", "upper",
    )


def q_quality(spark, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"))
