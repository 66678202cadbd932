"""Phrases of two to five words that occur together more often than their parts: an FM-index per shard over word ids.

Texts are cut into pieces at `. , ; : ! ?` and line breaks, pieces into words at blanks and tabs, A-Z in lower case.
All counts are per language. Shards are chunks of documents (`chunks.py`), whatever their languages.

1. Words that occur fewer than `least` times cannot be in a candidate, nor can pairs of words below it, nor longer
   phrases. Shards send packed counts of hashed words to buckets of keys, and get back one bit for each key; then of
   hashed pairs, then of triples. Different words with one hash only let more through, as the final counts are of the
   words themselves.
2. Each shard numbers its words, breaks its text where a word, pair or triple is out, and builds the Burrows-Wheeler
   transforms of the text and of the reversed text, sorted to the depth that phrases have. An interval of the one and one
   of the other stand for a phrase; extending it to the left by the first transform moves both, extending it to the right
   by the second. All intervals of a length are extended at once.
3. Phrases that may be frequent are sent with their counts, and with the word to their left, or right, if all of their
   occurrences in the shard have the same. Buckets of phrases sum across shards. A phrase is part of a longer one that is
   as frequent just if all shards agree on such a word.

Then each way to cut a phrase in two is scored by the counts of both parts, and the lowest score counts. Sums and
scores are exact: long integers, and decimals of 38 digits for the products.

Defined cases: null text is empty, null language is `und`; empty texts and texts without words count nothing; repeated
rows count each; ids and other columns are not read; no documents give no rows. A very long text is a chunk of its own.
A frequent word or a group of copies is one key per shard.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyshelf.llm.chunks import (
    Blocks,
    Chunk,
    answer,
    ask,
    blocks_table,
    bucket_count,
    bucket_of,
    by_bucket,
    to_chunks,
    with_answers,
    BLOCKS_DDL,
)
from tallyshelf.llm.common import discard, mix, numbering, pack, pack_sorted, release, stored, table, unpack, unpack_sorted
from tallyshelf.operators.joins import broadcast_if_small

LEAST = 100
MOST_WORDS = 5
REPORTED = 2000
CHUNK_BYTES = 8 << 20
SALTS = 64
PARTS_BYTES = 64 << 20
#: Of the columns a, total, l and r. Decimals of 19 digits multiply to 38, and the quotient is a long integer.
_WHOLE = "decimal(19, 0)"
SCORE = f"(cast(1000 * a as {_WHOLE}) * cast(total as {_WHOLE})) div (cast(l as {_WHOLE}) * cast(r as {_WHOLE}))"
KEY_BITS = np.uint64(16)  # that are shifted out of 64

# What ends a piece, and what parts words. A stop is no part of a word, so it stands for any end.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(PIECE_ENDS + b"\t", b"." * len(PIECE_ENDS) + b" ")

PHRASES = pa.schema([
    ("lang", pa.string()),
    ("phrase", pa.string()),
    ("n_words", pa.int32()),
    ("n", pa.int64()),
    ("inside", pa.bool_()),
])
PHRASES_DDL = "lang string, phrase string, n_words int, n long, inside boolean"
WORDS, PAIRS, TRIPLES, FOUND, RECORD = range(5)  # kinds of blocks
RECORDED = 3  # words of the longest phrases that shards keep and ask for


class Words:
    """A chunk's words as numbers from 1; 0 is the end of a piece. The same word of two languages is two words."""

    def __init__(self, text: np.ndarray, words: list[bytes], langs: list[str], lang_of: np.ndarray, totals: np.ndarray) -> None:
        self.text, self.words, self.langs, self.lang_of, self.totals = text, words, langs, lang_of, totals
        salts = [lang.encode("utf-8", "surrogatepass") + b"\0" for lang in langs]
        hashed = [xxhash.xxh3_64_intdigest(salts[k] + w) for k, w in zip(lang_of[1:].tolist(), words[1:], strict=True)]
        self.hashes = np.array([0, *hashed], np.uint64)
        self.counts = np.bincount(text, minlength=len(words))
        self.counts[0] = 0

    @classmethod
    def of_chunk(cls, chunk: Chunk) -> Words:
        fresh = count(1)
        numbers: dict[str, dict[bytes, int]] = {}
        parts, end = [np.zeros(1, np.int64)], np.zeros(1, np.int64)
        for lang, text in zip(chunk.carried, chunk.texts(), strict=True):
            if lang not in numbers:
                numbers[lang] = numbering()
                numbers[lang].default_factory = fresh.__next__
                numbers[lang][b"."] = 0
            found = text.lower().translate(_PLAIN).replace(b".", b" . ").split()
            parts += [np.fromiter(map(numbers[lang].__getitem__, found), np.int64, len(found)), end]
        n = next(fresh)
        words, lang_of = [b""] * n, np.zeros(n, np.int64)
        for k, known in enumerate(numbers.values()):
            for word, number in known.items():
                if number:
                    words[number], lang_of[number] = word, k
        text = np.concatenate(parts)
        counts = np.bincount(text, minlength=n)
        totals = np.bincount(lang_of[1:], weights=counts[1:], minlength=len(numbers)).astype(np.int64)
        return cls(text, words, list(numbers), lang_of, totals)

    def dump(self, *more: np.ndarray) -> bytes:
        """As bytes, with further arrays; words hold no line breaks."""
        names = np.frombuffer(b"\n".join(self.words), np.uint8)
        langs = np.frombuffer(json.dumps(self.langs).encode(), np.uint8)
        return pack(self.text.astype(np.int32), names, langs, self.lang_of.astype(np.uint16), self.totals, *more)

    @classmethod
    def load(cls, data: bytes) -> tuple[Words, list[np.ndarray]]:
        text, names, langs, lang_of, totals, *more = unpack(data)
        words = names.tobytes().split(b"\n")
        return cls(text.astype(np.int64), words, json.loads(langs.tobytes()), lang_of.astype(np.int64), totals), more

    def keep(self, kept: np.ndarray) -> Words:
        """Only some words, numbered anew, with piece ends in place of the others and no two ends in a row."""
        kept = np.concatenate([[False], kept])
        text = np.where(kept, np.cumsum(kept), 0)[self.text]
        text = text[np.concatenate([[True], (text[1:] != 0) | (text[:-1] != 0)])]
        own = np.flatnonzero(kept)
        words = [b"", *map(self.words.__getitem__, own.tolist())]
        return Words(text, words, self.langs, np.concatenate([[0], self.lang_of[own]]), self.totals)

    def keys(self, phrases: np.ndarray) -> np.ndarray:
        """The keys of phrases, one per row of word numbers."""
        acc = self.hashes[phrases[:, 0]]
        for k in range(1, phrases.shape[1]):
            acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + self.hashes[phrases[:, k]])
        return acc >> KEY_BITS


class Transform:
    """The Burrows-Wheeler transform of a text of numbers that starts and ends with 0, sorted to a depth."""

    def __init__(self, text: np.ndarray, depth: int) -> None:
        n, rank, length = len(text), text, 1
        while length < depth:
            later = np.concatenate([rank[length:], np.zeros(min(length, n), np.int64)])
            key = rank * (later.max() + 1) + later
            order = np.argsort(key)
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate([[0], np.diff(key[order]) != 0]))
            length *= 2
        self.n = n
        # Rows that are alike to the depth may be in any order: no interval starts or ends among them.
        self.rows = order
        self.before = text[self.rows - 1]
        self.counts = np.bincount(text)
        self.less = np.cumsum(self.counts) - self.counts
        self._by_symbol = np.sort(self.before * (n + 1) + np.arange(n))

    def occurrences(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """How often each symbol is before the texts of the rows above a row."""
        return np.searchsorted(self._by_symbol, symbols * (self.n + 1) + rows) - self.less[symbols]

    def _spread(self, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols before all rows of the intervals, and where each interval starts among them."""
        start = np.cumsum(size) - size
        rows = np.arange(size.sum()) + np.repeat(low - start, size)
        return self.before[rows], start

    def extend(self, low: np.ndarray, other: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Intervals of all extensions by one symbol before; `other` are the intervals of the reversed text."""
        symbols, start = self._spread(low, size)
        base = len(self.counts)
        key = np.sort(np.repeat(np.arange(len(low)), size) * base + symbols)
        first = np.flatnonzero(np.concatenate([[True], np.diff(key) != 0])[: len(key)])
        of, symbol = np.divmod(key[first], base)
        sizes = np.diff(first, append=len(key))
        # In the reversed text the rows of a phrase are in the order of what follows it there.
        others = other[of] + first - start[of]
        kept = symbol > 0
        of, symbol = of[kept], symbol[kept]
        return self.less[symbol] + self.occurrences(symbol, low[of]), others[kept], sizes[kept]

    def only(self, low: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The symbol before an interval's rows if it is the same for all, else 0."""
        if not len(low):
            return np.zeros(0, np.int64)
        symbols, start = self._spread(low, size)
        least = np.minimum.reduceat(symbols, start)
        return np.where(least == np.maximum.reduceat(symbols, start), least, 0)


def phrases_of(text: np.ndarray, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, places, counts, left, right) of all phrases of 2 to `most` words, one length at a time.

    A phrase is known by a place in the text; `left` and `right` are the only word beside all of its occurrences, or 0.
    """
    ahead, back = Transform(text, max(most, 2)), Transform(text[::-1], max(most, 2))
    symbols = np.flatnonzero(ahead.counts[1:]) + 1
    low, other, size = ahead.less[symbols], back.less[symbols], ahead.counts[symbols]
    for length in range(2, most + 1):
        if length % 2:
            low, other, size = ahead.extend(low, other, size)
        else:
            other, low, size = back.extend(other, low, size)
        yield length, ahead.rows[low], size, ahead.only(low, size), back.only(other, size)


def _key_blocks(keys: np.ndarray, counts: np.ndarray, buckets: int) -> Blocks:
    """Sums by key, packed for each bucket."""
    unique, inverse = np.unique(keys, return_inverse=True)
    sums = np.bincount(inverse, weights=counts).astype(np.int64)
    order, ends = by_bucket(bucket_of(unique, buckets), buckets)
    start = 0
    for bucket, end in enumerate(ends.tolist()):
        if end > start:
            own = order[start:end]
            yield bucket, pack(pack_sorted(unique[own]), sums[own])
        start = end


def _frequent(keys: np.ndarray, replies: dict[int, bytes], buckets: int) -> np.ndarray:
    """Which keys are frequent, by the replies to their blocks."""
    unique, inverse = np.unique(keys, return_inverse=True)
    order, ends = by_bucket(bucket_of(unique, buckets), buckets)
    flags = np.zeros(len(unique), bool)
    start = 0
    for bucket, end in enumerate(ends.tolist()):
        if end > start:
            bits = np.frombuffer(replies[bucket], np.uint8)
            flags[order[start:end]] = np.unpackbits(bits, count=end - start)
        start = end
    return flags[inverse]


def _sums_at_least(least: int):
    def merge(blocks: list[bytes]) -> list[bytes]:
        parts = [unpack(b) for b in blocks]
        keys = [unpack_sorted(p[0]) for p in parts]
        unique, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        # Sums of integers below 2**53 are exact in doubles.
        sums = np.bincount(inverse, weights=np.concatenate([p[1] for p in parts]))
        flags = (sums >= least)[inverse]
        return [np.packbits(f).tobytes() for f in np.split(flags, np.cumsum([len(k) for k in keys])[:-1])]

    return merge


def _ask_words(buckets: int):
    def question(chunk: Chunk) -> Blocks:
        words = Words.of_chunk(chunk)
        return _key_blocks(words.hashes[1:] >> KEY_BITS, words.counts[1:], buckets)

    return question


def _pairs(text: np.ndarray) -> np.ndarray:
    """Places whose word has a next one in the piece."""
    return np.flatnonzero((text[:-1] != 0) & (text[1:] != 0))


def _at(text: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    return text[places[:, None] + np.arange(length)]


def _with_record(number: int, blocks: Blocks, kind: int, record: bytes) -> pa.Table:
    return pa.concat_tables([blocks_table(number, blocks, kind), blocks_table(number, iter([(-1, record)]), RECORD)])


def _ask_pairs(buckets: int):
    """Pairs of frequent words, and the text of these as a record."""

    def use(number: int, chunk: Chunk, got: dict[int, dict[int, bytes]]) -> pa.Table:
        words = Words.of_chunk(chunk)
        words = words.keep(_frequent(words.hashes[1:] >> KEY_BITS, got.get(WORDS, {}), buckets))
        keys = words.keys(_at(words.text, _pairs(words.text), 2))
        return _with_record(number, _key_blocks(keys, np.ones(len(keys)), buckets), PAIRS, words.dump())

    return use


def _ask_triples(buckets: int, most: int):
    """Phrases of three words, and a record of those of up to three: places, counts and what is beside them."""

    def use(number: int, data: bytes, got: dict[int, bytes]) -> pa.Table:
        words, _ = Words.load(data)
        at = _pairs(words.text)
        frequent = _frequent(words.keys(_at(words.text, at, 2)), got, buckets)
        words.text = np.insert(words.text, at[~frequent] + 1, 0)
        levels, blocks = [], iter(())
        for length, places, n, left, right in phrases_of(words.text, min(most, RECORDED)):
            order = np.argsort(places)
            places, n, left, right = (a[order] for a in (places, n, left, right))
            sides = ((left > 0) | (right > 0) << 1).astype(np.uint8)
            levels += [np.diff(places, prepend=0).astype(np.int32), n.astype(np.int32), sides]
            if length == RECORDED:
                blocks = _key_blocks(words.keys(_at(words.text, places, length)), n, buckets)
        return _with_record(number, blocks, TRIPLES, words.dump(*levels))

    return use


def _covered(text: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The text with piece ends in place of words that are in none of the triples at some places."""
    kept = np.zeros(len(text), bool)
    for k in range(RECORDED):
        kept[places + k] = True
    text = np.where(kept, text, 0)
    return text[np.concatenate([[True], (text[1:] != 0) | (text[:-1] != 0)])]


def _send_found(buckets: int, most: int):
    """Phrases and words that may be frequent, as text, to the bucket of each."""

    def use(number: int, data: bytes, got: dict[int, bytes]) -> pa.Table:
        words, levels = Words.load(data)
        text, names = words.text, pa.array(words.words, pa.binary())
        nothing = np.zeros(len(words.words) - 1, np.int64)
        own = np.arange(1, len(words.words))
        # Where frequent triples are: longer phrases are made up of these.
        at = np.flatnonzero((text[:-2] != 0) & (text[1:-1] != 0) & (text[2:] != 0)) if most >= RECORDED else own[:0]
        at = at[_frequent(words.keys(_at(text, at, RECORDED)), got, buckets)]
        frequent = np.zeros(len(text), bool)
        frequent[at] = True
        # Per length: the words, their counts, and the only word to the left and right of each phrase.
        found = [(own[:, None], words.counts[1:], nothing, nothing)]
        for length in range(2, min(most, RECORDED) + 1):
            gaps, n, sides = levels[3 * (length - 2) : 3 * (length - 1)]
            places = np.cumsum(gaps.astype(np.int64))
            if length == RECORDED:
                n, sides, places = (a[frequent[places]] for a in (n, sides, places))
            left = np.where(sides & 1, text[places - 1], 0)
            right = np.where(sides & 2, text[places + length], 0)
            found.append((_at(text, places, length), n.astype(np.int64), left, right))
        if most > RECORDED:
            text = _covered(text, at)
            for length, places, n, left, right in phrases_of(text, most):
                if length > RECORDED:
                    found.append((_at(text, places, length), n, left, right))
        lines, keys, counts, lengths, langs = [], [], [], [], []
        for of, n, left, right in found:
            parts = [names.take(pa.array(of[:, k])) for k in range(of.shape[1])]
            phrase = pc.binary_join_element_wise(*parts, b" ") if len(parts) > 1 else parts[0]
            beside = (names.take(pa.array(a)) for a in (left, right))
            lines += pc.binary_join_element_wise(phrase, *beside, b"\t").to_pylist()
            keys.append(words.keys(of))
            counts.append(n)
            lengths.append(np.full(len(of), of.shape[1]))
            langs.append(words.lang_of[of[:, 0]])
        # A language's words are counted under no words.
        n = len(words.langs)
        lines += [b"\t\t"] * n
        keys.append(np.array([xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) for x in words.langs], np.uint64))
        counts.append(words.totals)
        lengths.append(np.zeros(n, np.int64))
        langs.append(np.arange(n))
        key, n, length, lang = map(np.concatenate, (keys, counts, lengths, langs))
        order, ends = by_bucket(bucket_of(key, buckets), buckets)
        names = np.frombuffer(json.dumps(words.langs).encode(), np.uint8)

        def blocks() -> Blocks:
            for bucket, rows in enumerate(np.split(order, ends[:-1])):
                if len(rows):
                    joined = np.frombuffer(b"\n".join(map(lines.__getitem__, rows.tolist())), np.uint8)
                    yield bucket, pack(n[rows], length[rows].astype(np.uint8), lang[rows].astype(np.uint16), names, joined)

        return blocks_table(number, blocks(), FOUND)

    return use


def _sum_found(least: int, most: int):
    """The phrases of a bucket over all shards."""

    def run(rows: pa.Table) -> pa.Table:
        sums: dict[tuple[str, bytes], list] = {}
        for data in rows["data"].to_pylist():
            n, length, lang, names, joined = unpack(data)
            langs = json.loads(names.tobytes())
            lines = joined.tobytes().split(b"\n")
            for line, k, words, number in zip(lines, n.tolist(), length.tolist(), lang.tolist(), strict=True):
                phrase, left, right = line.split(b"\t")
                row = sums.setdefault((langs[number], phrase), [words, 0, left, right])
                row[1] += k
                if row[2] != left:
                    row[2] = b""
                if row[3] != right:
                    row[3] = b""
        out = [
            (lang, phrase.decode("utf-8"), words, n, bool(left or right) and 2 <= words < most)
            for (lang, phrase), (words, n, left, right) in sums.items()
            if n >= least or not words
        ]
        return pa.Table.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(PHRASES)], schema=PHRASES)

    return run


def _with_records(rows: DataFrame, answers: DataFrame, use: Callable[[int, bytes, dict[int, bytes]], pa.Table]) -> DataFrame:
    """Each shard's record with its answers by bucket."""

    def run(mine: pa.Table, blocks: pa.Table) -> pa.Table:
        got = dict(zip(blocks["bucket"].to_pylist(), blocks["data"].to_pylist(), strict=True))
        return use(mine["chunk"][0].as_py(), mine["data"][0].as_py(), got)

    records = rows.filter(F.col("kind") == RECORD)
    return records.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, BLOCKS_DDL)


def phrase_counts(docs: DataFrame, least: int = LEAST, most: int = MOST_WORDS) -> DataFrame:
    """(lang, phrase, n_words, n, inside): phrases and words that occur `least` times, and all words under n_words 0.

    `inside`: a phrase of up to `most` words that contains it occurs as often.
    """
    rows = docs.select(F.lit(None).cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "lang")
    chunks = to_chunks(rows, limit=CHUNK_BYTES, carry=F.coalesce("lang", F.lit("und")))
    buckets = bucket_count(chunks)
    merge = _sums_at_least(least)

    def kept(frame: DataFrame, label: str) -> DataFrame:
        """Stored; what was shuffled for it may go."""
        out = stored(frame, label)
        release(docs.sparkSession)
        return out

    def answered(blocks: DataFrame, kind: int) -> DataFrame:
        return kept(answer(blocks.filter(F.col("kind") == kind), merge, kind), "answers")

    words = answered(ask(chunks, _ask_words(buckets), WORDS), WORDS)
    pairs = kept(with_answers(chunks, words, _ask_pairs(buckets), BLOCKS_DDL), "pairs")
    discard(chunks, words)
    known = answered(pairs, PAIRS)
    triples = kept(_with_records(pairs, known, _ask_triples(buckets, most)), "triples")
    discard(pairs, known)
    known = answered(triples, TRIPLES)
    found = _with_records(triples, known, _send_found(buckets, most))
    found = kept(found.groupBy("bucket").applyInArrow(_sum_found(least, most), PHRASES_DDL), "phrases")
    discard(triples, known)
    return found


def scored_phrases(docs: DataFrame, least: int = LEAST, most: int = MOST_WORDS) -> DataFrame:
    """(lang, phrase, a, l, r, n, score, cut) of all phrases that are not inside an equally frequent one.

    `a` counts the phrase, `n` the language's words, `l` and `r` the parts before and after the cut that scores lowest.
    """
    counts = phrase_counts(docs, least, most)
    totals = counts.filter(F.col("n_words") == 0).select("lang", F.col("n").alias("total"))
    parts = counts.filter((F.col("n_words") > 0) & (F.col("n_words") < most)).select("lang", "phrase", "n")
    parts = broadcast_if_small(parts, PARTS_BYTES)
    words = F.split("phrase", " ")
    cuts = counts.filter((F.col("n_words") > 1) & ~F.col("inside")).select(
        "lang", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("cut")
    ).select(
        "*",
        F.concat_ws(" ", F.slice(words, F.lit(1), F.col("cut"))).alias("first"),
        F.concat_ws(" ", F.slice(words, F.col("cut") + 1, F.size(words))).alias("rest"),
    )
    for part, name in (("first", "l"), ("rest", "r")):
        of = parts.select("lang", F.col("phrase").alias(part), F.col("n").alias(name))
        cuts = cuts.join(of, ["lang", part])
    # One row per language.
    cuts = cuts.join(F.broadcast(totals), "lang")
    lowest = cuts.groupBy("lang", "phrase").agg(
        F.min(F.struct(F.expr(SCORE).alias("score"), "cut", "l", "r", "a", F.col("total").alias("n"))).alias("kept")
    )
    return lowest.select("lang", "phrase", *[F.col("kept")[c].alias(c) for c in ("a", "l", "r", "n", "score", "cut")])


def top_phrases(scored: DataFrame, reported: int = REPORTED) -> DataFrame:
    """The first phrases of each language, ranked from 1. Most are left out in `SALTS` parts of a language already."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    parts = Window.partitionBy("lang", salt).orderBy(*order)
    first = scored.withColumn("rank", F.row_number().over(parts)).filter(F.col("rank") <= reported)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= reported)


def q_phrases(spark, sf_dir: str) -> DataFrame:
    ranked = top_phrases(scored_phrases(table(spark, sf_dir, "documents")))
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def phrases_sql(least: int = LEAST, most: int = MOST_WORDS, reported: int = REPORTED) -> str:
    """The same by counting the strings of all phrases, and by looking for each in all longer ones."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
with piece as (
    select lang, regexp_extract_all(piece, '[^ \\t]+') as words
    from (select coalesce(lang, 'und') as lang,
                 unnest(string_split_regex(translate(text, '{upper}', '{upper.lower()}'), '[.,;:!?\\n\\x0B\\x0C\\r]')) as piece
          from documents where text is not null)
), place as (
    select lang, words, unnest(range(1, len(words) + 1)) as start from piece
), total as (
    select lang, count(*) as n from place group by lang
), counted as (
    select lang, phrase, k, count(*) as a
    from (select lang, k, array_to_string(words[start:start + k - 1], ' ') as phrase
          from place, range(1, {most + 1}) t(k) where start + k - 1 <= len(words))
    group by all having count(*) >= {least}
), candidate as (
    select * from counted c where k > 1 and not exists (
        select 1 from counted b where b.lang = c.lang and b.k > c.k and b.a >= c.a
        and contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' '))
), cut as (
    select lang, phrase, a, cut, array_to_string(words[1:cut], ' ') as first, array_to_string(words[cut + 1:], ' ') as rest
    from (select lang, phrase, a, string_split(phrase, ' ') as words, unnest(range(1, k)) as cut from candidate)
), scored as (
    select cut.lang, cut.phrase, cut.a, l.a as l, r.a as r, n, cut,
           ((1000::hugeint * cut.a * n) // (l.a::hugeint * r.a))::bigint as score
    from cut join counted l on l.lang = cut.lang and l.phrase = first join counted r on r.lang = cut.lang and r.phrase = rest
    join total on total.lang = cut.lang
), lowest as (
    select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from lowest qualify rank <= {reported}
"""
