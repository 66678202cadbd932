"""Language-model scores of texts by a hierarchical Pitman-Yor model, with seatings sampled by Gibbs.

The model has a restaurant for each context of one word (or the start of a text), and all share one parent
restaurant, whose base is uniform over the V training words and one more for any other. In a restaurant, each
occurrence of a word sits at a table of that word; each table is a customer of the parent. A word's seating in a
restaurant enters predictions only through its customers c and tables t:

    p(w | u) = (c_uw - d t_uw + (a + d T_u) p(w)) / (a + C_u),    p(w) alike with t as customers.

A Gibbs sweep takes each word of each restaurant in turn: its customers get up and sit down again one by one,
at a new table with odds (a + d T) p_parent(w) to (seated - d t), given the tables of the other words and the
parent as they stand after the last sweep. Beyond ONE_BY_ONE customers they sit down in parties of a quarter of
those seated, whose odds are the first one's. Sweeps start with one table for each word, and after BURN_IN of
them the predictive probabilities of each are averaged. Discounts are estimated from the counts of ones and twos.

In Spark: chunks of documents, stored as numbers of their words, ask buckets for the training counts of their words
and word pairs; one of the chunks that have learnt a pair owns it. Only owned pairs with two customers or more are
seated anew (one customer has one table), in blocks of their own, which ask the buckets of words for T and the parent's state and send back how
many tables were added. Random numbers are hashes of pair, sweep and customer, so every chunk finds a pair's
tables again without being told, and a task that is run again gives the same. The number of jobs depends on the
number of sweeps alone, and all that is shuffled grows with the corpus.

Defined cases: null and empty text has no words and one token, its end; words are what stands between ASCII
white space, with A-Z in lower case; documents with a null id are learnt from; with no training documents every
token has the base's probability 1; repeated rows and ids are scored and learnt from as often as they come;
other columns are not read; very long texts are scored whole, as a chunk of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyshelf.llm.chunks import (
    BLOCKS,
    BLOCKS_DDL,
    NO_ID,
    Chunk,
    answer,
    ask,
    bucket_count,
    gather,
    range_bucket,
    serve,
    sums_of,
    to_chunks,
    update,
    with_answers,
)
from tallyshelf.llm.common import (
    id_and_text,
    mix,
    numbered,
    numbering,
    pack,
    pack_sorted,
    release,
    split_of,
    stored,
    table,
    unpack,
    unpack_sorted,
)

SWEEPS = 3
BURN_IN = 1
STRENGTH = 1.0
CHUNK_BYTES = 12 << 20
ONE_BY_ONE = 64
PAIR_BITS = 56
END = np.uint64(0x243F6A8885A308D3)


def text_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each distinct word."""
    if not words:
        return np.empty(0, np.uint64)
    joined = np.frombuffer(b" ".join(words) + b" ", np.uint8).astype(np.uint64)
    ends = np.flatnonzero(joined == 32)
    sizes = np.diff(ends, prepend=-1)
    first = ends - sizes + 1
    place = (np.arange(len(joined)) - np.repeat(first, sizes)).astype(np.uint64)
    return mix(np.add.reduceat(mix(joined + (place << np.uint64(8))), first))


def numbered_words(texts: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of each text; word numbers in a row, each text's end included; and hashes of the distinct words."""
    numbers = numbering()
    numbers[b" "]
    rows = []
    end = np.zeros(1, np.int64)
    for text in texts:
        words = text.lower().split()
        rows += [numbered(numbers, words), end]
    sizes = np.array([len(r) + 1 for r in rows[::2]], np.int64)
    words = np.concatenate(rows) if rows else np.empty(0, np.int64)
    del numbers[b" "]
    del rows
    # Numbers of tokens are kept in four bytes where they fit, as they are the longest arrays of all.
    number = np.int32 if len(words) < 1 << 31 else np.int64
    return sizes, words.astype(number), np.concatenate([[END], text_hashes(list(numbers))])


def packed_words(texts: list[bytes]) -> bytes:
    """Sizes, words and hashes of `numbered_words`; a word that is first seen is 0 and others their number plus 1."""
    sizes, words, hashes = numbered_words(texts)
    new = np.diff(np.maximum.accumulate(words), prepend=0) > 0
    return pack(sizes, np.where(new, 0, words + 1).astype(words.dtype), hashes)


def words_of_texts(chunk: Chunk) -> tuple[np.ndarray, ...]:
    return numbered_words(chunk.texts())


def stored_words(chunk: Chunk) -> tuple[np.ndarray, ...]:
    """The words of a chunk that was stored by `packed_words`."""
    sizes, words, hashes = unpack(chunk.data)
    new = words == 0
    return sizes, np.where(new, np.cumsum(new, dtype=words.dtype), words - 1), hashes


def distinct_codes(codes: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes, all below `bound`, and each code's place among them."""
    bits = len(codes).bit_length()
    if bound.bit_length() + bits > 63:
        return np.unique(codes, return_inverse=True)
    # Codes are sorted with their places in their low bits, so that nothing is looked up in their order.
    both = codes << bits
    both |= np.arange(len(codes))
    both.sort()
    at = both & ((1 << bits) - 1)
    both >>= bits
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    place = np.empty(len(both), np.int32 if len(codes) < 1 << 31 else np.int64)
    place[at] = np.cumsum(new, dtype=place.dtype) - 1
    return both[new], place


class Tokens:
    """A chunk's tokens: word numbers in a row, each text's end included, its distinct words and word pairs.

    Number 0 is the end of a text, which is also what the first token of a text follows.
    """

    def __init__(self, chunk: Chunk, read: Callable[[Chunk], tuple[np.ndarray, ...]] = words_of_texts) -> None:
        self.sizes, self.words, self.hashes = read(chunk)
        learnt = np.repeat(chunk.flags > 0, self.sizes)
        self.word_counts = np.bincount(self.words[learnt], minlength=len(self.hashes))
        codes = self.words.astype(np.int64)
        codes[1:] += self.words[:-1] * np.int64(len(self.hashes))
        codes, pair = distinct_codes(codes, len(self.hashes) ** 2)
        self.pair = pair.astype(self.words.dtype, copy=False)
        del pair
        self.pair_counts = np.bincount(self.pair[learnt], minlength=len(codes))
        self.left, self.right = np.divmod(codes, len(self.hashes))
        self.pair_keys = pair_key(self.hashes[self.left], self.hashes[self.right])


def pair_key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(mix(left) * np.uint64(3) + right) >> np.uint64(64 - PAIR_BITS)


def in_buckets(keys: np.ndarray, bits: int, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places of the keys of each bucket that has any, in the order of the keys."""
    order = np.argsort(keys)
    of = range_bucket(keys[order], bits, buckets)
    edges = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]])) if len(of) else np.zeros(1, int)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield int(of[a]), order[a:b]


def _unique_keys(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys and the sums of their values; and each key's place among them."""
    distinct, place = np.unique(keys, return_inverse=True)
    return distinct, *(np.bincount(place, v, len(distinct)).astype(np.int64) for v in values), place


# Words and pairs are asked for in the same pass; pairs have the buckets after those of words.


def _ask_counts(buckets: int):
    def question(chunk: Chunk) -> Iterator[tuple[int, bytes]]:
        t = Tokens(chunk, stored_words)
        for bucket, some in in_buckets(t.hashes, 64, buckets):
            yield bucket, pack(pack_sorted(t.hashes[some]), t.word_counts[some].astype(np.uint32))
        # Pairs whose hashes are equal are one to the bucket, which adds them up.
        for bucket, some in in_buckets(t.pair_keys, PAIR_BITS, buckets):
            yield buckets + bucket, pack(pack_sorted(t.pair_keys[some]), t.pair_counts[some].astype(np.uint32))

    return question


def _add_up(blocks: list[bytes]) -> list[bytes]:
    """For each block's keys: the sum over all blocks, and a bit that just one that has counted it gets: it owns it."""
    keys, counts = zip(*((unpack_sorted(g), c) for g, c in map(unpack, blocks)), strict=True)
    sizes = np.cumsum([len(k) for k in keys])
    whole, n = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    order = np.argsort(whole)
    new = np.concatenate([[True], whole[order[1:]] != whole[order[:-1]]])
    group = np.cumsum(new) - 1
    seen = n[order] > 0
    # Of those that have counted the key, the first in this order.
    at = np.where(seen, np.arange(len(order)), len(order))
    first = np.minimum.reduceat(at, np.flatnonzero(new))
    owner, total = np.zeros(len(whole), bool), np.empty(len(whole), np.int64)
    owner[order[first[first < len(order)]]] = True
    total[order] = np.bincount(group, n[order])[group].astype(np.int64)
    return [
        pack(t.astype(np.uint32 if t.max(initial=0) < 1 << 32 else np.uint64), np.packbits(o))
        for t, o in zip(np.split(total, sizes[:-1]), np.split(owner, sizes[:-1]), strict=True)
    ]


class Counted:
    """Training counts of a chunk's words and pairs, and which pairs are its own, from the buckets' answers."""

    def __init__(self, t: Tokens, got: dict[int, bytes], buckets: int) -> None:
        self.word = np.zeros(len(t.hashes), np.int64)
        self.word_owner = np.zeros(len(t.hashes), bool)
        for bucket, some in in_buckets(t.hashes, 64, buckets):
            total, bits = unpack(got[bucket])
            self.word[some] = total
            self.word_owner[some] = np.unpackbits(bits, count=len(some)).astype(bool)
        self.pair = np.zeros(len(t.pair_keys), np.int64)
        self.own = np.zeros(len(t.pair_keys), bool)
        for bucket, some in in_buckets(t.pair_keys, PAIR_BITS, buckets):
            total, bits = unpack(got[buckets + bucket])
            self.pair[some] = total
            self.own[some] = np.unpackbits(bits, count=len(some)).astype(bool)


WORDS_KIND, PAIRS_KIND, SUMS_KIND, ASKED_KIND = 0, 1, 2, 3


def _first_seating(buckets: int):
    """Blocks with one table for each owned pair: for words' buckets (tables as context and as word), and the pairs
    with more customers, in a block of their own; what the chunk will ask words' buckets; and sums for the driver."""

    def use(number: int, chunk: Chunk, got: dict[int, dict[int, bytes]]) -> pa.Table:
        t = Tokens(chunk, stored_words)
        c = Counted(t, got[0], buckets)
        own = np.flatnonzero(c.own)
        tables = np.bincount(t.left[own], minlength=len(t.hashes))
        customers = np.bincount(t.right[own], minlength=len(t.hashes))
        rows = []
        named = np.flatnonzero((tables > 0) | (customers > 0) | c.word_owner)
        for bucket, some in in_buckets(t.hashes[named], 64, buckets):
            k = named[some]
            rows.append((number, bucket, WORDS_KIND, pack(pack_sorted(t.hashes[k]), tables[k].astype(np.uint32), customers[k].astype(np.uint32))))
        for bucket, some in in_buckets(t.hashes, 64, buckets):
            rows.append((number, bucket, ASKED_KIND, pack(pack_sorted(t.hashes[some]))))
        several = own[c.pair[own] > 1]
        rows.append((number, -1, PAIRS_KIND, pack(t.hashes[t.left[several]], t.hashes[t.right[several]], c.pair[several])))
        sums = [
            float(t.word_counts.sum()),
            float((c.word_owner & (c.word > 0)).sum()),
            float((c.pair[own] == 1).sum()),
            float((c.pair[own] == 2).sum()),
        ]
        rows.append((number, -1, SUMS_KIND, pack(np.array(sums))))
        columns = list(zip(*rows, strict=True))
        return pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip(columns, BLOCKS, strict=True)], schema=BLOCKS)

    return use


# The state of a bucket of words: sorted keys, and for each sweep T (tables as context), N (customers in the
# parent), S (tables in the parent). Sweep 0 is the first seating.


def uniform(keys: np.ndarray, sweep: int, customer: int) -> np.ndarray:
    salt = mix(np.array([sweep * 1_000_003 + customer], np.uint64))[0]
    return (mix(keys ^ salt) >> np.uint64(11)).astype(np.float64) * 2.0**-53


def seat(keys: np.ndarray, customers: np.ndarray, others: np.ndarray, parent: np.ndarray, strength: float, discount: float, sweep: int) -> np.ndarray:
    """Tables of each dish after its customers sit down again; others: tables of other dishes in its restaurant."""
    order = np.argsort(-customers, kind="stable")
    c = customers[order]
    keys, others, parent = keys[order], others[order], parent[order]
    tables = np.minimum(c, 1).astype(np.float64)
    seated = 1
    n = int(np.searchsorted(-c, -seated, side="left"))
    while n:
        party = 1 if seated < ONE_BY_ONE else seated // 4
        size = np.minimum(c[:n] - seated, party)
        t = tables[:n]
        new = (strength + discount * (others[:n] + t)) * parent[:n]
        p = new / (new + seated - discount * t)
        u = uniform(keys[:n], sweep, seated)
        tables[:n] += (u < p) if party == 1 else np.minimum(np.floor(size * p + u), size)
        seated += party
        n = int(np.searchsorted(-c, -seated, side="left"))
    out = np.empty(len(c), np.int64)
    out[order] = tables.astype(np.int64)
    return out


def _new_state(strength: float, base: float):
    def merge(blocks: list[bytes]) -> tuple[bytes, list[float]]:
        parts = [unpack(b) for b in blocks]
        keys, tables, customers, _ = _unique_keys(
            np.concatenate([unpack_sorted(p[0]) for p in parts]),
            np.concatenate([p[1] for p in parts]),
            np.concatenate([p[2] for p in parts]),
        )
        at_parent = np.minimum(customers, 1)
        sums = [float(customers.sum()), float(at_parent.sum()), float((customers == 1).sum()), float((customers == 2).sum())]
        return pack(pack_sorted(keys), tables, customers, at_parent), sums

    return merge


def _next_state(sweep: int, strength: float, discount: float, base: float, parent_tables: float):
    def merge(state: bytes, blocks: list[bytes]) -> tuple[bytes, list[float]]:
        gaps, *columns = unpack(state)
        keys = unpack_sorted(gaps)
        tables, customers = columns[-3].copy(), columns[-2].copy()
        for block in blocks:
            asked, more_tables, more_customers = unpack(block)
            at = np.searchsorted(keys, unpack_sorted(asked))
            tables[at] += more_tables
            customers[at] += more_customers
        last = columns[-1]
        others = parent_tables - last
        at_parent = seat(keys, customers, others, np.full(len(keys), base), strength, discount, sweep)
        return pack(gaps, *columns, tables, customers, at_parent), [float(customers.sum()), float(at_parent.sum())]

    return merge


def _look_up(state: bytes | None, block: bytes) -> bytes:
    """The state's columns for the keys asked; zero where it doesn't have one."""
    asked = unpack_sorted(unpack(block)[0])
    if state is None:
        return pack()
    gaps, *columns = unpack(state)
    keys = unpack_sorted(gaps)
    at = np.searchsorted(keys, asked).clip(max=len(keys) - 1)
    known = keys[at] == asked
    found = [np.where(known, c[at], 0) for c in columns]
    # Sweeps mostly change little: later ones are sent as differences.
    return pack(*[c.astype(np.int32) if k < 3 else (c - found[k - 3]).astype(np.int32) for k, c in enumerate(found)])


def state_columns(hashes: np.ndarray, got: dict[int, bytes], buckets: int, sweeps: int) -> np.ndarray:
    """[3 * sweeps, word]: T, N, S of each sweep."""
    out = np.zeros((3 * sweeps, len(hashes)), np.int64)
    for bucket, some in in_buckets(hashes, 64, buckets):
        for k, column in enumerate(unpack(got[bucket])):
            out[k, some] = column
    for k in range(3, 3 * sweeps):
        out[k] += out[k - 3]
    return out


class Model:
    """Constants of the model, and the parent's customers and tables after each sweep."""

    def __init__(self, n_tokens: float, n_words: float, discount: float, parent_discount: float, strength: float) -> None:
        self.n_tokens, self.n_words = n_tokens, n_words
        self.discount, self.parent_discount, self.strength = discount, parent_discount, strength
        self.base = 1.0 / (n_words + 1)
        self.parents: list[tuple[float, float]] = []

    def parent_p(self, columns: np.ndarray, sweep: int) -> np.ndarray:
        """p(w) of words with the columns of the state."""
        customers, tables = self.parents[sweep]
        n, s = columns[3 * sweep + 1], columns[3 * sweep + 2]
        new = (self.strength + self.parent_discount * tables) * self.base
        return (n - self.parent_discount * s + new) / (self.strength + customers)

    def tables(self, keys, customers, left, right, columns: np.ndarray, sweeps: int) -> Iterator[np.ndarray]:
        """Tables of pairs with customers after each sweep from 0; left and right are places in the columns."""
        t = np.minimum(customers, 1)
        yield t
        several = np.flatnonzero(customers > 1)
        for sweep in range(1, sweeps):
            p = self.parent_p(columns, sweep - 1)[right[several]]
            others = columns[3 * (sweep - 1)][left[several]] - t[several]
            t = t.copy()
            t[several] = seat(keys[several], customers[several], others, p, self.strength, self.discount, sweep)
            yield t


def _pair_words(buckets: int, data: bytes):
    """An owned-pairs block: its words' sorted keys, pairs' places among them, pair keys and customers."""
    left, right, customers = unpack(data)
    words, place = np.unique(np.concatenate([left, right]), return_inverse=True)
    return words, place[: len(left)], place[len(left) :], pair_key(left, right), customers


def _ask_words(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = _pair_words(buckets, row["data"])[0]
                blocks = [(b, pack(pack_sorted(words[some]))) for b, some in in_buckets(words, 64, buckets)]
                n = len(blocks)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["chunk"]] * n, pa.int64()),
                        pa.array([b for b, _ in blocks], pa.int64()),
                        pa.array([0] * n, pa.int32()),
                        pa.array([d for _, d in blocks], pa.binary()),
                    ],
                    schema=BLOCKS,
                )

    return run


def _seat_pairs(model: Model, buckets: int, sweep: int):
    """Tables that a sweep adds or takes away, for the words' buckets."""

    def run(mine: pa.Table, answers: pa.Table) -> pa.Table:
        row = mine.to_pylist()[0]
        words, left, right, keys, customers = _pair_words(buckets, row["data"])
        got = dict(zip(answers["bucket"].to_pylist(), answers["data"].to_pylist(), strict=True))
        columns = state_columns(words, got, buckets, sweep)
        *_, before, now = model.tables(keys, customers, left, right, columns, sweep + 1)
        change = now - before
        tables = np.bincount(left, change, len(words)).astype(np.int64)
        arrived = np.bincount(right, change, len(words)).astype(np.int64)
        rows = []
        moved = np.flatnonzero((tables != 0) | (arrived != 0))
        for bucket, some in in_buckets(words[moved], 64, buckets):
            k = moved[some]
            rows.append((row["chunk"], bucket, 0, pack(pack_sorted(words[k]), tables[k], arrived[k])))
        columns = list(zip(*rows, strict=True)) or [[] for _ in BLOCKS]
        return pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip(columns, BLOCKS, strict=True)], schema=BLOCKS)

    return run


SCORES = pa.schema([
    ("doc_id", pa.int64()),
    ("held_out", pa.bool_()),
    ("n_tokens", pa.int64()),
    ("n_known", pa.int64()),
    ("train_tokens", pa.int64()),
    ("base_score", pa.float64()),
    ("score", pa.float64()),
    ("perplexity", pa.float64()),
])
SCORES_DDL = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
    "perplexity double"
)


def _scorer(model: Model, buckets: int, sweeps: int, burn_in: int):
    def use(number: int, chunk: Chunk, got: dict[int, dict[int, bytes]]) -> pa.Table:
        t = Tokens(chunk, stored_words)
        c = Counted(t, got[0], buckets)
        columns = state_columns(t.hashes, got[1], buckets, sweeps) if 1 in got else np.zeros((3 * sweeps, len(t.hashes)), np.int64)
        context = c.word[t.left]
        mean = np.zeros(len(t.pair_keys))
        for sweep, tables in enumerate(model.tables(t.pair_keys, c.pair, t.left, t.right, columns, sweeps)):
            if sweep < burn_in:
                continue
            p = model.parent_p(columns, sweep)[t.right]
            back = model.strength + model.discount * columns[3 * sweep][t.left]
            seen = np.maximum(c.pair - model.discount * tables, 0)
            mean += np.where(context > 0, (seen + back * p) / (model.strength + context), p) / (sweeps - burn_in)
        logs = np.log10(mean)[t.pair]
        base = np.log10((c.word + 1) / (model.n_tokens + model.n_words + 1))[t.words]
        heads = np.cumsum(t.sizes) - t.sizes
        score = np.add.reduceat(logs, heads)
        return pa.Table.from_arrays(
            [
                pa.array(chunk.ids, mask=chunk.ids == NO_ID),
                pa.array(chunk.flags == 0),
                pa.array(t.sizes),
                pa.array(np.add.reduceat((c.word[t.words] > 0).astype(np.int64), heads)),
                pa.array(np.full(len(heads), int(model.n_tokens))),
                pa.array(np.add.reduceat(base, heads)),
                pa.array(score),
                pa.array(10.0 ** np.minimum(-score / t.sizes, 300)),
            ],
            schema=SCORES,
        )

    return use


def _share(ones: float, twos: float) -> float:
    """A discount by the counts of ones and twos."""
    return float(np.clip(ones / (ones + 2 * twos), 0.1, 0.95)) if ones + twos > 0 else 0.5


def score_texts(
    docs: DataFrame,
    learn: Column | None = None,
    sweeps: int = SWEEPS,
    burn_in: int = BURN_IN,
    strength: float = STRENGTH,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Scores (log10) of every document under a model of those where `learn` holds."""
    spark = docs.sparkSession
    learn = F.coalesce(split_of("doc_id", 7), F.lit(-1)) != 2 if learn is None else learn
    rows = id_and_text(docs)
    # Texts are split into words once, and stored as their numbers.
    chunks = to_chunks(rows, learn.cast("int"), chunk_bytes, body=packed_words)
    buckets = bucket_count(chunks)
    counts = stored(answer(ask(chunks, _ask_counts(buckets)), _add_up, kind=0), "counts")
    release(spark)
    seated = stored(with_answers(chunks, counts, _first_seating(buckets), BLOCKS_DDL), "seating")
    release(spark)
    sums = np.zeros(4)
    for row in seated.filter(F.col("kind") == SUMS_KIND).select("data").toLocalIterator():
        sums += unpack(row["data"])[0]
    # Adding small sums chunk by chunk in the driver; the order of whole numbers doesn't matter.
    n_tokens, n_words, ones, twos = sums.tolist()
    base = 1.0 / (n_words + 1)
    state = stored(gather(seated.filter(F.col("kind") == WORDS_KIND), _new_state(strength, base)), "words")
    customers, tables, first_ones, first_twos = sums_of(state) or [0.0] * 4
    model = Model(n_tokens, n_words, _share(ones, twos), _share(first_ones, first_twos), strength)
    model.parents.append((customers, tables))
    pairs = seated.filter(F.col("kind") == PAIRS_KIND)
    asked = stored(pairs.mapInArrow(_ask_words(buckets), BLOCKS_DDL), "asked")
    for sweep in range(1, sweeps + 1):
        answers = serve(state, asked, _look_up, kind=0)
        changes = pairs.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
            _seat_pairs(model, buckets, sweep), BLOCKS_DDL
        )
        state = stored(
            update(state, changes, _next_state(sweep, strength, model.parent_discount, base, model.parents[-1][1])), "words"
        )
        model.parents.append(tuple(sums_of(state) or [0.0, 0.0]))
        release(spark)
    answers = serve(state, seated.filter(F.col("kind") == ASKED_KIND), _look_up, kind=1)
    return with_answers(chunks, counts.unionAll(answers), _scorer(model, buckets, sweeps + 1, burn_in + 1), SCORES_DDL)


def q_score(spark, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))
