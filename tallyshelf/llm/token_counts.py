"""Token counts of document sections: whole documents are encoded once, token spans joined to section spans.

A document is encoded as a whole, so that its tokens are those a training run would see. Token byte lengths,
summed up, give each token's character span. Sections are spans that cover the text from end to end; the
interval join is a search of every token's place in the sorted section starts. A token that crosses a
boundary is allotted by a rule:

- `first`: to the section that holds its first character (the default);
- `last`: to the section that holds its last character;
- `most`: to the section with most of its bytes, the earlier one of equals.

Whatever the rule, the counts of a document's sections add up to the document's count.

Defined cases: null and empty text is one empty section without tokens; a section that no token is allotted
to is still returned; repeated rows and ids are counted on their own; other columns are not read; a very
long text is encoded whole, by itself. Each task holds one group of rows at a time.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyshelf.llm.common import id_and_text, table, text_groups

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the vocabulary's published encoder cuts text before it merges bytes.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("first", "last", "most")
GROUP_BYTES = 4 << 20

COUNTS = pa.schema([
    ("doc_id", pa.int64()),
    ("section", pa.int32()),
    ("char_start", pa.int64()),
    ("char_end", pa.int64()),
    ("n_tokens", pa.int64()),
    ("n_crossing", pa.int64()),
    ("doc_tokens", pa.int64()),
])
COUNTS_DDL = (
    "doc_id long, section int, char_start long, char_end long, n_tokens long, n_crossing long, doc_tokens long"
)


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str):
    """The tiktoken encoding of a rank file, and the byte length of each token."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths


def line_starts(data: bytes) -> np.ndarray:
    """Byte places where lines start; a line break belongs to the line that it ends."""
    breaks = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    return np.concatenate([[0], breaks[breaks < len(data)]]).astype(np.int64)


def count_sections(lengths: np.ndarray, starts: np.ndarray, total: int, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens allotted to each section, and how many of these cross a boundary. All places are bytes."""
    ends = np.cumsum(lengths)
    begins = ends - lengths
    first = np.searchsorted(starts, begins, side="right") - 1
    last = np.searchsorted(starts, ends - 1, side="right") - 1
    chosen = first
    crossing = np.flatnonzero(first != last)
    if rule != "first" and len(crossing):
        chosen = first.copy()
        if rule == "last":
            chosen[crossing] = last[crossing]
        else:
            bounds = np.append(starts, total)
            for k in crossing:
                spans = np.arange(first[k], last[k] + 1)
                shares = np.minimum(bounds[spans + 1], ends[k]) - np.maximum(bounds[spans], begins[k])
                chosen[k] = spans[np.argmax(shares)]
    n = len(starts)
    return np.bincount(chosen, minlength=n), np.bincount(chosen[crossing], minlength=n)


def _counter(vocabulary: str, pattern: str, rule: str, sections: Callable[[bytes], np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, sizes = encoder(vocabulary, pattern)
        for group in text_groups(batches, GROUP_BYTES):
            out: list[list[np.ndarray]] = [[] for _ in COUNTS]
            for doc_id, text in zip(group["doc_id"].to_pylist(), group["text"].to_pylist(), strict=True):
                data = text.encode()
                lengths = sizes[np.array(encoding.encode_ordinary(text), dtype=np.int64)]
                starts = sections(data)
                tokens, crossing = count_sections(lengths, starts, len(data), rule)
                chars = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
                places = np.concatenate([[0], chars])[np.append(starts, len(data))]
                n = len(starts)
                ids = pa.array([doc_id], pa.int64()).take(pa.array(np.zeros(n, np.int64)))
                for column, values in zip(
                    out,
                    (ids, np.arange(n), places[:-1], places[1:], tokens, crossing, np.full(n, len(lengths))),
                    strict=True,
                ):
                    column.append(values)
            columns = [pa.concat_arrays(out[0])]
            columns += [pa.array(np.concatenate(c), f.type) for c, f in zip(out[1:], list(COUNTS)[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=COUNTS)

    return run


def section_token_counts(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    pattern: str = PATTERN,
    rule: str = "first",
    sections: Callable[[bytes], np.ndarray] = line_starts,
) -> DataFrame:
    """One row per section of each document, by default its lines.

    `sections` gives the sorted byte places at which a text's sections start; the first must be 0, and each
    must be the start of a character. `vocabulary` is a rank file that every executor has.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    return id_and_text(docs).mapInArrow(_counter(vocabulary, pattern, rule, sections), COUNTS_DDL)


def q_token_counts(spark, sf_dir: str) -> DataFrame:
    return section_token_counts(table(spark, sf_dir, "documents"))
