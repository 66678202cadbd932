"""Language of texts by a bidirectional gated recurrent network over bytes, in numpy.

A text's words are read byte by byte from both sides, and every byte position gets a probability of each
language; a document's probabilities are the means over all its positions. Words are separated by ASCII white
space and longer ones are read in pieces of `PIECE` bytes; as the network starts anew at each piece, each
distinct piece of a group of rows runs once and counts as often as it occurs. Pieces of one length run
together, without padding.

The network is trained by backpropagation through time on a bounded sample of labelled documents
(`sample_docs`, in the order of a hash of the id): every position of a document should say the document's
language. Languages weigh the same, however many documents they have.

Defined cases: null text, empty text and text without a letter (by its Unicode category) is `und` with score 0; so is every text if no
document is labelled; null labels are not learnt from; ties go to the first language in sorted order; repeated
rows and ids are predicted on their own; other columns are not read; a very long text is read whole, as a group
of its own.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyshelf.llm.common import numbered, numbering, sample_by_hash, split_of, table, text_groups

PIECE = 20
GROUP_BYTES = 6 << 20


@dataclass
class Network:
    """Weights by name; for each direction: byte table x, recurrent u, bias of the candidate's recurrent part b."""

    languages: list[str]
    weights: dict[str, np.ndarray]

    def probabilities(self, pieces: np.ndarray) -> np.ndarray:
        """[piece, position, language] for byte pieces of one length."""
        states = np.concatenate([_run(pieces, self.weights, d)[0] for d in "fb"], axis=2)
        logits = states @ self.weights["o"] + self.weights["ob"]
        logits -= logits.max(axis=2, keepdims=True)
        np.exp(logits, out=logits)
        return logits / logits.sum(axis=2, keepdims=True)


def _new_weights(hidden: int, languages: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    out = {"o": normal(2 * hidden, languages, scale=0.2), "ob": np.zeros(languages, np.float32)}
    for d in "fb":
        out[f"{d}x"] = normal(256, 3 * hidden, scale=0.4)
        out[f"{d}u"] = normal(hidden, 3 * hidden, scale=hidden**-0.5)
        out[f"{d}b"] = np.zeros(hidden, np.float32)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(pieces: np.ndarray, w: dict[str, np.ndarray], d: str) -> tuple[np.ndarray, list]:
    """States [piece, position, hidden] of one direction, and what the way back needs."""
    n, length = pieces.shape
    size = w[f"{d}b"].shape[0]
    h = np.zeros((n, size), np.float32)
    states = np.empty((n, length, size), np.float32)
    steps = []
    for t in range(length) if d == "f" else range(length - 1, -1, -1):
        x = w[f"{d}x"][pieces[:, t]]
        hu = h @ w[f"{d}u"]
        gates = _sigmoid(x[:, : 2 * size] + hu[:, : 2 * size])
        z, r = gates[:, :size], gates[:, size:]
        inner = hu[:, 2 * size :] + w[f"{d}b"]
        c = np.tanh(x[:, 2 * size :] + r * inner)
        steps.append((t, h, z, r, inner, c))
        h = c + z * (h - c)
        states[:, t] = h
    return states, steps


def _back(pieces: np.ndarray, w: dict[str, np.ndarray], d: str, steps: list, slope: np.ndarray, out: dict) -> None:
    """Gradients of one direction from the slopes of its states."""
    size = w[f"{d}b"].shape[0]
    dx, du, db = (np.zeros_like(w[f"{d}{k}"]) for k in "xub")
    later = np.zeros((len(pieces), size), np.float32)
    for t, h, z, r, inner, c in reversed(steps):
        dh = slope[:, t] + later
        dc = dh * (1 - z) * (1 - c * c)
        dz = dh * (h - c) * z * (1 - z)
        dr = dc * inner * r * (1 - r)
        di = dc * r
        by_x = np.concatenate([dz, dr, dc], axis=1)
        by_h = np.concatenate([dz, dr, di], axis=1)
        np.add.at(dx, pieces[:, t], by_x)
        du += h.T @ by_h
        db += di.sum(axis=0)
        later = dh * z + by_h @ w[f"{d}u"].T
    out[f"{d}x"], out[f"{d}u"], out[f"{d}b"] = dx, du, db


def gradients(pieces: np.ndarray, labels: np.ndarray, w: dict[str, np.ndarray]) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross entropy over all positions, and its gradients, for pieces of one length."""
    n, length = pieces.shape
    runs = {d: _run(pieces, w, d) for d in "fb"}
    states = np.concatenate([runs[d][0] for d in "fb"], axis=2)
    logits = states @ w["o"] + w["ob"]
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    rows = np.arange(n)
    loss = -np.log(p[rows, :, labels] + 1e-12).mean()
    p[rows, :, labels] -= 1
    p /= n * length
    out = {"o": np.einsum("nth,ntk->hk", states, p), "ob": p.sum(axis=(0, 1))}
    slope = p @ w["o"].T
    size = slope.shape[2] // 2
    _back(pieces, w, "f", runs["f"][1], slope[:, :, :size], out)
    _back(pieces, w, "b", runs["b"][1], slope[:, :, size:], out)
    return float(loss), out


def cut(word: bytes) -> list[bytes]:
    return [word[k : k + PIECE] for k in range(0, len(word), PIECE)]


def train(
    rows: list[tuple[str, str]], hidden: int = 12, steps: int = 1500, batch: int = 256, rate: float = 0.01, seed: int = 7
) -> Network | None:
    """A network for (text, language) rows; None without rows."""
    counts = Counter()
    for text, language in rows:
        for word, n in Counter(text.encode().split()).items():
            for piece in cut(word):
                counts[piece, language] += n
    if not counts:
        return None
    languages = sorted({language for _, language in counts})
    place = {language: k for k, language in enumerate(languages)}
    totals = Counter()
    for (_, language), n in counts.items():
        totals[language] += n
    by_length: dict[int, list[tuple[bytes, int, float]]] = {}
    for (piece, language), n in sorted(counts.items()):
        by_length.setdefault(len(piece), []).append((piece, place[language], n / totals[language]))
    pools = []
    for length, pool in by_length.items():
        pieces = np.frombuffer(b"".join(p for p, _, _ in pool), np.uint8).reshape(-1, length)
        share = np.array([s for _, _, s in pool])
        pools.append((pieces, np.array([k for _, k, _ in pool]), np.cumsum(share) / share.sum(), share.sum() * length))
    pick = np.array([p[3] for p in pools])
    pick /= pick.sum()
    rng = np.random.default_rng(seed)
    w = _new_weights(hidden, len(languages), seed)
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    for step in range(1, steps + 1):
        pieces, labels, ends, _ = pools[rng.choice(len(pools), p=pick)]
        chosen = np.searchsorted(ends, rng.random(batch)).clip(max=len(labels) - 1)
        _, slopes = gradients(pieces[chosen], labels[chosen], w)
        now = rate * min(1.0, 1.5 * (1 - step / (steps + 1)))
        for name, slope in slopes.items():
            first[name] += 0.1 * (slope - first[name])
            second[name] += 0.01 * (slope * slope - second[name])
            w[name] -= (now * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return Network(languages, w)


def pooled(texts: list[str], net: Network, slab: int = 1 << 14) -> np.ndarray:
    """Mean probabilities over all byte positions of each text's words; zeros for a text without words."""
    numbers = numbering()
    rows = [numbered(numbers, t.encode().split()) for t in texts]
    parts: dict[int, tuple[list[bytes], list[int]]] = {}
    for word, number in numbers.items():
        for piece in cut(word) if len(word) > PIECE else (word,):
            of_length = parts.setdefault(len(piece), ([], []))
            of_length[0].append(piece)
            of_length[1].append(number)
    sums = np.zeros((len(numbers), len(net.languages)))
    sizes = np.fromiter(map(len, numbers), np.int64, len(numbers))
    for length, (pieces, owners) in parts.items():
        for at in range(0, len(pieces), slab):
            some = np.frombuffer(b"".join(pieces[at : at + slab]), np.uint8).reshape(-1, length)
            np.add.at(sums, owners[at : at + slab], net.probabilities(some).sum(axis=1))
    out = np.zeros((len(texts), len(net.languages)))
    for k, row in enumerate(rows):
        if len(row):
            out[k] = sums[row].sum(axis=0) / sizes[row].sum()
    return out


GUESSES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def _guesser(net: Network | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in text_groups(batches, GROUP_BYTES):
            texts = group["text"].to_pylist()
            names, scores = ["und"] * len(texts), [0.0] * len(texts)
            if net is not None:
                for k, (text, p) in enumerate(zip(texts, pooled(texts, net), strict=True)):
                    if any(map(str.isalpha, text)):
                        names[k], scores[k] = net.languages[int(p.argmax())], min(1.0, float(p.max()))
            yield pa.RecordBatch.from_arrays(
                [group["doc_id"].combine_chunks(), group["held_out"].combine_chunks(), pa.array(names), pa.array(scores, pa.float64())],
                schema=GUESSES,
            )

    return run


def training_rows(docs: DataFrame, learn: Column, sample_docs: int) -> list[tuple[str, str]]:
    rows = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    return [(r["text"], r["lang"]) for r in sample_by_hash(rows, "doc_id", sample_docs, "lang", "text").collect()]


def predict_language(docs: DataFrame, learn: Column | None = None, sample_docs: int = 1500) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; only rows where `learn` holds are learnt from."""
    docs = docs.select("doc_id", "text", "lang")
    learn = split_of("doc_id", 5) != 0 if learn is None else learn
    net = train(training_rows(docs, learn, sample_docs))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (~F.coalesce(learn, F.lit(False))).alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return rows.mapInArrow(_guesser(net), "doc_id long, held_out boolean, lang_pred string, score double")


def q_language(spark, sf_dir: str) -> DataFrame:
    return predict_language(table(spark, sf_dir, "documents"))
