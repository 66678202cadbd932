"""Phrase counts and scores against SQL and against plain counting, and the transforms against their definition."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np

from tallyshelf.llm import phrases
from tests.llm.cases import DOCS, SF_DIR, duckdb_result, rows_of

SCHEMA = "doc_id int, text string, lang string, phrase string, n int, left_word string"


def frame(spark, rows):
    """With columns whose names the operator uses for itself."""
    return spark.createDataFrame([(k, t, lang, "p", 1, "l") for k, t, lang in rows], SCHEMA).repartition(3)


def by_hand(rows, least, most):
    """{(lang, phrase): (a, l, r, n, score, cut)} of all phrases that count."""
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            totals[lang] += len(words)
            for at in range(len(words)):
                for k in range(1, most + 1):
                    if at + k <= len(words):
                        counts[lang, words[at : at + k]] += 1
    inside = set()
    for (lang, words), n in counts.items():
        if n >= least:
            for i in range(len(words)):
                for j in range(i + 1, len(words) + 1):
                    if j - i < len(words) and n >= counts[lang, words[i:j]]:
                        inside.add((lang, words[i:j]))
    out = {}
    for (lang, words), a in counts.items():
        if a >= least and len(words) > 1 and (lang, words) not in inside:
            cuts = []
            for k in range(1, len(words)):
                left, right = counts[lang, words[:k]], counts[lang, words[k:]]
                cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
            score, cut, left, right = min(cuts)
            out[lang, " ".join(words)] = (a, left, right, totals[lang], score, cut)
    return out


def found(spark, rows, least, most=5):
    scored = phrases.scored_phrases(frame(spark, rows), least, most).collect()
    return {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score, r.cut) for r in scored}


def test_phrases_of_the_test_documents(spark):
    assert rows_of(phrases.q_phrases(spark, SF_DIR)) == duckdb_result(SF_DIR, phrases.phrases_sql())


def test_top_of_many_phrases(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    ranked = phrases.top_phrases(phrases.scored_phrases(docs, least=4), reported=50)
    wanted = duckdb_result(SF_DIR, phrases.phrases_sql(least=4, reported=50))
    assert rows_of(ranked.drop("cut")) == wanted and sum(wanted.values()) > 150


def test_odd_documents(spark, monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 3000)
    rows = [(k, t, None if k in (1, 7) else "en") for k, t in DOCS]
    rows += [(k, "a a a a a a. A b\tc  d e f, a b c d e f;\x01 z\x01 \x01", lang) for k, lang in enumerate(["fr", "fr", "en", None])]
    for least in (1, 2, 3):
        assert found(spark, rows, least) == by_hand(rows, least, 5)


def test_random_words_of_few_kinds(spark, monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 2000)
    rng = random.Random(2)
    rows = []
    for k in range(60):
        words = [rng.choice("aabbcdefgh") + rng.choice(["", "", ".", "\n"]) for _ in range(rng.randrange(0, 120))]
        rows.append((k, " ".join(words), rng.choice(["x", "y"])))
    rows += [(100 + k, "one long passage of words that many texts repeat as it is", "x") for k in range(30)]
    assert found(spark, rows, 6) == by_hand(rows, 6, 5)
    assert found(spark, rows, 6, 3) == by_hand(rows, 6, 3)


def test_no_documents(spark):
    assert phrases.scored_phrases(frame(spark, [(1, "a b", "en")]).limit(0)).collect() == []


def test_scores_beyond_64_bits(spark):
    row = spark.sql("select 'en' lang, 3000000000000000L a, 9000000000000000L total, 3000000000000000L l, 3000000000000000L r")
    assert row.selectExpr(f"{phrases.SCORE} s").first().s == 1000 * 9000000000000000 // 3000000000000000


def test_intervals_are_the_occurrences():
    rng = np.random.default_rng(4)
    for _ in range(50):
        text = np.concatenate([[0], rng.integers(0, 4, rng.integers(0, 80)), [0]])
        plain = [tuple(text[i : i + k].tolist()) for k in range(2, 6) for i in range(len(text) - k + 1)]
        counts = Counter(p for p in plain if 0 not in p)
        beside = defaultdict(lambda: (set(), set()))
        for i in range(1, len(text)):
            for k in range(2, 6):
                if i + k <= len(text) and 0 not in text[i : i + k]:
                    left, right = beside[tuple(text[i : i + k].tolist())]
                    left.add(int(text[i - 1]))
                    right.add(int(text[i + k]))
        seen = Counter()
        for length, places, n, left, right in phrases.phrases_of(text, 5):
            words = text[places[:, None] + np.arange(length)]
            for w, m, a, b in zip(map(tuple, words.tolist()), n.tolist(), left.tolist(), right.tolist()):
                seen[w] = m
                for value, values in zip((a, b), beside[w]):
                    assert value == (min(values) if len(values) == 1 else 0)
        assert seen == counts
