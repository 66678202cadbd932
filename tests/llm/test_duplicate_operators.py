"""Near-duplicates, decontamination, repeated passages, components and packed arrays."""

from __future__ import annotations

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyshelf.llm import common, decontaminate, order_minhash, repeats
from tallyshelf.llm.components import components
from tests.llm.cases import DOCS, SF_DIR, chunk_of, docs_frame


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


def classes_by_hand(rows, similarity=0.8):
    """Least id of each document's class, over all pairs."""
    words = [(t or "").encode().split() for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            same = (rows[i][1] or "") == (rows[j][1] or "")
            bound = int((1 - similarity) * max(len(words[i]), len(words[j])) + 1e-9)
            if same or (words[i] and words[j] and abs(len(words[i]) - len(words[j])) <= bound
                        and order_minhash.similar(words[i], words[j], similarity)):
                root[find(i)] = find(j)
    least = {}
    for k, (key, _) in enumerate(rows):
        ids = least.setdefault(find(k), [])
        if key is not None:
            ids.append(key)
    return Counter((key, min(least[find(k)], default=None)) for k, (key, _) in enumerate(rows))


# 3, near-duplicates


def test_banded_distance_is_the_edit_distance():
    rng = random.Random(1)
    for trial in range(1500):
        a = [rng.randrange(4) for _ in range(rng.randrange(0, 40))]
        b = list(a) if trial % 5 else [rng.randrange(4) for _ in range(rng.randrange(0, 40))]
        for _ in range(rng.randrange(0, 14)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(2)] = [rng.randrange(5)] * rng.randrange(2)
        limit, distance = rng.randrange(0, 20), edit_distance(a, b)
        found = order_minhash.banded_distance(np.array(a, int), np.array(b, int), limit)
        assert found == (distance if distance <= limit else None)


def test_classes_of_odd_documents(spark):
    words = [f"w{k}" for k in range(60)]
    near = [(20, " ".join(words)), (21, " ".join(words[:30] + ["new"] + words[31:])), (22, " ".join(words[3:])),
            (23, " ".join(reversed(words))), (24, " ".join(words[30:] + words[:30])), (25, "one two"), (26, "one two")]
    found = order_minhash.near_classes(docs_frame(spark, near)).collect()
    assert Counter((r.doc_id, r.class_id) for r in found) == classes_by_hand([*DOCS, *near])


def test_classes_of_the_test_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = order_minhash.near_classes(docs).collect()
    assert Counter((r.doc_id, r.class_id) for r in found) == classes_by_hand(rows)


def test_a_large_group_of_near_copies_is_one_class(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(10_000)}" for _ in range(120)]
    rows = []
    for k in range(400):
        text = list(base)
        for _ in range(3):
            text[rng.randrange(120)] = f"n{rng.randrange(10_000)}"
        rows.append((k, " ".join(text)))
    rows += [(1000 + k, " ".join(f"o{rng.randrange(10_000)}" for _ in range(120))) for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in order_minhash.near_classes(docs).collect()}
    assert {found[k] for k in range(400)} == {0} and all(found[1000 + k] == 1000 + k for k in range(100))


def test_a_star_of_copies_is_one_class(spark):
    """Each copy is similar to the original only; lone pairs share the sketches of a large bucket with them."""
    rng = random.Random(5)

    def edited(words, edits):
        words = list(words)
        for at in rng.sample(range(len(words)), edits):
            words[at] = f"n{rng.randrange(1_000_000)}"
        return words

    base = [f"w{rng.randrange(10_000)}" for _ in range(150)]
    texts = [base] + [edited(base, 18) for _ in range(300)]
    for _ in range(20):
        lone = base[:60] + [f"o{rng.randrange(1_000_000)}" for _ in range(90)]
        texts += [lone, edited(lone, 15)]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    assert sum(order_minhash.similar(texts[k], texts[k + 1], 0.8) for k in range(1, 300)) < 10
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # So many sketches that any two similar texts have one in common.
    found = order_minhash.near_classes(docs, sketches=96).collect()
    assert Counter((r.doc_id, r.class_id) for r in found) == classes_by_hand(rows)


def test_blocks_link_what_all_pairs_link(spark):
    """Verified inside the blocks, whatever their size, with fewer links than texts in a group."""
    rng = random.Random(11)
    texts = []
    for _ in range(30):
        base = [f"w{rng.randrange(300)}" for _ in range(40)]
        texts += [base] + [[*base[:at], f"n{rng.randrange(10**6)}", *base[at + 1 :]] for at in rng.sample(range(40), 3)]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("body", F.unhex(F.md5("text")))
    bodies = docs.select("body", F.col("doc_id").alias("rep"))
    # All texts have the first key, and every second one the other two, which have the same texts.
    keys = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit(5), F.lit(3), F.lit(4))).otherwise(F.array(F.lit(5)))
    buckets = docs.select("body", F.lit(40).cast("long").alias("n_words"), F.explode(keys.cast("array<long>")).alias("key"))
    wanted = classes_by_hand(rows)
    number = {r.body: r.doc_id for r in docs.collect()}
    for block, words in ((1, 1 << 18), (17, 1 << 18), (1000, 400), (1000, 1 << 18)):
        links = order_minhash.crossed(buckets, bodies, docs, None, 0.8, block, words)
        pairs = [(number[bytes(r.a)], number[bytes(r.b)]) for r in links.collect()]
        if block == 1000 and words == 1 << 18:
            # Classes have four texts, two of them also under the other key: the links of each key are a forest.
            assert len(pairs) <= 30 * (3 + 1)
        roots = {k: k for k, _ in rows}
        for a, b in pairs:
            assert order_minhash.similar(texts[a], texts[b], 0.8)
            one, two = sorted((roots[a], roots[b]))
            roots = {k: one if r == two else r for k, r in roots.items()}
        assert Counter(roots.items()) == wanted


def test_pairs_grow_with_the_bucket_and_not_with_its_square(spark):
    rows = spark.range(1000).select(F.lit(1).cast("long").alias("key"), F.sha2(F.col("id").cast("string"), 256).cast("binary").alias("body"))
    pairs = order_minhash.chained(rows, 16)
    assert 999 <= pairs.count() <= 1016
    assert components(pairs).groupBy("root").count().count() == 1


def test_no_documents(spark):
    empty = docs_frame(spark).limit(0)
    assert order_minhash.near_classes(empty).collect() == []
    assert repeats.remove_repeats(empty).collect() == []


def test_components_of_chains_stars_and_loops(spark):
    links = [(f"a{k:03}", f"a{k + 1:03}") for k in range(70)] + [("b0", f"b{k}") for k in range(1, 50)] + [("c", "c"), ("d", "e"), ("e", "d")]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert found == {f"a{k:03}": "a000" for k in range(71)} | {f"b{k}": "b0" for k in range(50)} | {"d": "d", "e": "d"}


# 9, decontamination


def test_best_run_is_the_nearest_of_all_runs():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = rng.integers(1, 4, rng.integers(1, 6)), rng.integers(1, 4, rng.integers(0, 8))
        distance, start, end = decontaminate.best_run(a, b)
        assert distance == min(edit_distance(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
        assert edit_distance(a, b[start:end]) == distance


def found_items(spark, docs, items):
    frames = (
        spark.createDataFrame([(k, t, 0) for k, t in rows], f"{name} long, text string, distance int")
        for rows, name in ((docs, "doc_id"), (items, "item_id"))
    )
    return decontaminate.find_items(*frames).collect()


def test_items_with_few_edits_are_found(spark):
    """Recall of random edits up to the bound, against the exact distance; and nothing else is found."""
    rng = random.Random(7)
    items = [(k, " ".join(f"i{k}x{rng.randrange(30)}" for _ in range(n))) for k, n in enumerate([1, 2, 3, 4, 5, 8, 12, 25, 40, 80])]
    docs, wanted = [], set()
    for number in range(200):
        key, text = items[number % len(items)]
        words = text.split()
        for _ in range(rng.randrange(0, decontaminate.allowed_edits(len(words)) + 3)):
            at = rng.randrange(len(words) + 1)
            words[at : at + rng.randrange(2)] = [f"z{rng.randrange(99)}"] * rng.randrange(2)
        around = [[f"o{rng.randrange(50)}" for _ in range(rng.randrange(0, 60))] for _ in range(2)]
        whole = around[0] + words + around[1]
        docs.append((number, " ".join(whole).upper() + " ..."))
        for item, original in items:
            row = original.split()
            numbers = {w: k for k, w in enumerate({*row, *whole})}
            nearest = decontaminate.best_run(np.array([numbers[w] for w in row]), np.array([numbers[w] for w in whole], int))[0]
            if nearest <= decontaminate.allowed_edits(len(row)):
                wanted.add((number, item, nearest))
    found = {(r.doc_id, r.item_id, r.distance) for r in found_items(spark, docs, items)}
    assert found <= wanted and len(found) >= 0.98 * len(wanted) > 50


def test_odd_documents_and_items(spark):
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = [(1, f"x {text} y"), (1, f"x {text} y"), (2, None), (None, f"Alpha, BETA gamma; delta epsilon zeta eta theta iota kappa!"),
            (3, ""), (4, text + " " + "long " * 5000 + text), (5, "alpha beta")]
    items = [(10, text), (10, text), (11, None), (12, ""), (13, "!!"), (14, "not there at all")]
    found = Counter((r.doc_id, r.item_id, r.distance, r.word_start, r.word_end) for r in found_items(spark, docs, items))
    assert found == Counter({(1, 10, 0, 1, 11): 4, (None, 10, 0, 0, 10): 2, (4, 10, 0, 0, 10): 2})
    assert found_items(spark, docs, items[2:5]) == [] and found_items(spark, [], items) == []


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "benchmark"))
    whole = Counter(map(tuple, decontaminate.find_items(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "ITEM_BLOCK", 7)
    assert Counter(map(tuple, decontaminate.find_items(docs, items).collect())) == whole
    texts = [(r.item_id, r.text) for r in items.collect()]
    held = {(d.doc_id, k) for d in docs.collect() for k, t in texts if d.text and t in d.text}
    assert held and held <= {(row[0], row[1]) for row in whole}


# 10, repeated passages


def kept_by_hand(rows, threshold):
    data = [(float("inf") if k is None else k, (t or "").encode(), k) for k, t in rows]
    first = {}
    for key, text, _ in data:
        for at in range(len(text) - threshold + 1):
            window = text[at : at + threshold]
            first[window] = min(first.get(window, key), key)
    out = Counter()
    for key, text, name in data:
        gone = bytearray(len(text))
        for at in range(len(text) - threshold + 1):
            if first[text[at : at + threshold]] < key:
                gone[at : at + threshold] = b"\1" * threshold
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        spans = len([s for s in bytes(gone).split(b"\0") if s])
        out[name, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def kept_by_spark(docs, **options):
    found = repeats.remove_repeats(docs, **options).collect()
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in found)


@pytest.mark.parametrize("chunk_bytes", [300, 1 << 20])
def test_odd_documents_keep_what_no_earlier_one_has(spark, chunk_bytes):
    assert kept_by_spark(docs_frame(spark), chunk_bytes=chunk_bytes) == kept_by_hand(DOCS, 50)


@pytest.mark.parametrize("threshold", [3, 8, 9, 50])
def test_random_documents_of_few_letters(spark, threshold):
    rng = random.Random(threshold)
    rows = [(rng.choice([*range(12), None]), "".join(rng.choice("abé") for _ in range(rng.randrange(0, 30)))) for _ in range(25)]
    rows += [(k, "abc" * 40 + "".join(rng.choice("xyz") for _ in range(60))) for k in range(30, 34)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert kept_by_spark(docs, threshold=threshold, chunk_bytes=100) == kept_by_hand(rows, threshold)


def test_test_documents_in_many_chunks(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert kept_by_spark(docs, chunk_bytes=30_000) == kept_by_hand([(r.doc_id, r.text) for r in docs.collect()], 50)


def test_kept_text_has_whole_characters(spark):
    line = "é" * 30
    docs = spark.createDataFrame([(1, "a" + line), (2, "bc" + line + "d")], "doc_id long, text string")
    found = {r.doc_id: r.kept_text for r in repeats.remove_repeats(docs).collect()}
    assert found == {1: "a" + line, 2: "bcd"}
    assert repeats.without("aéb".encode(), [2, 3]) == "ab"


def test_anchors_are_the_least_of_the_window():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 4, 300).astype(np.uint8)
    for threshold, anchor in ((50, 25), (9, 5), (3, 2), (8, 8), (5, 1)):
        found = repeats.anchors(data, threshold, anchor)
        assert len(found) == len(data) - threshold + 1
        windows = {}
        for at, key in enumerate(found.tolist()):
            assert windows.setdefault(data[at : at + threshold].tobytes(), key) == key


# Packed arrays


def test_packed_arrays_come_back():
    arrays = [np.arange(5), np.empty(0, np.uint8), np.array([1 << 63], np.uint64), np.array([1.5, -2.0])]
    for before, after in zip(arrays, common.unpack(common.pack(*arrays)), strict=True):
        assert before.dtype == after.dtype and before.tolist() == after.tolist()
    keys = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 100).astype(np.uint64))
    assert (common.unpack_sorted(common.pack_sorted(keys)) == keys).all()


def test_components_over_many_parts(spark, monkeypatch):
    from tallyshelf.llm import components as module

    monkeypatch.setattr(module, "LINKS_IN_A_PART", 7)
    links = [(f"a{k:03}", f"a{k + 1:03}") for k in range(100)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert set(found.values()) == {"a000"} and len(found) == 101


def test_the_mask_of_removed_bytes_is_small_beside_its_chunk():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 123, 20_000, dtype=np.uint8)) for _ in range(50)]
    chunk = chunk_of([*texts, *texts])
    keys = dict(repeats._ask_anchors(50, 25, 1)(chunk))
    bits = {0: repeats._shared_anchors([keys[0]])[0]}
    asked = repeats._ask_windows(50, 25, 1)(0, chunk, {0: bits})["data"].to_pylist()
    got = {0: bits, 1: {0: repeats._least_ids(50)(asked)[0]}}
    tracemalloc.start()
    gone = repeats.removed_bytes(chunk, got, 50, 25, 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert not gone[: len(gone) // 2].any() and gone[len(gone) // 2 :].all()
    assert peak < 30 * len(gone)


def test_what_many_chunks_have_alike_is_ordered_once(monkeypatch):
    rng = np.random.default_rng(5)
    texts = [bytes(rng.integers(97, 123, 300, dtype=np.uint8)) for _ in range(4)]
    chunks = [chunk_of([*texts, bytes([65 + k]) * 60]) for k in range(6)]
    keys = [dict(repeats._ask_anchors(50, 25, 1)(c))[0] for c in chunks]
    bits = repeats._shared_anchors(keys)
    asked = [repeats._ask_windows(50, 25, 1)(k, c, {0: {0: b}})["data"][0].as_py() for k, (c, b) in enumerate(zip(chunks, bits, strict=True))]
    ordered = []
    passes = repeats.radix_groups
    monkeypatch.setattr(repeats, "radix_groups", lambda first, *rest: ordered.append(len(first)) or passes(first, *rest))
    answers = [common.unpack(a)[0] for a in repeats._least_ids(50)(asked)]
    assert sum(ordered) < len(answers[0])
    assert all(len(a) == 4 * 251 and (a == answers[0]).all() for a in answers)
