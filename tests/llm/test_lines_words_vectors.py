"""Shared lines, spelling variants and vector codes against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from fixtures import SMALL, empty_like, odd_documents, pandas

from assayer.llm import codes, lines, queries, variants

# ---- lines


def brute_lines(rows):
    """(id, lines, dropped, digest) of each (id, text), as the contract says it."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = [(i, (t or "").split("\n")) for i, t in rows]
    holders = {}
    for i, own in split:
        for line in own:
            key = line.strip(" \t\n\x0b\f\r").translate(low)
            if len(key) >= 20:
                holders.setdefault(key, set()).add(i)
    found = []
    for i, own in split:
        kept = []
        for line in own:
            having = holders.get(line.strip(" \t\n\x0b\f\r").translate(low), ())
            if len(having) < 3 or i == max(having, key=lambda x: (x is not None, x)):
                kept.append(line)
        found.append((i, len(own), len(own) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return found


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("batch", [10_000, 7])
def test_shared_lines_against_brute_force(spark, batch):
    """Lines at the limits of length and number, hot ones, repeats; with small batches most runs end in several."""
    draw = random.Random(3)
    given = pandas("documents")
    rows = [(int(i), t) for i, t in zip(given.doc_id, given.text)]
    pool = [f"{'x' * draw.randrange(15, 24)} {k % 40}" for k in range(80)] + ["é" * 19, "é" * 20, "É" * 20, "a\x00" * 10]
    hot = "a very common line of all documents"
    for k in range(400):
        own = [draw.choice([" ", "", "\t"]) + draw.choice([str.upper, str])(draw.choice(pool)) for _ in range(draw.randrange(6))]
        rows.append((1000 + k, "\n".join([hot, *own, hot, "\r" + hot][draw.randrange(3) :])))
    rows += [(1001, hot + "\nown text of a repeated id"), (1001, hot), (None, hot + "\n" + hot), (None, hot), (5, None)]
    rows += [(2000 + k, "two of an id only, not shared") for k in (1, 1, 2)] + [(3000, "\n".join([hot, "z"] * 50_000))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        found = lines.report(df).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert order(found) == order(brute_lines(rows))


def test_shared_lines_odd_rows(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert order(lines.report(docs).collect()) == order(brute_lines(rows))
    whole = lines.without_shared_lines(docs, least=5, shared=2)
    assert whole.columns == docs.columns and whole.count() == docs.count()
    texts = [(r.doc_id, r.text) for r in whole.collect()]
    assert texts.count((1, "")) == 2 and (2, "a plain text of some words") in texts and (4, None) in texts
    assert lines.report(empty_like(docs)).count() == 0
    assert lines.bitmaps(docs).count() == 0


def test_bitmaps_are_small_and_exact(spark):
    text = "\n".join(["the same line in all texts"] * 10_000 + ["own"])
    docs = spark.createDataFrame([(k, text + str(k)) for k in range(4)], "doc_id bigint, text string")
    found = {r.id: r for r in lines.bitmaps(docs).collect()}
    assert sorted(found) == [0, 1, 2] and found[1].n_dropped == 10_000 and len(found[1].bitmap) < 100
    assert lines.kept_lines(text, found[1].bitmap) == "own"


# ---- words


def brute_vocabulary(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counted = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counted[run] += 1
    return {w: n for w, n in counted.items() if len(w) >= 6 and n >= 5}


def brute_near(words):
    """The words one edit apart, by the words with a letter left out."""
    by_hole = {}
    for w in words:
        for k in range(len(w)):
            by_hole.setdefault((w[:k], w[k + 1 :]), set()).add(w)
    found = {w: set() for w in words}
    for group in by_hole.values():
        for w in group:
            found[w] |= group - {w}
    for w in words:
        for k in range(len(w)):
            shorter = w[:k] + w[k + 1 :]
            if shorter in found:
                found[w].add(shorter)
                found[shorter].add(w)
    return found


def brute_variants(rows):
    words = brute_vocabulary(rows)
    found = brute_near(words)
    form = {}
    for w, near in found.items():
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (n, len(found[w]), form[w], form[w] and words[form[w]], root(w)) for w, n in words.items()}


def as_dict(found):
    rows = found.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}


@pytest.mark.parametrize("leaf", [variants.LEAF, 16])
def test_variants_against_brute_force(spark, leaf):
    """The given documents, and made words: edits at every place, transposed letters, chains of forms, long words."""
    draw = random.Random(4)
    given = pandas("documents")
    rows = [(int(i), t) for i, t in zip(given.doc_id, given.text)]
    stems = ["".join(draw.choice("abcdeé") for _ in range(draw.randrange(6, 11))) for _ in range(60)] + ["aaaaaa", "ÿ" * 7, "q" * 300]
    for k, stem in enumerate(stems):
        weight = 5 + 5 * draw.randrange(4)
        for _ in range(6):
            rows.append((5000 + len(rows), f"{stem} " * weight * draw.choice([1, 6, 40])))
            at = draw.randrange(len(stem))
            stem = draw.choice([stem[:at] + "abz"[at % 3] + stem[at + 1 :], stem[:at] + stem[at + 1 :], stem[:at] + "É" + stem[at:]])
        rows.append((7000 + k, f"{stem[1] + stem[0] + stem[2:]} " * 5))
    rows += [(None, "nameless " * 9), (None, None), (3, ""), (9000, "×÷×÷×÷ " * 7 + "Ünlaut's " * 5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute_variants(rows)
    assert sum(r[2] is not None for r in want.values()) > 20 and any(r[2] not in (None, r[4]) for r in want.values())
    assert as_dict(variants.group_variants(df, leaf=leaf)) == want


def test_variants_query_against_brute_force(spark):
    given = pandas("documents")
    found = as_dict(queries.QUERIES["op12_variants"](spark, SMALL))
    assert found == brute_variants(zip(given.doc_id, given.text)) and len(found) > 50


def test_no_leaf_within_reach_is_missed():
    draw = np.random.default_rng(6)
    words = sorted({"".join(draw.choice(list("abcdefgh"), 7)) for _ in range(3000)})
    vectors = variants.counts(words)
    tree = variants.fit(vectors[::3], len(words), 30)
    homes = dict(zip(*map(np.ndarray.tolist, variants.route(tree, vectors, 0, 0))))
    reach = {(r, leaf) for r, leaf in zip(*map(np.ndarray.tolist, variants.route(tree, vectors, 1, 1)))}
    assert len(homes) == len(words) and len(set(homes.values())) > 50
    assert len(reach) < 0.7 * len(words) * len(set(homes.values()))
    change = vectors[:, None] - vectors[None, :400]
    near = (np.maximum(change, 0).sum(axis=2) <= 1) & (np.maximum(-change, 0).sum(axis=2) <= 1)
    assert all((q, homes[w]) in reach for q, w in np.argwhere(near).tolist())


def test_variants_odd_rows(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert as_dict(variants.group_variants(docs)) == brute_variants(rows)
    assert variants.group_variants(empty_like(docs)).count() == 0


# ---- vectors


def brute_codes(rows, parts=16, entries=64, rounds=2):
    """(id, code, error, label error) of (id, vector, label) in Python's integers."""
    whole = []
    for i, v, label in rows:
        if v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole.append((i, [int(np.floor(256 * np.float64(x))) for x in v], label))
    width = len(whole[0][1]) // parts
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cuts = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for _, v, _ in whole]
    books = [[c[p] for c in cuts[:entries]] for p in range(parts)]

    def nearest(part, book):
        far = [sum((x - y) ** 2 for x, y in zip(part, e)) for e in book]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for c in cuts:
                held.setdefault(nearest(c[p], books[p])[0], []).append(c[p])
            for e, own in held.items():
                books[p][e] = tuple(sum(x) // len(own) for x in zip(*own))
    found, labels = [], Counter()
    for (i, _, label), c in zip(whole, cuts):
        best = [nearest(c[p], books[p]) for p in range(parts)]
        found.append((i, "".join(f"{e:02x}" for e, _ in best), sum(f for _, f in best), label))
        labels[label] += found[-1][2]
    text = ",".join(str(x) for b in books for e in b for x in e)
    return [(i, c, f, labels[label], hashlib.sha256(text.encode()).hexdigest()) for i, c, f, label in found]


@pytest.mark.parametrize("scale", [1.0, 3e4, 4e9])
def test_codes_against_brute_force(spark, scale):
    """Also of integers so large that they take several limbs, or leave int64."""
    draw = np.random.default_rng(7)
    rows = [(int(i), (draw.normal(size=32) * scale).tolist(), int(draw.integers(3))) for i in draw.permutation(300)]
    rows += [(1, rows[5][1], None), (1, rows[6][1], None), (None, rows[7][1], 2), (1000, None, 1)]
    rows += [(1001, [float("nan")] * 32, 1), (1002, [None] + [1.0] * 31, 1), (1003, [float("inf")] + [0.0] * 31, 9)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(5)
    df = df.selectExpr("*", "'x' as error", "'y' as code", "'z' as values", "'u' as id")
    found = codes.compress(df).collect()

    def long(x):
        return x if x is not None and x < 2**63 else None

    want = [(i, c, long(f), long(s), h) for i, c, f, s, h in brute_codes(rows)]
    assert order(found) == order(want)


def test_dot_products_are_exact():
    draw = np.random.default_rng(8)
    for bits in (5, 20, 27, 30, 45, 62):
        a, b = (draw.integers(-(2**bits), 2**bits, size) for size in ((40, 37), (11, 37)))
        found = codes.dots(a, b)
        assert (found.astype(object) == a.astype(object) @ b.astype(object).T).all()
        assert (found.dtype == object) == (bits > 27)
        for limb in codes.limbs(a, 9)[:-1]:
            assert limb.min() >= 0 and limb.max() < 512


def test_codes_ties_go_to_the_first_and_unused_entries_stay():
    rows = np.array([[1, 1], [5, 5], [3, 3]])
    entries = np.array([[0, 0], [6, 6], [0, 0], [6, 6]])
    assert codes.nearest(rows, entries)[0].tolist() == [0, 1, 0]
    assert codes.nearest(rows, entries)[1].tolist() == [2, 2, 18]


def test_codes_odd_tables(spark):
    schema = "vec_id bigint, embedding array<float>, label string"
    assert codes.compress(spark.createDataFrame([], schema)).count() == 0
    same = codes.compress(spark.createDataFrame([(k, [0.5] * 16, None) for k in range(200)], schema)).collect()
    assert {(r.code, r.error, r.label_error) for r in same} == {("00" * 16, 0, 0)}
    for rows in ([(1, [0.5] * 15, "a")], [(1, [0.5] * 16, "a"), (2, [0.5] * 32, "a")], [(1, [], "a")]):
        with pytest.raises(ValueError):
            codes.compress(spark.createDataFrame(rows, schema))
