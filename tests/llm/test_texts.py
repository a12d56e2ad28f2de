"""Decontamination, licences, mixing, quality and personal data."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from fixtures import LARGE, MEDIUM, SMALL, empty_like, odd_documents, pandas
from oracle_compare import connect, difference

from assayer.llm import decontaminate, licenses, mixing, personal, quality, queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_sql(spark, name):
    assert difference(spark, connect(SMALL), name, queries.QUERIES[name], queries.ORACLES[name], SMALL) is None


# ---- decontamination


def test_decontamination_in_blocks_equals_one_pass(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    one = decontaminate.mark(docs, items).select("doc_id", "_marks").collect()
    many = decontaminate.mark(docs, items, limit=3000).select("doc_id", "_marks").collect()
    assert sorted(map(str, one)) == sorted(map(str, many)) and any(r._marks.hit for r in one)


def test_decontamination_windows_and_offsets(spark):
    item = "One two, three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame(
        [
            (1, "é zero ONE two three; four five six seven eight nine TEN and more"),
            (2, "one two three four five six seven eight nine"),
            (3, "say: short ITEM here"),
            (4, "two three four five six seven eight nine ten eleven one"),
        ],
        "doc_id bigint, text string",
    )
    bench = spark.createDataFrame(
        [(7, item), (8, "short item"), (9, None), (10, ""), (7, item)], "item_id bigint, text string"
    )
    rows = {r.doc_id: r._marks for r in decontaminate.mark(docs, bench).collect()}
    assert rows[1].hit == list(range(2, 12)) and rows[1].items == ["7"] and not rows[2].hit
    text = docs.filter("doc_id = 1").first().text
    start, end = map(int, rows[1].spans[0].split(":"))
    assert text[start:end] == "ONE two three; four five six seven eight nine TEN"
    assert rows[3].items == ["8"] and rows[4].hit == list(range(10))
    got = {r.doc_id: r for r in decontaminate.report(docs, bench).collect()}
    assert got[2].items_sha256 == hashlib.sha256(b"").hexdigest() and got[3].n_hit == 2


def test_decontamination_odd_rows(spark):
    docs, bench = odd_documents(spark), spark.createDataFrame([(1, "lorem ipsum")], "item_id bigint, text string")
    assert {r.doc_id for r in decontaminate.report(docs, bench).collect() if r.contaminated} == {6}
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 1
    assert decontaminate.clean(docs, bench.limit(0)).count() == docs.count()
    assert decontaminate.clean(empty_like(docs), bench).count() == 0


# ---- licences


def test_licence_hashes_are_sparks(spark):
    value = licenses.shingle_hash("released under the mit license")
    row = spark.sql(f"select xxhash64('released under the mit license') as h, xxhash64({value}L, 5) as b").first()
    assert (row.h, row.b) == (value, licenses.band_hash(value, 5))


def test_licences_found_in_altered_wording(spark):
    apache = licenses.NOTICES[1][2]
    words = licenses.NOTICES[4][2].split()
    docs = spark.createDataFrame(
        [
            (1, "x y z " * 40 + apache.upper() + " a b c" * 40),
            (2, "intro " + " ".join(words[:-3]) + " elsewhere"),
            (3, " ".join(words[: len(words) // 2])),
            (4, "under CC-BY-NC 4.0"),
            (5, "Licensed under CC BY-NC 4.0. Released under the MIT\nlicense!"),
            (6, None),
        ],
        "doc_id bigint, text string",
    )
    got = {r.doc_id: (r.n_licenses, r.licenses, r.restricted) for r in licenses.scan(docs).collect()}
    assert got == {
        1: (1, "Apache-2.0", False),
        2: (1, "MIT", False),
        3: (0, "", False),
        4: (0, "", False),
        5: (2, "CC-BY-NC-4.0,MIT", True),
        6: (0, "", False),
    }


GPL_HEAD = (
    "This {} is free software: you can redistribute it and/or modify it under the terms of the GNU {}General"
    " Public License as published by the Free Software Foundation, either version {} of the License, or any later"
)


@pytest.mark.parametrize(
    "text,ids,restricted",
    [
        ("Copyright 2020. All rights reserved.", "reserved", True),
        ("ALL RIGHTS  RESERVED", "reserved", True),
        ("not all rights were reserved", "", False),
        ("All rights reserved. Redistribution and use in source and binary forms, with or without modification, are"
         " permitted provided that the following conditions are met", "BSD-3-Clause,reserved", False),
        ("This work is licensed under the GNU General Public License, version 2", "GPL-2.0", True),
        ("This work is licensed under the GNU General Public License, version 3", "GPL-3.0", True),
        (GPL_HEAD.format("program", "", "2"), "GPL-2.0", True),
        (GPL_HEAD.format("program", "", "3"), "GPL-3.0", True),
        (GPL_HEAD.format("program", "Affero ", "3"), "AGPL-3.0", True),
        (GPL_HEAD.format("library", "Lesser ", "3"), "LGPL-3.0", True),
        (GPL_HEAD.format("library", "Lesser ", "2.1"), "LGPL-2.1", True),
        ("licensed under CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0", True),
        ("licensed under CC BY-NC-ND 4.0", "CC-BY-NC-ND-4.0", True),
        ("licensed under CC BY-ND 4.0", "CC-BY-ND-4.0", True),
        ("Licensed under CC BY-SA 4.0", "CC-BY-SA-4.0", True),
        ("Licensed under CC BY 4.0", "CC-BY-4.0", False),
        ("Licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "CC-BY-NC-SA-4.0", True),
        ("Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "CC-BY-NC-4.0", True),
        ("This document is proprietary and confidential.", "proprietary", True),
        ("one", "", False),
    ],
)
def test_licence_families_and_versions(licence_rows, text, ids, restricted):
    assert licence_rows[text] == (ids, restricted)


@pytest.fixture(scope="module")
def licence_rows(spark):
    marks = test_licence_families_and_versions.pytestmark[0].args[1]
    rows = [(i, "before it " + "a b c " * 30 * (i % 2) + t + " and after" * (i % 3)) for i, (t, _, _) in enumerate(marks)]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    return {marks[r.doc_id][0]: (r.licenses, r.restricted) for r in found}


def test_licences_stay_in_the_jvm_without_shuffle(spark):
    plan = licenses.scan(spark.read.parquet(f"{SMALL}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Exchange", plan)


def test_licences_odd_rows(spark):
    docs = odd_documents(spark)
    assert licenses.scan(docs).count() == docs.count() and licenses.scan(empty_like(docs)).count() == 0


# ---- mixing


def test_mix_meets_its_targets(spark):
    rows = mixing.mix(spark.read.parquet(f"{MEDIUM}/documents.parquet")).collect()
    total = sum(r.size for r in rows)
    taken, target = {}, {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size and (r.position is None or 0 <= r.position <= 1)
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 1 for s in taken) and abs(sum(target.values()) - total) < 1e-3
    assert [r.position for r in rows if r.position is not None] == sorted(
        r.position for r in rows if r.position is not None
    )


def test_mix_caps_and_reshares(spark):
    docs = spark.createDataFrame(
        [(i, "w " * n, s) for i, (s, n) in enumerate([("a", 100), ("b", 10), ("c", 20), (None, 5)])],
        "doc_id bigint, text string, source string",
    )
    rows = {r.source: (r.target, r.taken) for r in mixing.mix(docs).collect()}
    # Weights 1, 2, 3, 1 of 135 words: b is held at 30, c at 60, the fourth at 15; the first has the rest.
    assert rows == {"a": (30.0, 30), "b": (30.0, 30), "c": (60.0, 60), None: (15.0, 15)}


def test_mix_odd_rows(spark):
    docs = odd_documents(spark)
    assert mixing.mix(docs).count() == docs.count() and mixing.mix(empty_like(docs)).count() == 0
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.filter("text is null or text = ''").count() == 0
    assert mixing.mixed(empty_like(docs)).count() == 0


def test_schedule_inverts_its_demand(spark):
    from pyspark.sql import functions as F

    for start, end in ((1.5, 0.5), (2.0, 2.0), (1.5, 4.5)):
        rows = spark.range(11).select(
            (F.col("id") / 10).alias("q"), mixing.position(F.col("id") / 10, F.lit(start), F.lit(end)).alias("t")
        )
        for r in rows.collect():
            assert abs((start * r.t + (end - start) * r.t**2 / 2) / ((start + end) / 2) - r.q) < 1e-9


# ---- quality


def test_marginals_against_all_labellings():
    draw = np.random.default_rng(1)
    scores, moves = draw.normal(size=(7, 2)), draw.normal(size=(2, 2))
    first = np.array([0, 4, 5, 7])
    probable, pairs, log_sum = quality.marginals(scores, moves, first)
    want, want_pairs, want_log = np.zeros((7, 2)), np.zeros((2, 2)), 0.0
    for a, b in zip(first, first[1:]):
        weights = {}
        for code in range(2 ** (b - a)):
            labels = [code >> k & 1 for k in range(b - a)]
            path = sum(moves[x, y] for x, y in zip(labels, labels[1:]))
            weights[tuple(labels)] = np.exp(sum(scores[a + k, y] for k, y in enumerate(labels)) + path)
        total = sum(weights.values())
        want_log += np.log(total)
        for labels, w in weights.items():
            for k, y in enumerate(labels):
                want[a + k, y] += w / total
            for x, y in zip(labels, labels[1:]):
                want_pairs[x, y] += w / total
    assert np.allclose(probable, want) and np.allclose(pairs, want_pairs) and abs(log_sum - want_log) < 1e-9


def test_quality_of_held_out_texts(spark):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: r for r in quality.report(docs, labels).collect()}
    known = pandas("labels", MEDIUM).set_index("doc_id").quality.to_dict()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    held = [i for i in known if i in rows and rows[i].held_out]
    assert len(held) > 40 and np.mean([rows[i].predicted == known[i] for i in held]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())


def test_quality_learns_nothing_from_held_out_labels(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    turned = labels.withColumn("quality", quality.F.when(quality.held_out(), 1 - labels.quality).otherwise(labels.quality))
    one, two = quality.fit(docs, labels), quality.fit(docs, turned)
    assert all(np.array_equal(one[k], two[k]) for k in one)


def test_quality_odd_rows(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1), (9, 0), (6, None), (None, 1), (9, 0)], "doc_id bigint, quality int")
    assert quality.report(docs, labels).count() == docs.count()
    assert {r.score for r in quality.report(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.good(docs, labels).columns == docs.columns
    assert quality.report(empty_like(docs), labels).count() == 0


# ---- personal data


def naive_spans(text):
    found = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        found += [(1, *m.span())] if all(int(p) <= 255 for p in m[0].split(".")) else []
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        found += [(2, *m.span())] if 13 <= len(digits) <= 19 and personal.luhn(digits) else []
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        found += [(3, *m.span())] if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15 else []
    return found


def test_patterns_against_plain_ones():
    draw = random.Random(6)
    for _ in range(3000):
        text = "".join(draw.choice("ab012345.@+-%() é\n") for _ in range(60))
        assert personal.base_spans(text) == naive_spans(text)
    assert personal.luhn("4111111111111111") and not personal.luhn("4111111111111112")


def test_patterns_stand_long_runs():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "@" * 100_000, "+1" + " " * 200_000, "a@" * 50_000):
        personal.base_spans(text)


def test_network_gradients_against_differences():
    draw = np.random.default_rng(0)
    model = {k: v.astype(np.float64) for k, v in personal.start_model().items()}
    x = draw.integers(0, personal.CLASSES, (3, 7))
    y = np.array([[0, 1, 2, 2, 0, 3, 4], [0, 0, 0, 5, 6, 0, 0], [7, 8, 0, 0, 1, 1, 2]])

    def loss(m):
        scores = personal.forward(m, x)[0].astype(np.float64)
        total = 0.0
        for s, tags in zip(scores, y):
            path = m["first"][tags[0]] + s[np.arange(7), tags].sum() + sum(m["moves"][a, b] for a, b in zip(tags, tags[1:]))
            ahead = np.where(personal.STARTS, m["first"] + s[0], -np.inf)
            for t in range(1, 7):
                steps = np.where(personal.ALLOWED, ahead[:, None] + m["moves"], -np.inf)
                ahead = np.logaddexp.reduce(steps, axis=0) + s[t]
            total += np.logaddexp.reduce(ahead) - path
        return total / 3

    grads = personal.gradients(model, x, y)
    for name in model:
        flat = np.argsort(-np.abs(grads[name]).ravel())[:3]
        for at in flat:
            place = np.unravel_index(at, model[name].shape)
            kept = model[name][place]
            model[name][place] = kept + 1e-2
            up = loss(model)
            model[name][place] = kept - 1e-2
            down = loss(model)
            model[name][place] = kept
            assert abs((up - down) / 2e-2 - grads[name][place]) < 2e-3 + 0.05 * abs(grads[name][place]), name


@pytest.fixture(scope="module")
def network():
    texts = [t for t in pandas("documents", LARGE).text if re.search("[0-9@]", t or "") and len(t) < 20_000]
    return personal.train(*personal.training_windows(texts[:300])), texts[300:500]


def test_network_finds_held_out_spans_and_other_spellings(network):
    model, texts = network
    base = [personal.base_spans(t) for t in texts]
    proposed = personal.proposals(texts, model)
    found = sum(any(s == b for _, s in p) for p, own in zip(proposed, base) for b in own)
    assert found >= 0.9 * sum(map(len, base)) > 0
    for text, kind in (("thon erou (988) 555-2485 ndwh er", 3), ("erin the 4111.1111.1111.1111 ha tion", 2)):
        spans = personal.reconciled(personal.base_spans(text), personal.proposals([text], model)[0])
        assert [s[0] for s in spans] == [kind] and not personal.base_spans(text)


def test_network_finds_spans_wherever_they_begin(network):
    """Respelled spans, up to 46 characters long, at every offset to the windows; spans across the blocks of a long text."""
    model, _ = network
    filler = "thon erou ndwh erin the ha tion ingl sost oth nda bri vel "
    spans = ["firstname.lastname.long @ mail.company.example", "(988) 555-2485", "4111.1111.1111.1111", "jo@mail . example . org"]
    total = found = 0
    texts, wanted = [], []
    for span in spans:
        for offset in range(64):
            before = (filler * 3)[: 70 + offset].rstrip() + " "
            before = before.ljust(70 + offset, "e")[:-1] + " "
            texts.append(f"{before}{span} {filler}")
            wanted.append((len(before), len(before) + len(span)))
    for text, want, proposed in zip(texts, wanted, personal.proposals(texts, model)):
        spans_found = personal.reconciled(personal.base_spans(text), proposed)
        total += 1
        found += any((s, e) == want for _, s, e in spans_found)
    assert found >= 0.9 * total


def test_long_texts_are_read_in_blocks(network, monkeypatch):
    model, texts = network
    whole = "\n".join(texts[:60])
    one = personal.proposals([whole], model)
    assert len(one[0]) > 20
    monkeypatch.setattr(personal, "BLOCK", 40)
    many = personal.proposals([whole], model)
    assert sorted({s for _, s in many[0]}) == sorted({s for _, s in one[0]})
    digits = personal.proposals(["1 2-3 " * 40_000], model)  # all of it one stretch
    assert len(digits) == 1


def test_find_against_plain_patterns(spark):
    docs = pandas("documents")
    rows = {r.doc_id: r for r in queries.QUERIES["op10_personal"](spark, SMALL).collect()}
    assert len(rows) == len(docs)
    for doc_id, text in zip(docs.doc_id, docs.text):
        spans = sorted(naive_spans(text))
        row = rows[doc_id]
        own = [f"{personal.KINDS[k]}:{s}:{e}" for k, s, e in spans]
        counts = [sum(k == kind for k, _, _ in spans) for kind in range(4)]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == counts
        assert row.base_sha256 == hashlib.sha256(",".join(own).encode()).hexdigest()
        assert set(own) <= set(row.spans.split(",")) | {""}


def test_network_is_the_same_each_time(network):
    x, y = personal.training_windows(network[1][:20])
    one, two = personal.train(x, y, steps=5), personal.train(x, y, steps=5)
    assert all(np.array_equal(one[k], two[k]) for k in one)


def test_reconciled_keeps_the_base_and_the_surest():
    base = [(0, 10, 20)]
    proposed = [(0.99, (1, 15, 25)), (0.95, (2, 30, 40)), (0.9, (3, 38, 60)), (0.9, (1, 40, 50)), (0.9, (1, 40, 50))]
    assert personal.reconciled(base, proposed) == [(0, 10, 20), (1, 40, 50), (2, 30, 40)]


def test_personal_odd_rows(spark):
    docs = odd_documents(spark).drop("n_email")
    rows = personal.find(docs).collect()
    assert len(rows) == docs.count() and {r.base_sha256 for r in rows} == {hashlib.sha256(b"").hexdigest()}
    assert personal.find(empty_like(docs)).count() == 0
