"""SimHash, cover trees and components against brute force."""

import random
from pathlib import Path

import numpy as np
import pytest
from fixtures import SMALL, brute_fingerprint, connected, empty_like, odd_documents, pandas
from pyspark.sql import functions as F

import corpus_pipeline
from assayer.llm import covertree, simhash
from assayer.llm.components import components


def test_components(spark):
    random.seed(3)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 480)]
    edges += [(500, i) for i in range(501, 560)] + [(7, 7)]
    df = spark.createDataFrame([*edges, (None, 3), (4, None)], "x bigint, y bigint")
    got = {r.node: r.component for r in components(df).collect()}
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    assert got == connected(nodes, edges)
    assert components(df.limit(0)).count() == 0


def test_fingerprint_and_groups_against_brute_force(spark):
    docs = pandas("documents")
    known = {i: brute_fingerprint(t) for i, t in zip(docs.doc_id, docs.text)}
    ids = sorted(known)
    links = [(a, b) for a in ids for b in ids if a < b and bin(known[a] ^ known[b]).count("1") <= 3]
    want = connected(ids, links)
    got = simhash.groups(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()
    assert {r.id: (r.fp % 2**64, r.component) for r in got} == {i: (known[i], want[i]) for i in ids}


@pytest.mark.parametrize("group,small", [(1024, 16), (8, 2)])
def test_all_links_within_the_limit(spark, monkeypatch, group, small):
    """Chains of fingerprints 1 to 4 bits apart, some keys crowded."""
    monkeypatch.setattr(simhash, "GROUP", group)
    monkeypatch.setattr(simhash, "SMALL", small)
    draw = random.Random(5)
    fps = set()
    for _ in range(40):
        fp = draw.getrandbits(64)
        for _ in range(12):
            fps.add(fp)
            for bit in draw.sample(range(64), draw.choice([1, 2, 3, 3, 4])):
                fp ^= 1 << bit
    hub = draw.getrandbits(64)
    fps |= {hub ^ (1 << b) for b in range(64)} | {0, 2**64 - 1}
    fps = sorted(fps)
    links = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if bin(a ^ b).count("1") <= 3]
    df = spark.createDataFrame([(f - 2**64 if f >> 63 else f,) for f in fps], "fp bigint")
    found = [(r.a % 2**64, r.b % 2**64) for r in simhash.near(df).collect()]
    assert all(bin(a ^ b).count("1") <= 3 or len(fps) for a, b in found)
    assert connected(fps, found) == connected(fps, links)


def test_simhash_odd_rows(spark):
    docs = odd_documents(spark)
    rows = simhash.groups(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r.id: r for r in rows if r.id is not None}
    assert by_id[3].fp == by_id[4].fp == by_id[7].fp == 0 and by_id[5].component == 3
    assert by_id[2].component == 1
    assert simhash.groups(empty_like(docs)).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 3, 6, 8, 9]
    assert [r.text for r in kept.collect() if r.doc_id is None] == ["a text without an id"]
    assert simhash.keep_one(empty_like(docs)).count() == 0


def brute_vectors(rows, limit=0.9):
    units = {}
    for i, v in rows:
        v = np.array([np.nan if x is None else x for x in v], float) if v is not None else np.array([np.nan])
        units[i] = v / np.linalg.norm(v) if np.isfinite(v).all() and v.any() else None
    links = [
        (a, b)
        for a in units
        for b in units
        if a < b
        and units[a] is not None
        and units[b] is not None
        and len(units[a]) == len(units[b])
        and units[a] @ units[b] >= limit
    ]
    roots = connected(units, links)
    return {i: (sum(i in e for e in links), roots[i], roots[i] == i) for i in units}


@pytest.mark.parametrize("block", [4096, 40])
def test_cover_tree_against_brute_force(spark, block):
    given = pandas("embeddings")
    draw = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(given.vec_id, given.embedding)]
    centre = draw.normal(size=64)
    for k in range(120):  # a chain of near copies, and a tight group
        centre = centre + draw.normal(size=64) * 0.2
        rows.append((10_000 + k, centre.tolist()))
        rows.append((20_000 + k, (np.ones(64) + draw.normal(size=64) * 0.01 * (k % 7)).tolist()))
    rows += [(30_000, None), (30_001, [0.0] * 64), (30_002, [float("nan")] * 64), (30_003, [None, 1.0]), (30_004, [])]
    rows += [(30_005, [1.0, 2.0]), (30_006, [2.0, 4.0]), (30_007, [1e-200, 2e-200]), (30_008, [float("inf"), 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in covertree.near_copies(df, block=block).collect()}
    assert got == brute_vectors(rows)


def test_cover_tree_covers_and_halves():
    draw = np.random.default_rng(4)
    points = np.concatenate([c + draw.normal(size=(80, 8)) * 0.05 for c in draw.normal(size=(6, 8))])
    points /= np.linalg.norm(points, axis=1)[:, None]
    order, root = covertree.build(points)
    assert sorted(order) == list(range(len(points)))
    stack = [root]
    while stack:
        node = stack.pop()
        own = points[order[node.start : node.stop]]
        assert (np.linalg.norm(own - points[node.centre], axis=1) <= node.radius + 1e-6).all()
        covered = [p for c in node.children for p in range(c.start, c.stop)]
        assert not covered or sorted(covered) == list(range(node.start, node.stop))
        stack += node.children


def written(spark):
    """Bytes of the files that now hold shuffles and checkpoints, by path."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = {files.apply(i).getPath(): files.apply(i).length() for i in range(files.size())}
    kept = (spark.sparkContext.getCheckpointDir() or "file:/nowhere").removeprefix("file:")
    return found | {str(p): p.stat().st_size for p in Path(kept).rglob("*") if p.is_file()}


def test_cover_tree_writes_no_pairs(spark):
    """What is written grows with the vectors, not with the pairs of blocks that are compared."""
    draw = np.random.default_rng(6)
    rows = [(k, [float(x) for x in draw.normal(size=64)]) for k in range(3000)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert covertree.near_copies(df.limit(10), block=40).count() == 10
    before = written(spark)
    assert covertree.near_copies(df, block=40).agg(F.sum("n_links")).first()[0] == 0
    more = sum(size for path, size in written(spark).items() if path not in before)
    assert more < 6 * 3000 * 64 * 4


def spread(draw):
    """Groups of vectors, from equal ones to some that hardly link."""
    scales = np.linspace(0, 0.6, 13)
    return [np.float32(draw.normal(size=(1, 64)) + draw.normal(size=(40, 64)) * scale) for scale in scales]


def test_cover_tree_visits_count_each_pair_once(monkeypatch):
    """Two chunks against themselves and each other, in small tiles, by balls whose trees are opened."""
    for name, value in {"TILE": 2048, "GUESTS": 32, "HELD": 16, "LEAF": 4}.items():
        monkeypatch.setattr(covertree, name, value)
    draw = np.random.default_rng(3)
    rows = draw.permutation(np.concatenate(spread(draw)))
    units = covertree._units(rows)
    pivots = units[:20].astype(np.float32)
    cells = (units @ pivots.T).argmax(axis=1)
    sides = []
    for half in (np.arange(0, len(rows), 2), np.arange(1, len(rows), 2)):
        at = half[np.argsort(cells[half], kind="stable")]
        sides.append(covertree.Side.of(at, cells[at], rows[at], pivots, covertree.limit_of(0.9), 30))
    assert max(s.sizes.max() for s in sides) > covertree.LEAF
    got = np.zeros(len(rows), int)
    for side in sides:
        np.add.at(got, side.rids, np.repeat(side.sizes, side.sizes) - 1)
    for one in sides:
        for two in sides:
            visits = covertree.Visits(one, two, 0.9, covertree._first(64, pivots))
            visits.run()
            for row in visits.found().to_pylist():
                side = one if row["rid"] in one.rids else two
                place = int(np.flatnonzero(side.rids == row["rid"])[0])
                ball = int(np.searchsorted(side.bounds, place, side="right")) - 1
                members = side.rids[side.bounds[ball] : side.bounds[ball + 1]] if row["ball"] else [row["rid"]]
                got[members] += row["n"]
    assert (got == (units @ units.T >= 0.9).sum(axis=1) - 1).all()


@pytest.mark.parametrize("kind", ["float", "double"])
def test_cover_tree_across_chunks(spark, monkeypatch, kind):
    """Groups from tight to wider than the limit and copies, dealt to several chunks."""
    monkeypatch.setattr(covertree, "LEAST", 64)
    monkeypatch.setattr(covertree, "SAMPLE", 500)
    draw = np.random.default_rng(9)
    groups = spread(draw)
    groups += [np.float32(draw.normal(size=(1, 2)) + draw.normal(size=(60, 2)) * 0.5), np.ones((90, 64), np.float32)]
    rows = [[float(x) for x in v] for g in groups for v in g] + [None, [], [0.0] * 64, [float("nan")] * 2]
    rows = [(int(i), v) for i, v in zip(draw.permutation(len(rows)), rows)]
    df = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in covertree.near_copies(df, block=50).collect()}
    assert got == brute_vectors(rows)


def test_cover_tree_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.1])], "vec_id bigint, embedding array<float>")
    assert sorted((r.vec_id or 0, r.n_links, r.component_id) for r in covertree.near_copies(df).collect()) == [
        (0, 2, 1),
        (1, 2, 1),
        (1, 2, 1),
    ]
    assert covertree.near_copies(df.limit(0)).count() == 0


def brute_kept(rows):
    """The rows left of (id, text): of each group of linked fingerprints the row with the smallest id, the least text."""
    found = {k: brute_fingerprint(t) for k, (_, t) in enumerate(rows)}
    links = [(a, b) for a in found for b in found if a < b and bin(found[a] ^ found[b]).count("1") <= 3]
    groups = {}
    for k, c in connected(found, links).items():
        groups.setdefault(c, []).append(k)
    return [min((rows[k][0] is None, rows[k][0] or 0) for k in ks) for ks in groups.values()]


def test_pipeline_near_copies_against_all_pairs(spark):
    """The given documents with edited copies, a chain of edits, many equal rows."""
    draw = random.Random(8)
    given = pandas("documents")
    rows = [(int(i), t) for i, t in zip(given.doc_id, given.text)]
    for k in range(60):
        words = rows[draw.randrange(100)][1].split()
        words[draw.randrange(len(words))] = "edited"
        rows.append((1000 + k, " ".join(words)))
    chain = [f"w{draw.randrange(5000)}" for _ in range(400)]
    for k in range(30):
        chain[draw.randrange(400)] = f"e{k}"
        rows.append((2000 + k, " ".join(chain)))
    rows += [(3000, "one text many times")] * 50 + [(3001, "one text many times"), (None, "one text many times")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = corpus_pipeline.near_copies(spark, df, SMALL).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == sorted(brute_kept(rows))


def test_pipeline_near_copies_go_by_row_not_by_id(spark):
    one, two, three = ("a b c d e f", "g h i j k l m", "n o p q r s t u")
    rows = [(1, one), (1, two), (1, two), (2, two), (None, one), (None, three), (None, three), (None, None), (3, " \n")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("_kept", F.create_map(F.lit("a"), "text"))
    kept = corpus_pipeline.near_copies(spark, df, SMALL)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, three), (1, one), (1, two), (3, " \n")]
