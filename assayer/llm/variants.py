"""Spelling variants: words one edit apart, found by k-d trees over their letter counts.

One edit changes a word's letter counts by two at most: a replaced letter
takes one away and adds one, an inserted one adds one.  So the words of a
length are searched by those of the same length, whose counts may be above by
one and below by one, and by those one longer, which may be above by one.

The words of a length are dealt to the leaves of a k-d tree over their counts.
Its splits are fitted on a bounded sample of words and only steer the balance:
a word goes to every leaf whose box is within reach, so nothing is missed.
Within a leaf, a task builds a k-d tree of its own with the true boxes of its
nodes, prunes the queries by them, and compares the letters in order last.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.operators.joins import lookup_join

from .shared import cut, ship

LEAST, OCCURRENCES, RATIO, DAMAGED = 6, 5, 5, 199
LETTERS = 26 + 64
#: Words of one length in a leaf, about; and about how many words the splits of all lengths are fitted on.
LEAF, SAMPLE = 4096, 50_000
#: Words in a leaf of a task's own tree; letters compared at once.
SMALL, CELLS = 48, 4_000_000
#: Words a task counts before it hands its counts on.
HELD = 200_000
#: A row in a leaf: one of its words, a word of the same length from elsewhere, a word longer by one.
OWN, SAME, LONGER = 0, 1, 2


def runs(text: bytes, least: int = 1) -> Iterator[str]:
    """The maximal runs of at least ``least`` letters, A-Z in lower case."""
    low = text.lower().decode("utf-8", "replace")  # of bytes: letters of ASCII only
    return (m.group() for m in re.finditer(f"[a-z\u00C0-\u00FF]{{{least},}}", low))


def damaged(doc_id: bytes, run: str) -> str:
    """The run as the corpus has it: one in 199, by a checksum of document and run, without one of its letters."""
    h = zlib.crc32(doc_id + b":" + run.encode())
    if h % DAMAGED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, least: int = LEAST, occurrences: int = OCCURRENCES) -> DataFrame:
    """(word, n): the words of at least ``least`` letters that occur often enough.

    A null text has no words; a null id counts as an empty one.
    """
    ship(docs.sparkSession)
    given = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"), F.col("text").cast("binary"))

    def batch_of(counted: Counter) -> pa.RecordBatch:
        columns = [pa.array(list(counted), pa.string()), pa.array(list(counted.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(*batch.columns):
                doc_id = doc_id.as_py()
                for run, n in Counter(runs(text.as_py() or b"", least)).items():
                    word = damaged(doc_id, run)
                    if len(word) >= least:
                        counted[word] += n
                if len(counted) > HELD:
                    yield batch_of(counted)
                    counted.clear()
        yield batch_of(counted)

    found = given.mapInArrow(work, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return found.filter(F.col("n") >= occurrences)


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all letters of the words one after the other, and where each word begins."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return np.where(codes < 128, codes - ord("a"), codes - 0xC0 + 26), np.r_[0, np.cumsum(lengths)]


def counts(words: list[str]) -> np.ndarray:
    """How often each word has each letter."""
    codes, starts = letters(words)
    found = np.zeros((len(words), LETTERS), np.int32)
    np.add.at(found, (np.repeat(np.arange(len(words)), np.diff(starts)), codes), 1)
    return found


def _split(vectors: np.ndarray) -> tuple[int, int] | None:
    """The letter that spreads most and a count, such that neither the words up to it nor those above are none."""
    spread = vectors.std(axis=0)
    for letter in np.argsort(-spread, kind="stable"):
        if spread[letter] == 0:
            return None
        own = vectors[:, letter]
        middle = int(np.median(own))
        for at in (middle, middle - 1):
            if (own <= at).any() and (own > at).any():
                return int(letter), at
    return None


def fit(vectors: np.ndarray, size: float, leaf: int = LEAF):
    """A k-d tree for ``size`` words, from a sample of them: (letter, count, left, right), or a leaf's number."""
    number = iter(range(len(vectors) + 1))

    def grow(rows: np.ndarray, size: float):
        chosen = _split(vectors[rows]) if size > leaf and len(rows) > 1 else None
        if chosen is None:
            return next(number)
        left = vectors[rows, chosen[0]] <= chosen[1]
        share = size / len(rows)
        return (*chosen, grow(rows[left], left.sum() * share), grow(rows[~left], (~left).sum() * share))

    return grow(np.arange(len(vectors)), size)


def route(tree, vectors: np.ndarray, above: int, below: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf): the leaves that hold words with up to ``above`` letters more and ``below`` fewer than each row."""
    rows, leaves = [], []

    def descend(node, at: np.ndarray, more: np.ndarray, fewer: np.ndarray, low: dict, high: dict) -> None:
        if not len(at):
            return
        if not isinstance(node, tuple):
            rows.append(at)
            leaves.append(np.full(len(at), node, np.int64))
            return
        letter, count, left, right = node
        own = vectors[at, letter]
        # Left of the split a word has up to ``count`` of the letter: what a row has above it would be lacking.
        old = np.maximum(own - high[letter], 0) if letter in high else 0
        lacks = fewer + np.maximum(own - count, 0) - old
        kept = lacks <= below
        descend(left, at[kept], more[kept], lacks[kept], low, {**high, letter: count})
        old = np.maximum(low[letter] - own, 0) if letter in low else 0
        exceeds = more + np.maximum(count + 1 - own, 0) - old
        kept = exceeds <= above
        descend(right, at[kept], exceeds[kept], fewer[kept], {**low, letter: count + 1}, high)

    none = np.zeros(len(vectors), np.int64)
    descend(tree, np.arange(len(vectors)), none, none, {}, {})
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *rows]), np.concatenate([empty, *leaves])


def _one_apart(queries: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Whether rows of letters are one edit apart; the queries are as long as the words, or longer by one."""
    if queries.shape[1] == words.shape[1]:
        return (queries != words).sum(axis=1) == 1
    before = np.logical_and.accumulate(queries[:, :-1] == words, axis=1).sum(axis=1)
    after = np.logical_and.accumulate((queries[:, 1:] == words)[:, ::-1], axis=1).sum(axis=1)
    return before + after >= words.shape[1]


def search(words: list[str], queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(query, word): all pairs one edit apart; the words have one length, the queries the same, or are longer by one.

    A k-d tree over the words' counts, with the box of each node; a query goes
    on to a node whose box is within reach.
    """
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    if not words or not queries:
        return found[0]
    longer = len(queries[0]) - len(words[0])
    own, asked = counts(words), counts(queries)
    codes, wanted = (letters(x)[0].reshape(len(x), -1) for x in (words, queries))

    def visit(rows: np.ndarray, at: np.ndarray) -> None:
        low, high = own[rows].min(axis=0), own[rows].max(axis=0)
        more = np.maximum(low - asked[at], 0).sum(axis=1)
        fewer = np.maximum(asked[at] - high, 0).sum(axis=1)
        at = at[(more <= 1 - longer) & (fewer <= 1)]
        if not len(at):
            return
        chosen = _split(own[rows]) if len(rows) > SMALL else None
        if chosen is not None:
            left = own[rows, chosen[0]] <= chosen[1]
            visit(rows[left], at)
            visit(rows[~left], at)
            return
        step = max(1, CELLS // (len(rows) * LETTERS))
        for some in (at[i : i + step] for i in range(0, len(at), step)):
            change = own[rows][None] - asked[some][:, None]
            near = (np.maximum(change, 0).sum(axis=2) <= 1 - longer) & (np.maximum(-change, 0).sum(axis=2) <= 1)
            q, w = np.nonzero(near)
            q, w = some[q], rows[w]
            part = max(1, CELLS // codes.shape[1])
            for k in range(0, len(q), part):
                true = _one_apart(wanted[q[k : k + part]], codes[w[k : k + part]])
                found.append((q[k : k + part][true], w[k : k + part][true]))

    visit(np.arange(len(words)), np.arange(len(queries)))
    return np.concatenate([q for q, _ in found]), np.concatenate([w for _, w in found])


def _trees(words: DataFrame, leaf: int, sample: int) -> dict:
    """A tree for each length that has words; a number for a length of one leaf.

    What is collected is a row for each length and about ``sample`` words of
    the long lists, those whose hash is least, the same each time.
    """
    sizes = {r["length"]: r["n"] for r in words.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    large = [length for length, n in sizes.items() if n > leaf]
    trees: dict = dict.fromkeys(sizes, 0)
    if large:
        share = min(1.0, sample / sum(sizes[length] for length in large))
        least = F.xxhash64("word") <= F.lit(min(2**63 - 1, int(-(2**63) + share * 2**64)))
        drawn = words.filter(F.col("length").isin(large) & least)
        by_length: dict[int, list[str]] = {}
        for row in drawn.select("word", "length").collect():
            by_length.setdefault(row["length"], []).append(row["word"])
        for length, own in by_length.items():
            trees[length] = fit(counts(own), sizes[length], leaf)
    return trees


def _leaves(tree) -> int:
    return _leaves(tree[2]) + _leaves(tree[3]) if isinstance(tree, tuple) else 1


def near(words: DataFrame, leaf: int = LEAF, sample: int = SAMPLE) -> DataFrame:
    """(word, other, other_n): every two words one edit apart, in both directions; ``words`` are distinct (word, n)."""
    ship(words.sparkSession)
    words = words.select("word", "n", F.char_length("word").alias("length"))
    trees = _trees(words, leaf, sample)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, lengths = batch.column(0).to_pylist(), batch.column(2).to_numpy(zero_copy_only=False)
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                vectors = counts([own[r] for r in rows])
                places = [(length, OWN, *route(trees[length], vectors, 0, 0)), (length, SAME, *route(trees[length], vectors, 1, 1))]
                if length - 1 in trees:
                    places.append((length - 1, LONGER, *route(trees[length - 1], vectors, 0, 1)))
                home = dict(zip(places[0][2].tolist(), places[0][3].tolist()))
                for of, role, at, leaves in places:
                    if role == SAME:
                        other = leaves != np.array([home[a] for a in at.tolist()], np.int64)
                        at, leaves = at[other], leaves[other]
                    chosen = batch.select([0, 1]).take(pa.array(rows[at]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(at), of, np.int32)),
                            pa.array(leaves),
                            pa.array(np.full(len(at), role, np.int32)),
                            *chosen.columns,
                        ],
                        ["length", "leaf", "role", "word", "n"],
                    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        own = group[group.role == OWN]
        found = []
        for kind in (group.role != LONGER, group.role == LONGER):
            asked = group[kind]
            q, w = search(own.word.tolist(), asked.word.tolist())
            asked, held = asked.iloc[q], own.iloc[w]
            found.append((asked.word, held.word, held.n))
        # Words of one length find each other from both sides; a longer one is found by none.
        found.append((held.word, asked.word, asked.n))
        return pd.DataFrame({name: np.concatenate(c) for name, c in zip(("word", "other", "other_n"), zip(*found))})

    # The work is in the comparing, not in the bytes: a task gets about two leaves, however few bytes they are.
    leaves = sum(map(_leaves, trees.values()))
    dealt = words.mapInArrow(deal, "length int, leaf bigint, role int, word string, n bigint")
    dealt = dealt.repartition(max(1, leaves // 2), "length", "leaf")
    return dealt.groupBy("length", "leaf").applyInPandas(compare, "word string, other string, other_n bigint")


def _roots(formed: DataFrame) -> DataFrame:
    """(word, root) of the words with a form: forms followed to the last, in steps that double.

    Each form is several times as frequent, so no chain is longer than the
    logarithm of the largest count.
    """
    steps = cut(formed.select("word", F.col("form").alias("root")))
    while True:
        next_step = steps.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        moved = cut(
            lookup_join(steps, next_step, "root", "_word", "left").select(
                "word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")
            )
        )
        steps = moved.select("word", "root")
        if not moved.filter("moved").take(1):
            return steps


def group_variants(docs: DataFrame, leaf: int = LEAF, sample: int = SAMPLE, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the documents' vocabulary.

    The form is the most frequent near word, of equal ones the first in
    code-point order, if it is ``ratio`` times as frequent as the word.
    """
    words = cut(vocabulary(docs))
    best = near(words, leaf, sample).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    named = words.join(best.withColumnRenamed("word", "_word"), F.col("word") == F.col("_word"), "left")
    is_form = -F.col("best.less") >= ratio * F.col("n")
    named = cut(
        named.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, F.col("best.other")).alias("form"),
            F.when(is_form, -F.col("best.less")).alias("form_n"),
        )
    )
    roots = _roots(named.filter("form is not null")).withColumnRenamed("word", "_word")
    joined = named.join(roots, F.col("word") == F.col("_word"), "left")
    return joined.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
