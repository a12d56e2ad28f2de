"""Text quality by a linear-chain conditional random field over a text's lines.

Each line has features of its own, made from counts of its bytes and words,
and those of the line before and after it.  The chain labels every line good
or bad; it is trained in numpy on labelled documents, each line bearing its
document's label.  Forward and backward sums give each line's probability of
being good; their mean, weighted by the lines' lengths, is brought to a
probability for the document by a logistic curve fitted on the same sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ship

#: Labelled documents that the model is fitted on, at most, and the longest text among them, in characters.
SAMPLE, SAMPLE_CHARS = 3000, 20_000
THRESHOLD = 0.7
STEPS, RATE, PENALTY = 250, 0.05, 1e-4

# Classes of bytes whose shares in a line are features.
CLASSES = 8
KIND = np.full(256, 7, np.uint8)  # parts of non-ASCII characters
KIND[:128] = 6  # ASCII symbols, and control characters
KIND[[9, 11, 12, 13, 32]] = 0
KIND[ord("a") : ord("z") + 1] = 1
KIND[ord("A") : ord("Z") + 1] = 2
KIND[ord("0") : ord("9") + 1] = 3
KIND[[ord(c) for c in ".,;:'\"-()"]] = 4
KIND[[ord(c) for c in "!?"]] = 5
#: A bias, the shares of the classes, and five more: see line_features.
OWN = 1 + CLASSES + 5


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, length of each line in bytes, first line of each text) of whole texts, all at once.

    The further features: the logarithms of the length and of the mean length
    of a word, the share of words that stand next to an equal one, the share
    of words seen before in the text's line, and whether the line is empty.
    """
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    counts = np.array([t.count(b"\n") + 1 for t in raw], np.int64)
    first = np.r_[0, np.cumsum(counts)]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.r_[0, ends[:-1] + 1]
    length = ends - starts
    kinds = KIND[data]
    shares = np.empty((len(ends), CLASSES), np.float32)
    for k in range(CLASSES):
        total = np.r_[0, np.cumsum(kinds == k, dtype=np.int32)]
        shares[:, k] = total[ends] - total[starts]
    words = np.zeros((len(ends), 3), np.float32)
    at = 0
    for text in raw:
        for line in text.split(b"\n"):
            if found := line.split():
                n = len(found)
                words[at] = n, sum(map(bytes.__eq__, found, found[1:])) / n, 1 - len(set(found)) / n
            at += 1
    size = np.maximum(length, 1)[:, None].astype(np.float32)
    features = np.concatenate(
        [
            np.ones_like(size),
            shares / size,
            np.log1p(length[:, None]) / 8,
            np.log1p(length[:, None] / np.maximum(words[:, :1], 1)) / 4,
            words[:, 1:],
            (length[:, None] == 0),
        ],
        axis=1,
    ).astype(np.float32)
    return features, length, first


def with_neighbours(features: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each line's features, then those of the line before and of the line after; zero at a text's ends."""
    before, after = np.zeros_like(features), np.zeros_like(features)
    before[1:], after[:-1] = features[:-1], features[1:]
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    return np.concatenate([features, before, after], axis=1)


def _steps(first: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each position in a text, the lines there and the texts that go on, the longest texts first."""
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    ascending = sizes[order][::-1]
    steps = []
    for k in range(int(sizes.max(initial=0))):
        alive = order[: len(sizes) - np.searchsorted(ascending, k, side="right")]
        steps.append((first[alive] + k, alive))
    return steps


def marginals(scores: np.ndarray, moves: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(each line's label probabilities, expected moves, sum of the log partition functions), by forward and backward sums.

    ``scores`` has a row of two label scores per line, ``moves`` the scores of
    going from a label to the next line's.
    """
    steps = _steps(first)
    top = scores.max(axis=1, keepdims=True)
    local, jump = np.exp(scores - top), np.exp(moves)
    ahead, scale = np.empty_like(local), np.ones(len(local))
    for k, (lines, _) in enumerate(steps):
        here = local[lines] if k == 0 else (ahead[lines - 1] @ jump) * local[lines]
        scale[lines] = here.sum(axis=1)
        ahead[lines] = here / scale[lines, None]
    back = np.ones_like(local)
    for lines, _ in reversed(steps[1:]):
        back[lines - 1] = ((local[lines] * back[lines]) @ jump.T) / scale[lines, None]
    pairs = np.zeros((2, 2))
    inner = np.ones(len(local), bool)
    inner[first[:-1]] = False
    here = np.flatnonzero(inner)
    if len(here):
        tail = local[here] * back[here] / scale[here, None]
        pairs = jump * (ahead[here - 1].T @ tail)
    return ahead * back, pairs, float(np.log(scale).sum() + top.sum())


def train(features: np.ndarray, first: np.ndarray, labels: np.ndarray, lengths: np.ndarray) -> dict[str, np.ndarray]:
    """Fit the chain to lines bearing their text's label, by Adam on the likelihood, then the curve on the texts."""
    full = with_neighbours(features, first).astype(np.float64)
    line_labels = np.repeat(labels, np.diff(first))
    truth = np.eye(2)[line_labels]
    # Both labels weigh the same, and each text as much as another, however many lines it has.
    share = np.bincount(labels, minlength=2) / max(1, len(labels))
    weight = (0.5 / np.maximum(share, 1e-9))[labels] / np.diff(first)
    line_weight = np.repeat(weight, np.diff(first))[:, None]
    slope = np.zeros((full.shape[1], 2))
    moves = np.zeros((2, 2))
    moments = [np.zeros_like(slope), np.zeros_like(slope), np.zeros_like(moves), np.zeros_like(moves)]
    inner = np.ones(len(full), bool)
    inner[first[:-1]] = False
    told = np.zeros((2, 2))
    np.add.at(told, (line_labels[inner.nonzero()[0] - 1], line_labels[inner]), 1.0)
    for step in range(1, STEPS + 1):
        probable, pairs, _ = marginals(full @ slope, moves, first)
        down = full.T @ ((truth - probable) * line_weight) / len(labels) - PENALTY * slope
        # Every line bears its text's label, so the moves only learn that labels persist; keep them weak.
        across = (told - pairs) / max(1, len(full)) - 0.05 * moves
        for i, (value, grade) in enumerate(((slope, down), (moves, across))):
            m, v = moments[2 * i], moments[2 * i + 1]
            m += 0.1 * (grade - m)
            v += 0.001 * (grade * grade - v)
            value += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model = {"slope": slope, "moves": moves, "curve": np.array([0.0, 1.0])}
    x = _logit(raw_scores(full, first, lengths, model))
    curve = np.array([0.0, 1.0])
    for _ in range(50):  # Newton steps of a logistic regression, held near the identity
        p = 1 / (1 + np.exp(-(curve[0] + curve[1] * x)))
        grade = np.array([(labels - p).sum(), ((labels - p) * x).sum()]) - np.array([0.0, curve[1] - 1])
        w = p * (1 - p)
        bend = np.array([[w.sum(), (w * x).sum()], [(w * x).sum(), (w * x * x).sum()]]) + np.eye(2)
        curve = curve + np.linalg.solve(bend, grade)
    return model | {"curve": curve}


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def raw_scores(full: np.ndarray, first: np.ndarray, lengths: np.ndarray, model: dict[str, np.ndarray]) -> np.ndarray:
    """Each text's mean probability of a good line, weighted by length plus one."""
    probable, _, _ = marginals(full @ model["slope"], model["moves"], first)
    weight = lengths + 1.0
    return np.add.reduceat(probable[:, 1] * weight, first[:-1]) / np.add.reduceat(weight, first[:-1])


def scores(texts: list[str], model: dict[str, np.ndarray]) -> np.ndarray:
    features, lengths, first = line_features(texts)
    raw = raw_scores(with_neighbours(features, first).astype(np.float64), first, lengths, model)
    return 1 / (1 + np.exp(-(model["curve"][0] + model["curve"][1] * _logit(raw))))


def held_out(id_column: str = "doc_id"):
    return F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(4)) == 2


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """A model from a bounded sample of labelled texts that are not held out.

    The sample is the ``sample`` texts first in the order of a hash of their
    ids, up to SAMPLE_CHARS characters each.  With no labelled texts, or of
    one label only, every score is the share of label 1, or one half.
    """
    known = labels.select(F.col("doc_id").alias("_id"), "quality").filter("quality in (0, 1)")
    known = known.filter(~held_out("_id")).groupBy("_id").agg(F.max("quality").alias("quality"))
    fits = docs.filter(F.length("text") <= SAMPLE_CHARS).select("doc_id", "text")
    # The ids come first: only they are sorted, and the texts are fetched for the few that were chosen.
    ids = known.join(fits.select("doc_id"), F.col("_id") == F.col("doc_id"), "left_semi")
    chosen = ids.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    found = fits.join(F.broadcast(chosen), F.col("_id") == F.col("doc_id")).select("_id", "quality", "text")
    rows = sorted({(r._id, r.quality, r.text) for r in found.limit(4 * sample).collect()})
    given = np.array([r[1] for r in rows], np.int64)
    if len(set(given.tolist())) < 2:
        share = given.mean() if len(given) else 0.5
        empty = np.zeros((3 * OWN, 2))
        return {"slope": empty, "moves": np.zeros((2, 2)), "curve": np.array([float(_logit(np.array(share))), 1.0])}
    features, lengths, first = line_features([r[2] for r in rows])
    return train(features, first, given, lengths)


def classify(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """``docs`` with a column ``_score``; only the text, null as empty, is looked at."""
    spark = docs.sparkSession
    ship(spark)
    scored = docs.withColumn("_score", F.lit(None).cast("double"))
    text_at, score_at = scored.columns.index("text"), len(scored.columns) - 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(text_at)]
            found = np.empty(len(texts))
            start = 0
            while start < len(texts):  # about 4 MB of text at a time
                stop, size = start, 0
                while stop < len(texts) and (stop == start or size + len(texts[stop]) < 4_000_000):
                    size += len(texts[stop])
                    stop += 1
                found[start:stop] = scores(texts[start:stop], model)
                start = stop
            yield batch.set_column(score_at, batch.schema.field(score_at), pa.array(found))

    return scored.mapInArrow(work, scored.schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; one without an id is not held out."""
    given = docs.select("doc_id", "text")
    scored = classify(given, fit(given, labels))
    return scored.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted good, with all their columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    scored = classify(docs.select(row, "text"), fit(docs.select("doc_id", "text"), labels))
    return scored.filter(F.col("_score") >= THRESHOLD).select("_row.*")
