"""Small tables for the operators' tests, with the cases every operator has to stand."""

import glob
import os

import pandas as pd

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
LARGE = "/root/testdata/sf0.1"

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "lorem ipsum dolor sit amet " * 30_000


def odd_documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    rows = [
        (1, "a plain text of some words", "en", "s1", 26),
        (1, "a plain text of some words", "en", "s1", 26),
        (2, "a plain text of some words", "en", "s2", 26),
        (3, "", "en", "s1", 0),
        (4, None, None, None, None),
        (5, None, "en", None, None),
        (None, "a text without an id", "en", "s2", 20),
        (None, None, None, None, None),
        (6, LONG, "en", "s3", len(LONG)),
        (7, " \n\n ", "en", "", 4),
        (8, "é中\U0001f600 one", "xx", "sé", 5),
        (9, "WORDS!! WORDS!! WORDS!! WORDS!! WORDS!!", "en", "s1", 39),
    ]
    found = spark.createDataFrame(rows, DOCUMENTS)
    extra = {
        name: f"cast('{name}' as string)"
        for name in ("size", "shard", "fp", "key", "group", "score", "_score", "position", "taken", "weight", "word")
    }
    return found.selectExpr("*", *[f"{v} as `{k}`" for k, v in extra.items()])


def empty_like(df):
    return df.limit(0)


def pandas(name, sf_dir=SMALL):
    return pd.concat(pd.read_parquet(p) for p in sorted(glob.glob(os.path.join(sf_dir, f"{name}.parquet"))))


def connected(nodes, edges):
    """The smallest node reachable from each node."""
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def brute_fingerprint(text):
    import xxhash

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        low = low.replace(space, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
