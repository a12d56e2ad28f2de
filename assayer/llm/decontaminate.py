"""Benchmark passages in documents, found by one Aho-Corasick automaton.

Words are lower-cased runs of letters, digits and non-ASCII characters.  A
window is ``WINDOW`` consecutive words of a benchmark item, or a whole shorter
item.  The windows, with single spaces between and around their words, are the
patterns of an automaton; a document, brought to the same form, is scanned
once, and what is found is mapped to its words and to offsets in the original.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut, ship

WINDOW = 10
#: Benchmark text, in bytes, for one automaton; a larger benchmark is scanned for in several passes.
BLOCK_BYTES = 8 << 20
# Bytes that are part of a word, lower-cased; all others become a space.
FORM = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
MARKS = "struct<n_words:bigint,hit:array<bigint>,items:array<string>,spans:array<string>>"
_BUILT: dict[str, object] = {}


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FORM).split()


def windows(found: list[bytes], size: int = WINDOW) -> set[bytes]:
    if not found:
        return set()
    return {b" ".join(found[i : i + size]) for i in range(max(1, len(found) - size + 1))}


def automaton(items: list[tuple[str, str | None]], size: int = WINDOW):
    """The automaton of the items' windows; a pattern carries its number of words and its items."""
    import ahocorasick

    owners: dict[bytes, set[str]] = {}
    for item, text in items:
        for window in windows(words(text), size):
            owners.setdefault(window, set()).add(item)
    built = ahocorasick.Automaton()
    for window, ids in owners.items():
        built.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, sorted(ids)))
    if owners:
        built.make_automaton()
    return built if owners else None


def scan(text: str | None, built) -> tuple[int, set[int], set[str]]:
    """(number of words, indexes of the words hit, items) of one text."""
    found = words(text)
    hit: set[int] = set()
    items: set[str] = set()
    if built is not None and found:
        # One character per byte, so that the automaton sees bytes whatever the script.
        form = (b" " + b" ".join(found) + b" ").decode("latin-1")
        at = end = 0
        for last, (n, ids) in built.iter(form):
            at, end = at + form.count(" ", end, last), last
            hit.update(range(at - n, at))
            items.update(ids)
    return len(found), hit, items


def spans(text: str, hit: set[int]) -> list[tuple[int, int]]:
    """The hit words as maximal (start, end) in the original's characters, end exclusive."""
    raw = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(FORM))]
    runs: list[list[int]] = []
    for index in sorted(hit):
        if runs and runs[-1][1] == index - 1:
            runs[-1][1] = index
        else:
            runs.append([index, index])
    found, at, chars = [], 0, 0
    for first, last in runs:
        edges = []
        for byte in (places[first][0], places[last][1]):
            chars += len(raw[at:byte].decode("utf-8", "surrogatepass"))
            at = byte
            edges.append(chars)
        found.append((edges[0], edges[1]))
    return found


def _blocks(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[str, str | None]]]:
    """The items in blocks of at most ``limit`` bytes of text, one item at least; each goes to the driver by itself."""
    given = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    given = given.filter("text is not null")
    total = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = int(2 * total // limit) + 1
    dealt = given.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(count)))
    for block in range(count):
        part: list[tuple[str, str | None]] = []
        size = 0
        for row in dealt.filter(F.col("block") == block).toLocalIterator():
            part.append((row.item, row.text))
            size += len(row.text)
            if size > limit:
                yield part
                part, size = [], 0
        if part or block == 0:
            yield part


def mark(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, limit: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with a column ``_marks``: n_words, indexes of the words hit, items, spans in the original.

    Null and empty texts have no words and no hits; so have all documents if
    the benchmark is empty.  Items without an id count as the item ''.
    """
    spark: SparkSession = docs.sparkSession
    ship(spark)
    marked = docs.withColumn("_marks", F.lit(None).cast(MARKS))
    for number, block in enumerate(_blocks(benchmark, limit)):
        marked = _pass(cut(marked) if number else marked, spark, block, size)
    return marked


def _pass(docs: DataFrame, spark: SparkSession, block: list[tuple[str, str | None]], size: int) -> DataFrame:
    shared = spark.sparkContext.broadcast(block)  # at most BLOCK_BYTES and one item
    digest = hashlib.sha256(repr((size, sorted(map(repr, block)))).encode()).hexdigest()
    columns = docs.columns
    text_at, marks_at = columns.index("text"), columns.index("_marks")
    schema = docs.schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if digest not in _BUILT:
            _BUILT.clear()
            _BUILT[digest] = automaton(shared.value, size)
        built = _BUILT[digest]
        for batch in batches:
            marks = []
            for text, before in zip(batch.column(text_at), batch.column(marks_at)):
                text, before = text.as_py(), before.as_py()
                n, hit, items = scan(text, built)
                if before:
                    hit |= set(before["hit"])
                    items |= set(before["items"])
                found = [f"{a}:{b}" for a, b in spans(text, hit)] if hit else []
                marks.append({"n_words": n, "hit": sorted(hit), "items": sorted(items), "spans": found})
            kind = batch.schema.field(marks_at).type
            yield batch.set_column(marks_at, batch.schema.field(marks_at), pa.array(marks, kind))

    return docs.mapInArrow(work, schema)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: its words, the words hit, the items found, whether it is contaminated."""
    marked = mark(docs.select("doc_id", "text"), benchmark)
    return marked.select(
        "doc_id",
        "_marks.n_words",
        F.size("_marks.hit").cast("bigint").alias("n_hit"),
        F.size("_marks.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("_marks.items", ","), 256).alias("items_sha256"),
        (F.size("_marks.hit") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark window occurs, with all their columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    marked = mark(docs.select(row, F.col("text")), benchmark)
    return marked.filter(F.size("_marks.hit") == 0).select("_row.*")


# The same by DuckDB: documents' words numbered, joined with the windows' first words spelled out.
FORM_SQL = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS_SQL = "regexp_extract_all(" + FORM_SQL + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
with d as (select row_number() over () as r, doc_id, {WORDS_SQL.format("coalesce(text, '')")} as w from documents),
i as (select cast(item_id as varchar) as item, {WORDS_SQL.format("coalesce(text, '')")} as w from benchmark),
p as (select distinct item, array_to_string(w[k : k + {WINDOW - 1}], ' ') as window,
             least(len(w), {WINDOW}) as n
      from (select item, w, unnest(range(1, greatest(2, len(w) - {WINDOW} + 2))) as k from i where len(w) > 0)),
sizes as (select distinct n from p),
s as (select r, k, n, array_to_string(w[k : k + n - 1], ' ') as window
      from (select r, w, unnest(range(1, len(w) + 1)) as k from d), sizes where k + n - 1 <= len(w)),
m as (select distinct s.r, s.k, s.n, p.item from s join p on s.window = p.window and s.n = p.n),
h as (select r, count(distinct word) as n_hit from (select r, unnest(range(k, k + n)) as word from m) group by r),
t as (select r, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items
      from m group by r)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(h.n_hit, 0) as n_hit,
       coalesce(t.n_items, 0) as n_items, sha256(coalesce(t.items, '')) as items_sha256,
       coalesce(h.n_hit, 0) > 0 as contaminated
from d left join h using (r) left join t using (r)
"""
