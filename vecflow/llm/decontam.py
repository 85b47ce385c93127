"""Benchmark decontamination: a prefix-filtered set join with exact containment over item-sized windows.

An item is cut into windows of ``window`` consecutive words (an item of fewer words, but not none, is one window). A
document is contaminated where it holds all words of a window in a row. The join of windows and documents works on
word shingles:

1. Shingles are ordered by rarity: the documents that hold each shingle of the items are counted over the whole
   corpus (first pass; one row for each item shingle comes back).
2. Prefix: exact containment needs every shingle of a window, so its rarest shingle alone is a sufficient prefix.
   Each window is filed under that shingle, with the shingle's place in the window.
3. Documents look up their shingles among the prefixes (second pass). A hit at word p with place o gives the only
   possible start, p - o. Positional bound: the start is not below 0. Length bound: the window's words end within the
   document.
4. Exact verification: the document's words of that span are compared with the window's, byte by byte.

Windows are processed in blocks of at most ``block_windows``: what a task receives is bounded by that, whatever the
benchmark's size, and documents need no shuffle. Of several blocks one is held at a time: rows are numbered in a table
that is written once, each block writes the hits it finds, and one shuffle of hits puts those of a row together. A lost
task is run again from the scan or that table.

Words: maximal runs of digits, letters A-Z in lower case, and characters beyond ASCII. Null and empty texts have no
words, are never contaminated and never contaminate. Items without an id add hits but are not counted as items.
Repeated documents give repeated rows, repeated items count once for each id. Extra columns are left behind.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecflow.llm import common

WINDOW = 10
SHINGLE = 3
#: Windows that are sent to the tasks at once, at most (about 150 bytes each).
BLOCK_WINDOWS = 200_000


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows of items(item_id, text): text (words joined by spaces), n (words), item_ids."""
    schema = pa.schema([("item_id", pa.string()), ("window", pa.binary()), ("n", pa.int32())])

    def cut(batches):
        for batch in batches:
            raw, off = common.utf8_column(batch.column(1))
            rows: tuple[list, list, list] = ([], [], [])
            for i, item in enumerate(batch.column(0).to_pylist()):
                low, s, e = common.words(raw[off[i] : off[i + 1]])
                got = [low[a:b].tobytes() for a, b in zip(s, e, strict=True)]
                k = min(window, len(got))
                for w in {b" ".join(got[j : j + k]) for j in range(len(got) - k + 1)} if k else ():
                    rows[0].append(item)
                    rows[1].append(w)
                    rows[2].append(k)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(rows, schema, strict=True)], schema=schema)

    cutted = items.select(F.col("item_id").cast("string"), F.col("text").cast("string")).mapInArrow(cut, "item_id string, window binary, n int")
    return cutted.groupBy("window").agg(F.first("n").alias("n"), F.collect_set("item_id").alias("item_ids"))


def _window_shingles(w: bytes) -> np.ndarray:
    low = np.frombuffer(w, np.uint8)
    _, s, e = common.words(low)
    return common.shingle_hashes(common.word_hashes(low, s, e), SHINGLE)


def _sizes(windows: list[bytes]) -> list[int]:
    """Shingle lengths in use: SHINGLE, and those of windows with fewer words."""
    return sorted({min(SHINGLE, w.count(b" ") + 1) for w in windows})


def _document_counts(docs: DataFrame, shingles: np.ndarray, sizes: list[int]) -> dict[int, int]:
    """Documents of the whole corpus that hold each of the shingles."""

    def count(batches):
        n = np.zeros(len(shingles), np.int64)
        for batch in batches:
            raw, off = common.utf8_column(batch.column(0))
            for i in range(len(off) - 1):
                low, s, e = common.words(raw[off[i] : off[i + 1]])
                h = common.word_hashes(low, s, e)
                for k in sizes:
                    if len(h) >= k:
                        x = common.shingle_hashes(h, k)
                        at = np.searchsorted(shingles, x)
                        at[at == len(shingles)] = 0
                        n[np.unique(at[shingles[at] == x])] += 1
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n[seen])], ["i", "n"])

    got = docs.select(F.col("text").cast("string")).mapInArrow(count, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()
    return {r["i"]: r["n"] for r in got}


def _prefixes(docs: DataFrame, windows: list[bytes]):
    """(sorted prefix shingles, first entry of each, entries: place in the window and the window's number)."""
    each = [_window_shingles(w) for w in windows]
    shingles = np.unique(np.concatenate(each))
    held = _document_counts(docs, shingles, _sizes(windows))
    n = np.zeros(len(shingles), np.int64)
    n[list(held)] = list(held.values())
    entries = []
    for k, h in enumerate(each):
        at = np.searchsorted(shingles, h)
        o = int(np.lexsort((h, n[at]))[0])  # the rarest; ties by hash
        if n[at[o]]:  # a window of which no document holds the prefix occurs nowhere
            entries.append((int(h[o]), o, k))
    entries.sort()
    keys, first = np.unique(np.array([h for h, _, _ in entries], np.uint64), return_index=True)
    return keys, np.append(first, len(entries)), np.array([[o, k] for _, o, k in entries], np.int64).reshape(-1, 2)


def _search(windows: list[bytes], n_words: list[int], prefixes, sizes):
    keys, first, entries = prefixes

    def find(raw: np.ndarray) -> tuple[int, list[tuple[int, int]], set[int]]:
        """(number of words, hit spans as word positions, windows found) of one text."""
        low, s, e = common.words(raw)
        if not len(s) or not len(keys):
            return len(s), [], set()
        h = common.word_hashes(low, s, e)
        spans, found = [], set()
        for size in sizes:
            if len(h) < size:
                continue
            x = common.shingle_hashes(h, size)
            at = np.searchsorted(keys, x)
            at[at == len(keys)] = 0
            for p in np.flatnonzero(keys[at] == x):
                for o, k in entries[first[at[p]] : first[at[p] + 1]]:
                    a, b = p - o, p - o + n_words[k]
                    if a < 0 or b > len(s):
                        continue
                    if b" ".join(low[s[j] : e[j]].tobytes() for j in range(a, b)) == windows[k]:
                        spans.append((int(a), int(b)))
                        found.add(int(k))
        return len(s), spans, found

    return find


def _blocks_of(listed: DataFrame, n_blocks: int, docs: DataFrame):
    """For each block of windows what a task needs to find them, broadcast: about block_windows rows at a time. The
    caller destroys one before it asks for the next."""
    spark = listed.sparkSession
    for b in range(n_blocks):
        rows = listed.where(F.pmod(F.xxhash64("window"), F.lit(n_blocks)) == b).collect()
        windows, n_words, owners = [bytes(r["window"]) for r in rows], [r["n"] for r in rows], [r["item_ids"] for r in rows]
        prefixes = _prefixes(docs, windows) if windows else (np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros((0, 2), np.int64))
        yield spark.sparkContext.broadcast((windows, n_words, owners, prefixes, _sizes(windows)))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """docs less the rows that hold a window of an item; all columns stay in place, whatever their names."""
    common.bound_batches(docs.sparkSession)
    listed = common.written(item_windows(items, window), "windows")
    n_blocks = max(1, -(-listed.count() // block_windows))
    at = docs.columns.index("text")
    out, before = docs, None
    for b, sent in enumerate(_blocks_of(listed, n_blocks, docs)):

        def run(batches, sent=sent):
            windows, n_words, _, prefixes, sizes = sent.value
            find = _search(windows, n_words, prefixes, sizes)
            for batch in batches:
                raw, off = common.utf8_column(batch.column(at))
                clean = [not find(raw[off[i] : off[i + 1]])[1] for i in range(batch.num_rows)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
        if b < n_blocks - 1:
            scratch = common.Scratch(docs.sparkSession, "clean")
            out = scratch.written(out, "documents")
            sent.destroy()
            if before is not None:
                before.clear()
            before = scratch
    return out


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, n_words, n_hit, item_ids (sorted strings), spans (merged hits:
    first word, word after the last)."""
    spark = docs.sparkSession
    common.bound_batches(spark)
    listed = common.written(item_windows(items, window), "windows")
    n_blocks = max(1, -(-listed.count() // block_windows))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scratch = common.Scratch(spark, "decontamination")
    if n_blocks > 1:  # written, so that all blocks mean the same row by its number
        d = scratch.written(d.withColumn("row", F.monotonically_increasing_id()), "rows")
    else:
        d = d.withColumn("row", F.lit(0).cast("long"))
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n_words", pa.int64()), ("item_ids", pa.list_(pa.string())), ("spans", pa.list_(pa.list_(pa.int64())))])
    parts = []
    for sent in _blocks_of(listed, n_blocks, d):

        def run(batches, sent=sent):
            windows, n_words, owners, prefixes, sizes = sent.value
            find = _search(windows, n_words, prefixes, sizes)
            for batch in batches:
                raw, off = common.utf8_column(batch.column(1))
                n, ids, spans = [], [], []
                for i in range(batch.num_rows):
                    k, got, found = find(raw[off[i] : off[i + 1]])
                    n.append(k)
                    ids.append(sorted({x for w in found for x in owners[w]}))
                    spans.append(_merged(got))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array(v, f.type) for v, f in zip((n, ids, spans), list(schema)[2:], strict=True))], schema=schema)

        hits = d.mapInArrow(run, "doc_id long, row long, n_words long, item_ids array<string>, spans array<array<long>>")
        if n_blocks > 1:  # the first block also brings the rows without hits
            hits = scratch.written(hits.where(F.size("spans") > 0) if parts else hits, "hits")
            sent.destroy()
        parts.append(hits)
    out = parts[0]
    if n_blocks > 1:
        for p in parts[1:]:
            out = out.unionByName(p)
        out = out.groupBy("doc_id", "row").agg(F.max("n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
        n_hit = F.aggregate("spans", start, lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s[1] - F.greatest(a["end"], s[0]))).alias("n"), F.greatest(a["end"], s[1]).alias("end")))["n"]
    else:
        n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    out = out.select("doc_id", "n_words", n_hit.alias("n_hit"), "item_ids", "spans")
    if n_blocks > 1:
        out = common.written(out, "contamination")
        scratch.clear()
    return out


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def item_digest(ids: list[str]) -> str:
    return hashlib.sha256(",".join(ids).encode()).hexdigest()


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    out = decontaminate(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS win
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM (SELECT item_id, w, least(10, len(w)) AS k FROM i WHERE len(w) > 0))
), dw AS (
  SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)
), m AS (
  SELECT doc_id, item_id, k, p FROM dw JOIN iw USING (k, win)
), h AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM m) GROUP BY doc_id
), t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
