"""N-gram Jaccard join by chosen paths, and near-duplicate classes from its links.

A text is the set of its word shingles (five words; fewer words, but not none, are one shingle). Two texts are linked
where the Jaccard similarity of their sets is at least ``threshold``. Texts of equal sets are one class from the start
and are joined as one (the smallest doc_id stands for them), so copies cost one row each and no pairs.

The join: in each of ``runs`` runs a set draws those of its shingles whose hash falls below ``RATE`` / size, and goes
into the bucket of each: similar sets draw the same shingles. A bucket of more than ``SMALL`` sets is split further, by
the pair of its path and each shingle whose hash with that path falls below ``RATE`` / size, to ``DEPTH`` shingles at
most, but not if that leaves it as large as it was. Small buckets are compared by brute force, all pairs, on whole sets.

Recall: two sets at the threshold t share RATE * t draws of a path or more, on average (the worst case is a set within
another), and draws of different paths are independent. So they share none in a run with probability a = exp(-RATE * t)
at most, and no path that lives through all splits with probability q at most, q = exp(-RATE * t * (1 - q)) applied
DEPTH times from 0. All sets take ``runs`` runs; sets of split buckets take ``more`` further ones, so that two sets that
share a split bucket both do. The part of links that never meet, a^runs + q^(runs + more), is at most 1 - ``recall``.

* Buckets that no split makes small are cut into blocks, and each pair of blocks is compared by itself: exact, in
  bounded memory, whatever the size.
* A bucket's set that has no other one of like size there is not sent; of buckets with the same members one is kept.
* A pair is counted only in the smallest bucket that holds both of its sets; each row carries the list of its buckets
  (RATE * runs of them, about), so this needs no exchange of pairs. A bucket sends numbers of links and a spanning tree
  of its links, never pairs: rows grow with the sets, not with the square of a group's size.
* Classes are connected components, found by repeated star contraction on written tables.

Result: one row per row: doc_id, class_id (smallest doc_id of the class), n_links (other texts linked to this one,
copies counted once), n_copies (rows with the same set), n_shingles. Null texts and texts without words are classes of
their own with n_copies 1 and no links, and so are rows without a doc_id (class_id null). Rows of equal doc_id are
rows of one class if their sets are equal. Extra columns are left behind. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vecflow.llm import common

SHINGLE = 5
THRESHOLD = 0.8
RATE = 2.0
RECALL = 0.999999
SMALL = 4096
DEPTH = 4
#: Sets of split buckets that are broadcast at most (16 bytes each).
COUNTED = 200_000
_SEEDS = np.random.default_rng(77).integers(1, 2**63, 256, dtype=np.uint64)


def runs_for(threshold: float = THRESHOLD, recall: float = RECALL, rate: float = RATE) -> int:
    """Runs of all sets: a pair at the threshold shares no draw with nine tenths of 1 - recall at most."""
    return max(1, math.ceil(math.log(0.9 * (1 - recall)) / (-rate * threshold)))


def more_runs_for(threshold: float = THRESHOLD, recall: float = RECALL, rate: float = RATE, depth: int = DEPTH) -> int:
    """Further runs of sets whose buckets are split: what splits lose fits into the rest of 1 - recall."""
    runs, q = runs_for(threshold, recall, rate), 0.0
    for _ in range(depth):
        q = math.exp(-rate * threshold * (1 - q))
    rest = 1 - recall - math.exp(-rate * threshold * runs)
    return max(0, math.ceil(math.log(rest) / math.log(q)) - runs)


def shingle_set(raw: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a text's bytes."""
    return np.unique(common.shingle_hashes(common.word_hashes(*common.words(raw)), k))


def set_name(s: np.ndarray, seed: int) -> int:
    """A 64-bit sum over the set's mixed hashes."""
    return int(np.add.reduce(common.mix(s ^ _SEEDS[seed])).view(np.int64))


def _drawn(s: np.ndarray, seed: np.uint64, rate: float) -> list[int]:
    """The shingles that a set draws under a seed."""
    top = np.uint64(min(2**64 - 1, int(rate / len(s) * 2**64)))
    return s[common.mix(s ^ seed) <= top].view(np.int64).tolist()


def _draws(s: np.ndarray, runs: int, rate: float) -> list[list[int]]:
    """The shingles that a set draws in each run."""
    return [_drawn(s, _SEEDS[r], rate) for r in range(runs)]


def _sets(docs: DataFrame, k: int, runs: int, rate: float) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("draws", pa.list_(pa.list_(pa.int64())))])

    def run(batches):
        for batch in batches:
            raw, off = common.utf8_column(batch.column(1))
            rows: list[tuple] = []
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                s = shingle_set(raw[off[i] : off[i + 1]], k)
                if not len(s) or doc_id is None:
                    rows.append((doc_id, len(s), None, None, []))
                    continue
                rows.append((doc_id, len(s), set_name(s, 254), set_name(s, 255), _draws(s, runs, rate)))
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True) if rows else [[]] * 5, schema, strict=True)], schema=schema)

    return docs.mapInArrow(run, "doc_id long, n long, a long, b long, draws array<array<long>>")


def _next_draws(k: int, rate: float):
    """Rows (id, path, above, token) of rows (id, text, paths): each path's own draw of each set."""
    schema = pa.schema([(c, pa.int64()) for c in ("id", "path", "above", "token")])

    def run(batches):
        for batch in batches:
            raw, off = common.utf8_column(batch.column(1))
            rows: list[tuple] = []
            for i, (set_id, own) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                s = shingle_set(raw[off[i] : off[i + 1]], k)
                for x in own:
                    seed = common.mix(np.array([x["path"]], np.int64).view(np.uint64) ^ _SEEDS[253])[0]
                    rows += [(set_id, x["path"], x["above"], token) for token in _drawn(s, seed, rate)]
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (zip(*rows, strict=True) if rows else [[]] * 4)], schema=schema)

    return run


def _split_texts(docs: DataFrame, ids: DataFrame, reps: DataFrame, k: int, scratch: common.Scratch) -> DataFrame:
    """(id, text): one text of each set of ids(id)."""

    def run(batches):
        for batch in batches:
            raw, off = common.utf8_column(batch.column(1))
            # another text under the same doc_id goes
            sets = [shingle_set(raw[off[i] : off[i + 1]], k) for i in range(batch.num_rows)]
            same = [len(s) > 0 and set_name(s, 254) == set_id for s, set_id in zip(sets, batch.column(0).to_pylist(), strict=True)]
            yield batch.filter(pa.array(same, pa.bool_()))

    doc = scratch.written(reps.select("id", F.col("doc").alias("doc_id")).join(ids.distinct(), "id", "left_semi"), "split-ids")
    # few of them: the texts stay where they are
    found = docs.join(doc.hint("broadcast" if doc.count() <= COUNTED else "shuffle_hash"), "doc_id").select("id", "text").mapInArrow(run, "id long, text string")
    return scratch.written(found.groupBy("id").agg(F.min("text").alias("text")), "split")


def _more_draws(texts: DataFrame, k: int, runs: int, more: int, rate: float) -> DataFrame:
    """(id, run, token) of the further runs of texts(id, text)."""
    schema = pa.schema([(c, pa.int64()) for c in ("id", "run", "token")])

    def run(batches):
        for batch in batches:
            raw, off = common.utf8_column(batch.column(1))
            rows: list[tuple] = []
            for i, set_id in enumerate(batch.column(0).to_pylist()):
                s = shingle_set(raw[off[i] : off[i + 1]], k)
                for r in range(runs, runs + more):
                    rows += [(set_id, r, token) for token in _drawn(s, _SEEDS[r], rate)]
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (zip(*rows, strict=True) if rows else [[]] * 3)], schema=schema)

    return texts.mapInArrow(run, "id long, run long, token long").select("id", F.col("run").cast("int").alias("run"), "token")


def _buckets(docs: DataFrame, reps: DataFrame, k: int, runs: int, more: int, rate: float, small: int, depth: int, scratch: common.Scratch) -> DataFrame:
    """(bucket, id, members): the leaves of all paths that hold more than one set."""

    def leaves(level, at):
        """(leaves, paths to split) of one level of paths(id, path, above)."""
        sizes = level.groupBy("path").agg(F.count("*").alias("members"), F.max("above").alias("was")).where("members > 1")
        sized = level.drop("above").join(sizes, "path")
        # a path that holds nine tenths of the sets of the one above is not split again: brute force, in blocks
        leaf = (F.col("members") <= small) | F.lit(at == depth) | (F.coalesce(F.col("members") > 0.9 * F.col("was"), F.lit(False)))
        return sized.where(leaf).select(F.col("path").alias("bucket"), "id", "members"), sized.where(~leaf)

    def first(tokens, name):
        return scratch.written(tokens.select("id", F.xxhash64("run", "token").alias("path"), F.lit(None).cast("long").alias("above")), name)

    tokens = reps.select("id", F.posexplode("draws").alias("run", "tokens")).select("id", "run", F.explode("tokens").alias("token"))
    done, large = leaves(first(tokens, "paths1"), 1)
    if depth == 1:
        return done
    large = scratch.written(large, "large1")
    if large.isEmpty():
        return done
    texts = _split_texts(docs, large.select("id"), reps, k, scratch)
    if more:
        also, larger = leaves(first(_more_draws(texts, k, runs, more, rate), "paths-more"), 1)
        done, large = done.unionByName(also), scratch.written(large.unionByName(larger), "large1")
    for at in range(2, depth + 1):
        own = large.groupBy("id").agg(F.collect_list(F.struct("path", F.col("members").alias("above"))).alias("paths"))
        drawn = texts.join(own, "id").select("id", "text", "paths").mapInArrow(_next_draws(k, rate), "id long, path long, above long, token long")
        level = scratch.written(drawn.select("id", F.xxhash64("path", "token").alias("path"), "above"), f"paths{at}")
        here, large = leaves(level, at)
        done = done.unionByName(here)
        if at < depth:
            large = scratch.written(large, f"large{at}")
            if large.isEmpty():
                break
    return done


def _of_like_sizes(buckets: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """Buckets less the sets that no other one of the bucket comes near in size: similarity is at most the sizes' ratio.

    The nearest in size are the neighbours in order of size, so no pair that could be linked is parted."""
    near = Window.partitionBy("bucket").orderBy("n", "id")
    sized = buckets.join(reps.select("id", "n"), "id").withColumns({"less": F.lag("n").over(near), "more": F.lead("n").over(near)})
    least = threshold * (1 - 1e-6)
    like = (F.coalesce("less", F.lit(0)) >= least * F.col("n")) | F.coalesce(F.col("n") >= least * F.col("more"), F.lit(False))
    return sized.where(like).select("bucket", "id", "members")


def _named_once(buckets: DataFrame) -> DataFrame:
    """Buckets less those that have the same members as another one, their members counted again."""
    h = F.xxhash64("id", F.lit("member"))
    sig = buckets.groupBy("bucket").agg(F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.sum(F.shiftright(h, 16)).alias("s"), F.min("id").alias("lo"))
    kept = sig.groupBy("n", "x", "s", "lo").agg(F.min("bucket").alias("bucket")).select("bucket", F.col("n").alias("members"))
    return buckets.drop("members").join(kept, "bucket").select("bucket", "id", "members")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sorted sets."""
    n = len(sets)
    out = np.zeros((n, n), np.float32)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    heavy = np.flatnonzero(count >= 16)
    for i in range(0, len(heavy), 2048):
        column = np.full(len(count), -1, np.int64)
        mine = heavy[i : i + 2048]
        column[mine] = np.arange(len(mine))
        at = column[code]
        grid = np.zeros((n, len(mine)), np.float32)
        grid[owner[at >= 0], at[at >= 0]] = 1
        out += grid @ grid.T
    order = np.argsort(code, kind="stable")
    of, c = owner[order], count[code[order]]
    for d in range(2, 16):
        held = of[c == d].reshape(-1, d)
        for a in range(d if len(held) else 0):
            for b in range(a + 1, d):
                np.add.at(out, (held[:, a], held[:, b]), 1)
                np.add.at(out, (held[:, b], held[:, a]), 1)
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def _first_met(keys: list[np.ndarray], bucket: int) -> np.ndarray:
    """Pairs that have no bucket in common that is smaller than this one."""
    less = [k[k < bucket] for k in keys]
    return overlaps(less) == 0 if any(map(len, less)) else np.ones((len(keys), len(keys)), bool)


def _roots(linked: np.ndarray) -> np.ndarray:
    """For each place the first place of its connected component."""
    root = np.full(len(linked), -1)
    for i in range(len(linked)):
        if root[i] >= 0:
            continue
        front = np.zeros(len(linked), bool)
        front[i] = True
        seen = front.copy()
        while front.any():
            front = linked[front].any(axis=0) & ~seen
            seen |= front
        root[seen] = i
    return root


def links_of(ids: np.ndarray, sets: list[np.ndarray], keys: list[np.ndarray], blocks: np.ndarray, bucket: int, threshold: float):
    """(ids with links, numbers of links, root of each in this bucket) of one bucket, or of a pair of its blocks."""
    order = np.argsort(ids)
    ids, blocks, sets, keys = ids[order], blocks[order], [sets[i] for i in order], [keys[i] for i in order]
    ok = _first_met(keys, bucket)
    if blocks.min() >= 0:  # a pair of different blocks: only pairs across them
        ok &= blocks[:, None] != blocks[None, :]
    np.fill_diagonal(ok, False)
    some = np.flatnonzero(ok.any(axis=0))
    if not len(some):
        return ids[:0], ids[:0], ids[:0]
    ids, ok, sets = ids[some], ok[np.ix_(some, some)], [sets[i] for i in some]
    size = np.array([len(s) for s in sets], np.float32)
    both = overlaps(sets)
    linked = ok & (both >= threshold * (size[:, None] + size[None, :] - both) * (1 - 1e-6))
    n = linked.sum(axis=1)
    root = ids[_roots(linked)]
    return ids[n > 0], n[n > 0], root[n > 0]


def _pairs_by_bucket(threshold: float):
    def run(batches):
        now, held = None, []

        def close():
            once = list({r[1]: r for r in held}.values())  # repeated rows of a document
            sets = [np.frombuffer(r[4], "<u8") for r in once]
            keys = [np.array(r[3], np.int64) for r in once]
            got = links_of(np.array([r[1] for r in once], np.int64), sets, keys, np.array([r[5] for r in once]), once[0][2], threshold)
            return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in got], ["id", "links", "root"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != now and held:
                    yield close()
                    held = []
                now = row[0]
                held.append(row)
        if held:
            yield close()

    return run


def _send_sets(k: int, small: int):
    """Rows (part, id, bucket, buckets, shingles, block): a set for each part of each of its buckets; block -1 where all pairs count."""
    schema = pa.schema([("part", pa.int64()), ("id", pa.int64()), ("bucket", pa.int64()), ("keys", pa.list_(pa.int64())), ("shingles", pa.binary()), ("block", pa.int32())])

    def run(batches):
        for batch in batches:
            raw, off = common.utf8_column(batch.column(1))
            rows: list[tuple] = []
            for i, (set_id, own) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                s = shingle_set(raw[off[i] : off[i + 1]], k)
                if not len(s) or set_name(s, 254) != set_id:  # another text under the same doc_id
                    continue
                s = s.tobytes()
                keys = sorted(x["bucket"] for x in own)
                for x in own:
                    n = max(1, -(-2 * x["members"] // small)) if x["members"] > small else 1
                    mine = int(common.mix(np.array([set_id], np.int64).view(np.uint64))[0] % np.uint64(n))
                    for other in range(n):
                        lo, hi = min(mine, other), max(mine, other)
                        part = x["bucket"] if n == 1 else int(common.mix(np.array([x["bucket"]], np.int64).view(np.uint64) + np.uint64(lo * n + hi + 1)).view(np.int64)[0])
                        rows.append((part, set_id, x["bucket"], keys, s, -1 if lo == hi else mine))
                if len(rows) >= 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


def _stars(e: DataFrame) -> bool:
    """Whether each u has one v, and no v is a u itself."""
    return e.groupBy("u").count().where("count > 1").isEmpty() and e.select(F.col("v").alias("u")).join(e, "u", "left_semi").isEmpty()


def components(edges: DataFrame, scratch: common.Scratch | None = None) -> DataFrame:
    """(id, root) of edges(id, root): the smallest id of each connected component, by alternating star contraction,
    which goes on until every component is one star."""
    scratch = scratch or common.Scratch(edges.sparkSession, "components")
    e = scratch.written(edges.where("id <> root").select(F.greatest("id", "root").alias("u"), F.least("id", "root").alias("v")).distinct(), "edges")
    while not _stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = scratch.written(large, "stars")
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        e = scratch.written(large.join(small, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.u", "x.v").where("u <> v").distinct(), "edges")
    return e.select(F.col("u").alias("id"), F.col("v").alias("root"))


def _classes(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, recall: float = RECALL, rate: float = RATE, small: int = SMALL, depth: int = DEPTH) -> DataFrame:
    """One row per row of docs(doc_id, text): what join() gives, the set's name (a, b, n), and whether a row of this
    doc_id and set is the one that stays of its class (the smallest doc_id; of its sets there the smallest name)."""
    spark = docs.sparkSession
    common.bound_batches(spark)
    runs, more = runs_for(threshold, recall, rate), more_runs_for(threshold, recall, rate, depth)
    n, scratch = common.partitions(spark), common.Scratch(spark, "jaccard")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = scratch.written(_sets(d, shingle, runs, rate), "sets")
    reps = scratch.written(sets.where("a is not null").groupBy("a", "b", "n").agg(F.min("doc_id").alias("doc"), F.count("*").alias("copies"), F.any_value("draws").alias("draws")).withColumn("id", F.col("a")), "classes")
    buckets = scratch.written(_named_once(_of_like_sizes(_buckets(d, reps, shingle, runs, more, rate, small, depth, scratch), reps, threshold)), "buckets")
    own = buckets.groupBy("id").agg(F.collect_set(F.struct("bucket", "members")).alias("own")).join(reps.select("id", "doc"), "id")
    own = own.select(F.col("doc").alias("doc_id"), "id", "own").hint("shuffle_hash")
    sent = d.join(own, "doc_id").select("id", "text", "own").mapInArrow(_send_sets(shingle, small), "part long, id long, bucket long, keys array<long>, shingles binary, block int")
    met = sent.repartition(2 * n, "part").sortWithinPartitions("part").mapInArrow(_pairs_by_bucket(threshold), "id long, links long, root long")
    met = scratch.written(met, "links")
    links = met.groupBy("id").agg(F.sum("links").alias("links"))
    rooted = reps.select("a", "b", "n", "id", "doc", "copies").join(links, "id", "left").join(components(met, scratch), "id", "left").withColumn("root", F.coalesce("root", "id"))
    first = rooted.groupBy("root").agg(F.min(F.struct("doc", "a", "b", "n")).alias("first"))
    whole = F.struct("doc", "a", "b", "n")
    classes = rooted.join(first, "root").select("a", "b", "n", F.col("first.doc").alias("class_id"), (whole == F.col("first")).alias("leads"), F.coalesce("links", F.lit(0)).alias("n_links"), F.col("copies").alias("n_copies"))
    out = sets.select("doc_id", "a", "b", "n").join(classes, ["a", "b", "n"], "left")
    out = out.select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        F.col("n").alias("n_shingles"), "a", "b", F.coalesce(F.col("leads") & (F.col("doc_id") == F.col("class_id")), F.lit(True)).alias("stays"),
    )
    result = common.written(out, "near-duplicates")
    scratch.clear()
    return result


def join(docs: DataFrame, **options) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, class_id, n_links, n_copies, n_shingles. Options: threshold,
    shingle (words), recall, rate, small, depth; their defaults are this module's constants."""
    return _classes(docs, **options).select("doc_id", "class_id", "n_links", "n_copies", "n_shingles")


def _named(docs: DataFrame, k: int) -> DataFrame:
    """docs with the name of each row's set: __a, __b (null without words), __n."""
    schema = pa.schema([("row", pa.struct([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())]))])

    @F.arrow_udf("struct<a:long,b:long,n:long>")
    def name(text: pa.Array) -> pa.Array:
        raw, off = common.utf8_column(text)
        sets = [shingle_set(raw[off[i] : off[i + 1]], k) for i in range(len(text))]
        names = [pa.array([set_name(s, seed) if len(s) else None for s in sets], pa.int64()) for seed in (254, 255)]
        return pa.StructArray.from_arrays([*names, pa.array([len(s) for s in sets], pa.int64())], fields=list(schema.field("row").type))

    return docs.withColumn("__set", name(F.col("text").cast("string"))).select("*", *(F.col(f"__set.{c}").alias(f"__{c}") for c in "abn")).drop("__set")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """docs less all but one row of each class: the row of the class's smallest doc_id stays.

    Rows without a doc_id, without text and without words all stay. Where rows of different sets share a doc_id, each
    is judged by its own set; of rows of one doc_id and equal sets that are all their class's first, the one of the
    smallest text stays."""
    spark = docs.sparkSession
    common.bound_batches(spark)
    classes = _classes(docs, **options)
    gone = classes.where("not stays")
    # repeated ids are rare: only their rows are told apart by their sets
    repeated = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return docs.join(gone.select("doc_id"), "doc_id", "left_anti").select(docs.columns)
    key = ["doc_id", "__a", "__b", "__n"]
    lone = docs.join(repeated, "doc_id", "left_anti").join(gone.select("doc_id"), "doc_id", "left_anti")
    again = _named(docs.join(repeated, "doc_id", "left_semi"), options.get("shingle", SHINGLE))
    again = again.join(gone.select("doc_id", F.col("a").alias("__a"), F.col("b").alias("__b"), F.col("n_shingles").alias("__n")).distinct(), key, "left_anti")
    first = again.where("__n > 0").groupBy(key).agg(F.min_by(F.struct(*docs.columns), "text").alias("__row")).select("__row.*")
    return lone.select(docs.columns).unionByName(first).unionByName(again.where("__n = 0").select(docs.columns))


def op7_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return join(common.table(spark, sf_dir, "documents"))
