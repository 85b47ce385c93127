"""Language identification by cross-parsing entropy.

Fitting: for each language a bounded sample of labelled text (``sample_docs`` documents with the smallest hashes of
their ids, the first ``doc_chars`` characters of each) is joined and its suffix automaton built: the states and
transitions that accept exactly the strings that occur in it. All labelled languages are learned.

Prediction: the text is parsed with each automaton into phrases, each the longest match from where the last one
ended; a letter that the sample lacks opens a phrase. Few phrases mean that long stretches of the text also occur in the sample: phrases * log2(sample length) /
characters estimates the cross entropy. Samples are cut to the length of the shortest that has at least MIN_SHARE of the
longest, so the phrase count decides; shorter samples stay whole and set no cut (their languages are found as well as
their text allows, with phrases that cost as much as those of the others); ties go to the first language by name. The score is 1 - best / second best, which is 0 where two languages parse alike
and near 1 where one parses far better (1 with a single language).

Each text is parsed as a whole, from its first letter to its last. The work runs on many stretches of STRETCH characters
in step, one numpy lookup for each character of all: a first round parses every stretch as if a phrase began there, a
second one takes each stretch up again in the state in which the one before ended, and stops where its state comes to be
that of the first round, as it soon is; what follows is the same. Characters are lower-cased, and runs of those that are no letters count as one
space. Null texts, and texts without a letter, get ``und`` and a score of 0. If nothing could be learned all do.

The fitted tables (about 2 * sample characters * letters * 4 bytes for each language) go to every executor in blocks of
BLOCK languages, one pass over the documents for each, written between passes, so that memory is bounded; up to BLOCK
languages, documents are predicted where they are scanned. There is no shuffle. Repeated rows get equal
predictions; extra columns are left behind by predict(), and kept by the pipeline.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vecflow.llm import common

SAMPLE_DOCS = 24
DOC_CHARS = 1500
#: Languages whose tables are held at a time.
BLOCK = 64
#: Samples below this share of the longest don't set the length that all are cut to.
MIN_SHARE = 0.5
#: Characters that are parsed in a row, and characters whose states are kept at a time (8 bytes each).
STRETCH = 512
AT_ONCE = 1 << 21
UNKNOWN = "und"


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a string of codes; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p != -1:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and moves[p].get(c) == q:
                    moves[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return moves


class Model:
    """Dense tables: table[language][state, letter] is the next state, or ~(state after a new phrase began)."""

    def __init__(self, samples: dict[str, str], cut: int | None = None):
        self.languages = sorted(samples)
        sizes = [len(_normal(s)) for s in samples.values()]
        self.cut = min((n for n in sizes if n >= MIN_SHARE * max(sizes)), default=0) if cut is None else cut
        self.texts = samples
        self.samples = samples if len(samples) > BLOCK else None
        if self.samples:  # tables come with blocks()
            return
        letters = sorted({c for s in samples.values() for c in _normal(s) if c != " "})
        #: code 0: a letter that no sample holds; 1: space
        self.code = {c: i + 2 for i, c in enumerate(letters)}
        self.tables = []
        for lang in self.languages:
            moves = suffix_automaton([self.code.get(c, 1) for c in _normal(samples[lang])[: self.cut]])
            table = np.full((len(moves), len(letters) + 2), -1, np.int32)
            for s, m in enumerate(moves):
                table[s, list(m)] = list(m.values())
            anew = np.where(table[0] >= 0, ~table[0], ~0)
            self.tables.append(np.where(table >= 0, table, anew[None, :]).astype(np.int32))

    def blocks(self):
        """Models of BLOCK languages at most, in order of names."""
        if not self.samples:
            yield self
            return
        for at in range(0, len(self.languages), BLOCK):
            yield Model({lang: self.samples[lang] for lang in self.languages[at : at + BLOCK]}, self.cut)


def _normal(text: str) -> str:
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


class Parser:
    """Predictions for texts; one for each task."""

    def __init__(self, model: Model):
        self.model = model
        top = 0x250  # Latin letters by table, others one by one
        self.low = np.array([self._code(chr(c)) for c in range(top)], np.int16)
        self.rare: dict[int, int] = {}

    def _code(self, c: str) -> int:
        return self.model.code.get(c, 0) if c.isalpha() else 1

    def codes(self, text: str) -> np.ndarray:
        """Codes of the normalised text; runs of code 1 are cut to one, and none is first or last."""
        u = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        out = np.empty(len(u), np.int16)
        plain = u < len(self.low)
        out[plain] = self.low[u[plain]]
        if not plain.all():
            for i in np.flatnonzero(~plain):
                c = int(u[i])
                if c not in self.rare:
                    if len(self.rare) > 50_000:
                        self.rare.clear()
                    self.rare[c] = self._code(chr(c))
                out[i] = self.rare[c]
        space = out == 1
        keep = ~space
        keep[1:] |= space[1:] & ~space[:-1]
        out = out[keep]
        if len(out) and out[0] == 1:
            out = out[1:]
        return out[:-1] if len(out) and out[-1] == 1 else out

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Numbers of phrases, a row for each text and a column for each language."""
        total = np.zeros((len(texts), len(self.model.tables)), np.int64)
        group: list[tuple[int, int, int]] = []  # (text, from, to) of texts or stretches of texts
        size = 0
        ends: list[dict[int, int]] = [{} for _ in self.model.tables]  # the state of texts that go on in the next group

        def close():
            for k, table in enumerate(self.model.tables):
                ends[k] = self._parse(table, texts, group, ends[k], total[:, k])

        for i, c in enumerate(texts):
            at = 0
            while at < len(c):
                to = min(len(c), at + max(STRETCH, (AT_ONCE - size) // STRETCH * STRETCH))
                group.append((i, at, to))
                size, at = size + to - at, to
                if size >= AT_ONCE:
                    close()
                    group, size = [], 0
        if group:
            close()
        return total

    @staticmethod
    def _parse(table: np.ndarray, texts: list[np.ndarray], group, begun: dict[int, int], total: np.ndarray) -> dict[int, int]:
        """Add the phrases of a group to total. begun: states of texts that go on; returns those after the group."""
        pieces, owner, before = [], [], []
        for i, at, to in group:
            for p in range(at, to, STRETCH):
                before.append(len(pieces) - 1 if p > 0 and owner and owner[-1] == i else -1)
                owner.append(i)
                pieces.append(texts[i][p : min(to, p + STRETCH)])
        flat, width = table.reshape(-1), table.shape[1]
        owner, before = np.array(owner), np.array(before)
        size = np.array([len(p) for p in pieces])
        order = np.argsort(-size, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        longest = int(size.max())
        grid = np.zeros((longest, len(order)), np.int16)
        for j, i in enumerate(order):
            grid[: size[i], j] = pieces[i]
        live = np.searchsorted(-size[order], -np.arange(longest), "left")  # stretches longer than each step
        # first round: each stretch by itself
        states, anew = np.zeros((longest, len(order)), np.int32), np.zeros((longest, len(order)), bool)
        state = np.zeros(len(order), np.int64)
        n = np.zeros(len(order), np.int64)
        for step in range(longest):
            m = live[step]
            to = flat.take(state[:m] * width + grid[step, :m])
            new = to < 0
            state[:m] = np.where(new, ~to, to)
            if not step:
                new[:] = True
            states[step, :m], anew[step, :m] = state[:m], new
            n[:m] += new
        # second round: from the state before, until it is the state of the first round
        last = state.copy()  # by place in the order
        entry = np.full(len(order), -1)
        for j, i in enumerate(order):
            entry[j] = last[rank[before[i]]] if before[i] >= 0 else begun.get(int(owner[i]), -1)
        again = np.flatnonzero(entry >= 0)
        extra = np.zeros(len(order), np.int64)
        follower = np.full(len(order), -1)
        for j, i in enumerate(order):
            if before[i] >= 0:
                follower[rank[before[i]]] = j
        length = size[order]
        while len(again):
            extra[again] = 0
            lanes, now = again, entry[again]
            changed = []
            for step in range(longest):
                over = length[lanes] <= step
                if over.any():  # parsed to its end in a state of its own
                    last_now = now[over]
                    mine = lanes[over]
                    differ = last[mine] != last_now
                    last[mine] = last_now
                    changed.append(mine[differ])
                    lanes, now = lanes[~over], now[~over]
                if not len(lanes):
                    break
                to = flat.take(now * width + grid[step, lanes])
                new = to < 0
                now = np.where(new, ~to, to)
                extra[lanes] += new.astype(np.int64) - anew[step, lanes]
                open_ = now != states[step, lanes]
                if not open_.all():
                    met = lanes[~open_]
                    end = states[length[met] - 1, met]
                    changed.append(met[last[met] != end])
                    last[met] = end
                    lanes, now = lanes[open_], now[open_]
            if len(lanes):
                changed.append(lanes[last[lanes] != now])
                last[lanes] = now
            again = follower[np.concatenate(changed)] if changed else np.zeros(0, np.int64)
            again = np.unique(again[again >= 0])
            behind = before[order[again]]
            entry[again] = last[rank[behind]]
        np.add.at(total, owner[order], n + extra)
        return {i: int(last[rank[len(pieces) - 1]]) for i, _, to in group[-1:] if to < len(texts[i])}

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        coded = [self.codes(t) if t else np.zeros(0, np.int16) for t in texts]
        n = self.phrases(coded)
        langs, scores = [], []
        for c, row in zip(coded, n, strict=True):
            if not len(c) or not len(row):
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            best = int(np.argmin(row))
            rest = np.delete(row, best)
            langs.append(self.model.languages[best])
            scores.append(float(1 - row[best] / rest.min()) if len(rest) else 1.0)
        return langs, scores


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, doc_chars: int = DOC_CHARS) -> Model:
    """Model of labelled docs(doc_id, text, lang). Ids choose the sample, and are no input of a prediction."""
    some = docs.where("lang is not null and text is not null and length(trim(text)) > 0")
    key, own = F.xxhash64(F.col("doc_id").cast("string"), F.lit("langid")), F.xxhash64("text")
    # the filter on the rank keeps sample_docs rows of a language in each task before anything is shuffled
    order = Window.partitionBy("lang").orderBy("k", "doc_id", "h")
    ranked = some.select("lang", "doc_id", key.alias("k"), own.alias("h")).distinct().withColumn("r", F.row_number().over(order)).where(F.col("r") <= sample_docs)
    chosen = ranked.select("doc_id", "h").collect()
    # ids may repeat: the text's hash keeps the rows to sample_docs a language
    mine = F.col("doc_id").isin([r["doc_id"] for r in chosen]) & own.isin([r["h"] for r in chosen])
    rows = some.where(mine).select("lang", "doc_id", F.substring("text", 1, doc_chars).alias("t")).distinct().collect() if chosen else []
    samples: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], zlib.crc32(str(r["doc_id"]).encode()), r["t"])):
        samples.setdefault(r["lang"], []).append(r["t"])
    joined = {lang: " ".join(t[:sample_docs]) for lang, t in samples.items()}
    return Model({lang: t for lang, t in joined.items() if _normal(t)})


def _by_blocks(docs: DataFrame, model: Model) -> tuple[DataFrame, Column, Column]:
    """(docs and working columns, prediction, score) for models of more than one block."""
    names, tag = docs.columns, uuid.uuid4().hex
    at, extra = names.index("text"), [f"best_{tag}", f"second_{tag}", f"lang_{tag}"]
    schema = StructType(list(docs.schema)).add(extra[0], "long").add(extra[1], "long").add(extra[2], "string")

    def fold(sent):
        def run(batches):
            parser = Parser(sent.value)
            for batch in batches:
                coded = [parser.codes(t) if t else np.zeros(0, np.int16) for t in batch.column(at).to_pylist()]
                before = [c.to_pylist() for c in batch.columns[len(names) :]] or [[None] * len(coded)] * 3
                rows: list[tuple] = []
                for c, row, best, second, lang in zip(coded, parser.phrases(coded).tolist(), *before, strict=True):
                    for n, name in zip(row if len(c) else [], sent.value.languages, strict=False):
                        if best is None or n < best:
                            best, second, lang = n, best, name
                        elif second is None or n < second:
                            second = n
                    rows.append((best, second, lang))
                more = [pa.array(v, t) for v, t in zip(zip(*rows, strict=True) if rows else [[]] * 3, (pa.int64(), pa.int64(), pa.string()), strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *more], [*names, *extra])

        return run

    for block in model.blocks():
        sent = docs.sparkSession.sparkContext.broadcast(block)
        docs = common.written(docs.mapInArrow(fold(sent), schema), "languages")
        sent.unpersist()
    best, second, lang = map(F.col, extra)
    score = F.when(best.isNull(), F.lit(0.0)).when(second.isNull(), F.lit(1.0)).otherwise(1 - best / second)
    return docs, F.coalesce(lang, F.lit(UNKNOWN)), score


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """docs(doc_id, text, ...) with lang_pred and score after its own columns."""
    spark = docs.sparkSession
    common.bound_batches(spark)
    if model.samples:
        parsed, lang, score = _by_blocks(docs, model)
        return parsed.select(*(F.col(f"`{c}`") for c in docs.columns), lang.alias("lang_pred"), score.alias("score"))
    sent = spark.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index("text")

    def run(batches):
        parser = Parser(sent.value)
        for batch in batches:
            langs, scores = parser.predict(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*names, "lang_pred", "score"])

    schema = StructType(list(docs.schema)).add("lang_pred", "string").add("score", "double")
    return docs.mapInArrow(run, schema)


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """docs less the rows whose language is ``und``, with lang (where there is such a column) set to the prediction.

    All columns stay in place, whatever their names."""
    spark = docs.sparkSession
    common.bound_batches(spark)
    if model.samples:
        parsed, found, _ = _by_blocks(docs, model)
        return parsed.where(found != UNKNOWN).select(*(found.cast(docs.schema[c].dataType).alias(c) if c == "lang" else F.col(f"`{c}`") for c in docs.columns))
    sent = spark.sparkContext.broadcast(model)
    names = docs.columns
    at, lang = names.index("text"), names.index("lang") if "lang" in names else None

    def run(batches):
        parser = Parser(sent.value)
        for batch in batches:
            got, _ = parser.predict(batch.column(at).to_pylist())
            columns = list(batch.columns)
            if lang is not None:
                columns[lang] = pa.array(got, pa.string()).cast(columns[lang].type)
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array([g != UNKNOWN for g in got], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    out = predict(docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
