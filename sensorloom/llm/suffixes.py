"""Passages that repeat across documents, by a sparse suffix array.

Suffixes are kept at content-selected places only: the minimisers, that is the least hash in every window of word runs.
Each run of ``least`` words belongs to the minimiser of its inner word runs, which equal runs choose alike wherever they
stand. Places whose nearest words (the core) occur in one document only go at once. The runs of the others are compared
exactly: least and greatest document of each are combined in every task, so no group has to fit a task, and a run that
several documents hold marks its words in all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import column_of, prepare, slices, text_of
from sensorloom.llm.tokens import Words, grams, ramp, words
from sensorloom.session import written


@dataclass(frozen=True)
class Passage:
    """least: words of the shortest passage. A place is the least of ``window`` runs of ``gram`` words; its core are the
    ``before`` words before it and ``after`` words from it on. before + after + window - 1 <= least, gram <= after."""

    least: int = 50
    window: int = 32
    gram: int = 6
    before: int = 4
    after: int = 15


def places(w: Words, rule: Passage) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Minimisers of all runs of ``rule.least`` words: word index (in the batch), text, hash of the core, word index of the
    first run that belongs to it, and how many do: these follow each other, at most ``rule.window`` of them."""
    every = grams(w.hashes, rule.gram)
    cores = grams(w.hashes, rule.before + rule.after)
    owner = w.owners()
    chosen = []
    # leftmost least among the word runs of each run whose core is inside of it
    for i in np.flatnonzero(w.counts() >= rule.least):
        a, b = w.offsets[i], w.offsets[i + 1] - rule.least + 1
        view = np.lib.stride_tricks.sliding_window_view(every[a + rule.before : b + rule.before + rule.window - 1], rule.window)
        for c in range(0, len(view), 1 << 15):
            part = view[c : c + (1 << 15)]
            chosen.append(a + rule.before + c + part.argmin(axis=1) + np.arange(len(part)))
    if not chosen:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 2
    of_run = np.concatenate(chosen)
    runs = np.flatnonzero(w.counts() >= rule.least)
    many = w.counts()[runs] - rule.least + 1
    start = np.repeat(w.offsets[runs], many) + ramp(many)
    new = np.flatnonzero(np.append(True, of_run[1:] != of_run[:-1]))
    p, first = of_run[new], start[new]
    return p, owner[p], cores[p - rule.before], first, np.diff(np.append(new, len(of_run)))


def _places(rule: Passage):
    """Cores of all places; ``spot`` packs first run, distance of the core from it, and number of runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w = words(column_of(part, "text"))
                p, of, core, first, many = places(w, rule)
                spot = ((first - w.offsets[of]) << 16) | ((p - rule.before - first) << 8) | many
                yield pa.RecordBatch.from_arrays([pa.array(core.view(np.int64)), column_of(part, "id").take(pa.array(of)), pa.array(spot)], ["core", "id", "spot"])

    return run


def _runs(rule: Passage):
    """Hashes of the runs of the wanted places, with 32 bits of the core: 96 bits tell runs apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w = words(column_of(part, "text"))
                cores = (grams(w.hashes, rule.before + rule.after) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                whole = grams(w.hashes, rule.least).view(np.int64)
                wanted = column_of(part, "wanted")
                size = np.asarray(pa.compute.list_value_length(wanted)).astype(np.int64)
                spot, of = wanted.flatten().to_numpy(), np.repeat(np.arange(len(size)), size)
                begin, core_at, many = spot >> 16, (spot >> 8) & 255, spot & 255
                first = w.offsets[of] + begin
                # rows that share an id may hold other texts
                ok = first + many - 1 + rule.least <= w.offsets[of + 1]
                of, begin, core_at, many, first = of[ok], begin[ok], core_at[ok], many[ok], first[ok]
                flat = whole[np.repeat(first, many) + ramp(many)]
                ends = np.concatenate([[0], np.cumsum(many)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        column_of(part, "id").take(pa.array(of)), pa.array(begin.astype(np.int32)), pa.array(cores[first + core_at]),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    ],
                    ["id", "begin", "core", "runs"],
                )

    return run


def _merged(begins: np.ndarray, least: int) -> list[dict]:
    """Spans of the runs that begin at the places given; runs that overlap or touch are one."""
    if not len(begins):
        return []
    begins = np.unique(begins)
    new = np.flatnonzero(np.append(True, np.diff(begins) > least))
    last = np.append(new[1:], len(begins)) - 1
    return [{"begin": a, "end": b + least} for a, b in zip(begins[new].tolist(), begins[last].tolist())]


_SPANS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))


def _by_document(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = column_of(batch, "marks")
            at = np.append(0, np.cumsum(np.asarray(pa.compute.list_value_length(column))))
            marks = column.flatten().to_numpy()
            own = [marks[a:b] for a, b in zip(at, at[1:])]
            found = [_merged(m >> 1, least) for m in own]
            cut = [_merged(m[m & 1 == 1] >> 1, least) for m in own]
            yield pa.RecordBatch.from_arrays([column_of(batch, "id"), pa.array(found, _SPANS), pa.array(cut, _SPANS)], ["id", "repeated", "removable"])

    return run


def repeated_passages(docs: DataFrame, rule: Passage = Passage(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents with a passage of ``rule.least`` words or more that also stands in another document; clean ones have no row.

    Columns: the id, ``repeated`` (all such passages) and ``removable`` (those that a document of smaller id has
    too, so that one copy of each stays), both arrays of (begin, end) in words, merged where they overlap or touch;
    repeated_words and removable_words. Repeats within one document alone do not count; rows that share an id are one
    document. Null and short texts have no passage; rows without an id are left out (nothing could refer to them).
    Other columns are left alone; an empty
    table gives an empty one.
    """
    prepare(docs.sparkSession)
    plain = docs.select(F.col(key).cast("bigint").alias("id"), text_of(text).alias("text")).filter("id is not null")
    found = plain.mapInArrow(_places(rule), "core bigint, id bigint, spot bigint")
    # sums and extremes are combined in each task before the exchange, so a passage that is everywhere is one row a task
    extremes = (F.min("id").alias("lo"), F.max("id").alias("hi"))
    cores = found.groupBy("core").agg(*extremes).filter("lo != hi")
    # written, so that both sides of the join are dealt out anew and the places of a frequent core can be split over tasks
    cores = written(cores.select("core"), "cores")
    wanted = written(found.join(cores, "core").groupBy("id").agg(F.collect_list("spot").alias("wanted")), "places")
    around = plain.join(wanted, "id").select("id", "text", "wanted").mapInArrow(_runs(rule), "id bigint, begin int, core int, runs array<bigint>")
    around = written(around, "runs")
    runs = around.select("id", "begin", "core", F.posexplode("runs").alias("at", "run"))
    shared = runs.groupBy("core", "run").agg(*extremes).filter("lo != hi").select("core", "run", "lo")
    shared = written(shared, "shared")
    mark = F.shiftleft(F.col("begin") + F.col("at"), 1) + F.when(F.col("lo") < F.col("id"), 1).otherwise(0)
    marks = runs.join(shared, ["core", "run"]).select("id", mark.cast("int").alias("mark"))
    spans = marks.groupBy("id").agg(F.collect_list("mark").alias("marks"))
    kind = "array<struct<begin:int,end:int>>"
    merged = spans.mapInArrow(_by_document(rule.least), f"id bigint, repeated {kind}, removable {kind}")
    length = lambda c: F.aggregate(c, F.lit(0), lambda a, s: a + s["end"] - s["begin"])
    return merged.select(
        F.col("id").alias(key), "repeated", "removable", length("repeated").alias("repeated_words"), length("removable").alias("removable_words")
    )


def _cut(columns: list[str], text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = words(column_of(batch, text))
            raw = [t.as_buffer().to_pybytes() if t.is_valid else None for t in column_of(batch, text)]
            out = []
            for i, spans in enumerate(column_of(batch, "_cuts").to_pylist()):
                if not spans or raw[i] is None:
                    out.append(raw[i].decode() if raw[i] is not None else None)
                    continue
                base, a, b = w.bytes[i], w.offsets[i], w.offsets[i + 1]
                kept, at = [], 0
                for s in spans:
                    if a + s["end"] > b:  # rows that share an id may hold other texts
                        continue
                    kept.append(raw[i][at : w.starts[a + s["begin"]] - base])
                    at = w.ends[a + s["end"] - 1] - base
                kept.append(raw[i][at:])
                parts = [k.decode().strip() for k in kept]
                out.append(" ".join(p for p in parts if p))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if c == text else column_of(batch, c) for c in columns], columns)

    return run


def without_repeats(docs: DataFrame, rule: Passage = Passage(), key: str = "doc_id", text: str = "text", length: str = "n_chars") -> DataFrame:
    """All documents with their columns; removable passages are cut out of the text, and ``length`` (if there) follows.

    Documents without such a passage keep their text as it is. Where one was cut, the pieces left are trimmed and joined
    by a space; a text that was all passage is empty.
    """
    prepare(docs.sparkSession)
    found = repeated_passages(docs, rule, key, text).filter("removable_words > 0")
    cuts = written(found.select(F.col(key).alias("_key"), F.col("removable").alias("_cuts")), "cuts")
    with_cuts = docs.join(cuts, docs[key] == F.col("_key"), "left").drop("_key")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    out = with_cuts.mapInArrow(_cut(docs.columns, text), schema)
    return out.withColumn(length, F.char_length(text).cast(docs.schema[length].dataType)) if length in docs.columns else out
