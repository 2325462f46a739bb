"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

The lexicon is learnt from labelled documents: words and word beginnings that stand in toxic documents far more often
than chance allows, weighted by their log odds. Before matching, letters that look alike and digits or signs that
stand for letters are folded, so ``1d10t`` and ``idiot`` spelt with foreign letters are the same word. A hit inside an exception
phrase does not count; such phrases are learnt from harmless documents that an entry hits. The score is a logistic function of the weight found and of that weight by length.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import column_of, prepare, slices, text_of

# Cyrillic and Greek letters that look like Latin ones, then digits and signs that stand for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "е": "e", "ё": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ѕ": "s",
    "т": "t", "у": "y", "х": "x", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
#: Labelled documents that the lexicon is learnt from, at most: those least by hash of the id.
SAMPLE = 20_000
#: Phrases in which a word of the lexicon is harmless, besides those that are learnt.
EXCEPTIONS = ("trash can", "trash bin", "class clown", "pond scum", "circus clown")
#: Lengths of word beginnings that may enter the lexicon.
STEMS = (4, 5, 6, 7, 8)
#: Evidence that an entry needs: likelihood ratio statistic, and toxic documents that hold it.
EVIDENCE, SUPPORT = 15.0, 3


def folded(text: str) -> str:
    """Lower case, look-alike letters and compatible forms made plain, joined by single spaces, one at either end.

    Digits and signs inside a word that also has a letter become letters; marks at the ends of a word go first, so
    ``idiot!`` stays ``idiot``. Invisible characters are left out.
    """
    text = unicodedata.normalize("NFKC", text).lower() if not text.isascii() else text.lower()
    if not text.isascii():
        text = text.translate(_LETTERS)
    words = []
    for word in text.split():
        if not word.isalpha():
            word = _ENDS.sub("", word)
            if not word.isalpha() and any(map(str.isalpha, word)):
                word = word.translate(_SIGNS)
                word = "".join(filter(str.isalpha, word)) if not word.isalpha() and "-" not in word else word
        words.append(word)
    return " " + " ".join(words) + " "


_LETTERS = {**{ord(k): v for k, v in HOMOGLYPHS.items()}, **dict.fromkeys(map(ord, "​‌‍⁠﻿­"), None)}
_SIGNS = {ord(k): v for k, v in DIGITS.items()}
# marks around a word; a sign that may stand for a first letter stays
_ENDS = re.compile(r"^(?:(?![@$])[\W_])+|[\W_]+$")


@dataclass
class Lexicon:
    """entries: text to find (a space before, and after unless it is a beginning) and its weight; curve: the score.

    score = 1 / (1 + exp(-(a + b * ln(1 + s) + c * s / sqrt(n)))) for weight s found in n words."""

    entries: dict[str, float]
    curve: tuple[float, float, float] = (-3.0, 2.0, 1.0)
    exceptions: tuple[str, ...] = field(default=EXCEPTIONS)

    def automaton(self) -> ahocorasick.Automaton:
        built = ahocorasick.Automaton()
        for phrase in self.exceptions:
            built.add_word(f" {phrase} ", (0.0, len(phrase) + 2))
        for entry, weight in self.entries.items():
            built.add_word(entry, (weight, len(entry)))
        built.make_automaton()
        return built


def found_weight(automaton: ahocorasick.Automaton, text: str) -> tuple[float, int]:
    """Weight of all hits and number of words. Of hits at the same word the heaviest counts; exceptions cover theirs."""
    plain = folded(text)
    n = plain.count(" ") - 1 if len(plain) > 2 else 0
    if not len(automaton):
        return 0.0, n
    best: dict[int, float] = {}
    harmless: list[tuple[int, int]] = []
    for end, (weight, size) in automaton.iter(plain):
        start = end - size + 1
        if weight == 0.0:
            harmless.append((start, end))
        elif weight > best.get(start, 0.0):
            best[start] = weight
    for a, b in harmless:
        for start in [s for s in best if a <= s < b]:
            del best[start]
    return sum(best.values()), n


def features(plain: str) -> set[str]:
    """Words and word beginnings of a folded text, marked as entries of a lexicon are."""
    out = set()
    for word in set(plain.split()):
        if len(word) > 2:
            out.add(f" {word} ")
            out.update(f" {word[:n]}" for n in STEMS if len(word) > n)
    return out


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            got, toxic = [], []
            for text, label in zip(column_of(part, "text").to_pylist(), column_of(part, "toxic").to_pylist()):
                some = features(folded(text or ""))
                got += some
                toxic += [label] * len(some)
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.string()), pa.array(toxic, pa.int32())], ["entry", "toxic"])


def phrases(automaton: ahocorasick.Automaton, plain: str) -> set[str]:
    """Each word of a folded text that an entry hits, with the word before it and with the word after it."""
    words = plain[1:-1].split(" ")  # a word that was all marks is empty
    # places of the spaces before the words, where entries begin
    at = {k: i for i, k in enumerate(k for k, c in enumerate(plain[:-1]) if c == " ")}
    hit = sorted({at[end - size + 1] for end, (_, size) in automaton.iter(plain) if end - size + 1 in at} if len(automaton) else set())
    pairs = [(i - 1, i) for i in hit if i] + [(i, i + 1) for i in hit if i + 1 < len(words)]
    return {f"{words[a]} {words[b]}" for a, b in pairs if words[a] and words[b]}


def _phrases(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            for part in slices(batch, "text"):
                got, toxic = [], []
                for text, label in zip(column_of(part, "text").to_pylist(), column_of(part, "toxic").to_pylist()):
                    some = phrases(automaton, folded(text or ""))
                    got += some
                    toxic += [label] * len(some)
                yield pa.RecordBatch.from_arrays([pa.array(got, pa.string()), pa.array(toxic, pa.int32())], ["phrase", "toxic"])

    return run


def _harmless(texts: DataFrame, lexicon: Lexicon) -> list[str]:
    """Phrases around an entry that stand in harmless documents only, and in too many of them for that to be chance.

    Chance is the share of toxic documents among all that an entry hits."""
    hits = texts.mapInArrow(_weighed(replace(lexicon, exceptions=()), ["toxic"], False), "toxic int, weight double, words bigint").filter("weight > 0")
    toxic, n = hits.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
    if not n or toxic == n:
        return []
    tally = texts.select("text", "toxic").mapInArrow(_phrases(lexicon), "phrase string, toxic int").groupBy("phrase")
    tally = tally.agg(F.sum("toxic").alias("a"), F.count("*").alias("n")).filter(F.col("a") == 0)
    evidence = -2 * F.col("n") * math.log(max(1 - toxic / n, 1e-9))
    return [r["phrase"] for r in tally.filter((F.col("n") >= SUPPORT) & (evidence >= EVIDENCE)).collect()]


def _weighed(lexicon: Lexicon, keep: list[str], score: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        a, b, c = lexicon.curve
        for batch in batches:
            got = [found_weight(automaton, t or "") for t in column_of(batch, "text").to_pylist()]
            s = np.array([x for x, _ in got], float)
            n = np.array([x for _, x in got], float)
            z = a + b * np.log1p(s) + c * s / np.sqrt(np.maximum(n, 1))
            columns = [column_of(batch, k) for k in keep]
            more = [pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))] if score else [pa.array(s), pa.array(n.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns + more, keep + (["score"] if score else ["weight", "words"]))

    return run


def _curve(s: np.ndarray, n: np.ndarray, y: np.ndarray, cut: float) -> tuple[float, float, float]:
    """Logistic regression with a little shrinkage, shifted so that the best place to decide lies at ``cut``."""
    x = np.column_stack([np.ones(len(s)), np.log1p(s), s / np.sqrt(np.maximum(n, 1))])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (y - p) - np.array([0, 0.1, 0.1]) * w
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-6, 0.1, 0.1])
        step = np.linalg.solve(h, g)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    z = x @ w
    order = np.argsort(-z, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(z) + 1) + y.sum())
    f1[:-1][z[order][:-1] == z[order][1:]] = -1
    k = int(np.argmax(f1))
    border = (z[order][k] + z[order][k + 1]) / 2 if k + 1 < len(z) else z[order][k] - 1e-6
    w[0] += math.log(cut / (1 - cut)) - border
    return tuple(float(v) for v in w)


def learn(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", cut: float = 0.3, sample: int = SAMPLE
) -> Lexicon:
    """A lexicon from labelled documents, of which the ``sample`` least by hash of the id are used.

    Rows without id or label do not count; of rows of equal ids the greatest label does. Without toxic and harmless
    documents the lexicon is empty and every score is that of a text without hits.
    """
    prepare(docs.sparkSession)
    known = labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("toxic")).dropna()
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic")).filter("toxic in (0, 1)")
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(sample)
    # bounded by ``sample`` rows of two numbers
    texts = docs.select(F.col(key).alias("id"), text_of(text).alias("text")).join(F.broadcast(chosen), "id")
    counts = {r["toxic"]: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    bad, good = counts.get(1, 0), counts.get(0, 0)
    if not bad or not good:
        return Lexicon({})
    rows = texts.select("text", "toxic").mapInArrow(_features, "entry string, toxic int")
    tally = rows.groupBy("entry").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).filter(F.col("a") >= SUPPORT)
    base = bad / (bad + good)
    part = F.col("a") / (F.col("a") + F.col("b"))
    against = F.when(F.col("b") > 0, F.col("b") * F.log((1 - part) / (1 - base))).otherwise(0.0)
    ratio = 2 * (F.col("a") * F.log(part / base) + against)
    strong = tally.filter((part > 0.5) & (ratio >= EVIDENCE)).collect()  # as many as the sample supports
    weights = {r["entry"]: math.log((r["a"] + 0.5) / (bad + 1)) - math.log((r["b"] + 0.5) / (good + 1)) for r in strong}
    lexicon = Lexicon({e: w for e, w in weights.items() if w > 0}, exceptions=())
    lexicon.exceptions = tuple(sorted({*EXCEPTIONS, *_harmless(texts, lexicon)}))
    seen = texts.select("toxic", "text").mapInArrow(_weighed(lexicon, ["toxic"], False), "toxic int, weight double, words bigint").toPandas()
    if len(seen):  # labels may be of documents that are not there
        lexicon.curve = _curve(seen["weight"].to_numpy(), seen["words"].to_numpy(), seen["toxic"].to_numpy(), cut)
    return lexicon


def toxicity(docs: DataFrame, lexicon: Lexicon, keep: list[str] = ["doc_id"], text: str = "text") -> DataFrame:  # noqa: B006
    """The kept columns and ``score`` (0 to 1) of every row. Null texts are empty; texts without hits share one score."""
    prepare(docs.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    plain = docs.select(*keep, text_of(text).alias("text")) if "text" not in keep else docs.withColumn("text", text_of(text)).select(*keep)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), "score double"])
    return plain.mapInArrow(_weighed(lexicon, list(keep), True), schema)
