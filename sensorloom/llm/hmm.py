"""A hidden Markov language model, trained by Baum-Welch over all documents.

Frequent words are symbols of their own; all other words belong to one of a fixed number of classes by their ending
and length, and have a probability within their class from their count. So the model's tables have a size that does
not depend on the data, while the counts of words grow with it.

Training: word counts; counts of which symbol follows which, from which symbols are grouped into first states; then
rounds of Baum-Welch, whose expected counts are summed in each task and then across tasks. Scoring: the forward
recursion with scaling gives the exact likelihood of a whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import column_of, prepare, slices, text_of
from sensorloom.llm.tokens import Words, mix, words
from sensorloom.session import written

#: The token that ends every text.
END = np.uint64(0x0E0D0E0D0E0D0E0D)
#: Bytes of text that are worked on at once, in training and in scoring.
PIECE, SCORED = 2 << 20, 4 << 20
#: Bytes of text whose words are looked up together.
CHUNK_BYTES = 16 << 20
#: Training runs over segments of this many tokens; scoring does not cut texts.
SEGMENT = 256
#: Words that a task counts before it hands its counts on.
HELD_WORDS = 1_500_000


@dataclass(frozen=True)
class Shape:
    """states; frequent words with a symbol of their own; classes of the others; rounds of Baum-Welch; columns of the
    table that the first states come from; weight of the overall distribution when a state's is estimated."""

    states: int = 8
    frequent: int = 4096
    classes: int = 1024
    rounds: int = 2
    following: int = 64
    prior: float = 5.0


@dataclass
class Vocabulary:
    """Frequent words by hash (sorted) with their symbols and counts; totals of all; totals and types of classes."""

    hashes: np.ndarray
    symbols: np.ndarray
    counts: np.ndarray
    tokens: int
    types: int
    class_tokens: np.ndarray
    class_types: np.ndarray

    def base(self, count: np.ndarray) -> np.ndarray:
        """log10 of the smoothed share of a word with that count."""
        return np.log10((count + 0.1) / (self.tokens + 0.1 * (self.types + 1)))


@dataclass
class Model:
    vocabulary: Vocabulary
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # symbols x states


def endings(w: Words, classes: int) -> np.ndarray:
    """Class of each word: by its last two bytes and whether it is short, middling or long."""
    last = w.data[w.ends - 1].astype(np.uint64)
    size = w.ends - w.starts
    prior = np.where(size > 1, w.data[np.maximum(w.ends - 2, 0)], 0).astype(np.uint64)
    span = np.digitize(size, [4, 8]).astype(np.uint64)
    return (mix(last | prior << np.uint64(8) | span << np.uint64(16)) % np.uint64(classes)).astype(np.int64)


def with_ends(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Place of every word and of every end in the token sequences of all texts, one end a text."""
    count = w.counts()
    at = w.offsets + np.arange(len(w.offsets))
    return np.arange(len(w.hashes)) + np.repeat(np.arange(len(count)), count), at


def symbols(w: Words, v: Vocabulary, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all tokens, offsets of the texts in them, and for each word whether it is a frequent one.

    Symbol 0 is the end, then come the frequent words, then the classes."""
    spot, at = with_ends(w)
    found = np.searchsorted(v.hashes, w.hashes)
    found[found == len(v.hashes)] = 0
    known = v.hashes[found] == w.hashes if len(v.hashes) else np.zeros(len(w.hashes), bool)
    own = 1 + shape.frequent + endings(w, shape.classes)
    if len(v.hashes):
        own = np.where(known, 1 + v.symbols[found], own)
    out = np.zeros(at[-1], np.int64)
    out[spot] = own
    return out, at, known


def _counted(shape: Shape):
    """Counts of the words of all batches, handed on when many are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def merged() -> tuple:
            h, c, k = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(h, kind="stable")
            h, c, k = h[order], c[order], k[order]
            first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
            return h[first], np.add.reduceat(c, first) if len(h) else c, k[first]

        def out() -> pa.RecordBatch:
            h, c, k = held[0]
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c), pa.array(k.astype(np.int32))], ["word", "c", "class"])

        for batch in batches:
            for part in slices(batch, "text", PIECE):
                w = words(column_of(part, "text"))
                h, first, c = np.unique(w.hashes, return_index=True, return_counts=True)
                held.append((np.append(h, END), np.append(c, part.num_rows), np.append(endings(w, shape.classes)[first], -1)))
                size += len(h) + 1
                if size > HELD_WORDS:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > HELD_WORDS // 2:
                        yield out()
                        held, size = [], 0
        if held:
            held = [merged()]
            yield out()

    return run


def _vocabulary(counts: DataFrame, shape: Shape) -> Vocabulary:
    """What every task gets of the counts: a fixed number of rows, whatever the data."""
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    top = counts.filter(F.col("class") >= 0).orderBy(F.desc("c"), "word").limit(shape.frequent).toPandas()
    sent = F.broadcast(counts.sparkSession.createDataFrame([(int(x),) for x in top["word"]], "word bigint"))
    rest = counts.filter(F.col("class") >= 0).join(sent, "word", "left_anti")
    by_class = rest.groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("v")).toPandas()
    tokens, types = np.zeros(shape.classes), np.zeros(shape.classes)
    tokens[by_class["class"]], types[by_class["class"]] = by_class["c"], by_class["v"]
    hashes = top["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Vocabulary(hashes[order], order.astype(np.int64), top["c"].to_numpy(np.int64)[order], int(total["n"] or 0), int(total["v"]), tokens, types)


def _overall(v: Vocabulary, shape: Shape, ends: int) -> np.ndarray:
    """Smoothed share of every symbol."""
    own = np.zeros(shape.frequent)
    own[v.symbols] = v.counts
    share = np.concatenate([[ends], own, v.class_tokens]) + 0.1
    return share / share.sum()


def _summed(tables: DataFrame, size: int) -> np.ndarray:
    """The tables of all tasks (spot, value) as one array of a fixed size."""
    rows = tables.groupBy("spot").agg(F.sum("value").alias("value")).toPandas()
    out = np.zeros(size)
    out[rows["spot"].to_numpy()] = rows["value"]
    return out


def _table(values: np.ndarray) -> pa.RecordBatch:
    spot = np.flatnonzero(values)
    return pa.RecordBatch.from_arrays([pa.array(spot), pa.array(values[spot].astype(float))], ["spot", "value"])


def _followers(v: Vocabulary, shape: Shape, size: int):
    """How often each symbol stands before and after the most frequent ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = np.zeros(2 * size * shape.following)
        for batch in batches:
            for part in slices(batch, "text", PIECE):
                s, at, _ = symbols(words(column_of(part, "text")), v, shape)
                inner = np.ones(len(s), bool)
                inner[at[1:] - 1] = False
                a, b = s[:-1][inner[:-1]], s[1:][inner[:-1]]
                for one, other, half in ((a, b, 0), (b, a, 1)):
                    ok = other < shape.following
                    key = one[ok] * shape.following + other[ok]
                    near[half * size * shape.following :][: size * shape.following] += np.bincount(key, minlength=size * shape.following)
        yield _table(near)

    return run


def first_states(near: np.ndarray, share: np.ndarray, states: int) -> np.ndarray:
    """A state for every symbol, by what stands next to it: k-means on the leading directions, seeded far apart."""
    size = len(share)
    both = np.concatenate([near[0], near[1]], axis=1)
    total = both.sum(axis=1, keepdims=True)
    expected = both.sum(axis=0, keepdims=True) / max(both.sum(), 1)
    x = np.sqrt((both + expected * 10) / (total + 10))
    x -= np.sqrt(expected)
    weight = np.sqrt(share)
    _, _, axes = np.linalg.svd((x * weight[:, None]).T @ (x * weight[:, None]))
    x = x @ axes[: 2 * states].T
    centre = x[[int(np.argmax(share))]]
    while len(centre) < states:
        far = ((x[:, None] - centre[None]) ** 2).sum(axis=2).min(axis=1)
        centre = np.vstack([centre, x[int(np.argmax(far * share))]])
    for _ in range(30):
        own = ((x[:, None] - centre[None]) ** 2).sum(axis=2).argmin(axis=1)
        for k in range(states):
            inside = own == k
            if inside.any():
                centre[k] = np.average(x[inside], axis=0, weights=share[inside])
    return own[:size]


def _layout(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the sequences by length, longest first, and how many reach each step."""
    order = np.argsort(-lengths, kind="stable")
    reach = np.searchsorted(-lengths[order], -np.arange(1, lengths.max() + 1), side="right") if len(lengths) else np.zeros(0, int)
    return order, reach


def forward(s: np.ndarray, starts: np.ndarray, lengths: np.ndarray, m: Model) -> np.ndarray:
    """Natural log of the likelihood of every sequence of symbols, all of one token or more."""
    order, reach = _layout(lengths)
    at = starts[order]
    out = np.zeros(len(lengths))
    alpha = np.tile(m.start, (len(lengths), 1))
    for t, n in enumerate(reach):
        alpha = (alpha[:n] @ m.move if t else alpha[:n]) * m.emit[s[at[:n] + t]]
        scale = alpha.sum(axis=1)
        alpha /= scale[:, None]
        out[:n] += np.log(scale)
    result = np.empty(len(lengths))
    result[order] = out
    return result


def expected(s: np.ndarray, starts: np.ndarray, lengths: np.ndarray, m: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts of first states, moves, and symbols by state (Baum-Welch, scaled)."""
    order, reach = _layout(lengths)
    at = starts[order]
    k = len(m.start)
    alphas, scales = [], []
    alpha = np.tile(m.start, (len(lengths), 1))
    for t, n in enumerate(reach):
        alpha = (alpha[:n] @ m.move if t else alpha[:n]) * m.emit[s[at[:n] + t]]
        scale = alpha.sum(axis=1, keepdims=True)
        alpha = alpha / scale
        alphas.append(alpha)
        scales.append(scale)
    move, emit = np.zeros((k, k)), np.zeros((len(m.emit), k))
    seen, gammas = [], []
    beta = np.ones((0, k))
    for t in range(len(reach) - 1, -1, -1):
        n = reach[t]
        after = len(beta)
        if t + 1 < len(reach):
            ahead = m.emit[s[at[:after] + t + 1]] * beta / scales[t + 1]
            move += alphas[t][:after].T @ ahead
            beta = ahead @ m.move.T
        beta = np.vstack([beta, np.ones((n - after, k))])
        gammas.append(alphas[t] * beta)
        seen.append(s[at[:n] + t])
    move *= m.move
    if seen:
        where, gamma = np.concatenate(seen), np.concatenate(gammas)
        for j in range(k):
            emit[:, j] = np.bincount(where, weights=gamma[:, j], minlength=len(emit))
        return gammas[-1].sum(axis=0), move, emit
    return np.zeros(k), move, emit


def _rounds(m: Model, shape: Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, size = len(m.start), len(m.emit)
        start, move, emit = np.zeros(k), np.zeros((k, k)), np.zeros((size, k))
        for batch in batches:
            for part in slices(batch, "text", PIECE):
                s, at, _ = symbols(words(column_of(part, "text")), m.vocabulary, shape)
                pieces = -(-np.diff(at) // SEGMENT)
                of = np.repeat(np.arange(len(pieces)), pieces)
                turn = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                starts = at[of] + turn * SEGMENT
                lengths = np.minimum(SEGMENT, at[of + 1] - starts)
                a, b, c = expected(s, starts, lengths, m)
                start, move, emit = start + a, move + b, emit + c
        yield _table(np.concatenate([start, move.ravel(), emit.ravel()]))

    return run


def _estimated(start: np.ndarray, move: np.ndarray, emit: np.ndarray, share: np.ndarray, v: Vocabulary, prior: float) -> Model:
    """Smoothed rates: each state's symbols lean on the overall shares by ``prior`` tokens for each kind of symbol."""
    lean = prior * 100
    return Model(
        v,
        (start + 1) / (start + 1).sum(),
        (move + 1) / (move + 1).sum(axis=1, keepdims=True),
        (emit + lean * share[:, None]) / (emit.sum(axis=0, keepdims=True) + lean),
    )


def train(docs: DataFrame, shape: Shape = Shape(), text: str = "text") -> tuple[Model, DataFrame]:
    """The model, and the counts of all words (word, c, class; the end has class -1).

    Null texts are empty: they hold the end alone. Without documents all shares are even."""
    prepare(docs.sparkSession)
    plain = docs.select(text_of(text).alias("text"))
    counted = plain.mapInArrow(_counted(shape), "word bigint, c bigint, class int")
    counts = written(counted.groupBy("word").agg(F.sum("c").alias("c"), F.min("class").alias("class")), "words")
    v = _vocabulary(counts, shape)
    ends = counts.filter(F.col("class") < 0).agg(F.sum("c")).first()[0] or 0
    share = _overall(v, shape, ends)
    size, k = len(share), shape.states
    near = _summed(plain.mapInArrow(_followers(v, shape, size), "spot bigint, value double"), 2 * size * shape.following)
    near = near.reshape(2, size, shape.following)
    own = first_states(near, share, k)
    # a state emits mostly the symbols of its group; groups follow each other as their symbols do
    emit = np.full((size, k), 0.1 / k) * share[:, None]
    emit[np.arange(size), own] += 0.9 * share
    group = np.eye(k)[own]
    move = group.T @ near[0] @ group[: shape.following]
    move = (move + 1) / (move + 1).sum(axis=1, keepdims=True)
    begin = group.T @ share + 0.01
    m = Model(v, begin / begin.sum(), 0.9 * move + 0.1 / k, emit / emit.sum(axis=0, keepdims=True))
    for _ in range(shape.rounds):
        table = _summed(plain.mapInArrow(_rounds(m, shape), "spot bigint, value double"), k + k * k + size * k)
        m = _estimated(table[:k], table[k : k + k * k].reshape(k, k), table[k + k * k :].reshape(size, k), share, v, shape.prior)
    return m, counts


def _rare_words(v: Vocabulary):
    """Distinct words of a chunk that have no symbol of their own."""

    def run(group: pa.Table) -> pa.Table:
        chunk = group["chunk"][0].as_py()
        found = [np.zeros(0, np.uint64)]
        for batch in group.combine_chunks().to_batches():
            for part in slices(batch, "text", PIECE):
                found.append(np.unique(words(column_of(part, "text")).hashes))
        all_ = np.unique(np.concatenate(found))
        all_ = all_[~np.isin(all_, v.hashes)]
        return pa.table({"word": all_.view(np.int64), "chunk": np.full(len(all_), chunk, np.int32)})

    return run


def _scored(m: Model, shape: Shape):
    v = m.vocabulary

    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        table, count = known["word"].to_numpy().view(np.uint64), known["c"].to_numpy()
        order = np.argsort(table)
        table, count = table[order], count[order]
        out = []
        for batch in texts.combine_chunks().to_batches():
            for part in slices(batch, "text", SCORED):
                w = words(column_of(part, "text"))
                s, at, frequent = symbols(w, v, shape)
                c = np.zeros(len(w.hashes), np.int64)
                c[frequent] = v.counts[np.searchsorted(v.hashes, w.hashes[frequent])]
                rare = np.flatnonzero(~frequent)
                if len(table) and len(rare):
                    spot = np.minimum(np.searchsorted(table, w.hashes[rare]), len(table) - 1)
                    c[rare] = np.where(table[spot] == w.hashes[rare], count[spot], 0)
                kind = s[with_ends(w)[0][rare]] - 1 - shape.frequent
                inner = np.zeros(len(w.hashes))
                inner[rare] = np.log10((c[rare] + 0.1) / (v.class_tokens[kind] + 0.1 * (v.class_types[kind] + 1)))
                sums = lambda x: np.diff(np.concatenate([[0.0], np.cumsum(x)])[w.offsets])
                exact = lambda x: np.array([x[a:b].sum() for a, b in zip(w.offsets, w.offsets[1:])])
                ends = part.num_rows
                end_count = m_ends
                out.append(
                    pa.table(
                        {
                            "id": column_of(part, "id"),
                            "n_tokens": w.counts() + 1,
                            "n_known": sums(c > 0).astype(np.int64) + (end_count > 0),
                            "base_score": exact(v.base(c)) + v.base(np.full(ends, end_count)),
                            "score": forward(s, at[:-1], np.diff(at), m) / np.log(10) + exact(inner),
                        }
                    )
                )
        names = ["id", "n_tokens", "n_known", "base_score", "score"]
        return pa.concat_tables(out) if out else pa.table({n: pa.array([], pa.float64()) for n in names})

    m_ends = shape_ends(m)
    return run


def shape_ends(m: Model) -> int:
    """Texts that the model has seen: the count of the end."""
    return int(m.vocabulary.tokens - m.vocabulary.counts.sum() - m.vocabulary.class_tokens.sum())


def score(docs: DataFrame, m: Model, counts: DataFrame, shape: Shape = Shape(), key: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Columns id, n_tokens, n_known, base_score, score (log10) of every row; see the query of this operator.

    Documents are dealt into chunks of about ``chunk_bytes`` by hash; the counts of a chunk's rarer words are brought
    to it by a join on the words that it holds, each once. Null texts are empty. Rows of equal ids are scored one by
    one; an empty table gives an empty one.
    """
    prepare(docs.sparkSession)
    plain = docs.select(F.col(key).cast("bigint").alias("id"), text_of(text).alias("text"))
    total = plain.agg(F.sum(F.octet_length("text").cast("bigint") + 64)).first()[0] or 0
    n = max(1, -(-total // chunk_bytes))
    deal: Column = F.pmod(F.xxhash64("id", F.when(F.col("id").isNull(), F.xxhash64("text"))), F.lit(n)).cast("int")
    chunks = plain.withColumn("chunk", deal).repartition(n, "chunk")
    rare = chunks.groupBy("chunk").applyInArrow(_rare_words(m.vocabulary), "word bigint, chunk int")
    known = rare.join(counts.select("word", "c"), "word").repartition(n, "chunk")
    return chunks.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(
        _scored(m, shape), "id bigint, n_tokens bigint, n_known bigint, base_score double, score double"
    )
