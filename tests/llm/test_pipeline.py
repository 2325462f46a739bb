"""The pipeline as a whole, and columns and rows that get in the way."""

import math
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F
from test_texts import brute_groups, brute_repeats, brute_tiles, plain_words

import corpus_pipeline
from sensorloom.llm.decontaminate import decontaminated
from sensorloom.llm.fingerprints import fingerprints
from sensorloom.llm.hmm import Shape, score, train
from sensorloom.llm.mixing import BLOCK, mixed, target_weight
from sensorloom.llm.near_dedup import near_duplicates
from sensorloom.llm.suffixes import repeated_passages, without_repeats
from sensorloom.llm.toxicity import Lexicon, folded, learn, toxicity

# names that the operators use inside
INNER = "id n one two bands rep root part place side slot core shard following preceding seed item score chunk word c class tag _s".split()


@pytest.fixture(scope="module")
def crowded(spark):
    """Documents with every inner name as a column, null in every column, and rows that repeat."""
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, None), (None, "x y"), (None, None), (3, "A b\tc d e f g"), (4, "q " * 300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("source", F.lit(None).cast("string"))
    return docs.withColumns({name: F.lit(None).cast("string") for name in INNER})


def test_inner_names_do_not_clash(spark, crowded):
    n = crowded.count()
    bench = spark.createDataFrame([(1, "a b c d e f g")], "item_id bigint, text string").withColumn("seed", F.lit(1))
    assert fingerprints(crowded).count() == n
    assert near_duplicates(crowded).count() == n
    assert {r["doc_id"] for r in near_duplicates(crowded).filter("not kept").collect()} == {3}
    assert decontaminated(crowded, bench).columns == crowded.columns
    assert sorted(r["doc_id"] or 0 for r in decontaminated(crowded, bench).collect()) == [0, 0, 2, 4]
    assert repeated_passages(crowded).count() == 0
    assert without_repeats(crowded).columns == crowded.columns and without_repeats(crowded).count() == n
    assert mixed(crowded).count() == n
    assert toxicity(crowded, Lexicon({" x ": 1.0})).count() == n
    shape = Shape(states=2, frequent=4, classes=4, following=4)
    assert score(crowded, *train(crowded, shape), shape).count() == n


def test_stages_keep_the_columns_of_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, left, sf)
        assert after.columns == docs.columns, name
        assert after.select("doc_id").subtract(left.select("doc_id")).isEmpty(), name
        assert 0 < after.count() <= left.count(), name
        left = after
    got = corpus_pipeline.run(spark, sf)
    ids = [r["doc_id"] for r in got.select("doc_id").collect()]
    assert sorted(ids) == sorted(r["doc_id"] for r in left.select("doc_id").collect()) and len(set(ids)) == len(ids)


def test_stages_on_nothing(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0


def brute_toxicity(text, lexicon):
    """Score of a text by trying every entry at every place."""
    plain = folded(text or "")
    places = lambda entry: [k for k in range(len(plain)) if plain.startswith(entry, k)]
    best = {}
    for entry, weight in lexicon.entries.items():
        for at in places(entry) if entry in plain else ():
            best[at] = max(best.get(at, 0.0), weight)
    for phrase in lexicon.exceptions:
        for at in places(f" {phrase} ") if f" {phrase} " in plain else ():
            best = {k: w for k, w in best.items() if not at <= k <= at + len(phrase)}
    s, n = sum(best.values()), len(plain.split())
    a, b, c = lexicon.curve
    z = a + b * math.log1p(s) + c * s / math.sqrt(max(n, 1))
    return 1 / (1 + math.exp(-min(30, max(-30, z))))


def brute_mix(blocks, weights):
    """The source of every slot: of the released blocks that with the earliest deadline; a new schedule when one runs out."""
    left, order = dict(blocks), []
    while left:
        total, slot, done = sum(weights[s] for s in left), 0, dict.fromkeys(left, 0)
        while all(left.values()):
            ready = []
            for s in left:
                w, i = Fraction(weights[s]) / Fraction(total), done[s] + 1
                if math.floor((i - 1) / w) <= slot:
                    due = math.ceil(i / w)
                    ready.append((due, 0 if math.floor(i / w) < due else 1, -w, s))
            s = min(ready)[3]
            order.append(s)
            done[s] += 1
            left[s] -= 1
            slot += 1
        left = {s: n for s, n in left.items() if n}
    return order


def test_pipeline_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    lexicon = learn(docs, spark.read.parquet(f"{sf}/labels.parquet"), cut=corpus_pipeline.TOXIC)
    texts = {i: r["text"] for i, r in rows.items() if brute_toxicity(r["text"], lexicon) < corpus_pipeline.TOXIC}
    groups = brute_groups(texts, 5, 80)
    texts = {i: t for i, t in texts.items() if groups[i][1] == i}
    cuts = brute_repeats(texts, 50)
    left = {i: [w for k, w in enumerate(plain_words(t)) if k not in cuts.get(i, ((), ()))[1]] for i, t in texts.items()}
    items = [plain_words(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    runs = [{tuple(item[k : k + 5]) for k in range(len(item) - 4)} for item in items]
    for i, w in list(left.items()):
        held = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        if any(own & held and brute_tiles(item, w, 5) >= 0.8 * len(item) for item, own in zip(items, runs)):
            del left[i]
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"]: plain_words(r["text"]) for r in got} == left and len(left) < len(rows)
    counts = Counter(rows[i]["source"] or "" for i in left)
    order = brute_mix({s: -(-c // BLOCK) for s, c in counts.items()}, {s: target_weight(s) for s in counts})
    assert len({target_weight(s) for s in counts}) > 1
    slots = {r["mix_slot"]: (r["mix_source"], r["mix_block"]) for r in got}
    assert [slots[k][0] for k in range(len(slots))] == order and len(slots) == len(order)
    assert all(len({r["mix_place"] for r in got if r["mix_slot"] == k}) == sum(r["mix_slot"] == k for r in got) for k in slots)

