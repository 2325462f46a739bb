"""Operators on documents against plain versions, and the cases that tables may hold."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sensorloom.llm.decontaminate import Tiling, contamination, decontaminated, tiles
from sensorloom.llm.fingerprints import fingerprints
from sensorloom.llm.graph import components
from sensorloom.llm.near_dedup import STRICT, deduplicated, near_duplicates
from sensorloom.llm.suffixes import Passage, repeated_passages, without_repeats
from sensorloom.llm.tokens import grams, shingle_sets, words

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def plain_words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def table(spark, texts, extra=None):
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in (texts.items() if isinstance(texts, dict) else enumerate(texts))]
    return spark.createDataFrame(rows, SCHEMA)


def vocabulary(seed, n=400):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefgß é".replace(" ", "h")) for _ in range(r.randint(2, 7))) for _ in range(n)]


def prose(seed, n, words_=None):
    r = random.Random(seed)
    return " ".join(r.choice(words_ or vocabulary(0)) for _ in range(n))


ODD = ["", None, " \n\t ", "one", "one two", "Ünï ÇÖDE \x0b\x0c wörd", "a a a a a a a a a a", "x" * 5000]


# words


def test_words_are_those_of_the_pattern():
    texts = ["A b\tC", *[t for t in ODD], "tail ", " head", prose(1, 3000)]
    w = words(pa.array(texts))
    seen = {}
    for i, t in enumerate(texts):
        own = plain_words(t)
        got = w.hashes[w.offsets[i] : w.offsets[i + 1]]
        assert len(own) == len(got)
        for a, b in zip(own, got):
            assert seen.setdefault(a, b) == b
        for a, x, y in zip(own, w.starts[w.offsets[i] :], w.ends[w.offsets[i] :]):
            assert bytes(w.data[x:y]).decode() == a
    assert len(set(seen.values())) == len(seen)


def test_words_do_not_depend_on_blocks(monkeypatch):
    from sensorloom.llm import tokens

    texts = pa.array([prose(2, 500), "z" * 300, prose(3, 10)])
    whole = words(texts).hashes
    monkeypatch.setattr(tokens, "_BLOCK", 16)
    assert (words(texts).hashes == whole).all()


def test_shingle_sets():
    texts = ["a b c a b c", "a b", "b a", "", "a", None, "a b c d"]
    sets, at = shingle_sets(words(pa.array(texts)), 3)
    assert np.diff(at).tolist() == [3, 1, 1, 0, 1, 0, 2]
    assert sets[at[1]] != sets[at[2]]
    assert sets[at[6] : at[7]].tolist() and set(sets[at[0] : at[1]]) & set(sets[at[6] : at[7]])


# components


def test_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7), (None, 3)]
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = top(a), top(b)
            root[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {x: top(x) for x in root}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


# near-duplicates


def shingles(text, n):
    w = plain_words(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def brute_groups(texts, n, percent):
    sets = {i: shingles(t, n) for i, t in texts.items()}
    root = {i: i for i in texts}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in ids}


def near_texts():
    r = random.Random(9)
    texts = list(ODD)
    for g in range(6):
        base = plain_words(prose(100 + g, r.randint(30, 300)))
        for _ in range(r.randint(1, 12)):
            copy = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 40))):
                copy[r.randrange(len(copy))] = f"new{r.randrange(10**6)}"
            texts.append(" ".join(copy))
            if r.random() < 0.3:
                texts.append(texts[-1].upper().lower())
    texts += [prose(500 + i, 40) for i in range(20)]
    r.shuffle(texts)
    return {i * 3 + 2: t for i, t in enumerate(texts)}


@pytest.mark.parametrize("block", [1_000_000, 300])
def test_near_duplicates_equal_brute_force(spark, block):
    texts = near_texts()
    docs = table(spark, texts)
    got = {r["doc_id"]: r for r in near_duplicates(docs, STRICT, block_shingles=block).collect()}
    want = brute_groups(texts, 3, 85)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_near_duplicates_of_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(docs, STRICT).collect()}
    assert got == brute_groups(texts, 3, 85)


def test_near_duplicates_odd_rows(spark):
    rows = [(1, "a b c d e f", 0), (1, "a b c d e f", 1), (None, "a b c d e f", 2), (5, "a b c d e f", 3), (4, None, 4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n bigint")
    got = sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in near_duplicates(docs).collect())
    assert got == [(0, 0, True), (1, 1, True), (1, 1, True), (4, 4, True), (5, 1, False)]
    kept = deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 4]
    assert near_duplicates(docs.limit(0)).count() == 0


# tiles


def brute_tiles(item, doc, least):
    """Length of all tiles, by looking at every pair of places in every round."""
    free_a, free_b, total = [True] * len(item), [True] * len(doc), 0
    least = min(least, len(item))
    while item and len(doc) >= least:
        best, found = 0, []
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while i + k < len(item) and j + k < len(doc) and item[i + k] == doc[j + k] and free_a[i + k] and free_b[j + k]:
                    k += 1
                if k > best:
                    best, found = k, []
                if k == best:
                    found.append((i, j))
        if best < least:
            break
        for i, j in found:
            if all(free_a[i : i + best]) and all(free_b[j : j + best]):
                free_a[i : i + best] = [False] * best
                free_b[j : j + best] = [False] * best
                total += best
    return total


def test_tiles_equal_brute_force():
    r = random.Random(3)
    for _ in range(200):
        item = [r.randrange(3) for _ in range(r.randint(1, 15))]
        doc = [r.randrange(3) for _ in range(r.randint(0, 25))]
        got = tiles(np.array(item, np.uint64), np.array(doc, np.uint64), 2)
        assert sum(t[2] for t in got) == brute_tiles(item, doc, 2)
        for a, b, n in got:
            assert item[a : a + n] == doc[b : b + n]


@pytest.mark.parametrize("sent", [2_000_000, 0])
def test_contamination(spark, sent):
    passage = prose(40, 40)
    w = passage.split()
    items = spark.createDataFrame([(7, passage), (8, "two words"), (9, prose(41, 30)), (10, ""), (None, "x y z x y z"), (11, None)], "item_id bigint, text string")
    shuffled = " ".join(w[20:] + ["gap"] + w[:20])
    texts = {1: f"{prose(50, 30)} {passage} {prose(51, 20)}", 2: shuffled, 3: " ".join(w[:25]), 4: "here are two words", 5: "", 6: None, 8: prose(53, 900)}
    docs = table(spark, texts)
    got = contamination(docs, items, seeds_sent=sent)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == {(1, 7), (2, 7), (4, 8)}
    assert {r["item_words"]: r["covered_words"] for r in got.filter("doc_id = 2").collect()} == {40: 40}
    left = decontaminated(docs, items)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {3, 5, 6, 8}
    assert contamination(docs.limit(0), items).count() == 0 and contamination(docs, items.limit(0)).count() == 0


def test_contamination_of_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]): r["covered_words"] for r in contamination(docs, bench).collect()}
    want = {}
    items = {r["item_id"]: plain_words(r["text"]) for r in bench.collect()}
    for d in docs.collect():
        w = plain_words(d["text"])
        runs = {tuple(w[i : i + 5]) for i in range(len(w))}
        for i, item in items.items():
            if any(tuple(item[k : k + 5]) in runs for k in range(len(item) - 4)):
                covered = brute_tiles(item, w, 5)
                if covered >= 0.8 * len(item):
                    want[d["doc_id"], i] = covered
    assert got == want and want


# passages


def brute_repeats(texts, least):
    """Word places in runs of ``least`` words that another document has too."""
    owners = defaultdict(set)
    for i, t in texts.items():
        w = plain_words(t)
        for k in range(len(w) - least + 1):
            owners[tuple(w[k : k + least])].add(i)
    out = {}
    for i, t in texts.items():
        w = plain_words(t)
        spots, cut = set(), set()
        for k in range(len(w) - least + 1):
            them = owners[tuple(w[k : k + least])]
            if len(them) > 1:
                spots.update(range(k, k + least))
                if min(them) < i:
                    cut.update(range(k, k + least))
        if spots:
            out[i] = (spots, cut)
    return out


def passage_texts():
    r = random.Random(21)
    shared = [prose(200 + i, n) for i, n in enumerate((50, 51, 60, 90, 200, 49, 30))]
    texts = list(ODD)
    for i in range(40):
        parts = []
        for _ in range(r.randint(1, 4)):
            parts.append(prose(1000 + r.randrange(10**6), r.randint(5, 120)))
            if r.random() < 0.6:
                parts.append(r.choice(shared))
        texts.append(" ".join(parts))
    return dict(enumerate(texts))


def test_repeated_passages_equal_brute_force(spark):
    texts = passage_texts()
    got = {r["doc_id"]: r for r in repeated_passages(table(spark, texts)).collect()}
    want = brute_repeats(texts, 50)
    spans = lambda s: {x for a in s for x in range(a["begin"], a["end"])}
    assert {i: spans(r["repeated"]) for i, r in got.items()} == {i: w[0] for i, w in want.items()}
    for i, r in got.items():
        assert spans(r["removable"]) == want[i][1]


def test_a_passage_of_many_documents(spark):
    passage = prose(77, 80)
    texts = {i: f"{prose(3000 + i, 30)} {passage} {prose(4000 + i, 30)}" for i in range(60)}
    got = {r["doc_id"]: r["removable_words"] for r in repeated_passages(table(spark, texts)).collect()}
    assert len(got) == 60 and got[0] == 0 and all(80 <= n <= 85 for i, n in got.items() if i)


def test_passages_of_suffixes_that_are_not_neighbours(spark):
    notice = prose(70, 45)
    before = prose(71, 6)
    texts = {i: f"{prose(5000 + i, 60)} {notice} {prose(6000 + i, 60)}" for i in range(1, 40)}
    texts |= {i: f"{prose(5000 + i, 60)} {before} {notice} {prose(6000 + i, 60)}" for i in (5, 33)}
    got = {r["doc_id"]: (r["repeated_words"], r["removable_words"]) for r in repeated_passages(table(spark, texts)).collect()}
    want = {i: (len(a), len(b)) for i, (a, b) in brute_repeats(texts, 50).items()}
    assert got == want and {5, 33} <= want.keys()


def test_passages_that_a_large_group_does_not_share(spark):
    notice = prose(72, 45)
    texts = {i: f"{prose(7000 + i, 60)} {notice} {prose(8000 + i, 60)}" for i in range(60)}
    for i in range(20, 40):
        texts[i] = f"{prose(7000 + i, 60)} {prose(7500 + i // 2, 6)} {notice} {prose(8000 + i, 60)}"
    got = {r["doc_id"]: (r["repeated_words"], r["removable_words"]) for r in repeated_passages(table(spark, texts)).collect()}
    want = {i: (len(a), len(b)) for i, (a, b) in brute_repeats(texts, 50).items()}
    assert got == want and set(range(20, 40)) <= want.keys()


def test_repeated_passages_of_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = brute_repeats(texts, 50)
    got = {r["doc_id"]: r["repeated_words"] for r in repeated_passages(docs).collect()}
    assert got == {i: len(w[0]) for i, w in want.items()}


def test_without_repeats(spark):
    passage = prose(88, 60)
    texts = {1: f"Keep  this {passage} end", 2: f"other\n{passage}\tlast", 3: passage, 4: None, 5: " as  it is "}
    docs = table(spark, texts)
    left = without_repeats(docs)
    assert left.schema == docs.schema
    assert {r["doc_id"]: r["text"] for r in left.collect()} == {1: texts[1], 2: "other last", 3: "", 4: None, 5: " as  it is "}
    assert {r["n_chars"] for r in left.filter("doc_id = 2").collect()} == {10}
    assert without_repeats(docs.limit(0)).count() == 0


# fingerprints


def test_fingerprints(spark):
    texts = {9: "last one", 1: "alpha beta gamma delta epsilon zeta", 2: "", 3: None, 4: "x", 6: prose(1, 400), 7: prose(1, 400), 8: "é" * 5}
    docs = table(spark, texts).drop("n_chars").withColumn("part", F.lit(3)).withColumn("place", F.lit("z"))
    got = {r["doc_id"]: r for r in fingerprints(docs).collect()}
    ids = sorted(texts)
    assert sorted(got) == ids
    for i, j in zip(ids, ids[1:] + ids[:1]):
        own, following = texts[i] or "", texts[j] or ""
        half = len(own) // 2
        changed = own[: len(own) - half] + following[:half]
        assert got[i]["n_chars"] == len(own)
        assert got[i]["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
    assert got[6]["fingerprint"] == got[7]["fingerprint"] and got[6]["near_next"] == 1.0
    assert got[7]["near_edited"] > 0.3 > got[7]["near_next"]
    assert got[2]["fingerprint"] == "" and got[2]["near_next"] == 1.0


def test_fingerprints_see_order(spark):
    a, b = prose(31, 300), prose(32, 300)
    docs = table(spark, {1: f"{a} {b}", 2: f"{b} {a}", 3: f"{a} {b} more"})
    got = {r["doc_id"]: r["near_next"] for r in fingerprints(docs).collect()}
    assert got[3] > 0.9 > got[1]


@pytest.mark.parametrize("n", [0, 1])
def test_fingerprints_of_few_rows(spark, n):
    docs = table(spark, {5: "only one text"}).limit(n)
    got = fingerprints(docs).collect()
    assert len(got) == n and all(r["near_next"] == 1.0 for r in got)


def test_fingerprints_over_ranges(spark):
    """The next text is found across ranges, whatever their number."""
    texts = {i * 7: prose(i, 40) for i in range(60)}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1b")
    from sensorloom.llm import fingerprints as module

    docs = table(spark, texts)
    want = {r["doc_id"]: r["edited_sha256"] for r in fingerprints(docs).collect()}
    bounds = sorted(texts)[::5]
    old, module._ranges = module._ranges, lambda *a: bounds
    try:
        got = {r["doc_id"]: r["edited_sha256"] for r in fingerprints(docs).collect()}
    finally:
        module._ranges = old
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert got == want


def test_grams_count():
    assert len(grams(np.zeros(3, np.uint64), 5)) == 0
    assert Counter(grams(np.array([1, 2, 1, 2, 1], np.uint64), 2).tolist()).most_common(1)[0][1] == 2


def test_tiles_of_repeated_words_are_linear():
    import time

    begun = time.perf_counter()
    assert tiles(np.full(1000, 7, np.uint64), np.full(20000, 7, np.uint64), 5) == [(0, 0, 1000)]
    r = np.random.default_rng(1)
    item, doc = r.integers(0, 3, 1000).astype(np.uint64), r.integers(0, 3, 20000).astype(np.uint64)
    got = tiles(item, doc, 5)
    assert time.perf_counter() - begun < 2
    assert all((item[a : a + n] == doc[b : b + n]).all() for a, b, n in got)
    lengths = [n for _, _, n in got]
    assert lengths == sorted(lengths, reverse=True)
    for side, at in ((item, 0), (doc, 1)):
        taken = np.zeros(len(side), int)
        for t in got:
            taken[t[at] : t[at] + t[2]] += 1
        assert taken.max() == 1


def test_common_seeds_leave_the_same_pairs(spark):
    """A phrase that all items share meets all documents; items made of nothing else are still found."""
    phrase = "one and the same long phrase of a form"
    items = [(i, f"{phrase} {prose(300 + i, 12)}") for i in range(12)] + [(90, phrase), (91, "here it is short")]
    texts = {i: f"{prose(400 + i, 20)} {phrase} {prose(500 + i, 20)}" for i in range(15)} | {50: items[3][1], 51: f"x {items[4][1]} y", 52: "here it is short"}
    docs, bench = table(spark, texts), spark.createDataFrame(items, "item_id bigint, text string")
    pairs = lambda **more: sorted((r["doc_id"], r["item_id"], r["covered_words"]) for r in contamination(docs, bench, **more).collect())
    usual = pairs()
    assert usual == pairs(common=3) == pairs(common=3, seeds_sent=0) == pairs(common=0)
    assert {(d, i) for d, i, _ in usual} == {(d, 90) for d in range(15)} | {(50, 3), (50, 90), (51, 4), (51, 90), (52, 91)}


def spark_hash(*values):
    """xxhash64 of Spark: each value hashed with the hash of those before it as seed, nulls left out."""
    import struct

    import xxhash

    h = 42
    for v in values:
        if v is None:
            continue
        kind, v = v if isinstance(v, tuple) else ("s", v)
        data = v.encode() if kind == "s" else struct.pack("<q" if kind == "l" else "<i", v)
        h = xxhash.xxh64(data, seed=h).intdigest()
    return h


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def brute_tokens(text):
    """Slots and tuples of Order MinHash, one k-mer at a time."""
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    if not w:
        return []
    seen, slots = Counter(), {}
    for pos in range(max(len(w) - 3, 0) + 1):
        gram = spark_hash(*w[pos : pos + 3])
        seen[gram] += 1
        h = spark_hash(("l", signed(gram)), ("i", seen[gram]))
        half = slots.setdefault(h & 63, [None, None])
        side, value = h >> 20 & 1, (h >> 31, pos)
        if half[side] is None or value < half[side]:
            half[side] = value
    tokens = []
    for slot, (a, b) in slots.items():
        one, two = a and ("l", a[0]), b and ("l", b[0])
        if b is None or (a is not None and a[1] <= b[1]):
            pair = spark_hash(one, two)
        else:
            pair = spark_hash(two, one, ("i", 1))
        tokens.append((slot << 24) + (pair & 0xFFFFFF))
    return sorted(tokens)


def brute_likeness(a, b):
    either = len(a) + len(b) - len({x >> 24 for x in a} & {x >> 24 for x in b})
    if not either:
        return 1.0
    j = (len(set(a) & set(b)) / either) ** 0.5
    return 2 * j / (1 + j)


def test_fingerprints_equal_brute_force(spark):
    r = random.Random(17)
    texts = {i: prose(900 + i % 9, r.choice([1, 2, 3, 4, 30, 200])) for i in range(40)} | {50: None, 51: "", 52: " \t\n", 53: "a a a a a a a a", 54: "Ä b c D", 55: "x " * 500}
    got = {row["doc_id"]: row for row in fingerprints(table(spark, texts)).collect()}
    ids = sorted(texts)
    for i, j in zip(ids, ids[1:] + ids[:1]):
        own, following = texts[i] or "", texts[j] or ""
        half = len(own) // 2
        changed = own[: len(own) - half] + following[:half]
        a, b, c = brute_tokens(own), brute_tokens(changed), brute_tokens(following)
        row = got[i]
        assert row["fingerprint"] == "".join(f"{t:08x}" for t in a), i
        assert row["edited_fingerprint"] == "".join(f"{t:08x}" for t in b), i
        assert row["near_edited"] == pytest.approx(brute_likeness(a, b)) and row["near_next"] == pytest.approx(brute_likeness(a, c)), i


def test_fingerprints_of_many_rows_without_id_and_of_one_id(spark):
    rows = [(None, f"text {i} of none") for i in range(120)] + [(5, f"text {i} of five") for i in range(120)] + [(9, "last")]
    got = fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert Counter(r["doc_id"] for r in got) == {None: 120, 5: 120, 9: 1}
    assert Counter(r["fingerprint"] for r in got) == Counter("".join(f"{t:08x}" for t in brute_tokens(text)) for _, text in rows)
