"""Language model, toxicity, page text, archives, URL rules and mixing against plain versions."""

import gzip
import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sensorloom.llm.common import crc_bucket
from sensorloom.llm.hmm import Model, Shape, Vocabulary, expected, forward, score, train
from sensorloom.llm.mixing import mixed, parts, period_schedule, phases
from sensorloom.llm.pages import blocks, extracted, main_text, suffix_array
from sensorloom.llm.toxicity import Lexicon, found_weight, folded, learn, toxicity
from sensorloom.llm.url_rules import ListRule, judged, mine
from sensorloom.llm.warc import read_archives, round_trip, salvage, write_archives

SF = "/root/testdata/sf0.01"


def plain_words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# language model


def small_model(k=3, size=6, seed=1):
    r = np.random.default_rng(seed)
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    v = Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 0, np.zeros(1), np.zeros(1))
    return Model(v, norm(r.random(k), 0), norm(r.random((k, k)), 1), norm(r.random((size, k)), 0))


def brute_likelihood(m, seq):
    from itertools import product

    total = 0.0
    for path in product(range(len(m.start)), repeat=len(seq)):
        p = m.start[path[0]] * m.emit[seq[0], path[0]]
        for a, b, s in zip(path, path[1:], seq[1:]):
            p *= m.move[a, b] * m.emit[s, b]
        total += p
    return math.log(total)


def test_forward_and_expected_counts_equal_all_paths():
    m = small_model()
    seqs = [[0, 1, 2, 5], [3], [4, 4], [1, 0, 0, 2, 3, 5]]
    s, lengths = np.concatenate(seqs), np.array([len(x) for x in seqs])
    starts = np.cumsum(lengths) - lengths
    got = forward(s, starts, lengths, m)
    assert np.allclose(got, [brute_likelihood(m, x) for x in seqs])
    start, move, emit = expected(s, starts, lengths, m)
    assert np.isclose(start.sum(), len(seqs)) and np.isclose(emit.sum(), len(s)) and np.isclose(move.sum(), len(s) - len(seqs))
    # Baum-Welch never lowers the likelihood
    better = Model(m.vocabulary, start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0, keepdims=True))
    assert forward(s, starts, lengths, better).sum() > got.sum()


def test_scores_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(-1, None), (-2, ""), (-3, "of of of zzzunknownzzz"), (-4, "Of  THE\x0bof")], "doc_id bigint, text string")
    docs = docs.unionByName(more)
    held = crc_bucket("doc_id", 10) == 0
    rows = {r["doc_id"]: (r["text"], r["held"]) for r in docs.select("*", held.alias("held")).collect()}
    shape = Shape(states=4, frequent=200, classes=64)
    m, counts = train(docs.filter(~held), shape)
    got = {r["id"]: r for r in score(docs, m, counts, shape, chunk_bytes=200_000).collect()}
    count = Counter()
    for text, out in rows.values():
        if not out:
            count.update([*plain_words(text), None])
    n, v = sum(count.values()), len(count)
    assert (m.vocabulary.tokens, m.vocabulary.types) == (n, v)
    gain = 0.0
    for i, (text, out) in rows.items():
        tokens = [*plain_words(text), None]
        assert got[i]["n_tokens"] == len(tokens) and got[i]["n_known"] == sum(count[t] > 0 for t in tokens)
        base = sum(math.log10((count[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        assert got[i]["base_score"] == pytest.approx(base, rel=1e-9)
        gain += (got[i]["score"] - base) * out
    assert gain > 0 and set(got) == set(rows)


def test_model_is_a_distribution(spark):
    """Over all texts of one word (known ones, and an unknown one of each class) and the end, and the empty text: at most 1."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b c a", "b b", "", "c d e f g a"])], "doc_id bigint, text string")
    shape = Shape(states=2, frequent=3, classes=4, following=4)
    m, counts = train(docs, shape)
    words = {w for t in ("a b c a", "c d e f g a") for w in t.split()}
    probes = [(i, w) for i, w in enumerate([*sorted(words), ""])]
    got = score(spark.createDataFrame(probes, "doc_id bigint, text string"), m, counts, shape).collect()
    assert 0 < sum(10 ** r["score"] for r in got) <= 1
    assert score(docs.limit(0), m, counts, shape).count() == 0


# toxicity


def test_folding():
    assert folded("1D10T, іdіоt! (stup1d)  2024 c0-op") == " idiot idiot stupid 2024 co-op "
    assert folded("") == "  " and folded("st​upid") == " stupid "


def test_hits():
    a = Lexicon({" trash ": 2.0, " moro": 1.5, " moron ": 3.0}).automaton()
    assert found_weight(a, "Trash trash") == (4.0, 2)
    assert found_weight(a, "the trash can is a m0ron's") == (1.5, 6)
    assert found_weight(a, "moron") == (3.0, 1) and found_weight(a, "") == (0.0, 0)


def test_held_out_toxicity(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = crc_bucket("doc_id", 4) == 2
    scored = toxicity(docs, learn(docs, labels.filter(~held)), ["doc_id"])
    rows = scored.join(labels.filter(held), "doc_id").select("score", "toxic").collect()
    hit = sum((r["score"] >= 0.3) == (r["toxic"] == 1) for r in rows)
    assert len(rows) > 80 and hit / len(rows) > 0.93
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "x" * 9000), (None, "fine")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1)], "doc_id bigint, toxic int")
    rows = toxicity(docs, learn(docs, labels)).collect()
    assert len(rows) == 4 and len({r["score"] for r in rows}) == 1
    assert toxicity(docs.limit(0), learn(docs.limit(0), labels.limit(0))).count() == 0


# pages

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var a="</p><article>no</article>";</script></head>
<body class="with-sidebar"><header>Site <b>name</b></header><nav><ul><li>Home<li>More</ul></nav><div class="cookie-notice">We use cookies</div>
<article><header><h1>Head&amp;line</h1></header><p>One <b>bo</b>ld &lt;tag&gt;<br>two<p>Three&nbsp;four<form>Send <input></form>
<div id="comments"><article>Nice</article></div><aside>Side</aside></article><footer>&copy; us</footer><!-- gone <p>x</p> --></body></html>"""


def test_blocks():
    assert main_text(blocks(PAGE), set()) == "Head&line One bold <tag> two Three four"
    assert blocks("") == [] and main_text(blocks("just text"), set()) == "just text"
    assert main_text(blocks("<p>a < b and c<p>d <b"), set()) == "a < b and c d"
    assert main_text(blocks("<div>&amp;lt;</div><script>no"), set()) == "&lt;"


def test_suffix_array():
    r = np.random.default_rng(4)
    for n in (0, 1, 2, 50, 300):
        stream = r.integers(0, 4, n).astype(np.uint64)
        order, common = suffix_array(stream)
        text = stream.tolist()
        assert order.tolist() == sorted(range(n), key=lambda i: text[i:])
        for k in range(1, n):
            a, b = text[order[k - 1] :], text[order[k] :]
            want = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert common[k] == min(want, 64)


@pytest.mark.parametrize("shard", [2000, 2])
def test_repeated_blocks_go(spark, shard):
    html = "<div>Home news about us</div><div>{}</div><div>All rights reserved here</div>"
    rows = [(i, f"http://a.org/{i}", html.format(f"unique text number {i} stays w{i * 7}")) for i in range(9)]
    rows += [(20, "http://b.org/", html.format("Home news about us")), (21, None, None), (22, "x", "")]
    got = {r["page_id"]: r["text"] for r in extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string"), shard_pages=shard).collect()}
    assert got == {i: f"unique text number {i} stays w{i * 7}" for i in range(9)} | {
        20: "Home news about us Home news about us All rights reserved here", 21: "", 22: "",
    }


@pytest.mark.parametrize("shard", [2000, 5])
def test_copies_and_common_phrases_stay(spark, shard):
    r = random.Random(5)
    some = [f"w{i}" for i in range(12)]
    prose = {i: " ".join(r.choice(some) for _ in range(60)) for i in range(40)}
    rows = [(i, f"http://hot.org/{i}", f"<p>{t}</p><p>share this page with all of your good friends today</p>") for i, t in prose.items()]
    rows += [(100 + i, f"http://copy.org/?session={i}", "<p>only one text here in four copies</p>") for i in range(4)]
    got = {r["page_id"]: r["text"] for r in extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string"), shard_pages=shard).collect()}
    assert got == prose | {100 + i: "only one text here in four copies" for i in range(4)}


def test_boilerplate_inside_articles(spark):
    html = "<article><p>unique words of number {0} a{0}</p><p>Subscribe to our paper for more of this every day</p></article><div>outside but unique {0}</div>"
    rows = [(i, f"http://a.org/{i}", html.format(i)) for i in range(9)]
    got = {r["page_id"]: r for r in extracted(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert {i: r["text"] for i, r in got.items()} == {i: f"unique words of number {i} a{i} outside but unique {i}" for i in range(9)}
    assert {(r["outside_blocks"], r["repeated_blocks"]) for r in got.values()} == {(1, 1)}


def test_given_pages(spark):
    import re
    from html import unescape

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r for r in extracted(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        want = " ".join(unescape(re.sub(r"<(?:/?p|/?h1|br)>", " ", inner).replace("<b>", "").replace("</b>", "")).split())
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)
    assert extracted(pages.limit(0)).count() == 0


# archives


def test_round_trip(spark, tmp_path):
    long = "ä" * 600
    rows = [(1, "http://a", long), (2, "http://b\r\nX: y", long), (3, None, long), (4, "c", "short"), (5, "d", "short"), (6, "e", None), (None, "f", long), (7, "g", "WARC/1.1\r\n\r\n" * 100)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    write_archives(pages, str(tmp_path / "w"))
    got = read_archives(spark, str(tmp_path / "w")).collect()
    assert len(got) == len(rows) and all(r["problem"] is None for r in got)
    by = {r["page_id"]: r for r in got}
    for i, _, text in rows:
        body = (text or "").encode()
        assert by[i]["payload_bytes"] == len(body) and by[i]["payload_digest"] == hashlib.sha1(body).hexdigest()
        assert bytes(by[i]["payload"]) == (b"" if i in (1, 2) else body)
    assert {i: (by[i]["record_type"], by[i]["refers_to"]) for i in (1, 2, 3, 4, 5, None)} == {
        1: ("revisit", 3), 2: ("revisit", 3), 3: ("response", None), 4: ("response", None), 5: ("response", None), None: ("response", None),
    }
    assert round_trip(pages.limit(0), str(tmp_path / "none")).count() == 0


def record(i, payload):
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nWARC-Payload-Digest: sha1:{hashlib.sha1(payload).hexdigest()}\r\n"
    return f"{head}Content-Length: {len(payload)}\r\n\r\n".encode() + payload + b"\r\n\r\n"


def test_salvage():
    good = [record(i, bytes([65 + i]) * 50) for i in range(4)]
    broken = good[1].replace(b"BBBB", b"BxBB", 1)
    data = b"junk" + good[0] + broken + good[2] + good[3][:-30]
    got = list(salvage(data))
    assert [(g[2] or {}).get("warc-record-id") for g in got] == [None, "<urn:page:0>", None, "<urn:page:2>", None]
    assert sum(g[1] for g in got) == len(data) and [g[0] for g in got] == np.cumsum([0] + [g[1] for g in got])[:-1].tolist()
    members = [gzip.compress(g, mtime=0) for g in good]
    bad = bytearray(members[1])
    bad[len(bad) // 2] ^= 255
    data = members[0] + bytes(bad) + members[2] + good[3]
    got = list(salvage(data))
    ids = [(g[2] or {}).get("warc-record-id") for g in got]
    assert [i for i in ids if i] == ["<urn:page:0>", "<urn:page:2>", "<urn:page:3>"] and sum(g[1] for g in got) == len(data)
    assert list(salvage(b"")) == [] and zlib.crc32(b"") == 0


def _many(n):
    """Records, each of its own bytes."""
    out = []
    for i in range(n):
        payload = f"page {i} ".encode() * (20 + i)
        head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nWARC-Payload-Digest: sha1:{hashlib.sha1(payload).hexdigest()}\r\nContent-Length: {len(payload)}\r\n\r\n"
        out.append(head.encode() + payload + b"\r\n\r\n")
    return out


def _ids(found):
    return [int(g[2]["warc-record-id"][10:-1]) for g in found if g[2]]


def test_one_bad_record_inside_a_member():
    """Ten records in one gzip member, one of them damaged before it was compressed: nine come back, the gap is logged."""
    parts = _many(10)
    parts[4] = parts[4].replace(b"page 4", b"page X", 1)
    member = gzip.compress(b"".join(parts))
    after = gzip.compress(_many(12)[11])
    got = list(salvage(member + after))
    assert _ids(got) == [0, 1, 2, 3, 5, 6, 7, 8, 9, 11]
    gaps = [g for g in got if g[2] is None]
    begin = sum(map(len, parts[:4]))
    assert [(g[0], g[1], g[4]) for g in gaps] == [(0, len(member), f"payload digest differs, bytes {begin} to {begin + len(parts[4])} of the member")]


def test_a_member_that_is_cut_or_broken_gives_what_comes_before():
    import os

    parts = _many(10)
    noise = b"WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 300000\r\n\r\n" + os.urandom(300000) + b"\r\n\r\n"
    member = gzip.compress(b"".join([*parts[:6], noise, *parts[6:]]))
    plain = parts[0].replace(b"page:0", b"page:99")
    cut = list(salvage(member[: len(member) // 2] + plain))
    assert _ids(cut) == [0, 1, 2, 3, 4, 5, 99]
    assert any(g[4] == "bad gzip member" and g[0] == 0 for g in cut) or any(g[4] == "gzip member without end" for g in cut)
    alone = list(salvage(member[: len(member) // 2]))
    assert _ids(alone) == [0, 1, 2, 3, 4, 5] and alone[-1][4] == "gzip member without end"
    wrong = bytearray(member)
    wrong[-6] ^= 255  # the check sum at the end
    assert _ids(salvage(bytes(wrong) + plain)) == [*range(6), 77, *range(6, 10), 99]


def test_files_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    import glob

    from sensorloom.llm import warc

    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    pages = spark.range(40).select(F.col("id").alias("page_id"), F.lit("http://x/").alias("url"), F.concat(F.col("id").cast("string"), F.repeat(F.lit("y"), 4000)).alias("html"))
    write_archives(pages.coalesce(1), str(tmp_path / "w"))
    assert len(glob.glob(str(tmp_path / "w" / "part-*"))) >= 10
    got = read_archives(spark, str(tmp_path / "w"))
    assert got.filter("problem is null").count() == 40 and got.filter("problem is not null").count() == 0


def test_any_cut_is_salvaged():
    good = [record(i, b"payload %d WARC/1.1\r\n" % i) for i in range(5)]
    data, r = b"".join(good), random.Random(1)
    for _ in range(60):
        a = r.randrange(len(data))
        b = min(len(data), a + r.randint(1, 150))
        left = {g[2]["warc-record-id"] for g in salvage(data[:a] + b"#" * r.randint(0, 9) + data[b:]) if g[2]}
        at, whole = 0, set()
        for i, g in enumerate(good):
            if at + len(g) <= a or at >= b:
                whole.add(f"<urn:page:{i}>")
            at += len(g)
        assert whole <= left


def test_exceptions_are_learnt_from_harmless_documents(spark):
    r = random.Random(4)
    other = lambda n: " ".join(f"w{r.randrange(400)}x" for _ in range(n))
    texts = [(f"{other(8)} moron {other(8)}", 1) for _ in range(60)] + [(f"{other(8)} Moron mushroom {other(8)}", 0) for _ in range(30)]
    texts += [(other(16), 0) for _ in range(200)] + [(f"{other(3)} {'q' * 200} {other(3)}", 1) for _ in range(40)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)], "doc_id bigint, toxic int")
    lexicon = learn(docs, labels)
    assert " moron " in lexicon.entries and "moron mushroom" in lexicon.exceptions
    assert f" {'q' * 200} " in lexicon.entries  # words of any length
    new = spark.createDataFrame([(1, "what a moron"), (2, "a moron mushroom"), (3, "a mushroom"), (4, "moron mushroom moron")], "doc_id bigint, text string")
    score = {r["doc_id"]: r["score"] for r in toxicity(new, lexicon).collect()}
    assert score[1] >= 0.3 and score[4] >= 0.3 and score[2] < 0.3 and score[3] < 0.3


def test_phrases_around_hits():
    from sensorloom.llm.toxicity import phrases

    automaton = Lexicon({" bad ": 1.0, " wor": 1.0}, exceptions=()).automaton()
    assert phrases(automaton, folded("a bad word")) == {"a bad", "bad word"}
    assert phrases(automaton, folded("a - bad -- word bad")) == {"word bad"}
    assert phrases(automaton, folded("bad")) == phrases(automaton, folded("")) == phrases(automaton, folded("none here")) == set()


# URL rules


def test_list_rules(spark):
    from sensorloom.llm.queries import URL_RULES

    urls = {
        1: ("http://WWW.Example.com/en/x?q", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
        2: ("https://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
        3: ("http://example.com", "example.com", "", None, "allow"),
        4: ("x://b.net/fr/1#t", "b.net", "/fr/1", "net/fr/", "block"),
        5: ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        6: (None, "", "", None, "allow"),
        7: ("no scheme", "", "", None, "allow"),
        8: ("http://a?b://c/d", "a", "", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u[0], "x") for i, u in urls.items()], "page_id bigint, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judged(pages, URL_RULES, support=0.9).collect()}
    assert got == {i: u[1:] for i, u in urls.items()}
    # repeated rows and rows without an id are judged one by one
    again = pages.unionByName(pages).unionByName(pages.withColumn("page_id", F.lit(None).cast("bigint")))
    assert Counter(r["verdict"] for r in judged(again, URL_RULES, support=0.9).collect()) == {k: 3 * n for k, n in Counter(u[4] for u in urls.values()).items()}
    assert judged(pages.limit(0), URL_RULES).count() == 0


def test_wide_urls_give_the_same_rules(spark, monkeypatch):
    from sensorloom.llm import url_rules

    r = random.Random(12)
    rows = []
    for _ in range(400):
        t = sorted({r.choice("abcdefghij") for _ in range(r.randint(1, 7))})
        rows.append((t, "block" if {"a", "b"} <= set(t) or r.random() < 0.05 else "allow"))
    known = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    near = lambda rules: [(t, v, round(c, 9), round(s, 9)) for t, v, c, s in rules]
    grown = near(mine(known, 0.02, 0.8))
    monkeypatch.setattr(url_rules, "WIDE", 1)
    assert near(mine(known, 0.02, 0.8)) == grown and any(len(t) == 3 for t, *_ in grown)


def test_urls_of_thirty_tokens_that_go_together(spark):
    """All combinations of thirty tokens are frequent: 2**30 of them, of which those of three are counted."""
    many = [f"p:{i:02d}" for i in range(30)]
    rows = [(many, "block")] * 50 + [(["h:x", f"p:o{i % 7}"], "allow") for i in range(300)]
    rules = mine(spark.createDataFrame(rows, "tokens array<string>, verdict string"), 0.05, 0.9)
    assert {tuple(t) for t, v, *_ in rules if v == "block"} == {(t,) for t in many}
    assert (["h:x"], "allow") in [(t, v) for t, v, *_ in rules]


def test_mined_rules_equal_brute_force(spark):
    r = random.Random(8)
    rows = []
    for _ in range(300):
        t = sorted({r.choice("abcdefg") for _ in range(r.randint(1, 5))})
        rows.append((t, "block" if "a" in t and "b" in t or r.random() < 0.05 else "allow"))
    got = {(tuple(x[0]), x[1]): (x[2], x[3]) for x in mine(spark.createDataFrame(rows, "tokens array<string>, verdict string"), 0.05, 0.8, 2)}
    from itertools import combinations

    sure = {}
    for k in (1, 2):
        for t in combinations("abcdefg", k):
            have = [v for own, v in rows if set(t) <= set(own)]
            for v in ("block", "allow"):
                n = have.count(v)
                if n >= 0.05 * len(rows) and n / len(have) >= 0.8:
                    if not any(sure.get(((x,), v), (0,))[0] >= n / len(have) for x in t if k > 1):
                        sure[t, v] = (n / len(have), n / len(rows))
    assert got.keys() == sure.keys() and all(got[x] == pytest.approx(sure[x]) for x in got)
    assert (("a", "b"), "block") in got


# mixing


def test_deviation_is_below_one_block():
    r = random.Random(2)
    for _ in range(60):
        weights = {f"s{i}": r.random() ** 3 + 0.001 for i in range(r.randint(1, 12))}
        share = parts(weights, r.choice([12, 50, 200]))
        q = sum(share.values())
        order = period_schedule(share)
        assert Counter(order) == share
        seen = Counter()
        for slot, s in enumerate(order, 1):
            seen[s] += 1
            assert all(abs(seen[x] - share[x] * slot / q) < 1 for x in share)


def test_mix_holds_all_rows_and_follows_weights(spark):
    rows = [(i, "big" if i % 3 else f"s{i % 7}", "t") for i in range(3000)] + [(9000, None, None), (None, "s1", "t")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, mix bigint".replace("mix bigint", "text string"))
    got = mixed(docs, {"big": 3.0, "s0": 1.0}, block=8, period=20).collect()
    assert Counter((r["doc_id"], r["source"]) for r in got) == Counter((r[0], r[1]) for r in rows)
    slots = {}
    for r in got:
        slots.setdefault(r["mix_slot"], set()).add((r["mix_source"], r["mix_block"]))
    assert sorted(slots) == list(range(len(slots))) and all(len(s) == 1 for s in slots.values())
    assert len({(r["mix_slot"], r["mix_place"]) for r in got}) == len(got)
    order = [next(iter(slots[k]))[0] for k in range(len(slots))]
    counts = {s: -(-c // 8) for s, c in Counter(r[1] or "" for r in rows).items()}
    share = parts({s: {"big": 3.0, "s0": 1.0}.get(s, 2.0) for s in counts}, 20)
    whole = min(counts[s] // share[s] for s in counts) * 20
    for n in range(1, whole + 1):
        seen = Counter(order[:n])
        assert all(abs(seen[s] - share[s] * n / 20) < 1 for s in share)
    for s in counts:
        assert [next(iter(slots[k]))[1] for k in range(len(slots)) if next(iter(slots[k]))[0] == s] == list(range(counts[s]))
    assert mixed(docs.limit(0)).count() == 0
    again = mixed(mixed(docs, block=8))
    assert again.columns == mixed(docs).columns and again.count() == len(rows)


@pytest.mark.parametrize("weights", [{"a": 1, "b": 1, "c": 1}, {"a": 1e-4, "b": 0.7, "c": 0.12345}, {f"s{i}": 1 + i % 7 for i in range(1200)}])
def test_deviation_from_given_weights(weights):
    total, n = sum(weights.values()), 60_000
    blocks = {s: int(w / total * n) + 2 for s, w in weights.items()}
    slots = {}
    for s, first, each, slot, times, length in phases(blocks, weights):
        for t in range(times):
            assert slots.setdefault(slot + t * length, (s, first + t * each)) == (s, first + t * each)
    assert sorted(slots) == list(range(sum(blocks.values())))
    seen = Counter()
    for slot in range(len(slots)):
        s, i = slots[slot]
        assert i == seen[s]
        seen[s] += 1
        if (slot + 1) % 97 == 0 and slot < n // 2:
            assert all(abs(seen[x] - w / total * (slot + 1)) < 1 + 1e-6 for x, w in weights.items())


def test_numbers_of_phases_do_not_grow():
    assert len(phases({"a": 10**9, "b": 10**7}, {"a": 1, "b": 1}, 10)) < 100
    with pytest.raises(ValueError):
        mixed(None, {"a": 0})


# covered runs of a host's pages


def brute_repeated(pages, run, cover, share, least, inside):
    """Repeated blocks of every page (id: html) of one host: runs and whole blocks counted over the distinct pages."""
    parsed = {i: blocks(source or "") for i, source in pages.items()}
    tokens = {i: [plain_words(b.text) for b in page] for i, page in parsed.items()}
    distinct = {tuple(b.text for b in page): i for i, page in parsed.items() if page}
    run_pages, block_pages = {}, {}
    for i in distinct.values():
        flat = [w for b in tokens[i] for w in b]
        for k in range(len(flat) - run + 1):
            run_pages.setdefault(tuple(flat[k : k + run]), set()).add(i)
        for b in tokens[i]:
            if b:
                block_pages.setdefault(tuple(b), set()).add(i)
    enough = lambda held, floor: len(held) >= max(least, floor, share * len(distinct))
    out = {}
    for i, page in parsed.items():
        flat = [w for b in tokens[i] for w in b]
        for floor in (0, inside):
            covered = [False] * len(flat)
            for k in range(len(flat) - run + 1):
                if enough(run_pages.get(tuple(flat[k : k + run]), ()), floor):
                    covered[k : k + run] = [True] * run
            at = 0
            for n, (b, words_) in enumerate(zip(page, tokens[i])):
                part = sum(covered[at : at + len(words_)])
                at += len(words_)
                if b.article == (floor == inside) and words_ and (part >= cover * len(words_) or enough(block_pages.get(tuple(words_), ()), floor)):
                    out.setdefault(i, set()).add(n)
    return {i: main_text(page, out.get(i, set())) for i, page in parsed.items()}


@pytest.mark.parametrize("shard", [2000, 5])
@pytest.mark.parametrize("mark", ["article", "div"])
def test_covered_runs_equal_brute_force(spark, shard, mark):
    from sensorloom.llm import pages as module

    r = random.Random(5)
    notices = [" ".join(f"n{k}x{j}" for j in range(n)) for k, n in enumerate((3, 7, 8, 9, 12, 30))]
    rows, hosts = [], {"a.com": 17, "b.org": 4, "c.net": 1}
    for host, n in hosts.items():
        for i in range(n):
            parts = []
            for _ in range(r.randint(0, 6)):
                own = " ".join(f"w{r.randrange(10**6)}" for _ in range(r.randint(1, 25)))
                notice = r.choice(notices[: 1 + 5 * (r.random() < 0.8)])
                parts.append(r.choice([own, notice, f"{notice} {own}", f"{own} {notice}"]))
            body = "".join(f"<p>{p}</p>" for p in parts)
            rows.append((len(rows), f"http://{host}/{i}", f"<html><body><{mark}>{body}</{mark}><p>{notices[4]}</p></body></html>"))
    rows += [(100 + i, url, source) for i, url, source in rows[:3]] + [(200, "http://a.com/x", None), (201, "http://a.com/y", "")]
    want = {}
    for host in hosts:
        some = {i: source for i, url, source in rows if host in url}
        want |= brute_repeated(some, module.RUN, module.COVER, module.SHARE, module.PAGES, module.ARTICLE_PAGES)
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({"host": F.lit(1), "text": F.lit("x"), "shard": F.lit("y")})
    got = {row["page_id"]: row["text"] for row in extracted(pages, shard_pages=shard).collect()}
    assert got == want
    plain = {i: main_text(blocks(source or ""), set()) for i, _, source in rows}
    assert sum(plain[i] != want[i] for i in want) > 5
