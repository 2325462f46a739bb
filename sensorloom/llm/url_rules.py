"""URL filters from association rules.

URLs whose verdict is known (by a list of host and path rules) are baskets of tokens with their verdict as one more
item. FP-growth finds the token combinations that often come with a verdict; those with enough support and confidence,
and no shorter rule that says the same at least as surely, are kept and applied to all other URLs through an index
from each rule's rarest token.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import column_of, prepare
from sensorloom.session import written

#: Part of the known URLs that a combination must be in, part of them that must agree, and tokens of a combination.
SUPPORT, CONFIDENCE, TOKENS = 0.002, 0.9, 3
#: Frequent tokens of a URL up to which FP-growth is given the baskets: it looks at up to 2**WIDE combinations of one. Where
#: a URL has more, combinations of TOKENS tokens or fewer are counted level by level, which finds the same rules.
WIDE = 16
#: What a URL gets that no rule speaks about.
OTHERWISE = "allow"


@dataclass(frozen=True)
class ListRule:
    """verdict for a host (and its subdomains) and the paths that begin with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What is between the first ``://`` and /, ?, # or the end, A-Z lower-cased; then up to ?, # or the end.

    Null, and a text without ``://``, gives two empty texts."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.char_length(text))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def listed(host: Column, path: Column, rules: list[ListRule]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null; of equally long ones the first."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(enumerate(rules), key=lambda r: (len(r[1].text), -r[0])):
        rule = rule[1]
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens: host labels (h:), words of the path (p:), its ending (e:), names of query parameters (q:).

    Digits become 0, so that numbers do not make every URL a token of its own."""
    marked = lambda mark, words: F.transform(F.filter(words, lambda w: w != ""), lambda w: F.concat(F.lit(mark), w))
    plain = lambda c: F.regexp_replace(F.lower(c), "[0-9]+", "0")
    query = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), "(?s)\\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda p: F.regexp_replace(F.lower(p), "(?s)=.*", ""))
    ending = F.array(F.regexp_extract(F.lower(path), "\\.([a-z0-9]{1,5})$", 1))
    return F.array_distinct(
        F.concat(
            marked("h:", F.split(plain(host), "\\.")), marked("p:", F.split(plain(path), "[/._-]")), marked("e:", ending), marked("q:", names)
        )
    )


def _grown(known: DataFrame, support: float, confidence: float, size: int) -> list:
    """Rules by FP-growth, which finds the frequent combinations of any size: up to 2**WIDE of a URL."""
    baskets = known.select(F.array_distinct(F.concat("tokens", F.array(F.concat(F.lit("="), "verdict")))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    rules = model.associationRules.filter(F.size("consequent") == 1).filter(F.col("consequent")[0].startswith("="))
    rules = rules.filter(F.size("antecedent") <= size).filter(~F.exists("antecedent", lambda t: t.startswith("=")))
    return rules.select(F.sort_array("antecedent").alias("t"), F.substring(F.col("consequent")[0], 2, 99).alias("v"), "confidence", "support").collect()


def _levelled(tokens_: DataFrame, n: int, least: int, confidence: float, size: int) -> list:
    """The same rules level by level, with no combination beyond ``size`` tokens: (id, verdict, n, t) are the frequent tokens.

    A combination of one token more joins two that differ in their last one; only those frequent enough go on."""
    now, out = tokens_.select("id", "verdict", "n", F.array("t").alias("t")), []
    for k in range(1, size + 1):
        both = written(now.groupBy("t", "verdict").agg(F.sum("n").alias("both")), "counts")
        all_ = both.groupBy("t").agg(F.sum("both").alias("c"))
        sure = both.filter(F.col("both") >= least).join(all_, "t").withColumn("confidence", F.col("both") / F.col("c"))
        rules = sure.filter(F.col("confidence") >= confidence)
        out += rules.select("t", F.col("verdict").alias("v"), "confidence", (F.col("both") / n).alias("support")).collect()
        if k < size:
            now = written(now.join(all_.filter(F.col("c") >= least).select("t"), "t", "left_semi"), "combinations")
            last, rest = F.element_at("t", -1), F.slice("t", 1, k - 1) if k > 1 else F.array().cast("array<string>")
            one = now.select("id", "verdict", "n", rest.alias("rest"), last.alias("x"))
            two = one.select("id", "rest", F.col("x").alias("y"))
            more = one.join(two, ["id", "rest"]).filter("x < y")
            now = more.select("id", "verdict", "n", F.concat("rest", F.array("x", "y")).alias("t"))
    return out


def mine(known: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, size: int = TOKENS) -> list[tuple[list[str], str, float, float]]:
    """Rules (tokens, verdict, confidence, support) from rows of tokens and verdict, the surest first.

    A rule is pruned where a part of its tokens gives the same verdict at least as surely. No rows give no rules. The
    driver gets as many rules as there are frequent combinations of ``size`` tokens or fewer: at most the mean number of
    such combinations in a URL divided by the support, whatever the number of URLs."""
    n = known.count()
    if not n:
        return []
    least = math.ceil(support * n)
    # equal baskets are one row with their number
    baskets = known.select(F.array_sort(F.array_distinct("tokens")).alias("tokens"), "verdict").groupBy("tokens", "verdict").agg(F.count("*").alias("n"))
    baskets = written(baskets.withColumn("id", F.monotonically_increasing_id()), "baskets")
    tokens_ = baskets.select("id", "verdict", "n", F.explode("tokens").alias("t"))
    often = tokens_.groupBy("t").agg(F.sum("n").alias("c")).filter(F.col("c") >= least).select("t")
    tokens_ = written(tokens_.join(often, "t"), "tokens")
    widest = tokens_.groupBy("id").agg(F.count("*").alias("c")).agg(F.max("c")).first()[0] or 0
    if widest <= WIDE:
        found = _grown(known, support, confidence, size)
    else:
        found = _levelled(tokens_, n, least, confidence, size)
    kept: dict[tuple[frozenset, str], float] = {}
    out = []
    for r in sorted(found, key=lambda r: (len(r["t"]), -r["confidence"], -r["support"], r["t"])):
        own = frozenset(r["t"])
        parts = [frozenset(x for i, x in enumerate(r["t"]) if bits >> i & 1) for bits in range(1, 2 ** len(r["t"]) - 1)]
        if any(kept.get((p, r["v"]), -1.0) >= r["confidence"] for p in parts):
            continue
        kept[own, r["v"]] = r["confidence"]
        out.append((list(r["t"]), r["v"], float(r["confidence"]), float(r["support"])))
    return sorted(out, key=lambda r: (-r[2], -len(r[0]), -r[3], r[0], r[1]))


def _applied(rules: list, otherwise: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # inverted index: a rule stands under the token that the fewest rules have
        often: dict[str, int] = {}
        for r in rules:
            for t in r[0]:
                often[t] = often.get(t, 0) + 1
        index: dict[str, list[int]] = {}
        for i, r in enumerate(rules):
            index.setdefault(min(r[0], key=lambda t: (often[t], t)), []).append(i)
        for batch in batches:
            verdict, by = [], []
            for own in column_of(batch, "tokens").to_pylist():
                held = set(own)
                hits = (i for t in held for i in index.get(t, ()) if held.issuperset(rules[i][0]))
                best = min(hits, default=None)
                verdict.append(otherwise if best is None else rules[best][1])
                by.append(None if best is None else " ".join(rules[best][0]))
            yield pa.RecordBatch.from_arrays(
                [*(column_of(batch, k) for k in keep), pa.array(verdict, pa.string()), pa.array(by, pa.string())], [*keep, "mined", "mined_by"]
            )

    return run


def judged(
    pages: DataFrame, rules: list[ListRule], key: str = "page_id", url: str = "url", otherwise: str = OTHERWISE,
    support: float = SUPPORT, confidence: float = CONFIDENCE,
) -> DataFrame:
    """Columns page_id, host, path, rule, verdict, mined_by of every row.

    ``rule`` is the longest list rule that fits, else null; ``verdict`` is its verdict, else that of the surest mined rule
    (ties: more tokens, more support, then by name), else ``otherwise``. Other columns are left alone.
    """
    prepare(pages.sparkSession)
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(key).alias("id"), F.col(url).alias("url"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("l", listed(F.col("host"), F.col("path"), rules)).withColumn("tokens", tokens(F.col("host"), F.col("path"), F.col("url")))
    known = rows.filter(F.col("l").isNotNull()).select("tokens", F.col("l.verdict").alias("verdict"))
    mined = mine(known, support, confidence)
    rows = rows.select("id", "host", "path", F.col("l.rule").alias("rule"), F.col("l.verdict").alias("sure"), "tokens")
    kind = dict(rows.dtypes)["id"]
    keep = ["id", "host", "path", "rule", "sure"]
    out = rows.mapInArrow(_applied(mined, otherwise, keep), f"id {kind}, host string, path string, rule string, sure string, mined string, mined_by string")
    return out.select(
        F.col("id").alias(key), "host", "path", "rule", F.coalesce("sure", "mined").alias("verdict"), F.when(F.col("rule").isNull(), F.col("mined_by")).alias("mined_by")
    )
