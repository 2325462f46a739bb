"""Document fingerprints by Order MinHash, in DataFrame functions only.

Every text becomes the k-mers of its words, each numbered by how often it has occurred before in the text, so a
repeated k-mer counts as often as it stands there. A hash deals the numbered k-mers to slots; a slot keeps the
least of each half of its hash range, and the two that it keeps are hashed in the order in which they stand in the
text. Moving passages about, which leaves the set of k-mers as it is, changes these tuples: the likeness follows
edit distance, not only the common words.

Rows are dealt to ranges of neighbouring ids once; all later grouping is within those ranges and needs no further
exchange of the texts.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Words in a k-mer, and slots of a fingerprint.
K, SLOTS = 3, 64
#: Ranges (20 bytes each) whose first rows are found by a broadcast; beyond, by a shuffle.
SENT_RANGES = 1_000_000
_SPACE = " \t\n\x0b\f\r"
# a packed k-mer: 33 bits of its hash above 30 bits of its position
_POSITION_BITS = 30


def _ranges(docs: DataFrame, key: str, text: str) -> list:
    """Bounds that cut the ids into ranges of about equal numbers of rows, half a shuffle partition each.

    One number a range comes to the driver: 100 TB in partitions of 256 MB are 800,000."""
    size = docs.sparkSession.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", size.strip().lower()).groups()
    range_bytes = max(1 << 20, (int(number) << 10 * " kmgt".index(unit or " ")) // 2)
    stats = docs.agg(
        F.sum(F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 16).alias("bytes"), F.count(key).alias("ids")
    ).first()
    n = max(1, -(-(stats["bytes"] or 0) // range_bytes))
    if n == 1 or not stats["ids"]:
        return []
    cuts = docs.agg(F.percentile_approx(key, F.array(*[F.lit(i / n) for i in range(1, n)]), 20 * n)).first()[0]
    return sorted(set(cuts))


def _range_of(key: Column, bounds: list) -> Column:
    """Number of bounds at or below the id; null ids come first."""
    if not bounds:
        return F.lit(0)

    def within(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(key < F.lit(bounds[mid]), within(low, mid)).otherwise(within(mid + 1, high))

    if len(bounds) <= 64:
        return F.when(key.isNull(), F.lit(0)).otherwise(within(0, len(bounds)))
    # two steps of about sqrt(n) comparisons
    step = int(len(bounds) ** 0.5)
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    group = F.greatest(F.size(F.filter(F.lit([g[0] for g in groups]), lambda b: b <= key)), F.lit(1))
    inner = F.size(F.filter(F.element_at(F.array(*[F.lit(g) for g in groups]), group), lambda b: b <= key))
    return F.when(key.isNull(), F.lit(0)).otherwise((group - 1) * step + inner)


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns part, place, id, text, next_text, guest: each row with the text of the row after it by ascending id.

    After the last row comes the first. Null ids come first; rows of equal ids follow each other by the hash of
    their texts. Null texts are empty. Each range also holds a copy of the next range's first row (guest), so that
    all that follows stays within a range.
    """
    bounds = _ranges(docs, key, text)
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("part", _range_of(F.col("id"), bounds)).withColumn("tie", F.xxhash64("text"))
    heads = rows.groupBy("part").agg(F.min(F.struct("id", "tie")).alias("head")).orderBy("part").collect()
    guests = [(heads[i]["part"], *heads[(i + 1) % len(heads)]["head"]) for i in range(len(heads))]
    if not guests:
        return rows.select("part", F.lit(1).alias("place"), "id", "text", F.lit("").alias("next_text"), F.lit(False).alias("guest"))
    # one row a range, from the aggregate above: small whatever the texts are, and sent to all tasks only up to a size
    ids = docs.sparkSession.createDataFrame(guests, "to_part int, head_id long, head_tie long")
    if len(guests) <= SENT_RANGES:
        ids = F.broadcast(ids)
    same = F.col("id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie"))
    spots = F.array(F.struct("part", F.lit(False).alias("guest")), F.struct(F.col("to_part").alias("part"), F.lit(True).alias("guest")))
    spots = F.when(F.col("to_part").isNull(), F.slice(spots, 1, 1)).otherwise(spots)
    both = rows.join(ids, same, "left").select("id", "text", "tie", F.inline(spots))
    # as many partitions as ranges: what a task sorts stays in memory
    both = both.repartition(len(guests), "part")
    order = Window.partitionBy("part").orderBy("guest", "id", "tie")
    return both.select(
        "part",
        F.row_number().over(order).alias("place"),
        "id",
        "text",
        F.coalesce(F.lead("text").over(order), F.lit("")).alias("next_text"),
        "guest",
    )


def edited(text: Column, following: Column) -> Column:
    """The text with its last floor(n/2) code points replaced by the first as many of the following text."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(following, F.lit(1), half))


def order_minhash(texts: DataFrame, keys: list[str], text: str = "text", k: int = K, slots: int = SLOTS) -> DataFrame:
    """Columns keys and tokens (sorted array<bigint>, slot above 24 bits of tuple hash) of every text with a word.

    Texts without words have no row. A text of fewer than k words is one k-mer. Equal texts have equal tokens.
    """
    spaced = F.split(F.btrim(F.lower(text), F.lit(_SPACE)), "[\\x20\\x09-\\x0D]+")
    rows = texts.select(*keys, spaced.alias("w")).filter(F.col("w")[0] != "")
    n = F.size("w")
    rows = rows.select(*keys, "w", F.explode(F.sequence(F.lit(0), F.greatest(n - k, F.lit(0)))).alias("pos"))
    gram = F.xxhash64(*[F.get("w", F.col("pos") + i) for i in range(k)])
    rows = rows.select(*keys, "pos", gram.alias("gram"))
    seen = Window.partitionBy("gram", *keys).orderBy("pos")
    rows = rows.select(*keys, "pos", F.xxhash64("gram", F.row_number().over(seen)).alias("h"))
    packed = F.shiftleft(F.shiftrightunsigned("h", 31), _POSITION_BITS).bitwiseOR(F.col("pos").cast("bigint"))
    slot = F.col("h").bitwiseAND(F.lit(slots - 1)).cast("int")
    upper = F.shiftright("h", 20).bitwiseAND(F.lit(1)) == 1
    kept = (
        rows.select(*keys, slot.alias("slot"), upper.alias("upper"), packed.alias("packed"))
        .groupBy(*keys, "slot")
        .agg(F.min(F.when(~F.col("upper"), F.col("packed"))).alias("a"), F.min(F.when(F.col("upper"), F.col("packed"))).alias("b"))
    )
    mask = F.lit((1 << _POSITION_BITS) - 1).cast("bigint")
    a, b = F.shiftright("a", _POSITION_BITS), F.shiftright("b", _POSITION_BITS)
    first = F.col("b").isNull() | (F.col("a").bitwiseAND(mask) <= F.col("b").bitwiseAND(mask))
    pair = F.when(first, F.xxhash64(a, b)).otherwise(F.xxhash64(b, a, F.lit(1)))
    token = F.col("slot").cast("bigint") * F.lit(1 << 24) + pair.bitwiseAND(F.lit((1 << 24) - 1))
    return kept.select(*keys, token.alias("token")).groupBy(*keys).agg(F.sort_array(F.collect_list("token")).alias("tokens"))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of text in common, 0 to 1, from the share r of filled slots whose tuples agree.

    Both k-mers of a tuple must be common for it to agree, so sqrt(r) estimates the Jaccard similarity j of the
    numbered k-mers, and 2j/(1+j) the part of either text that the other has. 1 for two empty texts."""
    slot = lambda t: F.transform(t, lambda x: F.shiftright(x, 24))
    either = F.size(a) + F.size(b) - F.size(F.array_intersect(slot(a), slot(b)))
    j = F.sqrt(F.size(F.array_intersect(a, b)) / either)
    return F.when(either == 0, F.lit(1.0)).otherwise(2 * j / (1 + j))


def fingerprint_text(tokens: Column) -> Column:
    """The tokens as hex digits, eight each; empty for a text without words."""
    return F.array_join(F.transform(tokens, lambda t: F.lpad(F.lower(F.hex(t)), 8, "0")), "")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, slots: int = SLOTS) -> DataFrame:
    """Fingerprint of every text, of its edited text, and how like they and the next text's are.

    Columns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next; one row for each
    row given. Null texts are empty, their fingerprint is the empty string. See ``with_next`` for the order.
    Other columns of the table are left alone.
    """
    rows = with_next(docs, key, text)
    changed = edited(F.col("text"), F.col("next_text"))
    about = rows.filter(~F.col("guest")).select(
        "part", "place", F.col("id").alias(key), F.char_length("text").cast("bigint").alias("n_chars"), F.sha2(changed.cast("binary"), 256).alias("edited_sha256")
    )
    sides = rows.select("part", "place", F.posexplode(F.array("text", changed)).alias("side", "t"))
    sides = sides.select("part", (F.col("place") * 2 + F.col("side")).alias("spot"), "t")
    marks = order_minhash(sides, ["part", "spot"], "t", k, slots)
    both = marks.groupBy("part", F.shiftright("spot", 1).alias("place")).agg(
        F.first(F.when(F.col("spot") % 2 == 0, F.col("tokens")), True).alias("own"),
        F.first(F.when(F.col("spot") % 2 == 1, F.col("tokens")), True).alias("changed"),
    )
    empty = F.array().cast("array<bigint>")
    places = rows.select("part", "place")
    order = Window.partitionBy("part").orderBy("place")
    marked = places.join(both, ["part", "place"], "left").select(
        "part", "place", F.coalesce("own", empty).alias("own"), F.coalesce("changed", empty).alias("changed")
    )
    marked = marked.withColumn("following", F.lead("own").over(order))
    return about.join(marked, ["part", "place"]).select(
        key,
        "n_chars",
        "edited_sha256",
        fingerprint_text(F.col("own")).alias("fingerprint"),
        fingerprint_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.coalesce("following", empty)).alias("near_next"),
    )
