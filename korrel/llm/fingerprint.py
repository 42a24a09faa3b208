"""Document fingerprints by one-permutation MinHash with optimal densification, in DataFrame operations only.

Every five-word shingle is hashed once. The high bits of the hash name its bin, the rest is its value; a bin keeps its least
value. An empty bin takes the value of the first bin that is not empty in its own random sequence of bins, the same for all
documents: a few probes at first, then the order of a second hash over the bins in use. Of each bin the four low bits are
stored, as one hexadecimal digit. Two sets of likeness J agree in a digit with probability J + (1 - J) / 16, and the likeness
that is returned is corrected for that.

The next document stands in the same block or is the first of the next block. Blocks are cut at quantiles of a bounded sample of
the whole order (id, text hash, row), so that neither an id far from the others nor one that a third of all rows have, null
included, makes a block large.

Cases: null and empty texts, and texts without words, have a fingerprint of dashes; it is like another such fingerprint and
unlike any other. Texts of fewer than five words have their whole sequence as the only shingle. Rows that repeat a doc_id, and
null ids, which come last, are ordered by a hash of the text, then by their place in the files. A single document is its own next
one; an empty table gives an empty one. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch

SHINGLE, BINS, BITS, PROBES = 5, 256, 4, 8
#: Low bits of a 63-bit hash, below the bin's number.
VALUE = 55
#: Documents that are put in order together, on average; most blocks; and sampled rows for each border of two blocks.
BLOCK, BLOCKS, SAMPLED = 256, 16_384, 16
#: Borders are looked up among the first ones of runs of so many, then in one run.
RUN = 128
_TOP = (1 << VALUE) - 1


def _probes() -> list[list[int]]:
    """For each bin the bins that it tries first, by a multiplicative hash of (bin, attempt)."""
    out = []
    for b in range(BINS):
        x, row = (b + 1) * 0x9E3779B97F4A7C15 % (1 << 64), []
        for _ in range(PROBES):
            x = (x ^ (x >> 29)) * 0xBF58476D1CE4E5B9 % (1 << 64)
            row.append((x >> 40) % BINS)
        out.append(row)
    return out


def _literal(values: list) -> Column:
    return F.array(*(_literal(v) if isinstance(v, list) else F.lit(v) for v in values))


def hashes_of(text: Column) -> tuple[Column, Column]:
    """The hashes of a text's words, and, of an array of such hashes named ``_words``, those of its shingles (63 bits)."""
    words = F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+"), "")
    w, positive = F.col("_words"), F.lit((1 << 63) - 1)
    starts = F.sequence(F.lit(0), F.greatest(F.size(w) - SHINGLE, F.lit(0)))
    many = F.transform(starts, lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(SHINGLE))).bitwiseAND(positive))
    return F.transform(words, lambda x: F.xxhash64(x)), F.when(F.size(w) >= SHINGLE, many).otherwise(F.array(F.xxhash64(w).bitwiseAND(positive)))


def with_digits(df: DataFrame, text: str, digits: str) -> DataFrame:
    """``df`` with the digits (an array of bytes) of the text column; an empty array if the text has no words."""
    own = [c for c in df.columns if c != digits]
    words, many = hashes_of(F.col(text))
    df = df.select(*own, words.alias("_words"))
    n = F.size("_words")
    # the greatest value of every bin stands for an empty one, so that each bin has a first value
    ends = _literal([(b << VALUE) | _TOP for b in range(BINS)])
    df = df.select(*own, n.alias("_n"), F.sort_array(F.concat(many, ends)).alias("_hashes"))

    def bin_of(h: Column) -> Column:
        return F.shiftright(h, VALUE)

    first = F.filter("_hashes", lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get("_hashes", i - 1))))
    df = df.select(*own, "_n", first.alias("_first"))
    low = F.lit(_TOP)

    def used(j: Column) -> Column:
        return F.get("_first", j).bitwiseAND(low) != low

    def fill(b: Column) -> Column:
        quick = F.get(F.filter(F.get(_literal(_probes()), b), used), F.lit(0))
        # the bin in use with the least hash of (this bin, that bin): the first one in a random order of all bins
        rest = F.array_min(F.transform("_used", lambda j: F.struct(F.xxhash64(b, j).alias("h"), j.alias("j"))))["j"]
        return F.get("_first", F.coalesce(quick, rest))

    df = df.select(*own, "_n", "_first", F.filter(_literal(list(range(BINS))), used).alias("_used"))
    dense = F.transform("_first", lambda h, b: F.when(h.bitwiseAND(low) != low, h).otherwise(fill(b)).bitwiseAND(F.lit((1 << BITS) - 1)).cast("byte"))
    return df.select(*own, F.when(F.col("_n") > 0, dense).otherwise(F.array().cast("array<byte>")).alias(digits))


def packed(digits: Column) -> Column:
    """The digits as a string: one hexadecimal digit for each bin."""
    text = F.array_join(F.transform(digits, lambda d: F.substring(F.lit("0123456789abcdef"), d.cast("int") + 1, F.lit(1))), "")
    return F.when(F.size(digits) > 0, text).otherwise(F.lit("-" * BINS))


def likeness(a: Column, b: Column) -> Column:
    """Estimated likeness, 0 to 1, of the sets that two fingerprints' digits stand for."""
    agree = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    chance = 1.0 / (1 << BITS)
    estimate = F.greatest(F.lit(0.0), (agree / float(BINS) - chance) / (1.0 - chance))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(estimate)


def _key() -> Column:
    """The order of the documents: descending ids, null last, then the text's hash, then the row's place."""
    down = F.coalesce(F.bitwise_not(F.col("doc_id").cast("long")), F.lit(0).cast("long"))
    return F.struct(F.col("doc_id").isNull().alias("without"), down.alias("down"), F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"))


def _borders(keys: DataFrame) -> DataFrame:
    """One row: the borders between blocks, in runs, and the first border of each run."""
    n = keys.count()
    blocks = max(1, min(BLOCKS, -(-n // BLOCK)))
    bound = SAMPLED * blocks
    share = int(min(1.0, bound / max(n, 1)) * (1 << 31))
    some = keys.filter(F.pmod(F.xxhash64("key.row", "key.tie", F.lit("borders")), F.lit(1 << 31)) < share)
    row = some.agg(F.sort_array(F.collect_list("key")).alias("s"))
    # a border's number times the sample's size is beyond 32 bits from about 11,600 blocks on
    cuts = F.transform(F.sequence(F.lit(1), F.lit(max(1, blocks - 1))), lambda i: F.get("s", F.floor(i.cast("long") * F.size("s") / blocks).cast("int")))
    # without any document, or with one block, there is no border
    row = row.select(F.when((F.size("s") > 0) & F.lit(blocks > 1), cuts).otherwise(F.slice("s", 1, 0)).alias("cuts"))
    runs = F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size("cuts") - 1, F.lit(0)) / RUN).cast("int")), lambda i: F.slice("cuts", i * RUN + 1, RUN))
    row = row.select(runs.alias("runs"))
    return row.select("runs", F.filter(F.transform("runs", lambda r: F.get(r, F.lit(0))), lambda x: x.isNotNull()).alias("heads"))


def _placed(rows: DataFrame, borders: DataFrame) -> DataFrame:
    """``rows(key, ...)`` with the number of their block: the borders that are not above their key.

    A join copies what it adds into each row: the first borders of the runs, then those of one run, never all of them.
    """
    own = rows.columns
    rows = rows.join(F.broadcast(borders.select("heads")))  # a single row of bounded size
    rows = rows.select(*own, (F.size(F.filter("heads", lambda h: h <= F.col("key"))) - 1).alias("run"))
    runs = borders.select(F.posexplode("runs").alias("run", "cuts"))
    rows = rows.join(F.broadcast(runs), "run", "left")
    inside = F.size(F.filter("cuts", lambda b: b <= F.col("key")))
    return rows.select(*own, F.when(F.col("run") < 0, 0).otherwise(F.col("run") * RUN + inside).alias("block"))


def with_next(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs(doc_id, text)`` with digits, and text and digits of the next document in descending doc_id, the first after the last.

    Texts are shuffled once, by block, and the first document of the next block is a guest in each.
    """
    keyed = docs.withColumn("key", _key())
    keys = scratch.keep(keyed.select("key"), "keys")
    borders = scratch.keep(_borders(keys), "borders")
    heads = _placed(keys, borders).groupBy("block").agg(F.min("key").alias("head"))
    # at most BLOCKS rows: each block's first document is a guest of the block before, that of the first block one of the last block
    before = F.coalesce(F.lag("block").over(W.orderBy("block")), F.max("block").over(W.partitionBy()))
    heads = scratch.keep(heads.select("head.without", "head.down", "head.tie", before.alias("host")), "heads")
    is_head = (F.col("key.without") == F.col("without")) & (F.col("key.down") == F.col("down")) & (F.col("key.tie") == F.col("tie"))
    guests = keyed.join(F.broadcast(heads), is_head).groupBy(F.col("host").alias("block")).agg(F.first("text").alias("text"))
    guests = guests.select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit(None).cast(keys.schema["key"].dataType).alias("key"), "block", F.lit(1).alias("guest"))
    both = _placed(keyed, borders).withColumn("guest", F.lit(0)).select("doc_id", "text", "key", "block", "guest").unionByName(guests)
    both = with_digits(both, "text", "digits")
    order = W.partitionBy("block").orderBy("guest", "key")
    both = both.withColumn("next_text", F.lead("text").over(order)).withColumn("next_digits", F.lead("digits").over(order))
    return both.filter("guest = 0").drop("guest", "key", "block")


def fingerprints(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Fingerprint of each text of ``docs(doc_id, text)`` and of its edited text, and how like they and the next one's are."""
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    both = with_next(docs, scratch)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    both = both.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), packed(F.col("digits")).alias("fingerprint"), "digits", likeness(F.col("digits"), F.col("next_digits")).alias("near_next"))
    both = with_digits(both, "edited", "edited_digits")
    return both.select(
        "doc_id",
        "n_chars",
        "edited",
        "fingerprint",
        packed(F.col("edited_digits")).alias("edited_fingerprint"),
        likeness(F.col("digits"), F.col("edited_digits")).alias("near_edited"),
        "near_next",
    )
