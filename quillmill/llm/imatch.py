"""Document fingerprints by I-Match, with DataFrame functions only.

A lexicon keeps the terms whose document frequency, counted over all documents, lies in a
chosen band: neither boilerplate nor one-off noise. Several randomised subsets of it are
drawn, from a thirty-second of its terms down to a two-hundred-and-fifty-sixth, so that texts of very
different lengths keep few terms in some of them. Per subset, the distinct terms of a
text are hashed in sorted order. Two texts are as alike as the share of subsets, of those
in which either has a term, that give the same hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quillmill.durable import durable
from quillmill.operators.positions import number_rows

#: Band of the document frequency: absolute and relative least, and relative most.
LEAST, LEAST_SHARE, MOST_SHARE = 2, 1e-4, 0.1
#: One term in so many may enter the lexicon at all, by its hash; at 1 the band is that of all terms.
THIN = 1
#: The lexicon is kept as a bit set of fixed size, indexed by the term's hash; a term that
#: shares its bit with one of the lexicon counts as a member, in every text alike.
LEXICON_BITS = 1 << 21
#: Bits of a term's hash that must be zero in a subset; subsets of each such size.
RATES, COPIES = (5, 7, 8), 8
EMPTY = "." * 8


def thin_terms(text: Column) -> Column:
    """Sorted distinct hashes of the terms that may enter the lexicon."""
    hashes = F.transform(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: F.xxhash64(w))
    nothing = F.xxhash64(F.lit(""))
    return F.sort_array(F.array_distinct(F.filter(hashes, lambda h: (h.bitwiseAND(F.lit(THIN - 1)) == 0) & (h != nothing))))


def _bit(term: Column) -> Column:
    return F.shiftrightunsigned(term, 8).bitwiseAND(F.lit(LEXICON_BITS - 1))


def lexicon(texts: DataFrame, text: str = "text") -> DataFrame:
    """One row with the bit set of the lexicon as an array of longs."""
    counted = texts.select(F.explode(thin_terms(F.col(text))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    total = texts.agg(F.count(F.lit(1)).alias("n")).scalar()
    band = counted.where((F.col("df") >= F.greatest(F.lit(float(LEAST)), total * LEAST_SHARE)) & (F.col("df") <= F.greatest(F.lit(float(LEAST)), total * MOST_SHARE)))
    bits = band.select(_bit(F.col("term")).alias("bit")).select(F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("mask"))
    words = bits.groupBy("word").agg(F.bit_or("mask").alias("mask"))
    every = texts.sparkSession.range(LEXICON_BITS // 64).withColumnRenamed("id", "word")
    filled = every.join(words, "word", "left").select("word", F.coalesce("mask", F.lit(0).cast("bigint")).alias("mask"))
    return filled.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "mask"))), lambda s: s["mask"]).alias("words"))


def known_words(texts: DataFrame, text: str = "text") -> Column:
    """The lexicon of ``texts`` as a constant: its bit set of fixed size, 256 KB."""
    return F.split(F.lit(",".join(map(str, lexicon(texts, text).first()["words"]))), ",").cast("array<bigint>")


def subset_hashes(text: Column, words: Column) -> Column:
    """Hash per randomised subset; without any term, all are the hash of the text itself."""

    def member(h: Column) -> Column:
        bit = _bit(h)
        mask = F.element_at(words, (F.shiftright(bit, 6) + 1).cast("int"))
        return F.call_function("shiftrightunsigned", mask, bit.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1

    def hashed(part: Column) -> Column:
        return F.lower(F.lpad(F.hex(F.xxhash64(part).bitwiseAND(F.lit((1 << 32) - 1))), 8, "0"))

    known = F.filter(thin_terms(text), member)
    spread = F.transform(known, lambda h: F.struct(h.alias("h"), *[F.xxhash64(h, F.lit(rate)).alias(f"s{rate}") for rate in RATES]))

    def drawn(terms: Column, rate: int, copy: int) -> Column:
        return F.filter(terms, lambda t: F.shiftrightunsigned(t[f"s{rate}"], rate * copy).bitwiseAND(F.lit((1 << rate) - 1)) == 0)

    def subsets(terms: Column) -> Column:
        parts = []
        for rate in RATES:
            for copy in range(COPIES):
                kept = drawn(terms, rate, copy)
                parts.append(F.when(F.size(kept) > 0, hashed(F.transform(kept, lambda t: t["h"]))).otherwise(F.lit(EMPTY)))
        return F.array(*parts)

    # bound once: the lambda's argument is the computed list
    found = F.element_at(F.transform(F.array(spread), subsets), 1)
    whole = F.array_repeat(hashed(text), len(RATES) * COPIES)
    return F.element_at(F.transform(F.array(found), lambda f: F.when(F.exists(f, lambda x: x != EMPTY), f).otherwise(whole)), 1)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets in which either side has terms."""
    pairs = F.zip_with(a, b, lambda x, y: F.when((x == EMPTY) & (y == EMPTY), F.lit(None)).otherwise((x == y).cast("double")))
    known = F.filter(pairs, lambda v: v.isNotNull())
    return F.aggregate(known, F.lit(0.0), lambda s, v: s + v) / F.greatest(F.size(known), F.lit(1))


def fingerprints(df: DataFrame, text: str = "text", name: str = "fingerprint", words: Column | None = None) -> DataFrame:
    """``df`` with an array of subset hashes; the lexicon is that of ``df`` unless given.

    A null text counts as empty, and texts without terms are known by themselves. Equal
    texts have equal fingerprints. No rows give no rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    words = known_words(df.select(body.alias("text"))) if words is None else words
    return df.withColumn(name, subset_hashes(body, words))


def with_next_text(docs: DataFrame, id: str = "doc_id", text: str = "text", carried=None) -> DataFrame:
    """``id, text, n_chars, edited`` and the next document's ``next``.

    ``edited`` is the text with its second half replaced by the beginning of the next.
    The next document is that with the next smaller id, after the smallest the largest;
    null ids are smallest. ``carried`` is an expression over the text of the next
    document. Rows that agree in id and text are one document in that order and are
    repeated in the result. Places are found on ids alone; then every text sends its
    beginning to one other document.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id).alias("id"), body.alias("text"))
    # the same columns on both sides of the exchange, so that the texts are shuffled once
    keyed = rows.select(F.col("id").isNull().alias("nul"), F.coalesce("id", F.lit(0)).alias("key"), F.xxhash64("text").alias("hash"), F.char_length("text").alias("n_chars"), "text")
    keys = ["nul", "key", "hash", "n_chars"]
    narrow = keyed.select(*keys).distinct()
    places = durable(number_rows(narrow, [F.desc("nul"), "key", "hash", "n_chars"], name="place"), "places")
    total = max(places.count(), 1)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    wanted = places.select(F.pmod(F.col("place") - 1, F.lit(total)).alias("place"), *[F.col(k).alias(f"to_{k}") for k in keys], half.alias("wanted"))
    sends = durable(places.join(wanted, "place").select(*keys, *[f"to_{k}" for k in keys], "wanted"), "sends")
    sent = keyed.join(sends, keys).select(*[F.col(f"to_{k}").alias(k) for k in keys], F.expr("substr(text, 1, wanted)").alias("head"), (F.lit(None) if carried is None else carried(F.col("text"))).alias("next"))
    heads = sent.groupBy(*keys).agg(F.max("head").alias("head"), F.max("next").alias("next"))  # repeated rows send the same
    kept = F.expr("substr(text, 1, n_chars - cast(floor(n_chars / 2) as int))")
    id_again = F.when(~F.col("nul"), F.col("key")).alias("id")
    return keyed.join(heads, keys).select(id_again, "text", "n_chars", F.concat(kept, F.col("head")).alias("edited"), "next")
