"""Document fingerprints: one-permutation MinHash with optimal densification, b-bit packed. Built-ins only.

Every shingle (five words; all words of a shorter text) is hashed once. The top bits of the hash choose one of
``BINS`` bins, the least hash of a bin is its value. An empty bin takes the value of the
first filled bin in an order that hashes of its number give: each empty bin draws from all filled bins alike and by
itself, the same in every document, which is what optimal densification asks for.
Of each value ``BITS`` low-order bits are kept, packed as hex. Two fingerprints agree in a bin by
chance with 2 ** -BITS; the likeness corrects that bias.

All of it is one expression per row: no explode, no shuffle. Only the next document's text in ascending
doc_id has to come from another row: documents are dealt to ranges of doc_id once, and each range gets a
copy of the next range's first row, so no window spans more than a range.

Defined cases: null text is empty; texts without words have a fingerprint of their own; of repeated ids the texts
decide the order; null ids come first; a table of one row is its own next document; an empty table gives no rows;
extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHINGLE_WORDS = 5
BINS = 128
BITS = 8
#: Bins that an empty bin asks one by one before it looks for the first in order among all filled ones.
TRIES = 6
#: Rows of one range of ids, and the most ranges: the driver holds two numbers for each.
RANGE_ROWS = 4_000
MOST_RANGES = 4_096


def shingle_hashes(text: Column) -> Column:
    """Sorted distinct hashes of the shingles of a text."""
    words = F.filter(F.split(F.lower(text), "[ \\t-\\r]+"), lambda w: w != "")

    def runs(word_ids: Column) -> Column:
        n = F.size(word_ids)
        some = F.transform(
            F.sequence(F.lit(1), n - (SHINGLE_WORDS - 1)),
            lambda i: F.xxhash64(*[F.get(word_ids, i + (k - 1)) for k in range(SHINGLE_WORDS)]))
        return F.when(n >= SHINGLE_WORDS, some).otherwise(F.array(F.xxhash64(word_ids)))

    # An array of one element, transformed: the word ids are computed once for all their uses.
    return F.sort_array(F.element_at(F.transform(F.array(F.transform(words, lambda w: F.xxhash64(w))), runs), 1))


def fingerprint(text: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """The low-order bits of all bins, as an array of numbers; ``packed`` makes it a string."""
    width = bins.bit_length() - 1
    bin_of = lambda h: (F.shiftright(h, 64 - width) + bins // 2).cast("int")  # noqa: E731  rises with the hash
    low = lambda h: h.bitwiseAND((1 << bits) - 1).cast("int")

    def filled(hashes: Column) -> Column:
        """Least hash of each bin that has one; hashes are sorted, so equal bins stand together."""
        return F.filter(hashes, lambda h, i: F.coalesce(F.shiftrightunsigned(h.bitwiseXOR(F.get(hashes, i - 1)), 64 - width), F.lit(1)) != 0)

    def dense(held: Column) -> Column:
        def some(numbers: Column) -> Column:
            at = lambda b: F.get(held, F.array_position(numbers, b).cast("int") - 1)  # noqa: E731  null if the bin is empty

            def value(b: Column) -> Column:
                tries = [at(F.pmod(F.xxhash64(b, F.lit(t)), F.lit(bins)).cast("int")) for t in range(TRIES)]
                # The rest of the order in which bins are asked: by a hash of both numbers, the number itself in its low bits.
                last = F.array_min(F.transform(numbers, lambda n: F.shiftleft(F.shiftright(F.xxhash64(b, n, F.lit(-1)), width), width).bitwiseOR(n.cast("long"))))
                lent = F.coalesce(*tries, at(last.bitwiseAND(bins - 1).cast("int")))
                return low(F.coalesce(at(b), F.xxhash64(lent, b)))  # hashed anew: bins of one lender agree by chance each by itself

            return F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), value)

        return F.when(F.size(held) == bins, F.transform(held, low)).otherwise(
            F.element_at(F.transform(F.array(F.transform(held, bin_of)), some), 1))

    once = F.transform(F.array(shingle_hashes(text)), filled)
    return F.element_at(F.transform(once, dense), 1)


def packed(codes: Column, bits: int = BITS) -> Column:
    """Hex of a fingerprint's numbers, ``bits`` each."""
    names = F.array(*[F.lit(f"{k:0{-(-bits // 4)}x}") for k in range(1 << bits)])
    return F.array_join(F.transform(codes, lambda c: F.get(names, c)), "")


def unpacked(fingerprint: Column, bins: int = BINS, bits: int = BITS) -> Column:
    digits = -(-bits // 4)
    return F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.conv(F.substr(fingerprint, i * digits + 1, F.lit(digits)), 16, 10).cast("int"))


def likeness(left: Column, right: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """Estimated Jaccard similarity from the bins that agree, less what agrees by chance."""
    same = F.aggregate(F.zip_with(left, right, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    chance = 2.0 ** -bits
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (same / F.lit(float(bins)) - chance) / (1 - chance)))


def with_next(docs: DataFrame, columns: list[str], derive: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Add ``next_<column>`` of the next row in ascending doc_id, after the last row those of the first.

    ``derive`` adds columns, for each row and for the few that stand at the end of a range a second time, once
    those are found. The driver holds one boundary per range of ``RANGE_ROWS`` rows.
    """
    spark = docs.sparkSession
    count = docs.count()
    if not count:
        docs = derive(docs)
        return docs.select("*", *[F.col(c).alias(f"next_{c}") for c in columns])
    ranges = min(MOST_RANGES, -(-count // RANGE_ROWS))
    cuts = docs.approxQuantile("doc_id", [k / ranges for k in range(1, ranges)], 0.2 / ranges) if ranges > 1 else []
    cuts = sorted({int(c) for c in cuts})
    place = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("doc_id"))) if cuts else F.lit(0)
    placed = docs.withColumn("range", F.when(F.col("doc_id").isNull(), 0).otherwise(place)).withColumn("is_copy", F.lit(False))
    found = placed.groupBy("range").agg(F.min("doc_id").alias("first"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).collect()
    firsts = {r["range"]: None if r["nulls"] else r["first"] for r in found}
    order = sorted(firsts)
    heads = spark.createDataFrame([(r, firsts[after]) for r, after in zip(order, order[1:] + order[:1], strict=True)], "head_range int, head_id long")
    ranked = Window.partitionBy("head_range").orderBy("text")
    copies = (docs.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("head_id"))).withColumn("nth", F.row_number().over(ranked)).where("nth = 1")
              .select(*docs.columns, F.col("head_range").alias("range"), F.lit(True).alias("is_copy")))
    ordered = Window.partitionBy("range").orderBy("is_copy", F.col("doc_id").asc_nulls_first(), "text")
    both = derive(placed).unionByName(derive(copies))
    return both.select("*", *[F.lead(c).over(ordered).alias(f"next_{c}") for c in columns]).where(~F.col("is_copy")).drop("range", "is_copy")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """The contract's row per document, with the edited text's fingerprint and both likenesses."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    rows = with_next(rows, ["text", "fingerprint"], lambda some: some.withColumn("fingerprint", fingerprint(F.col("text"))))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "fingerprint", "next_fingerprint")
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", fingerprint(F.col("edited")).alias("edited_fingerprint"), "next_fingerprint")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", packed(F.col("fingerprint")).alias("fingerprint"), packed(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
