"""Mix sources to target weights by a low-discrepancy schedule of equal-token blocks.

Targets: each source gets its share by weight; a share above ``cap`` times the source's own words stops there
and the excess is shared out again, one aggregate over the sources per round.

Schedule: slot i is the van der Corput point of i, mapped through the sources' cumulative targets, so that
every stretch of slots holds the sources close to their weights. Slots are ranked per source. A source has a quota
of ``ceil(target / block_words)`` slots, the last one shorter: slots beyond it fall out, and the few that the points
leave out are appended. So each source takes exactly its target in whole words.

Content: the documents of a source, shuffled by a seeded hash, are laid end to end, as often as the target needs; the stretch
``[r * block_words, (r + 1) * block_words)`` is the block of the source's r-th slot. The words are a
document's maximal runs of anything but ASCII white space. A document stands in a pass once, so it is taken at most
``cap`` times.

A hot source is spread by ranges of its shuffled order (``ordering.running``); the points fill all cells of the
cumulative weights evenly; a block holds at most ``block_words`` documents. Nothing is collected but two sums a
round and one row per range.

Defined cases: a null text, or one of white space, has size 0 and is taken 0 times; null sources are one source,
the last; sources are ordered by code point; rows that repeat a ``doc_id`` are documents each, in order of size where
their hashes tie; texts have any length; an empty table gives no rows; only ``doc_id``, ``source`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streambed.llm.ordering import running
from streambed.llm.shared import materialize

WEIGHTS = (5, 2, 1)
#: Times its own words that a source gives at most.
CAP = 3
#: Words of a slot.
BLOCK_WORDS = 1024
#: Cells of the cumulative weights, at least; more where there are more sources.
CELLS = 4096

_WORD = r"[^\x20\x09-\x0D]+"
_POINT_BITS = 62


def _swapped(x: Column, mask: int, bits: int) -> Column:
    return F.shiftleft(x.bitwiseAND(F.lit(mask)), bits).bitwiseOR(F.shiftright(x, bits).bitwiseAND(F.lit(mask)))


def _reversed_31(x: Column) -> Column:
    """The low 31 bits of a long in reverse."""
    for mask, bits in ((0x55555555, 1), (0x33333333, 2), (0x0F0F0F0F, 4), (0x00FF00FF, 8), (0x0000FFFF, 16)):
        x = _swapped(x, mask, bits)
    return F.shiftright(x, 1)


def van_der_corput(i: Column) -> Column:
    """The point of i in base 2, times 2^62; i is a long below 2^62."""
    low, high = i.bitwiseAND(F.lit((1 << 31) - 1)), F.shiftright(i, 31)
    return F.shiftleft(_reversed_31(low), 31).bitwiseOR(_reversed_31(high))


def sized(docs: DataFrame, seed: str) -> DataFrame:
    """``doc_id``, ``source_key`` (never null, null source last), ``size`` in words and the hash that shuffles."""
    name = F.col("doc_id").cast("string")
    return docs.select(
        "doc_id", F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source"))).alias("source_key"),
        F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(name, F.lit("")))).alias("shuffle"))


def _wide(value: Column) -> Column:
    return value.cast("decimal(19,0)")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Add ``source_no``, ``target`` and ``quota`` (whole words) to sources (``source_key``, ``source_size``)."""
    ranked = running(sources.withColumn("all", F.lit(0)), "all", ["source_key"], purpose="mix-sources")
    ranked = ranked.select("source_key", "source_size", F.col("place").alias("source_no"),
                           F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")).cast("long").alias("weight"))
    most = F.col("source_size") * cap

    def above(words: int, weight: int) -> Column:
        return _wide(F.col("weight")) * _wide(F.lit(words)) > _wide(most) * _wide(F.lit(weight))

    everything = ranked.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    words, weight, stopped = everything.words or 0, everything.weight or 0, 0
    while weight:
        at = ranked.where(above(words, weight)).agg(F.count("*").alias("n"), F.sum(most).alias("words"), F.sum("weight").alias("weight")).first()
        if at.n == stopped:
            break
        stopped, words, weight = at.n, everything.words - at.words, everything.weight - at.weight
    stops = above(words, weight) if weight else F.lit(True)
    share = F.col("weight") * F.lit(words).cast("long")
    per = F.lit(max(weight, 1)).cast("long")
    return ranked.select(
        "source_no", "source_key", "source_size",
        F.when(stops, most.cast("double")).otherwise(share.cast("double") / per.cast("double")).alias("target"),
        F.when(stops, most).otherwise(F.floor(share.cast("decimal(38,0)") / per.cast("decimal(19,0)")).cast("long")).alias("quota"))


def schedule(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``slot``, ``source_no``, ``rank`` and ``words`` of every slot, from sources with their quotas."""
    spark = sources.sparkSession
    laid = running(sources.select("source_no", "quota").withColumn("all", F.lit(0)), "all", ["source_no"], "quota", "mix-weights")
    laid = laid.select("source_no", "quota", F.col("before").alias("low"), (F.col("before") + F.col("quota")).alias("high"))
    whole = laid.agg(F.sum("quota").alias("words"), F.count("*").alias("n")).first()
    total = whole.words or 0
    slots = -(-total // block_words)
    width = max(1, -(-total // max(CELLS, whole.n)))
    point = F.floor(van_der_corput(F.col("id")).cast("decimal(19,0)") * F.lit(total).cast("decimal(19,0)") / F.lit(1 << _POINT_BITS).cast("decimal(19,0)")).cast("long")
    points = spark.range(slots).select(F.col("id").alias("slot"), F.least(point, F.lit(max(total - 1, 0))).alias("point"))
    cells = laid.where("quota > 0").select(
        "source_no", "low", "high", F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))).alias("cell"))
    mapped = points.withColumn("cell", F.floor(F.col("point") / width)).join(cells, "cell").where("point >= low AND point < high")
    ranked = running(mapped.select("source_no", "slot"), "source_no", ["slot"], purpose="mix-slots").select("source_no", "slot", F.col("place").alias("rank"))
    quotas = laid.where("quota > 0").select("source_no", "quota", F.ceil(F.col("quota") / block_words).alias("slots"))
    held = quotas.join(ranked.groupBy("source_no").agg(F.count("*").alias("got")), "source_no", "left")
    missing = held.where(F.coalesce("got", F.lit(0)) < F.col("slots")).select(
        "source_no", F.explode(F.sequence(F.coalesce("got", F.lit(0)), F.col("slots") - 1)).alias("rank"), F.lit(0).alias("all"))
    added = running(missing, "all", ["source_no", "rank"], purpose="mix-added").select("source_no", (F.col("place") + slots).alias("slot"), "rank")
    return ranked.unionByName(added).join(quotas, "source_no").where(F.col("rank") < F.col("slots")).select(
        "slot", "source_no", "rank", F.least(F.lit(block_words).cast("long"), F.col("quota") - F.col("rank") * block_words).alias("words"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, block_words: int = BLOCK_WORDS, seed: str = "mix") -> tuple[DataFrame, DataFrame]:
    """The documents with their sources' figures, and the mix itself.

    The mix has a row per stretch of words: ``slot``, ``source_no``, ``rank``, ``row`` and ``doc_id`` of the document,
    ``repeat`` (from 0), ``begin`` (its first word, from 0) and ``words``. In order of slot, repeat and the shuffled
    documents (``row``) it is the text of the mix.
    """
    rows = running(sized(docs, seed), "source_key", ["shuffle", "doc_id", "size"], "size", "mix-documents")
    figures = materialize(targets(rows.groupBy("source_key").agg(F.sum("size").alias("source_size")), weights, cap), "mix-targets")
    known = rows.select("row", "doc_id", "size", "before", "source_key").join(figures, "source_key")
    plan = materialize(schedule(figures, block_words), "mix-schedule")
    repeat = known.where("size > 0").withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(cap - 1))))
    start = F.col("repeat") * F.col("source_size") + F.col("before")
    laid = repeat.withColumn("start", start).where(F.col("start") < F.col("quota")).withColumn("end", F.least(F.col("start") + F.col("size"), F.col("quota")))
    last = F.floor((F.col("end") - 1) / block_words)
    cut = laid.withColumn("rank", F.explode(F.sequence(F.floor(F.col("start") / block_words), last)))
    begin = F.greatest(F.col("start"), F.col("rank") * block_words)
    pieces = cut.select(
        "source_no", "rank", "row", "doc_id", "repeat", (begin - F.col("start")).alias("begin"),
        (F.least(F.col("end"), (F.col("rank") + 1) * block_words) - begin).alias("words"))
    content = pieces.join(plan.select("source_no", "rank", "slot"), ["source_no", "rank"]).select(
        "slot", "source_no", "rank", "row", "doc_id", "repeat", "begin", "words")
    return known.select("row", "doc_id", "size", "source_no", "source_size", "target"), content


def mixing_digest(docs: DataFrame) -> DataFrame:
    """The contract's row per document: the words that the mix takes of it, over all its slots."""
    known, content = mix(docs)
    parts = known.withColumn("words", F.lit(0).cast("long")).unionByName(
        content.select("row", "words", "doc_id"), allowMissingColumns=True)
    return parts.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("size").alias("size"), F.max("source_size").alias("source_size"),
        F.max("target").alias("target"), F.sum("words").alias("taken")).drop("row")
