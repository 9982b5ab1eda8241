"""Operator 3: mixing sources to target weights by Sainte-Lague apportionment.

Targets: sources in code-point order (null last) weigh 3, 1, 2, repeating; they
share ``share`` times all words, no target above ``cap`` times its source. The
excess is shared again by weight until none is above.

Blocks: each source is dealt into shards of about ``shard_words`` words by a
seeded hash, a shard's documents are strung together in seeded order and cut
into blocks of ``block_words`` words, the last one shorter. The house has as many
blocks as all targets together. It is allocated to the (source, shard) rows by
highest quotients ``target / (2k + 1)``: the divisor at which every row gets its
target over it, rounded, is found by bisection, 64 divisors a job; rows that tie for
the last blocks get them in the order of source and shard. A shard first takes whole
rounds of all its blocks, then the rest of its quota by smallest seeded block hash.
Where a quota is under ``SMALL`` blocks half a block matters, so there the last block
is settled in words: the drawn blocks go as far as the shard's target. A document's
``taken`` is the sum of its words in taken blocks, so never above ``cap`` times its size.

Only ids, sizes and hashes are shuffled, never texts. The hot source is many
shards. The one unpartitioned window runs over one row per source.

Defined results: a null text has size 0; a size of 0 is taken 0 times; equal
rows are dealt in any order with the same result; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripforge.llm.common import stored

WEIGHTS = (3, 1, 2)
#: Below so many blocks a shard's target is met to the word; divisors counted in one job.
SMALL, DIVISORS = 1024, 64


def word_count(text: Column) -> Column:
    """Number of runs of bytes outside space and \\x09-\\x0D."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, share: float = 1.5, cap: float = 2.0, weights=WEIGHTS) -> DataFrame:
    """``sources`` (source, source_size) with each source's target.

    Water filling: a source is full when ``level * weight`` reaches its cap. Each
    round is one aggregate over one row per source; full sources only grow.
    """
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    s = stored(sources.withColumn("sid", number)
               .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") - 1) % len(weights) + 1).cast("double"))
               .withColumn("most", cap * F.col("source_size")), "mix-sources")
    total = s.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        is_full = F.col("most") <= F.lit(level) * F.col("weight")
        row = s.agg(F.count_if(is_full), F.sum(F.when(is_full, F.col("most"))), F.sum(F.when(~is_full, F.col("weight")))).first()
        if row[0] == full or not row[2]:
            break
        full = row[0]
        level = (share * total - (row[1] or 0.0)) / row[2]
    return s.select("sid", "source", "source_size", "weight", F.least(F.col("most"), F.lit(level) * F.col("weight")).alias("target"))


#: Equal rows that are numbered in one group.
EQUAL_ROWS = 100_000


def quotas(shards: DataFrame, block_words: int, cap: float = 2.0) -> DataFrame:
    """``shards`` (sid, shard, target, blocks), a stored table, with the ``quota`` of each:
    the Sainte-Lague allocation of ``floor(sum(target) / block_words)`` blocks, none
    above ``cap`` times its blocks."""
    most = F.floor(F.lit(cap) * F.col("blocks"))

    def seats(divisor):
        return F.least(F.floor(F.col("target") / F.lit(float(divisor)) + 0.5), most).cast("long")

    rows, total, highest = shards.agg(F.count("*"), F.sum("target"), F.max("target")).first()
    house = int(round(total or 0.0, 3) // block_words)  # rounded, as sums in another order differ in the last digits
    if not rows or not house:
        return shards.withColumn("quota", F.lit(0).cast("long"))
    # at the upper end no row has a seat; at the lower one there are enough, or all that the caps allow
    low, high = total / (house + rows + 1.0) / 2, 2.0 * highest + 1.0
    met = low
    while high - low > 1e-13 * high:
        tried = [low + (high - low) * i / (DIVISORS + 1) for i in range(1, DIVISORS + 1)]
        got = list(shards.agg(*[F.sum(seats(x)).alias(f"n{i}") for i, x in enumerate(tried)]).first())
        enough = [x for x, n in zip(tried, got) if n >= house]
        few = [x for x, n in zip(tried, got) if n < house]
        low, high = max([low, *enough]), min([high, *few])
        met = next((x for x, n in zip(tried, got) if n == house), None)
        if met:
            return shards.withColumn("quota", seats(met))
    # several quotients are equal at the cut: those below it have theirs, the first of the tied rows one more
    sure = shards.withColumn("quota", seats(high))
    left = house - sure.agg(F.sum("quota")).first()[0]
    tied = sure.filter(seats(low) > F.col("quota")).orderBy("sid", "shard").limit(left).select("sid", "shard", F.lit(1).cast("long").alias("more"))
    return sure.join(tied, ["sid", "shard"], "left").withColumn("quota", F.col("quota") + F.coalesce("more", F.lit(0))).drop("more")


def mix(docs: DataFrame, share: float = 1.5, cap: float = 2.0, weights=WEIGHTS, seed: int = 7,
        block_words: int = 64, shard_words: int = 1_000_000) -> DataFrame:
    """``doc_id, source, size, h, source_size, target, taken`` for every row of
    ``docs``; ``h`` is the seeded hash of id and text."""
    sized = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                               F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.col("text")).alias("h")), "mix-sized")
    t = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), share, cap, weights), "mix-targets")
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words))
    named = t.withColumnRenamed("source", "name")
    line = Window.partitionBy("sid", "shard").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    d = (sized.join(named, F.col("source").eqNullSafe(F.col("name"))).drop("name")
         .withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "h"), shards))
         .withColumn("stop", F.sum("size").over(line)).withColumn("start", F.col("stop") - F.col("size")))
    d = stored(d, "mix-lines")

    cells = (d.filter("size > 0").groupBy("sid", "shard")
             .agg(F.sum("size").alias("words"), F.first("target").alias("source_target"), F.first("source_size").alias("source_size"))
             .select("sid", "shard", "words", (F.col("source_target") * F.col("words") / F.col("source_size")).alias("target"),
                     F.ceil(F.col("words") / F.lit(block_words)).alias("blocks")))
    cells = quotas(stored(cells, "mix-shards"), block_words, cap)
    # whole rounds of a shard, then so many blocks, or so many words where the quota is small
    cells = cells.withColumn("small", F.col("quota") < SMALL).withColumn("unit", F.when(F.col("small"), F.col("words")).otherwise(F.col("blocks")))
    goal = F.when(F.col("small"), F.least(F.round("target"), F.floor(F.lit(cap) * F.col("words")))).otherwise(F.col("quota")).cast("long")
    cells = stored(cells.withColumn("goal", goal).selectExpr("sid", "shard", "words", "blocks", "small", "goal div unit AS rounds", "goal % unit AS extra"), "mix-quotas")
    draw = Window.partitionBy("sid", "shard").orderBy("draw", "block")
    held = F.least(F.lit(block_words), F.col("words") - F.col("block") * block_words)
    picked = (cells.filter("extra > 0")
              .select("sid", "shard", "small", "extra", "words", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
              .withColumn("draw", F.xxhash64(F.lit(seed), "sid", "shard", "block")).withColumn("held", held)
              .withColumn("place", F.row_number().over(draw)).withColumn("upto", F.sum("held").over(draw.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("used", F.when(F.col("small"), F.least("held", F.col("extra") - F.col("upto") + F.col("held")))
                          .otherwise(F.when(F.col("place") <= F.col("extra"), F.col("held"))))
              .filter("used > 0").select("sid", "shard", "block", "used"))
    parts = (d.filter("size > 0").select("sid", "shard", "start", "stop", F.explode(
        F.expr(f"sequence(start div {block_words}, (stop - 1) div {block_words})")).alias("block")))
    drawn = (parts.join(picked.hint("merge"), ["sid", "shard", "block"])
             .withColumn("drawn", F.expr(f"least(stop, block * {block_words} + used) - greatest(start, block * {block_words})"))
             .filter("drawn > 0").groupBy("sid", "shard", "start", "stop").agg(F.sum("drawn").alias("drawn")))
    out = (d.join(cells.select("sid", "shard", "rounds"), ["sid", "shard"], "left")
           .join(drawn.hint("merge"), ["sid", "shard", "start", "stop"], "left"))
    taken = F.when(F.col("size") > 0, F.col("rounds") * F.col("size") + F.coalesce("drawn", F.lit(0))).otherwise(0)
    return out.select("doc_id", "source", "size", "h", "source_size", "target", taken.cast("long").alias("taken"))


def repeat_documents(docs: DataFrame, seed: int = 7, **options) -> DataFrame:
    """``docs`` as the mix takes them, in whole documents: a document comes
    ``taken / size`` times, the fraction rounded up for that share of documents
    by a seeded hash. Rows keep all columns, of whatever names; texts without words
    stay once. Rows of equal id and text share their copies: each gets as many whole
    ones, the first ones one more until none is left."""
    m = mix(docs, seed=seed, **options)
    u = (F.pmod(F.xxhash64(F.lit("copies"), "h"), F.lit(1 << 30)) + 0.5) / float(1 << 30)
    copies = F.when(F.col("size") == 0, 1).otherwise(F.floor(F.col("taken") / F.col("size") + u))
    m = stored(m.withColumn("copies", copies).groupBy(F.col("doc_id").alias("its_id"), F.col("h").alias("its_h"))
               .agg(F.sum("copies").alias("copies"), F.count("*").alias("rows")), "mix-copies")
    row = F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, F.col("doc_id").alias("id"), F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.col("text")).alias("h"))
    same = F.col("id").eqNullSafe(F.col("its_id")) & (F.col("h") == F.col("its_h"))

    def repeated(d, n):
        return d.select("row", F.explode(F.array_repeat(F.lit(1), n.cast("int"))).alias("one")).select("row.*")

    once = repeated(keyed.join(m.filter("rows = 1"), same), F.col("copies"))
    # equal rows are numbered, in parts of bounded size
    more = m.filter("rows > 1")
    ids = more.select(F.col("its_id").alias("one_id")).distinct()
    equal = keyed.join(ids, F.col("id").eqNullSafe(F.col("one_id")), "left_semi").join(more, same)
    equal = stored(equal.withColumn("place", F.monotonically_increasing_id())
                   .withColumn("part", F.pmod("place", F.ceil(F.col("rows") / EQUAL_ROWS))), "mix-equal")
    key = ["its_id", "its_h"]
    before = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (equal.groupBy(*key, "part").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
             .select(F.col("its_id").alias("p_id"), F.col("its_h").alias("p_h"), F.col("part").alias("p"), "before"))
    line = Window.partitionBy(*key, "part").orderBy("place")
    numbered = equal.withColumn("number", F.row_number().over(line)).join(
        parts, F.col("its_id").eqNullSafe(F.col("p_id")) & (F.col("its_h") == F.col("p_h")) & (F.col("part") == F.col("p")))
    n = F.expr("copies div rows + CASE WHEN before + number <= copies % rows THEN 1 ELSE 0 END")
    return once.unionByName(repeated(numbered, n))
