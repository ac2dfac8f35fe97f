"""Mixing sources to target weights with a low-discrepancy schedule.

Golden-ratio points, one per slot, are mapped through the cumulative shares of
the sources, so every stretch of the schedule holds the sources in their
proportions. Slots are ranked per source; the r-th slot of a source takes the
r-th block (in turn) of its documents, which are shuffled by a hash and cut
into blocks of equal numbers of words.

Everything is integer arithmetic on DataFrame functions and a hash of the id,
so reruns agree. Ranks and running sums go in two steps (per chunk or hash
bucket, then over the chunks of a source), so a source with most of the rows
is spread over many tasks.

Null texts and texts without words have size 0 and take nothing. A null source
is a source of its own, after all others. Repeated rows are documents of their
own; documents that share an id follow each other by size. A very long text is one document of
many words, of which only the count is used. An empty table gives an empty result; if
no document has words, all targets are 0. Only id, text and source are read, whatever other columns
are called.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..durable import durable
from ..skew import join_dimension
from . import native

WEIGHTS = (5, 2, 1)
MOST = 3  # times a source, and a document, may be taken
BLOCK_WORDS = 4096  # words of a block at most
LEAST_SLOTS = 65536  # of the whole mix
SOURCE_SLOTS = 256  # about this many slots at least for every source
_GOLDEN = 2654435769  # 2**32 divided by the golden ratio
_RING = 1 << 32
_FINE = 1024  # parts of a slot in which wishes are summed, so that sums are exact
_CELL = 1 << 20  # width of the cells in which points meet the shares
_CHUNK = 4096  # consecutive slots ranked together


def source_targets(sizes, weights=WEIGHTS, most=MOST):
    """A row per source (``__s``): its size, weight and target.

    Targets share out all words by weight; those above ``most`` times their
    source's size stop there and the excess goes to the rest by weight, until
    none is above. The windows run over one row per source.
    """
    listed = sizes.groupBy("__s").agg(F.sum("size").alias("source_size"))
    place = (F.row_number().over(Window.orderBy("__s")) - 1) % len(weights)
    weight = F.get(F.array(*[F.lit(w) for w in weights]), place).cast("long")
    listed = listed.withColumn("weight", weight)
    everything = Window.partitionBy()
    tightest = Window.orderBy(F.col("source_size") / F.col("weight"), "__s").rowsBetween(Window.unboundedPreceding, -1)
    # Sources run full in order of size per weight; all before the first that does not are full.
    rate = (F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(tightest), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(tightest), F.lit(0))
    )
    order = F.row_number().over(Window.orderBy(F.col("source_size") / F.col("weight"), "__s"))
    listed = listed.withColumn("__rate", rate).withColumn("__order", order)
    full = F.col("__rate") * F.col("weight") >= most * F.col("source_size")
    # The rate of the first source that does not run full holds for it and all after it.
    level = F.min(F.when(~full, F.struct("__order", "__rate"))).over(everything)["__rate"]
    listed = listed.withColumn("__level", level)
    ceiling = (most * F.col("source_size")).cast("double")
    return listed.withColumn("target", F.least(ceiling, F.col("__level") * F.col("weight"))).drop("__rate", "__level", "__order")


def plan_blocks(targets, block_words=BLOCK_WORDS, least_slots=LEAST_SLOTS, source_slots=SOURCE_SLOTS):
    """Targets with words per block, blocks, slots, and the source's range [lo, hi) on the ring."""
    everything = Window.partitionBy()
    common = F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(F.sum("source_size").over(everything) / least_slots)))
    own = F.greatest(F.lit(1), F.least(common, F.floor(F.col("target") / source_slots)))
    planned = targets.withColumn("block", own.cast("long"))
    planned = planned.withColumn("blocks", F.ceil(F.col("source_size") / F.col("block")).cast("long"))
    planned = planned.withColumn("__want", F.round(F.col("target") / F.col("block") * _FINE).cast("long"))
    upto = Window.orderBy("__s").rowsBetween(Window.unboundedPreceding, 0)
    planned = planned.withColumn("__upto", F.sum("__want").over(upto)).withColumn("__all", F.sum("__want").over(everything))
    hi = F.when(F.col("__all") > 0, F.floor(F.col("__upto") / F.col("__all") * _RING)).otherwise(F.lit(0)).cast("long")
    planned = planned.withColumn("hi", hi).withColumn("slots", F.round(F.col("__all") / _FINE).cast("long"))
    lo = F.coalesce(F.lag("hi").over(Window.orderBy("__s")), F.lit(0))
    return planned.withColumn("lo", lo).drop("__want", "__upto", "__all")


def schedule(planned, slots):
    """(slot, __s, rank, block_no): which source each slot draws on, and its block."""
    spark = planned.sparkSession
    cells = planned.where("hi > lo").select(
        "__s", "lo", "hi", "blocks", F.explode(F.sequence(F.floor(F.col("lo") / _CELL), F.floor((F.col("hi") - 1) / _CELL))).alias("cell")
    )
    point = F.pmod(F.pmod(F.col("slot"), F.lit(1 << 31)) * F.lit(_GOLDEN), F.lit(_RING))
    points = spark.range(slots).withColumnRenamed("id", "slot").withColumn("point", point)
    points = points.withColumn("cell", F.floor(F.col("point") / _CELL)).withColumn("chunk", F.floor(F.col("slot") / _CHUNK))
    drawn = points.join(cells, "cell").where("point >= lo AND point < hi").select("slot", "chunk", "__s", "blocks")
    ahead = drawn.groupBy("__s", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("__s").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    ahead = ahead.select("__s", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    within = F.row_number().over(Window.partitionBy("__s", "chunk").orderBy("slot")) - 1
    ranked = drawn.withColumn("within", within).join(ahead, ["__s", "chunk"])
    ranked = ranked.withColumn("rank", F.col("within") + F.col("ahead"))
    # A source's blocks come round at most MOST times; targets end there too, but for rounding.
    return ranked.where(F.col("rank") < MOST * F.col("blocks")).select(
        "slot", "__s", "rank", (F.col("rank") % F.col("blocks")).alias("block_no")
    )


def shuffled_words(docs, seed="mix"):
    """``docs`` with ``first``, the place of its first word among its source's shuffled words."""
    order = F.md5(F.concat_ws(":", F.coalesce(F.col("__id"), F.lit("null")), F.lit(seed)))
    docs = docs.withColumn("__order", order).withColumn("__bucket", F.substring("__order", 1, 3))
    inside = Window.partitionBy("__s", "__bucket").orderBy("__order", "size").rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.withColumn("__inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    before = Window.partitionBy("__s").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = docs.groupBy("__s", "__bucket").agg(F.sum("size").alias("n"))
    ahead = ahead.select("__s", "__bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__ahead"))
    return docs.join(ahead, ["__s", "__bucket"]).withColumn("first", F.col("__ahead") + F.col("__inside")).drop(
        "__order", "__bucket", "__inside", "__ahead"
    )


def mix(df, text_col="text", id_col="doc_id", source_col="source", weights=WEIGHTS):
    """(id, source, size, source_size, target, taken) for every row of ``df``."""
    key = F.coalesce(F.concat(F.lit("a"), F.col(source_col)), F.lit("b"))
    sizes = durable(df.select(
        F.col(id_col), F.col(source_col), F.col(id_col).cast("string").alias("__id"), key.alias("__s"),
        native.word_count(F.col(text_col)).alias("size"),
    ))
    planned = durable(plan_blocks(source_targets(sizes, weights)))
    top = planned.agg(F.max("slots")).first()[0] or 0
    taken = schedule(planned, top).groupBy("__s", "block_no").agg(F.count("*").alias("times"))
    facts = planned.select("__s", "source_size", "target", "block")
    docs = durable(join_dimension(shuffled_words(sizes), facts, ["__s"]))
    pieces = docs.where("size > 0").select(
        "__s", "first", "size", "block",
        F.explode(F.sequence(F.floor(F.col("first") / F.col("block")), F.floor((F.col("first") + F.col("size") - 1) / F.col("block")))).alias("block_no"),
    )
    overlap = F.least(F.col("first") + F.col("size"), (F.col("block_no") + 1) * F.col("block")) - F.greatest(
        F.col("first"), F.col("block_no") * F.col("block")
    )
    words = (
        pieces.withColumn("words", overlap).join(taken, ["__s", "block_no"])
        .groupBy("__s", "first").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    )
    words = words.withColumn("__some", F.lit(True))
    return (
        docs.withColumn("__some", F.col("size") > 0).join(words, ["__s", "first", "__some"], "left")
        .select(id_col, source_col, "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )


def op_mix(documents):
    return mix(documents).select("doc_id", "size", "source_size", "target", "taken", "source")


SQL = f"""
WITH sizes AS (
  SELECT doc_id, source, coalesce('a' || source, 'b') AS s,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents),
listed AS (
  SELECT s, sum(size)::BIGINT AS source_size,
         [{', '.join(map(str, WEIGHTS))}][((row_number() OVER (ORDER BY s) - 1) % {len(WEIGHTS)} + 1)::INT]::BIGINT AS weight
  FROM sizes GROUP BY s),
rated AS (
  SELECT *, ((sum(source_size) OVER () - {MOST} * coalesce(sum(source_size) OVER w, 0))::DOUBLE
             / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::DOUBLE) AS rate,
         row_number() OVER (ORDER BY source_size::DOUBLE / weight, s) AS o
  FROM listed
  WINDOW w AS (ORDER BY source_size::DOUBLE / weight, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levelled AS (
  SELECT *, (SELECT arg_min(rate, o) FROM rated WHERE rate * weight < {MOST} * source_size) AS lvl FROM rated),
targets AS (
  SELECT s, source_size, least(({MOST} * source_size)::DOUBLE, lvl * weight) AS target FROM levelled),
common AS (
  SELECT *, greatest(1, least({BLOCK_WORDS}, floor((sum(source_size) OVER ())::DOUBLE / {LEAST_SLOTS}))) AS c FROM targets),
blocked AS (
  SELECT s, source_size, target, greatest(1, least(c, floor(target / {SOURCE_SLOTS})))::BIGINT AS block FROM common),
wanted AS (
  SELECT *, ceil(source_size::DOUBLE / block)::BIGINT AS blocks,
         sum(want) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::DOUBLE AS upto,
         (sum(want) OVER ())::DOUBLE AS al
  FROM (SELECT *, round(target / block * {_FINE})::BIGINT AS want FROM blocked)),
ringed AS (
  SELECT *, CASE WHEN al > 0 THEN floor(upto / al * {_RING}) ELSE 0 END::BIGINT AS hi, round(al / {_FINE})::BIGINT AS slots FROM wanted),
planned AS (
  SELECT *, coalesce(lag(hi) OVER (ORDER BY s), 0) AS lo FROM ringed),
points AS (
  SELECT i AS slot, (i * {_GOLDEN}) % {_RING} AS point
  FROM range((SELECT max(slots) FROM planned)) t(i)),
ranked AS (
  SELECT s, blocks, row_number() OVER (PARTITION BY s ORDER BY slot) - 1 AS r
  FROM points JOIN planned ON point >= lo AND point < hi),
taken AS (
  SELECT s, r % blocks AS block_no, count(*) AS times FROM ranked WHERE r < {MOST} * blocks GROUP BY ALL),
placed AS (
  SELECT doc_id, source, sizes.s, size, source_size, target, block,
         coalesce(sum(size) OVER (PARTITION BY sizes.s ORDER BY md5(coalesce(doc_id::VARCHAR, 'null') || ':mix'), size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS fst
  FROM sizes JOIN planned USING (s)),
pieces AS (
  SELECT *, unnest(range(fst // block, (fst + size - 1) // block + 1)) AS block_no FROM placed WHERE size > 0),
words AS (
  SELECT s, fst, sum((least(fst + size, (block_no + 1) * block) - greatest(fst, block_no * block)) * times)::BIGINT AS taken
  FROM pieces JOIN taken USING (s, block_no) GROUP BY ALL)
SELECT doc_id, size, source_size, target, coalesce(CASE WHEN size > 0 THEN words.taken END, 0)::BIGINT AS taken, source
FROM placed LEFT JOIN words ON placed.s = words.s AND placed.fst = words.fst
"""
