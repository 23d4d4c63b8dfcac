"""Mix sources to target weights with a multivariate-hypergeometric splitting tree.

Every source gets a target in words.  Its documents are put in hashed order and cut into
blocks of equally many words; the target fixes how many blocks the source sends into the
mix (its quota), a source that is short going round its order again.  A binary tree splits
all quotas among the output shards: at each node the blocks that go left are drawn without
replacement from all blocks of the node, so every shard is a fair sample of the mix and the
quotas hold exactly.  Each shard then takes its own blocks of the permuted order and orders
its documents by hash.

Only DataFrame and SQL functions are used.  What runs in one task is the tree, whose size is
``shards * blocks_per_shard`` blocks plus one count per source, whatever the corpus holds.

Defined results: null text has no words; a null source is a source of its own; documents
without words are drawn like others but take no words; repeated rows count each; an empty
table gives an empty mix.  Extra columns are kept.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayframe.llm.rows import exact, free_name
from assayframe.session import materialise

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SHARDS = 64
BLOCKS_PER_SHARD = 64
ROWS_PER_BUCKET = 4096
SEED = 20240229
WORD = r"[^\x20\x09-\x0D]+"


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts alone."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") / float(1 << 52)


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS,
            most: int = MOST_REPEATS) -> DataFrame:
    """Per source: its words and rows, and the words the mix should take of it.

    Sources in code point order, null last, weigh ``weights`` in turn and share all words.
    No target exceeds ``most`` times its source; what is left over is shared by weight
    among the rest.  That is a water level: with sources ordered by cap over weight, a
    source is at its cap if its ratio is below the level that the sources before it leave.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    listed = F.array(*[F.lit(float(w)) for w in weights])
    per = (
        per.withColumn("source_no", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(listed, F.col("source_no") % len(weights) + 1))
        .withColumn("cap", F.col("source_size") * float(most))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    by_ratio = Window.orderBy("ratio", "source_no")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    none = F.lit(0.0)
    per = per.withColumn(
        "level",
        (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), none))
        / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), none)))
    free = F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "source_no", "level"))
    per = per.withColumn("final", F.min(free).over(whole)["level"])
    share = F.col("weight") * F.col("final")
    return per.select(
        "source", "source_no", "source_size", "rows",
        F.when(F.col("final").isNull() | (F.col("cap") <= share), F.col("cap")).otherwise(share)
        .alias("target"))


def ordered(rows: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """Rows with their source's figures, the words before them in hashed order, and copies.

    The running sum works in two steps, so that no source is summed in one task: hash
    buckets of bounded size are summed inside, and the sums of whole buckets are added.
    """
    named = rows.join(sources, rows["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    # rows without id, or with one id, are told apart by their text
    named = named.withColumn("u", _unit(F.lit(seed), F.col("doc_id"), F.col("mix_key_1"), F.col("mix_key_2"))).withColumn(
        "bucket", F.floor(F.col("u") * F.ceil(F.col("rows") / float(ROWS_PER_BUCKET))))
    sums = named.groupBy("source_no", "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source_no", "bucket",
                       F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("bucket_start"))
    inside = Window.partitionBy("source_no", "bucket").orderBy("u", "doc_id", "size", "row") \
        .rowsBetween(Window.unboundedPreceding, -1)
    placed = named.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0))) \
        .join(sums, ["source_no", "bucket"])
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - F.col("rounds") * F.col("source_size")
    return (
        placed.withColumn("start", F.col("bucket_start") + F.col("within"))
        .withColumn("rounds", rounds)
        .withColumn("copies", (F.col("rounds") + F.when(
            F.col("start") + F.col("size") / 2.0 < rest, 1).otherwise(0)).cast("int"))
        .drop("u", "bucket", "within", "bucket_start", "rows", "rounds")
    )


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """Blocks of each source for each shard: rows of (shard, source_no, blocks).

    ``quotas`` has (source_no, blocks).  A node holds the shards [lo, hi) and the blocks it
    has of each source.  Going through its blocks one by one, a block goes left with the
    chance (places left on the left side) / (blocks not yet seen): drawing without
    replacement, hence multivariate-hypergeometric counts that add up exactly.
    """
    def step() -> Column:
        def of_source(state: Column, item: Column) -> Column:
            def of_block(s: Column, i: Column) -> Column:
                goes = _unit(F.lit(seed), F.col("lo"), F.col("hi"), item["source_no"], i) \
                    * s["unseen"] < s["places"]
                taken = F.when(goes, F.lit(1)).otherwise(F.lit(0)).cast("long")
                return F.struct((s["places"] - taken).alias("places"),
                                (s["unseen"] - 1).alias("unseen"), (s["left"] + taken).alias("left"))

            start = F.struct(state["places"].alias("places"), state["unseen"].alias("unseen"),
                             F.lit(0).cast("long").alias("left"))
            steps = F.when(item["blocks"] > 0, F.sequence(F.lit(1).cast("long"), item["blocks"])) \
                .otherwise(F.array().cast("array<long>"))
            done = F.aggregate(steps, start, of_block)
            return F.struct(done["places"].alias("places"), done["unseen"].alias("unseen"),
                            F.concat(state["out"], F.array(done["left"])).alias("out"))

        begin = F.struct(F.col("places").alias("places"), F.col("unseen").alias("unseen"),
                         F.array().cast("array<long>").alias("out"))
        return F.aggregate(F.col("counts"), begin, of_source, lambda s: s["out"])

    nodes = quotas.agg(F.sort_array(F.collect_list(F.struct("source_no", "blocks"))).alias("counts")) \
        .select(F.lit(0).alias("lo"), F.lit(shards).alias("hi"), "counts")
    width = shards
    while width > 1:
        nodes = (
            nodes.withColumn("mid", F.floor((F.col("lo") + F.col("hi")) / 2).cast("int"))
            .withColumn("unseen", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x["blocks"]))
            .withColumn("places", F.floor(F.col("unseen") * (F.col("mid") - F.col("lo"))
                                          / (F.col("hi") - F.col("lo")).cast("double")).cast("long"))
            .withColumn("left", step())
        )
        left = F.zip_with("counts", "left", lambda c, n: F.struct(
            c["source_no"].alias("source_no"), n.alias("blocks")))
        right = F.zip_with("counts", "left", lambda c, n: F.struct(
            c["source_no"].alias("source_no"), (c["blocks"] - n).alias("blocks")))
        sides = F.array(
            F.struct(F.col("lo").alias("lo"), F.col("mid").alias("hi"), left.alias("counts")),
            F.struct(F.col("mid").alias("lo"), F.col("hi").alias("hi"), right.alias("counts")))
        nodes = nodes.select(F.explode(sides).alias("n")).select("n.*").where("lo < hi")
        width = (width + 1) // 2
    return nodes.select(F.col("lo").alias("shard"), F.inline("counts"))


def block_shards(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """The shard of every block: (source_no, block, shard).

    The blocks of a source are permuted by hash; the shards take consecutive runs of that
    order, as long as their counts, so no two shards share a block.
    """
    before = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    runs = split_quotas(quotas, shards, seed).withColumn(
        "first", F.coalesce(F.sum("blocks").over(before), F.lit(0))).where("blocks > 0")
    taken = runs.select("source_no", "shard", F.explode(
        F.sequence("first", F.col("first") + F.col("blocks") - 1)).alias("place"))
    permuted = Window.partitionBy("source_no").orderBy(
        F.xxhash64(F.lit(seed), "source_no", "block"), "block")
    blocks = quotas.where("blocks > 0").select(
        "source_no", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    blocks = blocks.withColumn("place", (F.row_number().over(permuted) - 1).cast("long"))
    return blocks.join(taken, ["source_no", "place"]).select("source_no", "block", "shard")


def draw(sized: DataFrame, shards: int = SHARDS, blocks_per_shard: int = BLOCKS_PER_SHARD,
         seed: int = SEED, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Each row once per copy that the mix takes, with its shard; rows not taken have none.

    ``sized`` has (row, doc_id, source, size), ``row`` being unique, and should be a stored
    table, since it is read several times.  Added: source_size, target, copy (0 and up),
    block, shard.
    """
    sources = materialise(targets(sized, weights, most), "mix-sources")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    block_words = max(1, -(-int(total) // (shards * blocks_per_shard)))
    quotas = sources.select("source_no", F.ceil(F.col("target") / block_words).cast("long").alias("blocks"))
    taken = ordered(sized, sources, seed).select(
        "*", F.explode_outer(F.when(F.col("copies") > 0, F.sequence(
            F.lit(0), F.col("copies") - 1))).alias("copy"))
    last = F.greatest(F.ceil(F.col("target") / block_words) - 1, F.lit(0))
    taken = taken.withColumn("block", F.when(F.col("copy").isNotNull(), F.least(last, F.floor(
        (F.col("copy") * F.col("source_size") + F.col("start")) / float(block_words)))).cast("long"))
    return taken.join(block_shards(quotas, shards, seed), ["source_no", "block"], "left") \
        .drop("source_no", "start", "copies")


def _row_key(docs: DataFrame) -> dict[str, Column]:
    parts = [F.col("doc_id"), F.col("source").isNull(), F.col("source"), F.col("text").isNull(), F.col("text")]
    return {"mix_key_1": F.xxhash64(*parts), "mix_key_2": F.xxhash64(F.lit("2"), *parts)}


def with_sizes(docs: DataFrame) -> DataFrame:
    """The narrow table that ``draw`` reads, stored: (row, doc_id, source, size, row keys)."""
    keyed = docs.withColumns({"size": words_in(F.col("text")), **_row_key(docs)})
    return materialise(keyed.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "source", "size",
        "mix_key_1", "mix_key_2"), "mix-sizes")


def mix(docs: DataFrame, shards: int = SHARDS, blocks_per_shard: int = BLOCKS_PER_SHARD,
        seed: int = SEED, shard: str | None = "mix_shard") -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as the mix takes it.

    ``docs`` needs doc_id, text and source.  Texts are shuffled once, by a 128-bit key of
    those three columns, to meet their draws.  Rows that agree in all three share their draws
    evenly: both sides are numbered, and a draw meets the row of its number modulo the rows.
    Rows stand in hashed order inside each task.  ``shard`` names a column for the output
    shard (with underscores behind it where ``docs`` has that name), or is None for none.
    The columns of ``docs`` travel in one struct, so no name of theirs meets one used here.
    """
    drawn = draw(with_sizes(docs), shards, blocks_per_shard, seed).where("copy IS NOT NULL")
    keys = list(_row_key(docs))
    numbered = Window.partitionBy(*keys)
    rows = docs.select(F.struct(*[exact(c) for c in docs.columns]).alias("whole"),
                       *[k.alias(n) for n, k in _row_key(docs).items()])
    counts = rows.groupBy(*keys).agg(F.count("*").alias("rows"))
    rows = rows.withColumn("place", F.row_number().over(numbered.orderBy(F.lit(1))) - 1)
    drawn = drawn.select(*keys, "shard").withColumn("draw", F.row_number().over(numbered.orderBy("shard")) - 1)
    drawn = drawn.join(counts, keys).select(*keys, "shard", (F.col("draw") % F.col("rows")).cast("int").alias("place"))
    met = rows.join(drawn, [*keys, "place"]).sortWithinPartitions(
        "shard", F.xxhash64(F.lit(seed), "shard", keys[0]))
    added = [] if shard is None else [F.col("shard").alias(free_name(shard, docs.columns))]
    return met.select("whole.*", *added)


def mix_report(docs: DataFrame, shards: int = SHARDS, blocks_per_shard: int = BLOCKS_PER_SHARD,
               seed: int = SEED) -> DataFrame:
    """One row per document: size, source_size, target, words taken, and the shards."""
    drawn = draw(with_sizes(docs), shards, blocks_per_shard, seed)
    return drawn.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("size").alias("size"),
        F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.coalesce(F.sum(F.when(F.col("copy").isNotNull(), F.col("size"))), F.lit(0)).alias("taken"),
        F.sort_array(F.collect_list("shard")).alias("shards"),
    ).drop("row")
