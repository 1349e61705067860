"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words. A document of a source is wanted
``target / source_size`` times; the whole part is taken as it is and the
fractional part is rounded *dependently*: two fractional documents of a source
are paired and mass (words) moves at random from one to the other until one of
them is taken or left, so the sum of expected words never changes and every
document keeps its own probability. What stays fractional in a block of
documents goes on to the next level of a reduction tree; one document a source
is left at the root, so a source's words miss the target by less than the size
of one document.

Everything is DataFrame code: a block's documents are folded with the SQL
``aggregate`` function. Blocks are dealt by a hash of the document, so a source
that holds a third of all rows is spread over as many blocks as it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, doc_key, read_documents, saved

WEIGHTS = (1, 2, 3)   # repeating, over the sources in code point order, null last
MOST_COPIES = 3       # a target stops at so many times the source's size
BLOCK = 128           # mean documents in a block of the reduction tree


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   most: int = MOST_COPIES) -> DataFrame:
    """(source, size) rows -> source, source_size, n_docs, target.

    Targets share the total by weight; a target above ``most`` times its
    source's size stops there and the excess is shared again by weight among
    the others. In the order of ``most * size / weight`` the stopped sources
    come first, so one pass of running sums finds the level at which the
    resharing ends. There is one row a source; only those meet in one task.
    """
    every = Window.orderBy(F.col("source").isNull(), F.col("source"))
    src = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                       F.count(F.when(F.col("size") > 0, 1)).alias("n_docs"))
           .withColumn("rank", F.row_number().over(every) - 1))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.col("rank") % len(weights) + 1).cast("int"))
    src = src.withColumn("weight", weight.cast("double")).withColumn("cap", F.col("source_size") * most)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    whole = Window.partitionBy()
    src = (src
           .withColumn("left", F.sum("source_size").over(whole) - F.coalesce(
               F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
           .withColumn("level", F.col("left") / F.sum("weight").over(
               by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
           .withColumn("stopped", F.col("cap") < F.col("level") * F.col("weight"))
           .withColumn("end", F.max(F.when(~F.col("stopped"), F.col("level"))).over(whole)))
    target = F.when(F.col("stopped") | F.col("end").isNull(), F.col("cap").cast("double")).otherwise(
        F.least(F.col("cap").cast("double"), F.col("end") * F.col("weight")))
    return src.select("source", "source_size", "n_docs", target.alias("target"))


def _uniform(*cols) -> Column:
    """A number in [0, 1) that depends on the columns only, so reruns agree."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 53)).cast("double") / float(1 << 53)


def _fold(items: Column, seed: int, level: int) -> Column:
    """Fold a block's items (key, size, mass, p): ``done`` has those decided,
    ``last`` the one that still may be fractional."""
    done = F.expr("cast(array() as array<struct<key:bigint,size:bigint,up:boolean>>)")

    def settled(x: Column, up: Column) -> Column:
        return F.struct(x["key"].alias("key"), x["size"].alias("size"), up.alias("up"))

    def held(x: Column, p: Column) -> Column:
        return F.struct(x["key"].alias("key"), x["size"].alias("size"), x["mass"].alias("mass"), p.alias("p"))

    def step(state: Column, b: Column) -> Column:
        a = state["last"]
        # Words that can move from b to a, and from a to b.
        a_room, b_has = a["mass"] * (1.0 - a["p"]), b["mass"] * b["p"]
        a_has, b_room = a["mass"] * a["p"], b["mass"] * (1.0 - b["p"])
        to_a, to_b = F.least(a_room, b_has), F.least(a_has, b_room)
        u = _uniform(a["key"], a["size"], b["key"], b["size"], F.lit(seed), F.lit(level))
        moves_to_a = u * (to_a + to_b) < to_b
        both = to_a + to_b <= 0.0
        yes, no = F.lit(True), F.lit(False)

        def after(out: Column, last: Column) -> Column:
            return F.struct(last.alias("last"), F.concat(state["done"], F.array(out)).alias("done"))

        def clip(p: Column) -> Column:
            return F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))

        return (F.when(both | moves_to_a,
                       F.when(a_room <= b_has, after(settled(a, yes), held(b, clip(b["p"] - a_room / b["mass"]))))
                       .otherwise(after(settled(b, no), held(a, clip(a["p"] + b_has / a["mass"])))))
                .otherwise(
                       F.when(a_has <= b_room, after(settled(a, no), held(b, clip(b["p"] + a_has / b["mass"]))))
                       .otherwise(after(settled(b, yes), held(a, clip(a["p"] - b_room / a["mass"]))))))

    first = F.struct(F.element_at(items, 1).alias("last"), done.alias("done"))
    return F.aggregate(F.slice(items, F.lit(2), F.greatest(F.size(items) - 1, F.lit(0))), first, step)


def _fold_blocks(items: DataFrame, seed: int, level: int) -> DataFrame:
    """(source, blocks, block, key, size, mass, p) rows folded block by block,
    large documents first, so that what stays fractional is small."""
    item = F.struct((-F.col("mass")).alias("o"), F.xxhash64("key", "size", F.lit(seed)).alias("h"),
                    "key", "size", "mass", "p")
    plain = F.transform("items", lambda x: F.struct(
        x["key"].alias("key"), x["size"].alias("size"), x["mass"].alias("mass"), x["p"].alias("p")))
    folded = (items.groupBy("source", "blocks", "block").agg(F.sort_array(F.collect_list(item)).alias("items"))
              .withColumn("items", plain).select("source", "blocks", _fold(F.col("items"), seed, level).alias("f")))
    return saved(folded, f"mix-level{level}")


def pivotal_round(items: DataFrame, counts: DataFrame, seed: int = 1, block: int = BLOCK) -> DataFrame:
    """Round the probability ``p`` of each item (source, key, size, mass, p).

    ``counts`` has (source, n_docs). Returns (source, key, size, up). Each level
    of the tree is written to the shared folder and the next level starts from
    its residuals; the number of levels is the logarithm of the largest
    source's count, the only number that reaches the driver. About ``block``
    documents of each source wait for the root, where they follow the last
    residual in falling size: the document left at the end is then a small one.
    """
    most = counts.agg(F.max("n_docs")).first()[0] or 0
    same = F.col("i.source").eqNullSafe(F.col("n.source"))
    dealt = (items.alias("i").join(counts.select("source", "n_docs").alias("n"), same)
             .select("i.*", F.greatest(F.col("n.n_docs"), F.lit(1)).alias("n_docs"))
             .withColumn("waits", F.pmod(F.xxhash64("key", "size", F.lit(seed), F.lit(-2)), F.col("n_docs")) < block))
    results: list[DataFrame] = []
    now = dealt.filter(~F.col("waits")).withColumn("blocks", F.ceil(F.col("n_docs") / block)).drop("n_docs", "waits")
    level, left = 0, most
    while left > block:
        mixed = F.xxhash64("key", "size", F.lit(seed), F.lit(level))
        folded = _fold_blocks(now.withColumn("block", F.pmod(mixed, F.col("blocks"))), seed, level)
        results.append(folded.select("source", F.explode("f.done").alias("d")).select("source", "d.*"))
        now = folded.select("source", "f.last.*", F.ceil(F.col("blocks") / block).alias("blocks"))
        level, left = level + 1, -(-left // block)
    last = [c for c in now.columns if c != "blocks"]
    root = (now.select(*last).unionByName(dealt.filter("waits").select(*last))
            .withColumn("blocks", F.lit(1)).withColumn("block", F.lit(0)))
    folded = _fold_blocks(root, seed, level)
    results.append(folded.select("source", F.explode("f.done").alias("d")).select("source", "d.*"))
    chance = _uniform("key", "size", F.lit(seed), F.lit(-1)) < F.col("p")
    results.append(folded.select("source", "f.last.*").select("source", "key", "size", chance.alias("up")))
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES,
        seed: int = 1, block: int = BLOCK) -> DataFrame:
    """One row a document: doc_id, size, source_size, target, copies, taken.

    A null text has size 0; a document of size 0 is never taken. A null
    source is a source of its own, after all others. A null doc_id counts as
    the smallest id. Rows that agree in doc_id, source and size are rounded as
    one unit and all get the same number of copies. An empty table gives no rows. Other
    columns are not read.
    """
    sizes = saved(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), doc_key().alias("key"),
                              F.col("source").cast("string").alias("source"), word_count().alias("size")), "mix-sizes")
    targets = saved(source_targets(sizes, weights, most), "mix-targets")
    rate = F.when(F.col("t.source_size") > 0, F.least(F.lit(float(most)), F.col("t.target") / F.col("t.source_size"))
                  ).otherwise(F.lit(0.0))
    same = F.col("s.source").eqNullSafe(F.col("t.source"))
    rows = sizes.alias("s").join(targets.alias("t"), same).select(
        "s.*", "t.source_size", "t.target", F.floor(rate).alias("whole"), (rate - F.floor(rate)).alias("p"))
    items = (rows.filter((F.col("size") > 0) & (F.col("p") > 0)).groupBy("source", "key", "size")
             .agg((F.col("size") * F.count("*")).cast("double").alias("mass"), F.first("p").alias("p")))
    rounded = pivotal_round(items, targets, seed, block)
    on = (F.col("r.source").eqNullSafe(F.col("d.source")) & (F.col("r.key") == F.col("d.key"))
          & (F.col("r.size") == F.col("d.size")))
    copies = F.when(F.col("r.size") > 0, F.col("r.whole") + F.coalesce(F.col("d.up").cast("int"), F.lit(0))
                    ).otherwise(F.lit(0)).cast("bigint")
    return (rows.alias("r").join(rounded.alias("d"), on, "left")
            .select("r.doc_id", "r.source", "r.size", "r.source_size", "r.target", copies.alias("copies"))
            .withColumn("taken", F.col("copies") * F.col("size")))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, columns of ``docs``."""
    plan = mix(docs, **options).groupBy(doc_key().alias("k"), F.col("source").alias("s"), F.col("size").alias("n")
                                        ).agg(F.first("copies").alias("c")).filter("c > 0")
    rows = docs.select(F.struct("*").alias("row"), doc_key().alias("k"),
                       F.col("source").cast("string").alias("s"), word_count().alias("n"))
    on = (F.col("r.k") == F.col("p.k")) & F.col("r.s").eqNullSafe(F.col("p.s")) & (F.col("r.n") == F.col("p.n"))
    return (rows.alias("r").join(plan.alias("p"), on)
            .select("r.row", F.explode(F.sequence(F.lit(1), F.col("p.c").cast("int")))).select("row.*"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken."""
    return mix(read_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source")
