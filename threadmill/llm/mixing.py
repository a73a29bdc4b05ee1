"""Mixing sources to target weights by pivotal dependent rounding.

A source's documents all start with the same fractional number of copies, its
target over its size. The whole part is certain. For the rest, two documents
are paired: mass moves from one to the other, in a random direction, until one
of them has no fraction left; the words they are expected to give together stay
exactly the same, and so does each one's expectation. The other carries on to
the next pair. Blocks of about ``FAN_IN`` documents do this side by side and leave one
document each; these meet in the blocks of the next level, and so on, down to
one document of each source, which is rounded by itself. A source therefore
misses its target by one document at most.

Everything is DataFrame functions and every draw is a hash of the pair, so runs
agree. Defined cases: a null text has size 0 and is never taken; null sources
are one source, the last; repeated rows are separate documents; a source without
words has target 0; a very long text is a size like any other, and may be as far
as its source misses the target; columns of any name come back as they were; an
empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import boxed, unboxed, written

#: Documents of a block, about.
FAN_IN = 128
#: Blocks of a level that meet in one of the next, in each of a block's two numbers.
SPLIT = 32
EPSILON = 1e-9


def word_count(text: Column) -> Column:
    r"""Number of [^\x20\x09-\x0D]+ in a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), most: float = 3.0, share: float = 1.0) -> DataFrame:
    """source, n_docs, source_size, target, one row per source.

    Sources in code-point order, null last, take ``weights`` in turn. A target
    stops at ``most`` times its source's size and the excess goes to the others
    by weight: the level at which it settles is found with running sums over the
    sources in the order in which they fill up.
    """
    per = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(turn, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
    per = per.withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    per = per.withColumn("open", F.sum("weight").over(filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    per = per.withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
    # the first source that its level does not fill sets the level of all that are not full
    settled = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("full"))).over(everything)
    level = F.min(F.when((F.col("level") * F.col("weight") <= F.col("cap")) & (F.col("full") == settled), F.col("level"))).over(everything)
    per = per.withColumn("settled", settled).withColumn("water", level)
    target = F.when(F.col("water").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("water") * F.col("weight")))
    return per.select("source", "n_docs", "source_size", target.alias("target"))


def _uniform(*columns: Column | str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") * F.lit(2.0**-53)


def _let(value: Column, body) -> Column:
    """Bind ``value`` to a name inside one expression, so that it is evaluated once."""
    return F.transform(F.array(value), body)[0]


def _pair(seed: int):
    def merge(acc: Column, item: Column) -> Column:
        held = acc["held"]

        def step(v: Column) -> Column:
            up = F.least(1 - held["p"], v["reach"])
            down = F.least(held["p"], (1 - item["p"]) * v["ratio"])
            raised = v["u"] * (up + down) < down
            # a direction is drawn with the other's length, so both expectations stay
            p = F.when(raised, held["p"] + up).otherwise(held["p"] - down)
            q = F.when(raised, item["p"] - up / v["ratio"]).otherwise(item["p"] + down / v["ratio"])
            return F.struct(p.alias("p"), q.alias("q"))

        def settle(m: Column) -> Column:
            first = F.struct(held["doc"].alias("doc"), held["words"].alias("words"), m["p"].alias("p"))
            second = F.struct(item["doc"].alias("doc"), item["words"].alias("words"), m["q"].alias("p"))
            whole = (m["p"] < EPSILON) | (m["p"] > 1 - EPSILON)
            return F.struct(F.when(whole, second).otherwise(first).alias("held"), F.concat(acc["done"], F.array(F.when(whole, first).otherwise(second))).alias("done"))

        ratio = item["words"].cast("double") / held["words"].cast("double")
        start = F.struct(ratio.alias("ratio"), (item["p"] * ratio).alias("reach"), _uniform(F.lit(seed), held["doc"], item["doc"]).alias("u"))
        moved = _let(_let(start, step), settle)
        return F.when(held["doc"].isNull(), F.struct(item.alias("held"), acc["done"].alias("done"))).otherwise(moved)

    return merge


def _round_level(items: DataFrame, seed: int) -> DataFrame:
    """One level of the tree: source, held (one document of each block), done."""
    doc = "struct<a:bigint,b:bigint,n:bigint>"
    item = f"struct<doc:{doc},words:bigint,p:double>"
    zero = F.from_json(F.lit("{}"), f"held {item}, done array<{item}>")
    start = F.struct(zero["held"].alias("held"), F.array().cast(f"array<{item}>").alias("done"))
    blocks = items.groupBy("source", "block").agg(F.sort_array(F.collect_list(F.struct("doc", "words", "p"))).alias("all"))
    return blocks.select("source", "block", F.aggregate("all", start, _pair(seed)).alias("r")).select("source", "block", "r.held", "r.done")


def choose_copies(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), most: float = 3.0, share: float = 1.0, seed: int = 29, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, tag, nth (of equal doc_id, source and text hash), source, size, source_size, target, copies."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"))
    rows = written(narrow, "sizes")
    targets = written(source_targets(rows, weights, most, share), "targets")
    ratio = F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    # one row per source: small beside the documents, and Spark decides how to join it
    rows = rows.join(targets.withColumn("ratio", ratio).withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    whole = F.floor(F.col("ratio") + EPSILON).cast("long")
    rows = rows.withColumn("whole", whole).withColumn("p", F.greatest(F.col("ratio") - F.col("whole"), F.lit(0.0)))
    salted = rows.withColumn("part", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "tag"), F.greatest(F.ceil(F.col("n_docs") / FAN_IN), F.lit(1))))
    in_part = Window.partitionBy("source", "part").orderBy("doc_id", "tag")
    rows = written(salted.withColumn("n", F.row_number().over(in_part).cast("long")).drop("n_docs"), "parts")

    deepest = rows.agg(F.max("part"), F.max("n")).first()
    widest = max((deepest[0] or 0) + 1, math.ceil((deepest[1] or 1) / FAN_IN))
    fractional = rows.filter((F.col("size") > 0) & (F.col("p") > EPSILON) & (F.col("p") < 1 - EPSILON))
    block = F.struct("part", F.floor((F.col("n") - 1) / FAN_IN).alias("cut"))
    items = fractional.select("source", block.alias("block"), F.struct(F.col("doc_id").alias("a"), F.col("tag").alias("b"), F.col("n").alias("n")).alias("doc"), F.col("size").alias("words"), "p")
    done = None
    for level in range(1 + math.ceil(math.log(widest, SPLIT) - EPSILON)):
        result = written(_round_level(items, seed + level), "rounded")
        settled = result.select("source", F.explode("done").alias("one"))
        done = settled if done is None else done.unionByName(settled)
        held = result.filter("held.doc is not null").select("source", "block", "held")
        wider = F.struct(*[F.floor(F.col("block")[k] / SPLIT).alias(k) for k in ("part", "cut")])
        items = held.withColumn("block", wider).select("source", "block", "held.doc", "held.words", "held.p")
    last = items.withColumn("p", F.when(_uniform(F.lit(seed), "doc") < F.col("p"), 1.0).otherwise(0.0))
    final = done.select("source", "one.doc", "one.p").unionByName(last.select("source", "doc", "p"))
    extra = final.select(F.col("source").alias("__source"), F.col("doc.a").alias("__a"), F.col("doc.b").alias("__b"), F.col("doc.n").alias("__n"), F.round("p").cast("long").alias("extra"))
    same = F.col("doc_id").eqNullSafe(F.col("__a")) & (F.col("tag") == F.col("__b")) & (F.col("n") == F.col("__n")) & F.col("source").eqNullSafe(F.col("__source"))
    joined = rows.join(extra, same, "left")
    copies = F.when(F.col("size") == 0, 0).otherwise(F.coalesce(F.col("extra"), F.when(F.col("p") > 0.5, 1).otherwise(0)) + F.col("whole"))
    nth = F.row_number().over(Window.partitionBy("doc_id", "tag", "source").orderBy("n"))
    return joined.select("doc_id", "tag", nth.alias("nth"), "source", "size", "source_size", "target", copies.cast("long").alias("copies"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it; columns as they were."""
    chosen = written(choose_copies(docs, text=text, source=source, doc_id=doc_id, **options), "copies")
    repeated = (chosen.agg(F.max("nth")).first()[0] or 1) > 1
    chosen = chosen.filter("copies > 0").select("doc_id", "tag", "nth", F.col("source").alias("origin"), "copies")
    rows = boxed(docs, id=F.col(doc_id).cast("long"), mark=F.xxhash64(text), source=F.col(source).cast("string"))
    # rows that are told apart by nothing else are numbered; without any, texts are not shuffled for it
    rows = rows.withColumn("number", F.row_number().over(Window.partitionBy("id", "mark", "source").orderBy("id")) if repeated else F.lit(1))
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("mark") == F.col("tag")) & (F.col("number") == F.col("nth")) & F.col("source").eqNullSafe(F.col("origin"))
    return unboxed(rows.join(chosen, same).select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))))
