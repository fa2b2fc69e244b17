"""Mixing sources to target weights (operator 1).

Method: multivariate-hypergeometric splitting tree.  Every source is cut into
``blocks`` hash blocks (its documents in a seeded random order); the words a
source owes to the mixture fix an exact quota of blocks.  A binary tree over
the output shards splits the vector of quotas: each node draws the left
half's share without replacement (multivariate hypergeometric), so every
shard gets exact block counts per source that add up to the quotas.  A source
hands disjoint runs of its permuted blocks to the shards, and each shard
shuffles its own rows.

What the pass that is cut short still owes is filled, largest first, with free
documents that fit, until none does: a histogram of their sizes per source says how
many of each size, and they are looked up by their places.  Where that leaves a source
further than ``NEAR`` from its target (a document as long as a good part of the target
didn't fit), the pass is closed in another way (``closing``): filled from all documents
largest first or, if that is no nearer, with one more document that goes beyond.

What reaches the driver is one row per source and one number per source and shard:
configuration-sized (see ``MAX_CELLS``), never documents or blocks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hangar.llm.common import WORD, bucket, staged, table

#: Block and shard counts, and the bound on sources x shards on the driver.
BLOCKS, SHARDS, SEED = 1024, 16, 20240229
MAX_CELLS = 2_000_000
#: Mixture weights of the sources in code-point order, repeating, and how
#: often the words of a source may be repeated.
WEIGHTS, MAX_REPEATS = (5, 2, 1), 3
#: Share of its target that a source may miss before other closings are looked at: they
#: favour long documents or go beyond the target, so a small miss is left as it is.
NEAR = 0.05
#: Words of a shard that go to one task together (about 64 MB of text).
PART_WORDS = 10_000_000


def targets(sizes: Sequence[int], weights: Sequence[int], cap: int) -> list[Fraction]:
    """Words that each source owes to a mixture as large as the corpus.

    Shares follow the weights; a source is full at ``cap`` times its size and
    its excess goes to the others by weight until none is above.  If all are
    full, each gives its ``cap`` times.
    """
    total, out = sum(sizes), [Fraction(0)] * len(sizes)
    open_, left = list(range(len(sizes))), Fraction(sum(sizes))
    while open_ and total:
        weight = sum(weights[i] for i in open_)
        if not weight:
            break
        share = {i: left * weights[i] / weight for i in open_}
        full = [i for i in open_ if share[i] > cap * sizes[i]]
        if not full:
            for i in open_:
                out[i] = share[i]
            break
        for i in full:
            out[i] = Fraction(cap * sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in set(full)]
    return out


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Exact block counts, shape (sources, shards), from the splitting tree.

    The shards get equal numbers of blocks (to within one); each tree node
    has a generator seeded by its place, so reruns agree.
    """
    out = np.zeros((len(quotas), shards), dtype=np.int64)
    bounds = [int(quotas.sum()) * k // shards for k in range(shards + 1)]
    todo = [(0, shards, quotas.astype(np.int64))]
    while todo:
        lo, hi, counts = todo.pop()
        if hi - lo == 1:
            out[:, lo] = counts
            continue
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])
        left = np.zeros_like(counts)
        need, rest = bounds[mid] - bounds[lo], int(counts.sum())
        for s, n in enumerate(counts):  # the marginals of the joint draw, in turn
            left[s] = rng.hypergeometric(n, rest - n, need) if need and n else 0
            need, rest = need - int(left[s]), rest - int(n)
        todo += [(lo, mid, left), (mid, hi, counts - left)]
    return out


def located(docs: DataFrame, seed: int = SEED, blocks: int = BLOCKS) -> DataFrame:
    """Adds a document's hash block, and its place in the order there: rows with one
    doc_id and different texts have places of their own, equal rows share theirs."""
    key = F.xxhash64("doc_id", "text")
    return docs.withColumns({
        "block": bucket(key, seed, blocks), "place": F.xxhash64(F.lit(seed + 1), key)})


def sized(docs: DataFrame, seed: int = SEED, blocks: int = BLOCKS) -> DataFrame:
    """doc_id, source, size in words, block and place."""
    return located(docs.select("doc_id", "source", "text"), seed, blocks).select(
        "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        "block", "place")


def _rows(spark, rows, schema):
    return spark.createDataFrame(rows, T.StructType.fromDDL(schema))


def closing(near: float, left: int, beyond: int | None, left_again: int,
            beyond_again: int | None, rest: int, longer: int | None
            ) -> tuple[bool, int, int | None]:
    """How a pass that owes ``rest`` words is closed: whether its documents are chosen anew,
    the words that are then filled, and the size of one document more.

    As it is, ``left`` words are owed and the least free document has ``beyond`` words;
    chosen anew, largest first, ``left_again`` and ``beyond_again``; ``longer`` is the least
    document of more than ``rest`` words, which is taken alone.  If one of the two that stay
    below misses ``near`` words at most, it is taken; else what comes nearest.  Of equals,
    the first.
    """
    below = [(left, (False, rest, None)), (left_again, (True, rest, None))]
    if min(left, left_again) <= near:
        return min(below, key=lambda w: w[0])[1]
    ways = list(below)
    if beyond is not None:
        ways.append((abs(beyond - left), (False, rest, beyond)))
    if beyond_again is not None:
        ways.append((abs(beyond_again - left_again), (True, rest, beyond_again)))
    if longer is not None:
        ways.append((longer - rest, (True, 0, longer)))
    return min(ways, key=lambda w: w[0])[1]


def _free(sizes: DataFrame, known: DataFrame, cuts: DataFrame) -> DataFrame:
    """How many free documents a block has of each size that fits the gap (or is that of
    the document that goes beyond)."""
    k = known.select(F.col("source").alias("_k"), F.col("block").alias("_b"), "part")
    fits = F.col("size") <= F.col("gap")
    if "extra" in cuts.columns:
        fits = fits | F.coalesce(F.col("size") == F.col("extra"), F.lit(False))
    return (_untaken(sizes, k, cuts).where((F.col("size") > 0) & fits)
            .groupBy("source", "block", "size", "gap", "after").agg(F.count("*").alias("rows")))


def _untaken(sizes: DataFrame, k: DataFrame, cuts: DataFrame) -> DataFrame:
    """The rows that no whole block and no cut takes, with ``gap`` and ``after``."""
    return (sizes.join(k.where("part != 'whole'"), F.col("source").eqNullSafe(F.col("_k"))
                       & (F.col("block") == F.col("_b")))
            .join(cuts, F.col("source").eqNullSafe(F.col("_s")))
            .withColumn("after", F.when(F.col("part") == "cut", F.col("cut_place")))
            .where(F.col("after").isNull() | (F.col("place") > F.col("after"))))


def _wanted(free: DataFrame) -> DataFrame:
    """source, left, picks: documents of each size that fill the gap, largest first, and
    the words that none fits."""
    def most(s, x):
        n = F.least(x["rows"], F.floor(s["left"] / x["size"]).cast("long"))
        return F.struct((s["left"] - n * x["size"]).alias("left"), F.when(n > 0, F.concat(
            s["picks"], F.array(F.struct(x["size"].alias("size"), n.alias("want")))))
            .otherwise(s["picks"]).alias("picks"))

    return (free.groupBy("source", "gap", "size").agg(F.sum("rows").alias("rows"))
            .groupBy("source", "gap").agg(F.sort_array(F.collect_list(F.struct(
                "size", "rows")), asc=False).alias("sizes"))
            .withColumn("x", F.aggregate(
                "sizes", F.struct(F.col("gap").alias("left"), F.array().cast(
                    "array<struct<size:bigint,want:bigint>>").alias("picks")), most))
            .select("source", "x.left", "x.picks"))


def _least_beyond(rows: DataFrame, want: DataFrame) -> DataFrame:
    """_b, beyond: the least size of which ``rows`` (source, size, rows) has more documents
    than ``want`` takes."""
    taken = want.select(F.col("source").alias("_w"), F.explode("picks").alias("x")).select(
        "_w", F.col("x.size").alias("_size"), F.col("x.want").alias("want"))
    return (rows.join(taken, F.col("source").eqNullSafe(F.col("_w"))
                      & (F.col("size") == F.col("_size")), "left")
            .where(F.col("rows") > F.coalesce("want", F.lit(0).cast("long")))
            .groupBy(F.col("source").alias("_b")).agg(F.min("size").alias("beyond")))


def _far(sizes, known, cuts, free, want, by_source, goal, owed) -> list[tuple]:
    """(source, chosen anew, gap, size of one more) of the sources that another closing
    brings nearer to their targets; from aggregates, one row per source."""
    spark = sizes.sparkSession
    left = cuts.join(want.select(F.col("source").alias("_w"), "left"),
                     F.col("_s").eqNullSafe(F.col("_w")), "left").select(
        "_s", F.coalesce("left", "gap").alias("left")).collect()
    near = {r.source: NEAR * g for r, g in zip(by_source, goal, strict=True)}
    left = {r._s: int(r.left) for r in left if r.left > near[r._s]}
    if not left:
        return []
    own = F.broadcast(_rows(spark, [(s,) for s in left], "_o string"))
    some = lambda df, c="source": df.join(
        own, F.col(c).eqNullSafe(F.col("_o")), "left_semi")
    k = known.select(F.col("source").alias("_k"), F.col("block").alias("_b"), "part")
    untaken = _untaken(some(sizes), k, some(cuts, "_s")).where("size > 0").groupBy(
        "source", "size").agg(F.count("*").alias("rows"))
    beyond = {r._b: r.beyond for r in _least_beyond(untaken, want).collect()}
    rest = some(owed).select(F.col("source").alias("_r"), F.col("rest").alias("gap"))
    every = staged(some(sizes).where("size > 0").groupBy("source", "size").agg(
        F.count("*").alias("rows")).join(F.broadcast(rest), F.col("source").eqNullSafe(
            F.col("_r"))).drop("_r"), "mix_every")
    fresh = staged(_wanted(every.where("size <= gap")), "mix_fresh")
    left_again = {r.source: int(r.left) for r in fresh.select("source", "left").collect()}
    beyond_again = {r._b: r.beyond for r in _least_beyond(every, fresh).collect()}
    longer = {r.source: r.size for r in every.where("size > gap").groupBy("source").agg(
        F.min("size").alias("size")).collect()}
    out = []
    for r in rest.collect():
        again, gap, extra = closing(
            near[r._r], left[r._r], beyond.get(r._r), left_again.get(r._r, r.gap),
            beyond_again.get(r._r), r.gap, longer.get(r._r))
        if again or extra is not None:
            out.append((r._r, again, int(gap), extra))
    return out


def plan(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = MAX_REPEATS,
         shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """What the mix takes of each block.

    ``sizes`` as from ``sized`` (staged: it is read a few times).  One row per
    (source, block): source_size, target, ``units`` (epoch and shard of each
    whole pass over the block), and for the pass that is cut short: the
    documents with ``place`` up to ``cut_place`` are taken, and at each place of
    ``picks`` the first ``k`` of its ``n`` rows, which fill up what is left of the target.
    """
    spark = sizes.sparkSession
    blocks = staged(sizes.groupBy("source", "block").agg(
        F.sum("size").alias("words")), "mix_blocks")
    by_source = blocks.groupBy("source").agg(F.sum("words").alias("w")).collect()
    by_source.sort(key=lambda r: (r.source is None, r.source or ""))
    if len(by_source) * shards > MAX_CELLS:
        raise ValueError(f"{len(by_source)} sources x {shards} shards: use fewer shards")
    sums = [int(r.w) for r in by_source]
    goal = targets(sums, [weights[i % len(weights)] for i in range(len(sums))], cap)
    passes = [int(g // s) if s else 0 for g, s in zip(goal, sums, strict=True)]
    table_ = _rows(spark, [
        (r.source, s, float(g), p, int(round(g - p * s)))
        for r, s, g, p in zip(by_source, sums, goal, passes, strict=True)
    ], "source string, source_size long, target double, passes int, rest long")

    order = F.xxhash64(F.lit(seed + 2), "source", "passes", "block")
    run = Window.partitionBy("source").orderBy("_order", "block")
    known = blocks.join(table_.withColumnRenamed("source", "_s"),
                        F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    known = (known.withColumn("_order", order)
             .withColumn("_end", F.sum("words").over(run))
             .withColumn("_start", F.col("_end") - F.col("words"))
             .withColumn("part", F.when(F.col("_end") <= F.col("rest"), "whole")
                         .when(F.col("_start") < F.col("rest"), "cut").otherwise("none"))
             .withColumn("budget", F.col("rest") - F.col("_start"))
             .select("source", "block", "source_size", "target", "passes", "rest", "part",
                     "budget"))
    known = staged(known, "mix_known")

    # The block that is cut: its documents in order while they fit.  Rows of one place
    # are a group of equal ones, of which the cut can take some.
    cut = known.where("part = 'cut'").select(
        F.col("source").alias("_s"), F.col("block").alias("_b"), "budget")
    inside = sizes.join(cut, F.col("source").eqNullSafe(F.col("_s"))
                        & (F.col("block") == F.col("_b"))).groupBy(
        "source", "block", "budget", "place", "size").agg(F.count("*").alias("n"))
    run = Window.partitionBy("source", "block").orderBy("place", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    upto = inside.withColumn("_end", F.sum(F.col("size") * F.col("n")).over(run)).withColumn(
        "_left", F.col("budget") - F.col("_end") + F.col("size") * F.col("n"))
    fits = F.col("_end") <= F.col("budget")
    some = upto.withColumn("k", F.when(~fits & (F.col("_left") > 0), F.floor(
        F.col("_left") / F.col("size"))).otherwise(0).cast("long"))
    cuts = some.groupBy(F.col("source").alias("_s"), F.col("block").alias("_c")).agg(
        F.max(F.when(fits, F.col("place"))).alias("cut_place"),
        (F.first("budget") - F.sum(F.when(fits, F.col("size") * F.col("n")).otherwise(
            F.col("size") * F.col("k")))).alias("gap"),
        F.max(F.when(F.col("k") > 0, F.struct("place", "k", "n"))).alias("own"))
    cuts = staged(cuts, "mix_cuts")
    free = staged(_free(sizes, known, cuts), "mix_free")
    want = staged(_wanted(free), "mix_want")
    far = _far(sizes, known, cuts, free, want, by_source, goal, table_)
    if far:  # other closings for a few sources
        far = _rows(spark, far, "_f string, again boolean, new_gap long, extra long")
        other = lambda c: F.col(c).eqNullSafe(F.col("_f"))
        again = F.coalesce("again", F.lit(False))
        known = staged(known.join(F.broadcast(far), other("source"), "left").withColumn(
            "part", F.when(again, "none").otherwise(F.col("part"))).drop(*far.columns),
            "mix_known")
        cuts = staged(cuts.join(F.broadcast(far), other("_s"), "left").select(
            "_s", "_c", F.when(~again, F.col("cut_place")).alias("cut_place"),
            F.when(again, F.col("new_gap")).otherwise(F.col("gap")).alias("gap"),
            F.when(~again, F.col("own")).alias("own"), "extra"), "mix_cuts")
        free = staged(_free(sizes, known, cuts), "mix_free")
        want = staged(_wanted(free), "mix_want")
    want = want.select(F.col("source").alias("_w"), F.explode("picks").alias("x")).select(
        "_w", F.col("x.size").alias("_size"), F.col("x.want").alias("want"))
    if far:
        one = cuts.where("extra IS NOT NULL").select("_s", "extra", F.lit(1).cast("long"))
        want = want.unionAll(one).groupBy("_w", "_size").agg(F.sum("want").alias("want"))
    turn = Window.partitionBy("source", "size").orderBy(
        F.xxhash64(F.lit(seed + 5), "block"), "block").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    chosen = (free.join(want, F.col("source").eqNullSafe(F.col("_w"))
                        & (F.col("size") == F.col("_size")))
              .withColumn("take", F.least("rows", F.col("want") - F.sum("rows").over(turn)
                                          + F.col("rows"))).where("take > 0")
              .select(F.col("source").alias("_w"), F.col("block").alias("_b"),
                      F.col("size").alias("_size"), "after", "take"))
    run = Window.partitionBy("source", "block", "size").orderBy("place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    picks = (sizes.join(chosen, F.col("source").eqNullSafe(F.col("_w")) & (
        F.col("block") == F.col("_b")) & (F.col("size") == F.col("_size")))
        .where(F.col("after").isNull() | (F.col("place") > F.col("after")))
        .groupBy("source", "block", "size", "take", "place").agg(F.count("*").alias("n"))
        .withColumn("k", F.least("n", F.col("take") - F.sum("n").over(run) + F.col("n")))
        .where("k > 0").select("source", "block", F.struct("place", "k", "n").alias("pick")))
    picks = picks.unionAll(cuts.where("own IS NOT NULL").select("_s", "_c", "own"))
    if far:  # the document more can be an equal row of a place that the cut takes in part
        picks = picks.groupBy("source", "block", "pick.place").agg(
            F.sum("pick.k").alias("k"), F.max("pick.n").alias("n")).select(
            "source", "block", F.struct("place", "k", "n").alias("pick"))
    picks = (picks.groupBy(F.col("source").alias("_p"), F.col("block").alias("pick_block"))
             .agg(F.collect_list("pick").alias("picks")))

    # Units: each pass over a block; their shards come from the splitting tree.
    n_units = F.col("passes") + F.when(F.col("part") == "none", 0).otherwise(1)
    units = known.where(n_units > 0).select(
        "source", "block", F.explode(F.sequence(F.lit(0), n_units - 1)).alias("epoch"))
    quota_rows = known.groupBy("source").agg(F.sum(n_units).alias("q")).collect()
    quota = {r.source: int(r.q) for r in quota_rows}
    counts = split_quotas(np.array([quota[r.source] for r in by_source], dtype=np.int64),
                          shards, seed)
    ends = _rows(spark, [(r.source, [int(x) for x in np.cumsum(counts[i])])
                         for i, r in enumerate(by_source)], "_e string, ends array<long>")
    ranked = units.withColumn("_rank", F.row_number().over(
        Window.partitionBy("source").orderBy(
            F.xxhash64(F.lit(seed + 3), "source", "epoch", "block"), "epoch", "block")) - 1)
    placed = ranked.join(ends, F.col("source").eqNullSafe(F.col("_e"))).withColumn(
        "shard", F.size(F.filter("ends", lambda e: e <= F.col("_rank"))).cast("int"))
    units = placed.groupBy(F.col("source").alias("_u"), F.col("block").alias("_ub")).agg(
        F.sort_array(F.collect_list(F.struct("epoch", "shard"))).alias("units"))
    out = known.join(units, F.col("source").eqNullSafe(F.col("_u"))
                     & (F.col("block") == F.col("_ub")), "left")
    out = out.join(cuts.select("_s", "cut_place"), F.col("source").eqNullSafe(F.col("_s")), "left")
    out = out.join(picks, F.col("source").eqNullSafe(F.col("_p"))
                   & (F.col("block") == F.col("pick_block")), "left")
    return out.select("source", "block", "source_size", "target", "passes", "part", "units",
                      "cut_place", "picks")


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds ``_nth``: 0, 1, .. for the rows of a place, counted per task and then on
    from task to task, so no place goes to one task as a whole."""
    rows = staged(rows.withColumn("_row", F.monotonically_increasing_id())
                  .withColumn("_task", F.shiftright("_row", 33)), "mix_some")
    at = ["source", "block", "place"]
    before = rows.groupBy(*at, "_task").agg(F.count("*").alias("_n")).withColumn(
        "_before", F.sum("_n").over(Window.partitionBy(*at).orderBy("_task")) - F.col("_n"))
    before = before.select(*[F.col(c).alias(f"_{c}_") for c in (*at, "_task")], "_before")
    nth = F.row_number().over(Window.partitionBy(*at, "_task").orderBy("_row")) - 1
    return (rows.withColumn("_nth", nth)
            .join(before, F.col("source").eqNullSafe(F.col("_source_"))
                  & (F.col("block") == F.col("_block_")) & (F.col("place") == F.col("_place_"))
                  & (F.col("_task") == F.col("__task_")))
            .withColumn("_nth", F.col("_nth") + F.col("_before"))
            .drop("_row", "_task", "_source_", "_block_", "_place_", "__task_", "_before"))


def place(docs: DataFrame, mix: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Adds to rows that have source, block and place (see ``sized``) the
    columns source_size, target and ``placements``: epoch and shard of each copy
    that the mix takes."""
    names = {"source": "_ms", "block": "_mb"}
    m = mix.select(*[F.col(c).alias(names.get(c, c)) for c in mix.columns])
    whole = F.slice(F.coalesce("units", F.array().cast("array<struct<epoch:int,shard:int>>")),
                    F.lit(1), F.col("passes"))
    last = F.element_at("units", -1)
    yes = lambda c: F.coalesce(c, F.lit(False))
    kept = (F.col("part") == "whole") | ((F.col("part") == "cut")
                                         & yes(F.col("place") <= F.col("cut_place")))
    pick = F.get(F.filter("picks", lambda p: p["place"] == F.col("place")), 0)
    rows = (docs.join(m, F.col("source").eqNullSafe(F.col("_ms"))
                      & (F.col("block") == F.col("_mb"))).withColumn("_pick", pick))
    some = yes(F.col("_pick.k") < F.col("_pick.n"))
    whole_rows = rows.withColumn("_nth", F.lit(0).cast("long"))
    if mix.where(F.exists("picks", lambda p: p["k"] < p["n"])).limit(1).count():
        rows = whole_rows.where(~some).unionByName(_numbered(rows.where(some)))
    else:  # no place is taken in part
        rows = whole_rows
    picked = yes(F.col("_nth") < F.col("_pick.k"))
    own = F.struct(F.col("passes").alias("epoch"),
                   F.pmod(F.xxhash64("place", "_nth"), F.lit(shards)).cast("int").alias("shard"))
    return (rows.withColumn("placements", F.when(kept, F.concat(whole, F.array(last)))
                        .when(picked, F.concat(whole, F.array(own))).otherwise(whole))
            .drop("_ms", "_mb", "_pick", "_nth", "passes", "part", "units", "cut_place", "picks"))


def total_words(mix: DataFrame) -> float:
    """Words of the whole mixture, from one row per source of its plan."""
    return mix.groupBy("source").agg(F.max("target").alias("t")).agg(
        F.coalesce(F.sum("t"), F.lit(0.0))).head()[0]


def mixture(placed: DataFrame, seed: int = SEED, words: float = 0, shards: int = SHARDS) -> DataFrame:
    """One row per copy, in its shard, shuffled there.  If the mixture's ``words`` make a
    shard larger than ``PART_WORDS``, ranges of its shuffled order go to tasks of their own."""
    order = F.xxhash64(F.lit(seed + 4), "shard", "doc_id", "epoch")
    rows = placed.select("*", F.explode("placements").alias("_at")).select(
        *[c for c in placed.columns if c != "placements"],
        F.col("_at.shard").alias("shard"), F.col("_at.epoch").alias("epoch"))
    parts = max(1, math.ceil(words / (shards * PART_WORDS)))
    by = [F.col("shard")]
    if parts > 1:
        by.append(F.floor((order.cast("double") / 2.0**64 + 0.5) * parts))
    return rows.repartition(*by).sortWithinPartitions("shard", order)


def op1_mixing(spark, sf_dir):
    """doc_id, size, source_size, target, taken of every document.

    Null and empty texts have size 0; a null source is a source of its own and
    comes last; repeated rows share block and place, and as many of them are
    taken as fit; an empty table gives an empty result; other columns are not looked at.
    """
    sizes = staged(sized(table(spark, sf_dir, "documents")), "mix_sizes")
    placed = place(sizes, staged(plan(sizes), "mix_plan"))
    return placed.select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.size("placements")).alias("taken"),
        F.transform("placements", lambda p: p["shard"]).alias("shards"))
