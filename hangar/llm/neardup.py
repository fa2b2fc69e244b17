"""MinHash near-duplicates (operator 2).

Method: DartMinHash.  Hashed darts are thrown at the region below the weight of
each element of a text's set of five-word shingles; darts carry a rank and a
coordinate, and the earliest dart of each coordinate is the signature.  Rank
bands are thrown in order until every coordinate is hit, so the work follows
the number of elements, not elements times coordinates.  Two signatures agree
in a coordinate with the probability of the weighted Jaccard similarity;
bands of ``ROWS`` coordinates select candidates, which are verified exactly.

Exact copies are folded first, so signatures are made once per text.  Within a
bucket members are compared with leaders, not with each other: first with one
leader; then, in buckets of several classes, members of the largest class lead
against those outside it.  What is still in a bucket of several classes is dealt
out to blocks, and a task compares two blocks at a time and hands on a link per
pair of classes that belong together.  No link that a bucket holds is lost, pairs
are not listed, and a large group of copies costs a few comparisons per member.  Classes are connected components (alternating large
and small stars), kept in tables; nothing of the documents goes to the driver.

Defined cases: a null text counts as empty; texts without words are alike only
if equal; texts under five words are one shingle; repeated rows share a class;
an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hangar.llm.bpe import parts_of
from hangar.llm.common import ship, staged, table

#: Shingle length and least similarity; coordinates = bands x rows.  A pair at
#: 0.8 is missed with probability (1 - 0.8 ** 6) ** 32 < 0.0001.
WORDS, SIMILARITY, BANDS, ROWS = 5, 0.8, 32, 6
#: Leaders per bucket in the rounds after the first; texts in a block of the last.
CENTRE, BLOCK = (4, 16), 512

_M = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * _M[0]
    x = (x ^ (x >> np.uint64(27))) * _M[1]
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def rank_band(i: int) -> tuple[float, float]:
    """Bands of ranks: halves below 1, then unit steps, so that a unit of weight
    never expects more than one dart in a band."""
    if i < 10:
        return (0.0 if i == 0 else 2.0 ** (i - 10)), 2.0 ** (i - 9)
    return float(i - 9), float(i - 8)


def _poisson(mean: float) -> np.ndarray:
    p, out, term = 0.0, [], math.exp(-mean)
    for n in range(16):
        p += term
        out.append(p)
        term *= mean / (n + 1)
    return np.array(out)


def dart_signatures(sets: list[np.ndarray], weights: list[np.ndarray] | None,
                    size: int) -> np.ndarray:
    """Signatures, shape (sets, size), of sets of 64-bit elements; zero rows for
    empty sets.  ``weights`` (positive) default to 1."""
    out = np.zeros((len(sets), size), dtype=np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    if not len(owner):
        return out
    element = np.concatenate(sets).astype(np.uint64)
    height = np.concatenate(weights) if weights else None
    if height is not None:  # one row per unit cell of weight
        cells = np.ceil(height).astype(np.int64)
        cell = np.arange(cells.sum()) - np.repeat(np.cumsum(cells) - cells, cells)
        owner, element, height = (np.repeat(x, cells) for x in (owner, element, height))
        element = element + cell.astype(np.uint64) * _M[2]
        height = height - cell  # the part of the cell below the weight
    hit = np.zeros((len(sets), size), dtype=bool)
    i = 0
    while len(owner):
        lo, hi = rank_band(i)
        seed = mix(element ^ mix(np.full(1, i + 1, dtype=np.uint64) * _M[2]))
        count = np.searchsorted(_poisson(hi - lo), uniform(seed), side="right")
        who = np.flatnonzero(count)
        reps = np.repeat(who, count[who])
        nth = np.arange(len(reps)) - np.repeat(np.cumsum(count[who]) - count[who], count[who])
        dart = mix(seed[reps] + (nth.astype(np.uint64) + np.uint64(1)) * _M[2])
        if height is not None:
            below = uniform(mix(dart ^ _M[0])) < height[reps]
            reps, dart = reps[below], dart[below]
        spot = owner[reps] * size + (dart % np.uint64(size)).astype(np.int64)
        order = np.lexsort((mix(dart ^ _M[1]), spot))  # earliest first within a coordinate
        spot, dart = spot[order], dart[order]
        first = np.flatnonzero(np.diff(spot, prepend=-1))
        spot, dart = spot[first], dart[first]
        new = ~hit.reshape(-1)[spot]
        out.reshape(-1)[spot[new]] = dart[new]
        hit.reshape(-1)[spot[new]] = True
        open_ = ~hit.all(1)
        keep = open_[owner]
        owner, element = owner[keep], element[keep]
        height = height[keep] if height is not None else None
        i += 1
    return out


class _Hashes(dict):
    def __missing__(self, word):
        if len(self) > 300_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_POWERS = np.array([pow(0x9E3779B97F4A7C15, j + 1, 1 << 64) for j in range(64)], dtype=np.uint64)


def shingles(text: str, known: dict, words: int = WORDS) -> np.ndarray:
    """Distinct shingles of a text (lower case, cut at white space), as sorted hashes."""
    found = text.lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    n = min(words, len(h))
    total = np.zeros(len(h) - n + 1, dtype=np.uint64)
    for j in range(n):
        total += h[j:len(h) - n + 1 + j] * _POWERS[j]
    return np.unique(mix(total))


def signed(texts: DataFrame, words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Rows (key, text) as key, bands (array of long) and shingles (array of int)."""
    ship(texts.sparkSession)

    def run(batches):
        known = _Hashes()
        for batch in batches:
            for part in parts_of(batch):
                sets = [shingles(t, known, words) for t in part.column(1).to_pylist()]
                sig = dart_signatures(sets, None, bands * rows).reshape(len(sets), bands, rows)
                code = np.full((len(sets), bands), 0, dtype=np.uint64)
                for j in range(rows):
                    code = mix(code * _M[2] ^ sig[:, :, j])
                code = mix(code + np.arange(1, bands + 1, dtype=np.uint64) * _M[0])
                small = [np.unique((s & np.uint64(0xFFFFFFFF)).astype(np.uint32)).view(np.int32)
                         for s in sets]
                empty = np.array([len(s) == 0 for s in sets])
                yield pa.RecordBatch.from_arrays([
                    part.column(0),
                    pa.array([None if e else c for e, c in zip(empty, code.view(np.int64))],
                             pa.list_(pa.int64())),
                    pa.array(small, pa.list_(pa.int32()))], names=["key", "bands", "shingles"])

    return texts.select("key", "text").mapInArrow(
        run, "key binary, bands array<long>, shingles array<int>")


def similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose sets have at least that Jaccard similarity."""
    left = sets.select(F.col("rid").alias("a"), F.col("shingles").alias("_x"))
    right = sets.select(F.col("rid").alias("b"), F.col("shingles").alias("_y"))
    both = F.size(F.array_intersect("_x", "_y"))
    return pairs.join(left, "a").join(right, "b").where(
        both >= F.lit(least) * (F.size("_x") + F.size("_y") - both) - 1e-9).select("a", "b")


def _mark(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())


def components(edges: DataFrame) -> DataFrame:
    """id and root (the least id) of every node of edges (a, b)."""
    now = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .where("u <> v").distinct(), "links")
    mark = _mark(now)
    while mark[0]:
        sym = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (sym.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(
            F.explode(F.array(F.col("u"), F.col("v"))).alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())
        now = staged(small, "links")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("id"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("id"), F.col("v").alias("root"))).distinct()


def common(x: list[np.ndarray], y: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of each x with each y (sorted distinct elements),
    as products of 0/1 matrices over the shared elements, some columns at a time."""
    out = np.zeros((len(x), len(y)), dtype=np.float32)
    flat = [np.concatenate(z) if z else np.zeros(0, np.int32) for z in (x, y)]
    shared = np.intersect1d(*flat)
    rows = [np.repeat(np.arange(len(z)), [len(v) for v in z]) for z in (x, y)]
    spots = [np.searchsorted(shared, f) for f in flat]
    live = [shared[np.minimum(p, len(shared) - 1)] == f if len(shared) else np.zeros(len(f), bool)
            for p, f in zip(spots, flat)]
    rows, spots = ([z[k] for z, k in zip(q, live)] for q in (rows, spots))
    order = [np.argsort(p, kind="stable") for p in spots]
    rows, spots = ([z[o] for z, o in zip(q, order)] for q in (rows, spots))
    for at in range(0, len(shared), columns):
        parts = []
        for z, r, p in zip((x, y), rows, spots):
            lo, hi = np.searchsorted(p, [at, at + columns])
            m = np.zeros((len(z), columns), dtype=np.float32)
            m[r[lo:hi], p[lo:hi] - at] = 1
            parts.append(m)
        out += parts[0] @ parts[1].T
    return out


def block_links(rows: DataFrame, sets: DataFrame, least: float, size: int = BLOCK) -> DataFrame:
    """Links between different classes within buckets: ``rows`` is band, rid, root.

    A bucket is dealt out to blocks of about ``size`` texts; a task compares two
    blocks and hands on a link for each pair of classes that it joins.
    """
    ship(rows.sparkSession)
    parts = rows.groupBy("band").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("k"))
    dealt = rows.join(parts, "band").withColumn(
        "own", F.pmod(F.xxhash64("rid", "band"), F.col("k")).cast("int"))
    tasks = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).select(
        "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        "own", "rid", "root")

    def run(key, group):
        own, root = (np.asarray(group.column(c)) for c in ("own", "root"))
        texts = [np.asarray(v.values) for v in group.column("shingles").combine_chunks()]
        i, j = key[1].as_py(), key[2].as_py()
        left = np.flatnonzero(own == i)
        right = np.flatnonzero(own == j)
        both = common([texts[k] for k in left], [texts[k] for k in right])
        sizes = np.array([len(t) for t in texts], dtype=np.float32)
        total = sizes[left][:, None] + sizes[right][None, :] - both
        a, b = np.nonzero((both >= np.float32(least) * total - 1e-3)
                          & (root[left][:, None] != root[right][None, :]))
        pairs = np.unique(np.sort(np.stack([root[left][a], root[right][b]], 1), axis=1), axis=0)
        return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})

    return tasks.join(sets, "rid").groupBy("band", "i", "j").applyInArrow(
        run, "a long, b long").distinct()


def star_components(links: DataFrame) -> DataFrame:
    """``components`` of links (leader a, member b) with many members to a leader.

    A member hangs on the least of its leaders, and what it links are its
    leaders: only leaders need the rounds of ``components``.
    """
    least = staged(links.groupBy("b").agg(F.min("a").alias("m")), "leaders")
    others = links.join(least, "b").where("a <> m").select("a", F.col("m").alias("b"))
    own = least.join(links.select(F.col("a").alias("b")).distinct(), "b", "left_semi").select(
        F.col("b").alias("a"), F.col("m").alias("b"))
    roots = staged(components(others.union(own)), "leader_roots")
    hang = least.join(roots.withColumnRenamed("id", "m"), "m", "left").select(
        F.col("b").alias("id"), F.coalesce("root", "m").alias("root"))
    return hang.join(roots, "id", "left_anti").union(roots)


def near_links(reps: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """rid and root of the representatives that have a near-duplicate.

    ``reps``: rid, bands, shingles (staged).
    """
    rows = reps.select(F.explode("bands").alias("band"), "rid",
                       F.size("shingles").alias("n")).select(
        "band", "rid", "n", F.xxhash64("rid").alias("ord"))
    shared = rows.groupBy("band").agg(F.count(F.lit(1)).alias("m"), F.min(
        F.struct("ord", "rid", "n")).alias("lead")).where("m > 1")
    members = staged(rows.join(shared, "band").select("band", "rid", "n", "ord", "lead"), "buckets")
    sized = lambda x, y: F.least(x, y) >= F.lit(least) * F.greatest(x, y) - 1e-9
    pairs = (members.where(F.col("rid") != F.col("lead.rid"))
             .where(sized(F.col("n"), F.col("lead.n")))
             .select(F.col("lead.rid").alias("a"), F.col("rid").alias("b")).distinct())
    # the sets of what shares a bucket: all that is compared from here on
    reps = staged(reps.select("rid", "shingles").join(
        members.select("rid").distinct(), "rid", "left_semi"), "near_sets")
    links = staged(similar(pairs, reps, least), "near_links")
    roots = staged(members.select(F.col("rid").alias("id")).distinct().join(
        star_components(links), "id", "left").select("id", F.coalesce("root", "id").alias("root")),
        "near_roots")
    # A leader has met its whole bucket and needs no more comparisons there.
    left = members.where(F.col("rid") != F.col("lead.rid")).select("band", "rid", "n", "ord")
    root = lambda c: roots.select(F.col("id").alias(c), F.col("root").alias(f"r{c}"))
    for count in (*CENTRE, None):
        placed = left.join(roots.withColumnRenamed("id", "rid"), "rid")
        mixed = placed.groupBy("band").agg(
            F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("band")
        live = placed.join(mixed, "band")
        if count is None:
            found = block_links(staged(live.select("band", "rid", "root"), "near_open"), reps, least)
        else:
            per = live.groupBy("band", "root").agg(F.count(F.lit(1)).alias("c"))
            order = Window.partitionBy("band").orderBy(F.desc("c"), "root", "ord")
            live = staged(live.join(per, ["band", "root"])
                          .withColumn("pos", F.row_number().over(order)), "near_open")
            lead = live.where(F.col("pos") <= count).select(
                "band", F.col("rid").alias("a"), F.col("n").alias("an"),
                F.col("root").alias("ar"), F.col("pos").alias("ap"))
            pairs = (live.join(lead, "band").where((F.col("root") != F.col("ar"))
                                                   & (F.col("pos") > F.col("ap")))
                     .where(sized(F.col("n"), F.col("an")))
                     .select("a", F.col("rid").alias("b")).distinct())
            left = live.where(F.col("pos") > count).select("band", "rid", "n", "ord")
            found = similar(pairs, reps, least).join(root("a"), "a").join(root("b"), "b").select(
                F.col("ra").alias("a"), F.col("rb").alias("b")).distinct()
        found = staged(found, "near_links")
        if not found.isEmpty():  # classes that a new link joins
            joined = components(found).select(F.col("id").alias("root"), F.col("root").alias("_to"))
            roots = staged(roots.join(joined, "root", "left").select(
                "id", F.coalesce("_to", "root").alias("root")), "near_roots")
    return roots


def keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_key", F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")))))


def near_classes(docs: DataFrame) -> DataFrame:
    """key (digest of the text) and root (a number per class) of every text."""
    texts = keyed(docs.select("text")).select(F.col("_key").alias("key"), F.coalesce(
        "text", F.lit("")).alias("text")).dropDuplicates(["key"])
    reps = staged(signed(texts).select(F.monotonically_increasing_id().alias("rid"), "*"),
                  "near_reps")
    roots = near_links(reps)
    return reps.select("key", "rid").join(roots.withColumnRenamed("id", "rid"), "rid", "left").select(
        "key", F.coalesce("root", "rid").alias("root"))


def op2_minhash_neardup(spark, sf_dir):
    """doc_id and class_id (the least doc_id of the class) of every document."""
    docs = table(spark, sf_dir, "documents")
    rows = staged(keyed(docs.select("doc_id", "text")).select("doc_id", F.col("_key").alias("key"))
                  .join(near_classes(docs), "key").select("doc_id", "root"), "near_rows")
    ids = rows.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return rows.join(ids, "root").select("doc_id", "class_id")
