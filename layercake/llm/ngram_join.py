"""N-gram Jaccard join by vertical partitioning (operator 5).

A document's set of word n-grams is hashed; documents with equal sets are one class from then on. N-grams
have one global order, which is cut into fragments.

The first fragment screens: a set that is similar to another may miss few of its n-grams, so a class with
more n-grams of its own in the first fragment than that is similar to none. Whatever is left is cut into
fragments by the global order. Its n-grams are counted, and a class enters its rarest ones, as many as it
may miss (plus one); two similar classes share one of these. For a candidate pair the fragments count their
overlaps separately, each from the two parts it holds, and the counts are summed per pair.

Groups of similar classes are joined to components without making all their pairs. In each round a class is
compared with one hub, the class it shares most candidate n-grams with; lists whose members have all met
in one component are done. Once fewer pairs than list entries are left, or rounds with other hubs spare fewer
pairs than they read list entries, what is left is compared pair by pair: within a list and a band of sizes, in the
first list that both are in. So every link between different sets is either compared or already implied, and the
components are exact.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import Window

from layercake.llm.components import components
from layercake.llm.decontaminate import small
from layercake.llm.text import SPACE_CHARS, lower_words, numbers, table, without
from layercake.llm.scratch import Scratch

FRAGMENTS = 4
BARREN = 2  # so many rounds of hubs in a row that do not pay end them
BEFORE = 64  # n-grams of a set, before the one at hand, that tell whether a pair was made already
LOWEST, RANGE = -(2**63), 2**64


@dataclass(frozen=True)
class Similarity:
    """Jaccard similarity of at least ``percent`` over sets of ``n`` consecutive words."""

    n: int = 4
    percent: int = 85

    def least(self, size: Column) -> Column:
        """The smallest overlap that a set of this size has with a similar one."""
        return F.ceil(size * self.percent / F.lit(100.0)).cast("int")

    def needed(self, size: Column) -> Column:
        """Of any so many n-grams of a set of this size, a similar set has one."""
        return size - self.least(size) + 1

    def fits(self, shared_a: Column, size_a: Column, shared_b: Column, size_b: Column) -> Column:
        """Whether sets can be similar of which no more than so many n-grams are shared with any other set."""
        return self.linked(F.least(shared_a, shared_b), size_a, size_b)

    def linked(self, overlap: Column, a: Column, b: Column) -> Column:
        return 100 * overlap >= self.percent * (a + b - overlap)

    def band(self, size: Column) -> Column:
        """Similar sets are in one band of sizes or in two that follow each other.

        A band is a little wider than the ratio of two similar sizes, so that rounding parts none.
        """
        width = max(math.log(100 / self.percent), 1e-6) * (1 + 1e-9)
        return F.floor(F.log(size.cast("double")) / F.lit(width)).cast("int")

    @property
    def cut(self) -> int:
        """The end of the first fragment. It holds more n-grams than a set may miss, with some room."""
        return LOWEST + int(RANGE * min(0.99, 1.6 * (1 - self.percent / 100)))


def with_grams(docs: DataFrame, text: str, n: int) -> DataFrame:
    """``docs`` with ``grams``: the sorted hashes of its distinct n-grams, in the global order.

    A text of fewer words has one n-gram, all of it; one without words has none.
    """
    df = docs.withColumn("_words", F.transform(lower_words(F.col(text), SPACE_CHARS), lambda w: F.xxhash64(w)))
    each = F.transform(numbers(F.size("_words") - (n - 1)), lambda i: F.xxhash64(*[F.get("_words", i + j) for j in range(n)]))
    few = F.when(F.size("_words") > 0, F.array(F.xxhash64("_words"))).otherwise(F.array().cast("array<bigint>"))
    grams = F.when(F.size("_words") >= n, each).otherwise(few)
    return df.withColumn("grams", F.sort_array(F.array_distinct(grams))).drop("_words")


def signed(docs: DataFrame, like: Similarity) -> DataFrame:
    """(_id, _hash, size, n_first, s1, s2, first) of each row: ids of row and set, and the set's n-grams of
    the first fragment, or as many as decide about similarity if that is more."""
    df = with_grams(docs, "_text", like.n).withColumns(
        {
            "_hash": F.xxhash64("_text"),
            "size": F.size("grams"),
            "n_first": F.size(F.filter("grams", lambda g: g < F.lit(like.cut))),
        }
    )
    return df.select(
        "_id",
        "_hash",
        "size",
        "n_first",
        F.xxhash64("grams").alias("s1"),
        F.xxhash64(F.lit(1), "grams").alias("s2"),
        F.slice("grams", F.lit(1), F.greatest("n_first", F.least(like.needed(F.col("size")), F.col("size")))).alias("first"),
    )


def screened(sets: DataFrame, like: Similarity) -> DataFrame:
    """The classes (column ``node``) that the first fragment does not show to be similar to none."""
    both = F.shiftleft(F.col("size").cast("long"), 32).bitwiseOR(F.col("n_first").cast("long"))
    every = sets.select("node", both.alias("sizes"), F.explode("first").alias("gram"))
    shared = every.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).filter("df > 1").select("gram")
    met = every.join(shared, "gram").groupBy("node", "sizes").agg(
        F.sum((F.col("gram") < F.lit(like.cut)).cast("int")).alias("n_shared")
    )
    size, n_first = F.shiftright("sizes", 32).cast("int"), F.col("sizes").bitwiseAND(F.lit(2**32 - 1)).cast("int")
    return met.filter((n_first - F.col("n_shared") < like.needed(size)) | (n_first < like.needed(size))).select("node").distinct()


def candidate_postings(parts: DataFrame, like: Similarity) -> DataFrame:
    """(gram, df, node, sign, size, shared, at): each set's rarest n-grams that another set has too, how many it has
    and where the n-gram stands among them, from 1, the rarest first. A node may have several sets."""
    every = parts.select("node", "sign", "size", F.explode("part").alias("gram"))
    shared = every.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    of_set = Window.partitionBy("node", "sign", "size")
    ranked = every.join(shared, "gram").withColumns(
        {"at": F.row_number().over(of_set.orderBy("df", "gram")), "shared": F.count(F.lit(1)).over(of_set).cast("int")}
    )
    kept = ranked.filter(F.col("at") <= like.needed(F.col("size")) - (F.col("size") - F.col("shared")))
    return kept.select("gram", "df", "node", "sign", "size", "shared", "at")


def once(rows: DataFrame, again: DataFrame, repeated: bool, key: str = "_id") -> DataFrame:
    """``rows`` with those of the ids in ``again`` made distinct; only these are shuffled."""
    if not repeated:
        return rows
    again = small(again.select(F.col("_id").alias(key)))
    return rows.join(again, key, "left_anti").unionByName(rows.join(again, key, "left_semi").distinct())


def fragments(docs: DataFrame, nodes: DataFrame, like: Similarity) -> DataFrame:
    """(node, size, sign, fragment, part): the n-grams of the classes in ``nodes``, cut by the global order."""
    mine = docs.join(small(nodes.select(F.col("node").alias("_id"))), "_id", "left_semi")
    df = with_grams(mine, "_text", like.n)
    width = RANGE // FRAGMENTS

    def part(i: int) -> Column:
        low, high = LOWEST + i * width, LOWEST + (i + 1) * width - 1
        cut = F.filter("grams", lambda g: (g >= F.lit(low)) & (g <= F.lit(high)))
        return F.struct(F.lit(i).alias("fragment"), cut.alias("part"))

    return df.select(
        F.col("_id").alias("node"), F.size("grams").alias("size"), F.xxhash64("grams").alias("sign"), F.inline(F.array(*[part(i) for i in range(FRAGMENTS)]))
    )


def overlaps(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """(a, b, size_a, size_b, left_a, left_b, overlap) of each pair (a, b): one count per fragment, summed."""

    def side(x: str) -> DataFrame:
        return parts.select(F.col("node").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("size", "sign", "left", "part")], "fragment")

    other = side("b").join(small(pairs.select("b").distinct()), "b", "left_semi")
    met = side("a").join(small(pairs), "a").join(other, ["b", "fragment"])
    texts = ["a", "b", "size_a", "size_b", "sign_a", "sign_b", "left_a", "left_b"]
    counted = met.select(*texts, "fragment", F.size(F.array_intersect("part_a", "part_b")).alias("k"))
    # A repeated pair or part would count a fragment twice.
    single = counted.groupBy(*texts, "fragment").agg(F.max("k").alias("k"))
    return single.groupBy(*texts).agg(F.sum("k").alias("overlap")).drop("sign_a", "sign_b")


def links(postings: DataFrame, parts: DataFrame, like: Similarity, scratch: Scratch) -> DataFrame:
    """Links (a, b) between classes: enough of them for exact components.

    A round of hubs reads every open list, so it pays if it spares as many pairs as there are list entries and a
    tenth of all: a link found now and then does not, and the number of rounds grows with the logarithm of the pairs.
    """
    spark, on = postings.sparkSession, ["a", "b"]
    known = refused = spark.createDataFrame([], "a long, b long")
    rest, turn, poor, before = postings.withColumn("root", F.col("node")), 0, 0, None
    while True:
        lists = _open_lists(rest)
        rest = scratch.put(rest.join(lists.select("gram"), "gram", "left_semi"), "open")
        per_root = rest.groupBy("gram", "root").agg(F.count(F.lit(1)).alias("m"))
        sizes = per_root.groupBy("gram").agg(F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("same"))
        row = sizes.agg(F.sum((F.col("m") * F.col("m") - F.col("same")) / 2).alias("pairs"), F.sum("m").alias("rows")).first()
        if not row.rows:
            return known
        if before is not None:
            poor = 0 if before - row.pairs >= max(row.rows, before / 10) else poor + 1
        last, before = row.pairs <= row.rows or poor == BARREN, row.pairs
        pairs = _left_pairs(rest, like) if last else _hub_pairs(rest, like, turn)
        pairs = scratch.put(pairs.join(refused, on, "left_anti"), "pairs")
        # The first fragment alone shows most pairs not to be similar: the rest can add no more than it holds.
        begun = overlaps(pairs, parts.filter("fragment = 0").withColumn("left", F.col("size") - F.size("part")))
        could = like.linked(F.col("overlap") + F.least("left_a", "left_b"), F.col("size_a"), F.col("size_b"))
        likely = scratch.put(begun.filter(could).select(*on).distinct(), "likely")
        judged = overlaps(likely, parts.withColumn("left", F.lit(0))).filter(like.linked(F.col("overlap"), F.col("size_a"), F.col("size_b")))
        new = scratch.put(judged.select(*on).distinct(), "links")
        # Rounds are read in one scan: a plan that grew with them would fill the driver.
        known = scratch.put_all(new, "known")
        if last:
            return known
        turn += 1
        refused = scratch.put_all(pairs.join(new, on, "left_anti"), "refused")
        scratch.drop("pairs", "likely")
        if not new.isEmpty():
            roots = components(known, scratch)
            rest = rest.drop("root").join(small(roots), "node", "left").withColumn("root", F.coalesce("root", "node"))


def _open_lists(rest: DataFrame) -> DataFrame:
    """Lists with sets of more than one component; of lists with the same sets, one.

    N-grams of a passage that many documents share are in the same documents. Lists are told apart by
    their length and the sums of 128 bits of their members' hashes, 32 at a time, so that no sum overflows
    and a member that stands twice does not cancel itself. The one of the rarest n-gram stays, so that the
    first n-gram that two sets share keeps its list.
    """
    hashes = [F.xxhash64("node", "sign"), F.xxhash64(F.lit(1), "node", "sign")]
    halves = [half for h in hashes for half in (h.bitwiseAND(F.lit(2**32 - 1)), F.shiftrightunsigned(h, 32))]
    members = [F.count(F.lit(1)), *[F.sum(half) for half in halves]]
    lists = rest.groupBy("gram").agg(
        F.min("df").alias("df"), F.min("root").alias("low"), F.max("root").alias("high"), *[m.alias(f"m{i}") for i, m in enumerate(members)]
    )
    return lists.filter("low <> high").groupBy(*[f"m{i}" for i in range(len(members))]).agg(F.min(F.struct("df", "gram")).alias("first")).select("first.gram")


def _hub_pairs(rest: DataFrame, like: Similarity, turn: int) -> DataFrame:
    """For each class the hub of another component that it shares most lists with.

    At first a list's hub is the class with least of its own, which copies with changes were made from;
    later a class of one component, another one each time.
    """
    rank = [-F.col("shared") / F.col("size")] if not turn else [F.col("root"), F.xxhash64("node", F.lit(turn))]
    hubs = rest.groupBy("gram").agg(F.min_by(F.struct("root", "size", "shared", "node"), F.struct(*rank, "node")).alias("hub"))
    met = rest.join(hubs, "gram").filter((F.col("root") != F.col("hub.root")) & like.fits(F.col("shared"), F.col("size"), F.col("hub.shared"), F.col("hub.size")))
    voted = met.groupBy("node", F.col("hub.node").alias("hub")).agg(F.count(F.lit(1)).alias("votes"))
    best = voted.groupBy("node").agg(F.max_by("hub", F.struct("votes", -F.col("hub"))).alias("hub"))
    return best.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def _left_pairs(rest: DataFrame, like: Similarity) -> DataFrame:
    """Every pair of classes of different components that meet in a list and can be similar.

    Classes meet by list and band of sizes. A pair counts in the first of the lists that it meets in: it shares none
    of the n-grams before that one, so no more than the fewer that either has from there on. The nearest n-grams
    before the one at hand tell most later lists apart, and their number is fixed; what they miss is made once more
    and falls to ``distinct``.
    """
    earlier = Window.partitionBy("node", "sign", "size").orderBy("at").rowsBetween(-BEFORE, -1)
    mine = rest.withColumns(
        {"before": F.collect_list("gram").over(earlier), "ahead": F.col("shared") - F.col("at") + 1, "band": like.band(F.col("size"))}
    ).select("gram", "band", "node", "size", "ahead", "root", "before")
    # A class meets the larger ones of its own band and of the next one.
    other = mine.select("gram", *[F.col(c).alias(f"{c}_b") for c in mine.columns if c != "gram"])
    other = other.withColumn("band", F.explode(F.array("band_b", F.col("band_b") - 1)))
    met = mine.join(other, ["gram", "band"]).filter(
        ((F.col("band") < F.col("band_b")) | (F.col("node") < F.col("node_b")))
        & (F.col("root") != F.col("root_b"))
        & like.fits(F.col("ahead"), F.col("size"), F.col("ahead_b"), F.col("size_b"))
        & ~F.arrays_overlap("before", "before_b")
    )
    return met.select(F.least("node", "node_b").alias("a"), F.greatest("node", "node_b").alias("b")).distinct()


def id_links(sets: DataFrame, classes: DataFrame, again: DataFrame, same: list[str]) -> DataFrame:
    """Links (a, b) between the classes that an id of several rows has sets of."""
    held = sets.join(small(again), "_id", "left_semi").join(classes, same).select("_id", "node").distinct()
    least = held.groupBy("_id").agg(F.min("node").alias("a"))
    return held.join(least, "_id").filter("a <> node").select("a", F.col("node").alias("b")).distinct()


def ngram_components(docs: DataFrame, like: Similarity = Similarity(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``n_shingles`` (size of the set) and ``component_id`` (smallest id reachable by links).

    Null and empty texts and texts without words have an empty set and are their own component. Repeated
    rows and copies are one class. Rows that share an id are one node, linked if one of them is. A row
    without id takes the component of its class, null if no row of the class has an id. Ids are numbers.
    Input columns named like a result are replaced.
    """
    source = docs.select(F.col(f"`{key}`").cast("long").alias("_id"), F.col(f"`{text}`").alias("_text"))
    scratch, same = Scratch(docs.sparkSession, "ngram_join"), ["s1", "s2", "size"]
    sets = scratch.put(signed(source, like), "sets")
    classes = sets.filter("size > 0").groupBy(*same).agg(F.min("_id").alias("node")).filter("node IS NOT NULL")
    classes = scratch.put(classes, "classes")
    again = sets.groupBy("_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 AND _id IS NOT NULL").select("_id")
    again = scratch.put(again, "again")
    repeated = not again.isEmpty()
    own = once(sets.join(classes.withColumnRenamed("node", "_id"), [*same, "_id"], "left_semi"), again, repeated)
    nodes = scratch.put(screened(own.withColumnRenamed("_id", "node"), like), "nodes")
    sets = scratch.put(sets.select("_id", "_hash", *same).distinct(), "ids")
    scratch.drop("sets")
    parts = scratch.put(once(fragments(source, nodes, like), again, repeated, "node"), "fragments")
    postings = scratch.put(candidate_postings(parts, like), "postings")
    scratch.tidy()
    found = links(postings, parts, like, scratch)
    if repeated:
        found = found.unionByName(id_links(sets, classes, again, same))
    roots = components(found, scratch)
    of_class = classes.join(small(roots), "node", "left").select(*same, F.coalesce("root", "node").alias("component_id"))
    rows = sets.join(of_class, same, "left")
    own_id = F.when(F.col("size") == 0, F.col("_id"))
    rows = rows.select(
        F.col("_id").alias("_i"), F.col("_hash").alias("_h"), F.col("size").cast("long").alias("n_shingles"),
        F.coalesce("component_id", own_id).alias("component_id"),
    )
    mine = without(docs, ["n_shingles", "component_id", "_i", "_h", "_hash"]).withColumn("_hash", F.xxhash64(F.col(f"`{text}`")))
    on = F.col(f"`{key}`").cast("long").eqNullSafe(F.col("_i")) & (F.col("_hash") == F.col("_h"))
    return mine.join(rows, on, "left").drop("_i", "_h", "_hash")


def op5_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_components(table(spark, folder, "documents").select("doc_id", "text"))
