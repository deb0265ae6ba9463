"""Small graphs as edge lists: components, chains, cleaning.

Iterations write each round to the shared folder and stop when a round changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braidlake.functions import sequence as S
from braidlake.runtime import materialize


def state_of(rows: DataFrame) -> tuple:
    """The same for the same set of rows."""
    return tuple(rows.agg(F.count("*"), F.sum(F.xxhash64(*rows.columns).cast("decimal(20,0)"))).first())


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """node and root (the least node of its component) for every node of the edges a, b.

    Alternates large and small stars. A hub may have any number of neighbours: only minima are aggregated, and
    the joins that spread them can be split by adaptive execution.
    """
    ordered = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    edges, state = materialize(ordered, "links"), None
    for _ in range(most):
        # large star: neighbours above a node take the least of its neighbourhood
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        # small star: neighbours below a node, and itself, take the least of those
        below = large.groupBy(F.col("b").alias("a")).agg(F.min("a").alias("m"))
        lowered = large.select(F.col("b").alias("a"), F.col("a").alias("b")).join(below, "a").select(F.col("m").alias("a"), "b")
        small = lowered.union(below.select(F.col("m").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
        edges = materialize(small, "links")
        before, state = state, state_of(edges)
        if state == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    raise RuntimeError("components did not settle")


def classes(nodes: DataFrame, edges: DataFrame, node: str = "node") -> DataFrame:
    """Every node with its root; a node without edges is its own."""
    found = components(edges)
    return nodes.join(found, node, "left").withColumn("root", F.coalesce("root", F.col(node)))


def degrees(edges: DataFrame) -> DataFrame:
    """node, ins, outs."""
    ends = edges.select(F.col("a").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("o")).union(edges.select("b", F.lit(1), F.lit(0)))
    return ends.groupBy("node").agg(F.sum("i").alias("ins"), F.sum("o").alias("outs"))


def sources(edges: DataFrame) -> DataFrame:
    return degrees(edges).where("ins = 0").select("node")


def sinks(edges: DataFrame) -> DataFrame:
    return degrees(edges).where("outs = 0").select("node")


def distances(edges: DataFrame, start: DataFrame, length: str | None = None, most: int = 200) -> DataFrame:
    """node, distance: shortest way from any start node; edges count 1 or their length."""
    step = F.col(length) if length else F.lit(1)
    weighted = materialize(edges.groupBy("a", "b").agg(F.min(step).cast("long").alias("w")), "edges")
    found, state = materialize(start.select("node", F.lit(0).cast("long").alias("distance")), "distances"), None
    for _ in range(most):
        further = found.join(weighted, F.col("node") == F.col("a")).select(F.col("b").alias("node"), (F.col("distance") + F.col("w")).alias("distance"))
        found = materialize(found.union(further).groupBy("node").agg(F.min("distance").alias("distance")), "distances")
        before, state = state, state_of(found)
        if state == before:
            return found
    raise RuntimeError("distances did not settle")


def is_cyclic(edges: DataFrame) -> bool:
    """Whether some walk comes back: nodes without a way in, or out, are peeled off until none is left to peel.

    There are half as many rounds as the longest path of peeled nodes has, however long that is.
    """
    rest = materialize(edges.select("a", "b"), "edges")
    count = rest.count()
    while count:
        left = rest.join(rest.select(F.col("b").alias("a")).distinct(), "a", "left_semi").join(rest.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        rest = materialize(left.select("a", "b"), "edges")
        before, count = count, rest.count()
        if count == before:
            return True
    return False


def strong_components(edges: DataFrame) -> DataFrame:
    """node, root: nodes that reach each other; a node that isn't on a cycle has no row."""
    from .sets import closure

    reach = closure(edges)
    mutual = reach.intersect(reach.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return mutual.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root"))


def walk(steps: DataFrame, most: int = 60) -> DataFrame:
    """x, last, steps for every x of a map x -> to (null: the end): where its walk ends and after how many steps.

    Ways double in length every round. What is on or leads into a ring never ends and has no row.
    """
    first = steps.select("x", "to", F.when(F.col("to").isNull(), 0).otherwise(1).cast("long").alias("steps"), F.when(F.col("to").isNull(), F.col("x")).alias("last"))
    rows = materialize(first, "walk")
    open_ = rows.where("to is not null").count()
    for _ in range(most):
        if not open_:
            break
        second = rows.select(F.col("x").alias("to"), F.col("to").alias("to2"), F.col("steps").alias("steps2"), F.col("last").alias("last2"))
        longer = rows.join(second, "to", "left").select("x", F.col("to2").alias("to"), (F.col("steps") + F.coalesce("steps2", F.lit(0))).alias("steps"), F.coalesce("last", "last2").alias("last"))
        rows = materialize(longer, "walk")
        before, open_ = open_, rows.where("to is not null").count()
        if open_ == before:
            break
    return rows.where("to is null").select("x", "last", "steps")


def chains(links: DataFrame, zero_is_none: bool = False) -> DataFrame:
    """Scaffold ends joined into chains: chain, ordinal, scaffold, reversed.

    links: a, b, ends of scaffolds (2 * scaffold is the head, that and 1 the tail). A link is used if neither end
    has another. A chain is named and begun by the smaller of its two free ends; reversed means that the scaffold
    is entered by its tail. Rings have no free end and give no row. zero_is_none: links of end 0 don't count.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    if zero_is_none:
        both = both.where("a <> 0 and b <> 0")
    one = both.groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("b")).where("n = 1").select("a", "b")
    mutual = materialize(one.join(one.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"]), "mutual")
    # a state x is a scaffold entered at x: it is left at x ^ 1, and the partner of that is entered next
    states = mutual.select(F.col("a").alias("x")).union(mutual.select(F.expr("a ^ 1").alias("x"))).distinct()
    nexts = states.join(mutual, F.expr("x ^ 1") == F.col("a"), "left").select("x", F.col("b").alias("to"))
    ended = walk(nexts).select("x", F.expr("last ^ 1").alias("free"), "steps")
    back = ended.select(F.expr("x ^ 1").alias("x"), F.col("free").alias("start"), F.col("steps").alias("ordinal"))
    return ended.join(back, "x").where("start < free").select(F.col("start").alias("chain"), "ordinal", F.expr("x div 2").alias("scaffold"), (F.col("x") % 2 == 1).alias("reversed"))


def with_singletons(chained: DataFrame, scaffolds: DataFrame) -> DataFrame:
    """The chains, and each scaffold that is in none as a chain of its own. scaffolds: scaffold."""
    alone = scaffolds.select("scaffold").join(chained.select("scaffold"), "scaffold", "left_anti")
    return chained.unionByName(alone.select((2 * F.col("scaffold")).alias("chain"), F.lit(0).cast("long").alias("ordinal"), "scaffold", F.lit(False).alias("reversed")))


def prune_orientations(links: DataFrame) -> DataFrame:
    """Of the links of one pair of scaffolds those of the highest Jaccard index; equal ones all stay."""
    pair = Window.partitionBy(F.least(F.expr("a div 2"), F.expr("b div 2")), F.greatest(F.expr("a div 2"), F.expr("b div 2")))
    return links.withColumn("_best", F.max("jaccard").over(pair)).where(F.col("jaccard") == F.col("_best")).drop("_best")


def unbranched(edges: DataFrame) -> DataFrame:
    """node, path, ordinal: maximal unbranched paths, each named by its first node; rings begin at their least node."""
    rows = materialize(edges.select("a", "b").distinct(), "edges")
    single_out = rows.groupBy("a").agg(F.count("*").alias("n")).where("n = 1").select("a")
    single_in = rows.groupBy("b").agg(F.count("*").alias("n")).where("n = 1").select("b")
    inner = materialize(rows.join(single_out, "a").join(single_in, "b").select("a", "b").where("a <> b"), "inner")
    nodes = rows.select(F.col("a").alias("x")).union(rows.select("b")).distinct()
    # backwards: every node has at most one predecessor, and a path's first node none
    steps = materialize(nodes.join(inner, F.col("x") == F.col("b"), "left").select("x", F.col("a").alias("to")), "steps")
    placed = walk(steps)
    ringed = steps.join(placed.select("x"), "x", "left_anti")
    least = components(ringed.select(F.col("x").alias("a"), F.col("to").alias("b"))).groupBy("root").agg(F.min("node").alias("x")).select("x")
    cut = ringed.join(least.withColumn("_cut", F.lit(True)), "x", "left").select("x", F.when(F.col("_cut").isNull(), F.col("to")).alias("to"))
    both = placed.unionByName(walk(cut))
    return both.select(F.col("x").alias("node"), F.col("last").alias("path"), F.col("steps").alias("ordinal"))


def unitigs(kmers: DataFrame, kmer: str = "kmer") -> DataFrame:
    """seq: the unbranched sequences of a set of k-mers, each once, as the smaller strand.

    Both strands of each k-mer are nodes; a k-mer leads to those that it overlaps in all but one base.
    """
    both = materialize(kmers.select(F.col(kmer).alias("k")).union(kmers.select(S.reverse_complement(kmer))).distinct(), "kmers")
    inner = lambda side: F.expr(f"substring(k, 2)") if side == "a" else F.expr("substring(k, 1, length(k) - 1)")  # noqa: E731, F541
    edges = both.select(F.col("k").alias("a"), inner("a").alias("j")).join(both.select(F.col("k").alias("b"), inner("b").alias("j")), "j").select("a", "b")
    paths = unbranched(edges.where(F.col("b") != S.reverse_complement("a")))
    alone = both.select(F.col("k").alias("node")).join(paths.select("node"), "node", "left_anti")
    paths = paths.unionByName(alone.select("node", F.col("node").alias("path"), F.lit(0).cast("long").alias("ordinal")))
    letters = F.array_sort(F.collect_list(F.struct("ordinal", F.right("node", F.lit(1)).alias("c"))))
    joined = paths.groupBy("path").agg(letters.alias("l"))
    seq = F.concat("path", F.concat_ws("", F.transform(F.filter("l", lambda x: x["ordinal"] > 0), lambda x: x["c"])))
    return joined.select(F.least(seq, S.reverse_complement(seq)).alias("seq")).distinct()


def vertices(edges: DataFrame, k: int, seq: str = "seq") -> DataFrame:
    """Edges (edge, seq) with from_v and to_v: the (k - 1)-mers that they begin and end with."""
    return edges.withColumns({"from_v": F.substring(seq, 1, k - 1), "to_v": F.right(F.col(seq), F.lit(k - 1))})


# Cleaning. Edges: edge, a, b, length (in k-mers), rc (the edge of the other strand). Each operator gives the edges to
# delete; their other strands go with them.


def with_other_strand(doomed: DataFrame, edges: DataFrame) -> DataFrame:
    both = doomed.select("edge").join(edges.select("edge", "rc"), "edge")
    return both.select("edge").union(both.select(F.col("rc").alias("edge"))).distinct()


def delete(edges: DataFrame, doomed: DataFrame) -> DataFrame:
    return edges.join(with_other_strand(doomed, edges), "edge", "left_anti")


def simple_hangs(edges: DataFrame, most: int, ratio: float) -> DataFrame:
    """Dead ends of at most ``most`` beside an edge from the same node that is at least ``ratio`` times as long."""
    ends = edges.join(sinks(edges).withColumnRenamed("node", "b"), "b", "left_semi").where(F.col("length") <= most)
    longest = edges.groupBy("a").agg(F.max("length").alias("_longest"), F.count("*").alias("_n"))
    return ends.join(longest, "a").where((F.col("_n") > 1) & (F.col("_longest") >= ratio * F.col("length"))).select("edge")


def low_unique(edges: DataFrame, copies: DataFrame, least: int = 75, fraction: float | None = None) -> DataFrame:
    """Edges of components with fewer than ``least`` k-mers of multiplicity 1, or less than that fraction of them.

    copies: edge, multiplicity.
    """
    found = edges.join(components(edges.select("a", "b")), F.col("a") == F.col("node"), "left").withColumn("root", F.coalesce("root", "a")).join(copies, "edge")
    per = found.groupBy("root").agg(F.sum(F.when(F.col("multiplicity") == 1, F.col("length")).otherwise(0)).alias("u"), F.sum("length").alias("t"))
    weak = per.where(F.col("u") < fraction * F.col("t")) if fraction is not None else per.where(F.col("u") < least)
    return found.join(weak.select("root"), "root", "left_semi").select("edge")


def weak_branches(pairs: DataFrame, lose: int, win: int, ratio: float) -> DataFrame:
    """Of the two edges that follow an edge, the weaker, if its support n1 is at most ``lose``, the other's at least
    ``win`` and ``ratio`` times n1. pairs: a, b, n (how often edge b follows edge a)."""
    per = pairs.groupBy("a").agg(F.count("*").alias("k"), F.min_by("b", F.struct("n", "b")).alias("edge"), F.min("n").alias("n1"), F.max("n").alias("n2")).where("k = 2")
    return per.where((F.col("n1") <= lose) & (F.col("n2") >= win) & (F.col("n2") >= ratio * F.col("n1"))).select("edge").distinct()


def weak_bubbles(edges: DataFrame, pairs: DataFrame, delta: int, most: int, ratio: float) -> DataFrame:
    """Branches of two-branch bubbles with few pairs of their own. pairs: edge, pair_id.

    Lengths differ by 1 to ``delta``; a branch with at most ``most`` exclusive pairs loses against ``ratio`` times
    as many, at least that ratio.
    """
    e, f = edges.alias("e"), edges.alias("f")
    twins = e.join(f, (F.col("e.a") == F.col("f.a")) & (F.col("e.b") == F.col("f.b")) & (F.col("e.edge") != F.col("f.edge")))
    two = edges.groupBy("a", "b").agg(F.count("*").alias("n")).where("n = 2").select(F.col("a").alias("_a"), F.col("b").alias("_b"))
    twins = twins.join(two, (F.col("e.a") == F.col("_a")) & (F.col("e.b") == F.col("_b"))).where(F.abs(F.col("e.length") - F.col("f.length")).between(1, delta))
    twins = twins.select(F.col("e.edge").alias("edge"), F.col("f.edge").alias("other"))
    own = pairs.distinct()
    shared = twins.join(own, "edge").join(own.select(F.col("edge").alias("other"), F.col("pair_id").alias("p2")).withColumnRenamed("p2", "pair_id"), ["other", "pair_id"], "left_semi")
    sizes = own.groupBy("edge").agg(F.count("*").alias("n"))
    common = shared.groupBy("edge", "other").agg(F.count("*").alias("c"))
    named = lambda c, n: sizes.select(F.col("edge").alias(c), F.col("n").alias(n))
    rows = twins.join(named("edge", "n1"), "edge", "left").join(named("other", "n2"), "other", "left").join(common, ["edge", "other"], "left").na.fill(0)
    mine, theirs = F.col("n1") - F.col("c"), F.col("n2") - F.col("c")
    return rows.where((mine <= most) & (theirs >= ratio * F.greatest(F.lit(1), mine))).select("edge")


def inversion_bubbles(paths: DataFrame) -> DataFrame:
    """Edges between an edge and its own reverse complement. paths: line, ordinal, edge, rc."""
    order = Window.partitionBy("line").orderBy("ordinal")
    return paths.withColumns({"_next": F.lead("edge", 1).over(order), "_after": F.lead("edge", 2).over(order)}).where("_after = rc").select(F.col("_next").alias("edge")).distinct()


def splay(edges: DataFrame, ends: DataFrame) -> DataFrame:
    """Edges with nodes split: at each node of ``ends`` (node) with several edges, every edge gets a node of its own."""
    busy = degrees(edges).where("ins + outs > 1").join(ends, "node", "left_semi").select("node").withColumn("_s", F.lit(True))
    own = lambda c: F.when(F.col("_s"), F.concat(F.col(c).cast("string"), F.lit(":"), F.col("edge").cast("string"))).otherwise(F.col(c).cast("string"))
    out = edges
    for c in ("a", "b"):
        out = out.join(busy.withColumnRenamed("node", c), c, "left").withColumn(c, own(c)).drop("_s")
    return out.select(*edges.columns)


def pulled_apart(pairs: DataFrame, least: int = 5, ratio: float = 5.0, most: int = 4) -> DataFrame:
    """Ways through repeats that can be told apart. pairs: repeat, a, b, n over two ways in and two out.

    Both straight supports are at least ``least``, each at least ``ratio`` times every crossing one, which is at most
    ``most``. Result: repeat, a, b of the straight ways.
    """
    ins, outs = Window.partitionBy("repeat", "a"), Window.partitionBy("repeat", "b")
    shape = pairs.groupBy("repeat").agg(F.count_distinct("a").alias("i"), F.count_distinct("b").alias("o")).where("i = 2 and o = 2").select("repeat")
    rows = pairs.join(shape, "repeat", "left_semi").withColumns({"straight": (F.col("n") == F.max("n").over(ins)) & (F.col("n") == F.max("n").over(outs))})
    per = rows.groupBy("repeat").agg(
        F.count_if("straight").alias("k"), F.min(F.when(F.col("straight"), F.col("n"))).alias("s"), F.coalesce(F.max(F.when(~F.col("straight"), F.col("n"))), F.lit(0)).alias("x")
    )
    good = per.where((F.col("k") == 2) & (F.col("s") >= least) & (F.col("s") >= ratio * F.col("x")) & (F.col("x") <= most)).select("repeat")
    return rows.where("straight").join(good, "repeat", "left_semi").select("repeat", "a", "b")


def pair_links(ends: DataFrame, most: int = 1000, least: int = 2) -> DataFrame:
    """a -> b, support: lines joined by mates. ends: support_id, mate, line, rc_line, distance (to the line's end).

    The distances of both mates sum to at most ``most``; links of a line to itself or its other strand don't
    count; ``least`` distinct support ids are needed.
    """
    x, y = ends.where("mate = 0").alias("x"), ends.where("mate = 1").alias("y")
    rows = x.join(y, F.col("x.pair_id") == F.col("y.pair_id")).where(
        (F.col("x.distance") + F.col("y.distance") <= most) & (F.col("x.line") != F.col("y.line")) & (F.col("x.line") != F.col("y.rc_line"))
    )
    per = rows.groupBy(F.col("x.line").alias("a"), F.col("y.rc_line").alias("b")).agg(F.count_distinct("x.support_id").alias("support"))
    return per.where(F.col("support") >= least)


def support_id(barcode: Column, read: Column, unbarcoded: Column) -> Column:
    """What counts as one piece of evidence: a barcode; all unbarcoded reads of one kind; otherwise a read."""
    return F.when(barcode > 0, barcode).when(unbarcoded, F.lit(0)).otherwise(-read - 1)
