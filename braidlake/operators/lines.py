"""Lines (chains of bubbles) of assembly graphs, read placement, and gaps between lines."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import graph, windows


def lines(edges: DataFrame, most_paths: int = 10, most_depth: int = 6) -> DataFrame:
    """line, cell, branch, ordinal, edge: graphs as chains of cells.

    edges: edge, a, b, length. A cell is a set of parallel paths between two nodes: all ways out of the one meet
    again in the other, within ``most_depth`` edges and ``most_paths`` paths. From the longest edge not yet used, a
    line is extended to the right and then to the left, through single edges and cells. Lines are numbered by their
    component and order of length. A component of the graph is handled as a whole; after cleaning, components are
    chromosomes' pieces at most, and edges are few beside reads.
    """
    rooted = edges.join(graph.components(edges.select("a", "b")), F.col("a") == F.col("node"), "left").withColumn("root", F.coalesce("root", "a")).select("root", "edge", "a", "b", "length")
    schema = "line string, cell int, branch int, ordinal int, edge long"

    def of(rows: pd.DataFrame) -> pd.DataFrame:
        out: dict[int, list[tuple[int, int]]] = {}
        into: dict[int, list[tuple[int, int]]] = {}
        ends = {}
        for e, a, b in zip(rows["edge"].tolist(), rows["a"].tolist(), rows["b"].tolist(), strict=True):
            out.setdefault(a, []).append((e, b))
            into.setdefault(b, []).append((e, a))
            ends[e] = (a, b)
        used: set[int] = set()

        def cell(node: int, ways: dict, back: dict) -> tuple[list[list[int]], int] | None:
            """The paths from a node to where all of them meet again."""
            if len(ways.get(node, [])) == 1:
                e, there = ways[node][0]
                return ([[e]], there) if len(back.get(there, [])) == 1 else None
            paths = [([e], there) for e, there in sorted(ways.get(node, []))]
            for _ in range(most_depth):
                if len(paths) > most_paths or not paths:
                    return None
                if len({there for _, there in paths}) == 1:
                    there = paths[0][1]
                    inside = {e for p, _ in paths for e in p}
                    return ([p for p, _ in paths], there) if all(e in inside for e, _ in back.get(there, [])) else None
                # those that lag behind go on: a node that another path ends at, waits
                goals = {there for _, there in paths}
                grown = []
                for p, there in paths:
                    waits = all(there == g or not reaches(there, g, ways) for g in goals)
                    nexts = ways.get(there, [])
                    grown += [(p, there)] if waits or not nexts else [([*p, e], t) for e, t in sorted(nexts)]
                if grown == paths:
                    return None
                paths = grown
            return None

        def reaches(x: int, goal: int, ways: dict) -> bool:
            seen, front = {x}, [x]
            for _ in range(most_depth):
                front = [t for n in front for _, t in ways.get(n, []) if t not in seen]
                seen |= set(front)
                if goal in seen:
                    return True
            return False

        found = []
        order = sorted(zip((-rows["length"]).tolist(), rows["edge"].tolist(), strict=True))
        for _, start in order:
            if start in used:
                continue
            used.add(start)
            chain = [[[start]]]
            for ways, back, way in ((out, into, 1), (into, out, -1)):
                node, last = ends[start][1 if way == 1 else 0], {start}
                # a line goes on where nothing but its last cell leads in
                while all(e in last for e, _ in back.get(node, [])) and (got := cell(node, ways, back)) is not None:
                    paths, node = got
                    last = {e for p in paths for e in p}
                    if last & used:
                        break
                    used |= last
                    chain = [*chain, paths] if way == 1 else [[p[::-1] for p in paths], *chain]
            found.append(chain)
        root = rows["root"].iloc[0]
        data = [(f"{root}_{n}", c, b, o, e) for n, chain in enumerate(found) for c, paths in enumerate(chain) for b, p in enumerate(paths) for o, e in enumerate(p)]
        return pd.DataFrame(data, columns=["line", "cell", "branch", "ordinal", "edge"])

    return rooted.groupBy("root").applyInPandas(of, schema)


def edge_offsets(parts: DataFrame, edges: DataFrame) -> DataFrame:
    """line, edge, start: where each edge begins on its line, each cell as long as its median branch."""
    from .aggregates import line_lengths

    sized = parts.join(edges.select("edge", "length"), "edge")
    branches = sized.groupBy("line", "cell", "branch").agg(F.sum("length").alias("length"))
    cells = line_lengths(branches.select(F.struct("line", "cell").alias("line"), F.lit(0).alias("cell"), "length")).select("line.line", "line.cell", "length")
    before = F.coalesce(F.sum("length").over(Window.partitionBy("line").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inner = F.coalesce(F.sum("length").over(Window.partitionBy("line", "cell", "branch").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = cells.withColumn("before", before).drop("length")
    return sized.withColumn("inner", inner).join(starts, ["line", "cell"]).select("line", "edge", (F.col("before") + F.col("inner")).alias("start"))


def barcode_positions(paths: DataFrame, offsets: DataFrame, ends: DataFrame | None = None, view: int | None = None) -> DataFrame:
    """line, barcode, pos, pair_id of reads on lines, by the first edge of their path.

    paths: read_id, barcode, offset, edges. offsets: line, edge, start. With ends (line, length) and a view, only
    reads within it of either end of their line are returned.
    """
    first = paths.where("size(edges) > 0 and barcode > 0").select("read_id", "barcode", "offset", F.col("edges")[0].alias("edge"))
    rows = first.join(offsets, "edge").select("line", "barcode", (F.col("start") + F.col("offset")).alias("pos"), F.expr("read_id div 2").alias("pair_id"))
    if ends is None or view is None:
        return rows
    return rows.join(ends, "line").where((F.col("pos") < view) | (F.col("length") - F.col("pos") <= view)).drop("length")


def placements(hits: DataFrame, territory: DataFrame | None = None) -> DataFrame:
    """One placement a read: the most k-mers; with territories of its barcode, a place within one first (ties: line, pos).

    hits: read_id, barcode, line, pos, kmers. territory: barcode, line, start, stop.
    """
    rows = hits.withColumn("home", F.lit(0))
    if territory is not None:
        inside = hits.join(territory, ["barcode", "line"]).where("pos between start and stop").select("read_id", "line", "pos").distinct().withColumn("_h", F.lit(1))
        rows = hits.join(inside, ["read_id", "line", "pos"], "left").withColumn("home", F.coalesce("_h", F.lit(0))).drop("_h")
    best = rows.groupBy("read_id").agg(F.min(F.struct((-F.col("home")).alias("h"), (-F.col("kmers")).alias("k"), "line", "pos")).alias("b"))
    return best.select("read_id", "b.line", "b.pos", (-F.col("b.k")).alias("kmers"), (F.col("b.h") < 0).alias("at_home"))


#: How a neighbour may lie beside a line: before or after it, and which way round.
HYPOTHESES = (("after", False), ("after", True), ("before", False), ("before", True))


def orientations(positions: DataFrame, sizes: DataFrame, pairs: DataFrame, advantage: float = 5.0) -> DataFrame:
    """line, neighbour, side, reversed, score, margin: how each neighbour fits beside its line best.

    positions: line, barcode, pos. sizes: line, length. pairs: line, neighbour. Each of the four ways is scored by
    the steps that barcodes take across the seam (windows.order_score; low is good); the best must lead the second
    by ``advantage``.
    """
    ways = F.array(*[F.struct(F.lit(side).alias("side"), F.lit(turned).alias("reversed")) for side, turned in HYPOTHESES])
    asked = pairs.withColumn("way", F.explode(ways))
    named = asked.join(sizes.select("line", F.col("length").alias("own")), "line").join(sizes.select(F.col("line").alias("neighbour"), F.col("length").alias("other")), "neighbour")
    ordering = F.struct("line", "neighbour", F.col("way.side").alias("side"), F.col("way.reversed").alias("reversed")).alias("ordering")
    after = F.col("way.side") == "after"
    mine = named.join(positions, "line").select(ordering, "barcode", F.when(after, F.col("pos")).otherwise(F.col("other") + F.col("pos")).alias("pos"), F.when(after, 0).otherwise(1).alias("line_index"))
    turned = F.when(F.col("way.reversed"), F.col("other") - F.col("pos") - 1).otherwise(F.col("pos"))
    theirs = named.join(positions.withColumnRenamed("line", "neighbour"), "neighbour").select(
        ordering, "barcode", F.when(after, F.col("own") + turned).otherwise(turned).alias("pos"), F.when(after, 1).otherwise(0).alias("line_index")
    )
    scored = windows.order_score(mine.unionByName(theirs)).select("ordering.*", "score")
    place = Window.partitionBy("line", "neighbour").orderBy("score", "side", "reversed")
    ranked = scored.withColumns({"r": F.row_number().over(place), "margin": F.lead("score").over(place) - F.col("score")})
    return ranked.where((F.col("r") == 1) & (F.col("margin") >= advantage)).drop("r")


def star_candidates(neighbours: DataFrame, facts: DataFrame, least: int = 2000, long: int = 5000, copies: float = 0.5, most: int = 10) -> DataFrame:
    """line, neighbour: up to ``most`` neighbours of each long line, of like copy number and not too short.

    neighbours: owner, neighbour, common. facts: line, length, copies.
    """
    own = facts.where(F.col("length") >= long).select(F.col("line").alias("owner"), F.col("copies").alias("c1"))
    other = facts.where(F.col("length") >= least).select(F.col("line").alias("neighbour"), F.col("copies").alias("c2"))
    rows = neighbours.join(own, "owner").join(other, "neighbour").where(F.abs(F.col("c1") - F.col("c2")) <= copies)
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("owner").orderBy(F.desc("common"), "neighbour")))
    return ranked.where(F.col("r") <= most).select(F.col("owner").alias("line"), "neighbour")


def next_lines(oriented: DataFrame, facts: DataFrame, most: int = 6) -> DataFrame:
    """line, neighbour, reversed: of the ``most`` longest neighbours after each line, the one that fits best.

    oriented: as ``orientations`` gives it. facts: line, length.
    """
    sizes = facts.select(F.col("line").alias("neighbour"), "length")
    longest = Window.partitionBy("line").orderBy(F.desc("length"), "neighbour")
    kept = oriented.where("side = 'after'").join(sizes, "neighbour").withColumn("r", F.row_number().over(longest)).where(F.col("r") <= most)
    best = kept.groupBy("line").agg(F.min(F.struct("score", "neighbour", "reversed")).alias("b"))
    return best.select("line", "b.neighbour", "b.reversed")


def weak_tips(edges: DataFrame, support: DataFrame, most: int = 300, least_reads: int = 2, ratio: float = 5.0) -> DataFrame:
    """Tips to mow: of two edges into one node, the shorter dead end with few reads of low quality.

    edges: edge, a, b, length. support: edge, reads, quality. The tip has no way in, at most ``most`` k-mers and
    ``least_reads`` reads, and the other edge has ``ratio`` times its quality.
    """
    starts = graph.sources(edges).withColumnRenamed("node", "a")
    rows = edges.join(support, "edge", "left").na.fill(0, ["reads", "quality"])
    other = rows.groupBy("b").agg(F.count("*").alias("n"), F.max("quality").alias("best")).where("n = 2")
    tips = rows.join(starts, "a", "left_semi").join(other, "b")
    return tips.where((F.col("length") <= most) & (F.col("reads") <= least_reads) & (F.col("best") >= ratio * F.greatest(F.lit(1), F.col("quality")))).select("edge")


def separations(mates: DataFrame, libraries: DataFrame) -> DataFrame:
    """a, b, gap, sd, pairs: gaps between contigs from pairs of libraries with known separation.

    mates: a, b, library, distance (what both reads have to the ends that face each other). libraries: library,
    separation, sd. Measurements are weighted by inverse variance.
    """
    rows = mates.join(libraries, "library").withColumns({"g": F.col("separation") - F.col("distance"), "w": 1 / (F.col("sd") * F.col("sd"))})
    return rows.groupBy("a", "b").agg((F.sum(F.col("g") * F.col("w")) / F.sum("w")).alias("gap"), F.sqrt(1 / F.sum("w")).alias("sd"), F.count("*").alias("pairs"))


def library_statistics(pairs: DataFrame) -> DataFrame:
    """library, pairs, separation, sd from measured pairs (library, separation)."""
    return pairs.groupBy("library").agg(F.count("*").alias("pairs"), F.avg("separation").alias("separation"), F.stddev_pop("separation").alias("sd"))


def read_links(runs: DataFrame) -> DataFrame:
    """a, b, support: contigs that follow each other along long reads. runs: read_id, node, contig_id, reverse."""
    order = Window.partitionBy("read_id").orderBy("node")
    rows = runs.withColumn("next", F.lead("contig_id").over(order)).where("next is not null")
    a, b = F.when(F.col("reverse"), F.col("next")).otherwise(F.col("contig_id")), F.when(F.col("reverse"), F.col("contig_id")).otherwise(F.col("next"))
    return rows.select(a.alias("a"), b.alias("b"), "read_id").groupBy("a", "b").agg(F.count_distinct("read_id").alias("support"))


# What an edge of the super-graph may be: a path, or a gap of one of four kinds, told by a negative first number.
GAP_KINDS = {"pair": -1, "barcode": -2, "sequence": -3, "cell": -4}


def decoded(edges: DataFrame, column: str = "e") -> DataFrame:
    """kind, path, gap, ltrim, rtrim of edges stored as arrays of numbers.

    A first number from 0 is a path. -1: a gap between pairs; -2: one that only barcodes bridge, with a size if a
    second number follows; -3: an inline sequence with what it trims left and right; -4: a cell.
    """
    first = F.get(F.col(column), 0)
    kind = F.when(first.isNull() | (first >= 0), "path")
    for name, number in GAP_KINDS.items():
        kind = kind.when(first == number, name)
    part = lambda i, *kinds: F.when(F.col("kind").isin(*kinds), F.get(F.col(column), i))
    rows = edges.withColumn("kind", kind)
    return rows.withColumns({"path": F.when(F.col("kind") == "path", F.col(column)), "gap": part(1, "barcode"), "ltrim": part(1, "sequence"), "rtrim": part(2, "sequence")})


def check_graph(edges: DataFrame) -> dict[str, int]:
    """What is wrong with a graph whose edges know their other strand (edge, a, b, length, rc): counts by fault."""
    e, f = edges.alias("e"), edges.alias("f")
    pairs = e.join(f, F.col("e.rc") == F.col("f.edge"), "left")
    row = pairs.agg(
        F.count_if(F.col("f.edge").isNull()).alias("missing_strand"),
        F.count_if(F.col("f.rc") != F.col("e.edge")).alias("not_mutual"),
        F.count_if(F.col("f.length") != F.col("e.length")).alias("unequal_length"),
        F.count_if(F.col("e.length") <= 0).alias("empty"),
    ).first()
    doubled = edges.groupBy("edge").agg(F.count("*").alias("n")).where("n > 1").count()
    return row.asDict() | {"repeated_id": doubled}


def checksum(rows: DataFrame) -> int:
    """A number that is the same for the same rows in any order."""
    return int(rows.agg(F.sum(F.xxhash64(*rows.columns).cast("decimal(20,0)"))).first()[0] or 0)
