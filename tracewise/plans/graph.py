"""Dependency-graph operators on ``edges(src, dst)`` DataFrames (GRA1-5,
RCA7, VIZ4).

Iterative algorithms run one Spark job per round on distributed joins; the
driver sees only one scalar per round (the stopping test).  Lineage is cut
with a reliable ``checkpoint`` into the cluster's checkpoint folder every few
rounds so a lost executor recomputes at most a few rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.session import cut_lineage

CHECKPOINT_EVERY = 5


def vertices(edges: DataFrame) -> DataFrame:
    """SET1 / GRA1: distinct endpoints of the edges."""
    return edges.select(F.col("src").alias("id")).union(edges.select("dst")).distinct()


def degrees(edges: DataFrame) -> DataFrame:
    """AGG14: in- and out-degree per vertex."""
    v = vertices(edges)
    ind = edges.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("in_degree"))
    outd = edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("out_degree"))
    return (v.join(ind, "id", "left").join(outd, "id", "left")
            .fillna(0, subset=["in_degree", "out_degree"]))


def neighbours(edges: DataFrame, node: str, direction: str = "out") -> DataFrame:
    """GRA5: successors (``out``) or predecessors (``in``) of one node."""
    if direction == "out":
        return edges.filter(F.col("src") == node).select(F.col("dst").alias("id")).distinct()
    return edges.filter(F.col("dst") == node).select(F.col("src").alias("id")).distinct()


def pagerank(edges: DataFrame, alpha: float = 0.85, max_iter: int = 100, tol: float = 1e-6) -> DataFrame:
    """GRA2: PageRank, unweighted, dangling mass spread evenly, stop when
    the L1 change is below ``N * tol``; raises if that is not reached."""
    e = edges.select("src", "dst").distinct()
    deg = degrees(e).select("id", "out_degree")
    n = deg.count()
    if n == 0:
        return deg.select("id", F.lit(0.0).alias("pagerank"))
    ranks = cut_lineage(deg.select("id", "out_degree", F.lit(1.0 / n).alias("pr")))
    dangling = ranks.filter(F.col("out_degree") == 0).select(F.coalesce(F.sum("pr"), F.lit(0.0))).first()[0]
    for i in range(max_iter):
        contrib = (e.join(ranks.select(F.col("id").alias("src"), "pr", "out_degree"), "src")
                   .groupBy(F.col("dst").alias("id"))
                   .agg(F.sum(F.col("pr") / F.col("out_degree")).alias("c")))
        base = (alpha * dangling + (1.0 - alpha)) / n
        new = (ranks.join(contrib, "id", "left")
               .select("id", "out_degree", F.col("pr").alias("old"),
                       (F.lit(alpha) * F.coalesce("c", F.lit(0.0)) + F.lit(base)).alias("pr")))
        if (i + 1) % CHECKPOINT_EVERY == 0:
            new = cut_lineage(new)
        # one job per round: the change and the next round's dangling mass
        stats = new.select(F.sum(F.abs(F.col("pr") - F.col("old"))).alias("err"),
                           F.coalesce(F.sum(F.when(F.col("out_degree") == 0, F.col("pr"))), F.lit(0.0))
                           .alias("dangling")).first()
        ranks = new.drop("old")
        dangling = stats["dangling"]
        if stats["err"] < n * tol:
            break
    else:
        raise ArithmeticError(f"PageRank did not converge in {max_iter} rounds")
    return ranks.select("id", F.col("pr").alias("pagerank"))


def topological_layers(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """GRA3 helper: peel vertices with no incoming edge from the remaining
    graph, layer by layer.  Returns (layers(id, layer), remaining edges);
    remaining edges are non-empty exactly when the graph has a cycle.

    ``layer`` is the length of the longest path from a source to the vertex.
    """
    e = edges.select("src", "dst").distinct()
    remaining_v = vertices(e)
    layers = None
    layer = 0
    while True:
        peel = remaining_v.join(e.select(F.col("dst").alias("id")), "id", "left_anti")
        peel = cut_lineage(peel.withColumn("layer", F.lit(layer)))
        if peel.isEmpty():
            break
        layers = peel if layers is None else layers.unionByName(peel)
        remaining_v = remaining_v.join(peel, "id", "left_anti")
        e = e.join(peel.select(F.col("id").alias("src")), "src", "left_anti")
        if layer % CHECKPOINT_EVERY == 0:
            remaining_v, e = cut_lineage(remaining_v), cut_lineage(e)
        layer += 1
    if layers is None:
        layers = remaining_v.select("id", F.lit(0).alias("layer")).limit(0)
    return layers, e


def is_acyclic(edges: DataFrame) -> bool:
    """GRA3: directed acyclicity test."""
    _, rest = topological_layers(edges)
    return rest.isEmpty()


def _trim(v: DataFrame, e: DataFrame) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Peel vertices without incoming or without outgoing edges until every
    vertex has both; the peeled ones are components of their own."""
    alone = []
    while True:
        out = v.join(e.select(F.col("src").alias("id")).distinct(), "id", "left_anti")
        into = v.join(e.select(F.col("dst").alias("id")).distinct(), "id", "left_anti")
        gone = cut_lineage(out.union(into).distinct())
        if gone.isEmpty():
            return v, e, alone
        alone.append(gone)
        v = cut_lineage(v.join(gone, "id", "left_anti"))
        e = cut_lineage(e.join(gone.select(F.col("id").alias("src")), "src", "left_anti")
                        .join(gone.select(F.col("id").alias("dst")), "dst", "left_anti"))


def _colours(v: DataFrame, e: DataFrame) -> DataFrame:
    """(id, colour): the largest vertex from which a vertex can be reached."""
    now = cut_lineage(v.select("id", F.col("id").alias("colour")))
    while True:
        sent = e.join(now.select(F.col("id").alias("src"), "colour"), "src") \
            .groupBy(F.col("dst").alias("id")).agg(F.max("colour").alias("got"))
        new = cut_lineage(now.join(sent, "id", "left").select(
            "id", F.greatest("colour", "got").alias("colour"), F.coalesce(F.col("got") > F.col("colour"), F.lit(False))
            .alias("moved")))
        now = new.select("id", "colour")
        if new.filter("moved").isEmpty():
            return now


def strong_components(edges: DataFrame) -> DataFrame:
    """GRA3/GRA4: (id, component, size) of every vertex; the component is its
    smallest member.  Vertices on no cycle are trimmed first.  Then, round by
    round, the largest ancestor colours every vertex; of each colour, the vertices
    that reach the vertex the colour is named after form a component with it
    and leave.  Self-loops do not count."""
    e = cut_lineage(edges.select("src", "dst").where("src <> dst").distinct())
    v = cut_lineage(vertices(edges))
    found = []
    while not v.isEmpty():
        v, e, alone = _trim(v, e)
        found += [x.select("id", F.col("id").alias("name")) for x in alone]
        if v.isEmpty():
            break
        colour = _colours(v, e)
        # edges inside a colour, backwards
        back = cut_lineage(e.join(colour.select(F.col("id").alias("src"), F.col("colour").alias("cs")), "src")
                           .join(colour.select(F.col("id").alias("dst"), F.col("colour").alias("cd")), "dst")
                           .where("cs = cd").select("src", "dst"))
        front = cut_lineage(colour.where("id = colour"))
        reached = front
        while not front.isEmpty():
            nxt = back.join(front.select(F.col("id").alias("dst"), "colour"), "dst") \
                .select(F.col("src").alias("id"), "colour").distinct()
            front = cut_lineage(nxt.join(reached.select("id"), "id", "left_anti"))
            reached = cut_lineage(reached.union(front))
        found.append(reached.select("id", F.col("colour").alias("name")))
        gone = reached.select("id")
        v = cut_lineage(v.join(gone, "id", "left_anti"))
        e = cut_lineage(e.join(gone.select(F.col("id").alias("src")), "src", "left_anti")
                        .join(gone.select(F.col("id").alias("dst")), "dst", "left_anti"))
    if not found:
        return v.select("id", F.col("id").alias("component"), F.lit(1).cast("long").alias("size"))
    named = found[0]
    for x in found[1:]:
        named = named.union(x)
    named = cut_lineage(named)
    sizes = named.groupBy("name").agg(F.min("id").alias("component"), F.count(F.lit(1)).alias("size"))
    return named.join(sizes, "name").select("id", "component", "size")


def cycle_members(edges: DataFrame) -> DataFrame:
    """GRA4's cycle report: (component, id) of the vertices that lie on cycles,
    by strongly connected component; empty for a DAG.  A self-loop is a cycle."""
    loops = edges.where("src = dst").select(F.col("src").alias("id")).distinct().withColumn("_loop", F.lit(True))
    return strong_components(edges).join(loops, "id", "left").where("size > 1 OR _loop").select("component", "id")


def longest_path(edges: DataFrame) -> DataFrame:
    """GRA4: one longest path of a DAG (unit edge length) as rows
    (pos, id); empty when the graph has a cycle.

    The path ends at the vertex with the deepest layer (ties: smallest
    name) and walks back through a predecessor one layer up (ties: largest
    name).
    """
    layers, rest = topological_layers(edges)
    if not rest.isEmpty():
        return layers.sparkSession.createDataFrame([], "pos int, id string")
    e = edges.select("src", "dst").distinct()
    lay = cut_lineage(layers)
    end = lay.orderBy(F.col("layer").desc(), F.col("id")).limit(1)
    path = end.select(F.col("layer").alias("pos"), "id")
    cur = end
    acc = path
    while True:
        prev = (e.join(cur.select(F.col("id").alias("dst"), F.col("layer").alias("cl")), "dst")
                .join(lay.select(F.col("id").alias("src"), F.col("layer").alias("pl")), "src")
                .filter(F.col("pl") == F.col("cl") - 1)
                .orderBy(F.col("src").desc()).limit(1)
                .select(F.col("src").alias("id"), F.col("pl").alias("layer")))
        prev = cut_lineage(prev)
        if prev.isEmpty():
            break
        acc = acc.unionByName(prev.select(F.col("layer").alias("pos"), "id"))
        cur = prev
    return acc


def downstream_root_cause(anomalous: DataFrame, edges: DataFrame) -> DataFrame:
    """RCA7: anomalous services none of whose callees is anomalous (leaves
    included); among several, the one with most callers; none -> 'Not Found'.

    ``anomalous(id)``, ``edges(src=caller, dst=callee)``.  One row
    ``root_cause``.
    """
    anom = anomalous.select("id").distinct()
    sick_edges = (edges.join(anom.select(F.col("id").alias("dst")), "dst", "left_semi")
                  .select(F.col("src").alias("id")))
    cands = anom.join(sick_edges, "id", "left_anti")
    indeg = edges.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("in_degree"))
    ranked = (cands.join(indeg, "id", "left").fillna(0, subset=["in_degree"])
              .select(F.col("id").alias("root_cause"), "in_degree", F.lit(1).alias("_found")))
    fallback = anomalous.sparkSession.range(1).select(
        F.lit("Not Found").alias("root_cause"), F.lit(0).cast("long").alias("in_degree"),
        F.lit(0).alias("_found"))
    return (ranked.unionByName(fallback)
            .orderBy(F.col("_found").desc(), F.col("in_degree").desc(), F.col("root_cause"))
            .limit(1).select("root_cause"))


def graph_labels(anomalous: DataFrame, edges: DataFrame, root: DataFrame) -> DataFrame:
    """VIZ4: per vertex status root / symptom / normal."""
    v = vertices(edges).unionByName(anomalous.select("id")).distinct()
    a = anomalous.select("id", F.lit(True).alias("_a")).distinct()
    r = root.select(F.col("root_cause").alias("id"), F.lit(True).alias("_r"))
    return (v.join(a, "id", "left").join(r, "id", "left")
            .select("id", F.when(F.col("_r"), "root").when(F.col("_a"), "symptom")
                    .otherwise("normal").alias("status")))


def graph_edge_widths(edges: DataFrame, weight: str = "r") -> DataFrame:
    """VIZ4: (src, dst, label, width): ``Corr=0.85`` and five times the weight."""
    w = F.round(F.round(weight, 8), 2)
    return edges.select("src", "dst", F.concat(F.lit("Corr="), F.format_string("%.2f", w)).alias("label"),
                        (F.col(weight) * 5).alias("width"))
