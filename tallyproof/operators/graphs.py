"""Task and plan graphs as node and edge frames (edges run from ``src`` to ``dst``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyproof.plans.storage import written


def issues(nodes: DataFrame, edges: DataFrame, key: str = "id") -> DataFrame:
    """(kind, id): edges to unknown nodes, nodes declared twice, nodes with several parents."""
    known = nodes.select(F.col(key).alias("id"))
    ends = edges.select(F.col("dst").alias("id")).unionByName(edges.select(F.col("src").alias("id"))).distinct()
    dangling = ends.join(known, "id", "left_anti").select(F.lit("dangling").alias("kind"), "id")
    twice = known.groupBy("id").count().filter("count > 1").select(F.lit("duplicate").alias("kind"), "id")
    many = edges.select("src", "dst").distinct().groupBy(F.col("dst").alias("id")).count().filter("count > 1").select(F.lit("multi_parent").alias("kind"), "id")
    return dangling.unionByName(twice).unionByName(many)


def blocks_mismatch(blocks: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, declared, derived): tasks whose declared list of blocked tasks is not what edges say; an empty list declares nothing."""
    said = blocks.filter(F.size("blocks") > 0).select("id", F.sort_array("blocks").alias("declared"))
    derived = edges.select(F.col("src").alias("id"), "dst").distinct().groupBy("id").agg(F.sort_array(F.collect_list("dst")).alias("derived"))
    none = F.array().cast("array<string>")
    return said.join(derived, "id", "left").withColumn("derived", F.coalesce("derived", none)).filter("declared <> derived")


def _paths(edges: DataFrame, longest: bool = False) -> DataFrame:
    """(src, dst, depth) of all pairs joined by a path with its least, or in acyclic graphs greatest, number of steps.

    Paths are joined to paths, so each round doubles the steps that are covered and n steps take log2(n) rounds; pairs
    are kept once, however many paths join them.
    """
    pick = F.max if longest else F.min
    found = written(edges.select("src", "dst", F.lit(1).alias("depth")).distinct(), "paths")
    n = -1
    while True:
        one, two = found.alias("p"), found.alias("q")
        longer = one.join(two, F.col("p.dst") == F.col("q.src")).select(F.col("p.src").alias("src"), F.col("q.dst").alias("dst"), (F.col("p.depth") + F.col("q.depth")).alias("depth"))
        after = written(found.unionByName(longer).groupBy("src", "dst").agg(pick("depth").alias("depth")), "paths")
        now = tuple(after.agg(F.count(F.lit(1)), F.sum("depth")).first())
        if now == n:
            return after
        found, n = after, now


def closure(edges: DataFrame) -> DataFrame:
    """(src, dst, depth) of all pairs joined by a path, with the least number of steps; cycles included."""
    return _paths(edges)


def cyclic(edges: DataFrame) -> DataFrame:
    """Nodes that reach themselves."""
    return closure(edges).filter("src = dst").select(F.col("src").alias("id")).distinct()


def cycles(edges: DataFrame, most: int = 100_000) -> list[list[str]]:
    """The cycles that a depth-first walk in order of names closes, each from its first node back to it.

    Only edges between nodes that reach themselves come to the driver; more than ``most`` of them are refused.
    """
    on = cyclic(edges)
    rows = edges.join(on.select(F.col("id").alias("src")), "src", "left_semi").join(on.select(F.col("id").alias("dst")), "dst", "left_semi").select("src", "dst").distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} edges on cycles")
    ahead: dict[str, list[str]] = {}
    for r in sorted(rows):
        ahead.setdefault(r["src"], []).append(r["dst"])
    found: list[list[str]] = []
    done: set[str] = set()
    for root in sorted(ahead):
        path, at, walk = [root], {root: 0}, [iter(ahead[root])]
        while walk and root not in done:
            step = next(walk[-1], None)
            if step is None:
                walk.pop()
                last = path.pop()
                del at[last]
                done.add(last)
            elif step in at:
                if (cycle := [*path[at[step] :], step]) not in found:
                    found.append(cycle)
            elif step not in done:
                at[step] = len(path)
                path.append(step)
                walk.append(iter(ahead.get(step, [])))
    return found


def _acyclic(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes neither on nor behind a cycle, and the edges between them."""
    reach = closure(edges)
    on = reach.filter("src = dst").select("src").distinct()
    off = on.select(F.col("src").alias("id")).unionByName(reach.join(on, "src", "left_semi").select(F.col("dst").alias("id"))).distinct()
    kept = nodes.select("id").distinct().join(off, "id", "left_anti")
    inner = edges.join(off.select(F.col("id").alias("dst")), "dst", "left_anti").join(off.select(F.col("id").alias("src")), "src", "left_anti").select("src", "dst").distinct()
    return kept, inner


def levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, level): steps of the longest path to a node; nodes on or behind a cycle have no level and no row."""
    kept, inner = _acyclic(nodes, edges)
    deepest = _paths(inner, longest=True).groupBy(F.col("dst").alias("id")).agg(F.max("depth").alias("level"))
    return kept.join(deepest, "id", "left").select("id", F.coalesce("level", F.lit(0)).alias("level"))


def topological(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, level, place): nodes by level and then name; nodes on or behind a cycle have no level and come last."""
    found = nodes.select("id").distinct().join(levels(nodes, edges), "id", "left")
    return found.withColumn("place", F.row_number().over(Window.orderBy(F.col("level").asc_nulls_last(), "id")))


def critical_path_length(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    return levels(nodes, edges).agg((F.max("level") + 1).alias("steps"))


def critical_path(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(place, id) of the longest path, of several the one whose names come last.

    Nodes on a longest path have as many steps before them as places, and enough behind them.
    """
    kept, inner = _acyclic(nodes, edges)
    paths = written(_paths(inner, longest=True), "paths")
    before = paths.groupBy(F.col("dst").alias("id")).agg(F.max("depth").alias("before"))
    behind = paths.groupBy(F.col("src").alias("id")).agg(F.max("depth").alias("behind"))
    rated = kept.join(before, "id", "left").join(behind, "id", "left").fillna(0, ["before", "behind"])
    whole = rated.agg(F.max(F.col("before") + F.col("behind")).alias("whole"))
    on = rated.crossJoin(F.broadcast(whole)).filter("before + behind = whole").select("id", "before")  # the other side is one number
    steps = {r["before"]: [] for r in on.select("before").distinct().collect()}
    for r in on.collect():
        steps[r["before"]].append(r["id"])
    links = {(r["src"], r["dst"]) for r in inner.join(on.select(F.col("id").alias("src")), "src", "left_semi").join(on.select(F.col("id").alias("dst")), "dst", "left_semi").collect()}
    # walks on the longest paths only: a plan's few tasks
    best: dict[str, list[str]] = {}
    for place in sorted(steps):
        for node in steps[place]:
            paths_to = [best[x] for x in steps.get(place - 1, []) if (x, node) in links]
            best[node] = [*max(paths_to, default=[]), node]
    chosen = max((best[x] for x in steps.get(max(steps, default=0), [])), default=[])
    return nodes.sparkSession.createDataFrame(list(enumerate(chosen)), "place int, id string")


def frontier(tasks: DataFrame, edges: DataFrame) -> DataFrame:
    """Each open task with the dependencies that are not done; ready when there are none.

    An edge runs from a dependency to the task that needs it.
    """
    needs = edges.select(F.col("dst").alias("id"), F.col("src").alias("need")).distinct().join(tasks.select(F.col("id").alias("need"), F.col("status").alias("need_status")), "need", "left")
    blocked = needs.filter(F.coalesce(F.col("need_status") != "done", F.lit(True))).groupBy("id").agg(F.sort_array(F.collect_list(F.concat_ws(":", "need", F.coalesce("need_status", F.lit("missing"))))).alias("blocked_by"))
    return tasks.filter("status = 'open'").join(blocked, "id", "left").select("id", F.coalesce("blocked_by", F.array().cast("array<string>")).alias("blocked_by"), F.col("blocked_by").isNull().alias("ready"))


def frontier_reasons(tasks: DataFrame, edges: DataFrame, writes: DataFrame | None = None) -> DataFrame:
    """(id, ready, reasons) of every task (id, status, effort, supersedes).

    Reasons, in this order: a status other than ready; an effort of XL or XXL, which is a composition; a dependency that is missing,
    not done, or superseded; a write conflict with a task in progress; a dependency cycle through the task.
    """
    known = tasks.select(F.col("id").alias("need"), F.col("status").alias("need_status"))
    replaced = tasks.filter("supersedes is not null").select(F.col("supersedes").alias("need")).distinct().withColumn("replaced", F.lit(True))
    needs = edges.select(F.col("dst").alias("id"), F.col("src").alias("need")).distinct().join(known, "need", "left").join(replaced, "need", "left")
    reason = lambda rows, rank, text, by=F.lit(""): rows.select("id", F.lit(rank).alias("rank"), by.alias("by"), text.alias("reason"))
    found = reason(tasks.filter("status <> 'ready'"), 0, F.concat(F.lit("status:"), F.col("status")))
    found = found.unionByName(reason(tasks.filter("effort in ('XL', 'XXL')"), 1, F.lit("composition-node")))
    need = F.col("need")
    found = found.unionByName(reason(needs.filter("need_status is null"), 2, F.concat(F.lit("missing:"), need), F.concat(need, F.lit("0"))))
    found = found.unionByName(reason(needs.filter("need_status <> 'done'"), 2, F.concat(F.lit("unmet:"), need, F.lit(":"), F.col("need_status")), F.concat(need, F.lit("0"))))
    found = found.unionByName(reason(needs.filter("replaced"), 2, F.concat(F.lit("stale-superseded:"), need), F.concat(need, F.lit("1"))))
    if writes is not None:
        pairs = path_conflicts(writes)
        both = pairs.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("id"), F.col("a").alias("other")))
        busy = tasks.filter("status = 'in-progress'").select(F.col("id").alias("other"))
        found = found.unionByName(reason(both.join(busy, "other", "left_semi"), 3, F.concat(F.lit("write-conflict:"), F.col("other"), F.lit(":in-progress")), F.col("other")))
    found = found.unionByName(reason(cyclic(edges), 4, F.lit("dependency-cycle")))
    listed = found.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("rank", "by", "reason"))).alias("r")).select("id", F.col("r.reason").alias("reasons"))
    return tasks.select("id").distinct().join(listed, "id", "left").select("id", F.col("reasons").isNull().alias("ready"), F.coalesce("reasons", F.array().cast("array<string>")).alias("reasons"))


def eligible(ready: DataFrame, tasks: DataFrame) -> DataFrame:
    """(id, eligible, blockers) of a ready frontier against its tasks (id, effort, lifecycle, tier, verification, stale).

    A candidate is kept back if it is unknown, a composition, not in a ready lifecycle, or without a verified, fresh authorization of tier 1.
    """
    rows = ready.select("id").join(tasks.withColumn("_there", F.lit(True)), "id", "left")
    there = F.coalesce("_there", F.lit(False))
    blockers = F.array(
        F.when(~there, "GRAPH_NODE_MISSING"),
        F.when(there & F.col("effort").isin("XL", "XXL"), "COMPOSITION_NODE"),
        F.when(there & F.col("lifecycle").isNull(), "STATUS_UNAVAILABLE"),
        F.when(there & (F.col("lifecycle") != "ready"), "NOT_READY"),
        F.when(there & F.col("lifecycle").isNotNull() & ~F.coalesce((F.col("tier") == 1) & (F.col("verification") == "verified") & ~F.col("stale"), F.lit(False)), "AUTHORIZATION_NOT_TIER1"),
    )
    listed = rows.select("id", F.array_compact(blockers).alias("blockers"))
    return listed.select("id", (F.size("blockers") == 0).alias("eligible"), "blockers")


def path_conflicts(writes: DataFrame, key: str = "id", path: str = "path") -> DataFrame:
    """Pairs of tasks (a < b) whose written paths overlap.

    Each path is joined to its own parent folders by equality, not pairwise:
    overlap means that one path is a prefix folder of the other.
    """
    rows = writes.select(F.col(key).alias("k"), F.col(path).alias("p")).distinct()
    up = rows.select("k", "p", F.explode(F.transform(F.sequence(F.lit(1), F.size(F.split("p", "/"))), lambda n: F.array_join(F.slice(F.split("p", "/"), 1, n), "/"))).alias("folder"))
    held = rows.select(F.col("k").alias("other"), F.col("p").alias("folder"))
    return up.join(held, "folder").filter("k <> other").select(F.least("k", "other").alias("a"), F.greatest("k", "other").alias("b")).distinct()


def unordered_conflicts(writes: DataFrame, edges: DataFrame) -> DataFrame:
    """Conflicting pairs that no path puts in order."""
    reach = closure(edges)
    ordered = reach.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()
    return path_conflicts(writes).join(ordered, ["a", "b"], "left_anti")


def disjoint_groups(tasks: list[tuple[str, list[str]]]) -> list[list[str]]:
    """Greedy groups of tasks that write disjoint paths, in the given order; a plan's few tasks, on the driver."""
    groups: list[tuple[list[str], list[str]]] = []
    inside = lambda a, b: a == b or a.startswith(b + "/") or b.startswith(a + "/")
    for name, paths in tasks:
        for names, taken in groups:
            if not any(inside(p, q) for p in paths for q in taken):
                names.append(name)
                taken.extend(paths)
                break
        else:
            groups.append(([name], list(paths)))
    return [names for names, _ in groups]


def requirement_producers(requires: DataFrame, produces: DataFrame) -> DataFrame:
    """Requirements (task, artifact) without exactly one producer, with their number."""
    counted = produces.groupBy("artifact").agg(F.countDistinct("task").alias("producers"))
    return requires.join(counted, "artifact", "left").withColumn("producers", F.coalesce("producers", F.lit(0))).filter("producers <> 1")


