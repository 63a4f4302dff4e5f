"""Judges must go red on planted errors; reconciliation keeps its null rules; graphs and ledgers keep theirs."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyproof.operators import assertions, controls, graphs, ledger, medallion, profile, reconcile, referee, search

D = Decimal


def money(spark, rows, schema="id string, name string, amount decimal(18,2)"):
    return spark.createDataFrame(rows, schema)


BASE = [("a", "x", D("10.00")), ("b", "y", D("-0.01")), ("c", None, D("3.10"))]


def diff(spark, actual, expected=BASE):
    found = referee.record_diff(money(spark, actual), money(spark, expected), ["id"], ["name", "amount"], ("amount",))
    return sorted((r.id, r.field, r.actual, r.expected) for r in found.collect())


def test_equal_records_match(spark):
    assert diff(spark, BASE) == []
    assert diff(spark, [("a", " x ", D("10.00")), ("b", "y", D("-0.01")), ("c", "", D("3.10"))]) == []


@pytest.mark.parametrize(
    ("change", "want"),
    [
        ([("a", "x", D("10.01")), *BASE[1:]], [("a", "amount", "10.01", "10")]),
        ([("a", "x", D("9.99")), *BASE[1:]], [("a", "amount", "9.99", "10")]),
        (BASE[1:], [("a", "(record)", "absent", "present")]),
        ([*BASE, ("d", "z", D("1.00"))], [("d", "(record)", "present", "absent")]),
        ([("a", "X", D("10.00")), *BASE[1:]], [("a", "name", "X", "x")]),
        ([BASE[0], ("b", "y", D("0.01")), BASE[2]], [("b", "amount", "0.01", "-0.01")]),
    ],
)
def test_a_planted_error_is_found(spark, change, want):
    assert diff(spark, change) == want


def test_classification_order(spark):
    cases = [(c, r, s, a) for c in (True, False) for r in (True, False) for s in (True, False) for a in (True, False)]
    df = spark.createDataFrame(cases, "c boolean, r boolean, s boolean, a boolean")
    got = df.select("*", referee.classify(F.col("c"), F.col("r"), F.col("s"), F.col("a")).alias("k")).collect()
    for x in got:
        want = "APPROVED_BEHAVIOR_CHANGE" if x.a else "CONFIRMED_SOURCE_DEFECT" if x.s else "CONFIRMED_LEGACY_DEFECT" if x.c and not x.r else "MODERN_DEFECT" if not x.c else "UNRESOLVED"
        assert x.k == want


def test_status(spark):
    rows = lambda *k: spark.createDataFrame([(x,) for x in k], "classification string")
    assert referee.status(rows()).first().status == "MATCHED"
    assert referee.status(rows("APPROVED_BEHAVIOR_CHANGE")).first().status == "RESOLVED"
    assert referee.status(rows("APPROVED_BEHAVIOR_CHANGE", "UNRESOLVED")).first().status == "STALLED"


def lines(spark, amounts, batch="B1"):
    return spark.createDataFrame([(batch, D(a)) for a in amounts], "batch_id string, amount_brl decimal(18,2)")


def test_gold_verdicts(spark):
    control = spark.createDataFrame([("B1", 2, D("3.00")), ("B2", 1, D("1.00"))], "batch_id string, source_count int, source_net_amount decimal(18,2)")
    good = medallion.gold("01", control, lines(spark, ["1.00", "2.00"]), lines(spark, ["1.00", "2.00"])).collect()
    assert [(r.batch_id, r.status, r.net_amount_delta) for r in good] == [("B1", "MATCHED", D("0.00"))]  # a control without rows is not in gold
    bad = medallion.gold("01", control, lines(spark, ["1.00", "2.00"]), lines(spark, ["1.00", "2.01"])).first()
    assert (bad.status, bad.net_amount_delta) == ("MISMATCHED", D("0.01"))
    null = control.withColumn("source_net_amount", F.lit(None).cast("decimal(18,2)"))
    gold = medallion.gold("01", null, lines(spark, ["3.00"]), lines(spark, ["3.00"]))
    assert gold.first().status == "MISMATCHED" and assertions.release_gate(gold, ["net_amount_delta"]).count() == 1
    assert assertions.release_gate(gold.withColumn("status", F.lit("MATCHED")).drop("count_delta"), ["net_amount_delta"]).count() == 0  # a null delta does not stop


def test_type_04_verdict_leaves_the_net_amount_out(spark):
    schema = "batch_id string, movement_kind string, amount_brl decimal(18,2)"
    rows = spark.createDataFrame([("B1", "TRANSFER", D("5.00")), ("B1", "RETURN", D("-2.00"))], schema)
    control = spark.createDataFrame([("B1", 2, D("5.00"), D("-2.00"), D("9.99"))], "batch_id string, source_count int, source_gross_amount decimal(18,2), source_returned_amount decimal(18,2), source_net_amount decimal(18,2)")
    row = medallion.gold("04", control, rows, rows).first()
    assert (row.status, row.net_amount_delta) == ("MATCHED", D("-6.99"))


def test_sets_and_upserts(spark):
    a, b = money(spark, BASE), money(spark, BASE[:2] + [("e", "n", D("1.00")), ("a", "x", D("10.00"))])
    assert sorted((r.id, r.side) for r in reconcile.symmetric_difference(a, b).collect()) == [("c", "left"), ("e", "right")]
    assert [r.id for r in reconcile.insert_missing(a, b, ["id"]).collect()] == ["e"]
    new = money(spark, [("a", None, D("1.00"))])
    assert sorted((r.id, r.name, r.amount) for r in reconcile.upsert(a, new, ["id"]).collect())[0] == ("a", None, D("1.00"))
    assert [r.id for r in reconcile.replay_differences(a, new, ["id"]).collect()] == ["a"]


def test_states(spark):
    df = spark.createDataFrame([("claimed", "committed"), ("claimed", "succeeded"), ("committed", "succeeded"), ("succeeded", "claimed")], "s string, w string")
    assert [r[0] for r in df.select(reconcile.transition(F.col("s"), F.col("w"))).collect()] == ["committed", None, "succeeded", None]


def test_controls(spark):
    df = spark.createDataFrame([("x ", D("1.00")), ("x", D("2.00")), ("", D("4.00")), ("y", None)], "code string, v decimal(18,2)")
    row = controls.controls_and_codes(df, F.col("code"), F.col("v")).first()
    assert (row.row_count, row.invalid_count, row.sum_amount, row.totals_by_code) == (4, 1, D("7.00"), {"x": "3.00"})
    assert controls.five_controls(df, F.col("v")).first().asDict() == {"row_count": 4, "invalid_count": 1, "sum_amount": D("7.00"), "min_amount": D("1.00"), "max_amount": D("4.00")}
    assert controls.five_controls(df.limit(0), F.col("v")).first().sum_amount is None


def test_running_peak(spark):
    rows = [(i, D(v)) for i, v in enumerate(["5.00", "-3.00", "4.00", "-9.00", "8.00"])]
    df = spark.createDataFrame(rows, "i int, v decimal(18,2)")
    for width in (1, 2, 10):
        row = profile.running_peak(df.repartition(3), [F.col("i")], F.col("v"), width).first()
        assert (row.total, row.peak) == (D("5.00"), D("6.00"))


EDGES = [("a", "b"), ("b", "c"), ("a", "d")]


def graph(spark, pairs):
    return spark.createDataFrame(pairs, "src string, dst string")


def test_graphs(spark):
    e = graph(spark, EDGES)
    n = spark.createDataFrame([(x,) for x in "abcd"], "id string")
    assert {(r.src, r.dst): r.depth for r in graphs.closure(e).collect()} == {("a", "b"): 1, ("a", "c"): 2, ("a", "d"): 1, ("b", "c"): 1}
    assert [(r.id, r.level) for r in graphs.topological(n, e).orderBy("place").collect()] == [("a", 0), ("b", 1), ("d", 1), ("c", 2)]
    assert graphs.critical_path_length(n, e).first().steps == 3
    loop = graph(spark, [("a", "b"), ("b", "a"), ("b", "c")])
    assert {r.id for r in graphs.cyclic(loop).collect()} == {"a", "b"}
    assert [(r.id, r.level, r.place) for r in graphs.topological(n, loop.unionByName(graph(spark, [("d", "c")]))).orderBy("place").collect()] == [("d", 0, 1), ("a", None, 2), ("b", None, 3), ("c", None, 4)]
    assert graphs.cycles(loop) == [["a", "b", "a"]] and graphs.cycles(e) == []
    two = graph(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("c", "b"), ("d", "d"), ("x", "a")])
    assert graphs.cycles(two) == [["a", "b", "c", "a"], ["b", "c", "b"], ["d", "d"]]
    assert [r.id for r in graphs.critical_path(n, e).orderBy("place").collect()] == ["a", "b", "c"]
    assert [r.id for r in graphs.critical_path(n, graph(spark, [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d")])).orderBy("place").collect()] == ["a", "c", "d"]
    declared = spark.createDataFrame([("a", ["b", "d"]), ("b", ["d"]), ("c", [])], "id string, blocks array<string>")
    assert [tuple(r) for r in graphs.blocks_mismatch(declared, e).collect()] == [("b", ["d"], ["c"])]
    assert sorted((r.kind, r.id) for r in graphs.issues(n.limit(3).unionByName(n.limit(1)), graph(spark, [*EDGES, ("c", "d"), ("a", "z")])).collect() if r.id != "d") == [("dangling", "z"), ("duplicate", "a")]
    assert graphs.disjoint_groups([("t1", ["src/a"]), ("t2", ["src"]), ("t3", ["doc"])]) == [["t1", "t3"], ["t2"]]
    writes = spark.createDataFrame([("t1", "src/a"), ("t2", "src"), ("t3", "srcs")], "id string, path string")
    assert [(r.a, r.b) for r in graphs.path_conflicts(writes).collect()] == [("t1", "t2")]
    assert graphs.unordered_conflicts(writes, graph(spark, [("t1", "t2")])).count() == 0
    tasks = spark.createDataFrame([("a", "done"), ("b", "open"), ("c", "open")], "id string, status string")
    assert {r.id: (r.ready, r.blocked_by) for r in graphs.frontier(tasks, graph(spark, [("a", "b"), ("b", "c"), ("q", "c")])).collect()} == {"b": (True, []), "c": (False, ["b:open", "q:missing"])}


def test_long_and_layered_graphs(spark):
    chain = graph(spark, [(f"n{i:03}", f"n{i + 1:03}") for i in range(80)])
    nodes = spark.createDataFrame([(f"n{i:03}",) for i in range(81)], "id string")
    assert graphs.closure(chain).count() == 81 * 80 // 2
    assert graphs.critical_path_length(nodes, chain).first().steps == 81
    layers = graph(spark, [(f"l{i}{a}", f"l{i + 1}{b}") for i in range(9) for a in range(6) for b in range(6)])
    assert graphs.closure(layers).count() == 36 * 45


def test_frontier_reasons(spark):
    rows = [("a", "done", "S", None), ("b", "ready", "S", None), ("c", "ready", "XL", None), ("d", "in-progress", "M", "a"), ("e", "ready", "S", None), ("f", "ready", "S", None), ("g", "ready", "S", None)]
    tasks = spark.createDataFrame(rows, "id string, status string, effort string, supersedes string")
    edges = graph(spark, [("a", "b"), ("b", "c"), ("zz", "c"), ("f", "g"), ("g", "f")])
    writes = spark.createDataFrame([("d", "src"), ("e", "src/x")], "id string, path string")
    got = {r.id: r.reasons for r in graphs.frontier_reasons(tasks, edges, writes).collect()}
    assert got == {"a": ["status:done"], "b": ["stale-superseded:a"], "c": ["composition-node", "unmet:b:ready", "missing:zz"], "d": ["status:in-progress"], "e": ["write-conflict:d:in-progress"], "f": ["unmet:g:ready", "dependency-cycle"], "g": ["unmet:f:ready", "dependency-cycle"]}
    assert [r.id for r in graphs.frontier_reasons(tasks.filter("id = 'b'").drop("supersedes").withColumn("supersedes", F.lit(None).cast("string")), graph(spark, [("q", "r")])).filter("ready").collect()] == ["b"]
    facts = spark.createDataFrame([("a", "S", "ready", 1, "verified", False), ("b", "XXL", "ready", 1, "verified", True), ("c", "S", None, None, None, None), ("d", "S", "draft", 2, "verified", False)], "id string, effort string, lifecycle string, tier int, verification string, stale boolean")
    ready = spark.createDataFrame([(x,) for x in "abcdz"], "id string")
    assert {r.id: (r.eligible, r.blockers) for r in graphs.eligible(ready, facts).collect()} == {"a": (True, []), "b": (False, ["COMPOSITION_NODE", "AUTHORIZATION_NOT_TIER1"]), "c": (False, ["STATUS_UNAVAILABLE"]), "d": (False, ["NOT_READY", "AUTHORIZATION_NOT_TIER1"]), "z": (False, ["GRAPH_NODE_MISSING"])}


def test_last_write_wins(spark):
    schema = "id string, n int, name string, amount decimal(18,2)"
    actual = spark.createDataFrame([("a", 1, "old", D("1.00")), ("a", 2, "x", D("10.00")), ("b", 1, "y", D("2.00"))], schema)
    wanted = spark.createDataFrame([("b", 1, "q", D("2.00")), ("b", 2, "y", D("2.00")), ("a", 1, "x", D("10.00")), ("c", 1, None, None)], schema)
    found = referee.record_diff(actual, wanted, ["id"], ["name", "amount"], ("amount",), ["n"])
    assert [(r.id, r.field) for r in referee.in_order(found, ["id"]).collect()] == [("c", "(record)")]
    numbers = spark.createDataFrame([("10", "f"), ("9", "f"), ("9", "a")], "id string, field string")
    assert [(r.id, r.field) for r in referee.in_order(numbers, ["id"], numeric=True).collect()] == [("9", "a"), ("9", "f"), ("10", "f")]
    assert [r.id for r in referee.in_order(numbers, ["id"]).collect()] == ["10", "9", "9"]


def test_scale_of_the_reference(spark):
    from tallyproof.functions import money as M

    df = spark.createDataFrame([(D("1.50"), "2.0"), (D("1.25"), "7"), (D("2.25"), "0.1"), (D("-0.01"), "0.000"), (D("3.00"), "")], "v decimal(18,2), r string")
    assert [r[0] for r in df.select(M.at_scale(F.col("v"), F.col("r"))).collect()] == ["1.5", "1", "2.2", "-0.010", "3"]


def test_status_and_failure_code(spark):
    rows = [("claimed", None), ("claimed", "X"), ("quarantined", None), ("quarantined", "X"), ("oracle_mismatch", "X"), ("succeeded", None)]
    df = spark.createDataFrame(rows, "status string, failure_code string")
    assert sorted((r.status, r.conflict) for r in assertions.status_conflicts(df).collect()) == [("claimed", "FAILURE_CODE_MISMATCH"), ("quarantined", "FAILURE_CODE_MISMATCH"), ("succeeded", "UNSAFE_INITIAL_STATUS")]
    assert [(r.status, r.failure_code) for r in assertions.status_conflicts(df, initial=False).collect()] == [("quarantined", None)]


def test_profiles(spark):
    df = spark.createDataFrame([("1", "a", "x"), ("2", "a", "x"), ("3", "b", "3"), ("4x", "c", "12")], "code string, d string, other string")
    assert sorted(r.code for r in profile.collapsed_codes(df, "code", "d").collect()) == ["1", "2"]
    assert profile.swappable(df, F.col("code"), F.col("other")).first().swappable == 3
    stats = profile.run_stats(spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.5)], "c string, v double"), "c", F.col("v"))
    assert profile.mean_delta(stats, "c", "a", "b").first().delta == -4.0
    raw = spark.createDataFrame([(f"bad{i:02}",) for i in range(30)] + [("1,25",), ("x" * 90,), (None,), ("bad00",)], "raw string")
    row = profile.grammar(raw, F.col("raw"), F.when(F.col("raw").rlike("^[0-9],[0-9]+$"), 1)).first()
    assert (row.accepted, row.refused, row.scales, row.samples) == (1, 33, [2], [f"bad{i:02}" for i in range(10)])
    assert profile.grammar(raw.limit(0), F.col("raw"), F.lit(1)).first().samples == []


def event(i, kind, entity="t1", **more):
    row = {"schema_version": "1", "event_id": f"e{i}", "project_id": "p", "kind": kind, "importance": "", "access": "", "occurred_at": f"2026-01-0{i}T00:00:00Z", "observed_at": f"2026-01-0{i}T00:00:00Z", "source": None, "method_context": None, "headline": "", "entity_refs": [entity], "evidence_ids": [], "details": None, "previous_event_hash": None, "event_hash": None}
    return row | more


def events(spark, *rows):
    names = [x.strip().split()[0] for x in "schema_version event_id project_id kind importance access occurred_at observed_at source method_context headline entity_refs evidence_ids details previous_event_hash event_hash".split()]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ledger.EVENT_SCHEMA)


def test_ledger(spark):
    df = events(
        spark, event(1, "TASK_STARTED", method_context=("m", "f", "i1", "t1", "t0")), event(2, "BLOCKER_RAISED", "x"), event(3, "TASK_STARTED", "t2"), event(4, "TASK_COMPLETED", "t2", evidence_ids=["v1"]),
        event(5, "VERIFICATION_RECORDED", "t2", evidence_ids=["v1", "v2"]), event(6, "DRIFT_RESOLVED", "x"), event(7, "DECISION_REQUESTED", details='{"decision_id":"d1"}', observed_at="2026-01-09T00:00:00Z"),
    )
    assert sorted((r.rule, r.entity) for r in ledger.drift(df, ["occurred_at"]).collect()) == [("task_not_ended", "t1")]
    assert sorted((r.src, r.relation, r.dst) for r in ledger.relations(df).collect()) == [("t1", "implements", "i1")]
    more = events(
        spark, event(1, "TASK_ACCEPTED", "x", method_context=("m", "f", None, "t9", None)), event(5, "TASK_ACCEPTED", "t8"), event(2, "EVIDENCE_ADDED", "t1", entity_refs=["t1", "t2"], evidence_ids=["v1", "v2"]), event(3, "INTENT_REVISED", "i2", details='{"supersedes":"i1"}'),
        event(4, "NOTE", details='{"relations":[{"source_ref":"a","relation":"blocked_by","target_ref":"b"},{"source_ref":"a","relation":"likes","target_ref":"b"},{"source_ref":"","relation":"verifies","target_ref":"b"}]}'),
    )
    assert sorted((r.src, r.relation, r.dst) for r in ledger.relations(more).collect()) == [("a", "blocked_by", "b"), ("i2", "supersedes", "i1"), ("t1", "verifies", "v1"), ("t1", "verifies", "v2"), ("t2", "verifies", "v1"), ("t2", "verifies", "v2"), ("t9", "accepted_by", "e1")]
    assert [(r.decision_id, r.open) for r in ledger.decisions(df).collect()] == [("d1", True)]
    row = ledger.snapshot(df).first()
    assert (row.events, row.late, row.evidence_ids) == (7, 1, ["v1", "v2"])
    assert ledger.within(df, "2026-01-02T00:00:00Z", "2026-01-04T00:00:00Z").count() == 3
    assert sorted(r.outcome for r in ledger.ingest(df.limit(2), df.limit(3)).collect()) == ["APPENDED", "DUPLICATE", "DUPLICATE"]


def test_drift_findings(spark):
    task = lambda t, method="m", phase=None, parent=None: (method, phase, None, t, parent)
    df = events(
        spark,
        event(1, "NOTE", "x", details='{"scope_status":"exceeds-accepted","expected_phase":"build"}', method_context=("m", "plan", None, None, None)),
        event(2, "NOTE", "x", details='{"expected_source_revision":"r2","expected_sha256":"a","observed_sha256":"b"}', source=("git", "r", "r1")),
        event(3, "TASK_STARTED", "t1", method_context=task("t1", "bounded", parent="t0")),
        event(4, "BLOCKER_RAISED", "t0", method_context=None),
        event(5, "TASK_COMPLETED", "t0", method_context=task("t0")),
        event(6, "DRIFT_DETECTED", "d1", details='{"severity":"blocking"}'),
        event(7, "DRIFT_RESOLVED", "d1"),
        event(8, "INTENT_REVISED", "i1", details='{"decision_id":"q1","resolves_drift_ids":["drift.bypassed-blocker:e5"]}'),
        event(9, "INTENT_REVISED", "i1", details='{"decision_id":"none"}'),
    )
    recorded = events(spark, event(9, "DECISION_RECORDED", "q", event_id="e99", details='{"decision_id":"q1"}'))
    got = {(r.rule, r.event_id): r.disposition for r in ledger.drift_findings(df.unionByName(recorded), bounded=("bounded",)).collect()}
    assert got == {
        ("drift.scope-exceeds-accepted", "e1"): "open", ("drift.method-phase-conflict", "e1"): "open", ("drift.source-revision-mismatch", "e2"): "open", ("drift.artifact-hash-mismatch", "e2"): "open",
        ("drift.start-without-authorization", "e3"): "open", ("drift.completion-without-evidence", "e5"): "open", ("drift.bypassed-blocker", "e5"): "superseded-by-pivot", ("drift.completion-without-acceptance", "e5"): "open",
        ("drift.active-child-after-parent", "e3"): "open", ("event.drift-detected", "e6"): "resolved", ("drift.pivot-without-decision", "e9"): "open",
    }
    assert {(r.rule, r.event_id) for r in ledger.drift_findings(df, bounded=("bounded",)).collect()} == {*got, ("drift.pivot-without-decision", "e8")}
    told = ledger.story(df.unionByName(recorded)).first()
    assert [i.event_id for i in told.intents] == ["e8", "e9"] and told.blockers == ["t0"] and told.phase == "plan" and [m.kind for m in told.milestones] == ["TASK_COMPLETED"]
    assert [r.drift_id for r in ledger.supersedes(df).collect()] == ["drift.bypassed-blocker:e5"]
    assert [r.event_id for r in ledger.in_order(df.repartition(3)).limit(2).collect()] == ["e1", "e2"]


def test_chain(spark):
    rows = [("p", 1, None, "h1"), ("p", 2, "h1", "h2"), ("p", 3, "hX", "h3"), ("q", 1, "h0", "g1")]
    df = spark.createDataFrame(rows, "project string, n int, previous_event_hash string, event_hash string")
    assert sorted((r.project, r.n) for r in ledger.chain_breaks(df, "project", ["n"]).collect()) == [("p", 3), ("q", 1)]
    made = df.withColumn("event_hash", F.when(F.col("n") == 2, "forged").otherwise(ledger.event_hash(F.col("previous_event_hash"), F.col("project"), F.col("n"))))
    assert [(r.project, r.n) for r in ledger.forged(made, ["project", "n"]).collect()] == [("p", 2)]


def test_search(spark):
    df = spark.createDataFrame([("a", "net total"), ("b", "total"), ("c", "net total"), ("d", None)], "k string, v string")
    assert [(r.k, r.score) for r in search.keyword_search(df, "k", "v", "net total", 2).collect()] == [("a", 14), ("c", 14)]
