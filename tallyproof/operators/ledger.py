"""A hash-chained event ledger: chain checks, latest states, relations, drift and snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EVENT_SCHEMA = (
    "schema_version string, event_id string, project_id string, kind string, importance string, access string, occurred_at string, observed_at string, "
    "source struct<system:string,ref:string,source_revision:string>, method_context struct<method:string,phase:string,intent_ref:string,task_ref:string,parent_ref:string>, "
    "headline string, entity_refs array<string>, evidence_ids array<string>, details string, previous_event_hash string, event_hash string"
)


def event_hash(previous: Column, *parts: Column) -> Column:
    """Digest of an event's canonical text and the hash before it."""
    return F.sha2(F.concat_ws("\x1f", F.coalesce(previous, F.lit("")), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)), 256)


def chain_breaks(events: DataFrame, by: str, order: list[str]) -> DataFrame:
    """Events whose link is not the hash of the event before them; the first must link to nothing."""
    before = F.lag("event_hash").over(Window.partitionBy(by).orderBy(*order))
    return events.withColumn("expected_hash", before).filter(~F.col("previous_event_hash").eqNullSafe(F.col("expected_hash")))


def forged(events: DataFrame, parts: list[str]) -> DataFrame:
    """Events whose hash is not the one that their own fields and the hash before them give."""
    return events.withColumn("computed_hash", event_hash(F.col("previous_event_hash"), *(F.col(p) for p in parts))).filter(~F.col("event_hash").eqNullSafe(F.col("computed_hash")))


def ingest(ledger: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming events with what happens to them: APPENDED, or DUPLICATE where the id is known."""
    known = ledger.select("event_id", F.lit(True).alias("_known")).distinct()
    return incoming.join(known, "event_id", "left").withColumn("outcome", F.when(F.col("_known"), "DUPLICATE").otherwise("APPENDED")).drop("_known")


def within(events: DataFrame, since: str | None = None, until: str | None = None, at: str = "occurred_at") -> DataFrame:
    """Events from ``since`` to ``until``, both included, compared as instants."""
    when = F.to_timestamp(F.col(at))
    if since:
        events = events.filter(when >= F.to_timestamp(F.lit(since)))
    if until:
        events = events.filter(when <= F.to_timestamp(F.lit(until)))
    return events


def late(events: DataFrame, occurred: str = "occurred_at", observed: str = "observed_at") -> DataFrame:
    return events.filter(F.to_timestamp(F.col(observed)) > F.to_timestamp(F.col(occurred)))


def in_order(events: DataFrame) -> DataFrame:
    """Events by when they occurred, then by id."""
    return events.orderBy("occurred_at", "event_id")


RELATIONS = ("implements", "depends_on", "supersedes", "blocked_by", "contradicts", "verifies", "caused_by", "accepted_by", "learned_from")


def relations(events: DataFrame) -> DataFrame:
    """Edges (src, relation, dst, event_id, rule) that events state, and those that follow from their kind, once each an event."""
    context, rows = F.col("method_context"), events
    edge = lambda df, src, relation, dst, rule: df.select(src.alias("src"), F.lit(relation).alias("relation"), dst.alias("dst"), "event_id", F.lit(rule).alias("rule"))
    task = context["task_ref"]
    stated = rows.select("event_id", F.explode(F.from_json("details", "relations array<struct<source_ref:string,relation:string,target_ref:string>>")["relations"]).alias("r"))
    stated = stated.select(F.col("r.source_ref").alias("src"), F.col("r.relation").alias("relation"), F.col("r.target_ref").alias("dst"), "event_id", F.lit("explicit.relation").alias("rule"))
    implements = edge(rows.filter("kind = 'TASK_STARTED'"), task, "implements", context["intent_ref"], "event.task-started-intent")
    accepted = edge(rows.filter("kind = 'TASK_ACCEPTED'"), task, "accepted_by", F.col("event_id"), "event.task-accepted")
    proved = rows.filter("kind = 'EVIDENCE_ADDED'").select("event_id", F.explode("entity_refs").alias("e"), "evidence_ids").select("event_id", "e", F.explode("evidence_ids").alias("v"))
    verifies = edge(proved, F.col("e"), "verifies", F.col("v"), "event.evidence-added")
    revised = edge(rows.filter("kind = 'INTENT_REVISED'"), F.coalesce(context["intent_ref"], F.get("entity_refs", F.lit(0))), "supersedes", F.get_json_object("details", "$.supersedes"), "event.intent-revised")
    found = stated.unionByName(implements).unionByName(accepted).unionByName(verifies).unionByName(revised)
    return found.filter((F.coalesce("src", F.lit("")) != "") & (F.coalesce("dst", F.lit("")) != "") & F.col("relation").isin(*RELATIONS)).dropDuplicates(["src", "relation", "dst", "event_id"])


def drift(events: DataFrame, order: list[str]) -> DataFrame:
    """(rule, entity) of states that should not last: open blockers, tasks begun and not ended, work without evidence."""
    entities = events.select("kind", *order, "event_id", "evidence_ids", F.explode("entity_refs").alias("entity"))
    last = lambda kinds: entities.filter(F.col("kind").isin(*kinds)).groupBy("entity").agg(F.max_by("kind", F.struct(*order, "event_id")).alias("kind"))
    blockers = last(["BLOCKER_RAISED", "BLOCKER_CLEARED"]).filter("kind = 'BLOCKER_RAISED'").select(F.lit("open_blocker").alias("rule"), "entity")
    active = last(["TASK_STARTED", "TASK_COMPLETED", "TASK_ABANDONED"]).filter("kind = 'TASK_STARTED'").select(F.lit("task_not_ended").alias("rule"), "entity")
    bare = entities.filter("kind = 'TASK_COMPLETED'").groupBy("entity").agg(F.max(F.size("evidence_ids")).alias("n")).filter("coalesce(n, 0) <= 0").select(F.lit("completed_without_evidence").alias("rule"), "entity")
    settled = entities.filter("kind = 'DRIFT_RESOLVED'").select("entity").distinct()
    return blockers.unionByName(active).unionByName(bare).join(settled, "entity", "left_anti").select("rule", "entity")


def drift_findings(events: DataFrame, order: list[str] | None = None, bounded: tuple[str, ...] = ()) -> DataFrame:
    """(drift_id, rule, severity, event_id, task, disposition) of all eleven rules over a project's events.

    ``bounded`` names the methods whose tasks need an authorization to start.

    What an event tells alone is one projection; what came before it is a window over the events of a task or an entity.
    A finding is resolved by a later DRIFT_RESOLVED that names it, and superseded by the last revision of intent that
    a recorded decision backs, if that lists it.
    """
    order = order or ["occurred_at", "event_id"]
    said = lambda name: F.get_json_object("details", f"$.{name}")
    context = F.col("method_context")
    e = events.select("event_id", "kind", *[c for c in order if c != "event_id"], "importance", "entity_refs", "evidence_ids", "details", "source", context.alias("m"), context["task_ref"].alias("task"))
    recorded = e.filter("kind = 'DECISION_RECORDED'").select(said("decision_id").alias("decision")).filter("decision is not null").distinct()
    full = lambda c: F.coalesce(c, F.lit("")) != ""
    find = lambda df, rule, severity, task=F.col("task"): df.select(F.concat_ws(":", F.lit(rule), "event_id").alias("drift_id"), F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), "event_id", task.alias("task"))
    attention, blocking = "needs-attention", "blocking"
    expected_hash, observed_hash = said("expected_sha256"), said("observed_sha256")
    started, completed = e.filter("kind = 'TASK_STARTED' and task is not null"), e.filter("kind = 'TASK_COMPLETED' and task is not null")
    found = [
        find(e.filter((F.coalesce(said("scope_status"), F.lit("")) == "exceeds-accepted") | full(said("scope_exceeds_ref"))), "drift.scope-exceeds-accepted", attention),
        find(e.filter(full(said("expected_phase")) & ~F.col("m.phase").eqNullSafe(said("expected_phase"))), "drift.method-phase-conflict", attention),
        find(e.filter(full(said("expected_source_revision")) & ~F.col("source.source_revision").eqNullSafe(said("expected_source_revision"))), "drift.source-revision-mismatch", attention),
        find(e.filter((F.coalesce(said("hash_status"), F.lit("")) == "mismatch") | (full(expected_hash) & full(observed_hash) & (expected_hash != observed_hash))), "drift.artifact-hash-mismatch", blocking),
        find(e.filter("kind = 'INTENT_REVISED'").withColumn("decision", said("decision_id")).join(recorded, "decision", "left_anti"), "drift.pivot-without-decision", blocking),
        find(started.filter(F.col("m.method").isin(*bounded) & ~full(said("authorization_ref"))), "drift.start-without-authorization", attention),
        find(completed.filter(F.coalesce(F.size("evidence_ids"), F.lit(0)) <= 0), "drift.completion-without-evidence", attention),
    ]
    # a blocker still up when its task completes
    keys = [F.col(c) for c in order]
    blocked = e.filter("kind in ('BLOCKER_RAISED', 'BLOCKER_CLEARED')").select(*keys, F.explode(F.when(F.coalesce(F.size("entity_refs"), F.lit(0)) > 0, F.col("entity_refs")).otherwise(F.array("task"))).alias("task"), (F.col("kind") == "BLOCKER_RAISED").alias("up"), F.lit(False).alias("end"))
    both = blocked.unionByName(completed.select(*keys, "task", F.lit(None).cast("boolean").alias("up"), F.lit(True).alias("end")), allowMissingColumns=True)
    before = F.last("up", ignorenulls=True).over(Window.partitionBy("task").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    bypassed = both.withColumn("before", before).filter("end and before").select("event_id", "task")
    found.append(find(bypassed, "drift.bypassed-blocker", blocking))
    at = F.struct(*order)
    last_done = completed.groupBy("task").agg(F.max_by("event_id", at).alias("event_id"))
    accepted = e.filter("kind = 'TASK_ACCEPTED' and task is not null").select("task").distinct()
    found.append(find(last_done.join(accepted, "task", "left_anti"), "drift.completion-without-acceptance", attention))
    ends = e.filter("task is not null and kind in ('TASK_STARTED', 'TASK_COMPLETED', 'TASK_FAILED', 'TASK_REJECTED')").groupBy("task").agg(F.max_by(F.struct("kind", "event_id", F.col("m.parent_ref").alias("parent")), at).alias("z")).select("task", "z.*")
    child = ends.filter("kind = 'TASK_STARTED'").join(completed.select(F.col("task").alias("parent")).distinct(), "parent", "left_semi")
    found.append(find(child, "drift.active-child-after-parent", attention))
    reported = e.filter("kind = 'DRIFT_DETECTED'").select(F.coalesce(F.get("entity_refs", F.lit(0)), F.col("event_id")).alias("drift_id"), F.lit("event.drift-detected").alias("rule"), F.coalesce(said("severity"), F.col("importance")).alias("severity"), "event_id", "task")
    union = reported
    for f in found:
        union = union.unionByName(f)
    when = e.select("event_id", at.alias("at"))
    resolved = e.filter("kind = 'DRIFT_RESOLVED'").select(F.explode("entity_refs").alias("drift_id"), at.alias("then")).groupBy("drift_id").agg(F.max("then").alias("then"))
    backed = e.filter("kind = 'INTENT_REVISED'").withColumn("decision", said("decision_id")).join(recorded, "decision", "left_semi")
    listed = backed.agg(F.max_by("details", at).alias("details")).select(F.explode(F.from_json(F.get_json_object("details", "$.resolves_drift_ids"), "array<string>")).alias("drift_id")).distinct().withColumn("pivot", F.lit(True))
    rows = union.join(when, "event_id", "left").join(resolved, "drift_id", "left").join(listed, "drift_id", "left")
    disposition = F.when(F.col("pivot"), "superseded-by-pivot").when((F.col("rule") == "event.drift-detected") & (F.col("then") > F.col("at")), "resolved").otherwise("open")
    return rows.select("drift_id", "rule", "severity", "event_id", "task", disposition.alias("disposition"))


def supersedes(events: DataFrame) -> DataFrame:
    """(drift_id, event_id): findings that a revision of intent lists as settled."""
    listed = F.explode(F.from_json(F.get_json_object("details", "$.resolves_drift_ids"), "array<string>"))
    return events.filter("kind = 'INTENT_REVISED'").select(listed.alias("drift_id"), "event_id")


def story(events: DataFrame) -> DataFrame:
    """One row a project: what a snapshot tells besides its evidence, each as a sorted list.

    Intents, phases, milestones, detours, human actions, blockers still up and lessons with their review.
    """
    said = lambda name: F.get_json_object("details", f"$.{name}")
    at = F.struct("occurred_at", "event_id")
    ref = F.coalesce(F.get("entity_refs", F.lit(0)), F.col("event_id"))
    listed = lambda cond, *what: F.sort_array(F.collect_list(F.when(cond, F.struct(*what)))).alias
    kind = F.col("kind")
    told = events.groupBy("project_id").agg(
        listed(kind.isin("INTENT_DECLARED", "INTENT_REVISED"), "occurred_at", "event_id", F.coalesce(F.col("method_context.intent_ref"), F.get("entity_refs", F.lit(0))).alias("intent_ref"), "headline")("intents"),
        F.max_by("method_context.phase", F.when(F.coalesce(F.col("method_context.phase"), F.lit("")) != "", at)).alias("phase"),
        listed(kind.isin("TASK_COMPLETED", "TASK_ACCEPTED", "ARTIFACT_CREATED"), "occurred_at", "event_id", "kind", "headline")("milestones"),
        listed(said("signal") == "detour", "occurred_at", "event_id", "headline", said("reason").alias("reason"))("detours"),
        listed(F.coalesce(said("human_action"), F.lit("")) != "", "occurred_at", "event_id", said("human_action").alias("action"), (F.col("importance") == "blocking").alias("blocking"))("human_actions"),
    )
    up = events.filter("kind in ('BLOCKER_RAISED', 'BLOCKER_CLEARED')").select("project_id", at.alias("at"), kind, F.explode(F.when(kind == "BLOCKER_RAISED", F.array(ref)).otherwise(F.col("entity_refs"))).alias("blocker"))
    up = up.groupBy("project_id", "blocker").agg(F.max_by("kind", "at").alias("kind")).filter("kind = 'BLOCKER_RAISED'").groupBy("project_id").agg(F.sort_array(F.collect_list("blocker")).alias("blockers"))
    proposed = events.filter("kind = 'LESSON_PROPOSED'").groupBy("project_id", F.coalesce(said("lesson_id"), ref).alias("lesson_id")).agg(F.max_by(F.coalesce(said("observation"), F.col("headline")), at).alias("observation"))
    reviews = events.filter("kind = 'DECISION_RECORDED'").select("project_id", said("decision_id").alias("d"), said("choice").alias("choice"), at.alias("at")).filter("d like 'lesson-review:%'")
    reviews = reviews.groupBy("project_id", F.substring_index("d", ":", -1).alias("lesson_id")).agg(F.max_by(F.coalesce("choice", F.lit("recorded")), "at").alias("review"))
    lessons = proposed.join(reviews, ["project_id", "lesson_id"], "left").groupBy("project_id").agg(F.sort_array(F.collect_list(F.struct("lesson_id", "observation", F.coalesce("review", F.lit("proposed")).alias("review")))).alias("lessons"))
    return told.join(up, "project_id", "left").join(lessons, "project_id", "left")


def decisions(events: DataFrame) -> DataFrame:
    """Requests and records of a decision side by side."""
    rows = events.select("kind", "occurred_at", F.get_json_object("details", "$.decision_id").alias("decision_id"))
    side = lambda kind, name: rows.filter(F.col("kind") == kind).groupBy("decision_id").agg(F.min("occurred_at").alias(name))
    return side("DECISION_REQUESTED", "requested_at").join(side("DECISION_RECORDED", "recorded_at"), "decision_id", "full_outer").withColumn("open", F.col("recorded_at").isNull())


def snapshot(events: DataFrame) -> DataFrame:
    """One row per project: events, the window they cover, late ones, and the distinct evidence."""
    evidence = events.select("project_id", F.explode("evidence_ids").alias("e")).distinct().groupBy("project_id").agg(F.sort_array(F.collect_list("e")).alias("evidence_ids"))
    heads = events.groupBy("project_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.min("occurred_at").alias("since"),
        F.max("occurred_at").alias("until"),
        F.count(F.when(F.to_timestamp("observed_at") > F.to_timestamp("occurred_at"), 1)).alias("late"),
    )
    return heads.join(evidence, "project_id", "left")


def next_actions(events: DataFrame, n: int = 3) -> DataFrame:
    """The last ``n`` distinct next actions of each project, newest first."""
    rows = events.filter("kind = 'NEXT_ACTION'").groupBy("project_id", "headline").agg(F.max(F.struct("occurred_at", "event_id")).alias("at"))
    w = Window.partitionBy("project_id").orderBy(F.desc("at"))
    return rows.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= n).select("project_id", "place", "headline")


def state_fold(events: DataFrame, entity: str, kinds: dict[str, str], order: list[str]) -> DataFrame:
    """The state that the last relevant event leaves each entity in."""
    names = F.create_map(*(F.lit(x) for kv in kinds.items() for x in kv))
    rows = events.filter(F.col("kind").isin(*kinds))
    return rows.groupBy(entity).agg(F.max_by(names[F.col("kind")], F.struct(*order)).alias("state"))


def stale_reports(reports: DataFrame, events: DataFrame) -> DataFrame:
    """Reports with events after the window that they cover, and how many."""
    after = reports.join(events.select("project_id", "occurred_at"), "project_id").filter(F.to_timestamp("occurred_at") > F.to_timestamp("until"))
    return after.groupBy("project_id", "report_id").agg(F.count(F.lit(1)).alias("newer_events"))
