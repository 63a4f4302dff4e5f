"""The state of running streams, kept as one small document per progress report."""

from __future__ import annotations

import json
import time

from pyspark.sql import SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener


class Heartbeat(StreamingQueryListener):
    """Keeps the last state of each stream; ``document`` gives it as JSON."""

    def __init__(self) -> None:
        self.state: dict[str, dict] = {}

    def _note(self, event, **what) -> None:
        self.state.setdefault(str(event.id), {}).update(what, at=time.time())

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self._note(event, state="running", name=event.name)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self.state.setdefault(str(p.id), {}).update(state="running", sequence=p.batchId, rows=p.numInputRows, at=time.time())

    def onQueryIdle(self, event) -> None:  # noqa: N802
        self._note(event, state="idle")

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._note(event, state="failed" if event.exception else "stopped")

    def document(self) -> str:
        return json.dumps(self.state, sort_keys=True)


def watch(spark: SparkSession) -> Heartbeat:
    beat = Heartbeat()
    spark.streams.addListener(beat)
    return beat
