"""Progress of every streaming query as JSON Lines."""

from __future__ import annotations

import json
import time
import uuid
from pathlib import Path
from threading import Lock

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from millrace import files


class JsonLines:
    """Writes records where Spark reads them back.

    A plain path is a file on the driver that records are appended to. A path
    with a scheme (``s3a://...``) is a folder: stores cannot append, so every
    record becomes a small file of its own.
    """

    def __init__(self, path: str) -> None:
        self.path = path
        self.shared = "://" in path
        self._lock = Lock()
        if not self.shared:
            Path(path).parent.mkdir(parents=True, exist_ok=True)

    def write(self, record: dict) -> None:
        line = f"{json.dumps(record, ensure_ascii=True)}\n"
        if self.shared:
            name = f"{time.time_ns()}-{uuid.uuid4().hex}.json"
            files.write_text(SparkSession.builder.getOrCreate(), f"{self.path}/{name}", line)
            return
        with self._lock, Path(self.path).open("a", encoding="utf-8") as out:
            out.write(line)


class ProgressListener(StreamingQueryListener):
    """Started, progress and terminated events of all queries of a session."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self.out = JsonLines(path)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        record = {"name": event.name, "timestamp": event.timestamp}
        self.out.write(self._base("query_started", event) | record)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self.out.write(json.loads(event.progress.json) | {"event": "query_progress"})

    def onQueryIdle(self, event) -> None:  # noqa: N802
        """Nothing to record."""

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        record = {"exception": event.exception, "error_class": event.errorClassOnException}
        self.out.write(self._base("query_terminated", event) | record)

    @staticmethod
    def _base(kind: str, event) -> dict:
        return {"event": kind, "id": str(event.id), "run_id": str(event.runId)}
