"""Log events: typed JSON lines that Python's logging writes and Spark reads back as a table.

Drivers and fetching tasks log with `emit`; `read` gives the lines of all files
under a path, from which `operators.warehouse.request_stats`, `errors_by_type`,
`load_summary` and `streaming.control.retry_stats` take their rows."""

from __future__ import annotations

import json
import logging
import logging.handlers
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fields of each kind of event, beside time, level, logger, message and kind.
KINDS: dict[str, dict[str, str]] = {
    "request": {"url": "string", "status": "int", "duration": "double", "ok": "boolean"},
    "database": {"operation": "string", "table_name": "string", "row_count": "long", "duration": "double", "ok": "boolean"},
    "sitemap": {"url": "string", "url_count": "long", "duration": "double", "ok": "boolean"},
    "extraction": {"url": "string", "characters": "long", "duration": "double", "ok": "boolean"},
    "chunking": {"document_id": "string", "chunk_count": "long", "method": "string", "duration": "double"},
    "retry": {"func": "string", "attempt": "int", "outcome": "string", "delay": "double", "error_type": "string"},
    "rate_limit": {"host": "string", "delay": "double", "reason": "string"},
    "error": {"error_type": "string", "url": "string"},
}
FIELDS = {name: kind for fields in KINDS.values() for name, kind in fields.items()}
SCHEMA = ", ".join(f"{name} {kind}" for name, kind in ({"at": "timestamp", "level": "string", "logger": "string", "message": "string", "kind": "string", "exception": "string"} | FIELDS).items())


class JsonLines(logging.Formatter):
    """One JSON object a record, with the fields that the record carries."""

    def format(self, record: logging.LogRecord) -> str:
        found = {"at": datetime.fromtimestamp(record.created, UTC).isoformat(), "level": record.levelname, "logger": record.name, "message": record.getMessage()}
        found |= getattr(record, "event", {})
        if record.exc_info:
            found["exception"] = self.formatException(record.exc_info)
        return json.dumps(found, ensure_ascii=False, default=str)


def json_log(path: str, name: str = "loomline", size: int = 10 << 20, backups: int = 5) -> logging.Logger:
    """Logger whose records go to path as JSON lines; at `size` bytes the file is rotated, `backups` old ones stay."""
    logger = logging.getLogger(name)
    handler = logging.handlers.RotatingFileHandler(path, maxBytes=size, backupCount=backups, encoding="utf-8")
    handler.setFormatter(JsonLines())
    logger.addHandler(handler)
    logger.setLevel(logging.INFO)
    return logger


def emit(logger: logging.Logger, kind: str, message: str = "", level: int = logging.INFO, **fields: object) -> None:
    """Log an event of a known kind; unknown fields are refused, since no column would hold them."""
    if unknown := set(fields) - set(KINDS[kind]):
        raise ValueError(f"no fields of {kind}: {sorted(unknown)}")
    logger.log(level, message or kind, extra={"event": {"kind": kind, **fields}})


def read(spark: SparkSession, path: str) -> DataFrame:
    """Events of the JSON lines under path; a line that is not JSON has only `broken`."""
    return spark.read.schema(f"{SCHEMA}, broken string").option("columnNameOfCorruptRecord", "broken").json(path)


def requests(events: DataFrame) -> DataFrame:
    return events.where("kind = 'request'").select("at", "url", "status", "duration", "ok")


def outcomes(events: DataFrame) -> DataFrame:
    """(func, outcome) rows of retry events, as retry_stats takes them."""
    return events.where(F.col("kind") == "retry").select("func", "outcome")
