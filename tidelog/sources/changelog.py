"""Change-log sources: wire messages, server-sent events, paged reads, and a change log made of the events table."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The change log's schema, batch and stream alike.
SCHEMA = (
    "offset bigint, batch_id bigint, shape_id string, key string, op string, kind string, control string, handle string, cursor string, is_up_to_date boolean, payload string, "
    "value map<string,string>, old_value map<string,string>, snapshot struct<xmin:string,xmax:string,xip:array<string>>, txids array<bigint>, tags array<string>, removed_tags array<string>, "
    "active_conditions array<boolean>, event string, patterns array<struct<pos:int,value:string>>, is_subset_snapshot boolean"
)


def events_changelog(events: DataFrame) -> DataFrame:
    """The events table read as a change log of users: one row per event, with two fields that a change may not carry."""
    kind = F.col("event_type")
    return events.select(
        F.col("event_id").alias("offset"),
        F.col("user_id").alias("key"),
        F.expr("100 + event_id div 5").cast("bigint").alias("txid"),
        F.when(kind == "signup", "insert").when(kind == "error", "delete").otherwise("update").alias("op"),
        (kind != "click").alias("has_v"),
        (kind != "view").alias("has_k"),
        F.when(F.col("event_id") % 7 != 0, F.round("value", 4)).alias("v"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.expr("event_id div 200").cast("bigint").alias("batch_id"),
        F.when(F.col("event_id") % 1777 == 1776, "must_refetch").when(F.col("event_id") % 200 == 199, "up_to_date").alias("control"),
        F.when(F.col("event_id") % 11 != 0, F.col("props")).otherwise("").alias("payload"),
    )


def read_log(spark: SparkSession, path: str, starting: str = "earliest") -> DataFrame:
    """A change log of Parquet files. starting: earliest (all), latest (nothing that is there now) or an offset to start after."""
    log = spark.read.schema(SCHEMA).parquet(path)
    if starting == "earliest":
        return log
    return log.where(F.lit(False)) if starting == "latest" else log.where(F.col("offset") > int(starting))


def read_log_stream(spark: SparkSession, path: str, files_per_batch: int = 16) -> DataFrame:
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(path)


class EventParser:
    """Server-sent events: feed() takes bytes as they come and returns the data of finished events; finish() that of an event without a blank line after it.

    Lines count once they have ended. Only data: lines say anything; comments, other fields and a bare `data` do not.
    """

    def __init__(self) -> None:
        self.rest = b""
        self.lines: list[str] = []

    def feed(self, data: bytes) -> list[str]:
        *whole, self.rest = (self.rest + data).split(b"\n")
        return [x for line in whole if (x := self._line(line)) is not None]

    def finish(self) -> list[str]:
        last = self._line(b"")
        return [last] if last is not None else []

    def _line(self, raw: bytes) -> str | None:
        line = raw.removesuffix(b"\r").decode()
        if not line:
            found, self.lines = self.lines, []
            return "\n".join(found) if found else None
        if line.startswith("data:"):
            self.lines.append(line.removeprefix("data:").removeprefix(" "))
        return None


def event_data(text: Column) -> Column:
    """EventParser over a column of whole streams: an array with the data of each event."""
    lines = lambda block: F.filter(F.split(block, "\n"), lambda x: x.startswith("data:"))
    data = lambda x: F.regexp_replace(F.substring(x, 6, 1 << 30), "^ ", "")
    ended = F.regexp_replace(text, r"[^\n]*+\z", "")
    blocks = F.filter(F.split(F.regexp_replace(ended, "\r\n", "\n"), "\n\n+"), lambda b: F.size(lines(b)) > 0)
    return F.transform(blocks, lambda b: F.array_join(F.transform(lines(b), data), "\n"))


class SourceError(RuntimeError):
    """A paged read that cannot reach a boundary."""


@dataclass
class PagedRead:
    """Reads pages of messages until a boundary (subset_end or up_to_date); a reset ends it at once.

    fetch(cursor) returns messages: dicts with offset and control. Bounds on pages and messages guard memory and are an
    error where they are met, never a cut result.
    """

    fetch: Callable[[str | None], list[dict]]
    most_pages: int = 20
    most_messages: int = 50_000
    messages: list[dict] = field(default_factory=list)

    def run(self, start: str | None = None) -> list[dict]:
        at = start
        for _ in range(self.most_pages):
            page = self.fetch(at)
            if not page:
                raise SourceError("an empty page before a boundary")
            reset = next((m for m in page if m.get("control") in ("truncate", "must_refetch")), None)
            if reset:
                return [reset]
            self.messages += page
            if len(self.messages) > self.most_messages:
                raise SourceError("too many messages before a boundary")
            if any(m.get("control") in ("up_to_date", "subset_end") for m in page):
                return self.messages
            last = page[-1].get("offset")
            if last == at:
                raise SourceError("the offset does not advance")
            at = last
        raise SourceError("no boundary within the pages allowed")


def starting_options(offset: str | None, handle: str | None = None, mode: str = "eager") -> dict[str, str]:
    """Where a read starts: -1 is everything, now is the tail only; on demand, changes only are asked for."""
    out = {"offset": offset if offset is not None else ("now" if mode == "on_demand" else "-1")}
    if handle:
        out["handle"] = handle
    if mode == "on_demand":
        out["log"] = "changes_only"
    return out


def decode_header_error(message: str) -> str | None:
    """The header that a decoding error names (headers.<key>), for quarantine reports."""
    found = re.search(r"headers\.(\w+)", message)
    return found[1] if found else None


def pages_of(rows: list[dict], size: int) -> Iterator[list[dict]]:
    for i in range(0, len(rows), size):
        yield rows[i : i + size]
