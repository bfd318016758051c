"""Content items: the one table every kind of scan request is expressed in."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentgate.functions.rules import FILE_CONTENT, FILE_PATH, KINDS

RESERVED_CONTEXT = ("session_id", "agent_id", "source_application")

ITEM_COLUMNS = {
    "request_id": "string",
    "session_id": "string",
    "agent_id": "string",
    "api_key": "string",
    "ts": "timestamp",
    "content_kind": "string",
    "content": "string",
    "body": "string",
    "source_application": "string",
    "context": "map<string,string>",
    "mode": "string",
}


def file_kind(body: Column) -> Column:
    """A file request carries content when its body is not empty, else only a path."""
    return F.when(F.coalesce(body, F.lit("")) != "", FILE_CONTENT).otherwise(FILE_PATH)


def request_id(given: Column, *identity: Column) -> Column:
    """The given id, else a digest of what identifies the request.

    A random id would change when a task is retried; the digest does not. Each part is
    preceded by its length, and NULL has none, so different parts never read alike.
    """
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in identity]
    return F.coalesce(F.nullif(given, F.lit("")), F.sha2(F.concat_ws(",", *parts), 256))


def build_items(df: DataFrame, kind: str | Column, content: Column, body: Column | None = None, **fields) -> DataFrame:
    """Project any table to content items.

    ``fields`` gives the other item columns as Columns; those not given are NULL, except
    ``mode`` (production) and ``request_id`` (a digest of kind, content, body, caller, session,
    agent and time: two callers with one text have two ids).
    """
    unknown = set(fields) - set(ITEM_COLUMNS)
    if unknown:
        raise ValueError(f"unknown item columns: {sorted(unknown)}")
    if isinstance(kind, str):
        if kind not in KINDS:
            raise ValueError(f"unknown content kind: {kind}")
        kind = F.lit(kind)
    nothing = F.lit(None).cast("string")
    values = {
        "content_kind": kind,
        "content": content,
        "body": nothing if body is None else body,
        "mode": F.lit("production"),
        **fields,
    }
    who = [values.get(name, nothing) for name in ("api_key", "session_id", "agent_id")]
    at = F.unix_micros(values["ts"].cast("timestamp")) if "ts" in values else nothing
    values.setdefault("request_id", request_id(nothing, kind, content, values["body"], *who, at))
    return df.select(
        *[values.get(name, F.lit(None)).cast(dtype).alias(name) for name, dtype in ITEM_COLUMNS.items()]
    )


def union_items(*tables: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), tables)


def context_map(extras: dict[str, Column], session_id: Column, agent_id: Column, source_application: Column,
                keep_empty: bool = False) -> Column:
    """The context sent with a request: extras first, then the three reserved keys, which win.

    Extras without a value are left out (``keep_empty`` sends '' instead, as the guard
    profile does for SQL). Reserved names among the extras are dropped beforehand, so the
    two maps never share a key.
    """
    pairs = [x for name, value in extras.items() for x in (F.lit(name), value)]
    reserved = F.create_map(
        F.lit("session_id"), session_id, F.lit("agent_id"), agent_id,
        F.lit("source_application"), source_application,
    )
    if not pairs:
        return reserved
    given = F.create_map(*pairs)
    if keep_empty:
        given = F.transform_values(given, lambda k, v: F.coalesce(v, F.lit("")))
        kept = F.map_filter(given, lambda k, v: ~k.isin(*RESERVED_CONTEXT))
    else:
        kept = F.map_filter(given, lambda k, v: ~k.isin(*RESERVED_CONTEXT) & (F.coalesce(v, F.lit("")) != ""))
    return F.map_concat(kept, reserved)


def truthy_flag(flag: Column) -> Column:
    """'true' or nothing: how boolean options travel in the context."""
    return F.when(flag, F.lit("true"))
