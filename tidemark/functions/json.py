"""JSON parsing and projection.

Everything here is a built-in expression (``from_json``, ``get_json_object``,
higher-order functions), so parsing runs JVM-side and prunes unused fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the reference's parse rules.
NULL_TEXT = "null"      # a JSON null member becomes this text
MISSING_TEXT = ""       # a missing member becomes this text in event projections
EVENT_KEYS = ["event", "distinct_id", "properties", "time"]
PROPERTY_KEYS = ["v1_message_id", "v1_element_content", "v1_message_title"]
LOOKUP_DEFAULTS = {"id": "0", "username": "null", "password": "null"}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_map(c, null_text: bool = True) -> Column:
    """Top-level JSON object -> map<string,string>.

    Nested values stay as compact JSON text. A JSON null member becomes the
    text ``"null"`` (or stays NULL with ``null_text=False``). Anything that is
    not a JSON object (malformed text, arrays, scalars, NULL) gives an empty map.
    """
    m = F.from_json(_c(c), "map<string,string>")
    if null_text:
        m = F.transform_values(m, lambda k, v: F.coalesce(v, F.lit(NULL_TEXT)))
    return F.coalesce(m, F.create_map().cast("map<string,string>"))


def member(m: Column, key: str, default: str | None = MISSING_TEXT) -> Column:
    """Map lookup with a default for a missing key (``getOrElse``) on a map
    from :func:`json_map` (JSON nulls already read as "null").

    The map is referenced once: when Catalyst inlines the parse into pushed
    filters, each member costs one parse, not one per reference.
    """
    v = m.getItem(key)
    return v if default is None else F.coalesce(v, F.lit(default))


def members(raw, keys: list[str], default: str | None = MISSING_TEXT) -> list[Column]:
    """Top-level members ``keys`` of a JSON object as text, with P1's rules:
    nested values as compact JSON text, a JSON null as "null", a missing key
    (or a text that is not an object) as ``default``.

    The object is parsed as a struct of strings, which Catalyst prunes to the
    fields used; only when a field comes out NULL does the (lazy) map parse
    decide between an explicit null and a missing key.
    """
    return _members_of(F.from_json(_c(raw), _struct_ddl(keys)), _c(raw), keys, default)


def _struct_ddl(keys: list[str]) -> str:
    return ", ".join(f"`{k}` STRING" for k in keys)


def _members_of(st: Column, raw: Column, keys: list[str], default: str | None,
                mp: Column | None = None) -> list[Column]:
    mp = F.from_json(raw, "map<string,string>") if mp is None else mp
    out = []
    for k in keys:
        explicit_null = F.when(F.map_contains_key(mp, F.lit(k)), F.lit(NULL_TEXT))
        tail = [explicit_null] if default is None else [explicit_null, F.lit(default)]
        out.append(F.coalesce(st.getField(k), *tail).alias(k))
    return out


def project_event(raw, time_type: str = "bigint") -> list[Column]:
    """(event, distinct_id, properties, time) with ``""`` defaults.

    ``time`` is cast with ``try_cast``: a missing or non-numeric time becomes
    NULL instead of failing the job, so the caller can quarantine it (D3).
    """
    ev, uid, props = members(raw, ["event", "distinct_id", "properties"])
    t = F.from_json(_c(raw), "`time` STRING").getField("time").try_cast(time_type)
    return [ev, uid, props, t.alias("time")]


def project_properties(props, default: str = NULL_TEXT) -> list[Column]:
    """Second-level parse of ``properties``; default "null" (daily job)
    or "" (rolling job)."""
    return members(props, PROPERTY_KEYS, default)


def may_contain_value(raw, value: str) -> Column:
    """Cheap necessary condition for "some member of this JSON text equals
    ``value``": the text holds ``value`` literally, or uses ``\\u`` escapes
    (the only way JSON can spell letters differently). Put it before the full
    parse so records that cannot match are never parsed; keep the exact
    filter after the parse."""
    return (F.instr(_c(raw), value) > 0) | (F.instr(_c(raw), "\\u") > 0)


def parse_events(df: DataFrame, raw: str = "raw", keep: tuple[str, ...] = (),
                 time_type: str = "bigint") -> DataFrame:
    """P1 + P2 on a DataFrame: each record is parsed once into a struct column
    (Catalyst does not inline an expensive expression used several times)."""
    keys = ["event", "distinct_id", "properties", "time"]
    st = _with_fallback(df.select(*keep, F.col(raw).alias("_raw"),
                                  F.from_json(raw, _struct_ddl(keys)).alias("_s")), keys[:3])
    ev, uid, props = _members_of(F.col("_s"), F.col("_raw"), keys[:3], MISSING_TEXT, F.col("_m"))
    return st.select(*keep, ev, uid, props,
                     F.col("_s.time").try_cast(time_type).alias("time"))


def parse_properties(df: DataFrame, props: str = "properties", default: str = NULL_TEXT,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """P3 on a DataFrame, parsing each ``properties`` text once."""
    st = _with_fallback(df.select(*keep, F.col(props).alias("_raw"),
                                  F.from_json(props, _struct_ddl(PROPERTY_KEYS)).alias("_s")),
                        PROPERTY_KEYS)
    return st.select(*keep, *_members_of(F.col("_s"), F.col("_raw"), PROPERTY_KEYS, default,
                                         F.col("_m")))


def _with_fallback(st: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``_m``: the record as a map, parsed once and only when some member
    came out NULL (to tell an explicit JSON null from a missing key)."""
    any_null = None
    for k in keys:
        c = F.col(f"_s.{k}").isNull()
        any_null = c if any_null is None else (any_null | c)
    return st.withColumn("_m", F.when(any_null, F.from_json("_raw", "map<string,string>")))


def to_json_object(*cols) -> Column:
    """Object -> JSON text."""
    return F.to_json(F.struct(*cols))
