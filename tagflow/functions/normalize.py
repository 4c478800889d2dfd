"""Normalisation of references, markers, kinds and typed values.

Column functions for DataFrames, and operators that apply them to tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagflow.sqlops import operator

REF = r"^[A-Za-z0-9_:.-]+$"
ZONED = r"(Z|[+-]\d\d:?\d\d)$"
#: Fixed names: kinds of tagged objects that stand for their ``val``.
VALUE_KINDS = ("ref", "number", "date", "time", "uri", "coord", "symbol")
LEADING = ("fsk", "id", "dis", "navName", "siteRef", "equipRef")


def normalise_ref(c: Column) -> Column:
    """The id of a reference in text: after ``r:`` the display name goes; null where what is left is not an id as a whole."""
    body = F.when(c.startswith("r:"), F.split_part(F.substring(c, 3, 1 << 30), F.lit(" "), F.lit(1))).otherwise(c)
    return F.when(body.rlike(REF), body)


def reference(v: Column) -> Column:
    """The id of a reference in a variant: a text as in ``normalise_ref``, or the ``val`` of an object of kind ``ref``; else null."""
    val = F.try_variant_get(v, "$.val", "variant")
    inside = F.when((F.try_variant_get(v, "$._kind", "string") == "ref") & (F.schema_of_variant(val) == "STRING"), F.try_variant_get(val, "$", "string"))
    text = F.when(F.schema_of_variant(v).startswith("OBJECT"), inside).when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))
    return normalise_ref(text)


def legacy_ref(c: Column) -> Column:
    """Trimmed and without leading ``@``; not validated."""
    return F.ltrim(F.trim(c), F.lit("@"))


def historized_flag(c: Column) -> Column:
    """true, false (also for null), or null for a marker that is neither."""
    return F.when(c.isNull() | c.isin("", "false"), False).when(c.isin("true", "m:"), True)


def historized_value(v: Column) -> Column:
    """``historized_flag`` of a variant: a boolean, a text, a marker object; null for what is neither."""
    shape = F.schema_of_variant(v)
    text = historized_flag(F.try_variant_get(v, "$", "string"))
    return F.when(v.isNull() | F.is_variant_null(v), False).when(shape == "BOOLEAN", F.try_variant_get(v, "$", "boolean")).when(shape == "STRING", text).when(F.try_variant_get(v, "$._kind", "string") == "marker", True)


def historized_marker(c: Column, true_set: set[str], false_set: set[str]) -> Column:
    """``historized_flag`` with sets of one's own, of trimmed text in lower case; they must not overlap."""
    both = set(true_set) & set(false_set)
    if both:
        raise ValueError(f"markers that mean both: {sorted(both)}")
    v = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(v.isin(*true_set), True).when(v.isin(*false_set), False)


def flatten_kind(c: Column) -> Column:
    """Kinds of the older text form: ``m:`` is true whatever follows, ``r:`` and ``n:`` the token, other ``x:`` the body.

    A plain string whose second character is a colon is taken for a kind as well.
    """
    body = F.substring(c, 3, 1 << 30)
    token = F.split_part(body, F.lit(" "), F.lit(1))
    return F.when(F.substring(c, 2, 1) != ":", c).when(c.startswith("m:"), "true").when(c.startswith("r:") | c.startswith("n:"), token).otherwise(F.when(F.length(c) > 1, body).otherwise(c))


def flatten_object(v: Column) -> Column:
    """Kinds of the newer form, objects with ``_kind``, as text: a marker is true, a kind with a value
    its ``val`` (the whole object where it has no such field), a ``dateTime`` its ``val`` or null, any
    other object or list its JSON. Texts are read as in ``flatten_kind``."""
    kind, shape = F.try_variant_get(v, "$._kind", "string"), F.schema_of_variant(v)
    val = F.try_variant_get(v, "$.val", "variant")
    as_text = lambda x: F.when(F.schema_of_variant(x).rlike("^(OBJECT|ARRAY)"), F.to_json(x)).otherwise(F.try_variant_get(x, "$", "string"))
    nested = shape.startswith("OBJECT") | shape.startswith("ARRAY")
    return (
        F.when(kind == "marker", "true").when(kind == "dateTime", as_text(val)).when(kind.isin(*VALUE_KINDS) & val.isNotNull(), as_text(val)).when(nested, F.to_json(v))
        .when(shape == "STRING", flatten_kind(F.try_variant_get(v, "$", "string"))).otherwise(F.try_variant_get(v, "$", "string"))
    )


def instant_with_zone(c: Column) -> Column:
    """The instant of an ISO text that names its zone; null without a zone. The session's zone plays no part."""
    return F.when(c.rlike(ZONED), F.try_to_timestamp(c))


def utc_clock(instant: Column) -> Column:
    """An instant as what a clock in UTC shows, whatever the session's zone."""
    seconds = (F.unix_micros(instant).cast("decimal(24,6)") / 1_000_000).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def instant_of(clock: Column) -> Column:
    """The instant at which a clock in UTC shows ``clock``, whatever the session's zone."""
    return F.make_timestamp(F.year(clock), F.month(clock), F.dayofmonth(clock), F.hour(clock), F.minute(clock), F.date_part(F.lit("SECOND"), clock), F.lit("UTC"))


def local_clock(clock: Column, zone: str) -> Column:
    """What a clock in ``zone`` shows when one in UTC shows ``clock``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), clock)


def local_midnight(day: Column, zone: str) -> Column:
    """What a clock in UTC shows at midnight of a day in ``zone``."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), day.cast("timestamp_ntz"))


def _is_number(shape: Column) -> Column:
    return shape.startswith("BIGINT") | shape.startswith("DECIMAL") | shape.startswith("DOUBLE")


def typed_value(v: Column) -> dict[str, Column]:
    """value_kind, val_bool, val_num, val_str, val_na and source_status of a variant, told apart by its own type.

    An object of just ``value`` and ``status`` is unwrapped; its status must be a text, not empty.
    ``value_kind`` is null where the value is of no such type, not finite or a malformed wrapper.
    """
    outer = F.schema_of_variant(v)
    keys = F.array_sort(F.map_keys(F.try_variant_get(v, "$", "map<string,variant>")))
    wrapped = F.coalesce(keys == F.array(F.lit("status"), F.lit("value")), F.lit(False))
    status = F.when(wrapped, F.try_variant_get(v, "$.status", "string"))
    malformed = wrapped & (~outer.startswith("OBJECT<status: STRING") | (F.coalesce(status, F.lit("")) == ""))
    inner = F.when(wrapped, F.try_variant_get(v, "$.value", "variant")).otherwise(v)
    shape = F.schema_of_variant(inner)
    number = F.try_variant_get(inner, "$", "double")
    finite = ~F.isnan(number) & (F.abs(number) < float("inf"))
    kind = (
        F.when(malformed, None).when(shape == "BOOLEAN", "bool").when(_is_number(shape) & finite, "num").when(shape == "STRING", "str")
        .when(shape.startswith("OBJECT<_kind: STRING>") & (F.try_variant_get(inner, "$._kind", "string") == "na"), "na")
    )
    return {
        "value_kind": kind,
        "val_bool": F.when(kind == "bool", F.try_variant_get(inner, "$", "boolean")),
        "val_num": F.when(kind == "num", F.try_variant_get(inner, "$", "decimal(38,18)")),
        "val_str": F.when(kind == "str", F.try_variant_get(inner, "$", "string")),
        "val_na": F.when(kind == "na", True),
        "source_status": status,
    }


def coerce_live_value(v: Column) -> Column:
    """The lenient form, as text: scalars as they are, NA as its object, a number kind its number (its text
    where not finite), a kind with ``val`` that value's text, anything else its JSON."""
    shape, kind = F.schema_of_variant(v), F.try_variant_get(v, "$._kind", "string")
    val = F.try_variant_get(v, "$.val", "string")
    scalar = ~(shape.startswith("OBJECT") | shape.startswith("ARRAY"))
    return F.when(scalar, F.try_variant_get(v, "$", "string")).when(kind == "na", F.lit('{"_kind":"na"}')).when(val.isNotNull(), val).otherwise(F.to_json(v))


def ref_list(v: Column) -> Column:
    """array<string> of unique ids: of a list its references, texts or objects; of one reference in text that one, else none.

    Null (invalid) where a list repeats an id or holds what is no reference, or a text after ``r:`` is none.
    """
    shape = F.schema_of_variant(v)
    many = F.transform(F.try_variant_get(v, "$", "array<variant>"), reference)
    bad = F.exists(many, lambda x: x.isNull()) | (F.size(F.array_distinct(many)) < F.size(many))
    one = F.try_variant_get(v, "$", "string")
    none = F.array().cast("array<string>")
    single = F.when(one.rlike(REF) | one.startswith("r:"), F.when(normalise_ref(one).isNotNull(), F.array(normalise_ref(one)))).otherwise(none)
    return F.when(shape.startswith("ARRAY"), F.when(F.size(many) == 0, none).when(~bad, many)).when(shape == "STRING", single).otherwise(none)


def canonical(**cols: Column) -> Column:
    """The canonical JSON of named columns: names sorted, nulls kept. Pass decimals, not doubles."""
    return F.to_json(F.struct(*(cols[k].alias(k) for k in sorted(cols))), {"ignoreNullFields": "false"})


def row_hash(**cols: Column) -> Column:
    """SHA-256 of the canonical JSON of named columns."""
    return F.sha2(canonical(**cols), 256)


#: Fixed names: fields of a sample that its hash is of; those of the source count only where they are set.
SAMPLE_FIELDS = ("point_id", "observed_at", "value_kind", "val_bool", "val_str", "val_num", "val_na")
SOURCE_FIELDS = ("source_timestamp", "source_timezone", "source_status")


def observation_line(df: DataFrame) -> Column:
    """The canonical JSON of a sample, by its whole typed value and what the source said of it; absent columns are null."""
    text = {"observed_at": F.concat(F.col("observed_at").cast("timestamp_ntz").cast("string"), F.lit("Z")), "val_num": F.col("val_num").cast("string")}
    cols = {k: text.get(k, F.col(k)) if k in df.columns else F.lit(None).cast("string") for k in (*SAMPLE_FIELDS, *SOURCE_FIELDS)}
    line = F.to_json(F.struct(*(cols[k].alias(k) for k in sorted(cols))), {"ignoreNullFields": "false"})
    for k in SOURCE_FIELDS:  # quotes inside values are escaped, so this text is only ever a field
        line = F.replace(line, F.lit(f',"{k}":null'), F.lit(""))
    return line


def observation_hash(df: DataFrame) -> Column:
    """SHA-256 of a sample's canonical JSON."""
    return F.sha2(observation_line(df), 256)


def detection_key(tenant: Column, project: Column, site: Column, equipment: Column, rule: Column, day: Column, zone: Column) -> Column:
    """A detection's identity, which corrections of its payload keep."""
    return row_hash(tenant_id=tenant, project_id=project, site_ref=site, equipment_id=equipment, rule_id=rule, source_date=day.cast("string"), source_timezone=zone)


@operator
def flatten_kinds(tagged):
    """Tagged texts flat."""
    return tagged.select("row_no", flatten_kind(F.col("v")).alias("flat"))


@operator
def flatten_objects(json):
    """Tagged objects flat."""
    return json.select("row_no", flatten_object(F.try_parse_json("j")).alias("flat"))


@operator
def typed_references(marks):
    """Ids and markers of values as landed JSON has them; null is invalid."""
    v = F.try_parse_json("j")
    return marks.select("row_no", reference(v).alias("ref"), historized_value(v).alias("historized"))


@operator
def normalise_refs(tagged):
    """Ids of references, strict and legacy."""
    return tagged.select("row_no", normalise_ref(F.col("v")).alias("ref"), legacy_ref(F.col("v")).alias("legacy"))


@operator
def historized_flags(tagged):
    """Markers and what they mean; null is invalid."""
    return tagged.groupBy("v").agg(F.count("*").alias("n")).select("v", historized_flag(F.col("v")).alias("historized"), "n")


@operator
def historized_markers(tagged, true_set=("true", "m:", "yes"), false_set=("", "false", "no")):
    """Markers by sets of one's own; null is invalid."""
    marker = historized_marker(F.col("v"), set(true_set), set(false_set))
    return tagged.groupBy(marker.alias("historized")).agg(F.count("*").alias("n"))


@operator
def typed_values(json):
    """Values by type, and which are of none."""
    typed = json.select("row_no", *(c.alias(k) for k, c in typed_value(F.try_parse_json("j")).items()))
    return typed.withColumn("val_num", F.col("val_num").cast("decimal(18,2)"))


@operator
def coerced_values(json):
    """Values as the lenient reader keeps them."""
    return json.select("row_no", coerce_live_value(F.try_parse_json("j")).alias("value"))


@operator
def instants(stamps):
    """UTC instants of texts that name their zone, and texts and zones as they came; others are invalid."""
    at = instant_with_zone(F.col("stamp"))
    zone = F.when(at.isNotNull(), F.regexp_extract("stamp", ZONED, 1))
    return stamps.select("row_no", "stamp", zone.alias("source_timezone"), utc_clock(at).alias("observed_at"))


@operator
def ref_lists(json):
    """Unique ids of reference lists; ``valid`` is false where a list is at fault."""
    refs = ref_list(F.try_parse_json("j"))
    return json.select("row_no", refs.isNotNull().alias("valid"), F.coalesce(refs, F.array().cast("array<string>")).alias("refs"))


@operator
def wide_to_long(pages):
    """One row a cell that is set, of pages with columns and rows as maps."""
    cells = pages.select("batch_id", F.explode("rows").alias("row"))
    return cells.select("batch_id", F.col("row.ts").alias("observed_at"), F.explode("row.cells").alias("point_id", "cell")).where("cell IS NOT NULL")


@operator
def row_hashes(history):
    """Hash of each sample's value; the instant as text, decimals as text, nulls kept."""
    cols = {"observed_at": F.date_format("observed_at", "yyyy-MM-dd HH:mm:ss"), "point_id": F.col("point_id"), "val_num": F.col("val_num").cast("string"), "val_str": F.col("val_str")}
    return history.select("row_no", row_hash(**cols).alias("row_hash"))


@operator
def detection_keys(detections, tenant="t", project="1001", site="s", zone="UTC"):
    """Detections by identity."""
    key = detection_key(F.lit(tenant), F.lit(project), F.lit(site), F.col("targetRef"), F.col("ruleRef"), F.col("rule_date"), F.lit(zone))
    return detections.groupBy("targetRef", "ruleRef", "rule_date").agg(F.count("*").alias("n")).withColumn("detection_key", key)


#: Fixed names: fields of a source's detections and ours.
DETECTION_FIELDS = {
    "targetRef": "equipment_id", "ruleRef": "rule_id", "date": "source_date", "tz": "source_tz_tag", "spark": "spark", "dur": "duration", "periods": "periods", "points": "point_ids", "priority": "priority", "severity": "severity",
    "alarmMessageText": "alarm_message_text", "helpMessageText": "help_message_text",
}


@operator
def map_detections(found):
    """Source fields under their own names: references as ids, the day as a date, points as a list of ids (null where invalid).

    Fields that the source does not have are left out.
    """
    made = {"targetRef": normalise_ref, "ruleRef": normalise_ref, "date": lambda c: c.try_cast("date"), "points": lambda c: ref_list(F.try_parse_json(c))}
    return found.select(*(made.get(k, lambda c: c)(F.col(k)).alias(v) for k, v in DETECTION_FIELDS.items() if k in found.columns))


@operator
def normalise_entities(equipment, points):
    """Accepted rows of both kinds in one shape; a point without equipment is at site level."""
    own = equipment.where("outcome = 'accepted'").select(F.lit("equipment").alias("kind"), F.col("id").alias("source_id"), F.col("siteRef").alias("site_ref"))
    ref = F.when(F.trim("equipRef") != "", F.col("equipRef"))
    parts = points.where("outcome = 'accepted'").select(F.lit("point").alias("kind"), F.col("id").alias("source_id"), F.col("siteRef").alias("site_ref"), ref.alias("parent_id"), ref.isNull().alias("site_level"), "historized")
    return own.unionByName(parts, allowMissingColumns=True)


def lead(df: DataFrame, drop: tuple[str, ...] = (), **constants: str) -> DataFrame:
    """``df`` without ``drop``, constant columns and the known leading columns first, the others after."""
    kept = [c for c in df.columns if c not in drop and c not in constants]
    first = [c for c in LEADING if c in kept]
    return df.select(*(F.lit(v).alias(k) for k, v in constants.items()), *first, *(c for c in kept if c not in first))


@operator
def lead_columns(points, drop=("his",)):
    """Point rows with their key columns first; ``point_dis`` is the display name, else the navigation name."""
    return lead(points.withColumn("point_dis", F.coalesce("dis", "navName")), drop, project="1001")
