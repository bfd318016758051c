"""Raw scan results to public verdicts, and the audit of what a public table carries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contentgate.functions import taxonomy, variants
from contentgate.functions.text import non_empty

APPROVAL_TYPE = (
    "struct<requires_approval:boolean,approval_id:string,approval_level:string,action_summary:string,"
    "policy_name:string,expires_in_seconds:bigint,threat_type:string,severity:string,"
    "owasp_category:string,risk_factors:array<string>,original_action:string>"
)

NO_KEY_NOTE = "Scanned without an API key; detection depth is limited."

PUBLIC_COLUMNS = ("safe", "threat_type", "severity", "confidence", "reason", "guidance", "approval_info")


def read_fields(raw: DataFrame, column: str = "raw") -> DataFrame:
    """Typed fields of a VARIANT verdict, following the JSON types strictly.

    ``safe`` is false only for the boolean false. A threat type that is set but is not a
    string makes an unsafe result unusable (``usable`` = false), as does a body that is
    JSON null or did not parse.
    """
    body = F.col(column)
    names = ("safe", "threat_type", "severity", "confidence", "reason", "approval_info")
    # each member is looked up once; what follows reads it several times
    members = raw.select(
        "*",
        (variants.kind_of(body) != variants.NULL).alias("_present"),
        *[variants.field(body, name).alias(f"_{name}") for name in names],
    )
    flag, kind, approval = F.col("_safe"), F.col("_threat_type"), F.col("_approval_info")
    typed = members.select(
        *raw.columns,
        F.coalesce("_present", F.lit(False)).alias("_present"),
        (variants.is_kind(flag, variants.BOOLEAN) & ~F.try_variant_get(flag, "$", "boolean")).alias("_unsafe"),
        (variants.truthy_text(kind).isNotNull() & ~variants.is_kind(kind, variants.STRING)).alias("_bad_type"),
        variants.as_string(kind).alias("threat_type"),
        variants.as_string(F.col("_severity")).alias("severity"),
        variants.as_double(F.col("_confidence")).alias("confidence_score"),
        variants.truthy_text(F.col("_reason")).alias("reason"),
        F.when(variants.is_kind(approval, variants.OBJECT), F.try_variant_get(approval, "$", APPROVAL_TYPE)).alias(
            "approval_info"
        ),
    )
    return typed.select(
        *raw.columns,
        (F.col("_present") & ~(F.col("_unsafe") & F.col("_bad_type"))).alias("usable"),
        (~F.col("_unsafe")).alias("safe"),
        "threat_type", "severity", "confidence_score", "reason", "approval_info",
    )


def sanitize_verdicts(df: DataFrame, keep: tuple[str, ...] = ("request_id",), api_key: str | None = None) -> DataFrame:
    """Typed raw fields to the public verdict: an allow-list, never a deny-list.

    Reads ``safe, threat_type, severity, confidence_score, reason`` and, when present,
    ``approval_info``. Scores, violations and every other input column are left behind;
    ``keep`` names the identifying columns that pass. With ``api_key`` naming a column,
    rows scanned without a key get a note. Rows marked not ``usable`` (see ``read_fields``)
    have no verdict: every verdict column is NULL. They are kept rather than filtered, for
    the fail mode to resolve; a filter here would be pushed below the JSON reading and run
    it twice.
    """
    usable = F.coalesce("usable", F.lit(False)) if "usable" in df.columns else F.lit(True)
    unsafe = F.coalesce(~F.col("safe"), F.lit(False))
    typed = df.withColumn("_type", taxonomy.threat_type(F.col("threat_type")))
    public_type = F.col("_type")
    advice = taxonomy.guidance(public_type)
    approval = F.col("approval_info") if "approval_info" in df.columns else F.lit(None).cast(APPROVAL_TYPE)
    columns = [
        *keep,
        F.when(usable, ~unsafe).alias("safe"),
        F.when(usable & unsafe, public_type).alias("threat_type"),
        F.when(usable & unsafe, taxonomy.severity(public_type, F.col("severity"))).alias("severity"),
        F.when(usable & unsafe, taxonomy.confidence_level(F.col("confidence_score"))).alias("confidence"),
        F.when(usable, F.coalesce(non_empty(F.col("reason")), F.when(unsafe, advice).otherwise(""))).alias("reason"),
        F.when(usable & unsafe, advice).alias("guidance"),
        F.when(usable, approval).alias("approval_info"),
    ]
    if api_key is not None:
        columns.append(F.when(F.coalesce(F.col(api_key), F.lit("")) == "", F.lit(NO_KEY_NOTE)).alias("note"))
    return typed.select(*columns)


def raw_from_rules(df: DataFrame, position: Column, rules) -> DataFrame:
    """Add the raw fields of the winning rule (see functions.rules) to each row."""
    from contentgate.functions.rules import attribute

    return df.select(
        "*",
        position.isNull().alias("safe"),
        attribute(rules, position, lambda r: r.raw_type, "string").alias("threat_type"),
        F.lit(None).cast("string").alias("severity"),
        attribute(rules, position, lambda r: r.score, "double").alias("confidence_score"),
        attribute(rules, position, lambda r: r.reason, "string").alias("reason"),
    )


def pick_verdicts(findings: DataFrame) -> DataFrame:
    """One verdict per request from a table of findings.

    Highest severity wins, then highest score, then the earliest rule. A maximum over a
    struct combines on the map side, so a request with many findings costs no more to
    shuffle than one with few.
    """
    typed = findings.withColumn("_type", taxonomy.threat_type(F.col("raw_threat_type")))
    typed = typed.withColumn("_severity", taxonomy.severity(F.col("_type")))
    best = F.max(
        F.struct(
            taxonomy.severity_rank(F.col("_severity")).alias("rank"),
            F.coalesce(F.col("confidence_score"), F.lit(0.0)).alias("weight"),
            (-F.col("rule_ord")).alias("order"),
            F.col("rule_id").alias("rule_id"),
            F.col("_type").alias("threat_type"),
            F.col("_severity").alias("severity"),
            F.col("confidence_score").alias("confidence_score"),
        )
    )
    return typed.groupBy("request_id").agg(best.alias("b")).select(
        "request_id",
        "b.rule_id",
        "b.threat_type",
        "b.severity",
        taxonomy.confidence_level(F.col("b.confidence_score")).alias("confidence"),
    )


def internal_columns(schema: T.StructType, prefix: str = "") -> list[str]:
    """Dotted names of schema fields that expose detection internals.

    ``approval_info.policy_name`` is part of the public contract and is not reported.
    """
    found = []
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        if f.name in taxonomy.INTERNAL_FIELDS and path != "approval_info.policy_name":
            found.append(path)
        inner = f.dataType
        while isinstance(inner, T.ArrayType):
            inner = inner.elementType
        if isinstance(inner, T.StructType):
            found.extend(internal_columns(inner, f"{path}."))
    return found


def leak_audit(df: DataFrame, column: str = "raw") -> DataFrame:
    """How many rows of a VARIANT column carry each internal field, at any depth.

    A member's name stands in the JSON text behind a brace or a comma; inside a string its quotes
    are escaped, so text that mentions a field is not counted. ``approval_info.policy_name`` is
    public and not reported.
    """
    body = F.col(column)
    public = variants.field(variants.field(body, "approval_info"), "policy_name").isNotNull().cast("int")
    slim = df.select(F.to_json(body).alias("_json"), public.alias("_public"))

    def present(name: str) -> Column:
        places = F.size(F.split("_json", f'[{{,]"{name}":')) - 1
        return places > F.col("_public") if name == "policy_name" else places > 0

    found = F.array_compact(F.array(*[F.when(present(name), F.lit(name)) for name in taxonomy.INTERNAL_FIELDS]))
    return slim.select(F.explode(found).alias("field")).groupBy("field").agg(F.count(F.lit(1)).alias("n_rows"))
