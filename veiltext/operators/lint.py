"""Policies of many tenants, as a table: check each one, and overlay it on the defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import empty_array, let
from ..functions.labels import canonical_label
from ..functions.text import compiles, strip
from ..sources.policies import DEFAULT_MODEL, MAX_PATTERN_CHARS, NESTED_QUANTIFIER, RULES, Rule

_VIOLATION = "struct<path:string,rule:string,value:string>"
_NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "INT", "SMALLINT", "TINYINT")


def _kind(value: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.schema_of_variant(value), r"\A\w+", 0), F.lit("VOID"))


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _number(value: Column) -> Column:
    return F.try_variant_get(value, "$", "double")


def _violation(path: Column, rule: Column | str, value: Column) -> Column:
    return F.struct(
        path.alias("path"),
        (F.lit(rule) if isinstance(rule, str) else rule).alias("rule"),
        value.alias("value"),
    )


def _at(doc: Column, path: str, null: bool) -> Column:
    """The variant at a path; null for a missing field and, if ``null``, for an explicit null."""
    value = F.try_variant_get(doc, f"$.{path}", "variant")
    return F.when(~F.is_variant_null(value), value) if null else value


def _one(doc: Column, rule: Rule, fault_of) -> Column:
    """The violation of a single field, if any; ``fault_of`` gives its rule or null."""

    def check(v: Column) -> Column:
        fault = F.when(v.isNotNull(), fault_of(v))
        return F.when(
            fault.isNotNull(), F.array(_violation(F.lit(rule.path), fault, _text(v)))
        ).otherwise(empty_array(_VIOLATION))

    return let(_at(doc, rule.path, rule.null), check)


def _each(doc: Column, rule: Rule, faults_of) -> Column:
    """The violations among the fields of an object; ``faults_of(path, value)`` gives those of one."""

    def check(v: Column) -> Column:
        fields = F.map_entries(v.cast("map<string,variant>"))
        found = F.flatten(
            F.transform(
                fields, lambda e: faults_of(F.concat(F.lit(f"{rule.path}."), e["key"]), e["value"])
            )
        )
        return (
            F.when(_kind(v) == "OBJECT", found)
            .when(
                v.isNotNull(), F.array(_violation(F.lit(rule.path), F.lit("not_object"), _text(v)))
            )
            .otherwise(empty_array(_VIOLATION))
        )

    return let(_at(doc, rule.path, rule.null), check)


def _single(fault_of):
    """``faults_of`` for an object of scalars."""

    def faults(path: Column, v: Column) -> Column:
        return F.filter(
            F.array(_violation(path, fault_of(v), _text(v))), lambda x: x["rule"].isNotNull()
        )

    return faults


def _boolean(v: Column) -> Column:
    return F.when(_kind(v) != "BOOLEAN", F.lit("not_boolean"))


def _among(names: tuple[str, ...]):
    def rule(v: Column) -> Column:
        ok = (_kind(v) == "STRING") & _text(v).isin(*names)
        return F.when(~F.coalesce(ok, F.lit(False)), F.lit("bad_enum"))

    return rule


def _share(v: Column) -> Column:
    n = _number(v)
    return F.when(~_kind(v).isin(*_NUMBERS), F.lit("not_number")).when(
        F.isnan(n) | (n < 0) | (n > 1), F.lit("out_of_range")
    )


def _positive(v: Column) -> Column:
    n = _number(v)
    return F.when(
        ~_kind(v).isin(*_NUMBERS) | (n < 1) | (n != F.floor(n)), F.lit("not_positive_integer")
    )


def _entries(path: Column, v: Column, fault_of=None) -> Column:
    """Violations of a list of strings: that it is one, that all entries are strings, and ``fault_of`` each."""

    def one(x: Column) -> Column:
        fault = F.when(_kind(x) != "STRING", F.lit("not_string"))
        if fault_of is not None:
            fault = fault.otherwise(fault_of(strip(_text(x))))
        return _violation(path, fault, _text(x))

    found = F.transform(v.cast("array<variant>"), one)
    return F.when(
        _kind(v) == "ARRAY", F.filter(found, lambda x: x["rule"].isNotNull())
    ).otherwise(F.array(_violation(path, F.lit("not_array"), _text(v))))


def _list(doc: Column, rule: Rule, fault_of=None) -> Column:
    def check(v: Column) -> Column:
        return F.when(v.isNotNull(), _entries(F.lit(rule.path), v, fault_of)).otherwise(
            empty_array(_VIOLATION)
        )

    return let(_at(doc, rule.path, rule.null), check)


def _strings_of(value: Column) -> Column:
    """The usable entries of a list of strings: trimmed, not blank."""

    def read(v: Column) -> Column:
        texts = F.filter(v.cast("array<variant>"), lambda x: _kind(x) == "STRING")
        return F.when(
            _kind(v) == "ARRAY",
            F.filter(F.transform(texts, lambda x: strip(_text(x))), lambda s: s != ""),
        ).otherwise(empty_array("string"))

    return let(value, read)


def _strings(doc: Column, path: str) -> Column:
    return _strings_of(F.try_variant_get(doc, f"$.{path}", "variant"))


def _pattern_fault(p: Column) -> Column:
    return (
        F.when(p == "", F.lit(None).cast("string"))
        .when(F.length(p) > MAX_PATTERN_CHARS, F.lit("pattern_too_long"))
        .when(p.rlike(NESTED_QUANTIFIER), F.lit("nested_quantifier"))
        .when(~compiles(p), F.lit("invalid_regex"))
    )


def _violations(doc: Column, rule: Rule) -> Column:
    """The violations of one row of the rule table."""
    scalars = {"flag": _boolean, "choice": _among(rule.choices), "share": _share, "count": _positive}
    if rule.kind in scalars:
        return _one(doc, rule, scalars[rule.kind])
    if rule.kind in ("choices", "shares"):
        return _each(doc, rule, _single(scalars[rule.kind.removesuffix("s")]))
    if rule.kind == "lists":
        return _each(doc, rule, _entries)
    if rule.kind == "object":
        return _each(doc, rule, lambda path, v: empty_array(_VIOLATION))
    return _list(doc, rule, _pattern_fault if rule.kind == "patterns" else None)


def policy_lint(policies: DataFrame) -> DataFrame:
    """One row per violation of ``(policy_id, config)``; a policy without any is fit to load.

    Rules: ``not_json, not_object, not_boolean, bad_enum, not_number,
    out_of_range, not_positive_integer, not_array, not_string,
    pattern_too_long, nested_quantifier, invalid_regex``.
    """
    parsed = policies.select("policy_id", "config", F.try_parse_json("config").alias("doc"))
    doc = F.col("doc")
    found = F.concat(*[_violations(doc, rule) for rule in RULES])
    broken = F.array(_violation(F.lit("$"), F.lit("not_json"), F.col("config")))
    rows = F.when(_kind(doc) == "OBJECT", found).otherwise(broken)
    return parsed.select("policy_id", F.inline(rows))


def _last_by_label(config: Column, doc: Column, path: str, read) -> Column:
    """An object's fields under canonical labels; of fields that fall together the last one stays.

    A variant sorts its keys, so their order is read from the JSON text.
    """

    def kept(fields: Column) -> Column:
        keys = F.json_object_keys(F.get_json_object(config, f"$.{path}"))
        entries = F.transform(
            keys, lambda k: F.struct(canonical_label(k).alias("label"), read(fields[k]).alias("value"))
        )
        return let(
            entries,
            lambda es: F.filter(
                es,
                lambda e, i: ~F.exists(
                    F.slice(es, i + 2, F.size(es)), lambda later: later["label"] == e["label"]
                ),
            ),
        )

    value = F.try_variant_get(doc, f"$.{path}", "variant")
    fields = F.when(_kind(value) == "OBJECT", value.cast("map<string,variant>"))
    return F.coalesce(let(fields, kept), F.array())


def effective_policies(policies: DataFrame) -> DataFrame:
    """``(policy_id, config)`` overlaid on the defaults: one typed row per policy.

    A field with the wrong type reads as missing here; ``policy_lint`` names it.  Lists by label
    are arrays of ``(label, value)`` in document order.
    """
    df = policies.select("policy_id", "config", F.try_parse_json("config").alias("doc"))
    doc, config = F.col("doc"), F.col("config")
    get = lambda path, ddl, default: F.coalesce(
        F.try_variant_get(doc, f"$.{path}", ddl), F.lit(default)
    )
    threshold = F.try_variant_get(doc, "$.confidence_threshold", "variant")
    return df.select(
        "policy_id",
        get("enabled", "boolean", True).alias("enabled"),
        get("guardrail_mode", "string", "redact").alias("guardrail_mode"),
        get("redactStrategy", "string", "token").alias("redact_strategy"),
        get("model", "string", DEFAULT_MODEL).alias("model"),
        F.when(F.is_variant_null(threshold), 0.0)
        .otherwise(get("confidence_threshold", "double", 0.5))
        .alias("confidence_threshold"),
        get("auditEnabled", "boolean", True).alias("audit_enabled"),
        get("maxPendingRequests", "int", 50).alias("max_pending"),
        _strings_of(F.try_variant_get(doc, "$.custom_entities", "variant")).alias("custom_entities"),
        _last_by_label(config, doc, "entityActions", _text).alias("entity_actions"),
        _last_by_label(config, doc, "entityConfidenceThresholds", _number).alias("entity_thresholds"),
        F.array_distinct(_strings(doc, "allowlist.values")).alias("allow_values"),
        F.array_distinct(_strings(doc, "allowlist.patterns")).alias("allow_patterns"),
        _last_by_label(
            config, doc, "allowlist.entities", lambda v: F.array_distinct(_strings_of(v))
        ).alias("allow_entities"),
    )
