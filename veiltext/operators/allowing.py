"""Allowlists that are tables: values, values by label, and patterns, each of any size."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import canonical_label
from ..functions.literals import folded, folded_text, required_literal
from ..functions.text import compiles, fold_case, strip
from ..sources.policies import MAX_PATTERN_CHARS, MAX_SUBJECT_CHARS, NESTED_QUANTIFIER

#: Lists of so few entries are tested inside the row; nothing is shuffled then.
IN_PLACE = 2000
#: Characters of the shortest pieces by which patterns are found, and of all: a literal is filed under the longest it can hold.
GRAM = 3
_RUNGS = [GRAM << k for k in range(MAX_PATTERN_CHARS.bit_length()) if GRAM << k <= MAX_PATTERN_CHARS]
#: Between label and value where both are one key.
_BETWEEN = "\u0000"


@dataclass(frozen=True)
class AllowTables:
    """Allowlists as tables: ``values(value)``, ``label_values(label, value)`` and ``patterns(pattern)``.

    Entries that are null or blank do not count.  A pattern allows a span whose whole text it matches, without regard
    to case, as in a policy; one that no policy may hold (too long, nested quantifiers, no pattern) is left out.
    """

    values: DataFrame | None = None
    label_values: DataFrame | None = None
    patterns: DataFrame | None = None

    def keys(self) -> list[tuple[list[str], DataFrame]]:
        """The columns to join spans on, and the folded entries, each once."""
        out = []
        if self.values is not None:
            keys = self.values.select(fold_case(F.col("value")).alias("_key"))
            out.append((["_key"], keys.filter("_key <> ''").distinct()))
        if self.label_values is not None:
            keys = self.label_values.select(
                canonical_label("label").alias("label"), fold_case(F.col("value")).alias("_key")
            )
            out.append((["label", "_key"], keys.filter("label is not null and _key <> ''").distinct()))
        return out

    def usable_patterns(self) -> DataFrame | None:
        """``pattern``: those that a policy could hold, each once."""
        if self.patterns is None:
            return None
        kept = self.patterns.select(strip(F.col("pattern")).alias("pattern")).filter(
            (F.col("pattern") != "")
            & (F.length("pattern") <= MAX_PATTERN_CHARS)
            & ~F.col("pattern").rlike(NESTED_QUANTIFIER)
            & compiles(F.col("pattern"))
        )
        return kept.distinct()


@F.pandas_udf(T.StringType())
def _literal(patterns: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in patterns:
        yield batch.map(lambda p: folded(required_literal(p)))


def _rung(text: Column) -> Column:
    """Characters of the longest pieces that a text holds; null for one too short for any."""
    return F.greatest(F.lit(None).cast("int"), *[F.when(F.length(text) >= n, n) for n in _RUNGS])


def _grams(text: Column, size: Column) -> Column:
    """The different pieces of ``size`` characters of a text; none of a shorter one."""
    starts = F.sequence(F.lit(1), F.length(text) - (size - 1))
    pieces = F.transform(starts, lambda i: text.substr(i, size))
    return F.when(F.length(text) >= size, F.array_distinct(pieces)).otherwise(F.array().cast("array<string>"))


def _filed(sized: DataFrame) -> DataFrame:
    """``pattern, literal, piece``: each of ``sized(pattern, literal, size)`` under its rarest piece."""
    with_piece = sized.filter("size is not null").select("pattern", "literal", F.explode(_grams(F.col("literal"), F.col("size"))).alias("piece"))
    weight = with_piece.groupBy("piece").agg(F.count("*").alias("shared"))
    rarest = F.min_by(F.struct("literal", "piece"), F.struct("shared", "piece")).alias("p")
    return with_piece.join(weight, "piece").groupBy("pattern").agg(rarest).select("pattern", "p.literal", "p.piece")


def _held(values: DataFrame, sizes: list[int]) -> DataFrame:
    """``text, _folded, piece``: each text with each of its pieces of these lengths."""
    pieces = F.flatten(F.array(F.array().cast("array<string>"), *[_grams(F.col("_folded"), F.lit(n)) for n in sizes]))
    return values.select("text", folded_text(F.col("text")).alias("_folded")).withColumn("piece", F.explode(pieces))


def pattern_hits(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """``text``: those of ``texts(text)``, each once, that one of ``patterns(pattern)`` matches as a whole.

    Each pattern is filed under one piece of its longest required literal, the piece that the fewest patterns share, and
    meets only the texts that hold that piece; then the whole literal and the pattern itself are tested.  A piece has more
    than half the characters of the literal (as many as a rung of ``_RUNGS``), so that literals which differ in a number
    have pieces of their own, however many there are; with pieces of a fixed length each would be shared by a part of all.
    Patterns without a literal of three characters (``.*``, ``[0-9]+``) meet every text, block against block: at
    most ``IN_PLACE`` of them are tested in one pass over the texts.
    """
    values = texts.filter(F.length("text") <= MAX_SUBJECT_CHARS).select("text").distinct()
    filed = patterns.select("pattern", _literal("pattern").alias("literal"))
    sized = filed.withColumn("size", _rung(F.col("literal")))
    sizes = sorted(r["size"] for r in sized.select("size").filter("size is not null").distinct().collect())
    index, held = _filed(sized), _held(values, sizes)
    whole = F.expr("rlike(text, concat('(?iu)\\\\A(?:', pattern, ')\\\\z'))")
    met = held.join(index, "piece").filter(F.col("_folded").contains(F.col("literal"))).filter(whole)
    found = met.select("text")
    loose = filed.filter(F.length("literal") < GRAM).select("pattern").orderBy("pattern")
    for group in _groups([r.pattern for r in loose.toLocalIterator()]):
        found = found.union(values.filter(_any_of(F.col("text"), group)))
    return found.distinct()


def _groups(patterns: list[str]) -> Iterator[list[str]]:
    for at in range(0, len(patterns), IN_PLACE):
        yield patterns[at : at + IN_PLACE]


def _any_of(text: Column, patterns: list[str]) -> Column:
    """Whether one of the patterns matches the whole text."""
    return F.exists(F.array(*[F.lit(rf"(?iu)\A(?:{p})\z") for p in patterns]), lambda p: F.rlike(text, p))


def _few(table: DataFrame, columns: list[str]) -> list | None:
    """The rows of a short table, or None."""
    rows = table.select(*columns).limit(IN_PLACE + 1).collect()
    return rows if len(rows) <= IN_PLACE else None


def _pair(label: Column, key: Column) -> Column:
    return F.concat_ws(_BETWEEN, label, key)


def _in_place(allow: AllowTables) -> tuple[list, AllowTables]:
    """Tests of a span for the lists that are short, and the lists that are not."""
    tests, long_values, long_labelled = [], allow.values, allow.label_values
    for on, keys in allow.keys():
        rows = _few(keys, on)
        if rows is None:
            continue
        if on == ["_key"]:
            long_values, known = None, [r["_key"] for r in rows]
            tests.append(lambda e, known=known: fold_case(e["text"]).isin(known) if known else F.lit(False))
        else:
            long_labelled, known = None, [_BETWEEN.join(r) for r in rows]
            tests.append(lambda e, known=known: _pair(e["label"], fold_case(e["text"])).isin(known) if known else F.lit(False))
    return tests, AllowTables(long_values, long_labelled, allow.patterns)


def _listed(spans: DataFrame, allow: AllowTables) -> DataFrame:
    """``_d, _place``: the places of allowed spans; ``spans(_d, _place, label, text)``."""
    found = None
    keyed = spans.withColumn("_key", fold_case(F.col("text")))
    parts = [keyed.join(keys, on, "left_semi") for on, keys in allow.keys()]
    patterns = allow.usable_patterns()
    if patterns is not None:
        parts.append(keyed.join(pattern_hits(spans, patterns), "text", "left_semi"))
    for part in parts:
        hit = part.select("_d", "_place")
        found = hit if found is None else found.union(hit)
    return found


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def drop_listed(records: DataFrame, spans: str, allow: AllowTables) -> DataFrame:
    """Records whose array column ``spans`` has lost the spans that a table allows.

    Lists of at most ``IN_PLACE`` entries are tested inside the row.  For longer ones, and for patterns, records are
    known by what their spans are: a digest of the labels and texts, the same however often, where and in which order
    Spark computes it.  Each different list of spans goes once to the tables; what they allow comes back as places in it.
    A hot list of spans is one row on that side, so Spark can split the join.  Should a plan not give the same spans
    when it runs again (a model that is not deterministic), no digest meets and the spans stay: nothing is ever
    taken for allowed that was not looked up.
    """
    tests, rest = _in_place(allow)
    if tests:
        def stays(e: Column) -> Column:
            hit = tests[0](e)
            for test in tests[1:]:
                hit = hit | test(e)
            return ~F.coalesce(hit, F.lit(False))

        records = records.withColumn(spans, F.filter(spans, stays))
    if rest == AllowTables():
        return records
    if records.isStreaming:
        raise ValueError(f"on a stream, lists of more than {IN_PLACE} entries and patterns need foreachBatch")
    pairs = F.transform(spans, lambda e: F.struct(e["label"].alias("label"), e["text"].alias("text")))
    digest = F.sha2(F.to_json(pairs).cast("binary"), 256)
    # records without spans meet nothing; a number of their own spreads them over the tasks
    plain = [c for c in records.columns if c != spans and _hashable(records.schema[c].dataType)]
    own = F.xxhash64(*plain) if plain else F.lit(0).cast("bigint")
    some = F.size(spans) > 0
    rows = records.withColumn("_d", F.when(some, digest)).withColumn("_salt", F.when(some, F.lit(0)).otherwise(own))
    kinds = rows.filter("_d is not null").groupBy("_d").agg(F.first(spans).alias("_spans"))
    flat = kinds.select("_d", F.posexplode("_spans").alias("_place", "_e")).select("_d", "_place", "_e.label", "_e.text")
    places = _listed(flat, rest).groupBy("_d").agg(F.collect_set("_place").alias("_places"))
    out = rows.join(places.withColumn("_salt", F.lit(0).cast("bigint")), ["_d", "_salt"], "left")
    kept = F.filter(spans, lambda e, i: ~F.array_contains("_places", i))
    out = out.withColumn(spans, F.when(F.col("_places").isNull(), F.col(spans)).otherwise(kept))
    return out.select(*records.columns)


def drop_allowed(
    entities: DataFrame,
    values: DataFrame | None = None,
    label_values: DataFrame | None = None,
    patterns: DataFrame | None = None,
) -> DataFrame:
    """``drop_listed`` over one row per span."""
    allow = AllowTables(values, label_values, patterns)
    out = entities.withColumn("_key", fold_case(F.col("text")))
    for on, keys in allow.keys():
        out = out.join(keys, on, "left_anti")
    usable = allow.usable_patterns()
    if usable is not None:
        out = out.join(pattern_hits(entities.select("text"), usable), "text", "left_anti")
    return out.select(*entities.columns)
