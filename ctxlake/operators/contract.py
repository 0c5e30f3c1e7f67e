"""Contract checks: documents become node rows, a small rule table says what each must be.

A contract is written as nested kinds and unrolled into one rule per *shape path*
(the path with list positions replaced by ``[]``). Documents are exploded level
by level as VARIANT values, joined with the rules by shape path, and every broken
rule becomes a row. No Python runs and nothing is shuffled: the rule table is a
fixed few dozen rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import variant_kind

_RULE = (
    "shape string, expects string, closed boolean, required array<string>, nullable boolean, "
    "filled boolean, minimum int, allowed array<string>"
)


@dataclass(frozen=True)
class Field:
    """``expects`` is text, bool, score, timestamp, context, object or list."""

    expects: str
    required: bool = False
    nullable: bool = False
    filled: bool = False
    minimum: int = 0
    allowed: tuple[str, ...] = ()
    kind: str | None = None
    items: Field | None = None


@dataclass(frozen=True)
class Kind:
    fields: dict[str, Field] = field(default_factory=dict)
    closed: bool = True


def _unroll(contract: dict[str, Kind], rule: Field, shape: str, out: list[tuple]) -> None:
    kind = contract[rule.kind] if rule.kind else Kind()
    needed = [n for n, f in kind.fields.items() if f.required]
    closed = bool(rule.kind) and kind.closed
    out.append(
        (shape, rule.expects, closed, needed, rule.nullable, rule.filled, rule.minimum, list(rule.allowed))
    )
    for name, child in kind.fields.items():
        _unroll(contract, child, f"{shape}/{name}", out)
    if rule.items:
        _unroll(contract, rule.items, f"{shape}/[]", out)


def rules(contract: dict[str, Kind], top: str) -> list[tuple]:
    out: list[tuple] = []
    _unroll(contract, Field("object", kind=top), "", out)
    return out


def node_rows(frame: DataFrame, document: Column, depth: int) -> DataFrame:
    """Every value of a document down to ``depth``: ``(file_path, path, parent, shape, value)``.

    ``parent`` is the shape of the object a named value is a field of.
    Each level passes earlier nodes on and adds the children of the newest ones, so
    the whole walk is one chain of generators over one read of the documents.
    """
    nodes = frame.select(
        "file_path",
        F.lit("").alias("path"),
        F.lit(None).cast("string").alias("parent"),
        F.lit("").alias("shape"),
        document.alias("value"),
        F.lit(0).alias("level"),
    ).filter("value IS NOT NULL")
    for level in range(depth):
        value = F.col("value")

        def child(step: Column, name: Column, v: Column, owner: Column, at: int = level + 1) -> Column:
            return F.struct(
                F.concat("path", F.lit("/"), step).alias("path"),
                owner.alias("parent"),
                F.concat("shape", F.lit("/"), name).alias("shape"),
                v.alias("value"),
                F.lit(at).alias("level"),
            )

        members = F.transform(
            F.map_entries(F.try_variant_get(value, "$", "map<string,variant>")),
            lambda e: child(e["key"], e["key"], e["value"], F.col("shape")),
        )
        elements = F.transform(
            F.try_variant_get(value, "$", "array<variant>"),
            lambda v, i: child(i.cast("string"), F.lit("[]"), v, F.lit(None).cast("string")),
        )
        own = F.array(F.struct("path", "parent", "shape", "value", "level"))
        none = F.slice(own, 1, 0)
        below = F.when(F.col("level") == level, F.coalesce(members, elements, none)).otherwise(none)
        nodes = nodes.select("file_path", F.inline(F.concat(own, below)))
    return nodes


def timestamp_text(value: Column) -> Column:
    """Text of a timestamp given as a string or as a tagged YAML date."""
    return F.when(variant_kind(value) == "text", F.try_variant_get(value, "$", "string")).otherwise(
        F.try_variant_get(value, "$['$date']", "string")
    )


def document_violations(
    spark: SparkSession, frame: DataFrame, document: Column, contract: dict[str, Kind], top: str
) -> DataFrame:
    """``(file_path, path, rule, message)``, one row per broken rule."""
    table = rules(contract, top)
    closed = [shape for shape, _, is_closed, *_ in table if is_closed]
    depth = max(shape.count("/") for shape, *_ in table)
    checks = spark.createDataFrame(table, _RULE)
    nodes = node_rows(frame, document, depth).withColumn("is", variant_kind(F.col("value")))
    nodes = nodes.join(F.broadcast(checks), "shape", "left")

    expects, actual = F.col("expects"), F.col("is")
    text = F.try_variant_get("value", "$", "string")
    size = F.size(F.try_variant_get("value", "$", "array<variant>"))
    keys = F.map_keys(F.try_variant_get("value", "$", "map<string,variant>"))
    stamp = timestamp_text(F.col("value"))
    empty_ok = F.col("nullable") & (actual == "null")
    right_type = (
        F.when(expects == "score", actual == "number")
        .when(expects == "context", actual.isin("text", "object"))
        .when(expects == "timestamp", stamp.isNotNull())
        .otherwise(actual == expects)
    )
    wanted = F.when(expects == "score", F.lit("number")).when(
        expects == "context", F.lit("string or object")
    ).otherwise(expects)

    def one(when: Column, rule: str, message: Column, path: Column = F.col("path")) -> Column:
        return F.when(when, F.struct(path.alias("path"), F.lit(rule).alias("rule"), message.alias("message")))

    known = expects.isNotNull()
    typed = known & right_type & ~empty_ok
    found = F.array_compact(
        F.array(
            one(
                ~known & F.col("parent").isin(*closed), "unknown_field", F.lit("is not a known field")
            ),
            one(known & ~right_type & ~empty_ok, "type", F.concat(F.lit("must be of type "), wanted)),
            one(typed & F.col("filled") & (text == ""), "required", F.lit("must not be empty")),
            one(
                typed & (F.size("allowed") > 0) & ~F.coalesce(F.array_contains("allowed", text), F.lit(False)),
                "enum",
                F.concat(F.lit("must be one of "), F.array_join("allowed", ", ")),
            ),
            one(
                typed & (expects == "list") & (size < F.col("minimum")),
                "min_items",
                F.lit("has too few entries"),
            ),
            one(
                typed
                & (expects == "score")
                & ~F.coalesce(F.try_variant_get("value", "$", "double").between(0.0, 1.0), F.lit(False)),
                "range",
                F.lit("must be between 0 and 1"),
            ),
            one(
                typed & (expects == "timestamp") & F.try_to_timestamp(stamp).isNull(),
                "timestamp",
                F.lit("is not a readable timestamp"),
            ),
        )
    )
    absent = F.when(
        known & (actual == "object"),
        F.transform(
            F.array_except("required", keys),
            lambda k: F.struct(
                F.concat("path", F.lit("/"), k).alias("path"),
                F.lit("required").alias("rule"),
                F.lit("is required").alias("message"),
            ),
        ),
    )
    return nodes.select(
        "file_path", F.inline(F.when(absent.isNull(), found).otherwise(F.concat(found, absent)))
    )


# --- Open Semantic Interchange contract: fixed values of the published format ---
OSI_VERSION = "0.2.0.dev0"
OSI_DIALECTS = ("ANSI_SQL", "SNOWFLAKE", "MDX", "TABLEAU", "DATABRICKS", "MAQL")

TEXT = Field("text")
TEXTS = Field("list", items=TEXT)


def _one(kind: str, required: bool = False) -> Field:
    return Field("object", required=required, kind=kind)


def _many(kind: str, required: bool = False, minimum: int = 0) -> Field:
    return Field("list", required=required, minimum=minimum, items=_one(kind))


_NAME = Field("text", required=True)
_ANNOTATED = {"ai_context": Field("context", kind="context"), "custom_extensions": _many("extension")}
_DESCRIBED = {"description": TEXT, **_ANNOTATED}
_KEY_COLUMNS = Field("list", required=True, minimum=1, items=TEXT)

OSI_CONTRACT: dict[str, Kind] = {
    "document": Kind(
        {
            "version": Field("text", required=True, allowed=(OSI_VERSION,)),
            "semantic_model": _many("model", required=True),
        }
    ),
    "model": Kind(
        {
            "name": _NAME,
            "datasets": _many("dataset", required=True, minimum=1),
            "relationships": _many("relationship"),
            "metrics": _many("metric"),
            **_DESCRIBED,
        }
    ),
    "dataset": Kind(
        {
            "name": _NAME,
            "source": Field("text", required=True),
            "primary_key": TEXTS,
            "unique_keys": Field("list", items=TEXTS),
            "fields": _many("field"),
            **_DESCRIBED,
        }
    ),
    "field": Kind(
        {
            "name": _NAME,
            "expression": _one("expression", required=True),
            "dimension": _one("dimension"),
            "label": TEXT,
            **_DESCRIBED,
        }
    ),
    "metric": Kind({"name": _NAME, "expression": _one("expression", required=True), **_DESCRIBED}),
    "relationship": Kind(
        {
            "name": _NAME,
            "from": Field("text", required=True),
            "to": Field("text", required=True),
            "from_columns": _KEY_COLUMNS,
            "to_columns": _KEY_COLUMNS,
            **_ANNOTATED,
        }
    ),
    "expression": Kind({"dialects": _many("dialect", required=True, minimum=1)}),
    "dialect": Kind(
        {
            "dialect": Field("text", required=True, allowed=OSI_DIALECTS),
            "expression": Field("text", required=True),
        }
    ),
    "dimension": Kind({"is_time": Field("bool")}),
    "extension": Kind({"vendor_name": Field("text", required=True), "data": Field("text", required=True)}),
    "context": Kind({"instructions": TEXT, "synonyms": TEXTS, "examples": TEXTS}, closed=False),
}


def unreadable(parsed: DataFrame) -> DataFrame:
    return parsed.filter("error IS NOT NULL").select(
        "file_path", F.lit("").alias("path"), F.lit("yaml").alias("rule"), F.col("error").alias("message")
    )


def osi_violations(parsed: DataFrame) -> DataFrame:
    """Unreadable documents and contract violations, with the path inside the document.

    ``parsed`` is read twice, so pass it written when parsing is costly.
    """
    broken = document_violations(
        parsed.sparkSession, parsed, F.try_parse_json("json"), OSI_CONTRACT, "document"
    )
    return broken.unionByName(unreadable(parsed))


class ContractError(ValueError):
    """Faults that end a run; ``violations`` is the whole table of them."""

    def __init__(self, message: str, violations: DataFrame):
        super().__init__(message)
        self.violations = violations


def require_none(violations: DataFrame, what: str) -> None:
    """Fail the run when there is a violation; the message shows three, the error carries the table of all."""
    first = violations.take(3)
    if first:
        shown = "; ".join(f"{r['file_path']} at {r['path']}: {r['message']}" for r in first)
        raise ContractError(f"{what} failed validation: {shown}", violations)
