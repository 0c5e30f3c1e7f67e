"""Find, resolve, translate and evaluate governed metrics.

Catalog-wide steps (search, source resolution, dialect choice, formula expansion)
are DataFrame operators. Evaluation reads one model's few definition rows, builds
a DataFrame plan over the business tables from them, and leaves it to Catalyst:
columns no formula names are never read, a "one" side is broadcast only when its
measured size allows it, and a skewed fact key is split by adaptive execution.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import currency, percent, plain_identifier, plain_lookml_sql
from ..operators.search import attach_model_docs
from ..runtime import staged

_QUALIFIED = re.compile(r"\b([A-Za-z_]\w*)\.([A-Za-z_]\w*)")
_AGGREGATE = re.compile(r"\b(SUM|COUNT|AVG|MIN|MAX)\s*\(", re.I)


# --- catalog-wide steps ---


def formula(expressions: Column, dialect: str | None = None) -> Column:
    """One expression text: the requested dialect, else DATABRICKS, else ANSI_SQL."""
    order = [d for d in (dialect, "DATABRICKS", "ANSI_SQL") if d]
    picks = [
        F.try_element_at(F.filter(expressions, lambda e: e["dialect"] == d), F.lit(1))["expression"]
        for d in order
    ]
    return F.coalesce(*picks)


def metric_sources(metrics: DataFrame, datasets: DataFrame) -> DataFrame:
    """Source table and caveats of every dataset a metric's formula names; both are null where the model has no such dataset."""
    named = F.array_distinct(
        F.regexp_extract_all(formula(F.col("expressions")), F.lit(r"\b([A-Za-z_]\w*)\.[A-Za-z_]"), 1)
    )
    wanted = metrics.select(
        "model_name", F.col("name").alias("metric"), F.explode(named).alias("dataset")
    )
    found = datasets.select(
        "model_name", F.col("name").alias("dataset"), "source", F.col("ai_context").alias("dataset_context")
    )
    return wanted.join(found, ["model_name", "dataset"], "left").select(
        "model_name", "metric", "dataset", "source", "dataset_context"
    )


def measure_sources(measures: DataFrame, views: DataFrame) -> DataFrame:
    """LookML measures with the table and caveats of their view."""
    v = views.select(
        F.col("name").alias("view_name"), "sql_table_name", F.col("ai_context").alias("view_context")
    )
    return measures.select("view_name", "measure_name").join(v, "view_name", "left")


def omni_measure_sources(measures: DataFrame, views: DataFrame, models: DataFrame | None = None) -> DataFrame:
    v = views.select("view_name", "schema", "table_name", F.col("description").alias("view_description"))
    resolved = measures.select("view_name", "measure_name").join(v, "view_name", "left")
    return resolved if models is None else attach_model_docs(resolved, models, "schema", "table_name")


_REFERENCE = r"\$\{\s*([A-Za-z_][\w.]*)\s*\}"
_LOCAL_REFERENCE = r"\$\{\s*([A-Za-z_]\w*)\s*\}"


def _with_own_view(sql: Column, view: Column) -> Column:
    """References qualified by view, so they mean the same wherever the text is inlined."""
    plain = F.regexp_replace(plain_lookml_sql(sql), _REFERENCE, r"\${$1}")
    return F.regexp_replace(plain, F.lit(_LOCAL_REFERENCE), F.concat(F.lit(r"\${"), view, F.lit(".$1}")))


def expand_formulas(formulas: DataFrame, fields: DataFrame) -> DataFrame:
    """Replace ``${field}`` by that field's SQL until none is left.

    ``formulas``: ``(view_name, name, sql)``; ``fields``: the same shape, what may be
    referred to. ``${TABLE}.x`` becomes ``x``. Adds ``resolved`` and ``status``:
    ``ok``, ``unknown`` (leads to a field that does not exist, whose reference stays) or
    ``cycle`` (lies on a cycle or leads to one; nothing is replaced).

    Fields are resolved from those without references upwards: a round hands the texts that the
    last one finished to the fields and formulas that name them. The end is reached when
    a round finishes nothing, so chains may have any length.
    """
    shape = ["view_name", "name", "sql", _with_own_view(F.col("sql"), F.col("view_name")).alias("text")]
    single = fields.filter("sql IS NOT NULL").dropDuplicates(["view_name", "name"])
    nodes = formulas.select(F.lit(True).alias("asked"), *shape).unionByName(single.select(F.lit(False).alias("asked"), *shape))
    refs = F.coalesce(F.array_distinct(F.regexp_extract_all("text", F.lit(_REFERENCE), 1)), F.array().cast("array<string>"))
    nodes = staged(nodes.select(F.monotonically_increasing_id().alias("id"), "*", refs.alias("refs")), "formulas")
    known = nodes.filter("NOT asked").select(F.concat("view_name", F.lit("."), "name").alias("ref"))
    open_refs = (
        nodes.select("id", F.explode("refs").alias("ref"))
        .join(known.withColumn("exists", F.lit(True)), "ref", "left")
        .groupBy("id")
        .agg(F.expr("collect_list(ref) FILTER (WHERE exists)").alias("open"), F.expr("count_if(exists IS NULL) > 0").alias("lost"))
    )
    state = nodes.drop("refs").withColumn("resolved", F.col("text")).join(open_refs, "id", "left")
    state = staged(
        state.withColumn("open", F.coalesce("open", F.array().cast("array<string>"))).withColumn("lost", F.coalesce("lost", F.lit(False))),
        "formulas",
    )
    out = ["view_name", "name", "sql", "resolved", "status"]
    done: list[DataFrame] = []
    while True:
        fresh, pending = state.filter("size(open) = 0"), state.filter("size(open) > 0")
        done.append(fresh.filter("asked").withColumn("status", F.when(F.col("lost"), "unknown").otherwise("ok")).select(*out))
        if pending.isEmpty():
            break
        if fresh.isEmpty():
            stuck = pending.filter("asked").withColumn("resolved", F.col("text")).withColumn("status", F.lit("cycle"))
            done.append(stuck.select(*out))
            break
        plain = F.col("text").rlike(r"^(?:[\w.]+|\$\{[\w.]+\})$")
        given = fresh.filter("NOT asked").select(
            F.concat("view_name", F.lit("."), "name").alias("ref"),
            F.when(plain, F.col("resolved")).otherwise(F.concat(F.lit("("), "resolved", F.lit(")"))).alias("given"),
            F.col("lost").alias("given_lost"),
        )
        found = (
            pending.select("id", F.explode("open").alias("ref"))
            .join(given, "ref")
            .groupBy("id")
            .agg(F.collect_list(F.struct("ref", "given")).alias("found"), F.max("given_lost").alias("found_lost"))
        )
        replaced = F.aggregate(
            F.coalesce("found", F.array().cast("array<struct<ref: string, given: string>>")),
            F.col("resolved"),
            lambda acc, e: F.replace(acc, F.concat(F.lit("${"), e["ref"], F.lit("}")), e["given"]),
        )
        left = F.coalesce(F.array_except("open", F.col("found.ref")), F.col("open"))
        state = staged(
            pending.join(found, "id", "left").select(
                "id", "asked", "view_name", "name", "sql", "text",
                replaced.alias("resolved"), left.alias("open"),
                F.expr("lost OR coalesce(found_lost, false)").alias("lost"),
            ),
            "formulas",
        )
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


# Declared aggregate kinds that have a Spark aggregate, with the text that opens the call.
AGGREGATES = {
    "count": "COUNT(",
    "count_distinct": "COUNT(DISTINCT ",
    "sum": "SUM(",
    "average": "AVG(",
    "avg": "AVG(",
    "min": "MIN(",
    "max": "MAX(",
}
_FILTER = r"""([A-Za-z_][\w.]*)\s*:\s*("[^"]*"|'[^']*'|[^\s,"']+)"""
# Filter values with a meaning of their own that is not translated: ranges, relative dates, escapes, lists of conditions.
_SPECIAL = r"""(?i)^(-|>|<|=|!|\[|\(|not\b)|[%^\\]|^(null|empty|yes|no|)$|^-?\d+ to -?\d+$"""
_SPECIAL += r"""|^(last|this|next|before|after|today|yesterday|tomorrow)\b|\b(ago|days?|weeks?|months?|quarters?|years?)$"""


def _filter_clause(pair: Column) -> Column:
    """Condition of one ``field: value``; null where the value is not understood."""
    name = F.substring_index(F.regexp_extract(pair, r"^([\w.]+)", 1), ".", -1)
    raw = F.trim(F.regexp_extract(pair, r"^[\w.]+\s*:\s*(.*)$", 1))
    whole = F.trim(F.regexp_replace(raw, r"^[\"']|[\"']$", ""))
    items = F.transform(F.split(whole, ","), lambda x: F.trim(x))
    quoted = lambda x: F.concat(F.lit("'"), F.replace(x, F.lit("'"), F.lit("''")), F.lit("'"))
    simple = lambda x: ~x.rlike(_SPECIAL)
    rest = lambda x: F.substr(x, F.lit(2))
    listed = lambda f: F.array_join(F.transform(items, f), ",")
    number = r"^(>=|<=|<>|!=|>|<)\s*(-?\d+(?:\.\d+)?)$"
    return (
        F.when(F.forall(items, simple), F.concat(name, F.lit(" IN ("), listed(quoted), F.lit(")")))
        .when(F.upper(whole) == "NULL", F.concat(name, F.lit(" IS NULL")))
        .when(F.upper(whole) == "-NULL", F.concat(name, F.lit(" IS NOT NULL")))
        .when(F.lower(whole) == "yes", name)
        .when(F.lower(whole) == "no", F.concat(F.lit("NOT coalesce("), name, F.lit(", false)")))
        .when(
            F.forall(items, lambda x: x.startswith("-") & simple(rest(x))),
            F.concat(F.lit("("), name, F.lit(" NOT IN ("), listed(lambda x: quoted(rest(x))), F.lit(") OR "), name, F.lit(" IS NULL)")),
        )
        .when(whole.rlike(number), F.concat(name, F.lit(" "), F.regexp_extract(whole, number, 1), F.lit(" "), F.regexp_extract(whole, number, 2)))
        .when(whole.rlike(r"^[\w %.]*%[\w %.]*$") & ~whole.contains("_"), F.concat(name, F.lit(" LIKE "), quoted(whole)))
    )


def measure_formula(kind: Column, sql: Column, filters: Column | None = None) -> Column:
    """Aggregate SQL text of a measure; null when its kind or one of its filters is not supported.

    ``filters`` is the LookML form ``field: "value", other: "value"``. A value may be a text or a comma list of
    texts, the same negated by ``-``, a numeric comparison, a pattern with ``%``, NULL or -NULL, yes or no (without
    quotes too). Anything else makes the measure unsupported, never unfiltered.
    """
    kind = F.lower(kind)
    opened = None
    for name, text in AGGREGATES.items():
        opened = F.when(kind == name, F.lit(text)) if opened is None else opened.when(kind == name, F.lit(text))
    value = F.when(kind == "count", F.coalesce(sql, F.lit("1"))).otherwise(sql)
    if filters is not None:
        clauses = F.transform(F.regexp_extract_all(filters, F.lit(_FILTER), 0), _filter_clause)
        rest = F.regexp_replace(filters, _FILTER, "")
        understood = rest.rlike(r"^[\s,]*$") & ~F.exists(clauses, lambda c: c.isNull())
        guarded = F.concat(F.lit("CASE WHEN "), F.array_join(clauses, " AND "), F.lit(" THEN "), value, F.lit(" END"))
        value = F.when(F.trim(F.coalesce(filters, F.lit(""))) == "", value).when(understood, guarded)
    return F.concat(opened, value, F.lit(")"))


def measure_status(formula: Column) -> Column:
    return F.when(formula.isNull(), "unsupported").otherwise("ok")


def omni_measure_formula(aggregate_type: Column, sql: Column) -> Column:
    return measure_formula(aggregate_type, plain_identifier(sql))


# --- evaluation of one model ---


@dataclass(frozen=True)
class Model:
    """One model's definition rows, small enough to plan from."""

    name: str
    sources: Mapping[str, str]
    keys: Mapping[str, tuple[str, ...]]
    fields: Mapping[str, Mapping[str, str]]
    time_fields: Mapping[str, tuple[str, ...]]
    metrics: Mapping[str, str]
    relationships: Sequence[tuple[str, str, tuple[str, ...], tuple[str, ...]]]


def load_model(tables: Mapping[str, DataFrame], name: str, dialect: str | None = None) -> Model:
    """Read the definition rows of one model (bounded by one document).

    ``tables["osi_field"]`` may carry ``model_name``; without it, fields are told
    apart by dataset name only.
    """
    mine = F.col("model_name") == name
    chosen = formula(F.col("expressions"), dialect).alias("sql")
    fields = tables["osi_field"]
    own = mine
    if "model_name" not in fields.columns:
        names = tables["osi_dataset"].filter(mine).select(F.col("name").alias("dataset_name"))
        fields, own = fields.join(names, "dataset_name", "left_semi"), F.lit(True)
    parts = {
        "dataset": tables["osi_dataset"].filter(mine).select("name", "source", "primary_key"),
        "field": fields.filter(own).select("dataset_name", "name", "is_time_dimension", chosen),
        "metric": tables["osi_metric"].filter(mine).select("name", chosen),
        "link": tables["osi_relationship"].filter(mine).select(
            "from_dataset", "to_dataset", "from_columns", "to_columns"
        ),
    }
    # One job for all four: every row travels as JSON text under its kind.
    rows = None
    for kind, frame in parts.items():
        part = frame.select(F.lit(kind).alias("kind"), F.to_json(F.struct("*")).alias("row"))
        rows = part if rows is None else rows.unionByName(part)
    found: dict[str, list[dict]] = {kind: [] for kind in parts}
    for row in rows.collect():
        found[row["kind"]].append(json.loads(row["row"]))
    if not found["dataset"]:
        raise LookupError(f"no datasets for model {name}")
    sets = [r["name"] for r in found["dataset"]]
    by_set: dict[str, list[dict]] = {s: [] for s in sets}
    for f in found["field"]:
        if f["dataset_name"] in by_set:
            by_set[f["dataset_name"]].append(f)
    return Model(
        name=name,
        sources={r["name"]: r["source"] for r in found["dataset"]},
        keys={r["name"]: tuple(r.get("primary_key") or ()) for r in found["dataset"]},
        fields={s: {f["name"]: f["sql"] for f in by_set[s] if f.get("sql")} for s in sets},
        time_fields={s: tuple(f["name"] for f in by_set[s] if f["is_time_dimension"]) for s in sets},
        metrics={m["name"]: m["sql"] for m in found["metric"] if m.get("sql")},
        relationships=[
            (r["from_dataset"], r["to_dataset"], tuple(r["from_columns"]), tuple(r["to_columns"]))
            for r in found["link"]
        ],
    )


Reader = Callable[[str], DataFrame]


def _datasets_in(model: Model, *texts: str) -> list[str]:
    names = [m.group(1) for t in texts for m in _QUALIFIED.finditer(t)]
    return [n for n in dict.fromkeys(names) if n in model.sources]


def _routes(model: Model, base: str) -> dict[str, list[tuple]]:
    """For each dataset reachable from ``base``, the relationships leading there."""
    routes: dict[str, list[tuple]] = {base: []}
    frontier = [base]
    while frontier:
        here = frontier.pop(0)
        for link in model.relationships:
            if link[0] == here and link[1] not in routes:
                routes[link[1]] = [*routes[here], link]
                frontier.append(link[1])
    return routes


def base_dataset(model: Model, needed: Sequence[str]) -> str:
    """The needed dataset from which all others are reached, many to one."""
    for candidate in needed:
        if set(needed) <= set(_routes(model, candidate)):
            return candidate
    raise ValueError(f"no dataset of model {model.name} reaches all of {', '.join(needed)}")


def _dataset(model: Model, name: str, read: Reader) -> DataFrame:
    """Source columns plus computed fields, addressable as ``<dataset>.<field>``."""
    frame = read(model.sources[name])
    computed = {
        f: sql for f, sql in model.fields[name].items() if f not in frame.columns or sql.strip() != f
    }
    kept = [c for c in frame.columns if c not in computed]
    return frame.select(*kept, *[F.expr(sql).alias(f) for f, sql in computed.items()]).alias(name)


def star(
    model: Model, needed: Sequence[str], read: Reader, base_rows: DataFrame | None = None
) -> DataFrame:
    """Left joins from the base dataset along the relationships to every needed one."""
    base = base_dataset(model, needed)
    routes = _routes(model, base)
    joined = _dataset(model, base, read) if base_rows is None else base_rows.alias(base)
    attached = {base}
    for target in needed:
        for source, to, from_columns, to_columns in routes[target]:
            if to in attached:
                continue
            condition = None
            for a, b in zip(from_columns, to_columns, strict=True):
                pair = F.col(f"{source}.{a}") == F.col(f"{to}.{b}")
                condition = pair if condition is None else condition & pair
            joined = joined.join(_dataset(model, to, read), condition, "left")
            attached.add(to)
    return joined


def _group_columns(group_by: Sequence[str]) -> list[Column]:
    return [F.col(g).alias(g.split(".", 1)[1]) for g in group_by]


def evaluate(
    model: Model,
    metrics: Sequence[str],
    read: Reader,
    *,
    group_by: Sequence[str] = (),
    where: str | None = None,
    grain_safe: bool = False,
) -> DataFrame:
    """Metrics by name, optionally grouped by ``dataset.field``, one column each.

    The formula means the joined rows as they stand, so a sum over a "one" side counts a row once per
    matching fact; ``grain_safe`` counts it once. Where all aggregates combine, facts are reduced before they
    are joined (one scan of them for each relationship that aggregates lead to); else all metrics share
    one pass over one star. A "one" side is taken to be unique in the columns of its relationship.
    """
    formulas = {m: model.metrics[m] for m in metrics}
    needed = _datasets_in(model, *formulas.values(), *group_by, *([where] if where else []))
    conditioned = _datasets_in(model, where) if where else []
    if not grain_safe and len(conditioned) < 2:
        filters = [((conditioned or [base_dataset(model, needed)])[0], F.expr(where))] if where else []
        early = _aggregated_before_join(model, formulas, needed, read, group_by, filters)
        if early is not None:
            return early
    joined = star(model, needed, read)
    if where:
        joined = joined.filter(F.expr(where))
    if grain_safe:
        return _grain_safe(model, formulas, joined, base_dataset(model, needed), group_by)
    return _grouped(joined, group_by, [F.expr(sql).alias(name) for name, sql in formulas.items()])


def _grouped(rows: DataFrame, group_by: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    groups = _group_columns(group_by)
    return rows.groupBy(*groups).agg(*aggregates) if groups else rows.agg(*aggregates)


def _closing(text: str, opened: int) -> int:
    depth, quote = 0, ""
    for i in range(opened, len(text)):
        if quote:
            quote = "" if text[i] == quote else quote
        elif text[i] in "'\"":
            quote = text[i]
        else:
            depth += {"(": 1, ")": -1}.get(text[i], 0)
            if depth == 0:
                return i
    raise ValueError(f"unbalanced formula: {text}")


def _aggregate_terms(formulas: Mapping[str, str]) -> tuple[list[tuple[str, str, str]], dict[str, list[str]]]:
    """Aggregate calls as ``(alias, function, sql)``, and each formula as text pieces
    with the aliases at odd positions."""
    terms: list[tuple[str, str, str]] = []
    pieces: dict[str, list[str]] = {}
    for name, sql in formulas.items():
        parts, at = [], 0
        while match := _AGGREGATE.search(sql, at):
            end = _closing(sql, match.end() - 1) + 1
            terms.append((f"_t{len(terms)}", match.group(1).upper(), sql[match.start() : end]))
            parts += [sql[at : match.start()], terms[-1][0]]
            at = end
        pieces[name] = [*parts, sql[at:]]
    return terms, pieces


# How partial results of an aggregate are combined.
_MERGE = {"SUM": "SUM({0})", "COUNT": "COALESCE(SUM({0}), 0)", "MIN": "MIN({0})", "MAX": "MAX({0})"}
# The same from rows of a "one" side, each standing for ``_n`` facts.
_WEIGHTED = {
    "SUM": "SUM(({0}) * `_n`)",
    "COUNT": "COALESCE(SUM(CASE WHEN ({0}) IS NOT NULL THEN `_n` END), 0)",
    "MIN": "MIN({0})",
    "MAX": "MAX({0})",
}


@dataclass(frozen=True)
class _Term:
    """One aggregate call over the columns of one dataset."""

    alias: str
    function: str
    sql: str
    home: str
    distinct: bool
    kind: str

    def over(self, base: str) -> Column:
        """The aggregate over reduced rows that hold the columns of its dataset."""
        if self.home == base or self.distinct:
            return F.expr(self.sql)
        return F.expr(_WEIGHTED[self.function].format(self.sql[self.sql.index("(") + 1 : -1]))

    def merged(self) -> Column:
        return F.expr(_MERGE[self.function].format(f"`{self.alias}`"))


def _terms_by_dataset(model, terms, base, joined) -> list[_Term] | None:
    """None where a call cannot be combined from partial results."""
    if not terms:
        return None
    kinds = joined.agg(*[F.expr(sql).alias(alias) for alias, _, sql in terms]).schema
    found = []
    for alias, function, sql in terms:
        owners = _datasets_in(model, sql)
        inside = sql[sql.index("(") + 1 : -1]
        distinct = bool(re.match(r"\s*DISTINCT\b", inside, re.I))
        home = owners[0] if owners else base
        several = function == "COUNT" and "," in inside and home != base
        if len(owners) > 1 or function not in _MERGE or (distinct and (home == base or function != "COUNT")) or (several and not distinct):
            return None
        found.append(_Term(alias, function, sql, home, distinct, kinds[alias].dataType.simpleString()))
    return found


def _aggregated_before_join(
    model: Model,
    formulas: Mapping[str, str],
    needed: Sequence[str],
    read: Reader,
    group_by: Sequence[str],
    filters: Sequence[tuple[str, Column]],
) -> DataFrame | None:
    """Reduce rows to their foreign keys before each join, and combine what was aggregated.

    Facts are aggregated per foreign key with their number ``_n``; the reduced rows are joined, reduced to the
    next foreign key, and so on. A key that holds a large share of the facts is a single row in the join. A sum or count
    over a "one" side weighs its rows by ``_n``; least, greatest and distinct values need no weight. Aggregates over
    different relationships of the base are reduced apart, each together with the relationships of groups and
    filters, and meet as groups. ``filters`` are conditions on one dataset each. None where some aggregate mixes
    datasets, counts distinct facts, or cannot be combined.
    """
    base = base_dataset(model, needed)
    routes = _routes(model, base)
    terms, pieces = _aggregate_terms(formulas)
    outside = " ".join(p for parts in pieces.values() for p in parts[::2])
    if set(needed) == {base} or _datasets_in(model, outside) or re.search(r"\b(FILTER|OVER)\b", outside, re.I):
        return None
    found = _terms_by_dataset(model, terms, base, star(model, needed, read))
    if found is None:
        return None
    branch = lambda dataset: {routes[dataset][0]} if dataset != base else set()
    fixed = set().union(*[branch(d) for d in _datasets_in(model, *group_by)], *[branch(d) for d, _ in filters])
    by_branch: dict[frozenset, list[_Term]] = {}
    for term in sorted(found, key=lambda t: t.home == base):
        own = frozenset(fixed | branch(term.home))
        if term.home == base and by_branch:
            own = min(by_branch, key=len)  # any scan of the facts serves
        by_branch.setdefault(own, []).append(term)
    frames = [_reduced(model, base, own, read, group_by, filters) for own in by_branch.values()]
    groups = [g.split(".", 1)[1] for g in group_by]
    texts = {n: "".join(f"`{p}`" if i % 2 else p for i, p in enumerate(parts)) for n, parts in pieces.items()}
    return _side_by_side(frames, groups).select(*groups, *[F.expr(text).alias(n) for n, text in texts.items()])


def _equal(link: tuple) -> Column:
    source, to, left, right = link
    pairs = [F.col(f"{source}.{a}") == F.col(f"{to}.{b}") for a, b in zip(left, right, strict=True)]
    return reduce(lambda x, y: x & y, pairs)


def _reduced(model, base, terms, read, group_by, filters) -> DataFrame:
    """Group columns and the values of ``terms`` by alias; rows are reduced before each join."""
    routes = _routes(model, base)
    named = dict.fromkeys([*(t.home for t in terms), *_datasets_in(model, *group_by), *(d for d, _ in filters)])
    waiting = list(dict.fromkeys(link for dataset in named for link in routes[dataset]))

    def filtered(rows: DataFrame, dataset: str) -> DataFrame:
        return reduce(DataFrame.filter, [condition for d, condition in filters if d == dataset], rows)

    def attach(rows: DataFrame, link: tuple) -> DataFrame:
        return filtered(rows.join(_dataset(model, link[1], read), _equal(link), "left"), link[1])

    rows, here = filtered(_dataset(model, base, read), base), base
    partial: set[str] = set()
    carried: dict[str, str] = {}
    while waiting:
        onward = [link for link in waiting if link[0] == here]
        own = {g: f"_g{i}" for i, g in enumerate(group_by) if g.split(".", 1)[0] == here}
        keys = [F.col(f"{here}.{c}").alias(c) for c in dict.fromkeys(c for link in onward for c in link[2])]
        keys += [*(F.col(n) for n in carried.values()), *(F.col(g).alias(n) for g, n in own.items())]
        number = F.count(F.lit(1)) if here == base else F.sum("_n")
        ready = [t for t in terms if t.alias in partial or t.home == here]
        sums = [(t.merged() if t.alias in partial else t.over(base)).alias(t.alias) for t in ready]
        rows = rows.groupBy(*keys).agg(number.alias("_n"), *sums).alias(here)
        partial |= {t.alias for t in ready}
        carried |= own
        # One side is reduced again; beyond a fork, or from the side of a distinct count, all others are joined as they are.
        last = len(onward) > 1 or any(t.distinct and t.home == onward[0][1] for t in terms)
        for link in waiting if last else onward:
            rows = attach(rows, link)
        waiting = [] if last else [link for link in waiting if link not in onward]
        here = onward[0][1]
    groups = [F.col(carried.get(g, g)).alias(g.split(".", 1)[1]) for g in group_by]
    finals = [t.merged() if t.alias in partial else t.over(base) for t in terms]
    finals = [(c.cast(t.kind) if t.function == "SUM" else c).alias(t.alias) for c, t in zip(finals, terms)]
    return rows.groupBy(*groups).agg(*finals) if groups else rows.agg(*finals)


def _grain_safe(model, formulas, joined, base, group_by) -> DataFrame:
    """Each aggregate over a "one" side sees every row of that side once per group."""
    terms, pieces = _aggregate_terms(formulas)
    outer = {n: "".join(f"`{p}`" if i % 2 else p for i, p in enumerate(parts)) for n, parts in pieces.items()}
    groups = [g.split(".", 1)[1] for g in group_by]
    parts: dict[str, list[tuple[str, str]]] = {}
    for alias, _, sql in terms:
        owners = _datasets_in(model, sql)
        owner = owners[0] if len(owners) == 1 and owners[0] != base else base
        parts.setdefault(owner, []).append((alias, sql))

    def total(owner: str, items: list[tuple[str, str]]) -> DataFrame:
        if owner == base:
            return _grouped(joined, group_by, [F.expr(sql).alias(a) for a, sql in items])
        if not model.keys[owner]:
            raise ValueError(f"dataset {owner} has no primary key")
        used = sorted({m.group(2) for _, sql in items for m in _QUALIFIED.finditer(sql)} | set(model.keys[owner]))
        keep = [F.col(f"{owner}.{c}").alias(f"_c_{c}") for c in used]
        # Rows of facts without a match are not rows of this side.
        rows = joined.filter(F.col(f"{owner}.{model.keys[owner][0]}").isNotNull())
        rows = rows.select(*_group_columns(group_by), *keep).distinct()
        local = [
            F.expr(_QUALIFIED.sub(lambda m: f"`_c_{m.group(2)}`", sql)).alias(a) for a, sql in items
        ]
        return rows.groupBy(*groups).agg(*local) if groups else rows.agg(*local)

    result = _side_by_side([total(owner, items) for owner, items in parts.items()], groups)
    return result.select(*groups, *[F.expr(text).alias(n) for n, text in outer.items()])


def _side_by_side(frames: Sequence[DataFrame], groups: Sequence[str]) -> DataFrame:
    """Frames with one row for each of the same groups, as one."""
    result = frames[0]
    for frame in frames[1:]:
        values = [c for c in frame.columns if c not in groups]
        if not groups:
            for name in values:
                result = result.withColumn(name, frame.select(name).scalar())
            continue
        other = frame.select(*[F.col(g).alias(f"_g_{g}") for g in groups], *values)
        same = None
        for g in groups:
            pair = F.col(g).eqNullSafe(F.col(f"_g_{g}"))
            same = pair if same is None else same & pair
        result = result.join(other, same, "left").drop(*[f"_g_{g}" for g in groups])
    return result


def evaluate_all(model: Model, read: Reader) -> DataFrame:
    """Every metric of a model: ``(metric, value)``, one pass per base dataset."""
    by_base: dict[str, list[str]] = {}
    for name, sql in model.metrics.items():
        by_base.setdefault(base_dataset(model, _datasets_in(model, sql)), []).append(name)
    result = None
    for names in by_base.values():
        wide = evaluate(model, names, read)
        pairs = F.array(
            *[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names]
        )
        long = wide.select(F.inline(pairs))
        result = long if result is None else result.unionByName(long)
    return result


def time_field(model: Model, dataset: str) -> str:
    marked = model.time_fields.get(dataset, ())
    if not marked:
        raise LookupError(f"dataset {dataset} has no time dimension")
    return f"{dataset}.{marked[0]}"


_STEP = {
    "year": "INTERVAL 1 YEAR",
    "quarter": "INTERVAL 3 MONTH",
    "month": "INTERVAL 1 MONTH",
    "week": "INTERVAL 7 DAY",
    "day": "INTERVAL 1 DAY",
}


def year_to_date(
    model: Model, metric: str, read: Reader, *, time: str, year: int, group_by: Sequence[str] = ()
) -> DataFrame:
    """A metric for ``year``; if the data has no such rows, for its latest year.

    Adds ``year``, ``from_time`` and ``to_time``: the range actually used.
    """
    at = F.col(time)
    asked = F.max(F.when(F.year(at) == year, F.date_trunc("year", at)))
    start = F.coalesce(asked, F.date_trunc("year", F.max(at)))
    return _in_period(model, metric, read, time, start, "year", group_by)


def latest_period(
    model: Model, metric: str, read: Reader, *, time: str, grain: str = "month", group_by: Sequence[str] = ()
) -> DataFrame:
    """A metric for the latest period present in the time dimension."""
    start = F.date_trunc(grain, F.max(F.col(time)))
    return _in_period(model, metric, read, time, start, grain, group_by)


def _in_period(model, metric, read, time, start, grain, group_by) -> DataFrame:
    """The bounds are scalar subqueries over the time column alone. They are compared
    with the bare column in its own type, so the main scan can skip by its statistics."""
    dataset = _dataset(model, time.split(".", 1)[0], read)
    kind = dataset.select(time).schema[0].dataType
    bounds = dataset.agg(start.alias("start")).selectExpr("start", f"start + {_STEP[grain]} AS stop")
    low = bounds.select(F.col("start").cast(kind)).scalar()
    high = bounds.select(F.col("stop").cast(kind)).scalar()
    sql = model.metrics[metric]
    needed = _datasets_in(model, sql, time, *group_by)
    inside = (F.col(time) >= low) & (F.col(time) < high)
    formulas = {metric: sql, "from_time": f"MIN({time})", "to_time": f"MAX({time})"}
    result = _aggregated_before_join(model, formulas, needed, read, group_by, [(time.split(".", 1)[0], inside)])
    if result is None:
        rows = star(model, needed, read).filter(inside)
        result = _grouped(rows, group_by, [F.expr(text).alias(name) for name, text in formulas.items()])
    period = F.year("from_time") if grain == "year" else F.date_trunc(grain, "from_time")
    return result.withColumn(grain, period)


def evaluate_measures(rows: DataFrame, measures: Mapping[str, str], group_by: Sequence[str] = ()) -> DataFrame:
    """Measures of one view (name → aggregate SQL) over the view's table, in one pass."""
    aggregates = [F.expr(sql).alias(name) for name, sql in measures.items()]
    return rows.groupBy(*group_by).agg(*aggregates) if group_by else rows.agg(*aggregates)


def presented(result: DataFrame, values: Mapping[str, str], formulas: Mapping[str, str]) -> DataFrame:
    """Values as shown to a reader (``currency`` or ``percent``), with the formula used."""
    shown = {"currency": currency, "percent": percent}
    out = result
    for name, style in values.items():
        out = out.withColumn(f"{name}_shown", shown[style](F.col(name)))
        out = out.withColumn(f"{name}_formula", F.lit(formulas[name]))
    return out
