"""Validation of app state-machine contracts, for any number of documents at once.

Input: ``contracts(path STRING, doc STRING)``, one JSON document per row.
Output rows: ``(path, rule, subject, message)``.

* ``unreadable``: the text is null or not JSON.
* ``schema`` rules: the type of every value, required members, no unknown members,
  enums, the id pattern, the version minimum, non-empty states, unique array items.
* integrity rules, only for documents without schema findings: initial and
  terminal states exist, referenced context keys / data products / transition
  targets exist, every state is reachable from the initial state.

A document is parsed once, to a VARIANT, whose types are checked where they stand
(a typed parse would turn wrong types into nulls). All findings of a document are
one array, computed in its own row, reachability included, and exploded once: one
narrow pass, without shuffle, cache or checkpoint. Only data products, which refer
to the catalog, need a join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values of the contract schema: members and their types, limits ------------------
MEMBERS = {
    "root": {"$schema": "string", "id": "string", "version": "integer", "description": "string", "initial": "string",
             "terminal": "array", "context_schema": "object", "data_products": "object", "states": "object"},
    "context": {"type": "string", "description": "string", "sensitive": "boolean", "unit": "string", "enum": "array"},
    "product": {"owner": "string", "relation": "string", "description": "string", "freshness_field": "string"},
    "state": {"label": "string", "component": "string", "purpose": "string", "requires_context": "array",
              "writes_context": "array", "data": "array", "guards": "array", "analytics_event": "string", "transitions": "array"},
    "transition": {"event": "string", "target": "string", "label": "string", "guard": "string"},
}
REQUIRED = {
    "root": ["id", "version", "initial", "states"],
    "context": ["type", "description"],
    "product": ["owner", "relation", "description"],
    "state": ["label", "component", "purpose", "transitions"],
    "transition": ["event", "target"],
}
#: What the items of a list or the entries of an object with free names are.
CHILDREN = {
    "root.terminal": "name", "root.context_schema": "context", "root.data_products": "product", "root.states": "state",
    "context.enum": "item", "state.requires_context": "name", "state.writes_context": "name", "state.data": "name",
    "state.guards": "name", "state.transitions": "transition",
}
UNIQUE = ["root.terminal", "context.enum", "state.requires_context", "state.writes_context", "state.data", "state.guards"]
NOT_EMPTY = "root.states"
ENUMS = {"context.type": ["string", "number", "integer", "boolean", "date"], "product.owner": ["dbt", "webapp", "superset"]}
ITEM_TYPES = ["string", "number", "integer", "boolean"]
ID_PATTERN = "^[a-z][a-z0-9_-]*$"
LEAST_VERSION = 1
#: Levels of a document below its root: members, entries, their members, items, their members.
DEPTH = 5

OUT = ["path", "rule", "subject", "message"]

#: A valid document as a typed value; members in order of their names, as VARIANT keeps them.
TYPED = (
    "struct<`$schema`:string,"
    "context_schema:map<string,struct<description:string,enum:array<variant>,sensitive:boolean,type:string,unit:string>>,"
    "data_products:map<string,struct<description:string,freshness_field:string,owner:string,relation:string>>,"
    "description:string,id:string,initial:string,"
    "states:map<string,struct<analytics_event:string,component:string,data:array<string>,guards:array<string>,label:string,"
    "purpose:string,requires_context:array<string>,"
    "transitions:array<struct<event:string,guard:string,label:string,target:string>>,writes_context:array<string>>>,"
    "terminal:array<string>,version:long>"
)
FINDINGS = "array<struct<rule:string,subject:string,message:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _quoted(c: Column) -> Column:
    return F.concat(F.lit("'"), c, F.lit("'"))


def _none() -> Column:
    return F.array().cast(FINDINGS)


def _finding(rule: str, subject: Column, message: Column) -> Column:
    return F.struct(F.lit(rule).alias("rule"), subject.alias("subject"), message.alias("message"))


# --- the typed walk ----------------------------------------------------------------------
# A node is a value of a document: its place (``at``), the name of the rules that hold for it
# (``is``: "state" for an entry of states, "state.label" for its member), the type ``wanted`` of
# it (null for a member that is not known), the value and its kind.


def _as_map(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def _as_array(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _number(v: Column) -> Column:
    return F.try_variant_get(v, "$", "double")


def kind_of(v: Column) -> Column:
    """object, array, string, boolean, null or number."""
    names = _literal_map({"STRING": "string", "BOOLEAN": "boolean", "VOID": "null"})
    return let(F.schema_of_variant(v), lambda s: F.when(s.startswith("OBJECT<"), "object").when(s.startswith("ARRAY<"), "array").otherwise(
        F.coalesce(names[s], F.lit("number"))))


def _literal_map(values: dict) -> Column:
    def lit(x):
        return F.array(*[F.lit(i) for i in x]) if isinstance(x, list) else F.lit(x)

    return F.create_map(*[c for k, v in values.items() for c in (F.lit(k), lit(v))])


def _node(at: Column, rules: Column, wanted: Column, v: Column) -> Column:
    return F.struct(at.alias("at"), rules.alias("is"), wanted.alias("wanted"), v.alias("v"), kind_of(v).alias("kind"))


def _record_members() -> Column:
    return F.create_map(*[c for record, members in MEMBERS.items() for c in (F.lit(record), _literal_map(members))])


def children(n: Column) -> Column:
    """Nodes directly below a node that has rules, as an array; null below one that has none."""
    below = F.when(n["is"] == "root", F.lit("")).otherwise(F.concat(n["at"], F.lit(".")))
    child = _literal_map({k: [c, "object" if c in MEMBERS else "string" if c == "name" else "scalar"] for k, c in CHILDREN.items()})[n["is"]]

    def of_record(known: Column) -> Column:
        return F.transform(F.map_entries(_as_map(n["v"])), lambda e: _node(
            F.concat(below, e["key"]), F.concat(n["is"], F.lit("."), e["key"]), known[e["key"]], e["value"]))

    def of_named(child: Column) -> Column:
        return F.transform(F.map_entries(_as_map(n["v"])), lambda e: _node(F.concat(below, e["key"]), child[0], child[1], e["value"]))

    def of_list(child: Column) -> Column:
        return F.transform(_as_array(n["v"]), lambda x, i: _node(F.concat(below, i.cast("string")), child[0], child[1], x))

    is_object = (n["kind"] == "object") & (n["wanted"] == "object")
    record = let(_record_members()[n["is"]], lambda known: F.when(known.isNull(), let(child, of_named)).otherwise(of_record(known)))
    return F.when(is_object, record).when((n["kind"] == "array") & (n["wanted"] == "array"), let(child, of_list))


def nodes(v: Column, skip: Column) -> Column:
    """All nodes of a document, level by level, without the members of the root whose rules are in ``skip`` and what is below."""
    def below(n: Column) -> Column:
        return F.when(n["is"] == "root", F.filter(children(n), lambda x: ~F.array_contains(skip, x["is"]))).otherwise(children(n))

    def deeper(acc: Column, _: Column) -> Column:
        ahead = F.flatten(F.filter(F.transform(acc["last"], below), lambda c: c.isNotNull()))
        return let(ahead, lambda x: F.struct(F.concat(acc["all"], x).alias("all"), x.alias("last")))

    root = F.array(_node(F.lit("<root>"), F.lit("root"), F.lit("object"), v))
    return F.aggregate(F.array(*[F.lit(i) for i in range(DEPTH)]), F.struct(root.alias("all"), root.alias("last")), deeper, lambda acc: acc["all"])


def _shown(n: Column) -> Column:
    """A value as messages show it: texts quoted, lists and objects as JSON."""
    as_json = F.to_json(n["v"])
    return F.when(n["kind"] == "string", _quoted(_text(n["v"]))).when(n["kind"] == "null", "None").when(
        n["kind"] == "boolean", F.initcap(as_json)).otherwise(as_json)


def _alike(items: Column) -> Column:
    """Two items of a list are equal (1 and 1.0 are, 1 and true are not)."""
    same_as = F.transform(items, lambda x: F.when(kind_of(x) == "number", F.concat(F.lit("n"), _number(x).cast("string"))).otherwise(F.to_json(x)))
    return F.size(F.array_distinct(same_as)) < F.size(items)


def suspect(n: Column) -> Column:
    """Not simply a text or boolean where one is wanted."""
    plain = (n["kind"] == n["wanted"]) & n["kind"].isin("string", "boolean") & ~n["is"].isin(*ENUMS, "root.id")
    return n["wanted"].isNotNull() & ~plain


def complaints(n: Column) -> Column:
    """What is wrong with a node itself: an array of messages, those that do not apply null."""
    rules, wanted, kind, v = n["is"], n["wanted"], n["kind"], n["v"]
    fits = (F.when(wanted == "integer", (kind == "number") & (_number(v) % 1 == 0))
            .when(wanted == "scalar", kind.isin("string", "number", "boolean")).otherwise(kind == wanted))
    type_name = F.when(wanted == "scalar", ", ".join(f"'{t}'" for t in ITEM_TYPES)).otherwise(_quoted(wanted))
    no_option = [F.when((rules == name) & ~F.coalesce((kind == "string") & _text(v).isin(options), F.lit(False)),
                        F.concat(_shown(n), F.lit(f" is not one of {options}"))) for name, options in ENUMS.items()]

    def of_record(keys: Column) -> Column:
        known = F.map_keys(_record_members()[rules])
        unexpected = let(F.array_sort(F.array_except(keys, known)), lambda u: F.when(F.size(u) > 0, F.concat(
            F.lit("Additional properties are not allowed ("), F.array_join(F.transform(u, _quoted), ", "),
            F.when(F.size(u) == 1, " was unexpected)").otherwise(" were unexpected)"))))
        missing = F.transform(F.array_except(_literal_map(REQUIRED)[rules], keys), lambda k: F.concat(_quoted(k), F.lit(" is a required property")))
        empty = F.when((rules == NOT_EMPTY) & (F.size(keys) == 0), "{} should be non-empty")
        return F.concat(F.array(empty), F.when(rules.isin(*MEMBERS), F.concat(F.array(unexpected), missing)).otherwise(F.array(F.lit(None).cast("string"))))

    of_value = F.array(
        F.when(~F.coalesce(fits, F.lit(False)), F.concat(_shown(n), F.lit(" is not of type "), type_name)),
        *no_option,
        F.when((rules == "root.id") & (kind == "string") & ~_text(v).rlike(ID_PATTERN), F.concat(_shown(n), F.lit(f" does not match '{ID_PATTERN}'"))),
        F.when((rules == "root.version") & (kind == "number") & (_number(v) < LEAST_VERSION), F.concat(_shown(n), F.lit(f" is less than the minimum of {LEAST_VERSION}"))),
        F.when((kind == "array") & rules.isin(UNIQUE) & _alike(_as_array(v)), F.concat(F.to_json(v), F.lit(" has non-unique elements"))),
    )
    return F.when((kind == "object") & (wanted == "object"), let(F.map_keys(_as_map(v)), of_record)).otherwise(of_value)


# --- findings of a document --------------------------------------------------------------


def schema_findings(v: Column, skip: Column | None = None) -> Column:
    """Findings of a parsed document (VARIANT) about its structure; ``skip``: names of root members known to be valid."""
    skip = F.array().cast("array<string>") if skip is None else skip
    judged = F.transform(F.filter(nodes(v, skip), suspect), lambda n: F.transform(F.filter(complaints(n), lambda m: m.isNotNull()), lambda m: _finding("schema", n["at"], m)))
    return F.flatten(F.filter(judged, lambda found: F.size(found) > 0))


def typed(v: Column) -> Column:
    return F.try_variant_get(v, "$", TYPED)


def _member(name: str, text: Column) -> Column:
    """``name: text`` as schemas show it, null where ``text`` is."""
    return F.concat(F.lit(f"`{name}`: " if name.startswith("$") else f"{name}: "), text)


def _object(members: Column) -> Column:
    return F.concat(F.lit("OBJECT<"), F.array_join(members, ", "), F.lit(">"))


def _strings(c: Column) -> Column:
    return F.when(F.size(c) > 0, F.lit("ARRAY<STRING>")).when(c.isNotNull(), F.lit("ARRAY<VOID>"))


def _entries_schema(entries: Column, of: Callable[[Column], Column]) -> Column:
    def named(e: Column) -> Column:
        plain = e["key"].rlike("^[a-zA-Z_][a-zA-Z0-9_]*$")
        key = F.when(plain, e["key"]).otherwise(F.concat(F.lit("`"), F.replace(e["key"], F.lit("`"), F.lit("``")), F.lit("`")))
        return F.concat(key, F.lit(": "), of(e["value"]))

    return _object(F.transform(F.map_entries(entries), named))


def _record_schema(record: str, e: Column, texts: dict | None = None) -> Column:
    """The schema of a record with the members that ``e`` has, by their wanted types."""
    plain = {"string": "STRING", "boolean": "BOOLEAN", "integer": "BIGINT"}

    def text(name: str, wanted: str) -> Column:
        if texts and name in texts:
            return texts[name]
        return _strings(e[name]) if wanted == "array" else F.when(e[name].isNotNull(), plain[wanted])

    return _object(F.array(*[_member(name, text(name, wanted)) for name, wanted in sorted(MEMBERS[record].items())]))


def _transitions_schema(c: Column) -> Column:
    def shared(name: str) -> Column:
        return _member(name, F.when(F.exists(c, lambda t: t[name].isNotNull()), F.lit("STRING")))

    items = F.concat(F.lit("ARRAY<"), _object(F.array(*[shared(name) for name in sorted(MEMBERS["transition"])])), F.lit(">"))
    return F.when(F.size(c) > 0, items).when(c.isNotNull(), F.lit("ARRAY<VOID>"))


#: Schema that each section of a valid document has, from its typed value.
SECTION_SCHEMAS = {
    "context_schema": lambda c: _entries_schema(c, lambda e: _record_schema("context", e, {"enum": F.lit(None).cast("string")})),
    "data_products": lambda c: _entries_schema(c, lambda e: _record_schema("product", e)),
    "states": lambda c: _entries_schema(c, lambda e: _record_schema("state", e, {"transitions": _transitions_schema(e["transitions"])})),
}


def told_by_schema(doc: Column) -> Column:
    """The schema of the text tells the type of each of its values: it has no null, which an array's schema hides, and no enum."""
    return ~F.contains(doc, F.lit("null")) & ~F.contains(doc, F.lit('"enum"'))


def _whole(a: Column) -> Column:
    return F.coalesce((F.size(F.array_distinct(a)) == F.size(a)) & ~F.exists(a, lambda x: x.isNull()), F.lit(True))


def _required(e: Column, record: str) -> Column:
    return reduce(and_, (e[name].isNotNull() for name in REQUIRED[record]))


def _section_rules(c: Column) -> dict[str, Column]:
    """By section, whether its entries have the required members, options and unique items."""
    def state(e: Column) -> Column:
        lists = [name.split(".")[1] for name in UNIQUE if name.startswith("state.")]
        return _required(e, "state") & F.forall(e["transitions"], lambda t: _required(t, "transition")) & reduce(and_, (_whole(e[n]) for n in lists))

    def context(e: Column) -> Column:
        items = F.forall(e["enum"], lambda x: kind_of(x).isin("string", "number", "boolean")) & ~_alike(e["enum"])
        return _required(e, "context") & e["type"].isin(ENUMS["context.type"]) & F.coalesce(items, F.lit(True))

    def product(e: Column) -> Column:
        return _required(e, "product") & e["owner"].isin(ENUMS["product.owner"])

    def every(entries: Column, holds: Callable[[Column], Column]) -> Column:
        return F.coalesce(F.forall(F.map_values(entries), holds), F.lit(True))

    return {"context_schema": every(c["context_schema"], context), "data_products": every(c["data_products"], product),
            "states": every(c["states"], state) & (F.size(c["states"]) > 0)}


def plainly_valid(v: Column, c: Column, doc: Column) -> Column:
    """A quick test, true only for valid documents: ``v`` has the schema that ``c``, its typed value, would give.

    Then every member is known and of its type; required members, limits and unique items are
    looked at in the typed value. Where a schema does not tell all, both are written and compared as
    texts. Documents that fail (also rare valid ones: 1e0 for 1, say) take the walk.
    """
    texts = {name: F.when(c[name].isNotNull(), of(c[name])) for name, of in SECTION_SCHEMAS.items()}
    alike = F.when(told_by_schema(doc), F.schema_of_variant(v) == _record_schema("root", c, texts)).otherwise(F.to_json(v) == F.to_json(c))
    rules = _required(c, "root") & alike & c["id"].rlike(ID_PATTERN) & (c["version"] >= LEAST_VERSION) & _whole(c["terminal"])
    return F.coalesce(rules & reduce(and_, _section_rules(c).values()), F.lit(False))


def valid_sections(v: Column, c: Column, doc: Column) -> Column:
    """Rules of the sections of a document that are plainly valid (the walk need not enter them)."""
    def valid(name: str, rules: Column) -> Column:
        section = F.try_variant_get(v, f"$.{name}", "variant")
        return c[name].isNotNull() & rules & (F.schema_of_variant(section) == SECTION_SCHEMAS[name](c[name]))

    names = F.array(*[F.when(valid(name, rules), f"root.{name}") for name, rules in _section_rules(c).items()])
    return F.when(told_by_schema(doc), F.array_compact(names)).otherwise(F.array().cast("array<string>"))


def structure_findings(v: Column, c: Column, doc: Column) -> Column:
    """Schema findings of a parsed document with typed value ``c``; sections that are plainly valid are not walked."""
    return let(valid_sections(v, c, doc), lambda skip: schema_findings(v, skip))


def judged(v: Column, of_valid: Callable[[Column], Column], doc: Column) -> Column:
    """Schema findings of a parsed document, or ``of_valid`` of its typed value where there are none."""
    def walked(c: Column) -> Column:
        return let(structure_findings(v, c, doc), lambda found: F.when(F.size(found) > 0, found).otherwise(of_valid(c)))

    return let(typed(v), lambda c: F.when(plainly_valid(v, c, doc), of_valid(c)).otherwise(walked(c)))


def _names(c: Column) -> Column:
    return F.coalesce(c, F.array().cast("array<string>"))


def reference_findings(c: Column) -> Column:
    """Initial and terminal states, context keys, data products and transition targets of a valid
    document (``TYPED``) that it does not declare.

    Declarations and references carry the kind of name in front, so one set difference finds all
    that is missing; only references to those are looked up again.
    """

    def ref(kind: str, rule: str, name: Column, message: Column) -> Column:
        return F.struct(F.concat(F.lit(f"{kind}:"), name).alias("key"), _finding(rule, name, message).alias("finding"))

    def each(names: Column, kind: str, rule: str, before: Column) -> Column:
        return F.transform(_names(names), lambda k: ref(kind, rule, k, F.concat(before, _quoted(k))))

    def of_state(e: Column) -> Column:
        state, body = F.concat(F.lit("state "), _quoted(e["key"])), e["value"]
        unknown = F.concat(state, F.lit(" references unknown context key "))
        return F.concat(
            each(body["requires_context"], "context", "context_key", unknown),
            each(body["writes_context"], "context", "context_key", unknown),
            each(body["data"], "product", "data_product", F.concat(state, F.lit(" references unknown data product "))),
            each(body["transitions"]["target"], "state", "transition_target", F.concat(state, F.lit(" transitions to unknown state "))),
        )

    def absent(what: str, name: Column) -> Column:
        return F.concat(F.lit(f"{what} state "), _quoted(name), F.lit(" does not exist"))

    def keyed(members: Column, kind: str) -> Column:
        return F.transform(_names(F.map_keys(members)), lambda k: F.concat(F.lit(f"{kind}:"), k))

    refs = F.concat(
        F.array(ref("state", "initial_state", c["initial"], absent("initial", c["initial"]))),
        F.transform(_names(c["terminal"]), lambda t: ref("state", "terminal_state", t, absent("terminal", t))),
        F.flatten(F.transform(F.map_entries(c["states"]), of_state)),
    )
    declared = F.concat(keyed(c["states"], "state"), keyed(c["context_schema"], "context"), keyed(c["data_products"], "product"))

    def missing(refs: Column) -> Column:
        return let(F.array_except(refs["key"], declared), lambda gone: F.filter(refs, lambda r: F.array_contains(gone, r["key"]))["finding"])

    return let(refs, missing)


def reached_states(c: Column) -> Column:
    """States of a valid document (``TYPED``) that transitions lead to from the initial state, itself included.

    A fixpoint over (visited, frontier) inside the row, as many steps as there are states; steps
    after the last frontier do nothing.
    """
    targets = F.transform_values(c["states"], lambda _, s: _names(s["transitions"]["target"]))

    def walk(targets: Column) -> Column:
        def step(acc: Column, _: Column) -> Column:
            ahead = F.flatten(F.transform(acc["frontier"], lambda s: _names(targets[s])))
            further = let(F.array_except(ahead, acc["visited"]), lambda new: F.struct(F.concat(acc["visited"], new).alias("visited"), new.alias("frontier")))
            return F.when(F.size(acc["frontier"]) == 0, acc).otherwise(further)

        start = F.array(c["initial"])
        return F.aggregate(F.map_keys(c["states"]), F.struct(start.alias("visited"), start.alias("frontier")), step, lambda acc: acc["visited"])

    return let(targets, walk)


def unreachable_findings(c: Column) -> Column:
    """One finding that names the states of a valid document that are not reached; none without an initial state."""
    lost = F.array_sort(F.array_except(F.map_keys(c["states"]), reached_states(c)))
    message = lambda names: F.concat(F.lit("unreachable states: "), F.array_join(names, ", "))
    found = let(lost, lambda names: F.when(F.size(names) > 0, F.array(_finding("unreachable", F.lit(""), message(names)))).otherwise(_none()))
    return F.when(F.array_contains(F.map_keys(c["states"]), c["initial"]), found).otherwise(_none())


INTEGRITY = (reference_findings, unreachable_findings)


def document_findings(doc: Column, integrity: Sequence[Callable[[Column], Column]] = INTEGRITY) -> Column:
    """All findings of the text of a document."""

    def of_valid(c: Column) -> Column:
        return F.concat(_none(), *[rule(c).cast(FINDINGS) for rule in integrity])

    unreadable = F.array(_finding("unreadable", F.lit("<root>"), F.lit("the document is not JSON")))
    return let(F.try_parse_json(doc), lambda v: F.when(v.isNull(), unreadable).otherwise(judged(v, of_valid, doc)))


def contract_findings(docs: DataFrame, integrity: Sequence[Callable[[Column], Column]] = INTEGRITY) -> DataFrame:
    """(path, rule, subject, message) of a table of documents (path, doc); one narrow pass.

    ``integrity`` are the rules that run on documents without schema findings.
    A member that stands twice in an object makes the document unreadable.
    """
    return docs.select("path", F.inline(document_findings(F.col("doc"), integrity))).select(*OUT)


# --- data products and the catalog -------------------------------------------------------


def catalog_columns(spark, relations: dict) -> DataFrame:
    """``(relation, column)`` for named DataFrames or tables (schema only, no job);
    bounded by the number of columns in the catalog."""
    rows = [(name, c) for name, df in relations.items() for c in df.columns]
    return spark.createDataFrame(rows, "relation string, column string")


def data_products(docs: DataFrame) -> DataFrame:
    """(path, product, owner, relation, freshness_field) of the documents without schema findings."""

    def of(v: Column) -> Column:
        def products(c: Column) -> Column:
            return F.transform(F.map_entries(c["data_products"]), lambda e: F.struct(e["key"].alias("product"), e["value"]["owner"].alias("owner"),
                               e["value"]["relation"].alias("relation"), e["value"]["freshness_field"].alias("freshness_field")))

        return let(typed(v), lambda c: F.when(plainly_valid(v, c, F.col("doc")), products(c)).otherwise(
            F.when(F.size(structure_findings(v, c, F.col("doc"))) == 0, products(c))))

    return docs.select("path", F.inline(let(F.try_parse_json("doc"), of)))


def data_product_errors(docs: DataFrame, columns: DataFrame, owners: Sequence[str] = ("dbt",)) -> DataFrame:
    """Data products owned by the model layer must name an existing relation
    that has the declared freshness field (when one is declared). ``columns``
    is the catalog's (relation, column) list, one row a relation in the join."""
    catalog = columns.groupBy(F.col("relation").alias("__relation")).agg(F.collect_set("column").alias("__columns"))
    dp = data_products(docs).where(F.col("owner").isin(list(owners)))
    dp = dp.join(catalog, F.col("relation") == F.col("__relation"), "left")
    product, relation, field = (F.col(c) for c in ("product", "relation", "freshness_field"))
    no_relation = F.concat(F.lit("data product "), _quoted(product), F.lit(" names unknown relation "), _quoted(relation))
    no_field = F.concat(F.lit("data product "), _quoted(product), F.lit(" freshness field "), _quoted(field), F.lit(" is not a column of "), _quoted(relation))
    found = (F.when(F.col("__columns").isNull(), _finding("data_product_relation", product, no_relation))
             .when(field.isNotNull() & ~F.array_contains("__columns", field), _finding("data_product_freshness", product, no_field)))
    return dp.select("path", found.alias("f")).where("f IS NOT NULL").select("path", "f.*").select(*OUT)


def validate(docs: DataFrame, columns: DataFrame | None = None) -> DataFrame:
    """All findings for a table of contract documents; with ``columns`` those of data products too."""
    out = contract_findings(docs)
    return out if columns is None else out.unionByName(data_product_errors(docs, columns))
