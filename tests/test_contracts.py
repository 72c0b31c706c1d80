"""Contract validation on hand-written documents."""

import json

from ratebridge.plans import contracts as C


def doc(**over):
    d = {
        "id": "rate_check",
        "version": 1,
        "initial": "start",
        "terminal": ["done"],
        "context_schema": {"amount": {"type": "number", "description": "Loan amount"}},
        "data_products": {"rates": {"owner": "dbt", "relation": "rates_daily", "description": "Rates"}},
        "states": {
            "start": {"label": "S", "component": "A", "purpose": "p", "writes_context": ["amount"],
                      "transitions": [{"event": "go", "target": "review"}]},
            "review": {"label": "R", "component": "B", "purpose": "p", "requires_context": ["amount"],
                       "data": ["rates"], "transitions": [{"event": "back", "target": "start"},
                                                           {"event": "ok", "target": "done"}]},
            "done": {"label": "D", "component": "C", "purpose": "p", "transitions": []},
        },
    }
    d.update(over)
    return d


def run(spark, docs):
    df = spark.createDataFrame([(f"c{i}.json", json.dumps(d)) for i, d in enumerate(docs)], "path string, doc string")
    return sorted((r.path, r.rule, r.message) for r in C.validate(df).collect())


def test_valid_contract_with_cycle_has_no_findings(spark):
    assert run(spark, [doc()]) == []


def test_integrity_findings(spark):
    d = doc(terminal=["done", "closed"])
    d["states"]["review"]["requires_context"] = ["amount", "rate"]
    d["states"]["review"]["data"] = ["rates", "scenarios"]
    d["states"]["done"]["transitions"] = [{"event": "x", "target": "nowhere"}]
    d["states"]["orphan"] = {"label": "O", "component": "O", "purpose": "p",
                             "transitions": [{"event": "x", "target": "island"}]}
    d["states"]["island"] = {"label": "I", "component": "I", "purpose": "p", "transitions": []}
    out = run(spark, [d])
    assert out == sorted([
        ("c0.json", "terminal_state", "terminal state 'closed' does not exist"),
        ("c0.json", "context_key", "state 'review' references unknown context key 'rate'"),
        ("c0.json", "data_product", "state 'review' references unknown data product 'scenarios'"),
        ("c0.json", "transition_target", "state 'done' transitions to unknown state 'nowhere'"),
        ("c0.json", "unreachable", "unreachable states: island, orphan"),
    ])


def test_missing_initial_skips_reachability(spark):
    out = run(spark, [doc(initial="nope")])
    assert out == [("c0.json", "initial_state", "initial state 'nope' does not exist")]


def test_schema_findings_suppress_integrity(spark):
    d = doc(id="Bad Id", version=0, extra=True, initial="nope")
    d["context_schema"]["amount"]["type"] = "money"
    d["data_products"]["rates"]["owner"] = "someone"
    del d["states"]["done"]["purpose"]
    d["states"]["start"]["transitions"].append({"event": "z", "target": "done", "weight": 1})
    d["states"]["review"]["data"] = ["rates", "rates"]
    msgs = [m for _, _, m in run(spark, [d])]
    assert "'Bad Id' does not match '^[a-z][a-z0-9_-]*$'" in msgs
    assert "0 is less than the minimum of 1" in msgs
    assert "Additional properties are not allowed ('extra' was unexpected)" in msgs
    assert "'money' is not one of ['string', 'number', 'integer', 'boolean', 'date']" in msgs
    assert "'someone' is not one of ['dbt', 'webapp', 'superset']" in msgs
    assert "'purpose' is a required property" in msgs
    assert "Additional properties are not allowed ('weight' was unexpected)" in msgs
    assert '["rates","rates"] has non-unique elements' in msgs
    assert not any("initial state" in m for m in msgs)   # integrity skipped for invalid documents


def test_every_type_rule(spark):
    """A wrong type in each section, alone in its document: that finding and no other, no integrity rules."""
    item = "'string', 'number', 'integer', 'boolean'"
    cases = [
        (("version",), "one", "'one' is not of type 'integer'"),
        (("version",), 1.5, "1.5 is not of type 'integer'"),
        (("version",), True, "True is not of type 'integer'"),
        (("terminal",), "zzz", "'zzz' is not of type 'array'"),
        (("terminal",), ["done", None], "None is not of type 'string'"),
        (("terminal",), ["done", 3], "3 is not of type 'string'"),
        (("id",), 5, "5 is not of type 'string'"),
        (("$schema",), [], "[] is not of type 'string'"),
        (("initial",), None, "None is not of type 'string'"),
        (("states",), [], "[] is not of type 'object'"),
        (("states",), {}, "{} should be non-empty"),
        (("states", "done"), None, "None is not of type 'object'"),
        (("states", "done", "label"), 12, "12 is not of type 'string'"),
        (("states", "done", "analytics_event"), False, "False is not of type 'string'"),
        (("states", "done", "transitions"), {}, "{} is not of type 'array'"),
        (("states", "done", "guards"), ["a", "a"], '["a","a"] has non-unique elements'),
        (("states", "done", "transitions"), ["x"], "'x' is not of type 'object'"),
        (("states", "done", "transitions"), [{"event": "e", "target": 7}], "7 is not of type 'string'"),
        (("context_schema",), "none", "'none' is not of type 'object'"),
        (("context_schema", "amount"), [], "[] is not of type 'object'"),
        (("context_schema", "amount", "sensitive"), "yes", "'yes' is not of type 'boolean'"),
        (("context_schema", "amount", "enum"), [1, "1", True, None], f"None is not of type {item}"),
        (("context_schema", "amount", "enum"), [1, 1.0], "[1,1] has non-unique elements"),
        (("context_schema", "amount", "enum"), [["a"]], f'["a"] is not of type {item}'),
        (("data_products", "rates", "freshness_field"), {"a": 1}, '{"a":1} is not of type \'string\''),
        (("data_products", "rates", "relation"), 1e30, "1.0E30 is not of type 'string'"),
    ]
    docs = []
    for path, value, _ in cases:
        d = doc(initial="nowhere")
        at = d
        for key in path[:-1]:
            at = at[key]
        at[path[-1]] = value
        d["initial"] = value if path == ("initial",) else "nowhere"
        docs.append(d)
    out = run(spark, docs)
    assert [(p, m) for p, _, m in out] == sorted((f"c{i}.json", m) for i, (*_, m) in enumerate(cases))


def test_valid_documents_of_unusual_form(spark):
    whole = doc(version=1.0, terminal=[], context_schema={}, data_products={})
    for state in whole["states"].values():
        for name in ("writes_context", "requires_context", "data"):
            state.pop(name, None)
    odd = doc()
    odd["context_schema"]["amount"].update(enum=[1, "1", True, 2.5], unit="kr \u00e5\n\"q\"")
    far = doc(version=10**20)
    assert run(spark, [whole, odd, far]) == []


def test_unreadable_and_other_roots(spark):
    df = spark.createDataFrame([("a", '{"id": '), ("b", None), ("c", "[]"), ("d", "7"), ("e", ""), ("f", '{"id":1,"id":2}')], "path string, doc string")
    got = sorted((r.path, r.rule, r.subject, r.message) for r in C.validate(df).collect())
    unreadable = ("unreadable", "<root>", "the document is not JSON")
    assert got == [("a", *unreadable), ("b", *unreadable), ("c", "schema", "<root>", "[] is not of type 'object'"),
                   ("d", "schema", "<root>", "7 is not of type 'object'"), ("e", *unreadable), ("f", *unreadable)]


def test_unknown_members_are_one_finding(spark):
    d = doc(zeta=1, alpha=2)
    assert run(spark, [d]) == [("c0.json", "schema", "Additional properties are not allowed ('alpha', 'zeta' were unexpected)")]


def test_long_chain_inside_a_document(spark):
    n = 60
    names = [f"s{i:03}" for i in range(n)]
    states = {s: {"label": "L", "component": "A", "purpose": "p", "transitions": [{"event": "n", "target": names[(i + 1) % n]}]} for i, s in enumerate(names)}
    states["lost"] = {"label": "L", "component": "A", "purpose": "p", "transitions": [{"event": "n", "target": "s000"}]}
    d = doc(initial="s007", terminal=[], states=states)
    assert run(spark, [d]) == [("c0.json", "unreachable", "unreachable states: lost")]


def test_validation_is_one_narrow_pass(spark):
    df = spark.createDataFrame([("c.json", json.dumps(doc()))], "path string, doc string")
    plan = C.validate(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "InMemory" not in plan and plan.count("Generate") == 1


def test_missing_required_root_members(spark):
    d = doc()
    del d["states"], d["version"]
    msgs = [m for _, _, m in run(spark, [d])]
    assert "'states' is a required property" in msgs and "'version' is a required property" in msgs


def test_reachability_many_graphs_long_chain(spark):
    from ratebridge.operators.graph import reachable

    n = 20
    edges = spark.createDataFrame([(g, f"s{i}", f"s{i + 1}") for g in range(3) for i in range(n)], "g int, src string, dst string")
    starts = spark.createDataFrame([(0, "s0"), (1, "s5"), (2, "s20")], "g int, node string")
    got = {(r.g, r.node) for r in reachable(edges, starts, ["g"]).collect()}
    assert got == {(0, f"s{i}") for i in range(n + 1)} | {(1, f"s{i}") for i in range(5, n + 1)} | {(2, "s20")}


def test_data_product_resolution(spark):
    d = doc()
    d["data_products"]["bad_rel"] = {"owner": "dbt", "relation": "nope", "description": "x", "freshness_field": "d"}
    d["data_products"]["bad_col"] = {"owner": "dbt", "relation": "rates_daily", "description": "x",
                                     "freshness_field": "funding_date"}
    d["data_products"]["app"] = {"owner": "webapp", "relation": "computed", "description": "x"}
    d["data_products"]["rates"]["freshness_field"] = "rate_date"
    df = spark.createDataFrame([("c.json", json.dumps(d))], "path string, doc string")
    cols = C.catalog_columns(spark, {"rates_daily": spark.createDataFrame([], "rate_date date, policy_rate double")})
    out = sorted((r.rule, r.message) for r in C.validate(df, cols).collect())
    assert out == [
        ("data_product_freshness", "data product 'bad_col' freshness field 'funding_date' is not a column of 'rates_daily'"),
        ("data_product_relation", "data product 'bad_rel' names unknown relation 'nope'"),
    ]


def test_sections_told_by_their_schema(spark):
    """Odd names are quoted as schemas quote them; a null beside texts, which a schema hides, is still found."""
    from pyspark.sql import functions as F

    odd = doc(**{"$schema": "x"})
    odd["states"].update({"a-b": dict(odd["states"]["done"]), "1`2": dict(odd["states"]["done"]), "\u00e9 .": dict(odd["states"]["done"])})
    unknown = doc(more=1)
    hidden = doc()
    hidden["states"]["review"]["transitions"][0]["guard"] = None
    hidden["states"]["review"]["transitions"][1]["guard"] = "g"
    frame = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate([odd, unknown, hidden])], "i int, doc string")
    got = frame.select("i", C.let(F.try_parse_json("doc"), lambda v: C.let(C.typed(v), lambda c: F.struct(
        C.plainly_valid(v, c, F.col("doc")).alias("valid"), C.valid_sections(v, c, F.col("doc")).alias("sections")))).alias("r"))
    sections = ["root.context_schema", "root.data_products", "root.states"]
    assert [(r["i"], r["r"]["valid"], sorted(r["r"]["sections"])) for r in got.orderBy("i").collect()] == [(0, True, sections), (1, False, sections), (2, False, [])]
    assert [(p, m) for p, r, m in run(spark, [hidden]) if r == "schema"] == [("c0.json", "None is not of type 'string'")]
