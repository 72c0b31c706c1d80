"""Registered contract-validation queries over contracts synthesised from ``orders``."""

from __future__ import annotations

from ratebridge.plans import contracts as C
from ratebridge.plans.registry import register
from ratebridge.sources import landing as LD

_B = LD.CONTRACT_BLOCK
_CTX_CASE = "CASE st " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LD.STATUS_CONTEXT.items()) + " END"

#: Findings that the faults of LD.CONTRACT_EDITS must give: (number, rule, subject, message).
EDIT_FINDINGS = [
    (0, "schema", "version", "'one' is not of type 'integer'"),
    (1, "schema", "version", "1.5 is not of type 'integer'"),
    (2, "schema", "version", "0.5 is not of type 'integer'"),
    (2, "schema", "version", "0.5 is less than the minimum of 1"),
    (3, "schema", "terminal", "'zzz' is not of type 'array'"),
    (4, "schema", "context_schema.loan_amount.type", "5 is not of type 'string'"),
    (4, "schema", "context_schema.loan_amount.type", "5 is not one of ['string', 'number', 'integer', 'boolean', 'date']"),
    (5, "schema", "context_schema.loan_amount", "Additional properties are not allowed ('range', 'scale' were unexpected)"),
    (5, "schema", "context_schema.loan_amount.sensitive", "'yes' is not of type 'boolean'"),
    (5, "schema", "context_schema.loan_amount.enum", "[null,1,1] has non-unique elements"),
    (5, "schema", "context_schema.loan_amount.enum.0", "None is not of type 'string', 'number', 'integer', 'boolean'"),
    (6, "schema", "data_products.p3.owner", "[\"webapp\"] is not of type 'string'"),
    (6, "schema", "data_products.p3.owner", "[\"webapp\"] is not one of ['dbt', 'webapp', 'superset']"),
    (7, "schema", "states", "[] is not of type 'object'"),
    (8, "unreadable", "<root>", "the document is not JSON"),
    (9, "schema", "initial", "None is not of type 'string'"),
    (10, "schema", "<root>", "[] is not of type 'object'"),
    (12, "schema", "states.broken", "5 is not of type 'object'"),
]
_EDITED = ", ".join("({}, {})".format(n, ", ".join("'" + t.replace("'", "''") + "'" for t in texts)) for n, *texts in EDIT_FINDINGS)

_BASE = f"""
WITH o AS (
  SELECT o_custkey AS ck, o_orderkey // {_B} AS blk, o_orderkey AS k, o_orderstatus AS st, o_orderpriority AS pr,
         lead(o_orderkey) OVER w AS nk, lead(o_orderstatus) OVER w AS nst, lag(o_orderkey) OVER w AS pk
  FROM orders WINDOW w AS (PARTITION BY o_custkey, o_orderkey // {_B} ORDER BY o_orderkey)),
o2 AS (SELECT *, 'contracts/c' || CAST(ck AS VARCHAR) || '_' || CAST(blk AS VARCHAR) || '.json' AS path,
              's' || CAST(k AS VARCHAR) AS name FROM o),
docs AS (SELECT path, ck, min(k) AS k0 FROM o2 GROUP BY path, ck),
schema_errs AS (
  SELECT path, 'schema' AS rule, 'id' AS subject,
         '''C' || CAST(ck AS VARCHAR) || ''' does not match ''{C.ID_PATTERN}''' AS message
  FROM docs WHERE ck % 19 = 0
  UNION ALL
  SELECT path, 'schema', '<root>', 'Additional properties are not allowed (''owner_team'' was unexpected)'
  FROM docs WHERE ck % 17 = 0
  UNION ALL
  SELECT path, 'schema', 'states.' || name, '''purpose'' is a required property' FROM o2 WHERE k % 101 = 0),
plain AS (SELECT *, ck % {LD.CONTRACT_EDIT_CYCLE} AS edit FROM docs WHERE path NOT IN (SELECT path FROM schema_errs)),
type_errs AS (
  SELECT path, rule, subject, message FROM plain JOIN (VALUES {_EDITED}) AS e(edit, rule, subject, message) USING (edit)
  UNION ALL
  SELECT path, 'schema', 'states.' || name || '.transitions.' || CASE WHEN nk IS NOT NULL AND nst <> 'P' THEN '1' ELSE '0' END || '.event',
         '7 is not of type ''string''' FROM o2 JOIN plain USING (path) WHERE edit = 11 AND pk IS NOT NULL
  UNION ALL
  SELECT path, 'schema', 'states.s' || k0 || '.label', k0 || ' is not of type ''string''' FROM plain WHERE edit = {len(LD.CONTRACT_EDITS)}
  UNION ALL
  SELECT path, 'schema', 'states.s' || k0 || '.transitions', '{{}} is not of type ''array''' FROM plain WHERE edit = {len(LD.CONTRACT_EDITS) + 1}),
ok AS (SELECT * FROM plain WHERE path NOT IN (SELECT path FROM type_errs)),
okst AS (SELECT o2.* FROM o2 JOIN ok USING (path))"""

_VIOLATIONS = _BASE + f"""
SELECT path, rule, subject, message FROM schema_errs
UNION ALL
SELECT path, rule, subject, message FROM type_errs
UNION ALL
SELECT path, 'initial_state', 'start', 'initial state ''start'' does not exist' FROM ok WHERE ck % 13 = 0
UNION ALL
SELECT path, 'terminal_state', 'closed', 'terminal state ''closed'' does not exist'
FROM ok WHERE ck % 11 = 0
UNION ALL
SELECT path, 'context_key', ctx, 'state ''' || name || ''' references unknown context key ''' || ctx || ''''
FROM (SELECT *, {_CTX_CASE} AS ctx FROM okst) s
WHERE ctx <> 'loan_amount' AND NOT (ctx = 'current_rate' AND ck % 2 = 0)
UNION ALL
SELECT path, 'data_product', 'p5', 'state ''' || name || ''' references unknown data product ''p5''' FROM okst
WHERE pr = '5-LOW'
UNION ALL
SELECT path, 'transition_target', 'x' || CAST(k AS VARCHAR),
       'state ''' || name || ''' transitions to unknown state ''x' || CAST(k AS VARCHAR) || '''' FROM okst
WHERE pr = '5-LOW'"""

_UNREACHABLE = _BASE + """,
edges AS (
  SELECT path, name AS src, 's' || CAST(nk AS VARCHAR) AS dst FROM okst WHERE nk IS NOT NULL AND nst <> 'P'
  UNION ALL
  SELECT path, name, 's' || CAST(pk AS VARCHAR) FROM okst WHERE pk IS NOT NULL),
reach AS (
  WITH RECURSIVE r(path, node) AS (
    SELECT path, 's' || CAST(k0 AS VARCHAR) FROM ok WHERE ck % 13 <> 0
    UNION
    SELECT e.path, e.dst FROM r JOIN edges e ON e.path = r.path AND e.src = r.node)
  SELECT * FROM r)
SELECT path, 'unreachable' AS rule, '' AS subject,
       'unreachable states: ' || string_agg(name, ', ' ORDER BY name) AS message
FROM okst s
WHERE ck % 13 <> 0 AND NOT EXISTS (SELECT 1 FROM reach r WHERE r.path = s.path AND r.node = s.name)
GROUP BY path"""


@register("contract_violations", _VIOLATIONS)
def q_contract_violations(spark, sf_dir):
    """Structure and reference findings for every synthesised contract."""
    return C.contract_findings(LD.contract_documents(spark, sf_dir), [C.reference_findings])


@register("contract_unreachable", _UNREACHABLE)
def q_contract_unreachable(spark, sf_dir):
    """States no path from the initial state reaches, one row per contract."""
    return C.contract_findings(LD.contract_documents(spark, sf_dir), [C.unreachable_findings]).where("rule = 'unreachable'")


# Relations the contracts may reference, with their columns (the marts' declared outputs).
MODEL_COLUMNS = {
    "rates_daily": ["rate_date"],
    "bank_margin_analysis": ["bank", "period_label", "scrape_date", "funding_date"],
    "bank_vs_market_analysis": ["bank", "period_label", "funding_date", "scb_period_month"],
}
_CATALOG = "(VALUES " + ", ".join(f"('{r}', '{c}')" for r, cs in MODEL_COLUMNS.items() for c in cs) + ") AS cat(relation, col)"
_MSG_REL = "'data product ''' || product || ''' names unknown relation ''' || relation || ''''"
_MSG_COL = ("'data product ''' || product || ''' freshness field ''' || field || ''' is not a column of ''' "
            "|| relation || ''''")

_PRODUCTS = _BASE + f""",
prods AS (
  SELECT path, 'p4' AS product,
         CASE WHEN ck % 7 = 0 THEN 'rates_weekly' ELSE 'bank_vs_market_analysis' END AS relation,
         CASE WHEN ck % 3 = 0 THEN 'scrape_date' ELSE 'funding_date' END AS field
  FROM ok
  UNION ALL SELECT path, 'p1', 'rates_daily', 'rate_date' FROM ok
  UNION ALL SELECT path, 'p2', 'bank_margin_analysis', 'scrape_date' FROM ok),
cat AS (SELECT * FROM {_CATALOG})
SELECT path, 'data_product_relation' AS rule, product AS subject, {_MSG_REL} AS message
FROM prods p WHERE NOT EXISTS (SELECT 1 FROM cat c WHERE c.relation = p.relation)
UNION ALL
SELECT path, 'data_product_freshness', product, {_MSG_COL}
FROM prods p
WHERE EXISTS (SELECT 1 FROM cat c WHERE c.relation = p.relation)
  AND NOT EXISTS (SELECT 1 FROM cat c WHERE c.relation = p.relation AND c.col = p.field)"""


@register("contract_data_products", _PRODUCTS)
def q_contract_data_products(spark, sf_dir):
    """Model-owned data products must resolve to a relation with their freshness field."""
    cols = spark.createDataFrame([(r, c) for r, cs in MODEL_COLUMNS.items() for c in cs],
                                 "relation string, column string")
    return C.data_product_errors(LD.contract_documents(spark, sf_dir), cols)
