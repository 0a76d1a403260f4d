"""DuckDB oracle SQL for the registered queries.

Each query's oracle is ``WITH <the CTEs it needs> <final select>``.  The extracts are the
SQL twins of ``sources.fixtures``.  The build steps follow the operators' definitions by
another way than the Spark code takes: staging from the column specs, the merge as a fold
by key, first rows by ``arg_min``, KPI rates by grouping sets, the label by its truth table.
Column names, labels and thresholds are fixed values of the tables.
"""

from __future__ import annotations

from projectpulse.operators.cleaning import CONTRACT_SPEC, OUTCOME_SPEC, PROGRAM_SPEC
from projectpulse.operators.merge import PROGRAM_OUTCOME_LABELS, PROJECT_COLUMNS

TS_TEXT = "'%-m/%-d/%Y %-I:%M:%S %p'"

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body)


def with_ctes(final_sql: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return final_sql
    parts = ",\n".join(f"{n} AS (\n{CTES[n][1]}\n)" for n in order)
    return f"WITH {parts}\n{final_sql}"


def money(x: str) -> str:
    return f"CAST(CAST(floor({x}) AS BIGINT) AS VARCHAR)"


def ts_text(days: int, hour_expr: str) -> str:
    return f"strftime(o_orderdate + INTERVAL {days} DAY + to_hours({hour_expr}), {TS_TEXT})"


cte("ocn", (), """
SELECT o.*, c.c_mktsegment, n.n_name
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey""")

cte("raw_syip", ("ocn",), f"""
SELECT CASE WHEN o_orderkey % 97 = 1 THEN -o_orderkey ELSE o_orderkey END AS UPC,
  '  ' || n_name || ' ' AS DISTRICT_CODE_DESC,
  o_orderpriority || ' ' AS STATE_HIGHWAY_DESC,
  CASE WHEN o_orderkey % 1009 = 0 THEN NULL WHEN o_orderkey <= 64 THEN 'RARE'
       ELSE ' ' || c_mktsegment END AS SCOPE_OF_WORK_DESC,
  o_orderstatus AS POOL_PRJ_STATUS_DSC,
  CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS HAS_PE,
  CASE WHEN o_orderkey % 3 = 0 THEN 'true' ELSE 'false' END AS HAS_RW,
  CASE WHEN o_orderstatus = 'O' THEN 'false' ELSE 'true' END AS HAS_CN,
  {ts_text(0, 'o_orderkey % 24')} AS PE_START_DATE,
  CASE WHEN o_orderkey % 3 = 0 THEN {ts_text(30, '(o_orderkey + 5) % 24')} END AS RW_START_DATE,
  {ts_text(90, '(o_orderkey + 11) % 24')} AS CN_START_DATE,
  CASE WHEN o_orderstatus = 'F' THEN {ts_text(400, '(o_orderkey + 17) % 24')} END AS CN_END_DATE,
  CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 29 = 0 THEN '0'
       ELSE {money('o_totalprice')} END AS TOTAL_ALLOCATIONS_CURRENT,
  {money('o_totalprice * 6 / 10')} AS Y1_Y6_ALLOCATIONS,
  {money('o_totalprice / 10')} AS CURRENT_PE_ESTIMATE,
  CASE WHEN o_orderkey % 3 = 0 THEN {money('o_totalprice / 20')} END AS CURRENT_RW_ESTIMATE,
  {money('o_totalprice * 8 / 10')} AS CURRENT_CN_ESTIMATE,
  CASE WHEN o_orderkey % 31 = 0 THEN NULL
       ELSE {money('o_totalprice * (o_orderkey % 7 + 7) / 10')} END AS TOTAL_EST_CURRENT,
  CAST(year(o_orderdate) AS VARCHAR) AS CURRENT_YEAR
FROM ocn
WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'""")

def staged(table: str, spec) -> str:
    """A staged table: one expression per line of the column spec, by the kind of the column."""
    how = {"keep": "{0}", "text": "trim({0}, ' ' || chr(160))", "bool": "({0} = 'true')", "double": "CAST({0} AS DOUBLE)",
           "int": "CAST({0} AS INTEGER)", "date": "CAST({0} AS DATE)",
           "ts_text_date": "CAST(strptime(split_part({0}, ' ', 1), '%m/%d/%Y') AS DATE)"}
    return "SELECT " + ",\n  ".join(f"{how[c.kind].format(c.src)} AS {c.dst}" for c in spec) + f"\nFROM {table}"


cte("stg_syip", ("raw_syip",), staged("raw_syip", PROGRAM_SPEC))

cte("first_flag", (), """
SELECT l_orderkey, min(l_returnflag) AS ft FROM lineitem GROUP BY l_orderkey""")

cte("raw_dashboard", ("ocn", "first_flag"), f"""
SELECT o_orderkey AS UPC, '  ' || n_name AS DISTRICT, ' ' || o_orderpriority AS ROAD_SYSTEM,
  CASE WHEN o_orderkey <= 64 THEN 'RARE' ELSE c_mktsegment END AS SCOPE_OF_WORK,
  o_orderstatus AS PROJECT_STATUS,
  {money('o_totalprice * 9 / 10')} AS BUDGET,
  {money('o_totalprice')} AS ESTIMATE,
  'FY' || CAST(year(o_orderdate) AS VARCHAR) AS FISCAL_YEAR,
  CASE ft WHEN 'R' THEN 'R' WHEN 'N' THEN 'Y' ELSE 'G' END AS ON_TIME_STATUS,
  CASE ft WHEN 'R' THEN ' Late acceptance ' WHEN 'N' THEN 'Pending work' ELSE 'On schedule' END
    AS ON_TIME_STATUS_REASON,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL
       WHEN o_totalprice > 300000 AND o_orderstatus = 'F' THEN 'R'
       WHEN o_totalprice > 250000 THEN 'Y' ELSE 'G' END AS ON_BUDGET_STATUS,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL
       WHEN o_totalprice > 250000 THEN 'Estimate above budget ' ELSE 'Within budget' END
    AS ON_BUDGET_STATUS_REASON
FROM ocn LEFT JOIN first_flag ON first_flag.l_orderkey = ocn.o_orderkey
WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'""")

cte("stg_dashboard", ("raw_dashboard",), staged("raw_dashboard", OUTCOME_SPEC))

# The merge without an outer join: the rows of both sides under one another, folded by key.  Keys are
# unique on each side, so max() finds the one value that a side has; rows without a key stay apart.
MERGE_SIDES = {"l": ("stg_syip", 1), "r": ("stg_dashboard", 2)}


def merged(columns, labels) -> str:
    both, left, right = labels
    rows = []
    for side, (table, source) in MERGE_SIDES.items():
        picks = []
        for out, lc, rc in columns:
            for s, c in (("l", lc), ("r", rc)):
                if c:
                    picks.append(f"{c if s == side else 'NULL'} AS {s}_{out}")
        rows.append(f"SELECT upc, {source} AS source, "
                    f"CASE WHEN upc IS NULL THEN row_number() OVER () * 2 + {source} ELSE 0 END AS apart, "
                    + ", ".join(picks) + f" FROM {table}")
    outs = []
    for out, lc, rc in columns:
        parts = [f"max({s}_{out})" for s, c in (("l", lc), ("r", rc)) if c]
        outs.append(f"{parts[0] if len(parts) == 1 else 'ifnull(' + ', '.join(parts) + ')'} AS {out}")
    label = (f"['{left}', '{right}', '{both}'][CAST(CASE WHEN upc IS NULL THEN 2 ELSE sum(source) END AS BIGINT)]")
    return f"SELECT upc, {label} AS data_source, {', '.join(outs)}\nFROM (" + "\nUNION ALL ".join(rows) + ") s GROUP BY upc, apart"


cte("projects", ("stg_syip", "stg_dashboard"), merged(PROJECT_COLUMNS, PROGRAM_OUTCOME_LABELS))

cte("raw_contracts", (), """
SELECT DISTINCT k AS CONTRACT_ID, upc AS UPC,
  'D' || CAST(k % 9 AS VARCHAR) || ' ' AS DISTRICT,
  p_brand AS ROAD_SYSTEM,
  CAST(DATE '1998-01-01' + CAST(k % 700 AS INTEGER) AS TIMESTAMP) AS ORIGINAL_SPECIFIED_COMPLETION_DATE,
  CAST(DATE '1998-01-01' + CAST(k % 700 + k % 15 AS INTEGER) AS TIMESTAMP) AS CURRENT_SPECIFIED_COMPLETION_DATE,
  CASE WHEN k % 8 = 0 THEN NULL
       ELSE CAST(DATE '1998-01-01' + CAST(k % 700 + (k * 37) % 61 - 30 AS INTEGER) AS TIMESTAMP)
            + to_hours(CAST(k % 24 AS INTEGER)) END AS ACCEPTANCE_DATE,
  CASE WHEN k % 101 = 0 THEN 0.0 ELSE p_retailprice * 100 END AS CONTRACT_AWARD_AMOUNT,
  p_retailprice * (k % 20 + 95) AS CURRENT_CONTRACT_AMOUNT,
  CASE WHEN k % 3 = 0 THEN NULL ELSE p_retailprice * (k % 30 + 90) END AS UN_AUDITED_FINAL_COST,
  CASE WHEN (k * 37) % 61 - 30 > 0 THEN 'R' WHEN (k * 37) % 61 - 30 > -10 THEN 'Y' ELSE 'G' END
    AS ON_TIME_STATUS,
  CASE WHEN k % 30 >= 10 THEN 'R' ELSE 'G' END AS ON_BUDGET_STATUS
FROM (SELECT l_partkey * 10 + l_orderkey % 10 AS k, l_orderkey AS upc, p_retailprice, p_brand
      FROM lineitem JOIN part ON l_partkey = p_partkey) x""")

cte("contract_fields", ("raw_contracts",), staged("raw_contracts", CONTRACT_SPEC))

# Variances from the staged columns: days between calendar dates, and what was spent against the award.
cte("stg_contracts", ("contract_fields",), """
SELECT f.*, actual_completion_date - original_completion_date AS schedule_variance_days_actual,
  current_completion_date - original_completion_date AS schedule_variance_days_current,
  spent - award_amount AS cost_variance_dollars,
  IF(award_amount = 0, NULL, spent / award_amount - 1) AS cost_variance_pct
FROM contract_fields f, LATERAL (SELECT ifnull(f.final_cost, f.current_amount) AS spent) x""")

CONTRACT_KEPT = [c.dst for c in CONTRACT_SPEC if c.dst not in ("contract_id", "upc")] + [
    "schedule_variance_days_actual", "schedule_variance_days_current", "cost_variance_dollars", "cost_variance_pct"]

cte("contracts_distinct", ("stg_contracts",), f"""
SELECT contract_id, unnest(arg_min(c, ifnull(upc, 9223372036854775807))), count(*) AS project_count
FROM (SELECT contract_id, upc, {{{', '.join(f"'{c}': {c}" for c in CONTRACT_KEPT)}}} AS c FROM stg_contracts) s
GROUP BY contract_id""")

cte("rated", ("projects",), """
SELECT * FROM projects WHERE data_source IN ('both', 'dashboard_only')""")

KPI_DIMS = ("district", "project_type", "road_system")

cte("kpi_rates", ("rated",), f"""
SELECT {' '.join(['CASE', *(f"WHEN grouping({d}) = 0 THEN '{d}'" for d in KPI_DIMS), "ELSE 'overall' END"])} AS cut_type,
  {' '.join(['CASE', *(f"WHEN grouping({d}) = 0 THEN {d}" for d in KPI_DIMS), "ELSE 'ALL' END"])} AS cut_value,
  count(*) AS n_rated,
  {', '.join(f"count(*) FILTER ({s}_status = '{lv}') / nullif(count({s}_status), 0) AS {s}_{lv.lower()}_rate"
             for s in ('on_time', 'on_budget') for lv in 'GYR')}
FROM rated GROUP BY GROUPING SETS ((), {', '.join(f'({d})' for d in KPI_DIMS)})""")

cte("cost_base", ("projects",), """
SELECT district, project_type, road_system,
  current_estimate - allocated_budget AS vd,
  CASE WHEN allocated_budget <> 0 THEN (current_estimate - allocated_budget) / allocated_budget END AS vp
FROM projects WHERE current_estimate IS NOT NULL AND allocated_budget IS NOT NULL""")

cte("kept_levels", ("kpi_rates",), "SELECT cut_type, cut_value FROM kpi_rates WHERE n_rated >= 30")

# At risk by truth table: 1 where a status is Y or R, 0 where both are G, unknown otherwise.
STATUSES = ("'G'", "'Y'", "'R'", "NULL")
cte("bad_statuses", (), "SELECT * FROM (VALUES " + ", ".join(
    f"({t}, {b}, {1 if {t, b} & {STATUSES[1], STATUSES[2]} else 'NULL' if 'NULL' in (t, b) else 0})" for t in STATUSES for b in STATUSES)
    + ") v(t, b, flag)")

cte("model_features", ("projects", "kept_levels", "bad_statuses"), f"""
SELECT p.upc, p.data_source, p.data_source <> 'syip_only' AS has_label,
  p.data_source <> 'dashboard_only' AS is_currently_active,
  {', '.join(f"ifnull({d}_kept.cut_value, 'Other/Small Category') AS {d}_bucketed" for d in ('project_type', 'road_system', 'district'))},
  p.allocated_budget, ln(IF(p.allocated_budget > 0, p.allocated_budget, NULL)) AS log_allocated_budget,
  IF(p.data_source = 'syip_only', NULL, bad.flag) AS at_risk
FROM projects p
LEFT JOIN bad_statuses bad ON bad.t IS NOT DISTINCT FROM p.on_time_status AND bad.b IS NOT DISTINCT FROM p.on_budget_status
{chr(10).join(f"LEFT JOIN kept_levels {d}_kept ON {d}_kept.cut_type = '{d}' AND {d}_kept.cut_value = p.{d}"
              for d in ('project_type', 'road_system', 'district'))}""")

cte("training", ("model_features",), """
SELECT * FROM model_features WHERE has_label AND at_risk IS NOT NULL""")

cte("scored", (), """
SELECT o_orderkey AS id, CAST(o_orderstatus = 'F' AS INTEGER) AS label, floor(o_totalprice / 5000) / 100.0 AS score
FROM orders""")

cte("score_counts", ("scored",), """
SELECT score, count_if(label = 1) AS pos, count_if(label = 0) AS neg FROM scored GROUP BY score""")

cte("folds", ("scored",), """
SELECT id, label, score,
  CAST((row_number() OVER (PARTITION BY label ORDER BY md5(CAST(id AS VARCHAR) || '-42'), id) - 1) % 5 AS INTEGER) AS fold
FROM scored""")

# ---- preparation fitted on the training rows, and the closed-form coefficient fixture

CAT_COLS = ("project_type_bucketed", "road_system_bucketed", "district_bucketed")


def _cat_long(table: str, extra: str = "") -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS level{extra} FROM {table}" for c in CAT_COLS)


cte("levels", ("training",), f"""
SELECT column_name, level,
  CAST(row_number() OVER (PARTITION BY column_name ORDER BY level) - 1 AS INTEGER) AS position
FROM (SELECT DISTINCT column_name, level FROM ({_cat_long('training')}) u) d""")

cte("col_order", (), """
SELECT * FROM (VALUES ('project_type_bucketed', 0), ('road_system_bucketed', 1), ('district_bucketed', 2))
  t(column_name, col_pos)""")

cte("level_counts", ("training",), f"""
SELECT column_name, level, count_if(at_risk = 1) AS pos, count_if(at_risk = 0) AS neg
FROM ({_cat_long('training', ', at_risk')}) u GROUP BY column_name, level""")

cte("num_prep", ("training",), """
SELECT median(log_allocated_budget) AS med, count_if(log_allocated_budget IS NULL) > 0 AS has_ind
FROM training""")

cte("num_vals", ("training", "num_prep"), """
SELECT t.upc, t.at_risk, coalesce(t.log_allocated_budget, p.med) AS x,
  CAST(t.log_allocated_budget IS NULL AS DOUBLE) AS mi
FROM training t CROSS JOIN num_prep p""")

cte("num_scale", ("num_vals",), """
SELECT avg(x) AS mx, CASE WHEN coalesce(stddev_pop(x), 0) = 0 THEN 1.0 ELSE stddev_pop(x) END AS sx,
  avg(mi) AS mm, CASE WHEN coalesce(stddev_pop(mi), 0) = 0 THEN 1.0 ELSE stddev_pop(mi) END AS sm
FROM num_vals""")

cte("coefs", ("levels", "col_order", "level_counts", "num_vals", "num_scale", "num_prep"), """
SELECT l.column_name || '=' || l.level AS feature, l.column_name, l.level AS category, 'cat' AS kind,
  o.col_pos * 1000000 + l.position AS idx,
  ln((CAST(lc.pos AS DOUBLE) + 0.5) / (CAST(lc.neg AS DOUBLE) + 0.5))
    - ln((CAST(rc.pos AS DOUBLE) + 0.5) / (CAST(rc.neg AS DOUBLE) + 0.5)) AS coef
FROM levels l
JOIN col_order o ON o.column_name = l.column_name
JOIN level_counts lc ON lc.column_name = l.column_name AND lc.level = l.level
JOIN levels r ON r.column_name = l.column_name AND r.position = 0
JOIN level_counts rc ON rc.column_name = r.column_name AND rc.level = r.level
WHERE l.position > 0
UNION ALL
SELECT 'log_allocated_budget', 'log_allocated_budget', NULL, 'num', 10000000,
  avg(CASE WHEN at_risk = 1 THEN (x - mx) / sx END) - avg(CASE WHEN at_risk = 0 THEN (x - mx) / sx END)
FROM num_vals CROSS JOIN num_scale
UNION ALL
SELECT 'log_allocated_budget_missing', 'log_allocated_budget_missing', NULL, 'ind', 10000001,
  avg(CASE WHEN at_risk = 1 THEN (mi - mm) / sm END) - avg(CASE WHEN at_risk = 0 THEN (mi - mm) / sm END)
FROM num_vals CROSS JOIN num_scale
HAVING bool_or(mi = 1.0)""")

cte("intercept", ("training",), """
SELECT ln((CAST(count_if(at_risk = 1) AS DOUBLE) + 0.5) / (CAST(count_if(at_risk = 0) AS DOUBLE) + 0.5)) AS b0
FROM training""")

cte("active_feat", ("model_features", "num_prep"), """
SELECT m.upc, m.allocated_budget, m.project_type_bucketed, m.road_system_bucketed, m.district_bucketed,
  coalesce(m.log_allocated_budget, p.med) AS x, CAST(m.log_allocated_budget IS NULL AS DOUBLE) AS mi
FROM model_features m CROSS JOIN num_prep p WHERE m.is_currently_active""")

cte("contrib", ("active_feat", "coefs", "num_scale"), """
SELECT a.upc, c.idx, c.column_name, c.category, c.coef AS contrib
FROM active_feat a JOIN coefs c ON c.kind = 'cat' AND (
  (c.column_name = 'project_type_bucketed' AND a.project_type_bucketed = c.category) OR
  (c.column_name = 'road_system_bucketed' AND a.road_system_bucketed = c.category) OR
  (c.column_name = 'district_bucketed' AND a.district_bucketed = c.category))
UNION ALL
SELECT a.upc, c.idx, c.column_name, NULL, c.coef * ((a.x - s.mx) / s.sx)
FROM active_feat a CROSS JOIN num_scale s JOIN coefs c ON c.kind = 'num'
UNION ALL
SELECT a.upc, c.idx, c.column_name, NULL, c.coef * ((a.mi - s.mm) / s.sm)
FROM active_feat a CROSS JOIN num_scale s JOIN coefs c ON c.kind = 'ind'""")

cte("risk_scores", ("active_feat", "contrib", "intercept"), """
SELECT s.upc, s.p AS risk_probability, CAST(round_even(s.p * 100, 0) AS INTEGER) AS risk_score,
  coalesce(e.top_factors, 'no strong individual driver') AS top_factors, s.allocated_budget,
  CAST(round_even(s.p * 100, 0) AS INTEGER) >= 60 AS elevated_risk
FROM (SELECT a.upc, a.allocated_budget, 1.0 / (1.0 + exp(-(coalesce(sum(c.contrib), 0.0) + i.b0))) AS p
      FROM active_feat a CROSS JOIN intercept i LEFT JOIN contrib c ON c.upc = a.upc
      GROUP BY a.upc, a.allocated_budget, i.b0) s
LEFT JOIN (
  SELECT upc, string_agg(txt, '; ' ORDER BY rk) AS top_factors FROM (
    SELECT upc, row_number() OVER (PARTITION BY upc ORDER BY abs(contrib) DESC, idx) AS rk,
      CASE WHEN category IS NOT NULL THEN column_name || '=''' || category || '''' ELSE column_name END
      || CASE WHEN contrib > 0 THEN ' (raises risk)' ELSE ' (lowers risk)' END AS txt
    FROM contrib WHERE abs(contrib) > 1e-9) r
  WHERE rk <= 2 GROUP BY upc) e ON e.upc = s.upc""")

cte("feature_table", ("coefs", "levels"), """
SELECT c.idx, c.feature, c.column_name, c.category, c.coef, exp(c.coef) AS odds_ratio,
  CASE WHEN c.kind = 'cat' THEN
         c.column_name || '=''' || c.category || ''' carries ' || printf('%.2f', exp(c.coef))
         || 'x the odds of being flagged at-risk compared to ' || c.column_name || '=''' || r.level || ''' ('
         || CASE WHEN c.coef > 0 THEN 'higher' ELSE 'lower' END || ' risk).'
       WHEN c.kind = 'ind' THEN 'Indicator for projects with no allocated-budget figure to compute a size feature from.'
       ELSE 'Each one-standard-deviation increase in log(allocated budget) '
         || CASE WHEN c.coef > 0 THEN 'increases' ELSE 'decreases' END
         || ' the odds of being flagged at-risk by ' || printf('%.2f', exp(c.coef)) || 'x'
         || CASE WHEN c.coef > 0 THEN ' — bigger projects trend riskier' ELSE '' END || '.'
  END AS sentence
FROM coefs c LEFT JOIN levels r ON r.column_name = c.column_name AND r.position = 0""")
