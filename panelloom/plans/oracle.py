"""ANSI SQL that states what each registered query has to return, for an independent engine.

The common table expressions describe the survey view of the driver tables straight from the
tables: canonical values by CASE, bounds by a literal table, no mapping operator involved.
"""

from __future__ import annotations

from panelloom.plans import survey_config as S


def _quote(value: object) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def _role_rows() -> str:
    rows = []
    for edition in S.EDITIONS:
        offered = [r for r in S.ROLE if r[0] and (r[1] == "all" or edition in r[1].split(","))]
        for number, (raw, _, role, group) in enumerate(offered):
            rows.append(f"({_quote(edition)},{number},{_quote(raw)},{_quote(role)},{_quote(group)})")
    return ",".join(rows)


def _list(values: list[str]) -> str:
    return "[" + ",".join(_quote(v) for v in values) + "]"


_EMPLOYMENT = [c for raw, c in S.EMPLOYMENT_STATUS if raw]
_COMPANY = [c for raw, c, _ in S.COMPANY_SIZE if raw]

# Truth table of the band labels, in label order.
_BANDS = """(0,NULL,1000,NULL,'LOWER_OPEN',false),(1,40001,NULL,NULL,'UPPER_OPEN',false),
(2,101,2000,1050.5,'CLOSED',false),(3,1001,2000,1500.5,'CLOSED',false),(4,2001,3000,2500.5,'CLOSED',false),
(5,2001,3000,2500.5,'CLOSED',false),(6,3001,4000,3500.5,'CLOSED',false),(7,4001,6000,5000.5,'CLOSED',false),
(8,6001,8000,7000.5,'CLOSED',false),(9,25001,3000,NULL,'CLOSED',true),(10,8001,12000,10000.5,'CLOSED',false),
(11,12001,16000,14000.5,'CLOSED',false),(12,16001,20000,18000.5,'CLOSED',false),
(13,20001,25000,22500.5,'CLOSED',false),(14,25001,30000,27500.5,'CLOSED',false),
(15,30001,40000,35000.5,'CLOSED',false)"""

PANEL = f"""
bands(idx, lo, hi, mid, open_ended, anomaly) AS (VALUES {_BANDS}),
roles(ed, nation, role_raw, role, grp) AS (VALUES {_role_rows()}),
base AS (
  SELECT o.*, c.*, n.*, r.r_name,
    CASE WHEN year(o_orderdate) <= 1996 THEN 'year_1' WHEN year(o_orderdate) <= 1998 THEN 'year_2' ELSE 'year_3' END AS survey_year,
    month(o_orderdate) AS mo, day(o_orderdate) AS dy
  FROM orders o LEFT JOIN customer c ON o_custkey = c_custkey
  LEFT JOIN nation n ON c_nationkey = n_nationkey LEFT JOIN region r ON n_regionkey = r_regionkey),
panel AS (
  SELECT b.survey_year, b.survey_year || printf('_%06d', o_orderkey) AS respondent_id,
    o_orderkey,
    CASE WHEN o_orderstatus = 'F' THEN 'FEMALE' WHEN o_orderstatus = 'O' THEN 'MALE'
         WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'UNKNOWN' ELSE 'NOT_INFORMED' END AS gender,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'SPECIALIST' WHEN '2-HIGH' THEN 'SENIOR' WHEN '3-MEDIUM' THEN 'MID'
         WHEN '5-LOW' THEN 'JUNIOR' ELSE 'UNKNOWN' END AS seniority,
    CASE WHEN mo <= 3 THEN 'REMOTE' WHEN mo <= 6 THEN 'ON_SITE' WHEN mo <= 9 THEN 'HYBRID_FLEXIBLE'
         WHEN mo <= 11 THEN 'HYBRID_FIXED' ELSE 'UNKNOWN' END AS current_work_model,
    CASE WHEN c_acctbal < 0 THEN 'UNKNOWN' WHEN c_acctbal < 2500 THEN 'REMOTE' WHEN c_acctbal < 5000 THEN 'ON_SITE'
         WHEN c_acctbal < 7500 THEN 'HYBRID_FLEXIBLE' ELSE 'HYBRID_FIXED' END AS ideal_work_model,
    coalesce(({_list(_EMPLOYMENT)})[CAST(floor((dy - 1) / 2) AS INT) + 1], 'UNKNOWN') AS employment_status,
    CASE WHEN r_name = 'MIDDLE EAST' THEN NULL ELSE r_name END AS region,
    CASE WHEN c_acctbal >= 0 THEN coalesce(({_list(_COMPANY)})[CAST(floor(c_acctbal / 800) AS INT) + 1], 'UNKNOWN') ELSE 'UNKNOWN' END AS company_size,
    c_mktsegment AS sector, n_name AS state, o_orderpriority AS education_level,
    CASE WHEN dy <= 10 THEN true WHEN dy <= 25 THEN false END AS manager_flag,
    coalesce(ro.role, 'UNKNOWN') AS current_role, coalesce(ro.grp, 'UNKNOWN') AS comparability_group, ro.role_raw AS current_role_raw,
    CAST(ba.lo AS DOUBLE) AS salary_lower_bound, CAST(ba.hi AS DOUBLE) AS salary_upper_bound, CAST(ba.mid AS DOUBLE) AS salary_midpoint,
    ba.open_ended AS salary_open_ended, coalesce(ba.anomaly, false) AS salary_anomaly_flag
  FROM base b LEFT JOIN roles ro ON ro.ed = b.survey_year AND ro.nation = c_nationkey
  LEFT JOIN bands ba ON mo <> 12 AND ba.idx = CAST(floor(o_totalprice / 31250) AS INT))"""

_OPTION_ROWS = ",".join(f"({i},{_quote(name)})" for i, name in enumerate(S.DATABASE_OPTIONS))

BLOCK = f"""
opts(bit, technology) AS (VALUES {_OPTION_ROWS}),
eds AS (SELECT o_orderkey,
    CASE WHEN year(o_orderdate) <= 1996 THEN 'year_1' WHEN year(o_orderdate) <= 1998 THEN 'year_2' ELSE 'year_3' END AS survey_year FROM orders),
picks AS (
  SELECT l_orderkey, CAST(substr(p_brand, 7) AS INT) - 1 AS bit FROM lineitem JOIN part ON l_partkey = p_partkey
  UNION SELECT l_orderkey, CASE p_type WHEN 'ECONOMY' THEN 25 WHEN 'LARGE' THEN 26 WHEN 'MEDIUM' THEN 27 WHEN 'PROMO' THEN 28 WHEN 'SMALL' THEN 29 ELSE 30 END
    FROM lineitem JOIN part ON l_partkey = p_partkey
  UNION SELECT l_orderkey, CASE WHEN p_size <= 10 THEN 31 WHEN p_size <= 30 THEN 32 ELSE 33 END FROM lineitem JOIN part ON l_partkey = p_partkey),
shown AS (SELECT e.* FROM eds e WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = e.o_orderkey)),
bridge AS (
  SELECT s.o_orderkey, s.survey_year || printf('_%06d', s.o_orderkey) AS respondent_id,
    s.survey_year, t.technology, 'DATABASE' AS technology_family, p.l_orderkey IS NOT NULL AS selected
  FROM shown s JOIN opts t ON (t.technology <> 'SAP' OR s.survey_year = 'year_1')
  LEFT JOIN picks p ON p.l_orderkey = s.o_orderkey AND p.bit = t.bit),
adoption AS (
  SELECT survey_year, technology, count(*) FILTER (WHERE selected) AS technology_users, count(*) AS eligible_respondents,
    count(*) FILTER (WHERE selected) / CAST(count(*) AS DOUBLE) AS adoption_rate FROM bridge GROUP BY ALL),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY survey_year ORDER BY adoption_rate DESC) AS rank FROM adoption),
trend AS (
  SELECT r.*, (r.adoption_rate - p.adoption_rate) * 100 AS yoy FROM ranked r LEFT JOIN adoption p
    ON p.technology = r.technology AND CAST(substr(p.survey_year, 6) AS INT) = CAST(substr(r.survey_year, 6) AS INT) - 1)"""

AI = """
traits AS (
  SELECT l_orderkey, count(*) AS n, bool_or(l_returnflag = 'A') AS a, bool_or(l_returnflag = 'R') AS r,
    bool_or(l_linestatus = 'O') AS o, bool_or(l_discount >= 0.08) AS d FROM lineitem GROUP BY 1),
ai AS (
  SELECT e.o_orderkey, e.survey_year || printf('_%06d', e.o_orderkey) AS respondent_id, e.survey_year,
    CASE WHEN e.survey_year = 'year_1' THEN 'NOT_AVAILABLE' WHEN n = 1 THEN 'NOT_PRIORITY' WHEN n = 2 THEN 'SECONDARY_INITIATIVE'
         WHEN n = 3 THEN 'TOP_PRIORITY_MEDIUM_TERM' WHEN n = 4 THEN 'TOP_PRIORITY_MAIN' WHEN n = 5 THEN 'DONT_KNOW' ELSE 'NOT_ASKED' END AS enterprise_ai_priority,
    e.survey_year <> 'year_1' AS genai_question_available,
    e.survey_year <> 'year_1' AND n IS NOT NULL AS genai_eligible,
    CASE WHEN e.survey_year <> 'year_1' AND n IS NOT NULL THEN NOT a AND NOT r END AS genai_no_use,
    CASE WHEN e.survey_year <> 'year_1' AND n IS NOT NULL THEN a END AS genai_free_personal,
    CASE WHEN e.survey_year <> 'year_1' AND n IS NOT NULL THEN r END AS genai_paid_personal,
    CASE WHEN e.survey_year <> 'year_1' AND n IS NOT NULL THEN o END AS genai_paid_by_company,
    CASE WHEN e.survey_year <> 'year_1' AND n IS NOT NULL THEN d END AS genai_copilot
  FROM (SELECT o_orderkey, CASE WHEN year(o_orderdate) <= 1996 THEN 'year_1' WHEN year(o_orderdate) <= 1998 THEN 'year_2' ELSE 'year_3' END AS survey_year FROM orders) e
  LEFT JOIN traits ON l_orderkey = e.o_orderkey),
ai_overview AS (
  SELECT survey_year, 'enterprise_ai_priority_rate' AS metric, survey_year <> 'year_1' AS question_available,
    count(*) FILTER (WHERE enterprise_ai_priority NOT IN ('NOT_ASKED', 'NOT_AVAILABLE')) AS eligible_respondents,
    count(*) FILTER (WHERE enterprise_ai_priority LIKE 'TOP_PRIORITY%') AS hits FROM ai GROUP BY 1
""" + "".join(
    f"""  UNION ALL SELECT survey_year, '{metric}', survey_year <> 'year_1', count(*) FILTER (WHERE genai_eligible),
    count(*) FILTER (WHERE genai_eligible AND {column}) FROM ai GROUP BY 1
"""
    for column, metric in [*S.GENAI_METRICS.items(), ("NOT genai_no_use", S.GENAI_USAGE_METRIC)]
) + """),
ai_rates AS (
  SELECT survey_year, metric, question_available, eligible_respondents,
    CASE WHEN question_available THEN CAST(hits AS DOUBLE) END AS numerator,
    CASE WHEN question_available AND eligible_respondents > 0 THEN hits / CAST(eligible_respondents AS DOUBLE) END AS rate FROM ai_overview)"""


def market(nulls: str = "drop") -> str:
    """CTE ``market`` on top of PANEL."""
    dims = ("seniority", "gender", "current_work_model", "region", "employment_status")
    counts = " UNION ALL ".join(
        f"SELECT survey_year, '{d}' AS dimension, {d} AS dimension_value, count(*) AS respondent_count FROM panel "
        + (f"WHERE {d} IS NOT NULL " if nulls == "drop" else "")
        + "GROUP BY ALL"
        for d in dims
    )
    return (
        f"dim_counts AS ({counts}), market AS (SELECT *, respondent_count / CAST(sum(respondent_count) OVER "
        "(PARTITION BY survey_year, dimension) AS DOUBLE) AS respondent_share_within_year FROM dim_counts)"
    )


def compensation(dimension: str, name: str = "comp") -> str:
    """CTE ``name`` on top of PANEL."""
    keep = f"{dimension} IS NOT NULL" if dimension == "region" else f"{dimension} <> 'UNKNOWN'"
    return f"""{name} AS (
  SELECT survey_year, {dimension}, count(*) AS respondent_count, count(salary_midpoint) AS salary_known_count,
    quantile_cont(salary_midpoint, 0.5) AS median_salary_midpoint, avg(salary_midpoint) AS mean_salary_midpoint,
    quantile_cont(salary_midpoint, 0.25) AS salary_p25, quantile_cont(salary_midpoint, 0.75) AS salary_p75,
    quantile_cont(salary_midpoint, 0.75) - quantile_cont(salary_midpoint, 0.25) AS salary_iqr, count(*) < 30 AS low_sample_flag
  FROM panel WHERE {keep} GROUP BY ALL)"""


REPRESENTATION = """
cells AS (
  SELECT survey_year, gender, 'overall' AS cross_dimension, 'ALL' AS cross_dimension_value, salary_midpoint FROM panel
  UNION ALL SELECT survey_year, gender, 'seniority', seniority, salary_midpoint FROM panel WHERE seniority <> 'UNKNOWN'
  UNION ALL SELECT survey_year, gender, 'current_role', current_role, salary_midpoint FROM panel WHERE current_role <> 'UNKNOWN'
  UNION ALL SELECT survey_year, gender, 'region', region, salary_midpoint FROM panel WHERE region IS NOT NULL),
cell_counts AS (
  SELECT survey_year, gender, cross_dimension, cross_dimension_value, count(*) AS respondent_count,
    quantile_cont(salary_midpoint, 0.5) AS median_salary_midpoint
  FROM cells GROUP BY ALL),
rep AS (
  SELECT *, sum(respondent_count) OVER bucket AS bucket_total,
    respondent_count / CAST(sum(respondent_count) OVER bucket AS DOUBLE) AS share_within_bucket, respondent_count < 30 AS low_sample_flag
  FROM cell_counts WINDOW bucket AS (PARTITION BY survey_year, cross_dimension, cross_dimension_value))"""

SCORE = """
latest AS (SELECT respondent_id, current_role, seniority, salary_midpoint FROM panel WHERE survey_year = 'year_3'),
overall AS (
  SELECT count(DISTINCT CASE WHEN current_role <> 'UNKNOWN' THEN current_role END) AS n_roles, quantile_cont(salary_midpoint, 0.5) AS med,
    avg(CASE WHEN seniority IN ('SENIOR', 'SPECIALIST') THEN 1.0 ELSE 0.0 END) AS senior FROM latest),
growth AS (
  SELECT technology, (max(CASE WHEN survey_year = 'year_3' THEN adoption_rate END) - max(CASE WHEN survey_year = 'year_1' THEN adoption_rate END)) * 100 AS adoption_growth_pp
  FROM adoption GROUP BY 1),
used AS (
  SELECT b.technology, count(DISTINCT b.respondent_id) AS year_3_users,
    count(DISTINCT CASE WHEN current_role <> 'UNKNOWN' THEN current_role END) AS roles, quantile_cont(salary_midpoint, 0.5) AS med,
    avg(CASE WHEN seniority IN ('SENIOR', 'SPECIALIST') THEN 1.0 ELSE 0.0 END) AS senior
  FROM bridge b LEFT JOIN latest USING (respondent_id) WHERE b.survey_year = 'year_3' AND b.selected GROUP BY 1 HAVING count(DISTINCT b.respondent_id) >= 30),
parts AS (
  SELECT u.technology, u.year_3_users, (SELECT count(DISTINCT respondent_id) FROM bridge WHERE survey_year = 'year_3') AS year_3_eligible_respondents,
    g.adoption_growth_pp, u.roles / CAST(o.n_roles AS DOUBLE) AS cross_role_prevalence, (u.med - o.med) / o.med AS salary_association,
    (u.senior - o.senior) / o.senior AS senior_role_prevalence
  FROM used u JOIN growth g USING (technology), overall o WHERE g.adoption_growth_pp IS NOT NULL),
norm AS (
  SELECT p.*, """ + ", ".join(
    f"CASE WHEN max({c}) OVER () = min({c}) OVER () THEN 0.0 ELSE ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) END AS normalized_{c}"
    for c in S.SCORE_WEIGHTS
) + """ FROM parts p),
score AS (
  SELECT *, (0.30 * normalized_adoption_growth_pp + 0.25 * normalized_cross_role_prevalence + 0.20 * normalized_salary_association
    + 0.15 * normalized_senior_role_prevalence) / 0.90 AS priority_score FROM norm)"""


def family(name: str, options: dict[int, tuple[str, tuple[str, ...]]], answer: str, values: list) -> str:
    """Adoption, rank and change of one option family: ``options`` has each option's name and the editions that print it."""
    rows = ",".join(f"({i},{_quote(values[i])},{_quote(label)},{_quote(e)})" for i, (label, editions) in options.items() for e in editions)
    return f"""
opts(i, answer, technology, survey_year) AS (VALUES {rows}),
eds AS (SELECT o_orderkey,
    CASE WHEN year(o_orderdate) <= 1996 THEN 'year_1' WHEN year(o_orderdate) <= 1998 THEN 'year_2' ELSE 'year_3' END AS survey_year FROM orders),
picks AS (SELECT DISTINCT l_orderkey, CAST({answer} AS VARCHAR) AS answer FROM lineitem
    LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey),
shown AS (SELECT survey_year, count(*) AS eligible_respondents FROM eds WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1),
used AS (SELECT survey_year, answer, count(*) AS n FROM eds JOIN picks ON l_orderkey = o_orderkey GROUP BY 1, 2),
adoption AS (SELECT o.technology, o.survey_year, coalesce(n, 0) AS technology_users, eligible_respondents,
    coalesce(n, 0) / CAST(eligible_respondents AS DOUBLE) AS adoption_rate
    FROM opts o JOIN shown s ON s.survey_year = o.survey_year LEFT JOIN used u ON u.survey_year = o.survey_year AND u.answer = o.answer),
ranked AS (SELECT *, rank() OVER (PARTITION BY survey_year ORDER BY adoption_rate DESC) AS rank FROM adoption),
trend AS (
  SELECT r.*, (r.adoption_rate - p.adoption_rate) * 100 AS yoy FROM ranked r LEFT JOIN adoption p
    ON p.technology = r.technology AND CAST(substr(p.survey_year, 6) AS INT) = CAST(substr(r.survey_year, 6) AS INT) - 1)"""
