"""Queries over the driver tables, one per operator and product, each with its SQL statement.

``QUERIES`` maps a name to a builder ``(spark, sf_dir) -> DataFrame``; ``ORACLE`` maps the same
name to SQL. Doubles are rounded to six decimals and counts are bigint on both sides.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.functions.bands import parse_band
from panelloom.functions.headers import resolve_fields
from panelloom.operators import effective as EF
from panelloom.operators import gates as GT
from panelloom.operators import mapping as M
from panelloom.operators import options as O
from panelloom.operators import quality as Q
from panelloom.operators import ranking as R
from panelloom.operators import rates as A
from panelloom.operators import reshape as RS
from panelloom.operators import scoring as SC
from panelloom.operators import shares as SH
from panelloom.operators import similar as SM
from panelloom.operators import stats as ST
from panelloom.operators import trend as TR
from panelloom.plans import answers as AN
from panelloom.plans import chart_data as CD
from panelloom.plans import gold as G
from panelloom.plans import landing, oracle, panel, silver
from panelloom.plans import survey_config as S
from panelloom.plans.survey_job import DIMENSION_TABLES, gold_tables
from panelloom.session import new_folder
from panelloom.sources import bronze, sinks, tables
from panelloom.streaming.landing import land_new_files

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def tidy(df: DataFrame) -> DataFrame:
    """Doubles to six decimals, integers to bigint, so results compare by value."""
    columns = []
    for name, kind in df.dtypes:
        col = F.col(f"`{name}`")
        if kind == "double":
            col = F.round(col, 6)
        elif kind in ("int", "smallint", "tinyint"):
            col = col.cast("bigint")
        columns.append(col.alias(name))
    return df.select(*columns)


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    def register(build: Builder) -> Builder:
        QUERIES[name] = lambda spark, sf_dir: tidy(build(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


def add(name: str, build: Builder, sql: str | None = None) -> None:
    query(name, sql)(build)


def sql(ctes: list[str], source: str, columns: str) -> str:
    """``WITH ctes SELECT columns FROM source``; ``columns`` marks doubles with ~ and counts with #."""
    picked = []
    for column in columns.split():
        kind, name = (column[0], column[1:]) if column[0] in "~#" else ("", column)
        expr, _, alias = name.partition("=")
        alias = alias or expr
        wrapped = {"~": f"round(CAST({expr} AS DOUBLE), 6)", "#": f"CAST({expr} AS BIGINT)", "": expr}[kind]
        picked.append(f"{wrapped} AS {alias}")
    head = f"WITH {', '.join(ctes)} " if ctes else ""
    return f"{head}SELECT {', '.join(picked)} FROM {source}"


P, B, AI = oracle.PANEL, oracle.BLOCK, oracle.AI

# ---- Gold tables ------------------------------------------------------------------------

_MARKET = "survey_year dimension dimension_value #respondent_count ~respondent_share_within_year"
_STATS = (
    "#respondent_count #salary_known_count ~median_salary_midpoint ~mean_salary_midpoint "
    "~salary_p25 ~salary_p75 ~salary_iqr low_sample_flag"
)
_REP = (
    "survey_year gender cross_dimension cross_dimension_value #respondent_count #bucket_total "
    "~share_within_bucket ~median_salary_midpoint low_sample_flag"
)
_ADOPTION = "technology survey_year #technology_users #eligible_respondents ~adoption_rate"
_TREND = f"{_ADOPTION} #rank ~yoy=yoy_pp_change_vs_prev_survey"
_AI_RATES = "survey_year metric question_available #eligible_respondents ~numerator ~rate"
_COMPONENTS = " ".join(f"~{c}" for c in S.SCORE_WEIGHTS)
_SCORE = (
    f"technology #year_3_users #year_3_eligible_respondents {_COMPONENTS} "
    + " ".join(f"~normalized_{c}" for c in S.SCORE_WEIGHTS)
    + " ~priority_score note=future_interest_component #pos=rank"
)
_SCORED = (
    "(SELECT *, row_number() OVER (ORDER BY priority_score DESC, technology) AS pos, "
    f"'{S.FUTURE_INTEREST_NOTE}' AS note FROM score)"
)
_SCORE_CTES = [P, B, oracle.SCORE]

GOLD_SQL = {
    "gold_market_overview": sql([P, oracle.market()], "market", _MARKET),
    **{
        name: sql([P, oracle.compensation(d)], "comp", f"survey_year {d} {_STATS}")
        for name, d in DIMENSION_TABLES.items()
    },
    "gold_gender_representation": sql([P, oracle.REPRESENTATION], "rep", _REP),
    "gold_technology_adoption_by_year": sql([B], "trend", _TREND),
    "gold_ai_adoption_overview": sql([AI], "ai_rates", _AI_RATES),
    "gold_skill_priority_score": sql(_SCORE_CTES, _SCORED, _SCORE),
}
for _name in GOLD_SQL:
    add(_name, lambda s, d, n=_name: panel.gold(s, d, n), GOLD_SQL[_name])

# The same products after the full path: raw CSV, Bronze, Silver, Gold.
for _name in (
    "gold_market_overview", "gold_compensation_by_role", "gold_gender_representation",
    "gold_technology_adoption_by_year", "gold_ai_adoption_overview", "gold_skill_priority_score",
):
    add(
        f"from_raw_{_name}",
        lambda s, d, n=_name: gold_tables(landing.stored_silver(s, d))[n],
        GOLD_SQL[_name],
    )

for _name in ("gold_gender_representation", "gold_technology_adoption_by_year", "gold_ai_adoption_overview"):
    add(f"stored_{_name}", lambda s, d, n=_name: landing.stored_gold(s, d)[n], GOLD_SQL[_name])

# And from mergeable counts of several drops, see plans/incremental.py.
for _name in ("gold_market_overview", "gold_compensation_by_role", "gold_gender_representation", "gold_technology_adoption_by_year", "gold_ai_adoption_overview", "gold_skill_priority_score"):
    add(f"counted_{_name}", lambda s, d, n=_name: landing.counted_gold(s, d, n), GOLD_SQL[_name])

# ---- Answers ----------------------------------------------------------------------------

_LATEST = "survey_year = 'year_3'"


def _pivot_sql(dimension: str) -> str:
    cells = ", ".join(
        f"round(max(CASE WHEN survey_year = '{e}' THEN respondent_share_within_year END), 4) AS {e}" for e in S.EDITIONS
    )
    return (
        f"WITH {P}, {oracle.market()} SELECT dimension_value, {cells} FROM market "
        f"WHERE dimension = '{dimension}' GROUP BY dimension_value"
    )


def _comp_sql(dimension: str, columns: str, where: str = "true") -> str:
    return sql([P, oracle.compensation(dimension)], f"comp WHERE {where}", columns)


ANSWER_SQL = {
    **{
        f"q1_market_structure_{d}": _pivot_sql(d)
        for d in ("seniority", "current_work_model", "employment_status", "region")
    },
    "q2_compensation_by_role_latest_year": _comp_sql(
        "current_role", "current_role #respondent_count ~median_salary_midpoint ~salary_iqr low_sample_flag", _LATEST
    ),
    "q2_compensation_by_seniority_all_years": _comp_sql(
        "seniority", "survey_year seniority #respondent_count ~median_salary_midpoint"
    ),
    "q3_gender_overall_by_year": sql(
        [P, oracle.REPRESENTATION], "rep WHERE cross_dimension = 'overall'",
        "survey_year gender #respondent_count ~share_within_bucket ~median_salary_midpoint",
    ),
    "q3_gender_share_by_seniority": sql(
        [P, oracle.REPRESENTATION], "rep WHERE cross_dimension = 'seniority' AND gender = 'FEMALE'",
        "survey_year cross_dimension_value=seniority #respondent_count #bucket_total ~share_within_bucket",
    ),
    "q3_gender_share_by_role_latest_year": sql(
        [P, oracle.REPRESENTATION],
        f"rep WHERE cross_dimension = 'current_role' AND gender = 'FEMALE' AND {_LATEST}",
        "cross_dimension_value=current_role #respondent_count #bucket_total ~share_within_bucket",
    ),
    "q4_technology_adoption_latest_year": sql(
        [B], f"trend WHERE {_LATEST}",
        "technology #technology_users #eligible_respondents ~adoption_rate ~yoy=yoy_pp_change_vs_prev_survey",
    ),
    "q4_technology_yoy_change_latest_year": sql(
        [B], f"trend WHERE {_LATEST}", "technology ~adoption_rate ~yoy=yoy_pp_change_vs_prev_survey"
    ),
    "q5_ai_adoption_overview": sql([AI], "ai_rates", _AI_RATES),
    "q6_compensation_by_region_latest_year": _comp_sql(
        "region", "region #respondent_count ~median_salary_midpoint ~salary_iqr low_sample_flag", _LATEST
    ),
    "q6_compensation_by_seniority_all_years": _comp_sql(
        "seniority", "survey_year seniority #respondent_count ~median_salary_midpoint ~salary_iqr"
    ),
    "q6_compensation_by_work_model_all_years": _comp_sql(
        "current_work_model", "survey_year current_work_model #respondent_count ~median_salary_midpoint ~salary_iqr"
    ),
    "q7_skill_priority_ranking": sql(
        _SCORE_CTES, _SCORED, f"#pos=rank technology ~priority_score {_COMPONENTS}"
    ),
}

# Gold table each answer reads, so that asking for one answer plans one Gold table.
_ANSWERS: dict[str, Builder] = {
    **{
        f"q1_market_structure_{x}": lambda s, d, x=x: AN.market_structure(panel.gold(s, d, "gold_market_overview"), x)
        for x in ("seniority", "current_work_model", "employment_status", "region")
    },
    "q2_compensation_by_role_latest_year": lambda s, d: AN.roles_by_salary(panel.gold(s, d, "gold_compensation_by_role")),
    "q2_compensation_by_seniority_all_years": lambda s, d: AN.seniority_salary(panel.gold(s, d, "gold_compensation_by_seniority")),
    "q3_gender_overall_by_year": lambda s, d: AN.gender_overall(panel.gold(s, d, "gold_gender_representation")),
    "q3_gender_share_by_seniority": lambda s, d: AN.female_share_by_seniority(panel.gold(s, d, "gold_gender_representation")),
    "q3_gender_share_by_role_latest_year": lambda s, d: AN.female_share_by_role(panel.gold(s, d, "gold_gender_representation")),
    "q4_technology_adoption_latest_year": lambda s, d: AN.technology_ranking(panel.gold(s, d, "gold_technology_adoption_by_year")),
    "q4_technology_yoy_change_latest_year": lambda s, d: AN.technology_change(panel.gold(s, d, "gold_technology_adoption_by_year")),
    "q5_ai_adoption_overview": lambda s, d: AN.ai_adoption(panel.gold(s, d, "gold_ai_adoption_overview")),
    "q6_compensation_by_region_latest_year": lambda s, d: AN.region_salary(panel.gold(s, d, "gold_compensation_by_region")),
    "q6_compensation_by_seniority_all_years": lambda s, d: AN.salary_by(panel.gold(s, d, "gold_compensation_by_seniority"), "seniority"),
    "q6_compensation_by_work_model_all_years": lambda s, d: AN.salary_by(
        panel.gold(s, d, "gold_compensation_by_work_model"), "current_work_model"
    ),
    "q7_skill_priority_ranking": lambda s, d: AN.skill_ranking(panel.gold(s, d, "gold_skill_priority_score")),
}
for _name, _build in _ANSWERS.items():
    add(_name, _build, ANSWER_SQL[_name])

# ---- Chart tables -----------------------------------------------------------------------


def _case(column: str, labels: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items())
    return f"CASE {column} {whens} END"


_ED_LABEL = _case("survey_year", S.EDITION_LABELS)


def _mix_sql(dimension: str, labels: dict[str, str]) -> str:
    return (
        f"WITH {P}, {oracle.market()} SELECT {_case('dimension_value', labels)} AS dimension_label, survey_year, "
        f"{_ED_LABEL} AS survey_year_label, round(respondent_share_within_year, 4) AS value FROM market "
        f"WHERE dimension = '{dimension}' AND dimension_value IN ({', '.join(repr(k) for k in labels)})"
    )


def _category_sql(dimension: str, label: str, labels: dict[str, str]) -> str:
    return (
        f"WITH {P}, {oracle.compensation(dimension)} SELECT survey_year, {_ED_LABEL} AS survey_year_label, "
        f"{_case(dimension, labels)} AS {label}, round(median_salary_midpoint, 6) AS median_salary_midpoint FROM comp"
    )


def _answer(name: str) -> Builder:
    return _ANSWERS[name]


add(
    "chart_seniority_mix",
    lambda s, d: CD.share_mix(_answer("q1_market_structure_seniority")(s, d), S.SENIORITY_LABELS),
    _mix_sql("seniority", S.SENIORITY_LABELS),
)
add(
    "chart_work_model_mix",
    lambda s, d: CD.share_mix(_answer("q1_market_structure_current_work_model")(s, d), S.WORK_MODEL_MIX_LABELS),
    _mix_sql("current_work_model", S.WORK_MODEL_MIX_LABELS),
)
add(
    "chart_salary_by_role",
    lambda s, d: CD.salary_by_role(_answer("q2_compensation_by_role_latest_year")(s, d)),
    f"WITH {P}, {oracle.compensation('current_role')} SELECT coalesce({_case('current_role', S.ROLE_LABELS)}, current_role) "
    "|| CASE WHEN low_sample_flag THEN '*' ELSE '' END AS role_label, round(median_salary_midpoint, 6) AS median_salary_midpoint, "
    f"CAST(respondent_count AS BIGINT) AS respondent_count FROM comp WHERE {_LATEST} AND median_salary_midpoint IS NOT NULL "
    "ORDER BY comp.median_salary_midpoint DESC, current_role LIMIT 10",
)
add(
    "chart_salary_by_seniority",
    lambda s, d: CD.salary_by_category(
        _answer("q2_compensation_by_seniority_all_years")(s, d), "seniority", "seniority_label", S.SENIORITY_LABELS
    ),
    _category_sql("seniority", "seniority_label", S.SENIORITY_LABELS),
)
add(
    "chart_salary_by_work_model",
    lambda s, d: CD.salary_by_category(
        _answer("q6_compensation_by_work_model_all_years")(s, d), "current_work_model", "work_model_label",
        S.WORK_MODEL_SALARY_LABELS,
    ),
    _category_sql("current_work_model", "work_model_label", S.WORK_MODEL_SALARY_LABELS),
)
add(
    "chart_gender_by_edition",
    lambda s, d: CD.gender_by_edition(_answer("q3_gender_overall_by_year")(s, d)),
    f"WITH {P}, {oracle.REPRESENTATION} SELECT survey_year, {_ED_LABEL} AS survey_year_label, {_case('gender', S.GENDER_LABELS)} AS gender_label, "
    "round(share_within_bucket, 6) AS share_within_bucket FROM rep WHERE cross_dimension = 'overall' AND gender <> 'UNKNOWN'",
)
add(
    "chart_gender_funnel",
    lambda s, d: CD.gender_funnel(_answer("q3_gender_share_by_seniority")(s, d)),
    f"WITH {P}, {oracle.REPRESENTATION} SELECT survey_year, {_ED_LABEL} AS survey_year_label, "
    f"{_case('cross_dimension_value', S.SENIORITY_LABELS)} AS seniority_label, round(share_within_bucket, 6) AS share_within_bucket "
    "FROM rep WHERE cross_dimension = 'seniority' AND gender = 'FEMALE' AND survey_year IN ('year_1', 'year_3')",
)
add(
    "chart_top_technologies",
    lambda s, d: CD.top_technologies(_answer("q4_technology_adoption_latest_year")(s, d)),
    f"WITH {B} SELECT technology, round(adoption_rate, 6) AS adoption_rate FROM trend WHERE {_LATEST} "
    "ORDER BY trend.adoption_rate DESC, technology LIMIT 10",
)
add(
    "chart_technology_movers",
    lambda s, d: CD.technology_movers(_answer("q4_technology_yoy_change_latest_year")(s, d)),
    f"WITH {B}, m AS (SELECT technology, yoy, row_number() OVER (ORDER BY yoy DESC, technology) AS up, "
    f"row_number() OVER (ORDER BY yoy, technology) AS down FROM trend WHERE {_LATEST} AND yoy IS NOT NULL) "
    "SELECT technology, round(yoy, 6) AS yoy_pp_change_vs_prev_survey, CASE WHEN yoy > 0 THEN 'Alta' ELSE 'Queda' END AS sign "
    "FROM m WHERE up <= 6 OR down <= 6",
)
add(
    "chart_ai_metrics",
    lambda s, d: CD.ai_metrics(_answer("q5_ai_adoption_overview")(s, d)),
    f"WITH {AI} SELECT survey_year, {_ED_LABEL} AS survey_year_label, {_case('metric', S.AI_METRIC_LABELS)} AS metric_label, "
    f"round(rate, 6) AS rate FROM ai_rates WHERE question_available AND metric IN ({', '.join(repr(m) for m in S.AI_METRIC_LABELS)})",
)
add(
    "chart_region_spread",
    lambda s, d: CD.region_spread(_answer("q6_compensation_by_region_latest_year")(s, d)),
    f"WITH {P}, {oracle.compensation('region')} SELECT region, CAST(respondent_count AS BIGINT) AS respondent_count, "
    "round(median_salary_midpoint, 6) AS median_salary_midpoint, round(salary_iqr / 2, 6) AS spread, "
    "round(median_salary_midpoint - salary_iqr / 2, 6) AS low, round(median_salary_midpoint + salary_iqr / 2, 6) AS high "
    f"FROM comp WHERE {_LATEST}",
)
add(
    "chart_top_skills",
    lambda s, d: CD.top_skills(_answer("q7_skill_priority_ranking")(s, d)),
    f"WITH {', '.join(_SCORE_CTES)} SELECT technology, round(priority_score, 6) AS priority_score FROM score "
    "ORDER BY score.priority_score DESC, technology LIMIT 10",
)

# ---- Sources, keys, sinks ---------------------------------------------------------------

_EDITION_CASE = (
    "CASE WHEN year(o_orderdate) <= 1996 THEN 'year_1' WHEN year(o_orderdate) <= 1998 THEN 'year_2' ELSE 'year_3' END"
)


@query(
    "ingest_metadata",
    "SELECT 'orders' AS survey_year, 'orders.parquet' AS source_file, true AS stamped, o_orderkey, o_custkey, "
    "o_orderstatus, round(o_totalprice, 6) AS o_totalprice, o_orderpriority FROM orders",
)
def _(spark, sf_dir):
    landed = bronze.with_lineage(panel.scan(spark, sf_dir, "orders"), "orders", "orders.parquet")
    return landed.select(
        "survey_year", "source_file", F.col("ingestion_timestamp").isNotNull().alias("stamped"),
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
    )


@query(
    "surrogate_key",
    "SELECT o_orderkey, o_custkey, printf('orders_%06d', row_number() OVER (ORDER BY o_orderkey) - 1) AS respondent_id FROM orders",
)
def _(spark, sf_dir):
    numbered = bronze.number_parquet_rows(panel.scan(spark, sf_dir, "orders"), "row")
    return numbered.select(
        "o_orderkey", "o_custkey", F.format_string("orders_%06d", F.col("row")).alias("respondent_id")
    )


@query(
    "surrogate_key_csv",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_number FROM orders",
)
def _(spark, sf_dir):
    """The number every order gets from its place in the CSV files."""
    path = f"{new_folder(spark, 'csv')}/orders"
    sinks.write_csv(panel.scan(spark, sf_dir, "orders").repartitionByRange(6, "o_orderkey").sortWithinPartitions("o_orderkey"), path)
    numbered = bronze.number_rows(tables.read_headered_csv(spark, path, multi_line=False), "row_number")
    return numbered.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "row_number")


@query(
    "csv_round_trip",
    "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment FROM customer",
)
def _(spark, sf_dir):
    """Written as headered CSV and read back as strings."""
    path = f"{new_folder(spark, 'csv')}/customer"
    sinks.write_answer(panel.scan(spark, sf_dir, "customer"), path)
    back = tables.read_headered_csv(spark, path)
    return back.select(
        F.col("c_custkey").try_cast("bigint").alias("c_custkey"), "c_name",
        F.col("c_nationkey").try_cast("bigint").alias("c_nationkey"),
        F.col("c_acctbal").try_cast("double").alias("c_acctbal"), "c_mktsegment",
    )


@query(
    "partitioned_overwrite",
    f"SELECT {_EDITION_CASE} AS survey_year, count(*) AS respondent_count, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1",
)
def _(spark, sf_dir):
    """Partitioned by edition, one edition written again: the others stay, nothing doubles."""
    path = f"{new_folder(spark, 'partitioned')}/orders"
    tagged = panel.scan(spark, sf_dir, "orders").selectExpr(f"{panel.EDITION_SQL} AS survey_year", "o_orderkey", "o_custkey")
    sinks.write_partitioned(tagged, path)
    sinks.write_partitioned(tagged.where(F.col("survey_year") == "year_2"), path)
    return spark.read.parquet(path).groupBy("survey_year").agg(
        F.count(F.lit(1)).alias("respondent_count"), F.count_distinct("o_custkey").alias("customers")
    )


@query(
    "catalog_sql",
    f"WITH {P}, {oracle.market()} SELECT survey_year, dimension_value AS region, round(respondent_share_within_year, 6) AS share "
    "FROM market WHERE dimension = 'region' AND respondent_share_within_year > 0.2",
)
def _(spark, sf_dir):
    """Ad-hoc SQL over a registered Gold table."""
    tables.register_views({"panelloom_market_overview": panel.gold(spark, sf_dir, "gold_market_overview")})
    return spark.sql(
        "SELECT survey_year, dimension_value AS region, respondent_share_within_year AS share "
        "FROM panelloom_market_overview WHERE dimension = 'region' AND respondent_share_within_year > 0.2"
    )


@query("published_table", GOLD_SQL["gold_technology_adoption_by_year"])
def _(spark, sf_dir):
    """A Gold table published over an external folder and read back through the catalog by its name."""
    name = f"panelloom_adoption_{zlib.crc32(sf_dir.encode())}"
    sinks.publish(panel.gold(spark, sf_dir, "gold_technology_adoption_by_year"), name, f"{new_folder(spark, 'published')}/{name}")
    return spark.sql(f"SELECT * FROM {name}")


@query(
    "csv_round_trip_texts",
    "SELECT doc_id, nullif(text, '') AS text, nullif(lang, '') AS lang FROM documents",
)
def _(spark, sf_dir):
    """Texts with quotes, commas, line breaks and blanks at their ends, written as CSV and read back."""
    path = f"{new_folder(spark, 'csv-texts')}/documents"
    sinks.write_csv(panel.scan(spark, sf_dir, "documents").select("doc_id", "text", "lang"), path)
    return tables.read_headered_csv(spark, path).withColumn("doc_id", F.col("doc_id").cast("bigint"))


@query(
    "stream_new_files",
    f"SELECT {_EDITION_CASE} AS survey_year, count(*) AS respondent_count, count(*) AS distinct_keys, count(*) - 1 AS last_row, "
    "sum(o_orderkey)::BIGINT AS orders FROM orders GROUP BY 1",
)
def _(spark, sf_dir):
    """All editions in two drops each, the second landed under a new checkpoint: nothing is lost and keys continue."""
    root = new_folder(spark, "stream")
    orders = panel.scan(spark, sf_dir, "orders").selectExpr(f"{panel.EDITION_SQL} AS ed", "o_orderkey", "o_orderstatus")
    landed = []
    for edition in S.EDITIONS:
        own = orders.where(F.col("ed") == edition).drop("ed")
        for run, status in enumerate((("F", "O"), ("P",))):
            drop = f"{root}/landing/{edition}/{run}"
            sinks.write_csv(own.where(F.col("o_orderstatus").isin(*status)), drop)
            table = land_new_files(spark, drop, f"{root}/bronze", f"{root}/progress/{edition}/{run}", edition)
        landed.append(table.select("survey_year", "respondent_id", "o_orderkey"))
    rows = reduce(DataFrame.unionByName, landed)
    return rows.groupBy("survey_year").agg(
        F.count(F.lit(1)).alias("respondent_count"), F.count_distinct("respondent_id").alias("distinct_keys"),
        F.max(F.substring_index("respondent_id", "_", -1).cast("bigint")).alias("last_row"), F.sum(F.col("o_orderkey").cast("bigint")).alias("orders"),
    )


# ---- Header resolution ------------------------------------------------------------------


@query(
    "resolve_fields",
    f"WITH {P} SELECT survey_year, count(*) AS respondent_count, count(region) AS with_region, count(salary_open_ended) AS with_salary, "
    "count(CASE WHEN survey_year <> 'year_1' THEN 1 END) AS with_ethnicity FROM panel GROUP BY 1",
)
def _(spark, sf_dir):
    """Canonical fields found by question code in three header dialects; unasked ones are NULL."""
    fields = [*S.FIELD_CODES]
    answers = panel.raw_panel(spark, sf_dir, fields)
    parts = {}
    for edition in S.EDITIONS:
        headers = {h: f for h, f in landing.edition_headers(edition).items() if f in fields}
        raw = answers.where(F.col("survey_year") == edition).select(
            F.lit(edition).alias("survey_year"), *[F.col(f).alias(h) for h, f in headers.items()]
        )
        found = resolve_fields(raw.columns, S.field_codes(edition), S.HEADER_DIALECT[edition])
        parts[edition] = raw.select(
            "survey_year",
            *[(F.lit(None).cast("string") if c is None else F.col(f"`{c}`")).alias(f) for f, c in found.items()],
        )
    return silver.stack(parts).groupBy("survey_year").agg(
        F.count(F.lit(1)).alias("respondent_count"),
        F.count("region").alias("with_region"),
        F.count("salary_band").alias("with_salary"),
        F.count("ethnicity").alias("with_ethnicity"),
    )


@query(
    "question_availability",
    "SELECT field, survey_year, CASE WHEN field IN ('ethnicity', 'pcd_flag') AND survey_year = 'year_1' THEN false ELSE true END AS question_available, "
    "CASE WHEN field IN ('ethnicity', 'pcd_flag') AND survey_year = 'year_1' THEN 0 ELSE n END AS answer_slots FROM "
    f"(SELECT unnest([{', '.join(repr(f) for f in S.FIELD_CODES)}]) AS field), "
    f"(SELECT {_EDITION_CASE} AS survey_year, count(*) AS n FROM orders GROUP BY 1)",
)
def _(spark, sf_dir):
    """Which edition asked which field, with the number of respondents who could answer."""
    headers = {e: list(landing.edition_headers(e)) for e in S.EDITIONS}
    asked = silver.question_availability(spark, headers).select("field", "survey_year", "question_available")
    sizes = SH.counts_by(panel.raw_panel(spark, sf_dir, []), ["survey_year"])
    return asked.join(sizes, "survey_year").select(
        "field", "survey_year", "question_available",
        F.when(F.col("question_available"), F.col("respondent_count")).otherwise(0).alias("answer_slots"),
    )


# ---- Silver tables and mapping operators ------------------------------------------------

_FACT_COLUMNS = (
    "gender", "seniority", "employment_status", "current_work_model", "ideal_work_model", "current_role", "region",
    "manager_flag", "salary_lower_bound", "salary_upper_bound", "salary_midpoint", "salary_open_ended",
    "salary_anomaly_flag", "sector", "state",
)
_FACT = "survey_year respondent_id " + " ".join(
    f"~{c}" if c in ("salary_lower_bound", "salary_upper_bound", "salary_midpoint") else c for c in _FACT_COLUMNS
)
add("fact_respondent", lambda s, d: panel.fact(s, d, _FACT_COLUMNS), sql([P], "panel", _FACT))

_GROUPED = ("survey_year", "current_role", "seniority", "salary_open_ended")


@query(
    "from_raw_fact_respondent",
    f"WITH {P} SELECT survey_year, current_role, seniority, salary_open_ended, count(*) AS respondent_count, "
    "count(*) FILTER (WHERE manager_flag) AS managers, round(sum(salary_midpoint), 6) AS salary_total FROM panel GROUP BY 1, 2, 3, 4",
)
def _(spark, sf_dir):
    fact = landing.stored_silver(spark, sf_dir).fact
    return fact.groupBy(*_GROUPED).agg(
        F.count(F.lit(1)).alias("respondent_count"),
        F.count_if(F.coalesce("manager_flag", F.lit(False))).alias("managers"),
        F.sum("salary_midpoint").alias("salary_total"),
    )


@query(
    "map_category",
    f"WITH {P} SELECT respondent_id, seniority FROM panel",
)
def _(spark, sf_dir):
    raw = panel.raw_panel(spark, sf_dir, ["seniority"])
    seniority = silver.default_mappings(spark)["seniority"]
    return M.map_values(raw, "seniority", {"seniority": "canonical_value"}, seniority).select("respondent_id", "seniority")


@query("map_scoped", f"WITH {P} SELECT survey_year, current_role_raw, current_role, count(*) AS n FROM panel GROUP BY 1, 2, 3")
def _(spark, sf_dir):
    raw = panel.raw_panel(spark, sf_dir, ["current_role"]).withColumnRenamed("current_role", "current_role_raw")
    roles = silver.default_mappings(spark)["role"]
    mapped = M.map_values(
        raw, "current_role_raw", {"current_role": "canonical_role"}, roles, also_on={"survey_year": "survey_year"}
    )
    return mapped.groupBy("survey_year", "current_role_raw", "current_role").agg(F.count(F.lit(1)).alias("n"))


_RANKS = ", ".join(f"('{c}', {r})" for c, r in {c: r for _, c, r in S.COMPANY_SIZE if r}.items())


@query(
    "ordinal_map",
    f"WITH {P}, ranks(company_size, r) AS (VALUES {_RANKS}) SELECT survey_year, company_size, CAST(r AS BIGINT) AS ordinal_rank, "
    "count(*) AS n FROM panel LEFT JOIN ranks USING (company_size) GROUP BY 1, 2, 3",
)
def _(spark, sf_dir):
    raw = panel.raw_panel(spark, sf_dir, ["company_size"])
    sizes = silver.default_mappings(spark)["company_size"]
    mapped = M.map_values(raw, "company_size", {"company_size": "canonical_value", "ordinal_rank": "ordinal_rank"}, sizes)
    return mapped.groupBy("survey_year", "company_size", "ordinal_rank").agg(F.count(F.lit(1)).alias("n"))


_GROUP = oracle.compensation("comparability_group")
add(
    "comparability_rollup",
    lambda s, d: G.compensation_by(panel.fact(s, d, ("comparability_group", "salary_midpoint")), "comparability_group"),
    sql([P, _GROUP], "comp", f"survey_year comparability_group {_STATS}"),
)


@query(
    "unmapped_values",
    "SELECT DISTINCT 'o_orderpriority' AS field, CAST(NULL AS VARCHAR) AS edition, o_orderpriority AS raw_value FROM orders "
    "WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') "
    f"UNION SELECT DISTINCT 'o_orderstatus', survey_year, o_orderstatus FROM (SELECT *, {_EDITION_CASE} AS survey_year FROM orders) "
    "WHERE NOT (o_orderstatus = 'F' OR (o_orderstatus = 'O' AND survey_year = 'year_1'))",
)
def _(spark, sf_dir):
    """Values two incomplete mappings, one of them scoped by edition, do not know."""
    priority = tables.mapping_table(spark, [("1-URGENT", "HIGH"), ("2-HIGH", "HIGH"), (None, "UNKNOWN")])
    status = M.expand_scope(
        tables.literal_table(spark, [("F", "all"), ("O", "year_1")], "raw_value string, scope string"), S.EDITIONS, "scope"
    )
    orders = panel.scan(spark, sf_dir, "orders").selectExpr(
        f"{panel.EDITION_SQL} AS survey_year", "o_orderpriority", "o_orderstatus"
    )
    specs = [("o_orderpriority", priority, "raw_value"), ("o_orderstatus", status, "raw_value")]
    return M.unmapped_values(orders, specs, "survey_year")


@query(
    "unmapped_sample",
    "SELECT 'p_name' AS field, CAST(NULL AS VARCHAR) AS edition, p_name AS raw_value FROM (SELECT DISTINCT p_name FROM part JOIN lineitem ON l_partkey = p_partkey "
    "WHERE split_part(p_name, ' ', 2) NOT IN ('anvil', 'bolt')) ORDER BY p_name LIMIT 7",
)
def _(spark, sf_dir):
    """The first values no mapping knows: a bounded report, the same in every run."""
    parts = panel.scan(spark, sf_dir, "part")
    lines = panel.scan(spark, sf_dir, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    known = parts.where(F.split_part("p_name", F.lit(" "), F.lit(2)).isin("anvil", "bolt")).select(F.col("p_name").alias("raw_value")).distinct()
    return M.unmapped_sample(lines.select("p_name"), [("p_name", known, "raw_value")], sample=7)


_HISTORY = (
    ("1-URGENT", "TOP", None, "1996-07-01", "v1"), ("1-URGENT", "CRITICAL", "1996-07-01", None, "v2"), ("2-HIGH", "TOP", None, None, "v1"),
    ("3-MEDIUM", "NORMAL", None, "1995-01-01", "v1"), ("3-MEDIUM", "NORMAL", "1995-01-01", "1997-03-15", "v2"), ("3-MEDIUM", "LATER", "1997-03-15", None, "v3"),
    ("4-NOT SPECIFIED", "NORMAL", "1994-01-01", None, "v1"),
)
_HISTORY_SQL = "history(raw_value, canonical_value, valid_from, valid_to, mapping_version) AS (VALUES " + ", ".join(
    "(" + ", ".join("NULL" if v is None else f"'{v}'" for v in row) + ")" for row in _HISTORY
) + ")"
_IN_FORCE = "raw_value = o_orderpriority AND o_orderdate >= coalesce(valid_from, '0001-01-01')::TIMESTAMP AND o_orderdate < coalesce(valid_to, '9999-01-01')::TIMESTAMP"


def _priority_history(spark):
    """The history as a mapping file, written and read back, its intervals checked."""
    path = f"{new_folder(spark, 'mapping')}/mapping_priority.csv"
    schema = "raw_value string, canonical_value string, valid_from string, valid_to string, mapping_version string"
    sinks.write_csv(tables.literal_table(spark, _HISTORY, schema), path)
    history = tables.read_mapping(spark, path).withColumns({c: F.col(c).cast("timestamp") for c in (EF.START, EF.END)})
    EF.require_intervals(history, ["raw_value"])
    return history


@query(
    "map_as_of",
    f"WITH {_HISTORY_SQL} SELECT canonical_value AS priority, mapping_version, count(*) AS orders, round(sum(o_totalprice), 2) AS total, "
    f"CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders LEFT JOIN history ON {_IN_FORCE} GROUP BY 1, 2",
)
def _(spark, sf_dir):
    """Every order's priority by the mapping row in force on its date."""
    mapped = EF.map_as_of(
        panel.scan(spark, sf_dir, "orders"), "o_orderpriority", {"priority": "canonical_value", "mapping_version": "mapping_version"}, _priority_history(spark), "o_orderdate"
    )
    return mapped.groupBy("priority", "mapping_version").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.sum("o_orderkey").alias("keys")
    )


@query(
    "uncovered_values",
    f"WITH {_HISTORY_SQL} SELECT o_orderpriority AS raw_value, min(o_orderdate) AS first_at, max(o_orderdate) AS last_at, count(*) AS rows FROM orders "
    f"WHERE NOT EXISTS (SELECT 1 FROM history WHERE {_IN_FORCE}) GROUP BY 1",
)
def _(spark, sf_dir):
    return EF.uncovered_values(panel.scan(spark, sf_dir, "orders"), "o_orderpriority", _priority_history(spark), "o_orderdate")


_VERSIONED = ("current_role", "current_work_model", "employment_status", "gender", "ideal_work_model", "seniority")


def _versions_sql(seniority: str) -> str:
    return "'" + ",".join(f"{c}={seniority if c == 'seniority' else S.MAPPING_VERSION}" for c in _VERSIONED) + "'"


add(
    "from_raw_mapping_versions",
    lambda s, d: SH.counts_by(landing.stored_silver(s, d).fact, ["survey_year", "seniority", "mapping_versions"]),
    f"WITH {P} SELECT survey_year, seniority, CASE WHEN survey_year = 'year_1' THEN {_versions_sql('v1')} ELSE {_versions_sql('v2')} END AS mapping_versions, "
    "count(*) AS respondent_count FROM panel GROUP BY 1, 2, 3",
)


@query(
    "option_labels_mapped",
    f"WITH {B} SELECT technology AS canonical_value, count(*) AS n FROM bridge GROUP BY 1",
)
def _(spark, sf_dir):
    """Option labels harmonized after the unpivot through the technology table."""
    names = {c: next((a for a, n in S.DATABASE_ALIASES.items() if n == name), name) for c, name in panel.OPTION_COLUMNS.items()}
    long = O.option_bridge(panel.block(spark, sf_dir), ["respondent_id", "survey_year"], names, option="label")
    mapped = M.map_values(long, "label", {"canonical_value": "canonical_value"}, silver.default_mappings(spark)["technology"])
    offered = mapped.where((F.col("canonical_value") != "SAP") | (F.col("survey_year") == "year_1"))
    return offered.groupBy("canonical_value").agg(F.count(F.lit(1)).alias("n"))


_BAND = "~lower_bound ~upper_bound ~midpoint open_ended anomaly_flag"


@query(
    "parse_band",
    sql([P], "(SELECT respondent_id, salary_lower_bound AS lower_bound, salary_upper_bound AS upper_bound, salary_midpoint AS midpoint, "
        "salary_open_ended AS open_ended, salary_anomaly_flag AS anomaly_flag FROM panel)", f"respondent_id {_BAND}"),
)
def _(spark, sf_dir):
    """Bounds parsed row by row from the label."""
    raw = panel.raw_panel(spark, sf_dir, ["salary_band"])
    return raw.withColumn("band", parse_band(F.col("salary_band"))).select("respondent_id", "band.*")


@query(
    "band_lookup",
    sql([P], "panel", "respondent_id ~salary_lower_bound ~salary_upper_bound ~salary_midpoint salary_open_ended salary_anomaly_flag"),
)
def _(spark, sf_dir):
    raw = panel.raw_panel(spark, sf_dir, ["salary_band"])
    return M.attach_bands(raw, "salary_band", silver.default_mappings(spark)["salary_band"]).drop("salary_band", "survey_year")


# ---- Shares and statistics --------------------------------------------------------------

add(
    "share_null_keep",
    lambda s, d: G.market_overview(panel.fact(s, d, G.MARKET_DIMENSIONS), null_policy="keep"),
    sql([P, oracle.market("keep")], "market", _MARKET),
)


@query(
    "share_single",
    "SELECT lang, source, count(*) AS documents, round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY lang) AS DOUBLE), 6) AS share "
    "FROM documents GROUP BY lang, source",
)
def _(spark, sf_dir):
    documents = panel.scan(spark, sf_dir, "documents")
    return SH.share_of_total(SH.counts_by(documents, ["lang", "source"], "documents"), ["lang"], "documents", "share")


@query("edition_totals", f"SELECT {_EDITION_CASE} AS survey_year, count(*) AS respondent_count FROM orders GROUP BY 1")
def _(spark, sf_dir):
    return SH.counts_by(panel.raw_panel(spark, sf_dir, []), ["survey_year"])


_NAMES = {"known": "known_count", "median": "median_value", "mean": "mean_value", "p25": "p25", "p75": "p75", "iqr": "iqr"}


@query(
    "stats_quantity",
    "SELECT l_returnflag, l_linestatus, count(*) AS respondent_count, count(v) AS known_count, round(quantile_cont(v, 0.5), 6) AS median_value, "
    "round(avg(v), 6) AS mean_value, round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.75), 6) AS p75, "
    "round(quantile_cont(v, 0.75) - quantile_cont(v, 0.25), 6) AS iqr, count(*) < 30 AS low_sample_flag FROM "
    "(SELECT *, CASE WHEN l_discount <> 0 THEN l_quantity END AS v FROM lineitem) GROUP BY 1, 2",
)
def _(spark, sf_dir):
    """Quantity has fifty values, so it counts as a banded measure; undiscounted lines are unknown."""
    lines = panel.scan(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", F.when(F.col("l_discount") != 0, F.col("l_quantity")).alias("quantity")
    )
    return ST.distribution_stats(lines, ["l_returnflag", "l_linestatus"], "quantity", names=_NAMES)


@query(
    "stats_open_domain",
    "SELECT o_orderpriority, round(quantile_cont(o_totalprice, 0.25), 6) AS p25, round(quantile_cont(o_totalprice, 0.5), 6) AS median_value, "
    "round(quantile_cont(o_totalprice, 0.75), 6) AS p75, round(quantile_cont(o_totalprice, 0.99), 6) AS p99 FROM orders GROUP BY 1",
)
def _(spark, sf_dir):
    """Exact percentiles of a measure with an open value domain, without collecting a group."""
    orders = panel.scan(spark, sf_dir, "orders")
    quantiles = ST.exact_quantiles(orders, ["o_orderpriority"], "o_totalprice", [0.25, 0.5, 0.75, 0.99])
    names = ("p25", "median_value", "p75", "p99")
    return quantiles.select("o_orderpriority", *[F.get("quantiles", i).alias(n) for i, n in enumerate(names)])


def _open_stats(table: str, keys: str, value: str) -> str:
    return (
        f"SELECT {keys}, count(*) AS respondent_count, count({value}) AS known_count, round(quantile_cont({value}::DOUBLE, 0.5), 6) AS median_value, "
        f"round(avg({value}::DOUBLE), 4) AS mean_value, round(quantile_cont({value}::DOUBLE, 0.25), 6) AS p25, round(quantile_cont({value}::DOUBLE, 0.75), 6) AS p75, "
        f"round(quantile_cont({value}::DOUBLE, 0.75) - quantile_cont({value}::DOUBLE, 0.25), 6) AS iqr, count(*) < 30 AS low_sample_flag FROM {table} GROUP BY {keys}"
    )



@query("stats_extendedprice", _open_stats("lineitem", "l_returnflag, l_linestatus", "l_extendedprice"))
def _(spark, sf_dir):
    """All eight measures of a value with an open domain, by a few hot keys."""
    lines = panel.scan(spark, sf_dir, "lineitem")
    stats = ST.open_distribution_stats(lines, ["l_returnflag", "l_linestatus"], "l_extendedprice", names=_NAMES)
    return stats.withColumn("mean_value", F.round("mean_value", 4))


@query("stats_event_value", _open_stats("events", "event_type", "value"))
def _(spark, sf_dir):
    stats = ST.open_distribution_stats(panel.scan(spark, sf_dir, "events"), ["event_type"], "value", names=_NAMES)
    return stats.withColumn("mean_value", F.round("mean_value", 4))


# ---- Options, rank and trend ------------------------------------------------------------

add("option_bridge", panel.bridge, sql([B], "bridge", "respondent_id survey_year technology technology_family selected"))
add("option_adoption", panel.adoption, sql([B], "adoption", _ADOPTION))
add(
    "option_adoption_from_bridge",
    lambda s, d: O.adoption_from_bridge(panel.bridge(s, d)),
    sql([B], "adoption", _ADOPTION),
)


@query(
    "eligible_counts",
    f"WITH {B} SELECT survey_year, count(*) AS eligible_respondents FROM shown GROUP BY 1",
)
def _(spark, sf_dir):
    return O.eligible_counts(panel.block(spark, sf_dir), "survey_year", list(panel.OPTION_COLUMNS))


@query(
    "adoption_joined_eligible",
    sql([B], "adoption", _ADOPTION),
)
def _(spark, sf_dir):
    """Bridge counts joined with separately counted eligible respondents."""
    block = panel.block(spark, sf_dir)
    eligible = O.eligible_counts(block, "survey_year", list(panel.OPTION_COLUMNS))
    return O.adoption_from_bridge(panel.bridge(spark, sf_dir), eligible)


@query(
    "adoption_rank",
    sql([B], "ranked", "technology survey_year ~adoption_rate #rank"),
)
def _(spark, sf_dir):
    return TR.with_rank(panel.adoption(spark, sf_dir), "survey_year", "adoption_rate").select(
        "technology", "survey_year", "adoption_rate", "rank"
    )


@query("adoption_yoy", sql([B], "trend", "technology survey_year ~adoption_rate ~yoy=change_pp"))
def _(spark, sf_dir):
    changed = TR.with_change(panel.adoption(spark, sf_dir), "technology", "survey_year", S.EDITIONS, "adoption_rate", "change_pp")
    return changed.select("technology", "survey_year", "adoption_rate", "change_pp")


_GROWTH = (
    "growth AS (SELECT technology, (max(CASE WHEN survey_year = 'year_3' THEN adoption_rate END) - "
    "max(CASE WHEN survey_year = 'year_1' THEN adoption_rate END)) * 100 AS adoption_growth_pp FROM adoption GROUP BY 1)"
)
add(
    "growth_first_last",
    lambda s, d: G.adoption_growth(panel.adoption(s, d)),
    sql([B, _GROWTH], "growth", "technology ~adoption_growth_pp"),
)
add(
    "no_trend",
    lambda s, d: TR.without_trend(G.adoption_growth(panel.adoption(s, d)), "technology", "adoption_growth_pp"),
    f"WITH {B}, {_GROWTH} SELECT technology FROM growth WHERE adoption_growth_pp IS NULL",
)


@query(
    "options_with_trend",
    f"WITH {B}, {_GROWTH} SELECT survey_year, technology, count(*) FILTER (WHERE selected) AS users FROM bridge "
    "WHERE technology IN (SELECT technology FROM growth WHERE adoption_growth_pp IS NOT NULL) GROUP BY 1, 2",
)
def _(spark, sf_dir):
    """Semi-join: bridge rows of options that have a trend."""
    trend = G.adoption_growth(panel.adoption(spark, sf_dir)).where(F.col("adoption_growth_pp").isNotNull())
    kept = panel.bridge(spark, sf_dir).join(trend, "technology", "left_semi")
    return kept.groupBy("survey_year", "technology").agg(F.count_if("selected").alias("users"))


def _family_sql(family: str) -> str:
    """Every edition prints its own wording; the SQL names an option by the latest of them, by its number."""
    _, answer, values = panel.FAMILIES[family]
    editions = [e for e in S.EDITIONS if e in S.OPTION_FAMILIES[family]]
    printed = {e: panel.printed_options(family, e) for e in editions}
    options = {}
    for i in range(len(values)):
        having = tuple(e for e in editions if i in printed[e])
        options[i] = (printed[having[-1]][i], having)
    return sql([oracle.family(family, options, answer, list(values))], "trend", _TREND)


for _family in panel.FAMILIES:
    add(f"family_{_family.lower()}", lambda s, d, f=_family: panel.family_adoption(s, d, f), _family_sql(_family))


_KEY_SQL = "trim(regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}+#]+', ' ', 'g'))"
_TYPED = "CASE l_returnflag WHEN 'A' THEN upper(p_name) || '.' WHEN 'R' THEN replace(p_name, 'l', 'll') ELSE replace(p_name, 'i', 'y') END"


@query(
    "unmapped_advice",
    f"WITH typed AS (SELECT DISTINCT p_type, {_TYPED} AS raw_value FROM lineitem JOIN part ON l_partkey = p_partkey), "
    "known AS (SELECT DISTINCT p_type, p_name AS suggestion FROM part), "
    "unknown AS (SELECT * FROM typed t WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.p_type = t.p_type AND suggestion = raw_value)), "
    f"pairs AS (SELECT u.*, suggestion, {_KEY_SQL.format('raw_value')} AS a, {_KEY_SQL.format('suggestion')} AS b FROM unknown u JOIN known k ON k.p_type = u.p_type), "
    "near AS (SELECT *, levenshtein(a, b) AS distance FROM pairs WHERE levenshtein(a, b) <= floor(0.4::DOUBLE * greatest(length(a), length(b)))), "
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY p_type, raw_value ORDER BY distance, suggestion) AS place FROM near) "
    "SELECT p_type, raw_value, suggestion, CAST(distance AS BIGINT) AS distance, CAST(place AS BIGINT) AS place FROM ranked WHERE place <= 3",
)
def _(spark, sf_dir):
    """Part names as lines typed them: the three nearest names of the type for each one no part has."""
    parts = panel.scan(spark, sf_dir, "part")
    lines = panel.scan(spark, sf_dir, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    typed = lines.select("p_type", F.expr(_TYPED).alias("raw_value"))
    known = parts.select("p_type", F.col("p_name").alias("raw_value")).distinct()
    unknown = typed.distinct().join(known, ["p_type", "raw_value"], "left_anti")
    return SM.nearest_known(unknown, known, ["p_type"])


# ---- AI block ---------------------------------------------------------------------------

_FLAGS = " ".join(S.GENAI_METRICS)
add(
    "fact_ai_adoption",
    panel.ai_facts,
    sql([AI], "ai", f"respondent_id survey_year enterprise_ai_priority {_FLAGS} genai_question_available genai_eligible"),
)
add(
    "ai_available_only",
    lambda s, d: AN.ai_adoption_available(panel.gold(s, d, "gold_ai_adoption_overview")),
    sql([AI], "ai_rates WHERE question_available", "survey_year metric #eligible_respondents ~rate"),
)
add(
    "availability_by_edition",
    lambda s, d: A.availability_by_period(panel.gold(s, d, "gold_ai_adoption_overview"), "survey_year"),
    f"WITH {AI} SELECT survey_year, bool_or(question_available) AS question_available FROM ai_rates GROUP BY 1",
)

_WEEK = "CASE WHEN day(ts) <= 10 THEN 'ten_days_1' WHEN day(ts) <= 20 THEN 'ten_days_2' ELSE 'ten_days_3' END"
_TYPES = ("click", "error", "purchase", "signup", "view")
_PERIODS = ("ten_days_1", "ten_days_2", "ten_days_3", "ten_days_4")
_EVENT_RATES = f"""
people AS (SELECT DISTINCT user_id FROM events),
grid AS (SELECT user_id, unnest([{', '.join(repr(p) for p in _PERIODS)}]) AS period FROM people),
seen AS (SELECT user_id, {_WEEK} AS period, {', '.join(f"bool_or(event_type = '{t}') AS {t}" for t in _TYPES)} FROM events GROUP BY 1, 2),
flags AS (SELECT g.period, s.user_id IS NOT NULL AS shown, {', '.join(_TYPES)} FROM grid g LEFT JOIN seen s USING (user_id, period)),
rates AS ({' UNION ALL '.join(
    f"SELECT period, '{t}' AS metric, count(*) FILTER (WHERE shown) AS eligible, count(*) FILTER (WHERE shown AND {t}) AS hits FROM flags GROUP BY 1"
    for t in _TYPES)})"""


@query(
    "rates_with_availability",
    f"WITH {_EVENT_RATES} SELECT period, metric, eligible > 0 AS question_available, eligible AS eligible_respondents, "
    "CASE WHEN eligible > 0 THEN CAST(hits AS DOUBLE) END AS numerator, CASE WHEN eligible > 0 THEN round(hits / CAST(eligible AS DOUBLE), 6) END AS rate FROM rates",
)
def _(spark, sf_dir):
    """Users in ten-day periods of the event log; a fourth period had no log and is scaffolded."""
    events = panel.scan(spark, sf_dir, "events").selectExpr(
        "user_id", "event_type",
        "CASE WHEN dayofmonth(ts) <= 10 THEN 'ten_days_1' WHEN dayofmonth(ts) <= 20 THEN 'ten_days_2' ELSE 'ten_days_3' END AS period",
    )
    flags = events.groupBy("user_id", "period").agg(
        *[F.expr(f"CAST(bool_or(event_type = '{t}') AS DOUBLE) AS {t}") for t in _TYPES]
    )
    adopted = O.option_adoption(flags, {t: t for t in _TYPES}, period="period", option="metric", users="numerator")
    rates = adopted.select(
        "period", "metric", F.lit(True).alias("question_available"), "eligible_respondents",
        F.col("numerator").cast("double").alias("numerator"), F.col("adoption_rate").alias("rate"),
    )
    return A.scaffold(rates, "period", _PERIODS, "metric", _TYPES)


# ---- Score parts ------------------------------------------------------------------------

add(
    "skill_score_joined",
    lambda s, d: G.skill_priority_score(panel.bridge(s, d), panel.fact(s, d, G.PROFILE), panel.adoption(s, d)),
    GOLD_SQL["gold_skill_priority_score"],
)

add(
    "skill_components",
    lambda s, d: panel.gold(s, d, "gold_skill_priority_score").select("technology", "year_3_users", *S.SCORE_WEIGHTS),
    sql(_SCORE_CTES, "parts", f"technology #year_3_users {_COMPONENTS}"),
)


@query(
    "min_max_normalize",
    "WITH v AS (SELECT n_name, count(*) AS customers, avg(c_acctbal) AS balance, 7.0 AS constant FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1) "
    "SELECT n_name, round((customers - min(customers) OVER ()) / CAST(max(customers) OVER () - min(customers) OVER () AS DOUBLE), 6) AS normalized_customers, "
    "round((balance - min(balance) OVER ()) / (max(balance) OVER () - min(balance) OVER ()), 6) AS normalized_balance, CAST(0 AS DOUBLE) AS normalized_constant FROM v",
)
def _(spark, sf_dir):
    nations = panel.scan(spark, sf_dir, "customer").join(
        panel.scan(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    measured = nations.groupBy("n_name").agg(
        F.count(F.lit(1)).alias("customers"), F.avg("c_acctbal").alias("balance"), F.lit(7.0).alias("constant")
    )
    columns = ["customers", "balance", "constant"]
    return SC.normalize_rows(measured, columns).select("n_name", *[f"normalized_{c}" for c in columns])


@query(
    "distinct_users",
    f"WITH {B} SELECT technology, count(DISTINCT respondent_id) AS users FROM bridge WHERE selected GROUP BY 1 HAVING count(DISTINCT respondent_id) >= 30",
)
def _(spark, sf_dir):
    """Distinct respondents per option and the minimum-users cut."""
    users = panel.users(spark, sf_dir)
    return users.where(F.col("users") >= S.MIN_SAMPLE_SIZE)


# ---- Reshape, top-k ---------------------------------------------------------------------


@query(
    "pivot_share",
    "SELECT o_orderpriority, "
    + ", ".join(f"round(count(*) FILTER (WHERE {_EDITION_CASE} = '{e}') / CAST(sum(count(*) FILTER (WHERE {_EDITION_CASE} = '{e}')) OVER () AS DOUBLE), 4) AS {e}" for e in S.EDITIONS)
    + " FROM orders GROUP BY 1",
)
def _(spark, sf_dir):
    orders = panel.scan(spark, sf_dir, "orders").selectExpr(f"{panel.EDITION_SQL} AS survey_year", "o_orderpriority")
    shares = SH.share_within(orders, "survey_year", ["o_orderpriority"])
    wide = RS.pivot_periods(shares, "dimension_value", "survey_year", S.EDITIONS, "respondent_share_within_year", digits=4)
    return wide.withColumnRenamed("dimension_value", "o_orderpriority")


@query(
    "melt_share",
    f"WITH {P}, {oracle.market()} SELECT dimension_value, survey_year, round(respondent_share_within_year, 4) AS share FROM market WHERE dimension = 'region'",
)
def _(spark, sf_dir):
    wide = _answer("q1_market_structure_region")(spark, sf_dir)
    return RS.melt(wide, ["dimension_value"], list(S.EDITIONS), "survey_year", "share")


@query(
    "top_k_latest",
    "SELECT n_name, orders, rank_in_year FROM (SELECT n_name, count(*) AS orders, CAST(row_number() OVER (ORDER BY count(*) DESC, n_name) AS BIGINT) AS rank_in_year "
    f"FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE {_EDITION_CASE} = 'year_3' GROUP BY 1) WHERE rank_in_year <= 5",
)
def _(spark, sf_dir):
    """Five busiest nations of the latest edition."""
    states = SH.counts_by(panel.raw_panel(spark, sf_dir, ["state"]), ["survey_year", "state"], "orders")
    best = R.top_k(R.latest_only(states, "survey_year"), 5, "orders", "state")
    return SC.numbered_by(best, "orders", "state", "rank_in_year").select(
        F.col("state").alias("n_name"), "orders", "rank_in_year"
    )


@query(
    "movers",
    "WITH m AS (SELECT p_brand, avg(CASE WHEN l_returnflag = 'A' THEN l_quantity END) - avg(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS change "
    "FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY change DESC, p_brand) AS up, "
    "row_number() OVER (ORDER BY change, p_brand) AS down FROM m) SELECT p_brand, round(change, 6) AS change, "
    "CASE WHEN change > 0 THEN 'Alta' ELSE 'Queda' END AS sign FROM r WHERE up <= 4 OR down <= 4",
)
def _(spark, sf_dir):
    lines = panel.scan(spark, sf_dir, "lineitem").join(panel.scan(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))

    def mean(flag: str):
        return F.avg(F.when(F.col("l_returnflag") == flag, F.col("l_quantity")))

    change = lines.groupBy("p_brand").agg((mean("A") - mean("R")).alias("change"))
    return R.movers(change, 4, "p_brand", "change", S.CHANGE_SIGN_LABELS)


@query(
    "label_lookup",
    f"WITH {P} SELECT survey_year, {_case('seniority', {**S.SENIORITY_LABELS, 'UNKNOWN': 'UNKNOWN'})} AS label, count(*) AS n FROM panel GROUP BY 1, 2",
)
def _(spark, sf_dir):
    """Display labels from a table, the code itself where there is none."""
    labels = tables.literal_table(spark, S.SENIORITY_LABELS.items(), "code string, label string")
    counts = SH.counts_by(panel.fact(spark, sf_dir, ("seniority",)), ["survey_year", "seniority"], "n")
    return M.label_table(counts, "seniority", "label", labels, "code", "label").select("survey_year", "label", "n")


# ---- Data quality -----------------------------------------------------------------------

add(
    "reconcile",
    lambda s, d: Q.reconcile(panel.raw_panel(s, d, []), panel.fact(s, d, ("gender", "salary_midpoint")), "survey_year"),
    f"SELECT {_EDITION_CASE} AS survey_year, count(*) AS rows_before, count(*) AS rows_after, CAST(0 AS BIGINT) AS rows_lost FROM orders GROUP BY 1",
)
add(
    "from_raw_reconcile",
    lambda s, d: Q.reconcile(panel.raw_panel(s, d, []), landing.stored_silver(s, d).fact, "survey_year"),
    f"SELECT {_EDITION_CASE} AS survey_year, count(*) AS rows_before, count(*) AS rows_after, CAST(0 AS BIGINT) AS rows_lost FROM orders GROUP BY 1",
)
add(
    "key_unique",
    lambda s, d: Q.repeated_keys(panel.raw_panel(s, d, []), ["respondent_id"]),
    "SELECT printf('%06d', o_orderkey) AS respondent_id, count(*) AS rows FROM orders GROUP BY 1 HAVING count(*) > 1",
)
add(
    "from_raw_key_unique",
    lambda s, d: Q.repeated_keys(landing.stored_silver(s, d).fact, ["respondent_id"]),
    "SELECT printf('%06d', o_orderkey) AS respondent_id, count(*) AS rows FROM orders GROUP BY 1 HAVING count(*) > 1",
)
add(
    "from_raw_key_profile",
    lambda s, d: Q.key_profile(landing.stored_silver(s, d).fact, "survey_year", "respondent_id"),
    "SELECT survey_year, count(*) AS rows, count(*) AS distinct_keys, printf('%s_%06d', survey_year, 0) AS first_key, "
    f"printf('%s_%06d', survey_year, count(*) - 1) AS last_key FROM (SELECT {_EDITION_CASE} AS survey_year FROM orders) GROUP BY 1",
)
add(
    "from_raw_lineage",
    lambda s, d: landing.stored_silver(s, d).fact.groupBy("survey_year", "pipeline_version").agg(
        F.count(F.lit(1)).alias("respondent_count"), F.count("processing_timestamp").alias("stamped_rows")
    ),
    f"SELECT {_EDITION_CASE} AS survey_year, '{S.PIPELINE_VERSION}' AS pipeline_version, count(*) AS respondent_count, count(*) AS stamped_rows FROM orders GROUP BY 1",
)
add(
    "repeated_keys",
    lambda s, d: Q.repeated_keys(panel.scan(s, d, "lineitem"), ["l_partkey", "l_suppkey"]),
    "SELECT l_partkey, l_suppkey, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)

_UNKNOWN_FIELDS = ("gender", "employment_status", "seniority", "current_work_model", "current_role")
add(
    "unknown_matrix",
    lambda s, d: Q.value_rate_matrix(panel.fact(s, d, _UNKNOWN_FIELDS), "survey_year", S.EDITIONS, _UNKNOWN_FIELDS),
    f"WITH {P} " + " UNION ALL ".join(
        f"SELECT '{f}' AS field, " + ", ".join(
            f"round(avg(CASE WHEN survey_year = '{e}' THEN CASE WHEN {f} = 'UNKNOWN' THEN 1.0 ELSE 0.0 END END), 6) AS {e}" for e in S.EDITIONS
        ) + " FROM panel"
        for f in _UNKNOWN_FIELDS
    ),
)
_MISSING = ("region", "manager_flag", "salary_midpoint", "salary_open_ended", "current_role_raw", "state")
add(
    "missing_profile",
    lambda s, d: Q.missing_profile(panel.fact(s, d, ("region", "manager_flag", "salary_midpoint", "salary_open_ended", "current_role_raw", "current_role", "state")), _MISSING),
    f"WITH {P} " + " UNION ALL ".join(
        f"SELECT '{f}' AS \"column\", round(avg(CASE WHEN {f} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing_rate FROM panel" for f in _MISSING
    ),
)


@query(
    "missing_cells",
    f"WITH {B} SELECT e.survey_year, round(sum(34 - CASE WHEN s.o_orderkey IS NULL THEN 0 WHEN e.survey_year = 'year_1' THEN 34 ELSE 33 END) "
    "/ (34.0 * count(*)), 6) AS missing_rate FROM eds e LEFT JOIN shown s USING (o_orderkey) GROUP BY 1",
)
def _(spark, sf_dir):
    """Missing share of all block cells, mostly structural."""
    return Q.missing_cells(panel.block(spark, sf_dir), "survey_year", list(panel.OPTION_COLUMNS))


@query(
    "duplicate_rows",
    "SELECT lang, CAST(sum(n - 1) AS BIGINT) AS duplicated_rows FROM (SELECT lang, text, source, n_chars, count(*) AS n FROM documents GROUP BY ALL) GROUP BY 1",
)
def _(spark, sf_dir):
    """Copies of whole documents apart from the technical id."""
    return Q.duplicate_rows(panel.scan(spark, sf_dir, "documents"), "lang", ignore=["doc_id"])


@query(
    "duplicate_rows_with_id",
    "SELECT lang, CAST(sum(n - 1) AS BIGINT) AS duplicated_rows FROM (SELECT doc_id, lang, text, source, n_chars, count(*) AS n FROM documents GROUP BY ALL) GROUP BY 1",
)
def _(spark, sf_dir):
    return Q.duplicate_rows(panel.scan(spark, sf_dir, "documents"), "lang")


add(
    "band_flags",
    lambda s, d: Q.band_counts(panel.fact(s, d, ("salary_open_ended", "salary_anomaly_flag")), "survey_year", "salary_open_ended", "salary_anomaly_flag"),
    f"WITH {P} SELECT survey_year, count(*) FILTER (WHERE salary_open_ended <> 'CLOSED') AS open_ended_rows, "
    "count(*) FILTER (WHERE salary_anomaly_flag) AS anomaly_rows FROM panel GROUP BY 1",
)


# The same reports from counts taken while Silver was written: no scan of it.
for _name, _pick in {
    "reconcile": lambda r: r,
    "unknown_matrix": lambda r: r,
    "missing_profile": lambda r: r.where(F.col("column").isin(*_MISSING)),
    "band_flags": lambda r: r,
}.items():
    add(f"observed_{_name}", lambda s, d, n=_name, f=_pick: f(landing.stored_quality(s, d)[n]), ORACLE[_name])

@query(
    "eligibility_check",
    f"WITH {B}, {AI} SELECT a.survey_year, n AS technology, m AS genai, n = m AS blocks_agree FROM "
    "(SELECT survey_year, count(*) AS n FROM shown GROUP BY 1) a JOIN (SELECT survey_year, count(*) FILTER (WHERE genai_eligible) AS m FROM ai GROUP BY 1) b USING (survey_year)",
)
def _(spark, sf_dir):
    raw = panel.raw_panel(spark, sf_dir, [*panel.OPTION_COLUMNS, *panel.GENAI_COLUMNS])
    blocks = {"technology": list(panel.OPTION_COLUMNS), "genai": list(panel.GENAI_COLUMNS)}
    return O.eligibility_agreement(raw, "survey_year", blocks)


@query(
    "answer_status",
    f"WITH {P}, {B}, s AS (SELECT p.survey_year, CASE WHEN p.company_size = 'UNKNOWN' THEN CASE WHEN sh.o_orderkey IS NULL THEN 'NOT_ELIGIBLE' ELSE 'NOT_ANSWERED' END "
    "WHEN p.company_size = 'INVALID' THEN 'INVALID' ELSE 'ANSWERED' END AS answer_status FROM panel p LEFT JOIN shown sh USING (o_orderkey)) "
    "SELECT survey_year, answer_status, count(*) AS respondent_count FROM s GROUP BY 1, 2",
)
def _(spark, sf_dir):
    """Answered, blank, not shown and invalid company sizes told apart."""
    raw = panel.raw_panel(spark, sf_dir, ["company_size", *panel.OPTION_COLUMNS])
    shown = raw.select("survey_year", "company_size", O.eligible(list(panel.OPTION_COLUMNS)).alias("shown"))
    invalid = [r for r, c, _ in S.COMPANY_SIZE if c == "INVALID"]
    return Q.answer_status(shown, "survey_year", "company_size", {e: True for e in S.EDITIONS}, "shown", invalid)


_GATES = ("survey_year", "gender", "seniority", "employment_status", "manager_flag")
_GATE_SQL = (
    f"WITH {P}, {B}, {AI}, g AS (SELECT p.*, sh.o_orderkey IS NOT NULL AS technology, coalesce(a.genai_eligible, false) AS genai, p.survey_year <> 'year_1' AS pcd "
    "FROM panel p LEFT JOIN shown sh USING (o_orderkey) LEFT JOIN ai a ON a.o_orderkey = p.o_orderkey), "
    "long AS (" + " UNION ALL ".join(
        f"SELECT '{b}' AS block, '{g}' AS gate, CAST({g} AS VARCHAR) AS value, {b} AS answered FROM g" for b in ("technology", "genai", "pcd") for g in _GATES
    ) + "), per AS (SELECT block, gate, value, count(*) AS support, count(*) FILTER (WHERE NOT answered) AS blank FROM long GROUP BY 1, 2, 3), "
    "rated AS (SELECT *, blank / CAST(support AS DOUBLE) AS confidence, CASE WHEN sum(blank) OVER w > 0 THEN blank / CAST(sum(blank) OVER w AS DOUBLE) END AS coverage, "
    "bool_or(support >= 30 AND blank / CAST(support AS DOUBLE) < 0.99) OVER w AS has_open FROM per WINDOW w AS (PARTITION BY block, gate))"
)


def _gated(spark, sf_dir):
    """Gate answers beside the blocks, and the rules found in them."""
    raw = panel.raw_panel(spark, sf_dir, [*[g for g in _GATES if g != "survey_year"], "pcd_flag", *panel.OPTION_COLUMNS, *panel.GENAI_COLUMNS])
    people = silver.harmonize(raw.withColumnRenamed("pcd_flag", "pcd"), silver.default_mappings(spark), _GATES)
    blocks = {"technology": list(panel.OPTION_COLUMNS), "genai": list(panel.GENAI_COLUMNS), "pcd": ["pcd"]}
    return people, GT.answered_counts(people, _GATES, blocks), blocks


@query(
    "gate_rules",
    _GATE_SQL + " SELECT block, gate, value, support, round(confidence, 6) AS confidence, round(coverage, 6) AS coverage FROM rated "
    "WHERE support >= 30 AND confidence >= 0.99 AND has_open",
)
def _(spark, sf_dir):
    """Which answers close which block, read off the answers."""
    _, counts, blocks = _gated(spark, sf_dir)
    return GT.gate_rules(counts, _GATES, list(blocks))


@query(
    "block_implications",
    _GATE_SQL.split(", long AS")[0] + ", pairs AS (" + " UNION ALL ".join(
        f"SELECT '{a}' AS block, '{b}' AS implied, count(*) AS support, count(*) FILTER (WHERE {b}) / CAST(count(*) AS DOUBLE) AS confidence FROM g WHERE {a}"
        for a in ("technology", "genai", "pcd") for b in ("technology", "genai", "pcd") if a != b
    ) + ") SELECT block, implied, support, round(confidence, 6) AS confidence FROM pairs WHERE support >= 30 AND confidence >= 0.99",
)
def _(spark, sf_dir):
    _, counts, blocks = _gated(spark, sf_dir)
    return GT.block_implications(counts, list(blocks))


@query(
    "answer_status_by_rules",
    f"WITH {AI} SELECT survey_year, CASE WHEN survey_year = 'year_1' THEN 'NOT_ELIGIBLE' WHEN genai_eligible THEN 'ANSWERED' ELSE 'NOT_ANSWERED' END AS answer_status, "
    "count(*) AS respondent_count FROM ai GROUP BY 1, 2",
)
def _(spark, sf_dir):
    """Blank blocks told apart by the rules found in the data: closed by an answer, or left blank."""
    people, counts, blocks = _gated(spark, sf_dir)
    rules = GT.rules_of(GT.gate_rules(counts, _GATES, list(blocks)), "genai")
    told = people.select("survey_year", F.when(O.eligible(blocks["genai"]), F.lit("x")).alias("genai"), GT.shown(rules).alias("shown"))
    return Q.answer_status(told, "survey_year", "genai", {e: True for e in S.EDITIONS}, "shown")


@query(
    "work_model_gap",
    f"WITH {P} SELECT survey_year, current_work_model, ideal_work_model, count(*) AS respondent_count, "
    "round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY survey_year, current_work_model) AS DOUBLE), 6) AS share FROM panel GROUP BY 1, 2, 3",
)
def _(spark, sf_dir):
    """Current against ideal work model."""
    people = panel.fact(spark, sf_dir, ("current_work_model", "ideal_work_model"))
    counts = SH.counts_by(people, ["survey_year", "current_work_model", "ideal_work_model"])
    return SH.share_of_total(counts, ["survey_year", "current_work_model"], "respondent_count", "share")
