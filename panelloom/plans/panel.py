"""The driver tables seen as a survey, so that every survey operator runs on them.

An order is a respondent and the order date picks the edition. Answers are printed with the
questionnaire's own labels, so the mapping tables, the band parser and the option blocks do real
work: ``raw_panel`` gives raw answers, ``fact`` the harmonized ones. The database block comes
from the brands, types and sizes of an order's parts; an order without line items has a blank
block. All orders and all line items take part.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.operators.options import option_adoption, option_bridge, option_users
from panelloom.plans import gold as G
from panelloom.plans import incremental, silver
from panelloom.plans import survey_config as S
from panelloom.plans.survey_job import DIMENSION_TABLES, SilverTables
from panelloom.session import new_folder
from panelloom.sources.tables import read_table

EDITION = "survey_year"
OPTION_COLUMNS = {f"db_{i}": name for i, name in enumerate(S.DATABASE_OPTIONS)}
GENAI_COLUMNS = {f"ai_{i}": name for i, name in enumerate(S.GENAI_METRICS)}

# Fixed values of the analogy: which order attribute stands for which answer.
TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
REGION_NOT_TOLD = "MIDDLE EAST"
SENIORITY_BY_PRIORITY = {
    "1-URGENT": "Especialista/Staff+", "2-HIGH": "Sênior", "3-MEDIUM": "Pleno", "5-LOW": "Júnior",
}
GENDER_BY_STATUS = {"F": "Feminino", "O": "Masculino", "P": "Prefiro não informar"}
BAND_WIDTH = 31250.0


_scans: dict[tuple[str, str, str], DataFrame] = {}


def scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema and file listing are read once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _scans:
        _scans[key] = read_table(spark, sf_dir, name)
    return _scans[key]


def roles_offered(edition: str) -> list[str]:
    return [raw for raw, scope, *_ in S.ROLE if raw and (scope == "all" or edition in scope.split(","))]


def _answers(rows: Sequence[tuple]) -> list[str]:
    return [row[0] for row in rows if row[0] is not None]


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _nth(values: Sequence[str], index: str) -> str:
    """The index-th label, NULL outside the list."""
    return f"get(array({', '.join(_text(v) for v in values)}), CAST({index} AS INT))"


def _case(column: str, labels: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {_text(k)} THEN {_text(v)}" for k, v in labels.items()) + " END"


# What the lines of an order say about each option family: the options and which of them a line ticks.
_ADJECTIVES = ("blue", "cold", "hot", "large", "new", "old", "red", "small")
_NOUNS = ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")
FAMILIES = {
    "LANGUAGE": ([f"Written in {a}" for a in _ADJECTIVES], "split_part(p_name, ' ', 1)", _ADJECTIVES),
    "CLOUD": ([f"{n.capitalize()} hosting" for n in _NOUNS], "split_part(p_name, ' ', 2)", _NOUNS),
    "BI_TOOL": ([f"{a} {n}" for a in _ADJECTIVES for n in _NOUNS], "p_name", [f"{a} {n}" for a in _ADJECTIVES for n in _NOUNS]),
    "ETL_TOOL": ([f"Nation {i} pipelines" for i in range(25)], "s_nationkey", range(25)),
    "DATA_SCIENCE_METHOD": ([f"Tests with up to {10 * i} samples (t, chi)" for i in range(1, 6)], "CAST(ceil(l_quantity / 10) AS INT)", range(1, 6)),
    "DATA_SCIENCE_TOOL": ([f"{t.capitalize()} notebooks" for t in TYPES], "p_type", TYPES),
    "AI_USE_CASE": ([f"{what} {how}" for what in ("Answers", "Notes", "Reports") for how in ("for the team", "for clients")],
                    "concat(l_returnflag, l_linestatus)", [a + b for a in "ANR" for b in "FO"]),
    "AI_BLOCKER": ([f"Costs above {i} percent" for i in range(11)], "CAST(round(l_discount * 100) AS INT)", range(11)),
}

# The edition of an order, and every panel field as an expression over the joined tables.
EDITION_SQL = (
    "CASE WHEN year(o_orderdate) <= 1996 THEN 'year_1' WHEN year(o_orderdate) <= 1998 THEN 'year_2' ELSE 'year_3' END"
)
_ASKED = f"{EDITION_SQL} <> 'year_1'"


def _order_fields() -> dict[str, str]:
    models = [_text(m) for m in _answers(S.WORK_MODEL)]
    day, month = "dayofmonth(o_orderdate)", "month(o_orderdate)"
    return {
        "age_band": "concat('faixa_', quarter(o_orderdate))",
        "gender": "CASE WHEN o_orderstatus <> 'P' OR o_orderpriority <> '4-NOT SPECIFIED' "
        f"THEN {_case('o_orderstatus', GENDER_BY_STATUS)} END",
        "pcd_flag": f"CASE WHEN {_ASKED} THEN IF({day} <= 3, 'Sim', 'Não') END",
        "education_level": "o_orderpriority",
        "employment_status": _nth(_answers(S.EMPLOYMENT_STATUS), f"floor(({day} - 1) / 2)"),
        "manager_flag": f"CASE WHEN {day} <= 10 THEN '1.0' WHEN {day} <= 25 THEN '0.0' END",
        "seniority": _case("o_orderpriority", SENIORITY_BY_PRIORITY),
        "salary_band": f"CASE WHEN {month} <> 12 THEN {_nth(S.SALARY_BAND_LABELS, f'floor(o_totalprice / {BAND_WIDTH}D)')} END",
        "data_experience_band": f"concat('exp_', floor({day} / 8))",
        "it_experience_band": f"concat('exp_', floor({day} / 11))",
        "current_work_model": f"CASE WHEN {month} <= 3 THEN {models[0]} WHEN {month} <= 6 THEN {models[1]} "
        f"WHEN {month} <= 9 THEN {models[2]} WHEN {month} <= 11 THEN {models[3]} END",
        "rto_attitude": "concat('atitude_', quarter(o_orderdate))",
    }


def _customer_fields() -> dict[str, str]:
    models = [_text(m) for m in _answers(S.WORK_MODEL)]
    roles = " ".join(f"WHEN {_text(e)} THEN {_nth(roles_offered(e), 'c_nationkey')}" for e in S.EDITIONS)
    return {
        "ideal_work_model": f"CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 2500 THEN {models[0]} "
        f"WHEN c_acctbal < 5000 THEN {models[1]} WHEN c_acctbal < 7500 THEN {models[2]} ELSE {models[3]} END",
        "sector": "c_mktsegment",
        "education_area": "c_mktsegment",
        "company_size": f"CASE WHEN c_acctbal >= 0 THEN {_nth(_answers(S.COMPANY_SIZE), 'floor(c_acctbal / 800)')} END",
        "current_role": f"CASE {EDITION_SQL} {roles} END",
    }


def _place_fields() -> dict[str, str]:
    return {
        "state": "n_name",
        "region": f"nullif(r_name, {_text(REGION_NOT_TOLD)})",
        "ethnicity": f"CASE WHEN {_ASKED} THEN r_name END",
    }


def _block_fields() -> dict[str, str]:
    """Wide block columns, 1.0 / 0.0, NULL where the block was not shown or not offered."""
    def flag(bit: int) -> str:
        return f"CAST((mask >> {bit}) & 1L AS DOUBLE)"

    def only(condition: str, value: str) -> str:
        return f"CASE WHEN {condition} THEN {value} END"

    fields = {}
    for i, (column, name) in enumerate(OPTION_COLUMNS.items()):
        editions = S.DATABASE_OFFERED_IN.get(name)
        listed = ", ".join(_text(e) for e in editions or ())
        fields[column] = flag(i) if editions is None else only(f"{EDITION_SQL} IN ({listed})", flag(i))
    neither = f"CAST((mask & {(1 << 34) | (1 << 35)}L) = 0L AS DOUBLE)"
    for column, value in zip(GENAI_COLUMNS, [neither, *[flag(i) for i in (34, 35, 36, 37)]]):
        fields[column] = only(_ASKED, value)
    fields["block_shown"] = "mask IS NOT NULL"
    labels = [_text(v) for v in _answers(S.AI_PRIORITY)]
    fields["ai_priority"] = (
        f"CASE WHEN {_ASKED} THEN CASE line_count WHEN 1 THEN {labels[0]} "
        f"WHEN 2 THEN IF({EDITION_SQL} = 'year_2', {labels[1]}, {labels[2]}) "
        f"WHEN 3 THEN {labels[3]} WHEN 4 THEN {labels[4]} WHEN 5 THEN {labels[5]} END END"
    )
    return fields


def block_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: one bit per database option, one per GenAI trait, and the number of lines.

    The block is a bit mask until the last moment, so the shuffle by order carries two numbers
    per row instead of forty flags.
    """
    lines = scan(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_returnflag", "l_linestatus", "l_discount"
    )
    kinds = ", ".join(_text(t) for t in TYPES)
    parts = scan(spark, sf_dir, "part").selectExpr(
        "p_partkey AS l_partkey",
        "shiftleft(1L, CAST(substring(p_brand, 7) AS INT) - 1)"
        f" | coalesce(shiftleft(1L, CAST(nullif(array_position(array({kinds}), p_type), 0) AS INT) + 24), 0L)"
        " | shiftleft(1L, CASE WHEN p_size <= 10 THEN 31 WHEN p_size <= 30 THEN 32 ELSE 33 END) AS part_bits",
    )
    traits = ("l_returnflag = 'A'", "l_returnflag = 'R'", "l_linestatus = 'O'", "l_discount >= 0.08D")
    bits = " | ".join(["part_bits", *[f"IF({t}, {1 << (34 + i)}L, 0L)" for i, t in enumerate(traits)]])
    return (
        lines.join(parts, "l_partkey")
        .groupBy("l_orderkey")
        .agg(F.expr(f"bit_or({bits})").alias("mask"), F.count(F.lit(1)).alias("line_count"))
    )


def _fields() -> tuple[dict[str, str], ...]:
    return _order_fields(), _customer_fields(), _place_fields(), _block_fields()


# What the fields are made from; other columns of the tables are not read.
_SOURCES = ("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice", "c_nationkey", "c_acctbal", "c_mktsegment", "n_name", "r_name", "mask", "line_count")


def answer_sources(spark: SparkSession, sf_dir: str, fields: Collection[str]) -> DataFrame:
    """One row per order with what its answers are made from; only the tables the fields need are joined."""
    order, customer, place, block = _fields()
    unknown = [f for f in fields if f not in {**order, **customer, **place, **block}]
    if unknown:
        raise KeyError(f"unknown panel fields {unknown}")
    df = scan(spark, sf_dir, "orders")
    if any(f in customer or f in place for f in fields):
        customers = scan(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
        if any(f in place for f in fields):
            nations = scan(spark, sf_dir, "nation").join(
                scan(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
            )
            customers = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        df = df.join(customers, "o_custkey", "left")
    if any(f in block for f in fields):
        masks = block_masks(spark, sf_dir).withColumnRenamed("l_orderkey", "o_orderkey")
        df = df.join(masks, "o_orderkey", "left")
    return df.select(*[c for c in _SOURCES if c in df.columns])


def printed_answers(sources: DataFrame, fields: Collection[str], key: str = "respondent_id") -> DataFrame:
    """Edition, respondent key and the asked-for raw fields of :func:`answer_sources`."""
    order, customer, place, block = _fields()
    every = {**order, **customer, **place, **block}
    edition = EDITION if EDITION in sources.columns else f"{EDITION_SQL} AS {EDITION}"
    return sources.selectExpr(
        edition,
        f"format_string('%s_%06d', {EDITION_SQL}, o_orderkey) AS {key}",
        *[f"{every[f]} AS {f}" for f in fields],
    )


def raw_panel(spark: SparkSession, sf_dir: str, fields: Collection[str], key: str = "respondent_id") -> DataFrame:
    """Edition, respondent key and the asked-for raw fields; only the tables they need are joined."""
    return printed_answers(answer_sources(spark, sf_dir, fields), fields, key)


# Harmonized column: raw field it is made from, where the two differ.
_MADE_FROM = {
    "salary_midpoint": "salary_band", "salary_lower_bound": "salary_band", "salary_upper_bound": "salary_band",
    "salary_open_ended": "salary_band", "salary_anomaly_flag": "salary_band", "salary_band_raw": "salary_band",
    "current_role_raw": "current_role", "comparability_group": "current_role", "ethnicity_raw": "ethnicity",
    "pcd_flag_raw": "pcd_flag", "company_size_raw": "company_size", "rto_attitude_raw": "rto_attitude",
}


def fact(spark: SparkSession, sf_dir: str, columns: Collection[str]) -> DataFrame:
    """Harmonized respondents with the given columns."""
    raw = list(dict.fromkeys(_MADE_FROM.get(c, c) for c in columns))
    harmonized = silver.harmonize(raw_panel(spark, sf_dir, raw), silver.default_mappings(spark), columns)
    return harmonized.select(EDITION, "respondent_id", *columns)


def printed_options(family: str, edition: str) -> dict[int, str]:
    """Option number to its label as an edition prints it.

    The first edition is in capitals and lacks the last option. The third lacks the first one, ends labels with a stop, marks the
    first ``o`` and misspells every fifth option.
    """
    labels = dict(enumerate(FAMILIES[family][0]))
    if edition == S.EDITIONS[0]:
        del labels[len(labels) - 1]
        return {i: label.upper() for i, label in labels.items()}
    if edition == S.EDITIONS[-1]:
        del labels[0]
        return {i: (label[:3] + label[2:] if i % 5 == 0 else label).replace("o", "ó", 1) + "." for i, label in labels.items()}
    return labels


def family_headers(family: str, edition: str) -> dict[str, int | None]:
    """Header to option number of one family's block, the umbrella column first."""
    prefix = S.OPTION_FAMILIES[family].get(edition)
    if prefix is None:
        return {}
    dotted = S.HEADER_DIALECT[edition] == "dot"

    def header(code: str, label: str) -> str:
        return f"{code}_{label}" if dotted else str((f"{code} ", label))

    options = {header(f"{prefix}{i + 1}", label): i for i, label in printed_options(family, edition).items()}
    return {header(prefix[:-1], family.lower()): None, **options}


def family_bronze(spark: SparkSession, sf_dir: str, family: str) -> dict[str, DataFrame]:
    """One wide raw frame per edition with the family's block under its printed headers.

    The ticks of an order are one number, stored once by edition; an order without lines has a blank block.
    """
    _, answer, values = FAMILIES[family]
    listed = ", ".join(_text(v) if isinstance(v, str) else str(v) for v in values)
    lines = scan(spark, sf_dir, "lineitem")
    if "p_" in answer:
        lines = lines.join(scan(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if "s_" in answer:
        lines = lines.join(scan(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    place = f"CAST(nullif(array_position(array({listed}), {answer}), 0) AS INT)"
    ticks = lines.groupBy("l_orderkey").agg(F.expr(f"coalesce(bit_or(shiftleft(1L, {place} - 1)), 0L)").alias("mask"))
    orders = scan(spark, sf_dir, "orders").join(ticks, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    path = new_folder(spark, "family")
    orders.selectExpr(f"{EDITION_SQL} AS {EDITION}", f"format_string('%s_%06d', {EDITION_SQL}, o_orderkey) AS respondent_id", "mask").write.partitionBy(
        EDITION
    ).parquet(path)
    stored = spark.read.schema(f"respondent_id string, mask bigint, {EDITION} string").parquet(path)
    frames = {}
    for edition in S.EDITIONS:
        columns = [
            (F.lit(None).cast("string") if i is None else F.expr(f"CAST(CAST(shiftrightunsigned(mask, {i}) & 1L AS DOUBLE) AS STRING)")).alias(header)
            for header, i in family_headers(family, edition).items()
        ]
        if columns:
            frames[edition] = stored.where(F.col(EDITION) == edition).select(EDITION, "respondent_id", *columns)
    return frames


def family_adoption(spark: SparkSession, sf_dir: str, family: str) -> DataFrame:
    return G.technology_adoption(silver.family_adoption(family_bronze(spark, sf_dir, family), family))


def block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_panel(spark, sf_dir, list(OPTION_COLUMNS))


def bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return option_bridge(
        raw_panel(spark, sf_dir, [*OPTION_COLUMNS, "block_shown"]), ["respondent_id", EDITION], OPTION_COLUMNS,
        family="DATABASE", offered_in=S.DATABASE_OFFERED_IN, shown="block_shown",
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return option_users(block(spark, sf_dir), "respondent_id", OPTION_COLUMNS, offered_in=S.DATABASE_OFFERED_IN)


def adoption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return option_adoption(block(spark, sf_dir), OPTION_COLUMNS, offered_in=S.DATABASE_OFFERED_IN)


def ai_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_panel(spark, sf_dir, ["ai_priority", *GENAI_COLUMNS])
    return silver.ai_fact(
        raw, "ai_priority", GENAI_COLUMNS, F.col(EDITION) != "year_1", silver.default_mappings(spark)
    )


_PEOPLE = tuple(c for c in incremental.PEOPLE if c != EDITION)

#: Raw fields the three Silver tables are made from, as far as the counts of :mod:`panelloom.plans.incremental` read them.
SILVER_FIELDS = tuple(
    dict.fromkeys([*[_MADE_FROM.get(c, c) for c in _PEOPLE], *OPTION_COLUMNS, "block_shown", "ai_priority", *GENAI_COLUMNS])
)


def silver_tables(sources: DataFrame) -> tuple[SilverTables, DataFrame]:
    """Silver of stored :func:`answer_sources`, and the users of each option with their profile: a row holds both, so nothing is joined."""
    answers, tables = printed_answers(sources, SILVER_FIELDS), silver.default_mappings(sources.sparkSession)
    wide = silver.harmonize(answers, tables, _PEOPLE)

    def bridge(rows: DataFrame, ids: Sequence[str]) -> DataFrame:
        return option_bridge(rows, list(ids), OPTION_COLUMNS, family="DATABASE", offered_in=S.DATABASE_OFFERED_IN, shown="block_shown")

    ai = silver.ai_fact(answers, "ai_priority", GENAI_COLUMNS, F.col(EDITION) != "year_1", tables)
    whole = SilverTables(wide.select(EDITION, "respondent_id", *_PEOPLE), bridge(answers, ["respondent_id", EDITION]), ai)
    return whole, bridge(wide, [EDITION, *G.PROFILE]).where("selected")


def gold(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Gold table over the driver tables, planned with just the columns it reads."""
    def people(*columns: str) -> DataFrame:
        return fact(spark, sf_dir, columns)

    if name == "gold_market_overview":
        return G.market_overview(people(*G.MARKET_DIMENSIONS))
    if name in DIMENSION_TABLES:
        dimension = DIMENSION_TABLES[name]
        return G.compensation_by(people(dimension, "salary_midpoint"), dimension)
    if name == "gold_gender_representation":
        return G.gender_representation(people("gender", "seniority", "current_role", "region", "salary_midpoint"))
    if name == "gold_technology_adoption_by_year":
        return G.technology_adoption(adoption(spark, sf_dir))
    if name == "gold_ai_adoption_overview":
        return G.ai_adoption_overview(ai_facts(spark, sf_dir))
    if name == "gold_skill_priority_score":
        wide = silver.harmonize(
            raw_panel(spark, sf_dir, ["current_role", "seniority", "salary_band", *OPTION_COLUMNS, "block_shown"]),
            silver.default_mappings(spark), G.PROFILE,
        )
        return G.skill_priority_score_wide(wide, OPTION_COLUMNS, adoption(spark, sf_dir), shown="block_shown")
    raise KeyError(name)
