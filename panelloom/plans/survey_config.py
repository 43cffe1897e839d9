"""The survey as configuration: editions, question codes, mapping tables, option blocks.

Everything below the marker is a fixed value that has to equal the published
questionnaire for results to agree. Code that uses these values lives elsewhere.
"""

from __future__ import annotations

# ---- fixed values -----------------------------------------------------------------------

EDITIONS = ("year_1", "year_2", "year_3")

HEADER_DIALECT = {"year_1": "tuple", "year_2": "tuple", "year_3": "dot"}

RAW_FILES = {
    "year_1": "data_2021-2022.csv",
    "year_2": "data_2023-2024.csv",
    "year_3": "data_2025-2026.csv",
}

PIPELINE_VERSION = "v1"
MAPPING_VERSION = "v1"

# canonical field: question code in year_1, year_2, year_3 (None: not asked in that edition)
FIELD_CODES = {
    "age_band": ("P1_a_a", "P1_a_1", "1.a.1"),
    "gender": ("P1_b", "P1_b", "1.b"),
    "ethnicity": (None, "P1_c", "1.c"),
    "pcd_flag": (None, "P1_d", "1.d"),
    "state": ("P1_e_a", "P1_i_1", "1.i.1"),
    "region": ("P1_e_b", "P1_i_2", "1.i.2"),
    "education_level": ("P1_h", "P1_l", "1.l"),
    "education_area": ("P1_i", "P1_m", "1.m"),
    "employment_status": ("P2_a", "P2_a", "2.a"),
    "sector": ("P2_b", "P2_b", "2.b"),
    "company_size": ("P2_c", "P2_c", "2.c"),
    "manager_flag": ("P2_d", "P2_d", "2.d"),
    "current_role": ("P2_f", "P2_f", "2.f"),
    "seniority": ("P2_g", "P2_g", "2.g"),
    "salary_band": ("P2_h", "P2_h", "2.h"),
    "data_experience_band": ("P2_i", "P2_i", "2.i"),
    "it_experience_band": ("P2_j", "P2_j", "2.j"),
    "current_work_model": ("P2_q", "P2_r", "2.q"),
    "ideal_work_model": ("P2_r", "P2_s", "2.r"),
    "rto_attitude": ("P2_s", "P2_t", "2.s"),
}

# Mapping tables. The row without a raw value gives the value of a blank answer.
GENDER = (
    ("Masculino", "MALE"),
    ("Feminino", "FEMALE"),
    ("Outro", "OTHER"),
    ("Prefiro não informar", "NOT_INFORMED"),
    (None, "UNKNOWN"),
)

SENIORITY = (
    ("Júnior", "JUNIOR"),
    ("Pleno", "MID"),
    ("Sênior", "SENIOR"),
    ("Especialista/Staff+", "SPECIALIST"),
    (None, "UNKNOWN"),
)

WORK_MODEL = (
    ("Modelo 100% remoto", "REMOTE"),
    ("Modelo 100% presencial", "ON_SITE"),
    (
        "Modelo híbrido flexível (o funcionário tem liberdade para escolher quando estar no "
        "escritório presencialmente)",
        "HYBRID_FLEXIBLE",
    ),
    ("Modelo híbrido com dias fixos de trabalho presencial", "HYBRID_FIXED"),
    (None, "UNKNOWN"),
)

EMPLOYMENT_STATUS = (
    ("Empregado (CLT)", "EMPLOYEE_CLT"),
    ("Empreendedor ou Empregado (CNPJ)", "CONTRACTOR_CNPJ"),
    ("Desempregado, buscando recolocação", "UNEMPLOYED_SEEKING"),
    ("Desempregado e não estou buscando recolocação", "UNEMPLOYED_NOT_SEEKING"),
    ("Estagiário", "INTERN"),
    ("Servidor Público", "PUBLIC_SERVANT"),
    ("Vivo no Brasil e trabalho remoto para empresa de fora do Brasil (PJ)", "REMOTE_FOREIGN_COMPANY_BR"),
    ("Vivo no Brasil e trabalho remoto para empresa de fora do Brasil", "REMOTE_FOREIGN_COMPANY_BR"),
    ("Vivo fora do Brasil e trabalho para empresa de fora do Brasil", "ABROAD_FOREIGN_COMPANY"),
    ("Trabalho na área Acadêmica/Pesquisador", "ACADEMIC_RESEARCHER"),
    ("Freelancer", "FREELANCER"),
    ("Somente Estudante (graduação)", "STUDENT_UNDERGRAD"),
    ("Somente Estudante (pós-graduação)", "STUDENT_GRAD"),
    ("Prefiro não informar", "NOT_INFORMED"),
    (None, "UNKNOWN"),
)

AI_PRIORITY = (
    ("Não é uma iniciativa que estamos focando e não tem sido uma prioridade.", "NOT_PRIORITY"),
    (
        "Mais ou menos... É uma das várias iniciativas que estamos impulsionando, mas não é uma "
        "prioridade (iniciativas isoladas e pouco foco).",
        "SECONDARY_INITIATIVE",
    ),
    (
        "Mais ou menos... É uma das várias iniciativas que estamos impulsionando, mas não é uma "
        "prioridade (tratam-se de iniciativas isoladas e com pouco foco).",
        "SECONDARY_INITIATIVE",
    ),
    (
        "Sim, está entre nossas principais prioridades para os próximos 2-4 anos (com discussões de "
        "iniciativas e orçamentos de curto a médio prazo).",
        "TOP_PRIORITY_MEDIUM_TERM",
    ),
    (
        "Sim, é nossa principal prioridade como empresa (com foco executivo significativo e alocação "
        "de orçamento relevante).",
        "TOP_PRIORITY_MAIN",
    ),
    ("Não sei opinar sobre esse assunto.", "DONT_KNOW"),
    (None, "NOT_ASKED"),
)

# raw value, canonical value, ordinal rank
COMPANY_SIZE = (
    ("de 1 a 5", "BAND_1_5", 1),
    ("de 6 a 10", "BAND_6_10", 2),
    ("de 11 a 50", "BAND_11_50", 3),
    ("de 51 a 100", "BAND_51_100", 4),
    ("de 101 a 500", "BAND_101_500", 5),
    ("de 501 a 1000", "BAND_501_1000", 6),
    ("de 501 a 1.000", "BAND_501_1000", 6),
    ("de 1001 a 3000", "BAND_1001_3000", 7),
    ("de 1.001 a 3.000", "BAND_1001_3000", 7),
    ("Acima de 3000", "BAND_ABOVE_3000", 8),
    ("Acima de 3.000", "BAND_ABOVE_3000", 8),
    ("de 501 a 100", "INVALID", None),
    (None, "UNKNOWN", None),
)

# raw value, editions it belongs to, canonical role, group that is comparable across editions
ROLE = (
    ("Analista de Dados/Data Analyst", "all", "DATA_ANALYST", "DATA_ANALYST"),
    ("Cientista de Dados/Data Scientist", "all", "DATA_SCIENTIST", "DATA_SCIENTIST"),
    ("Engenheiro de Dados/Data Engineer", "year_1", "DATA_ENGINEER", "DATA_ENGINEER_GROUP"),
    (
        "Engenheiro de Dados/Arquiteto de Dados/Data Engineer/Data Architect",
        "year_2",
        "DATA_ENGINEER_OR_ARCHITECT",
        "DATA_ENGINEER_GROUP",
    ),
    (
        "Engenheiro de Dados/Data Engineer/Data Architect",
        "year_3",
        "DATA_ENGINEER_OR_ARCHITECT",
        "DATA_ENGINEER_GROUP",
    ),
    ("Arquiteto de Dados", "year_1", "DATA_ARCHITECT", "DATA_ENGINEER_GROUP"),
    ("Arquiteto de Dados/Data Architect", "year_3", "DATA_ARCHITECT", "DATA_ENGINEER_GROUP"),
    (
        "Analista de BI/BI Analyst/Analytics Engineer",
        "year_1",
        "BI_ANALYST_OR_ANALYTICS_ENGINEER",
        "BI_ANALYTICS_ENGINEER_GROUP",
    ),
    ("Analista de BI/BI Analyst", "year_2,year_3", "BI_ANALYST", "BI_ANALYTICS_ENGINEER_GROUP"),
    ("Analytics Engineer", "year_2,year_3", "ANALYTICS_ENGINEER", "BI_ANALYTICS_ENGINEER_GROUP"),
    ("Analista de Negocios/Business Analyst", "all", "BUSINESS_ANALYST", "BUSINESS_ANALYST"),
    ("Analista de Negócios/Business Analyst", "all", "BUSINESS_ANALYST", "BUSINESS_ANALYST"),
    ("Desenvolvedor ou Engenheiro de Software", "year_1", "SOFTWARE_ENGINEER", "SOFTWARE_IT_GROUP"),
    ("Analista de Sistemas/Analista de TI", "year_1", "IT_SYSTEMS_ANALYST", "SOFTWARE_IT_GROUP"),
    (
        "Desenvolvedor/ Engenheiro de Software/ Analista de Sistemas",
        "year_2,year_3",
        "SOFTWARE_ENGINEER_OR_IT_ANALYST",
        "SOFTWARE_IT_GROUP",
    ),
    ("Engenheiro de Machine Learning/ML Engineer", "year_1", "ML_ENGINEER", "ML_ENGINEER"),
    ("Engenheiro de Machine Learning/ML Engineer/AI Engineer", "year_2,year_3", "ML_ENGINEER", "ML_ENGINEER"),
    (
        "Data Product Manager/ Product Manager (PM/APM/DPM/GPM/PO)",
        "year_2,year_3",
        "DATA_PRODUCT_MANAGER",
        "DATA_PRODUCT_MANAGER",
    ),
    ("Analista de Suporte/Analista Tecnico", "year_2,year_3", "SUPPORT_ANALYST", "SUPPORT_ANALYST"),
    ("Analista de Suporte/Analista Técnico", "year_2,year_3", "SUPPORT_ANALYST", "SUPPORT_ANALYST"),
    ("Suporte Tecnico", "year_1", "SUPPORT_ANALYST", "SUPPORT_ANALYST"),
    ("Suporte Técnico", "year_1", "SUPPORT_ANALYST", "SUPPORT_ANALYST"),
    (
        "Analista de Inteligencia de Mercado/Market Intelligence",
        "all",
        "MARKET_INTELLIGENCE_ANALYST",
        "MARKET_INTELLIGENCE_ANALYST",
    ),
    (
        "Analista de Inteligência de Mercado/Market Intelligence",
        "all",
        "MARKET_INTELLIGENCE_ANALYST",
        "MARKET_INTELLIGENCE_ANALYST",
    ),
    ("Outras Engenharias (nao inclui dev)", "all", "OTHER_ENGINEERING", "OTHER_ENGINEERING"),
    ("Outras Engenharias (não inclui dev)", "all", "OTHER_ENGINEERING", "OTHER_ENGINEERING"),
    ("Estatistico", "all", "STATISTICIAN", "STATISTICIAN"),
    ("Estatístico", "all", "STATISTICIAN", "STATISTICIAN"),
    ("DBA/Administrador de Banco de Dados", "all", "DBA", "DBA"),
    ("Professor", "year_1", "ACADEMIC", "ACADEMIC"),
    ("Professor/Pesquisador", "year_2,year_3", "ACADEMIC", "ACADEMIC"),
    ("Economista", "year_2", "OTHER", "OTHER"),
    ("Analista Administrativo", "year_1", "OTHER", "OTHER"),
    ("Analista de Marketing", "year_1", "OTHER", "OTHER"),
    ("Tecnico", "year_1", "OTHER", "OTHER"),
    ("Técnico", "year_1", "OTHER", "OTHER"),
    ("Outro", "year_1", "OTHER", "OTHER"),
    ("Outra Opcao", "year_2,year_3", "OTHER", "OTHER"),
    ("Outra Opção", "year_2,year_3", "OTHER", "OTHER"),
    ("Arquiteto de dados", "year_1", "DATA_ARCHITECT", "DATA_ENGINEER_GROUP"),
    ("Product Manager", "year_1", "DATA_PRODUCT_MANAGER", "DATA_PRODUCT_MANAGER"),
    (None, "all", "UNKNOWN", "UNKNOWN"),
)

# Band labels as printed in the questionnaires; the bounds are parsed from them.
SALARY_BAND_LABELS = (
    "Menos de R$ 1.000/mês",
    "Acima de R$ 40.001/mês",
    "de R$ 101/mês a R$ 2.000/mês",
    "de R$ 1.001/mês a R$ 2.000/mês",
    "de R$ 2.001/mês a R$ 3000/mês",
    "de R$ 2.001/mês a R$ 3.000/mês",
    "de R$ 3.001/mês a R$ 4.000/mês",
    "de R$ 4.001/mês a R$ 6.000/mês",
    "de R$ 6.001/mês a R$ 8.000/mês",
    "de R$ 25.001/mês a R$ 3000/mês",
    "de R$ 8.001/mês a R$ 12.000/mês",
    "de R$ 12.001/mês a R$ 16.000/mês",
    "de R$ 16.001/mês a R$ 20.000/mês",
    "de R$ 20.001/mês a R$ 25.000/mês",
    "de R$ 25.001/mês a R$ 30.000/mês",
    "de R$ 30.001/mês a R$ 40.000/mês",
)

# Option labels of the database block. A label is its own canonical name except for the aliases.
DATABASE_OPTIONS = (
    "MySQL", "Oracle", "SQL SERVER", "SAP", "Amazon Aurora ou RDS", "DynamoDB", "CoachDB",
    "Cassandra", "MongoDB", "MariaDB", "Datomic", "S3", "PostgreSQL", "ElasticSearch", "DB2",
    "Microsoft Access", "SQLite", "Sybase", "Firebase", "Vertica", "Redis", "Neo4J",
    "Google BigQuery", "Google Firestore", "Amazon Redshift", "Amazon Athena", "Snowflake",
    "Databricks", "HBase", "Presto", "Splunk", "SAP HANA", "Hive", "Firebird",
)
DATABASE_ALIASES = {"Amazon DynamoDB": "DynamoDB"}
DATABASE_PREFIX = {"year_1": "P4_f_", "year_2": "P4_g_", "year_3": "4.d."}

# Options of the block that only some editions offered.
DATABASE_OFFERED_IN = {"SAP": ("year_1",)}

AI_PRIORITY_CODE = {"year_1": None, "year_2": "P3_e", "year_3": "3.e"}
GENAI_PREFIX = {"year_1": None, "year_2": "P4_m_", "year_3": "4.j."}
GENAI_ITEMS = {
    "Não uso soluções de AI Generativa com foco em produtividade": "genai_no_use",
    "Uso soluções gratuitas de AI Generativa com foco em produtividade": "genai_free_personal",
    "Uso e pago pelas soluções de AI Generativa com foco em produtividade": "genai_paid_personal",
    "A empresa que trabalho paga pelas soluções de AI Generativa com foco em produtividade": "genai_paid_by_company",
    "Uso soluções do tipo Copilot": "genai_copilot",
}
GENAI_METRICS = {
    "genai_no_use": "personal_genai_no_use_rate",
    "genai_free_personal": "personal_genai_free_use_rate",
    "genai_paid_personal": "personal_genai_self_paid_rate",
    "genai_paid_by_company": "personal_genai_company_paid_rate",
    "genai_copilot": "personal_genai_copilot_rate",
}
GENAI_USAGE_METRIC = "personal_genai_usage_rate"
AI_PRIORITY_METRIC = "enterprise_ai_priority_rate"
AI_TOP_PRIORITY = ("TOP_PRIORITY_MAIN", "TOP_PRIORITY_MEDIUM_TERM")

# Option families: prefix of the block in each edition that has it.
OPTION_FAMILIES = {
    "DATABASE": DATABASE_PREFIX,
    "LANGUAGE": {"year_1": "P4_d_", "year_2": "P4_d_", "year_3": "4.c."},
    "CLOUD": {"year_1": "P4_g_", "year_2": "P4_h_", "year_3": "4.e."},
    "BI_TOOL": {"year_1": "P4_h_", "year_2": "P4_j_", "year_3": "4.g."},
    "ETL_TOOL": {"year_1": "P6_b_", "year_2": "P6_b_", "year_3": "6.b."},
    "DATA_SCIENCE_METHOD": {"year_1": "P8_b_", "year_2": "P8_b_", "year_3": "8.b."},
    "DATA_SCIENCE_TOOL": {"year_1": "P8_c_", "year_2": "P8_c_", "year_3": "8.c."},
    "AI_USE_CASE": {"year_2": "P3_f_", "year_3": "3.f."},
    "AI_BLOCKER": {"year_2": "P3_g_", "year_3": "3.h."},
}
# Options reworded beyond recognition: label and the label it stands for.
OPTION_ALIASES = {
    **DATABASE_ALIASES,
    "Não utilizo nenhuma das linguagens listadas": "Não utilizo nenhuma linguagem",
}

MIN_SAMPLE_SIZE = 30
SENIOR_LEVELS = ("SENIOR", "SPECIALIST")
SCORE_WEIGHTS = {
    "adoption_growth_pp": 0.30,
    "cross_role_prevalence": 0.25,
    "salary_association": 0.20,
    "senior_role_prevalence": 0.15,
}
FUTURE_INTEREST_NOTE = (
    "NOT_MEASURED - no source question in any of the 3 surveys; weight redistributed to the "
    "other 4 components (see script docstring)"
)

# Display labels of the chart tables.
EDITION_LABELS = {
    "year_1": "Pesquisa 1 (2021-22)",
    "year_2": "Pesquisa 2 (2023-24)",
    "year_3": "Pesquisa 3 (2025-26)",
}
SENIORITY_LABELS = {"JUNIOR": "Júnior", "MID": "Pleno", "SENIOR": "Sênior", "SPECIALIST": "Especialista"}
WORK_MODEL_MIX_LABELS = {
    "REMOTE": "100% remoto",
    "HYBRID_FLEXIBLE": "Híbrido flexível",
    "HYBRID_FIXED": "Híbrido fixo",
    "ON_SITE": "100% presencial",
}
WORK_MODEL_SALARY_LABELS = {
    "ON_SITE": "Presencial",
    "HYBRID_FIXED": "Híbrido fixo",
    "HYBRID_FLEXIBLE": "Híbrido flexível",
    "REMOTE": "Remoto",
}
GENDER_LABELS = {
    "MALE": "Masculino",
    "FEMALE": "Feminino",
    "OTHER": "Outro",
    "NOT_INFORMED": "Não informado",
}
ROLE_LABELS = {
    "DATA_ANALYST": "Analista de Dados",
    "DATA_SCIENTIST": "Cientista de Dados",
    "DATA_ENGINEER_OR_ARCHITECT": "Eng. de Dados / Arquiteto",
    "DATA_ARCHITECT": "Arquiteto de Dados",
    "BI_ANALYST": "Analista de BI",
    "ANALYTICS_ENGINEER": "Analytics Engineer",
    "BUSINESS_ANALYST": "Analista de Negócios",
    "ML_ENGINEER": "ML Engineer",
    "SOFTWARE_ENGINEER_OR_IT_ANALYST": "Eng. Software / Analista TI",
    "SUPPORT_ANALYST": "Analista de Suporte",
    "DATA_PRODUCT_MANAGER": "Data Product Manager",
    "OTHER_ENGINEERING": "Outras Engenharias",
    "ACADEMIC": "Acadêmico/Pesquisador",
    "STATISTICIAN": "Estatístico",
    "DBA": "DBA",
    "MARKET_INTELLIGENCE_ANALYST": "Market Intelligence",
    "OTHER": "Outro",
}
AI_METRIC_LABELS = {
    "enterprise_ai_priority_rate": "IA é prioridade\nna empresa",
    "personal_genai_usage_rate": "Usa alguma\nsolução de GenAI",
    "personal_genai_company_paid_rate": "Empresa paga\npela ferramenta",
}
CHANGE_SIGN_LABELS = ("Alta", "Queda")

# ---- end of fixed values ----------------------------------------------------------------


def field_codes(edition: str) -> dict[str, str | None]:
    """Question code of every canonical field in one edition."""
    position = EDITIONS.index(edition)
    return {field: codes[position] for field, codes in FIELD_CODES.items()}
