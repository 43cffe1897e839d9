"""Header resolution: two dialects, reused and repeated codes, umbrella columns."""

from __future__ import annotations

import pytest

from panelloom.functions import headers as H
from panelloom.plans import survey_config as S

TUPLE = [
    "('P1_b ', 'Genero')", "('P2_q ', 'Forma de trabalho')", "('P1_f_1', 'Sem espaço')",
    "('P3_d_ ', 'a Contratar')", "('P3_d_ ', 'b Reter')", "('P4_f ', 'Quais bancos')",
    "('P4_f_a ', 'MySQL')", "('P4_f_z9 ', 'Firebird')", "('P4_g_a ', 'Amazon Web Services (AWS)')",
    "('P6_a_2 ', 'Construções de ETL's em ferramentas')", "Carimbo",
]
DOT = [
    "0.a_token", "1.b_genero", "4.d.1_MySQL", "4.d.10_Datomic", "4.d_banco_de_dados", "4.j.1 Não uso",
    "4.j_usa_chatgpt", "1.m_área_de_formação",
]


def test_parse_both_dialects():
    assert H.parse_header("('P2_h ', 'Faixa salarial')", "tuple") == ("('P2_h ', 'Faixa salarial')", "P2_h", "Faixa salarial")
    assert H.parse_header("4.j.1 Não uso", "dot")[1:] == ("4.j.1", "Não uso")
    assert H.parse_header("1.a.1_faixa_idade", "dot")[1:] == ("1.a.1", "faixa_idade")
    assert H.parse_header("Carimbo", "tuple") is None


def test_unescaped_quote_in_a_label_still_parses():
    parsed = H.parse_header("('P6_a_2 ', 'Construções de ETL's em ferramentas')", "tuple")
    assert parsed.code == "P6_a_2" and parsed.label == "Construções de ETL's em ferramentas"


def test_closing_parenthesis_of_a_label_is_kept():
    assert H.option_block(TUPLE, "P4_g_", "tuple") == [("('P4_g_a ', 'Amazon Web Services (AWS)')", "Amazon Web Services (AWS)")]


def test_resolution_ignores_trailing_blanks_and_uses_only_the_code():
    assert H.resolve_column(TUPLE, "P1_b", "tuple") == "('P1_b ', 'Genero')"
    assert H.resolve_column(TUPLE, "P1_f_1 ", "tuple") == "('P1_f_1', 'Sem espaço')"
    assert H.resolve_column(DOT, "1.b", "dot") == "1.b_genero"
    assert H.resolve_column(DOT, "1.b_genero", "dot") == "1.b_genero"
    assert H.resolve_column(DOT, "4.j.1", "dot") == "4.j.1 Não uso"
    assert H.resolve_column(DOT, None, "dot") is None


def test_missing_and_ambiguous_codes_fail():
    with pytest.raises(KeyError):
        H.resolve_column(TUPLE, "P9_z", "tuple")
    with pytest.raises(ValueError, match="ambiguous"):
        H.resolve_column(TUPLE, "P3_d_", "tuple")


def test_option_block_excludes_the_umbrella_and_strips_the_index():
    assert [label for _, label in H.option_block(TUPLE, "P4_f_", "tuple")] == ["MySQL", "Firebird"]
    assert H.option_block(DOT, "4.d.", "dot") == [("4.d.1_MySQL", "MySQL"), ("4.d.10_Datomic", "Datomic")]
    assert H.option_block(DOT, "4.j.", "dot") == [("4.j.1 Não uso", "Não uso")]


def test_option_names_fail_loudly_unless_told_otherwise():
    block = [("a", "MySQL"), ("b", "Novo")]
    with pytest.raises(ValueError, match="Novo"):
        H.name_options(block, {"MySQL": "MySQL"})
    assert H.name_options(block, {"MySQL": "MySQL"}, strict=False) == {"a": "MySQL"}


def test_every_field_has_one_code_per_edition():
    for edition in S.EDITIONS:
        codes = [c for c in S.field_codes(edition).values() if c]
        assert len(codes) == len(set(codes))
    assert S.field_codes("year_1")["ethnicity"] is None
