"""Near pairs, names across editions and advice, each against a plain computation over all pairs."""

from __future__ import annotations

import random
import re
import unicodedata

import pytest
from conftest import rows
from pyspark.sql import functions as F

from panelloom.operators import similar as SM
from panelloom.plans import panel, silver
from panelloom.plans import survey_config as S


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def key(label: str) -> str:
    plain = "".join(c for c in unicodedata.normalize("NFD", label.lower()) if not unicodedata.combining(c))
    return re.sub(r"[^\w+#]+|_+", " ", plain).strip()


def garbled(r: random.Random, text: str) -> str:
    chars = list(text)
    for _ in range(r.randrange(4)):
        at = r.randrange(len(chars) + 1)
        kind = r.randrange(3)
        if kind == 0:
            chars.insert(at, r.choice("abc "))
        elif chars and at < len(chars):
            chars[at : at + 1] = [] if kind == 1 else [r.choice("abcx")]
    return "".join(chars)


@pytest.mark.parametrize("ratio", [0.0, 0.15, 0.3, 0.45])
def test_near_pairs_lose_none(spark, ratio):
    r = random.Random(7)
    base = ["".join(r.choice("ab ") for _ in range(r.randrange(1, 25))) for _ in range(25)] + ["aaaaaaaaaa", "ababababab", "x"]
    left = sorted({garbled(r, b) for b in base for _ in range(3)})
    right = sorted({garbled(r, b) for b in base for _ in range(3)} | {""})
    want = sorted(
        (g, a, b, edits(a, b)) for g in "pq" for a in left for b in right
        if a and b and edits(a, b) <= int(ratio * max(len(a), len(b)))
    )
    frames = [spark.createDataFrame([(g, x, 1) for g in "pq" for x in side] * 2, "g string, key string, distance int") for side in (left, right)]
    got = SM.near_pairs(*frames, ["g"], ratio)
    assert sorted(map(tuple, got.collect())) == want


def test_a_ratio_that_would_lose_pairs_is_refused(spark):
    with pytest.raises(ValueError, match="ratio"):
        SM.near_pairs(spark.createDataFrame([], "key string"), spark.createDataFrame([], "key string"), ratio=0.5)


def test_label_keys(spark):
    labels = ["Javascript", "JavaScript", "R ", "C/C++/C#", ".NET", "Não utilizo.", "nao  UTILIZO", "HMM's", "(SSIS))", "...", "", None]
    got = {r[0]: r[1] for r in spark.createDataFrame([(x,) for x in labels], "l string").select("l", SM.label_key(F.col("l"))).collect()}
    assert [got[x] for x in labels] == ["javascript", "javascript", "r", "c c++ c#", "net", "nao utilizo", "nao utilizo", "hmm s", "ssis", "...", "", None]


def names(spark, editions: dict[str, list[str]], **more) -> dict[tuple[str, str], str]:
    table = spark.createDataFrame([("f", e, x) for e, labels in editions.items() for x in labels], "family string, year string, label string")
    return {(r["year"], r["label"]): r["name"] for r in SM.align_labels(table, "family", "year", "label", ["y1", "y2", "y3"], **more).collect()}


def test_options_keep_one_name_through_all_editions(spark):
    got = names(spark, {
        "y1": ["MYSQL", "Amazon QuickSight", "SAP Business Objects", "Models to detect fraud", "Looker", "R"],
        "y2": ["MySQL", "Amazon Quicksigth", "SAP Business Objects", "Models to detect fraud.", "Looker", "Rust"],
        "y3": ["MySQL.", "SAP Business Objects/SAP Analytics", "Models to detect frauds", "Looker Studio (Google)", "Looker", "R "],
    })
    assert {e: got[e, x] for e, x in (("y1", "MYSQL"), ("y2", "MySQL"), ("y3", "MySQL."))} == {"y1": "MySQL.", "y2": "MySQL.", "y3": "MySQL."}
    assert got["y1", "Amazon QuickSight"] == got["y2", "Amazon Quicksigth"] == "Amazon Quicksigth"
    assert got["y1", "SAP Business Objects"] == got["y2", "SAP Business Objects"] == "SAP Business Objects/SAP Analytics"
    assert got["y1", "Models to detect fraud"] == got["y2", "Models to detect fraud."] == "Models to detect frauds"
    assert got["y1", "Looker"] == "Looker" and got["y3", "Looker Studio (Google)"] == "Looker Studio (Google)"
    assert got["y1", "R"] == got["y3", "R "] == "R" and got["y2", "Rust"] == "Rust"


def test_two_equally_near_partners_fail_and_an_alias_settles_it(spark):
    editions = {"y1": ["notebooks A", "notebooks B"], "y2": ["notebooks C"]}
    with pytest.raises(SM.AmbiguousLabels, match="notebooks c"):
        names(spark, editions)
    got = names(spark, editions, aliases={"notebooks C": "notebooks B"})
    assert got["y1", "notebooks B"] == "notebooks C" and got["y1", "notebooks A"] == "notebooks A"


def test_the_nearest_partner_wins_and_the_other_stays_alone(spark):
    got = names(spark, {"y1": ["data notebooks"], "y2": ["data notebook", "dato notebookss"]})
    assert got["y1", "data notebooks"] == "data notebook" and got["y2", "dato notebookss"] == "dato notebookss"


def test_no_labels_and_editions_out_of_order(spark):
    assert names(spark, {}) == {}
    with pytest.raises(ValueError, match="y9"):
        names(spark, {"y9": ["a"]})


def test_advice_is_the_three_nearest(spark):
    r = random.Random(3)
    known = sorted({"".join(r.choice("abcd") for _ in range(r.randrange(3, 9))) for _ in range(60)})
    unknown = sorted({garbled(r, k).upper() for k in known} - set(known) - {""})
    got = SM.nearest_known(spark.createDataFrame([(u,) for u in unknown], "raw_value string"), spark.createDataFrame([(k,) for k in known], "raw_value string"))
    want = []
    for u in unknown:
        near = sorted((edits(key(u), k), k) for k in known if key(u) and edits(key(u), k) <= int(0.4 * max(len(key(u)), len(k))))[:3]
        want += [(u, k, d, i + 1) for i, (d, k) in enumerate(near)]
    assert rows(got) == sorted(want, key=lambda x: tuple((True, str(v)) for v in x))


@pytest.mark.parametrize("family", sorted(panel.FAMILIES))
def test_every_printed_option_finds_its_name(spark, family):
    headers = {e: list(panel.family_headers(family, e)) for e in S.EDITIONS}
    found = silver.family_names(spark, headers, [family])
    printed = {e: panel.printed_options(family, e) for e in S.EDITIONS if e in S.OPTION_FAMILIES[family]}
    for i in range(len(panel.FAMILIES[family][0])):
        having = [e for e in printed if i in printed[e]]
        assert {found[family, e][printed[e][i]] for e in having} == {printed[having[-1]][i]}
