"""Filter audit, Orchard clustering and personal data, each against a plain computation."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest

from panelloom.llm import filter_audit, orchard, pii, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n bigint, fails int, part string, id string, kept int"
MANY = " ".join(f"w{i}" for i in range(300))


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 1, 2, "x", "y", 3) for i, t, s in rows], DOCS)


# ---- filter audit


def plain_audit(rows, labels):
    good, toxic = ({i for i, q, t in labels if i is not None and (q, t)[k] == 1} for k in (0, 1))
    first: dict[str, int] = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    marks = []
    for i, t, s in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
            "D": any(c in "#$%&*|" for c in t), "E": i is not None and first[t] < i,
        }
        marks.append((s or "", fails, i in good, i in toxic))
    out = []
    for part in {m[0] for m in marks}:
        mine = [m[1:] for m in marks if m[0] == part]
        removed_by: Counter = Counter()
        found = []
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [m for m in left if m[0][f]]
                left = [m for m in left if not m[0][f]]
                failing = sum(m[0][f] for m in mine)
                alone = sum(m[0][f] and sum(m[0].values()) == 1 for m in mine)
                removed_by[f] += len(gone)
                found.append((part, "".join(order), step, len(left), len(gone), failing - len(gone), alone, sum(m[1] for m in gone), sum(m[2] for m in gone), f))
        out += [(*x[:-1], removed_by[x[-1]]) for x in found]
    return sorted(out)


def test_filter_audit(spark):
    r = random.Random(4)
    texts = [MANY, MANY + " #", "a " * 300, "UPPER " * 250, "short", "", None, " \t\n", MANY.upper(), "x" * 50_000, "é " * 220 + "|", "SHORT & " * 3]
    rows = [(i, r.choice(texts), r.choice(["s1", "s2", "s2", None, ""])) for i in range(120)]
    rows += [(7, MANY, "s1"), (7, MANY, "s2"), (None, MANY, "s1"), (None, "only once", "s3"), (200, "only once", "s3"), (-5, MANY, "s2")]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1])) for i in range(0, 130, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn("part", filter_audit.F.lit("z"))
    got = filter_audit.audit(documents(spark, rows).repartition(5), frame)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == plain_audit(rows, labels)


def test_filter_audit_of_nothing_and_without_labels(spark):
    nothing = documents(spark, []).where("doc_id is not null")
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(nothing, none).count() == 0
    rows = [(1, MANY, "s"), (2, MANY, "s")]
    assert sorted(map(tuple, filter_audit.audit(documents(spark, rows), none).collect())) == plain_audit(rows, [])


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_paths_through_the_lattice(n):
    edges = filter_audit.lattice(n)
    paths = {(e.state, e.filter): e.paths for e in edges}
    count: Counter = Counter()
    for order in itertools.permutations(range(n)):
        state = 0
        for f in order:
            count[state, f] += 1
            state |= 1 << f
    assert paths == count


# ---- Orchard clustering


def plain_clusters(vectors, k, rounds, seed="2:"):
    """``vectors`` as (id, whole-number components)."""
    key = lambda v: (hashlib.sha256(f"{seed}{'' if v[0] is None else v[0]}".encode()).hexdigest(), v[1])
    centres = [v[1] for v in sorted(vectors, key=key)[:k]]

    def best(p):
        return min((sum((a - b) ** 2 for a, b in zip(p, c)), i) for i, c in enumerate(centres))

    for _ in range(rounds):
        own = [best(p)[1] for _, p in vectors]
        centres = [
            tuple(sum(x) // len(mine) for x in zip(*mine)) if (mine := [p for (_, p), o in zip(vectors, own) if o == c]) else centre
            for c, centre in enumerate(centres)
        ]
    found = [best(p) for _, p in vectors]
    inertia = Counter()
    for d, c in found:
        inertia[c] += d
    return sorted(((str(i), c, d, inertia[c], sum(inertia.values()), centres[c]) for (i, _), (d, c) in zip(vectors, found)), key=str)


@pytest.mark.parametrize(("n", "k", "dim", "rounds"), [(300, 12, 3, 5), (200, 40, 2, 5), (7, 10, 4, 3), (60, 1, 5, 2), (150, 9, 1, 0)])
def test_orchard(spark, n, k, dim, rounds):
    r = random.Random(n)
    whole = [(i, tuple(r.randint(-6, 6) for _ in range(dim))) for i in range(n)]
    whole += [(i, p) for i, p in whole[:20]] + [(None, whole[0][1]), (n + 1, (0,) * dim), (n + 2, (0,) * dim)]
    odd = [(900, None), (901, [0.5] * (dim + 1)), (902, [float("nan")] * dim), (903, [float("inf")] + [0.0] * (dim - 1)), (904, [None] * dim), (905, [])]
    rows = [(i, [x / 256 + 0.0001 for x in p], 1, "a", 2) for i, p in whole] + [(i, v, 1, "a", 2) for i, v in odd]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, cluster int, point string, id int").repartition(4)
    got = orchard.cluster(table, dim=dim, k=k, rounds=rounds).collect()
    assert sorted(((str(x.vec_id), x.cluster, x.distance, x.cluster_inertia, x.inertia, tuple(x.centroid)) for x in got), key=str) == plain_clusters(whole, k, rounds)


def test_orchard_of_nothing_and_of_too_large_components(spark):
    empty = spark.createDataFrame([(1, [1.0])], "vec_id bigint, embedding array<float>")
    assert orchard.cluster(empty).count() == 0
    with pytest.raises(Exception, match="out of range"):
        orchard.cluster(spark.createDataFrame([(1, [1e30, 0.0])], "vec_id bigint, embedding array<double>"), dim=2).count()


def test_orchard_search_finds_the_nearest_and_prunes():
    r = np.random.default_rng(3)
    for dim, spread in ((2, 3), (2, 50), (8, 4), (64, 300)):
        centres = orchard.prepare(r.integers(-spread, spread, (30, dim)))
        vectors = r.integers(-spread, spread, (500, dim))
        at, far = orchard.nearest(vectors, centres)
        every = ((vectors[:, None] - centres.points[None]) ** 2).sum(2)
        assert np.array_equal(at, every.argmin(1)) and np.array_equal(far, every.min(1))


# ---- personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_base(text: str) -> list[tuple[str, int, int]]:
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], list(PATTERNS).index(s[0])))


def card(r: random.Random, n: int) -> str:
    body = "".join(r.choice("0123456789") for _ in range(n - 1))
    return body + next(d for d in "0123456789" if luhn(body + d))


def test_plain_spans_are_those_of_the_patterns():
    r = random.Random(8)
    for _ in range(4000):
        bits = ["a", "Z9", "@", ".", "-", "+", " ", "1", "20", "255", "256", "3.", "(", ")", "é", "_", "%", "\n", card(r, r.randint(12, 19)), "+1 (017) 555-77", "b@c.de", "10.0.0.1"]
        text = "".join(r.choice(bits) for _ in range(r.randrange(40)))
        assert sorted(pii.plain_spans(text), key=lambda s: (s[1], list(PATTERNS).index(s[0]))) == plain_base(text), text


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("jоhn@example.com", [("email", "jоhn@example.com")]),
        ("write to john (at) example [dot] com now", [("email", "john (at) example [dot] com")]),
        ("john dot doe at mail dot example dot com", [("email", "john dot doe at mail dot example dot com")]),
        ("maria arroba correo punto es", [("email", "maria arroba correo punto es")]),
        ("a&#64;b&#46;de", [("email", "a&#64;b&#46;de")]),
        ("ana_at_example_dot_org", [("email", "ana_at_example_dot_org")]),
        ("jo​hn@exa​mple.com!", [("email", "jo​hn@exa​mple.com")]),
        ("ｊｏｈｎ＠example．com", [("email", "ｊｏｈｎ＠example．com")]),
        ("host １９２.168.٠.1 up", [("ip", "１９２.168.٠.1")]),
        ("one nine two dot one six eight dot one dot one", [("ip", "one nine two dot one six eight dot one dot one")]),
        ("call plus one four one five five five five one two one two now", [("phone", "plus one four one five five five five one two one two")]),
        ("+eins zwei drei vier fünf sechs sieben acht neun null", [("phone", "+eins zwei drei vier fünf sechs sieben acht neun null")]),
        ("+1 four one five triple five 0 one two one", [("phone", "+1 four one five triple five 0 one two one")]),
        ("four-five-three-nine-one-four-eight-eight-zero-three-four-three-six-four-six-seven", [("card", "four-five-three-nine-one-four-eight-eight-zero-three-four-three-six-four-six-seven")]),
        ("ana-at-example-dot-org", [("email", "ana-at-example-dot-org")]),
        ("write john @ example.com", [("email", "john @ example.com")]),
        ("john(a)example.com", [("email", "john(a)example.com")]),
        ("kurt (ät) beispiel punkt de", [("email", "kurt (ät) beispiel punkt de")]),
        ("a【at】b。com", [("email", "a【at】b。com")]),
        ("+49–151–1234567", [("phone", "+49–151–1234567")]),
        ("host 1O.2O.0.1l is up", [("ip", "1O.2O.0.1l")]),
        ("call plus 1 four one five dash five 5 5 dash oh one two three", [("phone", "plus 1 four one five dash five 5 5 dash oh one two three")]),
        # Prose stays as it is.
        ("stay-at-home polka-dot dress", []),
        ("Il a 10 ans, 1l de lait, I10", []),
        ("(a) first, (b) second. at 3 o'clock", []),
        ("meet me at example.com at noon", []),
        ("one two three four", []),
        ("connect the dot at home", []),
        ("point one two at three o'clock", []),
        ("Привет, мир. ΑΒΓ. café, naïve, 10.5 % at 3.4.5", []),
    ],
)
def test_disguises_are_found_at_their_place(text, wanted):
    for before, after in (("", ""), ("é漢😀 ", " ß.")):
        whole = before + text + after
        added = [(s.kind, whole[s.start : s.end]) for s in pii.find(whole) if not s.plain]
        assert added == wanted
    assert [x for x in (pii.mask(text),) if wanted and any(w in x for _, w in wanted)] == []


def test_plain_spans_stay_and_are_not_repeated():
    text = "a@b.co jоhn@example.com one two three 10.0.0.1 +4915112345678"
    spans = pii.find(text)
    assert {(s.kind, s.start, s.end) for s in spans if s.plain} == set(pii.plain_spans(text))
    assert len({s[:3] for s in spans}) == len(spans)
    assert [text[s.start : s.end] for s in spans if not s.plain] == ["jоhn@example.com"]


@pytest.mark.parametrize("text", ["1" * 200_000, "a." * 100_000, "+5" + "(" * 200_000, "x" * 200_000 + "@", "1." * 100_000, "@" * 100_000, "one " * 50_000, "dot at " * 30_000, " " * 200_000 + "@ dot", "a" + " " * 200_000 + "(at)", "1 " * 100_000])
def test_very_long_texts_take_time_in_proportion(text):
    import time

    began = time.process_time()
    pii.find(text)
    assert time.process_time() - began < 5


def pii_rows():
    r = random.Random(2)
    texts = [None, "", " \t", "a@b.co", "x" * 30_000 + " 10.0.0.1", "jоhn@example.com", f"{card(r, 16)} and +49 151 1234567", "é😀 a@b.co é 1.2.3.4", "a@b.co"]
    return [(i, t, "s") for i, t in enumerate(texts)] + [(3, "a@b.co", "s"), (None, "a@b.co", None), (None, None, None)]


def test_pii_query_against_the_patterns(spark, monkeypatch):
    rows = pii_rows()
    monkeypatch.setattr(queries, "read_documents", lambda spark, folder: documents(spark, rows).repartition(3))
    got = queries.pii_query(spark, "").collect()
    want = []
    for i, t, _ in rows:
        base = plain_base(t or "")
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        want.append((str(i), *(sum(s[0] == k for s in base) for k in PATTERNS), hashlib.sha256(listed.encode()).hexdigest()))
    assert sorted((str(x.doc_id), x.n_email, x.n_ip, x.n_card, x.n_phone, x.base_sha256) for x in got) == sorted(want)
    assert next(x.spans for x in got if x.doc_id == 5) == "email:0:16,email:2:16"
    monkeypatch.setattr(queries, "read_documents", lambda spark, folder: documents(spark, rows).where("false"))
    assert queries.pii_query(spark, "").count() == 0


def test_redaction_keeps_columns_and_rows(spark):
    rows = pii_rows()
    docs = documents(spark, rows).repartition(2)
    out = pii.redact(docs)
    assert out.columns == docs.columns
    assert sorted((str(x.doc_id), str(x.text)) for x in out.collect()) == sorted((str(i), str(None if t is None else pii.mask(t))) for i, t, _ in rows)


# ---- positive-unlabelled learning against plain recomputation


def plain_risk(w, bias, texts_, positive, prior, decay):
    """The non-negative risk, term by term."""
    import math

    loss = lambda z: math.log1p(math.exp(-abs(z))) + max(-z, 0)
    z = [sum(w[j] * v for j, v in t.items()) + bias for t in texts_]
    pos, unl = [x for x, p in zip(z, positive) if p], [x for x, p in zip(z, positive) if not p]
    plus = sum(map(loss, pos)) / len(pos)
    rest = sum(loss(-x) for x in unl) / len(unl) - prior * sum(loss(-x) for x in pos) / len(pos)
    return prior * plus + max(0.0, rest) + decay / 2 * sum(x * x for x in w)


def test_the_fit_minimises_the_risk():
    from panelloom.llm.pu_learning import fit_weights

    r = random.Random(3)
    prior, width, decay = 0.3, 6, 0.05
    rows = []
    for i in range(400):
        is_p = i < 120
        bad = is_p or r.random() < prior
        rows.append(({j: r.randint(1, 3) for j in range(width) if r.random() < (0.6 if (j < 3) == bad else 0.2)}, is_p))
    row = np.array([i for i, (t, _) in enumerate(rows) for _ in t])
    column = np.array([j for t, _ in rows for j in sorted(t)])
    value = np.array([float(t[j]) for t, _ in rows for j in sorted(t)])
    positive = np.array([p for _, p in rows])
    w, bias = fit_weights(row, column, value, positive, width, prior, decay=decay)
    found = plain_risk(w, bias, *zip(*rows), prior, decay)
    assert found < plain_risk(np.zeros(width), np.log(prior / (1 - prior)), *zip(*rows), prior, decay)
    rng = np.random.default_rng(1)
    for size in (0.05, 0.2, 1.0):
        for _ in range(40):
            step = rng.normal(size=width + 1)
            step *= size / np.linalg.norm(step)
            assert plain_risk(w + step[:-1], bias + step[-1], *zip(*rows), prior, decay) > found - 1e-3


def marked(spark, n=400, labelled=1.0):
    r = random.Random(12)
    vocabulary = ["".join(r.choice("abdeklmnorstu") for _ in range(r.randint(3, 8))) for _ in range(80)]
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = [r.choice(vocabulary) for _ in range(40)] + (["(Nastyword!)", "vile"] if bad else [])
        rows.append((i, " ".join(words), "s"))
        if i < labelled * n:
            labels.append((i, int(not bad), int(bad)))
    rows += [(None, "vile", "s"), (5000, None, "s"), (5001, "", "s"), (5002, "vile " * 20_000, "s"), (3, rows[3][1], "s")]
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), rows


@pytest.mark.parametrize("labelled", [0.5, 1.0])
def test_scores_are_those_of_the_weights(spark, labelled):
    from panelloom.llm import toxicity
    from panelloom.llm.arrays import mix, span_hash
    from panelloom.llm.pu_learning import PREFIXES

    docs, labels, rows = marked(spark, labelled=labelled)
    model = toxicity.learn_toxicity(docs, labels)
    assert model.fitted and len(model.hashes)
    weight = dict(zip(model.hashes.tolist(), model.weights.tolist()))

    def hashed(word: bytes) -> int:
        return int(span_hash(np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)]))[0])

    def plain(text: str) -> float:
        counts: Counter = Counter()
        for word in WORD.findall(text.lower()):
            core = (word.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") or word).encode()
            counts[hashed(core)] += 1
            for n in PREFIXES:
                if len(core) > n:
                    counts[int(mix(np.array([hashed(core[:n])], np.uint64) + np.uint64(n))[0])] += 1
        z = model.bias + sum(weight.get(h, 0.0) * min(c, model.kind.most) for h, c in counts.items())
        return 1 / (1 + np.exp(-z))

    got = toxicity.score_toxicity(docs, model).collect()
    want = sorted((str(i), round(plain(t or ""), 9)) for i, t, _ in rows)
    assert sorted((str(x.doc_id), round(x.score, 9)) for x in got) == want
    assert all(x.predicted == (x.score >= 0.5) for x in got)
    bad = [x.score for x in got if x.doc_id is not None and x.doc_id < 400 and x.doc_id % 4 == 0]
    good = [x.score for x in got if x.doc_id is not None and x.doc_id < 400 and x.doc_id % 4]
    assert min(bad) > max(good)


def test_frequencies_and_sample_see_every_text_of_a_fully_labelled_corpus(spark):
    from panelloom.llm import quality

    docs, labels, _ = marked(spark)
    scores = {x.doc_id: x.score for x in quality.score_quality(docs, quality.learn_quality(docs, labels)).collect()}
    # So few texts settle little about quality (the toxicity test above tells them apart); the scores are not the bare prior.
    assert len({round(x, 6) for x in scores.values()}) > 1


# ---- language profiles against plain recomputation


def test_language_of_ties_repeats_and_long_texts(spark):
    from panelloom.llm import language_id

    r = random.Random(1)
    letters = {"xx": "abcdefg", "yy": "mnopqrs"}
    prose = lambda lang, n: " ".join("".join(r.choice(letters[lang]) for _ in range(r.randint(2, 7))) for _ in range(n))
    rows = [(i, prose("xx" if i % 2 else "yy", 60), "xx" if i % 2 else "yy") for i in range(60)]
    train = spark.createDataFrame([(i, t, lang, "s", 0.5, "und") for i, t, lang in rows], "doc_id bigint, text string, lang string, source string, score double, lang_pred string")
    asked = [(100, prose("xx", 30_000)), (101, prose("yy", 5)), (101, prose("yy", 5)), (102, None), (103, " 1 2 3 "), (104, ""), (None, prose("xx", 40)), (105, "zzz")]
    docs = spark.createDataFrame([(i, t, None, "s", 0.1, "q") for i, t in asked], train.schema)
    got = [(x.doc_id, x.lang_pred, x.score) for x in language_id.identify(docs, language_id.learn(train)).collect()]
    found = {i: lang for i, lang, _ in got}
    assert len(got) == len(asked) and all(0 <= s <= 1 for _, _, s in got)
    assert (found[100], found[101], found[102], found[103], found[104], found[None]) == ("xx", "yy", "und", "und", "und", "xx")
    assert found[105] in ("xx", "yy")
