"""Edge cases of the document operators, each against a plain computation."""

from __future__ import annotations

import hashlib
import inspect
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from panelloom.llm import (
    byte_bpe,
    components,
    exact_dedup,
    language_id,
    ngram_jaccard,
    packing,
    phrase_fingerprint,
    pitman_yor,
    pu_learning,
    quality,
    substring_dedup,
    toxicity,
)
from panelloom.llm.frames import crc32_of_id

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, keep_id int, n_words string, __row int, root string, h double"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(seed: int, n: int, size: int = 200) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(["ba", "de", "ko", "lu", "mi", "ra"]) for _ in range(1 + r.randrange(size) % 4)) for _ in range(n))


def table(spark, texts: list[tuple[int | None, str | None]]):
    """Documents with further columns whose names clash with results and with names used inside."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, "x", 2, "y", 0.5) for i, t in texts], SCHEMA)


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls, empty and blank texts, repeats, ties, one very long text, near copies."""
    base = prose(1, 120)
    near = base.split(" ")
    near[60] = "CHANGED"
    shared = prose(2, 50)
    rows = [
        (1, base), (2, base), (3, base.upper()), (4, " ".join(near)), (5, None), (6, ""), (7, " \t\n"), (8, "one"), (9, "one two three"), (10, "ONE two three"),
        (11, prose(3, 40) + " " + shared + " " + prose(4, 40)), (12, shared + "\n" + prose(5, 80)), (13, "w " * 100), (14, prose(6, 20_000)),
        (15, "x" * 5000), (16, "é ü ß 漢字 😀 İ Σ"), (9, "one two three"), (None, "one two three"), (None, None),
    ]
    return rows, table(spark, rows).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return table(spark, []).where("doc_id is not null")


def test_exact_dedup(edge, nothing):
    rows, docs = edge
    got = exact_dedup.exact_dedup(docs).collect()
    groups: dict[str, list] = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOW), []).append(i)
    want = sorted((str(i), str(max((x for x in g if x is not None), default=None)), len(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.exact_dedup(nothing).count() == 0 and exact_dedup.keep_one(nothing).count() == 0


def removed(rows: list[str], k: int) -> list[tuple[int, int, str]]:
    words = [WORD.findall(t or "") for t in rows]
    count: dict[tuple, int] = {}
    for w in words:
        for i in range(len(w) - k + 1):
            count[tuple(w[i : i + k])] = count.get(tuple(w[i : i + k]), 0) + 1
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - k + 1):
            if count[tuple(w[i : i + k])] > 1:
                gone.update(range(i, i + k))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize(("k", "m"), [(35, 12), (6, 3)])
def test_substring_dedup(edge, nothing, k, m):
    rows, docs = edge
    got = substring_dedup.substring_dedup(docs, k=k, m=m).select("__row.doc_id", "n_words", "n_removed", "kept").collect()
    want = [(i, *x) for (i, _), x in zip(rows, removed([t for _, t in rows], k))]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    changed = substring_dedup.drop_repeats(docs, k=k, m=m)
    assert changed.columns == docs.columns and changed.count() == len(rows)
    assert substring_dedup.drop_repeats(nothing, k=k, m=m).count() == 0


def test_substring_dedup_of_random_overlaps(spark):
    r = random.Random(5)
    pool = [prose(100 + i, 60) for i in range(6)]
    texts = [" ".join(" ".join(p[a : a + r.randint(5, 40)]) for p in (r.choice(pool).split() for _ in range(4)) for a in [r.randrange(40)]) for _ in range(60)]
    got = substring_dedup.substring_dedup(table(spark, list(enumerate(texts))), k=10, m=4).select("__row.doc_id", "n_words", "n_removed", "kept").collect()
    assert sorted(map(tuple, got)) == [(i, *x) for i, x in enumerate(removed(texts, 10))]


@pytest.mark.parametrize("marks", [1 << 20, 1])
def test_substring_dedup_moves_only_texts_with_repeats(spark, monkeypatch, marks):
    monkeypatch.setattr(substring_dedup, "SENT_SPANS", 0)
    monkeypatch.setattr(substring_dedup, "MARKS", marks)
    shared = prose(7, 50)
    rows = [(i, prose(200 + i, 60)) for i in range(40)] + [(None, None), (40, ""), (41, shared + " a"), (42, "b " + shared), (None, shared)]
    docs = table(spark, rows)
    out = substring_dedup.substring_dedup(docs)
    assert "LeftAnti" in out._jdf.queryExecution().optimizedPlan().toString()  # the others take a way of their own, without an exchange
    got = out.select("__row.doc_id", "n_words", "n_removed", "kept").collect()
    want = [(i, *x) for (i, _), x in zip(rows, removed([t for _, t in rows], 35), strict=True)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    source = substring_dedup._source(docs, "doc_id", "text").drop("__row")
    keys = source.where("__text like '% b %' or __id in (3, 41)").select("__id", "__th")
    semi, anti = ({r["__id"] for r in substring_dedup._marked(source, keys, keys.count(), how).collect()} for how in ("left_semi", "left_anti"))
    assert {3, 41} <= semi and not {3, 41} & anti and len(semi | anti) == 44
    assert len(anti) > 30 or marks == 1


def jaccard_components(rows: list[tuple], percent: int = 80) -> dict:
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOW))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    at = list(range(len(rows)))

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * len(a | sets[j]):
                at[find(i)] = find(j)
    members: dict[int, list] = {}
    for i, (doc, _) in enumerate(rows):
        members.setdefault(find(i), []).append(doc)
    return {i: (len(sets[i]), min((d for d in members[find(i)] if d is not None), default=None)) for i in range(len(rows))}


def test_ngram_jaccard(edge, nothing):
    rows, docs = edge
    want = sorted((str(d), *map(str, x)) for (d, _), x in zip(rows, jaccard_components(rows).values()))
    got = ngram_jaccard.ngram_jaccard(docs).collect()
    assert sorted((str(r.doc_id), str(r.n_shingles), str(r.component_id)) for r in got) == want
    assert ngram_jaccard.ngram_jaccard(nothing).count() == 0
    kept = ngram_jaccard.keep_representatives(docs)
    assert kept.columns == docs.columns


@pytest.mark.parametrize("hot", [32, 2])
def test_ngram_jaccard_around_the_threshold(spark, monkeypatch, hot):
    """Chains of edits: many pairs a little above and a little below the threshold, and a passage all texts share."""
    monkeypatch.setattr(ngram_jaccard, "HOT", hot)
    r = random.Random(9)
    rows, passage = [], prose(77, 30).split()
    for family in range(10):
        words = prose(500 + family, r.choice([6, 9, 20, 60, 300])).split() + (passage if family % 2 else [])
        for _ in range(6):
            words = list(words)
            for _ in range(max(1, len(words) // r.choice([30, 60, 100]))):
                words[r.randrange(len(words))] = f"w{r.randrange(10_000)}"
            rows.append((len(rows), " ".join(words)))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_jaccard.ngram_jaccard(table(spark, rows), sample=20).collect()}
    assert got == jaccard_components(rows)


@pytest.mark.parametrize("few", [0.32, 0.06])
def test_linked_sets_share_a_chosen_block_that_their_places_allow(monkeypatch, few):
    """Pairs at the very threshold, over all bands; with far too few blocks a set says so and its band is cut into single bits."""
    monkeypatch.setattr(ngram_jaccard, "_FEW", few)
    monkeypatch.setattr(ngram_jaccard, "_MANY", few)
    rng = np.random.default_rng(5)
    low26, low24 = (1 << 26) - 1, (1 << 24) - 1
    fallbacks = 0
    for _ in range(400):
        n = int(rng.integers(1, 1500))
        base = rng.integers(1, 2**63, n).astype(np.uint64)
        gone = int(rng.integers(0, n // 5 + 1))
        extra = rng.integers(1, 2**63, int(rng.integers(0, n // 5 + 1))).astype(np.uint64)
        a, b = np.unique(base), np.unique(np.concatenate([base[gone:], extra]))
        shared, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        if 100 * shared < 80 * union:
            continue
        frequent = np.sort(rng.permutation(a)[: int(rng.integers(0, n + 1))])
        farthest = len(a) + len(b) - 2 * -(-80 * (len(a) + len(b)) // 180)

        def chosen(s, fine=None):
            keys, infos = ngram_jaccard.band_keys(s, frequent, 80, fine)
            marks = infos >> ngram_jaccard._SHORT & 1 == 1
            assert ((infos[~marks] & low26) == len(s)).all()
            return dict(zip(keys[~marks].tolist(), (infos[~marks] >> ngram_jaccard._PLACE & low24).tolist())), set(keys[marks].tolist())

        (x, short_x), (y, short_y) = chosen(a), chosen(b)
        found = any(max(x[key], y[key]) <= farthest for key in x.keys() & y.keys())
        if short_x | short_y:
            fallbacks += 1
            fine = frozenset(int(band) for band in short_x | short_y)
            (x, more_x), (y, more_y) = chosen(a, fine), chosen(b, fine)
            assert not more_x and not more_y
            found |= any(max(x[key], y[key]) <= farthest for key in x.keys() & y.keys())
        assert found
    assert (fallbacks > 0) == (few < 0.1)


def test_a_band_with_too_few_blocks_loses_no_link(spark, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "_MANY", 0.05)
    monkeypatch.setattr(ngram_jaccard, "SMALL", 8)
    r = random.Random(21)
    rows = []
    for family in range(6):
        words = prose(900 + family, r.choice([30, 60, 120])).split()
        for _ in range(6):
            words = list(words)
            words[r.randrange(len(words))] = f"w{r.randrange(10_000)}"
            rows.append((len(rows), " ".join(words)))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_jaccard.ngram_jaccard(table(spark, rows), sample=20).collect()}
    assert got == jaccard_components(rows)


def test_parity_distance_bounds_the_difference():
    r = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(r.integers(0, 2**63, r.integers(1, 400)).astype(np.uint64))
        b = np.unique(np.concatenate([r.permutation(a)[: r.integers(0, len(a) + 1)], r.integers(0, 2**63, r.integers(0, 50)).astype(np.uint64)]))
        far = int(np.bitwise_count(np.frombuffer(ngram_jaccard.narrow_sketch(a), np.uint8) ^ np.frombuffer(ngram_jaccard.narrow_sketch(b), np.uint8)).sum())
        assert far <= len(np.setxor1d(a, b))


def test_components(spark):
    links = [(i, i + 1) for i in range(20, 60)] + [(5, 3), (3, 9), (9, 5), (100, 101), (7, 7)]
    got = {r.v: r.root for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 20 for i in range(20, 61)}, 3: 3, 5: 3, 9: 3, 100: 100, 101: 100}


def test_byte_bpe_is_what_tiktoken_gives(edge, nothing):
    tiktoken = pytest.importorskip("tiktoken")
    import base64

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    r = random.Random(3)
    bits = ["a", "s", "t", "'", "'s", "'ll", "re", " ", "  ", "\n", "\t", "ü", "ß", "1", "²", "!", "%%%", "漢字", "😀", "Thé", " 's", "''s", "'S", "\r\n", "\x1c", "\x85"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 60))) for _ in range(400)] + ["a" * 1000, "ab" * 400, "".join(r.choice("abcdefgh") for _ in range(3000)), "", None]
    assert list(byte_bpe.encode_rows(pa.array(texts, pa.string()), path)) == [plain.encode_ordinary(t or "") for t in texts]
    rows, docs = edge
    got = byte_bpe.encode(docs, path).collect()
    assert sorted((str(x.doc_id), x.ids, bytes(x.decoded)) for x in got) == sorted((str(i), plain.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)
    again = byte_bpe.decode(byte_bpe.encode(docs, path), path).collect()
    assert sorted(bytes(x.decoded) for x in again) == sorted((t or "").encode() for _, t in rows)
    assert byte_bpe.encode(nothing, path).count() == 0


def test_packing(edge, nothing):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    rows, docs = edge
    pieces = packing.pack(docs, path, 2).collect()
    by_doc: dict = {}
    for p in pieces:
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
        assert len(p.ids) == 4 * p.length
    for i, t in rows:
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 2]
        own = sorted(by_doc[i, len(ids)], key=lambda p: p.start)
        times = sum(1 for j, u in rows if j == i and u == t)
        assert sum(p.length for p in own) == times * len(ids)
        if times == 1 and sum(1 for j, _ in rows if j == i) == 1:
            assert np.frombuffer(b"".join(bytes(p.ids) for p in own), "<u4").tolist() == ids
    filled: dict[int, int] = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == filled.get(p.sequence_id, 0)
        filled[p.sequence_id] = p.offset + p.length
    assert all(n == 4096 or n & (n - 1) == 0 for n in filled.values())
    assert packing.padding(packing.pack(docs, path, 2)).first().padding == 0
    assert packing.pack(nothing, path, 2).count() == 0


def test_ids_of_texts_with_special_tokens_in_print():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    r = random.Random(6)
    bits = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext|", "|>", "<", "a", "Word", " ", "  ", "\n", ".", ",", "é", "e\u0301", "'s", "12", "漢", "x" * 30]
    rows = ["".join(r.choice(bits) for _ in range(r.randrange(12))) for _ in range(1500)]
    rows += ["<|endoftext|>", "<|endoftext|><|endoftext|>", "", "<|endof", "text|>", "<|startoftext|> " * 500]
    got = [ids.tolist() for part in packing.texts(pa.array(rows), 300) for ids in packing.tokenizer(path).rows(part)]
    assert got == [plain.encode(t, add_special_tokens=False).ids for t in rows]


def test_packing_keeps_all_three_limits():
    r = random.Random(2)
    packer = packing.Packer(100, 4, 60, 0)
    pieces, total = [], 0
    for i in range(300):
        n = r.randint(1, 250)
        total += n
        pieces += packer.add(i, np.arange(n, dtype=np.uint32), r.randint(0, n))
    pieces += packer.finish()
    by_sequence: dict[int, list] = {}
    for p in pieces:
        by_sequence.setdefault(p[6], []).append(p)
    assert sum(p[2] for p in pieces) == total
    for own in by_sequence.values():
        assert sum(p[2] for p in own) <= 100 and len(own) <= 4 and sum(p[4] for p in own) <= 60


def test_fingerprints(edge, nothing, spark):
    rows, docs = edge
    got = phrase_fingerprint.compare_with_next(docs, ranges=4).collect()
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -(2**63)), r[1] or ""))
    texts = [t or "" for _, t in order]
    want = []
    for (i, t), b in zip(order, texts[1:] + texts[:1]):
        t = t or ""
        e = t[: len(t) - len(t) // 2] + b[: len(t) // 2]
        want.append((str(i), len(t), hashlib.sha256(e.encode()).hexdigest()))
    assert sorted((str(x.doc_id), x.n_chars, x.edited_sha256) for x in got) == sorted(want)
    prints = {t or "": set() for _, t in rows}
    for x in phrase_fingerprint.fingerprints(docs).join(docs.select("doc_id", "text"), "doc_id").collect():
        if [i for i, _ in rows].count(x.doc_id) == 1:
            prints[x.text or ""].add(x.fingerprint)
    assert all(len(p) <= 1 for p in prints.values())
    assert all(0 <= x.near_edited <= 1 and 0 <= x.near_next <= 1 for x in got)
    assert phrase_fingerprint.compare_with_next(nothing).count() == 0
    one = phrase_fingerprint.compare_with_next(table(spark, [(5, "abcdef")])).collect()
    assert [(x.doc_id, x.near_next) for x in one] == [(5, 1.0)]


def test_equal_substrings_share_phrases_at_any_offset():
    body = prose(8, 2000)
    a, b = phrase_fingerprint.sketches(pa.array([body, "xyz 123 " + body]))
    c = phrase_fingerprint.sketches(pa.array([prose(9, 2000)]))[0]
    assert phrase_fingerprint.likeness(a, b) > 0.9 > 0.3 > phrase_fingerprint.likeness(a, c)


@pytest.fixture(scope="module")
def labelled(spark):
    r = random.Random(4)
    rows, marks = [], []
    for i in range(600):
        bad = i % 5 == 0
        words = prose(1000 + i, 60).split()
        if bad:
            words[r.randrange(60)] = r.choice(["nastyword", "vileword", "grimword"])
        rows.append((i, " ".join(words)))
        marks.append((i, int(not bad), int(bad)))
    docs = table(spark, rows + [(None, "x"), (9000, None), (9001, "")])
    return docs, spark.createDataFrame(marks[:300] + [(9000, None, None)], "doc_id bigint, quality int, toxic int")


def test_toxicity_learns_from_positives_and_unlabelled(labelled, nothing):
    docs, labels = labelled
    model = toxicity.learn_toxicity(docs, labels)
    got = {x.doc_id: x for x in toxicity.score_toxicity(docs, model).collect()}
    held = range(300, 600)
    right = sum(got[i].predicted == int(i % 5 == 0) for i in held)
    assert right >= 290 and len(got) == 603 and all(0 <= x.score <= 1 for x in got.values())
    clean = toxicity.keep_clean(docs, model)
    assert clean.columns == docs.columns and clean.count() == sum(x.predicted == 0 for x in got.values())
    assert toxicity.keep_clean(nothing, model).count() == 0
    unfit = toxicity.learn_toxicity(nothing, labels)
    assert not unfit.fitted and toxicity.score_toxicity(docs, unfit).count() == 603


def test_quality_sees_repetition_and_symbols(spark):
    rows, marks = [], []
    for i in range(3000):
        words = prose(5000 + i, 40).split()
        if i % 4 == 0:
            words = [w + "***" for w in words] if i % 8 else [words[0]] * 40
        rows.append((i, " ".join(words)))
        marks.append((i, int(i % 4 != 0)))
    docs = table(spark, rows)
    model = quality.learn_quality(docs, spark.createDataFrame(marks[:1500], "doc_id bigint, quality int"))
    got = {x.doc_id: x.score for x in quality.score_quality(docs, model).collect()}
    good, bad = [got[i] for i in range(1500, 3000) if i % 4], [got[i] for i in range(1500, 3000) if i % 4 == 0]
    assert sum(g > b for g in good for b in bad) > 0.95 * len(good) * len(bad)


def test_risk_is_not_driven_below_zero():
    """With P and U alike nothing can be learned, and the scores stay near the prior."""
    r = np.random.default_rng(0)
    rows, columns = np.repeat(np.arange(400), 5), r.integers(0, 50, 2000)
    w, b = pu_learning.fit_weights(rows, columns, np.ones(2000), np.arange(400) < 200, 50, 0.3)
    assert np.abs(w).max() < 3 and -3 < b < 3


def test_bounds_of_the_weight_fit():
    """The sample and the features of the first version, not fewer; shares of a text's make-up in forty parts."""
    bounds = {k: v.default for k, v in inspect.signature(pu_learning.learn).parameters.items()}
    assert (bounds["max_positive"], bounds["max_unlabelled"], bounds["max_features"]) == (20_000, 40_000, 8192)
    assert len(pu_learning._bucket(1, 0, np.ones(1))[0]) == 41


def test_features_are_chosen_from_all_training_rows(spark):
    """A word in 30 of 400 positives is a feature although a sample of 40 positives holds too few of its texts."""
    rows = [(i, prose(9000 + i, 30) + (" rareslur" if i < 400 and i % 13 == 0 else "")) for i in range(1400)]
    labels = spark.createDataFrame([(i, 1) for i in range(400)], "doc_id bigint, toxic int")
    model = toxicity.learn_toxicity(table(spark, rows), labels, max_positive=40, max_unlabelled=80)
    word = np.frombuffer(b"rareslur", np.uint8)
    assert np.isin(pu_learning.Spans(word).hash(np.array([0]), np.array([8])), model.hashes).all()


def test_language_profiles(spark, nothing):
    r = random.Random(1)
    parts = {"aa": ["ka", "lo", "mu"], "bb": ["she", "tion", "wi"], "cc": ["öß", "ü", "ich"]}
    rows = [(i, lang, " ".join("".join(r.choice(parts[lang]) for _ in range(3)) for _ in range(30))) for i, lang in enumerate(["aa", "bb", "cc"] * 30)]
    docs = spark.createDataFrame([(i, t, lang) for i, lang, t in rows] + [(900, None, "aa"), (901, "", "aa"), (902, "123 !!", "bb"), (903, "kalomu", None)], "doc_id bigint, text string, lang string")
    profiles = language_id.learn(docs.where("doc_id < 60"))
    got = {x.doc_id: x for x in language_id.identify(docs, profiles).collect()}
    assert all(got[i].lang_pred == lang for i, lang, _ in rows)
    assert [got[i].lang_pred for i in (900, 901, 902, 903)] == ["und", "und", "und", "aa"]
    assert language_id.learn(nothing) == {} and {x.lang_pred for x in language_id.identify(docs, {}).collect()} == {"und"}
    counts: dict = {}
    for word in " ".join(t for i, lang, t in rows if lang == "aa" and i < 60).split():
        word = f" {word} "
        for n in (1, 2, 3):
            for i in range(len(word) - n + 1):
                if word[i : i + n].strip() and " " not in word[i + 1 : i + n - 1]:
                    counts[word[i : i + n]] = counts.get(word[i : i + n], 0) + 1
    top = max(v for g, v in counts.items())
    first = int(profiles["aa"][0])
    assert counts[chr(first)] == top


def test_language_model(edge, nothing):
    import math
    from collections import Counter

    rows, docs = edge
    from pyspark.sql import functions as F

    held = F.pmod(crc32_of_id(F.col("doc_id")), F.lit(7)) == 2
    model = pitman_yor.learn(docs.where(~held))
    ids = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tokens = [[*WORD.findall((t or "").translate(LOW)), None] for _, t in rows]
    count = Counter(w for (i, _), own in zip(rows, tokens) if not ids(i) for w in own)
    n, v = sum(count.values()), len(count)
    assert (model.train_tokens, model.types) == (n, v)
    for head in (5, 20_000):  # with most words sent for, and with all at hand
        got = pitman_yor.score(docs, model, head=head).collect()
        want = sorted((str(i), len(own), sum(count[w] > 0 for w in own), round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own), 6)) for (i, _), own in zip(rows, tokens))
        assert sorted((str(x.doc_id), x.n_tokens, x.n_known, round(x.base_score, 6)) for x in got) == want
        scores = sorted((str(x.doc_id), round(x.score, 6)) for x in got)
        assert head == 5 or scores == before
        before = scores
    empty = pitman_yor.learn(nothing)
    assert (empty.train_tokens, empty.types) == (0, 0) and pitman_yor.score(docs, empty).count() == len(rows)
    assert pitman_yor.score(nothing, model).count() == 0


def test_language_model_packs_pairs_and_deletes_its_tables(spark, edge):
    from collections import Counter
    from pathlib import Path

    from panelloom.session import shared_folder

    rows, docs = edge
    r = random.Random(11)
    often = " ".join(f"the w{r.randrange(700)}" for _ in range(2000))  # one context with many words, counts beyond a byte
    docs = docs.unionByName(table(spark, [(100 + i, often + " x y" * 200) for i in range(3)]))
    word = lambda x: int(pitman_yor.tokens(next(pitman_yor.texts(pa.array([x]))))[0][0] & pitman_yor._WORD) if x else int(pitman_yor._END)
    count: Counter = Counter()
    for t in [t for _, t in rows] + 3 * [often + " x y" * 200]:
        own = [None, *WORD.findall((t or "").translate(LOW)), None]
        count.update(zip(own[1:], own[:-1]))
    hashes = {x: word(x) for pair in count for x in pair}
    want = {(hashes[w], hashes[v]): n for (w, v), n in count.items()}
    got = pitman_yor.pair_counts(docs).collect()
    assert len(got) == len(want) and {(x.w % (1 << 64), x.v % (1 << 64)): x.n for x in got} == want
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.glob("panelloom-lm-*"))
    model = pitman_yor.learn(docs)
    left = sorted(p.name.split("-")[2] for p in set(folder.glob("panelloom-lm-*")) - before)
    assert left == ["corrections", "rows"]  # what the model itself is read from
    assert model.pairs.count() == len(want) and model.rows.count() == len({w for w, _ in want})


def test_seating_does_not_depend_on_batches():
    n = np.array([1, 2, 70, 5000, 1, 3, 900] * 50)
    weight, key = np.linspace(0.001, 0.9, len(n)), np.arange(len(n), dtype=np.uint64)
    whole = pitman_yor.seat(n, weight, 0.6, key, 3)
    assert (whole == np.concatenate([pitman_yor.seat(n[i : i + 20], weight[i : i + 20], 0.6, key[i : i + 20], 3) for i in range(0, len(n), 20)])).all()
    batches = [pa.RecordBatch.from_arrays([pa.array([i, i])], ["a"]) for i in range(10)] + [pa.RecordBatch.from_arrays([pa.array([], pa.int64())], ["a"])]
    gathered = list(pitman_yor._gathered(iter(batches), 48))
    assert [b.num_rows for b in gathered] == [6, 6, 6, 2] and sum((b.column(0).to_pylist() for b in gathered), []) == sorted(2 * list(range(10)))


def test_predictive_probabilities_add_up(edge):
    """Over all known tokens and one unknown, each context's probabilities sum to one."""
    _, docs = edge
    model = pitman_yor.learn(docs)
    part = pitman_yor.Part(model.rows.toArrow().to_batches(), model.back_off, model.unknown)
    for context in (0, 3, 17):
        codes = np.append(part.w | np.uint64(context), np.uint64(0x123456789000 | context))
        assert abs((10 ** part.look_up(codes)[1]).sum() - 1) < 1e-6


def test_language_model_knows_the_word_before(spark):
    """After words of one ending, each is followed by its own word; probabilities after a word add up to one, seen or not."""
    docs = spark.createDataFrame([(i, " ".join(f"{'abcdef'[j]}xx {'uvwxyz'[j]}yy" for j in ((i + s) % 6 for s in range(6)))) for i in range(60)], "doc_id bigint, text string")
    model = pitman_yor.learn(docs)
    follows = spark.createDataFrame([(1, "axx uyy"), (2, "axx vyy")], "doc_id bigint, text string")
    got = {x.doc_id: x.score for x in pitman_yor.score(follows, model).collect()}
    assert got[1] - got[2] > 1
    assert {x.doc_id: round(x.score, 9) for x in pitman_yor.score(follows, model, head=2, head_pairs=3).collect()} == {i: round(x, 9) for i, x in got.items()}
    part = pitman_yor.Part(model.rows.toArrow().to_batches(), model.back_off, model.unknown)
    pairs = pitman_yor.Pairs.of(model.pairs.toArrow().to_batches())
    column = pitman_yor.texts(pitman_yor.pa.array(["axx uyy", "uyy axx", "never axx"]))
    codes, _ = pitman_yor.tokens(next(column))
    for code in codes[[1, 4, 7]]:  # the tokens after axx, uyy and never, with the word before each
        v = pitman_yor.before(codes)[codes == code][:1]
        ending = code & ~pitman_yor._WORD
        all_codes = np.append(part.w | ending, np.uint64(0x123456789000) | ending)
        log_p = part.look_up(all_codes)[1] + part.weight(v) + pairs.find(pitman_yor.pair_hash(v, all_codes & pitman_yor._WORD))[1]
        assert abs((10**log_p).sum() - 1) < 1e-6


def test_stragglers_of_a_large_family_do_not_meet_all_of_it(spark, monkeypatch):
    """Twice the family, not four times the pairs: unlike members are told apart where they meet, and like ones meet a few."""
    real, made = ngram_jaccard._verified, []
    monkeypatch.setattr(ngram_jaccard, "_verified", lambda pairs, *a: (made.append(pairs.count()), real(pairs, *a))[1])

    def compared(size: int) -> int:
        r = random.Random(3)
        base, rows = [f"w{r.randrange(4000)}" for _ in range(120)], []
        for i in range(size):
            words = list(base)
            for _ in range(r.choice([1, 2, 3])):
                words[r.randrange(len(words))] = f"x{r.randrange(10**6)}"
            rows.append((i, " ".join(words)))
        made.clear()
        got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_jaccard.ngram_jaccard(table(spark, rows)).collect()}
        assert got == jaccard_components(rows)
        return sum(made)

    assert compared(250) < 2 * 250
