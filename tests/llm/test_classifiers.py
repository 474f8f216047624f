import random
import zlib

import numpy as np
import pytest

from tidemark.llm import language, quality, toxicity


def held(doc, modulus, remainder):
    return zlib.crc32(str("" if doc is None else doc).encode()) % modulus == remainder


@pytest.fixture(scope="module")
def larger(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


# quality


def test_quality_on_held_out_rows(larger):
    docs, labels = larger
    rows = quality.score_quality(docs, labels).collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == held(r.doc_id, 5, 0) for r in rows)
    tested = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in tested) >= 0.95 * len(tested)
    for label in (0, 1):  # recall of each class
        own = [r for r in tested if truth[r.doc_id] == label]
        assert own and sum(r.predicted == label for r in own) >= 0.9 * len(own)
    assert sorted((r.doc_id, r.score) for r in quality.score_quality(docs.repartition(5), labels.repartition(3)).collect()) == sorted((r.doc_id, r.score) for r in rows)
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(r.doc_id for r in rows if r.predicted)


def test_quality_with_clashing_names(odd, larger):
    docs = odd.selectExpr("*", "1 as _score", "2 as label", "3 as x", "4 as sample_id", "5 as score")
    kept = quality.accepted(docs, larger[1])
    assert kept.columns == docs.columns and kept.count() <= docs.count()


def test_quality_odd_rows(odd, none, larger):
    labels = larger[1]
    assert quality.score_quality(odd, labels).count() == odd.count()
    assert {r.score for r in quality.score_quality(odd, labels.where("1 = 0")).collect()} == {0.5}
    assert quality.score_quality(none, labels).count() == 0
    assert quality.accepted(odd, labels.where("1 = 0")).count() == odd.count()
    assert len(quality.statistics(b"")) == len(quality.statistics("Ä b\nc!".encode())) == len(quality.FEATURES)


def test_trees_walk_alike_row_by_row():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 5)).round(2)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit_trees(x, y, trees=20, depth=3)

    def walk(row):
        total = model.base
        for feature, threshold, value in zip(model.feature, model.threshold, model.value):
            at = 0
            while at < len(feature):
                at = 2 * at + 1 + int(row[feature[at]] > threshold[at])
            total += value[at - len(feature)]
        return total

    assert model.raw(x) == pytest.approx([walk(r) for r in x])
    assert ((model.score(x) > 0.5) == y).mean() > 0.95
    assert quality.fit_trees(np.zeros((0, 3)), np.zeros(0)).score(np.ones((2, 3))).tolist() == [0.5, 0.5]


# toxicity


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score_toxicity(docs, labels).collect()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    tested = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == held(r.doc_id, 5, 0) for r in rows)
    assert sum(r.predicted == truth[r.doc_id] for r in tested) >= 0.97 * len(tested)
    toxic, called = [r for r in tested if truth[r.doc_id]], [r for r in tested if r.predicted]
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic) and sum(truth[r.doc_id] for r in called) >= 0.9 * len(called)


def test_rare_labels_keep_their_lexicon(spark):
    rows = [(i, f"plain words number {i % 7} and so on" + (" vile" if i % 200 == 0 else "") + (" common" if i % 3 == 0 or i % 200 == 0 else ""), int(i % 200 == 0)) for i in range(6000)]
    sample = spark.createDataFrame(rows, "i long, text string, label int").select("text", "label")
    assert dict(toxicity.learn_lexicon(sample)).keys() >= {" vile"}


def test_many_exceptions_and_matches():
    matcher = toxicity.Matcher([(" trash ", 2.0), (" can ", 1.0)], ("trash can",))
    text = "trash can " * 20000 + "trash"
    assert matcher.mass(text) == (2.0, 1, 40001)


def test_toxicity_odd_rows(odd, none, larger):
    labels = larger[1]
    assert toxicity.score_toxicity(odd, labels).count() == odd.count()
    assert {(r.score, r.predicted) for r in toxicity.score_toxicity(odd, labels.where("1 = 0")).collect()} == {(0.0, 0)}
    assert toxicity.score_toxicity(none, labels).count() == 0


def test_folding_and_matching():
    assert toxicity.fold("l0ser, Lоѕеr! Tra$h\tx") == " loser loser trash x "
    matcher = toxicity.Matcher([(" loser ", 3.0), (" lose", 2.0), (" trash ", 4.0)])
    assert matcher.mass("The l0ser is losing trash") == (7.0, 2, 5)
    assert matcher.mass("the trash can is full of losers") == (2.0, 1, 7)
    assert matcher.mass("closer") == (0.0, 0, 1)
    assert matcher.mass(None) == matcher.mass("") == (0.0, 0, 0)
    assert toxicity.Matcher([], ()).mass("a b") == (0.0, 0, 2)


def test_matches_equal_a_search_of_every_entry():
    rng = random.Random(1)
    lexicon = [(e, rng.random()) for e in {rng.choice([" %s ", " %s"]) % "".join(rng.choice("ab") for _ in range(rng.randint(1, 4))) for _ in range(20)}]
    matcher = toxicity.Matcher(lexicon, ())
    for _ in range(100):
        text = " ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 8)))
        best = [max((w for e, w in lexicon if f" {word} ".startswith(e)), default=0) for word in text.split()]
        mass, hits, n = matcher.mass(text)
        assert (mass, hits, n) == (pytest.approx(sum(best)), sum(b > 0 for b in best), len(best))


# language


def test_language_on_held_out_rows(larger):
    docs = larger[0]
    rows = language.identify(docs).collect()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == held(r.doc_id, 4, 2) for r in rows)
    tested = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in tested) >= 0.98 * len(tested)


def test_language_odd_rows(odd, none):
    got = {r.doc_id: r.lang_pred for r in language.identify(odd).collect()}
    assert {got[d] for d in (3, 4, 5)} == {"und"} and got[8] != "und"
    assert language.identify(none).count() == 0
    assert {r.lang_pred for r in language.identify(odd.where("doc_id in (3, 5, 4)")).collect()} == {"und"}


@pytest.fixture(scope="module")
def field():
    rng = random.Random(7)
    made = {"xx": ["ba", "bo", "bi"], "yy": ["ka", "ke", "ko"], "zz": ["ul", "ol", "al"]}
    word = lambda lang: "".join(rng.choice(made[lang]) for _ in range(rng.randint(1, 3)))
    names = sorted(made)
    texts = [(" ".join(word(n) for _ in range(20)), i) for i, n in enumerate(names) for _ in range(40)]
    out = language.Field(names)
    out.fit([language.letters(t) for t, _ in texts], [i for _, i in texts])
    return out, word


def test_switches_of_language(field):
    model, word = field
    text = " ".join([word("xx") for _ in range(8)] + [word("yy") for _ in range(8)])
    found = [lang for _, lang, _ in model.words(text)]
    assert found == ["xx"] * 8 + ["yy"] * 8
    assert model.label(["", "1 2", word("zz")])[:2] == [(None, 0.0)] * 2


def test_marginals_equal_the_sum_over_paths(field):
    from itertools import product

    model, word = field
    texts = [language.letters(t) for t in ("ba ko", "", "ul ba ke bo", "ka")]
    words = language.Words(texts)
    e = model.emissions(words, model.owners(words))
    p, pairs = model.marginals(words, e)
    at, total = 0, np.zeros((3, 3))
    for n in words.lengths.tolist():
        own, got, mass = e[at : at + n], np.zeros((n, 3)), 0.0
        for path in product(range(3), repeat=n):
            w = np.exp(sum(own[i, y] for i, y in enumerate(path)) + sum(model.transition[a, b] for a, b in zip(path, path[1:])))
            mass += w
            for i, y in enumerate(path):
                got[i, y] += w
        for path in product(range(3), repeat=n):
            w = np.exp(sum(own[i, y] for i, y in enumerate(path)) + sum(model.transition[a, b] for a, b in zip(path, path[1:]))) / mass if n else 0
            for a, b in zip(path, path[1:]):
                total[a, b] += w
        assert np.allclose(got / (mass or 1), p[at : at + n])
        at += n
    assert np.allclose(total, pairs)


def test_languages_with_long_texts_only(spark):
    rng = random.Random(4)
    words = {"aa": ["kato", "miru", "sen", "dolka"], "bb": ["wexy", "juph", "zorb", "quine"]}
    rows = [(i, " ".join(rng.choices(words[lang], k=5000 if not held(i, 4, 2) and lang == "bb" else 20)), lang) for i in range(80) for lang in ["ab"[i % 2] * 2]]
    found = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert {found[i].lang_pred == lang for i, _, lang in rows} == {True}


def test_pieces_are_of_whole_words_and_lose_none():
    text = language.letters(" ".join(f"word{'abcdef'[i % 6]}" for i in range(1000)))
    cut = language.pieces(text, 100)
    assert b" ".join(p.strip() for p in cut) == text.strip()
    assert all(len(p) <= 100 and p[:1] == p[-1:] == b" " for p in cut) and all(len(p) > 80 for p in cut[:-1])
    long = language.pieces(language.letters("ab " + "x" * 500 + " cd"), 100)
    assert b"".join(long).replace(b" ", b"") == b"ab" + b"x" * 500 + b"cd" and max(map(len, long)) <= 100
    assert language.pieces(language.letters(""), 100) == language.pieces(language.letters("1 2"), 100) == []


def test_switching_texts_are_labelled_no_worse_than_without_transitions(larger):
    docs = larger[0]
    train = ~language.held_out("doc_id", 4, 2)
    model = language.fit_field(docs, train)
    pool = {}
    for r in docs.where(~train).where("lang is not null and text is not null").collect():
        pool.setdefault(r.lang, []).extend(language.letters(r.text).decode().split())
    names, transition, stay = sorted(pool), model.transition, model.stay
    for run in (1, 2, 4, 8):
        share = []
        for used in (1, 0):
            model.transition, model.stay = transition * used, stay * used
            rng, good, total = random.Random(run), 0, 0
            for _ in range(150):
                a, b = rng.sample(names, 2)
                i, j = rng.randrange(len(pool[a]) - 16), rng.randrange(len(pool[b]) - 16)
                parts = [(pool[x][y + n : y + n + run], x) for n in range(0, 16, run) for x, y in ((a, i), (b, j))]
                want = [x for ws, x in parts for _ in ws]
                got = [lang for _, lang, _ in model.words(" ".join(w for ws, _ in parts for w in ws))]
                good, total = good + sum(x == y for x, y in zip(got, want)), total + len(want)
            share.append(good / total)
        assert share[0] >= max(share[1], 0.9), (run, share)


def test_expected_stays_equal_the_sum_over_paths(field):
    from itertools import product

    model, word = field
    words = language.Words([language.letters(t) for t in ("ba ko", "", "ul ba ke bo", "ka")])
    e = model.emissions(words, model.owners(words))
    steady = np.array([0, 4, 1, 3])
    p, pairs, stays = model.expected(words, e, steady)
    at, moved = 0, np.zeros((3, 3))
    for d, n in enumerate(words.lengths.tolist()):
        paths = list(product(range(3), repeat=n))
        bonus = model.stay[steady[d]]
        mass = np.array([np.exp(sum(e[at + i, y] for i, y in enumerate(x)) + sum(model.transition[a, b] + bonus * (a == b) for a, b in zip(x, x[1:]))) for x in paths])
        mass /= mass.sum()
        for x, m in zip(paths, mass):
            for a, b in zip(x, x[1:]):
                moved[a, b] += m
        assert stays[d] == pytest.approx(sum(m * sum(a == b for a, b in zip(x, x[1:])) for x, m in zip(paths, mass)))
        assert n == 0 or np.allclose(p[at : at + n], [[sum(m for x, m in zip(paths, mass) if x[i] == y) for y in range(3)] for i in range(n)])
        at += n
    assert np.allclose(moved, pairs)
