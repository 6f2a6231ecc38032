"""Rule ledger, phrases and whitening against plain versions."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusframe.llm import phrases, rule_ledger, whitening
from locusframe.llm.common import stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = defaultdict(list)
    for i in range(len(words) - 2):
        seen[tuple(words[i : i + 3])].append(i)
    covered = {p for places in seen.values() if len(places) > 1 for i in places for p in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), sum(x in lines[:i] for i, x in enumerate(lines)),
            sum(bool(re.search(r'[.!?":;,)][\x20\x09-\x0D]*\Z', x)) for x in lines), len(covered), sum(bool(re.search(r"[A-Za-z]|[^\x00-\x7f]", w)) for w in words))


ODD = [None, "", " \t\r\n\x0b\x0c", "a", "a\n\na\na \n a", "   x\x85y\x1cz", "é#1 42 *|* <b>", "x y z x y z x y", "a a a a", "😀 " * 30, "w.\n" * 60, "ab cd ef " * 30_000, "###\n%%%", "a b c\nd e f.\n" * 4]


def test_measures_and_bits(spark):
    rng = random.Random(5)
    texts = ODD + [" ".join(rng.choices("aa b, c. 12 | déf\n".split(" "), k=rng.randint(0, 150))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a b"), (3, "a"), (3, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"failed": F.lit("x"), "n_words": F.lit("y"), "m": F.lit(1), "kept": F.lit(0)}).repartition(3)
    got = rule_ledger.quality_ledger(docs).collect()
    names = [f.split()[0] for f in rule_ledger.MEASURES.split(", ")]
    want = []
    for i, t in rows:
        m = plain_measures(t)
        failed = sum(1 << r.bit for r in rule_ledger.RULES if eval(r.fails.replace("AND", "and"), {}, dict(zip(names, m))))
        want.append((-1 if i is None else i, *m, failed))
    assert sorted((-1 if r.doc_id is None else r.doc_id, *(r[n] for n in names), r.failed) for r in got) == sorted(want)
    empty = rule_ledger.quality_ledger(docs.limit(0))
    assert empty.collect() == [] and {r.n_docs for r in rule_ledger.ablations(empty, [rule_ledger.BASE]).collect()} == {0}


def test_policies_and_ablations(spark):
    masks = [random.Random(k).choice([0, 0, 1, 2, 3, 5, 16, 48, 33, 128, 256]) for k in range(500)]
    ledger = spark.createDataFrame([(i, m, "a" if i % 3 else "b") for i, m in enumerate(masks)], "doc_id long, failed long, source string")
    loose = rule_ledger.Policy("loose", rule_ledger.STANDARD.rules, allowed=1)
    policies = [rule_ledger.BASE, rule_ledger.STANDARD, loose]
    bits = {r.name: 1 << r.bit for r in rule_ledger.RULES}
    kept = {p.version: {r.doc_id for r in ledger.where(rule_ledger.kept_by(p)).collect()} for p in policies}
    for p in policies:
        assert kept[p.version] == {i for i, m in enumerate(masks) if sum(bool(m & bits[n]) for n in p.rules) <= p.allowed}
    got = {(r["version"], r["rule"]): r for r in rule_ledger.ablations(ledger, policies).collect()}
    assert len(got) == 2 + 8 + 8
    for p in policies:
        for name in p.rules:
            r, others = got[p.version, name], [bits[n] for n in p.rules if n != name]
            assert (r.n_docs, r.n_kept) == (500, len(kept[p.version]))
            assert r.n_failed == sum(bool(m & bits[name]) for m in masks)
            assert r.n_sole == sum(bool(m & bits[name]) and not any(m & o for o in others) for m in masks)
            assert r.n_kept_without == sum(sum(bool(m & o) for o in others) <= p.allowed for m in masks)
    seen = {r["source"]: r for r in rule_ledger.profile(ledger, "source").collect()}
    own = [m for i, m in enumerate(masks) if i % 3]
    assert seen["a"].n_docs == len(own) and set(seen["a"].any_failed) == {r.name for r in rule_ledger.RULES if any(m & 1 << r.bit for m in own)} and seen["a"].all_failed == []
    with pytest.raises(ValueError):
        rule_ledger.Policy("x", ("no_such_rule",)).mask()
    with pytest.raises(ValueError):
        rule_ledger.quality_ledger(ledger, (rule_ledger.RULES[0], rule_ledger.RULES[0]), "doc_id", "source")


def plain_counts(rows, max_words):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, max_words + 1):
                counts[lang].update(" ".join(words[i : i + k]) for i in range(len(words) - k + 1))
    return counts, totals


def plain_collocations(counts, totals, least, top):
    out = []
    for lang, own in counts.items():
        frequent = {p: c for p, c in own.items() if c >= least}
        found = []
        for p, a in frequent.items():
            w = p.split(" ")
            if len(w) < 2 or any(f" {p} " in f" {q} " and q != p and 100 * c >= 100 * a for q, c in frequent.items()):
                continue
            cuts = [(1000 * a * totals[lang] // (frequent[" ".join(w[:k])] * frequent[" ".join(w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            found.append((-score, -a, p.encode(), p, frequent[" ".join(w[:k])], frequent[" ".join(w[k:])]))
        for rank, (s, a, _, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p, -a, left, right, totals[lang], -s))
    return sorted(out)


def corpus():
    rng = random.Random(9)
    words = ["The", "quick", "fox", "É", "ñ,", "end.", "a\tb", "x\ny", " ", "red", "hot", "stone"]
    rows = [(rng.choice(["en", "de", None]), " ".join(rng.choices(words, k=rng.randint(0, 60)))) for _ in range(250)]
    rows += [("en", None), (None, ""), ("en", "the quick red fox jumps " * 500), ("fr", "rare words here"), ("zz", " \n ")]
    return rows + [("de", "one two three four five six seven.")] * 40


@pytest.mark.parametrize("rate,buckets", [(0.5, 1 << 20), (0.02, 1 << 16), (0.0, 1 << 16)])
def test_phrases_are_those_of_a_full_count(spark, rate, buckets, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame(rows, "lang string, text string").withColumns({"phrase": F.lit("x"), "n": F.lit(1), "len": F.lit("y"), "hash": F.lit(2)}).repartition(5)
    passes = []
    count = phrases.gram_counts
    monkeypatch.setattr(phrases, "gram_counts", lambda d, now, before, *rest: passes.append(before) or count(d, now, before, *rest))
    found = stored(phrases.frequent_phrases(docs, min_count=25, rate=rate, sizes=phrases.Sizes(3000, buckets)))
    counts, totals = plain_counts(rows, 5)
    want = {(lang, len(p.split(" ")), p, c) for lang, own in counts.items() for p, c in own.items() if c >= 25}
    assert {tuple(r) for r in found.where("len > 0").collect()} == want and any(k == 5 for _, k, _, _ in want)
    assert {(r.lang, r.n) for r in found.where("len = 0 and n > 0").collect()} == {(k, v) for k, v in totals.items() if v}
    if rate == 0.0:
        assert len(passes) == 2 and passes[0] is None  # nothing in the sample: the border fails and an expansion follows
    got = phrases.collocations(found, top=30, salts=3).collect()
    assert sorted(tuple(r) for r in got) == plain_collocations(counts, totals, 25, 30)


def test_phrases_of_nothing_and_large_counts(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(stored(phrases.frequent_phrases(none))).collect() == []
    big = 3_000_000_000_000
    table = [("en", 0, "", 9_000_000_000_000_000), ("en", 1, "a", big), ("en", 1, "b", big + 7), ("en", 2, "a b", big - 5)]
    r = phrases.collocations(stored(spark.createDataFrame(table, "lang string, len int, phrase string, n bigint"))).first()
    assert r.score == 1000 * (big - 5) * 9_000_000_000_000_000 // (big * (big + 7))


def test_flags_never_say_no_to_a_member(spark):
    hashes = [random.Random(k).getrandbits(64) - (1 << 63) for k in range(5000)]
    flags = phrases.flags_of(stored(spark.createDataFrame([(h,) for h in hashes], "hash bigint")), phrases.Sizes(buckets=1 << 20))
    assert flags.has(np.array(hashes, np.int64).view(np.uint64)).all()
    assert flags.has(np.array([random.Random(10_000 + k).getrandbits(64) for k in range(5000)], np.uint64)).mean() < 0.02
    with pytest.raises(ValueError):
        phrases.Sizes(buckets=1000)


def test_full_buckets_bound_the_candidates(spark):
    docs = spark.createDataFrame([("en", "a b c. " * 3 + "a b" + " z" * k) for k in range(40)], "lang string, text string").repartition(4)
    full = phrases.full_buckets(docs, [], None, range(1, 2), 300, phrases.Sizes(50, 1 << 16))
    x, word_hash, _ = phrases.counted_apart(["a b c z"])
    _, _, hashes, _ = next(phrases.chosen_grams(x, word_hash, "en", [], None, 1))
    assert full.has(hashes).tolist() == [False, False, False, True]  # 160, 160, 120 and 780 times


@pytest.mark.parametrize("held", [400_000, 3])
def test_a_task_sends_a_phrase_once(spark, held):
    cores = spark.sparkContext.defaultParallelism
    docs = spark.createDataFrame([(["en", "de"][k % 2], f"a b c. a b z{k}") for k in range(40 * cores)], "lang string, text string").repartition(4 * cores)
    everything = phrases.Flags(np.full(1 << 13, 255, np.uint8))
    sent = stored(phrases.task_counts(phrases.gathered(docs), [everything], None, everything, 2, phrases.Sizes(30, 1 << 16, held)))
    want = {(lang, p): n * 20 * cores for lang in ("en", "de") for p, n in {"": 6, "a": 2, "b": 2, "c": 1, "a b": 2, "b c": 1}.items()}
    found = sent.groupBy("lang", "phrase").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).where("n > 1").collect()
    assert {(r.lang, r.phrase): r.n for r in found} == want
    if held > 3:
        assert max(r.rows for r in found) <= 2 * cores


def test_word_hashes_do_not_depend_on_the_cut(monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choices("aÉbC \t.\n\xa0😀", k=rng.randint(0, 400))) for _ in range(30)] + ["", "x" * 3000, ".", "a"]
    raw = b"\xff".join(map(phrases.marked, texts))
    want = [w for w in raw.replace(b"\xff", b" \xff ").split(b" ") for w in w.split(b"\t") if w]
    whole = phrases.hashed(raw)
    assert len(whole) == len(want) and all((h == 0) == (w == b"\xff") for h, w in zip(whole, want))
    assert len(set(zip(whole.tolist(), want))) == len(set(want)) == len(set(whole.tolist()))
    monkeypatch.setattr(phrases, "HASHED_AT_ONCE", 64)
    assert (phrases.hashed(raw) == whole).all()
    x, hashes, words = phrases.counted_apart(texts)
    assert (hashes[x[x > 0]] == whole[whole > 0]).all() and len(words) == len(hashes)


def plain_whitening(vectors, most=16):
    x = np.unique(np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000, axis=0)
    n, s = len(x), x.sum(axis=0)
    a = (n * x - s) / n
    values, vecs = np.linalg.eigh(a.T @ a / n)
    order = np.argsort(-values)[:most]
    return n, s, values[order], vecs[:, order], values.sum()


def check(rows, got, vectors, by_id):
    n, s, values, vecs, trace = plain_whitening(vectors)
    kept = int((values > 1e-12 * values[0]).sum())
    assert len(got) == len(by_id) * kept
    table = {(r.vec_id, r.component): r for r in got}
    signs = None
    for i, v in by_id.items():
        x = np.floor(64 * np.array(v, np.float64)).astype(np.int64) + 1_000_000
        d = [n * int(c) - int(t) for c, t in zip(x, s)]
        w = (np.array(d) / n) @ vecs[:, :kept] / np.sqrt(values[:kept])
        mine = np.array([table[i, k + 1].whitened for k in range(kept)])
        if signs is None:
            signs = np.sign(mine * w)
        assert np.allclose(mine, signs * w, rtol=1e-6, atol=1e-7)
        assert {(r.n, int(r.deviation)) for r in got if r.vec_id == i} == {(n, sum(e * e for e in d))}
    assert np.allclose([table[next(iter(by_id)), k + 1].explained for k in range(kept)], values[:kept] / trace, rtol=1e-9)
    assert {r.identity_error for r in got}.pop() < 1e-6


def test_whitening_equals_a_dense_eigenproblem(spark):
    rng = np.random.default_rng(3)
    base = (rng.normal(size=(300, 20)) * np.geomspace(5, 0.05, 20)) @ np.linalg.qr(rng.normal(size=(20, 20)))[0]
    by_id = {i: v for i, v in enumerate(base.tolist())}
    rows = [(i, v, "x") for i, v in by_id.items()] + [(1000, by_id[0], "copy"), (1001, None, ""), (1002, [None] * 20, ""), (1003, [float("nan")] * 20, ""), (1004, [math.inf] + [0.0] * 19, ""), (1005, [], "")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n string").withColumns({"x": F.lit(1), "id": F.lit("clash"), "w": F.lit(2)}).repartition(5)
    check(rows, whitening.whiten(frame).collect(), base, by_id | {1000: by_id[0]})
    assert whitening.whiten(frame.limit(0)).collect() == []
    assert whitening.whiten(frame.where("vec_id in (0, 1000)")).collect() == []


def test_whitening_of_dependent_dimensions_lengths_and_large_numbers(spark):
    rng = np.random.default_rng(4)
    a = rng.normal(size=(200, 3))
    deficient = np.hstack([a, a[:, :1], np.full((200, 1), 0.25), np.round(a[:, 1:2] * 64) / 64 * 0])
    huge = np.round(rng.normal(size=(40, 2)) * 1e9) / 64
    rows = [(i, v) for i, v in enumerate(deficient.tolist())] + [(500 + i, v) for i, v in enumerate(huge.tolist())] + [(None, deficient[0].tolist()), (900, [1e30, -1e30, 0.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    first = [r for r in got if r.vec_id is not None and r.vec_id < 500]
    check(rows, first, deficient, dict(enumerate(deficient.tolist())))
    second = [r for r in got if r.vec_id is not None and 500 <= r.vec_id < 900]
    check(rows, second, huge, {500 + i: v for i, v in enumerate(huge.tolist())})
    assert sum(r.vec_id is None for r in got) == 3 and not any(r.vec_id == 900 for r in got)


def test_solves_and_shifted_factors():
    rng = np.random.default_rng(1)
    r = np.triu(rng.normal(size=(6, 6))) + 4 * np.eye(6)
    rows = rng.normal(size=(9, 6))
    assert np.allclose(whitening.solve_upper(rows, r) @ r, rows)
    g = np.ones((4, 4))
    f = whitening.cholesky(g, 0.0)
    assert np.allclose(f.T @ f, g, atol=1e-10)
