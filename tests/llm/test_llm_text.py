"""Language identification, toxicity, packing and decontamination on small cases."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusframe.llm import decontam, langid, packing, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LANGS = {
    "aa": ["thun", "blor", "sheng", "wath", "onder", "thing"],
    "bb": ["uelo", "ciña", "rro", "ajos", "ente", "mía"],
    "cc": ["eaux", "ouè", "tré", "menç", "vien", "ière"],
}


def sentences(lang, n, seed):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choices(LANGS[lang], k=rng.choice([1, 2]))) for _ in range(n))


def test_language_of_held_out_texts_and_odd_rows(spark):
    rows = [(i, sentences(lang, 5 + i % 40, i), lang, "s", 0) for i, lang in enumerate(list(LANGS) * 60)]
    train = spark.createDataFrame(rows, DOCS)
    model = langid.train_language_model(train, per_language=40, landmarks_per_language=8)
    odd = [(900, None, "aa", "s", 0), (901, "", "aa", "s", 0), (902, "12 34 !?", "aa", "s", 0), (None, sentences("bb", 9, 7), None, None, None),
           (903, "퟿ x", None, None, None), (904, sentences("cc", 60_000, 1), "aa", "s", 0)]
    fresh = [(1000 + i, sentences(lang, 12, f"new{i}"), lang, "s", 0) for i, lang in enumerate(list(LANGS) * 20)]
    docs = spark.createDataFrame(odd + fresh + fresh[:2], DOCS).withColumn("score", F.lit("clash"))
    got = langid.identify(docs, model).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(odd) + len(fresh) + 2
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0.0 for i in (900, 901, 902))
    assert by_id[None].lang_pred == "bb" and by_id[904].lang_pred == "cc"
    right = sum(by_id[i].lang_pred == lang for i, _, lang, _, _ in fresh)
    assert right >= 0.95 * len(fresh)
    assert all(0.0 <= r.score <= 1.0 for r in got)
    empty = langid.train_language_model(train.limit(0))
    assert {r.lang_pred for r in langid.identify(docs, empty).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).collect() == []


def test_kernel_equals_shared_grams():
    texts = [sentences(lang, 20, 1) for lang in LANGS] + ["a", "aa"]
    sets = [langid.grams(t, 3) for t in texts]
    model = langid.fit_kernel(sets, ["x", "y", "z", "x", "y"], 3, 5, 0.1)
    chosen = [i for lang in "xyz" for i in range(5) if "xyzxy"[i] == lang]
    plain = {i: {(n, texts[i][k : k + n]) for n in (1, 2, 3) for k in range(len(texts[i]) - n + 1)} for i in range(5)}
    for row, kernel in zip(plain.values(), model.kernel(sets)):
        want = [len(row & plain[j]) / np.sqrt(len(row) * len(plain[j])) for j in chosen]
        assert np.allclose(sorted(kernel), sorted(want), atol=1e-6)


def test_toxicity_folding_exceptions_and_odd_rows(spark):
    rng = random.Random(4)
    words = [f"wort{a}{b}" for a in "abcdefgh" for b in "klmnopqr"]
    rows, labels = [], []
    for i in range(400):
        body = rng.choices(words, k=rng.randrange(5, 60))
        bad = i % 4 == 0
        if bad:
            body.insert(rng.randrange(len(body)), rng.choice(["vilefoo", "vilefoo!", "stupor" + rng.choice("xyz") * 2]))
        elif i % 4 == 1:
            body.insert(rng.randrange(len(body)), "trash can")
        rows.append((i, " ".join(body), "aa", "s", 0))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, DOCS)
    lexicon = toxicity.train_lexicon(docs, spark.createDataFrame(labels + [(None, 1), (5000, None)], "doc_id long, label int"), min_g2=15, exceptions=("trash can",))
    assert ("vilefoo", True) in lexicon.weights or any("vilefoo".startswith(e) for e, _ in lexicon.weights)
    lexicon.weights["trash", True] = 5.0
    cases = [(1, "worta v1l3f00 wortb"), (2, "worta VILЕFОО wortb"), (3, "worta trash can wortb"), (4, "worta trash wortb"), (5, None), (6, ""),
             (7, "worta " * 50_000 + "vilefoo"), (8, "prevention"), (None, "vilefoo"), (1, "worta v1l3f00 wortb")]
    scored = toxicity.score_texts(spark.createDataFrame([(i, t) for i, t in cases], "doc_id long, text string").withColumn("predicted", F.lit("x")), lexicon).collect()
    high = lambda i: next(r.score for r in scored if r.doc_id == i)
    assert len(scored) == len(cases)
    assert high(1) > 0.5 and high(2) > 0.5 and high(4) > 0.5 and high(None) > 0.5
    low = high(5)
    assert low < 0.3 and high(6) == low and high(3) == low and high(8) == low
    assert low < high(7) < high(1)  # normalised by length
    one = toxicity.train_lexicon(docs, spark.createDataFrame([(1, 0)], "doc_id long, label int"))
    assert all(r.predicted == 0 for r in toxicity.score_texts(docs, one).collect())
    assert toxicity.score_texts(docs.limit(0), lexicon).collect() == []


def test_exceptions_need_an_excess_of_different_clean_texts(spark):
    rows = [(i, f"wort{i} vilefoo abc rest{i}") for i in range(100)] + [(100 + i, f"gut{i} rest{i}") for i in range(300)]
    rows += [(400 + i, f"noisy{i} vilefoo abc") for i in range(4)] + [(410, "vilefoo once " * 5)] + [(420 + i, "same vilefoo def") for i in range(4)]
    labels = [(i, int(i < 100)) for i, _ in rows]
    lexicon = toxicity.train_lexicon(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, label int"))
    assert lexicon.weights and lexicon.exceptions == ()


def test_every_letter_form_is_folded():
    assert toxicity.fold("\U0001d42f\U0001d422\U0001d425\U0001d41e\U0001d42d") == "vilet"
    assert toxicity.fold("\u24b6\u24d1\u24d2 \U0001d400") == "abc a" and toxicity.fold("d\u00e9j\u00e0") == "d\u00e9j\u00e0"


def test_pieces_equal_the_tokenizer(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["It's <|startoftext|> x<|ENDOFTEXT|>y 3.14abc", "İstanbul ΣΑΣ İİ.. é é x a b\x1c c\x85y", "日本語 हिन्दी, क़लम!", None, "", "a b " * 6000, "x", "x"]
    docs = spark.createDataFrame([(i if i != 6 else None, t, None, None, None) for i, t in enumerate(texts)], DOCS).withColumn("piece", F.lit("clash"))
    got = packing.pack_documents(docs, capacity=50).collect()
    for i, text in enumerate(texts):
        ids = whole.encode(text or "", add_special_tokens=False).ids + [1]
        want = [(k // 50, k, len(ids[k : k + 50]), zlib.crc32(np.array(ids[k : k + 50], "<u4").tobytes())) for k in range(0, len(ids), 50)]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in got if r.doc_id == (i if i != 6 else None)) == want
    assert packing.pack_documents(docs.limit(0)).collect() == []


def test_strings_in_use_are_learned_once(monkeypatch):
    rng = random.Random(4)
    vocabulary = packing.Vocabulary("word_bpe_49k.json")
    learned, learn = [], packing.Vocabulary.learn
    monkeypatch.setattr(packing.Vocabulary, "limit", 60)
    monkeypatch.setattr(packing.Vocabulary, "learn", lambda self: learned.extend(self.unknown) or learn(self))
    for _ in range(40):
        words = ["".join(rng.choices("aeioustnrÉçß", k=rng.randint(1, 9))) + rng.choice(["", ".", ",&&"]) for _ in range(20)]
        texts = [" ".join(["The", "fox,", *words, rng.choice(["x<|endoftext|>Y", "가각 ᄀ", "ᅡ क़ e\u0301", "3.14a's", "\x1cA"])]), None, "fox, the"]
        want = [np.array(vocabulary.tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert vocabulary.ids(texts) == want
    assert learned.count(b"fox,") == learned.count(b"the") == 1
    assert len(vocabulary) + len(vocabulary.older) <= 3 * 60


def test_a_vocabulary_holds_no_more_strings_than_its_limit(monkeypatch):
    monkeypatch.setattr(packing.Vocabulary, "limit", 400)
    vocabulary, rng = packing.Vocabulary("word_bpe_49k.json"), random.Random(6)
    for _ in range(30):
        words = ["".join(rng.choices("aeioustnré", k=9)) + rng.choice(["", ".", ",&"]) for _ in range(40)]
        assert vocabulary.ids([" ".join(words)]) == [vocabulary.encode(" ".join(words).encode())]
        own = [x for x in [vocabulary, *vars(vocabulary).values()] if isinstance(x, dict)]
        assert sum(map(len, own)) <= 400 + 2 * 2 * 40 + 10


@pytest.mark.parametrize("seed", range(3))
def test_packing_fills_sequences(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([rng.randrange(1, 30), rng.randrange(30, 101)]) for _ in range(900)]
    pieces = spark.createDataFrame([(i, 0, 0, n, i) for i, n in enumerate(sizes)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = packing.pack(pieces, 100, group_rows=200).toPandas()
    assert sorted(got.doc_id) == list(range(900)) and got.length.tolist() == [sizes[i] for i in got.doc_id]
    fill = got.groupby("sequence_id").length.sum()
    assert fill.max() <= 100 and len(fill) <= 1.02 * -(-sum(sizes) // 100) + 1
    ordered = got.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id").length.cumsum() - ordered.length == ordered.offset).all()


def test_local_search_empties_a_bin_that_best_fit_leaves():
    lengths = np.array([44, 24, 24, 22, 21, 17, 8, 8, 6, 6])
    first = packing.best_fit(lengths.tolist(), 61)
    again = packing.improve([list(b) for b in first], lengths, 61)
    assert sorted(i for b in again for i in b) == list(range(10))
    assert len(first) == 4 and len(again) == 3
    assert max(lengths[b].sum() for b in again) <= 61


def brute_tiles(item, document, least):
    free_i, free_d, out = [True] * len(item), [True] * len(document), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(document)):
                n = 0
                while i + n < len(item) and j + n < len(document) and item[i + n] == document[j + n] and free_i[i + n] and free_d[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < least:
            return out
        n, i, j = best
        free_i[i : i + n] = [False] * n
        free_d[j : j + n] = [False] * n
        out += n


def test_tiles_equal_brute_force():
    rng = random.Random(8)
    for _ in range(150):
        item = rng.choices("abcd", k=rng.randrange(3, 25))
        document = rng.choices("abcd", k=rng.randrange(0, 40))
        if rng.random() < 0.6:
            at = rng.randrange(len(item))
            document[3:3] = item[at:] + item[:at]
        seeds = decontam.Seeds([(1, " ".join(item))], 3)
        places = seeds.hits(decontam.words(" ".join(document))).get(1, [])
        assert sum(t[2] for t in decontam.tile(places, 3, len(item))) == brute_tiles(item, document, 3)


def test_decontamination_cases(spark):
    rng = random.Random(2)
    passage = [f"w{rng.randrange(500)}" for _ in range(40)]
    noise = lambda n: [f"n{rng.randrange(9000)}" for _ in range(n)]
    item = " ".join(passage)
    docs = [(1, " ".join(noise(50) + passage + noise(50))), (2, " ".join(passage[20:] + noise(7) + passage[:20])), (3, " ".join(noise(300))), (4, None), (5, ""),
            (6, " ".join(noise(40_000) + passage)), (None, item.upper()), (7, " ".join(passage[:12])), (1, " ".join(noise(50) + passage)), (8, "w1 " * 500)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame([(10, item), (11, "too short"), (12, None), (13, ""), (10, item)], "item_id long, text string")
    got = decontam.contaminated(frame, bench).collect()
    assert sorted({(r.doc_id or 0, r.item_id) for r in got}) == [(0, 10), (1, 10), (2, 10), (6, 10)]
    assert all(r.coverage == 1.0 for r in got) and {r.tiles for r in got if r.doc_id == 2} == {2}
    assert {(r.doc_id or 0, r.item_id) for r in decontam.contaminated(frame, bench, block_bytes=100).collect()} == {(r.doc_id or 0, r.item_id) for r in got}
    assert decontam.contaminated(frame.limit(0), bench).collect() == [] and decontam.contaminated(frame, bench.limit(0)).collect() == []
