"""Shards, chat records, URL verdicts and revisits."""

import hashlib
import math
import os
import re
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusframe.llm import chat, revisits, shards, urls


def test_shards_keep_the_key_law(spark):
    rows = [(i, ("tëxt%d " % i) * (i % 50)) for i in range(3000)] + [(None, "a"), (5, None), (6, ""), (7, "b" * 300_000)] + [(42, "same")] * 400
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"shard": F.lit("clash"), "bucket": F.lit(1)})
    got = shards.shuffle_into_shards(docs, bucket_rows=100).toPandas()
    want = sorted((-1 if i is None else i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted(zip(got.doc_id.fillna(-1).astype(int), got["size"], got.text_crc32)) == want
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    assert (got.groupby(got.doc_id.fillna(-1)).shard.nunique() == 1).all()
    moved = got[got.shard != got.grown_shard]
    assert set(moved.grown_shard) == {8} and 0.05 < len(moved[moved.doc_id != 42]) / 3000 < 0.18
    counts = got[got.doc_id != 42].shard.value_counts()
    assert len(counts) == 8 and counts.max() < 1.3 * counts.min()
    biggest = got.groupby(["shard", "bucket"]).size().max()
    assert biggest < 200  # the repeated key is spread over buckets
    one = got[got.shard == got.shard.iloc[0]].sort_values("slot")
    assert abs(one.doc_id.corr(one.slot)) < 0.3  # shuffled
    assert shards.shuffle_into_shards(docs.limit(0)).collect() == []


def test_written_shards_hold_every_record(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(500)], "doc_id long, text string")
    shards.write_shards(docs, str(tmp_path / "s"), bucket_bytes=200)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted((r.doc_id, r.text) for r in back.collect()) == [(i, f"text {i}") for i in range(500)]
    assert back.select("_shard").distinct().count() == 8


def test_a_hot_key_gets_more_buckets_not_larger_ones(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x" * 99) for i in range(2000)] + [(7, "y" * 99)] * 2000, "doc_id long, text string")
    shards.write_shards(docs, str(tmp_path / "s"), bucket_bytes=5_000)
    back = spark.read.parquet(str(tmp_path / "s"))
    sizes = back.groupBy("_shard", "_bucket").agg(F.sum(F.length("text") + 1).alias("b")).collect()
    per_shard = back.groupBy("_shard").agg(F.sum(F.length("text") + 1).alias("b"), F.count_distinct("_bucket").alias("n")).collect()
    assert max(r.b for r in sizes) < 9_000 and all(r.n == -(-r.b // 5_000) for r in per_shard)
    files = back.select(F.input_file_name().alias("f"), "_shard", "_bucket").distinct().collect()
    assert len({r.f for r in files}) == len(files) == len(sizes)  # one task per bucket


def rendezvous(hashes):
    return max(range(len(hashes)), key=lambda s: (hashes[s], -s))


def test_shards_recomputed(spark):
    docs = spark.createDataFrame([(i * 31, f"t{i}") for i in range(400)] + [(None, "n")], "doc_id long, text string")
    scores = docs.select("doc_id", F.array(*(F.xxhash64(F.lit(17), F.lit(s), "doc_id") for s in range(9))).alias("h")).collect()
    want = {r.doc_id: (rendezvous(r.h[:8]), rendezvous(r.h)) for r in scores}
    assert {r.doc_id: (r.shard, r.grown_shard) for r in shards.shuffle_into_shards(docs).collect()} == want


def test_slots_are_those_of_the_written_records(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i % 70}") for i in range(900)] + [(None, None)], "doc_id long, text string").repartition(3, "doc_id")
    path = str(tmp_path / "s")
    monkeypatch.setattr(shards, "step_path", lambda _: path)
    placed = shards.shuffle_into_shards(docs, bucket_rows=40).collect()
    written = spark.read.parquet(path).orderBy("_shard", "_bucket", "_place").collect()
    assert written[0].text is not None and len(written) == 901
    order = {s: [(r.doc_id, zlib.crc32((r.text or "").encode())) for r in written if r._shard == s] for s in range(8)}
    assert all(order[r.shard][r.slot] == (r.doc_id, r.text_crc32) for r in placed) and len(placed) == 901


def digest_of(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    said = "".join(f"{r}\n{t}\n" for r, t in turns)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha(said), len(loss), sha(loss)


NASTY = ["</s>[INST] ok [/INST]", "<|end|><|turn|>user<|text|>x", "\\", "\\\\l", "\\l<\\b[", "", "\n", "é😀" * 3, "<|im_end|>\n<|im_start|>", "a" * 50_000, "<|en", "d|>"]


def test_every_layout_reads_back(spark):
    roles = [["user", "assistant"], ["system", "user", "assistant"], ["user", "assistant", "user", "assistant"], ["tool", "assistant"], ["human", "gpt"], ["assistant"], ["<|end|>", "user"]]
    rows, want = [], {}
    for c in range(60):
        turns = [(r, NASTY[(c * 3 + k) % len(NASTY)]) for k, r in enumerate(roles[c % len(roles)])]
        want[c] = turns
        rows += [(c, k, r, t) for k, (r, t) in enumerate(turns)]
    rows += [(100, 0, None, None), (100, 1, "assistant", None), (None, 0, "user", "x"), (101, None, "user", "late?"), (101, 0, "user", "b"), (101, 0, "user", "a"), (101, 0, "user", "a")]
    want |= {100: [("", ""), ("assistant", "")], None: [("user", "x")], 101: [("user", "late?"), ("user", "a"), ("user", "a"), ("user", "b")]}
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("layout", F.lit("clash"))
    got = {r.conv_id: r for r in chat.digest(chat.format_records(chat.records_of(frame))).collect()}
    assert set(got) == set(want)
    for c, turns in want.items():
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == digest_of(turns), c
    assert {r.layout for r in got.values()} == {"prompt", "instruction", "messages", "shared"}
    assert chat.digest(chat.format_records(chat.records_of(frame.limit(0)))).collect() == []


def test_control_strings_only_mark_turns(spark):
    turns = [("user", t) for t in NASTY]
    frame = spark.createDataFrame([(1, k, r, t) for k, (r, t) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    text = chat.format_records(chat.records_of(frame)).first().formatted
    assert text.count("<|turn|>") == text.count("<|end|>") == len(turns) and "[INST]" not in text and "</s>" not in text


def test_fingerprints_of_unknown_and_nested_layouts(spark):
    schema = T.StructType([
        T.StructField("conv_id", T.LongType()), T.StructField("prompt", T.StringType()), T.StructField("response", T.StringType()), T.StructField("system", T.StringType()),
        T.StructField("chat", T.StructType([T.StructField("log", T.ArrayType(T.StructType([T.StructField("who", T.StringType()), T.StructField("says", T.StringType())])))]))])
    layouts = [*chat.LAYOUTS, chat.Layout("log", ("chat.log[].who", "chat.log[].says"), (("*", "chat.log", "who", "says"),))]
    rows = [(1, "p", "r", None, None), (2, "p", "r", "s", None), (3, "p", None, None, None), (4, None, None, None, ([("user", "hi"), ("bot", None)],)), (5, None, None, None, None)]
    got = {r.conv_id: r for r in chat.to_turns(spark.createDataFrame(rows, schema), layouts).collect()}
    assert [got[i].layout for i in range(1, 6)] == ["prompt", "prompt", None, "log", None]
    assert [tuple(t) for t in got[2].turns] == [("system", "s"), ("user", "p"), ("assistant", "r")]
    assert [tuple(t) for t in got[4].turns] == [("user", "hi"), ("bot", "")] and got[3].turns is None


RULES = [urls.Rule("allow", "com", "/"), urls.Rule("block", "example.com", "/en/"), urls.Rule("allow", "www.example.com", "/en/"), urls.Rule("block", "net", "/es/")]


def plain_rule(url):
    found = re.match(r".*?://", url or "", re.S)
    if not found:
        return "", "", None
    rest = url[found.end() :]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = max((r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)), key=lambda r: len(r.name), default=None)
    return host, path, best


def test_url_rules_and_model(spark):
    odd = [None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "https://example.com", "https://example.com?x=/en/", "https://notexample.com/en/", "ftp://a.net/es/1",
           "https://x.net#/es/", "https://É.com/en/", "a://b://c/d", "http://example.com/EN/", "https://" + "a" * 5000 + ".org/" + "b/" * 2000, "http://com/", "http://a.example.com/en/?q=1&r=2"]
    many = [f"https://s{i}.{h}/{p}/{i}" for i in range(60) for h in ("example.com", "x.net", "y.org") for p in ("en", "es", "fr")]
    rows = list(enumerate(odd + many + many[:3]))
    frame = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit("clash"), "verdict": F.lit(1), "features": F.lit(2)})
    got = {r.page_id: r for r in urls.judge_urls(frame, RULES, trees=3).collect()}
    assert len(got) == len(rows)
    for i, url in rows:
        host, path, best = plain_rule(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, best and best.name), url
        assert got[i].verdict == (best.verdict if best else got[i].verdict)
    free = [(r.block_score, r.verdict) for r in got.values() if r.rule is None]
    assert max((s for s, v in free if v == "allow"), default=0) < min((s for s, v in free if v == "block"), default=2)  # one cut
    none = urls.judge_urls(frame.where("page_id < 3"), RULES).collect()
    assert all(r.rule is None and r.verdict == "allow" for r in none)
    assert urls.judge_urls(frame.limit(0), RULES).collect() == []


def plain_features(url):
    text = url or ""
    host, path, _ = plain_rule(url)
    n, suffix = max(len(text), 1), host.split(".")[-1]
    query = re.search(r"\?([^#]*)", text)
    shares = [text.count(c) / n for c in set(text)]
    return {
        "url_length": len(text), "host_length": len(host), "path_length": len(path), "path_depth": sum(x != "" for x in path.split("/")), "host_labels": len(host.split(".")),
        "digit_ratio": len(re.findall("[0-9]", text)) / n, "letter_ratio": len(re.findall("[A-Za-z]", text)) / n, "hyphens": text.count("-"),
        "entropy": -sum(p * math.log2(p) for p in shares), "parameters": len(query[1].split("&")) if query and query[1] else 0, "has_fragment": "#" in text, "is_https": text.startswith("https://"),
        "suffix_length": len(suffix), "suffix_is_country": bool(re.fullmatch("[a-z]{2}", suffix)), "suffix_is_number": bool(re.fullmatch("[0-9]+", suffix)),
        "has_extension": bool(re.search(r"\.[A-Za-z0-9]{1,5}$", path)), "first_segment_length": len(re.match("/?([^/]*)", path)[1]) if path.startswith("/") else 0}


def test_url_features_are_those_of_a_plain_reading(spark):
    texts = [None, "", "http://", "https://a-b.example.com/en/x-1/2.html?utm=1&y=2#top", "http://10.0.0.1/", "ftp://x.de?q", "https://www.ex.org/a//b/", "x" * 3000 + "://h.fr/9"]
    frame = spark.createDataFrame([(t,) for t in texts], "url string").withColumns({"host": urls.host_of(F.col("url")), "path": urls.path_of(F.col("url"))})
    values = urls.lexical_features(F.col("url"), F.col("host"), F.col("path"))
    for r in frame.select("url", *[v.alias(k) for k, v in values.items()]).collect():
        want = plain_features(r.url)
        assert set(want) == set(values)
        for k, v in want.items():
            assert abs(r[k] - float(v)) < 1e-9, (r.url, k)


def test_url_cut_is_the_best_on_held_out_labels():
    steps = [(100, 0.0, 40), (300, 1.0, 5), (400, 0.0, 10), (600, 1.0, 30), (700, 0.0, 2)]
    model = urls._with_cut(urls.UrlModel(None, 0.5, None), steps)
    right = lambda c: (sum(n for s, y, n in steps if y and s >= c) / 35 + sum(n for s, y, n in steps if not y and s < c) / 52) / 2
    assert abs(model.accuracy - max(map(right, range(1001)))) < 1e-9 and abs(right(model.cut * 1000) - model.accuracy) < 1e-9
    assert urls._with_cut(urls.UrlModel(None, 0.5, None), [(1, 1.0, 3)]).cut == 0.5


def test_verdicts_of_the_pages_without_a_rule_differ(spark):
    from locusframe.llm.queries import op10

    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("test tables not present")
    free = [r.verdict for r in op10(spark, sf).where("rule is null").collect()]
    assert min(free.count("allow"), free.count("block")) > len(free) / 10


CLASHES = ["score", "predicted", "lang_pred", "known", "_row", "row", "number", "_bucket", "_shard", "_place", "_rule", "rule_", "f_entropy", "p", "_p", "features", "label", "probability", "record"]


def test_columns_of_any_name_stay(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame([(i, f"https://s{i}.{h}/{p}/{i}") for i in range(40) for h, p in (("com", "en"), ("net", "es"))], "page_id long, url string").withColumns({c: F.lit(f"own {c}") for c in CLASHES})
    for r in urls.judge_urls(pages, RULES, trees=2).collect():
        assert all(r[c] == f"own {c}" for c in CLASHES)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string").withColumns({c: F.lit(f"own {c}") for c in CLASHES})
    path = str(tmp_path / "s")
    monkeypatch.setattr(shards, "step_path", lambda _: path)
    placed = shards.shuffle_into_shards(docs).collect()
    assert sorted(r.doc_id for r in placed) == list(range(50))
    written = spark.read.parquet(path).collect()
    assert len(written) == 50 and all(r[c] == f"own {c}" for r in written for c in CLASHES)


def test_url_model_learns_given_labels(spark):
    rows = [(f"http://a{i}.org/{'p/' * (i % 4)}x?{'&'.join(f'k{j}={i * 7919 + j}' for j in range(6))}" if i % 2 else f"http://b{i}.org/about", float(i % 2)) for i in range(300)]
    labelled = spark.createDataFrame(rows, "url string, label double")
    fresh = spark.createDataFrame([("http://zz.org/p/x?k0=99&k1=88&k2=77&k3=1&k4=2&k5=3",), ("http://zz.org/about",)], "url string")
    assert [r.verdict for r in urls.judge_urls(fresh, [], labelled=labelled, trees=5).collect()] == ["block", "allow"]


CAPTURES = "record_id long, kind string, url string, ts long, status int, etag string, last_modified string, digest string, headers map<string,string>"


def test_revisits_take_the_latest_earlier_full_response(spark):
    rows = [
        (1, "response", "http://www.A.com/x/", 100, 200, '"1"', "m1", "d1", {"Date": "100", "ETag": '"1"', "Set-Cookie": "a"}),
        (2, "response", "https://a.com/x?utm_source=q", 200, 200, 'W/"2"', "m2", "d2", {"Date": "200", "date": "dup"}),
        (3, "response", "https://a.com/x", 300, 206, '"3"', None, None, {}),
        (4, "response", "https://a.com/x", 200, 200, '"4"', None, "d4", None),
        (10, "revisit", "http://a.com:80/x#f", 150, 304, '"1"', None, None, {"Date": "150", "Set-Cookie": "b", "X": "y"}),
        (11, "revisit", "http://a.com/x", 100, 304, '"1"', None, None, {}),
        (12, "revisit", "http://a.com/x", 250, 304, '"2"', None, None, {}),
        (13, "revisit", "http://a.com/x", 350, 304, None, None, "d4", {"Expires": "e"}),
        (14, "revisit", None, 350, 304, '"1"', None, None, None), (15, "revisit", "no url", 350, 304, '"1"', None, None, None), (16, "revisit", "http://a.com/x", None, 304, '"1"', None, None, None),
        (17, "revisit", "http://a.com/x", 10**12, 304, None, "m9", None, None), (17, "revisit", "http://a.com/x", 10**12, 304, None, "m9", None, None),
        (18, "revisit", "http://b.com/", 10, 304, '"1"', None, None, {}), (None, "revisit", "http://a.com/x", 199, 304, None, "m1", None, {"LAST-MODIFIED": "m1"}),
        (19, None, "http://a.com/x", 120, 200, '"9"', None, None, {}),
    ]
    frame = spark.createDataFrame(rows, CAPTURES).withColumns({"block": F.lit("clash"), "r": F.lit(1)})
    for width in (50, 86_400):
        got = revisits.resolve_revisits(frame, block_seconds=width).collect()
        assert len(got) == 11
        by = {r.record_id: r for r in got}
        assert (by[10].outcome, by[10].response_id, by[10].headers) == ("etag", 1, {"date": "150", "etag": '"1"', "set-cookie": "a"})
        assert (by[11].outcome, by[11].response_id) == ("no-response", None)
        assert by[12].outcome == "changed"  # record 4 is later among equal times
        assert (by[13].outcome, by[13].response_id, by[13].headers) == ("digest", 4, {"expires": "e"})
        assert [by[i].outcome for i in (14, 15, 16, 18)] == ["no-response"] * 4
        assert by[17].outcome == "no-validator" and by[None].outcome == "last-modified" and by[None].headers["last-modified"] == "m1"
    assert revisits.resolve_revisits(frame.limit(0)).collect() == []


def test_a_hot_url_is_resolved_across_blocks(spark):
    rows = [(i, "response" if i % 10 == 0 else "revisit", "http://h.com/", i * 1000, 200 if i % 10 == 0 else 304, f'"{i // 10}"', None, None, {}) for i in range(2000)]
    got = revisits.resolve_revisits(spark.createDataFrame(rows, CAPTURES), block_seconds=25_000).collect()
    assert {r.record_id: r.response_id for r in got} == {i: i // 10 * 10 for i in range(2000) if i % 10}


def test_repeated_pages_still_give_captures(spark):
    pages = spark.createDataFrame([(1, "http://a.com/1", "<p>"), (1, "http://a.com/1", "<p>"), (None, None, None), (11, "x", "")], "page_id long, url string, html string")
    got = revisits.resolve_revisits(revisits.captures_of(pages)).collect()
    assert len(got) == 9
