"""Verdicts on URLs: host and path rules first, a boosted-tree model on lexical features for the rest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array  # noqa: F401  (a JVM function)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host with all its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    rest = _rest(url)
    return F.translate(F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)", 1), F.lit("")), ASCII_UPPER, ASCII_LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct (name, verdict); null where none does. Ties: the first in text order."""
    fits = [
        F.when(((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)),
               F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict")))
        for r in sorted(rules, key=lambda r: (-len(r.name), r.name))
    ]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<name:string,verdict:string>")


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Numbers read off the text of a URL; nulls count as empty text.

    Of the suffix only its form is told, not its name: rules name suffixes, and a model that sees them learns nothing else.
    """
    text = F.coalesce(url, F.lit(""))
    n = F.greatest(F.length(text), F.lit(1))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    suffix = F.regexp_extract(host, r"([^.]*)$", 1)
    symbols = F.array_distinct(F.split(text, ""))
    entropy = F.aggregate(
        F.transform(symbols, lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n), F.lit(0.0),
        lambda total, p: total - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    out = {
        "url_length": F.length(text), "host_length": F.length(host), "path_length": F.length(path),
        "path_depth": F.size(F.filter(F.split(path, "/"), lambda x: x != "")), "host_labels": F.size(F.split(host, r"\.")),
        "digit_ratio": F.length(F.regexp_replace(text, "[^0-9]", "")) / n,
        "letter_ratio": F.length(F.regexp_replace(text, "[^A-Za-z]", "")) / n,
        "hyphens": F.length(F.regexp_replace(text, "[^-]", "")), "entropy": entropy,
        "parameters": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))),
        "has_fragment": F.instr(text, "#") > 0, "is_https": F.startswith(text, F.lit("https://")),
        "suffix_length": F.length(suffix), "suffix_is_country": suffix.rlike("^[a-z]{2}$"), "suffix_is_number": suffix.rlike("^[0-9]+$"), "has_extension": path.rlike(r"\.[A-Za-z0-9]{1,5}$"),
        "first_segment_length": F.length(F.regexp_extract(path, r"^/([^/]*)", 1)),
    }
    return {k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in out.items()}


@dataclass(frozen=True)
class UrlModel:
    """Boosted trees, the score from which a URL is blocked, and the balanced accuracy there on labelled URLs held out of the fit."""

    trees: PipelineModel | None
    cut: float
    accuracy: float | None
    constant: float = 0.0


def scored(df: DataFrame, model: UrlModel) -> DataFrame:
    """Add ``p`` to (row, url, host, path, ...); the features do not stay."""
    if model.trees is None:
        return df.withColumn("p", F.lit(model.constant))
    wide = df.select("*", *[v.alias(f"f_{k}") for k, v in lexical_features(F.col("url"), F.col("host"), F.col("path")).items()])
    return model.trees.transform(wide).select(*df.columns, vector_to_array("probability")[1].alias("p"))


def train_url_model(labelled: DataFrame, max_rows: int = 20_000, trees: int = 10, depth: int = 4, held_out: float = 0.25, seed: int = 5) -> UrlModel:
    """Boosted trees on labelled URLs (columns url, label; 1.0: block); a constant where the labels hold fewer than two classes.

    At most about ``max_rows`` labelled rows are used, drawn by a hash of the URL, and each URL counts once per label. Both
    labels get equal weight. The cut is the score with the best mean of the shares of blocked and allowed URLs told right
    among the ``held_out`` share of the drawn ones, that nearest to the middle of equals; without both labels there it is 0.5.
    """
    counts = {r[0]: r[1] for r in labelled.groupBy(F.col("label").cast("double")).count().collect() if r[0] is not None}
    if len(counts) < 2:
        return UrlModel(None, 0.5, None, next(iter(counts), 0.0))
    scale = 1_000_000
    place = F.pmod(F.xxhash64(F.lit(seed), "url"), F.lit(scale))
    share = min(1.0, max_rows / sum(counts.values()))
    drawn = labelled.where(place < int(share * scale)).select("url", F.col("label").cast("double").alias("label")).where("label is not null").distinct()
    drawn = drawn.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url")), "out": F.pmod(F.xxhash64(F.lit(seed + 1), "url"), F.lit(scale)) < int(held_out * scale)})
    fit = drawn.where("not out")
    sizes = {r["label"]: r["count"] for r in fit.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return UrlModel(None, 0.5, None, max(counts, key=counts.get))
    weight = F.when(F.col("label") == 1.0, 0.5 / sizes.get(1.0, 1)).otherwise(0.5 / sizes.get(0.0, 1)) * sum(sizes.values())
    names = list(lexical_features(F.col("url"), F.col("host"), F.col("path")))
    assembler = VectorAssembler(inputCols=[f"f_{k}" for k in names], outputCol="features")
    wide = fit.select("label", weight.alias("weight"), *[v.alias(f"f_{k}") for k, v in lexical_features(F.col("url"), F.col("host"), F.col("path")).items()])
    rows = assembler.transform(wide).select("features", "label", "weight").repartition(8).cache()
    boosted = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=trees, maxDepth=depth, seed=seed, cacheNodeIds=False).fit(rows)
    rows.unpersist()
    model = UrlModel(PipelineModel([assembler, boosted]), 0.5, None)
    steps = scored(drawn.where("out"), model).groupBy(F.floor(F.col("p") * 1000).alias("step"), "label").count().collect()
    return _with_cut(model, [(r["step"], r["label"], r["count"]) for r in steps])


def _with_cut(model: UrlModel, steps: list[tuple[int, float, int]]) -> UrlModel:
    """The model with the best cut for counts (thousandths of a score, label, count)."""
    blocked, allowed = (sum(n for _, y, n in steps if y == label) for label in (1.0, 0.0))
    if not blocked or not allowed:
        return model

    def accuracy(cut: int) -> float:
        right = sum(n / (blocked if y == 1.0 else allowed) for step, y, n in steps if (step >= cut) == (y == 1.0))
        return round(right / 2, 12)

    cuts = {c: accuracy(c) for c in range(1001)}
    best = max(cuts.values())
    equals = [c for c, a in cuts.items() if a == best]
    cut = min(equals, key=lambda c: (abs(c - sum(equals) / len(equals)), c))
    return UrlModel(model.trees, cut / 1000, best)


def judge_urls(df: DataFrame, rules: list[Rule], url: str = "url", labelled: DataFrame | None = None, **training) -> DataFrame:
    """Add host, path, rule (null where none fits), verdict (allow or block) and block_score.

    The rule decides where one fits, the model elsewhere. Without ``labelled`` (columns url, label)
    the URLs that a rule judges are the labels. A null URL has empty host and path and is judged by
    the model; repeated rows are judged alike; very long URLs are read whole; an empty table gives no rows. Columns of the input with the
    added names are replaced, all others stay, whatever their names.
    """
    kept = [c for c in df.columns if c.lower() not in {"host", "path", "rule", "verdict", "block_score"}]
    row = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.lit(None)
    base = df.select(row.alias("row"), F.col(f"`{url}`").alias("url")).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    judged = base.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    if labelled is None:
        labelled = judged.where("rule is not null").select("url", (F.col("rule.verdict") == "block").cast("double").alias("label"))
    model = train_url_model(labelled.select("url", "label"), **training)
    verdict = F.coalesce(F.col("rule.verdict"), F.when(F.col("p") >= model.cut, "block").otherwise("allow"))
    return scored(judged, model).select(
        *[F.col("row")[c].alias(c) for c in kept], "host", "path", F.col("rule.name").alias("rule"), verdict.alias("verdict"), F.col("p").alias("block_score"))
