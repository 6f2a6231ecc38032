"""Cross-species conservation of transcript segments, homology, synteny and gene age."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.functions.sequence import identity_count
from locusframe.functions.values import safe_ratio, to_float_lenient
from locusframe.operators.intervals import interval_join, islands, union_length
from locusframe.operators.ordered import left_lookup, position_block, running, with_rank
from locusframe.session import discard, materialize

RUN = ["species", "mode"]
# A base id with at most so many segments is worked on as one array; others go through joins that spread their segments.
SMALL = 64


def base_id(segment: Column) -> Column:
    """Id without its last ``_`` piece."""
    return F.regexp_replace(segment, "_[^_]*$", "")


def block_intervals(start: Column, end: Column, sizes: Column, starts: Column) -> Column:
    """Blocks as ``array<struct<start,end>>``; no sizes means one block, missing offsets are 0."""
    whole = F.array(F.struct(start.alias("start"), end.alias("end")))
    offsets = F.when(F.size(starts) == 0, F.transform(sizes, lambda _: F.lit(0).cast("bigint"))).otherwise(starts)
    n = F.least(F.size(sizes), F.size(offsets))
    parts = F.zip_with(F.slice(offsets, 1, n), F.slice(sizes, 1, n), lambda o, s: F.struct(
        (start + o).alias("start"), (start + o + s).alias("end")))
    return F.when(F.size(sizes) == 0, whole).otherwise(parts)


def pair_problems(query: DataFrame, target: DataFrame) -> DataFrame:
    """Segments present on one side only or with sequences of different length (must be empty)."""
    q = query.select(*RUN, "segment_id", F.length("seq").alias("q_length"))
    t = target.select(*RUN, "segment_id", F.length("seq").alias("t_length"))
    return q.join(t, [*RUN, "segment_id"], "full_outer").where("q_length is null or t_length is null or q_length != t_length")


def segment_scores(query: DataFrame, target: DataFrame) -> DataFrame:
    both = query.select(*RUN, "segment_id", F.col("seq").alias("q")).join(
        target.select(*RUN, "segment_id", F.col("seq").alias("t")), [*RUN, "segment_id"])
    return both.select(
        *RUN, "segment_id", base_id(F.col("segment_id")).alias("base_id"), F.length("q").cast("bigint").alias("mapped_length"),
        identity_count(F.col("q"), F.col("t")).alias("matched_length"))


def _union_of(blocks: Column) -> Column:
    """Positions that an array of blocks covers."""
    zero = F.lit(0).cast("bigint")
    first = F.struct(zero.alias("n"), F.array_min(F.transform(blocks, lambda x: x["start"])).alias("reach"))
    return F.aggregate(F.array_sort(blocks), first, lambda acc, x: F.struct(
        (acc["n"] + F.greatest(zero, x["end"] - F.greatest(x["start"], acc["reach"]))).alias("n"),
        F.greatest(acc["reach"], x["end"]).alias("reach")), lambda acc: acc["n"])


def _fraction_column(a: Column, b: Column) -> Column:
    """Pairwise block overlap over the smaller union, as expressions on two block arrays."""
    zero = F.lit(0).cast("bigint")
    pairwise = F.aggregate(a, zero, lambda acc, x: acc + F.aggregate(b, zero, lambda t, y: t + F.greatest(
        zero, F.least(x["end"], y["end"]) - F.greatest(x["start"], y["start"]))))
    small = F.least(_union_of(a), _union_of(b))
    return F.when(small > 0, pairwise / small).otherwise(0.0)


def _segment_rows(scores: DataFrame, blocks: DataFrame) -> DataFrame:
    """Scored segments with their span (``reach`` is one beyond the end) and blocks."""
    iv = block_intervals(F.col("start"), F.col("end"), F.col("sizes"), F.col("starts"))
    placed = blocks.select(*RUN, F.col("ids").alias("segment_id"), "start", "end", "sizes", "starts")
    rows = scores.select(*RUN, "base_id", "segment_id", "matched_length").join(placed, [*RUN, "segment_id"])
    return rows.select(*RUN, "base_id", "segment_id", "start", (F.col("end") + 1).alias("reach"), "matched_length", iv.alias("blocks"))


def _large(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of more than ``SMALL`` rows, written."""
    return materialize(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > SMALL).select(*keys))


def _gathered(rows: DataFrame, large: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One array ``m`` of the rows of each key that is not ``large``, sorted, ``segment_id`` first; keys with a null are left out."""
    rest = ["segment_id", *[c for c in rows.columns if c not in keys and c != "segment_id"]]
    return rows.dropna(subset=list(keys)).join(large, list(keys), "left_anti").groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(*rest))).alias("m"))


def _ids_differ(m: Column) -> Column:
    return F.size(F.array_distinct(F.transform(m, lambda x: x["segment_id"]))) == F.size(m)


def overlapping_pairs(scores: DataFrame, blocks: DataFrame) -> DataFrame:
    """Pairs of segments of a base id whose spans touch, in the order of their ids, with their block overlap.

    ``fraction`` is the summed pairwise block overlap over the smaller of the two unions.
    """
    return _overlaps(_segment_rows(scores, blocks))


def _overlaps(rows: DataFrame) -> DataFrame:
    keys, span = [*RUN, "base_id"], ("start", "reach")
    pairs = interval_join(rows, rows, keys, span, span).where(F.col("segment_id") < F.col("segment_id_b"))
    # guarded, as a filter on the fraction may be evaluated before the join's own conditions
    touch = (F.col("segment_id") < F.col("segment_id_b")) & (F.col("start") < F.col("reach_b")) & (F.col("start_b") < F.col("reach"))
    return pairs.select(*keys, "segment_id", "segment_id_b", "matched_length", "matched_length_b", F.when(touch, _fraction_column(F.col("blocks"), F.col("blocks_b"))).alias("fraction"))


def duplicate_segments(scores: DataFrame, blocks: DataFrame, cutoff: float = 0.5) -> DataFrame:
    """Segments dropped as duplicates of another segment of the same base id.

    Two segments whose spans touch and whose block overlap is at least ``cutoff`` of the smaller one
    are a pair; pairs are judged in the order of their ids as text, and the better matched segment stays (the
    left one on ties) unless one of the two is already gone. Ids are unique within a species and mode.
    """
    keys, m = [*RUN, "base_id"], F.col("m")
    rows, large = _segment_rows(scores, blocks), _large(scores, keys)
    fine = _ids_differ(m)
    judged = materialize(_gathered(rows, large, keys).select(
        *keys, F.when(fine, _losers(m, cutoff)).alias("lost"), F.when(~fine, m).alias("m")).where("m is not null or size(lost) > 0"))
    rest = judged.where("m is not null").select(*keys, F.inline("m"))
    if not large.isEmpty():
        rest = rest.unionByName(rows.join(large, keys, "left_semi"))
    pairs = _overlaps(rest).where(F.col("fraction") >= cutoff)
    beaten = _beaten(pairs.select(*keys, F.col("segment_id").alias("i"), F.col("segment_id_b").alias("j"), (F.col("matched_length") >= F.col("matched_length_b")).alias("keeps_i")), keys)
    return judged.select(*RUN, F.explode("lost").alias("segment_id")).unionByName(beaten)


def _losers(m: Column, cutoff: float) -> Column:
    """Ids lost in an array of segments sorted by their ids, all different: its pairs are judged one after the other."""
    def pairs_of(x: Column) -> Column:
        touching = F.filter(m, lambda y: (x["segment_id"] < y["segment_id"]) & (x["start"] < y["reach"]) & (y["start"] < x["reach"]))
        near = F.filter(touching, lambda y: _fraction_column(x["blocks"], y["blocks"]) >= cutoff)
        return F.transform(near, lambda y: F.struct(
            x["segment_id"].alias("i"), y["segment_id"].alias("j"), (x["matched_length"] >= y["matched_length"]).alias("keeps_i")))

    def judge(gone: Column, p: Column) -> Column:
        over = F.array_contains(gone, p["i"]) | F.array_contains(gone, p["j"])
        return F.when(over, gone).otherwise(F.concat(gone, F.array(F.when(p["keeps_i"], p["j"]).otherwise(p["i"]))))

    return F.aggregate(F.flatten(F.transform(m, pairs_of)), F.array().cast("array<string>"), judge)


def _beaten(pairs: DataFrame, keys: Sequence[str], trace: list[int] | None = None) -> DataFrame:
    """Losers of pairs (i, j, keeps_i) judged in the order of (i, j), by rounds.

    A pair counts unless one of its two is gone before, and only earlier pairs that the one in question loses can
    take it away. A pair without such an open pair counts. One with a single such pair counts exactly if that one does not: such
    pairs point to each other, and doubling the pointers (with the parity of the steps) finds what a chain of any
    length hangs on in a logarithmic number of joins. What is known then settles more pairs in the next round. ``trace`` receives
    the number of doublings of every round.
    """
    spark, parts = pairs.sparkSession, []
    keys = list(keys)
    open_ = materialize(pairs.select(
        F.monotonically_increasing_id().alias("pair"), *keys, "i", "j", F.struct("i", "j").alias("at"), F.when(F.col("keeps_i"), F.col("j")).otherwise(F.col("i")).alias("loser")))

    def at_ends(table: DataFrame, facts: DataFrame, *names: str) -> DataFrame:
        for end in ("i", "j"):
            table = table.join(facts.select(*keys, F.col("loser").alias(end), *[F.col(n).alias(f"{n}_{end}") for n in names]), [*keys, end], "left")
        return table

    while not open_.isEmpty():
        first = open_.groupBy(*keys, "loser").agg(F.min(F.struct("at", "pair")).alias("f")).select(*keys, "loser", F.col("f.at").alias("first"), F.col("f.pair").alias("by"))
        second = open_.join(first, [*keys, "loser"]).where(F.col("at") > F.col("first")).groupBy(*keys, "loser").agg(F.min("at").alias("second"))
        waits = at_ends(open_, first.join(second, [*keys, "loser"], "left"), "first", "second", "by")
        before = lambda n: F.coalesce(F.col(n) < F.col("at"), F.lit(False))
        waiting = sum((before(n).cast("int") for n in ("first_j", "second_i", "second_j")), before("first_i").cast("int"))
        judged = materialize(waits.select(*open_.columns, waiting.alias("waiting"), F.when(before("first_i"), F.col("by_i")).otherwise(F.col("by_j")).alias("by")))
        due = judged.where("waiting = 0")
        roots, doublings = _doubled(judged.where("waiting = 1").select("pair", F.col("by").alias("root"), F.lit(True).alias("flip")))
        known = materialize(roots.join(due.select(F.col("pair").alias("root")), "root").select("pair", (~F.col("flip")).alias("counts")).unionByName(
            due.select("pair", F.lit(True).alias("counts"))))
        if trace is not None:
            trace.append(doublings)
        lost = materialize(judged.join(known.where("counts"), "pair", "left_semi").select(*keys, "loser", F.col("at").alias("gone")))
        parts.append(lost)
        alive = lambda end: F.coalesce(F.col(f"gone_{end}") >= F.col("at"), F.lit(True))
        left = materialize(at_ends(judged.join(known, "pair", "left_anti"), lost, "gone").where(alive("i") & alive("j")).select(*open_.columns))
        for table in (open_, judged, known, roots):
            discard(table)
        open_ = left
    discard(open_)
    out = spark.createDataFrame([], pairs.select(*RUN, F.col("i").alias("segment_id")).schema)
    for part in parts:
        out = out.unionByName(part.select(*RUN, F.col("loser").alias("segment_id")))
    return out


def _doubled(links: DataFrame) -> tuple[DataFrame, int]:
    """(pair, root, flip) with every chain of links followed to its end, and the joins it took; links hold no cycle."""
    links, steps = materialize(links), 0
    while True:
        ahead = links.select(F.col("pair").alias("root"), F.col("root").alias("_next"), F.col("flip").alias("_turn"))
        moved = materialize(links.join(ahead, "root", "left").select(
            "pair", F.coalesce("_next", "root").alias("root"), (F.col("flip") != F.coalesce("_turn", F.lit(False))).alias("flip"), F.col("_next").isNotNull().alias("moved")))
        going = not moved.where("moved").isEmpty()
        discard(links)
        links = moved.drop("moved")
        links._table_path = moved._table_path
        if not going:
            return links, steps
        steps += 1


def _passed_labels(members: DataFrame, distance: int, trace: list[int] | None = None) -> DataFrame:
    """``label_id`` of each member (species, mode, base_id, strand, island, segment_id, start, end).

    Two members at most ``distance`` apart meet; the meetings of a base id happen in the order of both ids, and at each one both take
    the smaller of their labels, which start as the own ids. A meeting hangs on the last earlier one of either side,
    so its label is the smallest id among all it hangs on. In each round a meeting hears the labels of its (at most two) priors, then
    takes the prior of a prior that has only one itself, and drops a prior that another of its priors implies: chains and
    ladders shrink by half. A round in which no label falls proves them all. Chains of 20,011 members, each near one to five next ones, take
    at most 19 rounds in rising and falling ids and at most 25 in ids by a stride. ``trace`` receives the number of rounds.
    """
    base, cluster = [*RUN, "base_id"], [*RUN, "base_id", "strand", "island"]
    numbers = rank_texts(members.select(*base, "segment_id").distinct(), base, "segment_id", "no")
    placed = materialize(members.join(numbers, [*base, "segment_id"]).select(
        *cluster, "segment_id", "no", "start", (F.col("end") + distance + 1).alias("reach")))
    span = ("start", "reach")
    met = interval_join(placed, placed, cluster, span, span).where("no < no_b")
    met = materialize(met.select(*base, F.monotonically_increasing_id().alias("meeting"), F.col("no").alias("i"), F.col("no_b").alias("j")))
    side = lambda own, other: F.struct(F.col(own).alias("no"), F.col(other).alias("partner"))
    sides = met.select(*base, "meeting", F.inline(F.array(side("i", "j"), side("j", "i"))))
    # a member meets its partners in the order of their numbers, smaller and larger ones alike
    hangs = running(sides, [*base, "no"], ["partner"], position_block("partner"), {"prior": ("last", F.col("meeting"))}, exclusive=True)
    state = materialize(hangs.groupBy("meeting").agg(F.min("no").alias("label"), F.collect_list("prior").alias("priors")))
    rounds, going = 0, not state.isEmpty()
    while going:
        told = state.select(F.col("meeting").alias("from"), F.col("label").alias("heard"), F.col("priors").alias("ahead"))
        heard = state.select("meeting", F.explode("priors").alias("from")).join(told, "from").groupBy("meeting").agg(
            F.min("heard").alias("heard"), F.collect_list(F.struct("from", "ahead")).alias("m"))
        forked = lambda x: F.size(x["ahead"]) > 1
        next_ = F.flatten(F.transform("m", lambda x: F.when(forked(x), F.array(x["from"])).otherwise(x["ahead"])))
        implied = F.flatten(F.transform(F.filter("m", forked), lambda x: x["ahead"]))
        after = materialize(state.join(heard, "meeting", "left").select(
            "meeting", F.least("label", "heard").alias("label"), F.when(F.col("m").isNull(), F.col("priors")).otherwise(F.array_except(next_, implied)).alias("priors"),
            F.coalesce(F.col("heard") < F.col("label"), F.lit(False)).alias("fell")))
        going, rounds = not after.where("fell").isEmpty(), rounds + 1
        discard(state)
        state = after
    if trace is not None:
        trace.append(rounds)
    last = sides.groupBy(*base, "no").agg(F.max_by("meeting", "partner").alias("meeting"))
    label = last.join(state.select("meeting", "label"), "meeting").select(*base, "no", "label")
    own = placed.select(*base, "segment_id", "no").join(label, [*base, "no"], "left").withColumn("label", F.coalesce("label", "no"))
    names = placed.select(*base, F.col("no").alias("label"), F.col("segment_id").alias("label_id"))
    out = materialize(own.join(names, [*base, "label"]).select(*base, "segment_id", "label_id"))
    for table in (placed, met, state):
        discard(table)
    return out


def nearby_groups(kept: DataFrame, spans: DataFrame, distance: int = 100_000) -> DataFrame:
    """Group id of each kept segment: same strand and close together within a base id.

    A base id with one segment keeps its bare id, others get ``_1``, ``_2``, ... by the smallest
    member. Clusters further apart than ``distance`` or on other strands never interact, so each is
    labelled on its own; the numbering over a base id is a count of smaller labels. Segment ids are unique within a species
    and mode. Base ids of few segments whose clusters are no longer than the distance are labelled as arrays; for the others the
    work follows the pairs of near members of clusters longer than the distance.
    """
    keys, m = [*RUN, "base_id"], F.col("m")
    rows = materialize(kept.select(*keys, "segment_id").join(
        spans.select(*RUN, F.col("ids").alias("segment_id"), "start", "end", "strand"), [*RUN, "segment_id"], "left"))
    large = _large(rows, keys)
    named = _gathered(rows.withColumn("strand", F.coalesce("strand", F.lit("."))), large, keys).withColumn("l", _near_labels(m, distance))
    plain = _ids_differ(m) & F.forall("l", lambda x: x["clear"])
    order = F.array_sort(F.array_distinct(F.transform("l", lambda x: x["label_id"])))
    ids = F.transform(m, lambda x, i: F.struct(
        x["segment_id"].alias("segment_id"), F.array_position(order, F.element_at("l", i + 1)["label_id"]).alias("label_no")))
    judged = materialize(named.select(*keys, F.when(plain, ids).alias("ids"), F.when(~plain, m).alias("m")))
    few = judged.where("ids is not null").select(*keys, F.size("ids").cast("bigint").alias("members"), F.inline("ids"))
    rest = judged.where("m is not null").select(*keys, F.inline("m"))
    if not large.isEmpty():
        rest = rest.unionByName(rows.join(large, keys, "left_semi"))
    many = F.col("members") > 1
    return few.unionByName(_cluster_labels(rest, distance)).select(
        *keys, "segment_id",
        F.when(many, F.concat_ws("_", "base_id", F.col("label_no").cast("string"))).otherwise(F.col("base_id")).alias("grouped_id"),
        many.alias("modified_group"))


def _near_labels(m: Column, distance: int) -> Column:
    """Per segment of an array sorted by ids: ``label_id``, the first id among those near it, and ``clear``, whether these are all near each other.

    Where all are clear, being near is the same as being in one cluster no longer than the distance.
    """
    def label(x: Column) -> Column:
        near = F.filter(m, lambda y: (y["strand"] == x["strand"]) & (y["start"] - x["end"] <= distance) & (x["start"] - y["end"] <= distance))
        reach = F.array_max(F.transform(near, lambda y: y["start"])) - F.array_min(F.transform(near, lambda y: y["end"]))
        alone = x["start"].isNull()
        return F.struct(
            F.when(alone, x["segment_id"]).otherwise(F.try_element_at(near, F.lit(1))["segment_id"]).alias("label_id"),
            F.coalesce(alone | ((x["start"] <= x["end"]) & (reach <= distance)), F.lit(False)).alias("clear"))

    return F.transform(m, label)


def _cluster_labels(rows: DataFrame, distance: int) -> DataFrame:
    """``members`` of the base id and ``label_no`` of each segment's cluster, for base ids of any size."""
    keys = [*RUN, "base_id"]
    known = rows.where("start is not null").withColumn("strand", F.coalesce("strand", F.lit(".")))
    cluster = [*keys, "strand", "island"]
    placed = materialize(islands(known, [*keys, "strand"], gap=distance))
    extent = placed.groupBy(*cluster).agg(
        F.min("segment_id").alias("label_id"), (F.max("start") - F.min("end") <= distance).alias("compact"))
    sized = placed.join(extent, cluster)
    # all members near each other: the first one passes its label to every other at once
    compact = sized.where("compact").select(*keys, "segment_id", "label_id")
    chained = _passed_labels(sized.where("not compact").select(*cluster, "segment_id", "start", "end"), distance)
    labelled = compact.unionByName(chained)
    alone = rows.where("start is null").select(*keys, "segment_id", F.col("segment_id").alias("label_id"))
    labelled = materialize(labelled.unionByName(alone))
    sizes = labelled.groupBy(*keys).agg(F.count("*").alias("members"))
    ranks = rank_texts(labelled.select(*keys, "label_id").distinct(), keys, "label_id", "label_no")
    return labelled.join(ranks, [*keys, "label_id"]).join(sizes, keys).select(*keys, "members", "segment_id", "label_no")


def rank_texts(df: DataFrame, keys: Sequence[str], text: str, name: str) -> DataFrame:
    """1-based rank of distinct texts within the keys: places in one sort by range, counted from each key's first."""
    keys = list(keys)
    placed = with_rank(df.select(*keys, text).orderBy(*keys, text), "_place")
    first = placed.groupBy(*keys).agg(F.min("_place").alias("_first"))
    return placed.join(first, keys).select(*keys, text, (F.col("_place") - F.col("_first") + 1).alias(name))


def aggregate_groups(scores: DataFrame, groups: DataFrame, blocks: DataFrame, exons: DataFrame) -> DataFrame:
    """Statistics per group of segments: sums, covered length, covered exons, representative.

    ``blocks`` are segment blocks and ``exons`` transcript blocks (ids, start, end, sizes, starts).
    """
    keys = [*RUN, "grouped_id"]
    rows = scores.join(groups.select(*RUN, "segment_id", "grouped_id", "modified_group"), [*RUN, "segment_id"])
    totals = rows.groupBy(*keys).agg(
        F.first("base_id").alias("ids"), F.first("modified_group").alias("modified_group"),
        F.min_by("segment_id", F.struct(-F.col("matched_length"), F.col("segment_id"))).alias("segment_id"),
        F.sum("mapped_length").alias("mapped_length"), F.sum("matched_length").alias("matched_length"))
    wide = _large_groups(scores, groups, rows, keys)
    few = rows if wide is None else rows.join(wide, keys, "left_anti")
    found = _covered(few, blocks, exons, keys)
    if wide is not None:
        found = found.unionByName(_covered_of_large(rows.join(wide, keys, "left_semi"), blocks, exons, keys))
    out = totals.join(found, keys, "left").fillna(0, subset=["true_mapped_length", "exon_covered_num", "exon_counts"]).fillna("", subset=["exon_covered"])
    return out.withColumns({
        "match_ratio": safe_ratio(F.col("matched_length"), F.col("mapped_length")),
        "exon_covered_ratio": safe_ratio(F.col("exon_covered_num"), F.col("exon_counts"))})


def _large_groups(scores: DataFrame, groups: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """Groups of many segments, or with a segment of a base id that has many; none in most tables."""
    base = [*RUN, "base_id"]
    many, hot = _large(groups.select(*keys), keys), _large(scores.select(*base), base)
    if not hot.isEmpty():
        many = materialize(many.unionByName(rows.join(hot, base, "left_semi").select(*keys).distinct()).distinct())
    return None if many.isEmpty() else many


def _covered(rows: DataFrame, blocks: DataFrame, exons: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Covered length and exons per group, whose blocks are gathered as arrays; one exchange by base id serves the gathering and the exons."""
    base, b = [*RUN, "base_id"], F.col("b")
    iv = block_intervals(F.col("start"), F.col("end"), F.col("sizes"), F.col("starts"))
    placed = rows.select(*keys, "base_id", "segment_id").join(
        blocks.select(*RUN, F.col("ids").alias("segment_id"), "start", "end", "sizes", "starts"), [*RUN, "segment_id"])
    whole = F.filter(F.flatten(F.collect_list("b")), lambda x: x["start"].isNotNull() & x["end"].isNotNull())
    gathered = placed.select(*keys, "base_id", iv.alias("b")).where("size(b) > 0").repartition(*base).groupBy(*keys, "base_id").agg(whole.alias("b"))
    ex = exons.select(*RUN, F.col("ids").alias("base_id"), iv.alias("e"))
    met = F.filter(F.transform("e", lambda x, i: F.struct((i + 1).alias("no"), x["start"].alias("start"), x["end"].alias("end"))), lambda x: F.exists(
        b, lambda y: (x["start"] < y["end"]) & (y["start"] < x["end"])))
    met = F.coalesce(F.transform(met, lambda x: x["no"]), F.array().cast("array<int>"))
    per_base = gathered.join(ex, base, "left").select(*keys, "b", met.alias("met"), F.when(F.size("e") > 0, F.size("e")).alias("n"))
    per = per_base.groupBy(*keys).agg(
        F.flatten(F.collect_list("b")).alias("b"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("met")))).alias("met"), F.max("n").cast("bigint").alias("exon_counts"))
    return per.select(
        *keys, _union_of(b).alias("true_mapped_length"), F.array_join("met", ",").alias("exon_covered"), F.size("met").cast("bigint").alias("exon_covered_num"), "exon_counts")


def _covered_of_large(rows: DataFrame, blocks: DataFrame, exons: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same for groups of any size, by joins that spread a group."""
    iv = block_intervals(F.col("start"), F.col("end"), F.col("sizes"), F.col("starts"))
    parts = rows.select(*keys, "base_id", "segment_id").join(
        blocks.select(*RUN, F.col("ids").alias("segment_id"), F.explode(iv).alias("b")), [*RUN, "segment_id"]
    ).select(*keys, "base_id", "b.start", "b.end")
    length = union_length(parts, keys, "true_mapped_length")
    ex = exons.select(*RUN, F.col("ids").alias("base_id"), F.posexplode(iv).alias("i", "b"), F.size(iv).alias("exon_counts")).select(
        *RUN, "base_id", (F.col("i") + 1).alias("exon_no"), "b.start", "b.end", "exon_counts")
    covered = interval_join(ex, parts, on=[*RUN, "base_id"]).select(*keys, "exon_no").distinct().groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_list("exon_no")), ",").alias("exon_covered"), F.count("*").alias("exon_covered_num"))
    have_blocks = parts.select(*keys, "base_id").distinct()
    counts = have_blocks.join(ex.groupBy(*RUN, "base_id").agg(F.max("exon_counts").alias("exon_counts")), [*RUN, "base_id"]).groupBy(*keys).agg(
        F.max("exon_counts").cast("bigint").alias("exon_counts"))
    return parts.select(*keys).distinct().join(length, keys, "left").join(covered, keys, "left").join(counts, keys, "left").select(
        *keys, "true_mapped_length", "exon_covered", "exon_covered_num", "exon_counts")


def enrich(rows: DataFrame, table: DataFrame, key: str | Sequence[str], order: str = "ord") -> DataFrame:
    """Left lookup by key: the last table row of a key wins, blank keys never match.

    Table columns that exist already come in as ``context_<name>``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    values = [c for c in table.columns if c not in keys and c != order]
    last = table.where(" and ".join(f"`{k}` != ''" for k in keys)).groupBy(*keys).agg(
        F.max_by(F.struct(*values), order).alias("_r"))
    renamed = {c: (f"context_{c}" if c in rows.columns else c) for c in values}
    spread = [c for c, t in rows.dtypes if c not in keys and not t.startswith("map")]
    return left_lookup(rows, last, keys, spread, blanks=True).select(*[F.col(f"`{c}`") for c in rows.columns], *[F.col(f"_r.`{c}`").alias(n) for c, n in renamed.items()])


def cds_metrics(rows: DataFrame, query: DataFrame, target: DataFrame, cds: DataFrame) -> DataFrame:
    """Identity inside the coding window of the representative segment.

    ``cds``: ids, cds_start, cds_end (1-based closed); the segment's own line is preferred to the
    transcript's. ``ids`` may name segments or transcripts.
    """
    own = cds.select(*RUN, F.col("ids").alias("segment_id"), F.struct("cds_start", "cds_end").alias("_a"))
    tx = cds.select(*RUN, "ids", F.struct("cds_start", "cds_end").alias("_b"))
    q = query.select(*RUN, "segment_id", F.col("seq").alias("_q"))
    t = target.select(*RUN, "segment_id", F.col("seq").alias("_t"))
    x = (
        rows.join(own, [*RUN, "segment_id"], "left").join(tx, [*RUN, "ids"], "left")
        .join(q, [*RUN, "segment_id"], "left").join(t, [*RUN, "segment_id"], "left")
        .withColumn("_w", F.coalesce("_a", "_b")))
    start, end = F.coalesce(F.col("_w.cds_start"), F.lit(1)) - 1, F.coalesce(F.col("_w.cds_end"), F.lit(0))
    usable = F.col("_w").isNotNull() & (end > start) & (F.length("_q") > 0) & (F.length("_t") > 0)

    def cut(c: str) -> Column:
        return F.substring(F.col(c), (start + 1).cast("int"), (end - start).cast("int"))

    matched = F.when(usable, identity_count(cut("_q"), cut("_t")))
    mapped = F.when(usable, F.least(F.length(cut("_q")), F.length(cut("_t"))).cast("bigint"))
    return x.select(*[F.col(c) for c in rows.columns], mapped.alias("cds_mapped_length"), matched.alias("cds_matched_length"),
                    safe_ratio(matched, mapped).alias("cds_match_ratio"))


def classify(rows: DataFrame, min_mapped: float = 50, min_coverage: float = 0.2, min_intron: float = 0.0) -> DataFrame:
    """Threshold flags; coverage is recomputed when it is missing or zero, intron coverage only counts when present."""
    def num(name: str, default: float | None = 0.0) -> Column:
        if name not in rows.columns:
            return F.lit(default).cast("double")
        return to_float_lenient(F.col(name).cast("string"), default)

    stated = F.coalesce(F.nullif(F.col("true_mapped_length").cast("string"), F.lit("")), F.col("mapped_length").cast("string"))
    mapped = to_float_lenient(stated)
    length, given, intron = num("transcript_length"), num("transcript_coverage"), num("intron_coverage", None)
    coverage = F.when((given == 0) & (length != 0), mapped / length).otherwise(given)
    out = rows.withColumn("transcript_coverage", coverage).withColumns({
        "pass_length_filter": mapped >= min_mapped,
        "pass_transcript_coverage_filter": F.col("transcript_coverage") >= min_coverage,
        "pass_intron_coverage_filter": intron.isNull() | (intron >= min_intron)})
    return out.withColumn("is_conserved", F.expr(
        "pass_length_filter and pass_transcript_coverage_filter and pass_intron_coverage_filter"))


def homology_evidence(rows: DataFrame) -> DataFrame:
    """Conserved rows as gene pairs; ids fall back along the columns that are present."""
    def first(*names: str) -> Column:
        have = [F.nullif(F.col(n).cast("string"), F.lit("")) for n in names if n in rows.columns]
        return F.coalesce(*have, F.lit(""))

    return rows.where("is_conserved").select(
        first("geneID", "gene_id", "ids").alias("human_gene_id"), F.col("ids").alias("human_transcript_id"),
        F.col("species").alias("target_species"),
        first("target_gene_id", "target_geneID", "target_gene", "gene_id_target", "target_extra_gene_id",
              "target_transcript_id", "target_ids").alias("target_gene_id"),
        first("target_transcript_id", "target_ids").alias("target_transcript_id"),
        "true_mapped_length", "match_ratio", "transcript_coverage", "exon_covered_ratio", F.col("grouped_id").alias("evidence_group"))


def best_homologs(evidence: DataFrame) -> DataFrame:
    """Best row per (gene, species, target gene) and its support; ties go to the first evidence group."""
    keys = ["human_gene_id", "target_species", "target_gene_id"]
    zero = F.lit(0.0)
    scores = [-F.coalesce(F.col(c).cast("double"), zero) for c in (
        "true_mapped_length", "match_ratio", "transcript_coverage", "exon_covered_ratio")]
    rest = [c for c in evidence.columns if c not in keys]
    best = evidence.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*scores, F.col("evidence_group"))).alias("_r"), F.count("*").alias("supporting_segment_count"))
    tx = evidence.select(*keys, "human_transcript_id").distinct().groupBy(*keys).agg(F.count("*").alias("supporting_transcript_count"))
    return best.join(tx, keys).select(*keys, "_r.*", "supporting_transcript_count", "supporting_segment_count")


def synteny(homologs: DataFrame, anchors: DataFrame | None) -> DataFrame:
    """``1``/``0`` by membership in the anchor table, blank without one."""
    if anchors is None:
        return homologs.withColumn("syntenic_support", F.lit(""))

    def pick(*names: str) -> Column:
        return F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in names if n in anchors.columns])

    keys = ["human_gene_id", "target_species", "target_gene_id"]
    a = anchors.select(
        pick("human_gene_id", "human_gene").alias(keys[0]), pick("target_species", "species").alias(keys[1]),
        pick("target_gene_id", "target_gene").alias(keys[2])).dropna().distinct().withColumn("_hit", F.lit("1"))
    return homologs.join(a, keys, "left").withColumn("syntenic_support", F.coalesce("_hit", F.lit("0"))).drop("_hit")


def gene_age(homologs: DataFrame, species_order: DataFrame) -> DataFrame:
    """Oldest species per gene and its support.

    Rows of a gene are read by (species, target gene); each strictly older species starts the
    support anew, so it counts rows from the first one of the lowest rank on.
    ``species_order``: ord, species, rank, clade.
    """
    order = species_order.groupBy("species").agg(F.max_by(F.struct("rank", "clade"), "ord").alias("o"))
    rows = homologs.where("human_gene_id != '' and target_species != ''").join(
        order, homologs.target_species == order.species, "left").select(
        "human_gene_id", "target_species", "target_gene_id", "human_transcript_id",
        F.coalesce(F.col("o.rank").cast("bigint"), F.lit(10**9)).alias("rank"), F.coalesce("o.clade", "target_species").alias("clade"))
    place = F.struct("target_species", "target_gene_id")
    first = rows.groupBy("human_gene_id").agg(F.min(F.struct("rank", "target_species", "target_gene_id", "clade")).alias("f"))
    since = rows.join(first, "human_gene_id").where(place >= F.struct("f.target_species", "f.target_gene_id"))

    def distinct_list(name: str, out: str) -> DataFrame:
        return since.where(F.col(name) != "").select("human_gene_id", name).distinct().groupBy("human_gene_id").agg(
            F.array_join(F.array_sort(F.collect_list(name)), ",").alias(out))

    species = since.select("human_gene_id", "target_species").distinct().groupBy("human_gene_id").agg(F.count("*").alias("species_count"))
    return (
        first.select("human_gene_id", F.col("f.target_species").alias("oldest_detected_species"), F.col("f.clade").alias("oldest_detected_clade"))
        .join(species, "human_gene_id")
        .join(distinct_list("target_gene_id", "supporting_target_genes"), "human_gene_id", "left")
        .join(distinct_list("human_transcript_id", "supporting_transcripts"), "human_gene_id", "left")
        .fillna("", subset=["supporting_target_genes", "supporting_transcripts"]))


def parse_species_order(table: DataFrame) -> DataFrame:
    """Header table of species with rank and clade under their alternative names.

    ``table`` carries ``ord``; a rank that is no number falls back to the row's place.
    """
    from locusframe.functions.values import first_nonblank, to_int
    from locusframe.sources.lines import ord_block

    def pick(*names: str) -> list[Column]:
        return [F.col(n) for n in names if n in table.columns]

    placed = running(table, [], ["ord"], ord_block(), {"_idx": ("sum", F.lit(1).cast("bigint"))}, exclusive=True)
    return placed.select(
        "ord", first_nonblank(*pick("species", "target_species"), default="").alias("species"),
        F.coalesce(to_int(first_nonblank(*pick("rank", "age_rank"), default="")), F.col("_idx")).alias("rank"),
        F.coalesce(*[F.nullif(c, F.lit("")) for c in pick("clade", "age", "species", "target_species")], F.lit("")).alias("clade")
    ).where("species != ''")


def qc(scores: DataFrame, drops: DataFrame, grouped: DataFrame) -> DataFrame:
    """Segments in, dropped, kept and groups out per species and mode."""
    seen = scores.groupBy(*RUN).agg(F.count("*").alias("segments_input"))
    gone = drops.groupBy(*RUN).agg(F.count("*").alias("segments_dropped"))
    out = grouped.select(*RUN, "grouped_id").distinct().groupBy(*RUN).agg(F.count("*").alias("groups_output"))
    return seen.join(gone, RUN, "left").join(out, RUN, "left").fillna(0).select(
        *RUN, "segments_input", "segments_dropped", (F.col("segments_input") - F.col("segments_dropped")).alias("segments_kept"), "groups_output")
