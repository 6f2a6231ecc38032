"""Interval joins and interval algebra over 0-based half-open ``start``/``end`` columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.operators.ordered import position_block, running

# Positions (or bins) that one row of a cut run holds at most.
RUN_BLOCK = 1 << 16
# Bin sizes 2**14 and 2**20; an interval uses the finest one on which it spans at most 2**FAN_OUT + 1 bins.
BIN_CLASSES = (14, 20)
FAN_OUT = 6


def _class_of(start: Column, end: Column, classes: Sequence[int]) -> Column:
    out = F.lit(classes[-1])
    for c in reversed(classes[:-1]):
        out = F.when(end - start <= (1 << (c + FAN_OUT)), F.lit(c)).otherwise(out)
    return out


def _with_bins(df: DataFrame, level: Column, start: str, end: str) -> DataFrame:
    bins = F.expr(f"sequence(shiftright({start}, _lv), shiftright(greatest({end} - 1, {start}), _lv))")
    return df.withColumn("_lv", level).withColumn("_bin", F.explode(bins))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] = ("chrom",),
    left_span: tuple[str, str] = ("start", "end"),
    right_span: tuple[str, str] = ("start", "end"),
    short_side: str | None = None,
    classes: Sequence[int] = BIN_CLASSES,
    suffix: str = "_b",
) -> DataFrame:
    """Inner join of overlapping intervals, one row per overlapping pair.

    Each interval is assigned the bin size that fits its length, so no row is copied more than
    a fixed number of times. A pair meets at the coarser of its two bin sizes: the left rows at
    their own size against the right rows of that size or finer, and the right rows at their own
    size against strictly finer left rows. It is kept only in the bin of the later start, which
    makes a ``distinct`` needless. ``short_side='right'`` (variants, CpG sites, reads) treats every
    right row as finest, which drops the second join; the result is the same for any lengths.

    Which join Spark runs is left to its size checks: a side under the broadcast threshold is
    broadcast, otherwise (key, bin) is shuffled and AQE splits hot bins.

    Right columns whose names collide get ``suffix``; the key columns appear once.
    """
    on = list(on)
    taken = set(left.columns)
    rename = {c: (c + suffix if c in taken else c) for c in right.columns if c not in on}
    right = right.select(*on, *[F.col(c).alias(n) for c, n in rename.items()])
    ls, le = left_span
    rs, re_ = rename[right_span[0]], rename[right_span[1]]
    keep = [*left.columns, *rename.values()]

    overlap = (F.col(ls) < F.col(re_)) & (F.col(rs) < F.col(le))
    home = F.expr(f"_bin = shiftright(greatest({ls}, {rs}), _lv)")
    keys = [*on, "_lv", "_bin"]
    levels = F.array(*[F.lit(c) for c in classes])

    l_class = _class_of(F.col(ls), F.col(le), classes)
    r_class = F.lit(classes[0]) if short_side == "right" else _class_of(F.col(rs), F.col(re_), classes)

    def at_levels(df: DataFrame, own: Column, s: str, e: str, strict: bool) -> DataFrame:
        wanted = F.filter(levels, lambda c: (c > own) if strict else (c >= own))
        return _with_bins(df, F.explode(wanted), s, e)

    first = (
        _with_bins(left, l_class, ls, le)
        .join(at_levels(right, r_class, rs, re_, strict=False), keys)
        .where(overlap & home)
        .select(*keep)
    )
    if short_side == "right" or len(classes) == 1:
        return first
    second = (
        at_levels(left.where(l_class < classes[-1]), l_class, ls, le, strict=True)
        .join(_with_bins(right.where(r_class > classes[0]), r_class, rs, re_), keys)
        .where(overlap & home)
        .select(*keep)
    )
    return first.unionByName(second)


def cut_runs(df: DataFrame, start: str = "start", end: str = "end", block: int = RUN_BLOCK) -> DataFrame:
    """Runs of positions cut at the multiples of ``block``, so that no later array is longer than a block; empty runs have no parts."""
    cut = df.where(F.col(start) < F.col(end)).withColumn("_cut", F.explode(F.expr(f"sequence(`{start}` div {block}, (`{end}` - 1) div {block})")))
    return cut.withColumns({
        start: F.greatest(F.col(start), F.col("_cut") * block), end: F.least(F.col(end), (F.col("_cut") + 1) * block)}).drop("_cut")


def places(df: DataFrame, name: str, start: str = "start", end: str = "end", block: int = RUN_BLOCK) -> DataFrame:
    """One row per place ``start <= name < end`` in place of the two columns; long runs are cut first."""
    cut = cut_runs(df, start, end, block)
    return cut.withColumn(name, F.explode(F.expr(f"sequence(`{start}`, `{end}` - 1)"))).drop(start, end)


def overlap_length(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return F.greatest(F.lit(0).cast("bigint"), F.least(e1, e2) - F.greatest(s1, s2))


def _densest_end(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Farthest end per (keys, start): pre-aggregation that leaves the union unchanged."""
    return df.groupBy(*keys, "start").agg(F.max("end").alias("end"))


def with_previous_reach(df: DataFrame, keys: Sequence[str], shift: int = 16) -> DataFrame:
    """Per (keys, start): ``end`` and ``reach``, the farthest end of all earlier starts."""
    return running(
        _densest_end(df, keys), list(keys), ["start"], position_block("start", shift),
        {"reach": ("max", F.col("end"))}, exclusive=True,
    )


def union_length(df: DataFrame, keys: Sequence[str] = ("chrom",), name: str = "union_length") -> DataFrame:
    """Number of positions covered by at least one interval, per key."""
    fresh = F.col("end") - F.greatest(F.col("start"), F.coalesce(F.col("reach"), F.col("start")))
    return (
        with_previous_reach(df, keys)
        .groupBy(*keys)
        .agg(F.sum(F.greatest(fresh, F.lit(0).cast("bigint"))).alias(name))
    )


def merge_intervals(df: DataFrame, keys: Sequence[str] = ("chrom",)) -> DataFrame:
    """Union of intervals as disjoint intervals; touching ones are merged."""
    isl = islands(_densest_end(df, keys), keys)
    return isl.groupBy(*keys, F.col("island").alias("start")).agg(F.max("end").alias("end"))


def islands(df: DataFrame, keys: Sequence[str], gap: int = 0) -> DataFrame:
    """Append ``island``: the smallest start of the chain of intervals at most ``gap`` apart."""
    reach = with_previous_reach(df, keys)
    marks = reach.withColumn(
        "_first", F.when(F.col("reach").isNull() | (F.col("start") > F.col("reach") + gap), F.col("start"))
    )
    marked = running(
        marks, list(keys), ["start"], position_block("start"), {"island": ("max", F.col("_first"))}
    ).select(*keys, "start", "island")
    return df.join(marked, [*keys, "start"])


def coverage_depth(df: DataFrame, keys: Sequence[str] = ("chrom",), scale: float | None = None) -> DataFrame:
    """Depth of coverage as disjoint segments (zero depth left out), equal neighbours merged."""
    up = df.select(*keys, F.col("start").alias("pos"), F.lit(1).alias("delta"))
    down = df.select(*keys, F.col("end").alias("pos"), F.lit(-1).alias("delta"))
    steps = (
        up.unionByName(down).groupBy(*keys, "pos").agg(F.sum("delta").alias("delta")).where("delta != 0")
    )
    seg = running(
        steps, list(keys), ["pos"], position_block("pos"),
        {"start": ("last", F.col("pos")), "depth": ("sum", F.col("delta"))}, exclusive=True,
    ).where("depth > 0")
    depth = F.col("depth") if scale is None else F.col("depth") * F.lit(float(scale))
    return seg.select(*keys, "start", F.col("pos").alias("end"), depth.alias("depth"))


def base_depth(df: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """Depth per covered base (1-based ``pos``), optionally only inside ``regions``."""
    seg = coverage_depth(df)
    if regions is not None:
        part = merge_intervals(regions.select("chrom", "start", "end"))
        seg = interval_join(seg, part).select(
            "chrom", F.greatest("start", "start_b").alias("start"), F.least("end", "end_b").alias("end"), "depth"
        )
    return places(seg, "_at").select("chrom", (F.col("_at") + 1).alias("pos"), "depth")


def disjoint_segments(df: DataFrame, keys: Sequence[str] = ("chrom",)) -> DataFrame:
    """Segments between neighbouring interval boundaries."""
    points = (
        df.select(*keys, F.explode(F.array("start", "end")).alias("pos")).groupBy(*keys, "pos").agg(F.count("*").alias("_n"))
    )
    seg = running(
        points, list(keys), ["pos"], position_block("pos"), {"start": ("last", F.col("pos"))}, exclusive=True
    ).where("start is not null")
    return seg.select(*keys, "start", F.col("pos").alias("end"))


def union_tracks(tracks: DataFrame, names: Sequence[str], fill: float = 0.0) -> DataFrame:
    """Disjoint segments over all bedGraph tracks with one value column per track.

    ``tracks``: track, chrom, start, end, value; intervals of one track must not overlap.
    """
    tracks = tracks.where(F.col("track").isin(*names))
    seg = disjoint_segments(tracks)
    hits = interval_join(seg, tracks)
    wide = hits.groupBy("chrom", "start", "end").pivot("track", list(names)).agg(F.first("value"))
    return wide.fillna(fill, subset=list(names))


def compare_tracks(tracks: DataFrame, first: str, second: str, operation: str = "log2", pseudocount: float = 1.0) -> DataFrame:
    """Two tracks per segment: log2 ratio, ratio, difference, sum, mean or reciprocal ratio."""
    wide = union_tracks(tracks, [first, second])
    a, b = F.col(first), F.col(second)
    ratio = (a + pseudocount) / (b + pseudocount)
    value = {
        "log2": F.log2(ratio),
        "ratio": ratio,
        "subtract": a - b,
        "add": a + b,
        "mean": (a + b) / 2,
        "reciprocal_ratio": F.when(ratio >= 1, ratio).otherwise(-1 / ratio),
    }[operation]
    return wide.select("chrom", "start", "end", value.alias("value"))


def binned_coverage(df: DataFrame, bin_size: int, scale: float = 1.0, keys: Sequence[str] = ("chrom",)) -> DataFrame:
    """Number of intervals overlapping each fixed bin, times ``scale``; empty bins are left out.

    A long interval is not copied into every bin: bins between two changes of the count share one run.
    """
    up = df.select(*keys, F.expr(f"start div {bin_size}").alias("pos"), F.lit(1).alias("delta"))
    down = df.select(*keys, F.expr(f"(end - 1) div {bin_size} + 1").alias("pos"), F.lit(-1).alias("delta"))
    steps = up.unionByName(down).groupBy(*keys, "pos").agg(F.sum("delta").alias("delta")).where("delta != 0")
    runs = running(
        steps, list(keys), ["pos"], position_block("pos", 12),
        {"from": ("last", F.col("pos")), "n": ("sum", F.col("delta"))}, exclusive=True,
    ).where("n > 0")
    one = places(runs.select(*keys, "from", "pos", "n"), "bin", "from", "pos")
    return one.select(
        *keys,
        (F.col("bin") * bin_size).alias("start"),
        ((F.col("bin") + 1) * bin_size).alias("end"),
        (F.col("n") * F.lit(float(scale))).alias("value"),
    )


def binned_mean(tracks: DataFrame, bin_size: int) -> DataFrame:
    """Length-weighted mean of each track per fixed bin (``track``, chrom, start, end, value); empty intervals weigh nothing."""
    spans = tracks.where("start < end").withColumns({"_from": F.expr(f"start div {bin_size}"), "_to": F.expr(f"(end - 1) div {bin_size} + 1")})
    split = places(spans, "bin", "_from", "_to")
    lo, hi = F.col("bin") * bin_size, (F.col("bin") + 1) * bin_size
    share = overlap_length(F.col("start"), F.col("end"), lo, hi)
    return (
        split.select("track", "chrom", "bin", share.alias("w"), "value")
        .groupBy("track", "chrom", "bin")
        .agg((F.sum(F.col("w") * F.col("value")) / F.sum("w")).alias("value"))
        .select("track", "chrom", (F.col("bin") * bin_size).alias("start"), ((F.col("bin") + 1) * bin_size).alias("end"), "value")
    )


def tracks_matrix(tracks: DataFrame, bin_size: int, names: Sequence[str]) -> DataFrame:
    """Bins by tracks: mean value per bin, one column per track."""
    return binned_mean(tracks, bin_size).groupBy("chrom", "start", "end").pivot("track", list(names)).agg(F.first("value"))


def clip_to_sizes(df: DataFrame, sizes: DataFrame, truncate: bool = False) -> DataFrame:
    """Drop intervals beyond the contig end, or cut them there; unknown contigs are dropped."""
    joined = df.join(sizes.select("chrom", F.col("size").alias("_size")), "chrom")
    if truncate:
        joined = joined.withColumn("end", F.least("end", "_size")).where("start < end")
    else:
        joined = joined.where("end <= _size")
    return joined.where("start >= 0").select(*df.columns)


def region_coverage(regions: DataFrame, reads: DataFrame) -> DataFrame:
    """Read count and summed overlap length per region; untouched regions get zeros."""
    slim = reads.groupBy("chrom", "start", "end").agg(F.count("*").alias("_n"))
    hits = interval_join(regions.select("chrom", "start", "end").distinct(), slim)
    length = overlap_length(F.col("start"), F.col("end"), F.col("start_b"), F.col("end_b"))
    sums = hits.groupBy("chrom", "start", "end").agg(
        F.sum("_n").alias("n_reads"), F.sum(length * F.col("_n")).alias("n_bases")
    )
    return regions.join(sums, ["chrom", "start", "end"], "left").fillna(0, subset=["n_reads", "n_bases"])


def sort_intervals(df: DataFrame, *more: str, order: Sequence[str] | None = None) -> DataFrame:
    """Sort by contig, start, end; ``order`` lists contigs explicitly (others follow by name)."""
    if order:
        ranks = F.create_map(*[x for i, c in enumerate(order) for x in (F.lit(c), F.lit(i))])
        first = [F.coalesce(ranks[F.col("chrom")], F.lit(len(order))), F.col("chrom")]
    else:
        first = [F.col("chrom")]
    return df.orderBy(*first, "start", "end", *more)
