"""Profiles of images and videos, their distributions, and frame selection."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.functions.text import python_round
from tarn.operators.ordinal import ordinal, running_total
from tarn.operators.skew import join_facts, null_safe
from tarn.session import checkpoint_root

# Pixel mode -> channels.
CHANNELS_OF_MODE = {"RGB": 3, "RGBA": 4, "L": 1, "CMYK": 4}

# PNG colour type -> pixel mode, for 8-bit samples.
PNG_MODES = {0: "L", 2: "RGB", 3: "P", 4: "LA", 6: "RGBA"}

# Defaults.
BINS = 50
TARGET_FPS = 30
MAX_FRAMES = 16
# Videos whose frame counts (two short columns) may be broadcast.
FEW_VIDEOS = 500_000


def _lookup(column: Column, table: dict) -> Column:
    pairs = [F.lit(part) for pair in table.items() for part in pair]
    return F.create_map(*pairs)[column]


def _aspect(width: Column, height: Column) -> Column:
    return F.when(height > 0, python_round(width / F.nullif(height, F.lit(0))))


def image_profile(objects: DataFrame) -> DataFrame:
    """Profile of PNG objects ``(key, size, content)``, read from the header without decoding.

    Bodies that are no PNG give NULL columns.
    """
    head = F.hex(F.substring("content", 1, 29))

    def number(first_byte: int, size: int) -> Column:
        digits = F.substring(head, 2 * first_byte - 1, 2 * size)
        return F.when(F.length(digits) == 2 * size, F.conv(digits, 16, 10).cast("int"))

    is_png = F.startswith(head, F.lit("89504E470D0A1A0A0000000D49484452"))
    depth = number(25, 1)
    mode = F.when(depth == 8, _lookup(number(26, 1), PNG_MODES)).when(depth == 1, "1").when(
        depth == 16, _lookup(number(26, 1), {**PNG_MODES, 0: "I;16"})
    )
    found = objects.select(
        F.col("key").alias("file_name"),
        (F.col("size") / 1024).alias("file_size"),
        F.when(is_png, number(17, 4)).alias("width"),
        F.when(is_png, number(21, 4)).alias("height"),
        F.when(is_png, mode).alias("mode"),
    )
    return _with_derived(found, _lookup(F.col("mode"), CHANNELS_OF_MODE))


def _with_derived(found: DataFrame, channels: Column) -> DataFrame:
    return found.select(
        "file_name",
        "file_size",
        "width",
        "height",
        _aspect(F.col("width"), F.col("height")).alias("aspect_ratio"),
        "mode",
        channels.alias("channels"),
    )


def media_profile(meta: DataFrame, kind: str = "image") -> DataFrame:
    """Profile columns of decoded metadata.

    Images come with ``(key, size, width, height, mode)``; videos with ``(key, size, width, height,
    n_channels)``, where NULL channels mean that no frame could be read.
    """
    base = [
        F.col("key").alias("file_name"),
        (F.col("size") / 1024).alias("file_size"),
        F.col("width"),
        F.col("height"),
    ]
    if kind == "image":
        return _with_derived(
            meta.select(*base, "mode"), _lookup(F.col("mode"), CHANNELS_OF_MODE)
        )
    channels = F.col("n_channels")
    mode = F.when(channels.isNull(), "N/A").when(channels == 3, "BGR").otherwise("GRAY")
    return _with_derived(
        meta.select(*base, mode.alias("mode"), channels), F.coalesce(channels, F.lit(0))
    )


def _long_form(df: DataFrame, columns: Iterable[str], kind: str) -> DataFrame:
    cells = F.array(
        *(F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in columns)
    )
    return df.select(F.inline(cells)).filter(F.col("value").isNotNull())


def quantiles(df: DataFrame, columns: Sequence[str], levels: Sequence[float]) -> DataFrame:
    """Exact interpolated quantiles ``(column, level, value)`` of numeric columns.

    Equal values are counted first; the distinct values are then ranked by a distributed running
    total, so neither a repeated nor a wide-ranging column ends up in one task. Only the two
    neighbours of each level are kept.
    """
    counted = _long_form(df, columns, "double").groupBy("column", "value").agg(
        F.count("*").alias("n")
    )
    ranked = running_total(counted, ["column", "value"], "n", "before")
    spans = ranked.groupBy("column").agg(
        F.min("before").alias("first"), F.sum("n").alias("total")
    )
    wanted = F.explode(F.array(*(F.lit(float(level)) for level in levels)))
    # One row per column and level, a few at most.
    targets = spans.select("*", wanted.alias("level")).withColumn(
        "at", (F.col("total") - 1) * F.col("level")
    )
    start = F.col("before") - F.col("first")
    low, high = F.floor("at"), F.ceil("at")
    near = ranked.join(F.broadcast(targets), "column").filter(
        ((start <= low) & (low < start + F.col("n"))) | ((start <= high) & (high < start + F.col("n")))
    )
    picked = near.groupBy("column", "level").agg(
        F.min("value").alias("lower"), F.max("value").alias("upper"), F.first("at").alias("at")
    )
    fraction = F.col("at") - F.floor("at")
    return picked.select(
        "column",
        "level",
        (F.col("lower") + (F.col("upper") - F.col("lower")) * fraction).alias("value"),
    )


def describe_all(df: DataFrame, texts: Sequence[str] = (), numbers: Sequence[str] = ()) -> DataFrame:
    """Long-form summary ``(column, stat, value, number)``: values as text, and as doubles where they are numbers.

    Strings: count, unique, top (the smallest on a tie), freq. Numbers: count, mean, std, min,
    quartiles, max; as text with six decimals where the number has no more, else with all its digits.
    """
    parts = []
    if texts:
        counted = _long_form(df, texts, "string").groupBy("column", "value").agg(
            F.count("*").alias("n")
        )
        best = counted.groupBy("column").agg(
            F.sum("n").alias("count"),
            F.count("*").alias("unique"),
            F.max("n").alias("freq"),
        )
        # Ties for the top are settled by a second small aggregation over the most frequent values.
        top = (
            counted.join(F.broadcast(best.select("column", "freq")), "column")
            .filter(F.col("n") == F.col("freq"))
            .groupBy("column")
            .agg(F.min("value").alias("top"))
        )
        wide = best.join(top, "column")
        parts.append(_stats(wide, ("count", "unique", "top", "freq")))
    if numbers:
        aggregated = _long_form(df, numbers, "double").groupBy("column").agg(
            F.count("value").alias("count"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
        parts.append(_stats(aggregated, ("count", "mean", "std", "min", "max"), numbers=True))
        quartile = F.concat(F.round(F.col("level") * 100).cast("int").cast("string"), F.lit("%"))
        parts.append(
            quantiles(df, numbers, (0.25, 0.5, 0.75)).select(
                "column", quartile.alias("stat"), _written(F.col("value")).alias("value"), F.col("value").cast("double").alias("number")
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _written(value: Column) -> Column:
    number = value.cast("double")
    short = F.format_string("%.6f", number)
    return F.when(value.isNull(), None).when(short.cast("double") == number, short).otherwise(number.cast("string"))


def _stats(wide: DataFrame, names: Sequence[str], numbers: bool = False) -> DataFrame:
    text = lambda name: _written(F.col(name)) if numbers else F.col(name).cast("string")
    number = lambda name: F.lit(None).cast("double") if name == "top" else F.col(name).cast("double")
    cells = F.array(*(F.struct(F.lit(n).alias("stat"), text(n).alias("value"), number(n).alias("number")) for n in names))
    return wide.select("column", F.inline(cells))


def distinct_modes(profile: DataFrame, column: str = "mode") -> DataFrame:
    return profile.select(column).distinct()


def histogram(df: DataFrame, column: str, bins: int = BINS) -> DataFrame:
    """Equal-width bins ``(bin, lower, upper, n)`` over the column's range, the last one closed.

    NULLs are left out and empty bins are reported. The range is one row, known before the second scan and
    sent to its tasks.
    """
    values = df.select(F.col(column).cast("double").alias("x"))
    ends = values.agg(F.min("x").alias("low"), F.max("x").alias("high")).filter(F.col("low").isNotNull())
    # A single value gets the unit range around it.
    alone = F.col("low") == F.col("high")
    span = ends.select(
        F.when(alone, F.col("low") - 0.5).otherwise(F.col("low")).alias("lo"),
        F.when(alone, F.col("high") + 0.5).otherwise(F.col("high")).alias("hi"),
    )
    width = (F.col("hi") - F.col("lo")) / bins
    at = F.floor((F.col("x") - F.col("lo")) / width)
    place = F.when(at < bins, at).when(at >= bins, F.lit(bins - 1))
    filled = values.join(F.broadcast(span)).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    edges = (
        df.sparkSession.range(bins)
        .withColumnRenamed("id", "bin")
        .join(F.broadcast(span))
        .select("bin", (F.col("lo") + F.col("bin") * width).alias("lower"), (F.col("lo") + (F.col("bin") + 1) * width).alias("upper"))
    )
    return edges.join(filled, "bin", "left").select(
        "bin", "lower", "upper", F.coalesce("n", F.lit(0)).alias("n")
    )


def density_2d(df: DataFrame, x: str = "width", y: str = "height") -> DataFrame:
    """Points of a scatter plot with their multiplicity."""
    return df.groupBy(x, y).agg(F.count("*").alias("n"))


def purge_zero_size(objects: DataFrame) -> DataFrame:
    """Media objects with the decision to delete empty ones; folder marks are left out."""
    files = objects.filter(~((F.col("size") == 0) & F.endswith("key", F.lit("/"))))
    return files.select("key", "size", (F.col("size") == 0).alias("purge"))


def frame_decimate(frames: DataFrame, fps: str = "fps", target_fps: int = TARGET_FPS) -> DataFrame:
    """Every n-th frame by 1-based ``frame_no``, n from the frame rate (half-even, at least 1).

    A rate of zero cannot be processed and gives no frames.
    """
    skip = F.greatest(F.rint(F.col(fps) / target_fps), F.lit(1.0)).cast("long")
    return (
        frames.filter(F.col(fps) > 0)
        .withColumn("frame_skip", skip)
        .filter(F.col("frame_no") % F.col("frame_skip") == 0)
    )


def frame_sample(
    frames: DataFrame, max_frames: int = MAX_FRAMES, total: str | None = None
) -> DataFrame:
    """At most ``max_frames`` evenly spaced frames of each video by 0-based ``frame_no``.

    ``total`` names a column with the video's frame count (NULL: unknown, take the first frames).
    Without it the frames are counted. Counts of up to ``FEW_VIDEOS`` videos are sent to the frames, which are then chosen where they lie, so
    no payload moves; with more videos the choice is made on the numbers alone, and the frames are looked up by shuffle. Unreadable frames, with a NULL payload or embedding, drop out
    after the choice.
    """
    number = F.col("frame_no")

    def chosen(counted: DataFrame, count: Column) -> DataFrame:
        step = F.when(count > 0, F.greatest(F.lit(1), F.floor(count / max_frames))).otherwise(F.lit(1))
        return counted.filter((number % step == 0) & (number < step * max_frames))

    if total is None:
        checkpoint_root(frames.sparkSession)
        counts = frames.groupBy("video_id").agg(F.count("*").alias("_total")).checkpoint()
        if counts.count() <= FEW_VIDEOS:
            known = frames.alias("f").join(F.broadcast(counts.alias("w")), null_safe("f", "w", ["video_id"])).select("f.*", "w._total")
            return _readable(chosen(known, F.col("_total")).drop("_total"))
        numbers = join_facts(frames.select("video_id", "frame_no").distinct(), counts, ["video_id"])
        wanted = chosen(numbers, F.col("_total")).select("video_id", "frame_no")
        sampled = frames.alias("f").join(wanted.alias("w"), null_safe("f", "w", ["video_id", "frame_no"]), "left_semi")
    else:
        sampled = chosen(frames, F.col(total))
    return _readable(sampled)


def _readable(frames: DataFrame) -> DataFrame:
    for payload in ("payload", "embedding"):
        if payload in frames.columns:
            frames = frames.filter(F.col(payload).isNotNull())
    return frames


def before_after_profile(
    before: DataFrame, after: DataFrame, texts: Sequence[str], numbers: Sequence[str]
) -> DataFrame:
    """``describe_all`` of both stages under one ``stage`` column."""
    both = [
        describe_all(df, texts, numbers).withColumn("stage", F.lit(stage))
        for stage, df in (("before", before), ("after", after))
    ]
    return both[0].unionByName(both[1])


def number_frames(frames: DataFrame, by: str) -> DataFrame:
    """0-based ``frame_no`` of each row inside its video, in the order of ``by``."""
    placed = ordinal(frames, [by], "_place", within=["video_id"])
    return placed.withColumn("frame_no", F.col("_place") - 1).drop("_place")
