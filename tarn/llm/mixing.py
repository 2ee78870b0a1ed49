"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import WORDS, dealt, unit
from tarn.operators.ordinal import ordinal
from tarn.session import checkpoint_root

# The weights in turn, and how often a source may be repeated.
WEIGHTS = (1.0, 2.0, 3.0)
MOST = 3
# Probabilities that one step of the reduction tree pairs off, about.
CHUNK = 32
# Texts of over this many times their source's mean length are rounded before the others.
LONG = 4
# Sources up to this many are broadcast: a short row each.
FEW_SOURCES = 100_000


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """``source, source_size, long_size, target`` of ``sizes (source, source_size, rows)``, one row per source.

    Sources by code point, null last, have the weights in turn and share the sum of all sizes. A target above
    ``most`` times its source's size stops there and the rest is shared anew by weight, until none is
    above. Every round is one aggregate over the sources; only two sums reach the driver.
    """
    numbered = ordinal(sizes.withColumn("no_source", F.col("source").isNull()), ["no_source", "source"])
    cycle = F.lit(list(weights))
    state = (
        numbered.withColumn("weight", F.get(cycle, F.pmod(F.col("ordinal") - 1, F.lit(len(weights))).cast("int")))
        .withColumn("most", F.col("source_size") * F.lit(float(most)))
        .withColumn("long_size", F.col("source_size") / F.col("rows") * LONG)
        .select("source", "source_size", "long_size", "weight", "most")
        .checkpoint()
    )
    total = state.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = None, -1
    while True:
        over = F.lit(False) if level is None else F.col("weight") * level > F.col("most")
        seen = state.agg(
            F.count_if(over).alias("n"),
            F.sum(F.when(over, F.col("most"))).alias("taken"),
            F.sum(F.when(~over, F.col("weight"))).alias("weight"),
        ).first()
        if seen.n == stopped or not seen.weight:
            break
        stopped, level = seen.n, (total - (seen.taken or 0.0)) / seen.weight
    share = F.col("weight") * F.lit(level or 0.0)
    return state.select("source", "source_size", "long_size", F.least(share, F.col("most")).alias("target"))


def _step(state: Column, item: Column) -> Column:
    """Pair the carried probability with the next one and move words between them until one is whole.

    Moved words leave the sum of probability times size as it was. Which way they move is drawn so that
    neither probability changes in the mean.
    """
    kept, rest = state["done"], state["rest"]
    room_a, room_b = (1 - rest["p"]) * rest["size"], (1 - item["p"]) * item["size"]
    has_a, has_b = rest["p"] * rest["size"], item["p"] * item["size"]
    up, down = F.least(room_a, has_b), F.least(has_a, room_b)
    rises = unit(F.lit("move"), rest["id"], rest["size"], item["id"], item["size"]) * (up + down) < down
    left = lambda who, words: F.struct(
        who["id"].alias("id"), who["size"].alias("size"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), words / who["size"])).alias("p"),
    )
    sure = lambda who, value: F.array(
        F.struct(who["id"].alias("id"), who["size"].alias("size"), F.lit(value).alias("one"))
    )
    to = lambda decided, carried: F.struct(F.concat(kept, decided).alias("done"), carried.alias("rest"))
    return (
        F.when(rest["p"].isNull(), F.struct(kept.alias("done"), item.alias("rest")))
        .when(rises & (room_a <= has_b), to(sure(rest, 1), left(item, has_b - room_a)))
        .when(rises, to(sure(item, 0), left(rest, has_a + has_b)))
        .when(has_a <= room_b, to(sure(rest, 0), left(item, has_b + has_a)))
        .otherwise(to(sure(item, 1), left(rest, has_a - room_b)))
    )


def round_shares(shares: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Round every fraction ``p`` of ``shares (source, id, size, p)`` to ``one`` = 0 or 1.

    ``source, id, size`` identify a row. A reduction tree: rows of a source meet in seeded chunks of about
    ``chunk`` rows, each chunk decides all but one of its rows, and the remaining ones meet in fewer
    chunks, until each source has one left, which is drawn. Chunks are of the same length for every
    source, so a hot one only has more of them. Each level is written to the checkpoint folder.
    """
    none = "struct<id:bigint,size:bigint,p:double>"
    rest = shares.select("source", F.struct("id", "size", "p").alias("item"))
    chunks = max(1, -(-shares.count() // chunk))
    decided = []
    level = 0
    while True:
        met = F.sort_array(
            F.collect_list(F.struct(F.xxhash64(F.lit(level), "item.id", "item.size").alias("turn"), "item"))
        )
        begin = F.struct(
            F.array().cast("array<struct<id:bigint,size:bigint,one:int>>").alias("done"),
            F.lit(None).cast(none).alias("rest"),
        )
        folded = (
            rest.groupBy(
                "source", F.pmod(F.xxhash64(F.lit("chunk"), F.lit(level), "item.id", "item.size"), F.lit(chunks)).alias("chunk")
            )
            .agg(met.alias("met"))
            .select("source", F.aggregate("met", begin, lambda s, x: _step(s, x["item"])).alias("state"))
            .checkpoint()
        )
        decided.append(folded.select("source", F.inline("state.done")))
        rest = folded.select("source", F.col("state.rest").alias("item"))
        if chunks == 1:
            break
        chunks, level = -(-chunks // chunk), level + 1
    last = unit(F.lit("last"), F.col("item.id"), F.col("item.size")) < F.col("item.p")
    out = rest.select("source", "item.id", "item.size", last.cast("int").alias("one"))
    for part in decided:
        out = out.unionByName(part)
    return out


def _deal(known: DataFrame) -> DataFrame:
    """Add ``copies`` near ``times`` to rows that stand for ``n`` rows each, and give each its own row."""
    shares = (
        known.withColumn("base", F.floor("times"))
        .withColumn("part", F.col("n") * (F.col("times") - F.col("base")))
        .withColumn("whole", F.floor("part"))
        .withColumn("p", F.col("part") - F.col("whole"))
    )
    rounded = round_shares(shares.where("p > 0").select("source", "id", "size", "p"))
    key = lambda side: [F.col(f"{side}.{c}") for c in ("source", "id", "size")]
    same = [a.eqNullSafe(b) for a, b in zip(key("k"), key("o"), strict=True)]
    joined = shares.alias("k").join(rounded.alias("o"), same[0] & same[1] & same[2], "left")
    extra = F.col("whole") + F.coalesce("one", F.lit(0))
    return (
        joined.select("k.*", extra.alias("extra"))
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
        .withColumn("copies", (F.col("base") + (F.col("copy") < F.col("extra")).cast("long")).cast("int"))
        .select("id", "source", "size", "source_size", "target", "copies")
    )


def _identity(doc_id: str) -> dict[str, Column]:
    """What a row of documents is dealt copies by."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long")
    return {doc_id: F.col("doc_id").cast("long"), "source": F.col("source").cast("string"), "size": words}


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for every row of ``docs (doc_id, source, text)``.

    Size is the number of words; a null text has none. A row of a source is taken target / source_size
    times in the mean: as often as that is whole, and the fraction is rounded by :func:`round_shares`. Texts of
    over ``LONG`` times their source's mean are rounded first, and what they miss of their share is laid on
    the source's other texts, so a source misses its target by less than one text of that length (where the
    others can bear it). ``taken`` is copies times size. Rows that
    repeat source, id and size share one number of copies, dealt as evenly as it goes. A source of no
    words has target 0 and takes nothing, an empty text is not copied, a null source is a source. An empty table
    gives no rows. All is decided by seeded hashes of id and size, so reruns agree. Other columns are ignored.
    """
    checkpoint_root(docs.sparkSession)
    rows = docs.select(*(c.alias(name) for name, c in _identity("id").items()))
    rows = rows.groupBy("source", "id", "size").agg(F.count("*").alias("n")).checkpoint()
    sizes = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("rows"))
    planned = targets(sizes, weights, most).checkpoint()
    few = planned.count() <= FEW_SOURCES

    def with_source(left: DataFrame, right: DataFrame, *columns: str) -> DataFrame:
        joined = left.alias("r").join(
            (F.broadcast(right) if few else right).alias("t"), F.col("r.source").eqNullSafe(F.col("t.source")), "left"
        )
        return joined.select("r.*", *(f"t.{c}" for c in columns))

    known = with_source(rows, planned, "source_size", "target", "long_size")
    long = F.col("size") > F.col("long_size")
    first = _deal(known.where(long).withColumn("times", F.col("target") / F.col("source_size"))).checkpoint()
    taken = first.groupBy("source").agg(
        F.sum("size").alias("had"), F.sum(F.col("copies") * F.col("size")).alias("got")
    )
    had, got = F.coalesce("had", F.lit(0)), F.coalesce("got", F.lit(0))
    times = F.greatest(F.lit(0.0), F.least(F.lit(float(most)), (F.col("target") - got) / (F.col("source_size") - had)))
    others = with_source(known.where(~long), taken, "had", "got")
    second = _deal(others.withColumn("times", F.when(F.col("size") > 0, times).otherwise(F.lit(0.0))))
    return first.unionByName(second).select(
        F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The rows of ``docs``, each as often as :func:`mix` takes it, with all their columns."""
    decided = mix(docs, weights, most).where("copies > 0").select("doc_id", "source", "size", "copies")
    rows = dealt(docs, _identity("doc_id"), decided, ["doc_id", "source", "size"], "copies")
    return rows.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
