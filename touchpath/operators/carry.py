"""Last-touch carry-forward as a segmented scan: no task holds the rows of a visitor.

A visitor's channel at an event is the last channel assigned up to that event. Three kinds
of rows matter: rows that assign a channel, rows that carry the current one on, and direct
rows, of which only the visitor's first may assign (`touchpath.plans.pc`).

The channel of assigning and direct rows is certain at once, so they are only counted, per
visitor and channel. What they do to carrying rows is one point per visitor and time: the
last channel assigned there. The points are all that has to be put in order:

1. Rows become points and counts in one aggregation, combined before its shuffle. Copies
   of a line, or any number of tags at one time, leave one point.
2. Inside each (visitor, slot), a short segment of time, a window finds the last assignment
   up to each point and that of the whole slot. A slot has at most one point a millisecond.
3. Carrying rows whose assignment lies in their slot are certain now and are counted by
   channel. The others, a few groups per slot, wait for the state carried in; with a
   summary of the slot they go to the next level.
4. A window over the summaries of a visitor's slots, and what waits in them, does the same
   for the whole visitor.

So a window holds at most one point per millisecond of a slot, or a few rows per slot of
elapsed time (8,640 slots of ten seconds in a day), however many rows a visitor has.
Certain counts pass all steps dealt by visitor *and channel*, away from the windows that
order points and summaries, so a visitor with very many rows or channels is spread over
tasks like very many visitors. The slot length is a parameter (longer for logs of months);
the result does not depend on it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchpath import config as c

SLOT_MS = 10_000
START, END = Window.unboundedPreceding, Window.unboundedFollowing
SALTS = 997
_ASSIGNED = "struct<ts:bigint,channel:string>"


def _nothing(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _total(sums: Mapping[str, str]) -> list[Column]:
    return [F.sum(name).cast(kind).alias(name) for name, kind in sums.items()]


def points(rows: DataFrame, sums: Mapping[str, str], keys: tuple[str, ...] = ()) -> DataFrame:
    """Step 1 for rows with guid, ts, ``assigned``, ``direct`` and the measures ``sums`` (name: type).

    Rows with a ``ts`` are points; rows with a ``channel`` are counts of certain rows by ``keys``.
    """
    assigns, direct = F.col("assigned").isNotNull(), F.col("direct")
    carries = ~assigns & ~direct
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    point = F.struct(
        "ts", _nothing("string").alias("channel"), *[_nothing(types[k]).alias(k) for k in keys],
        F.col("assigned").alias("assigns"), carries.alias("carries"), direct.alias("direct"),
        *[F.when(carries, F.col(name)).alias(name) for name in sums],
    )
    count = F.struct(
        _nothing("bigint").alias("ts"), F.when(direct, c.DIRECT).otherwise(F.col("assigned")).alias("channel"), *keys,
        _nothing("string").alias("assigns"), F.lit(False).alias("carries"), F.lit(False).alias("direct"), *sums,
    )
    both = F.when(carries, F.array(point)).otherwise(F.array(point, count))
    return rows.select("guid", F.inline(both)).groupBy("guid", "ts", "channel", *keys).agg(
        F.max("assigns").alias("assigns"), F.max("carries").alias("carries"), F.max("direct").alias("direct"), *_total(sums))


def _within_slots(found: DataFrame, slot_ms: int, assigns_first: bool, *dealt: str) -> DataFrame:
    """Step 2: ``here`` (last assignment up to the point), ``after`` (the slot's first direct row if it came
    later than that), and of the whole slot ``last``, ``first_direct``, ``starts_carrying`` and ``opens``.

    ``assigns_first``: rows of one time assign before others carry, or else after them.
    """
    found = found.withColumn("slot", F.expr(f"ts div {int(slot_ms)}"))
    group = Window.partitionBy("guid", "slot", *dealt)
    window, whole = group.orderBy("ts"), group.orderBy("ts").rowsBetween(START, END)
    assigned = F.when(F.col("assigns").isNotNull(), F.struct("ts", F.col("assigns").alias("channel")))
    carries_first = F.col("carries") & F.col("assigns").isNull() if assigns_first else F.col("carries")
    seen = found.select(
        "*",
        F.last(assigned, True).over(window.rowsBetween(START, 0 if assigns_first else -1)).alias("here"),
        F.last(assigned, True).over(whole).alias("last"),
        F.min(F.when(F.col("direct"), F.col("ts"))).over(whole).alias("first_direct"),
        F.first(carries_first).over(whole).alias("starts_carrying"),
        (F.row_number().over(window) == 1).alias("opens"),
    )
    later = (F.col("first_direct") < F.col("ts")) & F.coalesce(F.col("here.ts") <= F.col("first_direct"), F.lit(True))
    return seen.withColumn("after", F.when(later, F.col("first_direct")))


def _across_slots(slots: DataFrame, slot_ms: int, *dealt: str) -> DataFrame:
    """Step 4: the columns of `_within_slots` for a visitor's slots and what waits in them."""
    # the summary comes after what waits in its slot, so earlier rows tell about earlier slots only
    in_order = Window.partitionBy("guid", *dealt).orderBy("slot", "summary")
    whole = in_order.rowsBetween(START, END)
    here, after = F.col("here"), F.col("after")
    seen = slots.withColumns({
        "carried": F.last("last", True).over(in_order.rowsBetween(START, -1)),
        "last": F.last("last", True).over(whole),
        "first_direct": F.min("first_direct").over(whole),
        "starts_carrying": F.first("starts_carrying", True).over(whole),
        "opens": F.row_number().over(in_order) == 1,
    })
    earlier = F.expr(f"first_direct div {int(slot_ms)}") < F.col("slot")
    since = here.isNull() & earlier & F.coalesce(F.col("first_direct") >= F.col("carried.ts"), F.lit(True))
    return seen.withColumns({
        "after": F.when((after == F.col("first_direct")) | since, F.col("first_direct")),
        "here": F.coalesce(here, "carried"),
    }).drop("carried")


_STATE = ("last", "first_direct", "starts_carrying")


def _passed_on(seen: DataFrame, sums: Mapping[str, str], keys: tuple[str, ...]) -> DataFrame:
    """Step 3: what is certain by channel ``to``, what waits, and a summary of each ``slot``.

    The slot's first row brings the summary: itself if it waits, or else a row of its own. Rows
    are grouped in place, as they are dealt by guid, slot and ``to``.
    """
    known = F.col("here").isNotNull() & F.col("after").isNull()
    to = F.coalesce("to", F.when(F.col("counts") & known, F.col("here.channel")))
    waits = F.col("counts") & to.isNull()
    opens = F.col("to").isNull() & F.col("opens")
    types = {f.name: f.dataType.simpleString() for f in seen.schema.fields}

    def part(counts: bool, summary: bool) -> Column:
        here = [F.when(waits, F.col(name)) if counts else _nothing(types[name]) for name in ("here", "after")]
        return F.struct(
            F.lit(counts).alias("counts"), F.lit(summary).alias("summary"), (to if counts else _nothing("string")).alias("new"),
            here[0].alias("here"), here[1].alias("after"),
            *[(F.col(name) if summary else _nothing(types[name])).alias(name) for name in _STATE],
            *[(F.col(name) if counts else _nothing(types[name])).alias(name) for name in sums],
        )

    parts = (
        F.when(opens & waits, F.array(part(True, True)))
        .when(opens & F.col("counts"), F.array(part(True, False), part(False, True)))
        .when(opens, F.array(part(False, True))).when(F.col("counts"), F.array(part(True, False)))
    )
    group = ("guid", "slot", "to", *keys, "new", "counts", "summary", "here", "after", *_STATE)
    rows = seen.select("guid", "slot", "to", *keys, F.inline(parts))
    return rows.groupBy(*group).agg(*_total(sums)).drop("to").withColumnRenamed("new", "to")


def attributed(rows: DataFrame, sums: Mapping[str, str], keys: tuple[str, ...] = (),
               slot_ms: int = SLOT_MS, assigns_first: bool = False) -> DataFrame:
    """guid, channel, ``keys`` and ``sums``: the measures of each visitor by channel, as several rows to add up.

    Carrying rows have NULL keys. ``falls_back`` marks one row of each visitor that starts by carrying.
    """
    found = points(rows, sums, keys).withColumnRenamed("channel", "to")
    found = found.withColumn("counts", F.col("to").isNotNull() | F.col("carries"))
    slots = _passed_on(_within_slots(found, slot_ms, assigns_first, "to"), sums, keys)
    visits = _across_slots(slots, slot_ms, "to")
    direct = F.col("after").isNotNull() & ~F.col("starts_carrying")
    channel = F.coalesce("to", F.when(direct, c.DIRECT).otherwise(F.col("here.channel")), F.lit(c.DIRECT))
    falls_back = F.col("to").isNull() & F.col("opens") & F.col("starts_carrying")
    return visits.where("counts").select("guid", channel.alias("channel"), *keys, *sums, falls_back.alias("falls_back"))


def attribute_rows(rows: DataFrame, keep: tuple[str, ...], slot_ms: int = SLOT_MS, assigns_first: bool = False) -> DataFrame:
    """guid, ts, ``keep`` and ``channel`` of every row; carrying rows look up the point at their time.

    Assigning and direct rows need no look-up and are dealt by salts, so that they do not meet
    at their time; equal carrying rows do, which AQE splits.
    """
    seen = _within_slots(points(rows, {}).where("ts IS NOT NULL"), slot_ms, assigns_first)
    waiting = (F.lit(True).alias("summary"), _nothing(_ASSIGNED).alias("here"), _nothing("bigint").alias("after"))
    slots = seen.where("opens").select("guid", "slot", *waiting, *_STATE)
    states = _across_slots(slots, slot_ms).select(
        "guid", "slot", F.col("here").alias("carried"), F.when(~F.col("starts_carrying"), F.col("first_direct")).alias("first_direct"))
    first = F.col("first_direct")
    direct_since = (F.expr(f"first_direct div {int(slot_ms)}") < F.col("slot")) & (first >= F.col("carried.ts"))
    carried = (
        F.when(F.col("after") == first, c.DIRECT).when(F.col("here").isNotNull(), F.col("here.channel"))
        .when(direct_since, c.DIRECT).otherwise(F.coalesce("carried.channel", F.lit(c.DIRECT)))
    )
    looked_up = seen.where("carries").select("guid", "slot", "ts", "here", "after").join(states, ["guid", "slot"]).select(
        "guid", "ts", F.lit(0).alias("salt"), carried.alias("carried"))
    certain = F.when(F.col("direct"), c.DIRECT).otherwise(F.col("assigned"))
    salt = F.when(certain.isNull(), 0).otherwise(1 + F.pmod(F.xxhash64("assigned", *keep), F.lit(SALTS)).cast("int"))
    salted = rows.withColumns({"salt": salt, "certain": certain})
    joined = salted.join(looked_up, ["guid", "ts", "salt"], "left")
    return joined.select("guid", "ts", *keep, F.coalesce("certain", "carried").alias("channel"))
