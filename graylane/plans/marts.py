"""Marts: compositions of the operators over captures. Business values (labels, tariffs, holidays, aliases) come as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graylane.functions import scalar as S
from graylane.operators import aggregates as A
from graylane.operators import intervals as I
from graylane.operators import joins as J
from graylane.operators import windows as W


def quotes(captures: DataFrame, tariffs: DataFrame) -> DataFrame:
    """A row for each quote of the captures (envelope JSON): status by what followed it, and the tariff of its pair of states (0 without one)."""
    r = S.typed_projection(F.col("envelope"), "record struct<id: bigint, origin: bigint, destination: bigint, invoice: string, comment: string, total: decimal(18,2)>")["record"]
    q = captures.select(r.alias("r")).select("r.*")
    status = F.when(F.col("invoice").isNotNull(), "Converted").when(F.col("comment").isNotNull(), "Rejected").otherwise("Pending")
    j = q.join(J.small(tariffs), ["origin", "destination"], "left")
    return j.select("id", status.alias("status"), "total", F.coalesce("amount", F.lit(0)).cast("decimal(19,4)").alias("tariff"))


def easter(year: Column) -> Column:
    """The Sunday of Easter in the Gregorian calendar (the anonymous algorithm), as a date."""
    y = year.cast("int")
    div = lambda a, b: F.floor(a / b).cast("int")
    a, b, c = y % 19, div(y, 100), y % 100
    d, e = div(b, 4), b % 4
    g = div(8 * b + 13, 25)
    h = (19 * a + b - d - g + 15) % 30
    i, k = div(c, 4), c % 4
    l = (32 + 2 * e + 2 * i - h - k) % 7  # noqa: E741
    m = div(a + 11 * h + 22 * l, 451)
    n = h + l - 7 * m + 114
    return F.make_date(y, div(n, 31), n % 31 + 1)


def calendar(days: DataFrame, fixed: DataFrame) -> DataFrame:
    """days (day) with year, month, ISO week, moving and fixed holidays (month, dom), business and the business day at or before.

    The last business day is carried along within a month and the one before, so no window spans the whole calendar.
    """
    e = easter(F.year("day"))
    moving = F.coalesce(*[F.when(F.col("day") == F.date_add(e, n), name) for n, name in ((-47, "carnival"), (-2, "good friday"), (0, "easter"), (60, "corpus christi"))])
    f = J.small(fixed.select("month", "dom", F.lit("fixed").alias("_f")))
    d = days.withColumn("month", F.month("day")).withColumn("dom", F.dayofmonth("day")).join(f, ["month", "dom"], "left")
    d = d.withColumn("holiday", F.coalesce(moving, "_f")).withColumn("business", F.col("holiday").isNull() & ~F.dayofweek("day").isin(1, 7))
    d = d.withColumn("_m", F.year("day") * 12 + F.col("month"))
    within = Window.partitionBy("_m").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = d.groupBy((F.col("_m") + 1).alias("_m")).agg(F.max(F.when(F.col("business"), F.col("day"))).alias("_before"))
    d = d.withColumn("_own", F.max(F.when(F.col("business"), F.col("day"))).over(within)).join(J.small(last), "_m", "left")
    return d.select("day", F.year("day").alias("year"), "month", F.weekofyear("day").alias("iso_week"), "holiday", "business", F.coalesce("_own", "_before").alias("business_day"))


def claims(df: DataFrame, parts: list[str], opened: str) -> DataFrame:
    """A row for each identity (hash of the parts) with the clock time of the opening; the latest opening wins."""
    keyed = df.withColumn("claim", S.row_hash(parts)).withColumn("clock", S.clock_text(F.date_format(opened, "yyyy-MM-dd HH:mm:ss")))
    return W.latest_per_key(keyed, ["claim"], [F.desc(opened), *[F.asc(p) for p in parts]])


def inventory(items: DataFrame, keys: list[str], order: list[Column], received: Column) -> DataFrame:
    """The latest row of each item and whether it was ever received."""
    return W.latest_per_key(items, keys, order).join(A.sticky_any(items, keys, received, "ever_received"), keys)


def payables(df: DataFrame, key: str, order: list[Column], kind: Column, amounts: dict[str, Column]) -> DataFrame:
    """The latest row of each key with its type token and parsed amounts."""
    return W.latest_per_key(df.withColumn("kind", S.type_token(kind)).withColumns({k: S.parse_decimal(c, 18, 2) for k, c in amounts.items()}), [key], order)


def trips(captures: DataFrame, stops: Column) -> tuple[DataFrame, DataFrame]:
    """(trips, stops): the stops of each trip by place; of a repeated (trip, place) the last in the list wins."""
    s = captures.select("trip", F.posexplode(stops).alias("pos", "s")).select("trip", "pos", "s.*")
    return captures.select("trip").distinct(), W.latest_per_key(s, ["trip", "place"], [F.desc("pos")])


def utilisation(visits: DataFrame, done: DataFrame) -> DataFrame:
    """day, branch: planned and done visits and their ratio."""
    c = A.contributions({"planned": visits, "done": done}, ["day", "branch"])
    return c.withColumn("ratio", A.ratio(F.col("done"), F.col("planned")))


def freight_detail(freights: DataFrame, lines: DataFrame) -> DataFrame:
    """freight: net and gross of its lines (decimal), first and last shipment, days late against the promise, band and on-time flag."""
    per = lines.groupBy("freight").agg(F.sum("gross").alias("gross"), F.sum("net").alias("net"), F.max("shipped").alias("shipped"))
    days = F.datediff("shipped", "promised")
    j = freights.join(per, "freight", "left")
    return j.select("freight", "gross", "net", days.alias("days_late"), S.delay_band(days).alias("band"), F.coalesce(days <= 0, F.lit(False)).alias("on_time"))


def indicators(detail: DataFrame, keys: list[str]) -> DataFrame:
    """keys: freights with a shipment, on time, and the share in basis points."""
    by = detail.filter("days_late is not null").groupBy(*keys).agg(F.count(F.lit(1)).alias("freights"), F.count_if(F.col("on_time")).alias("on_time"))
    return by.withColumn("basis_points", F.expr("on_time * 10000 div freights"))


def revenue_fact(freights: DataFrame, terms: DataFrame, relations: DataFrame) -> DataFrame:
    """Each freight with the terms valid on its date and a disposition: BLOCKED_RELATION, NO_TERMS, INELIGIBLE or READY; only ready ones have an amount."""
    j = I.interval_join(freights, terms, ["payer"], "day", "lo", "hi").join(relations.select("freight", F.lit(True).alias("_blocked")).distinct(), "freight", "left")
    state = F.when(F.col("_blocked"), "BLOCKED_RELATION").when(F.col("eligible").isNull(), "NO_TERMS").when(~F.col("eligible"), "INELIGIBLE").otherwise("READY")
    return j.select("freight", "payer", "day", state.alias("disposition"), F.when(state == "READY", F.col("amount")).alias("amount"))


def pickups(live: DataFrame, deleted: DataFrame) -> DataFrame:
    """The latest row of each pickup with the deletions applied."""
    latest = W.latest_per_key(live, ["pickup"], [F.desc("updated"), F.asc("status")])
    return J.with_tombstones(latest, deleted, "pickup", "updated", "deleted_at")


def receivables(documents: DataFrame, instalments: DataFrame) -> DataFrame:
    """Instalments of each document dealt over its lines by weight in cents, to the document's only client where a line has none."""
    lines = J.single_fallback(documents, documents.filter("client is not null").select("document", "client"), "document", "client")
    totals = instalments.groupBy("document").agg(F.sum("value").alias("total"))
    return W.allocate(lines.join(totals, "document"), ["document"], F.col("total"), F.col("weight"), [F.asc("line")]).select("document", "line", "client", "share")
