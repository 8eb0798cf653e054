"""Marts with the columns and rules of their published contracts. Labels, aliases, exclusions and assignments come as tables or parameters."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graylane import storage
from graylane.functions import scalar as S
from graylane.operators import aggregates as A
from graylane.operators import intervals as I
from graylane.operators import joins as J
from graylane.operators import windows as W

#: States of a delivery against its forecast, in the order of their codes 0, 1, 2 (fixed values).
PERFORMANCE = ("EM ABERTO", "NO PRAZO", "FORA DO PRAZO")
#: Value up to which a freight doesn't count for the cubage indicator (fixed value).
LEAST_VALUE = "0.01"
#: What a description says in this order when a proof of delivery is attached (fixed values).
PROOF = ("comprovante", "entrega", "anexado")


def filled(c: Column) -> Column:
    """Trimmed text, null if nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def transit(trips: DataFrame, stops: DataFrame) -> DataFrame:
    """A row for each stop of each trip (one for a trip without stops) with origin, destination, planned clock times and transit time, and where each comes from.

    trips: trip, route, origin_doc, destination_doc, origin_city, destination_city, planned_start, planned_end, minutes,
    extracted, removed; stops: trip, place, city, doc, planned_arrival, extracted, removed. The route's origin stands before
    its first separator; a stop's own city goes before the route's destination.
    """
    live = lambda df: df.filter(~F.coalesce("removed", F.lit(False))).drop("removed")
    s = live(stops).select("trip", "place", F.col("city").alias("stop_city"), F.col("doc").alias("stop_doc"), "planned_arrival", F.col("extracted").alias("stop_extracted"))
    b = live(trips).join(s, "trip", "left")
    text = filled(F.replace(F.replace("route", F.lit("/BRASIL"), F.lit("")), F.lit(" ATE "), F.lit("|")))
    at = F.locate("|", text)
    first = lambda pairs: (F.coalesce(*[c for _, c in pairs]), S.first_evidence([(name, c.isNotNull()) for name, c in pairs]))
    route_from, route_to = filled(F.when(at > 0, F.substring_index(text, "|", 1))), filled(F.when(at > 0, text.substr(at + 1, F.length(text))))
    origin, origin_from = first([("ROUTE", route_from), ("TRIP_DOC", filled(F.col("origin_doc"))), ("TRIP_CITY", F.col("origin_city").cast("string"))])
    destination, destination_from = first([("STOP_CITY", F.col("stop_city").cast("string")), ("ROUTE", route_to), ("STOP_DOC", filled(F.col("stop_doc"))), ("TRIP_DOC", filled(F.col("destination_doc"))), ("TRIP_CITY", F.col("destination_city").cast("string"))])
    minutes, minutes_from, invalid = S.transit_minutes(F.col("minutes"), F.col("planned_start"), F.col("planned_arrival"), F.col("planned_end"))
    name = lambda c: F.when(F.contains(c, F.lit("/")), F.trim(F.substring_index(c, "/", 1))).when(F.contains(c, F.lit("-")), F.trim(F.substring_index(c, "-", 1))).otherwise(c)
    clock = lambda c: F.date_format(c, "HH:mm")
    return b.select(
        "trip", "place", origin.alias("origin"), destination.alias("destination"), origin_from.alias("origin_from"), destination_from.alias("destination_from"),
        F.concat_ws(" x ", F.coalesce(origin, F.lit("")), F.coalesce(destination, F.lit(""))).alias("pair"), name(origin).alias("origin_name"), name(destination).alias("destination_name"),
        F.concat("place", F.lit("º")).alias("place_label"), clock("planned_start").alias("cutoff"), clock(F.coalesce("planned_arrival", "planned_end")).alias("forecast"),
        S.duration_text(minutes).alias("transit"), minutes_from.alias("transit_from"), invalid.alias("invalid_minutes"), F.greatest("extracted", "stop_extracted").alias("extracted"),
    )


def freight_indicators(freights: DataFrame, locations: DataFrame, excluded: DataFrame) -> DataFrame:
    """Two rows for each freight, PE (delivery on time) and CB (cubage): reference_date, valid and the reason if not; for PE the forecast's origin, code and state of the delivery, for CB whether the freight is cubed.

    freights: freight, total, document (any issued one), pending_substitute, branch_payer, courtesy, active, cancelled,
    complementary, forecast, finished, issued (dates), payer, branch, volume. locations: freight, location, forecast; one
    location, however often it stands there, stands in for a missing forecast, several are a conflict. excluded: payer.
    """
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    each = locations.select("freight", "location", "forecast").distinct().groupBy("freight").agg(F.count_distinct("location").alias("_n"), F.max("forecast").alias("_forecast"))
    f = freights.join(each, "freight", "left").join(J.small(excluded.select("payer", F.lit(True).alias("_excluded")).distinct()), "payer", "left")
    value = F.coalesce("total", F.lit(0)).cast("decimal(28,8)") > F.lit(LEAST_VALUE).cast("decimal(28,8)")
    due = F.coalesce("forecast", F.when(F.col("_n") == 1, F.col("_forecast")))
    source = F.when(F.col("forecast").isNotNull(), "FREIGHT").when(F.col("_n") == 1, "LOCATION")
    eligible = F.col("document").isNotNull() | (value & ~flag("pending_substitute") & ~flag("branch_payer"))
    common = [("INACTIVE", ~flag("active")), ("CANCELLED", flag("cancelled")), ("COURTESY", flag("courtesy")), ("COMPLEMENTARY", flag("complementary")), ("INELIGIBLE", ~eligible)]
    pe = S.first_evidence([*common, ("LOCATION_CONFLICT", F.col("forecast").isNull() & (F.col("_n") > 1)), ("DATE_MISSING", due.isNull()), ("BRANCH_MISSING", F.col("branch").isNull())])
    cb = S.first_evidence([*common, ("PAYER_EXCLUDED", flag("_excluded")), ("VALUE_THRESHOLD", ~value), ("DATE_MISSING", F.col("issued").isNull())])
    code = F.when(F.col("finished").isNull(), 0).when(F.col("finished") <= due, 1).when(F.col("finished") > due, 2)
    none = F.lit(None)
    row = lambda kind, day, why, code, cubed, origin: F.struct(F.lit(kind).alias("indicator"), day.alias("reference_date"), why.isNull().alias("valid"), why.alias("reason"), code.cast("int").alias("code"), F.get(F.array(*[F.lit(p) for p in PERFORMANCE]), code.cast("int")).alias("state"), cubed.cast("boolean").alias("cubed"), origin.cast("string").alias("forecast_from"))
    both = F.array(row("PE", due, pe, code, none, source), row("CB", F.col("issued"), cb, none, F.col("volume") != 0, none))
    return f.select("freight", F.explode(both).alias("i")).select("freight", "i.*")


def revenue(freights: DataFrame, terms: DataFrame, lines: DataFrame, locations: DataFrame, calendar: DataFrame, assignments: DataFrame) -> DataFrame:
    """A row for each freight: billing day, branch, volumes, counts of its invoices and documents, disposition and the value that counts as revenue.

    freights: freight, value, status, valid. terms: freight, state (READY or CONFLICT), day, classification, courtesy,
    eligible, active, volumes, payer. lines: freight, invoice, document, conflict, unresolved, cte, fiscal (texts) of the
    resolved relations of invoices; locations: freight, location, volumes, valid of those of locations. calendar: day,
    billing. assignments: payer, branch, lo, hi. Lines and locations are counted and written before freights meet them, so
    that their shuffle files don't stand on disk together. A zero is a decision against the freight, a null an open question.
    """
    says = lambda c, *tokens: S.contains_tokens(F.col(c), tokens)
    flags = {"_conflict": F.col("conflict"), "_unresolved": F.col("unresolved"), "_cte": F.col("cte").isNotNull(), "_cancelled": says("fiscal", "cancelad") | says("fiscal", "cancell")}
    kept = [F.bool_or(name).alias(name) for name in flags]
    # distinct values are counted by groups of groups; two count_distinct at once would shuffle three copies of each line
    per = lines.groupBy("freight", "invoice", "document").agg(*[F.bool_or(c).alias(name) for name, c in flags.items()])
    per = per.groupBy("freight", "invoice").agg(F.when(F.col("invoice").isNotNull(), F.count("document")).alias("documents"), *kept)
    per = per.groupBy("freight").agg(F.count("invoice").alias("invoices"), F.coalesce(F.sum("documents"), F.lit(0)).alias("documents"), *kept)
    place = locations.groupBy("freight").agg(F.count_distinct("location").alias("_places"), F.when(F.count_distinct("location") == 1, F.min("volumes")).alias("_volumes"), F.bool_or(~F.coalesce("valid", F.lit(False))).alias("_bad_place"))
    per, place = storage.written(per, "revenue-invoices", free=True), storage.written(place, "revenue-places", free=True)
    t = terms.select("freight", F.lit(True).alias("_terms"), F.col("state").alias("_state"), "day", "classification", "courtesy", "eligible", "active", F.col("volumes").alias("_own_volumes"), "payer")
    j = freights.join(t, "freight", "left").join(per, "freight", "left").join(place, "freight", "left").join(J.small(calendar.select("day", "billing")), "day", "left")
    j = I.interval_join(j, assignments.select("payer", "branch", "lo", "hi"), ["payer"], "day", "lo", "hi").drop("lo", "hi")
    yes = lambda c: F.coalesce(c if isinstance(c, Column) else F.col(c), F.lit(False))
    by_status = yes("_cte") & F.col("status").isin("canceled", "cancelled")
    cancelled = yes("_cancelled") | yes(by_status)
    provenance = F.when(yes("_cancelled") & yes(by_status), "INVOICE_AND_FREIGHT").when(yes("_cancelled"), "INVOICE").when(yes(by_status), "FREIGHT").otherwise("NONE")
    block = yes(says("classification", "bloqueio") & (says("classification", "anulacao") | says("classification", "isolamento")))
    refused = [("NULL_DATE", F.col("day").isNull()), ("INACTIVE", ~F.coalesce("active", F.lit(True))), ("CANCELLED", cancelled), ("COURTESY", yes("courtesy")), ("BILLING_BLOCK", block)]
    broken = [("TERMS_MISSING", F.col("_terms").isNull()), ("DATA_CONFLICT", (F.col("_state") == "CONFLICT") | ~yes("valid"))]
    rules = [
        broken[0], ("DATA_CONFLICT", broken[1][1] | yes("_conflict")), ("DEPENDENCY_MISSING", F.coalesce("invoices", F.lit(0)) == 0), ("FISCAL_UNRESOLVED", yes("_unresolved")), ("LOCATION_CONFLICT", yes("_bad_place") | (F.coalesce("_places", F.lit(0)) > 1)), *refused,
        ("POLICY_MISSING", F.col("eligible").isNull() | F.col("courtesy").isNull()), ("INELIGIBLE", ~F.coalesce("eligible", F.lit(True))), ("REFERENCE_MISSING", F.col("billing").isNull()), ("PAYER_UNMAPPED", F.col("branch").isNull()), ("VALUE_MISSING", F.col("value").isNull()),
    ]
    state = F.coalesce(S.first_evidence([(n, yes(c)) for n, c in rules]), F.lit("READY"))
    unknown = functools.reduce(lambda a, b: a | b, [yes(c) for _, c in broken])
    zero = functools.reduce(lambda a, b: a | b, [yes(c) for _, c in refused]) | ~F.coalesce("eligible", F.lit(True))
    amount = F.when(unknown, None).when(zero, F.lit(0)).when(state == "READY", F.col("value")).cast("decimal(28,8)")
    return j.select(
        "freight", "day", "billing", "branch", F.coalesce("_volumes", "_own_volumes").alias("volumes"), F.when(F.col("_volumes").isNotNull(), "LOCATION").when(F.col("_own_volumes").isNotNull(), "TERMS").otherwise("MISSING").alias("volumes_from"),
        F.coalesce("invoices", F.lit(0)).alias("invoices"), F.coalesce("documents", F.lit(0)).alias("documents"), provenance.alias("cancelled_from"), state.alias("disposition"), amount.alias("revenue"),
    )


def materialized(result: DataFrame, stored: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(decisions, receipt): result with action INSERT, UPDATE (any other value than stored, nulls being values) or NOOP; and one row of candidates, inserts, updates, noops, ready and blocked."""
    cols = [c for c in result.columns if c != key]
    old = stored.select(key, F.struct(*cols).alias("_old"))
    action = F.when(F.col("_old").isNull(), "INSERT").when(F.struct(*cols).eqNullSafe(F.col("_old")), "NOOP").otherwise("UPDATE")
    d = result.join(old, key, "left").withColumn("action", action).drop("_old")
    n = lambda c, name: F.count_if(c).alias(name)
    return d, d.agg(F.count(F.lit(1)).alias("candidates"), n(F.col("action") == "INSERT", "inserts"), n(F.col("action") == "UPDATE", "updates"), n(F.col("action") == "NOOP", "noops"), n(F.col("disposition") == "READY", "ready"), n(F.col("disposition") != "READY", "blocked"))


def collectors(manifests: DataFrame, orders: DataFrame, freights: DataFrame, aliases: DataFrame, closed: Sequence[str], kinds: Sequence[str], unknown: str = "unknown") -> DataFrame:
    """day, branch: orders scanned, manifests issued, unloadings, orders left open, and what share of the manifests was scanned.

    manifests: manifest, day, branch, class, destinations (text, one or many), stored, ordinal: the last row of each whose
    class begins with none of closed; it unloads at the first of its destinations by name. orders: ordering, day, branch,
    freight, kind, ended, updated, item: the last row of each, of the kinds; freights: freight, branch, stored: the last
    row's branch stands in for a missing one. aliases: names (array), branch; names are equal whatever their case and accents.
    """
    named = lambda df, c, name: J.alias_join(df, aliases.withColumnRenamed("branch", name), c, "names", [name], S.folded)
    starts = functools.reduce(lambda a, b: a | b, [S.starts_with_ci_ai(F.trim("class"), p) for p in closed], F.lit(False))
    m = manifests.filter("manifest is not null and day is not null").filter(~F.coalesce(starts, F.lit(False)))
    m = W.latest_per_key(m, ["manifest"], [F.desc_nulls_last("stored"), F.desc("ordinal")])
    issued = named(m.withColumn("_own", filled(F.col("branch"))), "_own", "_branch").select("day", F.coalesce("_branch", "_own", F.lit(unknown)).alias("branch"))
    parts = F.explode(F.split(F.regexp_replace("destinations", r'[\[\]"]', ""), r"[;,\r\n]")).alias("_part")
    at = m.select("manifest", "day", parts).select("manifest", "day", filled(F.col("_part")).alias("_part")).filter("_part is not null").filter(S.folded(F.col("_part")) != F.lit("null"))
    at = named(at, "_part", "_branch").select("manifest", "day", F.coalesce("_branch", "_part").alias("branch"))
    unloaded = at.groupBy("manifest", "day").agg(F.min("branch").alias("branch")).select("day", "branch")
    last = W.latest_per_key(freights, ["freight"], [F.desc_nulls_last("stored"), F.desc("branch")]).select("freight", F.col("branch").alias("_freight_branch"))
    o = orders.filter("ordering is not null and day is not null").filter(functools.reduce(lambda a, b: a | b, [S.folded(F.trim("kind")) == F.lit(k) for k in kinds]))
    o = W.latest_per_key(o, ["ordering"], [F.desc_nulls_last("updated"), F.desc("item")]).join(last, "freight", "left")
    o = named(o.withColumn("_own", F.coalesce(filled(F.col("branch")), filled(F.col("_freight_branch")))), "_own", "_branch")
    scanned = o.select("day", F.coalesce("_branch", "_own", F.lit(unknown)).alias("branch"), F.col("ended").isNull().alias("_open"))
    c = A.contributions({"scanned": scanned, "issued": issued, "unloaded": unloaded, "left_open": scanned.filter("_open")}, ["day", "branch"])
    total = F.col("issued") + F.col("unloaded")
    share = F.coalesce((F.col("scanned").cast("decimal(19,4)") * 100 / F.nullif(total, F.lit(0)).cast("decimal(19,4)")).cast("decimal(9,4)"), F.lit(0).cast("decimal(9,4)"))
    out = c.select("day", S.yyyymm(F.col("day")).alias("month"), "branch", "scanned", "issued", "unloaded", total.alias("manifests"), "left_open", share.alias("percent"), (F.col("scanned") > 0).alias("has_orders"), (total > 0).alias("has_manifests"))
    return out.withColumn("row_hash", S.framed_hash(["day", "branch", "scanned", "issued", "unloaded", "left_open"]))


def inventory_orders(items: DataFrame, freights: DataFrame, kinds: dict, states: dict) -> DataFrame:
    """The last row of each item with its labels, its issuing branch and whether a proof of delivery was ever attached.

    items: ordering, freight, invoices (array), started, finished, performed, kind, state, branch, description, stored,
    ordinal. An item is order, freight, invoices and start. freights: freight, branch; the one branch that its rows name,
    if it is one, goes before the order's.
    """
    listed = S.join_array(F.col("invoices"))
    identity = F.sha2(F.concat(F.col("ordering").cast("string"), F.lit("|"), F.coalesce(F.col("freight").cast("string"), F.lit("null")), F.lit("|"), F.coalesce(listed, F.lit("")), F.lit("|"), F.col("started").cast("string")), 256)
    keyed = items.filter("ordering is not null").withColumn("item", identity)
    proof = A.sticky_any(keyed, ["item"], S.contains_tokens(F.col("description"), PROOF), "proof")
    last = W.latest_per_key(keyed, ["item"], [F.desc_nulls_last(F.coalesce("performed", "finished", "started")), F.desc_nulls_last("stored"), F.desc("ordinal")])
    branch = freights.groupBy("freight").agg(F.min("branch").alias("_lo"), F.max("branch").alias("_hi")).select("freight", F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).alias("_branch"))
    j = last.join(proof, "item", "left").join(branch, "freight", "left")
    return j.select("item", "ordering", "freight", F.date_format("started", "HH:mm:ss").alias("clock"), S.label(F.col("kind"), kinds).alias("kind"), S.label(F.col("state"), states).alias("state"), "branch", F.coalesce("_branch", "branch").alias("issuing_branch"), listed.alias("invoices"), "proof")


def pickups(live: DataFrame, deleted: DataFrame, catalog: DataFrame, gone: str = "DELETED") -> DataFrame:
    """The last row of each pickup, with what a deletion says where it isn't older than the row: status by catalogue (code, label, terminal), clock of the request, regions, branch and reason.

    live: pickup, updated, status, hour, city, state, branch, weight, stored; deleted: pickup, deleted_at, branch, weight,
    reason, stored.
    """
    a = W.latest_per_key(live, ["pickup"], [F.desc_nulls_last("updated"), F.desc_nulls_last("stored")]).withColumnsRenamed({"branch": "_own_branch", "weight": "_own_weight"}).drop("stored")
    d = W.latest_per_key(deleted, ["pickup"], [F.desc_nulls_last("deleted_at"), F.desc_nulls_last("stored")]).withColumn("_d", F.lit(True)).drop("stored")
    j = a.join(d, "pickup", "full_outer")
    removed = F.coalesce(F.col("_d") & (F.col("updated").isNull() | (F.col("deleted_at") >= F.col("updated"))), F.lit(False))
    j = S.status_catalog(j.withColumn("_removed", removed), "status", catalog)
    city, state = filled(F.col("city")), filled(F.col("state"))
    clock = F.coalesce(S.clock_text(F.col("hour")), F.lit("00:00:00"))
    return j.select(
        "pickup", F.when(F.col("_removed"), gone).otherwise(F.col("label")).alias("status"), F.col("_removed").alias("removed"), (F.col("_removed") | F.col("terminal")).alias("terminal"), F.when(F.length(clock) == 5, F.concat(clock, F.lit(":00"))).otherwise(clock).alias("clock"),
        F.concat_ws(" - ", city, state).alias("region"), F.concat(F.coalesce(city, F.lit("no city")), F.lit(" - "), F.coalesce(F.upper(state), F.lit("no state"))).alias("logistic_region"), F.coalesce("_own_weight", "weight").alias("weight"),
        F.when(F.col("_removed"), F.coalesce("branch", "_own_branch")).otherwise(F.col("_own_branch")).alias("branch"), F.when(F.col("_removed"), F.col("reason")).alias("reason"), F.when(F.col("_removed"), F.col("deleted_at")).alias("removed_at"),
    )


def quote_rows(captures: DataFrame, tariffs: DataFrame) -> DataFrame:
    """A row for each quote of the captures (envelope JSON): parties, leg, measures, tariff of its pair of states (0 without one) and its states by what followed it."""
    record = "number: string, requested: timestamp_ntz, branch: string, user: string, customer: string, nickname: string, origin_city: string, origin_state: string, destination_city: string, destination_state: string, volumes: int, taxed_weight: decimal(18,3), invoices_value: decimal(18,2), total: decimal(18,2), comments: string, cte_at: timestamp_ntz, nfse_at: timestamp_ntz"
    q = captures.select(S.typed_projection(F.col("envelope"), f"record struct<{record}>")["record"].alias("r")).select("r.*")
    place = lambda c: F.concat(F.coalesce(f"{c}_city", F.lit("")), F.lit(" - "), F.coalesce(f"{c}_state", F.lit("")))
    status = S.first_evidence([("Converted", F.col("cte_at").isNotNull() | F.col("nfse_at").isNotNull()), ("Rejected", F.length(F.rtrim("comments")) > 0)])
    t = J.small(tariffs.select(F.col("origin").alias("origin_state"), F.col("destination").alias("destination_state"), "amount"))
    issued = lambda c: F.when(F.col(c).isNotNull(), "Issued").otherwise("Pending")
    return q.join(t, ["origin_state", "destination_state"], "left").select(
        "number", "requested", F.date_format("requested", "HH:mm:ss").alias("clock"), "branch", F.nullif(F.lower(F.trim("user")), F.lit("")).alias("user_key"), F.coalesce("nickname", "customer").alias("customer"), place("origin").alias("origin"), place("destination").alias("destination"),
        F.concat(place("origin"), F.lit(" x "), place("destination")).alias("leg"), "volumes", "taxed_weight", "invoices_value", "total", F.coalesce("amount", F.lit(0)).cast("decimal(19,4)").alias("tariff"), F.coalesce(status, F.lit("Pending")).alias("status"), issued("cte_at").alias("cte_state"), issued("nfse_at").alias("nfse_state"),
    )


def clock_prefix(text: Column) -> Column:
    """The clock time that a text begins with, behind a date if one goes before it; another short text as it is, a date alone, NULL and blanks as null."""
    t = F.trim(text)
    t = F.when(t.rlike(r"\A\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}"), t.substr(12, 8)).otherwise(t)
    other = ~t.isin("", "NULL") & (F.length(F.rtrim(t)) <= 10) & ~t.rlike(r"\A\d{4}-\d{2}-\d{2}\z")
    return F.when(t.rlike(r"\A\d{2}:\d{2}:\d{2}"), t.substr(1, 8)).when(t.rlike(r"\A\d{2}:\d{2}"), t.substr(1, 5)).when(other, t)


def claim_rows(df: DataFrame, treatments: dict, solutions: dict) -> DataFrame:
    """A row for each occurrence of a claim (number, invoice, freight, opened, occurred_clock, closed_clock, weight, debit, credits, treatment, solution): its identity, clock times, labels and result."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    identity = F.sha2(F.concat(F.col("number").cast("string"), F.lit("|"), part("invoice"), F.lit("|"), part("freight")), 256)
    result = S.sum_components([F.col("credit"), F.col("insurer_credit")]) - S.sum_components([F.col("debit")])
    return df.filter("number is not null").select("number", "invoice", "freight", identity.alias("claim"), "opened", clock_prefix(F.col("occurred_clock")).alias("occurred_clock"), clock_prefix(F.col("closed_clock")).alias("closed_clock"), "weight", result.cast("decimal(18,2)").alias("result"), S.label(F.col("treatment"), treatments).alias("treatment"), S.label(F.col("solution"), solutions).alias("solution"))


def payable_rows(df: DataFrame, money: Sequence[str], kinds: dict, classes: dict) -> DataFrame:
    """The last row of each entry: created, settled or transacted last (a civil day until its last millisecond), then stored, day and ordinal; type token and class by their labels, amounts parsed, paid and reconciled as states."""
    end = lambda c: F.expr(f"cast(date_add({c}, 1) as timestamp_ntz) - make_dt_interval(0, 0, 0, 0.001)")
    fresh = F.greatest("created", end("settled"), end("transacted"))
    last = W.latest_per_key(df.filter("entry is not null").withColumn("_fresh", fresh), ["entry"], [F.desc_nulls_last("_fresh"), F.desc_nulls_last("stored"), F.desc("ordinal")])
    kind = F.trim(S.type_token(filled(F.col("kind"))))
    return last.select(
        "entry", F.date_format(F.coalesce("created", F.lit("1900-01-01").cast("timestamp_ntz")), "HH:mm:ss").alias("clock"), S.label(kind, kinds).alias("kind"), S.label(filled(F.col("class")), classes).alias("class"), *[S.parse_decimal(F.col(c), 18, 2).alias(c) for c in money],
        F.when(F.col("paid"), "PAID").otherwise("OPEN").alias("state"), F.when(F.col("reconciled"), "RECONCILED").when(~F.col("reconciled"), "UNRECONCILED").alias("reconciled"), "settled", "transacted",
    )


def calendar_names(calendar: DataFrame, weekdays: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """The calendar (see marts.calendar) with keys, quarter, ISO weekday and its name, weekend, and its holiday as a national one or an optional one (the names in optional)."""
    key = lambda c: (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c))
    iso = F.weekday("day") + 1
    national = F.col("holiday").isNotNull() & ~F.col("holiday").isin(*optional)
    return calendar.select(
        "day", key("day").alias("day_key"), "year", "month", F.dayofmonth("day").alias("dom"), F.quarter("day").alias("quarter"), "iso_week", iso.alias("iso_weekday"), F.get(F.array(*[F.lit(w) for w in weekdays]), F.weekday("day")).alias("weekday"), (iso > 5).alias("weekend"),
        F.when(national, F.col("holiday")).alias("national_holiday"), F.when(F.col("holiday").isin(*optional), F.col("holiday")).alias("optional_day"), "business", F.coalesce("business_day", "day").alias("billing_day"), key(F.coalesce("business_day", "day")).alias("billing_key"), S.yyyymm(F.col("day")).alias("year_month"),
    )
