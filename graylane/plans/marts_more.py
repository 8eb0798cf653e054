"""Marts on dimensions, invoices, manifests, consolidated freight, trips and monitoring. Business values come as tables or columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graylane.functions import scalar as S
from graylane.operators import aggregates as A
from graylane.operators import changes as H
from graylane.operators import joins as J
from graylane.operators import windows as W
from graylane.sources import marked


def names(sources: Sequence[tuple[DataFrame, Column, dict[str, Column]]]) -> DataFrame:
    """key, name and attributes of the distinct normalised names of several sources (branches, drivers, vehicles, accounts); an attribute is the greatest value."""
    rows = None
    for df, name, attributes in sources:
        part = df.select(F.upper(F.trim(name)).alias("name"), *[c.alias(a) for a, c in attributes.items()]).filter("name != ''")
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    by = rows.groupBy("name").agg(*[F.max(c).alias(c) for c in rows.columns if c != "name"])
    return by.select(F.sha2("name", 256).alias("key"), *by.columns)


def clients(documents: DataFrame, roles: dict[str, tuple[str, str]]) -> DataFrame:
    """client (by document number, else by name), name, roles: everyone who stands in a role (document column, name column) of a document."""
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.col(d).alias("number"), F.col(n).alias("name")) for r, (d, n) in roles.items()]))
    rows = documents.select(each.alias("e")).select(S.party_key(F.col("e.number"), F.col("e.name")).alias("client"), "e.name", "e.role").filter("client is not null")
    return rows.groupBy("client").agg(F.max(F.upper(F.trim("name"))).alias("name"), F.array_join(F.array_sort(F.collect_set("role")), ",").alias("roles"))


def users(snapshots: DataFrame, key: str, name: str, order: Sequence[Column]) -> DataFrame:
    """The name that each user has in the last snapshot."""
    return W.latest_per_key(snapshots, [key], order).select(F.col(key).alias("id"), F.trim(name).alias("name"))


def cargo_location(rows: DataFrame, labels: dict, weight: Column, regions: DataFrame) -> DataFrame:
    """id, status (label of the code, unknown codes as they are), weight (parsed text) and region of the place by its aliases."""
    r = rows.select("id", S.label(F.col("status"), labels).alias("status"), S.parse_decimal(weight, 18, 3).alias("weight"), "place")
    return J.alias_join(r, regions, "place", "aliases", ["region"], S.folded).select("id", "status", "weight", "region")


def current_invoices(captures: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The freshest row of each invoice.

    Its identity is the access key, else number and party, else the row's own place; numbers of freights come as one
    canonical text; freshness is the latest of issue (a day, which lasts to its end) and update.
    """
    identity = S.identity_key([("key", F.col("access_key")), ("number", F.concat("number", F.lit("|"), "party")), ("row", F.col("ordinal").cast("string"))])
    fresh = S.freshness_max([F.col("updated")], [F.col("issued")])
    c = captures.withColumn("invoice", identity).withColumn("fresh", fresh).withColumn("freights", S.canonical_list(F.col("freights")))
    return W.latest_per_key(c, ["invoice"], [F.desc_nulls_last("fresh"), *order])


def invoice_fact(invoices: DataFrame, at: Column) -> DataFrame:
    """invoice, client, state against the day, days past due (open ones alone), month and amount, with a hash of the row."""
    state = S.payment_state(F.col("paid"), F.col("due"), at)
    f = invoices.select("invoice", S.party_key(F.col("document"), F.col("party")).alias("client"), state.alias("state"), F.when(state == "OVERDUE", F.datediff(at, "due")).alias("days_past_due"), S.yyyymm(F.col("issued")).alias("month"), "amount")
    return f.withColumn("row_hash", S.row_hash(["invoice", "client", "state", "amount"]))


def invoices_by_client(fact: DataFrame) -> DataFrame:
    """client, month: invoices, amount, and what of it is overdue."""
    over = F.col("state") == "OVERDUE"
    return fact.groupBy("client", "month").agg(F.count(F.lit(1)).alias("invoices"), F.sum("amount").alias("amount"), F.sum(F.when(over, F.col("amount")).otherwise(0).cast("decimal(18,2)")).alias("overdue"))


def trips(captures: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The last capture of each trip and day with origin and destination (of the route text, else of the stated places) and their provenance, and the transit time where it is within bounds."""
    t = W.latest_per_key(captures, ["trip", "day"], order)
    o, d = S.route_parts(F.col("route"))
    minutes = F.floor((F.unix_timestamp("arrived") - F.unix_timestamp("left")) / 60)
    source = F.when(o.isNotNull(), "route").when(F.col("from_place").isNotNull() & F.col("to_place").isNotNull(), "places").otherwise("none")
    return t.select("trip", "day", F.coalesce(o, "from_place").alias("origin"), F.coalesce(d, "to_place").alias("destination"), source.alias("source"), S.duration_text(minutes).alias("transit"))


def manifests(lines: DataFrame, drop: Sequence[str], order: Sequence[Column], classes, direct: DataFrame, first: DataFrame, second: DataFrame, value: DataFrame) -> DataFrame:
    """A row for each manifest: its lines (equal ones counted once, whatever their fields' order), cost by the freshest line, contract class and its provenance, revenue of its freights, direct and through pickups.

    lines: manifest, vehicle, fresh, cost, record (JSON); classes: steps for classify_chain; the four tables are path_union's.
    """
    once = W.latest_per_key(lines.withColumn("_line", S.stable_json_hash(F.col("record"), drop)), ["manifest", "_line"], order)
    newest = W.latest_per_key(once, ["manifest"], order).select("manifest", "vehicle", "cost")
    counted = once.groupBy("manifest").agg(F.count(F.lit(1)).alias("lines"))
    classed = J.classify_chain(newest, classes)
    money = J.path_union(direct, first, second, value).withColumnRenamed("root", "manifest")
    return classed.join(counted, "manifest").join(money, "manifest", "left").select("manifest", "lines", "cost", "class", "class_from", *[F.coalesce(c, F.lit(0)).cast("decimal(18,2)").alias(c) for c in ("direct_total", "via_total", "total")])


def freight_consolidated(freights: DataFrame, documents: DataFrame, branches: DataFrame, components: Sequence[str], evidence) -> DataFrame:
    """A row for each freight: total of its components, its newest document, branch, first evidence of a cancellation and eligibility.

    A freight that another valid one of its group follows is superseded and leaves. Eligible is what has a document, an
    amount above zero and no evidence against it.
    """
    f = W.drop_superseded(freights, ["group"], F.col("issued"), F.col("valid"))
    f = J.enrich_latest(f, documents, ["freight"], [F.desc_nulls_last("document_at"), F.desc("document")])
    f = J.lookup_first(f, branches, [("branch_name", "name"), ("branch_id", "id")], "branch", "branch")
    total = S.sum_components([F.col(c) for c in components])
    why = S.first_evidence(evidence)
    ok = F.col("document").isNotNull() & (total > 0) & why.isNull()
    return f.select("freight", "group", "issued", "document", "branch", total.alias("total"), why.alias("cancelled_by"), F.coalesce(ok, F.lit(False)).alias("eligible"))


def billing_fact(consolidated: DataFrame, calendar: DataFrame) -> DataFrame:
    """Eligible freights on their billing business day (calendar: day, business_day), with month keys and a hash of the row."""
    c = consolidated.filter("eligible").join(J.small(calendar.select(F.col("day").alias("issued"), F.col("business_day").alias("billed"))), "issued", "left")
    f = c.select("freight", "branch", "total", "issued", "billed", S.yyyymm(F.col("billed")).alias("month"), (F.col("billed") != F.col("issued")).alias("moved"))
    return f.withColumn("row_hash", S.row_hash(["freight", "branch", "total", "billed"]))


def occurrences_by_day(base: str, fresh: DataFrame, covered: DataFrame) -> DataFrame:
    """The occurrences of the marked table under base (by scope and day) after its partitions whose covered run (scope, day, run, rows) isn't the applied one were replaced, with their counts checked."""
    H.replace_partitions(base, fresh, covered.select("scope", "day", "run"), "run", covered.select("scope", "day", "rows"))
    return marked.read(fresh.sparkSession, base)


def execution_log(runs: DataFrame, logs: DataFrame, hashes: DataFrame) -> DataFrame:
    """A row for each run: its monitoring figures, and how many rows it has unchanged from the run before of the same entity.

    hashes: entity, seq, hash, n of each run's rows; a run's rows are compared with those of seq - 1 as multisets.
    """
    before = hashes.select("entity", (F.col("seq") + 1).alias("seq"), "hash", F.col("n").alias("_n"))
    same = hashes.join(before, ["entity", "seq", "hash"]).groupBy("entity", "seq").agg(F.sum(F.least("n", "_n")).alias("unchanged"))
    return A.run_monitor(runs, logs, ["entity", "seq"]).join(same, ["entity", "seq"], "left").withColumn("unchanged", F.coalesce("unchanged", F.lit(0)).cast("long"))
