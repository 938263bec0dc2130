"""Reports on stored partitions, runs, labels, sites and directories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.operators.windows import interval_faults, swept


def in_ranges(wanted: DataFrame, ranges: DataFrame, ident: str, low: str, high: str) -> DataFrame:
    """wanted joined with the ranges that hold their id: an equality on tiles, then the exact condition. A range lies in
    tiles of a width of its own, the power of two next to its length, and so in two at most, however wide it is; an id
    looks in one tile of each width that ranges have (at most one for each bit)."""
    ranges = ranges.filter(F.col(low) <= F.col(high)).withColumn("__bits", F.length(F.bin(F.col(high) - F.col(low))))
    tile = lambda c: F.expr(f"shiftright(cast(`{c}` as bigint), __bits)")
    tiled = ranges.withColumn("__tile", F.explode(F.array_distinct(F.array(tile(low), tile(high)))))
    widths = sorted(r[0] for r in ranges.select("__bits").distinct().collect())
    if not widths:
        return wanted.join(ranges.drop("__bits"), F.lit(False))
    asked = wanted.withColumn("__bits", F.explode(F.array(*map(F.lit, widths)))).withColumn("__tile", tile(ident))
    return asked.join(tiled, ["__bits", "__tile"]).filter(F.col(ident).between(F.col(low), F.col(high))).drop("__tile", "__bits")


def geography_check(rows: DataFrame, stored: str, found: str) -> DataFrame:
    """Adds state: how a stored area code agrees with the one looked up by place."""
    s, f = F.col(stored), F.col(found)
    state = F.when(s.isNull() & f.isNull(), "unresolved").when(s.isNull(), "missing_stored_code").when(f.isNull(), "outside_all_areas").when(s == f, "match").otherwise("mismatch")
    return rows.withColumn("state", state)


def place_classes(rows: DataFrame, first: str, second: str) -> DataFrame:
    """How stored area codes agree with those looked up by place, for two sets of areas at once. Of each set rows have
    <set>_stored, <set>_stored_name, and what found_places gives as <set>_code, <set>_name, <set>_how (error where the
    lookup itself failed). Adds <set>_match, overall_match and classes, an array in a fixed order:

    lookup_error; invalid_coordinates; <set>_no_match and <set>_code_mismatch for each set; possible_boundary_edge, where
    both agree but one was found from a neighbouring tile; possible_boundary_version_difference, where they do not agree but
    the names of a set do."""
    clean = lambda c: F.coalesce(F.trim(F.col(c)), F.lit(""))
    name = lambda c: F.regexp_replace(F.lower(clean(c)), r"[^\p{L}\p{N}]+", "")
    has = lambda c: clean(c) != ""
    match = {s: has(f"{s}_stored") & has(f"{s}_code") & (clean(f"{s}_stored") == clean(f"{s}_code")) for s in (first, second)}
    either = lambda how: (F.col(f"{first}_how") == how) | (F.col(f"{second}_how") == how)
    same_name = lambda s: has(f"{s}_code") & (name(f"{s}_stored_name") != "") & (name(f"{s}_stored_name") == name(f"{s}_name"))
    both = match[first] & match[second]
    looked = [c for s in (first, second) for c in (F.when(~has(f"{s}_code"), f"{s}_no_match").when(~match[s], f"{s}_code_mismatch"),)]
    looked += [F.when(both & either("neighbour_tile"), "possible_boundary_edge"), F.when(~both & (same_name(first) | same_name(second)), "possible_boundary_version_difference")]
    classes = F.when(either("error"), F.array(F.lit("lookup_error"))).when(either("invalid_coordinate"), F.array(F.lit("invalid_coordinates"))).otherwise(F.array_compact(F.array(*looked)))
    return rows.withColumns({f"{first}_match": match[first], f"{second}_match": match[second], "overall_match": both, "classes": classes})


def site_intervals(bridge: DataFrame, site: str, identity: list[str]) -> DataFrame:
    """Per site: its distinct identities, their list in order of start, and whether it resolves: no inverted interval, no
    overlap, one open end at most."""
    one = bridge.select(site, *identity, "valid_from", "valid_to").distinct()
    faults = interval_faults(one, site).select(site, "overlaps", "valid")
    listed = F.array_sort(F.collect_list(F.struct("valid_from", *identity, "valid_to")))
    out = one.groupBy(site).agg(F.count("*").alias("intervals"), F.count_if(F.col("valid_to") < F.col("valid_from")).alias("inverted"), listed.alias("l"))
    text = lambda x: F.concat_ws(":", x["valid_from"].cast("string"), *[x[c].cast("string") for c in identity])
    out = out.withColumn("listed", F.array_join(F.transform("l", text), ",")).drop("l").join(faults, site)
    return out.withColumn("resolved", F.col("valid") & (F.col("inverted") == 0)).drop("valid")


def resolved_sites(bridge: DataFrame, selectors: DataFrame, identity: list[str], measures: list[str]) -> DataFrame:
    """Selectors (selector, site_ref, other_ref; either may be null, case aside) to the intervals of their site: (selector,
    site_ref, other_ref, measure, identity, valid_from, valid_to, problem), a row for each distinct interval of the wanted
    measures, in which a problem of the selector stands in one row without an interval.

    A selector must lead to one site and one other reference (no_rows, several_sites, several_references); intervals of a
    measure must have a start (missing_start), not be inverted (inverted), and not overlap, by a sweep with the furthest
    end so far, so that one inside a long earlier one is seen (overlap). bridge: (site_ref, other_ref, measure, identity,
    valid_from, valid_to)."""
    up = lambda c: F.upper(F.trim(F.col(c)))
    rows = bridge.withColumns({"__site": up("site_ref"), "__other": up("other_ref")})
    ask = selectors.select("selector", up("site_ref").alias("__s"), up("other_ref").alias("__o"))
    # A selector with a site looks up by it; one with the other reference alone by that.
    by_site = ask.filter("__s is not null").join(rows, (F.col("__s") == F.col("__site")) & (F.col("__o").isNull() | (F.col("__o") == F.col("__other"))))
    by_other = ask.filter("__s is null").join(rows, F.col("__o") == F.col("__other"))
    met = by_site.unionByName(by_other)
    filled = lambda c: F.when(F.col(c) != "", F.col(c))
    refs = met.groupBy("selector").agg(F.count_distinct(filled("__site")).alias("sites"), F.count_distinct(filled("__other")).alias("others"), F.max(F.trim("site_ref")).alias("__ref"), F.max(F.trim("other_ref")).alias("__oref"))
    told = selectors.select("selector").join(refs, "selector", "left")
    problem = F.when(F.col("sites").isNull(), "no_rows").when(F.col("sites") != 1, "several_sites").when(F.col("others") != 1, "several_references")
    told = told.withColumn("problem", problem)
    wanted = met.withColumn("measure", F.lower(F.trim("measure"))).filter(F.col("measure").isin(measures))
    one = wanted.join(told.filter("problem is null").select("selector", "__ref", "__oref"), "selector").select("selector", F.col("__ref").alias("site_ref"), F.col("__oref").alias("other_ref"), "measure", *identity, "valid_from", "valid_to").distinct()
    swept_ = swept(one, ["selector", "measure"])
    fault = F.when(F.col("valid_from").isNull(), "missing_start").when(F.col("valid_from") > F.col("valid_to"), "inverted").when(F.col("overlapping"), "overlap")
    good = swept_.withColumn("problem", fault).drop("before", "overlapping")
    return good.unionByName(told.filter("problem is not null").select("selector", "problem"), allowMissingColumns=True)


def missing_counts(manifests: DataFrame, counts: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Per `by`: manifests, those without counts of series, rows that those name as a hint, share with counts."""
    both = manifests.join(counts.select(*keys).distinct().withColumn("__has", F.lit(True)), keys, "left")
    without = F.col("__has").isNull()
    out = both.groupBy(by).agg(F.count("*").alias("manifests"), F.count_if(without).alias("without_counts"), F.coalesce(F.sum(F.when(without, F.col("n"))), F.lit(0)).alias("rows_hint"))
    return out.withColumn("share", F.round((F.col("manifests") - F.col("without_counts")) / F.col("manifests") + 1e-9, 4))


def listed_documents(spark: SparkSession, root: str, pattern: str, keys: list[str]) -> DataFrame:
    """(keys: text, path, bytes, text) of the documents under root/key=value/...; the folder is listed and read once,
    whatever their number, and a document that is broken is read like any other."""
    found = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).format("binaryFile").load(root)
    return found.select(*[F.regexp_extract("path", f"/{k}=([^/]+)", 1).alias(k) for k in keys], "path", F.col("length").alias("bytes"), F.decode("content", "utf-8").alias("text"))


def documents_of(units: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Each unit with its document and status: ok, missing_file, or invalid_json for what is no JSON object."""
    status = F.when(F.col("path").isNull(), "missing_file").when(F.try_parse_json("text").isNull() | ~F.ltrim("text").startswith("{"), "invalid_json").otherwise("ok")
    return units.select(*keys).join(found, keys, "left").withColumns({"bytes": F.coalesce("bytes", F.lit(0)), "status": status})


def count_summary(text: Column, field: str) -> tuple[Column, Column]:
    """Of a document's object of counts by id: ok, missing (none, or no object) or empty_object (no usable count), and how
    many usable ones there are."""
    raw = F.get_json_object(text, f"$.{field}")
    counts = F.from_json(F.when(raw.startswith("{"), raw), "map<string, string>")
    usable = F.map_filter(counts, lambda k, v: k.rlike("^[0-9]+$") & F.coalesce(v.try_cast("double") >= 0, F.lit(False)))
    n = F.coalesce(F.size(F.map_keys(usable)), F.lit(0))
    return F.when(counts.isNull(), "missing").when(n <= 0, "empty_object").otherwise("ok"), F.greatest(n, F.lit(0))


def manifest_issues(units: DataFrame, first: DataFrame, second: DataFrame, keys: list[str], field: str, hints: list[str]) -> DataFrame:
    """A row for each unit whose documents are missing, broken or without the counts that they ought to have: for both
    documents (first: the unit's own, second: its index) the issue or ok, bytes, usable counts and the rows that a document
    names; kind is both, connector_manifest or index_manifest. Counts are wanted where a document names rows, in the index
    also where the unit's own does. first and second: (keys, path, bytes, text, status)."""
    def side(df, s):
        state, n = count_summary(F.col("text"), field)
        named = [F.get_json_object("text", f"$.{h}").try_cast("double") for h in hints]
        hint = F.coalesce(*[F.when(h > 0, F.floor(h).cast("long")) for h in named], F.lit(0))
        return df.select(*keys, F.col("path").alias(f"{s}_path"), F.col("bytes").alias(f"{s}_bytes"), F.col("status").alias(f"{s}_status"), state.alias(f"{s}_counts"), n.alias(f"{s}_series"), hint.alias(f"{s}_rows"))

    both = units.join(side(first, "own"), keys, "left").join(side(second, "index"), keys, "left")
    wanted = {"own": F.col("own_rows") > 0, "index": (F.col("index_rows") > 0) | (F.col("own_rows") > 0)}
    issue = lambda s: F.when(F.col(f"{s}_status") != "ok", F.col(f"{s}_status")).when((F.col(f"{s}_counts") != "ok") & wanted[s], F.concat(F.lit("counts_"), F.col(f"{s}_counts"))).otherwise("ok")
    out = both.withColumns({"own_issue": issue("own"), "index_issue": issue("index")})
    own, index = F.col("own_issue") != "ok", F.col("index_issue") != "ok"
    kind = F.when(own & index, "both").when(own, "connector_manifest").when(index, "index_manifest").otherwise("none")
    return out.select(*keys, "own_issue", "index_issue", "own_path", "index_path", "own_bytes", "index_bytes", "own_series", "index_series", "own_rows", "index_rows", kind.alias("kind"))


def run_report(runs: DataFrame, key: str, now: str, late_days: int, stuck_days: int) -> DataFrame:
    """Per key: the latest finished run, runs in flight, the oldest of them, and a state by two thresholds in days."""
    open_ = F.col("ended").isNull()
    out = runs.groupBy(key).agg(F.max(F.when(~open_, F.col("ended"))).alias("last_ended"), F.count_if(open_).alias("in_flight"), F.min(F.when(open_, F.col("started"))).alias("oldest_open"))
    age = lambda c: F.date_diff(F.lit(now).cast("date"), F.col(c))
    state = F.when(age("oldest_open") > stuck_days, "stuck").when(F.col("last_ended").isNull(), "never_finished").when(age("last_ended") > late_days, "late").otherwise("ok")
    return out.withColumn("state", state)


def runs_in_flight(runs: DataFrame, now: str, warn_minutes: int, most_minutes: int) -> DataFrame:
    """Each run with minutes in flight (null once ended), whether that is over the threshold, and whether it is so old that
    it counts as lost."""
    t = F.lit(now).cast("timestamp_ntz")
    minutes = F.when(F.col("ended").isNull() & (F.col("started") <= t), F.floor((F.unix_micros(t.cast("timestamp")) - F.unix_micros(F.col("started").cast("timestamp"))) / 60_000_000))
    out = runs.withColumn("minutes", minutes)
    return out.withColumns({"over_threshold": F.coalesce((F.col("minutes") >= warn_minutes) & (F.col("minutes") <= most_minutes), F.lit(False)), "lost": F.coalesce(F.col("minutes") > most_minutes, F.lit(False))})


def label_candidates(rows: DataFrame, label: str, file: str, site: str, unit: str, value: str) -> DataFrame:
    """Per label: files, sites, rows with a value, and how often each unit occurs; units are counted before they are listed."""
    each = rows.groupBy(label).agg(F.count_distinct(file).alias("files"), F.count_distinct(site).alias("sites"), F.count(value).alias("filled"))
    units = rows.groupBy(label, unit).agg(F.count("*").alias("n")).groupBy(label).agg(F.array_sort(F.collect_list(F.struct(unit, "n"))).alias("u"))
    return each.join(units, label).withColumn("units", F.array_join(F.transform("u", lambda x: F.concat_ws(":", x[unit], x["n"])), ",")).drop("u")


def code_sets(directory: DataFrame, boundaries: DataFrame, code: str) -> DataFrame:
    """(code, where): codes that only one of two sets has."""
    a, b = directory.select(code).filter(F.col(code).isNotNull()).distinct(), boundaries.select(code).filter(F.col(code).isNotNull()).distinct()
    return a.join(b, code, "left_anti").withColumn("where", F.lit("directory")).unionByName(b.join(a, code, "left_anti").withColumn("where", F.lit("boundaries")))


def guarded_validation(calculated: DataFrame, stored: DataFrame, keys: list[str], value: str, final_before: Column, tolerance: float) -> DataFrame:
    """(status, n) of calculated rows against stored ones: rows that may still change and rows of another version are set
    apart before values are compared."""
    both = calculated.select(*keys, F.col(value).alias("c"), F.col("version").alias("vc")).join(stored.select(*keys, F.col(value).alias("s"), F.col("version").alias("vs")), keys, "left")
    status = (
        F.when(~final_before, "mutable").when(F.col("vs").isNull(), "missing").when(F.col("vc") != F.col("vs"), "version_differs")
        .when(F.abs(F.col("c") - F.col("s")) <= tolerance, "same").otherwise("differs")
    )
    return both.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


def public_snapshot(state: DataFrame, station: DataFrame, network: DataFrame, connector: DataFrame, phenomenon: DataFrame, measure: DataFrame) -> DataFrame:
    """Latest values with what they belong to: series to station to network and connector, series to phenomenon to measure,
    by left joins; then rows with an area code whose network is known and public."""
    out = state.join(station, "station_id", "left").join(network, "network_id", "left").join(connector, "connector_id", "left").join(phenomenon, "phenomenon_id", "left").join(measure, "measure_id", "left")
    return out.filter("area_code is not null and network_name is not null and is_public")
