"""The latest-value snapshot as readers get it: values with what they belong to, names and units as shown, by policy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.functions import text as X
from chronoloom.plans.latest import matrix_measure, value_reason


def _filled(c: str) -> Column:
    return F.when(F.trim(F.col(c)) != "", F.trim(F.col(c)))


def told_rows(state: DataFrame, series: DataFrame, stations: DataFrame, networks: DataFrame, connectors: DataFrame, phenomena: DataFrame, properties: DataFrame) -> DataFrame:
    """Each value of the state (connector_id, timeseries_id, observed_at, value) with its metadata, by left joins from
    series to the rest, and why it is not shown (null if it is), the first that holds: missing_series; a measure that the
    snapshot has not, or a value that its policy refuses (see value_reason); no_area; missing_network.

    series (timeseries_id, station_id, phenomenon_id, series_connector_id, series_label); stations (station_id,
    station_name, station_label, station_ref, pcon_code, la_code, network_id); networks (network_id, network_code,
    network_name, template); connectors (connector_id, connector_name); phenomena (phenomenon_id, property_id, notation,
    measure_label, label, unit); properties (property_id, property_code). A measure's code is the property's, else the
    first of notation, measure label and label. All tables but the state are small, and left to Spark's threshold."""
    out = state.join(series.withColumn("__series", F.lit(True)), "timeseries_id", "left")
    out = out.withColumn("connector_id", F.coalesce("series_connector_id", "connector_id")).drop("series_connector_id")
    out = out.join(stations, "station_id", "left").join(networks, "network_id", "left").join(connectors, "connector_id", "left")
    out = out.join(phenomena, "phenomenon_id", "left").join(properties, "property_id", "left")
    code = F.coalesce(_filled("property_code"), _filled("notation"), _filled("measure_label"), _filled("label"))
    measure = matrix_measure(F.coalesce(X.measure_code(code), code))
    refused = value_reason(measure, F.col("value"))
    why = (
        F.when(F.col("__series").isNull(), "missing_series").when(refused != "eligible", refused).when(F.coalesce(_filled("pcon_code"), _filled("la_code")).isNull(), "no_area")
        .when(_filled("network_code").isNull() | _filled("network_name").isNull(), "missing_network")
    )
    shown = X.display_name(F.col("template"), F.col("station_name"), F.col("station_label"), F.col("station_ref"), F.col("station_id"))
    phenomenon = X.phenomenon_label(F.coalesce(_filled("measure_label"), F.lit("")), F.coalesce(_filled("notation"), F.lit("")), F.coalesce(_filled("label"), F.lit("")))
    return out.select(
        "timeseries_id", "station_id", "connector_id", "connector_name", "network_code", "network_name", measure.alias("pollutant_code"), "observed_at", "value",
        X.unit(F.col("unit")).alias("unit"), phenomenon.alias("phenomenon"), shown.alias("display_name"), "pcon_code", "la_code", why.alias("why"),
    )


def public_rows(told: DataFrame) -> DataFrame:
    return told.filter("why is null").drop("why")


def refused_counts(told: DataFrame) -> DataFrame:
    """(why, n): how many rows are shown (null) or not, and why."""
    return told.groupBy("why").agg(F.count("*").alias("n"))
