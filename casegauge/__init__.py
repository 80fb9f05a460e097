"""casegauge: service-quality analytics as Spark DataFrame operators."""

CASE = ("maprule", "geoname", "netname")
