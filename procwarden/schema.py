"""Schemas of the event table."""

from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType([
    T.StructField("UtcTime", T.StringType()),
    T.StructField("ProcessGuid", T.StringType()),
    T.StructField("ProcessId", T.IntegerType()),
    T.StructField("Image", T.StringType()),
    T.StructField("CommandLine", T.StringType()),
    T.StructField("ParentImage", T.StringType()),
    T.StructField("ParentCommandLine", T.StringType()),
    T.StructField("ParentProcessId", T.IntegerType()),
    T.StructField("User", T.StringType()),
    T.StructField("IntegrityLevel", T.StringType()),
    T.StructField("is_malicious", T.IntegerType()),
    T.StructField("mitre_technique_id", T.StringType()),
    T.StructField("technique_name", T.StringType()),
    T.StructField("label", T.StringType()),
])

# The column that gives events a total order: first-seen codes and ties use it.
EVENT_KEY = "event_id"
KEYED_EVENT_SCHEMA = T.StructType([T.StructField(EVENT_KEY, T.LongType())] + EVENT_SCHEMA.fields)

TEXT_COLUMNS = ["Image", "CommandLine", "ParentImage", "ParentCommandLine",
                "User", "IntegrityLevel", "UtcTime"]
COMMAND_LINES = ["CommandLine", "ParentCommandLine"]  # the long ones
