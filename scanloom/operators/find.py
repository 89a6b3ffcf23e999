"""Find and retrieve requests answered from the instance index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.functions.text import ColumnOrName, is_blank, study_series_key
from scanloom.operators.keyed import lookup_join, numbered
from scanloom.operators.routing import FAILURE, NOT_FOUND, SUCCESS

STUDY, SERIES, IMAGE = "STUDY", "SERIES", "IMAGE"
KEYS = {STUDY: ["patient_id"], SERIES: ["study_uid"], IMAGE: ["study_uid", "series_uid"]}


def study_matches(instances: DataFrame) -> DataFrame:
    """Study-level answers: modalities in the study and number of series."""
    return instances.groupBy("patient_id", "study_uid").agg(
        F.array_sort(F.collect_set("modality")).alias("modalities_in_study"),
        F.countDistinct("series_uid").alias("study_related_series"), F.count(F.lit(1)).alias("study_related_instances"))


def series_matches(instances: DataFrame) -> DataFrame:
    return instances.groupBy("study_uid", "series_uid").agg(
        F.max("modality").alias("modality"), F.count(F.lit(1)).alias("series_related_instances"))


def image_matches(instances: DataFrame) -> DataFrame:
    return instances.select("study_uid", "series_uid", "sop_instance_uid", "sop_class_uid")


def valid_count(value: ColumnOrName) -> Column:
    """Instance count as reported: only when present and not negative."""
    c = F.col(value) if isinstance(value, str) else value
    return F.when(c >= 0, c)


def parsed_requests(requests: DataFrame, level: str, content: str = "content") -> DataFrame:
    """Read request text: a patient id, or ``study[,series]``; adds keys, route and message.

    A request without the keys its level needs fails before anything is looked up.
    """
    key = study_series_key(content)
    out = requests.withColumn("_k", key)
    if level == STUDY:
        out, missing = out.withColumn("patient_id", F.col(content)), F.lit(False)
    elif level in (SERIES, IMAGE):
        out = out.withColumn("study_uid", F.col("_k.study")).withColumn("series_uid", F.nullif(F.col("_k.series"), F.lit("")))
        missing = is_blank("study_uid") | (is_blank("series_uid") if level == IMAGE else F.lit(False))
    else:
        raise ValueError(f"unsupported level: {level}")
    return out.drop("_k").withColumn("route", F.when(is_blank(content) | missing, FAILURE).otherwise(SUCCESS))


def matched(requests: DataFrame, matches: DataFrame, on: list[str], optional: str | None = None) -> DataFrame:
    """Requests joined with their matches; ``optional`` narrows only where the request names it.

    Requests may be many and need not be few per study, so neither side is copied nor broadcast: a merge join, in which
    Spark cuts the partition of a study with very many instances or requests.
    """
    asked = requests.select("request_id", *on, *([F.col(optional).alias("_want")] if optional else []))
    found = matches.join(asked.hint("merge"), on)
    if optional:
        found = found.filter(F.col("_want").isNull() | (F.col("_want") == F.col(optional))).drop("_want")
    return found


def answered(requests: DataFrame, matches: DataFrame, on: list[str], tie: str, optional: str | None = None) -> DataFrame:
    """All answers of each valid request with match count and 0-based index.

    A request without a match stays as one row routed ``not found`` with count 0.
    """
    valid = requests.filter(F.col("route") == SUCCESS)
    found = numbered(matched(valid, matches, on, optional), ["request_id"], tie, "match_index", "match_count")
    hits = found.withColumn("route", F.lit(SUCCESS))
    # One row per answered request is enough to tell which requests have no answer.
    empty = (valid.select("request_id").join(found.select("request_id").distinct(), "request_id", "left_anti")
             .withColumn("match_count", F.lit(0).cast("bigint")).withColumn("route", F.lit(NOT_FOUND)))
    return hits.unionByName(empty, allowMissingColumns=True)


def requested_instances(instances: DataFrame, requests: DataFrame, level: str) -> DataFrame:
    """Instances covered by retrieve requests of a level (study, or study and series)."""
    if level not in (STUDY, SERIES):
        raise ValueError(f"unsupported retrieve level: {level}")
    keys = ["study_uid"] if level == STUDY else ["study_uid", "series_uid"]
    return lookup_join(instances, requests.select(*keys).distinct(), keys, "sop_instance_uid", "left_semi")
