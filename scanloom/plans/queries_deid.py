"""Queries of sections D (joins and lookups) and E (de-identification), and the flagship query."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from scanloom.functions import actions as A
from scanloom.functions.dates import shift_da, shifted_values
from scanloom.operators import deid as D
from scanloom.operators import find, masking, packages
from scanloom.operators import routing as R
from scanloom.operators.keyed import in_tasks
from scanloom.plans.derived import ATTRIBUTES
from scanloom.plans.registry import INSTANCES_A_TASK, ROWS_A_TASK, instance_tasks, query, spread
from scanloom.plans.sqltext import blank, remapped, shifted, uuid_text
from scanloom.session import checkpoint_root
from scanloom.sources import instances


def path_text():
    return F.array_join(F.transform("item_path", lambda p: F.concat(p["tag"], F.lit(":"), p["item"].cast("string"))), "/").alias("path")


def value_text():
    return F.when(F.size("values") > 0, F.array_join("values", "\\")).alias("value")


def at_root():
    return F.size("item_path") == 0


def shown(df):
    return df.select("sop_instance_uid", path_text(), "tag", "vr", value_text())


def digests(df, tasks=None):
    """One digest over all attribute rows of an instance, so whole outputs can be compared."""
    line = F.concat_ws("|", "path", "tag", "vr", F.coalesce("value", F.lit("<none>")))
    lines = in_tasks(shown(df).select("sop_instance_uid", line.alias("line")), tasks, "sop_instance_uid")
    return lines.groupBy("sop_instance_uid").agg(F.count(F.lit(1)).alias("attributes"), F.md5(F.array_join(F.sort_array(F.collect_list("line")), "\n")).alias("digest"))


def _digest_sql(rows: str, moved: bool = True) -> str:
    line = "concat_ws('|', path, tag, vr, coalesce(value, '<none>'))"
    key = remapped("sop_instance_uid") if moved else "sop_instance_uid"
    return f"SELECT {key} AS sop_instance_uid, count(*) AS attributes, md5(string_agg({line}, chr(10) ORDER BY {line})) AS digest FROM ({rows}) GROUP BY sop_instance_uid"


_STRIPPED = "(substr(tag, 4, 1) IN ('1', '3', '5', '7', '9', 'B', 'D', 'F') OR substr(tag, 1, 2) IN ('50', '60'))"
_PSEUDO = "SELECT pid, arg_min(prefix, id) AS prefix, arg_min(postfix, id) AS postfix, coalesce(arg_min(coalesce(date_shift, 0), id), 0) AS days FROM pseudonyms GROUP BY pid"


def _rules_sql(source: str, retain: tuple[str, ...] = ()) -> str:
    """Expected attribute rows; ``source`` gives sop_instance_uid, days (0 or NULL: removed)."""
    s = "(coalesce(days, 0) <> 0)"
    keep_rt = "RTReferencedStudySequence" in retain
    inside_removed = "path LIKE '00400275:%' OR path LIKE '00081110:%'" + ("" if keep_rt else " OR path LIKE '30060010:0/30060012:%'")
    kept_whole = "path LIKE '30060010:0/30060012:%'" if keep_rt else "false"
    removed = ["RequestAttributesSequence", "PatientAge", *(() if keep_rt else ("RTReferencedStudySequence", "RTReferencedSeriesSequence"))]
    removed = [k for k in removed if k not in retain]
    drop = (f"({inside_removed}) OR (NOT ({kept_whole}) AND ({_STRIPPED} OR keyword IN ({', '.join(repr(k) for k in removed)}) OR keyword = 'TimezoneOffsetFromUTC' "
            f"OR (keyword = 'SeriesDate' AND (NOT {s}))))")
    emptied = [k for k in ("AccessionNumber", "PatientName", "PatientID", "ReferringPhysicianName", "ReferencedStudySequence") if k not in retain]
    keep_dates = "StudyDate" in retain
    cases = [f"WHEN {kept_whole} THEN value", f"WHEN keyword IN ({', '.join(repr(k) for k in emptied)}) THEN NULL",
             f"WHEN keyword = 'StudyDate' THEN CASE WHEN {s} THEN {shifted('value', 'days')} ELSE {'value' if keep_dates else 'NULL'} END",
             f"WHEN keyword = 'StudyTime' THEN CASE WHEN {s} THEN value END",
             "WHEN keyword IN ('InstitutionName', 'DeviceSerialNumber', 'DeviceLabel') THEN 'REMOVED'",
             f"WHEN keyword = 'SeriesDate' THEN {shifted('value', 'days')}",
             f"WHEN keyword = 'ContentDate' THEN CASE WHEN {s} THEN {shifted('value', 'days')} ELSE '19991111' END",
             f"WHEN vr = 'DT' THEN CASE WHEN {s} THEN {shifted('substr(value, 1, 8)', 'days')} || substr(value, 9) ELSE '19991111111111' END",
             *(["WHEN keyword = 'SOPInstanceUID' THEN value"] if "SOPInstanceUID" in retain else []),
             *(["WHEN keyword = 'ImageType' THEN 'ORIGINAL'"] if "ImageType" in retain else []),
             f"WHEN keyword = 'FrameOfReferenceUID' THEN {remapped(chr(115) + 'plit_part(value, chr(92), 1)')} || chr(92) || {remapped('split_part(value, chr(92), 2)')}",
             f"WHEN keyword IN ('SOPInstanceUID', 'StudyInstanceUID', 'SeriesInstanceUID', 'ReferencedSOPInstanceUID') THEN {remapped('value')}"]
    return (f"SELECT sop_instance_uid, path, tag, vr, CASE {' '.join(cases)} ELSE value END AS value, keyword FROM elements JOIN ({source}) USING (sop_instance_uid) WHERE NOT ({drop})")


_BASIC, _MODIFIED = "Basic Application Confidentiality Profile", "Retain Longitudinal Temporal Information Modified Dates Option"


def _marks_sql(source: str, issuer: str | None, identity: bool) -> str:
    """Expected generated rows; ``source`` gives sop_instance_uid, sop_class_uid, days[, pid, name]."""
    s = "(coalesce(days, 0) <> 0)"

    def row(path, tag, vr, value, where="true"):
        return f"SELECT sop_instance_uid, '{path}' AS path, '{tag}' AS tag, '{vr}' AS vr, {value} AS value FROM ({source}) WHERE {where}"

    rows = [row("", "00120062", "CS", "'YES'"), row("", "00280303", "CS", f"CASE WHEN {s} THEN 'MODIFIED' ELSE 'REMOVED' END"),
            row("", "00120063", "LO", f"'{_BASIC}' || CASE WHEN {s} THEN chr(92) || '{_MODIFIED}' ELSE '' END"), row("", "00120064", "SQ", "NULL")]
    for item, code, meaning, cond in ((0, "113100", _BASIC, "true"), (1, "113107", _MODIFIED, s)):
        rows += [row(f"00120064:{item}", t, vr, f"'{v}'", cond) for t, vr, v in (("00080100", "SH", code), ("00080102", "SH", "DCM"), ("00080104", "LO", meaning))]
    pet = f"sop_class_uid = '1.2.840.10008.5.1.4.1.1.128' AND NOT {s}"
    rows += [row("", "00080021", "DA", "'19991111'", pet), row("", "00080031", "TM", "'111111'", pet)]
    if identity:
        rows += [row("", "00100020", "LO", "pid"), row("", "00100010", "PN", "name")]
    if issuer:
        rows.append(row("", "00100021", "LO", f"'{issuer}'"))
    return " UNION ALL ".join(rows)


def _deid_sql(source: str, issuer: str | None = None, identity: bool = False, retain: tuple[str, ...] = ()) -> str:
    replaced = "AND NOT (path = '' AND keyword IN ('PatientID', 'PatientName'))" if identity else ""
    return (f"SELECT sop_instance_uid, path, tag, vr, value FROM ({_rules_sql(source, retain)}) WHERE true {replaced} "
            f"UNION ALL {_marks_sql(source, issuer, identity)}")


_NO_SHIFT = "SELECT sop_instance_uid, sop_class_uid, NULL AS days FROM inst"
_LOOKED_UP = f"SELECT sop_instance_uid, sop_class_uid, p.days AS days, prefix || '-' || postfix AS pid, prefix || '^' || postfix AS name FROM inst JOIN ({_PSEUDO}) p ON p.pid = patient_id WHERE patient_id <> ''"
_ATTRIBUTED = """SELECT sop_instance_uid, sop_class_uid, CAST(o_custkey % 40 AS INT) - 20 AS days, 'PS-' || CAST(o_custkey AS STRING) AS pid, 'PS^' || CAST(o_custkey AS STRING) AS name
  FROM inst WHERE o_orderkey % 6 NOT IN (1, 2, 3) AND patient_id <> ''"""


def _header(t):
    return D.header_of(t("elements"), instance_tasks(t))


def _table(t):
    return t("pseudonyms")


def _with_attributes(t):
    """Header with per-row pseudonym attributes, some of them invalid."""
    keys = spread(t("inst"), INSTANCES_A_TASK).select("sop_instance_uid", "o_orderkey", "o_custkey")
    k, c = F.col("o_orderkey") % 6, F.col("o_custkey")
    return (_header(t).join(keys, "sop_instance_uid")
            .withColumn("pseudonym_pid", F.when(k == 1, " ").otherwise(F.concat(F.lit("PS-"), c.cast("string")))).withColumn("pseudonym_name", F.concat(F.lit("PS^"), c.cast("string")))
            .withColumn("date_shift_text", F.when(k == 2, "abc").when(k == 3, "40000").otherwise(((c % 40) - 20).cast("string"))))


# --- flagship ---------------------------------------------------------------------------------

@query("flagship_route_pseudonymise_shift", f"""SELECT sop_instance_uid, prefix || '-' || postfix AS pseudonym_pid, prefix || '^' || postfix AS pseudonym_name, days, {shifted('da', 'days')} AS study_date,
  CASE WHEN pid IS NULL THEN 'failure' ELSE 'success' END AS route FROM (SELECT * FROM inst WHERE lower(calling_aet) = 'scu_f') i LEFT JOIN ({_PSEUDO}) p ON p.pid = i.patient_id AND i.patient_id <> ''""")
def _(t):
    routed = t("inst").filter(R.calling_title_route("SCU_F") == R.SUCCESS).select("sop_instance_uid", "patient_id", "da")
    out = D.lookup_pseudonyms(routed, _table(t), ["id"])
    return out.select("sop_instance_uid", "pseudonym_pid", "pseudonym_name", "days", F.when(F.col("route") == "success", shift_da("da", F.col("days"))).alias("study_date"), "route")


# --- D ----------------------------------------------------------------------------------------

@query("d1_pseudonym_lookup", f"""SELECT sop_instance_uid, prefix || '-' || postfix AS pseudonym_pid, days, CASE WHEN patient_id = '' THEN 'PID is not found' WHEN pid IS NULL THEN 'No results found' END AS error_message
FROM inst i LEFT JOIN ({_PSEUDO}) p ON p.pid = i.patient_id""")
def _(t):
    return D.lookup_pseudonyms(t("inst").select("sop_instance_uid", "patient_id"), _table(t), ["id"]).select("sop_instance_uid", "pseudonym_pid", "days", "error_message")


_NAMED_ACTION = """CASE WHEN keyword IN ('TimezoneOffsetFromUTC') THEN 'X' WHEN keyword IN ('StudyDate', 'StudyTime', 'AccessionNumber', 'PatientName', 'PatientID', 'ReferringPhysicianName', 'ReferencedStudySequence') THEN 'Z'
  WHEN keyword IN ('InstitutionName', 'DeviceSerialNumber', 'DeviceLabel', 'ContentDate', 'AcquisitionDateTime', 'FrameAcquisitionDateTime') THEN 'D'
  WHEN keyword IN ('SOPInstanceUID', 'StudyInstanceUID', 'SeriesInstanceUID', 'FrameOfReferenceUID', 'ReferencedSOPInstanceUID') THEN 'U' END"""


_REMOVED = "'OverlayData', 'PatientAge', 'RequestAttributesSequence', 'ScheduledProcedureStepID', 'RTReferencedStudySequence', 'RTReferencedSeriesSequence', 'SeriesDate'"


@query("d2_action_join", f"SELECT keyword, CASE WHEN keyword IN ({_REMOVED}) THEN 'X' ELSE {_NAMED_ACTION} END AS action, count(*) AS n FROM elements GROUP BY 1, 2")
def _(t):
    e = t("elements")
    return D.join_actions(e, A.default_actions(e.sparkSession)).groupBy("keyword", "action").agg(F.count(F.lit(1)).alias("n"))


@query("d3_manifest_join", """SELECT sop_instance_uid, CASE WHEN o_orderkey % 23 = 0 THEN 'Missing manifest entry' WHEN o_orderkey % 11 = 0 THEN 'Pseudonym SOP Instance UID mismatch' WHEN o_orderkey % 13 = 0 THEN 'Missing ZIP fragment index/count'
  WHEN o_orderkey % 17 = 0 THEN 'Invalid ZIP fragment index/count' WHEN o_orderkey % 19 = 0 THEN 'ZIP filename does not match pseudonym SOP UID' END AS error_message,
  CASE WHEN o_orderkey % 23 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0 THEN o_orderkey % 5 END AS fragment_index FROM inst""")
def _(t):
    i = t("inst").select(F.col("o_custkey").cast("string").alias("order_id"), F.concat(F.lit("R"), F.col("o_custkey").cast("string")).alias("retrieve_id"),
                         F.col("sop_instance_uid").alias("original_sop_uid"), F.concat(F.lit("p."), "sop_instance_uid").alias("sop_instance_uid"))
    return packages.join_manifest(i, t("manifest")).select(F.col("original_sop_uid").alias("sop_instance_uid"), "error_message", F.col("fragment_index").cast("bigint").alias("fragment_index"))


@query("d4_dictionary_join", "SELECT keyword, count(*) AS n FROM elements WHERE keyword <> '' AND keyword <> 'Modality' GROUP BY keyword")
def _(t):
    e = t("elements")
    known = sorted({(a[2], a[1], a[3]) for a in ATTRIBUTES if a[2] and a[2] != "Modality"})
    dictionary = e.sparkSession.createDataFrame(known, "keyword string, dict_tag string, dict_vr string")
    return D.join_dictionary(e, dictionary).filter("tag = dict_tag AND vr = dict_vr").groupBy("keyword").agg(F.count(F.lit(1)).alias("n"))


_REQ = f"""SELECT request_id, trim(split_part(content, ',', 1)) AS study_uid, nullif(trim(split_part(content, ',', 2)), '') AS want, NOT {blank("content")} AND trim(split_part(content, ',', 1)) <> '' AS valid FROM requests"""


@query("d5_query_keys", f"SELECT request_id, i.series_uid, i.n FROM ({_REQ}) r JOIN (SELECT study_uid, series_uid, count(*) AS n FROM inst GROUP BY 1, 2) i ON i.study_uid = r.study_uid AND (want IS NULL OR want = i.series_uid) WHERE valid")
def _(t):
    req = find.parsed_requests(t("requests"), find.SERIES).filter("route = 'success'")
    return find.matched(req, find.series_matches(t("inst")), ["study_uid"], "series_uid").select("request_id", "series_uid", F.col("series_related_instances").alias("n"))


@query("d6_retrieval_requests", f"SELECT sop_instance_uid FROM inst WHERE study_uid IN (SELECT study_uid FROM ({_REQ}) WHERE valid)")
def _(t):
    req = find.parsed_requests(t("requests"), find.SERIES).filter("route = 'success'")
    return find.requested_instances(t("inst"), req, find.STUDY).select("sop_instance_uid")


@query("d7_region_join", "SELECT CAST(doc_id AS STRING) AS sop_instance_uid, 0 AS frame_no, CASE WHEN doc_id % 3 < 2 THEN CAST(doc_id % 3 AS INT) + 1 END AS n FROM documents")
def _(t):
    from scanloom.functions.pixels import region_list
    f = t("frames").drop("pixels").withColumn("device", F.col("sop_instance_uid").cast("bigint") % 3)
    rules = f.sparkSession.createDataFrame([(0, "[0,0,-1,1]"), (1, "[1,0,2,1],[0,1,4,2]")], "device bigint, region_text string").withColumn("regions", region_list("region_text"))
    return masking.join_regions(f, rules, ["device"]).select("sop_instance_uid", "frame_no", F.when(F.col("regions").isNotNull(), F.size("regions")).alias("n"))


@query("d8_correlation", """SELECT o_orderkey, coalesce(lower(order_id) = lower(CASE WHEN o_orderkey % 5 = 0 THEN order_id ELSE upper(order_id) END), false) AND o_orderkey % 3 <> 0 AS same_ignoring_case,
  coalesce(order_id = CASE WHEN o_orderkey % 5 = 0 THEN order_id ELSE upper(order_id) END, false) AND o_orderkey % 3 <> 0 AS same FROM retrievals""")
def _(t):
    k = F.col("o_orderkey")
    r = t("retrievals").withColumn("p_order", F.when(k % 5 == 0, F.col("order_id")).otherwise(F.upper("order_id"))).withColumn("p_retrieve", F.when(k % 3 == 0, "other").otherwise(F.col("retrieve_id")))
    ids = ("p_order", "p_retrieve", "order_id", "retrieve_id")
    return r.select("o_orderkey", packages.correlated(*ids, True).alias("same_ignoring_case"), packages.correlated(*ids).alias("same"))


# --- E ----------------------------------------------------------------------------------------

def _plan(*rows, profile=D.Profile()):
    return D.ActionPlan(list(rows), profile)


def _plain_header(t):
    return _header(t).withColumn("days", F.lit(None).cast("int"))


def _counts(df):
    return shown(df).groupBy("path", "tag").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("filled"))


_PLACED = "WHEN path = '' AND keyword IN ('StudyInstanceUID', 'SeriesInstanceUID') THEN 'x'"


@query("e1_remove", f"SELECT path, tag, count(*) AS n, count(value) AS filled FROM elements WHERE NOT {_STRIPPED} AND keyword NOT IN ('PatientAge', 'RequestAttributesSequence') AND path NOT LIKE '00400275:%' AND NOT (keyword = 'SeriesDate' AND o_orderkey % 9 = 6) GROUP BY 1, 2")
def _(t):
    plan = _plan(("PatientAge", "X", "base"), ("RequestAttributesSequence", "X", "base"))
    return _counts(D.apply_rules(t("elements"), _plain_header(t), plan))


@query("e2_empty", f"SELECT path, tag, count(*) AS n, count(CASE WHEN keyword NOT IN ('PatientName', 'ReferencedStudySequence') THEN value END) AS filled FROM elements WHERE NOT {_STRIPPED} AND path NOT LIKE '00081110:%' AND NOT (keyword = 'SeriesDate' AND o_orderkey % 9 = 6) GROUP BY 1, 2")
def _(t):
    plan = _plan(("PatientName", "Z", "base"), ("ReferencedStudySequence", "Z", "base"))
    return _counts(D.apply_rules(t("elements"), _plain_header(t), plan))


_DUMMY = {"StudyDate": "19991111", "AcquisitionDateTime": "19991111111111", "StudyTime": "111111", "PatientAge": "0", "Rows": "0", "InstitutionName": "REMOVED", "PatientName": "REMOVED"}


@query("e3_dummy", f"SELECT keyword, CASE keyword {' '.join(f'WHEN {k!r} THEN {v!r}' for k, v in _DUMMY.items())} END AS value, count(*) AS n FROM elements WHERE keyword IN ({', '.join(repr(k) for k in _DUMMY)}) GROUP BY 1, 2")
def _(t):
    plan = _plan(*[(k, "D", "base") for k in _DUMMY])
    out = D.apply_rules(t("elements"), _plain_header(t), plan).filter(F.col("keyword").isin(list(_DUMMY)))
    return out.select("keyword", value_text()).groupBy("keyword", "value").agg(F.count(F.lit(1)).alias("n"))


@query("e4_uid_replacement", f"""SELECT sop_instance_uid, path, tag, 'UI' AS vr, {remapped('split_part(value, chr(92), 1)')} || CASE WHEN contains(value, chr(92)) THEN chr(92) || {remapped('split_part(value, chr(92), 2)')} ELSE '' END AS value
FROM elements WHERE keyword IN ('FrameOfReferenceUID', 'SOPInstanceUID', 'ReferencedSOPInstanceUID')""")
def _(t):
    plan = _plan(*[(k, "U", "base") for k in ("FrameOfReferenceUID", "SOPInstanceUID", "ReferencedSOPInstanceUID")])
    return shown(D.apply_rules(t("elements"), _plain_header(t), plan).filter(F.col("keyword").isin("FrameOfReferenceUID", "SOPInstanceUID", "ReferencedSOPInstanceUID")))


@query("e5_strip_groups", f"SELECT tag, count(*) AS n FROM elements WHERE NOT {_STRIPPED} GROUP BY tag")
def _(t):
    return t("elements").filter(~F.expr(D.stripped_group("tag"))).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


@query("e6_nested_rules", "SELECT sop_instance_uid, path, tag, '19991111111111' AS value FROM elements WHERE keyword = 'FrameAcquisitionDateTime'")
def _(t):
    out = D.apply_rules(t("elements"), _plain_header(t), D.ActionPlan.default())
    return shown(out.filter(F.col("keyword") == "FrameAcquisitionDateTime")).drop("vr")


@query("e7_profile_options", f"""SELECT keyword, count(*) AS n,
  CASE WHEN keyword IN ('StudyDate', 'StudyTime', 'ContentDate', 'AcquisitionDateTime', 'FrameAcquisitionDateTime', 'SeriesDate') THEN NULL WHEN keyword IN ('OverlayData', '', 'PatientAge', 'RequestAttributesSequence', 'ScheduledProcedureStepID', 'RTReferencedStudySequence', 'RTReferencedSeriesSequence') THEN 'X' ELSE {_NAMED_ACTION} END AS modified,
  CASE WHEN keyword IN ('StudyDate', 'StudyTime', 'ContentDate', 'AcquisitionDateTime', 'FrameAcquisitionDateTime', 'SeriesDate', 'TimezoneOffsetFromUTC', 'DeviceLabel') THEN NULL WHEN keyword IN ('DeviceSerialNumber', 'InstitutionName', 'ReferencedStudySequence') THEN NULL
    WHEN keyword IN ('SOPInstanceUID', 'StudyInstanceUID', 'SeriesInstanceUID', 'FrameOfReferenceUID', 'ReferencedSOPInstanceUID') THEN NULL
    WHEN keyword IN ('OverlayData', '', 'PatientAge', 'RequestAttributesSequence', 'ScheduledProcedureStepID', 'RTReferencedStudySequence', 'RTReferencedSeriesSequence') THEN 'X' ELSE {_NAMED_ACTION} END AS retaining
FROM elements GROUP BY keyword""")
def _(t):
    modified = D.ActionPlan.default(D.Profile(dates="modified"))
    retaining = D.ActionPlan.default(D.Profile(True, True, True, "full"))
    both = D.annotate_actions(t("elements"), modified).withColumnRenamed("action", "modified")
    both = D.annotate_actions(both, retaining).withColumnRenamed("action", "retaining")
    return both.groupBy("keyword", "modified", "retaining").agg(F.count(F.lit(1)).alias("n"))


@query("e8_patient_id_hash", f"SELECT sop_instance_uid, {uuid_text('patient_id')} AS value FROM inst WHERE patient_id <> ''")
def _(t):
    rows = D.generated_rows(_plain_header(t), D.Profile(patient_id_hash=True), None)
    return rows.filter("keyword = 'PatientID'").select("sop_instance_uid", value_text())


@query("e9_pet_correction", f"SELECT {remapped('sop_instance_uid')} AS sop_instance_uid, '19991111' AS series_date, '111111' AS series_time FROM inst WHERE sop_class_uid = '1.2.840.10008.5.1.4.1.1.128'")
def _(t):
    out = D.anonymise(t("elements"), _header(t)).filter(at_root() & F.col("keyword").isin("SeriesDate", "SeriesTime"))
    first = F.get("values", F.lit(0))
    return out.groupBy("sop_instance_uid").agg(F.max(F.when(F.col("keyword") == "SeriesDate", first)).alias("series_date"), F.max(F.when(F.col("keyword") == "SeriesTime", first)).alias("series_time"))


@query("e10_markers", f"SELECT path, tag, vr, value, count(*) AS n FROM ({_marks_sql(_LOOKED_UP, None, False)}) GROUP BY ALL")
def _(t):
    good = D.lookup_pseudonyms(_header(t), _table(t), ["id"]).filter("route = 'success'").drop("pseudonym_pid", "pseudonym_name")
    return shown(D.generated_rows(good, D.Profile(), None)).groupBy("path", "tag", "vr", "value").agg(F.count(F.lit(1)).alias("n"))


_RETAIN = ("StudyDate", "PatientAge", "SOPInstanceUID", "ImageType", "RTReferencedStudySequence")


@query("e11_retain_tags", _digest_sql(_deid_sql(_NO_SHIFT, retain=_RETAIN), moved=False))
def _(t):
    return digests(D.deidentify(t("elements"), _plain_header(t), retain=", ".join(_RETAIN) + ", UnknownName"), instance_tasks(t))


@query("e12_study_series_remap", f"SELECT sop_instance_uid, {remapped('study_uid')} AS new_study_uid, {remapped('series_uid')} AS new_series_uid, sop_instance_uid AS new_sop_instance_uid FROM inst")
def _(t):
    return D.result_uids(_header(t), retain="StudyInstanceUID, SOPInstanceUID").select("sop_instance_uid", "new_study_uid", "new_series_uid", "new_sop_instance_uid")


@query("e13_issuer", "SELECT value, count(*) AS n FROM (SELECT 'SITE-A' AS value FROM inst) GROUP BY value")
def _(t):
    rows = D.generated_rows(_plain_header(t), D.Profile(), "SITE-A").filter("keyword = 'IssuerOfPatientID'")
    return rows.select(value_text()).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query("e14_identity_by_lookup", f"SELECT {remapped('sop_instance_uid')} AS sop_instance_uid, pid AS patient_id, name AS patient_name FROM ({_LOOKED_UP})")
def _(t):
    out = D.pseudonymise_by_lookup(t("elements"), _header(t), _table(t), order=["id"]).filter(at_root() & F.col("keyword").isin("PatientID", "PatientName"))
    first = F.get("values", F.lit(0))
    return out.groupBy("sop_instance_uid").agg(F.max(F.when(F.col("keyword") == "PatientID", first)).alias("patient_id"), F.max(F.when(F.col("keyword") == "PatientName", first)).alias("patient_name"))


@query("e15_identity_by_attributes", f"SELECT sop_instance_uid, pid AS patient_id, name AS patient_name FROM ({_ATTRIBUTED})")
def _(t):
    good = D.attribute_pseudonym_checks(_with_attributes(t)).filter("route = 'success'")
    rows = D.generated_rows(good, D.Profile(), None)
    first = F.get("values", F.lit(0))
    return (rows.filter(F.col("keyword").isin("PatientID", "PatientName")).groupBy("sop_instance_uid")
            .agg(F.max(F.when(F.col("keyword") == "PatientID", first)).alias("patient_id"), F.max(F.when(F.col("keyword") == "PatientName", first)).alias("patient_name")))


@query("e16_date_shift", f"""SELECT sop_instance_uid, tag, vr, CASE WHEN d = 0 THEN value WHEN vr = 'DA' THEN {shifted('value', 'd')} ELSE {shifted('substr(value, 1, 8)', 'd')} || substr(value, 9) END AS value
FROM (SELECT *, CAST(o_orderkey % 100 AS INT) - 50 AS d FROM loose_elements) WHERE vr IN ('DA', 'DT')""")
def _(t):
    days = (F.substring_index("sop_instance_uid", ".", -1).cast("bigint") % 100 - 50).cast("int")
    e = D.resolve_dates(t("loose_elements")).filter(F.col("vr").isin("DA", "DT")).withColumn("d", days)
    return e.withColumn("values", shifted_values("values", "vr", F.col("d"))).select("sop_instance_uid", "tag", "vr", value_text())


@query("e17_anonymise", _digest_sql(_deid_sql(_NO_SHIFT, "SITE-A")))
def _(t):
    return digests(D.anonymise(t("elements"), _header(t), issuer="SITE-A"), instance_tasks(t))


@query("e17_anonymise_clustered", _digest_sql(_deid_sql(_NO_SHIFT, "SITE-A")))
def _(t):
    """Over tables bucketed by instance: elements are read once and meet the stored index without a shuffle."""
    elements = t("elements")
    spark, run = elements.sparkSession, uuid.uuid4().hex
    buckets = max(8, -(-t("inst").count() // ROWS_A_TASK))  # a bucket is a task of every later query
    for name, rows in (("elements", elements), ("index", D.header_of(elements, instance_tasks(t)))):
        instances.write_clustered(rows, f"{name}_{run}", buckets, path=f"{checkpoint_root(spark)}/{name}-{run}")
    return digests(D.anonymise(spark.table(f"elements_{run}"), spark.table(f"index_{run}"), issuer="SITE-A"))


@query("e18_pseudonymise_by_lookup", _digest_sql(_deid_sql(_LOOKED_UP, "SITE-A", True)))
def _(t):
    return digests(D.pseudonymise_by_lookup(t("elements"), _header(t), _table(t), issuer="SITE-A", order=["id"]), instance_tasks(t))


@query("e19_pseudonymise_by_attributes", _digest_sql(_deid_sql(_ATTRIBUTED, None, True)))
def _(t):
    return digests(D.pseudonymise_by_attributes(t("loose_elements"), _with_attributes(t)), instance_tasks(t))


@query("e19_attribute_checks", """SELECT sop_instance_uid, CASE o_orderkey % 6 WHEN 2 THEN 'Invalid pseudonymization property value' WHEN 1 THEN 'Missing pseudonym PID or name' WHEN 3 THEN 'Invalid date shift'
  ELSE CASE WHEN patient_id = '' THEN 'PID is not found' END END AS error_message FROM inst""")
def _(t):
    return D.attribute_pseudonym_checks(_with_attributes(t)).select("sop_instance_uid", "error_message")


@query("e20_residual_risk", """SELECT DISTINCT keyword, value FROM (SELECT keyword, unnest(string_split(value, chr(92))) AS value FROM elements WHERE keyword IN ('Modality', 'ImageType') AND value IS NOT NULL)
UNION SELECT 'ContentDate', '19991111' WHERE EXISTS (SELECT 1 FROM elements WHERE keyword = 'ContentDate' AND value = '19991111')""")
def _(t):
    e = t("loose_elements")
    return D.surviving_values(e, D.anonymise(e, D.header_of(e, instance_tasks(t))), ["AcquisitionDateTime", "FrameAcquisitionDateTime", "StudyDate", "ContentDate", "StudyInstanceUID", "SOPInstanceUID", "PatientName", "AccessionNumber", "Modality", "ImageType"])
