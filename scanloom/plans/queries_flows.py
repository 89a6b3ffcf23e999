"""Queries of sections I (messages), J (events), K (reference repair), L (masking), M (streams), N (extension)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from scanloom.functions import vocabulary as V
from scanloom.functions.pixels import mask_value, region_list
from scanloom.operators import events as E
from scanloom.operators import hl7, masking, outcomes, rtrepair
from scanloom.operators import routing as R
from scanloom.plans import derived  # noqa: F401
from scanloom.plans.derived import _UUID, EVENT_OPERATOR, EVENT_TIME
from scanloom.plans.queries_deid import path_text, value_text
from scanloom.plans.queries_results import _GATE, _OUTCOME, _RGB, _UUID_RE, _chan
from scanloom.plans.registry import QUERIES, query, table
from scanloom.plans.sqltext import blank, remapped, uuid_text
from scanloom.session import checkpoint_root
from scanloom.streaming import flows

# --- I ----------------------------------------------------------------------------------------

_SEGS = "SELECT msg_id, unnest(s) AS seg, unnest(range(1, len(s) + 1)) AS seg_no FROM (SELECT msg_id, list_filter(string_split(raw, chr(13)), lambda x: x <> '') AS s FROM adt)"
_FIELDS = f"""SELECT msg_id, seg_no, segment, unnest(f) AS fv, unnest(range(0, len(f))) AS field FROM (SELECT msg_id, seg_no, split_part(seg, '|', 1) AS segment,
  CASE WHEN seg LIKE 'MSH|%' THEN list_concat(['MSH', '|'], (string_split(seg, '|'))[2:]) ELSE string_split(seg, '|') END AS f FROM ({_SEGS}))"""
_LIT = "segment = 'MSH' AND field IN (1, 2)"


def _cut(rows: str, name: str, sep: str, number: str, out: str, keep: str) -> str:
    return f"""SELECT {keep}, unnest(l) AS {out}, unnest(range(1, len(l) + 1)) AS {number} FROM (SELECT *, CASE WHEN {_LIT} THEN [{name}] ELSE string_split({name}, '{sep}') END AS l FROM ({rows}))"""


_KEEP = "msg_id, seg_no, segment, field"
_REPS = _cut(f"SELECT * FROM ({_FIELDS}) WHERE field > 0 AND fv <> ''", "fv", "~", "rep", "rv", _KEEP)
_COMPS = _cut(_REPS, "rv", "^", "comp", "cv", _KEEP + ", rep")
_SUBS = _cut(_COMPS, "cv", "&", "sub", "uv", _KEEP + ", rep, comp")


@query("i1_exploded_messages", f"SELECT msg_id, seg_no, segment, field, rep, comp, sub, CASE WHEN {_LIT} THEN uv ELSE replace(uv, chr(92) || 'T' || chr(92), '&') END AS value FROM ({_SUBS}) WHERE uv <> ''")
def _(t):
    return hl7.exploded(t("adt"))


_ADT_FAC = "CASE WHEN c_nationkey = 3 THEN '' ELSE '<MSH.4><HD.1>F' || CAST(c_nationkey AS STRING) || '</HD.1></MSH.4>' END"
_ADT_EVENT = "CASE WHEN msg_id % 3 = 0 THEN 'A01' ELSE 'A04' END"
_ADT_XML = f"""'<ADT_' || {_ADT_EVENT} || ' xmlns="urn:hl7-org:v2xml"><MSH><MSH.1>|</MSH.1><MSH.2>^~' || chr(92) || '&amp;</MSH.2><MSH.3><HD.1>HIS</HD.1></MSH.3>' || {_ADT_FAC} || '<MSH.5><HD.1>RIS</HD.1></MSH.5><MSH.6><HD.1>' || c_mktsegment
  || '</HD.1></MSH.6><MSH.7><TS.1>20200101000000</TS.1></MSH.7><MSH.9><CM_MSG.1>ADT</CM_MSG.1><CM_MSG.2>' || {_ADT_EVENT} || '</CM_MSG.2></MSH.9><MSH.10>C' || CAST(msg_id AS STRING) || '</MSH.10><MSH.11><PT.1>P</PT.1></MSH.11><MSH.12>'
  || CASE WHEN msg_id % 2 = 0 THEN '2.3' ELSE '2.5' END || '</MSH.12></MSH><EVN><EVN.1>A04</EVN.1><EVN.2><TS.1>{EVENT_TIME}</TS.1></EVN.2><EVN.5><CN.2>{EVENT_OPERATOR[0]}</CN.2><CN.3>{EVENT_OPERATOR[1]}</CN.3></EVN.5></EVN><PID><PID.1>1</PID.1><PID.3><CX.1>'
  || CAST(msg_id AS STRING) || '</CX.1><CX.4><HD.1>HD</HD.1></CX.4></PID.3><PID.3><CX.1>X' || CAST(c_nationkey AS STRING) || '</CX.1></PID.3><PID.5><XPN.1>' || split_part(c_name, '#', 1) || '</XPN.1><XPN.2>' || split_part(c_name, '#', 2)
  || '</XPN.2><XPN.3>A&amp;B</XPN.3></PID.5></PID></ADT_' || {_ADT_EVENT} || '>'"""


@query("i2_message_xml", f"SELECT msg_id, {_ADT_XML} AS xml FROM adt")
def _(t):
    return hl7.to_xml_document(t("adt")).select("msg_id", "xml")


def _msh_xml(app: str, facility: str, recv: str, kind: str, event: str, control: str, version: str) -> str:
    """SQL text of the header's XML; the last five are SQL values."""
    return (f"""'<MSH><MSH.1>|</MSH.1><MSH.2>^~' || chr(92) || '&amp;</MSH.2><MSH.3><HD.1>{app}</HD.1></MSH.3><MSH.4><HD.1>{facility}</HD.1></MSH.4><MSH.5><HD.1>RIS</HD.1></MSH.5><MSH.6><HD.1>' || {recv} || '</HD.1></MSH.6>"""
            f"""<MSH.7><TS.1>20200101000000</TS.1></MSH.7><MSH.9><CM_MSG.1>' || {kind} || '</CM_MSG.1><CM_MSG.2>' || {event} || '</CM_MSG.2></MSH.9><MSH.10>' || {control} || '</MSH.10><MSH.11><PT.1>P</PT.1></MSH.11><MSH.12>' || {version} || '</MSH.12></MSH>'""")


def _orm_xml() -> str:
    """The order message rewritten text by text: observations, then order groups, around them the patient."""
    b = "chr(92)"
    obx = "regexp_replace(body, 'OBX[|]1[|]ST[|]([A-Z_]+)[^][A-Z_]+[^]99LOCAL[|][|]([^|]*)[|]+F.', '<@.OBSERVATION><OBX><OBX.1>1</OBX.1><OBX.2>ST</OBX.2><OBX.3><CE.1>' || {b}1 || '</CE.1><CE.2>' || {b}1 || '</CE.2><CE.3>99LOCAL</CE.3></OBX.3><OBX.5>' || {b}2 || '</OBX.5><OBX.11>F</OBX.11></OBX></@.OBSERVATION>', 'gs')"
    obx = obx.replace("[^][A-Z_]+[^]99LOCAL", "' || chr(92) || '^[A-Z_]+' || chr(92) || '^99LOCAL").replace("{b}1", f"{b} || '1'").replace("{b}2", f"{b} || '2'")
    orc = f"regexp_replace({obx}, 'ORC[|]NW[|]([0-9]+-[0-9])' || chr(13) || 'OBR[|]([0-9])' || chr(13), '</@.ORDER_DETAIL></@.ORDER><@.ORDER><ORC><ORC.1>NW</ORC.1><ORC.2><EI.1>' || {b} || '1</EI.1></ORC.2></ORC><@.ORDER_DETAIL><OBR><OBR.1>' || {b} || '2</OBR.1></OBR>', 'g')"
    orders = f"replace(substr({orc}, length('</@.ORDER_DETAIL></@.ORDER>') + 1), {b} || 'S' || {b}, '^') || '</@.ORDER_DETAIL></@.ORDER>'"
    head = _msh_xml("HIS", "F", "'R'", "'ORM'", "'O01'", "'C' || CAST(o_orderkey AS STRING)", "CASE WHEN o_orderkey % 12 = 0 THEN '2.3' ELSE '2.5' END")
    patient = "'<@.PATIENT><PID><PID.3><CX.1>' || CAST(o_custkey AS STRING) || '</CX.1><CX.4><HD.1>X</HD.1></CX.4></PID.3></PID></@.PATIENT>'"
    return f"""SELECT msg_id, replace('<@ xmlns="urn:hl7-org:v2xml">' || {head} || {patient} || {orders} || '</@>', '@', 'ORM_O01') AS xml FROM (SELECT *, substr(raw, strpos(raw, 'ORC|')) AS body FROM orm)"""


@query("i2_order_xml", _orm_xml())
def _(t):
    return hl7.to_xml_document(t("orm")).select("msg_id", "xml")


_ORU_XML = f"""SELECT msg_id, replace(replace('<ORU_R01 xmlns="urn:hl7-org:v2xml">' || {_msh_xml("LAB", "F", "'R'", "'ORU'", "'R01'", "'C' || CAST(o_orderkey AS STRING)", "CASE WHEN o_orderkey % 2 = 0 THEN '2.3' ELSE '2.5' END")}
  || '<@.$><@.PATIENT><PID><PID.3><CX.1>' || CAST(o_custkey AS STRING) || '</CX.1><CX.4><HD.1>X</HD.1></CX.4></PID.3></PID><@.VISIT><PV1><PV1.2>' || o_orderstatus || '</PV1.2></PV1></@.VISIT></@.PATIENT>'
  || '<@.ORDER_OBSERVATION><OBR><OBR.1>1</OBR.1></OBR><@.OBSERVATION><OBX><OBX.1>1</OBX.1><OBX.2>NM</OBX.2><OBX.3><CE.1>A</CE.1></OBX.3><OBX.5>' || CAST(o_custkey AS STRING) || '</OBX.5></OBX><NTE><NTE.1>1</NTE.1><NTE.3>' || o_orderpriority || '</NTE.3></NTE></@.OBSERVATION>'
  || '<@.OBSERVATION><OBX><OBX.1>2</OBX.1><OBX.2>CE</OBX.2><OBX.3><CE.1>B</CE.1></OBX.3><OBX.5><CE.1>' || o_orderstatus || '</CE.1><CE.2>' || o_orderpriority || '</CE.2></OBX.5></OBX></@.OBSERVATION></@.ORDER_OBSERVATION>'
  || '<@.ORDER_OBSERVATION><ORC><ORC.1>RE</ORC.1></ORC><OBR><OBR.1>2</OBR.1></OBR><ZZ1><ZZ1.1>own</ZZ1.1></ZZ1>'
  || CASE WHEN o_orderkey % 3 = 0 THEN '<@.SPECIMEN><SPM><SPM.1>1</SPM.1></SPM><OBX><OBX.1>1</OBX.1><OBX.2>ST</OBX.2><OBX.3><CE.1>C</CE.1></OBX.3><OBX.5>x</OBX.5></OBX></@.SPECIMEN>' ELSE '' END
  || '</@.ORDER_OBSERVATION></@.$></ORU_R01>', '@', 'ORU_R01'), '$', CASE WHEN o_orderkey % 2 = 0 THEN 'RESPONSE' ELSE 'PATIENT_RESULT' END) AS xml FROM oru"""


@query("i2_result_xml", _ORU_XML)
def _(t):
    return hl7.to_xml_document(t("oru")).select("msg_id", "xml")


def _json_lines(*parts) -> str:
    """SQL text of a pretty JSON object from (depth, name, SQL text value or bracket) lines; commas are in the values."""
    out = ["'{'"]
    for depth, name, value in parts:
        out.append(f"chr(10) || '{'  ' * depth}' || " + (f"""'"{name}": ' || """ if name else "") + value)
    return " || ".join([*out, "chr(10) || '}'"])


def _quoted(value: str, comma: bool = True) -> str:
    return f"""'"' || {value} || '"{',' if comma else ''}'"""


def _one(depth: int, name: str, inner: str, value: str) -> list:
    return [(depth, name, "'{'"), (depth + 1, inner, _quoted(value, False)), (depth, "", "'},'")]


_HAS_FACILITY = "c_nationkey <> 3"
_ADT_JSON = _json_lines(
    (1, "MSH", "'{'"), (2, "MSH.1", _quoted("'|'")), (2, "MSH.2", _quoted("'^~' || chr(92) || chr(92) || '&'")), *_one(2, "MSH.3", "HD.1", "'HIS'"),
    (2, "MSH.4", f"""'{{' || chr(10) || '      "HD.1": "F' || CAST(c_nationkey AS STRING) || '"' || chr(10) || '    }},'"""),
    *_one(2, "MSH.5", "HD.1", "'RIS'"), *_one(2, "MSH.6", "HD.1", "c_mktsegment"), *_one(2, "MSH.7", "TS.1", "'20200101000000'"),
    (2, "MSH.9", "'{'"), (3, "CM_MSG.1", _quoted("'ADT'")), (3, "CM_MSG.2", _quoted(_ADT_EVENT, False)), (2, "", "'},'"), (2, "MSH.10", _quoted("'C' || CAST(msg_id AS STRING)")),
    *_one(2, "MSH.11", "PT.1", "'P'"), (2, "MSH.12", _quoted("CASE WHEN msg_id % 2 = 0 THEN '2.3' ELSE '2.5' END", False)), (1, "", "'},'"),
    (1, "EVN", "'{'"), (2, "EVN.1", _quoted("'A04'")), *_one(2, "EVN.2", "TS.1", f"'{EVENT_TIME}'"),
    (2, "EVN.5", "'{'"), (3, "CN.2", _quoted(f"'{EVENT_OPERATOR[0]}'")), (3, "CN.3", _quoted(f"'{EVENT_OPERATOR[1]}'", False)), (2, "", "'}'"), (1, "", "'},'"),
    (1, "PID", "'{'"), (2, "PID.1", _quoted("'1'")), (2, "PID.3", "'['"), (3, "", "'{'"), (4, "CX.1", _quoted("CAST(msg_id AS STRING)")), (4, "CX.4", "'{'"), (5, "HD.1", _quoted("'HD'", False)), (4, "", "'}'"), (3, "", "'},'"),
    (3, "", "'{'"), (4, "CX.1", _quoted("'X' || CAST(c_nationkey AS STRING)", False)), (3, "", "'}'"), (2, "", "'],'"),
    (2, "PID.5", "'{'"), (3, "XPN.1", _quoted("split_part(c_name, '#', 1)")), (3, "XPN.2", _quoted("split_part(c_name, '#', 2)")), (3, "XPN.3", _quoted("'A&B'", False)), (2, "", "'}'"), (1, "", "'}'"))
_NO_FACILITY = """chr(10) || '    "MSH.4": {' || chr(10) || '      "HD.1": "F3"' || chr(10) || '    },'"""


@query("i3_message_json", f"""SELECT msg_id, 'C' || CAST(msg_id AS STRING) AS control_id, 'A&B' AS third, 'X' || CAST(c_nationkey AS STRING) AS second_id,
  CASE WHEN {_HAS_FACILITY} THEN {_ADT_JSON} ELSE replace({_ADT_JSON}, {_NO_FACILITY}, '') END AS json FROM adt""")
def _(t):
    j = hl7.to_json_document(t("adt")).select("msg_id", "json")
    return j.select("msg_id", F.get_json_object("json", "$.MSH['MSH.10']").alias("control_id"), F.get_json_object("json", "$.PID['PID.5']['XPN.3']").alias("third"),
                    F.get_json_object("json", "$.PID['PID.3'][1]['CX.1']").alias("second_id"), "json")


@query("i4_xml_to_message", "SELECT msg_id, raw FROM adt")
def _(t):
    xml = hl7.to_xml_document(t("adt")).select("msg_id", "xml")
    return hl7.from_xml_document(xml, "xml", "raw").select("msg_id", "raw")


@query("i4_order_round_trip", "SELECT msg_id, raw FROM orm")
def _(t):
    xml = hl7.to_xml_document(t("orm")).select("msg_id", "xml")
    return hl7.from_xml_document(xml, "xml", "raw").select("msg_id", "raw")


_ORM_ERROR = """CASE WHEN o_orderkey % 12 = 0 THEN 'Expected HL7 v2.5 ORM^O01 message' WHEN o_orderkey % 11 = 0 THEN 'Expected exactly one distinct value for PROJECT_ID, found 2: [' || o_orderpriority || ', OTHER]'
  WHEN o_orderkey % 10 = 4 THEN 'Invalid DATE_SHIFT_DAYS: outside +/-36500 days' WHEN o_orderkey % 10 = 6 THEN 'DELIVERY_AET is not allowed for DOWNLOAD' END"""
_CUST_TEXT = "CAST(o_custkey AS STRING)"
_ORM_ORDER = ["study_order_id", "order_id", "project_id", "pseudonym_pid", "pseudonym_name", "source_pacs", "destination_aet", "study_uid", "requester", "requester_email", "delivery_aet", "delivery_host", "delivery_port",
              "delivery_directory", "delivery_folder", "delivery_type", "date_shift_days", "patient_id", "series_uid", "content", "mime_type"]


def _orm_rows(n: int, series: str, where: str = "true") -> str:
    def second(rest: int, value: str, other: str = "NULL") -> str:
        return f"CASE WHEN o_orderkey % 10 = {rest} THEN {value} ELSE {other} END" if n == 2 else other

    study = f"'1.2.840.99.2.' || {_CUST_TEXT} || '.{n}'"
    values = {
        "study_order_id": f"CAST(o_orderkey AS STRING) || '-{n}'", "order_id": _UUID.format("o_orderkey"), "project_id": "o_orderpriority", "pseudonym_pid": f"'PS-' || {_CUST_TEXT}", "pseudonym_name": f"'PS^' || {_CUST_TEXT}",
        "source_pacs": "'PACS'", "destination_aet": "'PORTAL'", "study_uid": study, "requester": "'user'", "requester_email": "'mail'", "delivery_aet": second(7, f"'AE' || {_CUST_TEXT}"), "delivery_host": second(7, "'pacs.example.org'"),
        "delivery_port": second(7, "'104'"), "delivery_directory": second(5, "'disk'"), "delivery_folder": second(5, "'cohort'"), "delivery_type": second(5, "'DIRECTORY'", second(7, "'DICOM_STORE'", "'DOWNLOAD'")),
        "date_shift_days": f"CAST({second(3, '7')} AS INT)", "patient_id": _CUST_TEXT, "series_uid": series, "content": f"{study} || ',' || {series}", "mime_type": "'text/csv'"}
    columns = ", ".join(f"{values[c]} AS {c}" for c in _ORM_ORDER)
    return f"SELECT msg_id, 'success' AS route, NULL AS error_message, 'C' || CAST(o_orderkey AS STRING) AS message_control_id, {columns} FROM orm WHERE ({_ORM_ERROR}) IS NULL AND {where}"


_SERIES = "'1.2.840.99.3.' || CAST(o_custkey AS STRING) || '.{}.1'"


@query("i5_order_extraction", f"""{_orm_rows(1, _SERIES.format(1))} UNION ALL {_orm_rows(1, "'1.2.840.99.3.7'", 'o_orderkey % 4 = 1')} UNION ALL {_orm_rows(2, _SERIES.format(2))}
UNION ALL SELECT msg_id, 'failure', {_ORM_ERROR}, 'C' || CAST(o_orderkey AS STRING), {", ".join(["NULL"] * len(_ORM_ORDER))} FROM orm WHERE ({_ORM_ERROR}) IS NOT NULL""")
def _(t):
    return hl7.extract_orders(t("orm"))


@query("i6_structure_guard", "SELECT msg_id, msg_id % 3 <> 0 AND msg_id % 2 = 0 AS accepted FROM adt")
def _(t):
    return t("adt").withColumn("_s", hl7.segments("raw")).select("msg_id", hl7.is_structure("_s", "ADT", "A04", "2.3").alias("accepted"))


# --- J ----------------------------------------------------------------------------------------

def _js(*pairs) -> str:
    """JSON object text from (name, SQL value, quoted) with NULL written as null."""
    parts = [f"""'"{n}":' || coalesce({"'" + chr(34) + "' || " + v + " || '" + chr(34) + "'" if q else f"CAST({v} AS STRING)"}, 'null')""" for n, v, q in pairs]
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


_RETRIEVED = _js(("eventId", uuid_text("order_id || '|' || retrieve_id || '|SERIES_RETRIEVED'"), True), ("eventType", "'SERIES_RETRIEVED'", True), ("studyInstanceUid", "study_uid", True), ("seriesInstanceUid", "series_uid", True),
                 ("retrieveId", "retrieve_id", True), ("expectedInstances", "coalesce(expected, find_count_instances)", False), ("retrievedInstances", "completed", False), ("completedInstances", "'0'", False), ("failedInstances", "failed", False),
                 ("warningInstances", "warning", False), ("cgetStatus", "upper(trim(status))", True))


@query("j1_series_retrieved", f"SELECT o_orderkey, CASE WHEN ({_GATE}) IS NULL THEN {_RETRIEVED} END AS body FROM retrievals")
def _(t):
    return E.series_retrieved(t("retrievals")).select("o_orderkey", E.event_json().alias("body"))


_FAILED_MESSAGE = f"coalesce(nullif(concat_ws(' | ', get_error, error_comment, CASE WHEN NOT {blank('result_error')} THEN result_error END), ''), 'C-GET failed without details')"
_FAILED_OK = f"NOT {blank('order_id')} AND series_uid IS NOT NULL AND regexp_full_match(trim(order_id), '{_UUID_RE}')"
_FAILED = _js(("eventId", uuid_text("order_id || '|' || retrieve_id || '|SERIES_RETRIEVE_FAILED'"), True), ("eventType", "'SERIES_RETRIEVE_FAILED'", True), ("studyInstanceUid", "study_uid", True), ("seriesInstanceUid", "series_uid", True),
              ("retrieveId", "retrieve_id", True), ("expectedInstances", "coalesce(expected, find_count_instances)", False), ("retrievedInstances", "completed", False), ("failedInstances", "failed", False), ("warningInstances", "warning", False),
              ("cgetStatus", "CASE WHEN regexp_full_match(upper(trim(status)), '[0-9A-F]{4}') THEN upper(trim(status)) END", True), ("message", _FAILED_MESSAGE, True))


@query("j2_series_failed", f"SELECT o_orderkey, CASE WHEN {_FAILED_OK} THEN {_FAILED} END AS body, 'C-GET' AS failed_source FROM retrievals")
def _(t):
    return E.series_retrieve_failed(t("retrievals")).select("o_orderkey", E.event_json().alias("body"), "failed_source")


def _correlated(t):
    k = F.col("o_orderkey")
    ids = F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(F.col("o_custkey").cast("string"), 12, "0"))
    return t("inst").withColumn("order_id", F.when(k % 19 == 0, " ").otherwise(ids)).withColumn("retrieve_id", ids)


_IDS = _UUID.format("o_custkey")
_INSTANCE = [("retrieveId", _IDS, True), ("studyInstanceUid", "study_uid", True), ("seriesInstanceUid", "series_uid", True)]


def _eid(kind: str, original: str) -> str:
    return uuid_text(f"{_IDS} || '|' || {_IDS} || '|' || {original} || '|{kind}'")


@query("j3_instance_completed", f"""SELECT sop_instance_uid, unnest(CASE WHEN o_orderkey % 19 = 0 THEN ['original'] ELSE ['instance-event', 'dicom'] END) AS callback_type,
  unnest(CASE WHEN o_orderkey % 19 = 0 THEN [NULL] ELSE [{_js(('eventId', _eid('INSTANCE_COMPLETED', 'sop_instance_uid'), True), ('eventType', "'INSTANCE_COMPLETED'", True), *_INSTANCE, ('originalSopInstanceUid', 'sop_instance_uid', True), ('pseudonymSopInstanceUid', "'p.' || sop_instance_uid", True))}, NULL] END) AS body FROM inst""")
def _(t):
    df = _correlated(t).withColumn("original_sop_uid", F.col("sop_instance_uid")).withColumn("sop_instance_uid", F.concat(F.lit("p."), "sop_instance_uid"))
    return E.instance_completed(df).select(F.col("original_sop_uid").alias("sop_instance_uid"), "callback_type", E.event_json().alias("body"))


_CODE = "CASE o_orderkey % 5 WHEN 0 THEN 'STORE_FAILED' WHEN 1 THEN 'MASK_UNSUPPORTED' WHEN 2 THEN 'MASK_FAILED' WHEN 3 THEN 'PSEUDONYMIZE_FAILED' ELSE 'PROCESSING_FAILED' END"
_TEXT = """CASE o_orderkey % 5 WHEN 0 THEN 'DICOM C-STORE an AE1 fehlgeschlagen (STORE_REJECTED, Status A700): reason' WHEN 1 THEN 'Pixelmaskierung nicht anwendbar: single' WHEN 2 THEN 'Pixelmaskierung fehlgeschlagen: mask'
  WHEN 3 THEN 'Pseudonymisierung fehlgeschlagen: pid' ELSE 'Instanzverarbeitung fehlgeschlagen' END"""


@query("j4_instance_failed", f"""SELECT sop_instance_uid, CASE WHEN o_orderkey % 19 <> 0 THEN {_js(('eventId', _eid('INSTANCE_FAILED', 'sop_instance_uid'), True), ('eventType', "'INSTANCE_FAILED'", True), *_INSTANCE, ('originalSopInstanceUid', 'sop_instance_uid', True),
  ('pseudonymSopInstanceUid', 'CAST(NULL AS STRING)', True), ('errorCode', _CODE, True), ('errorMessage', _TEXT, True))} END AS body, CASE WHEN o_orderkey % 19 <> 0 THEN {_IDS} || ':' || {_IDS} END AS batch_group FROM inst""")
def _(t):
    k = F.col("o_orderkey") % 5
    df = (_correlated(t).withColumn("store_error_code", F.when(k == 0, "STORE_REJECTED")).withColumn("store_status", F.when(k == 0, "A700")).withColumn("store_error", F.lit("reason")).withColumn("delivery_aet", F.lit("AE1"))
          .withColumn("mask_unsupported", F.when(k <= 1, "single")).withColumn("mask_error", F.when(k <= 2, "mask")).withColumn("pseudonymizer_error", F.when(k <= 3, "pid")))
    return E.instance_failed(df).select("sop_instance_uid", E.event_json().alias("body"), "batch_group")


@query("j5_instance_skipped", f"""SELECT sop_instance_uid, CASE WHEN o_orderkey % 19 <> 0 THEN {_js(('eventId', _eid('INSTANCE_SKIPPED', 'sop_instance_uid'), True), ('eventType', "'INSTANCE_SKIPPED'", True), *_INSTANCE, ('originalSopInstanceUid', 'sop_instance_uid', True), ('pseudonymSopInstanceUid', 'CAST(NULL AS STRING)', True))} END AS body FROM inst""")
def _(t):
    return E.instance_skipped(_correlated(t)).select("sop_instance_uid", E.event_json().alias("body"))


@query("j6_package_failures", f"""SELECT sop_instance_uid, CASE WHEN o_orderkey % 19 <> 0 THEN CASE o_orderkey % 5 WHEN 0 THEN 'BAD_CODE' WHEN 1 THEN 'MANIFEST_HTTP_404' WHEN 2 THEN 'MANIFEST_UNREACHABLE' WHEN 3 THEN 'ZIP_INCOMPLETE' END END AS code,
  CASE WHEN o_orderkey % 19 <> 0 THEN CASE o_orderkey % 5 WHEN 0 THEN 'text' WHEN 1 THEN 'ZIP manifest request failed: Not Found' WHEN 2 THEN 'X: refused' WHEN 3 THEN 'Series ZIP not created: not all 12 fragments arrived within Max Bin Age (Create Series ZIP)' END END AS message,
  CASE WHEN o_orderkey % 19 = 0 OR o_orderkey % 5 = 4 THEN 'failure' ELSE 'success' END AS route FROM inst""")
def _(t):
    k = F.col("o_orderkey") % 5
    df = (_correlated(t).withColumn("zip_error_code", F.when(k == 0, "bad code")).withColumn("zip_error_message", F.lit("text")).withColumn("http_status", F.when(k <= 1, "404").otherwise("200")).withColumn("http_message", F.lit("Not Found"))
          .withColumn("exception_class", F.when(k <= 2, "X")).withColumn("exception_message", F.lit("refused")).withColumn("fragment_count", F.when(k <= 3, "12")))
    return E.package_failures(df).select("sop_instance_uid", F.col("event.errorCode").alias("code"), F.col("event.errorMessage").alias("message"), "route")


@query("j7_batch_keys", "SELECT order_id || ':' || retrieve_id AS batch_group, count(*) AS n FROM retrievals GROUP BY 1")
def _(t):
    return t("retrievals").groupBy(E.batch_key().alias("batch_group")).agg(F.count(F.lit(1)).alias("n"))


@query("j8_event_ids", f"SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'stored-' || CAST(event_id AS STRING) ELSE {uuid_text("CAST(user_id AS STRING) || '|' || event_type")} END AS id FROM events")
def _(t):
    from scanloom.functions.identifiers import event_id
    stored = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("stored-"), F.col("event_id").cast("string"))).otherwise(" ")
    return t("events").select("event_id", event_id(stored, F.col("user_id").cast("string"), "event_type").alias("id"))


@query("j9_store_results", f"""SELECT batch_id, pos, status AS raw_status, message AS raw_message, CASE WHEN o <> 'FAILED' OR status >= 0 THEN printf('%04X', status & 65535) END AS store_status, CASE WHEN o = 'WARNING' THEN message END AS store_warning, CASE WHEN o = 'FAILED' THEN error_code END AS store_error_code,
  CASE WHEN o = 'FAILED' THEN coalesce(message, error_code) END AS store_error, o = 'FAILED' AS retryable FROM (SELECT *, {_OUTCOME} AS o FROM store_results)""")
def _(t):
    return outcomes.store_results(t("store_results").withColumn("outcome", outcomes.store_outcome("status"))).select(
        "batch_id", "pos", F.col("status").alias("raw_status"), F.col("message").alias("raw_message"), "store_status", "store_warning", "store_error_code", "store_error", "retryable")


@query("j10_move_results", """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'Destination_AET:' || o_orderpriority || ' Status:0000 tookMs=' || CAST(o_custkey AS STRING) END AS move_details,
  CASE o_orderkey % 4 WHEN 1 THEN 'C-MOVE timed out (no final response)' WHEN 2 THEN 'refused' WHEN 3 THEN 'C-MOVE failed status=42752' END AS move_error FROM orders""")
def _(t):
    k = F.col("o_orderkey") % 4
    df = t("orders").select("o_orderkey", F.when(k != 1, True).alias("finished"), F.when(k == 0, 0).otherwise(0xA700).alias("status"), F.when(k == 2, "refused").alias("message"), F.col("o_orderpriority").alias("destination_aet"), F.col("o_custkey").alias("took_ms"))
    return outcomes.move_results(df).select("o_orderkey", "move_details", "move_error")


# --- K ----------------------------------------------------------------------------------------

_RT_PATH = "30060010:0/30060012:0/30060014:0"


def _repaired(t, out):
    here = out.filter(F.col("tag") == "0020000E").select("sop_instance_uid", path_text(), value_text()).filter(F.col("path") == _RT_PATH).select("sop_instance_uid", "value")
    return rtrepair.reference_routes(t("elements")).select("sop_instance_uid", "route").join(here, "sop_instance_uid", "left")


@query("k1_set_reference", "SELECT sop_instance_uid, CASE WHEN o_orderkey % 18 = 5 THEN 'success' ELSE 'failure' END AS route, CASE WHEN o_orderkey % 18 = 5 THEN series_uid END AS value FROM inst")
def _(t):
    return _repaired(t, rtrepair.set_reference(t("elements"), t("inst").select("sop_instance_uid", "series_uid")))


@query("k2_remap_reference", f"SELECT sop_instance_uid, CASE WHEN o_orderkey % 18 = 5 THEN 'success' ELSE 'failure' END AS route, CASE WHEN o_orderkey % 18 = 5 THEN {remapped(chr(39) + '1.2.840.99.6.' + chr(39) + ' || CAST(o_orderkey AS STRING)')} END AS value FROM inst")
def _(t):
    return _repaired(t, rtrepair.remap_reference(t("elements")))


# --- L ----------------------------------------------------------------------------------------

@query("l1_mask_frames", """SELECT sop_instance_uid, CASE WHEN rows < 2 THEN 'failure' ELSE 'success' END AS route, CASE WHEN rows < 2 THEN md5(from_hex(hexed)) ELSE
  md5(from_hex(substr(hexed, 1, 4) || 'ffffffffff' || substr(hexed, 15, 22) || 'ffffffffff' || substr(hexed, 47))) END AS digest FROM frames""")
def _(t):
    out = masking.mask_frames(t("frames"), region_list(F.lit("[2,0,5,2]")), 255)
    return out.select("sop_instance_uid", "route", F.md5("pixels").alias("digest"))


@query("l2_colour_space", f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE l_partkey % 4 WHEN 0 THEN rgb WHEN 1 THEN rgb WHEN 2 THEN {_chan('0.299', '+ 0.587', '+ 0.114', '')} * 65536 + {_chan('-0.168736', '- 0.331264', '+ 0.5', '+ 128::FLOAT')} * 256 + {_chan('0.5', '- 0.418688', '- 0.081312', '+ 128::FLOAT')} END AS fill
FROM (SELECT *, CAST((rgb >> 16) & 255 AS FLOAT) AS r, CAST((rgb >> 8) & 255 AS FLOAT) AS g, CAST(rgb & 255 AS FLOAT) AS b FROM ({_RGB}))""")
def _(t):
    k = F.col("l_partkey") % 4
    rgb = ((F.col("l_partkey") * 7919 + F.col("l_orderkey") * 31 + F.col("l_suppkey")) % 16777216).cast("int")
    base = t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", rgb.alias("rgb"), F.when(k == 0, 1).otherwise(3).alias("samples"), F.when(k == 1, "RGB").when(k == 2, "YBR_FULL").otherwise("YBR_RCT").alias("photometric"))
    return base.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", mask_value("rgb", "samples", "photometric").alias("fill"))


@query("l3_clean_pixel_marks", """SELECT keyword, path, value, count(*) AS n FROM (SELECT 'BurnedInAnnotation' AS keyword, '' AS path, 'NO' AS value FROM inst WHERE o_orderkey % 2 = 0
UNION ALL SELECT unnest(['CodeValue', 'CodingSchemeDesignator', 'CodeMeaning']), '00120064:0', unnest(['113101', 'DCM', 'Clean Pixel Data Option']) FROM inst WHERE o_orderkey % 2 = 0 UNION ALL SELECT keyword, path, value FROM elements WHERE keyword = 'Rows') GROUP BY ALL""")
def _(t):
    masked = t("inst").filter(F.col("o_orderkey") % 2 == 0)
    out = masking.mark_clean_pixels(t("elements"), masked).filter(F.col("keyword").isin("BurnedInAnnotation", "CodeValue", "CodingSchemeDesignator", "CodeMeaning", "Rows"))
    return out.select("keyword", path_text(), value_text()).groupBy("keyword", "path", "value").agg(F.count(F.lit(1)).alias("n"))


@query("l4_lossy_history", f"""SELECT sop_instance_uid, CASE WHEN lossy THEN '01' END AS lossy_flag, CASE WHEN lossy THEN CASE WHEN o_orderkey % 2 = 0 THEN '9.00' ELSE '12.50' END || ',10.00' ELSE CASE WHEN o_orderkey % 2 = 0 THEN '9.00' END END AS ratios,
  CASE WHEN lossy THEN concat_ws(',', CASE o_orderkey % 11 WHEN 4 THEN 'ISO_10918_1' WHEN 5 THEN 'ISO_15444_1' END, 'ISO_10918_1') END AS methods FROM (SELECT *, transfer_syntax_uid IN ({', '.join(repr(u) for u in V.LOSSY_SYNTAXES)}) AS lossy FROM inst)""")
def _(t):
    df = t("inst").withColumn("lossy_flag", F.lit(None).cast("string")).withColumn("ratios", F.when(F.col("o_orderkey") % 2 == 0, F.array(F.lit("9.00"), F.lit("")))).withColumn("methods", F.lit(None).cast("array<string>"))
    again = F.when(V.is_lossy("transfer_syntax_uid"), "1.2.840.10008.1.2.4.50")
    out = masking.lossy_history(df, F.lit(100), F.lit(8), again, F.lit(10))
    return out.select("sop_instance_uid", "lossy_flag", F.array_join(F.filter("ratios", lambda r: r != ""), ",").alias("ratios"), F.array_join("methods", ",").alias("methods"))


@query("l5_output_syntax", f"SELECT sop_instance_uid, CASE WHEN transfer_syntax_uid IN ({', '.join(repr(u) for u in V.LOSSY_SYNTAXES)}) THEN '{V.RLE}' ELSE transfer_syntax_uid END AS syntax FROM inst")
def _(t):
    return t("inst").select("sop_instance_uid", masking.output_syntax(F.col("transfer_syntax_uid")).alias("syntax"))


# --- M ----------------------------------------------------------------------------------------

def stream_query(name: str, sql: str | None = None):
    """Register a streaming run: the given table is read as a stream and drained completely; the
    result is what the stream wrote. ``fn(stream, t, folder)`` returns the written DataFrame."""
    def add(fn, source=None):
        def run(spark, sf_dir):
            def stream(n):
                schema = spark.read.parquet(f"{sf_dir}/{n}.parquet").schema
                # A pattern stands for a table of one file as well as for a folder of files.
                return spark.readStream.schema(schema).parquet(f"{sf_dir}/{n}.parque[t]")

            folder = f"{checkpoint_root(spark)}/{uuid.uuid4().hex}"
            return fn(stream, lambda n: table(spark, sf_dir, n), folder)

        query(name, sql)(lambda t: None)
        QUERIES[name] = run
        return fn

    return add


def _name() -> str:
    return f"q{uuid.uuid4().hex}"


def _drained(stream, folder):
    flows.ingest(stream, folder, _name()).awaitTermination()
    return stream.sparkSession.read.parquet(folder)


@stream_query("m1_message_ingest", "SELECT msg_id, CASE WHEN c_nationkey = 3 THEN '' ELSE 'F' || CAST(c_nationkey AS STRING) END AS send_facility FROM adt")
def _(stream, t, folder):
    fac = F.when(F.col("c_nationkey") == 3, "").otherwise(F.concat(F.lit("F"), F.col("c_nationkey").cast("string")))
    raw = F.concat(F.lit("MSH|^~\\&|HIS|"), fac, F.lit("|RIS|"), F.col("c_mktsegment"), F.lit("|20200101||ADT^A04|1|P|2.3\r"))
    landed = hl7.with_header(stream("customer").select(F.col("c_custkey").alias("msg_id"), raw.alias("raw")))
    return _drained(landed, folder).select("msg_id", "send_facility")


@stream_query("m2_routing_on_a_stream", "SELECT event_id, CASE WHEN event_type = 'error' THEN 'success' ELSE 'failure' END AS route FROM events")
def _(stream, t, folder):
    return _drained(stream("events").select("event_id", R.called_title_route("ERROR", "event_type").alias("route")), folder)


_FRAGMENTS = "SELECT CAST(conv_id AS STRING) AS grp, turn, count(*) OVER (PARTITION BY conv_id) + CASE WHEN conv_id % 3 = 0 THEN 1 ELSE 0 END AS fragment_count FROM conversations"


@stream_query("m3_defragmented_series", f"SELECT grp AS fragment_group, fragment_count, CASE WHEN count(*) = fragment_count THEN 'COMPLETE' ELSE 'OPEN' END AS state FROM ({_FRAGMENTS}) GROUP BY 1, 2")
def _(stream, t, folder):
    extra = F.when(F.col("conv_id") % 3 == 0, 1).otherwise(0)
    counts = t("conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select("conv_id", (F.col("n") + extra).cast("int").alias("fragment_count"))
    fragments = stream("conversations").join(counts, "conv_id").select(F.col("conv_id").cast("string").alias("fragment_identifier"), F.col("turn").cast("int").alias("fragment_index"), "fragment_count", F.lit("2024-01-01").cast("timestamp").alias("received_at"))
    shards = _drained(flows.defragment(fragments, 600_000), folder)
    # A group whose shards have not finished has no state row yet.
    states = flows.group_states(shards).select(F.col("group").alias("fragment_group"), "state")
    groups = counts.select(F.col("conv_id").cast("string").alias("fragment_group"), "fragment_count")
    return groups.join(states, "fragment_group", "left").withColumn("state", F.coalesce("state", F.lit("OPEN")))


@stream_query("m4_event_batches_on_a_stream", """SELECT order_id, batch_no, count(*) AS event_count, md5(string_agg(CAST(event_id AS STRING), ',' ORDER BY ts, CAST(event_id AS STRING))) AS digest FROM (
  SELECT event_id, ts, CAST(user_id AS STRING) AS order_id, (row_number() OVER (PARTITION BY user_id ORDER BY ts, CAST(event_id AS STRING)) - 1) // 50 AS batch_no FROM events) GROUP BY 1, 2""")
def _(stream, t, folder):
    ev = stream("events").select(F.col("user_id").cast("string").alias("order_id"), F.lit("r").alias("retrieve_id"), F.col("ts").cast("timestamp").alias("received_at"),
                                 F.struct(F.col("event_id").cast("string").alias("eventId"), "event_type").alias("event"))
    # A last row, years later and of no order, closes the batches that are open at the end.
    end = stream("region").filter("r_regionkey = 0").select(F.lit(None).cast("string").alias("order_id"), F.lit("end").alias("retrieve_id"), F.lit("2100-01-01").cast("timestamp").alias("received_at"),
                                                            F.struct(F.lit(None).cast("string").alias("eventId"), F.lit(None).cast("string").alias("event_type")).alias("event"))
    flows.batch_events(ev.unionByName(end), _name(), folder, 50, 10 * 365 * 86_400_000).awaitTermination()
    ids = F.array_join(F.transform(F.from_json("body", "events array<struct<eventId:string>>")["events"], lambda e: e["eventId"]), ",")
    return ev.sparkSession.read.parquet(folder).filter("order_id <> ''").select("order_id", "batch_no", F.col("event_count").cast("bigint").alias("event_count"), F.md5(ids).alias("digest"))


@stream_query("m5_idempotent_callbacks", "SELECT event_id, event_type FROM events")
def _(stream, t, folder):
    twice = stream("events").select("event_id", "event_type", "ts").unionByName(stream("events").select("event_id", "event_type", "ts"))
    return _drained(flows.idempotent(twice.withColumn("ts", F.col("ts").cast("timestamp")), "ts"), folder).select("event_id", "event_type")


@stream_query("m6_partial_series", "SELECT o_orderkey, status AS retrieve_status FROM retrievals")
def _(stream, t, folder):
    key = F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))
    arrived = stream("orders").select("o_orderkey", key.alias("retrieve_id"))
    return _drained(flows.with_final_state(arrived, t("retrievals"), ["retrieve_id"]), folder).select("o_orderkey", "retrieve_status")


# --- N ----------------------------------------------------------------------------------------

@query("n1_user_functions", "SELECT doc_id, upper(lang) AS lang, 'seen' AS mark, CASE WHEN n_chars > 500 THEN 'success' ELSE 'failure' END AS route FROM documents")
def _(t):
    def user(df):
        return df.withColumn("lang", F.upper("lang")).withColumn("mark", F.lit("seen")).withColumn("route", R.routed(F.col("n_chars") > 500))

    return t("documents").transform(user).select("doc_id", "lang", "mark", "route")


@query("n3_sql_handle", "SELECT c_custkey, md5(c_name) AS blob_md5 FROM customer WHERE c_name LIKE '%7%'")
def _(t):
    c = t("customer")
    blobs = c.select(F.col("c_custkey").alias("id"), F.encode("c_name", "UTF-8").alias("data"))
    return c.sparkSession.sql("SELECT m.c_custkey, md5(b.data) AS blob_md5 FROM {m} m JOIN {b} b ON b.id = m.c_custkey WHERE m.c_name LIKE '%7%'", m=c, b=blobs)


@query("n4_property_expressions", "SELECT sop_instance_uid, CASE WHEN lower(calling_aet) = lower('SCU_' || o_orderstatus) THEN 'success' ELSE 'failure' END AS route FROM inst")
def _(t):
    return t("inst").select("sop_instance_uid", R.calling_title_route(F.expr("'SCU_' || o_orderstatus")).alias("route"))


@query("n5_multiple_outputs", "SELECT o_orderkey, unnest([o_orderstatus, o_orderpriority]) AS part FROM orders")
def _(t):
    return t("orders").select("o_orderkey", F.explode(F.array("o_orderstatus", "o_orderpriority")).alias("part"))


