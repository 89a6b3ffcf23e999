"""Queries of sections A (sources and sinks), B (routing) and C (projections and documents)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from scanloom.functions import vocabulary as V
from scanloom.functions.identifiers import uid_digest
from scanloom.operators import documents, hl7, projections
from scanloom.operators import routing as R
from scanloom.plans import derived  # noqa: F401
from scanloom.plans.derived import EVENT_TIME
from scanloom.plans.registry import INSTANCES_A_TASK, instance_tasks, query, spread
from scanloom.plans.sqltext import blank, nested_document, uuid_text
from scanloom.session import checkpoint_root
from scanloom.sources import headerfiles, instances, messages, sinks


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _folder(df) -> str:
    return f"{checkpoint_root(df.sparkSession)}/{uuid.uuid4().hex}"


# --- A ----------------------------------------------------------------------------------------

@query("a1_instance_index", """
SELECT sop_instance_uid, sop_class_uid, study_uid, series_uid, CASE WHEN patient_id = '' THEN 'NO-ID' ELSE patient_id END AS patient_id, coalesce(modality, 'OT') AS modality,
  md5(study_uid) AS hex_study, md5(series_uid) AS hex_series, 'o' || CAST(o_orderkey AS STRING) || '.dcm' AS filename, 'application/dicom' AS mime_type, calling_aet, called_aet, transfer_syntax_uid,
  CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 3 END AS move_originator_message_id FROM inst""")
def _(t):
    arrivals = spread(t("inst"), INSTANCES_A_TASK).select("sop_instance_uid", "transfer_syntax_uid", "calling_aet", "called_aet", F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("path"),
                                F.when(F.col("o_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("o_orderkey") % 3).alias("move_originator_message_id"))
    return instances.index_of(t("elements"), arrivals, instance_tasks(t)).select(
        "sop_instance_uid", "sop_class_uid", "study_uid", "series_uid", "patient_id", "modality", "hex_study", "hex_series", "filename", "mime_type", "calling_aet", "called_aet",
        "transfer_syntax_uid", "move_originator_message_id")


@query("a2_retrieved_index", """
SELECT sop_instance_uid, CASE WHEN o_orderkey % 29 = 0 THEN 'failure' ELSE 'success' END AS route, sop_instance_uid || '.dcm' AS filename,
  CASE WHEN o_orderkey % 29 = 0 THEN 'Missing StudyInstanceUID or SeriesInstanceUID' END AS error_message, CAST(o_orderkey AS STRING) AS attr_order, study_uid AS attr_study,
  CASE WHEN o_orderkey % 29 <> 0 THEN md5(series_uid) END AS hex_series FROM inst""")
def _(t):
    df = t("inst").withColumn("order_id", F.col("o_orderkey")).withColumn("series_uid", F.when(F.col("o_orderkey") % 29 != 0, F.col("series_uid")))
    return projections.retrieved_attributes(df, ["order_id"]).select(
        "sop_instance_uid", "route", "filename", "error_message", F.col("attrs")["order_id"].alias("attr_order"), F.col("attrs")["study_uid"].alias("attr_study"), "hex_series")


def _encoded_files(df):
    """Explicit little-endian file bytes of each instance: preamble, meta group, six attributes."""
    def le(number, size):
        h = F.lpad(F.hex(number), size * 2, "0")
        return F.unhex(F.concat(*[F.substring(h, i, 2) for i in range(size * 2 - 1, 0, -2)]))

    def attribute(tag, vr, text):
        code = "".join((tag[2:4], tag[0:2], tag[6:8], tag[4:6]))
        padded = F.when(F.length(text) % 2 == 1, F.concat(text, F.lit(" "))).otherwise(text)
        data = F.encode(padded, "UTF-8")
        return F.concat(F.unhex(F.lit(code)), F.encode(F.lit(vr), "UTF-8"), le(F.length(data), 2), data)

    syntax = attribute("00020010", "UI", F.lit("1.2.840.10008.1.2.1"))
    meta = F.concat(F.unhex(F.lit("02000000")), F.encode(F.lit("UL"), "UTF-8"), F.unhex(F.lit("0400")), le(F.length(syntax), 4), syntax)
    body = F.concat(attribute("00080016", "UI", F.col("sop_class_uid")), attribute("00080018", "UI", F.col("sop_instance_uid")), attribute("00100020", "LO", F.col("patient_id")),
                    attribute("0020000D", "UI", F.col("study_uid")), attribute("0020000E", "UI", F.col("series_uid")),
                    F.unhex(F.lit("E07F10004F5700000400000001020304")))
    whole = F.concat(F.unhex(F.lit("00" * 128)), F.encode(F.lit("DICM"), "UTF-8"), meta, body)
    at = (F.col("o_orderkey") % 4).cast("int")
    cut = F.substring(whole, F.lit(1), F.length(whole) - 18 + at + F.when(at >= 2, 1).otherwise(0))  # within the series UID, or in the head of the pixels
    bare = F.when(F.col("o_orderkey") % 2 == 0, F.encode(F.lit("no image"), "UTF-8")).otherwise(cut)
    return df.select("sop_instance_uid", F.when(F.col("o_orderkey") % 17 == 0, bare).otherwise(whole).alias("content"))


@query("a3_header_until_pixels", """
SELECT sop_instance_uid AS path, tag, value, o_orderkey % 17 <> 0 AS readable FROM (
  SELECT *, unnest(['00080016', '00080018', '00100020', '0020000D', '0020000E']) AS tag, unnest([sop_class_uid, sop_instance_uid, nullif(patient_id, ''), study_uid, series_uid]) AS value FROM inst WHERE o_orderkey % 17 <> 0)
UNION ALL SELECT sop_instance_uid, NULL, NULL, false FROM inst WHERE o_orderkey % 17 = 0""")
def _(t):
    files = _encoded_files(spread(t("inst"))).withColumn("filename", F.concat("sop_instance_uid", F.lit(".dcm")))
    folder = _folder(files)
    sinks.write_files(files, folder)
    rows = headerfiles.read_headers(files.sparkSession, folder, ".dcm")
    return rows.select(F.regexp_extract("path", r"([^/]*)\.dcm$", 1).alias("path"), "tag", F.get("values", F.lit(0)).alias("value"), "readable")


@query("a4_message_charset", """
SELECT msg_id, raw AS text, CASE WHEN msg_id % 3 = 0 THEN 'ISO-8859-1' ELSE 'UTF-8' END AS charset FROM (
SELECT c_custkey AS msg_id, 'MSH|^~\\&|||||||ADT^A01|1|P|2.5||||||' || CASE WHEN c_custkey % 3 = 0 THEN '8859/1' WHEN c_custkey % 3 = 1 THEN 'UNICODE UTF-8' ELSE '' END || chr(13) || 'PID|Müller ' || c_name || chr(13) AS raw FROM customer)""")
def _(t):
    key = F.col("c_custkey")
    declared = F.when(key % 3 == 0, "8859/1").when(key % 3 == 1, "UNICODE UTF-8").otherwise("")
    raw = F.concat(F.lit("MSH|^~\\&|||||||ADT^A01|1|P|2.5||||||"), declared, F.lit("\rPID|Müller "), F.col("c_name"), F.lit("\r"))
    sent = t("customer").select(key.alias("msg_id"), F.when(key % 3 == 0, F.encode(raw, "ISO-8859-1")).otherwise(F.encode(raw, "UTF-8")).alias("content"))
    return sent.withColumn("charset", messages.declared_charset("content")).select("msg_id", messages.decoded("content", F.col("charset")).alias("text"), "charset")


@query("a5_lookup_source", "SELECT pid, count(*) AS row_count, min(id) AS first_id FROM pseudonyms GROUP BY pid")
def _(t):
    return t("pseudonyms").groupBy("pid").agg(F.count(F.lit(1)).alias("row_count"), F.min("id").alias("first_id"))


def _json_value(vr, value):
    if vr == "US":
        return f"'[' || ({value}) || ']'"
    if vr == "PN":
        return f"'[{{\"Alphabetic\":\"' || ({value}) || '\"}}]'"
    return f"'[\"' || replace({value}, '\\', '\",\"') || '\"]'"


def _json_entry(tag, keyword, vr, value):
    head = f"'\"{keyword or tag}\":{{\"vr\":\"{vr}\"'"
    if vr in ("SQ", "OW") or value is None:
        return head if vr == "SQ" else f"{head} || '}}'"
    return f"{head} || coalesce(',\"Value\":' || {_json_value(vr, value)}, '') || '}}'"


_JSON = "'{' || substr(" + nested_document(
    _json_entry, lambda inner: f"',\"Value\":[{{' || substr({inner}, 2) || '}}]}}'", "'}'", ",", lambda tag, path: int(tag[3], 16) % 2 == 1) + ", 2) || '}'"


@query("a6_json_sink", f"SELECT {_JSON} AS line FROM inst")
def _(t):
    docs = documents.to_json_documents(t("elements"), tasks=instance_tasks(t))
    folder = _folder(docs)
    sinks.write_documents(docs, folder, compression="gzip")
    return docs.sparkSession.read.text(folder).select(F.col("value").alias("line"))


def _xml_entry(tag, keyword, vr, value):
    kw = f' keyword="{keyword}"' if keyword else ""
    head = f"'<DicomAttribute{kw} tag=\"{tag}\" vr=\"{vr}\">'"
    if vr == "SQ":
        return head
    if vr == "OW" or value == "NULL":
        return f"{head} || '</DicomAttribute>'"
    if vr == "PN":
        v = f"({value})"
        name = f"'<PersonName number=\"1\"><Alphabetic><FamilyName>' || split_part({v}, '^', 1) || '</FamilyName><GivenName>' || split_part({v}, '^', 2) || '</GivenName></Alphabetic></PersonName>'"
        return f"{head} || {name} || '</DicomAttribute>'"
    v = f"({value})"
    second = f"CASE WHEN contains({v}, '\\') THEN '<Value number=\"2\">' || split_part({v}, '\\', 2) || '</Value>' ELSE '' END"
    return f"{head} || coalesce('<Value number=\"1\">' || split_part({v}, '\\', 1) || '</Value>' || {second}, '') || '</DicomAttribute>'"


_XML = ("'<?xml version=\"1.0\" encoding=\"UTF-8\"?><NativeDicomModel>' || " + nested_document(
    _xml_entry, lambda inner: f"'<Item number=\"1\">' || {inner} || '</Item></DicomAttribute>'", "'</DicomAttribute>'", "") + " || '</NativeDicomModel>'")


@query("a7_xml_sink", f"SELECT {_XML} AS line FROM inst")
def _(t):
    docs = documents.to_xml_documents(t("elements"), tasks=instance_tasks(t))
    folder = _folder(docs)
    sinks.write_documents(docs, folder, "xml", compression="gzip")
    return docs.sparkSession.read.text(folder).select(F.col("value").alias("line"))


@query("a8_event_sink", """SELECT DISTINCT '{"eventId":"' || CAST(user_id AS STRING) || '-' || event_type || '","eventType":"' || event_type || '"}' AS line FROM events""")
def _(t):
    ev = t("events").select(F.struct(F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("eventId"), F.col("event_type").alias("eventType")).alias("event"))
    folder = _folder(ev)
    sinks.write_events(ev, folder)
    return ev.sparkSession.read.text(folder).select(F.col("value").alias("line"))


_TARGET = """SELECT o_orderkey, 'disk-' || o_orderstatus AS directory, 'c' || substr(o_orderpriority, 1, 1) AS folder, 'P' || CAST(o_orderkey % 10 AS STRING) AS subfolder FROM orders"""


@query("a9_delivery_sink", f"SELECT o_orderkey, directory, folder, subfolder FROM ({_TARGET}) WHERE o_orderkey % 4 <> 0")
def _(t):
    o = t("orders")
    rows = o.select("o_orderkey", F.concat(F.lit("disk-"), "o_orderstatus").alias("directory"), F.concat(F.lit("c"), F.substring("o_orderpriority", 1, 1)).alias("folder"),
                    F.concat(F.lit("P"), (F.col("o_orderkey") % 10).cast("string")).alias("subfolder"), F.lit("success").alias("route"),
                    F.when(F.col("o_orderkey") % 4 == 0, "DOWNLOAD").otherwise("DIRECTORY").alias("delivery"))
    folder = _folder(rows)
    sinks.write_deliveries(rows.repartition("directory", "folder"), folder)
    return o.sparkSession.read.parquet(folder).select("o_orderkey", "directory", "folder", "subfolder")


@query("a10_content_names", f"SELECT doc_id, {uuid_text('CAST(doc_id AS STRING)')} || '.json' AS filename, 'application/json' AS mime_type FROM documents")
def _(t):
    return projections.named_content(t("documents"), F.col("doc_id").cast("string"), "json").select("doc_id", "filename", "mime_type")


@query("a11_record_copy", "SELECT p_partkey, p_name, p_size FROM part")
def _(t):
    part = t("part").select("p_partkey", "p_name", "p_size")
    root = _folder(part)
    part.write.csv(f"{root}/in")
    messages.copy_records(part.sparkSession, f"{root}/in", "csv", f"{root}/out", "json", "p_partkey bigint, p_name string, p_size int")
    return part.sparkSession.read.schema("p_partkey bigint, p_name string, p_size int").json(f"{root}/out")


@query("a12_json_array_rows", "SELECT o_orderkey AS id, 'n' || CAST(o_orderkey AS STRING) AS name FROM orders UNION ALL SELECT o_custkey AS id, o_orderstatus AS name FROM orders")
def _(t):
    k = F.col("o_orderkey").cast("string")
    text = F.format_string('[{"id":%s,"name":"n%s"},{"id":%s,"name":"%s"}]', k, k, F.col("o_custkey").cast("string"), F.col("o_orderstatus"))
    return messages.json_array_rows(t("orders").select(text.alias("body")), "body", "id:bigint,name:string")


# --- B ----------------------------------------------------------------------------------------

@query("b1_called_title", "SELECT sop_instance_uid, CASE WHEN lower(called_aet) = 'urgent' THEN 'success' ELSE 'failure' END AS route FROM inst")
def _(t):
    return t("inst").select("sop_instance_uid", R.called_title_route("Urgent").alias("route"))


@query("b2_calling_title", "SELECT sop_instance_uid, CASE WHEN lower(calling_aet) = 'scu_f' THEN 'success' ELSE 'failure' END AS route FROM inst")
def _(t):
    return t("inst").select("sop_instance_uid", R.calling_title_route("SCU_F").alias("route"))


_TYPE = f"""CASE WHEN bits_allocated IS NOT NULL AND sop_class_uid <> '{V.RT_DOSE}' THEN
  CASE WHEN transfer_syntax_uid = '1.2.840.10008.1.2.4.100' THEN 'MPEG2Video' WHEN transfer_syntax_uid = '1.2.840.10008.1.2.4.108' THEN 'MPEG4Video'
    ELSE (CASE WHEN transfer_syntax_uid IN ('1.2.840.10008.1.2', '1.2.840.10008.1.2.1') THEN 'Uncompressed' ELSE 'Compressed' END) ||
         (CASE WHEN coalesce(number_of_frames, 1) > 1 THEN 'MultiFrameImage' ELSE 'SingleFrameImage' END) END
  WHEN sop_class_uid = '1.2.840.10008.5.1.4.1.1.104.1' THEN 'EncapsulatedPDF' WHEN sop_class_uid = '1.2.840.10008.5.1.4.1.1.104.2' THEN 'EncapsulatedCDA'
  WHEN sop_class_uid = '1.2.840.10008.5.1.4.1.1.88.11' AND transfer_syntax_uid IN ('1.2.840.10008.1.2', '1.2.840.10008.1.2.1', '1.2.840.10008.1.2.1.99') THEN 'SRDocument' ELSE 'Other' END"""


@query("b3_sop_class_filter", f"""SELECT sop_instance_uid, CASE WHEN readable THEN 'success' ELSE 'failure' END AS all_route,
  CASE WHEN readable AND lower(sop_class_uid) = '{V.US_MULTIFRAME}' THEN 'success' ELSE 'failure' END AS value_route,
  CASE WHEN readable AND {_TYPE} = 'CompressedMultiFrameImage' THEN 'success' ELSE 'failure' END AS type_route FROM inst""")
def _(t):
    return t("inst").select("sop_instance_uid", R.sop_class_route("*", readable="readable").alias("all_route"),
                            R.sop_class_route("Value", V.US_MULTIFRAME, readable="readable").alias("value_route"), R.sop_class_route("CompressedMultiFrameImage", readable="readable").alias("type_route"))


@query("b4_object_type", f"SELECT {_TYPE} AS object_type, count(*) AS n FROM inst GROUP BY 1")
def _(t):
    return t("inst").groupBy(R.object_type().alias("object_type")).agg(F.count(F.lit(1)).alias("n"))


@query("b5_is_video", "SELECT sop_instance_uid, transfer_syntax_uid IN ('1.2.840.10008.1.2.4.100', '1.2.840.10008.1.2.4.108') AS video FROM inst")
def _(t):
    return t("inst").select("sop_instance_uid", R.is_video().alias("video"))


@query("b6_transfer_syntax_filter", f"""SELECT sop_instance_uid, CASE WHEN transfer_syntax_uid IN {_in(V.NATIVE_SYNTAXES)} THEN 'success' ELSE 'failure' END AS native_route,
  CASE WHEN transfer_syntax_uid <> '' THEN 'success' ELSE 'failure' END AS any_route, CASE WHEN transfer_syntax_uid = '{V.RLE}' THEN 'success' ELSE 'failure' END AS rle_route FROM inst""")
def _(t):
    return t("inst").select("sop_instance_uid", R.transfer_syntax_route("Uncompressed").alias("native_route"), R.transfer_syntax_route("Value", "*").alias("any_route"),
                            R.transfer_syntax_route("Value", V.RLE).alias("rle_route"))


@query("b7_thin_slices", """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, CASE WHEN l_quantity / 10 > 0 AND CAST(l_quantity / 10 AS FLOAT) <= 1 THEN 'success' ELSE 'failure' END AS route FROM lineitem""")
def _(t):
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", R.thin_slice_route(F.col("l_quantity") / 10).alias("route"))


@query("b8_message_type_filter", "SELECT msg_id, CASE WHEN msg_id % 3 = 0 THEN 'failure' ELSE 'success' END AS route, 'success' AS any_route FROM adt")
def _(t):
    return hl7.with_header(t("adt")).select("msg_id", R.message_type_route("ADT", "A04").alias("route"), R.message_type_route().alias("any_route"))


@query("b9_ultrasound_eligibility", f"""SELECT sop_instance_uid, CASE WHEN sop_class_uid <> '{V.US_MULTIFRAME}' THEN 'SOP Class ' || sop_class_uid || ' ist keine Ultrasound Multi-frame Image Storage'
  WHEN coalesce(number_of_frames, 1) <= 1 THEN 'Ultraschall-Single-Frame' END AS reason FROM inst""")
def _(t):
    return t("inst").select("sop_instance_uid", R.multiframe_ultrasound_reason().alias("reason"))


@query("b10_maskable_syntax", f"""SELECT sop_instance_uid, CASE WHEN sop_class_uid <> '{V.US_MULTIFRAME}' OR coalesce(number_of_frames, 1) <= 1 THEN 'unsupported'
  WHEN transfer_syntax_uid NOT IN {_in(V.MASKABLE_SYNTAXES)} OR NOT has_pixels THEN 'failure' ELSE 'success' END AS route FROM inst""")
def _(t):
    return t("inst").select("sop_instance_uid", R.masking_route().alias("route"))


_UUID_RE = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"


@query("b11_required_attributes", f"""SELECT o_orderkey, concat_ws('; ', CASE WHEN {blank('order_id')} THEN 'Missing required attribute: order_id' END, CASE WHEN {blank('series_uid')} THEN 'Missing required attribute: series_uid' END,
  CASE WHEN NOT {blank('order_id')} AND NOT regexp_full_match(trim(order_id), '{_UUID_RE}') THEN 'Invalid UUID: order_id' END) AS errors FROM retrievals""")
def _(t):
    return t("retrievals").select("o_orderkey", F.array_join(R.missing_attribute_errors({"order_id": "order_id", "series_uid": "series_uid"}, {"order_id": "order_id"}), "; ").alias("errors"))


@query("b12_like_filter", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%'")
def _(t):
    return R.name_like(t("part"), "p_name", "%ring%").select("p_partkey", "p_name")


@query("b13_attribute_filter", "SELECT event_id, value FROM events WHERE event_type = 'error'")
def _(t):
    return R.select_where(t("events"), "event_type", "error").select("event_id", "value")


# --- C ----------------------------------------------------------------------------------------

@query("c1_copy_attributes", "SELECT sop_instance_uid, nullif(patient_id, '') AS patient_id, modality, md5(study_uid) AS hex_study, md5(series_uid) AS hex_series, 'success' AS route FROM inst")
def _(t):
    from scanloom.operators.deid import header_of
    return projections.copied_attributes(header_of(t("elements"), instance_tasks(t))).select("sop_instance_uid", "patient_id", "modality", "hex_study", "hex_series", "route")


@query("c2_document_extraction", """SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '.pdf' WHEN 1 THEN '.xml' END AS extension, CASE WHEN doc_id % 3 < 2 THEN md5(text) END AS digest,
  CASE doc_id % 3 WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'application/xml' END AS mime_type, CASE WHEN doc_id % 3 < 2 THEN 'success' ELSE 'failure' END AS route FROM documents""")
def _(t):
    d = t("documents")
    cls = F.when(d.doc_id % 3 == 0, V.ENCAPSULATED[0][0]).when(d.doc_id % 3 == 1, V.ENCAPSULATED[1][0]).otherwise(V.CT_IMAGE)
    data = F.concat(F.encode("text", "UTF-8"), F.when(d.doc_id % 2 == 0, F.unhex(F.lit("00"))).otherwise(F.unhex(F.lit(""))))
    return projections.extracted_documents(d.withColumn("sop_class_uid", cls).withColumn("bin", data)).select("doc_id", "extension", F.md5("document").alias("digest"), "mime_type", "route")


@query("c3_message_header", """SELECT msg_id, CASE WHEN msg_id % 2 = 0 THEN '2.3' ELSE '2.5' END AS version, 'HIS' AS send_app, CASE WHEN c_nationkey = 3 THEN '' ELSE 'F' || CAST(c_nationkey AS STRING) END AS send_facility,
  'RIS' AS recv_app, c_mktsegment AS recv_facility, CASE WHEN msg_id % 3 = 0 THEN 'ADT^A01' ELSE 'ADT^A04' END AS message_type FROM adt""")
def _(t):
    return hl7.with_header(t("adt")).select("msg_id", "version", "send_app", "send_facility", "recv_app", "recv_facility", "message_type")


@query("c4_json_documents", f"SELECT sop_instance_uid, {_JSON} AS json FROM inst")
def _(t):
    return documents.to_json_documents(t("elements"), tasks=instance_tasks(t))


@query("c5_xml_documents", f"SELECT sop_instance_uid, {_XML} AS xml FROM inst")
def _(t):
    return documents.to_xml_documents(t("elements"), tasks=instance_tasks(t))


@query("c6_person_names", """SELECT c_custkey, nullif(split_part(v, '=', 1), '') AS alphabetic, nullif(split_part(v, '=', 2), '') AS ideographic, nullif(split_part(v, '=', 3), '') AS phonetic FROM (
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN c_name || '==' || c_mktsegment ELSE '=' || c_mktsegment END AS v FROM customer)""")
def _(t):
    c = t("customer")
    v = F.when(c.c_custkey % 3 == 0, c.c_name).when(c.c_custkey % 3 == 1, F.concat("c_name", F.lit("=="), "c_mktsegment")).otherwise(F.concat(F.lit("="), "c_mktsegment"))
    return c.select("c_custkey", projections.person_name_groups(v).alias("p")).select(
        "c_custkey", F.col("p.Alphabetic").alias("alphabetic"), F.col("p.Ideographic").alias("ideographic"), F.col("p.Phonetic").alias("phonetic"))


@query("c7_conversion_worklist", "SELECT sop_instance_uid, transfer_syntax_uid, '1.2.840.10008.1.2.4.70' AS target_syntax_uid FROM inst WHERE transfer_syntax_uid <> '1.2.840.10008.1.2.4.70'")
def _(t):
    return projections.conversion_worklist(t("inst"), "JPEGLosslessSV1").select("sop_instance_uid", "transfer_syntax_uid", "target_syntax_uid")


@query("c8_media_types", """SELECT sop_instance_uid, m AS media_type, CASE WHEN m IS NULL THEN 'failure' ELSE 'success' END AS route FROM (SELECT sop_instance_uid, CASE o_orderkey % 11 WHEN 0 THEN 'application/octet-stream'
  WHEN 1 THEN 'application/octet-stream' WHEN 4 THEN 'image/jpeg' WHEN 5 THEN 'image/jp2' WHEN 6 THEN 'image/dicom-rle' WHEN 7 THEN 'video/mpeg' WHEN 10 THEN 'image/jpeg' END AS m FROM inst)""")
def _(t):
    return projections.media_types(t("inst")).select("sop_instance_uid", "media_type", "route")


@query("c9_field_replacement", f"""SELECT msg_id, CASE WHEN msg_id % 3 <> 0 AND msg_id % 2 = 0 THEN 'success' ELSE 'failure' END AS route,
  CASE WHEN msg_id % 3 <> 0 AND msg_id % 2 = 0 THEN replace(raw, 'EVN|A04|{EVENT_TIME}|||^', 'EVN|A04|20250108000000|20250116000000||^') ELSE raw END AS raw FROM adt""")
def _(t):
    return hl7.planned_event(t("adt"), "20250116000000", "20250108000000").select("msg_id", "route", "raw")


@query("c10_csv_capitalised", """SELECT p_partkey, upper(substr(p_name, 1, 1)) || substr(p_name, 2) || ' ' || upper(substr(p_type, 1, 1)) || substr(p_type, 2) AS line, 'p_name,p_type' AS selected_columns FROM part""")
def _(t):
    return projections.csv_columns_capitalised(t("part"), "p_name", "p_type", keep=["p_partkey"])


@query("c11_constant_attribute", "SELECT s_suppkey, 'application/json' AS mime_type, CAST(s_nationkey AS STRING) || ':x' AS tag FROM supplier")
def _(t):
    return projections.with_constants(t("supplier"), mime_type="application/json", tag=F.concat(F.col("s_nationkey").cast("string"), F.lit(":x"))).select("s_suppkey", "mime_type", "tag")


@query("c12_result_lifecycle", """SELECT batch_id, pos, CASE WHEN status = 0 THEN 'success' ELSE 'failure' END AS route, CASE WHEN status = 0 THEN status END AS store_status,
  CASE WHEN status <> 0 THEN coalesce(error_code, 'UNKNOWN') END AS store_error FROM store_results""")
def _(t):
    df = t("store_results").withColumn("store_error", F.lit("stale")).withColumn("store_status", F.lit(-9))
    out = projections.settle_result(df, F.col("status") == 0, {"store_status": F.col("status")}, {"store_error": F.coalesce("error_code", F.lit("UNKNOWN"))})
    return out.select("batch_id", "pos", "route", "store_status", "store_error")


@query("h9_uid_digest", "SELECT sop_instance_uid, md5(study_uid) AS digest FROM inst")
def _(t):
    return t("inst").select("sop_instance_uid", uid_digest("study_uid").alias("digest"))
