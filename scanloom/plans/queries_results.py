"""Queries of sections F (aggregations), G (numbering, sets, packages) and H (scalar functions)."""

from __future__ import annotations

from pyspark.sql import functions as F

from scanloom.functions import dates, pixels, text
from scanloom.operators import documents, events, find, keyed, outcomes, packages
from scanloom.plans import derived  # noqa: F401
from scanloom.plans.queries_deid import _REQ
from scanloom.plans.registry import query
from scanloom.plans.sqltext import blank, shifted

# --- F ----------------------------------------------------------------------------------------


@query("f1_find_studies", """SELECT patient_id, study_uid, coalesce(string_agg(DISTINCT modality, ',' ORDER BY modality), '') AS modalities, count(DISTINCT series_uid) AS series, count(*) AS instances FROM inst GROUP BY 1, 2""")
def _(t):
    m = find.study_matches(t("inst"))
    return m.select("patient_id", "study_uid", F.array_join("modalities_in_study", ",").alias("modalities"), F.col("study_related_series").alias("series"), F.col("study_related_instances").alias("instances"))


@query("f2_find_series", "SELECT study_uid, series_uid, CASE WHEN count(*) >= 0 THEN count(*) END AS instances FROM inst GROUP BY 1, 2")
def _(t):
    return find.series_matches(t("inst")).select("study_uid", "series_uid", find.valid_count("series_related_instances").alias("instances"))


@query("f3_find_images", f"SELECT request_id, i.sop_instance_uid FROM ({_REQ}) r JOIN inst i ON i.study_uid = r.study_uid AND i.series_uid = r.want WHERE valid")
def _(t):
    req = find.parsed_requests(t("requests"), find.IMAGE).filter("route = 'success'")
    return find.matched(req, find.image_matches(t("inst")), ["study_uid", "series_uid"]).select("request_id", "sop_instance_uid")


_MATCHES = f"""SELECT request_id, i.series_uid AS series_uid FROM ({_REQ}) r JOIN (SELECT DISTINCT study_uid, series_uid FROM inst) i ON i.study_uid = r.study_uid AND (want IS NULL OR want = i.series_uid) WHERE valid"""


@query("f4_answered_requests", f"""SELECT request_id, series_uid, row_number() OVER (PARTITION BY request_id ORDER BY md5(series_uid), series_uid) - 1 AS match_index, count(*) OVER (PARTITION BY request_id) AS match_count, 'success' AS route FROM ({_MATCHES})
UNION ALL SELECT request_id, NULL, NULL, 0, 'not found' FROM ({_REQ}) WHERE valid AND request_id NOT IN (SELECT request_id FROM ({_MATCHES}))""")
def _(t):
    req = find.parsed_requests(t("requests"), find.SERIES)
    return find.answered(req, find.series_matches(t("inst")), ["study_uid"], "series_uid", "series_uid").select("request_id", "series_uid", "match_index", "match_count", "route")


@query("f5_retrieve_summary", """SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'A') AS completed, count(*) FILTER (WHERE l_returnflag = 'R') AS failed, count(*) FILTER (WHERE l_returnflag = 'N' AND l_linenumber = 7) AS warning,
  printf('%04X', CAST(max(CASE WHEN l_returnflag = 'R' THEN 45056 ELSE 0 END) AS INT)) AS status_text,
  CASE WHEN count(*) FILTER (WHERE l_returnflag = 'R') = 0 AND count(*) FILTER (WHERE l_returnflag = 'N' AND l_linenumber = 7) = 0 THEN 'success' ELSE 'failure' END AS route FROM lineitem GROUP BY l_orderkey""")
def _(t):
    state = F.when(F.col("l_returnflag") == "A", "completed").when(F.col("l_returnflag") == "R", "failed").when(F.col("l_linenumber") == 7, "warning").otherwise("remaining")
    results = t("lineitem").select("l_orderkey", state.alias("state"), F.when(F.col("l_returnflag") == "R", 0xB000).otherwise(0).alias("status"))
    return outcomes.retrieve_summary(results, ["l_orderkey"]).select("l_orderkey", "completed", "failed", "warning", "status_text", "route")


_N = "CAST(trim({0}) AS INT)"
_UUID_RE = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
_REMAINING = "CASE WHEN " + blank("remaining") + " THEN -1 ELSE CAST(trim(remaining) AS INT) END"
_GATE = f"""CASE WHEN {blank('order_id')} THEN 'Missing required attribute: order_id' WHEN series_uid IS NULL THEN 'Missing required attribute: series_uid'
  WHEN NOT regexp_full_match(trim(order_id), '{_UUID_RE}') THEN 'Invalid UUID string: ' || trim(order_id) WHEN NOT regexp_full_match(upper(trim(status)), '[0-9A-F]{{4}}') THEN 'Invalid C-GET status: ' || upper(trim(status))
  WHEN finished <> 'true' THEN 'C-GET has no final response'
  WHEN upper(trim(status)) <> '0000' OR completed = '0' OR failed <> '0' OR warning <> '0' OR {_REMAINING} NOT IN (0, -1) THEN 'C-GET not successful: status=' || upper(trim(status)) || ', completed=' || completed || ', failed=' || failed || ', warning=' || warning || ', remaining=' || CAST({_REMAINING} AS STRING) END"""


@query("f6_strict_gate", f"SELECT o_orderkey, {_GATE} AS gate_error, CAST(coalesce(expected, find_count_instances) AS INT) AS expected_instances FROM retrievals")
def _(t):
    return outcomes.strict_gate(t("retrievals")).select("o_orderkey", "gate_error", "expected_instances")


_OUTCOME = "CASE WHEN status = 0 THEN 'SUCCESS' WHEN status IN (1, 263, 278) OR status & 61440 = 45056 THEN 'WARNING' ELSE 'FAILED' END"


@query("f7_store_outcomes", f"SELECT batch_id, {_OUTCOME} AS outcome, count(*) AS n FROM store_results GROUP BY 1, 2")
def _(t):
    return t("store_results").groupBy("batch_id", outcomes.store_outcome("status").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query("f8_failure_summary", f"""WITH f AS (SELECT *, {_OUTCOME} AS outcome FROM store_results),
c AS (SELECT batch_id, coalesce(error_code, 'UNKNOWN') AS code, count(*) AS n, min(pos) AS first_at, arg_min(message, pos) FILTER (WHERE message IS NOT NULL) AS msg FROM f WHERE outcome = 'FAILED' GROUP BY 1, 2)
SELECT b.batch_id, s.summary AS failure_summary FROM (SELECT DISTINCT batch_id FROM store_results) b LEFT JOIN
 (SELECT batch_id, string_agg(code || ' x' || CAST(n AS STRING) || CASE WHEN msg IS NULL THEN '' ELSE ' (' || msg || ')' END, '; ' ORDER BY first_at, code) AS summary FROM c GROUP BY 1) s USING (batch_id)""")
def _(t):
    return outcomes.failure_summary(t("store_results").withColumn("outcome", outcomes.store_outcome("status")), ["batch_id"])


_DEST = """SELECT CASE WHEN s_suppkey % 7 = 0 THEN ' ' WHEN s_suppkey % 5 = 0 THEN NULL ELSE 'host' || CAST(s_nationkey AS STRING) END AS host, CASE WHEN s_suppkey % 11 = 0 THEN 'x' WHEN s_suppkey % 13 = 0 THEN '70000' ELSE '104' END AS port,
 'CALLING' AS calling_aet, CASE WHEN s_suppkey % 17 = 0 THEN 'AN_AE_TITLE_TOO_LONG' ELSE 'AE' || CAST(s_nationkey AS STRING) END AS called_aet FROM supplier"""


@query("f9_destinations", f"""SELECT CASE WHEN e IS NULL THEN called_aet || '@' || coalesce(host, 'localhost') || ':' || port || ' (calling CALLING)' END AS destination, CASE WHEN e IS NOT NULL THEN 'CONFIG_INVALID' END AS error_code, count(*) AS instances FROM (
SELECT *, CASE WHEN port = 'x' THEN 'p' WHEN host = ' ' THEN 'h' WHEN port = '70000' THEN 'r' WHEN length(called_aet) > 16 THEN 'a' END AS e FROM ({_DEST})) GROUP BY 1, 2""")
def _(t):
    k, n = F.col("s_suppkey"), F.col("s_nationkey").cast("string")
    df = t("supplier").select(
        F.when(k % 7 == 0, " ").when(k % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("host"), n)).alias("host"), F.when(k % 11 == 0, "x").when(k % 13 == 0, "70000").otherwise("104").alias("port"),
        F.lit("CALLING").alias("calling_aet"), F.when(k % 17 == 0, "AN_AE_TITLE_TOO_LONG").otherwise(F.concat(F.lit("AE"), n)).alias("called_aet"))
    return outcomes.per_destination(df)


@query("f10_single_values", """SELECT lang, n AS distinct_values, CASE WHEN n = 1 THEN v END AS single_value, CASE WHEN n <> 1 THEN 'Expected exactly one distinct value for ' || lang || ', found ' || CAST(n AS STRING) END AS error_message
FROM (SELECT lang, count(DISTINCT nullif(trim(source), '')) AS n, min(nullif(trim(source), '')) AS v FROM documents GROUP BY lang)""")
def _(t):
    return outcomes.require_single(outcomes.distinct_values(t("documents"), [], "lang", "source"), code="lang").select("lang", "distinct_values", "single_value", "error_message")


@query("f11_observation_multimap", """SELECT msg_id, 1 AS order_no, 2 + CASE WHEN o_orderkey % 4 = 1 THEN 1 ELSE 0 END - 1 AS series, CASE WHEN o_orderkey % 11 = 0 THEN o_orderpriority || ',OTHER' ELSE o_orderpriority END AS projects FROM orm
UNION ALL SELECT msg_id, 2, 1, o_orderpriority FROM orm""")
def _(t):
    from scanloom.operators import hl7
    groups = t("orm").withColumn("_s", hl7.segments("raw")).select("msg_id", F.posexplode(hl7.order_groups("_s")).alias("order_no", "g"))
    m = groups.select("msg_id", (F.col("order_no") + 1).alias("order_no"), hl7.observation_map("g.observations").alias("m"))
    return m.select("msg_id", "order_no", F.size(F.col("m")["SERIES_UID"]).alias("series"), F.array_join(F.col("m")["PROJECT_ID"], ",").alias("projects"))


@query("f11_observation_values", """SELECT msg_id, order_no, code, string_agg(v, ',' ORDER BY pos) AS found FROM (
SELECT msg_id, order_no, pos, split_part(split_part(seg, '|', 4), '^', 1) AS code, replace(split_part(seg, '|', 6), chr(92) || 'S' || chr(92), '^') AS v FROM (
SELECT msg_id, order_no, unnest(segs) AS seg, unnest(range(1, len(segs) + 1)) AS pos FROM (
SELECT msg_id, order_no, string_split(part, chr(13)) AS segs FROM (SELECT msg_id, unnest(string_split(raw, 'ORC|')[2:]) AS part, unnest(range(1, len(string_split(raw, 'ORC|')))) AS order_no FROM orm))) WHERE seg LIKE 'OBX|%') GROUP BY ALL""")
def _(t):
    from scanloom.operators import hl7
    groups = t("orm").withColumn("_s", hl7.segments("raw")).select("msg_id", F.posexplode(hl7.order_groups("_s")).alias("order_no", "g"))
    values = groups.select("msg_id", (F.col("order_no") + 1).alias("order_no"), F.explode(hl7.observation_map("g.observations")).alias("code", "_v"))
    return values.select("msg_id", "order_no", "code", F.array_join("_v", ",").alias("found"))


@query("f12_entry_name_digest", "SELECT package, count(*) AS entry_count, sha256(string_agg(entry_name, chr(10) ORDER BY entry_name)) AS names_sha256 FROM (SELECT DISTINCT package, entry_name FROM package_actual) GROUP BY package")
def _(t):
    return packages.entry_name_digest(t("package_actual"), ["package"])


@query("f13_event_batches", """SELECT user_id, batch_no, count(*) AS event_count, md5('{"events":[' || string_agg('{"eventId":"' || id || '","eventType":"' || event_type || '","retrieveId":"' || CAST(user_id AS STRING) || '"}', ',' ORDER BY id) || ']}') AS body_md5 FROM (
SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY md5(id), id) - 1) // 100 AS batch_no FROM (SELECT user_id, event_type, CAST(event_id AS STRING) AS id FROM events)) GROUP BY user_id, batch_no""")
def _(t):
    ev = t("events").select("user_id", F.struct(F.col("event_id").cast("string").alias("eventId"), F.col("event_type").alias("eventType"), F.col("user_id").cast("string").alias("retrieveId")).alias("event"))
    return events.event_batches(ev, 100, ("user_id",)).select("user_id", "batch_no", "event_count", F.md5("body").alias("body_md5"))


@query("f14_row_count", "SELECT count(*) AS n FROM lineitem")
def _(t):
    return t("lineitem").agg(F.count(F.lit(1)).alias("n"))


# --- G ----------------------------------------------------------------------------------------

@query("g1_match_index", "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY md5(CAST(o_orderkey AS STRING)), CAST(o_orderkey AS STRING)) - 1 AS match_index FROM orders")
def _(t):
    return keyed.numbered(t("orders").select("o_custkey", "o_orderkey"), ["o_custkey"], "o_orderkey", "match_index")


@query("g2_batch_numbers", "SELECT event_type, batch_no, count(*) AS n FROM (SELECT event_type, (row_number() OVER (PARTITION BY event_type ORDER BY md5(CAST(event_id AS STRING))) - 1) // 50 AS batch_no FROM events) GROUP BY 1, 2")
def _(t):
    return keyed.batched(t("events").select("event_type", "event_id"), ["event_type"], "event_id", 50).groupBy("event_type", "batch_no").agg(F.count(F.lit(1)).alias("n"))


@query("g3_fragment_index", "SELECT package, entry_name, row_number() OVER (PARTITION BY package ORDER BY md5(entry_name), entry_name) - 1 AS fragment_index, count(*) OVER (PARTITION BY package) AS fragment_count FROM package_expected")
def _(t):
    return packages.numbered_fragments(t("package_expected"), ["package"], "entry_name")


@query("g4_first_row_wins", "SELECT pid, arg_min(prefix, id) AS prefix, min(id) AS id FROM pseudonyms GROUP BY pid")
def _(t):
    return keyed.first_row_per_key(t("pseudonyms"), ["pid"], ["id"]).select("pid", "prefix", "id")


@query("g5_sorted_names", "SELECT package, count(*) AS entry_count, sha256(string_agg(entry_name, chr(10) ORDER BY entry_name)) AS names_sha256 FROM package_expected GROUP BY package")
def _(t):
    # A limit of 50 sends the larger packages through the incremental path over a spilled sort.
    return packages.entry_name_digest(t("package_expected"), ["package"])


@query("g6_first_twenty", "SELECT package, string_agg(entry_name, ',' ORDER BY entry_name) AS names FROM (SELECT *, row_number() OVER (PARTITION BY package ORDER BY entry_name) AS r FROM package_expected) WHERE r <= 20 GROUP BY package")
def _(t):
    return keyed.smallest_per_group(t("package_expected"), ["package"], "entry_name", 20, "names").withColumn("names", F.array_join("names", ","))


@query("g7_set_difference", "(SELECT package, entry_name, 'missing' AS side FROM package_expected EXCEPT SELECT package, entry_name, 'missing' FROM package_actual) UNION ALL (SELECT package, entry_name, 'unexpected' FROM package_actual EXCEPT SELECT package, entry_name, 'unexpected' FROM package_expected)")
def _(t):
    e, a = t("package_expected"), t("package_actual")
    return packages.entry_difference(e, a, ["package"]).withColumn("side", F.lit("missing")).unionByName(packages.entry_difference(a, e, ["package"]).withColumn("side", F.lit("unexpected")))


@query("g8_duplicates", "SELECT package, entry_name, count(*) AS times FROM package_actual GROUP BY 1, 2 HAVING count(*) > 1")
def _(t):
    return packages.duplicate_entries(t("package_actual"), ["package"])


_PACK = "SELECT package, CASE WHEN package LIKE 'de.%' THEN 'other' ELSE 'o' END AS manifest_order_id, count(*) AS fragment_count FROM package_expected GROUP BY 1, 2"


@query("g9_package_validation", f"""WITH p AS ({_PACK}), x AS (SELECT DISTINCT package, entry_name FROM package_expected), a AS (SELECT package, entry_name, count(*) AS c FROM package_actual GROUP BY 1, 2),
m AS (SELECT package, string_agg(entry_name, ', ' ORDER BY entry_name) FILTER (WHERE r <= 20) AS names FROM (SELECT *, row_number() OVER (PARTITION BY package ORDER BY entry_name) AS r FROM (SELECT package, entry_name FROM x EXCEPT SELECT package, entry_name FROM a)) GROUP BY 1),
u AS (SELECT package, string_agg(entry_name, ', ' ORDER BY entry_name) FILTER (WHERE r <= 20) AS names FROM (SELECT *, row_number() OVER (PARTITION BY package ORDER BY entry_name) AS r FROM (SELECT package, entry_name FROM a EXCEPT SELECT package, entry_name FROM x)) GROUP BY 1),
n AS (SELECT package, count(*) AS names, min(CASE WHEN c > 1 THEN entry_name END) AS dup FROM a GROUP BY 1)
SELECT p.package, CASE WHEN manifest_order_id <> 'o' THEN 'Manifest order/retrieval mismatch' WHEN dup IS NOT NULL THEN 'Duplicate ZIP entry: ' || dup
  WHEN n.names <> fragment_count THEN 'ZIP entry count mismatch: expected=' || CAST(fragment_count AS STRING) || ', actual=' || CAST(n.names AS STRING)
  WHEN m.names IS NOT NULL OR u.names IS NOT NULL THEN left('ZIP contents do not match manifest. Missing=[' || coalesce(m.names, '') || '], Unexpected=[' || coalesce(u.names, '') || ']', 1000) END AS error_message
FROM p LEFT JOIN n USING (package) LEFT JOIN m ON m.package = p.package LEFT JOIN u ON u.package = p.package""")
def _(t):
    e = t("package_expected")
    p = e.groupBy("package").agg(F.count(F.lit(1)).alias("fragment_count")).select(
        "package", F.when(F.startswith("package", F.lit("de.")), "other").otherwise("o").alias("manifest_order_id"), F.lit("r").alias("manifest_retrieve_id"), F.lit("o").alias("order_id"), F.lit("r").alias("retrieve_id"),
        "fragment_count", F.lit(None).cast("string").alias("entry_names_sha256"))
    return packages.validate_packages(p, e, t("package_actual"), ["package"]).select("package", "error_message")


# --- H ----------------------------------------------------------------------------------------

_DA = "replace(substr(CAST(l_shipdate AS STRING), 1, 10), '-', '')"


def _ship(t):
    return t("lineitem").withColumn("da", F.expr(_DA)).withColumn("days", (F.col("l_linenumber") * 37 - 150).cast("int"))


@query("h1_shift_da", f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE CAST(l_partkey % 6 AS INT) WHEN 0 THEN {shifted('da', 'days')} WHEN 1 THEN {shifted('da', 'days')} WHEN 2 THEN {shifted('da', 'days')} || '-' || {shifted('da', 'days')}
  WHEN 3 THEN {shifted('da', 'days')} || '-' WHEN 4 THEN '' ELSE '-' || {shifted('da', 'days')} END AS moved FROM (SELECT *, {_DA} AS da, l_linenumber * 37 - 150 AS days FROM lineitem)""")
def _(t):
    da, k = F.col("da"), F.col("l_partkey") % 6
    dotted = F.concat_ws(".", F.substring(da, 1, 4), F.substring(da, 5, 2), F.substring(da, 7, 2))
    v = (F.when(k == 0, da).when(k == 1, dotted).when(k == 2, F.concat(da, F.lit(" - "), da)).when(k == 3, F.concat(da, F.lit("-"))).when(k == 4, F.concat(F.substring(da, 1, 4), F.lit("0230"))).otherwise(F.concat(F.lit("-"), da)))
    return _ship(t).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", dates.shift_da(v, F.col("days")).alias("moved"))


@query("h2_shift_dt", f"""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '' ELSE {shifted("replace(substr(CAST(ts AS STRING), 1, 10), '-', '')", 'event_id % 200 - 100')} || CASE WHEN event_id % 2 = 0 THEN '101530.25+0100' ELSE '' END END AS moved FROM events""")
def _(t):
    k, day = F.col("event_id"), F.expr("replace(substr(CAST(ts AS STRING), 1, 10), '-', '')")
    v = F.when(k % 5 == 0, F.substring(day, 1, 6)).otherwise(F.concat(day, F.when(k % 2 == 0, "101530.25+0100").otherwise("")))
    return t("events").select("event_id", dates.shift_dt(v, (k % 200 - 100).cast("int")).alias("moved"))


@query("h3_shift_range", "SELECT o_orderkey, abs(o_orderkey * 7 - 50000) <= 36500 AS ok FROM orders")
def _(t):
    return t("orders").select("o_orderkey", dates.shift_in_range(F.col("o_orderkey") * 7 - 50000).alias("ok"))


@query("h4_region_text", """SELECT p_partkey, CASE WHEN p_partkey % 5 IN (1, 3) OR p_size = 0 THEN NULL WHEN p_partkey % 5 = 2 THEN 2 ELSE 1 END AS regions, CASE WHEN p_partkey % 5 IN (1, 3) OR p_size = 0 THEN NULL ELSE p_size END AS width FROM part""")
def _(t):
    k, w = F.col("p_partkey") % 5, F.col("p_size").cast("string")
    one = F.concat(F.lit("[1, 2,"), w, F.lit(",4 ]"))
    v = F.when(k == 1, F.concat(one, F.lit(",,"), one)).when(k == 2, F.concat(one, F.lit(" , [0,0,-1,80]"))).when(k == 3, F.concat(F.lit("x"), one)).otherwise(one)
    return t("part").select("p_partkey", pixels.region_list(v).alias("r")).select("p_partkey", F.when(F.col("r").isNotNull(), F.size("r")).alias("regions"), F.get("r", F.lit(0))["width"].alias("width"))


@query("h5_fill_colour", """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN v WHEN 1 THEN v WHEN 2 THEN v ELSE NULL END AS colour, CASE WHEN p_partkey % 4 = 3 THEN NULL WHEN p_partkey % 4 = 2 THEN 8 ELSE v END AS octal
FROM (SELECT p_partkey, CAST(CASE WHEN p_partkey % 4 = 2 THEN 10 ELSE p_partkey * 31 % 16777216 END AS INT) AS v FROM part)""")
def _(t):
    k, v = F.col("p_partkey") % 4, F.col("p_partkey") * 31 % 16777216
    txt = F.when(k == 0, v.cast("string")).when(k == 1, F.concat(F.when(F.col("p_partkey") % 8 == 1, "#").otherwise("0x"), F.hex(v))).when(k == 2, "010").otherwise("16777216")
    return t("part").select("p_partkey", pixels.fill_colour(txt).alias("colour"), pixels.fill_colour(txt, True).alias("octal"))


_RGB = "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST((l_partkey * 7919 + l_orderkey * 31 + l_suppkey) % 16777216 AS INT) AS rgb FROM lineitem"


def _chan(a, b, c, off):
    return f"greatest(0, least(255, CAST(floor(CAST({a}::FLOAT * r {b}::FLOAT * g {c}::FLOAT * b {off} AS DOUBLE) + 0.5) AS INT)))"


@query("h6_rgb_to_ybr", f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {_chan('0.299', '+ 0.587', '+ 0.114', '')} * 65536 + {_chan('-0.168736', '- 0.331264', '+ 0.5', '+ 128::FLOAT')} * 256 + {_chan('0.5', '- 0.418688', '- 0.081312', '+ 128::FLOAT')} AS ybr
FROM (SELECT *, CAST((rgb >> 16) & 255 AS FLOAT) AS r, CAST((rgb >> 8) & 255 AS FLOAT) AS g, CAST(rgb & 255 AS FLOAT) AS b FROM ({_RGB}))""")
def _(t):
    rgb = ((F.col("l_partkey") * 7919 + F.col("l_orderkey") * 31 + F.col("l_suppkey")) % 16777216).cast("int")
    return t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", rgb.alias("rgb")).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", pixels.rgb_to_ybr_full("rgb").alias("ybr"))


@query("h7_compression_ratio", """SELECT p_partkey, CASE WHEN p_size % 5 > 0 THEN CAST(q // 100 AS STRING) || '.' || lpad(CAST(q % 100 AS STRING), 2, '0') END AS ratio, p_size * 16 * 2 * 3 AS uncompressed FROM (
SELECT *, (200 * (p_size * 16 * 2 * 3) + p_size % 5) // nullif(2 * (p_size % 5), 0) AS q FROM part)""")
def _(t):
    size = pixels.uncompressed_bytes(F.col("p_size"), F.lit(16), F.lit(None).cast("int"), F.lit(12), F.lit(3))
    return t("part").select("p_partkey", pixels.compression_ratio(size, F.col("p_size") % 5).alias("ratio"), size.alias("uncompressed"))


@query("h8_lossy_method", "SELECT sop_instance_uid, CASE o_orderkey % 11 WHEN 4 THEN 'ISO_10918_1' WHEN 5 THEN 'ISO_15444_1' END AS method FROM inst")
def _(t):
    return t("inst").select("sop_instance_uid", pixels.lossy_method("transfer_syntax_uid").alias("method"))


@query("h10_status_hex", "SELECT o_orderkey, printf('%04X', CAST(o_orderkey * 13 % 65536 AS INT)) AS status FROM orders")
def _(t):
    return t("orders").select("o_orderkey", outcomes.status_hex(F.col("o_orderkey") * 13).alias("status"))


@query("h11_hl7_escapes", """SELECT c_custkey, c_name || CASE c_custkey % 6 WHEN 0 THEN '^' WHEN 1 THEN '&' WHEN 2 THEN '~' WHEN 3 THEN chr(92) || 'S' || chr(92) WHEN 4 THEN '|' ELSE chr(92) || '.br' || chr(92) END || c_mktsegment AS v FROM customer""")
def _(t):
    k = F.col("c_custkey") % 6
    esc = F.when(k == 0, "\\S\\").when(k == 1, "\\T\\").when(k == 2, "\\R\\").when(k == 3, "\\E\\S\\E\\").when(k == 4, "\\F\\").otherwise("\\.br\\")
    return t("customer").select("c_custkey", text.hl7_unescaped(F.concat("c_name", esc, "c_mktsegment")).alias("v"))


@query("h12_truncation", "SELECT doc_id, left(text, 300) || CASE WHEN length(text) > 300 THEN '...' ELSE '' END AS short, left(regexp_replace(upper(source || '-' || lang), '[^A-Z0-9_]', '_', 'g'), 50) AS code FROM documents")
def _(t):
    return t("documents").select("doc_id", text.abbreviated("text", 300).alias("short"), text.normalised_code(F.concat_ws("-", "source", "lang")).alias("code"))


@query("h13_delivery_fields", """SELECT p_partkey, regexp_full_match(v, '[A-Za-z0-9._-]{1,16}') AS aet, regexp_full_match(v, '[A-Za-z0-9]([A-Za-z0-9.-]{0,253}[A-Za-z0-9])?') AS host,
  regexp_full_match(v, '[A-Za-z0-9][A-Za-z0-9._-]{0,63}') AND NOT contains(v, '..') AS directory, CAST(p_size * 2000 AS INT) BETWEEN 1 AND 65535 AS port FROM (SELECT p_partkey, p_size, CASE WHEN p_partkey % 3 = 0 THEN replace(p_name, ' ', '..') WHEN p_partkey % 3 = 1 THEN replace(p_name, ' ', '-') ELSE p_name END AS v FROM part)""")
def _(t):
    k = F.col("p_partkey") % 3
    v = F.when(k == 0, F.replace("p_name", F.lit(" "), F.lit(".."))).when(k == 1, F.replace("p_name", F.lit(" "), F.lit("-"))).otherwise(F.col("p_name"))
    return t("part").select("p_partkey", "p_size", v.alias("v")).select(
        "p_partkey", text.full_match("v", text.AET_PATTERN).alias("aet"), text.full_match("v", text.HOST_PATTERN).alias("host"), text.directory_ok("v").alias("directory"),
        text.delivery_port_ok((F.col("p_size") * 2000).cast("string")).alias("port"))


@query("h14_day_shift_text", """SELECT o_orderkey, CASE WHEN o_orderkey % 5 IN (3, 4) THEN NULL ELSE nullif(CAST(d AS INT), 0) END AS days, CASE o_orderkey % 5 WHEN 3 THEN 'Invalid DATE_SHIFT_DAYS: not a whole number' WHEN 4 THEN 'Invalid DATE_SHIFT_DAYS: outside +/-36500 days' END AS error FROM (SELECT o_orderkey, o_custkey % 21 - 10 AS d FROM orders)""")
def _(t):
    k, d = F.col("o_orderkey") % 5, (F.col("o_custkey") % 21 - 10)
    v = F.when(k == 3, F.concat(d.cast("string"), F.lit(".5"))).when(k == 4, "-36501").when((k == 1) & (d > 0), F.concat(F.lit(" +"), d.cast("string"))).otherwise(d.cast("string"))
    return t("orders").select("o_orderkey", text.day_shift(v).alias("days"), text.day_shift_error(v).alias("error"))


@query("h15_json_numbers", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_linenumber AS STRING) AS small, '"' || CAST(9007199254740992 + l_partkey AS STRING) || '"' AS large, '"' || l_returnflag || '"' AS illegal, '"' || CAST(l_linenumber AS STRING) || '"' AS plain FROM lineitem""")
def _(t):
    n = F.col("l_linenumber").cast("string")
    big = (F.lit(9007199254740992) + F.col("l_partkey")).cast("string")
    return t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", documents.json_number(n, F.lit("IS"), True).alias("small"), documents.json_number(big, F.lit("SV"), True).alias("large"),
                                documents.json_number(F.col("l_returnflag"), F.lit("DS"), True).alias("illegal"), documents.json_number(n, F.lit("IS")).alias("plain"))


@query("h16_base64", "SELECT doc_id, to_base64(encode(text)) AS inline_binary FROM documents")
def _(t):
    return t("documents").select("doc_id", F.regexp_replace(F.base64(F.encode("text", "UTF-8")), r"\s", "").alias("inline_binary"))


@query("h17_study_series_key", "SELECT request_id, trim(split_part(content, ',', 1)) AS study, CASE WHEN contains(content, ',') THEN trim(split_part(content, ',', 2)) END AS series FROM requests")
def _(t):
    return t("requests").select("request_id", text.study_series_key("content").alias("k")).select("request_id", "k.study", "k.series")


@query("h18_joined_messages", f"SELECT o_orderkey, coalesce(nullif(concat_ws(' | ', get_error, error_comment, CASE WHEN NOT {blank('result_error')} THEN result_error END), ''), 'C-GET failed without details') AS message FROM retrievals")
def _(t):
    return t("retrievals").select("o_orderkey", text.joined_messages(F.col("get_error"), F.col("error_comment"), F.col("result_error"), default="C-GET failed without details").alias("message"))


@query("h19_json_payloads", """SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'Missing payload' WHEN 1 THEN 'payload is not valid JSON (length ' || CAST(length(props) - 1 AS STRING) || ')' END AS error FROM events""")
def _(t):
    k = F.col("event_id") % 3
    v = F.when(k == 0, " ").when(k == 1, F.substring("props", F.lit(1), F.length("props") - 1)).otherwise(F.col("props"))
    return t("events").select("event_id", v.alias("v")).select("event_id", text.json_error("v", "Missing payload", "payload is not valid JSON (length %d)").alias("error"))


