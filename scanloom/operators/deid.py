"""De-identification of element tables: remove, empty, replace, remap, retain, shift, mark.

``elements`` has one row per attribute; ``item_path`` holds the enclosing sequences from the root
(tag, keyword, item). A nested rule is therefore a predicate on one row and no plan recurses.
``header`` has one row per instance with what a rule needs to know about the whole instance
(:func:`header_of`). Joining the two on the instance UID is the only shuffle; tables bucketed by
``sop_instance_uid`` need none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.functions import actions as A
from scanloom.functions import vocabulary as V
from scanloom.functions.dates import MAX_DAYS, date_type, shifted_values
from scanloom.functions.identifiers import name_uuid, remap_uid, remap_uids
from scanloom.functions.text import blank_to_null, col, first_error, is_blank
from scanloom.operators.keyed import first_row_per_key, in_tasks, lookup_join, small_join

ITEM_PATH = "array<struct<tag:string,keyword:string,item:int>>"
ELEMENT_SCHEMA = (
    f"sop_instance_uid string, item_path {ITEM_PATH}, tag string, keyword string, vr string, "
    "private_creator string, values array<string>, bin binary, ord int")
ELEMENT_COLUMNS = ["sop_instance_uid", "item_path", "tag", "keyword", "vr", "private_creator", "values", "bin", "ord"]

# Dummy per VR (binary VRs take eight zero bytes, all others REMOVED).
DUMMIES = [("DA", "19991111"), ("DT", "19991111111111"), ("TM", "111111"), ("IS", "0"), ("DS", "0"), ("US", "0"), ("AS", "0"), ("UL", "0")]
BINARY_VRS = ["OB", "OD", "OF", "OL", "OV", "OW", "UN"]


@dataclass(frozen=True)
class Profile:
    """Options of the confidentiality profile.

    ``dates``: ``by_shift`` keeps (and shifts) dates of instances whose day shift is not 0 and
    removes them from the others; ``removed``, ``modified`` and ``full`` fix the choice.
    """

    retain_device: bool = False
    retain_institution: bool = False
    retain_uids: bool = False
    dates: str = "by_shift"
    patient_id_hash: bool = False

    def shifting(self, days: Column) -> Column:
        if self.dates == "by_shift":
            return F.coalesce(days, F.lit(0)) != 0
        return F.lit(self.dates == "modified")


class ActionPlan:
    """Action of every keyword of an action table under a profile: one with, one without a date shift.

    The table is bounded by the attribute dictionary. It is compiled once and meets the rows as a broadcast hash
    join, one probe a row; only the ancestors held in ``item_path`` are looked up in literal sets.
    """

    MOST = 100_000

    def __init__(self, rows, profile: Profile = Profile()):
        """``rows``: keyword, action, group and, for the date group, whether a date shift keeps the entry."""
        skipped = {g for g, on in (("device", profile.retain_device), ("institution", profile.retain_institution),
                                   ("uid", profile.retain_uids), ("dates", profile.dates == "full")) if on}
        self.profile = profile
        rank = {a: i for i, a in enumerate("XZD" if profile.retain_uids else "XZDU")}  # X wins over Z, D and U
        self.shifted: dict[str, str] = {}
        self.plain: dict[str, str] = {}
        for r in rows:
            keyword, action, group = r[0], r[1], r[2]
            if group in skipped or action not in rank:
                continue
            temporal = group == "dates" and (len(r) < 4 or bool(r[3]))
            for chosen in (self.plain,) if temporal else (self.plain, self.shifted):
                if keyword not in chosen or rank[action] < rank[chosen[keyword]]:
                    chosen[keyword] = action
        if len(self.plain) > self.MOST:
            raise ValueError(f"an action table has one row for each attribute; this one names more than {self.MOST}")

    @classmethod
    def of(cls, actions: DataFrame, profile: Profile = Profile()) -> ActionPlan:
        """Plan of an action table (keyword, action, grp, temporal); it has one row per keyword and action."""
        return cls([tuple(r) for r in actions.select("keyword", "action", "grp", "temporal").distinct().collect()], profile)

    @classmethod
    def default(cls, profile: Profile = Profile()) -> ActionPlan:
        return cls(A.named_actions(), profile)

    def attach(self, rows: DataFrame, shifted: str = "_shifted", plain: str = "_plain") -> DataFrame:
        """``rows`` with the actions of their keyword (X, Z, D, U, or NULL where it stays) with and without a date shift."""
        table = rows.sparkSession.createDataFrame([(k, self.shifted.get(k), a) for k, a in sorted(self.plain.items())], f"keyword string, {shifted} string, {plain} string")
        return rows.join(F.broadcast(table), "keyword", "left")  # at most MOST rows

    def ancestor(self, retain: list[str]) -> str:
        """SQL text for ``p``, a step of a path: 1 its subtree goes, 2 it stays whole, 3 and 4 the same without a date
        shift only, 0 no rule."""
        names = _quoted(retain) or "''"
        always = _quoted(sorted(k for k, a in self.shifted.items() if a in "XZD")) or "''"
        plain = _quoted(sorted(k for k, a in self.plain.items() if a in "XZD")) or "''"
        return (f"CASE WHEN {stripped_group('p.tag')} THEN 1 WHEN p.keyword IN ({always}) THEN CASE WHEN p.keyword IN ({names}) THEN 2 ELSE 1 END "
                f"WHEN p.keyword IN ({plain}) THEN CASE WHEN p.keyword IN ({names}) THEN 4 ELSE 3 END ELSE 0 END")


def _quoted(names) -> str:
    return ", ".join("'" + n.replace("'", "''") + "'" for n in names)


def stripped_group(tag: str) -> str:
    """SQL test for private (odd group), curve (50xx) and overlay (60xx) attributes."""
    return f"(substr({tag}, 4, 1) IN ('1', '3', '5', '7', '9', 'B', 'D', 'F', 'b', 'd', 'f') OR substr({tag}, 1, 2) IN ('50', '60'))"


def dummy_value(vr: Column) -> Column:
    return F.coalesce(V.pick(vr, DUMMIES), F.when(~vr.isin(BINARY_VRS), "REMOVED"))


HEADER_KEYWORDS = {"SOPClassUID": "sop_class_uid", "StudyInstanceUID": "study_uid", "SeriesInstanceUID": "series_uid", "PatientID": "patient_id",
                   "IssuerOfPatientID": "issuer_of_patient_id", "Modality": "modality"}


def header_of(elements: DataFrame, tasks: int | None = None) -> DataFrame:
    """One row per instance: the root attributes that whole-instance rules look at.

    Only the rows of those attributes are grouped (the keyword filter reaches the scan), a handful
    per instance instead of hundreds; its first row (``ord`` 0) keeps an instance without any. Rows without
    an instance UID belong to no instance.

    ``tasks`` deals the instances into that many parts, so that no task grows with the table: one part is sorted at a
    time, here and in a join of elements with this header. Without it the session's shuffle partitions decide.
    """
    root = F.size("item_path") == 0
    in_methods = (F.size("item_path") == 1) & (F.get("item_path", F.lit(0))["keyword"] == "DeidentificationMethodCodeSequence") & (F.col("keyword") == "CodeValue")
    wanted = F.coalesce(F.col("keyword").isin(*HEADER_KEYWORDS, "SOPInstanceUID", "CodeValue") & (root | in_methods), F.lit(False))
    rows = elements.filter(F.col("sop_instance_uid").isNotNull() & (wanted | (F.col("ord") == 0))).select(
        "sop_instance_uid", F.when(root, F.col("keyword")).alias("_root"), F.when(root, F.get("values", F.lit(0))).alias("_first"),
        F.when(in_methods, F.get("item_path", F.lit(0))["item"] + 1).alias("_methods"))
    rows = in_tasks(rows, tasks, "sop_instance_uid")
    values = [F.max(F.when(F.col("_root") == k, F.col("_first"))).alias(c) for k, c in HEADER_KEYWORDS.items()]
    grouped = rows.groupBy("sop_instance_uid").agg(*values, F.coalesce(F.max("_methods"), F.lit(0)).alias("method_items"))
    # Kept together, so that rules and generated rows, which need different columns, share one scan and shuffle.
    columns = [*HEADER_KEYWORDS.values(), "method_items"]
    return grouped.select("sop_instance_uid", F.inline(F.array(F.struct(*columns))))


def retained_keywords(retain: str | None, known: list[str] | None = None) -> list[str]:
    """Comma list of keywords; names that the dictionary does not know are dropped silently."""
    names = [n.strip() for n in (retain or "").split(",") if n.strip()]
    return [n for n in names if known is None or n in known]


def annotate_actions(elements: DataFrame, plan: ActionPlan, days: Column | None = None) -> DataFrame:
    """Add the action of each row (X, Z, D, U or NULL), ancestors not considered."""
    shifting = plan.profile.shifting(F.lit(None).cast("int") if days is None else days)
    own = F.when(shifting, F.col("_shifted")).otherwise(F.col("_plain"))
    rows = plan.attach(elements).withColumn("action", F.when(F.expr(stripped_group("tag")), "X").otherwise(own))
    return rows.select(*elements.columns, "action")


def resolve_dates(elements: DataFrame) -> DataFrame:
    """Rows of date attributes, at any depth, with their type by the dictionary where a file gives another or none.

    DA and DT stay as given. Text that an unknown type left in ``bin`` becomes values; an unreadable one becomes text that no shift
    accepts, so it is emptied. Sequences are left alone."""
    given = F.coalesce(F.col("vr"), F.lit(""))
    kind = F.when(~given.isin("DA", "DT", "SQ"), date_type("keyword"))
    hidden = kind.isNotNull() & (F.coalesce(F.size("values"), F.lit(0)) <= 0) & F.col("bin").isNotNull()
    text = F.split(F.btrim(F.decode("bin", "ISO-8859-1"), F.lit("\0 ")), r"\\")
    return elements.withColumns({
        "vr": F.coalesce(kind, F.col("vr")), "values": F.when(hidden, text).otherwise(F.col("values")),
        "bin": F.when(kind.isNull(), F.col("bin"))})


def join_actions(elements: DataFrame, actions: DataFrame) -> DataFrame:
    """Left join of elements with an action table on the keyword (X before Z, D, U)."""
    one = (actions.withColumn("_p", F.instr(F.lit("XZDU"), F.col("action"))).groupBy("keyword")
           .agg(F.min_by("action", "_p").alias("action")))
    return small_join(elements, one, ["keyword"], "sop_instance_uid")


def join_dictionary(elements: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Attach tag and VR by keyword; an unknown keyword drops out."""
    return small_join(elements, dictionary, ["keyword"], "sop_instance_uid", "inner")


def apply_rules(elements: DataFrame, header: DataFrame, plan: ActionPlan, retain: list[str] | None = None, new_key: bool = False) -> DataFrame:
    """Remove, empty, replace, remap and retain; then study/series remap and date shift.

    ``header`` needs sop_instance_uid, sop_class_uid, study_uid, series_uid and days (NULL = no shift). With
    ``new_key`` the rows carry the remapped UID as their key; it is computed once per instance.
    """
    retain = retain or []
    facts = header.select("sop_instance_uid", (remap_uid("sop_instance_uid") if new_key else F.col("sop_instance_uid")).alias("_key"), F.col("days").alias("_days"),
                          F.coalesce(F.col("sop_class_uid") == V.PET_IMAGE, F.lit(False)).alias("_pet"),
                          (F.col("study_uid").isNotNull() & F.col("series_uid").isNotNull()).alias("_placed"))
    # What a row and its path say is settled before the join, with and without a date shift; above it only
    # plain columns are compared, so no list is evaluated twice. The outermost sequence with a rule decides.
    steps = F.expr(f"CASE WHEN size(item_path) > 0 THEN filter(transform(item_path, p -> {plan.ancestor(retain)}), c -> c > 0) END")
    rows = resolve_dates(elements).withColumn("_steps", steps)
    rows = rows.withColumns({"_in_shifted": F.get(F.filter("_steps", lambda c: c < 3), F.lit(0)), "_in_plain": F.get("_steps", F.lit(0))}).drop("_steps")
    names = _quoted(retain) or "''"
    rows = plan.attach(rows).withColumns({"_stripped": F.expr(stripped_group("tag")), "_retained": F.expr(f"coalesce(keyword IN ({names}) AND (vr = 'SQ' OR get(values, 0) <> ''), false)")})
    # Merge join: elements must never be chosen for a broadcast by a low size estimate, and
    # tables bucketed and sorted by instance need neither shuffle nor sort here.
    rows = rows.hint("merge").join(facts, "sop_instance_uid").withColumn("_shifting", plan.profile.shifting(F.col("_days")))
    within = "CASE WHEN _shifting THEN _in_shifted ELSE _in_plain END"
    rows = rows.withColumn("_within", F.expr(within)).filter("coalesce(_within, 0) NOT IN (1, 3)")

    # PET takes dummy series date and time (generated_rows) unless dates stay, even when retained.
    pet = "false" if plan.profile.dates == "full" else "(_pet AND NOT _shifting AND size(item_path) = 0 AND keyword IN ('SeriesDate', 'SeriesTime'))"
    effective = (f"CASE WHEN _within IN (2, 4) THEN 'keep' WHEN {pet} OR _stripped THEN 'X' WHEN _retained THEN 'R' "
                 f"WHEN _shifting THEN _shifted ELSE _plain END")
    rows = rows.withColumn("_action", F.expr(effective)).filter("coalesce(_action, '') <> 'X'")

    root, first = F.size("item_path") == 0, F.nullif(F.get("values", F.lit(0)), F.lit(""))
    sequence = F.col("vr") == "SQ"
    act, none = F.col("_action"), F.array().cast("array<string>")
    dummy = dummy_value(F.col("vr"))
    zeroes = F.col("vr").isin(BINARY_VRS)
    placed = F.col("_placed") & root & F.col("keyword").isin("StudyInstanceUID", "SeriesInstanceUID")
    # E12 uses the original first value, whatever the rules above made of it.
    placed_uid = F.array(first if plan.profile.retain_uids else remap_uid(first))
    values = (F.when(placed & first.isNotNull(), placed_uid)
              .when(act == "Z", none).when((act == "D") & (sequence | zeroes), none).when(act == "D", F.array(dummy))
              .when(act == "U", remap_uids("values")).when((act == "R") & ~sequence, F.array(first)).otherwise(F.col("values")))
    binary = (F.when(act == "Z", F.lit(None).cast("binary")).when((act == "D") & zeroes, F.lit(bytearray(8)))
              .when(act.isin("D", "R") & ~sequence, F.lit(None).cast("binary")).otherwise(F.col("bin")))
    rows = rows.withColumn("values", values).withColumn("bin", binary)
    rows = rows.withColumn("values", shifted_values("values", "vr", F.when(F.col("_shifting"), F.col("_days"))))
    # An emptied sequence has no items; its subtree was dropped above.
    return rows.select(F.col("_key").alias("sop_instance_uid"), *ELEMENT_COLUMNS[1:])


def method_codes(profile: Profile, shifting: bool) -> list[str]:
    """Codes of the applied options in order."""
    full = profile.dates == "full"
    options = [("113100", True), ("113106", full), ("113107", shifting and not full), ("113109", profile.retain_device),
               ("113112", profile.retain_institution), ("113110", profile.retain_uids)]
    return [code for code, applies in options if applies]


def _generated(profile: Profile, issuer: str | None, shifting: bool) -> list[tuple]:
    """tag, keyword, vr, value, item of the method codes, condition: the same for all instances with or without a shift."""
    codes = method_codes(profile, shifting)
    full = profile.dates == "full"
    rows = [("00120062", "PatientIdentityRemoved", "CS", ["YES"], None, None),
            ("00280303", "LongitudinalTemporalInformationModified", "CS", ["UNMODIFIED" if full else "MODIFIED" if shifting else "REMOVED"], None, None),
            ("00120063", "DeidentificationMethod", "LO", [V.METHOD_CODES[c] for c in codes], None, None), ("00120064", "DeidentificationMethodCodeSequence", "SQ", [], None, None)]
    for item, code in enumerate(codes):
        rows += [("00080100", "CodeValue", "SH", [code], item, None), ("00080102", "CodingSchemeDesignator", "SH", ["DCM"], item, None), ("00080104", "CodeMeaning", "LO", [V.METHOD_CODES[code]], item, None)]
    if not shifting and not full:
        rows += [("00080021", "SeriesDate", "DA", ["19991111"], None, "pet"), ("00080031", "SeriesTime", "TM", ["111111"], None, "pet")]
    rows += [("00100020", "PatientID", "LO", [], None, "pid"), ("00100010", "PatientName", "PN", [], None, "name")]
    return rows + ([("00100021", "IssuerOfPatientID", "LO", [issuer], None, None)] if issuer is not None else [])


def generated_rows(header: DataFrame, profile: Profile, issuer: str | None) -> DataFrame:
    """Marker, identity and correction rows of each instance, built from the header alone.

    A stored instance index can serve as header, so elements need no second scan. ``header`` may
    carry pseudonym_pid and pseudonym_name; without them PatientID and PatientName
    stay as the rules left them (or take the hash option).
    """
    shifting = profile.shifting(F.col("days"))
    none = F.lit(None).cast("string")
    has_identity = "pseudonym_pid" in header.columns
    pid = F.col("pseudonym_pid") if has_identity else none
    name = F.col("pseudonym_name") if has_identity else none
    if profile.patient_id_hash:
        # id^^^issuer is the text form of an identifier with its issuer
        source = F.concat_ws("^^^", F.col("patient_id"), F.nullif(F.col("issuer_of_patient_id"), F.lit("")))
        pid = F.coalesce(pid, F.when(F.col("patient_id").isNotNull(), name_uuid(source)))
    # Two constant lists; what depends on the instance is filled in behind the explode, in plain columns.
    kind = "array<struct<tag:string,keyword:string,vr:string,values:array<string>,item:int,only:string>>"
    both = [F.array(*[F.struct(*[F.array(*map(F.lit, x)) if isinstance(x, list) else F.lit(x) for x in row]) for row in _generated(profile, issuer, s)]).cast(kind) for s in (True, False)]
    base = F.coalesce(F.col("method_items"), F.lit(0)) if "method_items" in header.columns else F.lit(0)
    rows = header.select("sop_instance_uid", base.cast("int").alias("_base"), F.coalesce(F.col("sop_class_uid") == V.PET_IMAGE, F.lit(False)).alias("_pet"), pid.alias("_pid"), name.alias("_name"),
                         F.explode(F.when(shifting, both[0]).otherwise(both[1])).alias("r"))
    only = F.col("r.only")
    rows = rows.filter(only.isNull() | ((only == "pet") & F.col("_pet")) | ((only == "pid") & F.col("_pid").isNotNull()) | ((only == "name") & F.col("_name").isNotNull()))
    step = F.struct(F.lit("00120064").alias("tag"), F.lit("DeidentificationMethodCodeSequence").alias("keyword"), (F.col("_base") + F.col("r.item")).alias("item"))
    return rows.select(
        "sop_instance_uid", F.when(F.col("r.item").isNull(), F.array().cast(ITEM_PATH)).otherwise(F.array(step)).alias("item_path"), "r.tag", "r.keyword", "r.vr", F.lit(None).cast("string").alias("private_creator"),
        F.when(only == "pid", F.array("_pid")).when(only == "name", F.array("_name")).otherwise(F.col("r.values")).alias("values"), F.lit(None).cast("binary").alias("bin"), F.lit(0).alias("ord"))


def deidentify(elements: DataFrame, header: DataFrame, plan: ActionPlan | None = None, retain: str | None = None, issuer: str | None = None) -> DataFrame:
    """The whole pipeline. ``header`` = :func:`header_of` plus days and optional pseudonyms.

    Rows are keyed by the new SOP Instance UID, unless UIDs or this one are retained; :func:`result_uids` maps
    the original keys to the new ones and belongs to a restricted place.
    """
    plan = plan or ActionPlan.default()
    has_identity = "pseudonym_pid" in header.columns
    keep = retained_keywords(retain)
    moved = not plan.profile.retain_uids and "SOPInstanceUID" not in keep
    kept = apply_rules(elements, header, plan, keep, moved)
    if moved:
        header = header.withColumn("sop_instance_uid", remap_uid("sop_instance_uid"))
    replaced = ["PatientIdentityRemoved", "LongitudinalTemporalInformationModified", "DeidentificationMethod", "DeidentificationMethodCodeSequence"]
    replaced += ["IssuerOfPatientID"] if issuer is not None else []
    replaced += ["PatientID", "PatientName"] if has_identity else (["PatientID"] if plan.profile.patient_id_hash else [])
    root = F.size("item_path") == 0
    kept = kept.filter(~(root & F.coalesce(F.col("keyword").isin(replaced), F.lit(False))))
    return kept.unionByName(generated_rows(header, plan.profile, issuer))


def result_uids(header: DataFrame, plan: ActionPlan | None = None, retain: str | None = None) -> DataFrame:
    """New study, series and SOP instance UIDs per instance, derived without reading elements."""
    plan = plan or ActionPlan.default()
    same = plan.profile.retain_uids
    keep = retained_keywords(retain)
    both = F.col("study_uid").isNotNull() & F.col("series_uid").isNotNull()

    def moved(column, keyword, always):
        kept = same or (keyword in keep)
        own = F.col(column) if kept else remap_uid(column)
        return (F.when(both, F.col(column) if same else remap_uid(column)).otherwise(own)) if always else own

    return (header.withColumn("new_study_uid", moved("study_uid", "StudyInstanceUID", True))
            .withColumn("new_series_uid", moved("series_uid", "SeriesInstanceUID", True))
            .withColumn("new_sop_instance_uid", moved("sop_instance_uid", "SOPInstanceUID", False)))


def anonymise(elements: DataFrame, header: DataFrame | None = None, plan: ActionPlan | None = None, issuer: str | None = None) -> DataFrame:
    """No identity, dates removed, UIDs remapped."""
    base = header if header is not None else header_of(elements)
    return deidentify(elements, base.withColumn("days", F.lit(None).cast("int")), plan, None, issuer)


def lookup_pseudonyms(header: DataFrame, pseudonyms: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Attach pseudonym and day shift by patient id; adds route and error_message.

    ``pseudonyms(pid, prefix, postfix[, date_shift])``: the first row per pid wins; a NULL shift
    counts as 0, a missing shift column as unknown. Every row of the header is kept.
    """
    table = pseudonyms
    if not {"pid", "prefix", "postfix"} <= set(table.columns):
        raise ValueError("pseudonym table needs pid, prefix and postfix")
    shift = F.coalesce(F.col("date_shift"), F.lit(0)).cast("int") if "date_shift" in table.columns else F.lit(None).cast("int")
    columns = [c for c in (order or []) if c not in ("pid", "prefix", "postfix")]
    table = table.select(F.col("pid").alias("patient_id"), "prefix", "postfix", shift.alias("days"), F.lit(True).alias("_hit"), *columns)
    table = first_row_per_key(table, ["patient_id"], order or ["prefix", "postfix"]).drop(*columns)
    joined = lookup_join(header, table, ["patient_id"], "sop_instance_uid")
    out_of_range = F.coalesce(F.abs(F.col("days").cast("bigint")) > MAX_DAYS, F.lit(False))
    error = first_error((F.coalesce(F.col("patient_id") == "", F.lit(True)), "PID is not found"), (F.col("_hit").isNull(), "No results found"),
                        (out_of_range, "Date shift out of range"))
    return (joined.withColumn("error_message", error)
            .withColumn("route", F.when(F.col("error_message").isNull(), "success").otherwise("failure"))
            .withColumn("pseudonym_pid", F.concat(F.col("prefix"), F.lit("-"), F.col("postfix")))
            .withColumn("pseudonym_name", F.concat(F.col("prefix"), F.lit("^"), F.col("postfix"))).drop("_hit"))


def pseudonymise_by_lookup(elements: DataFrame, header: DataFrame, pseudonyms: DataFrame, retain: str | None = None, issuer: str | None = None,
                           plan: ActionPlan | None = None, order: list[str] | None = None) -> DataFrame:
    """Lookup form; instances without a pseudonym produce no elements (see the routed header)."""
    good = lookup_pseudonyms(header, pseudonyms, order).filter("route = 'success'")
    return deidentify(elements, good, plan, retain, issuer)


def attribute_pseudonym_checks(header: DataFrame, pid="pseudonym_pid", name="pseudonym_name", shift="date_shift_text") -> DataFrame:
    """Validate per-row pseudonym attributes in order; adds days, error_message and route."""
    text = blank_to_null(shift)
    number = text.try_cast("int")
    error = first_error(
        (text.isNotNull() & number.isNull(), "Invalid pseudonymization property value"),
        (is_blank(pid) | is_blank(name), "Missing pseudonym PID or name"),
        (number.isNull() | (F.abs(number.cast("bigint")) > MAX_DAYS), "Invalid date shift"),
        (F.coalesce(F.col("patient_id") == "", F.lit(True)), "PID is not found"),
        (is_blank("study_uid") | is_blank("series_uid") | is_blank("sop_instance_uid"),
         "Anonymized DICOM object is missing Study/Series/SOP Instance UID"))
    return (header.withColumn("days", number).withColumn("error_message", error)
            .withColumn("pseudonym_pid", col(pid)).withColumn("pseudonym_name", col(name))
            .withColumn("route", F.when(F.col("error_message").isNull(), "success").otherwise("failure")))


def pseudonymise_by_attributes(elements: DataFrame, header: DataFrame, retain: str | None = None, issuer: str | None = None,
                               plan: ActionPlan | None = None) -> DataFrame:
    good = attribute_pseudonym_checks(header).filter("route = 'success'")
    return deidentify(elements, good, plan, retain, issuer)


def surviving_values(before: DataFrame, after: DataFrame, keywords: list[str]) -> DataFrame:
    """Residual risk: (keyword, value) pairs of restricted attributes found before and after, text of unknown type included.

    Both sides are reduced to distinct pairs before they meet, so frequent values cost nothing.
    """
    hidden = F.split(F.btrim(F.decode("bin", "ISO-8859-1"), F.lit("\0 ")), r"\\")
    texts = F.when(F.size("values") > 0, F.col("values")).when(F.col("bin").isNotNull(), hidden)

    def pairs(df):
        rows = df.filter(F.col("keyword").isin(keywords)).select("keyword", F.explode(texts).alias("value"))
        if "SOPInstanceUID" in keywords:  # the key column must not give it away either
            rows = rows.union(df.select(F.lit("SOPInstanceUID"), "sop_instance_uid"))
        return rows.filter("value is not null and value <> ''").distinct()

    return pairs(after).join(pairs(before), ["keyword", "value"], "left_semi")
