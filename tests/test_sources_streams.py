"""Sources, sinks and streams on small fixtures."""

import datetime as dt
import io
import json
import random
import re
import struct
import zlib

import pytest
from pyspark.sql import functions as F
from test_deid import SAMPLE, SOP, elements

import __spark_entry__  # noqa: F401
from scanloom.operators import hl7
from scanloom.plans import queries_deid, registry
from scanloom.plans.registry import QUERIES
from scanloom.sources import headerfiles, instances, messages, sinks
from scanloom.streaming import flows


def attribute(tag, vr, data, undefined=False):
    group, number = int(tag[:4], 16), int(tag[4:], 16)
    data = data + b" " * (len(data) % 2) if vr not in ("SQ", "OB") else data
    size = 0xFFFFFFFF if undefined else len(data)
    if vr in headerfiles.LONG_LENGTH:
        return struct.pack("<HH2sHI", group, number, vr.encode(), 0, size) + data
    return struct.pack("<HH2sH", group, number, vr.encode(), size) + data


def part10(body, syntax=b"1.2.840.10008.1.2.1"):
    meta = attribute("00020010", "UI", syntax)
    return b"\0" * 128 + b"DICM" + attribute("00020000", "UL", struct.pack("<I", len(meta))) + meta + body


def item(data):
    return struct.pack("<HHI", 0xFFFE, 0xE000, len(data)) + data


def test_header_files(spark, tmp_path):
    inner = attribute("00080100", "SH", b"C1")
    body = (attribute("00080005", "CS", b"ISO_IR 100") + attribute("00080018", "UI", b"1.2.3") + attribute("00081140", "SQ", item(inner) + item(inner)) + attribute("00100010", "PN", "Müller^A".encode("latin-1"))
            + attribute("00101010", "AS", b"") + attribute("00280010", "US", struct.pack("<H", 512)) + attribute("00209228", "UL", struct.pack("<I", 70000))
            + attribute("0040A730", "SQ", struct.pack("<HHI", 0xFFFE, 0xE000, 0xFFFFFFFF) + inner + struct.pack("<HHI", 0xFFFE, 0xE00D, 0) + struct.pack("<HHI", 0xFFFE, 0xE0DD, 0), undefined=True)
            + attribute("7FE00010", "OW", b"\1" * 64))
    (tmp_path / "a.dcm").write_bytes(part10(body))
    (tmp_path / "bad.dcm").write_bytes(b"hello")
    implicit = struct.pack("<HHI", 0x0008, 0x0018, 4) + b"1.9\0" + struct.pack("<HHI", 0x0010, 0x0020, 2) + b"P1"
    (tmp_path / "c.dcm").write_bytes(implicit)
    df = headerfiles.read_headers(spark, str(tmp_path), ".dcm", {"00080018": "UI", "00100020": "LO"})
    rows = df.collect()
    good = [r for r in rows if r["path"].endswith("a.dcm")]
    values = {(tuple((p["tag"], p["item"]) for p in r["item_path"]), r["tag"]): r["values"] for r in good}
    assert values[((), "00100010")] == ["Müller^A"] and values[((), "00280010")] == ["512"] and values[((), "00209228")] == ["70000"]
    assert values[((("00081140", 1),), "00080100")] == ["C1"] and values[((("0040A730", 0),), "00080100")] == ["C1"]
    assert ((), "7FE00010") not in values and all(r["sop_instance_uid"] == "1.2.3" for r in good)
    assert [r["readable"] for r in rows if r["path"].endswith("bad.dcm")] == [False]
    assert {r["tag"]: r["values"] for r in rows if r["path"].endswith("c.dcm")} == {"00080018": ["1.9"], "00100020": ["P1"]}
    dictionary = spark.createDataFrame([("00100010", "PatientName", "PN"), ("00081140", "ReferencedImageSequence", "SQ"), ("00080100", "CodeValue", "SH")], "tag string, keyword string, vr string")
    named = headerfiles.with_keywords(df.filter("readable"), dictionary).filter("tag = '00080100' and item_path[0].tag = '00081140'").first()
    assert named["keyword"] == "CodeValue" and named["item_path"][0]["keyword"] == "ReferencedImageSequence"


def swapped(body):
    """Explicit little-endian attributes without sequences and numbers, as big-endian ones."""
    out, at = b"", 0
    while at < len(body):
        group, number, vr = struct.unpack_from("<HH2s", body, at)
        long = vr.decode() in headerfiles.LONG_LENGTH
        size = struct.unpack_from("<I" if long else "<H", body, at + (8 if long else 6))[0]
        start = at + (12 if long else 8)
        out += struct.pack(">HH2s", group, number, vr) + (struct.pack(">HI", 0, size) if long else struct.pack(">H", size)) + body[start:start + size]
        at = start + size
    return out


def head(data, **vrs):
    return headerfiles.read_head(io.BytesIO(data), "x", vrs)


def test_cut_files_are_unreadable():
    """Every prefix that ends between two attributes is a whole file; any other is cut."""
    inner = attribute("00080100", "SH", b"C1")
    parts = [attribute("00080018", "UI", b"1.2.3"), attribute("00100020", "LO", b"P1"), attribute("00081140", "SQ", item(inner) + item(inner)),
             attribute("0040A730", "SQ", struct.pack("<HHI", 0xFFFE, 0xE000, 0xFFFFFFFF) + inner + struct.pack("<HHI", 0xFFFE, 0xE00D, 0) + struct.pack("<HHI", 0xFFFE, 0xE0DD, 0), undefined=True)]
    whole = part10(b"".join(parts))
    ends, at = set(), len(part10(b""))
    for p in parts:
        at += len(p)
        ends.add(at)
    for n in range(len(whole) + 1):
        assert head(whole[:n])[0]["readable"] == (n in ends), n


def test_deflated_big_endian_and_icons():
    plain = attribute("00080018", "UI", b"1.2.3") + attribute("00100010", "PN", b"Marsh^Lee") + attribute("00420011", "OB", b"\1\2\3\4")
    want = [(r["tag"], r["values"], r["bin"]) for r in head(part10(plain))]
    packer = zlib.compressobj(wbits=-15)
    deflated = packer.compress(plain + attribute("7FE00010", "OW", bytes(1 << 20))) + packer.flush()
    got = head(part10(deflated, headerfiles.DEFLATED.encode()))
    assert [(r["tag"], r["values"], r["bin"]) for r in got] == want and got[0]["transfer_syntax_uid"] == headerfiles.DEFLATED
    assert not head(part10(deflated[:20], headerfiles.DEFLATED.encode()))[0]["readable"]
    big = swapped(plain) + struct.pack(">HH2sHH", 0x0028, 0x0010, b"US", 2, 512)
    got = head(part10(big, headerfiles.BIG_ENDIAN.encode()))
    assert [(r["tag"], r["values"], r["bin"]) for r in got] == [*want, ("00280010", ["512"], None)]
    piece = struct.pack("<HHI", 0xFFFE, 0xE000, 4) + b"\xff\xd8\xff\xd9"
    icon = attribute("7FE00010", "OB", piece + piece + struct.pack("<HHI", 0xFFFE, 0xE0DD, 0), undefined=True)
    rows = head(part10(attribute("00880200", "SQ", item(icon + attribute("00420010", "ST", b"after"))) + attribute("7FE00010", "OB", b"\0" * 10)))
    assert [(r["tag"], len(r["item_path"])) for r in rows] == [("00880200", 0), ("7FE00010", 1), ("00420010", 1)]


@pytest.mark.parametrize("terms, data, want", [
    (b"ISO_IR 100", "Müller^Jörg".encode("latin-1"), "Müller^Jörg"),
    (b"ISO_IR 192", "山田^太郎".encode(), "山田^太郎"),
    (b"\\ISO 2022 IR 87", b"Yamada^Tarou=\x1b$B;3ED\x1b(B^\x1b$BB@O:\x1b(B=\x1b$B$d$^$@\x1b(B^\x1b$B$?$m$&\x1b(B", "Yamada^Tarou=山田^太郎=やまだ^たろう"),
    (b"ISO 2022 IR 13\\ISO 2022 IR 87", b"\xd4\xcf\xc0\xde^\xc0\xdb\xb3=\x1b$B;3ED\x1b(J^\x1b$BB@O:\x1b(J", "ﾔﾏﾀﾞ^ﾀﾛｳ=山田^太郎"),
    (b"\\ISO 2022 IR 149", b"Hong^Gildong=\x1b$)C\xfb\xf3^\x1b$)C\xd1\xce\xd4\xd7=\x1b$)C\xc8\xab^\x1b$)C\xb1\xe6\xb5\xbf", "Hong^Gildong=洪^吉洞=홍^길동"),
    (b"ISO 2022 IR 100\\ISO 2022 IR 144", b"Gr\xfcn^\x1b-L\xbb\xee\xda^\xfc", "Grün^Люк^ü"),
    (b"GB18030", "王^小东".encode("gb18030"), "王^小东"),
])
def test_character_sets(terms, data, want):
    rows = head(part10(attribute("00080005", "CS", terms) + attribute("00100010", "PN", data)))
    assert rows[1]["values"] == [want]


def test_instance_index(spark):
    df = elements(spark, SAMPLE)
    row = instances.index_of(df).first()
    assert row["modality"] == "OT" and row["filename"] == f"{SOP}.dcm" and len(row["hex_study"]) == 32
    orders = spark.createDataFrame([(SOP, "o1", "shadowed")], "sop_instance_uid string, order_id string, patient_hint string")
    got = instances.retrieved_index(df, orders, ["order_id"]).first()
    assert got["attrs"]["order_id"] == "o1" and got["attrs"]["study_uid"] == "2.25.501" and got["route"] == "success"


def test_message_files(spark, tmp_path):
    (tmp_path / "a.hl7").write_bytes("MSH|^~\\&|A||||||ADT^A01|1|P|2.5||||||8859/1\rPID|Müller\r".encode("latin-1"))
    (tmp_path / "b.hl7").write_bytes("MSH|^~\\&|B||||||ADT^A01|1|P|2.5\rPID|Jürg\r".encode())
    got = {r["send_app"]: r["raw"] for r in hl7.with_header(messages.read_messages(spark, str(tmp_path))).collect()}
    assert "Müller" in got["A"] and "Jürg" in got["B"]


def test_json_rows_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([('[{"id":1,"name":"a"},{"id":2,"name":"b"}]',)], "body string")
    assert [tuple(r) for r in messages.json_array_rows(df, "body", "id:int,name:string").collect()] == [(1, "a"), (2, "b")]
    ev = spark.createDataFrame([("e1",), ("e1",), ("e2",)], "id string").select(F.struct(F.col("id").alias("eventId"), F.lit(None).cast("string").alias("x")).alias("event"))
    sinks.write_events(ev, str(tmp_path / "ev"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "ev")).collect()) == ['{"eventId":"e1","x":null}', '{"eventId":"e2","x":null}']


@pytest.fixture
def checkpoints(monkeypatch, tmp_path):
    monkeypatch.setattr(flows, "checkpoint_root", lambda spark: str(tmp_path / "cp"))


FRAGMENTS = "fragment_identifier string, fragment_index int, fragment_count int, received_at timestamp"


def test_defragment_complete_incomplete_late(spark, tmp_path, checkpoints):
    """Every arrival is a stream of its own that goes on from the checkpoint of the last."""
    source, target, progress = tmp_path / "in", str(tmp_path / "out"), []

    def arrive(*rows):
        data = [(g, i, n, dt.datetime(2024, 1, 1, h)) for g, i, n, h in rows]
        spark.createDataFrame(data, FRAGMENTS).coalesce(1).write.mode("append").parquet(str(source))
        query = flows.ingest(flows.defragment(spark.readStream.schema(FRAGMENTS).parquet(str(source)), 3_600_000, shard_size=50), target, "defrag")
        query.awaitTermination()
        progress.append(query.lastProgress.stateOperators[0].numRowsTotal)

    arrive(("a", 0, 2, 0), ("b", 0, 3, 0), ("half", 0, 200, 0), ("twice", 0, 2, 0), ("twice", 0, 2, 0))
    arrive(("a", 1, 2, 0), ("b", 1, 3, 0), ("b", 1, 3, 0), ("c", 0, 1, 12), *[("half", i * 4 + 1, 200, 0) for i in range(50)])
    arrive(("d", 0, 1, 13), ("b", 2, 3, 12), ("e", None, 2, 13), (None, 0, 2, 13), ("e", 2, 2, 13), ("e", 0, None, 13))
    arrive(*[("big", i, 200, 14) for i in range(200)], ("d", 0, 1, 14))
    shards = spark.read.parquet(target)
    got = {r["group"]: r for r in flows.group_states(shards, 3_600_000, 1704117600000).collect()}
    assert {g: got[g]["state"] for g in got} == {
        "a": "COMPLETE", "b": "ZIP_INCOMPLETE", "c": "COMPLETE", "d": "COMPLETE", "big": "COMPLETE", "half": "ZIP_INCOMPLETE", "twice": "ZIP_INCOMPLETE"}
    assert got["b"]["late_fragments"] == 1 and shards.filter("group = 'big'").count() == 4
    assert shards.filter("status = 'failure'").agg(F.sum("arrived")).first()[0] == 4
    arrive(("z", 0, 1, 20))
    arrive(("z", 0, 1, 23))
    assert progress[0] > progress[-1] and progress[-1] <= 2  # one mark at most; all older state is gone


EVENTS = "order_id string, retrieve_id string, id int, received_at timestamp"


def brute_batches(rows, size, wait):
    """Batches of each key in order of arrival; the last is closed by the end of the stream."""
    out, keys = [], {}
    for order, retrieve, number, time in sorted(rows, key=lambda r: (r[3], str(r[2]))):
        keys.setdefault((order or "", retrieve or ""), []).append((number, time))
    for key, events in keys.items():
        batches = []
        for number, time in events:
            if not batches or len(batches[-1]) == size or (time - batches[-1][0][1]).total_seconds() * 1000 > wait:
                batches.append([])
            batches[-1].append((number, time))
        out += [(*key, n, [i for i, _ in b]) for n, b in enumerate(batches)]
    return sorted(out)


@pytest.mark.parametrize("cuts", [[], [40], [7, 8, 55, 90]])
def test_same_batches_whatever_the_micro_batches(spark, tmp_path, checkpoints, cuts):
    rng = random.Random(3)
    start, at, rows = dt.datetime(2024, 1, 1), 0, []
    for i in range(120):
        at += rng.choice([0, 1, 1, 400])
        rows.append((rng.choice(["o1", "o1", "o1", "o2", None]), rng.choice(["r1", "r2"]), i, start + dt.timedelta(milliseconds=at)))
    rows.append(("end", "of stream", 0, start + dt.timedelta(days=1)))  # its time closes what is open
    for a, b in zip([0, *cuts], [*cuts, len(rows)]):
        spark.createDataFrame(rows[a:b], EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(EVENTS).parquet(str(tmp_path / "in"))
        event = F.struct(F.lpad(F.col("id").cast("string"), 4, "0").alias("eventId"), F.lit("x").alias("eventType"))
        flows.batch_events(stream.withColumn("event", event), "batches", str(tmp_path / "out"), 5, 1000).awaitTermination()
    got = [(r.order_id, r.retrieve_id, r.batch_no, [int(e["eventId"]) for e in json.loads(r.body)["events"]]) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(got) == [b for b in brute_batches(rows, 5, 1000) if b[0] != "end"]


def test_idempotent_stream(spark, tmp_path, checkpoints):
    rows = [("e1", dt.datetime(2024, 1, 1)), ("e1", dt.datetime(2024, 1, 1)), ("e2", dt.datetime(2024, 1, 1))]
    spark.createDataFrame(rows, "event_id string, ts timestamp").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("event_id string, ts timestamp").parquet(str(tmp_path / "in"))
    flows.ingest(flows.idempotent(stream, "ts"), str(tmp_path / "out"), "idem").awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_stream_queries_read_tables_of_many_files(spark, tmp_path):
    rows = [(c, t, "user", "x") for c in range(4) for t in range(3)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    out = {r.fragment_group: (r.fragment_count, r.state) for r in QUERIES["m3_defragmented_series"](spark, str(tmp_path)).collect()}
    assert out == {"0": (4, "OPEN"), "1": (3, "COMPLETE"), "2": (3, "COMPLETE"), "3": (4, "OPEN")}


def orders(spark, folder, n):
    row = ["id as o_orderkey", "id % 100 as o_custkey", "'F' as o_orderstatus", "cast(1 as double) as o_totalprice", "date'2020-01-02' as o_orderdate", "'1-URGENT' as o_orderpriority"]
    spark.range(n, numPartitions=1).selectExpr(*row).write.parquet(f"{folder}/orders.parquet")


def test_derived_tables_have_tasks_by_their_rows(spark, tmp_path):
    orders(spark, tmp_path, 4 * registry.ROWS_A_TASK + 1)
    for name in ("elements", "orm", "oru"):
        assert registry.table(spark, str(tmp_path), name).rdd.getNumPartitions() == 5


def test_many_parts_are_dealt_without_holding_what_a_task_reads(spark, tmp_path, monkeypatch):
    orders(spark, tmp_path, 6000)
    monkeypatch.setattr(registry, "ROWS_A_TASK", 20)
    for name in ("elements", "oru"):
        rows = registry.table(spark, str(tmp_path), name)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        parts = [int(n) for n in re.findall(r"Exchange hashpartitioning\(_place#\d+L, (\d+)\)", plan)]
        assert parts == [300, 200] and "RoundRobin" not in plan  # the task that reads writes 200 parts row by row, without a sort
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert rows.distinct().count() == 6000 == sum(sizes) and max(sizes) < 60


def test_clustered_tables_have_buckets_by_their_rows(spark, tmp_path, monkeypatch):
    orders(spark, tmp_path, 100)
    monkeypatch.setattr(queries_deid, "ROWS_A_TASK", 10)
    out = QUERIES["e17_anonymise_clustered"](spark, str(tmp_path))
    assert "out of 10" in out._jdf.queryExecution().executedPlan().toString() and out.count() == 100


def test_documents_are_compressed_on_request(spark, tmp_path):
    docs = spark.range(100).select(F.concat(F.lit("<a>"), F.col("id").cast("string"), F.lit("</a>")).alias("xml"))
    sinks.write_documents(docs, f"{tmp_path}/d", "xml", compression="gzip")
    assert all(p.name.endswith(".gz") for p in (tmp_path / "d").glob("part-*"))
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/d").collect()) == sorted(r.xml for r in docs.collect())


def test_many_small_files_are_read_in_few_tasks(spark, tmp_path, monkeypatch):
    for n in range(300):
        (tmp_path / f"{n}.dcm").write_bytes(part10(attribute("00080018", "UI", b"1.2")))
    monkeypatch.setattr(headerfiles, "TASKS_A_CORE", 1)
    df = headerfiles.read_headers(spark, str(tmp_path), ".dcm")
    assert df.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert df.filter("tag = '00080018'").select("path").distinct().count() == 300
