import json
import time

import pytest
from pyspark.sql import functions as F

from riskscan.operators import chat as ch
from riskscan.operators import findings as fd
from riskscan.sources import json_arrays as ja
from riskscan.sources import readers as rd
from riskscan.sources import writers as wr


def test_csv_encodings_and_layouts(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.csv").write_text('Title,Score,Note\n"Größe\nzwei",5,NA\nplain,6,"say ""hi"""\n', encoding="utf-8")
    (tmp_path / "deep" / "b.CSV").write_bytes("Title,Other\nfür,x\n".encode("latin-1"))
    (tmp_path / "c.txt").write_text("no")
    assert rd.discover_files(spark, str(tmp_path)).count() == 2
    rows = {r["Title"]: r for r in rd.read_csv_findings(spark, str(tmp_path)).collect()}
    assert set(rows) == {"Größe\nzwei", "plain", "für"}
    assert rows["Größe\nzwei"]["Score"] == 5 and rows["Größe\nzwei"]["Note"] is None
    assert rows["plain"]["Note"] == 'say "hi"' and rows["für"]["Other"] == "x"


def test_texts_from_every_kind(spark, tmp_path):
    entries = [{"text": "a"}, {"text": None, "description": "d"}, {"description": "b", "content": "x"}, {"content": ""}, 5, {"content": "c"}]
    (tmp_path / "t.jsonl").write_text("\n".join([*map(json.dumps, entries), "{broken", "", '{"text": "a"}']))
    (tmp_path / "t.json").write_text(json.dumps(entries))
    (tmp_path / "one.json").write_text(json.dumps({"text": "a"}))
    (tmp_path / "t.txt").write_text("  a \n\nb\nc\na\n")
    (tmp_path / "t.csv").write_text("id,Finding Title\n1,a\n2,b\n3,c\n4,\n")
    for name, expected in (("t.jsonl", "abc"), ("t.json", "abc"), ("one.json", "a"), ("t.txt", "abc"), ("t.csv", "abc")):
        assert sorted(r["text"] for r in rd.read_texts(spark, str(tmp_path / name)).collect()) == list(expected), name


def test_examples_round_trip_and_rejects(spark, tmp_path):
    raw = spark.createDataFrame([("Open port", "7")], "Title string, L2 string")
    path = wr.write_examples_jsonl(fd.raw_to_examples(raw), str(tmp_path / "out"), raw)
    assert rd.load_examples(spark, path).first()["l2_category"] == "7"
    (tmp_path / "x.jsonl").write_text('{"type": "risk"}\n{bad\n\n')
    good, bad = rd.read_examples_jsonl(spark, str(tmp_path / "x.jsonl"))
    assert good.count() == 1 and [r["value"] for r in bad.collect()] == ["{bad"]


def test_nothing_to_write_keeps_the_raw_rows(spark, tmp_path):
    raw = spark.createDataFrame([("##",)], "Title string")
    with pytest.raises(ValueError):
        wr.write_examples_jsonl(fd.raw_to_examples(raw), str(tmp_path), raw)
    assert spark.read.json(str(tmp_path / "raw_backup")).count() == 1


def test_a_raw_csv_file_is_extracted(spark, tmp_path):
    (tmp_path / "f.csv").write_text("Title,Category\nOpen port here,Network\n")
    assert rd.load_examples(spark, str(tmp_path / "f.csv")).first()["l2_category"] == "Network"
    with pytest.raises(ValueError):
        (tmp_path / "e.jsonl").write_text("\n")
        rd.load_examples(spark, str(tmp_path / "e.jsonl"))


def write_csv(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(folder)


def test_whole_numbers_stay_whole_and_reach_their_label(spark, tmp_path):
    folder = write_csv(tmp_path, a="Title,L2,Score\nOpen port here,7,1.5\nWeak disk keys,5,2\n")
    read = rd.read_csv_findings(spark, folder)
    assert {"L2": "long", "Score": "double"}.items() <= {f.name: f.dataType.typeName() for f in read.schema}.items()
    labels = {r["raw_l2"]: r["l2_category"] for r in fd.label_findings(fd.map_columns(read.drop("source_file"))).collect()}
    assert set(map(str, labels)) == {"7", "5"} and all(v.startswith(f"{k}. ") for k, v in labels.items())
    assert {r["l2_category"] for r in rd.load_examples(spark, folder).collect()} == {"7", "5"}


def test_kinds_are_decided_file_by_file(spark, tmp_path):
    folder = write_csv(
        tmp_path, a="Title,Ref,Flag,L2\nOpen port here,12.55,True,7\nWeak disk keys,3,False,5\n",
        b="Title,Ref,L2\nOld certificate,ticket 77,\nNo backups made,ticket 78,4\n",
    )
    read = rd.read_csv_findings(spark, folder)
    assert read.schema["Flag"].dataType.typeName() == "boolean"
    rows = {r["Title"]: r for r in read.collect()}
    assert (rows["Open port here"]["Ref"], rows["Open port here"]["L2"]) == ("12.55", "7")
    assert (rows["No backups made"]["Ref"], rows["No backups made"]["L2"]) == ("ticket 78", "4.0")
    assert {r["source_file"].rsplit("/", 1)[1] for r in rows.values()} == {"a.csv", "b.csv"}
    texts = {r["text"] for r in fd.raw_to_examples(read, keep=["source_file"]).collect()}
    assert "Finding: Open port here" in texts
    assert any("Ref: ticket 77" in t for t in texts) and not any("12.55" in t or "Flag" in t for t in texts)


def test_case_of_names_and_rejected_records(spark, tmp_path):
    folder = write_csv(
        tmp_path, a="Title,TITLE\nOpen port here,other\n", b="title\nlower case title\n",
        c="Title,L2\nWeak disk keys,x,EXTRA CELL\nGood row here,y\n",
    )
    read = rd.read_csv_findings(spark, folder)
    assert sorted(c for c in read.columns if c.lower().startswith("title")) == ["TITLE (2)", "Title", "title (3)"]
    assert read.count() == 3
    rejects = rd.csv_rejects(spark, folder).collect()
    assert [(r["cells"], r["record"]) for r in rejects] == [(["Weak disk keys", "x", "EXTRA CELL"], "Weak disk keys,x,EXTRA CELL")]


def test_headers_of_every_kind(spark, tmp_path):
    """Quoted commas, quotes and line breaks in names, empty and repeated names, a byte order mark, headers alone."""
    folder = write_csv(
        tmp_path, a='\ufeff"Title, long","Line\nbreak","say ""x""",,Note,Note,\nA,B,C,D,E,F,G\n', b="single\nvalue\n\"x,y\"\n",
        c="only,a,header\n", d="",
    )
    read = rd.read_csv_findings(spark, folder, infer_numbers=False)
    assert sorted(set(read.columns) - {"source_file"}) == sorted(
        ["Title, long", "Line\nbreak", 'say "x"', "Unnamed: 3", "Note", "Note.1", "Unnamed: 6", "single"]
    )
    rows = [r.asDict() for r in read.drop("source_file").collect()]
    filled = sorted((sorted((k, v) for k, v in r.items() if v is not None) for r in rows), key=str)
    assert filled == sorted([
        sorted({"Title, long": "A", "Line\nbreak": "B", 'say "x"': "C", "Unnamed: 3": "D", "Note": "E", "Note.1": "F", "Unnamed: 6": "G"}.items()),
        [("single", "value")], [("single", "x,y")],
    ], key=str)


def test_a_long_cell_does_not_widen_the_table(spark, tmp_path):
    log = ",".join(["entry"] * 25_000)
    folder = write_csv(tmp_path, a=f'Title,Note\nOpen port here,"{log}"\nplain,x\n', b=f"Title,Other\nlog line,{log}\nfine,y\n")
    rd.read_csv_findings(spark, write_csv(tmp_path)).collect()  # the session is warm
    began = time.monotonic()
    read = rd.read_csv_findings(spark, folder)
    rows = {r["Title"]: r for r in read.collect()}
    assert time.monotonic() - began < 20  # alone under 5 s; the machine may be busy
    assert sorted(read.columns) == ["Note", "Other", "Title", "source_file"]
    assert set(rows) == {"Open port here", "plain", "fine"} and rows["Open port here"]["Note"] == log
    rejects = rd.csv_rejects(spark, folder).collect()
    assert [(r["cells"], r["record"]) for r in rejects] == [(["log line", "entry", "entry"], f"log line,{log}")]


def test_csv_files_are_scanned_three_times(spark, tmp_path, monkeypatch):
    folder = write_csv(tmp_path, **{f"f{i}": f"Title,c{i % 3}\nOpen port {i},{'x' if i % 2 else i}\n" for i in range(9)})
    scans, plans = [], []
    scan = rd._csv
    monkeypatch.setattr(rd, "_csv", lambda *a, **k: scans.append(a) or scan(*a, **k))
    write = type(spark.range(0).write).parquet
    monkeypatch.setattr(type(spark.range(0).write), "parquet", lambda w, *a, **k: plans.append(plan_of(w._df)) or write(w, *a, **k))
    read = rd.read_csv_findings(spark, folder)
    assert len(scans) == 2 and [p.count("FileScan csv") for p in [*plans, plan_of(read)]] == [1, 1, 1]
    assert "_not_text" in read.columns and read.count() == 9


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_split_files_and_a_table_of_files_beyond_broadcast(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(rd, "BROADCAST_BYTES", limit)
    for name, head in (("a", "Title,Ref"), ("b", "Ref,Title"), ("c", "Title,Extra")):
        lines = [f"{i},t{i}" if head.startswith("Ref") else f"t{i},{i}" for i in range(4000)]
        (tmp_path / f"{name}.csv").write_text("\n".join([head, *lines, ""]))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "5k")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        read = rd.read_csv_findings(spark, str(tmp_path), multi_line=False)
        assert ("BroadcastHashJoin" in plan_of(read)) == (limit > 0)
        assert read.rdd.getNumPartitions() > 8 or limit == 0
        assert read.count() == 12_000 and read.where("Title <> 't' || coalesce(Ref, Extra)").count() == 0
        assert read.where("Title = 'Title' or Title is null").isEmpty()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_an_extraction_reads_its_input_once(spark, tmp_path):
    folder = write_csv(tmp_path, a="Title,L2\nOpen port here,7\n##,5\n", b="Title,Risks\nWeak disk keys,Authentication\n")
    raw = rd.read_csv_findings(spark, folder)
    reads = spark.sparkContext.accumulator(0)
    counted = raw.rdd.map(lambda r: (reads.add(1), tuple(r))[1]).toDF(raw.schema)
    examples_of = lambda df: fd.raw_to_examples(df, keep=["source_file"]).drop("source_file")
    path, summary = wr.write_extraction(counted, examples_of, str(tmp_path / "out"))
    assert reads.value == 3
    row = spark.read.json(summary).first().asDict()
    examples = rd.load_examples(spark, path)
    expected = wr.extraction_summary(examples).first().asDict()
    assert row == {"total_files_processed": 2, "total_raw_entries": 3, **expected} and expected["total_training_examples"] >= 2
    with pytest.raises(ValueError):
        wr.write_extraction(raw.where("Title = '##'").drop("L2"), examples_of, str(tmp_path / "none"))
    assert spark.read.json(str(tmp_path / "none" / "raw_backup")).count() == 1


def test_the_last_of_repeated_names_counts(spark, tmp_path):
    lines = [
        '{"text": "a", "text": "b"}', '{"text": "c", "description": "d", "text": null, "description": "e"}', '{"content": 1, "content": "ü\\n"}',
        "{'text': 'x', 'text': 'y'}", '{"text": "x", "text": "y"', '{"text": "z"}', '{"description": "p", "text": "", "text": "q", "x": {"k": [1]}}',
    ]
    expected = []
    for line in lines:
        try:
            entry = json.loads(line)
        except json.JSONDecodeError:
            continue
        value = next((entry[k] for k in ("text", "description", "content") if k in entry), None)
        expected += [value] if value else []
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    assert sorted(r["text"] for r in rd.texts_from_jsonl(df).collect()) == sorted(expected)
    good, bad = rd.parse_examples(spark.createDataFrame([('{"type": "risk", "text": "a", "text": "b"}',), ("{'type': 1}",)], "value string"))
    assert [r["text"] for r in good.collect()] == ["b"] and bad.count() == 1


JSON_FILES = [
    '[{"text": "a"}, 5, "x}{[", {"content": "b } \\"c\\" \\\\"}, [{"text": "inner"}], {"text": {"k": [{}]}}, null, {"description": "d"}]',
    '{"text": "one } object {", "more": [{"a": {}}]}', '  [ ]  ', "[1, 2]", "[]", '[{"text": "t"}]\n', '\n{"text": "u"}\n\n',
    '[{"text": "v"}, 7]', '[{"text": "w"}\n,\n{"text": "é"}\n]', '[{"text": "rep", "text": "last"}]', '{"text": "p", "text": "q"}',
    '[[{"text": "deep"}]]', "{}", "[{}]", "5",
    # not valid as a whole
    '[{"text": "bad1"}', '[{"text": "bad2"}, ]', '[{"text": "bad3"} {"text": "bad3"}]', '{"text": "bad4"', '{"text": "bad5"} {"text": "bad5"}',
    '[{"text": "bad6"}]]', '[{"text": "bad7}]', '[{"text": bad8}, {"text": "bad8"}]', '{"text": "bad9"}]', "", '[{"text": "bad10"}, 5',
    '[{"text": "bad11"}] x', '[{"text": "bad12"} 5]', ',{"text": "bad13"}',
]


@pytest.mark.parametrize("split", ["9b", "1m"])
def test_json_files_are_cut_into_their_entries(spark, tmp_path, split):
    """Any place where a file may be split, against a parser that takes it whole."""
    expected = []
    for i, content in enumerate(JSON_FILES):
        (tmp_path / f"f{i}.json").write_text(content, encoding="utf-8")
        try:
            found = json.loads(content)
        except json.JSONDecodeError:
            continue
        expected += [e for e in (found if isinstance(found, list) else [found]) if isinstance(e, dict)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        entries = ja.entries_of_json_files(spark, str(tmp_path))
        got = [json.loads(r[0]) for r in entries.select(F.to_json("_e")).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    order = lambda entries: sorted(json.dumps(e, sort_keys=True) for e in entries)
    assert order(e for e in got if isinstance(e, dict)) == order(expected)


def test_a_large_json_file_is_read_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rd, "WHOLE_JSON_BYTES", 10_000)
    entries = [{"text": f"entry {i} " + "} {[" * (i % 7), "tags": [{"n": i}]} if i % 9 else i for i in range(5000)]
    (tmp_path / "large.json").write_text(json.dumps(entries))  # a single line
    (tmp_path / "small.json").write_text(json.dumps([{"content": "small"}]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
        assert ja._chunks(spark, str(tmp_path), 10_000).select("block").distinct().count() > 8
        got = sorted(r["text"] for r in rd.read_texts(spark, str(tmp_path / "large.json")).collect())
        assert got == sorted(e["text"] for e in entries if isinstance(e, dict))
        assert [r["text"] for r in rd.read_texts(spark, str(tmp_path / "small.json")).collect()] == ["small"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_chat_files_are_smaller_than_the_prompts_they_repeat(spark, tmp_path):
    raw = spark.range(400).selectExpr("concat('finding number ', id) AS Title", "'5. Protect Data' AS L2", "'Removable Media' AS Risks")
    chats = ch.chat_rows(ch.format_chat(ch.split_examples(fd.raw_to_examples(raw).withColumn("id", F.xxhash64("text")), "id")))
    folder = wr.write_chat_split(chats.coalesce(1), str(tmp_path / "chats"))
    on_disk = sum(p.stat().st_size for p in (tmp_path / "chats").rglob("part-*"))
    assert on_disk * 10 < chats.agg(F.sum(F.octet_length(F.to_json("messages")))).first()[0]
    written = spark.read.schema("split string, messages array<struct<role:string,content:string>>").json(folder)
    kept = lambda df: sorted((r["split"], [tuple(m) for m in r["messages"]]) for r in df.select("split", "messages").collect())
    assert kept(written) == kept(chats) and len(kept(written)) == 400


def test_only_cells_that_may_be_numbers_are_cast(spark):
    """A failed cast costs an exception: texts must not come to it, and everything that a cast takes must."""
    numbers = ["7", "-7", "+7.5", ".5", "5.", "1e5", "1E-5", "1.5d", "2F", "0x1p3", "0X1.8P-2", "NaN", "nan", "Infinity", "-inf", "+INF",
               "infinity", "\t5", "5\n", "1_0", "--5", "1e", "inf5", "nano", "0x", ".", "+", "-nan", "٥", "1,5"]
    words = ["5. Protect Data", "Network Segmentation", "identity", "no such label", "ticket 12", "True", "Infinite loop", "2024-01-01 report"]
    cells = spark.createDataFrame([(c,) for c in numbers + words], "c string")
    found = cells.select("c", F.col("c").try_cast("double").isNotNull().alias("number"), F.col("c").rlike(rd.MAYBE_NUMBER).alias("may")).collect()
    assert [r["c"] for r in found if r["number"] and not r["may"]] == []
    assert sum(r["number"] for r in found) >= 17
    assert [r["c"] for r in found if r["may"] and r["c"] in words] == []
