from __future__ import annotations

import json
import sys
import zipfile
from xml.etree import ElementTree

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.__main__ import main
from pairloom.plans import settings
from pairloom.plans.engine import CorpusEngine
from pairloom.sources import providers, readers, sinks
from pairloom.streaming import ingest


def reader():
    return lambda content: content.decode()


def broken():
    def fail(content):
        raise RuntimeError("no model")

    return fail


@pytest.fixture
def corpus(tmp_path):
    for work, pages in {"a": {"p1.png": "銀。兩", "p2.JPG": "三！", "note.txt": "no"}, "b": {"p1.jpeg": "x"}, "c": {"p10.png": "十", "p2.png": "二"}}.items():
        (tmp_path / "source" / work).mkdir(parents=True)
        for name, text in pages.items():
            (tmp_path / "source" / work / name).write_text(text)
    (tmp_path / "target").mkdir()
    for name in ("a.pdf", "b.PDF", "c.pdf", "z.pdf", "d.txt"):
        (tmp_path / "target" / name).write_bytes(b"%PDF")
    return tmp_path


def test_sources(spark, corpus):
    pages = readers.page_images(spark, f"file://{corpus}/source").select("work_id", "page_no", "file_name").collect()
    assert sorted(map(tuple, pages)) == [("a", 0, "p1.png"), ("a", 1, "p2.JPG"), ("b", 0, "p1.jpeg"), ("c", 0, "p10.png"), ("c", 1, "p2.png")]
    assert sorted(r.work_id for r in readers.works(spark, f"file://{corpus}/source").collect()) == ["a", "b", "c"]
    assert sorted(r.work_id for r in readers.translations(spark, f"file://{corpus}/target").collect()) == ["a", "b", "c", "z"]
    assert sorted(r.work_id for r in readers.translations(spark, f"file://{corpus}/target", exact=True).collect()) == ["a", "c", "z"]
    (corpus / "a_raw.txt").write_bytes("x\r\ny\rz".encode())
    assert [tuple(r) for r in readers.raw_texts(spark, f"file://{corpus}/*_raw.txt", "_raw.txt").collect()] == [("a", "x\ny\nz")]


def test_engine_steps_and_restart(spark, corpus):
    out = f"file://{corpus}/out"
    engine = CorpusEngine(spark, out, [("broken", broken), ("text", reader)])
    pairs = engine.run(f"file://{corpus}/source", f"file://{corpus}/target").orderBy("work_id", "pair_no").collect()
    assert [(r.work_id, r.pair_id, r.source_sentence, r.target_sentence) for r in pairs] == [
        ("a", "pair_0001", "銀。", "Mock content extracted from a"), ("a", "pair_0002", "兩", "pdf"), ("a", "pair_0003", "三！", ""),
        ("c", "pair_0001", "十", "Mock content extracted from c"), ("c", "pair_0002", "二", "pdf"),
    ]
    again = CorpusEngine(spark, out, aligner="dynamic").run(steps=("align",))
    assert again.filter("error is not null").count() == 0 and again.count() >= 5
    with pytest.raises(ValueError):
        CorpusEngine(spark, out, aligner="none").run(steps=("align",))


def test_global_mode(spark, corpus):
    engine = CorpusEngine(spark, f"file://{corpus}/all", [("text", reader)], first_pages=1)
    pairs = engine.run(f"file://{corpus}/source", f"file://{corpus}/target", global_work=True).orderBy("pair_no").collect()
    assert [r.source_sentence for r in pairs if r.source_sentence] == ["銀。", "兩", "x", "十"]
    assert {r.work_id for r in pairs} == {"global"}


def test_settings_and_command_line(spark, corpus):
    (corpus / ".env").write_text("# folders\nHAN_DIR=/x\nexport VIET_DIR = '/y z' # there\nKANDIAN_TOKEN=\"t#1\"\nnonsense\n")
    own = settings.load({"HAN_DIR": "/w", "OTHER": "1"}, str(corpus / ".env"))
    assert (own.source_dir, own.target_dir, own.output_dir) == ("/w", "/y z", "output")
    assert own.keys["KANDIAN_TOKEN"] == "t#1" and own.keys["GEMINI_API_KEY"] == "" and "t#1" not in repr(own)
    assert settings.load({}, str(corpus / "none")).source_dir == "dataset/china"
    folders = ["--han_dir", f"file://{corpus}/source", "--viet_dir", f"file://{corpus}/target", "--output_dir", f"file://{corpus}/cli"]
    assert main([*folders, "--recogniser", f"text={__name__}:reader", "--first-n-images", "1"], spark) == 0
    assert main([*folders, "--step_align", "--aligner", "dynamic"], spark) == 0
    assert spark.read.parquet(f"file://{corpus}/cli/pairs").filter("source_sentence = '銀。'").count() == 1


def test_tsv(spark, tmp_path):
    pairs = spark.createDataFrame([(1, "pair_0001", 'a"b', ""), (2, "pair_0002", "tab\there", "x")], "pair_no int, pair_id string, source_sentence string, target_sentence string")
    sinks.pairs_tsv(pairs.coalesce(1), f"file://{tmp_path}/t")
    text = "".join(sorted(p.read_text() for p in (tmp_path / "t").glob("part-*")))
    lines = [x for x in text.split("\n") if x and not x.startswith("pair_id")]
    assert "pair_id\than_sentence\tviet_sentence" in text
    assert lines == ['pair_0001\t"a""b"\t', 'pair_0002\t"tab\there"\tx']


def test_persisted_sentences_split_at_carriage_returns(spark):
    s = spark.createDataFrame([("w", 0, "a\rb"), ("w", 1, " c ")], "work_id string, pos int, sentence string")
    got = readers.persisted(s, ["work_id"]).orderBy("pos").collect()
    assert [(r.pos, r.sentence) for r in got] == [(0, "a"), (1, "b"), (2, "c")]


def test_providers(spark):
    pages = spark.createDataFrame([("w", 0, b"ok"), ("w", 1, b"bad")], "work_id string, page_no int, content binary")

    def boxes():
        def model(content):
            if content == b"bad":
                raise ValueError("unreadable")
            return [([(0, 0), (2, 0), (2, 2), (0, 2)], "t", 0.5)]

        return model

    got = providers.detect(pages, boxes).orderBy("page_no").collect()
    assert got[0].text == "t" and got[0].error is None and got[1].box_no == -1 and "unreadable" in got[1].error
    image = np.zeros((10, 20, 3), np.uint8)
    assert providers.prepared(image).shape == (120, 110, 3)
    texts = spark.createDataFrame([("x",), (" ",), (None,), ("fail",)], "t string")

    def upper():
        def model(t):
            if t == "fail":
                raise ValueError
            return f" {t.upper()} "

        return model

    assert [r.x for r in texts.select(providers.corrected(F.col("t"), upper).alias("x")).collect()] == ["X", " ", None, "fail"]
    s = spark.createDataFrame([("w", 0, "a"), ("w", 1, "b")], "work_id string, pos int, sentence string")
    got = providers.translated(s, "work_id", lambda: lambda x: [" A "]).orderBy("pos").collect()
    assert [r.sentence_tr for r in got] == ["A", ""]
    assert [r.sentence_tr for r in providers.translated(s, "work_id").orderBy("pos").collect()] == ["a", "b"]


def test_stream(spark, tmp_path):
    rows = spark.createDataFrame([("w", "a. b\rc")], "work_id string, text string")
    rows.write.parquet(f"file://{tmp_path}/in")
    stream = ingest.sentence_stream(spark, f"file://{tmp_path}/in")
    query = ingest.write_stream(stream, f"file://{tmp_path}/out", f"file://{tmp_path}/mark")
    assert query.awaitTermination(60)
    got = spark.read.parquet(f"file://{tmp_path}/out").orderBy("pos").collect()
    assert [r.sentence for r in got] == ["a.", "b", "c"]


def page_boxes():
    def model(content):
        if content == b"x":
            raise ValueError("unreadable")
        return [([(0, 10 * k), (2, 10 * k), (2, 10 * k + 2), (0, 10 * k + 2)], t, 0.9) for k, t in enumerate(content.decode().split("。"))] + [([(0, 0)] * 4, "暗", 0.39)]

    return model


def vision_answer():
    return lambda content: json.dumps({"responses": [{"fullTextAnnotation": {"text": content.decode() + "兩"}}]} if content != "三！".encode() else {"error": {"message": "quota"}})


def vertical_answer():
    return lambda content: json.dumps({"code": 0, "msg": "success", "data": [content.decode(), {"text": "。"}]})


def test_boxes_and_services_to_pairs(spark, corpus, caplog):
    """From boxes and answers of services to pairs: what each kind of recogniser reads is voted on."""
    folders = f"file://{corpus}/source", f"file://{corpus}/target"
    out = f"file://{corpus}/kinds"
    engine = CorpusEngine(spark, out, [("boxes", page_boxes, "boxes"), ("vision", vision_answer, "vision"), ("vertical", vertical_answer, "vertical")], exports=("tsv", "text", "xlsx"))
    with caplog.at_level("WARNING"):
        engine.run(*folders)
    assert "1 works have no translation" in caplog.text and [r.work_id for r in spark.read.parquet(f"{out}/unmatched").collect()] == ["b"]
    texts = {r.work_id: r.text for r in spark.read.parquet(f"{out}/source_raw").collect()}
    assert texts == {"a": "銀。兩兩\n三！", "c": "十兩\n二兩"}
    boxes = CorpusEngine(spark, None, [("boxes", page_boxes, "boxes")])
    pairs = boxes.run(*folders).filter("source_sentence <> ''").orderBy("work_id", "pair_no").collect()
    assert [(r.work_id, r.source_sentence) for r in pairs] == [("a", "銀"), ("a", "兩"), ("a", "三！"), ("c", "十"), ("c", "二")]
    with pytest.raises(ValueError):
        CorpusEngine(spark, None, [("x", reader, "none")]).run(*folders)
    assert {r.work_id for r in readers.raw_folders(spark, f"{out}/text/source_raw").collect()} == {"a", "c"}
    assert readers.raw_folders(spark, f"{out}/text/source_sentences").filter("work_id = 'c'").first().text == "十兩\n二兩\n"
    assert sorted(r.work_id for r in spark.read.parquet(f"{out}/pairs_xlsx").filter("error is null").collect()) == ["a", "c"]


def test_absent_folders_and_stages(spark, corpus, caplog):
    folders = f"file://{corpus}/source", f"file://{corpus}/target"
    engine = CorpusEngine(spark, f"file://{corpus}/absent", [("text", reader)])
    with caplog.at_level("WARNING"):
        assert engine.run(f"file://{corpus}/nowhere", folders[1]) is None and engine.run(folders[0], f"file://{corpus}/nowhere") is None
        assert engine.run(steps=("align",)) is None
    assert caplog.text.count("does not exist") == 2 and "segment step first" in caplog.text
    engine.run(*folders, steps=("segment", "align"))  # no raw texts: the source side is empty, with a warning
    assert "no raw texts" in caplog.text
    pairs = engine.stored("pairs").collect()
    assert {r.work_id for r in pairs} == {"a", "c"} and not any(r.source_sentence for r in pairs)
    pairs = CorpusEngine(spark, f"file://{corpus}/absent", aligner=lambda a, b: b.select("work_id", F.lit(1).alias("pair_no"), F.lit("x").alias("pair_id"), F.lit("").alias("source_sentence"), F.col("sentence").alias("target_sentence")))
    assert pairs.run(steps=("align",)).filter("pair_id = 'x'").count() > 0


def test_first_pages_are_taken_by_name(spark, corpus):
    files = readers.image_files(spark, f"file://{corpus}/source")
    got = lambda n: sorted((r.work_id, r.file_name) for r in CorpusEngine(spark, first_pages=n).first_images(files).collect())
    assert got(1) == [("a", "p1.png"), ("b", "p1.jpeg"), ("c", "p10.png")] and got(0) == [] and len(got(None)) == len(got(9)) == 5
    with pytest.raises(ValueError):
        got(-1)
    plan = CorpusEngine(spark, first_pages=1).first_images(files)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<path:string>") <= 2 and "BroadcastHashJoin" in plan


def test_spreadsheet(spark, tmp_path):
    pairs = spark.createDataFrame([(1, "pair_0001", "a<b & \x01c", ""), (2, "pair_0002", " é ", None)], "pair_no int, pair_id string, source_sentence string, target_sentence string")
    sinks.pairs_xlsx(pairs, str(tmp_path / "x.xlsx"))
    with zipfile.ZipFile(tmp_path / "x.xlsx") as z:
        assert not z.testzip() and {"[Content_Types].xml", "_rels/.rels", "xl/workbook.xml", "xl/_rels/workbook.xml.rels"} < set(z.namelist())
        rows = [["".join(c.itertext()) for c in r] for r in ElementTree.fromstring(z.read("xl/worksheets/sheet1.xml"))[0]]
    assert rows == [["pair_id", "han_sentence", "viet_sentence"], ["pair_0001", "a<b & c", ""], ["pair_0002", " é ", ""]]
    with pytest.raises(ValueError):
        sinks.workbook(("x",) for _ in range(sinks.SHEET_ROWS + 1))


def test_framed_detector():
    seen = []

    def built():
        return lambda image: seen.append(image.shape) or []

    assert providers.framed(lambda b: np.zeros((10, 20, 3), np.uint8), built)()(b"x") == [] and seen == [(120, 110, 3)]


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    """Many works' folders do not become a task each."""
    for k in range(100):
        (tmp_path / f"work_id=w{k:03d}").mkdir()
        (tmp_path / f"work_id=w{k:03d}" / "t.txt").write_text(f"text {k}")
    spark.sparkContext.setJobGroup("listing", "")
    before = spark.conf.get(readers.LISTS_SETTING)
    texts = readers.raw_folders(spark, str(tmp_path))
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(x) for job in tracker.getJobIdsForGroup("listing") for x in tracker.getJobInfo(job).stageIds]
    spark.sparkContext.setJobGroup("rest", "")
    assert stages and max(x.numTasks for x in stages) <= readers.LISTS
    assert spark.conf.get(readers.LISTS_SETTING) == before
    assert {(r.work_id, r.text) for r in texts.collect()} == {(f"w{k:03d}", f"text {k}") for k in range(100)}


def rows_at_once() -> str:
    """How many rows the caller's batch has."""
    frame = sys._getframe()
    while not {"b", "texts"} & set(frame.f_locals):
        frame = frame.f_back
    return str(len(frame.f_locals.get("b", frame.f_locals.get("texts"))))


def counter():
    return lambda content: rows_at_once()


def box_counter():
    return lambda content: [([(0, 0)], rows_at_once(), 1.0)]


def sentence_counter():
    return lambda text: [rows_at_once()]


@pytest.mark.parametrize("step", ["recognise", "detect", "corrected", "segmented"])
def test_batches_are_bounded_by_bytes(spark, step):
    """A worker gets long rows a few at a time, not by thousands."""
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    content = F.lit("x" * 1_000_000)
    pages = spark.range(0, 24, 1, 1).select(F.lit("w").alias("work_id"), F.col("id").cast("int").alias("page_no"), content.alias("t"), content.cast("binary").alias("content"))
    if step == "recognise":
        told = providers.recognise(pages, [("one", counter), ("two", counter)]).select("text")
    elif step == "detect":
        told = providers.detect(pages, box_counter).select("text")
    elif step == "corrected":
        told = pages.select(providers.corrected(F.col("t"), counter).alias("text"))
    else:
        told = pages.select(F.explode(providers.segmented(sentence_counter)(F.col("t"))).alias("text"))
    counts = [int(r.text) for r in told.collect()]
    assert len(counts) == (48 if step == "recognise" else 24) and max(counts) <= 6
