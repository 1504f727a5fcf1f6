"""A whole run over two small documents with stand-ins for rendering, recognition, detection and the model."""

import base64
import json

from pagemill import schema
from pagemill.plans.pipeline import Providers, Settings, contents, ingest, inspect, page_inputs
from pagemill.sources import records


def _providers(asked, broken=0):
    def note(what):
        with open(asked, "a") as f:
            f.write(what)

    class Renderer:
        def page_count(self, content):
            return 4

        def render(self, content, page_index, dpi):
            note("r")
            return 1000, 1000, bytes([page_index])

    def recogniser():
        def read(image, path):
            note("o")
            page = image[0]
            line = lambda y, t, size=9.0, x=10.0: {"spans": [{"text": t, "size": size, "bbox": [x, y, x + 100.0, y + 5.0]}]}
            if page == 1:
                lines = [line(0.0, "Part One.... 3", 14.0), line(10.0, "Races........ 4", 11.0), line(20.0, "outside")]
            else:
                lines = [line(0.0, "Part One" if page == 2 else "RACES"), line(10.0, f"text of {page}"), line(20.0, "cell"), line(30.0, "more- over")]
            return [{"type": 0, "lines": lines}]

        return read

    def detector():
        def look(image, path):
            note("d")
            box = lambda label, y0, y1: {"score": 0.9, "label": label, "coordinate": [0.0, y0 * 300 / 72, 2000.0, y1 * 300 / 72]}
            return [box("content", 0, 16)] if image[0] == 1 else [box("paragraph_title", 0, 5), box("table", 20, 25)]

        return look

    class Client:
        def ask(self, system, prompt, image, max_tokens):
            note("m")
            if broken and len(open(asked).read()) < broken:
                return "no JSON"
            said = {"title": prompt.split("Title: ")[1].split("\n")[0], "picture": base64.b64decode(image).decode()}
            return json.dumps({"columns": list(said), "rows": [said]})

    def cropper():
        def cut(image, x0, y0, x1, y1):
            note("c")
            return f"{image[0]}:{x0},{y0},{x1},{y1}".encode()

        return cut

    return Providers(Renderer, recogniser, detector, Client, cropper, wait=lambda s: None)


def test_ingest_twice(spark, tmp_path):
    asked = str(tmp_path / "asked")
    files = spark.createDataFrame([(1, bytearray(b"x")), (2, bytearray(b"y"))], "doc_id bigint, content binary")
    settings = Settings(columns=1, skipped_pages=(1, 2))
    home = tmp_path / "out"
    out = ingest(files, _providers(asked), str(home), settings)
    got = {(r.doc_id, r.section_id): (r.toc, r.text) for r in out["sections"].collect()}
    assert got == {(d, f"sec_00000{i}"): v for d in (1, 2) for i, v in enumerate([(["Part One"], "text of 2\n\nmoreover"), (["Part One", "Races"], "text of 3\n\nmoreover")])}
    found = {(r.doc_id, r.table_id): r.rows for r in out["tables"].collect()}
    # the model got the picture cut out of the page, and so stands in the file
    assert len(found) == 4 and found[1, "tbl_3_00001"] == [{"title": "Part One", "picture": "2:0,75,1000,112"}]
    at = home / settings.fingerprint()
    assert (at / "doc_1/crops/tbl_3_00001.png").read_bytes() == b"2:0,75,1000,112"
    assert sorted(p.name for p in (at / "doc_2/pages").iterdir() if p.suffix == ".png" and p.name[0] != ".") == [f"page_000{i}.png" for i in range(1, 5)]
    calls = open(asked).read()
    assert {c: calls.count(c) for c in "rodmc"} == {"r": 8, "o": 8, "d": 8, "m": 4, "c": 6}, "crops also of skipped pages"
    again = ingest(files, _providers(asked), str(home), settings)
    assert open(asked).read() == calls and again["tables"].count() == 4 and again["sections"].count() == 4, "nothing is done twice"
    more = files.unionByName(spark.createDataFrame([(3, bytearray(b"z"))], files.schema))
    assert ingest(more, _providers(asked), str(home), settings)["sections"].count() == 6
    assert len(open(asked).read()) == len(calls) * 3 // 2, "only the new document is worked on"
    assert Settings().fingerprint() != settings.fingerprint()


def test_failed_tables_are_asked_again_and_stand_once(spark, tmp_path):
    asked = str(tmp_path / "asked")
    files = spark.createDataFrame([(1, bytearray(b"x"))], "doc_id bigint, content binary")
    settings = Settings(columns=1, skipped_pages=(1, 2))
    for _ in range(2):
        out = ingest(files, _providers(asked, 10**6), str(tmp_path / "out"), settings)
        assert [r.status for r in out["tables"].collect()] == ["invalid"] * 2
    out = ingest(files, _providers(asked), str(tmp_path / "out"), settings)
    assert [r.status for r in out["tables"].collect()] == ["ok"] * 2


def test_contents_and_inspection(spark, tmp_path):
    files = spark.createDataFrame([(1, bytearray(b"x"))], "doc_id bigint, content binary")
    providers = _providers(str(tmp_path / "asked"))
    spans, layout = page_inputs(files, providers, Settings(columns=1))
    assert [(r.title, r.page_start, r.level) for r in contents(spans, layout, Settings(columns=1)).orderBy("toc_seq").collect()] == [("Part One", 3, 0), ("Races", 4, 1)]
    boxes = [{"score": s, "label": "text", "coordinate": [0.0, 0.0, 9.0, 9.0]} for s in (0.4, 0.6, 0.9)]
    raw = spark.createDataFrame([(1, 2, boxes)], schema.RAW_LAYOUT)
    order, regions = inspect(spans, raw, 1, 3, 1)
    assert [r.label for r in order.orderBy("region_idx").collect()] == ["0", "1", "2", "3"] and regions.count() == 2
    assert inspect(spans, raw, 1, 3, 1, 0.8)[1].count() == 1


def test_images(spark, tmp_path):
    boxes = spark.createDataFrame([(1, 0, "crops/a.png", 0, 1, 2, 3)], "doc_id bigint, page_index int, image_path string, crop_x0 int, crop_y0 int, crop_x1 int, crop_y1 int")
    pages = spark.createDataFrame([(1, 0, bytearray(b"page"))], "doc_id bigint, page_index int, image binary")
    cut = records.crop_images(boxes, pages, lambda: lambda image, a, b, c, d: bytes(image) + bytes([a, b, c, d]))
    for root in (str(tmp_path / "plain"), f"file://{tmp_path}/uri"):
        records.write_images(cut, root)
    assert (tmp_path / "plain/crops/a.png").read_bytes() == (tmp_path / "uri/crops/a.png").read_bytes() == b"page\x00\x01\x02\x03"
    assert records.exists(spark, str(tmp_path)) and not records.exists(spark, str(tmp_path / "no"))
