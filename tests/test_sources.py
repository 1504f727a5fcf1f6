import pytest

from pagemill import schema
from pagemill.operators.overlay import layout_overlay, order_overlay
from pagemill.sources import pages, records
from pagemill.streaming import pages as stream


def test_rendering_skips_pages_that_are_done(spark):
    class Renderer:
        def page_count(self, content):
            return len(content)

        def render(self, content, page_index, dpi):
            return 100 + page_index, 200, bytes([content[page_index]])

    files = spark.createDataFrame([(1, bytearray(b"abc")), (2, bytearray(b""))], "doc_id bigint, content binary")
    done = spark.createDataFrame([(1, 1)], "doc_id bigint, page_index int")
    got = {r.page_index: (r.width, r.image_path, None if r.image is None else bytes(r.image)) for r in pages.render_pages(files, Renderer, done).collect()}
    assert got == {0: (100, "pages/page_0001.png", b"a"), 1: (None, "pages/page_0002.png", None), 2: (102, "pages/page_0003.png", b"c")}


def test_recognition_and_detection(spark):
    made = spark.createDataFrame([(1, 0, "p1"), (1, 1, "p2")], "doc_id bigint, page_index int, image_path string")
    span = lambda t: {"text": t, "size": 9.0, "bbox": [1.0, 2.0, 3.0, 4.0]}
    blocks = [{"type": 1, "lines": [{"spans": [span("no")]}]}, {"type": 0, "lines": [{"spans": [span(" a "), span(" ")]}, {"spans": [span("b")]}]}]
    got = pages.recognise(made, lambda: lambda image, path: blocks).orderBy("page_index", "region_idx").collect()
    assert [(r.page_index, r.region_idx, r.text, r.x0, r.y1) for r in got] == [(0, 0, "a", 4, 16), (0, 1, "b", 4, 16), (1, 0, "a", 4, 16), (1, 1, "b", 4, 16)]
    boxes = [{"score": s, "label": x, "coordinate": [1.9, -1.9, 3.0, 4.0]} for x, s in (("text", 0.79), ("text", 0.8), ("footer", 0.1))]
    got = pages.detect(made, lambda: lambda image, path: boxes if path == "p1" else None, 0.8).orderBy("layout_idx").collect()
    assert [(r.layout_idx, r.label, r.x0, r.y0) for r in got] == [(0, "text", 1, -1), (1, "footer", 1, -1)]


def test_missing_image_ends_the_query(spark):
    made = spark.createDataFrame([(1, "a"), (1, "b")], "page int, image_path string")
    images = spark.createDataFrame([("a", bytearray(b"x"))], "path string, image binary")
    with pytest.raises(Exception, match="no image at b"):
        pages.require_images(made, images).collect()


def _blocks(spark, n=6):
    rows = [(d, f"blk_{p}_0000{o}", o, p, "text", f"t{d}{p}{o}", None, None) for d in (1, 2) for p in range(1, n) for o in (0, 1)]
    return spark.createDataFrame(rows, schema.BLOCK)


def test_blocks_round_trip_and_page_overwrite(spark, tmp_path):
    blocks = _blocks(spark)
    records.write_blocks(blocks, str(tmp_path / "b"))
    one = blocks.where("doc_id = 1 and page = 2").selectExpr(*["'new' as text" if c == "text" else c for c in blocks.columns]).select(*blocks.columns)
    records.write_blocks(one, str(tmp_path / "b"))
    got = records.read_blocks(spark, str(tmp_path / "b"))
    assert got.count() == blocks.count() and got.where("text = 'new'").count() == 2


def test_array_files(spark, tmp_path):
    (tmp_path / "page_0001.blocks.json").write_text('[{"block_id": "x", "order_id": 0, "page": 1, "type": "text", "text": "ü", "title": null, "image_crop": null}]')
    assert records.read_block_arrays(spark, str(tmp_path), 7).select("doc_id", "block_id", "text").first() == (7, "x", "ü")


def test_resume(spark):
    work = spark.createDataFrame([(i,) for i in range(5)], "k int")
    done = spark.createDataFrame([(1, "v1"), (2, "v0")], "k int, fingerprint string")
    assert sorted(r.k for r in records.pending(work, done, ["k"]).collect()) == [0, 3, 4]
    assert sorted(r.k for r in records.pending(work, done, ["k"], "v1").collect()) == [0, 2, 3, 4]


def test_overlays(spark):
    spans = spark.createDataFrame([(1, 0, 0, "a", 9.0, 0, 0, 5, 5), (1, 0, 1, "b", 9.0, 0, 0, 10, 10)], schema.SPAN)
    order = spark.createDataFrame([(1, 0, 1, 0)], "doc_id bigint, page_index int, region_idx int, seq int")
    got = {r.region_idx: (r.label, r.label_x, r.label_y) for r in order_overlay(spans, order).collect()}
    assert got == {0: (None, None, None), 1: ("0", -5, 15)}
    assert order_overlay(spans).where("label is not null").count() == 0
    layout = spark.createDataFrame([(1, 0, 0, "text", 0.8, 1, 2, 3, 4), (1, 0, 1, "footer", 0.25, 1, 50, 3, 60)], schema.LAYOUT)
    got = {r.layout_idx: (r.palette_index, r.label_text, r.label_y) for r in layout_overlay(layout).collect()}
    assert got == {0: (1, "text (0.80)", 10), 1: (0, "footer (0.25)", 45)}


def test_stream_gives_the_blocks_of_the_batch(spark, tmp_path):
    from pagemill.operators.assembly import assemble

    rows = [(1, p, i, f"w{p}{i}", 9.0, 0, 20 * i, 100, 20 * i + 10) for p in range(3) for i in range(4)]
    spans = spark.createDataFrame(rows, schema.SPAN)
    layout = spark.createDataFrame([(1, p, 0, "table", 0.9, 0, 20, 100, 30) for p in range(2)], schema.LAYOUT)
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    stream.page_records(spans, layout).coalesce(1).write.json(source)
    for _ in range(2):  # a second run finds nothing new
        stream.stream_blocks(spark, source, target, str(tmp_path / "cp")).awaitTermination(120)
    got = stream.current_blocks(spark, target).select("block_id", "text").collect()
    want = assemble(spans, layout).select("block_id", "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)
    assert stream.refresh_sections(stream.current_blocks(spark, target), spark.createDataFrame([(1,)], "doc_id bigint")).count() >= 1


def _images(spark, n):
    rows = [(d, p, f"doc_{d}/pages/page_{p:04d}.png", bytearray(f"{d}.{p}".encode())) for d in range(1, n + 1) for p in range(3)]
    return spark.createDataFrame([*rows, (n, 9, f"doc_{n}/pages/none.png", None)], "doc_id bigint, page_index int, image_path string, image binary")


def test_images_are_read_where_they_were_put(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pages, "BATCH_BYTES", 5)
    got = pages.load_images(records.put_images(_images(spark, 4), str(tmp_path)), str(tmp_path)).collect()
    assert sorted((r.doc_id, r.page_index, bytes(r.image).decode()) for r in got) == [(d, p, f"{d}.{p}") for d in range(1, 5) for p in range(3)]
    assert {r.image_path for r in got} == {str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*") if p.is_file()}
    (tmp_path / "doc_2/pages/page_0001.png").unlink()
    known = _images(spark, 4).where("image is not null").drop("image")
    with pytest.raises(Exception, match="no image at doc_2/pages/page_0001.png"):
        pages.load_images(known, str(tmp_path)).collect()


def test_images_read_once_leave_nothing(spark, tmp_path):
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, 4)  # documents lie across batches
    try:
        through = pages.load_images(records.put_images(_images(spark, 9).coalesce(2), str(tmp_path), apart=True), str(tmp_path), spend=True)
        for _ in range(2):  # the frame may be asked again
            got = through.collect()
            assert sorted((r.doc_id, r.page_index, bytes(r.image).decode()) for r in got) == [(d, p, f"{d}.{p}") for d in range(1, 10) for p in range(3)]
            assert not [*tmp_path.iterdir()]
    finally:
        spark.conf.set(batch, before)
